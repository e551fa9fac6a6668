"""Composites over boxes as video, and the files that jobs read and leave."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapwing.datasets import BOXES_SQL, DIALOGUE_SQL, boxes, dialogue, table
from lapwing.functions import text as tx
from lapwing.operators import cover
from lapwing.operators import schedule as sc
from lapwing.plans.interval_queries import DAY
from lapwing.plans.join_queries import _CC, _REACH, _cues_clusters
from lapwing.registry import query


def _video(spark, sf_dir):
    return boxes(spark, sf_dir).select(F.expr("frame div 64").alias("v"), (F.col("frame") % 64).alias("at"), "ord", "x1", "y1", "x2", "y2", "score")


_V = f"WITH {BOXES_SQL}, v AS (SELECT frame // 64 AS v, frame % 64 AS fr, ord, x1, y1, x2, y2, score FROM bx), cl AS (SELECT v, fr AS idx, fr AS s, fr + 1 AS e, min(x1) AS x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2 FROM v WHERE score >= 8 GROUP BY v, fr)"


def _clusters(spark, sf_dir):
    g = _video(spark, sf_dir).where("score >= 8").groupBy("v", "at").agg(F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"))
    return g.select("v", F.col("at").alias("index"), F.col("at").alias("start"), (F.col("at") + 1).alias("end"), "x1", "y1", "x2", "y2")


@query(
    "b19_reference_rects",
    _V + """, s AS (SELECT cl.v, idx, min(d.x1) AS a, min(d.y1) AS b, max(d.x2) AS c, max(d.y2) AS f, count(*) AS n FROM cl JOIN v d ON d.v = cl.v AND d.fr >= s - 1 AND d.fr <= e + 1 WHERE d.y1 BETWEEN 200 AND 500 GROUP BY cl.v, idx)
    SELECT cl.v, cl.idx AS index, coalesce(a, x1) AS x1, coalesce(b, y1) AS y1, coalesce(c, x2) AS x2, coalesce(f, y2) AS y2, coalesce(n, 0) AS support FROM cl LEFT JOIN s ON s.v = cl.v AND s.idx = cl.idx""",
)
def b19_reference_rects(spark, sf_dir):
    d = _video(spark, sf_dir).select("v", "at", "x1", "y1", "x2", "y2")
    return cover.reference_rects(_clusters(spark, sf_dir), d, ["v"], 8, 1, F.col("y1").between(200, 500)).drop("start", "end")


@query(
    "b16_event_rects",
    _V + """, a AS (SELECT cl.v, idx, min(d.x1) AS a, min(d.y1) AS b, max(d.x2) AS c, max(d.y2) AS f, count(*) AS n FROM cl JOIN v d ON d.v = cl.v AND d.fr >= s - 1 AND d.fr <= e + 1
      WHERE (d.x1 + d.x2) / 2.0 / 1280 BETWEEN 0.15 AND 0.85 AND (d.y1 + d.y2) / 2.0 / 720 BETWEEN 0.55 AND 0.90 AND d.x1 < cl.x2 + 42 AND d.x2 > cl.x1 - 42 AND d.y1 < cl.y2 + 42 AND d.y2 > cl.y1 - 42 GROUP BY cl.v, idx)
    SELECT cl.v, cl.idx AS index, greatest(0, coalesce(a, x1) - 26) AS x1, greatest(0, coalesce(b, y1) - 26) AS y1, least(1280, coalesce(c, x2) + 26) AS x2, least(720, coalesce(f, y2) + 26) AS y2, coalesce(n, 0) AS accepted
    FROM cl LEFT JOIN a ON a.v = cl.v AND a.idx = cl.idx""",
)
def b16_event_rects(spark, sf_dir):
    d = _video(spark, sf_dir).select("v", "at", "x1", "y1", "x2", "y2")
    return cover.event_rects(_clusters(spark, sf_dir), d, ["v"], 8, 1, 42, 26, 1280, 720)


@query("b24_watermark_cluster")
def b24_watermark_cluster(spark, sf_dir):
    return cover.watermark_rects(boxes(spark, sf_dir), ["frame"], [(10, 10, 200, 60), (1100, 640, 1270, 710)])


@query("j28_mask_pipeline")
def j28_mask_pipeline(spark, sf_dir):
    rows = _video(spark, sf_dir).withColumnRenamed("at", "frame").withColumns({"detector": F.when(F.col("ord") % 2 == 0, "a").otherwise("b"), "score": F.col("score") / 10.0, "cjk": F.col("ord") % 3 != 0})
    return cover.mask_pipeline(rows, "v", 8.0, 1280, 720).select("v", "start", "end", "members", "context_start", "context_end", F.size("rects").alias("rects"))


@query(
    "j27_cue_pipeline",
    _CC + f""", p AS (SELECT cues.key, cues.ord, cl.idx, greatest(0, least(cues.e, cl.e) - greatest(cues.s, cl.s)) AS o, greatest(0, cl.s - cues.e, cues.s - cl.e) AS g, greatest(cues.s, cl.s) AS a, least(cues.e, cl.e) AS b
      FROM cues JOIN cl ON cues.key = cl.key AND cl.s <= cues.e + {_REACH} AND cues.s <= cl.e + {_REACH}),
    r AS (SELECT *, row_number() OVER (PARTITION BY key, ord ORDER BY o * 1000.0 - g * 100.0 DESC, idx) AS n FROM p), k AS (SELECT key, ord, idx, a, b FROM r WHERE n = 1 AND b - a >= 120000000)
    SELECT key, ord, idx AS index, a AS start, b AS "end", 'cue' AS origin FROM k UNION ALL SELECT key, -1, idx, s, e, 'retry' FROM cl WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.key = cl.key AND k.idx = cl.idx)""",
)
def j27_cue_pipeline(spark, sf_dir):
    cues, clusters = _cues_clusters(spark, sf_dir)
    return cover.cue_pipeline(cues, clusters, ["key"], DAY, _REACH, 120000000)


@query(
    "r21_mix_manifest",
    f"""WITH {DIALOGUE_SQL}, s AS (SELECT conv_id, ord, e AS off, CASE WHEN ord % 7 = 6 THEN lag(e) OVER w + 1 ELSE lag(e) OVER w END AS prev, lag(e) OVER w AS actual, CASE WHEN ord % 2 = 0 THEN 'voice' ELSE 'music' END AS stem FROM dl WINDOW w AS (PARTITION BY conv_id ORDER BY ord))
    SELECT conv_id, bool_and(coalesce(prev = actual, prev IS NULL)) AS chained, max(off) <= 1199 AS inside, list_sort(list_distinct(list(stem))) = ['music', 'voice'] AS stems, max(off) AS "last" FROM s GROUP BY conv_id""",
)
def r21_mix_manifest(spark, sf_dir):
    from pyspark.sql import Window

    prev = F.lag("end").over(Window.partitionBy("conv_id").orderBy("ord"))
    rows = dialogue(spark, sf_dir).select("conv_id", "ord", F.col("end").alias("offset"), F.when(F.col("ord") % 7 == 6, prev + 1).otherwise(prev).alias("previous_offset"), F.when(F.col("ord") % 2 == 0, "voice").otherwise("music").alias("stem"))
    return cover.mix_manifest(rows, ["conv_id"], ["voice", "music"], F.lit(1200))


@query(
    "r14_r15_schedule_checks",
    f"""WITH {DIALOGUE_SQL}, t AS (SELECT conv_id, ord, s, e, s - ord AS anchor, lag(e) OVER (PARTITION BY conv_id ORDER BY ord) AS pe FROM dl)
    SELECT conv_id, ord, concat_ws(',', CASE WHEN s - pe < 1 THEN 'gap' END, CASE WHEN s - anchor > 3 THEN 'lag' END, CASE WHEN e > 1500 THEN 'end' END) AS rules FROM t WHERE coalesce(s - pe < 1, false) OR s - anchor > 3 OR e > 1500""",
)
def r14_r15_schedule_checks(spark, sf_dir):
    rows = dialogue(spark, sf_dir).withColumn("anchor", F.col("start") - F.col("ord"))
    return sc.schedule_violations(rows, ["conv_id"], 1, 3, F.lit(1500)).select("conv_id", "ord", F.array_join("rules", ",").alias("rules"))


@query(
    "x28_shorts_fields",
    """SELECT conv_id, turn, left(coalesce(nullif(trim(text), ''), 'untitled'), 100) AS title, left(concat_ws(chr(10) || chr(10), nullif(trim(text), ''), '#shorts'), 5000) AS description FROM conversations""",
)
def x28_shorts_fields(spark, sf_dir):
    body = F.nullif(F.trim("text"), F.lit(""))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.substring(F.coalesce(body, F.lit("untitled")), 1, 100).alias("title"), F.substring(F.concat_ws("\n\n", body, F.lit("#shorts")), 1, 5000).alias("description"))


@query("x27_finalized_cues")
def x27_finalized_cues(spark, sf_dir):
    t = tx.squeeze(F.col("text"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.sha2(t, 256).alias("text"), F.size(tx.balanced_lines(F.col("text"))).alias("line_count"))
