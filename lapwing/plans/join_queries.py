"""Join, deduplication, scheduling, tracking and fold queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lapwing.datasets import BOXES_SQL, DIALOGUE_SQL, INTERVALS_SQL, boxes, dialogue, intervals, table
from lapwing.functions import geometry
from lapwing.operators import folds
from lapwing.operators import intervals as iv
from lapwing.operators import joins as jn
from lapwing.operators import schedule as sc
from lapwing.plans.interval_queries import DAY, HOUR, _islands_sql
from lapwing.registry import query

_REACH = 2 * HOUR


def _cues_clusters(spark, sf_dir):
    rows = intervals(spark, sf_dir).where("end > start")
    return rows.where("kind in ('click', 'purchase')").select("key", "ord", "start", "end"), rows.where("kind = 'view'").select("key", F.col("ord").alias("index"), "start", "end")


_CC = f"""WITH {INTERVALS_SQL}, cues AS (SELECT key, ord, s, e FROM iv WHERE e > s AND kind IN ('click', 'purchase')), cl AS (SELECT key, ord AS idx, s, e FROM iv WHERE e > s AND kind = 'view')"""


@query(
    "j01_j03_match_cluster",
    _CC + f""", p AS (SELECT cues.key, cues.ord, cl.idx, greatest(0, least(cues.e, cl.e) - greatest(cues.s, cl.s)) AS overlap, greatest(0, cl.s - cues.e, cues.s - cl.e) AS gap
      FROM cues JOIN cl ON cues.key = cl.key AND cl.s <= cues.e + {_REACH} AND cues.s <= cl.e + {_REACH}),
    r AS (SELECT key, ord, idx, overlap, gap, row_number() OVER (PARTITION BY key, ord ORDER BY overlap * 1000.0 - gap * 100.0 DESC, idx) AS n FROM p WHERE overlap > 0 OR gap <= {_REACH})
    SELECT key, ord, idx AS cluster, overlap, gap FROM r WHERE n = 1""",
)
def j01_j03_match_cluster(spark, sf_dir):
    cues, clusters = _cues_clusters(spark, sf_dir)
    return jn.match_clusters(cues, clusters, ["key"], DAY, _REACH).select("key", "ord", F.col("r_index").alias("cluster"), "overlap", "gap")


@query(
    "j04_clusters_without_cues",
    _CC + f" SELECT key, idx AS ord, s AS start, e AS \"end\" FROM cl WHERE NOT EXISTS (SELECT 1 FROM cues WHERE cues.key = cl.key AND least(cues.e, cl.e) - greatest(cues.s, cl.s) >= {HOUR // 10})",
)
def j04_clusters_without_cues(spark, sf_dir):
    cues, clusters = _cues_clusters(spark, sf_dir)
    return jn.without_match(clusters.withColumnRenamed("index", "ord"), cues.drop("ord"), ["key"], DAY, HOUR // 10).select("key", "ord", "start", "end")


@query(
    "j06_voice_sync",
    f"""WITH {DIALOGUE_SQL}, y AS (SELECT conv_id, max(ord) AS o, ord // 2 AS line FROM dl GROUP BY conv_id, ord // 2), t AS (SELECT y.conv_id, line AS ord, dl.s + 5 AS s, dl.s + 5 + (dl.e - dl.s) // 2 AS e FROM y JOIN dl ON dl.conv_id = y.conv_id AND dl.ord = y.o),
    j AS (SELECT dl.conv_id, dl.ord, greatest(0, least(900, coalesce(t.s, dl.s))) AS s, least(900, coalesce(t.e, dl.e)) AS e FROM dl LEFT JOIN t ON t.conv_id = dl.conv_id AND t.ord = dl.ord)
    SELECT conv_id, ord, s AS start, greatest(s, e) AS "end" FROM j WHERE greatest(s, e) > s""",
)
def j06_voice_sync(spark, sf_dir):
    lines = dialogue(spark, sf_dir)
    sync = lines.select("conv_id", F.expr("ord div 2").alias("line"), F.col("ord").alias("o"), (F.col("start") + 5).alias("start"), F.expr("start + 5 + (end - start) div 2").alias("end"))
    sync = sync.withColumnRenamed("line", "ord")
    return jn.coalesce_timing(lines, sync, ["conv_id", "ord"], F.lit(900), "o").select("conv_id", "ord", "start", "end")


@query(
    "j07_j18_one_to_one",
    """WITH l AS (SELECT doc_id, count(*) AS n, min(n_chars) AS a FROM documents GROUP BY doc_id), r AS (SELECT doc_id, count(*) AS n, min(quality * 1000) AS a FROM labels GROUP BY doc_id)
    SELECT coalesce(l.doc_id, r.doc_id) AS doc_id, CASE WHEN r.n IS NULL THEN 'missing_right' WHEN l.n IS NULL THEN 'missing_left' WHEN l.n > 1 OR r.n > 1 THEN 'repeated'
      WHEN l.a IS DISTINCT FROM r.a THEN 'differs_n_chars' END AS problem
    FROM l FULL JOIN r ON l.doc_id = r.doc_id WHERE NOT (l.n = 1 AND r.n = 1 AND l.a IS NOT DISTINCT FROM r.a) OR l.n IS NULL OR r.n IS NULL""",
)
def j07_j18_one_to_one(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").withColumn("a", (F.col("quality") * 1000).cast("long"))
    return jn.one_to_one(table(spark, sf_dir, "documents"), labels, "doc_id", {"n_chars": "a"})


@query(
    "j09_delay_comparison",
    """WITH o AS (SELECT o_custkey, o_orderkey, epoch_us(o_orderdate) AS t FROM orders), l AS (SELECT l_orderkey, min(epoch_us(l_shipdate)) AS first_ship FROM lineitem GROUP BY l_orderkey)
    SELECT o_custkey, count(*) AS n, max(abs(first_ship - t)) AS max_abs, sum(CASE WHEN first_ship > t THEN 1 ELSE 0 END)::BIGINT AS late FROM o JOIN l ON o_orderkey = l_orderkey GROUP BY o_custkey""",
)
def j09_delay_comparison(spark, sf_dir):
    us = lambda c: F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {c})")
    first = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min(us("l_shipdate")).alias("ship"))
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", us("o_orderdate").alias("t")).join(first, F.col("o_orderkey") == F.col("l_orderkey"))
    return rows.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("ship") - F.col("t"))).alias("max_abs"), F.count_if(F.col("ship") > F.col("t")).alias("late"))


@query("j10_j11_new_documents", "SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def j10_j11_new_documents(spark, sf_dir):
    docs, seen = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return jn.new_items(docs, seen, "doc_id", "n_chars").select("doc_id", "source")


@query(
    "j13_effective_clusters",
    _CC + """ SELECT cl.key, idx AS cluster, count(cues.ord) AS n, coalesce(min(cues.s), cl.s) AS first_at, coalesce(max(cues.s), cl.e) AS last_at
    FROM cl LEFT JOIN cues ON cues.key = cl.key AND cues.s BETWEEN cl.s AND cl.e GROUP BY cl.key, idx, cl.s, cl.e""",
)
def j13_effective_clusters(spark, sf_dir):
    cues, clusters = _cues_clusters(spark, sf_dir)
    points = cues.select("key", F.col("start"), F.col("start").alias("end"))
    pairs = iv.bucketed_pairs(clusters, points, ["key"], DAY)
    agg = pairs.groupBy("key", "index").agg(F.count(F.lit(1)).alias("n"), F.min("r_start").alias("a"), F.max("r_start").alias("b"))
    rows = clusters.join(agg, ["key", "index"], "left")
    return rows.select("key", F.col("index").alias("cluster"), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("a", "start").alias("first_at"), F.coalesce("b", "end").alias("last_at"))


@query(
    "j14_uncovered_detections",
    _CC + f""", u AS (SELECT key, s, s AS e FROM cues WHERE NOT EXISTS (SELECT 1 FROM cl WHERE cl.key = cues.key AND cues.s BETWEEN cl.s AND cl.e)),
    {_islands_sql('u', 'm', HOUR)} SELECT key, s AS start, e AS "end", members FROM m""",
)
def j14_uncovered_detections(spark, sf_dir):
    cues, clusters = _cues_clusters(spark, sf_dir)
    return jn.uncovered_points(cues.select("key", "ord", F.col("start").alias("at")), clusters.drop("index"), ["key"], DAY, HOUR)


@query(
    "j15_j16_coverage",
    _CC + f""", c AS (SELECT cl.key, cl.idx, greatest(cl.s, cues.s) AS s, least(cl.e, cues.e) AS e FROM cl JOIN cues ON cl.key = cues.key AND cues.s < cl.e AND cues.e > cl.s),
    o AS (SELECT key, idx, s, e, max(e) OVER (PARTITION BY key, idx ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM c),
    t AS (SELECT key, idx, sum(greatest(0, e - greatest(s, coalesce(reach, s)))) AS covered FROM o GROUP BY key, idx)
    SELECT cl.key, cl.idx AS ord, CAST(coalesce(covered, 0) AS BIGINT) AS covered, CAST(cl.e - cl.s - coalesce(covered, 0) AS BIGINT) AS uncovered FROM cl LEFT JOIN t ON t.key = cl.key AND t.idx = cl.idx""",
)
def j15_j16_coverage(spark, sf_dir):
    cues, clusters = _cues_clusters(spark, sf_dir)
    return jn.coverage(clusters.withColumnRenamed("index", "ord"), cues.drop("ord"), ["key"], DAY).select("key", "ord", "covered", "uncovered")


@query(
    "j17_timing_excess",
    _CC + f""", m AS (SELECT cl.key, cl.idx, min(cues.s) AS a, max(cues.e) AS b FROM cl JOIN cues ON cl.key = cues.key AND cues.s < cl.e AND cues.e > cl.s GROUP BY cl.key, cl.idx)
    SELECT cl.key, count(*) AS clusters, CAST(sum(greatest(0, cl.s - {HOUR} - a)) AS BIGINT) AS early, CAST(sum(greatest(0, b - cl.e - {HOUR})) AS BIGINT) AS late FROM cl JOIN m ON m.key = cl.key AND m.idx = cl.idx GROUP BY cl.key""",
)
def j17_timing_excess(spark, sf_dir):
    cues, clusters = _cues_clusters(spark, sf_dir)
    pairs = iv.bucketed_pairs(clusters, cues, ["key"], DAY).where("r_start < end and r_end > start")
    m = pairs.groupBy("key", "index", "start", "end").agg(F.min("r_start").alias("a"), F.max("r_end").alias("b"))
    zero = F.lit(0).cast("bigint")
    early, late = F.greatest(zero, F.col("start") - HOUR - F.col("a")), F.greatest(zero, F.col("b") - F.col("end") - HOUR)
    return m.groupBy("key").agg(F.count(F.lit(1)).alias("clusters"), F.sum(early).alias("early"), F.sum(late).alias("late"))


@query(
    "j20_resolve_refs",
    """SELECT o_orderkey, CASE WHEN c_custkey IS NULL THEN 'missing' WHEN c_nationkey = o_orderkey % 25 THEN 'found' ELSE 'mismatch' END AS status
    FROM (SELECT o_orderkey, o_custkey % 2000 AS ref FROM orders) LEFT JOIN customer ON c_custkey = ref""",
)
def j20_resolve_refs(spark, sf_dir):
    refs = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 2000).alias("c_custkey"), (F.col("o_orderkey") % 25).cast("int").alias("c_nationkey"))
    return jn.resolve(refs, table(spark, sf_dir, "customer"), ["c_custkey", "c_nationkey"], "c_custkey").select("o_orderkey", "status")


@query(
    "j21_bundle_index",
    "SELECT sha256(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g')) AS digest, count(*) AS copies, CAST(sum(strlen(text)) AS BIGINT) AS bytes FROM documents GROUP BY 1",
)
def j21_bundle_index(spark, sf_dir):
    d = table(spark, sf_dir, "documents").withColumn("digest", F.sha2(F.regexp_replace("text", r"\s+", " "), 256))
    return d.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"), F.sum(F.octet_length("text")).alias("bytes"))


@query(
    "j25_samples_per_cue",
    _CC + f", f AS (SELECT key, s AS at FROM iv) SELECT cues.key, cues.ord, count(f.at) AS samples FROM cues LEFT JOIN f ON f.key = cues.key AND f.at >= cues.s AND f.at < cues.e GROUP BY cues.key, cues.ord",
)
def j25_samples_per_cue(spark, sf_dir):
    cues, _ = _cues_clusters(spark, sf_dir)
    frames = intervals(spark, sf_dir).select("key", "start", F.col("start").alias("end"))
    n = iv.bucketed_pairs(cues, frames, ["key"], DAY).where("r_start < end").groupBy("key", "ord").agg(F.count(F.lit(1)).alias("samples"))
    return cues.join(n, ["key", "ord"], "left").select("key", "ord", F.coalesce("samples", F.lit(0)).alias("samples"))


# --- deduplication ---------------------------------------------------------


@query(
    "d06_richest_row",
    """WITH r AS (SELECT doc_id, source, n_chars, row_number() OVER (PARTITION BY source ORDER BY CASE WHEN lang = 'en' THEN 0 ELSE 1 END, doc_id) AS n FROM documents) SELECT source, doc_id, n_chars FROM r WHERE n = 1""",
)
def d06_richest_row(spark, sf_dir):
    return jn.richest(table(spark, sf_dir, "documents"), ["source"], F.col("lang") == "en", "doc_id").select("source", "doc_id", "n_chars")


@query(
    "d07_cue_plans",
    f"""WITH {DIALOGUE_SQL}, u AS (SELECT conv_id, ord // 2 AS cue, min(s) AS s, count(DISTINCT s) AS starts FROM dl GROUP BY conv_id, ord // 2), t AS (SELECT conv_id, max(e) AS d FROM dl GROUP BY conv_id),
    n AS (SELECT u.conv_id, cue, s, starts, coalesce(lead(s) OVER (PARTITION BY u.conv_id ORDER BY s, cue), d) - s AS slot FROM u JOIN t ON t.conv_id = u.conv_id)
    SELECT conv_id, cue, s AS start, slot, slot - 5 AS fit_target, starts > 1 AS conflict FROM n""",
)
def d07_cue_plans(spark, sf_dir):
    rows = dialogue(spark, sf_dir)
    cue = rows.groupBy("conv_id", F.expr("ord div 2").alias("cue")).agg(F.min("start").alias("start"), (F.count_distinct("start") > 1).alias("conflict"))
    total = rows.groupBy("conv_id").agg(F.max("end").alias("d"))
    nxt = F.coalesce(F.lead("start").over(Window.partitionBy("conv_id").orderBy("start", "cue")), "d")
    out = cue.join(total, "conv_id").withColumn("slot", nxt - F.col("start"))
    return out.select("conv_id", "cue", "start", "slot", (F.col("slot") - 5).alias("fit_target"), "conflict")


@query(
    "d04_adjacent_repeats",
    """WITH t AS (SELECT user_id, event_id, lower(trim(event_type)) AS t, lag(lower(trim(event_type))) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events) SELECT user_id, event_id, length(t) AS chars FROM t WHERE t = p AND t <> ''""",
)
def d04_adjacent_repeats(spark, sf_dir):
    t = F.lower(F.trim("event_type"))
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = table(spark, sf_dir, "events").withColumns({"t": t, "p": F.lag(t).over(w)})
    return rows.where("t = p and t <> ''").select("user_id", "event_id", F.length("t").alias("chars"))


@query("d09_signature", f"WITH {DIALOGUE_SQL} SELECT conv_id, sha256(string_agg(CAST(s AS VARCHAR) || ':' || CAST(e AS VARCHAR) || ':' || text, '|' ORDER BY ord)) AS signature FROM dl GROUP BY conv_id")
def d09_signature(spark, sf_dir):
    part = F.concat_ws(":", F.col("start").cast("string"), F.col("end").cast("string"), "text")
    ordered = F.array_sort(F.collect_list(F.struct("ord", part.alias("p"))))
    return dialogue(spark, sf_dir).groupBy("conv_id").agg(F.sha2(F.array_join(F.transform(ordered, lambda x: x["p"]), "|"), 256).alias("signature"))


def _lines(spark, sf_dir):
    """Turns as dialogue lines in seconds, a tenth of a second a character."""
    rows = dialogue(spark, sf_dir)
    return rows.select("conv_id", "ord", (F.col("start") / 10).alias("start"), (F.col("end") / 10).alias("end"), F.lit("").alias("text_zh"), F.col("text").alias("text_vi"))


_LINE = "ord long, start double, end double"


def _times(rows):
    return [{"ord": r["ord"], "start": r["start"], "end": r["end"]} for r in rows]


@query("d01_merge_lines")
def d01_merge_lines(spark, sf_dir):
    return folds.fold_per_key(_lines(spark, sf_dir), ["conv_id"], lambda rows: _times(folds.merge_lines(rows)), _LINE, ["ord"])


@query("d02_tail_repeats")
def d02_tail_repeats(spark, sf_dir):
    return folds.fold_per_key(_lines(spark, sf_dir), ["conv_id"], lambda rows: _times(folds.suppress_tail_repeats(rows, max(r["end"] for r in rows))), _LINE, ["ord"])


@query(
    "d03_merge_touching",
    f"""WITH RECURSIVE {DIALOGUE_SQL}, l AS (SELECT conv_id, ord, s, e, left(text, 1) AS c, row_number() OVER (PARTITION BY conv_id ORDER BY ord) AS n FROM dl),
    q AS (SELECT conv_id, n, ord AS head, s, e, c, 1 AS size FROM l WHERE n = 1
      UNION ALL SELECT l.conv_id, l.n, CASE WHEN m THEN head ELSE l.ord END, CASE WHEN m THEN least(q.s, l.s) ELSE l.s END, CASE WHEN m THEN greatest(q.e, l.e) ELSE l.e END, CASE WHEN m THEN q.c ELSE l.c END, CASE WHEN m THEN size + 1 ELSE 1 END
        FROM (SELECT *, 1 AS one FROM q) q JOIN l ON l.conv_id = q.conv_id AND l.n = q.n + 1, LATERAL (SELECT 10 * (l.s - q.e) BETWEEN -5 AND 15 AND l.c = q.c AS m))
    SELECT conv_id, head AS ord, arg_max(s, n) AS start, arg_max(e, n) AS "end", max(size) AS n FROM q GROUP BY conv_id, head""",
)
def d03_merge_touching(spark, sf_dir):
    """In tenths of a second; the first letters stand for the texts' likeness."""

    def fold(rows):
        same = lambda a, b: a["text"][:1] == b["text"][:1]
        return [{**r, "n": len(r["members"])} for r in folds.merge_touching(rows, -0.5, 1.5, same)]

    rows = dialogue(spark, sf_dir).select("conv_id", "ord", "start", "end", "text")
    return folds.fold_per_key(rows, ["conv_id"], fold, "ord long, start long, end long, n long", ["ord"])


@query("c09_non_overlapping")
def c09_non_overlapping(spark, sf_dir):
    return folds.fold_per_key(_lines(spark, sf_dir), ["conv_id"], lambda rows: _times(folds.non_overlapping(rows)), _LINE, ["ord"])


@query("c10_readable")
def c10_readable(spark, sf_dir):
    return folds.fold_per_key(_lines(spark, sf_dir), ["conv_id"], lambda rows: _times(folds.readable(rows, max(r["end"] for r in rows) + 1)), _LINE, ["ord"])


@query("j02_gate")
def j02_gate(spark, sf_dir):
    """Cues cut to their best interval, short ones dropped, overlaps split."""
    cues, clusters = _cues_clusters(spark, sf_dir)
    pairs = iv.bucketed_pairs(cues, clusters, ["key"], DAY, HOUR // 10)
    overlap = F.greatest(F.lit(0).cast("bigint"), F.least("end", "r_end") - F.greatest("start", "r_start"))
    gap = iv.temporal_gap(F.col("start"), F.col("end"), F.col("r_start"), F.col("r_end"))
    best = iv.best_match(pairs, ["key", "ord"], overlap * 1.0 - gap * 1e-9, ["r_index"])
    gated = best.select("key", "ord", F.greatest("start", "r_start").alias("start"), F.least("end", "r_end").alias("end")).where("end - start >= 60000000")
    seconds = gated.withColumns({"start": F.col("start").cast("double"), "end": F.col("end").cast("double")})
    return folds.fold_per_key(seconds, ["key"], lambda rows: folds.split_overlaps(rows, 6e7), _LINE, ["start", "end", "ord"])


# --- tracking --------------------------------------------------------------

_BOX = "x1 int, y1 int, x2 int, y2 int"


def _video(spark, sf_dir):
    """Boxes of 64 orders as one video, an order a frame."""
    b = boxes(spark, sf_dir)
    return b.select(F.expr("frame div 64").alias("video"), (F.col("frame") % 64).alias("frame"), "ord", "x1", "y1", "x2", "y2", F.col("score").cast("double").alias("priority"))


@query("c01_c02_spans")
def c01_c02_spans(spark, sf_dir):
    def fold(rows):
        return folds.merge_spans(folds.spans(rows, 8.0, 0.25, 5))

    return folds.fold_per_key(_video(spark, sf_dir), ["video"], fold, "start double, end double, " + _BOX + ", samples long", ["frame", "y1", "x1", "ord"])


@query("c03_persistent")
def c03_persistent(spark, sf_dir):
    return folds.fold_per_key(_video(spark, sf_dir), ["video"], lambda rows: folds.persistent(rows, 0.2, 2), "frame long, ord long, " + _BOX, ["frame", "ord"])


@query("c06_merge_blur")
def c06_merge_blur(spark, sf_dir):
    rows = _video(spark, sf_dir).withColumns({"start": F.col("frame") / 8.0, "end": F.col("frame") / 8.0 + 0.2, "cluster": F.col("frame").cast("long") % 4})
    return folds.fold_per_key(rows, ["video"], folds.merge_blur, "event_id long, start double, end double, " + _BOX, ["frame", "ord"])


@query("b17_connected_rect")
def b17_connected_rect(spark, sf_dir):
    found = boxes(spark, sf_dir).groupBy("frame").agg(F.collect_list(F.struct("ord", "x1", "y1", "x2", "y2")).alias("r"))
    return found.select("frame", geometry.connected_rect(F.col("r"), 12).alias("b")).select("frame", "b.*")


@query(
    "c12_sequential_events",
    f"""WITH {DIALOGUE_SQL}, p AS (SELECT conv_id, ord, s, e, list_filter(list_transform(string_split_regex(trim(regexp_replace(text, '\\s+', ' ', 'g')), '[,，、;；:：.!。！？?…]+'), lambda p: trim(p)), lambda p: p <> '') AS ph FROM dl),
    x AS (SELECT conv_id, ord, s, e, unnest(ph) AS phrase, unnest(range(1, len(ph) + 1)) AS i FROM p), w AS (SELECT *, greatest(1, length(replace(phrase, ' ', ''))) AS weight FROM x),
    r AS (SELECT *, sum(weight) OVER (PARTITION BY conv_id, ord ORDER BY i ROWS UNBOUNDED PRECEDING) AS run, sum(weight) OVER (PARTITION BY conv_id, ord) AS total, max(i) OVER (PARTITION BY conv_id, ord) AS last FROM w)
    SELECT conv_id, ord, i - 1 AS phrase_index, phrase, round(s + (e - s) * (run - weight) / total, 6) AS part_start, round(CASE WHEN i = last THEN CAST(e AS DOUBLE) ELSE s + (e - s) * run / total END, 6) AS part_end FROM r""",
)
def c12_sequential_events(spark, sf_dir):
    from lapwing.functions import text as tx

    rows = dialogue(spark, sf_dir).select("conv_id", "ord", "start", "end", F.posexplode(tx.phrases(F.col("text"))).alias("phrase_index", "phrase"))
    rows = rows.withColumn("weight", F.greatest(F.lit(1), F.length(F.replace("phrase", F.lit(" "), F.lit("")))))
    out = sc.proportional(rows, ["conv_id", "ord"], "weight", "phrase_index")
    return out.select("conv_id", "ord", F.col("phrase_index").cast("long").alias("phrase_index"), "phrase", F.round("part_start", 6).alias("part_start"), F.round("part_end", 6).alias("part_end"))


# --- scheduling ------------------------------------------------------------


def _clips(spark, sf_dir):
    """Events of a user as clips: anchored at their start, a share of their
    length long, all in microseconds."""
    w = Window.partitionBy("key").orderBy("start", "ord")
    return intervals(spark, sf_dir).withColumns({"n": F.row_number().over(w) - 1, "clip": (F.col("end") - F.col("start")) * 20 + 1000000})


_CLIPS = f"WITH RECURSIVE {INTERVALS_SQL}, c AS (SELECT key, ord, s AS start, e, (e - s) * 20 + 1000000 AS clip, row_number() OVER (PARTITION BY key ORDER BY s, ord) - 1 AS n FROM iv)"


@query(
    "r02_r03_fixed_rate",
    _CLIPS + f""", q AS (SELECT key, n, start, clip, start AS onset, start + clip AS off FROM c WHERE n = 0
      UNION ALL SELECT c.key, c.n, c.start, c.clip, greatest(c.start, q.off + {HOUR}), greatest(c.start, q.off + {HOUR}) + c.clip FROM q JOIN c ON c.key = q.key AND c.n = q.n + 1)
    SELECT key, n, onset, off AS "offset", onset - start AS lag FROM q""",
)
def r02_r03_fixed_rate(spark, sf_dir):
    return sc.fixed_rate(_clips(spark, sf_dir), ["key"], "start", "clip", HOUR, "n").select("key", F.col("n").cast("long").alias("n"), "onset", "offset", "lag")


@query(
    "r01_r02_samples",
    _CLIPS + """, d AS (SELECT key, n, start // 1000000 AS anchor, ord % 300 AS don, ord % 300 + clip // 1000000 AS doff FROM c),
    q AS (SELECT key, n, anchor, don, doff, greatest(0, anchor - don) AS placement FROM d WHERE n = 0
      UNION ALL SELECT d.key, d.n, d.anchor, d.don, d.doff, greatest(0, greatest(d.anchor, q.placement + q.doff + 2205) - d.don) FROM q JOIN d ON d.key = q.key AND d.n = q.n + 1),
    f AS (SELECT key, n, placement, placement + don AS actual_onset, placement + doff AS actual_offset, placement + don - anchor AS lag FROM q), g AS (SELECT *, lag <= 26460 AND actual_offset <= 1999999999 AS fits FROM f)
    SELECT *, bool_and(fits) OVER (PARTITION BY key ORDER BY n ROWS UNBOUNDED PRECEDING) AS valid FROM g""",
)
def r01_r02_samples(spark, sf_dir):
    rows = _clips(spark, sf_dir).select("key", "n", F.expr("start div 1000000").alias("anchor"), F.expr("ord % 300").alias("detected_onset"), F.expr("ord % 300 + clip div 1000000").alias("detected_offset"))
    out = sc.sample_schedule(rows, ["key"], 2205, 26460, F.lit(2_000_000_000), "n")
    return out.select("key", F.col("n").cast("long").alias("n"), "placement", "actual_onset", "actual_offset", "lag", "fits", "valid")


@query(
    "r07_cascade_anchor",
    f"""WITH {INTERVALS_SQL}, d AS (SELECT key, max(e) AS d FROM iv GROUP BY key), c AS (SELECT iv.key, ord, e, d, ord % 3 AS cluster, lead(s) OVER w AS ns, lead(ord % 3) OVER w AS nc FROM iv JOIN d ON d.key = iv.key WINDOW w AS (PARTITION BY iv.key ORDER BY s, ord))
    SELECT key, ord, CASE WHEN ns IS NULL THEN least(d, e + {HOUR}) WHEN nc = cluster THEN least(d, ns) ELSE least(d, e + {HOUR}, ns) END AS anchor FROM c""",
)
def r07_cascade_anchor(spark, sf_dir):
    rows = _clips(spark, sf_dir).withColumn("cluster", F.col("ord") % 3)
    rows = rows.withColumn("d", F.max("end").over(Window.partitionBy("key")))
    return sc.cascade_anchor(rows, ["key"], HOUR, F.col("d"), "n").select("key", "ord", "anchor")


@query(
    "r09_speech_slots",
    f"""WITH {INTERVALS_SQL}, c AS (SELECT key, ord, s, e, (e - s) * 2 + 1000000 AS clip, lead(s) OVER (PARTITION BY key ORDER BY s, ord) AS ns FROM iv),
    a AS (SELECT *, least(e + {HOUR // 60}, coalesce(ns - 30000, e + {HOUR // 60})) - s AS target FROM c), b AS (SELECT *, CASE WHEN target > 0 THEN clip / CAST(target AS DOUBLE) END AS need FROM a)
    SELECT key, ord, target, CASE WHEN target > 0 THEN CASE WHEN clip <= target THEN 1.0 ELSE least(CASE WHEN need > 1.600000001 THEN 2.0 ELSE 1.6 END, need) END ELSE -1 END AS speed FROM b""",
)
def r09_speech_slots(spark, sf_dir):
    rows = _clips(spark, sf_dir).withColumn("clip", (F.col("end") - F.col("start")) * 2 + 1000000)
    out = sc.speech_slots(rows, ["key"], 30000, HOUR // 60, F.lit(1 << 62), 1.6, 2.0, "n")
    return out.select("key", "ord", "target", F.coalesce("speed", F.lit(-1.0)).alias("speed"))


@query(
    "r10_r11_clamped_speech",
    f"""WITH {INTERVALS_SQL}, x AS (SELECT key, ord, s + (ord * 7919) % 1000000 - 500000 AS a, s AS v, e FROM iv), y AS (SELECT *, least(v + 150000, greatest(greatest(0, v - 250000), a)) AS start FROM x)
    SELECT key, ord, start, start + greatest(50000, e - a) AS "end" FROM y""",
)
def r10_r11_clamped_speech(spark, sf_dir):
    a = F.col("start") + F.col("ord") * 7919 % 1000000 - 500000
    rows = intervals(spark, sf_dir).select("key", "ord", sc.clamp_speech(a, F.col("end"), F.col("start"), 250000, 150000, 50000).alias("t"))
    return rows.select("key", "ord", "t.start", "t.end")


@query(
    "r12_line_slots",
    f"""WITH {DIALOGUE_SQL}, t AS (SELECT *, coalesce(lead(s) OVER (PARTITION BY conv_id ORDER BY ord), 100000) AS ns FROM dl) SELECT conv_id, ord, greatest(3, least(greatest(5, e - s), greatest(3, ns - s - 8))) AS slot FROM t""",
)
def r12_line_slots(spark, sf_dir):
    return sc.slot(dialogue(spark, sf_dir), ["conv_id"], 8, 3, 5, F.lit(100000)).select("conv_id", "ord", "slot")


@query(
    "r13_r16_violations",
    f"""WITH {INTERVALS_SQL}, t AS (SELECT key, ord, s, e, s - (ord % 5) * {HOUR} AS anchor, lag(e) OVER (PARTITION BY key ORDER BY s, ord) AS pe FROM iv)
    SELECT key, ord, concat_ws(',', CASE WHEN s - pe < {HOUR} THEN 'gap' END, CASE WHEN s - anchor > {2 * HOUR} THEN 'lag' END, CASE WHEN e > 1706659200000000 THEN 'end' END) AS rules
    FROM t WHERE coalesce(s - pe < {HOUR}, false) OR s - anchor > {2 * HOUR} OR e > 1706659200000000""",
)
def r13_r16_violations(spark, sf_dir):
    rows = _clips(spark, sf_dir).withColumn("anchor", F.col("start") - F.col("ord") % 5 * HOUR)
    out = sc.schedule_violations(rows, ["key"], HOUR, 2 * HOUR, F.lit(1706659200000000), "n")
    return out.select("key", "ord", F.array_join("rules", ",").alias("rules"))


@query(
    "r18_shift_timeline",
    f'WITH {DIALOGUE_SQL} SELECT conv_id, ord, greatest(0, s - 70) AS start, greatest(0, s - 70) + greatest(1, e - s) AS "end" FROM dl',
)
def r18_shift_timeline(spark, sf_dir):
    start = F.greatest(F.lit(0), F.col("start") - 70)
    return dialogue(spark, sf_dir).select("conv_id", "ord", start.alias("start"), (start + F.greatest(F.lit(1), F.col("end") - F.col("start"))).alias("end"))


@query("r19_global_timeline", 'SELECT doc_id, CAST(coalesce(sum(n_chars) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset" FROM documents')
def r19_global_timeline(spark, sf_dir):
    return sc.global_timeline(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id", "n_chars").select("doc_id", "offset")


@query(
    "r20_cliffhanger",
    f"""WITH {DIALOGUE_SQL}, c AS (SELECT conv_id, ord FROM dl WHERE e BETWEEN 300 AND 900), k AS (SELECT conv_id, coalesce(max(CASE WHEN ord = conv_id % 7 THEN ord END), max(ord)) AS last FROM c GROUP BY conv_id)
    SELECT dl.conv_id, dl.ord FROM dl LEFT JOIN k ON k.conv_id = dl.conv_id WHERE k.last IS NULL OR dl.ord <= k.last""",
)
def r20_cliffhanger(spark, sf_dir):
    rows = dialogue(spark, sf_dir)
    wanted = F.max(F.when(F.col("ord") == F.col("conv_id") % 7, F.col("ord")))
    k = rows.where("end between 300 and 900").groupBy("conv_id").agg(F.coalesce(wanted, F.max("ord")).alias("last"))
    return rows.join(k, "conv_id", "left").where("last is null or ord <= last").select("conv_id", "ord")


def _voice(spark, sf_dir):
    rows = _clips(spark, sf_dir)
    first = F.min("start").over(Window.partitionBy("key"))
    return rows.select("key", "ord", ((F.col("start") - first) / 1e6).alias("anchor"), ((F.col("end") - F.col("start")) / 1e6).alias("duration"), F.lit(1e9).alias("limit"))


_SLOT = "ord long, start double, end double, lag double"
_VOICE = _CLIPS + """, v AS (SELECT key, ord, n, (start - min(start) OVER (PARTITION BY key)) / 1e6 AS anchor, (e - start) / 1e6 AS duration, lead(start) OVER (PARTITION BY key ORDER BY n) - min(start) OVER (PARTITION BY key) AS nxt FROM c)"""


def _micro(rows, *columns):
    """Seconds as whole microseconds, so that results compare exactly."""
    return rows.select(*[c for c in rows.columns if c not in columns], *[F.round(F.col(c) * 1e6).cast("bigint").alias(c) for c in columns])


def _next_ms(at: str) -> str:
    return f"ceil(({at} - 1e-9) * 1000) / 1000"


@query(
    "r04_fixed_milliseconds",
    _VOICE + f""", q AS (SELECT key, ord, n, anchor, {_next_ms("anchor")} AS b, {_next_ms("anchor")} + duration AS f FROM v WHERE n = 0
      UNION ALL SELECT v.key, v.ord, v.n, v.anchor, {_next_ms("greatest(v.anchor, f + 0.08)")}, {_next_ms("greatest(v.anchor, f + 0.08)")} + v.duration FROM q JOIN v ON v.key = q.key AND v.n = q.n + 1)
    SELECT key, ord, CAST(round(b * 1e6) AS BIGINT) AS start, CAST(round(f * 1e6) AS BIGINT) AS "end", CAST(round(greatest(0, b - anchor) * 1e6) AS BIGINT) AS lag FROM q""",
)
def r04_fixed_milliseconds(spark, sf_dir):
    return _micro(folds.fold_per_key(_voice(spark, sf_dir), ["key"], folds.fixed_rate, _SLOT, ["anchor", "ord"]), "start", "end", "lag")


#: A clip's room up to the next anchor, and the speed that its room asks for.
_ROOM = "(coalesce(least(1e9, v.nxt / 1e6), 1e9) - {b} - 0.05)"
_SPEED = f"CASE WHEN v.duration <= greatest(0.05, {_ROOM}) THEN 1.0 ELSE least(CASE WHEN {_ROOM} <= 0 OR v.duration / {_ROOM} > 1.6 + 1e-9 THEN 2.0 ELSE 1.6 END, v.duration / greatest(0.05, {_ROOM})) END"


@query(
    "r05_r06_cascade",
    _VOICE + f""", q AS (SELECT v.key, v.ord, v.n, v.anchor, {_next_ms("v.anchor")} AS b, {_SPEED.format(b=_next_ms("v.anchor"))} AS speed, {_next_ms("v.anchor")} + v.duration / {_SPEED.format(b=_next_ms("v.anchor"))} AS f FROM v WHERE n = 0
      UNION ALL SELECT v.key, v.ord, v.n, v.anchor, {_next_ms("greatest(v.anchor, f + 0.03)")}, {_SPEED.format(b=_next_ms("greatest(v.anchor, f + 0.03)"))},
        {_next_ms("greatest(v.anchor, f + 0.03)")} + v.duration / {_SPEED.format(b=_next_ms("greatest(v.anchor, f + 0.03)"))} FROM q JOIN v ON v.key = q.key AND v.n = q.n + 1)
    SELECT key, ord, CAST(round(b * 1e6) AS BIGINT) AS start, CAST(round(f * 1e6) AS BIGINT) AS "end", CAST(round(greatest(0, b - anchor) * 1e6) AS BIGINT) AS lag, CAST(round(speed * 1e6) AS BIGINT) AS speed FROM q""",
)
def r05_r06_cascade(spark, sf_dir):
    out = folds.fold_per_key(_voice(spark, sf_dir), ["key"], lambda rows: folds.cascade(rows, 1e9, 1.6, 2.0), _SLOT + ", speed double", ["anchor", "ord"])
    return _micro(out, "start", "end", "lag", "speed")


@query("r08_merge_groups")
def r08_merge_groups(spark, sf_dir):
    def fold(rows):
        return [{"group": g, "first": rows[m[0]]["ord"], "members": len(m)} for g, m in enumerate(folds.merge_groups(rows, 1.0))]

    return folds.fold_per_key(_voice(spark, sf_dir), ["key"], fold, "group long, first long, members long", ["anchor", "ord"])


@query("st01_d08_observations")
def st01_d08_observations(spark, sf_dir):
    """Turns as what was read at sample times; every fourth sample is empty."""
    rows = dialogue(spark, sf_dir).select("conv_id", (F.col("ord") * 0.25).alias("t"), "ord", F.when(F.col("ord") % 4 != 3, F.col("text")).otherwise("").alias("text"))
    return folds.fold_per_key(rows, ["conv_id"], lambda r: folds.observations_to_cues(r, 0.25), "start double, end double, text string", ["ord"])
