"""Composite queries: cover events, refinement, recovery and the remaining rules."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lapwing.datasets import BOXES_SQL, DIALOGUE_SQL, INTERVALS_SQL, boxes, dialogue, intervals, table
from lapwing.functions import hashing as hs
from lapwing.functions import text as tx
from lapwing.functions.geometry import Box
from lapwing.operators import constraints as cs
from lapwing.operators import cover, folds, timeline
from lapwing.operators import intervals as iv
from lapwing.operators import joins as jn
from lapwing.operators import reports as rp
from lapwing.plans.interval_queries import DAY, HOUR, _islands_sql
from lapwing.plans.join_queries import _CC, _REACH, _cues_clusters
from lapwing.registry import query


@query(
    "f02_confirm_detections",
    f"""WITH {BOXES_SQL}, d AS (SELECT *, CASE WHEN ord % 2 = 0 THEN 'a' ELSE 'b' END AS det, score / 10.0 AS sc, ord % 3 <> 0 AS cjk, (x1 + x2) / 2.0 / 1280 BETWEEN 0.15 AND 0.85 AND (y1 + y2) / 2.0 / 720 BETWEEN 0.55 AND 0.90 AS band, y2 - y1 AS h, x2 - x1 AS w FROM bx),
    o AS (SELECT *, CASE WHEN band THEN CASE WHEN h < 25.0 * 720 / 1024 THEN 'height_lt_sub_min' WHEN h > 100.0 * 720 / 1024 THEN 'height_gt_sub_max' WHEN w / greatest(1.0, CAST(h AS DOUBLE)) < 1.2 THEN 'aspect_lt_sub_min' ELSE '' END
      WHEN det = 'a' THEN CASE WHEN sc < 0.3 THEN 'score' WHEN NOT cjk THEN 'script' ELSE '' END END AS reason FROM d),
    k AS (SELECT * FROM o WHERE det = 'a' AND NOT band AND reason = ''),
    i AS (SELECT p.frame, p.ord, max(greatest(0, least(p.x2, k.x2) - greatest(p.x1, k.x1)) * greatest(0, least(p.y2, k.y2) - greatest(p.y1, k.y1)) * 1.0 / ((p.x2 - p.x1) * (p.y2 - p.y1) + (k.x2 - k.x1) * (k.y2 - k.y1)
       - greatest(0, least(p.x2, k.x2) - greatest(p.x1, k.x1)) * greatest(0, least(p.y2, k.y2) - greatest(p.y1, k.y1)))) AS best FROM o p JOIN k ON k.frame = p.frame WHERE p.det = 'b' AND NOT p.band GROUP BY p.frame, p.ord)
    SELECT o.frame, o.ord, coalesce(o.reason, CASE WHEN coalesce(best, 0) >= 0.5 THEN '' ELSE 'unconfirmed' END) AS reason FROM o LEFT JOIN i ON i.frame = o.frame AND i.ord = o.ord""",
)
def f02_confirm_detections(spark, sf_dir):
    b = boxes(spark, sf_dir).withColumns({"detector": F.when(F.col("ord") % 2 == 0, "a").otherwise("b"), "score": F.col("score") / 10.0, "cjk": F.col("ord") % 3 != 0})
    return cover.confirm_detections(b, ["frame"], "a", "b", 1280, 720).select("frame", "ord", "reason")


@query(
    "f05_f14_f16_clipped_clusters",
    _CC + f", d AS (SELECT key, min(s) + {9 * DAY} AS d FROM iv GROUP BY key) SELECT cl.key, idx, s AS start, least(e, d) AS \"end\" FROM cl JOIN d ON d.key = cl.key WHERE least(e, d) - s > 50000",
)
def f05_f14_f16_clipped_clusters(spark, sf_dir):
    _, clusters = _cues_clusters(spark, sf_dir)
    d = intervals(spark, sf_dir).groupBy("key").agg((F.min("start") + 9 * DAY).alias("d"))
    rows = clusters.join(d, "key").withColumn("end", F.least("end", "d"))
    return rows.where("end - start > 50000").select("key", F.col("index").alias("idx"), "start", "end")


@query("f11_first_bad_span", f"WITH {INTERVALS_SQL} SELECT key, min(CASE WHEN e - s < {HOUR // 60} THEN ord END) IS NULL AS valid, coalesce(min(CASE WHEN e - s < {HOUR // 60} THEN ord END), -1) AS first_bad FROM iv GROUP BY key")
def f11_first_bad_span(spark, sf_dir):
    bad = F.min(F.when(F.col("end") - F.col("start") < HOUR // 60, F.col("ord")))
    return intervals(spark, sf_dir).groupBy("key").agg(bad.isNull().alias("valid"), F.coalesce(bad, F.lit(-1)).alias("first_bad"))


@query("f12_f19_item_urls", "SELECT page_id, CASE WHEN regexp_matches(url, '^https?://') THEN url ELSE '' END AS url, page_id % 2 = 0 AS refresh FROM pages")
def f12_f19_item_urls(spark, sf_dir):
    """Items that are an address or an object with one."""
    item = F.when(F.col("page_id") % 2 == 0, F.to_json(F.struct(F.col("url").alias("url"), F.lit(True).alias("force_refresh")))).otherwise(F.to_json(F.struct(F.col("url").alias("plain"))))
    v = F.parse_json(item)
    rows = table(spark, sf_dir, "pages").select("page_id", v.alias("v"))
    url = F.coalesce(F.try_variant_get("v", "$.url", "string"), F.try_variant_get("v", "$.plain", "string"))
    return rows.select("page_id", F.when(url.rlike("^https?://"), url).otherwise("").alias("url"), F.coalesce(F.try_variant_get("v", "$.force_refresh", "boolean"), F.lit(False)).alias("refresh"))


@query("f15_typed_detections", "SELECT event_id, TRY_CAST(CASE WHEN event_id % 7 = 0 THEN 'x' ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS score FROM events WHERE TRY_CAST(CASE WHEN event_id % 7 = 0 THEN 'x' ELSE CAST(value AS VARCHAR) END AS DOUBLE) IS NOT NULL")
def f15_typed_detections(spark, sf_dir):
    raw = F.when(F.col("event_id") % 7 == 0, "x").otherwise(F.col("value").cast("string"))
    return table(spark, sf_dir, "events").select("event_id", raw.try_cast("double").alias("score")).where("score is not null")


@query("f18_full_detection", "SELECT event_type, count(*) = count(DISTINCT event_id) AND min(value) > 0 AS full_run FROM events GROUP BY event_type")
def f18_full_detection(spark, sf_dir):
    full = (F.count(F.lit(1)) == F.count_distinct("event_id")) & (F.min("value") > 0)
    return table(spark, sf_dir, "events").groupBy("event_type").agg(full.alias("full_run"))


@query(
    "i25_i26_segment_clusters",
    f"""WITH {INTERVALS_SQL}, sp AS (SELECT key, s - 1704000000000000 AS s, e - 1704000000000000 AS e FROM iv WHERE kind = 'view'), {_islands_sql('sp', 'm', HOUR)},
    p AS (SELECT key, members, greatest(0, s - {HOUR // 4}) AS s, e + {HOUR // 4} AS e FROM m)
    SELECT key, members, s AS start, e AS "end", CASE WHEN e - s < {6 * HOUR} THEN greatest(0, CAST(floor((s + e - {6 * HOUR}) / 2.0) AS BIGINT)) ELSE s END AS context_start,
      CASE WHEN e - s < {6 * HOUR} THEN CAST(floor((s + e + {6 * HOUR}) / 2.0) AS BIGINT) ELSE e END AS context_end FROM p""",
)
def i25_i26_segment_clusters(spark, sf_dir):
    rows = intervals(spark, sf_dir).where("kind = 'view'")
    base = 1704000000000000
    rows = rows.select("key", (F.col("start") - base).alias("start"), (F.col("end") - base).alias("end"), *[(F.col("ord") % k).cast("int").alias(c) for c, k in (("x1", 90), ("y1", 70))])
    rows = rows.withColumns({"x2": F.col("x1") + 20, "y2": F.col("y1") + 10})
    out = cover.segment_clusters(rows, ["key"], HOUR, HOUR // 4, 6 * HOUR, F.lit(1 << 60))
    return out.select("key", "members", "start", "end", "context_start", "context_end")


@query(
    "i19_segment_boundaries",
    f"""WITH RECURSIVE {DIALOGUE_SQL}, l AS (SELECT conv_id, s * 100 AS s, e * 100 AS e, row_number() OVER (PARTITION BY conv_id ORDER BY s, e) - 1 AS n, max(e * 100) OVER (PARTITION BY conv_id) AS d FROM dl),
    o AS (SELECT a.conv_id, a.n // 3 AS j, a.d, (b.e + a.s) // 2 AS middle FROM l a JOIN l b ON b.conv_id = a.conv_id AND b.n = a.n - 1 WHERE a.n % 3 = 0),
    q AS (SELECT DISTINCT conv_id, 0 AS j, 0 AS x, true AS kept, d FROM l
      UNION ALL SELECT o.conv_id, o.j, CASE WHEN least(o.d, greatest(q.x + 50, middle)) < o.d - 50 THEN least(o.d, greatest(q.x + 50, middle)) ELSE q.x END, least(o.d, greatest(q.x + 50, middle)) < o.d - 50, o.d FROM q JOIN o ON o.conv_id = q.conv_id AND o.j = q.j + 1),
    c AS (SELECT conv_id, x, lead(x, 1, d) OVER (PARTITION BY conv_id ORDER BY j) AS y FROM q WHERE kept)
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY x) - 1 AS segment, x AS start, y AS "end" FROM c WHERE y > x + 10""",
)
def i19_segment_boundaries(spark, sf_dir):
    """In whole milliseconds."""

    def fold(rows):
        cuts = folds.segment_boundaries(rows, max(r["end"] for r in rows), 3)
        return [{"segment": k, "start": round(a * 1000), "end": round(b * 1000)} for k, (a, b) in enumerate(cuts)]

    rows = dialogue(spark, sf_dir).select("conv_id", "ord", (F.col("start") / 10).alias("start"), (F.col("end") / 10).alias("end"))
    return folds.fold_per_key(rows, ["conv_id"], fold, "segment long, start long, end long", ["ord"])


@query(
    "i30_free_times",
    f"""WITH {INTERVALS_SQL}, b AS (SELECT key, min(s) AS lo, max(e) AS hi FROM iv GROUP BY key), p AS (SELECT key, i, CAST(trunc(lo + (hi - lo) * i / 12.0) AS BIGINT) AS t FROM b, range(1, 12) r(i)),
    f AS (SELECT * FROM p WHERE NOT EXISTS (SELECT 1 FROM iv WHERE iv.key = p.key AND s <= t AND e >= t)), a AS (SELECT key, min(t) AS one FROM f GROUP BY key)
    SELECT key, one AS "at" FROM a UNION ALL SELECT f.key, min(t) FROM f JOIN a ON a.key = f.key WHERE t - one > {DAY} GROUP BY f.key""",
)
def i30_free_times(spark, sf_dir):
    """Candidate times in no interval, spaced, the first two of each key."""
    rows = intervals(spark, sf_dir)
    span = rows.groupBy("key").agg(F.min("start").alias("lo"), F.max("end").alias("hi"))
    points = span.select("key", F.posexplode(F.transform(F.sequence(F.lit(1), F.lit(11)), lambda i: (F.col("lo") + (F.col("hi") - F.col("lo")) * i / 12).cast("bigint"))).alias("ord", "at"))
    p = points.withColumns({"start": F.col("at"), "end": F.col("at")})
    hit = iv.bucketed_pairs(p, rows.select("key", "start", "end"), ["key"], DAY).select("key", "ord").distinct()
    free = p.join(hit, ["key", "ord"], "left_anti").select("key", "ord", "at")
    return folds.fold_per_key(free, ["key"], lambda r: [{"at": t} for t in folds.spaced([x["at"] for x in r], DAY, 2)], "at long", ["ord"])


@query(
    "i34_i37_accepted_lines",
    f"""WITH {INTERVALS_SQL}, r AS (SELECT key, s, max(e) OVER (PARTITION BY key ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM iv WHERE kind = 'view'),
    g AS (SELECT key, reach AS a, s AS b FROM r WHERE s - reach > {DAY}) SELECT c.key, c.ord, greatest(c.s, a) AS start, least(c.e, b) AS "end" FROM iv c JOIN g ON g.key = c.key WHERE c.kind = 'click' AND c.s + c.e > 2 * a AND c.s + c.e < 2 * b""",
)
def i34_i37_accepted_lines(spark, sf_dir):
    rows = intervals(spark, sf_dir).select("key", "ord", "kind", "start", "end")
    view, click = rows.where("kind = 'view'"), rows.where("kind = 'click'")
    return cover.recover_gaps(view, [(click, DAY)], ["key"]).where("kind = 'click'").select("key", "ord", "start", "end")


_RECOVER_SQL = """{src}_r AS (SELECT key, s, max(e) OVER (PARTITION BY key ORDER BY s, e, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {src}),
    {src}_g AS (SELECT key, reach AS a, s AS b FROM {src}_r WHERE s - reach > {least}),
    {out}_all AS (SELECT key, ord, s, e FROM {src} UNION ALL SELECT c.key, c.ord, greatest(c.s, a), least(c.e, b) FROM iv c JOIN {src}_g g ON g.key = c.key WHERE c.kind = '{kind}' AND c.s + c.e > 2 * a AND c.s + c.e < 2 * b),
    {out}_m AS (SELECT *, lag(s) OVER (PARTITION BY key ORDER BY s, e, ord) AS ps, lag(e) OVER (PARTITION BY key ORDER BY s, e, ord) AS pe FROM {out}_all),
    {out} AS (SELECT key, ord, s, e FROM {out}_m WHERE ps IS NULL OR s <> ps OR e <> pe)"""


@query(
    "i38_recover_twice",
    f"""WITH {INTERVALS_SQL}, l0 AS (SELECT key, ord, s, e FROM iv WHERE kind = 'view'), {_RECOVER_SQL.format(src="l0", out="l1", kind="click", least=DAY)},
    {_RECOVER_SQL.format(src="l1", out="l2", kind="signup", least=2 * DAY)} SELECT key, ord, s AS start, e AS "end" FROM l2""",
)
def i38_recover_twice(spark, sf_dir):
    """Two readers; after each, lines of one and the same time are one."""
    rows = intervals(spark, sf_dir).select("key", "ord", "kind", "start", "end")
    pick = lambda k: rows.where(F.col("kind") == k).drop("kind")
    before = Window.partitionBy("key").orderBy("start", "end", "ord")

    def merge(lines):
        told = lines.withColumns({"_s": F.lag("start").over(before), "_e": F.lag("end").over(before)})
        return told.where("_s is null or start <> _s or end <> _e").drop("_s", "_e")

    return cover.recover_gaps(pick("view"), [(pick("click"), DAY), (pick("signup"), 2 * DAY)], ["key"], merge)


@query(
    "i36_cluster_centers",
    f"""WITH {BOXES_SQL} SELECT frame, min(ord) AS first_ord, (min(x1) + max(x2)) / 2.0 / 1280 AS center_x, (min(y1) + max(y2)) / 2.0 / 720 AS center_y FROM bx GROUP BY frame""",
)
def i36_cluster_centers(spark, sf_dir):
    mid = lambda a, b, n: ((F.min(a) + F.max(b)) / 2.0 / n)
    return boxes(spark, sf_dir).groupBy("frame").agg(F.min("ord").alias("first_ord"), mid("x1", "x2", 1280).alias("center_x"), mid("y1", "y2", 720).alias("center_y"))


@query(
    "j12_i39_prefer_visual",
    f"""WITH {INTERVALS_SQL}, l AS (SELECT * FROM iv WHERE kind = 'click'), v AS (SELECT * FROM iv WHERE kind = 'view'),
    c AS (SELECT DISTINCT l.key, l.ord FROM l JOIN v ON v.key = l.key WHERE (least(l.e, v.e) > greatest(l.s, v.s) AND (least(l.e, v.e) - greatest(l.s, v.s)) >= 0.35 * least(l.e - l.s, v.e - v.s))
      OR l.s + l.e BETWEEN 2 * (v.s - {HOUR}) AND 2 * (v.e + {HOUR}) OR v.s + v.e BETWEEN 2 * (l.s - {HOUR}) AND 2 * (l.e + {HOUR})),
    b AS (SELECT l.*, (SELECT max(v.e) FROM v WHERE v.key = l.key AND v.e <= l.s) AS before, (SELECT min(v.s) FROM v WHERE v.key = l.key AND v.s >= l.e) AS after FROM l WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.key = l.key AND c.ord = l.ord))
    SELECT key, ord, s AS start, e AS "end", 'kept' AS origin FROM b WHERE NOT coalesce(s - before <= 3 * {HOUR} AND after - e <= 3 * {HOUR}, false) UNION ALL SELECT key, ord, s, e, 'visual' FROM v""",
)
def j12_i39_prefer_visual(spark, sf_dir):
    rows = intervals(spark, sf_dir).select("key", "ord", "kind", "start", "end")
    return cover.prefer_visual(rows.where("kind = 'click'"), rows.where("kind = 'view'"), ["key"], DAY, HOUR).select("key", "ord", "start", "end", "origin")


@query(
    "i40_refined_lines",
    f"""WITH {DIALOGUE_SQL}, f AS (SELECT conv_id, ord AS of, ord * 10 AS ord, s, s + (e - s) // 2 AS e FROM dl WHERE ord % 2 = 0), l AS (SELECT conv_id, ord, s, e FROM dl)
    SELECT conv_id, ord, s AS start, e AS "end" FROM l WHERE NOT (e - s > 60 AND ord % 2 = 0) UNION ALL SELECT f.conv_id, f.ord, f.s, f.e FROM f JOIN l ON l.conv_id = f.conv_id AND l.ord = f.of WHERE l.e - l.s > 60""",
)
def i40_refined_lines(spark, sf_dir):
    lines = dialogue(spark, sf_dir).select("conv_id", "ord", "start", "end")
    fresh = lines.where("ord % 2 = 0").select("conv_id", F.col("ord").alias("of"), (F.col("ord") * 10).alias("ord"), "start", F.expr("start + (end - start) div 2").alias("end"))
    return cover.replace_where_refined(lines, fresh, ["conv_id"], 60)


@query("j05_cover_events")
def j05_cover_events(spark, sf_dir):
    cues, clusters = _cues_clusters(spark, sf_dir)
    return cover.cover_events(cues, clusters, ["key"], DAY, _REACH, HOUR).select("key", "event", "index", "cue", "start", "end")


@query(
    "j08_unique_timings",
    f"""WITH {DIALOGUE_SQL}, t AS (SELECT conv_id, ord // 2 AS cue, count(*) AS n, min(s) AS s FROM dl GROUP BY conv_id, ord // 2) SELECT conv_id, cue, CASE WHEN n > 1 THEN 'duplicate' ELSE '' END AS problem, s AS start FROM t""",
)
def j08_unique_timings(spark, sf_dir):
    t = dialogue(spark, sf_dir).groupBy("conv_id", F.expr("ord div 2").alias("cue")).agg(F.count(F.lit(1)).alias("n"), F.min("start").alias("start"))
    return t.select("conv_id", "cue", F.when(F.col("n") > 1, "duplicate").otherwise("").alias("problem"), "start")


@query("j24_h14_sources", "SELECT page_id, left(sha256(url || chr(10) || 'v2'), 32) AS key, 'gs://out/processed/' || lpad(CAST(page_id AS VARCHAR), 5, '0') || '/final' AS base FROM pages")
def j24_h14_sources(spark, sf_dir):
    base = F.concat(F.lit("gs://out/processed/"), F.lpad(F.col("page_id").cast("string"), 5, "0"), F.lit("/final"))
    return table(spark, sf_dir, "pages").select("page_id", hs.cache_key(F.col("url"), F.lit("v2")).alias("key"), base.alias("base"))


@query("j26_r17_positional", f'WITH {DIALOGUE_SQL}, a AS (SELECT conv_id, ord, text FROM dl), b AS (SELECT conv_id, ord, s * 2 AS s, e * 2 AS e FROM dl) SELECT a.conv_id, a.ord, text, s AS start, e AS "end" FROM a JOIN b ON b.conv_id = a.conv_id AND b.ord = a.ord')
def j26_r17_positional(spark, sf_dir):
    rows = dialogue(spark, sf_dir)
    timing = rows.select("conv_id", "ord", (F.col("start") * 2).alias("start"), (F.col("end") * 2).alias("end"))
    return rows.select("conv_id", "ord", "text").join(timing, ["conv_id", "ord"])


@query("d05_splice_windows")
def d05_splice_windows(spark, sf_dir):
    def fold(rows):
        fresh = [{**r, "start": r["start"] + 0.01} for r in rows]
        middle = (rows[len(rows) // 3]["start"], rows[len(rows) // 2]["end"])
        out = folds.splice_windows(rows, fresh, [middle], lambda r: tx.cue_key(r["text"]))
        return [{"ord": r["ord"], "start": r["start"], "end": r["end"]} for r in out]

    rows = dialogue(spark, sf_dir).select("conv_id", "ord", "text", (F.col("start") / 1).alias("start"), (F.col("end") / 1).alias("end"))
    return folds.fold_per_key(rows, ["conv_id"], fold, "ord long, start double, end double", ["ord"])


def _seen(spark, sf_dir):
    """Turns read three times each as text at sample times."""
    rows = dialogue(spark, sf_dir).select("conv_id", "ord", "text", (F.col("start") / 100).alias("start"), (F.col("end") / 100).alias("end"))
    return rows.withColumn("samples", F.transform(F.sequence(F.lit(1), F.lit(3)), lambda i: F.struct((F.col("start") + (F.col("end") - F.col("start")) * i / 4).alias("t"), F.col("text").alias("text"))))


@query("c07_refine_cues")
def c07_refine_cues(spark, sf_dir):
    def fold(rows):
        zh = lambda t: "".join(chr(0x4E00 + ord(c)) for c in t)
        samples = [{"t": s["t"], "text": zh(s["text"])} for r in rows for s in r["samples"]]
        cues = [{"ord": r["ord"], "text": zh(r["text"]), "start": r["start"] + 0.3, "end": r["end"] + 0.3} for r in rows]
        return folds.refine_with_samples(cues, samples, 0.25, max(r["end"] for r in rows))

    return folds.fold_per_key(_seen(spark, sf_dir), ["conv_id"], fold, "ord long, start double, end double, samples long", ["ord"])


@query("c08_snap_boundaries")
def c08_snap_boundaries(spark, sf_dir):
    def fold(rows):
        seen = [{"t": s["t"], "text": s["text"]} for r in rows for s in r["samples"]]
        return [{"ord": r["ord"], "start": r["start"], "end": r["end"]} for r in folds.snap_boundaries(rows, seen)]

    return folds.fold_per_key(_seen(spark, sf_dir), ["conv_id"], fold, "ord long, start double, end double", ["ord"])


def _track_pool(spark, sf_dir):
    """Boxes of a video, each with a text; one event a video, and its pool."""
    b = boxes(spark, sf_dir).select(F.expr("frame div 16").alias("video"), (F.col("frame") % 16).alias("at"), "ord", "x1", "y1", "x2", "y2")
    b = b.withColumn("text", F.concat(F.lit("t"), (F.col("x1") % 5).cast("string")))
    video = b.select("video").distinct()
    events = video.select("video", F.lit(0).alias("index"), (F.col("video") % 16).alias("start"), (F.col("video") % 16).alias("end"))
    return timeline.event_pool(events, b, ["video"], 16, 2)


@query(
    "c05_event_pool",
    f"""WITH {BOXES_SQL}, b AS (SELECT frame // 16 AS video, frame % 16 AS t, ord FROM bx),
    k AS (SELECT video, t, ord, CASE WHEN t = video % 16 THEN 0 WHEN abs(t - video % 16) <= 2 THEN 1 ELSE 2 END AS far FROM b),
    m AS (SELECT *, min(far) OVER (PARTITION BY video) AS nearest FROM k) SELECT video, t AS "at", ord FROM m WHERE far = nearest""",
)
def c05_event_pool(spark, sf_dir):
    return _track_pool(spark, sf_dir).select("video", F.col("r_at").alias("at"), F.col("r_ord").alias("ord"))


@query("c04_c05_detection_tracks")
def c04_c05_detection_tracks(spark, sf_dir):
    """Tracks among the pool of a video's event, and the one that shows its text."""

    def fold(rows):
        tracks = folds.detection_tracks([{**r, "t": r["at"] / 8.0} for r in rows], 30.0)
        return [{k: r[k] for k in ("ord", "text", "x1", "y1", "x2", "y2")} | {"track": n} for n, t in enumerate(tracks) for r in t]

    pool = _track_pool(spark, sf_dir)
    pool = pool.select("video", *[F.col(f"r_{c}").alias(c) for c in ("at", "ord", "text", "x1", "y1", "x2", "y2")])
    tracked = folds.fold_per_key(pool, ["video"], fold, "ord long, text string, x1 int, y1 int, x2 int, y2 int, track int", ["at", "ord"])
    return timeline.best_track(tracked, ["video"], "track", tx.text_similarity(F.lit("t3"), F.col("text")), (640.0, 500.0, 200.0, 60.0))


@query(
    "c11_rebase_timeline",
    f"""WITH {DIALOGUE_SQL}, t AS (SELECT conv_id, ord, trim(text, ' ') AS text, s / 10.0 AS s0, e / 10.0 AS e0 FROM dl),
    l AS (SELECT conv_id, ord, text, s0 AS s, greatest(e0, s0 + 0.5) AS e FROM t WHERE text <> ''),
    k AS (SELECT conv_id, min(s) AS a, max(s) AS b, max(e) AS c, count(*) AS n, sum(greatest(8, length(text))) AS w FROM l GROUP BY conv_id),
    h AS (SELECT *, CASE WHEN b < 40.5 AND c - a >= 6 AND c <= 42 THEN 'kept'
        WHEN greatest(0, b - 5) < 40.5 AND least(40, greatest(0.4, c - 5)) - greatest(0, a - 5) >= 6 THEN 'segment'
        WHEN b - a < 40.5 AND least(40, greatest(0.4, c - a)) >= 6 THEN 'first' ELSE 'shared' END AS how FROM k),
    p AS (SELECT l.*, h.a, h.how, greatest(0.7, greatest(1, 40 - 0.18 * (n - 1)) * greatest(8, length(text)) / w) AS d, row_number() OVER (PARTITION BY l.conv_id ORDER BY s DESC, ord DESC) AS back FROM l JOIN h ON h.conv_id = l.conv_id),
    q AS (SELECT *, least(40, coalesce(sum(d + 0.18) OVER (PARTITION BY conv_id ORDER BY s, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS x FROM p)
    SELECT conv_id, ord, how,
    CAST(round(1e6 * CASE how WHEN 'kept' THEN least(40, s) WHEN 'segment' THEN greatest(0, s - 5) WHEN 'first' THEN greatest(0, s - a) ELSE x END) AS BIGINT) AS start_us,
    CAST(round(1e6 * CASE how WHEN 'kept' THEN least(40, greatest(s + 0.4, e)) WHEN 'segment' THEN least(40, greatest(0.4, e - 5)) WHEN 'first' THEN least(40, greatest(0.4, e - a))
        ELSE least(40, greatest(x + 0.4, CASE WHEN back = 1 THEN 40 ELSE least(40, x + d) END)) END) AS BIGINT) AS end_us FROM q""",
)
def c11_rebase_timeline(spark, sf_dir):
    rows = dialogue(spark, sf_dir).select("conv_id", "ord", "text", (F.col("start") / 10).alias("start"), (F.col("end") / 10).alias("end"))
    us = lambda c: F.round(F.col(c) * 1e6).cast("bigint").alias(f"{c}_us")
    return timeline.rebase(rows, ["conv_id"], 5.0, 40.0).select("conv_id", "ord", "how", us("start"), us("end"))


@query(
    "r22_voice_slots",
    f"""WITH {DIALOGUE_SQL}, c AS (SELECT conv_id, ord, s * 1000 AS s, length(text) * 1100 AS d FROM dl),
    e AS (SELECT *, s + d AS f, max(s + d) OVER (PARTITION BY conv_id) * 995 // 1000 AS total, lead(s) OVER (PARTITION BY conv_id ORDER BY s, ord) AS nxt, row_number() OVER (PARTITION BY conv_id ORDER BY s + d DESC, s, ord) = 1 AS last FROM c),
    r AS (SELECT *, last AND f > total AS over, f - total > 5000 OR greatest(0, total - s) <= 0 OR d * 100 > greatest(0, total - s) * 102 AS wrong FROM e)
    SELECT conv_id, ord, CASE WHEN over AND NOT wrong THEN total ELSE f END AS "end", greatest(0, coalesce(f - nxt, 0)) AS spill, CASE WHEN over AND wrong THEN 'ends beyond the video' ELSE '' END AS error FROM r""",
)
def r22_voice_slots(spark, sf_dir):
    """In whole milliseconds, with a clip a little longer than its slot."""
    clips = dialogue(spark, sf_dir).select("conv_id", "ord", (F.col("start") * 1000).alias("start"), (F.length("text") * 1100).cast("bigint").alias("duration"))
    total = F.expr("max(start + duration) over (partition by conv_id) * 995 div 1000")
    out = timeline.voice_slots(clips, ["conv_id"], total, overflow=5000, speed=1.02)
    return out.select("conv_id", "ord", F.col("end").cast("bigint").alias("end"), F.col("spill").cast("bigint").alias("spill"), "error")


@query(
    "a06_a07_layout",
    f"""WITH {BOXES_SQL} SELECT frame, count(*) AS n, count(*) FILTER (WHERE x1 < 0 OR y1 < 0 OR x2 > 1280 OR y2 > 720) AS outside, count(*) FILTER (WHERE y1 < 300) AS above, count(*) FILTER (WHERE y1 >= 300 AND y2 <= 600) / CAST(count(*) AS DOUBLE) AS support FROM bx GROUP BY frame""",
)
def a06_a07_layout(spark, sf_dir):
    return cover.layout_audit(boxes(spark, sf_dir), ["frame"], 300, 600, 1280, 720)


@query("a10_nested_totals", "SELECT l_orderkey, CAST(sum(l_linenumber) AS BIGINT) AS total, count(*) AS parts, sum(l_linenumber) = count(*) * (count(*) + 1) // 2 AS complete FROM lineitem GROUP BY l_orderkey")
def a10_nested_totals(spark, sf_dir):
    nested = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_linenumber").alias("parts"))
    flat = nested.select("l_orderkey", F.explode("parts").alias("p")).groupBy("l_orderkey").agg(F.sum("p").alias("total"), F.count("p").alias("parts"))
    return flat.withColumn("complete", F.col("total") == F.expr("parts * (parts + 1) div 2"))


@query(
    "b20_anchored_text",
    f"""WITH {BOXES_SQL}, r AS (SELECT frame, min(y1) AS t, max(y2) AS b FROM bx WHERE score >= 5 GROUP BY frame)
    SELECT bx.frame, ord, CASE WHEN y2 < t - 26 OR y1 > b + 26 THEN CAST(round_even((t + b) / 2.0, 0) AS INT) ELSE y1 END AS y FROM bx JOIN r ON r.frame = bx.frame""",
)
def b20_anchored_text(spark, sf_dir):
    b = boxes(spark, sf_dir)
    r = b.where("score >= 5").groupBy("frame").agg(F.min("y1").alias("t"), F.max("y2").alias("b"))
    y = cover.anchor_text(F.col("y1"), F.col("y2"), F.col("y1"), F.col("t"), F.col("b"), 26)
    return b.join(r, "frame").select("frame", "ord", y.alias("y"))


@query(
    "b18_b25_cluster_union",
    f"""WITH {BOXES_SQL} SELECT frame, greatest(0, min(x1) - 12) AS x1, greatest(0, min(y1) - 6) AS y1, least(1280, max(x2) + 12) AS x2, least(720, max(y2) + 6) AS y2 FROM bx GROUP BY frame""",
)
def b18_b25_cluster_union(spark, sf_dir):
    from lapwing.functions.geometry import dilate

    u = boxes(spark, sf_dir).groupBy("frame").agg(F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"))
    return u.select("frame", dilate(Box(), 12, 6, 1280, 720).alias("d")).select("frame", "d.*")


@query("b15_b21_text_rects")
def b15_b21_text_rects(spark, sf_dir):
    """Rectangles of rendered text centred in the frame, joined with a box."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.explode(tx.balanced_lines(F.col("text"))).alias("line"))
    rows = rows.withColumn("u", tx.units("line")).groupBy("conv_id", "turn").agg(F.max("u").alias("u"), F.count(F.lit(1)).alias("n"))
    w, h = F.ceil(F.col("u") * 24) + 14, F.ceil(F.col("n") * 24 * 1.18) + 14
    x1, y1 = F.greatest(F.lit(0), F.floor((1280 - w) / 2)), F.greatest(F.lit(0), F.floor((1040 - h) / 2))
    return rows.select("conv_id", "turn", F.least(x1, F.lit(400)).alias("x1"), F.least(y1, F.lit(500)).alias("y1"), F.greatest(F.least(F.lit(1280), x1 + w), F.lit(880)).alias("x2"), F.greatest(F.least(F.lit(720), y1 + h), F.lit(540)).alias("y2"))


@query(
    "h10_h12_collection_root",
    """SELECT conv_id, bool_and(turn = place) AS contiguous, sha256('{"id":' || CAST(conv_id AS VARCHAR) || ',"members":[' || string_agg('{"h":"' || sha256(text) || '","i":' || CAST(turn AS VARCHAR) || '}', ',' ORDER BY turn) || ']}') AS root
    FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS place FROM conversations) GROUP BY conv_id""",
)
def h10_h12_collection_root(spark, sf_dir):
    """Ordered, contiguous members of each conversation and the root's digest."""
    item = F.struct(F.col("turn").alias("i"), F.sha2("text", 256).alias("h"))
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(item)).alias("m"))
    root = hs.canonical(F.to_json(F.struct(F.col("conv_id").alias("id"), F.col("m").alias("members"))))
    contiguous = F.forall(F.transform("m", lambda x, k: x["i"] == k), lambda b: b)
    return rows.select("conv_id", contiguous.alias("contiguous"), F.sha2(root, 256).alias("root"))


@query("n05_n07_n08_payloads", "SELECT event_id, CASE WHEN event_id % 4 = 3 THEN -1 ELSE event_id END AS id FROM events")
def n05_n07_n08_payloads(spark, sf_dir):
    """The first item of whichever known layout a payload has."""
    body = F.to_json(F.struct(F.col("event_id").alias("id")))
    i = F.col("event_id") % 4
    doc = F.when(i == 0, F.concat(F.lit('{"detail":'), body, F.lit("}"))).when(i == 1, F.concat(F.lit('{"item_list":['), body, F.lit("]}"))).when(i == 2, F.concat(F.lit('{"data":{"detail":'), body, F.lit("}}"))).otherwise(F.lit("{}"))
    v = table(spark, sf_dir, "events").select("event_id", F.parse_json(doc).alias("v"))
    paths = ["$.detail.id", "$.item_list[0].id", "$.data.detail.id", "$.data.item_list[0].id"]
    return v.select("event_id", F.coalesce(*[F.try_variant_get("v", p, "bigint") for p in paths], F.lit(-1)).alias("id"))


@query(
    "n11_width_markers",
    """WITH g AS (SELECT l_orderkey, l_linenumber, min(CAST(l_quantity AS INT)) AS a, max(CAST(l_quantity AS INT)) AS b FROM lineitem GROUP BY l_orderkey, l_linenumber)
    SELECT l_orderkey, count(*) AS marks, count(*) FILTER (WHERE a <> b) AS conflicts, max(l_linenumber) - count(*) AS missing FROM g GROUP BY l_orderkey""",
)
def n11_width_markers(spark, sf_dir):
    """Index and width out of numbers in a log; conflicts and gaps as problems."""
    log = F.concat(F.lit("[Eval @ 0x1] x="), (F.lit(1_000_000) + F.col("l_linenumber") * 10_000 + F.col("l_quantity").cast("int")).cast("string"), F.lit(" y=12"))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", F.explode(F.regexp_extract_all(log, F.lit(r"\d{7,}"), 0).cast("array<bigint>")).alias("v"))
    marks = rows.select("l_orderkey", F.expr("(v - 1000000) div 10000").alias("i"), F.expr("(v - 1000000) % 10000").alias("w"))
    g = marks.groupBy("l_orderkey", "i").agg(F.min("w").alias("a"), F.max("w").alias("b"))
    return g.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("marks"), F.count_if(F.col("a") != F.col("b")).alias("conflicts"), (F.max("i") - F.count(F.lit(1))).alias("missing"))


@query("n12_to_video", "SELECT event_id AS id, 'https://example.com/video/' || CAST(event_id AS VARCHAR) AS share_url, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS create_time FROM events")
def n12_to_video(spark, sf_dir):
    us = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.concat(F.lit("https://example.com/video/"), F.col("event_id").cast("string")).alias("share_url"), F.floor(us / 1000000).alias("create_time"))


@query("x04_nested_text")
def x04_nested_text(spark, sf_dir):
    """Normalised strings inside arrays and structs, shape kept."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", tx.normal_text(F.col("role")).alias("role"), tx.normal_text(F.col("text")).alias("text"))
    rows = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    return rows.select("conv_id", F.sha2(F.to_json("turns"), 256).alias("digest"))


@query(
    "x11_x13_hashtags",
    r"""WITH t AS (SELECT conv_id, turn, regexp_replace(strip_accents(replace(lower(translate(split_part(trim(regexp_replace(text, '\s+', ' ', 'g')), ' ', 1), 'Đđ', 'Dd')), 'ß', 'ss')), '[^A-Za-z0-9_]', '', 'g') AS plain FROM conversations)
    SELECT conv_id, turn, CASE WHEN plain <> '' THEN '#' || plain ELSE '' END AS tag FROM t""",
)
def x11_x13_hashtags(spark, sf_dir):
    """Hash tags without marks: the letters' base forms, a stroked d as d."""
    first = F.element_at(F.split(tx.squeeze(F.col("text")), " "), 1)
    plain = F.regexp_replace(tx.fold_text(F.translate(first, "Đđ", "Dd")), "[^A-Za-z0-9_]", "")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(plain != "", F.concat(F.lit("#"), plain)).otherwise("").alias("tag"))


@query("v12_taxonomy", "SELECT event_type, event_type IN ('view', 'click', 'purchase', 'signup', 'error') AS known, count(*) AS n FROM events GROUP BY event_type")
def v12_taxonomy(spark, sf_dir):
    known = F.array_contains(F.array(*[F.lit(x) for x in ("view", "click", "purchase", "signup", "error")]), F.col("event_type"))
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.bool_and(known).alias("known"), F.count(F.lit(1)).alias("n")).select("event_type", "known", "n")


@query(
    "v15_v22_forbidden_scan",
    """SELECT event_id, '$.a.token' AS path FROM events WHERE event_id % 3 = 0 UNION ALL SELECT event_id, '$.b[1]' FROM events WHERE event_id % 5 = 0""",
)
def v15_v22_forbidden_scan(spark, sf_dir):
    """Paths of forbidden keys and values anywhere in a document; every third event
    has such a key planted, every fifth such a value."""
    key = F.when(F.col("event_id") % 3 == 0, "token").otherwise("k")
    value = F.when(F.col("event_id") % 5 == 0, "Bearer abc").otherwise("plain")
    planted = F.concat(F.lit('{"a":{"'), key, F.lit('":'), F.col("props"), F.lit('},"b":["x","'), value, F.lit('"]}'))
    return cs.forbidden_nodes(table(spark, sf_dir, "events").select("event_id", planted.alias("doc")), "doc").select("event_id", "path")


@query("a16_strict_booleans", "SELECT event_id, event_id % 3 = 0 AS passed FROM events")
def a16_strict_booleans(spark, sf_dir):
    """Whether a verdict has exactly its fields, all true booleans, empty lists."""
    doc = F.when(F.col("event_id") % 3 == 0, F.lit('{"ok":true,"issues":[]}')).when(F.col("event_id") % 3 == 1, F.lit('{"ok":1,"issues":[]}')).otherwise(F.lit('{"ok":true,"issues":["x"]}'))
    v = table(spark, sf_dir, "events").select("event_id", F.parse_json(doc).alias("v"))
    kind = F.schema_of_variant("v")
    return v.select("event_id", ((kind == "OBJECT<issues: ARRAY<VOID>, ok: BOOLEAN>") & F.coalesce(F.try_variant_get("v", "$.ok", "boolean"), F.lit(False))).alias("passed"))
