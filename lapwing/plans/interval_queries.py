"""Interval queries over ``events`` (per user) and ``conversations``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwing.datasets import DIALOGUE_SQL, INTERVALS_SQL, dialogue, intervals
from lapwing.operators import intervals as iv
from lapwing.registry import query

TOLERANCE = 1_800_000_000
HOUR = 3_600_000_000
DAY = 24 * HOUR

#: Islands of intervals per key in SQL; ``src`` needs key, s, e.
ISLANDS = """
  {out} AS (
    SELECT key, min(s) AS s, max(e) AS e, count(*) AS members FROM (
      SELECT key, s, e, sum(opens) OVER (PARTITION BY key ORDER BY rn ROWS UNBOUNDED PRECEDING) AS island FROM (
        SELECT key, s, e, rn, CASE WHEN reach IS NULL OR s > reach + {tol} THEN 1 ELSE 0 END AS opens FROM (
          SELECT key, s, e, rn, max(e) OVER (PARTITION BY key ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
          FROM (SELECT key, s, e, row_number() OVER (PARTITION BY key ORDER BY s, e) AS rn FROM {src})))) GROUP BY key, island)"""


def _islands_sql(src: str, out: str, tol: int = 0) -> str:
    return ISLANDS.format(src=src, out=out, tol=tol)


def _bounds(rows: DataFrame) -> DataFrame:
    return rows.groupBy("key").agg((F.min("start") - HOUR).alias("lo"), (F.max("end") + HOUR).alias("hi"))


BOUNDS_SQL = f"bounds AS (SELECT key, min(s) - {HOUR} AS lo, max(e) + {HOUR} AS hi FROM iv GROUP BY key)"


@query("i03_islands", f"WITH {INTERVALS_SQL}, {_islands_sql('iv', 'm', TOLERANCE)} SELECT key, s AS start, e AS \"end\", members FROM m")
def i03_islands(spark, sf_dir):
    return iv.islands(intervals(spark, sf_dir), ["key"], tolerance=TOLERANCE).drop("island")


@query(
    "i01_overlap_ratio",
    f"""WITH {INTERVALS_SQL}, p AS (SELECT key, ord, s, e, lead(s) OVER w AS s2, lead(e) OVER w AS e2 FROM iv WINDOW w AS (PARTITION BY key ORDER BY s, ord))
    SELECT key, ord, CASE WHEN least(e, e2) - greatest(s, s2) > 0 AND least(e - s, e2 - s2) > 0
      THEN (least(e, e2) - greatest(s, s2)) / CAST(least(e - s, e2 - s2) AS DOUBLE) ELSE 0.0 END AS ratio,
      greatest(s2 - e, s - e2, 0) AS gap
    FROM p WHERE s2 IS NOT NULL""",
)
def i01_i02_neighbours(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("key").orderBy("start", "ord")
    rows = intervals(spark, sf_dir).withColumns({"s2": F.lead("start").over(w), "e2": F.lead("end").over(w)}).where("s2 is not null")
    s, e, s2, e2 = (F.col(c) for c in ("start", "end", "s2", "e2"))
    return rows.select("key", "ord", iv.overlap_ratio(s, e, s2, e2).alias("ratio"), iv.temporal_gap(s, e, s2, e2).alias("gap"))


@query(
    "i14_time_conflicts",
    f"""WITH {INTERVALS_SQL}, p AS (SELECT key, ord, s, e, lead(s) OVER w AS s2, lead(e) OVER w AS e2 FROM iv WINDOW w AS (PARTITION BY key ORDER BY s, ord))
    SELECT key, ord, (CASE WHEN least(e, e2) - greatest(s, s2) > 0 AND least(e - s, e2 - s2) > 0
        THEN (least(e, e2) - greatest(s, s2)) / CAST(least(e - s, e2 - s2) AS DOUBLE) ELSE 0.0 END >= 0.35)
      OR (s + e BETWEEN 2 * (s2 - {HOUR}) AND 2 * (e2 + {HOUR})) OR (s2 + e2 BETWEEN 2 * (s - {HOUR}) AND 2 * (e + {HOUR})) AS conflicts
    FROM p WHERE s2 IS NOT NULL""",
)
def i14_time_conflicts(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("key").orderBy("start", "ord")
    rows = intervals(spark, sf_dir).withColumns({"s2": F.lead("start").over(w), "e2": F.lead("end").over(w)}).where("s2 is not null")
    s, e, s2, e2 = (F.col(c) for c in ("start", "end", "s2", "e2"))
    return rows.select("key", "ord", iv.time_conflicts(s, e, s2, e2, HOUR).alias("conflicts"))


_COMPLEMENT = f"""WITH {INTERVALS_SQL}, {BOUNDS_SQL}, full_iv AS (SELECT key, s, e FROM iv WHERE e > s), {_islands_sql('full_iv', 'm')},
    edges AS (SELECT key, s, e FROM m UNION ALL SELECT key, hi, hi FROM bounds),
    g AS (SELECT edges.key, coalesce(lag(e) OVER (PARTITION BY edges.key ORDER BY s, e), lo) AS gap_start, s AS gap_end
          FROM edges JOIN bounds ON edges.key = bounds.key)
    SELECT key, gap_start, gap_end FROM g WHERE gap_end - gap_start > {{least}}"""


@query("i05_keep_segments", _COMPLEMENT.format(least=1000))
def i05_keep_segments(spark, sf_dir):
    rows = intervals(spark, sf_dir)
    return iv.complement(rows, _bounds(rows), ["key"], least=1000)


@query(
    "i06_interval_complement",
    f"""WITH {INTERVALS_SQL}, bounds AS (SELECT key, min(s) + {DAY} AS lo, max(e) - {DAY} AS hi FROM iv GROUP BY key HAVING min(s) + {DAY} < max(e) - {DAY}),
    c AS (SELECT iv.key, greatest(s, lo) AS s, least(e, hi) AS e FROM iv JOIN bounds ON iv.key = bounds.key WHERE least(e, hi) > greatest(s, lo)),
    {_islands_sql('c', 'm')},
    edges AS (SELECT key, s, e FROM m UNION ALL SELECT key, hi, hi FROM bounds),
    g AS (SELECT edges.key, coalesce(lag(e) OVER (PARTITION BY edges.key ORDER BY s, e), lo) AS gap_start, s AS gap_end
          FROM edges JOIN bounds ON edges.key = bounds.key)
    SELECT key, gap_start, gap_end FROM g WHERE gap_end - gap_start > 0""",
)
def i06_interval_complement(spark, sf_dir):
    rows = intervals(spark, sf_dir)
    bounds = rows.groupBy("key").agg((F.min("start") + DAY).alias("lo"), (F.max("end") - DAY).alias("hi")).where("lo < hi")
    return iv.complement(rows, bounds, ["key"])


@query(
    "i10_gap_ranges",
    f"""WITH {INTERVALS_SQL}, r AS (SELECT key, s, max(e) OVER (PARTITION BY key ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM iv)
    SELECT key, reach AS gap_start, s AS gap_end FROM r WHERE s - reach > {DAY}""",
)
def i10_gap_ranges(spark, sf_dir):
    return iv.internal_gaps(intervals(spark, sf_dir), ["key"], least=DAY)


_CUTS = f"""WITH {INTERVALS_SQL}, craw AS (SELECT key, s, e FROM iv WHERE kind = 'purchase'), {_islands_sql('craw', 'cuts')},
    pts AS (SELECT key, ord, s, e FROM iv WHERE kind <> 'purchase')"""


def _cuts_and_lines(spark, sf_dir):
    rows = intervals(spark, sf_dir)
    return rows.where("kind = 'purchase'").select("key", "start", "end"), rows.where("kind <> 'purchase'").select("key", "ord", "start", "end")


@query(
    "i07_removed_before",
    _CUTS + """ SELECT pts.key, pts.ord, pts.s AS at, CAST(coalesce(sum(greatest(0, least(pts.s, cuts.e) - cuts.s)), 0) AS BIGINT) AS removed
    FROM pts LEFT JOIN cuts ON pts.key = cuts.key GROUP BY pts.key, pts.ord, pts.s""",
)
def i07_removed_before(spark, sf_dir):
    cuts, lines = _cuts_and_lines(spark, sf_dir)
    return iv.removed_before(lines.select("key", "ord", F.col("start").alias("at")), cuts, ["key"])


@query(
    "i08_shift_lines",
    _CUTS + """, moved AS (
      SELECT pts.key, pts.ord, pts.s, pts.e,
        coalesce(max(CASE WHEN cuts.s <= pts.s AND pts.s < cuts.e THEN cuts.e END), pts.s) AS ns,
        coalesce(min(CASE WHEN cuts.s < pts.e AND pts.e <= cuts.e THEN cuts.s END), pts.e) AS ne
      FROM pts LEFT JOIN cuts ON pts.key = cuts.key WHERE pts.e > pts.s GROUP BY pts.key, pts.ord, pts.s, pts.e),
    out AS (SELECT moved.key, ord, ns - CAST(coalesce(sum(greatest(0, least(ns, cuts.e) - cuts.s)), 0) AS BIGINT) AS a,
        ne - CAST(coalesce(sum(greatest(0, least(ne, cuts.e) - cuts.s)), 0) AS BIGINT) AS b
      FROM moved LEFT JOIN cuts ON moved.key = cuts.key WHERE ne > ns GROUP BY moved.key, ord, ns, ne)
    SELECT key, ord, a AS start, b AS "end" FROM out WHERE b > a""",
)
def i08_shift_lines(spark, sf_dir):
    cuts, lines = _cuts_and_lines(spark, sf_dir)
    return iv.shift_after_cuts(lines, cuts, ["key"])


@query(
    "i09_shift_points",
    _CUTS + """, moved AS (SELECT pts.key, pts.ord, coalesce(max(CASE WHEN cuts.s <= pts.s AND pts.s < cuts.e THEN cuts.e END), pts.s) AS pos
      FROM pts LEFT JOIN cuts ON pts.key = cuts.key GROUP BY pts.key, pts.ord, pts.s)
    SELECT moved.key, ord, greatest(0, pos - CAST(coalesce(sum(greatest(0, least(pos, cuts.e) - cuts.s)), 0) AS BIGINT)) AS pos
    FROM moved LEFT JOIN cuts ON moved.key = cuts.key GROUP BY moved.key, ord, pos""",
)
def i09_shift_points(spark, sf_dir):
    cuts, lines = _cuts_and_lines(spark, sf_dir)
    return iv.shift_points(lines.select("key", "ord", F.col("start").alias("pos")), cuts, ["key"], at="pos")


@query(
    "i11_chunk_ranges",
    f"""WITH {DIALOGUE_SQL}, d AS (SELECT conv_id, max(e) AS duration FROM dl GROUP BY conv_id HAVING max(e) > 0),
    n AS (SELECT conv_id, duration, CAST(ceil(duration / 480.0) AS INT) AS chunks FROM d),
    x AS (SELECT conv_id, duration, chunks, unnest(range(0, chunks)) AS chunk FROM n)
    SELECT conv_id, CAST(chunk AS INT) AS chunk, chunk * (CAST(duration AS DOUBLE) / chunks) AS chunk_start,
      CASE WHEN chunk = chunks - 1 THEN CAST(duration AS DOUBLE) ELSE (chunk + 1) * (CAST(duration AS DOUBLE) / chunks) END AS chunk_end FROM x""",
)
def i11_chunk_ranges(spark, sf_dir):
    d = dialogue(spark, sf_dir).groupBy("conv_id").agg(F.max("end").alias("duration"))
    return iv.chunk_ranges(d, "duration", 480).select("conv_id", "chunk", "chunk_start", "chunk_end")


@query(
    "i12_select_chunk_lines",
    f"""WITH {DIALOGUE_SQL}, c AS (SELECT conv_id, ord, s, e, CAST(floor((s + e) / 600.0) AS BIGINT) AS chunk FROM dl)
    SELECT conv_id, ord, chunk, greatest(s - chunk * 300, 0) AS in_start, least(e - chunk * 300, 300) AS in_end
    FROM c WHERE least(e - chunk * 300, 300) > greatest(s - chunk * 300, 0)""",
)
def i12_select_chunk_lines(spark, sf_dir):
    return iv.assign_by_midpoint(dialogue(spark, sf_dir), 300).select("conv_id", "ord", "chunk", "in_start", "in_end")


@query(
    "i13_overlapped_windows",
    f"""WITH {DIALOGUE_SQL}, d AS (SELECT conv_id, max(e) AS duration FROM dl GROUP BY conv_id HAVING max(e) > 0),
    x AS (SELECT conv_id, duration, unnest(range(0, CAST(floor((duration - 1) / 300.0) AS BIGINT) + 1)) AS i FROM d)
    SELECT conv_id, i, i * 300 AS core_start, least((i + 1) * 300, duration) AS core_end,
      greatest(i * 300 - 40, 0) AS read_start, least(least((i + 1) * 300, duration) + 40, duration) AS read_end FROM x""",
)
def i13_overlapped_windows(spark, sf_dir):
    d = dialogue(spark, sf_dir).groupBy("conv_id").agg(F.max("end").alias("duration")).where("duration > 0")
    return iv.overlapped_windows(d, "duration", 300, 40).drop("duration")


@query(
    "i15_bracketed",
    f"""WITH {INTERVALS_SQL}, v AS (SELECT key, s, e FROM iv WHERE kind = 'view'), q AS (SELECT key, ord, s, e FROM iv WHERE kind = 'click')
    SELECT q.key, q.ord, coalesce(q.s - max(CASE WHEN v.e <= q.s THEN v.e END) <= {DAY}
      AND min(CASE WHEN v.s >= q.e THEN v.s END) - q.e <= {DAY}, false) AS bracketed
    FROM q LEFT JOIN v ON q.key = v.key GROUP BY q.key, q.ord, q.s, q.e""",
)
def i15_bracketed(spark, sf_dir):
    rows = intervals(spark, sf_dir)
    v = rows.where("kind = 'view'").select("key", F.col("start").alias("vs"), F.col("end").alias("ve"))
    q = rows.where("kind = 'click'").select("key", "ord", "start", "end")
    q = iv.as_of(q, v, ["key"], "start", "ve", "prev_end")
    q = iv.as_of(q, v, ["key"], "end", "vs", "next_start", forward=True)
    near = (F.col("start") - F.col("prev_end") <= DAY) & (F.col("next_start") - F.col("end") <= DAY)
    return q.select("key", "ord", F.coalesce(near, F.lit(False)).alias("bracketed"))


@query(
    "i16_cover_windows",
    f"""WITH {INTERVALS_SQL}, n AS (SELECT key, ord, s, e, lag(e) OVER w AS pe, lead(s) OVER w AS ns FROM iv WINDOW w AS (PARTITION BY key ORDER BY s, e, ord))
    SELECT key, ord, least(s, greatest(s - {HOUR}, coalesce(CAST(floor((pe + s) / 2.0) AS BIGINT), s - {HOUR}))) AS cover_start,
      greatest(e, least(e + {HOUR}, coalesce(CAST(floor((e + ns) / 2.0) AS BIGINT), e + {HOUR}))) AS cover_end FROM n""",
)
def i16_cover_windows(spark, sf_dir):
    return iv.padded_windows(intervals(spark, sf_dir), ["key"], HOUR).select("key", "ord", "cover_start", "cover_end")


@query(
    "i17_tiles",
    f"""WITH {INTERVALS_SQL}, {BOUNDS_SQL}
    SELECT iv.key, ord, CASE WHEN row_number() OVER w = 1 THEN lo ELSE s END AS tile_start, coalesce(lead(s) OVER w, hi) AS tile_end
    FROM iv JOIN bounds ON iv.key = bounds.key WINDOW w AS (PARTITION BY iv.key ORDER BY s, ord)""",
)
def i17_tiles(spark, sf_dir):
    rows = intervals(spark, sf_dir)
    return iv.tile(rows.join(_bounds(rows), "key"), ["key"]).select("key", "ord", "tile_start", "tile_end")


@query(
    "i18_slice_events",
    f"""WITH {INTERVALS_SQL}, b AS (SELECT key, min(s) + {DAY} AS lo, min(s) + {9 * DAY} AS hi FROM iv GROUP BY key)
    SELECT iv.key, ord, greatest(s, lo) - lo AS start, least(e, hi) - lo AS "end" FROM iv JOIN b ON iv.key = b.key WHERE least(e, hi) > greatest(s, lo)""",
)
def i18_slice_events(spark, sf_dir):
    rows = intervals(spark, sf_dir)
    b = rows.groupBy("key").agg((F.min("start") + DAY).alias("lo"), (F.min("start") + 9 * DAY).alias("hi"))
    return iv.slice_events(rows.join(b, "key"), F.col("lo"), F.col("hi")).select("key", "ord", "start", "end")


@query(
    "i21_active_points",
    f"""WITH {INTERVALS_SQL} SELECT a.key, a.ord, count(*) AS n, min(b.s) AS first_at, max(b.s) AS last_at
    FROM iv a JOIN iv b ON a.key = b.key AND b.s BETWEEN a.s - {HOUR} AND a.e + {HOUR} WHERE a.kind = 'purchase' GROUP BY a.key, a.ord""",
)
def i21_active_points(spark, sf_dir):
    rows = intervals(spark, sf_dir)
    points = rows.select("key", "start", F.col("start").alias("end"))
    spans = rows.where("kind = 'purchase'").select("key", "ord", "start", "end")
    pairs = iv.bucketed_pairs(spans, points, ["key"], DAY, HOUR)
    return pairs.groupBy("key", "ord").agg(F.count(F.lit(1)).alias("n"), F.min("r_start").alias("first_at"), F.max("r_start").alias("last_at"))


@query(
    "i22_keyframe_before",
    f"""WITH {INTERVALS_SQL}, k AS (SELECT key, s FROM iv WHERE kind = 'view'), q AS (SELECT key, ord, s FROM iv WHERE kind <> 'view')
    SELECT q.key, q.ord, coalesce(max(k.s), 0) AS keyframe FROM q LEFT JOIN k ON q.key = k.key AND k.s <= q.s + 1000 GROUP BY q.key, q.ord""",
)
def i22_keyframe_before(spark, sf_dir):
    rows = intervals(spark, sf_dir)
    q = rows.where("kind <> 'view'").select("key", "ord", (F.col("start") + 1000).alias("at"))
    out = iv.as_of(q, rows.where("kind = 'view'").select("key", F.col("start").alias("k")), ["key"], "at", "k", "keyframe")
    return out.select("key", "ord", F.coalesce("keyframe", F.lit(0)).alias("keyframe"))


@query(
    "i23_keyframe_after",
    f"""WITH {INTERVALS_SQL}, k AS (SELECT key, s FROM iv WHERE kind = 'view'), q AS (SELECT key, ord, e FROM iv WHERE kind <> 'view'),
    d AS (SELECT key, max(e) AS duration FROM iv GROUP BY key)
    SELECT q.key, q.ord, least(duration, coalesce(min(k.s), duration)) AS keyframe
    FROM q JOIN d ON q.key = d.key LEFT JOIN k ON q.key = k.key AND k.s >= q.e - 1000 GROUP BY q.key, q.ord, duration""",
)
def i23_keyframe_after(spark, sf_dir):
    rows = intervals(spark, sf_dir)
    d = rows.groupBy("key").agg(F.max("end").alias("duration"))
    q = rows.where("kind <> 'view'").select("key", "ord", (F.col("end") - 1000).alias("at"))
    out = iv.as_of(q, rows.where("kind = 'view'").select("key", F.col("start").alias("k")), ["key"], "at", "k", "keyframe", forward=True)
    return out.join(d, "key").select("key", "ord", F.least("duration", F.coalesce("keyframe", "duration")).alias("keyframe"))


@query(
    "i24_align_to_keyframes",
    f"""WITH {INTERVALS_SQL}, k AS (SELECT key, s FROM iv WHERE kind = 'view'), q AS (SELECT key, ord, s, e FROM iv WHERE kind = 'purchase'),
    d AS (SELECT key, max(e) AS duration FROM iv GROUP BY key),
    b AS (SELECT q.key, q.ord, coalesce(max(k.s), 0) AS s FROM q LEFT JOIN k ON q.key = k.key AND k.s <= q.s + 1000 GROUP BY q.key, q.ord),
    a AS (SELECT q.key, q.ord, duration, q.e AS own, least(duration, coalesce(min(k.s), duration)) AS e
      FROM q JOIN d ON q.key = d.key LEFT JOIN k ON q.key = k.key AND k.s >= q.e - 1000 GROUP BY q.key, q.ord, q.e, duration),
    snapped AS (SELECT b.key, b.s, CASE WHEN a.e <= b.s + 20000 THEN least(duration, greatest(a.e, own)) ELSE a.e END AS e FROM a JOIN b ON a.key = b.key AND a.ord = b.ord),
    {_islands_sql('snapped', 'm', 1000)}
    SELECT key, s AS start, e AS "end", members FROM m""",
)
def i24_align_to_keyframes(spark, sf_dir):
    rows = intervals(spark, sf_dir)
    k = rows.where("kind = 'view'").select("key", F.col("start").alias("k"))
    d = rows.groupBy("key").agg(F.max("end").alias("duration"))
    q = rows.where("kind = 'purchase'").select("key", "ord", F.col("end").alias("own"), (F.col("start") + 1000).alias("from"), (F.col("end") - 1000).alias("to"))
    q = iv.as_of(q, k, ["key"], "from", "k", "start")
    q = iv.as_of(q, k, ["key"], "to", "k", "end", forward=True).join(d, "key")
    start, end = F.coalesce("start", F.lit(0)), F.least("duration", F.coalesce("end", "duration"))
    end = F.when(end <= start + 20000, F.least("duration", F.greatest(end, "own"))).otherwise(end)
    return iv.islands(q.select("key", start.alias("start"), end.alias("end")), ["key"], tolerance=1000).drop("island")


@query(
    "i20_active_at",
    f"""WITH {INTERVALS_SQL} SELECT q.key, q.ord, count(c.ord) AS active FROM (SELECT * FROM iv WHERE kind = 'signup') q
    LEFT JOIN (SELECT * FROM iv WHERE kind <> 'signup') c ON q.key = c.key AND q.s BETWEEN c.s AND c.e GROUP BY q.key, q.ord""",
)
def i20_active_at(spark, sf_dir):
    rows = intervals(spark, sf_dir)
    q = rows.where("kind = 'signup'").select("key", "ord", "start", F.col("start").alias("end"))
    pairs = iv.bucketed_pairs(q, rows.where("kind <> 'signup'").select("key", F.col("ord").alias("id"), "start", "end"), ["key"], DAY)
    n = pairs.groupBy("key", "ord").agg(F.count(F.lit(1)).alias("active"))
    return q.select("key", "ord").join(n, ["key", "ord"], "left").select("key", "ord", F.coalesce("active", F.lit(0)).alias("active"))


@query(
    "i27_replace_tail",
    f"""WITH {DIALOGUE_SQL}, cut AS (SELECT conv_id, max(e) * 2 // 3 + 2 AS cut_at FROM dl GROUP BY conv_id)
    SELECT dl.conv_id, ord, s AS start, e AS "end", 'kept' AS origin FROM dl JOIN cut ON dl.conv_id = cut.conv_id WHERE role <> 'assistant' AND s + e < 2 * cut_at
    UNION ALL SELECT dl.conv_id, ord, s, e, 'fresh' FROM dl JOIN cut ON dl.conv_id = cut.conv_id WHERE role = 'assistant' AND s >= cut_at""",
)
def i27_replace_tail(spark, sf_dir):
    rows = dialogue(spark, sf_dir)
    cut = rows.groupBy("conv_id").agg(F.expr("max(end) * 2 div 3 + 2").alias("at"))
    rows = rows.join(cut, "conv_id")
    kept = rows.where("role <> 'assistant' and start + end < 2 * at").withColumn("origin", F.lit("kept"))
    fresh = rows.where("role = 'assistant' and start >= at").withColumn("origin", F.lit("fresh"))
    return kept.unionByName(fresh).select("conv_id", "ord", "start", "end", "origin")


@query(
    "i28_gaps_with_source",
    f"""WITH {INTERVALS_SQL}, r AS (SELECT key, s, max(e) OVER (PARTITION BY key ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM iv WHERE kind <> 'click'),
    g AS (SELECT key, reach AS a, s AS b FROM r WHERE s - reach > {HOUR}), c AS (SELECT key, s, e FROM iv WHERE kind = 'click')
    SELECT g.key, a AS gap_start, b AS gap_end FROM g WHERE EXISTS (SELECT 1 FROM c WHERE c.key = g.key AND (least(c.e, g.b) - greatest(c.s, g.a) >= {HOUR} // 60 OR (c.s + c.e > 2 * g.a AND c.s + c.e < 2 * g.b)))""",
)
def i28_gaps_with_source(spark, sf_dir):
    rows = intervals(spark, sf_dir)
    gaps = iv.internal_gaps(rows.where("kind <> 'click'"), ["key"], least=HOUR).select("key", F.col("gap_start").alias("start"), F.col("gap_end").alias("end"))
    pairs = iv.bucketed_pairs(gaps, rows.where("kind = 'click'").select("key", "start", "end"), ["key"], DAY)
    long = F.least("r_end", "end") - F.greatest("r_start", "start") >= HOUR // 60
    middle = (F.col("r_start") + F.col("r_end") > 2 * F.col("start")) & (F.col("r_start") + F.col("r_end") < 2 * F.col("end"))
    return pairs.where(long | middle).select("key", F.col("start").alias("gap_start"), F.col("end").alias("gap_end")).distinct()


@query("i32_fixed_times", f"WITH {DIALOGUE_SQL}, d AS (SELECT conv_id, max(e) AS m FROM dl GROUP BY conv_id) SELECT conv_id, CAST(unnest(range(50, m, 50)) AS BIGINT) AS at FROM d")
def i32_fixed_times(spark, sf_dir):
    d = dialogue(spark, sf_dir).groupBy("conv_id").agg(F.max("end").alias("m")).where("m > 50")
    return d.select("conv_id", F.explode(F.expr("sequence(50L, m - 1, 50L)")).alias("at"))


@query(
    "i33_gap_windows",
    f"""WITH {INTERVALS_SQL}, r AS (SELECT key, s, max(e) OVER (PARTITION BY key ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM iv),
    g AS (SELECT key, reach AS a, s AS b FROM r WHERE s - reach > {DAY}),
    x AS (SELECT key, a, b, unnest(range(0, CAST(ceil((b - a) / CAST({DAY} AS DOUBLE)) AS BIGINT))) AS i FROM g)
    SELECT key, a AS gap_start, a + i * {DAY} AS accept_start, least(b, a + (i + 1) * {DAY}) AS accept_end,
      a + i * {DAY} - {HOUR} AS read_start, least(b, a + (i + 1) * {DAY}) + {HOUR} AS read_end FROM x""",
)
def i33_gap_windows(spark, sf_dir):
    g = iv.internal_gaps(intervals(spark, sf_dir), ["key"], least=DAY)
    g = g.withColumn("i", F.explode(F.expr(f"sequence(0L, cast(ceil((gap_end - gap_start) / {DAY}.0D) as bigint) - 1)")))
    lo, hi = F.col("gap_start") + F.col("i") * DAY, F.least("gap_end", F.col("gap_start") + (F.col("i") + 1) * DAY)
    return g.select("key", "gap_start", lo.alias("accept_start"), hi.alias("accept_end"), (lo - HOUR).alias("read_start"), (hi + HOUR).alias("read_end"))


@query(
    "i35_tail_lines",
    f"""WITH {DIALOGUE_SQL}, c AS (SELECT conv_id, max(CASE WHEN role = 'user' THEN e END) AS covered FROM dl GROUP BY conv_id)
    SELECT dl.conv_id, ord, greatest(s, covered + 2) AS start, e AS "end" FROM dl JOIN c ON dl.conv_id = c.conv_id WHERE role <> 'user' AND e > greatest(s, covered + 2)""",
)
def i35_tail_lines(spark, sf_dir):
    rows = dialogue(spark, sf_dir)
    c = rows.groupBy("conv_id").agg(F.max(F.when(F.col("role") == "user", F.col("end"))).alias("covered"))
    out = rows.where("role <> 'user'").join(c, "conv_id").withColumn("start", F.greatest("start", F.col("covered") + 2))
    return out.where("covered is not null and end > start").select("conv_id", "ord", "start", "end")


@query(
    "i41_unexplained_gaps",
    f"""WITH {INTERVALS_SQL}, r AS (SELECT key, s, max(e) OVER (PARTITION BY key ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM iv WHERE kind <> 'click'),
    g AS (SELECT key, reach AS a, s AS b FROM r WHERE s - reach > {DAY}), c AS (SELECT key, s, e FROM iv WHERE kind = 'click')
    SELECT g.key, a AS gap_start, b AS gap_end, CASE WHEN EXISTS (SELECT 1 FROM c WHERE c.key = g.key AND c.s < g.b AND c.e > g.a) THEN 'error' ELSE 'warning' END AS severity FROM g""",
)
def i41_unexplained_gaps(spark, sf_dir):
    rows = intervals(spark, sf_dir)
    gaps = iv.internal_gaps(rows.where("kind <> 'click'"), ["key"], least=DAY).select("key", F.col("gap_start").alias("start"), F.col("gap_end").alias("end"))
    pairs = iv.bucketed_pairs(gaps, rows.where("kind = 'click'").select("key", "start", "end"), ["key"], DAY)
    bad = pairs.where("r_start < end and r_end > start").select("key", "start", "end").distinct().withColumn("hit", F.lit(1))
    out = gaps.join(bad, ["key", "start", "end"], "left")
    return out.select("key", F.col("start").alias("gap_start"), F.col("end").alias("gap_end"), F.when(F.col("hit") == 1, "error").otherwise("warning").alias("severity"))
