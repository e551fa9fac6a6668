"""Interval algebra over keyed, half-open intervals.

All functions take column names, never collect, and partition by the key.  A key
with a great many intervals is handled by sorting, not by pairing: merging,
complements and gaps are running maxima.  Sums over cuts use the cuts' prefix sums
(one as-of step), not a join of every point with every cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def overlap_ratio(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Overlap over the shorter duration; 0 when disjoint or degenerate."""
    overlap, shortest = F.least(e1, e2) - F.greatest(s1, s2), F.least(e1 - s1, e2 - s2)
    return F.when((overlap > 0) & (shortest > 0), overlap / shortest).otherwise(F.lit(0.0))


def temporal_gap(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Distance between two intervals, 0 when they touch or overlap."""
    return F.greatest(s2 - e1, s1 - e2, F.lit(0).cast("bigint"))


def time_conflicts(s1: Column, e1: Column, s2: Column, e2: Column, edge: float, share: float = 0.35) -> Column:
    """Enough overlap, or the middle of either within ``edge`` of the other."""
    m1, m2 = s1 + e1, s2 + e2  # twice the middles: stays in integers
    near = m1.between(2 * (s2 - edge), 2 * (e2 + edge)) | m2.between(2 * (s1 - edge), 2 * (e1 + edge))
    return (overlap_ratio(s1, e1, s2, e2) >= share) | near


def islands(df: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end", tolerance: int = 0, extra: Sequence[Column] = ()) -> DataFrame:
    """Merged intervals: a new island begins where the start lies more than
    ``tolerance`` after the running maximum end."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = (reach.isNull() | (F.col(start) > reach + F.lit(tolerance))).cast("int")
    numbered = df.withColumn("_opens", opens).withColumn("island", F.sum("_opens").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "island").agg(F.min(start).alias(start), F.max(end).alias(end), F.count(F.lit(1)).alias("members"), *extra)


def clamp(df: DataFrame, lo: Column, hi: Column, start: str = "start", end: str = "end") -> DataFrame:
    """Intervals cut to ``[lo, hi]``; what is empty then goes."""
    return df.withColumns({start: F.greatest(F.col(start), lo), end: F.least(F.col(end), hi)}).where(F.col(end) > F.col(start))


def complement(df: DataFrame, bounds: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end", least: int = 0) -> DataFrame:
    """What ``df`` leaves of each key's ``[lo, hi]`` in ``bounds``; pieces of at
    most ``least`` are dropped.  Keys without intervals keep their whole range."""
    inside = clamp(df.join(bounds, list(keys)), F.col("lo"), F.col("hi"), start, end)
    merged = islands(inside, keys, start, end).select(*keys, start, end)
    # The range's end is a last, empty island: every gap then ends at a start.
    edge = bounds.select(*keys, F.col("hi").alias(start), F.col("hi").alias(end))
    w = Window.partitionBy(*keys).orderBy(start, end)
    both = merged.unionByName(edge).join(bounds, list(keys))
    before = F.coalesce(F.lag(end).over(w), F.col("lo"))
    gaps = both.select(*keys, before.alias("gap_start"), F.col(start).alias("gap_end"))
    return gaps.where(F.col("gap_end") - F.col("gap_start") > least)


def internal_gaps(df: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end", least: int = 0) -> DataFrame:
    """Gaps longer than ``least`` between covered ranges; no head, no tail."""
    w = Window.partitionBy(*keys).orderBy(start, end).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn("gap_start", F.max(end).over(w)).withColumnRenamed(start, "gap_end")
    return rows.where(F.col("gap_end") - F.col("gap_start") > least).select(*keys, "gap_start", "gap_end")


def _with_removed(points: DataFrame, cuts: DataFrame, keys: Sequence[str], at: str, out: str) -> DataFrame:
    """``out``: cut length before ``at``; ``<out>_in_end``, ``<out>_in_start``: the
    bounds of the cut that ``at`` lies in, if any.  ``cuts`` are merged."""
    w = Window.partitionBy(*keys).orderBy("start")
    total = F.sum(F.col("end") - F.col("start")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    c = cuts.select(*keys, F.col("start").alias("_t"), F.struct("start", "end", F.coalesce(total, F.lit(0)).alias("before")).alias("_cut"))
    # Cuts sort before points at the same time, and the last cut is carried on.
    rows = points.withColumns({"_t": F.col(at), "_cut": F.lit(None).cast(c.schema["_cut"].dataType), "_p": F.lit(1)})
    both = rows.unionByName(c.withColumn("_p", F.lit(0)), allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy("_t", "_p").rowsBetween(Window.unboundedPreceding, 0)
    last = F.last("_cut", ignorenulls=True).over(w)
    both = both.withColumn("_last", last).where("_p = 1")
    removed = F.col("_last.before") + F.least(F.col(at), F.col("_last.end")) - F.col("_last.start")
    inside = F.col(at) < F.col("_last.end")
    return both.withColumns(
        {
            out: F.coalesce(removed, F.lit(0)),
            f"{out}_in_start": F.when(inside, F.col("_last.start")),
            f"{out}_in_end": F.when(inside, F.col("_last.end")),
        }
    ).drop("_t", "_p", "_cut", "_last")


def removed_before(points: DataFrame, cuts: DataFrame, keys: Sequence[str], at: str = "at") -> DataFrame:
    """Points with ``removed``: the length of their key's cuts before them."""
    return _with_removed(points, islands(cuts, keys), keys, at, "removed").drop("removed_in_start", "removed_in_end")


def shift_after_cuts(lines: DataFrame, cuts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lines on the timeline without the cuts: covered lines go, lines over an
    edge keep the surviving side, all others move up."""
    merged = islands(cuts, keys).select(*keys, "start", "end")
    rows = _with_removed(lines.where("end > start"), merged, keys, "start", "_a")
    # The end belongs to the cut it lies in or ends with: look just before it.
    rows = _with_removed(rows.withColumn("_e", F.col("end") - 1), merged, keys, "_e", "_b")
    new_start = F.coalesce(F.col("_a_in_end"), F.col("start"))
    new_end = F.coalesce(F.col("_b_in_start"), F.col("end"))
    removed_start = F.when(F.col("_a_in_end").isNull(), F.col("_a")).otherwise(F.col("_a") + F.col("_a_in_end") - F.col("start"))
    removed_end = F.when(F.col("_b_in_start").isNull(), F.col("_b")).otherwise(F.col("_b") - (F.col("_e") - F.col("_b_in_start")))
    out = rows.where(new_end > new_start).withColumns({"start": new_start - removed_start, "end": new_end - removed_end})
    return out.where("end > start").select(*lines.columns)


def shift_points(points: DataFrame, cuts: DataFrame, keys: Sequence[str], at: str = "at") -> DataFrame:
    """Points after the cuts: one inside a cut moves to where the cut was."""
    rows = _with_removed(points, islands(cuts, keys).select(*keys, "start", "end"), keys, at, "_r")
    end = F.coalesce(F.col("_r_in_end"), F.col(at))
    removed = F.col("_r") + end - F.col(at)
    return rows.withColumn(at, F.greatest(end - removed, F.lit(0))).select(*points.columns)


def chunk_ranges(df: DataFrame, duration: str, longest: int) -> DataFrame:
    """``ceil(duration / longest)`` equal chunks; the last ends exactly."""
    n = F.ceil(F.col(duration) / F.lit(longest)).cast("int")
    rows = df.where(F.col(duration) > 0).withColumn("chunks", n).withColumn("chunk", F.explode(F.expr("sequence(0, chunks - 1)")))
    size = F.col(duration) / F.col("chunks")
    return rows.withColumns(
        {
            "chunk_start": F.col("chunk") * size,
            "chunk_end": F.when(F.col("chunk") == F.col("chunks") - 1, F.col(duration).cast("double")).otherwise((F.col("chunk") + 1) * size),
        }
    )


def assign_by_midpoint(lines: DataFrame, size: int) -> DataFrame:
    """Each line belongs to the chunk of ``size`` that holds its middle, is cut to
    it and counted from its begin."""
    rows = lines.withColumn("chunk", F.floor((F.col("start") + F.col("end")) / F.lit(2 * size)))
    lo = F.col("chunk") * F.lit(size)
    rows = rows.withColumns({"in_start": F.greatest(F.col("start") - lo, F.lit(0)), "in_end": F.least(F.col("end") - lo, F.lit(size))})
    return rows.where("in_end > in_start")


def overlapped_windows(df: DataFrame, duration: str, core: int, overlap: int) -> DataFrame:
    """Cores of ``core`` with ``overlap`` read on either side."""
    rows = df.withColumn("i", F.explode(F.expr(f"sequence(0L, cast(floor(({duration} - 1) / {core}) as bigint))")))
    lo, hi = F.col("i") * core, F.least((F.col("i") + 1) * core, F.col(duration))
    return rows.withColumns(
        {"core_start": lo, "core_end": hi, "read_start": F.greatest(lo - overlap, F.lit(0)), "read_end": F.least(hi + overlap, F.col(duration))}
    )


def padded_windows(df: DataFrame, keys: Sequence[str], pad: int, order: Sequence[str] = ("start", "end", "ord")) -> DataFrame:
    """Windows grown by ``pad`` but not past the middle to a neighbour; never
    shrunk.  Twice the positions are compared, so nothing is rounded early."""
    w = Window.partitionBy(*keys).orderBy(*order)
    prev_end, next_start = F.lag("end").over(w), F.lead("start").over(w)
    lo = F.greatest(F.col("start") - pad, F.coalesce(F.floor((prev_end + F.col("start")) / 2), F.col("start") - pad))
    hi = F.least(F.col("end") + pad, F.coalesce(F.floor((F.col("end") + next_start) / 2), F.col("end") + pad))
    return df.withColumns({"cover_start": F.least(lo, F.col("start")), "cover_end": F.greatest(hi, F.col("end"))})


def tile(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each row lasts until the next one starts; the first begins at its key's
    ``lo`` and the last ends at its ``hi``."""
    w = Window.partitionBy(*keys).orderBy("start", "ord")
    return df.withColumns(
        {
            "tile_start": F.when(F.row_number().over(w) == 1, F.col("lo")).otherwise(F.col("start")),
            "tile_end": F.coalesce(F.lead("start").over(w), F.col("hi")),
        }
    )


def slice_events(df: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """Events cut to ``[lo, hi)`` and counted from ``lo``."""
    cut = df.withColumns({"start": F.greatest(F.col("start"), lo), "end": F.least(F.col("end"), hi)}).where(F.col("end") > F.col("start"))
    return cut.withColumns({"start": F.col("start") - lo, "end": F.col("end") - lo})


def as_of(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, value: str, out: str, forward: bool = False) -> DataFrame:
    """Nearest ``value`` of ``right`` at or before (``forward``: at or after) each
    ``at`` of ``left``, by one sort of both sides; no pairs are made."""
    r = right.select(*keys, F.col(value).alias("_t"), F.col(value).alias(out), F.lit(0).alias("_side"))
    rows = left.withColumns({"_t": F.col(at), "_side": F.lit(1)}).unionByName(r, allowMissingColumns=True)
    time, side = (F.col("_t").desc(), F.col("_side").asc()) if forward else (F.col("_t").asc(), F.col("_side").asc())
    w = Window.partitionBy(*keys).orderBy(time, side).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(out, F.last(out, ignorenulls=True).over(w)).where("_side = 1").drop("_t", "_side")


def bucketed_pairs(left: DataFrame, right: DataFrame, keys: Sequence[str], size: int, reach: int = 0) -> DataFrame:
    """Pairs of a key whose intervals overlap or lie within ``reach``.

    Both sides are dealt to time buckets of ``size``, so the join is an equi-join
    on key and bucket; a pair that shares several buckets is kept in its first
    one.  Columns of ``right`` come back with the prefix ``r_``."""
    first = lambda c, by: F.floor((F.col(c) + F.lit(by)) / F.lit(size)).cast("bigint")
    a = left.withColumns({"_lo": first("start", -reach), "_hi": first("end", reach)}).withColumn("_b", F.explode(F.sequence("_lo", "_hi")))
    names = [c for c in right.columns if c not in keys]
    b = right.select(*keys, *[F.col(c).alias(f"r_{c}") for c in names]).withColumns({"_rlo": first("r_start", 0), "_rhi": first("r_end", 0)})
    b = b.withColumn("_b", F.explode(F.sequence("_rlo", "_rhi")))
    pairs = a.join(b, [*keys, "_b"]).where(F.col("_b") == F.greatest("_lo", "_rlo"))
    near = (F.col("start") <= F.col("r_end") + reach) & (F.col("r_start") <= F.col("end") + reach)
    return pairs.where(near).drop("_b", "_lo", "_hi", "_rlo", "_rhi")


def best_match(pairs: DataFrame, left_id: Sequence[str], score: Column, ties: Sequence[str]) -> DataFrame:
    """The pair of each left row with the highest score, ties by the smallest."""
    order = F.struct((-score).alias("s"), *[F.col(t) for t in ties])
    names = [c for c in pairs.columns if c not in left_id]
    best = pairs.groupBy(*left_id).agg(F.min_by(F.struct(*names), order).alias("_best"))
    return best.select(*left_id, *[F.col(f"_best.{c}").alias(c) for c in names])
