"""Aggregations and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapwing.operators import intervals as iv


def calibrate_lane(df: DataFrame, keys: Sequence[str], center: str, height: str, seed: Column, width: float) -> DataFrame:
    """Robust lane of each key, in two exact-median steps: the seed rows' median
    centre and height, then the medians of all rows within ``width`` heights of
    that centre, with how many of the rows support them."""
    first = df.where(seed).groupBy(*keys).agg(F.median(center).alias("_c"), F.median(height).alias("_h"))
    near = df.join(first, list(keys)).where(F.abs(F.col(center) - F.col("_c")) <= F.col("_h") * width)
    lane = near.groupBy(*keys).agg(F.median(center).alias("lane_center"), F.median(height).alias("lane_height"), F.count(F.lit(1)).alias("support"))
    total = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return total.join(lane, list(keys), "left").withColumn("support_ratio", F.coalesce(F.col("support") / F.col("rows"), F.lit(0.0)))


def per_second(df: DataFrame, keys: Sequence[str], at: Column, measures: dict[str, Column]) -> DataFrame:
    """Counts by whole second: all rows and those for which each measure holds."""
    return df.groupBy(*keys, at.alias("second")).agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(n) for n, c in measures.items()])


def all_hold(df: DataFrame, keys: Sequence[str], checks: dict[str, Column]) -> DataFrame:
    """Whether each check holds for every row of a key, and all of them do."""
    out = df.groupBy(*keys).agg(*[F.bool_and(c).alias(n) for n, c in checks.items()])
    total = None
    for n in checks:
        total = F.col(n) if total is None else total & F.col(n)
    return out.withColumn("passed", total)


def set_equals(df: DataFrame, keys: Sequence[str], item: str, expected: Sequence[str]) -> DataFrame:
    """Whether a key's items are exactly the expected ones, and what is missing
    or too much."""
    want = F.array(*[F.lit(x) for x in sorted(expected)])
    got = df.groupBy(*keys).agg(F.sort_array(F.collect_set(item)).alias("_got"), F.count(item).alias("items"))
    return got.select(
        *keys, "items", ((F.col("_got") == want) & (F.col("items") == len(expected))).alias("exact"),
        F.array_join(F.array_except(want, "_got"), ",").alias("missing"), F.array_join(F.array_except("_got", want), ",").alias("extra"),
    )


def contained_in_active(points: DataFrame, events: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """Each point with whether some event active at its time contains its box, and
    the event (``index``) whose middle is nearest."""
    p = points.withColumns({"start": F.col("at"), "end": F.col("at")})
    pairs = iv.bucketed_pairs(p, events, keys, size).where("at >= r_start and at <= r_end")
    inside = (F.col("r_x1") <= F.col("x1")) & (F.col("r_y1") <= F.col("y1")) & (F.col("r_x2") >= F.col("x2")) & (F.col("r_y2") >= F.col("y2"))
    away = F.abs(F.col("r_start") + F.col("r_end") - 2 * F.col("at"))
    hit = pairs.groupBy(*keys, "ord").agg(F.bool_or(inside).alias("contained"), F.min_by("r_index", F.struct(away, F.col("r_index"))).alias("nearest"))
    return points.join(hit, [*keys, "ord"], "left").withColumn("contained", F.coalesce("contained", F.lit(False)))


def status_partition(df: DataFrame, keys: Sequence[str], status: Column, attempt: str) -> DataFrame:
    """Rows a key and status, with the most attempts any of them took."""
    return df.groupBy(*keys, status.alias("status")).agg(F.count(F.lit(1)).alias("n"), F.max(attempt).alias("attempts"))


def widest(df: DataFrame, keys: Sequence[str], width: Column, room: int, order: str) -> DataFrame:
    """The widest row of each key (the first of equals) and how many overflow."""
    best = F.max_by(F.col(order), F.struct(width, -F.col(order)))
    return df.groupBy(*keys).agg(best.alias("widest"), F.max(width).alias("width"), F.count_if(width > room).alias("overflows"))


def merge_candidates(df: DataFrame, keys: Sequence[str], tolerance: int) -> DataFrame:
    """Candidate spans merged within a tolerance: the best confidence, the sorted
    distinct sources and the distinct reasons in order of appearance."""
    reasons = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("start", "end", "ord", "reason"))), lambda x: x["reason"]))
    extra = [F.max("confidence").alias("confidence"), F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"), F.array_join(reasons, "; ").alias("reasons")]
    return iv.islands(df, keys, tolerance=tolerance, extra=extra).drop("island", "members")


def nearest_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each key, which is what is asked for."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
