"""Joins between timelines and between documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapwing.operators import intervals as iv


def match_clusters(cues: DataFrame, clusters: DataFrame, keys: Sequence[str], size: int, reach: int, y_cue: str | None = None, y_cluster: str | None = None) -> DataFrame:
    """The best cluster of each cue among those that overlap it or lie within
    ``reach``: most overlap, then least gap, then (if given) least vertical
    distance, ties by the smallest ``index``.  Cues without one are missing."""
    pairs = iv.bucketed_pairs(cues, clusters, keys, size, reach)
    overlap = F.greatest(F.lit(0).cast("bigint"), F.least("end", "r_end") - F.greatest("start", "r_start"))
    gap = iv.temporal_gap(F.col("start"), F.col("end"), F.col("r_start"), F.col("r_end"))
    score = overlap * 1000.0 - gap * 100.0
    if y_cue and y_cluster:
        score = score - F.abs(F.col(f"r_{y_cluster}") - F.col(y_cue)) * 0.01
    pairs = pairs.withColumns({"overlap": overlap, "gap": gap, "score": score}).where("overlap > 0 or gap <= " + str(reach))
    return iv.best_match(pairs, [*keys, "ord"], F.col("score"), ["r_index"])


def without_match(left: DataFrame, right: DataFrame, keys: Sequence[str], size: int, least: int) -> DataFrame:
    """Rows of ``left`` that overlap nothing of ``right`` by ``least`` or more."""
    pairs = iv.bucketed_pairs(left, right, keys, size)
    hit = pairs.where(F.least("end", "r_end") - F.greatest("start", "r_start") >= least).select(*keys, "ord").distinct()
    return left.join(hit, [*keys, "ord"], "left_anti")


def uncovered_points(points: DataFrame, events: DataFrame, keys: Sequence[str], size: int, gap: int) -> DataFrame:
    """Points in no event, joined to ranges where they lie within ``gap``."""
    p = points.withColumns({"start": F.col("at"), "end": F.col("at")})
    pairs = iv.bucketed_pairs(p, events, keys, size)
    hit = pairs.where("at >= r_start and at <= r_end").select(*keys, "ord").distinct()
    return iv.islands(p.join(hit, [*keys, "ord"], "left_anti"), keys, tolerance=gap).drop("island")


def coverage(spans: DataFrame, events: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """Per span (``ord``) its length, how much of it events cover, and the share."""
    pairs = iv.bucketed_pairs(spans, events, keys, size).where("r_start < end and r_end > start")
    clipped = pairs.select(*keys, "ord", F.greatest("start", "r_start").alias("start"), F.least("end", "r_end").alias("end"))
    merged = iv.islands(clipped, [*keys, "ord"]).groupBy(*keys, "ord").agg(F.sum(F.col("end") - F.col("start")).alias("covered"))
    out = spans.join(merged, [*keys, "ord"], "left").withColumn("covered", F.coalesce("covered", F.lit(0)))
    return out.withColumn("uncovered", F.col("end") - F.col("start") - F.col("covered"))


def coalesce_timing(lines: DataFrame, sync: DataFrame, keys: Sequence[str], limit: Column, order: str) -> DataFrame:
    """Lines with the timing of their row in ``sync`` if there is one (the last of
    duplicates by ``order``), held in ``[0, limit]``; empty ones go."""
    last = sync.groupBy(*keys).agg(F.max_by(F.struct("start", "end"), F.col(order)).alias("_t"))
    rows = lines.join(last, list(keys), "left")
    start = F.greatest(F.lit(0), F.least(limit, F.coalesce("_t.start", "start")))
    end = F.greatest(start, F.least(limit, F.coalesce("_t.end", "end")))
    return rows.withColumns({"start": start, "end": end}).drop("_t").where("end > start")


def one_to_one(left: DataFrame, right: DataFrame, key: str, compare: dict[str, str]) -> DataFrame:
    """Violations of a strict one-to-one relation: keys missing on a side, repeated
    keys, and compared columns that differ."""
    side = lambda df, n, cols: df.groupBy(F.col(key).alias(f"_{n}k")).agg(
        F.count(F.lit(1)).alias(f"_{n}n"), *[F.min(c).alias(f"_{n}{i}") for i, c in enumerate(cols)]
    )
    both = side(left, "l", compare).join(side(right, "r", compare.values()), F.col("_lk").eqNullSafe(F.col("_rk")), "full_outer")
    problem = F.when(F.col("_rn").isNull(), "missing_right").when(F.col("_ln").isNull(), "missing_left").when((F.col("_ln") > 1) | (F.col("_rn") > 1), "repeated")
    for i, c in enumerate(compare):
        problem = problem.when(~F.col(f"_l{i}").eqNullSafe(F.col(f"_r{i}")), f"differs_{c}")
    return both.select(F.coalesce("_lk", "_rk").alias(key), problem.alias("problem")).where("problem is not null")


def resolve(refs: DataFrame, catalog: DataFrame, exact: Sequence[str], digest: str) -> DataFrame:
    """Each reference's status against a catalog: ``found`` on all columns,
    ``mismatch`` if only the digest is there, else ``missing``."""
    full = catalog.select(*exact).distinct().withColumn("_full", F.lit(1))
    known = catalog.select(digest).distinct().withColumn("_known", F.lit(1))
    rows = refs.join(full, list(exact), "left").join(known, digest, "left")
    return rows.withColumn("status", F.when(F.col("_full") == 1, "found").when(F.col("_known") == 1, "mismatch").otherwise("missing")).drop("_full", "_known")


def richest(df: DataFrame, keys: Sequence[str], rich: Column, order: str) -> DataFrame:
    """One row a key: the first that is ``rich``, else the first."""
    w = Window.partitionBy(*keys).orderBy(rich.desc(), F.col(order))
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def new_items(items: DataFrame, processed: DataFrame, key: str, order: str) -> DataFrame:
    """Items never processed, the first row of each, ready to be marked."""
    fresh = items.join(processed.select(key).distinct(), key, "left_anti")
    w = Window.partitionBy(key).orderBy(order)
    return fresh.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
