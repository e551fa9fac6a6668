"""Rectangle operators over groups (a frame, a cluster)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwing.functions.geometry import greedy_keep


def dedupe_rects(df: DataFrame, keys: Sequence[str], share: float = 0.85) -> DataFrame:
    """Greedily, from the top left down, the rectangles that overlap no kept one
    by ``share``; one row each.  A group's rectangles are one array: for groups
    that are frames or clusters."""
    items = F.collect_list(F.struct("y1", "x1", "y2", "x2"))
    kept = df.groupBy(*keys).agg(items.alias("_r")).withColumn("_r", greedy_keep(F.col("_r"), F.col("_r"), share))
    return kept.select(*keys, F.explode("_r").alias("_b")).select(*keys, "_b.x1", "_b.y1", "_b.x2", "_b.y2")


def suppress(df: DataFrame, keys: Sequence[str], priority: Column, share: float = 0.55, tie: str = "ord") -> DataFrame:
    """Greedy non-maximum suppression: by priority, ties by ``tie``, the boxes
    that overlap no kept one of their group by ``share``."""
    names = [c for c in df.columns if c not in keys]
    rest = [c for c in names if c != tie]
    items = F.collect_list(F.struct((-priority).alias("_p"), F.col(tie), *rest))
    kept = df.groupBy(*keys).agg(items.alias("_r")).withColumn("_r", greedy_keep(F.col("_r"), F.col("_r"), share))
    return kept.select(*keys, F.explode("_r").alias("_b")).select(*keys, *[F.col(f"_b.{c}").alias(c) for c in names])


def zoom_crop(df: DataFrame, keys: Sequence[str], pad: int, width: int, height: int) -> DataFrame:
    """Envelope of a group's boxes, padded and held in the frame (the whole frame
    if nothing is left), beside the envelope itself."""
    u = df.groupBy(*keys).agg(F.min("x1").alias("x1"), F.min("y1").alias("y1"), F.max("x2").alias("x2"), F.max("y2").alias("y2"))
    x1, y1 = F.greatest(F.lit(0), F.col("x1") - pad), F.greatest(F.lit(0), F.col("y1") - pad)
    x2, y2 = F.least(F.lit(width), F.col("x2") + pad), F.least(F.lit(height), F.col("y2") + pad)
    bad = (x2 <= x1) | (y2 <= y1)
    pick = lambda v, whole: F.when(bad, F.lit(whole)).otherwise(v)
    return u.withColumns({"zoom_x1": pick(x1, 0), "zoom_y1": pick(y1, 0), "zoom_x2": pick(x2, width), "zoom_y2": pick(y2, height)})


def crop_bounds(df: DataFrame, pad: int, width: int, height: int) -> DataFrame:
    """Vertical range of ``y1..y2`` padded and at least a minimum height, inside
    the frame."""
    least = min(height, max(96, int(width * 5 / 18) + 8))
    df = df.withColumns({"_a": F.greatest(F.lit(0), F.col("y1") - pad), "_b": F.least(F.lit(height), F.col("y2") + pad)})
    small = F.col("_b") - F.col("_a") < least
    top = F.greatest(F.lit(0), F.floor((F.col("_a") + F.col("_b")) / 2) - least // 2)
    bottom = F.least(F.lit(height), top + least)
    return df.withColumns(
        {"crop_y1": F.when(small, F.greatest(F.lit(0), bottom - least)).otherwise(F.col("_a")), "crop_y2": F.when(small, bottom).otherwise(F.col("_b"))}
    ).drop("_a", "_b")
