"""Keep-or-reject rules.  Each gives the first reason that applies, or ''; what
is rejected stays visible as rows with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapwing.functions.geometry import Box, in_band


def span_reason(b: Box, samples: Column, width: int, height: int, crop_y: int, least_samples: int = 3, max_height: int = 120, max_area: float = 0.20) -> Column:
    """Why a tracked span is not to be cleaned."""
    w, h = b.x2 - b.x1, b.y2 - b.y1
    cx, cy = (b.x1 + b.x2) / 2.0 / max(1, width), (b.y1 + b.y2) / 2.0 / max(1, height)
    return (
        F.when(samples < least_samples, f"samples_lt_{least_samples}")
        .when(~cy.between(0.55, 0.90), "center_y_out_sub_band")
        .when(~cx.between(0.15, 0.85), "center_x_out_sub_band")
        .when(h > max_height, f"height_gt_{max_height}")
        .when(h > w, "height_gt_width")
        .when(b.area() > width * max(1, height - crop_y) * max_area, "area_gt_maxpct_band")
        .otherwise("")
    )


def box_reason(b: Box, width: int, height: int) -> Column:
    """First geometry rule that a box in the subtitle band breaks."""
    w, h, scale = b.x2 - b.x1, b.y2 - b.y1, height / 1024.0
    return (
        F.when(~in_band(b, width, height), "center_out_sub_band")
        .when(h < 25.0 * scale, "height_lt_sub_min")
        .when(h > 100.0 * scale, "height_gt_sub_max")
        .when(w / F.greatest(F.lit(1.0), h.cast("double")) < 1.2, "aspect_lt_sub_min")
        .otherwise("")
    )


def watermark_kind(b: Box, length: Column, duration: Column, width: int, height: int, share: float = 0.8) -> Column:
    """Boxes in the band are subtitles; outside it the long ones are watermarks."""
    return F.when(in_band(b, width, height), "subtitle").when(length >= duration * share, "watermark").otherwise("subtitle")


def lane_reasons(center: Column, height: Column, lane_center: Column, lane_height: Column, tolerance: float = 0.5) -> Column:
    """All rules of the lane that a box breaks."""
    return F.array_compact(
        F.array(
            F.when(F.abs(center - lane_center) > lane_height * tolerance, "center_off_lane"),
            F.when(height < lane_height * (1 - tolerance), "too_low"),
            F.when(height > lane_height * (1 + tolerance), "too_high"),
        )
    )


def cue_violations(cues: DataFrame, keys: list[str], duration: Column) -> DataFrame:
    """Cues clipped to the duration with the rule each breaks: empty text, start
    before the one before, or an index that is not contiguous from 0."""
    w = Window.partitionBy(*keys).orderBy("ord")
    clipped = cues.withColumns({"start": F.greatest(F.lit(0), F.least("start", duration)), "end": F.greatest(F.lit(0), F.least("end", duration))})
    before, n = F.lag("start").over(w), F.row_number().over(w) - 1
    reason = (
        F.when(F.length(F.trim(F.coalesce("text", F.lit("")))) == 0, "empty_text")
        .when(F.col("end") <= F.col("start"), "out_of_range")
        .when(F.col("start") < before, "unsorted")
        .when(F.col("ord") != n, "index_gap")
        .otherwise("")
    )
    return clipped.withColumn("reason", reason)
