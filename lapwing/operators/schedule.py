"""Scheduling recurrences with a closed form.

``onset(i) = max(anchor(i), end(i - 1) + gap)`` is max-plus linear in whole
samples: with ``P`` the running length of clips and gaps before ``i``,
``onset(i) = P(i) + max over j <= i of (anchor(j) - P(j))``.  A running sum and a
running maximum replace the scan, exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fixed_rate(df: DataFrame, keys: Sequence[str], anchor: str, length: str, gap: int, order: str = "ord") -> DataFrame:
    """``onset, offset, lag, previous_gap`` of clips that never overlap."""
    w = Window.partitionBy(*keys).orderBy(order)
    before = F.coalesce(F.sum(F.col(length) + gap).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    df = df.withColumn("_p", before)
    onset = F.col("_p") + F.max(F.col(anchor) - F.col("_p")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    df = df.withColumn("onset", onset).withColumn("offset", F.col("onset") + F.col(length))
    return df.withColumns({"lag": F.col("onset") - F.col(anchor), "previous_gap": F.col("onset") - F.lag("offset").over(w)}).drop("_p")


def sample_schedule(df: DataFrame, keys: Sequence[str], gap: int, longest_lag: int, video: Column, order: str = "ord") -> DataFrame:
    """Placement of decoded clips whose speech starts ``detected_onset`` samples
    in and ends (inclusive) at ``detected_offset``; ``fits`` tells whether lag and
    end are within bounds, ``valid`` whether all cues up to this one fit."""
    w = Window.partitionBy(*keys).orderBy(order)
    df = df.withColumn("_anchor", F.greatest("anchor", "detected_onset")).withColumn("_len", F.col("detected_offset") - F.col("detected_onset"))
    df = fixed_rate(df, keys, "_anchor", "_len", gap, order).drop("lag", "_anchor", "_len")
    df = df.withColumnsRenamed({"onset": "actual_onset", "offset": "actual_offset"})
    df = df.withColumns({"placement": F.col("actual_onset") - F.col("detected_onset"), "lag": F.col("actual_onset") - F.col("anchor")})
    fits = (F.col("lag") <= longest_lag) & (F.col("actual_offset") <= video - 1)
    return df.withColumn("fits", fits).withColumn("valid", F.min("fits").over(w.rowsBetween(Window.unboundedPreceding, 0)))


def cascade_anchor(df: DataFrame, keys: Sequence[str], breath: int, duration: Column, order: str = "ord") -> DataFrame:
    """Where a cue must end: the next start; no later than ``breath`` after its
    own end where the cluster changes or nothing follows."""
    w = Window.partitionBy(*keys).orderBy(order)
    start, cluster = F.lead("start").over(w), F.lead("cluster").over(w)
    own = F.col("end") + breath
    anchor = F.when(start.isNull(), F.least(duration, own)).when(cluster == F.col("cluster"), F.least(duration, start)).otherwise(F.least(duration, own, start))
    return df.withColumn("anchor", anchor)


def speech_slots(df: DataFrame, keys: Sequence[str], gap: int, tail: int, duration: Column, soft: float, hard: float, order: str = "ord") -> DataFrame:
    """Independent slots: a clip may last until ``tail`` after its speech, but not
    into the next one; beyond the soft speed the hard one is allowed."""
    nxt = F.lead("start").over(Window.partitionBy(*keys).orderBy(order))
    anchor = F.least(duration, F.col("end") + tail)
    anchor = F.least(anchor, F.coalesce(nxt - gap, anchor))
    target = anchor - F.col("start")
    need = F.when(target > 0, F.col("clip") / target)
    speed = F.when(F.col("clip") <= target, 1.0).otherwise(F.least(F.when(need > soft + 1e-9, hard).otherwise(soft), need))
    return df.withColumns({"anchor": anchor, "target": target, "needed": need, "speed": F.when(target > 0, speed)})


def clamp_speech(start: Column, end: Column, visual: Column, early: int, late: int, least: int) -> Column:
    """``struct(start, end)``: a speech start held near the visual one, the
    duration kept (``least`` at least)."""
    s = F.least(visual + late, F.greatest(F.greatest(F.lit(0), visual - early), start))
    return F.struct(s.alias("start"), (s + F.greatest(F.lit(least), end - start)).alias("end"))


def slot(df: DataFrame, keys: Sequence[str], gap: int, least: int, natural_least: int, total: Column, order: str = "ord") -> DataFrame:
    """``slot``: a line's own length, but not into the next line."""
    nxt = F.coalesce(F.lead("start").over(Window.partitionBy(*keys).orderBy(order)), total)
    natural = F.greatest(F.lit(natural_least), F.col("end") - F.col("start"))
    return df.withColumn("slot", F.greatest(F.lit(least), F.least(natural, F.greatest(F.lit(least), nxt - F.col("start") - gap))))


def schedule_violations(df: DataFrame, keys: Sequence[str], gap: int, longest_lag: int, duration: Column, order: str = "ord") -> DataFrame:
    """Rows of a schedule (``start, end, anchor``) that break a rule, with all the
    rules that they break."""
    before = F.lag("end").over(Window.partitionBy(*keys).orderBy(order))
    rules = F.array_compact(
        F.array(
            F.when(F.col("start") - before < gap, "gap"),
            F.when(F.col("start") - F.col("anchor") > longest_lag, "lag"),
            F.when(F.col("end") > duration, "end"),
        )
    )
    return df.withColumn("rules", rules).where(F.size("rules") > 0)


def proportional(df: DataFrame, keys: Sequence[str], weight: str, order: str) -> DataFrame:
    """``[start, end]`` of a row shared out among its parts by weight; the last
    part ends exactly."""
    w = Window.partitionBy(*keys).orderBy(order)
    run = F.sum(weight).over(w.rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum(weight).over(Window.partitionBy(*keys))
    length = F.col("end") - F.col("start")
    last = F.lead(weight).over(w).isNull()
    return df.withColumns(
        {
            "part_start": F.col("start") + length * (run - F.col(weight)) / total,
            "part_end": F.when(last, F.col("end").cast("double")).otherwise(F.col("start") + length * run / total),
        }
    )


def global_timeline(items: DataFrame, order: str, duration: str) -> DataFrame:
    """``offset`` of each item when all are laid end to end.

    The running sum goes over items in order in two steps, so it is no single
    task's work: sums of slices of the order first, then within each slice."""
    n = 1024
    sliced = items.withColumn("_slice", F.floor(F.col(order) / F.lit(n)))
    sums = sliced.groupBy("_slice").agg(F.sum(duration).alias("_sum"))
    before = F.coalesce(F.sum("_sum").over(Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = sums.select("_slice", before.alias("_base"))
    inside = F.sum(duration).over(Window.partitionBy("_slice").orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    return sliced.join(base, "_slice").withColumn("offset", F.col("_base") + F.coalesce(inside, F.lit(0))).drop("_slice", "_base")
