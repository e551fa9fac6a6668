"""Timelines of one key moved, slotted and audited, by windows and per-key sums."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapwing.operators import intervals as iv

# Seconds a line lasts at least, between lines that are shared out,
# and by which a timeline may exceed its clip.
LEAST, SHARED_LEAST, PAUSE, START_OVER, END_OVER = 0.4, 0.7, 0.18, 0.5, 2.0


def rebase(lines: DataFrame, keys: Sequence[str], segment_start: float, duration: float) -> DataFrame:
    """``start, end`` of spoken lines (``ord, text``) as seconds of their clip.

    Lines without text go.  A key's times are kept, or moved back by the segment's
    start, or by its own first start: the first of these under which they begin
    inside the clip and cover enough of it.  Moving is monotone, so whether an
    offset will do follows from a key's least and largest times.  If none does, the
    clip is shared out in proportion to the texts' lengths.  ``how`` tells which."""
    w = Window.partitionBy(*keys)
    rows = lines.withColumn("text", F.trim("text")).where("text != ''")
    rows = rows.withColumns({"end": F.greatest("end", F.col("start") + 0.5), "start": F.greatest(F.lit(0.0), "start")})
    rows = rows.withColumns({"_first": F.min("start").over(w), "_last": F.max("start").over(w), "_stop": F.max("end").over(w)})

    def moved(start: Column, end: Column, by: Column) -> tuple[Column, Column]:
        return F.greatest(F.lit(0.0), start - by), F.least(F.lit(duration), F.greatest(F.lit(LEAST), end - by))

    def will_do(first: Column, last: Column, stop: Column) -> Column:
        return (last < duration + START_OVER) & (stop - first >= min(6.0, 0.35 * duration))

    offsets = {"segment": F.lit(segment_start), "first": F.col("_first")}
    how = F.when(will_do(F.col("_first"), F.col("_last"), F.col("_stop")) & (F.col("_stop") <= duration + END_OVER), "kept")
    for name, by in offsets.items():
        first, last = (moved(F.col(c), F.col(c), by)[0] for c in ("_first", "_last"))
        how = how.when(will_do(first, last, moved(F.col("_stop"), F.col("_stop"), by)[1]), name)
    rows = rows.withColumn("how", how.otherwise("shared"))
    # Shared out: every line starts where those before it and the pauses end.
    weight = F.greatest(F.lit(8), F.length("text"))
    n, total = F.count(F.lit(1)).over(w), F.sum(weight).over(w)
    # Exact until it is divided: rounded results that lie halfway would go astray.
    room = F.greatest(F.lit(Decimal(1)), F.lit(Decimal(str(duration))) - F.lit(Decimal(str(PAUSE))) * (n - 1))
    ordered = w.orderBy("start", "ord")
    rows = rows.withColumns({"_long": F.greatest(F.lit(SHARED_LEAST), (room * weight).cast("double") / total), "_left": n - F.row_number().over(ordered)})
    before = F.coalesce(F.sum(F.col("_long") + PAUSE).over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rows = rows.withColumn("_at", F.least(F.lit(duration), before))
    limit = F.lit(duration)
    shared = F.when(F.col("_left") == 0, limit).otherwise(F.least(limit, F.col("_at") + F.col("_long")))
    options = {
        "kept": (F.least(limit, "start"), F.least(limit, F.greatest(F.col("start") + LEAST, F.col("end")))),
        **{name: moved(F.col("start"), F.col("end"), by) for name, by in offsets.items()},
        "shared": (F.col("_at"), F.least(limit, F.greatest(F.col("_at") + LEAST, shared))),
    }
    pick = lambda k: F.coalesce(*[F.when(F.col("how") == name, both[k]) for name, both in options.items()])
    return rows.select(*keys, "ord", "text", pick(0).alias("start"), pick(1).alias("end"), "how")


def voice_slots(clips: DataFrame, keys: Sequence[str], total: Column, overflow: float = 1.0, speed: float = 1.02) -> DataFrame:
    """Clips (``ord, start, duration``) with their end and what spills past the next
    start.  The clip that ends last, if it ends beyond ``total``, is fitted to what
    is left (``fit``), or an error where that takes too much."""
    w = Window.partitionBy(*keys)
    after = F.lead("start").over(w.orderBy("start", "ord"))
    rows = clips.withColumns({"end": F.col("start") + F.col("duration"), "_total": total})
    rows = rows.withColumns({"spill": F.coalesce(F.greatest(F.lit(0.0), F.col("end") - after), F.lit(0.0)), "_last": F.row_number().over(w.orderBy(F.desc("end"), "start", "ord")) == 1})
    room = F.greatest(F.lit(0.0), F.col("_total") - F.col("start"))
    over = F.col("_last") & (F.col("end") > F.col("_total"))
    wrong = (F.col("end") - F.col("_total") > overflow) | (room <= 0.05) | (F.col("duration") > room * speed)
    rows = rows.withColumns({"error": F.when(over & wrong, "ends beyond the video").otherwise(""), "fit": F.when(over & ~wrong, room)})
    return rows.withColumn("end", F.when(F.col("fit").isNotNull(), F.col("_total")).otherwise(F.col("end"))).drop("_total", "_last")


# --- which track shows a text ------------------------------------------------


def event_pool(events: DataFrame, detections: DataFrame, keys: Sequence[str], size: int, guard: int) -> DataFrame:
    """The detections (``at``) to choose from for each event (``index, start, end``):
    those in its time; where there are none, those within ``guard`` of it; where
    there are none either, all of its key.  Detections come with the prefix ``r_``."""
    points = detections.withColumns({"start": F.col("at"), "end": F.col("at")})
    near = iv.bucketed_pairs(events, points, keys, size, guard)
    near = near.withColumn("_core", (F.col("r_at") >= F.col("start")) & (F.col("r_at") <= F.col("end")))
    near = near.withColumn("_any", F.bool_or("_core").over(Window.partitionBy(*keys, "index"))).where("_core or not _any").drop("_core", "_any")
    alone = events.join(near.select(*keys, "index").distinct(), [*keys, "index"], "left_anti")
    every = alone.join(points.select(*keys, *[F.col(c).alias(f"r_{c}") for c in points.columns if c not in keys]), list(keys))
    return near.unionByName(every)


def best_track(tracked: DataFrame, keys: Sequence[str], track: str, alike: Column, lane: tuple[float, float, float, float], threshold: float = 0.42) -> DataFrame:
    """Per key the track that shows its text: by the number of detections alike
    from ``threshold`` on, the best likeness, the least distance of its median
    centre from the lane ``(x, y, tolerance x, tolerance y)``, its length, its
    number.  ``tracked`` has a box; ``track, hits, alike, detections`` come back."""
    x, y, tx, ty = lane
    middle = lambda a, b: F.median((F.col(a) + F.col(b)) / 2.0)
    off = F.abs(middle("x1", "x2") - x) / max(1.0, tx) + F.abs(middle("y1", "y2") - y) / max(1.0, ty)
    each = tracked.withColumn("_alike", alike).groupBy(*keys, track).agg(
        F.count_if(F.col("_alike") >= threshold).alias("hits"), F.max("_alike").alias("alike"), off.alias("_off"), F.count(F.lit(1)).alias("detections")
    )
    rank = F.struct("hits", "alike", -F.col("_off"), "detections", -F.col(track))
    return each.groupBy(*keys).agg(F.max_by(F.struct(track, "hits", "alike", "detections"), rank).alias("b")).select(*keys, "b.*")


# --- cut, look again ---------------------------------------------------------


def audit_until_clean(detect: Callable[[DataFrame | None], DataFrame], threshold: float, passes: int, score: str = "score") -> tuple[DataFrame, DataFrame]:
    """What up to ``passes`` rounds cut, and what a last look finds.

    ``detect`` looks at the timeline without the cuts so far (None: none yet) and
    gives scored candidates.  A round cuts those from ``threshold`` on; a key
    without any is done.  The last look's candidates have ``failed`` where they
    should have been cut: the limit was reached with these left."""
    cuts = None
    for k in range(passes):
        found = detect(cuts).where(F.col(score) >= threshold).withColumn("pass", F.lit(k + 1))
        cuts = found if cuts is None else cuts.unionByName(found)
    return cuts, detect(cuts).withColumn("failed", F.col(score) >= threshold)
