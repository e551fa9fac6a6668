"""Composites: cover events, layout audits and detector confirmation."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapwing.functions import geometry as geo
from lapwing.functions.geometry import Box
from lapwing.operators import filters as fl
from lapwing.operators import intervals as iv
from lapwing.operators import joins as jn


def confirm_detections(df: DataFrame, keys: Sequence[str], main: str, other: str, width: int, height: int, least_score: float = 0.3, share: float = 0.5) -> DataFrame:
    """Each detection's first reason to be rejected, or '': inside the band the
    geometry rules; outside it the main detector needs a score and script, and the
    other one a kept box of the main one that it overlaps in the same frame."""
    inside = geo.in_band(Box(), width, height)
    own = F.when(inside, fl.box_reason(Box(), width, height)).when(
        F.col("detector") == main, F.when(F.col("score") < least_score, "score").when(~F.col("cjk"), "script").otherwise("")
    )
    rows = df.withColumn("reason", own)
    kept = rows.where((F.col("detector") == main) & ~inside & (F.col("reason") == "")).select(*keys, *[F.col(c).alias(f"r_{c}") for c in ("x1", "y1", "x2", "y2")])
    asked = rows.where((F.col("detector") == other) & ~inside).select(*keys, "ord", "x1", "y1", "x2", "y2")
    best = asked.join(kept, list(keys)).groupBy(*keys, "ord").agg(F.max(geo.iou(Box(), Box("r_"))).alias("_best"))
    rows = rows.join(best, [*keys, "ord"], "left")
    confirmed = F.when(F.coalesce(F.col("_best"), F.lit(0.0)) >= share, "").otherwise("unconfirmed")
    return rows.withColumn("reason", F.coalesce("reason", confirmed)).drop("_best")


def cover_events(cues: DataFrame, clusters: DataFrame, keys: Sequence[str], size: int, reach: int, pad: int) -> DataFrame:
    """Clusters grown to windows and tiled by the cues matched to them; a cluster
    without cues is one event without text.  ``cluster, cue, start, end``."""
    windows = iv.padded_windows(clusters.withColumn("ord", F.col("index")), keys, pad).select(*keys, "index", F.col("cover_start").alias("lo"), F.col("cover_end").alias("hi"))
    matched = jn.match_clusters(cues, clusters, keys, size, reach).select(*keys, "ord", "start", F.col("r_index").alias("index"))
    rows = matched.join(windows, [*keys, "index"])
    held = rows.withColumn("start", F.greatest("lo", F.least("hi", "start")))
    tiles = iv.tile(held, [*keys, "index"]).select(*keys, "index", F.col("ord").alias("cue"), F.col("tile_start").alias("start"), F.col("tile_end").alias("end"))
    orphans = windows.join(matched.select(*keys, "index").distinct(), [*keys, "index"], "left_anti")
    orphans = orphans.select(*keys, "index", F.lit(None).cast("bigint").alias("cue"), F.col("lo").alias("start"), F.col("hi").alias("end"))
    events = tiles.unionByName(orphans).where("end > start")
    n = F.row_number().over(Window.partitionBy(*keys).orderBy("start", "end", "index", "cue")) - 1
    return events.withColumn("event", n)


def segment_clusters(spans: DataFrame, keys: Sequence[str], gap: int, pad: int, context: int, duration: Column, share: float = 0.65) -> DataFrame:
    """Spans merged within ``gap``, padded, with a context of a least length around
    them that stays in the duration, and their rectangles without duplicates."""
    boxes = F.collect_list(F.struct("y1", "x1", "y2", "x2"))
    rows = iv.islands(spans, keys, tolerance=gap, extra=[boxes.alias("rects"), F.max(duration).alias("_d")])
    start, end = F.greatest(F.lit(0), F.col("start") - pad), F.least("_d", F.col("end") + pad)
    rows = rows.withColumns({"start": start, "end": end}).where("end > start")
    middle2, short = F.col("start") + F.col("end"), F.col("end") - F.col("start") < context
    a = F.greatest(F.lit(0), F.floor((middle2 - context) / 2))
    b = F.least("_d", F.floor((middle2 + context) / 2))
    a2 = F.when((b - a < context) & (b >= F.col("_d")), F.greatest(F.lit(0), F.col("_d") - context)).otherwise(a)
    b2 = F.when((b - a < context) & (a <= 0), F.least("_d", F.lit(context))).otherwise(b)
    rows = rows.withColumns({"context_start": F.when(short, a2).otherwise(F.col("start")), "context_end": F.when(short, b2).otherwise(F.col("end"))})
    return rows.withColumn("rects", geo.greedy_keep(F.col("rects"), F.col("rects"), share)).drop("island", "_d")


def layout_audit(events: DataFrame, keys: Sequence[str], lane_top: int, lane_bottom: int, width: int, height: int) -> DataFrame:
    """Events out of the frame, out of the lane, and the share inside it."""
    out = (F.col("x1") < 0) | (F.col("y1") < 0) | (F.col("x2") > width) | (F.col("y2") > height)
    above, inside = F.col("y1") < lane_top, (F.col("y1") >= lane_top) & (F.col("y2") <= lane_bottom)
    return events.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_if(out).alias("outside"), F.count_if(above).alias("above"), (F.count_if(inside) / F.count(F.lit(1))).alias("support"))


def anchor_text(block_top: Column, block_bottom: Column, y: Column, ref_top: Column, ref_bottom: Column, margin: int) -> Column:
    """A text's y, moved to the middle of its reference if its block has no
    vertical contact with the reference grown by ``margin``."""
    apart = (block_bottom < ref_top - margin) | (block_top > ref_bottom + margin)
    return F.when(apart, F.bround((ref_top + ref_bottom) / 2).cast("int")).otherwise(y)


def recover_gaps(lines: DataFrame, readers: Sequence[tuple[DataFrame, int]], keys: Sequence[str], merge: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Lines with what each reader in turn finds in the gaps that are still longer
    than its limit, accepted by middle and cut to the gap; ``merge`` is applied to
    the lines after each reader.

    A key's gaps are disjoint, so the one that holds a middle is the last to begin
    before it: one sort of both, no pairs."""
    for found, least in readers:
        gaps = iv.internal_gaps(lines, keys, least=least).select(*keys, (2 * F.col("gap_start")).alias("_gap"), "gap_start", "gap_end")
        new = iv.as_of(found.withColumn("_middle", F.col("start") + F.col("end")), gaps, keys, "_middle", "_gap", "_gap")
        new = new.join(gaps, [*keys, "_gap"]).where((F.col("_middle") > F.col("_gap")) & (F.col("_middle") < 2 * F.col("gap_end")))
        new = new.withColumns({"start": F.greatest("start", "gap_start"), "end": F.least("end", "gap_end")})
        lines = lines.unionByName(new.select(*lines.columns))
        lines = merge(lines) if merge else lines
    return lines


def prefer_visual(lines: DataFrame, visual: DataFrame, keys: Sequence[str], size: int, edge: int) -> DataFrame:
    """Lines in conflict with no visual line and not closely between two of them,
    and the visual lines."""
    pairs = iv.bucketed_pairs(lines, visual.drop("ord"), keys, size, edge)
    s, e, s2, e2 = (F.col(c) for c in ("start", "end", "r_start", "r_end"))
    conflict = pairs.where(iv.time_conflicts(s, e, s2, e2, edge)).select(*keys, "ord").distinct()
    left = lines.join(conflict, [*keys, "ord"], "left_anti")
    left = iv.as_of(left, visual.select(*keys, F.col("end").alias("v")), keys, "start", "v", "_before")
    left = iv.as_of(left, visual.select(*keys, F.col("start").alias("v")), keys, "end", "v", "_after", forward=True)
    between = (F.col("start") - F.col("_before") <= 3 * edge) & (F.col("_after") - F.col("end") <= 3 * edge)
    kept = left.where(~F.coalesce(between, F.lit(False))).select(*lines.columns)
    return kept.withColumn("origin", F.lit("kept")).unionByName(visual.select(*lines.columns).withColumn("origin", F.lit("visual")))


def replace_where_refined(lines: DataFrame, fresh: DataFrame, keys: Sequence[str], longest: int) -> DataFrame:
    """Lines longer than ``longest`` give way to the fresh lines read for them, if
    there are any (``of``: the line a fresh one was read for)."""
    has = fresh.select(*keys, F.col("of").alias("ord")).distinct()
    kept = lines.join(has, [*keys, "ord"], "left_anti").unionByName(lines.where(F.col("end") - F.col("start") <= longest).join(has, [*keys, "ord"], "left_semi"))
    long = lines.where(F.col("end") - F.col("start") > longest).select(*keys, F.col("ord").alias("of"))
    return kept.unionByName(fresh.join(long, [*keys, "of"], "left_semi").select(*lines.columns))


def reference_rects(clusters: DataFrame, detections: DataFrame, keys: Sequence[str], size: int, margin: int, lane: Column) -> DataFrame:
    """Per cluster (``index, start, end`` and its own box) the envelope of the lane
    detections within ``margin`` of its time; its own box where there are none."""
    points = detections.where(lane).withColumns({"start": F.col("at"), "end": F.col("at")})
    pairs = iv.bucketed_pairs(clusters, points, keys, size, margin).where((F.col("r_at") >= F.col("start") - margin) & (F.col("r_at") <= F.col("end") + margin))
    seen = pairs.groupBy(*keys, "index").agg(F.min("r_x1").alias("_x1"), F.min("r_y1").alias("_y1"), F.max("r_x2").alias("_x2"), F.max("r_y2").alias("_y2"), F.count(F.lit(1)).alias("support"))
    rows = clusters.join(seen, [*keys, "index"], "left")
    return rows.select(*keys, "index", "start", "end", *[F.coalesce(f"_{c}", c).alias(c) for c in ("x1", "y1", "x2", "y2")], F.coalesce("support", F.lit(0)).alias("support"))


def event_rects(events: DataFrame, detections: DataFrame, keys: Sequence[str], size: int, guard: int, gate: int, grow: int, width: int, height: int) -> DataFrame:
    """Per event the box to cover: the envelope of the band detections active
    within ``guard`` that meet the event's reference box grown by ``gate``, grown by
    ``grow``; the reference box itself where none do."""
    active = iv.bucketed_pairs(events, detections.where(geo.in_band(Box(), width, height)).withColumns({"start": F.col("at"), "end": F.col("at")}), keys, size, guard)
    active = active.where((F.col("r_at") >= F.col("start") - guard) & (F.col("r_at") <= F.col("end") + guard))
    near = (F.col("r_x1") < F.col("x2") + gate) & (F.col("r_x2") > F.col("x1") - gate) & (F.col("r_y1") < F.col("y2") + gate) & (F.col("r_y2") > F.col("y1") - gate)
    u = active.where(near).groupBy(*keys, "index").agg(F.min("r_x1").alias("_x1"), F.min("r_y1").alias("_y1"), F.max("r_x2").alias("_x2"), F.max("r_y2").alias("_y2"), F.count(F.lit(1)).alias("accepted"))
    rows = events.join(u, [*keys, "index"], "left").withColumns({c: F.coalesce(f"_{c}", c) for c in ("x1", "y1", "x2", "y2")})
    d = geo.dilate(Box(), grow, grow, width, height)
    return rows.select(*keys, "index", d.alias("d"), F.coalesce("accepted", F.lit(0)).alias("accepted")).select(*keys, "index", "d.*", "accepted")


def watermark_rects(spans: DataFrame, keys: Sequence[str], fixed: Sequence[tuple[int, int, int, int]], share: float = 0.65) -> DataFrame:
    """Rectangles of a whole-video cluster: the spans' and the configured ones,
    without duplicates."""
    from lapwing.operators.rectangles import dedupe_rects

    given = F.explode(F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(("x1", "y1", "x2", "y2"), b)]) for b in fixed]))
    extra = spans.select(*keys).distinct().select(*keys, given.alias("b")).select(*keys, "b.*")
    return dedupe_rects(spans.select(*keys, "x1", "y1", "x2", "y2").unionByName(extra), keys, share)


def mask_pipeline(detections: DataFrame, key: str, fps: float, width: int, height: int) -> DataFrame:
    """Detections to subtitle clusters: confirmed, suppressed, tracked to spans,
    filtered by geometry, merged in time.  ``detections``: ``frame, ord, detector,
    score, cjk`` and a box."""
    from lapwing.operators import folds
    from lapwing.operators.rectangles import suppress

    good = confirm_detections(detections, [key, "frame"], "a", "b", width, height).where("reason = ''")
    good = suppress(good.select(key, "frame", "ord", "score", "x1", "y1", "x2", "y2"), [key, "frame"], F.col("score"), 0.55)

    def fold(rows: list[dict]) -> list[dict]:
        spans = folds.merge_spans(folds.spans(rows, fps, 0.25, max(2, round(fps * 0.6))))
        return [{**s, "start": int(s["start"] * 1000), "end": int(s["end"] * 1000)} for s in spans]

    spans = folds.fold_per_key(good, [key], fold, "start long, end long, x1 int, y1 int, x2 int, y2 int, samples long", ["frame", "y1", "x1", "ord"])
    spans = spans.withColumn("reason", fl.span_reason(Box(), F.col("samples"), width, height, height // 2, 1)).where("reason = ''")
    return segment_clusters(spans, [key], 500, 250, 1500, F.lit(1 << 40))


def cue_pipeline(cues: DataFrame, clusters: DataFrame, keys: Sequence[str], size: int, reach: int, least: int) -> DataFrame:
    """Cues gated to their clusters (cut to the best one, short ones dropped) and
    the clusters left without a cue, to be read again: ``origin`` tells which."""
    best = jn.match_clusters(cues, clusters, keys, size, reach)
    gated = best.select(*keys, "ord", F.col("r_index").alias("index"), F.greatest("start", "r_start").alias("start"), F.least("end", "r_end").alias("end"))
    kept = gated.where(F.col("end") - F.col("start") >= least).withColumn("origin", F.lit("cue"))
    missed = clusters.join(kept.select(*keys, "index").distinct(), [*keys, "index"], "left_anti")
    again = missed.select(*keys, F.lit(-1).cast("bigint").alias("ord"), "index", "start", "end", F.lit("retry").alias("origin"))
    return kept.unionByName(again)


def mix_manifest(schedules: DataFrame, keys: Sequence[str], stems: Sequence[str], video: Column) -> DataFrame:
    """Per video whether the schedule is a chain (each row's ``previous_offset`` is
    the actual one), ends in the video, and has exactly the named stems."""
    w = Window.partitionBy(*keys).orderBy("ord")
    rows = schedules.withColumn("_chain", F.coalesce(F.col("previous_offset") == F.lag("offset").over(w), F.col("previous_offset").isNull()))
    want = F.array(*[F.lit(s) for s in sorted(stems)])
    return rows.groupBy(*keys).agg(
        F.bool_and("_chain").alias("chained"), (F.max("offset") <= F.max(video) - 1).alias("inside"), (F.sort_array(F.collect_set("stem")) == want).alias("stems"), F.max("offset").alias("last")
    )
