"""Rectangles with integer corners, as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


class Box:
    """Four corner columns under a common prefix."""

    def __init__(self, prefix: str = ""):
        self.x1, self.y1, self.x2, self.y2 = (F.col(f"{prefix}{c}") for c in ("x1", "y1", "x2", "y2"))

    @classmethod
    def of(cls, s: Column) -> Box:
        b = cls.__new__(cls)
        b.x1, b.y1, b.x2, b.y2 = (s[c] for c in ("x1", "y1", "x2", "y2"))
        return b

    def area(self) -> Column:
        zero = F.lit(0)
        return F.greatest(zero, self.x2 - self.x1) * F.greatest(zero, self.y2 - self.y1)

    def struct(self) -> Column:
        return F.struct(self.x1.alias("x1"), self.y1.alias("y1"), self.x2.alias("x2"), self.y2.alias("y2"))


def _overlap(a: Box, b: Box) -> Column:
    w, h = F.least(a.x2, b.x2) - F.greatest(a.x1, b.x1), F.least(a.y2, b.y2) - F.greatest(a.y1, b.y1)
    return F.greatest(F.lit(0), w) * F.greatest(F.lit(0), h)


def iou(a: Box, b: Box) -> Column:
    """Intersection over union; areas are at least 1."""
    inter, one = _overlap(a, b), F.lit(1)
    area = lambda x: F.greatest(one, (x.x2 - x.x1) * (x.y2 - x.y1))
    return F.when(inter > 0, inter / (area(a) + area(b) - inter)).otherwise(F.lit(0.0))


def iou_floored_union(a: Box, b: Box) -> Column:
    """Intersection over union; the union is at least 1, areas may be 0."""
    inter = _overlap(a, b)
    return inter / F.greatest(F.lit(1), a.area() + b.area() - inter)


def dilate(b: Box, px: int, py: int, width: int, height: int) -> Column:
    """Grown by ``px`` and ``py`` (not under 0) and held in the frame."""
    px, py = max(0, px), max(0, py)
    return F.struct(
        F.greatest(F.lit(0), b.x1 - px).alias("x1"), F.greatest(F.lit(0), b.y1 - py).alias("y1"),
        F.least(F.lit(width), b.x2 + px).alias("x2"), F.least(F.lit(height), b.y2 + py).alias("y2"),
    )


def intersect(a: Box, b: Box) -> Column:
    """Common part, or NULL."""
    s = F.struct(
        F.greatest(a.x1, b.x1).alias("x1"), F.greatest(a.y1, b.y1).alias("y1"), F.least(a.x2, b.x2).alias("x2"), F.least(a.y2, b.y2).alias("y2")
    )
    return F.when((s["x2"] > s["x1"]) & (s["y2"] > s["y1"]), s)


def contains(outer: Box, inner: Box) -> Column:
    return (outer.x1 <= inner.x1) & (outer.y1 <= inner.y1) & (outer.x2 >= inner.x2) & (outer.y2 >= inner.y2)


def chebyshev(a: Box, b: Box) -> Column:
    """The larger of the horizontal and vertical distance; 0 when they meet."""
    zero = F.lit(0)
    return F.greatest(zero, a.x1 - b.x2, b.x1 - a.x2, a.y1 - b.y2, b.y1 - a.y2)


def near(a: Box, b: Box, share: float, pixels: int) -> Column:
    """Enough common area, or no further apart than ``pixels`` in either axis."""
    return (iou_floored_union(a, b) >= share) | (chebyshev(a, b) <= pixels)


def grow_to(b: Box, width: Column, height: Column, frame_w: int, frame_h: int) -> Column:
    """Grown around its middle to at least ``width`` x ``height`` in the frame."""

    def axis(lo: Column, hi: Column, want: Column, limit: int) -> tuple[Column, Column]:
        size = F.least(F.lit(limit), F.greatest(hi - lo, want))
        first = F.floor((lo + hi - size) / 2)
        first = F.greatest(F.lit(0), F.least(first, F.lit(limit) - size))
        return first, first + size

    (x1, x2), (y1, y2) = axis(b.x1, b.x2, width, frame_w), axis(b.y1, b.y2, height, frame_h)
    return F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))


def envelope(points: Column) -> Column:
    """Box around an array of ``struct(x, y)``."""
    ends = lambda c: (F.array_min(F.transform(points, lambda p: p[c])), F.array_max(F.transform(points, lambda p: p[c])))
    (x1, x2), (y1, y2) = ends("x"), ends("y")
    return F.when(F.size(points) > 0, F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2")))


def in_band(b: Box, width: int, height: int, y: tuple[float, float] = (0.55, 0.90), x: tuple[float, float] = (0.15, 0.85)) -> Column:
    """Whether the middle lies in a share of the frame, edges included."""
    return ((b.x1 + b.x2) / 2.0 / max(1, width)).between(*x) & ((b.y1 + b.y2) / 2.0 / max(1, height)).between(*y)


def greedy_keep(items: Column, order: Column, share: float) -> Column:
    """Of ``array<struct<..., x1, y1, x2, y2>>`` sorted by ``order`` those that
    overlap no kept one by ``share`` or more.  ``order`` is a comparator-ready
    array: pass ``items`` itself when its leading fields are the sort key."""
    kept = F.filter(items, lambda _: F.lit(False))
    return F.aggregate(
        F.array_sort(order),
        kept,
        lambda acc, x: F.when(F.forall(acc, lambda k: iou(Box.of(x), Box.of(k)) < share), F.concat(acc, F.array(x))).otherwise(acc),
    )


def connected_rect(items: Column, margin: int) -> Column:
    """Envelope ``struct<x1, y1, x2, y2>`` of what the lowest rectangle (by its middle,
    then the larger, then the later by ``ord``) of ``array<struct<ord, x1, y1, x2, y2>>``
    reaches: rectangles that meet the envelope so far grown by ``margin``.

    What the envelope holds changes it no more, so all are tried in each round; a
    round that reaches nothing new is followed by none that does, and every other
    one reaches a rectangle at least: as many rounds as rectangles suffice."""

    def grown(g: Column, r: Column) -> Column:
        meets = (F.least(r["x2"], g["x2"] + margin) > F.greatest(r["x1"], g["x1"] - margin)) & (F.least(r["y2"], g["y2"] + margin) > F.greatest(r["y1"], g["y1"] - margin))
        return F.when(meets, F.struct(F.least(g["x1"], r["x1"]).alias("x1"), F.least(g["y1"], r["y1"]).alias("y1"), F.greatest(g["x2"], r["x2"]).alias("x2"), F.greatest(g["y2"], r["y2"]).alias("y2"))).otherwise(g)

    corners = ("x1", "y1", "x2", "y2")
    area = lambda r: (r["x2"] - r["x1"]).cast("long") * (r["y2"] - r["y1"])
    lowest = F.array_max(F.transform(items, lambda r: F.struct((r["y1"] + r["y2"]).alias("low"), area(r).alias("area"), r["ord"].alias("ord"), *[r[c].alias(c) for c in corners])))
    sure = lambda s: F.struct(*[F.coalesce(s[c], F.lit(0)).alias(c) for c in corners])
    return F.aggregate(F.slice(items, 2, F.size(items)), sure(lowest), lambda g, _: F.aggregate(items, g, grown))


def priority(score: Column, text_is_cjk: Column, area: Column, good: float = 0.3) -> Column:
    """Score with bonuses for script, for a good score and for size (capped)."""
    return score + F.when(text_is_cjk, 1.0).otherwise(0.0) + F.when(score >= good, 0.35).otherwise(0.0) + F.least(F.lit(0.25), area / 50000.0)
