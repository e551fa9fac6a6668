"""Scalar time and number functions, as expressions that stay in codegen.

Formatting takes whole units (milliseconds, centiseconds, seconds) where a result
must be exact: rounding a binary fraction of a second differs between engines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_seconds(text: Column) -> Column:
    """``HH:MM:SS``, ``MM:SS``, ``SS`` or a number, comma or point; else NULL."""
    t = F.replace(F.trim(text), F.lit(","), F.lit("."))
    parts = F.split(t, ":")
    numbers = F.transform(parts, lambda p: p.try_cast("double"))
    total = F.aggregate(numbers, F.lit(0.0), lambda a, x: a * 60.0 + x)
    fine = (F.length(t) > 0) & (F.size(parts) <= 3) & F.forall(numbers, lambda x: x.isNotNull())
    return F.when(fine, total)


def hms(seconds: Column) -> Column:
    """``HH:MM:SS``, truncated, floor at 0."""
    t = F.greatest(seconds.cast("bigint"), F.lit(0))
    return F.format_string("%02d:%02d:%02d", F.floor(t / 3600), F.floor(t % 3600 / 60), t % 60)


def srt_time(millis: Column) -> Column:
    """``HH:MM:SS,mmm`` of whole milliseconds."""
    t = F.greatest(millis.cast("bigint"), F.lit(0))
    return F.format_string("%02d:%02d:%02d,%03d", F.floor(t / 3600000), F.floor(t % 3600000 / 60000), F.floor(t % 60000 / 1000), t % 1000)


def ass_time(centis: Column) -> Column:
    """``H:MM:SS.cc`` of whole centiseconds, with full carry."""
    t = F.greatest(centis.cast("bigint"), F.lit(0))
    return F.format_string("%d:%02d:%02d.%02d", F.floor(t / 360000), F.floor(t % 360000 / 6000), F.floor(t % 6000 / 100), t % 100)


def ass_time_short_carry(millis: Column) -> Column:
    """``H:MM:SS.cc`` whose carry stops at the seconds, so ``:60`` can appear;
    kept for readers of files written that way.  Half-even on centiseconds."""
    t = F.greatest(millis.cast("bigint"), F.lit(0))
    rest = t % 1000
    down, left = F.floor(rest / 10), rest % 10
    centis = down + F.when((left > 5) | ((left == 5) & (down % 2 == 1)), 1).otherwise(0)
    over = (centis >= 100).cast("int")
    return F.format_string("%d:%02d:%02d.%02d", F.floor(t / 3600000), F.floor(t % 3600000 / 60000), F.floor(t % 60000 / 1000) + over, centis - 100 * over)


def clock(seconds: Column) -> Column:
    """``MM:SS`` of whole seconds."""
    return F.format_string("%02d:%02d", F.floor(seconds / 60), seconds % 60)


def publish_at(part: Column, base_part: int, base_date: str, slots: list[str], offset_minutes: int) -> Column:
    """UTC time of a part in a calendar of daily slots; '' before the base."""
    n = part - F.lit(base_part)
    day = F.floor(n / len(slots)).cast("int")
    slot = F.element_at(F.array(*[F.lit(s) for s in slots]), (F.pmod(n, F.lit(len(slots))) + 1).cast("int"))
    local = F.to_timestamp_ntz(F.concat_ws(" ", F.date_add(F.lit(base_date).cast("date"), day).cast("string"), F.concat(slot, F.lit(":00"))), F.lit("yyyy-MM-dd HH:mm:ss"))
    utc = F.timestamp_add("MINUTE", F.lit(-offset_minutes), local)
    return F.when(n < 0, "").otherwise(F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))


def rfc3339_ok(text: Column) -> Column:
    """Whether a text is a timestamp with a mandatory zone."""
    shape = text.rlike(r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:[Zz]|[+-]\d{2}:\d{2})$")
    return F.coalesce(shape & F.try_to_timestamp(F.substring(text, 1, 10), F.lit("yyyy-MM-dd")).isNotNull(), F.lit(False))


def fraction_less(a: Column, b: Column) -> Column:
    """``a < b`` for texts ``n/d`` with positive denominators, exactly."""
    part = lambda t, k: F.element_at(F.split(t, "/"), k).cast("decimal(18,0)")
    return part(a, 1) * part(b, 2) < part(b, 1) * part(a, 2)


def clamp_box(x1: Column, y1: Column, x2: Column, y2: Column, width: int, height: int) -> Column:
    """Box with whole corners inside the frame; NULL if a side is under 4."""
    lo = lambda v, m: F.greatest(F.lit(0), F.least(F.lit(m - 1), F.floor(v)))
    hi = lambda v, m: F.greatest(F.lit(0), F.least(F.lit(m), F.ceil(v)))
    box = F.struct(lo(x1, width).alias("x1"), lo(y1, height).alias("y1"), hi(x2, width).alias("x2"), hi(y2, height).alias("y2"))
    return F.when((box["x2"] - box["x1"] >= 4) & (box["y2"] - box["y1"] >= 4), box)


def bounded_range(duration: Column, start: Column, longest: Column) -> Column:
    """``struct(start, end, error)``: ``[start, start + longest]`` in the duration."""
    s = F.greatest(start, F.lit(0))
    end = F.when(longest > 0, F.least(duration, s + longest)).otherwise(duration)
    error = F.when(s >= duration, "start beyond duration").when((longest > 0) & (longest < 60), "range too short")
    return F.struct(s.alias("start"), end.alias("end"), error.alias("error"))


def pick_segment(duration: Column, raw_start: Column, raw_end: Column, speed: Column, shortest: float = 35.0, longest: float = 45.0) -> Column:
    """``struct(t0, t1)`` whose length over speed lies between the limits."""
    bad = (raw_end <= F.greatest(raw_start, F.lit(0.0)) + 1.0) | (raw_end > duration + 0.5)
    a = F.when(bad, 0.0).otherwise(F.greatest(raw_start, F.lit(0.0)))
    b = F.least(F.when(bad, F.least(duration, longest * speed)).otherwise(raw_end), duration)
    length = (b - a) / speed
    grown = F.least(duration, a + shortest * speed)
    short = length < shortest
    t1 = F.when(length > longest, a + longest * speed).when(short, grown).otherwise(b)
    back = short & ((grown - a) / speed < shortest) & (a > 0)
    t0 = F.when(back, F.greatest(F.lit(0.0), grown - shortest * speed)).otherwise(a)
    return F.struct(t0.alias("t0"), F.least(t1, duration).alias("t1"))


def last_decodable(seconds: Column, duration: Column, fps: Column) -> Column:
    """A probe time held inside the frames that can be decoded."""
    return F.greatest(F.lit(0.0), F.least(seconds, duration - 1.0 / fps))


def ratio_pair(text: Column) -> Column:
    """``a,b`` held to [0, 1] and sorted; NULL without a comma."""
    v = F.transform(F.split(text, ",", 2), lambda p: F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.trim(p).try_cast("double"))))
    return F.when(F.size(v) == 2, F.array_sort(v))


def tail_adjustment(source: Column, target: Column) -> Column:
    """``struct(pad, trim)`` that brings one sample count to another."""
    zero = F.lit(0).cast("bigint")
    return F.struct(F.greatest(zero, target - source).alias("pad"), F.greatest(zero, source - target).alias("trim"))


def voice_fit(delay_ms: Column, duration_ms: Column, final_ms: Column, overflow_ms: int = 1000, speed_permille: int = 1020) -> Column:
    """``struct(target_ms, error)``: NULL target if the clip fits, the room left
    if a slight speed-up makes it fit, an error else."""
    room = F.greatest(F.lit(0).cast("bigint"), final_ms - F.greatest(delay_ms, F.lit(0).cast("bigint")))
    over = duration_ms - room
    error = F.when(over <= 0, None).when((over > overflow_ms) | (room <= 50), "ends beyond the video").when(duration_ms * 1000 > room * speed_permille, "above the micro-fit limit")
    return F.struct(F.when((over > 0) & error.isNull(), room).alias("target_ms"), error.alias("error"))


def voice_start(planned: Column) -> Column:
    return F.greatest(F.lit(0).cast("bigint"), planned)


def seconds_list(text: Column) -> Column:
    """Numbers of a comma list; what is no number is dropped."""
    values = F.transform(F.split(text, ","), lambda p: F.trim(p).try_cast("double"))
    return F.filter(values, lambda x: x.isNotNull())


def masks(text: Column, width: int, height: int) -> Column:
    """``a,b,c,d;...`` to boxes: four values within [0, 1] are shares of the
    frame, others pixels; malformed parts and boxes under 4 are dropped."""

    def one(part: Column) -> Column:
        v = F.transform(F.filter(F.transform(F.split(part, ","), lambda p: F.trim(p)), lambda p: p != ""), lambda p: p.try_cast("double"))
        share = F.forall(v, lambda x: x.between(0, 1))
        at = lambda k, size: F.get(v, F.lit(k)) * F.when(share, F.lit(float(size))).otherwise(F.lit(1.0))
        return F.when(F.size(v) == 4, clamp_box(at(0, width), at(1, height), at(2, width), at(3, height), width, height))

    return F.filter(F.transform(F.split(text, ";"), one), lambda b: b.isNotNull())
