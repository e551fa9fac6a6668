"""Literal cases of the operators on timelines."""

import pytest
from pyspark.sql import functions as F

from lapwing.operators import cover, timeline


def _rebased(spark, rows, segment=5.0, duration=40.0):
    df = spark.createDataFrame([("k", i, s, e, t) for i, (s, e, t) in enumerate(rows)], "key string, ord long, start double, end double, text string")
    return sorted((r["ord"], r["how"], round(r["start"], 6), round(r["end"], 6)) for r in timeline.rebase(df, ["key"], segment, duration).collect())


@pytest.mark.parametrize(
    ("rows", "want"),
    [
        # Inside the clip already: at least 0.4 s long, blank lines go.
        ([(0.0, 4.0, "a"), (5.0, 6.0, "  "), (20.0, 20.1, "b")], [(0, "kept", 0.0, 4.0), (2, "kept", 20.0, 20.5)]),
        # 3 s too far for the clip, but not after the segment's start is taken off.
        ([(6.0, 9.0, "a"), (42.0, 44.0, "b")], [(0, "segment", 1.0, 4.0), (1, "segment", 37.0, 39.0)]),
        # Absolute times: only the first start helps.
        ([(100.0, 104.0, "a"), (112.0, 113.0, "b")], [(0, "first", 0.0, 4.0), (1, "first", 12.0, 13.0)]),
        # All at one moment: shared out, (40 - 0.18) by 8 and 24 letters.
        ([(1.0, 1.0, "short"), (1.0, 1.0, "x" * 24)], [(0, "shared", 0.0, 9.955), (1, "shared", 10.135, 40.0)]),
    ],
)
def test_rebase(spark, rows, want):
    assert _rebased(spark, rows) == want


def test_voice_slots(spark):
    def slots(total, rows):
        df = spark.createDataFrame([("k", i, *r) for i, r in enumerate(rows)], "key string, ord long, start double, duration double")
        out = timeline.voice_slots(df, ["key"], F.lit(total)).orderBy("ord").collect()
        return [(r["end"], round(r["spill"], 6), r["fit"], r["error"]) for r in out]

    assert slots(10.0, [(0.0, 3.0), (2.5, 2.0)]) == [(3.0, 0.5, None, ""), (4.5, 0.0, None, "")]
    assert slots(10.0, [(5.0, 5.05)]) == [(10.0, 0.0, 5.0, "")]
    assert slots(10.0, [(5.0, 5.5)])[0][3] == "ends beyond the video"


def test_event_pool_and_best_track(spark):
    events = spark.createDataFrame([("v", 0, 10, 12), ("v", 1, 20, 20), ("v", 2, 50, 51)], "key string, index int, start long, end long")
    seen = spark.createDataFrame([("v", i, t) for i, t in enumerate((9, 11, 21, 30))], "key string, ord long, at long")
    pool = timeline.event_pool(events, seen, ["key"], 8, 2)
    got = {}
    for r in pool.collect():
        got.setdefault(r["index"], []).append(r["r_at"])
    # In its time; only near it; neither, so all.
    assert {k: sorted(v) for k, v in got.items()} == {0: [11], 1: [21], 2: [9, 11, 21, 30]}
    rows = [("v", 0, 0, 0, 10, 10, 0.1), ("v", 0, 0, 0, 10, 10, 0.5), ("v", 1, 50, 50, 60, 60, 0.5), ("v", 1, 52, 50, 60, 60, 0.1), ("v", 2, 0, 0, 9, 9, 0.4)]
    tracked = spark.createDataFrame(rows, "key string, track int, x1 int, y1 int, x2 int, y2 int, a double")
    best = timeline.best_track(tracked, ["key"], "track", F.col("a"), (55.0, 55.0, 10.0, 10.0)).first()
    assert (best["track"], best["hits"], best["detections"]) == (1, 1, 2)  # as many hits, nearer to the lane


def test_audit_cuts_until_nothing_is_found(spark):
    ads = spark.createDataFrame([(1, 0.9, 0), (2, 0.95, 1), (3, 0.9, 2), (4, 0.3, 0)], "ord long, score double, hidden_by long")

    def detect(cuts):  # an advertisement is seen once the one that hides it is cut
        if cuts is None:
            return ads.where("hidden_by = 0")
        seen = ads.join(cuts.select(F.col("ord").alias("c")), F.col("hidden_by") == F.col("c"), "left").where("hidden_by = 0 or c is not null").drop("c")
        return seen.join(cuts.select("ord"), "ord", "left_anti")

    cuts, left = timeline.audit_until_clean(detect, 0.8, 2)
    assert sorted((r["ord"], r["pass"]) for r in cuts.collect()) == [(1, 1), (2, 2)]
    assert sorted((r["ord"], r["failed"]) for r in left.collect()) == [(3, True), (4, False)]
    cuts, left = timeline.audit_until_clean(detect, 0.8, 5)
    assert cuts.count() == 3 and left.where("failed").count() == 0


def test_gaps_are_recovered_by_middle(spark):
    frame = lambda rows: spark.createDataFrame([("k", i, *r) for i, r in enumerate(rows)], "key string, ord long, start long, end long")
    lines, found = frame([(0, 10), (30, 40), (80, 90)]), frame([(8, 16), (25, 45), (20, 24), (60, 100), (10, 10)])
    out = cover.recover_gaps(lines, [(found, 5)], ["key"])
    assert sorted((r["start"], r["end"]) for r in out.collect()) == [(0, 10), (10, 16), (20, 24), (30, 40), (80, 90)]
    twice = cover.recover_gaps(lines, [(found, 5), (frame([(17, 19)]), 5)], ["key"], lambda df: df.where("end - start > 5"))
    assert sorted((r["start"], r["end"]) for r in twice.collect()) == [(0, 10), (10, 16), (30, 40), (80, 90)]


@pytest.mark.parametrize("n, total, first, us", [(2, 192, 57, 11821562), (3, 384, 33, 3406562), (3, 640, 33, 2043937), (4, 192, 57, 11714687)])
def test_shared_out_without_rounding_before_the_division(spark, n, total, first, us):
    """These shares lie halfway between two microseconds: the room, 40 seconds less
    pauses of 0.18, is decimal, and a last bit of it would decide."""
    rest, left = divmod(total - first, n - 1)
    sizes = [first, *[rest + (k < left) for k in range(n - 1)]]
    rows = spark.createDataFrame([("k", i, "x" * size, 100.0 * i, 100.0 * i + 1) for i, size in enumerate(sizes)], "key string, ord long, text string, start double, end double")
    out = timeline.rebase(rows, ["key"], 5.0, 40.0).where("ord = 0").first()
    assert out["how"] == "shared" and out["end"] == (4000 - 18 * (n - 1)) * first / 100 / total
    assert int(out["end"] * 1e6) == us
