"""Literal and randomised cases of the declarative operators."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from lapwing.functions import hashing as hs
from lapwing.functions import text as tx
from lapwing.functions import timefmt as tf
from lapwing.operators import constraints as cs
from lapwing.operators import intervals as iv
from lapwing.operators import schedule as sc
from lapwing.streaming import flows


def spans(spark, rows):
    return spark.createDataFrame([("k", i, a, b) for i, (a, b) in enumerate(rows)], "key string, ord int, start long, end long")


def pairs(df, a="start", b="end"):
    return sorted((r[a], r[b]) for r in df.collect())


def test_islands(spark):
    assert pairs(iv.islands(spans(spark, [(30, 40), (10, 20), (15, 25)]), ["key"])) == [(10, 25), (30, 40)]


def test_keep_segments(spark):
    bounds = spark.createDataFrame([("k", 0, 50), ("empty", 0, 5)], "key string, lo long, hi long")
    got = iv.complement(spans(spark, [(10, 25), (30, 40)]), bounds, ["key"])
    assert pairs(got, "gap_start", "gap_end") == [(0, 5), (0, 10), (25, 30), (40, 50)]


@pytest.mark.parametrize("lines,cuts,want", [([(10, 15), (22, 28), (40, 45)], [(20, 30)], [(10, 15), (30, 35)]), ([(25, 35)], [(20, 30)], [(20, 25)]), ([(15, 45)], [(20, 25), (35, 40)], [(15, 35)])])
def test_shift_after_cuts(spark, lines, cuts, want):
    assert pairs(iv.shift_after_cuts(spans(spark, lines), spans(spark, cuts).drop("ord"), ["key"])) == want


def test_gaps(spark):
    assert pairs(iv.internal_gaps(spans(spark, [(20, 24), (10, 12), (60, 62)]), ["key"], least=20), "gap_start", "gap_end") == [(24, 60)]


def test_padded_windows_stop_at_the_middle(spark):
    got = iv.padded_windows(spans(spark, [(1000, 2000), (2100, 3000)]), ["key"], 120).orderBy("ord").collect()
    assert (got[0]["cover_end"], got[1]["cover_start"]) == (2050, 2050)


def test_bucketed_pairs_are_all_pairs_once(spark):
    rng = random.Random(3)
    a = [(s, s + rng.randint(0, 90)) for s in (rng.randint(0, 1000) for _ in range(80))]
    b = [(s, s + rng.randint(0, 90)) for s in (rng.randint(-100, 1000) for _ in range(80))]
    right = spans(spark, b).withColumnRenamed("ord", "id")
    got = sorted((r["ord"], r["r_id"]) for r in iv.bucketed_pairs(spans(spark, a), right, ["key"], 50, 7).collect())
    want = sorted((i, j) for i, x in enumerate(a) for j, y in enumerate(b) if x[0] <= y[1] + 7 and y[0] <= x[1] + 7)
    assert got == want


def test_schedule_is_the_recurrence(spark):
    rng = random.Random(5)
    rows, end, want, at = [], None, [], 0
    for i in range(200):
        at += rng.randint(0, 30)
        n = rng.randint(1, 25)
        start = at if end is None else max(at, end + 3)
        end = start + n
        rows.append(("k", i, at, n))
        want.append((start, end))
    df = spark.createDataFrame(rows, "key string, ord int, anchor long, len long")
    got = sc.fixed_rate(df, ["key"], "anchor", "len", 3).orderBy("ord").collect()
    assert [(r["onset"], r["offset"]) for r in got] == want


def test_sample_schedule(spark):
    df = spark.createDataFrame([("k", 0, 1200, 100, 1000), ("k", 1, 1100, 200, 900)], "key string, ord int, anchor long, detected_onset long, detected_offset long")
    a, b = sc.sample_schedule(df, ["key"], 2205, 26460, F.lit(100000)).orderBy("ord").collect()
    assert (b["previous_gap"], b["lag"], b["fits"]) == (2205, a["actual_offset"] + 2205 - 1100, True)


def test_time_texts(spark):
    row = spark.range(1).select(
        tf.srt_time(F.lit(7501250)).alias("srt"), tf.to_seconds(F.lit("01:29:52")).alias("a"), tf.to_seconds(F.lit("10:30")).alias("b"), tf.to_seconds(F.lit("00:00:05,500")).alias("c"),
        tf.ass_time(F.lit(5999)).alias("carry"), tf.ass_time_short_carry(F.lit(59996)).alias("short"), tf.to_seconds(F.lit("1:2:3:4")).alias("none"),
    ).first()
    assert tuple(row) == ("02:05:01,250", 5392.0, 630.0, 5.5, "0:00:59.99", "0:00:60.00", None)


def test_publish_calendar(spark):
    at = tf.publish_at(F.col("id"), 13, "2026-08-26", ["11:30", "18:30"], 420)
    got = [r["at"] for r in spark.range(12, 17).select(at.alias("at")).collect()]
    assert got == ["", "2026-08-26T04:30:00Z", "2026-08-26T11:30:00Z", "2026-08-27T04:30:00Z", "2026-08-27T11:30:00Z"]


def test_voice_fit(spark):
    f = tf.voice_fit(F.lit(218000).cast("long"), F.lit(2693).cast("long"), F.lit(220276).cast("long"), speed_permille=1200)
    assert spark.range(1).select(f.alias("f")).first()["f"]["target_ms"] == 2276


def test_urls(spark):
    df = spark.createDataFrame([(" HTTPS://Video.EXAMPLE.com/AbC/?foo=1#bar ",), ("http://www.example.com//a//b).",), ("https://other.net/x",)], "u string")
    got = df.select(hs.normalize_url(F.col("u")).alias("n"), hs.strict_url(F.col("u"), ["example.com"]).alias("s")).collect()
    assert [r["s"] for r in got] == ["https://video.example.com/AbC/", "https://example.com/a/b/", None]
    assert got[0]["n"] == "https://video.example.com/AbC/"


@pytest.mark.parametrize(
    "text,digest",
    [
        ('{"z":0,"a":[true,null,3],"é":"Việt"}', "68262201503d423f5ac486fe31a7c99dbe68d994938006bfe775c9443be6a6b9"),
        ('{"quote":"\\"","control":"line\\nfeed"}', "7429742ee3fdea8fb7769ab3b21e93298a8adf8e0b8ea758e020e17b7bbc9e43"),
        ('{"rate":"1.5000","enabled":true,"attempt_seq":1}', "62e4acd2698ca4728df150ba22891cb0de5a8c652daba02bb0944d43e4739349"),
    ],
)
def test_canonical_json(text, digest):
    assert hashlib.sha256(hs.canonical_json(text).encode()).hexdigest() == digest


def test_strict_json():
    assert hs.canonical_json('{"a":1,"a":2}') is None and hs.canonical_json('{"a":NaN}') is None
    assert not hs.same_json("1", "true") and not hs.same_json("1", "1.0") and hs.same_json('{"a":[1]}', '{ "a": [1] }')


def test_text_rules(spark):
    assert tx.fold_key("Đây là Việt-Nam!") == "đaylavietnam"
    assert tx.cue_key("「Ｈello,  World！」") == "hello,world"
    row = spark.createDataFrame([("aaaa bbbb cccc dddd eeee ffff gggg hhhh iiii",)], "t string").select(tx.two_lines(F.col("t")).alias("l"), tx.balanced_lines(F.lit("short text")).alias("s")).first()
    assert row["l"] == ["aaaa bbbb cccc dddd", "eeee ffff gggg hhhh iiii"] and row["s"] == ["short text"]


def test_even_break_is_the_best_break(spark):
    rng = random.Random(9)
    texts = [" ".join("x" * rng.randint(1, 9) for _ in range(rng.randint(1, 14))) for _ in range(200)]

    def brute(t, longest):
        w = t.split(" ")
        if len(t) <= longest or len(w) < 2:
            return [t]
        over = lambda s: max(0, len(s) - longest)
        options = [(" ".join(w[:i]), " ".join(w[i:])) for i in range(1, len(w))]
        return list(min(options, key=lambda p: (over(p[0]) + over(p[1]), abs(len(p[0]) - len(p[1])), p)))

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r["l"] for r in df.select(tx.balanced_lines(F.col("t")).alias("l")).collect()]
    assert got == [brute(t, 24) for t in texts]


def test_transitions(spark):
    rows = [("j", 0, "queued"), ("j", 1, "downloading"), ("j", 2, "completed"), ("k", 0, "scheduling_tts"), ("k", 1, "failed")]
    bad = cs.transition_violations(spark.createDataFrame(rows, "job string, seq int, state string"), ["job"], "seq", {}).collect()
    assert [(r["job"], r["seq"], r["problem"]) for r in bad] == [("j", 2, "not_allowed")]
    assert cs.graph_problems(cs.edges(spark), cs.state_table(spark)).count() == 0
    moves = spark.createDataFrame([("a", "b"), ("b", "c"), ("end", "a")], "previous string, state string")
    states = spark.createDataFrame([("a", False), ("b", False), ("d", False), ("end", True)], "state string, final boolean")
    got = sorted(tuple(r) for r in cs.graph_problems(moves, states).collect())
    assert got == [("c", "unknown_target"), ("d", "no_way_out"), ("end", "final_can_be_left")]
    with pytest.raises(ValueError):
        cs.strict(cs.transition_violations(spark.createDataFrame(rows, "job string, seq int, state string"), ["job"], "seq", {}), "states")


def test_tampered_sequences(spark):
    good = [("c", i, i * 10, i * 10 + 5) for i in range(5)]
    frame = lambda rows: spark.createDataFrame(rows, "c string, i int, s long, e long")
    check = lambda rows: [r["rules"] for r in cs.sequence_violations(frame(rows), ["c"], "i", "s", "e").collect()]
    assert check(good) == []
    assert check([*good[:2], ("c", 2, 14, 25), *good[3:]]) == [["overlap"]]
    assert check([*good[:4], ("c", 5, 40, 45)]) == [["index"]]
    assert check([*good[:4], ("c", 4, 40, 40)]) == [["empty"]]


def test_streamed_claims_and_series(spark, tmp_path):
    rows = [(1, i, e, b, x) for i, (e, b, x) in enumerate([("start", "a", 0.0), ("completed", "zzz", 5.0), ("completed", "a", 9.0), ("start", "b", 0.0), ("failed", "b", 0.0), ("start", "c", 0.0)])]
    schema = "chat_id long, update_id long, event string, batch_id string, end double"
    df = spark.createDataFrame(rows, schema)
    want = ["started", "stale", "advanced", "started", "failed", "started"]
    assert [r["action"] for r in flows.series_batch(df).orderBy("update_id").collect()] == want
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    q = flows.series(stream).writeStream.format("memory").queryName("series_out").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    got = spark.sql("select * from series_out order by update_id").collect()
    assert [r["action"] for r in got] == want and got[-1]["part"] == 2
    once = flows.claims(spark.createDataFrame([(1, 1), (1, 2), (2, 3)], "update_id long, at long"), "update_id", "at")
    assert once.count() == 2


def test_streamed_windows_equal_batch(spark, tmp_path):
    src = "/root/testdata/sf0.001/events.parquet"
    batch = spark.read.parquet(src).select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    batch.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))
    out = flows.tumbling(stream, "ts", ["event_type"], "1 hour", "1 hour", "value")
    q = out.writeStream.format("memory").queryName("win_out").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    key = lambda r: (r["w"]["start"], r["event_type"], r["n"])
    assert sorted(map(key, spark.sql("select * from win_out").collect())) == sorted(map(key, flows.tumbling(batch, "ts", ["event_type"], "1 hour", "1 hour", "value").collect()))


def test_upsert_keeps_the_last(spark, tmp_path):
    write = flows.upsert(str(tmp_path / "t"), "k", "n")
    write(spark.createDataFrame([("a", 1), ("b", 1)], "k string, n int"), 0)
    write(spark.createDataFrame([("a", 2)], "k string, n int"), 1)
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "t/v=1")).collect()) == [("a", 2), ("b", 1)]


def test_removing_the_subpackage_leaves_the_rest(spark):
    """Nothing outside lapwing.llm imports it."""
    import pathlib

    root = pathlib.Path(iv.__file__).parents[1]
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert "lapwing.llm" not in p.read_text(), p
