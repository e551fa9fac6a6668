"""Sources and sinks through files."""

import hashlib

import pytest
from pyspark.sql import functions as F

from lapwing.sources import readers, sinks


def test_objects_are_hashed(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"abc")
    row = readers.objects(spark, str(tmp_path)).first()
    assert (row["size"], row["digest"]) == (3, hashlib.sha256(b"abc").hexdigest())


def test_json_documents_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 2.0, "你好", "xin chào")], "start double, end double, text_zh string, text_vi string")
    sinks.write_json(df, str(tmp_path / "cues"))
    got = readers.json_documents(spark, str(tmp_path / "cues"), df.schema, lines=True)
    assert got.collect() == df.collect()
    (tmp_path / "bom.json").write_bytes(b'\xef\xbb\xbf{"start": 1.5}')
    assert readers.json_documents(spark, str(tmp_path / "bom.json"), "start double").first()["start"] == 1.5


def test_versions_are_not_replaced(spark, tmp_path):
    df = spark.range(3)
    sinks.write_versioned(df, str(tmp_path / "t"), "1")
    with pytest.raises(Exception):
        sinks.write_versioned(df, str(tmp_path / "t"), "1")


def test_strict_json(spark):
    from pyspark.sql import types as T

    df = spark.createDataFrame([('{"a":1}',), ('{"a":1,"a":1}',), ('{"a":NaN}',), ('{"a":"x"}',), ("[",)], "t string")
    got = [r["problem"] for r in readers.strict_json(df, "t", T.StructType([T.StructField("a", T.LongType())])).collect()]
    assert got == ["", "not_strict", "not_strict", "type", "not_strict"]


def test_cue_override_and_hits(spark):
    df = spark.createDataFrame([("v", 0, -1.0, 2.0, " a  b "), ("v", 1, 5.0, 99.0, "c"), ("v", 2, 4.0, 6.0, ""), ("v", 3, 1.0, 2.0, "d")], "video_id string, ord int, start double, end double, text_vi string")
    got = readers.cue_override(df, 10.0).orderBy("ord").collect()
    assert [(r["start"], r["end"], r["problem"]) for r in got] == [(0.0, 2.0, ""), (5.0, 10.0, ""), (4.0, 6.0, "empty"), (1.0, 2.0, "unsorted")]
    assert got[0]["text_vi"] == "a b"


def test_srt(spark):
    df = spark.createDataFrame([("v", 0, 0, 1500, " one "), ("v", 1, 5, 5, "gone"), ("v", 2, 2000, 3000, " ")  , ("v", 3, 3000, 3723004, "two")], "k string, ord int, start long, end long, text string")
    row = sinks.srt_documents(df, ["k"]).first()
    assert row["cues"] == 2 and row["srt"] == "1\n00:00:00,000 --> 00:00:01,500\none\n\n2\n00:00:03,000 --> 01:02:03,004\ntwo"


def test_ass(spark):
    df = spark.createDataFrame([("v", 0, 0, 150, "some {words} that do not fit in one line")], "k string, ord int, start long, end long, text string")
    row = sinks.ass_documents(df, ["k"], "[Events]\n").first()
    assert row["ass"] == "[Events]\nDialogue: 0,0:00:00.00,0:00:01.50,Default,,0,0,0,,some \\{words\\} that do\\Nnot fit in one line"


def test_last_ids_and_relocation(spark):
    row = spark.range(1).select(sinks.last_ids(F.expr("sequence(1, 5)"), 2).alias("l"), sinks.last_ids(F.expr("sequence(1, 2)"), 9).alias("s")).first()
    assert (row["l"], row["s"]) == ([4, 5], [1, 2])
