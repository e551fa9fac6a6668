"""Null ids, and extra columns whose names differ from the operators' in case only."""

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lapwing.llm import byte_bpe, decontaminate, exact_dedup, pii, quality, simhash, token_counts, toxicity
from lapwing.llm._common import free_name, other_columns

ROWS = [(None, "a b c"), (None, None), (1, "call +1 (459) 555-7415 now"), (1, "call +1 (459) 555-7415 now"), (2, "")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string")


def _written(docs, path):
    docs.write.mode("overwrite").parquet(str(path / "documents.parquet"))
    return str(path)


def test_null_ids(spark, docs, tmp_path):
    sf = _written(docs, tmp_path)
    spark.createDataFrame([(None, 1, 1), (1, None, None)], "doc_id long, toxic int, quality int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(None, "a b"), (3, "b c")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    ids = sorted([r[0] for r in ROWS], key=str)
    for query in (toxicity.op1_toxicity, byte_bpe.op3_byte_bpe, decontaminate.op4_decontamination, token_counts.op7_token_counts, pii.op8_pii, quality.op2_quality):
        assert sorted([r["doc_id"] for r in query(spark, sf).collect()], key=str) == ids
    assert all(r["held_out"] is False for r in toxicity.op1_toxicity(spark, sf).collect() if r["doc_id"] is None)
    hit = [r for r in decontaminate.op4_decontamination(spark, sf).collect() if r["contaminated"]]
    # The item without an id counts, and is not in the list.
    assert [(r["doc_id"], r["n_hit"], r["n_items"], r["items_sha256"]) for r in hit] == [(None, 3, 2, hashlib.sha256(b"3").hexdigest())]


def test_names_that_differ_in_case(docs):
    odd = docs.selectExpr("*", "1 as Score", "2 as IDS", "3 as N_Tokens", "4 as PII", "5 as Toxicity_Score", "6 as Decoded")
    model = toxicity.Model(None)
    for out, name in (
        (toxicity.score(odd, model), "score"),
        (byte_bpe.encode(odd), "ids"),
        (byte_bpe.round_trip(odd), "decoded"),
        (token_counts.count_tokens(odd), "n_tokens"),
        (pii.detect(odd), "pii"),
    ):
        assert out.select(name).count() == len(ROWS) and len({c.lower() for c in out.columns}) == len(out.columns)
    assert free_name(odd, "toxicity_score") == "toxicity_score_" and other_columns(odd, "score", "ids") == [0, 1, 4, 5, 6, 7]


def test_stages_keep_columns_whatever_their_names(spark, docs, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame([(1, 0)], "doc_id long, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, "no such text")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    odd = docs.selectExpr("*", "'x' as Toxicity_Score", "1 as _slot", "2 as ROW", "3 as H", "4 as node", "5 as _id", "6 as `a.b`")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, sf)
        assert out.columns == odd.columns, name
        assert out.where("Toxicity_Score = 'x' and `a.b` = 6").count() == out.count() >= 3, name
    assert corpus_pipeline.STAGES[-1][1](spark, odd, sf).count() == len(ROWS)


def test_mask_cuts_by_the_spans(spark):
    texts = ["300.1.1.10 and 0.1.1.1", "é a@b.cc +1 (459) 555-7415 a@b.cc", "nothing", None, "a@b.co " * 2000]
    rows = pii.detect(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = {r["doc_id"]: (r["m"], r["pii"]) for r in rows.select("doc_id", "pii", pii.mask(F.col("text"), F.col("pii")).alias("m")).collect()}
    for i, t in enumerate(texts):
        want, at = "", 0
        for s in sorted(got[i][1], key=lambda s: (s["start"], -s["end"])):
            if s["start"] >= at:
                want += t[at : s["start"]] + f"<{s['kind']}>"
            at = max(at, s["end"])
        assert got[i][0] == (None if t is None else want + t[at:])
    assert got[0][0] == "300.1.1.10 and <ip>" and got[4][0] == "<email> " * 2000


def test_exact_copies_that_share_an_id(spark):
    rows = [(1, "a  b", "x"), (1, "a b", "y"), (1, "c", "z"), (2, "a b", "w"), (None, "a b", "v"), (None, None, "u"), (None, "", "t"), (3, "d", "s")]
    out = exact_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string, kd string")).collect()
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in out if r["kd"] not in "xytu") == [("1", "c"), ("3", "d")]
    assert sum(r["kd"] in "xy" for r in out) == 1 and sum(r["kd"] in "tu" for r in out) == 1 and len(out) == 4


def test_near_copies_of_text_ids(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [("b", text), ("a", text + " more"), (None, text), ("c", "else")]
    out = simhash.near_deduplicate(spark.createDataFrame(rows, "doc_id string, text string"))
    assert sorted(r["doc_id"] for r in out.collect()) == ["a", "c"]
