import hashlib
import re
import sys
from pathlib import Path

import public_tokenizers as P
import tiktoken

sys.path.insert(0, str(Path(__file__).parent))
import corpus_pipeline as cp
from test_decontaminate import brute as brute_hits

from lapwing.llm import byte_bpe, toxicity
from lapwing.llm._common import materialize

SF = "/root/testdata/sf0.01"


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    before = docs
    kept = {}
    for name, stage in cp.STAGES:
        after = materialize(stage(spark, before, SF), "test")
        rows = {r["doc_id"]: r["text"] for r in before.select("doc_id", "text").collect()}
        got = kept[name] = {r["doc_id"] for r in after.select("doc_id").collect()}
        assert got <= set(rows) and after.count() == len(got)
        if name != "byte_bpe":
            assert after.columns == docs.columns
        if name == "toxicity":
            model = toxicity.learn(docs, spark.read.parquet(f"{SF}/labels.parquet"))
            scores = dict(zip(rows, toxicity.score_texts(list(rows.values()), model)))
            assert got == {i for i, s in scores.items() if s < 0.5}
        if name == "exact_dedup":
            first = {}
            for i in sorted(rows):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", rows[i] or ""), i)
            assert got == set(first.values())
        if name == "near_dedup":
            assert 0.9 * len(rows) < len(got) < len(rows)
        if name == "decontamination":
            assert got == {r[0] for r in brute_hits(list(rows.items()), items) if not r[-1]}
        if name == "byte_bpe":
            ranks = byte_bpe.read_ranks(P.path(byte_bpe.RANK_FILE))
            enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
            for r in after.collect():
                text = rows[r["doc_id"]] or ""
                assert r["ids"] == enc.encode_ordinary(text) and r["n_tokens"] == len(r["ids"])
                assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        before = after


def test_odd_tables(spark, tmp_path):
    rows = [(1, None, "en", None, 0), (2, "", "en", "s", 0), (3, "a b c", None, "s", 5), (3, "a b c", None, "s", 5), (None, "x y", "en", "s", 3), (4, "long " * 40000, "en", "s", 9)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, data in (("odd", rows), ("empty", [])):
        d = tmp_path / name
        spark.createDataFrame(data, schema).selectExpr("*", "1 as toxicity_score", "2 as row").write.parquet(str(d / "documents.parquet"))
        spark.createDataFrame([(1, 0)], "doc_id long, toxic int").write.parquet(str(d / "labels.parquet"))
        spark.createDataFrame([(1, "q r s")], "item_id long, text string").write.parquet(str(d / "benchmark.parquet"))
        out = cp.run(spark, str(d)).collect()
        assert sorted(str(r["doc_id"]) for r in out) == (["1", "3", "4", "None"] if data else [])
