import hashlib
import json
import re

from lapwing import plans, registry

plans.load()

NAMES = [
    (r"\bTôm\s+Trường\s+Sinh\b", "Hà Trường Sinh"), (r"\bTôm\s+tiên\s+sinh\b", "Hà tiên sinh"), (r"\bTôm\s+mỗ\b", "Hà mỗ"),
    (r"\bHạ\s+Trường\s+Sinh\b", "Hà Trường Sinh"), (r"\bHạ\s+tiên\s+sinh\b", "Hà tiên sinh"), (r"\bHạ\s+mỗ\b", "Hà mỗ"),
]
TEXTS = ["TÔM  mỗ , đây", " hạ　tiên sinh !", "Tôm mỗi", "Hạ Trường\nSinh  và tôm trường sinh .", "", None, "été ,  là"]


def brute(t):
    t = t.strip()
    for old, new in NAMES:
        t = re.sub(old, new, t, flags=re.IGNORECASE)
    return re.sub(r"[ \t]{2,}", " ", re.sub(r"\s+([,.!?;:])", r"\1", t))


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def test_documents(spark, tmp_path):
    rows = [(i, t, [None, "fr", "en"][i % 3]) for i, t in enumerate(TEXTS)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["tidy"] for r in registry.QUERIES["x03_normal_text"](spark, str(tmp_path)).collect()}
    assert got == {i: None if t is None else sha(brute(t)) for i, t, _ in rows}
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r["tidy"] for r in registry.QUERIES["x03_normal_text"](spark, sf).collect()}
    assert got == {r["doc_id"]: sha(brute(r["text"])) for r in docs}


def test_nested(spark, tmp_path):
    rows = [(1, i, "user", t) for i, t in enumerate(TEXTS) if t]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = registry.QUERIES["x04_nested_text"](spark, str(tmp_path)).collect()
    want = json.dumps([{"turn": i, "role": r, "text": brute(t)} for _, i, r, t in rows], ensure_ascii=False, separators=(",", ":"))
    assert [r["digest"] for r in got] == [sha(want)]
