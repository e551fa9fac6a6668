import hashlib
import re
from collections import defaultdict

from lapwing.llm import decontaminate as dc

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))


def brute(docs, items):
    grams = defaultdict(set)
    for i, t in items:
        w = _words(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            grams[tuple(w[k : k + n])].add(str(i))
    sizes = sorted({len(g) for g in grams})
    out = []
    for i, t in docs:
        w, hit, found = _words(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                g = tuple(w[k : k + n])
                if g in grams:
                    hit.update(range(k, k + n))
                    found |= grams[g]
        ids = ",".join(sorted(found))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out)


def _run(spark, tmp_path, docs, items):
    spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as n", "'x' as items", "2 as h").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as n").write.parquet(str(tmp_path / "benchmark.parquet"))
    return sorted(tuple(r) for r in dc.op4_decontamination(spark, str(tmp_path)).collect())


LONG = "w1 w2 w3 W4 É5 w6 w7 w8 w9 w10 w11 w12"
ITEMS = [(1, LONG), (2, "short item"), (3, None), (4, ""), (5, "..."), (6, LONG), (7, "Ünï"), (2, "other words here")]
DOCS = [
    (1, None),
    (2, ""),
    (3, "x " + LONG.upper().replace("É", "É") + " y"),
    (4, "a short. ITEM b ünï Ünï"),
    (5, "w1 w2 w3 w4 É5 w6 w7 w8 w9"),
    (6, ("w2 w3 w4 É5, w6 w7 w8 w9 w10 w11; " * 3)),
    (6, ("w2 w3 w4 É5, w6 w7 w8 w9 w10 w11; " * 3)),
    (6, "short item"),
    (7, "é5 É5 " * 20000 + LONG),
]


def test_against_brute_force(spark, tmp_path):
    assert _run(spark, tmp_path, DOCS, ITEMS) == brute(DOCS, ITEMS)


def test_blocks_give_the_same(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    keep = ["doc_id", "text_hash", "n_words", "copies", "items", "n_hit"]
    one = dc.hits(docs, items).select(*keep).collect()
    many = dc.hits(docs, items, broadcast_windows=2).select(*keep).collect()
    assert sorted(map(str, one)) == sorted(map(str, many))


def test_empty_tables(spark, tmp_path):
    assert _run(spark, tmp_path / "a", [], ITEMS) == []
    assert _run(spark, tmp_path / "b", DOCS, []) == brute(DOCS, [])


def test_sample_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = {n: [tuple(r) for r in spark.read.parquet(f"{sf}/{n}.parquet").select(i, "text").collect()] for n, i in (("documents", "doc_id"), ("benchmark", "item_id"))}
    got = sorted(tuple(r) for r in dc.op4_decontamination(spark, sf).collect())
    assert got == brute(rows["documents"], rows["benchmark"])
    assert any(r[-1] for r in got)


def test_removal(spark):
    docs = spark.createDataFrame([(1, "a! " + LONG + " ?b", "k"), (2, "clean", "k"), (3, None, "k")], "doc_id long, text string, row string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert sorted(r["doc_id"] for r in dc.decontaminate(docs, items).collect()) == [2, 3]
    cut = {r["doc_id"]: r["text"] for r in dc.decontaminate(docs, items, remove="spans").collect()}
    assert cut == {1: "a!  ?b", 2: "clean", 3: None}
