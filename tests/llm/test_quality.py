import random

from lapwing.llm import quality as q


def test_buckets_are_the_texts_own():
    texts = [None, "", "One two One", " a\n", "x " * 5000, "One two One"]
    bucket, size = q.gram_buckets(texts)
    assert size.tolist() == [0, 0, 5, 1, 9999, 5]
    at = [0, 0, 0, 5, 6, 10005, 10010]
    assert sorted(bucket[at[2] : at[3]]) == sorted(bucket[at[5] : at[6]]) == sorted(q.gram_buckets(["One two One"])[0])


def test_good_texts_weigh_more_and_are_kept(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = q.op2_quality(spark, sf).collect()
    assert len(rows) == 10000
    test = [(labels[r["doc_id"]], r["log_weight"], r["kept"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    pos, neg = [w for y, w, _ in test if y], [w for y, w, _ in test if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    kept = [sum(k for y, _, k in test if y == v) / sum(y == v for y, _, _ in test) for v in (0, 1)]
    print("auc", auc, "kept of bad, good", kept, "share", sum(r["kept"] for r in rows) / len(rows))
    assert auc > 0.75 and kept[1] > kept[0]


def test_the_top_k_by_key_are_kept(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["good", "fine", "bad", "junk"]) for _ in range(rng.randint(1, 20)))) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, int("junk" not in t)) for i, t in rows[:200]], "doc_id long, quality int")
    got = q.resample(docs, labels, share=0.3).collect()
    keys = sorted((r["key"] for r in got), reverse=True)
    assert {r["doc_id"] for r in got if r["kept"]} == {r["doc_id"] for r in got if r["key"] >= keys[149]}
    assert [tuple(r) for r in sorted(got)] == [tuple(r) for r in sorted(q.resample(docs, labels, share=0.3).collect())]


def test_odd_rows(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, "x" * 100000), (4, "a b"), (4, "a b"), (None, "a b")]
    for name, data in (("odd", rows), ("empty", [])):
        d = tmp_path / name
        spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "1 as key", "2 as label").write.parquet(str(d / "documents.parquet"))
        spark.createDataFrame([(1, None), (None, 1), (4, 0)], "doc_id long, quality int").write.parquet(str(d / "labels.parquet"))
        got = q.op2_quality(spark, str(d)).collect()
        assert len(got) == len(data) and all(r["kept"] and r["log_weight"] == 0 for r in got)


def test_weights_against_brute_force(spark):
    """The models as dictionaries of n-grams' buckets, one n-gram at a time."""
    import math
    import zlib
    from collections import Counter

    from lapwing.llm import quality

    rows = [(i, " ".join(f"w{(i * j) % 17}" for j in range(1 + i % 9))) for i in range(60)] + [(60, None), (61, "")]
    labels = [(i, i % 2) for i in range(0, 50)] + [(3, 0), (7, None), (None, 1)]

    def buckets(text):
        words = (text or "").split()
        one = [int(quality.gram_buckets([w])[0][0]) for w in words]
        two = [next(int(b) for b in quality.gram_buckets([f"{a} {b_}"])[0][2:]) for a, b_ in zip(words, words[1:])]
        return one + two

    quality_of = {}
    for i, q in labels:
        if i is not None and q is not None:
            quality_of[i] = min(q, quality_of.get(i, 1))
    good = {i for i, q in quality_of.items() if q and zlib.crc32(str(i).encode()) % 5 != 0}
    raw, target = Counter(), Counter()
    for i, t in rows:
        raw.update(buckets(t))
        if i in good:
            target.update(buckets(t))
    prior = {b: (raw[b] + 1) / (sum(raw.values()) + quality.BUCKETS) for b in raw}
    ratio = {b: math.log((target[b] + quality.BUCKETS * p) / (sum(target.values()) + quality.BUCKETS)) - math.log(p) for b, p in prior.items()}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = quality.resample(docs, spark.createDataFrame(labels, "doc_id long, quality int"), 0.5).collect()
    for r in found:
        grams = buckets(dict(rows)[r["doc_id"]])
        want = quality.LENGTH * sum(ratio[b] for b in grams) / max(1, len(grams))
        assert abs(r["log_weight"] - want) < 1e-9
    assert sum(r["kept"] for r in found) == 31
