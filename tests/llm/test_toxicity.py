import random
import zlib

from lapwing.llm import toxicity as tox


def _held_out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = tox.op1_toxicity(spark, sf).collect()
    assert len(rows) == 10000 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert all(r["held_out"] == _held_out(r["doc_id"]) for r in rows)
    test = [(labels[r["doc_id"]], r["score"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    pos, neg = [s for y, s in test if y], [s for y, s in test if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    accuracy = sum((s >= 0.5) == bool(y) for y, s in test) / len(test)
    print("auc", auc, "accuracy", accuracy)
    assert auc > 0.92 and accuracy > 0.95


def test_labels_of_the_held_out_fold_are_not_read(spark, tmp_path):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("toxic", tox.F.when(tox.id_fold(tox.F.col("doc_id")) == 0, 1 - tox.F.col("toxic")).otherwise(tox.F.col("toxic")))
    a, b = tox.learn(docs, labels), tox.learn(docs, flipped)
    assert a.contents == b.contents and (a.weights is None) == (b.weights is None)


def test_odd_rows(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, "x" * 200000), (4, "a b"), (4, "a b")]
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as score").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, None), (None, 1), (7, 1)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = tox.op1_toxicity(spark, str(tmp_path)).collect()
    assert len(got) == 5 and all(r["score"] == 0 and r["predicted"] == 0 for r in got)
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    text = lambda bad: " ".join(w for _ in range(12) for w in ([word(), word(), word()] + ["moron"] * (bad and rng.random() < 0.4)))
    model = tox.fit([text(True) for _ in range(150)], [text(False) for _ in range(300)])
    scores = tox.score_texts([None, "", text(True) + " moron" + text(True), text(False), "abc moron " * 50000], model)
    assert scores[2] > 0.5 > scores[3] and scores[0] == scores[1] and scores[4] > 0.5
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "e" / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(str(tmp_path / "e" / "labels.parquet"))
    assert tox.op1_toxicity(spark, str(tmp_path / "e")).count() == 0


def test_scores_restated():
    """Windows compressed one by one with new compressors, counted and weighed by hand."""
    import math

    import zstandard

    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    text = lambda bad: " ".join(w for _ in range(15) for w in ([word(), word(), word()] + ["wretched"] * (bad and rng.random() < 0.4)))
    model = tox.fit([text(True) for _ in range(200)], [text(False) for _ in range(400)])
    assert len(model.contents[0]) == len(model.contents[1]) and b"wretched" in model.contents[0] and b"wretched" not in model.contents[1]

    def length(window, content):
        params = zstandard.ZstdCompressionParameters.from_level(
            tox.LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS
        )
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=params)
        return len(zstandard.ZstdCompressor(dict_data=d, compression_params=params).compress(window))

    for t in [text(True), text(False), "", "one", "wretched " * 30]:
        words = t.lower().split()
        saved = []
        for i in range(0, len(words), tox.WINDOW):
            window = "".join(" " + w for w in words[i : i + tox.WINDOW]).encode()
            saved.append(length(window, model.contents[1]) - length(window, model.contents[0]))
        n = max(1, len(saved))
        x = [math.log1p(n)]
        for step in tox.STEPS:
            k = sum(s >= step for s in saved)
            x += [math.log1p(k), math.sqrt(k / n)]
        z = sum(w * (v - m) / s for w, v, m, s in zip(model.weights, x, model.mean, model.scale)) + model.weights[-1]
        assert abs(tox.score_texts([t], model)[0] - 1 / (1 + math.exp(-max(-30, min(30, z))))) < 1e-9


def test_what_is_learnt_from(spark):
    """Repeated ids give one text, nulls none, and the held-out fold nothing."""
    rows = [(i, f"text {i}") for i in range(30)] + [(1, "another"), (None, "no id"), (2, None)]
    labels = [(i, i % 2) for i in range(30)] + [(1, 0), (None, 1), (3, None)]
    seen = []
    fit = tox.fit
    try:
        tox.fit = lambda toxic, ordinary: seen.append((toxic, ordinary)) or tox.Model(None)
        tox.learn(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    finally:
        tox.fit = fit
    learnt = [i for i in range(30) if not _held_out(i)]
    want = lambda bad: sorted("another" if i == 1 else f"text {i}" for i in learnt if (i % 2 == 1) == bad)
    assert [sorted(x) for x in seen[0]] == [want(True), want(False)]
