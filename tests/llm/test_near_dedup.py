import random

from lapwing.llm import simhash


def grams(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def brute_kept(rows):
    """Ids that stay, of ``(id, text)`` with distinct ids, by comparing all pairs."""
    rows = sorted(rows)
    sets = [grams(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            small, large = sorted((len(sets[i]), len(sets[j])))
            if 5 * small >= 4 * large:
                common = len(sets[i] & sets[j])
                if 5 * common >= 4 * (small + large - common):
                    p, q = root(i), root(j)
                    label[max(p, q)] = min(p, q)
    return sorted(rows[i][0] for i in range(len(rows)) if root(i) == i)


def _kept(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(r["doc_id"] for r in simhash.near_deduplicate(docs).collect())


def test_around_the_limit(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    line, rows = [word() for _ in range(12)], []
    for _ in range(40):
        base = [word() for _ in range(rng.choice([3, 5, 6, 9, 40, 100, 300]))] + line * rng.randint(0, 2)
        for _ in range(5):
            x = list(base)
            for _ in range(rng.randint(0, max(1, len(x) // 25))):
                x[rng.randrange(len(x))] = word()
            if rng.random() < 0.5:
                rng.shuffle(x)  # the same words, other shingles
            rows.append((len(rows), " ".join(x)))
    rows += [(900, ""), (901, " \n"), (902, "a b c d"), (903, "A  b c D"), (904, "a b c e")]
    # Exactly 0.8: 9 shingles, 8 of them in the other's 9.
    w = [word() + "z" for _ in range(14)]
    rows += [(910, " ".join(w[:13])), (911, " ".join(w[1:14])), (912, " ".join(w[:12] + ["zz", "zy"]))]
    assert _kept(spark, rows) == brute_kept(rows)


def test_group_joined_by_a_chain(spark):
    rng = random.Random(6)
    words = [f"w{rng.randrange(10**9)}" for _ in range(400)]
    rows = [(i, " ".join(words[4 * i : 4 * i + 60])) for i in range(80)]
    rng.shuffle(rows)
    assert brute_kept(rows) == _kept(spark, rows) and len(_kept(spark, rows)) < 10


def test_sample_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert _kept(spark, rows) == brute_kept(rows)


def test_sketches_part_long_sets():
    """512 parities tell nothing of sets of thousands; sketches grow with the sets."""
    import numpy as np

    rng = np.random.default_rng(7)
    allow = simhash._sketches_allow(0.8)
    read = lambda x: np.frombuffer(simhash.sketch(x), np.uint64)
    for n in (1, 9, 300, 3000, 20_000):
        whole = np.unique(rng.integers(0, 1 << 64, 2 * n, dtype=np.uint64))
        one = whole[: n + n // 8]
        assert allow(read(one), [read(one), read(whole[:n])]).all()  # the same, and eight ninths of it
        if n >= 300:  # similarity 0.6; of one set in half the other; nothing in common
            assert not allow(read(whole[:n]), [read(whole[n // 4 : n // 4 + n]), read(whole[: 2 * n]), read(whole[n:])]).any()


def test_long_texts_that_share_passages(spark):
    rng = random.Random(8)
    rows = []
    for _ in range(6):
        base = [f"w{rng.randrange(10**9)}" for _ in range(2000)]
        for _ in range(4):
            x = list(base)
            for k in rng.sample(range(2000), rng.choice([10, 40, 90, 120])):
                x[k] = f"v{rng.randrange(10**9)}"
            rows.append((len(rows), " ".join(x)))
    assert _kept(spark, rows) == brute_kept(rows)


def test_fingerprints_come_first(spark, monkeypatch):
    """The pairs of the four word fingerprints are what brute force connects, and near
    copies are linked through them before any other candidate is made."""
    import numpy as np

    from lapwing.llm.lm_scoring import token_hashes

    rng = random.Random(9)
    rows = []
    for _ in range(12):
        base = [f"w{rng.randrange(10**9)}" for _ in range(300)]
        for _ in range(4):
            x = list(base)
            x[rng.randrange(300)] = f"v{rng.randrange(10**9)}"
            rows.append((len(rows), " ".join(x)))
    prints = simhash.word_prints(*token_hashes([t for _, t in rows])).view(np.uint64)
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (np.bitwise_count(prints[i] ^ prints[j]) <= 3).any():
                label = [min(label[i], label[j]) if x in (label[i], label[j]) else x for x in label]
    seen, verify = [], simhash._verified
    monkeypatch.setattr(simhash, "_verified", lambda pairs, *rest: seen.append(pairs) or verify(pairs, *rest))
    assert _kept(spark, rows) == brute_kept(rows)
    texts = [(i, 1, [int(x) for x in p.view(np.int64)]) for i, p in enumerate(prints)]
    found = simhash.print_pairs(spark.createDataFrame(texts, "node long, n long, prints array<long>"))
    roots = {r["node"]: r["root"] for r in simhash.components(found).collect()}
    assert [roots.get(i, i) for i in range(len(rows))] == label and len(set(label)) < 20
    assert len(seen) == 3 and seen[0].count() == found.count()
