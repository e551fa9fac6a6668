import random

import numpy as np
import xxhash

from lapwing.llm import simhash
from lapwing.llm.components import components


def brute_print(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    grams = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << j for j in range(64) if 2 * sum(x >> j & 1 for x in h) > len(h))


def brute_classes(prints):
    """id -> smallest id reachable over links of at most 3 bits."""
    ids = sorted(prints)
    arr = np.array([prints[i] for i in ids], dtype=np.uint64)
    label = {}
    for k, i in enumerate(ids):
        if i in label:
            continue
        stack, label[i] = [k], i
        while stack:
            near = np.flatnonzero(np.bitwise_count(arr ^ arr[stack.pop()]) <= 3)
            for j in near.tolist():
                if ids[j] not in label:
                    label[ids[j]] = i
                    stack.append(j)
    return label


def _roots(spark, values, hot_size=simhash.HOT):
    nodes = spark.createDataFrame([(simhash._signed(int(v)),) for v in values], "fp long")
    got = {r["node"] % (1 << 64): r["root"] % (1 << 64) for r in components(simhash.links(nodes, hot_size).select('a', 'b')).collect()}
    return {v: got.get(v, v) for v in values}


def _same_partition(one, other):
    a, b = {}, {}
    for k in one:
        a.setdefault(one[k], set()).add(k)
        b.setdefault(other[k], set()).add(k)
    assert sorted(map(sorted, a.values())) == sorted(map(sorted, b.values()))


def _cluster(rng, n, bits):
    out = set()
    for _ in range(n):
        base = rng.getrandbits(64)
        out.add(base)
        for _ in range(6):
            x = base
            for b in rng.sample(range(64), rng.randint(1, bits)):
                x ^= 1 << b
            out.add(x)
    return sorted(out)


def test_links_lose_nothing(spark):
    values = _cluster(random.Random(1), 150, 5)
    _same_partition(_roots(spark, values), brute_classes({v: v for v in values}))


def test_hot_buckets_are_refined(spark):
    rng = random.Random(2)
    base = rng.getrandbits(64)
    values = {base}
    for _ in range(1500):
        x = base
        for b in rng.sample(range(20), rng.randint(1, 9)):
            x ^= 1 << b
        values.add(x)
    values = sorted(values | set(_cluster(rng, 40, 4)))
    _same_partition(_roots(spark, values, 40), brute_classes({v: v for v in values}))


def test_sample_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    prints = {r["doc_id"]: brute_print(r["text"]) for r in rows}
    want = brute_classes(prints)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.op10_simhash(spark, sf).collect()}
    assert got == {i: (f"{prints[i]:016x}", want[i]) for i in prints}


def test_odd_rows(spark, tmp_path):
    rows = [(5, None), (4, ""), (9, " \t\n"), (7, "One"), (7, "one"), (8, "two words"), (1, "a b c"), (None, "a B  c"), (None, "lonely x y z"), (3, "ÉA b c " * 30000)]
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as fp", "2 as root").write.parquet(str(tmp_path / "documents.parquet"))
    got = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.op10_simhash(spark, str(tmp_path)).collect()]
    assert len(got) == len(rows)
    ids = {(d, f): c for d, f, c in got}
    zero = "0" * 16
    assert ids[(5, zero)] == ids[(4, zero)] == ids[(9, zero)] == 4
    assert ids[(None, f"{brute_print('a b c'):016x}")] == 1
    assert ids[(None, f"{brute_print('lonely x y z'):016x}")] is None
    assert {f for _, f, _ in got} == {f"{brute_print(t):016x}" for _, t in rows}
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "e" / "documents.parquet"))
    assert simhash.op10_simhash(spark, str(tmp_path / "e")).count() == 0


def test_near_copies_go_and_others_stay(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    base = [[word() for _ in range(200)] for _ in range(60)]
    rows, copies = [], set()
    for i, w in enumerate(base):
        rows.append((i * 10, " ".join(w), "k"))
        for c in range(1, 3):
            x = list(w)
            x[rng.randrange(200)] = word()
            rows.append((i * 10 + c, " ".join(x), "k"))
            copies.add(i * 10 + c)
    rows += [(9001, None, "k"), (9002, "", "k"), (None, "a text of its own without an id", "k"), (9003, "one", "k"), (9004, "two", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, root string")
    kept = [r["doc_id"] for r in simhash.near_deduplicate(docs).collect()]
    assert sorted(x for x in kept if x is not None) == sorted({r[0] for r in rows if r[0] is not None} - copies - {9002}) and None in kept
    assert simhash.near_deduplicate(docs.limit(0)).count() == 0
