import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from lapwing.llm import token_store as ts

ODD = [
    None, "", " ", "\n\t", "One two", "it's I'LL <|endoftext|> x<|ENDOFTEXT|>y", "É é É ǅ İstanbul ΣΑΣ", "a1b22 3.14!!", "x" * 3000,
    "tab\tsep\x0bvt\x0cff\rcr\x1c\x85nel nbsp　wide", "word " * 5000, "日本語 テキスト 한국어", "%%% ...,,, a,b;c", " ́ combining", "the the the The THE",
]


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(P.path(ts.TOKENIZER))


def _want(lib, rows):
    out, start = [], 0
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0, r[1] is not None, (r[1] or "").encode()))
    for i, t in order:
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, ts.END_ID]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


def _random_rows(n):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeéXYZ12.,'") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    return [(i, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(n)]


def test_round_trip_and_random_access(spark, lib):
    rows = [(k * 3, t) for k, t in enumerate(ODD)] + [(k + 1000, t) for k, t in _random_rows(400)] + [(1001, "again"), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as part", "1 as ids")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    shards = ts.write(docs.repartition(3), shard_ids=4000)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert shards.count() > 4 and shards.select("part").distinct().count() > 1
    got = sorted((tuple(r) for r in ts.read(shards).collect()), key=lambda r: r[1])
    assert got == _want(lib, rows)
    by_id = {r[0]: r[4] for r in got}
    row = shards.orderBy("part", "block").collect()[2]
    shard = ts.Shard(bytes(row["payload"]))
    for k in (0, 1, len(row["doc_ids"]) - 1):
        ids = by_id[row["doc_ids"][k]]
        assert shard.document(k).tolist() == ids
        for lo, hi in ((0, 1), (2, 7), (0, len(ids)), (len(ids) - 1, len(ids))):
            assert shard.part(k, lo, hi).tolist() == ids[lo:hi]


def test_grammar_is_smaller_and_exact():
    rng = np.random.default_rng(1)
    flat = rng.integers(0, 50, 4000).astype("<i4")
    offsets = np.concatenate([[0], np.sort(rng.choice(4000, 900, replace=False)), [4000]])
    offsets = np.concatenate([[0, 1], offsets[1:]])
    flat[0] = ts.END_ID
    docs = [np.append(rng.integers(1, 800, rng.integers(0, 300)), 0) for _ in range(200)]
    docs += [np.append(np.full(5000, 7), 0)]
    words = np.concatenate(docs)
    symbols, at, rules = ts.compress(words, flat, offsets, [len(d) for d in docs], 64)
    shard = ts.Shard(ts.pack(symbols, at, rules, 64))
    want = [np.concatenate([flat[offsets[w] : offsets[w + 1]] for w in d]).tolist() for d in docs]
    assert [x.tolist() for x in shard.documents(7)] == want
    assert len(symbols) < sum(map(len, want)) / 2


def test_query(spark, lib, tmp_path):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(5, "tie"), (5, "tie")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(tuple(r) for r in ts.op9_token_store(spark, str(tmp_path)).collect())
    assert got == sorted(r[:4] for r in _want(lib, rows))
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "e" / "documents.parquet"))
    assert ts.op9_token_store(spark, str(tmp_path / "e")).count() == 0


def test_words_that_defeat_polynomial_hashes(spark, lib):
    """A Thue-Morse word and its complement agree under any polynomial hash modulo
    2**64 from 1,024 letters on."""
    rows = []
    for k, n in enumerate((512, 1024, 2048, 4096)):
        word = "".join("ab"[bin(i).count("1") & 1] for i in range(n))
        rows += [(2 * k, word), (2 * k + 1, word.translate(str.maketrans("ab", "ba")))]
    got = ts.read(ts.write(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == _want(lib, rows)


def test_pieces_of_one_code_are_told_apart(monkeypatch, lib):
    """With a code that knows only a word's length, bytes decide."""
    monkeypatch.setattr(ts, "codes", lambda data, begin, end: (end - begin).astype(np.uint64))
    table = ts.Words(P.path(ts.TOKENIZER))
    for texts in (["one", "two three"], ["six one two", "one"], ["ten seven", "one three eight"], [None, "two"]):
        flat_rows = table.rows(texts)
        flat, offsets = table.table()
        for t, rows in zip(texts, flat_rows):
            ids = [int(i) for r in rows for i in flat[offsets[r] : offsets[r + 1]]]
            assert ids == [*lib.encode(t or "", add_special_tokens=False).ids, ts.END_ID]


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_no_pair_is_left_frequent(seed):
    rng = np.random.default_rng(seed)
    flat = rng.zipf(1.3, 3000).clip(max=60).astype("<i4")
    offsets = np.concatenate([[0], np.sort(rng.choice(np.arange(1, 3000), 700, replace=False)), [3000]])
    words = rng.zipf(1.2, 40_000).clip(max=700) - 1
    sizes = rng.multinomial(40_000 - 50, np.ones(50) / 50) + 1
    words[200:900] = 3  # a long run
    symbols, at, rules = ts.compress(words, flat, offsets, sizes.tolist(), 100, minimum=8)
    pairs = np.stack([symbols[:-1], symbols[1:]], axis=1)[~np.isin(np.arange(1, len(symbols)), at)]
    assert np.unique(pairs, axis=0, return_counts=True)[1].max() < 8
    assert len({tuple(r) for r in rules.tolist()}) == len(rules)  # a pair has one rule
    shard = ts.Shard(ts.pack(symbols, at, rules, 100))
    ends = np.cumsum(sizes)
    for k, got in enumerate(shard.documents()):
        want = [flat[offsets[w] : offsets[w + 1]] for w in words[ends[k] - sizes[k] : ends[k]]]
        assert (got == np.concatenate(want)).all()


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        ts.Words(P.path("byte_bpe_50k.json"))
