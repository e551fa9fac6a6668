import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from lapwing.llm import _units, byte_bpe, token_counts

ODD = [
    None, "", " ", "\n", "  a", "a  b", "a \n b", "a\n\nb c ", " lead", "it's I'll 'tis o'clock '' 's", "x" * 5000, "1234567 89 ½ Ⅷ",
    "a b   c　", "tab\t\ttab \x1c\x1d y", "<|endoftext|>", "a <|endoftext|> b<|endoftext|>c", "😀 日本語 テキスト", "é é",
    "trail ", "trail\n", "  " * 3000, "\x00\x01 \x7f", "a  " * 2000, "ends with nbsp  x  y",
]


def _random_texts(n):
    rng = random.Random(5)
    bits = ["the", " ", "  ", "\n", "ing", "é", "'s", "'", ".", "42", "日本", "\t", " ", "Word", "<|endoftext|>", "<|", "ß", "👍🏽", "a", "B"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    return ODD + _random_texts(3000)


def test_pieces_encode_like_the_rank_library(texts):
    ranks = byte_bpe.read_ranks(P.path(byte_bpe.RANK_FILE))
    want = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    bpe = byte_bpe.ByteBPE(P.path(byte_bpe.RANK_FILE))
    inverse = byte_bpe.Decoder(P.path(byte_bpe.RANK_FILE))
    import numpy as np

    for t, ids in zip(texts, bpe.encode(texts)):
        got = np.frombuffer(ids, "<i4").tolist()
        assert got == want.encode_ordinary(t or ""), t
        assert inverse.decode(got) == (t or "").encode()


def test_counts_like_the_library(texts):
    lib = Tokenizer.from_file(P.path(token_counts.TOKENIZER))
    got = token_counts.Counter(P.path(token_counts.TOKENIZER)).count(texts)
    for t, n in zip(texts, got):
        assert n == len(lib.encode(t or "", add_special_tokens=False).ids), t


def test_small_table_changes_nothing(texts):
    c = token_counts.Counter(P.path(token_counts.TOKENIZER))
    whole = c.count(texts)
    c._table = _units.UnitTable(c._code, limit=20)
    assert [c.count(texts[i : i + 7]) for i in range(0, 700, 7)] == [whole[i : i + 7] for i in range(0, 700, 7)]


def test_queries(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(0, "again"), (0, "again")]
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as ids", "2 as n_tokens").write.parquet(str(tmp_path / "documents.parquet"))
    ranks = byte_bpe.read_ranks(P.path(byte_bpe.RANK_FILE))
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for i, t in rows:
        ids = enc.encode_ordinary(t or "")
        want.append((i, len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode())))
    assert sorted(tuple(r) for r in byte_bpe.op3_byte_bpe(spark, str(tmp_path)).collect()) == sorted(want)
    got = {(r["doc_id"], r["n_bytes"]): (r["n_tokens"], r["over_limit"]) for r in token_counts.op7_token_counts(spark, str(tmp_path)).collect()}
    lib = Tokenizer.from_file(P.path(token_counts.TOKENIZER))
    for i, t in rows:
        n = len(lib.encode(t or "", add_special_tokens=False).ids)
        assert got[(i, len((t or "").encode()))] == (n, n > 1024)


def test_encode_then_decode(spark):
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string").selectExpr("*", "1 as ids")
    two = byte_bpe.decode(byte_bpe.encode(docs)).orderBy("doc_id").collect()
    one = byte_bpe.round_trip(docs).orderBy("doc_id").collect()
    assert two == one and [bytes(r["decoded"]) for r in one] == [(t or "").encode() for t in ODD]


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert byte_bpe.op3_byte_bpe(spark, str(tmp_path)).count() == 0
    assert token_counts.op7_token_counts(spark, str(tmp_path)).count() == 0
