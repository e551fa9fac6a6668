import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lapwing.llm import lm_scoring as lm

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


END, BEGIN = "<end>", "<begin>"  # words get a letter in front


def _tokens(t):
    return ["w" + w for w in re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))] + [END]


def _fold(i):
    return None if i is None else zlib.crc32(str(i).encode()) % 5


class Brute:
    """Counts as dictionaries; probabilities by the recursion over histories."""

    def __init__(self, texts, priors, order):
        self.priors, self.order, self.count = priors, order, Counter()
        for t in texts:
            w = [BEGIN, *_tokens(t)]
            self.count.update(tuple(w[i : i + k]) for k in range(1, order + 1) for i in range(len(w) - k + 1))
        words = {g: c for g, c in self.count.items() if len(g) == 1 and g != (BEGIN,)}
        self.n, self.v = sum(words.values()), len(words)

    def prob(self, history, token):
        if not history:
            return (self.count[token,] + 0.5) / (self.n + 0.5 * (self.v + 1))
        rest, seen, prior = self.prob(history[1:], token), self.count[history], self.priors[len(history) - 1]
        return (self.count[*history, token] + prior * rest) / (seen + prior)

    def score(self, text):
        w, total = [BEGIN, *_tokens(text)], 0.0
        for i in range(1, len(w)):
            total += math.log10(self.prob(tuple(w[max(0, i - self.order + 1) : i]), w[i]))
        return total


def brute(rows, priors=lm.PRIORS, order=lm.ORDER):
    model = Brute([t for i, t in rows if _fold(i) not in (None, 1)], priors, order)
    out = []
    for i, t in rows:
        w = _tokens(t)
        base = sum(math.log10(model.prob((), x)) for x in w)
        out.append((i, _fold(i) == 1, len(w), sum(model.count[x,] > 0 for x in w), model.n, base, model.score(t)))
    return out


def _key(r):
    return (r[0] is None, r[0] or 0, r[2], round(r[6], 6))


def _same(got, want):
    got, want = sorted(map(tuple, got), key=_key), sorted(want, key=_key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    np.testing.assert_allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9)


def test_sample_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = lm.op5_lm_scoring(spark, sf).collect()
    _same(got, brute(rows))
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def _marked(docs):
    fold = lm.id_fold(lm.F.col("doc_id"))
    cols = [lm.F.coalesce(x, lm.F.lit(False)).alias(n) for x, n in ((fold == 1, "held_out"), (fold != 1, "training"))]
    return docs.select("doc_id", "text", *cols)


@pytest.mark.parametrize("block_tokens", [5, 2_000_000])
@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_odd_rows(spark, block_tokens, order):
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "One two ONE two É é"), (5, "one " * 3000), (5, "one two"), (5, "one two"), (None, "two one"), (6, "nbsp in word"), (12, "never seen"), (14, "x" * 9999)]
    rows += [(i, f"one two {i % 3}") for i in range(20, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as b", "2 as p").repartition(3)
    priors = (3.0, 2.0, 0.5)
    _same(lm.score(_marked(docs), priors, block_tokens, order).collect(), brute(rows, priors, order))


def test_words_that_defeat_polynomial_hashes(spark):
    """A Thue-Morse word and its complement agree under any polynomial hash modulo
    2**64 from 1,024 letters on."""
    rows = []
    for k, n in enumerate((512, 1024, 2048, 4096)):
        word = "".join("ab"[bin(i).count("1") & 1] for i in range(n))
        learnt = [i for i in range(100 * k, 100 * k + 100) if _fold(i) != 1][0]
        held = [i for i in range(100 * k, 100 * k + 100) if _fold(i) == 1][0]
        rows += [(learnt, word + " x"), (held, word.translate(str.maketrans("ab", "ba")) + " x")]
    got = lm.score(_marked(spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    _same(got, brute(rows))
    assert {r["n_known"] for r in got if r["held_out"]} == {2}  # x and the end


def test_ids_keep_their_type(spark):
    rows = [("a", "one two"), ("b", None), (None, "two")]
    got = lm.score(_marked(spark.createDataFrame(rows, "doc_id string, text string")))
    assert dict(got.dtypes)["doc_id"] == "string" and {r["doc_id"] for r in got.collect()} == {"a", "b", None}


def test_a_shuffle_row_needs_an_ngram(spark):
    """However many parts there are, a block has no more requests than n-grams."""
    rows = [(i, f"one two w{i}") for i in range(40)]
    for parts in (1, 7, 1_000_000):
        blocks = _marked(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).mapInArrow(lm._blocks(30, lm.DataType.fromDDL("long")), lm._block_schema("bigint"))
        sent = blocks.mapInArrow(lm._requests(parts, 3), lm._request_schema(3)).groupBy("b").count().collect()
        assert all(r["count"] <= min(parts, 3 * 4 * 30) for r in sent)


def test_nothing_to_learn_from(spark, tmp_path):
    held = [i for i in range(50) if zlib.crc32(str(i).encode()) % 5 == 1][:3]
    rows = [(i, "a b") for i in held]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    _same(lm.op5_lm_scoring(spark, str(tmp_path)).collect(), brute(rows))
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "e" / "documents.parquet"))
    assert lm.op5_lm_scoring(spark, str(tmp_path / "e")).count() == 0


def _grams(texts, order):
    """The automaton's input, from dictionaries."""
    model, out, at = Brute(texts, (), order), [], []
    for k in range(1, order + 1):
        found = sorted(g for g in model.count if len(g) == k)
        at.append({g: i for i, g in enumerate(found)})
        total, last = np.array([model.count[g] for g in found], float), np.array([at[0][g[-1:]] for g in found])
        below = [np.array([at[k - 2][x] for x in y]) for y in ([g[:-1] for g in found], [g[1:] for g in found])] if k > 1 else (None, None)
        out.append(lm.Grams(total, last, *below))
    return model, out, at[0]


@pytest.mark.parametrize("order", [1, 2, 3, 5])
def test_walk_in_pieces_is_the_whole_walk(order):
    texts = ["a b a c a b a d " * 30, "b b b", "", "c a b"]
    model, grams, number = _grams(texts, order)
    model.priors = priors = (3.0, 1.0, 0.5, 2.0)
    automaton = lm.Automaton(grams, model.n, model.v, priors)
    tokens = [[number[w,] for w in _tokens(t)] for t in texts]
    flat, size = np.concatenate(tokens), np.array([len(t) for t in tokens])
    walks = [automaton.walk(flat, size, automaton.start(number[BEGIN,]), order - 1, lane) for lane in (order, 7, 10_000)]
    want = [model.score(t) for t in texts]
    for got in walks:
        np.testing.assert_allclose(np.add.reduceat(got, np.cumsum(size) - size), want, rtol=1e-12)


def test_probabilities_out_of_a_state_sum_to_one():
    model, grams, number = _grams(["a b a c a b a", "b a"], 3)
    automaton = lm.Automaton(grams, model.n, model.v, (3.0, 0.7))
    unseen = 0.5 / (model.n + 0.5 * (model.v + 1))
    tokens = np.array([i for w, i in number.items() if w != (BEGIN,)])
    of_state = [(), *[g for k in (1, 2) for g in sorted(x for x in model.count if len(x) == k)]]
    for state in [k for k, g in enumerate(of_state) if END not in g]:  # nothing is read after the end
        out = np.power(10.0, automaton.step(np.full(len(tokens), state), tokens)[1]).sum()
        back, s = 0.0, state
        while s:  # an unseen token takes every failure arc
            back, s = back + automaton.fail_weight[s], automaton.fail[s]
        assert abs(out + 10**back * unseen - 1) < 1e-12
