"""Language-model scores from a weighted backoff automaton.

**Model.**  Words and one end per text; the smoothed n-grams of the training
texts, up to ``order`` tokens, make the automaton.  Its states are the root, the
begin of a text and every n-gram of fewer than ``order`` tokens that training
holds.  The root has an arc for every token, with
``P(t) = (c(t) + 0.5) / (N + 0.5 (V + 1))``; a token not seen takes the arc that
``c = 0`` gives, back to the root.  Another state ``s`` has an arc for each token
seen after it, with the probability ``(c(s, t) + K P'(t)) / (c(s) + K)``, where
``P'`` is what the state of one token less (the oldest) gives, and ``K`` the prior
of its order; and a failure arc to that state, with weight ``K / (c(s) + K)``: what
the explicit arcs leave, shared out as there.  The probabilities out of a state
(but the end's, after which nothing is read) sum to one.  An arc leads to the longest state that ends what was read.

**Traversal.**  One pass from left to right carries a state and adds up log10
weights: the arc's if the state has one for the token, else the failure arc's, and
again from there.  Texts are walked side by side, long ones in pieces of ``LANE``
tokens: a piece starts from the root and first reads the ``order - 1`` tokens before
it, which leads to the very state that the whole walk has there.

**Distribution.**  Neither vocabulary nor arcs need fit in one place.  Texts are
packed into blocks of about ``BLOCK_TOKENS`` tokens.  A block sends its distinct
n-grams with their training counts, as packed arrays, to parts of the hash space; a
part adds the counts up over all blocks and answers each block with the totals of
the n-grams that it sent; back at the block its own piece of the automaton is
complete.  Counts are added up before they move, no n-gram is dropped, and a very
frequent n-gram is one entry a block.  The parts grow with the blocks, and a block
sends nothing to a part of which it has no n-gram: there are never more packed
arrays than n-grams.  Tokens are told apart by 64-bit hashes, longer n-grams by 56
bits of theirs while training and other texts have fewer than 2**36 of them, else
by all 64: fewer than one in a million meets another.

Defined results: null and empty texts are the end alone; without training texts
every count is 0 (and V too), so ``P`` is one for the unseen token; repeated rows
are scored each, and trained on each; null ids are no training rows and are not
held out either; ids keep their type; an empty table gives an empty result; columns
other than those named are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from lapwing.llm._common import give_back, id_fold, materialize, read_table, small_batches
from lapwing.llm._words import mixed, tokens
from lapwing.llm.byte_bpe import _rows, _text_cost

#: Tokens of the longest n-grams.
ORDER = 3
#: For n-grams of two tokens and more: the state's count at which its arcs and its
#: failure arc weigh the same.
PRIORS = (3000.0, 10.0)
BLOCK_TOKENS = 1_000_000
#: Tokens of a piece of a long text.
LANE = 512
#: Shuffle partitions at most; a partition holds several parts, one after the other.
MAX_PARTITIONS = 1 << 14
_END, _BEGIN, _STEP = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F), np.uint64(0x9E3779B97F4A7C15)


def token_hashes(texts: list[str | None]):
    """Hashes of the tokens of all texts end to end, and the tokens a text has."""
    code, cuts = tokens(texts)
    return np.insert(code, cuts, _END), np.diff(np.concatenate([[0], cuts])) + 1


# --- the automaton ----------------------------------------------------------


class Grams:
    """Distinct n-grams of one order: counts, the last token, and the numbers of
    the n-grams one token shorter without the last (``context``) and without the
    oldest token (``suffix``)."""

    def __init__(self, total, token, context=None, suffix=None):
        self.total, self.token, self.context, self.suffix = total, token, context, suffix


class Automaton:
    """States, arcs and failure arcs of the n-grams of some texts.

    ``grams[0]`` are single tokens, the begin included; token numbers are places
    there.  State 0 is the root, then come the n-grams below the highest order."""

    def __init__(self, grams: list[Grams], n: int, v: int, priors: tuple[float, ...]):
        sizes = [len(g.total) for g in grams[:-1]]
        base = np.concatenate([[1], 1 + np.cumsum(sizes)]).astype(np.int64)
        states = int(base[-1])
        self.fail, self.fail_weight = np.zeros(states, np.int64), np.zeros(states)
        one = grams[0]
        prob = (one.total + 0.5) / (n + 0.5 * (v + 1))
        known = one.total > 0
        many = len(grams) > 1
        keys, weights = [one.token], [np.log10(prob)]
        targets = [np.where(known, base[0] + np.arange(len(known)), 0) if many else np.zeros(len(known), np.int64)]
        for k, g in enumerate(grams):
            if k:
                prior, below = priors[k - 1], grams[k - 1].total[g.context]
                prob = (g.total + prior * prob[g.suffix]) / (below + prior)
                live = np.flatnonzero(g.total > 0)
                keys.append((base[k - 1] + g.context[live]) << 32 | g.token[live])
                weights.append(np.log10(prob[live]))
                targets.append(base[k] + live if k + 1 < len(grams) else base[k - 1] + g.suffix[live])
            if k + 1 < len(grams):
                here, prior = slice(int(base[k]), int(base[k + 1])), priors[k]
                self.fail[here] = base[k - 1] + g.suffix if k else 0
                self.fail_weight[here] = np.log10(prior / (g.total + prior))
        key = np.concatenate(keys)
        order = np.argsort(key)
        self.key, self.weight, self.target = key[order], np.concatenate(weights)[order], np.concatenate(targets)[order]

    def start(self, begin: int) -> int:
        """The state at the begin of a text."""
        return 1 + begin if len(self.fail) > 1 else 0

    def step(self, state, token):
        """The states after reading a token each, and the log10 weights of it."""
        weight, out = np.zeros(len(state)), np.empty(len(state), np.int64)
        todo = np.arange(len(state))
        while len(todo):
            key = state << 32 | token
            at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            hit = self.key[at] == key  # at the root always
            done, at = todo[hit], at[hit]
            weight[done] += self.weight[at]
            out[done] = self.target[at]
            miss = ~hit
            todo, state, token = todo[miss], state[miss], token[miss]
            weight[todo] += self.fail_weight[state]
            state = self.fail[state]
        return out, weight

    def walk(self, tokens, size, start: int, lead: int, lane: int = LANE):
        """Log10 weight of every token of texts that lie end to end."""
        first = np.cumsum(size) - size
        pieces = -(-size // lane)
        number = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        lo = np.repeat(first, pieces) + number * lane
        n = np.minimum(lane, np.repeat(first + size, pieces) - lo)
        before = np.where(number > 0, lead, 0)
        lo, n = lo - before, n + before
        order = np.argsort(-n, kind="stable")  # those that go on come first
        lo, n, before = lo[order], n[order], before[order]
        state = np.where(before > 0, 0, start)
        out = np.zeros(len(tokens))
        on = np.searchsorted(-n, -np.arange(int(n[0]) if len(n) else 0), "left")
        for k, m in enumerate(on.tolist()):
            at = lo[:m] + k
            state, weight = self.step(state[:m], tokens[at])
            if k < lead:  # some only read what stands before their piece
                own = before[:m] <= k
                at, weight = at[own], weight[own]
            out[at] = weight
        return out


# --- blocks ----------------------------------------------------------------


def _zip(a, dtype) -> bytes:
    import zstandard

    planes = np.ascontiguousarray(a.astype(dtype).view(np.uint8).reshape(len(a), np.dtype(dtype).itemsize).T)
    return zstandard.compress(planes.tobytes(), 1)


def _unzip(data: bytes, dtype):
    import zstandard

    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(dtype).itemsize, -1).T).reshape(-1).view(dtype)


def _block_schema(id_type: str) -> str:
    return f"b long, doc_ids array<{id_type}>, held_out array<boolean>, sizes binary, training binary, hashes binary, tokens binary, n_train long, n_all long"


def _blocks(block_tokens: int, id_type: DataType):
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_type

        part, k = TaskContext.get().partitionId(), 0
        ids, held, training, sizes, codes, have = [], [], [], [], [], 0

        def close():
            size, code, train = np.concatenate(sizes), np.concatenate(codes), np.array(training, bool)
            hashes, number, count = np.unique(code, return_inverse=True, return_counts=True)
            # Frequent tokens get small numbers, which pack well.
            order = np.argsort(-count, kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            row = {
                "b": part << 24 | k, "doc_ids": ids, "held_out": held, "sizes": _zip(size, "<u4"), "training": _zip(train, "u1"),
                "hashes": hashes[order].tobytes(), "tokens": _zip(place[number], "<u4"), "n_train": int(size[train].sum()), "n_all": len(code),
            }
            return pa.RecordBatch.from_pylist([row], schema=schema)

        types = {"b": pa.int64(), "doc_ids": pa.list_(to_arrow_type(id_type)), "held_out": pa.list_(pa.bool_()), "n_train": pa.int64(), "n_all": pa.int64()}
        schema = pa.schema([(c.split()[0], types.get(c.split()[0], pa.binary())) for c in _block_schema("long").split(", ")])
        for piece in _rows(batches, "text", _text_cost, min(1 << 20, 4 * block_tokens)):
            code, size = token_hashes(piece.column(1).to_pylist())
            ids += piece.column(0).to_pylist()
            held += piece.column(2).to_pylist()
            training += piece.column(3).to_pylist()
            sizes.append(size)
            codes.append(code)
            have += len(code)
            if have >= block_tokens:
                yield close()
                k, have = k + 1, 0
                ids, held, training, sizes, codes = [], [], [], [], []
        if ids:
            yield close()

    return run


class _Block:
    """A block's tokens and its distinct n-grams, in the order of their hashes."""

    def __init__(self, row: dict, order: int):
        self.size = _unzip(row["sizes"], "<u4").astype(np.int64)
        train = _unzip(row["training"], "u1").astype(bool)
        word = np.append(np.frombuffer(row["hashes"], "<u8"), _BEGIN)
        sort = np.argsort(word)
        place = np.empty(len(word), np.int64)
        place[sort] = np.arange(len(word))
        #: Tokens as places among the single tokens; the begin is one of these.
        self.tokens, self.begin = place[_unzip(row["tokens"], "<u4").astype(np.int64)], int(place[-1])
        word = word[sort]
        weight, first = np.repeat(train, self.size).astype(np.float64), np.cumsum(self.size) - self.size
        seen = np.bincount(self.tokens, weights=weight, minlength=len(word))
        seen[self.begin] = train.sum()
        #: For each order hashes and counts, and the n-gram that ends at each place.
        self.hashes, self.counts, self.at = [word], [seen], [self.tokens]
        self.context, self.suffix, self.last = [None], [None], [np.arange(len(word))]
        here, context = np.arange(len(self.tokens)), np.empty(len(self.tokens), np.int64)
        context[1:] = self.tokens[:-1]
        context[first] = self.begin
        offset = here - np.repeat(first, self.size)
        for k in range(1, order):
            if k > 1:  # the n-gram before starts with the begin at the earliest
                here = np.flatnonzero(offset >= k - 1)
                context = self.at[-1][here - 1]
            code = mixed(self.hashes[-1][context] * _STEP ^ word[self.tokens[here]])
            hashes, index, number = np.unique(code, return_index=True, return_inverse=True)
            self.context.append(context[index])
            self.suffix.append(self.at[-1][here[index]])
            self.last.append(self.tokens[here[index]])
            self.hashes.append(hashes)
            self.counts.append(np.bincount(number, weights=weight[here], minlength=len(hashes)))
            at = np.full(len(self.tokens), -1)
            at[here] = number
            self.at.append(at)

    def grams(self, totals: list) -> list[Grams]:
        return [Grams(*x) for x in zip(totals, self.last, self.context, self.suffix)]


def _part_of(hashes, parts: int):
    """Which part of the hash space each hash lies in; it grows with the hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _requests(parts: int, order: int, bits: int = 64):
    """A block's n-grams and counts by part; of the hashes of n-grams longer than a
    token the first ``bits`` are sent."""

    def run(batches):
        import pyarrow as pa

        schema = pa.schema([(c.split()[0], pa.int64() if c.endswith("long") else pa.binary()) for c in _request_schema(order).split(", ")])
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                block, cells = _Block(row, order), {}
                for k, (hashes, count) in enumerate(zip(block.hashes, block.counts)):
                    part = _part_of(hashes, parts)
                    cuts = np.flatnonzero(np.diff(part, prepend=-1, append=parts)).tolist()
                    hashes = hashes >> np.uint64(64 - bits) if k else hashes
                    for lo, hi in zip(cuts, cuts[1:]):
                        cell = cells.setdefault(int(part[lo]), {"b": row["b"], "p": int(part[lo])})
                        cell[f"hash_{k}"] = _zip(np.diff(hashes[lo:hi], prepend=np.uint64(0)), "<u8")
                        cell[f"count_{k}"] = _zip(count[lo:hi], "<u4")
                yield pa.RecordBatch.from_pylist(list(cells.values()), schema=schema)
        give_back()

    return run


def _request_schema(order: int) -> str:
    return "b long, p long, " + ", ".join(f"hash_{k} binary, count_{k} binary" for k in range(order))


def _grouped(batches: Iterator, column: int) -> Iterator[list[dict]]:
    """Rows of sorted batches by a column's value."""
    rows: list[dict] = []
    for batch in batches:
        name = batch.schema.names[column]
        for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
            if rows and rows[0][name] != row[name]:
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows
    give_back()


def _answer_schema(order: int) -> str:
    return "b long, p long, known long, " + ", ".join(f"count_{k} binary" for k in range(order))


def _answers(order: int):
    """All requests of a part to answers: totals in the order of each request."""

    def run(batches):
        import pyarrow as pa

        schema = pa.schema([(c.split()[0], pa.int64() if c.endswith("long") else pa.binary()) for c in _answer_schema(order).split(", ")])
        for rows in _grouped(batches, 1):
            cells, known = [{"b": r["b"], "p": r["p"]} for r in rows], 0
            for k in range(order):
                asked = [i for i, r in enumerate(rows) if r[f"hash_{k}"] is not None]
                if not asked:
                    continue
                hashes = [np.cumsum(_unzip(rows[i][f"hash_{k}"], "<u8"), dtype=np.uint64) for i in asked]
                count = [_unzip(rows[i][f"count_{k}"], "<u4") for i in asked]
                keys, index = np.unique(np.concatenate(hashes), return_inverse=True)
                total = np.bincount(index, weights=np.concatenate(count), minlength=len(keys))
                if k == 0:
                    known = int(((total > 0) & (keys != _BEGIN)).sum())
                at = 0
                for i, h in zip(asked, hashes):
                    cells[i][f"count_{k}"] = _zip(total[index[at : at + len(h)]], "<u8")
                    at += len(h)
            for cell in cells:
                cell["known"] = known
                yield pa.RecordBatch.from_pylist([cell], schema=schema)

    return run


def _score_schema(id_type: str) -> str:
    return f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _scored(n: int, v: int, order: int, priors: tuple[float, ...], id_type: DataType):
    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        for rows in _grouped(batches, 0):
            *answers, last = rows
            block = _Block(last, order)
            totals = [
                np.concatenate([np.zeros(0, "<u8"), *[_unzip(a[f"count_{k}"], "<u8") for a in answers if a[f"count_{k}"] is not None]]).astype(np.float64)
                for k in range(order)
            ]
            automaton = Automaton(block.grams(totals), n, v, priors)
            weight = automaton.walk(block.tokens, block.size, automaton.start(block.begin), order - 1)
            count = totals[0][block.tokens]
            base = np.log10((count + 0.5) / (n + 0.5 * (v + 1)))
            first = np.cumsum(block.size) - block.size
            per = lambda x: np.add.reduceat(x, first)  # noqa: E731  every text has a token
            columns = [
                pa.array(last["doc_ids"], to_arrow_type(id_type)), pa.array(last["held_out"], pa.bool_()), pa.array(block.size, pa.int64()),
                pa.array(per((count > 0).astype(np.int64)), pa.int64()), pa.array(np.full(len(block.size), n), pa.int64()),
                pa.array(per(base), pa.float64()), pa.array(per(weight), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _score_schema("long").split(", ")])

    return run


def score(docs: DataFrame, priors: tuple[float, ...] = PRIORS, block_tokens: int = BLOCK_TOKENS, order: int = ORDER) -> DataFrame:
    """Scores of ``docs`` (``doc_id, text, held_out, training``), one row each."""
    id_type = docs.schema["doc_id"].dataType
    name = id_type.simpleString()
    rows = small_batches(docs).select("doc_id", "text", "held_out", "training")
    blocks = materialize(rows.mapInArrow(_blocks(block_tokens, id_type), _block_schema(name)), "blocks")
    seen = blocks.agg(F.count(F.lit(1)).alias("blocks"), F.coalesce(F.sum("n_train"), F.lit(0)).alias("n"), F.coalesce(F.sum("n_all"), F.lit(0)).alias("all")).first()
    parts, bits = max(seen["blocks"], 1), 56 if seen["all"] * (order - 1) < 1 << 36 else 64
    partitions = min(parts, MAX_PARTITIONS)
    asked = blocks.mapInArrow(_requests(parts, order, bits), _request_schema(order)).repartition(partitions, "p").sortWithinPartitions("p", "b")
    answers = materialize(asked.mapInArrow(_answers(order), _answer_schema(order)), "answers")
    known = answers.groupBy("p").agg(F.max("known").alias("v")).agg(F.coalesce(F.sum("v"), F.lit(0)).alias("v")).first()["v"]
    both = answers.drop("known").unionByName(blocks.drop("n_train", "n_all").withColumn("p", F.lit(parts).cast("long")), allowMissingColumns=True)
    dealt = both.select("b", "p", *[c for c in both.columns if c not in ("b", "p")]).repartition(partitions, "b").sortWithinPartitions("b", "p")
    return dealt.mapInArrow(_scored(seen["n"], known, order, tuple(priors), id_type), _score_schema(name))


def op5_lm_scoring(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    fold = id_fold(F.col("doc_id"))
    return score(docs.select("doc_id", "text", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), F.coalesce(fold != 1, F.lit(False)).alias("training")))
