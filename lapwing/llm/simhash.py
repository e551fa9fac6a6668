"""SimHash near-duplicates with pigeonring filtering.

**Fingerprints.**  XXH64 (seed 42) of every word shingle; bit ``j`` of the
fingerprint is set if it is set in over half the hashes.

**Candidates.**  The 64 bits make a ring of four 16-bit segments.  If two
fingerprints differ in at most 3 bits, some segment starts a chain in which the
first segment has no difference, the first two at most 1, the first three at most
2 and all four at most 3 (the pigeonring principle: every prefix of the chain
stays within its share of the budget).  The budgets also bound what must be equal
inside the chain: of the second segment's two halves one agrees, of the 24 bits
left in the first three segments one of three bytes agrees.  So each fingerprint
goes to 4 x 2 x 3 buckets that fix 32 of its bits, and nothing within 3 bits is
missed.  Inside a bucket pairs are pruned by the chain budgets, prefix by prefix,
before the full Hamming check.

**Hot buckets.**  Nodes are *distinct* fingerprints, so exact copies cost nothing
here, and a bucket returns a spanning forest of its links, never all pairs.  A
bucket with over ``HOT`` members is not compared: its members go on to buckets
that fix a quarter of the remaining bits each (with at most 3 differences one of
four parts agrees).  A bucket with ``f`` free bits holds at most ``2**f``
distinct fingerprints, so the refinement ends by itself and drops nothing.

Defined results: null and empty texts have fingerprint zero and link with each
other like any other text; fewer words than a shingle make one shingle; repeated
rows share a component; null ids take part but never name a component that has
another id; an empty table gives an empty result; extra columns are ignored, whatever
they are called.  :func:`near_deduplicate` keeps them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapwing.llm._common import give_back, materialize, parted, read_table, slot, small_batches
from lapwing.llm._words import mixed
from lapwing.llm.components import components

MAX_BITS = 3
SHINGLE = 3
HOT = 8192
_SMALL = 8
_SEG = 16


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of one text."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxh64_intdigest(b" ".join(words), 42)
    grams = zip(*[words[i:] for i in range(shingle)])
    h = np.array([xxh64_intdigest(b" ".join(g), 42) for g in grams], dtype="<u8")
    n, ones = len(h), np.zeros(64, dtype=np.int64)
    for at in range(0, n, 4096):  # bounds the unpacked bits of a very long text
        bits = np.unpackbits(h[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a signed long."""

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        out = np.array([fingerprint_of(t, shingle) for t in texts], dtype=np.uint64)
        return pd.Series(out.view(np.int64))

    return fp(text)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def first_masks() -> list[tuple[int, int]]:
    """``(start, mask)`` of the 24 first buckets; each mask fixes 32 bits."""
    out = []
    byte = lambda start, k: 0xFF << ((start * _SEG + 8 * k) % 64)  # noqa: E731  byte k of the ring read from start
    for start in range(4):
        for half in (2, 3):
            for third in [k for k in (2, 3, 4, 5) if k != half]:
                out.append((start, byte(start, 0) | byte(start, 1) | byte(start, half) | byte(start, third)))
    return out


def finer_masks(mask: int) -> list[int]:
    """Four masks that each also fix a quarter of the free bits."""
    free = [b for b in range(64) if not mask >> b & 1]
    cuts = [len(free) * k // 4 for k in range(5)]
    return [mask | sum(1 << b for b in free[cuts[k] : cuts[k + 1]]) for k in range(4)]


def _chain_links(a, b, start):
    """Where the pairs of fingerprints link by a viable chain from ``start``."""
    x, turn = a ^ b, np.uint64(_SEG * start)
    if start:
        x = (x >> turn) | (x << np.uint64(64 - _SEG * start))
    ok = np.bitwise_count(x & np.uint64(0xFFFFFFFF)) <= 1
    ok &= np.bitwise_count(x & np.uint64(0xFFFFFFFFFFFF)) <= 2
    ok[ok] = np.bitwise_count(x[ok]) <= MAX_BITS  # the full check, on what is left
    return ok


def _forest(members, start) -> list[tuple[int, int]]:
    """A spanning forest of the links among the members of one bucket."""
    n = len(members)
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    edges = []
    for i in range(n - 1):
        rest = members[i + 1 :]
        for j in np.flatnonzero(_chain_links(rest, members[i], start)).tolist():
            p, q = root(i), root(i + 1 + j)
            if p != q:
                parent[max(p, q)] = min(p, q)
                edges.append((members[i], rest[j]))
    return edges


def _compare(hot_size: int) -> Callable[[Iterator], Iterator]:
    return lambda batches: _compared(batches, hot_size)


class _Rows:
    """Output rows, gathered until there are enough for a batch."""

    def __init__(self):
        self._parts, self._n = [], 0

    def add(self, hot: bool, start: int, mask: int, a, b) -> None:
        if len(a):
            self._parts.append((hot, start, mask, np.asarray(a, np.uint64), np.asarray(b, np.uint64)))
            self._n += len(a)

    def batches(self, least: int) -> Iterator:
        import pyarrow as pa

        if self._n <= least:
            return
        size = [len(x[3]) for x in self._parts]
        cols = [np.repeat([x[k] for x in self._parts], size) for k in range(3)]
        cols = [pa.array(cols[0], pa.bool_()), pa.array(cols[1].astype(np.int32)), pa.array(cols[2].astype(np.int64))]
        cols += [pa.array(np.concatenate([x[k] for x in self._parts]).view(np.int64)) for k in (3, 4)]
        self._parts, self._n = [], 0
        yield pa.RecordBatch.from_arrays(cols, ["hot", "start", "mask", "a", "b"])


def _compared(batches: Iterator, hot_size: int) -> Iterator:
    """Sorted ``start, mask, fp`` rows to ``hot, start, mask, a, b`` rows: links,
    or (``hot``) members of a bucket that is too large to compare here.

    Buckets of up to ``_SMALL`` members are compared all together, neighbour with
    neighbour, then with the next but one, and so on; larger ones one by one."""
    out = _Rows()

    def close(group, start, mask):
        edges = _forest(np.concatenate(group), start % 4)
        if edges:
            out.add(False, start, mask, *zip(*edges))

    group, key, held, hot = [], None, 0, False
    for batch in batches:
        start, mask = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        fp = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
        if not len(fp):
            continue
        bucket = fp & mask.view(np.uint64)
        change = np.flatnonzero((bucket[1:] != bucket[:-1]) | (mask[1:] != mask[:-1]) | (start[1:] != start[:-1])) + 1
        bounds = np.concatenate([[0], change, [len(fp)]])
        size = bounds[1:] - bounds[:-1]
        plain = size <= _SMALL
        plain[0] = plain[-1] = False  # they may go on in the next batch
        at = np.repeat(np.where(plain, np.arange(len(size)), -1), size)
        for step in range(1, _SMALL):
            i = np.flatnonzero((at[step:] == at[:-step]) & (at[step:] >= 0))
            if not len(i):
                break
            for turn in range(4):
                j = i[start[i] % 4 == turn]
                if len(j):
                    j = j[_chain_links(fp[j], fp[j + step], turn)]
                    for s in np.unique(start[j]).tolist():
                        k = j[start[j] == s]
                        out.add(False, s, 0, fp[k], fp[k + step])
        for k in np.flatnonzero(~plain).tolist():
            lo, hi = int(bounds[k]), int(bounds[k + 1])
            this = (int(start[lo]), int(mask[lo]), int(bucket[lo]))
            if this != key:
                if key is not None and not hot and held > 1:
                    close(group, key[0], key[1])
                group, key, held, hot = [], this, 0, False
            part = fp[lo:hi].copy()
            held += hi - lo
            if hot:
                out.add(True, key[0], key[1], part, part)
            else:
                group.append(part)
                if held > hot_size:
                    hot, whole, group = True, np.concatenate(group), []
                    out.add(True, key[0], key[1], whole, whole)
        yield from out.batches(20_000)
    if key is not None and not hot and held > 1:
        close(group, key[0], key[1])
    yield from out.batches(0)
    give_back()


def links(prints: DataFrame, hot_size: int = HOT) -> DataFrame:
    """Links ``a, b`` that connect exactly the fingerprints (distinct ``fp``)
    which a path of steps of at most 3 bits connects; of each ``seed`` apart, if
    there is such a column."""
    where = [F.struct(F.lit(s).alias("start"), F.lit(_signed(m)).alias("mask")) for s, m in first_masks()]
    seed = F.col("seed") if "seed" in prints.columns else F.lit(0)
    rows = prints.select("fp", seed.alias("seed"), F.explode(F.array(*where)).alias("w"))
    rows = rows.select((F.col("seed") * 4 + F.col("w.start")).cast("int").alias("start"), "w.mask", "fp")
    found = None
    finer = F.udf(lambda m: [_signed(x) for x in finer_masks(m % (1 << 64))], "array<long>")
    while True:
        bucket = F.col("fp").bitwiseAND(F.col("mask"))
        dealt = rows.repartition("start", "mask", bucket.alias("bucket")).sortWithinPartitions("start", "mask", bucket)
        out = materialize(dealt.mapInArrow(_compare(hot_size), "hot boolean, start int, mask long, a long, b long"), "buckets")
        edges = out.where("not hot").select(F.expr("start div 4").cast("int").alias("seed"), "a", "b")
        found = edges if found is None else found.unionByName(edges)
        hot = out.where("hot")
        if hot.isEmpty():
            return found.distinct()
        rows = hot.select("start", F.explode(finer("mask")).alias("mask"), F.col("a").alias("fp")).distinct()


def classes(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fp, component_id``."""
    prints = materialize(small_batches(docs).select(F.col(id_col).alias("doc_id"), fingerprint(F.col(text_col), shingle).alias("fp")), "prints")
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = materialize(components(links(nodes.select("fp")).select("a", "b")), "roots")
    named = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = materialize(named, "named")
    least = materialize(named.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    final = materialize(named.select("fp", "root").join(least, "root").select("fp", "component_id"), "classes")
    return prints.join(final, "fp").select("doc_id", "fp", "component_id")


# --- near duplicates by exact similarity ------------------------------------

#: Words of a shingle, and the Jaccard similarity from which two texts are copies.
NEAR_WORDS = 5
NEAR_FROM = 0.8
#: Fingerprints of a text's words: with one, two in five of the links at the
#: threshold are candidates, with four most are.
NEAR_SEEDS = 4
#: Texts whose shingles are counted to tell the frequent ones, and how many of
#: those are remembered.
_SAMPLE, _FREQUENT = 8000, 100_000
#: 64-bit words of a set's parities.
_WORDS = 8
_EMPTY = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: list[str | None], words: int = NEAR_WORDS) -> list:
    """The distinct word shingles of each text, as sorted hashes; a shorter text
    is one shingle, and so is one without words."""
    from lapwing.llm.lm_scoring import token_hashes

    return _shingled(*token_hashes(texts), words)


def _shingled(codes, size, words: int = NEAR_WORDS) -> list:
    turned = [mixed(codes + np.uint64((i + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) for i in range(words)]
    chain = np.zeros(len(codes), np.uint64)
    for i in range(words):
        chain[: max(0, len(codes) - i)] = mixed(chain[: max(0, len(codes) - i)] * np.uint64(3) + turned[i][i:])
    out = []
    for n, end in zip((size - 1).tolist(), (np.cumsum(size) - 1).tolist()):
        if n >= words:
            out.append(np.unique(chain[end - n : end - words + 1]))
            continue
        one = np.full(1, _EMPTY)
        for i in range(n):
            one = mixed(one * np.uint64(3) + turned[i][end - n + i : end - n + i + 1])
        out.append(one)
    return out


def word_prints(codes, size):
    """``NEAR_SEEDS`` independent fingerprints of the distinct words of each text.

    Words change less than shingles when a text is edited: where one word in fifty
    is another, a fingerprint of five-word shingles moves by ten bits, one of
    distinct words by four."""
    prints = np.zeros((len(size), NEAR_SEEDS), np.uint64)
    for k, end in enumerate(np.cumsum(size).tolist()):
        words = np.unique(codes[end - size[k] : end - 1])  # without the end
        for s in range(NEAR_SEEDS):
            h = mixed(words + np.uint64(s * 0x9E3779B97F4A7C15 % (1 << 64)))
            ones = np.zeros(64, np.int64)
            for at in range(0, len(h), 4096):
                ones += np.unpackbits(h[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
            prints[k, s] = np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0]
    return prints.view(np.int64)


def _least_common(size, threshold: float):
    """Shingles that a set of this size shares with any set that similar."""
    return np.ceil(threshold * size - 1e-9).astype(np.int64)


def _frequent_shingles(texts: DataFrame):
    """Sorted hashes of frequent shingles and their counts in a sample of texts.
    They only order the shingles: any order finds the same pairs."""
    every = max(1, texts.count() // _SAMPLE)

    def run(batches):
        import pyarrow as pa

        from lapwing.llm.byte_bpe import _rows, _text_cost

        def counted():
            h, c = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c.astype(np.int64))], ["h", "c"])

        held, have = [], 0
        for piece in _rows(batches, "text", _text_cost):
            sets = shingle_sets(piece.column(1).to_pylist())
            held, have = held + sets, have + sum(map(len, sets))
            if have >= 1 << 20:
                yield counted()
                held, have = [], 0
        if held:
            yield counted()

    some = texts.where(F.pmod(F.xxhash64("node"), F.lit(every)) == 0).mapInArrow(run, "h long, c long")
    top = some.groupBy("h").agg(F.sum("c").alias("c")).where("c >= 3").orderBy(F.desc("c"), "h").limit(_FREQUENT).collect()
    h = np.array([r["h"] for r in top], np.int64).view(np.uint64)
    order = np.argsort(h)
    return h[order], np.array([r["c"] for r in top], np.int64)[order]


def parities(sets: list):
    """For each set of hashes ``_WORDS`` words of 64 bits: whether the hashes that
    fall on a bit are odd in number.  Two sets' bits differ in at most as many
    places as there are hashes that only one of the sets has."""
    size = np.array([len(x) for x in sets], np.int64)
    width = 64 * _WORDS
    place = np.repeat(np.arange(len(sets)), size) * width + (np.concatenate(sets) >> np.uint64(7)).astype(np.int64) % width
    odd = (np.bincount(place, minlength=len(sets) * width) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(len(sets), width), axis=1, bitorder="little").view("<i8")


def _most_unlike(threshold: float) -> float:
    """The share of two sizes' sum that so similar sets can differ in, at most."""
    return (1 - threshold) / (1 + threshold)


def _prefixes(texts: DataFrame, threshold: float) -> DataFrame:
    """``node, doc_id, n, prefix, bits, prints``: how many shingles a text has, its
    rarest ones, so many that two texts of that similarity have one in common, the
    parities of all, and the fingerprints of its words."""
    frequent, count = _frequent_shingles(texts)

    def run(batches):
        import pyarrow as pa

        from lapwing.llm.byte_bpe import _rows, _text_cost
        from lapwing.llm.lm_scoring import token_hashes

        for piece in _rows(batches, "text", _text_cost):
            codes, tokens = token_hashes(piece.column(1).to_pylist())
            sets, prints = _shingled(codes, tokens), word_prints(codes, tokens)
            size = np.array([len(x) for x in sets], np.int64)
            length = size - _least_common(size, threshold) + 1
            every = np.concatenate(sets)
            rank = np.zeros(len(every), np.int64)
            if len(frequent):
                at = np.minimum(np.searchsorted(frequent, every), len(frequent) - 1)
                rank = np.where(frequent[at] == every, count[at], 0)
            text = np.repeat(np.arange(len(size)), size)
            order = np.lexsort((every, rank, text))
            place = np.arange(len(every)) - np.repeat(np.cumsum(size) - size, size)
            first = every[order[place < np.repeat(length, size)]]
            cuts = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
            prefix = pa.ListArray.from_arrays(pa.array(cuts), pa.array(first.view(np.int64)))
            bits = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * _WORDS), pa.array(parities(sets).reshape(-1)))
            prints = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * NEAR_SEEDS), pa.array(prints.reshape(-1)))
            yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(2), pa.array(size), prefix, bits, prints], ["node", "doc_id", "n", "prefix", "bits", "prints"])

    return texts.mapInArrow(run, f"node long, doc_id {texts.schema['doc_id'].dataType.simpleString()}, n long, prefix array<long>, bits array<long>, prints array<long>")


def sketch(shingles) -> bytes:
    """How many hashes a set has, and their parities on two to four times as many
    places, a power of two.  Folding the halves of the parities on each other gives
    those on half the places, so sets of any two sizes can be compared."""
    width = max(64 * _WORDS, 1 << (2 * len(shingles) - 1).bit_length())
    odd = np.bincount((shingles >> np.uint64(7)).astype(np.int64) % width, minlength=width) & 1
    return np.int64(len(shingles)).tobytes() + np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _folded(words, size: int):
    while len(words) > size:
        words = words[: len(words) // 2] ^ words[len(words) // 2 :]
    return words


def _sketches_allow(threshold: float):
    """For one sketch and others, whether the sets can be that similar, and how many
    hashes both have."""

    def allow(one, others):
        out, n = np.zeros(len(others), bool), int(one[0])
        for k, other in enumerate(others):
            size = min(len(one), len(other)) - 1
            unlike = np.bitwise_count(_folded(one[1:], size) ^ _folded(other[1:], size)).sum()
            out[k] = unlike <= (n + int(other[0])) * _most_unlike(threshold) + 1e-6
        return out

    return allow


def _sets_similar(threshold: float):
    """For one set and others, whether they are that similar."""

    def similar(one, others):
        size = np.array([len(x) for x in others])
        every = np.concatenate(others)
        hit = one[np.minimum(np.searchsorted(one, every), len(one) - 1)] == every
        common = np.add.reduceat(hit.astype(np.int64), np.cumsum(size) - size)
        return common >= threshold * (size + len(one) - common) - 1e-9

    return similar


def _of_pairs(pairs: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes of the pairs, and ``node, text`` of the texts that have them (and a
    few more), without a shuffle of texts."""
    nodes = materialize(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("_slot", slot(F.col("node"))), "pair-nodes")
    _, some = parted(texts.select("node", "text").withColumn("_slot", slot(F.col("node"))), nodes)
    return nodes.select("node"), some.select("node", "text")


def _kept(pairs: DataFrame, values: DataFrame, load: Callable, test: Callable, most: int, label: str) -> DataFrame:
    """The pairs ``a, b, n`` that pass the test on what ``load`` makes of their ends'
    ``value``.  Pairs are dealt by the least partner of their greater end: most pairs
    of a group are one part, so its values move once; a group whose pairs' ``n`` are
    more than ``most`` in all is several parts."""
    dealt = pairs.withColumn("least", F.min("a").over(Window.partitionBy("b")))
    heavy = F.floor(F.sum("n").over(Window.partitionBy("least")) / F.lit(most)) + 1
    dealt = materialize(dealt.select("a", "b", "n", F.xxhash64("least", F.pmod(F.xxhash64("b"), heavy)).alias("part")), "dealt")
    need = dealt.select("part", F.explode(F.array("a", "b")).alias("node")).distinct()
    # One value a node, pre-aggregated: copies share their node.
    need = need.join(values.groupBy("node").agg(F.first("value").alias("value")), "node")
    need = need.select("part", F.lit(0).alias("kind"), F.col("node").alias("a"), F.lit(0).cast("long").alias("b"), F.lit(0).cast("long").alias("n"), "value")
    both = need.unionByName(dealt.select("part", F.lit(1).alias("kind"), "a", "b", "n", F.lit(None).cast(values.schema["value"].dataType).alias("value")))

    def run(batches):
        import pyarrow as pa

        now, held = None, {}
        for batch in batches:
            part, kind, a, b, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            if not len(part):
                continue
            change = np.flatnonzero((part[1:] != part[:-1]) | (kind[1:] != kind[:-1]) | (b[1:] != b[:-1])) + 1
            found = []
            for lo, hi in zip([0, *change.tolist()], [*change.tolist(), len(part)]):
                if part[lo] != now:
                    now, held = part[lo], {}
                if kind[lo] == 0:
                    for k in range(lo, hi):  # one by one: the codes of a text take several times its size
                        held[int(a[k])] = load(batch.column(5)[k].as_py())
                    continue
                found.append(lo + np.flatnonzero(test(held[int(b[lo])], [held[x] for x in a[lo:hi].tolist()])))
            if found:
                k = np.concatenate(found)
                yield pa.RecordBatch.from_arrays([pa.array(x[k]) for x in (a, b, n)], ["a", "b", "n"])
        give_back()

    rows = both.repartition("part").sortWithinPartitions("part", "kind", "b")
    return materialize(rows.mapInArrow(run, "a long, b long, n long"), label)


#: Shingles of the pairs in a part, in all, while sketches and while sets are compared.
_SKETCHED, _SETS = 1 << 24, 1 << 21


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``a, b, n`` (``n``: the shingles of both) whose sets of shingles are
    that similar.  Only sketches of the texts in pairs move, and the texts whose
    sketches leave a doubt: these are hardly ever unlike."""
    pairs = materialize(pairs, "pairs")
    nodes, some = _of_pairs(pairs, texts)

    def run(batches):
        import pyarrow as pa

        from lapwing.llm.byte_bpe import _rows, _text_cost

        for piece in _rows(batches, "text", _text_cost):
            sketches = [sketch(x) for x in shingle_sets(piece.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(sketches, pa.binary())], ["node", "value"])

    sketches = some.mapInArrow(run, "node long, value binary").join(nodes, "node", "left_semi")
    close = _kept(pairs, sketches, lambda x: np.frombuffer(x, np.uint64), _sketches_allow(threshold), _SKETCHED, "close")
    nodes, some = _of_pairs(close, texts)
    some = some.join(nodes, "node", "left_semi").withColumnRenamed("text", "value")
    return _kept(close, some, lambda x: shingle_sets([x])[0], _sets_similar(threshold), _SETS, "similar")


def _pairs_across(threshold: float):
    """Rows ``h, node, n, root, pos, bits``, sorted by ``h, n``, to the pairs of one
    ``h`` that have different roots and whose sizes, parities, and shingles from ``h``
    on, allow the similarity if ``h`` is the first that they share."""

    def pairs(node, n, root, pos, bits):
        import pyarrow as pa

        out, have = [], 0
        stop = np.searchsorted(n, np.floor(n / threshold + 1e-6), "right")
        for i in range(len(node) - 1):
            rest = i + 1 + np.flatnonzero(root[i + 1 : stop[i]] != root[i])
            both = n[i] + n[rest]
            rest = rest[np.minimum(n[i] - pos[i], n[rest] - pos[rest]) >= both * (threshold / (1 + threshold)) - 1e-6]
            unlike = np.bitwise_count((bits[i] ^ bits[rest]).view(np.uint64)).sum(axis=1)  # of signed ones it counts the magnitude
            most = (n[i] + n[rest]) * _most_unlike(threshold) + 1e-6
            other = node[rest[unlike <= most]]
            out.append((np.minimum(node[i], other), np.maximum(node[i], other), n[i] + n[rest[unlike <= most]]))
            have += len(other)
            if have and (have >= 100_000 or i == len(node) - 2):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[k] for x in out])) for k in (0, 1, 2)], ["a", "b", "n"])
                out, have = [], 0

    def run(batches):
        held = None
        for batch in batches:
            rows = np.concatenate(
                [np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]), batch.column(5).flatten().to_numpy(zero_copy_only=False).reshape(-1, _WORDS).T]
            )
            held = rows if held is None else np.concatenate([held, rows], axis=1)
            cuts = np.flatnonzero(held[0, 1:] != held[0, :-1]) + 1
            for lo, hi in zip([0, *cuts[:-1].tolist()], cuts.tolist()):
                yield from pairs(*held[1:5, lo:hi], np.ascontiguousarray(held[5:, lo:hi].T))
            if len(cuts):
                held = held[:, cuts[-1] :]
        if held is not None:
            yield from pairs(*held[1:5], np.ascontiguousarray(held[5:].T))
        give_back()

    return run


def print_pairs(texts: DataFrame) -> DataFrame:
    """Candidates ``a, b, n``: of ``node, n, prints``, pairs that connect all texts
    that one of the fingerprints connects by steps of at most 3 bits, found by the
    chains of :func:`links`."""
    each = texts.select("node", "n", F.posexplode("prints").alias("seed", "fp"))
    named = materialize(each.groupBy("seed", "fp").agg(F.min(F.struct("node", "n")).alias("one")), "prints")
    found = links(named.select("seed", "fp"))
    for end in ("a", "b"):
        found = found.join(named.select("seed", F.col("fp").alias(end), F.col("one").alias(f"one_{end}")), ["seed", end])
    same = each.join(named, ["seed", "fp"]).select(F.col("one").alias("one_a"), F.struct("node", "n").alias("one_b"))
    pairs = found.select("one_a", "one_b").unionByName(same).where("one_a.node != one_b.node")
    return pairs.select(F.least("one_a.node", "one_b.node").alias("a"), F.greatest("one_a.node", "one_b.node").alias("b"), (F.col("one_a.n") + F.col("one_b.n")).alias("n")).distinct()


def near_links(texts: DataFrame, prefixes: DataFrame, threshold: float) -> DataFrame:
    """Links ``a, b`` between the ``node`` of texts of at least that similarity,
    which connect all that such links connect.

    Candidates are first those of the fingerprints; the links among them join most
    copies.  What fingerprints miss follows, among texts that are not connected yet:
    similar texts meet at a shingle of both their prefixes.  There each is first
    compared with one of them, another one at each shingle; that joins large groups
    of copies.  Then every pair that no link found so far connects is compared.
    Before whole sets are, sizes, places and parities tell what cannot be similar;
    what they leave are mostly links, so it does not grow with the square of those
    that share a passage."""
    bucket = Window.partitionBy("h")
    unlike = F.aggregate(F.zip_with("a_bits", "b_bits", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    known = materialize(prefixes.select("node", "n", "bits", "prints").dropDuplicates(["node"]), "known")

    def rooted(rows, groups, node="node", root="root"):
        named = groups.select(F.col("node").alias(node), F.col("root").alias(root))
        return rows.join(named, node, "left").withColumn(root, F.coalesce(root, node))

    tried = materialize(print_pairs(known), "print-pairs")
    links = _verified(tried, texts, threshold)
    groups = materialize(components(links), "print-groups")
    shared = prefixes.select(F.posexplode("prefix").alias("pos", "h"), "node", "n")
    lead = F.min(F.struct(F.xxhash64("node", "h").alias("x"), "node", "n", "pos")).over(bucket)
    shared = shared.withColumns({"first": lead, "low": F.min("node").over(bucket), "high": F.max("node").over(bucket)}).where("low != high")
    shared = materialize(shared.select("h", "pos", "node", "n", F.struct("first.node", "first.n", "first.pos").alias("first")), "shared")
    most = F.least(F.col("n") - F.col("pos"), F.col("first.n") - F.col("first.pos"))
    fits = most >= (F.col("n") + F.col("first.n")) * F.lit(threshold / (1 + threshold)) - F.lit(1e-6)
    ends = F.least("node", "first.node").alias("a"), F.greatest("node", "first.node").alias("b")
    star = shared.where((F.col("node") != F.col("first.node")) & fits).select(*ends).distinct()
    for end in ("a", "b"):
        star = rooted(star, groups, end, f"{end}_root")
    star = star.where("a_root != b_root").select("a", "b").join(tried, ["a", "b"], "left_anti")
    for end in ("a", "b"):
        star = star.join(known.select(F.col("node").alias(end), F.col("n").alias(f"{end}_n"), F.col("bits").alias(f"{end}_bits")), end)
    both = F.col("a_n") + F.col("b_n")
    star = materialize(star.where(unlike <= both * _most_unlike(threshold) + 1e-6).select("a", "b", both.alias("n")), "star")
    tried, links = tried.unionByName(star), links.unionByName(_verified(star, texts, threshold))
    groups = materialize(components(links), "star-groups")
    rest = rooted(shared.drop("first"), groups)
    rest = rest.withColumns({"low": F.min("root").over(bucket), "high": F.max("root").over(bucket)}).where("low != high")
    rest = rest.select("h", "node", "n", "root", F.col("pos").cast("long").alias("pos")).join(known.select("node", "bits"), "node")
    rest = rest.select("h", "node", "n", "root", "pos", "bits").repartition("h").sortWithinPartitions("h", "n")
    across = rest.mapInArrow(_pairs_across(threshold), "a long, b long, n long").distinct().join(tried, ["a", "b"], "left_anti")
    return links.unionByName(_verified(across, texts, threshold))


def near_deduplicate(docs: DataFrame, threshold: float = NEAR_FROM, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay: of each group of near duplicates the one
    with the smallest id (nulls last), with all its columns.

    Two texts link if the Jaccard similarity of their sets of five-word shingles
    is at least ``threshold``; a group is what links connect.  No such pair is
    missed and no other is linked, but for collisions of 64-bit hashes."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = small_batches(docs).select(F.xxhash64(text, F.lit(7)).alias("node"), text.alias("text"), F.col(id_col).alias("doc_id"))
    prefixes = materialize(_prefixes(texts, threshold), "prefixes")
    groups = materialize(components(near_links(texts, prefixes, threshold)), "groups")
    member = materialize(prefixes.select("node", "doc_id").join(groups, "node", "left").withColumn("root", F.coalesce("root", "node")), "members")
    first = member.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "node")).alias("first"), F.count(F.lit(1)).alias("size"))
    marked = member.join(materialize(first.where("size > 1"), "first"), "root")
    # A row that agrees with its group's first one in id and text stays with it.
    gone = marked.where(~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("node") == F.col("first.node"))))
    gone = materialize(gone.select(F.col("doc_id").alias("_gone_id"), F.col("node").alias("_gone_hash")).distinct().withColumn("_slot", slot(F.col("_gone_hash"))), "gone")
    hashed = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")), F.lit(7))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("_id"), hashed.alias("_hash")).withColumn("_slot", slot(F.col("_hash")))
    sure, unsure = parted(rows, gone)
    on = F.col("_id").eqNullSafe(F.col("_gone_id")) & (F.col("_hash") == F.col("_gone_hash"))
    return sure.select("row.*").union(unsure.join(gone.drop("_slot"), on, "left_anti").select("row.*"))


def op10_simhash(spark, sf_dir: str) -> DataFrame:
    found = classes(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
