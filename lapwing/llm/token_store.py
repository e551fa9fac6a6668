"""Token ids on disk, compressed by Re-Pair grammars.

A shard holds consecutive documents in ascending id order.  Within it frequent
adjacent pairs of symbols are replaced by a new nonterminal, again and again, the
most frequent first, until no pair is frequent.  A rule is a pair of earlier
symbols; stored are the rules, the length of each rule's expansion, the remaining
symbols and where each document begins.  No pair spans two documents, so each can
be decoded alone, and the expansion lengths find any range of ids inside it
without expanding what stands before.

Pairs inside words are replaced first, on the shard's distinct words weighted by
how often they occur (the same replacements as on the whole sequence, at a
fraction of the work); pairs across words follow on the sequence itself.  Several
pairs are replaced in one pass: where two meet, the more frequent one wins.  Both go
down to ``MIN_COUNT`` and end only when no pair occurs that often; a pair has one
rule, whenever it is replaced.

The file format is one binary payload a shard, in Parquet files that Spark writes
to and reads from shared storage, so that a lost executor costs a retry only.

Defined results: null is empty text, which is the end id alone; rows with equal
ids are ordered by their texts; null ids come first, and ids keep their type; an
empty table writes no shard and reads back no document; only ``doc_id`` and ``text``
are looked at, whatever other columns are called.  A tokenizer that normalises or
cuts texts by other rules than the default one is refused.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from lapwing.llm._common import give_back, materialize, read_table, small_batches, tokenizer_path
from lapwing.llm._words import NOT_WHITE, codes, equal, same
from lapwing.llm.byte_bpe import _rows, _text_cost

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
#: A shard is closed when it holds this many ids.
SHARD_IDS = 4_000_000
#: Pairs rarer than this are not worth a rule.
MIN_COUNT = 12
_MAGIC = b"RPG1"
#: Kinds of bytes: white space, letters (ASCII, and whatever is not), digits, others.
_KIND = np.full(256, 3, np.uint8)
_KIND[~NOT_WHITE] = 0
_KIND[0x30:0x3A] = 2
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
#: What makes a word one that only the library cuts: apostrophes (contractions),
#: control characters, added tokens' spelling, and characters outside ASCII that
#: are not sure to be letters which neither lower-casing nor composition cuts:
#: all but U+00C0..U+027F, without the two signs and the dotted capital I in it.
_ODD = re.compile(rb"['\x00-\x1f\x7f\xc2\xca-\xff]|<\||\xc3[\x97\xb7]|\xc4\xb0").search
_ODD_BYTE = np.zeros(256, bool)
_ODD_BYTE[[0x27, 0x7F, 0xC2, *(set(range(0x20)) - {9, 10, 11, 12, 13}), *range(0xCA, 0x100)]] = True
_ODD_PAIRS = ((0x3C, 0x7C), (0xC3, 0x97), (0xC3, 0xB7), (0xC4, 0xB0))
#: The pre-tokens of the tokenizers that can be used.
_PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LINE = 500
_TABLE_LIMIT = 400_000


# --- grammar ---------------------------------------------------------------


class _Rules:
    """The rules so far; a pair has one symbol, whenever it is replaced."""

    def __init__(self, first: int):
        self.first = first
        self._symbol: dict[int, int] = {}

    def symbols_of(self, pairs):
        """Symbols of pairs (as 64-bit codes), with new rules where there is none."""
        symbol = self._symbol
        return np.array([symbol.setdefault(p, self.first + len(symbol)) for p in pairs.tolist()], np.int64)

    def table(self):
        codes = np.fromiter(self._symbol, np.uint64, len(self._symbol))
        return np.stack([(codes >> np.uint64(32)).astype(np.int64), (codes & np.uint64(0xFFFFFFFF)).astype(np.int64)], axis=1)


class _Sequence:
    """A sequence of symbols under replacement, linked: a replaced pair keeps its
    first place, and its second is passed over until :meth:`compact`.

    ``stop`` marks symbols that end a word or document; no pair goes beyond one.
    ``weight``: how often each place occurs, or None for once."""

    def __init__(self, symbols, stop, weight):
        self.symbols, self.stop, self.weight = symbols, stop, weight
        self._link()

    def _link(self):
        n = len(self.symbols)
        self._after, self._before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        self._rank, self._live = np.zeros(n + 2, np.int32), np.ones(n, bool)

    def compact(self):
        if not self._live.all():
            self.symbols, self.stop = self.symbols[self._live], self.stop[self._live]
            self.weight = None if self.weight is None else self.weight[self._live]
            self._link()

    def _rough(self, threshold):
        """Places of pairs that can be frequent, by hashed counts: upper bounds."""
        self.compact()
        if len(self.symbols) < 2:
            return np.empty(0, np.int64)
        code = (self.symbols[:-1].astype(np.uint64) << np.uint64(32)) | self.symbols[1:].astype(np.uint64)
        bucket = ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(43)).astype(np.int64)
        bucket[self.stop[:-1]] = 1 << 21
        rough = np.bincount(bucket, weights=None if self.weight is None else self.weight[:-1], minlength=(1 << 21) + 1)
        rough[1 << 21] = 0
        return np.flatnonzero((rough >= threshold)[bucket])

    def _counted(self, at, threshold):
        """The frequent pairs at places ``at``: pairs, counts, and the places and
        pairs' numbers of all their occurrences there."""
        code = (self.symbols[at].astype(np.uint64) << np.uint64(32)) | self.symbols[self._after[at]].astype(np.uint64)
        pairs, inverse = np.unique(code, return_inverse=True)
        counts = np.bincount(inverse, weights=None if self.weight is None else self.weight[at])
        good = counts >= threshold
        here = good[inverse]
        return pairs[good], counts[good], at[here], (np.cumsum(good) - 1)[inverse[here]]

    def shorten(self, threshold: int, rules: _Rules, last: bool) -> None:
        """Replace pairs of at least ``threshold`` occurrences.

        After a pass only places beside a replacement, and those that lost to a
        neighbour, are counted again.  At the ``last`` level all places are when
        these hold no frequent pair, and it ends only when none is left."""
        while True:
            at, done = self._rough(threshold), True
            while len(at):
                pairs, counts, at, inverse = self._counted(at, threshold)
                if not len(at):
                    break
                at, done = self._replaced(pairs, counts, at, inverse, rules), not last
            if done:
                self.compact()
                return

    def _replaced(self, pairs, counts, at, inverse, rules: _Rules):
        """One pass over the frequent pairs; the places to count next."""
        rank, after, before = self._rank, self._after, self._before
        # Distinct priorities, by count and then by pair; 0 stands for no pair.
        order = np.argsort(np.argsort(counts, kind="stable"), kind="stable") + 1
        mine = order[inverse]
        rank[at] = mine
        # A place wins over its neighbours; in a run of one pair every other one does.
        left = rank[before[at]]  # the last entry, before the first place, stays 0
        same = mine == left
        run = np.arange(len(at)) - np.maximum.accumulate(np.where(same, 0, np.arange(len(at))))
        wins = (mine >= np.where(same, 0, left)) & (mine >= rank[after[at]]) & (run % 2 == 0)
        rank[at] = 0
        won, name = at[wins], inverse[wins]
        # Runs can leave a winner right after another: the earlier one stays.
        if len(won) > 1:
            clear = np.concatenate([[True], won[1:] != after[won[:-1]]])
            won, name = won[clear], name[clear]
        used, name = np.unique(name, return_inverse=True)
        self.symbols[won] = rules.symbols_of(pairs[used])[name]
        gone = after[won]
        self.stop[won] |= self.stop[gone]
        self._live[gone] = False
        after[won] = after[gone]
        later = after[won] < len(before)
        before[after[won[later]]] = won[later]
        first = before[won]
        next_ = np.sort(np.concatenate([at, first[first >= 0]]), kind="stable")
        next_ = next_[np.concatenate([[True], next_[1:] != next_[:-1]])]
        return next_[self._live[next_] & ~self.stop[next_] & (after[next_] < len(before))]


def _thresholds(total: int, minimum: int) -> list[int]:
    """From a thousandth of all places down, each an eighth of the last."""
    out, t = [], max(minimum, total // 1000)
    while t > minimum:
        out.append(t)
        t //= 8
    return [*out, minimum]


def compress(words, flat, offsets, doc_words, first_new: int, minimum: int = MIN_COUNT):
    """Grammar of a shard.

    ``words``: the shard's words as rows of a table; row ``r`` stands for the ids
    ``flat[offsets[r]:offsets[r + 1]]``.  ``doc_words``: words in each document.
    Every document's last word must be the end marker's row, so that documents
    are never empty.  Returns ``(symbols, document offsets, rules)``.
    """
    counts = np.bincount(words, minlength=len(offsets) - 1)
    used = np.flatnonzero(counts)
    local = np.zeros(len(counts), np.int64)
    local[used] = np.arange(len(used))
    lens = (offsets[1:] - offsets[:-1])[used]
    ends = np.cumsum(lens)
    seq = flat[np.repeat(offsets[:-1][used] - (ends - lens), lens) + np.arange(ends[-1] if len(ends) else 0)].astype(np.int64)
    stop = np.zeros(len(seq), bool)
    stop[ends[lens > 0] - 1] = True
    rules, inner = _Rules(first_new), _Sequence(seq, stop, np.repeat(counts[used], lens).astype(np.float64))
    for threshold in _thresholds(len(words), minimum):
        inner.shorten(threshold, rules, threshold == minimum)
    seq, stop = inner.symbols, inner.stop
    # Words of no ids (they are possible) keep their place in the table.
    size = np.zeros(len(used), np.int64)
    size[lens > 0] = np.diff(np.concatenate([[0], np.flatnonzero(stop) + 1]))
    begin = np.cumsum(size) - size
    row = local[words]
    n = size[row]
    ends = np.cumsum(n)
    symbols = seq[np.repeat(begin[row] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]
    doc_ends = ends[np.cumsum(doc_words) - 1]
    stop = np.zeros(len(symbols), bool)
    stop[doc_ends - 1] = True
    outer = _Sequence(symbols, stop, None)
    for threshold in _thresholds(len(symbols), minimum):
        outer.shorten(threshold, rules, threshold == minimum)
    return outer.symbols, np.concatenate([[0], np.flatnonzero(outer.stop) + 1]), rules.table()


def _lengths(rules, base: int):
    """Expansion length of every rule; a rule refers to earlier symbols only."""
    out = np.zeros(len(rules), np.int64)
    done, todo = np.zeros(len(rules), bool), np.arange(len(rules))

    def of(symbols):
        terminal = symbols < base
        k = np.where(terminal, 0, symbols - base)
        return np.where(terminal, 1, out[k] if len(out) else 1), terminal | (done[k] if len(done) else True)

    while len(todo):
        (a, ok_a), (b, ok_b) = of(rules[todo, 0]), of(rules[todo, 1])
        now = ok_a & ok_b
        out[todo[now]] = (a + b)[now]
        done[todo[now]] = True
        todo = todo[~now]
    return out


def _packed(symbols) -> bytes:
    """Three byte planes, or four where a symbol needs them."""
    wide = 4 if len(symbols) and int(symbols.max()) >= 1 << 24 else 3
    planes = symbols.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :wide]
    return bytes([wide]) + np.ascontiguousarray(planes.T).tobytes()


def _unpacked(data, at: int, n: int):
    wide = data[at]
    planes = np.frombuffer(data, np.uint8, wide * n, at + 1).reshape(wide, n)
    out = np.zeros((n, 4), np.uint8)
    out[:, :wide] = planes.T
    return out.reshape(-1).view("<u4").astype(np.int64), at + 1 + wide * n


def pack(symbols, at, rules, base: int) -> bytes:
    """The payload of a shard."""
    lengths = _lengths(rules, base)
    head = struct.pack("<4sIQQQ", _MAGIC, base, len(rules), len(symbols), len(at) - 1)
    body = [_packed(x) for x in (rules[:, 0], rules[:, 1])]
    return b"".join([head, *body, lengths.astype("<u4").tobytes(), at.astype("<u8").tobytes(), _packed(symbols)])


class Shard:
    """A payload, opened for decoding."""

    def __init__(self, data: bytes):
        magic, self.base, n_rules, n_symbols, self.n_docs = struct.unpack_from("<4sIQQQ", data)
        if magic != _MAGIC:
            raise ValueError("not a shard of token ids")
        left, at = _unpacked(data, struct.calcsize("<4sIQQQ"), n_rules)
        right, at = _unpacked(data, at, n_rules)
        self._lens = np.frombuffer(data, "<u4", n_rules, at).astype(np.int64)
        at += 4 * n_rules
        self._at = np.frombuffer(data, "<u8", self.n_docs + 1, at).astype(np.int64)
        self._symbols, _ = _unpacked(data, at + 8 * (self.n_docs + 1), n_symbols)
        # Expansions of all rules, end to end, after the terminals.
        flat = np.arange(self.base, self.base + n_rules)
        while len(deep := np.flatnonzero(flat >= self.base)):
            k = flat[deep] - self.base
            n = np.ones(len(flat), np.int64)
            n[deep] = 2
            flat = np.repeat(flat, n)
            first = deep + np.arange(len(deep))
            flat[first], flat[first + 1] = left[k], right[k]
        self._table = np.concatenate([np.arange(self.base), flat])
        self._start = np.concatenate([np.arange(self.base), self.base + np.cumsum(self._lens) - self._lens])
        self._len = np.concatenate([np.ones(self.base, np.int64), self._lens])

    def _expand(self, symbols):
        n = self._len[symbols]
        ends = np.cumsum(n)
        return self._table[np.repeat(self._start[symbols] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]

    def document(self, k: int):
        """Ids of the ``k``-th document of the shard."""
        return self._expand(self._symbols[self._at[k] : self._at[k + 1]])

    def part(self, k: int, start: int, stop: int):
        """Ids ``start:stop`` of a document; only the symbols they touch expand."""
        symbols = self._symbols[self._at[k] : self._at[k + 1]]
        ends = np.cumsum(self._len[symbols])
        lo, hi = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
        skipped = int(ends[lo - 1]) if lo else 0
        return self._expand(symbols[lo:hi])[start - skipped : stop - skipped]

    def documents(self, group: int = 256) -> Iterator:
        for lo in range(0, self.n_docs, group):
            hi = min(lo + group, self.n_docs)
            symbols = self._symbols[self._at[lo] : self._at[hi]]
            ids, ends = self._expand(symbols), self._len[symbols].cumsum()
            cuts = ends[self._at[lo + 1 : hi + 1] - self._at[lo] - 1]
            last = 0
            for c in cuts.tolist():
                yield ids[last:c]
                last = c


# --- encoding --------------------------------------------------------------


def _pieces(data):
    """Where the pieces of space-led UTF-8 bytes begin and end.

    A piece is a run of letters, a digit or a run of other characters: the
    tokenizer's own pre-tokens.  A word with something odd in it stays whole."""
    kind = _KIND[data]
    inside = kind != 0
    starts = np.zeros(len(data), bool)
    starts[1:] = inside[1:] & ((kind[1:] != kind[:-1]) | (kind[1:] == 2))
    odd = _ODD_BYTE[data]
    for a, b in _ODD_PAIRS:
        odd[:-1] |= (data[:-1] == a) & (data[1:] == b)
    odd = np.flatnonzero(odd)
    if len(odd):
        first = np.zeros(len(data), bool)
        first[1:] = inside[1:] & ~inside[:-1]
        word = np.cumsum(first)
        whole = np.zeros(int(word[-1]) + 1, bool)
        whole[word[odd]] = True
        starts &= first | ~whole[word]
    begin = np.flatnonzero(starts)
    return begin, np.flatnonzero(inside[:-1] & (~inside[1:] | starts[1:])) + 1


def _cut_as_here(lib) -> bool:
    """Whether a tokenizer normalises and cuts texts as :func:`_pieces` assumes."""
    spec = json.loads(lib.to_str())
    normal = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
    cut = [t.get("pattern", {}).get("Regex") for t in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
    return normal == ["NFC", "Replace", "Lowercase"] and cut == [_PRE_TOKENS, None] and spec["model"].get("end_of_word_suffix") == "</w>"


class Words:
    """Table of the words seen by a worker and their ids.

    White space separates pre-tokens and leaves no trace in the ids, so a text's
    ids are its pieces' ids, one after the other.  Pieces are known by their bytes
    (codes only group those of a batch, and the groups are compared byte by byte);
    row 0 is the end marker."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._lib = Tokenizer.from_file(path)
        self._lib.no_truncation()
        self._lib.no_padding()
        if not _cut_as_here(self._lib):
            raise ValueError("the pieces of a text are not this tokenizer's pre-tokens")
        vocab = self._lib.get_vocab(with_added_tokens=True)
        self._ends = np.zeros(max(vocab.values()) + 1, bool)
        self._ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.base = max(self._lib.get_vocab_size(with_added_tokens=True), END_ID + 1)
        self._ids = [struct.pack("<i", END_ID)]
        self._seen = np.zeros(0)
        #: Codes in order, the pieces' places in the store, and their rows; pieces
        #: whose code another piece has come first in ``_odd``.
        self._code, self._at, self._row = np.empty(0, np.uint64), np.empty((0, 2), np.int64), np.empty(0, np.int64)
        self._store, self._odd = np.zeros(8, np.uint8), {}

    def rows(self, texts: list[str | None]) -> list:
        """Rows of the table for the pieces of each text, the end marker last."""
        raw = [(t or "").encode() for t in texts]
        # One space before each text, so that none of its words runs on.
        text = b" " + b" ".join(raw) + b" "
        data = np.frombuffer(text, np.uint8)
        if b"<|" not in text:  # an added token's spelling keeps its case
            data = np.where((data >= 0x41) & (data <= 0x5A), data | 0x20, data)
        begin, end = _pieces(data)
        code = codes(data, begin, end)
        hashes, first, index = np.unique(code, return_index=True, return_inverse=True)
        if equal(data, begin, end, first[index]):
            known = self._rows_of(hashes, data, begin[first], end[first])
        else:  # two pieces of one code
            plain = data.tobytes()
            every = np.array([plain[i:j] for i, j in zip(begin.tolist(), end.tolist())], object)
            pieces, index = np.unique(every, return_inverse=True)
            known = self._rows_apart(pieces.tolist())
        rows = known[index]
        edges = np.cumsum([len(x) + 1 for x in raw])
        cuts = np.searchsorted(begin, edges).tolist()
        return [np.append(rows[i:j], 0) for i, j in zip([0, *cuts], cuts)]

    def _rows_of(self, hashes, data, begin, end):
        """Rows of pieces of different codes, which are in order."""
        at = np.searchsorted(self._code, hashes)
        found = np.flatnonzero(at < len(self._code))
        found = found[self._code[at[found]] == hashes[found]]
        place = self._at[at[found]]
        both = np.concatenate([data, self._store])
        starts, stops = np.concatenate([begin[found], place[:, 0] + len(data)]), np.concatenate([end[found], place[:, 1] + len(data)])
        n = np.arange(len(found))
        right = same(both, starts, stops, n, n + len(found))
        out = np.empty(len(hashes), np.int64)
        out[found[right]] = self._row[at[found[right]]]
        fresh = np.ones(len(hashes), bool)
        fresh[found] = False
        plain = data.tobytes()
        for k in found[~right].tolist():  # another piece's code
            out[k] = self._rows_apart([plain[begin[k] : end[k]]])[0]
        new = np.flatnonzero(fresh)
        raw = [plain[i:j] for i, j in zip(begin[new].tolist(), end[new].tolist())]
        out[new] = self._added([p.decode() for p in raw])
        stop = len(self._store) - 8 + np.cumsum(end[new] - begin[new])
        self._store = np.concatenate([self._store[:-8], np.frombuffer(b"".join(raw), np.uint8), np.zeros(8, np.uint8)])
        self._code = np.insert(self._code, at[new], hashes[new])
        self._at = np.insert(self._at, at[new], np.stack([stop - (end[new] - begin[new]), stop], axis=1), axis=0)
        self._row = np.insert(self._row, at[new], out[new])
        return out

    def _rows_apart(self, pieces: list[bytes]):
        """Rows of pieces that codes do not tell apart."""
        new = [p for p in pieces if p not in self._odd]
        self._odd.update(zip(new, self._added([p.decode() for p in new])))
        return np.array([self._odd[p] for p in pieces], np.int64)

    def _added(self, words: list[str]) -> list[int]:
        """Put new words into the table; their rows."""
        odd = [w for w in words if _ODD(w.encode())]
        coded = chain(self._each(odd), self._together(list(set(words).difference(odd))))
        at = {}
        for w, ids in coded:
            at[w] = len(self._ids)
            self._ids.append(ids)
        return [at[w] for w in words]

    def _each(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        for w, e in zip(words, self._lib.encode_batch_fast(words, add_special_tokens=False)):
            yield w, np.array(e.ids, dtype="<i4").tobytes()

    def _together(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """Ids of words of one pre-token each, encoded as lines of many.

        The last id of every pre-token is one that ends a word, so the ids can be
        told apart.  A line whose numbers disagree is encoded word by word."""
        lines = [words[i : i + _LINE] for i in range(0, len(words), _LINE)]
        coded = self._lib.encode_batch_fast([" ".join(x) for x in lines], add_special_tokens=False)
        for line, e in zip(lines, coded):
            ids = np.array(e.ids, dtype="<i4")
            cuts = np.flatnonzero(self._ends[ids]) + 1
            if len(cuts) != len(line) or cuts[-1] != len(ids):
                yield from self._each(line)
                continue
            raw, at = ids.tobytes(), 0
            for w, end in zip(line, (4 * cuts).tolist()):
                yield w, raw[at:end]
                at = end

    def table(self):
        flat = np.frombuffer(b"".join(self._ids), "<i4")
        return flat, np.concatenate([[0], np.cumsum([len(x) // 4 for x in self._ids])]).astype(np.int64)

    def shrink(self, counts) -> None:
        """After a shard: where there are too many words, the rarest are forgotten.
        What words counted in earlier shards fades, but is not lost at once."""
        seen = np.zeros(len(self._ids))
        seen[: len(self._seen)] = self._seen * 0.7
        seen[: len(counts)] += counts
        self._seen = seen
        if len(self._ids) > _TABLE_LIMIT:
            seen[0] = np.inf
            keep = np.sort(np.argpartition(-seen, _TABLE_LIMIT * 5 // 8)[: _TABLE_LIMIT * 5 // 8])
            place = np.full(len(seen), -1, np.int64)
            place[keep] = np.arange(len(keep))
            stays = np.flatnonzero(place[self._row] >= 0)
            size = np.diff(self._at[stays], axis=1)[:, 0]
            stop = np.cumsum(size)
            self._store = np.append(self._store[np.repeat(self._at[stays, 0] - (stop - size), size) + np.arange(stop[-1] if len(stop) else 0)], np.zeros(8, np.uint8))
            self._code, self._at, self._row = self._code[stays], np.stack([stop - size, stop], axis=1), place[self._row[stays]]
            self._odd = {p: int(place[r]) for p, r in self._odd.items() if place[r] >= 0}
            self._ids = [self._ids[r] for r in keep.tolist()]
            self._seen = seen[keep]
            self._seen[0] = 0


@lru_cache(maxsize=2)
def words_of(path: str) -> Words:
    return Words(path)


def _shard_schema(id_type: str) -> str:
    return f"part int, block int, before long, n_ids long, doc_ids array<{id_type}>, payload binary"


def _shards(tokenizer: str, shard_ids: int, id_type: DataType):
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_type

        table, part, block, before = words_of(tokenizer_path(tokenizer)), TaskContext.get().partitionId(), 0, 0
        docs, rows, held = [], [], 0

        def close():
            flat, offsets = table.table()
            words = np.concatenate(rows)
            payload = pack(*compress(words, flat, offsets, [len(r) for r in rows], table.base), table.base)
            counts = np.bincount(words, minlength=len(offsets) - 1)
            n = int((counts * np.diff(offsets)).sum())
            table.shrink(counts)
            cols = [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([before], pa.int64()), pa.array([n], pa.int64())]
            cols += [pa.array([docs], pa.list_(to_arrow_type(id_type))), pa.array([payload], pa.binary())]
            return n, pa.RecordBatch.from_arrays(cols, ["part", "block", "before", "n_ids", "doc_ids", "payload"])

        for piece in _rows(batches, "text", _text_cost, min(3 << 20, shard_ids)):
            docs += piece.column(0).to_pylist()
            got = table.rows(piece.column(1).to_pylist())
            rows += got
            held += sum(map(len, got))
            if held * 2 >= shard_ids:  # a piece has about two ids
                n, out = close()
                yield out
                block, before, docs, rows, held = block + 1, before + n, [], [], 0
        if docs:
            yield close()[1]

    return run


def write(docs: DataFrame, tokenizer: str = TOKENIZER, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Write the ids of ``docs`` (``doc_id``, ``text``) and return the shards."""
    ordered = small_batches(docs).select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    id_type = docs.schema["doc_id"].dataType
    return materialize(ordered.mapInArrow(_shards(tokenizer, shard_ids, id_type), _shard_schema(id_type.simpleString())), "token-shards")


def read(shards: DataFrame, with_ids: bool = True) -> DataFrame:
    """Documents of written shards: ``doc_id, start, n_tokens, ids_crc32`` and,
    unless only these are wanted, ``ids``."""
    totals = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    offsets = totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))

    id_type = shards.schema["doc_ids"].dataType.elementType

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(id_type), pa.int64(), pa.int64(), pa.int64()]
        for batch in batches:
            for row in range(batch.num_rows):
                part, before = batch.column(0)[row].as_py(), batch.column(2)[row].as_py()
                docs, shard = batch.column(4)[row].as_py(), Shard(batch.column(5)[row].as_py())
                out = ([], [], [], [])
                for doc, ids in zip(docs, shard.documents()):
                    raw = ids.astype("<u4")
                    for column, value in zip(out, (doc, before, len(ids), zlib.crc32(raw))):
                        column.append(value)
                    if with_ids:
                        yield make(part, [[doc], [before], [len(ids)], [zlib.crc32(raw)]], [raw.astype(np.int32)], kinds, pa)
                    before += len(ids)
                if not with_ids:
                    yield make(part, out, None, kinds, pa)
        give_back()

    def make(part, columns, ids, kinds, pa):
        arrays = [pa.array([part] * len(columns[0]), pa.int32()), *[pa.array(c, kind) for c, kind in zip(columns, kinds)]]
        names = ["part", "doc_id", "before", "n_tokens", "ids_crc32"]
        if ids is not None:
            arrays, names = [*arrays, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
        return pa.RecordBatch.from_arrays(arrays, names)

    schema = f"part int, doc_id {id_type.simpleString()}, before long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    # At most one row a partition of the write: a bounded broadcast.
    out = shards.mapInArrow(run, schema).join(F.broadcast(offsets), "part")
    extra = ["ids"] if with_ids else []
    return out.select("doc_id", (F.col("before") + F.col("offset")).cast("long").alias("start"), "n_tokens", "ids_crc32", *extra)


def op9_token_store(spark, sf_dir: str) -> DataFrame:
    return read(write(read_table(spark, sf_dir, "documents").select("doc_id", "text")), with_ids=False)
