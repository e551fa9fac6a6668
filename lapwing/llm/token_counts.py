"""Token counts by the whole-token shortcut.

Offline, before any document is read, the driver encodes every vocabulary string
alone with the tokenizer's own library; those that come back as one token, and that
the pre-tokeniser leaves whole, are proven, and go to the workers as a set no larger
than the vocabulary.  A pre-token equal to a proven string
counts as one, without merging anything.  Only the other pre-tokens go through
the merges, and each distinct one once a batch.

A unit of text with the spelling of an added token in it is counted by the
library, which by default takes that spelling for the token.

Defined results: null is empty text, no bytes and no tokens; texts are counted
whole, without truncation; repeated rows give repeated results; null ids are kept; an
empty table gives an empty result; extra columns are kept unless called, in whatever
case, like the output.
"""

from __future__ import annotations

import os
from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from lapwing.llm._common import read_table, text_or_empty, tokenizer_path
from lapwing.llm._units import UnitTable
from lapwing.llm.byte_bpe import _pattern, append

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024


def _byte_chars() -> dict[str, int]:
    """The published byte-level alphabet: printable bytes stand for themselves,
    the others for the characters from U+0100 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in own}
    for k, b in enumerate(sorted(set(range(256)) - set(own))):
        out[chr(0x100 + k)] = b
    return out


class Counter:
    """Counts with the proven strings ``whole``; proves them where none are given."""

    def __init__(self, path: str, whole: frozenset[str] | None = None):
        import regex
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._lib = Tokenizer.from_file(path)
        self._lib.no_truncation()
        self._lib.no_padding()
        self._find = regex.compile(_pattern()).findall
        self._added = [t.content for t in self._lib.get_added_tokens_decoder().values()]
        self.whole = self.prove() if whole is None else whole
        self._merged: dict[str, int] = {}
        self._table = UnitTable(self._code)

    def _lengths(self, strings: list[str]) -> list[int]:
        return [len(e.ids) for e in self._lib.encode_batch_fast(strings, add_special_tokens=False)]

    def prove(self) -> frozenset[str]:
        """Vocabulary strings that alone are one pre-token and one token."""
        to_byte = _byte_chars()
        strings = []
        for token in self._lib.get_vocab(with_added_tokens=False):
            try:
                s = bytes(to_byte[c] for c in token).decode("utf-8")
            except (KeyError, UnicodeDecodeError):
                continue
            if self._find(s) == [s]:
                strings.append(s)
        return frozenset(s for s, n in zip(strings, self._lengths(strings)) if n == 1)

    def _code(self, strings: list[str]) -> Iterable[int]:
        special = {s: 0 for s in strings if any(a in s for a in self._added)}
        if special:
            special = dict(zip(special, self._lengths(list(special))))
        whole, merged = self.whole, self._merged
        found = [() if s in special else self._find(s) for s in strings]
        rest = list(set().union(*found).difference(whole, merged)) if found else []
        merged.update(zip(rest, self._lengths(rest)))
        out = [special[s] if s in special else sum(1 if t in whole else merged[t] for t in f) for s, f in zip(strings, found)]
        if len(merged) > 200_000:
            merged.clear()
        return out

    def count(self, texts: list[str | None]) -> list[int]:
        return [sum(parts) for parts in self._table(texts)]


@lru_cache(maxsize=2)
def counter(path: str, whole: frozenset[str] | None = None) -> Counter:
    return Counter(path, whole)


def count_tokens(docs: DataFrame, text_col: str = "text", out_col: str = "n_tokens", tokenizer: str = TOKENIZER) -> DataFrame:
    """``docs`` and the number of tokens of each text."""
    whole = counter(tokenizer_path(tokenizer)).whole  # proven once, here, and shipped: at most the vocabulary

    def counts(texts):
        import pyarrow as pa

        return [pa.array(counter(tokenizer_path(tokenizer), whole).count(texts.to_pylist()), pa.int64())]

    return append(docs, text_col, [(out_col, LongType())], counts)


def op7_token_counts(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", text_or_empty(F.col("text")).alias("text"))
    docs = docs.withColumn("n_bytes", F.octet_length("text").cast("long"))
    return count_tokens(docs).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
