"""Byte-level BPE encoding and decoding through a sentencepiece model.

The model is not trained: its protobuf is written out here, directly from a rank
file.  A vocabulary entry becomes a piece whose bytes are mapped to one character
each, scored by its negative rank, so the merge that the ranks would take first
scores highest.  Normalisation is the identity: no dummy prefix, no change of
spaces.  Every match of the pre-tokeniser's pattern is encoded on its own.

A vocabulary entry that the merges cannot reach from its own bytes would still be
one token for a rank-based encoder if a pre-token equals it.  Such entries are
found when the model is built (each entry is encoded alone) and looked up whole.

Decoding maps ids back to pieces and pieces back to bytes.

Defined results: null is empty text, which has no ids and decodes to no bytes;
texts of any length are encoded whole; repeated rows give repeated results; null ids
are kept; an empty table gives an empty result; extra columns are kept unless called,
in whatever case, like an output.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, IntegerType, StructField, StructType

from lapwing.llm._common import batches_of, give_back, other_columns, read_table, small_batches, tokenizer_path
from lapwing.llm._units import UnitTable

RANK_FILE = "byte_bpe_50k.tiktoken"
#: First of the 256 characters that stand for bytes: letters all, none is space.
_BYTE_CHAR = 0x100
#: Units that a worker remembers.
_UNITS = 300_000
_TO_CHARS = {b: chr(_BYTE_CHAR + b) for b in range(256)}


def _pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


# --- protobuf, as far as the model needs it ---------------------------------


def _varint(n: int) -> bytes:
    n %= 1 << 64
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _bytes_field(number: int, value: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def _int_field(number: int, value: int) -> bytes:
    return _varint(number << 3) + _varint(value)


def _float_field(number: int, value: float) -> bytes:
    return _varint(number << 3 | 5) + struct.pack("<f", value)


def mapped(token: bytes) -> str:
    """A token's bytes as one character each."""
    return token.decode("latin-1").translate(_TO_CHARS)


def model_proto(ranks: dict[bytes, int]) -> tuple[bytes, list[int]]:
    """A serialised sentencepiece BPE model, and the rank of each of its pieces
    (piece 0 is the unknown piece, which has none)."""
    unknown, normal, bpe = 2, 1, 2
    pieces = [_bytes_field(1, "<unk>".encode()) + _float_field(2, 0.0) + _int_field(3, unknown)]
    of_piece = [-1]
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        pieces.append(_bytes_field(1, mapped(token).encode()) + _float_field(2, -float(rank)) + _int_field(3, normal))
        of_piece.append(rank)
    trainer = _int_field(3, bpe) + _int_field(4, len(pieces)) + _int_field(40, 0)
    trainer += b"".join(_int_field(k, -1) for k in (41, 42, 43))  # no begin, end or padding piece
    normalizer = _bytes_field(1, b"identity") + b"".join(_int_field(k, 0) for k in (3, 4, 5))
    proto = b"".join(_bytes_field(1, p) for p in pieces) + _bytes_field(2, trainer) + _bytes_field(3, normalizer)
    return proto, of_piece


class ByteBPE:
    """Encoder of one rank file."""

    def __init__(self, path: str, pattern: str | None = None):
        import numpy as np
        import regex
        import sentencepiece

        ranks = read_ranks(path)
        proto, of_piece = model_proto(ranks)
        self._sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self._rank = np.array(of_piece, dtype=np.int32)
        self._find = regex.compile(pattern or _pattern()).findall
        tokens = sorted(ranks, key=ranks.get)
        alone = self._sp.encode([mapped(t) for t in tokens], out_type=int, num_threads=1)
        self.unreached = {t: ranks[t] for t, ids in zip(tokens, alone) if len(ids) != 1}
        self._tokens: dict[str, bytes] = {}
        self._table = UnitTable(self._code, _UNITS)

    def _code(self, strings: list[str]) -> Iterable[bytes]:
        """Ids of strings, as little-endian 32-bit integers."""
        import numpy as np

        found = [self._find(s) for s in strings]
        known = self._tokens
        new = list(set().union(*found).difference(known)) if found else []
        raw = [t.encode("utf-8") for t in new]
        coded = self._sp.encode([mapped(b) for b in raw], out_type=int, num_threads=1)
        rank = self._rank
        for t, b, ids in zip(new, raw, coded):
            whole = self.unreached.get(b)
            known[t] = (rank[ids] if whole is None else np.array([whole], np.int32)).astype("<i4").tobytes()
        out = [b"".join(map(known.__getitem__, f)) for f in found]
        if len(known) > 150_000:
            known.clear()
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, as little-endian 32-bit integers."""
        return [b"".join(parts) for parts in self._table(texts)]


class Decoder:
    """The inverse mapping: ids to bytes, without the model."""

    def __init__(self, path: str):
        import numpy as np

        ranks = read_ranks(path)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self._len = np.array([len(t) for t in tokens], np.int64)
        self._at = np.cumsum(self._len) - self._len
        self._data = np.frombuffer(b"".join(tokens), np.uint8)

    def decode_all(self, ids, ends) -> list[bytes]:
        """Bytes of texts whose ids lie end to end; ``ends``: where each ends."""
        import numpy as np

        size = self._len[ids]
        stop = np.cumsum(size)
        total = int(stop[-1]) if len(stop) else 0
        out = self._data[np.repeat(self._at[ids] - (stop - size), size) + np.arange(total)].tobytes()
        cuts = np.concatenate([[0], stop])[ends].tolist()
        return [out[i:j] for i, j in zip([0, *cuts], cuts)]

    def decode(self, ids: Iterable[int]) -> bytes:
        import numpy as np

        ids = np.fromiter(ids, np.int64)
        return self.decode_all(ids, np.array([len(ids)]))[0]


@lru_cache(maxsize=2)
def coder(path: str) -> ByteBPE:
    """One coder a worker process and file."""
    return ByteBPE(path)


@lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    return Decoder(path)


def _ids_array(parts: list[bytes]):
    import numpy as np
    import pyarrow as pa

    flat = np.frombuffer(b"".join(parts), dtype="<i4")
    ends = np.cumsum([0] + [len(p) // 4 for p in parts], dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat, pa.int32()))


def _rows(batches: Iterator, column: str, cost, max_cost: int = 2 << 20) -> Iterator:
    """Slices of batches, of bounded size."""
    for batch in batches:
        sizes = cost(batch.column(batch.schema.get_field_index(column)))
        for group in batches_of(zip(sizes, range(batch.num_rows)), max_cost=max_cost):
            yield batch.slice(group[0], len(group))
    give_back()


def _text_cost(column) -> list[int]:
    import pyarrow.compute as pc

    return [n or 0 for n in pc.binary_length(column).to_pylist()]


def append(df: DataFrame, column: str, outputs: list[tuple[str, DataType]], values: Callable, cost: Callable = _text_cost) -> DataFrame:
    """``df`` and further columns: ``values`` makes arrays of them, one an output,
    from an array of ``column``.  Other columns pass through whatever their names,
    but those called like an output, in whatever case, go."""
    keep, at = other_columns(df, *[n for n, _ in outputs]), df.columns.index(column)
    fields = [df.schema.fields[i] for i in keep] + [StructField(n, t) for n, t in outputs]
    plain = [f"c{i}" for i in range(len(fields))]  # a name with a dot is no name to Spark here

    def run(batches):
        import pyarrow as pa

        for part in _rows(batches, f"c{at}", cost):
            yield pa.RecordBatch.from_arrays([*[part.column(i) for i in keep], *values(part.column(at))], plain)

    schema = StructType([StructField(c, f.dataType) for c, f in zip(plain, fields)])
    rows = small_batches(df).toDF(*[f"c{i}" for i in range(len(df.columns))])
    return rows.mapInArrow(run, schema).toDF(*[f.name for f in fields])


def encode(docs: DataFrame, text_col: str = "text", out_col: str = "ids", rank_file: str = RANK_FILE) -> DataFrame:
    """``docs`` and an ``array<int>`` of ids."""

    def ids(texts):
        return [_ids_array(coder(tokenizer_path(rank_file)).encode(texts.to_pylist()))]

    return append(docs, text_col, [(out_col, ArrayType(IntegerType()))], ids)


def decode(rows: DataFrame, ids_col: str = "ids", out_col: str = "decoded", rank_file: str = RANK_FILE) -> DataFrame:
    """``rows`` and the bytes that the ids stand for."""

    def lengths(column) -> list[int]:
        import pyarrow.compute as pc

        return [n or 0 for n in pc.list_value_length(column).to_pylist()]

    def texts(column):
        import numpy as np
        import pyarrow as pa

        ids = column.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(np.array(lengths(column), np.int64))
        return [pa.array(decoder(tokenizer_path(rank_file)).decode_all(ids, ends), pa.binary())]

    return append(rows, ids_col, [(out_col, BinaryType())], texts, lambda c: [8 * n for n in lengths(c)])


def round_trip(docs: DataFrame, text_col: str = "text", rank_file: str = RANK_FILE) -> DataFrame:
    """``docs`` with ``ids`` and ``decoded``: :func:`encode` and :func:`decode` in
    one pass, so that the ids go to Python and back once."""

    def both(texts):
        import numpy as np
        import pyarrow as pa

        path = tokenizer_path(rank_file)
        coded = coder(path).encode(texts.to_pylist())
        ends = np.cumsum([len(c) // 4 for c in coded])
        return [_ids_array(coded), pa.array(decoder(path).decode_all(np.frombuffer(b"".join(coded), "<i4"), ends), pa.binary())]

    return append(docs, text_col, [("ids", ArrayType(IntegerType())), ("decoded", BinaryType())], both)


def digests(rows: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of encoded, decoded rows."""
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_byte_bpe(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(round_trip(docs))
