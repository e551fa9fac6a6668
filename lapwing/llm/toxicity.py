"""Toxicity by compression distance.

Two zstandard dictionaries are trained apart, one on toxic and one on ordinary
passages of labelled texts.  Each window of ``WINDOW`` words is compressed with
either; it is the closer to toxic text the more bytes the toxic dictionary saves.
How often the savings pass each of the ``STEPS`` in a text, and how long it is, go
through a logistic curve fitted on labelled texts that the dictionaries have not
seen: the calibrated thresholds, and the score.

Most of a toxic text is ordinary, and the trainer keeps what is frequent, so it
needs passages that are toxic: runs of the words of toxic texts in which a segment
occurs that tells toxic from ordinary texts.  Such segments are found by character
five-grams of words: greedily the gram with the largest significance of its log
odds, widened while nearly all its occurrences agree on the next character; words
that hold it then count for no other gram.  The ordinary passages are runs of the
words of ordinary texts.  Behind both dictionaries stands what the trainer finds in
windows of ordinary text at large, so that a common match costs the same in both.

Bounds: at most ``TOXIC_SAMPLE`` toxic and ``ORDINARY_SAMPLE`` ordinary labelled
rows of together at most ``SAMPLE_BYTES``, taken in the order of a hash of their
ids, are used to fit; the trainer sees at most ``TRAINER_WINDOWS`` of their windows,
evenly spaced.  Every text is scored whole.

Defined results: null and empty texts have no window and get the curve's value
there; unlabelled, null and conflicting labels: nulls are skipped, a document with
any toxic label is toxic; of rows that share an id the least text is learnt from;
null ids are scored, not learnt from and not held out; without toxic or ordinary
rows to learn from every score is 0; an empty table gives an empty result.
Repeated rows score alike; extra columns are kept unless called, in whatever case,
like the output.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from lapwing.llm._common import id_fold, materialize, read_table
from lapwing.llm.byte_bpe import append

TOXIC_SAMPLE = 2000
ORDINARY_SAMPLE = 6000
WINDOW = 8
STEPS = (1, 2, 3, 5)
#: Bytes of the two dictionaries' own parts, and of what stands behind both.
OWN = 256
DICTIONARY = 32 * 1024
LEVEL = 6
#: Bytes of text that are learnt from, at most.
SAMPLE_BYTES = 64 << 20
#: Windows that the dictionary trainer sees at most.
TRAINER_WINDOWS = 60_000
#: Words of a passage.
_PASSAGE = 4
#: Shingles that stand for a text when copies are told: the least by their hashes.
_SKETCH = 64
_GRAM = 5
_SHARED = 4
_COPIED = 0.2
_WIDEN = 0.9
_SIGNIFICANT = 4.0
_ODDS = 5.0
_SUPPORT = 0.012


def windows(text: str | None) -> list[bytes]:
    words = (text or "").lower().split()
    return [(" " + " ".join(words[i : i + WINDOW])).encode("utf-8", "surrogatepass") for i in range(0, len(words), WINDOW)]


# --- learning --------------------------------------------------------------


def apart(texts: list[str]) -> list[str]:
    """``texts`` without those that share much with an earlier one.

    Copies are no independent evidence: what tells a much copied text from the
    rest would pass for what tells toxic text from ordinary."""
    seen: set[int] = set()
    out = []
    for t in texts:
        words = t.lower().split()
        marks = {zlib.crc32(" ".join(words[i : i + _SHARED]).encode("utf-8", "surrogatepass")) for i in range(max(1, len(words) - _SHARED + 1))}
        marks = set(heapq.nsmallest(_SKETCH, marks))
        if len(marks & seen) <= _COPIED * len(marks):
            out.append(t)
        seen |= marks
    return out


def _grams(word: str) -> set[str]:
    return {word[i : i + _GRAM] for i in range(len(word) - _GRAM + 1)}


def _spaced_words(text: str) -> set[str]:
    return {" " + w for w in text.lower().split()}


def segments(toxic: list[str], ordinary: list[str]) -> list[str]:
    """Segments that tell toxic from ordinary texts, the most telling first."""
    import numpy as np

    n_toxic, n_ordinary = len(toxic), len(ordinary)
    least = max(4.0, _SUPPORT * n_toxic)
    seen_in = Counter(g for t in ordinary for g in {g for w in _spaced_words(t) for g in _grams(w)})
    held_by = Counter(g for t in toxic for g in {g for w in _spaced_words(t) for g in _grams(w)})
    telling = {g for g, n in held_by.items() if n >= least and (n / n_toxic) / ((seen_in[g] + 0.5) / n_ordinary) >= _ODDS}
    where: dict[str, set[tuple[int, str]]] = defaultdict(set)  # of the few telling grams only
    for i, t in enumerate(toxic):
        for w in _spaced_words(t):
            for g in telling.intersection(_grams(w)):
                where[g].add((i, w))

    def texts(places: Iterable[tuple[int, str]]) -> int:
        return len({i for i, _ in places})

    def significance(n: int, o: int) -> float:
        odds = np.log((n + 0.5) / (n_toxic + 1)) - np.log((o + 0.5) / (n_ordinary + 1))
        return float(odds / np.sqrt(1 / (n + 0.5) + 1 / (o + 0.5)))

    left = {g: [held_by[g], places] for g, places in where.items()}
    out = []
    while left:
        best = max(left, key=lambda g: (significance(left[g][0], seen_in[g]), g))
        if significance(left[best][0], seen_in[best]) < _SIGNIFICANT:
            break
        gone = set(left.pop(best)[1])
        out.append(_widened(best, gone))
        for g in list(left):
            rest = left[g][1] - gone
            if len(rest) < len(left[g][1]):
                left[g] = [texts(rest), rest]
                if left[g][0] < least:
                    del left[g]
    return out


def _widened(gram: str, places: set[tuple[int, str]]) -> str:
    while True:
        sides: Counter = Counter()
        for _, w in places:
            at = w.find(gram)
            if at > 0:
                sides[0, w[at - 1]] += 1
            if at + len(gram) < len(w):
                sides[1, w[at + len(gram)]] += 1
        if not sides:
            return gram
        (side, c), n = max(sides.items(), key=lambda x: (x[1], x[0]))
        if n < _WIDEN * len(places):
            return gram
        gram = gram + c if side else c + gram
        places = {(i, w) for i, w in places if gram in w}


def _spread(samples: list, n: int) -> list:
    """At most ``n`` samples, evenly spaced."""
    return samples if len(samples) <= n else [samples[i * len(samples) // n] for i in range(n)]


def trained(samples: list[bytes], size: int) -> bytes:
    """What zstandard's trainer keeps of the samples, without its header; where
    there is too little to train on, samples themselves, evenly spaced."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, _spread(samples, TRAINER_WINDOWS)).as_bytes()[8:]
    except zstandard.ZstdError:
        mean = max(1, sum(map(len, samples)) // max(1, len(samples)))
        return b"".join(_spread(samples, max(1, size // mean)))


def _passages(words: list[str]) -> list[bytes]:
    return [("".join(words[i : i + _PASSAGE])).encode("utf-8", "surrogatepass") for i in range(0, len(words), _PASSAGE)]


def dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes] | None:
    """Contents of the toxic and the ordinary dictionary, or None."""
    found = segments(toxic, ordinary)
    windowed = [w for t in ordinary for w in windows(t)]
    if not found or not windowed:
        return None
    telling = re.compile("|".join(map(re.escape, sorted(found, key=len, reverse=True)))).search
    spaced = lambda t: [" " + w for w in t.lower().split()]
    of_toxic = [p for t in toxic for p in _passages([w for w in spaced(t) if telling(w)])]
    of_ordinary = _spread([p for t in ordinary for p in _passages(spaced(t))], len(of_toxic))
    own, other, common = trained(of_toxic, OWN), trained(of_ordinary, OWN), trained(windowed, DICTIONARY)
    # Telling segments for which the trainer had no room, and ordinary text in their place.
    own += "".join(s for s in reversed(found) if s.encode("utf-8", "surrogatepass") not in own).encode("utf-8", "surrogatepass")
    filler = b"".join(_spread(windowed, len(own)))
    other = (filler[: max(0, len(own) - len(other))] + other)[-len(own) :]
    return own + common, other + common


class Model:
    """Dictionaries and the fitted curve; small, and shipped with the tasks."""

    def __init__(self, contents: tuple[bytes, bytes] | None, weights=None, mean=None, scale=None):
        self.contents, self.weights, self.mean, self.scale = contents, weights, mean, scale


@lru_cache(maxsize=2)
def _compressors(contents: tuple[bytes, bytes]):
    import zstandard as z

    params = z.ZstdCompressionParameters.from_level(
        LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False, format=z.FORMAT_ZSTD1_MAGICLESS
    )
    out = []
    for content in contents:
        d = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=params)
        out.append(z.ZstdCompressor(dict_data=d, compression_params=params).compress)
    return out


def savings(text: str | None, contents: tuple[bytes, bytes]) -> list[int]:
    """For each window the bytes that the toxic dictionary saves."""
    toxic, ordinary = _compressors(contents)
    return [len(ordinary(w)) - len(toxic(w)) for w in windows(text)]


def features(text: str | None, contents: tuple[bytes, bytes]) -> list[float]:
    import numpy as np

    saved = np.array(savings(text, contents), np.int64)
    n = max(1, len(saved))
    out = [np.log1p(n)]
    for step in STEPS:
        k = int((saved >= step).sum())
        out += [np.log1p(k), np.sqrt(k / n)]
    return out


def fit(toxic: list[str], ordinary: list[str]) -> Model:
    """Dictionaries from all texts; the curve from savings on each half of them
    by dictionaries made of the other half."""
    import numpy as np

    contents = dictionaries(toxic, ordinary)
    x, y = [], []
    for k in (0, 1):
        half = dictionaries(toxic[k::2], ordinary[k::2])
        if half is None:
            continue
        for label, texts in ((1.0, toxic[1 - k :: 2]), (0.0, ordinary[1 - k :: 2])):
            x += [features(t, half) for t in texts]
            y += [label] * len(texts)
    if contents is None or len(set(y)) < 2:
        return Model(None)
    x, y = np.array(x, float), np.array(y)
    mean, scale = x.mean(0), x.std(0) + 1e-9
    a = np.c_[(x - mean) / scale, np.ones(len(x))]
    w, ridge = np.zeros(a.shape[1]), np.r_[np.full(a.shape[1] - 1, 3e-3 * len(y)), 1e-6]
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(ridge + 1e-6), a.T @ (p - y) + ridge * w)
        w -= step * min(1.0, 3 / max(np.abs(step).max(), 1e-12))
    return Model(contents, w, mean, scale)


def score_texts(texts: list[str | None], model: Model) -> list[float]:
    import numpy as np

    if model.contents is None:
        return [0.0] * len(texts)
    x = np.array([features(t, model.contents) for t in texts], float).reshape(len(texts), -1)
    a = np.c_[(x - model.mean) / model.scale, np.ones(len(x))]
    return (1 / (1 + np.exp(-np.clip(a @ model.weights, -30, 30)))).tolist()


# --- DataFrames ------------------------------------------------------------


def learn(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", label_col: str = "toxic") -> Model:
    """Fit on a bounded sample of the labelled rows outside the held-out fold.

    The ids are chosen first (two bounded lists), then only their texts move."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (id_fold(F.col(id_col)) != 0))
    known = known.groupBy(F.col(id_col).alias("_id")).agg((F.max(label_col) > 0).alias("_toxic"))
    place = F.xxhash64(F.col("_id").cast("string"), F.lit("toxicity"))
    chosen = [known.where(which).orderBy(place, "_id").limit(n) for which, n in (("_toxic", TOXIC_SAMPLE), ("not _toxic", ORDINARY_SAMPLE))]
    chosen = chosen[0].unionByName(chosen[1])  # at most TOXIC_SAMPLE + ORDINARY_SAMPLE rows
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).where("_text is not null")
    rows = rows.join(F.broadcast(chosen), "_id").groupBy("_id", "_toxic").agg(F.min("_text").alias("_text"))
    rows = materialize(rows.select("_id", "_toxic", "_text", place.alias("_place")), "labelled")
    so_far = Window.orderBy("_place", "_id")  # over as many rows as are chosen
    fits = rows.select("_id", F.sum(F.octet_length("_text")).over(so_far).alias("_bytes")).where(F.col("_bytes") <= SAMPLE_BYTES)
    texts = rows.join(F.broadcast(fits.select("_id")), "_id").orderBy("_place", "_id").collect()
    return fit(*(apart([r["_text"] for r in texts if r["_toxic"] == toxic]) for toxic in (True, False)))


def score(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` and a score from 0 to 1 for each whole text."""

    def scores(texts):
        import pyarrow as pa

        return [pa.array(score_texts(texts.to_pylist(), model), pa.float64())]

    return append(docs, text_col, [(out_col, DoubleType())], scores)


def op1_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn(docs, read_table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return score(docs, model).select(
        "doc_id",
        F.coalesce(id_fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
