"""Quality by importance resampling.

Two generative models of hashed word unigrams and bigrams (``BUCKETS`` of them,
case and punctuation kept): one of the target, texts labelled good, one of the raw
corpus, all texts.  A document's log weight is the mean log ratio of its n-grams
under the two, times ``LENGTH``, so that long texts are not told apart by length
alone.  Adding Gumbel noise to the log weights and keeping the top ``k`` draws
``k`` documents without replacement with probabilities that follow the weights.

``k`` is a share of all rows: by default the share of good texts among the labelled
rows learnt from.  The noise comes from a hash of id and text, so a rerun draws the
same sample.  The cut is found by histograms of the keys, each refining the bin
that holds the ``k``-th, never by a sort of all rows; equal keys at the cut are all
kept.

Counts of the raw model cover all texts, the target's all good labelled ones; what
reaches the driver is the table of bucket counts, whose size is fixed.  Labels are learnt from rows whose crc32(id) mod 5 is not 0.

Defined results: null and empty texts have no n-gram and log weight 0; null ids are
scored and drawn like others; labels that are null are skipped, of conflicting ones
the lowest counts; without good labelled texts all weights are 0 and the share is 1;
repeated rows share a key; an empty table gives an empty result; extra columns are not
looked at, whatever they are called.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwing.llm._common import id_fold, materialize, parted, read_table, slot, small_batches
from lapwing.llm._words import mixed, tokens
from lapwing.llm.byte_bpe import _rows, _text_cost

BUCKETS = 1 << 16
LENGTH = 64.0
SMOOTHING = 1.0
_BINS = 4096


def gram_buckets(texts: list[str | None]):
    """Buckets of all n-grams, text after text, and how many each text has."""
    code, cuts = tokens(texts, lower=False)
    doc = np.repeat(np.arange(len(texts)), np.diff(cuts, prepend=0))
    code = mixed(code)
    pair = mixed(code[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ code[1:])
    same = doc[1:] == doc[:-1]
    codes, docs = np.concatenate([code, pair[same]]), np.concatenate([doc, doc[1:][same]])
    order = np.argsort(docs, kind="stable")
    return (codes[order] >> np.uint64(48)).astype(np.int64), np.bincount(docs, minlength=len(texts))


def _counts(batches):
    import pyarrow as pa

    total = np.zeros((2, BUCKETS), np.int64)
    for part in _rows(batches, "text", _text_cost):
        bucket, size = gram_buckets(part.column(0).to_pylist())
        good = np.repeat(np.array(part.column(1).to_pylist(), bool), size)
        total[0] += np.bincount(bucket, minlength=BUCKETS)
        total[1] += np.bincount(bucket[good], minlength=BUCKETS)
    seen = np.flatnonzero(total[0])
    yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[0][seen]), pa.array(total[1][seen])], ["bucket", "raw", "target"])


def log_ratios(docs: DataFrame):
    """Log ratio of the target's to the raw model for each bucket; ``docs`` has
    ``text`` and ``good``."""
    rows = small_batches(docs).select("text", "good").mapInArrow(_counts, "bucket int, raw long, target long")
    table = rows.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()  # at most BUCKETS rows
    n = np.zeros((2, BUCKETS))
    for r in table:
        n[:, r["bucket"]] = r["raw"], r["target"]
    if not n[1].sum():
        return np.zeros(BUCKETS)
    # The target's prior is the raw model, so what it has not seen is no evidence
    # beyond what its size makes it.
    raw = (n[0] + SMOOTHING) / (n[0].sum() + SMOOTHING * BUCKETS)
    target = (n[1] + SMOOTHING * BUCKETS * raw) / (n[1].sum() + SMOOTHING * BUCKETS)
    return np.log(target) - np.log(raw)


def _cut(keys: DataFrame, k: int, n: int) -> float:
    """The ``k``-th largest key, up to the last bin of four refinements."""
    ends = keys.agg(F.min("key").alias("lo"), F.max("key").alias("hi")).first()
    lo, hi, above = ends["lo"], ends["hi"], 0
    if k >= n:
        return lo
    for _ in range(4):
        width = (hi - lo) / _BINS
        if width <= 0 or lo + width == lo:
            break
        inside = keys.where((F.col("key") >= lo) & (F.col("key") <= hi))
        bin_ = F.least(F.floor((F.col("key") - lo) / width), F.lit(_BINS - 1)).alias("bin")
        for r in sorted(inside.groupBy(bin_).count().collect(), key=lambda r: -r["bin"]):  # at most _BINS rows
            if above + r["count"] >= k:
                lo, hi = lo + r["bin"] * width, min(hi, lo + (r["bin"] + 1) * width)
                break
            above += r["count"]
    return lo


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, seed: int = 1) -> DataFrame:
    """``doc_id, held_out, log_weight, key, kept`` for each row of ``docs``."""
    fold = id_fold(F.col("doc_id"))
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg((F.min("quality") > 0).alias("label"))
    learnt = known.where(id_fold(F.col("doc_id")) != 0)
    target = learnt.where("label").select("doc_id", F.lit(True).alias("good"), slot(F.col("doc_id")).alias("_slot"))
    # Only texts that may be good ones move, whatever the sizes (hence the hint).
    sure, unsure = parted(docs.select("doc_id", "text", slot(F.col("doc_id")).alias("_slot")), target)
    marked = unsure.join(target.drop("_slot").hint("merge"), "doc_id", "left").select("text", F.coalesce("good", F.lit(False)).alias("good"))
    ratio = log_ratios(sure.select("text", F.lit(False).alias("good")).unionByName(marked))
    if share is None:
        share = learnt.agg(F.avg(F.col("label").cast("double")).alias("s")).first()["s"]
        share = 1.0 if not share else share

    def run(batches):
        import pyarrow as pa

        for part in _rows(batches, "text", _text_cost):
            bucket, size = gram_buckets(part.column(0).to_pylist())
            sums = np.bincount(np.repeat(np.arange(len(size)), size), weights=ratio[bucket], minlength=len(size))
            weight = LENGTH * sums / np.maximum(size, 1)
            yield pa.RecordBatch.from_arrays([*[part.column(i) for i in (1, 2, 3)], pa.array(weight)], ["doc_id", "held_out", "h", "log_weight"])

    h = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")), F.lit(seed))
    rows = small_batches(docs).select("text", "doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), h.alias("h"))
    scored = rows.mapInArrow(run, "doc_id long, held_out boolean, h long, log_weight double")
    u = (F.pmod("h", F.lit(1 << 52)) + 0.5) / float(1 << 52)
    keyed = materialize(scored.select("doc_id", "held_out", "log_weight", (F.col("log_weight") - F.log(-F.log(u))).alias("key")), "keys")
    n = keyed.count()
    cut = _cut(keyed, max(1, round(share * n)), n) if n else 0.0
    return keyed.withColumn("kept", F.col("key") >= cut)


def op2_quality(spark, sf_dir: str) -> DataFrame:
    found = resample(read_table(spark, sf_dir, "documents").select("doc_id", "text"), read_table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return found.select("doc_id", "held_out", "log_weight", (1 / (1 + F.exp(-F.col("log_weight")))).alias("score"), F.col("key").alias("gumbel_key"), "kept")
