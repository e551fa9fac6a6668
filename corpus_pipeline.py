"""The corpus pipeline: from ``documents`` to token ids, in five stages.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; its result
is written as Parquet in the shared folder and read again as the next stage's
``docs``.  All but the last return the columns of ``documents``, whatever further
columns there are and whatever these are called.

Defined results: null texts count as empty; an empty text is not toxic unless the
curve says so of no window at all, equals every other empty text, has no benchmark
window and encodes to no ids; null ids are kept unless a copy with an id stays; rows
that agree in id and text leave one row; empty tables give empty results; texts of
any length are processed whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapwing.llm import byte_bpe, decontaminate, exact_dedup, simhash, toxicity
from lapwing.llm._common import free_name, materialize, read_table

#: Documents from this score on are rejected.
TOXIC_FROM = 0.5
#: Similarity of five-word shingles from which documents are near copies.
NEAR_FROM = 0.8


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under ``TOXIC_FROM``."""
    model = toxicity.learn(docs, read_table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    name = free_name(docs, "toxicity_score")
    return toxicity.score(docs, model, out_col=name).where(F.col(name) < TOXIC_FROM).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal but for white space, the one with the smallest id."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the one with the smallest id."""
    return simhash.near_deduplicate(docs, NEAR_FROM)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark").select("item_id", "text"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of the ids and of the bytes that
    they decode to."""
    coded = byte_bpe.round_trip(docs.select("doc_id", "text"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode),
]

#: Compression, fingerprints and merges are beyond SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
