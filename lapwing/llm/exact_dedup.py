"""Exact deduplication with a heavy-hitter split (DataFrame operations only).

1. One pass over the texts writes ``(row, id, digest)``; the texts are not read
   again for the grouping.
2. A Misra-Gries style frequent-items summary (mergeable, ``counters`` entries)
   proposes frequent digests.  It is built per slice of the input and the
   slices are combined, so no task sees more than a bounded summary per slice.
3. The proposals are verified: their exact counts and winners are computed with
   map-side partial aggregation.  At most ``counters`` rows remain, which is the
   proven bound for broadcasting them.
4. Rows with a frequent digest meet their winner on the map side.  All other
   digests are rarer than about ``2 / counters`` of the rows, so an ordinary
   shuffle on the digest has no hot key.

Defined results: null text is empty text; empty texts are equal to each other;
null ids sort last, so a group keeps its smallest non-null id; rows that agree in
text *and* id keep exactly one of them; an empty table gives an empty result;
extra columns pass through untouched whatever they are called (the helper
columns live in tables of their own).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwing.llm._common import materialize, parted, read_table, slot, text_or_empty

#: Size of the frequent-items summary, hence the bound of the broadcast.
COUNTERS = 2048
#: Slices that summarise on their own before they are combined.
SLICES = 64

#: White-space runs that one space replaces: all but a lone space.
_RUN = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalized(text: Column) -> Column:
    """Each run of space, tab, LF, VT, FF and CR becomes one space."""
    return F.regexp_replace(text_or_empty(text), _RUN, " ")


def digest_hex(text: Column) -> Column:
    return F.sha2(normalized(text), 256)


def _frequent(digests: DataFrame, counters: int, slices: int) -> DataFrame:
    """Digests that may be frequent, at most ``counters`` of them."""
    sketch = F.expr(f"approx_top_k_accumulate(hex(digest), {counters})")
    combine = F.expr(f"approx_top_k_combine(sketch, {counters})")
    estimate = F.expr(f"approx_top_k_estimate(sketch, {counters})")
    return (
        digests.groupBy(F.pmod(F.spark_partition_id(), F.lit(slices)).alias("slice"))
        .agg(sketch.alias("sketch"))
        # Grouped by a constant: an ungrouped aggregate would also merge the blank
        # summaries of tasks without rows, which the combining function rejects.
        .groupBy((F.col("slice") * 0).alias("all"))
        .agg(combine.alias("sketch"))
        .where("sketch is not null")
        .select(F.explode(estimate).alias("e"))
        .where("e.item is not null and e.count > 1")
        .select(F.unhex("e.item").alias("digest"))
    )


def _winner(by: list[str], rows: DataFrame) -> DataFrame:
    return rows.groupBy(*by).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "rid")).alias("win"),
        F.count(F.lit(1)).alias("group_size"),
    )


def membership(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    counters: int = COUNTERS,
    slices: int = SLICES,
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    digests = materialize(
        docs.select(
            F.monotonically_increasing_id().alias("rid"),
            F.col(id_col).alias("doc_id"),
            F.unhex(digest_hex(F.col(text_col))).alias("digest"),
        ),
        "digests",
    )
    if digests.isEmpty():
        return _shape(digests.withColumns({"win": F.struct(F.lit(False).alias("n"), "doc_id", "rid"), "group_size": F.lit(1).cast("long")}))
    candidates = materialize(_frequent(digests, counters, slices), "frequent")
    hot = materialize(
        _winner(["digest"], digests.join(F.broadcast(candidates), "digest", "left_semi")).where("group_size > 1"),
        "winners",
    )
    marked = digests.join(F.broadcast(hot), "digest", "left")
    frequent = marked.where("win is not null")
    rare = marked.where("win is null").drop("win", "group_size")
    # Aggregated before its shuffle, and joined back so that adaptive execution can
    # split what a digest just below the summary's reach still gathers.
    rest = rare.join(_winner(["digest"], rare), "digest")
    return _shape(frequent.unionByName(rest))


def _shape(rows: DataFrame) -> DataFrame:
    return rows.select(
        "doc_id",
        F.col("win.doc_id").alias("keep_id"),
        F.col("group_size").cast("long").alias("group_size"),
        (F.col("win.rid") == F.col("rid")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def deduplicate(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", counters: int = COUNTERS
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows that share id and text are told apart by nothing but their other
    columns; one of them stays.
    """
    member = membership(docs, text_col, id_col, counters)
    told = member.groupBy("doc_id", "text_sha256").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("same"))
    # Texts are neither moved nor hashed again but for the ids of these.
    told = told.where("not kept or same > 1").select(F.col("doc_id").alias("kd"), F.col("text_sha256").alias("kh"), "kept", slot(F.col("doc_id")).alias("_slot"))
    told = materialize(told, "dropped")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("d"), slot(F.col(id_col)).alias("_slot"))
    sure, unsure = parted(rows, told)
    unsure = unsure.withColumn("h", digest_hex(F.col(f"row.`{text_col}`")))
    joined = unsure.join(told.drop("_slot"), F.col("d").eqNullSafe(F.col("kd")) & (F.col("h") == F.col("kh")), "left")
    tied = joined.where("kept").dropDuplicates(["kd", "kh"])
    return sure.select("row.*").union(joined.where("kh is null").select("row.*")).union(tied.select("row.*"))


def op6_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return membership(read_table(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept,
       text_sha256
FROM d
"""
