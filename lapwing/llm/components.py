"""Connected components of a link table, by alternating large and small stars.

Every round is a few DataFrame joins and aggregations written to the shared
folder, so lineage stays short and no links reach the driver.  The minimum of a
node's neighbours is pre-aggregated before its shuffle; the join back to the
links is between two written tables, which lets adaptive execution split the
links of a very popular node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwing.llm._common import materialize


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _signature(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return r["n"], r["x"]


def _large_star(edges: DataFrame) -> DataFrame:
    links = _both_ways(edges)
    least = materialize(links.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
    return links.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = materialize(down.groupBy("a").agg(F.min("b").alias("m")), "least")
    leaves = down.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return leaves.unionByName(least.select("a", F.col("m").alias("b"))).where("a != b")


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``a, b``); the root is
    the smallest node that can be reached.  Null ends, loops and repeats are
    ignored; no links give an empty table."""
    kind = edges.schema["a"].dataType
    now = materialize(
        edges.where("a is not null and b is not null and a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    before = _signature(now)
    while before[0]:
        now = materialize(_small_star(materialize(_large_star(now).distinct(), "large")).distinct(), "small")
        after = _signature(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots).select(
        F.col("node").cast(kind), F.col("root").cast(kind)
    )
