"""The supplied tables read as the domain's inputs, and the same views as SQL.

Times are BIGINT microseconds (``events``) or BIGINT text positions
(``conversations``), boxes are integers: every result can be compared exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MINUTE_US = 60_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``key, ord, kind, start, end``: an event lasts ``floor(value)`` minutes."""
    start = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("key"),
        F.col("event_id").alias("ord"),
        F.col("event_type").alias("kind"),
        start.alias("start"),
        (start + F.floor("value") * F.lit(MINUTE_US)).alias("end"),
    )


INTERVALS_SQL = """iv AS (
  SELECT user_id AS key, event_id AS ord, event_type AS kind, epoch_us(ts) AS s,
         epoch_us(ts) + CAST(floor(value) AS BIGINT) * 60000000 AS e
  FROM events)"""


def dialogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conv_id, ord, role, text, start, end``: turns laid end to end."""
    c = table(spark, sf_dir, "conversations")
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("text").cast("long")).over(before), F.lit(0))
    return c.select("conv_id", F.col("turn").alias("ord"), "role", "text", start.alias("start"), (start + F.length("text")).alias("end"))


DIALOGUE_SQL = """dl AS (
  SELECT conv_id, turn AS ord, role, text, s, s + length(text) AS e FROM (
    SELECT conv_id, turn, role, text, CAST(coalesce(sum(length(text)) OVER (
      PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS s
    FROM conversations))"""


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``frame, ord, x1, y1, x2, y2, score``: boxes in a 1280 x 720 frame, several
    to a frame; repeated line numbers are told apart by ``ord``."""
    li = table(spark, sf_dir, "lineitem")
    x1, y1 = F.expr("l_partkey % 1100"), F.expr("l_suppkey * 7 % 640")
    return li.select(
        F.col("l_orderkey").alias("frame"),
        F.expr("l_partkey * 100000 + l_suppkey * 10 + l_linenumber").alias("ord"),
        x1.cast("int").alias("x1"),
        y1.cast("int").alias("y1"),
        (x1 + 8 + F.col("l_quantity").cast("int") * 3).cast("int").alias("x2"),
        (y1 + 6 + F.col("l_linenumber") * 9).cast("int").alias("y2"),
        F.expr("cast(round(l_discount * 100) as int)").alias("score"),
    ).distinct()


BOXES_SQL = """bx AS (
  SELECT DISTINCT l_orderkey AS frame, l_partkey * 100000 + l_suppkey * 10 + l_linenumber AS ord,
    CAST(l_partkey % 1100 AS INT) AS x1, CAST(l_suppkey * 7 % 640 AS INT) AS y1,
    CAST(l_partkey % 1100 + 8 + CAST(l_quantity AS INT) * 3 AS INT) AS x2,
    CAST(l_suppkey * 7 % 640 + 6 + l_linenumber * 9 AS INT) AS y2,
    CAST(round(l_discount * 100) AS INT) AS score
  FROM lineitem)"""
