"""Sinks: subtitle files and the documents that jobs leave behind."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapwing.functions import text as tx
from lapwing.functions import timefmt as tf


def srt_documents(cues: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """One SRT text a key and its number of cues; empty and degenerate cues go
    before the rest is numbered from 1.  Times are whole milliseconds."""
    w = Window.partitionBy(*keys).orderBy("ord")
    rows = cues.where((F.col("end") > F.col("start")) & (F.trim(text) != "")).withColumn("i", F.row_number().over(w))
    block = F.concat(F.col("i").cast("string"), F.lit("\n"), tf.srt_time(F.col("start")), F.lit(" --> "), tf.srt_time(F.col("end")), F.lit("\n"), F.trim(text))
    ordered = F.array_sort(F.collect_list(F.struct("i", block.alias("b"))))
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("cues"), F.array_join(F.transform(ordered, lambda x: x["b"]), "\n\n").alias("srt"))


def ass_documents(cues: DataFrame, keys: Sequence[str], header: str, style: str = "Default", text: str = "text") -> DataFrame:
    """One ASS text a key: an event a cue, text in two balanced lines.  Times are
    whole centiseconds."""
    rows = cues.where((F.col("end") > F.col("start")) & (F.trim(text) != ""))
    body = F.array_join(F.transform(tx.balanced_lines(F.col(text)), tx.ass_escape), "\\N")
    event = F.concat(F.lit("Dialogue: 0,"), tf.ass_time(F.col("start")), F.lit(","), tf.ass_time(F.col("end")), F.lit(f",{style},,0,0,0,,"), body)
    ordered = F.array_sort(F.collect_list(F.struct("start", "end", "ord", event.alias("e"))))
    lines = F.array_join(F.transform(ordered, lambda x: x["e"]), "\n")
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("events"), F.concat(F.lit(header), lines).alias("ass"))


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines, replacing what is there."""
    df.write.mode("overwrite").json(path)


def write_versioned(df: DataFrame, path: str, version: str) -> str:
    """A copy under its own version; versions are never replaced."""
    where = f"{path.rstrip('/')}/version={version}"
    df.write.mode("errorifexists").parquet(where)
    return where


def relocate(df: DataFrame, old: str, new: str, uris: Sequence[str]) -> DataFrame:
    """A copied document's own addresses moved from one prefix to another."""
    moved = lambda c: F.when(F.startswith(c, F.lit(old)), F.concat(F.lit(new), F.substr(c, F.lit(len(old) + 1)))).otherwise(c)
    return df.withColumns({c: moved(F.col(c)) for c in uris})


def last_ids(ids: Column, n: int = 2000) -> Column:
    """The last ``n`` of an array of processed ids."""
    return F.when(F.size(ids) > n, F.slice(ids, F.lit(-n), F.lit(n))).otherwise(ids)


def claim_once(updates: DataFrame, key: str = "update_id") -> DataFrame:
    """Exactly one row a key, batch or stream."""
    return updates.dropDuplicates([key])
