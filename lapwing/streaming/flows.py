"""Structured Streaming: claims, freshness, windows and keyed state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def claims(updates: DataFrame, key: str, at: str, keep: str = "1 day") -> DataFrame:
    """Each key once, the first time it is seen; a key is remembered for ``keep``
    of event time.  On a table: one row a key."""
    if updates.isStreaming:
        return updates.withWatermark(at, keep).dropDuplicatesWithinWatermark([key])
    return updates.dropDuplicates([key])


def route(text: Column) -> Column:
    """What a message asks for: a command, else an address, else nothing."""
    command = F.lower(F.regexp_extract(text, r"^\s*/([A-Za-z]+)", 1))
    has_url = text.rlike(r"https?://\S+")
    return (
        F.when(command == "help", "help")
        .when(command == "next", "series_next")
        .when(~has_url, "none")
        .when(command == "part", "series_start")
        .when(command == "long", "long")
        .otherwise("short")
    )


def fresh(status: Column, updated_us: Column, now_us: Column, ttl_seconds: int = 14400) -> Column:
    """Whether a job that is said to run has been heard of lately."""
    return (status == "running") & (now_us - updated_us <= ttl_seconds * 1_000_000)


def tumbling(events: DataFrame, at: str, keys: list[str], size: str, late: str, value: str) -> DataFrame:
    """Counts and sums by window and key; what is later than ``late`` is dropped."""
    rows = events.withWatermark(at, late) if events.isStreaming else events
    return rows.groupBy(F.window(at, size).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))


def sessions(events: DataFrame, at: str, keys: list[str], gap: str, late: str) -> DataFrame:
    """Runs of events of a key with no gap of ``gap`` or more between them."""
    rows = events.withWatermark(at, late) if events.isStreaming else events
    return rows.groupBy(F.session_window(at, gap).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))


#: State of a series: the part that runs, its batch, where the next one begins.
SERIES_STATE = "part long, batch string, next_start double, status string"
SERIES_OUT = "chat_id long, update_id long, action string, part long, next_start double, status string"


def series_step(state: tuple, row: dict) -> tuple[tuple, str]:
    """One event applied to a series' state: the new state and what it did."""
    part, batch, next_start, status = state
    kind = row["event"]
    if kind == "start":
        return (part + 1 if status != "failed" else part, row["batch_id"], next_start, "running"), "started"
    if row["batch_id"] != batch:  # an answer to a batch that is no longer the active one
        return state, "stale"
    if kind == "completed":
        return (part, None, max(next_start, row["end"]), "done"), "advanced"
    return (part, None, next_start, "failed"), "failed"


def _series(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    now = state.get if state.exists else (0, None, 0.0, "new")
    out = []
    for frame in frames:
        for row in frame.sort_values("update_id").to_dict("records"):
            now, action = series_step(now, row)
            out.append((key[0], row["update_id"], action, now[0], now[2], now[3]))
    state.update(now)
    yield pd.DataFrame(out, columns=[c.split()[0] for c in SERIES_OUT.split(", ")])


def series(events: DataFrame) -> DataFrame:
    """Keyed series state over a stream of ``chat_id, update_id, event, batch_id,
    end``; rows tell what each event did.  The state store replaces the
    read-modify-write of a shared document."""
    return events.groupBy("chat_id").applyInPandasWithState(_series, SERIES_OUT, SERIES_STATE, "append", "NoTimeout")


def series_batch(events: DataFrame) -> DataFrame:
    """The same over a table: one scan of each key's events in order."""
    from lapwing.operators.folds import fold_per_key

    def fold(rows: list[dict]) -> list[dict]:
        now, out = (0, None, 0.0, "new"), []
        for row in rows:
            now, action = series_step(now, row)
            out.append({"update_id": row["update_id"], "action": action, "part": now[0], "next_start": now[2], "status": now[3]})
        return out

    return fold_per_key(events, ["chat_id"], fold, SERIES_OUT.split(", ", 1)[1], ["update_id"])


def upsert(table_path: str, key: str, order: str):
    """A ``foreachBatch`` function that keeps the last row of each key in a table,
    written anew beside the old one each time (last write wins)."""

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        rows = batch
        if epoch:
            rows = rows.unionByName(spark.read.parquet(f"{table_path}/v={epoch - 1}"))
        last = rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), order).alias("r")).select("r.*")
        last.write.mode("overwrite").parquet(f"{table_path}/v={epoch}")

    return write
