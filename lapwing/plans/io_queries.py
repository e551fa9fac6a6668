"""Source, sink and streaming queries over the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapwing.datasets import DIALOGUE_SQL, INTERVALS_SQL, dialogue, intervals, table
from lapwing.registry import query
from lapwing.sources import readers, sinks
from lapwing.streaming import flows


def _meta(spark, sf_dir):
    """Orders as videos."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("video_id"), F.lit(25.0).alias("fps"), (F.col("o_custkey") % 400 + 1).cast("int").alias("frames")
    )


@query("s02_s17_cache_hits", "SELECT d.doc_id, l.doc_id IS NOT NULL AS hit FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON l.doc_id = d.doc_id")
def s02_s17_cache_hits(spark, sf_dir):
    return readers.existing(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id").select("doc_id", "hit")


@query("s04_strict_json")
def s04_strict_json(spark, sf_dir):
    from pyspark.sql import types as T

    t = F.when(F.col("event_id") % 5 == 0, F.lit('{"a":1,"a":2}')).when(F.col("event_id") % 5 == 1, F.lit('{"a":NaN}')).otherwise(F.col("props"))
    rows = table(spark, sf_dir, "events").select("event_id", t.alias("t"))
    return readers.strict_json(rows, "t", T.StructType([T.StructField("a", T.LongType())])).select("event_id", "problem")


@query("s05_task_input", "SELECT o_orderkey, o_orderkey % 8 AS task FROM orders")
def s05_task_input(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 8).alias("task"))
    return readers.task_input(rows, "task", 8)


@query("s08_sample_frames", "SELECT CAST(o_orderkey AS VARCHAR) AS video_id, CAST(unnest(range(0, greatest(1, o_custkey % 400 + 1), 6)) AS INT) AS frame FROM orders")
def s08_sample_frames(spark, sf_dir):
    return readers.sample_frames(_meta(spark, sf_dir), 4.0)


@query(
    "s09_nearest_frames",
    """WITH m AS (SELECT CAST(o_orderkey AS VARCHAR) AS video_id, CAST(o_custkey % 400 + 1 AS INT) AS frames FROM orders), x AS (SELECT video_id, frames, unnest(range(0, CAST(greatest(1, ceil(frames / 25.0 * 5.0)) AS BIGINT))) AS i FROM m)
    SELECT DISTINCT video_id, CAST(least(frames - 1, i * 5) AS INT) AS frame FROM x""",
)
def s09_nearest_frames(spark, sf_dir):
    return readers.nearest_frames(_meta(spark, sf_dir), 5.0)


@query(
    "s16_cue_override",
    f"""WITH {DIALOGUE_SQL}, c AS (SELECT conv_id, ord, greatest(0.0, least(s / 10.0, 60.0)) AS s, greatest(0.0, least(e / 10.0, 60.0)) AS e, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM dl),
    n AS (SELECT *, lag(s) OVER (PARTITION BY conv_id ORDER BY ord) AS ps FROM c) SELECT conv_id AS video_id, ord, CASE WHEN t = '' THEN 'empty' WHEN e <= s THEN 'degenerate' WHEN s < ps THEN 'unsorted' ELSE '' END AS problem FROM n""",
)
def s16_cue_override(spark, sf_dir):
    rows = dialogue(spark, sf_dir).select(F.col("conv_id").alias("video_id"), "ord", (F.col("start") / 10).alias("start"), (F.col("end") / 10).alias("end"), F.col("text").alias("text_vi"))
    return readers.cue_override(rows, 60.0).select("video_id", "ord", "problem")


@query("k04_k06_ass")
def k04_k06_ass(spark, sf_dir):
    return sinks.ass_documents(dialogue(spark, sf_dir), ["conv_id"], "[Events]\n")


@query("k07_k08_relocate", "SELECT page_id, CASE WHEN starts_with(url, 'https://') THEN 'gs://copy/' || substr(url, 9) ELSE url END AS url FROM pages")
def k07_k08_relocate(spark, sf_dir):
    return sinks.relocate(table(spark, sf_dir, "pages").select("page_id", "url"), "https://", "gs://copy/", ["url"])


@query("k09_last_ids", "WITH r AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events) SELECT user_id, event_id FROM r WHERE n <= 20")
def k09_last_ids(spark, sf_dir):
    ids = table(spark, sf_dir, "events").groupBy("user_id").agg(F.sort_array(F.collect_list("event_id")).alias("ids"))
    return ids.select("user_id", F.explode(sinks.last_ids(F.col("ids"), 20)).alias("event_id"))


@query("k11_claims", "SELECT DISTINCT user_id FROM events")
def k11_claims(spark, sf_dir):
    return flows.claims(table(spark, sf_dir, "events").select("user_id", "ts"), "user_id", "ts").select("user_id")


@query(
    "st05_route",
    """WITH m AS (SELECT page_id, CASE page_id % 6 WHEN 0 THEN '/help' WHEN 1 THEN '/next ' || url WHEN 2 THEN '/part ' || url WHEN 3 THEN ' /LONG ' || url WHEN 4 THEN url ELSE 'hello' END AS t FROM pages)
    SELECT page_id, CASE WHEN t = '/help' THEN 'help' WHEN page_id % 6 = 1 THEN 'series_next' WHEN NOT regexp_matches(t, 'https?://\\S+') THEN 'none' WHEN page_id % 6 = 2 THEN 'series_start' WHEN page_id % 6 = 3 THEN 'long' ELSE 'short' END AS route FROM m""",
)
def st05_route(spark, sf_dir):
    i = F.col("page_id") % 6
    t = F.when(i == 0, "/help").when(i == 1, F.concat(F.lit("/next "), "url")).when(i == 2, F.concat(F.lit("/part "), "url")).when(i == 3, F.concat(F.lit(" /LONG "), "url")).when(i == 4, F.col("url")).otherwise("hello")
    return table(spark, sf_dir, "pages").select("page_id", flows.route(t).alias("route"))


@query("st06_fresh", f"WITH {INTERVALS_SQL} SELECT key, ord, kind = 'view' AND 1706000000000000 - s <= 14400000000 AS fresh FROM iv")
def st06_fresh(spark, sf_dir):
    status = F.when(F.col("kind") == "view", "running").otherwise("done")
    return intervals(spark, sf_dir).select("key", "ord", flows.fresh(status, F.col("start"), F.lit(1706000000000000)).alias("fresh"))


@query(
    "st_windows",
    """SELECT time_bucket(INTERVAL 1 HOUR, ts) AS w_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""",
)
def st_windows(spark, sf_dir):
    out = flows.tumbling(table(spark, sf_dir, "events"), "ts", ["event_type"], "1 hour", "10 minutes", "value")
    return out.select(F.col("w.start").alias("w_start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("st02_st04_series")
def st02_st04_series(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    kind = F.when(F.col("event_type").isin("view", "click"), "start").when(F.col("event_type") == "error", "failed").otherwise("completed")
    batch = F.when(F.col("event_type") == "signup", "b0").otherwise(F.concat(F.lit("b"), (F.col("event_id") % 3).cast("string")))
    return flows.series_batch(rows.select(F.col("user_id").alias("chat_id"), F.col("event_id").alias("update_id"), kind.alias("event"), batch.alias("batch_id"), F.col("value").alias("end")))


@query("st08_incremental", "SELECT event_id FROM events e WHERE NOT EXISTS (SELECT 1 FROM events p WHERE p.event_id = e.event_id AND p.event_type = 'view')")
def st08_incremental(spark, sf_dir):
    from lapwing.operators.joins import new_items

    e = table(spark, sf_dir, "events")
    return new_items(e, e.where("event_type = 'view'"), "event_id", "ts").select("event_id")
