"""Sources: tables, documents and binary objects by path.

Paths go to Spark's readers only, so any store that Spark can read will do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CUE_SCHEMA = "start double, end double, text_zh string, text_vi string, center_x double, center_y double"
DETECTION_SCHEMA = "video_id string, detector string, frame bigint, t double, x1 int, y1 int, x2 int, y2 int, score double, text string"
META_SCHEMA = "video_id string, width int, height int, fps double, frames int, duration double"


def objects(spark: SparkSession, path: str) -> DataFrame:
    """``path, size, digest`` of binary objects, without keeping their content."""
    raw = spark.read.format("binaryFile").load(path)
    return raw.select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("digest"))


def existing(wanted: DataFrame, catalog: DataFrame, uri: str = "uri") -> DataFrame:
    """Which addresses a catalog of artifacts holds: cache hits."""
    return wanted.join(catalog.select(uri).distinct().withColumn("hit", F.lit(True)), uri, "left").withColumn("hit", F.coalesce("hit", F.lit(False)))


def json_documents(spark: SparkSession, path: str, schema: T.StructType | str, lines: bool = False) -> DataFrame:
    """JSON documents with an explicit schema, one a file or (``lines``) one a
    line; a byte order mark in front is no error."""
    raw = spark.read.text(path, wholetext=not lines)
    return raw.select(F.from_json(F.regexp_replace("value", "^\ufeff", ""), schema).alias("d")).select("d.*")


def strict_json(texts: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """Parsed documents beside a problem: bad JSON, repeated keys, NaN, or a value
    of another type than the schema's."""
    from lapwing.functions.hashing import canonical

    rows = texts.withColumn("_canonical", canonical(column))
    rows = rows.withColumn("document", F.from_json("_canonical", schema))
    unread = F.exists(F.array(*[F.get_json_object("_canonical", f"$.{f.name}").isNotNull() & F.col(f"document.{f.name}").isNull() for f in schema.fields]), lambda x: x)
    return rows.withColumn("problem", F.when(F.col("_canonical").isNull(), "not_strict").when(unread, "type").otherwise("")).drop("_canonical")


def task_input(batch: DataFrame, index: str, tasks: int) -> DataFrame:
    """One partition a task, dealt by the source index."""
    return batch.repartition(tasks, index)


def cue_override(cues: DataFrame, duration: float) -> DataFrame:
    """Cues held in the clip, texts squeezed, positions in [0, 1], and a problem
    for each that makes the whole file invalid."""
    from pyspark.sql import Window

    from lapwing.functions.text import squeeze

    hold = lambda c, hi: F.greatest(F.lit(0.0), F.least(F.coalesce(F.col(c), F.lit(0.0)), F.lit(hi)))
    rows = cues.withColumns({"start": hold("start", duration), "end": hold("end", duration), "text_vi": squeeze(F.coalesce("text_vi", F.lit("")))})
    before = F.lag("start").over(Window.partitionBy("video_id").orderBy("ord"))
    problem = F.when(F.col("text_vi") == "", "empty").when(F.col("end") <= F.col("start"), "degenerate").when(F.col("start") < before, "unsorted")
    return rows.withColumn("problem", problem.otherwise(""))


def sample_frames(meta: DataFrame, detect_fps: float) -> DataFrame:
    """Every n-th frame of each video, n by the wanted rate."""
    step = F.greatest(F.lit(1), F.bround(F.col("fps") / F.greatest(F.lit(0.1), F.lit(detect_fps))).cast("int"))
    return meta.withColumn("_step", step).select("video_id", F.explode(F.expr("sequence(0, greatest(1, frames) - 1, _step)")).alias("frame"))


def nearest_frames(meta: DataFrame, sample_fps: float) -> DataFrame:
    """Distinct nearest frames at a sample rate, held inside the video."""
    n = F.greatest(F.lit(1), F.ceil(F.col("frames") / F.col("fps") * sample_fps).cast("int"))
    rows = meta.withColumn("_n", n).select("video_id", "fps", "frames", F.explode(F.expr("sequence(0, _n - 1)")).alias("i"))
    frame = F.least(F.col("frames") - 1, F.bround(F.col("i") * F.col("fps") / sample_fps).cast("int"))
    return rows.select("video_id", frame.alias("frame")).distinct()
