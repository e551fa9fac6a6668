"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Environment variable that moves the tokenizer vocabularies.
TOKENIZER_DIR_DEFAULT = "/opt/tokenizers"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and every executor see.

    ``spark.checkpoint.dir`` names it.  Only in a local session, whose executors
    are the driver, may it be unset: a temporary folder is then made and remembered
    in the session.  On a cluster that is an error.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        where = spark.conf.get("lapwing.shared.dir", None)
    if not where and not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not where:
        where = tempfile.mkdtemp(prefix="lapwing-shared-")
        spark.conf.set("lapwing.shared.dir", where)
    return where.rstrip("/")


#: Has Spark delete an execution's shuffle files at its end, not when the driver
#: happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Folders that this driver has written.
_written: list[str] = []


@atexit.register
def _drop_local() -> None:
    for path in _written:
        local = path.removeprefix("file://")
        if os.path.isabs(local):
            shutil.rmtree(local, ignore_errors=True)


def drop_materialized(spark: SparkSession) -> None:
    """Delete what :func:`materialize` has written; DataFrames that read it end."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(conf).delete(path, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table.

    It cuts lineage: a lost executor costs a re-read, never a recomputation of
    what came before, and several passes over the result cost one computation.
    The shuffle files of the computation go when it is written.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lapwing/{label}-{uuid.uuid4().hex}"
    _written.append(path)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id written as text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(folds)


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def tokenizer_path(name: str) -> str:
    """Place of a vocabulary file, on the driver or on an executor."""
    try:
        import public_tokenizers

        return public_tokenizers.path(name)
    except ImportError:
        return os.path.join(TOKENIZER_DIR_DEFAULT, name)


#: Values that :func:`slot` has: the bound of what :func:`parted` broadcasts.
SLOTS = 1 << 20


def slot(*columns: Column) -> Column:
    """A hash of the columns, one of ``SLOTS`` values."""
    return F.pmod(F.xxhash64(*columns), F.lit(SLOTS)).cast("int")


def parted(rows: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``_slot`` no key has, and the others; without a shuffle.

    Only the keys' slots are broadcast, at most ``SLOTS`` whole numbers.  Where the
    keys are few among the rows, what must then be shuffled to meet them is little
    more than what does meet them; where they are many, it is everything, as in a
    plain join."""
    taken = F.broadcast(keys.select("_slot").distinct())
    return rows.join(taken, "_slot", "left_anti"), rows.join(taken, "_slot", "left_semi")


def other_columns(df: DataFrame, *names: str) -> list[int]:
    """Places of the columns that are not called like ``names``, in whatever case:
    Spark does not tell such names apart."""
    taken = {n.lower() for n in names}
    return [i for i, c in enumerate(df.columns) if c.lower() not in taken]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores as make it differ from all columns."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def batches_of(
    rows: Iterator, max_rows: int = 2000, max_cost: int = 8 << 20
) -> Iterator[list]:
    """Group ``(cost, row)`` pairs so that no group outgrows a few megabytes."""
    group: list = []
    cost = 0
    for c, row in rows:
        group.append(row)
        cost += c
        if len(group) >= max_rows or cost >= max_cost:
            yield group
            group, cost = [], 0
    if group:
        yield group


#: Rows that Spark sends a Python worker at a time.  Texts are long: the default
#: of 10,000 rows holds tens of megabytes on either side of the socket.
ARROW_ROWS = 500


def small_batches(df: DataFrame) -> DataFrame:
    """Have the session send smaller batches to Python, if it sends larger ones."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= ARROW_ROWS:
        conf.set(key, str(ARROW_ROWS))
    return df


def give_back() -> None:
    """Return a worker's freed memory to the system; workers outlive their tasks."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
