"""Shared plumbing of the pipeline operators: intermediate tables and tables' columns.

Intermediate results that are read more than once are written as Parquet below
``spark.checkpoint.dir`` (the folder that driver and executors share), so a lost
executor costs a re-read and never a recomputation of the whole lineage.
"""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Used only where the session names no shared folder, as in local tests.
LOCAL_SCRATCH = "/tmp/checkpoints"

#: Rows of one Arrow batch handed to a Python worker. Texts are long, so the
#: default of 10,000 rows would make batches of tens or hundreds of MB.
ARROW_ROWS = 256


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, as the session names it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        if not known.isDefined() and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = known.get() if known.isDefined() else LOCAL_SCRATCH
    return base.rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    try:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
    except Exception:  # the session ended first; the folder's owner cleans up
        pass


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, removed when the driver ends."""
    path = f"{scratch_dir(spark)}/rowsmith-{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    schema = df.schema
    df.write.parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out.written_to = path
    return out


def release(*tables: DataFrame | None) -> None:
    """Remove tables that ``materialize`` wrote and nothing will read again, as those of a loop's earlier rounds."""
    for t in tables:
        if t is not None:
            _remove(t.sparkSession, t.written_to)


def release_into(old: DataFrame, new: DataFrame, name: str) -> DataFrame:
    """``new``, which reads ``old``, written; ``old`` is removed."""
    out = materialize(new, name)
    release(old)
    return out


def settle(spark: SparkSession) -> None:
    """Let the driver's JVM give back what earlier stages left: plans, broadcasts, generated classes. Its heap grows
    to the limit otherwise before it is collected, however little is alive."""
    spark._jvm.System.gc()


def _drop(spark: SparkSession, name: str) -> None:
    try:
        spark.sql(f"drop table if exists {name}")
    except Exception:  # the session, and with it the catalog, ended first
        pass


def bucketed(df: DataFrame, key: str, name: str) -> DataFrame:
    """``df``, whose rows are already dealt by ``key``, as a table of the shared folder, bucketed by it:
    each task writes whole buckets, and later joins on ``key`` don't move the rows again."""
    spark = df.sparkSession
    full = f"rowsmith_{name.replace('-', '_')}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", new_path(spark, name)).saveAsTable(full)
    atexit.register(_drop, spark, full)
    return spark.table(full)


def small_batches(spark: SparkSession) -> None:
    """Hand long texts to Python in batches of bounded size."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str | Column) -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast("string")
