"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL_SCRATCH = "/tmp/checkpoints"


def scratch_dir(spark: SparkSession) -> str:
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
    except Exception:  # the session ended first
        pass


def new_path(spark: SparkSession, name: str, suffix: str = "") -> str:
    """A fresh path below the shared folder, removed when the driver ends."""
    path = f"{scratch_dir(spark)}/rowsmith-{name}-{uuid.uuid4().hex}{suffix}"
    atexit.register(_remove, spark, path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table: cuts lineage in loops and survives lost executors."""
    spark, schema = df.sparkSession, df.schema
    path = new_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out.written_to = path
    return out


def release(*tables: DataFrame) -> None:
    """Remove tables that ``written`` made and nothing will read again, as those of a loop's earlier rounds."""
    for t in tables:
        _remove(t.sparkSession, t.written_to)


def text_file(lines: DataFrame, name: str, suffix: str = ".csv", parts: bool = False) -> str:
    """The rows of (pos, line) as text in order; its path. One file, or with ``parts`` a folder of files in the order of their names."""
    path = new_path(lines.sparkSession, name, suffix)
    dealt = lines.repartitionByRange("pos") if parts else lines.repartition(1)
    dealt.sortWithinPartitions("pos").select("line").write.option("lineSep", "\n").text(path)
    return path
