"""Incremental grouping: files of deals that arrive over time, grouped as ``entities.group_entities`` does in one go.

The batch library reads every sheet whole; this is the same grouping for a folder that
keeps receiving exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsmith.functions.text import normalise_league

SCHEMA = T.StructType([T.StructField("src_pos", T.LongType()), T.StructField("league", T.StringType()), T.StructField("period", T.StringType()), T.StructField("arr_eur", T.DoubleType()), T.StructField("submitted", T.TimestampType())])


#: With what else matching reads of a deal.
WIDE = T.StructType([*SCHEMA.fields, T.StructField("territory", T.StringType()), T.StructField("account_ref", T.StringType())])


def arriving(spark: SparkSession, folder: str, files_per_batch: int = 100, schema: T.StructType = SCHEMA) -> DataFrame:
    """Deals of Parquet files as they arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def totals(deals: DataFrame, late: str = "30 days", window: str = "7 days") -> DataFrame:
    """Count and amount by league, period and submission window; rows later than ``late`` are dropped by the watermark."""
    keyed = deals.withColumn("league_key", normalise_league(F.col("league"))).withWatermark("submitted", late)
    by = ["league_key", "period", F.window("submitted", window).alias("submitted_in")]
    return keyed.groupBy(*by).agg(F.count("*").alias("n_rows"), F.sum("arr_eur").alias("total_arr"), F.min("src_pos").alias("first_pos"))
