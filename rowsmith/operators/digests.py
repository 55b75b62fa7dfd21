"""Diffs against large snapshots that read only what changed since the last time.

A snapshot is kept in buckets of its ids, with a digest of each bucket's records beside it.
A diff keeps, by bucket, the digest of what was desired, the digest of what the snapshot held, and
what differed. The next time, buckets whose two digests are the same keep their
differences; only the others are read and diffed. So an unchanged plan against an
unchanged snapshot reads digests only.

A bucket's digest is the number of its records, and sums and exclusive sums of two 64-bit
hashes of each record's id and sorted fields: it doesn't depend on order, and repeated records count.

Edge cases: a null id is a bucket of its own rows like any other id and matches nothing; null
fields are empty; empty tables have no buckets; fields with null values count as present and null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsmith.operators.changes import field_diff
from rowsmith.sources.lookups import exists

#: Buckets of a snapshot: so many digests at most are compared on the driver.
BUCKETS = 1024
_DIFF = "bucket int, id string, field string, old string, new string"


def bucket_of(ident: str = "id", buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(F.col(ident)), F.lit(buckets)).cast("int")


def bucket_digests(records: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, digest) of records (id, fields map of strings)."""
    entries = F.array_sort(F.map_entries(F.coalesce("fields", F.expr("cast(map() as map<string,string>)"))))
    line = F.to_json(F.struct("id", entries.alias("f")), {"ignoreNullFields": "false"})
    each = records.select(bucket_of(buckets=buckets).alias("bucket"), F.xxhash64(F.lit(1), line).alias("a"), F.xxhash64(F.lit(2), line).alias("b"))
    g = each.groupBy("bucket").agg(F.count("*").alias("n"), F.sum(F.col("a").cast("decimal(38,0)")).alias("s"), F.bit_xor("b").alias("x"))
    return g.select("bucket", F.concat_ws(":", "n", "s", "x").alias("digest"))


def store_snapshot(records: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """A snapshot (id, fields) below ``path``, in folders by bucket, with its digests."""
    path = path.rstrip("/")
    b = records.withColumn("bucket", bucket_of(buckets=buckets))
    b.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/records")
    spark = records.sparkSession
    kept = spark.read.schema("id string, fields map<string,string>, bucket int").parquet(f"{path}/records")
    bucket_digests(kept.select("id", "fields"), buckets).write.mode("overwrite").parquet(f"{path}/digests")


def snapshot_records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("id string, fields map<string,string>, bucket int").parquet(f"{path.rstrip('/')}/records")


def diff_since(desired: DataFrame, snapshot: str, folder: str, buckets: int = BUCKETS) -> DataFrame:
    """(id, field, old, new), as ``field_diff`` of ``desired`` (id, fields) against the snapshot stored at ``snapshot``.

    ``folder`` keeps what this diff found, for the next one; a version counts once its mark is there."""
    spark, folder = desired.sparkSession, folder.rstrip("/")
    want = bucket_digests(desired, buckets).withColumnRenamed("digest", "wanted")
    have = spark.read.parquet(f"{snapshot.rstrip('/')}/digests").withColumnRenamed("digest", "held")
    now = want.join(have, "bucket", "left").withColumn("held", F.coalesce("held", F.lit("")))
    last = _last(spark, folder)
    before = spark.read.parquet(f"{folder}/{last}/digests") if last is not None else spark.createDataFrame([], "bucket int, wanted string, held string")
    state = [r.asDict() for r in now.collect()]  # a row a bucket
    known = {r["bucket"]: (r["wanted"], r["held"]) for r in before.collect()}
    changed = sorted(r["bucket"] for r in state if known.get(r["bucket"]) != (r["wanted"], r["held"]))
    same = sorted(set(r["bucket"] for r in state) - set(changed))
    parts = spark.createDataFrame([], _DIFF)
    if changed:
        mine = desired.where(bucket_of(buckets=buckets).isin(changed)).select("id", "fields")
        held = snapshot_records(spark, snapshot).where(F.col("bucket").isin(changed)).select("id", "fields")
        parts = field_diff(mine, held).select(bucket_of(buckets=buckets).alias("bucket"), "id", "field", "old", "new")
    if same and last is not None:
        parts = parts.unionByName(spark.read.schema(_DIFF).parquet(f"{folder}/{last}/diff").where(F.col("bucket").isin(same)))
    number = 0 if last is None else last + 1
    parts.write.mode("overwrite").parquet(f"{folder}/{number}/diff")
    spark.createDataFrame([(r["bucket"], r["wanted"], r["held"]) for r in state], "bucket int, wanted string, held string").coalesce(1).write.mode("overwrite").parquet(f"{folder}/{number}/digests")
    return spark.read.schema(_DIFF).parquet(f"{folder}/{number}/diff").select("id", "field", "old", "new")


def _last(spark: SparkSession, folder: str) -> int | None:
    """The last finished version: digests are written last."""
    n = 0
    while exists(spark, f"{folder}/{n}/digests/_SUCCESS"):
        n += 1
    return n - 1 if n else None
