"""Matching of deals as they arrive: each micro-batch's leagues go through the league matcher against a pool of candidates.

``match_arriving`` matches each batch by itself. ``match_in_order`` gives, after every batch, what matching all deals
so far in one go gives: ids are claimed across batches, in the order of leagues, and a league's later rows add to
what is known of it. Results are one folder per batch, written whole, so a batch that is run again after a failure replaces its own result
and nothing is counted twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rowsmith import config as C
from rowsmith.functions.geo import territory_countries
from rowsmith.operators import match
from rowsmith.operators.entities import group_entities
from rowsmith.plans.tables import written
from rowsmith.sources.lookups import exists

#: What is kept from batch to batch: leagues with what is known of them, and what each pass found for them.
STATE = ("leagues", "trusted", "strong", "options")
RESULT = ["league_key", "display_name", "n_rows", "match_status", "match_type", "confidence", "account_ids"]


def leagues_of(deals: DataFrame) -> DataFrame:
    """The leagues of a batch of deals (src_pos, league, ...) as the matcher takes them."""
    empty = F.expr("cast(array() as array<string>)")
    return group_entities(deals).select(F.col("first_pos").alias("league_pos"), "league_key", "display_name", empty.alias("countries"), F.lit("").alias("pasted_id"), "n_rows")


def match_arriving(deals: DataFrame, pool: DataFrame, out: str, checkpoint: str, names: C.Names | None = None) -> StreamingQuery:
    """Start matching the leagues of arriving ``deals`` against ``pool``; batches so far, then stop. Results are below ``out``, by batch."""

    def each(batch: DataFrame, number: int) -> None:
        found = match.crosscheck(leagues_of(batch), pool, names)
        found.select("league_key", "display_name", "n_rows", "match_status", "match_type", "confidence", "account_ids").write.mode("overwrite").parquet(f"{out}/batch={number}")

    return deals.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def known_leagues(deals: DataFrame) -> DataFrame:
    """The leagues of deals (src_pos, league; territory and account_ref if there are such columns) with all that matching reads."""
    g = group_entities(deals)
    empty = F.expr("cast(array() as array<string>)")
    where = F.array_sort(F.array_distinct(F.flatten(F.transform("territorys", territory_countries)))) if "territorys" in g.columns else empty
    pasted = F.col("pasted_id") if "pasted_id" in g.columns else F.lit("")
    return g.select("league_key", F.col("first_pos").alias("league_pos"), "display_name", "n_rows", where.alias("countries"), pasted.alias("pasted_id"))


def merged(old: DataFrame, new: DataFrame) -> DataFrame:
    """Leagues of ``old`` with what rows of ``new`` add, and whether that can change their match; old_pos is where they were."""
    o, n = old.select("league_key", F.struct("*").alias("o")), new.select("league_key", F.struct("*").alias("n"))
    j = o.join(n, "league_key", "full")
    both, later = F.col("o").isNotNull() & F.col("n").isNotNull(), F.col("n.league_pos") < F.col("o.league_pos")
    first = F.when(both & ~later, F.col("o")).when(both, F.col("n")).otherwise(F.coalesce("o", "n"))
    other = F.when(both & ~later, F.col("n")).when(both, F.col("o"))
    empty = F.expr("cast(array() as array<string>)")
    out = j.select(
        "league_key", first["league_pos"].alias("league_pos"), first["display_name"].alias("display_name"), (first["n_rows"] + F.coalesce(other["n_rows"], F.lit(0))).alias("n_rows"),
        F.array_sort(F.array_union(first["countries"], F.coalesce(other["countries"], empty))).alias("countries"),
        F.when(first["pasted_id"] != "", first["pasted_id"]).otherwise(F.coalesce(other["pasted_id"], F.lit(""))).alias("pasted_id"), F.col("o"),
    )
    same = F.col("o").isNotNull()
    for c in ("league_pos", "display_name", "countries", "pasted_id"):
        same = same & (F.col(c) == F.col(f"o.{c}"))
    return out.withColumn("changed", ~F.coalesce(same, F.lit(False))).withColumn("old_pos", F.col("o.league_pos")).drop("o")


def _version(spark: SparkSession, out: str, number: int) -> str | None:
    """The state after the last finished batch before ``number``."""
    for n in range(number - 1, -1, -1):
        if exists(spark, f"{out}/state/{n}/_done"):
            return f"{out}/state/{n}"
    return None


def _remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def step(batch: DataFrame, number: int, pool: DataFrame, out: str, names: C.Names | None = None, manual: DataFrame | None = None, aliases: DataFrame | None = None) -> None:
    """Batch ``number``: only leagues that it brings or changes go through the passes; who claims what is settled over all.

    State and results of a batch are written below its number, and count once its mark is there; the state before stays until the
    next batch is done, so a batch that stopped half-way starts over from where it started."""
    spark = batch.sparkSession
    cands = written(match.candidates(pool), "candidates")
    before = _version(spark, out, number)
    new = written(known_leagues(batch), "arrived")
    old = {t: spark.read.parquet(f"{before}/{t}") for t in STATE} if before else None
    known = old["leagues"] if old else new.limit(0)
    now = written(merged(known, new), "known")
    leagues = now.drop("changed", "old_pos")
    changed = now.where("changed")
    fresh = match.found_by_name(changed.drop("changed", "old_pos"), cands, names or C.Names(), manual, aliases)
    gone = changed.where("old_pos is not null").select(F.col("old_pos").alias("league_pos"))
    tables = {"leagues": leagues}
    for name, found in zip(STATE[1:], fresh, strict=True):
        tables[name] = old[name].join(gone, "league_pos", "left_anti").unionByName(found) if old else found
    here = f"{out}/state/{number}"
    kept = {}
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{here}/{name}")
        kept[name] = spark.read.schema(df.schema).parquet(f"{here}/{name}")
    match.decided(kept["leagues"], cands, kept["trusted"], kept["strong"], kept["options"]).select(RESULT).write.mode("overwrite").parquet(f"{out}/results/{number}")
    spark.createDataFrame([(number,)], "batch long").coalesce(1).write.mode("overwrite").parquet(f"{here}/_done")
    for n in range(max(0, number - 3), number - 1):
        _remove(spark, f"{out}/state/{n}")


def results(spark: SparkSession, out: str) -> DataFrame:
    """The match of each league over all deals so far."""
    last = _version(spark, out, 1 + max([int(r["n"]) for r in _numbers(spark, out)], default=-1))
    if last is None:
        raise FileNotFoundError(f"{out}: no batch is done")
    return spark.read.parquet(f"{out}/results/{last.rsplit('/', 1)[1]}")


def _numbers(spark: SparkSession, out: str) -> list[dict]:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/state")
    files = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return [{"n": s.getPath().getName()} for s in files.listStatus(p)] if files.exists(p) else []


def match_in_order(deals: DataFrame, pool: DataFrame, out: str, checkpoint: str, names: C.Names | None = None, manual: DataFrame | None = None, aliases: DataFrame | None = None) -> StreamingQuery:
    """Start matching arriving ``deals`` with claims kept across batches; batches so far, then stop. See ``results``."""
    return deals.writeStream.foreachBatch(lambda batch, n: step(batch, n, pool, out, names, manual, aliases)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
