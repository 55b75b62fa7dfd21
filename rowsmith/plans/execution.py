"""A plan carried out in a live system, level by level, with a journal that a restart goes on from.

The journal is a folder of the shared store. It holds the plan as it was confirmed, and for
each step (the four levels, then values that only stick once a record is there, then
accounts' role lookups) what is to be done, decided from what the target holds when the step begins, and
what became of it, with a manifest. A step's decisions are written down before the first call.

Killed anywhere and run again with the same journal, finished parts are read instead of
done again; the unfinished step sends its written decisions once more. Creating is idempotent by
reference key and updating by its values, so the end state and the log equal those of a run that wasn't interrupted.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsmith.operators import changes
from rowsmith.operators.plan import ORDER
from rowsmith.sources import target as T
from rowsmith.sources.lookups import exists

#: Steps after the four levels.
LATE, ROLES = "late-values", "role-lookups"
_LOG = ["plan_pos", "ref_key", "sobject", "label", "outcome", "id", "reason"]


def _kept(spark: SparkSession, path: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table at ``path``, made and written only if it isn't complete."""
    if not exists(spark, f"{path}/_SUCCESS"):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _done(spark: SparkSession, path: str, records: DataFrame, target: T.Target, tasks: int) -> DataFrame:
    """What became of ``records``: as written down, or after sending them."""
    if exists(spark, f"{path}/{T.MANIFEST}"):
        return T.outcomes_of(spark, path)
    return T.sent(records, target, path, tasks)


def _known(plan: DataFrame, held: DataFrame) -> DataFrame:
    """The plan, with the ids of records that the target holds under their reference keys already."""
    ids = held.where("ref_key <> ''").groupBy("ref_key").agg(F.min("id").alias("_held"))
    p = plan.join(ids, "ref_key", "left")
    return p.withColumn("sf_id", F.when(F.coalesce("sf_id", F.lit("")) != "", F.col("sf_id")).otherwise(F.coalesce("_held", F.lit("")))).drop("_held")


def plan_fields(plan: DataFrame) -> dict[str, list[str]]:
    """By object the fields that a plan's records may fill: as many as the objects have, whatever the plan's size."""
    keys = F.concat(F.map_keys("fields"), F.map_keys("parents"), F.map_keys("deferred"))
    out: dict[str, list[str]] = {level: [] for level in ORDER}
    for r in plan.select("sobject", F.explode(keys).alias("k")).distinct().orderBy("sobject", "k").collect():
        out[r["sobject"]].append(r["k"])
    # Matching of contacts and duplicates reads these, planned or not.
    return out | {"contact": sorted({*out["contact"], "email", "account_id", "phone"})}


def execute(
    plan: DataFrame, target: T.Target, journal: str, confirm: Callable[[DataFrame], bool] = lambda changes: True, tasks: int = 8,
    read: Callable[[str], DataFrame] | None = None, after: Callable[[str], None] = lambda step: None,
) -> tuple[DataFrame, DataFrame] | None:
    """(log, failures), or None if not confirmed. The log is ``apply_plan``'s: plan_pos, ref_key, sobject, label, outcome, id, reason.

    failures: (step, plan_pos, id, reason, error) of records, and of later updates of records, that the target refused or that
    took another way than planned. read: what the target holds of an object (id, fields, ref_key), by default
    through the tool. tasks: calls at a time. after: told of each step that is finished."""
    spark, journal = plan.sparkSession, journal.rstrip("/")
    names = plan_fields(plan)
    read = read or (lambda level: T.snapshot(spark, target, level, names[level]))
    if not exists(spark, f"{journal}/plan/_SUCCESS"):
        if not confirm(changes.changeset(plan, {level: read(level).drop("ref_key") for level in ORDER})):
            return None
        plan.write.mode("overwrite").parquet(f"{journal}/plan")
    plan = spark.read.parquet(f"{journal}/plan")
    log, failures = None, None

    def note(step: str, rows: DataFrame) -> None:
        nonlocal failures
        part = rows.where("reason is not null").select(F.lit(step).alias("step"), "plan_pos", "id", "reason", "error")
        failures = part if failures is None else failures.unionByName(part)

    for level in ORDER:
        def decide(level=level, log=log) -> DataFrame:
            held = _kept(spark, f"{journal}/{level}/held", lambda: read(level))
            return changes.decided(_known(plan, held), level, held.drop("ref_key"), log)

        wanted = _kept(spark, f"{journal}/{level}/wanted", decide)
        calls = wanted.where("outcome in ('created', 'updated')")
        # A record that the plan names but the target lacks is updated, too: the target refuses, and says so.
        old = (F.col("outcome") == "updated") | F.col("named")
        calls = calls.withColumns({"fields": F.when(F.col("outcome") == "updated", F.col("diff")).otherwise(F.col("want")), "outcome": F.when(old, "updated").otherwise("created"), "id": F.when(old, F.col("id")).otherwise("")})
        made = _done(spark, f"{journal}/{level}/outcomes", calls, target, tasks)
        note(level, made)
        part = made.select(_LOG).unionByName(wanted.where("outcome not in ('created', 'updated')").select(_LOG))
        log = part if log is None else log.unionByName(part)
        after(level)
    described = plan.select("plan_pos", "ref_key", "sobject", "label", F.lit("updated").alias("outcome"))
    for step, rows in ((LATE, lambda: changes.follow_ups(plan, log)), (ROLES, lambda: changes.role_lookups(plan, log))):
        wanted = _kept(spark, f"{journal}/{step}/wanted", lambda rows=rows: rows().join(described, "plan_pos"))
        note(step, _done(spark, f"{journal}/{step}/outcomes", wanted, target, tasks))
        after(step)
    return log, failures
