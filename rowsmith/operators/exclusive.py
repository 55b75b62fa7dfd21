"""Exclusive assignment in order: each claimer, in turn, takes its best option that is still free."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsmith.operators.components import IN_TASK, in_order, parts
from rowsmith.plans.tables import release, written


def exclusive(options: DataFrame, taken: DataFrame | None = None, most: int = IN_TASK) -> DataFrame:
    """(claimer, id): the outcome of going through claimers in ascending order, each taking its
    lowest-ranked free option of ``options`` (claimer, rank, id); ids in ``taken`` (id) are never free.

    Claimers that share no id, directly or through others, don't affect each other: such parts of up to ``most`` rows are
    gone through in sequence, many to a task. In larger parts a claimer whose best open option no earlier claimer
    wants, as a first or a later choice, has it for good; rounds settle all of these at once, and once half of the rows are
    gone what is left is cut into parts again. Only a chain of claims that is itself longer than ``most`` takes a round a link."""
    best = Window.partitionBy("claimer", "id")
    rows = options.where(F.col("id") != "").withColumn("_first", F.min("rank").over(best)).where(F.col("rank") == F.col("_first")).select("claimer", "rank", "id").distinct()
    if taken is not None:
        rows = rows.join(taken.select("id").distinct(), "id", "left_anti")
    left = written(rows.select("claimer", "rank", "id"), "options")
    kind = left.schema["claimer"].dataType
    schema = pa.schema([("claimer", pa.string() if isinstance(kind, T.StringType) else pa.int64()), ("id", pa.string())])

    def take(claimer, mine, gone):
        for row in mine:
            if row["id"] not in gone:
                gone.add(row["id"])
                yield {"claimer": claimer, "id": row["id"]}
                return

    done = None
    while True:
        small, large = parts(left, "claimer", "id", most)
        found = in_order(small, "claimer", ["rank", "id"], take, schema).select(F.col("claimer").cast(kind).alias("claimer"), "id")
        done = found if done is None else done.unionByName(found)
        if large is None:
            return done
        left = written(large.select("claimer", "rank", "id"), "options")
        before = left.count()
        while True:
            wants = left.groupBy("claimer").agg(F.min_by("id", F.struct("rank", "id")).alias("id"))
            first = left.groupBy("id").agg(F.min("claimer").alias("claimer"))
            settled = written(wants.join(first, ["claimer", "id"]), "settled")
            done = done.unionByName(settled)
            rest = written(left.join(settled.select("claimer"), "claimer", "left_anti").join(settled.select("id"), "id", "left_anti"), "options")
            release(left)
            left, now = rest, rest.count()
            if not now:
                return done
            if 2 * now <= before:
                break
