"""Connected components, and graphs of claims cut into parts that can be gone through independently."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.plans.tables import release, written

#: Rows that one task goes through in sequence at most.
IN_TASK = 200_000


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes of ``edges`` (a, b): the smallest node that can be reached.

    Each round hangs every node's larger neighbours, then its smaller ones, on the smallest neighbour, which shortens
    paths by a constant factor. Neighbours are never gathered: their minimum is joined back."""
    both = lambda e: e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        near = both(now)
        least = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # Larger neighbours of a node go to the smallest of all its neighbours and itself.
        large = near.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        # A node and its smaller neighbours go to the smallest of these.
        small = large.join(lower, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(lower.select("a", F.col("m").alias("b"))).distinct()
        after = written(small, "edges")
        same = after.count() == now.count() and not after.exceptAll(now).take(1)
        release(now)
        now = after
        if same:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def parts(rows: DataFrame, claimer: str, ident: str, most: int = IN_TASK) -> tuple[DataFrame | None, DataFrame | None]:
    """(rows of small parts with _part, rows of large parts): claimers that share an ``ident`` (not empty) are in one part,
    directly or through others. A part of at most ``most`` rows is small; if all rows are no more, they are one part."""
    if rows.count() <= most:
        return rows.withColumn("_part", F.lit("")), None
    first = rows.groupBy(claimer).agg(F.min(F.when(F.col(ident) != "", F.col(ident))).alias("_m"))
    known = written(rows.join(first, claimer), "claims")
    found = components(known.where(F.col("_m").isNotNull() & (F.col(ident) != "")).select(F.col("_m").alias("a"), F.col(ident).alias("b")))
    part = F.coalesce("component", "_m", F.concat(F.lit("\u0001"), F.col(claimer).cast("string")))
    named = written(known.join(found.withColumnRenamed("node", "_m"), "_m", "left").withColumn("_part", part).drop("component", "_m"), "claims")
    release(known)
    big = written(named.groupBy("_part").agg(F.count("*").alias("_n")).where(F.col("_n") > most).select("_part"), "large-parts")
    if not big.take(1):
        return named, None
    return named.join(big, "_part", "left_anti"), named.join(big, "_part", "left_semi").drop("_part")


def in_order(rows: DataFrame, claimer: str, order: list[str], decide: Callable[[int, list[dict], set[str]], Iterator[dict]], schema: pa.Schema) -> DataFrame:
    """Go through each part of ``rows`` claimer by claimer. ``decide(claimer, its rows in order, taken)`` gives result rows and adds
    to ``taken``, the ids taken in this part. A task holds one claimer's rows and one part's taken ids."""
    wanted = [c for c in rows.columns if c != "_part"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, who, mine, taken = None, None, [], set()
        out: list[dict] = []
        for batch in batches:
            names = batch.column("_part").to_pylist()
            for p, row in zip(names, batch.select(wanted).to_pylist(), strict=True):
                if p != part or row[claimer] != who:
                    if mine:
                        out += decide(who, mine, taken)
                    if p != part:
                        taken = set()
                    part, who, mine = p, row[claimer], []
                mine.append(row)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if mine:
            out += decide(who, mine, taken)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    kinds = {pa.int64(): "long", pa.string(): "string", pa.float64(): "double", pa.int32(): "int"}
    ddl = ", ".join(f"`{f.name}` {kinds[f.type]}" for f in schema)
    return rows.repartition("_part").sortWithinPartitions("_part", claimer, *order).mapInArrow(run, ddl)
