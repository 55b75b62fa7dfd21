"""Dependent picklists: which values of one field each value of another one permits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_describe(spark: SparkSession, path: str) -> DataFrame:
    """One row: name, fields with their values, of a recorded object description."""
    value = "struct<value:string,active:boolean,validFor:string>"
    schema = f"name string, fields array<struct<name:string,dependentPicklist:boolean,controllerName:string,picklistValues:array<{value}>>>"
    return spark.read.schema(schema).option("multiLine", True).json(path)


def set_bits(bitmap: Column, n: Column) -> Column:
    """Indexes below n of the bits set in a base64 bitmap, first bit highest; a short bitmap has no more bits."""
    digits = F.hex(F.unbase64(F.coalesce(bitmap, F.lit(""))))
    digit = lambda i: F.conv(F.substring(digits, F.floor(i / 4).cast("int") + 1, F.lit(1)), 16, 10).cast("int")
    bit = lambda i: F.shiftright(F.coalesce(digit(i), F.lit(0)), 0).bitwiseAND(F.element_at(F.array(*[F.lit(x) for x in (8, 4, 2, 1)]), i % 4 + 1)) != 0
    return F.filter(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.expr("cast(array() as array<int>)")), bit)


def active_values(values: Column) -> Column:
    return F.transform(F.filter(values, lambda v: F.coalesce(v["active"], F.lit(True))), lambda v: v["value"])


def dependencies(describe: DataFrame, controller: str, dependent: str) -> DataFrame:
    """(control, control_pos, permitted): the active dependent values that each active controlling value permits."""
    pick = lambda name: F.get(F.filter("fields", lambda f: f["name"] == name), F.lit(0))
    d = describe.select("name", pick(controller).alias("c"), pick(dependent).alias("d"))
    fault = (
        F.when(F.col("c").isNull() | F.col("d").isNull(), F.concat(F.lit("no such fields on "), "name"))
        .when(~F.coalesce("d.dependentPicklist", F.lit(False)), F.lit(f"{dependent} is not a dependent picklist"))
        .when(F.coalesce("d.controllerName", F.lit("")) != controller, F.concat(F.lit(f"{dependent} is controlled by "), F.coalesce("d.controllerName", F.lit("nothing"))))
    )
    message = d.select(fault.alias("x")).first()
    if message is None or message[0]:
        raise ValueError(message[0] if message else "empty description")
    controls = d.select(F.posexplode(active_values(F.col("c.picklistValues")))).withColumnRenamed("pos", "control_pos").withColumnRenamed("col", "control")
    n = F.size(active_values(F.col("c.picklistValues")))
    allowed = d.select(n.alias("n"), F.posexplode(F.filter("d.picklistValues", lambda v: F.coalesce(v["active"], F.lit(True)))))
    allowed = allowed.select("pos", F.col("col.value").alias("value"), F.explode(set_bits(F.col("col.validFor"), F.col("n"))).alias("control_pos"))
    lists = allowed.groupBy("control_pos").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda x: x["value"]).alias("permitted"))
    return controls.join(lists, "control_pos", "left").select("control", "control_pos", F.coalesce("permitted", F.expr("cast(array() as array<string>)")).alias("permitted"))


def write_dependencies(deps: DataFrame, path: str) -> None:
    """The mapping as JSON, in the controlling field's order."""
    deps.repartition(1).sortWithinPartitions("control_pos").write.mode("overwrite").json(path)


def read_dependencies(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("control string, control_pos int, permitted array<string>").json(path)
