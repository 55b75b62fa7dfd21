"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule w(t), t from 0 to 1, linear in time with mean
``weight``: w(t) = weight * (1 + slope * (2t - 1)). The share of a source's words
that training has asked for by time t is the integral of its schedule,
D(t) = t * (1 - slope) + slope * t**2. A copy of a document whose words begin at
fraction c of its source's demand is due at the t with D(t) = c, which has a
closed form. Sorting all copies by t gives the training order.

Targets: sources in order of code point, null last, weigh 1, 2, 3, 1, 2, 3, ...
and share all words; a target stops at ``cap`` times its source's size, and the
excess goes to the others by weight until none is above (min(cap * size, level *
weight) with one level for all).

Inside a source, documents stand in the order of a hash of their id. If the target
is q times the source's size, each document is taken floor(q) times, and the first
ones in that order once more until the target is met; the document at the boundary
gives only the words still missing, so each source meets its target to the word.

Cumulative sizes are sums over hash buckets followed by sums inside a bucket, so no
task ever holds a whole source; only one row per source and one per source and
bucket is ever gathered by key.

Edge cases: null text counts 0 words; a null source is a source of its own, last;
rows with a null doc_id are ordered by a hash of their text; repeated rows are rows like others, told apart by
their order of arrival in the bucket, so as a set the result is the same in every
run; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WEIGHTS = (1, 2, 3)
CAP = 3
#: Buckets of a source's hash order; a bucket of the largest source should fit one task.
BUCKET_HEX = 3
#: Slopes of the weight schedules, by place of the source, repeating: early, even, late.
SLOPES = (-0.5, 0.0, 0.5)


def n_words(text: str = "text") -> Column:
    """Number of maximal runs of characters other than 0x20 and 0x09-0x0D."""
    squeezed = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[^\x20\x09-\x0D]+", "w")
    return F.length(F.regexp_replace(squeezed, r"[\x20\x09-\x0D]+", "")).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Of one row per source (source, source_size) the place, weight and target of each.

    With sources in order of size / weight, the first k of them are at their cap where
    the level left for the others exceeds cap * size / weight; one sorted pass finds k.
    One row per source is the only thing gathered here."""
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    pick = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    s = sizes.withColumn("place", F.row_number().over(by_name) - 1).withColumn("weight", pick.cast("long"))
    rising = Window.orderBy(F.col("source_size") / F.col("weight"), "place")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    s = s.withColumn("total", F.sum("source_size").over(every))
    s = s.withColumn("full", F.coalesce(F.sum("source_size").over(before), F.lit(0)) * cap)
    s = s.withColumn("open", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    s = s.withColumn("level", (F.col("total") - F.col("full")) / F.col("open"))
    # The level that holds: that of the first source, in this order, which it leaves below its cap.
    fits = F.col("level") * F.col("weight") <= F.col("source_size") * cap
    s = s.withColumn("held", F.min(F.when(fits, F.struct(F.col("source_size") / F.col("weight"), F.col("place"), F.col("level")))).over(every).getField("level"))
    goal = F.when(F.col("held").isNull(), (F.col("source_size") * cap).cast("double")).otherwise(F.least((F.col("source_size") * cap).cast("double"), F.col("held") * F.col("weight")))
    return s.select("source", "place", "weight", "source_size", goal.alias("target"))


def due(share: Column, slope: Column) -> Column:
    """The time t at which a schedule of this slope has asked for ``share`` of its words."""
    lean = F.lit(1.0) - slope
    root = F.sqrt(lean * lean + F.lit(4.0) * slope * share)
    return F.when(F.abs(slope) < 1e-12, share).otherwise((root - lean) / (F.lit(2.0) * slope))


def _taken(docs: DataFrame, weights: tuple[int, ...], cap: int, slopes: tuple[float, ...], row: Column | None = None) -> DataFrame:
    """Per row of ``docs`` what is taken of it, and below, goal and slope: what its copies' positions follow from. ``row`` names rows, as _key."""
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce(F.col("text"), F.lit("")))))
    rows = docs.select("doc_id", "source", n_words().alias("size"), key.alias("h"), *([] if row is None else [row.alias("_key")])).withColumn("bucket", F.substring("h", 1, BUCKET_HEX))
    totals = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    goals = targets(totals.groupBy("source").agg(F.sum("words").alias("source_size")), weights, cap)
    so_far = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.withColumn("base", F.coalesce(F.sum("words").over(so_far), F.lit(0))).select(F.col("source").alias("s"), F.col("bucket").alias("b"), "base")
    goals = goals.select(F.col("source").alias("g"), "place", "source_size", "target")
    starts = starts.join(goals, F.col("s").eqNullSafe(F.col("g"))).drop("g")
    inside = Window.partitionBy("source", "bucket").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("below", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    rows = rows.withColumn("below", F.col("below") + F.col("base"))
    goal = F.round("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0).cast("long")
    left = goal - whole * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), left - F.col("below"))).cast("long")
    rows = rows.withColumn("taken", whole * F.col("size") + part).withColumn("copies", whole.cast("int") + (part > 0).cast("int"))
    slope = F.element_at(F.array(*[F.lit(float(x)) for x in slopes]), (F.col("place") % len(slopes) + 1).cast("int"))
    return rows.select("doc_id", "size", "source_size", "target", "taken", "copies", "below", goal.alias("goal"), slope.alias("slope"), *([] if row is None else ["_key"]))


def _position(copy: Column) -> Column:
    """When copy number ``copy``, from 0, of a row of ``_taken`` is due: a source's copies of one number come after all of the one before."""
    share = F.when(F.col("goal") > 0, (F.col("below") + copy * F.col("source_size")) / F.col("goal"))
    return due(F.least(share, F.lit(1.0)), F.col("slope"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, slopes: tuple[float, ...] = SLOPES) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, source): doc_id, size, source_size, target, taken, copies, position, last_position.

    copies counts whole and started copies; position and last_position are the times at
    which the first and the last copy are due (null when the document isn't taken; each
    copy between them is due after its source's words of one more turn). Rows come in order of position."""
    at = lambda copy: F.when(F.col("taken") > 0, _position(copy))
    out = _taken(docs, weights, cap, slopes).select("doc_id", "size", "source_size", "target", "taken", "copies", at(F.lit(0)).alias("position"), at(F.col("copies") - 1).alias("last_position"))
    return out.repartitionByRange(F.col("position").asc_nulls_last(), F.col("doc_id")).sortWithinPartitions(F.col("position").asc_nulls_last(), "doc_id")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as documents in training order, each as often as its words are taken, each copy at its own time.

    Copies are whole documents: a boundary document is repeated for its started copy
    only if at least half of it is taken. Columns are those of ``docs``."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), F.md5(F.col(c).cast("string"))), F.lit("-"))
    key = F.md5(F.concat_ws(",", part("doc_id"), part("text"), part("source")))
    # Rows that agree in id, text and source are numbered, on both sides: each of the plan's belongs to one of the documents'.
    each = lambda order: F.row_number().over(Window.partitionBy("_key").orderBy(order))
    plan = _taken(docs, WEIGHTS, CAP, SLOPES, key).where("size > 0").withColumn("_times", F.floor(F.col("taken") / F.col("size") + 0.5).cast("int"))
    plan = plan.withColumn("_n", each(F.col("below"))).where("_times > 0")
    plan = plan.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_times") - 1)))
    plan = plan.select("_key", "_n", "_copy", _position(F.col("_copy")).alias("_position"))
    rows = docs.select(F.struct("*").alias("_row"), key.alias("_key"))  # columns of any name
    rows = rows.withColumn("_n", each(F.xxhash64("_row")))
    out = rows.join(plan, ["_key", "_n"])
    out = out.repartitionByRange("_position", "_key", "_n", "_copy").sortWithinPartitions("_position", "_key", "_n", "_copy")
    return out.select("_row.*")


SQL = """
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size,
         md5(coalesce(doc_id::varchar, md5(coalesce(text, '')))) as h
  from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
p as (select *, row_number() over (order by source is null, source collate "C") - 1 as place from s),
w as (select *, (place % 3 + 1)::bigint as weight, sum(source_size) over ()::bigint as total from p),
l as (
  select *, (total - 3 * coalesce(sum(source_size) over r, 0))::double
            / (sum(weight) over () - coalesce(sum(weight) over r, 0))::double as level
  from w window r as (order by source_size::double / weight, place rows between unbounded preceding and 1 preceding)),
v as (select arg_min(level, (source_size::double / weight, place)) as held from l where level * weight <= 3 * source_size),
g as (
  select source, source_size, place,
         case when held is null then (3 * source_size)::double else least((3 * source_size)::double, held * weight) end as target
  from l, v),
c as (
  select doc_id, size, source_size, target, round(target)::bigint as goal, [-0.5, 0.0, 0.5][(place % 3 + 1)::int]::double as slope,
         coalesce(sum(size) over (partition by d.source order by h, doc_id, size rows between unbounded preceding and 1 preceding), 0)::bigint as below
  from d join g on d.source is not distinct from g.source),
q as (select *, case when source_size > 0 then goal // source_size else 0 end as whole from c),
k as (
  select *, greatest(0, least(size, goal - whole * source_size - below))::bigint as part,
         least(below::double / goal, 1.0::double) as early
  from q),
t as (
  select *, (whole * size + part)::bigint as taken, (whole + (part > 0)::int)::int as copies from k),
z as (
  select *, least((below + (copies - 1)::bigint * source_size)::double / goal, 1.0::double) as late from t)
select doc_id, size, source_size, target, taken, copies,
       case when taken > 0 then case when slope = 0 then early else (sqrt((1 - slope) * (1 - slope) + 4 * slope * early) - (1 - slope)) / (2 * slope) end end as position,
       case when taken > 0 then case when slope = 0 then late else (sqrt((1 - slope) * (1 - slope) + 4 * slope * late) - (1 - slope)) / (2 * slope) end end as last_position
from z
"""
