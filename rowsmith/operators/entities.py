"""Grouping rows into entities and merging pools, with input order kept by position columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsmith.functions.text import normalise_league, strip, text


def ordered_distinct(value: Column, pos: Column, keep: Column | None = None) -> Column:
    """Aggregate: distinct non-empty values in order of first position. Partial results are merged on the map side."""
    good = (text(value) != "") if keep is None else keep
    pairs = F.array_sort(F.collect_list(F.when(good, F.struct(pos.alias("p"), value.alias("v")))))
    return F.array_distinct(F.transform(pairs, lambda x: x["v"]))


def first_nonblank(value: Column, pos: Column) -> Column:
    """Aggregate: the first value in order that isn't blank, or empty."""
    return F.coalesce(F.min_by(F.when(strip(value) != "", strip(value)), F.when(strip(value) != "", pos)), F.lit(""))


def group_entities(rows: DataFrame, by: list[str] = (), name: str = "league", pos: str = "src_pos") -> DataFrame:
    """One row per normalised name (and further columns ``by``), with what its rows say.

    The rows stay as they are in ``rows``, keyed by league_key: a popular name never becomes one wide row."""
    keyed = with_key(rows, name)
    p = F.col(pos)
    distinct = ["sport", "rep_name", "territory"]
    some = [c for c in distinct if c in rows.columns]
    out = keyed.groupBy("league_key", *by).agg(
        F.min(p).alias("first_pos"), F.min_by(name, p).alias("display_name"), F.count("*").alias("n_rows"),
        *([F.sum("arr_eur").alias("total_arr")] if "arr_eur" in rows.columns else []),
        *[ordered_distinct(F.col(c), p).alias(f"{c}s") for c in some],
        *([first_nonblank(F.col("account_ref"), p).alias("pasted_id")] if "account_ref" in rows.columns else []),
    )
    return out.withColumn("primary_sport", F.coalesce(F.get("sports", F.lit(0)), F.lit(""))) if "sport" in some else out


def with_key(rows: DataFrame, name: str = "league") -> DataFrame:
    return rows.withColumn("league_key", normalise_league(F.col(name)))


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def first_wins(df: DataFrame, keys: list[str], pos: str = "src_pos") -> DataFrame:
    return first_by(df, keys, [F.col(pos)])


def last_wins(df: DataFrame, keys: list[str], pos: str = "src_pos") -> DataFrame:
    return first_by(df, keys, [F.col(pos).desc()])


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def priority_union(first: DataFrame, second: DataFrame, ident: str = "id", name: str = "name", pos: str = "src_pos") -> DataFrame:
    """Rows of both pools, one per id (or per name where there is no id); the earlier pool and row win."""
    both = first.withColumn("_rank", F.lit(0)).unionByName(second.withColumn("_rank", F.lit(1)), allowMissingColumns=True)
    key = F.when(text(F.col(ident)) != "", F.concat(F.lit("id:"), F.col(ident))).otherwise(F.concat(F.lit("name:"), F.lower(F.trim(text(F.col(name))))))
    out = first_by(both.withColumn("_key", key), ["_key"], [F.col("_rank"), F.col(pos)])
    return out.withColumnRenamed("_rank", "pool").drop("_key")


def unambiguous(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with exactly one distinct value."""
    return df.where((F.col(key) != "") & F.col(value).isNotNull()).groupBy(key).agg(F.min(value).alias(value), F.max(value).alias("_other")).where(F.col(value) == F.col("_other")).drop("_other")


def attach_ids(pool: DataFrame, names: DataFrame, name: str = "name", ident: str = "other_id") -> DataFrame:
    """Missing ids filled by raw name in lower case, else by normalised name, where a name has just one id.

    ``names``: (name, id)."""
    raw = unambiguous(names.select(F.lower(strip(F.col("name"))).alias("raw"), "id"), "raw", "id").withColumnRenamed("id", "by_raw")
    norm = unambiguous(names.select(normalise_league(F.col("name")).alias("norm"), "id"), "norm", "id").withColumnRenamed("id", "by_norm")
    out = pool.withColumn("raw", F.lower(strip(F.col(name)))).withColumn("norm", normalise_league(F.col(name)))
    out = out.join(raw, "raw", "left").join(norm, "norm", "left")
    filled = F.when(text(F.col(ident)) != "", F.col(ident)).otherwise(F.coalesce("by_raw", "by_norm", F.lit("")))
    return out.withColumn(ident, filled).drop("raw", "norm", "by_raw", "by_norm")


def propagate(results: DataFrame, finer: DataFrame, key: str = "league_key") -> DataFrame:
    """Results per name carried to finer groups of the same name."""
    keep = [c for c in results.columns if c == key or c not in finer.columns]
    return finer.join(results.select(*keep), key, "left")


def missing_fields(rows: DataFrame) -> DataFrame:
    """One row per input row that lacks what a deal needs, with the names of what is missing."""
    blank = lambda c: F.when(strip(F.col(c)) == "", F.lit(c))
    lacks = F.array_compact(F.array(blank("product"), blank("sport"), blank("deal_type"), F.when(F.coalesce(F.col("arr_eur"), F.lit(0.0)) <= 0, F.lit("arr_eur"))))
    return rows.select("src_pos", "league", lacks.alias("missing")).where(F.size("missing") > 0)


def status_counts(results: DataFrame) -> DataFrame:
    """Counts of matched (with and without id), ambiguous and unmatched entities."""
    is_ = lambda s: F.col("match_status") == s
    return results.agg(
        F.count_if(is_("matched")).alias("matched"), F.count_if(is_("matched") & (F.size("account_ids") > 0)).alias("matched_with_id"),
        F.count_if(is_("ambiguous")).alias("ambiguous"), F.count_if(is_("unmatched")).alias("unmatched"),
    )


def most_frequent(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """The most frequent value of each group; ties go to the smallest."""
    n = df.groupBy(*by, value).agg(F.count("*").alias("_n"))
    return n.groupBy(*by).agg(F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(value))


def resolve_people(rows: DataFrame, users: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """(rep_name, user_id, status): names looked up in passes; the first pass with a hit decides.

    Passes: exact, case-insensitive, first name, substring either way for four letters or
    more. One hit resolves, several are ambiguous. An alias (alias, name) replaces all
    passes and must hit exactly one user. Each pass is an equi-join but the last, which
    joins on shared three-letter grams before the exact test."""
    reps = rows.select("rep_name").where(F.col("rep_name") != "").distinct().withColumn("low", F.lower("rep_name"))
    people = users.select(F.col("id").alias("user_id"), F.col("name").alias("user_name"), F.lower("name").alias("user_low"), "src_pos")
    alias = None
    if aliases is not None:
        alias = reps.join(aliases.withColumnRenamed("alias", "rep_name"), "rep_name").select("rep_name", F.col("name").alias("canonical"))
        reps_free = reps.join(alias, "rep_name", "left_anti")
    else:
        reps_free = reps
    first = people.withColumn("first_names", F.filter(F.transform(F.sequence(F.lit(1), F.size(F.split("user_low", " "))), lambda i: F.array_join(F.slice(F.split("user_low", " "), 1, i), " ")), lambda x: x != F.col("user_low")))
    hit = lambda df, n: df.select("rep_name", "user_id", "user_name", F.lit(n).alias("pass"))
    grams = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 3, F.lit(1))), lambda i: F.substring(c, i, F.lit(4))))
    short = F.least(F.length("low"), F.length("user_low"))
    a = reps_free.where(F.length("low") >= 4).withColumn("gram", F.explode(grams(F.col("low"))))
    b = people.where(F.length("user_low") >= 4).withColumn("gram", F.explode(grams(F.col("user_low"))))
    loose = a.join(b, "gram").where((F.contains("user_low", F.col("low")) | F.contains("low", F.col("user_low"))) & (short >= 4)).dropDuplicates(["rep_name", "user_id", "user_name"])
    tiny = reps_free.where(F.length("low") >= 4).withColumn("piece", F.explode(F.flatten(F.transform(F.array(F.lit(1), F.lit(2), F.lit(3)), lambda k: F.transform(F.sequence(F.lit(1), F.length("low") - k + 1), lambda i: F.substring(F.col("low"), i, k))))))
    tiny = tiny.join(people.where(F.length("user_low").between(1, 3)), F.col("piece") == F.col("user_low")).dropDuplicates(["rep_name", "user_id", "user_name"])
    hits = (
        hit(reps_free.join(people, F.col("rep_name") == F.col("user_name")), 1)
        .unionByName(hit(reps_free.join(people, F.col("low") == F.col("user_low")), 2))
        .unionByName(hit(reps_free.join(first.withColumn("f", F.explode("first_names")), F.col("low") == F.col("f")), 3))
        .unionByName(hit(loose, 4)).unionByName(hit(tiny, 4))
    )
    decided = hits.groupBy("rep_name", "pass").agg(F.count("*").alias("n"), F.min("user_id").alias("user_id"), F.min("user_name").alias("user_name"))
    decided = decided.groupBy("rep_name").agg(F.min_by(F.struct("n", "user_id", "user_name"), "pass").alias("r"))
    status = F.when(F.col("r.n") == 1, "matched").when(F.col("r.n") > 1, "ambiguous").otherwise("unmatched")
    out = reps_free.join(decided, "rep_name", "left").select("rep_name", F.when(F.col("r.n") == 1, F.col("r.user_id")).alias("user_id"), F.when(F.col("r.n") == 1, F.col("r.user_name")).alias("user_name"), status.alias("status"))
    if alias is not None:
        exact = people.groupBy("user_name").agg(F.count("*").alias("n"), F.min("user_id").alias("user_id"))
        named = alias.join(exact, alias["canonical"] == exact["user_name"], "left")
        one = F.col("n") == 1
        out = out.unionByName(named.select("rep_name", F.when(one, F.col("user_id")).alias("user_id"), F.when(one, F.col("canonical")).alias("user_name"), F.when(one, "matched").otherwise("unmatched").alias("status")))
    return out


def people_counts(rows: DataFrame, resolved: DataFrame) -> DataFrame:
    """Counts of rows, not names, by how their person was resolved."""
    s = F.coalesce(F.col("status"), F.lit("unmatched"))
    return rows.join(resolved.select("rep_name", "status"), "rep_name", "left").agg(*[F.count_if(s == k).alias(k) for k in ("matched", "ambiguous", "unmatched")])
