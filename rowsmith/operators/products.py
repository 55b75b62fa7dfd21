"""Free-text products to price-book entries, tiers, and splitting an amount over products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsmith import config as C
from rowsmith.functions.text import strip, text
from rowsmith.operators.entities import first_by, first_wins


def product_tokens(cell: Column) -> Column:
    """The products named in a cell, cleaned of prefixes, notes and hedging words."""
    s = F.regexp_replace(F.regexp_replace(F.regexp_replace(strip(cell), r"[\n\r]+", " "), r"(?U)\s+-\s+", "-"), r"(?U)^\s*\+\s*", "")
    parts = F.split(s, r"(?iU)\s*[,/&]\s*|\s+&\s+|\s+and\s+")

    def clean(t: Column) -> Column:
        t = strip(t)
        t = F.when(F.contains(t, F.lit(":")), strip(F.regexp_replace(t, r"(?s)^[^:]*:", ""))).otherwise(t)
        t = strip(F.regexp_replace(t, r"(?U)\s*\([^)]*\)\s*$", ""))
        t = strip(F.regexp_replace(t, r"(?iU)^\s*(?:could be|maybe|potentially|probably|likely|possibly)\s+", ""))
        return strip(F.regexp_replace(t, r"(?U)[.;:,\s]+$", ""))

    return F.filter(F.transform(parts, clean), lambda t: t != "")


def word_heads(value: Column) -> Column:
    """All beginnings of a text that a space follows."""
    words = F.split(value, " ")
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - 1, F.lit(1))), lambda n: F.when(F.size(words) > 1, F.array_join(F.slice(words, F.lit(1), n), " ")))


def heads(value: Column, lengths: list[int]) -> Column:
    """The beginnings of a text of these lengths, as far as it is that long."""
    if not lengths:
        return F.expr("cast(array() as array<string>)")
    return F.array_compact(F.array(*[F.when(F.length(value) >= n, F.left(value, F.lit(n))) for n in sorted(set(lengths))]))


def top_tier(book: DataFrame, prefixes: DataFrame, noise: str, ties: str = "src_pos") -> DataFrame:
    """Book rows with ``prefix``: for each prefix the dearest product that isn't a noise variant, else the dearest; the first on ties.
    Products meet prefixes by the beginnings of their names of the lengths that prefixes have."""
    p = prefixes.select("prefix").distinct().withColumn("_head", F.lower("prefix"))
    lengths = [r["n"] for r in p.select(F.length("_head").alias("n")).distinct().collect()]  # a few: prefixes are names of families
    j = book.withColumn("_head", F.explode(heads(F.lower("product"), lengths))).join(p, "_head").drop("_head")
    rest = F.trim(F.expr("substring(product, length(prefix) + 1)"))
    j = j.withColumn("noisy", rest.rlike(noise))
    return first_by(j, ["prefix"], [F.col("noisy"), F.col("list_price").desc(), F.col(ties)]).drop("noisy")


def family_products(book: DataFrame, conf: C.Products) -> DataFrame:
    """(target, sport, product_pos): what each family target means for each sport, '' being any sport.

    Tiers: a product of just that name; for the sport family, the league-wide credits of the sport, any
    league-wide product of it, any product of it; for other families the top tier. A few hundred rows at most."""
    spark = book.sparkSession
    goals = sorted({*conf.aliases.values(), *conf.features.values(), *conf.families, conf.fallback_family} - {""})
    sports = sorted({*conf.sports.values(), conf.default_sport} - {""})
    targets = spark.createDataFrame([(g,) for g in goals], "target string")
    b = first_wins(book, ["product"]).withColumn("low", F.lower("product"))
    named = targets.join(b, F.lower("target") == F.col("low")).select("target", F.lit("").alias("sport"), F.lit(0).alias("tier"), F.col("src_pos").alias("product_pos"))
    own = b.where(F.startswith("low", F.lit(conf.sport_family.lower()))) if conf.sport_family else b.limit(0)
    j = own.withColumn("sport", F.explode(F.filter(F.array(*[F.lit(x) for x in sports]), lambda x: F.contains(F.col("low"), F.lower(x))))) if sports else own.withColumn("sport", F.lit("")).limit(0)
    wide = F.contains("low", F.lit("league wide"))
    tier = F.when(F.col("low") == F.concat(F.lit(conf.sport_family.lower() + " "), F.lower("sport"), F.lit(" credits for league wide usage")), 1).when(wide, 2).otherwise(3)
    by_sport = j.select(F.lit(conf.sport_family).alias("target"), "sport", tier.alias("tier"), F.col("src_pos").alias("product_pos"))
    others = targets.where(F.col("target") != conf.sport_family).select(F.col("target").alias("prefix"))
    tops = top_tier(b, others, conf.noise).select(F.col("prefix").alias("target"), F.lit("").alias("sport"), F.lit(4).alias("tier"), F.col("src_pos").alias("product_pos"))
    every = named.unionByName(by_sport).unionByName(tops)
    return first_by(every, ["target", "sport"], [F.col("tier"), F.col("product_pos")]).select("target", "sport", "tier", "product_pos")


def resolve_cells(cells: DataFrame, book: DataFrame, conf: C.Products | None = None) -> DataFrame:
    """One row per token of (key, cell, sport): key, token_pos, token, product_pos (null if unresolved), note, duplicate.

    A token is looked up as a product name, a feature, an alias, an alias prefix (in dictionary order),
    a family prefix; the first that leads to a product decides."""
    conf = conf or C.Products()
    spark = cells.sparkSession
    pairs = lambda d, names: spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(d.items())], names) if d else spark.createDataFrame([], names)
    t = cells.select("key", text(F.col("sport")).alias("cell_sport"), F.posexplode(product_tokens(F.col("cell")))).withColumnRenamed("pos", "token_pos").withColumnRenamed("col", "token").withColumn("low", F.lower("token"))
    sport_map = F.create_map(*[F.lit(x) for kv in (conf.sports or {"": conf.default_sport}).items() for x in kv])
    sport_key = F.lower(F.regexp_replace(strip(F.col("cell_sport")), r"(?sU)\s*[/|\-]\s*.*$", ""))
    t = t.withColumn("sport", F.coalesce(sport_map[sport_key], F.lit(conf.default_sport)))
    fam = family_products(book, conf)
    named = first_wins(book, ["product"]).groupBy(F.lower("product").alias("low")).agg(F.min("src_pos").alias("product_pos"))
    feature, alias = pairs(conf.features, "low string, target string, dict_pos int"), pairs(conf.aliases, "alias string, target string, dict_pos int")
    family = pairs({f: f for f in conf.families}, "alias string, target string, dict_pos int").withColumn("head", F.lower("alias"))
    base = t.select("key", "token_pos", "low", "sport")
    step = lambda df, n: df.select("key", "token_pos", "sport", "target", F.lit(n).alias("step"))
    exact_alias = base.join(alias, F.col("low") == F.col("alias"))
    # Beginnings of tokens meet dictionaries by equality: those that a space follows aliases, those of the families' lengths families.
    rest = base.join(exact_alias.select("key", "token_pos"), ["key", "token_pos"], "left_anti")
    prefix = first_by(rest.withColumn("head", F.explode(F.array_distinct(F.array_compact(word_heads(F.col("low")))))).join(alias, F.col("head") == F.col("alias")), ["key", "token_pos"], [F.col("dict_pos")])
    fam_prefix = base.withColumn("head", F.explode(heads(F.col("low"), [len(f.lower()) for f in conf.families]))).join(family, "head")
    lookups = step(base.join(feature, "low"), 2).unionByName(step(exact_alias, 3)).unionByName(step(prefix, 3))
    lookups = lookups.unionByName(fam_prefix.select("key", "token_pos", "sport", "target", (F.lit(4) + F.col("dict_pos")).alias("step")))
    fam = fam.select("target", F.col("sport").alias("fs"), "tier", "product_pos")
    led = lookups.join(fam, ["target"]).where((F.col("fs") == "") | (F.col("fs") == F.col("sport")))
    led = first_by(led, ["key", "token_pos", "step"], [F.col("tier")]).select("key", "token_pos", "step", "product_pos")
    direct = base.join(named, "low").select("key", "token_pos", F.lit(1).alias("step"), "product_pos")
    best = first_by(direct.unionByName(led), ["key", "token_pos"], [F.col("step")])
    note = F.when(F.col("step") == 1, "exact").when(F.col("step") == 2, "feature-mapped").when(F.col("step").isNotNull(), "family-highest-tier").otherwise("unresolved")
    out = t.join(best, ["key", "token_pos"], "left").withColumn("note", note)
    again = F.row_number().over(Window.partitionBy("key", "product_pos").orderBy("token_pos")) > 1
    return out.select("key", "token_pos", "token", "product_pos", "note", (again & F.col("product_pos").isNotNull()).alias("duplicate"), "step")


def resolved_products(resolved: DataFrame, book: DataFrame) -> DataFrame:
    """Product lines of each key in token order: key, line, product and its columns."""
    lines = resolved.where("product_pos is not null and not duplicate").join(book.withColumnRenamed("src_pos", "product_pos"), "product_pos")
    return lines.withColumn("line", F.row_number().over(Window.partitionBy("key").orderBy("token_pos")))


def with_fallback(lines: DataFrame, keys: DataFrame, book: DataFrame, conf: C.Products | None = None) -> DataFrame:
    """Lines, and for keys with an amount but no line the top product of the fallback family."""
    conf = conf or C.Products()
    if not conf.fallback_family:
        return lines
    spark = book.sparkSession
    top = top_tier(first_wins(book, ["product"]), spark.createDataFrame([(conf.fallback_family,)], "prefix string"), conf.noise).drop("prefix").withColumnRenamed("src_pos", "product_pos")
    bare = keys.where("total_arr > 0").join(lines.select("key").distinct(), "key", "left_anti").select("key")
    extra = bare.withColumn("_one", F.lit(1)).join(F.broadcast(top.limit(1).withColumn("_one", F.lit(1))), "_one").drop("_one").withColumns({"token_pos": F.lit(0), "token": F.lit(""), "note": F.lit("fallback"), "duplicate": F.lit(False), "step": F.lit(9), "line": F.lit(1)})
    return lines.unionByName(extra.select(*lines.columns))


def allocate(lines: DataFrame, total: str, price: str = "list_price", key: str = "key") -> DataFrame:
    """Lines with their share of the key's total: all to a single line, by price, or equally if all prices are 0."""
    w = Window.partitionBy(key)
    n, prices = F.count("*").over(w), F.sum(price).over(w)
    share = F.when(n == 1, F.col(total)).when(prices == 0, F.col(total) / n).otherwise(F.col(price) / prices * F.col(total))
    return lines.withColumn("allocated", share)


def priced(lines: DataFrame, book: DataFrame, name: str = "product_name") -> DataFrame:
    """Lines joined to the price book by exact name, else in lower case; the last entry of a name counts."""
    from rowsmith.operators.entities import last_wins

    exact = last_wins(book, ["product"])
    low = last_wins(book.withColumn("low", F.lower("product")), ["low"])
    cols = [c for c in book.columns]
    a = exact.select(*[F.col(c).alias(f"e_{c}") for c in cols])
    b = low.select(*[F.col(c).alias(f"l_{c}") for c in cols], "low")
    j = lines.join(a, F.col(name) == F.col("e_product"), "left").join(b, F.lower(F.col(name)) == F.col("low"), "left")
    pick = lambda c: F.when(F.col("e_product").isNotNull(), F.col(f"e_{c}")).otherwise(F.col(f"l_{c}"))
    return j.select(*lines.columns, *[pick(c).alias(f"book_{c}") for c in cols])


def unit_price(mode: str, product: str = "book_product", price: str = "book_list_price", discounts: dict[str, float] | None = None) -> Column:
    """A line's price: free, at list, or from the discount table, where a missing product is an error."""
    if mode == "free":
        return F.lit(0.0)
    if mode == "list":
        return F.col(price)
    if mode != "discount":
        raise ValueError(f"unknown pricing mode {mode!r}")
    found = F.create_map(*[F.lit(x) for kv in (discounts or {}).items() for x in kv])[F.col(product)] if discounts else F.lit(None).cast("double")
    return F.when(F.col(product).isNull() | found.isNotNull(), found).otherwise(F.raise_error(F.concat(F.lit("no discount price for "), F.col(product))).cast("double"))
