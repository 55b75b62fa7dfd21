"""Similarity joins between names without comparing all pairs.

Each join first meets its pairs on keys that every true pair must share, then tests them
exactly. Keys are chosen rare: of a name's words, only the ones that are rarest on both
sides together are looked up where one is enough.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.functions.clubs import close
from rowsmith.functions.text import contains_words, tokens
from rowsmith.plans.tables import written


def _rarest(places: DataFrame, words: DataFrame) -> DataFrame:
    """(id, name, word, n) of (id, name, size, word): for each name its word that stands at the fewest places, n; none if one of its words occurs nowhere."""
    counts = places.groupBy("word").agg(F.count("*").alias("n"))
    best = words.join(counts, "word").groupBy("id", "name", "size").agg(F.count("*").alias("found"), F.min(F.struct("n", "word")).alias("best"))
    return best.where("found = size").select("id", "name", "best.word", "best.n")


def _places(outer: DataFrame, words: DataFrame, cut) -> DataFrame:
    """(id, word) of the outer names' words that some inner name has, too: no others move. ``words`` is written, so its size is known."""
    return outer.select("id", F.explode(cut(F.col("name"))).alias("word")).join(words.select("word").distinct(), "word", "left_semi")


def word_containment(a: DataFrame, b: DataFrame, least_a: int = 1, least_b: int = 1) -> DataFrame:
    """(a, b) ids of single-spaced names (id, name) of which one stands in the other at word edges."""
    a, b = a.where(F.length("name") >= least_a), b.where(F.length("name") >= least_b)

    def inside(outer, inner, o, i):
        return words_contained(outer, inner).select(F.col("outer").alias(o), F.col("inner").alias(i)).select("a", "b")

    return inside(a, b, "a", "b").unionByName(inside(b, a, "b", "a")).distinct()


def words_contained(outer: DataFrame, inner: DataFrame) -> DataFrame:
    """(outer, inner) ids of single-spaced names (id, name) such that the inner one stands in the outer one at word edges.

    Ids meet on the inner name's rarest word; outer names, which may be whole texts, are fetched for the pairs that met."""
    cut = lambda c: F.array_distinct(tokens(c))
    named = inner.withColumn("_words", cut(F.col("name")))
    words = written(named.select("id", "name", F.size("_words").alias("size"), F.explode("_words").alias("word")), "inner-words")
    places = _places(outer, words, cut)
    probe = _rarest(places, words).select(F.col("id").alias("inner"), F.col("name").alias("part"), "word")
    met = places.select(F.col("id").alias("outer"), "word").join(probe, "word").select("outer", "inner", "part")
    return met.join(outer.select(F.col("id").alias("outer"), F.col("name").alias("whole")), "outer").where(contains_words(F.col("whole"), F.col("part"))).select("outer", "inner")


#: Outer or inner names that may have a middle word, at most, for all its pairs to be met.
FEW = 64


def contained(outer: DataFrame, inner: DataFrame, gram: int = 8) -> DataFrame:
    """(outer, inner) ids of names (id, name) such that the inner one is part of the outer one, at any place."""
    side = lambda df, i, n: df.select(F.col("id").alias(i), F.col("name").alias(n))
    met = may_contain(outer, inner, gram).join(side(inner, "inner", "part"), "inner").join(side(outer, "outer", "whole"), "outer")
    return met.where(F.contains("whole", F.col("part"))).select("outer", "inner").distinct()


def may_contain(outer: DataFrame, inner: DataFrame, gram: int = 8) -> DataFrame:
    """(outer, inner) ids among which are all of ``contained``.

    A name of three words or more is met by its middle word that the fewest outer names have: words
    between spaces stand whole wherever the name does. Shorter ones, and those whose rarest middle word is in more than
    ``FEW`` outer names and the rarest of more than ``FEW`` inner ones, are met by the ``gram`` characters of theirs that stand at the fewest places of outer names, which
    are cut at every place only if there are such names: a word in all names brings no pairs together if something else in them is rare."""
    words = lambda c: F.array_distinct(F.filter(F.split(c, " "), lambda w: w != ""))
    parts = F.split("name", " ")
    cut = inner.withColumn("_middle", F.array_distinct(F.filter(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 2, F.lit(0))), lambda w: w != "")))
    long_ = written(cut.where(F.size("_middle") > 0).select("id", "name", F.size("_middle").alias("size"), F.explode("_middle").alias("word")), "middle-words")
    places = _places(outer, long_, words)
    rare = _rarest(places, long_)
    rare = written(rare.join(rare.groupBy("word").agg(F.count("*").alias("m")), "word"), "rare-words")
    # A name shorter than a gram has nothing but its words.
    frequent = (F.col("n") > FEW) & (F.col("m") > FEW) & (F.length("name") >= gram)
    side = lambda df, i: df.select(F.col("id").alias(i), "word")
    met = side(places, "outer").join(side(rare.where(~frequent), "inner"), "word").select("outer", "inner")
    short = cut.where(F.size("_middle") == 0).where(F.length("name") >= gram).select("id", "name").unionByName(rare.where(frequent).select("id", "name"))
    if not short.take(1):
        return met
    at = F.sequence(F.lit(1), F.greatest(F.length("name") - gram + 1, F.lit(1)))
    grams = lambda df: df.select("id", F.explode(F.array_distinct(F.transform(at, lambda p: F.substring(F.col("name"), p, F.lit(gram))))).alias("word"))
    own = written(grams(short), "inner-grams")
    stand = written(_places(outer, own, lambda c: F.array_distinct(F.transform(at, lambda p: F.substring(c, p, F.lit(gram))))), "outer-grams")
    counts = stand.groupBy("word").agg(F.count("*").alias("n"))
    best = own.join(counts, "word", "left").groupBy("id").agg(F.bool_and(F.col("n").isNotNull()).alias("all"), F.min(F.when(F.col("n").isNotNull(), F.struct("n", "word"))).alias("best")).where("all")
    return met.unionByName(side(stand, "outer").join(best.select(F.col("id").alias("inner"), F.col("best.word").alias("word")), "word").select("outer", "inner"))


def substring_containment(a: DataFrame, b: DataFrame, least: int = 8) -> DataFrame:
    """(a, b) ids of names (id, name) of at least ``least`` characters of which one is part of the other."""
    a, b = a.where(F.length("name") >= least), b.where(F.length("name") >= least)
    one = contained(a, b, least).select(F.col("outer").alias("a"), F.col("inner").alias("b"))
    return one.unionByName(contained(b, a, least).select(F.col("inner").alias("a"), F.col("outer").alias("b"))).distinct()


def set_overlap(a: DataFrame, b: DataFrame, percent: int = 80, least: int = 2, once: bool = False) -> DataFrame:
    """(a, b, common) of (id, words) whose common words are at least ``percent`` of the larger set; with ``once``, a < b only.

    Prefix filter: with words in order of rarity, two such sets share one of each one's first
    size - ceil(percent * size) + 1 words, and at the first word that they share enough words are left on
    either side. Words travel as 64-bit hashes, with ids, sizes and places; of a pair that met, the words it shares so
    far and those left behind the last of them bound what it can have in common, so the sets themselves are fetched only
    for pairs that may pass, and tested exactly (words of one hash can only bring more pairs together). Where both
    sides are one frame, its words are counted and cut once."""
    same = a is b
    a, b = a.where(F.size("words") >= least), b.where(F.size("words") >= (least if same else 1))
    spread = lambda df: df.select("id", F.size("words").alias("size"), F.explode(F.transform("words", lambda w: F.xxhash64(w))).alias("w"))
    counts = (spread(a) if same else spread(a).unionByName(spread(b))).groupBy("w").agg(F.count("*").alias("n"))

    def prefix(df: DataFrame) -> DataFrame:
        """(id, size, place, w): the words of each set by which it can be met."""
        keep = F.col("size") - F.ceil(F.col("size") * percent / 100).cast("int") + 1
        first = spread(df).join(counts, "w").groupBy("id", "size").agg(F.collect_list(F.struct("n", "w")).alias("all"))
        rare = F.slice(F.array_sort("all"), F.lit(1), keep)
        return first.select("id", "size", F.posexplode(rare)).select("id", "size", F.col("pos").alias("place"), F.col("col.w").alias("w"))

    mine = written(prefix(a), "prefixes") if same else prefix(a)
    side = lambda df, i: df.select(F.col("id").alias(i), F.col("size").alias(f"n{i}"), F.col("place").alias(f"p{i}"), "w")
    enough = f"100 * least(na, nb, na - pa, nb - pb) >= {percent} * greatest(na, nb)" + (" and a < b" if once else "")
    met = side(mine, "a").join(side(mine if same else prefix(b), "b"), "w").where(enough)
    # All common words up to the last shared prefix word are shared prefix words themselves.
    bound = F.col("m") + F.least(F.col("na") - F.col("last.pa"), F.col("nb") - F.col("last.pb")) - 1
    some = met.groupBy("a", "b", "na", "nb").agg(F.count("*").alias("m"), F.max(F.struct("pa", "pb")).alias("last")).where(100 * bound >= percent * F.greatest("na", "nb")).select("a", "b")
    sets = lambda df, i: df.select(F.col("id").alias(i), F.col("words").alias(f"w{i}"))
    pairs = some.join(sets(a, "a"), "a").join(sets(b, "b"), "b").withColumn("common", F.size(F.array_intersect("wa", "wb")))
    return pairs.where(100 * F.col("common") >= percent * F.greatest(F.size("wa"), F.size("wb"))).select("a", "b", "common")


def equal_sets(sets: DataFrame) -> DataFrame:
    """(id, first, words) of (id, words): each set with the smallest id that has the same words, in whatever order."""
    key = F.array_sort("words")
    digest = F.sha2(F.concat_ws("\u0001", key), 256)  # moves instead of the words; no two sets that occur share it
    named = sets.withColumn("_set", digest)
    return named.join(named.groupBy("_set").agg(F.min("id").alias("first")), "_set").select("id", "first", "words")


def edit_neighbours(a: DataFrame, b: DataFrame) -> DataFrame:
    """(a, b) ids of close names (id, name): one edit apart, two if both have 12 letters or more.

    Of a name cut into three pieces, two edits leave one piece whole, shifted by at most two:
    pieces meet grams of the other name near the same place, then the distance is taken."""
    a, b = a.where(F.length("name") >= 8), b.where(F.length("name") >= 8)
    third = F.floor(F.length("name") / 3).cast("int")
    starts = F.array(F.lit(1), third + 1, 2 * third + 1)
    sizes = F.array(third, third, F.length("name") - 2 * third)
    probe = a.select(F.col("id").alias("a"), F.col("name").alias("na"), F.length("name").alias("la"), F.posexplode(F.zip_with(starts, sizes, lambda s, k: F.struct(s.alias("s"), k.alias("k")))))
    probe = probe.select("a", "na", F.col("la").alias("len"), F.col("pos").alias("piece"), F.expr("substring(na, col.s, col.k)").alias("gram"))
    # For each length that ``a`` may have, the places where each of its pieces may now stand.
    base = b.select(F.col("id").alias("b"), F.col("name").alias("nb"), F.explode(F.transform(F.sequence(F.lit(-2), F.lit(2)), lambda d: F.length("name") + d)).alias("len"))
    base = base.withColumn("t", F.floor(F.col("len") / 3).cast("int")).withColumn("piece", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))).withColumn("shift", F.explode(F.sequence(F.lit(-2), F.lit(2))))
    base = base.withColumn("at", F.col("piece") * F.col("t") + 1 + F.col("shift")).withColumn("k", F.when(F.col("piece") < 2, F.col("t")).otherwise(F.col("len") - 2 * F.col("t"))).where("at >= 1")
    base = base.withColumn("gram", F.expr("substring(nb, at, k)")).where(F.length("gram") == F.col("k")).select("b", "nb", "len", "piece", "gram").distinct()
    return probe.join(base, ["len", "piece", "gram"]).where(close(F.col("na"), F.col("nb"))).select("a", "b").distinct()


def domain_relatives(a: DataFrame, b: DataFrame) -> DataFrame:
    """(a, b, equal) ids of cleaned domains (id, domain) that are equal or of which one is below the other."""
    from rowsmith.functions.clubs import domain_suffixes

    up = a.select(F.col("id").alias("a"), F.col("domain").alias("da"), F.explode(domain_suffixes(F.col("domain"))).alias("key"))
    down = b.where("domain <> ''").select(F.col("id").alias("b"), F.col("domain").alias("key"))
    one = up.join(down, "key").select("a", "b", (F.col("da") == F.col("key")).alias("equal"))
    up2 = b.select(F.col("id").alias("b"), F.col("domain").alias("db"), F.explode(domain_suffixes(F.col("domain"))).alias("key"))
    down2 = a.where("domain <> ''").select(F.col("id").alias("a"), F.col("domain").alias("key"))
    two = up2.join(down2, "key").where("db <> key").select("a", "b", F.lit(False).alias("equal"))
    return one.unionByName(two)
