"""The club matcher: domains, keyed passes, and three fallbacks; clubs and rows left over; decisions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsmith import config as C
from rowsmith.functions.clubs import clean_domain, normalise_club, prefix_first
from rowsmith.functions.text import acronym, acronym_safe, paren, significant_words, strip, text
from rowsmith.operators.blocking import domain_relatives, edit_neighbours, set_overlap, substring_containment
from rowsmith.operators.entities import first_by, last_wins
from rowsmith.plans.tables import written


def match(truth: DataFrame, rows: DataFrame, normaliser: Callable[[Column], Column] = normalise_club, names: C.Names | None = None) -> DataFrame:
    """(truth_pos, truth_name, row_pos, row_id, row_name, match_type, pass): hits in order, each row id at its first pass.

    truth: src_pos, name, domain; rows: src_pos, id, name, domain. Rows without an id share one place per club."""
    names = names or C.Names()
    t = truth.select(F.col("src_pos").alias("truth_pos"), strip(F.col("name")).alias("truth_name"), clean_domain(F.col("domain")).alias("truth_domain")).where("truth_name <> ''")
    t = written(t.withColumn("norm", normaliser(F.col("truth_name"))), "clubs")
    r = rows.select(F.col("src_pos").alias("row_pos"), text(F.col("id")).alias("row_id"), strip(F.col("name")).alias("row_name"), clean_domain(F.col("domain")).alias("row_domain")).where("row_name <> ''")
    r = written(r.withColumn("row_norm", normaliser(F.col("row_name"))), "club-rows")

    near = domain_relatives(t.select(F.col("truth_pos").alias("id"), F.col("truth_domain").alias("domain")), r.select(F.col("row_pos").alias("id"), F.col("row_domain").alias("domain")))
    # Names of one domain stand together, in order of the domain's first row.
    dom = r.where("row_domain <> ''").groupBy("row_domain").agg(F.min("row_pos").alias("dom_pos"))
    by_domain = near.select(F.col("a").alias("truth_pos"), F.col("b").alias("row_pos"), F.when(F.col("equal"), 0.0).otherwise(0.5).alias("pass"), F.lit("exact_domain").alias("match_type"))
    by_domain = by_domain.join(r.select("row_pos", "row_domain"), "row_pos").join(dom, "row_domain").select("truth_pos", "row_pos", "pass", "match_type", F.col("dom_pos").alias("order"))

    name, norm = F.col("row_name"), F.col("row_norm")
    key = lambda kind, v, ok=None: F.struct(F.lit(kind).alias("kind"), (v if ok is None else F.when(ok, v)).alias("key"))
    keys = r.select("row_pos", F.inline(F.array(key("exact", name), key("norm", norm), key("prefix", prefix_first(norm)), key("acr", acronym(name, 1)), key("paren", normaliser(paren(name)), F.length(paren(name)) > 6)))).where("key is not null and (key <> '' or kind in ('norm', 'prefix'))")
    probe = lambda n, m, kind, v: F.struct(F.lit(n).alias("pass"), F.lit(m).alias("match_type"), F.lit(kind).alias("kind"), v.alias("key"), F.lit(False).alias("guarded"))
    probes = t.select("truth_pos", F.inline(F.array(probe(1.0, "exact", "exact", F.col("truth_name")), probe(2.0, "normalised", "norm", F.col("norm")), probe(3.0, "prefix_canon", "prefix", prefix_first(F.col("norm"))), probe(6.0, "parenthetical", "paren", F.col("norm")))))
    if names.club_aliases:
        known = F.create_map(*[x for k, v in names.club_aliases.items() for x in (F.lit(k), F.array(*[F.lit(a) for a in v]))])
        other = t.select("truth_pos", F.posexplode(known[F.col("truth_name")])).withColumnRenamed("col", "alias")
        for kind, value, k in (("exact", F.col("alias"), 0), ("norm", normaliser(F.col("alias")), 1)):
            probes = probes.unionByName(other.select("truth_pos", (F.lit(4.0) + (2 * F.col("pos") + k) / 1000.0).alias("pass"), F.lit("alias").alias("match_type"), F.lit(kind).alias("kind"), value.alias("key"), F.lit(False).alias("guarded")))
    if names.club_acronyms:
        known = F.create_map(*[F.lit(x) for kv in names.club_acronyms.items() for x in kv])
        spelled = t.withColumn("acr", F.coalesce(known[F.col("norm")], known[F.lower("truth_name")])).where("acr is not null")
        for k, (kind, value) in enumerate((("acr", F.lower("acr")), ("exact", F.col("acr")), ("exact", F.upper("acr")), ("exact", F.lower("acr")))):
            probes = probes.unionByName(spelled.select("truth_pos", F.lit(5.0 + k / 10).alias("pass"), F.lit("acronym").alias("match_type"), F.lit(kind).alias("kind"), value.alias("key"), F.lit(True).alias("guarded")))
    hits = probes.join(keys, ["kind", "key"])
    if names.club_acronyms:
        stop = [*C.CLUB_STOPWORDS, *names.stopwords]
        hits = hits.join(t.select("truth_pos", F.col("norm").alias("tn"), F.lower(F.coalesce(known[F.col("norm")], known[F.lower("truth_name")])).alias("ta")), "truth_pos").join(r.select("row_pos", "row_name", "row_norm"), "row_pos")
        safe = acronym_safe(F.col("row_name"), F.col("row_norm"), significant_words(F.col("tn"), stop), stop) | (F.col("row_norm") == F.col("ta"))
        hits = hits.where(~F.col("guarded") | safe)
    strong = written(by_domain.unionByName(hits.select("truth_pos", "row_pos", "pass", "match_type", F.col("row_pos").alias("order"))), "club-strong")

    # Fallbacks, each for clubs that nothing has matched so far.
    keyed = r.groupBy("row_norm").agg(F.min("row_pos").alias("key_pos"))
    kn = keyed.select(F.col("key_pos").alias("id"), F.col("row_norm").alias("name"))
    left = t.join(strong.select("truth_pos").distinct(), "truth_pos", "left_anti").select(F.col("truth_pos").alias("id"), F.col("norm").alias("name"))
    words = lambda d: d.select("id", significant_words(F.col("name"), [*C.CLUB_STOPWORDS, *names.stopwords]).alias("words"))
    tag = lambda d, n, m: d.select(F.col("a").alias("truth_pos"), F.col("b").alias("key_pos"), F.lit(n).alias("pass"), F.lit(m).alias("match_type"))
    loose = tag(substring_containment(left, kn), 7.0, "containment").unionByName(tag(set_overlap(words(left), words(kn), 80, 2), 8.0, "fuzzy_overlap")).unionByName(tag(edit_neighbours(left, kn), 9.0, "fuzzy_overlap"))
    each = Window.partitionBy("truth_pos")
    loose = loose.withColumn("p", F.min("pass").over(each)).where("pass = p").withColumn("k", F.min("key_pos").over(each)).where("pass = 8.0 or key_pos = k")
    loose = loose.join(keyed, "key_pos").join(r.select("row_norm", "row_pos"), "row_norm").select("truth_pos", "row_pos", "pass", "match_type", F.col("key_pos").alias("order"))
    found = strong.unionByName(loose).join(r.select("row_pos", "row_id", "row_name"), "row_pos").join(t.select("truth_pos", "truth_name"), "truth_pos")
    return first_by(found, ["truth_pos", "row_id"], [F.col("pass"), F.col("order"), F.col("row_pos")]).select("truth_pos", "truth_name", "row_pos", "row_id", "row_name", "match_type", "pass", "order")


def by_name(matches: DataFrame) -> DataFrame:
    """Matches of the last club of each name."""
    last = matches.groupBy("truth_name").agg(F.max("truth_pos").alias("truth_pos"))
    return matches.join(last, ["truth_name", "truth_pos"])


def unmatched(truth: DataFrame, matches: DataFrame) -> DataFrame:
    return truth.where(strip(F.col("name")) != "").join(matches.select(F.col("truth_pos").alias("src_pos")).distinct(), "src_pos", "left_anti")


def orphans(rows: DataFrame, matches: DataFrame) -> DataFrame:
    """Rows with an id that no club has matched."""
    seen = matches.select(F.col("row_id").alias("id")).distinct()
    return rows.where(text(F.col("id")) != "").join(seen, "id", "left_anti")


def ranked(matches: DataFrame, active: str = "active") -> DataFrame:
    """Matches with their rank in their club: by type, then by how active the row is."""
    score = F.create_map(*[F.lit(x) for kv in C.CLUB_SCORES.items() for x in kv])[F.col("match_type")]
    n = F.coalesce(F.col(active).cast("string").try_cast("double"), F.lit(0.0))
    w = Window.partitionBy("truth_pos").orderBy(score.desc(), n.desc(), "pass", "order", "row_pos")
    return matches.withColumn("rank", F.row_number().over(w))


def account_decision(matches: DataFrame) -> DataFrame:
    """(truth_name, account_id, review): an exact name hit, else a single hit, else several ids to review."""
    rank = F.struct("pass", "order", "row_pos")
    g = by_name(matches).groupBy("truth_name").agg(
        F.count("*").alias("n"), F.min_by(F.when(F.col("match_type") == "exact", F.col("row_id")), F.when(F.col("match_type") == "exact", rank)).alias("exact"),
        F.min_by("row_id", rank).alias("one"), F.transform(F.array_sort(F.collect_list(F.struct(rank.alias("k"), F.col("row_id").alias("v")))), lambda x: x["v"]).alias("ids"),
    )
    decided = F.when(F.col("exact").isNotNull(), F.col("exact")).when(F.col("n") == 1, F.col("one"))
    return g.select("truth_name", F.coalesce(decided, F.lit("")).alias("account_id"), F.when(decided.isNull(), F.col("ids")).otherwise(F.expr("cast(array() as array<string>)")).alias("review"))


def known_elsewhere(clubs: DataFrame, decisions: DataFrame, other_rows: DataFrame, normaliser=normalise_club, names: C.Names | None = None) -> DataFrame:
    """Clubs without account and pinned id that another system's rows match: to be left out of an import."""
    open_ = clubs.where(text(F.col("pinned_id")) == "").join(decisions.where("account_id <> ''").select(F.col("truth_name").alias("name")), "name", "left_anti")
    found = match(open_, other_rows, normaliser, names)
    return open_.join(found.select(F.col("truth_pos").alias("src_pos")).distinct(), "src_pos", "left_semi")


def tier_rows(matches: DataFrame, tier: str) -> DataFrame:
    """Review rows of one tier; matched ones need an id."""
    rows = matches.where(F.col("tier") == tier)
    return rows.where(text(F.col("row_id")) != "") if tier == "matched" else rows


last_by_name = last_wins
