"""The league matcher: keyed passes, weak passes, scores, decisions.

All strong passes are one equi-join: candidates carry every key they can be found by,
leagues every key they look up, each with the number of its pass. A candidate id counts
for a league at its first pass. Leagues without any hit try containment and then word
overlap, with ids claimed by earlier leagues out of reach, exactly as if leagues were gone through one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsmith import config as C
from rowsmith.functions.amounts import confidence, match_source
from rowsmith.functions.geo import country_signal
from rowsmith.functions.text import acronym, acronym_safe, core, division, initials, junk_reason, normalise_league, overlap_ratio, paren, significant_words, spaceless, strip_sport_division, text, token_run, trailing_acronym
from rowsmith.operators.blocking import set_overlap, word_containment
from rowsmith.operators.components import IN_TASK, in_order, parts
from rowsmith.operators.entities import first_by, last_wins
from rowsmith.plans.tables import release, written

WEAK = ("containment", "fuzzy_overlap")
_CANDIDATE = ["cand_pos", "account_id", "other_id", "name", "country", "deals", "accounts", "active_arr"]


def candidates(df: DataFrame) -> DataFrame:
    """The columns that matching reads, canonical: nulls empty, counts 0."""
    have = set(df.columns)
    col = lambda c: text(F.col(c)) if c in have else F.lit("")
    num = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0)) if c in have else F.lit(0).cast("long")
    return df.select(F.col("src_pos").alias("cand_pos"), col("id").alias("account_id"), col("other_id").alias("other_id"), col("name").alias("name"), col("country").alias("country"), num("deals").alias("deals"), num("accounts").alias("accounts"), col("active_arr").alias("active_arr")).withColumn("norm", normalise_league(F.col("name")))


def candidate_keys(cands: DataFrame) -> DataFrame:
    """(kind, key, cand_pos): every key by which a candidate that isn't junk can be found."""
    name, norm = F.col("name"), F.col("norm")
    c, acr, par = core(norm), acronym(name), paren(name)
    key = lambda kind, value, ok=None: F.struct(F.lit(kind).alias("kind"), (value if ok is None else F.when(ok, value)).alias("key"))
    keys = F.array(
        key("exact", name), key("norm", norm), key("core", c, F.length(c) >= 3), key("core_ns", spaceless(c), (F.length(c) >= 3) & (F.length(spaceless(c)) >= 5)),
        key("acr", acr), key("acr_ns", spaceless(normalise_league(acr)), acr != ""), key("paren", normalise_league(par), F.length(par) > 6),
        key("initials", initials(name), F.length(initials(name)) >= 3),
    )
    real = cands.where(junk_reason(name).isNull())
    return real.select("cand_pos", F.inline(keys)).where("key <> ''")


def league_probes(leagues: DataFrame, names: C.Names) -> DataFrame:
    """(league_pos, pass, match_type, kind, key, guard): every key that a league looks up.

    guard: '' none, 'safe' the acronym test, 'override' the normalised name that an acronym must lead to."""
    name, norm = F.col("display_name"), F.col("league_key")
    df = leagues.withColumn("clean", normalise_league(strip_sport_division(name))).withColumn("acr", acronym(name)).withColumn("tail", trailing_acronym(F.col("clean")))
    df = df.withColumn("clean_core", core(F.col("clean"))).withColumn("clean_acr", spaceless(F.col("clean_core"))).withColumn("tail_core", core(F.col("tail.base")))
    clean, tail = F.col("clean"), F.col("tail")
    flat = F.create_map(*[F.lit(x) for kv in names.acronym_overrides.items() for x in kv]) if names.acronym_overrides else None
    by_division = {f"{a}|{d}": n for a, m in names.division_overrides.items() for d, n in m.items()}
    tagged = F.create_map(*[F.lit(x) for kv in by_division.items() for x in kv]) if by_division else None
    override = F.coalesce(*[m for m in (tagged[F.concat(F.col("clean_acr"), F.lit("|"), division(name))] if tagged is not None else None, flat[F.col("clean_acr")] if flat is not None else None) if m is not None], F.lit(""))
    p = lambda n, t, kind, value, ok=None, guard=F.lit(""): F.struct(F.lit(n).alias("pass"), F.lit(t).alias("match_type"), F.lit(kind).alias("kind"), (value if ok is None else F.when(ok, value)).alias("key"), guard.alias("guard"))
    changed, bare, split = clean != norm, F.length("clean_acr").between(3, 8) & F.col("clean_acr").rlike(r"(?U)^[\p{L}\p{N}]+$"), tail["acronym"] != ""
    probes = [
        p(10, "exact", "exact", name), p(20, "normalised", "norm", norm),
        p(40, "acronym", "acr", F.col("acr"), guard=F.lit("safe")), p(41, "acronym", "exact", F.upper("acr")),
        p(50, "parenthetical", "paren", norm), p(51, "normalised", "norm", clean, changed), p(52, "parenthetical", "paren", clean, changed),
        p(53, "acronym", "acr_ns", F.col("clean_acr"), bare, F.concat(F.lit("override:"), override)), p(54, "acronym", "initials", F.col("clean_acr"), bare, F.concat(F.lit("override:"), override)),
        p(55, "core", "core", F.col("clean_core"), F.length("clean_core") >= 3), p(56, "core", "core_ns", F.col("clean_acr"), F.length("clean_acr") >= 5),
        p(57, "normalised", "norm", tail["base"], split), p(58, "parenthetical", "paren", tail["base"], split),
        p(59, "core", "core", F.col("tail_core"), split & (F.length("tail_core") >= 3)), p(60, "acronym", "acr_ns", tail["acronym"], split),
    ]
    out = df.select("league_pos", F.inline(F.array(*probes))).where("key <> ''")
    if names.aliases:
        known = F.create_map(*[x for k, v in names.aliases.items() for x in (F.lit(k), F.array(*[F.lit(a) for a in v]))])
        other = df.select("league_pos", F.posexplode(known[name])).select("league_pos", F.col("pos"), F.col("col").alias("alias")).where("alias is not null")
        each = lambda kind, value, at: other.select("league_pos", (F.lit(30.0) + (F.col("pos") * 2 + at) / 1000.0).alias("pass"), F.lit("alias").alias("match_type"), F.lit(kind).alias("kind"), value.alias("key"), F.lit("").alias("guard"))
        out = out.withColumn("pass", F.col("pass").cast("double")).unionByName(each("exact", F.col("alias"), 0)).unionByName(each("norm", normalise_league(F.col("alias")), 1))
    return out.withColumn("pass", F.col("pass").cast("double"))


def strong_hits(leagues: DataFrame, cands: DataFrame, names: C.Names) -> DataFrame:
    """(league_pos, pass, match_type, cand_pos) of the keyed passes, each candidate id at its first pass."""
    probes, keys = league_probes(leagues, names), candidate_keys(cands)
    met = probes.join(keys, ["kind", "key"])
    # First letters count only where no candidate spells the acronym out.
    spelled = F.max((F.col("kind") == "acr_ns") & (F.col("pass") == 53)).over(Window.partitionBy("league_pos"))
    met = met.withColumn("spelled", spelled).where(~((F.col("pass") == 54) & F.col("spelled")))
    met = met.join(cands.select("cand_pos", "account_id", "name", "norm"), "cand_pos").join(leagues.select("league_pos", F.col("league_key").alias("lnorm")), "league_pos")
    safe = (F.col("guard") != "safe") | acronym_safe(F.col("name"), F.col("norm"), significant_words(F.col("lnorm")))
    wanted = F.regexp_replace("guard", "^override:", "")
    fits = ~F.startswith("guard", F.lit("override:")) | (wanted == "") | (wanted == F.col("norm"))
    return first_by(met.where(safe & fits), ["league_pos", "account_id"], [F.col("pass"), F.col("cand_pos")]).select("league_pos", "pass", "match_type", "cand_pos")


def weak_options(leagues: DataFrame, cands: DataFrame) -> DataFrame:
    """(league_pos, pass, match_type, key_pos, cand_pos) of containment and word overlap; key_pos orders candidate names by first sight."""
    real = cands.where(junk_reason(F.col("name")).isNull())
    keyed = real.groupBy("norm").agg(F.min("cand_pos").alias("key_pos"))
    names = keyed.select(F.col("key_pos").alias("id"), F.col("norm").alias("name"))
    mine = leagues.select(F.col("league_pos").alias("id"), F.col("league_key").alias("name"))
    part = word_containment(mine, names, 8, 4).select(F.col("a").alias("league_pos"), F.col("b").alias("key_pos"), F.lit(70.0).alias("pass"), F.lit("containment").alias("match_type"))
    words = lambda d: d.select("id", significant_words(F.col("name")).alias("words"))
    over = set_overlap(words(mine), words(names), int(C.OVERLAP * 100), 2).select(F.col("a").alias("league_pos"), F.col("b").alias("key_pos"), F.lit(80.0).alias("pass"), F.lit("fuzzy_overlap").alias("match_type"))
    return part.unionByName(over).join(keyed, "key_pos").join(real.select("norm", "cand_pos", "account_id"), "norm").select("league_pos", "pass", "match_type", "key_pos", "cand_pos", "account_id")


_HITS = pa.schema([("league_pos", pa.int64()), ("pass", pa.float64()), ("match_type", pa.string()), ("cand_pos", pa.int64())])


def _decide_weak(league: int, mine: list[dict], taken: set[str]) -> Iterator[dict]:
    """Weak hits of one league out of its options by pass, key_pos and cand_pos; what it claims goes to ``taken``."""
    live = [r for r in mine if r["account_id"] not in taken]
    if not live:
        return
    first = live[0]
    live = [r for r in live if r["pass"] == first["pass"] and (r["pass"] > 70 or r["key_pos"] == first["key_pos"])]
    hits: dict[str, dict] = {}
    for r in sorted(live, key=lambda r: (r["key_pos"], r["cand_pos"])):
        hits.setdefault(r["account_id"], r)
    good = [r for r in hits.values() if r["score"] >= C.KEEP_SCORE]
    best = [r for r in good if r["score"] == max(g["score"] for g in good)]
    named = [r for r in good if r["account_id"]]
    if named and (len(good) == 1 or len(best) == 1 or len({r["norm"] for r in best}) == 1):
        taken.add(min(named, key=lambda r: (-r["score"], -r["accounts"], -r["deals"], r["key_pos"], r["cand_pos"]))["account_id"])
    for r in hits.values():
        yield {k: r[k] for k in _HITS.names}


def weak_hits(options: DataFrame, claimed: DataFrame, leagues: DataFrame, cands: DataFrame, most: int = IN_TASK) -> DataFrame:
    """Weak hits out of the options of leagues without strong ones, as if leagues were gone through in order: a league that is matched by
    weak hits claims the best one's id, and no later league can have it. claimed: (id, from_pos), ids claimed otherwise.

    Containment stops at the first candidate name that yields a hit and keeps overlap out. Leagues that share no id, directly or
    through others, are independent: such parts of up to ``most`` options are gone through in sequence, many to a task. In larger
    parts all leagues are decided at once, given who claims what, until the claims stay the same: as
    many rounds as the longest chain of claims that changed one another, however many leagues share an id."""
    free = options.join(claimed.select(F.col("id").alias("account_id"), F.col("from_pos")), "account_id", "left")
    free = free.where(F.col("from_pos").isNull() | (F.col("from_pos") > F.col("league_pos")) | (F.col("account_id") == ""))
    kept = ["league_pos", "pass", "match_type", "key_pos", "cand_pos", "account_id", "norm", "score", "accounts", "deals"]
    every = written(scored(free.select("league_pos", "pass", "match_type", "key_pos", "cand_pos").distinct(), leagues, cands).select(*[F.col(c).cast("long").alias(c) if c in ("league_pos", "key_pos", "cand_pos") else c for c in kept]), "weak-options")
    small, large = parts(every, "league_pos", "account_id", most)
    out = in_order(small, "league_pos", ["pass", "key_pos", "cand_pos"], _decide_weak, _HITS)
    return out if large is None else out.unionByName(_settled(written(large, "weak-options")))


def _settled(every: DataFrame) -> DataFrame:
    """Weak hits of large parts, by rounds over all leagues."""
    each = Window.partitionBy("league_pos")

    def hits(live: DataFrame) -> DataFrame:
        live = live.withColumn("first_pass", F.min("pass").over(each)).where("pass = first_pass")
        live = live.withColumn("first_key", F.min("key_pos").over(each)).where((F.col("pass") > 70) | (F.col("key_pos") == F.col("first_key")))
        return first_by(live, ["league_pos", "account_id"], [F.col("key_pos"), F.col("cand_pos")])

    def still_open(taken: DataFrame) -> DataFrame:
        j = every.join(taken.select(F.col("id").alias("account_id"), "by"), "account_id", "left")
        return j.where(F.col("by").isNull() | (F.col("by") >= F.col("league_pos"))).drop("by")

    taken = written(every.sparkSession.createDataFrame([], "id string, by long"), "taken")
    while True:
        good = hits(still_open(taken)).where(F.col("score") >= C.KEEP_SCORE).withColumn("top", F.max("score").over(each))
        best = F.col("score") == F.col("top")
        rank = F.struct((-F.col("score")).alias("s"), (-F.col("accounts")).alias("a"), (-F.col("deals")).alias("d"), "key_pos", "cand_pos")
        decided = good.groupBy("league_pos").agg(F.count("*").alias("n"), F.count_if(best).alias("winners"), F.count_distinct(F.when(best, F.col("norm"))).alias("names"), F.min_by(F.when(F.col("account_id") != "", F.col("account_id")), F.when(F.col("account_id") != "", rank)).alias("id"))
        claims = decided.where("(n = 1 or winners = 1 or names = 1) and id is not null").groupBy("id").agg(F.min("league_pos").alias("by"))
        after = written(claims, "taken")
        same = after.count() == taken.count() and not after.exceptAll(taken).take(1)
        if same:
            return hits(still_open(after)).select(*_HITS.names)
        release(taken)
        taken = after


def scored(hits: DataFrame, leagues: DataFrame, cands: DataFrame) -> DataFrame:
    """Hits with base score and country signal; name passes can't lose by country."""
    base = F.create_map(*[F.lit(x) for kv in C.LEAGUE_SCORES.items() for x in kv])
    h = hits.join(cands, "cand_pos").join(leagues.select("league_pos", "countries"), "league_pos")
    signal = country_signal(F.col("countries"), F.col("country"))
    by_name = F.col("match_type").isin("exact", "normalised", "alias")
    return h.withColumn("signal", signal).withColumn("score", base[F.col("match_type")] + F.when(by_name, F.greatest(F.lit(0), signal)).otherwise(signal))


def decide(hits: DataFrame) -> DataFrame:
    """One row per league with hits: status, type, confidence, ids and names in order, note.

    Ties in score are one account seen twice if their normalised names agree, else ambiguous."""
    order = Window.partitionBy("league_pos").orderBy(F.col("score").desc(), "pass", "cand_pos")
    whole = Window.partitionBy("league_pos")
    h = hits.withColumn("n", F.row_number().over(order)).withColumn("top", F.max("score").over(whole))
    good = F.col("score") >= C.KEEP_SCORE
    h = h.withColumn("kept", F.sum(F.when(good, 1).otherwise(0)).over(whole))
    winner = good & (F.col("score") == F.col("top"))
    rank = F.struct((-F.col("score")).alias("s"), (-F.col("accounts")).alias("a"), (-F.col("deals")).alias("d"), F.col("pass").alias("p"), F.col("cand_pos").alias("c"))
    item = F.struct(rank.alias("rank"), "account_id", "other_id", "name", "deals", "active_arr")
    g = h.groupBy("league_pos").agg(
        F.max("kept").alias("kept"), F.max("top").alias("top"),
        F.max(F.when(F.col("n") == 1, F.col("match_type"))).alias("match_type"), F.max(F.when(F.col("n") == 1, F.col("name"))).alias("best_name"),
        F.max(F.when(F.col("n") == 1, F.col("country"))).alias("best_country"), F.max(F.when(F.col("n") == 1, F.col("signal"))).alias("best_signal"),
        F.count_if(winner).alias("winners"), F.count_distinct(F.when(winner, F.col("norm"))).alias("winner_names"),
        F.array_sort(F.collect_list(F.when(good, item))).alias("items"),
    )
    some = F.col("kept") > 0
    status = F.when(~some, "unmatched").when((F.col("kept") == 1) | (F.col("winners") == 1) | (F.col("winner_names") == 1), "matched").otherwise("ambiguous")
    ids = lambda f: F.array_distinct(F.filter(F.transform("items", lambda x: x[f]), lambda v: v != ""))
    via = F.concat(F.lit(" via "), "match_type", F.lit(" (score "), F.col("top").cast("string"), F.lit(")"))
    note = (
        F.when(~some, F.concat(F.lit("Best candidate "), "best_name", F.lit(" demoted: "), "match_type", F.lit(", composite "), F.col("top").cast("string")))
        .when(F.col("kept") == 1, F.concat(F.lit("Single match"), via))
        .when(F.col("winners") == 1, F.concat(F.lit("Best match"), via, F.lit("; "), (F.col("kept") - 1).cast("string"), F.lit(" weaker")))
        .when(F.col("winner_names") == 1, F.concat(F.lit("Match"), via, F.lit("; "), F.col("winners").cast("string"), F.lit(" rows of one account")))
        .otherwise(F.concat(F.col("winners").cast("string"), F.lit(" candidates tied at "), F.col("top").cast("string"), F.lit("; manual review")))
    )
    hint = F.when(some & (F.col("best_signal") > 0), F.concat(F.lit("; country match: "), "best_country")).when(some & (F.col("best_signal") < 0), F.concat(F.lit("; country conflict: "), "best_country")).otherwise("")
    return g.select(
        "league_pos", status.alias("match_status"), "match_type", F.greatest(F.col("top"), F.lit(0)).cast("int").alias("confidence"), F.when(some, confidence(F.col("top"))).otherwise("").alias("confidence_label"),
        ids("account_id").alias("account_ids"), ids("other_id").alias("other_ids"), F.transform("items", lambda x: x["name"]).alias("account_names"),
        F.when(some, F.get("items", F.lit(0))["deals"]).otherwise(0).cast("long").alias("deals"), F.when(some, F.get("items", F.lit(0))["active_arr"]).otherwise("").alias("active_arr"), F.concat(note, hint).alias("note"),
    ).withColumn("match_source", match_source(F.size("account_ids") > 0, F.size("other_ids") > 0))


def _trusted(league_pos: Column, type_: str, ids: Column, others: Column, names: Column, deals: Column, arr: Column, note: Column) -> list[Column]:
    one = lambda v: F.filter(F.array(F.coalesce(v, F.lit(""))), lambda x: x != "")
    return [league_pos.alias("league_pos"), F.lit("matched").alias("match_status"), F.lit(type_).alias("match_type"), F.lit(100).alias("confidence"), F.lit("High").alias("confidence_label"), one(ids).alias("account_ids"), one(others).alias("other_ids"), one(names).alias("account_names"), F.coalesce(deals, F.lit(0)).cast("long").alias("deals"), F.coalesce(arr, F.lit("")).alias("active_arr"), note.alias("note")]


def overrides(leagues: DataFrame, cands: DataFrame, manual: DataFrame | None, aliases: DataFrame | None) -> DataFrame | None:
    """Leagues that a curated row decides: manual id, then pasted id, then alias; the first that applies.

    manual: (league, account_id, other_id, note, src_pos); aliases: (league, company_name, other_id, reason, src_pos)."""
    parts = []
    by_id = last_wins(cands.where("account_id <> ''"), ["account_id"], "cand_pos")
    by_other = last_wins(cands.where("other_id <> ''"), ["other_id"], "cand_pos")
    pick = lambda d, p: d.select(*[F.col(c).alias(f"{p}_{c}") for c in _CANDIDATE])
    if manual is not None:
        m = last_wins(manual.where("account_id <> ''").withColumn("key", normalise_league(F.col("league"))), ["key"])
        m = m.select("key", F.col("account_id").alias("m_id"), text(F.col("other_id")).alias("m_other"), text(F.col("note")).alias("m_note"))
        j = leagues.withColumn("key", normalise_league(F.col("display_name"))).join(m, "key").join(pick(by_id, "c"), F.col("m_id") == F.col("c_account_id"), "left")
        other = F.when(F.coalesce("c_other_id", F.lit("")) != "", F.col("c_other_id")).otherwise(F.col("m_other"))
        note = F.concat(F.lit("Manual account id"), F.when(F.col("m_note") != "", F.concat(F.lit(": "), "m_note")).otherwise(""))
        parts.append(j.select(*_trusted(F.col("league_pos"), "manual", F.col("m_id"), other, F.col("c_name"), F.col("c_deals"), F.col("c_active_arr"), note), F.lit(1).alias("rule")))
    pasted = leagues.where(text(F.col("pasted_id")) != "").withColumn("pid", F.trim("pasted_id"))
    p = pasted.join(pick(by_id, "a"), F.col("pid") == F.col("a_account_id"), "left").join(pick(by_other, "b"), F.col("pid") == F.col("b_other_id"), "left")
    take = lambda f: F.when(F.col("a_cand_pos").isNotNull(), F.col(f"a_{f}")).otherwise(F.col(f"b_{f}"))
    via = F.when(F.col("a_cand_pos").isNotNull(), "Account id from the row").otherwise("Company id from the row")
    found = p.where("a_cand_pos is not null or b_cand_pos is not null")
    parts.append(found.select(*_trusted(F.col("league_pos"), "exact", take("account_id"), take("other_id"), take("name"), take("deals"), take("active_arr"), via), F.lit(2).alias("rule")))
    if aliases is not None:
        by_name = last_wins(cands.where("name <> ''"), ["norm"], "cand_pos")
        al = aliases.select(normalise_league(F.col("league")).alias("an"), text(F.col("other_id")).alias("al_other"), normalise_league(text(F.col("company_name"))).alias("al_norm"), text(F.col("reason")).alias("reason"), F.col("league").alias("al_league"), F.col("src_pos").alias("al_pos")).where("an <> ''")
        al = al.join(pick(by_other, "a"), F.col("al_other") == F.col("a_other_id"), "left").join(by_name.select(F.col("norm").alias("b_norm"), *[F.col(c).alias(f"b_{c}") for c in _CANDIDATE]), F.col("al_norm") == F.col("b_norm"), "left").where("a_cand_pos is not null or b_cand_pos is not null")
        # An alias stands in a league's name as a run of words: they meet on the alias's first word.
        al = al.withColumn("word", F.element_at(F.split("an", " "), 1))
        lw = leagues.select("league_pos", "league_key", F.explode(F.array_distinct(F.split("league_key", " "))).alias("word"))
        j = first_by(lw.join(al, "word").where(token_run(F.col("an"), F.col("league_key"))), ["league_pos"], [F.col("al_pos")])
        note = F.concat(F.lit("Alias "), "al_league", F.when(F.col("reason") != "", F.concat(F.lit(": "), "reason")).otherwise(""))
        parts.append(j.select(*_trusted(F.col("league_pos"), "alias", take("account_id"), take("other_id"), take("name"), take("deals"), take("active_arr"), note), F.lit(3).alias("rule")))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    out = first_by(out, ["league_pos"], [F.col("rule")]).drop("rule")
    return out.withColumn("match_source", match_source(F.size("account_ids") > 0, F.size("other_ids") > 0))


def found_by_name(leagues: DataFrame, cands: DataFrame, names: C.Names, manual: DataFrame | None = None, aliases: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(trusted, strong, options): what the passes find for each league by itself. Leagues that a curated row decides aren't looked up;
    weak options are of leagues without a strong hit."""
    trusted = written(overrides(leagues, cands, manual, aliases), "overrides")
    open_ = leagues.join(trusted.select("league_pos"), "league_pos", "left_anti")
    strong = written(strong_hits(open_, cands, names), "strong-hits")
    bare = written(open_.join(strong.select("league_pos").distinct(), "league_pos", "left_anti"), "bare-leagues")
    some = "league_pos long, pass double, match_type string, key_pos long, cand_pos long, account_id string"
    options = weak_options(bare, cands) if bare.take(1) else bare.sparkSession.createDataFrame([], some)
    return trusted, strong, written(options, "options")


def decided(leagues: DataFrame, cands: DataFrame, trusted: DataFrame, strong: DataFrame, options: DataFrame) -> DataFrame:
    """One row per league with its match, out of what ``found_by_name`` gives: here leagues meet, as weak matches claim ids in order."""
    hits = strong
    if options.take(1):
        claimed = trusted.select("league_pos", F.explode("account_ids").alias("id")).groupBy("id").agg(F.min("league_pos").alias("from_pos"))
        hits = hits.unionByName(weak_hits(options, claimed, leagues, cands))
    found = decide(scored(hits, leagues, cands)).unionByName(trusted)
    empty = F.expr("cast(array() as array<string>)")
    fill = {"match_status": F.lit("unmatched"), "match_type": F.lit(""), "confidence": F.lit(0), "confidence_label": F.lit(""), "account_ids": empty, "other_ids": empty, "account_names": empty, "deals": F.lit(0).cast("long"), "active_arr": F.lit(""), "note": F.lit("No matching account found"), "match_source": F.lit("")}
    out = leagues.join(found, "league_pos", "left")
    return out.withColumns({c: F.coalesce(F.col(c), v) for c, v in fill.items()})


def crosscheck(leagues: DataFrame, pool: DataFrame, names: C.Names | None = None, manual: DataFrame | None = None, aliases: DataFrame | None = None) -> DataFrame:
    """One row per league with its match.

    leagues: league_pos, league_key (normalised), display_name, countries (of its territories), pasted_id.
    pool: src_pos, id, other_id, name, country, deals, accounts, active_arr (missing ones count as empty)."""
    cands = written(candidates(pool), "candidates")
    leagues = written(leagues, "leagues")
    return decided(leagues, cands, *found_by_name(leagues, cands, names or C.Names(), manual, aliases))


def league_candidates(accounts: DataFrame, org_types: list[str] = C.LEAGUE_ORG_TYPES) -> DataFrame:
    """Accounts that look like leagues: by their type if they have one, else by their name."""
    kind, name = F.lower(F.trim(text(F.col("org_type")))), F.lower(F.trim(text(F.col("name"))))
    has = lambda c, words: F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(c, w))
    return accounts.where(name != "").where(F.when(kind != "", has(kind, org_types)).otherwise(has(name, [*org_types, *C.LEAGUE_NAME_CUES])))


def overlap(a: Column, b: Column) -> Column:
    return overlap_ratio(a, b)
