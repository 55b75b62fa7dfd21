"""Queries over the matchers pass by pass, products, and grouped entities. Each customer stands for one case; its key,
spelled in letters, makes its names its own, so the SQL can say which pass must find what."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith import config as C
from rowsmith.functions.clubs import normalise_club
from rowsmith.functions.text import normalise_league
from rowsmith.operators import clubs, entities, match, products
from rowsmith.plans import jobs
from rowsmith.plans.registry import T, query
from rowsmith.plans.tables import written
from rowsmith.sources import lookups

_DIGITS, _LETTERS = "0123456789", "bcdfghjklm"
_DIGITS_20, _LETTERS_20 = "0123456789ABCDEFGHIJ", "bcdfghjklmnpqrstvwxz"


def _letters(k: Column) -> Column:
    return F.translate(k.cast("string"), _DIGITS, _LETTERS)


def _short(u: Column) -> Column:
    """What ``_letters`` spells, at base 20 and without its last digit at that base, which is the case: six letters reach 1.28 billion keys."""
    k = F.translate(u, _LETTERS, _DIGITS).cast("long")
    return F.translate(F.conv(F.floor(k / len(_CASES)).cast("string"), 10, 20), _DIGITS_20, _LETTERS_20)


def _case(k: Column, forms: list[Column]) -> Column:
    return F.element_at(F.array(*forms), (k % len(forms) + 1).cast("int"))


#: Case by case: the league's name, its candidates' names (u: the key in letters; s: the same, shorter), what must come out.
_CASES = [
    ("zq{u} Conference", ["zq{u} Conference"], "matched", "exact", 100, 1),
    ("The zq{u} Conf.", ["zq{u} Conference"], "matched", "normalised", 95, 1),
    ("zq{u} North Group (q{u})", ["zq{u} North Assembly (Q{u})"], "matched", "acronym", 80, 1),
    ("zq{u} Big Conference", ["Other zq{u} Body (zq{u} Big Conference)"], "matched", "parenthetical", 75, 1),
    ("zq{u} Conference Mens Soccer", ["zq{u} Conference"], "matched", "normalised", 95, 1),
    # A parenthesis of more than six letters is a name, too, and comes first where a league is called just that.
    ("QX{s} League", ["zq{u} Rim South (qx{s})"], "matched", "acronym", 80, 1),
    ("qz{s}", ["Quab Zuab {w}"], "matched", "acronym", 80, 1),
    ("zq{u} League", ["zq{u} Association"], "matched", "core", 78, 1),
    ("zq{u} North Group zng", ["zq{u} North Group"], "matched", "normalised", 95, 1),
    ("zq{u} Alpine Circuit", ["zq{u} Alpine Circuit Premier Stage"], "matched", "containment", 60, 1),
    ("zq{u} vk{u} Lake Tour Stage", ["Stage zq{u} vk{u} Lake Prime"], "matched", "fuzzy_overlap", 50, 1),
    ("zq{u} Lonely", ["Elsewhere vk{u}"], "unmatched", "", 0, 0),
    ("zq{u} League", ["zq{u} Association", "zq{u} Federation"], "ambiguous", "core", 78, 2),
    ("zq{u} Conference", ["zq{u} Conference", "The zq{u} Conf"], "matched", "exact", 100, 2),
    # Far from the league's country: a core hit falls below what is kept.
    ("zq{u} League", ["zq{u} Association"], "unmatched", "core", 38, 0),
    ("zq{u} League", ["zq{u} Association", "zq{u} Federation"], "matched", "core", 98, 1),
    # Decided by curated rows: a pasted id, a manual id, an alias inside the name.
    ("zq{u} Pasted", ["Anything vk{u}"], "matched", "exact", 100, 1),
    ("zq{u} Manual", ["Anything vk{u}"], "matched", "manual", 100, 1),
    ("Grand zq{u} Nick Series", ["Called vk{u}"], "matched", "alias", 100, 1),
    # Junk names and short ones are no candidates.
    ("test {u}", ["test {u}"], "unmatched", "", 0, 0),
]
_FAR, _NEAR, _PASTED, _MANUAL, _ALIAS = 14, 15, 16, 17, 18


def _name(template: str, u: Column) -> Column:
    known = {"u": u, "s": _short(u), "w": F.trim(F.regexp_replace(_short(u), "(.)", "$1uab ")), "h": F.md5(u)}
    parts = [known.get(p, F.lit(p)) for p in template.replace("{u}", "\0u\0").replace("{s}", "\0s\0").replace("{w}", "\0w\0").replace("{h}", "\0h\0").split("\0")]
    return F.concat(*parts)


def _case_frames(spark, d) -> tuple[DataFrame, DataFrame]:
    c = T(spark, d, "customer")
    k, n = F.col("c_custkey"), len(_CASES)
    u, kind = _letters(k), k % n
    league = _case(k, [_name(x[0], u) for x in _CASES])
    leagues = c.select(k.alias("league_pos"), league.alias("display_name"), F.when(kind.isin(_FAR, _NEAR), F.array(F.lit("sweden"))).otherwise(F.expr("cast(array() as array<string>)")).alias("countries"), F.when(kind == _PASTED, F.concat(F.lit(" A"), k.cast("string"))).otherwise("").alias("pasted_id"))
    leagues = leagues.withColumn("league_key", normalise_league(F.col("display_name")))
    pool = None
    for i in (0, 1):
        name = _case(k, [_name(x[1][i], u) if len(x[1]) > i else F.lit("") for x in _CASES])
        country = F.when(kind == _FAR, "Norway").when(kind == _NEAR, F.lit("Sweden" if i == 0 else "Norway")).otherwise("")
        part = c.select((k * 2 + i).alias("src_pos"), F.concat(F.lit("AB"[i]), k.cast("string")).alias("id"), F.lit("").alias("other_id"), name.alias("name"), country.alias("country"), F.lit(0).alias("deals"), F.lit(0).alias("accounts"), F.lit("").alias("active_arr")).where("name <> ''")
        pool = part if pool is None else pool.unionByName(part)
    return leagues, pool


def _cases_sql(column: int) -> str:
    quoted = [f"'{x[column]}'" if isinstance(x[column], str) else str(x[column]) for x in _CASES]
    return f"case c_custkey % {len(_CASES)} " + " ".join(f"when {i} then {v}" for i, v in enumerate(quoted)) + " end"


@query(f"""select c_custkey as league_pos, {_cases_sql(2)} as match_status, {_cases_sql(3)} as match_type, {_cases_sql(4)} as confidence,
 case {_cases_sql(5)} when 0 then '' when 1 then 'A' || c_custkey else 'A' || c_custkey || ';B' || c_custkey end as account_ids from customer""")
def league_passes(spark, d):
    """Every pass of the league matcher, curated rows and country signals: one league a customer, case by case."""
    leagues, pool = _case_frames(spark, d)
    k, n = F.col("league_pos"), len(_CASES)
    u = _letters(k)
    manual = leagues.where(k % n == _MANUAL).select(F.upper("display_name").alias("league"), F.concat(F.lit("A"), k.cast("string")).alias("account_id"), F.lit("").alias("other_id"), F.lit("seen").alias("note"), k.alias("src_pos"))
    aliases = leagues.where(k % n == _ALIAS).select(F.concat(F.lit("zq"), u, F.lit(" nick")).alias("league"), F.concat(F.lit("called vk"), u).alias("company_name"), F.lit("").alias("other_id"), F.lit("").alias("reason"), k.alias("src_pos"))
    out = match.crosscheck(leagues, pool, C.Names(), manual, aliases)
    return out.select("league_pos", "match_status", "match_type", "confidence", F.array_join("account_ids", ";").alias("account_ids"))


@query("""select c_custkey as league_pos, case c_custkey when 1 then 'alias' when 2 then 'acronym' when 3 then 'acronym' when 4 then '' end as match_type, case c_custkey when 1 then 'B1' when 2 then 'B2' when 3 then 'B3' else '' end as account_ids from customer where c_custkey between 1 and 4""")
def league_dictionaries(spark, d):
    """What a deployment's dictionaries decide: aliases in order, acronyms that must lead to one name, also by division. The four leagues are configuration."""
    names = C.Names(aliases={"Omega Cup": ["Not There", "The Rim Conf"]}, acronym_overrides={"sba": "south bay assembly"}, division_overrides={"npc": {"d1": "north pine circle"}})
    key = T(spark, d, "customer").where("c_custkey between 1 and 4").select(F.col("c_custkey").alias("league_pos"))
    label = _case(F.col("league_pos") - 1, [F.lit(x) for x in ("Omega Cup", "SBA", "NPC Football D1", "NPC")])
    leagues = key.withColumns({"display_name": label, "countries": F.expr("cast(array() as array<string>)"), "pasted_id": F.lit("")}).withColumn("league_key", normalise_league(F.col("display_name")))
    pool = spark.createDataFrame([(1, "B1", "Rim Conference"), (2, "X2", "Sand Beach Arena (SBA)"), (3, "B2", "South Bay Assembly (SBA)"), (4, "X3", "Night Port Club (NPC)"), (5, "B3", "North Pine Circle (NPC)")], "src_pos long, id string, name string")
    # Without an override an acronym that two candidates spell stays open.
    out = match.crosscheck(leagues, pool, names)
    one = (F.col("match_status") == "matched") & (F.size("account_ids") == 1)
    return out.select("league_pos", F.when(one, F.col("match_type")).otherwise("").alias("match_type"), F.when(one, F.col("account_ids")[0]).otherwise("").alias("account_ids"))


#: Case by case (h: a digest of the key, so that no two keys are a few edits apart): the club's name and domain, its row's name and domain, what must come out.
_CLUBS = [
    ("zq{u} Town", "", "zq{u} Town", "", "exact"),
    ("Zq{u} Tówn", "", "zq{u} town GmbH", "", "normalised"),
    ("FC zq{u} Town", "", "zq{u} Town F.C.", "", "prefix_canon"),
    ("zq{u} Rim Town", "", "Club of vk{u} (zq{u} Rim Town)", "", "parenthetical"),
    ("zq{u} Rim Town", "", "zq{u} Rim Town United", "", "containment"),
    ("zq{u} vk{u} Lake Rim Stage", "", "Stage zq{u} vk{u} Lake Prime", "", "fuzzy_overlap"),
    ("Stadt{h}x am See", "", "Stadt{h}y am See", "", "fuzzy_overlap"),
    ("vk{u} Anything", "www.zq{u}.example", "Other zq{u}", "https://zq{u}.example/x", "exact_domain"),
    ("vk{u} Anything", "zq{u}.example", "Other zq{u}", "shop.zq{u}.example", "exact_domain"),
    ("vk{u} Lonely", "", "Nothing like zq{u}", "", None),
]


def _club_frames(spark, d) -> tuple[DataFrame, DataFrame]:
    c = T(spark, d, "customer")
    k = F.col("c_custkey")
    u = _letters(k)
    part = lambda i: _case(k, [_name(x[i], u) for x in _CLUBS])
    truth = c.select(k.alias("src_pos"), part(0).alias("name"), part(1).alias("domain"))
    rows = c.select(k.alias("src_pos"), F.concat(F.lit("A"), k.cast("string")).alias("id"), part(2).alias("name"), part(3).alias("domain"), (k % 5).cast("string").alias("active"))
    return truth, rows


_CLUB_TYPE = f"case c_custkey % {len(_CLUBS)} " + " ".join(f"when {i} then '{x[4]}'" for i, x in enumerate(_CLUBS) if x[4]) + " end"


@query(f"""select c_custkey as truth_pos, 'A' || c_custkey as row_id, {_CLUB_TYPE} as match_type from customer where {_CLUB_TYPE} is not null""")
def club_passes(spark, d):
    """Every pass of the club matcher, case by case."""
    return clubs.match(*_club_frames(spark, d)).select("truth_pos", "row_id", "match_type")


@query(f"""select c_custkey as k, 'club' as side from customer where {_CLUB_TYPE} is null union all select c_custkey, 'row' from customer where {_CLUB_TYPE} is null""")
def club_leftovers(spark, d):
    """Clubs without a row and rows without a club."""
    truth, rows = _club_frames(spark, d)
    found = written(clubs.match(truth, rows), "club-passes")
    return clubs.unmatched(truth, found).select(F.col("src_pos").alias("k"), F.lit("club").alias("side")).unionByName(clubs.orphans(rows, found).select(F.col("src_pos").alias("k"), F.lit("row").alias("side")))


_FOUND = """m as (select o_custkey as truth_pos, 'Club ' || (o_custkey // 2) as truth_name, o_orderkey as row_pos, 'R' || o_orderkey as row_id, case o_orderkey % 3 when 0 then 'exact' when 1 then 'containment' else 'exact_domain' end as match_type, o_orderkey % 3 as pass, o_orderkey % 5 as active from orders)"""


def _found(spark, d) -> DataFrame:
    o = F.col("o_orderkey")
    return T(spark, d, "orders").select(F.col("o_custkey").alias("truth_pos"), F.concat(F.lit("Club "), F.floor(F.col("o_custkey") / 2).cast("string")).alias("truth_name"), o.alias("row_pos"), F.concat(F.lit("R"), o.cast("string")).alias("row_id"), _case(o, [F.lit("exact"), F.lit("containment"), F.lit("exact_domain")]).alias("match_type"), (o % 3).cast("double").alias("pass"), o.alias("order"), (o % 5).cast("string").alias("active"))


@query(f"""with {_FOUND}, l as (select truth_name, max(truth_pos) as truth_pos from m group by 1), n as (select m.* from m join l using (truth_name, truth_pos))
select truth_name, coalesce(arg_min(row_id, (pass, row_pos)) filter (where match_type = 'exact'), case when count(*) = 1 then min(row_id) end, '') as account_id,
 case when count(*) filter (where match_type = 'exact') = 0 and count(*) > 1 then string_agg(row_id, ';' order by pass, row_pos) else '' end as review from n group by 1""")
def club_decisions(spark, d):
    """An account a club: the first exact hit, else the only one, else several to review; of clubs of one name the last."""
    out = clubs.account_decision(_found(spark, d))
    return out.select("truth_name", "account_id", F.array_join("review", ";").alias("review"))


@query(f"""with {_FOUND} select truth_pos, row_id, row_number() over (partition by truth_pos order by case match_type when 'containment' then 60 else 100 end desc, active desc, pass, row_pos) as rank from m""")
def club_ranks(spark, d):
    """A club's rows ranked by type, then by how active they are."""
    return clubs.ranked(_found(spark, d)).select("truth_pos", "row_id", "rank")


@query("""select c_custkey as src_pos from customer where c_custkey % 3 = 0 and c_custkey % 2 > 0 and c_custkey % 4 > 0""")
def clubs_known_elsewhere(spark, d):
    """Clubs without an account and a pinned id that another system's rows match."""
    c = T(spark, d, "customer")
    k = F.col("c_custkey")
    name = F.concat(F.md5(k.cast("string")), F.lit(" Town"))
    roster = c.select(k.alias("src_pos"), name.alias("name"), F.lit("").alias("domain"), F.when(k % 4 == 0, "pin").otherwise("").alias("pinned_id"))
    decisions = c.where("c_custkey % 2 = 0").select(name.alias("truth_name"), F.lit("A").alias("account_id"))
    others = c.where("c_custkey % 3 = 0").select(k.alias("src_pos"), k.cast("string").alias("id"), F.upper(name).alias("name"), F.lit("").alias("domain"))
    return clubs.known_elsewhere(roster, decisions, others).select("src_pos")


@query("""select tier, row_id from (select case when s_suppkey % 2 = 0 then 'matched' else 'none' end as tier, case when s_suppkey % 3 = 0 then '' else 'R' || s_suppkey end as row_id from supplier) where (tier = 'matched' and row_id <> '') or tier = 'none'""")
def club_tiers(spark, d):
    """Review rows of a tier; matched ones need an id."""
    k = F.col("s_suppkey")
    m = T(spark, d, "supplier").select(F.when(k % 2 == 0, "matched").otherwise("none").alias("tier"), F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("R"), k.cast("string"))).alias("row_id"))
    return clubs.tier_rows(m, "matched").unionByName(clubs.tier_rows(m, "none"))


# ---------------------------------------------------------------- entities
_DEALS = """r as (select o_orderkey as pos, case when o_orderkey % 2 = 0 then 'The Zone ' || o_custkey || ' Conf.' else 'zone ' || o_custkey || ' conference' end as league, 'zone ' || o_custkey || ' conference' as key, 'H' || (o_orderkey % 2 + 1) as period,
 case when o_orderkey % 3 = 0 then '' else 'Sport ' || (o_orderkey % 4) end as sport, 'Rep ' || (o_orderkey % 5) as rep, o_totalprice as arr, case when o_orderkey % 7 = 0 then 'ID' || o_orderkey else '' end as ref from orders)"""


def _deal_rows(spark, d) -> DataFrame:
    k = F.col("o_orderkey")
    key = F.col("o_custkey").cast("string")
    league = F.when(k % 2 == 0, F.concat(F.lit("The Zone "), key, F.lit(" Conf."))).otherwise(F.concat(F.lit("zone "), key, F.lit(" conference")))
    return T(spark, d, "orders").select(k.alias("src_pos"), league.alias("league"), F.concat(F.lit("H"), (k % 2 + 1).cast("string")).alias("period"), F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("Sport "), (k % 4).cast("string"))).alias("sport"), F.concat(F.lit("Rep "), (k % 5).cast("string")).alias("rep_name"), F.col("o_totalprice").alias("arr_eur"), F.when(k % 7 == 0, F.concat(F.lit("ID"), k.cast("string"))).otherwise("").alias("account_ref"))


def _grouped_sql(by: str) -> str:
    return f"""with {_DEALS}, s as (select key, {by} sport, min(pos) as p from r where sport <> '' group by all), t as (select key, {by} string_agg(sport, ';' order by p) as sports, arg_min(sport, p) as first_sport from s group by all),
 x as (select key, {by} rep, min(pos) as p from r group by all), y as (select key, {by} string_agg(rep, ';' order by p) as reps from x group by all),
 g as (select key, {by} min(pos) as first_pos, arg_min(league, pos) as display_name, count(*) as n_rows, round(sum(arr), 2) as total_arr, coalesce(arg_min(ref, pos) filter (where ref <> ''), '') as pasted_id from r group by all)
 select key as league_key, {by} first_pos, display_name, n_rows, total_arr, pasted_id, coalesce(sports, '') as sports, coalesce(first_sport, '') as primary_sport, reps from g left join t using (key{', ' + by.strip(', ') if by else ''}) join y using (key{', ' + by.strip(', ') if by else ''})"""


def _grouped(spark, d, by: list[str]) -> DataFrame:
    g = entities.group_entities(_deal_rows(spark, d), by)
    return g.select("league_key", *by, "first_pos", "display_name", "n_rows", F.round("total_arr", 2).alias("total_arr"), "pasted_id", F.array_join("sports", ";").alias("sports"), "primary_sport", F.array_join("rep_names", ";").alias("reps"))


@query(_grouped_sql(""))
def league_groups(spark, d):
    """Deals by normalised league: first spelling, sums, distinct sports and people in order of first sight."""
    return _grouped(spark, d, [])


@query(_grouped_sql("period, "))
def league_period_groups(spark, d):
    """Deals by normalised league and period."""
    return _grouped(spark, d, ["period"])


@query(f"""with {_DEALS}, m as (select key, count(*) as n, case when min(pos) % 2 = 0 then 'matched' else 'unmatched' end as status from r group by 1) select key as league_key, period, status from (select distinct key, period from r) join m using (key)""")
def propagated_results(spark, d):
    """Results by league carried to its periods."""
    rows = entities.with_key(_deal_rows(spark, d))
    results = rows.groupBy("league_key").agg(F.min("src_pos").alias("p")).select("league_key", F.when(F.col("p") % 2 == 0, "matched").otherwise("unmatched").alias("status"))
    return entities.propagate(results, rows.select("league_key", "period").distinct()).select("league_key", "period", "status")


@query("""select o_orderkey as src_pos, concat_ws(',', case when o_orderkey % 2 = 0 then 'product' end, case when o_orderkey % 3 = 0 then 'sport' end, case when o_orderkey % 5 = 0 then 'deal_type' end, case when o_orderkey % 7 = 0 then 'arr_eur' end) as missing from orders where o_orderkey % 2 = 0 or o_orderkey % 3 = 0 or o_orderkey % 5 = 0 or o_orderkey % 7 = 0""")
def missing_deal_fields(spark, d):
    """Rows that lack what a deal needs, and what they lack."""
    k = F.col("o_orderkey")
    blank = lambda n: F.when(k % n == 0, " ").otherwise("x")
    rows = T(spark, d, "orders").select(k.alias("src_pos"), F.lit("l").alias("league"), blank(2).alias("product"), blank(3).alias("sport"), blank(5).alias("deal_type"), F.when(k % 14 == 0, F.lit(0.0)).when(k % 7 == 0, F.lit(None).cast("double")).otherwise(F.lit(1.0)).alias("arr_eur"))
    return entities.missing_fields(rows).select("src_pos", F.array_join("missing", ",").alias("missing"))


@query("""select count(*) filter (where o_custkey % 3 = 0) as matched, count(*) filter (where o_custkey % 3 = 1) as ambiguous, count(*) filter (where o_custkey % 3 = 2) as unmatched from orders""")
def rep_counts(spark, d):
    """Rows, not names, by how their person was resolved."""
    r = T(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("rep_name"))
    k = F.col("rep_name").cast("long")
    resolved = r.distinct().where(k % 6 != 5).withColumn("status", _case(k, [F.lit("matched"), F.lit("ambiguous"), F.lit("unmatched")]))
    return entities.people_counts(r, resolved)


@query("""select c_nationkey as k, count(*) as n from customer group by 1 having count(*) > 1""")
def repeated_keys(spark, d):
    """Keys that occur more than once."""
    return entities.duplicates(T(spark, d, "customer").select(F.col("c_nationkey").alias("k")), ["k"])


@query("""with r as (select o_orderkey as pos, 'league ' || o_custkey as key, 'H' || (o_orderkey % 2 + 1) as period, case when o_orderkey % 3 = 0 then '' else 'kind ' || (o_orderkey % 5) end as deal_type, case when o_orderkey % 4 = 0 then 'M' || o_orderkey else '' end as master,
 o_orderkey % 7 as rep, case o_orderkey % 3 when 0 then 'Sweden' when 1 then 'DACH / uk' else '' end as territory from orders),
t as (select key, list_sort(list_distinct(flatten(list(case territory when 'Sweden' then ['sweden'] when 'DACH / uk' then ['austria', 'germany', 'switzerland', 'united kingdom'] else []::varchar[] end)))) as c from r group by 1)
select key as league_key, period, min(pos) as first_pos, coalesce(arg_min(deal_type, pos) filter (where deal_type <> ''), '') as deal_type, coalesce(arg_min(master, pos) filter (where master <> ''), '') as master_opportunity,
 case when arg_min(rep, pos) < 5 then 'U' || arg_min(rep, pos) else '' end as owner, array_to_string(any_value(c), ',') as countries from r join t using (key) group by 1, 2""")
def period_deals(spark, d):
    """A deals sheet matched and grouped by league and period: the first row's person owns the deal, first values count, territories unite."""
    k = F.col("o_orderkey")
    when = lambda n, v: F.when(k % n == 0, v).otherwise("")
    rows = T(spark, d, "orders").select(
        k.alias("src_pos"), F.concat(F.lit("League "), F.col("o_custkey").cast("string")).alias("league"), F.concat(F.lit("H"), (k % 2 + 1).cast("string")).alias("period"), F.when(k % 3 == 0, " ").otherwise(F.concat(F.lit("kind "), (k % 5).cast("string"))).alias("deal_type"), when(4, F.concat(F.lit("M"), k.cast("string"))).alias("master_opportunity"),
        F.concat(F.lit("Rep number "), (k % 7).cast("string")).alias("rep_name"), F.element_at(F.array(F.lit("Sweden"), F.lit("DACH / uk"), F.lit("")), (k % 3 + 1).cast("int")).alias("territory"), F.col("o_totalprice").alias("arr_eur"), F.lit("").alias("target_close"), F.lit("").alias("account_ref"), F.lit("Soccer").alias("sport"),
    )
    users = [{"id": f"U{i}", "name": f"Rep number {i}", "is_active": ""} for i in range(5)] + [{"id": "U6", "name": "Rep number 6", "is_active": "no"}]
    nothing = "src_pos long, id string, other_id string, name string, country string"
    found = jobs.crosscheck(spark, rows, C.Settings(manual_ids_csv="/none", aliases_csv="/none"), lookups.MemorySource(spark, users=users), pool=spark.createDataFrame([], nothing))
    out = jobs.periods(found).join(found.results.select("league_key", "countries"), "league_key")
    return out.select("league_key", "period", "first_pos", "deal_type", "master_opportunity", "owner", F.array_join(F.array_sort("countries"), ",").alias("countries"))


@query("""select 'by name' as way, 'U' || c_custkey as id from customer where c_name = 'Customer#000000007' union all select 'by id', '005000000000000' union all select 'one record', 'U' || c_custkey from customer where c_custkey = 9 union all select 'record type', 'R' || r_regionkey from region where r_name = 'ASIA' union all select 'fallback', 'known'""")
def point_lookups(spark, d):
    """Owners by name or id, single records, record types with a fallback."""
    c = T(spark, d, "customer")
    users = c.select(F.concat(F.lit("U"), F.col("c_custkey").cast("string")).alias("id"), F.col("c_name").alias("name"), F.lit("").alias("is_active"), "c_custkey")
    types = T(spark, d, "region").select(F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("id"), F.col("r_name").alias("name"))
    found = [("by name", lookups.owner_id(users, "Customer#000000007")), ("by id", lookups.owner_id(users, "005000000000000")), ("one record", lookups.one_record(users.where("c_custkey = 9"), "user 9")["id"]), ("record type", lookups.record_type_id(types, "ASIA", {})), ("fallback", lookups.record_type_id(types, "x", {"x": "known"}))]
    return spark.createDataFrame(found, "way string, id string")


# ---------------------------------------------------------------- products
def _price_rows(spark, d) -> DataFrame:
    """A price book: families in tiers, the sport family's products, and one product a part."""
    fixed = [("Alpha LITE", 1000.0), ("Alpha PRO", 3000.0), ("Alpha PRO PLUS", 5000.0), ("Alpha 20 TEAMS", 90000.0), ("Beta PRO", 2000.0), ("Beta", 100.0), ("Exchange", 0.0), ("Metrics Basketball credits for league wide usage", 10.0),
             ("Metrics Handball for league wide usage", 20.0), ("Metrics Handball", 30.0), ("Metrics Ice Hockey small", 40.0), ("Metrics Soccer credits for league wide usage", 50.0)]
    own = spark.createDataFrame([(i, n, p) for i, (n, p) in enumerate(fixed)], "src_pos long, product string, list_price double")
    p = T(spark, d, "part").select((F.col("p_partkey") + 1000).alias("src_pos"), F.concat(F.lit("Part "), F.col("p_partkey").cast("string")).alias("product"), F.col("p_retailprice").alias("list_price"))
    return own.unionByName(p)


#: A made-up deployment's dictionaries.
PRODUCTS = C.Products(
    aliases={"small": "Alpha LITE", "middle": "Alpha PRO", "middle plus": "Alpha PRO PLUS", "swap": "Exchange"}, features={"colour wheel": "Beta", "number sheet": "Metrics"}, families=["Alpha", "Beta", "Metrics", "Exchange"],
    sport_family="Metrics", sports={"soccer": "Soccer", "handball": "Handball", "basketball": "Basketball", "ice hockey": "Ice Hockey"}, default_sport="Soccer", fallback_family="Alpha",
)


#: Case by case: a cell and a sport, the products that its tokens lead to, their notes.
_CELLS = [
    ("Part {k}", "", ["Part {k}"], ["exact"]),
    ("part {k}, PART {k}; ", "", ["Part {k}", "Part {k}"], ["exact", "exact+"]),
    ("Alpha & colour wheel", "", ["Alpha PRO PLUS", "Beta"], ["family-highest-tier", "feature-mapped"]),
    ("maybe middle (2 teams) and small", "", ["Alpha PRO", "Alpha LITE"], ["family-highest-tier", "family-highest-tier"]),
    ("middle plus {k}", "", ["Alpha PRO"], ["family-highest-tier"]),
    ("metrics", "Basketball / Spain", ["Metrics Basketball credits for league wide usage"], ["family-highest-tier"]),
    ("Metrics", "handball", ["Metrics Handball for league wide usage"], ["family-highest-tier"]),
    ("number sheet", "Ice Hockey", ["Metrics Ice Hockey small"], ["feature-mapped"]),
    ("Metrics {k}", "Chess", ["Metrics Soccer credits for league wide usage"], ["family-highest-tier"]),
    ("betamax {k}", "", ["Beta"], ["family-highest-tier"]),
    ("nonsense {k}", "", [None], ["unresolved"]),
    ("note: Swap.", "", ["Exchange"], ["family-highest-tier"]),
]


def _cell_sql() -> str:
    rows = []
    for i, (_, _, found, notes) in enumerate(_CELLS):
        for j, (f, n) in enumerate(zip(found, notes, strict=True)):
            product = "null::varchar" if f is None else "'" + f.replace("{k}", "' || p_partkey || '") + "'"
            rows.append(f"select p_partkey as k, {j} as token_pos, {product} as product, '{n.strip('+')}' as note, {'true' if n.endswith('+') else 'false'} as duplicate from part where p_partkey % {len(_CELLS)} = {i}")
    return " union all ".join(rows)


def _cells(spark, d) -> DataFrame:
    k = F.col("p_partkey")
    fill = lambda t: F.replace(F.lit(t), F.lit("{k}"), k.cast("string"))
    return T(spark, d, "part").select(k.cast("string").alias("key"), _case(k, [fill(x[0]) for x in _CELLS]).alias("cell"), _case(k, [F.lit(x[1]) for x in _CELLS]).alias("sport"))


@query(_cell_sql())
def product_cascade(spark, d):
    """Product cells resolved: exact names, features, aliases and their prefixes, families, sport variants; repeats are marked."""
    book = written(_price_rows(spark, d), "book")
    found = products.resolve_cells(_cells(spark, d), book, PRODUCTS).join(book.select(F.col("src_pos").alias("product_pos"), "product"), "product_pos", "left")
    return found.select(F.col("key").cast("long").alias("k"), "token_pos", "product", "note", "duplicate")


@query(f"""with f as ({_cell_sql()}), l as (select k, token_pos, product from f where product is not null and not duplicate), n as (select *, row_number() over (partition by k order by token_pos) as line from l),
 x as (select k, product, line from n union all select p_partkey, 'Alpha PRO PLUS', 1 from part where p_partkey % {len(_CELLS)} = {len(_CELLS) - 2} and p_partkey % 5 > 0)
select k, product, line::int as line from x""")
def product_lines(spark, d):
    """Lines of each cell in order, and the fallback family's top product where a cell with an amount led to none."""
    book = written(_price_rows(spark, d), "book")
    lines = products.resolved_products(products.resolve_cells(_cells(spark, d), book, PRODUCTS), book)
    k = F.col("p_partkey")
    totals = T(spark, d, "part").select(k.cast("string").alias("key"), (k % 5).cast("double").alias("total_arr"))
    return products.with_fallback(lines, totals, book, PRODUCTS).select(F.col("key").cast("long").alias("k"), "product", "line")


@query("""with b as (select 'Part ' || (p_partkey // 2) as product, p_retailprice as price, p_partkey as pos, p_partkey % 2 as odd from part), e as (select product, arg_max(price, pos) as price from b group by 1)
select p_partkey as k, case when p_partkey % 4 = 3 then null else price end as price from part left join e on product = 'Part ' || p_partkey""")
def price_lookup(spark, d):
    """Prices by exact name, else in lower case; of entries of one name the last counts."""
    p = T(spark, d, "part")
    k = F.col("p_partkey")
    book = p.select(F.concat(F.lit("Part "), F.floor(k / 2).cast("string")).alias("product"), F.col("p_retailprice").alias("list_price"), k.alias("src_pos"))
    key = k.cast("string")
    lines = p.select(k.alias("k"), _case(k, [F.concat(F.lit("Part "), key), F.concat(F.lit("PART "), key), F.concat(F.lit("part "), key), F.concat(F.lit("Parts "), key)]).alias("product_name"))
    return products.priced(lines, book).select("k", F.col("book_list_price").alias("price"))


@query("""select p_partkey as k, case when p_partkey % 2 = 0 then (10 + p_partkey % 3)::double end as unit_price from part""")
def discount_prices(spark, d):
    """Discounted prices by product; a line without a product has none."""
    p = T(spark, d, "part")
    k = F.col("p_partkey")
    lines = p.select(k.alias("k"), F.when(k % 2 == 0, F.concat(F.lit("P"), (k % 3).cast("string"))).alias("book_product"), F.lit(1.0).alias("book_list_price"))
    return lines.select("k", products.unit_price("discount", discounts={f"P{i}": 10.0 + i for i in range(3)}).alias("unit_price"))


@query("""select n_nationkey as truth_pos, 'A' || s_suppkey as row_id, case s_suppkey % 3 when 0 then 'alias' when 1 then 'acronym' else 'normalised' end as match_type from supplier join nation on n_nationkey = s_nationkey""")
def club_dictionaries(spark, d):
    """A club a nation that has suppliers, found by its alias, by its acronym and through a normaliser of the deployment; the dictionaries have an entry a nation."""
    nations = T(spark, d, "nation").join(T(spark, d, "supplier"), F.col("s_nationkey") == F.col("n_nationkey"), "left_semi").select("n_nationkey", "n_name")
    known = [(r["n_nationkey"], f"Zq {r['n_name']} Town") for r in nations.collect()]  # configuration: one club a nation
    names = C.Names(club_aliases={club: ["Nobody", f"Nick {club}"] for _, club in known}, club_acronyms={club.lower(): f"qx{k}" for k, club in known})
    club = F.concat(F.lit("Zq "), "n_name", F.lit(" Town"))
    k = F.col("s_suppkey")
    name = F.when(k % 3 == 0, F.concat(F.lit("Nick "), club)).when(k % 3 == 1, F.concat(F.lit("QX"), F.col("n_nationkey").cast("string"))).otherwise(F.concat(F.lit("Verein "), club))
    rows = T(spark, d, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(k.alias("src_pos"), F.concat(F.lit("A"), k.cast("string")).alias("id"), name.alias("name"), F.lit("").alias("domain"))
    truth = nations.select(F.col("n_nationkey").alias("src_pos"), club.alias("name"), F.lit("").alias("domain"))
    own = lambda c: normalise_club(F.regexp_replace(c, "^Verein ", ""))
    return clubs.match(truth, rows, own, names).select("truth_pos", "row_id", "match_type")
