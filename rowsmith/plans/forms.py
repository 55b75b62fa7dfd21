"""Queries over single functions and small operators: texts are put together from the tables' keys and names by
templates, and the SQL says what each template must become."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith import config as C
from rowsmith.functions import amounts, clubs, geo, text
from rowsmith.operators import match
from rowsmith.plans.registry import T, query


def _sql_text(template: str, key: str) -> str:
    """A template as SQL: {k} stands for the key, {c} for the letter that belongs to it."""
    return "'" + template.replace("'", "''").replace("{k}", f"' || {key}::varchar || '").replace("{c}", f"' || chr((97 + {key} % 26)::int) || '") + "'"


def _text(template: str, key: Column) -> Column:
    parts: list[Column] = []
    for i, piece in enumerate(template.replace("{k}", "\0k\0").replace("{c}", "\0c\0").split("\0")):
        if i % 2 == 0:
            parts.append(F.lit(piece))
        else:
            parts.append(key.cast("string") if piece == "k" else F.chr((97 + key % 26).cast("int")))
    return F.concat(*parts)


def given(templates: list[tuple[str, ...]], at: int, key: Column) -> Column:
    """The text that row ``key`` holds: template key % n, its part ``at``."""
    return F.element_at(F.array(*[_text(t[at], key) for t in templates]), (key % len(templates) + 1).cast("int"))


def wanted(templates: list[tuple[str, ...]], at: int, key: str) -> str:
    return f"case {key} % {len(templates)} " + " ".join(f"when {i} then {_sql_text(t[at], key)}" for i, t in enumerate(templates)) + " end"


def forms(table: str, key: str, functions: dict[str, tuple[list[tuple[str, ...]], object]]):
    """A query that gives, per row of ``table``, each function's value of its texts, and the SQL that states it.

    functions: name to (templates, function of the texts); a template's last part is what must come out."""
    cols = [f"{wanted(t, -1, key)} as {name}" for name, (t, _) in functions.items()]

    def run(spark, d) -> DataFrame:
        k = F.col(key)
        out = [f(*[given(t, i, k) for i in range(len(t[0]) - 1)]).cast("string").alias(name) for name, (t, f) in functions.items()]
        return T(spark, d, table).select(key, *out)

    return run, f"select {key}, {', '.join(cols)} from {table}"


def register(name: str, doc: str, table: str, key: str, functions) -> None:
    run, sql = forms(table, key, functions)
    run.__name__, run.__doc__ = name, doc
    query(sql)(run)


_WORDS = lambda f: lambda *x: F.array_join(F.array_sort(f(*x)), " ")

register("league_names", "League names made canonical, stripped, and taken apart.", "part", "p_partkey", {
    "normalised": ([("  The Region {k} Conf. ", "region {k} conference"), ("Zone {c} & Co-op Leagues (ZC{k})", "zone {c} and co op league"), ("Intercol. Ath Assocs {c}12x", "intercol athletic association {c} 12 x"), ("Big Twelve {k} conferences", "big 12 {k} conference"), ("", "")], text.normalise_league),
    "stripped": ([("Region {k} Mens Soccer D1", "region {k}"), ("Women's Ice Hockey League {k}", "league {k}"), ("Soccer Hockey", "soccer hockey"), ("NAIA Zone-{c} Football, M & W", "zone {c}")], text.strip_sport_division),
    "paren": ([("Big Region {k} (BR {k}) ", "BR {k}"), ("Big Region {k}", ""), ("(a) Region {k} (b) c", ""), ("Region ()", "")], text.paren),
    "acronym": ([("Big Region {k} (BR{k})", "br{k}"), ("Region {k} (X)", ""), ("Region (a name that is long {k})", ""), ("Region", "")], text.acronym),
    "words": ([("the region of 0{k}zone and aaland league", "0{k}zone aaland region"), ("of the to", ""), ("aaa aaa b{c} ccc", "aaa ccc")], _WORDS(text.significant_words)),
    "core": ([("the region {k} conference of {c}", "region {k} {c}"), ("league of the association", "")], text.core),
    "tail_base": ([("{c}aa north of bbb {c}nb", "{c}aa north of bbb"), ("{c}aa north of bbb {c}nob", "{c}aa north of bbb"), ("{c}aa north of bbb xy{c}", "{c}aa north of bbb xy{c}"), ("zone {k}", "zone {k}")], lambda x: text.trailing_acronym(x)["base"]),
    "tail_acronym": ([("{c}aa north of bbb {c}nb", "{c}nb"), ("{c}aa north of bbb {c}nob", "{c}nob"), ("{c}aa north of bbb xyz{c}", ""), ("zone {k}", "")], lambda x: text.trailing_acronym(x)["acronym"]),
    "initials": ([("The {c}aa Group of North Conf. (x{k})", "{c}gnc"), ("{c}iga de la 1st Zone", "{c}1sz"), ("of the", "")], text.initials),
    "division": ([("Zone {k} D-III", "d3"), ("NCAA d 2 zone {k}", "d2"), ("Zone DI {c}", "d1"), ("naia {k}", "naia"), ("NJCAA", "njcaa"), ("zone {k} d4", "")], text.division),
    "junk": ([("Zone {k} Men's  Soccer", r"matches junk pattern: \bmen'?s\s+soccer\b"), ("test {k}", r"matches junk pattern: ^test\b"), (" ", "empty name"), (" x ", "too-short name: x"), ("please MERGE {k}", r"matches junk pattern: \bmerge\b"), ("Zone {k}", "")], lambda x: F.coalesce(text.junk_reason(x), F.lit(""))),
    "run": ([("b {c} c", "a b {c} c d", "true"), ("{c} d", "a b {c} c d", "false"), ("", "a", "false"), ("a{k}", "a{k}", "true")], text.token_run),
    "ratio": ([("aa bb c{k}", "aa bb c{k} dd", "0.75"), ("aa", "bb", "0.0"), ("", "", "0.0"), ("{c}x yy", "yy {c}x", "1.0")], lambda a, b: text.overlap_ratio(text.tokens(a), text.tokens(b))),
    "safe": ([("ABC", "abc", "north zone", "true"), ("North Zone {k}", "north zone {k}", "north zone east", "true"), ("North Zone East", "north zone east", "south west rim", "false"), ("NORTHERN", "northern", "south", "false")], lambda n, m, w: text.acronym_safe(n, m, text.significant_words(w))),
})

register("club_names", "Club names made canonical.", "part", "p_partkey", {
    "normalised": ([("The Cáfe​ Städt {k} G.m.b.H.", "cafe stadt {k}"), ("Sociedad Anonima Deportiva {c}-{k}", "{c} {k}"), ("{c}’s & Co/{k} S.p.A.", "{c}s and co {k}"), ("1. FC Żółć {k} e.V.", "1 fc zołc {k}"), ("", "")], clubs.normalise_club),
    "visible": ([("a​{k}﻿­b", "a{k}b"), ("{c}", "{c}")], clubs.strip_invisible),
    "prefixed": ([("stadt x{k} fc sc", "fc sc stadt x{k}"), ("{c} afc", "afc {c}"), ("fk", "fk"), ("zone x{k}", "zone x{k}")], clubs.prefix_first),
    "close": ([("stadtteil{k}x", "stadtteil{k}y", "true"), ("abc{c}", "abd{c}", "false"), ("stadtteil nord{c}", "stadtteil mort{c}", "true"), ("stadtteil nord{c}", "stadtteil moll{c}", "false"), ("{c}", "{c}", "true")], clubs.close),
    "domain": ([("https://user@www.{c}{k}.example:80/x?y#z", "{c}{k}.example"), (" .WWW.{c}.example/x ", "{c}.example"), ("{c}{k}.example", "{c}{k}.example"), ("", "")], clubs.clean_domain),
    "related": ([("{c}.example", "x.{c}.example", "true"), ("x{c}.example", "{c}.example", "false"), ("", "", "false"), ("{k}.example", "{k}.example", "true")], clubs.domains_match),
    "email_domain": ([("me@{c}.example", "{c}.example"), ("a@b@X{k}.Example ", "x{k}.example"), ("none", "")], text.email_domain),
    "words": ([("0{c}aa football club of bb{k}", "0{c}aa bb{k}"), ("the club", "")], lambda x: F.array_join(F.array_sort(text.significant_words(x, C.CLUB_STOPWORDS)), " ")),
})

register("field_values", "Ids, names, numbers and kinds as typed by hand.", "part", "p_partkey", {
    "record_id": ([("https://x.example/lightning/r/Account/001{c}00000000000/view", "001{c}00000000000"), ("001{c}00000000000AAA", "001{c}00000000000AAA"), (" deal {k} ", "deal {k}")], text.record_id),
    "sheet_id": ([("https://docs.example/spreadsheets/d/a-b_{k}/edit#gid=0", "a-b_{k}"), (" id{k} ", "id{k}")], text.sheet_id),
    "url": ([("001{k}", "https://x.example/lightning/r/Account/001{k}/view")], lambda x: text.record_url("https://x.example/", "Account", x)),
    "escaped": ([('say "{k}"', 'say \\"{k}\\"'), ("{c}", "{c}")], text.escaped),
    "slug": ([("  A {k}/b! ", "a-{k}-b"), ("--", "")], text.slug),
    "config_gender": ([("Womens_{k}", "Womens"), ("zone-men-{k}", "Mens"), ("mental {k}", "")], text.gender_of),
    "truthy": ([(" Yes", "true"), ("{k}x", "false"), ("1", "true"), ("Y ", "true")], text.truthy),
    "whole": ([("{k}.0", "{k}"), ("-{k}", "-{k}"), ("{c}", "0"), ("", "0")], amounts.lenient_int),
    "price": ([("{k},25", "{k}.25"), ("{k}.25", "{k}.25"), ("{k},2{c}x", "none")], lambda x: F.coalesce(amounts.price(x).cast("string"), F.lit("none"))),
    "source": ([("a{k}", "", "Accounts only"), ("", "b{k}", "Companies only (no account id)"), ("a{k}", "b{k}", "Companies + Accounts"), ("", "", "")], lambda a, b: amounts.match_source(a != "", b != "")),
    "country": ([(" Deutschland ", "germany"), ("U.K.", "united kingdom"), ("Sweden", "sweden"), ("Atlantis {k}", "")], geo.country),
    "plan_region": ([("Tariffs to US for cam {k}", "US"), ("Shipping to Sweden of cam {k}", "Sweden"), ("Shipping to Europe for x", "Europe"), ("to Americas {k}", "Americas-nonUS"), ("{k}", "")], geo.plan_region),
    "plan_camera": ([("Tariffs to US for Cam {c}{k} (with mic)", "cam {c}{k}"), ("Shipping to Sweden of Stream Encoder", "encoder"), ("{k}", "")], geo.plan_camera),
    "camera": ([(" Cam {k} (WITH MIC) ", "cam {k}"), ("Stream encoder", "encoder")], geo.shipping_camera),
    "label": ([("  Rep \n Name {k} ", "Rep Name {k}"), ("{c}", "{c}")], text.squeeze),
})


@query("""select p_partkey, p_retailprice::varchar as given, case when round(p_retailprice, 2) = floor(p_retailprice) then floor(p_retailprice)::bigint::varchar else printf('%.2f', p_retailprice) end as shown,
 printf('%.2f', p_retailprice) as cents, floor(p_retailprice)::bigint::varchar as floor_shown from part""")
def money_text(spark, d):
    """Prices as text: whole numbers without decimals, others with two."""
    p = F.col("p_retailprice")
    return T(spark, d, "part").select("p_partkey", p.cast("string").alias("given"), amounts.money(p).alias("shown"), amounts.cents(p).alias("cents"), amounts.money(F.floor(p).cast("double")).alias("floor_shown"))


@query("""select c_custkey as src_pos from customer where case c_custkey % 4 when 0 then c_mktsegment in ('AUTOMOBILE', 'BUILDING') when 1 then true when 2 then c_mktsegment in ('MACHINERY') else false end""")
def league_pool(spark, d):
    """Accounts that look like leagues by their type or, without one, by their name."""
    k, s = F.col("c_custkey"), F.col("c_mktsegment")
    kind = F.when(k % 4 == 0, F.when(s.isin("AUTOMOBILE", "BUILDING"), "Sports FEDERATION").otherwise("Club")).otherwise("")
    name = F.when(k % 4 == 0, "x league").when(k % 4 == 1, F.concat(F.lit("Liga "), k.cast("string"))).when(k % 4 == 2, F.when(s == "MACHINERY", "North Conference").otherwise("Team")).when(k % 8 == 3, "").otherwise("Town")
    return match.league_candidates(T(spark, d, "customer").select(k.alias("src_pos"), name.alias("name"), kind.alias("org_type"))).select("src_pos")
