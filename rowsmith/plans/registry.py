"""The library's queries over the TPC-H-like tables, and their SQL.

The tables hold no customer records, so each query shows an operator on its closest analogue."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowsmith.functions import amounts, clubs, geo, text
from rowsmith.operators import blocking, changes, entities, exclusive, match, overlap, products
from rowsmith.operators import clubs as club
from rowsmith.operators.plan import pruned
from rowsmith.plans.tables import written
from rowsmith.sources import lookups

_Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        _Q[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f
    return add


def T(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_NORM = r"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim({c})),
  '^the\s+', ''), '&', 'and', 'g'), '[-.,]', ' ', 'g'), '([a-z])([0-9])', '\1 \2', 'g'), '([0-9])([a-z])', '\1 \2', 'g'), '\s+', ' ', 'g'))"""


def _sql_norm(c: str) -> str:
    return _NORM.replace("{c}", c)


# ---------------------------------------------------------------- scalar functions
@query(f"""select s_suppkey, {_sql_norm('s_name')} as norm, trim(regexp_replace({_sql_norm('s_name')}, '\\bsupplier#?\\b', '')) as without from supplier""")
def norm_name(spark, d):
    """League normaliser and generic-word removal on supplier names."""
    n = text.normalise_league(F.col("s_name"))
    return T(spark, d, "supplier").select("s_suppkey", n.alias("norm"), F.trim(F.regexp_replace(n, r"\bsupplier#?\b", "")).alias("without"))


@query("""select item_id, array_to_string(list_sort(list_distinct(list_filter(string_split(trim(regexp_replace(lower(regexp_replace(text, '[.,]', ' ', 'g')), '\\s+', ' ', 'g')), ' '),
  lambda x: length(x) > 2 and not list_contains(['the','of','and','for','in','to','on','at','conference','league','athletic','association','intercollegiate','collegiate','division'], x)))), ' ') as words from benchmark""")
def token_sets(spark, d):
    """Significant words of benchmark texts."""
    n = text.squeeze(F.lower(F.regexp_replace("text", "[.,]", " ")))
    return T(spark, d, "benchmark").select("item_id", F.array_join(F.array_sort(text.significant_words(n)), " ").alias("words"))


@query("""select o_orderkey, round(o_totalprice, 2) as us, round(o_totalprice, 2) as eu, round(o_totalprice, 2) as plain, case when round(o_totalprice, 0) >= 1000 then round(o_totalprice, 0) else round(o_totalprice, 0) end as thousands from orders""")
def parse_amount(spark, d):
    """Totals written in four ways and read back."""
    o = T(spark, d, "orders")
    whole, rest = F.floor(F.round("o_totalprice", 2)).cast("long"), F.lpad((F.round(F.round("o_totalprice", 2) * 100) % 100).cast("int").cast("string"), 2, "0")
    us = F.concat(F.format_number(whole, 0), F.lit("."), rest)
    eu = F.concat(F.lit("€ "), F.replace(F.format_number(whole, 0), F.lit(","), F.lit(".")), F.lit(","), rest)
    plain = F.concat(whole.cast("string"), F.lit(","), rest)
    return o.select("o_orderkey", *[amounts.amount(x).alias(n) for x, n in ((us, "us"), (eu, "eu"), (plain, "plain"), (F.format_number(F.round("o_totalprice", 0).cast("long"), 0), "thousands"))])


@query("""select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as a, strftime(o_orderdate, '%Y-%m-%d') as b, strftime(o_orderdate, '%Y-%m-%d') as c, strftime(o_orderdate, '%Y-%m-%d') as d from orders""")
def parse_dates(spark, d):
    """Order dates written in four ways and read back."""
    f = lambda p: amounts.iso_date(F.date_format("o_orderdate", p))
    return T(spark, d, "orders").select("o_orderkey", f("yyyy-MM-dd HH:mm:ss").alias("a"), f("MMMM d, yyyy").alias("b"), f("M/d/yyyy").alias("c"), f("MMM d yyyy").alias("d"))


@query("""select page_id, regexp_replace(regexp_replace(regexp_replace(lower(url), '^https?://', ''), '[/?#].*$', ''), '^www\\.', '') as host from pages""")
def domain_clean(spark, d):
    """Hosts of page addresses."""
    return T(spark, d, "pages").select("page_id", clubs.clean_domain(F.col("url")).alias("host"))


@query("""with h as (select page_id, regexp_replace(regexp_replace(regexp_replace(lower(url), '^https?://', ''), '[/?#].*$', ''), '^www\\.', '') as host from pages),
s as (select distinct regexp_replace(host, '^[^.]*\\.', '') as parent from h)
select page_id, parent, host = parent as equal from h join s on host = parent or ends_with(host, '.' || parent)""")
def domain_suffix_join(spark, d):
    """Page hosts against the parent domains of all hosts."""
    h = T(spark, d, "pages").select(F.col("page_id").alias("id"), clubs.clean_domain(F.col("url")).alias("domain"))
    s = h.select(F.regexp_replace("domain", r"^[^.]*\.", "").alias("domain")).distinct().withColumn("id", F.col("domain"))
    return blocking.domain_relatives(h, s).where("equal or true").select(F.col("a").alias("page_id"), F.col("b").alias("parent"), "equal").join(h.select(F.col("id").alias("page_id"), F.col("domain").alias("host")), "page_id").where((F.col("host") == F.col("parent")) | F.endswith("host", F.concat(F.lit("."), "parent"))).select("page_id", "parent", "equal")


@query("""select event_id, coalesce(json_extract_string(props, '$.k'), '') as k from events""")
def json_prop(spark, d):
    """A field of JSON text under a standard name, by the headers that may hold it; missing ones are empty."""
    raw = T(spark, d, "events").select("event_id", F.from_json("props", "struct<k:string>").alias("p")).select("event_id", F.col("p.k").alias("K "))
    return raw.select("event_id", *lookups.mapped_columns(raw, {"k": ["key", "k"]}))


@query("""select doc_id, lower(strip_accents(text)) as folded from documents""")
def nfkd_fold(spark, d):
    """Accents folded away."""
    return T(spark, d, "documents").select("doc_id", F.lower(clubs.fold(F.col("text"))).alias("folded"))


@query("""select c_custkey, case c_nationkey % 5 when 0 then 'CA' when 1 then 'SE' when 2 then 'DE' when 3 then 'NO' else 'Atlantis' end as code,
 case c_nationkey % 5 when 2 then 'tax_reg_nr' else 'org_nr' end as tax, case c_nationkey % 5 when 0 then 'Americas-nonUS' when 1 then 'Sweden' when 2 then 'Europe' when 3 then 'Europe' else 'Americas-nonUS' end as region from customer""")
def country_fields(spark, d):
    """Country codes, tax fields and shipping regions."""
    c = F.element_at(F.array(*[F.lit(x) for x in (" Canada", "sweden", "GERMANY", "Norway", "Atlantis")]), F.col("c_nationkey") % 5 + 1)
    return T(spark, d, "customer").select("c_custkey", geo.country_code(c).alias("code"), geo.tax_field(c).alias("tax"), geo.shipping_region(c).alias("region"))


@query("""select c_custkey, case c_custkey % 4 when 0 then 'Mens' when 1 then 'Womens' when 2 then 'Mens and Womens' else '' end as gender, split_part(c_name, '#', 1) as first, '000' || right(c_name, 3) as last from customer where false
 union all select c_custkey, case c_custkey % 4 when 0 then 'Mens' when 1 then 'Womens' when 2 then 'Mens and Womens' else '' end, split_part(c_name, '#', 1), split_part(c_name, '#', 2) from customer""")
def person_fields(spark, d):
    """Genders and split names."""
    g = F.element_at(F.array(*[F.lit(x) for x in ("boys", "Women's", "M/W", "?")]), (F.col("c_custkey") % 4 + 1).cast("int"))
    n = text.split_name(F.replace("c_name", F.lit("#"), F.lit("  ")), repeat_single=True)
    return T(spark, d, "customer").select("c_custkey", geo.team_gender(g).alias("gender"), n["first"].alias("first"), n["last"].alias("last"))


@query("""select doc_id, case when n_chars < 300 then 'Low' when n_chars < 3000 then 'Medium' else 'High' end as label,
 case when doc_id % 3 = 0 then 'Renewal' when doc_id % 3 = 1 then 'Upsell' else 'New' end as kind from documents""")
def classifications(spark, d):
    """Confidence labels and deal kinds."""
    s = F.when(F.col("n_chars") < 300, 50).when(F.col("n_chars") < 3000, 70).otherwise(90)
    k = F.element_at(F.array(F.lit("to RENEW"), F.lit("Expansion"), F.lit("first")), (F.col("doc_id") % 3 + 1).cast("int"))
    return T(spark, d, "documents").select("doc_id", amounts.confidence(s).alias("label"), amounts.deal_kind(k).alias("kind"))


@query("""select c_custkey, array_to_string(list_sort(map_keys(m)), ',') as kept from (
 select c_custkey, map_from_entries(list_filter([{'k': 'name', 'v': c_name}, {'k': 'segment', 'v': case when c_custkey % 2 = 0 then '' else c_mktsegment end}, {'k': 'zero', 'v': '0.0'}], lambda e: e.v <> '')) as m from customer)""")
def prune_fields(spark, d):
    """Empty payload fields dropped, zeros kept."""
    m = F.create_map(F.lit("name"), F.col("c_name"), F.lit("segment"), F.when(F.col("c_custkey") % 2 == 0, "").otherwise(F.col("c_mktsegment")), F.lit("zero"), F.lit(0.0).cast("string"))
    return T(spark, d, "customer").select("c_custkey", F.array_join(F.array_sort(F.map_keys(pruned(m))), ",").alias("kept"))


# ---------------------------------------------------------------- grouping
@query("""select p_name, min(p_partkey) as first_key, arg_min(p_brand, p_partkey) as first_brand,
 array_to_string(list_transform(list_sort(list({'k': k, 'b': p_brand})), lambda x: x.b), ';') as brands from (
 select p_name, p_brand, min(p_partkey) as k, min(p_partkey) as p_partkey from part group by p_name, p_brand) group by p_name""")
def dedupe_first(spark, d):
    """Parts by name: first key and brand, brands in order of first sight."""
    p = F.col("p_partkey")
    return T(spark, d, "part").groupBy("p_name").agg(F.min(p).alias("first_key"), entities.first_nonblank(F.col("p_brand"), p).alias("first_brand"), F.array_join(entities.ordered_distinct(F.col("p_brand"), p), ";").alias("brands"))


_HALF = "'H' || (case when month(o_orderdate) <= 6 then '1' else '2' end) || ' ' || year(o_orderdate)"


@query(f"""select o_custkey, {_HALF} as period, count(*) as n, round(sum(o_totalprice), 2) as total, min(o_orderkey) as first_key from orders group by 1, 2""")
def dedupe_period(spark, d):
    """Orders by customer and half-year."""
    half = F.concat(F.lit("H"), F.when(F.month("o_orderdate") <= 6, "1").otherwise("2"), F.lit(" "), F.year("o_orderdate").cast("string"))
    return T(spark, d, "orders").groupBy("o_custkey", half.alias("period")).agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.min("o_orderkey").alias("first_key"))


@query("""select o_custkey, arg_min(o_orderpriority, o_orderkey) as priority from orders group by 1""")
def group_first_nonblank(spark, d):
    """The first priority of each customer."""
    return T(spark, d, "orders").groupBy("o_custkey").agg(entities.first_nonblank(F.col("o_orderpriority"), F.col("o_orderkey")).alias("priority"))


@query("""select coalesce(c.k, s.k) as id, coalesce(c.name, s.name) as name, case when c.k is not null then 0 else 1 end as pool from
 (select (c_custkey % 50)::varchar as k, arg_min(c_name, c_custkey) as name from customer group by 1) c full join
 (select s_suppkey::varchar as k, s_name as name from supplier) s on c.k = s.k""")
def priority_union(spark, d):
    """Customers before suppliers, one row per id."""
    a = T(spark, d, "customer").select((F.col("c_custkey") % 50).cast("string").alias("id"), F.col("c_name").alias("name"), F.col("c_custkey").alias("src_pos"))
    b = T(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("src_pos"))
    return entities.priority_union(a, b).select("id", "name", "pool")


@query("""select name, min(id) as id from (select c_mktsegment || ' ' || (c_custkey // 3) as name, 'N' || c_nationkey as id from customer) group by 1 having count(distinct id) = 1""")
def unambiguous_lookup(spark, d):
    """Names with a single id."""
    name = F.concat("c_mktsegment", F.lit(" "), F.floor(F.col("c_custkey") / 3).cast("string"))
    return entities.unambiguous(T(spark, d, "customer").select(name.alias("name"), F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("id")), "name", "id")


@query("""select p_type, arg_min(p_brand, (-n, p_brand)) as p_brand from (select p_type, p_brand, count(*) as n from part group by 1, 2) group by 1""")
def most_frequent(spark, d):
    """The most frequent brand of each type."""
    return entities.most_frequent(T(spark, d, "part"), ["p_type"], "p_brand")


@query("""select count(*) filter (where n > 0) as matched, count(*) filter (where n > 1) as matched_with_id, 0::bigint as ambiguous, count(*) filter (where n = 0) as unmatched from
 (select c_custkey, count(o_orderkey) as n from customer left join orders on o_custkey = c_custkey group by 1)""")
def report_status(spark, d):
    """Status counts."""
    n = T(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    r = T(spark, d, "customer").join(n, "c_custkey", "left").fillna(0, ["n"])
    ids = F.when(F.col("n") > 1, F.array(F.lit("x"))).otherwise(F.expr("cast(array() as array<string>)"))
    return entities.status_counts(r.select(F.when(F.col("n") > 0, "matched").otherwise("unmatched").alias("match_status"), ids.alias("account_ids")))


# ---------------------------------------------------------------- joins
@query("""select p_partkey, min(p_partkey) over (partition by p_name) as class_key from part where p_name is not null""")
def exact_join(spark, d):
    """Equal names of all parts: each part with the smallest key of its name, so two parts are equal if their class is."""
    p = T(spark, d, "part").where("p_name is not null").select("p_partkey", "p_name")
    return p.join(p.groupBy("p_name").agg(F.min("p_partkey").alias("class_key")), "p_name").select("p_partkey", "class_key")


def _words(c: str) -> str:
    return f"array_to_string(list_filter(string_split({_sql_norm(c)}, ' '), lambda t: t not in ('supplier#', 'customer#')), ' ')"


@query(f"""select s_suppkey, c_custkey from (select s_suppkey, {_words("replace(s_name, '#', '# ')")} as k from supplier) join (select c_custkey, {_words("replace(c_name, '#', '# ')")} as k from customer) using (k)""")
def core_join(spark, d):
    """Suppliers and customers by the core of their names."""
    key = lambda c: text.core(text.normalise_league(F.replace(F.col(c), F.lit("#"), F.lit("# "))), ["supplier#", "customer#"])
    return T(spark, d, "supplier").select("s_suppkey", key("s_name").alias("k")).join(T(spark, d, "customer").select("c_custkey", key("c_name").alias("k")), "k").select("s_suppkey", "c_custkey")


@query("""select doc_id, item_id from documents d join benchmark b on contains(d.text, b.text) where length(b.text) >= 8 and length(d.text) >= 8""")
def containment_join(spark, d):
    """Documents that contain a benchmark text."""
    long_ = lambda t, k: T(spark, d, t).select(F.col(k).alias("id"), F.col("text").alias("name")).where(F.length("text") >= 8)
    return blocking.contained(long_("documents", "doc_id"), long_("benchmark", "item_id")).select(F.col("outer").alias("doc_id"), F.col("inner").alias("item_id"))


@query("""with w as (select doc_id, list_sort(list_distinct(list_filter(string_split(trim(regexp_replace(lower(text), '[\\x20\\x09-\\x0D]+', ' ', 'g')), ' '), lambda x: length(x) > 2))) as l from documents where text is not null),
c as (select doc_id, len(l) as n, l, min(doc_id) over (partition by l) as first from w where len(l) >= 2),
e as (select doc_id, n, unnest(l) as t from c where doc_id = first),
p as (select a.doc_id as a, b.doc_id as b, any_value(a.n) as na, any_value(b.n) as nb, count(*) as common from e a join e b on a.t = b.t and a.doc_id < b.doc_id group by 1, 2)
select a, b, common from p where 100 * common >= 80 * greatest(na, nb) union all select first, doc_id, n from c where first < doc_id""")
def overlap_join(spark, d):
    """Documents with four fifths of their words in common: pairs of the first documents of each set of words, and every other document with its first one."""
    texts = T(spark, d, "documents").where("text is not null").select(F.col("doc_id").alias("id"), F.lower("text").cast("binary").alias("text"))
    return overlap.overlapping(texts)


@query("""with n as (select distinct p_name as name from part where length(p_name) >= 8)
select a.name as a, b.name as b from n a join n b on a.name < b.name and abs(length(a.name) - length(b.name)) <= 2
 where levenshtein(a.name, b.name) <= case when least(length(a.name), length(b.name)) >= 12 then 2 else 1 end""")
def edit_distance_join(spark, d):
    """Part names one or two edits apart."""
    n = T(spark, d, "part").select(F.col("p_name").alias("id"), F.col("p_name").alias("name")).distinct()
    return blocking.edit_neighbours(n, n).where("a < b")


@query("""select item_id, doc_id from (select item_id, lower(split_part(text, ' ', 1)) || ' ' || lower(split_part(text, ' ', 2)) as inner_ from benchmark) b
 join (select doc_id, lower(regexp_replace(text, '\\s+', ' ', 'g')) as outer_ from documents) d on contains(' ' || outer_ || ' ', ' ' || inner_ || ' ')""")
def word_containment_join(spark, d):
    """Documents that hold a benchmark's first two words at word edges, anywhere."""
    b = T(spark, d, "benchmark").select(F.col("item_id").alias("id"), F.lower(F.concat_ws(" ", F.split_part("text", F.lit(" "), F.lit(1)), F.split_part("text", F.lit(" "), F.lit(2)))).alias("name"))
    o = T(spark, d, "documents").select(F.col("doc_id").alias("id"), F.lower(F.regexp_replace("text", r"\s+", " ")).alias("name"))
    return blocking.words_contained(o, b).select(F.col("inner").alias("item_id"), F.col("outer").alias("doc_id"))


@query("""select s_suppkey, c_custkey, case when sn.n_regionkey = cn.n_regionkey then 20 else -40 end as signal, 80 + case when sn.n_regionkey = cn.n_regionkey then 20 else -40 end as score
 from supplier join nation sn on s_nationkey = sn.n_nationkey join customer on c_custkey = s_suppkey join nation cn on c_nationkey = cn.n_nationkey""")
def country_signal(spark, d):
    """Region evidence for pairs of suppliers and customers."""
    places = ["sweden", "germany", "japan", "brazil", "canada"]
    where = F.element_at(F.array(*[F.lit(p) for p in places]), F.col("n_regionkey") + 1)
    n = T(spark, d, "nation").select(F.col("n_nationkey").alias("k"), where.alias("place"))
    s = T(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("k")).select("s_suppkey", geo.territory_countries(F.col("place")).alias("territory"))
    c = T(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("k")).select("c_custkey", F.col("place").alias("country"))
    signal = geo.country_signal(F.col("territory"), F.col("country"))
    return s.join(c, F.col("s_suppkey") == F.col("c_custkey")).select("s_suppkey", "c_custkey", signal.alias("signal"), (F.lit(80) + signal).alias("score"))


@query("""with h as (select l_suppkey, l_orderkey, l_linenumber, l_partkey, l_quantity::bigint as score from lineitem),
t as (select l_suppkey, max(score) as top from h group by 1)
select h.l_suppkey, any_value(top) as top, min(l_partkey) filter (where score = top) as best_part, count(*) filter (where score = top) as winners,
 case when count(distinct case when score = top then l_partkey end) = 1 then 'matched' else 'ambiguous' end as status from h join t using (l_suppkey) group by 1""")
def best_match(spark, d):
    """Top hit of each supplier and whether it is tied."""
    h = T(spark, d, "lineitem").select("l_suppkey", "l_partkey", F.col("l_quantity").cast("long").alias("score"))
    g = h.groupBy("l_suppkey", "score").agg(F.min("l_partkey").alias("part"), F.max("l_partkey").alias("last"), F.count("*").alias("n"))
    top = g.groupBy("l_suppkey").agg(F.max_by(F.struct("score", "part", "last", "n"), "score").alias("t"))
    return top.select("l_suppkey", F.col("t.score").alias("top"), F.col("t.part").alias("best_part"), F.col("t.n").alias("winners"), F.when(F.col("t.part") == F.col("t.last"), "matched").otherwise("ambiguous").alias("status"))


@query("""select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_orderkey % 8 = 0)""")
def orphans(spark, d):
    """Customers that no order of every eighth has matched."""
    rows = T(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("id"), "c_custkey")
    matches = T(spark, d, "orders").where("o_orderkey % 8 = 0").select(F.col("o_custkey").cast("string").alias("row_id"))
    return club.orphans(rows, matches).select("c_custkey")


@query("""select o_orderkey from orders where o_orderkey not in (select l_orderkey from lineitem where l_returnflag = 'R')""")
def unmatched(spark, d):
    """Orders that no returned line has matched."""
    truth = T(spark, d, "orders").select(F.col("o_orderkey").alias("src_pos"), F.col("o_orderpriority").alias("name"))
    matches = T(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("truth_pos"))
    return club.unmatched(truth, matches).select(F.col("src_pos").alias("o_orderkey"))


@query("""select o_orderkey from orders where o_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R')""")
def flagged(spark, d):
    """Orders with a returned line."""
    return T(spark, d, "orders").join(T(spark, d, "lineitem").where("l_returnflag = 'R'"), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_orderkey")


@query("""with u as (select c_custkey, c_mktsegment || ' ' || right(c_name, 3) as name from customer), r as (select distinct c_mktsegment || ' ' || right(c_name, 3) as rep from customer union select distinct lower(c_mktsegment) from customer union select 'nobody at all')
, h as (select rep, c_custkey, case when rep = name then 1 when lower(rep) = lower(name) then 2 when starts_with(lower(name), lower(rep) || ' ') then 3 else 4 end as p from r join u on contains(lower(name), lower(rep)) or contains(lower(rep), lower(name)))
, m as (select rep, min(p) as p from h group by 1), n as (select h.rep, count(*) as n, min(c_custkey) as one from h join m using (rep, p) group by 1)
select r.rep as rep_name, case when n = 1 then one::varchar end as user_id, case when n = 1 then 'matched' when n > 1 then 'ambiguous' else 'unmatched' end as status from r left join n on r.rep = n.rep""")
def cascade_lookup(spark, d):
    """Names of all customers looked up in four passes."""
    return _looked_up(spark, d, "true")


def _looked_up(spark, d, named):
    c = T(spark, d, "customer")
    name = F.concat("c_mktsegment", F.lit(" "), F.right("c_name", F.lit(3)))
    users = c.select(F.col("c_custkey").cast("string").alias("id"), name.alias("name"), F.col("c_custkey").alias("src_pos"))
    reps = c.where(named).select(name.alias("rep_name")).unionByName(c.select(F.lower("c_mktsegment").alias("rep_name"))).unionByName(spark.createDataFrame([("nobody at all",)], "rep_name string"))
    return entities.resolve_people(reps, users).select("rep_name", "user_id", "status")


@query("""select s_suppkey as league_pos, case when s_suppkey % 4 = 0 then 'manual' when s_suppkey % 4 = 1 then 'exact' when s_suppkey % 4 = 2 then 'alias' end as match_type, 'C' || s_suppkey as account_id from supplier join customer on c_custkey = s_suppkey where s_suppkey % 4 < 3""")
def override_priority(spark, d):
    """Curated rows in order of trust: a manual id before an id in the row before an alias."""
    s, k = T(spark, d, "supplier"), F.col("s_suppkey")
    ident = F.concat(F.lit("C"), k.cast("string"))
    label = F.concat(F.lit("zone "), F.translate(k.cast("string"), "0123456789", "abcdefghij"))
    leagues = s.select(k.alias("league_pos"), label.alias("display_name"), label.alias("league_key"), F.when(k % 4 < 2, ident).otherwise("").alias("pasted_id"))
    c = T(spark, d, "customer").select(F.col("c_custkey").alias("src_pos"), F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("id"), F.concat(F.lit("h"), F.col("c_custkey").cast("string")).alias("other_id"), F.col("c_name").alias("name"))
    manual = s.where("s_suppkey % 4 = 0").select(label.alias("league"), ident.alias("account_id"), F.lit("").alias("other_id"), F.lit("").alias("note"), k.alias("src_pos"))
    aliases = s.where("s_suppkey % 4 < 3").select(label.alias("league"), F.lit("").alias("company_name"), F.concat(F.lit("h"), k.cast("string")).alias("other_id"), F.lit("").alias("reason"), k.alias("src_pos"))
    # Manual ids stand whether or not a candidate has them; here only those of customers count.
    found = match.overrides(leagues, match.candidates(c), manual, aliases).where(F.size("account_names") > 0)
    return found.select("league_pos", "match_type", F.col("account_ids")[0].alias("account_id"))


# ---------------------------------------------------------------- products, amounts, sequences
@query("""select p_type as family, arg_min(p_partkey, (case when regexp_matches(p_name, '\\bred\\b') then 1 else 0 end, -p_retailprice, p_partkey)) as product_key from part group by 1""")
def top_tier(spark, d):
    """The dearest part of each type whose name isn't a noise variant."""
    b = T(spark, d, "part").select(F.concat("p_type", F.lit(" "), "p_name").alias("product"), F.col("p_retailprice").alias("list_price"), F.col("p_partkey").alias("src_pos"))
    types = T(spark, d, "part").select(F.col("p_type").alias("prefix")).distinct()
    return products.top_tier(b, types, r"\bred\b").select(F.col("prefix").alias("family"), F.col("src_pos").alias("product_key"))


@query("""with l as (select l_orderkey as key, l_partkey, l_linenumber, l_extendedprice, o_totalprice, count(*) over (partition by l_orderkey) as n, sum(l_extendedprice) over (partition by l_orderkey) as s from lineitem join orders on l_orderkey = o_orderkey)
select key, l_partkey, l_linenumber, round(case when n = 1 then o_totalprice when s = 0 then o_totalprice / n else l_extendedprice / s * o_totalprice end, 4) as allocated from l""")
def alloc_proportional(spark, d):
    """Order totals over lines by price."""
    l = T(spark, d, "lineitem").join(T(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("l_orderkey").alias("key"), "l_partkey", "l_linenumber", "l_extendedprice", "o_totalprice")
    return products.allocate(l, "o_totalprice", "l_extendedprice").select("key", "l_partkey", "l_linenumber", F.round("allocated", 4).alias("allocated"))


@query("""select l_orderkey as key, count(*) as n, round(max(o_totalprice), 2) as total from lineitem join orders on l_orderkey = o_orderkey group by 1""")
def conservation(spark, d):
    """What is allocated to an order's lines adds up to its total."""
    l = T(spark, d, "lineitem").join(T(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("l_orderkey").alias("key"), "l_extendedprice", "o_totalprice")
    return products.allocate(l, "o_totalprice", "l_extendedprice").groupBy("key").agg(F.count("*").alias("n"), F.round(F.sum("allocated"), 2).alias("total"))


@query("""select l_orderkey, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice)::varchar as line_number, l_partkey from lineitem""")
def sequence_per_order(spark, d):
    """Lines numbered within their order."""
    out = changes.order_of(T(spark, d, "lineitem"), ["l_orderkey"], [F.col(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")])
    return out.select("l_orderkey", F.col("sequence").cast("string").alias("line_number"), "l_partkey")


@query("""select o_orderkey, q::bigint as quantity, o_totalprice as unit_price from orders, (values (1), (-1)) v(q) where o_orderpriority = '1-URGENT'""")
def voucher_pairs(spark, d):
    """Lines of +1 and -1 at list price."""
    return T(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select("o_orderkey", F.explode(F.array(F.lit(1), F.lit(-1)).cast("array<long>")).alias("quantity"), F.col("o_totalprice").alias("unit_price"))


@query("""select p_type as camera, case n_regionkey when 0 then 'Sweden' when 1 then 'Europe' when 2 then 'US' else 'Americas-nonUS' end as region, count(*) as quantity
 from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey group by 1, 2""")
def shipping_counts(spark, d):
    """Units by product kind and shipping region."""
    place = F.element_at(F.array(*[F.lit(x) for x in ("Sweden", "Norway", "usa", "Canada", "Atlantis")]), F.col("n_regionkey") + 1)
    n = T(spark, d, "nation").select("n_nationkey", geo.shipping_region(place).alias("region"))
    s = T(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "region")
    p = T(spark, d, "part").select("p_partkey", F.col("p_type").alias("camera"))
    l = T(spark, d, "lineitem").select("l_partkey", "l_suppkey")
    return l.join(p, F.col("l_partkey") == F.col("p_partkey")).join(s, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("camera", "region").agg(F.count("*").alias("quantity"))


@query("""select p_partkey, case p_size % 3 when 0 then p_retailprice when 1 then 0.0 else case p_brand when 'Brand#11' then 10.0 else 5.0 end end as unit_price from part""")
def price_gate(spark, d):
    """List, free and discounted prices."""
    p = T(spark, d, "part").withColumns({"book_list_price": F.col("p_retailprice"), "book_product": F.col("p_brand")})
    brands = {f"Brand#{i}{j}": 10.0 if (i, j) == (1, 1) else 5.0 for i in range(1, 6) for j in range(1, 6)}
    by = lambda m: products.unit_price(m, discounts=brands)
    found = F.coalesce(F.when(F.col("p_size") % 3 == 0, by("list")).when(F.col("p_size") % 3 == 1, by("free")).otherwise(F.create_map(*[F.lit(x) for kv in brands.items() for x in kv])[F.col("p_brand")]), F.lit(5.0))
    return p.select("p_partkey", found.alias("unit_price"))


@query("""select c_custkey, array_to_string(list_transform(string_split(c_mktsegment || ', ' || 'maybe Alpha PRO (3) & ' || lower(c_mktsegment) || '.', ','), lambda x: trim(x)), '|') as raw, 
 c_mktsegment || '|Alpha PRO|' || lower(c_mktsegment) as tokens from customer""")
def product_cells(spark, d):
    """Product cells cut into tokens."""
    cell = F.concat("c_mktsegment", F.lit(", maybe Alpha PRO (3) & "), F.lower("c_mktsegment"), F.lit("."))
    return T(spark, d, "customer").select("c_custkey", F.array_join(F.transform(F.split(cell, ","), lambda x: F.trim(x)), "|").alias("raw"), F.array_join(products.product_tokens(cell), "|").alias("tokens"))


# ---------------------------------------------------------------- plans and changes
@query("""select c_custkey::varchar as id, f as field, o as old, n as new from (
 select c_custkey, 'segment' as f, c_mktsegment as o, case when c_custkey % 3 = 0 then 'CHANGED' else c_mktsegment end as n from customer
 union all select c_custkey, 'nation', c_nationkey::varchar, (c_nationkey + case when c_custkey % 5 = 0 then 1 else 0 end)::varchar from customer
 union all select c_custkey, 'extra', '', case when c_custkey % 7 = 0 then 'x' else '' end from customer) where o <> n""")
def field_diff(spark, d):
    """Fields that differ between customers and a perturbed copy."""
    return changes.field_diff(*_perturbed(spark, d))


def _perturbed(spark, d, seven: int = 7) -> tuple[DataFrame, DataFrame]:
    """(desired, current) records of customers."""
    c = T(spark, d, "customer")
    k, s, n = F.col("c_custkey"), F.col("c_mktsegment"), F.col("c_nationkey")
    m = lambda *p: F.create_map(*[x if not isinstance(x, str) else F.lit(x) for x in p])
    now = c.select(k.cast("string").alias("id"), m("name", F.col("c_name"), "segment", s, "nation", n.cast("string")).alias("fields"))
    want = c.select(k.cast("string").alias("id"), m("name", F.lit("other"), "segment", F.when(k % 3 == 0, "CHANGED").otherwise(s), "nation", (n + (k % 5 == 0).cast("int")).cast("string"), "extra", F.when(k % seven == 0, "x").otherwise("")).alias("fields"))
    return want, now


@query("""with d as (select c_custkey, f, o, n, s from (
 select c_custkey, 'segment' as f, c_mktsegment as o, case when c_custkey % 3 = 0 then 'CHANGED' else c_mktsegment end as n, 0 as s from customer
 union all select c_custkey, 'nation', c_nationkey::varchar, (c_nationkey + case when c_custkey % 5 = 0 then 1 else 0 end)::varchar, 0 from customer
 union all select c_custkey, 'extra', '', case when c_custkey % 7 = 0 then 'x' else '' end, 1 from customer union all select c_custkey, 'extra', '', case when c_custkey % 14 = 0 then 'x' else '' end, 2 from customer) where o <> n)
select case s when 1 then 'first' else 'second' end as run, c_custkey::varchar as id, f as field, o as old, n as new from d where s > 0 union all select r, c_custkey::varchar, f, o, n from d, (values ('first'), ('second')) v(r) where s = 0""")
def diff_by_digest(spark, d):
    """The same diff from a stored snapshot, then again for a plan that changed in part: only buckets whose digests differ are read."""
    from rowsmith.operators import digests
    from rowsmith.plans.tables import new_path

    want, now = _perturbed(spark, d)
    snapshot, folder = new_path(spark, "snapshot"), new_path(spark, "diffs")
    digests.store_snapshot(now, snapshot, 64)
    first = digests.diff_since(want, snapshot, folder, 64).withColumn("run", F.lit("first"))
    second = digests.diff_since(_perturbed(spark, d, 14)[0], snapshot, folder, 64).withColumn("run", F.lit("second"))
    return first.unionByName(second).select("run", "id", "field", "old", "new")


@query("""with a as (select o_orderkey as id, 'order ' || o_orderkey as label from orders union all select o_orderkey + 100000000, 'order ' || (o_orderkey + 100000000) from orders),
e as (select o_orderkey as id, o_orderstatus as stage, o_orderstatus = 'F' as closed, case when o_orderkey % 2 = 0 then 'EUR' else 'USD' end as currency, count(l_orderkey) as n from orders left join lineitem on l_orderkey = o_orderkey group by all)
select label, label || ': deal ' || a.id || ' not found' as warning from a where id not in (select id from e)
union all select label, label || ': has ' || n || ' line(s), this run adds 2' from a join e using (id) where n > 0
union all select label, label || ': currency ' || currency || ' is not EUR' from a join e using (id) where currency <> 'EUR'
union all select label, label || ': already closed (' || stage || ')' from a join e using (id) where closed""")
def preflight(spark, d):
    """All orders, and as many that don't exist, checked before a plan is applied."""
    return _preflight(spark, d, "true", "true")


def _preflight(spark, d, attached, absent):
    o = T(spark, d, "orders")
    n = T(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("line_count"))
    e = o.join(n, "o_orderkey", "left").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("stage"), (F.col("o_orderstatus") == "F").alias("is_closed"), F.when(F.col("o_orderkey") % 2 == 0, "EUR").otherwise("USD").alias("currency"), F.coalesce("line_count", F.lit(0)).alias("line_count"))
    ids = o.where(attached).select(F.col("o_orderkey").alias("id")).unionByName(o.where(absent).select((F.col("o_orderkey") + 100000000).alias("id")))
    return changes.deal_preflight(ids.withColumns({"label": F.concat(F.lit("order "), F.col("id").cast("string")), "planned": F.lit(2)}), e, "EUR")


@query("""select o_orderkey as id, count(l_orderkey) as actual, 4::bigint as expected, case when count(l_orderkey) < 4 then 'bad' else 'ok' end as flag from orders left join lineitem on l_orderkey = o_orderkey group by 1""")
def verify_counts(spark, d):
    """Lines of each order against what was expected."""
    o = T(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("label"), F.lit(4).cast("long").alias("expected"))
    n = T(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.count("*").alias("line_count"))
    state = T(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.lit("").alias("name"), F.col("o_orderstatus").alias("stage"), F.lit("").alias("currency"), F.lit("").alias("amount")).join(n, "id", "left")
    return changes.verify(o, state, "EUR").select("id", F.col("actual").cast("long").alias("actual"), "expected", "flag")


@query("""with n as (select n_nationkey, 'ACC_' || n_nationkey as id, n_nationkey % 5 = 4 as gone from nation),
c as (select c_custkey, 'CON_' || c_custkey as id, n.id as parent, gone from customer join n on c_nationkey = n_nationkey),
o as (select o_orderkey, 'OPP_' || o_orderkey as id, c.id as parent, gone from orders join c on o_custkey = c_custkey)
select 'contact' as sobject, count(*) filter (where not gone) as made, count(*) filter (where gone) as skipped from c
union all select 'opportunity', count(*) filter (where not gone), count(*) filter (where gone) from o
union all select 'line', count(*) filter (where not gone), count(*) filter (where gone) from lineitem join o on l_orderkey = o_orderkey""")
def staged_plan(spark, d):
    """Records of four levels with resolved parents; what hangs on a skipped parent is skipped."""
    n, c, o, l = (T(spark, d, x) for x in ("nation", "customer", "orders", "lineitem"))
    ref = lambda p, k: F.concat(F.lit(p), k.cast("string"))
    ids = n.select(ref("ACC:", F.col("n_nationkey")).alias("ref"), ref("ACC_", F.col("n_nationkey")).alias("id"), (F.col("n_nationkey") % 5 == 4).alias("skipped"))
    out = None
    levels = [
        ("contact", c.select(ref("CON:", F.col("c_custkey")).alias("ref_key"), ref("ACC:", F.col("c_nationkey")).alias("parent"))),
        ("opportunity", o.select(ref("OPP:", F.col("o_orderkey")).alias("ref_key"), ref("CON:", F.col("o_custkey")).alias("parent"))),
        ("line", l.select(F.concat(ref("OLI:", F.col("l_orderkey")), F.lit(":"), F.col("l_linenumber").cast("string")).alias("ref_key"), ref("OPP:", F.col("l_orderkey")).alias("parent"))),
    ]
    for name, rows in levels:
        rows = rows.withColumn("plan_pos", F.monotonically_increasing_id()).withColumn("parents", F.create_map(F.lit("parent"), "parent"))
        done = written(changes.resolve_parents(written(rows, "level"), ids).select("ref_key", "blocked"), "resolved")
        ids = done.groupBy(F.col("ref_key").alias("ref")).agg(F.min("ref_key").alias("id"), F.bool_and("blocked").alias("skipped")).withColumn("id", F.regexp_replace("id", ":", "_"))
        part = done.agg(F.count_if(~F.col("blocked")).alias("made"), F.count_if("blocked").alias("skipped")).select(F.lit(name).alias("sobject"), "made", "skipped")
        out = part if out is None else out.unionByName(part)
    return out


@query("""with b as (select p_partkey, ('0x' || left(md5(p_name), 4))::int as v from part)
select p_partkey, array_to_string(list_filter(range(0, 16), lambda i: (v >> (15 - i)::int) & 1 = 1), ',') as bits, array_to_string(list_filter(range(0, 11), lambda i: (v >> (15 - i)::int) & 1 = 1), ',') as first_bits from b""")
def bitmap_decode(spark, d):
    """Bits of base64 bitmaps, as far as there are any, and those below 11."""
    from rowsmith.sources.picklists import set_bits

    bitmap = F.base64(F.substring(F.unhex(F.md5("p_name")), 1, 2))
    bits = lambda n: F.array_join(set_bits(bitmap, F.lit(n)).cast("array<string>"), ",")
    return T(spark, d, "part").select("p_partkey", bits(20).alias("bits"), bits(11).alias("first_bits"))


@query("""with recursive n as (select count(*) as n from supplier), s as (select s_suppkey::varchar as id, row_number() over (order by s_suppkey) - 1 as place from supplier),
o as (select c_custkey, rank, id from customer, range(0, 4) r(rank), n join s on place = (c_custkey * 7919 + rank * (104729 + c_custkey)) % n),
l as (select row_number() over (order by c_custkey) as i, c_custkey, list(id order by rank) as ids from o group by c_custkey),
r as (select 0::bigint as i, []::varchar[] as taken, null::bigint as claimer, null::varchar as id
 union all select l.i, case when pick is null then taken else list_append(taken, pick) end, l.c_custkey, pick from (select r.i as last, r.taken, l.*, list_filter(l.ids, lambda x: not list_contains(r.taken, x))[1] as pick from r join l on l.i = r.i + 1) l)
select claimer, id from r where id is not null""")
def greedy_exclusive(spark, d):
    """Customers take, in order, their best supplier that is still free; each has four options among all suppliers."""
    s = T(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("id"), (F.row_number().over(Window.orderBy("s_suppkey")) - 1).alias("place"))
    n = T(spark, d, "supplier").agg(F.count("*").alias("n"))
    wishes = T(spark, d, "customer").select(F.col("c_custkey").alias("claimer"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("rank")).crossJoin(n.where("n > 0"))
    options = wishes.withColumn("place", F.expr("(claimer * 7919 + rank * (104729 + claimer)) % n")).join(s, "place").select("claimer", "rank", "id")
    return exclusive.exclusive(options).select(F.col("claimer").cast("long").alias("claimer"), "id")


def _pools(spark, d):
    s = T(spark, d, "supplier").select(F.col("s_suppkey").alias("league_pos"), F.concat(F.lit("The "), F.replace("s_name", F.lit("Supplier#"), F.lit("Region ")), F.lit(" Athletic Conf.")).alias("display_name"), F.element_at(F.array(*[F.lit(x) for x in ("sweden", "germany", "japan", "brazil", "canada")]), F.col("s_nationkey") % 5 + 1).alias("place"))
    leagues = s.select("league_pos", text.normalise_league(F.col("display_name")).alias("league_key"), "display_name", F.array("place").alias("countries"), F.lit("").alias("pasted_id"))
    c = T(spark, d, "customer")
    pool = c.select(F.col("c_custkey").alias("src_pos"), F.format_string("A%05d", F.col("c_custkey").cast("long")).alias("id"), F.lit("").alias("other_id"), F.concat(F.replace("c_name", F.lit("Customer#"), F.lit("Region ")), F.lit(" Conference")).alias("name"), F.element_at(F.array(*[F.lit(x) for x in ("sweden", "germany", "japan", "brazil", "canada")]), F.col("c_nationkey") % 5 + 1).alias("country"), (F.col("c_custkey") % 4).alias("deals"), F.lit(0).alias("accounts"), F.lit("").alias("active_arr"))
    return leagues, pool


@query("""with p as (select s_suppkey, c_custkey, s_nationkey % 5 = c_nationkey % 5 as near from supplier left join customer on c_custkey = s_suppkey)
select s_suppkey as league_pos, case when near then 'matched' else 'unmatched' end as match_status, case when c_custkey is null then '' else 'core' end as match_type,
 case when c_custkey is null then 0 when near then 98 else 38 end as confidence, case when near then 'A' || lpad(c_custkey::varchar, 5, '0') else '' end as account_ids from p""")
def league_crosscheck(spark, d):
    """The league matcher over names derived from suppliers and customers."""
    leagues, pool = _pools(spark, d)
    return match.crosscheck(leagues, pool).select("league_pos", "match_status", "match_type", "confidence", F.array_join("account_ids", ";").alias("account_ids"))


@query("""select sobject, operation, count(*) as n, sum(line_number) as numbers from (
 select 'account' as sobject, 'create' as operation, 0 as line_number from supplier
 union all select 'contact', 'create', 0 from supplier where s_suppkey % 3 > 0
 union all select 'opportunity', case when s_suppkey % 2 = 0 then 'upsert' else 'create' end, 0 from supplier
 union all select 'line', 'create', k from supplier, (values (1), (2), (3)) v(k)) group by 1, 2""")
def plan_records(spark, d):
    """A load plan of one club per supplier: a subscription and two cameras each, one more camera without a price."""
    from rowsmith.operators import plan

    k = F.col("s_suppkey")
    texts = ["order_name", "gender", "arena", "customer_id", "effective_start", "contact_name", "contact_phone", "billing_country", "billing_street", "billing_postal", "billing_state", "billing_city", "tax_id", "exchange"]
    cam = lambda i, t: F.struct(F.lit(i).alias("index"), F.lit("Main").alias("scene"), F.lit(t).alias("type"), F.lit("").alias("position"), F.lit("").alias("install_status"))
    rows = T(spark, d, "supplier").select(k.alias("src_pos"), F.col("s_name").alias("team"), F.lit("Soccer").alias("sport"), F.lit("Product 1").alias("subscription"), F.when(k % 3 > 0, F.concat(k.cast("string"), F.lit("@x.example"))).otherwise("").alias("contact_email"), F.when(k % 2 == 0, F.concat(F.lit("OPP"), k.cast("string"))).otherwise("").alias("opportunity_id"), *[F.lit("").alias(t) for t in texts], F.array(cam(1, "product 2"), cam(2, "missing"), cam(3, "Product 3")).alias("cameras"))
    book = T(spark, d, "part").select(F.col("p_partkey").alias("src_pos"), F.concat(F.lit("Product "), F.col("p_partkey").cast("string")).alias("product"), F.col("p_partkey").cast("string").alias("product_id"), F.col("p_partkey").cast("string").alias("entry_id"), F.lit("EUR").alias("currency"), F.col("p_retailprice").alias("list_price"), F.lit("").alias("family"))
    records, _ = plan.build(rows, book, plan.Deal())
    return records.groupBy("sobject", "operation").agg(F.count("*").alias("n"), F.coalesce(F.sum(F.try_element_at("fields", F.lit("line_number")).cast("long")), F.lit(0)).alias("numbers"))


@query("""select s_suppkey as truth_pos, 'A' || c_custkey as row_id, case when s_suppkey % 9 = 0 then 'exact_domain' when s_suppkey % 2 = 0 then 'prefix_canon' else 'containment' end as match_type from supplier join customer on c_custkey = s_suppkey""")
def club_match(spark, d):
    """The club matcher over names derived from suppliers and customers."""
    s = T(spark, d, "supplier")
    truth = s.select(F.col("s_suppkey").alias("src_pos"), F.concat(F.lit("FC "), F.replace("s_name", F.lit("Supplier#"), F.lit("Städt "))).alias("name"), F.when(F.col("s_suppkey") % 9 == 0, F.concat(F.lit("c"), F.col("s_suppkey").cast("string"), F.lit(".example"))).otherwise("").alias("domain"))
    c = T(spark, d, "customer")
    rows = c.select(F.col("c_custkey").alias("src_pos"), F.concat(F.lit("A"), F.col("c_custkey").cast("string")).alias("id"), F.concat(F.replace("c_name", F.lit("Customer#"), F.lit("Stadt ")), F.when(F.col("c_custkey") % 2 == 0, " F.C.").otherwise(" GmbH")).alias("name"), F.concat(F.lit("www.c"), F.col("c_custkey").cast("string"), F.lit(".example")).alias("domain"))
    return club.match(truth, rows).select("truth_pos", "row_id", "match_type")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return league_crosscheck(spark, sf_dir)


def _every() -> None:
    """Load the modules that register further queries."""
    from rowsmith.plans import files, forms, live, loads, matches  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _every()
    return dict(_Q)


def oracle_sql() -> dict[str, str]:
    _every()
    return dict(_SQL)
