"""Queries over files: sheets and lookups are written from the tables and read back by the library's sources, import
files are written by its sinks and read back as text."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith import config as C
from rowsmith.functions import amounts
from rowsmith.operators import entities
from rowsmith.plans import jobs
from rowsmith.plans.registry import T, query
from rowsmith.plans.tables import new_path, text_file, written
from rowsmith.sources import lookups, picklists, sheets, sinks, xlsx


def _file(spark, name: str, head: list[str], rows: DataFrame, *cells: Column) -> str:
    """A CSV sheet with the given first lines and a line of quoted cells per row of ``rows`` (with pos)."""
    quoted = F.concat_ws(",", *[F.concat(F.lit('"'), F.replace(c.cast("string"), F.lit('"'), F.lit('""')), F.lit('"')) for c in cells])
    lines = spark.createDataFrame([(i - len(head), x) for i, x in enumerate(head)], "pos long, line string").unionByName(rows.select(F.col("pos").cast("long").alias("pos"), quoted.alias("line")))
    return text_file(lines, name, parts=True)


def _pick(k: Column, *values) -> Column:
    return F.element_at(F.array(*[v if isinstance(v, Column) else F.lit(v) for v in values]), (k % len(values) + 1).cast("int"))


# ---------------------------------------------------------------- sheets
@query("""select c_custkey as k, 'Rep ' || c_nationkey as rep_name, 'League ' || c_custkey as league, round(c_custkey * 1000 + 0.5, 2) as arr_eur, case when c_custkey % 3 = 0 then '' else 'Sweden' end as territory, 'H' || (c_custkey % 2 + 1) || ' 2026' as period, 'M' || c_custkey as master_opportunity, 'a, "b"' as notes
 from customer where c_custkey % 10 not in (0, 7)""")
def deals_sheet(spark, d):
    """A deals sheet with a preamble: its header is found, labels are mapped, amounts read; rows without person or league are passed over."""
    c = T(spark, d, "customer")
    k = F.col("c_custkey")
    key = k.cast("string")
    rep = F.when(k % 10 == 0, " ").otherwise(F.concat(F.lit(" Rep "), F.col("c_nationkey").cast("string")))
    league = F.when(k % 10 == 7, "").otherwise(F.concat(F.lit("League "), key))
    arr = F.concat(F.lit("€ "), F.replace(F.format_number(k * 1000, 0), F.lit(","), F.lit(".")), F.lit(",50"))
    head = ["Forecast,,,,,,,,", "filled by hand,,,,,,,,", '"  rep   NAME ",Territory,Mother deal ID,League,Nothing,ARR (€),Period,Notes,Product']
    path = _file(spark, "deals", head, c.withColumn("pos", k), rep, F.when(k % 3 == 0, "").otherwise("Sweden"), F.concat(F.lit("M"), key), league, F.lit("?"), arr, F.concat(F.lit("H"), (k % 2 + 1).cast("string"), F.lit(" 2026")), F.lit('a, "b"'), F.lit(""))
    found = sheets.deals(spark, path)
    return found.select(F.regexp_extract("league", r"(\d+)", 1).cast("long").alias("k"), "rep_name", "league", "arr_eur", "territory", "period", "master_opportunity", "notes")


@query("""select 'League ' || c_custkey as league from customer where c_nationkey = 3 and c_custkey % 2 = 0""")
def sheet_filters(spark, d):
    """Deals of one person and one period, whatever the case."""
    c = T(spark, d, "customer").select(F.concat(F.lit("Rep "), F.col("c_nationkey").cast("string")).alias("rep_name"), F.concat(F.lit("H"), (F.col("c_custkey") % 2 + 1).cast("string"), F.lit(" 2026 ")).alias("period"), F.concat(F.lit("League "), F.col("c_custkey").cast("string")).alias("league"))
    return sheets.filtered(c, " rep 3", "h1 2026").select("league")


@query("""select s_suppkey as k, s_name as team, '001' || lpad(s_suppkey::varchar, 12, '0') as customer_id, 'D ' || s_suppkey as opportunity_id, 2 as n_cameras, case when s_suppkey % 2 = 0 then 'Cam ' || s_suppkey else '' end as second_type, 'Left' as second_position from supplier where s_suppkey % 5 > 0""")
def order_sheet_rows(spark, d):
    """An order sheet: header somewhere, as many cameras as it numbers, ids out of addresses, rows without a team passed over."""
    s = T(spark, d, "supplier")
    k = F.col("s_suppkey")
    key = k.cast("string")
    head = ["Orders,,,,,,,,", "Team Name,Customer  SF ID,SF OPP LINK,Camera 1 Scene,Camera 1 Type,Camera 2 Scene,Camera 2 Type,Camera 2 Position of Field,Sport"]
    address = F.concat(F.lit("https://x.example/lightning/r/Account/001"), F.lpad(key, 12, "0"), F.lit("/view"))
    path = _file(spark, "orders", head, s.withColumn("pos", k), F.when(k % 5 > 0, F.col("s_name")).otherwise(""), address, F.concat(F.lit("D "), key), F.lit("Main"), F.lit("A"), F.lit(""), F.when(k % 2 == 0, F.concat(F.lit("Cam "), key)).otherwise(""), F.lit("Left"), F.lit("Soccer"))
    o = sheets.load_orders(spark, path)
    return o.select(F.regexp_extract("team", r"(\d+)$", 1).cast("long").alias("k"), "team", "customer_id", "opportunity_id", F.size("cameras").alias("n_cameras"), F.col("cameras")[1]["type"].alias("second_type"), F.col("cameras")[1]["position"].alias("second_position"))


@query("""select s_suppkey as pos, 4 as col, '' as old, 'T' || s_suppkey as new from supplier where s_suppkey % 2 = 0 and s_suppkey % 3 = 0""")
def sheet_writes(spark, d):
    """Cells to write: one permitted column, only where blank, for teams with a value."""
    s = T(spark, d, "supplier")
    k = F.col("s_suppkey")
    path = _file(spark, "writes", ["Team Name,Sport,SF OPP LINK,Tax ID"], s.withColumn("pos", k), F.col("s_name"), F.lit("Soccer"), F.lit(""), F.when(k % 2 == 0, "").otherwise("old"))
    values = s.select(F.col("s_name").alias("team"), F.when(k % 3 == 0, F.concat(F.lit("T"), k.cast("string"))).otherwise("").alias("value"))
    rows = sheets.read_rows(spark, path)
    wanted = sheets.cell_writes(rows, "Tax ID", values)
    team = rows.select(F.col("src_pos").alias("row"), F.regexp_extract(F.col("cells")[0], r"(\d+)$", 1).cast("long").alias("pos"))
    return wanted.join(team, "row").select("pos", "col", "old", "new")


@query("""select 'order' as kind, n_name as book, s_suppkey::varchar as k, s_name as value from supplier join nation on n_nationkey = s_nationkey where s_suppkey % 4 > 0
 union all select 'config', n_name, '', 'EUR' || n_nationkey from nation where n_nationkey in (select s_nationkey from supplier)""")
def order_workbooks(spark, d):
    """A folder of workbooks, one a nation, read by tasks: order rows below their header, blank rows counted, and the currency of each config tab."""
    folder = new_path(spark, "workbooks")
    rows = T(spark, d, "supplier").join(T(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("n_name", "n_nationkey", "s_suppkey", "s_name")

    def write(part):
        from rowsmith.sources.target import _place

        part = part.sort_values("s_suppkey")
        name, key = part["n_name"].iloc[0], part["n_nationkey"].iloc[0]
        lines = [[t if k % 4 else "", "Soccer", str(k)] for k, t in zip(part["s_suppkey"], part["s_name"], strict=True)]
        data = xlsx.workbook({"Main Camera Sheet": {"rows": [["Orders"], [], [], [], ["Team Name", "Sport", "Order Name"], *lines]}, "Config": {"rows": [["CONFIG"], [], ["League", name], ["Currency", f"EUR{key}"]]}})
        store, place = _place(folder)
        store.create_dir(place, recursive=True)
        with store.open_output_stream(f"{place}/{key}.xlsx") as out:
            out.write(data)
        return part[["n_name"]].head(1)

    made = rows.groupBy("n_name").applyInPandas(write, "n_name string")  # a workbook is what one person fills
    if not made.count():
        return spark.createDataFrame([], "kind string, book string, k string, value string")
    names = xlsx.read_workbooks(spark, folder, ["Config"])
    config = names.where(F.size("cells") > 1).groupBy("path").agg(*[F.max(F.when(F.col("cells")[0] == c, F.col("cells")[1])).alias(c) for c in ("League", "Currency")])
    config = written(config, "config")
    found = xlsx.read_workbooks(spark, folder, ["Main Camera Sheet"])
    orders = sheets.orders(found).select("src_pos", "team", F.col("order_name").alias("k"))
    teams = found.select("src_pos", "path", F.trim(F.get("cells", F.lit(0))).alias("team"))
    mine = orders.join(teams, ["src_pos", "team"]).join(config, "path")
    return mine.select(F.lit("order").alias("kind"), F.col("League").alias("book"), "k", F.col("team").alias("value")).unionByName(config.select(F.lit("config").alias("kind"), F.col("League").alias("book"), F.lit("").alias("k"), F.col("Currency").alias("value")))


def _price_file(spark, d, name: Column) -> str:
    """A price book of all parts, subscriptions and cameras by turns."""
    p = T(spark, d, "part")
    k = F.col("p_partkey")
    key = k.cast("string")
    return _file(spark, "prices", ["Price Book Name,Product: Product Name,Product ID,Price Book Entry ID,List Price Currency,List Price,Family"], p.withColumn("pos", k), F.lit("Standard"), name, F.concat(F.lit("P"), key), F.concat(F.lit("E"), key), F.lit("EUR"), F.col("p_retailprice").cast("string"), F.when(k % 2 == 1, "Subscription").otherwise("Camera"))


@query("""select 'Subscriptions' as list, 'Part ' || p_partkey as value from part where p_partkey % 2 = 1 union all select 'Cameras', 'Part ' || p_partkey from part where p_partkey % 2 = 0
 union all select 'config', 'EUR' union all select 'config', 'My League' union all select 'columns', '41'""")
def order_sheet_template(spark, d):
    """An empty order sheet: its dropdowns hold the price book's products, its config tab the defaults, found by words of their labels."""
    from pathlib import Path

    book = _price_file(spark, d, F.concat(F.lit("Part "), F.col("p_partkey").cast("string")))
    out = new_path(spark, "template", ".xlsx").removeprefix("file://").removeprefix("file:")
    jobs.order_sheet(spark, C.Settings(pricebook_csv=book), out, "My League")
    lists = xlsx.read_workbooks(spark, Path(out).as_uri(), ["Lists"]).where("src_pos > 1")
    values = lists.select(F.posexplode(F.slice("cells", 1, 2)).alias("at", "value")).where("value <> ''").select(F.when(F.col("at") == 0, "Subscriptions").otherwise("Cameras").alias("list"), "value")
    config = sheets.load_config(spark, out)
    wide = sheets.header(sheets.read_rows(spark, out, "Main Camera Sheet"), sheets.MARKER, fold=False)[1]
    found = [("config", C.config_value(config, "currency")), ("config", C.config_value(config, "league")), ("columns", str(len(wide)))]
    return written(values.unionByName(spark.createDataFrame(found, "list string, value string")), "template")


@query("""with n as (select count(*) as n from customer) select f as file, case when f in ('account_existing', 'contact') then 0 else n end as n from n, (values ('account_new'), ('account_existing'), ('contact'), ('opportunity'), ('opp_product'), ('league_crosscheck')) v(f)""")
def dry_run_counts(spark, d):
    """A dry run of the build over a deals sheet and a price book, without candidates: how many rows each import file would have."""
    c = T(spark, d, "customer")
    k = F.col("c_custkey")
    key = k.cast("string")
    deals = _file(spark, "forecast", ["A title", "", "Rep Name,League,Period,ARR,Product"], c.withColumn("pos", k), F.concat(F.lit("Rep "), F.col("c_nationkey").cast("string")), F.concat(F.lit("League "), key), F.lit("H1 2026"), key, F.concat(F.lit("Part "), (k % 3 + 1).cast("string")))
    book = _price_file(spark, d, F.concat(F.lit("Part "), F.col("p_partkey").cast("string")))
    counts = jobs.build(spark, deals, new_path(spark, "nowhere"), C.Settings(pricebook_csv=book), "none", dry_run=True)
    return spark.createDataFrame([(f, n) for f, n in counts.items()], "file string, n long")  # a row a file


# ---------------------------------------------------------------- lookups
@query("""select 'A' || c_custkey as id, c_name as name, case when c_custkey % 2 = 0 then 'first' else 'Sweden' end as country, '' as org_type from customer""")
def account_export(spark, d):
    """An account export with a byte order mark: headers by synonym, one preferred by the environment, missing ones empty, no file no rows."""
    c = T(spark, d, "customer")
    k = F.col("c_custkey")
    path = _file(spark, "accounts", ["﻿ACCOUNT ID,Account: Account Name,Where,Billing Country"], c.withColumn("pos", k), F.concat(F.lit("A"), k.cast("string")), F.col("c_name"), F.when(k % 2 == 0, "first").otherwise(""), F.lit(" Sweden "))
    before = os.environ.get("LOOKUP_ACCOUNTS_COUNTRY_HEADER")
    os.environ["LOOKUP_ACCOUNTS_COUNTRY_HEADER"] = "where"
    try:
        source = lookups.source("csv", spark, C.Settings(accounts_csv=path, users_csv=path + ".none"))
        return source.accounts().unionByName(source.users().select("src_pos", "id", "name", F.lit("").alias("country"), F.lit("").alias("org_type"), F.lit("").alias("sport"))).select("id", "name", "country", "org_type")
    finally:
        if before is None:
            del os.environ["LOOKUP_ACCOUNTS_COUNTRY_HEADER"]
        else:
            os.environ["LOOKUP_ACCOUNTS_COUNTRY_HEADER"] = before


@query("""select '005' || lpad(c_custkey::varchar, 12, '0') as id, c_name as name, 'u' || c_custkey || '@x.example' as email from customer where c_custkey % 5 not in (1, 2, 3) and c_custkey % 7 > 0""")
def active_users(spark, d):
    """A user export: only false, 0 and no are inactive, a blank mark is active; users without a name don't count."""
    c = T(spark, d, "customer")
    k = F.col("c_custkey")
    path = _file(spark, "users", ["User ID,Full Name,User Email,Active"], c.withColumn("pos", k), F.concat(F.lit("005"), F.lpad(k.cast("string"), 12, "0")), F.when(k % 7 > 0, F.col("c_name")).otherwise(" "), F.concat(F.lit("u"), k.cast("string"), F.lit("@x.example")), _pick(k, "", " FALSE", "0", "No", "yes"))
    return lookups.active(lookups.CsvSource(spark, path, path).users()).select("id", "name", "email")


@query("""select s_suppkey::varchar as id, s_name as name, case when s_suppkey % 2 = 0 then 'League' else 'Club' end as org_type, s_nationkey::varchar as country from supplier where s_suppkey % 2 = 0
 union all select s_suppkey::varchar, 'Liga ' || s_suppkey, 'Club', s_nationkey::varchar from supplier where s_suppkey % 6 = 3""")
def recorded_accounts(spark, d):
    """A recorded query result: attributes dropped, values as text, the keyword filter of the live scan applied."""
    s = T(spark, d, "supplier")
    k = F.col("s_suppkey")
    name = F.when(k % 6 == 3, F.concat(F.lit("Liga "), k.cast("string"))).otherwise(F.col("s_name"))
    record = F.to_json(F.struct(F.struct(F.lit("Account").alias("type")).alias("attributes"), k.alias("Id"), name.alias("Name"), F.when(k % 2 == 0, "League").otherwise("Club").alias("Kind__c"), F.col("s_nationkey").alias("BillingCountry"), F.lit(None).cast("string").alias("Sport__c")))
    last = s.agg(F.max("s_suppkey")).first()[0] or 0
    lines = s.select((k + 1).cast("long").alias("pos"), F.concat(record, F.when(k < last, ",").otherwise("")).alias("line"))
    ends = spark.createDataFrame([(-1, '{"status": 0, "result": {"records": ['), (1 << 40, "]}}")], "pos long, line string")
    path = text_file(lines.unionByName(ends), "recorded", ".json")
    source = lookups.RecordedSource(spark, path, path, org_type_field="Kind__c")
    return source.accounts().select("id", "name", "org_type", "country")


@query("""select c_custkey::varchar as other_id, c_name as name, c_custkey % 4 as deals, 0 as accounts, case when c_custkey % 3 = 0 then '' else 'A' || c_custkey end as id from customer where c_custkey % 11 > 0""")
def curated_pool(spark, d):
    """Curated candidates, also without an account id; counts written as decimals or not at all."""
    c = T(spark, d, "customer")
    k = F.col("c_custkey")
    path = _file(spark, "curated", ["Record ID,Company/Customer name,Number of Associated Deals,Number of associated account (active & cancelled),Salesforce Account ID"], c.withColumn("pos", k), k, F.when(k % 11 > 0, F.col("c_name")).otherwise(""), F.concat((k % 4).cast("string"), F.lit(".0")), F.lit("?"), F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("A"), k.cast("string"))))
    return lookups.curated_candidates(spark, path).select("other_id", "name", "deals", "accounts", "id")


@query("""with n as (select c_custkey as k, case when c_custkey % 4 = 0 then 'The North Conf. of ' || (c_custkey // 8) when c_custkey % 4 = 1 then 'Zone ' || c_custkey when c_custkey % 4 = 2 then 'ZONE ' || (c_custkey - 1) || ' do NOT use' else '' end as name from customer)
select c_custkey as k, case c_custkey % 3 when 0 then 'kept' when 1 then coalesce((select 'R' || k from n where n.k = c_custkey and k % 4 = 1), '')
 else coalesce((select case when count(*) = 1 then 'R' || min(n.k) end from n where n.k % 4 = 0 and n.k // 8 = c_custkey // 8), '') end as other_id from customer""")
def attached_ids(spark, d):
    """Company ids by name, in lower case or normalised, where a name has just one; deprecated rows are left out, ids that are there stay."""
    c = T(spark, d, "customer")
    k = F.col("c_custkey")
    key = k.cast("string")
    group = F.floor(k / 8).cast("long").cast("string")
    name = F.when(k % 4 == 0, F.concat(F.lit("The North Conf. of "), group)).when(k % 4 == 1, F.concat(F.lit("Zone "), key)).when(k % 4 == 2, F.concat(F.lit("ZONE "), (k - 1).cast("string"), F.lit(" do NOT use"))).otherwise("")
    path = _file(spark, "companies", ["Record ID,Company/Customer name"], c.withColumn("pos", k), F.concat(F.lit("R"), key), name)
    wanted = F.when(k % 3 == 1, F.concat(F.lit(" zone "), key)).otherwise(F.concat(F.lit("north conference of "), group))
    pool = c.select(k.alias("k"), wanted.alias("name"), F.when(k % 3 == 0, "kept").otherwise("").alias("other_id"))
    return entities.attach_ids(pool, lookups.company_ids(spark, path)).select("k", "other_id")


@query("""select 'manual' as file, s_name as league, 'A' || s_suppkey as id, 'why' as note from supplier where s_suppkey % 3 > 0 union all select 'alias', s_name, 'A' || s_suppkey, 'why' from supplier where s_suppkey % 3 > 0
 union all select 'company', s_name, 'A' || s_suppkey, 'x.' || s_suppkey || '.example' from supplier""")
def curated_rows(spark, d):
    """Manual ids and aliases without commented rows; companies with domains in lower case."""
    s = T(spark, d, "supplier")
    k = F.col("s_suppkey")
    ident = F.concat(F.lit("A"), k.cast("string"))
    league = F.when(k % 3 > 0, F.col("s_name")).otherwise(F.concat(F.lit("# "), "s_name"))
    rows = s.withColumn("pos", k)
    a = lookups.manual_ids(spark, _file(spark, "manual", ["league,sf_account_id,hs_record_id,note"], rows, league, ident, F.lit(""), F.lit("why")))
    b = lookups.deal_aliases(spark, _file(spark, "aliases", ["league,company_name,company_record_id,reason"], rows, league, F.lit("x"), ident, F.lit("why")))
    c = lookups.companies(spark, _file(spark, "crm", ["Name,Domain,Record ID"], rows, F.col("s_name"), F.concat(F.lit("X."), k.cast("string"), F.lit(".Example")), ident))
    out = a.select(F.lit("manual").alias("file"), "league", F.col("account_id").alias("id"), "note").unionByName(b.select(F.lit("alias").alias("file"), "league", F.col("other_id").alias("id"), F.col("reason").alias("note")))
    return out.unionByName(c.select(F.lit("company").alias("file"), F.col("name").alias("league"), "id", F.col("domain").alias("note")))


_BOOK_HEAD = ["Price Book Name,Product: Product Name,Product ID,Price Book Entry ID,List Price Currency,List Price,Family"]
_BOOK_SQL = """select p_partkey as k, 'Part ' || p_partkey as product, case when p_partkey % 6 = 5 then 0.0::double else (p_partkey + 0.25)::double end as list_price, case p_partkey % 3 when 0 then 'subscription' when 1 then 'camera' else 'other {}' end as family, case when p_partkey % 4 = 0 then 'USD' else 'EUR' end as currency from part where p_partkey % 9 > 0"""


def _book_file(spark, d, bad: str) -> str:
    p = T(spark, d, "part")
    k = F.col("p_partkey")
    price = F.when(k % 6 == 5, bad).otherwise(F.concat(k.cast("string"), F.lit(",25")))
    name = F.when(k % 9 > 0, F.concat(F.lit("Part "), k.cast("string"))).otherwise("")
    return _file(spark, "book", _BOOK_HEAD, p.withColumn("pos", k), F.lit("Main"), name, F.lit("p"), F.lit("e"), F.when(k % 4 == 0, "USD").otherwise("EUR"), price, _pick(k, "A Subscription", "Camera purchase", " Other {} "))


@query(_BOOK_SQL)
def price_book(spark, d):
    """A price book: required columns, prices with comma, blank ones free, product kinds from families, rows without a name passed over."""
    b = lookups.pricebook(spark, _book_file(spark, d, ""), strict=True)
    return b.select(F.regexp_extract("product", r"(\d+)", 1).cast("long").alias("k"), "product", "list_price", "family", "currency")


@query("select k, product, list_price, currency from (" + _BOOK_SQL + ") where currency = 'EUR'")
def currency_book(spark, d):
    """The entries of one currency; bad prices count as 0."""
    b = lookups.currency_pricebook(spark, _book_file(spark, d, "n/a"), "EUR")
    return b.select(F.regexp_extract("product", r"(\d+)", 1).cast("long").alias("k"), "product", "list_price", "currency")


@query("with b as (" + _BOOK_SQL + ") select 'family' as kind, family as name, product as value from b where family <> 'other {}' union all select distinct 'currency', currency, '' from b")
def book_values(spark, d):
    """What dropdowns offer: products by kind; currencies of a price book."""
    b = written(lookups.pricebook(spark, _book_file(spark, d, "")), "book")
    return lookups.products_by_family(b).select(F.lit("family").alias("kind"), F.col("family").alias("name"), F.col("product").alias("value")).unionByName(lookups.currencies(b).select(F.lit("currency").alias("kind"), F.col("currency").alias("name"), F.lit("").alias("value")))


# ---------------------------------------------------------------- dependent picklists
@query("""with p as (select n_nationkey as i, n_nationkey % 6 = 5 as off, n_name as v, ('0x' || left(md5(n_name), 2))::int as b from nation),
r as (select r_name as control, row_number() over (order by r_regionkey) - 1 as place from region)
select control, place as control_pos, coalesce(string_agg(v, ',' order by i) filter (where (b >> (7 - place)::int) & 1 = 1 and not off), '') as permitted from r, p group by 1, 2""")
def picklist_dependencies(spark, d):
    """An object description decoded: which nations each region permits by bitmap, inactive values left out; written as JSON and read back."""
    n = T(spark, d, "nation").select(F.col("n_nationkey").alias("i"), F.struct(F.col("n_name").alias("value"), F.when(F.col("n_nationkey") % 6 == 5, False).alias("active"), F.base64(F.substring(F.unhex(F.md5("n_name")), 1, 1)).alias("validFor")).alias("v"))
    r = T(spark, d, "region").select(F.col("r_regionkey").alias("i"), F.struct(F.col("r_name").alias("value"), F.lit(True).alias("active"), F.lit(None).cast("string").alias("validFor")).alias("v"))
    values = lambda t: t.agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda x: x["v"]).alias("picklistValues"))
    fields = lambda t, name, dep, by: values(t).select(F.struct(F.lit(name).alias("name"), F.lit(dep).alias("dependentPicklist"), F.lit(by).cast("string").alias("controllerName"), "picklistValues").alias("f"))
    both = fields(r, "region", False, None).unionByName(fields(n, "nation", True, "region")).agg(F.collect_list("f").alias("fields"))
    path = text_file(both.select(F.lit(0).cast("long").alias("pos"), F.to_json(F.struct(F.lit("Thing").alias("name"), "fields")).alias("line")), "describe", ".json")
    out = new_path(spark, "deps")
    picklists.write_dependencies(picklists.dependencies(picklists.read_describe(spark, path), "region", "nation"), out)
    return picklists.read_dependencies(spark, out).select("control", F.col("control_pos").cast("long").alias("control_pos"), F.array_join("permitted", ",").alias("permitted"))


# ---------------------------------------------------------------- sinks
def _back(spark, df: DataFrame, name: str) -> DataFrame:
    """An import file written and read back: each line's columns joined by |."""
    path = new_path(spark, name)
    sinks.write_csv(df, path)
    back = spark.read.option("header", True).option("escape", '"').option("ignoreTrailingWhiteSpace", False).csv(path)
    if list(back.columns) != list(df.columns):
        raise ValueError(f"{name}: columns {back.columns}")
    return back.select(F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in back.columns]).alias("line"))


def _results(spark, d) -> DataFrame:
    """Crosscheck results, one per customer: matched, unmatched, ambiguous by turns."""
    k = F.col("c_custkey")
    key = k.cast("string")
    texts = lambda *v: F.array(*v).cast("array<string>")
    none = F.expr("cast(array() as array<string>)")
    return T(spark, d, "customer").select(
        k.alias("first_pos"), k.alias("src_pos"), F.concat("c_name", F.lit(" ")).alias("display_name"), F.lower("c_name").alias("league_key"), _pick(k, "matched", "unmatched", "ambiguous").alias("match_status"),
        F.when(k % 3 == 1, none).otherwise(texts(F.concat(F.lit("A"), key), F.concat(F.lit("B"), key))).alias("account_ids"), F.when(k % 3 == 1, none).otherwise(texts(F.lit("h"))).alias("other_ids"), texts(F.lit("n, 1"), F.lit('n "2"')).alias("account_names"),
        F.lit("Soccer").alias("primary_sport"), texts(F.lit("Soccer"), F.lit("Golf")).alias("sports"), texts(F.lit("r1"), F.lit("r2")).alias("rep_names"), F.lit(3).alias("n_rows"), (k + 0.5).alias("total_arr"), F.lit("both").alias("match_source"),
        F.lit("exact").alias("match_type"), F.lit(100).alias("confidence"), F.lit("High").alias("confidence_label"), (k % 2).alias("deals"), F.lit("7").alias("active_arr"), F.concat(F.lit("note "), key).alias("note"), F.when(k % 4 == 0, F.concat(F.lit("Ada B. "), key)).otherwise(" ").alias("contact_name"), F.lit("e@x.example").alias("contact_email"),
        F.when(k % 5 == 0, "").otherwise("H1 2026").alias("period"), F.when(k % 2 == 0, "M").otherwise("").alias("master_opportunity"), F.lit("own").alias("owner"), F.lit("2026-06-01").alias("target_close"), _pick(k, "RENEWAL", "upsell", "x").alias("deal_type"), F.lit("Alpha").alias("product"), F.lit("Golf").alias("sport"),
    )


_R = """r as (select c_custkey as k, c_name as name, c_custkey % 3 as s, case when c_custkey % 3 = 0 then 'A' || c_custkey else '' end as acc, case when c_custkey % 5 = 0 then 'H2 2026' else 'H1 2026' end as period,
 case when c_custkey % 2 = 0 then 'M' else 'MM' end as master, case c_custkey % 3 when 0 then 'Renewal' when 1 then 'Upsell' else 'New' end as kind from customer)"""


@query(f"""with {_R} select case when s = 1 then 'new' else 'existing' end as file, acc || '|' || name || ' ' || '||||||' || '|Email|30|EUR' || '|||||||||' || '|League Organization|Soccer||' as line from r""")
def account_files(spark, d):
    """The account files: unmatched leagues are new, all others exist; an id only where matched."""
    new, old = sinks.split_accounts(_results(spark, d))
    s = C.Settings()
    return _back(spark, sinks.account_file(new, s), "accounts").withColumn("file", F.lit("new")).unionByName(_back(spark, sinks.account_file(old, s), "accounts").withColumn("file", F.lit("existing")))


@query(f"""with {_R} select case when s = 1 then '' else 'A' || k end || '||Ada|B. ' || k || '|Ada B. ' || k || '|e@x.example||Ada B. ' || k as line from r where k % 4 = 0""")
def contact_files(spark, d):
    """The contact file: leagues that name a contact, names split."""
    return _back(spark, sinks.contact_file(_results(spark, d)), "contacts")


@query(f"""with {_R} select acc || '|' || name || '|' || period || ' Forecast|' || master || '||' || name || ' - ' || period || '|own|2026-06-01|Open|Pipeline||' || name || ' Perform' || '|||EUR|' || kind || '|New order|Soccer||' || acc || '|Annual|1||' as line from r""")
def opportunity_files(spark, d):
    """The deals file, one per league and period: default period, master deal, deal kinds."""
    return _back(spark, sinks.opportunity_file(_results(spark, d), C.Settings(), "MM"), "deals")


@query(f"""with {_R} select acc || '|' || name || ' ' || '|Alpha|' || master || '||' || name || '  Alpha' || case when k % 5 = 0 then '' else ' H1 2026' end || '|own|2026-06-01|Open|Pipeline||' || name || '  Perform' || '|||EUR|' || kind || '|New order|Golf||' || acc || '|Annual|1||' as line from r""")
def opportunity_row_files(spark, d):
    """The deals file, one per input row."""
    return _back(spark, sinks.opportunity_row_file(_results(spark, d), C.Settings(), "MM"), "deals")


_LINES = """l as (select k, name, acc, period, n, 'Prod ' || n as product, case when n = 1 then 'subscription' else 'camera' end as family, k + 0.5 * (n - 1) as price from r, (values (1), (2)) v(n))"""


def _lines(spark, d) -> DataFrame:
    k, n = F.col("first_pos"), F.col("line")
    r = _results(spark, d).withColumn("line", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn("key", k.cast("string")).drop("product")
    return r.withColumns({"product": F.concat(F.lit("Prod "), n.cast("string")), "product_id": F.concat(F.lit("P"), n.cast("string")), "entry_id": F.concat(F.lit("E"), n.cast("string")), "family": F.when(n == 1, "subscription").otherwise("camera"), "allocated": k + 0.5 * (n - 1), "list_price": F.lit(10.0), "cell": F.lit("Alpha, Beta")})


_TERMS = """case when family = 'subscription' then 'account' else 'camera system/s' end || '||' || case when family = 'subscription' then 'Recurring' else 'One-off' end || '|Annual|' || case when family = 'subscription' then 'Annual' else '' end"""
_PRICE = """case when price = floor(price) then floor(price)::bigint::varchar else printf('%.2f', price::double) end"""


@query(f"""with {_R}, {_LINES} select acc || '||' || name || ' - ' || period || '|2|' || product || '|P' || n || '|E' || n || '|' || {_PRICE} || '|10|EUR|1|' || {_TERMS} || '|' || product || '||||||' || '|' || n as line from l""")
def product_files(spark, d):
    """The product lines file: lines numbered within their deal, prices as text, charge terms by kind."""
    return _back(spark, sinks.product_file(_lines(spark, d), C.Settings()), "lines")


@query(f"""with {_R}, {_LINES} select acc || '||' || name || '  Alpha, Beta' || case when k % 5 = 0 then '' else ' H1 2026' end || '|1|' || product || '|P' || n || '|E' || n || '|' || {_PRICE} || '|10|EUR|1|' || {_TERMS} || '|' || product || '||||||' || '|1' as line from l where n = 1""")
def product_row_files(spark, d):
    """The product lines file, one line per input row."""
    return _back(spark, sinks.product_file(_lines(spark, d).where("line = 1"), C.Settings(), per_row=True), "lines")


@query(f"""with {_R} select name || ' ' || '|' || lower(name) || '|Soccer|Soccer; Golf|2|r1; r2|3|' || printf('%.2f', k + 0.5) || '|' || case s when 0 then 'matched' when 1 then 'unmatched' else 'ambiguous' end || '|both|exact|100|High|' || case when s = 1 then '' else 'A' || k || '; B' || k end || '|'
 || case when s = 1 then '' else 'h' end || '|n, 1; n "2"|' || case when s = 0 then (k % 2)::varchar else '' end || '|' || case when s = 0 and k % 2 > 0 then 'YES — check CRM for duplicate deals' else '' end || '|' || case when s = 0 then '7' else '' end || '|note ' || k as line from r""")
def report_files(spark, d):
    """The crosscheck report: lists joined, deals and amounts only where matched."""
    return _back(spark, sinks.report(_results(spark, d)), "report")


@query("""with n as (select count(*) as n, count(*) filter (where c_custkey % 4 = 0) as named from customer)
select f as file, case f when 'contact' then 8 when 'league_crosscheck' then 20 else 24 end as n_columns, case f when 'contact' then named when 'opp_product' then 2 * n else n end as n_rows from n, (values ('account'), ('contact'), ('opportunity'), ('opp_product'), ('league_crosscheck')) t(f)""")
def csv_contracts(spark, d):
    """Columns and rows of the import files, written and read back."""
    r, conf = _results(spark, d), C.Settings()
    files = {"account": sinks.account_file(r, conf), "contact": sinks.contact_file(r), "opportunity": sinks.opportunity_file(r, conf), "opp_product": sinks.product_file(_lines(spark, d), conf), "league_crosscheck": sinks.report(r)}
    out = None
    for name, df in files.items():
        path = new_path(spark, name)
        sinks.write_csv(df, path)
        back = spark.read.option("header", True).option("escape", '"').csv(path)
        part = back.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("file"), F.lit(len(back.columns)).alias("n_columns"), "n_rows")
        out = part if out is None else out.unionByName(part)
    return out


@query("""select case when s_suppkey % 3 = 0 then 'none' when s_suppkey % 3 = 1 then 'tier-1' else 'a-b' end as tier, s_name as name from supplier""")
def review_folders(spark, d):
    """Review rows by tier, read back."""
    s = T(spark, d, "supplier").select(F.col("s_name").alias("name"), _pick(F.col("s_suppkey"), " ", "Tier 1", "A / B").alias("tier"))
    path = new_path(spark, "review")
    sinks.review_files(s, path)
    return spark.read.option("header", True).csv(path).select("tier", "name")


@query("""select case when x = floor(x) then floor(x)::bigint::varchar else printf('%.2f', x) end as shown, count(*) as n from (select round(l_discount * 100, 0) / 4 as x from lineitem) group by 1""")
def money_kinds(spark, d):
    """Amounts as text, grouped."""
    return T(spark, d, "lineitem").select(amounts.money(F.round(F.col("l_discount") * 100, 0) / 4).alias("shown")).groupBy("shown").agg(F.count("*").alias("n"))
