"""Queries over load plans: clubs are the suppliers, each with a subscription, two cameras that the price book has and
one that it lacks; the parts are the price book. Records are compared whole, their fields as sorted key=value text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.operators import changes, plan
from rowsmith.plans.registry import T, query
from rowsmith.plans.tables import written

#: The clubs as SQL: what each row of the order sheet says.
_CLUBS = """clubs as (select s_suppkey as k, s_name as team, s_name || '#' || s_suppkey as row_key,
 case when s_suppkey % 3 > 0 then 'm' || s_suppkey || '@x.example' else '' end as email, case when s_suppkey % 3 > 0 then 'Ada  K' || s_suppkey else '' end as contact,
 case when s_suppkey % 4 = 0 then '0' || s_suppkey else '' end as phone, case s_suppkey % 3 when 0 then 'SE' when 1 then 'DE' else 'CA' end as country,
 case when s_suppkey % 5 = 0 then 'ACC' || s_suppkey else '' end as account, case when s_suppkey % 2 = 0 then 'OPP' || s_suppkey else '' end as deal,
 s_suppkey % 7 = 0 as noted, s_suppkey % 4 = 1 as womens from supplier)"""


def clubs(spark, d) -> DataFrame:
    k = F.col("s_suppkey")
    key = k.cast("string")
    when = lambda cond, v: F.when(cond, v).otherwise("")
    cam = lambda i, scene, t: F.struct(F.lit(i).alias("index"), F.lit(scene).alias("scene"), F.lit(t).alias("type"), F.lit("Center").alias("position"), F.lit("").alias("install_status"))
    values = {
        "team": F.col("s_name"), "sport": F.lit("Soccer"), "subscription": F.lit("Product 1"), "contact_email": when(k % 3 > 0, F.concat(F.lit("m"), key, F.lit("@x.example"))), "contact_name": when(k % 3 > 0, F.concat(F.lit("Ada  K"), key)),
        "contact_phone": when(k % 4 == 0, F.concat(F.lit("0"), key)), "billing_country": F.element_at(F.array(F.lit("Sweden"), F.lit(" germany"), F.lit("Canada")), (k % 3 + 1).cast("int")), "tax_id": F.concat(F.lit("T"), key),
        "customer_id": when(k % 5 == 0, F.concat(F.lit("ACC"), key)), "opportunity_id": when(k % 2 == 0, F.concat(F.lit(" OPP"), key)), "effective_start": F.lit("June 1st, 2026"), "exchange": when(k % 7 == 0, "Yes"), "gender": when(k % 4 == 1, "girls"),
        **{c: F.lit("") for c in ("order_name", "arena", "billing_street", "billing_postal", "billing_state", "billing_city")},
    }
    return T(spark, d, "supplier").select(k.alias("src_pos"), *[v.alias(c) for c, v in values.items()], F.array(cam(1, "Main", "product 2"), cam(2, "", ""), cam(3, "Main", "missing"), cam(4, "", "Product 3")).alias("cameras"))


def book(spark, d) -> DataFrame:
    k = F.col("p_partkey").cast("string")
    return T(spark, d, "part").select(F.col("p_partkey").alias("src_pos"), F.concat(F.lit("Product "), k).alias("product"), F.concat(F.lit("P"), k).alias("product_id"), F.concat(F.lit("E"), k).alias("entry_id"), F.lit("EUR").alias("currency"), F.col("p_retailprice").alias("list_price"), F.lit("").alias("family"))


DEAL = plan.Deal(master_id="M1", master_owner="OWN", master_level="L1", gender="Mens", record_type="RT", pricebook_id="PB", voucher=True)


def flat(m: Column | str) -> Column:
    """A map as sorted key=value text."""
    return F.array_join(F.array_sort(F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), "|")


def _of(spark, d, sobject: str) -> DataFrame:
    records, _ = plan.build(clubs(spark, d), book(spark, d), DEAL)
    return records.where(F.col("sobject") == sobject).select("operation", "ref_key", "sf_id", "label", flat("fields").alias("fields"), flat("parents").alias("parents"), flat("deferred").alias("deferred"))


@query(f"""with {_CLUBS} select case when account <> '' then 'upsert' else 'create' end as operation, 'ACC:' || team as ref_key, account as sf_id, 'Account ' || team || case when account <> '' then ' (existing)' else ' (NEW)' end as label,
 concat_ws('|', 'billing_country=' || country, 'currency=EUR', 'invoice_delivery=Email', case when phone <> '' then 'invoice_phone=' || phone end, case when deal = '' then 'level=L1' end, 'name=' || team, case when country <> 'DE' then 'org_nr=T' || k end, 'org_type=CB',
  'payment_terms=30', 'shipping_country=' || country, case when phone <> '' then 'shipping_phone=' || phone end, 'sport=Soccer', case when country = 'DE' then 'tax_reg_nr=T' || k end) as fields, '' as parents,
 case when email <> '' then concat_ws('|', 'installation_responsible=CON:' || team, 'invoice_contact=CON:' || team, 'it_responsible=CON:' || team, 'shipping_contact=CON:' || team) else '' end as deferred from clubs""")
def plan_accounts(spark, d):
    """Account records: created or updated, with country codes, tax fields and roles looked up later."""
    return _of(spark, d, "account")


@query(f"""with {_CLUBS} select 'create' as operation, 'CON:' || team as ref_key, '' as sf_id, 'Contact ' || contact || ' <' || email || '>' as label,
 concat_ws('|', 'email=' || email, 'first_name=Ada', 'last_name=K' || k, 'owner_id=OWN', case when phone <> '' then 'phone=' || phone end) as fields, 'account_id=ACC:' || team as parents, '' as deferred from clubs where email <> ''""")
def plan_contacts(spark, d):
    """Contact records of clubs that name one."""
    return _of(spark, d, "contact")


@query(f"""with {_CLUBS} select case when deal <> '' then 'upsert' else 'create' end as operation, 'OPP:' || row_key as ref_key, deal as sf_id, case when deal <> '' then 'Opportunity (existing) ' || team || ' [' || deal || ']' else 'Opportunity ' || team || ' Soccer' end as label,
 concat_ws('|', 'account_name=' || team || ' Perform', 'currency=EUR', 'effective_start=2026-06-01', 'event_source=Not applicable', 'forecast=Closed', 'gender=' || case when womens then 'Womens' else 'Mens' end, 'master_id=M1', case when deal = '' then 'name=' || team || ' Soccer' end,
  'opp_type=New', case when noted then 'order_notes=add to exchange' end, 'order_type=New order', case when deal = '' then 'owner_id=OWN' end, 'pricebook_id=PB', case when deal = '' then 'record_type=RT' end, 'sport=Soccer', 'stage=Closed Won') as fields,
 concat_ws('|', case when deal = '' then 'account_id=ACC:' || team end, case when email <> '' then 'primary_contact=CON:' || team end, case when email <> '' then 'system_admin=CON:' || team end) as parents, '' as deferred from clubs""")
def plan_opportunities(spark, d):
    """Deal records: new ones, and updates of a few fields of deals that the row names."""
    return _of(spark, d, "opportunity")


@query(f"""with {_CLUBS}, l as (
 select k, team, row_key, 1 as n, 1 as quantity, 1 as part, 'OLI:' || row_key || ':sub' as ref_key, 'OLI sub ' || team || ' Product 1' as label from clubs
 union all select k, team, row_key, 2, -1, 1, 'OLI:' || row_key || ':sub_voucher', 'OLI sub ' || team || ' Product 1 (VOUCHER)' from clubs
 union all select k, team, row_key, 3, 1, 2, 'OLI:' || row_key || ':0', 'OLI ' || team || ' cam1' from clubs
 union all select k, team, row_key, 4, 1, 3, 'OLI:' || row_key || ':1', 'OLI ' || team || ' cam2' from clubs)
select 'create' as operation, ref_key, '' as sf_id, label, concat_ws('|', case when n < 3 then 'billing_period=Annual' end, 'charge_name=Product ' || part, 'charge_type=' || case when n < 3 then 'Recurring' else 'One-off' end, 'entry_id=E' || part, 'line_number=' || n, 'list_price=' || p_retailprice::varchar,
  case when n > 2 then 'order_kind=Shipment - No additional cost' end, case when n > 2 then 'position=Center' end, case when n < 3 then 'price_period=Annual' end, 'product_id=P' || part, 'quantity=' || quantity, case when n = 3 then 'scene=Main' end, case when n > 2 then 'sport=Soccer' end,
  'unit_price=' || p_retailprice::varchar, case when n = 2 then 'voucher=true' end) as fields, 'opportunity_id=OPP:' || row_key as parents, '' as deferred from l join part on p_partkey = part""")
def plan_lines(spark, d):
    """Line records: a subscription with its voucher, cameras priced by exact or lower-case name, all numbered within their deal."""
    return _of(spark, d, "line")


@query(f"""with {_CLUBS} select k as src_pos, team || ': camera product not in price book: missing' as warning from clubs
 union all select k, team || ': NEW account, set its website; contact ' || case when email = '' then 'none' else email end from clubs where account = ''
 union all select k, team || ': contact has no phone' from clubs where email <> '' and phone = ''""")
def plan_warnings(spark, d):
    """What a plan warns of: products without a price, new accounts once a club, contacts without a phone."""
    return plan.build(clubs(spark, d), book(spark, d), DEAL)[1].select("src_pos", "warning")


@query("""with s as (select s_suppkey as k from supplier), n as (select count(*) as n, count(*) filter (where k % 3 > 0) as c from s)
select structure, sobject, case when structure < 3 then rows_ else lines_ end as n from n, lateral (values
 (1, 'account', n, 0), (1, 'contact', c, 0), (1, 'opportunity', n, 0), (1, 'line', 3 * n, 0), (2, 'account', n, 0), (2, 'contact', c, 0), (2, 'opportunity', n, 0), (2, 'line', 2 * n, 0), (3, 'line', 0, 2 * n)) v(structure, sobject, rows_, lines_)""")
def plan_structures(spark, d):
    """Records by deal structure: cameras and subscriptions, cameras only, cameras on the master deal only."""
    out = None
    for s in (1, 2, 3):
        records, _ = plan.build(clubs(spark, d), book(spark, d), plan.Deal(structure=s, master_id="M1"))
        if s == 3:
            records = records.where("parents['opportunity_id'] = 'M1'")
        part = records.groupBy("sobject").agg(F.count("*").alias("n")).select(F.lit(s).alias("structure"), "sobject", "n")
        out = part if out is None else out.unionByName(part)
    return out


@query(f"""with {_CLUBS}, u as (select c, case country when 'SE' then 'Sweden' when 'DE' then 'Europe' else 'Americas-nonUS' end as region, count(*) as n from clubs, (values ('product 2'), ('missing'), ('product 3')) v(c) group by 1, 2)
select camera, region, product, n as quantity from (select u.c as camera, u.region, u.n, case when u.c = 'product 2' and u.region = 'Sweden' then 'S1' when u.c = 'missing' and u.region = 'Europe' then 'S4' end as product from u)""")
def master_shipping(spark, d):
    """Shipping plans by camera and region: refurbished ones, other currencies and plans of no camera are left out; units without a plan are warned of."""
    rows = plan.club_rows(clubs(spark, d))
    names = ["Shipping to Sweden of Product 2", "Refurbished shipping to Europe of product 3", "Shipping to Sweden for product 3", "Shipping to Europe for Missing (with mic)", "No plan"]
    plans = spark.createDataFrame([(f"S{i}", n) for i, n in enumerate(names, 1)], "product_id string, plan string")
    entries = spark.createDataFrame([(f"E{i}", f"S{i}", "USD" if i == 3 else "EUR") for i in range(1, 6)], "entry_id string, product_id string, currency string")
    records, bad = plan.shipping_lines(rows, plan.shipping_products(plans, entries, "EUR"), plan.Deal(master_id="M1"))
    f = F.col("fields")
    at = F.split(F.regexp_extract("ref_key", "^OLI:MASTER:ship:(.*)$", 1), ":")
    good = records.where("parents['opportunity_id'] = 'M1' and fields['unit_price'] = '0.0'").select(at[0].alias("camera"), at[1].alias("region"), f["product_id"].alias("product"), f["quantity"].cast("long").alias("quantity"))
    named = F.split(F.regexp_extract("warning", "no plan for (.*)$", 1), " / ")
    n = plan.shipping_counts(rows)
    return good.unionByName(bad.select(named[0].alias("camera"), named[1].alias("region")).join(n, ["camera", "region"]).select("camera", "region", F.lit(None).cast("string").alias("product"), "quantity"))


# ---------------------------------------------------------------- changes
def _snapshots(spark, d) -> dict[str, DataFrame]:
    """What the target system holds: the pinned accounts, every other one with another currency; contacts of some emails; the named deals."""
    c = clubs(spark, d)
    k = F.col("src_pos")
    key = k.cast("string")
    m = lambda **v: plan.pruned(F.create_map(*[x for n, e in v.items() for x in (F.lit(n), e)]))
    accounts = c.where("customer_id <> ''").select(F.col("customer_id").alias("id"), m(name=F.lit("Old name"), currency=F.when(k % 10 == 0, "EUR").otherwise("USD"), sport=F.lit("Soccer")).alias("fields"))
    contacts = c.where("contact_email <> '' and src_pos % 7 < 3").select(
        F.concat(F.lit("C"), key).alias("id"), m(email=F.col("contact_email"), account_id=F.when(k % 7 == 0, F.when(F.col("customer_id") != "", F.col("customer_id")).otherwise("ELSE")).when(k % 7 == 1, "").otherwise("OTHER")).alias("fields"))
    deals = c.where("opportunity_id <> ''").select(F.trim("opportunity_id").alias("id"), m(stage=F.when(k % 4 == 0, "Closed Won").otherwise("Open"), currency=F.lit("EUR"), is_closed=F.when(k % 4 == 0, "true").otherwise("false")).alias("fields"))
    lines = c.where("opportunity_id <> '' and src_pos % 6 = 0").select(F.concat(F.lit("L"), key).alias("id"), m(opportunity_id=F.trim("opportunity_id")).alias("fields"))
    return {"account": accounts, "contact": contacts, "opportunity": deals, "line": lines}


_HELD = """held as (select k, case when email <> '' and k % 7 < 3 then 'C' || k else '' end as contact_id, case when k % 7 = 0 then case when account <> '' then account else 'ELSE' end when k % 7 = 1 then '' else 'OTHER' end as contact_account from clubs)"""


@query(f"""with {_CLUBS} select 'account' as sobject, 'create' as change, count(*) as n, 0 as n_fields from clubs where account = ''
 union all select 'account', 'update', count(*), sum(n)::int from (select (case when k % 10 = 0 then 0 else 1 end) + 2 + 1 + 2 + 1 + 1 + (case when phone <> '' then 2 else 0 end) + (case when deal = '' then 1 else 0 end) - 1 as n from clubs where account <> '')
 union all select 'contact', 'create', count(*), 0 from clubs where email <> ''
 union all select 'opportunity', 'create', count(*), 0 from clubs where deal = ''
 union all select 'opportunity', 'update', count(*), sum(n)::int from (select 10 + (case when noted then 1 else 0 end) + (case when k % 4 = 0 then 0 else 1 end) + (case when email <> '' then 2 else 0 end) as n from clubs where deal <> '')
 union all select 'line', 'create', 4 * count(*), 0 from clubs""")
def change_kinds(spark, d):
    """A plan as changes against snapshots: what is created, updated and reused, and how many fields change."""
    records, _ = plan.build(clubs(spark, d), book(spark, d), DEAL)
    c = changes.changeset(records, _snapshots(spark, d))
    return c.groupBy("sobject", "change").agg(F.count("*").alias("n"), F.sum(F.size("diff")).cast("int").alias("n_fields"))


@query(f"""with {_CLUBS}, {_HELD} select 'CON:' || team as key, case when contact_id = '' then 'create' when contact_account = '' then 'adopt' when contact_account = account then 'reuse' else 'flag' end as action, contact_id
 from clubs join held using (k) where email <> ''""")
def contact_lookup(spark, d):
    """Contacts by email: created, reused on their account, adopted from none, or flagged as another account's."""
    c = clubs(spark, d).where("contact_email <> ''").select(F.concat(F.lit("CON:"), "team").alias("key"), F.col("contact_email").alias("email"), F.when(F.col("customer_id") != "", F.col("customer_id")).otherwise("NEW").alias("account_id"))
    s = _snapshots(spark, d)["contact"].select("id", F.col("fields")["email"].alias("email"), F.col("fields")["account_id"].alias("account_id"))
    return changes.contact_actions(c, s)


@query(f"""with {_CLUBS}, {_HELD}
select 'Opportunity (existing) ' || team || ' [' || deal || ']: has 1 line(s), this run adds 4' as warning from clubs where deal <> '' and k % 6 = 0
union all select 'Opportunity (existing) ' || team || ' [' || deal || ']: already closed (Closed Won)' from clubs where deal <> '' and k % 4 = 0
union all select 'Contact ' || contact || ' <' || email || '>: ' || email || ' is on account OTHER, not ' || account from clubs join held using (k) where account <> '' and email <> '' and k % 7 = 2
union all select 'Account ' || team || ' (existing): ' || n || ' accounts share the name Old name; also ' || others from (
 select k, team, (select count(*) from clubs where account <> '') as n, (select string_agg(account, ', ' order by account) from clubs o where o.account <> '' and o.k <> c.k) as others from clubs c where account <> '') where n > 1""")
def plan_preflight(spark, d):
    """All that a plan is warned of before it is applied: deals, contacts on other accounts, accounts of one name."""
    records, _ = plan.build(clubs(spark, d), book(spark, d), DEAL)
    return changes.preflight(written(records, "plan"), _snapshots(spark, d), "EUR").select("warning")


@query(f"""with {_CLUBS}, {_HELD}, c as (select *, case when email = '' then 'none' when contact_id = '' then 'created' when contact_account = '' then 'updated' when contact_account <> account or account = '' then 'skipped' when phone <> '' then 'updated' else 'reused' end as made from clubs join held using (k))
select 'account' as sobject, case when account = '' then 'created' else 'updated' end as outcome, count(*) as n from c group by 2
union all select 'contact', made, count(*) from c where made <> 'none' group by 2
union all select 'opportunity', case when deal = '' then 'created' else 'updated' end, count(*) from c group by 2
union all select 'line', 'created', 4 * count(*) from c""")
def apply_outcomes(spark, d):
    """A plan applied level by level: what was created, updated, reused and skipped."""
    records, _ = plan.build(clubs(spark, d), book(spark, d), DEAL)
    _, log = changes.apply_plan(written(records, "plan"), _snapshots(spark, d))
    return log.groupBy("sobject", "outcome").agg(F.count("*").alias("n"))


@query(f"""with {_CLUBS}, {_HELD}, c as (select *, contact_id <> '' and contact_account <> '' and (contact_account <> account) as gone from clubs join held using (k))
select case when deal <> '' then deal else '' end as id, 'OPP:' || row_key as ref_key, (email <> '' and not gone) as has_contact, 4::bigint as expected, (4 + case when deal <> '' and k % 6 = 0 then 1 else 0 end)::bigint as n_lines, (email <> '' and not gone) as has_roles, (gone and phone <> '') as phone_missing from c""")
def applied_state(spark, d):
    """The snapshots after a plan was applied: deals with their contact and lines, accounts with the roles looked up last, lines expected."""
    records = written(plan.build(clubs(spark, d), book(spark, d), DEAL)[0], "plan")
    before = _snapshots(spark, d)
    state, log = changes.apply_plan(records, before)
    f = lambda k: F.try_element_at("fields", F.lit(k))
    deals = state["opportunity"].select(F.col("id").alias("did"), f("primary_contact").isNotNull().alias("has_contact"))
    n = state["line"].groupBy(f("opportunity_id").alias("did")).agg(F.count("*").alias("n_lines"))
    roles = state["account"].select(F.col("id").alias("aid"), (f("invoice_contact").isNotNull() & f("it_responsible").isNotNull()).alias("has_roles"))
    own = log.where("sobject = 'opportunity'").select("ref_key", F.col("id").alias("did"), F.regexp_extract("ref_key", "^OPP:(.*)#", 1).alias("team"))
    acc = log.where("sobject = 'account'").select(F.regexp_extract("ref_key", "^ACC:(.*)$", 1).alias("team"), F.col("id").alias("aid"))
    con = log.where("sobject = 'contact'").select(F.regexp_extract("ref_key", "^CON:(.*)$", 1).alias("team"), (F.col("outcome") == "skipped").alias("lost"))
    phone = clubs(spark, d).select("team", (F.col("contact_phone") != "").alias("phone"), F.trim("opportunity_id").alias("id"))
    want = changes.expected_lines(records, log).select(F.col("ref").alias("ref_key"), "expected")
    out = own.join(deals, "did").join(n, "did").join(acc, "team").join(roles, "aid").join(con, "team", "left").join(phone, "team").join(want, "ref_key")
    return out.select("id", "ref_key", "has_contact", "expected", "n_lines", "has_roles", (F.coalesce("lost", F.lit(False)) & F.col("phone")).alias("phone_missing"))


@query(f"""with {_CLUBS} select k as src_pos, 'line' as sobject, 'position=Center' as fields from clubs, (values (1), (2)) v(i)
 union all select k, 'opportunity', 'effective_start=2026-06-01' from clubs""")
def follow_up_fields(spark, d):
    """Values that are written once a record is there: positions of new lines, start dates of deals."""
    records = written(plan.build(clubs(spark, d), book(spark, d), DEAL)[0], "plan")
    log = records.select("plan_pos", "sobject", F.when(F.col("operation") == "create", "created").otherwise("updated").alias("outcome"), F.col("ref_key").alias("id"))
    late = changes.follow_ups(records, log).join(records.select("plan_pos", "sobject"), "plan_pos")
    return late.select(F.floor(F.col("plan_pos") / 1_000_000).alias("src_pos"), "sobject", flat("fields").alias("fields"))


@query("""with n as (select c_mktsegment as v, count(*) as n from customer group by 1), s as (select s_suppkey as k, case when s_suppkey % 2 = 0 then 'BUILDING' else 'Customer#' || right('00000000' || s_suppkey, 9) end as v from supplier)
select k as plan_pos, 'c' || c_custkey as id from s join customer on c_name = v""")
def duplicate_rule(spark, d):
    """Records that exactly one existing record equals in a field: found by name, not where several share the value."""
    s = T(spark, d, "supplier")
    v = F.when(F.col("s_suppkey") % 2 == 0, "BUILDING").otherwise(F.concat(F.lit("Customer#"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0")))
    mine = s.select(F.col("s_suppkey").alias("plan_pos"), F.create_map(F.lit("v"), v).alias("fields"))
    c = T(spark, d, "customer")
    held = c.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("id"), F.create_map(F.lit("v"), F.col("c_name")).alias("fields")).unionByName(c.select(F.concat(F.lit("s"), F.col("c_custkey").cast("string")).alias("id"), F.create_map(F.lit("v"), F.col("c_mktsegment")).alias("fields")))
    return changes.single_match(mine, held, "v")


@query(f"""with {_CLUBS}, c as (
 select k, k * 1000000 as pos, 'account' as sobject, 'Account ' || team || ' (NEW)' as label from clubs where account = ''
 union all select k, k * 1000000 + 250000, 'contact', 'Contact ' || contact || ' <' || email || '>' from clubs where email <> ''
 union all select k, k * 1000000 + 500000, 'opportunity', 'Opportunity ' || team || ' Soccer' from clubs where deal = ''
 union all select k, k * 1000000 + 750000 + slot, 'line', replace(label, '@', team) from clubs, (values (0, 'OLI sub @ Product 1'), (1, 'OLI sub @ Product 1 (VOUCHER)'), (10, 'OLI @ cam1'), (11, 'OLI @ cam2')) v(slot, label)),
f as (select * from c order by pos limit 200), n as (select sobject, count(*) as n from c group by 1)
select '  + ' || rpad(sobject, 12, ' ') || ' ' || label as line from f union all select 'CREATE: ' || sum(n) || ' ' || string_agg(sobject || '=' || n, ' ' order by sobject) from n""")
def change_list(spark, d):
    """The change list for review: how much of each kind is created, and the first 200 in plan order."""
    records = written(plan.build(clubs(spark, d), book(spark, d), DEAL)[0], "plan")
    lines = changes.render(changes.changeset(records, None)).split("\n")
    return spark.createDataFrame([(x,) for x in lines if x.startswith(("CREATE", "  + "))], "line string")  # 201 lines at most


@query(f"""with {_CLUBS}, {_HELD} select 'OPP:' || row_key as ref, 4::bigint as planned, case when contact_id <> '' and contact_account <> '' and contact_account <> account then 0 else 4 end::bigint as expected from clubs join held using (k)""")
def expected_line_counts(spark, d):
    """Lines planned for each deal, and those expected once the ones that were skipped are left out."""
    records = written(plan.build(clubs(spark, d), book(spark, d), DEAL)[0], "plan")
    c, held = clubs(spark, d), _snapshots(spark, d)["contact"]
    e = held.select(F.col("fields")["email"].alias("contact_email"), F.try_element_at("fields", F.lit("account_id")).alias("aid")).where("aid is not null")
    lost = c.join(e, "contact_email").where("aid <> customer_id").select(F.concat(F.lit("OPP:"), "team", F.lit("#"), F.col("src_pos").cast("string")).alias("ref"))
    lines = records.where("sobject = 'line'").withColumn("ref", F.col("parents")["opportunity_id"])
    log = lines.join(lost, "ref", "left_semi").select("plan_pos", F.lit("skipped").alias("outcome"))
    want = changes.expected_lines(records, log)
    return changes.line_counts(records).join(want, "ref", "left").select("ref", "planned", F.coalesce("expected", F.lit(0).cast("long")).alias("expected"))
