"""The load plan: one record per planned object of each club row, in plan order.

A record is (plan_pos, sobject, operation, ref_key, sf_id, label, fields, parents,
deferred): fields, parents and deferred are maps of strings; parents and deferred name
other records' ref keys or known ids. plan_pos orders records by row, object and slot.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsmith.functions.amounts import iso_date
from rowsmith.functions.geo import country_code, shipping_camera, shipping_region, tax_field, team_gender
from rowsmith.functions.text import split_name, strip, text, truthy
from rowsmith.operators.products import priced, unit_price

CAMERAS_AND_SUBSCRIPTIONS, CAMERAS_ONLY, CAMERAS_TO_LEAGUE = 1, 2, 3
ORDER = ["account", "contact", "opportunity", "line"]
ROLES = ["invoice_contact", "shipping_contact", "installation_responsible", "it_responsible"]
_SLOT = 1_000_000


@dataclass
class Deal:
    """What all rows of an import share."""

    structure: int = CAMERAS_AND_SUBSCRIPTIONS
    currency: str = "EUR"
    master_id: str = ""
    master_owner: str = ""
    master_close: str = ""
    master_level: str = ""
    owner: str = ""
    stage: str = "Closed Won"
    forecast: str = "Closed"
    gender: str = ""
    record_type: str = ""
    pricebook_id: str = ""
    voucher: bool = False
    billing_period: str = "Annual"
    subscription_pricing: str = "list"
    camera_pricing: str = "list"
    subscription_discounts: dict[str, float] = field(default_factory=dict)
    camera_discounts: dict[str, float] = field(default_factory=dict)
    exchange_note: str = "add to exchange"
    account_suffix: str = "Perform"
    master_shipping: bool = False


def payload(**values: Column) -> Column:
    """A map of the values that aren't empty; zero stays."""
    pairs = [x for k, v in values.items() for x in (F.lit(k), v.cast("string"))]
    return pruned(F.create_map(*pairs))


def pruned(fields: Column) -> Column:
    return F.map_filter(fields, lambda k, v: v.isNotNull() & (v != "") & (k != ""))


def _empty() -> Column:
    return F.expr("cast(map() as map<string,string>)")


def _record(df: DataFrame, slot: Column, sobject: str, operation: Column, ref: Column, sf_id: Column, label: Column, fields: Column, parents: Column, deferred: Column | None = None) -> DataFrame:
    order = F.lit(ORDER.index(sobject) * _SLOT // 4)
    return df.select((F.col("src_pos") * _SLOT + order + slot).cast("long").alias("plan_pos"), F.lit(sobject).alias("sobject"), operation.alias("operation"), ref.alias("ref_key"), sf_id.alias("sf_id"), label.alias("label"), pruned(fields).alias("fields"), pruned(parents).alias("parents"), (deferred if deferred is not None else _empty()).alias("deferred"))


def club_rows(rows: DataFrame, accounts: DataFrame | None = None) -> DataFrame:
    """Rows with canonical text and the account each goes to: the pinned one, else the matched one (team, account_id)."""
    texts = [c for c, t in rows.dtypes if t == "string"]
    out = rows.withColumns({c: text(F.col(c)) for c in texts})
    if accounts is not None:
        a = accounts.select(F.col("truth_name").alias("team"), F.col("account_id").alias("matched_id"))
        out = out.join(a, "team", "left")
    else:
        out = out.withColumn("matched_id", F.lit(""))
    known = F.when(strip(F.col("customer_id")) != "", strip(F.col("customer_id"))).otherwise(F.coalesce("matched_id", F.lit("")))
    contact = (F.col("contact_email") != "") | (F.col("contact_name") != "")
    return out.withColumns({"account_id": known, "has_contact": contact, "attach_id": strip(F.col("opportunity_id")), "row_key": F.concat("team", F.lit("#"), F.col("src_pos").cast("string"))})


def accounts(rows: DataFrame, deal: Deal) -> DataFrame:
    c = F.col
    country, phone = country_code(c("billing_country")), c("contact_phone")
    fields = payload(
        name=c("team"), billing_country=country, billing_state=c("billing_state"), billing_street=c("billing_street"), billing_postal=c("billing_postal"), billing_city=c("billing_city"),
        currency=F.lit(deal.currency), sport=c("sport"), level=F.when(c("attach_id") == "", F.lit(deal.master_level)), org_type=F.lit("CB"), invoice_delivery=F.lit("Email"), payment_terms=F.lit("30"),
        invoice_phone=phone, shipping_phone=phone, shipping_country=country, shipping_state=c("billing_state"), shipping_street=c("billing_street"), shipping_postal=c("billing_postal"), shipping_city=c("billing_city"),
    )
    fields = F.map_concat(fields, F.map_from_arrays(F.array(tax_field(c("billing_country"))), F.array(c("tax_id"))))
    ref = F.concat(F.lit("ACC:"), c("team"))
    roles = F.when(c("has_contact"), F.create_map(*[x for r in ROLES for x in (F.lit(r), F.concat(F.lit("CON:"), c("team")))])).otherwise(_empty())
    old = c("account_id") != ""
    # A club on several rows is one account: its first row plans it.
    first = rows.withColumn("_n", F.row_number().over(Window.partitionBy("team").orderBy("src_pos"))).where("_n = 1 or account_id <> ''")
    return _record(first, F.lit(0), "account", F.when(old, "upsert").otherwise("create"), ref, c("account_id"), F.concat(F.lit("Account "), c("team"), F.when(old, " (existing)").otherwise(" (NEW)")), fields, _empty(), roles)


def contacts(rows: DataFrame, deal: Deal) -> DataFrame:
    c = F.col
    name = split_name(c("contact_name"), repeat_single=True)
    fields = payload(first_name=name["first"], last_name=name["last"], email=c("contact_email"), phone=c("contact_phone"), owner_id=F.lit(deal.master_owner))
    return _record(rows.where("has_contact"), F.lit(0), "contact", F.lit("create"), F.concat(F.lit("CON:"), c("team")), F.lit(""), F.concat(F.lit("Contact "), c("contact_name"), F.lit(" <"), c("contact_email"), F.lit(">")), fields, payload(account_id=F.concat(F.lit("ACC:"), c("team"))))


def opportunities(rows: DataFrame, deal: Deal) -> DataFrame:
    """New deals inherit from the master deal; rows that name a deal update a few of its fields."""
    c = F.col
    own = team_gender(c("gender"))
    gender = F.when(own != "", own).otherwise(F.lit(deal.gender))
    note = F.when(truthy(c("exchange")), F.lit(deal.exchange_note))
    both = dict(stage=F.lit(deal.stage), forecast=F.lit(deal.forecast), currency=F.lit(deal.currency), pricebook_id=F.lit(deal.pricebook_id), opp_type=F.lit("New"), order_type=F.lit("New order"), event_source=F.lit("Not applicable"),
                account_name=F.concat(c("team"), F.lit(" " + deal.account_suffix)), effective_start=iso_date(c("effective_start")), sport=c("sport"), master_id=F.lit(deal.master_id), gender=gender, order_notes=note)
    full = strip(F.concat_ws(" ", c("team"), c("sport")))
    name = F.when(full != "", full).when(strip(c("order_name")) != "", strip(c("order_name"))).otherwise(c("team"))
    ref = F.concat(F.lit("OPP:"), c("row_key"))
    contact = F.when(c("has_contact"), F.concat(F.lit("CON:"), c("team")))
    new = _record(rows.where("attach_id = ''"), F.lit(0), "opportunity", F.lit("create"), ref, F.lit(""), F.concat(F.lit("Opportunity "), name), payload(name=name, close_date=F.lit(deal.master_close), owner_id=F.lit(deal.owner or deal.master_owner), record_type=F.lit(deal.record_type), **both), payload(primary_contact=contact, system_admin=contact, account_id=F.concat(F.lit("ACC:"), c("team"))))
    old = _record(rows.where("attach_id <> ''"), F.lit(0), "opportunity", F.lit("upsert"), ref, c("attach_id"), F.concat(F.lit("Opportunity (existing) "), c("team"), F.lit(" ["), c("attach_id"), F.lit("]")), payload(owner_id=F.lit(deal.owner), **both), payload(primary_contact=contact, system_admin=contact))
    return new.unionByName(old)


def filled_cameras(rows: DataFrame) -> DataFrame:
    """One row per camera with a type or scene."""
    return rows.select("*", F.posexplode(F.filter("cameras", lambda k: (k["type"] != "") | (k["scene"] != "")))).withColumnRenamed("pos", "cam_pos").withColumnRenamed("col", "camera")


def lines(rows: DataFrame, book: DataFrame, deal: Deal) -> tuple[DataFrame, DataFrame]:
    """Line records and warnings: subscriptions (with a voucher, a second line of quantity -1) and cameras."""
    c = F.col
    to_master = deal.structure == CAMERAS_TO_LEAGUE
    parent = F.lit(deal.master_id) if to_master else F.concat(F.lit("OPP:"), c("row_key"))
    cams = priced(filled_cameras(rows).withColumn("product_name", c("camera.type")), book)
    missing = cams.where("book_product is null").select("src_pos", F.concat(c("team"), F.lit(": camera product not in price book: "), c("product_name")).alias("warning"))
    fields = payload(product_id=c("book_product_id"), entry_id=c("book_entry_id"), quantity=F.lit(1), unit_price=unit_price(deal.camera_pricing, discounts=deal.camera_discounts), charge_type=F.lit("One-off"), charge_name=c("book_product"), list_price=c("book_list_price"), sport=c("sport"), scene=c("camera.scene"), position=c("camera.position"), order_kind=F.lit("Shipment - No additional cost"))
    place = F.row_number().over(Window.partitionBy("src_pos").orderBy("cam_pos")) - 1
    good = cams.where("book_product is not null").withColumn("slot", place)
    out = _record(good, F.lit(10) + c("slot"), "line", F.lit("create"), F.concat(F.lit("OLI:"), c("row_key"), F.lit(":"), c("slot").cast("string")), F.lit(""), F.concat(F.lit("OLI "), c("team"), F.lit(" cam"), (c("slot") + 1).cast("string")), fields, payload(opportunity_id=parent))
    if deal.structure == CAMERAS_AND_SUBSCRIPTIONS:
        subs = priced(rows.where(c("subscription") != "").withColumn("product_name", c("subscription")), book)
        missing = missing.unionByName(subs.where("book_product is null").select("src_pos", F.concat(c("team"), F.lit(": subscription not in price book: "), c("product_name")).alias("warning")))
        price = c("book_list_price") if deal.voucher else unit_price(deal.subscription_pricing, discounts=deal.subscription_discounts)
        signs = F.array(F.lit(1), F.lit(-1)) if deal.voucher else F.array(F.lit(1))
        both = subs.where("book_product is not null").withColumn("quantity", F.explode(signs))
        back = c("quantity") < 0
        fields = payload(product_id=c("book_product_id"), entry_id=c("book_entry_id"), quantity=c("quantity"), unit_price=price, charge_type=F.lit("Recurring"), charge_name=c("book_product"), list_price=c("book_list_price"), billing_period=F.lit(deal.billing_period), price_period=F.lit(deal.billing_period), voucher=F.when(back, "true"))
        ref = F.concat(F.lit("OLI:"), c("row_key"), F.when(back, ":sub_voucher").otherwise(":sub"))
        label = F.concat(F.lit("OLI sub "), c("team"), F.lit(" "), c("subscription"), F.when(back, " (VOUCHER)").otherwise(""))
        out = out.unionByName(_record(both, F.when(back, 1).otherwise(0), "line", F.lit("create"), ref, F.lit(""), label, fields, payload(opportunity_id=F.concat(F.lit("OPP:"), c("row_key")))))
    return out, missing


def numbered(line_records: DataFrame) -> DataFrame:
    """Lines with their number within their deal, in plan order, as a field."""
    n = F.row_number().over(Window.partitionBy(F.col("parents")["opportunity_id"]).orderBy("plan_pos"))
    return line_records.withColumn("fields", F.map_concat(F.map_filter("fields", lambda k, v: k != "line_number"), F.create_map(F.lit("line_number"), n.cast("string"))))


def shipping_counts(rows: DataFrame) -> DataFrame:
    """(camera, region, quantity) over all filled cameras."""
    each = filled_cameras(rows).select(shipping_camera(F.col("camera.type")).alias("camera"), shipping_region(F.col("billing_country")).alias("region"))
    return each.groupBy("camera", "region").agg(F.count("*").alias("quantity"))


def shipping_products(products: DataFrame, entries: DataFrame, currency: str) -> DataFrame:
    """(camera, region, product_id, entry_id, charge_name): shipping plans with a price in the currency, refurbished ones left out.

    products: (product_id, plan); entries: (entry_id, product_id, currency)."""
    from rowsmith.functions.geo import plan_camera, plan_region

    p = products.where(~F.lower("plan").contains("refurbished")).select("product_id", F.col("plan").alias("charge_name"), plan_camera(F.col("plan")).alias("camera"), plan_region(F.col("plan")).alias("region"))
    j = p.where("camera <> '' and region <> ''").join(entries.where(F.col("currency") == currency).select("product_id", "entry_id"), "product_id")
    return j.groupBy("camera", "region").agg(F.min_by(F.struct("product_id", "entry_id", "charge_name"), "product_id").alias("s")).select("camera", "region", "s.*")


def shipping_lines(rows: DataFrame, shipping: DataFrame, deal: Deal) -> tuple[DataFrame, DataFrame]:
    """Free shipping lines on the master deal, one per camera and region, after all other records; warnings where no plan fits."""
    c = F.col
    j = shipping_counts(rows).join(shipping, ["camera", "region"], "left")
    w = Window.orderBy("camera", "region")  # a handful of cameras and regions
    good = j.where("product_id is not null").withColumn("n", F.row_number().over(w)).withColumn("src_pos", F.lit(1 << 40))
    fields = payload(product_id=c("product_id"), entry_id=c("entry_id"), quantity=c("quantity"), unit_price=F.lit(0.0), charge_type=F.lit("One-off"), charge_name=c("charge_name"))
    out = _record(good, c("n"), "line", F.lit("create"), F.concat(F.lit("OLI:MASTER:ship:"), c("camera"), F.lit(":"), c("region")), F.lit(""), F.concat(F.lit("OLI master SHIP "), c("camera"), F.lit(" ["), c("region"), F.lit("] x"), c("quantity").cast("string")), fields, payload(opportunity_id=F.lit(deal.master_id)))
    bad = j.where("product_id is null").select(F.lit(1 << 40).alias("src_pos"), F.concat(F.lit("master shipping: no plan for "), c("camera"), F.lit(" / "), c("region")).alias("warning"))
    return out, bad


def row_warnings(rows: DataFrame) -> DataFrame:
    """New accounts, once per club, and contacts without a phone."""
    c = F.col
    new = rows.where("account_id = ''").groupBy("team").agg(F.min("src_pos").alias("src_pos"), F.min_by("contact_email", "src_pos").alias("email"))
    new = new.select("src_pos", F.concat("team", F.lit(": NEW account, set its website; contact "), F.when(c("email") == "", "none").otherwise(c("email"))).alias("warning"))
    quiet = rows.where("has_contact and contact_phone = ''").select("src_pos", F.concat("team", F.lit(": contact has no phone")).alias("warning"))
    return new.unionByName(quiet)


def build(rows: DataFrame, book: DataFrame, deal: Deal, matched: DataFrame | None = None, shipping: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(plan, warnings) of an order sheet's rows."""
    rows = club_rows(rows, matched)
    line_records, warnings = lines(rows, book, deal)
    plan = numbered(line_records)
    if deal.structure != CAMERAS_TO_LEAGUE:
        plan = accounts(rows, deal).unionByName(contacts(rows, deal)).unionByName(opportunities(rows, deal)).unionByName(plan)
        warnings = warnings.unionByName(row_warnings(rows))
    if deal.master_shipping and deal.master_id and shipping is not None:
        more, bad = shipping_lines(rows, shipping, deal)
        plan, warnings = plan.unionByName(more), warnings.unionByName(bad)
    return plan, warnings


def by_object(plan: DataFrame, sobject: str) -> DataFrame:
    return plan.where(F.col("sobject") == sobject)
