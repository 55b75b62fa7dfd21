"""Sinks: import files with fixed columns, review files, the order sheet.

Labels are data; a deployment whose target system names a column differently passes
``labels``. Money is turned into text only here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsmith import config as C
from rowsmith.functions.amounts import cents, charge_terms, deal_kind, money
from rowsmith.functions.text import slug, split_name, squeeze, strip, text
from rowsmith.plans.tables import written
from rowsmith.sources.sheets import CAMERA_PARTS, MAX_CAMERAS
from rowsmith.sources.xlsx import column_letters, workbook

# Column labels of the import files, in order.
ACCOUNT_COLUMNS = ["Account ID", "Team Name", "Billing Country", "Billing Street", "Billing Postal Code/Zip Code", "Billing State", "Billing City", "Tax ID", "Invoice Delivery Method", "Payment Terms", "Account Currency", "Shipping Country", "Shipping Street", "Shipping Postal Code/Zip Code", "Shipping State", "Shipping City", "Invoice Contact ID", "Shipping Contact ID", "Installation Responsible ID", "IT Responsible ID", "Org type", "Sport", "Level", "League ID"]
CONTACT_COLUMNS = ["Account ID", "Opportunity ID", "First Name", "Last Name", "Full Name", "Email", "Phone Number", "Contact Name"]
OPPORTUNITY_COLUMNS = ["Account ID", "Team Name", "Order Name", "Master Opportunity", "Opportunity ID", "Name", "Owner ID", "Close Date", "Stage", "Forecast Category", "Effective Start Date", "Deal Account Name", "System Administrator", "Primary Contact", "Opportunity Currency", "Opportunity Type", "Order Type", "Sport", "Team Gender", "Invoice Account", "Billing Period", "Notice Period (Months)", "Camera Shipping Schedule", "Shipment Status"]
PRODUCT_COLUMNS = ["Account ID", "Opportunity ID", "Opportunity Name", "Number of Product Lines", "Products", "Product ID", "Price Book Entry ID", "Sales Price", "List", "Opp Currency", "Quantity", "Unit of Measure", "Camera order type", "Charge type", "Price Period", "Billing Period", "Charge Name", "Voucher", "Shipping status", "Position of Field", "Camera Scene", "Height", "Distance from sideline (m)", "ID unique OLI product"]
REPORT_COLUMNS = ["League", "Normalized Name", "Primary Sport", "All Sports", "Rep Count", "Reps", "Forecast Rows", "Total ARR (EUR)", "Match Status", "Match Source", "Match Type", "Confidence", "Confidence Label", "Matched SF Account IDs", "Matched HS Record IDs", "Matched SF Account Names", "Existing Deals", "Deal Review Needed?", "Existing Active ARR", "Note"]


def columns(df: DataFrame, names: list[str], values: dict[str, Column], order: list[Column]) -> DataFrame:
    """The fixed columns in order; those without a value are empty. Rows come in the given order."""
    if extra := set(values) - set(names):
        raise ValueError(f"unknown columns {extra}")
    return df.orderBy(*order).select(*[text(values[n]).alias(n) if n in values else F.lit("").alias(n) for n in names])


def write_csv(df: DataFrame, path: str, labels: dict[str, str] | None = None, one_file: bool = False) -> None:
    """Files with a header, cells as they are, spaces included: each task writes its own, in order of name, or all go to
    one, as a person uploads it. Without rows there is one file of the header."""
    for old, new in (labels or {}).items():
        df = df.withColumnRenamed(old, new)
    if not one_file:
        df = written(df, "import-file")
        one_file = not df.take(1)
    out = (df.coalesce(1) if one_file else df).write.mode("overwrite").option("header", True).option("emptyValue", "").option("escape", '"')
    out.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def _account_id() -> Column:
    return F.when(F.col("match_status") == "matched", F.get("account_ids", F.lit(0)))


def account_file(results: DataFrame, s: C.Settings) -> DataFrame:
    v = {"Account ID": _account_id(), "Team Name": F.col("display_name"), "Account Currency": F.lit("EUR"), "Payment Terms": F.lit(s.payment_terms), "Invoice Delivery Method": F.lit(s.invoice_delivery), "Org type": F.lit(s.org_type), "Sport": F.col("primary_sport")}
    return columns(results, ACCOUNT_COLUMNS, v, [F.col("first_pos")])


def split_accounts(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new, existing): unmatched ones are new, all others, ambiguous ones too, exist."""
    new = F.col("match_status") == "unmatched"
    return results.where(new), results.where(~new)


def contact_file(results: DataFrame) -> DataFrame:
    """Contacts of entities that carry a contact name; without such a column, the header only."""
    have = set(results.columns)
    col = lambda c: text(F.col(c)) if c in have else F.lit("")
    rows = results.withColumns({c: col(c) for c in ("contact_name", "contact_email", "contact_phone")}).where(strip(F.col("contact_name")) != "")
    name = split_name(F.col("contact_name"))
    v = {"Account ID": F.get("account_ids", F.lit(0)), "First Name": name["first"], "Last Name": name["last"], "Full Name": F.col("contact_name"), "Email": F.col("contact_email"), "Phone Number": F.col("contact_phone"), "Contact Name": F.col("contact_name")}
    return columns(rows, CONTACT_COLUMNS, v, [F.col("first_pos")])


def _opportunity(s: C.Settings, **v: Column) -> dict[str, Column]:
    fixed = {"Stage": F.lit(s.stage), "Forecast Category": F.lit(s.forecast), "Opportunity Currency": F.lit(s.currency), "Order Type": F.lit("New order"), "Billing Period": F.lit("Annual"), "Notice Period (Months)": F.lit("1")}
    return fixed | {k.replace("_", " "): c for k, c in v.items()}


def _named(period: Column, s: C.Settings) -> tuple[Column, Column, Column]:
    period = F.when(text(period) == "", F.lit(s.default_period)).otherwise(period)
    clean = squeeze(F.col("display_name"))
    return period, clean, F.regexp_replace(F.concat(clean, F.lit(" - "), period), r"^[ -]+|[ -]+$", "")


def opportunity_file(grouped: DataFrame, s: C.Settings, master: str = "") -> DataFrame:
    """One deal per league and period; grouped rows carry first values of deal_type, target_close, master_opportunity, owner."""
    period, clean, name = _named(F.col("period"), s)
    master_id = F.when(F.col("master_opportunity") != "", F.col("master_opportunity")).otherwise(F.lit(master))
    v = _opportunity(s, Account_ID=_account_id(), Team_Name=clean, Order_Name=F.concat(period, F.lit(" Forecast")), Master_Opportunity=master_id, Name=name, Owner_ID=F.col("owner"), Close_Date=F.col("target_close"), Deal_Account_Name=F.when(clean != "", F.concat(clean, F.lit(" Perform"))), Opportunity_Type=deal_kind(F.col("deal_type")), Sport=F.col("primary_sport"), Invoice_Account=_account_id())
    return columns(grouped, OPPORTUNITY_COLUMNS, v, [F.col("first_pos")])


def opportunity_row_file(rows: DataFrame, s: C.Settings, master: str = "") -> DataFrame:
    """One deal per input row."""
    name = strip(F.concat("display_name", F.lit(" "), "product", F.when(F.col("period") != "", F.concat(F.lit(" "), "period")).otherwise("")))
    master_id = F.when(F.col("master_opportunity") != "", F.col("master_opportunity")).otherwise(F.lit(master))
    v = _opportunity(s, Account_ID=_account_id(), Team_Name=F.col("display_name"), Order_Name=F.col("product"), Master_Opportunity=master_id, Name=name, Owner_ID=F.col("owner"), Close_Date=F.col("target_close"), Deal_Account_Name=F.when(F.col("display_name") != "", F.concat("display_name", F.lit(" Perform"))), Opportunity_Type=deal_kind(F.col("deal_type")), Sport=F.col("sport"), Invoice_Account=_account_id())
    return columns(rows, OPPORTUNITY_COLUMNS, v, [F.col("src_pos")])


def product_file(lines: DataFrame, s: C.Settings, per_row: bool = False) -> DataFrame:
    """Product lines with their allocated prices; numbered within their deal."""
    terms = charge_terms(F.col("family"))
    if per_row:
        name = strip(F.concat("display_name", F.lit(" "), "cell", F.when(F.col("period") != "", F.concat(F.lit(" "), "period")).otherwise("")))
        count, number = F.lit("1"), F.lit("1")
    else:
        name = _named(F.col("period"), s)[2]
        count, number = F.count("*").over(Window.partitionBy("key")), F.col("line")
    v = {"Account ID": _account_id(), "Opportunity Name": name, "Number of Product Lines": count, "Products": F.col("product"), "Product ID": F.col("product_id"), "Price Book Entry ID": F.col("entry_id"), "Sales Price": money(F.col("allocated")), "List": money(F.col("list_price")), "Opp Currency": F.lit(s.currency), "Quantity": F.lit("1"),
         "Unit of Measure": terms["unit"], "Charge type": terms["charge_type"], "Price Period": terms["price_period"], "Billing Period": terms["billing_period"], "Charge Name": F.col("product"), "ID unique OLI product": number}
    ready = lines.withColumns({f"_v{i}": c for i, c in enumerate(v.values())})
    return columns(ready, PRODUCT_COLUMNS, {k: F.col(f"_v{i}") for i, k in enumerate(v)}, [F.col("first_pos"), F.col("line")])


def report(results: DataFrame) -> DataFrame:
    """The crosscheck report, one row per league."""
    c = F.col
    hit = c("match_status") == "matched"
    v = {
        "League": c("display_name"), "Normalized Name": c("league_key"), "Primary Sport": c("primary_sport"), "All Sports": F.array_join("sports", "; "), "Rep Count": F.size("rep_names"), "Reps": F.array_join("rep_names", "; "), "Forecast Rows": c("n_rows"),
        "Total ARR (EUR)": cents(c("total_arr")), "Match Status": c("match_status"), "Match Source": c("match_source"), "Match Type": c("match_type"), "Confidence": c("confidence"), "Confidence Label": c("confidence_label"),
        "Matched SF Account IDs": F.array_join("account_ids", "; "), "Matched HS Record IDs": F.array_join("other_ids", "; "), "Matched SF Account Names": F.array_join("account_names", "; "), "Existing Deals": F.when(hit, c("deals")),
        "Deal Review Needed?": F.when(hit & (c("deals") > 0), "YES — check CRM for duplicate deals"), "Existing Active ARR": F.when(hit, c("active_arr")), "Note": c("note"),
    }
    return columns(results, REPORT_COLUMNS, v, [c("first_pos")])


def review_files(matches: DataFrame, path: str) -> None:
    """Review rows as one folder per tier."""
    matches.withColumn("tier", F.when(strip(F.col("tier")) == "", "none").otherwise(slug(F.col("tier")))).write.mode("overwrite").partitionBy("tier").option("header", True).csv(path)


def order_sheet(subscriptions: list[str], cameras: list[str], league: str = "", rows: int = 60, positions: list[str] = (), sports: list[str] = (), genders: tuple[str, ...] = ("Mens", "Womens", "Mens and Womens"), currencies: tuple[str, ...] = ("EUR", "USD", "GBP", "SEK")) -> bytes:
    """An empty order sheet with dropdowns, a hidden tab of their values, and a config tab, as xlsx."""
    base = ["Team Name", "Order Name", "Team Gender", "Sport", "Number Of Products", "Arena Name", "Customer SF ID", "Opportunity SF ID", "Effective Start Date", "Contact Name", "Contact Email", "Contact Number", "Billing Country", "Billing Street", "Billing Postal Code/Zip Code", "Billing Province/State", "Billing City", "Tax ID", "Subscription", "League Exchange"]
    labels = base + [f"Camera {n} {CAMERA_PARTS[p]}" for n in range(1, MAX_CAMERAS + 1) for p in ("scene", "type", "position")]
    tabs = {"Subscriptions": subscriptions, "Cameras": cameras, "Positions": list(positions), "Sports": list(sports), "Genders": list(genders), "YesNo": ["yes", "no"]}
    deep = max(len(v) for v in tabs.values())
    lists = [list(tabs)] + [[v[i] if i < len(v) else "" for v in tabs.values()] for i in range(deep)]
    where = {name: f"Lists!${column_letters(i)}$2:${column_letters(i)}${max(2, len(v) + 1)}" for i, (name, v) in enumerate(tabs.items(), 1)}
    kind = lambda label: "Cameras" if label.endswith(" Type") else "Positions" if label.endswith("of Field") else {"Team Gender": "Genders", "Sport": "Sports", "Subscription": "Subscriptions", "League Exchange": "YesNo"}.get(label)
    checks = {f"{column_letters(i)}6:{column_letters(i)}{5 + rows}": where[k] for i, label in enumerate(labels, 1) if (k := kind(label))}
    title = "League import: main camera sheet" + (f": {league}" if league else "")
    main = [[title], ["Fill one row per team. Billing address is shipping address."], [], [], labels]
    choices = [
        ("Deal Structure", ["1 - cameras + subscriptions", "2 - cameras only", "3 - cameras to the league"], "1 - cameras + subscriptions"), ("Master Opportunity ID", None, ""), ("League", None, league), ("Currency", list(currencies), currencies[0]),
        ("Team Gender (competition)", list(genders), genders[0]), ("Subscription pricing", ["list", "free", "discount"], "list"), ("Cameras pricing", ["list", "free", "discount"], "list"), ("Subscription billing period", ["Annual", "Quarterly", "Monthly"], "Annual"),
        ("Subscription discount price (if discounted)", None, ""), ("Voucher setup (league pre-paid the sub?)", ["no", "yes"], "no"), ("Opportunity Owner (full name or User Id)", None, ""), ("Master-opp shipping lines (per camera × region)?", ["no", "yes"], "no"),
    ]
    config = [["CONFIG"], [], *[[label, default] for label, _, default in choices]]
    pick = {f"B{i}": '"' + ",".join(opts) + '"' for i, (_, opts, _) in enumerate(choices, 3) if opts}
    return workbook({"Main Camera Sheet": {"rows": main, "lists": checks}, "Config": {"rows": config, "lists": pick}, "Lists": {"rows": lists, "hidden": True}})
