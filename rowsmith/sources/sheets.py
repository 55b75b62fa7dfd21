"""Hand-filled sheets: preamble, header row somewhere, columns by label.

A sheet is read as rows of cells with their position, a large one by several tasks (see
``records``). The header is found on the driver (a sheet has one header); everything below
it is a DataFrame projection."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsmith.functions.amounts import amount
from rowsmith.functions.text import record_id, strip, text
from rowsmith.sources.records import csv_records
from rowsmith.sources.xlsx import read_xlsx

# Column labels of a deals sheet, and the fields they fill.
DEAL_LABELS = {
    "rep name": "rep_name", "territory": "territory", "submitted date": "submitted_date", "period": "period", "priority rank": "priority_rank", "league": "league", "sport": "sport", "tier": "tier",
    "gtm motion": "gtm_motion", "product": "product", "deal type": "deal_type", "arr (€)": "arr_eur", "arr": "arr_eur", "target close": "target_close", "decision maker / title": "decision_maker",
    "entry point / goal": "entry_point", "competition / risk": "competition_risk", "what marketing can do": "marketing_ask", "why / strategic rationale": "strategic_rationale",
    "new product to add": "new_product_to_add", "clubs/teams to activate": "clubs_to_activate", "prerequisites": "prerequisites", "notes": "notes", "scope": "scope", "sf league / account id": "account_ref",
    "competitor + renewal year": "competitor_renewal_year", "product / feature ask": "product_feature_ask", "master opportunity": "master_opportunity", "master opportunity id": "master_opportunity",
    "master opp": "master_opportunity", "master opp id": "master_opportunity", "mother opportunity": "master_opportunity", "mother deal": "master_opportunity", "mother deal id": "master_opportunity",
}
DEAL_FIELDS = list(dict.fromkeys(DEAL_LABELS.values()))
# Column labels of an order sheet.
ORDER_LABELS = {
    "team": ["Team Name"], "order_name": ["Order Name"], "gender": ["Team Gender"], "sport": ["Sport"], "arena": ["Arena Name"], "customer_id": ["Customer SF ID"], "opportunity_id": ["Opportunity SF ID", "SF OPP LINK"],
    "effective_start": ["Effective Start Date"], "contact_name": ["Contact Name"], "contact_email": ["Contact Email"], "contact_phone": ["Contact Number"], "billing_country": ["Billing Country"],
    "billing_street": ["Billing Street"], "billing_postal": ["Billing Postal Code/Zip Code"], "billing_state": ["Billing Province/State"], "billing_city": ["Billing City"], "tax_id": ["Tax ID"],
    "subscription": ["Subscription"], "exchange": ["League Exchange"],
}
CAMERA_PARTS = {"scene": "Scene", "type": "Type", "position": "Position of Field", "install_status": "Installation/Calibration Status"}
MARKER = "Team Name"
MAX_CAMERAS = 7


def squeezed(label: str | None) -> str:
    return " ".join((label or "").split())


def read_rows(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """(src_pos, cells): all rows of a CSV or xlsx sheet, position 1 being the first; blank rows count and have no cells."""
    if path.lower().endswith(".xlsx"):
        return read_xlsx(spark, path, sheet)
    return csv_records(spark, path)


def header(rows: DataFrame, marker: str, first: int | None = None, fold: bool = True) -> tuple[int, list[str]]:
    """Position and labels of the first row with the marker cell, within the first ``first`` rows if given."""
    same = lambda c: F.regexp_replace(F.trim(F.lower(c) if fold else c), r"(?U)\s+", " ") == (marker.lower() if fold else marker)
    found = rows.where(F.exists("cells", same))
    if first:
        found = found.where(F.col("src_pos") <= first)
    hit = found.orderBy("src_pos").limit(1).collect()
    if not hit:
        raise ValueError(f"no header row with {marker!r}" + (f" in the first {first} rows" if first else ""))
    return hit[0]["src_pos"], list(hit[0]["cells"])


def cell(i: int | None) -> Column:
    """A trimmed cell; a missing column or a short row is empty."""
    return F.lit("") if i is None else strip(F.coalesce(F.get("cells", F.lit(i)), F.lit("")))


def deals(spark: SparkSession, path: str) -> DataFrame:
    """A deals sheet: src_pos, its text fields, arr_eur. Rows without a person or a league are passed over."""
    rows = read_rows(spark, path)
    at, labels = header(rows, "rep name", 15)
    place: dict[str, int] = {}
    for i, label in enumerate(labels):
        if (name := DEAL_LABELS.get(squeezed(label).lower())) is not None:
            place[name] = i  # of columns for one field the last one counts
    out = rows.where(F.col("src_pos") > at).select("src_pos", *[cell(place.get(f)).alias(f) for f in DEAL_FIELDS])
    return out.withColumn("arr_eur", amount(F.col("arr_eur"))).where("rep_name <> '' and league <> ''")


def filtered(rows: DataFrame, rep: str = "", period: str = "") -> DataFrame:
    """Rows of one person and period, whatever the case."""
    for c, v in (("rep_name", rep), ("period", period)):
        if v:
            rows = rows.where(F.lower(F.trim(F.col(c))) == v.strip().lower())
    return rows


def orders(rows: DataFrame, labels: dict[str, list[str]] | None = None) -> DataFrame:
    """Club rows of an order sheet's raw rows: src_pos, text fields, cameras (as many as the header numbers)."""
    labels = ORDER_LABELS | (labels or {})
    at, head = header(rows, MARKER, fold=False)
    place: dict[str, int] = {}
    for i, label in enumerate(map(squeezed, head)):
        if label:
            place.setdefault(label, i)
    count = max([int(m[1]) for k in place if (m := re.match(r"Camera (\d+)\b", k))], default=MAX_CAMERAS)
    first = lambda names: F.coalesce(*[F.when(cell(place[n]) != "", cell(place[n])) for n in names if n in place], F.lit(""))
    cameras = F.array(*[F.struct(F.lit(n).alias("index"), *[cell(place.get(f"Camera {n} {label}")).alias(k) for k, label in CAMERA_PARTS.items()]) for n in range(1, count + 1)])
    below = rows.where(F.col("src_pos") > at)
    out = below.select("src_pos", *[first(names).alias(f) for f, names in labels.items()], cameras.alias("cameras")).where("team <> ''")
    return out.withColumns({c: record_id(F.col(c)) for c in ("customer_id", "opportunity_id")}).withColumn("pinned_id", F.col("customer_id"))


def load_orders(spark: SparkSession, path: str, sheet: str = "Main Camera Sheet") -> DataFrame:
    return orders(read_rows(spark, path, sheet))


def load_config(spark: SparkSession, path: str, sheet: str = "Config") -> dict[str, str]:
    """Labels and values of the two-column config tab; empty without one."""
    if not path.lower().endswith(".xlsx"):
        return {}
    rows = read_xlsx(spark, path, sheet, missing_ok=True).where(F.size("cells") > 0)
    pairs = rows.select(F.trim(F.get("cells", F.lit(0))).alias("k"), text(F.get("cells", F.lit(1))).alias("v")).where("k <> ''").orderBy("src_pos")
    return {r["k"]: r["v"].strip() for r in pairs.collect()}


def cell_writes(rows: DataFrame, column: str, values: DataFrame, writable: tuple[str, ...] = ("SF OPP LINK", "Tax ID"), only_blank: bool = True) -> DataFrame:
    """(row, col, old, new): what to write into one permitted column for rows whose team is in ``values`` (team, value)."""
    if column not in writable:
        raise ValueError(f"{column!r} is not writable; permitted are {writable}")
    at, head = header(rows, MARKER, fold=False)
    head = [(h or "").strip() for h in head]
    if column not in head:
        raise ValueError(f"the sheet has no column {column!r}")
    w, t = head.index(column), head.index(MARKER)
    mine = rows.where(F.col("src_pos") > at).select(F.col("src_pos").alias("row"), F.lit(w + 1).alias("col"), cell(w).alias("old"), cell(t).alias("team")).where("team <> ''")
    out = mine.join(values.where(text(F.col("value")) != ""), "team").select("row", "col", "old", F.col("value").alias("new"))
    return out.where("old = ''") if only_blank else out
