from __future__ import annotations

import base64
import csv
import json

import pytest
from pyspark.sql import functions as F

from rowsmith import config as C
from rowsmith.plans import jobs
from rowsmith.sources import lookups, picklists, sheets, sinks, xlsx

HEADER = ["Rep Name", "Territory", "Submitted Date", "Period", "Priority Rank", "League", "Sport", "Tier", "GTM Motion", "Product", "Deal Type", "ARR (€)", "Target Close", "Decision Maker / Title", "Entry Point / Goal", "Competition / Risk", "What Marketing Can Do", "Why / Strategic Rationale", "New Product to Add", "Clubs/Teams to Activate", "Prerequisites", "Notes", "Scope", "SF League / Account ID", "Competitor + Renewal Year", "Product / Feature Ask"]


def deal(rep, territory, league, product, kind, arr, period="H2 2026", ref=""):
    row = dict.fromkeys(HEADER, "")
    row |= {"Rep Name": rep, "Territory": territory, "League": league, "Sport": "Football/Soccer", "Product": product, "Deal Type": kind, "ARR (€)": arr, "Period": period, "SF League / Account ID": ref, "Notes": "line one\nline two"}
    return [row[h] for h in HEADER]


@pytest.fixture
def files(tmp_path):
    def write(name, rows):
        with open(tmp_path / name, "w", newline="", encoding="utf-8") as f:
            csv.writer(f).writerows(rows)
        return str(tmp_path / name)

    write("deals.csv", [["ALL DEALS"], ["One row per league, per rep."], ["", ""], HEADER, deal("Ada", "UK", "First League", "Alpha PRO", "New", "50,000"), deal("Ada", "UK", "Second Championship", "lite", "New", "15,000"), deal("Bo", "Nordics", "Third Liga", "Alpha PRO", "New", "25000"), deal("Bo", "Nordics", "first league", "Alpha PRO PLUS", "Upsell", "35,000"), deal("Cy", "APAC", "J-League", "something", "New", "30000", ref="A9"), ["", "", "x"], ["", ""]])
    write("accounts.csv", [["﻿Account ID", "Account Name", "Org Type", "Billing Country"], ["A1", "First League", "League", "United Kingdom"], ["A2", "Third Liga", "", "Sweden"], ["A3", "A League Club", "Club", ""], ["A9", "Japan League", "League", "Japan"]])
    write("users.csv", [["User ID", "Full Name", "Active"], ["U1", "Ada King", ""], ["U2", "Bo Berg", "true"], ["U3", "Bo Old", "no"]])
    write("candidates.csv", [["Record ID", "Company/Customer name", "Country", "Number of Associated Deals", "Number of associated account (active & cancelled)", "Active ARR (new)", "Salesforce Account ID"], ["H1", "First League", "United Kingdom", "2.0", "1", "100", "A1"], ["H5", "Second Championship Cup", "", "x", "", "", ""]])
    write("company_ids.csv", [["Company/Customer name", "Record ID"], ["Third Liga", "H3"], ["Dup", "1"], ["Dup", "2"], ["Third Liga do not use", "H4"]])
    write("aliases.csv", [["league", "company_name", "company_record_id", "reason"], ["#note", "", "", ""]])
    write("manual_ids.csv", [["league", "sf_account_id", "hs_record_id", "note"], ["# none", "", "", ""]])
    write("pricebook.csv", [["Price Book Name", "Product: Product Name", "Product ID", "Price Book Entry ID", "List Price Currency", "List Price", "Family"], ["B", "Alpha LITE", "p1", "e1", "EUR", "1000", "Alpha (Subscription)"], ["B", "Alpha PRO", "p2", "e2", "EUR", "3000", "Alpha (Subscription)"], ["B", "Alpha PRO PLUS", "p3", "e3", "EUR", "5000,5", "Alpha (Subscription)"], ["B", "Cam WIDE", "p4", "e4", "USD", "700", "Systems (Purchase)"], ["B", "Alpha PRO", "p5", "e5", "EUR", "9", ""], ["B", "", "", "", "", "", ""]])
    return tmp_path


def settings(path):
    return C.Settings(**{f: str(path / f"{f.removesuffix('_csv')}.csv") for f in C.Settings.__dataclass_fields__ if f.endswith("_csv")})


def test_deals_sheet(spark, files):
    rows = sheets.deals(spark, str(files / "deals.csv"))
    got = rows.orderBy("src_pos").collect()
    assert [r["league"] for r in got] == ["First League", "Second Championship", "Third Liga", "first league", "J-League"]
    assert [r["arr_eur"] for r in got] == [50000, 15000, 25000, 35000, 30000] and got[0]["notes"] == "line one\nline two" and got[0]["src_pos"] == 5
    assert sheets.filtered(rows, rep="ADA").count() == 2 and sheets.filtered(rows, period="h1").count() == 0
    with pytest.raises(ValueError, match="no header row"):
        sheets.deals(spark, str(files / "accounts.csv"))


def test_lookups(spark, files):
    s = settings(files)
    src = lookups.source("csv", spark, s)
    assert [r["id"] for r in src.accounts().orderBy("src_pos").collect()] == ["A1", "A2", "A3", "A9"]
    assert sorted(r["id"] for r in lookups.active(src.users()).collect()) == ["U1", "U2"]
    assert lookups.CsvSource(spark, str(files / "none.csv"), s.users_csv).accounts().count() == 0
    book = lookups.pricebook(spark, s.pricebook_csv)
    assert [r["family"] for r in book.orderBy("src_pos").collect()] == ["subscription"] * 3 + ["camera", ""] and book.where("product = 'Alpha PRO PLUS'").first()["list_price"] == 5000.5
    with pytest.raises(ValueError, match="listed twice"):
        lookups.pricebook(spark, s.pricebook_csv, strict=True)
    with pytest.raises(ValueError, match="no price book entries"):
        lookups.currency_pricebook(spark, s.pricebook_csv, "SEK")
    assert lookups.currency_pricebook(spark, s.pricebook_csv, "USD").count() == 1
    with pytest.raises(FileNotFoundError):
        lookups.pricebook(spark, str(files / "none.csv"))
    assert lookups.owner_id(src.users(), "Ada King") == "U1" and lookups.owner_id(src.users(), "005A00000012345") == "005A00000012345"
    with pytest.raises(lookups.LookupError_):
        lookups.owner_id(src.users(), "Bo Old")
    pool = jobs.gather_candidates(spark, s, src).orderBy("src_pos").collect()
    assert [(r["id"], r["other_id"]) for r in pool] == [("A1", "H1"), ("", "H5"), ("A2", "H3"), ("A9", "")]


def test_recorded_source(spark, tmp_path):
    p = tmp_path / "a.json"
    p.write_text(json.dumps({"result": {"records": [{"attributes": {"type": "x"}, "Id": "1", "Name": "Big Liga", "Kind": None}, {"attributes": {}, "Id": "2", "Name": "Shop", "Kind": "League org"}, {"attributes": {}, "Id": "3", "Name": "Other", "Kind": ""}]}}))
    src = lookups.RecordedSource(spark, str(p), str(tmp_path / "none.json"), org_type_field="Kind")
    assert sorted(r["id"] for r in src.accounts().collect()) == ["1", "2"]
    with pytest.raises(lookups.LookupError_):
        src.users()


def test_build(spark, files, tmp_path):
    out = str(tmp_path / "out")
    (tmp_path / "products.json").write_text('{"aliases": {"lite": "Alpha LITE", "pro": "Alpha PRO"}, "families": ["Alpha"], "fallback_family": "Alpha"}')
    conf = settings(files)
    conf.products_json = str(tmp_path / "products.json")
    counts = jobs.build(spark, str(files / "deals.csv"), out, conf)
    assert counts == {"account_new": 0, "account_existing": 4, "contact": 0, "opportunity": 4, "opp_product": 5, "league_crosscheck": 4}
    read = lambda n: {r["League" if n == "league_crosscheck" else "Team Name"]: r for r in spark.read.option("header", True).csv(f"{out}/{n}").collect()}
    rep = read("league_crosscheck")
    assert rep["First League"]["Matched SF Account IDs"] == "A1" and rep["First League"]["Confidence"] == "120" and rep["First League"]["Total ARR (EUR)"] == "85000.00" and rep["First League"]["Matched HS Record IDs"] == "H1"
    assert rep["First League"]["Deal Review Needed?"].startswith("YES") and rep["Second Championship"]["Match Type"] == "containment" and rep["Second Championship"]["Matched SF Account IDs"] is None
    assert rep["J-League"]["Matched SF Account IDs"] == "A9"
    for name, cols in (("account_existing", sinks.ACCOUNT_COLUMNS), ("contact", sinks.CONTACT_COLUMNS), ("opportunity", sinks.OPPORTUNITY_COLUMNS), ("opp_product", sinks.PRODUCT_COLUMNS), ("league_crosscheck", sinks.REPORT_COLUMNS)):
        assert spark.read.option("header", True).csv(f"{out}/{name}").columns == cols
    assert [len(c) for c in (sinks.ACCOUNT_COLUMNS, sinks.CONTACT_COLUMNS, sinks.OPPORTUNITY_COLUMNS, sinks.PRODUCT_COLUMNS, sinks.REPORT_COLUMNS)] == [24, 8, 24, 24, 20]
    lines = spark.read.option("header", True).csv(f"{out}/opp_product").where("`Opportunity Name` like 'First%'").collect()
    assert abs(sum(float(r["Sales Price"]) for r in lines) - 85000) < 0.02 and sorted(r["ID unique OLI product"] for r in lines) == ["1", "2"]
    per = jobs.build(spark, str(files / "deals.csv"), out, conf, per_row=True, dry_run=True)
    assert per["opportunity"] == 5 and per["opp_product"] == 4
    none = jobs.build(spark, str(files / "deals.csv"), out, conf, kind="none", dry_run=True)
    assert none["account_new"] == 4


def test_order_sheet_round_trip(spark, files, tmp_path):
    path = jobs.order_sheet(spark, settings(files), str(tmp_path / "sheet.xlsx"), "My League")
    assert sheets.load_config(spark, path)["League"] == "My League" and len(sheets.load_config(spark, path)) == 13
    data = (tmp_path / "sheet.xlsx").read_bytes()
    rows = xlsx.sheet_rows(data, "Main Camera Sheet")
    assert len(rows[4]) == 41 and xlsx.sheet_rows(data, "Nope") is None
    assert [r[0] for r in xlsx.sheet_rows(data, "Lists")[1:4]] == ["Alpha LITE", "Alpha PRO", "Alpha PRO PLUS"]
    head = rows[4] + ["Camera 8 Scene ", "Camera 8 Type"]
    club = ["" for _ in head]
    for k, v in {"Team Name": " Club ", "Opportunity SF ID": "https://x.example/lightning/r/Opportunity/0061Q00000AbCdEfGH/view", "Camera 1 Type": "Cam WIDE", "Camera 8 Scene ": "Roof"}.items():
        club[head.index(k)] = v
    (tmp_path / "filled.xlsx").write_bytes(xlsx.workbook({"Main Camera Sheet": {"rows": [["t"], head, club, []]}}))
    got = sheets.load_orders(spark, str(tmp_path / "filled.xlsx")).collect()
    assert len(got) == 1 and got[0]["team"] == "Club" and got[0]["opportunity_id"] == "0061Q00000AbCdEfGH" and len(got[0]["cameras"]) == 8 and got[0]["cameras"][7]["scene"] == "Roof"
    assert jobs.deal_settings({"Deal Structure": "2 - cameras only", "Voucher setup (x?)": "yes", "Currency": "USD"}).structure == 2


def test_command_line(spark, files, tmp_path, monkeypatch, capsys):
    from rowsmith.__main__ import main

    for f in C.Settings.__dataclass_fields__:
        if f.endswith("_csv"):
            monkeypatch.setenv(f"ROWSMITH_{f.upper()}", str(files / f"{f.removesuffix('_csv')}.csv"))
    assert main(["crosscheck", "--input", str(files / "deals.csv"), "--out", str(tmp_path / "o")], spark) == 0
    assert "matched" in capsys.readouterr().out and spark.read.option("header", True).csv(str(tmp_path / "o/league_crosscheck")).count() == 4
    assert main(["gen", "--out", str(tmp_path / "s.xlsx"), "--league", "L"], spark) == 0
    assert main(["gen", "--out", str(tmp_path / "s.xlsx"), "--pricebook", str(tmp_path / "none.csv")], spark) == 2
    assert main(["import", "--sheet", str(tmp_path / "s.xlsx"), "--accounts", str(files / "accounts.csv")], spark) == 2  # no master deal


def test_cell_writes(spark):
    rows = spark.createDataFrame([(1, ["x"]), (2, ["Team Name", "Tax ID"]), (3, ["A", ""]), (4, ["B", "7"]), (5, ["", ""]), (6, ["C"])], "src_pos long, cells array<string>")
    values = spark.createDataFrame([("A", "1"), ("B", "2"), ("C", "3"), ("", "9")], "team string, value string")
    assert sorted(tuple(r) for r in sheets.cell_writes(rows, "Tax ID", values).collect()) == [(3, 2, "", "1"), (6, 2, "", "3")]
    assert sheets.cell_writes(rows, "Tax ID", values, only_blank=False).count() == 3
    with pytest.raises(ValueError, match="not writable"):
        sheets.cell_writes(rows, "Team Name", values)
    with pytest.raises(ValueError, match="no column"):
        sheets.cell_writes(rows, "SF OPP LINK", values)


def test_dependencies(spark, tmp_path):
    bits = lambda *on: base64.b64encode(bytes(sum(0x80 >> (i & 7) for i in on if i >> 3 == b) for b in range(2))).decode()
    ctrl = {"name": "sport", "picklistValues": [{"value": f"s{i}", "active": True} for i in range(10)] + [{"value": "old", "active": False}]}
    dep = {"name": "pos", "dependentPicklist": True, "controllerName": "sport", "picklistValues": [{"value": "p0", "validFor": bits(0, 9)}, {"value": "p1", "validFor": "gA=="}, {"value": "off", "active": False, "validFor": bits(1)}, {"value": "none"}]}
    (tmp_path / "d.json").write_text(json.dumps({"name": "Line", "fields": [ctrl, dep, {"name": "free", "dependentPicklist": False}]}))
    d = picklists.read_describe(spark, str(tmp_path / "d.json"))
    got = {r["control"]: r["permitted"] for r in picklists.dependencies(d, "sport", "pos").collect()}
    assert got["s0"] == ["p0", "p1"] and got["s9"] == ["p0"] and got["s1"] == [] and len(got) == 10
    picklists.write_dependencies(picklists.dependencies(d, "sport", "pos"), str(tmp_path / "out"))
    assert picklists.read_dependencies(spark, str(tmp_path / "out")).count() == 10
    for c, x in (("sport", "free"), ("pos", "pos"), ("sport", "missing")):
        with pytest.raises(ValueError):
            picklists.dependencies(d, c, x)


def test_env_file(tmp_path, monkeypatch):
    monkeypatch.delenv("RS_A", raising=False)
    monkeypatch.setenv("RS_B", "kept")
    (tmp_path / ".env").write_text("# c\nRS_A='x y'\nRS_B=new\nbad\n")
    assert C.load_env(str(tmp_path / ".env")) == {"RS_A": "x y", "RS_B": "kept"} and C.load_env(str(tmp_path / "no")) == {}
    assert C.config_value({"Master Opportunity ID": "1", "Other": ""}, "master", "id") == "1" and C.config_value({}, "x", default="d") == "d"


def test_review_files(spark, tmp_path):
    df = spark.createDataFrame([("a", "Tier A"), ("b", "")], "name string, tier string")
    sinks.review_files(df, str(tmp_path / "r"))
    assert {r["tier"] for r in spark.read.option("header", True).csv(str(tmp_path / "r")).select(F.col("tier").cast("string").alias("tier")).collect()} == {"tier-a", "none"}
