"""Queries without a cut of their inputs, against brute force on small tables whose keys go past any former limit."""

from __future__ import annotations

import pytest

from rowsmith.operators import plan
from rowsmith.plans import registry

PLACES = 5


@pytest.fixture
def tables(spark, tmp_path):
    """Writes tables given as (rows, schema) by name; the folder's path."""

    def write(**named):
        for name, (data, schema) in named.items():
            spark.createDataFrame(data, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return write


def companies(suppliers, customers):
    """Supplier and customer tables of (key, nation)."""
    s = [(k, f"Supplier#{k:09d}", n) for k, n in suppliers]
    c = [(k, f"Customer#{k:09d}", n) for k, n in customers]
    return {"supplier": (s, "s_suppkey long, s_name string, s_nationkey int"), "customer": (c, "c_custkey long, c_name string, c_nationkey int")}


def test_league_crosscheck_sees_all_customers(spark, tables):
    suppliers = [(k, k % 7) for k in (1, 2, 399, 400, 401, 402, 950, 1499, 123456, 123457, 777777)]
    customers = [(k, k % 3) for k in (*range(380, 420), 2, 950, 951, 1499, 12345, 123456, 123457)]
    d = tables(**companies(suppliers, customers))
    got = {r["league_pos"]: r for r in registry.league_crosscheck(spark, d).collect()}
    nation = dict(customers)
    assert set(got) == {k for k, _ in suppliers}
    for k, n in suppliers:
        # Names share their core, the number, with one customer at most; a country of another league speaks against it.
        alike = k in nation
        same = alike and n % PLACES == nation[k] % PLACES
        assert got[k]["match_type"] == ("core" if alike else ""), k
        assert got[k]["match_status"] == ("matched" if same else "unmatched"), k
        assert got[k]["account_ids"] == (f"A{k:05d}" if same else ""), k
    assert any(got[k]["match_status"] == "matched" for k in got if k > 400)


def test_greedy_exclusive_lets_all_customers_claim(spark, tables):
    suppliers, customers = [(3 * k + 1, 0) for k in range(700)], [(k, 0) for k in (*range(1, 60), *range(1990, 2400), 99_999)]
    d = tables(**companies(suppliers, customers))
    got = {r["claimer"]: r["id"] for r in registry.greedy_exclusive(spark, d).collect()}
    wishes = spark.createDataFrame([(k, r) for k, _ in customers for r in range(4)], "k long, r int").selectExpr("k", "r", "(k * 7919 + r * (104729 + k)) % 700 as place")
    wishes = {(w["k"], w["r"]): str(suppliers[w["place"]][0]) for w in wishes.collect()}
    want = {}
    for k, _ in customers:
        free = [i for r in range(4) if (i := wishes[k, r]) not in want.values()]
        if free:
            want[k] = free[0]
    assert got == want and max(got) == 99_999


def test_club_match_sees_all_customers(spark, tables):
    suppliers = [(k, 0) for k in (0, 7, 8, 9, 300, 301, 302, 315, 1500, 1501, 44_440, 44_441, 987_654_321)]
    customers = [(k, 0) for k in (0, 7, 8, 9, 300, 301, 302, 315, 1500, 1501, 44_440, 44_441, 55, 5555)]
    d = tables(**companies(suppliers, customers))
    got = sorted((r["truth_pos"], r["row_id"], r["match_type"]) for r in registry.club_match(spark, d).collect())
    # Domains of every ninth; "N F.C." is "FC N" in another order, "N GmbH" holds it.
    assert got == [(k, f"A{k}", "exact_domain" if k % 9 == 0 else "prefix_canon" if k % 2 == 0 else "containment") for k, _ in suppliers[:-1]]


def test_word_containment_sees_whole_documents(spark, tables):
    late = "filler " * 100
    docs = [(1, f"{late}Alpha\n Beta tail"), (2, "alpha beta first"), (3, f"{late}alphabeta alpha gamma beta"), (4, None), (5, ""), (6, f"{late}ends with Gamma  delta"), (7, f"{late}xalpha beta alpha betax")]
    items = [(1, "Alpha beta gamma"), (2, "gamma delta epsilon"), (3, "not there"), (4, None)]
    d = tables(documents=(docs, "doc_id long, text string"), benchmark=(items, "item_id long, text string"))
    got = sorted((r["item_id"], r["doc_id"]) for r in registry.word_containment_join(spark, d).collect())
    pad = lambda t: f" {' '.join(t.lower().split())} "
    assert got == sorted((i, k) for i, b in items if b for k, t in docs if t and pad(" ".join(b.split()[:2])) in pad(t)) == [(1, 1), (1, 2), (2, 6)]


def test_exact_join_sees_all_parts(spark, tables):
    parts = [(k, None if k % 11 == 0 else f"part {k * k % 13}") for k in range(1, 100)]
    got = {r["p_partkey"]: r["class_key"] for r in registry.exact_join(spark, tables(part=(parts, "p_partkey long, p_name string"))).collect()}
    names = dict(parts)
    assert set(got) == {k for k in names if names[k]}
    assert all((got[a] == got[b]) == (names[a] == names[b]) for a in got for b in got)
    assert sum(got[a] == got[b] for a in got for b in got) > sum(names[a] == names[b] for a in got for b in got if a % 7 == 0 and b % 7 == 1)


def test_plan_records_read_the_whole_price_book(spark, tables, monkeypatch):
    parts = [(k, 1.0) for k in range(1, 40)]
    d = tables(part=(parts, "p_partkey long, p_retailprice double"), supplier=([(1, "S1")], "s_suppkey long, s_name string"))
    seen = []
    build = plan.build
    monkeypatch.setattr(plan, "build", lambda rows, book, deal: seen.append(book.count()) or build(rows, book, deal))
    assert {(r["sobject"], r["n"]) for r in registry.plan_records(spark, d).collect()} == {("account", 1), ("contact", 1), ("opportunity", 1), ("line", 3)}
    assert seen == [len(parts)]
