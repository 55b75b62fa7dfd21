"""CSV records read in parallel against Python's csv; ordered claims, cut into parts, against a sequential loop."""

from __future__ import annotations

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from rowsmith.operators import components, exclusive, match
from rowsmith.sources import lookups, records, sheets


# ---------------------------------------------------------------- records
def python_rows(data: str) -> list[list[str]]:
    inside = False
    for line in io.StringIO(data, newline=""):
        inside = records.ends_inside(line, inside)
    return list(csv.reader(io.StringIO(data[:-1] if inside and data.endswith("\n") else data, newline="")))


@pytest.fixture
def small_ranges(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in before:
        spark.conf.set(k, "64")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def read(spark, path) -> list[list[str]]:
    got = {r["src_pos"]: r["cells"] for r in records.csv_records(spark, str(path)).collect()}
    assert sorted(got) == list(range(1, len(got) + 1))
    return [got[k] for k in sorted(got)]


def test_records_equal_pythons(spark, tmp_path, small_ranges):
    rng = random.Random(21)
    signs = ["a", "b", ",", ",", '"', '"', '""', "\n", "\n", "\r\n", "\r", "é", " ", '","', '\n"']
    cases = ["", "\n", "a", '"a\nb",c\n\n"d""e",\n', '"never closed\n,x\n' * 9, "﻿a,b\n1,2\n", '"' + "long cell\n" * 60 + '",end\nnext,1\n']
    cases += ["".join(rng.choice(signs) for _ in range(rng.randrange(40, 500))) for _ in range(5)]
    cases.append("\n".join(f'{i},"say ""{i}""","two\nlines {i}"' if i % 7 == 0 else f"{i},plain" if i % 5 else "" for i in range(300)))
    several = 0
    for i, data in enumerate(cases):
        path = tmp_path / f"{i}.csv"
        path.write_bytes(data.encode())
        assert read(spark, path) == python_rows(data.removeprefix("﻿")), data
        several += spark.read.option("lineSep", "\n").text(str(path)).rdd.getNumPartitions() > 3
    assert several > 4  # read by several tasks


def test_transitions_and_cells():
    rng = random.Random(22)
    for _ in range(20_000):
        line = "".join(rng.choice(["a", ",", '"', '""', " "]) for _ in range(rng.randrange(12)))
        row = next(csv.reader([line + "\n", "X\n"]), [])
        assert records.ends_inside(line, False) == any("\n" in c for c in row)
    assert records.pieces("a\rb\r") == ["a\r", "b\r"] and records.pieces("a\r") == ["a\r"] and records.pieces("") == [""]


def test_a_folder_of_files_is_read_in_the_order_of_names(spark, tmp_path):
    for i, data in enumerate(["h,x\n1,2\n", '3,"open\n', "4,5\n"]):
        (tmp_path / f"part-{i}.csv").write_text(data)
    assert read(spark, tmp_path) == [["h", "x"], ["1", "2"], ["3", "open"], ["4", "5"]]


def test_sheets_count_blank_lines_and_have_no_width(spark, tmp_path, small_ranges):
    lines = ["A title alone", "", "  ", *[""] * 3] + ["Rep Name,League,Notes"] + [f"Rep {i},League {i},n" if i % 9 else "" for i in range(300)] + ["Rep x,League x,n," + ",".join(f"more{k}" for k in range(40))]
    (tmp_path / "s.csv").write_text("\n".join(lines) + "\n")
    rows = sheets.read_rows(spark, str(tmp_path / "s.csv"))
    assert sheets.header(rows, "rep name", 15)[0] == 7
    with pytest.raises(ValueError):
        sheets.header(rows, "rep name", 6)
    got = {r["src_pos"]: r["league"] for r in sheets.deals(spark, str(tmp_path / "s.csv")).collect()}
    assert got == {i: line.split(",")[1] for i, line in enumerate(lines, 1) if i > 7 and line}
    wide = next(r["cells"] for r in rows.collect() if len(r["cells"]) > 3)
    assert wide[-1] == "more39" and rows.where(F.size("cells") == 0).count() > 30


def test_exports_with_a_mark_repeated_and_short_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿\n\nID,name,NAME,Billing Country\nA1,"Big, ""the"" League",second\n\nA2,,Other,Sweden,extra\n')
    got = lookups.read_csv(spark, str(tmp_path / "a.csv"), {"id": ["Id"], "name": ["Account Name", "Name"], "country": ["BillingCountry", "Billing Country"], "none": ["None"]})
    assert [tuple(r) for r in got.orderBy("src_pos").collect()] == [(1, "A1", 'Big, "the" League', "", ""), (3, "A2", "", "Sweden", "")]
    (tmp_path / "b.csv").write_text("\n")
    assert lookups.read_csv(spark, str(tmp_path / "b.csv"), {"id": ["Id"]}).count() == 0
    with pytest.raises(ValueError, match="lacks columns"):
        lookups.read_csv(spark, str(tmp_path / "a.csv"), {"x": ["Missing"]}, strict_headers=True)


# ---------------------------------------------------------------- claims
def test_components_equal_a_union(spark):
    rng = random.Random(23)
    edges = [(f"n{rng.randrange(90):03d}", f"n{rng.randrange(90):03d}") for _ in range(70)] + [(f"p{i:03d}", f"p{i + 1:03d}") for i in range(20)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a string, b string")).collect()}
    nodes = {x for e in edges for x in e if e[0] != e[1]}
    assert got == {n: min(m for m in nodes if find(m) == find(n)) for n in nodes}


def sequence(options):
    free, out = {i for _, _, i in options if i}, {}
    for c in sorted({o[0] for o in options}):
        for _, i in sorted((r, i) for d, r, i in options if d == c):
            if i in free:
                free.discard(i)
                out[c] = i
                break
    return out


@pytest.mark.parametrize("most", [components.IN_TASK, 12])
def test_claims_equal_a_loop(spark, most):
    rng = random.Random(24)
    options = [(c, r, f"i{rng.randrange(30)}") for c in range(25) for r in range(rng.randrange(0, 4))] + [(500 + c, r, f"q{c + r}") for c in range(7) for r in range(2)]
    options += [(700, 0, ""), (700, 1, "z"), (701, 0, "z"), (701, 3, "z")]
    got = {r["claimer"]: r["id"] for r in exclusive.exclusive(spark.createDataFrame(options, "claimer long, rank int, id string"), most=most).collect()}
    assert got == sequence(options)


def test_a_chain_is_gone_through_in_a_task(spark, monkeypatch):
    """Each of 120 claimers wants what the one before it wants, too: a loop of proposals would take 120 rounds."""
    options = [(0, 0, "i001")] + [(c, r, f"i{c + r:03d}") for c in range(1, 120) for r in range(2)]
    tables, name = [], exclusive.written
    monkeypatch.setattr(exclusive, "written", lambda df, what: (tables.append(what), name(df, what))[1])
    df = spark.createDataFrame(options, "claimer long, rank int, id string")
    assert {r["claimer"]: r["id"] for r in exclusive.exclusive(df).collect()} == sequence(options)
    assert tables == ["options"]


def weak_tables(spark, options):
    """Leagues, candidates and weak options out of (league, pass, key, account, deals)."""
    cands, opts = {}, []
    for league, p, key, account, deals, signal in options:
        pos = cands.setdefault((key, account, deals, signal), 1000 + len(cands))
        opts.append((league, float(p), "containment" if p == 70 else "fuzzy_overlap", key, pos, account))
    leagues = spark.createDataFrame([(i, ["Sweden"]) for i in sorted({o[0] for o in options})], "league_pos long, countries array<string>")
    rows = [(pos, account, "", f"Name {key}", "Sweden" if signal else "", deals, 0, "", f"name {key % 5}") for (key, account, deals, signal), pos in cands.items()]
    cand = spark.createDataFrame(rows, "cand_pos long, account_id string, other_id string, name string, country string, deals long, accounts long, active_arr string, norm string")
    return spark.createDataFrame(opts, "league_pos long, pass double, match_type string, key_pos long, cand_pos long, account_id string"), leagues, cand


def test_weak_hits_do_not_depend_on_how_parts_are_gone_through(spark):
    rng, shared = random.Random(25), True
    options = []
    for league in range(24):
        for _ in range(rng.randrange(1, 5)):
            account = "hub" if shared and rng.random() < 0.4 else "" if rng.random() < 0.1 else f"a{rng.randrange(30)}"
            options.append((league, rng.choice((70, 70, 80)), rng.randrange(40), account, rng.randrange(3), rng.random() < 0.7))
    opts, leagues, cands = weak_tables(spark, options)
    none = spark.createDataFrame([("a1", 3)], "id string, from_pos long")
    out = [sorted(map(tuple, match.weak_hits(opts, none, leagues, cands, most).collect())) for most in (components.IN_TASK, 12)]
    assert out[0] == out[1] and out[0]


def test_nine_leagues_of_one_account_take_few_rounds(spark, monkeypatch):
    opts, leagues, cands = weak_tables(spark, [(i, 70, 7, "hub", 1, True) for i in range(9)] + [(i, 70, 20 + i, f"own{i}", 1, True) for i in range(9)])
    rounds, name = [], match.written
    monkeypatch.setattr(match, "written", lambda df, what: (rounds.append(what), name(df, what))[1])
    none = spark.createDataFrame([], "id string, from_pos long")
    got = {(r["league_pos"], r["cand_pos"]) for r in match.weak_hits(opts, none, leagues, cands, 1).collect()}
    assert len(got) == 9 and rounds.count("taken") <= 5  # the first league has the hub, every other one its own
    rounds.clear()
    assert {(r["league_pos"], r["cand_pos"]) for r in match.weak_hits(opts, none, leagues, cands).collect()} == got and rounds.count("taken") == 0
