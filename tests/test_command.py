"""Lookups through a command-line tool, here a script that answers from a dictionary and writes down what it was asked."""

from __future__ import annotations

import sys

import pytest

from rowsmith.sources import command, lookups

TOOL = """
import json, re, sys, time
log, query = sys.argv[1], sys.argv[2]
open(log, "a").write(query + "\\n")
if "Slow" in query: time.sleep(30)
if "Broken" in query: print("not json", end=""); print("why", file=sys.stderr); sys.exit(0)
if "Refused" in query: print(json.dumps({"status": 1, "message": "no such object"})); sys.exit(1)
rows = {
    "Account": [{"attributes": {"type": "Account"}, "Id": "A1", "Name": "Big League", "Kind__c": None, "BillingCountry": "Sweden", "Website": "HTTPS://WWW.Big.example/x", "Owner": {"attributes": {}, "Name": "Ada"}},
                {"attributes": {"type": "Account"}, "Id": "A2", "Name": "Town", "Kind__c": "Federation", "BillingCountry": None, "Website": None, "Owner": None}],
    "User": [{"Id": "U1", "Name": "Ada", "Email": "a@x.example", "IsActive": True}, {"Id": "U2", "Name": "Bob", "Email": None, "IsActive": False}],
}[re.search(r"FROM (\\w+)", query)[1]]
if "IsActive = true" in query: rows = [r for r in rows if r["IsActive"]]
one = re.search(r"Id = '(\\w+)'", query)
print(json.dumps({"status": 0, "result": {"records": [r for r in rows if not one or r["Id"] == one[1]]}}))
sys.exit(3)  # the exit status says nothing
"""


@pytest.fixture
def tool(tmp_path):
    (tmp_path / "tool.py").write_text(TOOL)
    log = tmp_path / "log"
    return f"{sys.executable} {tmp_path / 'tool.py'} {log}", lambda: log.read_text().splitlines()


def test_live_source(spark, tool):
    line, asked = tool
    source = command.LiveSource(spark, line, org_type_field="Kind__c")
    assert [(r["id"], r["name"], r["country"], r["org_type"], r["sport"]) for r in source.accounts().collect()] == [("A1", "Big League", "Sweden", "", ""), ("A2", "Town", "", "Federation", "")]
    assert source.accounts().count() == 2 and len(asked()) == 1  # asked once
    assert asked()[0].startswith("SELECT Id, Name, BillingCountry, Kind__c, Sport__c FROM Account WHERE (Name LIKE '%league%' OR ") and "Kind__c LIKE '%federation%'" in asked()[0]
    assert [(r["id"], r["name"], r["email"]) for r in source.users().collect()] == [("U1", "Ada", "a@x.example")]
    assert asked()[1] == "SELECT Id, Name, Email, IsActive FROM User WHERE IsActive = true"
    assert {r["id"]: r["domain"] for r in source.companies().collect()} == {"A1": "HTTPS://WWW.Big.example/x", "A2": ""}
    assert source.record("Account", "A1", ["Name", "Owner.Name"]) == {"Id": "A1", "Name": "Big League", "Owner.Name": "Ada"}
    assert asked()[-1] == "SELECT Id, Name, Owner.Name FROM Account WHERE Id = 'A1'"
    with pytest.raises(lookups.LookupError_, match="none found"):
        source.record("Account", "A9", ["Name"])
    rows = command.records(spark, line, "Account", ["Id", "Name"]).where("Name like '%Lea%'")
    assert [r["Id"] for r in rows.collect()] == ["A1"] and asked()[-1].endswith("WHERE Name LIKE '%Lea%'")  # pushed, and applied again


def test_answers(tool):
    line, _ = tool
    ask = lambda sobject, seconds=20: command.answered(line.split(), command.query_text(sobject, ["Id"]), seconds)
    assert len(ask("Account")) == 2
    with pytest.raises(command.NoAnswer, match="within 1 s"):
        ask("Slow", 1)
    with pytest.raises(command.BadAnswer, match="no JSON; why"):
        ask("Broken")
    with pytest.raises(command.BadAnswer, match="no such object"):
        ask("Refused")
    with pytest.raises(command.ToolMissing):
        command.answered(["/no/such/tool"], "SELECT Id FROM Account", 1)
    assert command.quoted("O'Neil\\") == "'O\\'Neil\\\\'" and command.quoted(True) == "true" and command.quoted(3) == "3"


def _rehearsed(folder, n):
    """A rehearsal tool that holds ``n`` accounts, and the line to call it."""
    import json
    import pathlib

    from rowsmith.sources import rehearsal

    (folder / "state" / "Account").mkdir(parents=True)
    for i in range(n):
        ident = f"001{(i * 7919) % 100_000:05d}x{chr(65 + i % 26)}"
        (folder / "state" / "Account" / f"{ident}.json").write_text(json.dumps({"Id": ident, "Name": f"Name {i}", "Owner": "O'Neil" if i % 5 else None}))
    wrapper = folder / "tool.py"
    wrapper.write_text(f"import sys, json\nsys.path.insert(0, {str(pathlib.Path(rehearsal.__file__).parent)!r})\nimport rehearsal\nopen({str(folder / 'log')!r}, 'a').write(sys.argv[-1] + '\\n')\nprint(json.dumps(rehearsal.main(sys.argv[1:])))\n")
    return f"{sys.executable} -S {wrapper} {folder / 'state'} data query --json --query", lambda: (folder / "log").read_text().splitlines()


def test_scans_in_ranges_and_pages(spark, tmp_path):
    line, asked = _rehearsed(tmp_path, 230)
    whole = [tuple(r) for r in command.records(spark, line, "Account", ["Id", "Name", "Owner"]).collect()]
    assert len(whole) == 230 and len(asked()) == 1
    parts = command.records(spark, line, "Account", ["Name", "Id", "Owner"], tasks=6, page=20)
    got = parts.select("Id", "Name", "Owner").collect()
    assert [tuple(r) for r in got] == sorted(whole)  # in the order of ids, across tasks too
    queries = asked()[1:]
    assert "SELECT MIN(Id) low, MAX(Id) high FROM Account" in queries and all(q.endswith("LIMIT 20") for q in queries if "MIN(Id)" not in q)
    assert parts.rdd.getNumPartitions() == 6 and len(queries) >= 230 // 20
    some = command.records(spark, line, "Account", ["Name"], tasks=3, page=50).where("Name like 'Name 1%'")
    assert {r["Name"] for r in some.collect()} == {f"Name {i}" for i in range(230) if str(i).startswith("1")}
    assert "LIKE 'Name 1%' AND Id > " in asked()[-1] or "LIKE 'Name 1%' AND Id <= " in asked()[-1] or "LIKE 'Name 1%' ORDER" in asked()[-1]
    assert command.records(spark, line, "Nothing", ["Id"], tasks=4, page=10).count() == 0
    source = command.LiveSource(spark, line, tasks=4, page=30)
    rows = source.companies().orderBy("src_pos").collect()
    assert [r["id"] for r in rows] == sorted(r["id"] for r in rows) and len(rows) == 230


def test_many_point_lookups(spark, tmp_path):
    line, asked = _rehearsed(tmp_path, 120)
    ids = [r["Id"] for r in command.records(spark, line, "Account", ["Id"]).collect()]
    wanted = spark.createDataFrame([(i,) for i in [*ids[:90], *ids[:10], "", None, "nobody", "it's"]], "id string")
    before = len(asked())
    got = command.point_records(wanted, line, "Account", ["Name", "Owner"], tasks=3, chars=300)
    assert {r["Id"] for r in got.collect()} == set(ids[:90]) and got.count() == 90 and got.columns == ["Id", "Name", "Owner"]
    queries = asked()[before:]
    assert all(len(q) < 400 for q in queries) and len(queries) < 60
    by_name = command.point_records(spark.createDataFrame([("Name 3",), ("Name 5",)], "n string"), line, "Account", ["Id"], key="Name")
    assert {r["Name"] for r in by_name.collect()} == {"Name 3", "Name 5"}
    assert {r["Name"] for r in command.LiveSource(spark, line).records_of("Account", wanted, ["Name"]).collect()} and command.point_records(wanted.limit(0), line, "Account", ["Name"]).count() == 0


def test_ranges_cover_all_keys_evenly():
    import random

    rng = random.Random(41)
    for _ in range(300):
        keys = sorted({"".join(rng.choice(command.SIGNS) for _ in range(rng.randrange(1, 14))) for _ in range(60)})
        if rng.random() < 0.5:
            keys = sorted("0015w" + k for k in keys)
        cut = command.key_ranges(keys[0], keys[-1], rng.randrange(1, 9))
        places = [[k for k in keys if (a is None or k > a) and (b is None or k <= b)] for a, b in cut]
        assert [k for p in places for k in p] == keys
    assert command.key_ranges("a", "a", 5) == [(None, None)]
    even = command.key_ranges("001000000", "001zzzzzz", 4)
    assert [b[3] for _, b in even[:-1]] == ["F", "V", "k"] or len(even) == 4
