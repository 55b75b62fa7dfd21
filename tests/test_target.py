"""Plans carried out through a command-line tool: the rehearsal tool, wrapped so that it writes down what it does and fails where a test wants it to."""

from __future__ import annotations

import json
import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rowsmith.operators import changes, plan
from rowsmith.plans import execution, loads
from rowsmith.plans.tables import written
from rowsmith.sources import rehearsal, target

SF = "/root/testdata/sf0.001"
TOOL = """
import json, os, signal, sys
sys.path.insert(0, {place!r})
import rehearsal
log, argv = {log!r}, sys.argv[1:]
verb = " ".join(argv[1:3])
text = json.dumps(argv)
def say(line):
    with open(log, "a") as f: f.write(line + "\\n")
calls = sum(1 for _ in open(log)) if os.path.exists(log) else 0
if os.path.exists({marker!r}) and calls >= int(open({marker!r}).read() or 0):
    os.remove({marker!r})
    os.kill(os.getppid(), signal.SIGKILL)  # the task's worker dies with its work half done
if "REFUSE" in text and verb != "data query": print(json.dumps({{"status": 1, "message": "field integrity"}})); sys.exit(1)
if "LOOKALIKE" in text and verb == "data create": print(json.dumps({{"status": 1, "message": "Duplicate value found"}})); sys.exit(1)
if "GARBLED" in text and verb == "data create":
    rehearsal.main(argv)
    print("not json"); sys.exit(0)  # made, but the answer is lost
try:
    out = rehearsal.main(argv)
    if verb in ("data create", "api request"): say("made " + (out.get("id") or out["result"]["id"]))
    elif verb == "data update": say("changed " + out["result"]["id"])
    print(json.dumps(out))
except Exception as e:
    print(json.dumps({{"status": 1, "message": str(e)}})); sys.exit(1)
"""


class Tool:
    def __init__(self, folder: Path):
        folder.mkdir()
        self.state, self.log, self.marker = folder / "state", folder / "log", folder / "kill"
        (folder / "tool.py").write_text(TOOL.format(place=str(Path(rehearsal.__file__).parent), log=str(self.log), marker=str(self.marker)))
        self.target = target.Target(f"{sys.executable} -S {folder / 'tool.py'} {self.state}", rehearsal.KEY)

    def said(self) -> Counter:
        return Counter(self.log.read_text().splitlines()) if self.log.exists() else Counter()

    def holds(self) -> dict[tuple[str, str], dict]:
        return {(d.name, f.stem): json.loads(f.read_text()) for d in self.state.iterdir() for f in d.glob("*.json")}

    def put(self, sobject: str, ident: str, fields: dict) -> None:
        (self.state / sobject).mkdir(parents=True, exist_ok=True)
        (self.state / sobject / f"{ident}.json").write_text(json.dumps(fields | {"Id": ident}))


def seeded(spark, folder) -> tuple[Tool, dict]:
    """A tool that holds what the snapshots of the queries hold."""
    tool, snaps = Tool(folder), loads._snapshots(spark, SF)
    for sobject, df in snaps.items():
        (tool.state / sobject).mkdir(parents=True, exist_ok=True)
        for r in df.collect():
            tool.put(sobject, r["id"], r["fields"])
    return tool, snaps


def a_plan(spark):
    return written(plan.build(loads.clubs(spark, SF), loads.book(spark, SF), loads.DEAL)[0], "plan")


def logged(log) -> list:
    return sorted((r["plan_pos"], r["ref_key"], r["sobject"], r["label"], r["outcome"], r["id"] if r["outcome"] != "skipped" else "", r["reason"] or "") for r in log.collect())


def held(tool: Tool) -> dict:
    return {k: {f: v for f, v in r.items() if f != rehearsal.KEY} for k, r in tool.holds().items()}


def test_execution_equals_application_to_snapshots_and_goes_on_after_a_stop(spark, tmp_path):
    records = a_plan(spark)
    tool, snaps = seeded(spark, tmp_path / "one")
    state, log = changes.apply_plan(records, snaps)
    got, failures = execution.execute(records, tool.target, str(tmp_path / "journal"))
    assert logged(got) == logged(log) and failures.count() == 0
    for sobject, df in state.items():
        want = {r["id"]: {k: v for k, v in r["fields"].items()} for r in df.collect()}
        mine = {i: {k: v for k, v in r.items() if k not in ("Id", rehearsal.KEY)} for (o, i), r in tool.holds().items() if o == sobject}
        assert mine == want
    assert max(n for k, n in tool.said().items() if k.startswith("made ")) == 1
    # The journal answers now; nothing is called again.
    before = tool.said()
    assert logged(execution.execute(records, tool.target, str(tmp_path / "journal"))[0]) == logged(log) and tool.said() == before

    # Stopped after two of the steps, and once with a worker killed in the middle of one.
    other, _ = seeded(spark, tmp_path / "two")
    journal, stops = str(tmp_path / "journal2"), [plan.ORDER[1], execution.LATE]

    def stop(step):
        if step == stops[0]:
            stops.pop(0)
            raise KeyboardInterrupt(step)

    other.marker.write_text("7")  # dies at the eighth call
    for _ in range(len(stops) + 2):
        try:
            got, failures = execution.execute(records, other.target, journal, after=stop)
            break
        except KeyboardInterrupt:
            pass
        except Exception as e:  # the worker that was killed
            assert not other.marker.exists(), e
    assert not stops and logged(got) == logged(log) and held(other) == held(tool)
    made = {k: n for k, n in other.said().items() if k.startswith("made ")}
    assert made and set(made.values()) == {1} and set(made) == {k for k in tool.said() if k.startswith("made ")}


def test_confirmation_and_second_run(spark, tmp_path):
    records, tool = a_plan(spark), Tool(tmp_path / "tool")
    (tool.state).mkdir()
    new = records.withColumn("sf_id", F.lit("")).withColumn("operation", F.lit("create"))
    assert execution.execute(new, tool.target, str(tmp_path / "j"), confirm=lambda c: False) is None and not tool.said()
    first, _ = execution.execute(new, tool.target, str(tmp_path / "j"))
    assert {r["outcome"] for r in first.collect()} == {"created"}
    again, _ = execution.execute(new, tool.target, str(tmp_path / "j2"))  # found by their keys: nothing is made twice
    assert {r["outcome"] for r in again.collect()} == {"reused"} and max(n for k, n in tool.said().items() if k.startswith("made ")) == 1
    assert {r["ref_key"]: r["id"] for r in first.collect()} == {r["ref_key"]: r["id"] for r in again.collect()}


def test_refusals_are_typed(spark, tmp_path):
    tool = Tool(tmp_path / "tool")
    tool.put("account", "A1", {"name": "LOOKALIKE one"})
    for i in (2, 3):
        tool.put("account", f"A{i}", {"name": "LOOKALIKE two"})
    rec = lambda pos, ref, name, outcome="created", ident="", sobject="account", **f: (pos, ref, sobject, f"label {pos}", outcome, ident, {"name": name, **f})
    rows = [
        rec(1, "a", 'say "hi" = it\'s'), rec(2, "b", "REFUSE me"), rec(3, "c", "LOOKALIKE one"), rec(4, "d", "LOOKALIKE two"), rec(5, "e", "LOOKALIKE three"), rec(6, "f", "GARBLED"),
        rec(7, "", "x", "updated", "A1", phone="1"), rec(8, "", "x", "updated", "A9"), rec(9, "a", "same key"), rec(10, "c1", "Ada", sobject="contact", email="LOOKALIKE@x.example"), rec(11, "", "no key", sobject="contact"),
    ]
    df = spark.createDataFrame(rows, "plan_pos long, ref_key string, sobject string, label string, outcome string, id string, fields map<string,string>")
    got = {r["plan_pos"]: r for r in target.sent(df, tool.target, str(tmp_path / "out"), 3).collect()}
    assert len(got) == 11
    seen = {p: (r["outcome"], r["error"]) for p, r in got.items()}
    assert seen == {1: ("created", None), 2: ("skipped", "refused"), 3: ("reused", "duplicate"), 4: ("skipped", "duplicate"), 5: ("skipped", "duplicate"), 6: ("created", None), 7: ("updated", None), 8: ("skipped", "refused"), 9: ("created", None), 10: ("created", None), 11: ("skipped", "refused")}
    assert got[3]["id"] == "A1" and got[9]["id"] == got[1]["id"] and got[2]["reason"] == "create failed: field integrity" and got[8]["reason"].startswith("update failed")
    state = tool.holds()
    assert state["account", got[1]["id"]]["name"] == 'say "hi" = it\'s' and state["account", "A1"]["phone"] == "1" and ("account", got[6]["id"]) in state
    manifest = json.loads((tmp_path / "out" / target.MANIFEST).read_text())
    assert manifest["counts"] == {"created": 4, "skipped": 5, "reused": 1, "updated": 1}
    (tmp_path / "out" / "part-99999-lost.parquet").write_bytes(b"of a task that didn't count")
    assert target.outcomes_of(spark, str(tmp_path / "out")).count() == 11
    none = target.sent(df.limit(0), tool.target, str(tmp_path / "none"), 3)
    assert none.count() == 0 and none.columns == [c.split(" ")[0] for c in target.OUTCOMES.split(", ")]


def test_a_missing_tool_stops_the_task(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "account", "l", "created", "", {"name": "x"})], "plan_pos long, ref_key string, sobject string, label string, outcome string, id string, fields map<string,string>")
    with pytest.raises(Exception, match="not found"):
        target.sent(df, target.Target("/no/such/tool", "K"), str(tmp_path / "out"))
    assert not (tmp_path / "out" / target.MANIFEST).exists()


def test_lists_of_bounded_length():
    values = ["v" * n for n in (1, 50, 3, 200, 10, 10)]
    parts = list(target.lists(values, 60))
    assert [v for p in parts for v in p] == values and all(len(p) == 1 or sum(len(v) + 4 for v in p) <= 60 for p in parts)
    assert list(target.lists([], 60)) == []
