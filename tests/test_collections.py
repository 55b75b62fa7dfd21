"""Many records to a call, and pages of the rehearsal tool that read no more records than they must."""

from __future__ import annotations

import json
import sys
from dataclasses import replace
from pathlib import Path

from rowsmith.sources import rehearsal, target

TOOL = """
import json, sys
sys.path.insert(0, {place!r})
import rehearsal
argv = sys.argv[1:]
with open({log!r}, "a") as f: f.write(" ".join(argv[1:3]) + "\\n")
if "GARBLED" in " ".join(argv): print("not json"); sys.exit(0)
try:
    print(json.dumps(rehearsal.main(argv)))
except Exception as e:
    print(json.dumps({{"status": 1, "message": f"{{type(e).__name__}}: {{e}}"}})); sys.exit(1)
"""


def test_a_page_reads_its_own_records_only(tmp_path):
    ids = [f"ACC_{n:02d}" for n in range(20)]
    (tmp_path / "account").mkdir()
    for i in ids:
        (tmp_path / "account" / f"{i}.json").write_text(json.dumps({"Id": i, "name": i[-2:]}) if "ACC_05" <= i <= "ACC_09" else "no record")
    ask = lambda text: [r["Id"] for r in rehearsal.query(str(tmp_path), text)]
    assert ask("SELECT Id FROM account WHERE Id > 'ACC_04' AND Id <= 'ACC_12' ORDER BY Id LIMIT 5") == ids[5:10]
    assert ask("SELECT Id FROM account WHERE name LIKE '%0%' AND Id > 'ACC_04' ORDER BY Id LIMIT 3") == ids[5:8]
    assert ask("SELECT Id FROM account WHERE Id IN ('ACC_06', 'ACC_99')") == [ids[6]] and ask("SELECT Id FROM account WHERE Id = 'ACC_07'") == [ids[7]]
    assert rehearsal.query(str(tmp_path), "SELECT MIN(Id) low, MAX(Id) high FROM account") == [{"low": ids[0], "high": ids[-1]}]


def test_collections_do_what_single_calls_do(tmp_path):
    def sent(name: str, path: str) -> tuple[list[dict], dict, list[str]]:
        folder = tmp_path / name
        (folder / "state" / "account").mkdir(parents=True)
        (folder / "state" / "account" / "A1.json").write_text(json.dumps({"Id": "A1", "name": "old"}))
        (folder / "tool.py").write_text(TOOL.format(place=str(Path(rehearsal.__file__).parent), log=str(folder / "log")))
        to = target.Target(f"{sys.executable} -S {folder / 'tool.py'} {folder / 'state'}", rehearsal.KEY)
        row = lambda n, sobject, key, outcome="created", ident="", **f: {"plan_pos": n, "ref_key": key, "sobject": sobject, "label": "", "outcome": outcome, "id": ident, "fields": f}
        rows = [row(n, "account", f"k{n % 25}", name=f'say "{n}"') for n in range(30)]
        rows += [row(30, "contact", "c", email="x"), row(31, "contact", "", email="no key"), row(32, "account", "", "updated", "A1", phone="1"), row(33, "account", "", "updated", "A9", phone="1"), row(34, "account", "", "updated", "A1", phone="2")]
        done = [r | {"reason": r["reason"] and r["reason"].replace(str(folder), "")} for r in target.send(replace(to, collection_path=path), rows)]
        held = {(f.parent.name, f.stem): json.loads(f.read_text()) for f in (folder / "state").glob("*/*.json")}
        return done, held, (folder / "log").read_text().splitlines()

    many, held, calls = sent("many", "/services/data/v67.0/composite/sobjects")
    one, want, single = sent("one", "")
    assert many == one and held == want and held["account", "A1"]["phone"] == "2"
    assert [r["outcome"] for r in many[30:]] == ["created", "skipped", "updated", "skipped", "updated"] and many[0]["id"] == many[25]["id"]
    assert len(calls) <= 7 < 30 < len(single)
    # A call for many that fails as a whole falls back to a call each.
    assert sent("lost", "/GARBLED/composite/sobjects")[:2] == (one, want)


def test_pages_do_not_list_the_folder_again(tmp_path, monkeypatch):
    import os

    place = tmp_path / "account"
    place.mkdir()
    ids = sorted(f"ACC_{n:x}é" if n % 7 == 0 else f"ACC_{n:x}" for n in range(300))
    for i in ids:
        (place / f"{i}.json").write_text(json.dumps({"Id": i, "name": i[-1]}))
    calls, real = [], rehearsal.names
    monkeypatch.setattr(rehearsal, "names", lambda *a: calls.append(a) or real(*a))
    ask = lambda text: [r["Id"] for r in rehearsal.query(str(tmp_path), text)]
    assert ask("SELECT Id FROM account ORDER BY Id LIMIT 3") == ids[:3]
    os.utime(place, (1_700_000_000, 1_700_000_000))  # nothing changed for long
    calls.clear()
    got, last = [], ""
    while page := ask(f"SELECT Id FROM account WHERE Id > '{last}' AND Id <= '{ids[250]}' ORDER BY Id LIMIT 7"):
        got, last = got + page, page[-1]
    assert got == ids[:251] and len(calls) == 1
    assert ask("SELECT Id FROM account WHERE Id >= 'ACC_5' AND Id < 'ACC_7' AND name = '1' ORDER BY Id") == [i for i in ids if "ACC_5" <= i < "ACC_7" and i[-1] == "1"]
    assert ask("SELECT Id FROM account WHERE Id > 'B'") == [] and ask("SELECT Id FROM account WHERE Id < 'A'") == []
    assert rehearsal.query(str(tmp_path), "SELECT MIN(Id) low, MAX(Id) high FROM account") == [{"low": ids[0], "high": ids[-1]}] and len(calls) == 1
    (place / "ACC_00.json").write_text(json.dumps({"Id": "ACC_00"}))  # by whoever
    (place / f"{ids[0]}.json").unlink()
    assert ask("SELECT Id FROM account ORDER BY Id LIMIT 2") == ["ACC_00", ids[1]]


def test_ranges_of_digests_are_even():
    import hashlib

    from rowsmith.sources import command

    keys = sorted("SUP_" + hashlib.sha256(str(n).encode()).hexdigest()[:32] for n in range(4000))
    cut = command.key_ranges(keys[0], keys[-1], 4)
    sizes = [sum((a is None or k > a) and (b is None or k <= b) for k in keys) for a, b in cut]
    assert sum(sizes) == 4000 and len(sizes) == 4 and max(sizes) < 1200
