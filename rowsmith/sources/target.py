"""Writing to a target system through its command-line tool.

``TargetRecords`` is a data source to write to: each task sends its records through the
tool, one call a record, and writes what became of them, ids and typed errors included,
to a part file of its own. Its commit message names the file and counts outcomes; the
commit writes a manifest of the files of the tasks that counted, so what a lost or
repeated task left behind is never read. Only file names and counts reach the driver.

A created record carries its reference key in a field of its own. Before a task creates
anything it asks, in lists of bounded length, which keys are there already: a repeated
task finds what the lost one made instead of making it again, and so does a call that
wasn't answered in time. Equal keys must be in one task, see ``sent``.

Targets with a resource for collections take the records of a task that go together in
one call for each object; what becomes of a record doesn't depend on the others. If
such a call fails as a whole, its records are sent one by one.

What the tool prints is JSON; an exit status other than 0 is an error, with the
message from there. Errors are of a kind: 'duplicate' (a rule of the target refused a
lookalike), 'refused', 'no answer', 'bad answer'. A record whose creation a duplicate rule
refuses is the one existing record with its exact name or email, if there is just one.
"""

from __future__ import annotations

import json
import shlex
import subprocess
import uuid
from collections import Counter
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from rowsmith.sources.command import QUERY_CHARS, BadAnswer, NoAnswer, ToolMissing, lists, quoted
from rowsmith.sources.lookups import LookupError_

FORMAT = "target_records"
MANIFEST = "manifest.json"
#: What became of a record: one row of a part file.
OUTCOMES = "plan_pos long, ref_key string, sobject string, label string, outcome string, id string, reason string, error string"
_ARROW = pa.schema([("plan_pos", pa.int64()), *[(n, pa.string()) for n in ("ref_key", "sobject", "label", "outcome", "id", "reason", "error")]])
#: Records of a task that are looked up, sent and written down together.
TOGETHER = 200


class Refused(LookupError_):
    """The tool or the target system said no."""


@dataclass(frozen=True)
class Target:
    """How to reach a target system: the tool (as in a shell), the field that holds reference keys, and names.

    ``objects`` and ``fields`` give the target's names of the plan's objects and of their fields, where they differ;
    ``unique`` the field by which a duplicate is found again; ``direct`` objects are created past the duplicate
    rules, through ``direct_path`` and with ``direct_header``; ``run`` sets the keys of different imports apart;
    ``collection_path`` takes many records in one call, empty: each record is a call."""

    command: str
    key_field: str
    run: str = ""
    timeout: float = 120
    objects: dict[str, str] = field(default_factory=dict)
    fields: dict[str, dict[str, str]] = field(default_factory=dict)
    unique: dict[str, str] = field(default_factory=lambda: {"account": "name", "contact": "email"})
    direct: tuple[str, ...] = ("contact",)
    direct_path: str = "/services/data/v67.0/sobjects/{object}"
    direct_header: str = "Sforce-Duplicate-Rule-Header:allowSave=true"
    collection_path: str = ""

    def object(self, sobject: str) -> str:
        return self.objects.get(sobject, sobject)

    def name(self, sobject: str, plan_field: str) -> str:
        return self.fields.get(sobject, {}).get(plan_field, plan_field)

    def key(self, ref_key: str) -> str:
        return f"{self.run}:{ref_key}" if self.run else ref_key

    def options(self) -> dict[str, str]:
        return {"target": json.dumps(asdict(self))}

    @staticmethod
    def of(options: dict[str, str]) -> Target:
        given = json.loads(options["target"])
        return Target(**given | {"direct": tuple(given["direct"])})

    # -- calls
    def _call(self, args: list[str], body: str | None = None) -> object:
        """The JSON that the tool prints; of a list the first element."""
        out = self._answer(args, body)
        return out[0] if isinstance(out, list) and out else out

    def _answer(self, args: list[str], body: str | None = None) -> object:
        """The JSON that the tool prints."""
        line = [*shlex.split(self.command), *args]
        try:
            done = subprocess.run(line, input=body, capture_output=True, text=True, timeout=self.timeout, check=False)
        except FileNotFoundError as e:
            raise ToolMissing(f"{line[0]}: not found") from e
        except subprocess.TimeoutExpired as e:
            raise NoAnswer(f"no answer within {self.timeout:g} s") from e
        try:
            out = json.loads(done.stdout or "{}")
        except ValueError as e:
            raise (Refused if done.returncode else BadAnswer)((done.stdout.strip() or done.stderr.strip())[-300:]) from e
        said = out[0] if isinstance(out, list) and out else out
        if done.returncode:
            message = said.get("message") if isinstance(said, dict) else ""
            raise Refused(str(message or done.stdout.strip() or done.stderr.strip())[-300:])
        return out

    def _values(self, sobject: str, fields: dict[str, str]) -> str:
        """Fields as the tool's verbs take them: name="value", with quotes escaped."""
        return " ".join(f'{self.name(sobject, k)}="' + str(v).replace('"', '\\"') + '"' for k, v in fields.items())

    def query(self, text: str) -> list[dict]:
        said = self._call(["data", "query", "--query", text, "--json"])
        if not isinstance(said, dict) or "records" not in (said.get("result") or {}):
            raise BadAnswer("no result")
        return said["result"]["records"]

    def create(self, sobject: str, ref_key: str, fields: dict[str, str]) -> str:
        """The id of a new record, which carries its reference key."""
        if sobject in self.direct:
            body = {self.name(sobject, k): v for k, v in fields.items()} | {self.key_field: self.key(ref_key)}
            said = self._call(["api", "request", "rest", self.direct_path.format(object=self.object(sobject)), "--method", "POST", "--body", "-", "--header", self.direct_header], json.dumps(body))
            if not isinstance(said, dict) or not said.get("success"):
                raise Refused(str(said.get("message") or said.get("errors") or "no success") if isinstance(said, dict) else "no success")
            return said["id"]
        values = f"{self._values(sobject, fields)} {self.key_field}=" + '"' + self.key(ref_key).replace('"', '\\"') + '"'
        said = self._call(["data", "create", "record", "--sobject", self.object(sobject), "--values", values.strip(), "--json"])
        made = (said.get("result") or {}).get("id") if isinstance(said, dict) else None
        if not made:
            raise BadAnswer("no id of the new record")
        return made

    def update(self, sobject: str, ident: str, fields: dict[str, str]) -> None:
        self._call(["data", "update", "record", "--sobject", self.object(sobject), "--record-id", ident, "--values", self._values(sobject, fields), "--json"])

    def collection(self, sobject: str, rows: list[dict], old: bool) -> list[str | LookupError_]:
        """Ids of new or changed records of an object that go in one call, or errors of their own, in order."""
        own = lambda r: {"Id": r["id"]} if old else {self.key_field: self.key(r["ref_key"])}
        records = [{"attributes": {"type": self.object(sobject)}} | {self.name(sobject, k): v for k, v in (r["fields"] or {}).items()} | own(r) for r in rows]
        header = ["--header", self.direct_header] if sobject in self.direct and not old else []
        said = self._answer(["api", "request", "rest", self.collection_path, "--method", "PATCH" if old else "POST", "--body", "-", *header], json.dumps({"allOrNone": False, "records": records}))
        if not isinstance(said, list) or len(said) != len(rows):
            raise BadAnswer("not an answer for each record")
        error = lambda x: Refused("; ".join(str(e.get("message") or e) for e in x.get("errors") or []) or "no success")
        return [x["id"] if x.get("success") else error(x) for x in said]

    def made(self, sobject: str, ref_keys: Iterable[str]) -> dict[str, str]:
        """Ids of the records that carry these reference keys, by key."""
        names = {self.key(k): k for k in ref_keys}
        out: dict[str, str] = {}
        for part in lists(list(names), QUERY_CHARS):
            for r in self.query(f"SELECT Id, {self.key_field} FROM {self.object(sobject)} WHERE {self.key_field} IN ({', '.join(map(quoted, part))})"):
                out.setdefault(names[r[self.key_field]], r["Id"])
        return out

    def only(self, sobject: str, fields: dict[str, str]) -> str:
        """The id of the only record with the same value of the object's unique field; empty if there is none or several."""
        by = self.unique.get(sobject)
        if not by or not fields.get(by):
            return ""
        try:
            found = self.query(f"SELECT Id FROM {self.object(sobject)} WHERE {self.name(sobject, by)} = {quoted(fields[by])}")
        except (Refused, NoAnswer, BadAnswer):
            return ""
        return found[0]["Id"] if len(found) == 1 else ""


def _kind(e: LookupError_) -> str:
    return "no answer" if isinstance(e, NoAnswer) else "bad answer" if isinstance(e, BadAnswer) else "duplicate" if "duplicate" in str(e).lower() else "refused"


def _together(target: Target, rows: list[dict], seen: dict[tuple[str, str], str]) -> dict[int, str | LookupError_]:
    """By place what became of those of ``rows`` that went in collections; equal keys and ids after the first aren't among them."""
    groups: dict[tuple[str, bool], dict[str, int]] = {}
    for n, r in enumerate(rows):
        old = r["outcome"] == "updated"
        if old or (r["sobject"], r["ref_key"]) not in seen:
            groups.setdefault((r["sobject"], old), {}).setdefault(r["id"] if old else r["ref_key"], n)
    out: dict[int, str | LookupError_] = {}
    for (sobject, old), places in groups.items():
        try:
            out |= zip(places.values(), target.collection(sobject, [rows[n] for n in places.values()], old), strict=True)
        except ToolMissing:
            raise
        except LookupError_:  # some may have been made all the same; the others are sent one by one
            if not old:
                seen |= {(sobject, k): i for k, i in target.made(sobject, sorted(places)).items()}
    return out


def send(target: Target, rows: list[dict], seen: dict[tuple[str, str], str] | None = None) -> list[dict]:
    """What became of each of ``rows`` (plan_pos, ref_key, sobject, label, outcome created or updated, id, fields), in order.
    ``seen`` holds ids made earlier in this task, by object and key."""
    seen = {} if seen is None else seen
    for sobject in {r["sobject"] for r in rows}:
        new = {r["ref_key"] for r in rows if r["sobject"] == sobject and r["outcome"] == "created" and (sobject, r["ref_key"]) not in seen}
        seen |= {(sobject, k): i for k, i in target.made(sobject, sorted(new)).items()}
    sent_ = _together(target, rows, seen) if target.collection_path else {}
    out = []
    for n, r in enumerate(rows):
        done = {k: r[k] for k in ("plan_pos", "ref_key", "sobject", "label", "outcome", "id")} | {"reason": None, "error": None}
        key, fields = (r["sobject"], r["ref_key"]), dict(r["fields"] or {})
        try:
            if isinstance(sent_.get(n), LookupError_):
                raise sent_[n]
            if n in sent_:
                done["id"] = sent_[n]
                if r["outcome"] == "created":
                    seen[key] = sent_[n]
            elif r["outcome"] == "updated":
                target.update(r["sobject"], r["id"], fields)
            elif key in seen:
                done["id"] = seen[key]
            else:
                done["id"] = seen[key] = target.create(*key, fields)
        except ToolMissing:
            raise
        except LookupError_ as e:
            error, found = _kind(e), ""
            if r["outcome"] == "created" and error in ("no answer", "bad answer"):
                found = target.made(r["sobject"], [r["ref_key"]]).get(r["ref_key"], "")  # it may have been made all the same
            if found:
                done["id"] = seen[key] = found
            else:
                same = target.only(r["sobject"], fields) if r["outcome"] == "created" and error == "duplicate" else ""
                verb = "create" if r["outcome"] == "created" else "update"
                reason = "duplicate rule; the existing record was reused" if same else "duplicate rule; no single exact match" if error == "duplicate" and verb == "create" else f"{verb} failed: {e}"
                done |= {"outcome": "reused" if same else "skipped", "id": same, "reason": reason, "error": error}
        out.append(done)
    return out


def _place(path: str) -> tuple[fs.FileSystem, str]:
    """A folder of the shared store, as Python reaches it."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return fs.FileSystem.from_uri(path)


@dataclass
class _Sent(WriterCommitMessage):
    file: str
    counts: dict[str, int]


class TargetRecords(DataSource):
    """Options: target (see ``Target.options``), outcomes (a folder of the shared store). Takes plan_pos, ref_key, sobject,
    label, outcome (created or updated), id and fields."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Writer(dict(self.options))


class _Writer(DataSourceWriter):
    def __init__(self, options: dict[str, str]):
        self.target, self.folder = Target.of(options), options["outcomes"].rstrip("/")

    def write(self, iterator) -> WriterCommitMessage:
        store, folder = _place(self.folder)
        store.create_dir(folder, recursive=True)
        file = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.parquet"
        counts, held, seen = Counter(), [], {}
        with pq.ParquetWriter(f"{folder}/{file}", _ARROW, filesystem=store) as out:

            def flush() -> None:
                done = send(self.target, held, seen)
                counts.update(r["outcome"] for r in done)
                out.write_table(pa.Table.from_pylist(done, _ARROW))
                held.clear()

            for row in iterator:
                held.append(row.asDict())
                if len(held) == TOGETHER:
                    flush()
            if held:
                flush()
        return _Sent(file, dict(counts))

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        """The manifest, put in place in one step."""
        store, folder = _place(self.folder)
        store.create_dir(folder, recursive=True)
        said = [m for m in messages if m is not None]
        total = Counter()
        for m in said:
            total.update(m.counts)
        temporary = f"{folder}/{MANIFEST}.{uuid.uuid4().hex}"
        with store.open_output_stream(temporary) as out:
            out.write(json.dumps({"files": sorted(m.file for m in said), "counts": dict(total)}).encode())
        store.move(temporary, f"{folder}/{MANIFEST}")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Without a manifest nothing counts; the records stay in the target and are found by their keys next time."""
        store, folder = _place(self.folder)
        for m in messages:
            if m is not None:
                store.delete_file(f"{folder}/{m.file}")


def sent(records: DataFrame, target: Target, outcomes: str, tasks: int = 8) -> DataFrame:
    """Send ``records`` (see ``TargetRecords``) by at most ``tasks`` calls at a time; what became of them."""
    spark = records.sparkSession
    spark.dataSource.register(TargetRecords)
    ready = records.select("plan_pos", "ref_key", "sobject", "label", "outcome", "id", "fields").repartition(tasks, "sobject", "ref_key").sortWithinPartitions("plan_pos")
    ready.write.format(FORMAT).options(**target.options(), outcomes=outcomes).mode("append").save()
    return outcomes_of(spark, outcomes)


def outcomes_of(spark: SparkSession, folder: str) -> DataFrame:
    """What a finished ``sent`` wrote down."""
    folder = folder.rstrip("/")
    manifest = json.loads(spark.read.text(f"{folder}/{MANIFEST}", wholetext=True).first()[0])
    if not manifest["files"]:
        return spark.createDataFrame([], OUTCOMES)
    return spark.read.schema(OUTCOMES).parquet(*[f"{folder}/{f}" for f in manifest["files"]])


def snapshot(spark: SparkSession, target: Target, sobject: str, plan_fields: list[str], tasks: int = 1, page: int = 0) -> DataFrame:
    """(id, fields, ref_key) of what the target holds of an object, under the plan's field names; empty fields are left out."""
    from rowsmith.sources.command import records

    names = {target.name(sobject, f): f for f in plan_fields}
    rows = records(spark, f"{target.command} data query --json --query", target.object(sobject), ["Id", target.key_field, *names], timeout=target.timeout, tasks=tasks, page=page)
    fields = F.map_filter(F.create_map(*[x for n, f in names.items() for x in (F.lit(f), F.col(f"`{n}`"))]), lambda k, v: v != "")
    key = F.col(f"`{target.key_field}`")
    mine = F.startswith(key, F.lit(f"{target.run}:")) if target.run else F.lit(True)
    ref = F.when(mine, F.substring(key, len(target.run) + 2 if target.run else 1, 1 << 20))
    return rows.select(F.col("Id").alias("id"), fields.alias("fields"), F.coalesce(ref, F.lit("")).alias("ref_key"))
