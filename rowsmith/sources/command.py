"""Live lookups through a command-line tool that takes a query and answers with JSON on standard output.

The tool is a data source: projection, keywords and simple filters become part of the query, so only rows that are wanted
leave the target system. What it prints counts, whatever its exit status; a missing tool, no answer in
time, and answers that aren't results are errors of their own.

A large object is scanned by several tasks: the tool is asked for the least and the largest key, the keys between are cut
into ranges, and each task goes through its range in pages, asking for what comes after the last key it saw. Rows then
come in the order of keys, within and across tasks. Many records are looked up by key in lists of limited length."""

from __future__ import annotations

import json
import shlex
import subprocess
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition, StringContains, StringStartsWith

from rowsmith import config as C
from rowsmith.plans.tables import written
from rowsmith.sources.lookups import ACCOUNT_HEADERS, USER_HEADERS, LookupError_, active, mapped_columns

FORMAT = "command_records"
#: Characters of a list of keys in one query.
QUERY_CHARS = 8000


class ToolMissing(LookupError_):
    """The tool isn't installed."""


class NoAnswer(LookupError_):
    """The tool took too long."""


class BadAnswer(LookupError_):
    """What the tool printed is no result."""


def quoted(value: object) -> str:
    """A value in a query: truth values and numbers as they are, texts in single quotes."""
    if isinstance(value, bool):
        return "true" if value else "false"
    return str(value) if isinstance(value, (int, float)) else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def query_text(sobject: str, fields: list[str], where: list[str] = ()) -> str:
    return f"SELECT {', '.join(fields)} FROM {sobject}" + (f" WHERE {' AND '.join(where)}" if where else "")


def answered(command: list[str], query: str, timeout: float) -> list[dict]:
    """The records that the tool finds."""
    try:
        done = subprocess.run([*command, query], capture_output=True, text=True, timeout=timeout, check=False)
    except FileNotFoundError as e:
        raise ToolMissing(f"{command[0]}: not found") from e
    except subprocess.TimeoutExpired as e:
        raise NoAnswer(f"{command[0]}: no answer within {timeout:g} s") from e
    try:
        body = json.loads(done.stdout)
    except ValueError as e:
        raise BadAnswer(f"{command[0]}: no JSON; {done.stderr.strip()[-300:]}") from e
    if not isinstance(body, dict) or body.get("status", 0) != 0 or "records" not in (body.get("result") or {}):
        raise BadAnswer(f"{command[0]}: {body.get('message', 'no result') if isinstance(body, dict) else 'no result'}")
    return body["result"]["records"]


def flat(record: dict, prefix: str = "") -> dict[str, str]:
    """A record's values as text, nothing as empty, those of parents under dotted names; attributes are dropped."""
    out: dict[str, str] = {}
    for k, v in record.items():
        if k == "attributes":
            continue
        if isinstance(v, dict):
            out |= flat(v, f"{prefix}{k}.")
        else:
            out[prefix + k] = "" if v is None else quoted(v) if isinstance(v, bool) else str(v)
    return out


# The signs of keys in the order in which a target compares them.
SIGNS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
# Fixed value: the signs of keys that are digests; between '9' and 'a' there is nothing to read.
HEX_SIGNS = "0123456789abcdef"
#: Signs of keys that are looked at to cut a range, behind those that its bounds share.
DEPTH = 10
#: Signs of both bounds together that have to be hexadecimal for keys to be taken for digests.
SURE = 16


def key_ranges(low: str, high: str, n: int) -> list[tuple[str | None, str | None]]:
    """(above, up to) of at most ``n`` ranges that cover all keys, cut evenly between two keys; the outer ones are open.
    Wherever keys stand, they are covered: what their signs are taken for only makes ranges even."""
    same = 0
    while same < min(len(low), len(high)) and low[same] == high[same]:
        same += 1
    seen = low[same:] + high[same:]
    all_signs = HEX_SIGNS if len(seen) >= SURE and not set(seen) - set(HEX_SIGNS) and set(seen) & set("abcdef") else SIGNS

    def number(key: str) -> int:
        out = 0
        for i in range(DEPTH):
            sign = key[same + i] if same + i < len(key) else all_signs[0]
            out = out * len(all_signs) + min(len(all_signs) - 1, sum(c < sign for c in all_signs))
        return out

    def key(number: int) -> str:
        signs = []
        for _ in range(DEPTH):
            number, k = divmod(number, len(all_signs))
            signs.append(all_signs[k])
        return low[:same] + "".join(reversed(signs))

    a, b = number(low), number(high)
    cuts = list(dict.fromkeys(key(a + (b - a) * i // n) for i in range(1, n))) if b > a else []
    return list(zip([None, *cuts], [*cuts, None], strict=True))


@dataclass
class _Range(InputPartition):
    value: int = 0
    above: str | None = None
    up_to: str | None = None


class Records(DataSource):
    """Options: command (as in a shell), sobject, fields (comma-joined), where (a condition, may be empty), logical (fields
    whose values are true or false), timeout in seconds; key, tasks and page (rows of one answer, 0 for all) for scans in parts."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return ", ".join(f"`{f}` string" for f in self.options["fields"].split(","))

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options), schema.names)


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str], fields: list[str]):
        self.options, self.fields = options, fields
        self.where = [options["where"]] if options.get("where") else []
        self.logical = set(filter(None, options.get("logical", "").split(",")))
        self.key, self.tasks, self.page = options.get("key", "Id"), int(options.get("tasks", "1")), int(options.get("page", "0"))

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Equality and patterns go into the query; all filters are applied again to what comes back."""
        for f in filters:
            name = ".".join(f.attribute) if hasattr(f, "attribute") else ""
            if isinstance(f, EqualTo) and name in self.logical and f.value in ("true", "false"):
                self.where.append(f"{name} = {f.value}")
            elif isinstance(f, EqualTo) and isinstance(f.value, str) and f.value:
                self.where.append(f"{name} = {quoted(f.value)}")
            elif isinstance(f, (StringContains, StringStartsWith)) and not set(f.value) & set("%_"):
                self.where.append(f"{name} LIKE {quoted(('%' if isinstance(f, StringContains) else '') + f.value + '%')}")
            yield f

    def _ask(self, fields: list[str], where: list[str], end: str = "") -> list[dict]:
        return answered(shlex.split(self.options["command"]), query_text(self.options["sobject"], fields, where) + end, float(self.options.get("timeout", "180")))

    def partitions(self) -> list[InputPartition]:
        if self.tasks <= 1:
            return [_Range(0)]
        found = self._ask([f"MIN({self.key}) low", f"MAX({self.key}) high"], self.where)
        low, high = (found[0].get("low"), found[0].get("high")) if found else (None, None)
        if not low or not high:
            return [_Range(0)]
        return [_Range(i, above, up_to) for i, (above, up_to) in enumerate(key_ranges(str(low), str(high), self.tasks))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        fields = self.fields if self.key in self.fields or not self.page else [*self.fields, self.key]
        bounds = [f"{self.key} <= {quoted(partition.up_to)}"] if partition.up_to is not None else []
        end = (f" ORDER BY {self.key}" if self.page or self.tasks > 1 else "") + (f" LIMIT {self.page}" if self.page else "")
        last = partition.above
        while True:
            found = self._ask(fields, [*self.where, *([f"{self.key} > {quoted(last)}"] if last is not None else []), *bounds], end)
            for record in found:
                values = flat(record)
                last = values.get(self.key, last)
                yield tuple(values.get(f, "") for f in self.fields)
            if not self.page or len(found) < self.page:
                return


def records(spark: SparkSession, command: str, sobject: str, fields: list[str], where: str = "", logical: list[str] = (), timeout: float = 180, tasks: int = 1, page: int = 0, key: str = "Id") -> DataFrame:
    """A query's rows as text; filters on the frame reach the tool. ``tasks`` and ``page`` scan it in ranges of ``key``, in their order."""
    spark.dataSource.register(Records)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    options = {"command": command, "sobject": sobject, "fields": ",".join(fields), "where": where, "logical": ",".join(logical), "timeout": str(timeout), "tasks": str(tasks), "page": str(page), "key": key}
    return spark.read.format(FORMAT).options(**options).load()


def lists(values: list[str], chars: int) -> Iterator[list[str]]:
    """Values in lists whose quoted text is at most ``chars`` long (a longer value is alone)."""
    part, size = [], 0
    for v in values:
        n = len(quoted(v)) + 2
        if part and size + n > chars:
            yield part
            part, size = [], 0
        part.append(v)
        size += n
    if part:
        yield part


def point_records(wanted: DataFrame, command: str, sobject: str, fields: list[str], key: str = "Id", timeout: float = 180, tasks: int = 8, chars: int = QUERY_CHARS) -> DataFrame:
    """The records of ``sobject`` whose ``key`` is among the only column of ``wanted``, as text: each task asks for lists of keys."""
    column, line = wanted.columns[0], shlex.split(command)
    names = fields if key in fields else [key, *fields]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in lists(batch.column(0).to_pylist(), chars):
                found = [flat(r) for r in answered(line, query_text(sobject, names, [f"{key} IN ({', '.join(map(quoted, part))})"]), timeout)]
                yield pa.RecordBatch.from_arrays([pa.array([r.get(f, "") for r in found], pa.string()) for f in names], names=names)

    keys = wanted.select(F.col(column).cast("string").alias("k")).where("k <> ''").distinct().repartition(tasks, "k").sortWithinPartitions("k")
    return keys.mapInArrow(run, ", ".join(f"`{f}` string" for f in names))


class LiveSource:
    """Accounts and users of a live system. Each is asked for once; later reads see the same rows.

    The answer is written to the shared folder, so a lost executor doesn't ask again. ``tasks`` and ``page`` scan in
    ranges of ids, in their order."""

    def __init__(self, spark: SparkSession, command: str, org_type_field: str = "Org_Type__c", keywords: list[str] = C.LEAGUE_ORG_TYPES, timeout: float = 180, tasks: int = 1, page: int = 0):
        self.spark, self.command, self.org_type_field, self.keywords = spark, command, org_type_field, keywords
        self.how = {"timeout": timeout, "tasks": tasks, "page": page}
        self._read: dict[str, DataFrame] = {}

    def _once(self, name: str, df: DataFrame, headers: dict[str, list[str]]) -> DataFrame:
        if name not in self._read:
            self._read[name] = written(df.select((F.monotonically_increasing_id() + 1).alias("src_pos"), *mapped_columns(df, headers)), f"live-{name}")
        return self._read[name]

    def accounts(self) -> DataFrame:
        fields = ["Id", "Name", "BillingCountry", self.org_type_field, "Sport__c"]
        like = [f"{f} LIKE {quoted('%' + k + '%')}" for f in ("Name", self.org_type_field) for k in [*self.keywords, *C.LEAGUE_NAME_CUES]]
        rows = records(self.spark, self.command, "Account", fields, f"({' OR '.join(like)})", **self.how)
        return self._once("accounts", rows, ACCOUNT_HEADERS | {"org_type": [self.org_type_field]})

    def users(self) -> DataFrame:
        rows = records(self.spark, self.command, "User", ["Id", "Name", "Email", "IsActive"], logical=["IsActive"], **self.how).where("IsActive = 'true'")
        return active(self._once("users", rows, USER_HEADERS))

    def companies(self) -> DataFrame:
        """All accounts with their website as domain."""
        rows = records(self.spark, self.command, "Account", ["Id", "Name", "Website"], **self.how)
        return self._once("companies", rows, {"id": ["Id"], "name": ["Name"], "domain": ["Website"]})

    def record(self, sobject: str, ident: str, fields: list[str]) -> dict[str, str]:
        """Named fields of one record, parents' under dotted names."""
        from rowsmith.sources.lookups import one_record

        rows = records(self.spark, self.command, sobject, ["Id", *fields], timeout=self.how["timeout"]).where(F.col("Id") == ident)
        return one_record(rows, f"{sobject} {ident}")

    def records_of(self, sobject: str, idents: DataFrame, fields: list[str]) -> DataFrame:
        """Named fields of many records, by the ids in the only column of ``idents``."""
        return point_records(idents, self.command, sobject, ["Id", *fields], timeout=self.how["timeout"])
