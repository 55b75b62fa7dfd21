"""Lookup tables: accounts, users, curated candidates, company ids, price books, overrides, aliases.

A lookup source gives accounts and users under standard names whatever its headers are
called; CSV exports, recorded query results (JSON) and rows in memory are sources."""

from __future__ import annotations

import os
from collections.abc import Iterable
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsmith import config as C
from rowsmith.functions.amounts import lenient_int, price, product_family
from rowsmith.functions.text import strip, text
from rowsmith.operators.entities import duplicates
from rowsmith.sources.records import csv_records

# Standard fields and the headers that may hold them, in order of preference.
ACCOUNT_HEADERS = {
    "id": ["Id", "Account ID", "AccountID", "Account Id", "Salesforce Account ID", "SF Account ID"], "name": ["Name", "Account Name", "Account: Account Name"],
    "country": ["BillingCountry", "Billing Country"], "org_type": ["Org_Type__c", "Org Type", "Account: Org Type"], "sport": ["Sport__c", "Sport", "Account: Sport"],
}
USER_HEADERS = {"id": ["Id", "User ID", "UserID", "User Id"], "name": ["Name", "Full Name", "User Name", "Rep Name"], "email": ["Email", "User Email"], "is_active": ["IsActive", "Active", "Is Active"]}
CANDIDATE_HEADERS = {"other_id": ["Record ID"], "name": ["Company/Customer name"], "country": ["Country"], "deals": ["Number of Associated Deals"], "accounts": ["Number of associated account (active & cancelled)"], "active_arr": ["Active ARR (new)"], "id": ["Salesforce Account ID"]}
PRICE_HEADERS = {"book": ["Price Book Name"], "product": ["Product: Product Name"], "product_id": ["Product ID"], "entry_id": ["Price Book Entry ID"], "currency": ["List Price Currency"], "list_price": ["List Price"], "family": ["Family"]}


class LookupError_(RuntimeError):
    """A source can't be read."""


class LookupSource(Protocol):
    """Where accounts (src_pos, id, name, country, org_type, sport) and users (src_pos, id, name, email, is_active) come from."""

    def accounts(self) -> DataFrame: ...

    def users(self) -> DataFrame: ...


def _schema(names: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField("src_pos", T.LongType()), *[T.StructField(n, T.StringType()) for n in names]])


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _chosen(headers: dict[str, list[str]], present: dict[str, Column]) -> list[Column]:
    """Standard columns: of the headers present (by their lower-case label) the first non-empty value; else empty."""
    def one(names: list[str]) -> Column:
        values = [strip(present[n.strip().lower()]) for n in names if n.strip().lower() in present]
        return F.coalesce(*[F.when(v != "", v) for v in values], F.lit(""))
    return [one(names).alias(field) for field, names in headers.items()]


def _label(c: str | None) -> str:
    return (c or "").strip().lstrip("\ufeff").lower()


def mapped_columns(df: DataFrame, headers: dict[str, list[str]]) -> list[Column]:
    """Standard columns of a frame whose columns are named by headers, in any case."""
    present: dict[str, Column] = {}
    for c in df.columns:
        present.setdefault(_label(c), F.col(f"`{c}`"))
    return _chosen(headers, present)


def with_overrides(table: str, headers: dict[str, list[str]]) -> dict[str, list[str]]:
    """Headers with those that the environment prefers (LOOKUP_<TABLE>_<FIELD>_HEADER) in front."""
    return {f: [*([v] if (v := os.environ.get(f"LOOKUP_{table.upper()}_{f.upper()}_HEADER")) else []), *names] for f, names in headers.items()}


def read_csv(spark: SparkSession, path: str, headers: dict[str, list[str]], required: bool = False, strict_headers: bool = False) -> DataFrame:
    """A CSV export under standard names, positions in file order, blank lines left out; no file is no rows, unless required."""
    if not exists(spark, path):
        if required:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], _schema(headers))
    rows = csv_records(spark, path).where(F.size("cells") > 0)
    first = rows.orderBy("src_pos").limit(1).collect()
    labels = [_label(c) for c in first[0]["cells"]] if first else []
    if strict_headers and (missing := [n[0] for n in headers.values() if not any(x.lower() in labels for x in n)]):
        raise ValueError(f"{path} lacks columns {missing}")
    if not first:
        return spark.createDataFrame([], _schema(headers))
    present: dict[str, Column] = {}
    for i, label in enumerate(labels):
        present.setdefault(label, F.get("cells", F.lit(i)))
    at = first[0]["src_pos"]
    return rows.where(F.col("src_pos") > at).select((F.col("src_pos") - at).alias("src_pos"), *_chosen(headers, present))


class CsvSource:
    def __init__(self, spark: SparkSession, accounts_csv: str, users_csv: str):
        self.spark, self.accounts_csv, self.users_csv = spark, accounts_csv, users_csv

    def accounts(self) -> DataFrame:
        return read_csv(self.spark, self.accounts_csv, with_overrides("accounts", ACCOUNT_HEADERS))

    def users(self) -> DataFrame:
        return read_csv(self.spark, self.users_csv, with_overrides("users", USER_HEADERS))


class RecordedSource:
    """Recorded query results: JSON files with result.records, one per object; attributes are dropped, all else is text.

    ``command.LiveSource`` asks a live system's command-line tool instead."""

    def __init__(self, spark: SparkSession, accounts_json: str, users_json: str, org_type_field: str = "Org_Type__c", keywords: list[str] = C.LEAGUE_ORG_TYPES):
        self.spark, self.paths, self.org_type_field, self.keywords = spark, {"accounts": accounts_json, "users": users_json}, org_type_field, keywords
        self._read: dict[str, DataFrame] = {}

    def _records(self, table: str, headers: dict[str, list[str]]) -> DataFrame:
        if table not in self._read:
            path = self.paths[table]
            if not exists(self.spark, path):
                raise LookupError_(f"{path}: no recorded result")
            raw = self.spark.read.option("multiLine", True).option("primitivesAsString", True).option("mode", "FAILFAST").json(path)
            if "result" not in raw.columns:
                raise LookupError_(f"{path}: not a query result")
            records = raw.select(F.posexplode("result.records")).select((F.col("pos") + 1).cast("long").alias("src_pos"), "col.*")
            self._read[table] = records.select("src_pos", *mapped_columns(records.drop("attributes", "src_pos"), headers)).cache()
        return self._read[table]

    def accounts(self) -> DataFrame:
        headers = ACCOUNT_HEADERS | {"org_type": [self.org_type_field, *ACCOUNT_HEADERS["org_type"]]}
        rows = self._records("accounts", headers)
        like = F.lower(F.concat_ws(" ", "name", "org_type"))
        return rows.where(F.exists(F.array(*[F.lit(k) for k in [*self.keywords, *C.LEAGUE_NAME_CUES]]), lambda k: F.contains(like, k)))

    def users(self) -> DataFrame:
        return active(self._records("users", USER_HEADERS))


class MemorySource:
    def __init__(self, spark: SparkSession, accounts: list[dict] = (), users: list[dict] = ()):
        self.spark, self.rows = spark, {"accounts": accounts, "users": users}

    def _frame(self, table: str, names: Iterable[str]) -> DataFrame:
        names = list(names)
        return self.spark.createDataFrame([(i, *[str(r.get(n) or "") for n in names]) for i, r in enumerate(self.rows[table], 1)], _schema(names))

    def accounts(self) -> DataFrame:
        return self._frame("accounts", ACCOUNT_HEADERS)

    def users(self) -> DataFrame:
        return self._frame("users", USER_HEADERS)


def source(kind: str, spark: SparkSession, settings: C.Settings) -> LookupSource:
    if kind == "csv":
        return CsvSource(spark, settings.accounts_csv, settings.users_csv)
    if kind == "recorded":
        return RecordedSource(spark, settings.accounts_csv, settings.users_csv)
    if kind == "live":
        from rowsmith.sources.command import LiveSource

        return LiveSource(spark, settings.command)
    if kind == "none":
        return MemorySource(spark)
    raise ValueError(f"unknown source {kind!r}")


def active(users: DataFrame) -> DataFrame:
    """Users not marked inactive; a blank mark is active."""
    return users.where(~F.lower(strip(F.col("is_active"))).isin("false", "0", "no")).where(text(F.col("name")) != "")


def curated_candidates(spark: SparkSession, path: str) -> DataFrame:
    """Curated candidates, also those without an account id."""
    rows = read_csv(spark, path, CANDIDATE_HEADERS).where("name <> ''")
    return rows.withColumns({"deals": lenient_int(F.col("deals")), "accounts": lenient_int(F.col("accounts"))})


def company_ids(spark: SparkSession, path: str) -> DataFrame:
    """(src_pos, name, id) without deprecated rows."""
    rows = read_csv(spark, path, {"name": ["Company/Customer name"], "id": ["Record ID"]})
    return rows.where("name <> '' and id <> ''").where(~F.contains(F.lower("name"), F.lit("do not use")))


def companies(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, {"name": ["Name"], "domain": ["Domain"], "id": ["HubSpot Record ID", "Record ID"]}).withColumn("domain", F.lower("domain"))


def _uncommented(df: DataFrame) -> DataFrame:
    return df.where(~F.startswith(F.coalesce("league", F.lit("")), F.lit("#"))).where("league <> ''")


def manual_ids(spark: SparkSession, path: str) -> DataFrame:
    return _uncommented(read_csv(spark, path, {"league": ["league"], "account_id": ["sf_account_id", "account_id"], "other_id": ["hs_record_id", "other_id"], "note": ["note"]}))


def deal_aliases(spark: SparkSession, path: str) -> DataFrame:
    return _uncommented(read_csv(spark, path, {"league": ["league"], "company_name": ["company_name"], "other_id": ["company_record_id", "other_id"], "reason": ["reason"]}))


def pricebook(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """src_pos, book, product, product_id, entry_id, currency, list_price, family; bad prices are errors, so are, if strict, repeated names."""
    rows = read_csv(spark, path, PRICE_HEADERS, required=True, strict_headers=True).where("product <> ''")
    raw = F.when(F.col("list_price") == "", F.lit("0")).otherwise(F.col("list_price"))
    bad = F.raise_error(F.concat(F.lit("bad list price of "), "product", F.lit(": "), "list_price")).cast("double")
    out = rows.withColumn("list_price", F.coalesce(price(raw), bad)).withColumn("family", F.lower(product_family(F.col("family"))))
    if strict and (twice := duplicates(out, ["product"]).limit(5).collect()):
        raise ValueError(f"products listed twice: {[r['product'] for r in twice]}")
    return out


def currency_pricebook(spark: SparkSession, path: str, currency: str) -> DataFrame:
    """The entries of one currency; bad prices count as 0."""
    rows = read_csv(spark, path, PRICE_HEADERS, required=True).where("product <> ''").where(F.col("currency") == currency)
    out = rows.withColumn("list_price", F.coalesce(price(F.col("list_price")), F.lit(0.0)))
    if not out.take(1):
        raise ValueError(f"no price book entries in {currency}")
    return out


def currencies(book: DataFrame) -> DataFrame:
    return book.select("currency").where("currency <> ''").distinct()


def products_by_family(book: DataFrame) -> DataFrame:
    """Distinct names by kind, sorted: what the order sheet's dropdowns offer."""
    return book.where(F.col("family").isin("subscription", "camera")).select("family", "product").distinct().orderBy("family", "product")


def one_record(df: DataFrame, what: str) -> dict:
    """The only row of a point lookup; none or several are errors."""
    rows = df.limit(2).collect()
    if len(rows) != 1:
        raise LookupError_(f"{what}: {'none' if not rows else 'several'} found")
    return rows[0].asDict(recursive=True)


def record_type_id(types: DataFrame | None, name: str, fallback: dict[str, str]) -> str:
    """The id of a record type (id, name) of a recorded query, else the configured one, else none."""
    found = types.where(F.col("name") == name).select("id").limit(1).collect() if types is not None else []
    return found[0]["id"] if found else fallback.get(name, "")


def owner_id(users: DataFrame, who: str) -> str:
    """An id as it is, or the id of the only active user of that name."""
    import re

    if not who or re.fullmatch(r"005[A-Za-z0-9]{12,15}", who):
        return who
    return one_record(active(users).where(F.col("name") == who), f"user {who!r}")["id"]
