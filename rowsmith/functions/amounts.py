"""Amounts and money."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from rowsmith.functions.text import text


def amount(c: Column) -> Column:
    """A number written in any of the usual ways; 0 where it isn't one. A lone dot is a decimal point."""
    s = F.regexp_replace(text(c), r"(?U)[€$£\s]", "")
    comma, dot = F.contains(s, F.lit(",")), F.contains(s, F.lit("."))
    last = lambda x: F.length(s) - F.instr(F.reverse(s), x)
    without = lambda x: F.replace(s, F.lit(x), F.lit(""))
    point = lambda v: F.replace(v, F.lit(","), F.lit("."))
    after = F.instr(F.reverse(s), ",") - 1
    one = F.length(s) - F.length(without(",")) == 1
    plain = (
        F.when(comma & dot & (last(",") > last(".")), point(without(".")))
        .when(comma & dot, without(","))
        .when(comma & one & (after <= 2), point(s))
        .when(comma, without(","))
        .otherwise(s)
    )
    return F.coalesce(F.when(plain.rlike(r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"), plain.try_cast("double")), F.lit(0.0))


def lenient_int(c: Column) -> Column:
    """An integer, also written as a decimal; 0 where it isn't one."""
    return F.coalesce(text(c).try_cast("double").try_cast("int"), F.lit(0))


def price(c: Column) -> Column:
    """A price with point or comma, null where it isn't one."""
    return F.replace(F.trim(text(c)), F.lit(","), F.lit(".")).try_cast("double")


@pandas_udf(StringType())
def _money(v: pd.Series) -> pd.Series:
    return v.map(lambda x: None if pd.isna(x) else (f"{int(x)}" if x == int(x) else f"{x:.2f}"))


@pandas_udf(StringType())
def _cents(v: pd.Series) -> pd.Series:
    return v.map(lambda x: None if pd.isna(x) else f"{x:.2f}")


def money(c: Column) -> Column:
    """Whole amounts without decimals, others with two, rounded from the exact binary value. For sinks only."""
    return _money(c.cast("double"))


def cents(c: Column) -> Column:
    return _cents(c.cast("double"))


def iso_date(c: Column) -> Column:
    """An ISO date from any of the usual spellings, empty where it isn't a date; month first where both fit."""
    s = F.trim(text(c))
    bare = F.regexp_replace(s, r"(?i)(\d{1,2})(st|nd|rd|th)\b", "$1")
    tries = [F.when(bare.rlike(shape), F.try_to_date(bare, form)) for shape, form in (
        (r"(?i)^[a-z]{4,} +\d{1,2}, *\d{4}$", "MMMM d, yyyy"), (r"(?i)^[a-z]{4,} +\d{1,2} +\d{4}$", "MMMM d yyyy"),
        (r"(?i)^[a-z]{3} +\d{1,2}, *\d{4}$", "MMM d, yyyy"), (r"(?i)^[a-z]{3} +\d{1,2} +\d{4}$", "MMM d yyyy"),
        (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"), (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"), (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
    )]
    return F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}"), F.left(s, F.lit(10))).otherwise(F.coalesce(F.date_format(F.coalesce(*tries), "yyyy-MM-dd"), F.lit("")))


def confidence(score: Column) -> Column:
    return F.when(score >= 90, "High").when(score >= 70, "Medium").otherwise("Low")


def deal_kind(c: Column) -> Column:
    s = F.lower(text(c))
    return F.when(F.contains(s, F.lit("renew")), "Renewal").when(s.rlike("upsell|expansion|expand"), "Upsell").otherwise("New")


def match_source(has_first: Column, has_second: Column, first: str = "Accounts", second: str = "Companies") -> Column:
    return F.when(has_first & has_second, f"{second} + {first}").when(has_first, f"{first} only").when(has_second, f"{second} only (no account id)").otherwise("")


def product_family(c: Column) -> Column:
    s = F.lower(text(c))
    return F.when(F.contains(s, F.lit("subscription")), "subscription").when(s.rlike("camera|purchase"), "camera").otherwise(F.trim(text(c)))


def charge_terms(family: Column) -> Column:
    """Charge type, unit, price and billing period of a product family."""
    sub = family == "subscription"
    return F.struct(F.when(sub, "Recurring").otherwise("One-off").alias("charge_type"), F.when(sub, "account").otherwise("camera system/s").alias("unit"), F.lit("Annual").alias("price_period"), F.when(sub, "Annual").otherwise("").alias("billing_period"))
