"""Countries: territories, signals, codes, tax fields, shipping regions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowsmith import config as C
from rowsmith.functions.text import among, mapped, strip, text


def territory_countries(c: Column) -> Column:
    """Distinct countries that a territory cell names, by region, alias or name; others are passed over."""
    cell = strip(F.regexp_replace(text(c), r"\([^)]*\)", ""))
    parts = F.transform(F.split(cell, r"(?iU)\s*[/&,\-]\s*|\s+and\s+"), lambda t: F.lower(strip(t)))
    regions = F.create_map(*[x for k, v in C.REGIONS.items() for x in (F.lit(k), among(v) if v else F.expr("cast(array() as array<string>)"))])
    aliases, known = mapped(C.COUNTRY_ALIASES), among(C.COUNTRIES)
    one = lambda t: F.when(regions[t].isNotNull(), regions[t]).when(aliases[t].isNotNull(), F.array(aliases[t])).when(F.array_contains(known, t), F.array(t)).otherwise(F.expr("cast(array() as array<string>)"))
    return F.array_distinct(F.flatten(F.transform(parts, one)))


def country(c: Column) -> Column:
    """Canonical country, or empty if it isn't one."""
    s = F.lower(strip(c))
    s = F.coalesce(mapped(C.COUNTRY_ALIASES)[s], s)
    return F.when(F.array_contains(among(C.COUNTRIES), s), s).otherwise("")


def country_signal(territory: Column, candidate: Column) -> Column:
    """20 inside the territory, -40 outside, 0 if either side is unknown."""
    known = (F.size(territory) > 0) & (country(candidate) != "")
    return F.when(~known, 0).when(F.array_contains(territory, country(candidate)), 20).otherwise(-40)


def country_code(c: Column) -> Column:
    s = strip(c)
    return F.coalesce(mapped(C.COUNTRY_CODES)[F.lower(s)], s)


def is_eu(c: Column) -> Column:
    return F.array_contains(among(C.EU_COUNTRIES), F.lower(strip(c)))


def tax_field(c: Column, eu: str = "tax_reg_nr", other: str = "org_nr", exception: str = "sweden") -> Column:
    """The field a tax id goes to: EU countries but one have registration numbers, all others organisation numbers."""
    return F.when((F.lower(strip(c)) != exception) & is_eu(c), eu).otherwise(other)


def shipping_region(c: Column) -> Column:
    s = F.lower(strip(c))
    return F.when(s.isin("us", "usa", "united states", "united states of america"), "US").when(s == "sweden", "Sweden").when(is_eu(c) | s.isin(*C.OTHER_EUROPE), "Europe").otherwise("Americas-nonUS")


def shipping_camera(c: Column, encoder: str = "stream encoder") -> Column:
    s = strip(c)
    return F.when(F.lower(s) == encoder, "encoder").otherwise(F.lower(strip(F.regexp_replace(s, r"(?iU)\s*\(with mic\)\s*$", ""))))


def plan_region(plan: Column) -> Column:
    p = text(plan)
    has = lambda x: F.contains(p, F.lit(x))
    return F.when(has("Tariffs to US"), "US").when(has("to Sweden"), "Sweden").when(has("to Europe"), "Europe").when(has("to Americas"), "Americas-nonUS").otherwise("")


def plan_camera(plan: Column, encoder: str = "stream encoder") -> Column:
    """The camera that a shipping plan's name ends with, after its last ' for ', else its last ' of '."""
    p = text(plan)
    tail = lambda w: F.regexp_extract(p, f"(?s)^.* {w} (.*)$", 1)
    return F.when(F.contains(p, F.lit(" for ")), shipping_camera(tail("for"), encoder)).when(F.contains(p, F.lit(" of ")), shipping_camera(tail("of"), encoder)).otherwise("")


def team_gender(c: Column) -> Column:
    """Mens, Womens, Mens and Womens, or empty."""
    s = F.trim(F.regexp_replace(F.regexp_replace(F.lower(text(c)), r"['/&\-+,.]", " "), r"(?U)\s+", " "))
    padded = lambda x: F.concat(F.lit(" "), x, F.lit(" "))
    women = s.rlike("women|girls|female") | F.contains(padded(s), F.lit(" w "))
    rest = F.regexp_replace(s, "womens|women", "")
    men = rest.rlike("men|boys|male") | F.contains(padded(rest), F.lit(" m "))
    return F.when(men & women, "Mens and Womens").when(women, "Womens").when(men, "Mens").otherwise("")
