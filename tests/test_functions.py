from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rowsmith.functions import amounts, clubs, geo, text
from rowsmith.operators.products import product_tokens


def ev(spark, f, *values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string").select("i", f(F.col("x")).alias("y")).collect()
    return [r["y"] for r in sorted(rows, key=lambda r: r["i"])]


def test_league_names(spark):
    got = ev(spark, text.normalise_league, "The Big Ten Conference (B1G)", "Big10", "J-League", "Conf. of Eastern Athletics", "Athletic Assoc.", None, " ", "A & B League")
    assert got == ["big 10 conference", "big 10", "j league", "conference of eastern athletics", "athletic assoc", "", "", "a and b league"]
    assert ev(spark, text.strip_sport_division, "SoCon Basketball", "RMAC - D2", "Pac 12 Soccer", "Basketball", None) == ["socon", "rmac", "pac 12", "basketball", ""]
    assert ev(spark, text.acronym, "Big Ten (B1G)", "X (A)", "Y (a much longer note)", "Z") == ["b1g", "", "", ""]
    assert ev(spark, text.division, "X - D2", "X DIII", "NAIA X", "x", "D-1 x") == ["d2", "d3", "naia", "", "d1"]
    assert ev(spark, text.initials, "Fédération Française de Basket-Ball", "Tier 1 Elite Hockey League") == ["ffbb", "t1ehl"]
    assert [tuple(r) for r in ev(spark, text.trailing_acronym, "coastal athletic association caa", "university of southern california usc", "a b", "one two three")] == [("coastal athletic association", "caa"), ("university of southern california", "usc"), ("a b", ""), ("one two three", "")]
    assert [sorted(x) for x in ev(spark, text.significant_words, "the big 10 conference of eastern athletics", "")] == [["athletics", "big", "eastern"], []]


def test_junk(spark):
    got = ev(spark, text.junk_reason, "Men's Soccer League", "test x", "ab", "", None, "Good League", "to MERGE now")
    assert [g is None for g in got] == [False, False, False, False, False, True, False]


def test_small_text(spark):
    assert ev(spark, text.record_id, "https://x.example/lightning/r/Opportunity/0061Q00000AbCdEfGH/view", "001QD00000ABCDEF", "x y", None) == ["0061Q00000AbCdEfGH", "001QD00000ABCDEF", "x y", ""]
    assert ev(spark, text.sheet_id, "https://docs.example/d/abc-_1/edit", "plain") == ["abc-_1", "plain"]
    assert ev(spark, text.email_domain, "a@B.Example", "none") == ["b.example", ""]
    assert [tuple(r) for r in ev(spark, text.split_name, "Ada", "Ada  King Byron", "")] == [("Ada", ""), ("Ada", "King Byron"), ("", "")]
    assert [tuple(r) for r in ev(spark, lambda c: text.split_name(c, True), "Ada")] == [("Ada", "Ada")]
    assert ev(spark, text.slug, "Tier A / b!") == ["tier-a-b"]
    assert ev(spark, text.truthy, "Yes", "1", "no", None) == [True, True, False, False]


@pytest.mark.parametrize(("value", "want"), [("50,000", 50000), ("12.500,00", 12500), ("12,5", 12.5), ("25.000", 25.0), ("€ 1,234,567", 1234567), ("n/a", 0), ("", 0), (None, 0), ("12,500.00", 12500), ("-3", -3)])
def test_amounts(spark, value, want):
    assert ev(spark, amounts.amount, value) == [want]


def test_money_and_numbers(spark):
    r = spark.range(1).select(amounts.money(F.lit(2.675)), amounts.money(F.lit(85000.0)), amounts.cents(F.lit(0.125)), amounts.lenient_int(F.lit("12.0")), amounts.lenient_int(F.lit("x"))).first()
    assert tuple(r) == ("2.67", "85000", "0.12", 12, 0)


def test_dates(spark):
    got = ev(spark, amounts.iso_date, "June 1st, 2026", "Jun 1 2026", "6/1/2026", "2026-06-01 00:00:00", "13/02/2026", "soon", "May 5, 2026", "2026/1/2", None)
    assert got == ["2026-06-01", "2026-06-01", "2026-06-01", "2026-06-01", "2026-02-13", "", "2026-05-05", "2026-01-02", ""]


def test_geography(spark):
    got = [sorted(x) for x in ev(spark, geo.territory_countries, "UK / Polen", "Nordics", "UK Nordics", "Italy (football)", "EMEA", "", None, "bosnia and herzegovina")]
    assert got == [["poland", "united kingdom"], ["denmark", "finland", "iceland", "norway", "sweden"], [], ["italy"], [], [], [], []]
    both = spark.createDataFrame([(["italy"], "Italy"), (["italy"], "spain"), ([], "spain"), (["italy"], "junk")], "t array<string>, c string")
    assert [r[0] for r in both.select(geo.country_signal(F.col("t"), F.col("c"))).collect()] == [20, -40, 0, 0]
    assert ev(spark, geo.team_gender, "Women's", "M/W", "boys", "?", "Men's Women's", None) == ["Womens", "Mens and Womens", "Mens", "", "Mens and Womens", ""]
    assert ev(spark, geo.tax_field, "Germany", "Sweden", "Canada") == ["tax_reg_nr", "org_nr", "org_nr"]
    assert ev(spark, geo.shipping_region, "USA", "sweden", "Norway", "", "Brazil") == ["US", "Sweden", "Europe", "Americas-nonUS", "Americas-nonUS"]
    assert ev(spark, geo.plan_camera, "Shipping with Tariffs to US for Cam WIDE (with mic)", "Shipping to Sweden of Stream Encoder", "x") == ["cam wide", "encoder", ""]
    assert ev(spark, geo.plan_region, "Shipping to Europe of X", "Tariffs to US for X", "") == ["Europe", "US", ""]


def test_clubs(spark):
    assert ev(spark, clubs.normalise_club, "F.C. Test S.p.A.", "Bayern München FC", "NK Rudeš​", None) == ["fc test", "bayern munchen fc", "nk rudes", ""]
    assert ev(spark, clubs.prefix_first, "bayern munchen fc", "real sc fc") == ["fc bayern munchen", "sc fc real"]
    assert ev(spark, clubs.clean_domain, "https://www.club.example/x", "Www.Club.Example", "http://u@a.b:80/c?d", None) == ["club.example", "club.example", "a.b", ""]
    pairs = spark.createDataFrame([("abcdefgh", "abcdefgx"), ("abcdefgh", "abcdexyh"), ("abcdefghijkl", "abcdefghijxy"), ("short", "shore"), ("same", "same")], "a string, b string")
    assert [r[0] for r in pairs.select(clubs.close(F.col("a"), F.col("b"))).collect()] == [True, False, True, False, True]


def test_product_cells(spark):
    assert ev(spark, product_tokens, "Broadcasting, multi - angle & full scope: S.Perform, maybe Alpha PRO (3 cams) and beta.", "", "+ a\nb") == [["Broadcasting", "multi-angle", "S.Perform", "Alpha PRO", "beta"], [], ["a b"]]
