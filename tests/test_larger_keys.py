"""Queries whose inputs are put together from keys, on keys longer than those of the small tables, and operators where one word is in every name."""

from __future__ import annotations

from rowsmith.operators import blocking
from rowsmith.plans import matches


def customers(spark, folder, keys):
    rows = [(k, f"Customer#{k:09d}", k % 25) for k in keys]
    spark.createDataFrame(rows, "c_custkey long, c_name string, c_nationkey int").write.parquet(str(folder / "customer.parquet"))
    return str(folder)


def test_league_passes_hold_for_long_keys(spark, tmp_path):
    keys = [*range(10_000, 10_020), *range(899_980, 900_000), *range(12_345_660, 12_345_680)]
    got = {r["league_pos"]: tuple(r)[1:4] for r in matches.league_passes(spark, customers(spark, tmp_path, keys)).collect()}
    assert got == {k: matches._CASES[k % len(matches._CASES)][2:5] for k in keys}


def test_a_word_in_all_names_brings_no_pairs_together(spark):
    n = 300  # all pairs would be 90,000
    name = lambda k: f"{k * 7919 % 99991:05d} am see"
    outer = spark.createDataFrame([(k, f"stadt{name(k)} rim") for k in range(n)] + [(n + k, f"stadt 000{k:06d} fc") for k in range(n)], "id long, name string")
    inner = spark.createDataFrame([(k, name(k)) for k in range(n)] + [(n + k, f"stadt 000{k:06d}") for k in range(n)] + [(2 * n, "am see"), (2 * n + 1, "t am see")], "id long, name string")
    inners = inner.collect()
    want = {(o["id"], i["id"]) for o in outer.collect() for i in inners if i["name"] in o["name"] and len(i["name"]) >= 8}
    assert {tuple(r) for r in blocking.contained(outer, inner).where(f"inner <> {2 * n}").collect()} == want and len(want) >= 2 * n
    assert blocking.may_contain(outer, inner).count() < 10 * n
