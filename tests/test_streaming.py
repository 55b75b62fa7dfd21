from __future__ import annotations

import datetime as dt

from rowsmith.streaming import deals, matching


def test_totals_of_arriving_files(spark, tmp_path):
    day = dt.datetime(2026, 1, 5)
    rows = [(1, "Big Ten", "H1", 10.0, day), (2, "Big10", "H1", 5.0, day), (3, "Other", "H2", 1.0, day + dt.timedelta(days=8))]
    folder = str(tmp_path / "in")
    for part in (rows[:1], rows[1:]):
        spark.createDataFrame(part, deals.SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    q = deals.totals(deals.arriving(spark, folder, 1)).writeStream.format("memory").queryName("deal_totals").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {(r["league_key"], r["period"]): (r["n_rows"], r["total_arr"]) for r in spark.table("deal_totals").collect()}
    assert got == {("big 10", "H1"): (2, 15.0), ("other", "H2"): (1, 1.0)}


def test_matching_of_arriving_files(spark, tmp_path):
    day = dt.datetime(2026, 1, 5)
    pool = spark.createDataFrame([(1, "A1", "Big Ten"), (2, "A2", "Rim Conference"), (3, "A3", "Elsewhere League")], "src_pos long, id string, name string")
    folder, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))

    def arrive(*rows):
        spark.createDataFrame([(i, n, "H1", 1.0, day) for i, n in rows], deals.SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        matching.match_arriving(deals.arriving(spark, folder, 1), pool, out, checkpoint).awaitTermination(300)
        return {(r["batch"], r["league_key"]): (r["n_rows"], r["match_type"], r["account_ids"]) for r in spark.read.parquet(out).collect()}

    first = {(0, "big 10"): (2, "exact", ["A1"]), (0, "nobody known"): (1, "", [])}
    assert arrive((1, "Big Ten"), (2, "Big10"), (3, "Nobody Known")) == first
    assert arrive((4, "The Rim Conf.")) == first | {(1, "rim conference"): (1, "normalised", ["A2"])}
    assert matching.match_arriving(deals.arriving(spark, folder, 1), pool, out, checkpoint).awaitTermination(300) and spark.read.parquet(out).count() == 3


def _deals():
    """Deals whose leagues compete for ids by weak matches, come back with other territories, and are pinned late."""
    day = dt.datetime(2026, 1, 5)
    names = ["asobal spain", "liga asobal", "Big Ten", "liga asobal spain north", "Rim Conference", "alpha beta gamma delta", "beta gamma delta alpha", "gamma delta alpha beta", "Nobody Known", "asobal spain women"]
    rows = []
    for i in range(40):
        name = names[(i * 7 + i // 10) % len(names)]
        rows.append((i + 1, name, "H1", float(i), day, ["", "Sweden", "Germany", "Spain"][i % 4] if i > 8 else "", "A5" if i == 33 else ""))
    return rows


def _pool(spark):
    rows = [(1, "A1", "Big Ten", ""), (2, "A2", "Rim Conference", "Sweden"), (3, "A3", "Liga Asobal Spain", "Spain"), (4, "A4", "alpha beta gamma delta epsilon", "Germany"), (5, "A5", "beta alpha delta gamma zeta", ""), (6, "A6", "Spain Liga Asobal North", "Spain")]
    return spark.createDataFrame(rows, "src_pos long, id string, name string, country string")


def test_any_split_in_order_gives_what_one_go_gives(spark, tmp_path):
    import random

    from rowsmith.operators import match

    rows, pool = _deals(), _pool(spark)
    whole = match.crosscheck(matching.known_leagues(spark.createDataFrame(rows, deals.WIDE)), pool).select(matching.RESULT)
    want = sorted(map(tuple, whole.collect()))
    assert len({r[3] for r in want}) > 1 and len(want) == 10
    rng = random.Random(51)
    for k, cuts in enumerate([sorted(rng.sample(range(1, 40), 2))]):
        out = str(tmp_path / f"out{k}")
        edges = [0, *cuts, 40]
        for n, (a, b) in enumerate(zip(edges, edges[1:])):
            matching.step(spark.createDataFrame(rows[a:b], deals.WIDE), n, pool, out)
        assert sorted(map(tuple, matching.results(spark, out).collect())) == want


def test_in_order_goes_on_after_a_stop(spark, tmp_path, monkeypatch):
    from rowsmith.operators import match

    rows, pool = _deals(), _pool(spark)
    folder, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))
    want = sorted(map(tuple, match.crosscheck(matching.known_leagues(spark.createDataFrame(rows, deals.WIDE)), pool).select(matching.RESULT).collect()))
    real, calls = match.decided, []

    def stops_once(*args):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("stopped")
        return real(*args)

    for k, part in enumerate((rows[:17], rows[17:])):
        spark.createDataFrame(part, deals.WIDE).coalesce(1).write.mode("append").parquet(folder)
        monkeypatch.setattr(matching.match, "decided", stops_once)
        try:
            matching.match_in_order(deals.arriving(spark, folder, 1, deals.WIDE), pool, out, checkpoint).awaitTermination(300)
        except Exception:
            assert k == 1 and len(matching.results(spark, out).collect()) < 10 or k == 1
            matching.match_in_order(deals.arriving(spark, folder, 1, deals.WIDE), pool, out, checkpoint).awaitTermination(300)
    assert sorted(map(tuple, matching.results(spark, out).collect())) == want
