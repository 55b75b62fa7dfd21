"""Decisions of the pipeline's stages for rows that share an id or have none, link lists within articles, long labelled texts."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowsmith.llm import html_text, mixing, quality_model, quality_rules
from tests.llm.test_operators import frame, prose, rows


def test_rejected_rows_go_whoever_shares_their_id(spark):
    rng = random.Random(31)
    junk = lambda: " ".join(f"w{rng.randrange(400)}%%%" for _ in range(150))
    good = [(i, prose(rng, 120, 5000)) for i in range(120)] + [(None, prose(rng, 120, 5000))]
    bad = [(5, junk()), (None, junk()), (5, "too short"), (None, None), (300, "")]
    extra = {c: F.lit("clash") for c in ("_key", "g", "l", "o", "kept", "distance")}
    df = frame(spark, good + bad).withColumns(extra).drop("_key")
    left = quality_rules.keep_good(df)
    assert left.columns == df.columns
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in rows(left)))) == sorted(map(str, good))


def test_copies_of_rows_that_share_an_id(spark):
    rng = random.Random(32)
    text = {k: prose(rng, n) for k, n in (("a", 100), ("b", 400), ("c", 300), ("d", 100))}
    # The first source is small and taken three times, the last one is large and taken in part.
    df = frame(spark, [(None, text["a"]), (7, text["d"])], source="s1").unionByName(frame(spark, [(None, text["b"]), (7, text["c"]), (7, text["c"])], source="s3"))
    out = rows(mixing.mixed_documents(df))
    got = Counter((r["doc_id"], r["source"], r["text"][:20]) for r in out)
    plan = rows(mixing.mix(df))
    want = Counter()
    for r in plan:
        name = next(k for k in text if len(text[k].split()) == r["size"] and (r["source_size"] == 200) == (k in "ad") and (r["doc_id"] is None) == (k in "ab"))
        want[r["doc_id"], "s1" if name in "ad" else "s3", text[name][:20]] += int(r["taken"] / r["size"] + 0.5)
    assert got == +want and len(set(want.values())) > 1


P = lambda n, w: "<p>" + " ".join(f"{w}{i}" for i in range(n)) + "</p>"
LINKS = "<ul>" + "".join(f'<li><a href="/x{i}">link number {i}</a></li>' for i in range(4)) + "</ul>"
TABLE = "<table>" + "".join(f'<tr><td><a href="/x{i}">link row {i}</a></td><td><a href="/y{i}">cell {i}</a></td></tr>' for i in range(10)) + "</table>"


@pytest.mark.parametrize(
    "body",
    [
        f"<article>{P(60, 'a')}{LINKS}{P(60, 'b')}</article>", f"<article>{P(60, 'a')}{TABLE}{P(60, 'b')}</article>", f"<article><section>{P(60, 'a')}{LINKS}</section><section>{P(60, 'b')}{LINKS}</section></article>",
        f"<div>{LINKS}</div><div>{P(60, 'a')}{LINKS}{P(60, 'b')}</div><div>{LINKS}{LINKS}</div>", f"<nav>{LINKS}</nav><article>{P(90, 'a')}{LINKS}{P(40, 'b')}</article><footer>{LINKS}</footer>",
    ],
)
def test_link_lists_within_an_article_cost_nothing(body):
    words = html_text.main_text(f"<html><body>{body}</body></html>").split()
    assert "a0" in words and "b0" in words and "b39" in words and "link" not in words


def test_a_long_labelled_text_is_passed_over(spark, monkeypatch):
    rng = random.Random(33)
    monkeypatch.setattr(quality_model, "TRAIN_BYTES", 20_000)
    held = {r["i"] for r in spark.range(60).select(F.col("id").alias("i"), quality_model.remainder("id").alias("m")).collect() if r["m"] == 1}
    order = {r["i"]: r["h"] for r in spark.range(60).select(F.col("id").alias("i"), F.xxhash64("id").alias("h")).collect()}
    first = min((i for i in range(60) if i not in held), key=order.get)
    docs = [(i, "word " * 6000 if i == first else prose(rng, 40) + (" good" if i % 2 else " bad")) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    weights = quality_model.fit(frame(spark, docs), labels)
    assert np.count_nonzero(weights) > 100
    # Where nothing has room, the shortest text of each label is fitted.
    monkeypatch.setattr(quality_model, "TRAIN_BYTES", 1)
    assert np.count_nonzero(quality_model.fit(frame(spark, docs), labels)) > 10
    sizes = [{"order": o, "y": y, "bytes": b, "digest": 0} for o, y, b in ((1, 0, 50), (2, 1, 70), (3, 1, 60))]

    class Row(dict):
        def __iter__(self):
            return iter(self.values())

    assert quality_model._fitting([Row(s) for s in sizes]) == [(1, 0, 50, 0), (3, 1, 60, 0)]
