from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

pytest.importorskip("corpus_pipeline")
import corpus_pipeline  # noqa: E402

from rowsmith.llm import exact_dedup, mixing, near_dedup, quality_rules  # noqa: E402
from tests.llm.test_operators import brute_components, frame, prose, rows  # noqa: E402


def test_stages(spark, tmp_path):
    pytest.importorskip("public_tokenizers")
    rng = random.Random(4)
    docs = [(i, prose(rng, 120, 5000)) for i in range(120)]
    docs += [(200 + i, docs[i][1]) for i in range(10)] + [(300 + i, docs[20 + i][1] + " tail") for i in range(10)] + [(400 + i, " ".join(f"w{rng.randrange(400)}%%%" for _ in range(150))) for i in range(5)]
    df = frame(spark, docs).drop("row", "key")
    out, seen = df, []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, out, "")
        path = str(tmp_path / name.replace(" ", "_"))
        out.write.parquet(path)
        out = spark.read.parquet(path)
        seen.append({r["doc_id"] for r in rows(out.select("doc_id"))})
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == df.columns
    good = {i for i, _ in docs if i < 400}
    assert seen[0] == good
    assert seen[1] == good - set(range(10))  # of equal texts the largest id stays
    left = sorted(seen[1])
    texts = dict(docs)
    parts = brute_components([texts[i] for i in left], 5)
    assert seen[2] == {left[k] for k, p in enumerate(parts) if p[2]}
    assert seen[3] == seen[2] == seen[4]
    assert len(corpus_pipeline.STAGES) == 5 and (quality_rules and exact_dedup and near_dedup and mixing)


def test_stages_take_any_rows(spark, tmp_path):
    """Nulls in every column, empty and very long texts, repeated rows and ids, clashing column names, and no rows at all."""
    pytest.importorskip("public_tokenizers")
    rng = random.Random(6)
    usual = [(i, prose(rng, 90, 3000)) for i in range(60)]
    odd = [(None, None), (None, ""), (1, ""), (2, usual[2][1]), (2, usual[2][1]), (None, usual[3][1]), (None, prose(rng, 80, 3000)), (70, None), (71, prose(rng, 9000, 3000)), (72, "x" * 60_000), (5, prose(rng, 70, 3000))]
    df = frame(spark, usual).unionByName(frame(spark, odd, lang=None, source=None))
    extra = {c: F.lit("clash") for c in ("g", "digest", "id", "level", "name", "position", "_position", "_copy", "taken", "kept", "component_id", "text_sha256")}
    out = df.withColumns(extra)
    for name, stage in corpus_pipeline.STAGES:
        before = {(r["doc_id"], r["text"]) for r in rows(out.select("doc_id", "text"))}
        out = stage(spark, out, "")
        path = str(tmp_path / name.replace(" ", "_"))
        out.write.parquet(path)
        out = spark.read.parquet(path)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == [*df.columns, *extra]
            after = rows(out.select("doc_id", "text"))
            assert after and {(r["doc_id"], r["text"]) for r in after} <= before
        if name == "exact dedup":
            texts = [(r["text"] or "").lower() for r in after]
            assert len(texts) == len(set(texts))
    assert {None, 0} <= {r["doc_id"] for r in rows(out)}
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, df.withColumns(extra).limit(0), "").count() == 0
