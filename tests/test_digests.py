"""Diffs that read only buckets whose digests changed."""

from __future__ import annotations

import random
import shutil

from rowsmith.operators import changes, digests


def frame(spark, records):
    return spark.createDataFrame([(i, f) for i, f in records], "id string, fields map<string,string>")


def found(df):
    return sorted(((r["id"], r["field"], r["old"], r["new"]) for r in df.collect()), key=str)


def test_diff_since(spark, tmp_path):
    rng = random.Random(61)
    held = {f"r{i}": {k: str(rng.randrange(3)) for k in "abc" if rng.random() < 0.8} for i in range(200)}
    want = {i: {k: str(rng.randrange(3)) for k in f} for i, f in held.items() if rng.random() < 0.7} | {"new": {"a": "1"}, "": {"b": "2"}}
    snapshot, folder = str(tmp_path / "snapshot"), str(tmp_path / "diff")
    digests.store_snapshot(frame(spark, held.items()), snapshot, 16)
    desired = frame(spark, [*want.items(), (None, {"a": "x"}), ("r1", None)])
    whole = found(changes.field_diff(desired, frame(spark, held.items())))
    assert found(digests.diff_since(desired, snapshot, folder, 16)) == whole and whole
    # Nothing changed: the records aren't even there any more.
    shutil.move(f"{snapshot}/records", f"{tmp_path}/records")
    assert found(digests.diff_since(desired.repartition(3), snapshot, folder, 16)) == whole
    # One record of the plan changed: only its bucket is read.
    shutil.move(f"{tmp_path}/records", f"{snapshot}/records")
    bucket = spark.createDataFrame([("r5",)], "id string").select(digests.bucket_of(buckets=16)).first()[0]
    for k in range(16):
        if k != bucket:
            shutil.rmtree(f"{snapshot}/records/bucket={k}", ignore_errors=True)
    want["r5"] = {"a": "changed", "z": "9"}
    desired = frame(spark, [*want.items(), (None, {"a": "x"}), ("r1", None)])
    assert found(digests.diff_since(desired, snapshot, folder, 16)) == found(changes.field_diff(desired, frame(spark, held.items())))
    # The snapshot takes the changes.
    digests.store_snapshot(frame(spark, [(i, held.get(i, {}) | f) for i, f in {**held, **want}.items()]), snapshot, 16)
    assert {r[0] for r in found(digests.diff_since(frame(spark, want.items()), snapshot, folder, 16))} == set()
    assert found(digests.diff_since(desired.limit(0), snapshot, folder, 16)) == []
