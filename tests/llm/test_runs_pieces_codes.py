"""Periodic runs, SentencePiece tokens and vector codes against brute force, with nulls, ties, repeats, empty tables and extra columns."""

from __future__ import annotations

import hashlib
import heapq
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowsmith.llm import periodic_runs, pieces, vector_codes
from tests.llm.test_operators import frame, prose, rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---------------------------------------------------------------- 11
def brute_runs(s):
    """All runs by looking at every period and place."""
    found = {}
    for q in range(1, len(s) // 4 + 1):
        i = 0
        while i + q < len(s):
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((a, n, q) for (a, n), q in found.items()), key=lambda r: (r[0], r[2]))


def random_words(rng):
    k, n = rng.choice((1, 2, 3, 4, 40)), rng.randrange(80)
    s = [rng.randrange(k) for _ in range(n)]
    if rng.random() < 0.6:
        block, at = [rng.randrange(k) for _ in range(rng.randrange(1, 12))], rng.randrange(n + 1)
        s[at:at] = block * rng.randrange(2, 10) + block[: rng.randrange(len(block))]
    return s * rng.choice((1, 1, 1, 2, 5))


def test_runs_of_number_sequences():
    rng = random.Random(11)
    cases = [random_words(rng) for _ in range(1500)] + [[], [1], [1] * 5, [1] * 6, [1, 2] * 4, [1, 2] * 3, ([1, 1, 1, 1, 1, 1, 2] * 5)]
    offsets = np.concatenate([[0], np.cumsum([len(c) for c in cases])])
    found = periodic_runs.all_runs(np.array([x for c in cases for x in c], np.int32), offsets)
    assert found == [brute_runs(c) for c in cases] and sum(map(len, found)) > 1000


def test_z_function():
    rng = random.Random(12)
    for _ in range(200):
        s = [rng.randrange(2) for _ in range(rng.randrange(30))]
        assert periodic_runs.z_function(s) == [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(len(s))]


def brute_summary(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    start, length, period = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return {
        "doc_id": doc_id, "n_runs": len(runs), "start": start, "length": length, "period": period, "exponent_milli": 1000 * length // period if runs else None,
        "runs_sha256": digest("".join(f"{a},{n},{q}\n" for a, n, q in runs)), "collapsed_sha256": digest(" ".join(w for i, w in enumerate(words) if i not in gone)),
    }


def run_texts():
    rng = random.Random(13)
    texts = [(i, prose(rng, rng.randrange(1, 300), 60)) for i in range(120)]
    texts += [(200 + i, " ".join(f"é{x}" for x in random_words(rng))) for i in range(60)]
    texts += [(300, None), (301, ""), (302, " \t\n"), (303, "a " * 5000), (304, "x" * 60_000), (305, "a\x0bb a\x0cb a b a b " * 7), (None, "la " * 9), (None, None), (0, texts[0][1]), (0, texts[0][1])]
    texts.append((306, prose(rng, 2000, 3000) + " " + " ".join(prose(rng, 300, 3000) for _ in range(1)) + " " + "eins zwei drei " * 400))
    return texts


def test_runs_of_texts(spark):
    texts = run_texts()
    key = lambda r: (str(r["doc_id"]), r["collapsed_sha256"])
    got = sorted(rows(periodic_runs.summaries(frame(spark, texts), periodic_runs.planted)), key=key)
    assert got == sorted((brute_summary(i, t) for i, t in texts), key=key)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 and r["n_runs"] for i, r in ((r["doc_id"], r) for r in got))


def test_run_rows_and_collapsed_texts(spark):
    df = frame(spark, [(1, "so so so so so so it it goes"), (2, "a b c a b c a b c a b c a"), (3, "no runs"), (4, None)])
    assert {(r["doc_id"], r["start"], r["length"], r["period"], r["exponent_milli"]) for r in rows(periodic_runs.find_runs(df))} == {(1, 0, 6, 1, 6000), (2, 0, 13, 3, 4333)}
    assert {(r["doc_id"], r["text"]) for r in rows(periodic_runs.collapse_runs(df))} == {(1, "so it it goes"), (2, "a b c"), (3, "no runs"), (4, "")}
    none = df.limit(0)
    assert periodic_runs.find_runs(none).count() == periodic_runs.collapse_runs(none).count() == periodic_runs.summaries(none).count() == 0


def test_a_long_text_of_few_words_is_not_quadratic():
    n = 40_000
    assert periodic_runs.all_runs(np.zeros(n, np.int32), np.array([0, n])) == [[(0, n, 1)]]


# ---------------------------------------------------------------- 12
@pytest.fixture(scope="module")
def model():
    return str(pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model"))


def piece_texts():
    rng = random.Random(14)
    alphabet = "abcdefghij ▁ tTheirn'.,é漢😀\t\n\x000123"
    texts = ["", " ", "   ", "▁", "▁▁a", "a▁b ", "<s>", "</s><unk>", "<0x41>", "😀😀é", "\t\n\r", "x" * 5000, " " * 3000, "ab" * 3000, "日本語テキスト漢字" * 50, "�", "  "]
    return texts + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(400)] + [prose(rng, 200) for _ in range(20)]


def test_pieces_equal_the_library(model):
    from sentencepiece import SentencePieceProcessor

    library, mine = SentencePieceProcessor(model_file=model), pieces.PieceEncoder(model)
    for t in piece_texts():
        want = library.encode(t)
        n, line, back = mine.both(t)
        assert mine.encode(t) == want and n == len(want) and line == ",".join(map(str, want))
        assert back == library.decode(want) == mine.decode(want)
    rng = random.Random(15)
    for _ in range(3000):
        ids = [rng.choice([rng.randrange(32_000), rng.randrange(3, 259), 259, 260, rng.randrange(3)]) for _ in range(rng.randrange(1, 12))]
        assert mine.decode(ids) == library.decode(ids)


def test_backtracking_equals_merging_for_any_scores():
    """Small vocabularies with random scores, where longest matches are often wrong."""
    rng = random.Random(16)
    backs = 0
    for _ in range(150):
        enc = object.__new__(pieces.PieceEncoder)
        vocabulary = {c: 0.0 for c in "abc" if rng.random() < 0.9} | {"".join(rng.choice("abc") for _ in range(rng.randrange(2, 6))): -float(rng.randrange(12)) for _ in range(14)}
        enc._index([*vocabulary.items(), None])
        for _ in range(20):
            text = "".join(rng.choice("abcd") for _ in range(rng.randrange(40)))
            assert [enc.piece[i] for i in enc.tokens(text)] == enc.merged(text)
            greedy, at = [], 0
            while at < len(text):
                size = max((k for k in range(1, 6) if text[at : at + k] in enc.score), default=1)
                greedy.append(text[at : at + size])
                at += size
            backs += greedy != enc.merged(text)
    assert backs > 500


def test_pieces_on_tables(spark, model):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=model)
    texts = [*enumerate(piece_texts()), (7, None), (None, "no id"), (None, None), (3, "again"), (3, "again")]
    df = frame(spark, texts)
    want = []
    for i, t in texts:
        ids = library.encode(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((library.decode(ids) if ids else "").encode()).hexdigest()))
    assert sorted(map(tuple, pieces.digests(df, model).collect()), key=str) == sorted(want, key=str)
    encoded = pieces.encode_texts(df, model)
    assert encoded.dtypes == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids", "array<int>"), ("decoded", "string")]
    assert sorted(map(str, (tuple(r) for r in pieces.decode_ids(encoded, model).collect()))) == sorted(str((r["doc_id"], r["decoded"])) for r in encoded.collect())
    assert pieces.decode_ids(spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>"), model).collect()[0]["text"] == ""
    assert pieces.digests(df.limit(0), model).count() == 0


def test_other_models_are_refused(tmp_path, model):
    from sentencepiece import sentencepiece_model_pb2 as proto

    m = proto.ModelProto()
    m.ParseFromString(open(model, "rb").read())
    m.pieces[300].type = proto.ModelProto.SentencePiece.USER_DEFINED
    (tmp_path / "m").write_bytes(m.SerializeToString())
    with pytest.raises(ValueError, match="user-defined"):
        pieces.PieceEncoder(str(tmp_path / "m"))


# ---------------------------------------------------------------- 13
def brute_codes(vectors, entries=256, rounds=4):
    """{row: (code, error)} and the codebooks, by comparing everything with everything in Python's whole numbers."""
    good = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in vectors if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(good[0][1])
    cuts = [k * w // 4 for k in range(5)]
    books = [[v[a:b] for _, v in good[:entries]] for a, b in zip(cuts, cuts[1:])]
    far = lambda x, c: sum((p - q) ** 2 for p, q in zip(x, c))

    def assigned():
        return [[min(range(len(book)), key=lambda e: (far(v[a:b], book[e]), e)) for a, b, book in zip(cuts, cuts[1:], books)] for _, v in good]

    for _ in range(rounds):
        now = assigned()
        for k, book in enumerate(books):
            for e in range(len(book)):
                mine = [good[r][1][cuts[k] : cuts[k + 1]] for r, a in enumerate(now) if a[k] == e]
                if mine:
                    book[e] = [sum(c) // len(mine) for c in zip(*mine)]
    out = [(i, "".join(f"{e:02x}" for e in a), sum(far(v[cuts[k] : cuts[k + 1]], books[k][e]) for k, e in enumerate(a))) for (i, v), a in zip(good, assigned())]
    return out, hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()


def vector_frame(spark, vectors, labels=None):
    label = labels or (lambda i: None if i is None else i % 3)
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], label(i), "x", 1.5) for i, v in vectors], "vec_id long, embedding array<float>, label int, entries string, error double")


def check_codes(spark, vectors):
    want, named = brute_codes(vectors)
    got = rows(vector_codes.digests(vector_frame(spark, vectors).repartition(5)))
    assert sorted((str(r["vec_id"]), r["code"], r["error"]) for r in got) == sorted((str(i), c, e) for i, c, e in want)
    assert {r["codebooks_sha256"] for r in got} == {named}
    sums = {}
    for i, _, e in want:
        k = None if i is None else i % 3
        sums[k] = sums.get(k, 0) + e
    assert all(r["label_error"] == sums[None if r["vec_id"] is None else r["vec_id"] % 3] for r in got)


def test_codes_of_random_vectors(spark):
    rng = np.random.default_rng(17)
    vectors = [(int(i), list(map(float, v))) for i, v in enumerate(rng.normal(0, 0.2, (700, 8)).round(2))]
    check_codes(spark, vectors)


def test_codes_with_ties_copies_nulls_and_wide_values(spark):
    rng = np.random.default_rng(18)
    vectors = [(int(i), [float(x) / 1024 for x in v]) for i, v in enumerate(rng.integers(-2, 3, (500, 8)))]  # few values: many ties
    vectors += [(vectors[3][0], vectors[4][1])] * 3 + [(None, vectors[5][1]), (None, vectors[6][1])]
    vectors += [(900, None), (901, [None] * 8), (902, [float("nan")] * 8), (903, [0.1] * 7 + [float("inf")]), (904, [0.1] * 7 + [None])]
    vectors += [(905 + i, [float(x) for x in rng.normal(0, 9000, 8)]) for i in range(5)]
    check_codes(spark, vectors)


def test_codes_of_few_or_no_vectors(spark):
    check_codes(spark, [(5, [0.5] * 4), (7, [0.25, -0.5, 0.1, 0.0]), (9, [0.5] * 4)])
    check_codes(spark, [(5, [0.5, 0.1])])  # parts without components
    none = vector_codes.digests(vector_frame(spark, [(1, None)]))
    assert none.count() == 0 and none.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    mixed = vector_frame(spark, [(1, [0.5] * 4), (2, [0.5] * 8), (3, [0.25] * 4)])
    assert {r["vec_id"] for r in rows(vector_codes.digests(mixed))} == {1, 3}


def test_heaps_hold_every_part_once_and_spare_comparisons():
    rng = np.random.default_rng(19)
    centres = rng.integers(-5000, 5000, (40, 16))
    x = (centres[rng.integers(0, 40, 3000)] + rng.integers(-40, 40, (3000, 16))).astype(np.int32)
    state, block, compared = vector_codes.Codebooks(x[:256].astype(np.int64)), vector_codes.Block(x, 256), []
    near = vector_codes._nearest
    for k in range(6):
        seen = []
        vector_codes._nearest = lambda part, book, seen=seen: (seen.append(len(part)), near(part, book))[1]
        try:
            moves = block.reassign(state.books, state.drift, k == 0)
        finally:
            vector_codes._nearest = near
        compared.append(sum(seen))
        for part, (a, b) in enumerate(zip(state.cuts, state.cuts[1:], strict=False)):
            held = {row: e for e, heap in enumerate(block.heaps[part]) for _, row in heap}
            assert sorted(held) == list(range(3000)) and sum(map(len, block.heaps[part])) == 3000
            assert [held[r] for r in range(3000)] == near(x[:, a:b], state.books[part])[0].tolist()
            assert all(h == sorted(h) or heapq.nsmallest(1, h)[0] == h[0] for h in block.heaps[part])
        again = vector_codes.Block.unpacked(x, *block.packed())
        assert again.heaps == block.heaps
        state.update([dict(zip(("part", "entry", "n", "s"), m, strict=True)) for m in moves])
    assert compared[0] == 12_000 and compared[-1] < 9_000, compared


def test_label_errors_of_hot_and_many_labels(spark):
    df = spark.range(6000).select(F.col("id").alias("vec_id"), F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, F.lit(-1)).otherwise(F.col("id")).cast("int").alias("label"), (F.col("id") % 7).alias("error"))
    got = {r["vec_id"]: r["label_error"] for r in rows(vector_codes.with_group_error(df, "label"))}
    for i in range(6000):
        assert got[i] == (sum(j % 7 for j in range(i % 3, 6000, 3)) if i % 3 < 2 else i % 7)
    assert len(got) == 6000
