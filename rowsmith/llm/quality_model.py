"""Quality classifier: logistic regression on hashed word n-grams, trained with
follow-the-regularised-leader updates, scored as sparse dot products.

Features of a text are its words and pairs of words (A to Z in lower case), the shapes
of its words (runs of lower-case letters, capitals and digits each as one sign, other
signs as they are), pairs and triples of shapes, and pairs of equal neighbours. All are
hashed into ``2**BITS`` buckets; the counts of word features and of shape features are
each scaled to unit length. Ids, languages, sources and labels are no features.

Training reads at most ``TRAIN_ROWS`` labelled rows of at most ``TRAIN_BYTES`` of text in all,
the ones whose ids hash lowest, so the model and the time to fit it don't grow with the
tables; scoring covers all rows.

Edge cases: null and empty texts have only the constant feature and still get a score;
null ids are scored and never held out; labels other than 0 and 1 are ignored; without
any usable label all scores are 0.5; repeated rows score alike; other columns are
ignored; rows that repeat a labelled row are fitted once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.llm._io import materialize, small_batches, text_of
from rowsmith.llm._words import LOWER, U, hash_spans, mix, texts, words

BITS = 18
#: Most labelled rows that are fitted.
TRAIN_ROWS = 6000
#: Most bytes of their texts in all. Features are some four times as large as an ordinary text, 24 times at most.
TRAIN_BYTES = 24 << 20
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.3, 1.0, 1e-4, 1e-3
BIAS = 1 << BITS

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123] = 97
_SHAPE[128:] = 97
_SHAPE[65:91] = 65
_SHAPE[48:58] = 48


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, buckets and values of the non-zero features of a run of texts, sorted by row and bucket."""
    s, e, row = words(data, offsets)
    h = hash_spans(LOWER[data], s, e)
    # Shapes: keep the first byte of each run of one class, inside a word.
    shape = _SHAPE[data]
    first = np.ones(len(shape), bool)
    first[1:] = shape[1:] != shape[:-1]
    first[s] = True
    place = np.concatenate([[0], np.cumsum(first)])
    g = hash_spans(shape[first], place[s], place[e])
    pair = np.flatnonzero(row[1:] == row[:-1]) if len(row) > 1 else np.zeros(0, np.int64)
    triple = np.flatnonzero(row[2:] == row[:-2]) if len(row) > 2 else np.zeros(0, np.int64)
    same = pair[h[pair] == h[pair + 1]]
    tag = lambda x, k: mix(x + U(k * 0x9E3779B97F4A7C15 % (1 << 64)))
    blocks = [
        (row, tag(h, 1), 0), (row[pair], tag(h[pair] * U(3) + mix(h[pair + 1]), 2), 0),
        (row, tag(g, 3), 1), (row[pair], tag(g[pair] * U(3) + mix(g[pair + 1]), 4), 1),
        (row[triple], tag(g[triple] * U(5) + mix(g[triple + 1] * U(3) + mix(g[triple + 2])), 5), 1),
        (row[same], tag(np.zeros(len(same), U), 6), 1),
    ]
    half = U(1 << (BITS - 1))
    key = np.concatenate([(r.astype(U) << U(BITS)) | (x % half + half * U(b)) for r, x, b in blocks])
    key, count = np.unique(key, return_counts=True)
    r, bucket = (key >> U(BITS)).astype(np.int64), (key & U((1 << BITS) - 1)).astype(np.int64)
    side = 2 * r + (bucket >> (BITS - 1))
    value = np.log1p(count)
    norm = np.sqrt(np.bincount(side, value * value, 2 * (len(offsets) - 1)))
    return r, bucket, value / norm[side]


class Ftrl:
    """Per-coordinate FTRL-proximal logistic regression."""

    def __init__(self, size: int = (1 << BITS) + 1):
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, i: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[i], self.n[i]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, i: np.ndarray, x: np.ndarray, y: int) -> None:
        w = self.weights(i)
        p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
        g = (p - y) * x
        n = self.n[i]
        self.z[i] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[i] = n + g * g


def remainder(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % 3


def _featured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, data, offsets in texts(batch.column(2)):
            k = len(offsets) - 1
            r, bucket, value = features(data, offsets)
            cut = pa.array(np.concatenate([[0], np.cumsum(np.bincount(r, minlength=k))]), pa.int32())
            lists = [pa.ListArray.from_arrays(cut, pa.array(bucket, pa.int32())), pa.ListArray.from_arrays(cut, pa.array(value, pa.float32()))]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, k), batch.column(1).slice(at, k), *lists], names=["order", "y", "i", "x"])


def _fitting(sizes: list) -> list[tuple]:
    """Of (order, y, bytes, digest) in order those with room in TRAIN_BYTES, others being passed over; of a label
    that would be left out the shortest text is fitted all the same."""
    out, room = [], TRAIN_BYTES
    for r in sizes:
        if r["bytes"] <= room:
            out.append(tuple(r))
            room -= r["bytes"]
    for y in sorted({r["y"] for r in sizes} - {r[1] for r in out}):
        out.append(min(((r["bytes"], *r) for r in sizes if r["y"] == y))[1:])
    return out


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, epochs: int = EPOCHS) -> np.ndarray:
    """Weights from labelled rows (doc_id, quality) outside the held-out third, at most ``rows`` of them and of these, in order
    of their ids' hashes, the ones with room in TRAIN_BYTES of text."""
    small_batches(docs.sparkSession)
    known = labels.where("quality in (0, 1)").where(remainder() != 1)
    order = F.xxhash64("doc_id")
    sample = known.select("doc_id", F.col("quality").cast("int").alias("y"), order.alias("order")).orderBy("order", "doc_id", "y").limit(rows)
    # At most ``rows`` rows of three numbers: small enough to broadcast whatever the tables' size.
    picked = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("order", "y", "text").dropDuplicates(["order", "y", "text"])
    picked = materialize(picked, "labelled")
    # One row of numbers per picked row, at most ``rows`` of them; an id with several texts stands for as many as there is room for.
    by = ("order", "y", "bytes", "digest")
    keyed = picked.withColumns({"bytes": F.octet_length(text_of("text")).cast("long"), "digest": F.xxhash64("text")})
    chosen = _fitting(keyed.select(*by).orderBy(*by).limit(rows).collect())
    picked = keyed.join(F.broadcast(picked.sparkSession.createDataFrame(chosen, "order long, y int, bytes long, digest long")), list(by), "left_semi").select("order", "y", "text")
    table = picked.mapInArrow(_featured, "order long, y int, i array<int>, x array<float>").toArrow()
    model = Ftrl()
    order, y = table.column("order").to_numpy(), table.column("y").to_numpy()
    lists = lambda c: (table.column(c).combine_chunks().flatten().to_numpy(), np.concatenate([[0], np.cumsum(table.column(c).combine_chunks().value_lengths().to_numpy())]))
    if len(y):
        (bucket, cut), (value, _) = lists("i"), lists("x")
        turn = np.lexsort((y, order))
        for _ in range(epochs):
            for t in turn:
                i = np.append(bucket[cut[t] : cut[t + 1]], BIAS)
                model.learn(i, np.append(value[cut[t] : cut[t + 1]], 1.0).astype(float), int(y[t]))
    return model.weights().astype(np.float32)


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted."""
    small_batches(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in texts(batch.column(1)):
                k = len(offsets) - 1
                r, bucket, value = features(data, offsets)
                total = np.bincount(r, value * weights[bucket], k) + float(weights[BIAS])
                p = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, k), pa.array(p, pa.float64())], names=["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
    held = F.coalesce(remainder() == 1, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """Fit on the labels, score all documents."""
    return score(docs, fit(docs, labels, rows))
