"""Codes for vectors: each is cut into consecutive parts, each part is named by its codebook's nearest entry.

Components are whole numbers, floor(1024 x), so sums, distances and ties are exact and
reruns agree to the last bit, whatever the partitions.

The codebooks are fitted by Lloyd's rounds with heaps. A part that was compared with all
entries knows the distance u to its entry and l to the second nearest. When entries move,
u grows by at most its own entry's step and l shrinks by at most the largest step of
another entry; ``drift`` of an entry is the sum of both over the rounds. So a part whose
slack l - u exceeds its entry's drift since then keeps its entry. Vectors lie in blocks;
a block keeps, for each entry, a heap of its parts by slack plus the drift at the time,
so those that may have to move are on top: a round pops parts only until the top is
above the drift, compares exactly those with all entries, and pushes them back. Slacks
are lowered by more than rounding can add, so a tie is always compared exactly.

A round reads the blocks, writes them with their heaps to the shared folder, and adds up
in Spark only what changed hands: per entry, sums and counts of the parts that came less
those that left. The driver holds the codebooks, their sums and drifts, whose size
(parts x entries x width) doesn't depend on the rows. A lost executor costs a re-read of
the round's blocks.

Edge cases: vectors that are null or hold null, NaN or infinite components are left out;
so are those of another length than the vector of the smallest id. Of a length that the
number of parts doesn't divide, part k ends at component (k + 1) * length // parts.
Components are held to +-2**26 after scaling, where sums of squares stay exact. Repeated
rows count each; equal ids are ordered by their components, null ids come last. With fewer
vectors than entries the codebooks have as many entries as there are vectors; without
any there are no rows. Other columns are passed over, but for those asked for.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowsmith.llm._io import materialize, release, small_batches

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Vectors of a block at most, and the bytes of their components.
BLOCK_ROWS, BLOCK_BYTES = 4096, 1 << 20
#: Components after scaling are held to this.
LARGEST = 1 << 26
#: Where all squares and their sums stay below 2**53, products of floating-point matrices are exact.
EXACT = 1 << 53
#: Share of a slack that is given up for rounding.
MARGIN = 1e-9


def whole(vector: str | Column) -> Column:
    """The vector's components as whole numbers; null if it is null or a component is null or not finite."""
    v = F.col(vector) if isinstance(vector, str) else vector
    good = F.forall(v, lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    held = F.transform(v, lambda x: F.greatest(F.lit(-float(LARGEST)), F.least(F.lit(float(LARGEST)), F.floor(x.cast("double") * SCALE).cast("double"))).cast("int"))
    return F.when(good, held)


def _cuts(width: int) -> list[int]:
    return [k * width // PARTS for k in range(PARTS + 1)]


def _nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row of x its nearest row of c (the lower of equals), and the squared distances to it and to the second nearest."""
    entry, first, second = np.empty(len(x), np.int64), np.empty(len(x), np.int64), np.empty(len(x), np.float64)
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    fits = 4 * top * top * max(1, x.shape[1]) < EXACT
    step = 2048 if fits else max(1, (1 << 20) // max(1, c.size))
    for i in range(0, len(x), step):
        part = x[i : i + step]
        if fits:
            d = (c.astype(np.float64) ** 2).sum(1) - 2.0 * (part.astype(np.float64) @ c.T.astype(np.float64)) + (part.astype(np.float64) ** 2).sum(1)[:, None]
        else:
            d = ((part.astype(np.int64)[:, None, :] - c.astype(np.int64)[None]) ** 2).sum(2)
        at = np.arange(len(part))
        entry[i : i + step] = best = d.argmin(1)
        first[i : i + step] = d[at, best]
        if len(c) > 1:
            d[at, best] = np.iinfo(np.int64).max if d.dtype == np.int64 else np.inf
            second[i : i + step] = d.min(1)
        else:
            second[i : i + step] = np.inf
    return entry, first, second


class Block:
    """Vectors with, for each part position and entry, a heap of (slack plus drift, row)."""

    def __init__(self, x: np.ndarray, entries: int, heaps: list[list[list[tuple[float, int]]]] | None = None):
        self.x, self.entries, self.cuts = x, entries, _cuts(x.shape[1])
        self.heaps = heaps or [[[] for _ in range(entries)] for _ in range(PARTS)]

    def reassign(self, books: list[np.ndarray], drift: np.ndarray, fresh: bool) -> list[tuple[int, int, int, list[int]]]:
        """Pop the parts whose slack their entry's drift has used up (``fresh``: all), compare them with all entries
        and push them back. What changed hands: (part, entry, count, sum of components), negative where parts left."""
        moves = []
        for k, book in enumerate(books):
            heaps, columns = self.heaps[k], self.x[:, self.cuts[k] : self.cuts[k + 1]]
            rows, was = [], []
            if fresh:
                rows, was = list(range(len(columns))), [-1] * len(columns)
            else:
                for e, heap in enumerate(heaps):
                    used = drift[k, e]
                    while heap and heap[0][0] <= used:
                        rows.append(heapq.heappop(heap)[1])
                        was.append(e)
            if not rows:
                continue
            part, old = columns[rows], np.array(was)
            entry, first, second = _nearest(part, book)
            near, far = np.sqrt(first.astype(np.float64)), np.sqrt(second)
            used = drift[k, entry]
            slack = far - near + used - MARGIN * (1 + np.where(np.isinf(far), 0, far) + near + used)
            for key, row, e in zip(slack.tolist(), rows, entry.tolist(), strict=True):
                heapq.heappush(heaps[e], (key, row))
            moved = entry != old
            for e, sign in ((entry[moved], 1), (old[moved], -1)):
                there = part[moved][e >= 0].astype(np.int64)
                e = e[e >= 0]
                order = np.argsort(e, kind="stable")
                names, starts, counts = np.unique(e[order], return_index=True, return_counts=True)
                sums = np.add.reduceat(there[order], starts, axis=0) if len(names) else []
                moves += [(k, int(n), sign * int(c), (sign * s).tolist()) for n, c, s in zip(names, counts, sums, strict=True)]
        return moves

    def codes(self, books: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Each vector's entries, and its squared distance to them in all."""
        out, error = np.zeros((len(self.x), PARTS), np.int64), np.zeros(len(self.x), np.int64)
        for k, book in enumerate(books):
            for e, heap in enumerate(self.heaps[k]):
                out[[row for _, row in heap], k] = e
            error += ((self.x[:, self.cuts[k] : self.cuts[k + 1]].astype(np.int64) - book[out[:, k]]) ** 2).sum(1)
        return out, error

    def packed(self) -> tuple[bytes, bytes, bytes]:
        """The heaps as they lie: their sizes, slacks and rows."""
        flat = [item for heaps in self.heaps for heap in heaps for item in heap]
        sizes = [len(heap) for heaps in self.heaps for heap in heaps]
        return np.array(sizes, np.int32).tobytes(), np.array([f[0] for f in flat], np.float64).tobytes(), np.array([f[1] for f in flat], np.int32).tobytes()

    @staticmethod
    def unpacked(x: np.ndarray, sizes: bytes, slacks: bytes, rows: bytes) -> Block:
        ends = np.cumsum(np.frombuffer(sizes, np.int32)).tolist()
        flat = list(zip(np.frombuffer(slacks, np.float64).tolist(), np.frombuffer(rows, np.int32).tolist(), strict=True))
        every = [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        entries = len(ends) // PARTS
        return Block(x, entries, [every[k * entries : (k + 1) * entries] for k in range(PARTS)])


_MOVES = pa.list_(pa.struct([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("s", pa.list_(pa.int64()))]))
_STATE = "x binary, sizes binary, slacks binary, rows binary, moves array<struct<part: int, entry: int, n: bigint, s: array<bigint>>>"


def _written(kept: list, x: np.ndarray, block: Block, moves: list) -> pa.RecordBatch:
    """One block as one row."""
    width = np.int16 if np.abs(x).max(initial=0) < 1 << 15 else np.int32
    made = [[x.astype(width).tobytes()], *[[b] for b in block.packed()], [[dict(zip(("part", "entry", "n", "s"), m, strict=True)) for m in moves]]]
    kinds = [pa.binary()] * 4 + [_MOVES]
    columns = [pa.array([c.to_pylist()], pa.list_(c.type)) for c in kept] + [pa.array(m, k) for m, k in zip(made, kinds, strict=True)]
    names = [f"kept{i}" for i in range(len(kept))] + ["x", "sizes", "slacks", "rows", "moves"]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _read(batch: pa.RecordBatch, i: int, n_kept: int, width: int) -> tuple[np.ndarray, Block]:
    """Row ``i``: the components of its vectors, and their heaps."""
    raw = [batch.column(n_kept + k)[i].as_py() for k in range(4)]
    n = len(batch.column(0)[i])
    kind = np.int16 if len(raw[0]) == 2 * n * width else np.int32
    x = np.frombuffer(raw[0], kind).reshape(n, width).astype(np.int32)
    return x, Block.unpacked(x, *raw[1:])


class Codebooks:
    """The entries of all parts, the sums and counts of what is assigned to them, and their drifts."""

    def __init__(self, vectors: np.ndarray):
        self.cuts = _cuts(vectors.shape[1])
        self.books = [vectors[:, a:b].astype(np.int64) for a, b in zip(self.cuts, self.cuts[1:], strict=False)]
        self.sums = [np.zeros_like(b) for b in self.books]
        self.counts = np.zeros((PARTS, len(vectors)), np.int64)
        self.drift = np.zeros((PARTS, len(vectors)))

    def update(self, moves: list) -> None:
        """Add up what changed hands and move each entry to the floor of its parts' mean; unused ones stay."""
        for m in moves:
            self.counts[m["part"], m["entry"]] += m["n"]
            self.sums[m["part"]][m["entry"]] += np.array(m["s"], np.int64)
        for k, book in enumerate(self.books):
            n = self.counts[k][:, None]
            new = np.where(n > 0, self.sums[k] // np.maximum(n, 1), book)
            step = np.sqrt(((new - book).astype(np.float64) ** 2).sum(1))
            self.books[k] = new
            if len(step) > 1:
                top = np.sort(step)[-2:]
                others = np.where((step == top[1]) & (np.cumsum(step == top[1]) == 1), top[0], top[1])
                self.drift[k] = (self.drift[k] + step + others) * (1 + MARGIN)

    def digest(self) -> str:
        """SHA-256 of all components in decimal by part, entry and place, joined by commas."""
        return hashlib.sha256(",".join(str(v) for b in self.books for v in b.ravel().tolist()).encode()).hexdigest()


def _moved(blocks: DataFrame) -> list:
    """What changed hands over all blocks, at most one row per part and entry."""
    m = blocks.select(F.explode("moves").alias("m")).select("m.part", "m.entry", "m.n", F.posexplode_outer("m.s").alias("at", "v"))
    each = m.groupBy("part", "entry", "at").agg(F.sum(F.when(F.coalesce("at", F.lit(0)) == 0, F.col("n"))).alias("n"), F.sum("v").alias("v"))
    rows = each.groupBy("part", "entry").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.when(F.col("at").isNotNull(), F.struct("at", "v")))).alias("s")).collect()
    return [{"part": r["part"], "entry": r["entry"], "n": r["n"], "s": [x["v"] for x in r["s"]]} for r in rows]


def encode(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", keep: tuple[str, ...] = (), rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks | None]:
    """Codes for ``vectors`` after ``rounds`` rounds: (id, *keep, entries array<int>, error long), and the codebooks."""
    spark = vectors.sparkSession
    small_batches(spark)
    asked = [id_column, *keep]
    rows = vectors.select(*asked, whole(vector).alias("v")).where("v is not null")
    least = lambda df: [r["v"] for r in df.orderBy(F.col(id_column).asc_nulls_last(), "v").limit(ENTRIES).select("v").collect()]
    first = least(rows)
    kept_schema = [T.StructField(c, vectors.schema[c].dataType) for c in asked]
    out_schema = T.StructType([*kept_schema, T.StructField("entries", T.ArrayType(T.IntegerType())), T.StructField("error", T.LongType())])
    if not first:
        return spark.createDataFrame([], out_schema), None
    width = len(first[0])
    if any(len(v) != width for v in first):
        first = least(rows.where(F.size("v") == width))
    state = Codebooks(np.array(first, np.int64).reshape(len(first), width))
    n_kept = len(asked)
    most = max(1, min(BLOCK_ROWS, BLOCK_BYTES // max(1, 4 * width)))
    schema = T.StructType([*[T.StructField(f"kept{i}", T.ArrayType(f.dataType)) for i, f in enumerate(kept_schema)], *T._parse_datatype_string(_STATE).fields])

    def begin(books: list[np.ndarray], drift: np.ndarray):
        """Vectors to blocks, every part compared with all entries."""

        def made(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            columns = [t.column(i).combine_chunks() for i in range(n_kept + 1)]
            x = columns.pop().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, width).astype(np.int32)
            block = Block(x, len(books[0]))
            return _written(columns, x, block, block.reassign(books, drift, True))

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, n = [], 0
            for batch in batches:
                while batch.num_rows:
                    part = batch.slice(0, most - n)
                    batch = batch.slice(part.num_rows)
                    held.append(part)
                    n += part.num_rows
                    if n == most:
                        yield made(held)
                        held, n = [], 0
            if n:
                yield made(held)

        return run

    def again(books: list[np.ndarray], drift: np.ndarray):
        """Blocks after the entries moved."""

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    x, block = _read(batch, i, n_kept, width)
                    moves = block.reassign(books, drift, False)
                    yield _written([batch.column(c)[i].values for c in range(n_kept)], x, block, moves)

        return run

    def end(books: list[np.ndarray], drift: np.ndarray):
        """The last assignment: one row per vector."""

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    x, block = _read(batch, i, n_kept, width)
                    block.reassign(books, drift, False)
                    codes, error = block.codes(books)
                    entries = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * PARTS), pa.array(codes.ravel().astype(np.int32)))
                    yield pa.RecordBatch.from_arrays([*[batch.column(c)[i].values for c in range(n_kept)], entries, pa.array(error)], names=[*asked, "entries", "error"])

        return run

    blocks = materialize(rows.where(F.size("v") == width).mapInArrow(begin(state.books, state.drift), schema), "codes")
    state.update(_moved(blocks))
    for _ in range(rounds - 1):
        after = materialize(blocks.drop("moves").mapInArrow(again(state.books, state.drift), schema), "codes")
        release(blocks)
        blocks = after
        state.update(_moved(blocks))
    return blocks.drop("moves").mapInArrow(end(state.books, state.drift), out_schema), state


#: A label with more than this share of all rows is looked up by broadcast: there are fewer than 1 / share of them.
HOT_LABEL = 1 / 256


def with_group_error(codes: DataFrame, by: str) -> DataFrame:
    """``codes`` with ``label_error``, the error summed over equal values of ``by``, nulls together.

    Sums are added up before they are shuffled. Values that hold a large share of the rows get theirs
    by broadcast, and such rows are dealt evenly over the join with the others' sums."""
    sums = materialize(codes.groupBy(by).agg(F.sum("error").alias("label_error"), F.count("*").alias("n")), "labels")
    total = sums.agg(F.sum("n")).first()[0] or 0
    hot = sums.where(F.col("n") > total * HOT_LABEL).select(F.col(by).alias("_hot"), F.col("label_error").alias("_hot_error"))
    cold = sums.where(F.col("n") <= total * HOT_LABEL).select(F.col(by).alias("_cold"), F.col("label_error").alias("_cold_error"), F.lit(0).alias("_salt"))
    rows = codes.join(F.broadcast(hot), F.col(by).eqNullSafe(F.col("_hot")), "left")
    salt = F.when(F.col("_hot_error").isNull(), 0).otherwise(1 + F.pmod(F.monotonically_increasing_id(), F.lit(1 << 20)).cast("int"))
    rows = rows.withColumn("_at", salt)
    rows = rows.join(cold, F.col(by).eqNullSafe(F.col("_cold")) & (F.col("_at") == F.col("_salt")), "left")
    return rows.select(*codes.columns, F.coalesce("_hot_error", "_cold_error").alias("label_error"))


def digests(vectors: DataFrame) -> DataFrame:
    """Per kept row of ``vectors`` (vec_id, embedding, label): vec_id, code, error, label_error, codebooks_sha256."""
    codes, state = encode(vectors.select("vec_id", "embedding", "label"), keep=("label",))
    written = materialize(codes, "coded")
    code = F.concat_ws("", F.transform("entries", lambda e: F.lower(F.lpad(F.hex(e.cast("long")), 2, "0"))))
    named = F.lit(state.digest() if state else hashlib.sha256(b"").hexdigest())
    return with_group_error(written, "label").select("vec_id", code.alias("code"), "error", "label_error", named.alias("codebooks_sha256"))


def _sql() -> str:
    """All rounds, every part compared with every entry; components by (part, place)."""
    width = "(len(v) // 4)"
    nearest = "select r, j, min(d * 256 + e) as m from (select r, j, e, sum((x - c) * (x - c))::bigint as d from p join c{0} using (j, k) group by all) group by all"
    moved = "select c{0}.j, c{0}.e, c{0}.k, coalesce(((s - ((s % n) + n) % n) // n), c) as c from c{0} left join (select j, m % 256 as e, k, sum(x)::bigint as s, count(*) as n from a{0} join p using (r, j) group by all) u using (j, e, k)"
    steps = ", ".join(f"a{i} as materialized ({nearest.format(i)}), c{i + 1} as materialized ({moved.format(i)})" for i in range(ROUNDS))
    return f"""
with v as materialized (
  select row_number() over (order by vec_id) as r, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v
  from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as materialized (select r, (i - 1) // w as j, (i - 1) % w as k, x from (select r, {width} as w, unnest(v) as x, generate_subscripts(v, 1) as i from v)),
c0 as materialized (select j, r - 1 as e, k, x as c from p where r <= 256), {steps}, a{ROUNDS} as materialized ({nearest.format(ROUNDS)}),
o as (select r, string_agg(printf('%02x', (m % 256)::int), '' order by j) as code, sum(m // 256)::bigint as error from a{ROUNDS} group by r),
h as (select sha256(string_agg(c::varchar, ',' order by j, e, k)) as codebooks_sha256 from c{ROUNDS})
select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, codebooks_sha256 from v join o using (r), h
"""


SQL = _sql()
