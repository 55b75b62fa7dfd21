"""MinHash near-duplicates with sequential Bayesian verification.

1. One pass over the texts makes, per document, the set of distinct word
   shingles as 64-bit hashes, its digest, its size and a MinHash signature.
   Documents with one digest form a class; everything below runs on classes.
2. Signatures are cut into bands. Every class that shares a band with others is
   paired with the band's first class (a star, so candidates stay linear in the
   members, however large a bucket is).
3. Candidates are verified sequentially: signatures are compared batch by batch,
   and a pair is dropped as soon as the posterior probability that its similarity
   reaches the threshold falls below ``miss``. Survivors are verified exactly on
   their full shingle sets.
4. Connected components of the verified links are found. A band whose members all lie in
   one component can add nothing. The members of the others are compared block against
   block by step 3's test, in tasks of bounded size that emit only a spanning forest of
   the survivors; its components are clusters of classes that may be linked.
5. Inside each cluster, again block against block and between components only, survivors
   of the sequential test are verified on their full sets in the task, best ones first,
   and only the links that join components are emitted.

No bucket is capped and no link between different texts is lost except by the
MinHash itself: with 48 bands of 7, a pair at similarity 0.8 shares no band with
probability 1.2e-5, while a pair at 0.1 shares one with probability 5e-6.

Words are named by 128-bit keyed BLAKE2b digests, so no two words that occur share a name.
Classes rest on 128-bit hashes of shingles; the sets that links are verified on hold 64 of
these bits, so that a shingle of one document is taken for another one's with a
probability of about 1e-19 for each pair of shingles compared.

Edge cases: null or empty text has an empty set and is linked with nothing; a
null doc_id can't name a component, so such a row is linked with nothing, gets a
null component_id and is kept; repeated rows get equal results, and an id that
stands on several texts links them: all of its rows get the component that they share; an empty table
gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowsmith.llm._io import materialize, release, small_batches
from rowsmith.llm._words import LOWER, U, digests, mix, texts, words

BANDS, ROWS = 48, 7
PERMS = BANDS * ROWS
#: Hashes compared at once in the sequential test.
BATCH = 48
#: Chosen probability of missing a pair at the threshold, per batch.
MISS = 1e-6
#: Key of the words' names. Whoever writes the texts may not know it in a deployment that fears forged collisions.
KEY = b"rowsmith words"
#: Members of one comparison block.
BLOCK = 1024
_RNG = np.random.default_rng(20240607)
MULT = _RNG.integers(0, 1 << 63, PERMS, dtype=np.uint64) * U(2) + U(1)
ADD = _RNG.integers(0, 1 << 63, PERMS, dtype=np.uint64)


# ---------------------------------------------------------------- shingles and signatures
def shingle_hashes(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """128-bit hashes (two columns) of the k-word shingles of lower-cased texts and their rows, in text order.

    Words are named by keyed BLAKE2b, shingles by mixing the names of their words in order.
    A row with fewer than k words has its whole word sequence as one shingle."""
    low = LOWER[data]
    s, e, row = words(low, offsets)
    if not len(s):
        return np.zeros((0, 2), U), row
    h = digests(low, s, e, KEY)
    n = np.bincount(row, minlength=len(offsets) - 1)
    first = np.concatenate([[0], np.cumsum(n)[:-1]])
    place = np.arange(len(h)) - first[row]
    start = (place + k <= n[row]) | ((place == 0) & (n[row] < k))
    at = np.flatnonzero(start)
    out = np.tile(np.array([[0x5851F42D4C957F2D, 0x14057B7EF767814F]], U), (len(at), 1))
    for i in range(k):
        there = place[at] + i < n[row[at]]
        nxt = h[np.minimum(at + i, len(h) - 1)]
        out[there] = mix(out[there] * U(0x2545F4914F6CDD1D) + nxt[there])
    return out, row[at]


def row_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes (two columns), sorted in each row: hashes and offsets by row."""
    h, row = shingle_hashes(data, offsets, k)
    order = np.lexsort((h[:, 0], row))
    first = h[order, 0]
    alike = (first[1:] == first[:-1]) & (row[order][1:] == row[order][:-1])
    if (h[order, 1][1:] != h[order, 1][:-1])[alike].any():  # equal halves of different hashes
        order = np.lexsort((h[:, 1], h[:, 0], row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]).any(1) | (row[1:] != row[:-1])
    h, row = h[new], row[new]
    return h, np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(offsets) - 1))])


def signatures(h: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """MinHash signatures of the non-empty rows, one line of 16-bit minima a row."""
    sizes = np.diff(offs)
    full = np.flatnonzero(sizes)
    out = np.empty((len(full), PERMS), np.uint16)
    if len(full):
        at = offs[:-1][full]
        for p in range(PERMS):
            out[:, p] = mix(np.minimum.reduceat(h * MULT[p] + ADD[p], at)) >> U(48)
    return out


def _set_digests(h: np.ndarray, offs: np.ndarray) -> list[bytes | None]:
    return [hashlib.blake2b(h[a:b].tobytes(), digest_size=16).digest() if b > a else None for a, b in zip(offs[:-1], offs[1:], strict=True)]


def _sign(batches: Iterable[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for at, data, offsets in texts(batch.column(1)):
            h, offs = row_sets(data, offsets, k)
            size = np.diff(offs)
            sig = signatures(h[:, 0], offs)
            place = np.cumsum(size > 0) - 1
            digest = _set_digests(h, offs)
            rows = [sig[place[i]].tobytes() if size[i] else None for i in range(len(size))]
            yield pa.RecordBatch.from_arrays([ids.slice(at, len(size)), pa.array(digest, pa.binary()), pa.array(size, pa.int64()), pa.array(rows, pa.binary())], names=["doc_id", "digest", "n_shingles", "sig"])


def signed(docs: DataFrame, k: int) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(lambda it: _sign(it, k), "doc_id long, digest binary, n_shingles long, sig binary")


def _sorted_rows(h: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Signed values sorted inside each row."""
    return h[np.lexsort((h, np.repeat(np.arange(len(offs) - 1), np.diff(offs))))]


def _sets(batches: Iterable[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Of (id, text, digest of a set): id and set, where the text has just that set."""
    for batch in batches:
        for at, data, offsets in texts(batch.column(1)):
            h, offs = row_sets(data, offsets, k)
            lists = pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(_sorted_rows(h[:, 0].astype(np.int64), offs)))
            mine = [want == got for want, got in zip(batch.column(2).slice(at, len(lists)).to_pylist(), _set_digests(h, offs), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(lists)), lists], names=["id", "shingles"]).filter(pa.array(mine))


# ---------------------------------------------------------------- the sequential test
def least_matches(threshold: float, miss: float = MISS, batch: int = BATCH, total: int = PERMS) -> dict[int, int]:
    """For each number n of hashes compared so far, the fewest matches that keep a pair.

    Under a uniform prior the similarity given m of n matches is Beta(m + 1, n - m + 1),
    and P(similarity >= t) = P(Binomial(n + 1, t) <= m)."""
    out = {}
    for n in range(batch, total + 1, batch):
        below, m = 0.0, -1
        while below < miss:
            m += 1
            below += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out[n] = m
    return out


def survivors(a: np.ndarray, b: np.ndarray, ia: np.ndarray, ib: np.ndarray, need: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs (a[ia], b[ib]) of signatures those that the posterior bound keeps."""
    matches, lo = np.zeros(len(ia), np.int32), 0
    for n, m in need.items():
        matches += (a[ia, lo:n] == b[ib, lo:n]).sum(1, dtype=np.int32)
        keep = matches >= m
        ia, ib, matches, lo = ia[keep], ib[keep], matches[keep], n
        if not len(ia):
            break
    return ia, ib


def _matrix(column: pa.Array) -> np.ndarray:
    joined = b"".join(x.as_py() for x in column)
    return np.frombuffer(joined, np.uint16).reshape(len(column), PERMS)


def _screen(batches: Iterable[pa.RecordBatch], need: dict[int, int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        every = np.arange(batch.num_rows)
        keep, _ = survivors(_matrix(batch.column(2)), _matrix(batch.column(3)), every, every, need)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep)), batch.column(1).take(pa.array(keep))], names=["a", "b"])


def _groups(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows with equal first ``keys`` columns of a sorted stream."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        cut = np.zeros(batch.num_rows, bool)
        for c in cols:
            cut[1:] |= c[1:] != c[:-1]
        edges = [0, *np.flatnonzero(cut).tolist(), batch.num_rows]
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            now = tuple(c[lo] for c in cols)
            if now != last and held:
                yield pa.Table.from_batches(held)
                held = []
            last = now
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


class _Forest:
    """Union-find over the labels seen in one task."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(y, y)
            x = y
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def _block_pairs(g: pa.Table, need: dict[int, int], percent: int, step: int = 1 << 16):
    """Surviving pairs (places in the group) across components of one block pair, and the group's ids and components.

    Columns: group, bi, bj, blk, id, comp, n, sig."""
    blk, ids, comp, size = (g.column(i).combine_chunks().to_numpy(zero_copy_only=False) for i in (3, 4, 5, 6))
    sig = _matrix(g.column(7).combine_chunks())
    bi, bj = g.column(1)[0].as_py(), g.column(2)[0].as_py()
    left = np.flatnonzero(blk == bi)
    right = left if bi == bj else np.flatnonzero(blk == bj)
    lines = max(1, step // max(1, len(right)))
    for at in range(0, len(left), lines):
        l = left[at : at + lines]
        fit = comp[l][:, None] != comp[right][None, :]
        fit &= 100 * np.minimum(size[l][:, None], size[right][None, :]) >= percent * np.maximum(size[l][:, None], size[right][None, :])
        if bi == bj:
            fit &= ids[l][:, None] < ids[right][None, :]
        x, y = np.nonzero(fit)
        if len(x):
            yield (*survivors(sig, sig, l[x], right[y], need), sig)


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _candidates(batches: Iterable[pa.RecordBatch], need: dict[int, int], percent: int) -> Iterator[pa.RecordBatch]:
    """Per block pair of a band, pairs of components that survive the test: a spanning forest of them."""
    for g in _groups(batches, 3):
        comp, forest, found = g.column(5).combine_chunks().to_numpy(zero_copy_only=False), _Forest(), []
        for ia, ib, _ in _block_pairs(g, need, percent):
            both = np.unique(np.sort(np.stack([comp[ia], comp[ib]], 1), 1), axis=0)
            found += [(a, b) for a, b in both.tolist() if forest.join(a, b)]
        if found:
            yield _pairs(found)


def _confirm(batches: Iterable[pa.RecordBatch], need: dict[int, int], percent: int) -> Iterator[pa.RecordBatch]:
    """Per block pair of a cluster, verified links that join components. One more column: the shingle sets."""
    for g in _groups(batches, 3):
        ids, comp = (g.column(i).combine_chunks().to_numpy(zero_copy_only=False) for i in (4, 5))
        lists = g.column(8).combine_chunks()
        flat, cut = lists.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
        forest, found = _Forest(), []
        for ia, ib, sig in _block_pairs(g, need, percent):
            order = np.argsort(-(sig[ia] == sig[ib]).sum(1), kind="stable")
            ia, ib = ia[order], ib[order]
            for a in dict.fromkeys(ia.tolist()):
                mine, others = flat[cut[a] : cut[a + 1]], ib[ia == a]
                for at in range(0, len(others), 64):
                    top = forest.root(comp[a])
                    some = np.array([b for b in others[at : at + 64].tolist() if forest.root(comp[b]) != top], np.int64)
                    if not len(some):
                        continue
                    theirs = np.concatenate([flat[cut[b] : cut[b + 1]] for b in some])
                    sizes = cut[some + 1] - cut[some]
                    place = np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)
                    common = np.add.reduceat((mine[place] == theirs).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]]))
                    for b in some[100 * common >= percent * (len(mine) + sizes - common)].tolist():
                        if forest.join(comp[a], comp[b]):
                            found.append((min(ids[a], ids[b]), max(ids[a], ids[b])))
        if found:
            yield _pairs(found)


# ---------------------------------------------------------------- components
def components(edges: DataFrame) -> DataFrame:
    """(id, comp): the smallest id reachable over ``edges`` (a, b), by alternating large and small stars.

    Each node only ever meets the minimum of its neighbours, pre-aggregated on the
    map side, so a hub costs as many rows as it has links and is never gathered."""
    e = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    state = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = materialize(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        near = large.join(least, "u")
        small = near.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).where("u <> v").unionByName(least.select("u", F.col("m").alias("v")))
        shorter = materialize(small.distinct(), "small-star")
        release(e, large)
        e = shorter
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64(F.lit(1), "u", "v"))).first()
        if now == state or not now[0]:
            return e.select(F.col("u").alias("id"), F.col("v").alias("comp"))
        state = now


# ---------------------------------------------------------------- the operator
def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80, miss: float = MISS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Two documents are linked when 100 * |intersection| >= percent * |union| of their
    sets of ``shingle_words``-word shingles; component_id is the smallest doc_id
    reachable over links, kept is doc_id = component_id."""
    spark = docs.sparkSession
    need = least_matches(percent / 100, miss)
    rows = materialize(signed(docs, shingle_words), "signed")
    named = rows.where("doc_id is not null and digest is not null")
    classes = named.groupBy("digest").agg(F.min("doc_id").alias("least"), F.max("n_shingles").alias("n"), F.max("sig").alias("sig")).withColumn("id", F.col("least"))
    several = materialize(named.groupBy("doc_id").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi")).where("lo <> hi").select("doc_id"), "several-texts")
    same_id = None
    if several.take(1):  # ids on several texts: classes with one smallest id are numbered apart, and linked below
        apart = F.row_number().over(Window.partitionBy("id").orderBy("digest"))
        number = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64("digest"), 2)
        classes = materialize(classes.withColumn("id", F.when(apart == 1, F.col("id")).otherwise(number)), "classes")
        texts_of = named.select("doc_id", "digest").distinct().join(several, "doc_id").join(classes.select("digest", "id"), "digest")
        same_id = materialize(texts_of.withColumn("a", F.min("id").over(Window.partitionBy("doc_id"))).where("a <> id").select("a", F.col("id").alias("b")).distinct(), "same-id")
    else:
        classes = materialize(classes, "classes")

    # One row per class and band; bands shared by several classes, with their first class.
    width = 2 * ROWS
    bands = classes.select("id", F.explode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, F.substring(F.col("sig"), b * width + 1, F.lit(width))))).alias("key"))
    shared = materialize(bands.groupBy("key").agg(F.min("id").alias("first"), F.count("*").alias("members")).where("members > 1"), "shared")
    members = materialize(bands.join(shared, "key"), "members")

    def screened(pairs: DataFrame) -> DataFrame:
        side = lambda x: classes.select(F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("sig").alias(f"s{x}"))
        fit = F.expr(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
        return pairs.join(side("b"), "b").join(side("a"), "a").where(fit).select("a", "b", "sa", "sb").mapInArrow(lambda it: _screen(it, need), "a long, b long")

    def sets_of(wanted: DataFrame) -> DataFrame:
        """(id, shingles) of the wanted classes, from the text of a row that belongs to the class."""
        mine = docs.select(F.col("doc_id").alias("least"), "text").join(classes.join(wanted, "id", "left_semi").select("id", "least", "digest"), "least")
        return mine.select("id", "text", "digest").mapInArrow(lambda it: _sets(it, shingle_words), "id long, shingles array<long>").dropDuplicates(["id"])

    def block_pairs(rows: DataFrame, group: str) -> DataFrame:
        """Rows (group, blocks, id, comp) dealt into blocks and repeated for each pair of blocks, by pair."""
        each = rows.withColumn("blk", F.pmod(F.hash("id"), F.col("blocks"))).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        each = each.select(F.col(group).alias("grp"), F.least("blk", "other").alias("bi"), F.greatest("blk", "other").alias("bj"), "blk", "id", "comp")
        return each.join(classes.select("id", "n", "sig"), "id").select("grp", "bi", "bj", "blk", "id", "comp", "n", "sig")

    by_pair = ["grp", "bi", "bj"]
    stars = members.where("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
    pairs = materialize(screened(stars), "survivors")
    # Texts move once, for all classes that a later step may have to verify.
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).unionByName(members.where("members > 2").select("id")).distinct()
    sets = materialize(sets_of(wanted), "sets")
    side = lambda x: sets.select(F.col("id").alias(x), F.col("shingles").alias(f"s{x}"))
    common = F.size(F.array_intersect("sa", "sb"))
    both = pairs.join(side("b"), "b").join(side("a"), "a").withColumn("c", common)
    links = materialize(both.where(F.expr(f"100 * c >= {percent} * (size(sa) + size(sb) - c)")).select("a", "b"), "links")
    if same_id is not None:
        links = links.unionByName(same_id)
    comps = components(links)

    # Bands that still hold several components, and clusters of components whose members may be linked.
    placed = members.where("members > 2").join(comps, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    mixed = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("rest")).where("lo <> hi")
    mixed = materialize(mixed.select("key", F.ceil(F.col("rest") / BLOCK).cast("int").alias("blocks")), "mixed")
    if mixed.take(1):
        there = materialize(placed.join(mixed, "key").select("key", "blocks", "id", "comp"), "mixed-members")
        tasks = block_pairs(there, "key").repartition(*by_pair).sortWithinPartitions(*by_pair, "blk", "id")
        clusters = components(tasks.mapInArrow(lambda it: _candidates(it, need, percent), "a long, b long").distinct())
        near = there.select("id", "comp").distinct().join(clusters.select(F.col("id").alias("comp"), F.col("comp").alias("cluster")), "comp")
        near = materialize(near, "near")
        blocks = near.groupBy("cluster").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
        rows_ = block_pairs(near.join(blocks, "cluster"), "cluster").join(sets, "id")
        tasks = rows_.select(*by_pair, "blk", "id", "comp", "n", "sig", "shingles").repartition(*by_pair).sortWithinPartitions(*by_pair, "blk", "id")
        more = materialize(tasks.mapInArrow(lambda it: _confirm(it, need, percent), "a long, b long").distinct(), "links")
        if more.take(1):
            comps = components(links.unionByName(more))

    label = classes.select("digest", "id").join(comps, "id", "left").select("digest", F.coalesce("comp", "id").alias("component"))
    named = rows.select("doc_id", "digest", "n_shingles").join(label, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return named.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id", "n_shingles", "component_id", "kept")


def drop_near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose document is kept; all columns stay."""
    gone = near_duplicates(docs, shingle_words, percent).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
