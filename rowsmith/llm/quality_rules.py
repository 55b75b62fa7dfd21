"""Quality rules: robust multivariate outliers per language and source.

One pass over the texts counts what the rules need. Documents that fail a base rule go.
The others' counts become a vector of transformed statistics, and a minimum covariance
determinant estimate of the vectors' center and scatter is made for each language and
source; a document whose Mahalanobis distance from its group's estimate is too large
goes, too.

The estimate of a group is deterministic: three starts (the coordinates' medians with
their own scales, and with correlations of tanh-squashed coordinates and of spatial
signs), concentration steps from each (keep the ``SUPPORT`` share of rows with the smallest
distances, ties included, take their mean and covariance), the start with the smallest determinant on to
convergence, and a reweighted estimate over all rows within the ``INNER`` quantile. The
estimate of a source within a language leans on that of the language, made in the same way from all of its rows,
as if ``PRIOR`` more rows had been drawn there; this holds at every size, and decides only
where a source has few rows. A floor on each variance keeps constant statistics
from making the scatter singular. Statistics are whole numbers on a fine grid,
so all sums are exact and reruns agree whatever the order of rows.

Each step is two grouped aggregations over all rows with map-side partial sums, so a hot
source is only more rows, never a larger task. Equal words and lines are told by their bytes.

Edge cases: null and empty texts have no words and fail the base rules; null languages
and sources are groups of their own; repeated rows count as often as they stand there;
an empty table gives an empty result; other columns are ignored or passed through.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowsmith.llm._io import materialize, release, release_into, small_batches
from rowsmith.llm._words import classes, texts, words

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Rows that the estimate of a language's source takes from the distribution of the language.
PRIOR = 60
#: Share of a group's rows that the concentrated estimate rests on, at least.
SUPPORT = 0.75
#: Quantile of the chi-squared distribution within which rows count for the reweighted estimate.
INNER = 0.975
#: Concentration steps, at most; determinants fall with each one and stay after a few.
STEPS = 30
#: Squared distances are told apart by steps of this many an octave where the nearest rows are taken; rows on one step are ties.
STEPS_AN_OCTAVE = 64
#: Statistics are held in whole steps of 1/GRID, so that sums are exact and don't depend on the order of
#: rows (up to 2**36 rows a group).
GRID = 1024
#: Squared distance beyond which a document goes. Far in the tail of the chi-squared
#: distribution with as many degrees as there are statistics (p < 1e-9), so that
#: ordinary documents stay whatever the true law of a statistic is.
CUTOFF = 60.0
#: Transformed statistics and the least standard deviation each is given.
FLOORS = {"word_length": 0.10, "symbols": 0.35, "repeats": 0.08, "capitals": 0.06, "punctuation": 0.08, "dup_lines": 0.10, "variety": 0.10, "bare": 0.04}
_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_punct", "n_lines", "n_distinct", "n_bare"]

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_IS_UPPER = np.zeros(256, bool)
_IS_UPPER[65:91] = True
_IS_SIGN = np.zeros(256, bool)
_IS_SIGN[33:128] = True
_IS_SIGN[48:58] = _IS_SIGN[65:91] = _IS_SIGN[97:123] = False
_IS_PUNCT = np.zeros(256, bool)
_IS_PUNCT[list(b"!?;:()[]{}\"=_/\\~^+@")] = True


def _seen_before(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether an equal key stands earlier in the same row; whether one stands anywhere else in it."""
    order = np.lexsort((keys, rows))
    k, r = keys[order], rows[order]
    same = np.zeros(len(k), bool)
    same[1:] = (k[1:] == k[:-1]) & (r[1:] == r[:-1])
    earlier, again = np.zeros(len(k), bool), np.zeros(len(k), bool)
    earlier[order] = same  # the sort is stable: the first of equals stands first
    both = same.copy()
    both[:-1] |= same[1:]
    again[order] = both
    return earlier, again


def count_texts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of each text of a run of texts."""
    n = len(offsets) - 1
    by_row = lambda rows: np.bincount(rows, minlength=n)
    starts, ends, row = words(data, offsets)
    word = classes(data, starts, ends)
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    lengths = points[ends] - points[starts]

    triple = np.flatnonzero(row[2:] == row[:-2]) if len(row) > 2 else np.zeros(0, np.int64)
    pair = word[triple] * (len(word) + 1) + word[triple + 1]
    if len(word) >= 1 << 21:  # three numbers no longer fit one
        _, pair = np.unique(pair, return_inverse=True)
    _, again = _seen_before(pair * (len(word) + 1) + word[triple + 2], row[triple])
    covered = np.zeros(len(word), bool)
    for k in range(3):
        covered[triple[again] + k] = True
    earlier_word, _ = _seen_before(word, row)
    signs = np.concatenate([[0], np.cumsum(_IS_SIGN[data])])
    bare = signs[ends] - signs[starts] == ends - starts

    # Lines: pieces between newlines and row ends that have a word. One newline cut off a line is enough to tell it.
    newline = np.flatnonzero(data == 10)
    line_start = np.unique(np.concatenate([offsets[:-1][np.diff(offsets) > 0], newline + 1]))
    line_start = line_start[line_start < len(data)] if len(data) else line_start[:0]
    line_row = np.searchsorted(offsets, line_start, "right") - 1
    nxt = np.minimum(np.append(line_start[1:], len(data)), offsets[line_row + 1])
    line_end = np.where((nxt > line_start) & (data[np.maximum(nxt - 1, 0)] == 10), nxt - 1, nxt) if len(line_start) else nxt
    has_word = np.searchsorted(starts, line_end, "left") > np.searchsorted(starts, line_start, "left")
    line_start, line_end, line_row = line_start[has_word], line_end[has_word], line_row[has_word]
    earlier_line, _ = _seen_before(classes(data, line_start, line_end), line_row)

    def of_bytes(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return total[offsets[1:]] - total[offsets[:-1]]

    return {
        "n_words": by_row(row), "word_chars": np.bincount(row, lengths, n).astype(np.int64), "n_symbols": of_bytes(_IS_SYMBOL[data]),
        "n_dup_lines": by_row(line_row[earlier_line]), "n_repeat_words": by_row(row[covered]), "n_upper": of_bytes(_IS_UPPER[data]),
        "n_punct": of_bytes(_IS_PUNCT[data]), "n_lines": by_row(line_row), "n_distinct": by_row(row[~earlier_word]), "n_bare": by_row(row[bare]),
    }


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, data, offsets in texts(batch.column(1)):
            c = count_texts(data, offsets)
            k = len(offsets) - 1
            yield pa.RecordBatch.from_arrays([*[batch.column(i).slice(at, k) for i in (0, 2, 3)], *[pa.array(c[x], pa.int64()) for x in _COUNTS]], names=["doc_id", "lang", "source", *_COUNTS])


def counted(docs: DataFrame, ident: str = "doc_id") -> DataFrame:
    """doc_id (or another column of any type), lang, source and the counts of each row."""
    small_batches(docs.sparkSession)
    kind = docs.schema[ident].dataType.simpleString()
    schema = ", ".join([f"doc_id {kind}", "lang string", "source string", *[f"{c} long" for c in _COUNTS]])
    return docs.select(ident, "text", "lang", "source").mapInArrow(_count, schema)


def transformed() -> dict[str, Column]:
    """The vector of statistics: logarithms and arcsine roots of shares, near-normal for ordinary text."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    root = lambda x: F.asin(F.sqrt(F.least(F.lit(1.0), F.greatest(F.lit(0.0), x))))
    letters = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    return {
        "word_length": F.log(F.col("word_chars") / n + 0.01),
        "symbols": F.log((F.col("n_symbols") + 1.0) / (n + 50.0)),
        "repeats": root(F.col("n_repeat_words") / n),
        "capitals": root(F.col("n_upper") / letters),
        "punctuation": root(F.col("n_punct") / letters),
        "dup_lines": root(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
        # Distinct words against what a text of this length has: type-token ratio on a Herdan scale.
        "variety": F.log(F.greatest(F.col("n_distinct"), F.lit(1)).cast("double")) / F.log(n + 1.0),
        # Words of signs only.
        "bare": root(F.col("n_bare") / n),
    }


# ---------------------------------------------------------------- minimum covariance determinant
_V = list(FLOORS)
_P = len(_V)
_PAIRS = [(i, j) for i in range(_P) for j in range(i, _P)]
_FLOOR = np.diag(np.square(list(FLOORS.values())))


def chi_squared(x: float, p: int) -> float:
    """Distribution function of the chi-squared law with an even number ``p`` of degrees."""
    term, total = 1.0, 1.0
    for k in range(1, p // 2):
        term *= x / (2 * k)
        total += term
    return 1.0 - math.exp(-x / 2) * total


def quantile(share: float, p: int = _P) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(100):
        lo, hi = ((lo + hi) / 2, hi) if chi_squared((lo + hi) / 2, p) < share else (lo, (lo + hi) / 2)
    return lo


def consistency(share: float, p: int = _P) -> float:
    """By how much the covariance of the ``share`` nearest of a normal sample is too small."""
    return share / chi_squared(quantile(share, p), p + 2)


def _unpacked(packed: list[float]) -> np.ndarray:
    full = np.empty((_P, _P))
    for k, (i, j) in enumerate(_PAIRS):
        full[i, j] = full[j, i] = packed[k]
    return full


def _packed(full: np.ndarray) -> list[float]:
    return [float(full[i, j]) for i, j in _PAIRS]


def pooled(n: float, mean: np.ndarray, cov: np.ndarray, factor: float, over: tuple[np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray]:
    """Center and scatter of ``n`` rows together with PRIOR rows distributed as the group above."""
    if over is None:
        return mean, cov * factor
    m, s = over
    center = (n * mean + PRIOR * m) / (n + PRIOR)
    a, b = mean - center, m - center
    within = (n * (cov + np.outer(a, a)) + PRIOR * (s / factor + np.outer(b, b))) / (n + PRIOR)
    return center, within * factor


def solved(center: np.ndarray, scatter: np.ndarray) -> tuple[list[float], list[float], float]:
    """Center, packed inverse and logarithm of the determinant of the floored scatter."""
    floored = scatter + _FLOOR
    return center.tolist(), _packed(np.linalg.inv(floored)), float(np.linalg.slogdet(floored)[1])


_ESTIMATE = "g string, s int, c array<double>, w array<double>, scatter array<double>, det double, fell boolean"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int32(), *[pa.list_(pa.float64())] * 3, pa.float64(), pa.bool_()]
    columns = zip(*rows, strict=True) if rows else [[]] * 7
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=["g", "s", "c", "w", "scatter", "det", "fell"])


def _moments(row: dict, unit: float, sums: str = "s", products: str = "p") -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance from whole sums; the numbers are exact up to here, so the order of rows doesn't matter."""
    n = row["n"]
    mean = np.array([row[f"{sums}{i}"] for i in range(_P)], float) / n
    second = _unpacked([row[f"{products}{i}_{j}"] / n for i, j in _PAIRS])
    return mean / unit, (second - np.outer(mean, mean)) / unit**2


def _over(row: dict) -> tuple[np.ndarray, np.ndarray] | None:
    return None if row["oc"] is None else (np.array(row["oc"]), _unpacked(row["os"]))


def _solve(batches: Iterable[pa.RecordBatch], factor: float, keep: bool) -> Iterator[pa.RecordBatch]:
    """Sums of groups' subsets to estimates; if ``keep``, a group's estimate so far stays unless the determinant falls."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            over = _over(row)
            # A small group can lie wholly apart from where its estimate leans; without rows of its own it is judged by the group above.
            center, scatter = pooled(row["n"], *_moments(row, GRID), factor, over) if row["n"] else over
            c, w, det = solved(center, scatter)
            if keep and not det < row["det"] - 1e-9:  # a step that takes in more ties can raise it
                out.append((row["g"], row["s"], row["c"], row["w"], row["scatter"], row["det"], False))
            else:
                out.append((row["g"], row["s"], c, w, _packed(scatter), det, True))
        yield _batch(out)


def first_scatters(scale: np.ndarray, squashed: np.ndarray, signs: np.ndarray) -> list[np.ndarray]:
    """Three scatters to start from: the coordinates' own scales, the same with the correlations of
    squashed (tanh) coordinates, and with those of spatial signs."""
    out = [np.diag(scale**2)]
    for second in (squashed, signs):
        d = np.sqrt(np.maximum(np.diag(second), 1e-9))
        out.append(second / np.outer(d, d) * np.outer(scale, scale))
    return out


def _first(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            middle, scale = np.array(row["middle"]), np.array(row["scale"])
            second = [_unpacked([row[f"{k}{i}_{j}"] / row["n"] / GRID**2 for i, j in _PAIRS]) for k in ("t", "u")]
            for s, scatter in enumerate(first_scatters(scale, *second)):
                c, w, det = solved(middle, scatter)
                out.append((row["g"], s, c, w, _packed(scatter), det, True))
        yield _batch(out)


def _distance() -> Column:
    """Squared Mahalanobis distance of columns _V (on the grid) from the center ``c`` under the inverse scatter ``w``."""
    off = [F.col(v) / GRID - F.col("c")[i] for i, v in enumerate(_V)]
    parts = [off[i] * off[j] * F.col("w")[k] * (1 if i == j else 2) for k, (i, j) in enumerate(_PAIRS)]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total


def _sums(values: list[Column], sums: str = "s", products: str = "p") -> list[Column]:
    return [F.sum(v).alias(f"{sums}{i}") for i, v in enumerate(values)] + [F.sum(values[i] * values[j]).alias(f"{products}{i}_{j}") for i, j in _PAIRS]


def _starts(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """Three first estimates of each group. cells: (g, i, v, n), how often a statistic has a value in a group."""
    upto = Window.partitionBy("g", "i").orderBy("v")
    ranked = cells.withColumn("upto", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(Window.partitionBy("g", "i")))
    q = lambda share: F.min(F.when(F.col("upto") >= F.ceil(F.col("all") * share), F.col("v")))
    middles = ranked.groupBy("g", "i").agg((q(0.5) / GRID).alias("m"), ((q(0.75) - q(0.25)) / GRID / 1.349).alias("w"))
    floor = F.element_at(F.array(*[F.lit(x) for x in FLOORS.values()]), F.col("i") + 1)
    each = F.sort_array(F.collect_list(F.struct("i", "m", F.greatest("w", floor).alias("w"))))  # one entry per statistic
    middles = middles.groupBy("g").agg(each.alias("e")).select("g", F.col("e.m").alias("middle"), F.col("e.w").alias("scale"))
    z = [(F.col(v) / GRID - F.col("middle")[i]) / F.col("scale")[i] for i, v in enumerate(_V)]
    rows = rows.join(middles, "g").select("g", "middle", "scale", *[x.alias(f"z{i}") for i, x in enumerate(z)])
    norm = F.sqrt(sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(1, _P)), F.col("z0") * F.col("z0")))
    whole = lambda x: F.round(x * GRID).cast("long")
    rows = rows.withColumn("norm", F.greatest(norm, F.lit(1e-9)))
    rows = rows.select("g", "middle", "scale", *[whole(F.tanh(f"z{i}")).alias(f"a{i}") for i in range(_P)], *[whole(F.col(f"z{i}") / F.col("norm")).alias(f"b{i}") for i in range(_P)])
    sums = [F.sum(F.col(f"{c}{i}") * F.col(f"{c}{j}")).alias(f"{k}{i}_{j}") for c, k in (("a", "t"), ("b", "u")) for i, j in _PAIRS]
    totals = rows.groupBy("g").agg(F.count("*").alias("n"), F.first("middle").alias("middle"), F.first("scale").alias("scale"), *sums)
    return materialize(totals.mapInArrow(_first, _ESTIMATE), "mcd-start")


def estimates(rows: DataFrame, cells: DataFrame, over: DataFrame | None = None) -> DataFrame:
    """Robust center and scatter (g, c, w, scatter) of each group ``g`` of ``rows`` (g, up, the statistics on the grid).

    From each of three starts, concentration steps; the start with the smallest determinant
    after two steps goes on until its determinant stays; last, the reweighted estimate over
    all rows within the inner quantile. ``over`` holds the estimates of the groups above."""
    empty = F.lit(None).cast("array<double>")
    above = lambda t: t.withColumns({"oc": empty, "os": empty}) if over is None else t.join(over.select(F.col("g").alias("up"), F.col("c").alias("oc"), F.col("scatter").alias("os")), "up", "left")

    def solve(near: DataFrame, so_far: DataFrame, factor: float, keep: bool, name: str) -> DataFrame:
        """The estimates that follow from the rows marked ``near``."""
        totals = near.groupBy("g", "s", "up").agg(F.count_if("near").alias("n"), *_sums([F.when(F.col("near"), F.col(v)) for v in _V]))
        return materialize(above(totals).join(so_far.drop("fell"), ["g", "s"]).mapInArrow(lambda it: _solve(it, factor, keep), _ESTIMATE), name)

    est = _starts(rows, cells)
    inner = quantile(INNER)
    for step in range(STEPS):
        near = rows.join(est.select("g", "s", "c", "w"), "g").withColumn("step", F.floor(F.log2(_distance() + 2.0**-10) * STEPS_AN_OCTAVE)).drop("c", "w")
        steps = near.groupBy("g", "s", "step").agg(F.count("*").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("g", "s").orderBy("step"))
        steps = steps.withColumn("upto", upto).withColumn("all", F.sum("n").over(Window.partitionBy("g", "s")))
        limit = steps.where(F.col("upto") >= F.ceil(F.col("all") * SUPPORT)).groupBy("g", "s").agg(F.min("step").alias("limit"))
        new = solve(near.join(limit, ["g", "s"]).withColumn("near", F.col("step") <= F.col("limit")), est, consistency(SUPPORT), step > 0, "mcd")
        if step == 1:
            best = F.row_number().over(Window.partitionBy("g").orderBy("det", "s"))
            new = release_into(new, new.withColumn("best", best).where("best = 1").drop("best"), "mcd-best")
        release(est)
        est = new
        if step > 1 and not est.where("fell").take(1):
            break
    near = rows.join(est.select("g", "s", "c", "w"), "g").withColumn("near", _distance() <= inner).drop("c", "w")
    out = solve(near, est, consistency(INNER), False, "mcd-reweighted")
    release(est)
    return out


def judge(docs: DataFrame, ident: str = "doc_id") -> DataFrame:
    """Per row of ``docs`` (doc_id, or another column that stands for it, text, lang, source): doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, distance (squared; null where the base rules decide)."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    on_grid = {v: F.round(x * GRID).cast("long") for v, x in transformed().items()}
    rows = counted(docs, ident).withColumn("base_failed", failed).withColumns(on_grid)
    lang = F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-"))
    own = F.concat_ws("\u0001", "l", F.coalesce(F.concat(F.lit("="), "source"), F.lit("-")))
    rows = materialize(rows.withColumn("l", lang).withColumn("o", own), "counts")
    ordinary = rows.where("not base_failed")

    # Each statistic's values and how often they occur, once for both levels.
    values = F.posexplode(F.array(*_V)).alias("i", "v")
    cells = materialize(ordinary.select("o", "l", values).groupBy("o", "l", "i", "v").agg(F.count("*").alias("n")), "cells")
    est = None
    for key, up in (("l", F.lit("")), ("o", F.col("l"))):
        level = cells.groupBy(F.col(key).alias("g"), "i", "v").agg(F.sum("n").alias("n"))
        new = estimates(ordinary.select(F.col(key).alias("g"), up.alias("up"), *_V), level, est)
        release(est)
        est = new
    judged = ordinary.join(est.select(F.col("g").alias("o"), "c", "w"), "o").withColumn("distance", _distance())
    out = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    good = judged.select(*out, (F.col("distance") <= CUTOFF).alias("kept"), "distance")
    bad = rows.where("base_failed").select(*out, F.lit(False).alias("kept"), F.lit(None).cast("double").alias("distance"))
    return good.unionByName(bad)


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep. A row is known by its text, language and source, on which alone its
    verdict depends, so rows without an id or with one id are told apart."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), F.md5(F.col(c).cast("string"))), F.lit("-"))
    named = docs.select(F.struct("*").alias("_row"), F.md5(F.concat_ws(",", part("text"), part("lang"), part("source"))).alias("_key"))
    rows = named.select("_key", *[F.col(f"_row.{c}").alias(c) for c in ("text", "lang", "source")])
    gone = materialize(judge(rows, "_key").where("not kept").select(F.col("doc_id").alias("_key")).distinct(), "rejected")
    return named.join(gone, "_key", "left_anti").select("_row.*")
