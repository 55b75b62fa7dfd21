"""CSV records of one file, read in parallel, with their numbers.

A file is read as lines in byte ranges. Whether a line begins a record or lies inside a
quoted cell depends on everything before it, so each range is first looked at under both
assumptions: how many records begin in it, and whether it ends inside a quoted cell.
These few numbers a range are strung together on the driver, in the ranges' order; then
every range knows how it begins and the number of its first record, and is parsed for
itself. Of a record that goes on over the end of a range each range gives its piece, and
the pieces are put together by the record's number.

Records, cells and line ends are those of Python's ``csv`` reader on a file opened with
newline="": quotes count only at a cell's beginning, doubled quotes are one, a blank line is a
record without cells and has a number, \\r, \\n and \\r\\n end a line, a cell that is never
closed ends with the file. A byte order mark before the first record is dropped. A folder of
several files is read as the files in the order of their names, each for itself.
"""

from __future__ import annotations

import csv
import re
import sys
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsmith.plans.tables import written

_ROW = "src_pos long, cells array<string>, place long, piece string"
_ARROW = pa.schema([("src_pos", pa.int64()), ("cells", pa.list_(pa.string())), ("place", pa.int64()), ("piece", pa.string())])
#: Records of one Arrow batch that a task gives.
TOGETHER = 4096
#: Behind a carriage return that something follows.
_AFTER_RETURN = re.compile("(?<=\r)(?=.)", re.S)


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted cell is open after the line, if one is (``inside``) or none is before it."""
    if '"' not in line:
        return inside
    at = 0
    while True:
        if inside or line.startswith('"', at):
            close = line.find('"', at if inside else at + 1)
            while close >= 0 and line.startswith('"', close + 1):
                close = line.find('"', close + 2)
            if close < 0:
                return True
            at, inside = close + 1, False
        at = line.find(",", at) + 1
        if not at:
            return False


def pieces(line: str) -> list[str]:
    """A line that was ended by a line feed as the lines that carriage returns make of it."""
    return _AFTER_RETURN.split(line) if "\r" in line[:-1] else [line]


def _ranges(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int] | None, str]]:
    """(range, line) of batches of (file, start, value)."""
    for batch in batches:
        files, starts, values = (batch.column(i).to_pylist() for i in range(3))
        for f, s, v in zip(files, starts, values, strict=True):
            yield (f, s), v or ""


def _summary(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range: for both ways it may begin, the records that begin in it and whether it ends inside a cell."""
    seen: dict[tuple[str, int], list] = {}
    for key, line in _ranges(batches):
        now = seen.setdefault(key, [[0, False], [0, True]])
        for part in pieces(line):
            for way in now:
                way[0] += not way[1]
                way[1] = ends_inside(part, way[1])
    rows = [(f, s, a[0], a[1], b[0], b[1]) for (f, s), (a, b) in seen.items()]
    names = ["file", "start", "n0", "open0", "n1", "open1"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_()]
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)


def begins(summaries: list) -> dict[tuple[str, int], tuple[int, bool, int, bool]]:
    """For each range (file, start) its place, whether it begins inside a cell, the number of the first record that
    begins in it, and whether its file goes on after it."""
    out, first, inside = {}, 1, False
    rows = sorted(summaries, key=lambda r: (r["file"], r["start"]))
    for place, r in enumerate(rows):
        fresh = not place or rows[place - 1]["file"] != r["file"]
        inside = inside and not fresh
        goes_on = place + 1 < len(rows) and rows[place + 1]["file"] == r["file"]
        out[r["file"], r["start"]] = (place, inside, first, goes_on)
        first += r["n1"] if inside else r["n0"]
        inside = r["open1"] if inside else r["open0"]
    return out


def _cells(texts: list[str]) -> list[list[str]]:
    """The cells of whole records."""
    csv.field_size_limit(sys.maxsize)
    return list(csv.reader(texts))


def _parsed(known: dict):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: list[int] = []
        texts: list[str] = []
        loose: list[tuple[int, int, str]] = []

        def flush() -> pa.RecordBatch:
            rows = [(n, c, None, None) for n, c in zip(numbers, _cells(texts), strict=True)] + [(n, None, p, t) for n, p, t in loose]
            for held in (numbers, texts, loose):
                held.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_ARROW)], schema=_ARROW)

        at, place, number, inside, goes_on, head = None, 0, 0, False, False, False
        held: list[str] = []

        def close() -> None:
            """What is left at a range's end: a piece of a record that goes on, or the last record of its file."""
            if held:
                text = "".join(held) if goes_on else "".join(held).removesuffix("\n")
                held.clear()
                if goes_on or head:
                    loose.append((number - 1, place, text))
                else:
                    numbers.append(number - 1)
                    texts.append(text)

        for key, line in _ranges(batches):
            if key != at:
                close()
                at = key
                place, inside, number, goes_on = known[key]
                head = inside
                if key[1] == 0 and not inside:
                    line = line.removeprefix("﻿")
            parts = pieces(line)
            for i, part in enumerate(parts):
                number += not inside
                inside = ends_inside(part, inside)
                held.append(part if not inside and i + 1 == len(parts) else part + "\n" if i + 1 == len(parts) else part)
                if not inside:
                    text = "".join(held).removesuffix("\r")
                    held.clear()
                    if head:
                        loose.append((number - 1, place, text))
                        head = False
                    else:
                        numbers.append(number - 1)
                        texts.append(text)
            if len(numbers) + len(loose) >= TOGETHER:
                yield flush()
        close()
        if numbers or loose:
            yield flush()

    return run


def _joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records put together from their pieces."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_cells(batch.column(1).to_pylist()), pa.list_(pa.string()))], names=["src_pos", "cells"])


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(src_pos, cells): all records of a CSV file, blank lines included, the first one being 1."""
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    known = begins(lines.mapInArrow(_summary, "file string, start long, n0 long, open0 boolean, n1 long, open1 boolean").collect())  # a row a range
    rows = written(lines.mapInArrow(_parsed(known), _ROW), "records")
    whole = rows.where("place is null").select("src_pos", "cells")
    if not any(inside for _, inside, _, _ in known.values()):
        return whole
    parts = rows.where("place is not null").groupBy("src_pos").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "piece"))), lambda x: x["piece"]), "").alias("text"))
    return whole.unionByName(parts.mapInArrow(_joined, "src_pos long, cells array<string>"))
