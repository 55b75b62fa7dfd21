"""xlsx sheets from and to their zipped XML, without a spreadsheet library.

Files are read through Spark's file reader, so they may lie in any store it knows, and parsed in tasks: a folder of
workbooks by as many as there are workbooks, each sheet as a stream of rows."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterable, Iterator
from xml.etree import ElementTree as X
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from rowsmith.plans.tables import written

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships", "p": "http://schemas.openxmlformats.org/package/2006/relationships"}


#: Rows of one Arrow batch that a task gives.
TOGETHER = 2048


def column_number(letters: str) -> int:
    n = 0
    for ch in letters:
        n = 26 * n + ord(ch) - 64
    return n


def column_letters(n: int) -> str:
    out = ""
    while n:
        n, r = divmod(n - 1, 26)
        out = chr(65 + r) + out
    return out


def _tag(name: str) -> str:
    return f"{{{_NS['m']}}}{name}"


def _targets(z: zipfile.ZipFile) -> dict[str, str]:
    """Places of the sheets within the file, by name, in the workbook's order."""
    rels = {r.get("Id"): r.get("Target") for r in X.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
    found = {s.get("name"): rels[s.get(f"{{{_NS['r']}}}id")] for s in X.fromstring(z.read("xl/workbook.xml")).find("m:sheets", _NS)}
    return {name: t.lstrip("/") if t.startswith("/") else f"xl/{t}" for name, t in found.items()}


def _elements(z: zipfile.ZipFile, place: str, tag: str) -> Iterator[X.Element]:
    """The elements of one kind, one at a time; each is let go when the next is asked for."""
    with z.open(place) as stream:
        parents: list[X.Element] = []
        for event, e in X.iterparse(stream, ("start", "end")):
            if event == "start":
                parents.append(e)
                continue
            parents.pop()
            if e.tag == tag:
                yield e
                if parents:
                    parents[-1].clear()


def _rows(z: zipfile.ZipFile, place: str, shared: list[str]) -> Iterator[tuple[int, list[str]]]:
    """(position, values as text) of a sheet's rows; blank cells are empty, rows that the file leaves out have no cells."""
    last = 0
    for row in _elements(z, place, _tag("row")):
        at = int(row.get("r") or last + 1)
        for missing in range(last + 1, at):
            yield missing, []
        cells: list[str] = []
        for c in row.findall("m:c", _NS):
            ref = re.match(r"[A-Z]+", c.get("r") or "")
            col = column_number(ref[0]) if ref else len(cells) + 1
            value, kind = c.find("m:v", _NS), c.get("t")
            if kind == "inlineStr":
                text = "".join(t.text or "" for t in c.iter(_tag("t")))
            elif value is None:
                text = ""
            else:
                text = shared[int(value.text)] if kind == "s" else ("True" if value.text == "1" else "False") if kind == "b" else value.text or ""
            cells += [""] * (col - len(cells))
            cells[col - 1] = text
        yield at, cells
        last = at


def workbook_rows(data: bytes, sheets: list[str] | None = None) -> Iterator[tuple[str, int, list[str]]]:
    """(sheet, position, values) of the named sheets that a workbook has, or of all. Sheets are read as streams: what is held
    is the zipped file, its shared strings and one row."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        targets = _targets(z)
        shared = ["".join(t.text or "" for t in si.iter(_tag("t"))) for si in _elements(z, "xl/sharedStrings.xml", _tag("si"))] if "xl/sharedStrings.xml" in z.namelist() else []
        for name in [n for n in targets if sheets is None or n in sheets]:
            for at, cells in _rows(z, targets[name], shared):
                yield name, at, cells


def sheet_rows(data: bytes, sheet: str | None = None) -> list[list[str]] | None:
    """The sheet's values as text, blank cells empty; None if there is no such sheet."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = list(_targets(z))
    if sheet is not None and sheet not in names:
        return None
    return [cells for _, _, cells in workbook_rows(data, [sheet or names[0]])]


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path).select("path", "content")


def read_workbooks(spark: SparkSession, path: str, sheets: list[str] | None = None) -> DataFrame:
    """(path, sheet, src_pos, cells) of the named sheets (or all) of the workbooks at ``path``: a file, a folder or a pattern.
    Tasks take one workbook at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["path", "sheet", "src_pos", "cells"]
        kinds = [pa.string(), pa.string(), pa.int64(), pa.list_(pa.string())]

        def batch_of(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

        for batch in batches:
            for place, data in zip(batch.column(0), batch.column(1), strict=True):
                held = []
                for row in workbook_rows(data.as_py(), sheets):
                    held.append((place.as_py(), *row))
                    if len(held) == TOGETHER:
                        yield batch_of(held)
                        held = []
                if held:
                    yield batch_of(held)

    return _files(spark, path).mapInArrow(run, "path string, sheet string, src_pos long, cells array<string>")


def sheet_names(spark: SparkSession, path: str) -> DataFrame:
    """(path, place, sheet): the sheets of the workbooks at ``path``, in the workbooks' order."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for place, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                with zipfile.ZipFile(io.BytesIO(data.as_py())) as z:
                    rows += [(place, i, name) for i, name in enumerate(_targets(z))]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.string(), pa.int32(), pa.string()))], names=["path", "place", "sheet"])

    return _files(spark, path).mapInArrow(run, "path string, place int, sheet string")


def read_xlsx(spark: SparkSession, path: str, sheet: str | None = None, missing_ok: bool = False) -> DataFrame:
    """(src_pos, cells) of one sheet of one workbook, the first one if none is named."""
    names = [r["sheet"] for r in sheet_names(spark, path).orderBy("path", "place").collect()]  # as many as the workbook has tabs
    if not names or sheet is not None and sheet not in names:
        if not missing_ok:
            raise ValueError(f"no sheet {sheet!r} in {path}")
        return spark.createDataFrame([], "src_pos long, cells array<string>")
    return written(read_workbooks(spark, path, [sheet or names[0]]).select("src_pos", "cells"), "sheet")


def workbook(sheets: dict[str, dict]) -> bytes:
    """An xlsx file of named sheets: {"rows": [[...]], "lists": {range: formula}, "fills": set of header rows, "hidden": bool}."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        n = len(sheets)
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(1, n + 1))
        z.writestr("[Content_Types].xml", '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>' + kinds + "</Types>")
        z.writestr("_rels/.rels", f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{_NS["p"]}"><Relationship Id="rId1" Type="{_NS["r"]}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        entries = "".join(f'<sheet name="{escape(name)}" sheetId="{i}" r:id="rId{i}"' + (' state="hidden"' if s.get("hidden") else "") + "/>" for i, (name, s) in enumerate(sheets.items(), 1))
        z.writestr("xl/workbook.xml", f'<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="{_NS["m"]}" xmlns:r="{_NS["r"]}"><sheets>{entries}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="{_NS["p"]}">' + "".join(f'<Relationship Id="rId{i}" Type="{_NS["r"]}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, n + 1)) + "</Relationships>")
        for i, s in enumerate(sheets.values(), 1):
            body = []
            for r, row in enumerate(s["rows"], 1):
                cells = "".join(f'<c r="{column_letters(c)}{r}" t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>' for c, v in enumerate(row, 1) if v not in ("", None))
                if cells:
                    body.append(f'<row r="{r}">{cells}</row>')
            lists = "".join(f'<dataValidation type="list" allowBlank="1" sqref="{where}"><formula1>{escape(formula)}</formula1></dataValidation>' for where, formula in s.get("lists", {}).items())
            lists = f'<dataValidations count="{len(s.get("lists", {}))}">{lists}</dataValidations>' if lists else ""
            z.writestr(f"xl/worksheets/sheet{i}.xml", f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{_NS["m"]}"><sheetData>{"".join(body)}</sheetData>{lists}</worksheet>')
    return out.getvalue()
