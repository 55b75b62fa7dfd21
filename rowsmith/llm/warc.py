"""WARC archives: segmented writing, reassembly, chunked transfer framing, digests, revisits.

Writing turns (page_id, url, payload) into archive files below a folder. The
payload of the smallest page_id among equal payloads is stored as a response;
the others become revisit records that name it. A payload is framed as a chunked
transfer; a framed block longer than the segment size is cut into a first record
and continuation records that name the first one's id and carry segment numbers,
the last one the total length.

Reading scans the archives by Content-Length, groups the segments of a record by
origin identifier (only records that are segmented are grouped, a group is one
payload), orders them by segment number, checks that none is missing and that the
total length is right, and decodes the chunked framing.

Edge cases: a null payload is empty (an empty block, still a response or revisit); a
null page_id is written without the field and read back as null, and ranks last among
equal payloads; of repeated rows with the smallest page_id exactly one is the
response; empty tables give empty archives; extra columns are ignored. Damaged
records raise ValueError.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowsmith.llm._io import materialize, new_path, small_batches

VERSION = b"WARC/1.1"
#: Framed bytes of one record; longer blocks continue in further records.
SEGMENT = 32 * 1024
#: Payload bytes of one transfer chunk.
FRAME = 4096
#: Records of one archive file.
FILE_RECORDS = 2000
DATE = "2024-01-01T00:00:00Z"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def framed(payload: bytes, frame: int = FRAME) -> bytes:
    """The payload in chunked transfer framing."""
    parts = []
    for at in range(0, len(payload), frame):
        piece = payload[at : at + frame]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unframed(block: bytes) -> bytes:
    """The payload of chunked framing; chunk extensions and trailers are skipped."""
    parts, at = [], 0
    while True:
        end = block.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk size line is cut off")
        size = int(block[at:end].split(b";")[0].strip(), 16)
        at = end + 2
        if size == 0:
            return b"".join(parts)
        if block[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk is cut off")
        parts.append(block[at : at + size])
        at += size + 2


def record(fields: dict[str, object], block: bytes) -> bytes:
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields.items() if v is not None)
    return b"".join([VERSION, b"\r\n", head, b"Content-Length: %d\r\n\r\n" % len(block), block, b"\r\n\r\n"])


def _one_line(url: str | None) -> str | None:
    return None if url is None else re.sub(r"[\r\n]+", " ", url)


def page_records(row: dict, segment: int, frame: int) -> Iterator[bytes]:
    """The WARC records of one page."""
    payload = row["payload"]
    url = _one_line(row["url"])
    ident = f"<urn:rowsmith:{row['row']}>"
    base = {"WARC-Record-ID": ident, "WARC-Date": DATE, "WARC-Target-URI": url, "WARC-Payload-Digest": f"sha1:{sha1_base32(payload)}", "X-Page-ID": row["page_id"], "X-Payload-Length": len(payload)}
    if row["refers"] is not None or row["revisit"]:
        yield record({"WARC-Type": "revisit", "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", **base, "WARC-Refers-To": f"<urn:rowsmith:{row['first_row']}>", "WARC-Refers-To-Target-URI": _one_line(row["first_url"]), "WARC-Refers-To-Date": DATE, "X-Refers-To-Page-ID": row["refers"]}, b"")
        return
    block = framed(payload, frame)
    cut = [block[i : i + segment] for i in range(0, len(block), segment)]
    if len(cut) == 1:
        yield record({"WARC-Type": "response", **base, "X-Transfer-Encoding": "chunked"}, block)
        return
    for k, piece in enumerate(cut, 1):
        if k == 1:
            yield record({"WARC-Type": "response", **base, "X-Transfer-Encoding": "chunked", "WARC-Segment-Number": 1}, piece)
        else:
            last = {"WARC-Segment-Total-Length": len(block)} if k == len(cut) else {}
            yield record({"WARC-Type": "continuation", "WARC-Record-ID": f"<urn:rowsmith:{row['row']}:{k}>", "WARC-Date": DATE, "WARC-Segment-Origin-ID": ident, "WARC-Segment-Number": k, **last}, piece)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of an archive's bytes: lower-case field names to values, and the block."""
    at = 0
    while at < len(data):
        if data[at : at + 2] == b"\r\n":
            at += 2
            continue
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError("not a WARC record")
        fields = {}
        for line in data[at:end].decode().split("\r\n")[1:]:
            name, _, value = line.partition(":")
            fields[name.strip().lower()] = value.strip()
        size, at = int(fields["content-length"]), end + 4
        if at + size > len(data):
            raise ValueError("record is cut off")
        yield fields, data[at : at + size]
        at += size


# ---------------------------------------------------------------- writing
def write_archives(pages: DataFrame, path: str, segment: int = SEGMENT, frame: int = FRAME) -> None:
    """Write (page_id, url, payload string) as gzip-compressed WARC files below ``path``."""
    small_batches(pages.sparkSession)
    rows = pages.select("page_id", "url", F.coalesce(F.col("payload"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("row", F.monotonically_increasing_id()).withColumn("digest", F.sha2("payload", 256))
    # Payloads that occur more than once, with the row that stays; unique ones need no shuffle of payloads.
    rank = F.struct(F.col("page_id").isNull().alias("unknown"), "page_id", "row", "url")
    firsts = materialize(rows.select("digest", rank.alias("rank")).groupBy("digest").agg(F.min("rank").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first"), "first-payloads")
    rows = rows.join(firsts, "digest", "left")
    revisit = F.col("first").isNotNull() & (F.col("first.row") != F.col("row"))
    rows = rows.select("page_id", "url", "payload", "row", F.when(revisit, F.col("first.page_id")).alias("refers"), F.coalesce(revisit, F.lit(False)).alias("revisit"), F.col("first.row").alias("first_row"), F.col("first.url").alias("first_url"))

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [b for row in batch.to_pylist() for b in page_records(row, segment, frame)]
            for i in range(0, len(out), 64):
                yield pa.RecordBatch.from_arrays([pa.array(out[i : i + 64], pa.large_binary()).cast(pa.binary())], names=["record"])

    packed = rows.mapInArrow(pack, "record binary").select(F.col("record").cast("string").alias("value"))
    packed.write.option("lineSep", "\r\n").option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path)


# ---------------------------------------------------------------- reading
_PARSED = "ident string, number int, total long, page_id long, url string, digest string, kind string, refers long, length long, chunked boolean, segmented boolean, block binary"


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _PARSED.split(", ")]
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary()]
    number = lambda v: None if v is None else int(v)

    def flush(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    for batch in batches:
        for content in batch.column(0):
            data = content.as_py()
            if data[:2] == b"\x1f\x8b":
                data = _inflate(data)
            held, size = [], 0
            for f, block in parse(data):
                kind = f.get("warc-type")
                if kind not in ("response", "revisit", "continuation"):
                    continue
                digest = f.get("warc-payload-digest", "").removeprefix("sha1:") or None
                held.append((f.get("warc-segment-origin-id", f.get("warc-record-id")), number(f.get("warc-segment-number")), number(f.get("warc-segment-total-length")), number(f.get("x-page-id")), f.get("warc-target-uri"), digest, kind, number(f.get("x-refers-to-page-id")), number(f.get("x-payload-length")), f.get("x-transfer-encoding") == "chunked", "warc-segment-number" in f, block))
                size += len(block)
                if size > 1 << 22:
                    yield flush(held)
                    held, size = [], 0
            if held:
                yield flush(held)


def _inflate(data: bytes) -> bytes:
    parts = []
    while data:
        d = zlib.decompressobj(31)
        parts += [d.decompress(data), d.flush()]
        data = d.unused_data
    return b"".join(parts)


def _restored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Join the segments, decode blocks, and check them against the recorded numbers, lengths and digests."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            payload = None
            if r["kind"] != "revisit":
                if r["segmented"] and ([p["number"] for p in r["parts"]] != list(range(1, len(r["parts"]) + 1)) or r["total"] is None):
                    raise ValueError(f"segments missing of {r['ident']}")
                block = b"".join(p["block"] for p in r["parts"])
                if r["total"] is not None and r["total"] != len(block):
                    raise ValueError(f"record {r['ident']}: {len(block)} bytes of {r['total']}")
                payload = unframed(block) if r["chunked"] else block
                if r["digest"] and sha1_base32(payload) != r["digest"]:
                    raise ValueError(f"record {r['ident']}: digest differs")
            out.append((r["page_id"], r["url"], r["kind"], r["refers"], r["length"] if payload is None else len(payload), r["digest"] if payload is None else sha1_base32(payload), payload))
        if out:
            c = list(zip(*out, strict=True))
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(c, kinds, strict=True)], names=["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload (null for revisits)."""
    small_batches(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    found = files.mapInArrow(_rows, _PARSED)
    facts = ["total", "page_id", "url", "digest", "refers", "length"]
    part = F.struct("number", "block")
    plain = found.where("not segmented").select("ident", *facts, "kind", "chunked", "segmented", F.array(part).alias("parts"))
    joined = found.where("segmented").groupBy("ident").agg(*[F.max(c).alias(c) for c in facts], F.lit("response").alias("kind"), F.max("chunked").alias("chunked"), F.lit(True).alias("segmented"), F.array_sort(F.collect_list(part)).alias("parts"))
    schema = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
    return plain.unionByName(joined).mapInArrow(_restored, schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` (page_id, url, payload) as archives in the shared folder and read them back."""
    path = new_path(pages.sparkSession, "warc")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path)


SQL = """
with p as (
  select page_id, encode(coalesce(html, '')) as payload from pages),
h as (select page_id, octet_length(payload)::bigint as payload_bytes, sha1(payload) as hex from p),
m as (select *, min(page_id) over (partition by hex) as first_page from h),
b as (
  select *, list_aggregate(list_transform(range(1, 41), lambda i: lpad(to_base(('0x' || hex[i])::int, 2), 4, '0')), 'string_agg', '') as bits from m)
select page_id, payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(
         16 * bits[5*i+1]::int + 8 * bits[5*i+2]::int + 4 * bits[5*i+3]::int + 2 * bits[5*i+4]::int + bits[5*i+5]::int) + 1]), 'string_agg', '') as payload_digest,
       case when page_id = first_page then 'response' else 'revisit' end as record_type,
       case when page_id = first_page then null else first_page end as refers_to
from b
"""
