"""WARC archives of pages: writing with segmented, chunked, deduplicated
records, and reading back by segment reassembly.

Archives are gzipped files below one folder.  A block longer than the segment
size is spread over a ``response`` record and ``continuation`` records; the
reader groups these by origin identifier, orders them by segment number,
verifies the total length and decodes the chunked transfer framing.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, materialise

SEGMENT_BYTES, CHUNK_BYTES = 16 << 10, 4 << 10
RECORDS_A_FILE = 2000  # with the segment size, this bounds an archive at about 34 MB
DATE = "1970-01-01T00:00:00Z"
_END = b"\r\n\r\n"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: ten hex digits are eight of base 32."""
    part = lambda i: F.lpad(F.conv(F.substring(F.sha1(payload), 10 * i + 1, 10), 16, 32), 8, "0")
    return F.translate(F.concat(*map(part, range(4))), "0123456789ABCDEFGHIJKLMNOPQRSTUV", _BASE32)


# ---- writing -------------------------------------------------------------------------------------------------------
def _cuts(block: bytes, size: int) -> list[bytes]:
    """Parts of at most ``size`` (4 or more) bytes that do not split a UTF-8
    character: every record is valid text, as its sink demands."""
    parts, at = [], 0
    while at < len(block):
        end = min(len(block), at + size)
        while end < len(block) and block[end] & 0xC0 == 0x80:
            end -= 1
        parts.append(block[at:end])
        at = end
    return parts


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    return b"".join(b"%X\r\n%b\r\n" % (len(p), p) for p in _cuts(payload, size)) + b"0\r\n\r\n"


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", len(block))] if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block


def records_of(page_id: int | None, url: str | None, payload: bytes, digest: str, first_id: int | None, revisit: bool,
               segment_bytes: int) -> list[bytes]:
    """The records of one page, without the blank lines that end each."""
    name = lambda page, part: f"<urn:page:{'' if page is None else page}:{digest}:{part}>"
    uri = None if url is None else "".join(c if c > " " else f"%{ord(c):02X}" for c in url)
    common = [("WARC-Date", DATE), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{digest}"),
              ("X-Page-ID", page_id)]
    if revisit:
        return [_record([("WARC-Type", "revisit"), ("WARC-Record-ID", name(page_id, 1)), *common,
                         ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                         ("WARC-Refers-To", name(first_id, 1)), ("X-Refers-To-Page-ID", first_id),
                         ("X-Payload-Length", len(payload))], b"")]
    block = _HTTP + chunked(payload)
    parts = _cuts(block, segment_bytes)
    out = []
    for i, part in enumerate(parts, 1):
        fields = [("WARC-Type", "response" if i == 1 else "continuation"), ("WARC-Record-ID", name(page_id, i)), *common]
        if len(parts) > 1:
            fields.append(("WARC-Segment-Number", i))
        if i > 1:
            fields.append(("WARC-Segment-Origin-ID", name(page_id, 1)))
            if i == len(parts):
                fields.append(("WARC-Segment-Total-Length", len(block)))
        out.append(_record(fields, part))
    return out


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", text_col: str = "html",
                   min_revisit_bytes: int = 0, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write every page below ``path``.

    Of pages with equal payloads of at least ``min_revisit_bytes`` the one with
    the smallest id is a response and the others revisit it; rows that tie on
    that id are all responses, and so are pages without a smallest id to refer
    to (all null).  A null text is an empty payload.  Digests are grouped and
    joined; a payload shared by many pages is pre-aggregated to one row.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("payload"))
    keyed = rows.withColumn("digest", sha1_base32(F.col("payload")))
    # written, so that the join is of two plain exchanges and AQE may split a payload that many pages share
    first = materialise(keyed.groupBy("digest").agg(F.min("page_id").alias("first_id")), "warc-first")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [r.decode() for row in zip(*(c.to_pylist() for c in batch.columns)) for r in records_of(*row, segment_bytes)]
        return pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])

    revisit = ((F.octet_length("payload") >= min_revisit_bytes) & F.col("first_id").isNotNull()
               & ~F.col("page_id").eqNullSafe(F.col("first_id")))
    planned = keyed.join(first, "digest").select("page_id", "url", "payload", "digest", "first_id",
                                                 revisit.alias("revisit"))
    # a text sink whose line separator is the end of a record writes WARC files as they are
    (map_batches(planned, run, "value string").write.mode("overwrite").option("lineSep", _END.decode())
     .option("compression", "gzip").option("maxRecordsPerFile", RECORDS_A_FILE).text(path))


# ---- reading -------------------------------------------------------------------------------------------------------
def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields by lower-case name, block) of each record of an archive,
    plain or gzipped, as a whole or record by record."""
    data = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
    at = 0
    while at < len(data):
        head = data.index(_END, at)
        version, *lines = data[at:head].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        begin = head + len(_END)
        end = begin + int(fields["content-length"])
        if data[end:end + len(_END)] != _END:
            raise ValueError(f"the record at byte {at} does not end where its length says")
        yield fields, data[begin:end]
        at = end + len(_END)


_RECORD = ("type string, record_id string, origin string, segment int, total long, page_id long, refers_to long, "
           "payload_bytes long, digest string, block binary")
_RECORD_ARROW = pa.schema([("type", pa.string()), ("record_id", pa.string()), ("origin", pa.string()),
                           ("segment", pa.int32()), ("total", pa.int64()), ("page_id", pa.int64()),
                           ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("digest", pa.string()),
                           ("block", pa.binary())])


def read_records(spark: SparkSession, path: str, segmented: bool | None = None) -> DataFrame:
    """One row per record of the archives below ``path``; ``segmented`` keeps
    the records that are (are not) part of a segmented one."""
    number = lambda fields, key: int(fields[key]) if key in fields else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = []
                for f, block in parse(batch.column(0)[i].as_py()):
                    if segmented is not None and segmented != ("warc-segment-number" in f):
                        continue
                    rows.append({
                        "type": f["warc-type"], "record_id": f["warc-record-id"],
                        "origin": f.get("warc-segment-origin-id", f["warc-record-id"]),
                        "segment": number(f, "warc-segment-number"), "total": number(f, "warc-segment-total-length"),
                        "page_id": number(f, "x-page-id"), "refers_to": number(f, "x-refers-to-page-id"),
                        "payload_bytes": number(f, "x-payload-length"),
                        "digest": f.get("warc-payload-digest", "").removeprefix("sha1:") or None, "block": block})
                yield pa.RecordBatch.from_pylist(rows, _RECORD_ARROW)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, _RECORD)


def http_payload(block: bytes) -> bytes:
    """The body of an HTTP response, chunked transfer framing decoded."""
    head, _, body = block.partition(_END)
    if b"transfer-encoding: chunked" not in head.lower():
        return body
    parts, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        if not size:
            return b"".join(parts)
        part = body[line + 2:line + 2 + size]
        if len(part) != size or body[line + 2 + size:line + 4 + size] != b"\r\n":
            raise ValueError("a chunk does not end where its size says")
        parts.append(part)
        at = line + 4 + size


def joined(segments: list[dict]) -> bytes:
    """One block from its segments, ordered by number; equal copies count once."""
    by_number = {s["segment"]: s["block"] for s in segments}
    totals = {s["total"] for s in segments} - {None}
    block = b"".join(by_number[n] for n in sorted(by_number))
    if sorted(by_number) != list(range(1, len(by_number) + 1)) or totals != {len(block)}:
        raise ValueError(f"segments {sorted(by_number)} have {len(block)} bytes of {sorted(totals)}")
    return block


_PAGE = "page_id long, type string, refers_to long, payload_bytes long, digest string, payload binary, error string"
_PAGE_ARROW = pa.schema([("page_id", pa.int64()), ("type", pa.string()), ("refers_to", pa.int64()),
                         ("payload_bytes", pa.int64()), ("digest", pa.string()), ("payload", pa.binary()),
                         ("error", pa.string())])


def _page(record: dict, block: bytes | None, error: str | None = None) -> dict:
    payload = None
    if block is not None and record["type"] != "revisit":
        try:
            payload = http_payload(block)
        except ValueError as e:
            error = str(e)
    return {k: record[k] for k in ("page_id", "type", "refers_to", "payload_bytes", "digest")} | {
        "payload": payload, "error": error}


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per page of the archives: its payload (null for a revisit, whose
    length and digest are in its header), or an ``error`` if its segments are
    not whole or its framing is broken.  Only segmented records are shuffled;
    one origin's segments make up one payload, hence one output cell.  Where
    repeated pages share a record id, every one of them is returned.
    """

    def whole(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([_page(r, r["block"]) for r in batch.to_pylist()], _PAGE_ARROW)

    def parts(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for group in batch.column(0).to_pylist():
            heads = [s for s in group if s["segment"] == 1]
            try:
                block, error = joined(group), None
            except ValueError as e:
                block, error = None, str(e)
            out += [_page(s, block, error) for s in heads or [group[0] | {"type": "response"}]]
        return pa.RecordBatch.from_pylist(out, _PAGE_ARROW)

    fields = [f.split()[0] for f in _RECORD.split(", ")]
    groups = (read_records(spark, path, segmented=True).groupBy("origin")
              .agg(F.sort_array(F.collect_list(F.struct("segment", *(f for f in fields if f != "segment")))).alias("group"))
              .select("group"))
    return map_batches(read_records(spark, path, segmented=False), whole, _PAGE).unionByName(
        map_batches(groups, parts, _PAGE))
