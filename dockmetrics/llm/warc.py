"""WARC archives: written with an index, read by coalesced byte ranges.

One gzip member per record. Writing returns an index row per record (file, offset, length,
url, digest, ...), kept as a table. Reading starts from the index alone: the selected rows
are sorted by file and offset, neighbours less than ``gap`` bytes apart are fetched with one
range read of at most ``range_bytes``, and only then are records parsed.

Of records with equal payloads of ``revisit_bytes`` or more, the one with the largest page id
is a ``response``, the others are ``revisit`` records that refer to it and hold no payload;
smaller payloads are always responses. A null html is an empty payload. A null page id is
the smallest; rows that repeat the response's page id are responses as well. Control
characters and blanks of a url are percent-encoded in the record; a null url is empty.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockmetrics.llm.common import materialize, shuffle_width, whole_text
from dockmetrics.llm.files import attempt_name, open_store, write_file

REVISIT_BYTES = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
_INDEX = "file string, offset long, length long, page_id long, url string, digest string, record_type string"
_READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """The pages with ``record_type`` and ``refers_to``."""
    payload = whole_text(html_col)
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), whole_text(url_col).alias("url"), payload.alias("html"),
        F.when(F.octet_length(payload) >= revisit_bytes, F.sha2(payload, 256)).alias("content"),
    )
    copies = rows.filter("content is not null").groupBy("content").agg(
        F.count(F.lit(1)).alias("n"), F.max("page_id").alias("response_id")
    ).filter("n > 1").select("content", "response_id", F.lit(True).alias("copied"))
    joined = rows.join(copies, "content", "left")
    revisit = F.col("copied") & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    return joined.select(
        "page_id", "url", "html",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("response_id")).alias("refers_to"),
    )


def write_warc(records: DataFrame, folder: str) -> DataFrame:
    """Writes one archive per partition of ``plan_records``; returns the index."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, index, at = attempt_name("pages", ".warc.gz"), [], 0

        def chunks() -> Iterator[bytes]:
            nonlocal at
            for batch in batches:
                for page in _each_row(batch):
                    payload = page["html"].encode("utf-8", "surrogatepass")
                    digest = hashlib.sha1(payload).digest()
                    raw = _gzip(_record(page, payload, digest))
                    index.append((name, at, len(raw), page["page_id"], page["url"], digest.hex(), page["record_type"]))
                    at += len(raw)
                    yield raw

        write_file(folder, name, chunks())
        for begin in range(0, len(index), 10_000):
            columns = zip(*index[begin : begin + 10_000])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _INDEX_TYPES)], names=_INDEX_NAMES)

    return materialize(records.mapInArrow(write, _INDEX), "warc-index")


_INDEX_NAMES = [field.split(" ")[0] for field in _INDEX.split(", ")]
_INDEX_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]


def _each_row(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}


def _record(page: dict, payload: bytes, digest: bytes) -> bytes:
    url = "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in page["url"])
    head = {
        "WARC-Type": page["record_type"],
        "WARC-Record-ID": f"<urn:page:{'' if page['page_id'] is None else page['page_id']}>",
        "WARC-Target-URI": url,
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(digest).decode(),
        "X-Payload-Length": str(len(payload)),
        "Content-Type": "application/http; msgtype=response",
    }
    block = _HTTP.format(len(payload)).encode()
    if page["record_type"] == "revisit":
        head["WARC-Profile"] = PROFILE
        head["WARC-Refers-To"] = f"<urn:page:{'' if page['refers_to'] is None else page['refers_to']}>"
    else:
        block += payload
    head["Content-Length"] = str(len(block))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode("utf-8", "surrogatepass") + b"\r\n" + block + b"\r\n\r\n"


def _gzip(raw: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def read_warc(
    selected: DataFrame, folder: str, gap: int = 64 << 10, range_bytes: int = 8 << 20, span: int = 64 << 20, keep_payload: bool = True
) -> DataFrame:
    """The records of the selected index rows, with payloads if asked for. Files are read in
    spans, so that one large file is shared by several tasks."""
    place = selected.select("file", "offset", "length", F.expr(f"offset div {span}").alias("part"))
    width = shuffle_width(selected.sparkSession)
    ordered = place.repartition(width, "file", "part").sortWithinPartitions("file", "offset")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        group: list[tuple[str, int, int]] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))):
                if group and not _joins(group, row, gap, range_bytes):
                    yield from _fetch_range(store, base, group, keep_payload)
                    group = []
                group.append(row)
        if group:
            yield from _fetch_range(store, base, group, keep_payload)

    return ordered.mapInArrow(fetch, _READ)


def _joins(group: list, row: tuple, gap: int, most: int) -> bool:
    file, offset, length = row
    last = group[-1]
    return file == last[0] and offset - (last[1] + last[2]) <= gap and offset + length - group[0][1] <= most


def _fetch_range(store, base: str, group: list, keep_payload: bool) -> Iterator[pa.RecordBatch]:
    begin, end = group[0][1], group[-1][1] + group[-1][2]
    with store.open_input_file(f"{base}/{group[0][0]}") as file:
        raw = file.read_at(end - begin, begin)
    rows, held = [], 0
    for _, offset, length in group:
        rows.append(parse_record(zlib.decompress(raw[offset - begin : offset - begin + length], 31)))
        held += rows[-1]["payload_bytes"]
        if not keep_payload:
            rows[-1]["payload"] = None
        elif held > 16 << 20:
            yield pa.RecordBatch.from_pylist(rows, _READ_SCHEMA)
            rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_pylist(rows, _READ_SCHEMA)


_READ_SCHEMA = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
)


def parse_record(raw: bytes) -> dict:
    """Header fields and payload of one record; a stored payload must fit its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:"))
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and hashlib.sha1(payload).digest() != digest:
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    number = lambda name: int(n) if (n := fields.get(name, "")[len("<urn:page:") : -1]) else None
    return {
        "page_id": number("WARC-Record-ID"), "url": fields["WARC-Target-URI"],
        "payload_bytes": int(fields["X-Payload-Length"]), "payload_digest": digest.hex(),
        "record_type": fields["WARC-Type"], "refers_to": number("WARC-Refers-To"),
        "payload": None if revisit else payload,
    }
