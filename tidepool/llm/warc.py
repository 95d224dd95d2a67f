"""WARC archives, index first.

Tasks write gzipped WARC records (one gzip member each) to archives of a bounded
size in a shared folder and return the index: archive, offset, length, URL,
digest of every record. The index is what the archives are read by: selected
records are sorted by place, ranges that lie close are coalesced to one read,
and each read is cut into records again.

Records with equal payloads are stored once: the one with the largest page_id
is a response, the others are revisits that refer to it.

An archive of a task that failed stays without an index row; nothing reads it.

Defined results: a null html is an empty payload; a null URL leaves the header
out. Rows that share the largest page_id of a payload are all responses; a row
without page_id is a revisit if some row with one has its payload, else a
response. Extra columns are not read; an empty table gives an empty index.
"""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.common import query, read, written
from tidepool.session import scratch_path

#: An archive is closed when it has so many bytes.
ARCHIVE_BYTES = 64 << 20
#: Reads are coalesced over gaps up to the first size, to at most the second.
GAP_BYTES, READ_BYTES = 64 << 10, 4 << 20

_INDEX = ("page_id long, url string, archive string, offset long, length long, payload_digest string,"
          " payload_bytes long, record_type string")
_RECORDS = ("page_id long, url string, warc_date string, payload_bytes long, payload_digest string, record_type string,"
            " refers_to long, payload binary")


def _open(uri: str):
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


def _id(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(value: str) -> int | None:
    number = value[len("<urn:page:"):-1]
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> tuple[bytes, str]:
    """One WARC record of a capture at ``date`` (``2024-05-01T12:00:00Z``), and its payload digest.
    A revisit keeps the HTTP header, not the payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    kind = "response" if refers_to is None else "revisit"
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_id(page_id)}", f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(f"%{ord(c):02X}" if ord(c) < 33 else c for c in url))
    if refers_to is None:
        block += payload
    else:
        head += [f"WARC-Refers-To: {_id(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", digest


def parse(raw: bytes) -> dict:
    """The fields of a record as :func:`record` writes it; raises if the payload is not the one digested."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"record {fields['WARC-Record-ID']} doesn't match its digest")
    return {"page_id": _page(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "warc_date": fields["WARC-Date"], "payload_bytes": size,
            "payload_digest": digest, "record_type": fields["WARC-Type"],
            "refers_to": _page(fields["WARC-Refers-To"]) if revisit else None, "payload": None if revisit else payload}


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        store.create_dir(base, recursive=True)
        out = name = None
        at = 0
        try:
            for batch in batches:
                rows = []
                for x in zip(*(batch.column(i) for i in range(5))):
                    page_id, url, html, refers_to, date = (v.as_py() for v in x)
                    if out is None:
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{base}/{name}", compression=None)
                    payload = (html or "").encode()
                    raw, digest = record(page_id, url, payload, refers_to, date)
                    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
                    packed = packer.compress(raw) + packer.flush()
                    out.write(packed)
                    rows.append((page_id, url, f"{folder}/{name}", at, len(packed), digest, len(payload),
                                 "response" if refers_to is None else "revisit"))
                    at += len(packed)
                    if at >= ARCHIVE_BYTES:
                        out.close()
                        out = None
                yield _batch(rows, _INDEX)
        finally:
            if out is not None:
                out.close()

    return run


_TYPES = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(",")]
    columns = list(zip(*rows)) or [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[kind]) for c, (_, kind) in zip(columns, fields)], names=[n for n, _ in fields])


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = 0, date_col: str | None = None) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) to archives under ``folder`` (shared storage) and returns their index.

    Equal payloads of at least ``min_bytes`` are stored once. A record's date is the time in ``date_col``,
    and where there is none the time of this call.
    """
    now = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    at = F.lit(None).cast("timestamp") if date_col is None else F.col(date_col).cast("timestamp")
    date = F.coalesce(F.date_format(F.to_utc_timestamp(at, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(now))
    folder = (folder or scratch_path(pages.sparkSession, "warc")).rstrip("/")
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha1(payload).alias("digest"),
                        date.alias("warc_date"))
    copies = (rows.filter(F.octet_length(payload) >= min_bytes).groupBy("digest")
              .agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).filter("n > 1"))
    rows = (rows.join(copies, "digest", "left")
            .withColumn("refers_to", F.when(F.coalesce(F.col("page_id") < F.col("keeper"), F.col("keeper").isNotNull()), F.col("keeper"))))
    return written(rows.select("page_id", "url", "html", "refers_to", "warc_date").mapInArrow(_write(folder), _INDEX), "warc-index")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of index rows (archive, offset, length) that come sorted by place."""
    opened: tuple = ("", None)
    for batch in batches:
        places = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
        i = 0
        while i < len(places):
            archive, begin, length = places[i]
            j, end = i + 1, begin + length
            while j < len(places) and places[j][0] == archive and places[j][1] <= end + GAP_BYTES and places[j][1] + places[j][2] - begin <= READ_BYTES:
                end = max(end, places[j][1] + places[j][2])
                j += 1
            if opened[0] != archive:
                store, path = _open(archive)
                opened = (archive, store.open_input_file(path))
            block = opened[1].read_at(end - begin, begin)
            found = [parse(zlib.decompress(block[o - begin:o - begin + n], 31)) for _, o, n in places[i:j]]
            yield _batch([tuple(x.values()) for x in found], _RECORDS)
            i = j


def read_records(index: DataFrame) -> DataFrame:
    """The records that the rows of ``index`` point to; the number of tasks follows the bytes to be read."""
    stretch = F.floor(F.col("offset") / F.lit(4 * READ_BYTES))
    tasks = max(1, -(-(index.agg(F.sum("length")).first()[0] or 0) // (4 * READ_BYTES)))
    return (index.select("archive", "offset", "length").repartition(tasks, F.col("archive"), stretch)
            .sortWithinPartitions("archive", "offset").mapInArrow(_read, _RECORDS))


ORACLE = """
with p as (
  select page_id, octet_length(encode(coalesce(html, '')))::bigint as payload_bytes, sha1(coalesce(html, '')) as h,
         max(page_id) over (partition by sha1(coalesce(html, ''))) as keeper
  from pages)
select page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (((('0x' || substr(h, ((i // 4) * 5 + 1)::int, 5))::bigint >> (15 - 5 * (i % 4))::int) & 31) + 1)::int, 1)), '') as payload_digest,
       case when page_id < keeper then 'revisit' else 'response' end as record_type,
       case when page_id < keeper then keeper end as refers_to
from p
"""


@query("op9_warc", oracle=ORACLE)
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all pages to archives and reads every record back."""
    index = write_archives(read(spark, sf_dir, "pages"))
    return read_records(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
