"""WARC archives: written with an index, read back by ranges of bytes.

Every task writes one archive of gzip members, a record each, and yields an index row for
every record: file, offset, length, URL, digest. The index is stored as a table, so archives
of attempts that failed are never looked at. Reading starts from (any selection of) the
index: its rows are sorted by file and offset, neighbouring ranges are read at once, and the
records are taken apart again.

Archives go to the shared folder through Arrow's file systems, which reach local and shared
disks as well as object stores.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygate.llm.common import shared_place, shared_table

#: Payloads of fewer bytes are never replaced by a reference to an equal one.
LEAST_REVISITED = 0
GZIP_LEVEL = 4
#: Bytes of archives that one task reads, at one time, and may skip to join two ranges.
TASK_BYTES = 16 << 20
READ_BYTES = 4 << 20
SKIP_BYTES = 64 << 10
DATE = "2024-01-01T00:00:00Z"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url, payload: bytes | None, size: int, digest: str, refers_to) -> bytes:
    """A response (``payload`` given) or a revisit of the page ``refers_to``."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {size}\r\n\r\n"
    ).encode()
    body = http + (payload or b"")
    headers = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if payload is None else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if url is not None:
        # Bytes that would end the header line are escaped.
        headers.append(f"WARC-Target-URI: {quote(url, safe=_URL_SAFE)}")
    if payload is None:
        headers.append(
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        )
        headers.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    headers.append(f"Content-Length: {len(body)}")
    return "\r\n".join(headers).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


_URL_SAFE = "!#$%&'()*+,/:;=?@[]~"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (and ``http-content-length``) and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    body = rest[: int(headers["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    for line in http.decode().split("\r\n")[1:]:
        name, _, value = line.partition(": ")
        if name.lower() == "content-length":
            headers["http-content-length"] = value
    return headers, payload


def _page_of(name: str) -> int | None:
    number = name.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def write(
    pages: DataFrame,
    folder: str,
    least: int = LEAST_REVISITED,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """Archives of ``pages`` in ``folder``; returns their index, stored.

    A row each: null html is an empty payload, null url leaves the header out. Of payloads
    alike of at least ``least`` bytes the smallest id is the response (an id that repeats
    with the same payload, each time); null ids come last. An empty table writes nothing.
    """
    payload = F.coalesce(F.col(html_column).cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(id_column).cast("bigint").alias("page_id"),
        F.col(url_column).alias("url"),
        payload.alias("payload"),
    ).select("*", F.sha1("payload").alias("sha1"), F.octet_length("payload").alias("size"))
    firsts = rows.groupBy("sha1").agg(F.min("page_id").alias("first"))
    # The payloads of one digest may be a third of all rows: the join is a plain one, whose
    # large partitions Spark splits, and only responses carry their payload on.
    is_response = F.col("page_id").eqNullSafe(F.col("first")) | (F.col("size") < least)
    decided = rows.join(firsts, "sha1").select(
        "page_id",
        "url",
        F.when(is_response, F.col("payload")).alias("payload"),
        F.col("size").cast("bigint").alias("size"),
        F.unhex("sha1").alias("sha1"),
        F.when(~is_response, F.col("first")).alias("refers_to"),
    )

    def batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = fs.FileSystem.from_uri(folder)
        name = f"{uuid.uuid4().hex}.warc.gz"
        out, offset = None, 0
        for rows in batches:
            if rows.num_rows and out is None:
                system.create_dir(place, recursive=True)
                out = system.open_output_stream(f"{place}/{name}", compression=None)
            index = []
            for page_id, url, body, size, sha1, refers_to in zip(
                *(column.to_pylist() for column in rows.columns)
            ):
                digest = base64.b32encode(sha1).decode()
                pack = zlib.compressobj(GZIP_LEVEL, wbits=31)
                plain = record(page_id, url, body, size, digest, refers_to)
                member = pack.compress(plain) + pack.flush()
                out.write(member)
                index.append((page_id, url, digest, name, offset, len(member)))
                offset += len(member)
            if index:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*index), _INDEX_TYPES)], _INDEX_NAMES
                )
        if out is not None:
            out.close()

    return shared_table(decided.mapInArrow(batch, _INDEX_SCHEMA), "warc index")


_INDEX_NAMES = ["page_id", "url", "digest", "file", "offset", "length"]
_INDEX_TYPES = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
_INDEX_SCHEMA = (
    "page_id bigint, url string, digest string, file string, offset bigint, length bigint"
)


def ranges(rows: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list]]:
    """(file, start, end, rows) of reads that each cover sorted, neighbouring records."""
    file, start, end, own = None, 0, 0, []
    for row in rows:
        near = file == row[0] and 0 <= row[1] - end <= SKIP_BYTES
        if own and not (near and row[1] + row[2] - start <= READ_BYTES):
            yield file, start, end, own
            own = []
        if not own:
            file, start = row[0], row[1]
        end = row[1] + row[2]
        own.append(row)
    if own:
        yield file, start, end, own


def read(index: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """The records that ``index`` (all of it, or a selection) points to, taken apart.

    (page_id, url, payload_bytes, payload_digest, record_type, refers_to[, payload]). A
    response's size and digest are those of the payload that was read; a payload that does
    not have the digest written beside it is an error.
    """
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-total // TASK_BYTES))
    wanted = (
        index.select("file", "offset", "length")
        .repartitionByRange(tasks, "file", "offset")
        .sortWithinPartitions("file", "offset")
    )

    def batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, place = fs.FileSystem.from_uri(folder)
        for rows in batches:
            places = list(zip(*(column.to_pylist() for column in rows.columns)))
            for file, start, end, own in ranges(places):
                with system.open_input_file(f"{place}/{file}") as source:
                    data = source.read_at(end - start, start)
                found = [
                    _fields(zlib.decompress(data[at - start : at - start + length], wbits=31))
                    for _, at, length in own
                ]
                columns = list(zip(*found))[: len(names)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)], names
                )

    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    schema = (
        "page_id bigint, url string, payload_bytes bigint, payload_digest string, "
        "record_type string, refers_to bigint"
    )
    if with_payload:
        names, types = [*names, "payload"], [*types, pa.binary()]
        schema += ", payload binary"
    return wanted.mapInArrow(batch, schema)


def _fields(data: bytes) -> tuple:
    headers, payload = parse(data)
    kind = headers["WARC-Type"]
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    size, refers_to = int(headers["http-content-length"]), None
    if kind == "response":
        if base32_sha1(payload) != digest:
            raise ValueError(f"{headers['WARC-Record-ID']} does not have its digest")
        size = len(payload)
    else:
        refers_to, payload = _page_of(headers["WARC-Refers-To"]), None
    page_id = _page_of(headers["WARC-Record-ID"])
    return page_id, headers.get("WARC-Target-URI"), size, digest, kind, refers_to, payload


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives, and what reading them back finds."""
    folder = shared_place(spark, "warc")
    index = write(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return read(index, folder).drop("url")


OP2_SQL = f"""
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
         sha1(coalesce(html, '')) AS h
  FROM pages
),
d AS (
  SELECT page_id, payload_bytes, h, min(page_id) OVER (PARTITION BY h) AS first,
         list_transform(range(0, 8), lambda g:
           CAST('0x' || substr(h, CAST(5 * g + 1 AS INTEGER), 5) AS INTEGER)) AS v
  FROM p
)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(v, lambda x: list_aggregate(
         list_transform([x // 32768, x // 1024 % 32, x // 32 % 32, x % 32],
                        lambda c: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                                         CAST(c + 1 AS INTEGER), 1)),
         'string_agg', '')), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first OR payload_bytes < {LEAST_REVISITED}
            THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first OR payload_bytes < {LEAST_REVISITED}
            THEN NULL ELSE first END AS refers_to
FROM d
"""
