"""WARC archives of pages, with an index written first and byte ranges read by it.

Each task writes one archive after the other: gzip members, one record each. Records of equal
payloads have one response, that of the smallest page id; the others are revisit records that
name it and keep the HTTP headers without the payload. Per record the index has the file, the
byte offset and length, URL, digest and kind; it is written before anything is read. A read
selects index rows, sorts them by file and offset, merges records that lie close together
into one range of bounded size, and reads each range once.

Null payloads are empty. Payloads smaller than `least_bytes` are always responses. Rows that
share the smallest page id are all responses, as are rows of a payload without any page id.
Null URLs are written as an empty target. Repeated rows make repeated records.
"""

from __future__ import annotations

import base64
import hashlib
import math
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.llm.common import SharedFile, filesystem, in_batches, written

#: A task begins another archive after so many bytes.
FILE_BYTES = 1 << 30
#: Records closer together than this are read in one range, up to RANGE_BYTES.
GAP_BYTES, RANGE_BYTES = 1 << 16, 1 << 23
#: Archive bytes that a task reads, on average.
TASK_BYTES = 1 << 27
#: Copies of one payload are spread over so many parts when they look up their response.
SALTS = 16

INDEX = ("page_id long, url string, file string, offset long, length long, "
         "payload_digest string, payload_bytes long, record_type string, refers_to long")

# Fixed values of the format.
_DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page_of(record_id: str) -> int | None:
    name = record_id.removeprefix("<urn:page:").removesuffix(">")
    return None if name == "none" else int(name)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(value: str | None) -> str:
    """A header value: line ends would begin another header."""
    return "".join(c if c.isprintable() else " " for c in value or "")


def record(page_id: int | None, url: str | None, payload: bytes, name: str,
           refers_to: int | None) -> bytes:
    """A response record, or a revisit of another page's, as a gzip member."""
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    headers = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
               f"WARC-Record-ID: {_record_id(page_id)}", f"WARC-Date: {_DATE}",
               f"WARC-Target-URI: {_line(url)}", f"WARC-Payload-Digest: sha1:{name}",
               "Content-Type: application/http; msgtype=response",
               f"Content-Length: {len(block)}"]
    if revisit:
        headers += [f"WARC-Refers-To: {_record_id(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return (packer.compress("\r\n".join([*headers, "", ""]).encode() + block + b"\r\n\r\n")
            + packer.flush())


def parse(member: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Record headers, HTTP headers and payload of one gzip member."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:]), payload


def _roles(pages: DataFrame, least_bytes: int) -> DataFrame:
    """Each page with the response that it revisits, if it does."""
    sized = pages.withColumns({"sha": F.sha1("payload"), "size": F.octet_length("payload")})
    salt = F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")
    several = (pages.select(F.sha1("payload").alias("sha"), "page_id",
                            F.octet_length("payload").alias("size"))
               .where(F.col("size") >= least_bytes).groupBy("sha")
               .agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
               .where("copies > 1 AND first IS NOT NULL")
               .select("sha", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
                       .alias("salt")))
    return (sized.withColumn("salt", salt).join(several, ["sha", "salt"], "left")
            .select("page_id", "url", "payload",
                    F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
                    .alias("refers_to")))


def write(pages: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """Write the archives into the folder; returns their index, written beside them."""
    plain = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
        F.coalesce(F.col(html_col).cast("binary"), F.lit(b"")).alias("payload"))

    def archived(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, rows = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                page, url, payload, refers = (batch.column(c)[i].as_py() for c in range(4))
                if out is None:
                    out = SharedFile(folder, ".warc.gz")
                name = digest(payload)
                member = record(page, url, payload, name, refers)
                rows.append((page, url, out.name, out.write(member), len(member), name,
                             len(payload), "response" if refers is None else "revisit", refers))
                if out.size >= FILE_BYTES:
                    out.close()
                    yield _index_rows(rows)
                    out, rows = None, []
        if out is not None:
            out.close()
            yield _index_rows(rows)

    return written(in_batches(_roles(plain, least_bytes), archived, INDEX), "warc-index")


def _index_rows(rows: list[tuple]) -> pa.RecordBatch:
    names = [f.split()[0] for f in INDEX.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string()}
    types = [kinds[f.split()[1]] for f in INDEX.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def ranges(records: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[int]]]:
    """(file, begin, end, records) of merged byte ranges, for records in order."""
    held: list[int] = []
    name, begin, end = "", 0, 0
    for i, (file, offset, length) in enumerate(records):
        if held and (file != name or offset - end > GAP_BYTES
                     or max(end, offset + length) - begin > RANGE_BYTES):
            yield name, begin, end, held
            held = []
        if not held:
            name, begin, end = file, offset, offset
        held.append(i)
        end = max(end, offset + length)
    if held:
        yield name, begin, end, held


def read(index: DataFrame, folder: str) -> DataFrame:
    """The records of the given index rows, as the archives have them.

    Columns: page_id, url, record_type, refers_to, payload_digest, payload_bytes (both of the
    full payload, also of revisits) and payload (null for revisits). A payload whose digest
    is not the recorded one is an error.
    """
    spark = index.sparkSession
    total = index.agg(F.sum("length")).first()[0] or 0
    # A given number of partitions is kept; the index alone would look small enough for one task.
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(total / TASK_BYTES))
    placed = (index.select("file", "offset", "length")
              .withColumn("part", F.floor(F.col("offset") / RANGE_BYTES))
              .repartition(tasks, "file", "part").sortWithinPartitions("file", "offset")
              .select("file", "offset", "length"))
    schema = ("page_id long, url string, record_type string, refers_to long, "
              "payload_digest string, payload_bytes long, payload binary")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        for batch in batches:
            wanted = list(zip(*(c.to_pylist() for c in batch.columns)))
            for file, begin, end, held in ranges(wanted):
                with fs.open_input_file(f"{root}/{file}") as source:
                    data = source.read_at(end - begin, begin)
                rows = []
                for i in held:
                    at = wanted[i][1] - begin
                    fields, http, payload = parse(data[at:at + wanted[i][2]])
                    name = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    kind, refers = fields["WARC-Type"], fields.get("WARC-Refers-To")
                    if kind == "response" and digest(payload) != name:
                        raise ValueError(f"{file} at {wanted[i][1]}: payload differs from its digest")
                    rows.append((_page_of(fields["WARC-Record-ID"]), fields["WARC-Target-URI"],
                                 kind, refers and _page_of(refers), name,
                                 int(http["Content-Length"]),
                                 payload if kind == "response" else None))
                types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(),
                         pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), types)],
                    [f.split()[0] for f in schema.split(", ")])

    return in_batches(placed, records, schema)


#: SQL for the records that the archives of `pages` must hold.
ORACLE = """
    WITH named AS (
        SELECT page_id, coalesce(html, '') AS payload FROM pages),
    firsts AS (
        SELECT payload, min(page_id) AS first FROM named GROUP BY payload),
    bits AS (
        SELECT n.page_id, f.first, strlen(n.payload)::BIGINT AS payload_bytes,
               CAST(CAST(unhex(sha1(n.payload)) AS BIT) AS VARCHAR) AS b
        FROM named n JOIN firsts f ON n.payload = f.payload)
    SELECT page_id, payload_bytes,
           array_to_string(list_transform(range(32), lambda i: substr(
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               (1 + 16 * substr(b, 5 * i + 1, 1)::INT + 8 * substr(b, 5 * i + 2, 1)::INT
                + 4 * substr(b, 5 * i + 3, 1)::INT + 2 * substr(b, 5 * i + 4, 1)::INT
                + substr(b, 5 * i + 5, 1)::INT)::BIGINT, 1)), '') AS payload_digest,
           CASE WHEN page_id IS NOT DISTINCT FROM first OR first IS NULL
                THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
    FROM bits"""
