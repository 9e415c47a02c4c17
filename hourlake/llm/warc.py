"""Operator 7: WARC archives, index first.

Writing leaves an index row for each record: its archive, offset, length, URL, digest and kind. Reading
starts from the index: the rows wanted are dealt by ranges of (archive, offset), and each task joins
neighbouring byte ranges into one read before it cuts them into records.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourlake.llm.common import mark, new_path, qualified, result, stored

INDEX_SCHEMA = "page_id long, url string, archive string, offset long, length long, payload_bytes long, payload_digest string, record_type string, refers_to long"
RECORD_SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
#: An archive is closed beyond this size; ranges this near are read at once, up to so many bytes.
ARCHIVE_BYTES = 256 << 20
NEAR_BYTES = 64 << 10
READ_BYTES = 8 << 20
#: Bytes of archives that a task reads about.
TASK_BYTES = 256 << 20
DATE = "2024-01-01T00:00:00Z"
#: Records with payloads below this size are never revisits.
LEAST_PAYLOAD = 0


def file_system(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of a path's scheme, and the path in it. A path without one could mean another place here than on the driver."""
    if "://" not in path:
        raise ValueError(f"{path} names no file system")
    if path.startswith("file://"):
        return arrow_fs.LocalFileSystem(), path.removeprefix("file://")
    scheme, _, rest = path.partition("://")
    return arrow_fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{rest}")


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    """One record as its own gzip member. A revisit has the HTTP header but no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if kind == "revisit" else http + payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Payload-Length: {len(payload)}"]
    if page_id is not None:
        head.append(f"WARC-Page-ID: {page_id}")
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to, digest)}", f"WARC-Refers-To-Page-ID: {refers_to}"]
    data = "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"
    pack = zlib.compressobj(4, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def parse_record(member: bytes) -> dict:
    """The fields of RECORD_SCHEMA of one gzip member; a response's payload must have the digest it states."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if not lines[0].startswith("WARC/") or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("no whole WARC record at this offset")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    payload = None
    if fields["WARC-Type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if digest_of(payload) != digest:
            raise ValueError(f"payload of record {fields['WARC-Record-ID']} is not what its digest says")
    number = lambda k: int(fields[k]) if k in fields else None
    return {
        "page_id": number("WARC-Page-ID"),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": number("WARC-Payload-Length"),
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": number("WARC-Refers-To-Page-ID"),
        "payload": payload,
    }


def _table(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in schema.split(", "))])


def write_archives(pages: DataFrame, folder: str, least_payload: int = LEAST_PAYLOAD) -> DataFrame:
    """Write a record for each row of pages (page_id, url, html) below folder; returns the stored index.

    Of records with equal payloads of at least least_payload bytes, that with the largest page_id is the
    response and the others revisit it. An archive's name has a random part, and only index rows of tasks that
    succeeded are returned, so a repeated task does no harm.

    Nulls: a null html is the empty payload; a null url leaves the URI out; a null page_id counts as less than
    any other, so such a row is a response only if no equal payload has an id. Repeated rows with the largest id are
    responses each. An empty table writes nothing and gives an empty index. Other columns of pages are not read.
    """
    since, folder = mark(), qualified(pages.sparkSession, folder)
    pages = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    slim = pages.select("page_id", F.sha1(F.col("html").cast("binary")).alias("digest"), F.octet_length("html").alias("size"))
    groups = slim.where(F.col("size") >= least_payload).groupBy("digest").agg(F.max("page_id").alias("largest"), F.count("*").alias("n"))
    # Stored, so that the join below has an exchange on each side and a digest of very many pages can be split.
    groups = stored(groups.where((F.col("n") > 1) & F.col("largest").isNotNull()).drop("n"), "warc-groups")
    revisits = slim.where(F.col("size") >= least_payload).join(groups, "digest").where(~F.col("page_id").eqNullSafe(F.col("largest")))
    revisits = stored(revisits.select("page_id", F.col("digest").alias("of"), "largest").distinct(), "warc-revisits")
    digest = F.sha1(F.col("html").cast("binary"))
    joined = pages.join(revisits, pages["page_id"].eqNullSafe(revisits["page_id"]) & (digest == revisits["of"]), "left").select(pages["page_id"], "url", "html", "largest", F.col("of").isNotNull().alias("again"))
    schema = _arrow(INDEX_SCHEMA)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, out, name, offset = None, None, "", 0
        for batch in batches:
            rows = []
            for page_id, url, html, largest, again in zip(*(c for c in batch.columns), strict=True):
                page_id, payload = page_id.as_py(), html.as_py().encode("utf-8")
                if out is None or offset >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    name, offset = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
                    files, path = file_system(name)
                    files.create_dir(path.rpartition("/")[0], recursive=True)
                    out = files.open_output_stream(path, compression=None)
                kind, digest, refers = "revisit" if again.as_py() else "response", digest_of(payload), largest.as_py()
                member = make_record(page_id, url.as_py(), payload, digest, kind, refers)
                out.write(member)
                rows.append({"page_id": page_id, "url": url.as_py(), "archive": name, "offset": offset, "length": len(member), "payload_bytes": len(payload), "payload_digest": digest, "record_type": kind, "refers_to": refers if kind == "revisit" else None})
                offset += len(member)
            yield _table(rows, schema)
        if out is not None:
            out.close()

    return result(joined.mapInArrow(write, INDEX_SCHEMA), "warc-index", since)


def read_archives(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records that rows of an index select, read back from their archives.

    The rows are dealt by ranges of (archive, offset) and sorted; ranges of one archive at most NEAR_BYTES apart
    are read together, up to READ_BYTES. With payloads=False the column payload is left out. An empty selection
    gives an empty result; index rows selected twice give their record twice.
    """
    spark, wanted = index.sparkSession, index.select("archive", "offset", "length")
    size = wanted.agg(F.sum("length")).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES))  # a count, or all index rows would be few enough for one task
    wanted = wanted.repartitionByRange(parts, "archive", "offset").sortWithinPartitions("archive", "offset")
    fields = RECORD_SCHEMA if payloads else RECORD_SCHEMA.rpartition(",")[0]
    schema = _arrow(fields)

    def fetch(archive: str, ranges: list[tuple[int, int]]) -> pa.RecordBatch:
        files, path = file_system(archive)
        with files.open_input_file(path) as f:
            first = ranges[0][0]
            f.seek(first)
            data = f.read(max(o + n for o, n in ranges) - first)
        rows = [parse_record(data[o - first : o - first + n]) for o, n in ranges]
        return _table([{k: r[k] for k in schema.names} for r in rows], schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, ranges, end = None, [], 0
        for batch in batches:
            for a, o, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if ranges and (a != archive or o - end > NEAR_BYTES or o + n - ranges[0][0] > READ_BYTES):
                    yield fetch(archive, ranges)
                    ranges = []
                archive = a
                ranges.append((o, n))
                end = max(end, o + n) if len(ranges) > 1 else o + n
        if ranges:
            yield fetch(archive, ranges)

    return wanted.mapInArrow(read, fields)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages to archives in the shared folder and read every record back, without payloads."""
    return read_archives(write_archives(pages, new_path(pages.sparkSession, "warc")), payloads=False)
