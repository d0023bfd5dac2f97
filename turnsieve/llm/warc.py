"""Legacy archives (ARC, versions 1 and 2) to WARC, and back to rows.

An ARC file starts with a version block that names the fields of its header lines; every record is a header
line, as many bytes as the line declares, and a newline. Its block is a web server's answer: head, blank line,
payload. The converter follows the declared lengths, never what a payload looks like, and makes
WARC records with the same target, an identifier derived from the record, an ISO date, and digests. Of
equal payloads of at least ``LEAST`` bytes one is a response, the others are revisits that name it.

Files are written with Spark's text writer, with the format's separator as the end of a line, one file for
each task, compressed; so they commit as any table does. They are read as binary files, each taken apart
where it is read. What is shared between tasks to find equal payloads are digests, never payloads.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_folder, written

LEAST = 100
DATE = "20200101000000"

# Field names of the header lines of both versions, and the profile of a revisit.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = (
    "page_id bigint, url string, date string, payload_bytes bigint, payload_digest string, record_id string, file string, at bigint"
)


def _columns(rows: list[tuple], kinds: str) -> pa.RecordBatch:
    arrow = {"bigint": pa.int64(), "string": pa.string()}
    fields = [k.split() for k in kinds.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return pa.record_batch([pa.array(c, arrow[t]) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def _batches(rows: Iterator[tuple], kinds: str, weight: Callable[[tuple], int]) -> Iterator[pa.RecordBatch]:
    """Rows in batches of some megabytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weight(row) + 100
        if size > 8 << 20:
            yield _columns(held, kinds)
            held, size = [], 0
    if held:
        yield _columns(held, kinds)


def write_arc(pages: DataFrame, path: str, date: str = DATE, id_col: str = "page_id", url_col: str = "url", text_col: str = "html") -> None:
    """Pages as ARC files, by turns of version 1 and 2. Null payloads are empty, null addresses are made up."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        part = TaskContext.get().partitionId()
        version = 1 + part % 2
        about = f"{version} 0 archive\n{ARC_FIELDS[version]}\n"
        rest = "" if version == 1 else f"200 - - 0 part-{part} "
        yield (f"filedesc://part-{part}.arc 0.0.0.0 {date} text/plain {rest}{len(about)}\n{about}",)
        for batch in batches:
            for page, url, html in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                url = re.sub(r"\s", lambda m: f"%{ord(m.group()):02X}", url or "") or f"urn:page:{page}"
                html = html or ""
                size = len(html.encode("utf-8", "surrogatepass"))
                own = "" if page is None else f"X-Page-Id: {page}\r\n"
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}Content-Length: {size}\r\n\r\n"
                yield (f"{url} 0.0.0.0 {date} text/html {rest}{len(head) + size}\n{head}{html}",)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(rows(batches), "value string", lambda r: len(r[0]))

    slim = pages.select(F.col(id_col).cast("bigint"), F.col(url_col).cast("string"), F.col(text_col).cast("string"))
    slim.mapInArrow(run, "value string").write.option("compression", "gzip").option("lineSep", "\n").text(path)


class _Head:
    """The head of a web server's answer."""

    def __init__(self, block: bytes):
        self.raw, _, self.payload = block.partition(b"\r\n\r\n")
        lines = self.raw.decode("utf-8", "replace").split("\r\n")[1:]
        self.fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        page = self.fields.get("x-page-id")
        self.page = int(page) if page else None


def arc_records(content: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """``(place, header fields, block)`` of the records of one compressed ARC file, after its version block."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content)), 1 << 20)
    names: list[str] = []
    at = 0
    while line := stream.readline():
        start, at = at, at + len(line)
        fields = line.decode("utf-8", "replace").rstrip("\r\n").split(" ")
        if fields == [""]:
            continue
        length = int(fields[-1])
        block = stream.read(length)
        if len(block) != length:
            raise ValueError(f"record at {start}: {len(block)} of {length} bytes")
        stream.readline()
        at += length + 1
        if fields[0].startswith("filedesc:"):
            version, described = block.decode("utf-8", "replace").split("\n")[:2]
            if int(version.split(" ")[0]) not in ARC_FIELDS:
                raise ValueError(f"version {version}")
            names = described.split(" ")
        elif len(fields) == len(names):
            yield start, dict(zip(names, fields, strict=True)), block
        else:
            raise ValueError(f"record at {start}: {len(fields)} of {len(names)} fields")


def _converted(file: str, content: bytes) -> Iterator[tuple[tuple, _Head]]:
    """Rows of ``RECORD``, and the answer's head, for each record of an ARC file."""
    for at, fields, block in arc_records(content):
        head = _Head(block)
        digest = hashlib.sha256(head.payload).hexdigest()
        stamp = fields["Archive-date"].ljust(14, "0")
        date = f"{stamp[:4]}-{stamp[4:6]}-{stamp[6:8]}T{stamp[8:10]}:{stamp[10:12]}:{stamp[12:14]}Z"
        made = uuid.uuid5(uuid.NAMESPACE_URL, f"{fields['URL']} {date} {head.page} {digest} {file.rsplit('/', 1)[-1]} {at}")
        yield (head.page, fields["URL"], date, len(head.payload), digest, f"<urn:uuid:{made}>", file, at), head


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """Rows of ``RECORD`` for each record, without payloads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = _converted(batch.column(0)[i].as_py(), batch.column(1)[i].as_py())
                yield from _batches((row for row, _ in found), RECORD, lambda r: 200)

    return _files(spark, path).mapInArrow(run, RECORD)


def revisits(records: DataFrame, least: int = LEAST) -> DataFrame:
    """``(file, at, ref_id, ref_url, ref_date)`` of the records that repeat the payload of another.

    The response is the one with the smallest page id; records without an id come last; of equal ids the first
    in the archive is taken. A payload that a third of all records share is one row of a partial minimum.
    """
    large = records.where(F.col("payload_bytes") >= least)
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "file", "at", "record_id", "url", "date")
    first = large.groupBy("payload_digest").agg(F.min(order).alias("r"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = large.select("payload_digest", "file", "at").join(first, "payload_digest")
    return again.where(~((F.col("file") == F.col("r.file")) & (F.col("at") == F.col("r.at")))).select(
        "file", "at", F.col("r.record_id").alias("ref_id"), F.col("r.url").alias("ref_url"), F.col("r.date").alias("ref_date")
    )


def _lines(*fields: tuple[str, object]) -> str:
    return "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None) + "\r\n"


def convert(spark: SparkSession, arc: str, path: str, least: int = LEAST) -> None:
    """The ARC files under ``arc`` as WARC files under ``path``: responses and revisits."""
    records = written(read_arc(spark, arc), "records")
    known = written(revisits(records, least), "revisits")
    full = RECORD + ", head string, payload string"

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = _converted(batch.column(0)[i].as_py(), batch.column(1)[i].as_py())
                rows = ((*row, h.raw.decode(), h.payload.decode()) for row, h in found)
                yield from _batches(rows, full, lambda r: len(r[-1]))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        software = "software: turnsieve\r\nformat: WARC File Format 1.1"
        made = uuid.uuid5(uuid.NAMESPACE_URL, f"{path.rsplit('/', 1)[-1]} {TaskContext.get().partitionId()}")
        info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{made}>"), ("WARC-Date", "2020-01-01T00:00:00Z")]
        yield (_lines(*info, ("Content-Type", "application/warc-fields"), ("Content-Length", len(software))) + software,)
        for batch in batches:
            for r in batch.to_pylist():
                again = r["ref_id"] is not None
                block = r["head"] + "\r\n\r\n" + ("" if again else r["payload"])
                fields = _lines(
                    ("WARC-Type", "revisit" if again else "response"),
                    ("WARC-Record-ID", r["record_id"]),
                    ("WARC-Date", r["date"]),
                    ("WARC-Target-URI", r["url"]),
                    ("WARC-Profile", REVISIT if again else None),
                    ("WARC-Refers-To", r["ref_id"]),
                    ("WARC-Refers-To-Target-URI", r["ref_url"]),
                    ("WARC-Refers-To-Date", r["ref_date"]),
                    ("WARC-Payload-Digest", f"sha256:{r['payload_digest']}"),
                    ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block.encode()).hexdigest()}"),
                    ("Content-Type", "application/http; msgtype=response"),
                    ("Content-Length", len(block.encode())),
                )
                yield (fields + block,)

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(rows(batches), "value string", lambda r: len(r[0]))

    whole = _files(spark, arc).mapInArrow(parse, full).join(known, ["file", "at"], "left")
    wanted = whole.select("record_id", "url", "date", "payload_digest", "head", "payload", "ref_id", "ref_url", "ref_date")
    wanted.mapInArrow(render, "value string").write.option("compression", "gzip").option("lineSep", "\r\n\r\n").text(path)


def warc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """``(header fields, block)`` of the records of one compressed WARC file."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content)), 1 << 20)
    while line := stream.readline():
        if line in (b"\r\n", b"\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a record: {line[:40]!r}")
        fields: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            k, _, v = line.decode("utf-8", "replace").partition(":")
            fields[k.strip()] = v.strip()
        block = stream.read(int(fields["Content-Length"]))
        yield fields, block


WARC_ROW = (
    "page_id bigint, url string, date string, record_type string, record_id string, ref_id string, payload_bytes bigint, payload_digest string"
)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Rows of ``WARC_ROW`` for each response and revisit; digests of responses are computed again and compared."""

    def rows(content: bytes) -> Iterator[tuple]:
        for fields, block in warc_records(content):
            kind = fields["WARC-Type"]
            if kind not in ("response", "revisit"):
                continue
            head, digest = _Head(block), fields["WARC-Payload-Digest"].removeprefix("sha256:")
            size = int(head.fields["content-length"])
            if kind == "response" and (hashlib.sha256(head.payload).hexdigest() != digest or len(head.payload) != size):
                raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
            yield head.page, fields["WARC-Target-URI"], fields["WARC-Date"], kind, fields["WARC-Record-ID"], fields.get("WARC-Refers-To"), size, digest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from _batches(rows(batch.column(1)[i].as_py()), WARC_ROW, lambda r: 200)

    return _files(spark, path).mapInArrow(run, WARC_ROW)


def with_references(records: DataFrame) -> DataFrame:
    """Records read from WARC files with ``refers_to``, the page id of the response that a revisit names.

    Only revisits are joined: responses name no other record.
    """
    responses = records.where("record_type = 'response'")
    named = responses.select(F.col("record_id").alias("ref_id"), F.col("page_id").alias("refers_to"))
    revisits = records.where("record_type = 'revisit'").join(named, "ref_id", "left")
    kind = records.schema["page_id"].dataType
    return responses.withColumn("refers_to", F.lit(None).cast(kind)).unionByName(revisits)


def round_trip(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Pages as ARC files, converted to WARC files and read back: rows of ``WARC_ROW`` with ``refers_to``.

    Ids are BIGINT (others are cast); null ids and repeated rows stay. Null payloads are empty, payloads of any length
    are whole. Of equal ids with equal payloads one is the response. Other columns are left out, whatever
    their names; an empty table gives no rows.
    """
    spark = pages.sparkSession
    arc, warc = new_folder(spark, "arc"), new_folder(spark, "warc")
    write_arc(pages, arc)
    convert(spark, arc, warc, least)
    return with_references(written(read_warc(spark, warc), "warc-records"))
