"""Legacy archive converter: ARC files (version 1 and 2) to WARC files.

Reading ARC: the version block of each file names its version; the version fixes the fields of the
header lines (version 1: url, IP, date, type, length; version 2 adds result code,
checksum, location, offset and file name before the length). A record's bytes are taken by the
declared length, never by looking for the next header. Url, IP and date are the first three
fields and the fixed number of fields at the end is taken from there, so a type with spaces is read right.

Writing WARC: each ARC record becomes an equivalent WARC record. The identifier is a UUID made from
the archive's name and the record's offset (the same in each attempt of a task), the 14-digit
date becomes ISO form, HTTP blocks become `response` records and others `resource`; block and
payload digests are SHA-1. Of responses with equal payloads of at least `REVISIT_BYTES` bytes
the one with the largest key stays a response and the others become `revisit` records that refer to it
and keep only their HTTP header.

Which records are revisits is decided on digests (map-side combined, the lookup split by Spark when a
payload is very frequent); payload bytes are shuffled once, by record. Archives are as large as an
input split and are read whole by one task each: files of `spark.sql.files.maxPartitionBytes`
or less bound a task's memory.

Null payloads count as empty; null urls and keys are written empty and come back as null. Equal
payloads with the same key: one of them (by identifier) is the response. Repeated rows are records of
their own. An empty table writes no record and reads back empty. Only the named columns are
read, so extra columns cannot clash.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator
from uuid import NAMESPACE_URL, uuid5

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.llm.common import stage

REVISIT_BYTES = 1_000
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
#: Fields of a header line, by ARC version (fixed by the format).
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
#: A partition's first row has 0 in these bits of monotonically_increasing_id().
_ROW_BITS = (1 << 33) - 1


def _write(values: DataFrame, path: str, separator: str) -> None:
    """Write one string column, byte for byte, one gzip file for each task."""
    values.write.option("lineSep", separator).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)


def _string(binary: Column) -> Column:
    return binary.cast("string")


# --- ARC ------------------------------------------------------------------------------------

def http_block(payload: Column, mime: str, **headers: Column) -> Column:
    """An HTTP response (binary) with this payload (binary) and these headers."""
    lines = [F.lit(f"HTTP/1.1 200 OK\r\nContent-Type: {mime}\r\nContent-Length: "), F.octet_length(payload).cast("string"), F.lit("\r\n")]
    for name, value in headers.items():
        lines += [F.lit(f"{name.replace('_', '-')}: "), F.coalesce(value.cast("string"), F.lit("")), F.lit("\r\n")]
    return F.concat(F.concat(*lines, F.lit("\r\n")).cast("binary"), payload)


def write_arc(records: DataFrame, path: str, mime: str = "text/html") -> None:
    """Write rows (url, date: 14 digits, block: binary) as ARC files, versions 1 and 2 by turns, one for each task."""
    url = F.regexp_replace(F.coalesce("url", F.lit("")), r"\s", "%20")
    length = F.octet_length("block").cast("string")
    version = F.pmod(F.spark_partition_id(), F.lit(2)) + 1
    name = F.concat(F.lit("part-"), F.spark_partition_id().cast("string"), F.lit(".arc"))

    def of_version(v: int) -> tuple[Column, Column]:
        names = " ".join(ARC_FIELDS[v])
        about = f"{v} 0 reelhouse\n{names}\n\n"
        size = str(len(about))
        extra = [] if v == 1 else ["0", "text/plain", "200", "-", "-", "0", name, size]
        opening = F.concat_ws(" ", F.concat(F.lit("filedesc://"), name), F.lit("0.0.0.0"), F.lit("20240101000000"),
                              *([F.lit("text/plain"), F.lit(size)] if v == 1 else
                                [F.lit("text/plain"), F.lit("200"), F.lit("-"), F.lit("-"), F.lit("0"), extra[6], F.lit(size)]))
        header = F.concat_ws(" ", url, F.lit("0.0.0.0"), "date", F.lit(mime),
                             *([] if v == 1 else [F.lit("200"), F.lit("-"), F.lit("-"), F.lit("0"), name]), length)
        return F.concat(opening, F.lit("\n" + about)), header

    (open1, head1), (open2, head2) = of_version(1), of_version(2)
    first = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)) == 0
    start = F.when(first, F.when(version == 1, open1).otherwise(open2)).otherwise(F.lit(""))
    value = F.concat(F.concat(start, F.when(version == 1, head1).otherwise(head2), F.lit("\n")).cast("binary"), F.col("block"))
    _write(records.select(_string(value).alias("value")), path, "\n")


def parse_arc(stream: io.BufferedIOBase) -> Iterator[dict]:
    """The records of an ARC file: header fields, offset and block."""
    at, version = 0, 0
    while True:
        line = stream.readline()
        if not line:
            return
        if line == b"\n":          # between records
            at += 1
            continue
        fields = line.rstrip(b"\r\n").decode("utf-8", "replace").split(" ")
        length = int(fields[-1])
        block = stream.read(length)
        if len(block) != length:
            raise ValueError(f"ARC record at {at} is shorter than declared")
        if fields[0].startswith("filedesc://"):
            version = int(block.split(b" ", 1)[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"unknown ARC version {version}")
        elif not version:
            raise ValueError("an ARC file must begin with its version block")
        else:
            tail = len(ARC_FIELDS[version]) - 4
            yield {"offset": at, "version": version, "url": fields[0], "ip": fields[1], "date": fields[2], "mime": " ".join(fields[3:-tail]), "block": block}
        at += len(line) + length


def _opened(content: bytes) -> io.BufferedIOBase:
    return gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)


def _http_fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if x)}


def _payload(block: bytes, http: bool) -> int:
    """Where the payload begins."""
    if not http:
        return 0
    at = block.find(b"\r\n\r\n")
    return at + 4 if at >= 0 else len(block)


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches of about ``size`` bytes; the last column is the large one (bytes)."""
    held, total = [], 0
    for r in rows:
        held.append(r)
        total += len(r[-1] or b"") + 500
        if total >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, total = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


_CONVERTED = T.StructType([T.StructField(n, k) for n, k in [
    ("record_id", T.StringType()), ("kind", T.StringType()), ("url", T.StringType()), ("ip", T.StringType()), ("iso_date", T.StringType()), ("mime", T.StringType()),
    ("key", T.LongType()), ("payload_at", T.IntegerType()), ("payload_bytes", T.LongType()), ("payload_sha1", T.StringType()), ("block_sha1", T.StringType()), ("head_sha1", T.StringType()), ("block", T.BinaryType())]])


def _base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def converted(spark: SparkSession, path: str, key: str, with_block: bool = True) -> DataFrame:
    """The ARC records of ``path`` with what WARC needs: identifier, type, ISO date, digests; ``key`` is an HTTP header (a long)."""
    schema = T.StructType(_CONVERTED.fields if with_block else _CONVERTED.fields[:-1])
    root = path.split("://")[-1].rstrip("/") + "/"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = pa.schema([pa.field(f.name, {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[f.dataType.simpleString()]) for f in schema])

        def rows() -> Iterator[tuple]:
            for b in batches:
                for name, content in zip(b.column(0), b.column(1), strict=True):
                    archive = name.as_py().partition(root)[2] or name.as_py()       # equal names in two folders are two archives
                    for r in parse_arc(_opened(memoryview(content.as_buffer()).tobytes())):
                        block, d = r["block"], r["date"]
                        http = block.startswith(b"HTTP/")
                        at = _payload(block, http)
                        fields = _http_fields(block[:at]) if http else {}
                        own = fields.get(key.lower(), "")
                        body = memoryview(block)[at:]
                        row = (f"<urn:uuid:{uuid5(NAMESPACE_URL, f'{archive}#{r["offset"]}')}>", "response" if http else "resource", r["url"] or None, r["ip"],
                               f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z", r["mime"], int(own) if own else None, at, len(body),
                               _base32(body), _base32(block), _base32(block[:at]))
                        yield (*row, block) if with_block else row
        yield from _batches(rows(), arrow) if with_block else _narrow(rows(), arrow)

    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content").mapInArrow(run, schema)


def _narrow(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    yield from (b.select(schema.names) for b in _batches(((*r, None) for r in rows), schema.append(pa.field("_", pa.binary()))))


# --- WARC -----------------------------------------------------------------------------------

def revisits(narrow: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """(record_id, refers_to) of the records that repeat the payload of another one."""
    whole = narrow.filter((F.col("kind") == "response") & (F.col("payload_bytes") >= least))
    first = whole.groupBy("payload_sha1").agg(F.max(F.struct("key", "record_id")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    first = stage(first.select("payload_sha1", F.col("first.record_id").alias("refers_to")), "warc-first")
    return whole.join(first, "payload_sha1").filter("record_id <> refers_to").select("record_id", "refers_to")


def write_warc(records: DataFrame, refers: DataFrame, path: str) -> None:
    """Write converted ARC records as WARC files; those in ``refers`` (record_id, refers_to) as revisits."""
    def line(name: str, value: Column | str) -> Column:
        value = F.lit(value) if isinstance(value, str) else value
        return F.concat(F.lit(f"{name}: "), F.coalesce(value, F.lit("")), F.lit("\r\n"))

    again = F.col("refers_to").isNotNull()
    block = F.when(again, F.substring("block", F.lit(1), F.col("payload_at"))).otherwise(F.col("block"))
    head = F.concat(
        F.lit("WARC/1.0\r\n"), line("WARC-Type", F.when(again, "revisit").otherwise(F.col("kind"))), line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Date", F.col("iso_date")), line("WARC-Target-URI", F.col("url")), line("WARC-IP-Address", F.col("ip")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_sha1")),
        line("WARC-Block-Digest", F.concat(F.lit("sha1:"), F.when(again, F.col("head_sha1")).otherwise(F.col("block_sha1")))),
        F.when(again, F.concat(line("WARC-Refers-To", F.col("refers_to")), line("WARC-Profile", PROFILE))).otherwise(F.lit("")),
        line("Content-Type", F.when(F.col("kind") == "response", "application/http; msgtype=response").otherwise(F.col("mime"))),
        line("Content-Length", F.octet_length(F.col("_block")).cast("string")), F.lit("\r\n"))
    joined = records.join(refers, "record_id", "left").withColumn("_block", block)
    _write(joined.select(_string(F.concat(head.cast("binary"), F.col("_block"), F.lit("\r\n").cast("binary"))).alias("value")), path, "\r\n")


def parse_warc(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields by lower-case name, block) of each record, by declared length."""
    while True:
        line = stream.readline()
        if not line:
            return
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8", "replace").rstrip("\r\n").partition(": ")
            fields[name.lower()] = value
        length = int(fields["content-length"])
        block = stream.read(length)
        if len(block) != length:
            raise ValueError("WARC record is shorter than declared")
        yield fields, block


def read_warc(spark: SparkSession, path: str, key: str) -> DataFrame:
    """(record_id, record_type, refers_to_id, url, warc_date, key, payload_bytes, payload_digest) of each record read.

    A response's size and digest are those of the payload read, checked against the declared digest;
    a revisit's are the declared ones.
    """
    names = ["record_id", "record_type", "refers_to_id", "url", "warc_date", "key", "payload_bytes", "payload_digest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string()] * 5 + [pa.int64(), pa.int64(), pa.string()]

        def rows() -> Iterator[tuple]:
            for b in batches:
                for content in b.column(0):
                    for f, block in parse_warc(_opened(memoryview(content.as_buffer()).tobytes())):
                        http = block.startswith(b"HTTP/")
                        at = _payload(block, http)
                        inner = _http_fields(block[:at]) if http else {}
                        declared = base64.b32decode(f["warc-payload-digest"].removeprefix("sha1:")).hex()
                        if f["warc-type"] == "revisit":
                            size = int(inner["content-length"])
                        else:
                            size = len(block) - at
                            if hashlib.sha1(memoryview(block)[at:]).hexdigest() != declared:
                                raise ValueError(f"payload digest of {f['warc-record-id']} does not match")
                        own = inner.get(key.lower(), "")
                        yield (f["warc-record-id"], f["warc-type"], f.get("warc-refers-to"), f.get("warc-target-uri") or None, f["warc-date"],
                               int(own) if own else None, size, declared)
        yield from _narrow(rows(), pa.schema([pa.field(n, k) for n, k in zip(names, kinds, strict=True)]))

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("content").mapInArrow(run, "record_id string, record_type string, refers_to_id string, url string, warc_date string, key long, payload_bytes long, payload_digest string")


def convert(spark: SparkSession, arc_path: str, warc_path: str, key: str) -> None:
    """Convert all ARC files below ``arc_path`` to WARC files below ``warc_path``."""
    narrow = stage(converted(spark, arc_path, key, with_block=False), "warc-narrow")
    write_warc(converted(spark, arc_path, key), stage(revisits(narrow), "warc-revisits"), warc_path)
