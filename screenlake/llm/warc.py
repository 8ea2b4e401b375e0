"""WARC archives: writing with revisits and segments, reading with segment reassembly.

Writing: every row is a record. A payload travels as the body of an HTTP message in chunked transfer framing; a
message longer than ``segment_bytes`` is cut into a first record and continuation records that name it by
WARC-Segment-Origin-ID, the last of which states WARC-Segment-Total-Length. Files come from Spark's text sink with
the record separator as line separator, so they commit atomically on any file system that Spark writes to; records
are bounded by the segment size and files by ``records_per_file``, which bounds the reader's memory.

Reading: whole records are decoded in the task that reads them. Only segments are shuffled: grouped by origin,
ordered by number, checked for gaps and total length, joined and decoded. A group is one message: rows that repeat
key and payload share an identifier, so the segments of each also name the row they were cut from (X-Copy). A revisit
is resolved by the identifier that it refers to: key, digest and size come from the response that has it.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenlake.llm.common import written

END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(key, digest: str) -> str:
    """Stable identifier of the response with this key and payload."""
    return f"<urn:uuid:{uuid.UUID(hashlib.sha256(f'{key}:{digest}'.encode()).hexdigest()[:32])}>"


def chunked(payload: bytes, size: int) -> bytes:
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """Body of a chunked message; chunk extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        at = line + 2
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk does not end where it should")
        out.append(body[at : at + size])
        at += size + 2


def http_payload(message: bytes) -> bytes:
    head, _, body = message.partition(END)
    fields = dict(line.split(b": ", 1) for line in head.lower().split(b"\r\n")[1:] if b": " in line)
    return unchunked(body) if fields.get(b"transfer-encoding") == b"chunked" else body


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    """Record without its final separator, which the sink adds."""
    lines = ["WARC/1.1", *(f"{name}: {value}" for name, value in fields if value is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + END + block


def records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of every record of a file."""
    if content[:2] == b"\x1f\x8b":
        content = gzip.decompress(content)
    at = 0
    while at < len(content):
        head = content.index(END, at)
        lines = content[at:head].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a record")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        start = head + len(END)
        end = start + int(fields["Content-Length"])
        if content[end : end + 4] != END:
            raise ValueError("a record does not end where it should")
        yield fields, content[start:end]
        at = end + 4


def write_archives(
    pages: DataFrame, folder: str, key: str = "page_id", body: str = "html", uri: str | None = "url", min_revisit: int = 100,
    segment_bytes: int = 1 << 16, chunk_bytes: int = 1 << 13, records_per_file: int = 1000, date: str = "2024-01-01T00:00:00Z",
) -> None:
    """Writes one record (or one segmented record) per row of ``pages`` below ``folder``.

    Of rows with equal payloads of at least ``min_revisit`` bytes the one with the smallest key is the response
    and the others are revisits of it; rows that repeat the smallest key are responses too. Shorter payloads,
    null or empty ones among them, are responses. A null key sorts after all others, and is a revisit if another
    row with that payload has a key. An empty table writes no record. Other columns are not read.
    """
    payload = F.coalesce(F.col(body).cast("binary"), F.lit(b""))
    frame = pages.select(F.col(key).cast("long").alias("key"), (F.col(uri) if uri else F.lit(None)).cast("string").alias("uri"), payload.alias("payload"))
    frame = frame.withColumn("digest", F.sha2("payload", 256))
    shared = frame.where(F.octet_length("payload") >= min_revisit).groupBy("digest").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n"))
    shared = written(shared.where("n > 1").select("digest", "first"), "shared")
    frame = frame.join(shared, "digest", "left").select("key", "uri", "payload", "digest", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                own, target, data, digest, first = (c[i].as_py() for c in batch.columns)
                common = [("WARC-Date", date), ("WARC-Target-URI", target and " ".join(target.split())), ("X-Key", own)]
                head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked" + END
                kind = ("Content-Type", "application/http;msgtype=response")
                sums = [("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Payload-Length", len(data))]
                if first is not None and own != first:
                    fields = [("WARC-Type", "revisit"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), *common, ("WARC-Profile", PROFILE)]
                    out.append(record([*fields, ("WARC-Refers-To", record_id(first, digest)), *sums, kind], head))
                    continue
                name, message = record_id(own, digest), head + chunked(data, chunk_bytes)
                parts = [message[at : at + segment_bytes] for at in range(0, len(message), segment_bytes)]
                first_fields = [("WARC-Type", "response"), ("WARC-Record-ID", name), *common, *sums, kind]
                copy = ("X-Copy", uuid.uuid4().hex if len(parts) > 1 else None)
                out.append(record([*first_fields, ("WARC-Segment-Number", 1 if len(parts) > 1 else None), copy], parts[0]))
                for number, part in enumerate(parts[1:], 2):
                    fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date)]
                    total = len(message) if number == len(parts) else None
                    out.append(record([*fields, ("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", number), ("WARC-Segment-Total-Length", total), copy], part))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    text = frame.mapInArrow(run, "record binary").select(F.col("record").cast("string"))
    sink = text.write.option("lineSep", END.decode()).option("compression", "gzip").option("maxRecordsPerFile", records_per_file)
    sink.text(folder)


FIELDS = "record_id string, record_type string, key long, refers_id string, digest string, copy string, segment int, total long, block binary"


def _scan(spark: SparkSession, folder: str, segments: bool) -> DataFrame:
    """Whole records, or segments only, of all files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("record_id", pa.string()), ("record_type", pa.string()), ("key", pa.int64()), ("refers_id", pa.string()), ("digest", pa.string()),
             ("copy", pa.string()), ("segment", pa.int32()), ("total", pa.int64()), ("block", pa.binary())]
        )
        number = lambda fields, name: int(fields[name]) if name in fields else None
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for fields, block in records(content.as_py()):
                    if segments == ("WARC-Segment-Number" in fields):
                        name = fields.get("WARC-Segment-Origin-ID", fields["WARC-Record-ID"])
                        digest = fields.get("WARC-Payload-Digest", "").removeprefix("sha256:") or None
                        values = (number(fields, x) for x in ("WARC-Segment-Number", "WARC-Segment-Total-Length"))
                        rows.append((name, fields["WARC-Type"], number(fields, "X-Key"), fields.get("WARC-Refers-To"), digest, fields.get("X-Copy"), *values, block))
                for at in range(0, len(rows), 256):
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows[at : at + 256]), schema.types)]
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return spark.read.format("binaryFile").load(folder).select("content").mapInArrow(run, FIELDS)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """(key, record_type, refers_to, payload, payload_digest, payload_bytes), one row per record of ``folder``.

    Digest and size of a response are computed from its payload. A revisit has no payload; its digest, its size and
    ``refers_to`` are those of the response with the identifier that it refers to. A stated digest that differs from
    the payload's, a revisit whose response is not there or has another digest, a gap between segments and a wrong
    total length are errors. A folder without records gives no rows.
    """
    whole = _scan(spark, folder, segments=False)

    def joined(rows):
        rows = rows.sort_values("segment", kind="stable")
        if list(rows["segment"]) != list(range(1, len(rows) + 1)):
            raise ValueError(f"segments are missing in {rows['record_id'].iloc[0]}")
        message = b"".join(rows["block"])
        if rows["total"].iloc[-1] != len(message):
            raise ValueError(f"total length differs in {rows['record_id'].iloc[0]}")
        return rows.head(1).assign(block=[message], total=len(message))

    cut = _scan(spark, folder, segments=True).groupBy("record_id", "copy").applyInPandas(joined, FIELDS)

    def payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for kind, digest, block in zip(batch.column(1), batch.column(4), batch.column(8)):
                data = http_payload(block.as_py()) if kind.as_py() == "response" else None
                if data is not None and hashlib.sha256(data).hexdigest() != digest.as_py():
                    raise ValueError("payload digest differs")
                found.append(data)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in (0, 2, 1, 3)), pa.array(found, pa.binary()), batch.column(4)], DECODED)

    schema = "record_id string, key long, record_type string, refers_id string, payload binary, payload_digest string"
    read = written(whole.unionByName(cut).mapInArrow(payloads, schema), "decoded")
    read = read.withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    responses = read.where("record_type = 'response'")
    named = responses.groupBy("record_id").agg(F.first("key").alias("refers_to"), F.first("payload_digest").alias("own_digest"), F.first("payload_bytes").alias("own_bytes"))
    named = named.withColumnRenamed("record_id", "refers_id")
    found = read.where("record_type = 'revisit'").join(named, "refers_id", "left")
    right = F.coalesce(F.col("own_digest") == F.col("payload_digest"), F.lit(False))
    wrong = F.raise_error(F.concat(F.lit("a revisit refers to no response with its payload: "), F.coalesce("refers_id", F.lit("none")))).cast("string")
    revisits = found.select("key", "record_type", "refers_to", "payload", F.when(right, F.col("own_digest")).otherwise(wrong).alias("payload_digest"), F.col("own_bytes").alias("payload_bytes"))
    columns = ["key", "record_type", F.lit(None).cast("long").alias("refers_to"), "payload", "payload_digest", "payload_bytes"]
    return responses.select(*columns).unionByName(revisits)


DECODED = ["record_id", "key", "record_type", "refers_id", "payload", "payload_digest"]
