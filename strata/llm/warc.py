"""Operator 1, WARC: archives written and read as a chunked record table.

A payload of any size travels as rows of (record, chunk number, bytes). Writing,
a record's chunks are hashed and appended one after the other; reading, a file
is decoded as a stream and each chunk row carries the running SHA-1 of the
payload up to and with it, so no task ever holds a whole record beyond the cell
it was given, and the last chunk's digest is the payload's.

Records with equal payloads (by SHA-1 and length) of at least ``min_bytes`` are
written once: the smallest page id is the response, the others are revisits
that refer to it and have no block. Groups are found on (id, digest, length)
rows only, pre-aggregated before the shuffle; digests found once need no join.

Each partition writes one gzip archive (a member per record) in the shared
folder, under a new name per attempt; the manifest that Spark writes says which
files count, so a lost or repeated task does no harm.

Defined results: a null payload counts as empty, a null url as an empty target.
Rows that repeat a page id and its payload are each written; those with the
group's smallest id are all responses. Null ids never become the response of a
group that has another id; a group of null ids alone is all responses. An empty
table gives no records. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import cut, open_fs, scratch_path, table

CHUNK_BYTES = 1 << 20
READ_BYTES = 1 << 18
GZIP_LEVEL = 4
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# The archive date of every record; fixed, so that equal input gives equal files.
DATE = "2000-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a binary column."""
    digits = F.sha1(payload)
    parts = []
    for i in range(8):  # five hexadecimal digits are four base32 digits
        d = F.lpad(F.conv(F.substring(digits, 5 * i + 1, 5), 16, 32), 4, "0")
        parts.append(F.translate(d, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"))
    return F.concat(*parts)


def plan_records(pages: DataFrame, min_bytes: int = 0, key: str = "page_id",
                 url: str = "url", payload: str = "html") -> DataFrame:
    """``page_id, url, payload, digest, n_bytes, record_type, refers_to`` per row."""
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("url"),
        F.coalesce(F.encode(F.col(payload).cast("string"), "UTF-8"), F.lit(b"")).alias("payload"))
    rows = (rows.withColumn("digest", base32_sha1(F.col("payload")))
            .withColumn("n_bytes", F.octet_length("payload").cast("long")))
    groups = (rows.filter(F.col("n_bytes") >= min_bytes).groupBy("digest", "n_bytes")
              .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") > 1).select("digest", "n_bytes", "first_id"))
    joined = rows.join(cut(groups, "warc-groups"), ["digest", "n_bytes"], "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select(
        "page_id", "url", "payload", "digest", "n_bytes",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"))


def chunk_table(records: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Records as rows of at most ``chunk_bytes`` payload bytes, in order.

    A record without a block (empty or revisit) has one chunk without bytes.
    """
    block = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    last = F.greatest(F.lit(0), F.ceil(F.octet_length("_block") / F.lit(chunk_bytes)).cast("int") - 1)
    return (records.withColumn("_block", block)
            .withColumn("chunk_no", F.explode(F.sequence(F.lit(0), last)))
            .select("page_id", "url", "digest", "n_bytes", "record_type", "refers_to",
                    "chunk_no", (F.col("chunk_no") == last).alias("is_last"),
                    F.substring(F.col("_block"), F.col("chunk_no") * F.lit(chunk_bytes) + 1,
                                F.lit(chunk_bytes)).alias("data")))


def _header(row: dict, block_bytes: int) -> bytes:
    record_id = uuid.uuid5(uuid.NAMESPACE_URL, f"page:{row['page_id']}:{row['digest']}")
    lines = [
        "WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <urn:uuid:{record_id}>",
        f"WARC-Date: {DATE}",
        # line ends and other controls would end the header line early
        f"WARC-Target-URI: {''.join(c if c.isprintable() else f'%{ord(c):02X}' for c in row['url'])}",
        f"WARC-Payload-Digest: sha1:{row['digest']}",
        "Content-Type: text/html; charset=utf-8",
        f"X-Page-ID: {'' if row['page_id'] is None else row['page_id']}",
        f"X-Payload-Length: {row['n_bytes']}",
    ]
    if row["record_type"] == "revisit":
        lines += [f"WARC-Profile: {REVISIT_PROFILE}",
                  f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, 'page:%s:%s' % (row['refers_to'], row['digest']))}>",
                  f"X-Refers-To-Page-ID: {row['refers_to']}"]
    lines.append(f"Content-Length: {block_bytes}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


class _RecordSink:
    """Appends records, chunk by chunk, to a gzip archive."""

    def __init__(self, uri: str):
        fs, path = open_fs(uri)
        fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.out = fs.open_output_stream(path)
        self.records = 0

    def chunk(self, row: dict) -> None:
        if row["chunk_no"] == 0:
            self.zip = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
            self.sha = hashlib.sha1()
            self.size = 0
            self.out.write(self.zip.compress(
                _header(row, row["n_bytes"] if row["record_type"] == "response" else 0)))
        data = row["data"] or b""
        self.sha.update(data)
        self.size += len(data)
        self.out.write(self.zip.compress(data))
        if row["is_last"]:
            if row["record_type"] == "response":
                found = base64.b32encode(self.sha.digest()).decode()
                if (found, self.size) != (row["digest"], row["n_bytes"]):
                    raise ValueError(f"chunks of page {row['page_id']} do not make its payload")
            self.out.write(self.zip.compress(b"\r\n\r\n") + self.zip.flush())
            self.records += 1

    def close(self) -> None:
        self.out.close()


def write_warc(chunks: DataFrame, out_dir: str) -> DataFrame:
    """Write chunk rows (a record's chunks in order, in one partition); returns the manifest."""

    def write(batches):
        uri = f"{out_dir}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        sink = None
        for batch in batches:
            for row in batch.to_pylist():
                sink = sink or _RecordSink(uri)
                sink.chunk(row)
        if sink is not None:
            sink.close()
            yield pa.RecordBatch.from_pylist([{"path": uri, "records": sink.records}])

    return cut(chunks.mapInArrow(write, "path string, records long"), "warc-manifest")


def _bytes_of(uri: str):
    """Decoded bytes of a gzip archive, a block at a time."""
    fs, path = open_fs(uri)
    with fs.open_input_stream(path) as stream:
        unzip, rest = zlib.decompressobj(31), b""
        while True:
            raw = rest or stream.read(READ_BYTES)
            if not raw:
                return
            out = unzip.decompress(raw, READ_BYTES)
            rest = unzip.unconsumed_tail
            if unzip.eof:
                rest = unzip.unused_data
                unzip = zlib.decompressobj(31)
            if out:
                yield out


def read_records(uri: str, chunk_bytes: int):
    """(header, chunk number, bytes, running SHA-1 object, size so far, is last) of a file."""
    source, buffer = _bytes_of(uri), bytearray()

    def fill() -> bool:
        piece = next(source, None)
        if piece is None:
            return False
        buffer.extend(piece)
        return True

    while True:
        while (end := buffer.find(b"\r\n\r\n")) < 0:
            if not fill():
                if buffer.strip():
                    raise ValueError(f"{uri}: the archive ends inside a header")
                return
        lines = bytes(buffer[:end]).decode().split("\r\n")
        del buffer[:end + 4]
        header = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
        left, number, sha, size = int(header["Content-Length"]), 0, hashlib.sha1(), 0
        while True:
            want = min(left, chunk_bytes)
            while len(buffer) < want:
                if not fill():
                    raise ValueError(f"{uri}: the archive ends inside a record")
            data = bytes(buffer[:want])
            del buffer[:want]
            left -= want
            size += want
            sha.update(data)
            yield header, number, data, sha, size, left == 0
            if left == 0:
                break
            number += 1
        while len(buffer) < 4:
            if not fill():
                raise ValueError(f"{uri}: a record without its end")
        if buffer[:4] != b"\r\n\r\n":
            raise ValueError(f"{uri}: a record is longer than its header says")
        del buffer[:4]


CHUNK_SCHEMA = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, "
                "payload_digest string, chunk_no long, chunk_bytes long, is_last boolean, "
                "running_digest string, data binary")


def read_warc(manifest: DataFrame, chunk_bytes: int = CHUNK_BYTES, with_data: bool = True) -> DataFrame:
    """The chunked record table of the archives that ``manifest`` lists.

    ``payload_digest`` and ``payload_bytes`` are the whole payload's: of a
    response as computed from its chunks so far (whole at the last chunk), of a
    revisit as its header says, because its payload is the response's.
    """

    def read(batches):
        for batch in batches:
            for uri in batch["path"].to_pylist():
                rows, held = [], 0
                for h, number, data, sha, size, last in read_records(uri, chunk_bytes):
                    running = base64.b32encode(sha.digest()).decode()
                    response = h["WARC-Type"] == "response"
                    stated = h["WARC-Payload-Digest"].removeprefix("sha1:")
                    if response and last and running != stated:
                        raise ValueError(f"{uri}: a payload does not have its digest")
                    rows.append({
                        "page_id": int(h["X-Page-ID"]) if h["X-Page-ID"] else None,
                        "url": h["WARC-Target-URI"], "record_type": h["WARC-Type"],
                        "refers_to": int(h["X-Refers-To-Page-ID"]) if "X-Refers-To-Page-ID" in h else None,
                        "payload_bytes": size if response else int(h["X-Payload-Length"]),
                        "payload_digest": running if response else stated,
                        "chunk_no": number, "chunk_bytes": len(data), "is_last": last,
                        "running_digest": running, "data": data if with_data else None})
                    held += len(data) if with_data else 0
                    if held >= 8 * chunk_bytes or len(rows) >= 4096:
                        yield pa.RecordBatch.from_pylist(rows, _ARROW)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _ARROW)

    files = max(manifest.count(), 1)
    return manifest.select("path").repartition(files).mapInArrow(read, CHUNK_SCHEMA)


_ARROW = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("chunk_no", pa.int64()),
    ("chunk_bytes", pa.int64()), ("is_last", pa.bool_()), ("running_digest", pa.string()), ("data", pa.binary())])


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back; one row per record."""
    records = plan_records(table(spark, sf_dir, "pages"))
    manifest = write_warc(chunk_table(records), scratch_path(spark, "warc"))
    return (read_warc(manifest, with_data=False).filter("is_last")
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
