"""Operator 8, token-id output: concatenated ids with Elias-Fano boundaries.

Documents go by id range to shards, one file each. A shard file is

    magic | ids, little endian, 2 or 4 bytes each | boundaries | document ids | footer | footer length | magic

``boundaries`` holds the n+1 token offsets of n documents as an Elias-Fano
sequence: ``l`` low bits of each value packed, the high parts in a unary bit
vector, and every 256th one's position as a select sample (32 bits, relative to
the sequence). That is about ``2 + log2(mean length)`` bits a document instead
of 64, and ``select`` finds any boundary from a sample and at most a few words.
Document ids are ascending, so they are stored the same way (nulls, which sort
first, as a count).

A shard is written as a stream: a task holds one Arrow batch of texts, the ids of
``TEXT_BYTES`` of them and sixteen bytes per document of its shard (its length
and its id), and while the file is closed some tens of bytes a document for the
boundaries. Files get a new name per attempt and count only when the manifest,
written by Spark, lists them, so a retried or lost task leaves at most a file
that nobody reads. Files lie in the shared folder.

Defined results: a null or empty text has the end id alone. Documents with
equal ids are separate documents, next to each other in an order that stays
fixed for the written files. Null ids come first. An empty table gives no rows.
Extra columns are ignored.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import cut, open_fs, scratch_path, table
from strata.llm.tokens import TEXT_BYTES, WordEncoder, default_vocabulary, task_encoder, text_slices

MAGIC = b"EFIDS\x00\x00\x01"
SAMPLE_EVERY = 256
READ_BYTES = 1 << 22
PACK_VALUES = 1 << 14
END_ID = 1


# --------------------------------------------------------------------------
# Elias-Fano sequences
# --------------------------------------------------------------------------

class EliasFano:
    """A non-decreasing sequence of non-negative integers in near-minimal space."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, dtype=np.uint64)
        n = len(v)
        top = int(v[-1]) if n else 0
        l = max(0, (top // max(n, 1)).bit_length() - 1)
        parts = [np.zeros(0, np.uint8)]
        for i in range(0, n if l else 0, PACK_VALUES):  # a multiple of 8 values ends with a byte
            some = v[i:i + PACK_VALUES, None] >> np.arange(l, dtype=np.uint64)
            parts.append(np.packbits((some & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little"))
        low = np.concatenate(parts)
        at = (v >> np.uint64(l)).astype(np.int64) + np.arange(n)
        marks = np.zeros(int(at[-1]) + 1 if n else 0, np.uint8)
        marks[at] = 1
        return cls(n, l, low, np.packbits(marks, bitorder="little"), at[::SAMPLE_EVERY].astype("<u4"))

    def _lows(self, i: int, j: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(j - i, np.uint64)
        a, b = i * self.low_bits, j * self.low_bits
        bits = np.unpackbits(self.low[a // 8:(b + 7) // 8], bitorder="little")[a % 8:a % 8 + b - a]
        weights = np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64)
        return (bits.reshape(j - i, self.low_bits).astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64)

    def slice(self, i: int, j: int) -> np.ndarray:
        """Values i to j-1; reads only the bits from the sample before i on."""
        if i >= j:
            return np.zeros(0, np.uint64)
        k = i // SAMPLE_EVERY
        start = int(self.samples[k])
        k2 = (j - 1) // SAMPLE_EVERY + 1
        stop = int(self.samples[k2]) if k2 < len(self.samples) else 8 * len(self.high)
        bits = np.unpackbits(self.high[start // 8:(stop + 7) // 8], bitorder="little")
        ones = np.flatnonzero(bits[start % 8:]) + start
        at = ones[i - k * SAMPLE_EVERY: j - k * SAMPLE_EVERY]
        highs = (at - np.arange(i, j)).astype(np.uint64)
        return (highs << np.uint64(self.low_bits)) | self._lows(i, j)

    def select(self, i: int) -> int:
        """The i-th value."""
        return int(self.slice(i, i + 1)[0])

    def parts(self) -> list[bytes]:
        return [self.low.tobytes(), self.high.tobytes(), self.samples.tobytes()]

    def meta(self) -> dict:
        return {"n": self.n, "l": self.low_bits, "sizes": [len(p) for p in self.parts()]}

    @classmethod
    def decode(cls, meta: dict, blob: bytes) -> EliasFano:
        a, b, c = meta["sizes"]
        return cls(meta["n"], meta["l"], np.frombuffer(blob, np.uint8, a),
                   np.frombuffer(blob, np.uint8, b, a), np.frombuffer(blob, "<u4", c // 4, a + b))


# --------------------------------------------------------------------------
# Shard files
# --------------------------------------------------------------------------

class ShardWriter:
    """Streams one shard's documents into a file."""

    def __init__(self, uri: str, width: int):
        fs, path = open_fs(uri)
        fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.out, self.width = fs.open_output_stream(path), width
        self.out.write(MAGIC)
        self.lengths = array("Q")
        self.doc_ids = array("q")
        self.nulls = 0

    def add_all(self, doc_ids: pa.Array, ids: pa.Array) -> None:
        """Add documents in order: their ids and, as binaries, their token ids."""
        ends = np.frombuffer(ids.buffers()[1], np.int32, len(ids) + 1, 4 * ids.offset)
        self.out.write(ids.buffers()[2].slice(int(ends[0]), int(ends[-1] - ends[0])))
        self.lengths.frombytes((np.diff(ends) // self.width).astype(np.uint64).tobytes())
        self.nulls += doc_ids.null_count
        self.doc_ids.frombytes(doc_ids.drop_null().to_numpy().astype(np.int64).tobytes())

    def close(self) -> int:
        """Finish the file; returns the number of ids in it."""
        ends = np.concatenate([[0], np.cumsum(np.frombuffer(self.lengths, np.uint64), dtype=np.uint64)]).astype(np.uint64)
        least = self.doc_ids[0] if self.doc_ids else 0
        bounds = EliasFano.encode(ends)
        # differences are taken in unsigned 64 bits, which hold them all
        named = EliasFano.encode(np.frombuffer(self.doc_ids, np.int64).astype(np.uint64) - np.uint64(least % (1 << 64)))
        for part in bounds.parts() + named.parts():
            self.out.write(part)
        footer = json.dumps({"width": self.width, "tokens": int(ends[-1]), "nulls": self.nulls,
                             "least": least, "bounds": bounds.meta(), "docs": named.meta()}).encode()
        self.out.write(footer + struct.pack("<Q", len(footer)) + MAGIC)
        self.out.close()
        return int(ends[-1])


class ShardReader:
    """Random and sequential access to a shard file."""

    def __init__(self, uri: str):
        fs, path = open_fs(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        tail = self.file.read_at(16, size - 16)
        if tail[8:] != MAGIC or self.file.read_at(8, 0) != MAGIC:
            raise ValueError(f"not a token shard: {uri}")
        n = struct.unpack("<Q", tail[:8])[0]
        self.footer = json.loads(self.file.read_at(n, size - 16 - n))
        self.width = self.footer["width"]
        self.dtype = np.dtype(f"<u{self.width}")
        at = len(MAGIC) + self.footer["tokens"] * self.width
        parts = []
        for name in ("bounds", "docs"):
            meta = self.footer[name]
            length = sum(meta["sizes"])
            parts.append(EliasFano.decode(meta, self.file.read_at(length, at)))
            at += length
        self.bounds, self.docs = parts
        self.n_docs = self.bounds.n - 1

    def doc_ids(self, i: int, j: int) -> list[int | None]:
        nulls, least = self.footer["nulls"], self.footer["least"]
        known = self.docs.slice(max(i - nulls, 0), max(j - nulls, 0)).tolist()
        return [None] * (max(0, min(j, nulls) - i)) + [least + d for d in known]

    def ids(self, start: int, stop: int) -> Iterator[np.ndarray]:
        """The ids from ``start`` to ``stop``, in blocks of bounded size."""
        step = READ_BYTES // self.width
        while start < stop:
            n = min(step, stop - start)
            yield np.frombuffer(self.file.read_at(n * self.width, len(MAGIC) + start * self.width), self.dtype)
            start += n


# --------------------------------------------------------------------------
# Spark jobs
# --------------------------------------------------------------------------

def _written(batches, enc: WordEncoder, uri: str, end_id: int) -> ShardWriter | None:
    """The open shard of the batches' documents, encoded ``TEXT_BYTES`` at a time; None without any."""
    writer = None
    for batch in batches:
        for part in text_slices(batch, TEXT_BYTES):
            writer = writer or ShardWriter(uri, enc.dtype.itemsize)
            writer.add_all(part["doc_id"], enc.encode_texts(part["text"], end_id))
    return writer


def write_token_shards(docs: DataFrame, out_dir: str, vocabulary: str | None = None,
                       end_id: int = END_ID, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Write shard files in ascending document order; returns the manifest.

    Manifest: ``shard, path, n_docs, n_tokens``, shards ascending with the ids.
    Rows of one id are ordered by a hash of their texts, so that an id with many
    texts still spreads and a task that runs again finds the same rows.
    """
    vocabulary = vocabulary or default_vocabulary()

    def write(batches):
        with task_encoder(vocabulary) as enc:
            shard = TaskContext.get().partitionId()
            uri = f"{out_dir}/shard-{shard:06d}-{uuid.uuid4().hex}.efids"
            writer = _written(batches, enc, uri, end_id)
            if writer is not None:
                n_docs, n_tokens = len(writer.lengths), writer.close()
                yield pa.RecordBatch.from_pylist(
                    [{"shard": shard, "path": uri, "n_docs": n_docs, "n_tokens": n_tokens}])

    ordered = (docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
               .withColumn("tie", F.xxhash64("text"))
               .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
               .select("doc_id", "text"))
    return cut(ordered.mapInArrow(write, "shard long, path string, n_docs long, n_tokens long"),
               "token-manifest")


def read_token_shards(manifest: DataFrame) -> DataFrame:
    """One row per document, from the files: ``doc_id, start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all documents before it, in all shards. The
    running total needs one row per shard in one task, never one per document.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = max(manifest.count(), 1)
    located = manifest.withColumn("first", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                shard = ShardReader(row["path"])
                for i in range(0, shard.n_docs, 4096):
                    j = min(i + 4096, shard.n_docs)
                    ends = shard.bounds.slice(i, j + 1).astype(np.int64)
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(shard.doc_ids(i, j), pa.int64()),
                        "start": pa.array(ends[:-1] + row["first"], pa.int64()),
                        "n_tokens": pa.array(np.diff(ends), pa.int64()),
                        "ids_crc32": pa.array(_checksums(shard, ends), pa.int64())})

    return (located.select("path", "first").repartition(shards)
            .mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def _checksums(shard: ShardReader, ends: np.ndarray) -> list[int]:
    """CRC-32 of each document's ids as 32-bit little-endian integers."""
    sums, crc, doc, at = [], 0, 0, int(ends[0])
    for block in shard.ids(at, int(ends[-1])):
        wide, used = memoryview(block.astype("<u4").tobytes()), 0
        while used < len(block):
            take = min(len(block) - used, int(ends[doc + 1]) - at)
            crc = zlib.crc32(wide[4 * used:4 * (used + take)], crc)
            used, at = used + take, at + take
            if at == ends[doc + 1]:
                sums.append(crc)
                crc, doc = 0, doc + 1
    # every document has the end id, so none is empty
    return sums


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded, written to shard files and read back from them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    manifest = write_token_shards(docs, scratch_path(spark, "token-shards"))
    return read_token_shards(manifest)
