"""Operator 3, packing: documents in space-filling-curve order.

Every document's ids give a hashed vector (each id falls in one of ``FEATURES``
buckets) that a fixed random matrix projects to ``DIMS`` dimensions; as the
projection is linear, it is a lookup per id and a mean. The projections are
scaled by the corpus' own mean and deviation, quantised, and turned into a
Hilbert key: documents with similar vectors get near keys. The documents are
range-sorted by that key and laid end to end along the curve, and sequences are
cut from that line every ``length`` ids, so every sequence is full and only the
line's end is left over. The end is cut into sequences whose lengths are
powers of two, which need no padding.

What is sorted is narrow (key, ids, length), and ties go on to the document id
and the row number, so one text that a third of all rows share still spreads
over the sort's partitions. A row's place on the line is its place in its
partition plus the totals of the partitions before (one row per partition).
Places go back to the ids by row number, which no two rows share.

Defined results: a null or empty text has the end id alone. Repeated rows and
equal document ids are separate documents; null ids are kept. An empty table
gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import cut, table
from strata.llm.tokens import TEXT_BYTES, default_vocabulary, task_encoder, text_slices

LENGTH = 4096
END_ID = 2
FEATURES = 4096
DIMS = 4
CURVE_BITS = 8  # per dimension
SEED = 3


def projection(vocabulary_size: int, seed: int = SEED) -> np.ndarray:
    """Row i: the projected coordinates of id i's hashed feature."""
    matrix = np.random.default_rng(seed).standard_normal((FEATURES, DIMS)).astype(np.float32)
    ids = np.arange(vocabulary_size, dtype=np.uint64)
    mixed = (ids * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(52)  # the top 12 bits: 4096 buckets
    return matrix[mixed.astype(np.int64)]


def hilbert_keys(cells: np.ndarray, bits: int = CURVE_BITS) -> np.ndarray:
    """Hilbert index of each row of non-negative cell coordinates below ``2**bits``.

    Bit by bit from the top, a cell is rotated into the frame of the sub-cube
    that the higher bits chose; the Gray code of the result is then undone and
    the bits of all dimensions are interleaved.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        q = 1 << level
        low = q - 1
        for i in range(n):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    undo = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        q = 1 << level
        undo = np.where((x[n - 1] & q) != 0, undo ^ (q - 1), undo)
    x ^= undo
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> level) & 1)
    return key


def _encoded(batches, enc, end_id: int):
    table_ = projection(enc.tokenizer.get_vocab_size())
    width = enc.dtype.itemsize
    for batch in batches:
        for part in text_slices(batch, TEXT_BYTES):
            ids = enc.encode_texts(part["text"], end_id)
            n = pc.binary_length(ids).to_numpy() // width
            flat, at = np.frombuffer(ids.buffers()[2], enc.dtype), np.cumsum(n) - n
            means = np.empty((len(n), DIMS), np.float32)
            for i, (a, m) in enumerate(zip(at.tolist(), n.tolist(), strict=True)):
                means[i] = table_.take(flat[a:a + m], axis=0).mean(axis=0)
            yield pa.RecordBatch.from_pydict({
                "row": part["row"], "doc_id": part["doc_id"], "n": pa.array(n, pa.int64()),
                **{f"v{i}": pa.array(means[:, i], pa.float32()) for i in range(DIMS)},
                "ids": ids,
                "width": pa.array(np.full(len(n), width), pa.int64())})


def encode_documents(docs: DataFrame, vocabulary: str, end_id: int,
                     doc: str, text: str) -> DataFrame:
    """``row, doc_id, n, v0.., ids, width`` per document; ids are packed bytes."""
    schema = ("row long, doc_id long, n long, "
              + "".join(f"v{i} float, " for i in range(DIMS)) + "ids binary, width long")

    def encode(batches):
        with task_encoder(vocabulary) as enc:
            yield from _encoded(batches, enc, end_id)

    rows = docs.select(F.monotonically_increasing_id().alias("row"),
                       F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(encode, schema)


def curve_order(encoded: DataFrame) -> DataFrame:
    """``row, start`` per document: its place on the line along the curve."""
    names = [f"v{i}" for i in range(DIMS)]
    stats = encoded.agg(*[f(F.col(c).cast("double")) for c in names for f in (F.avg, F.stddev_pop)]).first()
    cells = 1 << CURVE_BITS

    def keyed(batches):
        for batch in batches:
            out = np.empty((batch.num_rows, DIMS), np.int64)
            for i, c in enumerate(names):
                mean, dev = stats[2 * i] or 0.0, stats[2 * i + 1] or 0.0
                z = (batch[c].to_numpy(zero_copy_only=False) - mean) / (dev or 1.0)
                # three deviations to either side; cells at the border are open
                out[:, i] = np.clip((z + 3) / 6 * cells, 0, cells - 1)
            yield pa.RecordBatch.from_arrays(
                [batch["row"], batch["doc_id"], batch["n"], pa.array(hilbert_keys(out))],
                names=["row", "doc_id", "n", "key"])

    def placed(batches):
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch["n"].to_numpy()
            ends = at + np.cumsum(n)
            yield pa.RecordBatch.from_arrays(
                [batch["row"], batch["n"], pa.array(ends - n), pa.array(np.full(len(n), part, np.int64))],
                names=["row", "n", "local", "part"])
            at = int(ends[-1]) if len(n) else at

    keys = encoded.select("row", "doc_id", "n", *names).mapInArrow(keyed, "row long, doc_id long, n long, key long")
    ordered = keys.repartitionByRange("key", "doc_id", "row").sortWithinPartitions("key", "doc_id", "row")
    local = cut(ordered.select("row", "n").mapInArrow(placed, "row long, n long, local long, part long"), "curve")
    # One row per sort partition.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (local.groupBy("part").agg(F.sum("n").alias("n"))
               .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    return local.join(F.broadcast(offsets), "part").select("row", (F.col("local") + F.col("offset")).alias("start"))


def tail_cuts(total: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of the sequences after the last full one, powers of two."""
    at, rest, out = total - total % length, total % length, []
    while rest:
        size = 1 << (rest.bit_length() - 1)
        out.append((at, size))
        at, rest = at + size, rest - size
    return out


def pack_documents(docs: DataFrame, length: int = LENGTH, vocabulary: str | None = None,
                   end_id: int = END_ID, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit integers. Each
    sequence has ``length`` ids, but for those that the line's end leaves.
    """
    vocabulary = vocabulary or default_vocabulary()
    encoded = cut(encode_documents(docs, vocabulary, end_id, doc, text), "packing-ids")
    total = encoded.agg(F.sum("n")).first()[0] or 0
    ends = tail_cuts(total, length)
    full = total // length

    def sequence_at(place: int) -> tuple[int, int, int]:
        """(sequence, its start, its end) at a place on the line."""
        if place < full * length:
            s = place // length
            return s, s * length, (s + 1) * length
        for i, (start, size) in enumerate(ends):
            if place < start + size:
                return full + i, start, start + size
        raise ValueError("place beyond the line's end")

    def cut_pieces(batches):
        for batch in batches:
            cols = {k: [] for k in ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")}
            for doc_id, first, n, blob, width in zip(*(batch[c].to_pylist() for c in (
                    "doc_id", "start", "n", "ids", "width")), strict=True):
                wide = np.frombuffer(blob, f"<u{width}").astype("<u4")
                at = 0
                while at < n:
                    seq, begin, end = sequence_at(first + at)
                    take = min(n - at, end - first - at)
                    for c, v in zip(cols, (doc_id, at, take, wide[at:at + take].tobytes(), n, seq,
                                           first + at - begin), strict=True):
                        cols[c].append(v)
                    at += take
            yield pa.RecordBatch.from_pydict({
                c: pa.array(v, pa.binary() if c == "ids" else pa.int64()) for c, v in cols.items()})

    joined = encoded.select("row", "doc_id", "n", "ids", "width").join(curve_order(encoded), "row")
    return joined.select("doc_id", "start", "n", "ids", "width").mapInArrow(
        cut_pieces, "doc_id long, start long, length long, ids binary, doc_tokens long, "
                    "sequence_id long, offset long")


def op3_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 ids; one row per piece."""
    pieces = pack_documents(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")

