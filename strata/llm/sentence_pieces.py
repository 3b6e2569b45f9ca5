"""Operator 13, SentencePiece encoding and decoding by a distinct-chunk table.

The library puts a marker before the text, turns every space into one, and joins
pieces by merges that its vocabulary lists. Where no listed piece has a marker
after another character, no merge crosses the place before a run of markers, so
a text's ids are those of its chunks (a run of markers and what follows it up to
the next one) in order. ``pieces_stay_apart`` looks at the whole vocabulary and
at what the library's normalizer does; where it says no, each whole text is one
chunk, and the rest is the same.

Tasks take texts in blocks of about ``BLOCK_CHUNKS`` chunks. A block's distinct
chunks make a table, in which the library segments each of them once; every
chunk of every text is a place in that table, and the ids are joined back by
position: one gather of the table's ids for the whole block. A block ends with a
text, so nothing is shuffled and nothing is written, and a lost executor costs
the blocks that it was at. (One table for the whole corpus, made by a Spark
``distinct`` and joined back per block, gives the same ids; it wrote and
shuffled more than four times the input, see the README.)

Decoding is the library's own ``decode`` of each whole id sequence.

Defined results: null and empty texts have no ids and decode to an empty text.
Rows are encoded one by one, so null and repeated ids give a row each. A text is
read whole whatever its length; one row must fit a task's memory. Bytes that are
no UTF-8 count as U+FFFD. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import table

DEFAULT_MODEL = "piece_bpe_32k.model"
BLOCK_CHUNKS = 1 << 18
MARK = "▁"
_CHUNK = re.compile(r" *[^ ]+| +")
# An identity normalizer that marks the front and keeps every space gives these as they are.
_PROBES = ("a", "  a  b ", "Ａﬁ é é ①\t\n\r x", "▁a", " ")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path(DEFAULT_MODEL)


def processor(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


def pieces_stay_apart(sp) -> bool:
    """Whether no piece crosses the place before a run of markers, and spaces become markers one by one."""
    if any(sp.normalize(t) != MARK + t.replace(" ", MARK) for t in _PROBES):
        return False
    if sp.is_unknown(sp.piece_to_id(MARK)):
        return False
    return not any(MARK in sp.id_to_piece(i).lstrip(MARK) for i in range(sp.get_piece_size()))


def chunks_of(text: str) -> list[str]:
    """A text's chunks, spaces for markers, each without its first marker; none of an empty text."""
    if not text:
        return []
    text = text.replace(MARK, " ")
    if "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    return [c[1:] for c in _CHUNK.findall(" " + text)]


def segment(sp, chunks: list[str], apart: bool) -> list[list[int]]:
    """Ids of each chunk; the library puts the first marker before a chunk by itself."""
    ids = sp.encode(chunks, num_threads=1)
    if apart and "" in chunks:
        # a marker alone, which the library would take for an empty text
        ids[chunks.index("")] = [sp.piece_to_id(MARK)]
    return ids


class Places(dict):
    """Distinct chunks in order; a new one's place is the number of those before it."""

    def __missing__(self, chunk: str) -> int:
        self[chunk] = place = len(self)
        return place


class ChunkTable:
    """The distinct chunks of a block of texts, and where its texts have them."""

    def __init__(self):
        self.index, self.total = Places(), 0
        self.places: list[np.ndarray] = []
        self.counts: list[int] = []

    def add(self, chunks: list[str]) -> None:
        """The next text."""
        self.places.append(np.fromiter(map(self.index.__getitem__, chunks), np.int64, len(chunks)))
        self.counts.append(len(chunks))
        self.total += len(chunks) + 1

    def join(self, sp, apart: bool) -> tuple[np.ndarray, np.ndarray]:
        """(where each text's ids begin and end, all ids), after segmenting each distinct chunk once."""
        lists = pa.array(segment(sp, list(self.index), apart), pa.list_(pa.int32()))
        size = np.asarray(lists.value_lengths(), np.int64)
        start, flat = np.cumsum(size) - size, lists.flatten().to_numpy()
        places = np.concatenate(self.places) if self.places else np.zeros(0, np.int64)
        size = size[places]
        end = np.concatenate([[0], np.cumsum(size)])
        take = np.repeat(start[places] - end[:-1], size) + np.arange(end[-1])
        # a text's chunks are neighbours
        return end[np.concatenate([[0], np.cumsum(self.counts, dtype=np.int64)])], flat[take]


def encode_documents(docs: DataFrame, model: str | None = None, doc: str = "doc_id", text: str = "text",
                     decode: bool = False) -> DataFrame:
    """``doc_id, ids`` for every row of ``docs``: its whole text as the library encodes it.

    With ``decode`` also ``decoded``, what the library decodes from those ids,
    without sending them to another worker.
    """
    with open(model or default_model(), "rb") as f:
        proto = f.read()
    apart = pieces_stay_apart(processor(proto))
    shared = docs.sparkSession.sparkContext.broadcast(proto)

    def encode(batches):
        sp = processor(shared.value)
        ids, block = [], ChunkTable()

        def done():
            edge, flat = block.join(sp, apart)
            columns = [pa.array(ids, pa.int64()), pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(flat))]
            if decode:
                every = flat.tolist()
                columns.append(pa.array([sp.decode(every[a:b]) for a, b in zip(edge[:-1], edge[1:], strict=True)],
                                        pa.string()))
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"][:len(columns)])

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                text = (text.as_py() or b"").decode("utf-8", "replace")
                block.add(chunks_of(text) if apart else [text] if text else [])
                ids.append(doc_id)
                if block.total >= BLOCK_CHUNKS:
                    yield done()
                    ids, block = [], ChunkTable()
        if ids:
            yield done()

    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(encode, "doc_id long, ids array<int>" + ", decoded string" * decode)


def decode_documents(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """``doc_id, ids, decoded``: each row's ids as the library decodes them."""
    with open(model or default_model(), "rb") as f:
        shared = encoded.sparkSession.sparkContext.broadcast(f.read())

    def decode(batches):
        sp = processor(shared.value)
        for batch in batches:
            texts = [sp.decode([] if ids is None else ids.to_numpy().tolist())
                     for ids in (r.values for r in batch["ids"])]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["ids"], pa.array(texts, pa.string())],
                                             names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, ids array<int>, decoded string")


def op13_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every whole document, as digests."""
    out = encode_documents(table(spark, sf_dir, "documents"), decode=True)
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
