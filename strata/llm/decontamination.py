"""Operator 7, benchmark decontamination: latent semantic retrieval, then LCS.

Words are compared lower-cased and without punctuation around them, as
32-bit hashes; documents are hashed once, into a scratch table. All documents
give the inverse document frequencies of ``FEATURES`` hashed words. A
randomised SVD of the benchmark's TF-IDF passages (Spark jobs that sum partial
products, a fixed number of power rounds) gives a latent space whose rank is the
block's number of passages, so that no item loses length in it. For each item,
every document has overlapping windows, one from each ``CELL``-th word, that
cover every stretch of the length in which the item is looked for. A stretch that
confirms holds a known share of the item's words, so its window has at least so
many of them, and its projection at least the dot product with the item that the
share's least telling words make; windows below either are no candidates. What
an item loses in the projection widens its threshold, so neither bound loses a
stretch that the rule below confirms.

A candidate is confirmed by the longest common subsequence of words: at least
80 % of the passage within a stretch 1.25 times its length, or at least 60 %
when the passage's answer is there word for word in order. The answer is the
``answer`` column of one word or more; without one it is the last sentence, or
the last ``SHORT`` words of the passage where that sentence is shorter or the
whole passage. An answer of fewer than ``SHORT`` words must follow the 60 %.
Passages of fewer than eight words must be there whole.

The benchmark is a stated query set: it is taken in blocks of about ``BLOCK``
passages of ``PASSAGE_WORDS`` words, an item's all in one block, and each block's
space, not the documents, is what tasks receive. Items may have any length: they
are cut for the space only, and looked for whole. Every document
is read whole; no bucket, candidate or window is capped. Stretches may
begin at every word. The reported cosine is the best one of the item with a
window of ``WINDOWS`` words or, for longer items, of up to the item's length; it
divides by the window's norm in the whole word space.

Defined results: null or empty documents and benchmark items match nothing.
Documents are judged row by row (null and repeated ids included); a document
gives one row per benchmark item that it holds. Equal items each give a row. An
empty benchmark or an empty table gives no rows. Extra columns are carried by
``drop_contaminated`` and ignored by the query.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import WordTable, cut, fresh, scratch_path, table, text_mark

FEATURES = 1 << 18
OVERSAMPLE = 16
POWER_ROUNDS = 2
BLOCK = 256
SVD_TASKS = 4  # a block's rows are few
WINDOWS = (16, 32, 64)
PASSAGE_WORDS = 64
CELL = 8  # words between the starts of two windows
SECTION = 1 << 10  # cells that are looked at together
LCS_SHARE, LCS_SHARE_WITH_ANSWER = 0.8, 0.6
SHORT = 3
STRETCH = 1.25
_AROUND = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _word_hash(word: bytes) -> int:
    """A 32-bit hash of a word's lower-cased bare form; 0 if nothing is left."""
    bare = word.decode("utf-8", "replace").lower().encode().strip(_AROUND)
    return (xxhash.xxh64_intdigest(bare) & 0xFFFFFFFF or 1) if bare else 0


def word_hashes(text: bytes | None, table_: WordTable | None = None) -> np.ndarray:
    """Hashes of a text's words in order, words of punctuation alone left out."""
    words = (text or b"").split()
    hashes = map(_word_hash if table_ is None else table_.__getitem__, words)
    h = np.fromiter(hashes, np.int64, len(words))
    return h[h != 0] if len(h) and not h.all() else h


def _features(hashes: np.ndarray) -> np.ndarray:
    return hashes & (FEATURES - 1)


def hashed_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, mark, words``: every document's word hashes, 32 bits each."""

    def hashed(batches):
        known = WordTable(_word_hash)
        for batch in batches:
            blobs = [word_hashes(t, known).astype("<u4").tobytes() for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["mark"], pa.array(blobs, pa.binary())],
                                             names=["doc_id", "mark", "words"])

    return docs.mapInArrow(hashed, "doc_id long, mark binary, words binary")


def inverse_frequencies(hashed: DataFrame) -> np.ndarray:
    """IDF of every hashed word over all documents (at most ``FEATURES`` rows come back)."""

    def count(batches):
        total, n = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            for blob in batch["words"].to_pylist():
                if blob:
                    total[np.unique(np.frombuffer(blob, "<u4") & (FEATURES - 1))] += 1
                    n += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), pa.array(np.append(total[at], n))], names=["feature", "n"])

    sums = (hashed.select("words").mapInArrow(count, "feature long, n long")
            .groupBy("feature").agg(F.sum("n").alias("n")).toArrow())
    feature, n = sums["feature"].to_numpy(), sums["n"].to_numpy()
    df = np.zeros(FEATURES)
    df[feature[feature >= 0]] = n[feature >= 0]
    return np.maximum(np.log((n[feature < 0].sum() + 1) / (df + 1)), 0.05).astype(np.float32)


class Item:
    """One benchmark passage, ready for the checks."""

    def __init__(self, item_id, text: bytes, answer: bytes | None):
        self.item_id = item_id
        self.words = word_hashes(text).tolist()
        if answer is None:
            sentences = [s for s in re.split(rb"[.!?\n]+", text) if s.strip()]
            self.answer = word_hashes(sentences[-1] if sentences else b"").tolist()
            if not SHORT <= len(self.answer) < len(self.words):
                self.answer = self.words[-SHORT:]
        else:
            self.answer = word_hashes(answer).tolist()
        self.answer_blob = np.array(self.answer, "<u4").tobytes()
        self.masks: dict[int, int] = {}
        for i, w in enumerate(self.words):
            self.masks[w] = self.masks.get(w, 0) | 1 << i

    def common(self, stretch: list[int]) -> int:
        """Length of the longest common subsequence, a bit per word of the passage."""
        full = (1 << len(self.words)) - 1
        v = full
        for w in stretch:
            m = self.masks.get(w)
            if m is not None:
                u = v & m
                v = ((v + u) | (v - u)) & full
        return len(self.words) - v.bit_count()

    def stretch_words(self) -> int:
        return max(len(self.words), int(len(self.words) * STRETCH))

    def share(self) -> float:
        return LCS_SHARE if len(self.words) >= 8 else 1.0

    def least_share(self) -> float:
        """The share that every confirmed stretch has."""
        return LCS_SHARE_WITH_ANSWER if len(self.words) >= 8 and self.answer else self.share()

    def confirm(self, words: list[int], start: int, stop: int) -> int:
        """The best LCS in the stretches that meet [start, stop), 0 if it does not confirm."""
        return self.confirm_from(words, max(0, start - self.stretch_words() + 1), stop)

    def confirm_from(self, words: list[int], start: int, stop: int) -> int:
        """The best LCS in the stretches that begin in [start, stop), 0 if it does not confirm."""
        n, size, best = len(self.words), self.stretch_words(), 0
        near = set(words[start:stop + size])
        # no more of the passage can be common than has its word in the neighbourhood
        if sum(m.bit_count() for w, m in self.masks.items() if w in near) < self.least_share() * n:
            return 0
        share, least = self.share(), int(np.ceil(self.least_share() * n - 1e-9))
        s, stop = start, min(stop, max(1, len(words) - n // 2))
        while s < stop:
            stretch = words[s:s + size]
            c = self.common(stretch)
            if c >= share * n or (n >= 8 and c >= LCS_SHARE_WITH_ANSWER * n and self._answered(stretch)):
                best = max(best, c)
            # the next stretch has one word more, so at most one more in common
            s += max(1, max(best + 1, least) - c)
        return best

    def answer_in(self, blob: bytes) -> bool:
        """Whether the answer may be somewhere in a document's word hashes."""
        return bool(self.answer) and self.answer_blob in blob

    def _answered(self, stretch: list[int]) -> bool:
        """Whether the answer is in a stretch; a short one only counts behind the words of the share."""
        m = len(self.answer)
        places = [i + m for i in range(len(stretch) - m + 1) if stretch[i:i + m] == self.answer] if m else []
        return bool(places) and (
            m >= SHORT or self.common(stretch[:places[-1]]) >= LCS_SHARE_WITH_ANSWER * len(self.words))


def _passage_rows(items: DataFrame, idf: np.ndarray) -> DataFrame:
    """Unit TF-IDF rows of the benchmark's passages, as index and value arrays."""

    def rows(batches):
        for batch in batches:
            idx, val = [], []
            for text in batch["text"].to_pylist():
                f = _features(word_hashes(text))
                for at in range(0, len(f), PASSAGE_WORDS):
                    u, c = np.unique(f[at:at + PASSAGE_WORDS], return_counts=True)
                    v = c * idf[u]
                    idx.append(u.tolist())
                    val.append((v / np.linalg.norm(v)).tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(idx, pa.list_(pa.int64())), pa.array(val, pa.list_(pa.float64()))], names=["idx", "val"])

    return items.select("text").mapInArrow(rows, "idx array<long>, val array<double>")


def latent_space(passages: DataFrame, rank: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(features, their rows of the right singular vectors) of the passages' matrix A.

    The range of A'A is found by a randomised subspace iteration: each round is
    a Spark job in which every task sums ``a (a . Q)`` over its rows a. The
    columns are the features that occur (bounded by a block's words).
    """
    vocabulary = np.array(sorted(r[0] for r in passages.select(F.explode("idx")).distinct().toLocalIterator()), np.int64)
    n = len(vocabulary)
    width = min(rank + OVERSAMPLE, n)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((n, width)))[0]

    def step(basis):
        def products(batches):
            total = np.zeros((n, width))
            for batch in batches:
                for idx, val in zip(batch["idx"].to_pylist(), batch["val"].to_pylist(), strict=True):
                    at, v = np.searchsorted(vocabulary, idx), np.array(val)
                    total[at] += np.outer(v, v @ basis[at])
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])
        parts = passages.mapInArrow(products, "part binary").toLocalIterator()
        return sum(np.frombuffer(p[0]).reshape(n, width) for p in parts)

    for _ in range(POWER_ROUNDS):
        q = np.linalg.qr(step(q))[0]
    small = q.T @ step(q)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    top = np.argsort(values)[::-1][:rank]
    return vocabulary, (q @ vectors[:, top]).astype(np.float32)


def windows_of(lengths: np.ndarray, sizes: tuple[int, ...] = WINDOWS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, end) of all windows of documents laid end to end.

    Windows of each size overlap by half; a document no longer than a size has
    one window of it and none of the larger sizes.
    """
    first = np.cumsum(lengths) - lengths
    docs, starts, ends, below = [], [], [], 0
    for w in sizes:
        of = np.flatnonzero(lengths > below)
        n = lengths[of]
        count = np.maximum(-(-(n - w) // (w // 2)), 0) + 1
        doc = np.repeat(of, count)
        turn = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
        a = np.minimum(turn * (w // 2), np.maximum(lengths[doc] - w, 0))
        docs.append(doc)
        starts.append(first[doc] + a)
        ends.append(first[doc] + np.minimum(a + w, lengths[doc]))
        below = w
    return np.concatenate(docs), np.concatenate(starts), np.concatenate(ends)


class Searcher:
    """Finds a block's passages in documents; what a task receives."""

    def __init__(self, rows: list[tuple], idf: np.ndarray, vocabulary: np.ndarray, vectors: np.ndarray):
        self.rows, self.idf, self.vocabulary, self.vectors = rows, idf, vocabulary, vectors
        self.items = None

    def _prepare(self) -> None:
        # in the order of their windows, so that items with equal windows are neighbours
        self.items = sorted((i for i in (Item(*r) for r in self.rows) if i.words), key=Item.stretch_words)
        size, unknown = len(self.items), len(self.vocabulary)
        self.where = np.full(FEATURES, unknown, np.int32)
        self.where[self.vocabulary] = np.arange(unknown)
        contribution = self.vectors * self.idf[self.vocabulary][:, None]
        self.energy = self.idf.astype(np.float64) ** 2
        self.member = np.zeros((unknown + 1, size), np.uint8)
        q = np.zeros((size, self.vectors.shape[1]))
        self.least, self.enough, self.dot, self.lost = (np.zeros(size) for _ in range(4))
        for i, item in enumerate(self.items):
            f = _features(np.array(item.words, np.int64))
            at = self.where[f]
            self.member[at, i] = 1
            u, c = np.unique(f, return_counts=True)
            norm = np.sqrt((c ** 2 * self.energy[u]).sum())
            q[i] = contribution[at].sum(axis=0, dtype=np.float64) / norm
            self.lost[i] = np.sqrt(max(1 - (q[i] ** 2).sum(), 0)) + 1e-4
            self.least[i] = np.ceil(item.least_share() * len(f) - 1e-9)
            self.enough[i] = np.ceil(item.share() * len(f) - 1e-9)
            # the words of the share that say least
            self.dot[i] = np.sort(self.energy[f])[:int(self.least[i])].sum() / norm
        # each word's term in the dot product of a window with each passage
        self.terms = np.concatenate([contribution @ q.T.astype(np.float32), np.zeros((1, size), np.float32)])
        # cells that cover a stretch from any word of the first one, an even number
        spans = [-(-(item.stretch_words() - 1) // CELL) + 1 for item in self.items]
        self.cells = np.array([n + n % 2 for n in spans], np.int64)
        self.groups = [(int(w), int(a), int(b)) for w in np.unique(self.cells)
                       for a, b in [np.searchsorted(self.cells, [w, w + 1])]]
        # running sums may wrap around, as long as a window's sum does not
        self.count_type = np.uint16 if self.cells.max(initial=0) * CELL < 1 << 16 else np.uint32

    def _windows(self, known: np.ndarray, total: np.ndarray):
        """(first cell, item, has its whole share) of the windows that reach both bounds."""
        cells, reach = len(known) // CELL, int(self.cells.max(initial=0))
        for at in range(0, cells, SECTION):
            stop = min(at + SECTION, cells)
            some = known[at * CELL:(stop + reach) * CELL].reshape(-1, CELL)
            counts = self.member[some[:, 0]]
            for i in range(1, CELL):
                counts += self.member[some[:, i]]
            sums = np.zeros((stop - at + reach + 1, len(self.items)), self.count_type)
            np.cumsum(counts, axis=0, dtype=self.count_type, out=sums[1:len(some) + 1])
            sums[len(some) + 1:] = sums[len(some)]
            for w, a, b in self.groups:
                inside = sums[w:w + stop - at, a:b] - sums[:stop - at, a:b]
                c, i = np.nonzero(inside >= self.least[a:b].astype(self.count_type))
                if not len(c):
                    continue
                whole, c, i = inside[c, i] >= self.enough[a:b][i], c + at, i + a
                for k in range(0, len(c), step := max(1, (1 << 22) // (w * CELL))):
                    ck, ik = c[k:k + step], i[k:k + step]
                    span = np.minimum(ck[:, None] * CELL + np.arange(w * CELL), len(known) - 1)
                    term = self.terms[known[span], ik[:, None]]
                    term[ck[:, None] * CELL + np.arange(w * CELL) >= len(known)] = 0
                    end = np.minimum((ck + w) * CELL, len(known))
                    norm = np.sqrt(np.maximum(total[end] - total[ck * CELL], 0))
                    keep = term.sum(axis=1) >= self.dot[ik] - self.lost[ik] * norm
                    yield ck[keep], ik[keep], whole[k:k + step][keep]

    def _cosine(self, f: np.ndarray, i: int) -> float:
        """The best cosine of an item with a window of a document."""
        sizes = list(WINDOWS)
        while sizes[-1] < len(self.items[i].words):
            sizes.append(2 * sizes[-1])
        _, a, b = windows_of(np.array([len(f)]), tuple(sizes))
        dot = np.concatenate([[0.0], np.cumsum(self.terms[self.where[f], i], dtype=np.float64)])
        total = np.concatenate([[0.0], np.cumsum(self.energy[f])])
        return float(((dot[b] - dot[a]) / np.sqrt(total[b] - total[a])).max())

    def find(self, blobs: list[bytes]) -> list[tuple]:
        """(document's place, item id, LCS, passage words, cosine) of the passages in documents."""
        if self.items is None:
            self._prepare()
        words = np.frombuffer(b"".join(blobs), "<u4").astype(np.int64)
        lengths = np.array([len(b) // 4 for b in blobs], np.int64)
        if not len(words) or not self.items:
            return []
        f = _features(words)
        # documents laid out in whole cells
        first, cells = np.cumsum(lengths) - lengths, -(-lengths // CELL)
        first_cell = np.cumsum(cells) - cells
        place = np.arange(len(words)) + np.repeat(first_cell * CELL - first, lengths)
        known = np.full(int(cells.sum()) * CELL, len(self.vocabulary), np.int32)
        known[place] = self.where[f]
        total = np.zeros(len(known) + 1)
        total[place + 1] = self.energy[f]
        hits = [h for h in self._windows(known, np.cumsum(total)) if len(h[0])]
        if not hits:
            return []
        cell, i, whole = (np.concatenate(x) for x in zip(*hits, strict=True))
        # a document without words owns no cell
        doc = np.searchsorted(first_cell + cells, cell, side="right")
        order = np.lexsort((cell, i, doc))
        cell, i, doc, whole = cell[order], i[order], doc[order], whole[order]
        edges = np.flatnonzero(np.diff(doc, prepend=-1) | np.diff(i, prepend=-1))
        promising = np.logical_or.reduceat(whole, edges)
        found, text_of, text = [], -1, []
        for k, (x, y) in enumerate(zip(edges.tolist(), [*edges[1:].tolist(), len(cell)], strict=True)):
            d, item = int(doc[x]), self.items[i[x]]
            if not promising[k] and not item.answer_in(blobs[d]):
                continue
            if text_of != d:
                text_of, text = d, words[first[d]:first[d] + lengths[d]].tolist()
            starts = (cell[x:y] - first_cell[d]) * CELL
            runs = np.flatnonzero(np.diff(starts, prepend=-2 * CELL) > CELL)
            best = 0
            for a, b in zip(runs.tolist(), [*runs[1:].tolist(), len(starts)], strict=True):
                best = max(best, item.confirm_from(text, int(starts[a]), int(starts[b - 1]) + CELL))
            if best:
                mine = f[first[d]:first[d] + lengths[d]]
                found.append((d, item.item_id, best, len(item.words), self._cosine(mine, int(i[x]))))
        return found


_HIT = "doc_id long, mark binary, item_id long, lcs_words long, item_words long, cosine double"


def _hits(docs: DataFrame, benchmark: DataFrame, doc: str, text: str, item: str, item_text: str,
          answer: str | None) -> DataFrame:
    """Which row (id and text's mark) holds which item."""
    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), text_mark(F.col(text)).alias("mark"),
                       F.col(text).cast("binary").alias("text"))
    items = benchmark.select(
        F.col(item).cast("long").alias("item_id"), F.col(item_text).cast("binary").alias("text"),
        (F.col(answer).cast("binary") if answer else F.lit(None).cast("binary")).alias("answer")
    ).filter(F.length("text") > 0)
    spark = docs.sparkSession
    hashed = cut(hashed_documents(rows), "hashed-words")
    idf = inverse_frequencies(hashed)
    # dealt to blocks by row, so that equal items spread as well
    items = cut(items.withColumn("row", F.monotonically_increasing_id()), "benchmark")
    size = F.ceil(F.size(F.split(F.col("text").cast("string"), r"\s+")) / PASSAGE_WORDS)
    blocks = max(1, -(-(items.agg(F.sum(size)).first()[0] or 0) // BLOCK))
    items = items.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks))).drop("row")
    found = []
    for (block,) in sorted(tuple(r) for r in items.select("block").distinct().collect()):
        of_block = items.filter(F.col("block") == block)
        queries = [(r["item_id"], bytes(r["text"]), None if r["answer"] is None else bytes(r["answer"]))
                   for r in of_block.drop("block").collect()]  # of about BLOCK passages
        passages = cut(_passage_rows(of_block, idf).coalesce(SVD_TASKS), "passages")
        if passages.isEmpty():
            continue
        shared = spark.sparkContext.broadcast(Searcher(queries, idf, *latent_space(passages, passages.count())))

        def search(batches, shared=shared):
            searcher = shared.value
            for batch in batches:
                ids, marks = batch["doc_id"].to_pylist(), batch["mark"].to_pylist()
                out = [(ids[d], marks[d], *hit) for d, *hit in searcher.find(batch["words"].to_pylist())]
                if out:
                    types = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                        names=["doc_id", "mark", "item_id", "lcs_words", "item_words", "cosine"])

        path = scratch_path(spark, "leaks")
        hashed.mapInArrow(search, _HIT).write.parquet(path)
        shared.destroy()  # what workers hold of this block's space goes too
        found.append(path)
    return spark.read.schema(_HIT).parquet(*found) if found else spark.createDataFrame([], _HIT)


def contaminated(docs: DataFrame, benchmark: DataFrame, doc: str = "doc_id", text: str = "text",
                 item: str = "item_id", item_text: str = "text", answer: str | None = None) -> DataFrame:
    """``doc_id, item_id, lcs_words, item_words, cosine``: which document holds which item."""
    return _hits(docs, benchmark, doc, text, item, item_text, answer).drop("mark")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; columns unchanged.

    Rows are told apart by id (a null one is an id like others) and text.
    """
    id_, mark = fresh(docs, "_id"), fresh(docs, "_mark")
    gone = _hits(docs, benchmark, doc, text, "item_id", "text", None).select(
        F.col("doc_id").alias(id_), F.col("mark").alias(mark)).distinct()
    on = F.col(doc).cast("long").eqNullSafe(F.col(id_)) & (text_mark(F.col(text)) == F.col(mark))
    return docs.join(gone, on, "left_anti")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
