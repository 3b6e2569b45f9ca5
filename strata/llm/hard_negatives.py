"""Operator 11, hard-negative mining: length buckets with sorted coordinate lists.

Vectors are whole numbers ``floor(scale * c)`` and scores their inner products,
so every comparison is exact. All rows are range-sorted by length, and each run
of up to ``BUCKET_ROWS`` neighbours makes one bucket, a row of the index table:
its vectors, and for every coordinate the order of its rows by that coordinate
of the unit vector (the sorted list). The index is made once and read by every
search.

A search looks for rows whose score with an anchor reaches a bound that rises as
better rows are found. In a bucket whose longest vector has length l, a score of
b needs a cosine of at least t = b / (|anchor| l): the bucket is left out where
t > 1. Otherwise a row within the angle arccos(t) of the anchor must have, in
each coordinate f, a value between cos(a + arccos t) and cos(a - arccos t), a
being the anchor's angle to that axis. The ranges of the anchor's ``FOCUS``
largest coordinates are found in the sorted lists by bisection, the shortest one
gives the candidates, the other ranges intersect them, and what is left is
scored exactly. Bounds that exclude nothing are scored as one matrix product.

Anchors are a stated query set, taken in blocks of about ``BLOCK_ANCHORS``; a
block and its at most ``positives`` scores an anchor are what tasks receive.
Every task returns its best few rows per anchor and score, and Spark ranks them.
No bucket, candidate or partner is capped.

Defined results: rows with a null id, label or vector, or with a null or
non-finite component, take no part. Rows of the same id are rows of their own:
a row is never its own positive, but its copies are, and each anchor row gives
its results. Equal scores rank by the smaller id, equal ids in any order (such
results are equal). Shorter vectors count as ending in zeros, empty ones score 0.
An anchor without a positive, or a positive without a fitting negative, gives no
row. An empty table gives none. A score beyond the long range raises. Extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import cut, scratch_path, table
from strata.llm.vectors import largest, matrix, usable, whole

BUCKET_ROWS = 4096
BLOCK_ANCHORS = 1 << 16
PARTITION_ROWS = 1 << 16
FOCUS = 6
# Cosines below this leave nearly every row in range.
LEAST_COSINE = 0.3
PRODUCT_CELLS = 1 << 22
_NONE = np.iinfo(np.int64).min


def vector_rows(rows: DataFrame, scale: int, vec: str, vector: str, label: str) -> DataFrame:
    """``row, vec_id, label, x, length`` of the rows that take part, as a written table."""
    fit = rows.filter(F.col(vec).isNotNull() & F.col(label).isNotNull() & usable(F.col(vector)))
    x = whole(F.col(vector), scale)
    made = fit.select(F.col(vec).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), x.alias("x"))
    square = F.aggregate("x", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    # the number only tells rows apart; it is read from the written table ever after
    return cut(made.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "x",
                           F.sqrt(square).alias("length")), "vectors")


_BUCKET = ("row array<bigint>, vec_id array<bigint>, label array<bigint>, "
           "bytes int, vectors binary, lists binary")


def length_buckets(vectors: DataFrame, width: int, count: int) -> DataFrame:
    """The index: one row for each run of up to ``BUCKET_ROWS`` rows of similar length."""

    def build(batches):
        held: list[pa.RecordBatch] = []

        def bucket():
            t = pa.Table.from_batches(held)
            x = matrix(t["x"], width)
            size = next((s for s in (2, 4) if largest(x) < 1 << (8 * s - 1)), 8)
            length = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
            unit = x / np.maximum(length, 1e-300)[:, None]
            lists = np.argsort(unit, axis=0, kind="stable").T.astype("<u2")
            columns = [[t[c].to_pylist()] for c in ("row", "vec_id", "label")]
            return pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.list_(pa.int64())) for c in columns), pa.array([size], pa.int32()),
                 pa.array([x.astype(f"<i{size}").tobytes()], pa.binary()), pa.array([lists.tobytes()], pa.binary())],
                names=["row", "vec_id", "label", "bytes", "vectors", "lists"])

        n = 0
        for batch in batches:
            at = 0
            while at < len(batch):
                part = batch.slice(at, BUCKET_ROWS - n)
                held.append(part)
                at, n = at + len(part), n + len(part)
                if n == BUCKET_ROWS:
                    yield bucket()
                    held, n = [], 0
        if n:
            yield bucket()

    parts = max(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-count // PARTITION_ROWS))
    # the row number parts rows of equal length, however many
    ordered = (vectors.repartitionByRange(parts, F.desc("length"), "row")
               .sortWithinPartitions(F.desc("length"), "row"))
    return cut(ordered.select("row", "vec_id", "label", "x").mapInArrow(build, _BUCKET), "length-buckets")


class Bucket:
    """One row of the index, as arrays."""

    def __init__(self, r: dict, width: int):
        self.row, self.vec_id, self.label = (np.array(r[c], np.int64) for c in ("row", "vec_id", "label"))
        n = len(self.row)
        self.x = np.frombuffer(r["vectors"], f"<i{r['bytes']}").reshape(n, width).astype(np.int64)
        self.values = self.x.astype(np.float64)
        self.length = np.sqrt((self.values ** 2).sum(axis=1))
        self.longest = float(self.length.max(initial=0))
        self.largest = largest(self.x)
        self.lists = np.frombuffer(r["lists"], "<u2").reshape(width, n)
        unit = self.values / np.maximum(self.length, 1e-300)[:, None]
        self.sorted = np.take_along_axis(unit.T, self.lists.astype(np.int64), axis=1)
        self.place = np.empty((width, n), np.int32)  # of each row in each list
        np.put_along_axis(self.place, self.lists.astype(np.int64), np.arange(n, dtype=np.int32)[None, :], axis=1)


class Anchors:
    """A block of anchors and, for each, its levels: how many rows to keep, and between which scores."""

    def __init__(self, row, vec_id, label, x, lower, upper, keep: int, same: bool):
        self.row, self.vec_id, self.label, self.x = row, vec_id, label, x
        self.lower, self.upper = lower, upper  # anchors x levels; a level with upper < lower finds nothing
        self.keep, self.same = keep, same

    def search(self, buckets, width: int):
        """(anchor's place, level, id, row, score) arrays of the best rows of each level in the buckets."""
        n, levels = self.lower.shape
        values = self.x.astype(np.float64)
        length = np.sqrt((values ** 2).sum(axis=1))
        unit = values / np.maximum(length, 1e-300)[:, None]
        focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :FOCUS]
        angle = np.arccos(np.clip(np.take_along_axis(unit, focus, axis=1), -1, 1))
        largest_x = largest(self.x)
        score = np.full((n, levels, self.keep), _NONE, np.int64)
        ids = np.zeros((n, levels, self.keep), np.int64)
        rows = np.zeros((n, levels, self.keep), np.int64)
        bound = self.lower.copy()  # what a row must reach to matter at a level
        active = self.upper >= self.lower
        least = np.where(active, bound, np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)

        def take(a: int, at: np.ndarray, s: np.ndarray, b: Bucket) -> None:
            right = (b.label[at] == self.label[a]) == self.same
            right &= (s >= least[a]) & (b.row[at] != self.row[a])
            if not right.any():
                return
            at, s = at[right], s[right]
            for k in range(levels):
                if not active[a, k]:
                    continue
                fits = np.flatnonzero((s >= bound[a, k]) & (s <= self.upper[a, k]))
                if not len(fits):
                    continue
                full = np.flatnonzero(score[a, k] != _NONE)
                every = np.concatenate([score[a, k, full], s[fits]])
                every_id = np.concatenate([ids[a, k, full], b.vec_id[at[fits]]])
                every_row = np.concatenate([rows[a, k, full], b.row[at[fits]]])
                best = np.lexsort((every_id, -every))[:self.keep]
                m = len(best)
                score[a, k, :m], ids[a, k, :m], rows[a, k, :m] = every[best], every_id[best], every_row[best]
                if m == self.keep:
                    bound[a, k] = max(bound[a, k], every[best[-1]])
            least[a] = bound[a][active[a]].min()

        for b in buckets:
            exact = largest_x * b.largest * max(width, 1) < 1 << 53

            def scores(at, a, b=b, exact=exact):
                if exact:
                    return (b.values[at] @ values[a].T).astype(np.int64)
                product = b.x[at].astype(object) @ self.x[a].astype(object).T
                if largest(product) >= 1 << 63:
                    raise OverflowError("a score does not fit into a long")
                return product.astype(np.int64)

            alive = active.any(axis=1)
            with np.errstate(divide="ignore", invalid="ignore"):
                # a little lower than exact, so that rounding loses nothing
                cosine = least / (length * b.longest) * (1 - 1e-9)
            cosine[(least <= 0) | (length == 0)] = -1
            alive &= cosine <= 1
            open_ = np.flatnonzero(alive & (cosine < LEAST_COSINE))
            step = max(1, PRODUCT_CELLS // max(len(b.row), 1))
            for i in range(0, len(open_), step):
                some = open_[i:i + step]
                product = scores(slice(None), some)
                for j, a in enumerate(some.tolist()):
                    column = product[:, j]
                    at = np.flatnonzero(column >= least[a])
                    take(a, at, column[at], b)
            narrow = np.flatnonzero(alive & (cosine >= LEAST_COSINE))
            if not len(narrow):
                continue
            reach = np.arccos(np.clip(cosine[narrow], -1, 1))[:, None]
            low = np.cos(np.minimum(angle[narrow] + reach, np.pi)) - 1e-9
            high = np.cos(np.maximum(angle[narrow] - reach, 0)) + 1e-9
            f = focus[narrow]
            first, last = np.empty(f.shape, np.int64), np.empty(f.shape, np.int64)
            for c in np.unique(f):
                here = f == c
                first[here] = np.searchsorted(b.sorted[c], low[here], "left")
                last[here] = np.searchsorted(b.sorted[c], high[here], "right")
            size = last - first
            shortest = np.argmin(size, axis=1)
            for j, a in enumerate(narrow.tolist()):
                k = shortest[j]
                at = b.lists[f[j, k], first[j, k]:last[j, k]].astype(np.int64)
                for i in range(f.shape[1]):
                    if i != k and len(at) and size[j, i] < len(b.row):
                        place = b.place[f[j, i], at]
                        at = at[(place >= first[j, i]) & (place < last[j, i])]
                if len(at):
                    take(a, at, scores(at, a), b)
        place, level, slot = np.nonzero(score != _NONE)
        return place, level, ids[place, level, slot], rows[place, level, slot], score[place, level, slot]


def _search(index: DataFrame, anchors: Anchors, width: int) -> DataFrame:
    """``place, level, vec_id, row, score``: each task's best rows."""
    shared = index.sparkSession.sparkContext.broadcast(anchors)

    def run(batches):
        def buckets():
            for batch in batches:
                for i in range(len(batch)):
                    yield Bucket(batch.slice(i, 1).to_pylist()[0], width)

        found = shared.value.search(buckets(), width)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found],
                                         names=["place", "level", "vec_id", "row", "score"])

    return index.mapInArrow(run, "place long, level long, vec_id long, row long, score long")


def _best(found: DataFrame, keep: int) -> DataFrame:
    """The first ``keep`` rows of each anchor and level over all tasks, with ``rank`` from 1."""
    w = Window.partitionBy("place", "level").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= keep)


def hard_negatives(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80,
                   high: int = 100, scale: int = 256, vec: str = "vec_id", vector: str = "embedding",
                   label: str = "label") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchor`` says over ``vec_id`` and ``label`` which rows are anchors. An
    anchor's positives are its best ``positives`` other rows of its label; for
    each, the best ``negatives`` rows of other labels whose score is between
    ``low`` and ``high`` per cent of the positive's, both included.
    """
    spark = rows.sparkSession
    vectors = vector_rows(rows, scale, vec, vector, label)
    queries = vectors.filter(anchor).select("row", "vec_id", "label", "x")
    width, count = vectors.agg(F.max(F.size("x")), F.count(F.lit(1))).first()
    schema = ("anchor_id long, positive_id long, rank int, negative_id long, "
              "positive_score long, negative_score long")
    wanted = queries.count()
    if not wanted:
        return spark.createDataFrame([], schema)
    index = length_buckets(vectors, width, count)
    blocks = -(-wanted // BLOCK_ANCHORS)
    done = []
    for block in range(blocks):
        of_block = queries.filter(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block).toArrow()
        if not len(of_block):
            continue
        row, vec_id, lab = (of_block[c].to_numpy() for c in ("row", "vec_id", "label"))
        x, n = matrix(of_block["x"], width), len(of_block)
        every = np.full((n, 1), _NONE + 1), np.full((n, 1), np.iinfo(np.int64).max)
        near = cut(_best(_search(index, Anchors(row, vec_id, lab, x, *every, positives, True), width), positives),
                   "positives")
        # at most ``positives`` scores for each anchor of the block
        pairs = near.select("place", "score").distinct().toArrow()
        place, score = pairs["place"].to_numpy(), pairs["score"].to_numpy()
        order = np.lexsort((score, place))
        place, score = place[order], score[order]
        level = np.arange(len(place)) - np.searchsorted(place, place)
        lower, upper = np.zeros((n, positives), np.int64), np.full((n, positives), -1)
        # the least whole number that reaches low per cent
        lower[place, level] = -(-low * score.astype(object) // 100)
        upper[place, level] = high * score.astype(object) // 100
        far = _best(_search(index, Anchors(row, vec_id, lab, x, lower, upper, negatives, False), width), negatives)
        names = spark.createDataFrame(
            pa.table({"place": place, "level": level, "score": score, "anchor_id": vec_id[place]}))
        named = near.select("place", "score", F.col("vec_id").alias("positive_id")).join(names, ["place", "score"])
        out = named.join(far.select("place", "level", F.col("rank").cast("int").alias("rank"),
                                    F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")),
                         ["place", "level"])
        path = scratch_path(spark, "hard-negatives")
        out.select("anchor_id", "positive_id", "rank", "negative_id", F.col("score").alias("positive_score"),
                   "negative_score").write.parquet(path)
        done.append(path)
    return spark.read.schema(schema).parquet(*done)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth row of ``embeddings``, over all rows."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.col("label").cast("long")
    shifted = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(rows.select("vec_id", "embedding", shifted.alias("label")), F.col("vec_id") % 100 == 0)


OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positive AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id
                               ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positive p JOIN scored s
  ON s.anchor_id = p.anchor_id AND NOT s.same
 AND 100 * s.score BETWEEN 80 * p.positive_score AND 100 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) <= 5
"""
