"""Operator 4, near duplicates: similarity sketches, banding, exact verification.

A document's set holds the hashes of its distinct ``k``-word shingles. Its
sketch has ``T`` coordinates, filled in rounds: in round i each element is
hashed to one bin with a value that starts with i, and each bin keeps its least
value. After round T-1 the rounds place every element in bin i-T, so no
coordinate stays empty and the share of equal coordinates estimates the Jaccard
similarity with the concentration that independent coordinates would have. A
set needs about ``T log T / size`` rounds, one or two for an ordinary text.

Bands of ``ROWS`` coordinates give the buckets. At similarity 0.85 two sets
share none of the 32 bands with probability 5e-11 (at 0.8: 5e-8). Buckets are
never expanded into pairs:

1. Documents with equal sets are one class; only its smallest id goes on.
2. In each bucket, every member is paired with the bucket's smallest id alone
   (a linear number of pairs); sketches drop the pairs that are far below the
   threshold, and the rest is verified on the full sets.
3. Where a bucket's members are then still in different components, each is
   paired with the next one in the order of other sketch coordinates, its
   likeliest link there (a linear number of pairs again): a group whose members
   link with many others, though not with its smallest id, becomes one
   component. This is done up to ``ROUNDS`` times, as long as one in ``YIELD``
   of the pairs tried is a link.
4. What is still open goes to an exact join: a pair over the threshold must share
   one of its rarest elements (prefix filter), at positions that leave room for
   the overlap. Only pairs of different components are looked at. Of each two
   components the pair with the most alike sketches is verified first; one link
   settles all their other pairs, and whatever is open after that is verified.

So the result is the components of the graph of all verified links that share
a band, and bucket sizes bound nothing. Links and labels stay in tables; links
found in steps 3 and 4 are followed between the components known by then, not
through all links anew.

Defined results: texts without words have an empty set and link with nothing;
texts with fewer than ``k`` words have one shingle, the whole sequence. Rows
are judged one by one, by their text: a node is a class of equal sets, numbered
by itself, so texts that share an id are not linked by it, and a component's id
is the smallest id of its rows. Rows with a null id take part in no link: their
component is null and they are kept. An empty table gives no rows. Extra columns
are carried by ``keep_first`` and ignored by the query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import WordTable, cut, fresh, table, text_mark

T = 128
ROWS = 4
BANDS = T // ROWS
# Pairs whose sketches agree less than this below the threshold are dropped: six
# standard deviations of the estimate at similarity 0.8 with 128 coordinates.
SKETCH_SLACK = 0.21
# Pairs that agree less than this below it are not tried before the exact join.
LIKELY_SLACK = 0.06
ROUNDS = 3
ORDER = 16
YIELD = 20
PART = 512
RARITY_BITS = 18

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijective mix of 64-bit integers."""
    x = (x ^ (x >> _S33)) * _M1
    x = (x ^ (x >> _S33)) * _M2
    return x ^ (x >> _S33)


def word_table() -> WordTable:
    """Words (bytes) to fixed 64-bit hashes."""
    return WordTable(xxhash.xxh64_intdigest)


def shingle_set(text: bytes | None, k: int, hashes: WordTable) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles of a text (A-Z lower-cased)."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = len(h) - k + 1
    parts = min(k, len(h))
    out = np.full(max(n, 1), parts, np.uint64)
    for i in range(parts):
        out = mix(out + h[i:i + len(out)])
    return np.unique(out)


def sketch(elements: np.ndarray) -> np.ndarray:
    """``T`` 32-bit coordinates of a non-empty set."""
    best = np.full(T, np.uint64(0xFFFFFFFFFFFFFFFF))
    for i in range(2 * T):
        x = mix(elements + np.uint64((i + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        value = (np.uint64(i) << np.uint64(56)) | (x >> np.uint64(8))
        if i < T:
            np.minimum.at(best, (x % np.uint64(T)).astype(np.int64), value)
        else:
            best[i - T] = min(best[i - T], value.min())
        # values of later rounds are larger: once no bin is empty, nothing changes
        if best.max() != np.uint64(0xFFFFFFFFFFFFFFFF):
            break
    return (mix(best) >> np.uint64(32)).astype("<u4")


def band_keys(coordinates: np.ndarray) -> np.ndarray:
    """One 64-bit bucket key for each band of a sketch."""
    rows = coordinates.astype(np.uint64).reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(ROWS):
        key = mix(key + rows[:, i])
    return key.view(np.int64)


def document_sets(docs: DataFrame, k: int) -> DataFrame:
    """``doc_id, mark, n, digest, sketch`` per row; the digest of equal sets is equal."""

    def sets(batches):
        hashes = word_table()
        for batch in batches:
            n, digests, sketches = [], [], []
            for text in batch["text"].to_pylist():
                s = shingle_set(text, k, hashes)
                n.append(len(s))
                digests.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                sketches.append(sketch(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["mark"], pa.array(n, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(sketches, pa.binary())], names=["doc_id", "mark", "n", "digest", "sketch"])

    return docs.mapInArrow(sets, "doc_id long, mark binary, n long, digest binary, sketch binary")


def bands(reps: DataFrame) -> DataFrame:
    """``key, rep`` for each band of each representative."""

    def explode(batches):
        for batch in batches:
            reps_, blobs = batch["rep"].to_numpy(), batch["sketch"].to_pylist()
            keys = [band_keys(np.frombuffer(b, "<u4")) for b in blobs]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64)),
                 pa.array(np.repeat(reps_, BANDS))], names=["key", "rep"])

    return reps.select("rep", "sketch").mapInArrow(explode, "key long, rep long")


def _similar_sketches(pairs: DataFrame, reps: DataFrame, least: float) -> DataFrame:
    """The pairs whose sketches agree in a share ``same`` of at least ``least``."""
    names = pairs.columns

    def agree(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch[c].to_pylist()), "<u4").reshape(-1, T) for c in ("sa", "sb"))
            same = (a == b).mean(axis=1)
            kept = batch.select(names).append_column("same", pa.array(same))
            yield kept.filter(pa.array(same >= least))

    s = reps.select("rep", "sketch")
    joined = (pairs.join(s.withColumnsRenamed({"rep": "a", "sketch": "sa"}), "a")
              .join(s.withColumnsRenamed({"rep": "b", "sketch": "sb"}), "b"))
    schema = ", ".join(f"{c} long" for c in names) + ", same double"
    return joined.select(*names, "sa", "sb").mapInArrow(agree, schema)


def verify(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs with ``100 * intersection >= percent * union`` on the full sets.

    Columns of whole numbers beside ``a, b`` are carried along.
    """
    names = [c for c in pairs.columns if c != "same"]

    def check(batches):
        hashes, held = word_table(), {}
        for batch in batches:
            keep, last_b, set_b = [], None, None
            for a, b, ta, tb in zip(*(batch[c].to_pylist() for c in ("a", "b", "ta", "tb")), strict=True):
                if last_b != b:
                    last_b, set_b = b, shingle_set(tb, k, hashes)
                if a not in held:
                    if len(held) >= 1000:
                        held.clear()
                    held[a] = shingle_set(ta, k, hashes)
                set_a = held[a]
                both = len(np.intersect1d(set_a, set_b, assume_unique=True))
                keep.append(100 * both >= percent * (len(set_a) + len(set_b) - both))
            yield batch.select(names).filter(pa.array(keep, pa.bool_()))

    joined = (pairs.join(texts.withColumnsRenamed({"rep": "a", "text": "ta"}), "a")
              .join(texts.withColumnsRenamed({"rep": "b", "text": "tb"}), "b"))
    return joined.select(*names, "ta", "tb").mapInArrow(check, ", ".join(f"{c} long" for c in names))


def _stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one other and none that others hang on does."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.agg(F.expr("count_if(up > 1 OR (up > 0 AND down > 0))")).first()[0] == 0


def components(links: DataFrame) -> DataFrame:
    """``rep, component`` for every linked node: the smallest id reachable.

    Alternating large-star and small-star steps; each keeps the components and
    brings the links nearer to stars around the smallest ids. The number of
    rounds grows with the logarithm of the longest chain.
    """
    edges = cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                .filter("u <> v").distinct(), "links")
    while not _stars(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = cut(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "links-min")
        large = (both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        large = cut(large, "links-large")
        least = cut(large.groupBy("u").agg(F.min("v").alias("m")), "links-min")
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        edges = cut(small, "links-small")
    return edges.select(F.col("u").alias("rep"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("rep"), F.col("v").alias("component"))).distinct()


def merged(label: DataFrame, links: DataFrame) -> DataFrame:
    """``label`` (``rep, component``) after ``links``; only those between components are followed."""

    def of(end: str) -> DataFrame:
        return label.select(F.col("rep").alias(end), F.col("component").alias("c" + end))

    between = links.select("a", "b").join(of("a"), "a", "left").join(of("b"), "b", "left").select(
        F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    moved = cut(components(between), "moved")
    to = moved.select(F.col("rep").alias("component"), F.col("component").alias("to"))
    after = label.join(to, "component", "left").select("rep", F.coalesce("to", "component").alias("component"))
    return after.union(moved.join(label, "rep", "left_anti").select("rep", "component"))


def _still_open(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """The pairs whose components ``ca, cb`` are still two after a merge."""
    for c in ("ca", "cb"):
        # a component's id is one of its own nodes
        to = label.select(F.col("rep").alias(c), F.col("component").alias("to"))
        pairs = pairs.join(to, c, "left").withColumn(c, F.coalesce("to", c)).drop("to")
    return pairs.filter("ca <> cb").select("a", "b")


def _ordered(pairs: DataFrame, x: str, cx: str, y: str, cy: str) -> DataFrame:
    """Distinct ``a, b, ca, cb``: two nodes, the larger first, and their components."""
    first = F.col(x) > F.col(y)
    return pairs.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b"),
                        F.when(first, F.col(cx)).otherwise(F.col(cy)).alias("ca"),
                        F.when(first, F.col(cy)).otherwise(F.col(cx)).alias("cb")).distinct()


def _neighbours(members: DataFrame, reps: DataFrame, round_: int) -> DataFrame:
    """Each member of a bucket with the next one in sketch order, if their components differ.

    The order is that of ``ORDER`` coordinates, others in each round, so
    neighbours agree in the first of them and are the likeliest links. A pair a
    member, whatever the bucket's size; a large bucket is ordered in parts of
    about ``PART`` members.
    """
    width = 4 * ORDER
    order = F.substring("sketch", 1 + width * round_, width)
    part = F.pmod(F.xxhash64("rep", F.lit(round_)), F.ceil(F.col("n") / PART))
    w = Window.partitionBy("key", "part").orderBy("order", "rep")
    next_ = members.join(reps.select("rep", order.alias("order")), "rep").withColumn("part", part).select(
        F.col("rep").alias("x"), "component", F.lead("rep").over(w).alias("y"), F.lead("component").over(w).alias("other"))
    return _ordered(next_.filter("component <> other"), "x", "component", "y", "other")


def _rarity(texts: DataFrame, k: int) -> np.ndarray:
    """How many sets have an element of each of ``2**RARITY_BITS`` hash classes."""
    size = 1 << RARITY_BITS

    def count(batches):
        total, hashes = np.zeros(size, np.int64), word_table()
        for batch in batches:
            for t in batch["text"].to_pylist():
                total[(shingle_set(t, k, hashes) & np.uint64(size - 1)).astype(np.int64)] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["class", "n"])

    counts = (texts.select("text").mapInArrow(count, "class long, n long")
              .groupBy("class").agg(F.sum("n").alias("n")))
    out = np.zeros(size, np.int64)
    for batch in counts.toArrow().to_batches():  # at most 2**RARITY_BITS rows
        out[batch["class"].to_numpy()] = batch["n"].to_numpy()
    return out


def _open_pairs(open_texts: DataFrame, labels: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs of different components that may be over the threshold, exactly.

    Elements are ordered by rarity. Sets a, b over the threshold overlap in at
    least ``need = percent (|a| + |b|) / (100 + percent)`` elements, so the
    first common element lies within the first ``|a| - need + 1`` of either, and
    what follows it in each must still hold the rest of the overlap.
    """
    rarity = _rarity(open_texts, k)

    def prefixes(batches):
        mask, hashes = np.uint64((1 << RARITY_BITS) - 1), word_table()
        for batch in batches:
            cols = {c: [] for c in ("token", "rep", "component", "n", "pos")}
            for rep, label, text in zip(*(batch[c].to_pylist() for c in ("rep", "component", "text")), strict=True):
                s = shingle_set(text, k, hashes)
                s = s[np.lexsort((s, rarity[(s & mask).astype(np.int64)]))]
                n = len(s)
                # the smallest partner has percent/100 of this set's elements
                length = n - -(-percent * n // 100) + 1
                cols["token"].append(s[:length].view(np.int64))
                cols["pos"].append(np.arange(length))
                for c, v in (("rep", rep), ("component", label), ("n", n)):
                    cols[c].append(np.full(length, v, np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(v).astype(np.int64) if v else np.zeros(0, np.int64)) for v in cols.values()],
                names=list(cols))

    rows = cut(open_texts.join(labels, "rep").select("rep", "component", "text").mapInArrow(
        prefixes, "token long, rep long, component long, n long, pos long"), "prefixes")
    # an element that only one component has links nothing new
    mixed = cut(rows.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y"))
                .filter("x <> y").select("token"), "prefix-tokens")
    rows = rows.join(mixed, "token")
    a, b = rows.alias("a"), rows.alias("b")
    need = f"{percent} * (a.n + b.n)"
    room = f"{100 + percent} * least(a.n - a.pos, b.n - b.pos)"
    met = a.join(b, F.expr(f"a.token = b.token AND a.component < b.component AND {room} >= {need}"))
    return _ordered(met, "a.rep", "a.component", "b.rep", "b.component")


def _judged(rows: DataFrame, k: int, percent: int) -> DataFrame:
    """``doc_id, mark, n, digest, first`` for every row of ``doc_id, mark, text``.

    ``first`` is the component's least ``doc_id, mark``, null for rows that link
    with nothing because they have no id or no set.
    """
    sets = cut(document_sets(rows, k), "sets")
    real = sets.filter(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    classes = real.groupBy("digest").agg(F.min(F.struct("doc_id", "mark", "sketch")).alias("m"))
    classes = cut(classes.select("digest", F.monotonically_increasing_id().alias("rep"), "m.*"), "classes")
    keys = cut(bands(classes), "bands")
    buckets = keys.groupBy("key").agg(F.min("rep").alias("b"), F.max("rep").alias("top")).filter("b <> top")
    buckets = cut(buckets.select("key", "b"), "buckets")
    members = cut(keys.join(buckets, "key").select("key", F.col("rep").alias("a"), "b"), "members")
    stars = members.filter("a <> b").select("a", "b").distinct()
    close = cut(_similar_sketches(stars, classes, percent / 100 - SKETCH_SLACK), "close")
    named = classes.join(members.select(F.col("a").alias("rep")).distinct(), "rep").select("rep", "doc_id", "mark")
    # rows that repeat both the id and the text have one text
    texts = cut(rows.join(named, ["doc_id", "mark"]).dropDuplicates(["doc_id", "mark"]).select("rep", "text"), "texts")
    links = cut(verify(close, texts, k, percent), "verified")
    label = cut(components(links), "labels")

    def labelled(df: DataFrame) -> DataFrame:
        return df.join(label, "rep", "left").select(
            *df.columns, F.coalesce("component", "rep").alias("component"))

    def undecided() -> DataFrame:
        """``key, rep, component, n`` of the buckets whose members are in several components."""
        seen = labelled(members.select("key", F.col("a").alias("rep")))
        split = seen.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"),
                                        F.count(F.lit(1)).alias("n")).filter("x <> y AND n > 2")
        # two members: the star was the only pair
        return cut(seen.join(split.select("key", "n"), "key"), "undecided")

    left = undecided()
    for i in range(ROUNDS):
        if left.isEmpty():
            break
        tried = cut(_similar_sketches(_neighbours(left, classes, i), classes, percent / 100 - LIKELY_SLACK), "likely")
        met = cut(verify(tried, texts, k, percent), "verified")
        found = met.count()
        if found:
            label = cut(merged(label, met), "labels")
            left = undecided()
        if found * YIELD <= tried.count():
            break
    open_reps = cut(left.select("rep").distinct(), "open")
    open_texts = cut(texts.join(open_reps, "rep"), "open-texts")
    pairs = cut(_open_pairs(open_texts, labelled(open_reps), k, percent), "open-pairs")
    pairs = cut(_similar_sketches(pairs, classes, percent / 100 - SKETCH_SLACK), "close")
    # the likeliest pair of each two components first: one link settles all their other pairs
    likeliest = pairs.groupBy(F.least("ca", "cb").alias("x"), F.greatest("ca", "cb").alias("y")).agg(
        F.max(F.struct("same", "a", "b", "ca", "cb")).alias("m")).select("m.a", "m.b", "m.ca", "m.cb")
    met = cut(verify(likeliest, texts, k, percent), "verified")
    if not met.isEmpty():
        label = cut(merged(label, met), "labels")
        pairs = _still_open(pairs, label)
    more = cut(verify(pairs, texts, k, percent), "verified")
    final = cut(merged(label, more), "labels") if not more.isEmpty() else label
    own = F.struct("doc_id", "mark")
    linked = classes.join(final, "rep").select("digest", "component", own.alias("own"))
    first = linked.groupBy("component").agg(F.min("own").alias("first"))
    node = cut(linked.join(first, "component").select("digest", "first"), "nodes")
    # a class that links with no other has its own first row
    alone = classes.select("digest", own.alias("own"))
    node = alone.join(node, "digest", "left").select("digest", F.coalesce("first", "own").alias("first"))
    out = sets.drop("sketch").join(node, "digest", "left")
    return out.withColumn("first", F.when(F.col("doc_id").isNotNull(), F.col("first")))


def _rows(docs: DataFrame, doc: str, text: str) -> DataFrame:
    return docs.select(F.col(doc).cast("long").alias("doc_id"), text_mark(F.col(text)).alias("mark"),
                       F.col(text).cast("binary").alias("text"))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80,
                    doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``."""
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("first.doc_id", "doc_id"))
    return _judged(_rows(docs, doc, text), k, percent).select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"))


def keep_first(docs: DataFrame, k: int = 5, percent: int = 80, doc: str = "doc_id",
               text: str = "text") -> DataFrame:
    """``docs`` with one row of each component, its columns unchanged.

    The row with the component's least id stays, and of several texts with that
    id one; rows that repeat both its id and its text stay once. Rows without an
    id or without words all stay. Rows are told apart by id and text.
    """
    spark_rows = cut(_judged(_rows(docs, doc, text), k, percent).filter("first IS NOT NULL").select(
        "doc_id", "mark", (F.struct("doc_id", "mark") == F.col("first")).alias("stays")), "judged")
    id_, mark = fresh(docs, "_id"), fresh(docs, "_mark")

    def named(df: DataFrame) -> DataFrame:
        return df.select(F.col("doc_id").alias(id_), F.col("mark").alias(mark))

    def met(df: DataFrame, how: str) -> DataFrame:
        on = (F.col(doc).cast("long") == F.col(id_)) & (text_mark(F.col(text)) == F.col(mark))
        return docs.join(named(df), on, how)

    several = cut(spark_rows.filter("stays").groupBy("doc_id", "mark").count().filter("count > 1"), "repeated")
    gone = spark_rows.filter("NOT stays").select("doc_id", "mark").distinct()
    once = (met(several, "left_semi").withColumns({id_: F.col(doc), mark: text_mark(F.col(text))})
            .dropDuplicates([id_, mark]).drop(id_, mark))
    return met(gone.union(several.select("doc_id", "mark")), "left_anti").unionByName(once)


def op4_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's near-duplicate component, by 3-word shingles at 0.85."""
    return near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)
