import random
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from strata.llm import near_dup as N
from tests.llm.util import awkward, frame, lower, prose, split


def _set(text, k):
    words = split(lower(text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))) if len(words) >= k \
        else frozenset([tuple(words)])


def brute(rows, k, percent):
    """(id, set size, component, kept) per row, over all pairs of rows."""
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, _set(t, k)) for i, t in rows]
    for a, (i, s) in enumerate(sets):
        for b, (j, t) in enumerate(sets[:a]):
            if None not in (i, j) and s and t and 100 * len(s & t) >= percent * len(s | t):
                parent[find(a)] = find(b)
    least = defaultdict(list)
    for a, (i, _) in enumerate(sets):
        least[find(a)].append(i)
    return sorted(((i, len(s), None if i is None else min(least[find(a)]),
                    i is None or min(least[find(a)]) == i) for a, (i, s) in enumerate(sets)), key=str)


def _got(spark, rows, k=3, percent=85):
    return sorted((tuple(r) for r in N.near_duplicates(frame(spark, rows), k, percent).collect()), key=str)


def _edited(text, edits, seed):
    words, r = text.split(), random.Random(seed)
    for _ in range(edits):
        words[r.randrange(len(words))] = f"new{r.randrange(10 ** 9)}"
    return " ".join(words)


def test_awkward_rows(spark):
    rows = awkward()
    assert _got(spark, rows) == brute(rows, 3, 85)


def test_texts_that_share_an_id_are_told_apart(spark):
    a, b = prose(80, 1), prose(80, 2)
    near = a + " tail"
    rows = [(1, a), (5, near), (5, b)]
    assert _got(spark, rows) == brute(rows, 3, 85) == [(1, 78, 1, True), (5, 78, 5, True), (5, 79, 1, False)]
    for extra in (near, a):
        kept = N.keep_first(frame(spark, [(1, a), (5, extra), (5, b)])).collect()
        assert sorted((r["doc_id"], r["text"]) for r in kept) == [(1, a), (5, b)]
    kept = N.keep_first(frame(spark, [(1, a), (1, near), (1, a), (2, ""), (2, ""), (None, a), (None, a)])).collect()
    assert sorted((str(r["doc_id"]), len(r["text"])) for r in kept if r["doc_id"] != 1) == \
        [("2", 0), ("2", 0), ("None", len(a)), ("None", len(a))]
    assert [r["text"] in (a, near) for r in kept if r["doc_id"] == 1] == [True]


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_near_copies_of_every_distance(spark, k, percent):
    base = [prose(200, s) for s in range(4)]
    rows = [(100 * b + e, _edited(t, e % 12, 17 * b + e)) for b, t in enumerate(base) for e in range(40)]
    rows += [(900 + i, prose(150, 50 + i)) for i in range(30)]
    random.Random(3).shuffle(rows)
    assert _got(spark, rows, k, percent) == brute(rows, k, percent)


def test_chain_of_small_edits_is_one_component(spark):
    text, rows = prose(200, 9), []
    for i in range(30):
        rows.append((i, text))
        words = text.split()
        words[(i * 6) % 200] = f"w{i}"
        text = " ".join(words)
    got = _got(spark, rows)
    assert got == brute(rows, 3, 85)
    assert {r[2] for r in got} == {0}


def test_shared_passage_alone_links_nothing(spark):
    passage = prose(30, 1)
    rows = [(i, passage + " " + prose(120, 100 + i)) for i in range(40)]
    assert all(r[3] for r in _got(spark, rows))


def test_sketch_estimates_similarity():
    r = np.random.default_rng(1)
    for share in (0.3, 0.85):
        common = r.integers(0, 1 << 62, 400).astype(np.uint64)
        only = int(400 * (1 - share) / share / 2)
        a, b = (N.sketch(np.unique(np.concatenate([common, r.integers(0, 1 << 62, only).astype(np.uint64)])))
                for _ in range(2))
        assert abs((a == b).mean() - share) < 0.15
    assert len(N.sketch(np.array([7], np.uint64))) == N.T


def test_components_of_a_long_path(spark):
    links = spark.range(1, 200).selectExpr("id AS a", "id - 1 AS b")
    got = N.components(links).collect()
    assert len(got) == 200 and {r["component"] for r in got} == {0}
    assert N.components(links.limit(0)).count() == 0


def test_links_between_components_merge_them(spark):
    label = spark.createDataFrame([(1, 1), (2, 1), (5, 5), (7, 5), (8, 8), (9, 8)], "rep long, component long")
    links = spark.createDataFrame([(7, 2), (7, 5), (20, 9), (31, 30), (2, 1)], "a long, b long")
    got = sorted(tuple(r) for r in N.merged(label, links).collect())
    assert got == [(1, 1), (2, 1), (5, 1), (7, 1), (8, 8), (9, 8), (20, 8), (30, 30), (31, 30)]
    assert N.merged(label, links.limit(0)).count() == 6 and N.merged(label.limit(0), links.limit(1)).count() == 2


def test_empty_table(spark):
    assert _got(spark, [(1, "a")]) == [(1, 1, 1, True)]
    assert N.near_duplicates(frame(spark, awkward()).limit(0)).count() == 0


def test_keep_first_keeps_one_of_each_group_with_its_columns(spark):
    rows = [(1, prose(80, 1)), (2, prose(80, 1)), (3, _edited(prose(80, 1), 1, 1)), (4, prose(80, 2)),
            (4, prose(80, 2)), (5, ""), (6, None), (None, "x"), (None, "x")]
    docs = frame(spark, rows)
    kept = N.keep_first(docs)
    assert kept.columns == docs.columns
    got = defaultdict(int)
    for r in kept.collect():
        got[r["doc_id"]] += 1
    assert dict(got) == {1: 1, 4: 1, 5: 1, 6: 1, None: 2}


def test_stage_keeps_one_document_of_each_brute_force_group(spark):
    rows = [(i, _edited(prose(150, i % 5), i % 7, i)) for i in range(35)]
    kept = corpus_pipeline.near_dedup(spark, frame(spark, rows), "").collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(i for i, _, _, k in brute(rows, 5, 80) if k)
