import random

import numpy as np
import pytest

import corpus_pipeline
from strata.llm import decontamination as D
from tests.llm.util import awkward, frame, prose


def _benchmark(spark, rows, schema="item_id long, text string"):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def items():
    return [(i, prose(12 + 4 * i, 1000 + i, 300).capitalize() + ".") for i in range(12)]


@pytest.fixture(scope="module")
def planted(items):
    """Documents by id, and which items each holds."""
    r, docs, holds = random.Random(4), [], set()
    for i in range(60):
        docs.append((i, prose(r.randint(30, 400), i, 900)))
    for i, (item, text) in enumerate(items):
        exact = prose(100, 300 + i) + " " + text + " " + prose(150, 400 + i)
        loud = prose(40, 500 + i) + "\n" + text.upper().replace(" ", ", ") + " " + prose(20, 600 + i)
        words = text.split()
        for at in r.sample(range(len(words)), len(words) // 8):
            words[at] = "instead"
        for k, t in enumerate((exact, loud, prose(300, 700 + i) + " " + " ".join(words), text)):
            docs.append((100 + 10 * i + k, t))
            holds.add((100 + 10 * i + k, item))
    r.shuffle(docs)
    return docs, holds


def _got(spark, docs, items):
    return {(r["doc_id"], r["item_id"]) for r in D.contaminated(frame(spark, docs), _benchmark(spark, items)).collect()}


def test_planted_passages_are_found_and_nothing_else(spark, items, planted):
    docs, holds = planted
    assert _got(spark, docs, items) == holds


def test_matches_a_brute_force_lcs(spark, items, planted):
    """Every document against every item in every stretch, without the search."""
    docs, _ = planted
    expected = set()
    for i, text in items:
        item = D.Item(i, text.encode(), None)
        for d, t in docs:
            words = D.word_hashes(t.encode()).tolist()
            if item.confirm(words, 0, len(words)):
                expected.add((d, i))
    assert _got(spark, docs, items) == expected


def test_lcs_by_bits_is_the_textbook_lcs():
    r = random.Random(2)
    for _ in range(200):
        a, b = ([r.choice("abcde") for _ in range(r.randint(1, 20))] for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        item = D.Item(1, " ".join(a).encode(), b"")
        assert item.common(D.word_hashes(" ".join(b).encode()).tolist()) == table[-1, -1]


def test_answer_lowers_the_share_that_is_needed(spark):
    question, answer = prose(20, 1, 900), "the reply is forty two"
    kept = " ".join(w if i % 2 else f"other{i}" for i, w in enumerate(question.split()))
    docs = [(1, f"{prose(50, 2)} {kept} {answer} {prose(50, 3)}"), (2, f"{prose(50, 2)} {kept} {prose(55, 3)}")]
    docs += [(10 + i, prose(80, 50 + i, 900)) for i in range(30)]
    rows = [(5, f"{question} {answer}", answer)]
    got = D.contaminated(frame(spark, docs), _benchmark(spark, rows, "item_id long, text string, reply string"),
                         answer="reply").collect()
    assert [r["doc_id"] for r in got] == [1]


def test_more_items_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK", 5)
    items = [(i, prose(20, 50 + i, 900)) for i in range(13)]
    docs = [(i, prose(30, 200 + i) + " " + t) for i, t in items]
    assert _got(spark, docs, items) == {(i, i) for i, _ in items}


def test_windows_cover_every_word_and_stay_inside():
    lengths = np.array([0, 1, 15, 16, 17, 33, 64, 65, 200])
    doc, a, b = D.windows_of(lengths)
    first = np.cumsum(lengths) - lengths
    for d, n in enumerate(lengths):
        mine = doc == d
        covered = {x for s, e in zip(a[mine], b[mine]) for x in range(s, e)}
        assert covered == set(range(first[d], first[d] + n))


def test_awkward_inputs(spark):
    items = [(1, None), (2, ""), (3, "..."), (None, "One two three four five six seven eight nine ten"), (4, "a")]
    docs = awkward() + [(50, "so: one two three four five six seven eight nine ten")]
    got = D.contaminated(frame(spark, docs), _benchmark(spark, items)).collect()
    assert (50, None) in {(r["doc_id"], r["item_id"]) for r in got}
    assert D.contaminated(frame(spark, docs).limit(0), _benchmark(spark, items)).count() == 0
    assert D.contaminated(frame(spark, docs), _benchmark(spark, items).limit(0)).count() == 0


def test_stage_drops_contaminated_documents_only(spark, tmp_path, items, planted):
    docs, holds = planted
    _benchmark(spark, items).write.parquet(str(tmp_path / "benchmark.parquet"))
    before = frame(spark, docs)
    after = corpus_pipeline.decontaminate(spark, before, str(tmp_path))
    assert after.columns == before.columns
    assert {r["doc_id"] for r in after.collect()} == {d for d, _ in docs} - {d for d, _ in holds}


def _reworded(text, share, r):
    """The text with a share of its words replaced by words that no document has."""
    words = text.split()
    for at in r.sample(range(len(words)), int(share * len(words))):
        words[at] = f"new{r.randint(0, 10 ** 9)}"
    return " ".join(words)


def _without_search(docs, items):
    """The pairs of documents and the items planted in them (by number) that the LCS confirms."""
    expected = set()
    for d, t in docs:
        if d >= 1000:
            item = D.Item(d % 1000, dict(items)[d % 1000].encode(), None)
            words = D.word_hashes(t.encode()).tolist()
            if item.confirm(words, 0, len(words)):
                expected.add((d, d % 1000))
    return expected


def test_reworded_items_of_a_full_block_are_found(spark):
    """256 items with 20 to 40 % of their words replaced, against the LCS without the search."""
    r = random.Random(11)
    items = [(i, ". ".join((prose(9 + i % 30, 2000 + i, 3000), prose(5, 4000 + i, 300)))) for i in range(256)]
    docs = [(i, prose(r.randint(30, 200), i, 3000)) for i in range(200)]
    for k, share in enumerate((0.2, 0.3, 0.4)):
        docs += [(1000 * (k + 1) + i, f"{prose(30 + i % 50, 5000 + i)} {_reworded(t, share, r)} {prose(40, 6000 + i)}")
                 for i, t in items]
    expected, got = _without_search(docs, items), _got(spark, docs, items)
    assert len(expected) > 256
    assert {p for p in got if p[0] % 1000 == p[1] and p[0] >= 1000} == expected


def test_long_items_are_found_whole_and_reworded(spark, monkeypatch):
    """Items of 300 to 2000 words, dealt to blocks by their passages."""
    r = random.Random(12)
    items = [(i, prose(n, 7000 + i, 3000)) for i, n in enumerate((300, 400, 500, 800, 1200, 2000) * 2)]
    docs = [(i, prose(300, 20 + i, 3000)) for i in range(30)]
    for k, share in enumerate((0.0, 0.2)):
        docs += [(1000 * (k + 1) + i, f"{prose(50 + i, 5000 + i)} {_reworded(t, share, r)} {prose(40, 6000 + i)}")
                 for i, t in items]
    expected = _without_search(docs, items)
    assert {p for p in expected if p[0] < 2000} == {(1000 + i, i) for i, _ in items}
    assert _got(spark, docs, items) == expected
    ranks, space = [], D.latent_space
    monkeypatch.setattr(D, "latent_space", lambda p, rank: ranks.append(rank) or space(p, rank))
    monkeypatch.setattr(D, "BLOCK", 64)
    assert _got(spark, docs, items) == expected
    # several blocks of about 64 passages, each passage in one of them
    assert len(ranks) > 1 and sum(ranks) == sum(-(-len(t.split()) // 64) for _, t in items)


def _half(question, r):
    """The question with about a third of its words replaced: less than 80 %, more than 60 %."""
    return _reworded(question, 0.35, r)


def test_answers_of_one_or_two_words_lower_the_share(spark):
    """A short answer counts when it follows the question's words, not before them."""
    r, rows, docs = random.Random(13), [], [(10 + i, prose(80, 50 + i, 900)) for i in range(30)]
    for i, answer in enumerate(("Everest", "1912", "blue whale")):
        question = prose(40, 800 + i, 3000)
        half = _half(question, r)
        rows.append((i, question, answer))
        docs += [(100 + i, f"{prose(30, i)} {half} {answer}, {prose(30, 9 + i)}"),
                 (200 + i, f"{prose(30, i)} {answer} {half} {prose(30, 9 + i)}"),
                 (300 + i, f"{prose(30, i)} {half} {prose(30, 9 + i)}")]
    got = D.contaminated(frame(spark, docs), _benchmark(spark, rows, "item_id long, text string, reply string"),
                         answer="reply").collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(100 + i, i) for i in range(3)}


def test_items_without_an_answer_column_always_have_an_answer(spark):
    """The last words stand in where the last sentence is short or the whole item."""
    r = random.Random(14)
    rows = [(0, prose(40, 900, 3000)), (1, prose(38, 901, 3000) + ". Blue whale."), (2, prose(38, 902, 3000) + ". Er.")]
    docs = [(10 + i, prose(80, 50 + i, 900)) for i in range(30)]
    for i, text in rows:
        words = text.split()
        docs += [(100 + i, f"{prose(30, i)} {_half(' '.join(words[:-3]), r)} {' '.join(words[-3:])} {prose(30, 9 + i)}"),
                 (200 + i, f"{prose(30, i)} {_half(' '.join(words[:-3]), r)} {prose(33, 9 + i)}")]
    assert _got(spark, docs, rows) == {(100 + i, i) for i, _ in rows}
    assert D.Item(1, rows[1][1].encode(), None).answer == D.word_hashes(rows[1][1].encode()).tolist()[-3:]


def test_rows_are_dropped_by_id_and_text(spark):
    """A contaminated row without an id goes, a clean row that shares an id stays."""
    item = prose(30, 999, 900)
    dirty, clean = f"{prose(40, 1, 900)} {item}", prose(50, 2, 900)
    docs = frame(spark, [(7, dirty), (7, clean), (None, dirty), (None, clean), (None, None), (8, dirty), (8, dirty)])
    kept = D.drop_contaminated(docs, _benchmark(spark, [(1, item)], "item_id long, text string"))
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == \
        sorted([(7, clean), (None, clean), (None, None)], key=str)
