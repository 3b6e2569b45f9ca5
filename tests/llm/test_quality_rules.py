import re
from collections import Counter

from strata.llm import quality_rules as Q
from tests.llm.util import SF, awkward, frame, prose, split

TEXTS = ["", "a b", prose(40, 1), prose(30, 2) + "\n" + prose(30, 2), "x " * 30, "a b c d e f g h i " * 5,
         "# $ % one\n\nsame line\nsame line\n \nsame line\r\n" + prose(20, 3), prose(9, 4), prose(8, 4) + " " + prose(8, 4),
         "1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8 z 2 3 4 5 6 7 8 9", "é\x85ü \x1c q\tw\x0bz", prose(3000, 8)]


def measured(text):
    words = split(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(8)}
    lines = [x for x in (text or "").split("\n") if split(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(covered))


def base_failed(m):
    return m[0] < 20 or 100 * m[4] > 30 * m[0]


def test_measures_match_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + awkward()
    docs = frame(spark, rows).select("doc_id", "text").withColumn("ws", Q.words_of(Q.F.col("text")))
    m = Q.measures(Q.F.col("text"), Q.F.col("ws"))
    got = docs.select("doc_id", *[m[c].alias(c) for c in Q.BASE_COLUMNS]).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(((i, *measured(t)) for i, t in rows), key=str)


def test_query_returns_every_document(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = Q.op10_quality_rules(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        m = measured(texts[r["doc_id"]])
        assert tuple(r[c] for c in Q.BASE_COLUMNS) == m
        assert r["base_failed"] == base_failed(m)
        assert not (r["base_failed"] and r["kept"])


def test_prose_is_kept_and_junk_is_not(spark):
    junk = {1: " ".join(w + "$$$" for w in prose(60, 1).split()), 2: prose(60, 1).upper(), 3: "a b",
            4: (prose(5, 1) + "\n") * 30, 5: None, 6: " ".join(str(i) for i in range(1000, 1100))}
    rows = [*junk.items(), *((i, prose(60, i).capitalize()) for i in range(10, 20))]
    docs = frame(spark, rows)
    kept = Q.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(10, 20))


def test_cascade_runs_in_the_order_of_rejection_per_cost():
    rules = [Q.Rule(n, lambda m: m["n_words"] < 0) for n in "abc"]
    costs = [Q.RuleCost("a", 1e-3, 0.1), Q.RuleCost("b", 1e-6, 0.1), Q.RuleCost("c", 1e-6, 0.5)]
    assert [r.name for r in Q.order_rules(rules, costs)] == ["c", "b", "a"]


def test_order_changes_the_reason_never_the_verdict(spark):
    docs = frame(spark, [(i, t) for i, t in enumerate(TEXTS)])
    rules = list(Q.BASE_RULES + Q.METHOD_RULES)
    words = docs.withColumn("ws", Q.words_of(Q.F.col("text")))
    m = Q.measures(Q.F.col("text"), Q.F.col("ws"))
    verdicts = [[r[0] is None for r in words.select(Q.first_failure(order, m)).collect()]
                for order in (rules, rules[::-1])]
    assert verdicts[0] == verdicts[1]


def test_costs_come_from_a_bounded_sample(spark):
    docs = frame(spark, [(i, prose(30, i % 3)) for i in range(400)])
    assert Q.sample_rows(docs, 50).count() < 120
    assert {c.name for c in Q.estimate(docs, Q.METHOD_RULES, bound=50)} == {r.name for r in Q.METHOD_RULES}


def test_later_rules_see_only_what_reaches_them(spark):
    raises = Q.Rule("late", lambda m: Q.F.raise_error(Q.F.lit("reached")).cast("boolean"))
    m = {"n_words": Q.F.lit(1)}
    assert spark.range(1).select(Q.first_failure([Q.BASE_RULES[0], raises], m)).first()[0] == "few_words"


def test_empty_table(spark):
    docs = frame(spark, awkward()).limit(0)
    assert Q.cascade(docs).count() == 0
    assert Q.keep_good(docs).count() == 0
