"""Operator 10, quality rules: a short-circuit cascade in measured order.

Every rule says which texts it rejects. Its cost (seconds a row) and its
selectivity (share of rows rejected) are measured on one bounded sample, and
the rules run in the order of rejection per cost, so that cheap and strict
rules spare the expensive ones the rows they would reject anyway. The verdict
is the conjunction of all rules, so the measured order changes the work and
the reported first failing rule, never which rows are kept.

Only DataFrame functions are used: a row's words are an array, and the windows
of a text are counted inside the row, so no row leaves its partition.

Defined results: a null text counts as empty (no words: rejected by the length
rule, as are empty texts). Null ids, ties and repeated rows are judged row by
row and all stay in the output. An empty table gives an empty result and keeps
the declared rule order. Extra columns are carried by ``cascade`` and ignored
by the query; clashing names get fresh internal names.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import SPACE_CLASS, cut, fresh, let, table

# Fixed values of the base rules.
MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PERCENT = 30
SYMBOLS = "[#*$%&|<>]"
# Thresholds of the method's own rules, chosen so that plain prose in any of
# the languages stays far from them.
MAX_SYMBOLS_PER_100_WORDS = 10
MAX_DUP_LINE_PERCENT = 50
MIN_MEAN_WORD, MAX_MEAN_WORD = 2, 15
MAX_UPPER_PERCENT = 60
MAX_DIGIT_PERCENT = 40
SAMPLE_ROWS = 2000


@dataclass(frozen=True)
class Rule:
    """``rejects`` maps the measures of a row to a boolean column."""

    name: str
    rejects: Callable[[dict[str, Column]], Column]


def words_of(text: Column) -> Column:
    """The words of a text, in order, as an array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS), lambda w: w != F.lit(""))


def _repeat_words(words: Column) -> Column:
    """Words that lie in a ``WINDOW``-word window found twice or more in the text.

    Windows are compared by hash first (word hashes, paired three times: spans
    of 2, 4 and 8 words); only texts where two hashes agree are compared by the
    words themselves, so a hash collision cannot count.
    """
    n = F.size(words)

    def starts() -> Column:
        return F.sequence(F.lit(1), n - F.lit(WINDOW - 1))

    def paired(spans: Column, apart: int) -> Column:
        return let(spans, lambda s: F.zip_with(
            s, F.slice(s, apart + 1, F.size(s)), lambda x, y: F.xxhash64(x, y)))

    spans, apart = F.transform(words, lambda w: F.xxhash64(w)), 1
    while apart < WINDOW:
        spans, apart = paired(spans, apart), 2 * apart
    suspect = let(F.slice(spans, 1, n - F.lit(WINDOW - 1)),
                  lambda h: F.size(F.array_distinct(h)) < F.size(h))

    windows = F.sort_array(F.transform(
        starts(), lambda i: F.struct(F.array_join(F.slice(words, i, WINDOW), " ").alias("w"), i.alias("i"))))

    def repeated(ws: Column) -> Column:
        def twin(k: Column) -> Column:
            same_before = F.coalesce(F.get(ws, k - 1)["w"] == F.get(ws, k)["w"], F.lit(False))
            same_after = F.coalesce(F.get(ws, k + 1)["w"] == F.get(ws, k)["w"], F.lit(False))
            return same_before | same_after
        ks = F.filter(F.sequence(F.lit(0), F.size(ws) - 1), twin)
        return F.sort_array(F.transform(ks, lambda k: F.get(ws, k)["i"]))

    def covered(at: Column) -> Column:
        gaps = F.transform(at, lambda s, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - s, F.lit(WINDOW))))
        return F.aggregate(gaps, F.lit(0), lambda acc, g: acc + g)

    exact = let(windows, lambda ws: let(repeated(ws), covered))
    return F.when(n < WINDOW + 1, F.lit(0)).when(suspect, exact).otherwise(F.lit(0)).cast("long")


def measures(text: Column, words: Column) -> dict[str, Column]:
    """The measures that rules may use, as expressions over a text and its words."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counts = let(lines, lambda x: F.struct(
        F.size(x).alias("all"), (F.size(x) - F.size(F.array_distinct(x))).alias("again")))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": F.regexp_count(t, F.lit(SYMBOLS)).cast("long"),
        "n_lines": counts["all"].cast("long"),
        "n_dup_lines": counts["again"].cast("long"),
        "n_repeat_words": _repeat_words(words),
        "n_upper": F.regexp_count(t, F.lit("[A-Z]")).cast("long"),
        "n_digits": F.regexp_count(t, F.lit("[0-9]")).cast("long"),
    }


# The cascade orders the base rules like any other.
BASE_RULES = (
    Rule("few_words", lambda m: m["n_words"] < MIN_WORDS),
    Rule("repeated_windows", lambda m: m["n_repeat_words"] * 100 > m["n_words"] * MAX_REPEAT_PERCENT),
)
METHOD_RULES = (
    Rule("symbols", lambda m: m["n_symbols"] * 100 > m["n_words"] * MAX_SYMBOLS_PER_100_WORDS),
    Rule("repeated_lines", lambda m: m["n_dup_lines"] * 100 > m["n_lines"] * MAX_DUP_LINE_PERCENT),
    Rule("word_length", lambda m: (m["word_chars"] < m["n_words"] * MIN_MEAN_WORD)
         | (m["word_chars"] > m["n_words"] * MAX_MEAN_WORD)),
    Rule("shouting", lambda m: m["n_upper"] * 100 > m["word_chars"] * MAX_UPPER_PERCENT),
    Rule("digits", lambda m: m["n_digits"] * 100 > m["word_chars"] * MAX_DIGIT_PERCENT),
)


@dataclass(frozen=True)
class RuleCost:
    name: str
    seconds_per_row: float
    rejected_share: float

    @property
    def rank(self) -> float:
        return self.rejected_share / max(self.seconds_per_row, 1e-9)


def sample_rows(df: DataFrame, bound: int, seed: int = 10) -> DataFrame:
    """About ``bound`` rows of ``df`` at most, uniformly, as a scratch table."""
    n = df.count()
    fraction = 1.0 if n <= bound else bound / n
    return cut(df.sample(False, fraction, seed) if fraction < 1 else df, "rule-sample")


def estimate(docs: DataFrame, rules: Sequence[Rule], text: str = "text",
             bound: int = SAMPLE_ROWS) -> list[RuleCost]:
    """Each rule's cost and selectivity on one bounded sample of the rows."""
    rows = sample_rows(docs.select(F.col(text).alias("text")), bound)
    rows = rows.withColumn("words", words_of(F.col("text")))
    m = measures(F.col("text"), F.col("words"))

    def timed(reject: Column) -> tuple[float, int, int]:
        t0 = time.perf_counter()
        n, hit = rows.agg(F.count(F.lit(1)), F.count_if(F.coalesce(reject, F.lit(False)))).first()
        return time.perf_counter() - t0, n, hit

    idle = min(timed(F.size("words") < 0)[0] for _ in range(2))
    out = []
    for r in rules:
        took, n, hit = timed(r.rejects(m))
        out.append(RuleCost(r.name, max(took - idle, 0.0) / max(n, 1), hit / max(n, 1)))
    return out


def order_rules(rules: Sequence[Rule], costs: Sequence[RuleCost]) -> list[Rule]:
    """The rules by rejection per cost, highest first; ties keep their order."""
    rank = {c.name: c.rank for c in costs}
    return sorted(rules, key=lambda r: -rank.get(r.name, 0.0))


def first_failure(rules: Sequence[Rule], m: dict[str, Column]) -> Column:
    """Name of the first rule that rejects the row, else null.

    A CASE evaluates its branches in order and stops at the first that holds:
    that is the short circuit.
    """
    out = None
    for r in rules:
        hit = F.coalesce(r.rejects(m), F.lit(False))
        out = F.when(hit, F.lit(r.name)) if out is None else out.when(hit, F.lit(r.name))
    return F.lit(None).cast("string") if out is None else out


def cascade(docs: DataFrame, rules: Sequence[Rule] = BASE_RULES + METHOD_RULES, text: str = "text",
            bound: int = SAMPLE_ROWS, out: str = "failed_rule") -> DataFrame:
    """All rows and columns of ``docs`` plus ``out``, the first failing rule or null.

    The words are bound inside the one expression: as a column of their own, a
    filter on ``out`` that Spark moves below that column would split the text
    again for every use.
    """
    ordered = order_rules(rules, estimate(docs, rules, text, bound))
    failed = let(words_of(F.col(text)), lambda w: first_failure(ordered, measures(F.col(text), w)))
    return docs.withColumn(out, failed)


def keep_good(docs: DataFrame, text: str = "text", bound: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with their columns unchanged."""
    out = fresh(docs, "_failed_rule")
    return cascade(docs, text=text, bound=bound, out=out).filter(F.col(out).isNull()).drop(out)


BASE_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its measures, the base verdict and the cascade's verdict.

    The measures that the result shows are columns; the others stay inside the
    cascade's branches and run only for rows that reach their rule.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ordered = order_rules(METHOD_RULES, estimate(docs, METHOD_RULES))
    worded = docs.withColumn("words", words_of(F.col("text")))
    lazy = measures(F.col("text"), F.col("words"))
    shown = worded.select("doc_id", "text", *[lazy[c].alias(c) for c in (*BASE_COLUMNS, "n_lines")])
    m = {c: F.col(c) if c in shown.columns else lazy[c] for c in lazy}
    base_failed = F.lit(False)
    for r in BASE_RULES:
        base_failed = base_failed | F.coalesce(r.rejects(m), F.lit(False))
    judged = shown.withColumn("base_failed", base_failed).withColumn(
        "failed_rule", F.when(~F.col("base_failed"), first_failure(ordered, m)))
    return judged.select(
        "doc_id", *BASE_COLUMNS, "base_failed",
        (~F.col("base_failed") & F.col("failed_rule").isNull()).alias("kept"))
