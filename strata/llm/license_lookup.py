"""Operator 6, licence scans: canonical digests of entire texts.

A text is brought into a canonical form: lower case, copyright and rights lines
left out, every run of anything but letters and digits one space, and
equivalent spellings made one. Texts whose canonical forms are equal have equal
digests, so a licence is found by a hash join of the texts' digests with the
digests of the known licences, with and without their titles.

Only DataFrame functions are used, row by row; the known licences are a small
table whose size Spark knows, and a larger one joins by shuffle as well.

Defined results: a null text counts as empty; texts that are empty in canonical
form have the digest of the empty text and no licence. Rows are judged one by
one; null ids and repeated rows stay. An empty table gives no rows. Known
licences with equal digests: the first name in order is reported. Extra columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import table
from strata.llm.license_texts import LICENSES, TITLES

# A line that names a holder and years, not prose that mentions copyright.
_NOTICE = (r"(^|\n)[ \t#*/]*((portions )?copyright[ \t]*[:,]?[ \t]*(\(c\)|©|&copy;|[0-9]{4}|<|\[|\{)"
           r"|(\(c\)|©)[ \t]*[0-9]{4}|all rights reserved)[^\n]*")
_NOT_WORDS = r"[^\p{L}\p{N}]+"
# Equivalent spellings, applied in this order to canonical text.
EQUIVALENT = (
    ("licence", "license"), ("sub license", "sublicense"), ("organisation", "organization"),
    ("authoris", "authoriz"), ("recognis", "recogniz"), ("initialis", "initializ"),
    ("favour", "favor"), ("honour", "honor"), ("artefact", "artifact"), ("analogue", "analog"),
    ("catalogue", "catalog"), ("centre", "center"), ("per cent", "percent"),
    ("acknowledgement", "acknowledgment"), ("judgement", "judgment"), ("wilful", "willful"),
    ("whilst", "while"), ("non commercial", "noncommercial"), ("non infringement", "noninfringement"),
    ("copyright owner", "copyright holder"), ("https ", "http "),
)


def canonical(text: Column) -> Column:
    """The canonical form of a text."""
    out = F.lower(F.coalesce(text, F.lit("")))
    out = F.regexp_replace(out, _NOTICE, "$1")
    out = F.trim(F.regexp_replace(out, _NOT_WORDS, " "))
    for said, same in EQUIVALENT:
        out = F.replace(out, F.lit(said), F.lit(same))
    return out


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_licenses(spark: SparkSession, texts: dict[str, str] = LICENSES,
                   titles: dict[str, tuple[str, ...]] = TITLES) -> DataFrame:
    """``license, text`` of the known licences, with each of their titles and without."""
    rows = [(n, t) for n, body in texts.items()
            for t in (body, *(f"{title}\n\n{body}" for title in titles.get(n, ())))]
    return spark.createDataFrame(rows, "license string, text string")


def find_licenses(docs: DataFrame, known: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, canonical_digest, license`` per row; ``license`` is null when the text is none."""
    listed = (known.withColumn("canonical_digest", digest(F.col("text"))).filter(canonical(F.col("text")) != "")
              .groupBy("canonical_digest").agg(F.min("license").alias("license")))
    rows = docs.select(F.col(doc).alias("doc_id"), digest(F.col(text)).alias("canonical_digest"))
    return rows.join(listed, "canonical_digest", "left").select("doc_id", "canonical_digest", "license")


def op6_license_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's canonical digest and the licence whose text it is."""
    return find_licenses(table(spark, sf_dir, "documents"), known_licenses(spark))


def _canonical_sql(col: str) -> str:
    out = f"regexp_replace(lower(coalesce({col}, '')), '{_NOTICE}', '\\1', 'g')"
    out = f"trim(regexp_replace({out}, '{_NOT_WORDS}', ' ', 'g'))"
    for said, same in EQUIVALENT:
        out = f"replace({out}, '{said}', '{same}')"
    return out


def _known_sql() -> str:
    rows = [(n, t) for n, body in LICENSES.items() for t in (body, *(f"{x}\n\n{body}" for x in TITLES[n]))]
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    return ", ".join(f"({quoted(n)}, {quoted(t)})" for n, t in rows)


OP6_SQL = f"""
WITH known(license, body) AS (VALUES {_known_sql()}),
listed AS (SELECT sha256({_canonical_sql('body')}) AS canonical_digest, min(license) AS license FROM known GROUP BY 1),
d AS (SELECT doc_id, sha256({_canonical_sql('text')}) AS canonical_digest FROM documents)
SELECT doc_id, d.canonical_digest, license FROM d LEFT JOIN listed USING (canonical_digest)
"""
