"""Operator 2, URL filters: blocked Bloom filter, then an exact hash join.

A rule is a host and the start of a path; it fits its host, all subdomains and
every path that starts with the rule's. A URL therefore fits a rule exactly
when one of its *candidate keys* (a suffix of its host at a label border,
joined with a prefix of its path) is the rule's key. The candidate keys probe a
blocked Bloom filter (256-bit blocks, one bit in each of eight words) of all
listed keys; keys that may be listed go to an exact join with the list, which
removes the false positives. The longest matching rule of a URL wins.

URLs are judged once per distinct (host, path) and the verdicts joined back, so
a URL that a third of all pages share costs one probe. Path prefixes are cut
only at the lengths that listed paths have. The filter's size is a parameter
(``max_blocks``, 32 bytes each: 8 MB as it stands) whatever the list's length;
with a longer list more keys pass it, and the join still decides exactly.

Defined results: a null URL or one without ``://`` has an empty host and path
and fits no rule. Rows are judged one by one: null ids and repeated rows stay.
Rules repeated with different verdicts: ``allow`` wins over ``block``. Rules
with a null host, path or verdict fit nothing. Rules of equal key length can
only differ in where host ends and path starts; the longer host wins. An empty
rule table leaves every URL with the default verdict. Extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import cut, lower_ascii, table

WORDS = 8  # 32-bit words in a block
BITS_PER_KEY = 16
MAX_BLOCKS = 1 << 18

# The query's rules.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def host_of(url: Column) -> Column:
    """Lower-cased host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end."""
    return lower_ascii(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """Path: from the host's end up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    u = F.coalesce(url, F.lit(""))
    at = F.instr(u, "://")
    return F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise(F.lit(""))


def canonical_rules(rules: DataFrame) -> DataFrame:
    """The listed keys, one row each: ``host, path, key, verdict``."""
    listed = rules.select(
        lower_ascii(F.col("host")).alias("host"), F.col("path").alias("path"),
        F.col("verdict").alias("verdict")).dropna()
    return (listed.groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
            .withColumn("key", F.concat("host", "path")))


def _hash(key: Column) -> Column:
    return F.xxhash64(key)


def _block(h: Column, blocks: int) -> Column:
    return F.pmod(h, F.lit(blocks)).cast("int")


# The bit of a word is looked up in the list of the powers of two.
_POWERS = [1 << i for i in range(32)]


def _bit_masks(key: Column) -> list[Column]:
    """For each word of a block, the one bit that the key sets."""
    h2 = F.xxhash64(key, F.lit("bits"))
    powers = F.array(*[F.lit(p).cast("long") for p in _POWERS])
    return [F.get(powers, F.shiftrightunsigned(h2, 5 * i).bitwiseAND(F.lit(31)).cast("int"))
            for i in range(WORDS)]


def block_count(n_keys: int, max_blocks: int = MAX_BLOCKS) -> int:
    """Blocks for a list of ``n_keys``, a power of two, at most ``max_blocks``."""
    blocks = 1
    while blocks < max_blocks and blocks * 32 * WORDS < n_keys * BITS_PER_KEY:
        blocks *= 2
    return blocks


def build_filter(keys: DataFrame, blocks: int) -> DataFrame:
    """The filter's non-empty blocks: ``block, w0..w7`` from a ``key`` column."""
    masks = _bit_masks(F.col("key"))
    rows = keys.select(_block(_hash(F.col("key")), blocks).alias("block"),
                       *[m.alias(f"w{i}") for i, m in enumerate(masks)])
    return rows.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def probe(candidates: DataFrame, blooms: DataFrame, blocks: int) -> DataFrame:
    """The candidates whose key the filter may hold.

    The filter has at most ``max_blocks`` rows of 72 bytes, so it is broadcast.
    """
    hashed = candidates.withColumn("_block", _block(_hash(F.col("key")), blocks))
    joined = hashed.join(F.broadcast(blooms), F.col("_block") == F.col("block"))
    hit = F.lit(True)
    for i, m in enumerate(_bit_masks(F.col("key"))):
        hit = hit & (F.col(f"w{i}").bitwiseAND(m) == m)
    return joined.filter(hit).select(*candidates.columns)


def candidate_keys(urls: DataFrame, path_lengths: list[int]) -> DataFrame:
    """One row for each host suffix and path prefix of a (host, path) row."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    lengths = F.array(*[F.lit(n) for n in path_lengths])
    prefixes = F.transform(F.filter(lengths, lambda n: n <= F.length("path")),
                           lambda n: F.col("path").substr(F.lit(1), n))
    return (urls.select("host", "path", F.explode(suffixes).alias("_suffix"))
            .withColumn("_prefix", F.explode(prefixes))
            .select("host", "path", F.concat("_suffix", "_prefix").alias("key"),
                    F.col("_suffix").alias("rule_host"), F.col("_prefix").alias("rule_path")))


def match_rules(urls: DataFrame, rules: DataFrame, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """``host, path, rule, verdict`` for each distinct (host, path) that a rule fits."""
    listed = canonical_rules(rules)
    # Path lengths are at most as many as the longest listed path has characters.
    stats = listed.agg(F.count(F.lit(1)), F.sort_array(F.collect_set(F.length("path")))).first()
    blocks = block_count(stats[0], max_blocks)
    keys = listed.select("key", F.col("host").alias("rule_host"), F.col("path").alias("rule_path"),
                         "verdict")
    distinct = urls.select("host", "path").distinct()
    possible = probe(candidate_keys(distinct, stats[1]), build_filter(listed, blocks), blocks)
    exact = possible.join(keys, ["key", "rule_host", "rule_path"])
    best = F.max(F.struct(F.length("key").alias("n"), F.length("rule_host").alias("h"),
                          F.col("key").alias("rule"), F.col("verdict").alias("verdict")))
    return (exact.groupBy("host", "path").agg(best.alias("b"))
            .select("host", "path", F.col("b.rule").alias("rule"), F.col("b.verdict").alias("verdict")))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow",
               key: str = "page_id", url: str = "url", max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """``key, host, path, rule, verdict`` for every row of ``pages``."""
    urls = pages.select(F.col(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    # a table of its own and a merge join, so that Spark can split a URL that many
    # pages share; the verdicts grow with the distinct URLs and are not broadcast
    judged = cut(match_rules(urls, rules, max_blocks), "verdicts").hint("merge")
    return (urls.join(judged, ["host", "path"], "left")
            .select(key, "host", "path", "rule",
                    F.coalesce("verdict", F.lit(default)).alias("verdict")))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by the fixed rules."""
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


OP2_SQL = r"""
WITH r(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
       ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
u AS (SELECT row_number() OVER () AS id, page_id,
             CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
      FROM pages),
hp AS (SELECT id, page_id,
              translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
              regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
m AS (SELECT hp.*, h || p AS rule, v,
             row_number() OVER (PARTITION BY id ORDER BY length(h || p) DESC NULLS LAST, length(h) DESC) AS k
      FROM hp LEFT JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM m WHERE k = 1
"""
