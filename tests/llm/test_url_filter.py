from strata.llm import url_filter as U

URLS = ["http://example.com/en/1", "https://WWW.Example.com/en/x?q", "http://a.b.example.com/en", "ftp://x.net/es/#f",
        "http://net/fr/", "http://xnet/fr/", "com/", None, "", "://", "http://ü.com/?a://b.net/es/", "http://com",
        "http://example.com:80/en/", "http://q.com/en/", "http://.net/fr/1", "x://y.net/es"]


def _brute(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    end = min([rest.find(c, cut) for c in "?#" if rest.find(c, cut) >= 0], default=len(rest))
    path = rest[cut:end]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def _pages(spark, urls):
    return spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)],
                                 "page_id long, url string, rule string, host string")


def _rules(spark, rules):
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def test_verdicts_match_brute_force(spark):
    urls = URLS * 3
    got = U.judge_urls(_pages(spark, urls), _rules(spark, U.RULES)).orderBy("page_id").collect()
    assert [tuple(r)[1:] for r in got] == [_brute(u, U.RULES) for u in urls]


def test_filter_has_no_false_negatives_and_passes_little_else(spark):
    keys = spark.range(2000).selectExpr("concat('host', id, '.org/') AS key")
    blocks = U.block_count(2000)
    blooms = U.build_filter(keys, blocks)
    assert U.probe(keys, blooms, blocks).count() == 2000
    others = spark.range(20000).selectExpr("concat('other', id, '.org/') AS key")
    assert U.probe(others, blooms, blocks).count() < 200


def test_a_filter_too_small_for_its_list_still_decides_exactly(spark):
    rules = [(f"h{i}.com", "/p/", "block") for i in range(300)] + [(None, "/", "block"), ("x.com", None, "block")]
    urls = [f"http://h{i}.com/p/1" for i in range(290, 310)]
    got = U.judge_urls(_pages(spark, urls), _rules(spark, rules), max_blocks=1).orderBy("page_id").collect()
    assert [r["verdict"] for r in got] == ["block"] * 10 + ["allow"] * 10


def test_ties_and_empty_tables(spark):
    rules = _rules(spark, [("a.com", "/", "block"), ("a.com", "/", "allow")])
    assert U.judge_urls(_pages(spark, ["http://a.com/"]), rules).first()["verdict"] == "allow"
    assert U.judge_urls(_pages(spark, URLS), rules.limit(0)).filter("rule IS NOT NULL").count() == 0
    assert U.judge_urls(_pages(spark, URLS).limit(0), rules).count() == 0
