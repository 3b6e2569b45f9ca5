import base64
import hashlib

from strata.llm import warc


def _expected(rows, least=0):
    first = {}
    for i, h in rows:
        k = (h or "").encode()
        if i is not None:
            first[k] = min(first.get(k, i), i)
    out = []
    for i, h in rows:
        k = (h or "").encode()
        revisit = len(k) >= least and k in first and first[k] != i and sum((x or "").encode() == k for _, x in rows) > 1
        out.append((i, len(k), base64.b32encode(hashlib.sha1(k).digest()).decode(),
                    "revisit" if revisit else "response", first[k] if revisit else None))
    return sorted(out, key=str)


def _pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x") for i, u, h in rows],
                                 "page_id long, url string, html string, digest string")


ROWS = [(5, "http://a/", "<p>x</p>"), (3, "http://b/\r\nX: y", "<p>x</p>"), (3, None, "<p>x</p>"), (4, "u", None),
        (6, "u", ""), (7, "é", "é" * 70_000), (None, "n", "<p>x</p>"), (None, "n", "only"), (9, "u", "\r\n\r\nWARC/1.1\r\n")]


def _round_trip(spark, tmp_path, rows, least=0, chunk=1000):
    plan = warc.plan_records(_pages(spark, rows), least)
    manifest = warc.write_warc(warc.chunk_table(plan, chunk), f"file://{tmp_path}/w")
    return warc.read_warc(manifest, chunk)


def test_every_page_comes_back(spark, tmp_path):
    got = _round_trip(spark, tmp_path, ROWS).filter("is_last").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=str) == _expected([(i, h) for i, _, h in ROWS])


def test_small_payloads_are_all_responses(spark, tmp_path):
    got = _round_trip(spark, tmp_path, ROWS, least=9).filter("is_last").collect()
    assert {r["record_type"] for r in got} == {"response"}


def test_chunks_are_bounded_and_carry_running_digests(spark, tmp_path):
    rows = _round_trip(spark, tmp_path, [(7, "u", "é" * 5_000)]).orderBy("chunk_no").collect()
    payload, sha = b"", hashlib.sha1()
    assert [r["chunk_no"] for r in rows] == list(range(10))
    for r in rows:
        assert len(r["data"]) <= 1000
        payload += r["data"]
        sha.update(r["data"])
        assert r["running_digest"] == base64.b32encode(sha.digest()).decode()
    assert payload.decode() == "é" * 5_000


def test_no_pages(spark, tmp_path):
    empty = _pages(spark, ROWS).limit(0)
    manifest = warc.write_warc(warc.chunk_table(warc.plan_records(empty)), f"file://{tmp_path}/w")
    assert warc.read_warc(manifest).count() == 0


def test_retried_tasks_files_do_not_count(spark, tmp_path):
    plan = warc.chunk_table(warc.plan_records(_pages(spark, ROWS)))
    manifest = warc.write_warc(plan, f"file://{tmp_path}/w")
    warc.write_warc(plan, f"file://{tmp_path}/w")  # as a lost attempt would leave files
    assert warc.read_warc(manifest).filter("is_last").count() == len(ROWS)
