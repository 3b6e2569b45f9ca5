import corpus_pipeline
from strata.llm import near_dup as N
from tests.llm.util import frame, prose


def _write(spark, tmp_path, docs, items):
    frame(spark, docs).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_stages_are_the_four_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontaminate", "pack"]


def test_pipeline_keeps_what_every_stage_should_keep(spark, tmp_path):
    item = prose(30, 999, 900)
    clean = {i: prose(80 + i, i, 900) for i in range(15)}
    docs = [*clean.items(), (100, clean[3]), (101, clean[4] + " one"), (102, "too short"), (103, None),
            (104, " ".join(w + "###" for w in prose(60, 77).split())), (105, prose(60, 78, 900) + " " + item)]
    sf = _write(spark, tmp_path, docs, [(1, item)])
    pieces = corpus_pipeline.run(spark, sf).collect()
    assert {r["doc_id"] for r in pieces} == set(clean)
    total = sum(r["length"] for r in pieces)
    assert total == sum({r["doc_id"]: r["doc_tokens"] for r in pieces}.values())


def test_each_stage_returns_the_documents_columns(spark, tmp_path):
    docs = [(i, prose(60, i, 900)) for i in range(6)]
    sf = _write(spark, tmp_path, docs, [(1, prose(20, 500))])
    frame_ = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame_, sf)
        assert out.dtypes == frame_.dtypes and out.count() == 6


def test_empty_documents(spark, tmp_path):
    sf = _write(spark, tmp_path, [(1, "x")], [(1, "y z")])
    empty = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf).count() == 0


def test_kept_documents_are_not_near_copies(spark, tmp_path):
    docs = [(i, prose(100, i % 4, 900) + f" end{i % 2}") for i in range(16)]
    kept = corpus_pipeline.near_dedup(spark, frame(spark, docs), "")
    rows = N.near_duplicates(kept).collect()
    assert len(rows) == 4 and all(r["kept"] for r in rows)
