"""Operators 8 and 3: ids against the library, files, pieces."""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import curve_packing as P
from strata.llm import elias_fano as E
from strata.llm.tokens import WordEncoder, default_vocabulary, encoder
from tests.llm.util import awkward, frame


def _ids(text, end):
    tokenizer = encoder(default_vocabulary()).tokenizer
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [end]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_words_encode_as_the_whole_text_does(text):
    enc = encoder(default_vocabulary())
    body = text.encode("utf-8", "replace")
    got = np.frombuffer(enc.encode_text(body), enc.dtype).tolist()
    assert got == enc.tokenizer.encode(body.decode(), add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40), st.text("aB.,é <|\t", max_size=20)), max_size=6))
def test_texts_encode_together_as_one_by_one(texts):
    enc = encoder(default_vocabulary())
    bodies = [None if t is None else t.encode("utf-8", "replace") for t in texts]
    got = enc.encode_texts(pa.array(bodies, pa.binary()), 2)
    assert got.to_pylist() == [enc.encode_text(b, 2) for b in bodies]


def test_forms_of_a_word_share_its_ids(monkeypatch):
    enc, seen = WordEncoder(default_vocabulary()), []
    letters = WordEncoder._letters
    monkeypatch.setattr(WordEncoder, "_letters", lambda self, core: seen.append(core) or letters(self, core))
    bodies = [b"Word word, WORD. \xff\xfe.", b"", None, b"word; " * 50 + b"w" * 400, b"<|endoftext|> it's. ,"]
    got = enc.encode_texts(pa.array([b"not this one", *bodies])[1:], 2).to_pylist()
    assert sorted(seen) == sorted([b"word", b"\xff\xfe", b"w" * 400, b"<|endoftext|>", b"it's", b""])
    assert got == [WordEncoder(default_vocabulary()).encode_text(b, 2) for b in bodies]


def test_batches_are_encoded_in_parts_of_a_bounded_size(monkeypatch):
    enc = encoder(default_vocabulary())
    monkeypatch.setattr(P, "TEXT_BYTES", 300)
    texts = [t and t.encode() for _, t in awkward()]
    batch = pa.RecordBatch.from_pydict({"row": list(range(len(texts))), "doc_id": list(range(len(texts))),
                                        "text": pa.array(texts, pa.binary())})
    got = pa.Table.from_batches(P._encoded([batch], enc, 2))
    assert got["ids"].to_pylist() == [enc.encode_text(t, 2) for t in texts]
    assert got["row"].to_pylist() == batch["row"].to_pylist() and got["ids"].num_chunks > 3


def test_a_shard_takes_its_texts_together(tmp_path, monkeypatch):
    """op8 looks words up once for many texts, never text by text, and slices a bounded part of a batch."""
    rows = sorted(awkward(), key=lambda r: (r[0] is not None, r[0] or 0))
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([i for i, _ in rows], pa.int64()),
                                        "text": pa.array([t and t.encode() for _, t in rows], pa.binary())})
    enc, sizes = WordEncoder(default_vocabulary()), []
    together = WordEncoder.encode_texts
    monkeypatch.setattr(E, "TEXT_BYTES", 300)
    monkeypatch.setattr(WordEncoder, "encode_text", None)
    monkeypatch.setattr(WordEncoder, "encode_texts", lambda self, t, end: sizes.append(len(t)) or together(self, t, end))
    assert E._written([], enc, f"file://{tmp_path}/none", 1) is None
    writer = E._written([batch.slice(0, 5), batch.slice(5)], enc, f"file://{tmp_path}/shard", 1)
    assert len(sizes) > 3 and sum(sizes) == len(rows)
    expected = [_ids(t, 1) for _, t in rows]
    assert writer.close() == sum(map(len, expected))
    shard = E.ShardReader(f"file://{tmp_path}/shard")
    ends = shard.bounds.slice(0, len(rows) + 1).tolist()
    assert shard.doc_ids(0, len(rows)) == [i for i, _ in rows]
    assert [np.concatenate(list(shard.ids(a, b))).tolist() for a, b in zip(ends, ends[1:])] == expected


@pytest.mark.parametrize("values", [[0], [0, 0, 0], [5, 5, 9, 1000], list(range(0, 3000, 7)), [0, 1 << 40], []])
def test_elias_fano_round_trip(values):
    coded = E.EliasFano.encode(np.array(values, np.uint64))
    back = E.EliasFano.decode(coded.meta(), b"".join(coded.parts()))
    assert back.slice(0, len(values)).tolist() == values
    assert [back.select(i) for i in range(len(values))] == values


def test_boundaries_take_little_space():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 1000, 100_000)).astype(np.uint64)
    assert sum(map(len, E.EliasFano.encode(ends).parts())) < 100_000 * 12 / 8


def _from_files(spark, tmp_path, docs):
    manifest = E.write_token_shards(docs, f"file://{tmp_path}/shards")
    return manifest, [tuple(r) for r in E.read_token_shards(manifest).orderBy("start").collect()]


def test_token_files_hold_every_document_in_order(spark, tmp_path):
    rows = awkward()
    manifest, got = _from_files(spark, tmp_path, frame(spark, rows).repartition(3))
    assert [r[0] for r in got] == sorted([i for i, _ in rows], key=lambda i: (i is not None, i))
    at = 0
    for _, start, n, _ in got:
        assert start == at
        at += n
    exact = lambda i, t: (i, len(_ids(t, 1)), zlib.crc32(np.array(_ids(t, 1), "<u4").tobytes()))
    assert sorted(((i, n, c) for i, _, n, c in got), key=str) == sorted((exact(i, t) for i, t in rows), key=str)
    assert manifest.agg({"n_docs": "sum"}).first()[0] == len(rows)


def test_random_access_to_a_shard(spark, tmp_path):
    manifest, got = _from_files(spark, tmp_path, frame(spark, awkward()).coalesce(1))
    shard = E.ShardReader(manifest.orderBy("shard").first()["path"])
    assert shard.bounds.select(shard.n_docs) == shard.footer["tokens"]
    a, b = shard.bounds.select(0), shard.bounds.select(1)
    assert sum(len(x) for x in shard.ids(a, b)) == got[0][2]


def test_no_documents(spark, tmp_path):
    assert _from_files(spark, tmp_path, frame(spark, awkward()).limit(0))[1] == []
    assert P.pack_documents(frame(spark, awkward()).limit(0)).count() == 0


def test_one_id_for_all_rows(spark, tmp_path):
    _, got = _from_files(spark, tmp_path, frame(spark, [(7, f"text {i}") for i in range(200)]))
    assert len(got) == 200 and {r[0] for r in got} == {7}


@pytest.mark.parametrize("length", [8, 64, 4096])
def test_packing_holds_each_id_once(spark, length):
    rows = [(i, t) for i, (_, t) in enumerate(awkward())]
    pieces = P.pack_documents(frame(spark, rows), length).collect()
    texts, ids, sequences = dict(rows), defaultdict(list), defaultdict(list)
    for r in pieces:
        ids[r["doc_id"]].append((r["start"], np.frombuffer(r["ids"], "<u4").tolist()))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, t in texts.items():
        assert [x for _, part in sorted(ids[i]) for x in part] == _ids(t, 2)
    for spans in sequences.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at == length or (at < length and at & (at - 1) == 0)
    assert sorted(sequences) == list(range(len(sequences)))


def test_hilbert_curve_visits_neighbours():
    side = 8
    cells = np.array([[x, y, z] for x in range(side) for y in range(side) for z in range(side)])
    keys = P.hilbert_keys(cells, bits=3)
    assert sorted(keys.tolist()) == list(range(side ** 3))
    line = cells[np.argsort(keys)]
    assert (np.abs(np.diff(line, axis=0)).sum(axis=1) == 1).all()


def test_equal_texts_lie_together(spark):
    rows = [(i, ("red green blue " if i % 2 else "uno dos tres quatro ") * 30) for i in range(40)]
    order = P.pack_documents(frame(spark, rows)).filter("start = 0").orderBy("sequence_id", "offset").collect()
    kinds = [r["doc_id"] % 2 for r in order]
    assert sum(a != b for a, b in zip(kinds, kinds[1:])) == 1
