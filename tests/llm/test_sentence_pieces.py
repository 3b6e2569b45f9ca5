import hashlib

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import sentence_pieces as S
from tests.llm.util import awkward, frame, prose

SP = sentencepiece.SentencePieceProcessor(model_file=S.default_model())


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def want(rows):
    out = []
    for i, t in rows:
        ids = SP.encode(t or "")
        out.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                    hashlib.sha256(SP.decode(ids).encode()).hexdigest()))
    return sorted(out, key=str)


def odd():
    return [*awkward(), (20, " "), (21, "a "), (22, "  a  b   "), (23, "▁a▁ ▁▁b"), (24, "\x00 ퟿"),
            (25, "<s> </s> <unk> <0x41>"), (26, "a\nb\r\n c\t d"), (27, "x" * 5000), (28, " " * 300), (29, " 　x"),
            (30, "\U0001f600\U0001f600 é Ａ")]


def test_equals_the_library(spark, monkeypatch):
    rows = odd() + [(100 + i, prose(50 + i, i)) for i in range(20)]
    for size in (1, 200, S.BLOCK_CHUNKS):
        monkeypatch.setattr(S, "BLOCK_CHUNKS", size)
        expected = sorted(((i, SP.encode(t or ""), SP.decode(SP.encode(t or ""))) for i, t in rows), key=str)
        assert rows_of(S.encode_documents(frame(spark, rows), decode=True)) == expected
        assert rows_of(S.decode_documents(S.encode_documents(frame(spark, rows)))) == expected


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab ▁\n.,é中th")), max_size=40) | st.text(max_size=40))
def test_chunks_give_the_ids_of_the_text(text):
    text = text.encode("utf-8", "replace").decode()
    ids = [i for c in S.segment(SP, S.chunks_of(text), True) for i in c] if text else []
    assert ids == SP.encode(text)
    assert "".join(" " + c for c in S.chunks_of(text)) == (" " + text.replace("▁", " ") if text else "")


def test_whole_texts_where_pieces_may_cross(spark, monkeypatch):
    monkeypatch.setattr(S, "pieces_stay_apart", lambda sp: False)
    got = S.encode_documents(frame(spark, odd()))
    assert rows_of(got) == sorted(((i, SP.encode(t or "")) for i, t in odd()), key=str)


def test_what_lets_pieces_cross_is_seen():
    assert S.pieces_stay_apart(SP)

    class Crossing:
        def __init__(self, **change):
            self.change = change

        def __getattr__(self, name):
            return self.change.get(name, getattr(SP, name))

    assert not S.pieces_stay_apart(Crossing(id_to_piece=lambda i: "of▁the" if i == 900 else SP.id_to_piece(i)))
    assert not S.pieces_stay_apart(Crossing(normalize=lambda t: SP.normalize(t.strip())))
    assert not S.pieces_stay_apart(Crossing(is_unknown=lambda i: True))


def test_each_distinct_chunk_of_a_block_is_segmented_once():
    seen = []

    class Counting:
        def encode(self, chunks, num_threads):
            seen.extend(chunks)
            return SP.encode(chunks)

        def piece_to_id(self, piece):
            return SP.piece_to_id(piece)

    texts = [prose(40, i % 3) for i in range(30)] + ["", " "]
    block = S.ChunkTable()
    for t in texts:
        block.add(S.chunks_of(t))
    edge, flat = block.join(Counting(), True)
    assert [flat[a:b].tolist() for a, b in zip(edge, edge[1:])] == [SP.encode(t) for t in texts]
    assert sorted(seen) == sorted({c for t in texts for c in S.chunks_of(t)})
    assert [len(x) for x in S.ChunkTable().join(SP, True)] == [1, 0]


def test_empty_table(spark):
    assert S.encode_documents(frame(spark, awkward()).limit(0)).count() == 0


def test_query_over_whole_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert rows_of(S.op13_sentence_pieces(spark, sf)) == want(docs)
