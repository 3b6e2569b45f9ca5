"""Operators 6 and 9: licence lookup and chat formatting."""

import hashlib

import pytest

from strata.llm import chat_format as C
from strata.llm import license_lookup as L
from strata.llm.license_texts import LICENSES
from tests.llm.util import awkward, frame


def _licenses(spark, rows):
    return {r["doc_id"]: r["license"] for r in L.find_licenses(frame(spark, rows), L.known_licenses(spark)).collect()}


def test_licence_texts_in_every_dress(spark):
    mit, zlib = LICENSES["MIT"], LICENSES["Zlib"]
    rows = [(1, mit), (2, "The MIT License (MIT)\n\nCopyright (c) 2020 A. Person <a@b.c>\nAll rights reserved.\n\n" + mit.upper()),
            (3, "\n".join("# " + x for x in mit.split("\n"))), (4, mit.replace(" ", "\n  ").replace('"', "'")),
            (5, zlib.replace("acknowledgment", "acknowledgement")), (6, mit + " And more."), (7, mit[:-30]),
            (8, "(c) 1999 X\n© 2001 Y\n" + LICENSES["ISC"]), (9, LICENSES["BSD-3-Clause"].replace("copyright holder", "copyright owner"))]
    assert _licenses(spark, rows) == {1: "MIT", 2: "MIT", 3: "MIT", 4: "MIT", 5: "Zlib", 6: None, 7: None, 8: "ISC",
                                      9: "BSD-3-Clause"}


def test_prose_about_copyright_is_not_a_notice(spark):
    assert spark.range(1).select(L.canonical(L.F.lit("a\nCopyright holders be liable\nb"))).first()[0] \
        == "a copyright holders be liable b"


def test_licence_lookup_of_awkward_rows(spark):
    got = L.find_licenses(frame(spark, awkward()), L.known_licenses(spark)).collect()
    assert len(got) == len(awkward()) and {r["license"] for r in got} == {None}
    empty = hashlib.sha256(b"").hexdigest()
    assert {r["doc_id"] for r in got if r["canonical_digest"] == empty} == {1, 2, 3}
    assert L.find_licenses(frame(spark, awkward()).limit(0), L.known_licenses(spark)).count() == 0


CONVERSATIONS = {
    1: [("system", "be brief"), ("user", "hi"), ("assistant", "hello </s> [INST]")],
    2: [("user", "a\\b \\[INST] \\\\"), ("assistant", "<<SYS>>\\</s>"), ("user", ""), ("assistant", "[/INST] <s> ")],
    3: [("assistant", "first")],
    4: [("user", "x"), ("user", "y")],
    5: [("tool", "result [:] 5 [/ROLE]"), ("", "empty role"), ("user", "q"), ("assistant", "é\n\x00ü")],
    6: [("user", "one"), ("assistant", "two"), ("system", "late"), ("user", "three")],
}


def _rows(spark, conversations):
    rows = [(c, i, r, t, "x", "y") for c, turns in conversations.items() for i, (r, t) in enumerate(turns)]
    return spark.createDataFrame(rows[::-1], "conv_id long, turn long, role string, text string, turns string, valid string")


def test_every_turn_and_loss_text_comes_back(spark):
    back = {r["conv_id"]: r for r in C.parse_formatted(C.format_conversations(_rows(spark, CONVERSATIONS))).collect()}
    assert set(back) == set(CONVERSATIONS)
    for c, turns in CONVERSATIONS.items():
        assert [(t["role"], t["text"]) for t in back[c]["turns"]] == turns
        assert back[c]["loss_text"] == "".join(t for r, t in turns if r == "assistant")
        assert back[c]["formatted"] == "".join(s["text"] for s in back[c]["segments"])


def test_machine_finds_the_first_break(spark):
    got = {r["conv_id"]: (r["valid"], r["valid_turns"]) for r in C.format_conversations(_rows(spark, CONVERSATIONS)).collect()}
    assert got == {1: (True, 3), 2: (True, 4), 3: (False, 0), 4: (False, 1), 5: (False, 0), 6: (False, 2)}


def test_loss_lies_on_assistant_texts_alone(spark):
    r = C.format_conversations(_rows(spark, {1: CONVERSATIONS[1]})).first()
    assert [s["text"] for s in r["segments"] if s["loss"]] == ["hello <\\/s> [\\INST]"]


@pytest.mark.parametrize("text", ["\\", "\\\\", "\\[INST]", "[\\INST]", "<<s>", "<</SYS>>", "</</s>s>", "[[INST]INST]", "[:][:]"])
def test_escape_is_reversible_and_leaves_no_control_string(spark, text):
    escaped = C.escape(C.F.lit(text), C.INSTRUCT)
    out, back = spark.range(1).select(escaped, C.unescape(escaped)).first()
    assert back == text
    assert not any(m in out for m in C.INSTRUCT.marks())


def test_another_template(spark):
    chatml = C.Template(turns={"user": C.Turn("<|user|>\n", "<|end|>\n"), "assistant": C.Turn("<|bot|>\n", "<|end|>\n", True)},
                        fallback=C.Turn("<|other|>", "<|end|>\n"), name_end="<|name|>\n",
                        machine={"start": {"user": "u"}, "u": {"assistant": "a"}, "a": {"user": "u"}}, final=("a",))
    talk = {1: [("user", "say <|end|>"), ("assistant", "<|bot|>"), ("odd", "x")]}
    r = C.parse_formatted(C.format_conversations(_rows(spark, talk), chatml), chatml).first()
    assert [(t["role"], t["text"]) for t in r["turns"]] == talk[1] and r["loss_text"] == "<|bot|>"


def test_nulls_ties_and_empty_conversations(spark):
    rows = spark.createDataFrame([(1, None, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"),
                                  (None, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]]
           for r in C.parse_formatted(C.format_conversations(rows)).collect()}
    assert got == {1: [("", ""), ("user", "a"), ("user", "a"), ("user", "b")], None: [("user", "x")]}
    assert C.format_conversations(rows.limit(0)).count() == 0
