"""Small inputs with the awkward cases: nulls, empty and long texts, repeats, clashing columns."""

from __future__ import annotations

import random
import re

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string, kept string, row string"


def split(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def documents(spark, texts: dict):
    """Documents by id, with extra columns whose names operators use inside."""
    return frame(spark, list(texts.items()))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0, "w", "k", "r") for i, t in rows], SCHEMA)


def prose(n: int, seed: int, words: int = 400) -> str:
    r = random.Random(seed)
    syllables = ["th", "on", "re", "st", "an", "er", "é", "ou", "ti", "ble", "in", "ha"]
    vocabulary = ["".join(r.choices(syllables, k=r.randint(1, 4))) for _ in range(words)]
    return " ".join(r.choice(vocabulary) for _ in range(n))


def awkward() -> list[tuple]:
    long = prose(6000, 5)
    return [(1, None), (2, ""), (3, " \n\t "), (4, "One"), (5, "one two"), (6, long), (7, long + " tail"),
            (8, "Ünï ſ ΣΑΣ don't <|endoftext|> 12 345 日本語。 x\x85y a\u00a0b"), (8, "same id, other text"),
            (None, "no id"), (9, prose(60, 1)), (9, prose(60, 1)), (-3, prose(60, 1).upper()), (10, prose(300, 2))]
