"""Small tables with every odd case, and plain versions of what the operators compute."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and to in is was that for it with as his on be at by had not are but from or have an they".split()


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + str(draw.randrange(40)) for _ in range(words))


def changed(text: str, seed: int, words: int) -> str:
    """The text with some of its words replaced."""
    draw, out = random.Random(seed), text.split(" ")
    for at in draw.sample(range(len(out)), words):
        out[at] = f"new{seed}x{at}"
    return " ".join(out)


def odd_documents(spark: SparkSession) -> DataFrame:
    """Nulls in any column, empty and very long texts, ties, repeated rows, and columns
    whose names the operators use themselves."""
    base = prose(1, 300)
    rows = [
        (0, base, "en", "a", 1),
        (1, base, "en", "a", 1),  # an exact copy
        (2, changed(base, 2, 3), "en", "b", 1),
        (2, changed(base, 2, 3), "en", "b", 1),  # a repeated row
        (3, None, "en", "a", None),
        (4, "", None, None, 0),
        (5, " \t\n\x0b\x0c\r ", "en", "b", 7),
        (6, prose(6, 30_000), "en", "a", 1),
        (7, "one", "de", "c", 3),
        (8, "ONE", "de", "c", 3),
        (9, "one two", "de", None, 7),
        (None, base, "en", "a", 1),
        (None, None, None, None, None),
        (10, "naïve größe   日本 <|endoftext|> don't  stop\n\n", "xx", "ü", 1),
        (11, "x" * 50_000, "en", "b", 1),
        (12, "spam spam " * 400, "en", "b", 1),
        (13, "a line of text here\n" * 40, "en", "b", 1),
    ] + [(20 + k, prose(100 + k, 20 + 7 * k), "en", "abc"[k % 3], 1) for k in range(40)]
    return spark.createDataFrame(rows, DOCUMENTS)


def clashing(docs: DataFrame) -> DataFrame:
    """The documents with further columns of likely names."""
    names = ["size", "copies", "mix", "n_words", "failures", "ledger", "evidence", "length", "part", "node", "token", "kept"]
    return docs.selectExpr("*", *(f"'x{k}' AS {name}" for k, name in enumerate(names)))


def empty(docs: DataFrame) -> DataFrame:
    return docs.limit(0)


def rows(frame: DataFrame, *columns: str) -> list[tuple]:
    """The rows in an order that nulls do not disturb."""
    found = [tuple(r) for r in (frame.select(*columns) if columns else frame).collect()]
    return sorted(found, key=lambda r: [(x is not None, x) for x in r])
