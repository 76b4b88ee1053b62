"""Tables for the tests of the training-data operators."""

import os
import random

SF_DIR = "/root/testdata/sf0.001"
HAS_TABLES = os.path.isdir(SF_DIR)

# Documents as the operators get them, with columns whose names clash with those that operators add.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, _row long, rate string, `Key` string"

WORDS = "the river of stone and water was in a valley with green hills for many years it ran past old mills and small towns".split()


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) * rng.randrange(2) for _ in range(n))


def table(spark, rows):
    """Rows of ``doc_id, text`` or ``doc_id, text, source``."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), 0.5, 7, "x", "k") for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def bare(spark, rows):
    return spark.createDataFrame([tuple(r[:2]) for r in rows], "doc_id long, text string")


LONG = prose(30_000, 99)

EDGES = [
    (1, "Some words that stay the same here.\nAnd more."),
    (2, "SOME words that stay the same here.\nAnd more."),
    (3, None),
    (4, ""),
    (5, " \t\n "),
    (6, "é É ß 漢字 é naïve"),
    (7, LONG),
    (8, "x" * 100_000),
    (9, prose(60, 1)),
    (9, prose(60, 1)),
    (9, prose(60, 2)),
    (None, "no id at all"),
    (None, "no id at all"),
    (12, "one"),
]


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
