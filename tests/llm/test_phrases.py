"""Phrase mining against counting in Python."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docsift.llm import phrases
from tests.llm.helpers import EDGES, ascii_lower, table


def brute(rows, least, first=2000):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", ascii_lower(text or "")):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    often = {key: f for key, f in counts.items() if f >= least}
    scored = []
    for (lang, words), a in often.items():
        if len(words) == 1:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = often[lang, words[:k]], often[lang, words[k:]]
            cuts.append((2_000_000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        covered = any(
            other == lang and len(longer) > len(words) and 100 * f >= 80 * a and any(longer[i : i + len(words)] == words for i in range(len(longer)))
            for (other, longer), f in often.items()
        )
        if not covered:
            scored.append((lang, " ".join(words), a, left, right, totals[lang], score))
    out = []
    for lang in totals:
        mine = sorted((s for s in scored if s[0] == lang), key=lambda s: (-s[6], -s[2], s[1].encode()))
        out += [(s[0], i + 1, *s[1:]) for i, s in enumerate(mine[:first])]
    return sorted(out)


def found(docs, **options):
    return sorted(tuple(r) for r in phrases.collocations(docs, **options).collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, text, lang, "p", 3) for i, (lang, text) in enumerate(rows)], "doc_id long, text string, lang string, phrase string, rank int")


def texts(n, seed):
    rng = random.Random(seed)
    fixed = ["red stone bridge over", "old mill", "New York City Hall", "a b a b a b", "Ünï çödé"]
    out = []
    for _ in range(n):
        words = []
        for _ in range(rng.randrange(3, 60)):
            words.append(rng.choice(fixed) if rng.random() < 0.3 else rng.choice("the of in to we is it".split()))
            words.append(rng.choice([" ", "  ", "\t", ". ", ",", "\n", "\r\n", ";;", "\x0b"]))
        out.append((rng.choice(["en", "en", "fr", None, "und", ""]), "".join(words)))
    return out


def test_against_counting(spark):
    rows = [*texts(120, 1), *((lang, text) for lang, (_, text, *_) in zip(["en", None] * 20, EDGES)), *[("en", "same words again and again")] * 40]
    want = brute(rows, 30)
    assert len(want) > 30 and found(frame(spark, rows).repartition(3)) == want


def test_first_of_each_language(spark):
    rows = texts(80, 2)
    assert found(frame(spark, rows), least=3, first=7) == brute(rows, 3, 7)


def test_collisions_are_told_apart(spark):
    rows = texts(60, 3)
    assert found(frame(spark, rows), least=4, symbols=lambda: phrases._Symbols(mask=0b1100)) == brute(rows, 4)


@pytest.mark.parametrize("size", [1, 7, 40, 300])
def test_parts_of_long_texts(spark, size, monkeypatch):
    """Texts in parts, with pieces that are longer than a part, count like whole ones."""
    monkeypatch.setattr(phrases, "PART_BYTES", size)
    monkeypatch.setattr(phrases, "CHUNK_BYTES", 500)
    monkeypatch.setattr(phrases, "BLOCK", 100)
    rows = texts(12, 4) + [("en", "the old mill of the old mill " * 30), ("en", "x" * 900), ("en", "  lead and trail  "), ("fr", ". , the of. ")]
    assert found(frame(spark, rows), least=2) == brute(rows, 2)


def test_edges(spark):
    assert found(table(spark, [])) == []
    assert found(table(spark, EDGES), least=10_000) == []
    everything = table(spark, EDGES).withColumn("lang", F.lit(None).cast("string"))
    assert found(everything, least=500) == brute([(None, r[1]) for r in EDGES], 500)
