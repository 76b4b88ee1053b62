"""Links by shared n-grams against brute force over all pairs."""

import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from docsift.llm import grams, jaccard_join
from tests.llm.helpers import EDGES, bare, prose, table
from tests.llm.test_similar import brute_shingles, edited


def brute(rows, words=4, percent=85):
    sets = [brute_shingles(text, words) for _, text in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[top(i)] = min(least.get(top(i), doc_id), doc_id)
    return sorted(((doc_id, len(sets[i]), least.get(top(i))) for i, (doc_id, _) in enumerate(rows)), key=str)


def found(docs, **options):
    return sorted((tuple(r) for r in jaccard_join.jaccard_components(docs, **options).collect()), key=str)


def rows_with_links():
    rows = [(i, prose(40 + 11 * i, 200 + i)) for i in range(20)]
    rows += [(1000 + 10 * i + j, edited(rows[i][1], share, 50 * i + j)) for i in range(20) for j, share in enumerate((0.0, 0.01, 0.03, 0.06, 0.08, 0.12))]
    # Two groups of near copies that share half of their text, a chain of edits, and a passage in texts of their own.
    passage = prose(60, 7)
    for g in (1, 2):
        text = passage + " " + prose(70, 40 + g)
        rows += [(2000 * g + i, edited(text, 0.03, 9000 * g + i)) for i in range(30)]
    chain = prose(150, 17)
    for i in range(10):
        chain = edited(chain, 0.05, 800 + i)
        rows.append((7000 + i, chain))
    return rows + [(8000 + i, passage + " " + prose(5 + i, 600 + i)) for i in range(25)]


def test_against_brute_force(spark):
    rows = [*rows_with_links(), *EDGES]
    random.Random(5).shuffle(rows)
    want = brute(rows)
    assert len({component for _, _, component in want}) < len(rows) - 60
    assert found(table(spark, rows)) == want


@pytest.mark.parametrize("words, percent", [(1, 60), (3, 100), (5, 30)])
def test_other_sizes(spark, monkeypatch, words, percent):
    """Small chunks, blocks and parts of columns, so that every kind of cut is met."""
    for name, value in (("CHUNK", 250), ("BLOCK", 300), ("ROWS", 4), ("COLUMNS", 32), ("_MOST_DOCS", 7)):
        monkeypatch.setattr(jaccard_join, name, value)
    rows = [*rows_with_links()[::4], *EDGES[:6], *EDGES[8:]]
    got = found(table(spark, rows).repartition(5), words=words, similarity=Fraction(percent, 100))
    assert got == brute(rows, words, percent)


def test_exactly_at_the_bound(spark):
    """17 of 20 n-grams are linked, 16 of 19 are not."""
    words = [f"w{i}" for i in range(23)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:20])), (3, " ".join(f"v{i}" for i in range(22))), (4, " ".join(f"v{i}" for i in range(19)))]
    assert found(bare(spark, rows)) == [(1, 20, 1), (2, 17, 1), (3, 19, 3), (4, 16, 4)]


def test_one_set_of_many_rows_and_empty_tables(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("the same five words here").alias("text"))
    assert {r.component_id for r in jaccard_join.jaccard_components(rows).collect()} == {0}
    assert found(table(spark, [])) == [] and found(bare(spark, [(5, None), (6, " ")])) == [(5, 0, 5), (6, 0, 6)]


def test_long_texts_in_slices(monkeypatch):
    text = prose(4000, 3).encode()
    whole = grams.word_hashes(text)
    monkeypatch.setattr(grams.slices, "__defaults__", (64,))
    assert np.array_equal(grams.word_hashes(text), whole) and b"".join(grams.slices(text)) == text
    assert grams.word_hashes(b"x" * 500 + b" y").size == 2 and grams.word_hashes(b" \t\n").size == 0
    few = grams.WordHashes(most=3)
    assert [few[w] for w in (b"a", b"b", b"c", b"d", b"a")] == [grams.SEEN[w] for w in (b"a", b"b", b"c", b"d", b"a")] and len(few) <= 3


def test_similarity_must_be_positive(spark):
    with pytest.raises(ValueError):
        jaccard_join.jaccard_components(bare(spark, []), similarity=0)
