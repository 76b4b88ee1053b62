"""Near duplicates by Jaccard similarity against brute force."""

import random
import re

import corpus_pipeline
from docsift.llm import jaccard_join, similar
from docsift.llm.simhash import near_duplicates
from tests.llm.helpers import EDGES, ascii_lower, bare, prose, table


def brute_shingles(text, words=5):
    found = re.findall("[^ \t-\r]+", ascii_lower(text or ""))
    return {" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))} if found else set()


def brute_kept(rows, similarity=0.8):
    """The ids that stay: the smallest of each component, null ids last."""
    sets = [brute_shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a == sets[j] or (a and sets[j] and len(a & sets[j]) / len(a | sets[j]) >= similarity):
                root[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        r = top(i)
        least[r] = min(least.get(r, similar._LAST), similar._LAST if doc_id is None else doc_id)
    return sorted(least.values())


def kept(docs):
    return sorted(similar._LAST if r.doc_id is None else r.doc_id for r in docs.collect())


def edited(text, share, seed):
    """The text with the share of its words replaced, in one run."""
    rng, words = random.Random(seed), text.split()
    n = int(len(words) * share)
    at = rng.randrange(len(words) - n + 1)
    words[at : at + n] = [f"w{seed}x{i}" for i in range(n)]
    return " ".join(words)


def near_rows():
    rows = [(i, prose(60 + 7 * i, i)) for i in range(30)]
    rows += [(1000 + 10 * i + j, edited(rows[i][1], share, 10 * i + j)) for i in range(30) for j, share in enumerate((0.02, 0.06, 0.09, 0.12, 0.2))]
    # A group of near copies, a chain of edits, and texts that share all but their ends.
    rows += [(5000 + i, edited(rows[29][1], 0.05, 900 + i)) for i in range(40)]
    chain = prose(200, 77)
    for i in range(12):
        chain = edited(chain, 0.07, 700 + i)
        rows.append((6000 + i, chain))
    return rows + [(7000 + i, prose(90, 5) + " " + prose(40, 300 + i)) for i in range(25)]


def test_stage_against_brute_force(spark):
    rows = [*near_rows(), *EDGES]
    random.Random(3).shuffle(rows)
    want = brute_kept(rows)
    assert len(want) < len(rows) - 60
    got = corpus_pipeline.simhash_near_dedup(spark, table(spark, rows), "")
    assert got.columns == table(spark, []).columns and kept(got) == want


def test_small_chunks_and_blocks_lose_nothing(spark, monkeypatch):
    rows = near_rows()[::3]
    for name, value in (("CHUNK", 300), ("BLOCK", 200), ("ROWS", 3), ("COLUMNS", 16)):
        monkeypatch.setattr(jaccard_join, name, value)
    assert kept(similar.drop_similar(bare(spark, rows), similarity=0.6)) == brute_kept(rows, 0.6)


def test_stage_links_close_fingerprints(spark):
    # Repeated words weigh by their number in a fingerprint, but are few shingles of a set.
    often = "the river of stone and water was " * 60
    rows = [(3, often), (2, often + "then came quite other words that no text had before"), (1, prose(60, 8))]
    assert brute_kept(rows) == [1, 2, 3]
    assert near_duplicates(bare(spark, rows)).where("doc_id <> component_id").count() == 1
    assert kept(corpus_pipeline.simhash_near_dedup(spark, table(spark, rows), "")) == [1, 2]


def test_links_of_both_kinds_make_one_component(spark):
    often = "the river of stone and water was " * 60
    first = often + " ".join(f"a{i}" for i in range(60))
    rows = [(1, often), (2, first), (3, edited(first, 0.0, 1) + " end"), (4, None), (5, " ")]
    by_prints = {r.doc_id: r.component_id for r in near_duplicates(bare(spark, rows)).collect()}
    want = {frozenset(s) for s in ({1, 2, 3}, {4, 5})}
    assert by_prints[2] == by_prints[1] and len(brute_kept(rows)) == 3
    got = kept(similar.drop_similar(bare(spark, rows), distance=2))
    assert got == sorted(min(s) for s in want)


def test_empty_table(spark):
    assert similar.drop_similar(bare(spark, []), distance=2).collect() == []
    assert similar.drop_similar(bare(spark, [])).collect() == []
