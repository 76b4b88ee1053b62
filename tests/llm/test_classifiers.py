"""Quality and toxicity: edge cases, what is learned from, and held-out accuracy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from docsift.llm import quality, toxicity
from docsift.llm.common import documents, in_fold, labels
from tests.llm.helpers import EDGES, HAS_TABLES, prose, table

SF = "/root/testdata/sf0.01"

GOOD = [(i, prose(80, i).capitalize() + ".") for i in range(400)]
BAD = [(1000 + i, " ".join(w.upper() + "!!" for w in prose(60, i).split())) for i in range(60)]
RUDE = [(2000 + i, prose(30, i) + " you utter nincompoop " + prose(30, -i)) for i in range(120)]


def marks(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_quality_learns_from_positives_only(spark):
    docs = table(spark, GOOD + BAD + EDGES)
    held = in_fold(F.col("_id"), 5, 0)
    rows = [(i, 1, 0) for i, _ in GOOD[:150]]
    got = {r.doc_id: r for r in quality.quality_scores(docs, marks(spark, rows), held).collect()}
    assert np.mean([got[i].predicted for i, _ in GOOD]) > 0.97
    assert np.mean([got[i].predicted for i, _ in BAD]) < 0.1
    assert got[3].score == got[4].score and all(0 <= r.score <= 1 for r in got.values())
    assert all(r.predicted == int(r.score >= 0.3) for r in got.values())
    # Negative labels, labels of held-out documents, and repeated ones change nothing.
    more = [(i, 0, 1) for i, _ in BAD] + rows + [(None, 1, 0), (77777, 1, None)]
    again = {r.doc_id: r.score for r in quality.quality_scores(docs, marks(spark, rows + more), held).collect()}
    assert again[1001] == pytest.approx(got[1001].score, abs=0.05)
    kept = quality.keep_good(docs, marks(spark, rows), held)
    assert kept.columns == docs.columns
    assert 380 < kept.where("doc_id < 400").count() <= 400 + len(EDGES)


def test_quality_without_labels_or_rows(spark):
    docs, none = table(spark, EDGES), marks(spark, [])
    held = in_fold(F.col("_id"), 5, 0)
    assert {r.score for r in quality.quality_scores(docs, none, held).collect()} == {0.5}
    assert quality.quality_scores(table(spark, []), marks(spark, [(1, 1, 0)]), held).collect() == []


def test_non_negative_risk_turns_where_the_risk_is_negative():
    slopes = quality.non_negative_risk(0.9)
    p, u = slopes(np.zeros(4), np.zeros(4))
    assert np.allclose(p, -0.9 / 4) and np.allclose(u, 0.5 / 4)
    p, u = slopes(np.full(4, 5.0), np.full(4, -5.0))
    assert (u < 0).all() and (p > 0).all()


def test_prior_is_near_the_share_of_positives():
    rng = np.random.default_rng(0)
    positive = rng.normal(1.5, 1, (800, 4)).astype(np.float32)
    mixed = np.concatenate([rng.normal(1.5, 1, (560, 4)), rng.normal(-2.5, 1, (240, 4))]).astype(np.float32)
    assert 0.6 < quality.estimate_prior(positive, rng.permutation(mixed)) < 0.8


def test_toxicity_finds_what_toxic_texts_share(spark):
    docs = table(spark, GOOD + RUDE + EDGES)
    held = in_fold(F.col("_id"), 3, 1)
    rows = [(i, None, 0) for i, _ in GOOD] + [(i, None, 1) for i, _ in RUDE]
    got = {r.doc_id: r for r in toxicity.toxicity_scores(docs, marks(spark, rows), held).collect()}
    rude = [got[i] for i, _ in RUDE if got[i].held_out]
    good = [got[i] for i, _ in GOOD if got[i].held_out]
    assert rude and np.mean([r.predicted for r in rude]) > 0.9 and np.mean([r.predicted for r in good]) < 0.03
    assert got[3].score == got[4].score and got[3].n_windows == 1
    assert got[8].n_windows == -(-100_001 // toxicity.WINDOW_BYTES)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())


def test_toxicity_without_labels_or_rows(spark):
    held = in_fold(F.col("_id"), 3, 1)
    docs = table(spark, EDGES)
    for rows in ([], [(1, 1, 0)], [(1, 1, 1)]):
        assert {r.score for r in toxicity.toxicity_scores(docs, marks(spark, rows), held).collect()} == {0.0}
    assert toxicity.toxicity_scores(table(spark, []), marks(spark, [(1, 1, 1), (2, 1, 0)]), held).collect() == []


def test_windows_hold_the_whole_text():
    text = prose(1000, 3).encode()
    assert b"".join(toxicity.windows(text)) == b" " + b" ".join(text.split())
    assert toxicity.windows(b"") == [b" "] and max(map(len, toxicity.windows(b"y" * 5000))) == toxicity.WINDOW_BYTES


@pytest.mark.skipif(not HAS_TABLES, reason="no test tables")
def test_held_out_accuracy(spark):
    docs, marked = documents(spark, SF), labels(spark, SF)
    got = quality.quality_scores(docs, marked, in_fold(F.col("_id"), 5, 0)).where("held_out").join(marked, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in got]) > 0.93
    got = toxicity.toxicity_scores(docs, marked, in_fold(F.col("_id"), 3, 1)).where("held_out").join(marked, "doc_id").collect()
    assert np.mean([r.predicted for r in got if r.toxic == 0]) < 0.06
    assert np.mean([r.predicted == r.toxic for r in got]) > 0.88
