"""The pipeline's stages against brute force on what each of them was given, and every query on small tables."""

import inspect
from collections import Counter

import pytest

import corpus_pipeline
from docsift.llm import queries
from docsift.llm.common import documents, saved
from tests.llm.helpers import HAS_TABLES, SF_DIR, ascii_lower
from tests.llm.test_packing_mixing import check_packed
from tests.llm.test_similar import brute_kept

pytestmark = pytest.mark.skipif(not HAS_TABLES, reason="no test tables")


def test_stages(spark):
    docs = documents(spark, SF_DIR)
    columns = docs.columns
    inputs = {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = docs.collect()
        docs = saved(stage(spark, docs, SF_DIR), name.replace(" ", "-"))
        if name != "best-fit packing":
            assert docs.columns == columns
    packed = docs.collect()

    first = {r.doc_id: r for r in inputs["quality classifier"]}
    kept = inputs["exact dedup"]
    assert 0.7 * len(first) < len(kept) < len(first) and all(first[r.doc_id] == r for r in kept)

    last = {}
    for r in kept:
        last[ascii_lower(r.text)] = max(r.doc_id, last.get(ascii_lower(r.text), -1))
    once = inputs["simhash near-dedup"]
    assert sorted(r.doc_id for r in once) == sorted(last.values())

    mixed = inputs["source mixing"]
    assert sorted(r.doc_id for r in mixed) == brute_kept([(r.doc_id, r.text) for r in once])

    copies = inputs["best-fit packing"]
    assert {r.doc_id for r in copies} <= {r.doc_id for r in mixed}
    used = check_packed([(r.doc_id, r.text) for r in copies], packed, 2048)
    assert used <= 1.02 * sum(r.length for r in packed) / 2048 + 1


def test_run_is_the_stages(spark):
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(rows.columns) and rows.count() > 0


# These return phrases or components of vectors, and have tests of their own.
OTHER_ROWS = ("op12_phrase_mining", "op13_embedding_whitening")


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(OTHER_ROWS)))
def test_queries_return_a_row_per_document(spark, name):
    ids = Counter(r.doc_id for r in documents(spark, SF_DIR).select("doc_id").collect())
    got = queries.QUERIES[name](spark, SF_DIR)
    found = Counter(r.doc_id for r in got.select("doc_id").collect())
    if name.startswith(("op4_", "op8_")):
        assert set(found) <= set(ids)
    else:
        assert found == ids
    assert name.startswith("op") and inspect.isfunction(queries.QUERIES[name])
