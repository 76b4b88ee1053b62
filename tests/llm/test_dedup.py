"""Exact and near duplicates against brute force."""

import hashlib
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from docsift.llm import exact_dedup, simhash
from docsift.llm.components import connected_components
from tests.llm.helpers import EDGES, ascii_lower, bare, prose, table


def brute_exact(rows):
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault(ascii_lower(text or ""), []).append(doc_id)
    out = []
    for doc_id, text, *_ in rows:
        small = ascii_lower(text or "")
        ids = [i for i in groups[small] if i is not None]
        out.append((doc_id, max(ids, default=None), len(groups[small]), hashlib.sha256(small.encode()).hexdigest()))
    return sorted(out, key=str)


def check_exact(spark, rows, **options):
    got = exact_dedup.exact_duplicates(table(spark, rows), **options).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == brute_exact(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({ascii_lower(t or "") for _, t, *_ in rows})
    assert all(r.doc_id == r.keep_id for r in kept)


COPIES = [(i, prose(20, i % 7)) for i in range(200)]


def test_exact_edges(spark):
    check_exact(spark, EDGES)


def test_exact_collisions_and_small_buckets(spark):
    """Two keys for all texts: chains hold many texts, and buckets of one key are sliced."""
    check_exact(spark, COPIES + EDGES, key_of=lambda digest: (digest[0] & 1) << 63, capacity=500)


def test_exact_without_memory(spark):
    """Copies that no task recognises meet at their owners."""
    check_exact(spark, COPIES, remembered=0, capacity=300)


def test_exact_empty_table(spark):
    assert exact_dedup.exact_duplicates(table(spark, [])).collect() == []
    assert exact_dedup.drop_exact_duplicates(table(spark, [])).collect() == []


def test_drop_exact_keeps_columns(spark):
    docs = table(spark, EDGES)
    kept = exact_dedup.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert len(rows) == len({ascii_lower(t or "") for _, t in EDGES})
    assert {r.doc_id for r in rows if (r.text or "") == ""} == {4}
    assert all(r.Key == "k" and r._row == 7 for r in rows)


@pytest.mark.parametrize("capacity", [1, 100, 10_000])
def test_directory_splits_overfull_buckets(spark, capacity):
    keys = spark.createDataFrame([(k << 50, 10) for k in range(64)] + [(-(1 << 62), 10)] * 30, "key long, bytes long")
    directory = exact_dedup.build_directory(keys, capacity)
    assert list(directory.firsts) == sorted(directory.firsts) and directory.firsts[0] == 0
    assert directory.tasks == directory.slices.sum()
    held = {}
    for row in keys.collect():
        at = int((directory.firsts <= row.key % (1 << 64)).sum()) - 1
        held.setdefault(at, []).append(row)
    for at, rows in held.items():
        assert sum(r.bytes for r in rows) <= capacity * directory.slices[at] or len({r.key for r in rows}) == 1


def brute_print(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", ascii_lower(text or "").encode())
    if not words:
        return 0
    runs = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(r, seed=42) for r in runs]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_near(rows, distance=2):
    prints = [brute_print(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, *_) in enumerate(rows):
        least.setdefault(find(i), []).append(doc_id)
    named = {k: min((d for d in v if d is not None), default=None) for k, v in least.items()}
    return sorted(((rows[i][0], f"{prints[i]:016x}", named[find(i)]) for i in range(len(rows))), key=str)


def test_simhash_against_brute_force(spark):
    rows = [r for r in EDGES if r[0] not in (7, 8)]
    base = prose(400, 5)
    for i in range(60):
        words = base.split()
        words[(i * 7) % 400] = f"changed{i}"
        rows.append((100 + i, " ".join(words)))
    got = simhash.near_duplicates(table(spark, rows)).collect()
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == brute_near(rows)


def test_simhash_full_buckets_have_the_same_components(spark):
    """Buckets joined by common points give the components that pairs give."""
    prints = [0, 1, 3, 7, 15, 1 << 63, (1 << 63) | 5, 0xFFFF, 0xFFFE, 0xABCDEF, 0xABCDEF ^ 0x30000, 1 << 40 | 1 << 41 | 1 << 42]
    frame = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "p long")

    def components(paired):
        links = simhash.close_links(frame, "p", paired=paired)
        return sorted((r.node, r.root) for r in connected_components(links, "a", "b").collect())

    assert components(paired=0) == components(paired=1000)
    assert len(components(paired=0)) == 11


def test_simhash_empty_and_long(spark):
    assert simhash.near_duplicates(table(spark, [])).collect() == []
    got = {r.doc_id: r for r in simhash.near_duplicates(table(spark, [r for r in EDGES if r[0]])).collect()}
    assert got[3].fingerprint == got[5].fingerprint == "0" * 16
    assert got[3].component_id == got[4].component_id == got[5].component_id == 3
    assert got[2].component_id == 1 and len(got) == len({r[0] for r in EDGES if r[0]})


def test_drop_near_keeps_smallest_id(spark):
    docs = table(spark, EDGES)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert ids == sorted(["1", "3", "6", "7", "8", "9", "9", "None", "12"])


def test_components_of_a_long_chain(spark):
    links = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    more = spark.createDataFrame([(900, 901), (901, 902), (900, 902), (5, 5), (None, 3)], "a long, b long")
    got = {r.node: r.root for r in connected_components(links.unionByName(more), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(301)}, 900: 900, 901: 900, 902: 900}
    assert connected_components(bare(spark, []).select(F.col("doc_id").alias("a"), F.col("doc_id").alias("b")), "a", "b").collect() == []
