"""Spot signatures against a plain version in Python."""

import hashlib
import re

import xxhash
from pyspark.sql import functions as F

from docsift.llm import spotsigs
from tests.llm.helpers import EDGES, prose, table


def brute_signatures(text, chain=2):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    content, marked = [], False
    for word in words:
        if word in spotsigs.ANCHORS:
            marked = True
        else:
            content.append((word, marked))
            marked = False
    found = {" ".join(w for w, _ in content[i : i + chain]) for i, (_, after) in enumerate(content) if after and i + chain <= len(content)}
    if not found:
        found = {" " + " ".join(words)} if words else set()
    return {xxhash.xxh64_intdigest(s.encode(), 42) >> 32 for s in found}


def brute_jaccard(a, b):
    return 1.0 if not a | b else len(a & b) / len(a | b)


def as_text(found):
    return "".join(f"{h:08x}" for h in sorted(found, key=lambda h: h - (1 << 32) if h >> 31 else h))


def test_against_brute_force(spark):
    rows = [r for i, r in enumerate(EDGES) if r[0] is not None and r not in EDGES[:i] and r[0] != 9] + [(20 + i, prose(3 * i, i)) for i in range(12)]
    got = {r.doc_id: r for r in spotsigs.fingerprints_with_edits(table(spark, rows)).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    assert len(got) == len(rows)
    for k, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, other, next_ = (brute_signatures(t) for t in (text, edited, following))
        r = got[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (as_text(own), as_text(other))
        assert abs(r.near_edited - brute_jaccard(own, other)) < 1e-12 and abs(r.near_next - brute_jaccard(own, next_)) < 1e-12


def test_edges(spark):
    got = spotsigs.fingerprints_with_edits(table(spark, EDGES)).collect()
    # Rows that repeat id and text are one document; null ids come last.
    assert sorted((str(r.doc_id) for r in got)) == sorted(["1", "2", "3", "4", "5", "6", "7", "8", "9", "9", "12", "None"])
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].fingerprint == by_id[2].fingerprint != ""
    assert by_id[3].fingerprint == "" and by_id[4].near_next == 1.0
    assert spotsigs.fingerprints_with_edits(table(spark, [])).collect() == []
    one = spotsigs.fingerprints_with_edits(table(spark, [(1, "the only one of all")])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_no_python_in_the_plan(spark):
    plan = spotsigs.fingerprints_with_edits(table(spark, EDGES))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Scan ExistingRDD.*Python", plan.replace("ArrowEval", "Arrow"))


def test_near_duplicates(spark):
    base = prose(300, 7).split()
    rows = [(i, prose(120, 50 + i)) for i in range(20)]
    for i in range(15):
        words = list(base)
        words[20 * i : 20 * i + 4] = [f"w{i}x{j}" for j in range(4)]
        rows.append((100 + i, " ".join(words)))
    rows += [(200, rows[0][1].upper()), (None, rows[1][1]), (3, None), (4, ""), (5, "the of")]
    members, links = spotsigs.near_duplicates(table(spark, rows), similarity=0.8)
    prints = {}
    for doc_id, text in rows:
        if brute_signatures(text):
            prints.setdefault(frozenset(brute_signatures(text)), []).append(doc_id)
    sets = sorted(((min(d for d in ids if d is not None), s) for s, ids in prints.items()), key=lambda x: x[0])
    want = {(a, b) for i, (a, s) in enumerate(sets) for b, t in sets[i + 1 :] if brute_jaccard(s, t) >= 0.8}
    assert {(r.a, r.b) for r in links.collect()} == want and want
    got = members.collect()
    assert len(got) == len(rows)
    assert {r.class_id for r in got if r.doc_id and 100 <= r.doc_id < 115} == {100}
    assert next(r for r in got if r.doc_id == 200).class_id == 0


def test_pruned_jaccard(spark):
    row = spark.range(1).select(
        spotsigs.jaccard(F.array(F.lit(1), F.lit(2)), F.array(F.lit(2), F.lit(3))).alias("a"),
        spotsigs.jaccard(F.array(F.lit(1)), F.array(*map(F.lit, range(9))), 0.5).alias("b"),
    ).first()
    assert abs(row.a - 1 / 3) < 1e-12 and row.b == 0
