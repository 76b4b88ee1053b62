"""Packing and mixing: whole against the tokenizer, a greedy packer and the Poisson distribution itself."""

import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docsift.llm import mixing, packing
from docsift.llm.queries import ORACLES
from tests.llm.helpers import EDGES, HAS_TABLES, SF_DIR, prose, table

PATH = public_tokenizers.path("word_bpe_49k.json")

ODD = [
    "It's the dogs' bone, isn't it? ...!!&&& ½ x́ H̱ ẖ <|endoftext|> <|ENDOFTEXT|> 12,345.67",
    "The&&& THE!! the, ÉCOLE école Straße İstanbul ΣΟΦΟΣ nbsp em\x1cfs\x0bvt tab\tnew\r\nline",
    "a_b __init__ (x) [y] {z} ~`@#$%^*+= 漢字かな 😀😀 'll 's 't re've don't",
]


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def test_chunks_have_the_ids_of_the_text():
    tokenizer, chunks = Tokenizer.from_file(PATH), packing.ChunkIds(PATH, limit=50)
    for text in [t or "" for _, t in EDGES if t is None or len(t) < 1000] + ODD + [prose(300, 4)]:
        assert list(np.frombuffer(chunks.of(text.encode()), dtype="<u4")) == tokenizer.encode(text, add_special_tokens=False).ids


def test_marks_and_cases_have_the_ids_of_the_text():
    """Short texts of letters in both cases, every combining mark that meets ASCII, and special names, against the tokenizer."""
    tokenizer, chunks = Tokenizer.from_file(PATH), packing.ChunkIds(PATH, limit=2000)
    marks = [chr(c) for c in range(0x300, 0x370)]
    texts = [base + mark + end for base in "TtHhWwYyAaJj" for mark in marks for end in ("", "x", " T")]
    rng = np.random.default_rng(7)
    letters = [*"TtHWyAzK 9'", "É", "ß", "İ", "ſ", "K", "漢", "\u0340", "\u0343", "\u0344", "\u0345", "<|endoftext|>", "\u1100", "\u1161", *rng.choice(marks, 12)]
    texts += ["".join(rng.choice(letters, rng.integers(1, 7))) for _ in range(100_000)]
    want = tokenizer.encode_batch(texts, add_special_tokens=False)
    wrong = [t for t, w in zip(texts, want, strict=True) if list(np.frombuffer(chunks.of(t.encode()), dtype="<u4")) != w.ids]
    assert wrong == []


def check_packed(rows, got, capacity):
    tokenizer = Tokenizer.from_file(PATH)
    want = Counter()
    for doc_id, text, *_ in rows:
        ids = ids_of(tokenizer, text)
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            want[doc_id, piece, at, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        place = 0
        for offset, length in sorted(parts):
            assert offset == place
            place += length
        assert place <= capacity
    return len(sequences)


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for length in sorted(lengths, reverse=True):
        fitting = [i for i, g in enumerate(gaps) if g >= length]
        if fitting:
            i = min(fitting, key=lambda i: gaps[i])
            gaps[i] -= length
        else:
            gaps.append(capacity - length)
    return len(gaps)


@pytest.mark.parametrize("capacity", [64, 2048])
def test_packing(spark, capacity):
    rows = [r for r in EDGES if r[0] != 8] + [(100 + i, t) for i, t in enumerate(ODD)] + [(200 + i, prose(1 + i * 3 % 50, i)) for i in range(150)]
    got = packing.pack_documents(table(spark, rows), PATH, capacity=capacity).collect()
    used = check_packed(rows, got, capacity)
    assert used <= best_fit_decreasing([r.length for r in got], capacity) + 1
    some = next(r for r in got if r.doc_id == 12)
    assert list(np.frombuffer(some.ids, dtype="<u4")) == ids_of(Tokenizer.from_file(PATH), "one")


def test_packing_empty_table(spark):
    assert packing.pack_documents(table(spark, []), PATH).collect() == []


def test_sweep_places_everything():
    rng = np.random.default_rng(0)
    lengths = Counter(int(x) for x in rng.integers(1, 101, 3000))
    left, gaps, opened, rounds = dict(lengths), {}, 0, 0
    while any(left.values()):
        before = sum(left.values())
        fills, new, gaps = packing.sweep(left, dict(gaps), 100)
        assert sum(left.values()) == before - sum(f.count * f.each for f in fills + new) < before
        opened += sum(f.count for f in new)
        rounds += 1
    assert opened * 100 - sum(g * n for g, n in gaps.items()) == sum(k * n for k, n in lengths.items())
    assert opened <= best_fit_decreasing([k for k, n in lengths.items() for _ in range(n)], 100) + 1 and rounds < 30


def test_mixing_edges(spark):
    rows = [(i, prose(30, i), "big") for i in range(60)] + [(100 + i, prose(30, i), None) for i in range(6)]
    rows += [(200, None, "empty"), (201, "", "empty"), (None, "some text", "big"), (0, prose(30, 0), "big")]
    got = mixing.mix_sources(table(spark, rows)).collect()
    assert sorted(r.position for r in got) == list(range(len(got)))
    assert {r.source for r in got} <= {"big", None}
    copies = Counter((r.doc_id, r.copy) for r in got)
    assert copies[0, 0] in (0, 2)
    rates = {r.source: r.rate for r in got}
    assert rates[None] > 1 > rates["big"]
    again = mixing.mix_sources(table(spark, rows).repartition(3)).collect()
    assert Counter((r.doc_id, r.n_copies, r.copy) for r in again) == Counter((r.doc_id, r.n_copies, r.copy) for r in got)


def test_mixing_targets(spark):
    rows = [(i, "word " * 10, "ab"[i % 2]) for i in range(400)] + [(900, "left out", "c")]
    docs = table(spark, rows)
    kept = mixing.mixed_documents(docs, targets={"a": 0.9, "b": 0.1, "absent": 5.0})
    assert kept.columns == docs.columns
    counts = Counter(r.source for r in kept.collect())
    # Shares of sources that are there are relative to all targets named among them.
    assert set(counts) == {"a", "b"} and 8 < counts["a"] / counts["b"] < 10.5
    assert mixing.mix_sources(table(spark, [])).collect() == []


@pytest.mark.parametrize("rate", [0.3, 1.0, 4.5, 16.0])
def test_counts_have_the_poisson_distribution(spark, rate):
    u = spark.range(20_000).select(mixing.uniform(F.lit("seed"), F.col("id").cast("string")).alias("u"))
    steps = mixing.poisson_steps(F.lit(rate))
    got = [r.k for r in u.select(F.size(F.filter(steps, lambda v: v <= F.col("u"))).alias("k")).collect()]
    assert abs(np.mean(got) - rate) < 4 * (rate / len(got)) ** 0.5
    assert abs(np.var(got) - rate) < 0.08 * rate


def test_large_rates_are_split(spark):
    rows = [(i, "w", "small") for i in range(4)] + [(10, "w" * 4000, "large")]
    got = mixing.mix_sources(table(spark, rows), targets={"small": 1.0, "large": 1.0}).collect()
    small = [r for r in got if r.source == "small"]
    assert small[0].rate > 400 and 1700 < len(small) < 2300


@pytest.mark.skipif(not HAS_TABLES, reason="no test tables")
def test_mixing_query_against_sql(spark):
    from docsift.llm.queries import QUERIES

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    for name in ("op4_mix_sources", "op10_exact_dedup"):
        want = con.execute(ORACLES[name]).df()
        got = QUERIES[name](spark, SF_DIR).toPandas()[list(want.columns)]
        order = list(want.columns)
        assert got.sort_values(order).astype(str).values.tolist() == want.sort_values(order).astype(str).values.tolist()
