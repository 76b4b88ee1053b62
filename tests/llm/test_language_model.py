"""The language model: counts against brute force, slopes against differences, and a distribution that sums to one."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docsift.llm import language_model as lm
from docsift.llm.common import documents, in_fold
from tests.llm.helpers import EDGES, HAS_TABLES, SF_DIR, ascii_lower, prose, table


def brute(rows):
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(t or "")) + [None] for _, t in rows]
    counts = Counter()
    for (doc_id, _), found in zip(rows, tokens, strict=True):
        if doc_id is None or zlib.crc32(str(doc_id).encode()) % 10:
            counts.update(found)
    total = sum(counts.values())
    denominator = total + 0.1 * (len(counts) + 1)
    out = []
    for (doc_id, _), found in zip(rows, tokens, strict=True):
        base = sum(math.log10((counts[t] + 0.1) / denominator) for t in found)
        out.append((doc_id, len(found), sum(counts[t] > 0 for t in found), total, base))
    return sorted(out, key=str)


ROWS = EDGES + [(20 + i, prose(40 + 11 * i, i)) for i in range(60)]


@pytest.mark.parametrize("shared", [lm.SHARED_COUNTS, 30])
def test_base_scores(spark, monkeypatch, shared):
    """With few shared counts most tokens are met in the join."""
    monkeypatch.setattr(lm, "SHARED_COUNTS", shared)
    got = lm.likelihoods(table(spark, ROWS), in_fold(F.col("doc_id"), 10, 0), rounds=1).collect()
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=str)
    for a, b in zip(got, brute(ROWS), strict=True):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4], rel=1e-9)


def test_empty_and_all_held_out(spark):
    assert lm.likelihoods(table(spark, []), in_fold(F.col("doc_id"), 10, 0)).collect() == []
    got = lm.likelihoods(table(spark, EDGES), F.lit(True)).collect()
    assert len(got) == len(EDGES) and all(r.train_tokens == r.n_known == 0 and r.base_score == 0 for r in got)
    assert all(math.isfinite(r.score) for r in got)


def small_model():
    counts = Counter(t for i in range(30) for t in lm.tokens_of(prose(100, i).encode()))
    items = sorted(counts.items(), key=lambda x: (-x[1], x[0]))
    mass = np.full(lm.TAILS, 0.1)
    for token, n in items[lm.HEAD :]:
        mass[lm.tail_of(token)] += n + 0.1
    return lm.Vocabulary([t for t, _ in items], np.array([n for _, n in items]), sum(counts.values()), len(counts), mass)


def test_symbols_have_a_distribution():
    """All head words and tail classes together have probability one after any text."""
    vocabulary = small_model()
    look = lm.Lookup.of(vocabulary)
    weights = lm.train(lm.first_weights(vocabulary), [look.read(prose(200, i).encode())[2] for i in range(20)], look.end)[0]
    start = look.read(b"the river of stone")[2][:-1]
    every = np.concatenate([np.arange(len(vocabulary.tokens)), lm.HEAD + np.arange(lm.TAILS)]).astype(np.int32)
    base = dict(lm.log_likelihoods(weights, [start], look.end))[0]
    logs = dict(lm.log_likelihoods(weights, [np.append(start, s).astype(np.int32) for s in every], look.end))
    assert sum(math.exp(logs[i] - base) for i in range(len(every))) == pytest.approx(1, abs=1e-3)


def test_state_is_carried_and_documents_do_not_mix():
    vocabulary = small_model()
    look = lm.Lookup.of(vocabulary)
    docs = [look.read(prose(n, n).encode())[2] for n in (700, 3, 150, 64, 63, 65, 1, 400)] + [look.read(b"")[2]]
    weights = lm.train(lm.first_weights(vocabulary), docs, look.end)[0]
    together = dict(lm.log_likelihoods(weights, docs, look.end))
    assert sorted(together) == list(range(len(docs)))
    for i, symbols in enumerate(docs):
        state, total = np.zeros((1, lm.HIDDEN), dtype=np.float32), 0.0
        run = np.concatenate([[look.end], symbols])
        for a, b in zip(run, run[1:], strict=False):
            window = lm.Window(np.array([[a]]), np.array([[b]]), np.array([[False]]), np.array([[0]]), np.array([0]))
            out, state, _ = lm._run(weights, window, state, keep=False)
            total += float(lm._predict(weights, out, window.targets, None)[0][0])
        assert together[i] == pytest.approx(total, rel=1e-4)


def test_slopes_match_differences():
    vocabulary = small_model()
    look = lm.Lookup.of(vocabulary)
    rng = np.random.default_rng(0)
    weights = {n: (w + rng.normal(0, 0.1, w.shape)).astype(np.float64) for n, w in lm.first_weights(vocabulary).items()}
    docs = [look.read(prose(n, n).encode())[2] for n in (9, 4, 13)]
    window = next(lm.in_lanes(lm.long_first(docs, look.end), 2, 20))

    def loss():
        out, _, _ = lm._run(weights, window, np.zeros((2, lm.HIDDEN)), keep=False)
        return -float(lm._predict(weights, out, window.targets, None)[0].sum())

    grads = {n: np.zeros_like(w) for n, w in weights.items()}
    out, _, kept = lm._run(weights, window, np.zeros((2, lm.HIDDEN)), keep=True)
    _, slopes = lm._predict(weights, out, window.targets, grads)
    lm._go_back(weights, window, kept, slopes, grads)
    for name, grad in grads.items():
        at = np.unravel_index(np.argmax(np.abs(grad)), grad.shape)
        held, step = weights[name][at], 0.01
        weights[name][at] = held + step
        up = loss()
        weights[name][at] = held - step
        down = loss()
        weights[name][at] = held
        assert (up - down) / (2 * step) == pytest.approx(grad[at], rel=0.03, abs=2e-3), name


def test_words_of_batches():
    """Split as each text alone is: by blanks, tabs and line ends only, in bytes, however many stand together."""
    texts = [t for _, t in EDGES] + ["", "  a\x1cB \t\r\n\x0b\x0cC\x1f ", "\x85d\u2003E\xa0f", "\x00 \x00", "İ ſ É"]
    values = pa.array([None if t is None else t.encode() for t in texts] + [b"\xff A\xc3 B\x80"], pa.binary())
    column = pa.Array.from_buffers(pa.string(), len(values), values.buffers(), values.null_count)
    for part, plain in ((column, values), (column[5:], values[5:]), (column[:0], values[:0])):
        words, before = lm.words_of(part)
        found = [words[a:b].to_pylist() + [lm.END] for a, b in zip(before, before[1:], strict=False)]
        assert found == [lm.tokens_of(t or b"") for t in plain.to_pylist()]


@pytest.mark.parametrize("held", [lm.HELD_COUNTS, 40])
def test_counts_of_many_batches(spark, monkeypatch, held):
    monkeypatch.setattr(lm, "HELD_COUNTS", held)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = {r.token: (r.tail, r.n) for r in lm.token_counts(table(spark, ROWS).coalesce(1)).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    counts = Counter(t for _, text in ROWS for t in lm.tokens_of((text or "").encode()))
    assert {bytes(t): n for t, (_, n) in got.items()} == dict(counts) and all(tail == lm.tail_of(t) for t, (tail, _) in got.items())


def test_training_reads_written_symbols(spark, monkeypatch):
    """Texts are not split into tokens again for training: all rows come with their symbols, once."""
    given, train_rounds = [], lm.train_rounds
    monkeypatch.setattr(lm, "train_rounds", lambda df, *rest: given.append(df) or train_rounds(df, *rest))
    lm.likelihoods(table(spark, ROWS), in_fold(F.col("doc_id"), 10, 0), rounds=2)
    assert "text" not in given[0].columns
    rows = given[0].select("doc_id", "held_out", "round", "n_tokens", "symbols").collect()
    got = sorted(((r.doc_id, r.n_tokens, r.held_out) for r in rows), key=str)
    assert got == [(i, n, i is not None and zlib.crc32(str(i).encode()) % 10 == 0) for i, n, *_ in brute(ROWS)]
    assert all(len(r.symbols) == r.n_tokens * lm.SYMBOL.itemsize for r in rows) and {r["round"] for r in rows} == {0, 1}


def test_scores_match_the_network_apart_from_spark(spark):
    """Trained in one task and one round, the scores are those of the same network, with each rare word's share of its tail class."""
    rows = [(i, text + "".join(f" w{i}x{j}" for j in range(60))) for i, text in ROWS[len(EDGES) :]]
    got = {r.doc_id: r.score for r in lm.likelihoods(table(spark, rows).coalesce(1), in_fold(F.col("doc_id"), 10, 0), rounds=1).collect()}
    docs = {i: text.encode() for i, text in rows}
    training = [text for i, text in docs.items() if zlib.crc32(str(i).encode()) % 10]
    counts = Counter(t for text in training for t in lm.tokens_of(text))
    items = sorted(counts.items(), key=lambda x: (-x[1], x[0]))
    assert len(items) > lm.HEAD
    mass = np.full(lm.TAILS, 0.1)
    for token, n in items[lm.HEAD :]:
        mass[lm.tail_of(token)] += n + 0.1
    vocabulary = lm.Vocabulary([t for t, _ in items], np.array([n for _, n in items]), sum(counts.values()), len(counts), mass)
    look = lm.Lookup.of(vocabulary)
    weights = lm.train(lm.first_weights(vocabulary), map(look.symbols, training), look.end)[0]
    logs = dict(lm.log_likelihoods(weights, map(look.symbols, docs.values()), look.end))
    for number, (i, text) in enumerate(docs.items()):
        tokens, _, symbols = look.read(text)
        shares = sum(math.log10((counts[t] + 0.1) / mass[s - lm.HEAD]) for t, s in zip(tokens, symbols.tolist(), strict=True) if s >= lm.HEAD)
        assert got[i] == pytest.approx(logs[number] / math.log(10) + shares, rel=1e-5)


@pytest.mark.skipif(not HAS_TABLES, reason="no test tables")
def test_better_than_the_base_on_held_out_texts(spark):
    got = lm.likelihoods(documents(spark, SF_DIR), in_fold(F.col("doc_id"), 10, 0)).where("held_out").collect()
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_the_network_knows_2048_words():
    assert lm.HEAD == 2048 and lm.HIDDEN == 16
    counts = np.arange(3000, 0, -1)
    tokens = [b"w%d" % i for i in range(len(counts))]
    vocabulary = lm.Vocabulary(tokens, counts, int(counts.sum()), len(counts), np.full(lm.TAILS, 0.1))
    found = lm.Lookup.of(vocabulary).symbols(b"w0 w1500 w2047 w2048")[:-1]
    assert found[:3].tolist() == [0, 1500, 2047] and found[3] >= lm.HEAD
