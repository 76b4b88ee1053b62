"""Scoring texts with a gated recurrent language model whose softmax is factored into classes.

Counts of all training tokens are a Spark aggregation. The most frequent words are the network's vocabulary, dealt to
classes by frequency; every other token belongs to a tail class by its last byte, within which it has the share of its
count. A token's probability is that of its class given the state, times that of the word in its class: a second softmax
for vocabulary words, the share for the others. Every tail class keeps a share for unknown tokens, so it is a probability.

The network, in numpy, is trained on all training documents once, by truncated backpropagation: documents run through
lanes in windows, and the state is carried from window to window and starts from zero with a document. Documents are dealt
to rounds; in a round every task trains on what it reads from the weights all tasks share, and the weights are averaged,
weighted by tokens. Softmax biases start from the counts, so the untrained model is the unigram model.

Texts are split into tokens twice, to count them and, with the vocabulary, to write every document's symbols; training and
scoring read the symbols. Scoring runs through every whole document in the same way without going back. Counts of the most
frequent tokens travel with the vocabulary; those of all rarer ones are met in a join.
"""

from __future__ import annotations

import uuid
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.llm.common import id_and_text, saved

CLASSES, CLASS_WORDS = 32, 64
HEAD = CLASSES * CLASS_WORDS
TAILS = 32
# Written symbols.
SYMBOL = np.dtype("<i2")
HIDDEN = 16
# Counts of so many most frequent tokens are sent to all tasks.
SHARED_COUNTS = 1 << 18
ROUNDS = 4
TRAIN_LANES, SCORE_LANES = 256, 512
TRAIN_STEPS, SCORE_STEPS = 48, 64
RATE = 0.03
# Tokens that wait for a lane; and the longest piece of a document in training, after which the state starts anew.
BUFFER = 2_000_000
SEGMENT = 1024
# Partial sums of weights that reach the driver, whatever the number of tasks.
SUMS = 8
# A task hands on its counts whenever it holds so many tokens.
HELD_COUNTS = 400_000
# No word holds a blank.
END = b" "
_NEVER = -30.0
# Rows of a softmax at a time.
BLOCK = 512


def tokens_of(text: bytes) -> list[bytes]:
    """The words, lower-cased in A-Z, and one end."""
    words = text.lower().split()
    words.append(END)
    return words


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts of a batch, as ``tokens_of`` finds them, and how many stand before each text, and in all."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words = lists.flatten().cast(pa.binary())
    # White space at the ends of a text leaves empty words.
    some = pc.greater(pc.binary_length(words), 0)
    before = np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))])
    return words.filter(some), before[lists.offsets.to_numpy()]


def tail_of(token: bytes) -> int:
    return token[-1] % TAILS


def _tails(tokens: pa.Array) -> np.ndarray:
    """``tail_of`` each token of an array."""
    _, offsets, data = tokens.buffers()
    ends = np.frombuffer(offsets, dtype=np.int32)[tokens.offset + 1 : tokens.offset + len(tokens) + 1]
    return (np.frombuffer(data, dtype=np.uint8)[ends - 1] % TAILS).astype(np.int32)


def _with_end(words: pa.Array) -> pa.Array:
    return pa.concat_arrays([words, pa.array([END], pa.binary())])


def token_counts(texts: DataFrame) -> DataFrame:
    """``token, tail, n`` over the column ``text``, one row per distinct token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def merged(held: list[pa.Table]) -> pa.Table:
            sums = pa.concat_tables(held).group_by("token", use_threads=False).aggregate([("n", "sum")])
            return pa.table({"token": sums["token"], "n": sums["n_sum"]})

        def rows(held: pa.Table) -> pa.RecordBatch:
            tokens, n = (held[name].combine_chunks() for name in ("token", "n"))
            return pa.RecordBatch.from_arrays([tokens, pa.array(_tails(tokens)), n], names=["token", "tail", "n"])

        held: list[pa.Table] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            coded = words_of(batch.column(0))[0].dictionary_encode()
            n = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
            held.append(pa.table({"token": _with_end(coded.dictionary), "n": pa.array(np.append(n, batch.num_rows), pa.int64())}))
            if sum(map(len, held)) > HELD_COUNTS:
                held = [merged(held)]
                if len(held[0]) > HELD_COUNTS:
                    yield rows(held.pop())
        if held:
            yield rows(merged(held))

    partial = texts.select("text").mapInArrow(run, "token binary, tail int, n long")
    return partial.groupBy("token", "tail").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """The most frequent tokens with their counts, most frequent first, and the sums over all tokens."""

    tokens: list[bytes]
    counts: np.ndarray
    total: int
    distinct: int
    # Per tail class the sum of n + 0.1 over its tokens outside the head, and 0.1 for an unknown one.
    tail_mass: np.ndarray
    # Tells vocabularies apart in workers that live through several runs.
    key: str = field(default_factory=lambda: uuid.uuid4().hex)

    @property
    def denominator(self) -> float:
        return self.total + 0.1 * (self.distinct + 1)


def read_vocabulary(counts: DataFrame) -> Vocabulary:
    """From the written counts. The driver holds at most ``SHARED_COUNTS`` tokens, their numbers by size, and a sum per tail.

    Which tokens are shared is a bound on their counts, found from a histogram of 16 bins to the power of two.
    """
    size = F.floor(F.log2(F.col("n").cast("double")) * 16)
    bins = sorted(((r.bin, r.types) for r in counts.groupBy(size.alias("bin")).agg(F.count("*").alias("types")).collect()), reverse=True)
    least, held = None, 0
    for number, types in bins:
        if held + types > SHARED_COUNTS:
            break
        least, held = number, held + types
    top = counts.where(size >= (F.lit(1 << 30) if least is None else F.lit(least))).select("token", "n").toArrow()
    tokens, n = top.column("token").to_pylist(), np.asarray(top.column("n")).astype(np.int64)
    order = sorted(range(len(tokens)), key=lambda i: (-n[i], tokens[i]))
    tokens, n = [tokens[i] for i in order], n[order]
    mass = np.full(TAILS, 0.1)
    total = distinct = 0
    for row in counts.groupBy("tail").agg(F.sum("n").alias("n"), F.count("*").alias("types")).collect():
        mass[row.tail] += row.n + 0.1 * row.types
        total, distinct = total + row.n, distinct + row.types
    for token, count in zip(tokens[:HEAD], n[:HEAD], strict=True):
        mass[tail_of(token)] -= count + 0.1
    return Vocabulary(tokens, n, total, distinct, np.maximum(mass, 0.1))


class _Ranks(dict):
    """Ranks by token; of a token outside of the vocabulary, -1 less its tail class."""

    def __missing__(self, token: bytes) -> int:
        return -1 - tail_of(token)


@dataclass
class Lookup:
    """What a task needs of the vocabulary. Symbols are places in the head, then tail classes."""

    ranks: _Ranks
    # By rank, and counted from the back, by the negative ranks of unknown tokens: symbols, logarithms of n + 0.1, and those
    # of shares in tail classes, 0 in the head. Of an unknown token the logarithm of n + 0.1 is left out of both.
    symbol_of: np.ndarray
    logs: np.ndarray
    shares: np.ndarray

    @classmethod
    def of(cls, vocabulary: Vocabulary) -> Lookup:
        ranks = _Ranks(zip(vocabulary.tokens, range(len(vocabulary.tokens)), strict=True))
        symbols = np.arange(len(ranks) + TAILS)
        symbols[HEAD : len(ranks)] = [HEAD + tail_of(t) for t in vocabulary.tokens[HEAD:]]
        symbols[len(ranks) :] = HEAD + np.arange(TAILS)[::-1]
        logs = np.concatenate([np.log10(vocabulary.counts + 0.1), np.zeros(TAILS)])
        shares = np.zeros(len(symbols))
        in_tail = symbols >= HEAD
        shares[in_tail] = logs[in_tail] - np.log10(vocabulary.tail_mass)[symbols[in_tail] - HEAD]
        return cls(ranks, symbols.astype(np.int32), logs, shares)

    @property
    def end(self) -> int:
        return int(self.symbol_of[self.ranks[END]])

    def symbols(self, text: bytes) -> np.ndarray:
        return self.read(text)[2]

    def ranks_of(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.ranks.__getitem__, tokens), dtype=np.int32, count=len(tokens))

    def read(self, text: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Tokens, their ranks, negative outside of the vocabulary, and symbols of a text."""
        tokens = tokens_of(text)
        ranks = self.ranks_of(tokens)
        return tokens, ranks, self.symbol_of[ranks]


_LOOKUPS: dict[str, Lookup] = {}


def _lookup(shared: Broadcast) -> Lookup:
    """The lookup of a broadcast vocabulary, made once per worker."""
    vocabulary = shared.value
    if vocabulary.key not in _LOOKUPS:
        _LOOKUPS.clear()
        _LOOKUPS[vocabulary.key] = Lookup.of(vocabulary)
    return _LOOKUPS[vocabulary.key]


@dataclass
class Window:
    """Steps by lanes: inputs, targets (-1 where a lane is empty), starts of documents, documents, and lanes kept."""

    inputs: np.ndarray
    targets: np.ndarray
    starts: np.ndarray
    docs: np.ndarray
    lanes: np.ndarray


def long_first(docs: Iterable[np.ndarray], end: int, segment: int | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """The documents, numbered as they come, in buffers of ``BUFFER`` tokens from the longest to the shortest.

    Lanes then run empty at about the same time. Each is its symbols after the one before the first, the end's at a
    document's start. With ``segment`` documents are cut into pieces of so many tokens.
    """

    def ordered(held: list[tuple[int, np.ndarray]]) -> list[tuple[int, np.ndarray]]:
        return sorted(held, key=lambda item: -len(item[1]))

    held: list[tuple[int, np.ndarray]] = []
    size = 0
    for number, symbols in enumerate(docs):
        run = np.empty(len(symbols) + 1, dtype=np.int32)
        run[0], run[1:] = end, symbols
        step = segment or len(symbols)
        held += [(number, run[at : at + step + 1]) for at in range(0, len(symbols), step)]
        size += len(symbols)
        if size >= BUFFER:
            yield from ordered(held)
            held, size = [], 0
    yield from ordered(held)


def in_lanes(feed: Iterator[tuple[int, np.ndarray]], lanes: int, steps: int) -> Iterator[Window]:
    """Run symbols through lanes, window by window; an empty lane takes the next of the feed.

    ``Window.lanes`` are the lanes of the window before whose states go on; emptied lanes are dropped when the feed is
    at its end.
    """
    held: list[tuple[int, np.ndarray, int] | None] = [None] * lanes
    more = True
    while True:
        n = len(held)
        inputs, targets = np.zeros((n, steps), dtype=np.int32), np.full((n, steps), -1, dtype=np.int32)
        starts, numbers = np.zeros((n, steps), dtype=bool), np.zeros((n, steps), dtype=np.int64)
        for lane in range(n):
            place = 0
            while place < steps:
                if held[lane] is None:
                    taken = next(feed, None) if more else None
                    if taken is None:
                        more = False
                        break
                    held[lane] = (*taken, 0)
                    starts[lane, place] = True
                number, run, at = held[lane]
                m = min(steps - place, len(run) - 1 - at)
                inputs[lane, place : place + m] = run[at : at + m]
                targets[lane, place : place + m] = run[at + 1 : at + m + 1]
                numbers[lane, place : place + m] = number
                held[lane] = (number, run, at + m) if at + m + 1 < len(run) else None
                place += m
        used = np.flatnonzero(targets[:, 0] >= 0)
        if not len(used):
            return
        yield Window(*(np.ascontiguousarray(a[used].T) for a in (inputs, targets, starts, numbers)), used)
        held = [held[lane] for lane in used]
        if more and len(held) < lanes:
            held += [None] * (lanes - len(held))


SHAPES = {
    "embedding": (HEAD + TAILS, 3 * HIDDEN),
    "gates": (HIDDEN, 2 * HIDDEN),
    "candidate": (HIDDEN, HIDDEN),
    # The last row holds the biases.
    "to_class": (HIDDEN + 1, CLASSES + TAILS),
    "to_word": (CLASSES, HIDDEN + 1, CLASS_WORDS),
}

Weights = dict[str, np.ndarray]


def first_weights(vocabulary: Vocabulary, seed: int = 1) -> Weights:
    """Random recurrent weights, zero softmax weights, and biases of the unigram model."""
    rng = np.random.default_rng(seed)
    weights = {name: np.zeros(shape, dtype=np.float32) for name, shape in SHAPES.items()}
    weights["embedding"] = rng.normal(0, 0.5, SHAPES["embedding"]).astype(np.float32)
    for name in ("gates", "candidate"):
        weights[name] = rng.normal(0, HIDDEN**-0.5, SHAPES[name]).astype(np.float32)
    mass = np.zeros(HEAD)
    mass[: len(vocabulary.counts[:HEAD])] = vocabulary.counts[:HEAD] + 0.1
    mass = mass.reshape(CLASSES, CLASS_WORDS)
    of_class = mass.sum(axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        weights["to_word"][:, -1] = np.maximum(np.nan_to_num(np.log(mass / of_class[:, None]), nan=_NEVER, neginf=_NEVER), _NEVER)
        everything = np.concatenate([of_class, vocabulary.tail_mass])
        weights["to_class"][-1] = np.maximum(np.log(everything / everything.sum()), _NEVER)
    return weights


def _run(weights: Weights, window: Window, state: np.ndarray, keep: bool):
    """States after every step, the last state, and with ``keep`` what backpropagation needs.

    Within a window arrays are steps by units by lanes, so that each step works on whole blocks of memory.
    """
    steps, lanes = window.inputs.shape
    # Sigmoids take the negative, and tanh, by the exponential, twice the negative.
    scale = np.repeat(np.array([-1, -2], dtype=np.float32), [2 * HIDDEN, HIDDEN])
    given = np.ascontiguousarray((weights["embedding"] * scale)[window.inputs].transpose(0, 2, 1))
    gates, candidate = (weights["gates"] * np.float32(-1)).T.copy(), (weights["candidate"] * np.float32(-2)).T.copy()
    out = np.empty((steps, HIDDEN, lanes), dtype=np.float32)
    held = steps if keep else 1
    gate, cand, shut = (np.empty((held, k, lanes), dtype=np.float32) for k in (2 * HIDDEN, HIDDEN, HIDDEN))
    change = np.empty((HIDDEN, lanes), dtype=np.float32)
    before = []
    anew, goes_on = window.starts.any(axis=1).tolist(), (~window.starts).astype(np.float32)
    state = np.ascontiguousarray(state.T)
    for t in range(steps):
        if anew[t]:
            state = state * goes_on[t]
        k = t if keep else 0
        x, g, c, rh = given[t], gate[k], cand[k], shut[k]
        np.matmul(gates, state, out=g)
        g += x[: 2 * HIDDEN]
        np.exp(g, out=g)
        g += 1
        np.reciprocal(g, out=g)
        np.multiply(g[HIDDEN:], state, out=rh)
        np.matmul(candidate, rh, out=c)
        c += x[2 * HIDDEN :]
        np.exp(c, out=c)
        c += 1
        np.divide(2, c, out=c)
        c -= 1
        if keep:
            before.append(state)
        np.subtract(c, state, out=change)
        change *= g[:HIDDEN]
        np.add(state, change, out=out[t])
        state = out[t]
    return out, state.T.copy(), (before, gate, cand, shut) if keep else None


def _large(weights: np.ndarray) -> np.ndarray:
    """Whether an exponential of a softmax could overflow, whatever the state: states are between -1 and 1."""
    return (np.abs(weights[..., :HIDDEN, :]).sum(axis=-2) + weights[..., HIDDEN, :]).max(axis=-1) > 60


def _softmax(held: np.ndarray, weights: np.ndarray, chosen: np.ndarray, large: bool, grads: np.ndarray | None) -> tuple[np.ndarray, np.ndarray | None]:
    """The log probability of each row's chosen column under the softmax of ``held @ weights``.

    With ``grads`` the softmax's slopes for the weights are added to it, and those for the states of the rows returned. Rows
    are scaled down only if ``large``. Blocks of rows stay in the cache.
    """
    n, width = len(held), weights.shape[1]
    logs = np.empty(n, dtype=np.float32)
    back = None if grads is None else np.empty((n, HIDDEN), dtype=np.float32)
    to_state, ones = weights[:HIDDEN].T, np.ones(width, dtype=np.float32)
    for a in range(0, n, BLOCK):
        rows = held[a : a + BLOCK]
        b = a + len(rows)
        exponents = rows @ weights
        flat = exponents.reshape(-1)
        at = np.arange(0, len(flat), width) + chosen[a:b]
        picked = flat[at]
        if large:
            top = exponents.max(axis=1)
            exponents -= top[:, None]
            picked -= top
        np.exp(exponents, out=exponents)
        total = exponents @ ones
        np.subtract(picked, np.log(total), out=logs[a:b])
        if grads is not None:
            # Probabilities less one for the chosen column, all times the row's sum.
            flat[at] -= total
            share = (1 / total)[:, None]
            grads += (rows * share).T @ exponents
            np.multiply(exponents @ to_state, share, out=back[a:b])
    return logs, back


def _predict(weights: Weights, out: np.ndarray, targets: np.ndarray, grads: Weights | None):
    """Natural logarithms of the targets' probabilities; with ``grads`` also the slopes, added up, and those of the states."""
    symbols = targets.ravel()
    # In the order of symbols, those of one class are neighbours, and vocabulary words come first.
    order = np.argsort(symbols.astype(np.int16), kind="stable")[int((symbols < 0).sum()) :]
    sym = symbols[order].astype(np.int64)
    cls = np.where(sym < HEAD, sym // CLASS_WORDS, sym - HEAD + CLASSES)
    # A last column of ones carries the biases.
    held = np.ones((len(order), HIDDEN + 1), dtype=np.float32)
    held[:, :HIDDEN] = out.transpose(0, 2, 1).reshape(-1, HIDDEN).take(order, axis=0)
    logp, back = _softmax(held, weights["to_class"], cls, _large(weights["to_class"]), None if grads is None else grads["to_class"])
    edges = np.searchsorted(cls, np.arange(CLASSES + 1))
    large = _large(weights["to_word"])
    for k in np.flatnonzero(np.diff(edges)):
        a, b = edges[k], edges[k + 1]
        word = sym[a:b] - k * CLASS_WORDS
        logs, more = _softmax(held[a:b], weights["to_word"][k], word, large[k], None if grads is None else grads["to_word"][k])
        logp[a:b] += logs
        if grads is not None:
            back[a:b] += more
    logs = np.zeros(len(symbols), dtype=np.float32)
    logs[order] = logp
    if grads is None:
        return logs, None
    slopes = np.zeros((len(symbols), HIDDEN), dtype=np.float32)
    slopes[order] = back
    return logs, np.ascontiguousarray(slopes.reshape(*targets.shape, HIDDEN).transpose(0, 2, 1))


def _go_back(weights: Weights, window: Window, kept, slopes: np.ndarray, grads: Weights) -> None:
    """Backpropagation through the window's steps; the slopes end where the window or a document starts."""
    before, gate, cand, shut = kept
    steps, lanes = window.inputs.shape
    to_given = np.empty((steps, 3 * HIDDEN, lanes), dtype=np.float32)
    gates, candidate = weights["gates"], weights["candidate"]
    to_gates, to_candidate = np.zeros_like(gates), np.zeros_like(candidate)
    anew, goes_on = window.starts.any(axis=1).tolist(), (~window.starts).astype(np.float32)
    later = np.zeros((HIDDEN, lanes), dtype=np.float32)
    part, rest = np.empty_like(later), np.empty((2 * HIDDEN, lanes), dtype=np.float32)
    for t in range(steps - 1, -1, -1):
        later += slopes[t]
        g, c, h = gate[t], cand[t], before[t]
        to_g, to_c = to_given[t, : 2 * HIDDEN], to_given[t, 2 * HIDDEN :]
        np.multiply(c, c, out=part)
        np.subtract(1, part, out=part)
        np.multiply(later, g[:HIDDEN], out=to_c)
        to_c *= part
        to_rh = candidate @ to_c
        np.subtract(c, h, out=part)
        np.multiply(later, part, out=to_g[:HIDDEN])
        np.multiply(to_rh, h, out=to_g[HIDDEN:])
        to_g *= g
        np.subtract(1, g, out=rest)
        to_g *= rest
        later *= rest[:HIDDEN]
        to_rh *= g[HIDDEN:]
        later += to_rh
        later += gates @ to_g
        if anew[t]:
            later *= goes_on[t]
        to_gates += h @ to_g.T
        to_candidate += shut[t] @ to_c.T
    grads["gates"] += to_gates
    grads["candidate"] += to_candidate
    symbols = window.inputs.ravel().astype(np.intp)
    sums = [np.bincount(symbols, to_given[:, unit].ravel(), HEAD + TAILS) for unit in range(3 * HIDDEN)]
    grads["embedding"] += np.array(sums, dtype=np.float32).T


def train(weights: Weights, docs: Iterable[np.ndarray], end: int, rate: float = RATE) -> tuple[Weights, int]:
    """One pass over the documents with Adam; the new weights and the number of tokens."""
    weights = {name: w.copy() for name, w in weights.items()}
    first = {name: np.zeros_like(w) for name, w in weights.items()}
    second = {name: np.zeros_like(w) for name, w in weights.items()}
    state, step, seen = np.zeros((0, HIDDEN), dtype=np.float32), 0, 0
    for window in in_lanes(long_first(docs, end, SEGMENT), TRAIN_LANES, TRAIN_STEPS):
        state = _carried(state, window)
        grads = {name: np.zeros_like(w) for name, w in weights.items()}
        out, state, kept = _run(weights, window, state, keep=True)
        n = int((window.targets >= 0).sum())
        _, slopes = _predict(weights, out, window.targets, grads)
        _go_back(weights, window, kept, slopes, grads)
        step, seen = step + 1, seen + n
        pace = rate * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
        for name, w in weights.items():
            g, m, v = grads[name], first[name], second[name]
            g /= n
            m *= 0.9
            m += 0.1 * g
            v *= 0.99
            g *= g
            g *= 0.01
            v += g
            np.sqrt(v, out=g)
            g += 1e-6
            np.divide(m, g, out=g)
            g *= pace
            w -= g
    return weights, seen


def _carried(state: np.ndarray, window: Window) -> np.ndarray:
    """The states of the window's lanes; a lane that is new starts a document, and from zero."""
    known = window.lanes < len(state)
    out = np.zeros((len(window.lanes), HIDDEN), dtype=np.float32)
    out[known] = state[window.lanes[known]]
    return out


def log_likelihoods(weights: Weights, docs: Iterable[np.ndarray], end: int) -> Iterator[tuple[int, float]]:
    """``number, natural log probability of its symbols`` of each document, as soon as it is through."""
    state = np.zeros((0, HIDDEN), dtype=np.float32)
    open_: dict[int, float] = {}
    for window in in_lanes(long_first(docs, end), SCORE_LANES, SCORE_STEPS):
        state = _carried(state, window)
        out, state, _ = _run(weights, window, state, keep=False)
        logs, _ = _predict(weights, out, window.targets, None)
        numbers, valid = window.docs.ravel(), window.targets.ravel() >= 0
        found, places = np.unique(numbers[valid], return_inverse=True)
        for number, value in zip(found.tolist(), np.bincount(places, weights=logs[valid]).tolist(), strict=True):
            open_[number] = open_.get(number, 0.0) + value
        going_on = set(window.docs[-1].tolist())
        for number in [x for x in open_ if x not in going_on]:
            yield number, open_.pop(number)
    yield from open_.items()


def _averaged(trained: DataFrame) -> np.ndarray | None:
    """The mean of ``weights``, doubles times tokens as bytes, over ``tokens``; summed up in tasks before the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, tokens = None, 0
        for batch in batches:
            for value, n in zip(batch.column("weights").to_pylist(), batch.column("tokens").to_pylist(), strict=True):
                values = np.frombuffer(value, dtype=np.float64)
                total = values.copy() if total is None else total + values
                tokens += n
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary()), pa.array([tokens], pa.int64())], names=["weights", "tokens"])

    rows = trained.repartition(SUMS).mapInArrow(add, "weights binary, tokens long").collect()
    if not rows:
        return None
    return sum(np.frombuffer(r["weights"], dtype=np.float64) for r in rows) / sum(r["tokens"] for r in rows)


def _flat(weights: Weights) -> np.ndarray:
    return np.concatenate([weights[name].ravel() for name in SHAPES])


def _shaped(flat: np.ndarray) -> Weights:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        out[name] = flat[at : at + size].reshape(shape).astype(np.float32)
        at += size
    return out


_ENCODED = (
    "row long, doc_id long, held_out boolean, round int, n_tokens long, n_known long, base double, model double, symbols binary, "
    "rare array<struct<token: binary, n: long>>"
)


def _encode(shared: Broadcast, denominator: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Arrow job over ``doc_id, held_out, round, text``: symbols, and scores but for the network and for rare tokens, which are listed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _lookup(shared)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            docs = batch.num_rows
            if not docs:
                continue
            words, before = words_of(batch.column("text"))
            coded = words.dictionary_encode()
            distinct = _with_end(coded.dictionary)
            # All texts' tokens in a row, as places among the distinct ones, of which the end is the last.
            ends = before[1:] + np.arange(1, docs + 1)
            starts = np.concatenate([[0], ends[:-1]])
            is_word = np.ones(ends[-1], dtype=bool)
            is_word[ends - 1] = False
            places = np.full(ends[-1], len(distinct) - 1)
            places[is_word] = coded.indices.to_numpy()
            ranks = lookup.ranks_of(distinct.to_numpy(zero_copy_only=False).tolist())[places]
            symbols = lookup.symbol_of[ranks].astype(SYMBOL)
            # Unknown tokens by text, each once with its number there.
            unknown = np.flatnonzero(ranks < 0)
            keys, n = np.unique(np.searchsorted(ends, unknown, side="right") * len(distinct) + places[unknown], return_counts=True)
            text, token = np.divmod(keys, len(distinct))
            entries = pa.StructArray.from_arrays([distinct.take(pa.array(token)), pa.array(n, pa.int64())], ["token", "n"])
            offsets = np.concatenate([[0], ends * SYMBOL.itemsize]).astype(np.int32)
            arrays = {
                "row": pa.array(np.arange(row, row + docs), pa.int64()),
                **{name: batch.column(name) for name in ("doc_id", "held_out", "round")},
                "n_tokens": pa.array(ends - starts, pa.int64()),
                "n_known": pa.array(np.add.reduceat(ranks >= 0, starts, dtype=np.int64)),
                "base": pa.array(np.add.reduceat(lookup.logs[ranks], starts) - (ends - starts) * np.log10(denominator)),
                "model": pa.array(np.add.reduceat(lookup.shares[ranks], starts)),
                "symbols": pa.Array.from_buffers(pa.binary(), docs, [None, pa.py_buffer(offsets), pa.py_buffer(symbols)]),
                "rare": pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(docs + 1)), pa.int32()), entries),
            }
            row += docs
            yield pa.RecordBatch.from_arrays(list(arrays.values()), names=list(arrays))

    return run


def _symbols(column: pa.Array) -> Iterator[np.ndarray]:
    return (np.frombuffer(value, dtype=SYMBOL) for value in column.to_pylist())


def train_rounds(encoded: DataFrame, vocabulary: Vocabulary, end: int, rounds: int = ROUNDS) -> Weights:
    """Train on the ``symbols`` of all rows that are not held out, each in its ``round``."""
    weights = first_weights(vocabulary)
    for number in range(rounds):
        given = weights

        def run(batches: Iterator[pa.RecordBatch], given: Weights = given) -> Iterator[pa.RecordBatch]:
            trained, tokens = train(given, (symbols for b in batches for symbols in _symbols(b.column(0))), end)
            if tokens:
                value = (_flat(trained).astype(np.float64) * tokens).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([value], pa.binary()), pa.array([tokens], pa.int64())], names=["weights", "tokens"])

        part = encoded.where(~F.col("held_out") & (F.col("round") == number)).select("symbols")
        flat = _averaged(part.mapInArrow(run, "weights binary, tokens long"))
        weights = weights if flat is None else _shaped(flat)
    return weights


_SCORED = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "model"]


def _score(weights: Weights, end: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Arrow job over the columns of ``_SCORED`` and ``symbols``: the network's score is added to ``model``."""
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, tuple] = {}
        done: deque[tuple] = deque()

        def read() -> Iterator[np.ndarray]:
            number = 0
            for batch in batches:
                columns = [batch.column(name).to_pylist() for name in _SCORED]
                for *values, symbols in zip(*columns, _symbols(batch.column("symbols")), strict=True):
                    waiting[number] = tuple(values)
                    number += 1
                    yield symbols

        def rows(least: int) -> Iterator[pa.RecordBatch]:
            while len(done) >= max(least, 1):
                part = [done.popleft() for _ in range(min(len(done), 2000))]
                arrays = [pa.array(c, k) for c, k in zip(zip(*part, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=_SCORED)

        for number, value in log_likelihoods(weights, read(), end):
            *head, model = waiting.pop(number)
            done.append((*head, model + value / np.log(10)))
            yield from rows(2000)
        yield from rows(1)

    return run


def likelihoods(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_token``.

    ``held_out`` is a condition on a column ``doc_id``; documents for which it holds are not learned from. Scores are
    log10 probabilities of whole texts with their ends: ``base_score`` of the smoothed unigram model, ``score`` of the
    network. A null or empty text is its end alone. Null ids are not held out; repeated rows are learned from and scored
    each. Without training documents every token is unknown. An empty table gives an empty result. Other columns are
    ignored.
    """
    spark = docs.sparkSession
    rows = id_and_text(docs, id_col, text_col)
    counts = saved(token_counts(rows.where(~held_out).select("text")), "lm-counts")
    vocabulary = read_vocabulary(counts)
    shared = spark.sparkContext.broadcast(vocabulary)
    end = Lookup.of(vocabulary).end
    # Equal texts are in one round.
    a_round = F.pmod(F.xxhash64(F.lit("round"), "text"), F.lit(rounds)).cast("int")
    given = rows.select("doc_id", held_out.alias("held_out"), a_round.alias("round"), "text")
    encoded = saved(given.mapInArrow(_encode(shared, vocabulary.denominator), _ENCODED), "lm-symbols")
    weights = train_rounds(encoded, vocabulary, end, rounds)
    kinds = encoded.select(*_SCORED).schema
    parts = saved(encoded.select(*_SCORED, "symbols").mapInArrow(_score(weights, end), kinds), "lm-parts")
    rare = encoded.select("row", F.explode("rare").alias("r")).select("row", F.col("r.token").alias("token"), F.col("r.n").alias("k"))
    met = rare.join(counts.select("token", "n"), "token", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    added = met.groupBy("row").agg(
        F.sum(F.col("k") * F.log10(F.col("n") + F.lit(0.1).cast("double"))).alias("logs"), F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(0)).alias("known")
    )
    joined = parts.join(added, "row", "left")
    logs = F.coalesce("logs", F.lit(0.0))
    score = F.col("model") + logs
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(vocabulary.total).cast("long").alias("train_tokens"),
        (F.col("base") + logs).alias("base_score"),
        score.alias("score"),
        (-score / F.col("n_tokens") * F.lit(float(np.log2(10)))).alias("bits_per_token"),
    )
