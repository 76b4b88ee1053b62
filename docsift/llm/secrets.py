"""Secret scans: fixed rules, and a character convolutional network over every other candidate and its context.

The rules' findings are the labels the network learns from: a candidate that overlaps one is a secret. A candidate is a
long run of the characters that keys are written in, with a digit in it; its window holds it and the characters around it,
and context is blanked in half of the training examples, so that the run itself must tell. Scores are calibrated on
findings kept back from training, and the threshold is the largest that still finds ``RECALL`` of them.

Every different candidate of all documents is an example: three quarters are trained on, a quarter is kept back. Training
goes in rounds. In a round each task passes over its share from the weights all tasks have in common, and the weights are
averaged by the shares' sizes. Scores of what is kept back are a table, over which the calibration's sums are taken and the
threshold is found by rank. Only weights, sums and counts come to the driver. Scanning reads every whole text and judges
every candidate, long ones in overlapping windows.
"""

from __future__ import annotations

import copy
import hashlib
import math
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from itertools import accumulate, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.llm.common import globally_ranked, id_and_text, saved, utf8

# Examples of a task's share, and the most shares there are; beyond that, shares grow.
SHARE, MOST_SHARES = 8_192, 64
# Passes over the examples: more over few, fewer over very many, never less than one.
PASSES, LEAST_SEEN, MOST_SEEN = 12, 3_000, 2_000_000
RECALL = 0.98
KINDS = ("assign", "access", "hex", "model")

# The rules.
_ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ASSIGN_NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
_DIGIT = re.compile(r"[0-9]")
_ONLY_HEX = bytes(120 if chr(b) in "0123456789abcdef" else 32 for b in range(256))

INSIDE, AROUND = 64, 20
WIDTH = INSIDE + 2 * AROUND
STRIDE = INSIDE // 2
# Character codes: ASCII itself, all others one code, and one for no character.
OTHER, NONE, CODES = 128, 129, 130
CHANNELS, FILTERS, SPAN = 6, 16, 5

Span = tuple[int, int, str]


def rule_spans(text: str, raw: bytes) -> list[Span]:
    """The base rules' spans, leftmost and not overlapping within a kind; ``raw`` is the text in UTF-8."""
    found: list[Span] = []
    small = raw.lower()
    if any(name in small for name in _ASSIGN_NAMES):
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if b"AKIA" in raw:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    if b"x" * LEAST_HEX in raw.translate(_ONLY_HEX):
        found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text) if len(m[0]) >= LEAST_HEX]
    return found


def candidates(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _CANDIDATE.finditer(text) if _DIGIT.search(text, m.start(), m.end())]


def in_windows(text: str, start: int, end: int) -> Iterator[np.ndarray]:
    """The candidate and its surroundings as rows of character codes, one for each place of a window in it."""
    for at in range(start, max(start + 1, end - STRIDE), STRIDE):
        stop = min(at + INSIDE, end)
        codes = np.full(WIDTH, NONE, dtype=np.int64)
        for place, piece in ((AROUND, text[at:stop]), (AROUND + INSIDE, text[stop : stop + AROUND])):
            codes[place : place + len(piece)] = [min(ord(c), OTHER) for c in piece]
        before = text[max(0, at - AROUND) : at]
        codes[AROUND - len(before) : AROUND] = [min(ord(c), OTHER) for c in before]
        yield codes


def _blank(windows: np.ndarray) -> np.ndarray:
    blanked = windows.copy()
    blanked[:, :AROUND] = NONE
    blanked[:, AROUND + INSIDE :] = NONE
    return blanked


@dataclass
class Network:
    """Embedding, one convolution with ReLU, the maxima within and around the candidate, and a logistic unit."""

    embedding: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    threshold: float = 0.5
    slope: float = 1.0
    shift: float = 0.0
    # How many examples it was trained on, and how many it was calibrated on.
    trained: int = 0
    calibrated: int = 0

    @property
    def tensors(self) -> list[np.ndarray]:
        return [self.embedding, self.filters, self.bias, self.out]

    @classmethod
    def random(cls, rng: np.random.Generator) -> Network:
        def draw(*shape: int, scale: float) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        return cls(draw(CODES, CHANNELS, scale=0.5), draw(SPAN * CHANNELS, FILTERS, scale=0.2), draw(FILTERS, scale=0.01), draw(2 * FILTERS + 1, scale=0.1))

    def forward(self, windows: np.ndarray):
        """Logits, and what the way back needs."""
        held = self.embedding[windows]
        n, steps = len(windows), WIDTH - SPAN + 1
        views = np.lib.stride_tricks.sliding_window_view(held, SPAN, axis=1)  # n, steps, channels, span
        columns = views.transpose(0, 1, 3, 2).reshape(n * steps, SPAN * CHANNELS)
        active = np.maximum(columns @ self.filters + self.bias, 0).reshape(n, steps, FILTERS)
        inside = slice(AROUND - SPAN // 2, AROUND + INSIDE - SPAN // 2)
        outer = active.copy()
        outer[:, inside] = 0
        tops = active[:, inside].argmax(axis=1) + inside.start, outer.argmax(axis=1)
        pooled = np.concatenate([np.take_along_axis(a, t[:, None], axis=1)[:, 0] for a, t in zip((active, outer), tops, strict=True)], axis=1)
        return pooled @ self.out[:-1] + self.out[-1], (columns, pooled, tops)

    def logits(self, windows: np.ndarray) -> np.ndarray:
        return np.concatenate([self.forward(windows[i : i + 256])[0] for i in range(0, len(windows), 256)])

    def scaled(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logits + self.shift, -30, 30)))

    def probability(self, windows: np.ndarray) -> np.ndarray:
        return self.scaled(self.logits(windows))

    def gradients(self, windows: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
        logits, (columns, pooled, tops) = self.forward(windows)
        n, steps = len(windows), WIDTH - SPAN + 1
        slope = ((1 / (1 + np.exp(-np.clip(logits, -30, 30))) - labels) * weights / n).astype(np.float32)
        back = np.zeros((n, steps, FILTERS), dtype=np.float32)
        to_pool = slope[:, None] * self.out[:-1] * (pooled > 0)
        rows, filters = np.arange(n)[:, None], np.arange(FILTERS)[None]
        for k, top in enumerate(tops):
            np.add.at(back, (rows, top, filters), to_pool[:, k * FILTERS : (k + 1) * FILTERS])
        back = back.reshape(n * steps, FILTERS)
        to_columns = (back @ self.filters.T).reshape(n, steps, SPAN, CHANNELS)
        to_held = np.zeros((n, WIDTH, CHANNELS), dtype=np.float32)
        for k in range(SPAN):
            to_held[:, k : k + steps] += to_columns[:, :, k]
        to_embedding = np.zeros_like(self.embedding)
        np.add.at(to_embedding, windows.ravel(), to_held.reshape(-1, CHANNELS))
        return [to_embedding, columns.T @ back, back.sum(axis=0), np.append(pooled.T @ slope, slope.sum())]


@dataclass
class Fitting:
    """A network in training: its weights, Adam's moments, and the steps made."""

    net: Network
    first: list[np.ndarray] = field(default_factory=list)
    second: list[np.ndarray] = field(default_factory=list)
    step: int = 0

    def __post_init__(self):
        self.first = self.first or [np.zeros_like(w) for w in self.net.tensors]
        self.second = self.second or [np.zeros_like(w) for w in self.net.tensors]

    def passes(self, x: np.ndarray, y: np.ndarray, weights: np.ndarray, n: int, rng: np.random.Generator) -> None:
        """Pass over the windows ``n`` times, in batches of 64."""
        for _ in range(n):
            for part in np.array_split(rng.permutation(len(y)), max(1, len(y) // 64)):
                batch = x[part].astype(np.int64)
                blank = rng.random(len(part)) < 0.5
                batch = np.where(blank[:, None], _blank(batch), batch)
                self.step += 1
                gradients = self.net.gradients(batch, y[part], weights[part])
                for w, g, m, v in zip(self.net.tensors, gradients, self.first, self.second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= 0.004 * (m / (1 - 0.9**self.step)) / (np.sqrt(v / (1 - 0.999**self.step)) + 1e-8)

    def packed(self) -> bytes:
        return np.concatenate([t.ravel() for t in (*self.net.tensors, *self.first, *self.second)]).astype("<f4").tobytes()

    def unpack(self, values: np.ndarray) -> None:
        at = 0
        for t in (*self.net.tensors, *self.first, *self.second):
            t[...] = values[at : at + t.size].reshape(t.shape)
            at += t.size


def class_weights(labels: np.ndarray, share: float) -> np.ndarray:
    """Weights that give both kinds the same sum; ``share`` is that of the positives."""
    return np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)


def train(windows: Sequence[np.ndarray], labels: np.ndarray, epochs: int = PASSES, seed: int = 4) -> Network | None:
    """Train, calibrate and set the threshold on examples at hand; none unless there are a few of both kinds.

    An example has one window or more (a window alone may be a row). It is trained on by its first window, and judged,
    as in use, by its highest. ``learn`` does the same with the examples of a table, in Spark.
    """
    windows = [w.reshape(-1, WIDTH) for w in windows]
    if min(labels.sum(), (1 - labels).sum()) < 4:
        return None
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(labels))
    windows, labels = [windows[i] for i in order], labels[order].astype(np.float32)
    kept_back = np.arange(len(labels)) % 4 == 0
    x, y = np.array([w[0] for w, kept in zip(windows, kept_back, strict=True) if not kept]).reshape(-1, WIDTH), labels[~kept_back]
    if not 0 < y.sum() < len(y) or not 0 < labels[kept_back].sum() < kept_back.sum():
        return None
    fitting = Fitting(Network.random(rng))
    fitting.passes(x, y, class_weights(y, float(y.mean())), max(epochs, LEAST_SEEN // len(y)), rng)
    _calibrate(fitting.net, [w for w, kept in zip(windows, kept_back, strict=True) if kept], labels[kept_back])
    return fitting.net


def _calibrate(net: Network, windows: list[np.ndarray], labels: np.ndarray) -> None:
    """Platt scaling by Newton steps, then the largest threshold that finds ``RECALL`` of the positives.

    A candidate's logit is the highest of its windows, as when candidates are judged.
    """
    starts = np.cumsum([0, *(len(w) for w in windows)])[:-1]
    logits = np.maximum.reduceat(net.logits(np.concatenate(windows)).astype(np.float64), starts)

    def sums(slope: float, shift: float, high: float, low: float) -> tuple[float, ...]:
        z, target = slope * logits + shift, np.where(labels == 1, high, low)
        q = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        bend, off = q * (1 - q), q - target
        loss = np.logaddexp(0, z) - target * z
        return (bend * logits * logits).sum(), (bend * logits).sum(), bend.sum(), (off * logits).sum(), off.sum(), loss.sum()

    net.slope, net.shift = _platt(sums, int((labels == 1).sum()), int((labels == 0).sum()))
    found = np.sort(logits[labels == 1])
    net.threshold = _threshold(net, float(found[_rank(net, len(found))]))


def _platt(sums: Callable[..., tuple[float, ...]], positives: int, negatives: int) -> tuple[float, float]:
    """Slope and shift by Newton steps, halved while the loss rises.

    ``sums`` takes both and the targets of either kind, and returns the sums of bends, of slopes, and of the loss.
    """
    # Targets short of 0 and 1, as Platt has them, keep the slope finite where the kinds are far apart.
    high, low = (positives + 1) / (positives + 2), 1 / (negatives + 2)
    w = np.array([0.0, math.log((positives + 1) / (negatives + 1))])
    xx, x1, one, gx, g1, loss = sums(*w.tolist(), high, low)
    for _ in range(30):
        step, share = np.linalg.solve(np.array([[xx, x1], [x1, one]]) + 1e-9 * np.eye(2), np.array([gx, g1])), 1.0
        while share > 1e-6:
            tried = sums(*(w - share * step).tolist(), high, low)
            if tried[-1] <= loss:
                break
            share /= 2
        else:
            break
        gained, w = loss - tried[-1], w - share * step
        xx, x1, one, gx, g1, loss = tried
        if gained <= 1e-7 * loss:
            break
    # Sums of many tasks differ in their last digits from run to run.
    return float(f"{w[0]:.6g}"), float(f"{w[1]:.6g}")


def _rank(net: Network, positives: int) -> int:
    """The place, from 0 by rising logit, of the positive whose probability is the threshold."""
    missed = int(math.floor((1 - RECALL) * positives))
    return missed if net.slope >= 0 else positives - 1 - missed


def _threshold(net: Network, logit: float) -> float:
    return float(net.scaled(np.array([logit], dtype=np.float32))[0])


class _Cover:
    """Whether spans overlap some of others, each in the time of a search."""

    def __init__(self, spans: list[Span]):
        ordered = sorted(spans)
        self.starts = [start for start, _, _ in ordered]
        self.reach = list(accumulate((end for _, end, _ in ordered), max))

    def overlaps(self, span: tuple[int, int]) -> bool:
        before = bisect_left(self.starts, span[1])
        return before > 0 and self.reach[before - 1] > span[0]


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per window of each candidate: the candidate's label and a hash of it and its surroundings, the window's number."""
    types = {"label": pa.int32(), "key": pa.binary(), "at": pa.int64(), "window": pa.binary()}

    def cut(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(types)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values(), strict=True)], names=list(types))

    for batch in batches:
        rows = []
        for raw in utf8(batch.column(0)):
            text = raw.decode("utf-8", "replace")
            cover = _Cover(rule_spans(text, raw))
            for span in candidates(text):
                near = text[max(0, span[0] - AROUND) : span[1] + AROUND]
                label, key = int(cover.overlaps(span)), hashlib.md5(f"{min(span[0], AROUND)} {near}".encode()).digest()
                for at, window in enumerate(in_windows(text, *span)):
                    rows.append((label, key, at, window.astype(np.uint8).tobytes()))
                    if len(rows) == 1 << 15:
                        yield cut(rows)
                        rows = []
        yield cut(rows)


def _fit(state: Fitting, passes: int, positive: float, seed: int) -> Callable[[pa.Table], pa.Table]:
    """Gives the weights after passes over a share, from those of the state, and the share's size."""

    def fit(share: pa.Table) -> pa.Table:
        mine, number = copy.deepcopy(state), share.column("share")[0].as_py()
        share = share.sort_by([("key", "ascending"), ("label", "ascending")])
        x = np.frombuffer(b"".join(share.column("window").to_pylist()), dtype=np.uint8).reshape(-1, WIDTH)
        y = share.column("label").to_numpy().astype(np.float32)
        mine.passes(x, y, class_weights(y, positive), passes, np.random.default_rng([seed, number]))
        return pa.table({"share": [number], "n": [len(y)], "step": [mine.step], "weights": [mine.packed()]})

    return fit


def _trained(examples: DataFrame, n: int, positive: float, seed: int) -> Network:
    """Rounds of training on all of the examples; ``positive`` is the positives' share."""
    shares = min(math.ceil(n / SHARE), MOST_SHARES)
    passes = max(1, min(max(PASSES, LEAST_SEEN // n), MOST_SEEN // n))
    # A single share has nothing to average, so its passes are one round.
    rounds, each = (1, passes) if shares == 1 else (passes, 1)
    dealt = examples.withColumn("share", F.pmod(F.xxhash64("key"), F.lit(shares)))
    state = Fitting(Network.random(np.random.default_rng(seed)))
    for number in range(rounds):
        found = dealt.groupBy("share").applyInArrow(_fit(state, each, positive, seed + number), "share long, n long, step long, weights binary")
        rows = sorted(found.toArrow().to_pylist(), key=lambda r: r["share"])
        total = sum(r["n"] for r in rows)
        state = copy.deepcopy(state)
        state.unpack(sum(np.frombuffer(r["weights"], dtype="<f4").astype(np.float64) * (r["n"] / total) for r in rows))
        state.step = round(sum(r["step"] * r["n"] for r in rows) / total)
    state.net.trained = n
    return state.net


def _calibrated(examples: DataFrame, net: Network) -> Network:
    """The network with slope, shift and threshold from all windows of the examples kept back."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            windows = np.frombuffer(b"".join(batch.column("window").to_pylist()), dtype=np.uint8).reshape(-1, WIDTH)
            logits = [net.logits(windows[i : i + 256].astype(np.int64)) for i in range(0, len(windows), 256)]
            found = pa.array(np.concatenate(logits).astype(np.float64))
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("key"), found], names=["label", "key", "logit"])

    judged = examples.select("label", "key", "window").mapInArrow(judge, "label int, key binary, logit double")
    judged = saved(judged.groupBy("label", "key").agg(F.max("logit").alias("logit")).select("label", "logit"), "secrets-logits")
    counts = {r["label"]: r["n"] for r in judged.groupBy("label").agg(F.count("*").alias("n")).collect()}
    x = F.col("logit")

    def sums(slope: float, shift: float, high: float, low: float) -> tuple[float, ...]:
        z, target = x * slope + shift, F.when(F.col("label") == 1, high).otherwise(low)
        q = 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))
        loss = F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z))) - target * z
        rows = judged.select(x, (q * (1 - q)).alias("bend"), (q - target).alias("off"), loss.alias("loss"))
        bend, off = F.col("bend"), F.col("off")
        return tuple(rows.agg(F.sum(bend * x * x), F.sum(bend * x), F.sum(bend), F.sum(off * x), F.sum(off), F.sum("loss")).first())

    net.slope, net.shift = _platt(sums, counts[1], counts[0])
    ranked = globally_ranked(judged.where("label = 1"), [x], "rank", "secrets-ranked")
    net.threshold = _threshold(net, ranked.where(F.col("rank") == _rank(net, counts[1])).first()["logit"])
    net.calibrated = counts[0] + counts[1]
    return net


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 4) -> Network | None:
    """The network, trained and calibrated on every different candidate of all documents, as the rules have labelled them.

    None unless there are some examples of both kinds, both to train on and to keep back.
    """
    texts = id_and_text(docs, id_col, text_col).select("text")
    examples = saved(texts.mapInArrow(_examples, "label int, key binary, at long, window binary").distinct(), "secrets-examples")
    back = F.pmod(F.xxhash64(F.lit("back"), "key"), F.lit(4)) == 0
    found = examples.where("at = 0").groupBy("label", back.alias("back")).agg(F.count("*").alias("n")).collect()
    counts = {(r["label"], r["back"]): r["n"] for r in found}
    sizes = [counts.get(kind, 0) for kind in ((0, False), (0, True), (1, False), (1, True))]
    if min(sizes) == 0 or min(sizes[0] + sizes[1], sizes[2] + sizes[3]) < 4:
        return None
    n = sizes[0] + sizes[2]
    net = _trained(examples.where(~back & (F.col("at") == 0)).select("label", "key", "window"), n, sizes[2] / n, seed)
    return _calibrated(examples.where(back), net)


def find_secrets(text: str, raw: bytes, net: Network | None) -> list[tuple[int, int, str, float]]:
    """All spans as ``start, end, kind, probability``, by start and then kind; rules' findings have probability 1."""
    spans = rule_spans(text, raw)
    out = [(*span, 1.0) for span in spans]
    if net is not None:
        cover = _Cover(spans)
        rest = [c for c in candidates(text) if not cover.overlaps(c)]
        best = np.zeros(len(rest))
        views = ((i, w) for i, span in enumerate(rest) for w in in_windows(text, *span))
        while block := list(islice(views, 256)):
            np.maximum.at(best, [i for i, _ in block], net.probability(np.array([w for _, w in block])))
        out += [(*span, "model", float(p)) for span, p in zip(rest, best, strict=True) if p >= net.threshold]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id`` and ``spans``, an array of ``kind, start, end, probability, value``.

    Places are code points, ends exclusive. A null or empty text has no span. Ids may be null or repeated; rows are
    scanned each. Without findings to learn from, as in an empty table, only the rules are applied. Other columns are
    ignored.
    """
    net = learn(docs, id_col, text_col)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64()), ("value", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for raw in utf8(batch.column(1)):
                text = raw.decode("utf-8", "replace")
                found.append(
                    [{"kind": k, "start": a, "end": b, "probability": p, "value": text[a:b]} for a, b, k, p in find_secrets(text, raw, net)]
                )
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], names=["doc_id", "spans"])

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, spans array<struct<kind: string, start: long, end: long, probability: double, value: string>>"
    )
