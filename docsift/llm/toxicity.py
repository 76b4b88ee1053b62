"""Toxicity by compression distance: which of two zstandard dictionaries compresses a text's windows better.

The ordinary dictionary is trained on chunks of ordinary labelled texts. The toxic one holds the same bytes and then the
segments that cover toxic labelled texts and not ordinary ones: word beginnings, chosen greedily, each worth the toxic
documents it is in, halved for every segment they already hold, less ``PRICE`` times the share of ordinary ones. In place of them
the ordinary dictionary repeats bytes of its own, so ordinary text costs nearly the same in both, and a window's gain is
what the toxic segments save.

A document's gains over all its windows are summed up in a few numbers, from which a logistic regression on labelled
documents gives the score, so that thresholds are probabilities. Fitting uses at most ``MAX_TOXIC`` and ``MAX_ORDINARY``
labelled documents; scoring reads every whole text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.llm.common import extended, saved, utf8
from docsift.llm.sampling import hash_sample

MAX_TOXIC = 3_000
MAX_ORDINARY = 4_000
THRESHOLD = 0.7
WINDOW_WORDS = 8
# A window without blanks is cut at this many bytes.
WINDOW_BYTES = 512
DICTIONARY_BYTES = 16 << 10
MAX_SEGMENTS = 1_000
PRICE = 6
SEGMENT_LETTERS = range(4, 11)
_CHUNK = 1024
_CHUNKS = 4

_WORD = regex.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def windows(text: bytes) -> list[bytes]:
    """The lower-cased text in runs of words, each after a blank; one empty window for an empty text."""
    words = text.lower().split()
    out = []
    for i in range(0, max(1, len(words)), WINDOW_WORDS):
        window = b" " + b" ".join(words[i : i + WINDOW_WORDS])
        out += [window] if len(window) <= WINDOW_BYTES else [window[a : a + WINDOW_BYTES] for a in range(0, len(window), WINDOW_BYTES)]
    return out


def segments(text: bytes) -> set[str]:
    """The beginnings of the text's words, as long as ``SEGMENT_LETTERS`` says."""
    out: set[str] = set()
    for word in set(_WORD.findall(text.lower())):
        letters = word.decode("utf-8", "replace")
        out.update(letters[:n] for n in SEGMENT_LETTERS if n <= len(letters))
    return out


def choose_segments(toxic: list[set[int]], ordinary: list[set[int]], names: list[str]) -> list[str]:
    """The greedy cover: ``toxic`` and ``ordinary`` hold each document's segments by their place in ``names``."""
    held_t: list[list[int]] = [[] for _ in names]
    held_o = np.zeros(len(names))
    for doc, found in enumerate(toxic):
        for s in found:
            held_t[s].append(doc)
    for found in ordinary:
        for s in found:
            held_o[s] += 1
    weight = np.ones(len(toxic))
    cost = PRICE * held_o / max(1, len(ordinary))
    open_ = set(range(len(names)))
    chosen: list[str] = []
    while open_:
        worth, _, best = max((weight[held_t[s]].sum() / max(1, len(toxic)) - cost[s], len(names[s]), names[s]) for s in open_)
        if worth < 0.01:
            break
        chosen.append(best)
        weight[held_t[names.index(best)]] *= 0.5
        open_ = {s for s in open_ if not names[s].startswith(best) and not best.startswith(names[s])}
    return chosen


@dataclass
class Dictionaries:
    toxic: bytes
    ordinary: bytes

    def gains(self, text: bytes) -> np.ndarray:
        """Bytes that the toxic dictionary saves over the ordinary one, per window."""
        toxic, ordinary = _compressor(self.toxic).compress, _compressor(self.ordinary).compress
        return np.array([len(ordinary(w)) - len(toxic(w)) for w in windows(text)], dtype=np.float32)


_COMPRESSORS: dict[bytes, zstandard.ZstdCompressor] = {}


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    if content not in _COMPRESSORS:
        params = zstandard.ZstdCompressionParameters.from_level(
            3, strategy=zstandard.STRATEGY_FAST, min_match=5, window_log=15, hash_log=16, write_content_size=0, write_checksum=0, write_dict_id=0
        )
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        _COMPRESSORS[content] = zstandard.ZstdCompressor(dict_data=held, compression_params=params)
    return _COMPRESSORS[content]


def summary(gains: np.ndarray) -> np.ndarray:
    """What a document's gains come to: the best four, their sum, and how many are large."""
    best = np.concatenate([np.sort(gains)[::-1][:4], np.zeros(4)])[:4]
    n = len(gains)
    return np.array(
        [*best, np.log(n), gains.clip(0).sum() / n**0.5, (gains >= 2).mean(), np.log1p((gains >= 3).sum()), np.log1p((gains >= 5).sum())], dtype=np.float32
    )


@dataclass
class Model:
    dictionaries: Dictionaries
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def score(self, gains: np.ndarray) -> float:
        x = np.append((summary(gains) - self.mean) / self.scale, 1.0)
        return float(1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30))))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ridge logistic regression by Newton steps: mean, scale and weights, the constant last."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.c_[(x - mean) / scale, np.ones(len(x))].astype(np.float64)
    w, ridge = np.zeros(z.shape[1]), np.r_[np.full(z.shape[1] - 1, 0.1), 1e-3]
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge), z.T @ (p - y) + ridge * w)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return mean, scale, w


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for toxic, text in zip(batch.column("toxic").to_pylist(), utf8(batch.column("text")), strict=True):
            counts[toxic].update(segments(text))
    for toxic, found in enumerate(counts):
        names = list(found)
        for at in range(0, len(names), 50_000):
            part = names[at : at + 50_000]
            columns = [pa.array(part, pa.string()), pa.array([toxic] * len(part), pa.int32()), pa.array([found[s] for s in part], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["segment", "toxic", "n"])


def _candidates(sample: DataFrame, n_toxic: int, n_ordinary: int) -> list[str]:
    """The segments that toxic documents surely hold more often than ordinary ones, at most ``MAX_SEGMENTS``."""
    counts = sample.mapInArrow(_counted, "segment string, toxic int, n long").groupBy("segment").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("b")
    )
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    sure = F.log((a / (n_toxic + 1)) / (b / (n_ordinary + 1))) - 3 * F.sqrt(1 / a + 1 / b)
    kept = counts.where(F.col("a") >= max(2, 0.01 * n_toxic)).where(sure > 0.3).orderBy(F.desc(sure), "segment").limit(MAX_SEGMENTS)
    return sorted(row.segment for row in kept.select("segment").collect())


def _described(names: list[str]):
    """Arrow job: per labelled document which of the segments it holds, and some chunks of an ordinary one."""
    place = {s: i for i, s in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, found, chunks = batch.column("toxic").to_pylist(), [], []
            for is_toxic, text in zip(toxic, utf8(batch.column("text")), strict=True):
                found.append(sorted(place[s] for s in segments(text) if s in place))
                starts = range(0, max(1, len(text) - _CHUNK), max(_CHUNK, len(text) // _CHUNKS))
                chunks.append([] if is_toxic else [text[s : s + _CHUNK].lower() for s in starts][:_CHUNKS])
            columns = [pa.array(toxic, pa.int32()), pa.array(found, pa.list_(pa.int32())), pa.array(chunks, pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, names=["toxic", "found", "chunks"])

    return run


def train_dictionaries(toxic: list[set[int]], ordinary: list[set[int]], names: list[str], chunks: list[bytes]) -> Dictionaries:
    try:
        base = zstandard.train_dictionary(DICTIONARY_BYTES, chunks).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on
        base = b"".join(chunks)[:DICTIONARY_BYTES] or b" " * 64
    own = "".join(" " + s for s in sorted(choose_segments(toxic, ordinary, names))).encode()
    return Dictionaries(base + own, base + (base * (len(own) // len(base) + 1))[: len(own)])


def learn(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model | None:
    """Fit on labelled documents for whose id, ``_id``, ``usable`` holds; none without both kinds of labels.

    An id with several labels is toxic if one of them says so.
    """
    marked = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("toxic")).where("toxic in (0, 1)").where(usable)
    marked = marked.groupBy("_id").agg(F.max("toxic").alias("toxic"))
    chosen = hash_sample(marked.where("toxic = 1"), F.col("_id"), MAX_TOXIC, "toxic").unionByName(
        hash_sample(marked.where("toxic = 0"), F.col("_id"), MAX_ORDINARY, "ordinary")
    )
    rows = docs.select(docs[id_col].cast("long").alias("_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    # At most MAX_TOXIC + MAX_ORDINARY and a tenth ids.
    sample = saved(rows.join(F.broadcast(chosen), "_id").select("_id", "toxic", "text"), "toxicity-sample")
    n = {row.toxic: row.n for row in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return None
    names = _candidates(sample.select("toxic", "text"), n[1], n[0])
    described = sample.select("toxic", "text").mapInArrow(_described(names), "toxic int, found array<int>, chunks array<binary>").toArrow().to_pylist()
    sets = [[set(d["found"]) for d in described if d["toxic"] == kind] for kind in (1, 0)]
    chunks = sorted(c for d in described for c in d["chunks"] if c)
    dictionaries = train_dictionaries(sets[0], sets[1], names, chunks)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [summary(dictionaries.gains(t)).tobytes() for t in utf8(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(x, pa.binary())], names=["toxic", "x"])

    fitted = sample.select("toxic", "text").mapInArrow(summed, "toxic int, x binary").toArrow().to_pylist()
    fitted.sort(key=lambda r: (r["toxic"], r["x"]))
    x = np.array([np.frombuffer(r["x"], dtype=np.float32) for r in fitted], dtype=np.float64)
    # The sample may hold a larger share of toxic documents than there are; each kind has the weight of its labels.
    total = {row.toxic: row.n for row in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    mean, scale, weights = _logistic(x, np.array([r["toxic"] for r in fitted], dtype=np.float64))
    weights[-1] += np.log(total[1] / total[0]) - np.log(n[1] / n[0])
    return Model(dictionaries, mean, scale, weights)


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    held_out: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted, n_windows, best_gain``.

    ``held_out`` is a condition on a column ``_id``; labels for which it holds are not learned from. A null text counts
    as empty, with one empty window; empty texts all have one score. Null ids match no label and are not held out.
    Repeated rows are scored each. Without usable labels of both kinds, or in an empty table, scores are zero. Other
    columns are ignored.
    """
    model = learn(docs, labels, ~held_out, id_col, text_col, label_col)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[float, int, float]] = []
            for text in utf8(batch.column("_text")):
                if model is None:
                    found.append((0.0, len(windows(text)), 0.0))
                    continue
                gains = model.dictionaries.gains(text)
                found.append((model.score(gains), len(gains), float(gains.max())))
            columns = zip(*found, strict=True) if found else ((), (), ())
            arrays = [pa.array(c, k) for c, k in zip(columns, (pa.float64(), pa.int64(), pa.float64()), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=["doc_id", "score", "n_windows", "best_gain"])

    schema = extended(rows.select("doc_id").schema, score=T.DoubleType(), n_windows=T.LongType(), best_gain=T.DoubleType())
    scored = rows.mapInArrow(run, schema).withColumn("_id", F.col("doc_id"))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "n_windows", "best_gain")
