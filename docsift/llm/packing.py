"""Packing documents into sequences of tokens by bulk-synchronous best fit.

Texts become token ids once, cut into pieces where they are longer than a sequence. Then rounds follow. Pieces and open
gaps are sorted by range, so that each has a rank within its size. A sweep from the longest pieces to the shortest gives
each size of piece the smallest gaps that hold it. Pieces that want the same gap are told apart by rank: the gaps of one
size, in order of rank, take the pieces of one size, in order of rank, each gap as many as fit. Gaps are then updated and
the next round begins, until every piece has its place.

The sweep sees only how many pieces and gaps there are of each size, at most as many numbers as a sequence has tokens;
pieces and gaps themselves stay in tables, are sorted, matched and moved by ranks, and never meet in one task.
"""

from __future__ import annotations

import bisect
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.llm.common import globally_ranked, id_and_text, saved, utf8

CAPACITY = 2048
END_ID = 0
# Chunks of text whose ids a worker remembers, in two generations.
REMEMBERED_CHUNKS = 300_000

# A word of Latin letters and the ASCII punctuation after it, neither of them with an apostrophe: two tokens' worth of text.
_WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 itself, else one from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


_BYTE_LETTERS = _byte_letters()


class ChunkIds(dict):
    """The ids of chunks between blanks, as little-endian bytes, by their UTF-8.

    The vocabulary's tokenizer drops white space and never joins over it, so a text's ids are those of its chunks.
    """

    def __init__(self, path: str, limit: int = REMEMBERED_CHUNKS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model.tokenize
        self.limit = limit
        self.words: dict[str, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.older_words: dict[str, bytes] = {}

    def of(self, text: bytes) -> bytes:
        if len(self) > self.limit:
            self.older = dict(self)
            self.clear()
        if len(self.words) > self.limit:
            self.older_words, self.words = self.words, {}
        if b"\xcc" not in text and b"\xcd" not in text and b"<|" not in text:
            # Safe before the tokenizer's own steps without the combining marks that compose with letters of ASCII, some
            # with small ones only (U+0300 to U+036F, whose UTF-8 begins with one of these bytes), and without the
            # vocabulary's special names.
            text = text.lower()
        return b"".join(map(self.__getitem__, text.replace(b"\n", b" ").split(b" ")))

    def __missing__(self, chunk: bytes) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            text = chunk.decode("utf-8", "replace")
            word = _WORD.fullmatch(text)
            ids = self._word(word[1].lower()) + (self._word(word[2]) if word[2] else b"") if word else self._encoded(text)
        self[chunk] = ids
        return ids

    def _word(self, word: str) -> bytes:
        """The ids of a text that the tokenizer takes as it is and as one piece: only its merges are to be found."""
        ids = self.words.get(word)
        if ids is None:
            ids = self.older_words.get(word)
            if ids is None:
                ids = b"".join(t.id.to_bytes(4, "little") for t in self.merges(word.encode().decode("latin-1").translate(_BYTE_LETTERS)))
            self.words[word] = ids
        return ids

    def _encoded(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


_TOKENIZERS: dict[str, ChunkIds] = {}

_PIECES = "row long, doc_id long, piece int, start long, length int, ids binary, ids_crc32 long"


def tokenized_pieces(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """A row per piece of a document: ``row`` (unique), ``doc_id, piece, start, length, ids, ids_crc32``.

    ``ids`` are little-endian unsigned 32-bit numbers. A document is its text's ids and one end id, so a null or empty
    text is one piece of one token.
    """
    end = np.array([END_ID], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _TOKENIZERS:
            _TOKENIZERS[vocabulary] = ChunkIds(vocabulary)
        ids_of = _TOKENIZERS[vocabulary].of
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                ids = ids_of(text) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((row, doc_id, piece, at // 4, len(part) // 4, part, zlib.crc32(part)))
                    row += 1
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int64()]
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
            names = ["row", "doc_id", "piece", "start", "length", "ids", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, _PIECES)


@dataclass
class Fill:
    """``count`` gaps of one size each take ``each`` pieces of one length."""

    length: int
    gap: int
    count: int
    each: int


def _best_fit(lengths: list[int], left: dict[int, int], pool: dict[int, int], reuse: bool) -> Iterator[Fill]:
    """Give the pieces left of each length, longest first, the smallest gaps of the pool that hold them.

    With ``reuse`` what is left of a gap goes back to the pool at once.
    """
    live = sorted(g for g, n in pool.items() if n)
    for length in lengths:
        while left[length]:
            at = bisect.bisect_left(live, length)
            if at == len(live):
                break
            gap = live[at]
            each = gap // length
            count = min(pool[gap], left[length] // each)
            if not count:
                count, each = 1, left[length]
            yield Fill(length, gap, count, each)
            left[length] -= count * each
            pool[gap] -= count
            if not pool[gap]:
                live.pop(at)
            rest = gap - length * each
            if reuse and rest:
                if not pool.get(rest):
                    bisect.insort(live, rest)
                pool[rest] = pool.get(rest, 0) + count


def sweep(left: dict[int, int], gaps: dict[int, int], capacity: int) -> tuple[list[Fill], list[Fill], dict[int, int]]:
    """One round over the numbers of pieces and gaps by size: fills of open gaps, new sequences, and the gaps after it.

    ``left`` is reduced by what the round places. Pieces that neither an open gap now nor what will be left of the gaps
    in later rounds can hold open new sequences; the others wait for the next round.
    """
    lengths = sorted((length for length, n in left.items() if n), reverse=True)
    after: dict[int, int] = {}
    fills = list(_best_fit(lengths, left, gaps, reuse=False))
    for gap, n in gaps.items():
        after[gap] = after.get(gap, 0) + n
    for fill in fills:
        rest = fill.gap - fill.length * fill.each
        after[rest] = after.get(rest, 0) + fill.count
    later, waiting, opened = {g: n for g, n in after.items() if g}, dict(left), []
    for length in lengths:
        for _ in _best_fit([length], waiting, later, reuse=True):
            pass
        each = capacity // length
        for count, each in ((waiting[length] // each, each), (1, waiting[length] % each)):
            if count and each:
                opened.append(Fill(length, capacity, count, each))
                left[length] -= count * each
                rest = capacity - length * each
                after[rest] = after.get(rest, 0) + count
                later[rest] = later.get(rest, 0) + count if rest else 0
        waiting[length] = 0
    return fills, opened, {g: n for g, n in after.items() if g and n}


def _placing(fills: list[tuple[int, int, Fill]], first_rank: int):
    """Arrow job: the rows of ``seq, gap, place`` whose place lies in a fill get their first piece; all get their new gap.

    ``fills`` has the first place, the first piece's rank, and the fill, in order of places, counted from ``first_rank``.
    """
    places = np.array([p for p, _, _ in fills], dtype=np.int64)
    firsts = np.array([r for _, r, _ in fills], dtype=np.int64)
    counts, eaches, lengths = (np.array([getattr(f, n) for _, _, f in fills], dtype=np.int64) for n in ("count", "each", "length"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seq, gap, place = (np.asarray(batch.column(c)).astype(np.int64) for c in ("seq", "gap", "place"))
            place = place - first_rank
            if len(places):
                at = np.maximum(np.searchsorted(places, place, side="right") - 1, 0)
                inside = place - places[at]
                hit = (inside >= 0) & (inside < counts[at])
                each, length = np.where(hit, eaches[at], 0), lengths[at]
                first = firsts[at] + inside * eaches[at]
            else:
                each = length = first = np.zeros_like(seq)
            columns = [seq, gap, first, each, length, gap - each * length]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["seq", "gap", "first", "each", "length", "rest"])

    return run


_ROUND = "seq long, gap long, first long, each long, length long, rest long"


def best_fit_sequences(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``row, sequence_id, offset`` for the written table ``row, length``, lengths from 1 to ``capacity``."""
    spark = pieces.sparkSession
    ranked = globally_ranked(pieces.select("row", "length"), [F.desc("length"), F.col("row")], "rank", "packing-pieces")
    left = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    next_rank, rank = {}, 0
    for length in sorted(left, reverse=True):
        next_rank[length] = rank
        rank += left[length]

    def ranked_fills(fills: list[Fill], starts: dict[int, int] | None) -> list[tuple[int, int, Fill]]:
        out, place = [], 0
        for fill in fills:
            if starts is not None:
                place = starts[fill.gap]
                starts[fill.gap] += fill.count
            out.append((place, next_rank[fill.length], fill))
            place += fill.count
            next_rank[fill.length] += fill.count * fill.each
        return sorted(out, key=lambda x: x[0])

    gaps_table, gaps, sequences, rounds = None, {}, 0, []
    while any(left.values()):
        starts, place = {}, 0
        for gap in sorted(gaps):
            starts[gap] = place
            place += gaps[gap]
        fills, opened, gaps = sweep(left, dict(gaps), capacity)
        parts = []
        if gaps_table is not None:
            order = [F.col("gap"), F.col("seq")]
            places = globally_ranked(gaps_table, order, "place", "packing-gaps").select("seq", "gap", "place")
            parts.append(places.mapInArrow(_placing(ranked_fills(fills, starts), 0), _ROUND))
        new = sum(f.count for f in opened)
        if new:
            fresh = spark.range(sequences, sequences + new).select(
                F.col("id").alias("seq"), F.lit(capacity).cast("long").alias("gap"), F.col("id").alias("place")
            )
            parts.append(fresh.mapInArrow(_placing(ranked_fills(opened, None), sequences), _ROUND))
            sequences += new
        done = saved(parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]), "packing-round")
        rounds.append(done)
        least = min((length for length, n in left.items() if n), default=capacity + 1)
        gaps = {g: n for g, n in gaps.items() if g >= least}
        gaps_table = done.where(F.col("rest") >= least).select("seq", F.col("rest").alias("gap"))
    if not rounds:
        return ranked.select("row", F.col("rank").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    placed = rounds[0]
    for done in rounds[1:]:
        placed = placed.unionByName(done)
    placed = placed.where("each > 0").withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("each") - 1)))
    placed = placed.select(
        (F.col("first") + F.col("i")).alias("rank"), F.col("seq").alias("sequence_id"), (capacity - F.col("gap") + F.col("i") * F.col("length")).alias("offset")
    )
    return ranked.join(placed, "rank").select("row", "sequence_id", "offset")


def pack_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """A row per piece: ``doc_id, piece, start, length, ids, ids_crc32, sequence_id, offset``.

    Only documents longer than ``capacity`` tokens are cut, at its multiples. Within a sequence pieces follow each other
    without gaps from offset 0. A null or empty text is the end id alone. Repeated rows are packed each; a null id stays
    null. An empty table gives an empty result. Other columns are ignored.
    """
    pieces = saved(tokenized_pieces(docs, vocabulary, id_col, text_col, capacity), "packing-tokens")
    places = best_fit_sequences(pieces, capacity)
    return pieces.join(places, "row").select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids", "ids_crc32", "sequence_id", "offset"
    )
