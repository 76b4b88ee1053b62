"""Phrases whose words stand together more often than by chance, by Rabin-Karp fingerprints.

Texts are cut into chunks. The fingerprint of every run of one to four words comes from prefix polynomials over the
words' hashes: the difference of two prefixes, divided by the power at which it begins, modulo 2^64. A chunk sends each
block of fingerprints those it has, with their counts; the chunk and the fingerprint point to where the run occurs. A
block adds the counts up and answers with the fingerprints that may be frequent. Only then does a chunk turn to its text
again: occurrences of a fingerprint are compared word by word with the first of them, and the phrases are counted as
text. Two phrases with one fingerprint are so told apart, and a fingerprint that was frequent by collision is not.

Few fingerprints are frequent, so few phrases ever exist as text, and scoring joins them as ordinary tables.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docsift.llm.common import saved
from docsift.llm.grams import SEED

WORDS = 4
LEAST = 30
FIRST = 2000
# A longer phrase stands for a shorter one within it from this share of its occurrences.
SHARE = (80, 100)
SCALE = 2_000_000
# Bytes of text in a chunk and in one part of a long text, and fingerprints that a block gets of the whole table.
CHUNK_BYTES, PART_BYTES, BLOCK = 8 << 20, 4 << 20, 1 << 22
# Bytes of text to a fingerprint, by which blocks are numbered; an error costs memory or tasks, not results.
_BYTES_EACH = 3

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MULTIPLIER = np.uint64(0xD6E8FEB86659FD93)
_ENDS = re.compile(rb"[.,;:!?\n-\r]")
_SPACE = re.compile(rb"[ \t]")
# Ends of pieces become line feeds, and tabulators spaces.
_TABLE = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b"\n\n\n\n\n\n\n\n\n\n ")


class _Symbols(dict):
    """What stands for a word in the polynomials: never 0 or 1, which stand for nothing and for the end of a piece.

    Only the bits of ``mask`` tell words apart.
    """

    def __init__(self, mask: int = (1 << 64) - 1):
        super().__init__()
        self.mask = mask

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 18:
            self.clear()
        value = self[word] = 0 if not word else 1 if word == b"\n" else xxhash.xxh64_intdigest(word, SEED) & self.mask | 2
        return value


_SYMBOLS = _Symbols()


def parts_of(text: bytes, size: int) -> Iterator[tuple[int, bytes]]:
    """``skip, part``: a text in parts of about a size, which end with a piece if they can.

    Within a piece that is longer a part ends with a word, and the next begins with its last three words again, which
    ``skip`` counts.
    """
    at, skip, head = 0, 0, b""
    while True:
        if len(text) - at <= size:
            yield skip, head + text[at:]
            return
        end = _ENDS.search(text, at + size, at + 2 * size)
        if end:
            yield skip, head + text[at : end.end()]
            at, skip, head = end.end(), 0, b""
            continue
        space = _SPACE.search(text, at + size)
        # After a word without an end there is nothing to cut.
        stop = space.end() if space else len(text)
        part = head + text[at:stop]
        yield skip, part
        if stop == len(text):
            return
        piece = part[max((m.end() for m in _ENDS.finditer(part)), default=0) :]
        last = piece.lstrip(b" \t").split()[-(WORDS - 1) :]
        at, skip, head = stop, len(last), b" ".join(last) + b" " if last else b""


def chunked(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``chunk, lang, skip, text`` of all texts: texts in chunks of about a size, long ones in parts."""
    chunk_bytes, part_bytes = CHUNK_BYTES, PART_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            rows = []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for skip, part in parts_of(text, part_bytes):
                    rows.append((chunk, lang, skip, part))
                    size += len(part)
                    if size >= chunk_bytes:
                        chunk, size = chunk + 1, 0
            chunks, langs, skips, texts = zip(*rows) if rows else ((), (), (), ())
            arrays = [pa.array(chunks, pa.int64()), pa.array(langs, pa.string()), pa.array(skips, pa.int32()), pa.array(texts, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["chunk", "lang", "skip", "text"])

    text = F.coalesce(docs[text_col].cast("string"), F.lit("")).cast("binary").alias("text")
    rows = docs.select(F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang"), text).where("length(text) > 0")
    return rows.mapInArrow(run, "chunk long, lang string, skip int, text binary")


class _Numbers(dict):
    """Numbers by word, from 0 as they are met."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


class Runs:
    """The words of some texts, and the fingerprints of their runs."""

    def __init__(self, rows: list[tuple[str, int, bytes]], keep_words: bool = False, symbols: dict | None = None):
        symbols = _SYMBOLS if symbols is None else symbols
        # All texts are split at once; the ends of pieces tell which text a word is of.
        texts = [text.lower().translate(_TABLE) for _, _, text in rows]
        found = b"\n".join(texts).replace(b"\n", b" \n ").split(b" ")
        h = np.fromiter(map(symbols.__getitem__, found), dtype=np.uint64, count=len(found))
        is_word = h > 1
        self.words: list[bytes] = list(compress(found, is_word.tolist())) if keep_words else []
        self.langs = [lang for lang, _, _ in rows]
        piece = np.cumsum(h == 1)[is_word]
        h = h[is_word]
        self.row = np.repeat(np.arange(len(rows), dtype=np.int32), [t.count(b"\n") + 1 for t in texts])[piece]
        self.again = np.zeros(len(h), dtype=bool)
        for i, (_, skip, _) in enumerate(rows):
            if skip:
                start = np.searchsorted(self.row, i)
                self.again[start : start + skip] = True
        # How many words a piece still has from each of its words on.
        sizes = np.bincount(piece) if len(piece) else np.empty(0, dtype=np.int64)
        self.left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(piece))
        powers = np.ones(len(h) + 1, dtype=np.uint64)
        powers[1:] = np.uint64(_BASE)
        inverse = np.ones(len(h) + 1, dtype=np.uint64)
        inverse[1:] = np.uint64(_INVERSE)
        self.inverse = np.cumprod(inverse)
        self.prefix = np.zeros(len(h) + 1, dtype=np.uint64)
        np.cumsum(h * np.cumprod(powers)[:-1], out=self.prefix[1:])
        self.of_lang = np.array([xxhash.xxh64_intdigest(x.encode(), SEED) for x in self.langs], dtype=np.uint64)

    def fingerprints(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Where runs of ``k`` words within a piece begin, and their fingerprints with their language."""
        at = np.flatnonzero(self.left >= k)
        at = at[~self.again[at + k - 1]]
        found = (self.prefix[at + k] - self.prefix[at]) * self.inverse[at]
        found ^= self.of_lang[self.row[at]] + np.uint64(k)
        for _ in range(2):
            found ^= found >> np.uint64(32)
            found *= _MULTIPLIER
        return at, found ^ (found >> np.uint64(32))


def _rows_of(table) -> list[tuple[str, int, bytes]]:
    return list(zip(table.column("lang").to_pylist(), table.column("skip").to_pylist(), table.column("text").to_pylist(), strict=True))


def _maybe_frequent(chunks: DataFrame, bits: int, least: int, symbols: dict | None) -> DataFrame:
    """``chunk, block, keys``: of each chunk's fingerprints, cut to fewer bits, those that occur often enough in all."""
    down = np.uint64(32 - bits)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(chunk: int, rows) -> pa.RecordBatch:
            runs = Runs(rows, symbols=symbols)
            keys, counts = np.unique(np.concatenate([runs.fingerprints(k)[1] for k in range(1, WORDS + 1)]) >> down, return_counts=True)
            ends = np.searchsorted(keys >> np.uint64(32), np.arange((1 << bits) + 1))
            blocks = np.flatnonzero(np.diff(ends))
            keys, counts = keys.astype(np.uint32), counts.astype(np.uint32)
            arrays = [
                pa.array([chunk] * len(blocks), pa.int64()),
                pa.array(blocks.astype(np.int32)),
                pa.array([keys[ends[b] : ends[b + 1]].tobytes() for b in blocks], pa.binary()),
                pa.array([counts[ends[b] : ends[b + 1]].tobytes() for b in blocks], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(arrays, names=["chunk", "block", "keys", "counts"])

        current, held = None, []
        for batch in batches:
            for chunk, row in zip(batch.column("chunk").to_pylist(), _rows_of(batch), strict=True):
                if chunk != current and held:
                    yield flush(current, held)
                    held = []
                current = chunk
                held.append(row)
        if held:
            yield flush(current, held)

    def answer(table: pa.Table) -> pa.Table:
        keys = [np.frombuffer(v, dtype=np.uint32) for v in table.column("keys").to_pylist()]
        counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), dtype=np.uint32)
        every = np.concatenate(keys)
        order = np.argsort(every, kind="stable")
        sorted_ = every[order]
        starts = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
        totals = np.add.reduceat(counts[order].astype(np.int64), starts)
        often = np.empty(len(every), dtype=bool)
        often[order] = np.repeat(totals >= least, np.diff(np.append(starts, len(every))))
        ends = np.cumsum([0, *map(len, keys)])
        back = [k[often[ends[i] : ends[i + 1]]].tobytes() for i, k in enumerate(keys)]
        return pa.table([table.column("chunk"), table.column("block"), pa.array(back, pa.binary())], names=["chunk", "block", "keys"])

    sent = chunks.mapInArrow(send, "chunk long, block int, keys binary, counts binary")
    return sent.groupBy("block").applyInArrow(answer, "chunk long, block int, keys binary").where("length(keys) > 0")


def _counted(chunks: DataFrame, frequent: DataFrame, bits: int, symbols: dict | None) -> DataFrame:
    """``lang, words, phrase, f`` by chunk, for runs that may be frequent; with no words, the number of all words."""
    down = np.uint64(32 - bits)

    def materialise(table: pa.Table, answers: pa.Table) -> pa.Table:
        runs = Runs(_rows_of(table), keep_words=True, symbols=symbols)
        ids = np.fromiter(map(_Numbers().__getitem__, runs.words), dtype=np.int64, count=len(runs.words))
        names = {lang: i for i, lang in enumerate(dict.fromkeys(runs.langs))}
        lang_of = np.array([names[x] for x in runs.langs], dtype=np.int64)[runs.row]
        langs = list(names)
        keys = [
            np.frombuffer(k, dtype=np.uint32).astype(np.uint64) | np.uint64(b << 32)
            for k, b in zip(answers.column("keys").to_pylist(), answers.column("block").to_pylist(), strict=True)
        ]
        keys = np.unique(np.concatenate([np.empty(0, dtype=np.uint64), *keys]))
        # Most runs are told off by a table of some of their bits, the others by a search.
        some = np.zeros(1 << 22, dtype=bool)
        some[keys & np.uint64(len(some) - 1)] = True
        out: Counter = Counter()
        for i, n in enumerate(np.bincount(lang_of[~runs.again], minlength=len(langs)).tolist()):
            out[langs[i], 0, ""] += n
        for k in range(1, WORDS + 1):
            at, found = runs.fingerprints(k)
            likely = np.flatnonzero(some[found >> down & np.uint64(len(some) - 1)])
            if not len(likely):
                continue
            at, found = at[likely], found[likely]
            own = found >> down
            chosen = keys[np.minimum(np.searchsorted(keys, own), len(keys) - 1)] == own
            at, found = at[chosen], found[chosen]
            if not len(at):
                continue
            order = np.argsort(found, kind="stable")
            at, found = at[order], found[order]
            starts = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
            sizes = np.diff(np.append(starts, len(at)))
            first = np.repeat(at[starts], sizes)
            same = lang_of[at] == lang_of[first]
            for i in range(k):
                same &= ids[at + i] == ids[first + i]
            counts = np.add.reduceat(same.astype(np.int64), starts)
            for start, n in zip(at[starts].tolist(), counts.tolist(), strict=True):
                out[langs[lang_of[start]], k, b" ".join(runs.words[start : start + k]).decode()] += n
            # Other words with the fingerprint of the first.
            for start in at[~same].tolist():
                out[langs[lang_of[start]], k, b" ".join(runs.words[start : start + k]).decode()] += 1
        found_langs, words, phrases = zip(*out) if out else ((), (), ())
        arrays = [pa.array(found_langs, pa.string()), pa.array(words, pa.int32()), pa.array(phrases, pa.string()), pa.array(list(out.values()), pa.int64())]
        return pa.table(arrays, names=["lang", "words", "phrase", "f"])

    both = chunks.groupBy("chunk").cogroup(frequent.groupBy("chunk"))
    return both.applyInArrow(materialise, "lang string, words int, phrase string, f long")


def frequent_phrases(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, symbols: Callable[[], dict] | None = None
) -> DataFrame:
    """``lang, words, phrase, f`` of all phrases of one to four words that occur ``least`` times, and of all words by ``words = 0``.

    ``symbols`` makes another table of words' hashes, for tests.
    """
    chunks = saved(chunked(docs, text_col, lang_col), "phrases-chunks")
    total = chunks.agg(F.sum(F.length("text"))).first()[0] or 0
    bits = max(3, math.ceil(math.log2(max(total // _BYTES_EACH, 1) / BLOCK))) if total // _BYTES_EACH > BLOCK else 3
    table = symbols() if symbols is not None else None
    frequent = _maybe_frequent(chunks, bits, least, table)
    counted = _counted(chunks, frequent, bits, table).groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f"))
    return saved(counted.where((F.col("words") == 0) | (F.col("f") >= least)), "phrases-counted")


def _words(first, count):
    return F.array_join(F.slice(F.split("phrase", " "), first, count), " ")


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = LEAST,
    first: int = FIRST,
    symbols: Callable[[], dict] | None = None,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first phrases of two to four words.

    A-Z count as a-z. Pieces of text end at ``.,;:!?`` and line ends, words at spaces and tabulators, and phrases lie
    within pieces. ``a`` is how often a phrase occurs, ``l`` and ``r`` how often its parts do at the cut with the lowest
    score, the first of such, ``n`` how many words its language has. A phrase within a longer one that has 80 in 100 of
    its occurrences or more is left out. Equal scores go by ``a``, then by the phrase's bytes, so there are no ties.
    A null or empty text adds nothing, a null language is ``und``, rows that repeat are counted again, ids are not
    looked at, and an empty table gives an empty one. Columns of other names are not looked at.
    """
    counted = frequent_phrases(docs, text_col, lang_col, least, symbols)
    known = counted.where("words > 0").select("lang", "phrase", "words", F.col("f").alias("a"))
    candidates = known.where("words > 1")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumns({"head": _words(F.lit(1), F.col("k")), "tail": _words(F.col("k") + 1, F.col("words") - F.col("k"))})
    heads = known.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l"))
    tails = known.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("r"))
    # Decimals, as products may pass 64 bits.
    score = F.expr(f"cast(({SCALE} * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0))) as bigint)")
    cuts = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).withColumn("score", score)
    lowest = cuts.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    scored = lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

    longer = candidates.where("words > 2").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    longer = longer.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    within = longer.select("lang", _words(F.col("at"), F.col("size")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    part, whole = SHARE
    covered = F.col("most").cast("decimal(20,0)") * whole >= F.col("a").cast("decimal(20,0)") * part
    kept = scored.join(within, ["lang", "phrase"], "left").where(~F.coalesce(covered, F.lit(False))).drop("most")

    # Each language's first of each of many parts come before its first of all, so no task sorts a language as a whole.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = F.pmod(F.xxhash64("phrase"), F.lit(64))
    some = kept.withColumn("part", parts).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    some = some.where(F.col("rank") <= first).drop("part", "rank")
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= first)
    words = counted.where("words = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
