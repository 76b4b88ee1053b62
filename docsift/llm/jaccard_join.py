"""Documents that share most of their n-grams, found by a blocked product of the document by n-gram incidence matrix.

The matrix has a row per different set of n-grams and a column per n-gram. Sets ``a`` and ``b`` are linked if their
overlap, an entry of the product of the matrix and its transpose, is at least ``s`` of their union. Bounds that follow
from the sizes alone keep nearly all entries from being computed:

1. *Columns of one document add nothing.* A set of ``n`` needs ``s * n`` n-grams that others have too. Columns are cut
   into blocks by hash; tasks send the blocks their n-grams, packed, and learn how many of each document's are shared.
   Most documents end here.
2. *Rare columns decide.* Linked sets share one of the first ``n - ceil(s * n) + 1`` n-grams of each, in any order. Here
   the order goes by how many documents hold an n-gram, which the blocks count, so only rare shared columns are
   multiplied.
3. *What is left must suffice.* A pair goes on only if what the two have from the first common n-gram on can reach the
   overlap that their sizes ask for.

The overlaps of the pairs that are left are then added up, block of columns by block of columns.

Only components are asked for, so a column of many documents is first multiplied by one of its documents, then by some,
and in the end as a whole, in blocks of rows. Documents that are in one component by then are not multiplied again, and
columns whose documents all are are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.llm.common import saved, utf8
from docsift.llm.components import connected_components
from docsift.llm.grams import SEED, shingles

WORDS = 4
SIMILARITY = Fraction(85, 100)
# N-grams that a task sends to the blocks at once, and that a block of columns gets of the whole table.
CHUNK, BLOCK = 1 << 20, 1 << 22
# Rounds before columns are multiplied as a whole: in the first (0) every document meets the best pivot of all its columns
# only, in the other each of so many pivots of each column.
PIVOTS = (0, 8)
# Documents in a block of rows of a column.
ROWS = 512
# N-grams in a block of columns when overlaps are added up.
COLUMNS = 1 << 13
_MOST_DOCS = 1 << 16

SIZED = "_row long, _id long, size int, whole long, _text binary"


def ratio(similarity: Fraction | float) -> Fraction:
    s = Fraction(similarity).limit_denominator(10_000)
    if not 0 < s <= 1:
        raise ValueError("similarity must be over 0 and at most 1")
    return s


def least_shared(n, s: Fraction):
    """How many n-grams a set of ``n`` must share with a set that is as similar; for numbers, arrays and columns."""
    return -((-n * s.numerator) // s.denominator) if not isinstance(n, Column) else F.ceil(n * s.numerator / F.lit(s.denominator) - F.lit(1e-9))


def sized_texts(texts: DataFrame, words: int) -> DataFrame:
    """``_row, _id, size, whole, _text`` of texts (``_row, _id, _text``): each one's number of n-grams and a hash of them all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, wholes = [], []
            for text in utf8(batch.column("_text")):
                found = shingles(text, words)
                sizes.append(len(found))
                wholes.append(xxhash.xxh64_intdigest(found.tobytes(), SEED))
            hashes = pa.array(np.array(wholes, dtype=np.uint64).view(np.int64))
            arrays = [batch.column("_row"), batch.column("_id"), pa.array(sizes, pa.int32()), hashes, batch.column("_text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["_row", "_id", "size", "whole", "_text"])

    return texts.select("_row", "_id", "_text").mapInArrow(run, SIZED)


def _block_bits(total: int) -> int:
    return max(3, math.ceil(math.log2(max(total, 1) / BLOCK))) if total > BLOCK else 3


def _packed(arrays: list[np.ndarray]) -> pa.Array:
    return pa.array([a.tobytes() for a in arrays], pa.binary())


def _per_block(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of the keys by block, and where each block begins and ends in it."""
    block = (keys >> np.uint64(32)).astype(np.uint16 if bits <= 16 else np.uint32)
    order = np.argsort(block, kind="stable")
    return order, np.searchsorted(block[order], np.arange((1 << bits) + 1))


def _shared_counts(texts: DataFrame, words: int, bits: int) -> DataFrame:
    """``_row, size, shared``: how many of each set's n-grams are in another set, or more by a rare collision.

    A chunk of documents sends each block the n-grams that only one of its documents has, with the document's number,
    and once those that several have. It gets back the numbers of the documents whose n-grams others sent too.
    """
    down, chunk_size, most = np.uint64(32 - bits), CHUNK, _MOST_DOCS

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, chunks, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush() -> pa.RecordBatch:
            lengths = np.array([len(found) for _, _, found in held])
            keys = np.concatenate([found for _, _, found in held]) >> down
            owner = np.repeat(np.arange(len(held), dtype=np.uint16), lengths)
            order = np.argsort(keys, kind="stable")
            sorted_ = keys[order]
            same = sorted_[1:] == sorted_[:-1]
            again = np.zeros(len(keys), dtype=bool)
            again[1:] |= same
            again[:-1] |= same
            repeated = np.empty(len(keys), dtype=bool)
            repeated[order] = again
            local = np.bincount(owner[repeated], minlength=len(held)).astype(np.int32)
            several = np.unique(sorted_[again])
            singles, owners = keys[~repeated], owner[~repeated]
            order, ends = _per_block(singles, bits)
            singles, owners = singles[order].astype(np.uint32), owners[order]
            _, others = _per_block(several, bits)
            several = several.astype(np.uint32)
            blocks = np.flatnonzero((np.diff(ends) > 0) | (np.diff(others) > 0))
            chunk = (part << 32) + chunks
            # One of the messages carries what the chunk itself knows; it comes back with the answers.
            known = [b""] * len(blocks)
            at = chunk % len(blocks)
            known[at] = np.array([r for r, _, _ in held], dtype=np.int64).tobytes() + np.array([n for _, n, _ in held], dtype=np.int64).tobytes() + local.tobytes()
            arrays = [
                pa.array([chunk] * len(blocks), pa.int64()),
                pa.array(blocks.astype(np.int32)),
                _packed([singles[ends[b] : ends[b + 1]] for b in blocks]),
                _packed([owners[ends[b] : ends[b + 1]] for b in blocks]),
                _packed([several[others[b] : others[b + 1]] for b in blocks]),
                pa.array(known, pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(arrays, names=["chunk", "block", "singles", "owners", "several", "known"])

        for batch in batches:
            for row, text in zip(batch.column("_row").to_pylist(), batch.column("_text").to_pylist(), strict=True):
                found = shingles(text or b"", words)
                # A very long text goes in pieces, whose counts are added up in the end.
                for at in range(0, len(found), chunk_size):
                    held.append((row, len(found), found[at : at + chunk_size]))
                    size += len(held[-1][2])
                    if size >= chunk_size or len(held) == most:
                        yield flush()
                        chunks, held, size = chunks + 1, [], 0
        if held:
            yield flush()

    def answer(table: pa.Table) -> pa.Table:
        singles = [np.frombuffer(v, dtype=np.uint32) for v in table.column("singles").to_pylist()]
        several = [np.frombuffer(v, dtype=np.uint32) for v in table.column("several").to_pylist()]
        # What a chunk has several times counts as twice.
        keys = np.concatenate([*singles, *several, *several])
        order = np.argsort(keys, kind="stable")
        sorted_ = keys[order]
        same = sorted_[1:] == sorted_[:-1]
        again = np.zeros(len(keys), dtype=bool)
        again[1:] |= same
        again[:-1] |= same
        shared = np.empty(len(keys), dtype=bool)
        shared[order] = again
        ends = np.cumsum([0, *map(len, singles)])
        owners = [np.frombuffer(v, dtype=np.uint16) for v in table.column("owners").to_pylist()]
        back = [o[shared[ends[i] : ends[i + 1]]] for i, o in enumerate(owners)]
        return pa.table([table.column("chunk"), _packed(back), table.column("known")], names=["chunk", "owners", "known"])

    def add(table: pa.Table) -> pa.Table:
        known = next(v for v in table.column("known").to_pylist() if v)
        n = len(known) // 20
        rows, sizes = np.frombuffer(known, dtype=np.int64, count=2 * n).reshape(2, n)
        local = np.frombuffer(known, dtype=np.int32, offset=16 * n)
        owners = np.frombuffer(b"".join(table.column("owners").to_pylist()), dtype=np.uint16)
        shared = local + np.bincount(owners, minlength=n)
        return pa.table([pa.array(rows), pa.array(sizes), pa.array(shared.astype(np.int64))], names=["_row", "size", "shared"])

    sent = texts.select("_row", "_text").mapInArrow(send, "chunk long, block int, singles binary, owners binary, several binary, known binary")
    answers = sent.groupBy("block").applyInArrow(answer, "chunk long, owners binary, known binary")
    pieces = answers.groupBy("chunk").applyInArrow(add, "_row long, size long, shared long")
    return pieces.groupBy("_row").agg(F.first("size").alias("size"), F.sum("shared").alias("shared"))


def _sets(texts: DataFrame, words: int) -> DataFrame:
    """``chunk, node, sigs``: the n-grams of each text, in chunks of texts."""
    chunk_size = CHUNK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            found, chunks = [], []
            for text in batch.column("_text").to_pylist():
                found.append(shingles(text or b"", words).view(np.int64))
                chunks.append(chunk)
                size += len(found[-1])
                if size >= chunk_size:
                    chunk, size = chunk + 1, 0
            ends = pa.array(np.cumsum([0, *map(len, found)]).astype(np.int32))
            listed = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(found) if found else np.empty(0, np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.int64()), batch.column("node"), listed], names=["chunk", "node", "sigs"])

    return texts.select("node", "_text").mapInArrow(run, "chunk long, node long, sigs array<long>")


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All values of lists one after the other, and the lengths of the lists."""
    values = [c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]
    lengths = [c.value_lengths().to_numpy(zero_copy_only=False) for c in column.chunks]
    none = np.empty(0, dtype=np.int64)
    return np.concatenate([none, *values]).astype(np.int64).view(np.uint64), np.concatenate([none, *lengths]).astype(np.int64)


def _first_columns(sets: DataFrame, s: Fraction, bits: int) -> DataFrame:
    """``k, node, size, place, central``: the shared n-grams among the first that decide, rare ones first, with their places.

    ``central`` is how frequent a document's n-grams are on average: of a group of edited copies the text that they
    were made from has most, as each edit leaves others with n-grams of their own.
    """
    down = np.uint64(32 - bits)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunks = batch.column("chunk").to_numpy()
            for chunk in np.unique(chunks):
                mine = batch.filter(pa.array(chunks == chunk))
                values, _ = _flat(pa.chunked_array([mine.column("sigs")]))
                keys, counts = np.unique(values >> down, return_counts=True)
                order, ends = _per_block(keys, bits)
                keys, counts = keys[order].astype(np.uint32), np.minimum(counts[order], 65535).astype(np.uint16)
                blocks = np.flatnonzero(np.diff(ends))
                arrays = [
                    pa.array([int(chunk)] * len(blocks), pa.int64()),
                    pa.array(blocks.astype(np.int32)),
                    _packed([keys[ends[b] : ends[b + 1]] for b in blocks]),
                    _packed([counts[ends[b] : ends[b + 1]] for b in blocks]),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["chunk", "block", "keys", "counts"])

    def answer(table: pa.Table) -> pa.Table:
        keys = [np.frombuffer(v, dtype=np.uint32) for v in table.column("keys").to_pylist()]
        counts = np.concatenate([np.frombuffer(v, dtype=np.uint16) for v in table.column("counts").to_pylist()]).astype(np.int64)
        found, place = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.bincount(place, weights=counts, minlength=len(found))
        # Eight steps to a doubling are fine enough for an order. No code is zero, which stands for a single document.
        codes = np.where(totals > 1, np.minimum(1 + 8 * np.log2(np.maximum(totals, 1)), 255), 0).astype(np.uint8)[place]
        ends, back, coded = np.cumsum([0, *map(len, keys)]), [], []
        for i, k in enumerate(keys):
            c = codes[ends[i] : ends[i + 1]]
            back.append(k[c > 0])
            coded.append(c[c > 0])
        return pa.table([table.column("chunk"), table.column("block"), _packed(back), _packed(coded)], names=["chunk", "block", "keys", "codes"])

    def choose(sets: pa.Table, answers: pa.Table) -> pa.Table:
        values, sizes = _flat(sets.column("sigs"))
        nodes = sets.column("node").to_numpy()
        keys = [
            np.frombuffer(k, dtype=np.uint32).astype(np.uint64) | np.uint64(b << 32)
            for k, b in zip(answers.column("keys").to_pylist(), answers.column("block").to_pylist(), strict=True)
        ]
        keys = np.concatenate([np.empty(0, dtype=np.uint64), *keys])
        codes = np.frombuffer(b"".join(answers.column("codes").to_pylist()), dtype=np.uint8)
        keys, first = np.unique(keys, return_index=True)
        codes = codes[first]
        own = values >> down
        at = np.minimum(np.searchsorted(keys, own), max(len(keys) - 1, 0))
        code = np.where(keys[at] == own, codes[at], 0).astype(np.uint8) if len(keys) else np.zeros(len(own), dtype=np.uint8)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        order = np.lexsort((values, code, owner))
        place = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        central = (np.bincount(owner, weights=code, minlength=len(sizes)) * 1024 / np.maximum(sizes, 1)).astype(np.int32)
        wanted = (place <= (sizes - least_shared(sizes, s))[owner]) & (code[order] > 0)
        chosen, owner = order[wanted], owner[wanted]
        arrays = [
            pa.array(values[chosen].view(np.int64)),
            pa.array(nodes[owner]),
            pa.array(sizes[owner].astype(np.int32)),
            pa.array(place[wanted].astype(np.int32)),
            pa.array(central[owner]),
        ]
        return pa.table(arrays, names=["k", "node", "size", "place", "central"])

    sent = sets.select("chunk", "sigs").mapInArrow(send, "chunk long, block int, keys binary, counts binary")
    answers = sent.groupBy("block").applyInArrow(answer, "chunk long, block int, keys binary, codes binary")
    both = sets.groupBy("chunk").cogroup(answers.groupBy("chunk"))
    return both.applyInArrow(choose, "k long, node long, size int, place int, central int")


def _possible(s: Fraction) -> Column:
    """Whether two sets can be similar, if the n-gram they share is the first that they share.

    ``na`` and ``nb`` are their sizes, ``ia`` and ``ib`` the n-gram's places. For the first shared one this is exact.
    """
    most = F.least(F.col("na") - F.col("ia"), F.col("nb") - F.col("ib")).cast("long")
    return most * (s.numerator + s.denominator) >= (F.col("na") + F.col("nb")).cast("long") * s.numerator


def _side(end: str, *more: str) -> list[Column]:
    return [F.col(c).alias(n + end) for c, n in (("node", ""), ("size", "n"), ("place", "i"), ("root", "r"))] + [F.col(m) for m in more]


def _pairs(members: DataFrame, pivots: int | None, s: Fraction) -> DataFrame:
    """``a, b, na, nb`` of one column and different roots, each pair once: every document with each of some, or with all."""
    if pivots is None:
        # A column's documents are dealt to blocks of rows, and a block is met by all blocks of its column.
        sizes = members.groupBy("k").agg(F.ceil(F.count("*") / ROWS).cast("int").alias("blocks"))
        dealt = members.join(sizes, "k").withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
        dealt = dealt.select("k", "node", "size", "place", "root", "mine", other)
        left = dealt.where("mine <= other").select(*_side("a", "k"), F.col("mine").alias("x"), F.col("other").alias("y"))
        right = dealt.where("mine >= other").select(*_side("b", "k"), F.col("other").alias("x"), F.col("mine").alias("y"))
        pairs = left.join(right, ["k", "x", "y"]).where((F.col("x") < F.col("y")) | (F.col("a") < F.col("b")))
    else:
        # One order for all columns, so that the first document of a group of copies is the first in most of its columns.
        order = [(-F.col("central")).alias("c"), F.xxhash64("node").alias("h")]
        first = F.min(F.struct(*order, "node", "size", "place", "root")).alias("s")
        slot = F.pmod(F.xxhash64("node"), F.lit(max(pivots, 1))).alias("slot")
        chosen = members.groupBy("k", slot).agg(first, F.count("*").alias("n")).select("k", "s.*", "n")
        chosen = saved(chosen, "jaccard-pivots")
        # Columns of very many documents are cut into parts, and their pivots repeated for each.
        hot = chosen.groupBy("k").agg(F.ceil(F.sum("n") / (ROWS * 16)).cast("int").alias("parts")).where("parts > 1")
        hot = saved(hot, "jaccard-hot")
        some = chosen.where("n > 1") if pivots < 2 else chosen
        some = some.join(hot, "k", "left").select(*_side("a", "k", "c", "h"), F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part"))
        rest = members.join(hot, "k", "left").withColumn("part", F.pmod(F.xxhash64("node", "k"), F.coalesce("parts", F.lit(1))).cast("int"))
        pairs = some.join(rest.select(*_side("b", "k", "part")), ["k", "part"]).where("a <> b")
    pairs = pairs.where("ra <> rb").where(_possible(s))
    if pivots == 0:
        pairs = pairs.groupBy("b", "nb").agg(F.min(F.struct("c", "h", "a", "na")).alias("s")).select("s.a", "b", "s.na", "nb")
    swap = F.col("a") > F.col("b")
    ends = [F.when(swap, F.col(y)).otherwise(F.col(x)).alias(n) for n, x, y in (("a", "a", "b"), ("b", "b", "a"), ("na", "na", "nb"), ("nb", "nb", "na"))]
    return pairs.select(*ends).distinct()


def _level(n: str) -> Column:
    """Into how many halves of halves the columns are cut for a set of this size."""
    return F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(F.col(n), F.lit(1)) / COLUMNS))).cast("int")


def _cut_sets(sets: DataFrame) -> DataFrame:
    """``node, block, sigs``: each set by blocks of columns, of about ``COLUMNS`` n-grams at most."""
    leveled = sets.select("node", "sigs", F.size("sigs").alias("n")).withColumn("level", _level("n"))
    whole = leveled.where("level = 0").select("node", F.lit(0).alias("block"), "sigs")
    sig = leveled.where("level > 0").select("node", "level", F.explode("sigs").alias("sig"))
    block = F.expr("cast(shiftrightunsigned(sig, 64 - level) as int)").alias("block")
    return whole.unionByName(sig.groupBy("node", block).agg(F.collect_list("sig").alias("sigs")))


def _linked(pairs: DataFrame, cut: DataFrame, s: Fraction) -> DataFrame:
    """The pairs ``a, b`` whose overlap, added up over blocks of columns, reaches what their sizes ask for."""
    finer = F.greatest("la", "lb")
    pairs = pairs.withColumns({"la": _level("na"), "lb": _level("nb")}).withColumn("finer", finer)
    blocks = pairs.withColumn("j", F.explode(F.expr("sequence(0, shiftleft(1, finer) - 1)")))
    blocks = blocks.withColumns({"block_a": F.expr("shiftright(j, finer - la)"), "block_b": F.expr("shiftright(j, finer - lb)")})
    one = cut.select(F.col("node").alias("a"), F.col("block").alias("block_a"), F.col("sigs").alias("sa"))
    two = cut.select(F.col("node").alias("b"), F.col("block").alias("block_b"), F.col("sigs").alias("sb"))
    met = blocks.join(one, ["a", "block_a"]).join(two, ["b", "block_b"])
    met = met.select("a", "b", "na", "nb", F.size(F.array_intersect("sa", "sb")).cast("long").alias("common"))
    sums = met.groupBy("a", "b", "na", "nb").agg(F.sum("common").alias("common"))
    return sums.where(F.col("common") * (s.numerator + s.denominator) >= (F.col("na") + F.col("nb")).cast("long") * s.numerator).select("a", "b")


def _roots(members: DataFrame, sets: DataFrame, s: Fraction) -> DataFrame | None:
    """``node, root`` for every node that is linked to another; None without links."""
    links, roots, cut = None, None, None
    left = members.withColumn("root", F.col("node"))
    for pivots in (*PIVOTS, None):
        if roots is not None:
            left = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        several = left.groupBy("k").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("k")
        left = saved(left.join(several, "k", "left_semi"), "jaccard-columns")
        if left.isEmpty():
            break
        pairs = saved(_pairs(left, pivots, s), "jaccard-pairs")
        if cut is None:
            named = saved(left.select("node").distinct(), "jaccard-named")
            cut = saved(_cut_sets(sets.join(named, "node", "left_semi")), "jaccard-sets")
        found = saved(_linked(pairs, cut, s), "jaccard-links")
        if found.isEmpty():
            continue
        links = found if links is None else links.unionByName(found)
        roots = connected_components(links, "a", "b")
    return roots


def similar_sets(sized: DataFrame, texts: DataFrame, words: int = WORDS, similarity: Fraction | float = SIMILARITY) -> DataFrame:
    """``size, whole, node, n_rows, root`` for every set of n-grams of written ``sized_texts`` and their ``_row, _text``.

    ``node`` is a row that has the set, ``root`` a node of its component. Sets without n-grams are left out.
    """
    s = ratio(similarity)
    classes = sized.where("size > 0").groupBy("size", "whole").agg(F.min("_row").alias("node"), F.count("*").alias("n_rows"))
    classes = saved(classes, "jaccard-classes")
    bits = _block_bits(sized.agg(F.sum("size")).first()[0] or 0)
    shared = _shared_counts(texts, words, bits).where(F.col("shared") >= least_shared(F.col("size"), s)).select(F.col("_row").alias("node"))
    kept = saved(shared.join(classes.select("node"), "node"), "jaccard-kept")
    wanted = texts.select(F.col("_row").alias("node"), "_text").join(kept, "node", "left_semi")
    sets = saved(_sets(wanted, words), "jaccard-texts")
    members = saved(_first_columns(sets, s, bits), "jaccard-first")
    roots = _roots(members, sets, s)
    if roots is None:
        return classes.withColumn("root", F.col("node"))
    return classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, similarity: Fraction | float = SIMILARITY
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row: its distinct n-grams, and the smallest id that links reach from it.

    A-Z count as a-z. A text with fewer words than an n-gram is one n-gram as a whole. A null, empty or blank text has
    none and is linked with nothing, so it keeps its own id. Texts with the same n-grams are linked, whatever their
    length. Rows may repeat ids; null ids are rows like others and are never the smallest, and a component of null ids
    alone has none. An empty table gives an empty one. Columns of other names are not looked at. N-grams are told apart
    by 64-bit hashes. A task holds the n-grams of one text at a time, 8 bytes each.
    """
    ids = docs.select(docs[id_col].cast("long").alias("_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).cast("binary").alias("_text"))
    rows = saved(sized_texts(ids.withColumn("_row", F.monotonically_increasing_id()), words), "jaccard-rows")
    sets = saved(similar_sets(rows.drop("_text"), rows.where("size > 0"), words, similarity), "jaccard-components")
    # Only sets of several rows or with links change a row's component, and only they are looked up.
    linked = sets.groupBy("root").agg(F.count("*").alias("n")).where("n > 1").select("root")
    changed = sets.join(linked.withColumn("linked", F.lit(True)), "root", "left").where("linked or n_rows > 1").select("size", "whole", "root")
    changed = saved(changed, "jaccard-changed")
    narrow = rows.select("_id", "size", "whole")
    found = saved(narrow.join(changed, ["size", "whole"], "left"), "jaccard-found")
    least = saved(found.where("root is not null").groupBy("root").agg(F.min("_id").alias("least")), "jaccard-least")
    placed = found.join(least, "root", "left")
    component = F.when(F.col("root").isNull(), F.col("_id")).otherwise(F.col("least"))
    return placed.select(F.col("_id").alias("doc_id"), F.col("size").cast("long").alias("n_shingles"), component.alias("component_id"))
