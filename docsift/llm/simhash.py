"""Near duplicates by SimHash: fingerprints that differ in few bits share a block.

A fingerprint has 64 bits, one for each bit that is set in over half the hashes of the text's word shingles. With
``distance`` or fewer differing bits and more blocks than that, all but ``distance`` blocks agree, so one of the joins on
those blocks meets every close pair; the Hamming distance is then checked. Different fingerprints are compared, never
copies.

A block value that very many fingerprints share would give all their pairs. Such a bucket is joined in another exact way:
two fingerprints at a distance of at most 2 have a common point within one bit of each, so each is sent to the points
within one bit of it, and a point's few fingerprints are linked to the least of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.llm.common import fresh, id_and_text, saved, utf8
from docsift.llm.components import connected_components

SHINGLE_WORDS = 3
SEED = 42
BLOCKS = 4
# Buckets with more fingerprints are joined by common points instead of pairs.
PAIRED_BUCKET = 128
_CHUNK = 1 << 16


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of a text in UTF-8; zero if it has no word."""
    found = text.lower().split()
    if not found:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(found) <= words:
        hashes = [digest(b" ".join(found), SEED)]
    else:
        hashes = [digest(s, SEED) for s in map(b" ".join, zip(*(found[i:] for i in range(words)), strict=False))]
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _CHUNK):
        bits = np.unpackbits(np.array(hashes[at : at + _CHUNK], dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text_col: str, name: str, words: int = SHINGLE_WORDS) -> DataFrame:
    """The table with the fingerprint of its texts as a long, without the texts."""
    kept = [c for c in docs.columns if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, words) for t in utf8(batch.column(text_col))], dtype=np.uint64)
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(prints.view(np.int64))], names=[*kept, name])

    schema = docs.select(*kept, F.lit(0).cast("long").alias(name)).schema
    return docs.mapInArrow(run, schema)


def _blocks(value: Column, blocks: int) -> list[Column]:
    """The bits of each block in their places, all others zero."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    masks = [((1 << high) - 1) ^ ((1 << low) - 1) for low, high in zip(edges, edges[1:], strict=False)]
    return [value.bitwiseAND(F.lit(m - (1 << 64) if m >= 1 << 63 else m)) for m in masks]


def _within(a: str, b: str, distance: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= distance


def close_links(prints: DataFrame, name: str, distance: int = 2, blocks: int = BLOCKS, paired: int = PAIRED_BUCKET) -> DataFrame:
    """Links ``a, b`` between different fingerprints that have the same components as all close pairs.

    Every pair within ``distance`` (0 to 2) is a link itself or its two ends are linked through a close fingerprint.
    """
    if not 0 <= distance <= 2 or blocks <= distance:
        raise ValueError("distance must be 0 to 2, and there must be more blocks than that")
    value = F.col(name)
    parts = _blocks(value, blocks)
    agreeing = list(combinations(range(blocks), blocks - distance))
    keys = F.array(
        *(F.struct(F.lit(i).alias("c"), reduce(Column.bitwiseOR, (parts[j] for j in chosen)).alias("k")) for i, chosen in enumerate(agreeing))
    )
    unique = prints.select(value).where(value.isNotNull()).distinct()
    rows = unique.select(value.alias("p"), F.explode(keys).alias("_key")).select("p", "_key.c", "_key.k")
    buckets = rows.groupBy("c", "k").agg(F.count("*").alias("n")).where("n > 1")
    shared = saved(rows.join(buckets, ["c", "k"]), "simhash-blocks")
    few = shared.where(F.col("n") <= paired)
    pairs = few.select("c", "k", F.col("p").alias("a")).join(few.select("c", "k", F.col("p").alias("b")), ["c", "k"])
    pairs = pairs.where((F.col("a") < F.col("b")) & _within("a", "b", distance)).select("a", "b")
    many = shared.where(F.col("n") > paired)
    flips = F.array(F.lit(0).cast("long"), *(F.lit((1 << i) - ((1 << 64) if i == 63 else 0)).cast("long") for i in range(64)))
    points = many.select("p").distinct().select("p", F.explode(flips).alias("_flip"))
    points = points.select("p", F.col("p").bitwiseXOR(F.col("_flip")).alias("point"))
    least = points.groupBy("point").agg(F.min("p").alias("least"), F.count("*").alias("n")).where("n > 1")
    stars = points.join(least, "point").where("p <> least").where(_within("p", "least", distance)).select(F.col("least").alias("a"), F.col("p").alias("b"))
    return pairs.unionByName(stars).distinct()


def print_roots(rows: DataFrame, name: str, distance: int = 2, blocks: int = BLOCKS, paired: int = PAIRED_BUCKET) -> DataFrame:
    """``name, _root`` for every different fingerprint: the smallest that links reach."""
    roots = connected_components(close_links(rows, name, distance, blocks, paired), "a", "b")
    rooted = rows.select(name).distinct().join(roots, F.col(name) == F.col("node"), "left")
    return rooted.select(name, F.coalesce("root", name).alias("_root"))


def _components(rows: DataFrame, name: str, distance: int, blocks: int, paired: int) -> DataFrame:
    """``name, _root, component_id`` for every fingerprint, from ``name, _id``."""
    firsts = rows.groupBy(name).agg(F.min("_id").alias("_first"))
    rooted = firsts.join(print_roots(rows, name, distance, blocks, paired), name)
    ids = rooted.groupBy("_root").agg(F.min("_first").alias("component_id"))
    return rooted.join(ids, "_root").select(name, "_root", "component_id")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = SHINGLE_WORDS,
    distance: int = 2,
    blocks: int = BLOCKS,
    paired: int = PAIRED_BUCKET,
) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``.

    Fingerprints link at ``distance`` or fewer differing bits; ``component_id`` is the smallest id that links reach. A
    text without words, a null one too, has the fingerprint zero, which links like any other. A null id is never a
    ``component_id`` unless the component has no other. Repeated rows are repeated in the result. An empty table gives
    an empty result. Other columns are ignored.
    """
    texts = id_and_text(docs, id_col, text_col).select(F.col("doc_id").alias("_id"), "text")
    rows = saved(with_fingerprints(texts, "text", "_print", words), "simhash-prints")
    found = _components(rows, "_print", distance, blocks, paired)
    return rows.join(found, "_print").select(
        F.col("_id").alias("doc_id"), F.lower(F.lpad(F.hex("_print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, distance: int = 2) -> DataFrame:
    """The documents with all their columns, one row of each component: that with the smallest id, null ids last.

    Of rows that share the smallest id one stays.
    """
    (row,) = fresh(docs, "_row")
    rows = saved(docs.withColumn(row, F.monotonically_increasing_id()), "simhash-rows")
    texts = rows.select(F.col(row).alias("_row"), F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    prints = saved(with_fingerprints(texts, "_text", "_print", words), "simhash-prints")
    found = _components(prints.select("_print", F.coalesce("_id", F.lit((1 << 63) - 1)).alias("_id")), "_print", distance, BLOCKS, PAIRED_BUCKET)
    members = prints.join(found, "_print").groupBy("_root").agg(
        F.min(F.struct(F.coalesce("_id", F.lit((1 << 63) - 1)).alias("id"), F.col("_row").alias("row"))).alias("stays")
    )
    return rows.join(members.select(F.col("stays.row").alias(row)), row, "left_semi").select(*docs.columns)
