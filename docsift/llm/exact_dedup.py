"""Exact duplicates through an extendible-hash index on shared files.

Texts are equal if their bytes are after lower-casing A-Z. Every text gets a 64-bit key. A directory of key prefixes is
doubled where a bucket holds more than its capacity; each bucket belongs to one owner task, which reads its keys in order,
chains the different texts of one key and compares bytes. Links from texts to chain heads are the index's files; groups
are then a sum over heads.

Copies never meet in one task in full: a task compares what it reads first and sends one text per group, and a key that
alone is over a bucket's capacity is cut into slices whose chain heads are compared in a second round.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.llm.common import extended, fresh, saved, utf8

BUCKET_BYTES = 64 << 20
# Texts that one task remembers to find copies among what it reads; the others meet at their owner.
REMEMBERED_BYTES = 48 << 20
# The directory looks at this many more bits of the key per pass over the counts.
BITS_PER_PASS = 12


def sha_key(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "big")


@dataclass(frozen=True)
class Directory:
    """Buckets in key order: the first key of each, its owner task, and over how many tasks its only key is sliced."""

    firsts: np.ndarray
    owners: np.ndarray
    slices: np.ndarray

    @property
    def tasks(self) -> int:
        return int(self.slices.sum())


def build_directory(keys: DataFrame, capacity: int = BUCKET_BYTES) -> Directory:
    """Double the directory of prefixes of ``key`` until no bucket holds more than ``capacity`` of ``bytes``.

    The driver holds one entry per bucket, and at most 4096 counts per overfull prefix while it splits it.
    """
    leaves: list[tuple[int, int]] = []  # first key, slices
    overfull, depth = [0], 0
    while overfull:
        below = min(depth + BITS_PER_PASS, 64)
        step = below - depth
        prefix = F.shiftrightunsigned("key", 64 - below) if below < 64 else F.col("key")
        rows = keys if depth == 0 else keys.where(F.shiftrightunsigned("key", 64 - depth).isin(_signed(overfull)))
        counts: dict[int, np.ndarray] = {p: np.zeros(1 << step, dtype=np.float64) for p in overfull}
        for row in rows.groupBy(prefix.alias("prefix")).agg(F.sum("bytes").alias("bytes")).collect():
            value = row.prefix % (1 << 64)
            counts[value >> step][value & ((1 << step) - 1)] = row.bytes
        again = []
        for parent in overfull:
            ends = np.concatenate([[0], np.cumsum(counts[parent])])
            stack = [(0, 1 << step)]
            while stack:
                low, width = stack.pop()
                held = ends[low + width] - ends[low]
                value = (parent << step) + low
                if held <= capacity or (width == 1 and below == 64):
                    leaves.append((value << (64 - below), max(1, int(np.ceil(held / capacity)))))
                elif width == 1:
                    again.append(value)
                else:
                    stack += [(low, width // 2), (low + width // 2, width // 2)]
        overfull, depth = again, below
    leaves.sort()
    slices = np.array([n for _, n in leaves], dtype=np.int64)
    return Directory(np.array([k for k, _ in leaves], dtype=np.uint64), np.cumsum(slices) - slices, slices)


def _signed(values: list[int]) -> list[int]:
    return [v - (1 << 64) if v >= 1 << 63 else v for v in values]


def _tagged(docs: DataFrame, text_col: str, names: list[str], key_of: Callable[[bytes], int], remembered: int) -> DataFrame:
    """The documents with row id, row id of an equal text in the same task, key and digest."""
    at = docs.columns.index(text_col)

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        heads: OrderedDict[bytes, tuple[int, bytes]] = OrderedDict()
        held = 0
        for batch in batches:
            texts = utf8(batch.column(at))
            first = row
            twins, keys, digests = [], [], []
            for text in texts:
                text = text.lower()
                digest = hashlib.sha256(text).digest()
                twin = row
                known = heads.get(digest)
                if known is None:
                    if len(text) <= remembered:
                        heads[digest] = (row, text)
                        held += len(text) + 200
                        while held > remembered:
                            held -= len(heads.popitem(last=False)[1][1]) + 200
                elif known[1] == text:
                    twin = known[0]
                    heads.move_to_end(digest)
                twins.append(twin)
                keys.append(key_of(digest))
                digests.append(digest.hex())
                row += 1
            added = [
                pa.array(np.arange(first, row, dtype=np.int64)),
                pa.array(twins, pa.int64()),
                pa.array(np.array(keys, dtype=np.uint64).view(np.int64)),
                pa.array(digests, pa.string()),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, *names])

    kinds = [T.LongType(), T.LongType(), T.LongType(), T.StringType()]
    return docs.mapInArrow(tag, extended(docs.schema, **dict(zip(names, kinds, strict=True))))


def _routed(directory: Directory):
    firsts, owners, slices = directory.firsts, directory.owners, directory.slices

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.asarray(batch.column("key")).view(np.uint64)
            rows = np.asarray(batch.column("row"))
            bucket = np.searchsorted(firsts, keys, side="right") - 1
            owner = owners[bucket] + (rows + (rows >> 33)) % slices[bucket]
            added = [pa.array(owner.astype(np.int32)), pa.array(slices[bucket] > 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "owner", "sliced"])

    return route


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row its chain head: the first row in key order with the same key and the same bytes."""
    key, links = None, []
    for batch in batches:
        heads, kept = [], []
        rows, keys = batch.column("row").to_pylist(), batch.column("key").to_pylist()
        sliced, owner = batch.column("sliced").to_pylist(), batch.column("owner")
        for i, (row, at, text) in enumerate(zip(rows, keys, utf8(batch.column("text")), strict=True)):
            text = text.lower()
            if at != key:
                key, links = at, []
            head = next((h for h, other in links if other == text), None)
            if head is None:
                head = row
                links.append((row, text))
            heads.append(head)
            kept.append(text if sliced[i] and head == row else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("key"), pa.array(heads, pa.int64()), batch.column("sliced"), pa.array(kept, pa.binary()), owner],
            names=["row", "key", "head", "sliced", "text", "owner"],
        )


_LINKS = "row long, key long, head long, sliced boolean, text binary, owner int"


def build_index(texts: DataFrame, capacity: int = BUCKET_BYTES) -> DataFrame:
    """The index of ``row, key, bytes, text``: ``row, key, head, owner``, in shared files, one owner task per bucket."""
    directory = build_directory(texts.select("key", "bytes"), capacity)
    routed = texts.select("row", "key", "text").mapInArrow(
        _routed(directory), "row long, key long, text string, owner int, sliced boolean"
    )
    owned = routed.repartitionById(directory.tasks, F.col("owner")).sortWithinPartitions("key", "row")
    links = saved(owned.mapInArrow(_chained, _LINKS), "dedup-index")
    if not (directory.slices > 1).any():
        return links.select("row", "key", "head", "owner")
    heads = links.where("sliced and row = head").select("row", "key", F.col("text").cast("string").alias("text"), "owner", "sliced")
    merged = heads.repartition("key").sortWithinPartitions("key", "row").mapInArrow(_chained, _LINKS)
    merged = saved(merged.select(F.col("row").alias("head"), F.col("head").alias("first")), "dedup-index-slices")
    return links.join(merged, "head", "left").select("row", "key", F.coalesce("first", "head").alias("head"), "owner")


def _grouped(docs: DataFrame, id_col: str, text_col: str, capacity: int, key_of: Callable[[bytes], int], remembered: int):
    """Written documents with row ids, their ids, heads of the texts that tasks sent, and per head its group's size and the row that stays."""
    row, twin, key, digest = fresh(docs, "_row", "_twin", "_key", "_sha256")
    tagged = saved(_tagged(docs, text_col, [row, twin, key, digest], key_of, remembered), "dedup-rows")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    heads = tagged.where(F.col(row) == F.col(twin)).select(
        F.col(row).alias("row"), F.col(key).alias("key"), (F.octet_length(text) + 64).cast("long").alias("bytes"), text.alias("text")
    )
    index = build_index(heads, capacity).select(F.col("row").alias("_twin"), F.col("head").alias("_head"))
    members = tagged.select(
        F.col(row).alias("_row"), F.col(twin).alias("_twin"), F.col(id_col).cast("long").alias("_id"), F.col(digest).alias("_sha256")
    )
    # A group is summed up per task that read some of it before its parts meet.
    stays = F.max(F.struct(F.col("_id").alias("id"), F.col("_row").alias("row"))).alias("_stays")
    parts = members.groupBy("_twin").agg(F.count("*").alias("_size"), stays)
    groups = parts.join(index, "_twin").groupBy("_head").agg(F.sum("_size").alias("_size"), F.max("_stays").alias("_stays"))
    return tagged, row, members, index, groups


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = BUCKET_BYTES,
    key_of: Callable[[bytes], int] = sha_key,
    remembered: int = REMEMBERED_BYTES,
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    A null text counts as empty, and all empty texts are equal. Of equal texts the row with the largest id stays; a null
    id comes before all others, so a group of null ids only has a null ``keep_id``. Rows that repeat with one id are
    separate rows of the group, of which one stays. An empty table gives an empty result. Other columns are ignored.
    ``key_of`` maps a text's SHA-256 to its 64-bit key; it may collide at will.
    """
    _, _, members, index, groups = _grouped(docs.select(id_col, text_col), id_col, text_col, capacity, key_of, remembered)
    # Rows learn of their group through the first equal row of their own task, so that no group meets in one task.
    return members.join(index.join(groups, "_head"), "_twin").select(
        F.col("_id").alias("doc_id"),
        F.col("_stays.id").alias("keep_id"),
        F.col("_size").alias("group_size"),
        (F.col("_stays.row") == F.col("_row")).alias("kept"),
        F.col("_sha256").alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = BUCKET_BYTES) -> DataFrame:
    """The documents with all their columns, one row for each group of equal texts, chosen as by ``exact_duplicates``."""
    tagged, row, _, _, groups = _grouped(docs, id_col, text_col, capacity, sha_key, REMEMBERED_BYTES)
    stays = groups.select(F.col("_stays.row").alias(row))
    return tagged.join(stays, row, "left_semi").select(*docs.columns)
