"""Contents that are files of their own: archives and mailboxes whose members are read by many tasks, and their texts.

Inputs above a size are used where they lie; what is found in them and is as large was stored while it was unpacked (see
``sources.contents``). Both are read by place and range, so no content has to fit into a row or a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from docsift.operators.openers import Limits, Openers, opened_row, unquoted
from docsift.operators.routing import parse_types
from docsift.operators.skew import join_to_small
from docsift.schemas import EXPANDED, LOOK_STRUCT, MAIL, MBOX, STORED, ZIP
from docsift.session import new_run_dir, staged
from docsift.sources.contents import decoded_pieces, kept_content, look_at, looked_checksum, looked_type, read_pieces
from docsift.sources.registry import mime_registry, with_type_by_name
from docsift.sources.zips import Entry, Reader, content_of
from docsift.sources.zips import entries as entries_of
from docsift.stores import open_store

# A mailbox is read in ranges of this size, and a range in steps of the other.
RANGE_BYTES = 64 << 20
READ_BYTES = 4 << 20
# Compressed bytes of archive entries that are one unit of work, and what an entry costs beside its bytes.
UNIT_BYTES, ENTRY_COST = 64 << 20, 4096
# Tasks of a stage per core at most; a task takes several units then.
TASKS_PER_CORE = 16
# Tasks per core that texts with files of their own are dealt to.
TEXT_TASKS_PER_CORE = 4
# A value holds at most 2 GiB.
MOST_VALUE_BYTES = 2_000_000_000

_LISTED = (
    "path string, ordinal bigint, name string, method int, flags int, crc bigint, compressed bigint, size bigint, offset bigint, "
    "before bigint, error string"
)
_MEMBERS = (
    f"path string, record string, ordinal bigint, child_name string, content binary, location string, look {LOOK_STRUCT}, "
    "error_class string, message string"
)


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def dealt(rows: DataFrame, units: int, *keys: str) -> DataFrame:
    """Rows that stand for much work each, in as many partitions as there are units of it.

    The number is given, as a plan that goes by the rows' own few bytes would put them all into one.
    """
    most = TASKS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(min(max(units, 1), most), *keys)


def looks(files: DataFrame, checksums: bool = True) -> DataFrame:
    """``path, look`` of files (``path, is_mail``), each read once from its beginning to its end by one task.

    MD5 is sequential, so a file is one task's work; it is read in pieces and never held. Without ``checksums`` only a
    file's beginning is looked at, and its type goes by that.
    """

    kind = _arrow(f"look {LOOK_STRUCT}").field("look").type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, is_mail in zip(batch.column("path").to_pylist(), batch.column("is_mail").to_pylist(), strict=True):
                found = look_at(path, bool(is_mail)) if checksums else look_at(path, bool(is_mail), READ_BYTES)
                row = found.__dict__ if checksums else {**found.__dict__, "checksum": None, "mail_checksum": None, "sha256": None, "md5": None}
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([row], kind)], names=["path", "look"])

    paths = files.groupBy("path").agg(F.max("is_mail").alias("is_mail"))
    return dealt(paths, paths.count(), "path").mapInArrow(run, f"path string, look {LOOK_STRUCT}")


def located_roots(files: DataFrame, checksums: bool = True, registry: DataFrame | None = None) -> DataFrame:
    """FILES rows of inputs that are used where they lie: ``job_id, root_id, name, path, length, mimetype, types, recurse``."""
    named = with_type_by_name(files, mime_registry(files.sparkSession) if registry is None else registry)
    named = staged(named.withColumn("is_mail", F.coalesce(F.coalesce("mimetype", "type_by_name") == MAIL, F.lit(False))), "large")
    rows = named.join(staged(looks(named, checksums), "looks"), "path")
    mimetype = F.coalesce(F.col("mimetype"), looked_type(F.col("look"), F.col("type_by_name")))
    return rows.withColumn("mimetype", mimetype).select(
        "job_id",
        "root_id",
        F.sha2(F.concat_ws("\x1f", "job_id", "root_id"), 256).alias("file_id"),
        F.lit(None).cast("string").alias("parent_id"),
        F.lit(0).alias("depth"),
        F.lit(0).cast("bigint").alias("ordinal"),
        F.array().cast("array<string>").alias("id_chain"),
        "name",
        "mimetype",
        looked_checksum(F.col("look"), F.col("mimetype")).alias("checksum"),
        "length",
        parse_types(F.col("types")).alias("types"),
        "recurse",
        F.lit(None).cast("string").alias("decoded"),
        F.lit(None).cast("binary").alias("content"),
        F.struct(F.col("path").alias("location"), F.col("look.sha256").alias("sha256"), F.col("look.md5").alias("md5")).alias("stored"),
    )


def archive_members(archives: DataFrame, limits: Limits | None = None) -> DataFrame:
    """``path, record, ordinal, child_name, content, location, look, error_class, message`` of the entries of zip files.

    The directory of an archive is read once, in a stream, into a table of entries with their places. Runs of entries
    with about as many compressed bytes are units of work, so a single archive with most of all entries is read by the
    whole cluster, and a task goes to the places of its entries. An entry above the limit is unpacked into a file of its
    own and never held.
    """
    limits = (limits or Limits()).with_folder(archives.sparkSession)
    listing, found = _arrow(_LISTED), _arrow(_MEMBERS)

    def list_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows = []
                try:
                    with _open(path) as stream:
                        # Looked through once before, as a damaged directory gives no entry at all.
                        for _ in entries_of(_reader(stream), stream.size()):
                            pass
                        for entry in entries_of(_reader(stream), stream.size()):
                            rows.append({"path": path, **entry.__dict__})
                            if len(rows) == 10_000:
                                yield pa.RecordBatch.from_pylist(rows, schema=listing)
                                rows = []
                except Exception as e:  # noqa: BLE001 - any fault of untrusted bytes
                    rows = [{"path": path, "ordinal": 0, "before": 0, "error": f"{type(e).__name__}: {e}"}]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=listing)

    def read_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_path, stream = None, None
        for batch in batches:
            rows, held = [], 0
            for member in batch.to_pylist():
                path, error = member.pop("path"), member.pop("error")
                member.pop("unit")
                where = {"path": path, "ordinal": member["ordinal"]}
                if error is not None:
                    row = {"record": "error", "error_class": "bad_container", "message": error}
                else:
                    entry = Entry(**member)
                    try:
                        if path != open_path:
                            stream, open_path = _open(path), path
                        row = opened_row(entry.name, entry.size, lambda: content_of(_reader(stream), entry), limits)  # noqa: B023 - used at once
                    except Exception as e:  # noqa: BLE001 - a file that went away or changed since it was listed
                        row = {"record": "error", "error_class": "bad_entry", "message": f"{entry.name}: {e}", "child_name": entry.name}
                rows.append({**where, **row})
                held += 200 + len(row.get("content") or b"")
                if held >= limits.batch_bytes:
                    yield pa.RecordBatch.from_pylist(rows, schema=found)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=found)

    paths = archives.select("path").distinct()
    listed = staged(dealt(paths, paths.count(), "path").mapInArrow(list_entries, _LISTED), "directories")
    unit = F.floor((F.col("before") + F.col("ordinal") * ENTRY_COST) / UNIT_BYTES)
    listed = listed.withColumn("unit", unit)
    units = listed.select("path", "unit").distinct().count()
    spread = dealt(listed, units, "path", "unit").sortWithinPartitions("path", "ordinal")
    return spread.mapInArrow(read_entries, _MEMBERS)


def _open(path: str):
    store, name = open_store(path)
    return store.open_input_file(name)


def _reader(stream) -> Reader:
    def read(at: int, size: int) -> bytes:
        stream.seek(at)
        return stream.read(size)

    return read


def mailbox_members(mailboxes: DataFrame, range_bytes: int = RANGE_BYTES, limits: Limits | None = None) -> DataFrame:
    """``path, ordinal, content, location, look`` of the messages of mailboxes (``path, length``), and an error row without any.

    A mailbox is cut into byte ranges, which are rows of their own and spread over tasks. A task reads the messages that
    start in its range, the last of them to its end beyond it; a message above the limit goes into a file of its own and
    is never held. Counts per range then give each message its place.
    """
    limits = (limits or Limits()).with_folder(mailboxes.sparkSession)
    mailboxes = mailboxes.select("path", "length").distinct()
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(range_bytes).cast("long"))
    ranges = mailboxes.select("path", F.explode(starts).alias("start"))
    schema = f"path string, start long, place long, content binary, location string, look {LOOK_STRUCT}"

    arrow = _arrow(schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                rows, held = [], 0
                for place, pieces in enumerate(_messages(path, start, start + range_bytes)):
                    kept = kept_content(pieces, limits.folder, limits.inline_bytes, is_mail=True)
                    rows.append({"path": path, "start": start, "place": place, **kept})
                    held += 200 + len(kept.get("content") or b"")
                    if held >= limits.batch_bytes:
                        yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    found = staged(dealt(ranges, ranges.count(), "path", "start").mapInArrow(read, schema), "mailbox")
    counts = found.groupBy("path", "start").agg(F.count("*").alias("n"))
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("path", "start", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ordinal = (F.col("first") + F.col("place")).alias("ordinal")
    placed = found.join(firsts, ["path", "start"]).select("path", ordinal, "content", "location", "look")
    empty = mailboxes.select("path").join(counts.select("path").distinct(), "path", "left_anti").select(
        "path", F.lit("error").alias("record"), F.lit("bad_container").alias("error_class"), F.lit("ValueError: no message separator").alias("message")
    )
    return placed.withColumn("record", F.lit("child")).unionByName(empty, allowMissingColumns=True)


def _messages(path: str, start: int, stop: int) -> Iterator[Iterator[bytes]]:
    """Messages, in pieces, whose separator line starts at a place from ``start`` and before ``stop``.

    The pieces of a message are read before the next message is asked for.
    """
    reader = _Mailbox(path, start)
    while reader.at_separator(stop):
        message = reader.message()
        yield message
        for _ in message:
            pass


class _Mailbox:
    """A mailbox from a place on, of which a part of a message is held at most.

    The first byte held is a line feed where a line begins after it, and stands for the line before it.
    """

    def __init__(self, path: str, start: int):
        at = max(start - 1, 0)
        self.pieces = read_pieces(path, at, step=READ_BYTES)
        # A line feed stands for the beginning of the file, so that every separator follows one.
        self.held = bytearray(b"" if start else b"\n")
        self.offset = at - len(self.held)

    def _more(self) -> bool:
        piece = next(self.pieces, b"")
        self.held += piece
        return bool(piece)

    def _drop(self, n: int) -> None:
        del self.held[:n]
        self.offset += n

    def at_separator(self, stop: int) -> bool:
        """Go to the next separator line, if one begins before ``stop``."""
        while (found := self.held.find(b"\nFrom ")) < 0:
            self._drop(max(0, len(self.held) - 5))
            if self.offset + 1 >= stop or not self._more():
                return False
        self._drop(found)
        return self.offset + 1 < stop

    def message(self) -> Iterator[bytes]:
        """The message after the separator line that is held, quoted separator lines restored."""
        at = 1
        while (end := self.held.find(b"\n", at)) < 0:
            at = len(self.held)
            if not self._more():
                self._drop(at)
                return
        self._drop(end)
        while (found := self.held.find(b"\nFrom ")) < 0:
            if len(self.held) >= max(READ_BYTES, 64):
                # The last line waits, as a separator or a quoted one may be cut; but for a very long one, which is neither.
                line = self.held.rfind(b"\n")
                cut = line if line > 0 else len(self.held) - 1
                yield unquoted(bytes(self.held[: cut + 1]))[1:]
                self._drop(cut)
            if not self._more():
                yield unquoted(bytes(self.held))[1:]
                self._drop(len(self.held))
                return
        yield unquoted(bytes(self.held[: found + 1]))[1:]
        self._drop(found)


def _carried(containers: DataFrame) -> DataFrame:
    return containers.select(
        "job_id", "root_id", "file_id", "depth", "id_chain", "name", "mimetype", "checksum", "types", "recurse", F.col("stored.location").alias("path")
    )


def _in_parts(openers: Openers) -> list[str]:
    """The formats of large containers that are read by many tasks: archives and mailboxes, unless a user's opener reads them."""
    return [kind for kind in (ZIP, MBOX) if openers.by_type.get(kind) is Openers().by_type[kind]]


def opened_as_a_whole(containers: DataFrame, openers: Openers) -> DataFrame:
    """Of containers with a file of their own, those that an opener needs as a value, and that fit into one."""
    whole = F.col("mimetype").isin(*openers.by_type) & ~F.col("mimetype").isin(*_in_parts(openers))
    return containers.where(whole & F.col("stored").isNotNull() & (F.col("length") <= MOST_VALUE_BYTES))


def located_members(containers: DataFrame, openers: Openers, limits: Limits) -> DataFrame:
    """EXPANDED rows of containers with their content in a file of their own: archives and mailboxes, by many tasks each.

    A container of a format that can only be opened as a whole, and does not fit into a value, is an error row.
    """
    parts = _in_parts(openers)
    asked = containers.where(F.array_contains("types", "embedded") & F.col("mimetype").isin("", *parts))
    archives = asked.where(F.col("mimetype") == ZIP).select(F.col("stored.location").alias("path"))
    boxes = asked.where(F.col("mimetype") == MBOX).select(F.col("stored.location").alias("path"), "length")
    found = archive_members(archives, limits).unionByName(mailbox_members(boxes, limits=limits), allowMissingColumns=True)
    rows = join_to_small(found, _carried(asked), ["path"], "ordinal").drop("path")
    whole = containers.where(F.col("mimetype").isin(*openers.by_type) & ~F.col("mimetype").isin(*parts) & (F.col("length") > MOST_VALUE_BYTES))
    too_large = _carried(whole).drop("path").withColumns(
        {
            "record": F.lit("error"),
            "ordinal": F.lit(0).cast("bigint"),
            "error_class": F.lit("too_large"),
            "message": F.concat(F.col("name"), F.lit(": such a file is opened as a whole")),
        }
    )
    rows = rows.unionByName(too_large, allowMissingColumns=True)
    have = set(rows.columns)
    wanted = StructType.fromDDL(EXPANDED)
    return rows.select(*[F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in wanted])


def with_values(files: DataFrame) -> DataFrame:
    """FILES rows with their content read from its own file, for readers that need it whole; it has to fit into a value."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column("stored").field("location").to_pylist()
            at = batch.schema.get_field_index("content")
            for i, place in enumerate(places):
                row = batch.slice(i, 1)
                content = pa.array([b"".join(read_pieces(place))], pa.binary())
                yield row.set_column(at, "content", content)

    # A value now, like any other.
    return files.mapInArrow(read, files.schema).withColumn("stored", F.lit(None).cast(files.schema["stored"].dataType))


def located_texts(files: DataFrame, inline_bytes: int) -> DataFrame:
    """``text, kept, bytes`` beside the rows of text files that have a file of their own (``stored``).

    A file is decoded in pieces by one task; a text above the limit is a file of its own again.
    """
    folder = new_run_dir(files.sparkSession, "texts", kept=True)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema]
    schema = StructType.fromDDL(", ".join([*fields, "text string", STORED.replace("stored", "kept", 1), "bytes bigint"]))

    kind = to_arrow_schema(schema).field("kept").type

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, place in enumerate(batch.column("stored").field("location").to_pylist()):
                pieces = (t.encode("utf-8", "replace") for t in decoded_pieces(read_pieces(place)) if t)
                found = kept_content(pieces, folder, inline_bytes, digests_only=True)
                content, look = found.get("content"), found.get("look")
                kept = None if look is None else {"location": found["location"], "sha256": look["sha256"], "md5": look["md5"]}
                text = None if content is None else content.decode()
                n = len(content) if look is None else look["length"]
                arrays = [*batch.slice(i, 1).columns, pa.array([text], pa.string()), pa.array([kept], kind), pa.array([n], pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, "text", "kept", "bytes"])

    # Rows are narrow and stand for a file each, so splits by their bytes would leave most files to one task.
    cores = files.sparkSession.sparkContext.defaultParallelism
    return dealt(files, TEXT_TASKS_PER_CORE * cores, "file_id").mapInArrow(read, schema)
