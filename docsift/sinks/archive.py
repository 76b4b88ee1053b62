"""Export: the outputs of a root as one zip archive, however large it is.

Outputs are deflated where they are, so that they move as small as they are in an archive, and in rounds, so that only some of
them lie in a shuffle at a time. An archive of one part is written by one task. A larger one is cut into parts that many tasks
write as segments; each segment's entries are a table with their places in it. One task then joins the segments' bytes under
the archive's name: the places of the entries are sums over the segments before, and the directory follows, in the 64-bit form
where it has to be.
"""

from __future__ import annotations

import posixpath
import struct
import zipfile
import zlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.session import own_shuffles, staged
from docsift.sources.contents import read_pieces
from docsift.sources.large import dealt
from docsift.sources.zips import CENTRAL, DEFLATED, END, END_64, LOCATOR_64
from docsift.stores import open_store

MANIFEST = "job_id string, root_id string, path string, n_entries bigint, bytes bigint"
_SEGMENTS = (
    "job_id string, root_id string, part int, ordinal bigint, name string, crc bigint, compressed bigint, size bigint, offset bigint, "
    "segment string, segment_bytes bigint, whole string"
)

_PACKED = (
    "job_id string, root_id string, archive_path string, parts int, part int, data binary, place string, crc bigint, size bigint"
)

# Bytes and entries of a part, so that roots of very many small outputs are cut as well.
PART_BYTES, PART_ENTRIES = 256 << 20, 250_000

# Each round reads all outputs and moves its share of them, so rounds are few, and have a task per core at least.
MOST_ROUNDS = 4

# All entries carry the earliest time a zip can hold, so that archives of equal content are equal. Names
# that are not ASCII are UTF-8, sizes follow the data, and so they may have 64 bits.
ENTRY_TIME = (1980, 1, 1, 0, 0, 0)
_DOS_DATE, _SIZES_FOLLOW, _UTF8_NAME, _VERSION, _UNIX = 0x21, 0x08, 0x800, 45, 3
_ATTRIBUTES = 0o600 << 16
_SIZES = b"PK\x07\x08"
_MOST_16, _MOST_32 = 0xFFFF, 0xFFFFFFFF


def with_part(outputs: DataFrame, part_bytes: int, part_entries: int = PART_ENTRIES) -> tuple[DataFrame, int]:
    """Add ``part`` and ``parts``, and how many tasks the bytes ask for: an output's part goes by a hash of its path.

    Only roots that need several parts are listed, of which there is at most one per ``part_bytes`` of data and one per
    ``part_entries`` outputs. Whether that table is sent to all tasks is left to Spark, which knows its size.
    """
    sized = outputs.groupBy("job_id", "root_id").agg(F.sum("length").alias("bytes"), F.count("*").alias("n"))
    parts = F.greatest(F.ceil(F.col("bytes") / part_bytes), F.ceil(F.col("n") / part_entries), F.lit(1))
    sized = staged(sized.select("job_id", "root_id", "bytes", parts.cast("int").alias("parts")), "archive-sizes")
    units = sized.agg(F.sum(F.when(F.col("parts") > 1, F.col("parts"))).alias("cut"), F.sum("bytes").alias("bytes")).first()
    cores = outputs.sparkSession.sparkContext.defaultParallelism
    tasks = cores + (units.cut or 0) + (units.bytes or 0) // part_bytes
    # A table of its own, as Spark goes by the size of a table before it is filtered: joined otherwise, all contents would move.
    several = staged(sized.where("parts > 1").drop("bytes"), "archive-parts")
    joined = outputs.join(several, ["job_id", "root_id"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    return joined.withColumn("part", F.pmod(F.xxhash64("archive_path"), F.col("parts")).cast("int")), tasks


def write_archives(outputs: DataFrame, path: str, part_bytes: int = PART_BYTES, part_entries: int = PART_ENTRIES) -> DataFrame:
    """Write one zip per root of a job and return the manifest rows, a table next to the archives.

    Entry names are the archive paths. An archive is written under a temporary name and renamed when it is complete.
    """
    spark = outputs.sparkSession
    data = F.coalesce(F.col("content"), F.encode("text", "UTF-8"))
    place = F.col("stored.location") if "stored" in outputs.columns else F.lit(None).cast("string")
    rows, tasks = with_part(
        outputs.select("job_id", "root_id", "archive_path", "length", data.alias("data"), place.alias("place")), part_bytes, part_entries
    )
    key = ["job_id", "root_id", "part"]
    rows = rows.select("job_id", "root_id", "archive_path", "parts", "part", "data", "place")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        store, base = open_store(path)
        store.create_dir(posixpath.join(base, "archives"), recursive=True)
        store.create_dir(posixpath.join(base, "_segments"), recursive=True)
        current, several, archive, stream, place = None, False, None, None, None

        def finish() -> pa.RecordBatch:
            # The data ends here; the directory that closing adds is not part of a segment.
            end = stream.tell()
            infos = archive.infolist()
            archive.close()
            stream.close()
            job, root, part = current
            segment, whole = None, None
            if several:
                segment = f"{path.rstrip('/')}/_segments/{posixpath.basename(place)}"
            else:
                whole = f"{path.rstrip('/')}/archives/{_archive_name(job, root)}"
                store.move(place, posixpath.join(base, "archives", _archive_name(job, root)))
            found = [(i, e.filename, e.CRC, e.compress_size, e.file_size, e.header_offset) for i, e in enumerate(infos)]
            return _batch([(job, root, part, *e, segment, end, whole) for e in found], _SEGMENT_TYPES)

        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in key), strict=True)
            names, contents = batch.column("archive_path").to_pylist(), batch.column("data")
            places, parts, crcs, sizes = (batch.column(c).to_pylist() for c in ("place", "parts", "crc", "size"))
            for i, found in enumerate(keys):
                if found != current:
                    if current is not None:
                        yield finish()
                    current, several = found, parts[i] > 1
                    # Listings leave out names that begin with an underscore, so an unfinished archive is not seen.
                    partial = f"_{attempt}.{_archive_name(*found[:2])}"
                    place = posixpath.join(base, "_segments" if several else "archives", f"{partial}.{found[2]}" if several else partial)
                    stream = store.open_output_stream(place)
                    archive = zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED, allowZip64=True)
                if places[i] is None:
                    _add_deflated(archive, _entry(names[i]), contents[i].as_py(), crcs[i], sizes[i])
                    continue
                with archive.open(_entry(names[i]), "w", force_zip64=True) as entry:
                    for piece in read_pieces(places[i]):
                        entry.write(piece)
        if current is not None:
            yield finish()

    rounds = rounds_of(tasks, spark.sparkContext.defaultParallelism)
    segments = []
    for i in range(rounds):
        mine = rows.where(F.pmod(F.xxhash64(*key), F.lit(rounds)) == i) if rounds > 1 else rows
        packed = dealt(mine.mapInArrow(_deflated, _PACKED), -(-tasks // rounds), *key).sortWithinPartitions(*key, "archive_path")
        segments.append(staged(packed.mapInArrow(write, _SEGMENTS), "segments"))
    segments = reduce(DataFrame.unionByName, segments)
    rows = segments.where("segment is null").groupBy("job_id", "root_id", F.col("whole").alias("path"))
    rows = rows.agg(F.count("*").alias("n_entries"), F.sum("size").alias("bytes"))
    cut = segments.where("segment is not null")
    archives = cut.select("job_id", "root_id").distinct().count()
    joined = dealt(cut, archives, "job_id", "root_id").sortWithinPartitions(*key, "ordinal").mapInArrow(_joined(path), MANIFEST)
    manifest = rows.unionByName(joined) if archives else rows
    with own_shuffles(spark):
        manifest.write.mode("overwrite").parquet(f"{path}/manifest")
    _delete(spark, f"{path}/_segments")
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def rounds_of(tasks: int, cores: int) -> int:
    return min(max(tasks // cores, 1), MOST_ROUNDS)


def _deflated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Outputs with their data deflated, its CRC and size; those with a file of their own are left to who writes them."""
    for batch in batches:
        found = []
        for value, place in zip(batch.column("data"), batch.column("place").to_pylist(), strict=True):
            if place is not None:
                found.append((None, None, None))
                continue
            raw = memoryview(value.as_buffer()) if value.is_valid else b""
            # As zipfile does it.
            press = zlib.compressobj(zlib.Z_DEFAULT_COMPRESSION, zlib.DEFLATED, -zlib.MAX_WBITS)
            found.append((press.compress(raw) + press.flush(), zlib.crc32(raw), len(raw)))
        data, crcs, sizes = zip(*found, strict=True) if found else ((), (), ())
        new = {"data": pa.array(data, pa.binary()), "crc": pa.array(crcs, pa.int64()), "size": pa.array(sizes, pa.int64())}
        names = ["job_id", "root_id", "archive_path", "parts", "part", "data", "place", "crc", "size"]
        yield pa.RecordBatch.from_arrays([new[n] if n in new else batch.column(n) for n in names], names=names)


def _add_deflated(archive: zipfile.ZipFile, info: zipfile.ZipInfo, data: bytes, crc: int, size: int) -> None:
    """Add an entry that is deflated already to an archive that is written as a stream, in the form zipfile gives it."""
    info.CRC, info.compress_size, info.file_size = crc, len(data), size
    info.flag_bits, info.external_attr, info.header_offset = _SIZES_FOLLOW, _ATTRIBUTES, archive.fp.tell()
    archive.fp.write(info.FileHeader(zip64=False))
    archive.fp.write(data)
    archive.fp.write(struct.pack("<4sLLL", _SIZES, crc, len(data), size))
    archive.filelist.append(info)
    archive.NameToInfo[info.filename] = info
    archive.start_dir = archive.fp.tell()


def _joined(path: str):
    """Joins the segments of archives, whose entries come in order; one entry and one piece of bytes are held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        store, base = open_store(path)
        current, writer = None, None
        for batch in batches:
            for row in batch.to_pylist():
                found = row["job_id"], row["root_id"]
                if found != current:
                    if writer is not None:
                        yield _batch([(*current, *writer.finish())], _MANIFEST_TYPES)
                    current = found
                    name = _archive_name(*found)
                    final, partial = (posixpath.join(base, "archives", n) for n in (name, f"_{attempt}.{name}"))
                    writer = _Joiner(store, final, partial, f"{path.rstrip('/')}/archives/{name}")
                writer.add(row)
        if writer is not None:
            yield _batch([(*current, *writer.finish())], _MANIFEST_TYPES)

    return run


class _Joiner:
    def __init__(self, store: fs.FileSystem, final: str, partial: str, shown: str):
        self.store, self.final, self.partial, self.shown = store, final, partial, shown
        self.stream = store.open_output_stream(partial)
        # The directory comes last, but is known as entries pass: it waits in a file of its own.
        self.waiting = f"{partial}.directory"
        self.directory = store.open_output_stream(self.waiting)
        self.segment, self.base, self.at, self.directory_bytes, self.n, self.bytes = None, 0, 0, 0, 0, 0

    def add(self, row: dict) -> None:
        if row["segment"] != self.segment:
            self.segment, self.base = row["segment"], self.at
            for piece in read_pieces(self.segment, 0, row["segment_bytes"]):
                self.stream.write(piece)
            self.at += row["segment_bytes"]
        record = directory_record(row["name"], row["crc"], row["compressed"], row["size"], self.base + row["offset"])
        self.directory.write(record)
        self.directory_bytes += len(record)
        self.n, self.bytes = self.n + 1, self.bytes + row["size"]

    def finish(self) -> tuple[str, int, int]:
        self.directory.close()
        with self.store.open_input_stream(self.waiting) as stream:
            while piece := stream.read(1 << 20):
                self.stream.write(piece)
        self.stream.write(end_of_archive(self.n, self.directory_bytes, self.at))
        self.stream.close()
        self.store.delete_file(self.waiting)
        self.store.move(self.partial, self.final)
        return self.shown, self.n, self.bytes


def directory_record(name: str, crc: int, compressed: int, size: int, offset: int) -> bytes:
    """An entry's record in the directory, as the zip format has it; numbers that need more than 32 bits go into its extra field."""
    raw = name.encode()
    flags = _SIZES_FOLLOW | (0 if name.isascii() else _UTF8_NAME)
    long = [v for v in (size, compressed, offset) if v >= _MOST_32]
    extra = struct.pack(f"<HH{len(long)}Q", 1, 8 * len(long), *long) if long else b""
    size, compressed, offset = (min(v, _MOST_32) for v in (size, compressed, offset))
    head = struct.pack(
        "<4sBBHHHHHLLLHHHHHLL",
        CENTRAL, _VERSION, _UNIX, _VERSION, flags, DEFLATED, 0, _DOS_DATE, crc, compressed, size, len(raw), len(extra), 0, 0, 0, _ATTRIBUTES, offset,
    )
    return head + raw + extra


def end_of_archive(n: int, size: int, offset: int) -> bytes:
    """The records after a directory of ``n`` entries and ``size`` bytes that begins at ``offset``."""
    out = b""
    if n >= _MOST_16 or size >= _MOST_32 or offset >= _MOST_32:
        out += struct.pack("<4sQHHLLQQQQ", END_64, 44, _VERSION, _VERSION, 0, 0, n, n, size, offset)
        out += struct.pack("<4sLQL", LOCATOR_64, 0, offset + size, 1)
    return out + struct.pack("<4sHHHHLLH", END, 0, 0, min(n, _MOST_16), min(n, _MOST_16), min(size, _MOST_32), min(offset, _MOST_32), 0)


_SEGMENT_TYPES = {
    "job_id": pa.string(), "root_id": pa.string(), "part": pa.int32(), "ordinal": pa.int64(), "name": pa.string(), "crc": pa.int64(),
    "compressed": pa.int64(), "size": pa.int64(), "offset": pa.int64(), "segment": pa.string(), "segment_bytes": pa.int64(), "whole": pa.string(),
}
_MANIFEST_TYPES = {"job_id": pa.string(), "root_id": pa.string(), "path": pa.string(), "n_entries": pa.int64(), "bytes": pa.int64()}


def _batch(rows: list[tuple], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values(), strict=True)], names=list(types))


def _entry(name: str) -> zipfile.ZipInfo:
    # Names of attachments come from mails; none may lead out of the folder an archive is unpacked in.
    steps = [s for s in name.split("/") if s not in ("", ".", "..")]
    info = zipfile.ZipInfo("/".join(steps), ENTRY_TIME)
    info.compress_type = zipfile.ZIP_DEFLATED
    return info


def _archive_name(job_id: str, root_id: str) -> str:
    return f"{_file_name(root_id) if job_id == root_id else _file_name(job_id) + '.' + _file_name(root_id)}.zip"


def _file_name(root_id: str) -> str:
    return "".join(c if c.isalnum() or c in "-_" else f"%{ord(c):x}" for c in root_id)


def _delete(spark, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def publish(manifest: DataFrame, jobs: DataFrame) -> DataFrame:
    """Copy each root's archive to its job's ``output_uri``, one task per archive. Returns ``job_id, root_id, uri, bytes``.

    Copied when it is called, and once: what it returns is a written table, however often that is read.
    """
    copies = manifest.join(jobs.select("job_id", F.col("output_uri").alias("uri")), "job_id").select("job_id", "root_id", "path", "uri")

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = []
            for source, uri in zip(batch.column("path").to_pylist(), batch.column("uri").to_pylist()):
                from_store, from_path = open_store(source)
                to_store, to_path = open_store(uri)
                to_store.create_dir(posixpath.dirname(to_path), recursive=True)
                # copy_files streams in chunks, so an archive of any size passes through little memory.
                fs.copy_files(from_path, to_path, from_store, to_store)
                sizes.append(to_store.get_file_info(to_path).size)
            yield pa.RecordBatch.from_arrays(
                [batch.column("job_id"), batch.column("root_id"), batch.column("uri"), pa.array(sizes, pa.int64())],
                names=["job_id", "root_id", "uri", "bytes"],
            )

    n = manifest.count()
    return staged(dealt(copies, n, "job_id", "path").mapInArrow(copy, "job_id string, root_id string, uri string, bytes bigint"), "published")
