"""From files to all results: nested files, outputs, parsed mails and errors."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.functions.identity import dedupe_checksum
from docsift.functions.mail_columns import HTML, Renderer, file_metadata, mail_metadata
from docsift.functions.mime import identify_or_default
from docsift.operators.expand import Limits, Openers, errors_of, expand_levels, files_of, messages_of
from docsift.operators.extract import Extractor, embedded_outputs, error_rows, good_rows, process_files
from docsift.operators.routing import parse_types, unknown_types
from docsift.schemas import MAIL, PROCESS_TYPES, STORED
from docsift.session import staged
from docsift.sources.contents import INLINE_BYTES
from docsift.sources.files import plain_path, scan_files, scan_jobs
from docsift.sources.large import MOST_VALUE_BYTES, located_roots
from docsift.sources.registry import mime_registry, with_type_by_name


@dataclass(frozen=True)
class ProcessResult:
    """Lazy tables over what the run wrote to the shared folder."""

    files: DataFrame
    outputs: DataFrame
    errors: DataFrame
    messages: DataFrame
    # One row per file and metadata key: ``job_id, root_id, file_id, key, values``.
    metadata: DataFrame


def as_roots(
    files: DataFrame,
    types: list[str] | None = None,
    recurse: bool = True,
    registry: DataFrame | None = None,
    checksums: bool = True,
) -> DataFrame:
    """FILES rows for roots, from ``root_id, name, content`` and any of ``job_id, mimetype, types, recurse``.

    A missing MIME type is identified from content and name, with ``registry`` (see ``sources.registry``) for the name.
    Without ``checksums`` that of the roots is NULL: for those who open one level and want only what is in it.
    """
    have = set(files.columns)
    if "mimetype" not in have:
        files = files.withColumn("mimetype", F.lit(None).cast("string"))
    if "types" not in have:
        files = files.withColumn("types", F.array(*[F.lit(t) for t in types or ["all"]]))
    if "recurse" not in have:
        files = files.withColumn("recurse", F.lit(recurse))
    if "job_id" not in have:
        files = files.withColumn("job_id", F.col("root_id"))
    named = with_type_by_name(files, mime_registry(files.sparkSession) if registry is None else registry)
    mimetype = F.coalesce(F.col("mimetype"), identify_or_default(F.col("content"), F.col("type_by_name")))
    named = named.withColumn("mimetype", mimetype)
    return named.select(
        "job_id",
        "root_id",
        F.sha2(F.concat_ws("\x1f", "job_id", "root_id"), 256).alias("file_id"),
        F.lit(None).cast("string").alias("parent_id"),
        F.lit(0).alias("depth"),
        F.lit(0).cast("bigint").alias("ordinal"),
        F.array().cast("array<string>").alias("id_chain"),
        "name",
        "mimetype",
        (dedupe_checksum(F.col("content"), F.col("mimetype")) if checksums else F.lit(None).cast("string")).alias("checksum"),
        F.octet_length("content").cast("bigint").alias("length"),
        parse_types(F.col("types")).alias("types"),
        "recurse",
        F.lit(None).cast("string").alias("decoded"),
        "content",
        F.lit(None).cast(STORED.split(" ", 1)[1]).alias("stored"),
    )


def type_errors(files: DataFrame) -> DataFrame:
    """An error row for each root that asks for a process type that does not exist."""
    bad = unknown_types(F.col("types"))
    job = F.col("job_id") if "job_id" in files.columns else F.col("root_id")
    return files.where(F.size(bad) > 0).select(
        job.alias("job_id"),
        "root_id",
        F.lit(None).cast("string").alias("file_id"),
        F.lit("request").alias("stage"),
        F.lit(None).cast("string").alias("process_type"),
        F.lit("unknown_type").alias("error_class"),
        F.array_join(bad, ", ").alias("message"),
    )


def process(
    files: DataFrame,
    types: list[str] | None = None,
    recurse: bool = True,
    renderer: Renderer = HTML,
    extractors: Iterable[Extractor] = (),
    openers: Openers | None = None,
    limits: Limits | None = None,
    located: DataFrame | None = None,
    value_bytes: int = MOST_VALUE_BYTES,
    registry: DataFrame | None = None,
) -> ProcessResult:
    """Expand files to all depths and run the extractors each one is routed to.

    ``files`` holds one row per root: ``root_id, name, content``, and optionally ``job_id, mimetype, types, recurse``.
    ``located`` adds roots that are used where they lie (see ``sources.large``). Contents above ``limits.inline_bytes``
    that are found on the way are put into files of their own, and so are texts; ``stored`` tells where. What can only be
    read as a whole is read up to ``value_bytes``.
    """
    extractors = list(extractors)
    asked = [t.lower() for t in types or ["all"]]
    if unknown := set(asked) - {*PROCESS_TYPES, "all"}:
        raise ValueError(f"unknown process types: {', '.join(sorted(unknown))}")
    if "types" in files.columns or "all" in asked:
        asked = PROCESS_TYPES
    # Written once: inputs are read and hashed once, and every result table reads only its own columns after that.
    roots = staged(as_roots(files, types, recurse, registry), "roots")
    wrong = None
    if "types" in files.columns:
        # A request with an unknown type is refused as a whole.
        wrong = type_errors(files)
        known = F.array(*[F.lit(t) for t in PROCESS_TYPES])
        roots = roots.where(F.size(F.array_except("types", known)) == 0)
    if located is not None:
        roots = roots.unionByName(staged(located, "located"))
    limits = (limits or Limits()).with_folder(files.sparkSession)
    levels, any_stored = expand_levels(roots, openers, limits)
    nested, parsed = files_of(levels), messages_of(levels)
    # Without recursion the files found are results, but are not processed themselves.
    at_work = nested.where("recurse").unionByName(roots)
    here, elsewhere = at_work, None
    if any_stored or located is not None:
        here, elsewhere = at_work.where("stored is null"), at_work.where("stored is not null")
    rows = process_files(here, parsed, renderer, extractors, asked, elsewhere, limits.inline_bytes, value_bytes)
    errors = errors_of(levels).unionByName(error_rows(rows))
    if wrong is not None:
        errors = errors.unionByName(wrong)
    asks = F.array_contains("types", "metadata")
    own = ["job_id", "root_id", "file_id"]
    metadata = at_work.where(asks & (F.col("mimetype") != MAIL)).select(*own, F.explode(file_metadata(F.col("mimetype"))).alias("key", "values"))
    metadata = metadata.unionByName(parsed.where(asks).select(*own, F.explode(mail_metadata(F.col("headers"))).alias("key", "values")))
    digests = {
        "content_sha256": F.coalesce("stored.sha256", F.sha2("content", 256)),
        "content_md5": F.coalesce("stored.md5", F.md5("content")),
    }
    return ProcessResult(
        # The digests are computed when they are read, and only then.
        files=roots.unionByName(nested).withColumns(digests),
        outputs=good_rows(rows).unionByName(embedded_outputs(nested)),
        errors=errors,
        messages=parsed,
        metadata=metadata,
    )


def process_jobs(
    jobs: DataFrame, files: DataFrame, large_bytes: int = INLINE_BYTES, large_checksums: bool = True, **options
) -> ProcessResult:
    """Process the inputs of a table of jobs (``schemas.JOBS``), found in a scan of the folders they lie in.

    An input above ``large_bytes`` is not read into a row, but used where it lies.
    """
    roots, large, unread = scan_jobs(jobs, files, large_bytes)
    large = staged(large, "large-inputs")
    located = None
    if not large.isEmpty():
        wrong = type_errors(large)
        known = F.array(*[F.lit(t) for t in PROCESS_TYPES])
        large = large.where(F.size(F.array_except(parse_types(F.col("types")), known)) == 0)
        unread = unread.unionByName(wrong)
        located = located_roots(large, large_checksums, options.get("registry"))
    result = process(roots, located=located, **options)
    return replace(result, errors=result.errors.unionByName(unread))


def process_path(
    spark: SparkSession,
    path: str,
    types: list[str] | None = None,
    recurse: bool = True,
    glob: str | None = None,
    large_bytes: int = INLINE_BYTES,
    large_checksums: bool = True,
    **options,
) -> ProcessResult:
    """Process all files below a path. Those above ``large_bytes`` are used where they lie, archives and mailboxes by many tasks.

    The checksum of a large file is one task's work, as MD5 is sequential; ``large_checksums=False`` leaves it NULL
    instead, and types the file by its first megabytes. Checksums of what is inside are not affected.
    """
    types = types or ["all"]
    scanned = scan_files(spark, path, glob).withColumn("path", plain_path(F.col("path")))
    root, name = F.col("path").alias("root_id"), F.element_at(F.split("path", "/"), -1).alias("name")
    files = scanned.where(F.col("length") <= large_bytes).select(root, name, "content")
    listed = scanned.where(F.col("length") > large_bytes).select(
        F.col("path").alias("job_id"),
        root,
        name,
        "path",
        "length",
        F.lit(None).cast("string").alias("mimetype"),
        F.array(*[F.lit(t) for t in types]).alias("types"),
        F.lit(recurse).alias("recurse"),
    )
    located = None
    if not listed.isEmpty():
        located = located_roots(listed, large_checksums, options.get("registry"))
    return process(files, types, recurse, located=located, **options)
