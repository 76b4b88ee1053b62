"""Routed files to processed outputs: text, metadata and rendered mail, with errors as rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docsift.functions.mail_columns import (
    HTML,
    Renderer,
    extracted_text,
    file_metadata,
    mail_metadata,
    metadata_json,
    metadata_key,
    render,
)
from docsift.functions.paths import archive_path
from docsift.functions.text import html_to_text, text_of
from docsift.operators.routing import route, routing_rules
from docsift.schemas import ERRORS, MAIL, OUTPUTS, PROCESS_TYPES, STORED
from docsift.sources.contents import INLINE_BYTES
from docsift.sources.large import MOST_VALUE_BYTES, located_texts, with_values

# Name and MIME type of the output of each process type.
PROCESSED = {
    "text": ("extracted.txt", "text/plain"),
    "metadata": ("metadata.json", "application/json"),
    "pdf": ("rendered.html", "text/html"),
}

_TYPE_OF = {"default_text": "text", "default_metadata": "metadata", "rfc822_render": "pdf"}


@dataclass(frozen=True)
class Extractor:
    """A user's extractor: gets pandas frames of ``file_id, content`` and yields ``file_id, text, error``.

    It is called once per batch of rows.
    """

    name: str
    process_type: str
    mimetypes: tuple[str, ...]
    function: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]

    def rules(self) -> list[tuple[str, str, str]]:
        return [(self.process_type, m, self.name) for m in self.mimetypes]


def file_text(content: Column, mimetype: Column, decoded: Column | None = None) -> Column:
    """Text of a file that is not a mail; NULL for a format that has no text reader here.

    ``decoded`` is its text where that is known already, by a charset declared outside of it.
    """
    text = text_of(content) if decoded is None else F.coalesce(decoded, text_of(content))
    return F.when(mimetype == "text/html", html_to_text(text)).when(mimetype.startswith("text/"), text)


def process_files(
    files: DataFrame,
    parsed: DataFrame,
    renderer: Renderer = HTML,
    extractors: Iterable[Extractor] = (),
    types: Iterable[str] = PROCESS_TYPES,
    located: DataFrame | None = None,
    inline_bytes: int = INLINE_BYTES,
    value_bytes: int = MOST_VALUE_BYTES,
) -> DataFrame:
    """Run the routed extractors. Returns OUTPUTS columns and ``error_class, message`` of those that failed.

    Mails come parsed (see ``expand``), so their text, metadata and rendering share one parse; each process type reads
    only the columns it needs, and nothing is joined or shuffled. ``types`` names all types that some file asks for.

    ``located`` are files whose content is a file of its own. Their plain texts are read in pieces, whatever their size.
    HTML and users' extractors need a content whole: up to ``value_bytes`` it is read into its row, beyond that the file
    is an error row.
    """
    extractors, types = list(extractors), set(types) - {"embedded"}
    rules = routing_rules(files.sparkSession, [r for e in extractors for r in e.rules()])
    own = [e.name for e in extractors]
    mimetype, headers, parts = F.col("mimetype"), F.col("headers"), F.col("parts")

    def native(routed: DataFrame, readers: dict[str, Callable[[], Column]], unsupported: Column) -> DataFrame:
        """Rows of the built-in extractors. What is unsupported shows from the type, so error rows read no content."""
        text = F.lit(None).cast("string")
        for extractor, reader in readers.items():
            if _TYPE_OF[extractor] in types:
                text = F.when(F.col("extractor") == extractor, reader()).otherwise(text)
        wanted = F.col("process_type").isin(*types) & ~F.col("extractor").isin(*own)
        rows = routed.where(wanted).select(*_lineage(), text.alias("text"))
        return rows.withColumns(
            {
                "error_class": F.when(unsupported, F.lit("unsupported_type")),
                "message": F.when(unsupported, mimetype),
            }
        )

    from_content = {
        "default_text": lambda: file_text(F.col("content"), mimetype, F.col("decoded")),
        "default_metadata": lambda: metadata_json(file_metadata(mimetype)),
    }
    from_mail = {
        "default_text": lambda: extracted_text(parts),
        "default_metadata": lambda: metadata_json(mail_metadata(headers)),
        "rfc822_render": lambda: render(headers, parts, renderer),
    }
    no_reader = (F.col("process_type") == "text") & ~mimetype.startswith("text/")
    tables = []
    if located is not None:
        # Own extractors may be for any type, mails too.
        as_value = mimetype.isin("text/html", *[m for e in extractors for m in e.mimetypes])
        fits = F.col("length") <= value_bytes
        files = files.unionByName(with_values(located.where(as_value & fits)))
        rest = route(located.where(~(as_value & fits)), rules)
        is_own = F.col("extractor").isin(*own)
        in_pieces = (F.col("extractor") == "default_text") & mimetype.startswith("text/") & (mimetype != "text/html")
        unread = is_own | ((F.col("extractor") == "default_text") & (mimetype == "text/html"))
        others = rest.where(~in_pieces & ~unread & (mimetype != MAIL))
        tables.append(native(others, {k: v for k, v in from_content.items() if k != "default_text"}, no_reader))
        if "text" in types:
            texts = located_texts(rest.where(in_pieces & ~is_own).select(*_lineage(), "stored"), inline_bytes)
            tables.append(texts.select(*_lineage(), "text", F.col("kept").alias("stored"), F.col("bytes").alias("length")))
        wanted = F.col("process_type").isin(*types)
        size = F.concat_ws(" ", F.col("length").cast("string"), F.lit("bytes"))
        tables.append(rest.where(unread & wanted).select(*_lineage(), F.lit("too_large").alias("error_class"), size.alias("message")))
    tables += [
        native(route(files.where(mimetype != MAIL), rules), from_content, no_reader),
        native(route(parsed, rules), from_mail, F.lit(False)),
        *(_run(e, route(files, rules)) for e in extractors),
    ]
    return _named(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables))


def _run(extractor: Extractor, routed: DataFrame) -> DataFrame:
    """Rows of a user's extractor. Lineage is put back batch by batch, so nothing is joined or shuffled."""
    function, lineage = extractor.function, _lineage()
    mine = routed.where(F.col("extractor") == extractor.name).select(*lineage, "content")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for found in function(iter([frame[["file_id", "content"]]])):
                yield frame[lineage].merge(found, on="file_id")[[*lineage, "text", "error"]]

    schema = StructType([mine.schema[c] for c in lineage]).simpleString()[len("struct<") : -1]
    done = mine.mapInPandas(run, f"{schema},text:string,error:string")
    return done.withColumn("error_class", F.when(F.col("error").isNotNull(), F.lit("extractor_error"))).withColumnRenamed(
        "error", "message"
    )


def _lineage() -> list[str]:
    return ["job_id", "root_id", "file_id", "depth", "checksum", "id_chain", "process_type", "mimetype"]


def _named(rows: DataFrame) -> DataFrame:
    kinds = F.create_map(*[F.lit(x) for t, (name, _) in PROCESSED.items() for x in (t, name)])
    types = F.create_map(*[F.lit(x) for t, (_, mimetype) in PROCESSED.items() for x in (t, mimetype)])
    have = set(rows.columns)
    length = F.octet_length("text").cast("bigint")
    if "length" in have:
        length = F.coalesce(F.col("length"), length)
    stored = F.col("stored") if "stored" in have else F.lit(None).cast(STORED.split(" ", 1)[1]).alias("stored")
    name = F.element_at(kinds, F.col("process_type"))
    return rows.select(
        "job_id",
        "root_id",
        "file_id",
        "depth",
        F.lit(0).cast("bigint").alias("ordinal"),
        F.lit("processed").alias("kind"),
        "process_type",
        name.alias("name"),
        F.element_at(types, F.col("process_type")).alias("mimetype"),
        # A processed output carries the checksum and the chain of the file it was made from.
        "checksum",
        "id_chain",
        archive_path(F.col("id_chain"), name).alias("archive_path"),
        length.alias("length"),
        "text",
        F.lit(None).cast("binary").alias("content"),
        stored,
        "error_class",
        "message",
    )


def embedded_outputs(children: DataFrame) -> DataFrame:
    """OUTPUTS rows of the files found in containers."""
    return children.select(
        "job_id",
        "root_id",
        "file_id",
        "depth",
        "ordinal",
        F.lit("embedded").alias("kind"),
        F.lit("embedded").alias("process_type"),
        "name",
        "mimetype",
        "checksum",
        "id_chain",
        archive_path(F.col("id_chain"), F.col("name")).alias("archive_path"),
        "length",
        F.lit(None).cast("string").alias("text"),
        "content",
        "stored",
    )


def missing_key_errors(outputs: DataFrame, key: str) -> DataFrame:
    """ERRORS rows for metadata outputs that have no string under a key."""
    rows = outputs.where((F.col("process_type") == "metadata") & metadata_key(F.col("text"), key).isNull())
    return rows.select(
        "job_id", "root_id", "file_id", F.lit("extract").alias("stage"), "process_type", F.lit("missing_key").alias("error_class"), F.lit(key).alias("message")
    )


def good_rows(rows: DataFrame) -> DataFrame:
    return rows.where("error_class is null").select(*StructType.fromDDL(OUTPUTS).names)


def error_rows(rows: DataFrame, stage: str = "extract") -> DataFrame:
    return rows.where("error_class is not null").withColumn("stage", F.lit(stage)).select(
        *StructType.fromDDL(ERRORS).names
    )
