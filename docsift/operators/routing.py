"""Requested process types, and which extractor handles a file for each of them."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.schemas import MAIL, MBOX, PROCESS_TYPES, ZIP

# Fixed values. The first entry ends in a space, so plain text does get its text extracted.
NO_TEXT = ["text/plain ", "text/css", "text/csv", "text/javascript", ZIP, MBOX]
RENDERED = {MAIL: "rfc822_render"}
CONTAINERS = {ZIP: "zip_embedded", MBOX: "mbox_embedded", MAIL: "rfc822_embedded"}
DEFAULTS = {"text": "default_text", "metadata": "default_metadata"}


def parse_types(types: Column) -> Column:
    """Lower-case types, ``all`` standing for every type."""
    lower = F.array_distinct(F.transform(types, F.lower))
    every = F.array(*[F.lit(t) for t in PROCESS_TYPES])
    return F.when(F.array_contains(lower, "all"), every).otherwise(lower)


def unknown_types(types: Column) -> Column:
    """The requested types that do not exist, as they were written."""
    return F.filter(types, lambda t: ~F.lower(t).isin(*PROCESS_TYPES, "all"))


def routing_rules(spark: SparkSession, extra: Iterable[tuple[str, str, str]] = ()) -> DataFrame:
    """Rules for single MIME types; a NULL extractor means there is none. ``extra`` rules replace built-in ones."""
    rules = {("text", m): None for m in NO_TEXT}
    rules |= {("pdf", m): e for m, e in RENDERED.items()}
    rules |= {("embedded", m): e for m, e in CONTAINERS.items()}
    rules |= {(t, m): e for t, m, e in extra}
    table = {
        "process_type": [t for t, _ in rules],
        "mimetype": [m for _, m in rules],
        "extractor": pa.array(list(rules.values()), pa.string()),
    }
    # An Arrow table becomes a local relation, whose size Spark knows when it chooses a join.
    return spark.createDataFrame(pa.table(table))


def route(files: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """One row per file and extractor that handles it: adds ``process_type`` and ``extractor``."""
    rules = routing_rules(files.sparkSession) if rules is None else rules
    # Broadcast by Spark on account of its size.
    matched = rules.withColumn("has_rule", F.lit(True))
    default = F.create_map(*[F.lit(x) for pair in DEFAULTS.items() for x in pair])
    asked = files.withColumn("process_type", F.explode(parse_types(F.col("types"))))
    routed = asked.join(matched, ["process_type", "mimetype"], "left").withColumn(
        "extractor",
        F.when(F.col("has_rule"), F.col("extractor")).otherwise(F.try_element_at(default, F.col("process_type"))),
    )
    return routed.where(F.col("extractor").isNotNull()).drop("has_rule")
