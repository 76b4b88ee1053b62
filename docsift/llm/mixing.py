"""Mixing sources to target weights by Poisson replication.

Each source has a target share of the output. Its rate is that share times the size of the input over the source's own
size, so a document of it is wanted ``rate`` times on average. A hash of the document's id and a seed gives a number in
[0, 1); the inverse of the Poisson distribution with that rate turns it into a count, the same in every run and on every
machine. Documents are repeated by their counts, and all copies are ordered by another hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.llm.common import fresh, globally_ranked, saved

SEED = "mix-1"
# Shares are proportional to sizes to this power where no targets are given: below 1, small sources are read more often.
TEMPERATURE = 0.5
# A rate above this is split into equal parts whose counts are added, so that exp(-rate) stays far from zero.
LARGEST_RATE = 16.0
_UNIT = 1 << 52


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) of 52 bits from the MD5 of the parts, joined by a bar."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(_UNIT)


def poisson_steps(mean: Column) -> Column:
    """The Poisson distribution function at 0, 1, 2 and so on, as far as it grows in floating point, without the last.

    The number of its values that are at most ``u`` is the smallest count at which the function exceeds ``u``.
    """
    counts = F.sequence(F.lit(1), F.lit(int(LARGEST_RATE * 4 + 60)))
    start = F.struct(F.exp(-mean).alias("term"), F.array(F.exp(-mean)).alias("steps"))

    def step(state: Column, n: Column) -> Column:
        term = state["term"] * mean / n
        last = F.element_at(state["steps"], -1)
        grown = F.when(last + term > last, F.concat(state["steps"], F.array(last + term))).otherwise(state["steps"])
        return F.struct(term.alias("term"), grown.alias("steps"))

    steps = F.aggregate(counts, start, step, lambda state: state["steps"])
    return F.when(mean > 0, F.slice(steps, F.lit(1), F.size(steps) - 1)).otherwise(F.array().cast("array<double>"))


def source_rates(docs: DataFrame, source_col: str, size: Column, targets: dict[str, float] | None, temperature: float) -> DataFrame:
    """``_source, rate``, one row per source: share times total size over own size.

    Without targets shares go with size to the power of ``temperature``. With them, sources that they don't name have
    share zero, and shares are taken relative to the sum of the targets of sources that are there. Shares are counted in
    millionths, so that sums don't hang on their order.
    """
    sizes = docs.groupBy(F.col(source_col).alias("_source")).agg(F.sum(size).cast("long").alias("_size"))
    if targets is None:
        share = F.pow(F.col("_size").cast("double"), F.lit(temperature))
    else:
        named = F.create_map(*(F.lit(x) for pair in targets.items() for x in pair)) if targets else F.lit(None).cast("map<string,double>")
        share = F.coalesce(named[F.col("_source")], F.lit(0.0))
    share = F.when(F.col("_size") > 0, F.round(share * 1_000_000).cast("long")).otherwise(F.lit(0).cast("long"))
    sized = saved(sizes.withColumn("_share", share), "mixing-sources")
    total = sized.agg(F.sum("_size").alias("size"), F.sum("_share").alias("share")).first()
    rate = (F.col("_share") / F.lit(float(total.share or 1))) * (F.lit(float(total.size or 0)) / F.col("_size"))
    return sized.select("_source", F.when(F.col("_share") > 0, rate).otherwise(F.lit(0.0)).alias("rate"))


def replicated(
    docs: DataFrame,
    size: Column,
    id_col: str = "doc_id",
    source_col: str = "source",
    targets: dict[str, float] | None = None,
    temperature: float = TEMPERATURE,
    seed: str = SEED,
) -> tuple[DataFrame, dict[str, str]]:
    """The rows repeated by their counts, with the names of the columns that this adds.

    These are ``rate``, ``n_copies``, ``copy`` (from 0) and ``position`` (from 0 in the shuffled order), under names that
    are free. The result is written in that order. ``size`` says how much a row weighs in its source; null is nothing.
    """
    names = dict(zip(("rate", "n_copies", "copy", "position"), fresh(docs, "rate", "n_copies", "copy", "position"), strict=True))
    source, rate, parts, steps, order = fresh(docs, "_source_key", "_rate", "_parts", "_steps", "_order")
    rates = source_rates(docs, source_col, F.coalesce(size, F.lit(0)), targets, temperature)
    rates = rates.withColumn("_parts", F.greatest(F.ceil(F.col("rate") / LARGEST_RATE), F.lit(1)))
    # The distribution of a source is tabled once, in its one row.
    rates = rates.select(
        F.col("_source").alias(source), F.col("rate").alias(rate), F.col("_parts").alias(parts), poisson_steps(F.col("rate") / F.col("_parts")).alias(steps)
    )
    joined = docs.join(saved(rates, "mixing-rates"), F.col(source_col).eqNullSafe(F.col(source)), "left")
    doc_id = F.coalesce(F.col(id_col).cast("string"), F.lit(""))

    def drawn(part: Column) -> Column:
        u = uniform(F.lit(seed), doc_id, part.cast("string"))
        # Bound by a lambda, so that the hash is taken once and not for every value.
        return F.transform(F.array(u), lambda x: F.size(F.filter(F.col(steps), lambda value: value <= x)))[0]

    count = F.aggregate(F.sequence(F.lit(1).cast("long"), F.col(parts)), F.lit(0), lambda total, part: total + drawn(part))
    counted = joined.withColumn(names["rate"], F.col(rate)).withColumn(names["n_copies"], count)
    copies = counted.where(F.col(names["n_copies"]) > 0).withColumn(
        names["copy"], F.explode(F.sequence(F.lit(0), F.col(names["n_copies"]) - 1))
    )
    key = F.md5(F.concat_ws("|", F.lit(seed), F.lit("order"), doc_id, F.col(names["copy"]).cast("string")).cast("binary"))
    sorting = [F.col(order), F.col(id_col), F.col(names["copy"])]
    shuffled = globally_ranked(copies.withColumn(order, key), sorting, names["position"], "mixing-copies")
    return shuffled.drop(source, rate, parts, steps, order), names


def _chars(docs: DataFrame, text_col: str) -> Column:
    return F.char_length(docs[text_col].cast("string")).cast("long")


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """One row per copy: ``doc_id, source, rate, n_copies, copy, position``; options as of ``replicated``.

    Sizes are characters of the texts. A null source is a source of its own; a null or empty text has size zero, and a
    source of such texts only has rate zero. A null id is hashed as an empty one. Repeated rows have the same count, and
    their copies tie in the order, which then is any between them. An empty table gives an empty result. Other columns
    are ignored.
    """
    narrow = docs.select(docs[id_col].alias("doc_id"), docs[source_col].alias("source"), _chars(docs, text_col).alias("_chars"))
    rows, names = replicated(narrow, F.col("_chars"), "doc_id", "source", **options)
    return rows.select("doc_id", "source", *(F.col(names[n]).alias(n) for n in ("rate", "n_copies", "copy", "position")))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The documents with all their columns and no others, each repeated by its count, in files of the shuffled order."""
    rows, _ = replicated(docs, _chars(docs, text_col), id_col, source_col, **options)
    return rows.select(*docs.columns)
