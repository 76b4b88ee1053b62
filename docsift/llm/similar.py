"""Near duplicates by SimHash and by the Jaccard similarity of sets of word shingles: one document of each component stays.

Two kinds of links count, each found exactly: fingerprints that differ in few bits (``simhash``), and sets of shingles that
share most of their union (``jaccard_join``). Components are those of all links together.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.llm.common import fresh, saved
from docsift.llm.components import connected_components
from docsift.llm.jaccard_join import similar_sets, sized_texts
from docsift.llm.simhash import print_roots, with_fingerprints

SHINGLE_WORDS = 5
SIMILARITY = Fraction(4, 5)
_LAST = (1 << 63) - 1


def drop_similar(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = SHINGLE_WORDS,
    similarity: Fraction | float = SIMILARITY,
    distance: int | None = None,
) -> DataFrame:
    """The documents with all their columns, one row of each component: that with the smallest id, null ids last.

    Texts are linked if the Jaccard similarity of their sets of shingles is ``similarity`` or more, and with ``distance``
    also if their SimHash fingerprints, as in ``near_duplicates``, differ in as many bits or fewer. Texts without words,
    null ones too, are one component. Of rows that share the smallest id one stays.
    """
    (row,) = fresh(docs, "_row")
    # Written once with the text and all other columns; what follows reads the text from there.
    kept = saved(docs.withColumn(row, F.monotonically_increasing_id()), "similar-rows")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("_text")
    ids = F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("_id")
    texts = kept.select(F.col(row).alias("_row"), ids, text)
    sized = saved(sized_texts(texts, words).drop("_text"), "similar-sized")
    sets = similar_sets(sized, texts, words, similarity)
    first = F.min(F.struct("_id", "_row")).alias("first")
    kinds = ["size", "whole"]
    if distance is not None:
        prints = saved(with_fingerprints(texts.select("_row", "_text"), "_text", "_print"), "similar-prints")
        sized = saved(sized.join(prints, "_row"), "similar-printed")
        kinds.append("_print")
    firsts = saved(sized.groupBy(*kinds).agg(first), "similar-firsts")
    # Texts without words are one set, which has no root; row numbers are not negative.
    named = firsts.join(sets.select("size", "whole", "root"), ["size", "whole"], "left").withColumn("root", F.coalesce("root", F.lit(-1).cast("long")))
    if distance is not None:
        named = _joined_by_prints(saved(named, "similar-named"), distance)
    stays = named.groupBy("root").agg(F.min("first").alias("stays")).select(F.col("stays._row").alias("_row"))
    goes = saved(sized.select("_row").join(stays, "_row", "left_anti"), "similar-goes")
    return kept.join(goes.withColumnRenamed("_row", row), row, "left_anti").select(*docs.columns)


def _joined_by_prints(named: DataFrame, distance: int) -> DataFrame:
    """``first, root`` of ``first, root, _print``, with the components of sets joined where fingerprints are close."""
    printed = named.join(print_roots(named.select("_print"), "_print", distance), "_print")
    both = saved(printed.select("first", "root", "_root"), "similar-both")
    # All sets of a group of close fingerprints are linked to the least of them.
    pairs = both.select("root", "_root").distinct()
    least = pairs.groupBy("_root").agg(F.min("root").alias("least"))
    roots = connected_components(pairs.join(least, "_root").where("root <> least").select("root", "least"), "root", "least")
    roots = roots.select(F.col("node").alias("root"), F.col("root").alias("_top"))
    return both.join(roots, "root", "left").select("first", F.coalesce("_top", "root").alias("root"))
