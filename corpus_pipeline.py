"""The corpus pipeline: stages applied to ``documents`` one after the other, each written and read again.

Bad documents go, then copies, then near copies; the sources of what is left are mixed, and the result is packed.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.llm.common import documents, in_fold, labels, prepared, saved
from docsift.llm.exact_dedup import drop_exact_duplicates
from docsift.llm.mixing import mixed_documents
from docsift.llm.packing import pack_documents
from docsift.llm.quality import keep_good
from docsift.llm.similar import drop_similar

VOCABULARY = "word_bpe_49k.json"
# Differing bits up to which SimHash fingerprints link, as in ``op6_simhash``.
HAMMING = 2


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier accepts."""
    return keep_good(docs, labels(spark, sf_dir), in_fold(F.col("_id"), 5, 0))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for the case of A-Z, the one with the largest id."""
    prepared(spark)
    return drop_exact_duplicates(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links join, the one with the smallest id.

    SimHash fingerprints at 2 or fewer differing bits link, and so do 5-word shingles with a Jaccard similarity of 0.8.
    """
    prepared(spark)
    return drop_similar(docs, distance=HAMMING)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated towards their sources' target shares, in shuffled order."""
    prepared(spark)
    return mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequences and offsets."""
    prepared(spark)
    return pack_documents(docs, public_tokenizers.path(VOCABULARY)).drop("ids")


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup),
    ("simhash near-dedup", simhash_near_dedup),
    ("source mixing", mix_sources),
    ("best-fit packing", best_fit_packing),
]

# No stage but the second and fourth can be said in SQL; the whole is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
