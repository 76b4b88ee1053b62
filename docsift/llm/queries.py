"""The queries of this subpackage, over whole tables with production parameters, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.llm.common import documents, embeddings, in_fold, labels
from docsift.llm.exact_dedup import exact_duplicates
from docsift.llm.jaccard_join import jaccard_components
from docsift.llm.language_model import likelihoods
from docsift.llm.licenses import license_spans
from docsift.llm.mixing import mix_sources
from docsift.llm.packing import pack_documents
from docsift.llm.phrases import collocations
from docsift.llm.quality import quality_scores
from docsift.llm.secrets import secret_spans
from docsift.llm.simhash import near_duplicates
from docsift.llm.spotsigs import fingerprints_with_edits
from docsift.llm.toxicity import toxicity_scores
from docsift.llm.whitening import whitened

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

VOCABULARY = "word_bpe_49k.json"


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


# Lower-casing of A-Z alone.
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(f"""
WITH d AS (SELECT doc_id, {LOWERED} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
       sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
""")
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir))


@query()
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


@query()
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY)).drop("ids")


@query("""
WITH RECURSIVE sized AS (
  SELECT source, coalesce(sum(length(text)), 0)::BIGINT AS size FROM documents GROUP BY source),
shared AS (SELECT *, CASE WHEN size > 0 THEN round(pow(size::DOUBLE, 0.5) * 1000000)::BIGINT ELSE 0 END AS share FROM sized),
rates AS (
  SELECT source, CASE WHEN share > 0 THEN (share::DOUBLE / (sum(share) OVER ())::DOUBLE) * ((sum(size) OVER ())::DOUBLE / size::DOUBLE)
                      ELSE 0.0 END AS rate
  FROM shared),
parted AS (SELECT source, rate, greatest(ceil(rate / 16.0), 1)::BIGINT AS parts FROM rates),
steps(source, mean, k, term, total) AS (
  SELECT source, rate / parts, 0, exp(-(rate / parts)), exp(-(rate / parts)) FROM parted WHERE rate > 0
  UNION ALL
  SELECT source, mean, k + 1, term * mean / (k + 1), total + term * mean / (k + 1) FROM steps
  WHERE k < 124 AND total + term * mean / (k + 1) > total),
terms AS (SELECT source, k, total, k < max(k) OVER (PARTITION BY source) AS grows FROM steps),
draws AS (
  SELECT doc_id, d.source, rate, p,
         ('0x' || substr(md5('mix-1|' || doc_id || '|' || p), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u
  FROM documents d JOIN parted r ON d.source IS NOT DISTINCT FROM r.source, unnest(range(1, parts + 1)) AS x(p)),
counted AS (
  SELECT doc_id, w.source, rate, count(k)::INT AS n_copies
  FROM draws w LEFT JOIN terms t ON t.source IS NOT DISTINCT FROM w.source AND t.grows AND t.total <= w.u
  GROUP BY doc_id, w.source, rate),
copies AS (SELECT doc_id, source, rate, n_copies, c::INT AS copy FROM counted, unnest(range(n_copies)) AS y(c))
SELECT *, row_number() OVER (ORDER BY md5('mix-1|order|' || doc_id || '|' || copy), doc_id, copy) - 1 AS position FROM copies
""")
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir))


@query()
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(documents(spark, sf_dir), labels(spark, sf_dir), in_fold(F.col("_id"), 5, 0))


@query()
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(documents(spark, sf_dir), labels(spark, sf_dir), in_fold(F.col("_id"), 3, 1))


@query()
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_spans(documents(spark, sf_dir))
    return found.withColumn("spans", F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["label"], s["start"], s["end"])), ","))


@query()
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(documents(spark, sf_dir))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "model")
    return found.select(
        "doc_id", *(number(k) for k in ("assign", "access", "hex")), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )


@query()
def op9_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints_with_edits(documents(spark, sf_dir))


@query()
def op1_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return likelihoods(documents(spark, sf_dir), in_fold(F.col("doc_id"), 10, 0))


@query()
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(embeddings(spark, sf_dir))


@query(f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWERED}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
grams AS (
  SELECT DISTINCT r, array_to_string(w[i:i + 3], ' ') AS g FROM d, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS x(i) WHERE len(w) > 0),
sized AS (SELECT r, count(*) AS n FROM grams GROUP BY r),
links AS (
  SELECT a.r AS a, b.r AS b FROM grams a JOIN grams b ON a.g = b.g AND a.r <> b.r JOIN sized x ON x.r = a.r JOIN sized y ON y.r = b.r
  GROUP BY a.r, b.r, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
reached(a, b) AS (SELECT r, r FROM d UNION SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b),
least AS (SELECT a, min(doc_id) AS component_id FROM reached JOIN d ON d.r = reached.b GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM d JOIN least ON a = d.r LEFT JOIN sized ON sized.r = d.r
""")
def op11_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir))


@query(f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(string_split_regex({LOWERED}, '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS w
  FROM documents),
counted AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
known AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM pieces, unnest([1, 2, 3, 4]) AS x(k), unnest(range(1, len(w) - k + 2)) AS y(i) GROUP BY ALL HAVING count(*) >= 30),
split AS (SELECT *, string_split(phrase, ' ') AS w FROM known WHERE k > 1),
cuts AS (
  SELECT s.lang, s.phrase, s.f AS a, cut, h.f AS l, t.f AS r, ((2000000::HUGEINT * s.f) // (h.f + t.f))::BIGINT AS score
  FROM split s, unnest(range(1, s.k)) AS x(cut)
  JOIN known h ON h.lang = s.lang AND h.phrase = array_to_string(s.w[1:cut], ' ')
  JOIN known t ON t.lang = s.lang AND t.phrase = array_to_string(s.w[cut + 1:], ' ')),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS o FROM cuts),
within AS (
  SELECT lang, array_to_string(w[j:j + size - 1], ' ') AS phrase, max(f) AS most
  FROM split, unnest(range(2, k)) AS x(size), unnest(range(1, k - size + 2)) AS y(j) GROUP BY ALL),
kept AS (
  SELECT c.* FROM lowest c LEFT JOIN within v ON v.lang = c.lang AND v.phrase = c.phrase
  WHERE o = 1 AND (most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN counted USING (lang) WHERE rank <= 2000
""")
def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))
