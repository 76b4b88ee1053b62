"""Document fingerprints by spot signatures, with DataFrame functions only.

Common words of a few languages are anchors. At every content word that follows an anchor a chain of content words starts,
anchors between them left out; the chains of a text are its signatures, and their sorted hashes its fingerprint. Two
fingerprints are alike by the Jaccard similarity of their sets.

Near duplicates are found among different fingerprints. Fingerprints are dealt to partitions by the size of their sets, so
wide that similar sets lie in the same partition or in neighbours; there they are joined on the few rarest signatures that
similar sets must share, pruned by size, and compared.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.llm.common import globally_ranked, saved
from docsift.llm.components import connected_components

# Frequent function words of English, French, German and Spanish.
ANCHORS = (
    "the of and to a in is that it for was on with as be by this are at from or an not but have has had "
    "de la le et les des en un du une que pour est par qui dans avec sur pas au plus "
    "der die und den von zu das mit sich auf für ist im nicht dem ein eine als auch es "
    "el y los se del las por con no su una para al lo como más"
).split()
CHAIN = 2
SIMILARITY = 0.8

_MARK = "\x01"


def with_signatures(rows: DataFrame, chain: int = CHAIN, **texts: str) -> DataFrame:
    """Add, under each name, the sorted distinct 32-bit hashes of the signatures of the text column given for it.

    A text without a whole chain after an anchor has one signature of all its words; one without words has none. Words
    and chains are columns of steps of their own, which Spark keeps apart as each is used more than once: they are
    computed once per text.
    """
    words, chains = {n: f"_words_{n}" for n in texts}, {n: f"_chains_{n}" for n in texts}
    anchor = r"(?<=[ " + _MARK + r"])(?:" + "|".join(sorted(ANCHORS, key=lambda w: (-len(w), w))) + r")(?: |$)"
    following = "".join(rf" {_MARK}*+[^ {_MARK}]++" for _ in range(chain - 1))

    def in_words(text: str) -> Column:
        return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))), r"[^\p{L}\p{N}]++", " ")))

    def in_chains(name: str) -> Column:
        # An anchor and the blank after it become a mark, so a content word after anchors has marks before it.
        marked = F.regexp_replace(words[name], anchor, _MARK)
        return F.regexp_extract_all(marked, F.lit(rf"{_MARK}(?=([^ {_MARK}]++{following}))"), F.lit(1))

    def hashed(name: str) -> Column:
        listed = F.split(F.translate(F.array_join(chains[name], "\n"), _MARK, ""), "\n")
        whole = F.when(F.length(words[name]) > 1, F.array(words[name])).otherwise(F.array().cast("array<string>"))
        spots = F.when(F.size(chains[name]) > 0, listed).otherwise(whole)
        return F.array_sort(F.array_distinct(F.transform(spots, lambda s: F.shiftright(F.xxhash64(s), 32).cast("int"))))

    rows = rows.withColumns({words[n]: in_words(t) for n, t in texts.items()})
    rows = rows.withColumns({chains[n]: in_chains(n) for n in texts})
    return rows.withColumns({n: hashed(n) for n in texts}).drop(*words.values(), *chains.values())


def as_text(prints: Column) -> Column:
    """A fingerprint as hexadecimal digits, eight for each signature."""
    return F.array_join(F.transform(prints, lambda h: F.lower(F.lpad(F.hex(h.cast("long").bitwiseAND(0xFFFFFFFF)), 8, "0"))), "")


def jaccard(a: Column, b: Column, least: float = 0.0) -> Column:
    """The similarity of two sets; zero where their sizes alone keep it below ``least``. Two empty sets are alike."""
    common = F.size(F.array_intersect(a, b))
    exact = common / (F.size(a) + F.size(b) - common)
    sizes = F.least(F.size(a), F.size(b)) / F.greatest(F.size(a), F.size(b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when(sizes < least, F.lit(0.0)).otherwise(exact)


def fingerprints_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chain: int = CHAIN) -> DataFrame:
    """One row per document: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    n_signatures``.

    The next document is that with the next smaller id, and after the smallest the greatest; null ids come last. The
    edited text is the text with its last half, rounded down, replaced by as many first characters of the next text.
    Documents that share an id are ordered by a hash of their texts; rows that repeat id and text are one document. A
    null text counts as empty; two texts without words are alike. A table of one document has itself as the next. An
    empty table gives an empty result. Other columns are ignored.

    Texts are shuffled once by id. What then goes to the document before is the part of the text that it needs and the
    signatures. The order itself comes from ids and lengths alone.
    """
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), text.alias("text"))
    # The least number stands for a null id.
    none = F.lit(-(1 << 63))
    key = [F.coalesce("doc_id", none).alias("k"), F.xxhash64("text").alias("h")]
    sizes = saved(rows.select(*key, F.char_length("text").alias("n")).groupBy("k", "h").agg(F.max("n").alias("n"), F.count("*").alias("rows")), "spots-sizes")
    if sizes.where("rows > 1").limit(1).count():
        rows = rows.dropDuplicates(["doc_id", "text"])
    ranked = saved(globally_ranked(sizes.drop("rows"), [F.desc("k"), F.col("h")], "place", "spots-order"), "spots-order")
    total = ranked.count()
    before = ranked.select(
        ((F.col("place") + 1) % F.lit(max(total, 1))).alias("place"), F.col("k").alias("pk"), F.col("h").alias("ph"), F.col("n").alias("pn")
    )
    chainmap = ranked.select("place", "k", "h").join(before, "place").select("k", "h", "pk", "ph", "pn")
    # Both joins below take the same columns of the texts, so that Spark shuffles them once for both.
    keyed = rows.select(*key, "text")
    sent = with_signatures(keyed.join(chainmap, ["k", "h"]), chain, next_print="text").select(
        F.col("pk").alias("k"), F.col("ph").alias("h"), F.expr("substring(text, 1, floor(pn / 2))").alias("head"), "next_print"
    )
    edited = F.concat(F.expr("substring(text, 1, char_length(text) - floor(char_length(text) / 2))"), F.col("head"))
    both = keyed.join(sent, ["k", "h"]).select(F.nullif(F.col("k"), none).alias("doc_id"), "text", F.char_length("text").cast("long").alias("n_chars"), edited.alias("edited"), "next_print")
    printed = with_signatures(both, chain, own="text", other="edited").withColumn("edited_sha256", F.sha2("edited", 256))
    return printed.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("other")).alias("edited_fingerprint"),
        jaccard(F.col("own"), F.col("other")).alias("near_edited"),
        jaccard(F.col("own"), F.col("next_print")).alias("near_next"),
        F.size("own").alias("n_signatures"),
    )


def _partition(size: Column, similarity: float) -> Column:
    """Sets whose sizes are in the ratio ``similarity`` or nearer have numbers that differ by at most 1."""
    return F.floor(F.log(size.cast("double")) / F.lit(-math.log(similarity)) + 1e-9)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, chain: int = CHAIN) -> tuple[DataFrame, DataFrame]:
    """Members ``doc_id, class, class_id`` and links ``a, b, similarity`` between classes of equal fingerprints.

    Every two different fingerprints with a similarity of ``similarity`` or more are linked. ``class`` is the least id of
    the documents with one fingerprint, ``class_id`` the least id that links reach. Texts without words are one class. A
    null id is in a class, but never its name unless it has no other. Repeated rows are members each.
    """
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    rows = saved(with_signatures(rows, chain, sigs="text").select("doc_id", "sigs"), "spots-rows")
    classes = saved(rows.groupBy("sigs").agg(F.min("doc_id").alias("class")), "spots-classes")
    sets = classes.where(F.col("class").isNotNull() & (F.size("sigs") > 0)).withColumn("size", F.size("sigs"))
    spots = sets.select("class", "size", F.explode("sigs").alias("sig"))
    rarity = spots.groupBy("sig").agg(F.count("*").alias("df"))
    ordered = spots.join(rarity, "sig").groupBy("class", "size").agg(F.array_sort(F.collect_list(F.struct("df", "sig"))).alias("byrarity"))
    keep = (F.col("size") - F.ceil(F.col("size") * similarity) + 1).cast("int")
    prefix = ordered.select("class", "size", F.explode(F.slice("byrarity", F.lit(1), keep)).alias("s")).select(
        "class", "size", F.col("s.sig").alias("sig"), _partition(F.col("size"), similarity).alias("part")
    )
    prefix = saved(prefix, "spots-prefixes")
    left = prefix.select(F.col("class").alias("a"), F.col("size").alias("na"), "sig", F.explode(F.array("part", F.col("part") + 1)).alias("part"))
    right = prefix.select(F.col("class").alias("b"), F.col("size").alias("nb"), "sig", "part")
    pairs = left.join(right, ["sig", "part"]).where("a <> b").where(F.col("na") <= F.col("nb")).where(F.col("na") >= F.col("nb") * similarity)
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    one = sets.select(F.col("class").alias("a"), F.col("sigs").alias("sa"))
    two = sets.select(F.col("class").alias("b"), F.col("sigs").alias("sb"))
    links = pairs.join(one, "a").join(two, "b").select("a", "b", jaccard(F.col("sa"), F.col("sb"), similarity).alias("similarity"))
    links = saved(links.where(F.col("similarity") >= similarity), "spots-links")
    roots = connected_components(links, "a", "b")
    named = classes.join(roots, F.col("class") == F.col("node"), "left").select("sigs", "class", F.coalesce("root", "class").alias("class_id"))
    return rows.join(named, "sigs").select("doc_id", "class", "class_id"), links
