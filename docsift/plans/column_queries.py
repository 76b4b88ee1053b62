"""Queries on column functions: routing, identification, formatting, escaping, dates, URIs, registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.functions.dates import mail_date_iso, mail_date_utc
from docsift.functions.identity import message_id
from docsift.functions.mail_columns import (
    format_addresses,
    format_group,
    format_groups,
    format_name_address,
    format_text_list,
    metadata_key,
    metadata_keys,
)
from docsift.functions.mime import format_content_type, identify, identify_or_default
from docsift.functions.paths import archive_path, extend_chain, safe_name
from docsift.functions.text import clean_text, escape_html, html_to_text, paragraphs
from docsift.functions.uris import object_location
from docsift.operators.extract import missing_key_errors
from docsift.operators.routing import route, unknown_types
from docsift.plans import fixtures
from docsift.plans.catalog import query
from docsift.sources.registry import mime_registry, with_type_by_name

# MIME types given to documents by id, so that every rule of the routing table is met.
_TYPES = [
    "text/plain", "text/plain ", "text/css", "text/csv", "text/javascript", "text/html", "application/zip",
    "application/mbox", "message/rfc822", "application/pdf", "image/png", "application/octet-stream",
]
_TYPE_LIST = "[" + ", ".join(f"'{t}'" for t in _TYPES) + "]"


def _pick(values: list[str], by: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (by % len(values) + 1).cast("int"))


@query(
    f"""
WITH typed AS (SELECT doc_id, {_TYPE_LIST}[doc_id % {len(_TYPES)} + 1] AS mimetype FROM documents),
asked AS (SELECT *, unnest(CASE doc_id % 3 WHEN 0 THEN ['text', 'metadata', 'pdf', 'embedded']
                                           WHEN 1 THEN ['text', 'embedded'] ELSE ['pdf', 'metadata'] END) AS process_type
          FROM typed)
SELECT * FROM (
  SELECT doc_id, mimetype, process_type,
    CASE process_type
      WHEN 'text' THEN CASE WHEN mimetype IN ('text/plain ', 'text/css', 'text/csv', 'text/javascript', 'application/zip',
                                              'application/mbox') THEN NULL ELSE 'default_text' END
      WHEN 'metadata' THEN 'default_metadata'
      WHEN 'pdf' THEN CASE mimetype WHEN 'message/rfc822' THEN 'rfc822_render' END
      ELSE CASE mimetype WHEN 'message/rfc822' THEN 'rfc822_embedded' WHEN 'application/zip' THEN 'zip_embedded'
                         WHEN 'application/mbox' THEN 'mbox_embedded' END END AS extractor
  FROM asked) WHERE extractor IS NOT NULL"""
)
def route_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files and requested types to extractors."""
    doc_id = F.col("doc_id")
    asked = (
        F.when(doc_id % 3 == 0, F.array(F.lit("ALL")))
        .when(doc_id % 3 == 1, F.array(F.lit("Text"), F.lit("embedded")))
        .otherwise(F.array(F.lit("PDF"), F.lit("metadata")))
    )
    files = fixtures.table(spark, sf_dir, "documents").select(
        "doc_id", _pick(_TYPES, doc_id).alias("mimetype"), asked.alias("types")
    )
    return route(files).select("doc_id", "mimetype", "process_type", "extractor")


@query(
    """
SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'Txt' WHEN doc_id % 5 = 1 THEN 'txt, ocr' END AS unknown
FROM documents WHERE doc_id % 5 < 2"""
)
def unknown_process_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested types that do not exist."""
    kind = F.col("doc_id") % 5
    types = (
        F.when(kind == 0, F.array(F.lit("Txt"), F.lit("pdf")))
        .when(kind == 1, F.array(F.lit("txt"), F.lit("ocr")))
        .otherwise(F.array(F.lit("Text"), F.lit("ALL")))
    )
    docs = fixtures.table(spark, sf_dir, "documents").select("doc_id", unknown_types(types).alias("bad"))
    return docs.where(F.size("bad") > 0).select("doc_id", F.array_join("bad", ", ").alias("unknown"))


@query(
    r"""
SELECT 'doc' AS kind, doc_id AS id,
       CASE WHEN starts_with(text, 'From ') THEN 'application/mbox'
            WHEN regexp_matches(text, '(?i)^\s*(<!doctype\s+html|<html)\b') THEN 'text/html'
            WHEN doc_id % 3 = 0 THEN 'image/png' ELSE 'text/plain' END AS mimetype
FROM documents
UNION ALL SELECT 'page', page_id, 'text/html' FROM pages
UNION ALL SELECT 'mail', conv_id * 1000 + turn, 'message/rfc822' FROM conversations
UNION ALL SELECT 'mbox', conv_id * 1000 + turn // 64, 'application/mbox' FROM conversations GROUP BY conv_id, turn // 64
UNION ALL SELECT 'zip', doc_id // 64, 'application/zip' FROM documents GROUP BY doc_id // 64
UNION ALL SELECT 'raw', doc_id, CASE WHEN doc_id % 2 = 0 THEN 'application/pdf' ELSE 'application/octet-stream' END
FROM documents"""
)
def identify_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MIME types of texts, pages, mails, mailboxes, archives and other bytes, by content and then by name."""
    docs = fixtures.spread_table(spark, sf_dir, "documents", "doc_id")
    utf8 = lambda c: F.encode(c, "UTF-8")
    doc_id = F.col("doc_id")
    no_name = F.lit(None).cast("string")
    mail_id = lambda root, sep: F.split(root, sep)[0].cast("bigint") * 1000 + F.split(root, sep)[1].cast("bigint")
    tables = [
        ("doc", docs, doc_id, F.when(doc_id % 3 == 0, F.lit("a/picture.PNG")).otherwise(F.lit("note")), utf8("text")),
        ("page", fixtures.spread_table(spark, sf_dir, "pages", "page_id"), F.col("page_id"), no_name, utf8("html")),
        ("mail", fixtures.mails(spark, sf_dir), F.col("conv_id") * 1000 + F.col("turn"), no_name, F.col("content")),
        ("mbox", fixtures.mailboxes(spark, sf_dir), mail_id(F.col("root_id"), "/"), no_name, F.col("content")),
        ("zip", fixtures.document_zips(spark, sf_dir), F.split("root_id", "-")[1].cast("bigint"), no_name, F.col("content")),
        (
            "raw", docs, doc_id, F.lit("x.unknown-ending"),
            F.concat(F.when(doc_id % 2 == 0, F.lit(b"%PDF-1.7\n")).otherwise(F.lit(b"\x00\xff")), utf8("text")),
        ),
    ]
    parts = [
        t.select(F.lit(kind).alias("kind"), i.alias("id"), name.alias("name"), content.alias("content"))
        for kind, t, i, name, content in tables
    ]
    files = parts[0]
    for part in parts[1:]:
        files = files.unionByName(part)
    typed = with_type_by_name(files, mime_registry(spark))
    return typed.select("kind", "id", identify_or_default(F.col("content"), F.col("type_by_name")).alias("mimetype"))


_EXTENSIONS = [".eml", ".zip", ".mbox", ".jpeg", ".JPG", ".png", ".bz2", ".tar", ".gz", ".no-such-ending", ""]


@query(
    """
SELECT doc_id, ['message/rfc822', 'application/zip', 'application/mbox', 'image/jpeg', 'image/jpeg', 'image/png',
                'application/x-bzip2', 'application/x-tar', 'application/gzip', NULL, NULL][doc_id % 11 + 1] AS type_by_name
FROM documents"""
)
def type_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry types of file names; an extension of several types gets the implemented or first one."""
    names = fixtures.table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit("in.box/file"), F.col("doc_id"), _pick(_EXTENSIONS, F.col("doc_id"))).alias("name")
    )
    return with_type_by_name(names, mime_registry(spark)).select("doc_id", "type_by_name")


@query(
    """
SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN lang || '/' || source ELSE lang END AS content_type FROM documents"""
)
def content_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type and subtype, or the type alone."""
    subtype = F.when(F.col("doc_id") % 2 == 0, F.col("source"))
    docs = fixtures.table(spark, sf_dir, "documents")
    return docs.select("doc_id", format_content_type(F.col("lang"), subtype).alias("content_type"))


# Customers as addresses: names and addresses are left out by key.
_SQL_NAME = "CASE WHEN c_custkey % 4 < 2 THEN c_name END"
_SQL_ADDRESS = "CASE WHEN c_custkey % 2 = 0 THEN 'c' || c_custkey || '@example.invalid' END"
_SQL_FORMATTED = f"""
SELECT *, CASE WHEN name IS NOT NULL AND address IS NOT NULL THEN name || ' <' || address || '>'
               WHEN name IS NOT NULL THEN name WHEN address IS NOT NULL THEN '<' || address || '>' END AS formatted
FROM (SELECT *, {_SQL_NAME} AS name, {_SQL_ADDRESS} AS address FROM customer)"""


def _addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    name = F.when(key % 4 < 2, F.col("c_name"))
    address = F.when(key % 2 == 0, F.concat(F.lit("c"), key, F.lit("@example.invalid")))
    return fixtures.table(spark, sf_dir, "customer").select(
        "c_custkey", (F.col("c_custkey") / 8).cast("bigint").alias("batch"), name.alias("name"), address.alias("address")
    )


@query(f"SELECT c_custkey, formatted FROM ({_SQL_FORMATTED})")
def format_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses with and without name and address."""
    return _addresses(spark, sf_dir).select(
        "c_custkey", format_name_address(F.col("name"), F.col("address")).alias("formatted")
    )


def _address_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of eight addresses by ranges of keys."""
    rows = F.array_sort(F.collect_list(F.struct("c_custkey", F.struct("name", "address").alias("a"))))
    lists = _addresses(spark, sf_dir).groupBy("batch").agg(rows.alias("rows"))
    return lists.select("batch", F.col("rows.a").alias("addresses"))


@query(
    f"""
SELECT c_custkey // 8 AS batch, string_agg(formatted, ', ' ORDER BY c_custkey) AS formatted
FROM ({_SQL_FORMATTED}) GROUP BY c_custkey // 8"""
)
def format_address_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of addresses, empty ones left out."""
    return _address_lists(spark, sf_dir).select("batch", format_addresses(F.col("addresses")).alias("formatted"))


@query(
    f"""
WITH lists AS (SELECT c_custkey // 8 AS batch, string_agg(formatted, ', ' ORDER BY c_custkey) AS members
               FROM ({_SQL_FORMATTED}) GROUP BY c_custkey // 8),
named AS (SELECT batch, CASE WHEN batch % 2 = 0 THEN 'Group ' || batch || ' <' || members || '>'
                             ELSE '<' || members || '>' END AS one FROM lists)
SELECT batch, one AS formatted, one || ', Empty group' AS formatted_list FROM named"""
)
def format_group_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of addresses, with and without a name, and lists of groups."""
    name = F.when(F.col("batch") % 2 == 0, F.concat(F.lit("Group "), F.col("batch")))
    group = F.struct(name.alias("name"), "addresses")
    none = F.array().cast("array<struct<name:string,address:string>>")
    empty = F.struct(F.lit("Empty group").alias("name"), none.alias("addresses"))
    nothing = F.struct(F.lit(None).cast("string").alias("name"), none.alias("addresses"))
    lists = _address_lists(spark, sf_dir).withColumn("group", group)
    return lists.select(
        "batch",
        format_group(F.col("group")).alias("formatted"),
        format_groups(F.array("group", empty, nothing)).alias("formatted_list"),
    )


@query(
    """
SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN NULL
                       WHEN s_suppkey % 3 = 1 THEN s_name ELSE s_name || ', ' || s_nationkey END AS formatted
FROM supplier"""
)
def text_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of texts joined, empty ones left out."""
    key = F.col("s_suppkey")
    first = F.when(key % 3 == 0, F.lit("")).otherwise(F.col("s_name"))
    second = F.when(key % 3 == 2, F.col("s_nationkey").cast("string")).otherwise(F.lit(""))
    suppliers = fixtures.table(spark, sf_dir, "supplier")
    return suppliers.select("s_suppkey", format_text_list(F.array(first, F.lit(""), second)).alias("formatted"))


@query(
    """
SELECT page_id, replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS escaped FROM pages"""
)
def escape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole pages escaped as text."""
    return fixtures.spread_table(spark, sf_dir, "pages", "page_id").select(
        "page_id", escape_html(F.col("html")).alias("escaped")
    )


@query(
    """
SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)),
         lambda x: '<p>' || replace(replace(replace(x, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</p>'), chr(10)) AS html
FROM documents"""
)
def text_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as paragraphs, one per line."""
    return fixtures.spread_table(spark, sf_dir, "documents", "doc_id").select(
        "doc_id", paragraphs(F.col("text")).alias("html")
    )


_ZONES = ["+0000", "-0800", "+0530", "EST", "GMT", "-0330 (local)"]


@query(
    """
WITH zoned AS (
  SELECT event_id, date_trunc('second', ts) AS at_local,
         ['Z', '-08:00', '+05:30', '-05:00', 'Z', '-03:30'][event_id % 6 + 1] AS shown,
         [0, -28800, 19800, -18000, 0, -12600][event_id % 6 + 1] AS seconds
  FROM events)
SELECT event_id, strftime(at_local, '%Y-%m-%dT%H:%M:%S') || shown AS date_iso, at_local - to_seconds(seconds) AS date_utc
FROM zoned"""
)
def message_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mail dates of all events, with offsets, zone names and wrong weekdays, as ISO-8601 and as instants."""
    day = F.when(F.col("event_id") % 7 == 0, F.lit("")).otherwise(F.lit("Wed, "))
    written = F.concat(day, F.date_format("ts", "d MMM yyyy HH:mm:ss "), _pick(_ZONES, F.col("event_id")))
    return fixtures.table(spark, sf_dir, "events").select(
        "event_id", mail_date_iso(written).alias("date_iso"), mail_date_utc(written).alias("date_utc")
    )


@query(
    r"""
WITH uris AS (
  SELECT page_id, CASE page_id % 5 WHEN 0 THEN 's3://' || regexp_extract(url, '^https?://(.*)$', 1)
                                   WHEN 1 THEN url
                                   WHEN 2 THEN 's3://bucket-' || page_id || '/a%20b/c+d.eml'
                                   WHEN 3 THEN 's3://bucket-only' ELSE 'not a uri ' || page_id END AS uri
  FROM pages)
SELECT page_id,
       CASE page_id % 5 WHEN 0 THEN regexp_extract(uri, '^s3://([^/]+)/', 1) WHEN 2 THEN 'bucket-' || page_id END AS bucket,
       CASE page_id % 5 WHEN 0 THEN regexp_extract(uri, '^s3://[^/]+/([^?#]*)', 1) WHEN 2 THEN 'a b/c+d.eml' END AS key,
       CASE page_id % 5 WHEN 0 THEN regexp_extract(uri, '^s3://([^/]+)/', 1) WHEN 1 THEN regexp_extract(uri, '//([^/]+)/', 1)
                        WHEN 2 THEN 'bucket-' || page_id WHEN 3 THEN 'bucket-only' END AS any_host
FROM uris"""
)
def object_uri(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object URIs to bucket and key, by the strict and the lenient rule."""
    page_id, kind = F.col("page_id"), F.col("page_id") % 5
    uri = (
        F.when(kind == 0, F.regexp_replace("url", "^https?://", "s3://"))
        .when(kind == 1, F.col("url"))
        .when(kind == 2, F.concat(F.lit("s3://bucket-"), page_id, F.lit("/a%20b/c+d.eml")))
        .when(kind == 3, F.lit("s3://bucket-only"))
        .otherwise(F.concat(F.lit("not a uri "), page_id))
    )
    pages = fixtures.table(spark, sf_dir, "pages").select("page_id", uri.alias("uri"))
    strict, lenient = object_location(F.col("uri")), object_location(F.col("uri"), strict=False)
    return pages.select(
        "page_id", strict["bucket"].alias("bucket"), strict["key"].alias("key"), lenient["bucket"].alias("any_host")
    )


@query(
    """
SELECT event_id, CASE WHEN event_id % 3 = 2 THEN NULL ELSE 'text/' || event_type END AS content_type,
       CASE WHEN event_id % 3 = 2 THEN 'k' ELSE 'k,Content-Type' END AS keys
FROM events"""
)
def metadata_json_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One string value and the key set of metadata objects; a value that is no string counts as missing."""
    added = F.concat(
        F.regexp_replace("props", r"\}\s*$", ""), F.lit(', "Content-Type": "text/'), F.col("event_type"), F.lit('"}')
    )
    has_it = F.col("event_id") % 3 != 2
    objects = fixtures.table(spark, sf_dir, "events").select(
        "event_id", F.when(has_it, added).otherwise(F.col("props")).alias("json")
    )
    return objects.select(
        "event_id",
        metadata_key(F.col("json"), "Content-Type").alias("content_type"),
        F.array_join(metadata_keys(F.col("json")), ",").alias("keys"),
    )


@query(
    r"""
SELECT doc_id, regexp_replace(text, '^\s+|\s+$', '', 'g') || '|' || chr(65533) AS cleaned FROM documents"""
)
def cleaned_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with NUL characters, a malformed byte and white space around them, cleaned."""
    trimmed = F.regexp_replace("text", r"\A\s+|\s+\z", "")
    dirty = F.concat(F.lit(b" \t\x00"), F.encode(trimmed, "UTF-8"), F.lit(b"\x00|\xff\x00\r\n "))
    return fixtures.spread_table(spark, sf_dir, "documents", "doc_id").select("doc_id", clean_text(dirty).alias("cleaned"))


_BLOCK = (
    "address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|head|header|hr|html|li|"
    "main|nav|ol|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul"
)


@query(
    rf"""
WITH stripped AS (
  SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
    '<!--.*?-->', '', 'gs'), '(?i)<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'gs'),
    '(?i)</?(?:{_BLOCK})\b[^>]*>', chr(10), 'g'), '<[!/a-zA-Z][^>]*>', '', 'g') AS t
  FROM pages),
resolved AS (
  SELECT page_id, replace(replace(replace(replace(replace(replace(t,
    '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&middot;', '·'), '&copy;', '©'), '&amp;', '&') AS t
  FROM stripped)
SELECT page_id, regexp_replace(regexp_replace(regexp_replace(t, '[ \t\r\f]+', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g'),
                               '^\s+|\s+$', '', 'g') AS visible
FROM resolved"""
)
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of all pages."""
    return fixtures.spread_table(spark, sf_dir, "pages", "page_id").select(
        "page_id", html_to_text(F.col("html")).alias("visible")
    )


@query(
    """
SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN doc_id || '.txt' WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE source END AS name,
       CASE doc_id % 4 WHEN 0 THEN 'aa/bb/' || doc_id || '.txt' WHEN 3 THEN 'aa/bb/' || source END AS path
FROM documents"""
)
def entry_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of archive entries, entries that leave the archive refused, and their paths in the output."""
    doc_id, kind = F.col("doc_id").cast("string"), F.col("doc_id") % 4
    entry = (
        F.when(kind == 0, F.concat(F.lit("a/../b/./"), doc_id, F.lit(".txt")))
        .when(kind == 1, F.concat(F.lit("a/../../"), doc_id))
        .when(kind == 2, F.concat(F.lit("/"), doc_id))
        .otherwise(F.concat(F.col("source"), F.lit("/")))
    )
    chain = extend_chain(F.array(F.lit("aa")), F.lit("bb"))
    names = fixtures.table(spark, sf_dir, "documents").select("doc_id", safe_name(entry).alias("name"))
    return names.select("doc_id", "name", F.when(F.col("name").isNotNull(), archive_path(chain, F.col("name"))).alias("path"))


@query(
    """
SELECT doc_id, 'message/rfc822' AS mimetype, 'd' || doc_id || '@example.invalid' AS message_id FROM documents"""
)
def folded_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mails with a header folded at every word of a document, and an id with a comment behind it."""
    docs = fixtures.table(spark, sf_dir, "documents")
    words = F.replace(F.replace(F.col("text"), F.lit("\n"), F.lit(" ")), F.lit(" "), F.lit("\n "))
    head = F.concat(
        F.lit("To: "), words, F.lit("\nMessage-ID:\n\t<d"), F.col("doc_id").cast("string"), F.lit("@example.invalid> (relayed)\nSubject: s\n\nbody")
    )
    mails = docs.select("doc_id", F.encode(head, "UTF-8").alias("content"))
    return mails.select("doc_id", identify(F.col("content")).alias("mimetype"), message_id(F.col("content")).alias("message_id"))


@query("SELECT event_id, 'missing_key' AS error_class, 'Content-Type' AS message FROM events WHERE event_id % 3 = 2")
def metadata_missing_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error rows for metadata without a content type."""
    added = F.concat(F.regexp_replace("props", r"\}\s*$", ""), F.lit(', "Content-Type": "text/plain"}'))
    text = F.when(F.col("event_id") % 3 != 2, added).otherwise(F.col("props"))
    none = F.lit(None).cast("string")
    outputs = fixtures.table(spark, sf_dir, "events").select(
        none.alias("job_id"), none.alias("root_id"), F.col("event_id").alias("file_id"), F.lit("metadata").alias("process_type"), text.alias("text")
    )
    return missing_key_errors(outputs, "Content-Type").select(F.col("file_id").alias("event_id"), "error_class", "message")
