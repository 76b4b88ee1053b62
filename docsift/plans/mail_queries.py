"""Queries on mails: parsing, bodies, rendering, metadata, fields, identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.functions.dates import mail_date_iso, mail_date_utc
from docsift.functions.identity import dedupe_checksum, message_id
from docsift.functions.mail_columns import (
    bodies,
    body_text,
    extracted_text,
    header,
    header_value,
    mail_metadata,
    render,
)
from docsift.operators.expand import expand_once, files_of, messages_of
from docsift.operators.fielded import file_fields, message_fields
from docsift.operators.mail import parsed_mail
from docsift.plans import fixtures
from docsift.plans.catalog import TURNS, buffer_md5_sql, query
from docsift.plans.process import as_roots
from docsift.session import staged


def _parsed(mails: DataFrame, *keys: str) -> DataFrame:
    return mails.select(*keys, "content", parsed_mail("content").alias("m")).select(*keys, "content", "m.*")


def md5_text(text: Column) -> Column:
    return F.md5(F.encode(text, "UTF-8"))


@query(
    TURNS
    + """
SELECT conv_id, turn, CASE WHEN has_id THEN key || '@example.invalid' END AS message_id,
       'Role ' || role || ' <' || role || '@example.invalid>' AS sender,
       'Review Team <team@example.invalid>, <archive@example.invalid>' AS recipients,
       subject, sent_iso, sent_utc, text AS body,
       CAST(CASE WHEN has_id THEN 9 ELSE 8 END AS BIGINT) AS n_headers, CAST(1 AS BIGINT) AS n_parts
FROM dated"""
)
def rfc822_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn as a mail, parsed: headers, dates, body."""
    headers, parts = F.col("headers"), F.col("parts")
    sent = header(headers, "Date")["raw"]
    return _parsed(fixtures.mails(spark, sf_dir), "conv_id", "turn").select(
        "conv_id",
        "turn",
        message_id(F.col("content")).alias("message_id"),
        header_value(headers, "From").alias("sender"),
        header_value(headers, "To").alias("recipients"),
        header_value(headers, "Subject").alias("subject"),
        mail_date_iso(sent).alias("sent_iso"),
        mail_date_utc(sent).alias("sent_utc"),
        body_text(parts).alias("body"),
        F.size(headers).cast("bigint").alias("n_headers"),
        F.size(parts).cast("bigint").alias("n_parts"),
    )


@query(TURNS + "SELECT conv_id, turn, md5(text || chr(10) || chr(10)) AS text_md5 FROM turns")
def mail_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text extracted from every turn's mail."""
    text = extracted_text(F.col("parts"))
    return _parsed(fixtures.mails(spark, sf_dir), "conv_id", "turn").select("conv_id", "turn", md5_text(text).alias("text_md5"))


@query(
    TURNS
    + f"""
SELECT conv_id, turn, has_id,
       {buffer_md5_sql("CASE WHEN has_id THEN key || '@example.invalid' ELSE mail END")} AS checksum, md5(mail) AS content_md5
FROM plain, zeros"""
)
def message_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dedupe checksum of mails: by Message-ID, or by content where there is none."""
    content = F.col("content")
    return fixtures.mails(spark, sf_dir).select(
        "conv_id",
        "turn",
        message_id(content).isNotNull().alias("has_id"),
        dedupe_checksum(content, F.col("mimetype")).alias("checksum"),
        F.md5(content).alias("content_md5"),
    )


@query(
    TURNS
    + """
SELECT conv_id, turn,
       '<div><b>Date</b>: ' || sent_iso || '</div>' || chr(10)
       || '<div><b>From</b>: Role ' || role || ' &lt;' || role || '@example.invalid&gt;</div>' || chr(10)
       || '<div><b>To</b>: Review Team &lt;team@example.invalid&gt;, &lt;archive@example.invalid&gt;</div>' || chr(10)
       || '<div><b>Subject</b>: ' || replace(replace(replace(subject, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</div>'
       || chr(10) || '<br>' || chr(10) || '<div>'
       || array_to_string(list_transform(string_split(text, chr(10)),
            lambda x: '<p>' || replace(replace(replace(x, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</p>'), chr(10))
       || '</div>' AS html
FROM dated"""
)
def render_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn's mail rendered as HTML."""
    return _parsed(fixtures.mails(spark, sf_dir), "conv_id", "turn").select(
        "conv_id", "turn", render(F.col("headers"), F.col("parts")).alias("html")
    )


@query(
    TURNS
    + """
SELECT conv_id, turn, u.k AS key, u.v AS value
FROM plain, LATERAL (SELECT unnest([
  {k: 'Content-Type', v: 'message/rfc822'}, {k: 'dc:subject', v: subject}, {k: 'dc:title', v: subject},
  {k: 'dc:creator', v: 'Role ' || role || ' <' || role || '@example.invalid>'},
  {k: 'Message-From', v: 'Role ' || role || ' <' || role || '@example.invalid>'},
  {k: 'Message:From-Email', v: role || '@example.invalid'}, {k: 'Message:From-Name', v: 'Role ' || role},
  {k: 'Message-To', v: 'Review Team <team@example.invalid>, <archive@example.invalid>'},
  {k: 'dcterms:created', v: strftime(sent_utc, '%Y-%m-%dT%H:%M:%SZ')},
  {k: 'Message:Raw-Header:Message-ID', v: CASE WHEN has_id THEN '<' || key || '@example.invalid>' END},
  {k: 'Message:Raw-Header:X-Thread', v: key}, {k: 'Message:Raw-Header:MIME-Version', v: '1.0'},
  {k: 'Message:Raw-Header:Content-Type', v: 'text/plain; charset=utf-8'},
  {k: 'Message:Raw-Header:Content-Transfer-Encoding', v: CASE WHEN turn % 2 = 0 THEN 'base64' ELSE '8bit' END}
]) AS u) WHERE u.v IS NOT NULL"""
)
def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of every turn's mail, one row per key."""
    return (
        _parsed(fixtures.mails(spark, sf_dir), "conv_id", "turn")
        .select("conv_id", "turn", F.explode(mail_metadata(F.col("headers"))).alias("key", "values"))
        .select("conv_id", "turn", "key", F.array_join("values", "; ").alias("value"))
    )


_PAGE_FILES = """
SELECT d.doc_id, p.html IS NOT NULL AS is_page, coalesce(p.html, d.text) AS content,
       CASE WHEN p.html IS NOT NULL THEN 'text/html' ELSE 'text/plain' END AS mimetype,
       CASE WHEN d.doc_id % 7 = 0 THEN 'message-attachment.dat'
            WHEN p.html IS NOT NULL THEN 'page-' || d.doc_id || '.html' ELSE 'notes.txt' END AS name
FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id"""


@query(
    f"""
SELECT doc_id, name, mimetype, CAST(strlen(content) AS BIGINT) AS length, md5(content) AS content_md5,
       CAST(1 AS BIGINT) AS depth, 'doc-' || doc_id || '.eml' AS parent_name
FROM ({_PAGE_FILES})"""
)
def attachments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attached files of one mail per document."""
    mails = fixtures.page_mails(spark, sf_dir)
    roots = as_roots(mails, types=["embedded"], checksums=False)
    parents = mails.select(F.col("root_id"), F.col("name").alias("parent_name"))
    found = files_of(expand_once(roots)).select(
        F.col("root_id").cast("bigint").alias("doc_id"),
        "root_id",
        "name",
        "mimetype",
        "length",
        F.md5("content").alias("content_md5"),
        F.col("depth").cast("bigint").alias("depth"),
    )
    return found.join(parents, "root_id").drop("root_id")


@query(
    """
SELECT page_id, CASE WHEN page_id % 3 = 1 THEN 'text' ELSE 'html' END AS kind,
       CAST(CASE WHEN page_id % 3 = 0 THEN 3 ELSE 1 END AS BIGINT) AS n_parts,
       md5(CASE WHEN page_id % 3 = 1 THEN 'Page at ' || url ELSE html END) AS body_md5,
       md5('<div><b>From</b>: &lt;web@example.invalid&gt;</div>' || chr(10) || '<br>' || chr(10) || '<div>'
           || CASE WHEN page_id % 3 = 1
                   THEN '<p>Page at ' || replace(replace(replace(url, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</p>'
                   ELSE html END
           || '</div>') AS rendered_md5
FROM pages"""
)
def body_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which body of a mail is shown when it has alternatives, and that HTML passes through unescaped."""
    mails = fixtures.alternative_mails(spark, sf_dir)
    shown = F.get(bodies(F.col("parts")), F.lit(0))
    return _parsed(mails, "root_id").select(
        F.col("root_id").cast("bigint").alias("page_id"),
        shown["kind"].alias("kind"),
        F.size("parts").cast("bigint").alias("n_parts"),
        md5_text(shown["text"]).alias("body_md5"),
        md5_text(render(F.col("headers"), F.col("parts"))).alias("rendered_md5"),
    )


@query(
    f"""
WITH files AS ({_PAGE_FILES})
SELECT 'doc-' || doc_id || '.eml' AS FileName, '.eml' AS FileExtension,
       CAST(strlen('Message-ID: <doc-' || doc_id || '@example.invalid>' || 'Date: Mon, 1 Jan 2024 10:00:00 +0200'
         || 'From: sender@example.invalid' || 'To: team@example.invalid' || 'Subject: Document ' || doc_id
         || 'MIME-Version: 1.0' || 'Content-Type: multipart/mixed; boundary="=-part"' || '--=-part'
         || 'Content-Type: text/plain; charset=utf-8' || 'See the attached file.' || '--=-part'
         || 'Content-Type: ' || CASE WHEN is_page THEN 'text/html; charset=utf-8' ELSE 'Text/Plain' END
         || 'Content-Disposition: attachment' || CASE WHEN doc_id % 7 = 0 THEN '' ELSE '; filename="' || name || '"' END
         || 'Content-Transfer-Encoding: base64' || base64(encode(content)) || '--=-part--') + 19 AS BIGINT) AS FileSize,
       'sender@example.invalid' AS sender_address, '<team@example.invalid>' AS "To", CAST(NULL AS VARCHAR) AS CC,
       'Document ' || doc_id AS Subject, TIMESTAMP '2024-01-01 08:00:00' AS DateSent, TRUE AS HasAttachments,
       CAST(1 AS BIGINT) AS AttachmentCount, name AS AttachmentNames,
       CAST(NULL AS VARCHAR) AS ReviewComment
FROM files
UNION ALL
SELECT name, CASE WHEN name LIKE '%.dat' THEN '.dat' WHEN name LIKE '%.html' THEN '.html' ELSE '.txt' END,
       strlen(content), NULL, NULL, NULL, NULL, NULL, FALSE, 0, NULL, NULL
FROM files"""
)
def fielded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load-file fields of one mail per document and of its attached file."""
    roots = as_roots(fixtures.page_mails(spark, sf_dir), types=["metadata", "embedded"])
    level = staged(expand_once(roots), "fielded")
    files = roots.unionByName(files_of(level))
    rows = file_fields(files).join(message_fields(messages_of(level)), "file_id", "left")
    return rows.select(
        "FileName",
        "FileExtension",
        "FileSize",
        F.regexp_extract("From", "<([^>]*)>", 1).alias("sender_address"),
        "To",
        "CC",
        "Subject",
        "DateSent",
        F.coalesce("HasAttachments", F.lit(False)).alias("HasAttachments"),
        F.coalesce(F.col("AttachmentCount").cast("bigint"), F.lit(0)).alias("AttachmentCount"),
        "AttachmentNames",
        "ReviewComment",
    )
