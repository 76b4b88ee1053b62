"""The registered queries: name, Spark job, and the equal SQL over the driver's tables where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docsift.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(configure(spark), sf_dir)

        QUERIES[function.__name__] = run
        if sql is not None:
            ORACLES[function.__name__] = sql
        return run

    return register


# SQL for the mails that fixtures.py builds, shared by the oracles.
TURNS = """
WITH turns AS (
  SELECT conv_id, turn, role, text, 'c' || conv_id || '-t' || turn AS key,
         TIMESTAMP '2024-01-01 00:00:00' + to_seconds(conv_id * 3600 + turn * 60) AS at_local,
         CASE conv_id % 4 WHEN 0 THEN '+0000' WHEN 1 THEN '-0800' WHEN 2 THEN '+0530' ELSE '-0330' END AS zone,
         CASE conv_id % 4 WHEN 0 THEN 0 WHEN 1 THEN -28800 WHEN 2 THEN 19800 ELSE -12600 END AS zone_seconds,
         'Turn ' || turn || ': ' || split_part(text, chr(10), 1) || '.' AS subject,
         (conv_id * 8 + turn) % 10 <> 9 AS has_id
  FROM conversations),
dated AS (
  SELECT *, strftime(at_local, '%Y-%m-%dT%H:%M:%S')
              || CASE zone WHEN '+0000' THEN 'Z' ELSE left(zone, 3) || ':' || right(zone, 2) END AS sent_iso,
         at_local - to_seconds(zone_seconds) AS sent_utc
  FROM turns),
common AS (
  SELECT *, concat_ws(chr(10),
           CASE WHEN has_id THEN 'Message-ID: <' || key || '@example.invalid>' END,
           'Date: ' || strftime(at_local, '%a, %d %b %Y %H:%M:%S ') || zone,
           'From: Role ' || role || ' <' || role || '@example.invalid>',
           'To: Review Team <team@example.invalid>, archive@example.invalid',
           'Subject: =?utf-8?B?' || base64(encode(subject)) || '?=',
           'X-Thread: ' || key,
           'MIME-Version: 1.0') AS head
  FROM dated),
plain AS (
  SELECT *, head || chr(10) || 'Content-Type: text/plain; charset=utf-8' || chr(10)
           || CASE WHEN turn % 2 = 0
                   THEN 'Content-Transfer-Encoding: base64' || chr(10) || chr(10) || base64(encode(text))
                   ELSE 'Content-Transfer-Encoding: 8bit' || chr(10) || chr(10) || text END AS mail
  FROM common),
attached AS (
  SELECT *, 'turn-' || turn || '.txt' AS file_name,
         head || chr(10) || 'Content-Type: multipart/mixed; boundary="=-part"' || chr(10) || chr(10)
           || '--=-part' || chr(10) || 'Content-Type: text/plain; charset=utf-8' || chr(10)
           || 'Content-Transfer-Encoding: base64' || chr(10) || chr(10) || base64(encode(text)) || chr(10)
           || '--=-part' || chr(10) || 'Content-Type: text/plain' || chr(10)
           || 'Content-Disposition: attachment; filename="turn-' || turn || '.txt"' || chr(10)
           || 'Content-Transfer-Encoding: base64' || chr(10) || chr(10) || base64(encode(text)) || chr(10)
           || '--=-part--' || chr(10) AS mail
  FROM common),
zeros AS (SELECT repeat(chr(0), 1000000) AS z)
"""

FROM_LINE = "'From sender@example.invalid Mon Jan  1 00:00:00 2024' || chr(10)"


def buffer_md5_sql(text: str) -> str:
    """The padded checksum of a text shorter than the buffer; needs ``zeros`` of TURNS in scope."""
    return f"md5(CASE WHEN {text} = '' THEN '' ELSE {text} || left(zeros.z, 1000000 - strlen({text})) END)"
