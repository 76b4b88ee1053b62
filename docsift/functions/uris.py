"""Object-store URIs as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def object_location(uri: Column, strict: bool = True) -> Column:
    """``struct<bucket, key>`` of an object URI, NULL when it is not one.

    Strict: the scheme is ``s3``, host and path are present, and the path is percent-decoded. Otherwise any scheme
    with a host will do, and the key may be empty.
    """
    scheme = F.try_parse_url(uri, F.lit("PROTOCOL"))
    host = F.try_parse_url(uri, F.lit("HOST"))
    path = F.coalesce(F.try_parse_url(uri, F.lit("PATH")), F.lit(""))
    key = F.regexp_replace(path, "^/", "")
    if strict:
        # '+' is an ordinary character of a path, unlike in a query string.
        key = F.try_url_decode(F.replace(key, F.lit("+"), F.lit("%2B")))
        ok = (F.lower(scheme) == "s3") & (host != "") & (path != "") & key.isNotNull()
    else:
        ok = scheme.isNotNull() & (host != "")
    return F.when(ok, F.struct(host.alias("bucket"), key.alias("key")))


def hadoop_uri(uri: Column) -> Column:
    """The same object under the scheme of Spark's object-store connector."""
    return F.regexp_replace(uri, "^s3://", "s3a://")
