"""Connected components of a graph as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.llm.common import saved


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` for every node that has a link, with the smallest node it reaches as ``root``.

    Large and small stars in turn: every node's greater, then its smaller neighbours are linked to the least of them,
    until nothing changes. Links never become more, a hub's neighbours are reduced to their minimum before they are
    shuffled, and only a count and a checksum of the links come to the driver. Rounds grow with the logarithm of a
    component's diameter. Each round is written to the shared folder. Links with a null end and loops are no links.
    """
    edges = saved(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull()).where("u <> v").distinct(),
        "links",
    )
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = saved(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if (row.n, row.s) == state:
            break
        state = (row.n, row.s)
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
