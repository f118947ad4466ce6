"""Connected components of a table of links, without gathering a component anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``(id, label)``: the smallest node that links (columns ``a`` and ``b``) reach, for each node in a link.

    Alternates two steps until nothing changes (large-star and small-star of the
    published algorithm): each node tells its larger neighbours, then its smaller
    ones, of the smallest it knows.  Minima are summed map-side and joined back, so
    a node with very many links is split like any skewed join key.  Each round's
    links are a table in the shared folder.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stored(edges, "links")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # a table, as it is used three times below, and the driver plans each use anew
        large = stored(both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "links")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(low, "a")
        small = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        new = stored(small, "links")
        # done when every link leads from a node to its component's smallest, that is: no change;
        # links are distinct on both sides, so one that comes once has changed
        if new.unionByName(edges).groupBy("a", "b").count().where("count = 1").isEmpty():
            break
        edges = new
    return edges.select(F.col("a").alias("id"), F.col("b").alias("label")).unionByName(
        edges.select(F.col("b").alias("id"), F.col("b").alias("label")).distinct())
