"""Connected components of a large graph by alternating large and small stars, in joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexforge.llm.staging import staged, unstage


def _least_neighbours(edges: DataFrame) -> DataFrame:
    """Each node's smallest neighbour; dealt out anew, so that a join with the edges can split a node that has very many."""
    n = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return edges.groupBy("u").agg(F.min("v").alias("m")).repartition(n, "u", "m")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, component), staged: the smallest node reachable, for every node that has an edge to another node.

    Each round hangs every node's larger neighbours, then its smaller ones, on the smallest node that it sees; rounds end
    when nothing changes, and their number grows with the logarithm of the longest path.  Repeated, reversed and looping
    edges and an empty table are fine; edges with a null end are left out.
    """
    pair = lambda df, x, y: df.filter(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct()
    now = staged(pair(edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull()), F.col(a), F.col(b)), "edges")
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        seen = both.join(_least_neighbours(both), "u").filter(F.col("v") > F.col("u"))
        large = staged(pair(seen, F.col("v"), F.least("m", "u")), "edges")
        held = large.join(_least_neighbours(large), "u")
        small = staged(pair(held.select("v", "m").unionByName(held.select(F.col("u").alias("v"), "m")), F.col("v"), F.col("m")), "edges")
        unstage(now)
        unstage(large)
        r = small.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).head()
        now = small
        if (r["n"], r["h"]) == mark or not r["n"]:
            break
        mark = r["n"], r["h"]
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    out = staged(nodes.unionByName(roots), "components")
    unstage(now)
    return out
