"""Connected components of a table of links, by alternating star contractions.

Every round replaces links by links to the smallest neighbour, first for the larger neighbours of a node, then for the
smaller ones, until each node hangs on its component's smallest node. Only a count and a checksum reach the driver; the
links themselves stay in tables in the shared folder, so a lost executor costs at most one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twosided.session import materialise


def _summary(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of a link between two different nodes; the component is its smallest node.

    Nodes are of any type that can be ordered. Links with a null end, loops and repeated links change nothing; no links
    give no rows. The smallest neighbour is found by an aggregate that is combined before the shuffle, and the
    two joins of a round can be split by Spark where a node has very many links.
    """
    high, low = F.greatest(F.col(a), F.col(b)), F.least(F.col(a), F.col(b))
    proper = links.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    now = materialise(proper.select(high.alias("u"), low.alias("v")).distinct(), "links")
    before, seen = None, _summary(now)
    while seen[0] and seen != before:
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(
            F.col("v").alias("u"), F.col("m").alias("v")))).alias("link")).select("link.*").filter("u > v").distinct()
        now = materialise(small, "links")
        before, seen = seen, _summary(now)
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
