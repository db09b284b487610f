"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampleledger.llm.common import cut


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``links``: ``root`` is the smallest node reachable.

    Each round a node takes the smallest root among its own and its neighbours', its old root takes
    the smallest that any of its nodes found (so whole trees hang themselves on smaller ones, not
    only the nodes at their edges), and every node then follows its root's root. The rounds grow
    with the logarithm of the nodes: the tests count 13 for a chain of 4,096 in order, and no more
    than twice the logarithm for one in random order. A round is three joins and two groupings that
    combine on the map side; a node with very many links is a skewed join key, which adaptive
    execution splits. Rows with a null end are no links. No links give no rows.
    """
    ends = links.select(F.col(a).alias("src"), F.col(b).alias("dst")).filter("src <> dst")
    both = cut(ends.union(ends.select("dst", "src")).distinct())
    roots = cut(both.groupBy(F.col("src").alias("node")).agg(F.least(F.min("dst"), F.col("src")).alias("root")))
    while True:
        near = both.join(roots.select(F.col("node").alias("src"), F.col("root").alias("candidate")), "src")
        best = near.groupBy(F.col("dst").alias("node")).agg(F.min("candidate").alias("candidate"))
        closer = cut(roots.join(best, "node").select("node", F.col("root").alias("was"), F.least("root", "candidate").alias("root")))
        # an old root hears what its nodes found; roots are nodes themselves
        heard = closer.groupBy(F.col("was").alias("node")).agg(F.min("root").alias("heard"))
        hung = cut(closer.join(heard, "node", "left").select("node", "was", F.least("root", "heard").alias("root")))
        up = hung.select(F.col("node").alias("root"), F.col("root").alias("above"))
        moved = cut(hung.join(up, "root").select("node", "was", F.least("root", "above").alias("root")))
        if moved.filter("root <> was").isEmpty():
            return moved.select("node", "root")
        roots = moved.select("node", "root")
