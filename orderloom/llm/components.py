"""Connected components of a link table, by hooking and pointer jumping on DataFrames.

Each round points every node to the smallest of itself and its neighbours,
doubles those pointers until they end in local minima, and contracts the links
to links between these minima. A round at least halves the nodes that still
have links, so a few rounds suffice; every table is written to the shared
checkpoint folder before it is read again. Nothing but row counts reaches the
driver. A node with very many links is summed before the shuffle (min), and
joins on it are split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import stored


def _contracted(links: DataFrame) -> DataFrame:
    """Smaller end first, no self links, each link once."""
    return (links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .where(F.col("a") != F.col("b")).distinct())


def _to_roots(parents: DataFrame) -> DataFrame:
    """Double the pointers of (node, parent) until every parent is its own parent."""
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        parents = stored(parents.join(up, "parent").select("node", F.col("grand").alias("parent"),
                                                           (F.col("grand") != F.col("parent")).alias("moved")), "pointers")
        if parents.where("moved").isEmpty():
            return parents.select("node", "parent")


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b) that links to another one: the smallest node reachable."""
    links = stored(_contracted(links), "links")
    found = None
    while not links.isEmpty():
        ends = links.select("a", "b").union(links.select("b", "a")).toDF("node", "other")
        parents = ends.groupBy("node").agg(F.min("other").alias("other")).select("node", F.least("node", "other").alias("parent"))
        roots = _to_roots(stored(parents, "parents"))
        up = roots.select(F.col("node").alias("component"), F.col("parent").alias("root"))
        found = roots.toDF("node", "component") if found is None else stored(
            found.join(up, "component", "left").select("node", F.coalesce("root", "component").alias("component")), "components")
        a, b = roots.toDF("a", "ra"), roots.toDF("b", "rb")
        links = stored(_contracted(links.join(a, "a").join(b, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))), "links")
    return links.toDF("node", "component") if found is None else found
