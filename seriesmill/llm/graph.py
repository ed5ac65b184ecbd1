"""Connected components of a link table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.llm.work import Work


def components(edges: DataFrame, work: Work) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); root is the smallest node of the component.

    Each round points every node at the smallest of itself and its neighbours, follows the
    pointers to their ends (doubling the step each time), and replaces the ends of all links by
    those roots. Rounds grow with the logarithm of the component size. Every table is written
    before it is joined, so that a node with very many links is a skewed join that the engine
    can split, and aggregates combine before they shuffle. Loops and repeated links are ignored.
    An empty link table gives an empty result.
    """
    links = work.settle(_canonical(edges), "links")
    found = None
    while not links.isEmpty():
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            links.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        up = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("p"))
        up = work.settle(up, "parents")
        while True:
            over = up.select(F.col("u").alias("mid"), F.col("p").alias("far"))
            jumped = up.join(over, up.p == over.mid).select("u", F.col("far").alias("p"), (F.col("far") != up.p).alias("moved"))
            jumped = work.settle(jumped, "jumped")
            moved = not jumped.filter("moved").isEmpty()
            work.drop(up)
            up = jumped.select("u", "p")
            up._settled_at = jumped._settled_at
            if not moved:
                break
        of = lambda end: up.select(F.col("u").alias(end), F.col("p").alias(f"{end}_root"))
        closer = links.join(of("a"), "a").join(of("b"), "b").select(F.col("a_root").alias("a"), F.col("b_root").alias("b"))
        contracted = work.settle(_canonical(closer), "links")
        if found is None:
            now = up.select(F.col("u").alias("node"), F.col("p").alias("root"))
        else:
            now = found.join(up, found.root == up.u, "left").select("node", F.coalesce("p", "root").alias("root"))
        now = work.settle(now, "roots")
        work.drop(links, up, *([found] if found is not None else []))
        links, found = contracted, now
    if found is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return found


def _canonical(edges: DataFrame) -> DataFrame:
    return (
        edges.filter("a != b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
