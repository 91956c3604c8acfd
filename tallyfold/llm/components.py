"""Connected components of a link table, by repeated contraction."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (two columns of the same integer type).

    `root` is the least node of the component. Each round points every node at its least
    neighbour, follows the pointers to their ends, and replaces the nodes of all links by
    those ends; links inside one group vanish. Rounds grow as the logarithm of the number of
    nodes, also for long chains. Nothing but counts reaches the driver, and every grouping
    is a minimum that is combined before its shuffle, so a hub with very many links is no
    hot key. Null ends and loops are ignored; an empty table gives an empty result.
    """
    a, b = (F.col(c) for c in links.columns)
    ends = links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    live = cut(ends.where("a < b").distinct())
    label = None
    while not live.isEmpty():
        both = live.unionAll(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = F.least("node", "up").alias("up")
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("up"))
        hook = _to_the_end(cut(least.select("node", up)))
        if label is None:
            label = hook.select("node", F.col("up").alias("root"))
        else:
            found = hook.select(F.col("node").alias("root"), "up")
            root = F.coalesce("up", "root").alias("root")
            label = cut(label.join(found, "root", "left").select("node", root))
        left = hook.select(F.col("node").alias("a"), F.col("up").alias("a_up"))
        right = hook.select(F.col("node").alias("b"), F.col("up").alias("b_up"))
        low, high = F.least("a_up", "b_up"), F.greatest("a_up", "b_up")
        moved = live.join(left, "a").join(right, "b")
        live = cut(moved.select(low.alias("a"), high.alias("b")).where("a < b").distinct())
    if label is None:
        return live.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return label


def _to_the_end(hook: DataFrame) -> DataFrame:
    """Pointers (node, up) to smaller nodes, replaced by pointers to the last node reached."""
    while True:
        far = hook.select(F.col("node").alias("up"), F.col("up").alias("far"))
        hook = cut(hook.join(far, "up").select("node", F.col("far").alias("up"), (F.col("far") != F.col("up")).alias("moved")))
        if hook.where("moved").isEmpty():
            return hook.drop("moved")
        hook = hook.drop("moved")
