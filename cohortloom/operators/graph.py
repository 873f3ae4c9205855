"""Connected components of edge tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.session import cut_lineage, few_tasks


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60, at_most: int | None = None) -> DataFrame:
    """(node, component): every node with the smallest node id it can reach.

    Each round hangs every node below its smallest neighbour (a partial aggregate, so a hub node with a third of all
    edges is combined map-side), follows the trees to their roots by pointer doubling, and keeps only the distinct edges
    between different roots.  So an edge inside a tree is never shuffled again, an edge is held in one direction only, and
    a node's own row is read once more at the end, when the roots' labels come down.  Each round at least halves the nodes
    that still have edges.  Tables are stored every round, so neither the plan nor the loss of an executor grows with the
    number of rounds; edges are counted, so the tables of late rounds are a few files.  ``at_most`` is a bound of the
    edges given, if one is known.
    """
    given = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).filter(F.col("a").isNotNull() & F.col("b").isNotNull())
    left = cut_lineage(few_tasks(_edges(given), at_most))
    n = first = left.count()
    alone = left.filter("lo = hi").select(F.col("lo").alias("node"), F.col("lo").alias("component"))
    left, levels, below = left.filter("lo < hi"), [], 0
    for _ in range(max_rounds):
        roots = _roots(left.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("root")), max_rounds, n)
        levels.append(roots)
        below += n
        up = left.join(roots.select(F.col("node").alias("hi"), F.col("root").alias("__h")), "hi")
        both = up.join(roots.select(F.col("node").alias("lo"), F.col("root").alias("__l")), "lo", "left")
        between = both.select(F.coalesce("__l", "lo").alias("a"), F.col("__h").alias("b")).filter("a <> b")
        left = cut_lineage(few_tasks(_edges(between), n))
        n = left.count()
        if not n:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    # A node hangs below a root on one level only; the last level's roots are final.
    done = levels.pop().withColumnRenamed("root", "component")
    for level in reversed(levels):
        top = done.select(F.col("node").alias("root"), F.col("component").alias("__c"))
        done = cut_lineage(few_tasks(done.unionByName(level.join(top, "root", "left").select("node", F.coalesce("__c", "root").alias("component"))), below))
    tops = done.select(F.col("component").alias("node"), "component")
    return cut_lineage(few_tasks(reduce(DataFrame.unionByName, [done, tops, alone]).groupBy("node").agg(F.min("component").alias("component")), 2 * below + first))


def _edges(pairs: DataFrame) -> DataFrame:
    """Distinct pairs with the smaller end first."""
    return pairs.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct()


def _roots(parents: DataFrame, max_rounds: int, at_most: int) -> DataFrame:
    """(node, root) of the nodes that have a parent (``root`` of the input), stored; a node that is not listed is a root."""
    parents = cut_lineage(few_tasks(parents, at_most))
    for _ in range(max_rounds):
        above = parents.select(F.col("node").alias("root"), F.col("root").alias("__up"))
        if not parents.join(above, "root", "left_semi").limit(1).count():
            return parents
        parents = cut_lineage(few_tasks(parents.join(above, "root", "left").select("node", F.coalesce("__up", "root").alias("root")), at_most))
    raise RuntimeError(f"roots were not reached in {max_rounds} rounds")
