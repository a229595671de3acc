"""Groups of linked things: comparing cells in blocks, and connected components."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthspan.llm.shared import saved


def blocked(members: DataFrame, keys: list[str], node: str, block: int) -> DataFrame:
    """Cut cells into pairs of blocks, so that a task never holds more than two blocks at once.

    ``members`` has a row per cell (``keys``) and node. Cells of one member are left out, as they
    hold no pair. A cell of n members gets n / block blocks, a member's block follows from its hash,
    and a row comes back for each pair of blocks (lo, hi) that the member's own block is part of.
    Sizes are counted before rows move, and the rows meet their counts in a join whose large
    partitions Spark splits, so one cell may hold any share of all rows.
    """
    sizes = members.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    blocks = F.ceil(F.col("_n") / block).cast("int")
    sized = members.join(sizes, keys).withColumn("_blocks", blocks)
    own = F.pmod(F.xxhash64(F.col(node)), F.col("_blocks")).cast("int")
    sized = sized.withColumn("own", own)
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    paired = sized.withColumn("_other", other)
    return paired.select(
        *members.columns,
        "own",
        F.least("own", "_other").alias("lo"),
        F.greatest("own", "_other").alias("hi"),
    )


def together(cells: DataFrame, keys: list[str], node: str) -> DataFrame:
    """Bring the rows of each pair of blocks together, sorted."""
    place = [*keys, "lo", "hi"]
    return cells.repartition(*place).sortWithinPartitions(*place, node)


def least_reached(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of n sorted nodes the first one that links lead to."""
    least = np.arange(n)
    while len(left):
        low = np.minimum(least[left], least[right])
        before = least.copy()
        np.minimum.at(least, left, low)
        np.minimum.at(least, right, low)
        least = least[least]
        if (least == before).all():
            break
    return least


def components(links: DataFrame, name: str) -> DataFrame:
    """Connected components of undirected links (a, b): node and component, its least node.

    Every round hooks each node to its least neighbour, follows the hooks two doublings far and
    contracts what has met; rounds grow with the logarithm of the longest chain. Each round's tables
    are written to the shared folder. Nothing but the question whether links are left reaches the
    driver. Without links the result is empty.
    """
    links = saved(links.where("a <> b").select("a", "b").distinct(), f"{name}-links")
    found = None
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy("a").agg(F.min("b").alias("b"))
        hooks = saved(hooks.select("a", F.least("a", "b").alias("b")), f"{name}-hooks")
        for _ in range(2):
            further = hooks.select(F.col("a").alias("b"), F.col("b").alias("c"))
            hooks = hooks.join(further, "b").select("a", F.col("c").alias("b"))
        hooks = saved(hooks, f"{name}-jumps")
        if found is None:
            found = hooks.select(F.col("a").alias("node"), F.col("b").alias("component"))
        else:
            onward = hooks.select(F.col("a").alias("component"), F.col("b").alias("_onward"))
            moved = found.join(onward, "component", "left")
            found = moved.select("node", F.coalesce("_onward", "component").alias("component"))
        found = saved(found, f"{name}-found")
        left = hooks.select("a", F.col("b").alias("x"))
        right = hooks.select(F.col("a").alias("b"), F.col("b").alias("y"))
        contracted = links.join(left, "a").join(right, "b").where("x <> y")
        links = saved(
            contracted.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
            f"{name}-links",
        )
    if found is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found
