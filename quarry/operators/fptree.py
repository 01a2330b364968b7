"""Frequent itemsets by conditional FP-trees, with the length cap inside.

Items are numbered by descending frequency and baskets written as ascending numbers, so what is frequent stands in
front. The conditional database of a suffix (a set already known to be frequent) holds, for every basket with that set,
the items in front of it; equal rows are one row with a weight, added up before they are shuffled. A database with few
enough rows is mined in one task: its rows become an FP-tree, and the sets that end in each item come from the item's
conditional tree, no deeper than the cap allows. A larger one is first divided over the cluster by its next item, so no
task ever holds more than ``ROWS`` rows, however many baskets share a set. No set longer than the cap is built anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import ship_package, stored

ROWS = 200_000               # distinct rows of a conditional database that one task mines


class Node:
    """A node of an FP-tree: an item, its weight on this path, the node above, the nodes below by item."""
    __slots__ = ("item", "up", "below", "weight")

    def __init__(self, item: int, up: Node | None):
        self.item, self.up, self.weight, self.below = item, up, 0, {}


class FPTree:
    """Baskets as paths from the root; equal beginnings share nodes."""

    def __init__(self, rows: list[tuple], least: int):
        """``rows``: ascending items and a weight. Items that weigh less than ``least`` in all are left out."""
        total: dict[int, int] = {}
        for items, w in rows:
            for i in items:
                total[i] = total.get(i, 0) + w
        self.total = {i: w for i, w in total.items() if w >= least}
        self.nodes: dict[int, list[Node]] = {i: [] for i in self.total}
        root = Node(-1, None)
        for items, w in rows:
            at = root
            for i in items:
                if i in self.total:
                    below = at.below.get(i)
                    if below is None:
                        below = at.below[i] = Node(i, at)
                        self.nodes[i].append(below)
                    below.weight += w
                    at = below

    def paths(self, item: int) -> list[tuple]:
        """What stands in front of an item: the rows of its conditional tree."""
        out = []
        for n in self.nodes[item]:
            path, up = [], n.up
            while up.item >= 0:
                path.append(up.item)
                up = up.up
            if path:
                out.append((path[::-1], n.weight))
        return out


def grow(rows: list[tuple], least: int, longest: int | None, suffix: tuple = ()) -> Iterator[tuple[tuple, int]]:
    """Sets of one to ``longest`` items that weigh ``least`` or more, each with ``suffix`` behind it."""
    tree = FPTree(rows, least)
    for i, w in tree.total.items():
        found = (i, *suffix)
        yield found, w
        if longest is None or longest > 1:
            yield from grow(tree.paths(i), least, None if longest is None else longest - 1, found)


def mine(baskets: DataFrame, least: int, longest: int | None = None, rows: int = ROWS) -> DataFrame:
    """``(items, freq)`` of every set of at most ``longest`` items (any number when None) in ``least`` baskets or more.
    ``baskets``: a column ``items``, ascending arrays of distinct ints. Empty or null baskets hold nothing."""
    spark = baskets.sparkSession
    ship_package(spark)
    nothing = spark.createDataFrame([], "items array<int>, freq long")
    if longest is not None and longest < 1:
        return nothing
    large = stored(baskets.where(F.size("items") > 0).groupBy("items").agg(F.count("*").alias("w"))
                   .select(F.array().cast("array<int>").alias("suffix"), "items", "w"), "baskets")
    found, depth = [], 0

    def local(left: int | None):
        def run(t: pa.Table) -> pa.Table:
            suffix = tuple(t.column("suffix")[0].as_py())
            sets, freq = [], []
            for s, w in grow(list(zip(t.column("items").to_pylist(), t.column("w").to_pylist())), least, left, suffix):
                sets.append(s)
                freq.append(w)
            return pa.table({"items": pa.array(sets, pa.list_(pa.int32())), "freq": pa.array(freq, pa.int64())})
        return run

    while True:
        each = large.select("suffix", "items", "w", F.posexplode("items").alias("at", "item"))
        frequent = stored(each.groupBy("suffix", "item").agg(F.sum("w").alias("freq")).where(F.col("freq") >= least), "sets")
        found.append(frequent.select(F.concat(F.array("item"), "suffix").alias("items"), "freq"))
        depth += 1
        if longest is not None and depth >= longest:
            break
        # the databases of the sets that are one item longer
        next_ = (each.where("at > 0").join(frequent.select("suffix", "item"), ["suffix", "item"], "left_semi")
                 .select(F.concat(F.array("item"), "suffix").alias("suffix"), F.slice("items", F.lit(1), F.col("at")).alias("items"), "w")
                 .groupBy("suffix", "items").agg(F.sum("w").alias("w")))
        next_ = stored(next_, "conditional")
        over = stored(next_.groupBy("suffix").agg(F.count("*").alias("n")).where(F.col("n") > rows).select("suffix"), "over")
        small = next_.join(over, "suffix", "left_anti")
        found.append(small.groupBy("suffix").applyInArrow(local(None if longest is None else longest - depth),
                                                          "items array<int>, freq long"))
        if over.isEmpty():
            break
        large = next_.join(over, "suffix", "left_semi")
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out
