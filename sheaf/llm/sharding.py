"""Shards of near equal size: indivisible groups, best fit decreasing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import col, numbered
from sheaf.session import settle


class CapacityTree:
    """A height-balanced search tree of (room, bin), for the bin of least sufficient room."""

    __slots__ = ("root",)

    def __init__(self) -> None:
        self.root = None  # node: [key, left, right, height]

    @staticmethod
    def _height(node) -> int:
        return node[3] if node else 0

    def _fixed(self, node):
        node[3] = 1 + max(self._height(node[1]), self._height(node[2]))
        for high, low in ((1, 2), (2, 1)):
            if self._height(node[high]) > self._height(node[low]) + 1:
                if self._height(node[high][low]) > self._height(node[high][high]):
                    node[high] = self._turned(node[high], low, high)
                return self._turned(node, high, low)
        return node

    def _turned(self, node, high: int, low: int):
        top = node[high]
        node[high], top[low] = top[low], node
        for x in (node, top):
            x[3] = 1 + max(self._height(x[1]), self._height(x[2]))
        return top

    def add(self, key: tuple[int, int]) -> None:
        def into(node):
            if node is None:
                return [key, None, None, 1]
            side = 1 if key < node[0] else 2
            node[side] = into(node[side])
            return self._fixed(node)

        self.root = into(self.root)

    def remove(self, key: tuple[int, int]) -> None:
        def out_of(node, key):
            if key == node[0]:
                if node[1] is None or node[2] is None:
                    return node[1] or node[2]
                least = node[2]
                while least[1]:
                    least = least[1]
                node[0] = least[0]
                node[2] = out_of(node[2], least[0])
            else:
                side = 1 if key < node[0] else 2
                node[side] = out_of(node[side], key)
            return self._fixed(node)

        self.root = out_of(self.root, key)

    def tightest(self, size: int) -> tuple[int, int] | None:
        node, best = self.root, None
        while node:
            if node[0][0] >= size:
                best, node = node[0], node[1]
            else:
                node = node[2]
        return best


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """The bin of every item. An item above the capacity gets a bin of its own."""
    tree, bins, placed = CapacityTree(), 0, [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = tree.tightest(sizes[i])
        if found:
            tree.remove(found)
        else:
            found, bins = (max(capacity, sizes[i]), bins), bins + 1
        placed[i] = found[1]
        tree.add((found[0] - sizes[i], found[1]))
    return placed


def fit_into(sizes: list[int], shards: int) -> list[int]:
    """Best fit decreasing at the least capacity, found by halving, that needs no more than ``shards`` bins."""
    if not sizes:
        return []
    low = max(-(-sum(sizes) // shards), max(sizes))
    high = 2 * low  # always enough: any two bins together hold more than a capacity
    best = best_fit_decreasing(sizes, high)
    while high - low > high // 1_000_000:
        middle = (low + high) // 2
        placed = best_fit_decreasing(sizes, middle)
        if max(placed) < shards:
            best, high = placed, middle
        else:
            low = middle + 1
    return best


def shard_groups(docs: DataFrame, group: Column, size: Column, order: list[str], shards: int = 8, bundles: int = 4096) -> DataFrame:
    """Adds ``size``, ``shard`` and ``slot``; rows of equal ``group`` stay together and the shards' sizes are near equal.

    Groups of at least 1/``bundles`` of all bytes, of which there are at most ``bundles``, are items of their own.
    The others are joined by a hash of their key into ``bundles`` items, so what best fit decreasing sees on the
    driver is at most ``2 * bundles`` numbers at any input size, and a shard is off by about the smallest items.
    A group above an even share makes its shard that much larger, as groups are indivisible.
    Slots count 0, 1, 2, … in each shard. Null groups are one group. An empty table gives an empty result.
    Columns named ``size``, ``shard`` or ``slot`` are replaced, and those with a leading underscore are left out.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    rows = docs.withColumns({"size": size.cast("long"), "_group": group})
    rows = rows.drop("shard", "slot", *[c for c in docs.columns if c.startswith("_") and c not in (*order, "_group")])
    groups = settle(rows.groupBy("_group").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")))
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    alone = F.col("bytes") * bundles >= total
    spark = docs.sparkSession
    kind = groups.select("_group", F.lit(0).alias("_alone")).schema
    found = groups.where(alone & (F.lit(total) > 0)).select("_group").collect()  # at most `bundles` groups
    large = spark.createDataFrame([(r[0], bundles + i) for i, r in enumerate(found)], kind)
    bundle = F.pmod(F.xxhash64("_group"), F.lit(bundles)).cast("int")
    same = F.col("_group").eqNullSafe(F.col("_big"))
    big = large.withColumnRenamed("_group", "_big")
    item = F.coalesce("_alone", bundle)
    items = groups.join(F.broadcast(big), same, "left").withColumn("_item", item).groupBy("_item").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
    found = items.orderBy("_item").collect()  # at most 2 * bundles rows
    placed = fit_into([r["bytes"] for r in found], shards)
    schema = "_item int, shard int, n long"
    plan = spark.createDataFrame([(r["_item"], s, r["n"]) for r, s in zip(found, placed)], schema)
    joined = rows.join(F.broadcast(big), same, "left").withColumn("_item", item).drop("_big", "_alone")
    placed_rows = joined.join(F.broadcast(plan.drop("n")), "_item")
    return numbered(placed_rows, "shard", "_item", plan, [col(c) for c in order], "slot").drop("_item", "_group")

