"""Helpers of the corpus operators: named scratch columns, clean vectors, gapless numbers, linked groups."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sheaf.session import settle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def col(name: str) -> Column:
    """A column by its exact name, also with dots or blanks in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null or empty, all components finite, not all zero."""
    broken = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & ~broken & F.exists(vector, lambda x: x != 0), F.lit(False))


def numbered(df: DataFrame, group: str, item: str, sizes: DataFrame, order: list[Column], name: str, per_task: int = 256) -> DataFrame:
    """Numbers 0, 1, 2, … within each ``group``, without bringing a group or an item into one task.

    ``sizes(item, group, n)`` says how many rows each item of a group has; it is small. An item of more than
    ``per_task`` rows is cut by a hash of ``order``; the rows of a cut are ranked, and cuts and items are added up
    from their counts. Items are ordered by their key.
    """
    earlier = F.coalesce(F.sum("n").over(Window.partitionBy(group).orderBy(item).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = settle(sizes.select(col(item), F.ceil(F.col("n") / per_task).cast("int").alias("_cuts"), earlier.alias("_start")))
    cut = F.pmod(F.xxhash64(*order), F.greatest(F.col("_cuts"), F.lit(1))).cast("int")
    marked = df.join(starts, item).withColumn("_cut", cut)
    counts = marked.groupBy(item, "_cut").agg(F.count("*").alias("_n"))
    ends = Window.partitionBy(item).orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    cuts = settle(counts.select(item, "_cut", F.coalesce(F.sum("_n").over(ends), F.lit(0)).alias("_before")))
    rank = F.row_number().over(Window.partitionBy(item, "_cut").orderBy(*order)) - 1
    ranked = marked.withColumn("_rank", rank).join(cuts, [item, "_cut"])
    return ranked.withColumn(name, F.col("_start") + F.col("_before") + F.col("_rank")).drop("_cuts", "_start", "_cut", "_rank", "_before")


def forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The links of one partition, thinned to a star per locally linked group."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    for links in batches:
        for a, b in zip(links["a"].tolist(), links["b"].tolist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    stars = [(x, root(x)) for x in parent if root(x) != x]
    yield pd.DataFrame(stars, columns=["a", "b"]).astype("int64")


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``: the smallest node it is linked with, directly or not.

    Each round hooks every node to the neighbour of least hash and contracts the links, so the number of
    rounds is logarithmic whatever the shape; groups are never gathered, only minima are. Rounds are cut by
    tables in the shared folder.
    """
    links = settle(links.select("a", "b").where("a <> b").mapInPandas(forest, "a long, b long").distinct())
    found = None
    while not links.isEmpty():
        ways = links.union(links.select("b", "a"))
        rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("id"))
        least = ways.groupBy("a").agg(F.min(rank("b")).alias("to"))
        hook = settle(least.select(F.col("a").alias("node"), F.least(F.col("to"), rank("a"))["id"].alias("up")))
        if found is None:
            found = hook
        else:
            step = hook.select(F.col("node").alias("up"), F.col("up").alias("_next"))
            found = settle(found.join(step, "up", "left").select("node", F.coalesce("_next", "up").alias("up")))
        left = hook.select(F.col("node").alias("a"), F.col("up").alias("_a"))
        right = hook.select(F.col("node").alias("b"), F.col("up").alias("_b"))
        moved = links.join(left, "a").join(right, "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
        links = settle(moved.where("a <> b").mapInPandas(forest, "a long, b long").distinct())
    if found is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    least = settle(found.groupBy("up").agg(F.min("node").alias("component")))
    return found.join(least, "up").select("node", "component")
