"""Merge of records that share a locator, e.g. language versions of one item."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sheaf.functions.lists import first_of
from sheaf.session import settle


def merged_values(
    df: DataFrame, locator: str, id_column: str, order: list[str], list_columns: list[str], within: tuple[str, ...] = ()
) -> DataFrame:
    """The merged record in long form, one row per value: keys, ``id_column`` (the first id of the locator), ``column``,
    the order columns, ``item`` and ``value``.

    Sorted by order and item, the values of a column are its chained lists. The form is the same for a locator of
    any size: rows stay where they are, and only the first id per locator is aggregated, by partial minima. The first
    ids are written, so the join sees their size and need not deal rows out by locator to learn it.
    """
    keyed = df.withColumn("locator", first_of(F.col(f"`{locator}`")))
    keys = [*within, "locator"]
    first = settle(keyed.groupBy(*keys).agg(F.min_by(id_column, F.struct(*order)).alias("_first")))
    lists = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("values")) for c in list_columns])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    named = first.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_first").alias(id_column))
    # lists are opened after the join, so that where it has to deal rows out they are moved whole
    rows = keyed.select(*keys, *order, lists.alias("_lists")).join(named, same).select(*keys, id_column, *order, F.inline("_lists"))
    return rows.select(*keys, id_column, "column", *order, F.posexplode("values").alias("item", "value"))


def _same(keys: list[str], left: DataFrame, right: DataFrame) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def merge_lists(
    df: DataFrame, locator: str, id_column: str, order: list[str], list_columns: list[str], within: tuple[str, ...] = (), part_items: int = 10_000
) -> DataFrame:
    """Per first locator value (and ``within`` columns, such as the collection): the first id, and every list chained in
    row order, in parts of at most ``part_items`` values of each column: ``keys, id_column, part, list columns``.

    A locator of a usual size is part 0 alone; a large one has as many parts as it needs, and its rows lie in as many
    tasks. Where a row's values go is known from two levels of sums: rows are cut into ranges by key and order and
    written so; counts add up over the ranges of a locator, and over the rows within a range. Rows that tie come in the
    order of their lists. A locator without any value has one part with empty lists.
    """
    keys, lists = [*within, "locator"], list(dict.fromkeys(list_columns))
    named = df.withColumn("locator", first_of(F.col(f"`{locator}`"))).withColumn("_id", F.col(f"`{id_column}`"))
    numbered = {c: f"_list{i}" for i, c in enumerate(lists)}
    held = named.select(*keys, "_id", F.struct(*order).alias("_at"), *[F.col(f"`{c}`").alias(n) for c, n in numbered.items()])
    sort = [*keys, "_at", *numbered.values()]
    ranged = settle(held.repartitionByRange(*sort).withColumn("_range", F.spark_partition_id()))
    sizes = {n: F.greatest(F.size(n), F.lit(0)).cast("bigint") for n in numbered.values()}

    every_size = reduce(lambda a, b: a + b, sizes.values(), F.lit(0).cast("bigint"))
    firsts = settle(ranged.groupBy(*keys).agg(F.min_by("_id", F.struct("_at", "_id")).alias(id_column), F.sum(every_size).alias("_values")))
    totals = ranged.groupBy(*keys, "_range").agg(*[F.sum(x).alias(f"_sum{n}") for n, x in sizes.items()])
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = [F.coalesce(F.sum(f"_sum{n}").over(earlier), F.lit(0)).alias(f"_base{n}") for n in sizes]
    ranges = settle(totals.select(*keys, "_range", *bases))
    inside = Window.partitionBy(*keys, "_range").orderBy("_at", *numbered.values()).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.select("*", *[F.coalesce(F.sum(x).over(inside), F.lit(0)).alias(f"_before{n}") for n, x in sizes.items()])
    based = placed.join(ranges, _same(keys, placed, ranges) & (placed["_range"] == ranges["_range"]))

    def entries(n: str) -> Column:
        start = F.col(f"_base{n}") + F.col(f"_before{n}")
        return F.transform(F.col(n), lambda v, i: F.struct(F.lit(n).alias("column"), (start + i).alias("place"), v.cast("string").alias("value")))

    every = F.flatten(F.array_compact(F.array(*[entries(n) for n in sizes])))
    items = based.select(*[placed[k] for k in keys], F.explode(every).alias("_item")).select(*keys, "_item.*")
    part = F.floor(F.col("place") / part_items).cast("bigint")
    # at most part_items values of each column in a group
    mine = lambda n: F.when(F.col("column") == n, F.struct("place", "value"))
    parts = items.groupBy(*keys, part.alias("part")).agg(*[F.array_sort(F.collect_list(mine(n))).alias(n) for n in sizes])
    shapes = {n: T.ArrayType(held.schema[n].dataType.elementType) for n in sizes}
    values = [F.transform(n, lambda x: x["value"]).cast(shapes[n]).alias(c) for c, n in numbered.items()]
    shown = [*[firsts[k] for k in keys], firsts[id_column]]
    # parts are the streamed side of an inner join, which Spark can split where a locator has many; a locator without a
    # value has no part there and gets its own
    filled = parts.join(firsts, _same(keys, parts, firsts)).select(*shown, "part", *values)
    bare = [F.array().cast(shapes[n]).alias(c) for c, n in numbered.items()]
    return filled.union(firsts.where("_values = 0").select(*shown, F.lit(0).cast("bigint").alias("part"), *bare))
