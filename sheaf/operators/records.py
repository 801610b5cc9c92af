"""Record form: one row per record with its fields in a map; wide tables only at the output."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheaf.functions.lists import first_of, scalar_or_list
from sheaf.spec import CollectionSpec


def wide(records: DataFrame, columns: list[str], keys: list[str], lists: bool = False) -> DataFrame:
    """Named fields as columns: lists, or the scalar-or-list view."""
    def cell(name: str) -> Column:
        values = F.try_element_at(F.col("fields"), F.lit(name))
        return (values if lists else scalar_or_list(values)).alias(name)

    return records.select(*keys, *[cell(c) for c in columns])


def long(records: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, field, vpos, value``: one row per value."""
    entries = records.select(*keys, F.explode("fields").alias("field", "values"))
    return entries.select(*keys, "field", F.posexplode("values").alias("vpos", "value"))


def scalar_id(df: DataFrame, column: str) -> DataFrame:
    """A list-valued id becomes its first element."""
    if isinstance(df.schema[column].dataType, T.ArrayType):
        return df.withColumn(column, first_of(F.col(f"`{column}`")))
    return df


def missing_fields(records: DataFrame, spec: CollectionSpec, keys: list[str]) -> DataFrame:
    """Audit ``keys, field, path, required`` of declared fields a record lacks."""
    declared = F.array(
        *[
            F.struct(F.lit(n).alias("field"), F.lit(i.path).alias("path"), F.lit(not i.optional).alias("required"))
            for n, i in spec.fields.items()
        ]
    )
    absent = F.filter(declared, lambda d: ~F.map_contains_key(F.col("fields"), d["field"]))
    return records.select(*keys, F.inline(absent))


def with_fields(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Pack columns into a ``fields`` map; empty values are left out."""
    cells = F.create_map(*[x for name, values in columns.items() for x in (F.lit(name), values)])
    return df.withColumn("fields", F.map_filter(cells, lambda _, v: F.coalesce(F.size(v) > 0, F.lit(False))))
