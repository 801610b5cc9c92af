"""Which fields occur where, and how they compare with a mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def field_inventory(records: DataFrame, group: str) -> DataFrame:
    """``group, field, n``: records of a file or collection that hold the field, partial sums first."""
    names = records.select(group, F.explode(F.map_keys("fields")).alias("field"))
    return names.groupBy(group, "field").agg(F.count("*").alias("n"))


def distinct_fields(inventory: DataFrame) -> DataFrame:
    return inventory.select("field").distinct().orderBy("field")


def holding(inventory: DataFrame, group: str, field: str) -> DataFrame:
    """Files or collections that hold a field."""
    return inventory.where(F.col("field") == field).select(group).distinct()


def unmapped(harvested: DataFrame, mapped: DataFrame, ignored: DataFrame | None = None) -> DataFrame:
    """Harvested fields that are neither mapped nor set aside on purpose."""
    out = harvested.select("field").distinct().join(mapped.select("field").distinct(), "field", "left_anti")
    return out.join(ignored.select("field").distinct(), "field", "left_anti") if ignored is not None else out


def imaginary(harvested: DataFrame, mapped: DataFrame) -> DataFrame:
    """Mapped fields that no record holds."""
    return mapped.select("field").distinct().join(harvested.select("field").distinct(), "field", "left_anti")


def values_by_group(df: DataFrame, group: str, value: str) -> DataFrame:
    """Distinct values per group, one row each, with their count."""
    return df.groupBy(group, value).agg(F.count("*").alias("n"))
