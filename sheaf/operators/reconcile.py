"""Counts of harvested against mapped records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def record_counts(df: DataFrame, key: str = "collection_id") -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n"))


def expected_count(n: Column, formula: Column) -> Column:
    """Harvested count after a formula such as ``/2`` or ``+3``.

    Division is true division and by zero gives 0; no formula leaves the count; any other
    text is an error.
    """
    sign = F.regexp_extract(formula, r"^\s*([-+*/])\s*(\d+)\s*$", 1)
    operand = F.regexp_extract(formula, r"^\s*([-+*/])\s*(\d+)\s*$", 2).try_cast("double")
    count = n.cast("double")
    return (
        F.when(formula.isNull() | (formula == ""), count)
        .when(sign == "+", count + operand)
        .when(sign == "-", count - operand)
        .when(sign == "*", count * operand)
        .when(sign == "/", F.coalesce(F.try_divide(count, operand), F.lit(0.0)))
        .otherwise(F.raise_error(F.concat(F.lit("unsupported count formula: "), formula)).cast("double"))
    )


def reconcile(harvested: DataFrame, mapped: DataFrame, formulas: DataFrame, key: str = "collection_id", strict: bool = False) -> DataFrame:
    """``key, harvested, expected, mapped, status`` of every collection on either side."""
    left = record_counts(harvested, key).withColumnRenamed("n", "harvested")
    right = record_counts(mapped, key).withColumnRenamed("n", "mapped")
    joined = left.join(right, key, "full_outer").join(formulas, key, "left")
    zero = F.lit(0).cast("bigint")
    out = joined.select(
        key, F.coalesce("harvested", zero).alias("harvested"), F.coalesce("mapped", zero).alias("mapped"), "formula"
    ).withColumn("expected", expected_count(F.col("harvested"), F.col("formula")))
    same = F.col("expected") == F.col("mapped")
    bad = F.raise_error(F.concat(F.lit("counts differ for "), F.col(key).cast("string"))).cast("string") if strict else F.lit("failed")
    return out.withColumn("status", F.when(same, F.lit("ok")).otherwise(bad)).drop("formula")


def require_rows(df: DataFrame) -> DataFrame:
    """Fail at run time on an empty table."""
    if df.isEmpty():
        raise ValueError("no records")
    return df
