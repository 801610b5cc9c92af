"""Include and exclude lists. They run after de-duplication, in spec order."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheaf.spec import FieldFilter


def filter_field(df: DataFrame, column: str, rule: FieldFilter) -> DataFrame:
    """Keep included values, drop excluded ones.

    Plain column: null is never included and never excluded. List column: a row is included
    when it shares a value, and excluded only when it holds all excluded values.
    """
    c = F.col(f"`{column}`")
    is_list = isinstance(df.schema[column].dataType, T.ArrayType)
    if rule.include:
        values = list(rule.include)
        df = df.where(F.arrays_overlap(c, F.array(*map(F.lit, values))) if is_list else c.isin(values))
    if rule.exclude:
        values = list(rule.exclude)
        if is_list:
            held = F.coalesce(c, F.array().cast("array<string>"))
            df = df.where(F.size(F.array_except(F.array(*map(F.lit, values)), held)) > 0)
        else:
            df = df.where(~F.coalesce(c.isin(values), F.lit(False)))
    return df


def apply_filters(df: DataFrame, filters: Mapping[str, FieldFilter]) -> DataFrame:
    for column, rule in filters.items():
        df = filter_field(df, column, rule)
    return df
