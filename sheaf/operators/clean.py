"""Cell and row cleaning."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.functions.text import truthy


def falsy_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Empty text, zero, false and empty collections become null."""
    chosen = df.columns if columns is None else columns
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: F.when(truthy(F.col(f"`{c}`"), types[c]), F.col(f"`{c}`")) for c in chosen})


def drop_empty(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop rows in which every one of ``columns`` is null or falsy."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.where(reduce(or_, [truthy(F.col(f"`{c}`"), types[c]) for c in columns]))


def drop_null(df: DataFrame, column: str) -> DataFrame:
    return df.na.drop(subset=[column])
