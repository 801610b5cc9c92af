"""De-duplication in harvest order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def first_per_key(df: DataFrame, keys: list[str | Column], order: list[str | Column]) -> DataFrame:
    """Keep the first row per key; null keys count as equal.

    Spark turns the rank test into a group limit that runs before the shuffle as well, so
    each task sends at most one row per key and a hot key stays small.
    """
    # text keys by their digest: tasks sort and compare 32 bytes, however long a text is
    kinds = df.select(*keys).dtypes
    short = [F.unhex(F.sha2(_column(k), 256)) if kind == "string" else _column(k) for k, (_, kind) in zip(keys, kinds)]
    rank = F.row_number().over(Window.partitionBy(*short).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def _column(key: str | Column) -> Column:
    return F.col(key) if isinstance(key, str) else key
