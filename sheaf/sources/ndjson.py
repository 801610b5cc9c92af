"""Mapped records, one JSON document per line, and mapping texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.functions.text import strip


def non_blank(lines: DataFrame, column: str = "value") -> DataFrame:
    return lines.where(F.length(strip(F.col(column))) > 0)


def scan_ndjson(spark: SparkSession, path: str) -> DataFrame:
    """``file_name, value`` of all lines that are not blank."""
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("file_name"), "value")
    return non_blank(lines)


def members(line: Column) -> Column:
    """Top-level members of a JSON object line, in order; a broken line has none."""
    return F.from_json(line, "map<string,variant>")


def scan_mapping_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file_path, file_name, line_no, line`` of mapping texts. A text is one small file, so it is read whole."""
    texts = spark.read.text(path, wholetext=True)
    return texts.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.posexplode(F.split("value", "\r?\n")).alias("line_no", "line"),
    )
