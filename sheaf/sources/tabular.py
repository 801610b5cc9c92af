"""CSV, TSV and JSON record files, and the sinks that write them."""

from __future__ import annotations

from functools import reduce
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILE_ORDER = ["file_idx", "file_block", "file_row"]


def scan_csv(spark: SparkSession, paths, schema: str | None = None, multi_line: bool = True, **options) -> DataFrame:
    """CSV with a header. Quoted line breaks need ``multi_line``; without them, switch it off
    so that large files are split over tasks."""
    reader = spark.read.options(header=True, escape='"', multiLine=multi_line, **options)
    return (reader.schema(schema) if schema else reader).csv(paths)


def scan_delimited(spark: SparkSession, paths: list[str], multi_line: bool = True) -> DataFrame:
    """Files in list order: ``.tsv`` files by tab, others by comma; columns widen by name.

    Files that share a header are read by one scan. ``file_idx, file_block, file_row``
    give the harvest order.
    """
    groups: dict[tuple, list[tuple[int, str]]] = {}
    for idx, path in enumerate(paths):
        sep = "\t" if path.rstrip("/").endswith(".tsv") else ","
        header = tuple(scan_csv(spark, path, multi_line=multi_line, sep=sep).columns)
        groups.setdefault((sep, header), []).append((idx, path))

    def read(sep: str, files: list[tuple[int, str]]) -> DataFrame:
        table = scan_csv(spark, [p for _, p in files], multi_line=multi_line, sep=sep)
        where = F.col("_metadata.file_path")
        longest_first = sorted(files, key=lambda f: -len(f[1]))
        index = F.coalesce(*[F.when(F.contains(where, F.lit(quote(p.rstrip("/")))), F.lit(i)) for i, p in longest_first])
        return table.select(
            "*",
            index.cast("bigint").alias("file_idx"),
            F.col("_metadata.file_block_start").alias("file_block"),
            F.monotonically_increasing_id().alias("file_row"),
        )

    return union_widen([read(sep, files) for (sep, _), files in groups.items()])


def union_widen(tables: list[DataFrame]) -> DataFrame:
    """Append tables; columns are the union, absent cells are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def scan_json_array(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """One JSON array of records per file. Without a schema all scalars stay text, so no dates are guessed."""
    reader = spark.read.options(multiLine=True, primitivesAsString=True)
    return (reader.schema(schema) if schema else reader).json(path)


def flat_names(schema: T.StructType, prefix: str = "") -> list[str]:
    names: list[str] = []
    for f in schema.fields:
        name = f"{prefix}{f.name}"
        names += flat_names(f.dataType, f"{name}.") if isinstance(f.dataType, T.StructType) else [name]
    return names


def dotted(df: DataFrame) -> DataFrame:
    """Nested structs become columns with dotted names."""

    def ref(name: str, schema: T.StructType) -> str:
        head, _, tail = name.partition(".")
        return f"`{head}`" + (f".{ref(tail, schema)}" if tail else "")

    return df.select([F.col(ref(n, df.schema)).alias(n) for n in flat_names(df.schema)])


def write_csv(df: DataFrame, path: str) -> None:
    """CSV has no lists: arrays, maps and structs are written as JSON text."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    cells = [
        (F.to_json(F.col(f"`{f.name}`")) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`")).alias(f.name)
        for f in df.schema.fields
    ]
    df.select(cells).write.options(header=True, escape='"', emptyValue='""').csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """One record per line, UTF-8, nulls kept."""
    df.write.options(ignoreNullFields=False).json(path)
