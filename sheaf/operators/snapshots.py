"""Change detection, archive decisions and snapshot writes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sheaf.session import settle


def row_hash(df: DataFrame, columns: list[str]) -> Column:
    """60 bits of the SHA-256 of the row's text; null and empty text differ."""
    cells = [F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("!")) for c in columns]
    return F.conv(F.substring(F.sha2(F.concat_ws("\x1f", *cells), 256), 1, 15), 16, 10).cast("decimal(38,0)")


def digests(df: DataFrame, group: list[str], columns: list[str]) -> DataFrame:
    """``group, n, digest`` of the rows as a multiset, one pass with partial sums.

    Put the order columns among ``columns`` when order matters.
    """
    return df.groupBy(*group).agg(F.count("*").alias("n"), F.sum(row_hash(df, columns)).cast("string").alias("digest"))


def _changed_ranges(current: DataFrame, previous: DataFrame, ranges: list[str], columns: list[str]) -> DataFrame:
    """Ranges whose rows are not the same multiset in both tables, by one digest per range and table."""
    left = digests(current, ranges, columns)
    right = digests(previous, ranges, columns).toDF(*[f"_{r}" for r in ranges], "_n", "_digest")
    together = reduce(lambda x, y: x & y, [F.col(r).eqNullSafe(F.col(f"_{r}")) for r in ranges])
    same = (F.col("n") == F.col("_n")) & (F.col("digest") == F.col("_digest"))
    joined = left.join(right, together, "full").where(~F.coalesce(same, F.lit(False)))
    return joined.select(*[F.when(F.col("n").isNotNull(), F.col(r)).otherwise(F.col(f"_{r}")).alias(r) for r in ranges])


def differing_rows(current: DataFrame, previous: DataFrame, group: list[str] | None = None, key: list[str] | None = None, buckets: int = 256) -> DataFrame:
    """Rows one table holds more often than the other, with that side and the number of extra copies.

    Both tables are first digested by range, that is by ``group`` (such as the collection) and ``buckets`` parts of a
    hash of ``key`` (all columns, if none is named); only a row of counts per range moves. Ranges with the same
    digest are the same, so the signed count of whole rows shuffles rows of changed ranges alone. Empty when the
    tables are equal. Add the order columns when order matters.
    """
    columns = current.columns
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in key or columns]), F.lit(buckets)).cast("int")
    cut = [df.select(*[F.col(f"`{c}`") for c in columns]).withColumn("_part", part) for df in (current, previous)]
    ranges = [*(group or []), "_part"]
    changed = settle(_changed_ranges(*cut, ranges, columns))

    def within(df: DataFrame, sign: int) -> DataFrame:
        here = reduce(lambda x, y: x & y, [df[r].eqNullSafe(changed[r]) for r in ranges])
        return df.join(changed, here, "left_semi").drop("_part").withColumn("_sign", F.lit(sign))

    net = within(cut[0], 1).unionByName(within(cut[1], -1)).groupBy(*columns).agg(F.sum("_sign").alias("_net")).where(F.col("_net") != 0)
    side = F.when(F.col("_net") > 0, F.lit("current")).otherwise(F.lit("previous"))
    return net.select(*columns, side.alias("side"), F.abs("_net").alias("copies"))


def decide_load(current: DataFrame, previous: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``key, n, decision``: ``skip`` an unchanged collection, ``load`` any other, ``gone`` for one that has no rows now."""
    now = digests(current, [key], columns)
    before = digests(previous, [key], columns).select(F.col(key), F.col("n").alias("_n"), F.col("digest").alias("_digest"))
    same = (F.col("n") == F.col("_n")) & (F.col("digest") == F.col("_digest"))
    decision = F.when(F.coalesce(same, F.lit(False)), F.lit("skip")).when(F.col("n").isNull(), F.lit("gone")).otherwise(F.lit("load"))
    return now.join(before, key, "full").select(key, F.coalesce("n", F.lit(0).cast("bigint")).alias("n"), decision.alias("decision"))


def changed_only(current: DataFrame, decisions: DataFrame, key: str) -> DataFrame:
    """Records of the collections to load."""
    return current.join(settle(decisions.where(F.col("decision") == "load").select(key)), key, "left_semi")


def archive_decisions(snapshots: DataFrame, key: list[str], ts: str = "snapshot_ts") -> DataFrame:
    """Per snapshot ``archive``, ``empty`` or ``unchanged``; it is compared with the last one that had data.

    ``snapshots`` holds one small row per snapshot: ``key, ts, n, digest``.
    """
    earlier = Window.partitionBy(*key).orderBy(ts).rowsBetween(Window.unboundedPreceding, -1)
    previous = F.last(F.when(F.col("n") > 0, F.col("digest")), ignorenulls=True).over(earlier)
    verdict = F.when(F.col("n") == 0, F.lit("empty")).when(
        F.col("digest") == previous, F.lit("unchanged")
    ).otherwise(F.lit("archive"))
    return snapshots.withColumn("decision", verdict)


def newest(snapshots: DataFrame, key: list[str], ts: str = "snapshot_ts") -> DataFrame:
    """Time stamp of the newest snapshot per key."""
    return snapshots.groupBy(*key).agg(F.max(ts).alias(ts))


def archive(records: DataFrame, decisions: DataFrame, key: list[str], path: str, ts: str = "snapshot_ts") -> None:
    """Add the snapshots to keep: rows in a folder per key and stamp, then one row per snapshot that says it is whole.

    A snapshot counts once that row is there (``archived``), so a write that fails leaves nothing to be seen, and
    the same write run again replaces its folders. A large snapshot is written by several tasks.
    """
    keep = settle(decisions.where(F.col("decision") == "archive").select(*key, ts))
    rows = records.join(keep, [*key, ts], "left_semi").hint("rebalance", *key, ts)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*key, ts).parquet(f"{path}/rows")
    keep.write.mode("append").parquet(f"{path}/whole")


def archived(spark: SparkSession, path: str, key: list[str], ts: str = "snapshot_ts") -> DataFrame:
    """Rows of all whole snapshots of an archive."""
    whole = spark.read.parquet(f"{path}/whole").distinct()
    # folder names are text; they are read as what the rows had
    kinds = {f.name: f.dataType for f in spark.read.parquet(f"{path}/rows").schema} | {f.name: f.dataType for f in whole.schema}
    declared = ", ".join(f"`{name}` {kind.simpleString()}" for name, kind in kinds.items())
    return spark.read.schema(declared).parquet(f"{path}/rows").join(whole, [*key, ts], "left_semi")
