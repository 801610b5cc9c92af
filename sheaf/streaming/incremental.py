"""Harvest of what changed: in batch by date, and as a stream of landed files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.operators.dedupe import first_per_key
from sheaf.operators.records import scalar_id, wide
from sheaf.session import settle
from sheaf.sources.registry import read_records
from sheaf.spec import CollectionSpec


def changed_since(records: DataFrame, datestamp: Column, spec: CollectionSpec, last_start: str | None) -> DataFrame:
    """Records of one collection from the day of the last run on; a full or first harvest keeps all.

    The day is a literal, so the scan can skip files and partitions.
    """
    if spec.full_harvest or last_start is None:
        return records
    return records.where(datestamp >= F.to_date(F.lit(last_start)))


def changed_since_state(records: DataFrame, state: DataFrame, datestamp: str = "datestamp") -> DataFrame:
    """The same for all collections; ``state`` has one row each: ``collection_id, last_start, full_harvest``."""
    every = F.coalesce("full_harvest", F.lit(False)) | F.col("last_start").isNull()
    joined = records.join(settle(state), "collection_id", "left")  # of known size, so no record moves for a small one
    return joined.where(every | (F.col(datestamp) >= F.to_date("last_start"))).drop("last_start", "full_harvest")


def first_within_delay(stream: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """Drop repeats that arrive within ``delay`` of the first, with state bounded by the watermark."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def stream_upsert(
    source: DataFrame, log_path: str, checkpoint: str, key: list[Column | str], order: list[Column | str]
) -> None:
    """Run all files that have landed and stop.

    A micro-batch is reduced to the first record per key and written to its own folder of the
    change log. A repeated batch overwrites that folder, so a retry changes nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        first = first_per_key(batch, key, order)
        first.write.mode("overwrite").parquet(f"{log_path}/batch={batch_id}")

    query = (
        source.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_harvest(
    payloads: DataFrame, spec: CollectionSpec, columns: list[str], log_path: str, checkpoint: str
) -> None:
    """Landed payloads to the change log: read as records and upserted by harvest and id."""
    records = wide(read_records(payloads, spec), columns, ["harvest_id", "seq", "pos"], lists=True)
    table = scalar_id(records, spec.id_column)
    stream_upsert(table, log_path, checkpoint, ["harvest_id", F.col(f"`{spec.id_column}`")], ["seq", "pos"])


def current_records(spark: SparkSession, log_path: str, key: list[Column | str]) -> DataFrame:
    """Newest version per key of the change log."""
    log = spark.read.parquet(log_path)
    return first_per_key(log, key, [F.col("batch").desc()]).drop("batch")
