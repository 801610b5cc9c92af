"""One harvest from landed payloads to a checked table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.operators.dedupe import first_per_key
from sheaf.operators.filters import apply_filters
from sheaf.operators.hooks import run_hook
from sheaf.operators.paging import limit_by_page
from sheaf.operators.records import scalar_id, wide
from sheaf.operators.serials import ISSUE_TAG
from sheaf.sources.marc import split_issues
from sheaf.sources.registry import read_records, read_table
from sheaf.spec import CollectionSpec

ORDER = ("seq", "pos")
KEYS = ("harvest_id", "seq", "pos")


def harvest_table(
    payloads: DataFrame,
    spec: CollectionSpec,
    columns: list[str],
    hook_arguments: Mapping[str, Any] | None = None,
    listings: DataFrame | None = None,
    index: DataFrame | None = None,
) -> DataFrame:
    """Records as list columns: read, cut to the record limit, first per id in harvest order,
    filtered, and passed through the spec's own step. Serials are split from the whole record,
    as the folded fields hold one issue only."""
    serials = spec.post_harvest == "split_marc_serials" and spec.driver == "hathi_trust"
    records = read_records(payloads, spec, listings, index, raw=serials)
    if spec.record_limit:
        records = limit_by_page(records, spec.record_limit)
    keys = [c for c in KEYS if c in records.columns]
    table = wide(records, columns, [*keys, "record"] if serials else keys, lists=True)
    if serials:
        issues = split_issues(finish(table, spec).select(*keys, "record"), ISSUE_TAG)
        return scalar_id(wide(issues, columns, [*keys, "issue_no"], lists=True), spec.id_column)
    return run_hook(finish(table, spec), spec, hook_arguments)


def harvest_many(
    payloads: DataFrame, specs: Sequence[CollectionSpec], columns: list[str], listings: DataFrame | None = None
) -> DataFrame:
    """Many collections in one plan: ``collection_id``, the declared id as ``record_id`` and the list columns.

    ``payloads`` is partitioned by ``collection_id``; the predicate of a spec reaches the scan, so each reads its
    own partition and all run in one job.
    """

    def one(spec: CollectionSpec) -> DataFrame:
        own = lambda df: df.where(F.col("collection_id") == spec.collection_id).drop("collection_id") if df is not None else None
        wanted = list(dict.fromkeys([spec.id_column, *columns]))
        table = harvest_table(own(payloads), spec, wanted, listings=own(listings) if listings is not None else None)
        record_id = F.col(f"`{spec.id_column}`").cast("string").alias("record_id")
        shown = [F.col(f"`{c}`") if c != spec.id_column else F.array(F.col(f"`{c}`")).alias(c) for c in columns]
        return table.select(F.lit(spec.collection_id).alias("collection_id"), record_id, *shown)

    return reduce(DataFrame.unionByName, [one(s) for s in specs])


def harvest_files(spark: SparkSession, spec: CollectionSpec) -> DataFrame:
    """The same for the table files of a CSV spec."""
    table = read_table(spark, spec)
    if spec.record_limit:
        table = limit_by_page(table.withColumn("harvest_id", F.lit(spec.collection_id)), spec.record_limit)
    return finish(table, spec)


def finish(table: DataFrame, spec: CollectionSpec) -> DataFrame:
    """First record per harvest and id, then the filters. They come after de-duplication on
    purpose: the first record of an id decides."""
    table = scalar_id(table, spec.id_column)
    keys = [F.col("harvest_id")] if "harvest_id" in table.columns else []
    first = first_per_key(table, [*keys, F.col(f"`{spec.id_column}`")], [c for c in ORDER if c in table.columns])
    return apply_filters(first, spec.filters)
