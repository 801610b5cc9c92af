"""Readers by the driver name a spec uses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.sources import json_pages, manifests, marc, oai, tabular, xml_pages
from sheaf.spec import CollectionSpec

Reader = Callable[[DataFrame, CollectionSpec], DataFrame]

READERS: dict[str, Reader] = {
    "custom_json": json_pages.json_records,
    "iiif_json": manifests.manifest_records,
    "oai_xml": oai.oai_records,
    # without a selector every landed page is one record
    "xml": lambda payloads, spec: (xml_pages.xml_records if spec.record_selector else xml_pages.xml_page_records)(payloads, spec),
}


TABLE_DRIVERS = ("csv", "sequential_csv")

# Column types a table spec may declare.
TABLE_TYPES = {"object": "string", "str": "string", "string": "string", "int64": "bigint", "float64": "double"}


def read_table(spark: SparkSession, spec: CollectionSpec) -> DataFrame:
    """The files of a table spec in list order, with ``seq``, file and byte offset of the part a
    task read, and ``pos``, the row in it. Declared columns have their declared types; a value
    that does not fit its type is an error."""
    table = tabular.scan_delimited(spark, list(spec.paths))
    for name, declared in spec.dtypes.items():
        if declared not in TABLE_TYPES:
            raise ValueError(f"unknown column type {declared}")
        if name in table.columns:
            table = table.withColumn(name, F.col(f"`{name}`").cast(TABLE_TYPES[declared]))
    part = F.shiftleft(F.col("file_idx"), 44) + F.col("file_block")
    return table.withColumns({"seq": part, "pos": F.col("file_row")}).drop(*tabular.FILE_ORDER)


def read_records(
    payloads: DataFrame, spec: CollectionSpec, listings: DataFrame | None = None, index: DataFrame | None = None, raw: bool = False
) -> DataFrame:
    """Records of landed payloads by the spec's driver; version 3 manifests need their listings too, and MARC
    collections may have an index of their addresses. ``raw`` keeps the unfolded MARC record beside the fields."""
    if spec.driver == "hathi_trust":
        return marc.marc_records(payloads, index, raw=raw)
    if spec.driver == "iiif_json_v3":
        if listings is None:
            raise ValueError("version 3 manifests are read with their listings")
        return manifests.manifest_records_v3(listings, payloads, spec)
    if spec.driver not in READERS:
        raise ValueError(f"no reader for driver {spec.driver}")
    return READERS[spec.driver](payloads, spec)
