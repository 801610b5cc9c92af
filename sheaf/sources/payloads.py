"""Landed responses: one row per fetched page, manifest or file.

``harvest_id, seq, url, status, content_type, body``; fetching happens before Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions import jsonpath, xmlpath, xmltree
from sheaf.spec import CollectionSpec

SCHEMA = "harvest_id string, seq bigint, url string, status int, content_type string, body string"
ORDER = ["seq", "pos"]


def ok_pages(payloads: DataFrame) -> DataFrame:
    return payloads.where(F.col("status") == 200)


def failed_pages(payloads: DataFrame) -> DataFrame:
    """Audit of pages that gave nothing."""
    return payloads.where(~(F.col("status") == 200) | F.col("status").isNull()).select(
        "harvest_id", "seq", "url", "status"
    )


def unreadable_json(payloads: DataFrame) -> DataFrame:
    """Audit of pages that answered 200 with something else than JSON."""
    return ok_pages(payloads).where(F.try_parse_json("body").isNull()).select("harvest_id", "seq", "url")


def unreadable_xml(payloads: DataFrame) -> DataFrame:
    """Audit of pages that answered 200 with broken XML, or none."""
    return ok_pages(payloads).where(~xmlpath.well_formed(F.col("body"))).select("harvest_id", "seq", "url")


def json_fields(doc: Column, raw: Column | None, spec: CollectionSpec) -> Column:
    """Declared fields of one parsed body as a map; a field without a match is absent."""
    return jsonpath.find_fields(doc, {name: info.path for name, info in spec.fields.items()}, raw)


def xml_fields(body: Column, spec: CollectionSpec, clean) -> Column:
    """Declared fields of one XML record; ``clean`` maps the found values."""
    found = xmltree.find_fields(body, {name: (info.path, info.namespaces) for name, info in spec.fields.items()})
    return F.transform_values(found, lambda _, values: clean(values))
