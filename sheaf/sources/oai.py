"""OAI-PMH list pages: records, headers, and flattened metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions import xmlpath, xmltree
from sheaf.functions.lists import merge_pairs, override, strip_all
from sheaf.sources.payloads import ok_pages, xml_fields
from sheaf.spec import CollectionSpec

# The root element of the metadata per prefix.
METADATA_ROOTS = {
    "oai_dc": "dc",
    "mods": "mods",
    "mods_no_ocr": "mods",
    "marc21": "record",
    "oai_marc21": "record",
    "oai_dpla": "dpla",
}

# A record ends where one of its parts does, so a MARC ``record`` inside it does not end it.
RECORD = (
    r"(?s)<(?:\w+:)?record(?:\s[^>]*)?>\s*<(?:\w+:)?header\b.*?"
    r"(?:</(?:\w+:)?(?:header|metadata|about)\s*>|<(?:\w+:)?header[^>]*/>)\s*</(?:\w+:)?record\s*>"
)


def oai_headers(payloads: DataFrame) -> DataFrame:
    """All listed records with their header: ``identifier, datestamp, deleted, record``."""
    pages = ok_pages(payloads).select(
        "harvest_id", "seq", "url", F.posexplode(F.regexp_extract_all(xmlpath.plain_markup(F.col("body")), F.lit(RECORD), F.lit(0))).alias("pos", "record")
    )
    head = F.regexp_extract("record", r"(?s)(<(?:\w+:)?header\b.*?(?:/>|</(?:\w+:)?header\s*>))", 1)

    def part(name: str) -> Column:
        return F.trim(F.regexp_extract(head, rf"(?s)<(?:\w+:)?{name}\s*>(.*?)</", 1))

    return pages.select(
        "harvest_id",
        "seq",
        F.col("pos").cast("bigint").alias("pos"),
        "url",
        part("identifier").alias("identifier"),
        part("datestamp").alias("datestamp"),
        head.rlike(r"""^<[^>]*\sstatus\s*=\s*["']deleted["']""").alias("deleted"),
        "record",
    )


def live_records(payloads: DataFrame) -> DataFrame:
    return oai_headers(payloads).where(~F.col("deleted")).drop("deleted")


def get_record(payloads: DataFrame, identifier: str) -> DataFrame:
    return live_records(payloads).where(F.col("identifier") == F.lit(identifier))


def metadata_part(record: Column) -> Column:
    return F.regexp_extract(record, r"(?s)<((?:\w+:)?metadata)\b[^>]*>(.*)</\1\s*>", 2)


def oai_records(payloads: DataFrame, spec: CollectionSpec, all_leaves: bool = False) -> DataFrame:
    """Live records as fields: declared paths, then flattened metadata, which wins.

    With no live record the result is empty and has the same columns.
    """
    if spec.metadata_prefix not in METADATA_ROOTS:
        raise ValueError(f"unknown metadata prefix {spec.metadata_prefix}")
    root = METADATA_ROOTS[spec.metadata_prefix]
    records = live_records(payloads).where(xmlpath.well_formed(F.col("record")))
    body = F.regexp_replace(metadata_part(F.col("record")), r"(?s)<\?.*?\?>", "")
    flat = records.withColumn("pairs", xmltree.leaf_pairs(body, root, marc=root == "record", all_leaves=all_leaves))
    declared = xml_fields(F.col("record"), spec, strip_all)
    return flat.select(
        "harvest_id",
        "seq",
        "pos",
        "identifier",
        "datestamp",
        override(declared, merge_pairs(F.col("pairs"))).alias("fields"),
    )
