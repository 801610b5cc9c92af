"""Records inside XML pages and XML files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.functions import xmlpath
from sheaf.functions.lists import kept
from sheaf.functions.text import markup_to_text, sanitize
from sheaf.sources.payloads import ok_pages, xml_fields
from sheaf.spec import CollectionSpec


def clean_values(values: Column) -> Column:
    """Markup inside a value becomes text, then the text is sanitised."""
    return F.transform(values, lambda v: sanitize(markup_to_text(v)))


def record_elements(pages: DataFrame, selector: str) -> DataFrame:
    """``harvest_id, seq, pos, url, record`` with the source text of every selected element."""
    return pages.select(
        "harvest_id", "seq", "url", F.posexplode(xmlpath.split_elements(F.col("body"), selector)).alias("pos", "record")
    ).withColumn("pos", F.col("pos").cast("bigint"))


def extract(records: DataFrame, spec: CollectionSpec) -> DataFrame:
    good = kept(F.col("record"), xmlpath.well_formed).alias("_record")
    return records.select("harvest_id", "seq", "pos", "url", good).select(
        "harvest_id", "seq", "pos", "url", xml_fields(F.col("_record"), spec, clean_values).alias("fields")
    )


def xml_records(payloads: DataFrame, spec: CollectionSpec) -> DataFrame:
    """Records that the selector picks from pages that answered 200."""
    return extract(record_elements(ok_pages(payloads), spec.record_selector), spec)


def with_address(record: Column, url: Column) -> Column:
    """The record with a last child ``harvest_url`` that holds the page's address."""
    escaped = F.replace(F.replace(url, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    end = F.regexp_extract(record, r"(?s)^.*(</[^<>]+>.*)$", 1)  # from the last closing tag on
    start = F.substring(record, F.lit(1), F.length(record) - F.length(end))
    added = F.concat(start, F.lit("<harvest_url>"), escaped, F.lit("</harvest_url>"), end)
    return F.when(end != "", added).otherwise(record)


def xml_page_records(payloads: DataFrame, spec: CollectionSpec) -> DataFrame:
    """One record per linked page; the page's address is in it as ``harvest_url``, for a field to name."""
    body = F.regexp_replace("body", r"(?s)^\s*<\?xml.*?\?>", "")
    records = ok_pages(payloads).select(
        "harvest_id", "seq", F.lit(0).cast("bigint").alias("pos"), "url", with_address(body, F.col("url")).alias("record")
    )
    return extract(records, spec)


def scan_xml_files(spark: SparkSession, path: str, selector: str) -> DataFrame:
    """Records of large XML files. The closing tag is the line separator, so one file splits over many tasks."""
    tag = selector.rstrip("/").rsplit("/", 1)[-1]
    lines = spark.read.option("lineSep", f"</{tag}>").text(path)
    chunk = F.concat("value", F.lit(f"</{tag}>"))
    return lines.select(
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("file_block"),
        F.monotonically_increasing_id().alias("file_row"),
        F.explode(xmlpath.split_elements(chunk, tag)).alias("record"),
    )
