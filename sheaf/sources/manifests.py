"""IIIF collections and manifests, versions 2 and 3."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions.lists import PAIRS, empty_strings, kept, let, merge_pairs, override, strip_all
from sheaf.functions.text import normalise_label
from sheaf.functions.variants import flatten_nested, listify, text_of
from sheaf.sources.payloads import json_fields, ok_pages
from sheaf.spec import CollectionSpec

PAIRS_V3 = "struct<metadata:array<struct<label:map<string,array<string>>,value:map<string,array<string>>>>>"


def listed_members(listings: DataFrame) -> DataFrame:
    """``harvest_id, seq, pos, member`` of each listing: ``manifests``, or else ``items``."""
    doc = F.try_parse_json("body")
    pages = ok_pages(listings).select("harvest_id", "seq", doc.alias("doc"))
    found = F.coalesce(
        F.try_variant_get("doc", "$.manifests", "array<variant>"), F.try_variant_get("doc", "$.items", "array<variant>")
    )
    return pages.select("harvest_id", "seq", F.posexplode(found).alias("pos", "member"))


def manifest_urls(listings: DataFrame, explicit: list[str] | None = None, strict: bool = False) -> DataFrame:
    """Manifest addresses of the listings, after any explicit ones (each once).

    ``strict`` fails on a listing of unknown form and on a member without an address.
    """
    if strict:
        listings = listings.where(
            F.when(
                (F.col("status") == 200) & ~known_listing(F.col("body")),
                F.raise_error(F.concat(F.lit("unknown listing form: "), "url")).cast("boolean"),
            ).otherwise(F.lit(True))
        )
    address = F.coalesce(F.try_variant_get("member", "$['@id']", "string"), F.try_variant_get("member", "$.id", "string"))
    if strict:
        address = F.coalesce(address, F.raise_error(F.lit("member without an address")).cast("string"))
    urls = listed_members(listings).select("harvest_id", "seq", F.col("pos").cast("bigint").alias("pos"), address.alias("url"))
    urls = urls.where(F.col("url").isNotNull())
    if explicit:
        first = listings.select("harvest_id").distinct().select(
            "harvest_id",
            F.lit(-1).cast("bigint").alias("seq"),
            F.posexplode(F.array_distinct(F.array(*map(F.lit, explicit)))).alias("pos", "url"),
        )
        urls = first.withColumn("pos", F.col("pos").cast("bigint")).unionByName(urls)
    return urls


def known_listing(body: Column) -> Column:
    def has_list(doc: Column) -> Column:
        lists = [F.try_variant_get(doc, f"$.{name}", "array<variant>") for name in ("manifests", "items")]
        return F.coalesce(*lists).isNotNull()

    return F.coalesce(let(F.try_parse_json(body), has_list), F.lit(False))


def unknown_listings(listings: DataFrame) -> DataFrame:
    """Audit of answered listings that hold neither form."""
    return ok_pages(listings).where(~known_listing(F.col("body"))).select(
        "harvest_id", "seq", "url"
    )


def tagged_pairs(body: Column) -> Column:
    """Version 2 pairs: a value with ``@language`` goes to the label with that suffix."""
    rows = F.from_json(body, "struct<metadata:array<struct<label:string,value:variant>>>")["metadata"]

    def one(label: Column, v: Column) -> Column:
        language = F.try_variant_get(v, "$['@language']", "string")
        value = F.coalesce(F.try_variant_get(v, "$['@value']", "variant"), v)
        found = F.transform(flatten_nested(listify(value)), text_of)
        return F.struct(F.concat_ws("_", label, language).alias("field"), F.array_compact(found).alias("values"))

    def row_pairs(row: Column) -> Column:
        label = normalise_label(row["label"])
        return F.transform(flatten_nested(listify(row["value"])), lambda v: one(label, v))

    labelled = F.filter(rows, lambda r: r["label"].isNotNull() & r["value"].isNotNull())
    return F.coalesce(F.flatten(F.transform(labelled, row_pairs)), F.array().cast(PAIRS)).cast(PAIRS)


def language_pairs(body: Column) -> Column:
    """Version 3 pairs: first label of the first language; values of every label language in turn."""
    rows = F.from_json(body, PAIRS_V3)["metadata"]

    def values(row: Column) -> Column:
        by_language = F.transform(
            F.map_keys(row["label"]), lambda k: F.coalesce(F.try_element_at(row["value"], k), empty_strings())
        )
        return F.flatten(by_language)

    def label(row: Column) -> Column:
        return normalise_label(F.get(F.get(F.map_values(row["label"]), F.lit(0)), F.lit(0)), drop_slash=False)

    pairs = F.transform(rows, lambda r: F.struct(label(r).alias("field"), values(r).alias("values")))
    return F.coalesce(pairs, F.array().cast(PAIRS)).cast(PAIRS)


def not_empty(fields: Column) -> Column:
    """Generator of the fields of records that hold any value."""
    return kept(fields, lambda m: F.exists(F.map_values(m), lambda vs: F.exists(vs, lambda v: v != "")))


def parsed(payloads: DataFrame) -> DataFrame:
    """Adds ``doc``, and drops bodies that are not JSON."""
    return payloads.select("*", kept(F.try_parse_json("body"), lambda d: d.isNotNull()).alias("doc"))


def manifest_records(payloads: DataFrame, spec: CollectionSpec) -> DataFrame:
    """Version 2 manifests as records; metadata pairs win over declared fields."""
    docs = parsed(ok_pages(payloads).select("harvest_id", "seq", "url", "body"))
    fields = override(json_fields(F.col("doc"), F.col("body"), spec), merge_pairs(tagged_pairs(F.col("body"))))
    return docs.select("harvest_id", "seq", F.lit(0).cast("bigint").alias("pos"), "url", not_empty(fields).alias("fields"))


def manifest_records_v3(listings: DataFrame, payloads: DataFrame, spec: CollectionSpec) -> DataFrame:
    """Version 3 manifests as records, with the thumbnail their listing shows."""
    members = listed_members(listings).select(
        "harvest_id",
        "seq",
        F.col("pos").cast("bigint").alias("pos"),
        F.try_variant_get("member", "$.id", "string").alias("url"),
        F.try_variant_get("member", "$.thumbnail[0].id", "string").alias("thumbnail"),
    )
    joined = parsed(members.join(ok_pages(payloads).select("harvest_id", "url", "body"), ["harvest_id", "url"]))
    declared = F.transform_values(json_fields(F.col("doc"), F.col("body"), spec), lambda _, v: strip_all(v))
    thumbnail = F.array(
        F.struct(F.lit("thumbnail").alias("field"), F.array_compact(F.array("thumbnail")).alias("values"))
    )
    fields = override(override(declared, merge_pairs(language_pairs(F.col("body")))), merge_pairs(thumbnail))
    return joined.select("harvest_id", "seq", "pos", "url", not_empty(fields).alias("fields"))
