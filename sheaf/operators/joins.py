"""Joins between harvests of one collection. No side is broadcast by hint: adaptive
execution measures both sides, broadcasts a small one and splits hot keys of large ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.sources.manifests import listed_members
from sheaf.sources.payloads import ok_pages


def join_on_id(left: DataFrame, right: DataFrame, key: str = "id", within: tuple[str, ...] = ()) -> DataFrame:
    """Inner join on the id (and ``within`` columns, such as the collection); other columns
    both sides have get ``_x`` and ``_y``."""
    keys = [*within, key]
    both = (set(left.columns) & set(right.columns)) - set(keys)

    def suffixed(df: DataFrame, suffix: str) -> DataFrame:
        return df.select([F.col(f"`{c}`").alias(c + suffix if c in both else c) for c in df.columns])

    return suffixed(left, "_x").join(suffixed(right, "_y"), keys)


def listing_thumbnails(listings: DataFrame, payloads: DataFrame) -> DataFrame:
    """``id, thumbnail`` of listed version 3 items; the thumbnail is the first canvas's, else null."""
    address = F.coalesce(F.try_variant_get("member", "$['@id']", "string"), F.try_variant_get("member", "$.id", "string"))
    urls = listed_members(listings).select("harvest_id", address.alias("url"))
    docs = ok_pages(payloads).select(
        "url", F.try_variant_get(F.try_parse_json("body"), "$.items[0].thumbnail[0].id", "string").alias("thumbnail")
    )
    return urls.join(docs, "url").select("harvest_id", F.col("url").alias("id"), "thumbnail")
