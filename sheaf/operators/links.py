"""Link checks of mapped records against a table of probe results, and thumbnail quality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sheaf.functions.text import is_url
from sheaf.operators.report import whole_percent

# Sample sizes by number of addresses, and the least good image side.
SAMPLE_TIERS = ((5000, 250), (100, 50))
GOOD_SIDE = 400

# Sentences of the report.
UNRESOLVED = ("Identifier ", " from ", ": ")
NO_THUMBNAILS = "No thumbnail images were resolvable."
THUMBNAIL_SHARE = ("% of the ", " thumbnail images sampled had a width or height of {} or greater.")


def record_links(lines: DataFrame) -> DataFrame:
    """``collection_id, id, kind, url`` of every record: its resource, and its preview if it has one."""
    doc = lines.select("collection_id", F.try_parse_json("value").alias("doc"))
    shown = F.struct(F.lit("resource").alias("kind"), F.try_variant_get("doc", "$.agg_is_shown_at.wr_id", "string").alias("url"))
    preview = F.struct(F.lit("thumbnail").alias("kind"), F.try_variant_get("doc", "$.agg_preview.wr_id", "string").alias("url"))
    has_preview = F.try_variant_get("doc", "$.agg_preview", "variant")
    filled = has_preview.isNotNull() & ~F.to_json(has_preview).isin("null", "{}", '""', "[]", "0", "false")
    links = F.when(filled, F.array(shown, preview)).otherwise(F.array(shown))
    return doc.select("collection_id", F.try_variant_get("doc", "$.id", "string").alias("id"), F.inline(links))


def check_links(links: DataFrame, probes: DataFrame) -> DataFrame:
    """Adds ``resolved``: the address is valid and a probe of it answered below 400.

    Invalid addresses cannot match; each gets a key of its own, so that a flood of nulls
    does not meet in one task.
    """
    results = probes.groupBy(F.col("url").alias("_url")).agg(
        F.max((F.col("status") < 400) & F.col("error").isNull()).alias("_ok")
    )
    valid = is_url(F.col("url"))
    key = F.when(valid, F.col("url")).otherwise(F.concat(F.lit("\x00"), F.coalesce("id", F.lit(""))))
    joined = links.withColumn("_key", key).join(results, F.col("_key") == F.col("_url"), "left")
    return joined.withColumn("resolved", valid & F.coalesce("_ok", F.lit(False))).drop("_key", "_url", "_ok")


def unresolvable(checked: DataFrame) -> DataFrame:
    """Report lines of links that did not resolve."""
    message = F.concat(F.lit(UNRESOLVED[0]), "id", F.lit(UNRESOLVED[1]), "collection_id", F.lit(UNRESOLVED[2]), F.coalesce("url", F.lit("None")))
    return checked.where(~F.col("resolved")).select("collection_id", "id", "kind", message.alias("message"))


def thumbnail_sample(thumbnails: DataFrame, tiers: Sequence[tuple[int, int]] = SAMPLE_TIERS) -> DataFrame:
    """Per collection all addresses, or as many as the highest tier says whose bound is exceeded, in hash order.

    The rank is limited before the shuffle; counts are partial sums.
    """
    if not tiers:
        raise ValueError("a sample needs a tier")
    most = max(min(bound for bound, _ in tiers), *[size for _, size in tiers])
    by_hash = Window.partitionBy("collection_id").orderBy(F.md5("url"), "id")
    ranked = thumbnails.withColumn("rank", F.row_number().over(by_hash)).where(F.col("rank") <= most)
    counts = thumbnails.groupBy("collection_id").agg(F.count("*").alias("available"))
    size = F.col("available")
    for bound, sample in sorted(tiers):
        size = F.when(F.col("available") > bound, F.lit(sample)).otherwise(size)
    return ranked.join(counts, "collection_id").where(F.col("rank") <= size)


def thumbnail_quality(sizes: DataFrame) -> DataFrame:
    """Per collection the share of sampled images with a side of 400 or more, as counts and text."""
    good = F.sum(F.when(F.greatest("width", "height") >= GOOD_SIDE, 1).otherwise(0))
    n = F.count("width")
    grouped = sizes.groupBy("collection_id").agg(n.alias("sampled"), F.coalesce(good, F.lit(0)).alias("good"))
    percent = whole_percent(F.col("good"), F.greatest("sampled", F.lit(1)))
    text = F.when(F.col("sampled") == 0, F.lit(NO_THUMBNAILS)).otherwise(
        F.concat(percent.cast("string"), F.lit(THUMBNAIL_SHARE[0]), F.col("sampled").cast("string"), F.lit(THUMBNAIL_SHARE[1].format(GOOD_SIDE)))
    )
    return grouped.withColumn("message", text)
