"""Page plans and page truncation, for all harvests at once."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sheaf.functions import jsonpath
from sheaf.functions.lists import let
from sheaf.functions.text import decode_entities, is_url
from sheaf.functions.variants import opened
from sheaf.functions.xmlpath import find_values, well_formed
from sheaf.session import settle

BLOCK = 4096


def _steps(plan: DataFrame, n: Column) -> DataFrame:
    """Rows ``step`` = 0 … n-1 per harvest, in bounded blocks, so that no array grows with n."""
    last = F.ceil(n / F.lit(BLOCK)).cast("bigint") - 1
    blocks = plan.withColumn("_n", n.cast("bigint")).where(F.col("_n") > 0)
    blocks = blocks.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    start = F.col("_block") * BLOCK
    stop = F.least(start + BLOCK, F.col("_n")) - 1
    return blocks.withColumn("step", F.explode(F.sequence(start, stop))).drop("_n", "_block")


def with_total(pages: DataFrame, path: str) -> DataFrame:
    """Adds ``total``, the number of results a first JSON page states at ``path``."""
    found = jsonpath.find_texts(F.try_parse_json("body"), path, F.col("body"))
    return pages.withColumn("total", F.get(found, F.lit(0)).try_cast("bigint"))


def with_max_results(pages: DataFrame, path: str, namespaces: Mapping[str, str] | None = None) -> DataFrame:
    """Adds ``max_results``, the most results a service pages through, as an XML page states it."""
    found = F.when(well_formed(F.col("body")), find_values(F.col("body"), path, namespaces))
    return pages.withColumn("max_results", F.get(found, F.lit(0)).try_cast("bigint"))


def plan_offsets(harvests: DataFrame, increment: int, param: str, skip_first: bool = False) -> DataFrame:
    """Pages of ``harvest_id, url, total``: the bare address, then offsets below the total.

    ``skip_first`` serves services that count pages from 1: offsets start one later and
    the total is one larger.
    """
    shift = 1 if skip_first else 0
    rest = F.ceil((F.col("total") + shift - (increment + shift)) / F.lit(increment)).cast("bigint")
    first = harvests.select("harvest_id", F.lit(0).cast("bigint").alias("seq"), F.col("url").alias("page_url"))
    offset = F.col("step") * increment + increment + shift
    more = _steps(harvests, F.greatest(rest, F.lit(0))).select(
        "harvest_id",
        (F.col("step") + 1).alias("seq"),
        F.concat("url", F.lit(f"&{param}="), offset.cast("string")).alias("page_url"),
    )
    return first.unionByName(more)


def plan_starts(harvests: DataFrame, increment: int, start: int = 0) -> DataFrame:
    """Start values ``start, start+increment, …`` up to and including ``max_results``; the first always."""
    n = F.greatest(F.floor((F.col("max_results") - start) / F.lit(increment)) + 1, F.lit(1))
    return _steps(harvests, n).select("harvest_id", "step", (F.col("step") * increment + start).alias("start"))


def plan_listed(payloads: DataFrame, list_path: str) -> DataFrame:
    """The page's own address first, then every address of its page list that is not null."""
    pages = let(jsonpath.find_nodes(F.try_parse_json("body"), list_path), opened)
    first = payloads.select("harvest_id", F.lit(-1).alias("pos"), F.col("url").alias("page_url"))
    listed = payloads.select("harvest_id", F.posexplode(pages).alias("pos", "page"))
    more = listed.select("harvest_id", "pos", F.try_variant_get("page", "$.url", "string").alias("page_url"))
    return first.unionByName(more.where(F.col("page_url").isNotNull()))


def listing_entries(pages: DataFrame, path: str) -> DataFrame:
    """Adds ``entries``: the list of one listing page as variants."""
    return pages.withColumn("entries", F.try_variant_get(F.try_parse_json("body"), path, "array<variant>"))


def until_first(pages: DataFrame, stop: Column, keep_stop: bool) -> DataFrame:
    """Pages of each harvest up to the first one where ``stop`` holds.

    The first stop per harvest is a partial minimum, so no harvest is sorted or gathered. It
    is settled first: one number per harvest then meets the pages without moving their bodies.
    """
    ends = pages.where(stop).groupBy("harvest_id").agg(F.min("seq").alias("_end"))
    inside = (F.col("seq") <= F.col("_end")) if keep_stop else (F.col("seq") < F.col("_end"))
    return pages.join(settle(ends), "harvest_id", "left").where(F.col("_end").isNull() | inside).drop("_end")


def until_short(pages: DataFrame, limit: int, size: Column) -> DataFrame:
    """Stop after the first page with fewer than ``limit`` entries."""
    return until_first(pages, F.coalesce(size, F.lit(0)) < limit, keep_stop=True)


def until_malformed(pages: DataFrame, body: str = "body") -> DataFrame:
    """Stop before the first page that is not XML."""
    return until_first(pages, ~well_formed(F.col(body)), keep_stop=False)


def resumption_token(body: Column) -> Column:
    """Number after ``=`` in the page's resumption token; null when there is none."""
    token = F.regexp_extract(body, r"(?s)<(?:\w+:)?resumptionToken[^>]*>[^<]*=\s*(\d+)\s*<", 1)
    return F.when(token != "", token.cast("bigint"))


def until_token(pages: DataFrame, body: str = "body") -> DataFrame:
    """Stop after the first page without a resumption token."""
    return until_first(pages, resumption_token(F.col(body)).isNull(), keep_stop=True)


def expired(body: Column) -> Column:
    return F.coalesce(body.rlike(r"""<(?:\w+:)?error\s[^>]*code\s*=\s*["']badResumptionToken["']"""), F.lit(False))


def until_expired(pages: DataFrame, allow_expiration: bool, body: str = "body") -> DataFrame:
    """Pages before an expired token; without ``allow_expiration`` the token is an error."""
    if not allow_expiration:
        check = F.when(expired(F.col(body)), F.raise_error(F.concat(F.lit("expired token: "), "url")).cast("boolean"))
        return pages.where(check.otherwise(F.lit(True)))
    return until_first(pages, expired(F.col(body)), keep_stop=False)


def to_url(value: Column, base: Column) -> Column:
    """A valid address stays, anything else is appended to the base address."""
    return F.when(is_url(value), value).otherwise(F.concat(base, value))


def entry_urls(pages: DataFrame, base: str) -> DataFrame:
    """Record addresses of listing entries, in order."""
    entries = pages.select("harvest_id", "seq", F.posexplode("entries").alias("pos", "entry"))
    value = F.try_variant_get("entry", "$.id", "string")
    return entries.select("harvest_id", "seq", "pos", to_url(value, F.lit(base)).alias("record_url"))


def entry_thumbnails(pages: DataFrame, base: str) -> DataFrame:
    """Record address and first thumbnail of listing entries."""
    entries = pages.select("harvest_id", "seq", F.posexplode("entries").alias("pos", "entry"))
    value = F.try_variant_get("entry", "$.id", "string")
    thumbnail = F.try_variant_get("entry", "$.thumbnail[0].id", "string")
    return entries.select("harvest_id", "seq", "pos", to_url(value, F.lit(base)).alias("record_url"), thumbnail.alias("thumbnail"))


def page_links(pages: DataFrame, text: str, base: str) -> DataFrame:
    """Targets of anchors whose whole text is ``text``, after the base address."""
    quoted = "".join(f"\\{ch}" if not ch.isalnum() and ord(ch) < 128 else ch for ch in text)
    pattern = rf"""(?is)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["'][^>]*>(?-i){quoted}</a\s*>"""
    links = F.transform(F.regexp_extract_all("body", F.lit(pattern), F.lit(1)), decode_entities)
    return pages.select("harvest_id", "url", F.posexplode(links).alias("pos", "href")).select(
        "harvest_id", "url", "pos", F.concat(F.lit(base), "href").alias("page_url")
    )


def running_before(pages: DataFrame, value: str, key: str = "harvest_id", seq: str = "seq") -> DataFrame:
    """Adds ``before``: the sum of ``value`` over earlier pages of the harvest.

    Two levels: inside a block of pages, and over the block totals. A window task holds one
    block or one total per block, never a whole harvest.
    """
    blocked = pages.withColumn("_block", F.floor(F.col(seq) / BLOCK))
    totals = blocked.groupBy(key, "_block").agg(F.sum(value).alias("_total"))
    earlier = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(key, "_block", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(key, "_block").orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)
    local = blocked.withColumn("_local", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    summed = local.join(totals, [key, "_block"])
    return summed.withColumn("before", F.col("_base") + F.col("_local")).drop("_block", "_base", "_local")


def limit_records(records: DataFrame, limit: int, order: list[str]) -> DataFrame:
    """First ``limit`` records of one harvest; zero means all. The records of a small limit
    fit one task; ``limit_by_page`` serves a large one."""
    return records.orderBy(*order).limit(limit) if limit else records


def limit_by_page(records: DataFrame, limit: int) -> DataFrame:
    """First ``limit`` records of every harvest by ``(seq, pos)``, both whole numbers.

    Counts name the page on which the limit falls, then the run of positions inside it, so a
    page of any size is never ranked as a whole; one run is, to find the last record inside.
    Every record is then compared with that one settled row of its harvest, where it lies.
    """
    run = F.floor(F.col("pos") / BLOCK)
    runs = settle(records.groupBy("harvest_id", "seq", run.alias("_run")).agg(F.count("*").alias("_n")))
    falls_here = (F.col("before") < limit) & (F.col("before") + F.col("_n") >= limit)
    pages = running_before(runs.groupBy("harvest_id", "seq").agg(F.sum("_n").alias("_n")), "_n")
    edge = pages.where(falls_here).select("harvest_id", "seq", F.col("before").alias("_base"))
    earlier = Window.partitionBy("harvest_id", "seq").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    on_page = runs.join(edge, ["harvest_id", "seq"]).withColumn(
        "before", F.col("_base") + F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    )
    edge_run = settle(on_page.where(falls_here).select("harvest_id", "seq", "_run", (F.lit(limit) - F.col("before")).alias("_room")))
    rank = F.row_number().over(Window.partitionBy("harvest_id", "seq", "_run").orderBy("pos"))
    on_run = records.select("harvest_id", "seq", "pos", run.alias("_run")).join(edge_run, ["harvest_id", "seq", "_run"])
    last = on_run.withColumn("_rank", rank).where(F.col("_rank") == F.col("_room"))
    last = settle(last.select("harvest_id", F.struct("seq", "pos").alias("_last")))
    inside = F.col("_last").isNull() | (F.struct("seq", "pos") <= F.col("_last"))
    return records.join(last, "harvest_id", "left").where(inside).drop("_last")
