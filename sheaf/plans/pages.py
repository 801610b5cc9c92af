"""Page plans and page cuts as a spec's paging options ask for them."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.operators import paging


def plan_pages(pages: DataFrame, options: Mapping[str, Any], base: str = "") -> DataFrame:
    """Addresses to fetch next, from landed first pages or listing pages.

    A result count gives offsets, a page list its own addresses, listing pages the addresses
    of their entries up to the first short page, and a link text the links that carry it.
    """
    if "pages_url" in options:
        listing = paging.listing_entries(pages, f"$['{options['page_data']}']")
        return paging.entry_urls(paging.until_short(listing, options["limit"], F.size("entries")), base)
    if "link_text" in options:
        return paging.page_links(pages, options["link_text"], options.get("base_url", ""))
    if "increment" in options and "result_count" in options:
        counted = paging.with_total(pages, options["result_count"])
        return paging.plan_offsets(counted, options["increment"], options["query_param"], bool(options.get("skip_first")))
    if "urls" in options:
        return paging.plan_listed(pages, options["urls"])
    raise ValueError(f"paging options name no page plan: {sorted(options)}")


def cut_pages(pages: DataFrame, options: Mapping[str, Any]) -> DataFrame:
    """Landed XML pages of a harvest up to its end: the page without a token, the largest
    result set the service allows, or the first page that is not XML."""
    if "resumptionToken" in options:
        return paging.until_token(pages)
    if "pagination" in options:
        if "max_results" not in options:
            raise ValueError("paging by a largest result set needs max_results")
        most = options["max_results"]
        stated = paging.with_max_results(pages, most["path"], most.get("namespace"))
        start = F.col("seq") * options["increment"] + options.get("start", 0)
        return paging.until_first(stated, start + options["increment"] > F.col("max_results"), keep_stop=True).drop("max_results")
    return paging.until_malformed(pages)
