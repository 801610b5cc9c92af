"""Page plans and page truncation over pages made of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheaf.functions.text import is_url
from sheaf.operators import paging
from sheaf.plans.catalogue import load, query
from sheaf.plans.pages import plan_pages

BASE = "https://catalogue.example.org/item/"


def user_totals(spark, sf_dir):
    """First pages, which state how many events the user has."""
    totals = load(spark, sf_dir, "events").groupBy(F.col("user_id").cast("string").alias("harvest_id"))
    n = F.count("*").cast("string")
    return totals.agg(
        F.concat(F.lit('{"pagination":{"of":'), n, F.lit("}}")).alias("json_body"),
        F.concat(F.lit('<p:results xmlns:p="u"><p:maxPageableSet>'), n, F.lit("</p:maxPageableSet></p:results>")).alias("xml_body"),
    ).withColumn("url", F.concat(F.lit("https://catalogue.example.org/list?user="), "harvest_id"))


def json_totals(spark, sf_dir):
    return paging.with_total(user_totals(spark, sf_dir).withColumnRenamed("json_body", "body"), "pagination.of")


_TOTALS_SQL = """
    SELECT user_id::VARCHAR AS harvest_id, count(*) AS total,
           'https://catalogue.example.org/list?user=' || user_id AS url
    FROM events GROUP BY user_id
"""


@query(
    "page_plan_offset",
    f"""
    WITH h AS ({_TOTALS_SQL})
    SELECT harvest_id, 0::BIGINT AS seq, url AS page_url FROM h
    UNION ALL
    SELECT harvest_id, (o // 25)::BIGINT, url || '&offset=' || o FROM h, unnest(range(25, total, 25)) AS t(o)
    """,
)
def page_plan_offset(spark, sf_dir):
    options = {"increment": 25, "query_param": "offset", "result_count": "pagination.of"}
    return plan_pages(user_totals(spark, sf_dir).withColumnRenamed("json_body", "body"), options)


@query(
    "page_plan_skip_first",
    f"""
    WITH h AS ({_TOTALS_SQL})
    SELECT harvest_id, 0::BIGINT AS seq, url AS page_url FROM h
    UNION ALL
    SELECT harvest_id, (o - 1)::BIGINT, url || '&sp=' || o FROM h, unnest(range(2, total + 1)) AS t(o)
    """,
)
def page_plan_skip_first(spark, sf_dir):
    return paging.plan_offsets(json_totals(spark, sf_dir), 1, "sp", skip_first=True)


@query(
    "page_plan_max",
    f"""
    WITH h AS ({_TOTALS_SQL})
    SELECT harvest_id, (s // 20)::BIGINT AS step, s::BIGINT AS start FROM h, unnest(range(0, total + 1, 20)) AS t(s)
    """,
)
def page_plan_max(spark, sf_dir):
    pages = user_totals(spark, sf_dir).withColumnRenamed("xml_body", "body")
    return paging.plan_starts(paging.with_max_results(pages, "//p:maxPageableSet", {"p": "u"}), 20)


@query(
    "page_plan_listed",
    """
    WITH links AS (
        SELECT page_id::VARCHAR AS harvest_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hrefs FROM pages
    ), listed AS (
        SELECT harvest_id, generate_subscripts(hrefs, 1) - 1 AS pos, unnest(hrefs) AS href FROM links
    )
    SELECT harvest_id, -1 AS pos, url AS page_url FROM links
    UNION ALL SELECT harvest_id, pos, href FROM listed WHERE href <> '/the'
    """,
)
def page_plan_listed(spark, sf_dir):
    links = F.regexp_extract_all("html", F.lit(r'<a href="([^"]*)"'), F.lit(1))
    entries = F.transform(links, lambda h: F.struct(F.when(h != "/the", h).alias("url")))
    body = F.to_json(F.struct(F.struct(entries.alias("page_list")).alias("pagination")))
    payloads = load(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("harvest_id"), "url", body.alias("body"))
    return paging.plan_listed(payloads, "pagination.page_list")


@query(
    "id_to_url",
    """
    WITH ids AS (SELECT page_id, CASE WHEN starts_with(url, 'https://') THEN url ELSE url[8:] END AS id FROM pages)
    SELECT page_id, CASE WHEN starts_with(id, 'https://') THEN id
           ELSE 'https://catalogue.example.org/item/' || id END AS record_url
    FROM ids
    """,
)
def id_to_url(spark, sf_dir):
    bare = F.substring(F.col("url"), F.lit(8), F.length("url"))
    value = F.when(F.startswith("url", F.lit("https://")), F.col("url")).otherwise(bare)
    return load(spark, sf_dir, "pages").select("page_id", paging.to_url(value, F.lit(BASE)).alias("record_url"))


@query(
    "url_valid",
    """
    SELECT page_id, true AS valid, false AS bare_valid, page_id % 300 <= 255 AS octet_valid,
           page_id * 7919 % 80000 <= 65535 AS port_valid, page_id % 8 < 7 AS groups_valid FROM pages
    """,
)
def url_valid(spark, sf_dir):
    bare = F.substring(F.col("url"), F.lit(8), F.length("url"))
    n = F.col("page_id")
    octet = F.concat(F.lit("http://"), (n % 300).cast("string"), F.lit(".1.2.3/x"))
    port = F.concat(F.lit("https://h.example.org:"), (n * 7919 % 80000).cast("string"), F.lit("/"))
    # 1 to 8 groups before a run of zeros, of which 7 is the most
    groups = F.concat(F.lit("http://["), F.repeat(F.lit("a:"), (n % 8).cast("int") + 1), F.lit(":]/"))
    checks = {"valid": F.col("url"), "bare_valid": bare, "octet_valid": octet, "port_valid": port, "groups_valid": groups}
    return load(spark, sf_dir, "pages").select("page_id", *[is_url(c).alias(name) for name, c in checks.items()])


def listing_pages(spark, sf_dir):
    """Per event type, the events of each run of 100 ids as one JSON listing page."""
    entry = F.struct(
        F.col("event_id").alias("id"),
        F.array(F.struct(F.concat(F.lit("https://img.example.org/"), "user_id").alias("id"))).alias("thumbnail"),
    )
    pages = load(spark, sf_dir, "events").groupBy(
        F.col("event_type").alias("harvest_id"), F.floor(F.col("event_id") / 100).alias("seq")
    )
    return pages.agg(F.to_json(F.struct(F.sort_array(F.collect_list(entry)).alias("data"))).alias("body"))


_PAGES_SQL = """
    SELECT event_type AS harvest_id, event_id // 100 AS seq, count(*) AS size FROM events GROUP BY ALL
"""


@query(
    "page_until_short",
    f"""
    WITH p AS ({_PAGES_SQL}), e AS (SELECT harvest_id, min(seq) AS stop FROM p WHERE size < 13 GROUP BY harvest_id)
    SELECT harvest_id, seq::BIGINT AS seq, size FROM p LEFT JOIN e USING (harvest_id) WHERE stop IS NULL OR seq <= stop
    """,
)
def page_until_short(spark, sf_dir):
    pages = paging.listing_entries(listing_pages(spark, sf_dir), "$.data")
    size = F.size("entries")
    return paging.until_short(pages, 13, size).select("harvest_id", "seq", size.cast("bigint").alias("size"))


@query(
    "page_entries",
    f"""
    WITH p AS ({_PAGES_SQL}), e AS (SELECT harvest_id, min(seq) AS stop FROM p WHERE size < 13 GROUP BY harvest_id)
    SELECT v.event_type AS harvest_id, (v.event_id // 100)::BIGINT AS seq,
           (row_number() OVER (PARTITION BY v.event_type, v.event_id // 100 ORDER BY v.event_id) - 1)::INT AS pos,
           'https://catalogue.example.org/item/' || v.event_id AS record_url,
           'https://img.example.org/' || v.user_id AS thumbnail
    FROM events v LEFT JOIN e ON e.harvest_id = v.event_type WHERE stop IS NULL OR v.event_id // 100 <= stop
    """,
)
def page_entries(spark, sf_dir):
    pages = paging.listing_entries(listing_pages(spark, sf_dir), "$.data")
    return paging.entry_thumbnails(paging.until_short(pages, 13, F.size("entries")), BASE)


@query(
    "page_entry_urls",
    """
    SELECT event_type AS harvest_id, (event_id // 100)::BIGINT AS seq,
           (row_number() OVER (PARTITION BY event_type, event_id // 100 ORDER BY event_id) - 1)::INT AS pos,
           'https://catalogue.example.org/item/' || event_id AS record_url
    FROM events
    """,
)
def page_entry_urls(spark, sf_dir):
    # no page has fewer than one entry, so none is the last
    return plan_pages(listing_pages(spark, sf_dir), {"pages_url": "https://x/{offset}", "page_data": "data", "limit": 1}, BASE)


def event_pages(spark, sf_dir, body):
    return load(spark, sf_dir, "events").select(
        F.col("user_id").alias("harvest_id"), F.col("event_id").alias("seq"),
        F.concat(F.lit("https://catalogue.example.org/page/"), "event_id").alias("url"), body.alias("body"),
    )


def _stop_sql(kind: str, compare: str, extra: str = "") -> str:
    return f"""
    WITH e AS (SELECT user_id, min(event_id) AS stop FROM events WHERE event_type = '{kind}' GROUP BY user_id)
    SELECT v.user_id AS harvest_id, v.event_id AS seq{extra}
    FROM events v LEFT JOIN e USING (user_id) WHERE stop IS NULL OR v.event_id {compare} stop
    """


@query("page_until_malformed", _stop_sql("error", "<"))
def page_until_malformed(spark, sf_dir):
    good = F.concat(F.lit("<page><v>"), "value", F.lit("</v></page>"))
    body = F.when(F.col("event_type") == "error", F.lit("<page><v>")).otherwise(good)
    return paging.until_malformed(event_pages(spark, sf_dir, body)).select("harvest_id", "seq")


@query(
    "page_until_token",
    _stop_sql("purchase", "<=", ", CASE WHEN v.event_type = 'purchase' THEN -1 ELSE v.event_id + 1 END AS next_offset"),
)
def page_until_token(spark, sf_dir):
    token = F.concat(F.lit("<resumptionToken>/export?resumptionToken="), F.col("event_id") + 1, F.lit("</resumptionToken>"))
    inner = F.when(F.col("event_type") == "purchase", F.lit("")).otherwise(token)
    pages = event_pages(spark, sf_dir, F.concat(F.lit("<page>"), inner, F.lit("</page>")))
    next_offset = F.coalesce(paging.resumption_token(F.col("body")), F.lit(-1).cast("bigint"))
    return paging.until_token(pages).select("harvest_id", "seq", next_offset.alias("next_offset"))


@query("page_expired", _stop_sql("error", "<"))
def page_expired(spark, sf_dir):
    error = F.lit('<OAI-PMH><error code="badResumptionToken">expired</error></OAI-PMH>')
    body = F.when(F.col("event_type") == "error", error).otherwise(F.lit("<OAI-PMH/>"))
    return paging.until_expired(event_pages(spark, sf_dir, body), allow_expiration=True).select("harvest_id", "seq")


@query(
    "running_page_counts",
    f"""
    SELECT harvest_id, seq::BIGINT AS seq, size,
           coalesce(sum(size) OVER (PARTITION BY harvest_id ORDER BY seq
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
    FROM ({_PAGES_SQL})
    """,
)
def running_page_counts(spark, sf_dir):
    pages = load(spark, sf_dir, "events").groupBy(
        F.col("event_type").alias("harvest_id"), F.floor(F.col("event_id") / 100).alias("seq")
    ).agg(F.count("*").alias("size"))
    return paging.running_before(pages, "size")


@query(
    "html_links_by_text",
    """
    WITH l AS (SELECT page_id::VARCHAR AS harvest_id, url,
                      regexp_extract_all(html, '<a href="([^"]*)">the</a>', 1) AS hrefs FROM pages)
    SELECT harvest_id, url, (generate_subscripts(hrefs, 1) - 1)::INT AS pos,
           'https://catalogue.example.org' || unnest(hrefs) AS page_url FROM l
    """,
)
def html_links_by_text(spark, sf_dir):
    pages = load(spark, sf_dir, "pages").select(
        F.col("page_id").cast("string").alias("harvest_id"), "url", F.col("html").alias("body")
    )
    return paging.page_links(pages, "the", "https://catalogue.example.org")
