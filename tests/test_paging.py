import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sheaf.operators import paging
from sheaf.plans.pages import cut_pages, plan_pages


def urls(df):
    return [r.page_url for r in df.orderBy("seq").collect()]


def harvests(spark, total):
    return spark.createDataFrame([("h", "https://x.example.org/a?b=1", total)], "harvest_id string, url string, total bigint")


def test_offsets_stop_below_the_total(spark):
    out = urls(paging.plan_offsets(harvests(spark, 75), 25, "from"))
    assert out == ["https://x.example.org/a?b=1", "https://x.example.org/a?b=1&from=25", "https://x.example.org/a?b=1&from=50"]


def test_one_page_when_total_is_small(spark):
    for total in (0, 1, 25):
        assert urls(paging.plan_offsets(harvests(spark, total), 25, "from")) == ["https://x.example.org/a?b=1"]


def test_skip_first_starts_at_two(spark):
    out = urls(paging.plan_offsets(harvests(spark, 4), 1, "sp", skip_first=True))
    assert [u.split("&")[1:] for u in out] == [[], ["sp=2"], ["sp=3"], ["sp=4"]]


def test_offsets_beyond_one_block(spark):
    total = 3 * paging.BLOCK + 7
    out = paging.plan_offsets(harvests(spark, total), 1, "p")
    assert out.count() == total
    assert out.select("page_url").distinct().count() == total
    assert out.agg(F.max("seq")).first()[0] == total - 1


def test_starts_include_the_maximum(spark):
    df = harvests(spark, 150).withColumnRenamed("total", "max_results")
    assert sorted(r.start for r in paging.plan_starts(df, 100).collect()) == [0, 100]
    df = harvests(spark, 200).withColumnRenamed("total", "max_results")
    assert sorted(r.start for r in paging.plan_starts(df, 100).collect()) == [0, 100, 200]


def test_listed_pages_drop_null(payloads):
    pages = payloads('{"pagination":{"page_list":[{"url":null,"n":1},{"url":"https://x.example.org/2"},{"n":3}]}}')
    out = paging.plan_listed(pages, "pagination.page_list").orderBy("pos").collect()
    assert [r.page_url for r in out] == ["https://x.example.org/0", "https://x.example.org/2"]


def test_listing_stops_at_short_page(payloads):
    pages = payloads('{"data":[{"id":1},{"id":2}]}', '{"data":[{"id":"https://o.example.org/3"}]}', '{"data":[{"id":4},{"id":5}]}')
    kept = paging.until_short(paging.listing_entries(pages, "$.data"), 2, F.size("entries"))
    out = paging.entry_urls(kept, "https://x.example.org/art/").orderBy("seq", "pos").collect()
    assert [r.record_url for r in out] == ["https://x.example.org/art/1", "https://x.example.org/art/2", "https://o.example.org/3"]


def test_first_short_page_can_be_the_only_one(payloads):
    pages = payloads('{"data":[{"id":116787},{"id":60732}]}', '{"data":[{"id":9},{"id":9},{"id":9}]}')
    kept = paging.until_short(paging.listing_entries(pages, "$.data"), 3, F.size("entries"))
    assert kept.count() == 1


def test_entry_thumbnails(payloads):
    pages = payloads('{"items":[{"id":"https://x.example.org/m/1","thumbnail":[{"id":"t1"},{"id":"t2"}]},{"id":"m2"}]}')
    out = paging.entry_thumbnails(paging.listing_entries(pages, "$.items"), "https://x.example.org/").orderBy("pos").collect()
    assert [(r.record_url, r.thumbnail) for r in out] == [("https://x.example.org/m/1", "t1"), ("https://x.example.org/m2", None)]


def test_malformed_page_ends_the_harvest(payloads):
    pages = payloads("<r><a/></r>", "<r/>", "nothing here", "<r/>")
    assert sorted(r.seq for r in paging.until_malformed(pages).collect()) == [0, 1]
    for bad in ("", "<r><a></r>", None):
        assert paging.until_malformed(payloads("<r/>", bad)).count() == 1


def test_page_without_token_is_the_last(payloads):
    pages = payloads("<r><resumptionToken>/export?resumptionToken=2</resumptionToken></r>", "<r><item/></r>", "<r/>")
    out = paging.until_token(pages).select("seq", paging.resumption_token(F.col("body")).alias("t")).orderBy("seq").collect()
    assert [(r.seq, r.t) for r in out] == [(0, 2), (1, None)]


def test_expired_token(payloads):
    pages = payloads("<OAI/>", '<OAI><error code="badResumptionToken">x</error></OAI>', "<OAI/>")
    assert [r.seq for r in paging.until_expired(pages, allow_expiration=True).collect()] == [0]
    with pytest.raises(PySparkException, match="expired token"):
        paging.until_expired(pages, allow_expiration=False).collect()


def test_truncation_is_per_harvest(payloads):
    pages = payloads("<r/>", "bad", "<r/>", harvest="a").unionByName(payloads("<r/>", "<r/>", "<r/>", harvest="b"))
    got = {(r.harvest_id, r.seq) for r in paging.until_malformed(pages).collect()}
    assert got == {("a", 0), ("b", 0), ("b", 1), ("b", 2)}


def test_links_with_the_whole_text(payloads):
    html = """<a href="/a/1.xml">TEI XML</a> <a class='x' href='/a/2.xml'>TEI XML</a> <a href="/b">TEI XML files</a><a href="/q?a=1&amp;b=2">TEI XML</a><A HREF="/c">tei xml</A>"""
    out = paging.page_links(payloads(html), "TEI XML", "https://x.example.org").orderBy("pos").collect()
    assert [r.page_url for r in out] == [f"https://x.example.org{p}" for p in ("/a/1.xml", "/a/2.xml", "/q?a=1&b=2")]


def test_limit_cuts_inside_a_page(spark):
    rows = [("h", s, p) for s in range(5) for p in range(3)] + [("g", 0, 0)]
    df = spark.createDataFrame(rows, "harvest_id string, seq bigint, pos bigint")
    got = sorted((r.harvest_id, r.seq, r.pos) for r in paging.limit_by_page(df, 7).collect())
    assert got == sorted([("g", 0, 0)] + [("h", s, p) for s in range(2) for p in range(3)] + [("h", 2, 0)])


def test_limit_inside_a_huge_page(spark):
    n = 3 * paging.BLOCK
    df = spark.range(n).selectExpr("'h' AS harvest_id", "cast(0 as bigint) AS seq", "id AS pos")
    for limit in (1, paging.BLOCK, paging.BLOCK + 1, n - 1, n, n + 5):
        out = paging.limit_by_page(df, limit)
        assert out.agg(F.count("*"), F.max("pos")).first()[:] == (min(limit, n), min(limit, n) - 1)


def test_running_sum_over_blocks(spark):
    n = 2 * paging.BLOCK + 5
    pages = spark.range(n).selectExpr("'h' AS harvest_id", "id AS seq", "id % 3 AS n")
    out = paging.running_before(pages, "n")
    assert out.count() == n
    last = out.where(F.col("seq") == n - 1).first()
    assert last.before == sum(i % 3 for i in range(n - 1))
    assert out.where("seq = 0").first().before == 0


def test_plans_by_options(payloads):
    page = payloads('{"n":{"of":60},"list":[{"url":"u1"}]}')
    offsets = plan_pages(page, {"increment": 30, "query_param": "p", "result_count": "n.of"})
    assert urls(offsets) == ["https://x.example.org/0", "https://x.example.org/0&p=30"]
    assert plan_pages(page, {"urls": "list"}).count() == 2
    listing = payloads('{"items":[{"id":"a"},{"id":"b"}]}', '{"items":[{"id":"c"}]}', '{"items":[{"id":"d"}]}')
    options = {"pages_url": "https://x/{offset}/{limit}", "page_data": "items", "limit": 2}
    assert sorted(r.record_url for r in plan_pages(listing, options, "b/").collect()) == ["b/a", "b/b", "b/c"]
    html = payloads('<a href="/t.xml">TEI</a>')
    assert plan_pages(html, {"link_text": "TEI", "base_url": "https://b"}).first().page_url == "https://b/t.xml"
    with pytest.raises(ValueError):
        plan_pages(page, {"something": 1})


def test_cuts_by_options(payloads):
    page = '<r><p:most xmlns:p="u">150</p:most></r>'
    most = {"path": "//p:most", "namespace": {"p": "u"}}
    options = {"pagination": True, "increment": 100, "max_results": most}
    assert sorted(r.seq for r in cut_pages(payloads(page, page, page), options).collect()) == [0, 1]
    assert cut_pages(payloads("<r/>", "<r/>", "bad"), {}).count() == 2
    assert cut_pages(payloads("<r/>", "<r/>"), {"resumptionToken": True}).count() == 1
    with pytest.raises(ValueError):
        cut_pages(payloads(page), {"pagination": True, "increment": 1})
