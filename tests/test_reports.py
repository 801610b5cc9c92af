import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sheaf.operators import conform, inventory, links, mapping, reconcile, report, snapshots
from sheaf.operators.enrich import add_thumbnails
from sheaf.spec import CollectionSpec
from sheaf.streaming import incremental


def lines(spark, *records, collection="c"):
    return spark.createDataFrame([(collection, json.dumps(r)) for r in records], "collection_id string, value string")


MUSEUM = [
    {
        "id": str(i),
        "shop_source_file": "f.json",
        "agg_is_shown_at": {"wr_id": f"https://x.example.org/{i}", "wr_dc_rights": ["open"]},
        "agg_preview": {"wr_id": f"https://x.example.org/{i}.jpg"},
        "agg_edm_rights": ["cc"],
        "cho_title": {"en": ["t"], "ar-Arab": ["u", "v"]},
        "cho_dc_rights": {"en": ["r"]},
        "cho_date_range_norm": [1, 2, 3],
        **({"cho_extent": {"en": ["1 p."]}} if i < 2 else {}),
    }
    for i in range(3)
]


def counts(spark, *records):
    return report.field_counts(lines(spark, *records), report.ignored_fields("shop"))


def table(df):
    return {(r.field, r.key): r.n for r in df.where(F.col("field") != report.RECORDS).collect()}


@pytest.mark.parametrize(
    "value, expected",
    [
        ({"en": ["a", "b"]}, {"fields_covered": 1, "en": 2}),
        ({"en": "a", "fr": []}, {"fields_covered": 1, "en": 1, "fr": 0}),
        (["a", "b"], {"fields_covered": 1, "values": 1}),
        ("a", {"fields_covered": 1, "values": 1}),
        (None, {"fields_covered": 1, "values": 1}),
        ({}, {"fields_covered": 1}),
    ],
)
def test_field_counts(spark, value, expected):
    assert table(counts(spark, {"f": value})) == {("f", k): n for k, n in expected.items()}


def test_ignored_fields(spark):
    assert table(counts(spark, {"id": "1", "cho_type_facet": "x", "shop_source_file": "x", "shop_collection": "y"})) == {}


def test_coverage_is_truncated(spark):
    got = {r.field: r.percent for r in report.coverage(counts(spark, *MUSEUM)).collect()}
    assert got["cho_extent"] == 66
    assert {v for k, v in got.items() if k != "cho_extent"} == {100}


def test_averages(spark):
    c = counts(spark, *MUSEUM)
    plain = {(r.field, r.key): r.average for r in report.averages(c).collect()}
    assert plain[("cho_date_range_norm", "values")] == 1.0 and plain[("agg_preview", "wr_id")] == 1.0
    langs = {(r.field, r.lang): r.average for r in report.language_averages(c).collect()}
    assert langs[("cho_title", "*")] == 3.0 and langs[("cho_title", "ar-Arab")] == 2.0 and langs[("cho_extent", "en")] == 0.67


def test_resources_and_rights(spark):
    c = counts(spark, *MUSEUM)
    r = report.resource_report(c).first()
    assert (r.records, r.thumbnails, r.resources, r.manifests) == (3, 3, 3, 0)
    r = report.rights_report(c).first()
    assert (r.object_rights, r.web_resource_rights, r.aggregation_rights) == (3, 3, 3)
    edm = {"id": "1", "agg_is_shown_at": {"wr_id": "u", "wr_edm_rights": ["x"], "wr_dc_rights": ["y", "z"]}}
    assert report.rights_report(counts(spark, edm)).first().web_resource_rights == 1


def test_rounding(spark):
    df = spark.createDataFrame([(1, 3), (2, 3), (1, 8), (3, 8), (5, 1), (1, 200), (3, 200)], "n bigint, d bigint")
    got = [r[0] for r in df.select(report.hundredths(F.col("n"), F.col("d"))).collect()]
    assert got == [0.33, 0.67, 0.12, 0.38, 5.0, 0.0, 0.02]


def test_thumbnail_quality(spark):
    sizes = spark.createDataFrame([("c", 100, 200), ("c", 400, 300), ("c", 100, 500), ("e", None, None)], "collection_id string, width int, height int")
    got = {r.collection_id: r.message for r in links.thumbnail_quality(sizes).collect()}
    assert got["c"] == "67% of the 3 thumbnail images sampled had a width or height of 400 or greater."
    assert got["e"] == "No thumbnail images were resolvable."


def test_links(spark):
    records = [
        {"id": "ok", "agg_is_shown_at": {"wr_id": "https://x.example.org/1"}, "agg_preview": {"wr_id": "https://x.example.org/gone"}},
        {"id": "bad", "agg_is_shown_at": {"wr_id": "not a url"}, "agg_preview": {}},
        {"id": "null", "agg_is_shown_at": {"wr_id": None}},
        {"id": "late", "agg_is_shown_at": {"wr_id": "https://x.example.org/timeout"}, "agg_preview": {"wr_id": "https://x.example.org/1"}},
        {"id": "unprobed", "agg_is_shown_at": {"wr_id": "https://x.example.org/2"}},
    ]
    probes = spark.createDataFrame(
        [("https://x.example.org/1", 200, None), ("https://x.example.org/gone", 404, None), ("https://x.example.org/timeout", None, "timed out"), ("not a url", 200, None)],
        "url string, status int, error string",
    )
    checked = links.check_links(links.record_links(lines(spark, *records)), probes)
    bad = {(r.id, r.kind) for r in links.unresolvable(checked).collect()}
    assert bad == {("ok", "thumbnail"), ("bad", "resource"), ("null", "resource"), ("late", "resource"), ("unprobed", "resource")}


def test_sample_sizes(spark):
    df = spark.sql(
        "SELECT c AS collection_id, cast(id AS string) AS id, concat('u', id) AS url FROM range(5001) "
        "LATERAL VIEW explode(array('big', 'mid', 'small')) t AS c WHERE c = 'big' OR (c = 'mid' AND id < 101) OR id < 100"
    )
    got = {r.collection_id: r["count"] for r in links.thumbnail_sample(df).groupBy("collection_id").count().collect()}
    assert got == {"big": 250, "mid": 50, "small": 100}


def test_required(spark):
    good = {"id": "g", "agg_preview": {"wr_id": "u"}, "agg_is_shown_at": {"wr_id": "u"}, "cho_dc_rights": {"en": ["x"]}, "cho_edm_type": {"en": ["x"]}, "cho_has_type": {"en": ["x"]}}
    bad = {**good, "id": "b", "agg_preview": {"wr_id": ""}, "cho_edm_type": {}, "cho_has_type": None}
    none = {"id": "n"}
    found = conform.missing_required(lines(spark, good, bad, none))
    assert {(r.field, r.id) for r in found.collect()} == {
        ("agg_preview", "b"), ("cho_edm_type", "b"), ("cho_has_type", "b"), *((f, "n") for f in conform.REQUIRED_FIELDS),
    }
    assert {r.field: r.n for r in conform.missing_counts(found).collect()}["agg_preview"] == 2


def test_conformance(spark):
    df = spark.createDataFrame([("1", "xml", None, None), ("2", "oai_xml", None, "d"), ("3", "other", "p", None)], "id string, driver string, prefix string, data_path string")
    rules = conform.Rules(required=["data_path"], allowed={"driver": ["xml", "oai_xml"]}, required_when=[("prefix", "driver", "oai_xml")])
    got = {(r.id, r.rule) for r in conform.violations(df, rules, "id").collect()}
    assert got == {("1", "required:data_path"), ("2", "required:prefix:when:driver=oai_xml"), ("3", "required:data_path"), ("3", "allowed:driver")}


def test_count_formula(spark):
    df = spark.createDataFrame([(6, "/2"), (6, "-2"), (6, "+2"), (6, "/0"), (6, None), (7, "/2"), (6, "*3")], "n bigint, f string")
    got = [r[0] for r in df.select(reconcile.expected_count(F.col("n"), F.col("f"))).collect()]
    assert got == [3.0, 4.0, 8.0, 0.0, 6.0, 3.5, 18.0]
    with pytest.raises(PySparkException, match="unsupported count formula"):
        spark.createDataFrame([(6, "__import__('os')")], "n bigint, f string").select(reconcile.expected_count(F.col("n"), F.col("f"))).collect()


def test_reconcile(spark):
    ids = lambda *cs: spark.createDataFrame([(c,) for c in cs], "collection_id string")
    formulas = spark.createDataFrame([("half", "/2")], "collection_id string, formula string")
    harvested, mapped = ids("a", "a", "a", "half", "half", "b"), ids("a", "a", "a", "half", "c")
    got = {r.collection_id: (r.harvested, r.mapped, r.status) for r in reconcile.reconcile(harvested, mapped, formulas).collect()}
    assert got == {"a": (3, 3, "ok"), "half": (2, 1, "ok"), "b": (1, 0, "failed"), "c": (0, 1, "failed")}
    with pytest.raises(PySparkException, match="counts differ"):
        reconcile.reconcile(harvested, mapped, formulas, strict=True).collect()
    with pytest.raises(ValueError):
        reconcile.require_rows(ids("a").where("false"))


def test_snapshots(spark):
    rows = [("a", 1, "x"), ("a", 1, "x"), ("a", 2, None), ("b", 1, "y")]
    now = spark.createDataFrame(rows, "c string, k int, v string")
    shuffled = spark.createDataFrame(rows[::-1], "c string, k int, v string")
    assert {r.decision for r in snapshots.decide_load(now, shuffled, "c", ["k", "v"]).collect()} == {"skip"}
    once = spark.createDataFrame([rows[0], rows[2], ("a", 2, ""), rows[3]], "c string, k int, v string")
    got = {r.c: r.decision for r in snapshots.decide_load(now, once, "c", ["k", "v"]).collect()}
    assert got == {"a": "load", "b": "skip"}
    assert snapshots.differing_rows(now, shuffled).count() == 0
    got = sorted((r.side, r.k, r.v, r.copies) for r in snapshots.differing_rows(now, once).collect())
    assert got == [("current", 1, "x", 1), ("previous", 2, "", 1)]


def test_only_changed_ranges_are_compared(spark):
    import random

    rnd = random.Random(2)
    before = [(rnd.choice(["a", "b", None]), i % 300, rnd.choice(["x", "y", None])) for i in range(900)] + [("same", i, "z") for i in range(20, 70)]
    now = [r for r in before if r[1] != 7] + [("b", 8, "x"), (None, 9, None), ("new", 1, "n")]
    cur, old = (spark.createDataFrame(rows, "c string, k int, v string") for rows in (now, before))
    wanted = {r: now.count(r) - before.count(r) for r in set(now + before) if now.count(r) != before.count(r)}
    for group, key, buckets in ((None, None, 4), (["c"], ["k"], 16), (["c"], None, 1)):
        got = snapshots.differing_rows(cur, old, group=group, key=key, buckets=buckets).collect()
        assert {(r.c, r.k, r.v): r.copies if r.side == "current" else -r.copies for r in got} == wanted
    assert snapshots._changed_ranges(cur, old, ["c"], ["c", "k", "v"]).where("c = 'same'").count() == 0


def test_archive(spark, tmp_path):
    snaps = spark.createDataFrame(
        [("c", "1", 2, "d1"), ("c", "2", 2, "d1"), ("c", "3", 0, ""), ("c", "4", 2, "d1"), ("c", "5", 3, "d2"), ("c", "6", 2, "d1")],
        "key string, snapshot_ts string, n bigint, digest string",
    )
    decided = snapshots.archive_decisions(snaps, ["key"])
    assert [r.decision for r in decided.orderBy("snapshot_ts").collect()] == ["archive", "unchanged", "empty", "unchanged", "archive", "archive"]
    rows = spark.createDataFrame([("c", str(t), i) for t in range(1, 7) for i in range(2)], "key string, snapshot_ts string, v int")
    path = str(tmp_path / "a")
    for _ in range(2):  # the same write again changes nothing
        snapshots.archive(rows, decided, ["key"], path)
        kept = sorted((r.key, r.snapshot_ts, r.v) for r in snapshots.archived(spark, path, ["key"]).collect())
        assert kept == [("c", t, i) for t in "156" for i in range(2)]
    rows.where("snapshot_ts = '2'").write.mode("append").partitionBy("key", "snapshot_ts").parquet(f"{path}/rows")
    assert snapshots.archived(spark, path, ["key"]).count() == 6  # rows of a write that has not ended do not count
    assert snapshots.newest(snaps, ["key"]).first().snapshot_ts == "6"


def test_crosswalk(spark):
    text = [
        "to_field 'cho_title', extract_json('.title[0]'), strip, prepend('x')",
        "to_field 'cho_edm_type', generate_edm_type, translation_map('types')",
        "to_field 'cho_date', column('date'), strip",
        "to_field 'cho_type_facet', column('facet')",
        "to_field 'agg_provider', provider",
        "to_field 'cho_language', literal('Arabic'), lang('en')",
        "each_record do |r|",
        "## skipped field ",
    ]
    df = spark.createDataFrame([("m.rb", i, t) for i, t in enumerate(text)], "file_name string, line_no int, line string")
    got = {r.to_field: (r.from_field, r.transforms) for r in mapping.crosswalk(df).collect()}
    assert set(got) == {"cho_title", "cho_edm_type", "cho_date", "cho_language"}
    assert got["cho_title"] == (".title[0]", mapping.MODIFY_MACROS["prepend"])
    assert got["cho_edm_type"][0] == ".Classification or .ObjectName"
    assert got["cho_edm_type"][1] == f"{mapping.EXTRACT_MACROS['generate_edm_type'][1]} {mapping.MODIFY_MACROS['translation_map']}"
    assert got["cho_date"] == ("date", "")
    assert got["cho_language"][0] == "Assigned literal value: ''Arabic''"
    assert {r.field for r in mapping.mapped_fields(df).collect()} == {"title", "date", "facet"}
    assert [r.field for r in mapping.ignored_in_mapping(df).collect()] == ["skipped field"]


def test_inventory(spark):
    df = spark.sql("SELECT 'f1' AS f, map('a', array('1'), 'b', array('2')) AS fields UNION ALL SELECT 'f2', map('a', array('3'))")
    inv = inventory.field_inventory(df, "f")
    assert [r.field for r in inventory.distinct_fields(inv).collect()] == ["a", "b"]
    assert [r.f for r in inventory.holding(inv, "f", "b").collect()] == ["f1"]
    mapped = spark.createDataFrame([("a",), ("z",)], "field string")
    assert [r.field for r in inventory.unmapped(inv, mapped).collect()] == ["b"]
    assert [r.field for r in inventory.imaginary(inv, mapped).collect()] == ["z"]
    assert inventory.unmapped(inv, mapped, spark.createDataFrame([("b",)], "field string")).count() == 0


def test_json_ld(spark):
    def page(script):
        return f"<html><body>{script}</body></html>"

    rows = [
        ("u1", 200, "text/html; charset=utf-8", page('<script type="application/ld+json">{"name":"a\nb","thumbnailUrl":"t1"}</script><script type="application/ld+json">{"thumbnailUrl":"t2"}</script>')),
        ("u2", 200, "text/html", page('<script type="application/ld+json">{"thumbnailUrl":</script>')),
        ("u3", 200, "application/pdf", page('<script type="application/ld+json">{"thumbnailUrl":"t3"}</script>')),
        ("u4", 200, "text/html", page("<p/>")),
        ("u5", 200, "text/html", page('<script type="application/ld+json">{"name":"none"}</script>')),
    ]
    pages = spark.createDataFrame(rows, "url string, status int, content_type string, body string")
    records = pages.select(F.col("url").alias("Record URL"), F.lit(1).alias("n"))
    assert [tuple(r) for r in add_thumbnails(records, pages, "Record URL").collect()] == [("u1", 1, "t1")]


def test_incremental(spark):
    df = spark.sql("SELECT 'c' AS collection_id, date'2024-01-01' + cast(id AS int) AS datestamp, id FROM range(5)")
    spec = CollectionSpec("c", "oai_xml")
    assert incremental.changed_since(df, F.col("datestamp"), spec, "2024-01-03 23:00:00").count() == 3
    assert incremental.changed_since(df, F.col("datestamp"), spec, None).count() == 5
    assert incremental.changed_since(df, F.col("datestamp"), CollectionSpec("c", "oai_xml", full_harvest=True), "2024-01-03").count() == 5
    state = spark.sql("SELECT 'c' AS collection_id, timestamp'2024-01-04 10:00:00' AS last_start, false AS full_harvest")
    assert incremental.changed_since_state(df, state).count() == 2


def test_stream_keeps_the_newest_version(spark, tmp_path):
    landed, schema = tmp_path / "landed", "id string, seq int, v string"
    run = lambda: incremental.stream_upsert(
        spark.readStream.schema(schema).json(str(landed)), str(tmp_path / "log"), str(tmp_path / "cp"), ["id"], ["seq"]
    )
    landed.mkdir()
    (landed / "1.json").write_text('{"id":"a","seq":2,"v":"late"}\n{"id":"a","seq":1,"v":"first"}\n{"id":"b","seq":3,"v":"b1"}\n')
    run()
    (landed / "2.json").write_text('{"id":"a","seq":9,"v":"newer"}\n{"id":"c","seq":9,"v":"c1"}\n')
    run()
    run()
    got = {(r.id, r.v) for r in incremental.current_records(spark, str(tmp_path / "log"), ["id"]).collect()}
    assert got == {("a", "newer"), ("b", "b1"), ("c", "c1")}


def test_sample_tiers_are_an_argument(spark):
    df = spark.range(30).selectExpr("'c' as collection_id", "cast(id as string) as id", "concat('https://x.example.org/', id) as url")
    assert [links.thumbnail_sample(df, tiers).count() for tiers in ([(20, 3)], [(40, 3)], [(10, 5), (25, 7)])] == [3, 30, 7]
    with pytest.raises(ValueError):
        links.thumbnail_sample(df, [])
