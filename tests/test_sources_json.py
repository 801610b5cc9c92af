import json
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sheaf.functions import jsonpath
from sheaf.operators.joins import listing_thumbnails
from sheaf.operators.records import missing_fields, wide
from sheaf.sources.json_pages import json_records
from sheaf.sources.manifests import manifest_records, manifest_records_v3, manifest_urls, unknown_listings
from sheaf.sources.payloads import failed_pages
from sheaf.spec import CollectionSpec, FieldSpec


def spec(driver="iiif_json", selector=None, **fields):
    return CollectionSpec("c", driver, {k: v if isinstance(v, FieldSpec) else FieldSpec(v) for k, v in fields.items()}, selector)


def fields_of(df):
    return [r.fields for r in df.orderBy("seq", "pos").collect()]


def find(spark, doc, path):
    df = spark.createDataFrame([(json.dumps(doc),)], "body string")
    return df.select(jsonpath.find_texts(F.try_parse_json("body"), path, F.col("body")).alias("v")).first().v


@pytest.mark.parametrize(
    "doc, path, expected",
    [
        ({"a": {"b": "x"}}, "a.b", ["x"]),
        ({"a": {"b": "x"}}, "$.a.b", ["x"]),
        ({"@id": "u"}, "@id", ["u"]),
        ({"a b": {"c-d": 1}}, "'a b'.c-d", ["1"]),
        ({"a": [{"b": 1}, {"b": 2}, {"c": 3}]}, "a[*].b", ["1", "2"]),
        ({"a": [" x ", 2, ["y"]]}, "a", ["x", "2", "y"]),
        ({"a": " x "}, "a", [" x "]),
        ({"a": None}, "a", []),
        ({"a": []}, "a", []),
        ({"a": "[bracketed]"}, "a", ["[bracketed]"]),
        ({"a": {"x": 1}}, "a", ['{"x":1}']),
        ({"a": {"x": 1}}, "a[*].x", ["1"]),
        ({"a": "s"}, "a[*]", ["s"]),
        ({"it's": 1}, """["it's"]""", ["1"]),
        ({"a": {"z": 1, "b": [2, 3]}}, "a.*", ["1", "2", "3"]),
        ({"a": [{"z": 1}]}, "a.*", []),
        ({"s": [{"c": [{"f": "jpg"}]}, {"f": "png"}]}, "s..f", ["jpg", "png"]),
        ({"line": {"part": {"key": 2, "sup": [{"key": 3}]}, "key": 1}}, "line..key", ["1", "2", "3"]),
        ({"t": {"@id": "u"}}, "t..@id", ["u"]),
        ({"s": [{"i": [{"r": {"@id": "u"}}]}]}, "s..r.@id", ["u"]),
        ({}, "a..b", []),
        ({"a": {"é": {"q\"r": "v"}}}, "a..é", ['{"q\\"r":"v"}']),
        ({"a": [{"b": {"b": 1}}]}, "a..b", ['{"b":1}', "1"]),
    ],
)
def test_paths(spark, doc, path, expected):
    assert find(spark, doc, path) == expected


def test_bad_path_is_an_error():
    for path in ("a[?(@.b)]", "", "a.."):
        with pytest.raises(ValueError):
            jsonpath.parse_path(path)


def test_json_pages(payloads):
    pages = payloads(
        '{"content":{"results":[{"id":1,"t":["a "," b"]},[{"id":2,"t":"c"}]]}}',
        ("gone", 404, None),
        ('{"content":{"results":[{"id":3}]}}', 200, None),
        "not json",
    )
    s = spec("custom_json", "content.results", id="id", title="t")
    assert fields_of(json_records(pages, s)) == [{"id": ["1"], "title": ["a", "b"]}, {"id": ["2"], "title": ["c"]}, {"id": ["3"]}]
    assert [(r.seq, r.status) for r in failed_pages(pages).collect()] == [(1, 404)]


def test_single_object_selector(payloads):
    pages = payloads('{"message":"ok","data":{"id":116787,"title":"A"}}', '{"message":"ok","data":{"id":60732,"title":"B"}}')
    s = spec("custom_json", "data", id="id", title="title")
    assert [f["title"] for f in fields_of(json_records(pages, s))] == [["A"], ["B"]]


def test_json_record_pairs(payloads):
    record = {
        "id": "7",
        "metadata": [
            {"label": "Call Number (Old)", "value": "A/1"},
            {"label": "Title", "value": [{"@value": "one"}, {"@value": "two"}]},
            {"label": "title", "value": ["p", ["q"]]},
            {"label": "Empty", "value": ""},
            {"label": "None", "value": None},
        ],
    }
    s = spec("custom_json", "items", id="id", metadata="metadata[*]")
    (out,) = fields_of(json_records(payloads(json.dumps({"items": [record]})), s))
    assert len(out.pop("metadata")) == 5
    assert out == {"id": ["7"], "call-number-old": ["A/1"], "title": ["one", "p", "q"]}


def test_listing_versions(payloads):
    listings = payloads('{"manifests":[{"@id":"u1"},{"id":"u2"}]}', '{"items":[{"id":"u3"}]}', '{"other":[]}')
    got = manifest_urls(listings, ["x", "y", "x"]).orderBy("seq", "pos").collect()
    assert [r.url for r in got] == ["x", "y", "u1", "u2", "u3"]
    assert [r.seq for r in unknown_listings(listings).collect()] == [2]
    with pytest.raises(PySparkException, match="unknown listing form"):
        manifest_urls(listings, strict=True).collect()


def test_manifest_of_a_tide_gauge(payloads):
    """A record sheet of measurements: tagged, plain, repeated and empty entries, and paths of any depth."""
    sheet = {
        "@id": "https://gauges.example.net/sheet/88",
        "attribution": ["  Harbour office", "Copy 2  "],
        "metadata": [
            {"label": "Depth / m", "value": ["3.2", "2.9"]},
            {"label": "Observer", "value": [{"@language": "nl", "@value": "wacht"}, {"@value": "watch"}]},
            {"label": "Depth / m", "value": "4.0"},
            {"label": "Wind", "value": {"@language": "nl", "@value": "west"}},
            {"label": "Remark", "value": None},
        ],
        "rolls": [{"parts": [{"scan": {"kind": "tiff"}}, {"scan": {"kind": "png"}}]}, {"scan": {"kind": "tiff"}}],
    }
    s = spec(
        sheet="@id", office="attribution", kinds="rolls..kind", first_kind="rolls[0].parts[1].scan.kind",
        sealed=FieldSpec("rolls..seal", optional=True), stamp="stamps..@id",
    )
    records = manifest_records(payloads(json.dumps(sheet), ("", 500, None), "{}"), s)
    assert fields_of(records) == [
        {
            "sheet": ["https://gauges.example.net/sheet/88"],
            "office": ["Harbour office", "Copy 2"],
            "kinds": ["tiff", "png", "tiff"],
            "first_kind": ["png"],
            "depth--m": ["3.2", "2.9", "4.0"],
            "observer_nl": ["wacht"],
            "observer": ["watch"],
            "wind_nl": ["west"],
        }
    ]
    audit = {(r.field, r.required) for r in missing_fields(records, s, ["seq"]).collect()}
    assert audit == {("sealed", False), ("stamp", True)}
    row = wide(records, ["sheet", "kinds", "sealed"], ["seq"]).first()
    assert (row.sheet, row.kinds, row.sealed) == ("https://gauges.example.net/sheet/88", '["tiff","png","tiff"]', None)


def test_manifest_pairs_win_over_declared_fields(payloads):
    manifest = {"@id": "u", "title": "declared", "metadata": [{"label": "Title", "value": "pair"}]}
    assert fields_of(manifest_records(payloads(json.dumps(manifest)), spec(id="@id", title="title"))) == [{"id": ["u"], "title": ["pair"]}]


def test_version_3(payloads):
    listing = {"items": [{"id": "https://x.example.org/1", "thumbnail": [{"id": "thumb1"}]}, {"id": "https://x.example.org/0"}]}
    manifests = payloads(
        (json.dumps({"id": " i0 ", "metadata": [{"label": {"en": ["Date"]}, "value": {"en": ["1998"]}}]}), 200, "https://x.example.org/0"),
        (
            json.dumps(
                {
                    "id": "i1",
                    "metadata": [
                        {"label": {"en": ["Author (s)"], "ar": ["x"]}, "value": {"ar": ["B"], "en": ["A"]}},
                        {"label": {"en": ["author s"]}, "value": {"en": ["C"]}},
                        {"label": {"en": ["Lost"]}, "value": {"none": ["C"]}},
                        {"label": {"en": ["Empty"]}},
                    ],
                }
            ),
            200,
            "https://x.example.org/1",
        ),
    )
    got = {r.url[-1]: r.fields for r in manifest_records_v3(payloads(json.dumps(listing)), manifests, spec(id="id")).collect()}
    assert got["1"] == {"id": ["i1"], "author-s": ["A", "B", "C"], "thumbnail": ["thumb1"]}
    assert got["0"] == {"id": ["i0"], "date": ["1998"]}


def test_listing_thumbnails(payloads):
    listing = payloads('{"items":[{"id":"u1"},{"@id":"u2"}]}')
    docs = payloads(('{"items":[{"thumbnail":[{"id":"t1"}]}]}', 200, "u1"), ('{"label":"no items"}', 200, "u2"))
    assert {(r.id, r.thumbnail) for r in listing_thumbnails(listing, docs).collect()} == {("u1", "t1"), ("u2", None)}


def test_paths_equal_a_plain_walk(spark):
    """Compiled paths against a walk in Python, on random documents."""
    rng = random.Random(7)

    def value(depth):
        kind = rng.random()
        if depth == 0 or kind < 0.35:
            return rng.choice([1, "x", " y ", True, 2.5, "", None])
        if kind < 0.65:
            return [value(depth - 1) for _ in range(rng.randint(0, 3))]
        return {k: value(depth - 1) for k in rng.sample("abc", rng.randint(0, 3))}

    docs = [{"a": value(4), "b": value(3)} for _ in range(200)]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "i int, body string")
    for path in ("a.b", "a[0]", "a[*].b", "a[*][1].c", "b[*].a[*]", "a..b", "a..b[0]", "a..c.a", "a.*", "b[*].*"):
        nodes = jsonpath.find_nodes(F.try_parse_json("body"), path, F.col("body"))
        got = {r.i: [json.loads(x) for x in r.v] for r in df.select("i", F.transform(nodes, lambda n: F.to_json(n)).alias("v")).collect()}
        steps = jsonpath.parse_path(path)
        for i, doc in enumerate(docs):
            found = [m for m in plain_walk(doc, steps) if m is not None]
            assert [normal(m) for m in got[i] if m is not None] == [normal(m) for m in found], (path, doc)


def plain_walk(node, steps):
    """Matches below a node, which comes before what lies under it."""
    if not steps:
        yield node
        return
    (what, arg), rest = steps[0], steps[1:]
    children = list(node.values()) if isinstance(node, dict) else node if isinstance(node, list) else []
    if what == "deep":
        yield from plain_walk(node, rest)
        for child in children:
            yield from plain_walk(child, steps)
    elif what == "all":
        for child in node if isinstance(node, list) else [node]:
            yield from plain_walk(child, rest)
    elif what == "members":
        for child in children if isinstance(node, dict) else []:
            yield from plain_walk(child, rest)
    elif what == "index" and isinstance(node, list) and arg < len(node):
        yield from plain_walk(node[arg], rest)
    elif what == "name" and isinstance(node, dict) and arg in node:
        yield from plain_walk(node[arg], rest)


def normal(m):
    return json.dumps(m, sort_keys=True)
