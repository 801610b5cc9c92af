"""Inputs that sources do send: deep lists, long numbers, comments, CDATA, nested elements, unions, odd addresses."""

import pytest
from pyspark.sql import functions as F
from sheaf.functions import jsonpath, xmlpath
from sheaf.functions.text import is_url
from sheaf.sources.oai import oai_headers


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("body", "path", "expected"),
    [
        ('{"a":[["x",["y",["z",["w",["v",[]]]]]]]}', "a", ["x", "y", "z", "w", "v"]),
        ('{"a":["[[[", ["b"]]}', "a", ["[[[", "b"]),
        ('{"s":[{"k":12345678901234567890.123},{"k":0.1234567890123456789}]}', "s..k", ["12345678901234567890.123", "0.1234567890123456789"]),
        ('{"x":{"a\\/b":1}}', "x..'a/b'", ["1"]),
        ('{"x":{"k":1e999}, "y":{"k":2}}', "y..k", ["2"]),
        ('{"a":{"b":"x"}} {"c":1}', "a..b", ["x"]),  # text after the end
        ('{"a":{"b":"x"}} }]', "a..b", ["x"]),
        ('{"z":{"k":1},"a":{"k":2},"m":[{"k":3},{"k":4}]}', "$..k", ["1", "2", "3", "4"]),  # in the order of the text
        ('{"z":{"k":1},"k":2}', "$..k", ["2", "1"]),  # an object before what lies under it
        (r'{"a\\":{"k\"":1},"b":{"k\"":"\\\\\""}}', """$..'k"'""", ["1", '\\\\"']),
        (r'{"s":{"t":"\"k\":{","k":"{\"k\":1}"}}', "$..k", ['{"k":1}']),
        ('{"o":{"b":{"12345678x":[{"y" : "00000001y"}]}}}', "$..b", ['{"12345678x":[{"y":"00000001y"}]}']),
        ('{"x":{"\ue000\ue001":{"k":"\ue000"}}}', "$..k", ["\ue000"]),
        ('{"s":[{"k":[1,2]},{"k":[[3]]}]}', "s..k[0]", ["1", "3"]),
        ('{"z":{"b":1,"a":2},"c":[0]}', "$.*", ['{"a":2,"b":1}', "0"]),
    ],
)
def test_json_values(spark, body, path, expected):
    doc = F.try_parse_json("body")
    assert one(spark, jsonpath.find_texts(doc, path, F.col("body")), body=body) == expected


@pytest.mark.parametrize(
    ("body", "path", "expected"),
    [
        ("<r><alpha>1</alpha></r>", "//alpha|//beta", ["1"]),
        ("<r><alpha>1</alpha><beta>2</beta></r>", "//alpha | //beta", ["1", "2"]),
        ("<r><a t='x|y'>1</a></r>", "//a[@t='x|y']", ["1"]),
    ],
)
def test_unions(spark, body, path, expected):
    assert one(spark, xmlpath.find_values(F.col("body"), path), body=body) == expected


@pytest.mark.parametrize(
    ("body", "expected"),
    [
        ("<r><item>1</item><item a='b'/></r>", ["<item>1</item>", "<item a='b'/>"]),
        ("<r><!-- <item>0</item> --><item>1</item></r>", ["<item>1</item>"]),
        ("<r><item><![CDATA[a </item> & b]]></item></r>", ["<item>a &lt;/item&gt; &amp; b</item>"]),
        ("<r><item>1<item>2</item><item/></item><x:item>3</x:item></r>", ["<item>1<item>2</item><item/></item>", "<item>2</item>", "<item/>", "<x:item>3</x:item>"]),
        ("<r><items>1</items></r>", []),
    ],
)
def test_records_of_a_page(spark, body, expected):
    assert one(spark, xmlpath.split_elements(F.col("body"), ".//item"), body=body) == expected


def test_oai_page_with_comment_and_cdata(spark, payloads):
    body = (
        "<OAI><ListRecords><!-- <record><header><identifier>old</identifier></header></record> -->"
        "<record><header><identifier>live</identifier></header><metadata><dc><t><![CDATA[</metadata></record>]]></t></dc></metadata></record>"
        "</ListRecords></OAI>"
    )
    rows = oai_headers(payloads(body)).collect()
    assert [r.identifier for r in rows] == ["live"] and rows[0].record.endswith("&lt;/record&gt;</t></dc></metadata></record>")


@pytest.mark.parametrize(
    ("url", "valid"),
    [
        ("http://999.999.1.1/a", False),
        ("http://255.0.1.1/a", True),
        ("http://[::::]/x", False),
        ("http://[2001:db8::1]:80/x", True),
        ("http://[1:2:3:4:5:6:7:8]/", True),
        ("http://[1:2:3:4:5:6:7:8:9]/", False),
        ("http://[::ffff:10.0.0.1]/", True),
        ("http://a.example:99999/", False),
        ("http://a.example:65535/", True),
        ("https://bücher.example/a", True),
        ("mailto:a@b.example", False),
    ],
)
def test_addresses(spark, url, valid):
    assert one(spark, is_url(F.col("u")), u=url) is valid


def test_collections_read_their_own_partitions(spark):
    from sheaf.plans.extract_queries import MANY, many_payloads
    from sheaf.plans.harvest import harvest_many

    table = harvest_many(many_payloads(spark, "/root/testdata/sf0.001"), MANY, ["title"])
    plan = table._jdf.queryExecution().executedPlan().toString()
    for spec in MANY:
        assert "(collection_id#" in plan and f" = {spec.collection_id})" in plan.split("PartitionFilters", 1)[1]


def test_declared_types_of_a_table(spark, tmp_path):
    from sheaf.sources.registry import read_table
    from sheaf.spec import CollectionSpec

    (tmp_path / "a.csv").write_text("n,x,t\n007,1.5,007\n")
    args = {"urlpath": str(tmp_path / "a.csv"), "csv_kwargs": {"dtype": {"n": "int64", "x": "float64", "t": "object"}}}
    row = read_table(spark, CollectionSpec.from_dict("c", {"driver": "csv", "args": args})).first()
    assert (row.n, row.x, row.t) == (7, 1.5, "007")
    with pytest.raises(ValueError):
        read_table(spark, CollectionSpec.from_dict("c", {"driver": "csv", "args": {**args, "csv_kwargs": {"dtype": {"n": "complex"}}}}))


def test_vanished_collection_is_reported(spark):
    from sheaf.operators.snapshots import decide_load

    now, before = (spark.createDataFrame(rows, "c string, v int") for rows in ([("a", 1), ("b", 1)], [("a", 1), ("b", 2), ("z", 1)]))
    assert {tuple(r) for r in decide_load(now, before, "c", ["v"]).collect()} == {("a", 1, "skip"), ("b", 1, "load"), ("z", 0, "gone")}


def test_descent_stays_in_the_jvm(spark):
    """No Python in the plan, and a member that lies deep or under thousands of brackets is found."""
    depth, wide = 400, 3000
    rows = [("[" * depth + '{"k":1}' + "]" * depth,), ('{"l":[' + ",".join('{"x":[]}' for _ in range(wide)) + ',{"k":2}]}',)]
    out = spark.createDataFrame(rows, "body string").select(jsonpath.find_texts(F.try_parse_json("body"), "$..k", F.col("body")).alias("x"))
    assert [r.x for r in out.collect()] == [["1"], ["2"]]
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()


def test_two_descents_in_a_row_are_an_error():
    with pytest.raises(ValueError):
        jsonpath.parse_path("a....b")


def test_fields_share_one_reading(spark):
    paths = {"a": "x..k", "b": "y..k", "it's": "plain", "none": "q..k"}
    body = '{"x":{"m":{"k":1},"c":{"k":2}},"y":[{"k":3}],"plain":" p "}'
    found = spark.createDataFrame([(body,)], "body string").select(jsonpath.find_fields(F.try_parse_json("body"), paths, F.col("body")).alias("f")).first().f
    assert found == {"a": ["1", "2"], "b": ["3"], "it's": [" p "]}
