import pytest
from pyspark.sql import functions as F

from sheaf.functions import xmlpath
from sheaf.functions.text import markup_to_text, sanitize, strip
from sheaf.sources import marc, oai
from sheaf.sources.registry import read_records
from sheaf.sources.tabular import scan_csv
from sheaf.sources.xml_pages import scan_xml_files, xml_page_records, xml_records
from sheaf.spec import CollectionSpec, FieldSpec

DC = {"dc": "u"}


def spec(driver="xml", selector=None, prefix=None, **fields):
    paths = {k: v if isinstance(v, FieldSpec) else FieldSpec(v) for k, v in fields.items()}
    return CollectionSpec("c", driver, paths, selector, prefix)


def fields_of(df):
    return [r.fields for r in df.orderBy("seq", "pos").collect()]


def values(spark, xml, path, ns=None):
    df = spark.createDataFrame([(xml,)], "x string")
    return df.select(xmlpath.find_values(F.col("x"), path, ns).alias("v")).first().v


def test_paths(spark):
    xml = (
        '<r xmlns:dc="u"><dc:t xml:lang="en">a</dc:t><t type="x">b<i>c</i>d</t><t/><t><i>e</i>f</t><k><![CDATA[<p>q</p>]]></k>'
        '<l><u access="preview" url="p1"/><u access="raw" url="p2"/></l><rel><dc:t>z</dc:t></rel></r>'
    )
    assert values(spark, xml, "//dc:t", DC) == ["a", "b", "z"]
    assert values(spark, xml, ".//u[@access='preview']/@url") == ["p1"]
    assert values(spark, xml, "//dc:t[not(ancestor::rel)]", DC) == ["a", "b"]
    assert values(spark, xml, "//t[@xml:lang='en']") == ["a"]
    assert values(spark, xml, "//t[@type = 'x']") == ["b"]
    assert values(spark, xml, "/r/k") == ["<p>q</p>"]
    assert values(spark, xml, "//rel/*[local-name()='t']/text()") == ["z"]
    assert values(spark, xml, "//none") == []


SCANNED = [
    "<r><t>a</t><x><t k='v>w' j=\"y\">b &amp; c &#233;&#x41;</t></x><t/><t a='1'/><t  >d</t><tt>no</tt><p:t xmlns:p='u'>e</p:t></r>",
    "<r><t><i>x</i>tail</t><t>head<i>y</i>tail</t><t> </t><t></t><t>l1\r\nl2\rl3</t></r>",
    "<r><!-- <t>no</t> --><t>a</t></r>",
    "<r><d><![CDATA[<t>no</t>]]></d><t>b<![CDATA[c]]></t></r>",
    "<t>root<t>inner</t></t>",
    '<?xml version="1.0"?>\n<t>root<x><t>inner</t></x></t>',
    "<r><a t='1'>&lt;t&gt;no&lt;/t&gt;</a></r>",
    "<r><x/></r>",
]


@pytest.mark.parametrize("path", ["//t", ".//t", "//p:t"])
def test_scanned_text_equals_the_tree(spark, path):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(SCANNED)], "i int, x string")
    both = df.select(
        "i", xmlpath.find_values(F.col("x"), path).alias("scan"), F.xpath("x", F.lit(xmlpath.value_path(path))).alias("tree")
    )
    for r in both.orderBy("i").collect():
        assert r.scan == r.tree, SCANNED[r.i]


def test_undeclared_prefix_is_an_error():
    with pytest.raises(ValueError):
        xmlpath.local_path("//dc:t", {"mods": "v"})


def test_well_formed(spark):
    df = spark.createDataFrame([("<r/>",), ("<r><a></r>",), ("",), ("text",), (None,)], "x string")
    assert [r[0] for r in df.select(xmlpath.well_formed(F.col("x"))).collect()] == [True, False, False, False, False]


def test_records_keep_value_order(payloads):
    pages = payloads(
        "<set><record><id>1</id><name>a</name><name>b</name></record><record><id>2</id><name>c</name></record></set>",
        ("<set><record><id>x</id></record></set>", 500, None),
    )
    s = spec(selector=".//record", id="./id", names="name")
    assert fields_of(read_records(pages, s)) == [{"id": ["1"], "names": ["a", "b"]}, {"id": ["2"], "names": ["c"]}]


def test_elements_are_found_by_local_name(spark):
    df = spark.createDataFrame([('<a xmlns:m="u"><m:mods x="1"><m:t>1</m:t></m:mods><m:modsCollection/><mods/></a>',)], "x string")
    found = df.select(xmlpath.split_elements(F.col("x"), "//mods:mods").alias("v")).first().v
    assert found == ['<m:mods x="1"><m:t>1</m:t></m:mods>', "<mods/>"]


def test_broken_record_is_dropped(payloads):
    pages = payloads("<s><record><id>1</id></record><record><id>2</record></s>")
    assert fields_of(xml_records(pages, spec(selector="//record", id="//id"))) == [{"id": ["1"]}]


def test_linked_pages(payloads):
    pages = payloads(('<?xml version="1.0"?><TEI><title>A</title></TEI>\n<!-- x -->', 200, "u?a=1&b=$2"), ("<TEI>", 200, "u2"))
    s = spec(title="//title", harvest_url="/TEI/harvest_url")
    assert fields_of(xml_page_records(pages, s)) == [{"title": ["A"], "harvest_url": ["u?a=1&b=$2"]}]


def test_xml_file_scan(spark, tmp_path):
    text = "<rss>\n" + "\n".join(f'<item n="{i}">\n<guid>{i}</guid></item>' for i in range(500)) + "\n</rss>"
    (tmp_path / "feed.xml").write_text(text)
    records = scan_xml_files(spark, str(tmp_path), "item")
    ids = records.select(F.regexp_extract("record", r"<guid>(\d+)", 1).cast("int").alias("i"))
    assert sorted(r.i for r in ids.collect()) == list(range(500))


def test_text_helpers(spark):
    df = spark.createDataFrame([(" \n a\nb\r\n\tc 　",)], "x string")
    row = df.select(strip(F.col("x")).alias("a"), sanitize(F.col("x")).alias("b")).first()
    assert (row.a, row.b) == ("a\nb\r\n\tc", "a b \tc")
    raw = "&eacute;&amp;lt;&#233;&#x1F600;&bogus;x<b>q</b><!-- z --><script>a<b</script>&lt;i&gt;5 < 6"
    df = spark.createDataFrame([(raw,), ("plain",)], "x string")
    assert [r[0] for r in df.select(markup_to_text(F.col("x"))).collect()] == ["é&lt;é😀&bogus;xq<i>5 < 6", "plain"]


OAI = """<?xml version="1.0"?><OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/"><ListRecords>
<record><header><identifier>i1</identifier><datestamp>2024-01-02</datestamp></header>
<metadata>%s</metadata></record>
<record><header status="deleted"><identifier>i2</identifier></header></record>
<record><header><identifier>i3</identifier></header><metadata>%s</metadata><about><x/></about></record>
</ListRecords></OAI-PMH>"""

DC_RECORD = (
    '<oai_dc:dc xmlns:oai_dc="o" xmlns:dc="d"><dc:title> One </dc:title><dc:subject>s1</dc:subject><dc:subject>s2</dc:subject>'
    "<dc:empty/><dc:n><dc:p>first</dc:p><dc:p>last</dc:p><dc:r>role</dc:r></dc:n></oai_dc:dc>"
)


def test_oai_dublin_core(payloads):
    pages = payloads(OAI % (DC_RECORD, "<dc><title>T</title></dc>"))
    s = spec("oai_xml", prefix="oai_dc", ident="//header/identifier")
    out = read_records(pages, s).orderBy("pos").collect()
    assert [r.identifier for r in out] == ["i1", "i3"]
    assert out[0].fields == {"ident": ["i1"], "title": ["One"], "subject": ["s1", "s2"], "n_p": ["last"]}
    assert out[1].fields == {"ident": ["i3"], "title": ["T"]}
    assert out[0].datestamp == "2024-01-02"


def test_oai_marc_keys(payloads):
    record = (
        '<record xmlns="http://www.loc.gov/MARC21/slim"><leader>00</leader><controlfield tag="008">0080</controlfield>'
        '<datafield tag="650"><subfield code="a">x</subfield><subfield code="b">y</subfield></datafield>'
        '<datafield tag="650"><subfield code="a">z</subfield></datafield></record>'
    )
    pages = payloads(OAI % (record, record))
    expected = {"leader": ["00"], "008": ["0080"], "650_a": ["x", "z"]}
    assert [r.fields for r in oai.oai_records(pages, spec("oai_xml", prefix="marc21")).collect()] == [expected] * 2
    every = oai.oai_records(pages, spec("oai_xml", prefix="oai_marc21"), all_leaves=True).first()
    assert every.fields == {**expected, "650_b": ["y"]}


def test_oai_get_record_and_empty(payloads):
    pages = payloads(OAI % (DC_RECORD, DC_RECORD))
    assert [r.identifier for r in oai.get_record(pages, "i3").collect()] == ["i3"]
    assert oai.get_record(pages, "i2").count() == 0
    none = oai.oai_records(payloads('<OAI-PMH><error code="noRecordsMatch"/></OAI-PMH>'), spec("oai_xml", prefix="mods"))
    assert none.count() == 0 and "fields" in none.columns


def test_unknown_prefix(payloads):
    with pytest.raises(ValueError, match="unknown metadata prefix"):
        oai.oai_records(payloads("<x/>"), spec("oai_xml", prefix="ese"))


MARC = (
    '<collection xmlns="http://www.loc.gov/MARC21/slim"><record><leader>00000cam</leader><controlfield tag="001">000123</controlfield>'
    '\n  <controlfield tag="006">m        d        </controlfield>'
    '<controlfield tag="008">0080</controlfield> <datafield tag="245" ind1="1" ind2="0"><subfield code="a">T1</subfield>'
    '<subfield code="a">T2</subfield><subfield code="c"></subfield></datafield>'
    '<datafield tag="974" ind1=" " ind2=" "><subfield code="u">v1</subfield><subfield code="z">only first</subfield></datafield>'
    '<datafield tag="974" ind1=" " ind2=" "><subfield code="u">v2</subfield></datafield></record></collection>'
)


def test_marc(payloads, spark):
    pages = payloads((MARC, 200, "123"), (MARC, 200, "999"))
    row = marc.marc_records(pages).first()
    assert row.leader == "00000cam"
    assert row.fields == {"001": ["000123"], "006": ["m        d        "], "008": ["0080"], "245_a": ["T1", "T2"], "974_u": ["v2"], "974_z": ["only first"]}
    joined = marc.marc_records(pages, keep="append").first().fields
    assert joined["974_u"] == ["v1", "v2"]
    index = spark.createDataFrame([("123",), ("123",)], "url string")
    assert [r.url for r in marc.marc_records(pages, index).collect()] == ["123"]


def test_marc_index(spark, tmp_path):
    (tmp_path / "c.txt").write_text("title\tht_bib_key\nA\t5245329\nB\t2583088\n")
    index = marc.scan_index(spark, str(tmp_path / "c.txt"), "ht_bib_key", "https://x.example.org/{id}.xml").orderBy("record_id")
    assert [tuple(r) for r in index.collect()] == [(i, f"https://x.example.org/{i}.xml") for i in ("2583088", "5245329")]
    assert scan_csv(spark, str(tmp_path / "c.txt"), sep="\t").count() == 2
