"""One pass over a record's tags, against Spark's own xpath and against an expat walk."""

import random
from xml.parsers import expat
from xml.sax.saxutils import escape, quoteattr

import pytest
from pyspark.sql import functions as F
from sheaf.functions import xmlpath, xmltree

PATHS = [
    ".//a", "./a", "a", "/r/a", "//a", "//a/b", ".//a//b", "//x:b", "a/b/c", "//*/b", "//a[2]", "./a[1]", ".//b[3]", "//a[@k='v']", "//a[@x:l='v']/@k",
    ".//a[@k]", "//c/@k", "//b[not(ancestor::a)]", "//b[ancestor::c]", "//b[@k='v'][1]", "/r", "/r/@k", "//r", "a | b", "//a/text()", "a[b]/c", "//a/b[last()]",
]


def record(rnd, depth=3):
    def element(name, left):
        attributes = "".join(f" {k}={quoteattr(rnd.choice(['v', 'w', 'a>b', '&', 'é']))}" for k in ("k", "x:l") if rnd.random() < 0.3)
        if rnd.random() < 0.15:
            return f"<{name}{attributes}/>"
        inner = rnd.choice(["", "", " ", "t", "a & b", "\r\n x ", "é<", "1 > 0"])
        body = escape(inner) + ("&#233;" if rnd.random() < 0.1 else "")
        for _ in range(rnd.randint(0, 4) if left else 0):
            body += element(rnd.choice(["a", "b", "c", "x:b", "ab"]), left - 1) + rnd.choice(["", "", "\n", "tail"])
        return f"<{name}{attributes}{rnd.choice(['', ' '])}>{body}</{name}>"

    return element("r", depth)


def test_fields_equal_xpath(spark):
    rnd = random.Random(3)
    rows = [(i, record(rnd)) for i in range(150)] + [(900, "<r/>"), (901, "<r>x</r>"), (902, "<r><!-- <a>n</a> --><a>1</a></r>"), (903, "<r><a><![CDATA[<b>]]></a></r>")]
    df = spark.createDataFrame(rows, "i int, x string")
    found = xmltree.find_fields(F.col("x"), {p: (p, None) for p in PATHS})
    tree = [F.xpath("x", F.lit(xmlpath.value_path(p))).alias(f"t{k}") for k, p in enumerate(PATHS)]
    seen = set()
    for r in df.select("i", "x", found.alias("found"), *tree).collect():
        for k, p in enumerate(PATHS):
            assert r.found.get(p, []) == r[f"t{k}"], (p, r.x)
            seen.update([p] if r[f"t{k}"] else [])
    assert seen >= set(PATHS) - {"a[b]/c"}


def test_few_names_are_searched(spark):
    rnd = random.Random(5)
    df = spark.createDataFrame([(i, record(rnd)) for i in range(80)], "i int, x string")
    paths = ["//a", "//ab", "//x:b", "//r"]
    assert all(xmltree._scanned("x", xmltree.compiled(p)) for p in paths) and not xmltree._scanned("x", xmltree.compiled("//a/b"))
    tree = [F.xpath("x", F.lit(xmlpath.value_path(p))).alias(f"t{k}") for k, p in enumerate(paths)]
    for r in df.select("x", xmltree.find_fields(F.col("x"), {p: (p, None) for p in paths}).alias("found"), *tree).collect():
        assert [r.found.get(p, []) for p in paths] == [r[f"t{k}"] for k in range(4)], r.x


def test_common_paths_need_no_tree():
    through_xpath = [p for p in PATHS if not xmltree.compiled(p)]
    assert through_xpath == ["a | b", "//a/text()", "a[b]/c", "//a/b[last()]"]
    with pytest.raises(ValueError):
        xmltree.compiled("//q:a", {"dc": "http://purl.org/dc/elements/1.1/"})


def plain_pairs(body, root, marc, all_leaves):
    pairs, names, leaves, text, state = [], [], {}, [], {"inside": False, "done": False, "leaf": False}

    def start(tag, attributes):
        name = tag.rpartition(":")[2]
        if state["done"] or not state["inside"]:
            state["inside"] = state["inside"] or name == root
            return
        if marc and name in ("controlfield", "datafield", "subfield"):
            name = attributes.get("code" if name == "subfield" else "tag", name)
        names.append(name)
        text.clear()
        state["leaf"] = True

    def end(_):
        if state["done"] or not state["inside"]:
            return
        if not names:
            state["done"] = True
            return
        if state["leaf"] and "".join(text):
            leaves["_".join(names)] = "".join(text)
        state["leaf"] = False
        names.pop()
        if not names:
            pairs.extend([(k, [v.strip()]) for k, v in leaves.items()][: None if all_leaves else 1])
            leaves.clear()

    parser = expat.ParserCreate()
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, text.append
    parser.Parse(body, True)
    return pairs


@pytest.mark.parametrize("all_leaves", [False, True])
@pytest.mark.parametrize("root", ["r", "a", "q"])
def test_leaf_pairs_equal_a_walk(spark, root, all_leaves):
    rnd = random.Random(8)
    rows = [(i, record(rnd, 4)) for i in range(120)]
    out = spark.createDataFrame(rows, "i int, x string").select("x", xmltree.leaf_pairs(F.col("x"), root, all_leaves=all_leaves).alias("p"))
    for r in out.collect():
        assert [(p.field, list(p["values"])) for p in r.p] == plain_pairs(r.x, root, False, all_leaves), r.x


def test_marc_names(spark):
    body = (
        '<m:record xmlns:m="u"><m:leader>l</m:leader><m:controlfield tag="001">1</m:controlfield><m:controlfield>2</m:controlfield>'
        "<m:datafield ind1='1' tag='650'><m:subfield code='a'> x </m:subfield><m:subfield code='a'>y</m:subfield></m:datafield></m:record>"
    )
    df = spark.createDataFrame([(body,)], "x string")
    for all_leaves in (False, True):
        got = df.select(xmltree.leaf_pairs(F.col("x"), "record", marc=True, all_leaves=all_leaves).alias("p")).first().p
        assert [(p.field, list(p["values"])) for p in got] == plain_pairs(body, "record", True, all_leaves) != []


def test_a_body_the_old_parser_refused(spark, payloads):
    """U+FFFF passes as text; no body ends the job, and one that is no XML is in the audit."""
    from sheaf.sources.oai import oai_records
    from sheaf.sources.payloads import unreadable_xml
    from sheaf.spec import CollectionSpec

    page = "<OAI><ListRecords><record><header><identifier>{}</identifier></header><metadata><dc>{}</dc></metadata></record></ListRecords></OAI>"
    pages = payloads(page.format("one", "<t>a￿b</t><u>c</u>"), page.format("two", "<t>a<?p q?>b</t>"), page.format("three", "<t>a</u>"), "<OAI>", "")
    spec = CollectionSpec.from_dict("c", {"driver": "oai_xml", "args": {"metadata_prefix": "oai_dc"}})
    got = {r.identifier: r.fields for r in oai_records(pages, spec).collect()}
    assert got["two"] == {"t": ["ab"]} and got.get("one", {"u": ["c"]})["u"] == ["c"] and "three" not in got
    assert {r.seq for r in unreadable_xml(pages).collect()} >= {2, 3, 4}
