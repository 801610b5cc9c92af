"""Extraction of records from JSON, IIIF, XML, OAI-PMH and MARC payloads built from the given tables."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from sheaf.functions import jsonpath
from sheaf.functions.lists import RECORD, merge_pairs, override, scalar_or_list
from sheaf.functions.text import markup_to_text, normalise_label, sanitize
from sheaf.operators.enrich import add_thumbnails
from sheaf.operators.joins import listing_thumbnails
from sheaf.operators.records import long, missing_fields, wide
from sheaf.plans.catalogue import load, query
from sheaf.plans.harvest import harvest_many, harvest_table
from sheaf.session import shared_dir
from sheaf.sources.json_pages import json_records, record_pairs
from sheaf.sources.manifests import manifest_records, manifest_records_v3, manifest_urls, tagged_pairs, unknown_listings
from sheaf.sources.marc import marc_records, scan_index
from sheaf.sources.oai import get_record, live_records, oai_records
from sheaf.sources.payloads import failed_pages, unreadable_json, unreadable_xml
from sheaf.sources.registry import read_records
from sheaf.sources.xml_pages import extract, scan_xml_files, xml_page_records, xml_records
from sheaf.spec import CollectionSpec, FieldSpec

SITE = "https://catalogue.example.org"


def spec(driver, fields, **more):
    paths = {n: p if isinstance(p, FieldSpec) else FieldSpec(p) for n, p in fields.items()}
    return CollectionSpec(collection_id="check", driver=driver, fields=paths, **more)


def shown(name, default="-"):
    return F.coalesce(F.col(name), F.lit(default)).alias(name)


def paged(df, per_page, key, record, head="", tail="", status=None):
    """Payload pages of at most ``per_page`` records (text column ``record``), by a unique number ``key``."""
    pages = df.groupBy(F.floor(F.col(key) / per_page).alias("seq")).agg(
        F.array_sort(F.collect_list(F.struct(F.col(key).alias("at"), record.alias("record")))).alias("records"),
        (status if status is not None else F.lit(200)).alias("status"),
    )
    joined = F.array_join(F.transform("records", lambda r: r["record"]), "," if head.startswith("{") else "\n")
    return pages.select(
        F.lit("h").alias("harvest_id"), "seq",
        F.concat(F.lit(f"{SITE}/page/"), "seq").alias("url"),
        F.col("status").cast("int").alias("status"),
        F.lit("text/plain").alias("content_type"),
        F.concat(F.lit(head), joined, F.lit(tail)).alias("body"),
    )


def single(df, key, body, status=None):
    """One payload per row."""
    return df.select(
        F.lit("h").alias("harvest_id"), F.col(key).cast("bigint").alias("seq"),
        F.concat(F.lit(f"{SITE}/record/"), F.col(key).cast("string")).alias("url"),
        (status if status is not None else F.lit(200)).cast("int").alias("status"),
        F.lit("text/plain").alias("content_type"), body.alias("body"),
    )


# --- JSON -----------------------------------------------------------------

def order_pages(spark, sf_dir):
    """JSON pages of 50 orders; a page with a very large order failed to load."""
    record = F.to_json(
        F.struct(
            F.col("o_orderkey").alias("id"),
            F.array("o_orderstatus", F.concat(F.lit("  "), "o_orderpriority", F.lit("\n"))).alias("status"),
            F.array(
                F.struct(F.col("o_orderpriority").alias("name"), F.array("o_orderstatus", F.col("o_custkey").cast("string")).alias("codes")),
                F.struct(F.col("o_orderstatus").alias("name"), F.array(F.col("o_custkey").cast("string")).alias("codes")),
            ).alias("parts"),
        )
    )
    failed = F.when(F.max("o_totalprice") > 499000, 503).otherwise(200)
    return paged(load(spark, sf_dir, "orders"), 50, "o_orderkey", record, '{"content":{"results":[', "]}}", failed)


ORDER_SPEC = {
    "id": "id",
    "status": "status",
    "names": "parts[*].name",
    "first_code": "parts[0].codes[1]",
    "codes": "parts[1].codes",
    "nothing": FieldSpec("nothing.here", optional=True),
}

_PAGE_STATUS = "SELECT o_orderkey // 50 AS seq, max(o_totalprice) > 499000 AS failed FROM orders GROUP BY 1"


@query("json_field", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_field(spark, sf_dir):
    doc = load(spark, sf_dir, "events").select("event_id", F.try_parse_json("props").alias("doc"))
    return doc.select("event_id", scalar_or_list(jsonpath.find_texts(F.col("doc"), "$.k")).alias("k"))


@query(
    "json_records",
    f"""
    WITH p AS ({_PAGE_STATUS})
    SELECT seq::BIGINT AS seq, (o_orderkey % 50)::BIGINT AS pos, o_orderkey::VARCHAR AS id,
           '["' || o_orderstatus || '","' || o_orderpriority || '"]' AS status,
           '["' || o_orderpriority || '","' || o_orderstatus || '"]' AS names,
           o_custkey::VARCHAR AS first_code, o_custkey::VARCHAR AS codes, '-' AS nothing
    FROM orders JOIN p ON o_orderkey // 50 = seq WHERE NOT failed
    """,
)
def json_page_records(spark, sf_dir):
    s = spec("custom_json", ORDER_SPEC, record_selector="content.results")
    table = wide(json_records(order_pages(spark, sf_dir), s), list(ORDER_SPEC), ["seq", "pos"])
    return table.withColumn("nothing", F.coalesce("nothing", F.lit("-")))


@query(
    "failed_pages",
    f"WITH p AS ({_PAGE_STATUS}) SELECT seq::BIGINT AS seq, 503 AS status FROM p WHERE failed",
)
def failed_page_audit(spark, sf_dir):
    return failed_pages(order_pages(spark, sf_dir)).select("seq", "status")


@query(
    "unreadable_pages",
    """
    SELECT o_orderkey AS seq, 'json' AS kind FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'
    UNION ALL SELECT o_orderkey, 'xml' FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority <> '5-LOW'
    """,
)
def unreadable_pages(spark, sf_dir):
    state, orders = F.col("o_orderstatus"), load(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderpriority") == "5-LOW", 500).otherwise(200)
    json_pages = single(orders, "o_orderkey", F.when(state == "F", F.lit('{"a":')).otherwise(F.lit('{"a":[]}')), status)
    xml_pages = single(orders, "o_orderkey", F.when(state == "P", F.lit("<a><b>")).otherwise(F.lit("<a/>")), status)
    broken = unreadable_json(json_pages).withColumn("kind", F.lit("json"))
    return broken.unionByName(unreadable_xml(xml_pages).withColumn("kind", F.lit("xml"))).select("seq", "kind")


@query(
    "json_descend",
    """
    SELECT l_orderkey, l_linenumber, l_orderkey || '|' || l_partkey || '|' || l_suppkey || '|' || l_linenumber AS found
    FROM lineitem
    """,
)
def json_descend(spark, sf_dir):
    supplier = F.struct(F.struct(F.col("l_suppkey").alias("key")).alias("supplier"), F.array(F.struct(F.col("l_linenumber").alias("key"))).alias("rest"))
    part = F.struct(F.col("l_partkey").alias("key"), supplier.alias("inner"))
    body = F.to_json(F.struct(F.struct(part.alias("part"), F.col("l_orderkey").alias("key")).alias("line")))
    df = load(spark, sf_dir, "lineitem", spread=True).select("l_orderkey", "l_linenumber", body.alias("body"))
    docs = df.withColumn("doc", F.try_parse_json("body"))
    values = jsonpath.find_texts(F.col("doc"), "line..key", F.col("body"))
    return docs.select("l_orderkey", "l_linenumber", F.array_join(values, "|").alias("found"))


@query(
    "json_record_pairs",
    """
    SELECT o_orderkey, 'order-status' AS field, o_orderstatus || '|' || o_orderpriority AS found FROM orders
    UNION ALL SELECT o_orderkey, 'customer/key', o_custkey::VARCHAR FROM orders WHERE o_orderstatus <> 'P'
    """,
)
def json_record_pairs(spark, sf_dir):
    def pair(label, value):
        return F.concat(F.lit(f'{{"label":"{label}","value":'), value, F.lit("}"))
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    customer = F.when(F.col("o_orderstatus") != "P", F.concat(F.lit('[{"@value":'), quoted(F.col("o_custkey").cast("string")), F.lit("}]"))).otherwise(F.lit('""'))
    body = F.concat(
        F.lit('{"metadata":['),
        F.concat_ws(",", pair("Order (Status)", quoted(F.col("o_orderstatus"))), pair("Customer/Key", customer),
                    pair("order status", F.concat(F.lit("["), quoted(F.col("o_orderpriority")), F.lit("]")))),
        F.lit("]}"),
    )
    docs = load(spark, sf_dir, "orders").select("o_orderkey", F.try_parse_json(body).alias("doc"))
    fields = docs.select("o_orderkey", F.explode(merge_pairs(record_pairs(F.col("doc")))).alias("field", "values"))
    return fields.select("o_orderkey", "field", F.array_join("values", "|").alias("found"))


# --- IIIF -----------------------------------------------------------------

def doc_url():
    return F.concat(F.lit(f"{SITE}/manifest/"), F.col("doc_id").cast("string"))


def doc_listings(spark, sf_dir):
    """Per source and run of 1000 ids one listing; by the source's name of the older or newer
    form, of no known form, or failed."""
    docs = load(spark, sf_dir, "documents", spread=True).select("doc_id", "source", doc_url().alias("manifest"), "lang")
    groups = docs.groupBy("source", F.floor(F.col("doc_id") / 1000).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("doc_id", "manifest", "lang"))).alias("entries")
    )
    older = F.to_json(F.struct(F.transform("entries", lambda e: F.struct(e["manifest"].alias("@id"))).alias("manifests")))
    thumb = lambda e: F.array(F.struct(F.concat(F.lit("https://img.example.org/"), e["lang"], F.lit("/"), e["doc_id"].cast("string")).alias("id")))
    newer = F.to_json(F.struct(F.transform("entries", lambda e: F.struct(e["manifest"].alias("id"), thumb(e).alias("thumbnail"))).alias("items")))
    body = F.when(F.col("source") < "src13", older).when(F.col("source") == "src9", F.lit('{"members":[]}')).otherwise(newer)
    return groups.select(
        F.col("source").alias("harvest_id"), F.col("block").alias("seq"),
        F.concat(F.lit(f"{SITE}/listing/"), "source", F.lit("/"), "block").alias("url"),
        F.when(F.col("source") == "src2", 500).otherwise(200).alias("status"),
        F.lit("application/json").alias("content_type"), body.alias("body"),
    )


@query(
    "listing_manifests",
    """
    SELECT source AS harvest_id, 'https://catalogue.example.org/manifest/' || doc_id AS url
    FROM documents WHERE source NOT IN ('src2', 'src9')
    UNION ALL
    SELECT DISTINCT source, unnest(['https://catalogue.example.org/extra/1', 'https://catalogue.example.org/extra/2'])
    FROM documents
    """,
)
def listing_manifests(spark, sf_dir):
    extra = [f"{SITE}/extra/1", f"{SITE}/extra/2", f"{SITE}/extra/1"]
    return manifest_urls(doc_listings(spark, sf_dir), extra).select("harvest_id", "url")


@query(
    "listing_unknown",
    "SELECT DISTINCT source AS harvest_id, (doc_id // 1000)::BIGINT AS seq FROM documents WHERE source = 'src9'",
)
def listing_unknown(spark, sf_dir):
    return unknown_listings(doc_listings(spark, sf_dir)).select("harvest_id", "seq")


def doc_manifests(spark, sf_dir):
    """Version 2 manifests of the documents; labelled pairs in every value shape."""
    title = F.substring_index("text", "\n", 1)
    lines = F.split("text", "\n")
    tagged = F.struct(F.col("lang").alias("@language"), title.alias("@value"))
    rows = F.concat_ws(
        ",",
        F.to_json(F.struct(F.lit("Source (Name)").alias("label"), F.col("source").alias("value"))),
        F.to_json(F.struct(F.lit("Title").alias("label"), F.array(tagged).alias("value"))),
        F.to_json(F.struct(F.lit("Text/Lines").alias("label"), lines.alias("value"))),
        F.to_json(F.struct(F.lit("text lines").alias("label"), F.lit("[end]").alias("value"))),
        F.to_json(F.struct(F.lit("Text/ Lines").alias("label"), F.col("source").alias("value"))),
        F.to_json(F.struct(F.lit("language").alias("label"), F.struct(F.col("lang").alias("@value")).alias("value"))),
        F.lit('{"label":"none","value":null}'),
    )
    resource = F.concat(
        F.lit('{"@id":"https://img.example.org/'), F.col("doc_id").cast("string"), F.lit('","format":"image/jpeg"}')
    )
    body = F.concat(
        F.lit('{"@id":"'), doc_url(), F.lit('","description":["  a ", 3],"language":"overridden","sequences":'),
        F.lit('[{"canvases":[{"images":[{"resource":'), resource, F.lit('}]},{"images":[{"resource":'), resource,
        F.lit('}]}]}],"metadata":['), rows, F.lit("]}"),
    )
    return single(load(spark, sf_dir, "documents", spread=True), "doc_id", body)


MANIFEST_SPEC = {
    "id": "@id",
    "description": "description",
    "language": "language",
    "format": "sequences..format",
    "image": "sequences[0].canvases[0].images[0]..@id",
    "absent": "thumbnail..@id",
}


@query(
    "manifest_records",
    """
    SELECT doc_id AS seq, 'https://catalogue.example.org/manifest/' || doc_id AS id,
           '["a","3"]' AS description, lang AS language, '["image/jpeg","image/jpeg"]' AS format,
           'https://img.example.org/' || doc_id AS image, '-' AS absent, source AS "source-name",
           md5(replace(text, chr(10), '|')) AS "textlines_md5", '[end]' AS "text-lines-extra"
    FROM documents
    """,
)
def manifests_v2(spark, sf_dir):
    records = manifest_records(doc_manifests(spark, sf_dir), spec("iiif_json", MANIFEST_SPEC))
    fields = wide(records.withColumn("lines", F.col("fields")["textlines"]), [*MANIFEST_SPEC, "source-name"], ["seq", "lines", "fields"])
    own = F.md5(F.array_join("lines", "|")).alias("textlines_md5")
    extra = F.get(F.col("fields")["text-lines"], F.lit(0)).alias("text-lines-extra")
    return fields.select(
        "seq", "id", "description", "language", "format", "image", shown("absent"), "`source-name`", own, extra
    )


@query(
    "label_lang",
    """
    SELECT doc_id, 'title_' || lang AS field, string_split(text, chr(10))[1] AS value FROM documents
    UNION ALL SELECT doc_id, 'language', lang FROM documents
    """,
)
def label_lang(spark, sf_dir):
    docs = doc_manifests(spark, sf_dir).select(F.col("seq").alias("doc_id"), "body")
    pairs = docs.select("doc_id", F.inline(tagged_pairs(F.col("body"))))
    return pairs.where(F.startswith("field", F.lit("title_")) | (F.col("field") == "language")).select(
        "doc_id", "field", F.get("values", F.lit(0)).alias("value")
    )


@query(
    "manifest_records_v3",
    """
    SELECT source AS harvest_id, 'https://catalogue.example.org/manifest/' || doc_id AS id,
           source || '|' || lang AS "source-name", len(string_split(text, chr(10)))::BIGINT AS n_lines,
           'https://img.example.org/' || lang || '/' || doc_id AS thumbnail
    FROM documents WHERE source >= 'src13' AND source NOT IN ('src2', 'src9')
    """,
)
def manifests_v3(spark, sf_dir):
    docs = load(spark, sf_dir, "documents", spread=True)
    label = lambda text: F.create_map(F.lit("en"), F.array(F.lit(text)), F.lit("ar"), F.array(F.lit("x")))
    rows = F.concat_ws(
        ",",
        F.to_json(F.struct(label("Source (Name)").alias("label"),
                           F.create_map(F.lit("ar"), F.array("lang"), F.lit("en"), F.array("source")).alias("value"))),
        F.to_json(F.struct(label("Lines").alias("label"), F.create_map(F.lit("en"), F.split("text", "\n")).alias("value"))),
        F.lit('{"label":{"en":["Empty"]}}'),
    )
    body = F.concat(F.lit('{"id":"'), doc_url(), F.lit('","metadata":['), rows, F.lit("]}"))
    payloads = docs.select(
        F.col("source").alias("harvest_id"), F.col("doc_id").alias("seq"), doc_url().alias("url"),
        F.lit(200).alias("status"), F.lit("application/json").alias("content_type"), body.alias("body"),
    )
    records = manifest_records_v3(doc_listings(spark, sf_dir), payloads, spec("iiif_json_v3", {"id": "id"}))
    f = F.col("fields")
    return records.select(
        "harvest_id", F.get(f["id"], F.lit(0)).alias("id"), F.array_join(f["source-name"], "|").alias("source-name"),
        F.size(f["lines"]).cast("bigint").alias("n_lines"), F.get(f["thumbnail"], F.lit(0)).alias("thumbnail"),
    )


@query(
    "join_listing",
    """
    SELECT source AS harvest_id, 'https://catalogue.example.org/manifest/' || doc_id AS id,
           CASE WHEN lang = 'en' THEN 'https://img.example.org/c/' || doc_id ELSE '-' END AS thumbnail
    FROM documents WHERE source NOT IN ('src2', 'src9')
    """,
)
def join_listing(spark, sf_dir):
    thumb = F.concat(F.lit('"thumbnail":[{"id":"https://img.example.org/c/'), F.col("doc_id").cast("string"), F.lit('"}]'))
    body = F.concat(F.lit('{"items":[{'), F.when(F.col("lang") == "en", thumb).otherwise(F.lit('"x":1')), F.lit("}]}"))
    payloads = load(spark, sf_dir, "documents", spread=True).select(doc_url().alias("url"), F.lit(200).alias("status"), body.alias("body"))
    return listing_thumbnails(doc_listings(spark, sf_dir), payloads).select("harvest_id", "id", shown("thumbnail"))


# --- labels and lists -----------------------------------------------------

@query(
    "label_normalise",
    """
    SELECT p_partkey, lower(p_brand || '-' || p_type || '' || replace(p_name, ' ', '-')) AS label,
           lower(p_brand || '-' || p_type || '/' || replace(p_name, ' ', '-')) AS label_with_slash
    FROM part
    """,
)
def label_normalise(spark, sf_dir):
    label = F.concat("p_brand", F.lit(" ("), "p_type", F.lit(")/"), "p_name")
    return load(spark, sf_dir, "part", spread=True).select(
        "p_partkey", normalise_label(label).alias("label"), normalise_label(label, drop_slash=False).alias("label_with_slash")
    )


@query(
    "label_merge",
    """
    SELECT p_partkey, lower(p_type) AS field, p_name || '|' || p_brand AS found FROM part
    UNION ALL SELECT p_partkey, 'size', p_size::VARCHAR FROM part
    """,
)
def label_merge(spark, sf_dir):
    pair = lambda field, value: F.struct(field.alias("field"), F.array(value).alias("values"))
    pairs = F.array(
        pair(F.lower("p_type"), F.col("p_name")),
        pair(F.lit("size"), F.col("p_size").cast("string")),
        pair(F.lower("p_type"), F.col("p_brand")),
        F.struct(F.lit("empty").alias("field"), F.array().cast("array<string>").alias("values")),
    )
    fields = load(spark, sf_dir, "part", spread=True).select("p_partkey", F.explode(merge_pairs(pairs)).alias("field", "values"))
    return fields.select("p_partkey", "field", F.array_join("values", "|").alias("found"))


@query(
    "override_fields",
    """
    SELECT doc_id, lang, CASE WHEN quality IS NULL THEN source ELSE quality::VARCHAR END AS note
    FROM documents LEFT JOIN labels USING (doc_id)
    """,
)
def override_fields(spark, sf_dir):
    df = load(spark, sf_dir, "documents", spread=True).join(load(spark, sf_dir, "labels"), "doc_id", "left")
    declared = F.create_map(F.lit("lang"), F.array("lang"), F.lit("note"), F.array("source")).cast(RECORD)
    pair = F.when(F.col("quality").isNotNull(), F.create_map(F.lit("note"), F.array(F.col("quality").cast("string"))))
    merged = override(declared, F.coalesce(pair, F.create_map().cast(RECORD)))
    return wide(df.withColumn("fields", merged), ["lang", "note"], ["doc_id"])


@query(
    "missing_field_audit",
    """
    WITH r AS (SELECT doc_id, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))
    SELECT doc_id, 'quality' AS field, 'a.quality' AS path, true AS required FROM r WHERE quality IS NULL
    UNION ALL SELECT doc_id, 'toxic', 'a.toxic', false FROM r WHERE coalesce(toxic, 0) = 0
    UNION ALL SELECT doc_id, 'never', 'a.never', true FROM r
    """,
)
def missing_field_audit(spark, sf_dir):
    df = load(spark, sf_dir, "documents", spread=True).join(load(spark, sf_dir, "labels"), "doc_id", "left")
    toxic = F.when(F.col("toxic") != 0, F.col("toxic"))
    body = F.to_json(F.struct(F.struct("lang", "quality", toxic.alias("toxic")).alias("a")))
    paths = {"lang": "a.lang", "quality": "a.quality", "toxic": FieldSpec("a.toxic", optional=True), "never": "a.never"}
    s = spec("iiif_json", paths)
    records = manifest_records(single(df, "doc_id", body), s)
    return missing_fields(records, s, ["seq"]).withColumnRenamed("seq", "doc_id")


@query(
    "record_values",
    """
    SELECT doc_id, 'lang' AS field, 0 AS vpos, lang AS value FROM documents
    UNION ALL SELECT doc_id, 'line', (generate_subscripts(lines, 1) - 1)::INT, unnest(lines)
    FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)
    """,
)
def record_values(spark, sf_dir):
    fields = F.create_map(F.lit("lang"), F.array("lang"), F.lit("line"), F.split("text", "\n"))
    return long(load(spark, sf_dir, "documents", spread=True).select("doc_id", fields.alias("fields")), ["doc_id"])


# --- text -----------------------------------------------------------------

@query(
    "sanitize_text",
    """
    SELECT doc_id, md5(replace(replace(trim(t, ' ' || chr(10) || chr(13) || chr(9)), chr(10), ' '), chr(13), '')) AS clean_md5
    FROM (SELECT doc_id, chr(10) || ' ' || replace(text, '. ', '.' || chr(13) || chr(10)) || chr(9) AS t FROM documents)
    """,
)
def sanitize_text(spark, sf_dir):
    raw = F.concat(F.lit("\n "), F.replace(F.col("text"), F.lit(". "), F.lit(".\r\n")), F.lit("\t"))
    return load(spark, sf_dir, "documents", spread=True).select("doc_id", F.md5(sanitize(raw)).alias("clean_md5"))


@query(
    "markup_to_text",
    r"""
    WITH t AS (SELECT page_id,
        regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->|<\?.*?>|<![A-Za-z][^>]*>', '', 'g'),
        '(?is)<script\b[^>]*>.*?</script\s*>', '', 'g'), '</?[A-Za-z][^>]*>', '', 'g') AS t FROM pages)
    SELECT page_id, md5(replace(replace(replace(replace(t, '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;', '&')) AS text_md5
    FROM t
    """,
)
def html_to_text(spark, sf_dir):
    return load(spark, sf_dir, "pages", spread=True).select("page_id", F.md5(markup_to_text(F.col("html"))).alias("text_md5"))


@query("markup_known", "SELECT doc_id, md5(text) AS text_md5 FROM documents")
def known_markup(spark, sf_dir):
    """Markup made around a known text, which must come back."""
    text = F.col("text")
    for character, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("é", "&eacute;"), ("ü", "&#252;")):
        text = F.replace(text, F.lit(character), F.lit(name))
    html = F.concat(F.lit('<div title="a"><!-- <b>no</b> --><script>if (a < b) no();</script><p>'), text, F.lit("</p></div>"))
    return load(spark, sf_dir, "documents", spread=True).select("doc_id", F.md5(markup_to_text(html)).alias("text_md5"))


@query(
    "jsonld_thumbnail",
    """
    SELECT page_id, url, 'https://img.example.org/' || page_id AS thumbnail FROM pages
    WHERE starts_with(url, 'https://') AND url NOT LIKE '%/fr/%' AND url NOT LIKE '%/de/%'
      AND contains(html, '</body>')
    """,
)
def jsonld_thumbnail(spark, sf_dir):
    pages = load(spark, sf_dir, "pages", spread=True)
    good = F.concat(F.lit('{"name":"a\nb","thumbnailUrl":"https://img.example.org/'), F.col("page_id").cast("string"), F.lit('"}'))
    block = F.when(F.contains("url", F.lit("/fr/")), F.lit('{"thumbnailUrl":')).otherwise(good)
    script = F.concat(F.lit('<script type="application/ld+json">'), block, F.lit("</script></body>"))
    has_script = F.startswith("url", F.lit("https://"))
    body = F.when(has_script, F.replace(F.col("html"), F.lit("</body>"), script)).otherwise(F.col("html"))
    kind = F.when(F.contains("url", F.lit("/de/")), F.lit("application/pdf")).otherwise(F.lit("text/html; charset=utf-8"))
    payloads = pages.select("url", F.lit(200).alias("status"), kind.alias("content_type"), body.alias("body"))
    return add_thumbnails(pages.select("page_id", "url"), payloads, "url")


# --- XML ------------------------------------------------------------------

XML_HEAD = '<?xml version="1.0"?><rss xmlns:dc="http://purl.org/dc/elements/1.1/"><channel>'
XML_TAIL = "</channel></rss>"
DC = {"dc": "http://purl.org/dc/elements/1.1/"}


def customer_item():
    return F.concat(
        F.lit("<item><guid>"), F.col("c_custkey").cast("string"), F.lit("</guid><dc:title xml:lang=\"en\"> "), F.col("c_name"),
        F.lit("\n</dc:title><dc:creator>"), F.col("c_mktsegment"), F.lit("</dc:creator><dc:creator>&lt;b&gt;n"),
        F.col("c_nationkey").cast("string"), F.lit("&lt;/b&gt; &amp;amp; co</dc:creator><related><dc:title>other</dc:title></related>"),
        F.lit('<file access="preview" url="https://img.example.org/'), F.col("c_custkey").cast("string"),
        F.lit('"/><file access="raw" url="https://raw.example.org/x"/><empty/></item>'),
    )


XML_SPEC = {
    "id": ".//guid",
    "title": FieldSpec("./dc:title", DC),
    "creator": FieldSpec(".//dc:creator", DC),
    "preview": FieldSpec(".//file[@access='preview']/@url"),
    "own_title": FieldSpec("//dc:title[not(ancestor::related)]", DC),
    "second": FieldSpec(".//dc:creator[2]", DC),
    "french": FieldSpec("//dc:title[@xml:lang='fr']", DC, optional=True),
    "empty": FieldSpec(".//empty"),
}

_XML_SQL = """
    SELECT {keys}c_custkey::VARCHAR AS id, c_name AS title,
           '["' || c_mktsegment || '","n' || c_nationkey || ' & co"]' AS creator,
           'https://img.example.org/' || c_custkey AS preview, c_name AS own_title,
           'n' || c_nationkey || ' & co' AS second, '-' AS french, '-' AS empty
    FROM customer
"""


def _xml_view(records, keys):
    names = list(XML_SPEC)
    table = wide(records, names, keys)
    return table.select(*keys, *[shown(n) if n in ("french", "empty") else F.col(n) for n in names])


@query("xml_records", _XML_SQL.format(keys="(c_custkey // 40)::BIGINT AS seq, (c_custkey % 40)::BIGINT AS pos, "))
def xml_page_table(spark, sf_dir):
    s = spec("xml", XML_SPEC, record_selector=".//item")
    pages = paged(load(spark, sf_dir, "customer"), 40, "c_custkey", customer_item(), XML_HEAD, XML_TAIL)
    return _xml_view(read_records(pages, s), ["seq", "pos"])


@query("xml_files", _XML_SQL.format(keys=""))
def xml_file_table(spark, sf_dir):
    path = shared_dir(spark, "feed")
    df = load(spark, sf_dir, "customer").select(F.concat(F.lit("  "), customer_item()).alias("value"))
    df.write.text(path)
    records = scan_xml_files(spark, path, "item").select(
        F.lit("h").alias("harvest_id"), F.col("file_block").alias("seq"), F.col("file_row").alias("pos"),
        F.col("file_name").alias("url"), "record",
    )
    return _xml_view(extract(records, spec("xml", XML_SPEC)), [])


@query(
    "xml_linked_pages",
    """
    SELECT c_custkey AS seq, c_custkey::VARCHAR AS id, 'https://catalogue.example.org/record/' || c_custkey AS address
    FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'FURNITURE')
    """,
)
def xml_linked_pages(spark, sf_dir):
    body = F.concat(F.lit('<?xml version="1.0"?>\n'), F.when(F.col("c_mktsegment") == "FURNITURE", F.lit("<item><guid>")).otherwise(customer_item()))
    status = F.when(F.col("c_mktsegment") == "BUILDING", 404).otherwise(200)
    pages = single(load(spark, sf_dir, "customer"), "c_custkey", body, status)
    return wide(xml_page_records(pages, spec("xml", {"id": ".//guid", "address": "/item/harvest_url"})), ["id", "address"], ["seq"])


# --- OAI-PMH --------------------------------------------------------------

OAI_HEAD = '<?xml version="1.0"?><OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/"><ListRecords>'
OAI_TAIL = "<resumptionToken>x</resumptionToken></ListRecords></OAI-PMH>"


def oai_pages(spark, sf_dir, metadata):
    """List pages of 50 orders; an order of status F is a deleted record."""
    deleted = F.col("o_orderstatus") == "F"
    header = F.concat(
        F.when(deleted, F.lit('<header status="deleted">')).otherwise(F.lit("<header>")),
        F.lit("<identifier>oai:x:"), F.col("o_orderkey").cast("string"), F.lit("</identifier><datestamp>"),
        F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("</datestamp></header>"),
    )
    body = F.when(deleted, F.lit("")).otherwise(F.concat(F.lit("<metadata>"), metadata, F.lit("</metadata>")))
    record = F.concat(F.lit("<record>"), header, body, F.lit("</record>"))
    return paged(load(spark, sf_dir, "orders"), 50, "o_orderkey", record, OAI_HEAD, OAI_TAIL)


def dc_metadata():
    return F.concat(
        F.lit('<oai_dc:dc xmlns:oai_dc="http://www.openarchives.org/OAI/2.0/oai_dc/" xmlns:dc="http://purl.org/dc/elements/1.1/">'),
        F.lit("<dc:title> Order "), F.col("o_orderkey").cast("string"), F.lit("\n</dc:title><dc:subject>"), F.col("o_orderpriority"),
        F.lit("</dc:subject><dc:subject>"), F.col("o_orderstatus"),
        F.lit("</dc:subject><dc:name><dc:part>first</dc:part><dc:part>c"), F.col("o_custkey").cast("string"),
        F.lit("</dc:part><dc:role>payer</dc:role></dc:name><dc:empty/></oai_dc:dc>"),
    )


@query(
    "oai_skip_deleted",
    """
    SELECT 'oai:x:' || o_orderkey AS identifier, strftime(o_orderdate, '%Y-%m-%d') AS datestamp
    FROM orders WHERE o_orderstatus <> 'F'
    """,
)
def oai_skip_deleted(spark, sf_dir):
    return live_records(oai_pages(spark, sf_dir, dc_metadata())).select("identifier", "datestamp")


@query(
    "oai_get_record",
    "SELECT 'oai:x:' || o_orderkey AS identifier FROM orders WHERE o_orderkey = 1 AND o_orderstatus <> 'F'"
    " UNION ALL SELECT 'oai:x:' || o_orderkey FROM orders WHERE o_orderkey = 2 AND o_orderstatus <> 'F'",
)
def oai_get(spark, sf_dir):
    pages = oai_pages(spark, sf_dir, dc_metadata())
    return get_record(pages, "oai:x:1").unionByName(get_record(pages, "oai:x:2")).select("identifier")


@query(
    "oai_records",
    """
    SELECT 'oai:x:' || o_orderkey AS identifier, '["oai:x:' || o_orderkey || '"]' AS ids, 'Order ' || o_orderkey AS title,
           '["' || o_orderpriority || '","' || o_orderstatus || '"]' AS subject, 'c' || o_custkey AS name_part,
           '-' AS name_role, '-' AS empty
    FROM orders WHERE o_orderstatus <> 'F'
    """,
)
def oai_dc_records(spark, sf_dir):
    s = spec("oai_xml", {"ids": "//identifier", "title": FieldSpec("//dc:title", DC)}, metadata_prefix="oai_dc")
    records = read_records(oai_pages(spark, sf_dir, dc_metadata()), s)
    table = wide(records.withColumn("ids", F.to_json(F.col("fields")["ids"])), ["title", "subject", "name_part", "name_role", "empty"], ["identifier", "ids"])
    return table.select("identifier", "ids", "title", "subject", "name_part", shown("name_role"), shown("empty"))


@query(
    "oai_all_leaves",
    """
    SELECT 'oai:x:' || o_orderkey AS identifier, 'c' || o_custkey AS name_part, 'payer' AS name_role
    FROM orders WHERE o_orderstatus <> 'F'
    """,
)
def oai_all_leaves(spark, sf_dir):
    s = spec("oai_xml", {}, metadata_prefix="oai_dc")
    records = oai_records(oai_pages(spark, sf_dir, dc_metadata()), s, all_leaves=True)
    return wide(records, ["name_part", "name_role"], ["identifier"])


@query(
    "oai_marc_records",
    """
    SELECT 'oai:x:' || o_orderkey AS identifier, 'l' || o_orderkey AS leader, '00' || o_custkey AS "001",
           '["' || o_orderpriority || '","' || o_orderstatus || '"]' AS "650_a", '-' AS "650_b"
    FROM orders WHERE o_orderstatus <> 'F'
    """,
)
def oai_marc_records(spark, sf_dir):
    key, customer = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    field = lambda value: F.concat(F.lit('<datafield tag="650" ind1=" "><subfield code="a">'), value, F.lit('</subfield><subfield code="b">z</subfield></datafield>'))
    metadata = F.concat(
        F.lit('<record xmlns="http://www.loc.gov/MARC21/slim"><leader>l'), key, F.lit('</leader><controlfield tag="001">00'), customer,
        F.lit("</controlfield>"), field(F.col("o_orderpriority")), field(F.col("o_orderstatus")), F.lit("</record>"),
    )
    records = oai_records(oai_pages(spark, sf_dir, metadata), spec("oai_xml", {}, metadata_prefix="oai_marc21"))
    table = wide(records, ["leader", "001", "650_a", "650_b"], ["identifier"])
    return table.withColumn("650_b", F.coalesce("650_b", F.lit("-")))


# --- MARC -----------------------------------------------------------------

def marc_payloads(spark, sf_dir):
    key = F.col("p_partkey").cast("string")

    def data(tag, *subfields):
        inner = [x for code, value in subfields for x in (F.lit(f'<subfield code="{code}">'), value, F.lit("</subfield>"))]
        return F.concat(F.lit(f'<datafield tag="{tag}" ind1="1" ind2=" ">'), *inner, F.lit("</datafield>"))

    body = F.concat(
        F.lit('<collection xmlns="http://www.loc.gov/MARC21/slim"><record><leader>00000cam</leader><controlfield tag="001">00'), key,
        F.lit('</controlfield><controlfield tag="008">0080</controlfield>'),
        data("245", ("a", F.col("p_name")), ("a", F.col("p_type")), ("c", F.lit(""))),
        data("650", ("a", F.col("p_brand"))), data("650", ("a", F.col("p_size").cast("string")), ("x", F.lit("y"))),
        F.lit("</record></collection>"),
    )
    return single(load(spark, sf_dir, "part", spread=True), "p_partkey", body)


_MARC_SQL = """
    SELECT p_partkey AS seq, '00000cam' AS leader, '00' || p_partkey AS "001", '0080' AS "008",
           '["' || p_name || '","' || p_type || '"]' AS "245_a", '-' AS "245_c", {a} AS "650_a", 'y' AS "650_x"
    FROM part
"""


def _marc_view(records):
    table = wide(records, ["001", "008", "245_a", "245_c", "650_a", "650_x"], ["seq", "leader"])
    return table.withColumn("245_c", F.coalesce("245_c", F.lit("-")))


@query("marc_flatten", _MARC_SQL.format(a="p_size::VARCHAR"))
def marc_flatten(spark, sf_dir):
    return _marc_view(marc_records(marc_payloads(spark, sf_dir)))


@query("marc_flatten_append", _MARC_SQL.format(a="'[\"' || p_brand || '\",\"' || p_size || '\"]'"))
def marc_flatten_append(spark, sf_dir):
    return _marc_view(marc_records(marc_payloads(spark, sf_dir), keep="append"))


@query(
    "marc_by_index",
    "SELECT p_partkey AS seq, '00' || p_partkey AS \"001\" FROM part WHERE p_type IN ('SMALL', 'PROMO')",
)
def marc_by_index(spark, sf_dir):
    path = shared_dir(spark, "index")
    index = load(spark, sf_dir, "part", spread=True).where(F.col("p_type").isin("SMALL", "PROMO"))
    index.select(F.col("p_name").alias("title"), F.col("p_partkey").alias("ht_bib_key")).write.options(header=True, sep="\t").csv(path)
    records = marc_records(marc_payloads(spark, sf_dir), scan_index(spark, path, "ht_bib_key", SITE + "/record/{id}"))
    return wide(records, ["001"], ["seq"])


_ISSUES_XML = (
    '<collection><record><leader>l</leader><controlfield tag="001">{id}</controlfield>'
    '<datafield ind1=" " ind2=" " tag="245"><subfield code="a">{title}</subfield></datafield>{issues}</record></collection>'
)


@query(
    "harvest_serials",
    """
    SELECT o_custkey::VARCHAR AS id, 'c' || o_custkey AS title, o_orderkey::VARCHAR AS issue, o_orderstatus AS status
    FROM orders
    """,
)
def harvest_serials(spark, sf_dir):
    """Customers as serials with their orders as issues, split by the spec alone."""
    issue = '<datafield ind1=" " ind2=" " tag="974"><subfield code="a">{}</subfield><subfield code="s">{}</subfield></datafield>'.split("{}")
    parts = [F.lit(issue[0]), F.col("o_orderkey").cast("string"), F.lit(issue[1]), F.col("o_orderstatus"), F.lit(issue[2])]
    issues = F.array_join(F.sort_array(F.collect_list(F.concat(*parts))), "").alias("issues")
    customers = load(spark, sf_dir, "orders").groupBy("o_custkey").agg(issues)
    before, middle, after, end = re.split(r"\{id\}|\{title\}|\{issues\}", _ISSUES_XML)
    name = F.col("o_custkey").cast("string")
    body = F.concat(F.lit(before), name, F.lit(middle), F.lit("c"), name, F.lit(after), "issues", F.lit(end))
    payloads = customers.select(
        F.lit("h").alias("harvest_id"), F.col("o_custkey").alias("seq"), F.concat(F.lit("https://x.example.org/"), name).alias("url"),
        F.lit(200).alias("status"), F.lit("text/xml").alias("content_type"), body.alias("body"),
    )
    spec = CollectionSpec.from_dict("serials", {"driver": "hathi_trust", "metadata": {
        "fields": {"id": {"name_in_dataframe": "001"}}, "post_harvest": "split_marc_serials"}})
    table = harvest_table(payloads, spec, ["001", "245_a", "974_a", "974_s"])
    first = [F.get(F.col(c), F.lit(0)) for c in ("245_a", "974_a", "974_s")]
    return table.select(F.col("001").alias("id"), first[0].alias("title"), first[1].alias("issue"), first[2].alias("status"))


MANY = [
    CollectionSpec.from_dict("orders", {"driver": "custom_json", "args": {"record_selector": "content.results"}, "metadata": {
        "fields": {"id": {"path": "id"}, "title": {"path": "parts[0].name"}}}}),
    CollectionSpec.from_dict("customers", {"driver": "custom_json", "args": {"record_selector": "items"}, "metadata": {
        "fields": {"id": {"path": "key"}, "title": {"path": "label"}}}}),
    CollectionSpec.from_dict("parts", {"driver": "hathi_trust", "metadata": {"fields": {"id": {"name_in_dataframe": "001"}}}}),
]


def many_payloads(spark, sf_dir):
    """Landed pages of three collections, written as one table partitioned by collection."""
    customer = F.to_json(F.struct(F.col("c_custkey").alias("key"), F.col("c_name").alias("label")))
    tables = {
        "orders": order_pages(spark, sf_dir),
        "customers": paged(load(spark, sf_dir, "customer"), 100, "c_custkey", customer, '{"items":[', "]}"),
        "parts": marc_payloads(spark, sf_dir),
    }
    path = shared_dir(spark, "collections")
    for name, table in tables.items():
        table.write.parquet(f"{path}/collection_id={name}")
    return spark.read.parquet(path)


@query(
    "harvest_collections",
    f"""
    WITH pages AS ({_PAGE_STATUS})
    SELECT 'orders' AS collection_id, o_orderkey::VARCHAR AS record_id, o_orderpriority AS title
    FROM orders JOIN pages ON seq = o_orderkey // 50 WHERE NOT failed
    UNION ALL SELECT 'customers', c_custkey::VARCHAR, c_name FROM customer
    UNION ALL SELECT 'parts', '00' || p_partkey, '-' FROM part
    """,
)
def harvest_collections(spark, sf_dir):
    table = harvest_many(many_payloads(spark, sf_dir), MANY, ["title"])
    return table.select("collection_id", "record_id", F.coalesce(F.get(F.col("title"), F.lit(0)), F.lit("-")).alias("title"))
