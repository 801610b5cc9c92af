"""Report figures over mapped records that are made from documents and labels as NDJSON lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheaf.functions.text import sanitize
from sheaf.operators import conform, inventory, links, mapping, report
from sheaf.operators.dedupe import first_per_key
from sheaf.operators.filters import apply_filters
from sheaf.operators.records import with_fields
from sheaf.plans.catalogue import load, query
from sheaf.session import shared_dir
from sheaf.sources.ndjson import scan_mapping_lines
from sheaf.spec import CollectionSpec, FieldFilter, FieldSpec


def mapped_lines(spark, sf_dir, documents=None):
    """One JSON line per document, collection = source; fields depend on its labels."""
    documents = load(spark, sf_dir, "documents", spread=True) if documents is None else documents
    df = documents.join(load(spark, sf_dir, "labels"), "doc_id", "left")
    good, clean = F.col("quality") == 1, F.col("toxic") == 0
    by_lang = lambda values: F.create_map(F.col("lang"), values)
    address = F.when(good, F.concat(F.lit("https://img.example.org/"), F.col("doc_id").cast("string"))).otherwise(
        F.concat(F.lit("/lost/"), F.col("doc_id").cast("string"))
    )
    shown_at = F.struct(
        F.concat(F.lit("https://catalogue.example.org/"), F.col("source"), F.lit("/"), F.col("n_chars").cast("string")).alias("wr_id"),
        F.when(clean, F.array(F.lit("open"))).alias("wr_dc_rights"),
        F.when(good, F.array(F.lit("m1"))).alias("wr_is_referenced_by"),
    )
    record = F.struct(
        F.col("doc_id").cast("string").alias("id"),
        by_lang(F.array(F.substring_index("text", "\n", 1))).alias("cho_title"),
        by_lang(F.split("text", "\n")).alias("cho_description"),
        F.array("n_chars", F.col("n_chars") + 1).alias("cho_date_range_norm"),
        F.when(clean, F.create_map(F.lit("en"), F.array(F.lit("free"), F.lit("open")))).alias("cho_dc_rights"),
        F.when(good, F.array(F.lit("cc0"))).alias("agg_edm_rights"),
        F.when(F.col("quality").isNotNull(), F.struct(address.alias("wr_id"))).alias("agg_preview"),
        shown_at.alias("agg_is_shown_at"),
        F.lit("t").alias("cho_type_facet"),
        F.lit("file.json").alias("shop_source_file"),
    )
    return df.select(F.col("source").alias("collection_id"), F.to_json(record).alias("value"))


def counted(spark, sf_dir):
    return report.field_counts(mapped_lines(spark, sf_dir), report.ignored_fields("shop"))


_R = """
    r AS (SELECT d.source AS collection_id, d.doc_id, d.lang, d.n_chars, l.quality, l.toxic,
                 len(string_split(d.text, chr(10))) AS n_lines
          FROM documents d LEFT JOIN labels l USING (doc_id)),
    c AS (
        SELECT collection_id, 'cho_title' AS field, 'fields_covered' AS key, 1 AS n FROM r
        UNION ALL SELECT collection_id, 'cho_title', lang, 1 FROM r
        UNION ALL SELECT collection_id, 'cho_description', 'fields_covered', 1 FROM r
        UNION ALL SELECT collection_id, 'cho_description', lang, n_lines FROM r
        UNION ALL SELECT collection_id, 'cho_date_range_norm', unnest(['fields_covered', 'values']), 1 FROM r
        UNION ALL SELECT collection_id, 'cho_dc_rights', 'fields_covered', 1 FROM r WHERE toxic = 0
        UNION ALL SELECT collection_id, 'cho_dc_rights', 'en', 2 FROM r WHERE toxic = 0
        UNION ALL SELECT collection_id, 'agg_edm_rights', unnest(['fields_covered', 'values']), 1 FROM r WHERE quality = 1
        UNION ALL SELECT collection_id, 'agg_preview', unnest(['fields_covered', 'wr_id']), 1 FROM r WHERE quality IS NOT NULL
        UNION ALL SELECT collection_id, 'agg_is_shown_at', unnest(['fields_covered', 'wr_id']), 1 FROM r
        UNION ALL SELECT collection_id, 'agg_is_shown_at', 'wr_dc_rights', 1 FROM r WHERE toxic = 0
        UNION ALL SELECT collection_id, 'agg_is_shown_at', 'wr_is_referenced_by', 1 FROM r WHERE quality = 1
    ),
    k AS (SELECT collection_id, field, key, sum(n)::BIGINT AS n FROM c GROUP BY ALL),
    t AS (SELECT collection_id, count(*) AS records FROM r GROUP BY 1)
"""

# n / records to two digits, ties to even, without floating point
_AVG = """(CASE WHEN 2 * ((n * 100) % records) > records
    OR (2 * ((n * 100) % records) = records AND ((n * 100) // records) % 2 = 1)
    THEN (n * 100) // records + 1 ELSE (n * 100) // records END) / 100.0::DOUBLE"""

_LANGS = """k2 AS (SELECT collection_id, field, key AS lang, n FROM k
    WHERE key NOT IN ('fields_covered', 'values', 'wr_id', 'wr_dc_rights', 'wr_edm_rights', 'wr_is_referenced_by')),
    k3 AS (SELECT * FROM k2 UNION ALL SELECT collection_id, field, '*', sum(n)::BIGINT FROM k2 GROUP BY ALL)"""


@query("field_counts", f"WITH {_R} SELECT * FROM k")
def field_counts(spark, sf_dir):
    return counted(spark, sf_dir).where(F.col("field") != report.RECORDS)


@query(
    "field_coverage",
    f"""
    WITH {_R}
    SELECT collection_id, field, n, records, (n * 100 // records)::BIGINT AS percent
    FROM k JOIN t USING (collection_id) WHERE key = 'fields_covered'
    """,
)
def field_coverage(spark, sf_dir):
    return report.coverage(counted(spark, sf_dir))


@query(
    "harvest_coverage",
    f"""
    WITH firsts AS (
        SELECT doc_id, lang, source, n_chars, replace(replace(trim(text, ' ' || chr(10) || chr(13) || chr(9)), chr(10), ' '), chr(13), '') AS text
        FROM documents
        QUALIFY row_number() OVER (PARTITION BY replace(replace(trim(text, ' ' || chr(10) || chr(13) || chr(9)), chr(10), ' '), chr(13), '') ORDER BY doc_id) = 1
    ), kept AS (SELECT * FROM firsts WHERE lang IN ('en', 'fr', 'de') AND source NOT IN ('src1', 'src2')),
    {_R.replace("FROM documents d", "FROM kept d")}
    SELECT collection_id, field, n, records, (n * 100 // records)::BIGINT AS percent
    FROM k JOIN t USING (collection_id) WHERE key = 'fields_covered'
    """,
)
def harvest_coverage(spark, sf_dir):
    """Clean the texts, keep the first of equal ones, filter, then report field coverage per source."""
    documents = load(spark, sf_dir, "documents").withColumn("text", sanitize(F.col("text")))
    spec = CollectionSpec(
        "docs", "custom_json", fields={"id": FieldSpec("id", name_in_table="text")},
        filters={"lang": FieldFilter(include=("en", "fr", "de")), "source": FieldFilter(exclude=("src1", "src2"))},
    )
    kept = apply_filters(first_per_key(documents, [spec.id_column], ["doc_id"]), spec.filters)
    return report.coverage(report.field_counts(mapped_lines(spark, sf_dir, kept), report.ignored_fields("shop")))


@query(
    "field_averages",
    f"""
    WITH {_R}
    SELECT collection_id, field, key, {_AVG} AS average FROM k JOIN t USING (collection_id) WHERE key IN ('values', 'wr_id')
    """,
)
def field_averages(spark, sf_dir):
    return report.averages(counted(spark, sf_dir))


@query(
    "language_averages",
    f"WITH {_R}, {_LANGS} SELECT collection_id, field, lang, n, {_AVG} AS average FROM k3 JOIN t USING (collection_id)",
)
def language_averages(spark, sf_dir):
    return report.language_averages(counted(spark, sf_dir))


_RESOURCES = """SELECT collection_id, count(*) AS records, count(quality) AS thumbnails, count(*) AS resources,
    count(*) FILTER (WHERE quality = 1) AS manifests FROM r GROUP BY 1"""

_RIGHTS = """SELECT collection_id, count(*) AS records, count(*) FILTER (WHERE toxic = 0) AS object_rights,
    count(*) FILTER (WHERE toxic = 0) AS web_resource_rights, count(*) FILTER (WHERE quality = 1) AS aggregation_rights
    FROM r GROUP BY 1"""


@query("resource_report", f"WITH {_R} {_RESOURCES}")
def resource_report(spark, sf_dir):
    return report.resource_report(counted(spark, sf_dir))


@query("rights_report", f"WITH {_R} {_RIGHTS}")
def rights_report(spark, sf_dir):
    return report.rights_report(counted(spark, sf_dir))


_SECTIONS = f"""
    SELECT collection_id, 'coverage' AS section, field, '' AS key, 'n' AS measure, n::DOUBLE AS value
    FROM k WHERE key = 'fields_covered'
    UNION ALL SELECT collection_id, 'coverage', field, '', 'percent', (n * 100 // records)::DOUBLE
    FROM k JOIN t USING (collection_id) WHERE key = 'fields_covered'
    UNION ALL SELECT collection_id, 'averages', field, key, 'average', {_AVG}
    FROM k JOIN t USING (collection_id) WHERE key IN ('values', 'wr_id')
    UNION ALL SELECT collection_id, 'languages', field, lang, 'n', n::DOUBLE FROM k3
    UNION ALL SELECT collection_id, 'languages', field, lang, 'average', {_AVG} FROM k3 JOIN t USING (collection_id)
    UNION ALL SELECT collection_id, 'resources', '', '', unnest(['records', 'thumbnails', 'resources', 'manifests']),
        unnest([records, thumbnails, resources, manifests])::DOUBLE FROM res
    UNION ALL SELECT collection_id, 'rights', '', '', unnest(['object_rights', 'web_resource_rights', 'aggregation_rights']),
        unnest([object_rights, web_resource_rights, aggregation_rights])::DOUBLE FROM rig
"""


@query("report_sections", f"WITH {_R}, {_LANGS}, res AS ({_RESOURCES}), rig AS ({_RIGHTS}) {_SECTIONS}")
def report_sections(spark, sf_dir):
    return report.report_sections(counted(spark, sf_dir))


# --- links and thumbnails -------------------------------------------------

def probes(spark, sf_dir):
    """Probe results of the addresses above: short documents are gone, long ones time out."""
    df = load(spark, sf_dir, "documents")
    status = F.when(F.col("n_chars") < 800, 404).otherwise(200)
    error = F.when(F.col("n_chars") > 5000, F.lit("timed out"))
    page = F.concat(F.lit("https://catalogue.example.org/"), F.col("source"), F.lit("/"), F.col("n_chars").cast("string"))
    image = F.concat(F.lit("https://img.example.org/"), F.col("doc_id").cast("string"))
    return df.select(page.alias("url"), status.alias("status"), error.alias("error")).unionByName(
        df.select(image.alias("url"), status.alias("status"), F.lit(None).cast("string").alias("error"))
    )


def checked_links(spark, sf_dir):
    return links.check_links(links.record_links(mapped_lines(spark, sf_dir)), probes(spark, sf_dir))


@query(
    "unresolvable_links",
    """
    WITH r AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id)),
    l AS (
        SELECT source AS collection_id, doc_id::VARCHAR AS id, 'resource' AS kind,
               'https://catalogue.example.org/' || source || '/' || n_chars AS url, n_chars BETWEEN 800 AND 5000 AS good FROM r
        UNION ALL
        SELECT source, doc_id::VARCHAR, 'thumbnail',
               CASE WHEN quality = 1 THEN 'https://img.example.org/' ELSE '/lost/' END || doc_id, quality = 1 AND n_chars >= 800
        FROM r WHERE quality IS NOT NULL
    )
    SELECT collection_id, id, kind, 'Identifier ' || id || ' from ' || collection_id || ': ' || url AS message
    FROM l WHERE NOT good
    """,
)
def unresolvable_links(spark, sf_dir):
    return links.unresolvable(checked_links(spark, sf_dir))


@query(
    "thumbnail_sample",
    """
    WITH u AS (SELECT CASE WHEN lang = 'en' THEN 'en' ELSE 'other' END AS collection_id, doc_id::VARCHAR AS id,
                      'https://img.example.org/' || doc_id AS url FROM documents),
    r AS (SELECT *, row_number() OVER (PARTITION BY collection_id ORDER BY md5(url), id) AS rank,
                 count(*) OVER (PARTITION BY collection_id) AS available FROM u)
    SELECT collection_id, id, url, rank::INT AS rank, available FROM r
    WHERE rank <= CASE WHEN available > 5000 THEN 250 WHEN available > 100 THEN 50 ELSE available END
    """,
)
def thumbnail_sample(spark, sf_dir):
    urls = load(spark, sf_dir, "documents").select(
        F.when(F.col("lang") == "en", F.lit("en")).otherwise(F.lit("other")).alias("collection_id"),
        F.col("doc_id").cast("string").alias("id"),
        F.concat(F.lit("https://img.example.org/"), F.col("doc_id").cast("string")).alias("url"),
    )
    return links.thumbnail_sample(urls)


@query(
    "thumbnail_quality",
    """
    WITH s AS (SELECT p_brand AS collection_id, count(*) FILTER (WHERE p_size > 0) AS sampled,
                      count(*) FILTER (WHERE greatest(p_size * 12, p_retailprice / 4) >= 400) AS good FROM part GROUP BY 1)
    SELECT *, round_even(good * 100.0 / sampled, 0)::BIGINT || '% of the ' || sampled
        || ' thumbnail images sampled had a width or height of 400 or greater.' AS message FROM s
    """,
)
def thumbnail_quality(spark, sf_dir):
    sizes = load(spark, sf_dir, "part").select(
        F.col("p_brand").alias("collection_id"), (F.col("p_size") * 12).alias("width"), (F.col("p_retailprice") / 4).alias("height")
    )
    return links.thumbnail_quality(sizes)


_TRANSFORMS = """
        SELECT p_type, CASE WHEN p_size < 10 THEN '.' || replace(p_name, ' ', '_') || '[0]'
                    WHEN p_size < 20 THEN replace(p_name, ' ', '_')
                    WHEN p_size < 30 THEN 'Assigned literal value: ''''' || p_partkey || ''''''
                    ELSE '.Classification or .ObjectName' END AS from_field,
               CASE WHEN p_size < 10 THEN 'cho_title' WHEN p_size < 20 THEN 'cho_date'
                    WHEN p_size < 30 THEN 'cho_type' ELSE 'cho_edm_type' END AS to_field,
               CASE WHEN p_size < 10 THEN 'A literal value was prepended to provide context or to satisfy a consistent pattern requirement.'
                    WHEN p_size < 20 THEN 'The output value was mapped to a value in a controlled vocabulary.'
                    WHEN p_size < 30 THEN '' ELSE 'Seperate values on '';'', then downcase' END AS transforms
        FROM part WHERE p_size < 35
"""


@query(
    "report_document",
    f"""
    WITH {_R}, {_LANGS}, res AS ({_RESOURCES}), rig AS ({_RIGHTS}),
    bad AS (
        SELECT collection_id, 'resource' AS field, count(*) FILTER (WHERE n_chars NOT BETWEEN 800 AND 5000) AS n FROM r GROUP BY 1
        UNION ALL SELECT collection_id, 'thumbnail', count(*) FILTER (WHERE quality <> 1 OR n_chars < 800)
        FROM r WHERE quality IS NOT NULL GROUP BY 1),
    images AS (SELECT p_brand AS collection_id, count(*) FILTER (WHERE p_size > 0) AS sampled,
                      count(*) FILTER (WHERE greatest(p_size * 12, p_retailprice / 4) >= 400) AS good FROM part GROUP BY 1)
    SELECT *, NULL::VARCHAR AS text FROM ({_SECTIONS}) x
    UNION ALL SELECT collection_id, 'links', field, '', 'unresolvable', n::DOUBLE, NULL FROM bad
    UNION ALL SELECT collection_id, 'thumbnail quality', '', '', 'good', good::DOUBLE, round_even(good * 100.0 / sampled, 0)::BIGINT || '% of the '
        || sampled || ' thumbnail images sampled had a width or height of 400 or greater.' FROM images
    UNION ALL SELECT p_type, 'crosswalk', to_field, from_field, 'transforms', NULL, transforms FROM ({_TRANSFORMS}) y
    """,
)
def report_document(spark, sf_dir):
    counts, checked = counted(spark, sf_dir), checked_links(spark, sf_dir)
    # the folder of a mapping text names its collection
    rows = mapping.crosswalk(mapping_lines(spark, sf_dir)).withColumn(
        "collection_id", F.regexp_extract("file_path", "p_type=([^/]+)", 1)
    )
    return report.report_document(counts, checked, thumbnail_quality(spark, sf_dir), rows)


# --- required fields ------------------------------------------------------

_REQUIRED = ("agg_preview", "agg_is_shown_at", "cho_dc_rights", "cho_title")
_MISSING = """
    SELECT source AS collection_id, field, doc_id::VARCHAR AS id FROM (
        SELECT *, 'agg_preview' AS field FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL
        UNION ALL SELECT *, 'cho_dc_rights' FROM documents LEFT JOIN labels USING (doc_id) WHERE toxic IS NULL OR toxic <> 0)
"""


@query("required_fields", _MISSING)
def required_fields(spark, sf_dir):
    return conform.missing_required(mapped_lines(spark, sf_dir), _REQUIRED)


@query(
    "required_field_counts",
    f"""SELECT collection_id, field, count(*) AS n, min(id) AS first_id, max(id) AS last_id
        FROM ({_MISSING}) GROUP BY collection_id, field""",
)
def required_field_counts(spark, sf_dir):
    return conform.missing_counts(conform.missing_required(mapped_lines(spark, sf_dir), _REQUIRED))


@query(
    "record_conformance",
    """
    SELECT o_orderkey, 'required:clerk' AS rule FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED'
    UNION ALL SELECT o_orderkey, 'allowed:o_orderstatus' FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
    UNION ALL SELECT o_orderkey, 'required:clerk:when:o_orderstatus=P' FROM orders
    WHERE o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P'
    """,
)
def record_conformance(spark, sf_dir):
    rules = conform.Rules(
        required=["clerk"], allowed={"o_orderstatus": ["F", "O"]}, required_when=[("clerk", "o_orderstatus", "P")]
    )
    clerk = F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_custkey"))
    return conform.violations(load(spark, sf_dir, "orders").withColumn("clerk", clerk), rules, "o_orderkey")


# --- field inventory and mapping ------------------------------------------

def document_records(spark, sf_dir):
    df = load(spark, sf_dir, "documents").join(load(spark, sf_dir, "labels"), "doc_id", "left")
    one = lambda c: F.when(F.col(c).isNotNull(), F.array(F.col(c).cast("string")))
    toxic = F.when(F.col("toxic") != 0, F.array(F.lit("toxic")))
    return with_fields(df, {"text": one("text"), "lang": one("lang"), "quality": one("quality"), "toxic": toxic})


_INVENTORY = """
    SELECT source, field, count(*) AS n FROM (
        SELECT source, unnest(['text', 'lang']) AS field FROM documents
        UNION ALL SELECT source, 'quality' FROM documents JOIN labels USING (doc_id)
        UNION ALL SELECT source, 'toxic' FROM documents JOIN labels USING (doc_id) WHERE toxic <> 0) GROUP BY ALL
"""


@query("field_inventory", _INVENTORY)
def field_inventory(spark, sf_dir):
    return inventory.field_inventory(document_records(spark, sf_dir), "source")


@query("field_names", f"SELECT DISTINCT field FROM ({_INVENTORY})")
def field_names(spark, sf_dir):
    return inventory.distinct_fields(inventory.field_inventory(document_records(spark, sf_dir), "source"))


@query("field_locator", f"SELECT DISTINCT source FROM ({_INVENTORY}) WHERE field = 'toxic'")
def field_locator(spark, sf_dir):
    return inventory.holding(inventory.field_inventory(document_records(spark, sf_dir), "source"), "source", "toxic")


def mapping_lines(spark, sf_dir):
    """Mapping texts, one per part type, of lines in the usual form, written and read back."""
    path = shared_dir(spark, "mappings")
    part = load(spark, sf_dir, "part")
    name, key = F.replace(F.col("p_name"), F.lit(" "), F.lit("_")), F.col("p_partkey").cast("string")
    line = (
        F.when(F.col("p_size") < 10, F.concat(F.lit("to_field 'cho_title', extract_json('."), name, F.lit("[0]'), strip, prepend('x ')")))
        .when(F.col("p_size") < 20, F.concat(F.lit("to_field 'cho_date', column('"), name, F.lit("'), translation_map('m')")))
        .when(F.col("p_size") < 30, F.concat(F.lit("to_field 'cho_type', literal('"), key, F.lit("'), lang('en')")))
        .when(F.col("p_size") < 35, F.lit("to_field 'cho_edm_type', generate_edm_type"))
        .when(F.col("p_size") < 40, F.concat(F.lit("## "), name))
        .when(F.col("p_size") < 45, F.lit("to_field 'cho_unknown', column('lost')"))
        .otherwise(F.lit(""))
    )
    texts = part.groupBy("p_type", F.floor(F.col("p_partkey") / 1000).alias("block")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", line.alias("line")))), lambda r: r["line"]), "\n").alias("value")
    )
    texts.write.partitionBy("p_type", "block").text(path)
    return scan_mapping_lines(spark, f"{path}/*/*/*.txt")


@query(
    "crosswalk",
    f"""
    WITH w AS ({_TRANSFORMS})
    SELECT from_field, to_field, transforms, count(*) AS n FROM w GROUP BY from_field, to_field, transforms
    """,
)
def crosswalk_rows(spark, sf_dir):
    rows = mapping.crosswalk(mapping_lines(spark, sf_dir))
    return rows.groupBy("from_field", "to_field", "transforms").agg(F.count("*").alias("n"))


@query(
    "mapped_fields",
    """
    SELECT DISTINCT replace(p_name, ' ', '_') AS field FROM part WHERE p_size < 20
    UNION SELECT 'lost' FROM part WHERE p_size BETWEEN 40 AND 44
    """,
)
def mapped_fields(spark, sf_dir):
    return mapping.mapped_fields(mapping_lines(spark, sf_dir)).select("field").distinct()


def part_names(spark, sf_dir):
    """Names of parts that suppliers' lines use, as harvested fields."""
    used = load(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R").select(F.col("l_partkey").alias("p_partkey"))
    names = load(spark, sf_dir, "part").join(used, "p_partkey", "left_semi")
    return names.select(F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.when(F.col("p_size") > 45, F.lit("_xl")).otherwise(F.lit(""))).alias("field"))


_NAMES = """
    h AS (SELECT DISTINCT replace(p_name, ' ', '_') || CASE WHEN p_size > 45 THEN '_xl' ELSE '' END AS field
          FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R')),
    m AS (SELECT DISTINCT replace(p_name, ' ', '_') AS field FROM part WHERE p_size < 20
          UNION SELECT 'lost' FROM part WHERE p_size BETWEEN 40 AND 44),
    i AS (SELECT DISTINCT replace(p_name, ' ', '_') AS field FROM part WHERE p_size BETWEEN 35 AND 39)
"""


@query("unmapped_fields", f"WITH {_NAMES} SELECT field FROM h EXCEPT SELECT field FROM m EXCEPT SELECT field FROM i")
def unmapped_fields(spark, sf_dir):
    lines = mapping_lines(spark, sf_dir)
    return inventory.unmapped(part_names(spark, sf_dir), mapping.mapped_fields(lines), mapping.ignored_in_mapping(lines))


@query("imaginary_fields", f"WITH {_NAMES} SELECT field FROM m EXCEPT SELECT field FROM h")
def imaginary_fields(spark, sf_dir):
    return inventory.imaginary(part_names(spark, sf_dir), mapping.mapped_fields(mapping_lines(spark, sf_dir)))
