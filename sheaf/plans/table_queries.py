"""Table scans, cleaning, filters, de-duplication, merges and joins on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheaf.functions.lists import scalar_or_list
from sheaf.operators.clean import drop_empty, drop_null, falsy_to_null
from sheaf.operators.dedupe import first_per_key
from sheaf.operators.filters import apply_filters
from sheaf.operators.inventory import values_by_group
from sheaf.operators.joins import join_on_id
from sheaf.operators.merge import merge_lists, merged_values
from sheaf.operators.paging import limit_by_page, limit_records
from sheaf.operators.records import scalar_id
from sheaf.operators.serials import split_serials
from sheaf.plans.catalogue import load, query
from sheaf.session import shared_dir
from sheaf.sources.ndjson import scan_ndjson
from sheaf.sources.tabular import dotted, scan_csv, scan_delimited, scan_json_array, union_widen, write_csv, write_json
from sheaf.spec import FieldFilter


@query(
    "scan_csv",
    """
    SELECT c_custkey, c_name, c_nationkey, c_acctbal::DECIMAL(18, 2) AS c_acctbal, c_mktsegment FROM customer
    """,
)
def scan_csv_typed(spark, sf_dir):
    path = shared_dir(spark, "customers")
    write_csv(load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"), path)
    return scan_csv(spark, path, schema="c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DECIMAL(18,2), c_mktsegment STRING")


@query(
    "scan_csv_multi",
    """
    SELECT 0::BIGINT AS file_idx, c_custkey::VARCHAR AS id, c_name AS name, c_mktsegment AS segment, '-' AS nation
    FROM customer WHERE c_mktsegment = 'BUILDING'
    UNION ALL
    SELECT 1, c_custkey::VARCHAR, c_name, c_mktsegment, '-' FROM customer WHERE c_mktsegment <> 'BUILDING'
    UNION ALL
    SELECT 2, s_suppkey::VARCHAR, s_name, '-', s_nationkey::VARCHAR FROM supplier
    """,
)
def scan_csv_multi(spark, sf_dir):
    base = shared_dir(spark, "mixed")
    customers = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = load(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")
    )
    write_csv(customers.where("segment = 'BUILDING'"), f"{base}/one.csv")
    write_csv(customers.where("segment <> 'BUILDING'"), f"{base}/two.csv")
    suppliers.write.options(header=True, sep="\t").csv(f"{base}/three.tsv")
    table = scan_delimited(spark, [f"{base}/one.csv", f"{base}/two.csv", f"{base}/three.tsv"])
    absent = F.lit("-")
    return table.select(
        "file_idx", "id", "name", F.coalesce("segment", absent).alias("segment"), F.coalesce("nation", absent).alias("nation")
    )


@query(
    "write_csv_lists",
    """
    SELECT p_partkey::VARCHAR AS p_partkey, '["' || p_brand || '","' || p_type || '"]' AS tags, p_name FROM part
    """,
)
def write_csv_lists(spark, sf_dir):
    path = shared_dir(spark, "parts")
    write_csv(load(spark, sf_dir, "part").select("p_partkey", F.array("p_brand", "p_type").alias("tags"), "p_name"), path)
    return scan_csv(spark, path)


@query(
    "scan_json_array",
    """
    SELECT c_custkey::VARCHAR AS id, c_name AS name, c_nationkey::VARCHAR AS nation FROM customer
    """,
)
def scan_json_array_docs(spark, sf_dir):
    path = shared_dir(spark, "arrays")
    record = F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    # one array document per block of at most 1000 customers
    blocks = load(spark, sf_dir, "customer").groupBy(F.floor(F.col("c_custkey") / 1000).alias("block")).agg(
        F.to_json(F.collect_list(record)).alias("value")
    )
    blocks.write.partitionBy("block").text(path)
    return scan_json_array(spark, f"{path}/*/*.txt").select("id", "name", "nation")


@query(
    "scan_ndjson",
    """
    SELECT o_orderkey::VARCHAR AS id, o_orderstatus AS status,
           CASE WHEN o_orderpriority = '1-URGENT' THEN 'null' ELSE o_orderpriority END AS priority
    FROM orders
    """,
)
def scan_ndjson_lines(spark, sf_dir):
    path = shared_dir(spark, "orders")
    priority = F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderpriority"))
    write_json(load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", priority.alias("priority")), path)
    doc = scan_ndjson(spark, path).select(F.try_parse_json("value").alias("doc"))
    priority_text = F.try_variant_get("doc", "$.priority", "string")
    return doc.select(
        F.try_variant_get("doc", "$.o_orderkey", "string").alias("id"),
        F.try_variant_get("doc", "$.o_orderstatus", "string").alias("status"),
        F.coalesce(priority_text, F.lit("null")).alias("priority"),
    )


@query(
    "falsy_to_null",
    """
    SELECT d.doc_id, coalesce(nullif(l.quality, 0)::VARCHAR, 'null') AS quality,
           coalesce(nullif(l.toxic, 0)::VARCHAR, 'null') AS toxic, coalesce(nullif(d.lang, ''), 'null') AS lang
    FROM documents d LEFT JOIN labels l USING (doc_id)
    """,
)
def falsy_cells(spark, sf_dir):
    df = load(spark, sf_dir, "documents").join(load(spark, sf_dir, "labels"), "doc_id", "left")
    cleaned = falsy_to_null(df.select("doc_id", "quality", "toxic", "lang"), ["quality", "toxic", "lang"])
    shown = [F.coalesce(F.col(c).cast("string"), F.lit("null")).alias(c) for c in ("quality", "toxic", "lang")]
    return cleaned.select("doc_id", *shown)


@query(
    "drop_empty_records",
    """
    SELECT d.doc_id FROM documents d LEFT JOIN labels l USING (doc_id)
    WHERE coalesce(l.quality, 0) <> 0 OR coalesce(l.toxic, 0) <> 0
    """,
)
def drop_empty_records(spark, sf_dir):
    df = load(spark, sf_dir, "documents").join(load(spark, sf_dir, "labels"), "doc_id", "left")
    return drop_empty(df, ["quality", "toxic"]).select("doc_id")


@query("drop_null_rows", "SELECT doc_id, quality FROM documents JOIN labels USING (doc_id)")
def drop_null_rows(spark, sf_dir):
    df = load(spark, sf_dir, "documents").join(load(spark, sf_dir, "labels"), "doc_id", "left")
    return drop_null(df, "quality").select("doc_id", "quality")


@query(
    "dedupe_first",
    """
    SELECT doc_id, source, lang FROM documents
    QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1
    """,
)
def dedupe_first(spark, sf_dir):
    return first_per_key(load(spark, sf_dir, "documents"), ["text"], ["doc_id"]).select("doc_id", "source", "lang")


@query(
    "dedupe_null_ids",
    """
    SELECT doc_id, lang FROM documents LEFT JOIN labels USING (doc_id)
    QUALIFY row_number() OVER (PARTITION BY lang, quality ORDER BY doc_id) = 1
    """,
)
def dedupe_null_ids(spark, sf_dir):
    df = load(spark, sf_dir, "documents").join(load(spark, sf_dir, "labels"), "doc_id", "left")
    return first_per_key(df, ["lang", "quality"], ["doc_id"]).select("doc_id", "lang")


@query("id_first_of_list", "SELECT l_orderkey::VARCHAR AS id, l_linenumber FROM lineitem")
def id_first_of_list(spark, sf_dir):
    ids = F.array(F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string"))
    return scalar_id(load(spark, sf_dir, "lineitem").select(ids.alias("id"), "l_linenumber"), "id")


@query(
    "union_widen",
    """
    SELECT c_name AS name, c_nationkey AS nation, c_mktsegment AS segment, '-' AS kind FROM customer
    UNION ALL SELECT s_name, s_nationkey, '-', 'supplier' FROM supplier
    """,
)
def union_wide(spark, sf_dir):
    customers = load(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = load(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), F.lit("supplier").alias("kind")
    )
    df = union_widen([customers, suppliers])
    return df.select("name", "nation", *[F.coalesce(c, F.lit("-")).alias(c) for c in ("segment", "kind")])


@query(
    "limit_ordered",
    "SELECT event_id, user_id, event_type FROM events ORDER BY event_id LIMIT 500",
)
def limit_ordered(spark, sf_dir):
    df = load(spark, sf_dir, "events").withColumn("seq", F.floor(F.col("event_id") / 100))
    return limit_records(df, 500, ["seq", "event_id"]).select("event_id", "user_id", "event_type")


@query(
    "limit_by_page",
    """
    SELECT event_type AS harvest_id, event_id FROM events
    QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id) <= 300
    """,
)
def limit_pages(spark, sf_dir):
    records = load(spark, sf_dir, "events").select(
        F.col("event_type").alias("harvest_id"),
        F.floor(F.col("event_id") / 100).alias("seq"),
        F.col("event_id").alias("pos"),
        "event_id",
    )
    return limit_by_page(records, 300).select("harvest_id", "event_id")


@query(
    "filter_include",
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'P')",
)
def filter_include(spark, sf_dir):
    kept = apply_filters(load(spark, sf_dir, "orders"), {"o_orderstatus": FieldFilter(include=("F", "P"))})
    return kept.select("o_orderkey", "o_orderstatus")


@query(
    "filter_multi",
    """
    SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
    WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority NOT IN ('1-URGENT', '5-LOW')
    """,
)
def filter_multi(spark, sf_dir):
    rules = {
        "o_orderstatus": FieldFilter(include=("F", "O")),
        "o_orderpriority": FieldFilter(exclude=("1-URGENT", "5-LOW")),
    }
    return apply_filters(load(spark, sf_dir, "orders"), rules).select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query(
    "filter_exclude_nulls",
    """
    SELECT d.doc_id, coalesce(l.quality::VARCHAR, 'null') AS quality
    FROM documents d LEFT JOIN labels l USING (doc_id)
    WHERE l.quality IS NULL OR l.quality::VARCHAR NOT IN ('0')
    """,
)
def filter_exclude_nulls(spark, sf_dir):
    df = load(spark, sf_dir, "documents").join(load(spark, sf_dir, "labels"), "doc_id", "left")
    df = df.withColumn("quality", F.col("quality").cast("string"))
    kept = apply_filters(df, {"quality": FieldFilter(exclude=("0",))})
    return kept.select("doc_id", F.coalesce("quality", F.lit("null")).alias("quality"))


def _daily_types(spark, sf_dir):
    # the list of a group holds distinct event types, of which there are five
    days = load(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("day"))
    return days.agg(F.sort_array(F.collect_set("event_type")).alias("types"))


_DAILY_SQL = """
    SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, list_sort(list(DISTINCT event_type)) AS types
    FROM events GROUP BY ALL
"""


@query(
    "filter_exclude_superset",
    f"""
    SELECT user_id, day, array_to_string(types, ',') AS types FROM ({_DAILY_SQL})
    WHERE NOT list_has_all(types, ['click', 'error'])
    """,
)
def filter_exclude_superset(spark, sf_dir):
    kept = apply_filters(_daily_types(spark, sf_dir), {"types": FieldFilter(exclude=("click", "error"))})
    return kept.select("user_id", F.col("day").cast("string").alias("day"), F.array_join("types", ",").alias("types"))


@query(
    "filter_include_array",
    f"""
    SELECT user_id, day, array_to_string(types, ',') AS types FROM ({_DAILY_SQL})
    WHERE list_has_any(types, ['signup', 'view'])
    """,
)
def filter_include_array(spark, sf_dir):
    kept = apply_filters(_daily_types(spark, sf_dir), {"types": FieldFilter(include=("signup", "view"))})
    return kept.select("user_id", F.col("day").cast("string").alias("day"), F.array_join("types", ",").alias("types"))


def _language_versions(spark, sf_dir):
    return load(spark, sf_dir, "conversations").select(
        F.array(F.col("conv_id").cast("string")).alias("locator_list"),
        F.concat("conv_id", F.lit("-"), "turn").alias("id"),
        "turn",
        F.array("role").alias("role"),
        F.split("text", "\n").alias("text"),
    )


@query(
    "merge_lists",
    """
    SELECT conv_id::VARCHAR AS locator, arg_min(conv_id || '-' || turn, turn) AS id, 0::BIGINT AS part,
           string_agg(role, '|' ORDER BY turn) AS roles,
           md5(string_agg(replace(text, chr(10), '|'), '|' ORDER BY turn)) AS text_md5
    FROM conversations GROUP BY conv_id
    """,
)
def merge_versions(spark, sf_dir):
    merged = merge_lists(_language_versions(spark, sf_dir), "locator_list", "id", ["turn"], ["role", "text"])
    return merged.select("locator", "id", "part", F.array_join("role", "|").alias("roles"), F.md5(F.array_join("text", "|")).alias("text_md5"))


@query(
    "merge_large_locators",
    """
    WITH l AS (SELECT l_returnflag AS locator, l_orderkey || '-' || l_linenumber AS id, l_partkey::VARCHAR AS part_key, l_linestatus AS state,
                      row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey::VARCHAR, l_linestatus) - 1 AS n FROM lineitem),
    f AS (SELECT locator, id FROM l WHERE n = 0),
    p AS (SELECT locator, n // 500 AS part, md5(string_agg(part_key || ',' || state, ',' ORDER BY n)) AS parts_md5 FROM l GROUP BY ALL),
    s AS (SELECT locator, n // 1000 AS part, string_agg(state, '' ORDER BY n) AS states FROM l GROUP BY ALL)
    SELECT p.locator, f.id, p.part::BIGINT AS part, p.parts_md5, coalesce(s.states, '') AS states
    FROM p JOIN f USING (locator) LEFT JOIN s ON s.locator = p.locator AND s.part = p.part
    """,
)
def merge_large_locators(spark, sf_dir):
    """Three locators that hold all line items, merged into lists of at most 1000 values."""
    lines = load(spark, sf_dir, "lineitem").select(
        F.array("l_returnflag").alias("flags"), F.concat("l_orderkey", F.lit("-"), "l_linenumber").alias("id"), "l_orderkey", "l_linenumber",
        F.array(F.col("l_partkey").cast("string"), "l_linestatus").alias("parts"), F.array("l_linestatus").alias("state"),
    )
    merged = merge_lists(lines, "flags", "id", ["l_orderkey", "l_linenumber"], ["parts", "state"], part_items=1000)
    return merged.select("locator", "id", "part", F.md5(F.array_join("parts", ",")).alias("parts_md5"), F.array_join("state", "").alias("states"))


@query(
    "merge_lists_parted",
    """
    WITH l AS (SELECT l_returnflag AS locator, l_orderkey || '-' || l_linenumber AS id, l_orderkey, l_linenumber, l_partkey::VARCHAR AS part, l_linestatus FROM lineitem),
    f AS (SELECT locator, arg_min(id, (l_orderkey, l_linenumber)) AS id FROM l GROUP BY 1)
    SELECT l.locator, f.id, v.c AS "column", l.l_orderkey, l.l_linenumber, v.item::INT AS item, v.value
    FROM l JOIN f USING (locator), LATERAL (VALUES ('parts', 0, l.part), ('parts', 1, l.l_linestatus), ('state', 0, l.l_linestatus)) v(c, item, value)
    """,
)
def merge_large_groups(spark, sf_dir):
    """Three locators that hold all line items: the long form, whose shape does not depend on a locator's size."""
    versions = load(spark, sf_dir, "lineitem").select(
        F.array("l_returnflag").alias("flags"),
        F.concat("l_orderkey", F.lit("-"), "l_linenumber").alias("id"),
        "l_orderkey",
        "l_linenumber",
        F.array(F.col("l_partkey").cast("string"), "l_linestatus").alias("parts"),
        F.array("l_linestatus").alias("state"),
    )
    return merged_values(versions, "flags", "id", ["l_orderkey", "l_linenumber"], ["parts", "state"])


def serial_records(spark, sf_dir):
    """Orders as serials: one shared field and as many issues as the priority digit, less one."""
    issues = F.substring("o_orderpriority", 1, 1).cast("int") - 1
    numbers = F.when(issues > 0, F.sequence(F.lit(1), issues)).otherwise(F.array().cast("array<int>"))
    return load(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(
            F.array(F.create_map(F.lit("245"), F.col("o_orderstatus"))),
            F.transform(numbers, lambda i: F.create_map(F.lit("974"), F.concat(F.lit("issue "), i.cast("string")))),
            F.array(F.create_map(F.lit("900"), F.col("o_custkey").cast("string"))),
        ).alias("fields"),
    )


@query(
    "split_serials",
    """
    SELECT o_orderkey, i::INT AS issue_no,
           '[{"245":"' || o_orderstatus || '"},{"900":"' || o_custkey || '"},{"974":"issue ' || (i + 1) || '"}]' AS fields
    FROM orders, unnest(range(substr(o_orderpriority, 1, 1)::INT - 1)) AS t(i)
    """,
)
def split_issues(spark, sf_dir):
    return split_serials(serial_records(spark, sf_dir)).withColumn("fields", F.to_json("fields"))


@query(
    "join_sources",
    """
    SELECT d.doc_id AS id, d.lang AS note_x, l.toxic::VARCHAR AS note_y, d.source, l.quality
    FROM documents d JOIN labels l USING (doc_id)
    """,
)
def join_sources(spark, sf_dir):
    left = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("note"), "source")
    right = load(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"), F.col("toxic").cast("string").alias("note"), "quality"
    )
    return join_on_id(left, right)


@query(
    "values_by_group",
    "SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL",
)
def group_values(spark, sf_dir):
    return values_by_group(load(spark, sf_dir, "events"), "user_id", "event_type")


@query(
    "nested_to_columns",
    """
    SELECT l_orderkey AS "line.order", l_partkey AS "line.part.key", l_suppkey AS "line.part.supplier", l_linenumber
    FROM lineitem
    """,
)
def nested_to_columns(spark, sf_dir):
    part = F.struct(F.col("l_partkey").alias("key"), F.col("l_suppkey").alias("supplier"))
    line = F.struct(F.col("l_orderkey").alias("order"), part.alias("part"))
    return dotted(load(spark, sf_dir, "lineitem").select(line.alias("line"), "l_linenumber"))


@query(
    "scalar_or_list",
    """
    SELECT o_orderkey, CASE
        WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN '-'
        WHEN o_orderstatus = 'F' THEN o_orderpriority
        WHEN o_orderpriority = '5-LOW' THEN o_orderstatus
        ELSE '["' || o_orderpriority || '","' || o_orderstatus || '"]' END AS value
    FROM orders
    """,
)
def scalar_or_list_view(spark, sf_dir):
    low, done = F.col("o_orderpriority") == "5-LOW", F.col("o_orderstatus") == "F"
    values = F.array_compact(F.array(F.when(~low, F.col("o_orderpriority")), F.when(~done, F.col("o_orderstatus"))))
    return load(spark, sf_dir, "orders").select("o_orderkey", F.coalesce(scalar_or_list(values), F.lit("-")).alias("value"))
