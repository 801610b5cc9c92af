"""Change detection, reconciliation, incremental harvests and hooks on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheaf.operators import reconcile, snapshots
from sheaf.operators.hooks import run_hook
from sheaf.plans.catalogue import load, query
from sheaf.plans.extract_queries import order_pages
from sheaf.plans.harvest import finish
from sheaf.session import shared_dir
from sheaf.spec import CollectionSpec, FieldFilter, FieldSpec
from sheaf.streaming import incremental

COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]


def order_versions(spark, sf_dir):
    """Orders of now, and of before: customers above 1000 had one status changed, a customer's low orders had other prices, some were missing."""
    now = load(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("collection_id"), *COLUMNS)
    changed = (F.col("collection_id") == "2-HIGH") & (F.col("o_custkey") > 1000)
    before = now.withColumn("o_orderstatus", F.when(changed, F.lit("X")).otherwise(F.col("o_orderstatus")))
    cheaper = (F.col("collection_id") == "4-NOT SPECIFIED") & (F.col("o_custkey") == 7)
    before = before.withColumn("o_totalprice", F.when(cheaper, F.col("o_totalprice") - 1).otherwise(F.col("o_totalprice")))
    gone = (F.col("collection_id") == "5-LOW") & (F.col("o_custkey") < 20)
    return now, before.where(~gone & (F.col("collection_id") != "1-URGENT"))


_BEFORE = """
    before AS (SELECT o_orderpriority AS collection_id, o_orderkey, o_custkey,
                      CASE WHEN o_orderpriority = '2-HIGH' AND o_custkey > 1000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
                      CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_custkey = 7 THEN o_totalprice - 1 ELSE o_totalprice END AS o_totalprice, o_orderdate
               FROM orders WHERE NOT (o_orderpriority = '5-LOW' AND o_custkey < 20) AND o_orderpriority <> '1-URGENT'),
    now AS (SELECT o_orderpriority AS collection_id, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders)
"""


@query(
    "snapshot_differences",
    f"""
    WITH {_BEFORE}
    SELECT *, 'current' AS side, count(*) AS copies FROM (SELECT * FROM now EXCEPT ALL SELECT * FROM before) GROUP BY ALL
    UNION ALL SELECT *, 'previous', count(*) FROM (SELECT * FROM before EXCEPT ALL SELECT * FROM now) GROUP BY ALL
    """,
)
def snapshot_differences(spark, sf_dir):
    return snapshots.differing_rows(*order_versions(spark, sf_dir), group=["collection_id"], key=["o_custkey"])


_DECISIONS = """
    d AS (SELECT collection_id, count(*) AS n FROM (SELECT * FROM now EXCEPT ALL SELECT * FROM before) GROUP BY 1
          UNION ALL SELECT collection_id, 0 FROM (SELECT * FROM before EXCEPT ALL SELECT * FROM now)),
    decided AS (SELECT collection_id, count(*) AS n,
                CASE WHEN collection_id IN (SELECT collection_id FROM d) THEN 'load' ELSE 'skip' END AS decision
                FROM now GROUP BY collection_id)
"""


@query(
    "harvest_decision",
    f"""
    WITH {_BEFORE}, {_DECISIONS} SELECT * FROM decided WHERE collection_id <> '3-MEDIUM'
    UNION ALL SELECT DISTINCT collection_id, 0, 'gone' FROM before WHERE collection_id = '3-MEDIUM'
    """,
)
def harvest_decision(spark, sf_dir):
    """One collection has vanished since."""
    now, before = order_versions(spark, sf_dir)
    return snapshots.decide_load(now.where(F.col("collection_id") != "3-MEDIUM"), before, "collection_id", COLUMNS)


@query(
    "changed_collections",
    f"WITH {_BEFORE}, {_DECISIONS} SELECT * FROM now WHERE collection_id IN (SELECT collection_id FROM decided WHERE decision = 'load')",
)
def changed_collections(spark, sf_dir):
    now, before = order_versions(spark, sf_dir)
    decisions = snapshots.decide_load(now, before, "collection_id", COLUMNS)
    return snapshots.changed_only(now, decisions, "collection_id")


def _digest_sql(columns: list[str]) -> str:
    text = " || chr(31) || ".join(f"coalesce('=' || {c}, '!')" for c in columns)
    return f"sum(('0x' || substr(sha256({text}), 1, 15))::BIGINT)::VARCHAR"


@query(
    "snapshot_digest",
    f"SELECT o_orderstatus, strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n, {_digest_sql(['o_orderkey', 'o_custkey', 'o_totalprice', 'o_orderdate', 'o_orderpriority'])} AS digest"
    " FROM orders GROUP BY 1, 2",
)
def snapshot_digest(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    return snapshots.digests(orders, ["o_orderstatus", "month"], ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"])


def daily_snapshots(spark, sf_dir):
    """Per status one snapshot a day: the priorities of that day's large orders, often none."""
    orders = load(spark, sf_dir, "orders").withColumn("snapshot_ts", F.date_format("o_orderdate", "yyyyMMddHHmmss"))
    large = F.when(F.col("o_totalprice") > 450000, F.col("o_orderpriority"))
    rows = orders.select("o_orderstatus", "snapshot_ts", large.alias("o_orderpriority")).distinct()
    all_stamps = rows.select("o_orderstatus", "snapshot_ts").distinct().withColumn("n0", F.lit(0))
    kept = snapshots.digests(rows.where("o_orderpriority IS NOT NULL"), ["o_orderstatus", "snapshot_ts"], ["o_orderpriority"])
    joined = all_stamps.join(kept, ["o_orderstatus", "snapshot_ts"], "left")
    return joined.select(
        "o_orderstatus", "snapshot_ts", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"), F.coalesce("digest", F.lit("")).alias("digest")
    )


_MONTHLY = f"""
    rows_ AS (SELECT DISTINCT o_orderstatus, strftime(o_orderdate, '%Y%m%d%H%M%S') AS snapshot_ts,
                     CASE WHEN o_totalprice > 450000 THEN o_orderpriority END AS p FROM orders),
    s AS (SELECT o_orderstatus, snapshot_ts, count(p) AS n, coalesce({_digest_sql(['p'])} FILTER (WHERE p IS NOT NULL), '') AS digest
          FROM rows_ GROUP BY 1, 2),
""".replace("::VARCHAR FILTER (WHERE p IS NOT NULL)", " FILTER (WHERE p IS NOT NULL)::VARCHAR")


@query(
    "archive_decision",
    f"""
    WITH {_MONTHLY}
    l AS (SELECT *, last_value(CASE WHEN n > 0 THEN digest END IGNORE NULLS) OVER (PARTITION BY o_orderstatus ORDER BY snapshot_ts
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous FROM s)
    SELECT o_orderstatus, snapshot_ts, n,
           CASE WHEN n = 0 THEN 'empty' WHEN digest = previous THEN 'unchanged' ELSE 'archive' END AS decision FROM l
    """,
)
def archive_decision(spark, sf_dir):
    return snapshots.archive_decisions(daily_snapshots(spark, sf_dir), ["o_orderstatus"]).drop("digest")


@query(
    "archive_write",
    """
    SELECT o_orderkey, o_totalprice, o_orderstatus, strftime(o_orderdate, '%Y%m01000000') AS snapshot_ts FROM orders
    WHERE month(o_orderdate) % 3 = 1
       OR (month(o_orderdate) % 3 = 2 AND (o_orderstatus, strftime(o_orderdate, '%Y-') || quarter(o_orderdate)) NOT IN
           (SELECT (o_orderstatus, strftime(o_orderdate, '%Y-') || quarter(o_orderdate)) FROM orders WHERE month(o_orderdate) % 3 = 1))
    """,
)
def archive_write(spark, sf_dir):
    """Orders by month: of each quarter the first month is new, the second has the same digest, and the third counts as
    empty. The write is run twice, and another one, of second months, has not come to its end."""
    path, key = shared_dir(spark, "archive"), ["o_orderstatus"]
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", F.date_format("o_orderdate", "yyyyMM01000000").alias("snapshot_ts")
    )
    month = F.substring("snapshot_ts", 5, 2).cast("int")
    quarter = F.concat(F.substring("snapshot_ts", 1, 4), F.lit("-"), F.ceil(month / 3).cast("string"))
    counted = orders.groupBy(*key, "snapshot_ts").agg(F.count("*").alias("n"))
    small = counted.withColumns({"n": F.when(month % 3 == 0, 0).otherwise(F.col("n")), "digest": quarter})
    decisions = snapshots.archive_decisions(small, key)
    for _ in range(2):
        snapshots.archive(orders, decisions, key, path)
    torn = orders.where(month % 3 == 2).join(decisions.where("decision = 'unchanged'").select(*key, "snapshot_ts"), [*key, "snapshot_ts"], "left_semi")
    torn.hint("rebalance", *key, "snapshot_ts").write.mode("append").partitionBy(*key, "snapshot_ts").parquet(f"{path}/rows")
    return snapshots.archived(spark, path, key).select("o_orderkey", "o_totalprice", "o_orderstatus", "snapshot_ts")


@query(
    "archive_newest",
    "SELECT o_orderstatus, max(strftime(o_orderdate, '%Y%m%d%H%M%S')) AS snapshot_ts FROM orders GROUP BY 1",
)
def archive_newest(spark, sf_dir):
    return snapshots.newest(daily_snapshots(spark, sf_dir), ["o_orderstatus"])


@query(
    "count_reconcile",
    """
    WITH h AS (SELECT o_custkey AS collection_id, count(*) AS harvested FROM orders GROUP BY 1),
    m AS (SELECT o_custkey AS collection_id, count(*) AS mapped FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1),
    f AS (SELECT c_custkey AS collection_id, CASE c_mktsegment WHEN 'BUILDING' THEN '/2' WHEN 'MACHINERY' THEN '-2'
                 WHEN 'FURNITURE' THEN '+2' WHEN 'HOUSEHOLD' THEN '/0' END AS formula FROM customer),
    j AS (SELECT collection_id, coalesce(harvested, 0)::BIGINT AS harvested, coalesce(mapped, 0)::BIGINT AS mapped, formula
          FROM h FULL JOIN m USING (collection_id) LEFT JOIN f USING (collection_id)),
    e AS (SELECT collection_id, harvested, mapped, (CASE formula WHEN '/2' THEN harvested / 2 WHEN '-2' THEN harvested - 2
                 WHEN '+2' THEN harvested + 2 WHEN '/0' THEN 0 ELSE harvested END)::DOUBLE AS expected FROM j)
    SELECT *, CASE WHEN expected = mapped THEN 'ok' ELSE 'failed' END AS status FROM e
    """,
)
def count_reconcile(spark, sf_dir):
    harvested = load(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "collection_id")
    mapped = harvested.where(F.col("o_orderstatus") != "F")
    segment = F.col("c_mktsegment")
    formula = F.when(segment == "BUILDING", "/2").when(segment == "MACHINERY", "-2").when(segment == "FURNITURE", "+2").when(segment == "HOUSEHOLD", "/0")
    formulas = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("collection_id"), formula.alias("formula"))
    return reconcile.reconcile(harvested, mapped, formulas)


# --- incremental ----------------------------------------------------------

def stamped_events(spark, sf_dir):
    return load(spark, sf_dir, "events").select(F.col("event_type").alias("collection_id"), "event_id", F.to_date("ts").alias("datestamp"))


@query("incremental_since", "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-20 00:00:00'")
def incremental_since(spark, sf_dir):
    spec = CollectionSpec("events", "oai_xml")
    df = load(spark, sf_dir, "events")
    return incremental.changed_since(df, F.col("ts"), spec, "2024-01-20 15:30:00").select("event_id")


@query(
    "incremental_by_state",
    """
    WITH s AS (SELECT event_type, max(ts) FILTER (WHERE value < 0.5) AS last_start FROM events GROUP BY 1)
    SELECT event_id, event_type AS collection_id FROM events JOIN s USING (event_type)
    WHERE last_start IS NULL OR event_type = 'view' OR ts::DATE >= last_start::DATE
    """,
)
def incremental_by_state(spark, sf_dir):
    state = load(spark, sf_dir, "events").groupBy(F.col("event_type").alias("collection_id")).agg(
        F.max(F.when(F.col("value") < 0.5, F.col("ts"))).alias("last_start")
    )
    state = state.withColumn("full_harvest", F.col("collection_id") == "view")
    return incremental.changed_since_state(stamped_events(spark, sf_dir), state).select("event_id", "collection_id")


@query(
    "stream_upsert",
    """
    SELECT user_id, arg_min(event_id, event_id) AS event_id, arg_min(event_type, event_id) AS event_type
    FROM events GROUP BY user_id
    """,
)
def stream_upsert(spark, sf_dir):
    base = shared_dir(spark, "stream")
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    source = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    records = source.select("user_id", "event_id", "event_type")
    incremental.stream_upsert(records, f"{base}/log", f"{base}/checkpoint", ["user_id"], ["event_id"])
    return incremental.current_records(spark, f"{base}/log", ["user_id"])


@query(
    "stream_harvest",
    """
    WITH p AS (SELECT o_orderkey // 50 AS seq, max(o_totalprice) > 499000 AS failed FROM orders GROUP BY 1)
    SELECT o_orderkey::VARCHAR AS id, o_custkey::VARCHAR AS first_code FROM orders JOIN p ON o_orderkey // 50 = seq WHERE NOT failed
    """,
)
def stream_harvest(spark, sf_dir):
    base = shared_dir(spark, "landed")
    landed = order_pages(spark, sf_dir)
    landed.write.parquet(f"{base}/payloads")
    spec = CollectionSpec(
        "orders", "custom_json", {"id": FieldSpec("id"), "first_code": FieldSpec("parts[0].codes[1]")}, "content.results"
    )
    source = spark.readStream.schema(landed.schema).parquet(f"{base}/payloads")
    incremental.stream_harvest(source, spec, ["id", "first_code"], f"{base}/log", f"{base}/checkpoint")
    current = incremental.current_records(spark, f"{base}/log", ["harvest_id", "id"])
    return current.select("id", F.get("first_code", F.lit(0)).alias("first_code"))


@query("stream_first_seen", "SELECT DISTINCT user_id, event_type, 1::BIGINT AS n FROM events")
def stream_first_seen(spark, sf_dir):
    base = shared_dir(spark, "seen")
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    source = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    stamped = source.select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    first = incremental.first_within_delay(stamped, ["user_id", "event_type"], "ts", "60 days")
    query_ = (
        first.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True).start()
    )
    query_.awaitTermination()
    return spark.read.parquet(f"{base}/out").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


@query("require_rows", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 400000")
def some_rows(spark, sf_dir):
    large = load(spark, sf_dir, "orders").where("o_totalprice > 400000").select("o_orderkey", "o_totalprice")
    try:
        reconcile.require_rows(large.where("o_totalprice < 0"))
    except ValueError:
        return reconcile.require_rows(large)
    raise AssertionError("an empty table was accepted")


# --- hooks and the whole harvest ------------------------------------------

@query(
    "post_harvest",
    """
    WITH l AS (SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) // 4 AS part FROM conversations),
    f AS (SELECT conv_id, arg_min(conv_id || '-' || turn, turn) AS id FROM l GROUP BY conv_id)
    SELECT conv_id::VARCHAR AS locator, id, part::BIGINT AS part, string_agg(role, '|' ORDER BY turn) AS roles
    FROM l JOIN f USING (conv_id) GROUP BY ALL
    """,
)
def post_harvest(spark, sf_dir):
    df = load(spark, sf_dir, "conversations").select(
        F.array(F.col("conv_id").cast("string")).alias("shelf"), F.concat("conv_id", F.lit("-"), "turn").alias("id"), "turn",
        F.array("role").alias("role"),
    )
    spec = CollectionSpec.from_dict("talks", {"driver": "custom_json", "metadata": {
        "post_harvest": "merge_records", "post_harvest_arguments": {"locator": "shelf", "order": ["turn"], "part_items": 4}}})
    merged = run_hook(df, spec)
    return merged.select("locator", "id", "part", F.array_join("role", "|").alias("roles"))


@query(
    "harvest_finish",
    """
    WITH f AS (SELECT doc_id, text, lang, source FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1)
    SELECT doc_id AS seq, lang, source FROM f WHERE lang IN ('en', 'fr') AND source NOT IN ('src1', 'src2')
    """,
)
def harvest_finish(spark, sf_dir):
    spec = CollectionSpec(
        "docs", "custom_json", fields={"id": FieldSpec("id", name_in_table="Record Text")},
        filters={"lang": FieldFilter(include=("en", "fr")), "source": FieldFilter(exclude=("src1", "src2"))},
    )
    df = load(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("seq"), F.lit(0).alias("pos"), F.array("text").alias("Record Text"), "lang", "source"
    )
    return finish(df, spec).select("seq", "lang", "source")
