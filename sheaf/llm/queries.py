"""Registered queries of the corpus operators, and the SQL they must agree with."""

from __future__ import annotations

import public_tokenizers as TOKENIZERS
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.llm import centroids, chat, embed_dedup, mixing, nearest, packing, private, quality, repair, sharding, shingle_join, token_counts, toxicity
from sheaf.session import settle

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    digests = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("bytes"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )
    placed = sharding.shard_groups(settle(digests), F.col("digest"), F.col("bytes"), ["doc_id", "digest"], shards=8)
    columns = ["doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot"]
    return placed.select(*columns, F.lit(None).cast("int").alias("grown_shard"))


@query
def op10_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = private.find_private(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    base = F.filter("spans", lambda s: s["kind"].isin(*private.KINDS[:4]))
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    named = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size("spans") - F.size(F.array_remove(named, k))).cast("long").alias(f"n_{k}") for k in private.KINDS[:4]]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def piece_digests(packed: DataFrame) -> DataFrame:
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return piece_digests(packing.pack_documents(docs, TOKENIZERS.path("byte_bpe_50k.json"), TOKENIZERS.PATTERN))


@query
def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query
def op2_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_vectors(table(spark, sf_dir, "embeddings"), least=0.98)


@query
def op5_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.shingle_links(table(spark, sf_dir, "documents"), width=3, num=90, den=100)


def held_out(key):
    return F.crc32(key.cast("string").cast("binary")) % 4 == 2


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), held_out=held_out)
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


TARGETS = {
    "lang": {"en": 0.5, "de": 0.2, "fr": 0.15, "es": 0.15},
    "topic": {"prose": 0.85, "table": 0.05, "shout": 0.02, "licence": 0.08},
}
ROUNDS = 20


def topic():
    text = F.col("text")
    form = F.when(text.contains(" | "), "table").when(text.contains("!!"), "shout")
    return form.when(text.contains("License") | text.contains("rights reserved"), "licence").otherwise("prose")


def mixed(docs: DataFrame) -> DataFrame:
    axes = {"lang": F.col("lang"), "topic": topic()}
    tokens = F.floor(F.octet_length(F.coalesce("text", F.lit(""))) / 4) + 1
    return mixing.mix(docs, {a: (axes[a], t) for a, t in TARGETS.items()}, tokens, share=0.5, rounds=ROUNDS, source=F.col("source"), temper=0.5)


def _raking(rounds: int = ROUNDS) -> str:
    """The same fit as SQL: one step per axis and round on the few cells."""
    steps, last = [], "cells"
    for i in range(rounds):
        for axis in ("source", *TARGETS):
            name = f"f{i}_{axis}"
            steps.append(
                f"{name} AS MATERIALIZED (SELECT c.source, c.lang, c.topic, c.t, c.w * coalesce(g.goal / nullif(sum(c.w) OVER (PARTITION BY c.{axis}), 0), 0) AS w "
                f"FROM {last} c JOIN goal_{axis} g ON g.v = c.{axis})"
            )
            last = name
    return ", ".join(steps) + f", fitted AS MATERIALIZED (SELECT * FROM {last})"


def _case(axis: str) -> str:
    named = ", ".join(f"'{v}'" for v in TARGETS[axis] if v != "*")
    return f"CASE WHEN {axis} IN ({named}) THEN {axis} ELSE '*' END"


def _goal(axis: str) -> str:
    """Targets of the values that occur; without a target ``*`` gets the weight that keeps its share of the tokens."""
    rows = ", ".join(f"('{v}', {w}::DOUBLE)" for v, w in TARGETS[axis].items())
    held = f"SELECT {axis} AS v, sum(t) AS t, any_value(x.w) AS w FROM cells LEFT JOIN (VALUES {rows}) x(v, w) ON x.v = {axis} GROUP BY ALL"
    given = f"SELECT v, coalesce(w, coalesce(sum(w) OVER () * t / nullif(sum(t) FILTER (WHERE v <> '*') OVER (), 0), 1.0)) AS w FROM ({held})"
    return f"goal_{axis} AS MATERIALIZED (SELECT v, w / nullif(sum(w) OVER (), 0) AS goal FROM ({given}))"


MIXED_SQL = f"""
WITH formed AS (SELECT doc_id, source, lang, octet_length(encode(coalesce(text, ''))) // 4 + 1 AS tokens,
    CASE WHEN contains(text, ' | ') THEN 'table' WHEN contains(text, '!!') THEN 'shout'
         WHEN contains(text, 'License') OR contains(text, 'rights reserved') THEN 'licence' ELSE 'prose' END AS topic FROM documents),
pooled AS MATERIALIZED (SELECT doc_id, tokens, coalesce('=' || source, '') AS source, {", ".join(f"{_case(a)} AS {a}" for a in TARGETS)} FROM formed),
sums AS (SELECT source, lang, topic, sum(tokens)::DOUBLE AS t FROM pooled GROUP BY ALL),
cells AS MATERIALIZED (SELECT *, t / sum(t) OVER () AS w FROM sums),
goal_source AS MATERIALIZED (SELECT source AS v, sqrt(sum(t)) / sum(sqrt(sum(t))) OVER () AS goal FROM cells GROUP BY source),
{", ".join(_goal(a) for a in TARGETS)}, {_raking()},
ranked AS (SELECT *, w / t AS rate, sum(t) OVER () * 0.5 AS budget, row_number() OVER (ORDER BY w / t DESC) AS k FROM fitted),
levels AS (SELECT *, coalesce(sum(t) OVER before, 0) AS full_t, sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS held_w FROM ranked
    WINDOW before AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
cut AS (SELECT coalesce(min(k) FILTER (WHERE rate <= 0 OR (budget - full_t) * rate <= held_w), 1000000) AS k FROM levels),
scale AS (SELECT (l.budget - l.full_t) / l.held_w AS s FROM levels l JOIN cut USING (k) WHERE l.held_w > 1e-15),
chance AS (SELECT source, lang, topic, w, CASE WHEN rate > 0 THEN least(1.0, coalesce((SELECT s FROM scale), 1e300) * rate) ELSE 0 END AS p FROM levels)
SELECT d.doc_id, d.tokens, round(c.w, 9) AS weight, round(c.p, 9) AS probability FROM pooled d JOIN chance c USING (source, lang, topic)
WHERE ('0x' || substr(md5('mix:' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 < c.p
"""


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixed(table(spark, sf_dir, "documents"))
    return taken.select("doc_id", F.col("_tokens").alias("tokens"), F.round("_weight", 9).alias("weight"), F.round("_probability", 9).alias("probability"))


ORACLES["op9_mixing"] = MIXED_SQL


@query
def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.perspectives(table(spark, sf_dir, "conversations"))


ORACLES["op4_chat"] = """
WITH m AS (SELECT conv_id, turn, coalesce(role, '') AS speaker, coalesce(text, '') AS text FROM conversations),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM m WHERE speaker <> 'system'),
s AS (SELECT m.conv_id, p.perspective, m.turn, m.speaker, m.text,
    CASE WHEN m.speaker = p.perspective THEN '<|assistant|>' WHEN m.speaker = 'system' THEN '<|system|>'
         ELSE '<|user:' || m.speaker || '|>' END || chr(10) AS head FROM m JOIN p ON m.conv_id IS NOT DISTINCT FROM p.conv_id),
r AS (SELECT *, head || text || '<|end|>' || chr(10) AS segment FROM s),
o AS (SELECT *, row_number() OVER w - 1 AS position, (sum(length(segment)) OVER w)::BIGINT AS "end" FROM r
    WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, perspective, position, speaker, segment, "end" - length(segment) AS start, "end",
    CASE WHEN speaker = perspective THEN "end" - length(segment) + length(head) END AS mask_start,
    CASE WHEN speaker = perspective THEN "end" - 1 END AS mask_end FROM o
"""


def left_out(key):
    """A quarter of the trusted documents sets thresholds and is not in the model."""
    return F.crc32(key.cast("string").cast("binary")) % 4 == 1


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    good = table(spark, sf_dir, "labels").where("quality = 1 and doc_id is not null").select("doc_id", F.lit(True).alias("good")).distinct()
    marked = docs.select("doc_id", "text", "lang").join(shingle_join.of_small(settle(good)), "doc_id", "left")
    rated = quality.perplexities(marked, F.col("good"), keep=("lang",), held=left_out(F.col("doc_id")))
    return quality.classify(settle(rated)).select("doc_id", "lang", "perplexity", "threshold", "kept")


_USABLE = "len(embedding) > 0 AND NOT list_has_any([x IS NULL OR isnan(x) OR isinf(x) FOR x IN embedding], [true]) AND list_has_any([x <> 0 FOR x IN embedding], [true])"

ORACLES["op1_nearest"] = f"""
WITH v AS MATERIALIZED (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id IS NOT NULL AND {_USABLE}),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum([q.e[i] * c.e[i] FOR i IN range(1, len(q.e) + 1)]) AS score
      FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, row_number() OVER w::INT AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 20
"""

# Components: every node starts as its own class and takes the least class it is linked with until nothing changes.
_REACHED = """
reached AS (SELECT a AS node, b AS other FROM links UNION SELECT r.node, l.b FROM reached r JOIN links l ON r.other = l.a),
least AS (SELECT node, min(other) AS other FROM reached GROUP BY node)
"""

ORACLES["op2_embed_dedup"] = f"""
WITH RECURSIVE v AS MATERIALIZED (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND {_USABLE}),
links AS MATERIALIZED (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
      WHERE list_cosine_similarity(x.e, y.e) >= 0.98), {_REACHED}
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, least(vec_id, other) AS component_id, least(vec_id, other) = vec_id AS kept
FROM embeddings LEFT JOIN least ON node = vec_id
"""

ORACLES["op5_shingle_join"] = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
        ELSE [words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] FOR i IN range(1, len(words) - 1)] END) AS shingle FROM w),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM shared JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 90 * (na.n + nb.n - k)), {_REACHED}
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, other) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN least ON node = d.doc_id
"""


@query
def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.centroid_clusters(spark, table(spark, sf_dir, "embeddings"), k=40, rounds=5, dims=64, scale=256, salt="2")


def _lloyd(rounds: int = 5) -> str:
    """Rounds of assignment and exact means as SQL; ``a{i}`` assigns all vectors to the centroids ``c{i}``."""
    steps = []
    for i in range(rounds + 1):
        steps.append(
            f"a{i} AS MATERIALIZED (SELECT n, vec_id, e, d.d AS distance, d.k AS cluster FROM (SELECT n, any_value(vec_id) AS vec_id, any_value(e) AS e, "
            f"min({{'d': d, 'k': k}}) AS d FROM (SELECT v.n, v.vec_id, v.e, c.k, list_sum([(v.e[j] - c.e[j]) * (v.e[j] - c.e[j]) FOR j IN range(1, 65)])::BIGINT AS d "
            f"FROM v, c{i} c) GROUP BY n))"
        )
        if i < rounds:
            steps.append(
                f"m{i} AS MATERIALIZED (SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY j) AS e FROM (SELECT cluster AS k, j, sum(x)::BIGINT AS s, count(*) AS n "
                f"FROM (SELECT cluster, unnest(e) AS x, unnest(range(1, 65)) AS j FROM a{i}) GROUP BY ALL) GROUP BY k)"
            )
            steps.append(f"c{i + 1} AS MATERIALIZED (SELECT c.k, coalesce(m.e, c.e) AS e FROM c{i} c LEFT JOIN m{i} m USING (k))")
    return ", ".join(steps)


ORACLES["op11_centroids"] = f"""
WITH f AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings WHERE len(embedding) = 64),
v AS MATERIALIZED (SELECT row_number() OVER () AS n, vec_id, [floor(256 * y)::BIGINT FOR y IN x] AS e FROM f
     WHERE NOT list_has_any([y IS NULL OR isnan(y) OR isinf(y) FOR y IN x], [true])),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, e) - 1 AS k, e FROM (SELECT sha256('2:' || coalesce(vec_id::VARCHAR, '')) AS h, e FROM v) ORDER BY h, e LIMIT 40),
{_lloyd()}
SELECT vec_id, cluster::INT AS cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
    sha256(array_to_string(c5.e, ',')) AS centroid_sha256 FROM a5 JOIN c5 ON c5.k = a5.cluster
"""


@query
def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_digests(repair.damage(table(spark, sf_dir, "conversations")), key="conv_id")


@query
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), TOKENIZERS.path("piece_bpe_32k.model"), limit=4096)
