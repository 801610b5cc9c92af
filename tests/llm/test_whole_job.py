"""Cases in which an operator once did less than the whole job."""

from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from sheaf.llm import embed_dedup, mixing, quality, queries, shingle_join


def plain_links(texts, width, num, den):
    """Pairs of keys whose sets of ``width`` words are linked."""
    sets = []
    for key, text in texts:
        words = text.lower().split()
        wide = min(width, len(words))
        sets.append((key, {tuple(words[k : k + wide]) for k in range(len(words) - wide + 1)}))
    return {(a, b) for a, s in sets for b, t in sets if a < b and den * len(s & t) >= num * len(s | t)}


def test_sets_on_both_sides_of_the_size_limit_meet(spark):
    rng = np.random.default_rng(3)
    texts = []
    for n, more in ((232, 58), (240, 49), (258, 31), (259, 60), (288, 1), (288, 72), (289, 70), (231, 57), (231, 58)):
        words = [f"w{rng.integers(10**9)}" for _ in range(n + more + 4)]
        texts += [(len(texts), " ".join(words[: n + 4])), (len(texts) + 1, " ".join(words))]  # n and n + more shingles of 5 words
    wanted = plain_links(texts, 5, 80, 100)
    rows = shingle_join.shingle_links(spark.createDataFrame(texts, "doc_id long, text string"), width=5, num=80, den=100).collect()
    assert {(r["component_id"], r["doc_id"]) for r in rows if r["component_id"] != r["doc_id"]} == wanted and len(wanted) == 8


def test_few_sets_need_the_comparison_by_size(spark):
    """The share of tokens that long sets send is well above the prefix at any similarity."""
    rng = np.random.default_rng(5)
    for num in (50, 80, 90):
        long, halved = shingle_join.sizes(num, 100)
        assert 100 * (long - 1) < num * (shingle_join.SHORT + 1)
        chosen = rng.binomial(long, 0.5**halved, 20_000)
        assert (chosen < shingle_join.lacking(long, num, 100)).mean() < 1e-3


def test_mixing_keeps_languages_without_a_target(spark):
    rows = [(i, ["it", None, "en", "de"][i % 4], f"src{i % 3}", "word " * 20) for i in range(8000)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")
    out = queries.mixed(docs).collect()
    total = sum(r["_tokens"] for r in out)
    assert abs(len(out) / len(rows) - 0.5) < 0.03
    assert abs(sum(r["_tokens"] for r in out if r["lang"] in ("it", None)) / total - 0.5) < 0.03
    foreign = docs.where("lang = 'it' or lang is null")
    assert abs(queries.mixed(foreign).count() / 4000 - 0.5) < 0.03
    asked = {"lang": (F.col("lang"), {"en": 0.5, "de": 0.5, "*": 0.0})}
    assert {r["lang"] for r in mixing.mix(docs, asked, F.lit(1)).collect()} == {"en", "de"}


def test_mixing_rakes_every_source_as_its_sql(spark, tmp_path):
    """A hot source of another name, a null source, a fifth language, and a source of one row."""
    rng = np.random.default_rng(5)
    source = ["hot" if x < 0.4 else None if x < 0.45 else f"s{int(x * 40)}" for x in rng.random(3000)] + ["one"]
    lang = [["en", "de", "fr", "es", "it", None][i] for i in rng.integers(0, 6, 3001)]
    text = [["plain", "a | b", "wow!!", "License", None][i] for i in rng.integers(0, 5, 3001)]
    rows = [(i, t and (t + " word") * (1 + i % 40), a, s, 0) for i, (t, a, s) in enumerate(zip(text, lang, source))]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op9_mixing(spark, str(tmp_path)).collect()
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    wanted = {r[0]: r[1:] for r in duck.sql(queries.ORACLES["op9_mixing"]).fetchall()}
    assert {r["doc_id"]: (r["tokens"], r["weight"], r["probability"]) for r in out} == wanted and len(wanted) > 1000
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    axes = {"lang": (F.col("lang"), queries.TARGETS["lang"])}
    every = mixing.mix(docs, axes, F.floor(F.length(F.coalesce("text", F.lit(""))) / 4) + 1, share=9.0, source=F.col("source")).collect()
    assert len(every) == len(rows)
    cells, before = {}, Counter()
    for r in every:
        cells[r["source"], r["lang"] if r["lang"] in queries.TARGETS["lang"] else "*"] = r["_weight"]
        before[r["source"]] += r["_tokens"]
    goal, reached = {s: t**0.5 for s, t in before.items()}, Counter()
    for (s, _), w in cells.items():
        reached[s] += w
    for s in set(reached) - {"one"}:  # a source of one row has one language
        assert reached[s] == pytest.approx(goal[s] / sum(goal.values()), rel=0.01)


@pytest.mark.parametrize("common, whole", [(0.9, False), (0.99, True)])
def test_near_vectors_with_a_common_mean(spark, common, whole):
    """Random vectors have a cosine of about ``common``; pairs are planted at a cosine of just over 0.98."""
    rng = np.random.default_rng(17)
    middle = np.full(64, 1 / 8)
    x = rng.standard_normal((1500, 64)) * np.sqrt((1 - common) / 64) + np.sqrt(common) * middle
    x /= np.linalg.norm(x, axis=1)[:, None]
    side = rng.standard_normal(x.shape)
    side -= (side * x).sum(axis=1)[:, None] * x
    side /= np.linalg.norm(side, axis=1)[:, None]
    vectors = np.vstack([x, 0.9801 * x + np.sqrt(1 - 0.9801**2) * side])
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    label = np.arange(len(unit)) % 1500 % 10
    links = (unit @ unit.T >= 0.98) & (label[:, None] == label[None, :])
    wanted = links.sum(axis=1) - 1
    rows = [(i, v.tolist(), int(g)) for i, (v, g) in enumerate(zip(vectors, label))]
    out = embed_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), least=0.98)
    found = np.array([r["n_links"] for r in sorted(out.collect(), key=lambda r: r["vec_id"])])
    assert (found <= wanted).all() and found.sum() >= (1 if whole else 0.98) * wanted.sum() > 2900


def test_quality_keeps_good_documents_it_has_not_seen(spark, tmp_path):
    """Half of the good documents carry no label; thresholds come from labelled ones left out of the model."""
    rng = np.random.default_rng(3)
    words = np.array(["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(400)])
    rows = [(i, " ".join(rng.choice(words, 30)), "en") for i in range(1200)]
    rows += [(i, "".join(rng.choice(list("qxz# 0"), 180)), "en") for i in range(1200, 1260)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, 0) for i in range(600)] + [(i, 0, 0) for i in range(1200, 1210)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = {r["doc_id"]: r for r in queries.op7_quality(spark, str(tmp_path)).collect()}
    assert len(out) == len(rows) and not any(out[i]["kept"] for i in range(1200, 1260))
    assert np.mean([out[i]["kept"] for i in range(600, 1200)]) > 0.97


def test_quality_is_the_same_however_the_texts_are_split(spark, monkeypatch):
    rows = [(i, "some good text here " * (i % 7) if i % 11 else None, "en") for i in range(300)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = []
    for parts, shelf, block in ((1, 4_000_000, 32_000_000), (7, 500, 1000)):
        monkeypatch.setattr(quality, "SHELF", shelf)
        monkeypatch.setattr(quality, "BLOCK", block)
        rated = quality.perplexities(table.repartition(parts), F.col("doc_id") % 3 == 0, keep=("lang",), held=F.col("doc_id") % 6 == 0)
        seen.append({r["doc_id"]: (r["trusted"], r["held"], round(r["perplexity"], 4)) for r in rated.collect()})
    assert seen[0] == seen[1] and len(seen[0]) == 300
