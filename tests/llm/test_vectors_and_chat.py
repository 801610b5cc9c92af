"""Vector operators against all pairs, chat formatting, and the pipeline."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from sheaf.llm import chat, embed_dedup, nearest
from sheaf.llm.common import components

NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(1)
    rows = []
    for i in range(300):
        v = rng.standard_normal(16)
        for copy in range(3 if i % 10 == 0 else 1):
            rows.append((len(rows), (v + 0.02 * copy * rng.standard_normal(16)).tolist(), i % 3))
    rows += [(len(rows) + k, rows[0][1], rows[0][2]) for k in range(30)]  # ties
    bad = [None, [], [0.0] * 16, [NAN] + [1.0] * 15, [INF] + [1.0] * 15, [None] + [1.0] * 15, [1.0] * 4]
    rows += [(len(rows) + k, v, 1) for k, v in enumerate(bad)]
    return [*rows, (None, [1.0] * 16, 1), (9999, [1.0] * 16, None)]


def good(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, score string")


def test_nearest_equals_all_pairs(spark, vectors):
    rows = nearest.nearest(frame(spark, vectors), F.col("vec_id") % 7 == 0, k=5, query_rows=16, rows=64).collect()
    got = {}
    for r in rows:
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    there = [(i, v) for i, v, _ in vectors if i is not None and good(v)]
    for q, x in there:
        if q % 7 == 0:
            near = sorted(((-float((np.array(x) * np.array(v)).sum()), i) for i, v in there if i != q and len(v) == len(x)))[:5]
            mine = sorted(got.get(q, []))
            assert [i for _, i, _ in mine] == [i for _, i in near] and [r for r, _, _ in mine] == list(range(1, len(near) + 1))
            assert [s for *_, s in mine] == pytest.approx([-s for s, _ in near], abs=1e-12)
    assert set(got) == {q for q, v in there if q % 7 == 0 and len(v) == 16}
    assert nearest.nearest(frame(spark, vectors).limit(0), F.lit(True)).count() == 0


def test_bounds_hold_for_wide_and_uneven_rows():
    rng = np.random.default_rng(8)
    x, y = rng.standard_normal((40, 1500)) * 10.0 ** rng.integers(-6, 6, (40, 1)), rng.standard_normal((200, 1500))
    heaps = [[] for _ in x]
    nearest.tile_search((x, nearest.quantised(x)), np.arange(1000, 1040), (y, nearest.quantised(y)), np.arange(200), heaps, 7)
    for a, heap in zip(x, heaps):
        assert sorted(-i for _, i in heap) == sorted(np.argsort(-(y @ a))[:7])


def test_near_vectors_equal_all_pairs(spark, vectors):
    rows = [*vectors, vectors[0]]
    got = embed_dedup.near_vectors(frame(spark, rows), least=0.95, tables=4, bits_each=4).collect()
    assert len(got) == len(rows)
    usable = [(i, np.array(v) / np.linalg.norm(v), label) for i, v, label in vectors if i is not None and label is not None and good(v)]
    links, group = {}, {i: i for i, *_ in usable}
    for a, (i, x, p) in enumerate(usable):
        for j, y, q in usable[:a]:
            if p == q and len(x) == len(y) and x @ y >= 0.95:
                links[i], links[j] = links.get(i, 0) + 1, links.get(j, 0) + 1
                low, high = sorted((group[i], group[j]))
                group = {k: low if v == high else v for k, v in group.items()}
    for r in got:
        i = r["vec_id"]
        assert (r["n_links"], r["component_id"], r["kept"]) == (links.get(i, 0), group.get(i, i), group.get(i, i) == i), r
    assert embed_dedup.near_vectors(frame(spark, vectors).limit(0)).count() == 0
    with pytest.raises(ValueError):
        embed_dedup.near_vectors(frame(spark, vectors), flips=2)


def test_copies_are_compared_as_one(spark, monkeypatch):
    """Exact copies count as links of each other and of what is near them; a key with several vectors is one partner."""
    x, y, near_x = [1.0, 2.0, 3.0, 4.0], [-4.0, 3.0, -2.0, 1.0], [1.0, 2.0, 3.0, 4.01]
    rows = [(100 + i, x, 1) for i in range(200)] + [(5, near_x, 1), (5, near_x, 1), (6, x, 2), (7, y, 1), (8, x, None)]
    rows += [(50, x, 1), (50, y, 1), (60, x, 3), (60, near_x, 3), (61, near_x, 3)]
    made = []
    whole = embed_dedup.components
    monkeypatch.setattr(embed_dedup, "components", lambda links: made.append(links.count()) or whole(links))
    out = embed_dedup.near_vectors(frame(spark, rows))
    got = {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in out.collect()}
    assert got == {
        *[(100 + i, 202 - 1, 5, False) for i in range(200)],
        (5, 201 + 1 - 1, 5, True), (6, 0, 6, True), (7, 1, 5, False), (8, 0, 8, True),
        (50, 202, 5, False), (60, 1, 60, True), (61, 1, 60, False),
    }
    assert made[0] < 10


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(0, 300)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    rows = components(spark.createDataFrame([*path, *star, (5000, 5000)], "a long, b long").repartition(7)).collect()
    assert {(r["node"], r["component"]) for r in rows} == {(i, 0) for i in range(301)} | {(1000 + i, 1000) for i in range(200)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_rendered_dialogue(spark):
    turns = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 200, "ann", "bye"), (1, 200, "ann", "bye"), (2, 0, "system", "alone"), (None, None, None, "x")]
    table = spark.createDataFrame([(*t, 1) for t in turns], "conv_id long, turn int, role string, text string, position int")
    rows = chat.perspectives(table).collect()
    views = {}
    for r in sorted(rows, key=lambda r: r["position"]):
        views.setdefault((r["conv_id"], r["perspective"]), []).append(r)
    assert set(views) == {(1, "ann"), (1, "bob"), (None, "")}
    for parts in views.values():
        whole = "".join(r["segment"] for r in parts)
        assert [r["position"] for r in parts] == list(range(len(parts)))
        assert all(whole[r["start"] : r["end"]] == r["segment"] for r in parts)
    ann = views[(1, "ann")]
    whole = "".join(r["segment"] for r in ann)
    assert whole.startswith("<|system|>\nbe kind<|end|>\n<|assistant|>\nhi<|end|>\n<|user:bob|>\n<|end|>\n")
    assert [whole[r["mask_start"] : r["mask_end"]] for r in ann if r["mask_start"] is not None] == ["hi<|end|>", "bye<|end|>", "bye<|end|>"]
    assert chat.perspectives(table.limit(0)).count() == 0


def test_pipeline_stages_keep_their_contract(spark, tmp_path):
    import corpus_pipeline

    source = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{source}/documents.parquet")
    extra = docs.withColumn("score", F.lit("s")).union(docs.limit(1).selectExpr("cast(null as bigint)", "cast(null as string)", "lang", "source", "n_chars", "'s'"))
    extra = extra.union(extra.limit(2))
    extra.write.parquet(str(tmp_path / "in"))
    now = spark.read.parquet(str(tmp_path / "in"))
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, source)
        out.write.parquet(str(tmp_path / str(k)))
        after = spark.read.parquet(str(tmp_path / str(k)))
        if name != "packing":
            assert after.columns == extra.columns and after.count() > 0
        if name == "ngram_jaccard":
            ids = [r[0] for r in after.select("doc_id").where("doc_id is not null").collect()]
            assert len(ids) == len(set(ids))
            assert after.where("doc_id is null").count() == now.where("doc_id is null").count()
        now = after
    assert set(now.columns) == {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}
