"""Centroids, conversation repair and token counts against plain versions."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers as TOKENIZERS
import pytest
import sentencepiece
from sheaf.llm import centroids, queries, repair, token_counts

SF = "/root/testdata/sf0.001"


# ---- centroids


def plain_clusters(rows, k, rounds):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)[:k]
    centres = [v for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centres = [[sum(x) // len(groups[n]) for x in zip(*groups[n])] if n in groups else c for n, c in enumerate(centres)]
    placed = [(i, *reversed(nearest(v))) for i, v in kept]
    sums = {}
    for _, n, d in placed:
        sums[n] = sums.get(n, 0) + d
    return [(i, n, d, sums[n], sum(sums.values()), hashlib.sha256(",".join(map(str, centres[n])).encode()).hexdigest()) for i, n, d in placed]


def same(left, right):
    order = lambda r: tuple((x is not None, x if x is not None else 0) for x in r)
    assert sorted(map(tuple, left), key=order) == sorted(map(tuple, right), key=order)


def test_centroids_equal_plain(spark):
    rng = np.random.default_rng(3)
    centre = rng.standard_normal((6, 64))
    rows = [(i, (centre[i % 6] * (0.1 if i % 5 else 4) + 0.2 * rng.standard_normal(64)).astype(float).tolist()) for i in range(250)]
    rows += [(300 + i, rows[0][1]) for i in range(40)] + [rows[7], (None, rows[3][1]), (900, [0.0] * 64)]
    nan, inf = float("nan"), float("inf")
    bad = [(800, None), (801, []), (802, [1.0] * 63), (803, [nan] + [1.0] * 63), (804, [inf] + [1.0] * 63), (805, [None] + [1.0] * 63)]
    frame = spark.createDataFrame([(*r, 1) for r in rows + bad], "vec_id long, embedding array<double>, cluster int").repartition(5)
    got = centroids.centroid_clusters(spark, frame, k=12, rounds=3)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    same(got.collect(), plain_clusters(rows, 12, 3))
    few = frame.where("vec_id in (1, 2)")
    same(centroids.centroid_clusters(spark, few, k=40).collect(), plain_clusters(rows[1:3], 40, 5))
    assert centroids.centroid_clusters(spark, frame.where("vec_id > 799 and vec_id < 900")).count() == 0
    assert centroids.centroid_clusters(spark, frame.limit(0)).count() == 0
    with pytest.raises(Exception, match="too large"):
        centroids.centroid_clusters(spark, spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<double>"))


def test_ties_and_bounds():
    rng = np.random.default_rng(5)
    x = rng.integers(-3, 3, (400, 4)).astype(np.int64)
    centres = np.concatenate([x[:9], x[:9], 1 << 25 | rng.integers(0, 9, (4, 4))]).astype(np.int64)
    pivots = centroids.spread_pivots(centres, 3)
    table = np.sqrt(np.stack([centroids.squares(x, p[None]) for p in pivots], axis=1).astype(float))
    best, least = centroids.assign(x, table, centres, pivots)
    every = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
    assert (best == every.argmin(axis=1)).all() and (least == every.min(axis=1)).all()


def test_centroid_query_on_whole_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    same(queries.QUERIES["op11_centroids"](spark, SF).collect(), plain_clusters(rows, 40, 5))


# ---- conversation repair

BLANKS = " \t\n\x0b\x0c\r"


def plain_repair(rows):
    """``{conv_id: (gaps, blank, duplicate, truncated, illegal, cost, audit, sha)}``, one conversation after the other."""
    damaged = {}
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind, role, text = zlib.crc32(key.encode()) % 20, " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        said = damaged.setdefault(conv, [])
        if kind:
            said += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {conv: one_repair(said) for conv, said in damaged.items()}


def one_repair(said):
    said = sorted(said, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
    faults, seen = [], set()
    for _, role, text in said:
        faults.append("b" if not text.strip(BLANKS) else "d" if (role, text) in seen else "t" if text.rstrip(BLANKS)[-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [r[:1] for _, r, _ in said]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    turns = {t for t, _, _ in said if t is not None}
    # least cost and letters from each state, from the last row back; the states are what the initials so far end with
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}
    cheapest = {"": (0, "", ()), "a": (0, "", ())}

    def insertions(table):
        for _ in range(4):
            for state, nexts in follows.items():
                for role in nexts:
                    if role != "s" and role in table:
                        cost, letters, kept = table[role]
                        way = (cost + 5, "I" + letters, ((role, None), *kept))
                        if state not in table or way[:2] < table[state][:2]:
                            table[state] = way
        return table

    cheapest = insertions(cheapest)
    for (_, role, text), fault in zip(reversed(said), reversed(faults)):
        here = {}
        for state, nexts in follows.items():
            ways = [(cheapest[state][0] + 2, "D" + cheapest[state][1], cheapest[state][2])]
            for to in nexts if fault not in ("b", "d") else "":
                cost, letters, kept = cheapest[to] if to in cheapest else (None, "", ())
                stays = 5 if fault == "t" else 0
                if cost is not None and role[:1] == to:
                    ways.append((cost + stays, "K" + letters, ((role, text), *kept)))
                elif cost is not None and to != "s":
                    ways.append((cost + stays + 1, "R" + letters, ((to, text), *kept)))
            here[state] = min(ways, key=lambda w: w[:2])
        cheapest = insertions(here)
    cost, letters, kept = cheapest[""]
    names = {"u": "user", "a": "assistant"}
    words = "\n".join(f"{names.get(role, role)}:{text or ''}" for role, text in kept)
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, letters, hashlib.sha256(words.encode()).hexdigest())


def repaired(spark, frame):
    got = repair.repair_digests(repair.damage(frame), key="conv_id")
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    found = {r["conv_id"]: tuple(r)[1:] for r in got.collect()}
    return found


def talk(seed, convs, turns):
    rnd = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(rnd.randint(1, turns)):
            role = rnd.choice(["system", "user", "assistant", "user", "assistant", "tool", None, ""])
            text = rnd.choice(["Yes.", "No!", "Well", " ", "", None, "A\n b? \n", "ä.", f"{rnd.random()}.", "x" * 3000 + "."])
            rows.append((c, rnd.choice([t, t, t + 1, None, 3 * t]), role, text))
    return [*rows, *rows[:20], (None, None, "user", "Hm."), (None, 2, "assistant", "Ok."), (None, 3, "assistant", "Ok.")]


def test_repair_equals_plain(spark):
    rows = talk(1, 150, 9)
    frame = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, audit int").repartition(7)
    assert repaired(spark, frame) == plain_repair(rows)
    assert repaired(spark, frame.limit(0)) == {}


def test_dropped_conversations_stay(spark):
    gone = [(c, 0, "user", "Hi.") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    found = repaired(spark, spark.createDataFrame(gone, "conv_id long, turn long, role string, text string"))
    empty = hashlib.sha256(b"").hexdigest()
    assert gone and found == {c: (0, 0, 0, 0, 0, 0, "", empty) for c, *_ in gone}


def test_a_long_conversation_is_cut(spark):
    """One conversation with most rows, in many lattices and pieces, and equal rows beyond a batch."""
    rnd = random.Random(4)
    rows = [(7, t // 2, rnd.choice(["user", "assistant", "system"]), rnd.choice(["A.", "B", f"{t}.", f"{t}"])) for t in range(6000)]
    rows += [(8, None, "user", "Same.")] * 2500 + [(9, 1, "user", "Hi."), (9, 2, "assistant", "Hi.")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    assert repaired(spark, frame) == plain_repair(rows)


def test_repaired_rows_read_as_they_should(spark):
    rows = talk(2, 60, 7)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    damaged = repair.damage(frame)
    said = {}
    for r in repair.repaired_rows(damaged).orderBy("conv", "position").collect():
        said.setdefault(r["conv"], []).append((r["position"], r["role"], r["text"]))
    for conv, facts in plain_repair(rows).items():
        lines = said.get(conv, [])
        assert [p for p, *_ in lines] == list(range(len(lines)))
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for _, role, _ in lines))
        assert hashlib.sha256("\n".join(f"{role}:{text}" for _, role, text in lines).encode()).hexdigest() == facts[-1]


def test_prices_are_distances():
    rnd = random.Random(6)
    for _ in range(40):
        codes = bytes(rnd.randrange(16) for _ in range(20))
        found = repair.Lattice(codes, (0, repair.NO_WAY, repair.NO_WAY, 0), True)
        for node in rnd.sample(range(84), 84):
            found.settle(node)
        for node in range(84):
            assert found.price[node] == min(cost + found.price[to] for _, cost, to in found.arcs[node])


def test_repair_query_on_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r)[1:] for r in queries.QUERIES["op12_repair"](spark, SF).collect()}
    assert got == plain_repair(rows)


# ---- token counts

PIECES = TOKENIZERS.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def hostile(seed, many):
    rnd = random.Random(seed)
    atoms = [" ", "  ", "\n", "\n\n", "\r\n", "\t", "▁", "a", "the", "ü", "日本", "<s>", "</s>", "<unk>", "<0x0A>", "\0", "😀", ".", ");", "　", "\xa0", "é"]
    return ["".join(rnd.choices(atoms, k=rnd.randint(0, 60))) for _ in range(many)]


def test_split_texts_have_the_same_tokens(library):
    places = token_counts.safe_places(library)
    texts = [*hostile(1, 3000), " " * 50, "\n" * 50, "▁" * 30 + " a", "a " * 40 + "\n"]
    for text in texts:
        for least in (1, 3, 10):
            got = list(token_counts.parts(text.encode(), places, least))
            assert sum(len(library.encode(p)) - extra for p, extra in got) == len(library.encode(text)), (text, got)


def test_batches_hold_all_parts_evenly(library):
    texts = [t.encode() for t in hostile(2, 300)] + [b"word " * 5000, b"x" * 20000]
    batches = list(token_counts.even_batches(texts, token_counts.safe_places(library), 500, 4000))
    sizes = [sum(len(p) for _, p, _ in b) for b in batches]
    assert max(sizes) <= 4000 + 20000 and sorted(sizes)[len(sizes) // 2] >= 2000
    assert {i for b in batches for i, _, _ in b} == set(range(len(texts)))


def test_counts_equal_the_library(spark, library):
    texts = [*hostile(3, 400), None, "", "wörter und mehr " * 9000, "x" * 70000, "line\n" * 9000, *hostile(3, 5)]
    rows = [(i if i % 50 else None, t, "x") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string").repartition(3)
    got = token_counts.count_tokens(frame, PIECES, part_bytes=1000, batch_bytes=20000)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    sizes = [(i, len((t or "").encode()), len(library.encode(t or ""))) for i, t, _ in rows]
    same(got.collect(), [(i, b, n, n > 4096) for i, b, n in sizes])
    assert token_counts.count_tokens(frame.limit(0), PIECES).count() == 0


def test_count_query_on_whole_table(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    sizes = [(r["doc_id"], len((r["text"] or "").encode()), len(library.encode(r["text"] or ""))) for r in docs]
    same(queries.QUERIES["op13_token_counts"](spark, SF).collect(), [(i, b, n, n > 4096) for i, b, n in sizes])


def test_queries_keep_types(spark):
    kinds = {n: [t for _, t in queries.QUERIES[n](spark, SF).dtypes] for n in ("op11_centroids", "op12_repair", "op13_token_counts")}
    assert kinds["op11_centroids"] == ["bigint", "int", "bigint", "bigint", "bigint", "string"]
    assert kinds["op12_repair"] == ["bigint"] + ["bigint"] * 6 + ["string", "string"]
    assert kinds["op13_token_counts"] == ["bigint", "bigint", "bigint", "boolean"]
