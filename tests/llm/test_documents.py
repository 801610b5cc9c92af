"""Document operators on awkward rows, and against plain versions."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as vocabularies
import pytest
from pyspark.sql import functions as F
from sheaf.llm import mixing, packing, private, quality, sharding, shingle_join, toxicity

LONG = " ".join(f"w{i}" for i in range(30_000))
NEAR = " ".join(f"n{i}" for i in range(200))
TEXTS = [
    (1, "Mail a.b@c.org or +1 (555) 010-9999 now"),
    (2, None),
    (3, ""),
    (4, LONG),
    (5, NEAR),
    (6, NEAR + " tail"),
    (7, NEAR.upper()),
    (7, NEAR.upper()),
    (8, "two words"),
    (9, "Two\twords"),
    (None, NEAR),
    (10, " \n "),
    (11, "<|endoftext|> ünï cödé 10.0.0.1.2 4111 1111 1111 1111"),
]
SHAPE = "doc_id long, text string, score string, _cut int, `a.b` int, size string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "s", 1, 2, "z") for i, t in TEXTS], SHAPE)


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.limit(0)


def test_shards_keep_groups_and_number_slots(docs, nothing):
    size = F.octet_length(F.coalesce("text", F.lit(""))) + 1
    rows = sharding.shard_groups(docs, F.col("text"), size, ["doc_id"], shards=3).collect()
    assert len(rows) == len(TEXTS)
    where, slots = defaultdict(set), defaultdict(list)
    for r in rows:
        where[r["text"]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
    assert all(len(s) == 1 for s in where.values()) and set(slots) <= {0, 1, 2}
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = sharding.shard_groups(docs.withColumn("shard", F.lit(9)).withColumn("slot", F.lit("x")), F.col("text"), size, ["doc_id"], shards=3)
    assert {r["shard"] for r in again.collect()} <= {0, 1, 2} and "a.b" in again.columns and "_cut" not in again.columns
    assert sharding.shard_groups(nothing, F.col("text"), size, ["doc_id"], shards=3).count() == 0


def test_hot_group_is_numbered_in_cuts(spark):
    many = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 2000, "x").otherwise(F.col("id").cast("string")).alias("text"))
    rows = sharding.shard_groups(many, F.col("text"), F.lit(10), ["doc_id"], shards=4).groupBy("shard")
    out = rows.agg(F.count("*").alias("n"), F.min("slot").alias("least"), F.max("slot").alias("most"), F.countDistinct("slot").alias("d")).collect()
    assert sum(r["n"] for r in out) == 3000 and all((r["least"], r["most"], r["d"]) == (0, r["n"] - 1, r["n"]) for r in out)


def test_tree_is_best_fit():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 60, 400).tolist()
    placed, room, plain = sharding.best_fit_decreasing(sizes, 100), [], {}
    for i in sorted(range(400), key=lambda i: (-sizes[i], i)):
        fits = [(r, b) for b, r in enumerate(room) if r >= sizes[i]]
        b = min(fits)[1] if fits else len(room)
        room += [] if fits else [100]
        room[b] -= sizes[i]
        plain[i] = b
    assert placed == [plain[i] for i in range(400)]
    spread = Counter()
    for s, b in zip(sizes, sharding.fit_into(sizes, 8)):
        spread[b] += s
    assert len(spread) == 8 and max(spread.values()) - min(spread.values()) <= 60


def test_sharding_refuses_no_shards(docs):
    with pytest.raises(ValueError):
        sharding.shard_groups(docs, F.col("text"), F.lit(1), ["doc_id"], shards=0)


BASE = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain_spans(text):
    found = []
    for kind, pattern in enumerate(BASE):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = [True, all(int(p) <= 255 for p in m[0].split(".")) if kind == 1 else True, 14 <= len(digits) <= 19 and private._luhn(digits), 10 <= len(digits) <= 15]
            if good[kind]:
                found.append((m.start(), kind, m.end()))
    return sorted(found)


def test_spans_equal_the_patterns_on_random_texts():
    rng, automaton = np.random.default_rng(5), private._automaton()
    for _ in range(4000):
        text = "".join(rng.choice(list("a.@-+ 01245()%é"), rng.integers(0, 60)))
        assert [s for s in private.find_spans(text, automaton) if s[1] < 4] == plain_spans(text), text
    card = "4111 1111 1111 1111"
    assert [s for s in private.find_spans("x" + card, automaton) if s[1] == 2] == [(1, 2, 20)]


def test_more_kinds_and_masks(docs, nothing):
    automaton = private._automaton()
    text = "see https://me:pw@host/x, IBAN: GB82WEST12345698765432, account no. 12345678"
    found = private.find_spans(text, automaton)
    assert [private.KINDS[k] for _, k, _ in found] == ["login", "account", "account"]
    assert private.masked("a 1.2.3.4 b", [(2, 1, 9)]) == "a [IP] b"
    out = private.find_private(docs, redacted="clean").collect()
    assert len(out) == len(TEXTS) and out[0]["clean"] == "Mail [EMAIL] or [PHONE] now" and out[1]["clean"] is None
    assert private.find_private(docs).columns == [*docs.columns, "spans"] and private.find_private(nothing).count() == 0


def test_packing_is_gapless_and_equals_the_tokenizer(docs, nothing):
    path = vocabularies.path("byte_bpe_50k.json")
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(path)
    rows = packing.pack_documents(docs.coalesce(2), path, vocabularies.PATTERN, size=256, open_windows=2).collect()
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        windows[r["sequence_id"]].append(r)
    for i, text in TEXTS:
        if i != 7:
            ids = [*plain.encode(text or "", add_special_tokens=False).ids, 1]
            got = sorted(pieces[i], key=lambda r: r["start"])
            assert [x for r in got for x in np.frombuffer(r["ids"], "<u4")] == ids and all(r["doc_tokens"] == len(ids) for r in got)
    padding = 0
    for rows in windows.values():
        rows.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in rows] == [sum(x["length"] for x in rows[:k]) for k in range(len(rows))]
        held = sum(r["length"] for r in rows)
        assert held <= 256
        padding += 256 - held if held & (held - 1) else 0
    assert padding <= 16 * len(windows)
    assert packing.pack_documents(nothing, path, vocabularies.PATTERN).count() == 0
    with pytest.raises(ValueError):
        packing.pack_documents(docs, path, vocabularies.PATTERN, size=100)


def plain_classes(texts, num=90, den=100, width=3):
    word, lower = re.compile(r"[^\x20\x09-\x0D]+"), str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, text in texts:
        w = word.findall((text or "").translate(lower))
        sets.append({tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    group = {i: i for i, _ in texts}

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, (i, _) in enumerate(texts):
        for b, (j, _) in enumerate(texts[:a]):
            shared = len(sets[a] & sets[b])
            if shared and den * shared >= num * len(sets[a] | sets[b]):
                x, y = top(i), top(j)
                group[max(x, y)] = min(x, y)
    return {i: (len(s), top(i)) for (i, _), s in zip(texts, sets)}


def test_shingle_links_on_awkward_rows(docs, nothing):
    rows = shingle_join.shingle_links(docs).collect()
    assert len(rows) == len(TEXTS)
    expected = plain_classes([t for t in dict.fromkeys(TEXTS) if t[0] is not None])
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"] is not None} == expected
    assert [r["component_id"] for r in rows if r["doc_id"] is None] == [None]
    assert shingle_join.shingle_links(nothing).count() == 0


def test_shingle_links_equal_all_pairs(spark):
    rng = np.random.default_rng(11)
    texts = []
    for family in range(12):
        base = [f"t{rng.integers(400)}" for _ in range(int(rng.integers(3, 700)))]
        for _ in range(15):
            words = list(base)
            for k in rng.integers(0, len(words), rng.integers(0, 4)):
                words[k] = f"e{rng.integers(1000)}"
            texts.append((len(texts), " ".join(words)))
    rows = shingle_join.shingle_links(spark.createDataFrame(texts, "doc_id long, text string").repartition(5)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == plain_classes(texts)


def test_sets_without_chosen_tokens_are_still_compared(spark, monkeypatch):
    """With bands that leave long sets too few tokens, the comparison by size finds their links."""
    monkeypatch.setattr(shingle_join, "SHORT", 4)
    monkeypatch.setattr(shingle_join, "LONG", 4)
    rng = np.random.default_rng(2)
    texts = []
    for _ in range(25):
        words = [f"t{rng.integers(10**6)}" for _ in range(int(rng.integers(10, 30)))]
        texts += [(len(texts), " ".join(words)), (len(texts) + 1, " ".join([*words, "x"]))]
    rows = shingle_join.shingle_links(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == plain_classes(texts)


def test_toxicity_learns_and_takes_awkward_rows(spark, docs, nothing):
    rng = np.random.default_rng(4)
    syllables = [a + b for a in "bdfgklmnprst" for b in "aeiou"]
    say = lambda n: ["".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(n)]
    texts, labels = [], []
    for i in range(600):
        words = say(80)
        for k in rng.integers(0, 80, 5 if i % 4 == 0 else 0):
            words[k] = ["zwoxy", "qujixx"][rng.integers(2)]
        texts.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    table, marks = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame([*labels, (None, 1), (3, None), (5, 1)], "doc_id long, toxic int")
    held = lambda key: F.crc32(key.cast("string").cast("binary")) % 4 == 2
    model = toxicity.train(table, marks, held_out=held)
    scored = {r["doc_id"]: r["score"] for r in toxicity.score(table, model).collect()}
    unseen = [(scored[i], y) for i, y in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([(s >= 0.3) == bool(y) for s, y in unseen]) > 0.95
    out = toxicity.score(docs, model).collect()
    assert len(out) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in out) and out[1]["score"] == out[2]["score"]
    assert toxicity.score(nothing, model).count() == 0
    empty = toxicity.train(table, marks.limit(0))
    assert all(r["score"] == toxicity.score(table, empty).first()["score"] for r in toxicity.score(docs, empty).collect())


def test_mixing_reaches_its_margins(spark, nothing):
    rows = [(i, ["a", "b", None][i % 3], ["x", "y"][i % 7 > 4], 1 + i % 5) for i in range(20_000)]
    table = spark.createDataFrame(rows, "doc_id long, source string, lang string, n int")
    axes = {"source": (F.col("source"), {"a": 0.6, "*": 0.4}), "lang": (F.col("lang"), {"x": 0.5, "y": 0.5, "gone": 0.3})}
    out = mixing.mix(table, axes, F.col("n"), share=0.2).collect()
    total = sum(r["_tokens"] for r in out)
    assert abs(total / sum(r[3] for r in rows) - 0.2) < 0.01
    assert abs(sum(r["_tokens"] for r in out if r["source"] == "a") / total - 0.6) < 0.02
    assert abs(sum(r["_tokens"] for r in out if r["lang"] == "x") / total - 0.5) < 0.02
    assert mixing.mix(table.limit(0), axes, F.col("n")).count() == 0
    whole = mixing.mix(table, {"lang": (F.col("lang"), {"x": 0.9, "y": 0.1})}, F.col("n"), share=1.0).count()
    assert whole == len(rows)


def plain_model(trusted, order):
    """Interpolated modified Kneser-Ney by dictionaries."""
    lead = b"\0" * (order - 1)
    levels = {order: Counter()}
    for t in trusted:
        b = lead + t + b"\3"
        levels[order].update(b[i : i + order] for i in range(len(b) - order + 1))
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    cut = {k: quality.discounts([sum(1 for c in v.values() if c == n) for n in (1, 2, 3, 4)]) for k, v in levels.items()}

    def p(gram):
        if not gram:
            return 1 / quality.SYMBOLS
        k = len(gram)
        beside = [(g, c) for g, c in levels[k].items() if g[:-1] == gram[:-1]]
        total = sum(c for _, c in beside)
        lower = p(gram[1:])
        if not total:
            return lower
        d = lambda c: cut[k][min(c, 3) - 1]
        c = levels[k].get(gram, 0)
        return ((max(c - d(c), 0) if c else 0) + sum(min(d(c), c) for _, c in beside) * lower) / total

    def perplexity(t):
        b = lead + t + b"\3"
        return float(np.exp(-np.mean([np.log(p(b[i : i + order])) for i in range(len(b) - order + 1)])))

    return perplexity


def test_perplexities_equal_a_plain_model(spark, nothing):
    texts = [(1, "the cat sat on the mat", "en", True), (2, "the dog sat on the log", "en", True), (3, "xq zzv", "en", False), (4, None, None, False), (5, "", "de", None), (6, "the cat ät", "en", False), (6, "the cat ät", "en", False)]
    table = spark.createDataFrame(texts, "doc_id long, text string, lang string, good boolean")
    rated = quality.perplexities(table, F.col("good"), F.pmod("doc_id", F.lit(3)), order=3, keep=("lang",))
    plain = plain_model([t.encode() for _, t, _, good in texts if good], 3)
    got = {r["doc_id"]: r for r in quality.classify(rated).collect()}
    assert rated.count() == len(texts)
    for i, text, _, _ in texts:
        assert got[i]["perplexity"] == pytest.approx(plain((text or "").encode()), rel=1e-4)
    assert not got[3]["kept"] and got[1]["kept"]
    none = quality.perplexities(table, F.lit(False), F.lit(1), order=3, keep=("lang",))
    assert all(r["kept"] and r["perplexity"] == pytest.approx(257, rel=1e-4) for r in quality.classify(none).collect())
    assert quality.perplexities(table.limit(0), F.col("good"), F.lit(1), keep=("lang",)).count() == 0


def test_base_digest_of_the_query(spark):
    from sheaf.llm import queries

    rows = queries.op10_private(spark, "/root/testdata/sf0.001").collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in rows:
        spans = plain_spans(texts[r["doc_id"]])
        listed = ",".join(f"{private.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(k == x for _, k, _ in spans) for x in range(4)]
