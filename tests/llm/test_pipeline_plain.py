"""The pipeline's rows against a plain version without Spark."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as vocabularies
import zstandard
from sheaf.llm import private, queries, toxicity
from tests.llm.test_documents import plain_classes, plain_spans

SOURCE = "/root/testdata/sf0.001"


def plain_score(text, model):
    """Window by window, each compressed alone."""
    body = text.encode()
    plain = zstandard.ZstdCompressionParameters.from_level(
        3, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_dict_id=False, write_checksum=False
    )
    pair = []
    for content in (model.ordinary, model.toxic):
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(compression_params=plain)
        pair.append(zstandard.ZstdCompressor(dict_data=held, compression_params=plain))
    found = []
    for width in toxicity.WINDOWS:
        windows, start, mark = [], 0, width
        while mark < len(body):
            cut = next((i for i in range(mark, len(body)) if body[i] in b" \t\n\x0b\x0c\r"), None)
            if cut is None:
                break
            windows.append(body[start:cut])
            start = cut
            mark = width * (cut // width + 1)
        windows.append(body[start:])
        gain = [len(pair[0].compress(w)) - len(pair[1].compress(w)) for w in windows if w]
        found += [np.log1p(sum(g >= least for g in gain)) for least in toxicity.GAINS]
        found.append(max([0, *np.clip(gain, 0, 24)]) / 8)
    return 1 / (1 + np.exp(-np.dot([*found, np.log1p(len(gain)), 1], model.weights)))


def plain_mix(docs):
    """Raking and sampling over dictionaries."""
    named = queries.TARGETS

    def form(text):
        for name, marks in (("table", [" | "]), ("shout", ["!!"]), ("licence", ["License", "rights reserved"])):
            if any(m in text for m in marks):
                return name
        return "prose"

    cells, where, size = Counter(), {}, {}
    for d in docs:
        values = {"lang": d["lang"], "topic": form(d["text"])}
        where[d["doc_id"]] = (d["source"], *(values[a] if values[a] in named[a] else "*" for a in named))
        size[d["doc_id"]] = len(d["text"].encode()) // 4 + 1
        cells[where[d["doc_id"]]] += size[d["doc_id"]]
    total = sum(cells.values())
    w = {c: t / total for c, t in cells.items()}
    tokens_of = Counter()
    for c, t in cells.items():
        tokens_of[c[0]] += t
    targets = [{v: t**0.5 for v, t in tokens_of.items()}, *queries.TARGETS.values()]
    for _ in range(queries.ROUNDS):
        for k, target in enumerate(targets):
            now = defaultdict(float)
            for c, x in w.items():
                now[c[k]] += x
            goal = {v: target.get(v, 0) for v in now}
            w = {c: x * goal[c[k]] / sum(goal.values()) / now[c[k]] if now[c[k]] else 0 for c, x in w.items()}
    low, high = 0.0, 1e12  # the scale that gives half of all tokens, by halving
    for _ in range(200):
        scale = (low + high) / 2
        if sum(min(1, scale * w[c] / t) * t for c, t in cells.items()) < total / 2:
            low = scale
        else:
            high = scale
    number = lambda i: int(hashlib.md5(f"mix:{i}".encode()).hexdigest()[:13], 16) / 2**52
    return [d for d in docs if number(d["doc_id"]) < min(1, high * w[where[d["doc_id"]]] / cells[where[d["doc_id"]]])]


def test_pipeline_equals_the_plain_version(spark):
    import corpus_pipeline
    from tokenizers import Tokenizer

    table = spark.read.parquet(f"{SOURCE}/documents.parquet")
    model = toxicity.train(table, spark.read.parquet(f"{SOURCE}/labels.parquet"), held_out=queries.held_out)
    docs = [r.asDict() for r in table.collect()]
    docs = [d for d in docs if plain_score(d["text"], model) < 0.3]
    classes = plain_classes([(d["doc_id"], d["text"]) for d in docs], num=80, width=5)
    docs = [d for d in docs if classes[d["doc_id"]][1] == d["doc_id"]]
    automaton = private._automaton()
    for d in docs:
        more = [s for s in private.find_spans(d["text"], automaton) if s[1] >= 4]
        d["text"] = private.masked(d["text"], sorted(plain_spans(d["text"]) + more))
    docs = plain_mix(docs)
    encode = Tokenizer.from_file(vocabularies.path("byte_bpe_50k.json")).encode
    ids = {d["doc_id"]: [*encode(d["text"], add_special_tokens=False).ids, 1] for d in docs}
    pieces = defaultdict(list)
    for r in corpus_pipeline.run(spark, SOURCE).collect():
        pieces[r["doc_id"]].append(r)
    assert set(pieces) == set(ids) and len(ids) > 40
    for key, rows in pieces.items():
        at = 0
        for r in sorted(rows, key=lambda r: r["start"]):
            part = np.array(ids[key][at : at + r["length"]], "<u4")
            assert r["start"] == at and r["doc_tokens"] == len(ids[key]) and zlib.crc32(part.tobytes()) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids[key])


def test_rows_that_share_a_key_are_copies_only_by_their_texts(spark):
    import corpus_pipeline

    words = lambda a, n: " ".join(f"{a}{i}" for i in range(n))
    near = words("a", 60).replace("a30 ", "z ")  # 5 of 56 shingles changed: linked at 0.8 on five words
    far = words("a", 60).replace("a30 ", "z ").replace("a10 ", "y ").replace("a50 ", "x ")
    rows = [(5, words("a", 60)), (5, words("b", 60)), (3, near), (None, words("a", 60)), (None, words("c", 60)), (None, words("c", 60)), (7, far), (8, None), (8, None), (9, "")]
    docs = spark.createDataFrame([(i, t, "en", "src0", 1, "x") for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, component_id string")
    left = corpus_pipeline.drop_near_copies(spark, docs, SOURCE)
    assert left.columns == docs.columns
    order = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted([(r["doc_id"], r["text"]) for r in left.collect()], key=order) == sorted([rows[2], rows[1], rows[4], rows[6], rows[7], rows[8], rows[9]], key=order)
    assert corpus_pipeline.drop_near_copies(spark, docs.limit(0), SOURCE).count() == 0
