"""Toxicity by compression distance: one zstandard dictionary of ordinary and one of toxic text."""

from __future__ import annotations

import math
import sys
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import col

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOWS = (32, 48)  # bytes, to the end of a word
GAINS = (2, 3, 4, 5, 6, 8, 10)  # bytes that a window is shorter with the toxic dictionary
FEATURES = len(WINDOWS) * (len(GAINS) + 1) + 2


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]


def windows(body: bytes, width: int) -> np.ndarray:
    """``(offset, length)`` of windows that cover the text, each cut at the first white space after ``width`` bytes."""
    data = np.frombuffer(body, np.uint8)
    blank = np.flatnonzero((data == 32) | ((data >= 9) & (data <= 13)))
    at = np.unique(np.searchsorted(blank, np.arange(width, len(data), width)))
    starts = np.concatenate([[0], blank[at[at < len(blank)]]])
    ends = np.concatenate([starts[1:], [len(data)]])
    return np.stack([starts, ends - starts], 1)[ends > starts].astype(np.uint64)


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    plain = zstandard.ZstdCompressionParameters.from_level(
        3, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_dict_id=False, write_checksum=False
    )
    held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(compression_params=plain)
    return zstandard.ZstdCompressor(dict_data=held, compression_params=plain)


def gains(bodies: list[bytes], width: int, ordinary: zstandard.ZstdCompressor, toxic: zstandard.ZstdCompressor) -> tuple[np.ndarray, np.ndarray]:
    """For each window of all bodies: whose it is, and how much shorter the toxic dictionary makes it."""
    cuts, base = [], 0
    for body in bodies:
        cut = windows(body, width)
        cut[:, 0] += np.uint64(base)
        cuts.append(cut)
        base += len(body)
    owner = np.repeat(np.arange(len(bodies)), [len(c) for c in cuts])
    if not len(owner):
        return owner, owner
    data, every = b"".join(bodies), np.concatenate(cuts)
    sizes = []
    for a in range(0, len(every), 100_000):
        part = zstandard.BufferWithSegments(data, every[a : a + 100_000].tobytes())
        for c in (ordinary, toxic):
            made = c.multi_compress_to_buffer(part, threads=1)
            sizes.append(np.fromiter((len(made[i]) for i in range(len(made))), np.int64, len(made)))
    return owner, np.concatenate(sizes[::2]) - np.concatenate(sizes[1::2])


def features(bodies: list[bytes], ordinary: zstandard.ZstdCompressor, toxic: zstandard.ZstdCompressor) -> np.ndarray:
    """Per document and window width: how many windows gain so much, by logarithm, and the largest gain; then the
    number of windows, and 1."""
    out = []
    for width in WINDOWS:
        owner, gain = gains(bodies, width, ordinary, toxic)
        out += [np.log1p(np.bincount(owner[gain >= least], minlength=len(bodies))) for least in GAINS]
        most = np.zeros(len(bodies))
        np.maximum.at(most, owner, np.clip(gain, 0, 24))
        out.append(most / 8)
    return np.stack([*out, np.log1p(np.bincount(owner, minlength=len(bodies))), np.ones(len(bodies))], 1)


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 30) -> np.ndarray:
    """Logistic regression by Newton steps; the last feature is the intercept."""
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - penalty * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), slope)
        w += step * min(1, 5 / max(np.abs(step).max(), 1e-12))
    return w


def _unalike(texts: list[bytes]) -> list[int]:
    """Texts that are no near copies of one before: copies would make the words of one text look common."""
    seen: set[int] = set()
    kept = []
    for i, body in enumerate(texts):
        words = body.split()
        least = sorted({zlib.crc32(b" ".join(words[j : j + 3])) for j in range(max(1, len(words) - 2))})[:8]
        if sum(h in seen for h in least) < 2:
            seen.update(least)
            kept.append(i)
    return kept


def _pieces(word: bytes) -> tuple[bytes, ...]:
    return word[:4], word[:5], word[:6], word


def _surprise(k: int, n: int, others: int, of: int) -> float:
    """The likelihood ratio of a piece in k of n toxic and ``others`` of ``of`` ordinary texts."""
    p = (k + others) / (n + of)
    terms = ((k, n * p), (n - k, n * (1 - p)), (others, of * p), (of - others, of * (1 - p)))
    return 2 * sum(a * math.log(a / b) for a, b in terms if a > 0)


def learn(texts: list[str], labels: list[int], rate: float | None = None, size: int = 110_000) -> Model:
    """Dictionaries and calibration from labelled texts.

    The ordinary dictionary is trained on pieces of ordinary text. A toxic text is mostly ordinary, so the passages
    that make it toxic are found first: words with a beginning that toxic texts hold far more often. The toxic
    dictionary holds the same ordinary content and then these passages, the most frequent last, so that a window
    gets shorter only by what is toxic. How many windows must gain how much is fitted on the same texts, and the
    intercept is moved to the ``rate`` of toxic texts where these hold more or fewer of them.
    """
    bodies = [t.encode("utf-8", "surrogatepass") for t in texts]
    kept = _unalike(bodies)
    bodies, y = [bodies[i] for i in kept], np.array([labels[i] for i in kept], float)
    sides = [[b for b, label in zip(bodies, y) if label == side] for side in (0, 1)]
    if not sides[0] or not sides[1]:  # nothing to compare
        rate = (y.sum() + 0.5) / (len(y) + 10)  # of the few there are
        return Model(b" ", b" ", (*[0.0] * (FEATURES - 1), math.log(rate / (1 - rate))))
    holds = [Counter(p for b in side for p in {p for w in set(b.split()) for p in _pieces(w)}) for side in sides]
    n, of = len(sides[1]), len(sides[0])
    telling = {p for p, k in holds[1].items() if k * of > 4 * holds[0][p] * n and _surprise(k, n, holds[0][p], of) > 20}
    words = Counter(w for b in sides[1] for w in b.split() if telling.intersection(_pieces(w)))
    passages = b" " + b" ".join(w for w, _ in sorted(words.items(), key=lambda x: (x[1], x[0]))) + b" "
    pieces = [b[i : i + 64] for b in sides[0] for i in range(0, max(1, len(b) - 64), 256)]
    step = max(1, len(pieces) // 40_000)
    try:
        ordinary = zstandard.train_dictionary(size, pieces[::step], k=64, d=6).as_bytes()
    except zstandard.ZstdError:  # too little text to choose from
        ordinary = b" ".join(pieces)[-size:]
    toxic = ordinary + passages[-size:]
    x = features(bodies, compressor(ordinary), compressor(toxic))
    weights = fit(x, y)
    if rate is not None and 0 < rate < 1:
        weights[-1] += math.log(rate / (1 - rate)) - math.log(y.mean() / (1 - y.mean()))
    return Model(ordinary, toxic, tuple(weights.tolist()))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", held_out: Callable[[Column], Column] | None = None, per_class: int = 3000) -> Model:
    """A model from at most ``per_class`` labelled documents of each class, those whose keys have the least hashes.

    That bound is all that reaches the driver. Keys for which ``held_out`` holds are not learned from. Null texts and
    labels and contradicting labels of a key are left out.
    """
    named = labels.select(col(key).alias("id"), col(label).cast("int").alias("y")).where(F.col("id").isNotNull())
    named = named.groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("_y")).where("y = _y and y in (0, 1)")
    order = [F.xxhash64("id"), "id"]
    named = named.where(~held_out(F.col("id"))) if held_out else named
    picked = [named.where(F.col("y") == y).orderBy(*order).limit(per_class) for y in (0, 1)]
    chosen = F.broadcast(picked[0].union(picked[1]))
    texts = docs.select(col(key).alias("id"), col(text).alias("text")).where(F.col("text").isNotNull())
    rows = texts.join(chosen, "id").groupBy("id").agg(F.min("text").alias("text"), F.first("y").alias("y")).collect()
    rows.sort(key=lambda r: str(r["id"]))
    rate = named.agg(F.avg("y")).first()[0]
    return learn([r["text"] for r in rows], [r["y"] for r in rows], rate)


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """Adds the probability, 0 to 1, that a document is toxic.

    Whole texts are read; a null text counts as empty, and an empty one gets the score of a text without windows.
    One pass without a shuffle, rows are independent. A column called ``name`` is replaced, all others kept.
    """
    rest = [c for c in docs.columns if c != name]
    place = rest.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = compressor(model.ordinary), compressor(model.toxic)
        weights = np.array(model.weights)
        for batch in batches:
            scores = []
            for a in range(0, batch.num_rows, 500):
                bodies = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column(place).slice(a, 500).to_pylist()]
                scores.append(1 / (1 + np.exp(-np.clip(features(bodies, *pair) @ weights, -30, 30))))
            made = pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], [f"c{i}" for i in range(len(rest) + 1)])

    plain = docs.select(*[col(c).alias(f"c{i}") for i, c in enumerate(rest)])
    shape = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(plain.schema)) + f", c{len(rest)} double"
    return plain.mapInArrow(run, shape).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate([*rest, name])])
