"""Token counts: Arrow batches cut by bytes, long texts split where no token can lie across, lengths only."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import col

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MARK = "▁"  # how pieces write a blank


def safe_places(model) -> re.Pattern | None:
    """Where a text may be split without changing its tokens, or None if the vocabulary does not show it.

    A merge joins neighbours into a piece of the vocabulary, so no merge crosses a place that no piece crosses.
    If no piece has a blank after another character, a place between such a character and a blank is one: the part
    after it gets the blank that the library puts before every text in place of its own. If no piece holds a line
    feed, a place before one is another: there the part after it has a blank too many, which is a token by itself.
    """
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    blanks = not any(MARK in p.lstrip(MARK) for p in pieces)
    lines = not any("\n" in p for p in pieces) and not model.is_unknown(model.piece_to_id(MARK))
    as_it_is = model.normalize("a  b \n") == f"{MARK}a{MARK}{MARK}b{MARK}\n" and model.normalize(f" {MARK}") == MARK * 3
    if not (blanks and as_it_is):
        return None
    blank = rb"(?<!\xe2\x96\x81)(?<! ) (?!\Z)"
    return re.compile(blank + rb"|\n" if lines else blank)


def parts(text: bytes, places: re.Pattern | None, least: int) -> Iterator[tuple[bytes, int]]:
    """``(part, tokens too many in it)``: the whole text, in parts that end at the first safe place after ``least``
    bytes. A text without such places stays whole."""
    start = extra = 0
    while places and len(text) - start > least and (place := places.search(text, start + least)):
        yield text[start : place.start()], extra
        start, extra = (place.start(), 1) if place[0] == b"\n" else (place.end(), 0)
    yield text[start:], extra


def even_batches(texts: list[bytes], places: re.Pattern | None, part_bytes: int, batch_bytes: int) -> Iterator[list[tuple[int, bytes, int]]]:
    """Parts of all texts, as ``(text number, part, tokens too many)``, in batches of nearly equal bytes."""
    total = sum(map(len, texts))
    share = total / max(1, -(-total // batch_bytes))
    held: list[tuple[int, bytes, int]] = []
    size = 0
    for i, text in enumerate(texts):
        for part, extra in parts(text, places, part_bytes):
            held.append((i, part, extra))
            size += len(part)
            if size >= share:
                yield held
                held, size = [], 0
    yield held


def count_tokens(
    docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", limit: int = 4096, part_bytes: int = 1 << 15, batch_bytes: int = 1 << 19
) -> DataFrame:
    """``(key, n_bytes, n_tokens, over_limit)`` of every row: UTF-8 bytes, tokens under the sentencepiece ``model``
    without begin and end, and whether these are more than ``limit``.

    The whole text counts, however long; a null or empty text has 0 of both. The strings of special tokens are
    ordinary text, as the library takes them. Rows are independent: one pass without a shuffle, equal texts and
    repeated keys are counted each, and a task that is run again gives the same rows. The model's file must be
    readable under its path on every executor. Memory is that of one Arrow batch, the model, and the ids of
    ``batch_bytes`` of text; a text that offers no safe place to split is encoded at once. An empty table gives no
    rows; other columns are not carried, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=model)
        places = safe_places(library)
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).to_pylist()]
            counts = np.zeros(len(texts), dtype=np.int64)
            for held in even_batches(texts, places, part_bytes, batch_bytes):
                for (i, _, extra), ids in zip(held, library.encode([part for _, part, _ in held], num_threads=1)):
                    counts[i] += len(ids) - extra
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(counts)], ["key", "n_bytes", "n_tokens"])

    kind = docs.select(col(key)).schema[0].dataType.simpleString()
    counted = docs.select(col(key).alias("key"), F.encode(col(text), "UTF-8").alias("text")).mapInArrow(run, f"key {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("key").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
