"""Packing of tokenised documents into fixed windows, online and with a bounded number of open windows."""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame

from sheaf.llm.common import col

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def load_tokenizer(path: str, pattern: str):
    """A function from texts to ids, the same as ``tokenizers`` gives for the byte-level BPE file at ``path``.

    The file's vocabulary is in merge order, so its ranks are its ids and tiktoken, several times as fast, gives
    the same ids. A text that holds a special token's string goes to ``tokenizers`` itself.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that a byte-level vocabulary shows as they are
    hidden = [b for b in range(256) if b not in set(shown)]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    special = {t["content"] for t in spec["added_tokens"]}
    ranks = {bytes(byte[c] for c in word): i for word, i in spec["model"]["vocab"].items() if word not in special}
    fast = tiktoken.Encoding("ids", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    rare = re.compile("|".join(map(re.escape, sorted(special))) or "(?!)")
    slow: list = []

    def ids(text: str) -> list[int]:
        if not rare.search(text):
            return fast.encode_ordinary(text)
        if not slow:
            from tokenizers import Tokenizer

            slow.append(Tokenizer.from_file(path))
        return slow[0].encode(text, add_special_tokens=False).ids

    return ids


class OpenWindows:
    """At most ``most`` open windows of ``size`` ids. A piece is ``(row, start, ids)``; full windows go to ``done``."""

    def __init__(self, size: int, most: int, least_cut: int) -> None:
        self.size, self.most, self.least_cut = size, most, least_cut
        self.open: list[tuple[int, list]] = []  # (room, pieces)
        self.done: list[list] = []

    def add(self, row, ids: np.ndarray) -> None:
        at = 0
        while len(ids) - at >= self.size:
            self.done.append([(row, at, ids[at : at + self.size])])
            at += self.size
        if at < len(ids):
            self.place(row, at, ids[at:])

    def place(self, row, start: int, ids: np.ndarray) -> None:
        fits = [i for i, (room, _) in enumerate(self.open) if room >= len(ids)]
        if not fits and len(self.open) >= self.most:
            fullest = min(range(self.most), key=lambda i: self.open[i][0])
            room, pieces = self.open.pop(fullest)
            if room >= self.least_cut:  # fill it up rather than pad it
                pieces.append((row, start, ids[:room]))
                start, ids = start + room, ids[room:]
            self.done.append(pieces)
            fits = [i for i, (room, _) in enumerate(self.open) if room >= len(ids)]
        if fits:
            best = min(fits, key=lambda i: self.open[i][0])
            room, pieces = self.open.pop(best)
        else:
            room, pieces = self.size, []
        pieces.append((row, start, ids))
        if room == len(ids):
            self.done.append(pieces)
        else:
            self.open.append((room - len(ids), pieces))

    def close(self) -> None:
        """Merges what is left: the open windows' pieces, fullest first, are cut into full windows, and the last
        rest into lengths that are powers of two, which need no padding."""
        pieces = [p for _, window in sorted(self.open, key=lambda w: w[0]) for p in window]
        left = sum(len(ids) for _, _, ids in pieces)
        room, window = 0, []
        for row, start, ids in pieces:
            while len(ids):
                if not room:
                    room, window = min(self.size, 1 << (left.bit_length() - 1)), []
                    self.done.append(window)
                take = min(room, len(ids))
                window.append((row, start, ids[:take]))
                start, ids, room, left = start + take, ids[take:], room - take, left - take
        self.open = []


def pack_documents(
    docs: DataFrame, tokenizer: str, pattern: str, key: str = "doc_id", text: str = "text", size: int = 2048, end_id: int = 1, open_windows: int = 64, least_cut: int = 16
) -> DataFrame:
    """One row per piece: key, ``start``, ``length``, ``ids`` (little-endian unsigned 32-bit), ``doc_tokens``,
    ``sequence_id`` and ``offset``.

    A document's ids end with ``end_id``; a null or empty text has that id alone. Documents longer than a window
    are cut at its size, and the rest goes to the open window with the least room that takes it. If none takes it
    and no more may be opened, the fullest is emitted; it is topped up first if at least ``least_cut`` ids would
    be padding. A partition merges its leftovers at its end, the last into lengths that are powers of two. So
    each partition is packed by itself: no shuffle, nothing kept but the open windows, and a task that is run
    again gives the same rows. ``size`` must be a power of two. Repeated rows are packed each; an empty table gives no rows.
    Other columns are not carried, as a piece's key tells where they are.
    """
    if size < 1 or size & (size - 1):
        raise ValueError("size must be a power of two")
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, windows = load_tokenizer(tokenizer, pattern), OpenWindows(size, open_windows, least_cut)
        next_id = TaskContext.get().partitionId() << 33
        key_type = None

        def rows():
            nonlocal next_id
            out = {n: [] for n in ("key", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")}
            for window in windows.done:
                offset = 0
                for (name, tokens), start, ids in window:
                    for column, value in zip(out.values(), (name, start, len(ids), ids.tobytes(), tokens, next_id, offset)):
                        column.append(value)
                    offset += len(ids)
                next_id += 1
            windows.done = []
            types = [key_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], list(out))

        for batch in batches:
            key_type = batch.schema.field(0).type
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                body = body.as_py()
                ids = np.array([*(encode(body) if body else ()), end_id], dtype="<u4")
                windows.add((name, len(ids)), ids)
                if len(windows.done) >= 256:
                    yield rows()
        windows.close()
        if windows.done:
            yield rows()

    shape = f"key {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    packed = docs.select(col(key).alias("key"), col(text).alias("text")).mapInArrow(run, shape)
    return packed.withColumnRenamed("key", key)
