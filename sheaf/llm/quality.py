"""Quality by an interpolated modified Kneser-Ney model of byte n-grams, trained on trusted text."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import col
from sheaf.session import settle, shared_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SYMBOLS = 257  # bytes and the end of a text; the end is byte 3, the start byte 0
AT_ONCE = 1_000_000  # bytes whose n-grams are sorted together
SHELF = 4_000_000  # bytes of text compressed together
BLOCK = 16_000_000  # bytes of text that ask for their n-grams together
GRAMS_HELD = 4_000_000  # n-grams a task holds before it sends them


def grams(bodies: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of the texts, packed into integers with the last symbol lowest, and the number in each text.

    Texts are led by ``order - 1`` zero bytes and closed by one end byte, so a text has one n-gram more than bytes.
    """
    lead = b"\0" * (order - 1)
    data = np.frombuffer(b"".join(lead + b + b"\3" for b in bodies), np.uint8).astype(np.uint64)
    whole = np.zeros(max(0, len(data) - order + 1), np.uint64)
    for j in range(order):
        whole = (whole << np.uint64(8)) | data[j : len(data) - order + 1 + j]
    sizes = np.array([len(b) + 1 for b in bodies])
    # between two texts lie n-grams that belong to neither
    starts = np.cumsum(sizes + order - 1) - (sizes + order - 1)
    inside = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    return whole[inside], sizes


def groups_of(bodies: list[bytes], most: int) -> Iterator[slice]:
    start = held = 0
    for i, body in enumerate(bodies):
        if held and held + len(body) > most:
            yield slice(start, i)
            start, held = i, 0
        held += len(body)
    if start < len(bodies):
        yield slice(start, len(bodies))


def unpacked(shelf: bytes) -> pa.Table:
    return pa.ipc.open_stream(shelf).read_all()


def shelve(rows: DataFrame) -> DataFrame:
    """``(block, shelf)``: the rows as compressed tables of about ``SHELF`` bytes, ``BLOCK`` bytes of them to a block.

    A block is named by the task that wrote it, so it holds together only once it is written. A text of
    more bytes than a block is a block by itself. Rows of different ``block`` never share one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held, size, filled = TaskContext.get().partitionId(), {}, {}, {}
        zstd = pa.ipc.IpcWriteOptions(compression="zstd")

        def flush(block: str) -> pa.RecordBatch:
            whole, out = pa.Table.from_batches(held.pop(block)).combine_chunks(), pa.BufferOutputStream()
            with pa.ipc.new_stream(out, whole.schema, options=zstd) as stream:
                stream.write_table(whole)
            name = f"{task}/{filled.get(block, 0) // BLOCK}/{block}"
            filled[block] = filled.get(block, 0) + size.pop(block)
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([out.getvalue().to_pybytes()], pa.binary())], ["block", "shelf"])

        for batch in batches:
            blocks = np.array(batch.column(0).to_pylist(), object)
            texts = batch.column(batch.schema.get_field_index("text"))
            bytes_of = np.array([len(t.as_buffer()) if t.is_valid else 0 for t in texts]) + 16
            for block in dict.fromkeys(blocks):
                at = np.flatnonzero(blocks == block)
                for part in parts_of(bytes_of[at], SHELF):
                    held.setdefault(block, []).append(batch.take(pa.array(at[part])).drop_columns(["block"]))
                    size[block] = size.get(block, 0) + int(bytes_of[at[part]].sum())
                    if size[block] >= SHELF:
                        yield flush(block)
            if sum(size.values()) >= 4 * SHELF:  # many blocks at a time
                for block in list(held):
                    yield flush(block)
        for block in list(held):
            yield flush(block)

    return rows.mapInArrow(run, "block string, shelf binary")


def written_by_block(shelves: DataFrame) -> DataFrame:
    """The shelves as a table in the shared folder, bucketed by block, so that its texts are not shuffled to meet their answers."""
    spark = shelves.sparkSession
    path = shared_dir(spark, "shelves")
    name = "shelves_" + path[-32:]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shelves.write.bucketBy(buckets, "block").option("path", path).option("compression", "none").format("parquet").saveAsTable(name)
    return spark.table(name)


def parts_of(sizes: np.ndarray, most: int) -> Iterator[slice]:
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield slice(start, len(sizes))


def encoded(texts: pa.ChunkedArray) -> list[bytes]:
    return [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in texts]


def count_grams(shelves: DataFrame, order: int) -> DataFrame:
    """``(block, gram, c)``: the distinct n-grams of each block, and how often they are in its counted texts.

    A task adds up before it sends, so a block sends an n-gram about once, however often it occurs.
    """

    def send(held: dict[str, tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for block, (found, n) in held.items():
            for a in range(0, len(found), 100_000):
                part = slice(a, a + 100_000)
                size = len(found[part])
                arrays = [pa.array([block] * size), pa.array(found[part].astype(np.int64)), pa.array(n[part])]
                yield pa.RecordBatch.from_arrays(arrays, ["block", "gram", "c"])
        held.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for block, shelf in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if block not in held and sum(len(x) for x, _ in held.values()) > GRAMS_HELD:
                    yield from send(held)
                table = unpacked(shelf)
                counted, texts = np.array(table.column("counted").to_pylist(), bool), encoded(table.column("text"))
                for own in (True, False):
                    bodies = [texts[i] for i in np.flatnonzero(counted == own)]
                    for part in groups_of(bodies, AT_ONCE):
                        found, n = np.unique(grams(bodies[part], order)[0], return_counts=True)
                        before = held.get(block, (np.empty(0, np.uint64), np.empty(0, np.int64)))
                        merged, at = np.unique(np.concatenate([before[0], found]), return_inverse=True)
                        held[block] = merged, np.bincount(at, np.concatenate([before[1], n * own]), len(merged)).astype(np.int64)
        yield from send(held)

    return shelves.mapInArrow(run, "block string, gram long, c long")


def discounts(n: list[int]) -> list[float]:
    """D1, D2 and D3+ from how many n-grams occur once, twice, three and four times."""
    n1, n2, n3, n4 = n
    if not n1 or not n2:
        return [0.5, 0.75, 1.0]
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.0]
    return [min(max(d, 0.1), k + 0.9) for k, d in enumerate(raw)]


def model_probabilities(counts: DataFrame, wanted: DataFrame, order: int) -> DataFrame:
    """``(gram, p)`` for every n-gram of ``wanted(gram)``, from ``counts(gram, c)``.

    The highest order counts occurrences, lower orders in how many different n-grams of the next one an n-gram ends.
    An order interpolates with the next lower one, the lowest with even chances. Each step joins tables that are
    sharded by n-gram or by context.
    """
    mask = lambda c, k: F.col(c).bitwiseAND(F.lit((1 << 8 * k) - 1))
    context = F.shiftright("gram", 8)
    levels = {order: counts}
    for k in range(order - 1, 0, -1):
        levels[k] = settle(levels[k + 1].groupBy(mask("gram", k).alias("gram")).agg(F.count("*").alias("c")))
    rare = [levels[k].where("c <= 4").groupBy(F.lit(k).alias("k"), "c").agg(F.count("*").alias("n")) for k in levels]
    seen = rare[0]
    for more in rare[1:]:
        seen = seen.union(more)
    times = {(r["k"], r["c"]): r["n"] for r in seen.collect()}  # four numbers for each order
    below = None
    for k in range(1, order + 1):
        d = discounts([times.get((k, c), 0) for c in (1, 2, 3, 4)])
        discount = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        sums = levels[k].groupBy(context.alias("context")).agg(F.sum("c").alias("total"), F.sum(F.least(discount, F.col("c"))).alias("left"))
        sums = settle(sums.select("context", "total", (F.col("left") / F.col("total")).alias("back")))
        need = wanted.select(mask("gram", k).alias("gram")).distinct() if k < order else wanted
        kept = levels[k].select("gram", F.greatest(F.col("c") - discount, F.lit(0.0)).alias("own"))
        found = need.join(kept, "gram", "left").withColumn("context", context).join(sums, "context", "left")
        own, back = F.coalesce(F.col("own") / F.col("total"), F.lit(0.0)), F.coalesce("back", F.lit(1.0))
        if below is None:
            lower = F.lit(1 / SYMBOLS)
        else:
            found = found.withColumn("_lower", mask("gram", k - 1)).join(below.withColumnsRenamed({"gram": "_lower", "p": "_p"}), "_lower")
            lower = F.col("_p")
        below = settle(found.select("gram", (own + back * lower).alias("p")))
    return below


def perplexities(
    docs: DataFrame,
    trusted: Column,
    block: Column | None = None,
    order: int = 5,
    key: str = "doc_id",
    text: str = "text",
    keep: tuple[str, ...] = (),
    held: Column | None = None,
) -> DataFrame:
    """Key, ``keep`` columns, ``trusted``, ``held`` and ``perplexity`` per byte of every document under the model of the trusted ones.

    Trusted documents for which ``held`` holds are not counted in the model: what it says of them is what it
    says of good text it has not seen. The documents are written once, compressed, in blocks of bounded size that
    are read back as they were written, so nothing depends on how the input is split; rows of different ``block`` never share one. A
    block asks for the probabilities of its distinct n-grams and gets them back beside its texts. Null texts are empty;
    the end of a text counts as a byte. With no trusted text all symbols are alike. An empty table gives no rows.
    """
    extra = [f"_k{i}" for i in range(len(keep))]
    good, out = F.coalesce(trusted, F.lit(False)), F.lit(False) if held is None else F.coalesce(held, F.lit(False))
    named = F.lit("") if block is None else F.coalesce(block.cast("string"), F.lit(""))
    columns = [named.alias("block"), good.alias("trusted"), (good & out).alias("held"), (good & ~out).alias("counted"), col(text).alias("text")]
    rows = docs.select(*columns, col(key).alias("key"), *[col(c).alias(e) for c, e in zip(keep, extra)])
    shelves = written_by_block(shelve(rows))
    asked = settle(count_grams(shelves, order))
    totals = settle(asked.groupBy("gram").agg(F.sum("c").alias("c")))
    known = model_probabilities(totals.where("c > 0"), totals.select("gram"), order)
    answers = asked.select("block", "gram").join(known, "gram").select("block", "gram", F.ln("p").cast("float").alias("p"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    carried = ["key", "trusted", "held", *extra]

    def rate(shelves: pa.Table, answers: pa.Table) -> pa.Table:
        gram, p = answers.column("gram").to_numpy().astype(np.uint64), answers.column("p").to_numpy()
        by = np.argsort(gram)
        gram, p = gram[by], p[by].astype(np.float64)
        rated = []
        for shelf in shelves.column("shelf"):
            table = unpacked(shelf.as_py())
            bodies, out = encoded(table.column("text")), [np.zeros(0)]
            for part in groups_of(bodies, AT_ONCE):
                found, sizes = grams(bodies[part], order)
                distinct, at = np.unique(found, return_inverse=True)
                place = np.searchsorted(gram, distinct)
                if len(distinct) and (place[-1] >= len(gram) or (gram[place] != distinct).any()):
                    raise ValueError("an n-gram has no answer")
                ends = np.cumsum(sizes)
                out.append(np.exp(-np.add.reduceat(p[place][at], ends - sizes) / sizes))
            rated.append(table.select(carried).append_column("perplexity", pa.array(np.concatenate(out), pa.float64())))
        return pa.concat_tables(rated)

    shape = ", ".join(f"{c} {kinds[c]}" for c in carried) + ", perplexity double"
    rated = shelves.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(rate, shape)
    return rated.select(F.col("key").alias(key), *[F.col(e).alias(c) for e, c in zip(extra, keep)], "trusted", "held", "perplexity")


def classify(rated: DataFrame, lang: str = "lang", quantile: float = 0.995) -> DataFrame:
    """Adds ``threshold``, the ``quantile`` of the perplexities of a language's held trusted documents, and ``kept``.

    Documents the model was trained on look better to it than others of their kind, so only where none at all
    was held out do trusted documents in the model set the thresholds. Null is a language of its own. A language
    without such documents takes the quantile of all; without any trusted document everything is kept. Thresholds are
    approximate quantiles with an error of one in ten thousand ranks.
    """
    at = F.percentile_approx("perplexity", quantile, 10_000)
    some = rated.where("held").limit(1).count() > 0
    sample = rated.where("held" if some else "trusted")
    own = settle(sample.groupBy(col(lang).alias("_lang")).agg(at.alias("_own")))
    every = sample.agg(at.alias("t")).first()["t"]
    out = rated.join(own, col(lang).eqNullSafe(F.col("_lang")), "left")
    threshold = F.coalesce("_own", F.lit(every).cast("double"))
    return out.withColumn("threshold", threshold).withColumn("kept", F.coalesce(F.col("perplexity") <= threshold, F.lit(True))).drop("_lang", "_own")
