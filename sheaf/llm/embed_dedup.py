"""Near copies among vectors: balanced binary codes, multi-index Hamming tables, then the original vectors."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import col, components, usable
from sheaf.session import settle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FOUND = 0.99  # of the pairs at the least cosine, as simulated on the sample
MOST_TABLES = 64  # where more were needed, all pairs of a label are compared
BLOCK = 1024  # vectors that are then compared with as many others at once


def learn_rotation(sample: np.ndarray, bits: int, rounds: int = 50, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Iterative quantisation: the mean, and a rotated principal projection whose signs lose least.

    Directions without variance are filled up at random, so that any number of rows and components gives ``bits`` bits.
    """
    rng = np.random.default_rng(seed)
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, _, axes = np.linalg.svd(np.vstack([centred, 1e-9 * rng.standard_normal((bits, sample.shape[1]))]), full_matrices=False)
    project = axes[:bits].T
    if project.shape[1] < bits:
        project = np.hstack([project, rng.standard_normal((len(project), bits - project.shape[1])) / np.sqrt(len(project))])
    seen = centred @ project
    rotation = np.linalg.qr(rng.standard_normal((bits, bits)))[0]
    for _ in range(rounds):
        left, _, right = np.linalg.svd(np.where(seen @ rotation >= 0, 1.0, -1.0).T @ seen)
        rotation = (left @ right).T
    return mean, project @ rotation


def more_tables(turn: np.ndarray, bits: int, bits_each: int, tables: int, seed: int = 11) -> np.ndarray:
    """``turn`` with random rotations of its directions beside it, cut to ``tables`` tables."""
    rng, parts = np.random.default_rng(seed), [turn]
    while sum(p.shape[1] for p in parts) < tables * bits_each:
        parts.append(turn @ np.linalg.qr(rng.standard_normal((bits, bits)))[0])
    return np.hstack(parts)[:, : tables * bits_each]


def recall_by_tables(unit: np.ndarray, mean: np.ndarray, turn: np.ndarray, least: float, bits_each: int, flips: int, seed: int = 13) -> np.ndarray:
    """The share of pairs at cosine ``least`` that meet in the first 1, 2, 3, … tables of ``turn``.

    The pairs are sample rows, each turned by that angle once to any side and once towards where the data vary; the lesser share counts.
    """
    rng, shares = np.random.default_rng(seed), []
    x = unit[np.arange(max(4096, len(unit))) % len(unit)]
    for side in (rng.standard_normal(x.shape), unit[rng.integers(len(unit), size=len(x))] - unit[rng.integers(len(unit), size=len(x))]):
        side = side - (side * x).sum(axis=1)[:, None] * x
        size = np.sqrt((side * side).sum(axis=1))
        there = size > 1e-9
        if not there.any():
            continue
        a, side = x[there], side[there] / size[there][:, None]
        b = least * a + np.sqrt(max(0.0, 1 - least * least)) * side
        differ = ((a - mean) @ turn >= 0) != ((b - mean) @ turn >= 0)
        meets = differ.reshape(len(a), -1, bits_each).sum(axis=2) <= flips
        shares.append(np.logical_or.accumulate(meets, axis=1).mean(axis=0))
    return np.min(shares, axis=0) if shares else np.ones(turn.shape[1] // bits_each)


def all_pairs(part: DataFrame, least: float) -> DataFrame:
    """``(a, b, label)`` of all pairs of a label at about ``least`` or more; pairs of blocks are compared, and no label is gathered."""
    counts = settle(part.groupBy("label").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")))
    own = F.pmod(F.xxhash64("id", "vec"), "blocks").cast("int")
    cells = part.join(counts, "label").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = cells.select("label", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "id", "vec")
    kind = dict(part.dtypes)["label"]

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        vectors = np.stack(rows["vec"].to_list())
        vectors = vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]
        ids, own = rows["id"].to_numpy(), rows["own"].to_numpy()
        left, right = np.flatnonzero(own == rows["x"].iloc[0]), np.flatnonzero(own == rows["y"].iloc[0])
        i, j = np.nonzero(vectors[left] @ vectors[right].T >= least - 1e-9)
        a, b = ids[left[i]], ids[right[j]]
        pairs = pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})[a != b].drop_duplicates()
        return pairs.assign(label=rows["label"].iloc[0])

    return cells.groupBy("label", "x", "y").applyInPandas(compare, f"a long, b long, label {kind}")


def meeting(found: DataFrame, tables: int, bits_each: int, flips: int) -> DataFrame:
    """``(a, b, label)`` of pairs whose codes differ in at most ``flips`` bits of one of up to ``tables`` tables."""
    stored = found.select("dim", "label", F.posexplode("codes").alias("table", "code"), F.col("id").alias("b"), F.col("codes").alias("codes_b"))
    probes = [F.col("code"), *[F.col("code").bitwiseXOR(F.lit(1 << i)) for i in range(bits_each if flips else 0)]]
    asked = found.select("dim", "label", F.posexplode("codes").alias("table", "code"), F.col("id").alias("a"), F.col("codes").alias("codes_a"))
    asked = asked.withColumn("code", F.explode(F.array(*probes)))
    met = asked.join(stored, ["dim", "label", "table", "code"]).where("a < b")
    # a pair is taken from the first table in which it meets, so that no pair comes twice
    apart = [F.bit_count(F.get("codes_a", F.lit(t)).bitwiseXOR(F.get("codes_b", F.lit(t)))) > flips for t in range(tables)]
    first = F.lit(True)
    for t in range(tables):
        first = first & ((F.col("table") <= t) | apart[t])
    return met.where(first).select("a", "b", "label")


def near_vectors(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    least: float = 0.98,
    tables: int = 4,
    bits_each: int = 16,
    flips: int = 1,
    sample_rows: int = 4096,
) -> DataFrame:
    """``(key, n_links, component_id, kept)``, one row per row of ``vectors``.

    Two rows of equal, not null label are linked if the cosine of their vectors in double precision is at least
    ``least``. A pair is looked at if in one table of ``bits_each`` bits its codes differ in at most ``flips`` bits (0 or
    1). There are ``tables`` of them, or as many more as it takes until ``FOUND`` of simulated pairs at a cosine of
    ``least`` meet: with a mean near 0 a bit differs in 1 of 16 cases at 0.98, which 4 tables of 16 bits with one flip miss in
    about 1 of 200 cases, but codes are signs after the mean is taken off, which widens the angles of vectors that have
    one in common. Where ``MOST_TABLES`` are too few, all pairs of a label are compared, and none is missed. The
    rotation is learned from the ``sample_rows`` usable rows whose keys have the least hashes; all rows are coded.

    Equal vectors of one label are compared as one and counted as many, so a group of exact copies of any size makes
    no pairs. Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do rows with a
    null key or label, nor vectors of different lengths. They keep a row with no links and themselves as component. Rows
    of one key count as one vector if they are equal; a key with several vectors is one row per vector, linked through
    each. An empty table gives no rows. Other columns are ignored.
    """
    if flips not in (0, 1) or bits_each > 30 or tables * bits_each > 64:
        raise ValueError("up to 64 bits in tables of up to 30, with 0 or 1 flips")
    bits, spark = tables * bits_each, vectors.sparkSession
    rows = vectors.select(col(key).alias("id"), col(label).alias("label"), col(vector).cast("array<double>").alias("vec"))
    rows = settle(rows)
    usable_rows = rows.where(usable(F.col("vec")) & F.col("id").isNotNull() & F.col("label").isNotNull())
    # exact copies are told by a digest of 128 bits; keys with several vectors stand for themselves
    digest = [F.xxhash64(F.lit(seed), F.col("vec")).alias(name) for seed, name in ((1, "_high"), (2, "_low"))]
    row = F.struct(F.col("label"), *digest)
    many = usable_rows.groupBy("id").agg(F.min(row).alias("least"), F.max(row).alias("most"))
    many = settle(many.where(~F.col("least").eqNullSafe(F.col("most"))).select("id"))
    alone = usable_rows.join(many, "id", "left_anti").select("id", "label", *digest).distinct()
    same = ["label", "_high", "_low"]
    copies = settle(alone.groupBy(*same).agg(F.min("id").alias("unit"), F.count("*").alias("copies")))
    units = settle(copies.select("unit", "copies"))
    member = settle(alone.join(copies.where("copies > 1"), same).where("id <> unit").select("id", "unit"))
    clean = settle(usable_rows.join(member, "id", "left_anti").distinct())  # one row per unit
    sizes = clean.groupBy(F.size("vec").alias("dim")).count().collect()  # one row per vector length
    found, whole, most = None, None, tables
    for dim in sorted(r["dim"] for r in sizes):
        part = clean.where(F.size("vec") == dim)
        picked = part.orderBy(F.xxhash64("id"), "id").limit(sample_rows).collect()
        sample = np.array([r["vec"] for r in picked])
        unit = sample / np.linalg.norm(sample, axis=1)[:, None]
        mean, turn = learn_rotation(unit, bits)
        count = tables
        if recall_by_tables(unit, mean, turn, least, bits_each, flips)[-1] < FOUND:
            turn = more_tables(turn, bits, bits_each, max(tables, MOST_TABLES))
            enough = recall_by_tables(unit, mean, turn, least, bits_each, flips) >= FOUND
            if not enough.any():
                met = all_pairs(part, least)
                whole = met if whole is None else whole.union(met)
                continue
            count = int(enough.argmax()) + 1
            turn = turn[:, : count * bits_each]
        most = max(most, count)
        weights = 1 << np.arange(bits_each, dtype=np.int64)

        def code(batches: Iterator[pd.DataFrame], mean=mean, turn=turn, count=count) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    x = np.stack(batch["vec"].to_list())
                    signs = (x / np.sqrt((x * x).sum(axis=1))[:, None] - mean) @ turn >= 0
                    chunks = signs.reshape(len(x), count, bits_each) @ weights
                    yield pd.DataFrame({"id": batch["id"], "label": batch["label"], "codes": list(chunks)})

        kinds = {f.name: f.dataType.simpleString() for f in part.schema}
        coded = part.mapInPandas(code, f"id {kinds['id']}, label {kinds['label']}, codes array<long>").withColumn("dim", F.lit(dim))
        found = coded if found is None else found.union(coded)
    own = F.col("id").alias("component_id")
    if not sizes:
        return rows.select(F.col("id").alias(key), F.lit(0).cast("long").alias("n_links"), own, F.lit(True).alias("kept"))
    if found is not None:
        pairs = meeting(settle(found), most, bits_each, flips)
        pairs = pairs if whole is None else pairs.union(whole)
    else:
        pairs = whole
    pairs = settle(pairs)
    values = clean.select("id", "label", "vec")
    left = values.select(F.col("id").alias("a"), "label", F.col("vec").alias("va"))
    right = values.select(F.col("id").alias("b"), "label", F.col("vec").alias("vb"))
    both = pairs.join(left, ["a", "label"]).join(right, ["b", "label"])

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, some in batch.groupby(batch["va"].map(len)) if len(batch) else ():
                x, y = np.stack(some["va"].to_list()), np.stack(some["vb"].to_list())
                cosine = (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))
                yield some.loc[cosine >= least, ["a", "b"]]

    links = settle(both.select("a", "b", "va", "vb").mapInPandas(near, "a long, b long").distinct())
    both_ways = links.union(links.select("b", "a"))
    weight = F.coalesce("copies", F.lit(1))
    ends = both_ways.join(units.withColumnRenamed("unit", "b"), "b", "left").groupBy("a").agg(F.sum(weight).alias("others"))
    joined = components(links)
    # back to all rows: copies have the links of their unit, and each other
    unit = F.coalesce("unit", "id")
    out = rows.select("id").join(member, "id", "left").select("id", unit.alias("a"))
    out = out.join(units.withColumnRenamed("unit", "a"), "a", "left").join(ends, "a", "left").join(joined.withColumnRenamed("node", "a"), "a", "left")
    n_links = F.coalesce("others", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1
    out = out.select("id", n_links.alias("n_links"), F.coalesce("component", "a").alias("component"))
    component = F.coalesce("component", "id").alias("component_id")
    return out.select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component, F.coalesce(component.eqNullSafe(F.col("id")), F.lit(True)).alias("kept"))
