"""Jaccard join on word shingles: prefixes under several global token orders, then the whole sets."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import col, components
from sheaf.session import settle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS = 48  # of a token on its way
SHORT, LONG = 288, 259  # sets up to SHORT are joined by all tokens, sets from LONG, or less (see sizes), on by a share of them
PER_BUCKET = 1_000_000
BLOCK = 64  # sets that are compared with as many others at once
AT_ONCE = 4_000_000  # tokens that a task holds to add them up


class WordHashes(dict):
    """Hashes of words seen, forgotten when there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str | None, width: int, hashes: WordHashes) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes. Bytes are split at ASCII white space and only A-Z lower-cased."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    wide = min(width, len(h))
    z = h[: len(h) - wide + 1] + np.uint64(wide)
    for j in range(1, wide):
        z = (z ^ (z >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + h[j : len(h) - wide + 1 + j]
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return np.unique(z ^ (z >> np.uint64(31)))


def to_bytes(tokens: np.ndarray) -> bytes:
    """48-bit tokens as six bytes each: all low halves, then all high parts."""
    return (tokens & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes() + (tokens >> np.uint64(32)).astype("<u2").tobytes()


def from_bytes(body: bytes) -> np.ndarray:
    n = len(body) // 6
    return np.frombuffer(body, "<u4", n).astype(np.uint64) | (np.frombuffer(body, "<u2", n, 4 * n).astype(np.uint64) << np.uint64(32))


def sizes(num: int, den: int) -> tuple[int, int]:
    """The least size joined by a share of the tokens, and the share's power of 1/2.

    Sets below the least size are linked with none above SHORT, so any two linked sets meet in a join. The share is
    at least 2.5 times the prefix, if not all tokens: a fourth at 0.9, half at 0.8.
    """
    return min(LONG, -(-num * (SHORT + 1) // den)), max(s for s in (0, 1, 2) if s == 0 or 2 * den >= 5 * (den - num) << s)


def bands(n: int, long: int) -> list[int]:
    """The joins a set of n tokens takes part in: 0 by all tokens, 1, from ``long`` on, by a share of them."""
    return [0] * (n <= SHORT) + [1] * (n >= long)


def lacking(n, num: int, den: int):
    """Prefix length: a set of n tokens shares one of any so many with every set it is linked with."""
    return n + (-num * n // den) + 1


def other_prefix(tokens: np.ndarray, length: int, order: int) -> np.ndarray:
    """The ``length`` first tokens under a seeded global order, as their 32-bit ranks."""
    rank = tokens * np.uint64((0xD6E8FEB86659FD93, 0xA0761D6478BD642F)[order])
    rank ^= rank >> np.uint64(32)
    rank = (rank * np.uint64(0xE7037ED1A0B428DB)) >> np.uint64(32)
    return np.sort(rank)[:length].astype("<u4")


def in_buckets(bucket: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else []
    for a, b in zip(starts, [*starts[1:], len(bucket)]):
        yield (int(bucket[a]), *[c[order[a:b]] for c in columns])


def shared_counts(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many tokens each set of ``left`` shares with each of ``right`` (positions), by products of 0/1 tiles."""
    used = np.unique(np.concatenate([left, right]))
    tokens = np.concatenate([sets[i] for i in used])
    distinct, at, times = np.unique(tokens, return_inverse=True, return_counts=True)
    rows = np.repeat(np.arange(len(used)), [len(sets[i]) for i in used])
    common = times > 1  # a token of one set is shared by none
    column = np.cumsum(common) - 1
    rows, column = rows[common[at]], column[at[common[at]]]
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    out = np.zeros((len(left), len(right)), np.float32)
    a, b = np.searchsorted(used, left), np.searchsorted(used, right)
    for start in range(0, int(common.sum()), 8192):
        lo, hi = np.searchsorted(column, [start, start + 8192])
        tile = np.zeros((len(used), min(8192, int(common.sum()) - start)), np.float32)
        tile[rows[lo:hi], column[lo:hi] - start] = 1
        out += tile[a] @ tile[b].T
    return out


def block_links(rows: pd.DataFrame, num: int, den: int) -> pd.DataFrame:
    """Links among the sets of one group that join its parts, each pair of blocks x, y compared once."""
    sets = [from_bytes(t) for t in rows["tokens"]]
    n, ids, own = np.array([len(s) for s in sets]), rows["id"].to_numpy(), rows["own"].to_numpy()
    left = np.flatnonzero(own == rows["x"].iloc[0])
    right = np.flatnonzero(own == rows["y"].iloc[0])
    na, nb = n[left][:, None], n[right][None, :]
    may = (ids[left][:, None] != ids[right][None, :]) & (den * na >= num * nb) & (den * nb >= num * na)
    prefixes = [[np.asarray(f, np.uint64) for f in rows["first"]]]
    prefixes += [[other_prefix(s, lacking(len(s), num, den), k) for s in sets] for k in (0, 1)]
    for prefix in prefixes:
        if may.any():
            may &= shared_counts(prefix, left, right) > 0
    a, b = may.any(axis=1), may.any(axis=0)
    out: list[tuple[int, int]] = []
    if a.any():
        shared = shared_counts(sets, left[a], right[b])
        good = may[np.ix_(a, b)] & (den * shared.astype(np.int64) >= num * (na[a] + nb[:, b] - shared.astype(np.int64)))
        root = {}

        def top(x):
            while root.setdefault(x, x) != x:
                root[x] = x = root[root[x]]
            return x

        for i, j in zip(*np.nonzero(good)):
            x, y = sorted((int(ids[left[a]][i]), int(ids[right[b]][j])))
            u, v = top(x), top(y)
            if u != v:
                root[max(u, v)] = min(u, v)
                out.append((x, y))
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def shingle_links(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """``(key, n_shingles, component_id)``, one row per document; linked are sets whose ``den * shared >= num * union``.

    A text with fewer than ``width`` words is one shingle; without words it has none and links with nothing, as does a
    row with a null key. A key given several times is one document that links through each of its texts. Keys must be
    integers. Other columns are ignored; an empty table gives no rows. Shingles are compared by 48 bits of a 64-bit hash.

    1. Sets are made in one pass. Rows of equal sets are one node, the least key.
    2. First order: rare tokens first. A task adds up in how many of its sets a token is and sends that, packed, to
       buckets of the hash space, which tell each part of the table which of its tokens are shared and by how many
       sets. So a token costs a bucket one number per part, however many sets hold it. A set whose prefix holds
       only tokens of its own is linked with nothing. Long sets send a fourth of the token space, at lower similarities
       half or all of it: any choice that depends on the token alone is a global order, in which the chosen ones
       come first. A long set with too few of them, which hardly happens, is compared with all sets of about its size.
    3. Sets that share a prefix token go to the bucket of the token's least set. A large bucket is cut into blocks
       by a hash, and each pair of blocks is one group of at most ``2 * BLOCK`` sets, so no group is unbounded and
       pairs never become rows.
    4. Within a group, candidates must share prefix tokens under all three orders; these are verified on the
       whole sets. Only links that join what the group has not yet joined are sent on.
    """
    hundred = (num, den)
    long, halved = sizes(num, den)
    plain = docs.select(col(key).cast("long").alias("id"), col(text).alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, at, part = WordHashes(), 0, TaskContext.get().partitionId()
        for batch in batches:
            n, prints, low, posted = [], [], [], []
            for body in batch.column(1):
                shingles = shingle_set(body.as_py(), width, hashes)
                tokens = shingles >> np.uint64(64 - BITS)
                chosen = np.searchsorted(tokens, np.uint64(1 << (BITS - halved)))
                n.append(len(tokens))
                posted.append(int(chosen))
                prints.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                low.append(to_bytes(tokens if len(tokens) <= SHORT else tokens[:chosen]))
            size = len(n)
            values = [batch.column(0), pa.array(n, pa.int64()), pa.array(posted, pa.int64()), pa.array(prints, pa.binary())]
            values += [pa.array([part] * size, pa.int32()), pa.array(range(at, at + size), pa.int32()), pa.array(low, pa.binary())]
            at += size
            yield pa.RecordBatch.from_arrays(values, ["id", "n", "chosen", "print", "part", "at", "low"])

    signed = settle(plain.mapInArrow(sign, "id long, n long, chosen long, print binary, part int, at int, low binary"))
    real = signed.where("id is not null and n > 0")
    row = F.struct("id", "part", "at")
    first = settle(real.groupBy("print").agg(F.min(row).alias("first"), F.count("*").alias("copies"), F.max("n").alias("n"), F.max("chosen").alias("chosen")))
    nodes = first.select("first.*", "n", "chosen")

    # the first order
    posted = F.when(F.col("n") <= SHORT, F.col("n")).otherwise(F.col("chosen"))
    buckets = max(8, -(-int(nodes.agg(F.sum(posted)).first()[0] or 0) // PER_BUCKET))
    kept = real.join(of_small(nodes.select("part", "at")), ["part", "at"], "left_semi")

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[np.ndarray]] = {}
        waiting = 0

        def added_up() -> pa.RecordBatch:
            out = []
            for (p, band), sets in held.items():
                tokens, times = np.unique(np.concatenate(sets), return_counts=True)
                where = (tokens >> np.uint64(BITS - 32 - halved * band)) * np.uint64(buckets) >> np.uint64(32)
                out += [(2 * b + band, p, to_bytes(t), c.astype("<u4").tobytes()) for b, t, c in in_buckets(where, tokens, times)]
            return pa.RecordBatch.from_pylist([dict(zip(POSTED.names, r)) for r in out], schema=POSTED)

        for batch in batches:
            part, n, chosen, low = (batch.column(i) for i in range(4))
            for p, size, some, body in zip(part.to_pylist(), n.to_pylist(), chosen.to_pylist(), low):
                tokens = from_bytes(body.as_py())
                for band in bands(size, long):
                    held.setdefault((p, band), []).append(tokens[:some] if band else tokens)
                    waiting += len(held[p, band][-1])
                if waiting > AT_ONCE:
                    yield added_up()
                    held.clear()
                    waiting = 0
        if held:
            yield added_up()

    POSTED = pa.schema([("bucket", pa.int32()), ("part", pa.int32()), ("tokens", pa.binary()), ("sets", pa.binary())])
    sent = kept.select("part", "n", "chosen", "low").mapInArrow(post, "bucket int, part int, tokens binary, sets binary")

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        tokens = np.concatenate([from_bytes(t) for t in rows["tokens"]])
        times = np.concatenate([np.frombuffer(s, "<u4") for s in rows["sets"]])
        parts = np.repeat(rows["part"].to_numpy(), [len(s) // 4 for s in rows["sets"]])
        _, at = np.unique(tokens, return_inverse=True)
        sets = np.minimum(np.bincount(at, times), 2**32 - 1)[at]
        shared = sets > 1
        band = int(rows["bucket"].iloc[0]) % 2
        out = [(part, band, to_bytes(t), s.astype("<u4").tobytes()) for part, t, s in in_buckets(parts[shared], tokens[shared], sets[shared])]
        return pd.DataFrame(out, columns=["part", "band", "tokens", "sets"])

    told = sent.groupBy("bucket").applyInPandas(count, "part int, band int, tokens binary, sets binary")

    def prefix(rows: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"token": [], "id": [], "n": []}).astype("int64")]
        ids, n, chosen, low = (members[c].to_numpy() for c in ("id", "n", "chosen", "low"))
        for band in (0, 1):
            own = np.array([band in bands(size, long) for size in n.tolist()], bool)
            posted = n if band == 0 else chosen
            need = lacking(n, *hundred)
            few = own & (posted < need)
            out.append(pd.DataFrame({"token": np.full(few.sum(), -1), "id": ids[few], "n": n[few]}))
            some = rows[rows["band"] == band]
            if some.empty:
                continue
            known, at = np.unique(np.concatenate([from_bytes(t) for t in some["tokens"]]), return_index=True)
            sets = np.concatenate([np.frombuffer(s, "<u4") for s in some["sets"]])[at]
            mine = np.flatnonzero(own)
            steps = np.cumsum(posted[mine]) // AT_ONCE
            for step in np.unique(steps):
                these = mine[steps == step]
                tokens = np.concatenate([from_bytes(low[i])[: posted[i]] for i in these])
                place = np.repeat(np.arange(len(these)), posted[these])
                at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
                there = known[at] == tokens
                tokens, place, times = tokens[there], place[there], sets[at[there]]
                order = np.lexsort((tokens, times, place))
                tokens, place = tokens[order], place[order]
                begin = np.searchsorted(place, np.arange(len(these)))
                shared = np.searchsorted(place, np.arange(len(these)), side="right") - begin
                most = need[these] - (posted[these] - shared)
                first = np.arange(len(place)) - begin[place] < most[place]
                tokens, own_row = tokens[first], these[place[first]]
                out.append(pd.DataFrame({"token": tokens.astype(np.int64) | (band << BITS), "id": ids[own_row], "n": n[own_row]}))
        return pd.concat(out)

    members = kept.select("part", "id", "n", "chosen", "low").groupBy("part")
    prefixes = settle(told.groupBy("part").cogroup(members).applyInPandas(prefix, "token long, id long, n long"))
    marked = prefixes.where("token >= 0")
    rare = prefixes.where("token < 0").select("id", "n").distinct()

    # buckets: the sets that share prefix tokens with one least set
    least = marked.groupBy("token").agg(F.min("id").alias("bucket"), F.max("id").alias("_most"))
    least = settle(least.where("bucket < _most").select("token", "bucket"))
    met = marked.join(least, "token").groupBy("bucket", "id").agg(F.collect_set("token").alias("first"))
    met = settle(met)
    blocks = met.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    wanted = settle(met.select("id").union(rare.select("id")).distinct())

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [np.unique(shingle_set(t.as_py(), width, hashes) >> np.uint64(64 - BITS)) for t in batch.column(1)]
            values = [pa.array([len(s) for s in sets], pa.int64()), pa.array([to_bytes(s) for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *values], ["id", "n", "tokens"])

    shape = "id long, n long, tokens binary"
    sets = plain.join(of_small(wanted), "id", "left_semi").mapInArrow(whole, shape).where("n > 0")
    own = F.pmod(F.xxhash64("id"), "blocks").cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    cells = met.join(settle(blocks), "bucket").withColumn("own", own).withColumn("other", other)
    cells = cells.select("bucket", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "id", "first")
    keys = ["bucket", "x", "y"]
    dealt = cells.join(sets, "id").repartition(*keys).sortWithinPartitions(*keys)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            edges = (held[keys] != held[keys].shift()).any(axis=1).to_numpy().nonzero()[0]
            for a, b in zip(edges, edges[1:]):
                yield block_links(held.iloc[a:b], num, den)
            held = held.iloc[edges[-1] :] if len(edges) else held
        if held is not None and len(held):
            yield block_links(held, num, den)

    links = settle(dealt.select(*keys, "own", "id", "first", "tokens").mapInPandas(compare, "a long, b long").distinct())
    if not rare.isEmpty():  # sets with too few tokens for the order: all sets of about their size
        near_size = (F.col("na") * den >= F.col("nb") * num) & (F.col("nb") * den >= F.col("na") * num)
        level = F.floor(F.log(F.col("n")) / F.lit(float(np.log(den / num))))
        asked = rare.select(F.col("id").alias("a"), F.col("n").alias("na"), F.explode(F.array(level - 1, level, level + 1)).alias("level"))
        given = nodes.select(F.col("id").alias("b"), F.col("n").alias("nb"), level.alias("level"))
        near = settle(asked.join(given, "level").where(near_size & (F.col("a") != F.col("b"))).select("a", "b").distinct())
        sized = plain.join(near.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "id", "left_semi").mapInArrow(whole, shape).where("n > 0")
        for side in "ab":
            near = near.join(sized.select(F.col("id").alias(side), F.col("tokens").alias(f"t{side}")), side)

        def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                shared = [len(np.intersect1d(from_bytes(a), from_bytes(b), assume_unique=True)) for a, b in zip(batch["ta"], batch["tb"])]
                union = batch["ta"].map(len) // 6 + batch["tb"].map(len) // 6 - np.array(shared, int)
                yield batch.loc[den * np.array(shared, int) >= num * union, ["a", "b"]]

        links = links.union(near.select("a", "b", "ta", "tb").mapInPandas(linked, "a long, b long"))
    joined = components(links).withColumnsRenamed({"node": "_first", "component": "_group"})
    # back to all rows: equal sets share their first key
    own = first.select("print", F.col("first.id").alias("_first")).join(joined, "_first", "left")
    own = settle(own.select("print", F.coalesce("_group", "_first").alias("_group")))
    found = signed.select("id", "n", "print").join(own, "print", "left")
    component = F.when(F.col("id").isNotNull() & (F.col("n") > 0), F.coalesce("_group", "id")).otherwise(F.col("id"))
    return found.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"))


WIDTHS = {"boolean": 1, "int": 4, "bigint": 8}


def of_small(df: DataFrame, most_bytes: int = 32_000_000) -> DataFrame:
    """A written table of numbers, to be broadcast if its rows are no more than ``most_bytes``; beyond, or with a column
    of no fixed width, Spark chooses."""
    kinds = [kind for _, kind in df.dtypes]
    if any(k not in WIDTHS for k in kinds):
        return df
    return F.broadcast(df) if df.count() * (8 + sum(WIDTHS[k] for k in kinds)) <= most_bytes else df
