"""Conversation repair: the cheapest edits by an auction on the lattice of rows and grammar states.

A conversation must read as ``(s?(ua)+)?`` in the initials of its roles. Its lattice has a layer per row and four
states per layer; keeping, changing or deleting a row leads to the next layer, inserting stays in it. The auction
holds a price per node and a path from the start: where the path's end can go on at its price it is extended, else
its price rises to the cheapest way on and the path is cut back. Prices that have converged are distances, so the
arcs that fit them are the cheapest edits, and these are followed in the order of their letters.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import col
from sheaf.session import settle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

START, SYSTEM, USER, ASSISTANT = range(4)  # the last role so far
FINE, TRUNCATED, BLANK, DUPLICATE = range(4)  # a row's first fault
INITIALS = "sua"  # kinds of roles; any other is kind 3
COSTS = {"K": 0, "R": 1, "D": 2, "I": 5}
LEFT_TRUNCATED = 5
NO_WAY = 1 << 60
BLOCK = 64  # rows of one lattice


def after(state: int, kind: int) -> int | None:
    """The state once a role of this kind follows."""
    if kind == 0:
        return SYSTEM if state == START else None
    if kind == 1:
        return None if state == USER else USER
    return ASSISTANT if kind == 2 and state == USER else None


def row_edits(code: int) -> list[list[tuple[str, int, int]]]:
    """``(letter, cost, next state)`` of a row, for each state. A code is 4 * kind + fault."""
    kind, fault = divmod(code, 4)
    edits = [[("D", COSTS["D"], state)] for state in range(4)]
    more = LEFT_TRUNCATED if fault == TRUNCATED else 0
    for state in range(4) if fault < BLANK else ():
        for role in range(3):
            to = after(state, role)
            if to is not None and (role == kind or role > 0):
                letter = "K" if role == kind else "R"
                edits[state].append((letter, COSTS[letter] + more, to))
    return edits


EDITS = [row_edits(code) for code in range(16)]
INSERTS = [[("I", COSTS["I"], to) for role in (1, 2) if (to := after(state, role)) is not None] for state in range(4)]


class Lattice:
    """Up to ``BLOCK`` rows before four ends of known cost. Inserting after the last row belongs to what follows,
    so only the ``last`` lattice of a conversation does it."""

    def __init__(self, codes: bytes, ends: tuple[int, ...], last: bool) -> None:
        self.rows, self.last, self.target = len(codes), last, 4 * (len(codes) + 1)
        self.arcs: list[list[tuple[str, int, int]]] = []
        for layer, code in enumerate(codes):
            for state in range(4):
                ahead = [(letter, cost, 4 * layer + 4 + to) for letter, cost, to in EDITS[code][state]]
                self.arcs.append(ahead + [(letter, cost, 4 * layer + to) for letter, cost, to in INSERTS[state]])
        here = 4 * self.rows
        for state in range(4):
            stay = [(letter, cost, here + to) for letter, cost, to in INSERTS[state]] if last else []
            self.arcs.append(stay + ([("", ends[state], self.target)] if ends[state] < NO_WAY else []))
        # a start at which every arc costs at least what prices fall by: what the rows that follow cost at the least
        self.price = [0] * (self.target + 1)
        for layer in reversed(range(self.rows)):
            least = min(cost for ways in EDITS[codes[layer]] for _, cost, _ in ways)
            self.price[4 * layer : 4 * layer + 4] = [self.price[4 * layer + 4] + least] * 4

    def settle(self, origin: int) -> int:
        """The auction from ``origin``: on return its price is its distance from the target."""
        price, arcs, path = self.price, self.arcs, [origin]
        while (at := path[-1]) != self.target:
            least, way = NO_WAY, -1
            for _, cost, to in arcs[at]:
                if cost + price[to] < least:
                    least, way = cost + price[to], to
            if price[at] < least:  # contraction
                price[at] = least
                if len(path) > 1:
                    path.pop()
                elif least == NO_WAY:
                    break
            else:  # extension
                path.append(way)
        return price[origin]

    def trace(self, states: frozenset[int]) -> tuple[str, frozenset[int]]:
        """Least letters of cheapest edits from any of ``states``, all of them on cheapest ways and reached by the
        same letters so far, and the states that the same letters lead to at the end."""
        letters: list[str] = []
        nodes = sorted(states)
        for node in nodes:
            self.settle(node)
        while True:
            if nodes[0] >= 4 * self.rows and (not self.last or any(self.fits(n, arc) for n in nodes for arc in self.arcs[n] if not arc[0])):
                return "".join(letters), frozenset(n - 4 * self.rows for n in nodes)
            least, reached = "~", set()
            for node in nodes:
                for arc in self.arcs[node]:
                    if arc[0] and arc[0] <= least and self.fits(node, arc):
                        if arc[0] < least:
                            least, reached = arc[0], set()
                        reached.add(arc[2])
            letters.append(least)
            nodes = sorted(reached)

    def fits(self, node: int, arc: tuple[str, int, int]) -> bool:
        """Whether the arc lies on a cheapest way from ``node``: it is tight, and so it stays once the price behind
        it has converged too."""
        _, cost, to = arc
        return cost + self.price[to] == self.price[node] and cost + self.settle(to) == self.price[node]


@lru_cache(maxsize=500)
def lattice(codes: bytes, ends: tuple[int, ...], last: bool) -> Lattice:
    return Lattice(codes, ends, last)


@lru_cache(maxsize=20_000)
def distances(codes: bytes, ends: tuple[int, ...], last: bool) -> tuple[int, ...]:
    return tuple(lattice(codes, ends, last).settle(state) for state in range(4))


@lru_cache(maxsize=20_000)
def traced(codes: bytes, ends: tuple[int, ...], last: bool, states: frozenset[int]) -> tuple[str, frozenset[int]]:
    return lattice(codes, ends, last).trace(states)


def cheapest_edits(codes: bytes) -> tuple[int, str]:
    """Cost and letters. Lattices of ``BLOCK`` rows are settled from the last to the first, each before the
    distances of the next, and traced from the first to the last, so that work grows with the rows."""
    cuts = list(range(0, len(codes), BLOCK)) or [0]
    ends, base, calls = (0, NO_WAY, NO_WAY, 0), 0, []
    for at in reversed(cuts):
        call = codes[at : at + BLOCK], ends, at == cuts[-1]
        calls.append(call)
        found = distances(*call)
        least = min(found)  # equal rows before ends of equal differences are one case
        base, ends = base + least, tuple(x - least for x in found)
    states, letters = frozenset([START]), []
    for call in reversed(calls):
        some, states = traced(*call, states)
        letters.append(some)
    return base + ends[START], "".join(letters)


LEGAL = {0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 1}  # su, ua, au


def facts_of(codes: bytes) -> tuple[int, int, int, int]:
    """Blank, duplicate and truncated rows, and neighbours whose roles may not follow each other."""
    numbers = np.frombuffer(codes, np.uint8)
    faults, kinds = numbers % 4, (numbers // 4).astype(np.int64)
    pairs = kinds[:-1] * 4 + kinds[1:]
    return int((faults == BLANK).sum()), int((faults == DUPLICATE).sum()), int((faults == TRUNCATED).sum()), int((~np.isin(pairs, [*LEGAL])).sum())


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv, turn, role, text, copies)``: rows damaged by the checksum of ``conv:turn`` modulo 20. 0 drops the row
    (no copies), 1 empties its text, 2 takes its sentence ends, 3 repeats it, 4 makes it a user's. Null roles and
    texts, and null parts of the checksum's text, count as one space."""
    plain = lambda c: F.coalesce(col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(plain(conv), F.lit(":"), plain(turn)).cast("binary")) % 20
    words = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    named = rows.select(col(conv).alias("conv"), col(turn).alias("turn"), plain(role).alias("role"), plain(text).alias("text"), kind.alias("_kind"))
    return named.select(
        "conv",
        "turn",
        F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        words.alias("text"),
        F.when(F.col("_kind") == 0, 0).when(F.col("_kind") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _row_codes(rows: DataFrame) -> DataFrame:
    """``(conv, turn, role, digest, code, repeat, copies)``: equal rows of a turn as one, with the code of the first
    and of any further copy. Texts stay behind. A row is a duplicate if its role and text occur in an earlier one."""
    bare = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    fault = F.when(F.ltrim(bare, F.lit(" \t\n\x0b\x0c\r")) == "", BLANK).when(F.right(bare, F.lit(1)).isin(".", "!", "?"), FINE).otherwise(TRUNCATED)
    keys = ["conv", "turn", "role", "digest", "fault"]
    plain = rows.select("conv", F.col("turn").cast("long").alias("turn"), "role", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), fault.alias("fault"), "copies")
    turns = settle(plain.groupBy(*keys).agg(F.sum("copies").alias("copies")))
    said = turns.where((F.col("copies") > 0) & (F.col("fault") != BLANK))
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")  # null turns come first
    firsts = said.groupBy("conv", "role", "digest").agg(F.min(place).alias("first"))
    a, b = turns.alias("a"), firsts.alias("b")
    same = F.col("a.conv").eqNullSafe(F.col("b.conv")) & (F.col("a.role") == F.col("b.role")) & (F.col("a.digest") == F.col("b.digest"))
    initial = F.left("role", F.lit(1))
    kind = 4 * F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    earlier = F.col("first")["turn"].eqNullSafe(F.col("turn")) == F.lit(False)
    joined = a.join(b, same, "left").select("a.*", "b.first")
    again = F.when(F.col("fault") == BLANK, BLANK).otherwise(DUPLICATE)
    return joined.select("conv", "turn", "role", "digest", (kind + F.when(earlier, again).otherwise(F.col("fault"))).alias("code"), (kind + again).alias("repeat"), "copies")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, dict[str, list]]]:
    """``(conversation, columns)`` of rows that lie together; a long conversation comes in several parts."""
    for batch in batches:
        columns = {name: batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names)}
        keys, start = columns["conv"], 0
        for i in range(1, len(keys) + 1):
            if i == len(keys) or keys[i] != keys[start]:
                yield keys[start], {name: values[start:i] for name, values in columns.items()}
                start = i


def _batches(rows: Iterator[tuple], names: list[str], types: list, size: int = 500) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)

    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield made()
            held = []
    if held:
        yield made()


def _streamed(steps, names: list[str], types: list):
    """A function for ``mapInArrow`` from one over batches that gives tuples; they start with the conversation,
    whose type stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = None

        def seen():
            nonlocal key
            for batch in batches:
                key = batch.schema.field("conv").type
                yield batch

        for batch in _batches(steps(seen()), names, types):
            yield batch.set_column(0, names[0], batch.column(0).cast(key))

    return run


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows in order as a byte each, cut where a batch ends."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 33
    for conv, part in _runs(batches):
        codes = bytearray()
        for code, repeat, copies in zip(part["code"], part["repeat"], part["copies"]):
            if copies:
                codes.append(code)
                codes.extend(bytes([repeat]) * (copies - 1))
        turns = [t for t, copies in zip(part["turn"], part["copies"]) if copies and t is not None]
        yield conv, number, bytes(codes), min(turns, default=None), max(turns, default=None), len(set(turns))
        number += 1


FACTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The pieces of each conversation in order, as its facts and edits."""

    def audit(conv, codes: bytes, low, high, distinct) -> tuple:
        blank, duplicate, truncated, illegal = facts_of(codes)
        cost, letters = cheapest_edits(codes)
        return conv, high - low + 1 - distinct if distinct else 0, blank, duplicate, truncated, illegal, cost, letters

    held = None
    for conv, part in _runs(batches):
        if held is None or held[0] != conv:
            if held:
                yield audit(held[0], bytes(held[1]), *held[2:])
            held = (conv, bytearray(), None, None, 0)
        _, codes, low, high, distinct = held
        for more, first, last, turns in zip(part["codes"], part["first_turn"], part["last_turn"], part["turns"]):
            codes.extend(more)
            if turns:
                distinct += turns - (high == first)  # a turn may go on in the next piece
                low, high = first if low is None else low, last
        held = (conv, codes, low, high, distinct)
    if held:
        yield audit(held[0], bytes(held[1]), *held[2:])


def audits(rows: DataFrame) -> DataFrame:
    """``(conv, gaps, blank, duplicate, truncated, illegal, cost, audit)`` of ``rows(conv, turn, role, text, copies)``.

    The order comes from a sort by ranges of conversation and turn, so a conversation of any length is spread over
    tasks until each of its rows is one byte; one task then holds these bytes, as many as its audit has letters.
    """
    order = ["conv", "turn", "role", "digest"]
    kind = rows.schema["conv"].dataType.simpleString()
    coded = settle(_row_codes(rows))
    ranged = coded.repartitionByRange(*order).sortWithinPartitions(*order)
    names = ["conv", "piece", "codes", "first_turn", "last_turn", "turns"]
    pieces = _streamed(_pieces, names, [None, pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()])
    cut = ranged.mapInArrow(pieces, f"conv {kind}, piece long, codes binary, first_turn long, last_turn long, turns long")
    audited = _streamed(_audits, ["conv", *FACTS, "audit"], [None, *[pa.int64()] * len(FACTS), pa.string()])
    # a byte of these is a row's work, so as many tasks as a whole shuffle has, however few the bytes
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    gathered = cut.repartition(tasks, "conv").sortWithinPartitions("conv", "piece")
    return gathered.mapInArrow(audited, f"conv {kind}, {', '.join(f'{f} long' for f in FACTS)}, audit string")


def _replay(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``(head, role, text)``: for each conversation its head alone, then its rows after the edits, in order."""
    letters: Iterator[str] = iter(())
    state = START

    def inserted() -> Iterator[tuple]:
        """What is inserted before the next row; returns that row's letter."""
        nonlocal state
        for letter in letters:
            if letter != "I":
                return letter
            state = ASSISTANT if state == USER else USER
            yield None, "assistant" if state == ASSISTANT else "user", b""
        return None

    for batch in batches:
        columns = {name: batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names)}
        for i, audit in enumerate(columns["audit"]):
            if audit is not None:
                yield from inserted()
                letters, state = iter(audit), START
                yield {name: values[i] for name, values in columns.items()}, None, None
                continue
            for _ in range(columns["copies"][i]):
                letter = yield from inserted()
                role, words = columns["role"][i], columns["text"][i]
                if letter == "R":
                    role = "assistant" if state == USER else "user"
                if letter != "D":
                    state = 1 + INITIALS.index(role[0])
                    yield None, role, words
    yield from inserted()


def _beside(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's audit and then its rows in order, in one task but one after the other."""
    words = F.col("text").cast("binary")
    said = rows.where("copies > 0").select("conv", F.col("turn").cast("long").alias("turn"), "role", words.alias("text"), F.unhex(F.sha2(words, 256)).alias("digest"), "copies")
    both = found.unionByName(said, allowMissingColumns=True)
    order = [F.col("conv"), F.col("audit").isNull(), F.col("turn"), F.col("role"), F.col("digest")]
    return both.repartition("conv").sortWithinPartitions(*order).drop("turn", "digest")


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    conv, position = None, 0
    for head, role, words in _replay(batches):
        if head:
            conv, position = head["conv"], 0
        else:
            yield conv, position, role, words.decode("utf-8", "replace")
            position += 1


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    facts, digest, some = None, None, False
    for head, role, words in _replay(batches):
        if head:
            if facts:
                yield *facts, digest.hexdigest()
            facts, digest, some = [head[c] for c in ("conv", *FACTS, "audit")], hashlib.sha256(), False
        else:
            digest.update((b"\n" if some else b"") + role.encode() + b":")
            digest.update(words)
            some = True
    if facts:
        yield *facts, digest.hexdigest()


def repaired_rows(rows: DataFrame) -> DataFrame:
    """``(conv, position, role, text)``: the conversations of ``repair_digests`` after their cheapest edits."""
    kind = rows.schema["conv"].dataType.simpleString()
    run = _streamed(_numbered, ["conv", "position", "role", "text"], [None, pa.int64(), pa.string(), pa.string()])
    return _beside(rows, audits(rows)).mapInArrow(run, f"conv {kind}, position long, role string, text string")


def repair_digests(rows: DataFrame, key: str = "conv_id") -> DataFrame:
    """``(key, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)`` of every conversation of
    ``rows(conv, turn, role, text, copies)``, that is of every conv, null included, also of those without a copy left.

    Rows count in the order of turn (nulls first), then role, then SHA-256 of the text; a row with several copies
    stands that many times in a row. Faults and edits are those of the module's text: a blank row has no character
    but blanks, a duplicate repeats role and text of an earlier row, a truncated row does not end in ``.!?``; keeping
    costs 0, a change to user or assistant 1, deletion 2, an inserted empty row 5, a truncated row that stays 5 more.
    Of the cheapest edits those whose letters are least in ASCII are taken. The initial of a role is its first
    character; an empty role has none and cannot stay as it is. ``gaps`` counts missing turns between the least and
    the largest. Very long texts and conversations are streamed; one conversation's edits are a string and its digest
    is one chain, so both end in one task, which holds a byte per row and a batch of texts. An empty table gives
    no rows; further columns are not carried.
    """
    kind = rows.schema["conv"].dataType.simpleString()
    names = ["conv", *FACTS, "audit", "repaired_sha256"]
    run = _streamed(_digested, names, [None, *[pa.int64()] * len(FACTS), pa.string(), pa.string()])
    shape = f"conv {kind}, {', '.join(f'{f} long' for f in FACTS)}, audit string, repaired_sha256 string"
    return _beside(rows, audits(rows)).mapInArrow(run, shape).withColumnRenamed("conv", key)
