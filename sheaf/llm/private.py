"""Personal data by anchor expansion: one automaton finds the anchors, local parsers grow and test the spans."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.llm.common import col

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Kinds in the order in which spans of one start are listed, and the cue words before an account.
KINDS = ["email", "ip", "card", "phone", "login", "account"]
CUES = ["account", "acct", "iban", "konto", "compte", "cuenta"]

SPANS = "array<struct<kind:string,start:int,end:int>>"
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOGIN = re.compile(r"://([^\s/?#@:]+:[^\s/?#@]+)@")
_ACCOUNT = re.compile(r"[ \t]*(?:no\.?|number|nr\.?)?[ \t]*[:#=]?[ \t]*([A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}|[0-9]{8,18})(?![A-Za-z0-9])")


def _automaton():
    found = ahocorasick.Automaton()
    for anchor in ["@", "+", "://", *"0123456789"]:
        found.add_word(anchor, (anchor if anchor in "@+://" else "0", len(anchor)))
    for cue in CUES:
        for form in (cue, cue.capitalize(), cue.upper()):
            found.add_word(form, ("cue", len(form)))
    found.make_automaton()
    return found


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _iban(value: str) -> bool:
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def find_spans(text: str, automaton) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` in order. Every kind is read left to right without overlap; a run that its
    parser takes but its test refuses is passed over as a whole."""
    spans: list[tuple[int, int, int]] = []
    email = ip = card = phone = login = account = 0  # where each kind reads on
    for last, (anchor, width) in automaton.iter(text):
        at = last - width + 1
        if anchor == "0":
            if at >= ip and (at == ip or not "0" <= text[at - 1] <= "9"):
                if m := _IP.match(text, at):
                    ip = m.end()
                    if all(map(_byte, m.groups())):
                        spans.append((at, 1, ip))
            if at >= card and (m := _CARD.match(text, at)):
                card = m.end()
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and _luhn(digits):
                    spans.append((at, 2, card))
        elif anchor == "@":
            start = at
            while start > email and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                email = m.end()
                spans.append((start, 0, email))
        elif anchor == "+":
            if at >= phone and (m := _PHONE.match(text, at)):
                phone = m.end()
                if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                    spans.append((at, 3, phone))
        elif anchor == "://":
            if at >= login and (m := _LOGIN.match(text, at)):
                login = m.end()
                spans.append((m.start(1), 4, m.end(1)))
        elif at >= account and (at == 0 or not text[at - 1].isalpha()) and (m := _ACCOUNT.match(text, last + 1)):
            if m[1].isdigit() or _iban(m[1]):
                account = m.end()
                spans.append((m.start(1), 5, account))
    spans.sort()
    return spans


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span, or run of overlapping spans, replaced by the name of its first kind."""
    parts, done = [], 0
    for start, kind, end in spans:
        if start >= done:
            parts += [text[done:start], f"[{KINDS[kind].upper()}]"]
        done = max(done, end)
    return "".join([*parts, text[done:]])


def find_private(docs: DataFrame, text: str = "text", spans: str = "spans", redacted: str | None = None) -> DataFrame:
    """Adds ``spans``, and the text without them as ``redacted`` where that is named.

    Spans hold kind, start and end in code points, ordered by start and kind. The whole text is read; a null text
    counts as empty and its redacted form stays null. Rows are independent, so the plan is one pass without a
    shuffle; columns of the names given are replaced, all others kept, also of unusual names.
    """
    rest = [c for c in docs.columns if c not in (spans, redacted) or c == text]
    kept = docs.select(*[col(c) for c in rest])
    made = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    place, at = rest.index(text), redacted if redacted in rest else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton()
        for batch in batches:
            texts = batch.column(place).to_pylist()
            found = [find_spans(t, automaton) if t else [] for t in texts]
            columns, names = list(batch.columns), list(rest)
            if redacted:
                clean = pa.array([masked(t, s) if s else t for t, s in zip(texts, found)], pa.string())
                if at:
                    columns[names.index(at)] = clean
                else:
                    columns, names = [*columns, clean], [*names, redacted]
            if spans:
                listed = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in s] for s in found]
                columns, names = [*columns, pa.array(listed, made)], [*names, spans]
            yield pa.RecordBatch.from_arrays(columns, [f"c{i}" for i in range(len(columns))])

    fields = [*rest, *([redacted] if redacted and not at else []), *([spans] if spans else [])]
    kinds = {f.name: f.dataType.simpleString() for f in kept.schema} | ({redacted: "string"} if redacted else {}) | ({spans: SPANS} if spans else {})
    # positional names on the way, so that no name of the caller's needs quoting
    shape = ", ".join(f"c{i} {kinds[c]}" for i, c in enumerate(fields))
    plain = kept.select(*[col(c).alias(f"c{i}") for i, c in enumerate(rest)])
    return plain.mapInArrow(run, shape).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(fields)])
