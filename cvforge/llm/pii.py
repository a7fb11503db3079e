"""Personal data: exact base patterns, and spans that a semi-Markov conditional random field adds.

Base spans are the pattern matches of each kind that pass its test (address parts up to 255,
card numbers with a right check digit, 8 to 15 digits of a phone number).

The field works on *zones*: stretches of text around digits and ``@``, cut into atoms (runs
of letters, runs of digits, single other characters). A segment of up to ``MAX_ATOMS`` atoms may
be an entity of any kind; what scores it are features of the whole span (its shape, number
of digits, parts, check digit, neighbours), not of single atoms. Dynamic programming over
segment ends chooses boundaries and kinds together; learning follows the gradient of the
log-likelihood, with expectations from the same recursion run forwards and backwards.

It is taught by the base spans of a bounded sample of zones (``per_kind`` of each kind and of
zones without any). In part of the zones the features that only repeat a base test are left
out, so that shapes get weights of their own. Entities that overlap no base span are added.

Null and empty texts have no spans. Without base spans anywhere nothing is learned and
nothing added. Rows are judged one by one; columns not read do not matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cvforge.llm.common import id_text, slices, texts, tidy
from cvforge.session import write_shared

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    """Whether the last digit checks: from the right, every second digit doubled with its digits added."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def only_digits(s: str) -> str:
    return "".join(c for c in s if c in "0123456789")


def small_parts(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in s.split("."))


def is_card(s: str) -> bool:
    d = only_digits(s)
    return 16 <= len(d) <= 19 and luhn(d)


def is_phone(s: str) -> bool:
    return 8 <= len(only_digits(s)) <= 15


def emails(text: str) -> list[Span]:
    """Email matches, found from their ``@``: linear in the text whatever stands before it."""
    out: list[Span] = []
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append(("email", start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str) -> list[Span]:
    """Base spans by kind as listed, then by start. A match starts at the first digit of its run:
    one from further inside would end alike."""
    out = emails(text) if "@" in text else []
    if ANY_DIGIT.search(text):
        for kind, pattern, passes in (("ip", IP, small_parts), ("card", CARD, is_card), ("phone", PHONE, is_phone)):
            if kind == "ip" and "." not in text or kind == "phone" and "+" not in text:
                continue
            out += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if passes(m.group())]
    return out


ANY_DIGIT = re.compile("[0-9]")
TRIGGER = re.compile("[0-9@]+")
ATOM = re.compile(r"[A-Za-z]+|[0-9]+|[^A-Za-z0-9]", re.S)
REACH, MAX_ATOMS = 48, 16


def zones(text: str) -> list[tuple[int, int]]:
    """Stretches around digits and ``@``: at most ``REACH`` non-space characters to either side, merged over single blanks."""
    out: list[tuple[int, int]] = []
    for m in TRIGGER.finditer(text):
        if out and m.end() <= out[-1][1]:
            continue
        if m.end() - m.start() > REACH:  # no entity is made of so many digits
            continue
        start, stop = m.start(), m.end()
        floor, roof = max(out[-1][1] if out else 0, start - REACH), min(len(text), stop + REACH)
        while start > floor and not text[start - 1].isspace():
            start -= 1
        while stop < roof and not text[stop].isspace():
            stop += 1
        if out and start - out[-1][1] <= 1 and stop - out[-1][0] <= 4 * REACH and text[out[-1][1] : start].strip(" ") == "":
            out[-1] = (out[-1][0], stop)
        else:
            out.append((start, stop))
    return out


@lru_cache(maxsize=100_000)
def shape(s: str) -> str:
    """Letters as a, digits as their number, everything else as it is."""
    return "".join("a" if a[0].isalpha() else f"<{min(len(a), 20)}>" if a[0].isdigit() else a for a in ATOM.findall(s))


#: Left out in a part of the zones. The check digit stays: without it a number is no card.
CHECKS = ("plus", "parts")


def features(s: str, left: str, right: str) -> list[str]:
    """Whole-span features; those named in ``CHECKS`` only repeat a base test."""
    digits, sh = only_digits(s), shape(s)
    side = lambda c: "none" if not c else "digit" if c in "0123456789" else "letter" if c.isalpha() else "space" if c.isspace() else "other"
    local, at, domain = sh.partition("@")
    out = [
        "bias",
        f"digits={min(len(digits), 20)}",
        f"left={side(left)}",
        f"right={side(right)}",
        f"ends={side(s[0])},{side(s[-1])}",
        f"at={s.count('@')},{min(domain.count('.'), 3) if at else '-'}",
        f"dots={min(s.count('.'), 4)}",
        f"marks={''.join(sorted(set(c for c in s if not c.isalnum())))[:8]}",
    ]
    if not at:
        out.append(f"shape={sh[:40]}")
    if s[0] == "+":
        out.append("plus")
    if 16 <= len(digits) <= 19:
        out.append("luhn" if luhn(digits) else "not luhn")
    if sh.count("<") == 4 and s.count(".") == 3 and len(sh) < 24 and all(p.isdigit() for p in s.split(".")) and small_parts(s):
        out.append("parts")
    return out


class Lattice:
    """All segments of a zone: entities of every kind, and single atoms outside any entity."""

    def __init__(self, text: str, start: int, stop: int, number, drop: bool = False):
        atoms = [(m.start(), m.end()) for m in ATOM.finditer(text, start, stop)]
        self.edges = [start, *(b for _, b in atoms)]
        self.segments: list[tuple[int, int, int]] = []  # first atom, one past the last, kind (-1: outside)
        rows: list[list[int]] = []
        for i, (a, b) in enumerate(atoms):
            self.segments.append((i, i + 1, -1))
            c = text[a]
            rows.append([number("out:" + ("letter" if c.isalpha() else "digit" if c.isdigit() else c))])
            if not (c.isalnum() or c in "+("):
                continue
            for j in range(i + 1, min(len(atoms), i + MAX_ATOMS) + 1):
                end = atoms[j - 1][1]
                s = text[a:end]
                if not s[-1].isalnum() or len(s) > 2 * REACH or ("@" not in s and sum(map(s.count, "0123456789")) < 4):
                    continue
                found = features(s, text[a - 1 : a], text[end : end + 1])
                if drop:
                    found = [f for f in found if f not in CHECKS]
                for k, kind in enumerate(KINDS):
                    self.segments.append((i, j, k))
                    rows.append([number(f"{kind}:{f}") for f in found])
        self.size = len(atoms)
        lengths = np.array([len(r) for r in rows])
        self.index = np.array([x for r in rows for x in r], np.int64)
        self.cuts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if rows else np.zeros(0, np.int64)
        self.rows = rows

    def scores(self, weights: np.ndarray) -> np.ndarray:
        return np.add.reduceat(weights[self.index], self.cuts) if len(self.cuts) else np.zeros(0)

    def best(self, weights: np.ndarray) -> list[Span]:
        """Entities of the best segmentation."""
        scores = self.scores(weights)
        best, back = [0.0] + [-np.inf] * self.size, [-1] * (self.size + 1)
        for n, (i, j, _) in enumerate(self.segments):  # ordered by first atom
            if best[i] + scores[n] > best[j]:
                best[j], back[j] = best[i] + scores[n], n
        out, at = [], self.size
        while at > 0:
            i, j, k = self.segments[back[at]]
            if k >= 0:
                out.append((KINDS[k], self.edges[i], self.edges[j]))
            at = i
        return out[::-1]

    def marginals(self, weights: np.ndarray) -> np.ndarray:
        """Probability of each segment, by the forward and the backward recursion."""
        scores = self.scores(weights)
        forward, backward = [0.0] + [-np.inf] * self.size, [-np.inf] * self.size + [0.0]
        for n, (i, j, _) in enumerate(self.segments):
            forward[j] = np.logaddexp(forward[j], forward[i] + scores[n])
        for n in range(len(self.segments) - 1, -1, -1):
            i, j, _ = self.segments[n]
            backward[i] = np.logaddexp(backward[i], backward[j] + scores[n])
        return np.exp([forward[i] + scores[n] + backward[j] - forward[self.size] for n, (i, j, _) in enumerate(self.segments)])

    def gold(self, spans: list[Span]) -> np.ndarray | None:
        """Which segments the given spans make; None if a span does not fit the atoms."""
        place = {e: i for i, e in enumerate(self.edges)}
        want = {(place.get(a, -1), place.get(b, -1), KINDS.index(k)) for k, a, b in spans}
        inside = {x for i, j, _ in want for x in range(i, j)}
        marks = np.array([(s in want) if s[2] >= 0 else s[0] not in inside for s in self.segments], float)
        return marks if marks.sum() == len(want) + self.size - len(inside) else None


class Numbering(dict):
    """Numbers for feature names: new names get new numbers while learning, number 0 afterwards."""

    def __init__(self, known: dict[str, int] | None = None):
        super().__init__(known or {"": 0})
        self.open = known is None

    def __call__(self, name: str) -> int:
        if name not in self and self.open:
            self[name] = len(self)
        return self.get(name, 0)


def fit(zones_seen: list[tuple[str, int, int, list[Span]]], rounds: int = 12, rate: float = 0.3, ridge: float = 1e-3) -> dict[str, float]:
    """Weights by feature from zones (text, start, stop, spans): AdaGrad on the log-likelihood."""
    number = Numbering()
    cases = []
    for n, (text, start, stop, spans) in enumerate(zones_seen):
        lattice = Lattice(text, start, stop, number, drop=n % 4 == 0)
        if (gold := lattice.gold(spans)) is not None:
            cases.append((lattice, gold, np.repeat(np.arange(len(gold)), [len(r) for r in lattice.rows])))
    weights, seen = np.zeros(len(number)), np.full(len(number), 1e-6)
    for _ in range(rounds):
        for lattice, gold, owner in cases:
            error = (gold - lattice.marginals(weights))[owner]
            step = np.bincount(lattice.index, error, len(weights)) - ridge * weights * (np.bincount(lattice.index, minlength=len(weights)) > 0)
            seen += step * step
            weights += rate * step / np.sqrt(seen)
    return {f: float(weights[i]) for f, i in number.items() if f and weights[i]}


ZONE = "zone string, start int, stop int, kind array<string>, first array<int>, last array<int>, kinds string"
MARGIN = 1


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_kind: int = 80) -> dict[str, float]:
    """Weights from ``per_kind`` different zones of each kind and of those without base spans, over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for text in texts(batch):
                spans = base_spans(text)
                for a, b in zones(text):
                    inside = [(k, s, e) for k, s, e in spans if s < b and e > a]
                    if any(s < a or e > b for _, s, e in inside) or sum(e - s for _, s, e in inside) > len({i for _, s, e in inside for i in range(s, e)}):
                        continue  # spans that reach out of the zone or overlap are no example of one segmentation
                    begin = max(0, a - MARGIN)
                    rows.append(
                        {
                            "zone": text[begin : b + MARGIN],
                            "start": a - begin,
                            "stop": b - begin,
                            "kind": [k for k, _, _ in inside],
                            "first": [s - begin for _, s, _ in inside],
                            "last": [e - begin for _, _, e in inside],
                            "kinds": ",".join(sorted({k for k, _, _ in inside})),
                        }
                    )
            ints = pa.list_(pa.int32())
            fields = [("zone", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("kind", pa.list_(pa.string())), ("first", ints), ("last", ints), ("kinds", pa.string())]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(fields))

    found = write_shared(id_text(docs, id_col, text_col).mapInArrow(tidy(run), ZONE), "pii-zones")
    cases = []
    for kind in ("", *KINDS):
        some = found.where(F.col("kinds") == kind).dropDuplicates(["zone"]).orderBy(F.xxhash64("zone"), "zone").limit(per_kind).collect()
        cases += [(r["zone"], r["start"], r["stop"], list(zip(r["kind"], r["first"], r["last"], strict=True))) for r in some]
    if not any(spans for *_, spans in cases):
        return {}
    cases.sort(key=lambda c: c[0][::-1])
    return fit(cases)


def added_spans(text: str, base: list[Span], number: Numbering, weights: np.ndarray) -> list[Span]:
    """Entities of the field's best segmentations that overlap no base span."""
    out: list[Span] = []
    taken = sorted((s, e) for _, s, e in base)
    for a, b in zones(text):
        near = [(s, e) for s, e in taken if s < b and e > a]
        if any(s <= a and e >= b for s, e in near):
            continue
        out += [(k, s, e) for k, s, e in Lattice(text, a, b, number).best(weights) if not any(s < y and e > x for x, y in near)]
    return out


SPANS = "array<struct<kind:string,start:int,end:int>>"


def find(docs: DataFrame, weights: dict[str, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, added) with the spans of every text, by kind as in ``KINDS``, then start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = Numbering({"": 0} | {f: i + 1 for i, f in enumerate(weights)})
        values = np.array([0.0, *weights.values()])
        kind_order = {k: i for i, k in enumerate(KINDS)}
        arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in slices(batches):
            both: tuple[list, list] = ([], [])
            for text in texts(batch):
                base = base_spans(text)
                added = added_spans(text, base, number, values) if weights else []
                for out, spans in zip(both, (base, sorted(added, key=lambda x: (kind_order[x[0]], x[1]))), strict=True):
                    out.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "base": pa.array(both[0], arrow), "added": pa.array(both[1], arrow)})

    return id_text(docs, id_col, text_col).mapInArrow(tidy(run), f"doc_id long, base {SPANS}, added {SPANS}")


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each run of overlapping spans replaced by the kind of its first."""
    out: list[str] = []
    done = 0
    for kind, a, b in sorted(spans, key=lambda x: (x[1], -x[2])):
        if a >= done:
            out += [text[done:a], f"[{kind.upper()}]"]
        done = max(done, b)
    return "".join(out) + text[done:]


def redact(docs: DataFrame, weights: dict[str, float], text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, with all spans of the text replaced (and its new length in ``length_col``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = Numbering({"": 0} | {f: i + 1 for i, f in enumerate(weights)})
        values = np.array([0.0, *weights.values()])
        for batch in slices(batches, text_col):
            out: list[str | None] = []
            for text in batch.column(text_col).to_pylist():
                if text:
                    base = base_spans(text)
                    text = redacted(text, base + (added_spans(text, base, number, values) if weights else []))
                out.append(text)
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            columns[text_col] = pa.array(out, batch.schema.field(text_col).type)
            if length_col in columns:
                columns[length_col] = pa.array([None if t is None else len(t) for t in out], batch.schema.field(length_col).type)
            yield pa.RecordBatch.from_pydict(columns, schema=batch.schema)

    return docs.mapInArrow(tidy(run), docs.schema)
