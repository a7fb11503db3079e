"""Removal of repeated byte strings by a hash-compared suffix sort.

A byte of a document goes if a string of ``length`` bytes that covers it also begins earlier:
in a document with a smaller id, or further left in the same one. Equal strings are brought
together by *anchors*: of every window of ``length`` bytes one place is chosen that depends on
the window's bytes alone (a mod-minimizer: the place of its least short gram, modulo ``SPREAD``),
so equal windows have the same anchor at the same offset, and neighbouring windows mostly
share theirs. Consecutive windows of one anchor make a *run*, about 2 % as many as bytes.

Runs are grouped by the hash of the anchor's gram. If all runs of a group are equal as a
whole, by a 128-bit BLAKE2b digest of their bytes, all but the earliest are repeats, and no text
is looked at again. Otherwise the
different ones get their bytes, and their windows' suffixes are sorted: a mergesort whose
comparisons find the common extension of two suffixes by binary search over prefix polynomial
hashes, in a number of steps logarithmic in ``length``. Sorting is stable and starts from
the order of places, so of equal neighbours the first stays. Neighbours held equal are
compared byte by byte; if hashes ever collide, another base is taken. Groups of more than
``group_limit`` runs do not go to one task: their windows are grouped by a 128-bit hash in Spark.

Null and short texts lose nothing. Rows that share an id count as at the same place: only
the start decides which is earlier, and neither loses what both have there. A row without
an id comes after all others. Empty tables give empty results; columns not read do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cvforge.llm.common import id_text, packed_texts, slices, texts, tidy, unpack
from cvforge.llm.rolling import Base, U, mix
from cvforge.session import write_shared

LAST_ID = (1 << 63) - 1
#: For windows of 100 bytes: an anchor's gram has 54, lies at an offset below 47, and short grams have 7.
SPREAD, SHORT = 47, 7


@lru_cache(maxsize=8)
def base(seed: int) -> Base:
    return Base(seed)


def sliding_least(v: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive values, by widths that double."""
    have = 1
    while have * 2 <= width:
        v = np.minimum(v[:-have], v[have:])
        have *= 2
    return np.minimum(v[: len(v) - (width - have)], v[width - have :]) if have < width else v


def runs_of(many: list[bytes], length: int) -> dict[str, np.ndarray]:
    """All runs of the texts: text number, first window, offset of the anchor, number of windows, the
    hash of the anchor's gram, and a 128-bit digest, as two numbers, of all its bytes, offset and count."""
    names = ("text", "first", "offset", "count", "gram", "whole")
    data = np.frombuffer(b"".join(many), np.uint8)
    ends = np.cumsum([0, *map(len, many)])
    if len(data) < length:
        return {n: np.zeros((0, 2) if n == "whole" else 0, np.int64) for n in names}
    b = base(1)
    sums = b.prefix(data)
    at = np.arange(len(data) - SHORT + 1)
    grams = mix(b.span(sums, at, at + SHORT)) & ~U(0xFFFFFFFF) | at.astype(np.uint64)
    least = (sliding_least(grams, length - SHORT + 1) & U(0xFFFFFFFF)).astype(np.int64)
    window = np.arange(len(least))
    anchor = window + (least - window) % SPREAD
    text = np.repeat(np.arange(len(many)), np.diff(ends))[: len(least)]
    whole_window = window + length <= ends[text + 1]
    window, anchor, text = window[whole_window], anchor[whole_window], text[whole_window]
    new = np.ones(len(window), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1) | (text[1:] != text[:-1])
    starts = np.flatnonzero(new)
    count = np.diff(np.append(starts, len(window)))
    first, anchor, text = window[starts], anchor[starts], text[starts]
    gram = mix(b.span(sums, anchor, anchor + length - SPREAD + 1))
    joined, offset = memoryview(data), anchor - first
    # offsets and counts fit a byte each
    spans = zip(first.tolist(), (first + count - 1 + length).tolist(), offset.tolist(), count.tolist(), strict=True)
    digests = b"".join(hashlib.blake2b(joined[x:y], digest_size=16, salt=bytes((o, n))).digest() for x, y, o, n in spans)
    whole = np.frombuffer(digests, np.int64).reshape(-1, 2)
    return dict(zip(names, (text, first - ends[text], offset, count, gram.view(np.int64), whole), strict=True))


RUN = "gram long, whole binary, doc_id long, place long, again boolean"


def find_runs(docs: DataFrame, length: int) -> DataFrame:
    """A row for each run; ``place`` packs its first window, its anchor's offset and its windows.

    A run equal to an earlier one of the same slice is already known to repeat (``again``). It
    gets a gram of its own, so that copies without number do not meet under one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            r = runs_of([t.encode("utf-8", "replace") for t in texts(batch)], length)
            doc = ids[r["text"]] if len(ids) else ids
            place = r["first"] << 16 | r["offset"] << 8 | r["count"]
            order = np.lexsort((place, doc, *r["whole"].T, r["gram"]))
            g, w = r["gram"][order], r["whole"][order]
            again = np.zeros(len(order), bool)
            # rows of one id count as at the same place, so equal places are no repeats
            d, f = doc[order], r["first"][order]
            head = np.ones(len(order), bool)
            head[1:] = (g[1:] != g[:-1]) | (w[1:] != w[:-1]).any(axis=1)
            lead = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
            again[order] = (d != d[lead]) | (f != f[lead])
            own = mix(mix(doc.astype(np.uint64)) + place.astype(np.uint64)).view(np.int64)
            whole = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(order), [None, pa.py_buffer(r["whole"].tobytes())])
            yield pa.RecordBatch.from_pydict(
                {"gram": pa.array(np.where(again, own, r["gram"])), "whole": whole.cast(pa.binary()), "doc_id": pa.array(doc), "place": pa.array(place), "again": pa.array(again)}
            )

    return docs.mapInArrow(tidy(run), RUN)


def judge_runs(runs: DataFrame) -> DataFrame:
    """(gram, doc_id, place, repeat, many) of the runs that repeat as a whole, and of the first of each kind in groups of several kinds."""
    place = F.struct("doc_id", F.shiftright("place", 16).alias("first"))
    same, group = W.partitionBy("gram", "whole"), W.partitionBy("gram")
    seen = runs.select("gram", "whole", "doc_id", "place", "again", F.min(place).over(same).alias("lead"), F.row_number().over(same.orderBy("doc_id", "place")).alias("turn"))
    seen = seen.withColumn("kinds", F.min("whole").over(group) != F.max("whole").over(group))
    seen = seen.withColumn("many", F.sum((F.col("turn") == 1).cast("int")).over(group))
    repeat = F.col("again") | (F.col("lead") < place)
    return seen.where(repeat | (F.col("kinds") & (F.col("turn") == 1))).select("gram", "doc_id", "place", repeat.alias("repeat"), "many")


def common_extension(b: Base, sums: np.ndarray, x: np.ndarray, y: np.ndarray, most: int) -> np.ndarray:
    """Length of the longest common prefix, up to ``most``, of the suffixes at x and at y: binary search on hashes."""
    low, high = np.zeros(len(x), np.int64), np.full(len(x), most)
    while (open_ := low < high).any():
        middle = (low + high + 1) >> 1
        equal = b.span(sums, x, x + middle) == b.span(sums, y, y + middle)
        low, high = np.where(open_ & equal, middle, low), np.where(open_ & ~equal, middle - 1, high)
    return low


def sort_suffixes(data: np.ndarray, suffix: np.ndarray, group: np.ndarray, most: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Stable mergesort of suffixes within each group, which must be consecutive.

    Returns the order, and for each place in it whether its suffix equals the one before. All
    merges of a level happen at once: an element's place is its own plus its rank in the
    neighbouring run, found by binary search with hash-compared suffixes.
    """
    b = base(seed)
    sums = b.prefix(data)
    padded = np.append(data, 0)

    def before(x: np.ndarray, y: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether the suffix at x sorts before that at y (or may stand before an equal one)."""
        shared = common_extension(b, sums, x, y, most)
        return np.where(shared == most, or_equal, padded[np.minimum(x + shared, len(data))] < padded[np.minimum(y + shared, len(data))])

    n = len(suffix)
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if n else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, n))
    first, size = np.repeat(starts, sizes), np.repeat(sizes, sizes)
    order, width = np.arange(n), 1
    while n and width < sizes.max():
        live = np.flatnonzero(size > width)
        inner = live - first[live]
        left = (inner // width) % 2 == 0
        pair = first[live] + inner // (2 * width) * (2 * width)
        end = first[live] + size[live]
        mate = np.where(left, pair + width, pair)  # where the other run of the pair begins and ends
        low, high = np.minimum(mate, end), np.minimum(mate + width, end)
        begin = low.copy()
        mine = suffix[order[live]]
        while (open_ := low < high).any():
            at = np.flatnonzero(open_)
            middle = (low[at] + high[at]) >> 1
            # the other's element goes first if smaller, or equal and in the left run
            ahead = before(suffix[order[middle]], mine[at], ~left[at])
            low[at], high[at] = np.where(ahead, middle + 1, low[at]), np.where(ahead, high[at], middle)
        own = inner % width
        target = pair + own + (low - begin)
        moved = order.copy()
        moved[target] = order[live]
        order = moved
        width *= 2
    same = np.zeros(n, bool)
    if n > 1:
        x, y = suffix[order[1:]], suffix[order[:-1]]
        same[1:] = (group[order[1:]] == group[order[:-1]]) & (common_extension(b, sums, x, y, most) == most)
    return order, same


def verified(data: np.ndarray, suffix: np.ndarray, order: np.ndarray, same: np.ndarray, most: int) -> bool:
    """Whether neighbours held equal are equal byte by byte."""
    at = np.flatnonzero(same)
    for i in range(0, len(at), 20_000):
        x, y = suffix[order[at[i : i + 20_000]]], suffix[order[at[i : i + 20_000] - 1]]
        if any((data[x + k] != data[y + k]).any() for k in range(most)):
            return False
    return True


def repeated_windows(gram: np.ndarray, doc: np.ndarray, place: np.ndarray, contexts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, start) of the windows of these runs that equal an earlier one's."""
    first, offset, count = place >> 16, place >> 8 & 0xFF, place & 0xFF
    begins = np.cumsum([0, *map(len, contexts)])[:-1]
    run = np.repeat(np.arange(len(place)), count)
    step = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
    # windows can only be equal with the same gram at the same offset
    _, kind = np.unique(gram, return_inverse=True)
    group = kind[run] * 256 + offset[run] - step
    start = first[run] + step
    order = np.lexsort((start, doc[run], group))
    group, start, where, suffix = group[order], start[order], doc[run][order], (begins[run] + step)[order]
    data = np.frombuffer(b"".join(contexts), np.uint8)
    for seed in range(3, 100):
        order, same = sort_suffixes(data, suffix, group, length, seed)
        if verified(data, suffix, order, same, length):
            break
    lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    place_of = lambda i: (where[order[i]], start[order[i]])
    (d, s), (d0, s0) = place_of(np.arange(len(order))), place_of(lead)
    late = (d != d0) | (s != s0)
    return d[late], s[late]


def spans_of(doc: np.ndarray, start: np.ndarray, length: int) -> pa.RecordBatch:
    """Consecutive windows of a document as one row (doc_id, start, stop)."""
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + 1)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(doc)) - 1 if len(doc) else head
    return pa.RecordBatch.from_pydict({"doc_id": pa.array(doc[head]), "start": pa.array(start[head]), "stop": pa.array(start[tail] + length)})


SPANS = "doc_id long, start long, stop long"


def sorted_spans(contexts: DataFrame, length: int, windows: int = 200_000) -> DataFrame:
    """Spans of repeated windows; each task sorts whole groups of grams, some ``windows`` windows at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            rest = pa.concat_tables([rest, t]) if rest is not None else t
            if rest.num_rows * SPREAD < windows:
                continue
            gram = rest["gram"].to_numpy()
            cut = int(np.searchsorted(gram, gram[-1]))  # the last group may go on
            if cut:
                yield solve(rest.slice(0, cut))
                rest = rest.slice(cut)
        if rest is not None and rest.num_rows:
            yield solve(rest)

    def solve(t: pa.Table) -> pa.RecordBatch:
        doc, start = repeated_windows(*(t[c].to_numpy() for c in ("gram", "doc_id", "place")), t["context"].to_pylist(), length)
        return spans_of(doc, start, length)

    return contexts.repartition("gram").sortWithinPartitions("gram").select("gram", "doc_id", "place", "context").mapInArrow(tidy(run), SPANS)


def hashed_spans(contexts: DataFrame, length: int) -> DataFrame:
    """The same for runs of very large groups: windows grouped by a 128-bit hash of their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "context", 1 << 18):
            place, context = batch.column("place").to_numpy(), batch.column("context").to_pylist()
            doc = np.repeat(batch.column("doc_id").to_numpy(), place & 0xFF)
            keys = [hashlib.blake2b(c[i : i + length], digest_size=16).digest() for c, n in zip(context, place & 0xFF, strict=True) for i in range(n)]
            start = np.concatenate([p + np.arange(n) for p, n in zip(place >> 16, place & 0xFF, strict=True)]) if len(place) else place
            yield pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.binary()), "doc_id": pa.array(doc), "start": pa.array(start)})

    found = contexts.select("doc_id", "place", "context").mapInArrow(tidy(run), "key binary, doc_id long, start long")
    lead = found.groupBy("key").agg(F.min(F.struct("doc_id", "start")).alias("lead"), F.count("*").alias("n")).where("n > 1").select("key", "lead")
    late = found.join(lead, "key").where(F.col("lead") < F.struct("doc_id", "start"))
    return late.select("doc_id", "start", (F.col("start") + length).alias("stop"))


def removed_spans(docs: DataFrame, packed: DataFrame, length: int, group_limit: int) -> DataFrame:
    """(doc_id, start, stop) of removed strings, which may overlap."""
    judged = write_shared(judge_runs(find_runs(docs, length)), "suffix-runs")
    place = F.col("place")
    first, count = F.shiftright(place, 16), place.bitwiseAND(0xFF)
    whole = judged.where("repeat").select("doc_id", first.alias("start"), (first + count - 1 + length).alias("stop"))
    wanted = judged.where("not repeat").groupBy(F.col("doc_id").alias("w_id")).agg(F.collect_list(F.struct("gram", "place", "many")).alias("runs"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("gram", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int64()), ("many", pa.int64()), ("context", pa.binary())])
        for batch in slices(batches, "packed", 1 << 20):
            rows = []
            for doc, packed_, runs in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "packed", "runs")), strict=True):
                text = unpack(packed_).encode("utf-8")
                for r in runs:
                    at, n = r["place"] >> 16, r["place"] & 0xFF
                    if len(found := text[at : at + n - 1 + length]) == n - 1 + length:
                        rows.append((r["gram"], doc, r["place"], r["many"], found))
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)] if rows else [pa.array([], f.type) for f in schema], schema=schema)

    joined = packed.join(wanted, packed.doc_id == wanted.w_id).select("doc_id", "packed", "runs")
    contexts = joined.mapInArrow(tidy(cut), "gram long, doc_id long, place long, many long, context binary")
    spans = whole.union(sorted_spans(contexts.where(F.col("many") <= group_limit), length))
    if judged.where((~F.col("repeat")) & (F.col("many") > group_limit)).limit(1).count():
        spans = spans.union(hashed_spans(contexts.where(F.col("many") > group_limit), length))
    return spans


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, group_limit: int = 20_000) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every document: the maximal removed runs of bytes, and the bytes that stay."""
    if length != SPREAD + (SPREAD + SHORT) - 1:
        raise ValueError("the anchors are laid out for strings of 100 bytes")
    rows = id_text(docs, id_col, text_col).select(F.coalesce("doc_id", F.lit(LAST_ID)).alias("doc_id"), "text")
    # without null ids both joins read one and the same shuffle of the texts
    packed = packed_texts(rows, null_ids=False)
    spans = removed_spans(rows, packed, length, group_limit)
    gathered = spans.groupBy(F.col("doc_id").alias("s_id")).agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("found"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        for batch in slices(batches, "packed", 1 << 20):
            sizes, removed, kept = [], [], []
            for packed_, found in zip(batch.column("packed").to_pylist(), batch.column("found").to_pylist(), strict=True):
                text, runs, parts, done = unpack(packed_).encode("utf-8"), [], [], 0
                for s in found or ():
                    stop = min(s["stop"], len(text))
                    if runs and s["start"] <= runs[-1]["stop"]:
                        runs[-1]["stop"] = max(runs[-1]["stop"], stop)
                    elif s["start"] < stop:
                        runs.append({"start": s["start"], "stop": stop})
                for r in runs:
                    parts.append(text[done : r["start"]])
                    done = r["stop"]
                sizes.append(len(text))
                removed.append(runs)
                kept.append(b"".join(parts) + text[done:])
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "n_bytes": pa.array(sizes, pa.int64()), "spans": pa.array(removed, arrow), "kept": pa.array(kept, pa.binary())}
            )

    both = packed.join(gathered, packed.doc_id == gathered.s_id, "left").select("doc_id", "packed", "found")
    out = both.mapInArrow(tidy(run), "doc_id long, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary")
    return out.withColumn("doc_id", F.nullif("doc_id", F.lit(LAST_ID)))
