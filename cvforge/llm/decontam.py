"""Benchmark decontamination with Wu-Manber multi-pattern search over words.

A pattern is ``window`` consecutive words of a benchmark item, or all words of a shorter
item. Patterns of one length share tables: a *shift* table keyed by blocks of two words says
how far the search may jump when a block ends at the current word; where the shift is 0, the
block's bucket lists the patterns that end with it; the first word is compared, then the
whole pattern. Most positions are never looked at.

The benchmark is a query set that is searched in blocks of at most ``block_words`` pattern
words: each block's tables are broadcast (so their size is bounded by that parameter) and
every document is read against them; a benchmark beyond one block takes one pass per block.

Null or wordless texts have no words, no hits and no items. Null or wordless items have no
windows; repeated items and windows count once, and an item without an id marks words but
is not listed. Repeated documents are judged one by one; empty tables give empty or
hit-free results; columns not read do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from cvforge.llm.common import id_text, slices, tidy, words_of
from cvforge.session import write_shared

def patterns_of(items: list[tuple[int | None, str | None]], window: int) -> dict[tuple[bytes, ...], set[str]]:
    """Each window of the items, with the ids of the items that hold it."""
    found: dict[tuple[bytes, ...], set[str]] = {}
    for item_id, text in items:
        w = words_of(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            ids = found.setdefault(tuple(w[i : i + size]), set())
            if item_id is not None:
                ids.add(str(item_id))
    return found


class Tables:
    """Shift and bucket tables for the patterns of one length."""

    def __init__(self, length: int, patterns: dict[tuple[bytes, ...], set[str]]):
        self.length, self.block = length, min(2, length)
        self.far = length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], list[tuple[bytes, list[bytes], set[str]]]] = {}
        for p, ids in patterns.items():
            for end in range(self.block, length + 1):
                key = p[end - self.block : end]
                self.shift[key] = min(self.shift.get(key, self.far), length - end)
            self.buckets.setdefault(p[-self.block :], []).append((p[0], list(p), ids))

    def search(self, words: list[bytes], spans: list[tuple[int, int]], items: set[str]) -> None:
        """Add the word span and the items of every occurrence."""
        n, m, block, far, shift, buckets = len(words), self.length, self.block, self.far, self.shift.get, self.buckets
        at = m  # one past the last word of the window in view
        while at <= n:
            key = tuple(words[at - block : at])
            if jump := shift(key, far):
                at += jump
                continue
            start = at - m
            for first, whole, ids in buckets[key]:
                if words[start] == first and words[start:at] == whole:
                    spans.append((start, at))
                    items |= ids
            at += 1


def tables_of(patterns: dict[tuple[bytes, ...], set[str]]) -> list[Tables]:
    by_length: dict[int, dict] = {}
    for p, ids in patterns.items():
        by_length.setdefault(len(p), {})[p] = ids
    return [Tables(n, by_length[n]) for n in sorted(by_length)]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def blocks(benchmark: DataFrame, window: int, block_words: int) -> Iterator[list[tuple[int | None, str | None]]]:
    """The items in lists whose patterns hold at most ``block_words`` words (one item at least)."""
    held: list[tuple[int | None, str | None]] = []
    size = 0
    for item_id, text in benchmark.toLocalIterator():
        n = len(words_of(text))
        weight = max(1, n - window + 1) * min(window, n)
        if held and size + weight > block_words:
            yield held
            held, size = [], 0
        held.append((item_id, text))
        size += weight
    yield held


SCHEMA = "doc_id long, text string, n_words long, spans array<struct<start:int,end:int>>, items array<string>"
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def find_occurrences(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    block_words: int = 5_000_000,
    keep_text: bool = False,
) -> DataFrame:
    """(doc_id, text, n_words, spans, items) of every document.

    ``spans`` are the maximal runs of hit words (numbers of words, end exclusive); ``items`` the
    sorted ids of the items with occurring windows. ``text`` is null unless ``keep_text``.
    """
    found = id_text(docs, id_col, text_col).selectExpr("doc_id", "text", "0L n_words", "cast(array() as array<struct<start:int,end:int>>) spans", "cast(array() as array<string>) items")
    queries = benchmark.select(benchmark[item_col].alias("item_id"), benchmark[item_text_col].cast("string").alias("text"))
    for items, last in _lookahead(blocks(queries, window, block_words)):
        shared = docs.sparkSession.sparkContext.broadcast(items)
        found = found.mapInArrow(_searcher(shared, window, keep_text or not last), SCHEMA)
        if not last:
            found = write_shared(found, "decontam-pass")
    return found


def _lookahead(it: Iterator[list]) -> Iterator[tuple[list, bool]]:
    """Each item with whether it is the last."""
    held = next(it, [])
    for item in it:
        yield held, False
        held = item
    yield held, True


def _searcher(shared, window: int, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = tables_of(patterns_of(shared.value, window))
        for batch in slices(batches):
            counts, spans, items = [], [], []
            earlier = zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist(), strict=True)
            for text, (old_spans, old_items) in zip(batch.column("text").to_pylist(), earlier, strict=True):
                words = words_of(text)
                s, i = [(x["start"], x["end"]) for x in old_spans], set(old_items)
                for t in tables:
                    t.search(words, s, i)
                counts.append(len(words))
                spans.append([{"start": a, "end": b} for a, b in merged(s)])
                items.append(sorted(i))
            text = batch.column("text") if keep_text else pa.nulls(batch.num_rows, pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), text, pa.array(counts, pa.int64()), pa.array(spans, SPANS), pa.array(items, pa.list_(pa.string()))],
                names=["doc_id", "text", "n_words", "spans", "items"],
            )

    return tidy(run)


def clean(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    block_words: int = 5_000_000,
) -> DataFrame:
    """The rows of ``docs``, all columns, in whose text no window of any item occurs."""
    queries = benchmark.select(benchmark[item_col].alias("item_id"), benchmark[item_text_col].cast("string").alias("text"))
    schema = docs.schema
    for items, last in _lookahead(blocks(queries, window, block_words)):
        docs = docs.mapInArrow(_cleaner(docs.sparkSession.sparkContext.broadcast(items), window, text_col), schema)
        if not last:
            docs = write_shared(docs, "decontam-pass")
    return docs


def _cleaner(shared, window: int, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = tables_of(patterns_of(shared.value, window))
        for batch in slices(batches, text_col):
            marks = []
            for text in batch.column(text_col).to_pylist():
                words, spans = words_of(text), []
                for t in tables:
                    t.search(words, spans, set())
                marks.append(not spans)
            yield batch.filter(pa.array(marks, pa.bool_()))

    return tidy(run)
