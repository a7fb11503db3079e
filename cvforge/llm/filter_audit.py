"""How filters interact: what each removes in every order, from path counts over the lattice of subsets.

A document fails a set of filters, its mask. Counts by (part, mask) are all that the data give:
at most 2**filters rows a part. A state of the lattice is the set of filters applied so far; an
edge adds one filter and removes the documents that fail it and passed every filter of the
state. Counting paths forward from the empty state and backward from the full one gives the
number of orders through an edge, which weights its removals for the Shapley sum; the steps of
each single order are read from the same edges.

The five filters of ``text_masks``: fewer than 200 words; distinct words under half of the
words; more than 3 % capitals A-Z; any of ``#$%&*|``; a text that a smaller doc_id has too
(texts are told by their SHA-256). Null texts count as empty. A document without an id repeats
nothing and is repeated by nothing, and has no labels; rows that share an id do not repeat each
other. Repeated labels of an id count once. Empty tables give empty results; columns not read do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cvforge.llm.common import join_each, slices, texts, tidy
from cvforge.session import write_shared

FILTERS = "ABCDE"
CAPITALS = bytes(range(0x41, 0x5B))
MARKS = frozenset(b"#$%&*|")
#: Rows without an id are dealt over so many parts of a join that none of them can match.
SPREAD = 1 << 16


def failed(text: str) -> tuple[int, bytes]:
    """Mask of the filters A to D that a text fails (A is bit 0), and its digest."""
    raw = text.encode("utf-8", "replace")
    words = raw.split()  # bytes split at 0x20 and 0x09-0x0D alone
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    mask = (len(words) < 200) | (100 * len(set(words)) < 50 * len(words)) << 1
    mask |= (100 * capitals > 3 * len(text)) << 2 | (not MARKS.isdisjoint(raw)) << 3
    return mask, hashlib.sha256(raw).digest()


def text_masks(docs: DataFrame, part_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, part, mask) of every row, filter E included; a null part is the empty string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [failed(t) for t in texts(batch)]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "part": batch.column("part"), "mask": pa.array([m for m, _ in found], pa.int32()), "digest": pa.array([d for _, d in found], pa.binary())}
            )

    part = F.coalesce(docs[part_col].cast("string"), F.lit(""))
    read = docs.select(docs[id_col].cast("long").alias("doc_id"), part.alias("part"), docs[text_col].cast("string").alias("text"))
    rows = write_shared(read.mapInArrow(tidy(run), "doc_id long, part string, mask int, digest binary"), "audit-masks")
    groups = rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")).where("n > 1")
    found = join_each(rows, write_shared(groups, "audit-copies"), "digest", "n")
    repeats = F.coalesce(F.col("doc_id") > F.col("first_id"), F.lit(False))
    return found.select("doc_id", "part", F.col("mask").bitwiseOR(F.when(repeats, 16).otherwise(0)).alias("mask"))


def with_marks(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """Add ``good`` (quality = 1) and ``toxic`` (toxic = 1), 0 without such a label."""
    mark = lambda c: F.max((F.col(c) == 1).cast("int"))
    known = labels.select(labels["doc_id"].cast("long").alias("l_id"), "quality", "toxic").where("quality = 1 or toxic = 1")
    known = known.groupBy("l_id").agg(mark("quality").alias("good"), mark("toxic").alias("toxic"))
    known = known.withColumn("l_deal", F.xxhash64("l_id", F.lit(0)))
    slot = F.when(F.col("doc_id").isNull(), 1 + F.pmod(F.spark_partition_id(), F.lit(SPREAD))).otherwise(0)
    rows = masks.withColumn("deal", F.xxhash64("doc_id", slot))
    joined = rows.join(known, (rows.doc_id == known.l_id) & (rows.deal == known.l_deal), "left")
    return joined.select("part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


def path_counts(filters: int) -> dict[tuple[int, int], int]:
    """Orders through each edge (state, filter): ways to reach the state times ways on from the next."""
    states = range(1 << filters)
    forward, backward = [0] * len(states), [0] * len(states)
    forward[0] = backward[-1] = 1
    for s in states:  # a state comes after all its subsets
        for f in range(filters):
            if not s >> f & 1:
                forward[s | 1 << f] += forward[s]
    for s in reversed(states):
        for f in range(filters):
            if not s >> f & 1:
                backward[s] += backward[s | 1 << f]
    return {(s, f): forward[s] * backward[s | 1 << f] for s in states for f in range(filters) if not s >> f & 1}


def literal(rows: list[tuple], names: list[str]) -> Column:
    return F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row, strict=True)]) for row in rows])


def audit(marked: DataFrame, names: str = FILTERS) -> DataFrame:
    """One row for each part, order of the filters and step, from (part, mask, good, toxic) of each document."""
    n = len(names)
    counts = marked.groupBy("part", "mask").agg(F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    counts = write_shared(counts, "audit-counts")
    edges = literal([(s, f, paths) for (s, f), paths in sorted(path_counts(n).items())], ["state", "filter", "paths"])
    bit = F.expr("shiftleft(1, filter)")
    fails = F.col("mask").bitwiseAND(bit) != 0
    passed = F.col("mask").bitwiseAND(F.col("state")) == 0
    total = lambda when, what="n": F.coalesce(F.sum(F.when(when, F.col(what))), F.lit(0)).cast("long")
    each = counts.select("*", F.explode(edges).alias("e")).select("part", "mask", "n", "good", "toxic", "e.*")
    steps = each.groupBy("part", "state", "filter", "paths").agg(
        total(passed & ~fails).alias("kept"),
        total(passed & fails).alias("removed"),
        total(~passed & fails).alias("redundant"),
        total(F.col("mask") == bit).alias("unique_fails"),
        total(passed & fails, "good").alias("good_lost"),
        total(passed & fails, "toxic").alias("toxic_lost"),
    )
    steps = write_shared(steps, "audit-edges")  # 80 rows a part for five filters
    shapley = steps.groupBy("part", "filter").agg(F.sum(F.col("removed") * F.col("paths")).alias("shapley"))
    ways = [("".join(names[f] for f in way), k + 1, sum(1 << f for f in way[:k]), way[k]) for way in permutations(range(n)) for k in range(n)]
    orders = marked.sparkSession.createDataFrame(ways, "filter_order string, step int, state int, filter int")
    found = steps.join(F.broadcast(orders), ["state", "filter"]).join(shapley, ["part", "filter"])
    return found.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def filter_interactions(docs: DataFrame, labels: DataFrame, part_col: str = "lang") -> DataFrame:
    """The audit of filters A to E over whole documents, by part."""
    return audit(with_marks(text_masks(docs, part_col), labels))
