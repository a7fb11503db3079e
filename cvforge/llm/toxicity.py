"""Toxicity by class-conditional Kneser-Ney models.

Two models are learned, one from texts labelled toxic and one from the others. Their units are
pieces of words (three bytes each), so that words never seen share what their parts have
shown. Both are interpolated Kneser-Ney: a bigram's discounted count, backed off to the
discounted number of different units that the unit follows within the class, backed off to the
same number over both classes. That last, shared, level keeps rare expressions from speaking for the
class that merely happens to hold more text. A text's evidence is the difference of the
two log-likelihoods per unit, over the whole text and over its most toxic stretches
of each length in ``stretches``; a logistic curve fitted on labelled rows that the counts have not seen
turns these numbers into a score from 0 to 1.

Counts cover every learning row: tasks add up bigrams of what they read, Spark adds those up by
bigram. They stay a Spark table, exact and of any size, from which one more table is made: the
evidence of every bigram seen, of every unit before another one, and of every unit alone (the last
two add up to that of a bigram never seen). Texts are dealt into chunks of about ``CHUNK_BYTES``;
each asks for its distinct bigrams and units, a merge join answers, and the texts of a chunk are
measured with the answers, so a task holds what occurs in its chunk alone. The curve alone
is fitted on a bounded sample, of about ``curve_rows`` labelled rows.

Words are runs of digits, letters and non-ASCII characters, A-Z lower-cased. A text without
words has no evidence and the score of the curve's constant; without toxic or without
ordinary learning rows all scores are 0. Null labels are not learned from; a repeated row
counts as often as it occurs; documents are scored one by one; columns not read do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cvforge.llm.common import WORD_BYTES, fold, id_text, packed_texts, slices, tidy, unpack
from cvforge.session import write_shared

#: Taken from every count.
DISCOUNT = 0.75
#: Most that one unit may add to the evidence.
MOST = 4.0
#: Bytes of the texts that are measured together.
CHUNK_BYTES = 8 << 20
#: Shuffle partitions that the chunks are dealt over at most; a partition takes its chunks one by one.
PARTITIONS = 20_000
#: Keys that a task holds at most before it asks for them.
HELD_KEYS = 4_000_000
#: Stands for the unit before in the keys of units alone; beyond all ids.
ALONE = 1 << 26


def units(many: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units of all texts, the unit before each within its word (0 at a word's beginning), and
    where each text's units begin (and the last end). A unit is three bytes of a word, the last
    one of a word perhaps less, and whether it is the first; ids are positive."""
    raw = [(t or "").encode("utf-8", "replace") + b" " for t in many]
    ends = np.cumsum([0, *map(len, raw)])
    chars = np.frombuffer(b"".join(raw).translate(WORD_BYTES) + b"  ", np.uint8)
    inside = chars != 0x20
    n = len(chars) - 2
    place = np.arange(n, dtype=np.int32)
    last_blank = np.maximum.accumulate(np.where(inside[:n], -1, place))
    within = place - last_blank - 1
    at = np.flatnonzero(inside[:n] & (within % 3 == 0))
    first = within[at] == 0
    second = np.where(inside[at + 1], chars[at + 1], 0).astype(np.int64)
    third = np.where(inside[at + 1] & inside[at + 2], chars[at + 2], 0).astype(np.int64)
    ids = chars[at].astype(np.int64) | second << 8 | third << 16 | first.astype(np.int64) << 24
    before = np.zeros_like(ids)
    before[1:] = np.where(first[1:], 0, ids[:-1])
    return ids, before, np.searchsorted(at, ends)


def count_bigrams(labelled: DataFrame) -> DataFrame:
    """(key, n0, n1): every bigram with its count in each class; key = unit before << 32 | unit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "packed"):
            ids, before, ends = units([unpack(p) for p in batch.column("packed").to_pylist()])
            toxic = np.repeat(batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64), np.diff(ends))
            key, spot = np.unique(before << 32 | ids, return_inverse=True)
            n = [np.bincount(spot[toxic == c], minlength=len(key)) for c in (0, 1)]
            yield pa.RecordBatch.from_pydict({"key": pa.array(key, pa.int64()), "n0": pa.array(n[0], pa.int64()), "n1": pa.array(n[1], pa.int64())})

    found = labelled.select("packed", "toxic").mapInArrow(tidy(run), "key long, n0 long, n1 long")
    return found.groupBy("key").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def tell_evidence(bigrams: DataFrame) -> tuple[DataFrame, float]:
    """(key, value) of every bigram seen, of every unit before another one that both classes know
    (key: unit << 32) and of every unit alone (key: ALONE << 32 | unit), each
    log P(.. | toxic) - log P(.. | ordinary); and the same for a unit never seen."""
    unit = F.col("key").bitwiseAND(0x7FFFFFFF)
    bigrams = bigrams.select("key", "n0", "n1", F.shiftright("key", 32).alias("u"), unit.alias("w"))
    befores = bigrams.groupBy("u").agg(
        *(F.sum(f"n{c}").alias(f"h{c}") for c in (0, 1)),
        *(F.count_if(F.col(f"n{c}") > 0).alias(f"f{c}") for c in (0, 1)),
    )
    befores = write_shared(befores.withColumnRenamed("u", "h_u"), "toxicity-befores")
    heads = bigrams.groupBy("w").agg(*(F.count_if(F.col(f"n{c}") > 0).alias(f"s{c}") for c in (0, 1)))
    heads = write_shared(heads.withColumnRenamed("w", "s_w"), "toxicity-heads")
    t = heads.agg(*(F.sum(f"s{c}").alias(f"types{c}") for c in (0, 1)), *(F.count_if(F.col(f"s{c}") > 0).alias(f"units{c}") for c in (0, 1)), F.count("*").alias("all")).first()
    types = [max(t[f"types{c}"] or 0, 1) for c in (0, 1)]
    backoff = [DISCOUNT * t[f"units{c}"] / types[c] if t[f"units{c}"] else 1.0 for c in (0, 1)]
    floor = 1.0 / (t["all"] + 1)

    kept = lambda n: F.greatest(n - F.lit(DISCOUNT), F.lit(0.0))
    shared = (F.col("s0") + F.col("s1")) / F.lit(float(sum(types))) * 0.99 + 0.01 * floor
    alone = [kept(F.col(f"s{c}")) / float(types[c]) + backoff[c] * shared for c in (0, 1)]
    # a unit before that only one class knows would compare a bigram with a mere unit
    known = (F.col("h0") > 0) & (F.col("h1") > 0)
    rest = [DISCOUNT * F.col(f"f{c}") / F.col(f"h{c}") for c in (0, 1)]
    after = [F.when(known, kept(F.col(f"n{c}")) / F.col(f"h{c}") + rest[c] * alone[c]).otherwise(alone[c]) for c in (0, 1)]
    clipped = lambda x: F.greatest(F.least(x, F.lit(MOST)), F.lit(-MOST))
    difference = lambda p: F.log(p[1]) - F.log(p[0])

    # the beginning of words comes before very many units, so its numbers need no join
    start = befores.where("h_u = 0").first()
    first = F.col("u") == 0
    at = F.when(first, -F.col("w")).otherwise(F.col("u"))
    joined = bigrams.join(heads.hint("merge"), F.col("w") == F.col("s_w")).join(befores.hint("merge"), at == F.col("h_u"), "left")
    joined = joined.select("key", "n0", "n1", "s0", "s1", *(F.when(first, F.lit(start[x] if start else 0)).otherwise(F.col(x)).alias(x) for x in ("h0", "h1", "f0", "f1")))
    values = (
        joined.select("key", clipped(difference(after)).alias("value"))
        .union(befores.where(known).select(F.shiftleft("h_u", 32), difference(rest)))
        .union(heads.select(F.lit(ALONE << 32).bitwiseOR(F.col("s_w")), difference(alone)))
    )
    return write_shared(values, "toxicity-values"), float(np.log(backoff[1]) - np.log(backoff[0]))


class Evidence:
    """Log-likelihood differences from values by ``key`` (as of ``tell_evidence``)."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, unseen: float, stretches: tuple[int, ...]):
        order = np.argsort(keys, kind="stable")
        self.keys, self.values, self.unseen, self.stretches = keys[order], values[order], unseen, stretches

    def get(self, keys: np.ndarray, other: float) -> tuple[np.ndarray, np.ndarray]:
        """Value of each key, ``other`` without one, and whether there is one."""
        if not len(self.keys):
            return np.full(len(keys), other), np.zeros(len(keys), bool)
        spot = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        there = self.keys[spot] == keys
        return np.where(there, self.values[spot], other), there

    def per_unit(self, ids: np.ndarray, before: np.ndarray) -> np.ndarray:
        """log P(unit | toxic) - log P(unit | ordinary)."""
        keys, spot = np.unique(before << 32 | ids, return_inverse=True)
        seen, there = self.get(keys, 0.0)
        apart = self.get(keys >> 32 << 32, 0.0)[0] + self.get(ALONE << 32 | (keys & 0x7FFFFFFF), self.unseen)[0]
        return np.where(there, seen, np.clip(apart, -MOST, MOST))[spot]

    def of(self, many: list[str | None]) -> np.ndarray:
        """Of each text the mean over its units and the greatest mean of a stretch of each length; zeros without words."""
        ids, before, ends = units(many)
        out = np.zeros((len(many), 1 + len(self.stretches)))
        if not len(ids):
            return out
        sums = np.concatenate([[0.0], np.cumsum(self.per_unit(ids, before), dtype=np.float64)])
        starts, stops = ends[:-1], ends[1:]
        n = stops - starts
        full = n > 0
        out[full, 0] = ((sums[stops] - sums[starts]) / np.maximum(n, 1))[full]
        text = np.repeat(np.arange(len(many)), n)
        for k, length in enumerate(self.stretches):
            # a stretch that would reach beyond its text's end is moved back into it
            width = np.minimum(length, n)[text]
            begin = np.minimum(np.arange(len(ids)), stops[text] - width)
            out[full, 1 + k] = np.maximum.reduceat((sums[begin + width] - sums[begin]) / length, starts[full])
        return out


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps; weights of the columns and the constant."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    a = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = a.T @ (a * (p * (1 - p))[:, None]) + ridge * np.eye(len(w))
        step = np.linalg.solve(h, a.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    slope = w[:-1] / scale
    return np.append(slope, w[-1] - slope @ mean)


def measure(rows: DataFrame, values: DataFrame, unseen: float, stretches: tuple[int, ...]) -> DataFrame:
    """(doc_id, toxic, evidence) of rows (doc_id, text, toxic)."""
    spark = rows.sparkSession
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    chunks = 1 + size // CHUNK_BYTES
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = zstandard.ZstdCompressor(level=3)
        for batch in slices(batches):
            # equal rows share a chunk; those that lie together become one
            copies: dict[tuple, int] = {}
            for row in zip(*(batch.column(x).to_pylist() for x in ("chunk", "doc_id", "toxic", "text")), strict=True):
                copies[row] = copies.get(row, 0) + 1
            chunk, doc_id, toxic, text = zip(*copies, strict=True)
            packed = [c.compress((t or "").encode("utf-8", "replace")) for t in text]
            yield pa.RecordBatch.from_pydict({"chunk": pa.array(chunk, pa.int64()), "doc_id": pa.array(doc_id, pa.int64()), "toxic": pa.array(toxic, pa.int32()), "copies": pa.array(copies.values(), pa.int64()), "packed": pa.array(packed, pa.binary())})

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}

        def told() -> Iterator[pa.RecordBatch]:
            for c, pairs in held.items():
                keys = np.concatenate([pairs, np.unique(pairs >> 32 << 32), np.unique(ALONE << 32 | (pairs & 0x7FFFFFFF))])
                yield pa.RecordBatch.from_pydict({"a_chunk": pa.array(np.full(len(keys), c), pa.int64()), "a_key": pa.array(keys, pa.int64())})
            held.clear()

        for batch in slices(batches, "packed"):
            ids, before, ends = units([unpack(p) for p in batch.column("packed").to_pylist()])
            of = np.repeat(batch.column("chunk").to_numpy(), np.diff(ends))
            keys = before << 32 | ids
            for c in np.unique(of).tolist():
                new = np.unique(keys[of == c])
                held[c] = np.union1d(held[c], new) if c in held else new
            if sum(map(len, held.values())) > HELD_KEYS:
                yield from told()
        yield from told()

    def answer(texts: pa.Table, told: pa.Table) -> pa.Table:
        evidence = Evidence(told["key"].to_numpy(), told["value"].to_numpy(), unseen, stretches)
        out = []
        for batch in slices(iter(texts.combine_chunks().to_batches()), "packed"):
            x = evidence.of([unpack(p) for p in batch.column("packed").to_pylist()])
            again = np.repeat(np.arange(batch.num_rows), batch.column("copies").to_numpy())
            found = pa.table({"doc_id": batch.column("doc_id"), "toxic": batch.column("toxic"), "evidence": pa.array(x.tolist(), pa.list_(pa.float64()))})
            out.append(found.take(pa.array(again)))
        return pa.concat_tables(out) if out else pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("evidence", pa.list_(pa.float64()))]).empty_table()

    packed = rows.select("chunk", "doc_id", "toxic", "text").mapInArrow(tidy(pack), "chunk long, doc_id long, toxic int, copies long, packed binary")
    # both uses of the dealt texts read one shuffle
    dealt = packed.repartition(min(max(chunks, int(spark.conf.get("spark.sql.shuffle.partitions"))), PARTITIONS), "chunk")
    asked = dealt.mapInArrow(tidy(ask), "a_chunk long, a_key long")
    told = asked.join(values.hint("merge"), F.col("a_key") == F.col("key")).select("a_chunk", "key", "value")
    return dealt.groupBy("chunk").cogroup(told.groupBy("a_chunk")).applyInArrow(answer, "doc_id long, toxic int, evidence array<double>")


@dataclass(frozen=True)
class Model:
    values: DataFrame | None
    unseen: float
    curve: tuple[float, ...] | None
    stretches: tuple[int, ...]


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    held_out: int = 2,
    curve_fold: int = 3,
    curve_rows: int = 8000,
    stretches: tuple[int, ...] = (2, 4, 16),
) -> Model:
    """Counts from the labelled rows outside folds ``held_out`` and ``curve_fold``; the curve from a sample of the latter."""
    known = labels.select(labels[id_col].cast("long").alias("l_id"), labels[label_col].cast("int").alias("toxic")).where("l_id is not null and toxic in (0, 1)")
    known = known.withColumn("fold", fold(F.col("l_id")))
    there = {(r["fold"], r["toxic"]): r["count"] for r in known.groupBy("fold", "toxic").count().collect()}
    in_curve = sum(v for (f, _), v in there.items() if f == curve_fold)
    counted = [sum(v for (f, t), v in there.items() if f not in (held_out, curve_fold) and t == c) for c in (0, 1)]
    if not all(counted) or not in_curve:
        return Model(None, 0.0, None, stretches)
    share = min(1.0, curve_rows / in_curve)
    rows = id_text(docs, id_col, text_col)
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20))
    train = rows.where(~fold(rows.doc_id).isin(held_out, curve_fold))
    curve = rows.where((fold(rows.doc_id) == curve_fold) & drawn)
    # a merge join at every size: a broadcast of the labels while they are few would only change the plan later
    label = lambda part: part.join(known.hint("merge"), part.doc_id == known.l_id)
    bigrams = write_shared(count_bigrams(label(packed_texts(train))), "toxicity-bigrams")
    values, unseen = tell_evidence(bigrams)
    sample = measure(label(curve).select("doc_id", "text", "toxic"), values, unseen, stretches).select("evidence", "toxic").orderBy("evidence", "toxic").collect()
    if not sample:
        return Model(None, 0.0, None, stretches)
    x = np.array([r["evidence"] for r in sample])
    w = fit_curve(x, np.array([r["toxic"] for r in sample], float))
    return Model(values, unseen, tuple(map(float, w)), stretches)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, evidence, score) of every text."""
    rows = id_text(docs, id_col, text_col)
    if model.values is None:
        return rows.selectExpr("doc_id", "cast(null as array<double>) evidence", "0d score")
    found = measure(rows.withColumn("toxic", F.lit(None).cast("int")), model.values, model.unseen, model.stretches)
    return found.select("doc_id", "evidence", curve_of(F.col("evidence"), model.curve).alias("score"))


def curve_of(evidence: Column, curve: tuple[float, ...]) -> Column:
    z = F.lit(curve[-1])
    for k, weight in enumerate(curve[:-1]):
        z = z + evidence[k] * F.lit(weight)
    return 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(500.0)), F.lit(-500.0))))
