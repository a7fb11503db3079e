"""Phrase collocations by prefix-free parsing.

Texts are cut into words; a separator byte stands between pieces. Where a window of words
hashes to 0 modulo ``period``, a chunk ends and the next begins, the window belonging to both.
So equal passages parse alike wherever they stand, and the distinct chunks with their parse
frequencies are a dictionary of the corpus. An n-gram is counted inside the distinct chunks,
weighted by their frequencies, and belongs to the chunk in which it begins before the overlap,
once.

Counting goes by length. Every part of a phrase with ``least`` occurrences has as many, so an
n-gram is counted only if both (n-1)-grams within it may have them. That is asked of a
broadcast bitmap of 2**BITS bits (8 MB at every size): a bit is set for each frequent
(n-1)-gram's hash, so a wrong answer can only let an n-gram pass to be counted in vain. Counts
themselves are by phrase, exact; scores are whole numbers, products taken as decimals.

Null texts are empty, a null lang is ``und``; rows are occurrences, so repeated rows and ids count
each time; ties end in byte order. A text without words adds nothing. Empty tables give empty results; columns
not read do not matter. A very long text has chunks of its own; no length is cut.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cvforge.llm.common import slices, texts, tidy
from cvforge.llm.rolling import U, mix
from cvforge.session import write_shared

#: Bits of the bitmap that tells which shorter phrases may be frequent.
BITS = 26
#: Bytes of texts or chunks that a task counts at a time.
PIECE = 8 << 20
SEP = b"\xff"  # in no UTF-8 text
_ends = b".,;:!?\n\x0b\x0c\r"
CUT = bytes(0xFF if b in _ends else 0x20 if b == 9 else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def words_in(texts_: list[str]) -> list[list[bytes]]:
    """The words of each text, lower-cased, with SEP between pieces."""
    return [t.encode("utf-8", "replace").translate(CUT).replace(SEP, b" \xff ").split() for t in texts_]


class Tokens:
    """Rows of words as one array of ids, with a hash for each word."""

    def __init__(self, words: pa.Array, lengths: np.ndarray):
        self.lengths = lengths
        coded = words.dictionary_encode()
        self.words = coded.dictionary
        self.ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        known = self.words.to_pylist()
        self.hash = np.array([xxhash.xxh64_intdigest(w) for w in known], np.uint64)[self.ids] if known else np.zeros(0, np.uint64)
        self.real = np.array([w != SEP for w in known], bool)[self.ids] if known else np.zeros(0, bool)


def split(rows: pa.Array) -> Tokens:
    """The words of rows in which single blanks stand between them."""
    lists = pc.split_pattern(rows, b" ")
    return Tokens(lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))


def chunks_of(lists: list[list[bytes]], overlap: int, period: int) -> list[list[bytes]]:
    """The chunks of each text; the last is filled up with SEP, so the words that a chunk owns are all but ``overlap``."""
    filled = [x + [SEP] * overlap for x in lists]
    t = Tokens(pa.array(list(chain.from_iterable(filled)), pa.binary()), np.array([len(x) for x in filled], np.int64))
    if not len(t.ids):
        return [[] for _ in lists]
    h = t.hash
    window = reduce(lambda x, k: mix(x * U(0x9E3779B97F4A7C15) + np.roll(h, -k)), range(1, overlap), h)
    ends = np.cumsum(t.lengths)
    begins = ends - t.lengths
    cut = window % U(period) == 0
    cut[begins] = False
    for k in range(overlap + 1):  # no chunk begins in the filling
        cut[np.maximum(ends - k, begins)[ends - k < len(cut)]] = False
    places = np.flatnonzero(cut)
    spans = np.searchsorted(places, np.stack([begins, ends]))
    out = []
    for words, begin, low, high in zip(filled, begins.tolist(), spans[0].tolist(), spans[1].tolist(), strict=True):
        edges = [0, *(places[low:high] - begin).tolist(), len(words) - overlap]
        out.append([b" ".join(words[a : b + overlap]) for a, b in zip(edges[:-1], edges[1:], strict=True) if b > a])
    return out


def parse(docs: DataFrame, longest: int, period: int) -> DataFrame:
    """(lang, chunk, n): the dictionary of chunks with their parse frequencies in each lang."""
    overlap = longest - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=PIECE):
            found = chunks_of(words_in(texts(batch)), overlap, period)
            n = Counter((lang, c) for lang, many in zip(batch.column("lang").to_pylist(), found, strict=True) for c in many)
            yield pa.RecordBatch.from_pydict(
                {"lang": pa.array([lang for lang, _ in n], pa.string()), "chunk": pa.array([c for _, c in n], pa.binary()), "n": pa.array(n.values(), pa.int64())}
            )

    return docs.mapInArrow(tidy(run), "lang string, chunk binary, n long").groupBy("lang", "chunk").agg(F.sum("n").alias("n"))


def named(langs: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(x, seed=1) for x in langs], np.uint64)


def gram_hashes(first: np.ndarray, lang: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the ``size`` words from each place of ``at`` on, in their lang."""
    return reduce(lambda x, k: mix(x * U(0x9E3779B97F4A7C15) + first[at + k]), range(size), lang)


def known_bits(spark: SparkSession, frequent: DataFrame, size: int) -> np.ndarray:
    """The bitmap of the frequent phrases of ``size`` words, put together in Spark by blocks of 64 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            t = split(batch.column("phrase").cast(pa.binary()))
            at = np.arange(batch.num_rows) * size
            lang = named(langs.dictionary.to_pylist())[langs.indices.to_numpy()] if batch.num_rows else np.zeros(0, np.uint64)
            bit = gram_hashes(t.hash, lang, at, size) >> U(64 - BITS)
            yield pa.RecordBatch.from_pydict({"block": (bit >> U(6)).astype(np.int64), "bits": (U(1) << (bit & U(63))).view(np.int64)})

    blocks = frequent.select("lang", "phrase").mapInArrow(tidy(run), "block long, bits long").groupBy("block").agg(F.bit_or("bits").alias("bits"))
    found = blocks.toArrow()  # 2**BITS / 64 rows at most
    out = np.zeros(1 << (BITS - 6), np.uint64)
    out[found["block"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


def count_grams(dictionary: DataFrame, size: int, overlap: int, bits: object | None) -> DataFrame:
    """(lang, phrase, n) of the phrases of ``size`` words; ``bits`` is the broadcast bitmap of those one shorter."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs = batch.column("lang").dictionary_encode()
        t = split(batch.column("chunk"))
        many = len(t.ids)
        of_chunk = np.repeat(np.arange(batch.num_rows), t.lengths)
        lang = langs.indices.to_numpy()[of_chunk]
        left = np.cumsum(t.lengths)[of_chunk] - np.arange(many)  # words from here to the chunk's end
        open_ = left > overlap
        for k in range(size):
            open_[: many - k] &= t.real[k:]
        at = np.flatnonzero(open_)
        if bits is not None:
            named_ = named(langs.dictionary.to_pylist())[lang]
            for k in (0, 1):
                bit = gram_hashes(t.hash, named_[at], at + k, size - 1) >> U(64 - BITS)
                at = at[(bits.value[bit >> U(6)] >> (bit & U(63)) & U(1)).astype(bool)]
        code = lang[at].astype(np.int64)
        for k in range(size):
            code, kinds = pd.factorize(code * len(t.words) + t.ids[at + k])
        total = np.zeros(len(kinds) if len(at) else 0, np.int64)
        np.add.at(total, code, batch.column("n").to_numpy()[of_chunk[at]])
        first = np.zeros(len(total), np.int64)
        first[code[::-1]] = at[::-1]
        parts = [t.words.take(pa.array(t.ids[first + k])) for k in range(size)]
        phrase = pc.binary_join_element_wise(*parts, b" ") if size > 1 else parts[0]
        return pa.RecordBatch.from_pydict({"lang": langs.dictionary.take(pa.array(lang[first])), "phrase": phrase.cast(pa.string()), "n": total})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "chunk", PIECE):
            yield count(batch)

    return dictionary.mapInArrow(tidy(run), "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("f"))


def frequent_grams(docs: DataFrame, longest: int, least: int, period: int) -> tuple[DataFrame, list[DataFrame]]:
    """(lang, n) of all words, and for each length (lang, phrase, f) of the phrases that occur ``least`` times."""
    spark = docs.sparkSession
    dictionary = write_shared(parse(docs, longest, period), "phrase-dictionary")
    words = write_shared(count_grams(dictionary, 1, longest - 1, None), "phrase-counts")
    found = [words.where(F.col("f") >= least)]
    for size in range(2, longest + 1):
        bits = spark.sparkContext.broadcast(known_bits(spark, found[-1], size - 1))
        counted = count_grams(dictionary, size, longest - 1, bits).where(F.col("f") >= least)
        found.append(write_shared(counted, "phrase-counts"))
        bits.destroy()
    return words.groupBy("lang").agg(F.sum("f").alias("n")), found


def scored(found: list[DataFrame], scale: int) -> DataFrame:
    """(lang, phrase, size, a, l, r, score) of every phrase of two words or more, by its lowest cut."""
    every = reduce(DataFrame.union, [x.select("lang", "phrase", "f", F.lit(k + 1).alias("size")) for k, x in enumerate(found)])
    phrases = every.where("size > 1").withColumnRenamed("f", "a")
    part = lambda begin, n: F.array_join(F.slice(F.split("phrase", " ", -1), begin, n), " ")
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumn("head", part(F.lit(1), F.col("k"))).withColumn("tail", part(F.col("k") + 1, F.col("size") - F.col("k")))
    side = lambda name, n: every.select("lang", F.col("phrase").alias(name), F.col("f").alias(n))
    cuts = cuts.join(side("head", "l"), ["lang", "head"]).join(side("tail", "r"), ["lang", "tail"])
    cuts = cuts.withColumn("score", F.expr(f"(cast(a as decimal(19,0)) * cast({scale} as decimal(18,0))) div (cast(l as decimal(19,0)) + r)"))
    lowest = cuts.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
    return lowest.select("lang", "phrase", "size", "a", "c.l", "c.r", "c.score")


def collocations(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    longest: int = 4,
    least: int = 30,
    share: int = 80,
    most: int = 2000,
    scale: int = 2_000_000,
    period: int = 64,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each lang's ``most`` best phrases.

    A phrase goes if a longer one that holds it has at least ``share`` per cent of its occurrences.
    """
    rows = docs.select(F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang"), docs[text_col].cast("string").alias("text"))
    words, found = frequent_grams(rows, longest, least, period)
    phrases = write_shared(scored(found, scale), "phrase-scores")
    inner = phrases.where("size > 2").select("lang", "a", "size", F.split("phrase", " ", -1).alias("w"))
    inner = inner.withColumn("many", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    inner = inner.withColumn("begin", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("many") + 1)))
    held = inner.groupBy("lang", F.array_join(F.slice("w", F.col("begin"), F.col("many")), " ").alias("phrase")).agg(F.max("a").alias("longer"))
    times = lambda c, k: F.col(c).cast("decimal(19,0)") * F.lit(k)
    left = phrases.join(held, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (times("longer", 100) < times("a", share)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return best.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
