"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. A letter n-gram is the
element-wise product of its letters' vectors, each rotated by its place (binding); a text is
the sum of its n-grams' vectors (bundling); a language's prototype is the sum over its
learning texts, each weighted to the same total. A text has the language whose prototype is
nearest by cosine.

Texts are lower-cased and every run of non-letters is one blank, which has a vector too.
Learning reads all learning rows: tasks bundle what they read, and the sums per language and
dimension are added up by Spark in whole numbers, so results do not depend on the order. The
prototypes are the only thing broadcast: languages times ``dims`` numbers.

A text that is null or has no letter is ``und`` with score 0, and so is every text if nothing
can be learned (empty table, no labels). Ties go to the alphabetically first language. Null
labels are not learned from. Rows are judged one by one; columns not read do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cvforge.llm.common import id_text, slices, texts, tidy

#: Whole-number weight that each learning text spreads over its n-grams.
UNIT = 1 << 20
#: Longer texts are read in parts of so many characters; n-grams are bound so many at a time.
LONG, BLOCK = 1 << 19, 1 << 13


@dataclass(frozen=True)
class Profiles:
    """Prototypes of the learned languages, one row of ``matrix`` each, of length 1."""

    langs: tuple[str, ...]
    matrix: np.ndarray
    n: int
    dims: int


@lru_cache(maxsize=1 << 15)
def letter_vector(code: int, dims: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([code, dims])).integers(0, 2, dims, dtype=np.int8) * 2 - 1


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)], bool)


def spelled(many: list[str], n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(codes, row): letters and single blanks of the texts, and the text of each, in pieces.

    A piece holds several texts, or a part of one text beyond LONG; such a part begins with the
    last n - 1 codes of the part before, so that every n-gram lies in one part.
    """
    short = [i for i, t in enumerate(many) if len(t) <= LONG]
    if short:
        joined = [f" {many[i].lower()} " for i in short]
        row = np.repeat(np.array(short, np.int32), [len(t) for t in joined])
        chars = np.frombuffer("".join(joined).encode("utf-32-le", "replace"), np.uint32)
        is_letter = letters()[chars]
        keep = is_letter.copy()
        keep[0:1] = True
        keep[1:] |= is_letter[:-1] | (row[1:] != row[:-1])  # the first blank of each run
        yield np.where(is_letter, chars, 0x20)[keep], row[keep]
    for i in sorted(set(range(len(many))) - set(short)):
        low, before = many[i].lower() + " ", np.array([0x20], np.uint32)
        for at in range(0, len(low), LONG):
            chars = np.frombuffer(low[at : at + LONG].encode("utf-32-le", "replace"), np.uint32)
            is_letter = letters()[chars]
            keep = is_letter.copy()
            keep[0] |= before[-1] != 0x20
            keep[1:] |= is_letter[:-1]
            codes = np.concatenate([before, np.where(is_letter, chars, 0x20)[keep]])
            yield codes, np.full(len(codes), i, np.int32)
            before = codes[1 - n :] if n > 1 else codes[-1:]


class Grams:
    """The n-grams of a piece: ``codes`` (one row of code points each) and which text has which."""

    def __init__(self, spelling: np.ndarray, row: np.ndarray, texts_: int, n: int):
        self.texts = texts_
        known = np.flatnonzero(np.bincount(spelling, minlength=0x21))
        size, span = len(known), max(0, len(spelling) - n + 1)
        number = np.zeros(int(known[-1]) + 1 if size else 1, np.int64)
        number[known] = np.arange(size)
        ids = number[spelling]
        key = np.zeros(span, np.int64)
        for k in range(n):
            key = key * size + ids[k : k + span]
        inside = row[:span] == row[n - 1 : n - 1 + span]
        key, self.row = key[inside], row[:span][inside]
        if size**n <= 1 << 22:
            present = np.flatnonzero(np.bincount(key, minlength=1))
            lookup = np.zeros(size**n, np.int32)
            lookup[present] = np.arange(len(present))
            self.column = lookup[key]
        else:
            present, self.column = np.unique(key, return_inverse=True)
        self.codes = known[np.stack([present // size ** (n - 1 - k) % size for k in range(n)], 1)] if len(present) else np.zeros((0, n), np.int64)

    def blocks(self, dims: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(counts of texts by n-grams, bound vectors) of at most BLOCK n-grams at a time."""
        row, column = self.row, self.column
        if len(self.codes) > BLOCK:
            order = np.argsort(column, kind="stable")
            row, column = row[order], column[order]
        for at in range(0, len(self.codes), BLOCK):
            codes = self.codes[at : at + BLOCK]
            low, high = (0, len(row)) if len(self.codes) <= BLOCK else np.searchsorted(column, [at, at + BLOCK])
            cell = row[low:high].astype(np.int64) * len(codes) + (column[low:high] - at)
            yield np.bincount(cell, minlength=self.texts * len(codes)).reshape(self.texts, len(codes)), vectors(codes, dims)


def vectors(codes: np.ndarray, dims: int) -> np.ndarray:
    """The bound vector of each n-gram."""
    out = np.ones((len(codes), dims), np.int8)
    known, place = np.unique(codes, return_inverse=True)
    table = np.stack([letter_vector(int(c), dims) for c in known]) if len(known) else np.zeros((0, dims), np.int8)
    place = place.reshape(codes.shape)
    for k in range(codes.shape[1]):
        out *= np.roll(table, k, axis=1)[place[:, k]]
    return out


def grams_in(many: list[str], n: int) -> np.ndarray:
    """Number of n-grams of each text."""
    found = np.zeros(len(many), np.int64)
    for codes, row in spelled(many, n):
        span = max(0, len(codes) - n + 1)
        found += np.bincount(row[:span][row[:span] == row[n - 1 : n - 1 + span]], minlength=len(many))
    return found


def groups(batches: Iterator[pa.RecordBatch], rows: int = 256, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of at most ``rows`` texts, so that a table of counts stays small."""
    for batch in slices(batches, column):
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", n: int = 3, dims: int = 1024) -> Profiles:
    """Prototypes from all rows of ``docs`` whose ``lang_col`` is not null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in groups(batches):
            many = texts(batch)
            langs = np.array(batch.column("lang").to_pylist(), object)
            here = list(dict.fromkeys(langs))
            pieces = [Grams(*piece, len(many), n) for piece in spelled(many, n)] if max(map(len, many), default=0) <= LONG else None
            totals = grams_in(many, n) if pieces is None else sum(np.bincount(g.row, minlength=len(many)) for g in pieces)
            totals = np.maximum(totals, 1)[:, None]
            for grams in pieces or (Grams(*piece, len(many), n) for piece in spelled(many, n)):
                for counts, bound in grams.blocks(dims):
                    weights = counts * UNIT // totals
                    added = np.stack([weights[langs == lang].sum(0) for lang in here]).astype(np.float64)
                    for k in range(0, dims, 256):  # whole numbers far below 2**53, so the products are exact
                        part = (added @ bound[:, k : k + 256].astype(np.float64)).astype(np.int64)
                        for lang, v in zip(here, part, strict=True):
                            sums.setdefault(lang, np.zeros(dims, np.int64))[k : k + 256] += v
        for lang, v in sums.items():
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang]), "bundle": pa.array([v.tolist()], pa.list_(pa.int64()))})

    rows = docs.select(docs[text_col].cast("string").alias("text"), docs[lang_col].cast("string").alias("lang")).where("lang is not null")
    bundles = rows.mapInArrow(tidy(run), "lang string, bundle array<long>")
    added = bundles.select("lang", F.posexplode("bundle").alias("k", "v")).groupBy("lang", "k").agg(F.sum(F.col("v").cast("double")).alias("v"))
    found = added.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("k", "v")))["v"].alias("v")).orderBy("lang").collect()
    matrix = np.array([r["v"] for r in found], np.float64).reshape(len(found), dims)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return Profiles(tuple(r["lang"] for r in found), (matrix / np.where(norms == 0, 1, norms)).astype(np.float32), n, dims)


def predict(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score): the nearest language and its cosine, cut off at 0 and 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches):
            lang, score, _ = nearest(texts(batch), profiles)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "lang_pred": pa.array(lang, pa.string()), "score": pa.array(score, pa.float64())})

    return id_text(docs, id_col, text_col).mapInArrow(tidy(run), "doc_id long, lang_pred string, score double")


def least_cosines(docs: DataFrame, profiles: Profiles, enough: int, quantile: float = 0.05, share: float = 0.5, text_col: str = "text", lang_col: str = "lang") -> dict[str, float]:
    """Per language, ``share`` of the low ``quantile`` of its own texts' cosines.

    Counted are all rows of ``docs`` with ``enough`` n-grams or more that the profiles put in the
    language of their label; cosines are rounded to thousandths, so 1,001 counts a language do. A language
    without such rows has the least cosine 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches):
            lang, score, size = nearest(texts(batch), profiles)
            found = [(x, round(1000 * s)) for x, s, n, label in zip(lang, score, size, batch.column("lang").to_pylist(), strict=True) if n >= enough and x == label]
            yield pa.RecordBatch.from_pydict({"lang": pa.array([x for x, _ in found], pa.string()), "step": pa.array([k for _, k in found], pa.int32())})

    rows = docs.select(docs[text_col].cast("string").alias("text"), docs[lang_col].cast("string").alias("lang")).where("lang is not null")
    counted = rows.mapInArrow(tidy(run), "lang string, step int").groupBy("lang", "step").count().orderBy("lang", "step").collect()
    least = dict.fromkeys(profiles.langs, 0.0)
    for lang in least:
        steps = [(r["step"], r["count"]) for r in counted if r["lang"] == lang]
        wanted = quantile * sum(n for _, n in steps)
        for step, n in steps:
            wanted -= n
            if wanted <= 0:
                least[lang] = share * step / 1000
                break
    return least


def accepted(docs: DataFrame, profiles: Profiles, least: dict[str, float], enough: int, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text is in a learned language.

    Rejected are texts without letters, and those of ``enough`` n-grams or more with a cosine
    below the ``least`` of their language; shorter texts say too little to be turned away.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches, column=text_col):
            found = zip(*nearest(texts(batch, text_col), profiles), strict=True)
            yield batch.filter(pa.array([x != "und" and (n < enough or s >= least.get(x, 0.0)) for x, s, n in found], pa.bool_()))

    return docs.mapInArrow(tidy(run), docs.schema)


def nearest(many: list[str], profiles: Profiles) -> tuple[list[str], list[float], list[int]]:
    """Language, score and number of n-grams of each text."""
    bundles = np.zeros((len(many), profiles.dims), np.float32)
    sizes, known = np.zeros(len(many), np.int64), np.zeros(len(many), bool)
    for codes, row in spelled(many, profiles.n):
        known[row[codes != 0x20]] = True
        grams = Grams(codes, row, len(many), profiles.n)
        sizes += np.bincount(grams.row, minlength=len(many))
        if profiles.langs:
            for counts, bound in grams.blocks(profiles.dims):
                bundles += counts.astype(np.float32) @ bound.astype(np.float32)
    if not profiles.langs:
        return ["und"] * len(many), [0.0] * len(many), sizes.tolist()
    norms = np.linalg.norm(bundles, axis=1, keepdims=True)
    cosines = (bundles @ profiles.matrix.T) / np.where(norms == 0, 1, norms)
    best = cosines.argmax(1)
    top = np.clip(cosines[np.arange(len(many)), best], 0.0, 1.0)
    known &= sizes > 0
    langs = [profiles.langs[b] if k else "und" for b, k in zip(best, known, strict=True)]
    return langs, [float(s) if k else 0.0 for s, k in zip(top, known, strict=True)], sizes.tolist()
