"""Near-duplicate documents by MinHash with tensored banding.

A document's set holds its distinct shingles, each known by 128 bits made of keyed digests of
its words. Documents with equal sets form a class, whose least id stands for it; only classes are compared. The table keys are *tensored*: there are two
collections of ``halves`` half keys, each made of ``rows`` minhashes, and every pair of a half
key from the first and one from the second is the key of one table. ``halves**2`` tables thus
take only ``2 * halves * rows`` minhashes.

Two classes can meet in a table only if they share a half key of either collection. So half
keys that no other class has are dropped first, and table keys are formed of the rest. In
each table, every class is compared with the table's least class. Components are formed of
the confirmed links; then classes that met in a table but are in different components are
compared among themselves, so no link through a third class is lost, while large groups of
copies, joined by then, are not compared in pairs. Such groups are taken in blocks, so
that no task holds one whole. Links are confirmed on full sets of words, taken from the texts anew.

Two sets of similarity 0.85 miss all tables with probability 3e-4 at the default sizes, of 0.9 with 1e-5;
signatures spare comparisons that full sets would fail (4 standard errors below the limit).

Null, empty and wordless texts have the empty set and link with nothing. Rows that share
an id are one node. A row without an id is linked but names no component; it is kept only
if no row of its class has an id. Empty tables give empty results; columns not read do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cvforge.llm.common import ASCII_LOWER, by_runs, id_text, packed_texts, slices, texts, tidy, unpack
from cvforge.llm.components import components
from cvforge.llm.rolling import U, mix
from cvforge.session import write_shared


@dataclass(frozen=True)
class Params:
    shingle: int = 3
    percent: int = 85  # links have 100 * intersection >= percent * union
    halves: int = 12
    rows: int = 4
    block: int = 1024  # classes of one half key that a task compares at a time
    key: bytes = b"shingles of words"  # of the words' digests; another one hashes anew

    @property
    def hashes(self) -> int:
        return 2 * self.halves * self.rows

    @property
    def estimate(self) -> float:
        """Least share of equal minhashes of a pair worth confirming."""
        p = self.percent / 100
        return p - 4 * (p * (1 - p) / self.hashes) ** 0.5


def words_of(text: str) -> list[bytes]:
    """Words between white space (0x20, 0x09-0x0D), A-Z in lower case."""
    return text.encode("utf-8", "replace").translate(ASCII_LOWER).split()


def lanes_of(many: list[str], p: Params) -> list[np.ndarray]:
    """The distinct shingles of each text, two 64-bit hashes (columns) each, sorted.

    A word's 128-bit digest is keyed and gives a number for each column; a shingle's hashes mix those of its words.
    """
    lists = [words_of(t) for t in many]
    coded = pa.array(list(chain.from_iterable(lists)), pa.binary()).dictionary_encode()
    digests = b"".join(hashlib.blake2b(w, digest_size=16, key=p.key).digest() for w in coded.dictionary.to_pylist())
    words = np.frombuffer(digests, np.uint64).reshape(-1, 2)[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else np.zeros((0, 2), np.uint64)
    size, step = p.shingle, np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
    run = words.copy()
    for k in range(1, size):  # hashes of the ``size`` words from each word on
        run = mix(run[: len(words) - k] * step + words[k:]) if len(words) > k else run[:0]
    out, a = [], 0
    for z in np.cumsum([len(x) for x in lists]).tolist():
        if z - a >= size:
            found = run[a : z - size + 1]
        else:
            found = words[a : min(z, a + 1)]
            for i in range(a + 1, z):
                found = mix(found * step + words[i : i + 1])
            found = mix(found + U(z - a))
        first, place = np.unique(found[:, 0], return_index=True)
        out.append(np.stack([first, found[place, 1]], 1))
        a = z
    return out


def sets_of(many: list[str], p: Params) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text, one column alone."""
    return [x[:, 0] for x in lanes_of(many, p)]


def shingles_of(text: str, size: int) -> frozenset[tuple[bytes, ...]]:
    """The shingles themselves, as words."""
    w = words_of(text)
    return frozenset(zip(*(w[k:] for k in range(size)), strict=False)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def linked(a: frozenset, b: frozenset, p: Params) -> bool:
    """The link's rule on sets of words."""
    both = len(a & b)
    return bool(both) and 100 * both >= p.percent * (len(a) + len(b) - both)


@lru_cache(maxsize=2)
def multipliers(n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 64, n, np.uint64, endpoint=False) | U(1)


def signature(s: np.ndarray, p: Params) -> np.ndarray:
    """16 bits of each minhash; ``rows`` of them make a half key of 64 bits."""
    m = multipliers(p.hashes)
    least = np.full(p.hashes, ~U(0))
    for i in range(0, len(s), 2048):
        np.minimum(least, (s[i : i + 2048, None] * m).min(0), out=least)
    return (mix(least) & U(0xFFFF)).astype(np.uint16)


def describe(docs: DataFrame, p: Params) -> DataFrame:
    """(doc_id, n, set_key, sig) of every document; set_key and sig are null for the empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = lanes_of(texts(batch), p)
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            sigs = [signature(s[:, 0], p).view(np.int64) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "n": pa.array([len(s) for s in sets], pa.int64()), "set_key": pa.array(keys, pa.binary()), "sig": pa.array(sigs, pa.list_(pa.int64()))}
            )

    return docs.mapInArrow(tidy(run), "doc_id long, n long, set_key binary, sig array<long>")


def star_pairs(classes: DataFrame, p: Params) -> tuple[DataFrame, DataFrame]:
    """Shared half keys (rep, slot, half), and the pairs (a, b) of each table's least class with its others."""
    halves = classes.select("rep", F.posexplode("sig").alias("slot", "value")).select("rep", "slot", F.xxhash64("slot", "value").alias("half"))
    common = halves.groupBy("half").agg(F.count("*").alias("n")).where("n > 1").select("half")
    shared = write_shared(halves.join(common, "half", "left_semi"), "minhash-halves")
    listed = shared.groupBy("rep").agg(F.collect_list(F.struct("slot", "half")).alias("h"))
    first, second = F.filter("h", lambda x: x["slot"] < p.halves), F.filter("h", lambda x: x["slot"] >= p.halves)
    keys = F.flatten(F.transform(first, lambda x: F.transform(second, lambda y: F.xxhash64(x["half"], y["half"]))))
    tables = listed.select("rep", F.explode(keys).alias("key"))
    least = tables.groupBy("key").agg(F.min("rep").alias("a"), F.count("*").alias("n")).where("n > 1").select("key", "a")
    pairs = tables.join(least, "key").where("rep <> a").select("a", F.col("rep").alias("b")).distinct()
    return shared, write_shared(pairs, "minhash-pairs")


def likely(pairs: DataFrame, classes: DataFrame, p: Params) -> DataFrame:
    """Pairs whose sizes and signatures leave a link possible."""
    side = lambda x: classes.select(F.col("rep").alias(x), F.col("n").alias(f"n_{x}"), F.col("sig").alias(f"sig_{x}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a").where(f"100 * least(n_a, n_b) >= {p.percent} * greatest(n_a, n_b)")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (batch.column(c).flatten().to_numpy().view(np.uint16).reshape(batch.num_rows, -1) for c in ("sig_a", "sig_b"))
                yield batch.select(["a", "b"]).filter(pa.array((x == y).mean(1) >= p.estimate))

    return both.select("a", "b", "sig_a", "sig_b").mapInArrow(tidy(run), "a long, b long")


def similar(a: np.ndarray, b: np.ndarray, p: Params) -> bool:
    """Whether two sets, sorted, are similar enough for a link."""
    if not len(a) or not len(b):
        return False
    both = int((a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b).sum())
    return 100 * both >= p.percent * (len(a) + len(b) - both)


def confirmed(pairs: DataFrame, packed: DataFrame, p: Params) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    side = lambda x: packed.select(F.col("doc_id").alias(x), F.col("packed").alias(f"text_{x}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a").sortWithinPartitions("a").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[bytes, np.ndarray, frozenset] | None = None
        for batch in slices(batches, "text_b", 1 << 20):
            marks = []
            plain = [unpack(x) for x in batch.column("text_b").to_pylist()]
            for own, text, other in zip(batch.column("text_a").to_pylist(), plain, sets_of(plain, p), strict=True):
                if held is None or held[0] != own:
                    held = (own, sets_of([unpack(own)], p)[0], shingles_of(unpack(own), p.shingle))
                marks.append(similar(held[1], other, p) and linked(held[2], shingles_of(text, p.shingle), p))
            yield batch.select(["a", "b"]).filter(pa.array(marks, pa.bool_()))

    return both.mapInArrow(tidy(run), "a long, b long")


def crossing_links(shared: DataFrame, classes: DataFrame, joined: DataFrame, packed: DataFrame, p: Params) -> DataFrame:
    """Links between classes that met in a table and lie in different components.

    All classes of one half key of the first collection meet in a task, or in one task for
    each two blocks if they are many. A pair counts under the first half key it shares, and is
    confirmed there on its full sets; pairs that links found before have joined are passed
    over, so that only links which join something leave the task.
    """
    home = classes.join(joined, classes.rep == joined.node, "left").select("rep", "n", "sig", F.coalesce("component", "rep").alias("home"))
    first = shared.where(F.col("slot") < p.halves)
    labelled = first.join(home.select("rep", "home"), "rep")
    mixed = labelled.groupBy("half").agg(F.count("*").alias("many"), F.min("home").alias("low"), F.max("home").alias("high")).where("many > 2 and low <> high").select("half", "many")
    rows = first.join(mixed, "half").withColumn("blocks", F.ceil(F.col("many") / p.block).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    rows = rows.select("rep", "slot", "half", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    rows = rows.select("rep", "slot", "half", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    rows = rows.join(home, "rep").join(packed, F.col("rep") == F.col("doc_id"))
    rows = rows.repartition("half", "low", "high").sortWithinPartitions("half", "low", "high")

    def compare(t: pa.Table) -> pa.Table:
        low, high, slot = (t[c][0].as_py() for c in ("low", "high", "slot"))
        rep, home_, own, n = (t[c].to_numpy() for c in ("rep", "home", "own", "n"))
        sig = np.ascontiguousarray(t["sig"].combine_chunks().flatten().to_numpy().reshape(len(rep), -1))
        short, packed_ = sig.view(np.uint16), t["packed"]
        sets: dict[int, np.ndarray] = {}

        def set_of(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = sets_of([text_of(i)], p)[0]
            return sets[i]

        def text_of(i: int) -> str:
            return unpack(packed_[i].as_py())

        links: list[tuple[int, int]] = []
        where = home_.copy()  # components as the links found here join them
        for i in range(len(rep)):
            far = where != where[i]
            far[: i + 1] = False
            if low != high:
                far &= own != own[i]
            far &= 100 * np.minimum(n, n[i]) >= p.percent * np.maximum(n, n[i])
            at = np.flatnonzero(far)
            if not len(at):
                continue
            alike = (short[at] == short[i]).mean(1)
            same = sig[at] == sig[i]
            met = (alike >= p.estimate) & (same[:, : p.halves].argmax(1) == slot) & same[:, p.halves :].any(1)
            for j in at[met][np.argsort(-alike[met], kind="stable")]:
                if where[j] != where[i] and similar(set_of(i), set_of(j), p) and linked(shingles_of(text_of(i), p.shingle), shingles_of(text_of(j), p.shingle), p):
                    links.append((min(rep[i], rep[j]), max(rep[i], rep[j])))
                    where[where == where[j]] = where[i]
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in by_runs(batches, ["half", "low", "high"]):
            yield from compare(t).to_batches()

    return rows.select("half", "low", "high", "slot", "rep", "home", "own", "n", "sig", "packed").mapInArrow(tidy(run), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: Params = Params()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document."""
    p = params
    rows = id_text(docs, id_col, text_col)
    described = write_shared(describe(rows, p), "minhash-sets")
    found = described.where("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig"))
    found = write_shared(found, "minhash-classes")
    classes = found.where("rep is not null").select("rep", "n", "sig")
    shared, pairs = star_pairs(classes, p)
    met = pairs.select(F.col("a").alias("m_id")).union(pairs.select("b")).distinct()
    # a merge join at every size: a broadcast of few ids would only change the plan later
    packed = packed_texts(rows)
    packed = write_shared(packed.join(met.hint("merge"), packed.doc_id == met.m_id, "left_semi"), "minhash-texts")
    links = write_shared(confirmed(likely(pairs, classes, p), packed, p), "minhash-links")
    joined = components(links)
    more = write_shared(crossing_links(shared, classes, joined, packed, p).distinct(), "minhash-links")
    if more.limit(1).count():
        joined = components(links.union(more))
    homes = found.join(joined, found.rep == joined.node, "left").select(F.col("set_key").alias("c_key"), F.coalesce("component", "rep").alias("home"))
    out = described.drop("sig").join(homes, described.set_key == homes.c_key, "left")
    home = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("home"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), home.alias("component_id"), F.col("doc_id").eqNullSafe(home).alias("kept"))
