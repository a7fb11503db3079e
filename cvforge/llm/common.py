"""Small helpers shared by the corpus operators: reading the tables and walking Arrow batches."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, so other columns cannot clash with its own."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Let a Python worker give memory back: Spark keeps workers between stages, and what one
    stage has freed would else stay with a worker that another stage uses or that only waits."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            libc = ctypes.CDLL(None)
            if hasattr(libc, "malloc_trim"):
                libc.malloc_trim(0)

    return wrapped


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into pieces of about ``limit`` bytes (list items) of ``column``, one row at least."""
    for batch in batches:
        values = batch.column(column)
        measure = pa.compute.list_value_length if pa.types.is_list(values.type) else pa.compute.binary_length
        sizes = pa.compute.fill_null(measure(values), 0).to_pylist()
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Texts of a batch with null as the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


#: Digits, a-z and all bytes of non-ASCII characters are word bytes; A-Z are lower-cased.
WORD_BYTES = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(WORD_BYTES).split()


def fold(doc_id: Column) -> Column:
    """The fold of a document, 0 to 3: crc32 of its id as text, modulo 4. Fold 2 is held out."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4))


#: So many keys at most are broadcast by ``join_each``.
HEAVY = 1000


def join_each(rows: DataFrame, table: DataFrame, key: str, weight: str) -> DataFrame:
    """``rows`` with the columns of ``table`` (one row for each key, of which ``weight`` rows have it), null without a match.

    The ``HEAVY`` keys of the largest weight are broadcast; a key beyond them has fewer than a
    thousandth of the rows. Rows that found theirs so are dealt on by the partition they come from.
    """
    values = F.struct(*[c for c in table.columns if c != key])
    heavy = table.orderBy(F.desc(weight), key).limit(HEAVY).select(F.col(key).alias("heavy_key"), values.alias("heavy_value"))
    other = table.select(F.col(key).alias("other_key"), values.alias("other_value"), F.xxhash64(key, F.lit(0)).alias("other_deal"))
    found = rows.join(F.broadcast(heavy), F.col(key) == F.col("heavy_key"), "left")
    slot = F.when(F.col("heavy_value").isNull(), 0).otherwise(1 + F.spark_partition_id())
    found = found.withColumn("deal", F.xxhash64(key, slot))
    found = found.join(other, (F.col(key) == F.col("other_key")) & (F.col("deal") == F.col("other_deal")), "left")
    return found.select(*rows.columns, F.coalesce("heavy_value", "other_value").alias("value")).select(*rows.columns, "value.*")


def packed_texts(docs: DataFrame, null_ids: bool = True) -> DataFrame:
    """(doc_id, packed): texts compressed for a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = zstandard.ZstdCompressor(level=3)
        for batch in slices(batches):
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "packed": pa.array([c.compress(t.encode("utf-8", "replace")) for t in texts(batch)], pa.binary())})

    return docs.mapInArrow(tidy(run), "doc_id long, packed binary" if null_ids else "doc_id long not null, packed binary")


def unpack(packed: bytes) -> str:
    return zstandard.ZstdDecompressor().decompress(packed).decode("utf-8")


def by_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows in order of ``keys``, as one table for each run of equal keys."""
    rest: pa.Table | None = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = pa.concat_tables([rest, t]) if rest is not None else t
        if not t.num_rows:
            continue
        new = np.zeros(t.num_rows, bool)
        new[0] = True
        for k in keys:
            x = t[k].to_numpy()
            new[1:] |= x[1:] != x[:-1]
        starts = np.flatnonzero(new)
        for s, e in zip(starts[:-1], starts[1:], strict=True):
            yield t.slice(s, e - s)
        rest = t.slice(starts[-1])
    if rest is not None and rest.num_rows:
        yield rest
