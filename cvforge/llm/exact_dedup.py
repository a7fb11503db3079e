"""Exact copies by skew-safe combining, in DataFrame functions alone.

Texts are normalised (A-Z lower-cased) and known by a digest, but two texts are equal only if
their whole contents are: content is a grouping key, beside the digest, at every stage.

1. Copies within a partition fold into one row before anything moves (partial aggregation).
2. Those rows meet by (digest, salt, content). The salt is that of the partition they come
   from, so the copies of a hot text, a row for each partition, end in ``salts`` tasks.
3. The winners of the salts, at most ``salts`` rows a text, are dealt by digest and combined.

The documents then take the winner of their digest from a table without texts. A digest that
several contents share is told there, and its documents are joined on content as well. The
``HEAVY`` largest groups are broadcast; the others are shuffled.

Null counts as the empty text. A row without an id loses against every id. Of rows that share
the kept id (a repeated row, or a group without ids) exactly one is kept. Empty tables give
empty results; columns not read do not matter.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cvforge.llm.common import id_text, join_each
from cvforge.session import write_shared

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is; ``lower`` does that faster where all is ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def combine(rows: DataFrame, salts: int) -> DataFrame:
    """(digest, content, keep_id, group_size) of every distinct content of (doc_id, digest, content)."""
    salted = rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    winners = salted.groupBy("digest", "salt", "content").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    dealt = winners.drop("salt").repartition("digest")
    return dealt.groupBy("digest", "content").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))


def one_of_each(found: DataFrame) -> DataFrame:
    """Mark one row of each group that has the kept id: first one in each partition, then one of those.

    Other rows stay where they are dealt, each partition's rows of a group by themselves.
    """
    here = lambda: F.spark_partition_id() + 1
    best = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    keys = ["text_sha256", "digest", "keep_id", "group_size"]
    rows = found.withColumn("best", best).withColumn("slot", here())
    first = F.col("best") & (F.row_number().over(Window.partitionBy(*keys, "best", "slot").orderBy("doc_id")) == 1)
    rows = rows.withColumn("first", first).withColumn("slot", F.when(F.col("first"), 0).otherwise(here()))
    only = F.col("first") & (F.row_number().over(Window.partitionBy(*keys, "first", "slot").orderBy("doc_id")) == 1)
    return rows.withColumn("kept", only)


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    normalise: Callable[[Column], Column] = lower_ascii,
    digest: Callable[[Column], Column] = sha256,
    salts: int = 64,
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row; the largest id of equal texts is kept."""
    rows = id_text(docs, id_col, text_col).select("doc_id", normalise(F.coalesce("text", F.lit(""))).alias("content"))
    rows = rows.withColumn("digest", digest(F.col("content")))
    groups = combine(rows, salts).groupBy("digest").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"), F.count("*").alias("contents")
    )
    groups = write_shared(groups, "exact-groups")
    named = rows.select("doc_id", "digest", sha256(F.col("content")).alias("text_sha256"))
    found = join_each(named, groups, "digest", "group_size").where("contents = 1").drop("contents")
    shared = groups.where("contents > 1").select("digest")
    if not shared.isEmpty():
        mixed = rows.join(shared, "digest", "left_semi")
        apart = mixed.select("doc_id", "digest", sha256(F.col("content")).alias("text_sha256"), "content").join(combine(mixed, salts), ["digest", "content"])
        found = found.unionByName(apart.drop("content"))
    return one_of_each(found).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
