"""Document fingerprints: bottom-k sketches of word shingles, in DataFrame functions alone.

A text's words are what white space separates, in lower case; a shingle is ``size`` consecutive
words (all words, if there are fewer). A sketch is the ``k`` smallest distinct 64-bit shingle
hashes in ascending order. The sketch of a union is the k smallest of both sketches, so
parts merge in any order. The share of a union's sketch that both sketches hold estimates
the resemblance; the place of the k-th hash estimates the number of distinct shingles; both
together give the containment. With fewer than k shingles all three are exact.

Null texts are empty; texts without words have the empty sketch, which resembles another
empty one fully and any other not at all. Rows that share an id are ordered by a hash of their
text; a null id comes before all others. Empty tables give empty results; columns not read do not matter.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cvforge.llm.common import id_text

K = 256
SHINGLE = 5
#: Documents meet their next one in GROUPS x GROUPS groups of neighbours; more for tables beyond some 100 TB.
GROUPS = 64


def held(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later expressions read again and again without computing them anew: a
    generator of one row is a border that the optimizer does not merge projections over."""
    names = list(columns)
    found = df.select("*", F.explode(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))).alias("held_row"))
    return found.select(*(F.col(c) for c in df.columns), *(F.col("held_row")[n].alias(n) for n in names))


def sketch(df: DataFrame, text_col: str, out: str, k: int = K, size: int = SHINGLE) -> DataFrame:
    """``df`` with the sketch of ``text_col`` as the column ``out``."""
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    df = held(df, sk_words=F.transform(words, lambda w: F.xxhash64(w)))
    word = F.col("sk_words")
    shingles = F.transform(
        F.sequence(F.lit(0), F.size(word) - size), lambda i: F.xxhash64(*(F.get(word, i + j) for j in range(size)))
    )
    hashes = F.when(F.size(word) >= size, shingles).when(F.size(word) > 0, F.array(F.xxhash64(word))).otherwise(F.array().cast("array<bigint>"))
    return held(df, **{out: F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)}).drop("sk_words")


def union_sketch(a: Column, b: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the union's shingles that both texts have."""
    union = union_sketch(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(a, b), union))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k, else from the k-th smallest hash."""
    place = (F.element_at(a, k).cast("double") + F.lit(2.0**63) + 1) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / place)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first text's shingles that the second has too."""
    both = resemblance(a, b, k) * distinct_count(union_sketch(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), both / distinct_count(a, k)))


def merge_sketches(df: DataFrame, by: list[str], col: str, k: int = K) -> DataFrame:
    """One sketch for each group of rows: (``by``, ``col``). Tasks keep k hashes of a group before the shuffle."""
    hashes = df.select(*by, F.explode_outer(col).alias("hash")).groupBy(*by, "hash").agg(F.lit(1).alias("one"))
    order = W.partitionBy(*by).orderBy(F.col("hash").asc_nulls_last())  # null: a group of empty sketches
    ranked = hashes.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    return ranked.groupBy(*by).agg(F.sort_array(F.collect_list("hash")).alias(col))


def written(a: Column) -> Column:
    """A sketch as text: its hashes in hexadecimal."""
    return F.array_join(F.transform(a, lambda h: F.lower(F.hex(h))), ",")


def chunked(rows: DataFrame, groups: int) -> DataFrame:
    """``rows`` (doc_id, text) with the order key (near, tie) and the place ``chunk`` of their group.

    The borders of the groups are quantiles of the ids, so groups are alike in size however ids lie.
    An id that takes up several borders is dealt over as many groups, by the hash that orders its texts.
    """
    rows = rows.select("*", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("near"), F.shiftrightunsigned(F.xxhash64("text"), 1).alias("tie"))
    shares = [i / (groups * groups) for i in range(1, groups * groups)]
    borders = rows.agg(F.percentile_approx("near", shares, 10 * groups * groups).alias("b")).first().b or [0]
    parts = [borders[i : i + groups] for i in range(0, len(borders), groups)]
    longs = lambda values: F.array(*map(F.lit, values)).cast("array<bigint>")
    tops, all_parts = longs([p[0] for p in parts]), F.array(*map(longs, parts))

    def before(below: Callable[[Column], Column]) -> Column:
        top = F.size(F.filter(tops, below))
        return F.when(top == 0, 0).otherwise((top - 1) * groups + F.size(F.filter(F.get(all_parts, top - 1), below)))

    rows = held(rows, low=before(lambda b: b < F.col("near")), high=before(lambda b: b <= F.col("near")))
    chunk = F.col("low") + F.shiftright((F.col("high") - F.col("low")) * F.shiftright("tie", 32), 31)
    return rows.select("doc_id", "text", "near", "tie", chunk.cast("int").alias("chunk"))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, size: int = SHINGLE, groups: int = GROUPS) -> DataFrame:
    """(doc_id, text, sketch, next_text, next_sketch) where the next document is that of the next higher id, the first's after the last.

    Texts are shuffled once, to groups of neighbours, and sketched there, so a document takes over
    the sketch of the next one. The last document of a group takes the first of the next group that
    has any; the list of groups has ``groups`` x ``groups`` rows at most.
    """
    rows = id_text(docs, id_col, text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = chunked(rows, groups)
    # read twice, with the same columns so that one shuffle serves both: all rows, and the first of each group
    dealt = rows.repartition("chunk")
    order = W.partitionBy("chunk").orderBy("near", "doc_id", "tie", "text")
    following = F.lead(F.struct("text", "sketch")).over(order)
    inner = sketch(dealt, "text", "sketch", k, size).select("doc_id", "text", "sketch", "chunk", following.alias("following"))
    firsts = dealt.select("*", F.row_number().over(order).alias("place")).where("place = 1").select("chunk", "text")
    firsts = sketch(firsts, "text", "sketch", k, size).select(F.col("chunk").alias("f_chunk"), F.struct("text", "sketch").alias("first"))
    every = W.orderBy("n_chunk")
    around = every.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    follow = rows.select(F.col("chunk").alias("n_chunk")).distinct()
    follow = follow.select("n_chunk", F.coalesce(F.lag("n_chunk").over(every), F.last("n_chunk").over(around)).alias("l_chunk"))
    firsts = follow.join(firsts, F.col("n_chunk") == F.col("f_chunk")).select("l_chunk", "first")
    found = inner.join(firsts.hint("merge"), F.col("chunk") == F.col("l_chunk"), "left")
    onward = F.coalesce("following", "first")
    return found.select("doc_id", "text", "sketch", onward["text"].alias("next_text"), onward["sketch"].alias("next_sketch"))


def edited_text(text: Column, next_text: Column) -> Column:
    """The text with its last half replaced by as many characters (or all) from the next one's beginning."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substr(text, F.lit(1), F.char_length(text) - half), F.substr(next_text, F.lit(1), half))


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, size: int = SHINGLE) -> DataFrame:
    """(doc_id, text, edited, sketch, edited_sketch, next_sketch) of every document."""
    rows = with_next(docs, id_col, text_col, k, size)
    rows = held(rows, edited=edited_text(F.col("text"), F.col("next_text")))
    return sketch(rows, "edited", "edited_sketch", k, size).drop("next_text")
