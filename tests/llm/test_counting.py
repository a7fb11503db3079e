"""Exact copies, collocations and the filter audit against brute force, with nulls, ties, repeats and long texts."""

import hashlib
import random
import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from cvforge.llm import collocations as col
from cvforge.llm import filter_audit
from cvforge.llm.exact_dedup import exact_duplicates
from cvforge.llm.common import join_each

SCHEMA = "doc_id long, text string, lang string, content string, digest string, salt int, slot int, n int, part string, mask int, chunk binary"


def table(spark, rows, parts=4):
    return spark.createDataFrame([(*r, *[None] * 8) for r in rows], SCHEMA).repartition(parts)


def lowered(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


@pytest.mark.parametrize("digest", [None, lambda c: F.length(c).cast("string")])
def test_exact_duplicates(spark, digest):
    draw = random.Random(1)
    made = ["", None, "Ab", "aB", "ÀB", "àb", "x" * 300_000, "X" * 300_000, "same words", "Same words", "cd"]
    rows = [(i, made[draw.randrange(len(made))], "en") for i in range(400)] + [(7, "only once", None), (None, "ab", None), (None, None, None)]
    more = {} if digest is None else {"digest": digest}  # lengths: digests that collide
    got = exact_duplicates(table(spark, rows), salts=3, **more).collect()
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(lowered(t), []).append(i)
    want = Counter()
    for t, ids in groups.items():
        last = max(i for i in ids if i is not None)
        sha = hashlib.sha256(t.encode()).hexdigest()
        want.update((i, last, len(ids), i == last, sha) for i in ids)
    assert Counter(map(tuple, got)) == want


def test_exact_duplicates_keep_one_row_each(spark):
    rows = [(None, "gone", "en")] * 50 + [(5, "twice", "en")] * 40 + [(4, "Twice", "en")] * 30
    got = exact_duplicates(table(spark, rows, 7)).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in got if r.kept) == {(None, None, 50): 1, (5, 5, 70): 1}
    assert len(got) == 120 and exact_duplicates(table(spark, rows).limit(0)).count() == 0


def test_join_each_takes_heavy_and_other_keys(spark, monkeypatch):
    monkeypatch.setattr("cvforge.llm.common.HEAVY", 2)
    rows = spark.createDataFrame([(i, k) for i, k in enumerate("aaaaaabbbbcdx")] + [(99, None)], "i long, key string").repartition(5)
    each = spark.createDataFrame([(k, n, v) for k, n, v in (("a", 6, None), ("b", 4, 2), ("c", 1, 3), ("d", 1, None))], "key string, n long, v int")
    got = {(r.i, r.key, r.n, r.v) for r in join_each(rows, each, "key", "n").collect()}
    known = {"a": (6, None), "b": (4, 2), "c": (1, 3), "d": (1, None)}
    assert got == {(i, k, *known.get(k, (None, None))) for i, k in [*enumerate("aaaaaabbbbcdx"), (99, None)]}


def phrases_of(rows, least, share, most, scale):
    """The contract's wording, by lists and dictionaries."""
    out = []
    langs = {"und" if lang is None else lang for _, _, lang in rows}
    for lang in langs:
        f, n = Counter(), 0
        for _, t, x in rows:
            if ("und" if x is None else x) != lang:
                continue
            for piece in re.split(r"[.,;:!?\x0a-\x0d]", lowered(t)):
                w = re.findall(r"[^\x20\x09]+", piece)
                n += len(w)
                f.update(tuple(w[i : i + m]) for m in range(1, 5) for i in range(len(w) - m + 1))
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= share * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in cand.items()):
                continue
            score, _, left, right = min((scale * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:most]):
            out.append((lang, rank + 1, p.decode(), -a, left, right, n, -score))
    return set(out)


@pytest.mark.parametrize("period", [1, 3, 1000])
def test_collocations(spark, period):
    draw = random.Random(period)
    words = ["a", "B", "c", "d'e", "é", "日", "x y", "\x00", "7"]
    text = lambda: "".join(draw.choice(words) + draw.choice([" ", " ", "  ", "\t", ". ", "\n", ",", " ? "]) for _ in range(draw.randrange(60)))
    rows = [(i, text(), draw.choice(["en", "de", None, "und", ""])) for i in range(80)]
    same = text() + " alpha beta gamma delta " + text()
    rows += [(1000 + i, same, "en") for i in range(40)] + [(1, None, "en"), (2, "", "de"), (3, " \t. ", "fr"), (4, "one two " * 3000, "de"), (None, "one two", None)]
    got = {tuple(r) for r in col.collocations(table(spark, rows), least=5, most=60, period=period).collect()}
    assert got == phrases_of(rows, 5, 80, 60, 2_000_000)


def test_collocations_with_a_full_bitmap_and_large_counts(spark, monkeypatch):
    rows = [(i, "one two three four, one two. three four one", "en") for i in range(300)]
    want = phrases_of(rows, 30, 80, 2000, 10**17)
    assert {tuple(r) for r in col.collocations(table(spark, rows), scale=10**17).collect()} == want  # products pass 64 bits
    monkeypatch.setattr(col, "known_bits", lambda *_: col.np.full(1 << (col.BITS - 6), ~col.U(0)))
    assert {tuple(r) for r in col.collocations(table(spark, rows), scale=10**17).collect()} == want
    assert col.collocations(table(spark, rows).limit(0)).count() == 0


def test_chunks_depend_on_words_alone():
    draw = random.Random(3)
    passage = [draw.choice("abcdefgh") for _ in range(400)]
    texts = [" ".join([draw.choice("xyz") for _ in range(draw.randrange(50))] + passage) for _ in range(5)]
    many = [set(c) for c in col.chunks_of(col.words_in(texts), 3, 8)]
    assert len(set.intersection(*many)) > 20
    for t, chunks in zip(texts, col.chunks_of(col.words_in(texts), 3, 8)):
        owned = [w for c in chunks for w in c.split(b" ")[:-3]]
        assert owned == t.encode().split()


def test_filter_audit(spark):
    draw = random.Random(9)
    some = ["", None, "Word " * 250, "a b c " * 100, " ".join(f"w{i}" for i in range(300)), " ".join(f"w{i}" for i in range(300)) + " $", "CAPS " + " ".join(f"é{i}" for i in range(230)), "|"]
    rows = [(i, draw.choice(some), draw.choice(["en", "de", None, ""])) for i in range(150)]
    rows += [(3, "twin", "en"), (3, "twin", "en"), (None, "twin", "en"), (2, "twin", "fr"), (200, "twin", "fr")]
    labels = [(draw.randrange(160), draw.choice([0, 1, None]), draw.choice([0, 1, None]), "x") for _ in range(80)] + [(None, 1, 1, "x")]
    docs = table(spark, rows)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int, part string")
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))

    def fails(i, t):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0d]+", t)
        found = ["A"] * (len(w) < 200) + ["B"] * (100 * len(set(w)) < 50 * len(w)) + ["C"] * (100 * len(re.findall("[A-Z]", t)) > 3 * len(t))
        return found + ["D"] * bool(re.search(r"[#$%&*|]", t)) + ["E"] * (i is not None and i > first[t])

    good, toxic = ({i for i, q, x, _ in labels if i is not None and (q, x)[k] == 1} for k in (0, 1))
    want, total = {}, Counter()
    for part in {p or "" for _, _, p in rows}:
        mine = [(i, fails(i, t)) for i, t, p in rows if (p or "") == part]
        for order in permutations("ABCDE"):
            left = mine
            for k, f in enumerate(order):
                gone, left = [x for x in left if f in x[1]], [x for x in left if f not in x[1]]
                total[part, f] += len(gone)
                failing = sum(f in x[1] for x in mine)
                want[part, "".join(order), k + 1] = (len(left), len(gone), failing - len(gone), sum(x[1] == [f] for x in mine), sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone))
    got = filter_audit.filter_interactions(docs, marks).collect()
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:9] for r in got} == want and len(got) == len(want)
    assert all(r.shapley == total[r.part, r.filter_order[r.step - 1]] for r in got)
    assert filter_audit.filter_interactions(docs.limit(0), marks).count() == 0
    assert {r.good_lost for r in filter_audit.filter_interactions(docs, marks.limit(0)).collect()} == {0}


def test_path_counts_of_all_orders():
    counts = filter_audit.path_counts(5)
    assert len(counts) == 80 and sum(counts.values()) == 120 * 5 and counts[0, 0] == 24 and counts[0b11110, 0] == 24
