"""The dealt queries against brute-force versions on the small tables, and their operators' building blocks."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from cvforge.llm import bpe, decontam, pii, suffix_dedup
from cvforge.llm.components import components
from cvforge.llm.queries import ORACLES, QUERIES
from cvforge.llm.rolling import Base
from tests.harness import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").orderBy("doc_id").collect()
    return [(r.doc_id, r.text or "", r.lang) for r in rows]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    ok, said = compare(QUERIES[name](spark, SF), duck(SF), ORACLES[name])
    assert ok, said


def test_op1(spark, texts):
    def shingles(t):
        w = re.findall(rb"[^\x20\x09-\x0D]+", t.encode().lower())
        return frozenset(zip(w, w[1:], w[2:])) if len(w) >= 3 else frozenset([tuple(w)]) if w else frozenset()

    sets = {i: shingles(t) for i, t, _ in texts}
    home = {i: i for i in sets}

    def find(x):
        while home[x] != x:
            x = home[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                home[y] = x
    want = {(i, len(s), find(i), find(i) == i) for i, s in sets.items()}
    assert {tuple(r) for r in QUERIES["op1_minhash"](spark, SF).collect()} == want


def test_op2_held_out_accuracy(spark, texts):
    lang = {i: x for i, _, x in texts}
    held = [r for r in QUERIES["op2_langid"](spark, SF).collect() if r.held_out]
    assert {r.doc_id for r in held} == {i for i in lang if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)


def test_op3_as_tiktoken(spark, texts):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sha = lambda x: hashlib.sha256(x).hexdigest()
    want = set()
    for i, t, _ in texts:
        ids = own.encode_ordinary(t)
        want.add((i, len(ids), sha(",".join(map(str, ids)).encode()), sha(t.encode())))
    assert {tuple(r) for r in QUERIES["op3_bpe"](spark, SF).collect()} == want


def test_segments_as_tiktoken():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    segments = bpe.Segments(bpe.load(path, public_tokenizers.PATTERN), most=50)
    draw = random.Random(3)
    for _ in range(3000):
        t = "".join(draw.choice("abc   \n\t'sé日🙂́\x85\xa0\x1c12٣") for _ in range(draw.randrange(30)))
        assert segments.encode([t])[0].tolist() == own.encode_ordinary(t)


def repeats(texts, length=100):
    seen, out = set(), {}
    for i, t in texts:
        b = t.encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if b[k : k + length] in seen:
                gone[k : k + length] = b"\1" * length
            seen.add(b[k : k + length])
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[i] = (i, len(b), len(b) - len(kept), (b"\0" + bytes(gone)).count(b"\0\1"), hashlib.sha256(kept).hexdigest())
    return out


def test_op4(spark, texts):
    want = repeats([(i, t) for i, t, _ in texts])
    assert {tuple(r) for r in QUERIES["op4_suffix_dedup"](spark, SF).collect()} == set(want.values())


@pytest.mark.parametrize("limit", [20_000, 1])
def test_repeats_in_large_and_small_groups(spark, limit):
    draw = random.Random(limit)
    word = lambda: "".join(draw.choice("ab") for _ in range(3))
    passage = " ".join(word() for _ in range(60))
    texts = [(i, " ".join(word() for _ in range(draw.randrange(60))) + passage[draw.randrange(40) : 200] + " ".join(word() for _ in range(20)) + "x" * draw.choice([0, 250])) for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = suffix_dedup.remove_repeats(docs, group_limit=limit).collect()
    assert {(r.doc_id, r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in got} == set(repeats(texts).values())


def test_hash_compared_sort_is_a_sort():
    draw = np.random.default_rng(5)
    data = draw.integers(97, 99, 4000).astype(np.uint8)
    suffix, group = draw.integers(0, 3900, 500), np.sort(draw.integers(0, 4, 500))
    order, same = suffix_dedup.sort_suffixes(data, suffix, group, 20, 3)
    key = lambda i: (group[i], bytes(data[suffix[i] : suffix[i] + 20]))
    assert [key(i) for i in order] == sorted(map(key, range(500)))
    assert [bool(s) for s in same[1:]] == [key(a) == key(b) for a, b in zip(order[:-1], order[1:])]
    assert suffix_dedup.verified(data, suffix, order, same, 20) and not suffix_dedup.verified(data, suffix, order, np.ones(500, bool), 20)


def test_span_hashes_do_not_depend_on_place():
    b, data = Base(9), np.frombuffer(b"abcabcab" * 5, np.uint8)
    sums = b.prefix(data)
    at = np.arange(0, 30)
    found = {}
    for i, h in zip(at, b.span(sums, at, at + 7)):
        assert found.setdefault(bytes(data[i : i + 7]), h) == h
    assert len(set(found.values())) == len(found)


def test_op6(spark, texts):
    def base(t):
        out = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
        out += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
        out += [("card", m) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if pii.is_card(m.group())]
        out += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if pii.is_phone(m.group())]
        return [f"{k}:{m.start()}:{m.end()}" for k, m in out]

    got = {r.doc_id: r for r in QUERIES["op6_pii"](spark, SF).collect()}
    for i, t, _ in texts:
        want = base(t)
        assert got[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(got[i].spans.split(",")) | {""}
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(w.startswith(k) for w in want) for k in pii.KINDS]
    draw = random.Random(1)
    for _ in range(5000):
        t = "".join(draw.choice("aB1.2@-+ ()5_%9é") for _ in range(draw.randrange(40)))
        assert [f"{k}:{a}:{b}" for k, a, b in pii.base_spans(t)] == base(t)


def test_field_recursions_agree():
    number = pii.Numbering()
    lattice = pii.Lattice("x a@b.c 12 y", 2, 10, number)
    weights = np.random.default_rng(2).normal(size=len(number))
    scores = lattice.scores(weights)
    ways = [[]]  # all segmentations, extended segment by segment
    done = []
    while ways:
        way = ways.pop()
        at = lattice.segments[way[-1]][1] if way else 0
        if at == lattice.size:
            done.append(way)
        else:
            ways += [way + [n] for n, s in enumerate(lattice.segments) if s[0] == at]
    best = max(done, key=lambda w: scores[w].sum())
    assert lattice.best(weights) == [(pii.KINDS[k], lattice.edges[i], lattice.edges[j]) for i, j, k in (lattice.segments[n] for n in best) if k >= 0]
    p = np.exp([scores[w].sum() for w in done])
    want = np.zeros(len(scores))
    for w, x in zip(done, p / p.sum()):
        want[w] += x
    assert np.allclose(lattice.marginals(weights), want)


def test_op7(spark, texts):
    def shingles(t):
        w = t.lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())

    like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    def estimate(a, b):
        value = lambda h: int(h, 16) - (1 << 64 if int(h, 16) >> 63 else 0)
        a, b = ({value(h) for h in x.split(",") if h} for x in (a, b))
        union = sorted(a | b)[:256]
        return len(a & b & set(union)) / len(union) if union else 1.0

    got = {r.doc_id: r for r in QUERIES["op7_fingerprints"](spark, SF).collect()}
    for n, (i, t, _) in enumerate(texts):
        onward = texts[(n + 1) % len(texts)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + onward[:half]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert got[i].near_next == pytest.approx(estimate(got[i].fingerprint, got[texts[(n + 1) % len(texts)][0]].fingerprint))
        assert got[i].near_edited == pytest.approx(estimate(got[i].fingerprint, got[i].edited_fingerprint))
        assert len(got[i].fingerprint.split(",")) == max(1, min(256, len(shingles(t))))
        assert abs(got[i].near_edited - like(shingles(t), shingles(edited))) < 0.15
        assert abs(got[i].near_next - like(shingles(t), shingles(onward))) < 0.15


def test_op8_catches_planted_words(spark):
    rows = QUERIES["op8_toxicity"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_wu_manber_finds_what_a_plain_search_finds():
    draw = random.Random(4)
    for _ in range(300):
        words = [draw.choice([b"a", b"b", b"c"]) for _ in range(draw.randrange(40))]
        items = [(k, " ".join(draw.choice("abc") for _ in range(draw.randrange(1, 7)))) for k in range(4)]
        found = decontam.patterns_of(items, 4)
        spans, ids = [], set()
        for t in decontam.tables_of(found):
            t.search(words, spans, ids)
        want = [(i, i + len(p)) for p in found for i in range(len(words) - len(p) + 1) if tuple(words[i : i + len(p)]) == p]
        assert sorted(spans) == sorted(want)


def test_components(spark):
    draw = random.Random(8)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2001 + i) for i in range(50)]
    home = {x: x for e in edges for x in e}
    for _ in range(400):
        for a, b in edges:
            home[a] = home[b] = min(home[a], home[b])
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    alone = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    assert got == {k: v for k, v in home.items() if k not in alone}
