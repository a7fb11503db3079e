"""Every operator and pipeline stage on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cvforge.llm import bpe, decontam, fingerprint, langid, minhash, pii, suffix_dedup, toxicity, url_filter, warc
from cvforge.llm.common import fold

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
CLASH = "kept boolean, n int, rep string, sig string, packed string, found string, chunk string, spans string, score string, copy_id string, home string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}"
LONG = " ".join(f"wort{i % 977} stone{i % 83}" for i in range(30_000))


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, "src0", len(t or ""), *[None] * 11) for i, t, lang in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    plain = "the cat sat on the mat and looked at the big dog outside"
    rows = [
        (1, plain, "en"),
        (2, plain, "en"),
        (2, plain, "en"),
        (3, None, "en"),
        (4, "", None),
        (5, "   \n\t ", "en"),
        (6, "12 34 56", "en"),
        (7, "der hund und die katze sind nicht hier aber dort drüben", "de"),
        (8, "der hund und die katze sind nicht hier aber dort oben", "de"),
        (None, plain, None),
        (9, LONG, "en"),
        (10, "x", "en"),
        (11, "mail bob@example.com or +1 (555) 555-0101 now", "en"),
    ]
    return table(spark, rows).cache()


@pytest.fixture(scope="module")
def nothing(spark, docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, "the cat sat on the mat and looked at the big dog outside", None), (1, "the cat sat on the mat and looked at the big dog outside", None), (2, None, None), (3, "drüben", None), (None, "hund", None)]
    return spark.createDataFrame(rows, "item_id long, text string, spans string")


def test_minhash(docs, nothing):
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()}
    assert {(1, 11, 1, True), (2, 11, 1, False), (None, 11, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 1, 6, True), (10, 1, 10, True)} <= got
    assert {r.component_id for r in minhash.near_duplicates(docs).where("doc_id in (7, 8)").collect()} == {7, 8}  # 8 of 10 words alike
    assert minhash.near_duplicates(nothing).count() == 0


def test_langid(docs, nothing):
    profiles = langid.learn(docs)
    got = {r.doc_id: r for r in langid.predict(docs, profiles).collect()}
    assert profiles.langs == ("de", "en")
    assert [got[i].lang_pred for i in (1, 3, 4, 5, 6, 7)] == ["en", "und", "und", "und", "und", "de"]
    assert all(0 <= r.score <= 1 for r in got.values()) and langid.predict(docs, profiles).count() == docs.count()
    empty = langid.learn(nothing)
    assert empty.langs == () and {r.lang_pred for r in langid.predict(docs, empty).collect()} == {"und"}
    assert langid.predict(nothing, profiles).count() == 0


def test_bpe(docs, nothing):
    ids = bpe.encode(docs, PATH, public_tokenizers.PATTERN, offsets=True)
    for r in docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(ids.dropDuplicates(["doc_id"]), "doc_id").collect():
        assert len(r.ids) == len(r.starts) and (not r.ids or r.ends[-1] == len(r.text))
    back = bpe.decode(ids, PATH)
    want = sorted(hashlib.sha256((r.text or "").encode()).hexdigest() for r in docs.collect())
    assert sorted(hashlib.sha256(r.decoded).hexdigest() for r in back.collect()) == want
    fast = bpe.encode(docs, PATH, public_tokenizers.PATTERN).select("ids").collect()
    assert sorted(r.ids for r in fast) == sorted(r.ids for r in ids.collect())
    assert bpe.encode(nothing, PATH, public_tokenizers.PATTERN).count() == 0
    assert bytes(bpe.decode(docs.select(F.lit(1).alias("doc_id"), F.lit(None).cast("array<int>").alias("ids")).limit(1), PATH).first().decoded) == b""


def test_suffix_dedup(spark, docs, nothing):
    got = suffix_dedup.remove_repeats(docs)
    assert got.count() == docs.count() and suffix_dedup.remove_repeats(nothing).count() == 0
    by_id = {r.doc_id: r for r in got.collect()}
    assert by_id[3].n_bytes == 0 and by_id[1].spans == []
    twice = table(spark, [(1, "ab" * 100, None), (1, "ab" * 100, None), (2, "q" + "ab" * 100 + "é" * 10, None)])
    rows = sorted(suffix_dedup.remove_repeats(twice).collect(), key=lambda r: r.doc_id)
    assert [len(r.kept) for r in rows] == [2, 2, 21]


def test_suffix_runs_are_told_apart_by_their_bytes(monkeypatch):
    draw = random.Random(6)
    a, b = draw.randbytes(300), draw.randbytes(300)
    monkeypatch.setattr(suffix_dedup, "mix", np.zeros_like)  # every polynomial hash collides
    r = suffix_dedup.runs_of([a, b, a], 100)
    of = lambda k: {tuple(np.atleast_1d(w)) for w, t in zip(r["whole"], r["text"], strict=True) if t == k}
    assert of(0) and of(0) == of(2) and of(0).isdisjoint(of(1))


def test_decontam(docs, nothing, benchmark):
    got = {r.doc_id: r for r in decontam.find_occurrences(docs, benchmark).collect()}
    assert [(s.start, s.end) for s in got[1].spans] == [(0, 13)] and got[1].items == ["1"]
    assert [(s.start, s.end) for s in got[7].spans] == [(1, 2), (10, 11)] and got[7].items == ["3"]
    assert got[3].n_words == 0 and got[3].spans == [] and got[6].n_words == 3
    blocks = {r.doc_id: r for r in decontam.find_occurrences(docs, benchmark, block_words=1).collect()}
    assert {k: (r.n_words, r.spans, r.items) for k, r in blocks.items()} == {k: (r.n_words, r.spans, r.items) for k, r in got.items()}
    assert decontam.find_occurrences(nothing, benchmark).count() == 0
    assert decontam.find_occurrences(docs, benchmark.limit(0)).where("size(spans) > 0").count() == 0
    assert {r.doc_id for r in decontam.clean(docs, benchmark).collect()} == {3, 4, 5, 6, 9, 10, 11}


def test_pii(docs, nothing):
    weights = pii.learn(docs)
    got = {r.doc_id: r for r in pii.find(docs, weights).collect()}
    assert [(s.kind, s.start, s.end) for s in got[11].base] == [("email", 5, 20), ("phone", 24, 41)]
    assert got[3].base == [] and got[4].added == [] and pii.learn(nothing) == {} and pii.find(nothing, weights).count() == 0
    assert {r.doc_id: r for r in pii.redact(docs, {}, length_col="n_chars").collect()}[11].text == "mail [EMAIL] or [PHONE] now"
    assert pii.redact(docs, {}).columns == docs.columns


def test_fingerprint_neighbours(spark):
    """Ids far apart, in clusters, repeated and null: everyone's next is the next id's, the last one's the first's."""
    draw = random.Random(5)
    ids = [draw.randrange(-(1 << 62), 1 << 62) for _ in range(150)] + [(1 << 40) + i for i in range(60)]
    rows = [(i, f"text {i}") for i in ids] + [(None, f"none {n}") for n in range(120)] + [(77, f"same {n}") for n in range(90)]
    draw.shuffle(rows)
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = fingerprint.with_next(table, groups=8).collect()
    assert sorted(r.text for r in found) == sorted(t for _, t in rows)
    onward = {r.text: r.next_text for r in found}
    way = ["none 0"]
    while len(way) < len(rows):
        way.append(onward[way[-1]])
    assert len(set(way)) == len(rows) and onward[way[-1]] == "none 0"
    place = {t: -(1 << 63) if i is None else i for i, t in rows}
    start = min(range(len(way)), key=lambda n: (place[way[n]], place[way[n - 1]] == place[way[n]]))
    order = [place[t] for t in way[start:] + way[:start]]
    assert order == sorted(order)
    chunks = fingerprint.chunked(table, 8).groupBy("doc_id").agg(F.count_distinct("chunk").alias("n"))
    assert {r.doc_id for r in chunks.where("n > 5").collect()} == {None, 77}
    sketched = {r.text: r.sketch for r in found}
    assert all(r.next_sketch == sketched[r.next_text] for r in found)


def test_fingerprint(spark, docs, nothing):
    rows = fingerprint.compare_with_edits(docs).collect()
    assert len(rows) == docs.count() and fingerprint.compare_with_edits(nothing).count() == 0
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r.text, r.sketch) == r.sketch
    sketches = fingerprint.sketch(docs.select("doc_id", "text", "lang"), "text", "sk", k=64)
    merged = {r.lang: r.sk for r in fingerprint.merge_sketches(sketches, ["lang"], "sk", k=64).collect()}
    for lang, sk in merged.items():
        of = [h for r in sketches.collect() if r.lang == lang for h in r.sk]
        assert sk == sorted(set(of))[:64]
    one = fingerprint.sketch(spark.createDataFrame([(" ".join(map(str, range(5000))),)], "text string"), "text", "sk")
    assert abs(one.select(fingerprint.distinct_count(F.col("sk")).alias("n")).first().n - 4996) < 1000
    assert one.select(fingerprint.containment(F.col("sk"), F.col("sk")).alias("c")).first().c == 1.0


def test_toxicity(spark, docs, nothing):
    bad = [(100 + i, f"you {('stupid', 'moronic')[i % 2]} clown number {i}", "en") for i in range(60)]
    good = [(300 + i, f"we like the garden and the river number {i}", "en") for i in range(60)]
    every = docs.union(table(spark, bad + good))
    labels = spark.createDataFrame([(i, 1, int(i < 300), None) for i, _, _ in bad + good] + [(1, 1, None, None), (None, 1, 1, None)], "doc_id long, quality int, toxic int, text string")
    model = toxicity.learn(every, labels)
    got = {r.doc_id: r.score for r in toxicity.score(every, model).collect()}
    assert min(got[i] for i, _, _ in bad) > max(got[i] for i, _, _ in good) and all(0 <= s <= 1 for s in got.values())
    assert got[3] == got[4] == got[5]
    assert {r.score for r in toxicity.score(docs, toxicity.learn(docs, labels.limit(0))).collect()} == {0.0}
    assert toxicity.score(nothing, model).count() == 0


def test_toxicity_counts_have_no_ceiling(spark):
    # "same" is every tenth word of both classes, of which one is 20 times as large
    words = " ".join("same" if i % 10 == 0 else f"{'xyz'[i % 3]}{i % 7}" for i in range(4000))
    rows = [(i, words if i < 60 else " ".join([words] * 20), "en") for i in range(120)]
    labels = spark.createDataFrame([(i, int(i < 60)) for i, _, _ in rows], "doc_id long, toxic int")
    model = toxicity.learn(table(spark, rows), labels)
    found = toxicity.score(table(spark, [(1000, "same", "en"), (1001, words, "en")]), model).collect()
    assert all(abs(x) < 0.1 for r in found for x in r.evidence)


def test_toxicity_counts_are_exact(spark):
    # 20,000 different units and more bigrams, against counts in dictionaries
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.choice((3, 4, 6, 9))))
    rows = [(i, " ".join(word() for _ in range(400)), "en") for i in range(160)]
    labels = spark.createDataFrame([(i, i % 2) for i, _, _ in rows], "doc_id long, toxic int")
    docs = table(spark, rows)
    counted = {r.doc_id for r in docs.select("doc_id").where(~fold(F.col("doc_id")).isin(2, 3)).collect()}
    pieces = lambda t: [[w[i : i + 3] for i in range(0, len(w), 3)] for w in t.split()]
    pairs_of = lambda t: [(u, (k == 0, w)) for p in pieces(t) for k, w in enumerate(p) for u in [(k == 1, p[k - 1]) if k else 0]]
    n = [Counter(x for i, t, _ in rows if i in counted and i % 2 == c for x in pairs_of(t)) for c in (0, 1)]
    total, follow, heads = [Counter(), Counter()], [Counter(), Counter()], [Counter(), Counter()]
    for c in (0, 1):
        for (u, w), k in n[c].items():
            total[c][u] += k
            follow[c][u] += 1
            heads[c][w] += 1
    types, known = [sum(h.values()) for h in heads], len(heads[0] | heads[1])

    def value(u, w):
        logs = []
        for c in (0, 1):
            shared = 0.99 * (heads[0][w] + heads[1][w]) / sum(types) + 0.01 / (known + 1)
            p = max(heads[c][w] - 0.75, 0) / types[c] + 0.75 * len(heads[c]) / types[c] * shared
            if total[0][u] and total[1][u]:
                p = max(n[c][u, w] - 0.75, 0) / total[c][u] + 0.75 * follow[c][u] / total[c][u] * p
            logs.append(math.log(p))
        return min(max(logs[1] - logs[0], -4), 4)

    got = {r.doc_id: r.evidence[0] for r in toxicity.score(docs, toxicity.learn(docs, labels)).collect()}
    for i, t, _ in rows:
        want = [value(*x) for x in pairs_of(t)]
        assert abs(got[i] - sum(want) / len(want)) < 1e-6


def test_urls(spark):
    urls = ["http://a.example.com/en/x?q=1", "https://WWW.Example.com/en/", "http://com", "http://x.net/es/", "ftp no scheme", None, "http://x.org/casino", "http://x.org/free-bets", "http://x.org/freebets", "http://x.org/free/free", "", "a://b#c/d"]
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(pages).collect()}
    assert got[0] == ("a.example.com", "/en/x", "example.com/en/", "block")
    assert got[1] == ("www.example.com", "/en/", "www.example.com/en/", "allow")
    assert got[2] == ("com", "", None, "allow") and got[3][2:] == ("net/es/", "block") and got[4] == ("", "", None, "allow") and got[5] == ("", "", None, "allow")
    assert [got[i][3] for i in (6, 7, 8, 9)] == ["block", "block", "allow", "allow"] and got[10] == ("", "", None, "allow") and got[11] == ("b", "", None, "allow")
    assert url_filter.filter_urls(pages.limit(0)).count() == 0


def test_warc(spark):
    magic, fake = warc.MAGIC, warc.MAGIC + "WARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    texts = [None, "", "\r\n\r\n" + magic + "\r\n\r\n", "z" * 3000 + magic + "y" * 3000, fake + "é" * 200 + magic, *["same" * 40] * 3, *(f"page {i} " * i + fake * (i % 3) for i in range(40))]
    pages = spark.createDataFrame([(i, h, "x") for i, h in enumerate(texts)] + [(5, "same" * 40, "x"), (None, "same" * 40, "x")], "page_id long, html string, payload string").repartition(2)
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")  # records and magics lie across splits
    try:
        got = warc.archive_round_trip(pages).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    assert len(got) == pages.count()
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    for r in got:
        text = texts[r.page_id] if r.page_id is not None else "same" * 40
        assert (r.payload_bytes, r.payload_digest) == (len((text or "").encode()), sha(text))
        assert (r.record_type, r.refers_to) == (("revisit", 5) if r.page_id in (6, 7, None) else ("response", None))
        assert r.intact
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


def test_warc_holds_whole_records(spark):
    inner = lambda t: warc.MAGIC + f"WARC-Type: response\r\nWARC-Payload-Digest: sha256:{hashlib.sha256(t.encode()).hexdigest()}\r\nContent-Length: {len(t)}\r\n\r\n{t}\r\n\r\n"
    texts = [inner("one") + inner("two") + "after", "before" + inner("one") * 3, inner("one"), "plain"]
    pages = spark.createDataFrame([(i, t, f"http://x.org/{i} \r\n") for i, t in enumerate(texts)], "page_id long, html string, url string")
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.intact) for r in warc.archive_round_trip(pages).collect()}
    assert got == {i: (len(t), hashlib.sha256(t.encode()).hexdigest(), True) for i, t in enumerate(texts)}


def test_warc_damaged(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"page {i} " * 30, "http://x.org/a b" if i else None) for i in range(6)], "page_id long, html string, url string").coalesce(1)

    def written(name, change):
        warc.write_archives(warc.plan_records(pages), str(tmp_path / name))
        (part,) = (tmp_path / name).glob("part-*")
        part.write_bytes(change(part.read_bytes()))
        for crc in (tmp_path / name).glob(".part-*.crc"):
            crc.unlink()
        return str(tmp_path / name)

    sound = written("sound", lambda b: b)
    text = next((tmp_path / "sound").glob("part-*")).read_text(newline="")
    assert text.count("WARC-Date: ") == 6 and text.count("WARC-Target-URI: http://x.org/a%20b\r\n") == 5
    assert [r.intact for r in warc.read_archives(spark, sound).collect()] == [True] * 6
    changed = written("changed", lambda b: b.replace(b"page 3 page 3", b"page 3 pagX 3", 1))
    with pytest.raises(ValueError, match="page 3"):
        warc.read_archives(spark, changed)
    rows = {r.page_id: r for r in warc.read_archives(spark, changed, strict=False).collect()}
    told = hashlib.sha256(("page 3 pagX 3 " + "page 3 " * 28).encode()).hexdigest()
    assert [i for i in rows if not rows[i].intact] == [3] and rows[3].payload_digest == told and rows[3].payload_bytes == 210
    for name, cut in {"tail": lambda b: b[:-50], "head": lambda b: b[20:], "middle": lambda b: b.replace(b"Content-Length: 210", b"Content-Length: 211", 1)}.items():
        with pytest.raises(ValueError, match="damaged archive"):
            warc.read_archives(spark, written(name, cut))


def test_pipeline_stages(spark, docs, nothing, benchmark, tmp_path):
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    now, empty = docs, nothing
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        now, empty = stage(spark, now, str(tmp_path)), stage(spark, empty, str(tmp_path))
        assert empty.count() == 0
        if k < 4:
            assert now.columns == docs.columns == empty.columns
    assert {r.doc_id for r in now.collect()} == {9, 10, 11}
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == {9, 10, 11}


def test_minhash_tells_long_similar_words_apart(spark):
    # a power-of-two polynomial hash of these two words is equal for every odd base
    morse = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
    other = morse.translate(str.maketrans("ab", "ba"))
    rows = [(1, morse, "en"), (2, other, "en"), (3, morse.upper(), "en"), (4, f"{morse} x y z", "en"), (5, f"{other} x y z", "en")]
    got = {r.doc_id: (r.component_id, r.kept) for r in minhash.near_duplicates(table(spark, rows)).collect()}
    assert got == {1: (1, True), 2: (2, True), 3: (1, False), 4: (4, True), 5: (5, True)}


def test_bpe_of_another_pattern_as_tiktoken(spark):
    import tiktoken

    pattern = r"\S+ \S+|\s+|\S+"  # matches span blanks
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})
    many = ["one two three four", "a b", "", "x  y z", "ends here "]
    docs = spark.createDataFrame(list(enumerate(many)), "doc_id long, text string")
    for found in (bpe.encode(docs, PATH, pattern), bpe.round_trip(docs, PATH, pattern)):
        assert {r.doc_id: r.ids for r in found.collect()} == {i: own.encode_ordinary(t) for i, t in enumerate(many)}


def test_language_pieces_of_long_texts(monkeypatch):
    draw = random.Random(2)
    many = ["".join(draw.choice("abß  .1日é") for _ in range(draw.randrange(300))) for _ in range(20)]
    profiles = langid.Profiles(("x", "y"), np.random.default_rng(1).normal(size=(2, 64)).astype(np.float32), 3, 64)
    whole = langid.nearest(many, profiles)
    monkeypatch.setattr(langid, "LONG", 7)
    monkeypatch.setattr(langid, "BLOCK", 5)
    parts = langid.nearest(many, profiles)
    assert whole[0] == parts[0] and whole[2] == parts[2] and np.allclose(whole[1], parts[1], atol=1e-5)
    assert whole[2] == langid.grams_in(many, 3).tolist()


def test_language_memory_is_bounded():
    import resource

    draw = np.random.default_rng(4)
    text = "".join(map(chr, draw.integers(0x4E00, 0x7000, 300_000)))
    profiles = langid.Profiles(("x",), np.ones((1, 1024), np.float32), 3, 1024)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    assert langid.nearest([text, "abc"], profiles)[2][0] == 300_000
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 400_000  # kilobytes


def test_a_left_out_language_is_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    for out in ("de", "es"):
        learning = docs.where((F.col("lang") != out) & (fold(F.col("doc_id")) != 2))
        profiles = langid.learn(learning)
        least = langid.least_cosines(learning, profiles, 100)
        stays = {r.doc_id for r in langid.accepted(docs, profiles, least, 100).collect()}
        of = lambda lang: {r.doc_id for r in docs.where(lang).collect()}
        foreign, own = of(F.col("lang") == out), of(F.col("lang") != out)
        assert len(stays & foreign) < 0.2 * len(foreign) and len(stays & own) > 0.99 * len(own)


def test_pipeline_keeps_one_of_rows_without_or_with_one_id(spark):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(None, text, "en"), (None, text, "en"), (None, "another text without an id", "en"), (8, "twice the same row", "en"), (8, "twice the same row", "en"), (8, "and other words", "en")]
    got = corpus_pipeline.keep_one_of_copies(spark, table(spark, rows).cache(), "").collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(set((i, t) for i, t, _ in rows))
