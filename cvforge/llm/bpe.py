"""Byte-level BPE: encode whole texts with the ``tokenizers`` library over Arrow batches, and decode.

A rank file (base64 token, rank) becomes a ``tokenizers`` BPE model: every byte is written
as one printable character, tokens are strings of such characters, and each way to put a
token together from two known tokens is a merge with the token's rank. The split pattern
cuts a text first; each match is encoded by itself. Offsets are code points of the input;
a token that holds part of a character has the offsets of the whole character.

Decoding turns ids into their byte strings and joins them, so characters split over tokens
come back whole; ``decoded_text`` replaces bytes that are not UTF-8 (ids cut off within a character).

Null texts are empty and have no ids; null ids decode to no bytes. Rows are independent, so
repeated rows, ties and empty tables need no care, and columns not read do not matter.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from tokenizers import Regex, Tokenizer, decoders, models, pre_tokenizers

from cvforge.llm.common import id_text, slices, texts, tidy


def byte_chars() -> list[str]:
    """The character for each byte: printable Latin-1 for itself, the others from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merges_of(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """All pairs of tokens that join to a token, by the rank of what they join to."""
    return [
        (token[:i], token[i:])
        for token in sorted(ranks, key=ranks.__getitem__)
        for i in range(1, len(token))
        if token[:i] in ranks and token[i:] in ranks
    ]


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> Tokenizer:
    """Tokenizer of a rank file; built once in a Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task for each core already
    ranks, chars = read_ranks(path), byte_chars()
    written = lambda token: "".join(chars[b] for b in token)
    vocab = {written(t): r for t, r in ranks.items()}
    model = models.BPE(vocab=vocab, merges=[(written(a), written(b)) for a, b in merges_of(ranks)], ignore_merges=True, cache_capacity=10_000)
    t = Tokenizer(model)
    t.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    t.decoder = decoders.ByteLevel()
    return t


@lru_cache(maxsize=2)
def token_bytes(path: str) -> list[bytes]:
    """The bytes of each id; decoding needs no tokenizer."""
    ranks = read_ranks(path)
    by_id = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        by_id[rank] = token
    return by_id


#: White space as the split pattern's ``\\s`` has it.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE_RUN = re.compile(f" [{WHITE}]")
#: Patterns that end every match before a single blank; texts are encoded whole by any other.
BY_BLANKS = frozenset({public_tokenizers.PATTERN})


class Segments:
    """Ids of texts by their parts between single blanks.

    A pattern of BY_BLANKS ends every match before a blank that a non-space character follows, so
    a blank and what follows up to the next one encode alike everywhere. Each distinct part goes
    through the tokenizer once while it is remembered; beyond ``most`` parts, those not seen
    since the last change of generation are forgotten. A text with a blank before other white
    space has matches across such borders and is encoded as one.
    """

    def __init__(self, tokenizer: Tokenizer, most: int = 60_000):
        self.tokenizer, self.most, self.known, self.before = tokenizer, most, {}, {}

    def learn(self, parts: set[str]) -> None:
        if len(self.known) > self.most:
            self.before, self.known = self.known, {}
        new = parts - self.known.keys()
        if self.before:
            again = new & self.before.keys()
            self.known.update((p, self.before[p]) for p in again)
            new -= again
        self.known.update(zip(new, self.packed([" " + p for p in new]), strict=True))

    def packed(self, many: list[str]) -> list[bytes]:
        """Ids of each string; in pieces, since the library's results are far larger than the ids."""
        out: list[bytes] = []
        for i in range(0, len(many), 2000):
            found = self.tokenizer.encode_batch_fast(many[i : i + 2000], add_special_tokens=False)
            out += [np.array(e.ids, np.int32).tobytes() for e in found]
        return out

    def encode(self, many: list[str]) -> list[np.ndarray]:
        """The ids of each text; parts are known by what follows their blank."""
        cut = [[t] if SPACE_RUN.search(t) else t.split(" ") for t in many]
        heads = self.packed([parts.pop(0) for parts in cut])
        self.learn(set(chain.from_iterable(cut)))
        return [np.frombuffer(head + b"".join(map(self.known.__getitem__, parts)), np.int32) for head, parts in zip(heads, cut, strict=True)]


def id_lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int32)))


def encoder_of(path: str, pattern: str) -> Callable[[list[str]], list[np.ndarray]]:
    """Ids of each text: by parts if ``pattern`` is known to end its matches before single blanks, else of whole texts."""
    segments = Segments(load(path, pattern))
    if pattern in BY_BLANKS:
        return segments.encode
    return lambda many: [np.frombuffer(x, np.int32) for x in segments.packed(many)]


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", offsets: bool = False) -> DataFrame:
    """(doc_id, ids) of every text, with ``starts`` and ``ends`` of each token if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, encoder = load(path, pattern), encoder_of(path, pattern)
        for batch in slices(batches, limit=1 << 19):
            if not offsets:
                ids = id_lists(encoder(texts(batch)))
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "ids": ids})
                continue
            found = tokenizer.encode_batch(texts(batch), add_special_tokens=False)
            columns = {"doc_id": batch.column("doc_id"), "ids": pa.array([e.ids for e in found], pa.list_(pa.int32()))}
            spans = [e.offsets for e in found]
            for k, name in enumerate(("starts", "ends")):
                columns[name] = pa.array([[s[k] for s in x] for x in spans], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    more = ", starts array<int>, ends array<int>" if offsets else ""
    return id_text(docs, id_col, text_col).mapInArrow(tidy(run), "doc_id long, ids array<int>" + more)


class Decoder:
    """The bytes of lists of ids, from a table of all tokens' bytes."""

    def __init__(self, path: str):
        by_id = token_bytes(path)
        self.table, self.lengths = np.frombuffer(b"".join(by_id), np.uint8), np.array([len(t) for t in by_id], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def decode(self, ids: pa.Array) -> pa.Array:
        flat = ids.flatten().to_numpy(zero_copy_only=False)
        n = self.lengths[flat]
        ends = np.cumsum(n)
        # where each byte of the output stands in the table of all tokens' bytes
        place = np.repeat(self.starts[flat] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)
        cuts = np.cumsum([0, *(x or 0 for x in pa.compute.list_value_length(ids).to_pylist())])
        offsets = np.concatenate([[0], ends])[cuts].astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(offsets), pa.py_buffer(self.table[place])])


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, ids, decoded) with the bytes that the ids stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(path)
        for batch in slices(batches, "ids", 1 << 18):
            ids = batch.column("ids")
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "ids": ids, "decoded": decoder.decode(ids)})

    rows = encoded.select(encoded[id_col].cast("long").alias("doc_id"), encoded[ids_col].cast("array<int>").alias("ids"))
    return rows.mapInArrow(tidy(run), "doc_id long, ids array<int>, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) as ``decode(encode(docs))`` has it, in one pass: one Python worker a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = encoder_of(path, pattern), Decoder(path)
        for batch in slices(batches, limit=1 << 19):
            ids = id_lists(encoder(texts(batch)))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "ids": ids, "decoded": decoder.decode(ids)})

    return id_text(docs, id_col, text_col).mapInArrow(tidy(run), "doc_id long, ids array<int>, decoded binary")


def decoded_text(decoded: bytes) -> str:
    return decoded.decode("utf-8", errors="replace")
