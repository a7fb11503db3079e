"""URL filter: longest host/path rule first, else a weighted vocabulary counted with Aho-Corasick.

An Aho-Corasick automaton finds every strict and soft term of the lower-cased URL in one
pass. A hit counts only between boundaries (no letter or digit on either side). One strict
term, or ``soft_limit`` distinct soft terms, block the URL.

Null or scheme-less URLs have an empty host and path, meet no rule, and are judged by the
vocabulary alone (a null URL has no terms and is allowed). Repeated rows are judged one by
one; an empty table gives an empty result; columns other than the two read do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from cvforge.llm.common import ASCII_LOWER, tidy

STRICT_TERMS = ("casino", "porn", "porno", "xxx", "escort", "adult", "spam", "viagra", "warez")
SOFT_TERMS = ("free", "bet", "bets", "win", "poker", "sex", "hot", "cheap", "pills", "loan", "farm", "torrent", "crack", "dating")


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the dealt query.
RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)


def host_path(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    if url is None or (at := url.find("://")) < 0:
        return "", ""
    rest = url[at + 3 :]
    end = min((i for c in "?#" if (i := rest.find(c)) >= 0), default=len(rest))
    slash = rest.find("/", 0, end)
    host = rest[: slash if slash >= 0 else end]
    return host.encode().translate(ASCII_LOWER).decode(), rest[slash:end] if slash >= 0 else ""


def rule_index(rules: tuple[Rule, ...]) -> dict[str, list[Rule]]:
    """Rules by host, the longest first."""
    index: dict[str, list[Rule]] = {}
    for r in sorted(rules, key=lambda r: -len(r.name)):
        index.setdefault(r.host, []).append(r)
    return index


def best_rule(index: dict[str, list[Rule]], host: str, path: str) -> Rule | None:
    """The longest rule for the host or one of its parent domains whose path begins the URL's path."""
    found, domain = [], host
    while domain:
        found += [r for r in index.get(domain, ()) if path.startswith(r.path)][:1]
        _, _, domain = domain.partition(".")
    return max(found, key=lambda r: len(r.name), default=None)


def automaton(strict: tuple[str, ...], soft: tuple[str, ...]) -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for kind, terms in (("soft", soft), ("strict", strict)):
        for t in terms:
            a.add_word(t, (t, kind))
    a.make_automaton()
    return a


def is_word(c: str) -> bool:
    return c.isascii() and c.isalnum()


def term_hits(a: ahocorasick.Automaton, url: str) -> tuple[set[str], set[str]]:
    """Distinct strict and soft terms that stand between boundaries in a lower-cased URL."""
    hits: dict[str, set[str]] = {"strict": set(), "soft": set()}
    for end, (term, kind) in a.iter(url):
        start = end + 1 - len(term)
        if (start == 0 or not is_word(url[start - 1])) and (end + 1 == len(url) or not is_word(url[end + 1])):
            hits[kind].add(term)
    return hits["strict"], hits["soft"]


SCHEMA = "page_id long, host string, path string, rule string, verdict string, n_strict int, n_soft int"


def filter_urls(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: tuple[Rule, ...] = RULES,
    strict: tuple[str, ...] = STRICT_TERMS,
    soft: tuple[str, ...] = SOFT_TERMS,
    soft_limit: int = 2,
) -> DataFrame:
    """Judge every URL; one narrow pass, no shuffle."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, index = automaton(strict, soft), rule_index(rules)
        schema = pa.schema(
            [("page_id", pa.int64()), *((c, pa.string()) for c in ("host", "path", "rule", "verdict")), ("n_strict", pa.int32()), ("n_soft", pa.int32())]
        )
        for batch in batches:
            out = []
            for page_id, url in zip(*batch.to_pydict().values(), strict=True):
                host, path = host_path(url)
                s, w = term_hits(a, (url or "").encode().translate(ASCII_LOWER).decode())
                rule = best_rule(index, host, path)
                verdict = rule.verdict if rule else "block" if s or len(w) >= soft_limit else "allow"
                out.append((page_id, host, path, rule.name if rule else None, verdict, len(s), len(w)))
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema=schema)

    rows = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"))
    return rows.mapInArrow(tidy(judge), SCHEMA)
