"""Secret scans through a trigram index.

Every rule is a regular expression. From its parse tree a Boolean query over trigrams
is derived that each text with a match must satisfy. The trigrams that occur in some
query are indexed for a slice of texts at a time (a text's lower-cased bytes, so that
one index serves rules that ignore case); postings are intersected and united as the
query says, and only the texts left are searched with the rule itself. A rule without
mandatory trigrams searches every text.

Defined results: null and empty texts have no spans; repeated rows are searched one by
one; spans of different rules may overlap; an empty table gives an empty result; kept
columns named like a new one give way to it. Texts are searched whole, a few MB at a time
and one text at least, so memory grows with the longest text only.

The parse tree is that of Python's own regular expressions, from the modules in which
CPython keeps it since version 3.11.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from spintally.llm import ragged, spans
from spintally.llm.rows import map_texts

try:
    from re import _constants as sre
    from re import _parser as sre_parser
except ImportError as missing:
    raise ImportError("secret scans need the parse trees of CPython 3.11 or later") from missing

#: Largest set of strings that a part of a rule is followed through exactly.
EXACT_LIMIT = 48
#: Largest character class that counts as a set of letters.
CLASS_LIMIT = 8

#: A query is True (any text), a trigram, ("and", {queries}) or ("or", {queries}).
Query = bool | bytes | tuple[str, frozenset]


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, and what a match must fulfil to count."""

    kind: str
    pattern: str
    accept: Callable[[re.Match], bool] | None = None
    ignore_case: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.ignore_case else 0))


def long_value(match: re.Match) -> bool:
    return len(match[2]) >= 8


def long_key(match: re.Match) -> bool:
    return len(match[0]) >= 16


BASE_RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        long_value,
        ignore_case=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", long_key),
    Rule("hex", r"[0-9a-f]{32,}"),  # a maximal run, as shorter runs are dropped
)
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule(  # to the END line, over header and base64 lines; the BEGIN line alone without one
        "pem",
        r"-----BEGIN ((?:RSA |EC |DSA |OPENSSH |ENCRYPTED |PGP )?PRIVATE KEY(?: BLOCK)?)-----"
        r"(?:\s*+(?:[A-Za-z][A-Za-z-]*+:(?:[^\r\n-]|-(?!----))*+\s*+)*+"
        r"[A-Za-z0-9+/=\s\\]*+-----END \1-----)?+",
    ),
    Rule("login", r"://[A-Za-z0-9._%+-]++:[^\s:/@]++@"),
)
RULES = BASE_RULES + MORE_RULES


def both(a: Query, b: Query) -> Query:
    if a is True or a == b:
        return b
    return a if b is True else ("and", frozenset([a, b]))


def either(queries: list[Query]) -> Query:
    if any(q is True for q in queries):
        return True
    return queries[0] if len(set(queries)) == 1 else ("or", frozenset(queries))


def of_strings(strings: set[str]) -> Query:
    """Any of the strings occurs: all trigrams of one of them; True if one is too short."""
    options = []
    for text in strings:
        raw = text.encode()
        query: Query = True
        for i in range(len(raw) - 2):
            query = both(query, raw[i : i + 3])
        options.append(query)
    return either(options) if options else True


def letters(members: list) -> set[str] | None:
    """The lower-cased characters of a class, if they are few."""
    found: set[str] = set()
    for op, value in members:
        if op is sre.LITERAL:
            found.add(chr(value).lower())
        elif op is sre.RANGE and value[1] - value[0] < CLASS_LIMIT:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found if len(found) <= CLASS_LIMIT else None


def analysed(node) -> tuple[set[str] | None, Query]:
    """The strings a parse tree stands for, if they are few, and else a query they satisfy."""
    exact: set[str] | None = {""}  # the strings since the last part that is not exact
    whole, query = True, True
    for op, value in node:
        part, own = element(op, value)
        if part is not None and len(exact) * len(part) <= EXACT_LIMIT:
            exact = {a + b for a in exact for b in part}
            continue
        whole = False
        query = both(query, of_strings(exact))
        query = both(query, own)
        exact = part if part is not None else {""}
    if whole:
        return exact, of_strings(exact)
    return None, both(query, of_strings(exact))


def element(op, value) -> tuple[set[str] | None, Query]:
    if op is sre.LITERAL:
        return {chr(value).lower()}, True
    if op is sre.IN:
        return letters(value), True
    if op is sre.AT:
        return {""}, True
    if op is sre.SUBPATTERN:
        return analysed(value[3])
    if op is sre.BRANCH:
        parts = [analysed(branch) for branch in value[1]]
        if all(p is not None for p, _ in parts) and sum(len(p) for p, _ in parts) <= EXACT_LIMIT:
            union = set().union(*(p for p, _ in parts))
            return union, of_strings(union)
        return None, either([q for _, q in parts])
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
        low, high, inner = value
        part, query = analysed(inner)
        if low == 0:
            if high == 1 and part is not None:
                return part | {""}, True
            return None, True
        if low == high == 1:
            return part, query
        return None, query
    return None, True


@lru_cache(maxsize=256)
def trigram_query(pattern: str) -> Query:
    """What the trigrams of the lower-cased text must fulfil for the pattern to match in it."""
    return analysed(sre_parser.parse(pattern))[1]


def trigrams(query: Query) -> set[bytes]:
    if isinstance(query, bytes):
        return {query}
    return set() if query is True else set().union(*map(trigrams, query[1]))


class TrigramIndex:
    """Postings of wanted trigrams: the rows of a slice of texts in which each occurs."""

    def __init__(self, texts: list[bytes], wanted: frozenset[bytes]):
        bounds = ragged.offsets_of(np.fromiter(map(len, texts), np.int64, len(texts)))
        data = np.frombuffer(b"".join(texts).lower(), np.uint8).astype(np.int32)
        self.rows = np.arange(len(texts))
        self.postings: dict[bytes, np.ndarray] = {}
        if len(data) < 3:
            return
        codes = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
        at = np.flatnonzero(wanted_codes(wanted)[codes])
        row = np.searchsorted(bounds, at, "right") - 1
        inside = at + 2 < bounds[row + 1]
        pairs = np.unique(codes[at[inside]].astype(np.int64) * len(texts) + row[inside])
        found, rows = np.divmod(pairs, len(texts))
        edges = np.flatnonzero(np.diff(found, prepend=-1))
        for begin, end in zip(edges, np.append(edges[1:], len(found))):
            self.postings[int(found[begin]).to_bytes(3, "big")] = rows[begin:end]

    def candidates(self, query: Query) -> np.ndarray:
        if query is True:
            return self.rows
        if isinstance(query, bytes):
            return self.postings.get(query, self.rows[:0])
        parts = sorted((self.candidates(q) for q in query[1]), key=len)
        join = np.intersect1d if query[0] == "and" else np.union1d
        out = parts[0]
        for part in parts[1:]:
            out = join(out, part)
        return out


@lru_cache(maxsize=4)
def wanted_codes(wanted: frozenset[bytes]) -> np.ndarray:
    table = np.zeros(1 << 24, bool)
    table[[int.from_bytes(t, "big") for t in wanted]] = True
    return table


def scan(texts: list[str], rules: tuple[Rule, ...] = RULES) -> list[list[spans.Span]]:
    """Spans of every text by start, then by the rules' order."""
    queries = [trigram_query(rule.pattern) for rule in rules]
    wanted = frozenset(set().union(*map(trigrams, queries)))
    index = TrigramIndex([text.encode("utf-8", "replace") for text in texts], wanted)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for order, (rule, query) in enumerate(zip(rules, queries)):
        search = rule.compiled().finditer
        for row in index.candidates(query).tolist():
            for match in search(texts[row]):
                if rule.accept is None or rule.accept(match):
                    found[row].append((match.start(), order, match.end()))
    return [[(rules[o].kind, a, b) for a, o, b in sorted(spans)] for spans in found]


def find_secrets(
    docs: DataFrame,
    text_col: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """``keep`` columns and ``spans`` of all kinds, one row per input row."""

    def compute(texts):
        return [spans.column(scan(texts, rules))]

    return map_texts(docs, compute, f"spans {spans.FIELD}", text_col, keep)
