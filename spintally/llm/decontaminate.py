"""Benchmark decontamination by template windows and slot consistency.

Texts become templates: numbers, names and units turn into typed placeholders, and
what stood there is kept as the slot's value. Windows of ``WINDOW`` template tokens
are hashed and joined between documents and benchmark items, so that a question with
other numbers or names meets its original. A pair counts if the document has most of
the item's windows, or if the windows it has hold most of the item's tokens (one changed
word costs up to five windows, but one token), and if each slot value of the item is
replaced by one and the same value throughout: unrelated texts that share a template fill
it at random. One number may stand in several roles, as in "5 apples and 5 pears", and each
role has a replacement of its own; its role are the words next to it on either side, a name
for any name.
A name or unit means the same wherever it stands and has one replacement.

Windows of documents go through a Bloom filter of the benchmark's windows before they are
joined. Its size is fixed, whatever the benchmark's, and the join that follows is exact.
Pairs are counted by their windows first; slot values are compared only for the pairs
whose windows suffice, so that a stock phrase in many items and documents stays cheap.

Tokens: a number with inner separators; a currency or percent sign, or a unit right
after a number; a name; any other word, lower-cased. Line breaks and ``.!?`` end
sentences and are no tokens. Neighbouring capitalised words form one name.
Texts of the characters of ``CODEC`` are cut as bytes, all of a slice at once; the others
one by one by a pattern. Both give the same tokens, kinds and hashes.

Whether a capitalised word is a name cannot be told from the word, so that every text is
read in several ways, and a pair counts if it does by one of them. Names are the words of
one capital and small letters inside a sentence (``INSIDE``); all words with a capital,
so that a name that starts a sentence or is written McDonald may be replaced too
(``ANYWHERE``: windows with a plain word only, none of texts shorter than a window); no
words, so that copies in capitals or small letters meet their original (``NOWHERE``).

Defined results: null, empty and blank texts have no windows and match nothing; a text
of fewer tokens than a window is one window of its own length; rows with equal id and
text are one document; null ids are kept apart by their texts; empty tables on either
side give no pairs.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spintally.llm import ragged
from spintally.llm.pretokens import SETTLED, is_early, ranges
from spintally.llm.rows import map_texts
from spintally.llm.tables import saved

WINDOW = 5
#: Least share of an item's windows that a document must have.
MIN_COVERAGE = 0.8
#: Or else: least share of an item's tokens that lie in such windows, and their least number.
MIN_COVERED = 0.6
MIN_COVERED_TOKENS = 8
#: Windows of mostly placeholders meet by chance; for that share a window counts if it has so
#: few slots, or if it stands among so many consecutive windows that match.
FEW_SLOTS = 1
LONG_RUN = 4
#: Least share of an item's matched slots whose values are replaced alike throughout.
MIN_CONSISTENCY = 0.8
#: Bits of the filter that is sent to the tasks, as a power of two (8 MB), and its probes. Up to
#: 5 million benchmark windows, it lets one in a hundred others through; more windows, more others.
FILTER_POWER = 26
PROBES = 4

LETTER = r"[^\W\d_]"
DIGIT = r"\d"
TOKEN = "L+(?:['’]L+)*|D+(?:[.,:/]D+)*|[$€£¥%]|[.!?\n]"
#: Tokens that a worker remembers before it starts anew.
MEMO_TOKENS = 300_000
#: One byte a character; a token has one hash, by these bytes if it has them, by UTF-8 if not.
CODEC = "cp1252"
#: Tokens of more bytes are hashed one by one.
LONG_TOKEN = 64
# Fixed values.
SIGNS = set("$€£¥%")
BREAKS = set(".!?\n")
UNITS = {
    "mm", "cm", "m", "km", "in", "inch", "inches", "ft", "feet", "foot", "yd", "yard", "yards", "mile",
    "miles", "mg", "g", "kg", "t", "ton", "tons", "lb", "lbs", "oz", "pound", "pounds", "ml", "l",
    "liter", "liters", "litre", "litres", "gallon", "gallons", "s", "sec", "second", "seconds", "min",
    "minute", "minutes", "h", "hour", "hours", "day", "days", "week", "weeks", "month", "months",
    "year", "years", "usd", "eur", "dollar", "dollars", "euro", "euros", "cent", "cents", "percent",
    "degree", "degrees", "meter", "meters", "metre", "metres", "kilometer", "kilometers", "gram",
    "grams", "kilogram", "kilograms", "mph", "kmh", "hz", "kb", "mb", "gb", "w", "kw", "v", "a",
}
PLAIN, NUMBER, SIGN, UNIT, TITLE, BREAK, CAPITAL = range(7)
#: Ways to read a text, by where names stand; windows of different readings never meet.
INSIDE, ANYWHERE, NOWHERE = READINGS = range(3)
#: Placeholders by type, as hashed in place of what they stand for.
PLACEHOLDERS = {NUMBER: "<number>", UNIT: "<unit>", TITLE: "<name>"}


@lru_cache(maxsize=1)
def finders() -> tuple[Callable, Callable]:
    """Token search for texts below ``SETTLED``, with the classes written out, and for others."""

    def early(pattern):
        points = [c for c in range(SETTLED) if re.match(pattern, chr(c))]
        return f"[{ranges(points)}]"

    made = [
        re.compile(TOKEN.replace("L", letter).replace("D", digit))
        for letter, digit in ((early(LETTER), early(DIGIT)), (LETTER, DIGIT))
    ]
    return made[0].findall, made[1].findall


class TokenTable:
    """Kinds and hashes of the tokens a worker has met; starts anew once there are many."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.kinds, self.hashes = np.zeros(0, np.int8), np.zeros(0, np.uint64)

    def of(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.place) >= MEMO_TOKENS:
            self.clear()
        at = np.fromiter(map(self.place.get, tokens, repeat(-1)), np.int64, len(tokens))
        missed = np.flatnonzero(at < 0)
        if len(missed):
            new = [tokens[i] for i in missed.tolist()]
            at[missed] = np.arange(len(self.kinds), len(self.kinds) + len(new))
            self.place.update(zip(new, at[missed].tolist()))
            self.kinds = np.append(self.kinds, np.array(list(map(kind_of, new)), np.int8))
            self.hashes = np.append(self.hashes, hashes_of(new))
        return self.kinds[at], self.hashes[at]


@lru_cache(maxsize=1)
def token_table() -> TokenTable:
    return TokenTable()


def kind_of(token: str) -> int:
    """What a token can be by itself."""
    first, lower = token[0], token.lower()
    if token in BREAKS:
        return BREAK
    if first.isdigit():
        return NUMBER
    if token in SIGNS:
        return SIGN
    if lower in UNITS:
        return UNIT
    if first.isupper():
        return TITLE if len(token) > 1 and token[1:].islower() else CAPITAL
    return PLAIN


MIX, MIX_AGAIN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
#: By length, the bits of a word of eight bytes that hold the first so many bytes.
HELD = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def stirred(total: np.ndarray, held: np.ndarray) -> np.ndarray:
    """``total`` with one more word each; different words give different results."""
    total = (total ^ held) * MIX
    total ^= total >> np.uint64(29)
    total *= MIX_AGAIN
    total ^= total >> np.uint64(32)
    return total


def byte_hashes(data: bytes, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hashes of the pieces of ``data`` at ``starts``, eight bytes of all pieces at a time."""
    words = np.ndarray(len(data) + 1, "<u8", data + bytes(8), strides=(1,))
    out = stirred(lengths.astype(np.uint64), words[starts] & HELD[np.minimum(lengths, 8)])
    left = np.flatnonzero((lengths > 8) & (lengths <= LONG_TOKEN))
    done = 8
    while len(left):
        held = words[starts[left] + done] & HELD[np.minimum(lengths[left] - done, 8)]
        out[left] = stirred(out[left], held)
        done += 8
        left = left[lengths[left] > done]
    for i in np.flatnonzero(lengths > LONG_TOKEN).tolist():
        begin = int(starts[i])
        out[i] = xxhash.xxh64_intdigest(data[begin : begin + int(lengths[i])])
    return out


def hashes_of(tokens: list[str]) -> np.ndarray:
    """Hashes of the lower-cased tokens."""
    out = np.zeros(len(tokens), np.uint64)
    rows, held = [], []
    for row, token in enumerate(tokens):
        lower = token.lower()
        try:
            held.append(lower.encode(CODEC))
            rows.append(row)
        except UnicodeEncodeError:
            out[row] = xxhash.xxh64_intdigest(lower)
    lengths = np.array([len(x) for x in held], np.int64)
    out[rows] = byte_hashes(b"".join(held), ragged.offsets_of(lengths)[:-1], lengths)
    return out


PLACEHOLDER_HASH = np.zeros(7, np.uint64)
for _kind, _name in PLACEHOLDERS.items():
    PLACEHOLDER_HASH[_kind] = xxhash.xxh64_intdigest(_name)
PLACEHOLDER_HASH[SIGN] = PLACEHOLDER_HASH[UNIT]


class Tokens:
    """The tokens of texts, one text after the other."""

    def __init__(self, kinds: np.ndarray, hashes: np.ndarray, counts: np.ndarray):
        self.kinds, self.hashes, self.n_texts = kinds, hashes, len(counts)
        self.text = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        self.starts = ragged.offsets_of(counts)[:-1][counts > 0]
        self.before = np.append(np.int8(BREAK), self.kinds[:-1])[: len(self.kinds)]
        self.before[self.starts] = BREAK

    def piece(self, at: int) -> str:
        raise NotImplementedError


class FoundTokens(Tokens):
    """Tokens of any texts, by the pattern."""

    def __init__(self, texts: list[str]):
        pieces: list[str] = []
        counts = np.zeros(len(texts), np.int64)
        early, other = finders()
        for row, text in enumerate(texts):
            found = (early if is_early(text) else other)(text)
            counts[row] = len(found)
            pieces += found
        self._distinct, self._which = ragged.distinct(pieces)
        kinds, hashes = (column[self._which] for column in token_table().of(self._distinct))
        super().__init__(kinds, hashes, counts)

    def piece(self, at: int) -> str:
        return self._distinct[self._which[at]]


OTHER, LETTERS, DIGITS, SINGLE, IN_WORD, IN_NUMBER, POINT = range(7)


class ByteTables:
    """By byte of ``CODEC``: what it is in a token, its small letter, its case, the kind it begins."""

    def __init__(self):
        points = [bytes([byte]).decode(CODEC, "ignore") or "\0" for byte in range(256)]
        self.classes = bytes(map(self.class_of, points))
        self.lower = b"".join(c.lower().encode(CODEC) for c in points)
        self.is_lower = np.array([c.islower() for c in points])
        self.is_upper = bytes(c.isupper() for c in points)
        self.begins = np.array([CAPITAL if c.isupper() else kind_of(c) for c in points], np.int8)
        self.begins[self.begins == UNIT] = PLAIN
        self.units = np.sort(hashes_of(sorted(UNITS)))
        self.maybe_unit = np.zeros(1 << 12, bool)
        self.maybe_unit[self.units >> np.uint64(52)] = True

    @staticmethod
    def class_of(c: str) -> int:
        if re.match(LETTER, c):
            return LETTERS
        if re.match(DIGIT, c):
            return DIGITS
        if c == ".":
            return POINT
        if c in SIGNS or c in BREAKS:
            return SINGLE
        return IN_WORD if c in "'’" else IN_NUMBER if c in ",:/" else OTHER


@lru_cache(maxsize=1)
def byte_tables() -> ByteTables:
    return ByteTables()


class ByteTokens(Tokens):
    """Tokens of texts in ``CODEC``, the same as by the pattern.

    Letters in a row form a token, and so do digits. An apostrophe between two letters or one
    of ``.,:/`` between two digits belongs to them; no piece can begin with one.
    """

    def __init__(self, texts: list[bytes]):
        tables = byte_tables()
        data = b"\0" + b"\0".join(texts) + b"\0"
        run = np.frombuffer(bytearray(data.translate(tables.classes)), np.uint8)
        inner = np.flatnonzero(run >= IN_WORD)
        kind = run[inner]
        around = np.where(run[inner - 1] == run[inner + 1], run[inner - 1], OTHER)
        joins = around == np.where(kind == IN_WORD, LETTERS, DIGITS)
        run[inner] = np.where(joins, around, np.where(kind == POINT, SINGLE, OTHER))
        single, differs = run == SINGLE, run[1:] != run[:-1]
        within = run != OTHER
        begins, ends = within & single, within & single
        begins[1:] |= within[1:] & differs
        ends[:-1] |= within[:-1] & differs
        starts, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        lengths = ends - starts
        hashes = byte_hashes(data.translate(tables.lower), starts, lengths)

        octets = np.frombuffer(data, np.uint8)
        kinds = tables.begins[octets[starts]]
        upper = np.frombuffer(data.translate(tables.is_upper), bool)
        inside = np.searchsorted(starts, np.flatnonzero(upper & ~begins), "right") - 1
        small = (kinds == CAPITAL) & (lengths > 1)
        small[inside] = False
        small = np.flatnonzero(small)
        told = tables.is_lower[octets[starts[small] + 1]]
        kinds[small[told]] = TITLE
        for at in small[~told].tolist():
            kinds[at] = kind_of(data[starts[at] : ends[at]].decode(CODEC))
        maybe = np.flatnonzero(tables.maybe_unit[hashes >> np.uint64(52)])
        kinds[maybe[np.isin(hashes[maybe], tables.units)]] = UNIT

        sizes = np.array([len(text) + 1 for text in texts], np.int64)
        counts = np.diff(np.searchsorted(starts, 1 + ragged.offsets_of(sizes)))
        super().__init__(kinds, hashes, counts)
        self._data, self._begins, self._ends = data, starts, ends

    def piece(self, at: int) -> str:
        return self._data[self._begins[at] : self._ends[at]].decode(CODEC)


def tokens_of(texts: list[str]) -> list[tuple[Tokens, np.ndarray]]:
    """The tokens of all texts in two parts, each with the numbers of its texts."""
    coded, others = ([], []), ([], [])
    for row, text in enumerate(texts):
        try:
            coded[0].append(text.encode(CODEC))
            coded[1].append(row)
        except UnicodeEncodeError:
            others[0].append(text)
            others[1].append(row)
    parts = ((ByteTokens, coded), (FoundTokens, others))
    return [(made(held), np.array(rows, np.int64)) for made, (held, rows) in parts if rows]


class Templates:
    """The template tokens of a slice of texts by one reading, one text after the other."""

    def __init__(self, tokens: Tokens, reading: int):
        kinds, before = tokens.kinds, tokens.before
        slot = kinds.copy()
        if reading == INSIDE:
            slot[(kinds == TITLE) & (before == BREAK)] = PLAIN
        slot[kinds == CAPITAL] = TITLE if reading == ANYWHERE else PLAIN
        if reading == NOWHERE:
            slot[kinds == TITLE] = PLAIN
        slot[(kinds == UNIT) & (before != NUMBER)] = PLAIN
        named = slot == TITLE
        goes_on = named & np.append(False, named[:-1])[: len(named)]
        goes_on[tokens.starts] = False
        keep = np.flatnonzero((kinds != BREAK) & ~goes_on)
        self.reading = reading
        self.slot, self.text = slot[keep], tokens.text[keep]
        self.hash = np.where(
            self.slot == PLAIN, tokens.hashes[keep], PLACEHOLDER_HASH[self.slot]
        )
        self.counts = np.bincount(self.text, minlength=tokens.n_texts)
        self.bounds = ragged.offsets_of(self.counts)
        self._piece, self._keep, self._goes_on = tokens.piece, keep, goes_on

    def beside(self, place: int, step: int) -> str:
        """The next word of the same text before (-1) or after (1) a slot, or nothing.

        A name stands for any name; numbers and units are passed over.
        """
        at, text = place + step, self.text[place]
        while 0 <= at < len(self.slot) and self.text[at] == text:
            if self.slot[at] == PLAIN:
                return self.value(at)
            if self.slot[at] == TITLE:
                return PLACEHOLDERS[TITLE]
            at += step
        return ""

    def key(self, place: int) -> str:
        """A slot's value, a number's with its role."""
        if self.slot[place] != NUMBER:
            return self.value(place)
        return " ".join([self.value(place), self.beside(place, -1), "_", self.beside(place, 1)])

    def value(self, place: int) -> str:
        """What stands in a slot, a name with all its words."""
        at = int(self._keep[place])
        words = [self._piece(at)]
        while at + 1 < len(self._goes_on) and self._goes_on[at + 1]:
            at += 1
            words.append(self._piece(at))
        return " ".join(words).lower()

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and hash of every window and their number by text; a shorter text is one window."""
        n = max(len(self.hash) - size + 1, 0)
        whole = self.text[:n] == self.text[size - 1 :][:n]
        if self.reading == ANYWHERE:
            plain = self.slot == PLAIN
            told = np.zeros(n, bool)
            for step in range(size):
                told |= plain[step:][:n]
            whole &= told
        total = np.full(n, self.salt(size))
        for step in range(size):
            total = woven(total, self.hash[step:][:n])
        starts, total = np.flatnonzero(whole), total[whole]
        own = np.bincount(self.text[:n][whole], minlength=len(self.counts))
        short = np.flatnonzero((self.counts > 0) & (self.counts < size))
        if len(short) and self.reading != ANYWHERE:
            own[short] = 1
            begins, lengths = self.bounds[short], self.counts[short]
            few = self.salt(lengths)
            for step in range(size - 1):
                inside = np.flatnonzero(step < lengths)
                few[inside] = woven(few[inside], self.hash[begins[inside] + step])
            starts, total = np.append(starts, begins), np.append(total, few)
        return starts, total.view(np.int64), own

    def salt(self, length):
        """What the hash of a window of so many tokens begins with."""
        return np.asarray(length + (self.reading << 32)).astype(np.uint64) * MIX


def woven(total: np.ndarray, held: np.ndarray) -> np.ndarray:
    """The hashes ``total`` of windows with the next token of each."""
    total = (total ^ held) * MIX
    total ^= total >> np.uint64(29)
    return total


WINDOW_FIELDS = (
    "n_all long, windows array<struct<reading:int,n_windows:long,n_tokens:long,hash:long,"
    "place:int,slots:array<string>>>"
)
WINDOW_TYPE = pa.list_(
    pa.struct(
        [
            ("reading", pa.int32()),
            ("n_windows", pa.int64()),
            ("n_tokens", pa.int64()),
            ("hash", pa.int64()),
            ("place", pa.int32()),
            ("slots", pa.list_(pa.string())),
        ]
    )
)


class Filter:
    """A Bloom filter over window hashes, as words of 64 bits."""

    def __init__(self, words: np.ndarray, power: int):
        self.words, self.power = words, power

    def among(self, hashes: np.ndarray) -> np.ndarray:
        """Where in ``hashes`` one stands that the filter does not rule out."""
        plain = hashes.view(np.uint64)
        bit = plain & np.uint64(0xFFFFFFFF)
        left = np.flatnonzero(self.holds(bit))
        bit, step = bit[left], (plain[left] >> np.uint64(32)) | np.uint64(1)
        for _ in range(1, PROBES):
            bit = bit + step
            held = self.holds(bit)
            left, bit, step = left[held], bit[held], step[held]
        return left

    def holds(self, bit: np.ndarray) -> np.ndarray:
        """Whether bits are set, counted round the filter."""
        bit = bit & np.uint64((1 << self.power) - 1)
        held = self.words[(bit >> np.uint64(6)).view(np.int64)] >> (bit & np.uint64(63))
        return (held & np.uint64(1)).astype(bool)


def filter_of(hashes: DataFrame, power: int) -> Filter:
    """The filter of a column ``hash``; the driver gets its words, whose number ``power`` bounds."""
    first = F.col("hash").bitwiseAND(F.lit(0xFFFFFFFF))
    step = F.shiftrightunsigned("hash", 32).bitwiseOR(F.lit(1))
    mask = F.lit((1 << power) - 1)
    bits = F.array(*[(first + step * probe).bitwiseAND(mask) for probe in range(PROBES)])
    words = (
        hashes.select(F.explode(bits).alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("place"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("word"))
    ).toPandas()
    out = np.zeros(max(1, 1 << (power - 6)), np.int64)
    out[words["place"].to_numpy(np.int64)] = words["word"].to_numpy(np.int64)
    return Filter(out.view(np.uint64), power)


def windows_of(
    texts: list[str], size: int, asked: Filter | np.ndarray | None
) -> list[pa.Array]:
    """Number of windows of each text by all readings, and those that pass a filter.

    The hashes themselves may be given for a filter. Without either all windows are given,
    their slots with roles, as for benchmark items.
    """
    totals = np.zeros(len(texts), np.int64)
    out: list[list[dict]] = [[] for _ in texts]
    seen: set[tuple] = set()
    for tokens, rows in tokens_of(texts):
        for reading in READINGS:
            templates = Templates(tokens, reading)
            starts, hashes, own = templates.windows(size)
            totals[rows] += own
            if asked is None:
                picked = np.arange(len(starts))
            elif isinstance(asked, np.ndarray):
                picked = np.flatnonzero(np.isin(hashes, asked))
            else:
                picked = asked.among(hashes)
            for at in picked.tolist():
                begin = int(starts[at])
                text = int(templates.text[begin])
                row, n_tokens = int(rows[text]), int(templates.counts[text])
                slots = [
                    templates.key(place) if asked is None else templates.value(place)
                    for place in range(begin, begin + min(n_tokens, size))
                    if templates.slot[place] != PLAIN
                ]
                key = (row, int(hashes[at]), tuple(slots))
                if asked is not None and key in seen:
                    continue  # a document that repeats a filled window says nothing new by it
                seen.add(key)
                out[row].append(
                    {
                        "reading": reading,
                        "n_windows": int(own[text]),
                        "n_tokens": n_tokens,
                        "hash": key[1],
                        "place": begin - int(templates.bounds[text]),
                        "slots": slots,
                    }
                )
    return [pa.array(totals, pa.int64()), pa.array(out, WINDOW_TYPE)]


def template_windows(
    table: DataFrame,
    text_col: str,
    keep: Iterable[str],
    size: int = WINDOW,
    asked: Filter | None = None,
) -> DataFrame:
    """``keep`` and the fields of a window: a row per window and reading."""
    held = table.sparkSession.sparkContext.broadcast(asked)
    made = map_texts(
        table, lambda texts: windows_of(texts, size, held.value), WINDOW_FIELDS, text_col, keep
    )
    return made.select(*[f"`{c}`" for c in keep], F.inline("windows"))


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    size: int = WINDOW,
    min_coverage: float = MIN_COVERAGE,
    min_consistency: float = MIN_CONSISTENCY,
    filter_power: int = FILTER_POWER,
    min_covered: float = MIN_COVERED,
    min_covered_tokens: int = MIN_COVERED_TOKENS,
    all_pairs: bool = True,
) -> DataFrame:
    """A row per document and item that share a template window.

    Without ``all_pairs`` those whose windows do not suffice are left out before their slots
    are compared; what is contaminated is the same.

    Columns: ``doc_id``, ``text_hash`` (of the document's text), ``item_id``,
    ``n_windows`` (of the item), ``n_matched``, ``coverage``, ``slot_consistency``
    (1 without slots), all of the first reading that has a window in common, ``covered``
    (the largest share of the item's tokens in matched windows by any reading), and
    ``contaminated``, which is true if it is by any reading.
    """
    items = benchmark.select(
        F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{item_text_col}`").alias("item_text")
    )
    items = saved(template_windows(items, "item_text", ["item_id"], size))
    asked = filter_of(items.select("hash").distinct(), filter_power)
    own = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.xxhash64(F.col(f"`{text_col}`")).alias("text_hash"),
        F.col(f"`{text_col}`").alias("doc_text"),
    )
    found = template_windows(own, "doc_text", ["doc_id", "text_hash"], size, asked)
    found = saved(
        found.select("doc_id", "text_hash", "hash", F.col("slots").alias("doc_slots")).join(
            items.select("hash").distinct(), "hash", "left_semi"
        )
    )
    # a hash belongs to one reading
    shared = found.select("doc_id", "text_hash", "hash").join(
        items.select("hash", "item_id", "reading", "n_windows", "n_tokens", "place",
                     F.size("slots").alias("n_slots")), "hash"
    )
    pair = ["doc_id", "text_hash", "item_id", "reading"]
    # arrays of one item's windows, so no longer than the item
    in_run = [
        lambda i, back=back: (
            F.get("places", i - back + (LONG_RUN - 1))["place"] - F.get("places", i - back)["place"]
            == LONG_RUN - 1
        )
        for back in range(LONG_RUN)
    ]
    told = F.filter(
        "places",
        lambda w, i: F.greatest(
            w["n_slots"] <= FEW_SLOTS, *[F.coalesce(run(i), F.lit(False)) for run in in_run]
        ),
    )
    overlaps = F.zip_with(
        "told",
        F.slice("told", F.lit(2), F.size("told")),
        lambda w, then: F.greatest(w["place"] + F.lit(size) - then["place"], F.lit(0)),
    )
    lost = F.aggregate(overlaps, F.lit(0), lambda n, x: n + F.coalesce(x, F.lit(0)))
    matched = (
        shared.groupBy(*pair)
        .agg(
            F.max("n_windows").alias("n_windows"),
            F.max("n_tokens").alias("n_tokens"),
            F.size(F.collect_set("place")).cast("long").alias("n_matched"),
            F.sort_array(F.collect_set(F.struct("place", "n_slots"))).alias("places"),
        )
        .withColumn("told", told)
        .withColumn("n_covered", F.least("n_tokens", F.size("told") * F.lit(size) - lost))
        .drop("places", "told")
    )
    covered, coverage = F.col("n_covered") / F.col("n_tokens"), F.col("n_matched") / F.col("n_windows")
    most = (covered >= min_covered) & (F.col("n_covered") >= min_covered_tokens)
    matched = matched.withColumns(
        {"coverage": coverage, "covered": covered, "enough": (coverage >= min_coverage) | most}
    )
    matched = saved(matched if all_pairs else matched.filter("enough"))

    def same(a: str, b: str, names: Iterable[str]) -> list[Column]:
        return [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in names]

    wanted = matched.select(*pair).alias("w").join(
        items.alias("i"), same("w", "i", ["item_id", "reading"])
    )
    wanted = wanted.select(*[f"w.{c}" for c in pair], "i.hash", "i.place", "i.slots")
    hits = wanted.alias("w").join(found.alias("f"), same("w", "f", ["doc_id", "text_hash", "hash"]))
    hits = hits.select(*[f"w.{c}" for c in pair], "w.place", "w.slots", "f.doc_slots")
    filled = hits.select(
        *pair, "place", F.posexplode(F.arrays_zip("slots", "doc_slots")).alias("slot", "value")
    ).select(*pair, "place", "slot", "value.slots", "value.doc_slots")
    filled = filled.distinct()
    # each item value's most frequent replacement, against all matched slots of the item
    alike = (
        filled.groupBy(*pair, "slots", "doc_slots")
        .count()
        .groupBy(*pair, "slots")
        .agg(F.max("count").alias("alike"))
        .groupBy(*pair)
        .agg(F.sum("alike").alias("alike"))
    )
    places = filled.select(*pair, "place", "slot").distinct()
    slots = places.groupBy(*pair).agg(F.count("*").alias("n_slots"))

    checked = alike.alias("a").join(slots.alias("s"), same("a", "s", pair))
    held = F.col("alike") / F.col("n_slots")
    checked = checked.select(*[f"a.{c}" for c in pair], held.alias("held"))
    out = matched.alias("m").join(checked.alias("c"), same("m", "c", pair), "left")
    out = out.select(
        *[f"m.{c}" for c in pair], "n_windows", "n_matched", "coverage", "covered", "enough",
        F.coalesce("held", F.lit(1.0)).alias("slot_consistency"),
    )
    out = out.withColumn(
        "contaminated", F.col("enough") & (F.col("slot_consistency") >= min_consistency)
    )
    figures = ["n_windows", "n_matched", "coverage", "slot_consistency"]
    out = out.groupBy(*pair[:-1]).agg(
        F.min_by(F.struct(*figures), "reading").alias("first"),
        F.max("covered").alias("covered"),
        F.max("contaminated").alias("contaminated"),
    )
    return out.select(*pair[:-1], "first.*", "covered", "contaminated")


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """The rows of ``docs``, all columns, that no benchmark item contaminates."""
    found = contamination(docs, benchmark, id_col, text_col, all_pairs=False, **options)
    bad = found.filter("contaminated").select("doc_id", "text_hash").distinct().alias("bad")
    own = docs.alias("own")
    return own.join(
        bad,
        F.col(f"own.`{id_col}`").eqNullSafe(F.col("bad.doc_id"))
        & (F.xxhash64(F.col(f"own.`{text_col}`")) == F.col("bad.text_hash")),
        "left_anti",
    )
