"""Personal data by weak supervision over candidate spans.

Candidates are everything that looks like personal data, by wide patterns. Labelers
vote on each: its strict form, its checksum or range, gazetteers (countries' dialling
codes, card issuers, mail and network domains, given names), cue words before and
after it, and the characters around it. Votes are counted over all candidates of all
texts, a row per combination; expectation-maximisation finds from those counts how
reliable each labeler is, and the resulting probabilities train a logistic classifier
on the candidate's features, which decides. Spans of the base rules always stay.

Only the table of combinations reaches the driver: its size is bounded by the
labelers, not by the texts.

Defined results: null and empty texts have no spans; repeated rows are searched one by
one and each counts in the statistics; an empty table gives an empty result; kept
columns named like a new one give way to it. Texts are searched whole, a few MB at a
time and one text at least, so memory grows with the longest text only.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spintally.llm import spans
from spintally.llm.rows import map_column, map_texts, strings

BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("ssn", "iban", "name", "local_phone")
KINDS = BASE_KINDS + MORE_KINDS
LABELERS = ("form", "check", "gazetteer", "before", "edges")
#: Labelers whose yes every genuine span gets: the form and the checksum or range.
BY_CONSTRUCTION = (0, 1)
MODEL_THRESHOLD = 0.5
#: Reliability that labelers start from, the candidates that weighs, and that of a sure one.
PRIOR, PRIOR_WEIGHT, SURE = 0.75, 10.0, 0.99

# Gazetteers.
DIALLING_CODES = {
    "1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45",
    "46", "47", "48", "49", "51", "52", "53", "54", "55", "56", "57", "58", "60", "61", "62", "63",
    "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "93", "94", "95", "98", "351", "352",
    "353", "354", "358", "359", "370", "371", "372", "380", "381", "385", "386", "420", "421",
    "852", "880", "886", "966", "971", "972",
}
MAIL_ENDINGS = {
    "com", "net", "org", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "it", "nl", "ch", "at",
    "eu", "us", "ca", "mx", "ar", "br", "pt", "pl", "se", "no", "dk", "fi", "jp", "cn", "in", "au",
}
GIVEN_NAMES = {
    "james", "mary", "john", "linda", "robert", "susan", "michael", "sarah", "david", "anna",
    "thomas", "laura", "peter", "maria", "hans", "julia", "pierre", "marie", "jean", "claire",
    "carlos", "elena", "juan", "carmen", "jose", "lucia", "klaus", "petra", "paul", "emma",
}
TITLES = {"mr", "mrs", "ms", "dr", "prof", "herr", "frau", "madame", "monsieur", "señor", "señora"}
IBAN_COUNTRIES = set("AT BE CH DE DK ES FI FR GB IE IT LU NL NO PL PT SE".split())
CUES = {
    "email": {"email", "mail", "e-mail", "contact", "write", "address", "correo", "courriel"},
    "ip": {"ip", "host", "server", "address", "client", "from", "login"},
    "card": {"card", "visa", "mastercard", "credit", "payment", "karte", "carte", "tarjeta"},
    "phone": {"phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"},
    "local_phone": {"phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"},
    "ssn": {"ssn", "social", "security", "insurance"},
    "iban": {"iban", "account", "bank", "konto", "compte", "cuenta"},
    "name": {"name", "called", "by", "from", "dear", "author", "contact"},
}
AGAINST = set("version isbn issn order item serial invoice id build release doi".split())

LOCAL_PART = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A number cannot start within a run of digits: the run's first digit would have matched.
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
IBAN = re.compile(
    r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
)
LOCAL_PHONE = re.compile(
    r"(?<![+0-9.)-])(?<![+0-9.)-]\x20)\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9-])"
)
NAME = re.compile(r"(?<![^\W\d_])[^\W\d_]{2,12}\.?\x20[^\W\d_]{2,30}(?:\x20[^\W\d_]{2,30})?")
TITLE_OR_NAME = re.compile(
    r"(?<!\w)(?:"
    + "|".join(f"{name[0].upper()}(?i:{name[1:]})" for name in sorted(TITLES | GIVEN_NAMES))
    + r")\.?\x20"
)
DIGIT = re.compile("[0-9]")
WORD = re.compile(r"[\w-]+")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of ``[local]+@[domain]``, found from each at sign outwards."""
    floor, at = 0, text.find("@")
    while at >= 0:
        following = text.find("@", at + 1)
        begin = floor + len(text[floor:at].rstrip(LOCAL_PART))
        match = DOMAIN.match(text, at + 1) if begin < at else None
        floor = at + 1
        if match:
            yield begin, match.end()
            floor = match.end()
        at = following


@dataclass(frozen=True)
class Candidate:
    kind: str
    start: int
    end: int
    base: bool
    votes: tuple[int, ...]
    #: What the classifier sees besides the votes of the cue, edge and gazetteer labelers.
    length: int


def digits_of(piece: str) -> str:
    return "".join(c for c in piece if "0" <= c <= "9")


def pieces(text: str) -> Iterator[tuple[str, int, int, int, int, int]]:
    """Kind, start, end and the votes on form, checksum and gazetteer of every candidate."""
    if "@" in text:
        for a, b in emails(text):
            ending = text[a:b].rpartition(".")[2].lower()
            shape = 1 if ending.isalpha() and not text[a:b].startswith((".", "-")) else -1
            yield "email", a, b, 1, shape, 1 if ending in MAIL_ENDINGS else -1
    if DIGIT.search(text):
        yield from numbers(text)
    for hint in TITLE_OR_NAME.finditer(text):
        match = NAME.match(text, hint.start())
        if match:
            words = match[0].replace(".", "").split()
            capital = all(w[0].isupper() for w in words)
            known = any(w.lower() in GIVEN_NAMES for w in words)
            titled = words[0].lower() in TITLES
            yield "name", *match.span(), 1 if capital else -1, 1 if titled else 0, 1 if known else -1


def numbers(text: str) -> Iterator[tuple[str, int, int, int, int, int]]:
    """The candidates of ``pieces`` that hold digits."""
    for match in IP.finditer(text):
        parts = match.groups()
        short = [p.lstrip("0") or "0" for p in parts]  # int() refuses thousands of zeros
        inside = all(len(p) <= 3 and int(p) <= 255 for p in short)
        plain = all(p == "0" or p[0] != "0" for p in parts)
        place = 0
        if inside:
            place = -1 if int(short[0]) in (0, 255) else 1
        yield "ip", *match.span(), 1 if inside else -1, 1 if plain else -1, place
    for match in CARD.finditer(text):
        digits = digits_of(match[0])
        if len(digits) >= 12:
            right = 13 <= len(digits) <= 19
            issuer = 1 if digits[0] in "3456" or digits[:2] == "22" else -1
            yield "card", *match.span(), 1 if right else -1, 1 if luhn(digits) else -1, issuer
    international = []
    if "+" in text:
        for match in PHONE.finditer(text):
            international.append(match.span())
            digits = digits_of(match[0])
            right = 9 <= len(digits) <= 15
            known = any(digits[:n] in DIALLING_CODES for n in (1, 2, 3))
            grouped = 1 if match[0].count("(") == match[0].count(")") else -1
            yield "phone", *match.span(), 1 if right else -1, grouped, 1 if known else -1
    for match in SSN.finditer(text):
        area, group, serial = match[0].split("-")
        valid = area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"
        yield "ssn", *match.span(), 1, 1 if valid else -1, 0
    for match in IBAN.finditer(text):
        own = match[0].replace(" ", "")
        moved = "".join(str(int(c, 36)) for c in own[4:] + own[:4])
        known = 1 if own[:2] in IBAN_COUNTRIES else -1
        right = 1 if int(moved) % 97 == 1 else -1
        yield "iban", *match.span(), 1 if 15 <= len(own) <= 34 else -1, right, known
    for match in LOCAL_PHONE.finditer(text):
        place = bisect(international, (match.start(), len(text))) - 1
        if place >= 0 and international[place][1] > match.start():
            continue  # part of a number with a dialling code
        area = digits_of(match[0])[:3]
        yield "local_phone", *match.span(), 1, 1 if area[0] not in "01" else -1, 0


def is_base(kind: str, votes: tuple[int, ...]) -> bool:
    """Whether the base rule takes the candidate: its form, and for cards the checksum too."""
    return kind in BASE_KINDS and votes[0] == 1 and (kind != "card" or votes[1] == 1)


def candidates(text: str) -> list[Candidate]:
    out = []
    for kind, start, end, form, check, gazetteer in pieces(text):
        cues = {w.lower() for w in WORD.findall(text[max(0, start - 40) : start])[-4:]}
        before = 1 if cues & CUES[kind] else -1 if cues & AGAINST else 0
        touching = (start and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum())
        votes = (form, check, gazetteer, before, -1 if touching else 1)
        out.append(
            Candidate(kind, start, end, is_base(kind, votes), votes, min(3, (end - start) // 10))
        )
    return out


@dataclass(frozen=True)
class Model:
    """Weights of the span classifier and what the labelers turned out to be worth."""

    weights: tuple[float, ...]
    #: Kind and labeler, sensitivity, specificity.
    reliabilities: tuple[tuple[str, float, float], ...]

    def probability(self, kind: str, votes: tuple[int, ...], length: int) -> float:
        x = features(kind, votes, length)
        return float(1 / (1 + np.exp(-np.dot(self.weights, x))))


def features(kind: str, votes: tuple[int, ...], length: int) -> np.ndarray:
    """Intercept, the kind, each vote for and against, and the length class."""
    x = np.zeros(1 + len(KINDS) + 2 * len(LABELERS) + 4)
    x[0] = x[1 + KINDS.index(kind)] = 1
    for place, vote in enumerate(votes):
        if vote:
            x[1 + len(KINDS) + 2 * place + (vote < 0)] = 1
    x[-4 + length] = 1
    return x


def expectation_maximisation(
    votes: np.ndarray, counts: np.ndarray, held: tuple[int, ...] = (), rounds: int = 200
):
    """Probability of each row of votes to be personal data, and the labelers' reliabilities.

    A labeler has a sensitivity, how often it says yes to personal data if it votes, and a
    specificity, how often it says no to the rest. Labelers are independent given the
    truth. Both start from, and keep a little weight on, a prior. For the labelers in
    ``held`` the sensitivity stays ``SURE``: what they check holds for every genuine span
    by construction, whatever the corpus looks like.
    """
    width = votes.shape[1]
    sensitivity, specificity = np.full(width, PRIOR), np.full(width, PRIOR)
    sensitivity[list(held)] = SURE
    yes, no = votes > 0, votes < 0
    share, truth = 0.5, np.full(len(counts), 0.5)
    for _ in range(rounds):
        for_it = np.log(sensitivity / (1 - specificity))
        against = np.log((1 - sensitivity) / specificity)
        odds = yes @ for_it + no @ against + np.log(share / (1 - share))
        truth = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        genuine, other = counts * truth, counts * (1 - truth)
        for labeler in range(width):
            y, n = yes[:, labeler], no[:, labeler]
            cast = y | n
            if labeler not in held:
                sensitivity[labeler] = (genuine[y].sum() + PRIOR * PRIOR_WEIGHT) / (
                    genuine[cast].sum() + PRIOR_WEIGHT
                )
            specificity[labeler] = (other[n].sum() + PRIOR * PRIOR_WEIGHT) / (
                other[cast].sum() + PRIOR_WEIGHT
            )
        sensitivity, specificity = np.clip(sensitivity, 0.01, 0.99), np.clip(specificity, 0.01, 0.99)
        share = np.clip(genuine.sum() / max(counts.sum(), 1), 0.05, 0.95)
    return truth, sensitivity, specificity


def logistic(x: np.ndarray, target: np.ndarray, counts: np.ndarray, ridge: float = 1.0):
    """Weights of a logistic regression on soft targets, by Newton's method."""
    weights = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (counts * (target - p)) - ridge * weights
        curve = (x * (counts * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(curve, slope)
        weights += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return weights


PATTERN_FIELDS = "patterns array<struct<kind:string,votes:array<int>,length:int>>"
PATTERN_TYPE = pa.list_(
    pa.struct([("kind", pa.string()), ("votes", pa.list_(pa.int32())), ("length", pa.int32())])
)


def vote_patterns(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``kind``, ``votes``, ``length`` and how many candidates of all texts have them."""

    def compute(texts):
        rows = [
            [{"kind": c.kind, "votes": list(c.votes), "length": c.length} for c in candidates(text)]
            for text in texts
        ]
        return [pa.array(rows, PATTERN_TYPE)]

    found = map_texts(docs, compute, PATTERN_FIELDS, text_col, [])
    return (
        found.select(F.inline("patterns")).groupBy("kind", "votes", "length").agg(F.count("*").alias("n"))
    )


def fit(docs: DataFrame, text_col: str = "text") -> Model:
    """The model of all candidates in ``docs``; without candidates, weights are zero."""
    counted = vote_patterns(docs, text_col).collect()
    rows = sorted((r.kind, tuple(r.votes), r.length, r.n) for r in counted)
    width = len(features(KINDS[0], (0,) * len(LABELERS), 0))
    if not rows:
        return Model((0.0,) * width, ())
    counts = np.array([r[3] for r in rows], float)
    truth = np.zeros(len(rows))
    accuracies = []
    for kind in KINDS:  # a labeler is as reliable as its rule for that kind
        own = [i for i, r in enumerate(rows) if r[0] == kind]
        if own:
            votes = np.array([rows[i][1] for i in own], float)
            truth[own], *found = expectation_maximisation(votes, counts[own], BY_CONSTRUCTION)
            accuracies += [
                (f"{kind}.{name}", float(yes), float(no)) for name, yes, no in zip(LABELERS, *found)
            ]
    x = np.array([features(k, v, n) for k, v, n, _ in rows])
    return Model(tuple(logistic(x, truth, counts).tolist()), tuple(accuracies))


def decide(text: str, model: Model, memo: dict) -> tuple[list[spans.Span], list[spans.Span]]:
    """Base spans, and base spans together with those the classifier takes, by kind and start."""
    base, out = [], []
    for c in candidates(text):
        key = (c.kind, c.votes, c.length)
        if key not in memo:  # as many keys as combinations of votes
            memo[key] = model.probability(*key) > MODEL_THRESHOLD
        if c.base:
            base.append((c.kind, c.start, c.end))
        if c.base or memo[key]:
            out.append((c.kind, c.start, c.end))
    ordered = lambda found: sorted(found, key=lambda s: (KINDS.index(s[0]), s[1]))
    return ordered(base), ordered(out)


def find_pii(
    docs: DataFrame,
    model: Model,
    text_col: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``keep`` columns, ``base_spans`` and all ``spans``, one row per input row."""

    def compute(texts):
        memo: dict = {}
        made = [decide(text, model, memo) for text in texts]
        return [spans.column([base for base, _ in made]), spans.column([own for _, own in made])]

    fields = f"base_spans {spans.FIELD}, spans {spans.FIELD}"
    return map_texts(docs, compute, fields, text_col, keep)


def redacted(text: str, found: list[spans.Span]) -> str:
    """``text`` with each span, and spans that overlap together, replaced by the kind."""
    out, at = [], 0
    merged: list[list] = []
    for kind, start, end in sorted(found, key=lambda s: (s[1], -s[2])):
        if merged and start < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], end)
        else:
            merged.append([kind, start, end])
    for kind, start, end in merged:
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def redact(
    docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``keep`` columns, the redacted ``text_col`` (null stays null) and its ``n_spans``."""

    def compute(column):
        memo: dict = {}
        texts = strings(column)
        found = [decide(text, model, memo)[1] for text in texts]
        made = [redacted(text, own) for text, own in zip(texts, found)]
        missing = column.is_null().to_numpy(zero_copy_only=False)
        counts = pa.array(list(map(len, found)), pa.int32())
        return [pa.array(made, pa.string(), mask=missing), counts]

    typed = docs.withColumn(text_col, F.col(f"`{text_col}`").cast("string"))
    return map_column(typed, compute, f"`{text_col}` string, n_spans int", text_col, keep)
