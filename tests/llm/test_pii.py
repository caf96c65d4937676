import hashlib
import random
import re

import numpy as np

from cases_llm import SCHEMA, clashing, odd_rows, rows
from spintally.llm import pii, queries

TEXTS = [
    "write to a.b+c@mail.example.com, or x@y or @z.com or a@b.c.d.",
    "a@b@c.de a..b@c-d.e-f. %@1.2 a@b..c",
    "from 10.0.0.1 and 256.1.1.1 and 1.2.3.4.5 and 001.2.3.4 and 1.2.3",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112 and 0000000000000 1 2 3",
    "call +1 (415) 555-2671 or +49 30 123456. or +1 2 or +12345678901234567890",
    "+1+1 415 555 2671 (+33) 1 23 45 67 89",
    "SSN 123-45-6789 and IBAN DE89 3704 0044 0532 0130 00, call 415-555-2671",
    "Dear Dr. Maria Lopez, name is John Smith, order 123-45-6780",
    "٤111 1111 1111 1111 ١.2.3.4",
    "5500005555555559 4.4.4.4 5500 0055 5555 5559-",
]


def test_ip_parts_of_thousands_of_zeros(spark):
    zeros = "0" * 5000
    texts = [f"1.2.3.{zeros}", f"{zeros}.2.3.4", f"{zeros}7.2.3.{zeros}255", f"1.2.3.{zeros}256", "1.2.3.4"]
    docs = spark.createDataFrame(rows(texts), SCHEMA)
    found = {r.doc_id: r.base_spans for r in pii.find_pii(docs, pii.fit(docs)).collect()}
    got = {d: [tuple(s) for s in spans] for d, spans in found.items()}
    assert got == {d: [("ip", 0, len(t))] if d != 3 else [] for d, t in enumerate(texts)}


def literal(pattern, text, accept):
    return [m.span() for m in re.finditer(pattern, text) if accept(m)]


def plain(text):
    text = text or ""
    digits = lambda s: [c for c in s if c in "0123456789"]

    def luhn(ds):
        total = 0
        for i, d in enumerate(reversed(ds)):
            v = int(d) * (2 if i % 2 else 1)
            total += v if v < 10 else v - 9
        return total % 10 == 0

    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m[0])) <= 15),
    ]
    return [(kind, a, b) for kind, pattern, ok in rules for a, b in literal(pattern, text, ok)]


def noisy(seed):
    rng = random.Random(seed)
    parts = ["a", "@", ".", "-", " ", "+", "1", "25", "415", "4111", "1111", "(", ")", "é", "b.c", "x@y.z", "\n"]
    return "".join(rng.choice(parts) for _ in range(rng.randrange(50)))


def test_base_spans_as_plain_patterns(spark, tmp_path):
    data = odd_rows() + rows(TEXTS, 100) + rows([noisy(s) for s in range(600)], 200)
    spark.createDataFrame(data, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op10_pii(spark, str(tmp_path)).collect()
    expected = []
    for doc_id, text, *_ in data:
        own = plain(text)
        kinds = [k for k, _, _ in own]
        digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in own).encode()).hexdigest()
        expected.append((str(doc_id), *map(kinds.count, pii.BASE_KINDS), digest))
    got = [(str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in found]
    assert sorted(got) == sorted(expected)
    for doc_id, text, *_ in data:
        own = {f"{k}:{a}:{b}" for k, a, b in plain(text)}
        assert all(own <= set(r.spans.split(",")) for r in found if doc_id is not None and r.doc_id == doc_id and plain(text))


def test_expectation_maximisation_finds_reliabilities():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.6
    accuracy = np.array([0.95, 0.8, 0.65, 0.55])
    right = rng.random((20_000, 4)) < accuracy
    cast = rng.random((20_000, 4)) < 0.8
    votes = np.where(truth[:, None] == right, 1, -1) * cast
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    _, yes, no = pii.expectation_maximisation(patterns.astype(float), counts.astype(float))
    assert np.abs(yes - accuracy).max() < 0.06 and np.abs(no - accuracy).max() < 0.06


def test_a_failed_checksum_outweighs_the_look_of_a_number(spark):
    cards = ["4111111111111111", "5500005555555559", "4012888888881881"]
    texts = [f"word {c} word" for c in cards] + [f"word {c[:-1]}{(int(c[-1]) + 3) % 10} word" for c in cards * 3]
    docs = spark.createDataFrame(rows(texts), SCHEMA)
    found = {r.doc_id: r for r in pii.find_pii(docs, pii.fit(docs)).collect()}
    assert [len(found[i].spans) for i in range(len(texts))] == [1] * 3 + [0] * 9


def test_a_number_with_a_dialling_code_is_one_span(spark):
    docs = spark.createDataFrame(rows(["call +1 (415) 555-2671 now", "call (415) 555-2671 now"]), SCHEMA)
    found = {r.doc_id: [s.kind for s in r.spans] for r in pii.find_pii(docs, pii.fit(docs)).collect()}
    assert found[0] == ["phone"] and found[1] == ["local_phone"]


def test_model_separates_cued_candidates(spark):
    good = [f"my ssn {i:03d}-45-{1000 + i} is private" for i in range(100, 160)]
    bad = [f"order 000-00-{1000 + i}x item" for i in range(20)]
    docs = spark.createDataFrame(rows(good + bad), SCHEMA)
    model = pii.fit(docs)
    found = {r.doc_id: r.spans for r in pii.find_pii(clashing(docs), model).collect()}
    assert all(found[i][0].kind == "ssn" for i in range(len(good)))
    assert not any(found[i] for i in range(len(good), len(good) + len(bad)))
    assert {name for name, *_ in model.reliabilities} == {f"ssn.{n}" for n in pii.LABELERS}


def test_statistics_count_every_candidate(spark):
    docs = spark.createDataFrame(rows(TEXTS * 3), SCHEMA).repartition(5)
    counted = sum(r.n for r in pii.vote_patterns(docs).collect())
    assert counted == 3 * sum(len(pii.candidates(t)) for t in TEXTS)


def test_redaction(spark):
    assert pii.redacted("a x@y.z b", [("email", 2, 7)]) == "a [EMAIL] b"
    assert pii.redacted("0123456789", [("ip", 2, 6), ("card", 4, 8), ("phone", 8, 9)]) == "01[IP][PHONE]9"
    data = odd_rows() + rows(TEXTS, 100)
    docs = clashing(spark.createDataFrame(data, SCHEMA))
    made = pii.redact(docs, pii.fit(docs), keep=("doc_id", "lang", "spans"))
    assert made.columns == ["doc_id", "lang", "spans", "text", "n_spans"]
    found = {r.doc_id: r.text for r in made.collect()}
    assert found[0] is None and found[1] == "" and "@" not in found[100].replace("@z.com", "").replace("x@y ", "")
    assert "[CARD]" in found[103] and "4111 1111 1111 1111" not in found[103]


def test_pathological_runs_stay_linear():
    for text in ["a" * 300_000, "1" * 300_000, "1." * 100_000, "a@" * 50_000, "+1" + " " * 100_000, "Dr. " * 50_000]:
        pii.candidates(text)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert pii.find_pii(empty, pii.fit(empty)).collect() == []


def test_redaction_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame(
        [(1, "mail a.b@example.com now", "x"), (2, None, "y"), (3, "", None)],
        "doc_id long, text string, was_null string",
    )
    model = pii.fit(docs)
    made = pii.redact(docs, model, keep=("doc_id", "was_null")).orderBy("doc_id")
    assert made.columns == ["doc_id", "was_null", "text", "n_spans"]
    assert [tuple(r) for r in made.collect()] == [
        (1, "x", "mail [EMAIL] now", 1), (2, "y", None, 0), (3, None, "", 0)
    ]
