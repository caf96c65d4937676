import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases_llm import SCHEMA, clashing, odd_rows, prose, rows
from spintally.llm import queries, ragged, runs, suffixes
from test_repetition import plain_words


def plain_runs(words, min_length=24, min_exponent=3):
    """Every stretch of one period that no neighbour extends, if no smaller period fits it."""
    found = []
    for q in range(1, len(words) // min_exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(min_length, min_exponent * q):
                own = words[i : i + length]
                if not any(own[d:] == own[: length - d] for d in range(1, q)):
                    found.append((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda run: (run[0], run[2]))


def plain_rewritten(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(words):
    found = plain_runs(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else None
    gone = {i for start, length, q in found for i in range(start + q, start + length)}
    return (
        len(found), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
        digest("".join(f"{a},{n},{q}\n" for a, n, q in found)),
        digest(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


NAMES = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def periodic_texts():
    rng = random.Random(11)
    out = ["x " * 23, "x " * 24, "a b " * 12, "a b c d e f g h " * 2 + "a b c d e f g", "aa " * 400]
    for seed in range(60):
        words = []
        for _ in range(rng.randrange(1, 6)):
            block = prose(rng.randrange(99), rng.randrange(1, 25), rng.choice([1, 2, 40])).split()
            words += block * rng.choice([1, 1, 2, 3, 4, 9])
        cut = rng.randrange(0, 4)
        out.append(rng.choice([" ", "\n", " \t "]).join(words[cut:]))
    return out


def test_suffixes_and_common_prefixes_as_sorted_lists():
    for seed in range(120):
        rng = random.Random(seed)
        sizes = [rng.randrange(0, 40) for _ in range(3)]
        bounds = ragged.offsets_of(np.array(sizes))
        words = np.array([rng.randrange(rng.choice([1, 2, 3])) for _ in range(sum(sizes))], np.int64)
        for least in (1, 2, 4):
            at = suffixes.repeated_suffixes(words, bounds, least)
            text = np.searchsorted(bounds, at, "right") - 1
            own = [(t, tuple(words[p : bounds[t + 1]])) for p, t in zip(at, text)]
            assert own == sorted(own)
            shared = suffixes.common_prefixes(words, bounds, at)
            for k in range(1, len(at)):
                (s, x), (t, y) = own[k - 1], own[k]
                equal = 0
                while s == t and equal < min(len(x), len(y)) and x[equal] == y[equal]:
                    equal += 1
                assert shared[k] == equal
            places = {}
            for t in range(3):
                for p in range(bounds[t], bounds[t + 1] - least + 1):
                    places.setdefault((t, tuple(words[p : p + least])), []).append(p)
            assert {p for v in places.values() if len(v) > 1 for p in v} <= set(at.tolist())


def test_runs_as_brute_force():
    total = 0
    for seed in range(400):
        rng = random.Random(seed)
        letters, words = rng.choice([1, 2, 2, 3]), []
        while len(words) < rng.randrange(20, 160):
            block = [rng.randrange(letters + 1) for _ in range(rng.randrange(1, 14))]
            words += block * rng.choice([1, 1, 2, 5, 9])
        cut = rng.randrange(len(words) + 1)
        found = runs.find_runs(np.array(words), np.array([0, cut, len(words)]))
        later = [(cut + a, n, q) for a, n, q in plain_runs(words[cut:])]
        assert found == plain_runs(words[:cut]) + later
        total += len(found)
    assert total > 300


def test_other_lengths_and_exponents():
    for seed in range(60):
        rng = random.Random(seed)
        words = [rng.randrange(2) for _ in range(80)] + [0, 1, 1] * rng.randrange(2, 9)
        for length, exponent in ((1, 3), (6, 4), (40, 5)):
            got = runs.find_runs(np.array(words), np.array([0, len(words)]), length, exponent)
            assert got == plain_runs(words, length, exponent)
    with pytest.raises(ValueError):
        runs.find_runs(np.zeros(9, np.int64), np.array([0, 9]), 4, 2)


def test_rows_as_brute_force(spark):
    data = odd_rows() + rows(periodic_texts(), 100)
    docs = clashing(spark.createDataFrame(data, SCHEMA)).repartition(3)
    found = runs.periodic_runs(docs).collect()
    got = sorted(((str(r.doc_id), *(r[n] for n in NAMES)) for r in found), key=str)
    data = [(d, plain_words(t)) for d, t, *_ in data]
    expected = [
        (str(d), *(plain(w) if len(set(w)) > 1 or len(w) < 600 else one_word(w))) for d, w in data
    ]
    assert got == sorted(expected, key=str)
    listed = [len(r.runs) for r in found]
    assert listed == [r.n_runs for r in found] and sum(listed) > 20


def one_word(words):
    """The one run of a text that repeats a single word."""
    n = len(words)
    return 1, 0, n, 1, 1000 * n, digest(f"0,{n},1\n"), digest(words[0])


def test_query_rewrites_and_finds_as_brute_force(spark, tmp_path):
    texts = [prose(s, 1 + s * 7 % 300, 60) for s in range(150)] + periodic_texts()[:9]
    data = rows(texts, 1000) + [r for r in odd_rows() if r[1] is None or len(r[1]) < 3000]
    spark.createDataFrame(data, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op11_periodic_runs(spark, str(tmp_path)).collect()
    got = sorted((tuple(r) for r in found), key=str)
    expected = [(d, *plain(plain_rewritten(d, plain_words(t)))) for d, t, *_ in data]
    assert got == sorted(expected, key=str)
    changed = [d for d, t, *_ in data if plain_rewritten(d, plain_words(t)) != plain_words(t)]
    assert len(changed) > 8 and sum(r[1] for r in got) > 10


def test_collapsed_text_keeps_first_periods(spark):
    data = rows(["a b c " * 9 + "end", "x\ty  z", None, "", "q " * 30])
    made = runs.collapsed(spark.createDataFrame(data, SCHEMA)).orderBy("doc_id").collect()
    assert [r.text for r in made] == ["a b c end", "x\ty  z", "", "", "q"]
    assert made[0].asDict().keys() == {"doc_id", "text", "lang", "source", "n_chars"}


def test_long_text_and_empty_table(spark):
    words = prose(5, 300).split()
    text = " ".join(words * 400) + " " + " ".join(f"u{i}" for i in range(40_000)) + " z" * 50_000
    row = runs.periodic_runs(spark.createDataFrame(rows([text]), SCHEMA)).collect()[0]
    assert (row.n_runs, row.start, row.length, row.period) == (2, 160_000, 50_000, 1)
    assert row.runs[0].asDict() == {"start": 0, "length": 120_000, "period": 300}
    empty = spark.createDataFrame([], SCHEMA)
    assert runs.periodic_runs(empty).collect() == []
    assert empty.select(runs.rewritten(F.col("text"), F.col("doc_id"))).collect() == []
