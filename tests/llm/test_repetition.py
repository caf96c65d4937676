import random

import numpy as np
import pyarrow as pa

from cases_llm import SCHEMA, clashing, odd_rows, prose, rows
from spintally.llm import ragged, repetition
from test_simhash import words_of


def plain_words(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c == " " or "\x09" <= c <= "\x0d":
            out += [word] if word else []
            word = ""
        else:
            word += c
    return out


def plain_cover(words, size):
    """Words in windows of ``size`` that stand at two or more places."""
    places = {}
    for i in range(len(words) - size + 1):
        places.setdefault(tuple(words[i : i + size]), []).append(i)
    inside = {i + k for own in places.values() if len(own) > 1 for i in own for k in range(size)}
    return len(inside)


def plain_longest(words, least):
    size = least - 1
    while plain_cover(words, size + 1):
        size += 1
    return size if size >= least else 0


def plain(text, least=repetition.MIN_REPEAT):
    text = text or ""
    words = plain_words(text)
    lines = [line for line in text.split("\n") if plain_words(line)]
    repeat = plain_cover(words, 8)
    cover, longest = plain_cover(words, least), plain_longest(words, least)
    failed = len(words) < 20 or 100 * repeat > 30 * len(words)
    over = cover > repetition.MAX_COVERED * len(words) or longest > repetition.MAX_LONGEST
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        sum(line in lines[:i] for i, line in enumerate(lines)), repeat, cover, longest,
        failed, not failed and not over,
    )


def repetitive_texts():
    rng = random.Random(4)
    out = ["a " * 50, "a b " * 30, "one two three four five six seven eight nine " * 2]
    for seed in range(25):
        words = prose(seed, rng.randrange(1, 250), rng.choice([2, 5, 40, 400])).split()
        for _ in range(rng.randrange(3)):
            a = rng.randrange(len(words))
            part = words[a : a + rng.randrange(1, 130)]
            at = rng.randrange(len(words) + 1)
            words[at:at] = part
        out.append(rng.choice([" ", "\n", " \t\n"]).join(words) + "### $")
    return out


def test_counts_and_verdicts_as_brute_force(spark):
    data = odd_rows() + rows(repetitive_texts(), 100)
    data = [r for r in data if r[1] is None or len(r[1]) < 6000] + rows(["word " * 300], 900)
    docs = clashing(spark.createDataFrame(data, SCHEMA)).repartition(3)
    found = repetition.quality(docs).collect()
    names = [f.split()[0] for f in repetition.FIELDS.split(", ")] + ["base_failed", "kept"]
    got = sorted(((str(r.doc_id), *(r[n] for n in names)) for r in found), key=str)
    assert got == sorted(((str(d), *plain(t)) for d, t, *_ in data), key=str)


def test_longest_repeats_are_maximal():
    for seed in range(30):
        words = prose(seed, 150, 4).split()
        codes = pa.array(words).dictionary_encode().indices.to_numpy().astype(np.int64)
        suffixes = repetition.SortedSuffixes(codes, ragged.offsets_of(np.array([70, 80])))
        starts, lengths = suffixes.longest_repeats(3)
        own = dict(zip(starts.tolist(), lengths.tolist()))
        for i in range(150):
            low, high = (0, 70) if i < 70 else (70, 150)
            best = 0
            for j in range(low, high):
                k = 0
                while i != j and max(i, j) + k < high and words[i + k] == words[j + k]:
                    k += 1
                best = max(best, k)
            assert own.get(i, 0) == (best if best >= 3 else 0)


def test_long_text_and_empty_table(spark):
    long = " ".join(prose(s, 2000) for s in range(20)) + " " + "x" * 100_000
    docs = spark.createDataFrame(rows([long]), SCHEMA)
    row = repetition.quality(docs).collect()[0]
    assert row.n_words == 40_001 and row.word_chars == sum(map(len, words_of(long)))
    assert repetition.quality(spark.createDataFrame([], SCHEMA)).collect() == []
