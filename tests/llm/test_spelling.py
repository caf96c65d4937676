import random
import re
import zlib
from collections import Counter

import pytest

from cases_llm import SCHEMA, clashing, odd_rows, prose, rows
from spintally.llm import queries, spelling

LOWER = str.maketrans(spelling.UPPER, spelling.UPPER.lower())


def plain_words(data, damage=True):
    """Words with their counts, as the contract words it."""
    counts = Counter()
    for doc_id, text, *_ in data:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if damage and h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= 5
    return {word: n for word, n in counts.items() if n >= 3}


def one_edit(a, b):
    """Whether ``b`` is ``a`` with one code point inserted, deleted or replaced, tried out."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(words):
    near = {w: [] for w in words}
    for a in words:
        for b in words:
            if a < b and abs(len(a) - len(b)) < 2 and one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out)


def misspelt_texts(seed=3):
    """Words of few stems with edits of one or two letters, in uneven numbers, capitals and accents."""
    rng = random.Random(seed)
    letters = "abcDeéÿÀ×z"
    stems = ["".join(rng.choice(letters) for _ in range(rng.randrange(4, 12))) for _ in range(14)]
    stems += ["aaaaa", "aaaaaa", "aaaaaaaa", "abababab", "x" * 40]
    texts = []
    for _ in range(60):
        words = []
        for _ in range(rng.randrange(80)):
            word = rng.choice(stems[: rng.randrange(1, len(stems) + 1)])
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                i = rng.randrange(len(word) + 1)
                word = word[:i] + rng.choice(["", *letters]) + word[i + rng.randrange(2) :]
            words.append(rng.choice([word, word, word.upper() if word.isascii() else word]))
        texts.append(rng.choice([" ", "-", "1"]).join(words))
    texts.append("kitten " * 8 + "kittens " * 40 + "kittensq " * 90 + "kittenq " * 3)
    return texts


@pytest.mark.parametrize("dense", [spelling.DENSE, 3])
def test_variants_as_brute_force(spark, dense):
    data = odd_rows() + rows(misspelt_texts(), 1000)
    docs = clashing(spark.createDataFrame(data, SCHEMA)).repartition(3)
    found = spelling.variants(docs, damage=True, dense=dense).collect()
    expected = plain(plain_words(data))
    assert sorted(tuple(r) for r in found) == expected
    assert sum(r[1] is not None for r in expected) > 20 and any(r[1] != r[2] for r in expected if r[1])


def test_query_as_brute_force(spark, tmp_path):
    data = rows(misspelt_texts(8) + [prose(s, 60, 30) for s in range(20)], 500)
    spark.createDataFrame(data, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op12_spelling_variants(spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in found) == plain(plain_words(data))


def test_small_batches_keep_buckets_whole(spark):
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    data = rows(misspelt_texts(5), 1000)
    spark.conf.set(setting, "7")
    try:
        found = spelling.variants(spark.createDataFrame(data, SCHEMA)).collect()
    finally:
        spark.conf.set(setting, before)
    assert sorted(tuple(r) for r in found) == plain(plain_words(data, damage=False))


def test_equal_counts_go_to_the_first_word(spark):
    text = "stone " * 3 + "stony " * 6 + "stones " * 6 + "lonely " * 4 + "Stonÿ " * 6
    found = spelling.variants(spark.createDataFrame(rows([text, text]), SCHEMA)).collect()
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in found}
    assert got["stone"] == ("stones", "stones", 6, 3, 12)
    assert got["lonely"] == (None, "lonely", 8, 0, None)
    assert got["stony"] == (None, "stony", 12, 2, None)


def test_very_long_words_and_empty_table(spark):
    long = "ab" * 30_000
    text = " ".join([long] * 6 + [long[:20_000] + "x" + long[20_000:]] * 3 + [long[:-2] + "xx"] * 3)
    found = spelling.variants(spark.createDataFrame(rows([text]), SCHEMA)).collect()
    assert sorted((len(r.word), r.n, r.n_near, r.form == long) for r in found) == [
        (60_000, 3, 0, False), (60_000, 6, 1, False), (60_001, 3, 1, True)
    ]
    assert spelling.variants(spark.createDataFrame([], SCHEMA)).collect() == []
    with pytest.raises(ValueError):
        spelling.variants(spark.createDataFrame([], SCHEMA), ratio=1)
