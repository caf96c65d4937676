import random

import pytest
import xxhash

from cases_llm import SCHEMA, clashing, odd_rows, prose, rows
from spintally.llm import simhash
from spintally.llm.tables import components


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words_of(text):
    out, word = [], ""
    for c in lower(text or "") + " ":
        if c == " " or "\x09" <= c <= "\x0d":
            out += [word] if word else []
            word = ""
        else:
            word += c
    return out


def plain_fingerprint(text, k=4):
    words = words_of(text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, fps, max_bits):
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= max_bits:
                parent[root(i)] = root(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [least.get(root(i)) for i in range(len(ids))]


def near_texts():
    rng = random.Random(3)
    out = []
    for group in range(6):
        words = prose(group, 120).split()
        for _ in range(9):
            words = list(words)
            words[rng.randrange(len(words))] = f"new{rng.randrange(9)}"
            out.append(" ".join(words))
    return out


@pytest.mark.parametrize("dense", [simhash.DENSE_BUCKET, 1])
@pytest.mark.parametrize("max_bits", [0, 3, 4])
def test_components_as_brute_force(spark, max_bits, dense):
    data = odd_rows() + rows(near_texts(), 100)
    fps = [plain_fingerprint(t) for _, t, *_ in data]
    expected = plain_components([d for d, *_ in data], fps, max_bits)
    docs = clashing(spark.createDataFrame(data, SCHEMA))
    found = simhash.near_duplicates(docs, max_bits=max_bits, dense_bucket=dense).collect()
    as_rows = [(r.doc_id, r.fp % (1 << 64), r.component_id) for r in found]
    assert sorted(as_rows, key=str) == sorted(zip([d for d, *_ in data], fps, expected), key=str)


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    text = prose(9, 1000)
    monkeypatch.setattr(simhash, "PIECE", 64)
    assert simhash.fingerprint(simhash.shingle_hashes(text, 4)) == plain_fingerprint(text)


def test_flips_are_those_within_the_shares():
    assert len(simhash.chain_flips(0, 4, 2)) == 1 + 13
    for start in range(5):
        widths = [simhash.segments(4)[(start + i) % 5][1] for i in range(3)]
        a, b = widths[1], widths[2]
        expected = 1 + a + b + a * b + b * (b - 1) // 2
        flips = simhash.chain_flips(start, 4, 3)
        assert len(flips) == len(set(flips)) == expected


@pytest.mark.parametrize("key_segments", [2, 3])
@pytest.mark.parametrize("dense", [simhash.DENSE_BUCKET, 2])
def test_links_lose_nothing(spark, dense, key_segments):
    rng = random.Random(8)
    values = {rng.getrandbits(64) for _ in range(40)}
    for value in list(values):
        for _ in range(6):
            flips = rng.sample(range(64), rng.randrange(1, 7))
            values.add(value ^ sum(1 << b for b in flips))
    values = [simhash.signed(v) for v in values]
    linked = {(a, b) for a in values for b in values if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 4}
    found = [tuple(r) for r in simhash.links(frame(spark, values), 4, dense, key_segments).collect()]
    if dense == simhash.DENSE_BUCKET:
        assert sorted(found) == sorted(linked)
    assert all((min(p), max(p)) in linked for p in found)
    roots = {r.node: r.root for r in components(spark.createDataFrame(found, "a long, b long")).collect()}
    assert all(roots[a] == roots[b] for a, b in linked)


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "fp long")


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    assert {r.root for r in components(edges).collect()} == {0}


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
