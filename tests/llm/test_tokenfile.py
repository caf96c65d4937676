import random
import time
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from cases_llm import SCHEMA, clashing, odd_rows, prose, rows
from spintally.llm import tokenfile

PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("bits", [1, 3, 8, 11, 16, 17, 24, 31])
def test_packing_round_trip_and_random_access(bits):
    rng = np.random.default_rng(bits)
    ids = rng.integers(0, 1 << bits, 70_001, dtype=np.uint32)
    payload = tokenfile.pack(ids, bits)
    assert len(payload) == (len(ids) * bits + 7) // 8
    assert (tokenfile.unpack(payload, bits, 0, len(ids)) == ids).all()
    for first, count in [(0, 0), (1, 1), (69_990, 11), (12_345, 678)]:
        assert (tokenfile.unpack(payload, bits, first, count) == ids[first : first + count]).all()
    with pytest.raises(ValueError):
        tokenfile.pack(np.array([1 << bits], np.uint32), bits)


def test_bits_hold_the_vocabulary():
    assert [tokenfile.bits_for(n) for n in (1, 2, 3, 50_257, 65_536, 65_537)] == [1, 1, 2, 16, 16, 17]


def expected(data, library):
    out, start = [], 0
    for doc_id, text, *_ in sorted(data, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("block_ids", [1, 500, 1 << 18])
def test_file_read_back_matches_the_library(spark, tmp_path, library, block_ids):
    data = odd_rows() + rows([prose(s, 200) for s in range(30)], 100)
    random.Random(1).shuffle(data)
    docs = clashing(spark.createDataFrame(data, SCHEMA)).repartition(5)
    target = str(tmp_path / "file")
    tokenfile.write(docs, target, PATH, P.PATTERN, 0, block_ids=block_ids)
    found = [
        (r.doc_id, r.start, r.n_tokens, zlib.crc32(bytes(r.ids)))
        for r in tokenfile.read(spark, target).collect()
    ]
    assert sorted(found, key=lambda r: r[1]) == expected(data, library)
    one = tokenfile.read_document(spark, target, 105)
    assert [p.tolist() for p in one] == [library.encode(prose(5, 200)).ids + [0]]
    assert len(tokenfile.read_document(spark, target, 3)) == 2  # a repeated id


def test_every_code_point_as_the_library(library):
    own = tokenfile.encoder(open(PATH, "rb").read())
    points = [chr(c) for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c} {c}1{c}" for c in points[i : i + 64]) for i in range(0, len(points), 64)]
    ids, counts = own.encode(texts, P.PATTERN)
    parts = np.split(ids, np.cumsum(counts)[:-1])
    wrong = [i for i, (t, p) in enumerate(zip(texts, parts)) if library.encode(t).ids != p.tolist()]
    assert not wrong


def test_empty_table(spark, tmp_path):
    target = str(tmp_path / "file")
    tokenfile.write(spark.createDataFrame([], SCHEMA), target, PATH, P.PATTERN, 0)
    assert tokenfile.read(spark, target).collect() == []


def test_ids_that_are_no_numbers_and_texts_with_added_tokens(spark, tmp_path):
    data = [("b2", "one text"), ("7", "two <|endoftext|> texts"), (None, "three"), ("1.5x", "one text")]
    docs = spark.createDataFrame(data, "doc_id string, text string")
    path = str(tmp_path / "tokens")
    tokenfile.write(docs, path, P.path("byte_bpe_50k.json"), P.PATTERN, 0)
    found = sorted((str(r.doc_id), r.n_tokens) for r in tokenfile.read(spark, path).collect())
    own = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    expected = [
        ("7" if i == "7" else "None", len(own.encode(t, add_special_tokens=False).ids) + 1) for i, t in data
    ]
    assert found == sorted(expected)


def test_many_texts_with_added_tokens_take_linear_time():
    own = tokenfile.encoder(open(P.path("byte_bpe_50k.json"), "rb").read())
    took = []
    for n in (2_000, 8_000):
        began = time.process_time()
        own.encode(["a <|endoftext|>"] * n, P.PATTERN)
        took.append(time.process_time() - began)
    assert took[1] < 10 * max(took[0], 0.02)
