"""Tokens of texts read as bytes against those by the pattern."""

import cProfile
import pstats
import random

import numpy as np
import pytest

from cases_llm import ODD_TEXTS
from spintally.llm import decontaminate as dec

CHARACTERS = bytes(range(256)).decode(dec.CODEC, "ignore")
PIECES = [
    "Anna", "McDonald", "O'neil", "O’Neil", "d'", "'tis", "5", "7.5", "1,000", "9:30.", ".5", "5.", "kg", "KG",
    "m", "A", "I", "In", "%", "$", "€", "£", ".", "!", "\n", "½", "m²", "²5", "A½", "É", "Été", "ß", "ŒUVRE", "Œuvre",
    "œ", "Ÿ", "\0", "a_b", "x" * 70, "X" * 70, "X" + "x" * 80, "kilometers", "a" * 8, "a" * 9, "a" * 64, "a" * 65,
]
WIDE = ["\x85", "жук", "漢字", "Ω", "Kelvin", "kelvin", "ẞ", "İx", "ǅx", "\U0001f642"]


def read(tokens):
    n = len(tokens.kinds)
    pieces = [tokens.piece(i) for i in range(n)]
    return pieces, tokens.kinds.tolist(), tokens.hashes.tolist(), tokens.text.tolist(), tokens.before.tolist()


def mixed(seed, pieces):
    rng = random.Random(seed)
    return [
        "".join(rng.choice(pieces) + rng.choice(["", " ", " "]) for _ in range(rng.choice([0, 1, 3, 5, 60])))
        for _ in range(12)
    ]


@pytest.mark.parametrize("seed", range(20))
def test_bytes_give_the_tokens_of_the_pattern(seed):
    texts = mixed(seed, PIECES) + mixed(seed, list(CHARACTERS)) + mixed(seed, list("aA5.,:/'’ é%\n"))
    coded = dec.ByteTokens([text.encode(dec.CODEC) for text in texts])
    assert read(coded) == read(dec.FoundTokens(texts))


def test_every_character_of_the_codec():
    texts = [a + c + b for c in CHARACTERS for a, b in (("", ""), ("a", "a"), ("5", "5"), ("A", ""), ("", "b"))]
    coded = dec.ByteTokens([text.encode(dec.CODEC) for text in texts])
    assert read(coded) == read(dec.FoundTokens(texts))


@pytest.mark.parametrize("seed", range(5))
def test_both_kinds_of_texts_in_one_slice(seed):
    texts = [text or "" for text in ODD_TEXTS] + mixed(seed, PIECES + WIDE) + mixed(seed, PIECES)
    totals, windows = (column.to_pylist() for column in dec.windows_of(texts, 5, None))
    for text, total, own in zip(texts, totals, windows):
        alone = dec.windows_of([text], 5, None)
        assert (alone[0].to_pylist(), alone[1].to_pylist()) == ([total], [own])
    # the same words meet whatever else a text holds
    words = "we tell of Œuvre and Kelvin's 5 kg here"
    wide = {w["hash"] for w in dec.windows_of([words + " Ω"], 5, None)[1].to_pylist()[0]}
    assert {w["hash"] for w in dec.windows_of([words], 5, None)[1].to_pylist()[0]} < wide


def test_hashes_of_different_pieces_differ():
    rng = random.Random(5)
    pieces = {"a" * n for n in range(1, 200)} | {"".join(rng.choices("abéœ", k=rng.randrange(1, 30))) for _ in range(50_000)}
    assert len(set(dec.hashes_of(sorted(pieces)).tolist())) == len(pieces)


def test_new_words_cost_no_calls_of_their_own():
    def calls(n, seed):
        rng = random.Random(seed)
        text = " ".join("".join(rng.choices("abcdefgé", k=12)) for _ in range(n))
        profile = cProfile.Profile()
        profile.runcall(dec.windows_of, [text], 5, dec.Filter(np.zeros(1 << 4, np.uint64), 10))
        found = pstats.Stats(profile).stats.items()  # without what a garbage collection calls
        return sum(n_calls for (file, *_), (_, n_calls, *_) in found if file == dec.__file__)

    calls(100, 1)  # tables
    assert calls(20_000, 2) < calls(1_000, 3) + 500
