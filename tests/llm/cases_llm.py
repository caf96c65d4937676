"""Small tables with the rows every operator must stand."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

ODD_TEXTS = [
    None,
    "",
    " \t\n\r\x0b\x0c",
    "a",
    "\x00 nul \x1c\x1f separators \x85\xa0  　 wide",
    "naïve café — ЖЗ 漢字 🙂🙃 é́",
    "same text twice",
    "same text twice",
    "it's we're they'll I'd 12345 ½ ٣٤  two  spaces   end ",
    "x" * 5000,
    "word " * 3000,
    "<|endoftext|> is ordinary here",
]


def rows(texts, first=0):
    return [
        (first + i, text, "en", f"src{i % 3}", None if text is None else len(text))
        for i, text in enumerate(texts)
    ]


def odd_rows():
    """Every odd text, a repeated row, a row without id."""
    out = rows(ODD_TEXTS)
    return [*out, out[3], (None, "no id at all", None, None, None)]


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    names = [f"w{rng.randrange(10**6):x}o" for _ in range(vocabulary)]
    return " ".join(rng.choice(names) for _ in range(words))


def clashing(df):
    """Extra columns named like what operators make or use inside."""
    from pyspark.sql import functions as F

    names = ["ids", "n_tokens", "value", "k0", "fp", "component_id", "root", "key", "start", "spans"]
    return df.withColumns({name: F.lit("clash") for name in names})
