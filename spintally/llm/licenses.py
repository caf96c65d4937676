"""License scans: templates with optional and replaceable regions as token automata.

A template is text with markup. Words outside markup are mandatory and must match
exactly, in order, after lower-casing and dropping punctuation. ``[[ ... ]]`` is
optional and may nest; ``{{a|b c|d}}`` takes one of the alternatives; ``{{*n}}`` takes
up to n words of any kind, fewest first. Each template becomes an automaton over words;
it accepts where a run of words leads from its start to its end. A text is searched
only from where a template's longest mandatory run of words stands.

Defined results: null, empty and blank texts have no words, no places and no labels,
null first and last words and score zero; repeated rows are judged one by one; an
empty table gives an empty result; kept columns named like a new one give way to it.
Texts are read whole: a template is tried only where its anchor stands, so time grows
with the text's length, and memory with it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from spintally.llm.rows import map_texts

#: Phrases whose places are counted, with their labels.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

TEMPLATES = {
    "apache-2.0": "licensed under [[the]] apache license [[,]] {{version 2.0|2.0|v2}} "
    "[[(the \"license\")]] [[you may not use this [[file|work]] except in compliance with the license]]",
    "cc-by-4.0": "licensed under [[a|the]] {{cc by|creative commons attribution}} 4.0 [[international]] [[license]]",
    "cc-by-sa-4.0": "licensed under [[a|the]] {{cc by sa|creative commons attribution sharealike|"
    "creative commons attribution share alike}} 4.0 [[international]] [[license]]",
    "cc-by-nc-4.0": "licensed under [[a|the]] {{cc by nc|creative commons attribution noncommercial|"
    "creative commons attribution non commercial}} 4.0 [[international]] [[license]]",
    "cc-by-nc-sa-4.0": "licensed under [[a|the]] {{cc by nc sa|creative commons attribution "
    "noncommercial sharealike}} 4.0 [[international]] [[license]]",
    "gpl-2.0": "{{licensed|released|distributed|it}} under the [[terms of the]] gnu general public license "
    "[[as published by the free software foundation]] [[;]] [[either]] version 2 [[of the license]] "
    "[[or [[(at your option)]] any later version]]",
    "gpl-3.0": "{{licensed|released|distributed|it}} under the [[terms of the]] gnu general public license "
    "[[as published by the free software foundation]] [[,]] [[either]] version 3 [[of the license]] "
    "[[or [[(at your option)]] any later version]]",
    "lgpl-2.1": "under the [[terms of the]] gnu lesser general public license [[as published by the "
    "free software foundation]] [[either]] version 2.1 [[of the license]]",
    "lgpl-3.0": "under the [[terms of the]] gnu lesser general public license [[as published by the "
    "free software foundation]] [[either]] version 3 [[of the license]]",
    "agpl-3.0": "under the [[terms of the]] gnu affero general public license [[as published by the "
    "free software foundation]] [[either]] version 3 [[of the license]]",
    "mpl-2.0": "subject to the terms of the mozilla public license [[,]] [[v.]] {{2.0|version 2.0}}",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "all-rights-reserved": "[[copyright [[(c)]] [[{{*8}}]]]] all rights reserved",
}

_UNDER = "{{licensed|released|distributed|available|provided|published}} under [[a|an|the]] [[terms of the]]"
_CLAUSES = "[[{{2|3|4|two|three|four}} clause]]"
_KINDS = "[[new|modified|revised|simplified|original]]"
#: Short notices, by the name of a license instead of its wording; a label may stand twice.
NOTICES = tuple(
    (label, f"{_UNDER} {template} {word}{then}")
    for word in ("license", "licence")
    for label, template, then in (
        ("mit", "mit", ""),
        ("bsd", f"{_CLAUSES} {_KINDS} bsd {_CLAUSES}", ""),
        ("isc", "isc", ""),
        ("mpl", "mozilla public", ""),
        ("mpl-2.0", "mozilla public", " [[,]] {{2.0|v2.0|v. 2.0|version 2.0}}"),
    )
)

#: The openings of long wordings. Alone they say little, as the conditions below may be others.
HEADS = {
    "mit": "permission is hereby granted, free of charge, to any person obtaining a copy of "
    "{{this software|this font software|the software}} and associated documentation files "
    "[[(the \"software\")]], to deal in the software without restriction",
    "isc": "permission to use, copy, modify, {{and|and or}} distribute this software for any purpose "
    "with or without fee is hereby granted",
    "bsd": "redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met",
}
HEAD_SCORE = 0.75

_BSD_SOURCE = (
    "redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met: [[1.]] redistributions of source code must retain "
    "the above copyright notice, this list of conditions and the following disclaimer. [[2.]] "
    "redistributions in binary form must reproduce the above copyright notice, this list of conditions "
    "and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution."
)
_BSD_NAME = (
    "[[3.]] neither the name of [[the]] {{*8}} nor the names of {{its|their|the}} contributors may be "
    "used to endorse or promote products derived from this software without specific prior written "
    "permission."
)
_BSD_DISCLAIMER = (
    "this software is provided by {{the copyright holders and contributors|the author and contributors|"
    "the regents and contributors}} \"as is\" and any express or implied warranties, including, but not "
    "limited to, the implied warranties of merchantability and fitness for a particular purpose are "
    "disclaimed. in no event shall {{the copyright holder or contributors|the copyright holders or "
    "contributors|the copyright owner or contributors|the author or contributors|the regents or "
    "contributors}} be liable for any direct, indirect, incidental, special, exemplary, or consequential "
    "damages (including, but not limited to, procurement of substitute goods or services; loss of use, "
    "data, or profits; or business interruption) however caused and on any theory of liability, whether "
    "in contract, strict liability, or tort (including negligence or otherwise) arising in any way out "
    "of the use of this software, even if advised of the possibility of such damage."
)
#: Whole wordings, with every condition and disclaimer.
WORDINGS = {
    "mit": "permission is hereby granted, free of charge, to any person obtaining a copy of "
    "{{this software|the software}} and associated documentation files [[(the \"software\")]], to deal "
    "in the software without restriction, including without limitation the rights to use, copy, modify, "
    "merge, publish, distribute, sublicense, and/or sell copies of the software, and to permit persons "
    "to whom the software is furnished to do so, subject to the following conditions: the above "
    "copyright notice and this permission notice [[(including the next paragraph)]] shall be included in "
    "all copies or substantial portions of the software. the software is provided \"as is\", without "
    "warranty of any kind, express or implied, including but not limited to the warranties of "
    "merchantability, fitness for a particular purpose and noninfringement. in no event shall [[the]] "
    "{{*8}} be liable for any claim, damages or other liability, whether in an action of contract, tort "
    "or otherwise, arising from, out of or in connection with the software or the use or other dealings "
    "in the software.",
    "isc": "permission to use, copy, modify, {{and|and or}} distribute this software for any purpose with "
    "or without fee is hereby granted, provided that the above copyright notice and this permission "
    "notice appear in all copies. the software is provided \"as is\" and {{*8}} disclaims all warranties "
    "with regard to this software including all implied warranties of merchantability and fitness. in no "
    "event shall {{*8}} be liable for any special, direct, indirect, or consequential damages or any "
    "damages whatsoever resulting from loss of use, data or profits, whether in an action of contract, "
    "negligence or other tortious action, arising out of or in connection with the use or performance of "
    "this software.",
    "bsd-2-clause": f"{_BSD_SOURCE} {_BSD_DISCLAIMER}",
    "bsd-3-clause": f"{_BSD_SOURCE} {_BSD_NAME} {_BSD_DISCLAIMER}",
    "apache-2.0": "licensed under the apache license, version 2.0 (the \"license\"); you may not use this "
    "{{file|work}} except in compliance with the license. you may obtain a copy of the license at "
    "{{http|https}}://www.apache.org/licenses/license-2.0 [[.html]] unless required by applicable law or "
    "agreed to in writing, software distributed under the license is distributed on an \"as is\" basis, "
    "without warranties or conditions of any kind, either express or implied. see the license for the "
    "specific language governing permissions and limitations under the license.",
}
#: What is searched by default: (label, template, score).
ALL = (
    *((label, template, 1.0) for label, template in TEMPLATES.items()),
    *((label, template, 1.0) for label, template in NOTICES),
    *((label, template, 1.0) for label, template in WORDINGS.items()),
    *((label, template, HEAD_SCORE) for label, template in HEADS.items()),
)

#: Every byte that is no digit, letter or part of a wider character parts words.
_WORDS = bytes(
    byte + 32 if 0x41 <= byte <= 0x5A
    else byte if 0x30 <= byte <= 0x39 or 0x61 <= byte <= 0x7A or byte >= 0x80
    else 0x20
    for byte in range(256)
)


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_WORDS).split()


ANY = None


@dataclass
class Automaton:
    """States over words: ``step[state]`` has (word or ANY, next), ``free[state]`` moves without one."""

    step: list[list[tuple[bytes | None, int]]] = field(default_factory=lambda: [[]])
    free: list[list[int]] = field(default_factory=lambda: [[]])
    runs: list[list[bytes]] = field(default_factory=lambda: [[]])

    def state(self) -> int:
        self.step.append([])
        self.free.append([])
        return len(self.step) - 1

    def words(self, at: int, words: list[bytes], mandatory: bool) -> int:
        for word in words:
            then = self.state()
            self.step[at].append((word, then))
            at = then
        if mandatory:
            self.runs[-1] += words
        elif words:
            self.runs.append([])
        return at

    def closure(self, states: set[int]) -> set[int]:
        todo, held = list(states), set(states)
        while todo:
            for then in self.free[todo.pop()]:
                if then not in held:
                    held.add(then)
                    todo.append(then)
        return held

    def accepts(self, words: list[bytes], begin: int) -> int | None:
        """End of the shortest accepted run of words from ``begin``, if there is one."""
        states = self.closure({0})
        at = begin
        while states:
            if self.final in states:
                return at
            if at == len(words):
                return None
            word = words[at]
            then = {b for s in states for a, b in self.step[s] if a is ANY or a == word}
            states = self.closure(then)
            at += 1
        return None


def compile_template(template: str) -> Automaton:
    """The automaton of a template's markup."""
    parts = re.findall(r"\[\[|\]\]|\{\{\*\d+\}\}|\{\{[^}]*\}\}|[^\[\]{}]+", template)
    out = Automaton()
    at, opened = 0, []
    for part in parts:
        if part == "[[":
            opened.append(at)
            out.runs.append([])
        elif part == "]]":
            begin = opened.pop()
            then = out.state()
            out.free[at].append(then)
            out.free[begin].append(then)
            at = then
            out.runs.append([])
        elif part.startswith("{{*"):
            ends = [at]
            for _ in range(int(part[3:-2])):
                then = out.state()
                out.step[ends[-1]].append((ANY, then))
                ends.append(then)
            join = out.state()
            for end in ends:
                out.free[end].append(join)
            at = join
            out.runs.append([])
        else:
            options = part[2:-2].split("|") if part.startswith("{{") else part.split("|")
            if len(options) == 1:
                at = out.words(at, words_of(options[0]), mandatory=not opened)
                continue
            out.runs.append([])
            ends = [out.words(at, words_of(option), mandatory=False) for option in options]
            join = out.state()
            for end in ends:
                out.free[end].append(join)
            at = join
            out.runs.append([])
    if opened:
        raise ValueError(f"unclosed optional region: {template}")
    out.final = at
    return out


@dataclass(frozen=True)
class Compiled:
    label: str
    automaton: Automaton
    anchor: bytes
    #: How many words may stand before the anchor within the template.
    reach: int
    score: float


@lru_cache(maxsize=4)
def compiled(templates: tuple[tuple, ...]) -> list[Compiled]:
    """Automata of (label, template) or (label, template, score); the score is 1 by default."""
    out = []
    for label, template, *score in templates:
        automaton = compile_template(template)
        run = max(automaton.runs, key=lambda words: (len(words), sum(map(len, words))))
        if not run:
            raise ValueError(f"a template needs a mandatory word: {label}")
        anchor = b" " + b" ".join(run) + b" "
        out.append(Compiled(label, automaton, anchor, len(automaton.step), *score or (1.0,)))
    return out


def places(joined: bytes, phrase: bytes) -> list[int]:
    """Words before each place of ``phrase`` in words joined and surrounded by spaces."""
    out, at, seen, counted = [], joined.find(phrase), 0, 0
    while at >= 0:
        counted += joined.count(b" ", seen, at)
        seen = at
        out.append(counted)
        at = joined.find(phrase, at + 1)
    return out


def scan(text: str, templates: list[Compiled]) -> tuple:
    words = words_of(text)
    joined = b" " + b" ".join(words) + b" "
    starts, base = [], set()
    for phrase, label in BASE_PHRASES.items():
        found = places(joined, f" {phrase} ".encode())
        if found:
            starts += found
            base.add(label)
    accepted, best = [], 0.5 if base else 0.0
    for one in templates:
        tried = -1
        for anchor in places(joined, one.anchor):
            for begin in range(max(tried + 1, anchor - one.reach), anchor + 1):
                end = one.automaton.accepts(words, begin)
                if end is not None and end > anchor:
                    accepted.append((one.label, begin, end))
                    best = max(best, one.score)
                    break
            tried = anchor
    labels = sorted(base | {label for label, _, _ in accepted})
    return (
        len(words),
        len(starts),
        min(starts, default=None),
        max(starts, default=None),
        sorted(base),
        labels,
        [{"label": a, "first_word": b, "end_word": c} for a, b, c in accepted],
        best,
    )


FIELDS = (
    "n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
    "labels array<string>, accepted array<struct<label:string,first_word:long,end_word:long>>, "
    "score double"
)
TYPES = [
    *[pa.int64()] * 4,
    *[pa.list_(pa.string())] * 2,
    pa.list_(
        pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64())])
    ),
    pa.float64(),
]


def find_licenses(
    docs: DataFrame,
    text_col: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    templates: dict[str, str] | None = None,
) -> DataFrame:
    """``keep`` columns, word and phrase counts, labels and accepted runs, one row per input row.

    ``score`` is 1 where a template accepts, 0.75 where only the opening of a long wording
    stands, 0.5 where only a phrase does, else 0. Without ``templates`` the references,
    short notices, whole wordings and their openings are searched (``ALL``).
    """
    own = ALL if templates is None else tuple(templates.items())

    def compute(texts):
        made = [scan(text, compiled(own)) for text in texts]
        return [pa.array([row[i] for row in made], kind) for i, kind in enumerate(TYPES)]

    return map_texts(docs, compute, FIELDS, text_col, keep)
