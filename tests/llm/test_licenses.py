import random
import re

import duckdb
import pytest

from cases_llm import SCHEMA, clashing, odd_rows, rows
from spintally.llm import licenses, queries

TEXTS = [
    "Licensed under CC BY-NC 4.0.",
    "Licensed under the Apache License, Version 2.0.",
    "This work is licensed under the GNU General Public License, version 3.",
    "All rights reserved. all RIGHTS-reserved; all rights are reserved",
    "CC BY_SA cc0by cc by",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    'associated documentation files (the "Software"), to deal in the Software without restriction',
    "licensed under the apache license version 1.0",
    "general public license general public license",
    "écc by cc byé cc é by",
]


def plain_words(text):
    out, word = [], ""
    for c in (text or "") + " ":
        c = chr(ord(c) + 32) if "A" <= c <= "Z" else c
        if c >= "\x80" or "0" <= c <= "9" or "a" <= c <= "z":
            word += c
        else:
            out += [word] if word else []
            word = ""
    return out


def plain(text):
    words = plain_words(text)
    places, labels = [], set()
    for phrase, label in [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]:
        own = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(own)] == own:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def noisy(seed):
    rng = random.Random(seed)
    parts = ["cc", "by", "general", "public", "license", "all", "rights", "reserved", "é", "x"]
    return "".join(rng.choice(parts) + rng.choice([" ", "-", ", ", "", "\n"]) for _ in range(30))


def test_base_places_as_brute_force(spark, tmp_path):
    data = odd_rows() + rows(TEXTS, 100) + rows([noisy(s) for s in range(200)], 200)
    spark.createDataFrame(data, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op9_license_scan(spark, str(tmp_path)).collect()
    got = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in found]
    assert sorted(got, key=str) == sorted(((d, *plain(t)) for d, t, *_ in data), key=str)
    assert all(0 <= r.score <= 1 and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) for r in found)


def test_templates_on_real_wordings(spark):
    docs = clashing(spark.createDataFrame(rows(TEXTS), SCHEMA))
    labels = {r.doc_id: r.labels for r in licenses.find_licenses(docs).collect()}
    assert labels[0] == ["cc-by", "cc-by-nc-4.0"]
    assert labels[1] == ["apache-2.0"]
    assert labels[2] == ["gpl", "gpl-3.0"]
    assert labels[3] == ["all-rights-reserved", "reserved"]
    assert labels[5] == ["mit"]
    assert labels[6] == []


@pytest.mark.parametrize(
    "text, labels",
    [
        ("Licensed under the Apache License, Version 2.0.", ["apache-2.0"]),
        ("Released under the MIT License.", ["mit"]),
        ("This work is licensed under the GNU General Public License, version 3.", ["gpl", "gpl-3.0"]),
        ("All rights reserved.", ["all-rights-reserved", "reserved"]),
        ("Licensed under CC BY-NC 4.0.", ["cc-by", "cc-by-nc-4.0"]),
        ("distributed under the terms of the MIT licence", ["mit"]),
        ("It is licensed under the BSD license.", ["bsd"]),
        ("Licensed under a 3-clause BSD License", ["bsd"]),
        ("released under the BSD 2-Clause License", ["bsd"]),
        ("Licensed under the ISC license", ["isc"]),
        ("available under the terms of the Mozilla Public License, v. 2.0", ["mpl", "mpl-2.0"]),
        ("released under the Mozilla Public License 1.1", ["mpl"]),
        ("released under the mitigation license; an MIT course; the BSD license", []),
    ],
)
def test_license_lines_of_the_documents_and_short_notices(text, labels):
    own = licenses.compiled(licenses.ALL)
    found = licenses.scan(f"Some words before. {text} Some words after.", own)
    assert found[5] == labels
    assert found[7] == (1.0 if labels else 0.0)


def test_short_notices_by_default(spark):
    docs = spark.createDataFrame(rows(["x Released under the MIT License. y", "released under it"]), SCHEMA)
    found = {r.doc_id: (r.labels, r.score) for r in licenses.find_licenses(docs).collect()}
    assert found == {0: (["mit"], 1.0), 1: ([], 0.0)}


def plain_accepts(parts, words):
    """Whether ``words`` is one of the wordings of a parsed template."""
    if not parts:
        return not words
    kind, value = parts[0]
    if kind == "words":
        return words[: len(value)] == value and plain_accepts(parts[1:], words[len(value) :])
    if kind == "optional":
        return plain_accepts(parts[1:], words) or plain_accepts(value + parts[1:], words)
    if kind == "any":
        return any(plain_accepts(parts[1:], words[n:]) for n in range(min(value, len(words)) + 1))
    return any(plain_accepts([("words", v)] + parts[1:], words) for v in value)


@pytest.mark.parametrize(
    "template, parts",
    [
        ("a [[b [[c]]]] d", [("words", ["a"]), ("optional", [("words", ["b"]), ("optional", [("words", ["c"])])]), ("words", ["d"])]),
        ("a {{b|c d}} e", [("words", ["a"]), ("choice", [["b"], ["c", "d"]]), ("words", ["e"])]),
        ("[[a]] {{*2}} b c", [("optional", [("words", ["a"])]), ("any", 2), ("words", ["b", "c"])]),
    ],
)
def test_automata_accept_what_the_markup_says(template, parts):
    automaton = licenses.compile_template(template)
    rng = random.Random(1)
    for _ in range(600):
        words = [rng.choice("abcde") for _ in range(rng.randrange(6))]
        end = automaton.accepts([w.encode() for w in words], 0)
        ends = [n for n in range(len(words) + 1) if plain_accepts(parts, words[:n])]
        assert end == (ends[0] if ends else None)


def test_bad_templates_and_empty_table(spark):
    with pytest.raises(ValueError):
        licenses.compile_template("a [[b")
    with pytest.raises(ValueError):
        licenses.compiled((("x", "[[a]]"),))
    assert licenses.find_licenses(spark.createDataFrame([], SCHEMA)).collect() == []


def wording(label):
    """A text that a whole wording stands for: optional parts left in, first alternatives."""
    text = licenses.WORDINGS[label].replace("[[", "").replace("]]", "")
    text = re.sub(r"\{\{\*8\}\}", "Jane Doe and friends", text)
    return re.sub(r"\{\{([^|}]*)[^}]*\}\}", r"\1", text)


@pytest.mark.parametrize(
    "label, labels",
    [
        ("mit", ["mit"]), ("isc", ["isc"]), ("apache-2.0", ["apache-2.0"]),
        ("bsd-2-clause", ["bsd", "bsd-2-clause"]), ("bsd-3-clause", ["bsd", "bsd-3-clause"]),
    ],
)
def test_whole_wordings_and_altered_conditions(label, labels):
    own = licenses.compiled(licenses.ALL)
    text = wording(label)
    found = licenses.scan(f"Copyright 2020. {text.upper()} More words.", own)
    assert found[5] == labels and found[7] == 1.0
    words = text.split()
    altered = " ".join([*words[:-12], "but", "not", "for", "evil", *words[-12:]])
    found = licenses.scan(altered, own)
    assert label == "apache-2.0" or (found[5] == labels[:1] and found[7] == licenses.HEAD_SCORE)
    assert licenses.scan(" ".join(words[3:]), own)[7] < licenses.HEAD_SCORE


def test_sql_knows_all_templates(spark, tmp_path):
    texts = [*TEXTS, *(wording(x) for x in licenses.WORDINGS)]
    texts += [" ".join(t.split()[:-20]) + " and more" for t in texts[len(TEXTS) :]]
    texts += [
        f"x {under} the {name} {word} y"
        for under in ("Released under", "available under the terms of", "made under")
        for name in ("MIT", "BSD", "3-clause BSD", "new BSD 2-clause", "ISC", "Mozilla Public", "GPL")
        for word in ("License", "licence", "License, v. 2.0", "course")
    ]
    docs = spark.createDataFrame(rows(texts), SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    query = f"SELECT doc_id, labels, score, n_base FROM ({queries.ORACLE['op9_license_scan']})"
    expected = sorted(con.execute(query).fetchall())
    found = queries.op9_license_scan(spark, str(tmp_path)).select("doc_id", "labels", "score", "n_base")
    assert sorted(tuple(r) for r in found.collect()) == expected
    assert {s for _, _, s, _ in expected} == {0.0, 0.5, 0.75, 1.0}
