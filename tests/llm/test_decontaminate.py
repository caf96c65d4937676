import random

import numpy as np
import pytest
import regex

from cases_llm import SCHEMA, clashing, odd_rows, prose, rows
from spintally.llm import decontaminate as dec

ITEMS = [
    (1, "Anna has 12 apples and buys 5 kg more. How many apples does Anna have after 3 days?"),
    (2, prose(50, 40)),
    (3, "two words"),
    (4, None),
    (5, ""),
    (6, "A train leaves at 9:30 with Peter Miller on board. It travels 120 km in 2 hours. How fast is it?"),
    (7, prose(51, 12) + " " + prose(51, 12)),
]
DOCS = [
    prose(1, 60) + " " + ITEMS[0][1] + " " + prose(2, 60),
    prose(1, 60) + " Anna has 7 apples and buys 9 kg more. How many apples does Anna have after 4 days? " + prose(2, 30),
    ITEMS[1][1].upper() + "!",
    "two words",
    "Two words.",
    prose(3, 300),
    "A train leaves at 7:15 with John Paul Smith on board. It travels 300 miles in 4 hours. How fast is it?",
    prose(50, 40)[:60],
    "x y " + ITEMS[6][1],
    # the template of an item, its one value replaced in several ways
    "A train leaves at 9:30 with Peter Miller on board. It travels",
]


def plain_tokens(text):
    """(template token, slot value or None) of a text."""
    out, before, unit_ok = [], "break", False
    merged = False
    for token in regex.findall(r"\d+(?:[.,:/]\d+)*|[^\W\d_]+(?:['’][^\W\d_]+)*|[$€£¥%]|[.!?\n]", text or ""):
        if token in ".!?\n":
            before = "break"
            continue
        lower = token.lower()
        if token[0].isdigit():
            kind, item = "number", ("<number>", lower)
        elif token in "$€£¥%":
            kind, item = "sign", ("<unit>", lower)
        elif lower in dec.UNITS:
            kind, item = "unit", ("<unit>", lower) if before == "number" else (lower, None)
        elif token[0].isupper() and len(token) > 1 and token[1:].islower():
            kind, item = "title", (lower, None) if before == "break" else ("<name>", lower)
        else:
            kind, item = "plain", (lower, None)
        if item[0] == "<name>" and out and out[-1][0] == "<name>" and before == "title" and merged:
            out[-1] = ("<name>", out[-1][1] + " " + lower)
        else:
            out.append(item)
        merged = item[0] == "<name>"
        before = kind
    return out


def with_roles(tokens):
    """Numbers as slot values together with the next words on both sides, any name being alike."""
    out = []
    for i, (template, value) in enumerate(tokens):
        if template == "<number>":
            left = next((t for t, v in reversed(tokens[:i]) if v is None or t == "<name>"), "")
            right = next((t for t, v in tokens[i + 1 :] if v is None or t == "<name>"), "")
            value = (value, left, right)
        out.append((template, value))
    return out


def plain_windows(text, size=5, roles=False):
    tokens = with_roles(plain_tokens(text)) if roles else plain_tokens(text)
    n = len(tokens)
    count = 0 if not n else max(1, n - size + 1)
    return [
        (tuple(t for t, _ in tokens[i : i + size]), tuple(v for _, v in tokens[i : i + size] if v is not None))
        for i in range(count)
    ]


def plain_pairs(data):
    out = set()
    for doc_id, text, *_ in data:
        have = {}
        for template, slots in plain_windows(text):
            have.setdefault(template, set()).add(slots)
        for item_id, item in ITEMS:
            windows = plain_windows(item, roles=True)
            hits = [(i, s, d) for i, (t, s) in enumerate(windows) for d in have.get(t, ())]
            if not hits:
                continue
            votes, slots = {}, set()
            for i, s, d in hits:
                for k, (a, b) in enumerate(zip(s, d)):
                    votes.setdefault(a, {}).setdefault(b, set()).add((i, k))
                    slots.add((i, k))
            held = sum(max(map(len, own.values())) for own in votes.values()) / len(slots) if slots else 1.0
            matched = len({i for i, _, _ in hits})
            cover = matched / len(windows)
            out.add((doc_id, item_id, len(windows), matched, round(cover, 9), round(held, 9), cover >= 0.8 and held >= 0.8))
    return out


def noisy(seed):
    rng = random.Random(seed)
    words = " ".join(t for _, t in ITEMS if t).split()
    return " ".join(rng.choice(words + ["7", "Maria", "kg", "%"]) for _ in range(60))


@pytest.mark.parametrize("power", [dec.FILTER_POWER, 7])
def test_pairs_as_brute_force(spark, power):
    data = odd_rows() + rows(DOCS, 100) + rows([noisy(s) for s in range(60)], 200)
    docs = clashing(spark.createDataFrame(data, SCHEMA)).repartition(4)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = {
        (r.doc_id, r.item_id, r.n_windows, r.n_matched, round(r.coverage, 9), round(r.slot_consistency, 9), r.contaminated)
        for r in dec.contamination(docs, items, filter_power=power).collect()
    }
    assert found == plain_pairs(data)
    fewer = dec.contamination(docs, items, filter_power=power, all_pairs=False).filter("contaminated")
    assert sorted((r.doc_id, r.item_id) for r in fewer.collect()) == sorted((f[0], f[1]) for f in found if f[-1])
    bad = {(d, i) for d, i, *_, hit in found if hit}
    assert {(100, 1), (101, 1), (102, 2), (103, 3), (106, 6), (108, 7)} <= bad
    assert not any(d in (105, 107, 109) for d, _ in bad)


def test_rows_that_stay(spark):
    data = odd_rows() + rows(DOCS, 100) + [(None, DOCS[0], None, None, None)]
    docs = clashing(spark.createDataFrame(data, SCHEMA))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = dec.decontaminated(docs, items)
    assert kept.columns == docs.columns
    hit = {d for d, _, _, _, _, _, bad in plain_pairs(data) if bad}
    expected = sorted((str(d), str(t)) for d, t, *_ in data if d not in hit or t == "no id at all")
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == expected


def test_inconsistent_slots_do_not_count(spark):
    item = [(1, "Value 5 is red. Value 5 is blue. Value 5 is green. Value 5 is black. Value 5 is white here now.")]
    same = "Value 8 is red. Value 8 is blue. Value 8 is green. Value 8 is black. Value 8 is white here now."
    other = "Value 1 is red. Value 2 is blue. Value 3 is green. Value 4 is black. Value 6 is white here now."
    docs = spark.createDataFrame(rows([same, other]), SCHEMA)
    found = {r.doc_id: r for r in dec.contamination(docs, spark.createDataFrame(item, "item_id long, text string")).collect()}
    assert found[0].contaminated and not found[1].contaminated
    assert found[1].coverage == 1.0 and found[1].slot_consistency < 0.5


def hits(spark, items, texts, **options):
    table = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = dec.contamination(spark.createDataFrame(rows(texts), SCHEMA), table, **options)
    return {(r.doc_id, r.item_id) for r in found.filter("contaminated").collect()}


def test_names_at_sentence_starts_and_of_other_forms(spark):
    items = [
        "Tom has 3 apples. Mary has 5 apples. How many do they have together?",
        "One day McDonald sells 12 pears to Ann for 3 dollars. Then McDonald eats 2 of them. How many pears are left?",
        "Paris",
        "Two words",
    ]
    texts = [
        "x y. Tom has 4 apples. Lucy has 6 apples. How many do they have together? z",
        "x y. Ben has 4 apples. Lucy Lee has 6 apples. How many do they have together? z",
        "One day Baker sells 15 pears to Sue for 4 dollars. Then Baker eats 3 of them. How many pears are left?",
        items[1].upper(),
        items[1].lower(),
        "Hello",  # one capitalised word is no copy of another
        "Green words",
        "Tom has 4 friends. Mary has 6 cats. How old is the dog?",
    ]
    for power in (dec.FILTER_POWER, 8):
        assert hits(spark, items, texts, filter_power=power) == {(0, 0), (1, 0), (2, 1), (3, 1), (4, 1)}


def test_one_number_in_several_roles(spark):
    items = [
        "If 5 apples cost 5 dollars and 5 pears cost 5 dollars, what do 5 plums cost?",
        "Tom buys 5 apples and 5 pears at the market on his way home.",
        "Value 5 is red. Value 5 is blue. Value 5 is green. Value 5 is black. Value 5 is white here now.",
    ]
    texts = [
        "If 7 apples cost 9 dollars and 4 pears cost 8 dollars, what do 3 plums cost?",
        "Tom buys 7 apples and 9 pears at the market on his way home.",
        "x. Tom buys 12 apples and 5 pears at the market on his way home. y",
        # one role, several replacements
        "Value 1 is red. Value 2 is blue. Value 3 is green. Value 4 is black. Value 6 is white here now.",
        "Value 3 is red. Value 3 is blue. Value 3 is green. Value 3 is black. Value 3 is white here now.",
        "Tom reads 7 books and 9 letters at the desk on his way home.",
    ]
    assert hits(spark, items, texts) == {(0, 0), (1, 1), (2, 1), (4, 2)}


def plain_role_pairs(items, data):
    """Contaminated pairs by windows and roles, for texts without names."""
    out = set()
    for d, text in enumerate(data):
        have = {}
        for template, slots in plain_windows(text):
            have.setdefault(template, []).append(slots)
        for i, item in enumerate(items):
            windows = plain_windows(item, roles=True)
            matched = [(w, s) for w, (t, s) in enumerate(windows) if t in have]
            replaced, places = {}, set()
            for w, slots in matched:
                for other in have[windows[w][0]]:
                    for k, (key, value) in enumerate(zip(slots, other)):
                        replaced.setdefault(key, {}).setdefault(value, set()).add((w, k))
                        places.add((w, k))
            held = sum(max(map(len, own.values())) for own in replaced.values())
            if len(matched) >= 0.8 * len(windows) and held >= 0.8 * len(places):
                out.add((d, i))
    return out


def test_roles_as_brute_force(spark):
    rng = random.Random(12)
    things = ["apples", "pears", "plums", "pens", "books"]
    items, texts = [], []
    for kinds in (1, 1, 1, 1, 1, 1, 2, 2, 2, 3, 4, 5):
        parts = [
            f"{rng.choice([5, 5, 5, 8])} {rng.choice(things[:kinds])} are {''.join(rng.choices('bdfgk', k=9))}"
            for _ in range(6)
        ]
        items.append("we say " + " and ".join(parts) + " all of us")
    for _ in range(150):
        words = rng.choice(items).split()
        same, noise = {}, rng.choice([0, 0.1, 0.8])
        for k, word in enumerate(words):
            if word.isdigit():
                own = same.setdefault((word, words[k + 1]), rng.randrange(2, 99))
                words[k] = str(own if rng.random() >= noise else rng.randrange(100, 999))
        texts.append(" ".join(words))
    expected = plain_role_pairs(items, texts)
    table = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = dec.contamination(
        spark.createDataFrame(rows(texts), SCHEMA), table, min_covered_tokens=10**6
    )
    got = {(r.doc_id, r.item_id) for r in found.filter("contaminated").collect()}
    assert got == expected and 20 < len({d for d, _ in got}) < 140


def test_filter_rules_no_window_out(spark):
    rng = random.Random(3)
    held = [rng.randrange(-(2**63), 2**63) for _ in range(3000)] + [0, -1, 2**63 - 1, -(2**63)]
    table = spark.createDataFrame([(h,) for h in held], "hash long")
    for power, most in ((dec.FILTER_POWER, 2), (16, 300), (6, 3000)):
        made = dec.filter_of(table, power)
        assert len(made.among(np.array(held, np.int64))) == len(held)
        others = np.array([rng.randrange(-(2**63), 2**63) for _ in range(3000)], np.int64)
        assert len(made.among(others)) <= most
    assert len(dec.filter_of(table.limit(0), 10).among(np.array(held, np.int64))) == 0


def plain_covered(item, doc, size=5):
    """Share of the item's words in windows that the document has, for plain words only."""
    a, b = item.lower().split(), doc.lower().split()
    have = {tuple(b[i : i + size]) for i in range(len(b) - size + 1)}
    held = {i + k for i in range(len(a) - size + 1) if tuple(a[i : i + size]) in have for k in range(size)}
    return len(held) / len(a)


def test_edited_words_and_parts_of_items_as_brute_force(spark):
    rng = random.Random(7)
    words = ["b" + "".join(rng.choice("aeioudfk") for _ in range(7)) for _ in range(4000)]
    items = [" ".join(rng.choice(words) for _ in range(n)) for n in (8, 12, 15, 28, 40, 120)]
    texts = []
    for item in items:
        words = item.split()
        n = len(words)
        for at in rng.sample(range(n), min(n, 8)):
            texts.append(" ".join([*words[:at], "changed", *words[at + 1 :]]))
            texts.append(" ".join(words[:at] + words[at + 1 :]))
            texts.append(" ".join([*words[:at], "added", *words[at:]]))
        texts += [" ".join(words[: n * k // 12]) + " and so on" for k in (2, 5, 6, 7, 8, 9)]
        texts.append(" ".join("other" if i in (n // 3, 2 * n // 3) else w for i, w in enumerate(words)))
    texts += [prose(77, 300), prose(78, 300)]
    expected = {}
    for d, text in enumerate(texts):
        for i, item in enumerate(items):
            share = plain_covered(item, text)
            if share:
                expected[d, i] = round(share, 9)
    table = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    made = dec.contamination(spark.createDataFrame(rows(texts), SCHEMA), table).collect()
    assert {(r.doc_id, r.item_id): round(r.covered, 9) for r in made} == expected
    bad = {(r.doc_id, r.item_id) for r in made if r.contaminated}
    sizes = [len(item.split()) for item in items]
    assert bad == {(d, i) for (d, i), c in expected.items() if c >= 0.6 and round(c * sizes[i]) >= 8}
    two_changed = sum(r.contaminated and r.coverage < 0.8 for r in made)
    assert two_changed > 30  # not found by the share of windows


def test_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert dec.contamination(spark.createDataFrame([], SCHEMA), items).collect() == []
    assert dec.contamination(spark.createDataFrame(rows(DOCS), SCHEMA), none).collect() == []
