"""Labelled pages: small layouts in which the parts that belong to the article are marked.

``*`` after a tag marks a part as main text, ``-`` inside it as something else again. A
part keeps its parent's mark unless it has its own.
"""

from __future__ import annotations

import random

WORDS = (
    "river morning letter garden window market island winter paper signal harbour mountain "
    "kitchen silver weather engine village music teacher ladder bridge candle forest machine"
).split()

#: Stands first in a layout whose body is the article, but for what is marked otherwise.
MAIN_BODY = "main body"

# One layout per line group: nested (tag, attributes, mark, children); a string names a filler.
LAYOUTS = [
    # plain semantic page
    [
        ("nav", "", "", [("ul", "", "", ["links"])]),
        ("div", 'class="ad"', "", ["sentence"]),
        ("article", "", "*", [("h1", "", "", ["title"]), "paragraphs", ("p", "", "", ["short"])]),
        ("footer", "", "", ["legal"]),
    ],
    # article with things inside that are not part of it
    [
        ("header", "", "", [("div", 'class="logo"', "", ["short"]), ("nav", "", "", ["links"])]),
        ("main", "", "*", [
            ("h1", "", "", ["title"]),
            "paragraphs",
            ("div", 'class="advert"', "-", ["sentence"]),
            ("aside", 'class="related"', "-", [("h3", "", "", ["short"]), ("ul", "", "", ["links"])]),
            ("blockquote", "", "", ["sentence"]),
            "paragraphs",
            ("div", 'class="share social"', "-", ["links"]),
        ]),
        ("section", 'id="comments"', "", [("h2", "", "", ["short"]), "comments"]),
        ("footer", "", "", ["legal", ("ul", "", "", ["links"])]),
    ],
    # divs only, with telling names
    [
        ("div", 'id="cookie-notice"', "", [("p", "", "", ["sentence"]), ("button", "", "", ["short"])]),
        ("div", 'id="header"', "", [("ul", 'class="menu"', "", ["links"])]),
        ("div", 'id="content"', "*", [("h2", "", "", ["title"]), "paragraphs", ("ul", "", "", ["items"]), "paragraphs"]),
        ("div", 'id="sidebar"', "", [("h3", "", "", ["short"]), ("p", "", "", ["sentence"]), ("ul", "", "", ["links"])]),
        ("div", 'class="comment-list"', "", ["comments"]),
        ("div", 'id="footer"', "", [("p", "", "", ["legal"])]),
    ],
    # divs without names
    [
        ("div", "", "", ["links"]),
        ("div", "", "*", [("h1", "", "", ["title"]), "paragraphs", "paragraphs"]),
        ("div", "", "", ["links"]),
        ("div", "", "", ["legal"]),
    ],
    # forms, tables, code and figures
    [
        ("header", "", "", [("form", 'class="search"', "", [("label", "", "", ["short"]), ("button", "", "", ["short"])])]),
        ("article", 'class="post"', "*", [
            ("header", "", "", [("h1", "", "", ["title"])]),
            "paragraphs",
            ("table", "", "", [("tr", "", "", [("td", "", "", ["short"]), ("td", "", "", ["short"])])]),
            ("pre", "", "", ["sentence"]),
            ("figure", "", "", [("figcaption", "", "", ["sentence"])]),
            ("form", 'class="newsletter"', "-", [("p", "", "", ["sentence"]), ("button", "", "", ["short"])]),
            "paragraphs",
            ("div", 'class="comments"', "-", ["comments"]),
        ]),
        ("aside", "", "", [("p", "", "", ["sentence"]), "paragraphs"]),
        ("footer", "", "", ["legal"]),
    ],
    # notices and roles
    [
        ("div", 'role="banner"', "", ["short", ("div", 'role="navigation"', "", ["links"])]),
        ("div", 'class="alert notice" role="alert"', "", [("p", "", "", ["sentence"])]),
        ("div", 'role="main"', "*", [
            ("section", "", "", [("h2", "", "", ["title"]), "paragraphs"]),
            ("section", "", "", [("h2", "", "", ["title"]), "paragraphs", ("ol", "", "", ["items"])]),
            ("div", 'class="sponsored promo"', "-", [("p", "", "", ["sentence"])]),
        ]),
        ("div", 'role="complementary"', "", [("p", "", "", ["sentence"])]),
        ("div", 'role="contentinfo"', "", ["legal"]),
    ],
    # comments and boxes with names inside the article, columns beside it
    [
        ("div", 'class="topbar menu"', "", ["links"]),
        ("div", 'class="left sidebar"', "", ["paragraphs", ("ul", "", "", ["links"])]),
        ("article", 'class="story entry"', "*", [
            ("h1", "", "", ["title"]),
            ("p", "", "", ["short"]),
            "paragraphs",
            ("div", 'class="comments"', "-", [("p", "", "", ["sentence"])]),
        ]),
        ("aside", "", "", ["paragraphs"]),
        ("aside", "", "", [("h3", "", "", ["title"]), ("p", "", "", ["sentence"])]),
        ("section", 'class="comments"', "", ["paragraphs"]),
        ("div", 'class="subscribe form"', "", [("p", "", "", ["sentence"]), ("form", "", "", [("input", "", "", []), ("button", "", "", ["short"])])]),
        ("footer", "", "", [("p", "", "", ["legal"]), ("p", "", "", ["sentence"])]),
    ],
    # article in a column, with sections that carry no names
    [
        ("header", "", "", [("h1", "", "", ["short"]), ("p", "", "", ["sentence"])]),
        ("div", 'class="notice"', "", ["sentence"]),
        ("div", 'class="columns"', "", [
            ("main", "", "*", [
                ("div", "", "", [("h2", "", "", ["title"]), "paragraphs"]),
                ("div", "", "", ["paragraphs", ("h3", "", "", ["short"]), "paragraphs"]),
                ("div", 'class="ad"', "-", ["sentence"]),
                ("div", 'id="reader-comments"', "-", [("h3", "", "", ["short"]), ("p", "", "", ["sentence"]), ("p", "", "", ["sentence"])]),
            ]),
            ("aside", 'class="side"', "", ["paragraphs"]),
        ]),
        ("footer", "", "", ["legal"]),
    ],
    # very short article
    [
        ("nav", "", "", ["links"]),
        ("div", 'class="banner-ad"', "", ["sentence"]),
        ("article", "", "*", [("h1", "", "", ["short"]), ("p", "", "", ["short"])]),
        ("footer", "", "", ["legal"]),
    ],
    # headings and paragraphs right in the body
    [
        MAIN_BODY,
        ("h1", "", "", ["title"]),
        "paragraphs",
        ("h2", "", "", ["title"]),
        "paragraphs",
    ],
    # the same between links and a line of rights
    [
        MAIN_BODY,
        ("p", "", "-", ["links"]),
        ("h1", "", "", ["title"]),
        "paragraphs",
        "paragraphs",
        ("ul", "", "-", ["links"]),
        ("hr", "", "", []),
        ("p", "", "-", ["legal"]),
    ],
    # columns of a grid that say nothing of what they hold
    [
        ("div", 'class="container"', "", [
            ("div", 'class="row"', "", [("div", 'class="col-md-12"', "", ["links"])]),
            ("div", 'class="row"', "", [
                ("div", 'class="col-md-8"', "*", [("h1", "", "", ["title"]), "paragraphs", "paragraphs"]),
                ("div", 'class="col-md-4"', "", [("h4", "", "", ["short"]), ("ul", "", "", ["links"]), ("p", "", "", ["sentence"])]),
            ]),
            ("div", 'class="row"', "", [("div", 'class="col-md-12"', "", ["legal"])]),
        ]),
    ],
    # nothing but the article, in boxes
    [
        ("div", 'class="container"', "*", [
            ("div", 'class="row"', "", [("div", 'class="col-sm-9"', "", ["paragraphs"])]),
        ]),
    ],
    [("div", "", "*", [("div", "", "", ["lines"])])],
    [("div", "", "*", [("h1", "", "", ["title"]), "lines"])],
    [("div", "", "*", [("div", "", "", [("h2", "", "", ["title"]), "paragraphs"])]), ("div", "", "", ["legal"])],
    # text parted by line breaks, without paragraphs
    [
        ("div", "", "", [
            ("div", "", "", ["links"]),
            ("div", "", "*", ["lines"]),
            ("div", "", "", ["legal"]),
        ]),
    ],
    [
        ("div", "", "", ["links"]),
        ("div", "", "*", ["lines"]),
        ("div", "", "", ["legal"]),
    ],
    [
        ("center", "", "", ["links"]),
        ("div", "", "*", [("h2", "", "", ["title"]), "lines"]),
        ("div", "", "", ["short", "links"]),
    ],
    # a table that lays out the page
    [
        ("table", 'width="100%"', "", [
            ("tr", "", "", [("td", 'colspan="2"', "", ["links"])]),
            ("tr", "", "", [
                ("td", 'width="20%"', "", ["links", "links"]),
                ("td", "", "*", [("h2", "", "", ["title"]), "paragraphs", "lines"]),
            ]),
            ("tr", "", "", [("td", 'colspan="2"', "", ["legal"])]),
        ]),
    ],
    [
        ("table", "", "", [
            ("tr", "", "", [("td", "", "", [("font", "", "", ["links"])]), ("td", "", "*", ["lines"])]),
        ]),
        ("p", "", "", ["legal"]),
    ],
]


def words(rng: random.Random, low: int, high: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(rng.randint(low, high)))


def sentence(rng: random.Random, low: int = 6, high: int = 30) -> str:
    return words(rng, low, high).capitalize() + "."


def paragraph(rng: random.Random, brief: bool) -> str:
    if brief and rng.random() < 0.6:
        return sentence(rng, 1, 8)
    return " ".join(sentence(rng) for _ in range(rng.randint(1, 6)))


def filler(kind: str, rng: random.Random) -> str:
    if kind == "links":
        tag = rng.choice(["li", "span"])
        return "".join(
            f'<{tag}><a href="/{i}">{words(rng, 1, 3)}</a></{tag}>' for i in range(rng.randint(3, 7))
        )
    if kind == "paragraphs":
        many = rng.randint(10, 60) if rng.random() < 0.12 else rng.randint(1, 4)
        brief = rng.random() < 0.3  # short paragraphs, as of speech, among the others
        return "".join(f"<p>{paragraph(rng, brief)}</p>" for _ in range(many))
    if kind == "text":
        return " ".join(sentence(rng) for _ in range(rng.randint(1, 5)))
    if kind == "lines":
        gap = rng.choice(["<br>", "<br/>", "<br><br>", "<br />\n"])
        return gap.join(filler("text", rng) for _ in range(rng.randint(2, 7)))
    if kind == "items":
        return "".join(f"<li>{sentence(rng, 3, 14)}</li>" for _ in range(rng.randint(2, 5)))
    if kind == "comments":
        return "".join(
            f'<div class="comment"><b>{words(rng, 1, 1)}</b><p>{sentence(rng)}</p></div>'
            for _ in range(rng.randint(1, 3))
        )
    if kind == "legal":
        return f"&copy; {rng.randint(1995, 2030)} {words(rng, 1, 3)} &middot; {sentence(rng, 2, 9)}"
    if kind == "title":
        return words(rng, 2, 9).capitalize()
    if kind == "short":
        return words(rng, 1, 3).capitalize()
    return sentence(rng)


def rendered(part, rng: random.Random) -> str:
    if isinstance(part, str):
        return filler(part, rng)
    tag, attributes, mark, children = part
    if tag == "hr":
        return "<hr>"
    marked = {"*": " data-main=1", "-": " data-main=0", "": ""}[mark]
    inner = "".join(rendered(child, rng) for child in children)
    return f"<{tag} {attributes}{marked}>{inner}</{tag}>"


def labelled_pages(copies: int = 7, seed: int = 1) -> list[str]:
    """``copies`` pages of every layout with their marks, filled with different words."""
    rng = random.Random(seed)
    out = []
    for _ in range(copies):
        for layout in LAYOUTS:
            own = layout[0] == MAIN_BODY
            body = "".join(rendered(part, rng) for part in layout[own:])
            wrap = rng.random() < 0.4 and not own
            body = f'<div class="wrapper">{body}</div>' if wrap else body
            head = f"<head><title>{words(rng, 2, 5)}</title><style>p{{}}</style></head>"
            mark = " data-main=1" * own
            out.append(f"<!DOCTYPE html><html>{head}<body{mark}>{body}</body></html>")
    return out
