"""The registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from spintally.llm import (
    bpe,
    decontaminate,
    html,
    licenses,
    pii,
    repetition,
    runs,
    secrets,
    simhash,
    spans,
    spelling,
    tokenfile,
    topk,
    toxicity,
)
from spintally.session import run_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the bytes they decode to."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode(documents(spark, sf_dir), path, public_tokenizers.PATTERN)
    return bpe.decode(encoded, path).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document, read back from a token file."""
    target = run_dir(spark, "tokens")
    tokenfile.write(
        documents(spark, sf_dir),
        target,
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN,
        end_id=0,
    )
    return tokenfile.read(spark, target).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that contains a benchmark item, with the item."""
    found = decontaminate.contamination(
        documents(spark, sf_dir), table(spark, sf_dir, "benchmark"), all_pairs=False
    )
    return found.filter("contaminated").select(
        "doc_id", "item_id", "n_windows", "n_matched", "coverage", "slot_consistency",
        "covered",
    )


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html.extract(table(spark, sf_dir, "pages"))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(documents(spark, sf_dir), shingle=4, max_bits=4)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    made = repetition.quality(documents(spark, sf_dir))
    return made.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_covered",
    )


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of the base spans of every document, and all spans."""
    found = secrets.find_secrets(documents(spark, sf_dir))
    base = [rule.kind for rule in secrets.BASE_RULES]
    return found.select(
        "doc_id",
        *[spans.count("spans", kind).alias(f"n_{kind}") for kind in base],
        F.sha2(spans.joined(spans.of_kinds("spans", base)), 256).alias("base_sha256"),
        spans.joined(F.col("spans")).alias("spans"),
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity and verdict of every document."""
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).withColumnRenamed("rejected", "toxic")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of the base phrases, and all labels of every document."""
    found = licenses.find_licenses(documents(spark, sf_dir))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.concat_ws(",", "base_labels").alias("base_labels"),
        F.concat_ws(",", "labels").alias("labels"),
        "score",
    )


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of the base spans of every document, and all spans."""
    docs = documents(spark, sf_dir)
    model = pii.fit(docs)
    found = pii.find_pii(docs, model)
    return found.select(
        "doc_id",
        *[spans.count("base_spans", kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS],
        F.sha2(spans.joined(F.col("base_spans")), 256).alias("base_sha256"),
        spans.joined(F.col("spans")).alias("spans"),
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, one tenth of them made periodic from some word on."""
    docs = documents(spark, sf_dir)
    found = runs.periodic_runs(
        docs.withColumn("text", runs.rewritten(F.col("text"), F.col("doc_id")))
    )
    return found.select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
        "collapsed_sha256",
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word with its more frequent form one edit away, and that form's root."""
    return spelling.variants(documents(spark, sf_dir), damage=True)


def op13_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best scores of every hundredth vector against all others."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk.search(vectors, vectors.filter("vec_id % 100 = 0"), k=10, scale=1024)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_token_file": op2_token_file,
    "op3_decontamination": op3_decontamination,
    "op4_html_extraction": op4_html_extraction,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_quality_rules": op6_quality_rules,
    "op7_secret_scan": op7_secret_scan,
    "op8_toxicity": op8_toxicity,
    "op9_license_scan": op9_license_scan,
    "op10_pii": op10_pii,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_top_k": op13_top_k,
}

# Words as the contract writes them; a window is repeated if it stands at two places of a text.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _covered(size: int) -> str:
    """SQL for the words of each document that lie in repeated windows of ``size`` words."""
    return f"""
      (SELECT r, count(*) AS n FROM (
         SELECT DISTINCT r, i + k AS place FROM (
           SELECT r, i, count(*) OVER (PARTITION BY r, w) AS times FROM (
             SELECT r, i, array_to_string(list_slice(words, i, i + {size} - 1), ' ') AS w
             FROM (SELECT r, words, unnest(range(1, len(words) - {size} + 2)) AS i FROM d)))
         , range({size}) AS ks(k) WHERE times > 1)
       GROUP BY r)"""


# The license templates as patterns over words joined by spaces, up to where they are accepted.
_PUBLISHED = "(as published by the free software foundation )?(either )?"
_LICENSES = {
    "all-rights-reserved": "all rights reserved",
    "apache-2.0": "licensed under (the )?apache license (version 2 0|2 0|v2)",
    "cc-by-4.0": "licensed under (a |the )?(cc by|creative commons attribution) 4 0",
    "cc-by-sa-4.0": "licensed under (a |the )?(cc by sa|creative commons attribution "
    "(sharealike|share alike)) 4 0",
    "cc-by-nc-4.0": "licensed under (a |the )?(cc by nc|creative commons attribution "
    "(noncommercial|non commercial)) 4 0",
    "cc-by-nc-sa-4.0": "licensed under (a |the )?(cc by nc sa|creative commons attribution "
    "noncommercial sharealike) 4 0",
    "gpl-2.0": "(licensed|released|distributed|it) under the (terms of the )?gnu general public "
    f"license {_PUBLISHED}version 2",
    "gpl-3.0": "(licensed|released|distributed|it) under the (terms of the )?gnu general public "
    f"license {_PUBLISHED}version 3",
    "lgpl-2.1": "under the (terms of the )?gnu lesser general public license "
    f"{_PUBLISHED}version 2 1",
    "lgpl-3.0": f"under the (terms of the )?gnu lesser general public license {_PUBLISHED}version 3",
    "agpl-3.0": f"under the (terms of the )?gnu affero general public license {_PUBLISHED}version 3",
    "mpl-2.0": "subject to the terms of the mozilla public license (v )?(version )?2 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
}
_UNDER = "(licensed|released|distributed|available|provided|published) under (a |an |the )?(terms of the )?"
_CLAUSES = "((2|3|4|two|three|four) clause )?"
_NOTICES = {
    "mit": f"{_UNDER}mit licen[cs]e",
    "bsd": f"{_UNDER}{_CLAUSES}((new|modified|revised|simplified|original) )?bsd {_CLAUSES}licen[cs]e",
    "isc": f"{_UNDER}isc licen[cs]e",
    "mpl": f"{_UNDER}mozilla public licen[cs]e",
    "mpl-2.0": f"{_UNDER}mozilla public licen[cs]e (2 0|v2 0|v 2 0|version 2 0)",
}
_HEADS = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of "
    "(this software|this font software|the software) and associated documentation files "
    "(the software )?to deal in the software without restriction",
    "isc": "permission to use copy modify (and|and or) distribute this software for any purpose "
    "with or without fee is hereby granted",
    "bsd": "redistribution and use in source and binary forms with or without modification are "
    "permitted provided that the following conditions are met",
}


def _pattern(template: str) -> str:
    """A template's markup as a pattern over words that are each followed by a space."""
    words = lambda text: "".join(f"{w} " for w in re.findall("[a-z0-9]+", text.lower()))
    out = ""
    for part in re.findall(r"\[\[|\]\]|\{\{[^}]*\}\}|[^\[\]{}]+", template):
        if part in ("[[", "]]"):
            out += "(" if part == "[[" else ")?"
        elif part.startswith("{{*"):
            out += f"([^ ]+ ){{0,{part[3:-2]}}}"
        elif part.startswith("{{"):
            out += f"({'|'.join(map(words, part[2:-2].split('|')))})"
        else:
            out += words(part)
    return out.rstrip()


_WORDINGS = {label: _pattern(template) for label, template in licenses.WORDINGS.items()}


def _matches(patterns: dict[str, str]) -> str:
    """SQL for the list of labels whose pattern stands in the words."""
    cases = ", ".join(
        f"CASE WHEN regexp_matches(joined, ' {pattern} ') THEN '{label}' END"
        for label, pattern in patterns.items()
    )
    return f"list_filter([{cases}], lambda x: x IS NOT NULL)"


_FOUND = f"list_concat({_matches(_LICENSES)}, {_matches(_NOTICES)}, {_matches(_WORDINGS)})"

ORACLE: dict[str, str] = {
    "op4_html_extraction": r"""
        WITH a AS (
          SELECT page_id, url,
                 regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) AS inner_html
          FROM pages),
        b AS (
          SELECT page_id, url, regexp_replace(regexp_replace(inner_html,
                 '</?(b|i|em|strong|a)( [^>]*)?>', '', 'g'), '<[^>]*>', ' ', 'g') AS t FROM a),
        c AS (
          SELECT page_id, url, replace(replace(replace(replace(t,
                 '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS t FROM b)
        SELECT page_id, url, trim(regexp_replace(t, '\s+', ' ', 'g')) AS text,
               length(trim(regexp_replace(t, '\s+', ' ', 'g'))) AS n_chars
        FROM c""",
    "op6_quality_rules": rf"""
        WITH d AS (
          SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, {_WORDS} AS words
          FROM documents),
        l AS (
          SELECT r, count(*) - count(DISTINCT line) AS n FROM (
            SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
        c AS (
          SELECT d.r, doc_id, len(words)::BIGINT AS n_words,
                 length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
                 (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
                 coalesce(l.n, 0)::BIGINT AS n_dup_lines, coalesce(w8.n, 0)::BIGINT AS n_repeat_words,
                 coalesce(w5.n, 0)::BIGINT AS n_covered, coalesce(w101.n, 0) > 0 AS over_long
          FROM d LEFT JOIN l ON l.r = d.r
          LEFT JOIN {_covered(repetition.WINDOW)} w8 ON w8.r = d.r
          LEFT JOIN {_covered(repetition.MIN_REPEAT)} w5 ON w5.r = d.r
          LEFT JOIN {_covered(repetition.MAX_LONGEST + 1)} w101 ON w101.r = d.r)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_covered,
               n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
               NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
               AND n_covered <= n_words * {repetition.MAX_COVERED} AND NOT over_long AS kept
        FROM c""",
    "op9_license_scan": rf"""
        WITH d AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        p AS (
          SELECT *, ' ' || array_to_string(w, ' ') || ' ' AS joined,
                 list_filter(range(1, len(w) + 1), lambda i: w[i] = 'cc' AND w[i + 1] = 'by') AS cc,
                 list_filter(range(1, len(w) + 1), lambda i: w[i] = 'general'
                   AND w[i + 1] = 'public' AND w[i + 2] = 'license') AS gpl,
                 list_filter(range(1, len(w) + 1), lambda i: w[i] = 'all'
                   AND w[i + 1] = 'rights' AND w[i + 2] = 'reserved') AS res
          FROM d),
        q AS (
          SELECT *, list_concat(list_concat(cc, gpl), res) AS places,
                 list_filter([CASE WHEN len(cc) > 0 THEN 'cc-by' END,
                   CASE WHEN len(gpl) > 0 THEN 'gpl' END,
                   CASE WHEN len(res) > 0 THEN 'reserved' END], lambda x: x IS NOT NULL) AS base,
                 {_FOUND} AS accepted, {_matches(_HEADS)} AS heads
          FROM p)
        SELECT doc_id, len(w)::BIGINT AS n_words, len(places)::BIGINT AS n_base,
               (list_min(places) - 1)::BIGINT AS first_word,
               (list_max(places) - 1)::BIGINT AS last_word,
               array_to_string(list_sort(base), ',') AS base_labels,
               array_to_string(list_sort(list_distinct(list_concat(base, accepted, heads))), ',')
                 AS labels,
               CASE WHEN len(accepted) > 0 THEN 1.0 WHEN len(heads) > 0 THEN {licenses.HEAD_SCORE}
                    WHEN len(base) > 0 THEN 0.5 ELSE 0.0 END::DOUBLE AS score
        FROM q""",
    "op13_top_k": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e
          FROM embeddings
          WHERE vec_id IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
          SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
          FROM v AS q JOIN v AS c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0),
        r AS (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT
            AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    # CRC-32 bit by bit: a byte is mixed in, then shifted out in eight steps (-1 each).
    "op12_spelling_variants": """
        WITH RECURSIVE d AS (
          SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(run,
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
          FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run
                FROM documents)),
        own AS (SELECT id, run, count(*) AS times FROM d WHERE length(run) >= 5 GROUP BY id, run),
        hashed AS (
          SELECT *, xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(
              flatten(list_transform(string_split(id || ':' || run, ''), lambda c:
                CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [195::BIGINT, ord(c)::BIGINT - 64] END)),
              lambda b: list_concat([b], [-1, -1, -1, -1, -1, -1, -1, -1])))),
            lambda h, b: CASE WHEN b >= 0 THEN xor(h, b)
              WHEN h & 1 = 1 THEN xor(h >> 1, 3988292384) ELSE h >> 1 END)) AS h
          FROM own),
        w AS (
          SELECT word, sum(times)::BIGINT AS n FROM (
            SELECT times, CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INT)
                     || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM hashed)
          WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
        cut AS (
          SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS rest
          FROM (SELECT word, unnest(range(1, length(word) + 1))::INT AS i FROM w)),
        pairs AS (
          SELECT a.word, b.word AS near FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest
          WHERE a.word <> b.word
          UNION SELECT cut.word, w.word FROM cut JOIN w ON w.word = cut.rest
          UNION SELECT w.word, cut.word FROM cut JOIN w ON w.word = cut.rest),
        best AS (
          SELECT p.word, count(*) AS n_near,
                 first(p.near ORDER BY m.n DESC, p.near) AS near, max(m.n) AS near_n
          FROM pairs p JOIN w m ON m.word = p.near GROUP BY p.word),
        f AS (
          SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
                 CASE WHEN near_n >= 2 * w.n THEN near END AS form,
                 CASE WHEN near_n >= 2 * w.n THEN near_n END::BIGINT AS form_n
          FROM w LEFT JOIN best ON best.word = w.word),
        chain AS (
          SELECT word, word AS place FROM f
          UNION ALL
          SELECT c.word, f.form FROM chain c JOIN f ON f.word = c.place WHERE f.form IS NOT NULL)
        SELECT f.word, f.form, c.place AS root, f.n, f.n_near, f.form_n
        FROM f JOIN chain c ON c.word = f.word
        JOIN f AS last ON last.word = c.place AND last.form IS NULL""",
}
