import base64
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow.parquet as pq
import pytest
import tiktoken
from oracle_check import compare, connect
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
from cases_llm import SCHEMA, odd_rows, rows
from spintally.llm import licenses
from spintally.llm.queries import ORACLE, QUERIES
from test_simhash import plain_components, plain_fingerprint

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

#: The columns each contract fixes, with their types.
CONTRACT = {
    "op1": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op2": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op3": "doc_id bigint, item_id bigint",
    "op4": "page_id bigint, url string, text string, n_chars bigint",
    "op5": "doc_id bigint, fingerprint string, component_id bigint",
    "op6": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, kept boolean",
    "op7": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op8": "doc_id bigint, severity double, toxic boolean",
    "op9": "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
    "base_labels string, labels string, score double",
    "op10": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
    "base_sha256 string, spans string",
    "op11": "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, "
    "exponent_milli bigint, runs_sha256 string, collapsed_sha256 string",
    "op12": "word string, form string, root string, n bigint, n_near bigint, form_n bigint",
    "op13": "query_id bigint, rank int, vec_id bigint, score bigint",
}


def documents(folder):
    return pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).to_pylist()


def test_every_operator_and_the_pipeline_are_registered():
    found = [name.split("_")[0] for name in QUERIES]
    assert found == [f"op{n}" for n in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(entry_points.queries())
    assert set(ORACLE) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_columns_of_the_contract(spark, name):
    made = QUERIES[name](spark, SMALL)
    types = dict(made.dtypes)
    for column in CONTRACT[name.split("_")[0]].split(", "):
        field, kind = column.split()
        assert types[field] == kind
    if name.split("_")[0] not in ("op3", "op4", "op12", "op13"):  # those have rows of other things
        assert made.count() == len(documents(SMALL))


@pytest.fixture(scope="module")
def duck():
    con = connect(MIDDLE)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, MIDDLE), duck, ORACLE[name]) is None


def wording(template, rng):
    """One of the wordings of a template, sometimes with a word changed."""
    while (found := re.search(r"\[\[((?:(?!\[\[|\]\]).)*)\]\]", template)) is not None:
        kept = found[1] if rng.random() < 0.5 else " "
        template = template[: found.start()] + kept + template[found.end() :]
    template = re.sub(r"\{\{\*\d+\}\}", "some words", template)
    template = re.sub(r"\{\{([^}]*)\}\}", lambda m: rng.choice(m[1].split("|")), template)
    if rng.random() < 0.3:
        words = template.split()
        words[rng.randrange(len(words))] = "other"
        template = " ".join(words)
    return template


def test_license_templates_as_sql_patterns(spark, tmp_path):
    rng = random.Random(2)
    texts = [
        f"start {wording(template, rng)} end. {wording(rng.choice(list(licenses.TEMPLATES.values())), rng)}"
        for template in list(licenses.TEMPLATES.values()) * 12
    ]
    frame = spark.createDataFrame(rows(texts) + [(d and d + 1000, *r) for d, *r in odd_rows()], SCHEMA)
    frame.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = connect(MIDDLE)
    con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    name = "op9_license_scan"
    made = QUERIES[name](spark, str(tmp_path))
    assert compare(made, con, ORACLE[name]) is None
    assert len({label for r in made.collect() for label in r.labels.split(",")}) >= len(licenses.TEMPLATES)


def test_bpe_of_a_whole_table_as_the_library(spark):
    lines = open(P.path("byte_bpe_multi_50k.tiktoken"), "rb")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = set()
    for row in documents(MIDDLE):
        ids = library.encode_ordinary(row["text"] or "")
        packed = np.array(ids, "<u4").tobytes()
        expected.add(
            (row["doc_id"], len(ids), hashlib.sha256(packed).hexdigest(),
             hashlib.sha256((row["text"] or "").encode()).hexdigest())
        )
    assert set(map(tuple, QUERIES["op1_byte_bpe"](spark, MIDDLE).collect())) == expected


def test_token_file_of_a_whole_table_as_the_library(spark):
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    expected, start = set(), 0
    for row in sorted(documents(MIDDLE), key=lambda r: r["doc_id"]):
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids + [0]
        expected.add((row["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert set(map(tuple, QUERIES["op2_token_file"](spark, MIDDLE).collect())) == expected


def test_components_of_a_whole_table_as_brute_force(spark):
    data = documents(MIDDLE)
    ids = [r["doc_id"] for r in data]
    fps = [plain_fingerprint(r["text"]) for r in data]
    expected = set(zip(ids, [f"{fp:016x}" for fp in fps], plain_components(ids, fps, 4)))
    found = QUERIES["op5_simhash_near_dedup"](spark, MIDDLE)
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in found.collect()} == expected
