import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cases_llm import SCHEMA, odd_rows, prose, rows
from spintally.llm import bpe, pii, simhash, toxicity
from test_bpe import as_ids
from test_decontaminate import ITEMS, plain_pairs
from test_simhash import near_texts, plain_components, plain_fingerprint
from test_toxicity import corpus


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    texts, marks = corpus(150, seed=3)
    data = rows(texts) + rows(near_texts(), 500)
    data += rows([prose(80, 50) + " " + ITEMS[0][1], "mail a.b@c.example.com now please, " + prose(81, 40)], 800)
    data += [(d if d is None else d + 900, *rest) for d, *rest in odd_rows()]
    labels = [(i, 1, m) for i, m in enumerate(marks)]
    spark.createDataFrame(data, SCHEMA).write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(str(path / "benchmark.parquet"))
    return str(path)


def triples(df):
    return sorted(((str(r.doc_id), str(r.text), str(r.n_chars)) for r in df.collect()))


def test_every_stage_against_a_plain_version(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == [name for name, _ in corpus_pipeline.STAGES] and len(stages) == 5

    clean = stages["toxicity"](spark, docs, folder)
    assert clean.columns == docs.columns
    model = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))

    def rejected(text):
        found = toxicity.occurrences(text or "", model.weights, {})
        import math

        return sum(model.weights[f] * math.log1p(n) for f, n in found.items()) > model.thresholds[0]

    data = [tuple(r) for r in docs.collect()]
    kept = [r for r in data if not rejected(r[1])]
    assert 0 < len(kept) < len(data)
    assert triples(clean) == sorted((str(r[0]), str(r[1]), str(r[4])) for r in kept)

    unique = stages["simhash_near_dedup"](spark, clean, folder)
    assert unique.columns == docs.columns
    fps = [plain_fingerprint(r[1]) for r in kept]
    groups = plain_components(list(range(len(kept))), fps, 4)
    left = [tuple(r) for r in unique.collect()]
    assert len(left) == len(set(groups))
    position = {}
    for group, row in zip(groups, kept):
        best = position.get(group)
        if best is None or (row[0] is None, row[0] or 0) < (best[0] is None, best[0] or 0):
            position[group] = row
    assert sorted(str(r[0]) for r in left) == sorted(str(r[0]) for r in position.values())

    free = stages["benchmark_decontamination"](spark, unique, folder)
    hit = {d for d, *_, bad in plain_pairs(left) if bad}
    assert 800 in hit and free.columns == docs.columns
    expected = [r for r in left if r[0] not in hit]
    assert triples(free) == sorted((str(r[0]), str(r[1]), str(r[4])) for r in expected)

    private = stages["pii"](spark, free, folder)
    assert private.columns == docs.columns
    weights = pii.fit(free)
    redacted = {str(r[0]): None if r[1] is None else pii.redacted(r[1], pii.decide(r[1], weights, {})[1]) for r in expected}
    got = {str(r.doc_id): r for r in private.collect()}
    assert {k: r.text for k, r in got.items()} == redacted
    assert "[EMAIL]" in got["801"].text and all(r.text is None or r.n_chars == len(r.text) for r in got.values())

    ids = stages["byte_bpe"](spark, private, folder).collect()
    own = bpe.vocabulary(bpe.read_ranks(public_tokenizers.path(corpus_pipeline.RANKS)))
    assert len(ids) == len(got) and all(r.round_trip for r in ids)
    for row in ids[:40]:
        data_of, _ = own.bytes_of(__import__("numpy").array(as_ids(row.ids), dtype=int))
        assert data_of.tobytes() == (redacted[str(row.doc_id)] or "").encode()


def test_run_applies_all_stages(spark, folder):
    found = corpus_pipeline.run(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert sorted(map(str, found.collect())) == sorted(map(str, docs.collect()))


def test_repeated_rows_leave_one(spark):
    data = rows(["same words in every row here today"] * 3) + [(0, "same words in every row here today", "en", "src0", 34)] * 4
    data += [(None, "another text without any id at all", None, None, None)] * 2
    kept = simhash.deduplicated(spark.createDataFrame(data, SCHEMA)).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["0", "None"]


def test_columns_of_any_name_pass_the_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = ["was_null", "n_spans", "rejected", "severity", "others", "fp", "root", "others.text"]
    for number, name in enumerate(names):
        docs = docs.withColumn(name, F.concat(F.lit(f"{number}-"), F.col("doc_id").cast("string")))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", *names]
        for row in docs.collect():
            own = [row[name] for name in names]
            assert own == [None if row.doc_id is None else f"{i}-{row.doc_id}" for i in range(len(names))]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert last.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "round_trip"]


def test_empty_tables_pass_all_stages(spark, tmp_path):
    for name, ddl in (
        ("documents", SCHEMA), ("labels", "doc_id long, quality int, toxic int"),
        ("benchmark", "item_id long, text string"),
    ):
        spark.createDataFrame([], ddl).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
