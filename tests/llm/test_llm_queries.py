"""The registered queries of the package against their SQL, or a plain form where there is none."""

from __future__ import annotations

from collections import defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
import corpus_pipeline
from conftest import SMALL
from oracle import connect, difference
from smeltery.llm import toxicity as tox
from smeltery.llm.queries import LLM_QUERIES

MIDDLE = "/root/testdata/sf0.01"
NATIVE = ("op3_line_dedup", "op8_pii")


def docs_of(spark, folder):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]


def token_ids(texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for i, t in texts}


@pytest.mark.parametrize("name", sorted(n for n, q in LLM_QUERIES.items() if q.sql))
def test_matches_sql(spark, name):
    frame = LLM_QUERIES[name].run(spark, SMALL)
    assert difference(frame, connect(SMALL), LLM_QUERIES[name].sql) == ""


@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_stay_in_the_engine(spark, name):
    plan = LLM_QUERIES[name].run(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not [w for w in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop") if w in plan]


def test_pii_spans_match_plain_python(spark):
    texts = dict(docs_of(spark, MIDDLE))
    for r in LLM_QUERIES["op8_pii"].run(spark, MIDDLE).collect():
        kinds, text = ("EMAIL", "IP", "CARD", "PHONE", "IBAN"), texts[r["doc_id"]] or ""
        assert r["spans"] == ",".join(f"{k}:{a}:{b}" for k, a, b in brute.spans(text, kinds))
        assert r["scores"] == ",".join(str(s) for k in kinds for _, _, s in brute.scored(k, text))


def test_join_matches_all_pairs(spark):
    expected = brute.near_classes(docs_of(spark, MIDDLE))
    found = LLM_QUERIES["op4_jaccard_join"].run(spark, MIDDLE).collect()
    assert {r["doc_id"]: (r["class_id"], r["n_links"], r["n_sets"]) for r in found} == expected


def test_packing_holds_every_id_once(spark):
    ids = token_ids(docs_of(spark, SMALL))
    assert brute.check_packing(LLM_QUERIES["op7_packing"].run(spark, SMALL).collect(), ids) < 0.05


def test_pieces_come_back(spark):
    found = LLM_QUERIES["op5_pieces"].run(spark, SMALL)
    assert found.count() == len(docs_of(spark, SMALL))
    assert found.where("NOT lossless").count() == 0


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{MIDDLE}/labels.parquet")


def test_languages_of_held_out_texts(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "lang")
    found = LLM_QUERIES["op2_language"].run(spark, MIDDLE).join(docs, "doc_id").where("held_out")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97


def test_toxicity_of_held_out_texts(spark, labels):
    found = LLM_QUERIES["op10_toxicity"].run(spark, MIDDLE).join(labels, "doc_id").where("held_out")
    right = found.agg(F.avg((F.col("toxic") == F.col("predicted")).cast("int"))).first()[0]
    assert right > 0.93


def test_quality_of_held_out_texts(spark, labels):
    found = LLM_QUERIES["op6_quality"].run(spark, MIDDLE).join(labels, "doc_id").where("held_out")
    right = found.agg(F.avg((F.col("quality") == F.col("selected").cast("int")).cast("int"))).first()[0]
    assert right > 0.93
    assert found.where("expected_grade < 0 OR expected_grade > 2 OR tail < 0 OR tail > 1").count() == 0


def test_pipeline_matches_plain_python(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = tox._learned(docs, spark.read.parquet(f"{SMALL}/labels.parquet"), "doc_id", "text", "toxic", tox.SAMPLE)
    rows = [(i, t) for i, t in docs_of(spark, SMALL) if model.score(t or "") < 0.5]
    rows = list(brute.line_dedup(rows).items())
    classes = brute.near_classes(rows)
    groups = defaultdict(list)
    for i, (top, _, _) in classes.items():
        groups[top].append(i)
    texts = dict(rows)
    kept = [(min(g), brute.masked(texts[min(g)])) for g in groups.values()]
    found = corpus_pipeline.run(spark, SMALL).collect()
    brute.check_packing(found, token_ids(kept))


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(40)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).columns == docs.columns
