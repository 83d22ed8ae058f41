"""The pipeline against a plain run of its steps, on small tables."""

import collections

import corpus_pipeline
import __spark_entry__ as E
from promptwatt.llm import decontaminate, mixing, quality_classifier

from .test_corpus import brute_fingerprint, components, expected_tokens

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_and_agree_with_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r for r in docs.collect()}
    kept = {r.doc_id for r in quality_classifier.classify(docs, spark.read.parquet(f"{SF}/labels.parquet")).filter("kept").collect()}
    assert kept < set(texts)
    first = components([(i, brute_fingerprint(texts[i].text)) for i in sorted(kept)])
    kept = {i for i in kept if first[i] == i}
    items = [(r.item_id, decontaminate.words_of(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    holds = lambda t: any(b" ".join(w) in b" ".join(decontaminate.words_of(t)) for _, w in items)
    clean = {i for i in kept if not holds(texts[i].text)}
    assert clean < kept
    rest = spark.createDataFrame([texts[i] for i in sorted(clean)], docs.schema)
    copies = collections.Counter(r.doc_id for r in mixing.mix(rest).collect())
    want = expected_tokens([(i, texts[i].text) for i in sorted(clean) for _ in range(copies[i])])
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == want


def test_stages_keep_columns_and_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns


def test_queries_are_registered():
    names = list(E.queries())
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names
