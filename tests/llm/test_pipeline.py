"""The pipeline's stages in turn, each judged on its own input."""

import hashlib

import corpus_pipeline
from pyspark.sql import functions as F

from corpusloom.llm import decontaminate, quality_rules, secrets, simhash

D = "/root/testdata/sf0.001"


def test_stages(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{D}/documents.parquet")
    columns = docs.columns
    state = docs
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        before = state.cache()
        state = stage(spark, before, D).cache()
        seen.append((name, before, state))
        if name != "tokens":
            assert state.columns == columns and state.dtypes == docs.dtypes
    (_, a, b), (_, _, c), (_, _, d), (_, _, e), (_, _, out) = seen
    kept = {r.doc_id for r in quality_rules.quality_rules(a).where("kept").collect()}
    assert {r.doc_id for r in b.collect()} == kept
    first = {r.doc_id for r in simhash.near_duplicates(b).where("doc_id = component_id").collect()}
    assert {r.doc_id for r in c.collect()} == first
    leaks = {r.doc_id for r in decontaminate.contaminated(c, spark.read.parquet(f"{D}/benchmark.parquet")).collect()}
    assert {r.doc_id for r in d.collect()} == first - leaks
    spans = {r.doc_id: r.spans for r in secrets.digests(secrets.secret_spans(d)).collect()}
    text = {r.doc_id: r.text for r in d.collect()}
    for r in e.collect():
        assert (r.text == text[r.doc_id]) == (spans[r.doc_id] == "") and r.n_chars == len(r.text)
    lib = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    got = {r.doc_id: r for r in out.collect()}
    for r in e.collect():
        assert got[r.doc_id].ids == lib.encode(r.text, add_special_tokens=False).ids
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()
    whole = corpus_pipeline.run(spark, D)
    assert whole.agg(F.count("*"), F.sum("n_tokens")).first() == out.agg(F.count("*"), F.sum("n_tokens")).first()
