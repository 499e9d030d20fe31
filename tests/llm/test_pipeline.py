import hashlib

import public_tokenizers as P
import tiktoken

import corpus_pipeline
from strata.llm.bpe import RANKS_FILE, load_ranks
from strata.llm.decontam import decontaminate
from strata.llm.near_dedup import near_duplicates
from strata.llm.pii import stage as pii_stage
from strata.llm.quality_rules import judge

SF = "/root/testdata/sf0.01"


def test_every_stage_and_the_whole(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    scratch = corpus_pipeline.Scratch(spark, "pipeline-test")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontaminate", "personal_data", "tokens"]
    want = [lambda d: {r.doc_id for r in judge(d).collect() if r.kept},
            lambda d: {r.doc_id for r in near_duplicates(d).collect() if r.kept},
            lambda d: {r.doc_id for r in decontaminate(d, bench).collect() if not r.contaminated},
            lambda d: {r.doc_id for r in d.collect()}, lambda d: {r.doc_id for r in d.collect()}]
    cur = docs
    for (name, stage), ids in zip(corpus_pipeline.STAGES, want):
        before = cur
        cur = scratch.table(stage(spark, before, SF), name)
        got = [r.doc_id for r in cur.select("doc_id").collect()]
        assert len(got) == len(set(got)) and set(got) == ids(before)
        if name != "tokens":
            assert cur.dtypes == docs.dtypes
        if name == "personal_data":
            clean = {r.doc_id: r for r in cur.collect()}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=load_ranks(P.path(RANKS_FILE)), special_tokens={})
    for r in cur.collect():
        assert r.ids == library.encode_ordinary(clean[r.doc_id].text)
        assert r.decoded_sha256 == hashlib.sha256(clean[r.doc_id].text.encode()).hexdigest()
        assert clean[r.doc_id].n_chars == len(clean[r.doc_id].text)
    assert pii_stage(spark, before, SF).count() == before.count()


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.collect() == []
