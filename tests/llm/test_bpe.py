import hashlib
import random

import public_tokenizers as P
import pytest
import regex
import tiktoken

from strata.llm.bpe import RANKS_FILE, encode, encode_words, load_ranks, merge_word, op5_bpe, stage


@pytest.fixture(scope="module")
def ranks():
    return load_ranks(P.path(RANKS_FILE))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_whole_table_against_the_library(spark, library):
    sf = "/root/testdata/sf0.001"
    text = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op5_bpe(spark, sf).collect()
    assert len(rows) == len(text)
    for r in rows:
        ids = library.encode_ordinary(text[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


def test_strange_strings_against_the_library(spark, library):
    rnd = random.Random(3)
    chars = [chr(c) for c in range(128)] + list("\x85\xa0​ 　﻿é中😀́١Ⅷ")
    texts = ["".join(rnd.choice(chars) for _ in range(rnd.randint(0, 50))) for _ in range(600)]
    texts += ["a" * 5000, "ab" * 3000, "!" * 700, "x" + " " * 300, "é" * 400, "<|endoftext|>",
              "".join(rnd.choice("abcdefgh") for _ in range(4000))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in encode(df).collect():
        assert r.ids == library.encode_ordinary(texts[r.doc_id])


def test_higher_order_fold_gives_the_same_ids(spark, ranks):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(3).collect()
    words = sorted({w for r in docs for w in regex.findall(P.PATTERN, r.text)})[:200] + ["", "é", "\n"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = {bytes(r.word): r.ids for r in encode_words(df, "w", ranks).collect()}
    assert got == {w.encode(): merge_word(w.encode(), ranks) for w in words if w}


def test_edges(spark, edge_rows, no_rows):
    rows = encode(edge_rows, carry=("doc_id", "ids")).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert len(rows) == 10
    assert all(r.n_tokens == 0 and r.ids_sha256 == r.decoded_sha256 == empty for r in rows if r[0] in (1, 2))
    assert encode(no_rows).collect() == []
    assert stage(spark, edge_rows, None).count() == 10
