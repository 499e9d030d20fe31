import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from strata.llm import exact_dedup
from strata.llm.exact_dedup import deduplicated, exact_duplicates, op11_exact_dedup


def brute(rows):
    """(doc_id, keep_id, size, kept, sha) of (doc_id, text) rows, as a multiset."""
    groups = defaultdict(list)
    for i, (doc_id, text) in enumerate(rows):
        norm = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups[norm].append((-len(text or ""), doc_id is None, doc_id or 0, i, doc_id))
    out = []
    for norm, members in groups.items():
        best = min(members)
        out += [(m[-1], best[-1], len(members), m == best, hashlib.sha256(norm.encode()).hexdigest()) for m in members]
    return Counter(out)


def got(df):
    return Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect())


def weak(norm):
    """Four hashes only: nearly every group holds different texts."""
    return F.unhex(F.hex(F.pmod(F.xxhash64(norm), F.lit(4))))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_tables(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    assert got(op11_exact_dedup(spark, f"/root/testdata/{sf}")) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_colliding_hashes_are_told_apart_by_their_bytes(spark):
    rows = [(i, f"text {i % 7}" + " " * (i % 3)) for i in range(200)] + [(300 + i, "\t\n") for i in range(5)] + [(400, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(exact_duplicates(docs, hashed=weak)) == brute(rows)
    assert got(exact_duplicates(docs)) == brute(rows)


def test_one_group_of_most_rows_and_a_full_bitmap(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BITS", 1 << 16)
    rows = [(i, "hot text") for i in range(3000)] + [(5000 + i, f"t {i // 2}") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(12)
    assert got(exact_duplicates(docs)) == brute(rows)


def test_other_blanks_and_signs_differ(spark):
    rows = [(1, "a b"), (2, "ab"), (3, "a b"), (4, "a\x0bb"), (5, "a\x00b"), (6, "A b"), (7, "\U0001F600 x"), (8, "\U0001F600x ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(exact_duplicates(docs)) == brute(rows)


def test_edges(spark, edge_rows, no_rows):
    assert exact_duplicates(no_rows).collect() == []
    assert got(exact_duplicates(edge_rows)) == brute([(r.doc_id, r.text) for r in edge_rows.collect()])


def test_kept_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = deduplicated(docs).collect()
    assert len(rows) == len({re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in docs.collect()})
