import zlib
from collections import defaultdict

import pytest

from strata.llm import sharding
from strata.llm.sharding import SHARDS, assign_shards, op2_sharding, write_shards


def check(rows, text):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    assert set(by) <= set(range(SHARDS))
    for s in by.values():
        assert sorted(r.slot for r in s) == list(range(len(s)))
    total, largest = sum(r.size for r in rows), max(r.size for r in rows)
    for s in range(SHARDS):
        assert abs(sum(r.size for r in by[s]) - total / SHARDS) <= largest
    for r in rows:
        b = (text[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(b) + 1, zlib.crc32(b))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_tables(spark, sf):
    sf = f"/root/testdata/{sf}"
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op2_sharding(spark, sf).collect()
    assert len(rows) == len(text) and {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    check(rows, text)


def test_hot_text_and_overfull_ranges(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RANGES", (8, 64))
    monkeypatch.setattr(sharding, "SAMPLES", 2)
    docs = [(i, "hot" if i % 3 else f"t{i}" * (i % 50)) for i in range(3000)] + [(-1, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    check(assign_shards(df).collect(), dict(docs))
    same = df.unionAll(spark.createDataFrame([(7, "hot")] * 2000, df.schema))     # one row, repeated
    rows = assign_shards(same).collect()
    size = defaultdict(int)
    for r in rows:
        size[r.shard] += r.size
    assert len(rows) == 5001 and max(size.values()) - min(size.values()) < 500


def test_edges(spark, edge_rows, no_rows):
    assert assign_shards(no_rows).collect() == []
    rows = assign_shards(edge_rows).collect()
    assert len(rows) == 10 and {(r.size, r.text_crc32) for r in rows if r.doc_id in (1, 2)} == {(1, 0)}


def test_written_shards(spark, tmp_path, edge_rows):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    write_shards(docs, str(tmp_path / "out"))
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == docs.count() and out.select("_shard", "_slot").distinct().count() == docs.count()
    assert sorted(map(str, out.select(*docs.columns).collect())) == sorted(map(str, docs.collect()))
    # repeated rows and rows without an id, as often as they occur
    write_shards(edge_rows.unionAll(edge_rows), str(tmp_path / "edges"), shards=3)
    got = spark.read.parquet(str(tmp_path / "edges")).select(*edge_rows.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, edge_rows.collect() * 2))
