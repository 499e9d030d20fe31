import random

import numpy as np
from pyspark.sql import functions as F

from strata.llm.common import PIECE, bitmap, maybe_in, pieces, surely_not_in
from strata.llm.near_dedup import M, estimate, minima, near_duplicates, registers, shingles, stage


def brute(rows):
    sets = [(d, frozenset(shingles(None if t is None else t.encode()).tolist())) for d, t in rows]
    up = list(range(len(sets)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    low = {}
    for i, (d, _) in enumerate(sets):
        low[find(i)] = min(low.get(find(i), d), d)
    return sorted((d, len(s), low[find(i)], low[find(i)] == d) for i, (d, s) in enumerate(sets))


def mutated(rnd, words, share):
    return " ".join(rnd.choice("qwertyuiop") * 5 if rnd.random() < share else w for w in words)


def test_components_against_brute_force(spark):
    rnd = random.Random(3)
    vocab = ["".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(3000)]
    rows, k = [], 0
    for _ in range(25):
        base = [rnd.choice(vocab) for _ in range(rnd.randint(8, 300))]
        for _ in range(rnd.randint(1, 14)):
            rows.append((1000 - k, mutated(rnd, base, rnd.choice([0, 0.01, 0.02, 0.03, 0.05]))))
            k += 1
    shared = [rnd.choice(vocab) for _ in range(60)]        # a passage that many documents share
    for _ in range(60):
        rows.append((2000 + k, " ".join(shared + [rnd.choice(vocab) for _ in range(rnd.randint(10, 60))])))
        k += 1
    rows += [(1, None), (2, ""), (3, " \n "), (4, "One two"), (5, "one  TWO"), (6, "two one"), (7, "ÄB c"), (8, "äB c")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(tuple(r) for r in near_duplicates(df).collect())
    assert got == brute(rows)


def test_sf_small(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(tuple(r) for r in near_duplicates(docs).collect()) == brute(rows)


def test_edges(spark, edge_rows, no_rows):
    got = near_duplicates(edge_rows).collect()
    assert len(got) == 10
    assert {(r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id == 4} == {(1, 4, True)}
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None and r.n_shingles] == [(4, False)]
    assert all(r.component_id == r.doc_id and r.kept for r in got if r.n_shingles == 0)
    assert near_duplicates(no_rows).collect() == []
    staged = stage(spark, edge_rows, None)
    assert staged.columns == edge_rows.columns
    # one row of the repeated (4, "one two"); rows without an id stay
    assert sorted((r.doc_id or 0) for r in staged.collect()) == [0, 0, 1, 2, 3, 4, 7, 8, 9]


def test_sketches_merge_and_estimate():
    rnd = np.random.default_rng(5)
    a, b = rnd.integers(0, 1 << 63, 600, dtype=np.uint64), rnd.integers(0, 1 << 63, 200, dtype=np.uint64)
    union = registers(minima(np.union1d(a, b)))
    x, y = registers(minima(a)), registers(minima(b))
    assert (np.maximum(x, y) == union).all()
    errors = []
    for j in (0.2, 0.5, 0.75, 0.9):
        n = 1000
        both = round(2 * n * j / (1 + j))
        e = rnd.integers(0, 1 << 63, 2 * n - both, dtype=np.uint64)
        p, q = registers(minima(e[:n])), registers(minima(e[n - both:]))
        got = estimate(np.array([(p > q).sum()]), np.array([(p < q).sum()]), np.array([n]), np.array([n]))[0]
        errors.append(abs(got - j) / np.sqrt(j * (1 - j) / M))
    assert max(errors) < 4.5


def test_stage_shuffles_only_the_texts_of_odd_ids(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("text", F.concat("text", F.lit(" end")))
    docs.write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")        # as for a table of any size
    try:
        found = stage(spark, docs, "")
        plan = found._jdf.queryExecution().sparkPlan()
        assert plan.nodeName() == "Union"
        first = plan.children().head().toString()       # what passes as it is read
        assert "BroadcastHashJoin" in first and "SortMergeJoin" not in first
        got = sorted(r.doc_id for r in found.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert got == sorted(d for d, _, _, kept in brute([(r.doc_id, r.text) for r in docs.collect()]) if kept)


def test_stage_is_exact_when_the_bitmap_is_full(spark, monkeypatch):
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(900)]
    rows = [(i, " ".join(rnd.choices(words, k=40))) for i in range(60)]
    rows += [(100 + i, rows[i][1]) for i in range(0, 60, 4)]        # copies that go
    rows += [rows[1], rows[1], rows[2], (3, "another text " * 9), (None, None), (None, ""), (None, rows[5][1]), (70, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = [r for r in rows if r[0] is None or r[0] < 100]
    want = sorted(map(str, [r for r in want if want.count(r) == 1] + [rows[1], rows[2]]))
    for bits in (1 << 26, 8):
        monkeypatch.setattr("strata.llm.near_dedup.ID_BITS", bits)
        assert sorted(str(tuple(r)) for r in stage(spark, docs, "").collect()) == want


def test_the_two_sides_of_a_bitmap(spark):
    keys = spark.createDataFrame([(k,) for k in (*range(0, 3000, 7), None)], "k long")
    rows = spark.range(5000).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.lit("x").alias("v"))
    for bits in (1 << 26, 1 << 15, 64):
        made = bitmap(keys, F.col("k"), bits)
        may = {r.k for r in maybe_in(rows, F.col("k"), made, bits).collect()}
        rest = surely_not_in(rows, F.col("k"), made, bits)
        assert rest.columns == rows.columns and {None, *range(7, 3000, 7)} <= may
        got = [r.k for r in rest.collect()]
        assert len(got) + len(may) == 5000 and not may & set(got)
        fine = pieces(made)
        assert {r.k for r in maybe_in(rows, F.col("k"), fine, bits, 8 * PIECE).collect()} == may
        assert {r.k for r in surely_not_in(rows, F.col("k"), fine, bits, 8 * PIECE).collect()} == set(got)
    nothing = bitmap(keys.limit(0), F.col("k"), 1 << 26)
    assert surely_not_in(rows, F.col("k"), nothing, 1 << 26).count() == 5000
