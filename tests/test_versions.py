"""Versioned publication: commits, half-written layers, quarantine, retirement, contents, samples."""

import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import guards, quality
from strata.sources.landing import read_layer, sample, write_layer
from strata.sources.versions import ACCEPTED, BROKEN, Layout, Publication, commit_log, current, read_published, retire


def test_a_write_killed_half_way_leaves_the_former_version(spark, tmp_path):
    base = str(tmp_path)
    first = Publication(spark, base, "gold")
    first.write(spark.range(10), "a")
    first.write(spark.range(5), "b")
    with pytest.raises(LookupError):
        read_published(spark, base, "gold", "a")          # written, not committed
    first.commit()
    second = Publication(spark, base, "gold")
    second.write(spark.range(99), "a")
    with pytest.raises(Exception, match="killed"):
        second.write(spark.range(20).select(F.when(F.col("id") == 17, F.raise_error(F.lit("killed"))).otherwise(F.col("id")).alias("id")), "b")
    assert read_published(spark, base, "gold", "a").count() == 10 and read_published(spark, base, "gold", "b").count() == 5
    third = Publication(spark, base, "gold")
    third.write(spark.range(7).withColumn("more", F.lit("x")), "a")        # another schema
    third.write(spark.range(0), "b")
    third.commit()
    assert read_published(spark, base, "gold", "a").columns == ["id", "more"]
    assert read_published(spark, base, "gold", "b").count() == 0
    assert [r.rows for r in commit_log(spark, base, "gold").orderBy("seq", "table").collect()] == [10, 5, 7, 0]


def test_single_tables_partitions_and_retirement(spark, tmp_path):
    base = str(tmp_path)
    for n in (3, 4, 5):
        write_layer(spark.range(n).withColumn("g", F.col("id") % 2), base, "silver", "t", partition_by=["g"])
    assert sorted(map(tuple, read_layer(spark, base, "silver", "t").collect())) == [(i, i % 2) for i in range(5)]
    assert retire(spark, base, "silver", keep=2) == 1 and retire(spark, base, "silver", keep=2) == 0
    assert read_layer(spark, base, "silver", "t").count() == 5
    assert current(spark, base, "silver")["t"][0] in {f"{base}/silver/t/{r.version}" for r in commit_log(spark, base, "silver").collect()}


def test_quarantine_in_the_same_pass(spark, tmp_path):
    df = spark.createDataFrame([(1, 5), (2, -5), (3, None), (4, 500), (None, -5)], "id int, v int")
    rules = {"not_negative": F.col("v") >= 0, "at_most_100": F.col("v") <= 100, "with_id": F.col("id").isNotNull()}
    new = Publication(spark, str(tmp_path), "gold")
    good = new.write(df, "t", rules)
    assert sorted(r.id for r in good.collect()) == [1, 3] and good.columns == ["id", "v"]
    assert new.refused == {("t", "not_negative"): 2, ("t", "at_most_100"): 1, ("t", "with_id"): 1}
    counted = {r.verificacao: r.violacoes for r in quality.check_rules(df, rules).collect()}
    assert {n: c for (_, n), c in new.refused.items()} == counted
    new.commit()
    bad = {(r.id, tuple(r[BROKEN])) for r in read_published(spark, str(tmp_path), "gold", "t", accepted=False).collect()}
    assert bad == {(2, ("not_negative",)), (4, ("at_most_100",)), (None, ("not_negative", "with_id"))}


def test_changed_contents_are_found(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (2, None)], "k int, v string")
    same = a.orderBy(F.desc("k")).repartition(3)
    other = spark.createDataFrame([(1, "y"), (2, None), (2, None)], "k int, v string")
    blank = spark.createDataFrame([(1, "x"), (2, ""), (2, None)], "k int, v string")
    pairs = {"same": (a, same), "other": (a, other), "blank": (a, blank), "counts": (a, other)}
    got = {r.tabela: r.integro for r in guards.reconcile(pairs, {t: ["k", "v"] for t in ("same", "other", "blank")}).collect()}
    assert got == {"same": True, "other": False, "blank": False, "counts": True}
    none = a.limit(0)
    assert guards.reconcile({"e": (none, none)}, {"e": ["k", "v"]}).first().integro


def test_sample_is_the_same_on_every_run(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 7 > 0, F.col("id") * 2).alias("x"))
    one = sorted(map(str, sample(df, 20).collect()))
    assert len(one) == 20 and one == sorted(map(str, sample(df.repartition(13, "x"), 20).collect()))
    assert one != sorted(map(str, sample(df, 20, seed=1).collect()))
    assert sample(df.limit(0)).collect() == [] and sample(df.limit(3)).count() == 3


def test_shared_gate_equals_the_single_checks(spark):
    fact = spark.createDataFrame([(1, 10, 5, True), (1, 10, -1, False), (2, None, None, None), (None, 30, 9, False)],
                                 "k int, d long, v int, f boolean")
    dim = spark.createDataFrame([(10,), (20,), (20,), (None,)], "d int")
    tables = {"fact": fact, "dim": dim, "none": fact.limit(0)}
    checks = []
    for t in ("fact", "none"):
        checks += [(f"u_{t}", "unique", t, ["k", "d"]), (f"c_{t}", "cardinality", t, ("k", 3)), (f"r_{t}", "range", t, ("v", 0, 8)),
                   (f"e_{t}", "rule", t, "v <> 9"), (f"p_{t}", "presence", t, "f"), (f"fk_{t}", "fk", t, ("d", "dim", "d")),
                   (f"n_{t}", "null_not_zero", t, ("f", ["v"], None))]
    got = {r.verificacao: r.violacoes for r in quality.shared_gate(checks, tables.get).collect()}
    want = {}
    for name, kind, t, args in checks:
        df = tables[t]
        one = {"unique": lambda: quality.check_unique(df, args, name), "cardinality": lambda: quality.check_cardinality(df, *args, name),
               "range": lambda: quality.check_rules(df, {name: quality.range_rule(*args)}),
               "rule": lambda: quality.check_rules(df, {name: F.expr(args)}),
               "presence": lambda: quality.check_presence(df, F.col(args), name),
               "fk": lambda: quality.check_fk(df, dim.where("d is not null"), "d", name),
               "null_not_zero": lambda: quality.check_null_not_zero(df, args[0], args[1], name, args[2])}[kind]()
        want[name] = one.first().violacoes
    assert got == want and want["fk_fact"] == 2 and want["u_fact"] == 1 and want["p_none"] == 1


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_laid_out_table_needs_no_shuffle_by_its_key(spark, tmp_path):
    base = str(tmp_path)
    rows = spark.range(3000).select((F.col("id") % 37).alias("k"), (F.col("id") * 7919 % 3000).alias("d"), F.col("id").alias("v"))
    rows = rows.unionByName(spark.createDataFrame([(None, 5, 1), (None, None, 2)], "k long, d long, v long"))
    p = Publication(spark, base, "silver")
    held = p.write(rows, "t", layout=Layout("k", "d", 8))
    with pytest.raises(LookupError):
        read_published(spark, base, "silver", "t")          # written, not committed
    p.commit()
    w = Window.partitionBy("k").orderBy("d", "v")
    lag = lambda df: df.withColumn("before", F.lag("v").over(w))
    want = sorted(map(str, lag(rows).collect()))
    assert "Exchange" in _plan(lag(rows))
    for df in (held, read_published(spark, base, "silver", "t")):
        assert "Exchange" not in _plan(lag(df)) and sorted(map(str, lag(df).collect())) == want
        assert "Exchange" not in _plan(df.groupBy("k").agg(F.sum("v")))
    # another reader has only the log: the table is declared again from it
    spark.sql(f"DROP TABLE `strata_silver_t_{p.version}`")
    assert "Exchange" not in _plan(lag(read_published(spark, base, "silver", "t")))
    assert commit_log(spark, base, "silver").first().rows == 3002
    # each bucket is one file, and plain Parquet readers see the same rows
    files = [f for f in os.listdir(f"{p.path('t')}/{ACCEPTED}=true") if f.endswith(".parquet")]
    assert len(files) <= 8 and sorted(map(str, spark.read.schema("k long, d long, v long").parquet(f"{p.path('t')}/{ACCEPTED}=true").collect())) == sorted(map(str, rows.collect()))
    assert read_published(spark, base, "silver", "t", accepted=False).count() == 0
    with pytest.raises(ValueError):
        p.write(rows, "u", {"v": F.col("v") > 0}, layout=Layout("k", "d", 8))
    empty = Publication(spark, base, "silver")
    assert empty.write(rows.limit(0), "t", layout=Layout("k", "d", 8)).count() == 0
    empty.commit()
    assert read_published(spark, base, "silver", "t").count() == 0
    assert retire(spark, base, "silver", keep=1) == 1
