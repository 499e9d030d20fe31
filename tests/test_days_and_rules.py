"""Observed days as bits, and correction rules as data, against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strata.operators import quality


def _table(spark):
    rnd = random.Random(4)
    day = lambda i: dt.date(1969, 11, 1) + dt.timedelta(days=i)
    rows = [(e, day(rnd.randint(0, 400)), i if i % 3 else None) for i in range(300) for e in [rnd.choice(["a", "b", "c", None])]]
    rows += [("far", day(0), 1), ("far", day(3000), 2), ("one", day(77), 3), ("a", None, 4), ("nul", None, None)]
    return rows, spark.createDataFrame(rows, "e string, d date, v int").repartition(4)


def test_gaps_and_coverage(spark):
    rows, df = _table(spark)
    seen = {}
    for e, d, _ in rows:
        seen.setdefault(e, set()).update([d] if d else [])
    every = set().union(*seen.values())
    want = {(e, d) for e, ds in seen.items() if ds for d in every - ds if min(ds) < d < max(ds)}
    got = [tuple(r) for r in quality.date_gaps(df, "e", "d").collect()]
    assert len(got) == len(set(got)) and set(got) == want
    cover = {r.e: (r.registros, r.dias_distintos, r.primeira_data, r.ultima_data, r.preenchidos) for r in quality.coverage(df, "e", "d", "v").collect()}
    assert cover == {e: (sum(x[0] == e for x in rows), len(ds), min(ds, default=None), max(ds, default=None),
                         sum(x[0] == e and x[2] is not None for x in rows)) for e, ds in seen.items()}
    pair = {tuple(r) for r in quality.date_gaps_pair(df, "e", "d", "a", "b").collect()}
    assert pair == {("a", "b", d) for d in seen["a"] - seen["b"]} | {("b", "a", d) for d in seen["b"] - seen["a"]}
    none = df.limit(0)
    assert quality.date_gaps(none, "e", "d").collect() == quality.coverage(none, "e", "d").collect() == []


def test_rules_see_the_output_of_earlier_ones(spark):
    df = spark.createDataFrame([(1, "x", "old"), (2, "y", "old"), (3, None, "old"), (4, "x", None)], "id int, a string, b string")
    rules = spark.createDataFrame([(2, {"b": "^mid$"}, "a", "x", "z"), (1, {"a": "^x$"}, "b", None, "mid"), (3, {"zz": "."}, "a", None, "never"),
                                   (4, {"a": "^z$", "b": "mid"}, "b", "i", "I")], quality.RULES)
    got = {r.id: (r.a, r.b) for r in quality.apply_rule_table(df, rules, ["a", "b"]).collect()}
    assert got == {1: ("z", "mId"), 2: ("y", "old"), 3: (None, "old"), 4: ("z", "mId")}
    plain = quality.apply_corrections(df, [(F.col("a") == "x", "b", F.lit("mid")), (F.col("b") == "mid", "a", F.regexp_replace("a", "x", "z")),
                                           ((F.col("a") == "z") & F.col("b").contains("mid"), "b", F.regexp_replace("b", "i", "I"))])
    assert got == {r.id: (r.a, r.b) for r in plain.collect()}
    assert quality.apply_rule_table(df, rules.limit(0), ["a", "b"]).count() == 4


def test_too_many_rules_raise(spark, monkeypatch):
    monkeypatch.setattr(quality, "MAX_RULES", 2)
    rules = spark.createDataFrame([(i, {"a": "."}, "a", None, "q") for i in range(3)], quality.RULES)
    with pytest.raises(Exception, match="more than 2 rules"):
        quality.apply_rule_table(spark.createDataFrame([("x",)], "a string"), rules, ["a"]).collect()
