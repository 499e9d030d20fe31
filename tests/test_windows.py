"""Rewrite R1 (prefix sums + doubling maxima) against the literal interval join."""

import datetime as dt
import random

from pyspark.sql import functions as F

from strata.operators import windows as W
from strata.operators.windows import Agg

AGGS = [Agg("sum", "s", "v"), Agg("count_pos", "p", "v"), Agg("max", "mx", "v"),
        Agg("count_rows", "r"), Agg("count", "n", "v"), Agg("sum", "s2", "u")]


def _frames(spark, seed):
    rnd = random.Random(seed)
    d0 = dt.date(2020, 1, 1)
    days = sorted(rnd.sample(range(0, 366), 120))
    daily = [(d0 + dt.timedelta(days=d),
              None if rnd.random() < 0.15 else round(rnd.uniform(-5, 50), 2),
              None if rnd.random() < 0.5 else rnd.randint(0, 3)) for d in days]
    wins = []
    for i in range(300):
        a = rnd.randint(-1, 365)
        b = min(365, a + rnd.choice([0, 1, 2, 3, 7, 30, 64, 65, 200]))
        prev = None if rnd.random() < 0.05 else d0 + dt.timedelta(days=a)
        wins.append((i, prev, d0 + dt.timedelta(days=b)))
    wins += [(1000, dt.date(2019, 12, 31), dt.date(2020, 1, 1)),   # first day of range
             (1001, dt.date(2020, 12, 30), dt.date(2020, 12, 31))]  # last day of range
    wins += [(1002, dt.date(1871, 3, 1), dt.date(2020, 2, 1)), (1003, dt.date(2020, 6, 1), dt.date(2160, 1, 1)),
             (1004, dt.date(2020, 5, 9), dt.date(2020, 5, 2)), (1005, dt.date(1990, 1, 1), dt.date(1990, 2, 1))]
    d = spark.createDataFrame(daily, "data date, v double, u int")
    w = spark.createDataFrame(wins, "id int, data_medicao_anterior date, data_medicao date")
    return w, d


def _norm(rows):
    return sorted((r["id"], *[None if r[a.out] is None else round(float(r[a.out]), 6) for a in AGGS])
                  for r in rows)


def test_rewrite_equals_literal(spark):
    for seed in (1, 2):
        w, d = _frames(spark, seed)
        got = W.attribute_windows(w, d, AGGS).collect()
        want = W.attribute_windows_literal(w, d, AGGS).collect()
        assert _norm(got) == _norm(want)


def test_window_edges(spark):
    """(prev, cur]: driver on prev excluded, on cur included; empty window -> NULL / 0."""
    d = spark.createDataFrame([(dt.date(2020, 3, 1), 5.0), (dt.date(2020, 3, 10), 0.0)],
                              "data date, v double")
    w = spark.createDataFrame([
        (1, dt.date(2020, 3, 1), dt.date(2020, 3, 10)),   # prev on a driver day, cur on one
        (2, dt.date(2020, 3, 2), dt.date(2020, 3, 9)),    # empty
        (3, dt.date(2020, 3, 10), dt.date(2020, 6, 1)),   # past the last driver day
    ], "id int, data_medicao_anterior date, data_medicao date")
    aggs = [Agg("sum", "s", "v"), Agg("count_pos", "p", "v"), Agg("max", "mx", "v"),
            Agg("count_rows", "r")]
    got = {r["id"]: (r["s"], r["p"], r["mx"], r["r"])
           for r in W.attribute_windows(w, d, aggs).collect()}
    assert float(got[1][0]) == 0.0 and got[1][1:] == (0, 0.0, 1)
    assert got[2] == (None, 0, None, 0)
    assert got[3] == (None, 0, None, 0)


def test_coverage(spark):
    w = spark.createDataFrame([(dt.date(2020, 1, 5),), (dt.date(2020, 2, 5),)], "data_medicao date")
    drv = spark.createDataFrame([(dt.date(2020, 1, 27),)], "d date")
    got = sorted(tuple(r) for r in W.with_coverage(w, {"ok": drv}, "data_medicao").collect())
    assert got == [(dt.date(2020, 1, 5), True), (dt.date(2020, 2, 5), False)]
