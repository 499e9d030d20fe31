"""Semantics ledger 7-16: consecutive facts, percentile, classification, views."""

import datetime as dt

from pyspark.sql import functions as F

from strata.operators import facts, stats, views

D = dt.date


def test_consecutive_semantics(spark):
    rows = [(1, D(2020, 1, 1), 10.0, False), (1, D(2020, 1, 31), 5.0, True),   # -5 exactly: growth
            (1, D(2020, 3, 1), 0.0, False),                                    # -5 -> then below?
            (1, D(2020, 4, 1), -6.0, False),                                   # -6: event
            (2, D(2020, 1, 5), None, False), (2, D(2020, 2, 5), 3.0, False),   # NULL level
            (3, D(2019, 12, 1), 50.0, False), (3, D(2020, 1, 10), 40.0, False)]  # scope before lag
    df = spark.createDataFrame(rows, "e int, d date, lvl double, z boolean")
    out = {(r["e"], r["data_medicao"]): r for r in facts.fact_consecutive(
        df, "e", "d", "lvl", "z", 5.0, scope=("2020-01-01", "2020-12-31")).collect()}
    first = out[(1, D(2020, 1, 1))]
    assert first["variacao"] is None and first["flag_evento"] is None
    assert first["flag_base_zerada"] is False and first["dias_corridos"] is None
    r = out[(1, D(2020, 1, 31))]
    assert float(r["variacao"]) == -5.0 and r["flag_evento"] is False and float(r["crescimento"]) == -5.0
    assert r["dias_corridos"] == 30 and float(r["variacao_dia"]) == round(-5 / 30, 4)
    assert out[(1, D(2020, 3, 1))]["flag_base_zerada"] is True   # previous row had a zero level
    r = out[(1, D(2020, 4, 1))]
    assert r["flag_evento"] is True and r["crescimento"] is None
    assert out[(2, D(2020, 2, 5))]["variacao"] is None
    assert out[(3, D(2020, 1, 10))]["nivel_anterior"] is None      # 2019 row is out of scope


def test_percentile_window_equals_theta_join(spark):
    vals = [(1995, 10.0), (1996, 20.0), (1997, 20.0), (1998, 5.0), (1999, None), (2000, 30.0),
            (2001, 20.0), (2002, 1.0)]
    df = spark.createDataFrame(vals, "ano int, x double").withColumn("b", F.col("ano") <= 2000)
    got = {r["ano"]: (r["_abaixo"], r["_n_base"])
           for r in stats.percentile_vs_baseline(df, "x", "b").collect()}
    base = [(a, x) for a, x in vals if a <= 2000]
    for a, x in vals:
        below = 0 if x is None else sum(1 for _, y in base if y is not None and y < x)
        assert got[a] == (below, len(base))


def test_classify_and_baseline(spark):
    df = spark.createDataFrame([(1.0, 10.0, 2.0), (9.0, 10.0, 2.0), (13.0, 10.0, 2.0),
                                (None, 10.0, 2.0), (1.0, 10.0, None)], "x double, m double, s double")
    got = [r[0] for r in df.select(stats.classify(F.col("x"), F.col("m"), F.col("s"))).collect()]
    assert got == ["SECO", "TIPICO", "CHUVOSO", "TIPICO", "TIPICO"]
    one = spark.createDataFrame([(2000, 5.0)], "ano int, v double")
    b = stats.baseline(one, "v", F.lit(True)).first()
    assert b["desvio_hist"] is None and b["anos_hist"] == 1   # n = 1 -> NULL sd


def test_minmax_zero_range_and_nulls(spark):
    df = spark.createDataFrame([("a", 5.0, 1.0), ("b", 5.0, None), ("c", 5.0, 3.0)], "k string, x double, y double")
    out = {r["k"]: (r["nx"], r["ny"], r["iy"]) for r in views.minmax_normalise(
        df.withColumn("y2", F.col("y")), {"x": "nx", "y": "ny", "y2": "iy"}, inverted={"y2"}).collect()}
    assert out["a"][0] is None                       # zero range -> NULL
    assert float(out["a"][1]) == 0.0 and float(out["c"][1]) == 100.0 and out["b"][1] is None
    assert float(out["a"][2]) == 100.0 and float(out["c"][2]) == 0.0


def test_climatology_absent_months(spark):
    fact = spark.createDataFrame([
        (1, D(1995, 1, 3), 10.0), (1, D(1996, 1, 3), 20.0), (1, D(1996, 2, 3), 4.0),
        (2, D(1995, 1, 5), 30.0), (1, D(1997, 1, 2), 50.0)], "estacao int, data date, milimetros double") \
        .withColumn("milimetros", F.col("milimetros").cast("decimal(12,2)"))
    st = spark.createDataFrame([(1, False), (2, False)], "estacao int, flag_suspeita boolean")
    mm = stats.monthly_means(fact, st)
    comp = {r["mes"]: r for r in stats.compare_climatology(mm, (1995, 1996), 1997).collect()}
    assert set(comp) == {1, 2}                            # months without readings are absent
    assert float(comp[1]["media_historica_mm"]) == 20.0   # (20 + 20) / 2
    assert comp[1]["situacao"] == "ACIMA" or comp[1]["desvio_historico_mm"] is not None
    assert comp[2]["situacao"] == "SEM DADO" and comp[2]["anos_observados"] == 1
