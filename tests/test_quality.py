"""Semantics ledger 3, 4, 5, 17 and the gate checks (one passing and one failing frame)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import quality as Q


def _dups(spark):
    rows = [  # key, protocol, submission, value
        ("A", "1", "01/01/2020 10:00:00", "12,5"), ("A", "2", "02/01/2020 10:00:00", "12,5"),  # resent
        ("B", "3", "01/01/2020 10:00:00", "12,5"), ("B", "4", "02/01/2020 10:00:00", "13,0"),  # conflict
        ("C", "5", "01/01/2020 10:00:00", "7"), ("C", "6", "02/01/2020 10:00:00", None),      # value+NULL
        ("D", "7", "01/01/2020 10:00:00", "12,5"), ("D", "8", "02/01/2020 10:00:00", "12.5"),  # spellings
        ("E", "9", "01/01/2020 10:00:00", "1"),                                                 # single
    ]
    return spark.createDataFrame(rows, "k string, p string, ts string, v string")


def test_duplicate_classes(spark):
    rep = {r["k"]: r["classificacao"] for r in Q.duplicate_report(_dups(spark), ["k"], ["v"], "p", "ts").collect()}
    assert rep == {"A": "REENVIO", "B": "CONFLITO DE VALOR", "C": "REENVIO", "D": "CONFLITO DE VALOR"}
    s = Q.duplicate_summary(_dups(spark), ["k"], ["v"]).first().asDict()
    assert s == {"registros": 9, "chaves_distintas": 5, "lancamentos_excedentes": 4,
                 "chaves_reenvio": 2, "chaves_conflito": 2}
    assert Q.duplicate_rows(_dups(spark), ["k"]).count() == 8
    vals = Q.duplicate_values(_dups(spark), ["k"], ["v"]).filter("k = 'D'").count()
    assert vals == 2


def test_dedup_order(spark):
    rows = [("K", "1", None, 5.0), ("K", "2", dt.datetime(2020, 1, 2), None),      # present beats NULL
            ("L", "3", dt.datetime(2020, 1, 1), 1.0), ("L", "4", dt.datetime(2020, 1, 2), 2.0),  # newest
            ("M", "5", None, 1.0), ("M", "6", dt.datetime(2020, 1, 1), 1.0),       # NULL ts last
            ("N", "7", dt.datetime(2020, 1, 1), 1.0), ("N", "8", dt.datetime(2020, 1, 1), 1.0)]  # tie
    df = spark.createDataFrame(rows, "k string, p string, ts timestamp, v double")
    order = [F.col("v").isNotNull().desc(), F.col("ts").desc_nulls_last(),
             F.col("v").desc_nulls_last(), F.col("p").desc()]
    got = {r["k"]: r["p"] for r in Q.dedup_best(df, ["k"], order).collect()}
    assert got == {"K": "1", "L": "4", "M": "6", "N": "8"}


def test_corrections_are_sequential(spark):
    df = spark.createDataFrame([("283327", "B1", "15/01/2026")], "p string, b string, d string")
    rules = [(F.col("p") == "283327", "b", F.lit("B2")),
             ((F.col("b") == "B2") & (F.col("d") == "15/01/2026"), "d", F.lit("14/01/2026"))]
    assert tuple(Q.apply_corrections(df, rules).first()) == ("283327", "B2", "14/01/2026")


def _viol(df):
    return {r["verificacao"]: r["violacoes"] for r in df.collect()}


def test_checks_pass_and_fail(spark):
    good = spark.createDataFrame([(1, 25.0, 10), (2, None, 20)], "k int, dens double, n int")
    bad = spark.createDataFrame([(1, 31.0, 10), (1, 19.0, 20)], "k int, dens double, n int")
    for df, expect in ((good, 0), (bad, 1)):
        assert _viol(Q.check_unique(df, ["k"], "u")) == {"u": expect}
        assert _viol(Q.check_cardinality(df, "k", 2, "c")) == {"c": expect}
        r = _viol(Q.check_rules(df, {"range": Q.range_rule("dens", 20, 30),
                                      "pos": F.col("n") > 0}))
        assert r == {"range": 2 * expect, "pos": 0}  # NULL passes the range rule
    dim = spark.createDataFrame([(1,)], "k int")
    assert _viol(Q.check_fk(good, dim, "k", "fk")) == {"fk": 1}
    assert _viol(Q.check_fk(bad, dim, "k", "fk")) == {"fk": 0}
    assert _viol(Q.check_presence(good, F.col("n") > 15, "p")) == {"p": 0}
    assert _viol(Q.check_presence(good, F.col("n") > 25, "p")) == {"p": 1}


def test_conformed_and_null_not_zero(spark):
    fine = spark.createDataFrame([("2020-01", "Jan"), ("2020-01", "Jan"), ("2020-02", "Fev")], "m string, nome string")
    coarse_ok = spark.createDataFrame([("2020-01", "Jan"), ("2020-02", "Fev")], "m string, nome string")
    coarse_bad = spark.createDataFrame([("2020-01", "Jan"), ("2020-02", "Mar")], "m string, nome string")
    assert _viol(Q.check_conformed(fine, coarse_ok, "m", ["nome"], "c")) == {"c": 0}
    assert _viol(Q.check_conformed(fine, coarse_bad, "m", ["nome"], "c")) == {"c": 1}
    m = spark.createDataFrame([(True, 1.0), (False, None), (False, 0.0)], "cov boolean, x double")
    assert _viol(Q.check_null_not_zero(m, "cov", ["x"], "nz")) == {"nz": 1}


def test_run_checks_raises_once(spark):
    ok = spark.createDataFrame([("a", 0)], "verificacao string, violacoes bigint")
    bad = spark.createDataFrame([("a", 0), ("b", 3), ("c", 1)], "verificacao string, violacoes bigint")
    Q.run_checks(ok)
    with pytest.raises(Q.QualityGateError, match="b: 3.*c: 1"):
        Q.run_checks(bad)


def test_enforce_raises_on_bad_row(spark):
    good = spark.createDataFrame([(10.0,), (None,)], "mm double")
    bad = spark.createDataFrame([(10.0,), (None,), (250.0,)], "mm double")
    rules = {"rain_0_200": F.col("mm").between(0, 200)}
    assert len(Q.enforce(good, rules).collect()) == 2   # NULL passes
    with pytest.raises(Exception, match="rain_0_200"):
        Q.enforce(bad, rules).collect()


def test_date_gaps(spark):
    d = dt.date
    df = spark.createDataFrame([("A", d(2020, 1, 1)), ("A", d(2020, 1, 3)), ("B", d(2020, 1, 2)),
                                ("B", d(2020, 1, 3)), ("B", d(2020, 1, 4))], "e string, data date")
    got = sorted(tuple(r) for r in Q.date_gaps(df, "e", "data").collect())
    assert got == [("A", d(2020, 1, 2))]
    pair = sorted(tuple(r) for r in Q.date_gaps_pair(df, "e", "data", "A", "B").collect())
    assert pair == [("A", "B", d(2020, 1, 1)), ("B", "A", d(2020, 1, 2)), ("B", "A", d(2020, 1, 4))]


def test_gate_shuffles_the_levels_once(spark):
    import re

    from strata.plans.registry import QUERIES
    from small_tables import SF_SMALL
    gate = QUERIES["quality_checks"](spark, SF_SMALL)
    gate.collect()
    plan = gate._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    by = lambda keys: set(re.findall(rf"Exchange hashpartitioning\({keys}, 8\).*?plan_id=(\d+)", plan))
    assert len(by(r"cristalizador#\d+L?, data_medicao#\d+")) == 1       # from the line items, for all readers
    assert len(by(r"cristalizador#\d+L?")) == 1                         # for the lag, for all readers
    assert "inline(array(" in plan and "inline(knownnotcontainsnull(filter(array(" not in plan       # compiled entries


def test_shared_gate_keys_with_nulls_and_mixed_types(spark):
    day = dt.date(2020, 1, 1)
    t = spark.createDataFrame([(None, 5, "1", day), (5, None, "1", None), (5, 6, None, day), (5, 6, None, day), (None, None, "2", None),
                               (None, None, "2", None)], "a int, b long, s string, d date")
    dim = spark.createDataFrame([(5, "2", day), (5, None, None)], "k long, s string, d date")
    tables = {"t": t, "dim": dim, "only": t}
    checks = [("u_ab", "unique", "t", ["a", "b"]), ("u_sd", "unique", "t", ["s", "d"]), ("u_abd", "unique", "t", ["a", "b", "d"]),
              ("only_ab", "unique", "only", ["a", "b"]), ("only_s", "unique", "only", ["s"]),
              ("fk_number", "fk", "t", ("a", "dim", "k")), ("fk_text", "fk", "t", ("s", "dim", "s")), ("fk_day", "fk", "t", ("d", "dim", "d")),
              ("fk_mixed", "fk", "t", ("s", "dim", "k")), ("members", "cardinality", "t", ("d", 3)), ("rule", "rule", "t", "b <> 6")]
    got = {r.verificacao: r.violacoes for r in Q.shared_gate(checks, tables.get).collect()}
    assert got == {"u_ab": 2, "u_sd": 2, "u_abd": 2, "only_ab": 2, "only_s": 3, "fk_number": 3, "fk_text": 4, "fk_day": 3,
                   "fk_mixed": 6, "members": 2, "rule": 2}
    alone = {r.verificacao: r.violacoes for r in Q.shared_gate(checks[3:5], tables.get).collect()}
    assert alone == {"only_ab": 2, "only_s": 3}
    empty = {k: v.limit(0) for k, v in tables.items()}
    assert {r.verificacao: r.violacoes for r in Q.shared_gate(checks, empty.get).collect()} == {
        c[0]: 3 if c[0] == "members" else 0 for c in checks}
