"""Profiling: tokens, distinct of raw text, min/max of trimmed text, empty table."""

import pytest

from strata.operators import profile


def test_profile_columns(spark):
    df = spark.createDataFrame([(" 100",), ("99",), ("-",), ("",), (None,), (" 99",)], "c string")
    r = profile.profile_columns(df).first().asDict()
    assert (r["linhas"], r["nulos"], r["vazios_ou_hifen"], r["distintos"]) == (6, 1, 2, 5)
    assert float(r["preenchido_pct"]) == 50.0
    assert r["menor"] == "" and r["maior"] == "99"     # lexicographic on trimmed text


def test_profile_empty_raises(spark):
    empty = spark.createDataFrame([], "c string")
    with pytest.raises(Exception, match="table without rows"):
        profile.profile_columns(empty).collect()
    assert profile.profile_columns(empty, require_rows=False).first().linhas == 0


def test_profile_ships_no_text(spark):
    df = spark.createDataFrame([("a" * 1000, 1), ("b", None), ("b", 2)], "t string, n int")
    plan = profile.profile_columns(df)._jdf.queryExecution().executedPlan().toString()
    keyed = [x for x in plan.splitlines() if "hashpartitioning" in x]
    assert keyed and not any("hashpartitioning(t" in x or "valor" in x for x in keyed)
    assert {r.coluna: r.distintos for r in profile.profile_columns(df).collect()} == {"t": 2, "n": 2}


def test_numeric_and_top_values(spark):
    df = spark.createDataFrame([("1,5", "a"), ("2", "b"), ("-", "b"), ("x", None)], "n string, t string")
    nc = {r["coluna"]: (r["preenchidos"], r["numericos"], r["numerica"])
          for r in profile.numeric_columns(df).collect()}
    assert nc["n"] == (3, 2, False) and nc["t"] == (3, 0, False)
    top = [tuple(r) for r in profile.top_values(df, "t", 2).collect()]
    assert top == [("b", 2), (None, 1)]
    with pytest.raises(Exception, match="zz"):
        profile.top_values(df, "zz")
    with pytest.raises(ValueError):
        profile.profile_numeric(df, ["zz"])
    num = {r.coluna: (r.contagem, r.p50) for r in profile.profile_numeric(df, ["n", "zz"]).collect()}
    assert num == {"n": (2, 1.5)}
    comp = {r["coluna"]: float(r["pct_nulos"]) for r in profile.completeness(df, ["n", "t"]).collect()}
    assert comp == {"n": 0.0, "t": 25.0}
