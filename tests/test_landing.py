"""Landing (A1-A4) and load guards."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from strata.operators import guards
from strata.sources import landing


def _csv(rows: str) -> str:
    d = tempfile.mkdtemp(prefix="strata-land-", dir="/tmp")
    path = os.path.join(d, "leitura.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write(rows)
    return path


def test_land_text_keeps_hyphen_and_nulls_empty(spark):
    path = _csv("ESTACAO,DATAREGISTRO,MILIMETROS\nP1,01/02/2026,\"14,0\"\nP2,02/02/2026,-\nP3,03/02/2026,\n")
    df = landing.land_text(spark, path, ["ESTACAO", "DATAREGISTRO", "MILIMETROS"])
    assert all(t == "string" for _, t in df.dtypes)
    vals = [r["MILIMETROS"] for r in df.orderBy("ESTACAO").collect()]
    assert vals == ["14,0", "-", None]
    staged = landing.stamp(df, "drive")
    assert {r["arquivo_origem"] for r in staged.select("arquivo_origem").collect()} == {"leitura.csv"}
    bronze = landing.stamp_bronze(staged, "leitura")
    assert bronze.select("origem_tabela").first()[0] == "staging.leitura"
    assert "data_carga_silver" in landing.stamp_layer(bronze, "silver").columns


def test_land_text_goes_by_the_header_and_is_strict(spark):
    swapped = landing.land_text(spark, _csv("B,A\nb1,a1\n"), ["A", "B"])
    assert [tuple(r) for r in swapped.collect()] == [("a1", "b1")]
    quoted = landing.land_text(spark, _csv('A,B\n"x\ny",2\nz,3\n'), ["A", "B"], multi_line=True)
    assert [tuple(r) for r in quoted.collect()] == [("x\ny", "2"), ("z", "3")]
    for bad in ("A,B\n1,2,3\n", "A,B\n1\n"):
        with pytest.raises(Exception, match="(?i)malformed"):
            landing.land_text(spark, _csv(bad), ["A", "B"]).collect()
    with pytest.raises(ValueError, match="C"):
        landing.land_text(spark, _csv("A,B\n1,2\n"), ["A", "C"])


def test_guards(spark):
    landed = spark.createDataFrame([("a.csv",), ("b.csv",)], "arquivo_origem string")
    guards.assert_sources(landed, ["a.csv", "b.csv"])
    with pytest.raises(guards.LoadGuardError, match="c.csv"):
        guards.assert_sources(landed, ["a.csv", "c.csv"])
    with pytest.raises(guards.LoadGuardError):
        guards.assert_not_empty(spark.createDataFrame([], "x int"), "x")
    src = spark.range(5)
    rep = guards.reconcile({"ok": (src, src), "bad": (src, src.filter(F.col("id") > 0))})
    flags = {r["tabela"]: r["integro"] for r in rep.collect()}
    assert flags == {"ok": True, "bad": False}
    with pytest.raises(guards.LoadGuardError, match="bad"):
        guards.assert_reconciled(rep)
    audit = guards.load_audit({"t1": landed, "t2": landed.limit(1)}).collect()
    assert [(r["tabela"], r["registros"]) for r in audit] == [("t1", 2), ("t2", 1)]


def test_attach_requires_one_row(spark):
    from strata.operators.scalars import attach, is_one_row
    df = spark.range(3)
    assert is_one_row(df.agg(F.max("id")))
    assert not is_one_row(df.groupBy("id").count())
    with pytest.raises(ValueError):
        attach(df, df.groupBy("id").count())
    assert attach(df, df.agg(F.max("id").alias("m"))).filter("m = 2").count() == 3
