"""The layer job end to end: bronze text to gold, and every guard that stops it."""

import os
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

from strata.operators.guards import LoadGuardError
from strata.operators.quality import QualityGateError
from strata.operators import quality
from strata.plans import layers
from strata.plans.layers import GOLD, VIEWS, run_layers
from strata.plans.measurement import Model
from strata.sources.landing import read_layer

from small_tables import SF_SMALL


def _rows(df):
    return sorted(str(tuple(r)) for r in df.collect())


@pytest.fixture(scope="module")
def done(spark):
    base = tempfile.mkdtemp(prefix="strata-layers-", dir="/tmp")
    return base, run_layers(spark, SF_SMALL, base)


def _copy(tmp_path):
    for t in layers.STAGED:
        shutil.copy(f"{SF_SMALL}/{t}.parquet", tmp_path / f"{t}.parquet")
    return str(tmp_path)


def test_every_layer(spark, done):
    base, out = done
    assert len(GOLD) == 11 and len(VIEWS) == 5
    assert {f"gold.{t}" for t in GOLD} | {f"view.{v}" for v in VIEWS} <= set(out)
    assert all(os.path.isdir(p) for k, p in out.items() if not k.startswith("view."))
    bronze = read_layer(spark, base, "bronze", "orders")
    assert bronze.count() == spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()
    assert dict(bronze.dtypes)["o_totalprice"] == "string"
    # gold from bronze text equals gold straight from the typed tables
    for t in ("fact_rain", "fact_level", "monthly", "customers"):
        assert _rows(read_layer(spark, base, "gold", t).drop("data_carga_gold")) == _rows(getattr(Model(spark, SF_SMALL), t)), t
    assert spark.table("vw_seasonal_view").count() > 0


def test_silver_is_co_located_for_the_lag_and_keep_best(spark, done):
    base, _ = done
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    silver = {t: read_layer(spark, base, "silver", t).drop("data_carga_silver") for t in layers.CO_LOCATED}
    lag = Model(spark, SF_SMALL, silver=silver).fact_level
    assert "Window" in plan(lag) and "Exchange" not in plan(lag)
    assert _rows(lag) == _rows(Model(spark, SF_SMALL).fact_level)
    again = quality.dedup_best(silver["submissions"], ["cristalizador", "data_registro"], [F.col("protocolo").desc()])
    assert "Exchange" not in plan(again) and again.count() == silver["submissions"].count()
    assert "Exchange" not in plan(quality.coverage(silver["rain"], "estacao", "data_registro"))


def test_a_missing_or_empty_source_stops_before_any_write(spark, done, tmp_path):
    base, _ = done
    src = _copy(tmp_path)
    before = {d: sorted(os.listdir(f"{base}/{d}/orders")) for d in ("staging", "bronze")}
    os.remove(f"{src}/nation.parquet")
    with pytest.raises(LoadGuardError, match="nation"):
        run_layers(spark, src, base)
    spark.read.parquet(f"{SF_SMALL}/nation.parquet").limit(0).toPandas().to_parquet(f"{src}/nation.parquet")
    with pytest.raises(LoadGuardError, match="nation is empty"):
        run_layers(spark, src, base)
    assert before == {d: sorted(os.listdir(f"{base}/{d}/orders")) for d in ("staging", "bronze")}


@pytest.mark.parametrize("price, error, stage", [(-5.0, QualityGateError, "silver")])
def test_a_breach_stops_the_job_and_keeps_gold(spark, done, tmp_path, price, error, stage):
    base, _ = done
    src = _copy(tmp_path)
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").toPandas()
    li.loc[li.index[0], "l_extendedprice"] = price
    li.loc[li.index[0], "l_orderkey"] = 10 ** 9            # the newest submission of its day
    li.to_parquet(f"{src}/lineitem.parquet", coerce_timestamps="us")
    files = sorted(os.listdir(f"{base}/gold/fact_level"))
    with pytest.raises(error, match="range_level"):
        run_layers(spark, src, base)
    with pytest.raises(Exception, match="level_not_negative"):
        run_layers(spark, src, base, gate=False)
    assert sorted(os.listdir(f"{base}/silver/levels")) and sorted(os.listdir(f"{base}/gold/calendar"))
    assert files


def test_every_gold_check_can_fail(spark):
    from strata.plans.registry import CHECKS, _check_frame

    m = Model(spark, SF_SMALL)
    by = {c[0]: c for c in CHECKS}
    level = m.fact_level
    m.__dict__["fact_level"] = level.withColumn("nivel_anterior", F.col("nivel_anterior") + 1)
    assert _check_frame(m, *by["previous_level_is_the_measured_one"]).first().violacoes > 0
    m.__dict__["dirty_typed"] = m.dirty_typed.withColumn("data_registro", F.lit(None).cast("date"))
    assert _check_frame(m, *by["dates_parsed"]).first().violacoes > 0
    m.__dict__["monthly"] = m.monthly.withColumn("cobertura_bacia_ok", F.lit(False))
    assert _check_frame(m, *by["null_not_zero"]).first().violacoes > 0
