"""Exact quantiles against sorting."""

import math
import random

import pytest
from pyspark.sql import functions as F

from strata.operators import dims, profile, quantiles
from strata.operators.quantiles import exact_quantiles

PROBS = [0.0, 0.25, 1 / 3, 0.5, 0.75, 0.99, 1.0]


def want(values, p):
    values = sorted(v for v in values if v is not None)
    return values[max(math.ceil(p * len(values)), 1) - 1] if values else None


@pytest.mark.parametrize("bins", [4, 1 << 14])
def test_against_sorting(spark, monkeypatch, bins):
    monkeypatch.setattr(quantiles, "BINS", bins)
    monkeypatch.setattr(quantiles, "_HIGH", bins)
    monkeypatch.setattr(quantiles, "_NAN", bins + 1)
    rnd = random.Random(3)
    cols = {"flat": [rnd.uniform(-5, 5) for _ in range(600)], "wide": [rnd.choice((-1, 1)) * 10.0 ** rnd.uniform(-300, 300) for _ in range(600)],
            "ties": [float(rnd.randint(0, 3)) for _ in range(600)], "one": [7.5] * 600, "none": [None] * 600,
            "few": [1.5, None, 2.0] + [None] * 597, "edges": [float("inf"), float("-inf"), 1.7e308, -1.7e308, 0.0] + [None] * 595}
    if bins == 4:
        del cols["wide"]                        # halving 2,000 powers of two takes as many passes
    df = spark.createDataFrame(list(zip(*cols.values())), ", ".join(f"{c} double" for c in cols)).repartition(5)
    got = exact_quantiles(df, {c: F.col(c) for c in cols}, PROBS)
    assert got == {(c, p): want(v, p) for c, v in cols.items() for p in PROBS}


def test_nan_is_the_greatest(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,), (2.0,), (float("inf"),)], "x double")
    got = exact_quantiles(df, {"x": F.col("x")}, [0.25, 0.5, 0.75, 1.0])
    assert [got["x", p] for p in (0.25, 0.5, 0.75)] == [1.0, 2.0, float("inf")] and math.isnan(got["x", 1.0])


def test_more_values_than_any_sketch_keeps(spark):
    """1.5 million different values: ranks are exact, not within a millionth."""
    n = 1_500_000
    df = spark.range(n).select(((F.col("id") * 7_919) % n / 3).alias("x"))
    got = exact_quantiles(df, {"x": F.col("x")}, [0.25, 0.3333, 0.5, 0.6667])
    assert all(v == (max(math.ceil(p * n), 1) - 1) / 3 for (_, p), v in got.items())


def test_profile_and_terciles_use_them(spark):
    df = spark.range(1001).select("id", (F.col("id") * 1.5).alias("x"))
    r = profile.profile_numeric(df, ["x"]).first()
    assert (r.p25, r.p50, r.p75) == (250 * 1.5, 500 * 1.5, 750 * 1.5)
    sizes = {r.faixa: r["count"] for r in dims.dim_entity_terciles(df, "id", "x").groupBy("faixa").count().collect()}
    assert sizes == {"PEQUENO": 334, "MEDIO": 334, "GRANDE": 333}
    empty = dims.dim_entity_terciles(df.limit(0), "id", "x")
    assert empty.collect() == [] and profile.profile_numeric(df.limit(0), ["x"]).first().p50 is None
