"""Analytical views and answers.

Whole-set MIN/MAX windows (``OVER ()``) would move every row to one partition; here the
bounds are one global aggregate (map-side partials) attached to every row by broadcast
(R2). Per-metric bounds are a grouped aggregate joined on the metric.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.scalars import attach


def minmax_scale(x: Column, lo: Column, hi: Column, inverted: bool = False) -> Column:
    """100 * (x - min) / (max - min), or 100 * (max - x) / (max - min); zero range -> NULL;
    1 dp, decimal(5,1)."""
    num = (hi - x) if inverted else (x - lo)
    return F.round(F.lit(100) * num / F.nullif(hi - lo, F.lit(0)), 1).cast("decimal(5,1)")


def minmax_normalise(df: DataFrame, cols: dict[str, str], inverted: set[str] | None = None
                     ) -> DataFrame:
    """V1/V2: add ``out`` = min-max scaled ``col`` for each ``{col: out}``, bounds taken
    over the whole frame (NULLs ignored)."""
    inverted = inverted or set()
    bounds = df.agg(*[F.min(c).alias(f"_min_{c}") for c in cols],
                    *[F.max(c).alias(f"_max_{c}") for c in cols])
    return attach(df, bounds).select(*df.columns, *[
        minmax_scale(F.col(c), F.col(f"_min_{c}"), F.col(f"_max_{c}"), c in inverted).alias(o)
        for c, o in cols.items()])


def minmax_by_group(df: DataFrame, group: str, value: str, out: str) -> DataFrame:
    """Min-max scaling with bounds per ``group`` (grouped aggregate + join)."""
    b = df.groupBy(group).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    return (df.join(b, group).withColumn(out, minmax_scale(F.col(value), F.col("_lo"),
                                                           F.col("_hi")))
            .drop("_lo", "_hi"))


def wide_to_long(df: DataFrame, keys: list[str], metrics: list[tuple[str, str, str, str]],
                 value_type: str = "decimal(16,2)") -> DataFrame:
    """V3: one row per key x metric with label, unit and question; NULL values dropped.

    ``metrics`` = [(column, label, unit, question)]. One scan (explode of structs).
    """
    structs = [F.struct(F.lit(q).alias("pergunta"), F.lit(lbl).alias("metrica"),
                        F.lit(u).alias("unidade"), F.col(c).cast(value_type).alias("valor"))
               for c, lbl, u, q in metrics]
    return (df.select(*keys, F.explode(F.array(*structs)).alias("_m"))
            .select(*keys, "_m.*").filter(F.col("valor").isNotNull()))


def band(mean: Column, sd: Column) -> tuple[Column, Column]:
    """V5: mean - sd and mean + sd."""
    return mean - sd, mean + sd


def regression_answer(df: DataFrame, y: str, x: str) -> DataFrame:
    """N, intercept (2 dp), slope (4 dp), R2 (2 dp) and break-even x = -a/b (0 dp)
    over rows where both are present; a zero slope gives a NULL break-even."""
    d = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    a = F.regr_intercept(F.col(y).cast("double"), F.col(x).cast("double"))
    b = F.regr_slope(F.col(y).cast("double"), F.col(x).cast("double"))
    r2 = F.regr_r2(F.col(y).cast("double"), F.col(x).cast("double"))
    return d.agg(F.count(F.lit(1)).alias("meses"), a.alias("_a"), b.alias("_b"), r2.alias("_r2")) \
        .select("meses",
                F.round("_a", 2).cast("decimal(20,2)").alias("intercepto"),
                F.round("_b", 4).cast("decimal(20,4)").alias("inclinacao"),
                F.round("_r2", 2).cast("decimal(6,2)").alias("r2"),
                F.round(F.try_divide(-F.col("_a"), F.col("_b")), 0).cast("decimal(20,0)")
                .alias("x_equilibrio"))


def correlation_table(df: DataFrame, target: str,
                      candidates: list[tuple[str, str, Column | None]]) -> DataFrame:
    """One aggregate pass, one row per candidate: corr with the target and its
    square (3 dp). ``candidates`` = [(label, column, row filter or None)]."""
    aggs = []
    for i, (_, c, cond) in enumerate(candidates):
        xc = F.col(c).cast("double")
        if cond is not None:
            xc = F.when(cond, xc)
        aggs.append(F.corr(xc, F.col(target).cast("double")).alias(f"_c{i}"))
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(lbl).alias("regime"), F.col(f"_c{i}").alias("_r"))
                     for i, (lbl, _, _) in enumerate(candidates)])
    return one.select(F.explode(rows).alias("_x")).select("_x.*").select(
        "regime", F.round("_r", 3).cast("decimal(6,3)").alias("correlacao"),
        F.round(F.pow("_r", 2), 3).cast("decimal(6,3)").alias("r2"))


def correlations_wide(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Z3: several correlations in one aggregate (3 dp each)."""
    return df.agg(*[F.round(F.corr(F.col(a).cast("double"), F.col(b).cast("double")), 3)
                    .cast("decimal(6,3)").alias(name) for name, (a, b) in pairs.items()])
