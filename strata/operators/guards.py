"""Load control: expected sources, empty input, reconciliation, audit."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class LoadGuardError(RuntimeError):
    pass


def open_sources(names: list[str], open_one) -> dict[str, DataFrame]:
    """A10: every expected source as a frame, or one error that lists all that cannot be opened.
    Opening reads names and schemas only; nothing is written before this has passed."""
    found, missing = {}, []
    for name in names:
        try:
            found[name] = open_one(name)
        except AnalysisException as e:
            missing.append(f"{name} ({e.getCondition()})")
    if missing:
        raise LoadGuardError(f"expected sources not found: {missing}")
    return found


def missing_sources(landed: DataFrame, expected: list[str], file_col: str = "arquivo_origem"
                    ) -> DataFrame:
    """A10: expected file names that are absent from the landed table (left anti join)."""
    spark = landed.sparkSession
    exp = spark.createDataFrame([(e,) for e in expected], f"{file_col} string")
    return exp.join(landed.select(file_col).distinct(), file_col, "left_anti")


def assert_sources(landed: DataFrame, expected: list[str], file_col: str = "arquivo_origem"):
    """A10: abort before any write when an expected source is missing."""
    missing = [r[0] for r in missing_sources(landed, expected, file_col).collect()]
    if missing:
        raise LoadGuardError(f"expected sources not found: {sorted(missing)}")


def assert_not_empty(df: DataFrame, name: str = "source"):
    """An empty input must not overwrite valid data (``isEmpty`` reads one row)."""
    if df.isEmpty():
        raise LoadGuardError(f"{name} is empty; load aborted")


def content_digest(cols: list[str]) -> Column:
    """A digest of the rows of a table that does not depend on their order: the sum of 60 bits of each row's
    hash over ``cols`` as text. Sums merge on the map side, and repeated rows count each time."""
    text = F.concat_ws("|", *[F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("-")) for c in cols])
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")
    return F.coalesce(F.sum(bits.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))


def reconcile(pairs: dict[str, tuple[DataFrame, DataFrame]], content: dict[str, list[str]] | None = None) -> DataFrame:
    """Rows in vs rows out per table, with an ``integro`` flag: tagged counts, one row per
    side and table, put side by side by a tiny aggregate.

    ``content`` names the columns (of both sides) whose contents must agree as well, so that a changed value
    is found although the counts agree; each side is still read once.
    """
    content = content or {}
    none = F.lit(None).cast("decimal(38,0)")
    sides = [df.agg(F.lit(name).alias("tabela"), F.lit(side).alias("lado"), F.count("*").alias("n"),
                    (content_digest(content[name]) if name in content else none).alias("d"))
             for name, pair in pairs.items() for side, df in enumerate(pair)]
    at = lambda c, side: F.max(F.when(F.col("lado") == side, F.col(c)))
    out = reduce(DataFrame.unionByName, sides).groupBy("tabela").agg(
        at("n", 0).alias("registros_origem"), at("n", 1).alias("registros_destino"), at("d", 0).alias("_a"), at("d", 1).alias("_b"))
    return out.select("tabela", "registros_origem", "registros_destino", (
        (F.col("registros_origem") == F.col("registros_destino")) & F.col("_a").eqNullSafe(F.col("_b"))).alias("integro"))


def assert_reconciled(report: DataFrame):
    """Raise on any mismatch (the reference only records the flag)."""
    bad = [r["tabela"] for r in report.filter(~F.col("integro")).collect()]
    if bad:
        raise LoadGuardError(f"row count mismatch or changed content for: {bad}")


def load_audit(tables: dict[str, DataFrame], file_col: str = "arquivo_origem",
               ts_cols: tuple[str, ...] = ()) -> DataFrame:
    """Per table row count, first source file and latest load times, sorted."""
    parts = []
    for name, df in tables.items():
        aggs = [F.lit(name).alias("tabela"), F.count(F.lit(1)).alias("registros"),
                F.min(file_col).alias("arquivo")]
        aggs += [F.max(c).alias(f"max_{c}") for c in ts_cols]
        parts.append(df.agg(*aggs))
    return reduce(lambda a, b: a.unionByName(b), parts).orderBy("tabela")
