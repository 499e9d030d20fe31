"""Column profiling.

Every profile is one wide aggregate with map-side partials, turned into one row per column by
``stack``. Only distinct counts need a shuffle of values; they travel as 16-byte digests, so
long texts never enter an exchange, and a hot value is one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.clean import MISSING_TOKENS, try_parse_number
from strata.operators.quantiles import exact_quantiles


def per_column(df: DataFrame, cols: list[str], measures: dict) -> DataFrame:
    """One row per column (``coluna``) with the aggregates ``measures``: name -> f(column name)."""
    if not cols:
        raise ValueError(f"no column to profile among {df.columns}")
    one = df.agg(*[f(c).alias(f"m{i}_{j}") for i, c in enumerate(cols) for j, f in enumerate(measures.values())])
    rows = ", ".join(", ".join([f"'{c}'", *[f"m{i}_{j}" for j in range(len(measures))]]) for i, c in enumerate(cols))
    return one.selectExpr(f"stack({len(cols)}, {rows}) AS (coluna, {', '.join(measures)})")


def text_of(c: str) -> Column:
    return F.col(c).cast("string")


def filled(x: Column) -> Column:
    return x.isNotNull() & ~F.trim(x).isin(*MISSING_TOKENS)


def pct(part: Column, whole: Column, digits: int) -> Column:
    """round(100 * part / whole, digits) in exact decimal arithmetic (NULL when whole = 0)."""
    return F.round(part.cast("decimal(20,0)") * F.lit(100) / F.nullif(whole, F.lit(0))
                   .cast("decimal(20,0)"), digits)


def distinct_texts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(coluna, distintos): distinct texts per column, counted on 128-bit digests."""
    marks = F.array(*[F.struct(F.lit(c).alias("coluna"), F.unhex(F.md5(text_of(c))).alias("h")) for c in cols])
    seen = df.select(F.inline(marks)).where("h IS NOT NULL").groupBy("coluna", "h").agg(F.lit(1).alias("x"))
    return seen.groupBy("coluna").agg(F.count("*").alias("distintos"))


def profile_columns(df: DataFrame, cols: list[str] | None = None, require_rows: bool = True) -> DataFrame:
    """One row per column.

    linhas, nulos, vazios_ou_hifen (trimmed value in '', '-'), preenchido_pct (1 dp),
    distintos (distinct untrimmed text, NULL excluded, tokens included),
    menor / maior (lexicographic min / max of the trimmed text). With ``require_rows`` the
    result of a table without rows raises when it is read.
    """
    cols = cols or df.columns
    wide = per_column(df, cols, {
        "linhas": lambda c: F.count("*"),
        "nulos": lambda c: F.count_if(F.col(c).isNull()),
        "vazios_ou_hifen": lambda c: F.count_if(F.col(c).isNotNull() & ~filled(text_of(c))),
        "menor": lambda c: F.min(F.trim(text_of(c))),
        "maior": lambda c: F.max(F.trim(text_of(c)))})
    n = F.col("linhas")
    if require_rows:
        wide = wide.withColumn("linhas", F.when(n > 0, n).otherwise(F.raise_error(F.lit("table without rows"))))
    present = n - F.col("nulos") - F.col("vazios_ou_hifen")
    return wide.join(distinct_texts(df, cols), "coluna", "left").select(
        "coluna", "linhas", "nulos", "vazios_ou_hifen", pct(present, n, 1).cast("decimal(4,1)").alias("preenchido_pct"),
        F.coalesce("distintos", F.lit(0)).cast("bigint").alias("distintos"), "menor", "maior")


def numeric_columns(df: DataFrame, cols: list[str] | None = None,
                    threshold: float = 0.9) -> DataFrame:
    """Per column, filled values, values that parse as numbers, and whether the column
    qualifies (filled > 0 and parsed / filled >= threshold)."""
    wide = per_column(df, cols or df.columns, {
        "preenchidos": lambda c: F.count_if(filled(text_of(c))),
        "numericos": lambda c: F.count_if(filled(text_of(c)) & try_parse_number(F.col(c)).isNotNull())})
    have, parsed = F.col("preenchidos"), F.col("numericos")
    return wide.withColumn("numerica", (have > 0) & (parsed >= F.lit(threshold) * have))


def profile_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count / mean / stddev / min / quartiles / max per column; text is parsed tolerantly.

    Unknown columns are skipped; none left raises. Quartiles are exact values of the columns.
    """
    kinds = {f.name: f.dataType for f in df.schema}
    cols = [c for c in cols if c in kinds]

    def number(c: str) -> Column:
        return F.col(c).cast("double") if isinstance(kinds[c], T.NumericType) else try_parse_number(F.col(c))

    quarts = exact_quantiles(df, {c: number(c) for c in cols}, [0.25, 0.5, 0.75]) if cols else {}
    quart = lambda p: lambda c: F.lit(quarts[c, p]).cast("double")
    return per_column(df, cols, {
        "contagem": lambda c: F.count(number(c)),
        "media": lambda c: F.round(F.avg(number(c)), 4).cast("decimal(20,4)"),
        "desvio": lambda c: F.round(F.stddev_samp(number(c)), 4).cast("decimal(20,4)"),
        "minimo": lambda c: F.min(number(c)), "p25": quart(0.25), "p50": quart(0.5), "p75": quart(0.75),
        "maximo": lambda c: F.max(number(c))})


def top_values(df: DataFrame, col: str, n: int = 10) -> DataFrame:
    """Most frequent trimmed values, ties broken by the value (NULL first)."""
    seen = domain_counts(df, F.trim(text_of(col))).withColumnRenamed("registros", "ocorrencias")
    return seen.sort(F.col("ocorrencias").desc(), F.col("valor").asc_nulls_first()).limit(n)


def completeness(df: DataFrame, cols: list[str]) -> DataFrame:
    """P5: total, NULLs and NULL percentage (2 dp) per column, in one aggregate pass."""
    one = df.agg(F.count(F.lit(1)).alias("_t"),
                 *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', _n{i}" for i, c in enumerate(cols))
    long = one.selectExpr("_t", f"stack({len(cols)}, {stack}) AS (coluna, nulos)")
    return long.select("coluna", F.col("_t").alias("total"), F.col("nulos").cast("bigint"),
                       pct(F.col("nulos"), F.col("_t"), 2).cast("decimal(5,2)").alias("pct_nulos"))


def missing_kinds(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column, hyphens, blank-or-NULL and filled values (one pass)."""
    aggs = []
    for i, c in enumerate(cols):
        t = F.trim(F.col(c))
        aggs += [F.count_if(t == "-").alias(f"_h{i}"),
                 F.count_if(F.col(c).isNull() | (t == "")).alias(f"_v{i}"),
                 F.count_if(F.col(c).isNotNull() & (t != "-") & (t != "")).alias(f"_p{i}")]
    stack = ", ".join(f"'{c}', _h{i}, _v{i}, _p{i}" for i, c in enumerate(cols))
    return df.agg(*aggs).selectExpr(
        f"stack({len(cols)}, {stack}) AS (coluna, hifen, vazio_ou_nulo, preenchido)")


def fill_by_group(df: DataFrame, group: str | Column, col: str, date: str | Column) -> DataFrame:
    """Rows, filled values, filled percentage (1 dp) and first/last date per group."""
    g = F.col(group) if isinstance(group, str) else group
    d = F.col(date) if isinstance(date, str) else date
    t = F.trim(F.col(col).cast("string"))
    filled = t.isNotNull() & ~t.isin(*MISSING_TOKENS)
    return (df.groupBy(g.alias("grupo"))
            .agg(F.count(F.lit(1)).alias("registros"), F.count_if(filled).alias("preenchidos"),
                 F.min(d).alias("primeira_data"), F.max(d).alias("ultima_data"))
            .withColumn("pct_preenchido",
                        pct(F.col("preenchidos"), F.col("registros"), 1).cast("decimal(4,1)")))


def domain_counts(df: DataFrame, col: str | Column) -> DataFrame:
    """Rows per member of a categorical column; NULL is its own member."""
    c = F.col(col) if isinstance(col, str) else col
    return df.groupBy(c.alias("valor")).agg(F.count(F.lit(1)).alias("registros"))
