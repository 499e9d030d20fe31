"""Monthly / yearly analytics.

Averages are exact decimal sum / count followed by one rounding, so results do not
depend on the order in which partial sums meet. Standard deviations are sample
standard deviations (NULL for n = 1).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.dims import month_name
from strata.operators.facts import exact_avg
from strata.operators.scalars import attach


def _round(x: Column, digits: int, dtype: str) -> Column:
    return F.round(x, digits).cast(dtype)


def ratio_of_avgs(num: str, den: str) -> Column:
    """C17: AVG(num) / NULLIF(AVG(den), 0) as one exact fraction
    (sum(num) * count(den)) / (count(num) * sum(den)); ``den`` holds whole numbers.

    The factors are widened to decimals before they are multiplied: groups of up to 10^13 rows
    and sums of up to 10^18 (whole numbers: 10^20) cannot overflow."""
    top = F.sum(num).cast("decimal(24,6)") * F.count(den).cast("decimal(13,0)")
    bottom = F.count(num).cast("decimal(13,0)") * F.sum(F.col(den).cast("decimal(20,0)")).cast("decimal(20,0)")
    return top / F.nullif(bottom, F.lit(0))


@dataclass(frozen=True)
class Mean:
    """One measure of a monthly roll-up: AVG(num), or AVG(num) / AVG(den) with ``den``, rounded.
    ``where_covered``: reported only where ``covered`` holds for a row of the month, else NULL."""

    out: str
    num: str
    digits: int
    type: str
    den: str | None = None
    where_covered: bool = False


def monthly_rollup(rows: DataFrame, date: str, means: list[Mean], covered: str, more: dict[str, Column],
                   out_month: str = "ano_mes") -> DataFrame:
    """one row per month: rounded means and ratios of means, NULL (never 0) in months that the
    driver series does not cover, and further aggregates ``more``."""
    def value(m: Mean) -> Column:
        x = ratio_of_avgs(m.num, m.den) if m.den else exact_avg(F.col(m.num))
        x = _round(x, m.digits, m.type)
        return (F.when(F.max(covered), x) if m.where_covered else x).alias(m.out)

    return rows.groupBy(F.date_format(date, "yyyy-MM").alias(out_month)).agg(
        *[c.alias(n) for n, c in more.items()], *[value(m) for m in means])


def yearly_by_entity(fact: DataFrame, stations: DataFrame, cutoff_month: int,
                     entity: str = "estacao", measure: str = "milimetros") -> DataFrame:
    """F10 step 1: per year x entity, comparable-period sum (months <= cutoff) and year sum."""
    m = F.col(measure)
    # the station dimension grows with the number of entities: no broadcast hint, AQE
    # broadcasts it at run time only when its measured size is small
    return (fact.join(stations.select(entity, "flag_suspeita"), entity)
            .groupBy(F.year("data").alias("ano"), F.col(entity), F.col("flag_suspeita"))
            .agg(F.sum(F.when(F.month("data") <= cutoff_month, m).otherwise(0))
                 .alias("mm_recorte"),
                 F.sum(m).alias("mm_ano")))


def yearly_totals(per_entity: DataFrame) -> DataFrame:
    """F10 step 2: mean over entities per year, with and without suspects (6 dp)."""
    t = "decimal(18,6)"
    return per_entity.groupBy("ano").agg(
        exact_avg(F.col("mm_recorte")).cast(t).alias("total_recorte"),
        exact_avg(F.when(~F.col("flag_suspeita"), F.col("mm_recorte"))).cast(t)
        .alias("total_recorte_sem_suspeita"),
        exact_avg(F.col("mm_ano")).cast(t).alias("total_ano"))


def yearly_events(fact: DataFrame, measure: str = "milimetros") -> DataFrame:
    """distinct days with a positive reading and the largest single reading per year."""
    return fact.groupBy(F.year("data").alias("ano")).agg(
        F.countDistinct(F.when(F.col("houve_chuva"), F.col("data"))).alias("dias_com_chuva"),
        F.max(measure).alias("maior_evento"))


def baseline(df: DataFrame, value: str, is_base: Column, by: list[str] | None = None) -> DataFrame:
    """mean (10 dp), sample sd and count of ``value`` over the baseline rows."""
    g = df.filter(is_base)
    g = g.groupBy(*by) if by else g.groupBy()
    return g.agg(exact_avg(F.col(value)).cast("decimal(28,10)").alias("media_hist"),
                 F.stddev_samp(F.col(value).cast("double")).alias("desvio_hist"),
                 F.count(value).alias("anos_hist"))


def percentile_vs_baseline(df: DataFrame, value: str, is_base: str,
                           by: list[str] | None = None) -> DataFrame:
    """100 * (baseline rows strictly below this value) / (baseline rows), per row.

    Replaces the theta self-join with windows: a running count of baseline rows over a
    RANGE frame ordered by value, minus the baseline rows tied with this value. A NULL
    value has no row below it (0). Partitioned by ``by`` when given.
    """
    by = by or []
    # baseline rows with a NULL value are never "below" anything, but they do count in n
    b = F.when(F.col(is_base) & F.col(value).isNotNull(), 1).otherwise(0)
    order = Window.partitionBy(*by).orderBy(F.col(value).asc_nulls_first()) \
        .rangeBetween(Window.unboundedPreceding, 0)
    ties = Window.partitionBy(*by, value)
    total = Window.partitionBy(*by)
    below = F.sum(b).over(order) - F.sum(b).over(ties)
    n = F.sum(F.when(F.col(is_base), 1).otherwise(0)).over(total)
    return df.withColumns({
        "_abaixo": F.when(F.col(value).isNull(), 0).otherwise(below),
        "_n_base": n,
    })


# Year classes.
DRY, WET, TYPICAL = "SECO", "CHUVOSO", "TIPICO"


def classify(x: Column, mean: Column, sd: Column) -> Column:
    """x < mean - sd -> SECO, x > mean + sd -> CHUVOSO, else TIPICO (NULLs -> TIPICO)."""
    return (F.when(x < mean - sd, F.lit(DRY)).when(x > mean + sd, F.lit(WET))
            .otherwise(F.lit(TYPICAL)))


def pct_deviation(x: Column, mean: Column, digits: int) -> Column:
    """100 * (x / mean - 1) as one exact fraction 100 * (x - mean) / mean, NULL for mean 0."""
    m = mean.cast("decimal(28,10)")
    return F.round((x - m) * F.lit(100).cast("decimal(3,0)") / F.nullif(m, F.lit(0)), digits)


def yearly_answer(fact: DataFrame, stations: DataFrame, cutoff_month: int,
                  base_years: tuple[int, int], study_year: int) -> DataFrame:
    """F10-F14 assembled (comparable-period yearly totals classified against a baseline)."""
    per_year = yearly_totals(yearly_by_entity(fact, stations, cutoff_month))
    events = yearly_events(fact)
    is_base = F.col("ano").between(*base_years)
    hist = baseline(per_year, "total_recorte_sem_suspeita", is_base)
    ranked = percentile_vs_baseline(per_year.withColumn("_base", is_base),
                                    "total_recorte_sem_suspeita", "_base")
    x = F.col("total_recorte_sem_suspeita")
    mean, sd = F.col("media_hist"), F.col("desvio_hist")
    return (attach(ranked.join(events, "ano"), hist).select(
        "ano",
        _round(F.col("total_recorte"), 1, "decimal(12,1)").alias("total_mm_recorte"),
        _round(x, 1, "decimal(12,1)").alias("total_mm_recorte_sem_suspeita"),
        _round(F.col("total_ano"), 1, "decimal(12,1)").alias("total_mm_ano"),
        "dias_com_chuva",
        _round(F.col("maior_evento"), 1, "decimal(12,1)").alias("maior_evento_mm"),
        _round(mean, 1, "decimal(12,1)").alias("media_historica_mm"),
        _round(sd, 1, "decimal(12,1)").alias("desvio_historico_mm"),
        pct_deviation(x, mean, 1).cast("decimal(8,1)").alias("desvio_vs_media_pct"),
        F.round(F.col("_abaixo").cast("decimal(20,0)") * F.lit(100)
                / F.nullif(F.col("_n_base"), F.lit(0)).cast("decimal(20,0)"), 0)
        .cast("decimal(5,1)").alias("percentil_na_serie"),
        classify(x, mean, sd).alias("classificacao"),
        (F.col("ano") == study_year).alias("ano_do_estudo")))


def classify_by_entity(fact: DataFrame, cutoff_month: int, base_years: tuple[int, int],
                       study_year: int, entity: str = "estacao",
                       measure: str = "milimetros") -> DataFrame:
    """F12-F14 per entity: each entity's comparable-period yearly totals against its own
    baseline years (mean, sd, percentile, class)."""
    m = F.col(measure)
    per = fact.groupBy(F.col(entity), F.year("data").alias("ano")).agg(
        F.sum(F.when(F.month("data") <= cutoff_month, m).otherwise(0)).alias("mm"))
    is_base = F.col("ano").between(*base_years)
    hist = baseline(per, "mm", is_base, by=[entity])
    ranked = percentile_vs_baseline(per.withColumn("_base", is_base), "mm", "_base", by=[entity])
    x, mean, sd = F.col("mm"), F.col("media_hist"), F.col("desvio_hist")
    return ranked.join(hist, entity, "left").select(
        entity, "ano", _round(x, 1, "decimal(12,1)").alias("total_mm_recorte"),
        _round(mean, 1, "decimal(12,1)").alias("media_historica_mm"),
        _round(sd, 1, "decimal(12,1)").alias("desvio_historico_mm"),
        F.round(F.col("_abaixo").cast("decimal(20,0)") * F.lit(100)
                / F.nullif(F.col("_n_base"), F.lit(0)).cast("decimal(20,0)"), 0)
        .cast("decimal(5,1)").alias("percentil_na_serie"),
        classify(x, mean, sd).alias("classificacao"),
        (F.col("ano") == study_year).alias("ano_do_estudo"))


def monthly_means(fact: DataFrame, stations: DataFrame, entity: str = "estacao",
                  measure: str = "milimetros") -> DataFrame:
    """F15 step 1: month totals per non-suspect entity, averaged over entities (6 dp).
    Months without any reading are absent, not zero."""
    per = (fact.join(stations.filter(~F.col("flag_suspeita")).select(entity), entity, "left_semi")
           .groupBy(F.year("data").alias("ano"), F.month("data").alias("mes"), F.col(entity))
           .agg(F.sum(measure).alias("mm")))
    return per.groupBy("ano", "mes").agg(exact_avg(F.col("mm")).cast("decimal(18,6)").alias("mm"))


def climatology(monthly: DataFrame, base_years: tuple[int, int]) -> DataFrame:
    """per month of year over the baseline years: mean, sd, min, max, years observed."""
    return (monthly.filter(F.col("ano").between(*base_years)).groupBy("mes").agg(
        exact_avg(F.col("mm")).alias("media"), F.stddev_samp(F.col("mm").cast("double")).alias("sd"),
        F.min("mm").alias("minimo"), F.max("mm").alias("maximo"),
        F.count(F.lit(1)).alias("anos_observados")))


# Situation of a month against its climatology.
NO_DATA, BELOW, ABOVE, INSIDE = "SEM DADO", "ABAIXO", "ACIMA", "DENTRO DA FAIXA"


def compare_climatology(monthly: DataFrame, base_years: tuple[int, int], study_year: int,
                        season=(2, 5)) -> DataFrame:
    """F16: study-year months against the climatology (left join: months without study
    data are kept with SEM DADO)."""
    h = climatology(monthly, base_years)
    a = monthly.filter(F.col("ano") == study_year).select("mes", F.col("mm").alias("_x"))
    x, mean, sd = F.col("_x"), F.col("media"), F.col("sd")
    return h.join(a, "mes", "left").select(
        "mes", month_name(F.col("mes")).alias("nome_mes"),
        _round(x, 1, "decimal(12,1)").alias("chuva_estudo_mm"),
        _round(mean, 1, "decimal(12,1)").alias("media_historica_mm"),
        _round(sd, 1, "decimal(12,1)").alias("desvio_historico_mm"),
        _round(F.col("minimo"), 1, "decimal(12,1)").alias("minimo_historico_mm"),
        _round(F.col("maximo"), 1, "decimal(12,1)").alias("maximo_historico_mm"),
        "anos_observados",
        pct_deviation(x, mean, 0).cast("decimal(8,1)").alias("desvio_vs_media_pct"),
        F.when(x.isNull(), F.lit(NO_DATA)).when(x < mean - sd, F.lit(BELOW))
        .when(x > mean + sd, F.lit(ABOVE)).otherwise(F.lit(INSIDE)).alias("situacao"),
        F.col("mes").between(*season).alias("estacao_chuvosa"))
