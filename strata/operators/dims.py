"""Dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.quantiles import exact_quantiles

# Portuguese month names, January first.
MONTH_NAMES = ["Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
               "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro"]


def month_name(month: Column) -> Column:
    """Month number (1-12) -> Portuguese name."""
    return F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), month.cast("int"))


def calendar_days(bounds: DataFrame, start: str = "inicio", end: str = "fim") -> DataFrame:
    """One row per day between the two DATE columns of a one-row ``bounds`` frame."""
    return bounds.select(F.explode(F.sequence(F.col(start), F.col(end))).alias("data"))


def dim_calendar(days: DataFrame, season=(2, 5), scope: tuple[str, str] | None = None
                 ) -> DataFrame:
    """Calendar attributes for each day (``days`` has a DATE column ``data``).

    year, month, day, yyyy-MM, month name, quarter = ceil(month / 3), rainy season flag
    (month between ``season``), in-scope flag (date inside ``scope``).
    """
    d = F.col("data")
    m = F.month(d)
    in_scope = (d.between(F.lit(scope[0]).cast("date"), F.lit(scope[1]).cast("date"))
                if scope else F.lit(True))
    return days.select(
        d.alias("data"), F.year(d).alias("ano"), m.alias("mes"), F.dayofmonth(d).alias("dia"),
        F.date_format(d, "yyyy-MM").alias("ano_mes"), month_name(m).alias("nome_mes"),
        F.ceil(m / F.lit(3.0)).cast("int").alias("trimestre"),
        m.between(season[0], season[1]).alias("estacao_chuvosa"),
        in_scope.alias("no_recorte_analise"))


def dim_month(calendar: DataFrame) -> DataFrame:
    """Month grain rolled up from the day calendar, so attributes conform."""
    return calendar.groupBy("ano_mes").agg(
        F.max("ano").alias("ano"), F.max("mes").alias("mes"), F.max("nome_mes").alias("nome_mes"),
        F.max("trimestre").alias("trimestre"), F.max("estacao_chuvosa").alias("estacao_chuvosa"),
        F.max("no_recorte_analise").alias("no_recorte_analise"),
        F.count(F.lit(1)).alias("dias_no_mes"))


# Tercile cut points and class labels.
TERCILE_CUTS = (0.3333, 0.6667)
TERCILE_LABELS = ("PEQUENO", "MEDIO", "GRANDE")


def dim_entity_terciles(df: DataFrame, key: str, attr: str, attr_type: str = "decimal(14,2)") -> DataFrame:
    """D3: max(attr) per entity, classed by the exact terciles over the entities.

    ``attr`` is reported as a decimal and scaled by 10,000 (hectares -> m2).
    """
    base = df.groupBy(key).agg(F.max(attr).alias("_a"))
    cuts = exact_quantiles(base, {"a": F.col("_a")}, list(TERCILE_CUTS))
    a, t = F.col("_a"), [F.lit(cuts["a", p]).cast("double") for p in TERCILE_CUTS]
    ad = a.cast(attr_type)
    return base.select(
        F.col(key), ad.alias(attr),
        (ad * F.lit(10000).cast("decimal(5,0)")).cast("decimal(18,2)").alias(f"{attr}_x10000"),
        F.when(a <= t[0], F.lit(TERCILE_LABELS[0])).when(a <= t[1], F.lit(TERCILE_LABELS[1]))
        .otherwise(F.lit(TERCILE_LABELS[2])).alias("faixa"))


def dim_entity_flag(df: DataFrame, key: str, suspect: Column, note: str) -> DataFrame:
    """Distinct entities with a suspect flag and a note for the flagged ones."""
    return (df.select(key).distinct()
            .withColumn("flag_suspeita", suspect)
            .withColumn("observacao_qualidade",
                        F.when(F.col("flag_suspeita"), F.lit(note))))


# The two members, their labels and whether their density is measured.
FLUIDS = [("AGUA_DOCE", "Água doce", False), ("SALMOURA", "Salmoura", True)]


def dim_fluid(spark: SparkSession) -> DataFrame:
    """Constant dimension of the two paired members with their physical attributes.

    Area of a 1 m diameter circle: round(pi * 0.5^2, 4) = 0.7854 m2.
    """
    area = F.round(F.pi() * F.pow(F.lit(0.5), F.lit(2)), 4).cast("decimal(6,4)")
    rows = spark.createDataFrame(FLUIDS, "fluido string, descricao string, mede_densidade boolean")
    return rows.select("fluido", "descricao", F.lit(1.0).cast("decimal(4,2)").alias("diametro_m"),
                       area.alias("area_m2"), "mede_densidade")
