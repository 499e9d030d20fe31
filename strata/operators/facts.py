"""Daily and consecutive-measurement facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.clean import pair_state, signed_pair


def fact_daily(silver: DataFrame, entity: str, date: str, measure: str,
               measure_type: str = "decimal(12,2)", out_entity: str = "estacao",
               out_measure: str = "milimetros") -> DataFrame:
    """one row per entity and day with a reading; NULL readings leave, no zero-fill.

    ``houve_chuva`` = reading > 0.
    """
    m = F.col(measure).cast(measure_type)
    return (silver.filter(F.col(measure).isNotNull())
            .select(F.col(entity).alias(out_entity), F.col(date).alias("data"),
                    m.alias(out_measure), (m > 0).alias("houve_chuva")))


def daily_means(fact: DataFrame, measure: str = "milimetros", date: str = "data",
                out: str = "chuva_mm", out_type: str = "decimal(18,6)") -> DataFrame:
    """mean over entities per day (sum / count of exact decimals, then one rounding)."""
    return fact.groupBy(date).agg(
        (F.sum(measure).cast("decimal(30,6)") / F.count(measure).cast("decimal(20,0)"))
        .cast(out_type).alias(out))


def unpivot_pairs(wide: DataFrame, keys: list[str],
                  members: dict[str, tuple[str, str, str | None]],
                  value_type: str = "decimal(12,2)", density_type: str = "double") -> DataFrame:
    """one row per (keys, member) from paired (placed, removed[, density]) columns.

    One scan (explode of an array of structs) instead of one union branch per member;
    members without a density column get NULL.
    """
    structs = [F.struct(F.lit(name).alias("fluido"),
                        F.col(p).cast(value_type).alias("colocado"),
                        F.col(r).cast(value_type).alias("retirado"),
                        (F.col(d) if d else F.lit(None)).cast(density_type).alias("densidade_be"))
               for name, (p, r, d) in members.items()]
    return (wide.select(*keys, F.explode(F.array(*structs)).alias("_m"))
            .select(*keys, "_m.*"))


def pivot_values(long: DataFrame, keys: list[str], member: str, value: str, names: dict[str, str],
                 *more: Column) -> DataFrame:
    """One row per ``keys`` with the largest ``value`` of each listed member as a column of its
    own, and further aggregates. A fixed member list: one aggregate, no extra pass for names."""
    picked = [F.max(F.when(F.col(member) == m, F.col(value))).alias(c) for m, c in names.items()]
    return long.groupBy(*keys).agg(*picked, *more)


def fact_signed_daily(pairs: DataFrame, fluid_dim: DataFrame, date: str = "data",
                      volume_type: str = "decimal(12,2)", film_type: str = "decimal(12,2)",
                      density_type: str = "decimal(4,1)",
                      density_change_type: str = "decimal(4,2)") -> DataFrame:
    """signed daily fact per member.

    state label and signed volume from the exclusive pair (B15), film = volume / area of
    the member (B16, 2 dp), density and its change against the previous row of the member
    (W3: previous row, so a NULL neighbour gives NULL).
    The dimension has one row per member and is broadcast.
    """
    dim = F.broadcast(fluid_dim.select("fluido", "area_m2"))
    j = pairs.join(dim, "fluido")
    vol = signed_pair("colocado", "retirado")
    w = Window.partitionBy("fluido").orderBy(date)
    dens = F.col("densidade_be").cast(density_type)
    return j.select(
        "fluido", F.col(date).alias("data"),
        pair_state("colocado", "retirado").alias("tipo_evento"),
        vol.cast(volume_type).alias("volume_litros"),
        F.round(vol / F.col("area_m2"), 2).cast(film_type).alias("lamina_mm"),
        dens.alias("densidade_be"),
        F.round(dens - F.lag(dens).over(w), 2).cast(density_change_type)
        .alias("variacao_densidade_be"))


def fact_consecutive(levels: DataFrame, entity: str, date: str, level: str, zero_flag: str,
                     threshold: float, scope: tuple[str, str] | None = None,
                     level_type: str = "decimal(12,2)", change_type: str = "decimal(12,2)",
                     rate_type: str = "decimal(14,4)") -> DataFrame:
    """change between consecutive measurements of each entity.

    The scope filter runs before the lag. First row per entity: previous values, change,
    rate and event flag are NULL and ``flag_base_zerada`` is FALSE. Event = change < -t
    (strict); growth = change when change >= -t, else NULL.

    ``levels`` must hold one row per (entity, date) (see ``dedup_best``), so a window
    partition holds at most one row per day of the scope, however hot the entity.
    """
    base = levels
    if scope:
        base = base.filter(F.col(date).between(F.lit(scope[0]).cast("date"),
                                               F.lit(scope[1]).cast("date")))
    base = base.select(F.col(entity), F.col(date).alias("data_medicao"),
                       F.col(level).cast(level_type).alias("nivel"),
                       F.col(zero_flag).alias("flag_zerada"))
    w = Window.partitionBy(entity).orderBy("data_medicao")
    lagged = base.select("*",
                         F.lag("nivel").over(w).alias("nivel_anterior"),
                         F.lag("data_medicao").over(w).alias("data_medicao_anterior"),
                         F.lag("flag_zerada").over(w).alias("_prev_flag"))
    days = F.datediff("data_medicao", "data_medicao_anterior")
    change = (F.col("nivel") - F.col("nivel_anterior")).cast(change_type)
    t = F.lit(-threshold)
    return lagged.select(
        entity, "data_medicao", "data_medicao_anterior", days.alias("dias_corridos"),
        "nivel", "nivel_anterior",
        change.alias("variacao"),
        F.round(change / F.nullif(days, F.lit(0)), 4).cast(rate_type).alias("variacao_dia"),
        (change < t).alias("flag_evento"),
        F.when(change >= t, change).alias("crescimento"),
        "flag_zerada",
        F.coalesce(F.col("_prev_flag"), F.lit(False)).alias("flag_base_zerada"))


def level_summary(consecutive: DataFrame, event_threshold: float) -> DataFrame:
    """Per month of measurement: measurements, events, zero levels, mean level (2 dp)
    and mean growth (2 dp, changes >= -t only)."""
    t = F.lit(-event_threshold)
    ch = F.col("variacao")
    return consecutive.groupBy(F.date_format("data_medicao", "yyyy-MM").alias("ano_mes")).agg(
        F.count(F.lit(1)).alias("medicoes"),
        F.sum(F.when(F.col("flag_evento"), 1).otherwise(0)).cast("bigint").alias("eventos"),
        F.sum(F.when(F.col("flag_zerada"), 1).otherwise(0)).cast("bigint").alias("niveis_zerados"),
        F.round(exact_avg(F.col("nivel")), 2).cast("decimal(14,2)").alias("nivel_medio"),
        F.round(exact_avg(F.when(ch >= t, ch)), 2).cast("decimal(14,2)").alias("crescimento_medio"))


def exact_avg(col: Column, sum_type: str = "decimal(28,6)") -> Column:
    """Average as exact decimal sum / count (NULL when no non-NULL value)."""
    return F.sum(col).cast(sum_type) / F.nullif(F.count(col), F.lit(0)).cast("decimal(20,0)")
