"""Silver and gold tables of the measurement model, built from the driver's tables.

``Model(spark, sf_dir)`` exposes each layer table as a lazily built DataFrame; queries
pick what they need and Catalyst prunes the rest. Nothing here collects data.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.clean import (normalize_label, parse_date, parse_number, parse_ts)
from strata.operators import dims, facts, quality, stats, windows
from strata.operators.scalars import product
from strata.operators.windows import Agg
from strata.plans import spec
from strata.sources.dirty import dirty_orders
from strata.sources.tables import read_table


class Model:
    def __init__(self, spark: SparkSession, sf_dir: str, silver: dict[str, DataFrame] | None = None,
                 tables: dict[str, DataFrame] | None = None, gold: dict[str, DataFrame] | None = None):
        """``tables`` optionally supplies source tables (else they are read from ``sf_dir``).
        ``silver`` optionally supplies already written silver tables
        (keys ``levels``, ``rain``, ``basins``); gold is then built from them. ``gold`` optionally
        supplies written gold tables under their names here; whatever depends on them reads them."""
        self.spark, self.sf_dir = spark, sf_dir
        self.__dict__.update(gold or {})        # a cached property that is set already
        self._tables: dict[str, DataFrame] = dict(tables or {})
        self._silver = silver or {}
        self._written = bool(silver or gold)

    def sharing(self) -> Model:
        """The model for a query that reads the levels and their changes several times; this one if it has written tables."""
        return self if self._written else SharedModel(self.spark, self.sf_dir, tables=self._tables)

    def table(self, name: str) -> DataFrame:
        """One scan definition per table (file listing and schema read once)."""
        if name not in self._tables:
            self._tables[name] = read_table(self.spark, self.sf_dir, name)
        return self._tables[name]

    # ------------------------------------------------------------ bronze-like text
    @cached_property
    def dirty(self) -> DataFrame:
        return dirty_orders(self.table("orders"))

    @cached_property
    def dirty_typed(self) -> DataFrame:
        """Approved rows, typed and renamed (protocol and submission kept)."""
        d = self.dirty.filter(F.col("STATUS") == "DONE")
        return d.select(
            F.col("PROTOCOLO").alias("protocolo"),
            normalize_label("ESTACAO").alias("estacao"),
            parse_number("CRISTALIZADOR", "int").alias("cristalizador"),
            parse_date("DATAREGISTRO").alias("data_registro"),
            parse_number("MILIMETROS").alias("milimetros"),
            parse_ts("SOLICDATA").alias("solicdata"))

    @cached_property
    def dirty_dedup(self) -> DataFrame:
        """Q4: present measure first, newest submission, largest value, then protocol."""
        return quality.dedup_best(
            self.dirty_typed, ["cristalizador", "data_registro"],
            [F.col("milimetros").isNotNull().desc(), F.col("solicdata").desc_nulls_last(),
             F.col("milimetros").desc_nulls_last(), F.col("protocolo").desc()])

    # ------------------------------------------------------------ silver
    @cached_property
    def silver_levels(self) -> DataFrame:
        if "levels" in self._silver:
            return self._silver["levels"]
        return self._build_silver_levels()

    def _build_silver_levels(self) -> DataFrame:
        li = self.table("lineitem").select(
            "l_orderkey", "l_linenumber", F.col("l_suppkey").alias("cristalizador"),
            F.to_date("l_shipdate").alias("data_medicao"), F.col("l_extendedprice").alias("nivel"))
        best = quality.dedup_best(li, ["cristalizador", "data_medicao"], [
            F.col("l_orderkey").desc(), F.col("l_linenumber").desc(), F.col("nivel").desc_nulls_last()])
        return best.select("cristalizador", "data_medicao", "nivel",
                           (F.col("nivel") < spec.ZERO_FLOOR).alias("flag_zerada"))

    @cached_property
    def silver_rain(self) -> DataFrame:
        if "rain" in self._silver:
            return self._silver["rain"]
        return self._build_silver_rain()

    def _build_silver_rain(self) -> DataFrame:
        return self.table("orders").groupBy(
            F.col("o_custkey").alias("estacao"), F.to_date("o_orderdate").alias("data_registro")).agg(
            F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("milimetros"))

    @cached_property
    def silver_basins(self) -> DataFrame:
        if "basins" in self._silver:
            return self._silver["basins"]
        return self._build_silver_basins()

    def _build_silver_basins(self) -> DataFrame:
        li = self.table("lineitem")
        q = F.col("l_quantity").cast("decimal(12,2)")

        def net(cond_a, cond_b):
            a = F.sum(F.when(cond_a, q))
            b = F.sum(F.when(cond_b, q))
            return F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0))

        wide = li.groupBy(F.col("l_returnflag").alias("bacia"),
                          F.to_date("l_shipdate").alias("data_registro")).agg(
            net(F.col("l_linestatus") == "O", F.col("l_linestatus") == "F").alias("_n1"),
            net(F.col("l_discount") >= 0.05, F.col("l_discount") < 0.05).alias("_n2"),
            (F.lit(20) + F.lit(100) * F.max(F.col("l_discount").cast("decimal(4,2)")))
            .cast("double").alias("salmoura_densidade"))
        n1, n2 = F.col("_n1"), F.col("_n2")
        return wide.select(
            "bacia", "data_registro",
            F.when(n1 > 0, n1).cast("decimal(12,2)").alias("agua_doce_colocado"),
            F.when(n1 < 0, -n1).cast("decimal(12,2)").alias("agua_doce_retirado"),
            F.when(n2 > 0, n2).cast("decimal(12,2)").alias("salmoura_colocado"),
            F.when(n2 < 0, -n2).cast("decimal(12,2)").alias("salmoura_retirado"),
            "salmoura_densidade")

    # ------------------------------------------------------------ dimensions
    @cached_property
    def customers(self) -> DataFrame:
        """D3: customers by terciles of their balance."""
        return dims.dim_entity_terciles(self.table("customer"), "c_custkey", "c_acctbal")

    @cached_property
    def calendar(self) -> DataFrame:
        """D1 over whole years covering the level and driver series."""
        o = self.table("orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
        li = self.table("lineitem").agg(F.min("l_shipdate").alias("c"), F.max("l_shipdate").alias("d"))
        bounds = product(o, li).select(
            F.make_date(F.year(F.least("a", "c")), F.lit(1), F.lit(1)).alias("inicio"),
            F.make_date(F.year(F.greatest("b", "d")), F.lit(12), F.lit(31)).alias("fim"))
        return dims.dim_calendar(dims.calendar_days(bounds), season=spec.SEASON, scope=spec.LEVEL_SCOPE)

    @cached_property
    def dim_month(self) -> DataFrame:
        return dims.dim_month(self.calendar)

    @cached_property
    def stations(self) -> DataFrame:
        return dims.dim_entity_flag(
            self.silver_rain, "estacao",
            F.col("estacao") % spec.SUSPECT_MOD == spec.SUSPECT_REM, spec.SUSPECT_NOTE)

    @cached_property
    def fluids(self) -> DataFrame:
        return dims.dim_fluid(self.spark)

    # ------------------------------------------------------------ facts
    @cached_property
    def fact_rain(self) -> DataFrame:
        return facts.fact_daily(self.silver_rain, "estacao", "data_registro", "milimetros")

    @cached_property
    def rain_day(self) -> DataFrame:
        return facts.daily_means(self.fact_rain)

    @cached_property
    def pairs(self) -> DataFrame:
        b = self.silver_basins.filter(
            (F.col("bacia") == spec.BASIN_SCOPE)
            & F.col("data_registro").between(F.lit(spec.LEVEL_SCOPE[0]).cast("date"),
                                             F.lit(spec.LEVEL_SCOPE[1]).cast("date")))
        members = {
            spec.BASIN_MEMBERS[0]: ("agua_doce_colocado", "agua_doce_retirado", None),
            spec.BASIN_MEMBERS[1]: ("salmoura_colocado", "salmoura_retirado", "salmoura_densidade"),
        }
        return facts.unpivot_pairs(b.withColumnRenamed("data_registro", "data"), ["data"], members)

    @cached_property
    def fact_evap(self) -> DataFrame:
        return facts.fact_signed_daily(self.pairs, self.fluids)

    @cached_property
    def evap_day(self) -> DataFrame:
        """C5 pivot: one row per day with each member's film and a removal flag."""
        films = dict(zip(spec.BASIN_MEMBERS, ("evap_agua_mm", "evap_salmoura_mm")))
        wide = facts.pivot_values(self.fact_evap, ["data"], "fluido", "lamina_mm", films,
                                  F.max((F.col("tipo_evento") == "RETIRADA").cast("int")).alias("teve_retirada"))
        return wide

    @cached_property
    def fact_level(self) -> DataFrame:
        return facts.fact_consecutive(
            self.silver_levels, "cristalizador", "data_medicao", "nivel", "flag_zerada",
            spec.EVENT_THRESHOLD, scope=spec.LEVEL_SCOPE)

    @cached_property
    def windows(self) -> DataFrame:
        """Level windows without events, with driver attribution and coverage."""
        w = (self.fact_level
             .filter(F.col("data_medicao_anterior").isNotNull() & ~F.col("flag_evento"))
             .select("cristalizador", "data_medicao", "data_medicao_anterior", "dias_corridos",
                     "variacao", "crescimento", "flag_base_zerada"))
        # both daily drivers, each joined into the calendar of the analysis range
        w = windows.attribute_windows(w, [self.rain_day, self.evap_day], [
            Agg("sum", "chuva_volume_mm", "chuva_mm"),
            Agg("count_pos", "chuva_dias_registrados", "chuva_mm"),
            Agg("max", "chuva_max_dia_mm", "chuva_mm"),
            Agg("count", "dias_lidos_janela", "chuva_mm"),
            Agg("sum", "evap_agua_total_mm", "evap_agua_mm"),
            Agg("sum", "evap_salmoura_total_mm", "evap_salmoura_mm"),
            Agg("sum", "dias_retirada_janela", "teve_retirada"),
            Agg("count", "dias_bacia_janela", "teve_retirada"),
        ])
        return windows.with_coverage(
            w, {"cobertura_pluviometrica_ok": self.silver_rain.filter(F.col("milimetros").isNotNull())
                .select("data_registro"),
                "cobertura_bacia_ok": self.pairs.select("data")}, "data_medicao")

    @cached_property
    def monthly(self) -> DataFrame:
        """F9 on the attributed windows; rain measures are NULL in uncovered months."""
        m = stats.Mean
        return stats.monthly_rollup(self.windows, "data_medicao", [
            m("variacao_media_cm", "variacao", 3, "decimal(14,3)"),
            m("dias_corridos_medio", "dias_corridos", 1, "decimal(8,1)"),
            m("chuva_volume_mm", "chuva_volume_mm", 1, "decimal(12,1)", where_covered=True),
            m("chuva_dias_registrados", "chuva_dias_registrados", 1, "decimal(8,1)", where_covered=True),
            m("chuva_intensidade_mm_dia", "chuva_volume_mm", 2, "decimal(12,2)", "chuva_dias_registrados", True),
            m("chuva_max_dia_mm", "chuva_max_dia_mm", 1, "decimal(12,1)", where_covered=True),
            m("dias_lidos_janela", "dias_lidos_janela", 1, "decimal(8,1)", where_covered=True),
            m("evaporacao_agua_mm_dia", "evap_agua_total_mm", 2, "decimal(12,2)", "dias_corridos"),
            m("evaporacao_salmoura_mm_dia", "evap_salmoura_total_mm", 2, "decimal(12,2)", "dias_corridos"),
            m("dias_retirada_janela", "dias_retirada_janela", 1, "decimal(8,1)"),
            m("dias_bacia_janela", "dias_bacia_janela", 1, "decimal(8,1)"),
        ], "cobertura_pluviometrica_ok", {
            "cristalizadores": F.count(F.lit(1)),
            "variacao_desvio_cm": F.round(F.stddev_samp(F.col("variacao").cast("double")), 3).cast("decimal(14,3)"),
            "medicoes_pos_colheita": F.count_if("flag_base_zerada"),
            "cobertura_pluviometrica_ok": F.max("cobertura_pluviometrica_ok"),
            "cobertura_bacia_ok": F.max("cobertura_bacia_ok"),
        })

    @cached_property
    def yearly(self) -> DataFrame:
        return stats.yearly_answer(self.fact_rain, self.stations, spec.CUTOFF_MONTH,
                                   spec.BASE_YEARS, spec.STUDY_YEAR)

    @cached_property
    def month_means(self) -> DataFrame:
        return stats.monthly_means(self.fact_rain, self.stations)

    @cached_property
    def climatology(self) -> DataFrame:
        return stats.compare_climatology(self.month_means, spec.BASE_YEARS, spec.STUDY_YEAR,
                                         season=spec.SEASON)


class SharedModel(Model):
    """Model for a query that reads the levels and their changes several times.

    Both are frames that count some of their rows (``Dataset.observe``): neither filters nor the pruning of the
    counted column pass that, so every reader wants the same of what lies below, and Spark
    shuffles the levels once by (entity, day) and once by entity for all of them.
    """

    @cached_property
    def silver_levels(self) -> DataFrame:
        return super().silver_levels.observe("silver_levels", F.count(F.lit(1)).alias("linhas"))

    @cached_property
    def fact_level(self) -> DataFrame:
        return super().fact_level.observe("fact_level", F.count_if("flag_base_zerada").alias("pos_zerada"))
