"""Full-refresh layer job: staging -> bronze -> silver -> gold, written as Parquet.

One job in a fixed order. Every layer is a ``Publication``: its tables are written as a new version,
audited as written, and committed together; a layer that fails leaves the versions published
before as they were, and nothing that is half written is ever visible. The next layer, and within gold the
roll-ups and the views, are built from the written tables: bronze holds text, silver parses,
corrects and deduplicates that text, gold facts read silver, roll-ups and views read gold. So
lineage ends at each table, and a lost executor costs the current one only. ``base`` defaults to a folder
under the session's ``spark.checkpoint.dir`` (the shared folder on a cluster).

Nothing is written before every expected source has been opened and found to hold rows. Counts
and contents are reconciled after bronze. The gates of silver and of gold read the written version before it
is committed; all checks but ``REPORT_ONLY`` block. Gold rows pass the write-time rules on their way to the
sink: rows that break one go to the quarantine of the table in the same pass. With ``on_broken="raise"``
such rows stop the job with the full list before gold is committed; with ``"quarantine"`` the good
rows are published and the others can be read with the names of their rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import guards, quality
from strata.plans.measurement import Model
from strata.session import ensure_checkpoint_dir
from strata.sources.landing import land_table, publish_view, stamp_bronze, stamp_layer
from strata.sources.tables import read_table
from strata.sources.versions import Layout, Publication

STAGED = ("orders", "lineitem", "customer", "supplier", "nation", "region")
LINEAGE = ("data_ingestao", "origem", "arquivo_origem", "data_carga_bronze", "origem_tabela")
SILVER = {"levels": "silver_levels", "rain": "silver_rain", "basins": "silver_basins", "submissions": "dirty_dedup"}
#: Key and order of the silver tables that later windows and aggregations read by entity (W1-W3): stored
#: bucketed and sorted. Basins are two members, too few to spread over buckets.
CO_LOCATED = {"levels": ("cristalizador", "data_medicao"), "rain": ("estacao", "data_registro"),
              "submissions": ("cristalizador", "data_registro")}
# In this order: what stands later reads the written tables before it.
GOLD = ("calendar", "dim_month", "stations", "fluids", "customers", "fact_rain", "fact_evap", "fact_level",
        "monthly", "yearly", "climatology")
#: Reported by ``quality_checks`` but not blocking: a limit of evaporation pans, which daily sums of
#: the driver's quantities outgrow.
REPORT_ONLY = {"range_film_60"}
VIEWS = ("minmax_global", "minmax_inverted", "wide_to_long", "band_view", "seasonal_view")


def write_rules(table: str) -> dict[str, Column]:
    """The seven write-time rules of the gold tables (passing conditions; a NULL passes). Limits of summed
    quantities leave room for larger tables than the driver's."""
    c = F.col
    return {"fact_rain": {"reading_0_10m": c("milimetros").between(0, 10_000_000)},
            "fact_evap": {"density_20_30": c("densidade_be").between(20, 30),
                          "film_1g": c("lamina_mm").between(-10**9, 10**9)},
            "fact_level": {"level_not_negative": c("nivel").between(0, 10_000_000),
                           "interval_1_400": c("dias_corridos").between(1, 400)},
            "monthly": {"spread_0_10m": c("variacao_desvio_cm").between(0, 10_000_000)},
            "customers": {"area_within_100k": c("c_acctbal").between(-100_000, 100_000)}}.get(table, {})


def default_base(spark: SparkSession) -> str:
    return ensure_checkpoint_dir(spark).rstrip("/") + "/strata-layers"


def typed(bronze: DataFrame, like: DataFrame) -> DataFrame:
    """The text columns of a bronze table with the types of the source (a malformed text raises)."""
    return bronze.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in like.schema])


def silver_gate(silver: dict[str, DataFrame]) -> list[DataFrame]:
    """Checks before silver is published: keys, parsed dates, signs."""
    keys = {"levels": ["cristalizador", "data_medicao"], "rain": ["estacao", "data_registro"],
            "basins": ["bacia", "data_registro"], "submissions": ["cristalizador", "data_registro"]}
    dates = {"levels": "data_medicao", "rain": "data_registro", "basins": "data_registro", "submissions": "data_registro"}
    out = [quality.check_unique(silver[t], k, f"unique_{t}") for t, k in keys.items()]
    out += [quality.check_rules(silver[t], {f"date_parsed_{t}": F.col(d).isNotNull()}) for t, d in dates.items()]
    return out + [quality.check_rules(silver["rain"], {"range_rain": quality.range_rule("milimetros", 0, 10_000_000)}),
                  quality.check_rules(silver["levels"], {"range_level": quality.range_rule("nivel", 0, 10_000_000)})]


def run_layers(spark: SparkSession, sf_dir: str, base: str | None = None, gate: bool = True,
               view_prefix: str = "vw_", on_broken: str = "raise", buckets: int | None = None) -> dict[str, str]:
    """Writes and commits every layer and registers the views; returns {layer.table: path or view name}.

    ``buckets`` of the co-located silver tables (default: the session's shuffle partitions).
    """
    from strata.plans.registry import QUERY_OF, gate_frame

    if on_broken not in ("raise", "quarantine"):
        raise ValueError(on_broken)
    base = base or default_base(spark)
    written: dict[str, str] = {}
    source = guards.open_sources(list(STAGED), lambda t: read_table(spark, sf_dir, t))
    for t, df in source.items():
        guards.assert_not_empty(df, t)

    def publish(new: Publication):
        new.commit()
        written.update({f"{new.layer}.{e[0]}": new.path(e[0]) for e in new.entries})

    # staging: all-text copies with lineage (A1, A2); bronze: staging + load metadata (A3)
    staging, raw = Publication(spark, base, "staging"), Publication(spark, base, "bronze")
    pairs = {}
    for t, df in source.items():
        staged = staging.write(land_table(df, "driver"), t)
        pairs[t] = (df, raw.write(stamp_bronze(staged, t), t))
    guards.assert_reconciled(guards.reconcile(pairs, {t: df.columns for t, df in source.items()}))
    publish(staging)
    publish(raw)

    # silver: parsed from the bronze text, corrected, one row per key (B, Q4)
    bronze = {t: typed(b.drop(*LINEAGE), source[t]) for t, (_, b) in pairs.items()}
    m = Model(spark, sf_dir, tables=bronze)
    clean = Publication(spark, base, "silver")
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = {t: Layout(*by, n) for t, by in CO_LOCATED.items()}
    back = {t: clean.write(stamp_layer(getattr(m, name), "silver"), t, layout=laid.get(t)).drop("data_carga_silver")
            for t, name in SILVER.items()}
    if gate:
        quality.run_checks(silver_gate(back), "silver gate")
    publish(clean)

    # gold: each table through its write-time rules (A6, Q18), then every check on what was written (Q17)
    last, gold = Publication(spark, base, "gold"), {}
    for t in GOLD:
        m = Model(spark, sf_dir, silver=back, tables=bronze, gold=gold)
        gold[t] = last.write(stamp_layer(getattr(m, t), "gold"), t, write_rules(t)).drop("data_carga_gold")
    if last.refused and on_broken == "raise":
        raise quality.QualityGateError(f"write-time rules broken: { {f'{t}.{r}': n for (t, r), n in last.refused.items()} }")
    m = Model(spark, sf_dir, silver=back, tables=bronze, gold=gold)
    if gate:
        report = gate_frame(m)
        quality.run_checks(report.where(~F.col("verificacao").isin(*REPORT_ONLY)), "gold gate")
    publish(last)
    for v in VIEWS:
        publish_view(QUERY_OF[v](m), view_prefix + v)
        written[f"view.{v}"] = view_prefix + v
    return written
