"""Answers follow the tables: a source that changes within a session changes the next answer."""

import shutil

from pyspark.sql import functions as F

from __spark_entry__ import queries
from strata.plans.registry import QUERIES
from strata.sources.tables import DRIVER_TABLES

from small_tables import SF_SMALL


def test_changed_source_changes_the_answer(spark, tmp_path):
    for t in DRIVER_TABLES:
        shutil.copy(f"{SF_SMALL}/{t}.parquet", tmp_path / f"{t}.parquet")
    ask = lambda: queries()["fact_daily"](spark, str(tmp_path)).count()
    before = ask()
    half = spark.read.parquet(f"{SF_SMALL}/orders.parquet").filter(F.col("o_orderkey") % 2 == 0).toPandas()
    half.to_parquet(tmp_path / "orders.parquet", coerce_timestamps="us")
    spark.catalog.refreshByPath(str(tmp_path))
    assert before > ask() == half.groupby([half.o_custkey, half.o_orderdate.dt.date]).ngroups


def test_plans_have_no_round_robin_and_building_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "plans only")
    for key in ("fact_monthly", "attribute_windows", "quality_checks", "yearly_answer"):
        plan = QUERIES[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "RoundRobinPartitioning" not in plan
    # only schema reads of Parquet footers may run
    assert len(tracker.getJobIdsForGroup("building")) <= 4 * len(DRIVER_TABLES)
