"""Published layer tables: versions, a commit log and quarantine.

A refresh writes every table into a folder of a new version, ``<base>/<layer>/<table>/<version>``.
Nothing that was published before is touched. ``commit`` then appends one file to the log of
the layer, ``<base>/commits/<layer>``; only with that file do the new versions become the current
ones, all tables of the refresh at once. A write that fails half-way leaves a folder that no
reader ever resolves, and the former version stays readable.

A table written with rules is parted in the same pass: good rows under ``aceito=true``, rows that
break a rule under ``aceito=false`` together with the names of those rules. Rows written and rows
refused, per rule, are counted by the write itself (``Observation``), not by another scan.

A table written with a ``Layout`` is bucketed by its key and sorted within the buckets (one file each), so that
windows, aggregations and joins on the key need no shuffle. Spark keeps bucketing in the catalog: the files
are an external table of the session, declared again from the commit log by whoever reads the
version. Without that declaration they are plain Parquet files.

One writer per layer at a time (a full refresh is one job); readers may come and go.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

LOG = "seq long, at timestamp, table string, version string, columns string, rows long, refused long, retired boolean, layout string"
ACCEPTED, BROKEN = "aceito", "regras_violadas"


class Layout(NamedTuple):
    """Buckets by ``key``, sorted by ``key`` and ``sort`` within them. Rows of one key lie in one file, so the
    key must have many values and a bounded number of rows for each (one a day, say)."""

    key: str
    sort: str
    buckets: int

    def clause(self) -> str:
        return f"CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`, `{self.sort}`) INTO {self.buckets} BUCKETS"


def _log_path(base: str, layer: str) -> str:
    return f"{base.rstrip('/')}/commits/{layer}"


def commit_log(spark: SparkSession, base: str, layer: str) -> DataFrame:
    """One row per table and commit; empty before the first commit."""
    try:
        return spark.read.schema(LOG).json(_log_path(base, layer))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], LOG)
        raise


def broken_rules(rules: dict[str, Column]) -> Column:
    """The names of the rules that a row breaks; a rule is the passing condition, NULL passes."""
    return F.array_compact(F.array(*[F.when(~ok, F.lit(name)) for name, ok in rules.items()]))


class Publication:
    """One refresh of one layer."""

    def __init__(self, spark: SparkSession, base: str, layer: str):
        self.spark, self.base, self.layer = spark, base.rstrip("/"), layer
        self.version = uuid.uuid4().hex
        self.entries: list[tuple] = []
        #: refused rows by (table, rule)
        self.refused: dict[tuple[str, str], int] = {}

    def path(self, table: str) -> str:
        return f"{self.base}/{self.layer}/{table}/{self.version}"

    def write(self, df: DataFrame, table: str, rules: dict[str, Column] | None = None,
              partition_by: list[str] | None = None, layout: Layout | None = None) -> DataFrame:
        """Writes ``df`` and returns what was written (the accepted rows); visible to others after ``commit``."""
        rules = rules or {}
        if layout and (rules or partition_by):
            raise ValueError("a layout goes with neither rules nor partitions")
        seen = Observation()
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        if layout:
            # one task per bucket, by the same hash, so that a bucket is one file
            name = _declare(self.spark, self.path(table), columns, layout.clause())
            rows = df.observe(seen, F.count(F.lit(1)).alias("rows"))
            rows.repartition(layout.buckets, F.col(f"`{layout.key}`")).write.insertInto(name)
            self.entries.append((table, self.version, columns, seen.get["rows"], 0, False, layout.clause()))
            return _read(self.spark, self.path(table), columns, layout.clause())
        broken = broken_rules(rules) if rules else F.expr("cast(array() as array<string>)")
        counts = [F.count(F.lit(1)).alias("rows"), F.count_if(F.size(BROKEN) > 0).alias("refused")]
        counts += [F.count_if(F.array_contains(BROKEN, name)).alias(f"r{i}") for i, name in enumerate(rules)]
        out = df.withColumn(BROKEN, broken).observe(seen, *counts)
        out = out.withColumn(ACCEPTED, F.size(BROKEN) == 0)
        out.write.partitionBy(ACCEPTED, *(partition_by or [])).parquet(self.path(table))
        got = seen.get
        for i, name in enumerate(rules):
            if got[f"r{i}"]:
                self.refused[table, name] = got[f"r{i}"]
        self.entries.append((table, self.version, columns, got["rows"] - got["refused"], got["refused"], False, None))
        return _read(self.spark, self.path(table), columns)

    def commit(self) -> None:
        """Makes every table written here the current version, by one appended file."""
        _append(self.spark, self.base, self.layer, self.entries)


def _append(spark: SparkSession, base: str, layer: str, entries: list[tuple]) -> None:
    last = commit_log(spark, base, layer).agg(F.max("seq")).first()[0]
    rows = spark.createDataFrame(entries, LOG.split("timestamp, ", 1)[1])
    (rows.select(F.lit((last or 0) + 1).cast("long").alias("seq"), F.current_timestamp().alias("at"), "*")
     .coalesce(1).write.mode("append").json(_log_path(base, layer)))


def _declare(spark: SparkSession, path: str, columns: str, layout: str) -> str:
    """The session's external table over the bucketed files of a version; its name."""
    layer, table, version = path.rsplit("/", 3)[1:]
    name = f"strata_{layer}_{table}_{version}"
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{name}` ({columns}) USING parquet {layout} "
              f"LOCATION '{path}/{ACCEPTED}=true'")
    return name


def _read(spark: SparkSession, path: str, columns: str, layout: str | None = None, accepted: bool = True) -> DataFrame:
    if layout and accepted:
        return spark.table(f"`{_declare(spark, path, columns, layout)}`")
    whole = spark.read.schema(f"{columns}, {BROKEN} array<string>, {ACCEPTED} boolean").parquet(path)
    rows = whole.where(F.col(ACCEPTED) == accepted)
    return rows.drop(ACCEPTED, BROKEN) if accepted else rows.drop(ACCEPTED)


def current(spark: SparkSession, base: str, layer: str) -> dict[str, tuple[str, str, str | None]]:
    """{table: (path, columns, layout)} of the last committed versions."""
    last = (commit_log(spark, base, layer).where("not retired").groupBy("table")
            .agg(F.max_by(F.struct("version", "columns", "layout"), "seq").alias("v")))
    return {r["table"]: (f"{base.rstrip('/')}/{layer}/{r['table']}/{r['v'].version}", r["v"].columns, r["v"].layout)
            for r in last.collect()}            # one row per table


def read_published(spark: SparkSession, base: str, layer: str, table: str, accepted: bool = True) -> DataFrame:
    """The last committed version of a table; with ``accepted=False`` its quarantine: the refused rows
    and the names of the rules they break."""
    found = current(spark, base, layer)
    if table not in found:
        raise LookupError(f"{layer}.{table} was never published under {base}")
    return _read(spark, *found[table], accepted=accepted)


def retire(spark: SparkSession, base: str, layer: str, keep: int = 2) -> int:
    """Empties the versions that are older than the last ``keep`` of their table and notes that in the log."""
    log = commit_log(spark, base, layer).collect()          # one row per table and commit
    gone = {(r["table"], r["version"]) for r in log if r["retired"]}
    entries = []
    for table in sorted({r["table"] for r in log}):
        made = sorted((r for r in log if r["table"] == table and not r["retired"]), key=lambda r: -r["seq"])
        for r in made[keep:]:
            if (table, r["version"]) not in gone:
                spark.createDataFrame([], r["columns"]).write.mode("overwrite").parquet(
                    f"{base.rstrip('/')}/{layer}/{table}/{r['version']}")
                if r["layout"]:
                    spark.sql(f"DROP TABLE IF EXISTS `strata_{layer}_{table}_{r['version']}`")
                entries.append((table, r["version"], r["columns"], 0, 0, True, r["layout"]))
    if entries:
        _append(spark, base, layer, entries)
    return len(entries)
