"""Landing, lineage stamps and layer sinks.

Layers hold Parquet tables in versions (``<base>/<layer>/<table>/<version>``). Every write is a
full refresh, which is what the modelled loads do; it becomes visible by a commit (``versions``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.versions import Publication, read_published

# Lineage column names of each layer.
STAGING_LINEAGE = ("data_ingestao", "origem", "arquivo_origem")
BRONZE_LINEAGE = ("data_carga_bronze", "origem_tabela")


def text_schema(columns: list[str]) -> T.StructType:
    """All-string, nullable schema: nothing is inferred at landing."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def land_text(spark: SparkSession, path: str, columns: list[str], sep: str = ",",
              header: bool = True, multi_line: bool = False) -> DataFrame:
    """A1: read delimited text, all columns as text.

    With a header, columns are found by their names in it, whatever their order; a missing one
    raises. A record with more or fewer cells than the header raises when it is read. Empty
    cells become NULL; a literal '-' stays text. ``multi_line`` allows line breaks inside quotes
    (such a file is one split).
    """
    reader = (spark.read.option("sep", sep).option("mode", "FAILFAST").option("multiLine", multi_line)
              .option("escape", '"'))
    if header:
        names = reader.option("header", True).csv(path).columns          # reads the first line only
        reader = reader.option("header", True).option("enforceSchema", False)
    else:
        names = columns
    absent = [c for c in columns if c not in names]
    if absent:
        raise ValueError(f"{path}: columns {absent} are not among {names}")
    whole = reader.schema(text_schema(names)).csv(path)
    return whole.select(*columns)


def as_text(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """A1 from a typed table: every (selected) column cast to string."""
    cols = columns or df.columns
    return df.select(*[F.col(c).cast("string").alias(c) for c in cols])


def stamp(df: DataFrame, origem: str, arquivo: str | None = None) -> DataFrame:
    """A2 staging lineage: load time, source system and source file name.

    Without an explicit name the file name comes from the scan metadata.
    """
    arq = F.lit(arquivo) if arquivo is not None else F.col("_metadata.file_name")
    return df.withColumns({
        "data_ingestao": F.current_timestamp(),
        "origem": F.lit(origem),
        "arquivo_origem": arq,
    })


def stamp_bronze(df: DataFrame, table: str, source_layer: str = "staging") -> DataFrame:
    """A3 bronze lineage: load time and source table."""
    return df.withColumns({
        "data_carga_bronze": F.current_timestamp(),
        "origem_tabela": F.lit(f"{source_layer}.{table}"),
    })


def stamp_layer(df: DataFrame, layer: str) -> DataFrame:
    """A4: ``data_carga_<layer>`` = load time."""
    return df.withColumn(f"data_carga_{layer}", F.current_timestamp())


def land_table(df: DataFrame, origem: str) -> DataFrame:
    """A1 + A2 of a scanned table: all columns as text, with the name of the scanned file."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns], F.current_timestamp().alias("data_ingestao"),
                     F.lit(origem).alias("origem"), F.col("_metadata.file_name").alias("arquivo_origem"))


def write_layer(df: DataFrame, base: str, layer: str, table: str,
                partition_by: list[str] | None = None) -> str:
    """A5/A6 full-refresh sink of one table: a new version with its own data and schema, committed once
    it is complete; a failed write leaves the former version as it was. Returns the written path."""
    new = Publication(df.sparkSession, base, layer)
    new.write(df, table, partition_by=partition_by)
    new.commit()
    return new.path(table)


def read_layer(spark: SparkSession, base: str, layer: str, table: str) -> DataFrame:
    """A8 scan of the last committed version of a layer table."""
    return read_published(spark, base, layer, table)


def publish_view(df: DataFrame, name: str) -> DataFrame:
    """Register an unmaterialised view."""
    df.createOrReplaceTempView(name)
    return df


def sample(df: DataFrame, n: int = 10, seed: int = 0) -> DataFrame:
    """``n`` rows (the limit is the feature), the same ones on every run: those with the smallest
    hashes of their whole content. Each task keeps its n smallest (top-n under the limit), so nothing is sorted
    as a whole. Repeated rows have equal hashes and are taken together."""
    text = F.concat_ws("|", *[F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("-")) for c in df.columns])
    key = F.md5(F.concat(F.lit(f"{seed}|"), text).cast("binary"))
    return df.withColumn("_place", key).orderBy("_place").limit(n).drop("_place")
