"""Dirty-text landing view derived from ``orders``.

A deterministic select that turns the typed ``orders`` table into the kind of all-text
table the field files land as: decimal comma, ``dd/MM/yyyy`` dates, blank / hyphen / NULL
for missing values, a label with stray blanks and a trailing dot, and re-sent or corrected
submissions of the same business key. ``k`` is ``o_orderkey``.

One scan: every order yields its base row plus (k % 11 = 0) a re-sent copy and
(k % 13 = 0) a corrected copy, produced by ``explode`` rather than a three-way union.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns of the dirty view, in order.
DIRTY_COLUMNS = ["PROTOCOLO", "SOLICDATA", "STATUS", "UNIDADE", "ESTACAO", "CRISTALIZADOR",
                 "DATAREGISTRO", "MILIMETROS", "OBSERVACOES"]
BUSINESS_KEY = ["CRISTALIZADOR", "DATAREGISTRO"]


def _measure_text(k, value):
    """First matching rule: NULL, one blank, hyphen, else decimal-comma text."""
    return (F.when(k % 29 == 0, F.lit(None).cast("string"))
             .when(k % 23 == 0, F.lit(" "))
             .when(k % 17 == 0, F.lit("-"))
             .otherwise(F.replace(value.cast("string"), F.lit("."), F.lit(","))))


def dirty_orders(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    variants = F.array(
        F.lit(0),
        F.when(k % 11 == 0, F.lit(1)),
        F.when(k % 13 == 0, F.lit(2)),
    )
    base = (orders
            .select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                    F.to_date("o_orderdate").alias("d"), "o_orderpriority")
            .withColumn("v", F.explode(F.filter(variants, lambda x: x.isNotNull()))))
    v = F.col("v")
    value = F.col("o_totalprice").cast("decimal(12,2)") + F.when(v == 2, F.lit(1)).otherwise(0) \
        .cast("decimal(3,2)")
    suffix = F.when(v == 1, F.lit("-R")).when(v == 2, F.lit("-C")).otherwise(F.lit(""))
    return base.select(
        F.concat(k.cast("string"), suffix).alias("PROTOCOLO"),
        F.date_format(F.date_add(F.col("d"), (k % 5).cast("int") + v), "dd/MM/yyyy HH:mm:ss")
        .alias("SOLICDATA"),
        F.when(F.col("o_orderstatus") == "P", F.lit("PENDING")).otherwise(F.lit("DONE"))
        .alias("STATUS"),
        F.lit("RN").alias("UNIDADE"),
        F.when(k % 4 == 0, F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(".")))
        .otherwise(F.col("o_orderpriority")).alias("ESTACAO"),
        F.lpad(F.col("o_custkey").cast("string"), 6, "0").alias("CRISTALIZADOR"),
        F.date_format(F.col("d"), "dd/MM/yyyy").alias("DATAREGISTRO"),
        _measure_text(k, value).alias("MILIMETROS"),
        F.lit(None).cast("string").alias("OBSERVACOES"),
    )


def dirty_orders_sql(orders: str = "orders") -> str:
    """The same view as DuckDB SQL (oracle side)."""
    def measure(value: str) -> str:
        return (f"CASE WHEN o_orderkey % 29 = 0 THEN CAST(NULL AS VARCHAR) "
                f"WHEN o_orderkey % 23 = 0 THEN ' ' WHEN o_orderkey % 17 = 0 THEN '-' "
                f"ELSE replace(CAST({value} AS VARCHAR), '.', ',') END")

    def select(v: int, suffix: str, extra: str) -> str:
        value = "CAST(o_totalprice AS DECIMAL(12,2))" + (" + 1.00" if v == 2 else "")
        return f"""SELECT CAST(o_orderkey AS VARCHAR) || '{suffix}' AS PROTOCOLO,
  strftime(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 + {v} AS INTEGER), '%d/%m/%Y %H:%M:%S') AS SOLICDATA,
  CASE WHEN o_orderstatus = 'P' THEN 'PENDING' ELSE 'DONE' END AS STATUS,
  'RN' AS UNIDADE,
  CASE WHEN o_orderkey % 4 = 0 THEN '  ' || o_orderpriority || '.' ELSE o_orderpriority END AS ESTACAO,
  lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS CRISTALIZADOR,
  strftime(CAST(o_orderdate AS DATE), '%d/%m/%Y') AS DATAREGISTRO,
  {measure(value)} AS MILIMETROS,
  CAST(NULL AS VARCHAR) AS OBSERVACOES
FROM {orders} {extra}"""

    return "\nUNION ALL\n".join([
        select(0, "", ""),
        select(1, "-R", "WHERE o_orderkey % 11 = 0"),
        select(2, "-C", "WHERE o_orderkey % 13 = 0"),
    ])
