"""Exact quantiles by histogram refinement.

The quantile p of n values is the value of rank ``ceil(p n)`` (the first one for p = 0). Values are counted
in ``BINS`` bins between the least and the greatest one; the bin that holds the rank tells how many values lie
below it, and its own least and greatest value are the next interval. It ends when both are equal,
which takes two or three passes for usual columns; each pass puts a value into another bin than the greatest, so
it always ends. A pass is a narrow scan and a hash aggregate with map-side combine: at most ``BINS`` rows
per task and interval, whatever the size of the table, and no sketch. The driver gets one row per wanted
rank and pass. All columns and ranks are refined in the same passes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS = 1 << 14
_LOW, _HIGH, _NAN = -1, BINS, BINS + 1      # bins of -inf, inf and NaN, in the order of Spark's doubles


def _finite(v: Column) -> Column:
    return ~F.isnan(v) & (F.abs(v) < float("inf"))


def exact_quantiles(df: DataFrame, cols: dict[str, Column], probs: list[float]) -> dict[tuple[str, float], float | None]:
    """{(name, p): value} of the non-NULL values of each column expression (as doubles); None without any."""
    spark = df.sparkSession
    entries = [F.struct(F.lit(n).alias("name"), c.cast("double").alias("v")) for n, c in cols.items()]
    values = df.select(F.inline(F.array(*entries))).where(F.col("v").isNotNull())
    inside = F.when(_finite(F.col("v")), F.col("v"))
    found: dict[tuple[str, float], float | None] = {(n, p): None for n in cols for p in probs}
    todo = []                                   # (key, interval, rank within it)
    for r in values.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min(inside).alias("lo"), F.max(inside).alias("hi")).collect():
        whole = (r["name"], r["lo"], r["hi"], True)
        todo += [((r["name"], p), whole, max(math.ceil(p * r["n"]), 1)) for p in probs]
    while todo:
        spans = sorted({span for _, span, _ in todo}, key=str)
        at = {span: i for i, span in enumerate(spans)}
        known = spark.createDataFrame([(i, *span) for i, span in enumerate(spans)], "s int, name string, lo double, hi double, whole boolean")
        ranks = spark.createDataFrame([(at[span], rank) for _, span, rank in todo], "s int, rank long").distinct()
        width = F.col("hi") / 2 - F.col("lo") / 2             # halves: the difference may not fit a double
        place = F.when(width > 0, F.floor((F.col("v") / 2 - F.col("lo") / 2) / F.when(width > 0, width) * BINS)).otherwise(0)
        bin_ = (F.when(F.isnan("v"), _NAN).when(F.col("v") == float("inf"), _HIGH).when(F.col("v") == float("-inf"), _LOW)
                .otherwise(F.least(place, F.lit(BINS - 1)))).cast("int")
        # the intervals are as many as the wanted ranks at most
        held = values.join(F.broadcast(known), "name").where(F.col("whole") | F.col("v").between(F.col("lo"), F.col("hi")))
        bins = held.groupBy("s", bin_.alias("bin")).agg(F.count(F.lit(1)).alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        upto = F.sum("c").over(Window.partitionBy("s").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
        hit = (bins.withColumn("upto", upto).join(F.broadcast(ranks), "s")
               .where((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("c"))))
        got = {(r["s"], r["rank"]): r for r in hit.collect()}
        left = []
        for key, span, rank in todo:
            r = got[at[span], rank]
            if r["bin"] in (_LOW, _HIGH, _NAN) or r["lo"] == r["hi"]:
                found[key] = r["lo"]
            else:
                left.append((key, (key[0], r["lo"], r["hi"], False), rank - (r["upto"] - r["c"])))
        todo = left
    return found
