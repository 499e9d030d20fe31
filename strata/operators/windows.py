"""Attribution of a daily driver series to level windows ``(prev, cur]``.

The literal form is a left join on ``d > prev AND d <= cur`` followed by a group by
window. Without an equi-key Spark plans it as a broadcast nested loop join (windows x days).

Here the days are indexed in two steps of hash aggregates and equi-joins, without sorting them:

* *nodes*: days are numbered since 1970; node (k, j) stands for the days ``j 2^k .. (j + 1) 2^k - 1`` and
  holds the sum, counts and maximum of each measure over them. Levels reach to the longest window that the
  DATE type can express; a day of the driver adds one row per level to a hash aggregate with map-side
  combine, so the index is bounded by the calendar, never by the data;
* *cover*: the distinct pairs (prev, cur) are taken first, however many windows share them. A pair of n days is the
  disjoint union of at most 2 log2(n) nodes, found level by level from the pair alone; it joins them on
  (k, j) and adds them up.

Windows then join the result on their pair. Sums are exact decimals, so the order in which nodes meet
does not matter. One path for every size; what is broadcast is left to adaptive execution, which
knows the sizes.
"""

from __future__ import annotations

from dataclasses import dataclass

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.scalars import attach, product

LEVELS = 22     # 2^22 days exceed the whole range of the DATE type


@dataclass(frozen=True)
class Agg:
    """One aggregate of the daily series over a window.

    kind: 'sum' (NULL when no non-NULL value), 'count_pos' (values > 0),
          'max', 'count_rows' (driver rows present), 'count' (non-NULL values).
    """
    kind: str
    out: str
    col: str | None = None


def _days(tables: list[DataFrame], date: str, cols: list[str]) -> DataFrame:
    """One row per day ``_i`` (days since 1970) that some table has, with the values of all."""
    parts = []
    for t in tables:
        held = [F.col(c) if c in t.columns else F.lit(None).alias(c) for c in cols]
        parts.append(t.select(F.unix_date(F.to_date(F.col(date))).alias("_i"), *held))
    if len(parts) == 1:
        return parts[0]
    # one row per date in each table, so the maximum is the one value
    return reduce(DataFrame.unionAll, parts).groupBy("_i").agg(*[F.max(c).alias(c) for c in cols])


def _measures(aggs: list[Agg], sum_type: str) -> dict[str, tuple[Column, Column]]:
    """name -> (aggregate of a node over its days, aggregate of a window over its nodes)."""
    out = {}
    for a in aggs:
        if a.kind == "sum":
            out[f"sum_{a.col}"] = F.sum(F.col(a.col).cast(sum_type)), F.sum(f"sum_{a.col}")
        elif a.kind == "max":
            out[f"max_{a.col}"] = F.max(a.col), F.max(f"max_{a.col}")
        elif a.kind == "count":
            out[f"count_{a.col}"] = F.count(a.col), F.sum(f"count_{a.col}")
        elif a.kind == "count_pos":
            out[f"count_pos_{a.col}"] = F.count_if(F.col(a.col) > 0), F.sum(f"count_pos_{a.col}")
        elif a.kind == "count_rows":
            out["count_rows"] = F.count(F.lit(1)), F.sum("count_rows")
        else:
            raise ValueError(a.kind)
    return out


def _levels(lo: Column, hi: Column) -> Column:
    """floor(log2(days)) of the days lo < .. <= hi: the bit length of their number, less one."""
    return F.length(F.bin(hi - lo)) - 1


def _cover(lo: Column, hi: Column) -> Column:
    """The nodes (k, j) whose days make up ``(lo, hi]``, at most two per level.

    Of the days ``[a, b)`` the nodes of level k that lie inside are numbered ``ceil(a / 2^k)`` to
    ``floor(b / 2^k) - 1``. The first belongs to no larger node inside if its number is odd, the last if
    the number after it is odd; they are taken, once if they are the same.
    """
    def at(k):
        width = F.call_function("shiftleft", F.lit(1).cast("bigint"), k)
        first = F.ceil((lo + 1) / width).cast("bigint")
        end = F.floor((hi + 1) / width).cast("bigint")
        odd = first.bitwiseAND(F.lit(1)) == 1
        node = lambda j: F.struct(k.alias("k"), j.alias("j"))
        left = F.when((first < end) & odd, node(first))
        right = F.when((F.when(odd, first + 1).otherwise(first) < end) & (end.bitwiseAND(F.lit(1)) == 1), node(end - 1))
        return F.array(left, right)

    return F.array_compact(F.flatten(F.transform(F.sequence(F.lit(0), _levels(lo, hi)), at)))


def attribute_windows(windows: DataFrame, daily: DataFrame | list[DataFrame], aggs: list[Agg],
                      prev: str = "data_medicao_anterior", cur: str = "data_medicao",
                      date: str = "data", sum_type: str = "decimal(28,6)") -> DataFrame:
    """Add one column per ``Agg`` to ``windows`` for the days in ``(prev, cur]``.

    ``daily`` (one frame or a list) must have one row per ``date``; a list behaves like the full
    outer join of its frames on ``date``. Windows with NULL bounds, or that end before they
    start, get NULL sums/max and zero counts, like a left join that matches nothing.
    """
    tables = daily if isinstance(daily, list) else [daily]
    measures = _measures(aggs, sum_type)
    w = windows.withColumns({"_p": F.unix_date(F.to_date(prev)), "_c": F.unix_date(F.to_date(cur))})
    # The distinct pairs. The hash (never null) looks at every column, so that this side reads the same columns
    # as the windows themselves: Spark then shuffles the rows that windows are made of once, for both.
    pairs = (w.where(F.col("_c") > F.col("_p")).groupBy("_p", "_c")
             .agg(F.bit_or(F.xxhash64(*[F.col(f"`{c}`") for c in windows.columns])).alias("_all"))
             .where(F.col("_all").isNotNull()).select("_p", "_c"))

    # day numbers before 1970 shift like the others
    days = _days(tables, date, sorted({a.col for a in aggs if a.col})).where(F.col("_i").isNotNull())
    nodes = (days.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(LEVELS))))
             .withColumn("j", F.expr("shiftright(cast(_i as bigint), k)"))
             .groupBy("k", "j").agg(*[node.alias(n) for n, (node, _) in measures.items()]))
    cover = pairs.select("_p", "_c", F.inline(_cover(F.col("_p"), F.col("_c"))))
    found = (cover.join(nodes, ["k", "j"]).groupBy("_p", "_c")
             .agg(*[whole.alias(n) for n, (_, whole) in measures.items()]))
    outs = []
    for a in aggs:
        got = F.col("_f." + (a.kind if a.kind == "count_rows" else f"{a.kind}_{a.col}"))
        outs.append((got if a.kind in ("sum", "max") else F.coalesce(got, F.lit(0)).cast("bigint")).alias(a.out))
    both = w.alias("_w").join(found.alias("_f"), ["_p", "_c"], "left")
    return both.select(*[F.col(f"_w.{c}") for c in windows.columns], *outs)


def attribute_windows_literal(windows: DataFrame, daily: DataFrame, aggs: list[Agg],
                              prev: str = "data_medicao_anterior", cur: str = "data_medicao",
                              date: str = "data", sum_type: str = "decimal(28,6)") -> DataFrame:
    """Reference form (interval left join + group by). Quadratic; used by tests only."""
    wid = windows.withColumn("_wid", F.monotonically_increasing_id())
    d = daily.select(F.col(date).alias("_d"), *[F.col(c) for c in {a.col for a in aggs if a.col}])
    j = wid.join(d, (F.col("_d") > F.col(prev)) & (F.col("_d") <= F.col(cur)), "left")
    exprs = []
    for a in aggs:
        if a.kind == "sum":
            exprs.append(F.sum(F.col(a.col).cast(sum_type)).alias(a.out))
        elif a.kind == "count":
            exprs.append(F.count(a.col).alias(a.out))
        elif a.kind == "count_pos":
            exprs.append(F.count(F.when(F.col(a.col) > 0, 1)).alias(a.out))
        elif a.kind == "count_rows":
            exprs.append(F.count("_d").alias(a.out))
        elif a.kind == "max":
            exprs.append(F.max(a.col).alias(a.out))
    agg = j.groupBy("_wid").agg(*exprs)
    return wid.join(agg, "_wid").drop("_wid")


def with_coverage(windows: DataFrame, last_days: dict[str, DataFrame], cur: str) -> DataFrame:
    """F8: ``cur <= max(driver date)`` over the whole driver table, one flag per driver.

    ``last_days`` maps output flag -> a frame with one DATE column holding the driver's
    days. The maxima are one-row aggregates (map-side partial max) attached by broadcast.
    """
    lasts = product(*[days.agg(F.max(days.columns[0]).alias(f"_{out}_max"))
                      for out, days in last_days.items()])
    w = attach(windows, lasts)
    for out in last_days:
        w = w.withColumn(out, F.col(cur) <= F.col(f"_{out}_max")).drop(f"_{out}_max")
    return w
