"""Duplicates, dedup and data-quality checks (Q1-Q20).

Scale notes
-----------
* Every per-key statistic is a hash aggregate with map-side combine, so a key that holds
  a third of the rows still reaches the reducers as one partial row per map task.
* Distinct counts plan as Expand + two aggregates keyed by (key, value), which spreads a
  hot key over many reducers.
* The sets of values behind a duplicated key are returned in long form
  (``duplicate_values``: one row per key, column and value) instead of an array per key,
  so no single group has to hold an unbounded array.
* Checks return a ``(check, violations)`` DataFrame; ``run_checks`` is the only place that
  brings a (tiny) result to the driver, to raise once with the full list.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.scalars import attach

# Duplicate classes.
RESENT, CONFLICT = "REENVIO", "CONFLITO DE VALOR"


def submissions(df: DataFrame, keys: list[str], distinct: dict[str, str], times: str | None = None) -> DataFrame:
    """Rows per business key (``lancamentos``), the distinct raw texts of each column of
    ``distinct`` (output name -> column; NULL is no value, '12,5' and '12.5' are two), and the first
    and last time."""
    stats = {out: F.countDistinct(F.col(c).cast("string")) for out, c in distinct.items()}
    if times:
        stats |= {"primeiro_lancamento": F.min(times), "ultimo_lancamento": F.max(times)}
    return df.groupBy(*keys).agg(F.count("*").alias("lancamentos"), *[x.alias(out) for out, x in stats.items()])


def contradicts(measures: list[str]) -> Column:
    """Some measure of a key has several texts."""
    return reduce(Column.__or__, [F.col(f"distintos_{m}") > 1 for m in measures])


def _per_measure(measures: list[str]) -> dict[str, str]:
    return {f"distintos_{m}": m for m in measures}


def duplicate_report(df: DataFrame, keys: list[str], measures: list[str],
                     id_col: str | None = None, ts_col: str | None = None) -> DataFrame:
    """Q1: business keys with more than one row, classified REENVIO / CONFLITO DE VALOR."""
    named = ({"protocolos": id_col} if id_col else {}) | _per_measure(measures)
    again = submissions(df, keys, named, ts_col).where("lancamentos > 1")
    return again.withColumn("classificacao", F.when(contradicts(measures), CONFLICT).otherwise(RESENT))


def duplicate_values(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Q1 detail: the distinct raw values behind each duplicated key, one row each, for measures as
    well as protocols and submission times.

    Long form (key, column, value, occurrences): no group holds a set of unbounded size.
    """
    repeated = df.groupBy(*keys).count().where("count > 1").select(*keys)
    cells = F.array(*[F.struct(F.lit(c).alias("coluna"), F.col(c).cast("string").alias("valor")) for c in columns])
    return (df.select(*keys, F.inline(cells)).where("valor IS NOT NULL")
            .groupBy(*keys, "coluna", "valor").agg(F.count("*").alias("ocorrencias"))
            .join(repeated, keys, "left_semi"))


def duplicate_summary(df: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Q2 scoreboard in one aggregate pass over the per-key statistics."""
    rows, twice, bad = F.col("lancamentos"), F.col("lancamentos") > 1, contradicts(measures)
    return submissions(df, keys, _per_measure(measures)).agg(
        F.sum(rows).alias("registros"), F.count("*").alias("chaves_distintas"),
        F.sum(rows - 1).alias("lancamentos_excedentes"),
        F.count_if(twice & ~bad).alias("chaves_reenvio"), F.count_if(twice & bad).alias("chaves_conflito"))


def duplicate_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Q3: full rows behind each duplicated key (join-back on the key).

    The duplicated-key side is an aggregate; AQE broadcasts it when its runtime size is
    small and otherwise splits skewed partitions of the sort-merge join.
    """
    dup_keys = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    return df.join(dup_keys, keys, "left_semi")


def dedup_best(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Q4 keep-best: one row per key, first by ``order`` (caller appends a total order).

    ``row_number() = 1`` plans as WindowGroupLimit: a partial top-1 per key runs before the
    shuffle, so a hot key ships one row per map task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


# ---------------------------------------------------------------- observed days as bits (Q5, Q6)

def day_words(df: DataFrame, keys: list[str], date: str, *aggs: Column) -> DataFrame:
    """The observed days of each key as bits: (keys, _word, _bits) with day ``64 _word + i`` (since 1970) as bit i,
    and ``aggs`` per word. A key has a row per 64 days, combined on the map side, however many rows it has."""
    day = F.unix_date(F.to_date(F.col(date))).cast("bigint")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(day, F.lit(64)).cast("int"))
    return df.groupBy(*keys, F.floor(day / 64).cast("bigint").alias("_word")).agg(F.bit_or(bit).alias("_bits"), *aggs)


def days_of(word: Column, bits: Column) -> Column:
    """The dates whose bits are set, as an array."""
    held = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.call_function("getbit", bits, i) == 1)
    return F.transform(held, lambda i: F.date_from_unix_date((word * 64 + i).cast("int")))


def coverage(df: DataFrame, entity: str, date: str, measure: str | None = None) -> DataFrame:
    """Q5: rows, distinct days, first/last date (and filled count) per entity."""
    aggs = [F.count(F.lit(1)).alias("_n"), F.min(date).alias("_lo"), F.max(date).alias("_hi")]
    if measure:
        aggs.append(F.count(measure).alias("_m"))
    whole = [F.sum("_n").alias("registros"), F.coalesce(F.sum(F.bit_count("_bits")), F.lit(0)).alias("dias_distintos"),
             F.min("_lo").alias("primeira_data"), F.max("_hi").alias("ultima_data")]
    if measure:
        whole.append(F.sum("_m").alias("preenchidos"))
    return day_words(df, [entity], date, *aggs).groupBy(entity).agg(*whole)


def date_gaps(df: DataFrame, entity: str, date: str) -> DataFrame:
    """Q6 generalised: per entity, dates inside its own first..last range on which some
    other entity has a row and this one has none.

    Both sides are words of 64 days: what anyone observed AND NOT what the entity did. Words that
    the entity skips as a whole lie between two of its words (``lead``); only missing days are expanded.
    """
    own = day_words(df.where(F.col(date).isNotNull()), [entity], date, F.min(date).alias("_lo"), F.max(date).alias("_hi"))
    all_ = day_words(df.where(F.col(date).isNotNull()), [], date).withColumnRenamed("_bits", "_all")
    mine = Window.partitionBy(entity)
    after = F.coalesce(F.lead("_word").over(mine.orderBy("_word")) - 1, F.col("_word"))
    spread = (own.select(entity, "_word", "_bits", F.min("_lo").over(mine).alias("_lo"), F.max("_hi").over(mine).alias("_hi"),
                         after.alias("_upto"))
              .select(entity, "_lo", "_hi", F.explode(F.sequence("_word", "_upto")).alias("_w"), "_word", "_bits")
              .select(entity, "_lo", "_hi", F.col("_w").alias("_word"), F.when(F.col("_w") == F.col("_word"), F.col("_bits")).otherwise(0).alias("_bits")))
    missing = F.col("_all").bitwiseAND(F.bitwise_not("_bits"))
    days = (spread.join(all_, "_word").where(missing != 0)
            .select(entity, "_lo", "_hi", F.explode(days_of(F.col("_word"), missing)).alias("_day")))
    return days.where(F.col("_day").between(F.col("_lo"), F.col("_hi"))).select(entity, F.col("_day").alias(date))


def date_gaps_pair(df: DataFrame, entity: str, date: str, a, b) -> DataFrame:
    """Q6 literal: dates present for entity ``a`` and absent for ``b``, and the reverse, from one scan."""
    held = df.where(F.col(entity).isin(a, b) & F.col(date).isNotNull())
    words = day_words(held, [entity], date).groupBy("_word").agg(
        *[F.coalesce(F.bit_or(F.when(F.col(entity) == x, F.col("_bits"))), F.lit(0)).alias(n) for n, x in (("_a", a), ("_b", b))])
    only = lambda x, y: days_of(F.col("_word"), F.col(x).bitwiseAND(F.bitwise_not(F.col(y))))
    sides = F.array(F.struct(F.lit(a).alias("presente_em"), F.lit(b).alias("ausente_em"), only("_a", "_b").alias("_days")),
                    F.struct(F.lit(b).alias("presente_em"), F.lit(a).alias("ausente_em"), only("_b", "_a").alias("_days")))
    return words.select(F.inline(sides)).select("presente_em", "ausente_em", F.explode("_days").alias(date))


def apply_corrections(df: DataFrame, rules: list[tuple[Column, str, Column]]) -> DataFrame:
    """Ordered keyed rewrites; rule i sees the output of rules < i.

    Each rule is (condition, target column, new value).
    """
    for cond, target, value in rules:
        df = df.withColumn(target, F.when(cond, value).otherwise(F.col(target)))
    return df


#: Columns of a rules table: order, {column: regular expression that its value must match}, target column,
#: what to replace in it (a regular expression; NULL: the whole value) and by what.
RULES = "ordem int, quando map<string,string>, alvo string, padrao string, novo string"
MAX_RULES = 1000


def apply_rule_table(df: DataFrame, rules: DataFrame, cols: list[str]) -> DataFrame:
    """B11 with the rules as data (schema ``RULES``): rewrites the text columns ``cols`` of ``df``.

    The rules become one ordered array, attached by broadcast (more than ``MAX_RULES`` raise), and are folded over
    each row, so rule i sees the output of rules < i. A NULL value matches nothing. Rules on columns that are not in
    ``cols`` never match.
    """
    order = F.array_sort(F.collect_list(F.struct("ordem", "alvo", "padrao", "novo", F.map_entries("quando").alias("quando"))))
    one = rules.agg(F.when(F.count(F.lit(1)) > MAX_RULES, F.raise_error(F.lit(f"more than {MAX_RULES} rules"))).otherwise(order).alias("_rules"))
    held = attach(df, one)
    row = F.create_map(*[x for c in cols for x in (F.lit(c), F.col(c))])

    def step(acc, r):
        value = F.element_at(acc, r["alvo"])
        new = F.when(r["padrao"].isNull(), r["novo"]).otherwise(F.regexp_replace(value, r["padrao"], r["novo"]))
        hit = F.forall(r["quando"], lambda q: F.coalesce(F.regexp_like(F.element_at(acc, q["key"]), q["value"]), F.lit(False)))
        return F.when(hit, F.transform_values(acc, lambda k, v: F.when(k == r["alvo"], new).otherwise(v))).otherwise(acc)

    done = held.withColumn("_row", F.aggregate("_rules", row, step))
    return done.withColumns({c: F.element_at("_row", c) for c in cols}).drop("_row", "_rules")


# ---------------------------------------------------------------- checks (Q7-Q18)

def _check_row(name: str, violations: Column) -> list[Column]:
    return [F.lit(name).alias("verificacao"), violations.cast("bigint").alias("violacoes")]


def check_unique(df: DataFrame, keys: list[str], name: str | None = None) -> DataFrame:
    """Q7: number of keys that occur more than once."""
    name = name or f"unique({','.join(keys)})"
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
            .agg(*_check_row(name, F.count_if(F.col("_n") > 1))))


def check_cardinality(df: DataFrame, col: str, expected: int, name: str | None = None) -> DataFrame:
    """Q8: |distinct members - expected|."""
    name = name or f"cardinality({col})={expected}"
    return df.agg(*_check_row(name, F.abs(F.countDistinct(col) - F.lit(expected))))


def check_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Q9/Q10/Q12/Q18: many row rules in one pass; a rule is the *passing* condition.

    A NULL outcome passes (``count_if`` only counts TRUE), which is how ``~between`` lets
    NULL through.
    """
    aggs = [F.count_if(~cond).alias(f"_r{i}") for i, cond in enumerate(rules.values())]
    one = df.agg(*aggs)
    stack = ", ".join(f"'{n}', _r{i}" for i, n in enumerate(rules))
    return one.selectExpr(f"stack({len(rules)}, {stack}) AS (verificacao, violacoes)") \
        .select("verificacao", F.col("violacoes").cast("bigint"))


def range_rule(col: str, lo, hi) -> Column:
    """Q9 passing condition ``col BETWEEN lo AND hi`` (NULL passes)."""
    return F.col(col).between(lo, hi) | F.col(col).isNull()


def check_fk(fact: DataFrame, dim: DataFrame, key: str | list[str], name: str | None = None,
             dim_key: str | None = None) -> DataFrame:
    """Q13: fact rows whose key has no dimension member (left anti join)."""
    keys = [key] if isinstance(key, str) else key
    d = dim.select(*(F.col(dim_key).alias(keys[0]),) if dim_key else keys).distinct()
    name = name or f"fk({','.join(keys)})"
    return fact.join(d, keys, "left_anti").agg(*_check_row(name, F.count(F.lit(1))))


def check_conformed(fine: DataFrame, coarse: DataFrame, key: str, cols: list[str],
                    name: str | None = None) -> DataFrame:
    """Q14: members of the fine grain whose shared attributes differ at the coarse grain."""
    f = fine.select(key, *cols).distinct()
    c = coarse.select(key, *[F.col(x).alias(f"{x}_g") for x in cols])
    diff = reduce(lambda a, b: a | b, [~F.col(x).eqNullSafe(F.col(f"{x}_g")) for x in cols])
    name = name or f"conformed({key})"
    return f.join(c, key).filter(diff).agg(*_check_row(name, F.count(F.lit(1))))


def check_matches(df: DataFrame, other: DataFrame, key: dict[str, str], value: str, other_value: str,
                  name: str) -> DataFrame:
    """Q10: ``value`` must equal what ``other`` holds under ``key`` (column -> its column); a key
    without a row there is a violation as well, a NULL key is none."""
    o = other.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(key.values())], F.col(other_value).alias("_v"))
    on = reduce(Column.__and__, [F.col(c) == F.col(f"_k{i}") for i, c in enumerate(key)])
    asked = df.where(reduce(Column.__and__, [F.col(c).isNotNull() for c in key]))
    found = asked.join(o, on, "left")
    return found.agg(*_check_row(name, F.count_if(~F.col(value).eqNullSafe(F.col("_v").cast(df.schema[value].dataType)))))


def check_presence(df: DataFrame, cond: Column, name: str) -> DataFrame:
    """Q16: at least one row satisfies ``cond`` (violation = 1 when none does)."""
    return df.agg(*_check_row(name, F.when(F.count_if(cond) == 0, 1).otherwise(0)))


def check_null_not_zero(df: DataFrame, covered: str, measures: list[str],
                        name: str = "null_not_zero", other: str | None = None) -> DataFrame:
    """Q15: a row without coverage must carry NULL measures (never 0), and must be covered by the
    ``other`` driver where one is named."""
    wrong = [F.col(m).isNotNull() for m in measures] + ([~F.col(other)] if other else [])
    bad = ~F.col(covered) & reduce(Column.__or__, wrong)
    return df.agg(*_check_row(name, F.count_if(bad)))


def union_checks(checks: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), checks)


#: Kinds that a table answers from one scan of its own (a dimension's members count as its scan).
SHARED_KINDS = ("unique", "cardinality", "range", "rule", "null_not_zero", "presence", "fk")


def _key_hash(cols: list[Column]) -> tuple[Column, Column]:
    """128 bits of a key, equal for equal texts whatever the types of the columns."""
    text = [c.cast("string") for c in cols]
    return F.xxhash64(*text), F.xxhash64(F.lit(1), *text)


_WHOLE = ("tinyint", "smallint", "int", "bigint")


def _key(kinds: list[str], cols: list[str]) -> tuple[Column, Column]:
    """Two numbers that tell the keys of ``cols``: the values themselves where all are whole numbers or dates and two at
    most (``kinds``: the types on each side of the check), else a hash of the texts."""
    if len(cols) > 2 or not all(k == "date" or k in _WHOLE for k in kinds):
        return _key_hash([F.col(c) for c in cols])
    value = lambda c, k: (F.unix_date(F.col(c)) if k == "date" else F.col(c)).cast("bigint")
    own = [value(c, k) for c, k in zip(cols, kinds)]
    return own[0], own[1] if len(own) > 1 else F.lit(0).cast("bigint")


def shared_gate(checks: list[tuple], table) -> DataFrame:
    """(verificacao, violacoes) of many checks with one scan per table.

    ``checks`` are (name, kind, table, args) of ``SHARED_KINDS``; ``table`` gives the frame of a name. Every row
    of a table is turned into what its checks want to know of it: (check, side, key) for a
    uniqueness key, a member or a foreign key, and one entry for each rule that it breaks. Entries of all tables
    meet in one aggregation by (check, key), with map-side combine, so a foreign key sends each distinct value once per
    task; a fact is read once for all of its keys, a dimension once for all facts. Keys of one or two whole numbers
    or dates stand for themselves, others are known by 128-bit hashes. Entries are generated by compiled code
    and those that do not apply are filtered after it: a higher-order function here would be interpreted for every row.

    A table that is only asked for unique keys is grouped by its own columns: its rows then stay where
    a table built by the same key has them, instead of going through the exchange of the entries.
    """
    frames = {t: table(t) for _, _, t, _ in checks}
    frames.update({args[1]: table(args[1]) for _, kind, _, args in checks if kind == "fk" and args[1] not in frames})
    kinds_of = {t: dict(df.dtypes) for t, df in frames.items()}
    asked: dict[str, set[str]] = {}
    for _, kind, t, args in checks:
        asked.setdefault(t, set()).add(kind)
        if kind == "fk":
            asked.setdefault(args[1], set()).add("member")
    entries: dict[str, list[Column]] = {}
    alone = []
    none = (F.lit(0).cast("bigint"), F.lit(0).cast("bigint"))

    def add(t, check, key=none, side=0, when=None):
        e = F.struct(F.lit(check).alias("check"), F.lit(side).alias("lado"), key[0].alias("h1"), key[1].alias("h2"))
        entries.setdefault(t, []).append(e if when is None else F.when(when, e))

    for i, (name, kind, t, args) in enumerate(checks):
        if kind == "unique":
            if asked[t] == {"unique"}:
                alone.append(frames[t].groupBy(*args).agg(F.count(F.lit(1)).alias("n"))
                             .agg(F.lit(i).alias("check"), F.sum("n").alias("rows"), F.count_if(F.col("n") > 1).alias("repeated"),
                                  F.count(F.lit(1)).alias("distinct"), F.lit(0).cast("bigint").alias("orphans")))
            else:
                add(t, i, _key([kinds_of[t][c] for c in args], args))
        elif kind == "cardinality":
            add(t, i, _key([kinds_of[t][args[0]]], [args[0]]), when=F.col(args[0]).isNotNull())
        elif kind == "range":
            add(t, i, when=~range_rule(*args))
        elif kind == "rule":
            add(t, i, when=~F.expr(args))
        elif kind == "null_not_zero":
            covered, measures, other = args
            wrong = [F.col(x).isNotNull() for x in measures] + ([~F.col(other)] if other else [])
            add(t, i, when=~F.col(covered) & reduce(Column.__or__, wrong))
        elif kind == "presence":
            add(t, i, when=F.col(args))
        elif kind == "fk":
            col, dim, dim_col = args
            own, theirs = kinds_of[t][col], kinds_of[dim][dim_col]
            both = "date" if own == theirs == "date" else "bigint" if own in _WHOLE and theirs in _WHOLE else "string"
            add(t, i, _key([both], [col]))
            add(dim, i, _key([both], [dim_col]), side=1, when=F.col(dim_col).isNotNull())
        else:
            raise ValueError(kind)
    told = [frames[t].select(F.inline(F.array(*es))).where(F.col("check").isNotNull()) for t, es in entries.items()]
    spark = next(iter(frames.values())).sparkSession
    found = alone
    if told:
        keys = reduce(DataFrame.unionAll, told).groupBy("check", "h1", "h2").agg(
            F.count_if(F.col("lado") == 0).alias("n"), F.count_if(F.col("lado") == 1).alias("members"))
        found = [keys.groupBy("check").agg(
            F.sum("n").alias("rows"), F.count_if(F.col("n") > 1).alias("repeated"), F.count_if(F.col("n") > 0).alias("distinct"),
            F.sum(F.when(F.col("members") == 0, F.col("n"))).alias("orphans")), *alone]
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    wanted = spark.createDataFrame(
        [(i, name, kind, args[1] if kind == "cardinality" else None) for i, (name, kind, _, args) in enumerate(checks)],
        "check int, verificacao string, kind string, expected long")            # one row per check
    kind = F.col("kind")
    count = (F.when(kind == "unique", zero("repeated")).when(kind == "fk", zero("orphans"))
             .when(kind == "cardinality", F.abs(zero("distinct") - F.col("expected")))
             .when(kind == "presence", (zero("rows") == 0).cast("bigint")).otherwise(zero("rows")))
    return (wanted.join(reduce(DataFrame.unionByName, found), "check", "left")
            .select("verificacao", count.cast("bigint").alias("violacoes")))


class QualityGateError(RuntimeError):
    pass


def run_checks(checks: list[DataFrame] | DataFrame, label: str = "gate") -> DataFrame:
    """Q17: evaluate all checks, print each, raise once with the full list of failures."""
    df = checks if isinstance(checks, DataFrame) else union_checks(checks)
    rows = df.collect()  # one row per check
    failed = [f"{r['verificacao']}: {r['violacoes']}" for r in rows if r["violacoes"]]
    for r in rows:
        print(f"{'ok ' if not r['violacoes'] else 'FAIL'} {r['verificacao']}: {r['violacoes']}")
    if failed:
        raise QualityGateError(f"{label} failed: {failed}")
    return df


def enforce(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Q18 write-time rules: the returned frame raises at run time on the first row that
    breaks a rule (NULL passes), so a sink fed from it never stores a bad row."""
    guard = reduce(lambda acc, item: F.when(~item[1], F.raise_error(F.lit(f"rule {item[0]} broken")))
                   .otherwise(acc), list(rules.items()), F.lit(True))
    return df.withColumn("_guard", guard).filter(F.col("_guard")).drop("_guard")
