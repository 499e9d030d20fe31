"""Merkle manifest of a dataset with proofs by pointer jumping (operator 12).

Every row is a leaf, H of its fields (H: lowercase hex sha256; digests are fed to it as hex text).
The leaves of a group (``lang``) stand in the order of their ids; every ``FAN`` consecutive nodes
become their H until one is left, the subroot. The subroots, in the order of the groups, are the
leaves of a tree of their own, whose root is the root of the dataset.

1. Places: the narrow leaves are range-partitioned by (group, id, leaf), sorted within partitions and
   written with their partition and line; counts of (partition, group) give each leaf its place in
   its group, and each group its number. No window spans a group.
2. Levels: one aggregation per level over groups of at most ``FAN`` nodes; each level is written.
3. Proofs: every inner node points at its parent and holds the segment (left and right siblings) of
   that step. In each round a self-join follows the pointer of the node that a node points at and
   appends its segment, so the distance doubles until all point at the root. Leaves, seven eighths of
   all nodes, jump last: with the segment towards their parent they take the parent's finished one,
   so they reach the root in one join and their long proofs are never written or shuffled. A node
   close to the root is pointed at by many; it is copied for salts, so that a key of a round's join
   meets at most 64 nodes (4,096 copies at most).

A row is verified by folding its leaf through its segments and comparing with the root.

Defined results: a null field counts as ``-``. Rows without an id come first in their group; rows that
repeat in all hashed fields have equal leaves and take neighbouring places. An empty table gives an
empty result (and no root). A group of one row has its leaf as subroot; one group's subroot is the
root; a single row's proof is empty. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import Scratch, documents

FAN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SALTS = 4096                    # copies of a node in a join, at most
TOP = -1                        # the tree over the subroots
_NODE = ["t", "l", "i"]         # tree, level, place in the level
_STEPS = "array<struct<a:binary,b:binary>>"


def H(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def encoded(field: Column) -> Column:
    value = field.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    return H(F.concat(*[encoded(f) for f in fields]))


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _raw(column: Column) -> Column:
    return F.unhex(column)


def placed(leaves: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(leaves with ``t`` (number of the group), ``i`` (place in it) and ``n`` (its rows); groups).

    ``leaves`` has ``k`` (not null, sorts as the groups do), ``doc_id`` and ``leaf``.
    """
    spread = leaves.repartitionByRange("k", "doc_id", "leaf", "row").sortWithinPartitions("k", "doc_id", "leaf", "row")
    # within a partition the generated id counts the rows from 0; its upper bits are the partition
    line = F.monotonically_increasing_id()
    lined = scratch.table(spread.drop("row").withColumn("_id", line), "lined")
    part = F.shiftright("_id", 33).alias("p")
    within = F.col("_id").bitwiseAND((1 << 33) - 1)
    counts = scratch.table(lined.groupBy("k", part).agg(F.min(within).alias("first"), F.count("*").alias("c")), "counts")
    before = F.sum("c").over(Window.partitionBy("k").orderBy("p").rowsBetween(Window.unboundedPreceding, -1))
    groups = scratch.table(numbered(counts.groupBy("k").agg(F.sum("c").alias("n")), scratch), "groups")
    starts = (counts.withColumn("before", F.coalesce(before, F.lit(0))).join(groups, "k")
              .select("k", "p", (F.col("before") - F.col("first")).alias("shift"), "n", "t"))
    at = lined.withColumn("p", part).withColumn("w", within).join(starts, ["k", "p"])
    return at.withColumn("i", F.col("w") + F.col("shift")).drop("w", "shift", "p", "_id"), groups


def numbered(groups: DataFrame, scratch: Scratch) -> DataFrame:
    """``groups`` with ``t``: their places in the order of ``k``, however many there are."""
    lined = scratch.table(groups.repartitionByRange("k").sortWithinPartitions("k")
                          .withColumn("_id", F.monotonically_increasing_id()), "groups-lined")
    p = F.shiftright("_id", 33)
    # one row per partition
    counts = lined.groupBy(p.alias("p")).agg(F.count("*").alias("c"))
    before = F.sum("c").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.withColumn("before", F.coalesce(before, F.lit(0))).drop("c")
    return (lined.withColumn("p", p).join(counts, "p")
            .withColumn("t", F.col("before") + F.col("_id").bitwiseAND((1 << 33) - 1)).drop("p", "before", "_id"))


def _parents(level: DataFrame, l: int) -> DataFrame:
    """Nodes of level ``l`` over the nodes (t, i, n, digest) of the level below: with ``kids``, the
    digests of the at most FAN children from left to right."""
    kids = F.transform(F.array_sort(F.collect_list(F.struct("i", "digest"))), lambda x: x["digest"])
    up = (level.groupBy("t", F.floor(F.col("i") / FAN).cast("long").alias("p"))
          .agg(kids.alias("kids"), F.ceil(F.first("n") / FAN).cast("long").alias("n")))
    return up.select("t", F.lit(l).alias("l"), F.col("p").alias("i"), "n", "kids",
                     _raw(H(F.array_join(F.transform("kids", _hex), ""))).alias("digest"))


def climbed(leaves: DataFrame, scratch: Scratch, name: str) -> tuple[list[DataFrame], DataFrame]:
    """(inner nodes by level, (t, digest) of the top node of every tree); ``leaves`` has t, i, n, digest."""
    levels, tops, level, l = [], [leaves.where("n = 1").select("t", "digest")], leaves.where("n > 1"), 0
    while not level.isEmpty():
        l += 1
        up = scratch.table(_parents(level.select("t", "i", "n", "digest"), l), f"{name}{l}")
        levels.append(up)
        tops.append(up.where("n = 1").select("t", "digest"))
        level = up.where("n > 1")
    return levels, reduce(DataFrame.unionAll, tops)


def siblings(kids: Column, at: Column) -> Column:
    """The step from the child of number ``at`` (from 0): digests to its left and to its right."""
    join = lambda x: F.unhex(F.array_join(F.transform(x, F.hex), ""))
    at = at.cast("int")
    return F.struct(join(F.slice(kids, 1, at)).alias("a"), join(F.slice(kids, at + 2, FAN)).alias("b"))


def jumped(pointers: DataFrame, depth: int, scratch: Scratch) -> DataFrame:
    """(t, l, i, steps) of every inner node but the root, the steps leading to the root.

    ``pointers`` has t, l, i, the parent pt, pl, pi and ``steps`` of one entry; the root is no row.
    """
    far, turn = 1, 0
    cur = scratch.table(pointers, "jump0")
    while far < depth:
        salts = min(FAN ** max(far - 2, 0), SALTS)
        goal = cur.select(*[F.col(c).alias(f"p{c}") for c in _NODE], F.col("steps").alias("more"),
                          *[F.col(f"p{c}").alias(f"q{c}") for c in _NODE])
        # a node of a group's tree is reached over this distance only from its level up
        goal = goal.where((F.col("pt") == TOP) | (F.col("pl") > far))
        goal = goal.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        keyed = cur.withColumn("salt", F.pmod(F.floor(F.col("i") / FAN ** 2), F.lit(salts)).cast("int"))
        both = keyed.join(goal, ["pt", "pl", "pi", "salt"], "left")
        step = lambda c: F.coalesce(F.col(f"q{c}"), F.col(f"p{c}")).alias(f"p{c}")
        turn += 1
        new = scratch.table(both.select(*_NODE, F.concat("steps", F.coalesce("more", F.expr(f"cast(array() as {_STEPS})"))).alias("steps"),
                                        *[step(c) for c in _NODE]), f"jump{turn}")
        scratch.release(f"jump{turn - 1}", cur.schema)
        cur, far = new, far * 2
    return cur.select(*_NODE, "steps")


def proofs(leaves: DataFrame, scratch: Scratch) -> tuple[DataFrame, str | None]:
    """(the rows of ``leaves`` with subroot and ``steps``, root).

    ``leaves`` has ``k``, ``doc_id``, ``row`` and ``leaf`` (binary); further columns are kept.
    """
    at, groups = placed(leaves, scratch)
    at = scratch.table(at.withColumnRenamed("leaf", "digest"), "placed")
    levels, subroots = climbed(at.select("t", "i", "n", "digest"), scratch, "level")
    subroots = scratch.table(subroots, "subroots")
    trees = groups.count()
    top = subroots.select(F.lit(TOP).cast("long").alias("t"), F.col("t").alias("i"), F.lit(trees).cast("long").alias("n"), "digest")
    top_levels, root = climbed(top, scratch, "top")
    root = root.first()
    if root is None:
        return at.withColumn("subroot", F.col("digest")).withColumn("steps", F.expr(f"cast(array() as {_STEPS})")), None
    inner = levels + top_levels
    if inner:
        nodes = reduce(DataFrame.unionAll, inner)
        # the pointers of the children that are inner nodes; a subroot is a leaf of the top tree
        kid = nodes.where(f"l > 1 or t = {TOP}").select("t", "l", "i", F.posexplode("kids").alias("j", "d"), "kids")
        child = F.col("i") * FAN + F.col("j")
        links = kid.select("t", (F.col("l") - 1).alias("l"), child.alias("i"), F.col("t").alias("pt"), F.col("l").alias("pl"),
                           F.col("i").alias("pi"), F.array(siblings(F.col("kids"), F.col("j"))).alias("steps"))
        subs = nodes.where(f"n = 1 and t <> {TOP}").select("t", F.col("l").alias("sl"))
        # pointers at a subroot go to its place in the top tree
        links = links.join(subs.withColumnRenamed("t", "pt").withColumnRenamed("sl", "pl").withColumn("sub", F.lit(True)),
                           ["pt", "pl"], "left")
        moved = F.coalesce("sub", F.lit(False))
        links = links.select("t", "l", "i", F.when(moved, F.lit(TOP)).otherwise(F.col("pt")).cast("long").alias("pt"),
                             F.when(moved, 0).otherwise(F.col("pl")).alias("pl"),
                             F.when(moved, F.col("pt")).otherwise(F.col("pi")).alias("pi"), "steps")
        paths = jumped(links, len(levels) + len(top_levels), scratch)
        # leaves ask for their parent under its own name, paths know a subroot under its place on top
        first = nodes.where("l = 1").select("t", F.col("i").alias("p"), "kids", F.when(
            (F.col("n") == 1) & (F.col("t") != TOP), F.struct(F.lit(TOP).cast("long").alias("t"), F.lit(0).alias("l"), F.col("t").alias("i"))
        ).otherwise(F.struct("t", "l", "i")).alias("at"))
        first = first.join(paths.select(F.struct(*_NODE).alias("at"), "steps"), "at", "left").select(
            F.col("t").alias("ft"), F.col("p").alias("fp"), "kids", "steps")
        lone = F.col("n") == 1
        mine = at.withColumns({"ft": F.when(lone, F.lit(TOP)).otherwise(F.col("t")).cast("long"),
                               "fi": F.when(lone, F.col("t")).otherwise(F.col("i"))})
        mine = mine.withColumn("fp", F.floor(F.col("fi") / FAN).cast("long")).join(first, ["ft", "fp"], "left")
        own = F.when(F.col("kids").isNotNull(), F.array(siblings(F.col("kids"), F.col("fi") % FAN)))
        none = F.expr(f"cast(array() as {_STEPS})")
        at = mine.withColumn("steps", F.concat(F.coalesce(own, none), F.coalesce("steps", none))).drop("ft", "fi", "fp", "kids")
    else:
        at = at.withColumn("steps", F.expr(f"cast(array() as {_STEPS})"))
    return at.join(subroots.withColumnRenamed("digest", "subroot"), "t"), root.digest.hex()


def proof_digest(steps: Column) -> Column:
    return H(F.array_join(F.transform(steps, lambda s: _hex(F.concat(s["a"], s["b"]))), ""))


def folded(digest: Column, steps: Column) -> Column:
    """The root that ``digest`` (hex) leads to along ``steps``."""
    return F.aggregate(steps, digest, lambda acc, s: H(F.concat(_hex(s["a"]), acc, _hex(s["b"]))))


def lowered(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def manifest(docs: DataFrame, tampered: Column | None = None, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row of ``docs``.

    ``tampered`` tells which rows to check with their text's A-Z lower-cased (default: none).
    """
    scratch = scratch or Scratch(docs.sparkSession, "merkle")
    field = {f: F.col(f"`{f}`") for f in FIELDS}
    bad = F.coalesce(tampered, F.lit(False)) if tampered is not None else F.lit(False)
    changed = leaf([lowered(field[f]) if f == "text" else field[f] for f in FIELDS])
    group = F.coalesce(F.concat(F.lit("="), field["lang"]), F.lit("-"))         # '-' sorts before '='
    leaves = scratch.table(docs.select(
        field["doc_id"].alias("doc_id"), group.alias("k"), _raw(leaf([field[f] for f in FIELDS])).alias("leaf"),
        F.when(bad, _raw(changed)).alias("tampered"), F.monotonically_increasing_id().alias("row")), "leaves")
    at, root = proofs(leaves, scratch)
    fold = folded(_hex(F.coalesce("tampered", "digest")), F.col("steps"))
    out = at.select("doc_id", _hex(F.col("digest")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"),
                    F.lit(root).cast("string").alias("root"), proof_digest(F.col("steps")).alias("proof_sha256"),
                    fold.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return manifest(documents(spark, sf_dir), picked)
