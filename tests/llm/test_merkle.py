import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from strata.llm.merkle import FIELDS, manifest, op12_merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def H(s):
    return hashlib.sha256(s.encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def lower(text):
    return text if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def climb(nodes):
    """(top, [steps of each node]): steps are (left, right) hex texts."""
    steps, where = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for j, at in enumerate(where):
            run = at // 8 * 8
            steps[j].append(("".join(nodes[run:at]), "".join(nodes[at + 1:run + 8])))
        nodes = [H("".join(nodes[i:i + 8])) for i in range(0, len(nodes), 8)]
        where = [at // 8 for at in where]
    return nodes[0], steps


def brute(rows, picked):
    groups = defaultdict(list)
    for r in rows:
        doc = {f: r[f] for f in FIELDS}
        leaf = H("".join(enc(doc[f]) for f in FIELDS))
        bad = H("".join(enc(lower(doc[f]) if f == "text" else doc[f]) for f in FIELDS)) if picked(doc["doc_id"]) else leaf
        groups[doc["lang"]].append((doc["doc_id"] is not None, doc["doc_id"] or 0, leaf, bad))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [climb([x[2] for x in sorted(groups[g])]) for g in order]
    root, upper = climb([t[0] for t in trees])
    out = []
    for g, (subroot, steps), more in zip(order, trees, upper):
        for (has, doc_id, leaf, bad), own in zip(sorted(groups[g]), steps):
            acc = bad
            for a, b in own + more:
                acc = H(a + acc + b)
            out.append((doc_id if has else None, leaf, subroot, root, H("".join(a + b for a, b in own + more)), acc, acc == root))
    return Counter(out)


def crc_picked(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0


def got(df):
    return Counter(tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_tables(spark, sf):
    rows = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").collect()
    assert got(op12_merkle(spark, f"/root/testdata/{sf}")) == brute(rows, crc_picked)


@pytest.mark.parametrize("sizes", [[1], [2], [8], [9], [1, 1], [1, 8, 64, 65, 3], [700], [1] * 70 + [20]])
def test_shapes(spark, sizes):
    rows = [(1000 * g + i, f"Text {i}", None if g == 1 else f"l{g}", "s", i) for g, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    df = manifest(docs, F.col("doc_id") % 4 == 0)
    assert got(df) == brute(docs.collect(), lambda d: d % 4 == 0)
    assert all(r.verified == (r.doc_id % 4 != 0) for r in df.collect())


def test_deep_tree_of_one_group(spark):
    docs = spark.range(5000).select("id", F.lit("A"), F.lit("en"), F.lit("s"), F.col("id").alias("n")).toDF(*SCHEMA.replace(" long", "").replace(" string", "").split(", "))
    assert got(manifest(docs, F.col("doc_id") % 3 == 1)) == brute(docs.collect(), lambda d: d % 3 == 1)


def test_changes_are_found(spark):
    """Any change of a row changes the root; rows in another order do not."""
    rows = [(i, f"t{i}", "en" if i % 3 else None, "s", i) for i in range(50)]
    root = lambda rs: manifest(spark.createDataFrame(rs, SCHEMA)).first().root
    first = root(rows)
    assert root(rows[::-1]) == first
    assert len({first, root(rows[:-1]), root([(0, "t0", "en", "s", 0)] + rows[1:]), root([(0, None, None, "s", 0)] + rows[1:])}) == 4


def test_edges(spark, edge_rows, no_rows):
    """Nulls in any column, empty and long texts, repeated rows, extra columns with clashing names."""
    clash = lambda df: df.withColumn("source", F.lit("s")).withColumn("n_chars", F.lit(None).cast("long")).withColumns(
        {c: F.lit(1) for c in ("t", "l", "i", "n", "k", "row", "leaf", "root", "steps", "kids", "digest")})
    assert manifest(clash(no_rows)).collect() == []
    rows = clash(edge_rows)
    assert got(manifest(rows, F.col("doc_id") % 2 == 1)) == brute(rows.collect(), lambda d: d is not None and d % 2 == 1)
