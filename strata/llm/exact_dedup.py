"""Exact duplicates by 128-bit content hashes, compared byte by byte (operator 11).

Texts are equal when they are identical after every character of ``[\\x20\\x09-\\x0D]`` is deleted.

1. One scan turns every row into a narrow one (hash, code points, digest), written once. Rows are
   grouped by the 128-bit hash of the normalised text, per (hash, salt) before per hash, so that a
   group of a third of all rows is spread over many tasks; the row that stays has the most code
   points in its original text, then the smallest id.
2. Bytes are compared inside the groups: a second scan groups the texts of hashes that several
   rows share by (hash, normalised text). Equal texts collapse within each task before anything
   moves, so a task sends a text once however many copies it has. A hash with two texts is a
   collision, and its rows are grouped by their texts instead.

Which hashes are shared is told to the second scan by a bitmap of at most ``BITS`` bits, built by
Spark's bitmap aggregates and broadcast: it is a pre-filter that lets some unshared texts through,
never one that holds a shared one back, and its size does not depend on the data.

Defined results: a null text counts as an empty one, and blank texts equal it. A row without an id
stays only where no row of the group with as many code points has one (``keep_id`` is null then).
Of rows that repeat in text and id exactly one stays. An empty table gives an empty result. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import Scratch, bitmap, documents, maybe_in, salt

BLANKS = r"[\x20\x09-\x0D]++"
BITS = 1 << 27                  # of the bitmap of shared hashes: 16 MB at most


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, "")


def content_hash(norm: Column) -> Column:
    """128 bits."""
    return F.unhex(F.md5(norm.cast("binary")))


def _best(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with ``best`` (the first ``rank`` of their group) and ``group_size``."""
    salted = rows.withColumn("_salt", salt(F.col("rank.row")))
    part = salted.groupBy(*keys, "_salt").agg(F.min("rank").alias("_m"), F.count("*").alias("_n"))
    whole = part.groupBy(*keys).agg(F.min("_m").alias("best"), F.sum("_n").alias("group_size"))
    return salted.join(part.select(*keys, "_salt").join(whole, keys), [*keys, "_salt"])


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     hashed: Callable[[Column], Column] = content_hash, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``."""
    scratch = scratch or Scratch(docs.sparkSession, "exact-dedup")
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("t"))
    texts = source.select("doc_id", F.coalesce(F.length("t"), F.lit(0)).alias("n"), normalised(F.col("t")).alias("norm"))
    rank = F.struct((-F.col("n")).alias("n"), F.col("doc_id").isNull().alias("no_id"), "doc_id",
                    F.monotonically_increasing_id().alias("row"))
    narrow = scratch.table(texts.select(hashed(F.col("norm")).alias("h"), rank.alias("rank"),
                                        F.unhex(F.sha2("norm", 256)).alias("sha")), "rows")

    # bytes inside the groups
    shared = narrow.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    flagged = scratch.table(bitmap(shared, F.col("h"), BITS), "bitmap")
    hashes = texts.withColumn("h", hashed(F.col("norm")))
    maybe = maybe_in(hashes, F.col("h"), flagged, BITS)
    distinct = maybe.select("h", "norm").groupBy("h", "norm").agg(F.count("*").alias("n"))
    collided = scratch.table(distinct.groupBy("h").agg(F.count("*").alias("texts")).where(F.col("texts") > 1).select("h"),
                             "collided")
    if collided.isEmpty():
        grouped = _best(narrow, ["h"])
    else:
        clear = _best(narrow.join(collided, "h", "left_anti"), ["h"])
        apart = (hashes.join(collided, "h", "left_semi")
                 .select("h", "norm", rank.alias("rank"), F.unhex(F.sha2("norm", 256)).alias("sha")))
        apart = _best(scratch.table(apart, "apart"), ["h", "norm"])
        grouped = clear.unionByName(apart.drop("norm"))
    return grouped.select(F.col("rank.doc_id").alias("doc_id"), F.col("best.doc_id").alias("keep_id"), "group_size",
                          (F.col("rank.row") == F.col("best.row")).alias("kept"),
                          F.lower(F.hex("sha")).alias("text_sha256"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, for tables whose ids are unique and not null."""
    kept = exact_duplicates(docs, id_col, text_col).where("kept").select(F.col("doc_id").alias("_keep"))
    return docs.join(kept, docs[id_col] == kept["_keep"], "left_semi")


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir))
