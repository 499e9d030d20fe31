"""Sharding by sampled splitters (operator 2), law ``bytes``.

Records are ordered by (hash of the text, id), so equal texts lie together, and cut into
shards of nearly equal bytes:

1. A size-weighted sample of keys is drawn (probability in proportion to the size), its
   quantiles become splitters, and the records are range-partitioned by them.
2. Rows and bytes of every range are counted. Overfull ranges get splitters of their own from
   a denser sample of the range alone, until none is overfull; keys are unique, so a hot
   text, even one row repeated millions of times, splits like anything else.
3. Each range is sorted in a task of its own; running sums plus the range's offset place
   every record on the line of all bytes, and the shard is the sixteenth it falls into. So
   shards differ by about one record at most, whatever the sample was.

The driver gets the sample and one row per range (at most a few thousand), never records.

Defined results: a null text has size 1 and the CRC of an empty one, and lies with the empty
ones; rows without an id come first among equal texts; repeated rows take neighbouring places.
An empty table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import Scratch, documents

SHARDS = 16
RANGE_ROWS = 100_000             # aimed at for a range
RANGES = (64, 4096)              # least and most ranges at first
SAMPLES = 32                     # sampled keys for each splitter
OVERFULL = 4                     # times the mean of rows or bytes
ROUNDS = 4                       # of subdivision


def _keys(h, ids, uid) -> np.ndarray:
    """Keys as fixed byte strings whose order is that of (h, id with null first, uid)."""
    none = np.asarray(ids.is_null())
    ids = np.asarray(ids.fill_null(0))
    flip = np.uint64(1 << 63)
    big = lambda x: (np.asarray(x).astype(np.int64).view(np.uint64) ^ flip).astype(">u8").view(np.uint8).reshape(-1, 8)
    rows = np.concatenate([big(h), (~none).astype(np.uint8)[:, None], big(ids), big(uid)], axis=1)
    return np.ascontiguousarray(rows).view("S25").ravel()


def _ranged(keyed: DataFrame, splitters: np.ndarray) -> DataFrame:
    """``keyed`` with ``r``, the number of splitters up to the key."""
    shared = keyed.sparkSession.sparkContext.broadcast(splitters)

    def run(batches):
        cut = shared.value
        for b in batches:
            key = _keys(b.column("h"), b.column("doc_id"), b.column("uid"))
            r = np.searchsorted(cut, key, side="right") if len(cut) else np.zeros(b.num_rows, np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(r.astype(np.int32))], [*b.schema.names, "r"])

    return keyed.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema) + ", r int")


def _sample(keyed: DataFrame, per_byte, seed: int):
    """Keys drawn with probability ``per_byte`` * size (1 at most), and their weights in bytes."""
    u = F.pmod(F.xxhash64("h", "doc_id", "uid", F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    t = keyed.where(u < F.col("size") * per_byte).select("h", "doc_id", "uid", "size", per_byte.alias("p")).toArrow()
    t = t.combine_chunks()
    col = lambda c: t.column(c).combine_chunks()
    keys = _keys(col("h"), col("doc_id"), col("uid"))
    size, p = np.asarray(col("size")).astype(float), np.asarray(col("p")).astype(float)
    return keys, size / np.minimum(1, size * p)


def quantiles(keys: np.ndarray, weights: np.ndarray, parts: int) -> np.ndarray:
    """Sorted splitters that cut the weight into ``parts``."""
    if not len(keys):
        return keys
    order = np.argsort(keys)
    cum = np.cumsum(weights[order])
    at = np.searchsorted(cum, cum[-1] * np.arange(1, parts) / parts)
    return np.unique(keys[order][np.minimum(at, len(keys) - 1)])


def assign_shards(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
                  scratch: Scratch | None = None, row_col: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row, and ``uid``: the row's value of ``row_col``, a column
    of different numbers, if one is named."""
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "sharding")
    text = F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b""))
    keyed = scratch.table(docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), (F.length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("h"),
        (F.col(f"`{row_col}`") if row_col else F.monotonically_increasing_id()).alias("uid")), "keys")
    all_ = keyed.agg(F.count("*").alias("n"), F.sum("size").alias("b")).first()
    n, total = all_.n, all_.b or 0
    ranges = int(min(max(RANGES[0], -(-n // RANGE_ROWS)), RANGES[1]))
    keys, weights = _sample(keyed, F.lit(SAMPLES * ranges / max(total, 1)), 0)
    splitters = quantiles(keys, weights, ranges)
    for turn in range(ROUNDS + 1):
        ranged = _ranged(keyed, splitters)
        counts = (ranged.groupBy("r").agg(F.count("*").alias("n"), F.sum("size").alias("b"))
                  .toPandas().sort_values("r"))
        most = OVERFULL * max(n / ranges, 1), OVERFULL * total / ranges
        over = counts[((counts.n > most[0]) | (counts.b > most[1])) & (counts.n > 1)]
        if turn == ROUNDS or not len(over):
            break
        # in an overfull range the sample aims at parts of the mean size
        rate = {int(x.r): SAMPLES * max(x.n * ranges / n, x.b * ranges / total) / x.b for x in over.itertuples()}
        per_byte = F.element_at(F.create_map(*[F.lit(v) for kv in rate.items() for v in kv]), F.col("r"))
        more, w = _sample(ranged.where(F.col("r").isin(list(rate))), per_byte, turn + 1)
        where = np.searchsorted(splitters, more, side="right")
        parts = [quantiles(more[where == r], w[where == r], int(np.ceil(rate[r] * b / SAMPLES)))
                 for r, b in zip(over.r, over.b)]
        new = np.unique(np.concatenate([splitters, *parts]))
        if len(new) == len(splitters):
            break
        splitters = new
    offsets = counts[["r"]].assign(rows=(counts.n.cumsum() - counts.n).astype("int64"),
                                   bytes=(counts.b.cumsum() - counts.b).astype("int64"))
    start = spark.createDataFrame(list(offsets.itertuples(index=False, name=None)), "r int, rows long, bytes long")
    line = Window.partitionBy("r").orderBy("h", F.col("doc_id").asc_nulls_first(), "uid")
    upto = F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    placed = (ranged.withColumn("before", upto).withColumn("i", F.row_number().over(line) - 1)
              .join(F.broadcast(start), "r"))
    middle = 2 * (F.col("bytes") + F.col("before")) + F.col("size")
    shard = F.least(F.floor(middle * shards / F.lit(2 * max(total, 1))), F.lit(shards - 1)).cast("int")
    placed = scratch.table(placed.select("doc_id", "size", "text_crc32", shard.alias("shard"),
                                         (F.col("rows") + F.col("i")).alias("place"), *(["uid"] if row_col else [])), "placed")
    first = placed.groupBy("shard").agg(F.min("place").alias("first"))       # one row per shard
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("place") - F.col("first")).cast("long").alias("slot"),
        *(["uid"] if row_col else []))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
                 slice_rows: int = 100_000) -> None:
    """Writes the documents into one folder per shard (``_shard``, with their ``_slot``), in slices of slots, so that no
    task holds a shard. Rows are known by a number that is written with them first, so rows without an id and
    repeated rows are written as often as they occur."""
    scratch = Scratch(docs.sparkSession, "shards")
    rows = scratch.table(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")
    at = assign_shards(rows, shards, id_col, text_col, scratch, "_row").select(
        F.col("uid").alias("_row"), F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
    part = F.floor(F.col("_slot") / slice_rows)
    (rows.join(at, "_row").drop("_row").repartition("_shard", part).sortWithinPartitions("_shard", "_slot")
     .write.partitionBy("_shard").parquet(path))
    scratch.clear()


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
