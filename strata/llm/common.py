"""Shared helpers of the text operators.

* ``map_text``   applies a per-batch Python function to a text column over Arrow batches and
                 carries other columns along untouched (by position, so names cannot clash).
* ``Scratch``    tables written under the session's ``spark.checkpoint.dir`` (the folder that
                 all executors share) to cut lineage: a lost executor re-reads files.
* ``keyed_min``  the smallest value of each key given to every row, with salted aggregation,
                 so a key that holds a third of all rows is spread over many tasks.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import ensure_checkpoint_dir

#: Texts handed to a batch function at once hold at most so many bytes (or one longer text).
BATCH_BYTES = 4 << 20


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _slices(lengths, limit: int) -> Iterator[tuple[int, int]]:
    start = total = 0
    for i, n in enumerate(lengths):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)


def map_text(df: DataFrame, text_col: str, carry: Sequence[str], out: Sequence[T.StructField],
             make: Callable[[], Callable[..., list[pa.Array]]], also: Sequence[str] = ()) -> DataFrame:
    """Columns ``carry`` of ``df``, then the fields ``out`` computed from ``text_col``.

    ``make`` runs once per task and returns the batch function: from a list of UTF-8 byte
    strings (None for null) to one Arrow array per field of ``out``. Carried columns travel
    by position under neutral names, so they may have the names of the new fields; callers
    who keep both select by position. Values of the carried columns ``also`` go to the batch
    function as further lists. Batches are cut at ``BATCH_BYTES`` of text.
    """
    carry = list(carry)
    fields = {f.name: f for f in df.schema.fields}
    source = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)]
    at = carry.index(text_col) if text_col in carry else None
    if at is None:
        source.append(F.col(f"`{text_col}`").cast("binary").alias("t"))
    inner = T.StructType([T.StructField(f"c{i}", fields[c].dataType) for i, c in enumerate(carry)]
                         + [T.StructField(f"o{i}", f.dataType) for i, f in enumerate(out)])
    n = len(carry)
    extra = [carry.index(c) for c in also]

    def run(batches):
        fn = make()
        for batch in batches:
            texts = batch.column(n if at is None else at)
            texts = texts if pa.types.is_binary(texts.type) else texts.cast(pa.binary())
            sizes = [0 if v is None else v for v in pc.binary_length(texts).to_pylist()]
            for a, b in _slices(sizes, BATCH_BYTES):
                new = fn(texts.slice(a, b - a).to_pylist(),
                         *[batch.column(i).slice(a, b - a).to_pylist() for i in extra])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(a, b - a) for i in range(n)] + new,
                    [f"c{i}" for i in range(n)] + [f"o{i}" for i in range(len(out))])

    return df.select(*source).mapInArrow(run, inner).toDF(*carry, *[f.name for f in out])


class Scratch:
    """Written tables in a fresh folder under ``spark.checkpoint.dir``."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.held: dict[str, T.StructType] = {}

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}"
        df.write.parquet(path)
        self.held[name] = df.schema
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self, name: str, schema: T.StructType) -> None:
        """Frees the data of a table that is no longer read (leaves an empty one)."""
        self.spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{self.path}/{name}")
        self.held.pop(name, None)

    def clear(self) -> None:
        """Frees every table of this folder."""
        for name, schema in list(self.held.items()):
            self.release(name, schema)


def salt(col: Column, n: int = 32) -> Column:
    return F.pmod(F.xxhash64(col), F.lit(n))


def keyed_min(df: DataFrame, key: str, value: str, out: str, extend=lambda t: t) -> DataFrame:
    """``df`` with ``out``: the smallest ``value`` among the rows of equal ``key`` (null key: null).

    Rows are aggregated per (key, salt), then per key; the per-key row, with what ``extend``
    adds to it, goes back to the at most 32 (key, salt) rows, and those join the rows, so no
    task holds a whole hot key.
    """
    salted = df.withColumn("_salt", salt(F.col(value)))
    part = salted.where(F.col(key).isNotNull()).groupBy(key, "_salt").agg(F.min(value).alias("_m"))
    whole = extend(part.groupBy(key).agg(F.min("_m").alias(out)))
    back = part.select(key, "_salt").join(whole, key)
    return salted.join(back, [key, "_salt"], "left").drop("_salt")


_BITS = 1 << 15                 # of one row of Spark's bitmap aggregates


def bitmap(keys: DataFrame, key: Column, bits: int) -> DataFrame:
    """(_bucket, _map): a bitmap of ``bits`` bits at most with the hashes of ``keys`` set, in rows of 4,096 bytes."""
    slot = F.pmod(F.xxhash64(key), F.lit(bits))
    return (keys.groupBy(F.floor(slot / _BITS).cast("int").alias("_bucket"))
            .agg(F.bitmap_construct_agg(slot % _BITS).alias("_map")))


PIECE = 64                      # bytes of a row of ``pieces``


def pieces(made: DataFrame) -> DataFrame:
    """A bitmap in rows of PIECE bytes, empty ones left out: a join copies the row it meets for every
    row of the other side, which for rows of 4,096 bytes is more than most texts have."""
    n = _BITS // 8 // PIECE
    parts = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.struct(
        (F.col("_bucket") * n + i).alias("_bucket"), F.substring("_map", i * PIECE + 1, F.lit(PIECE)).alias("_map")))
    return made.select(F.inline(parts)).where(F.col("_map") != F.lit(bytes(PIECE)))


def _bit(df: DataFrame, key: Column, made: DataFrame, bits: int, how: str, width: int) -> DataFrame:
    """``df`` with ``_bit``: whether the hash of its key is set in ``made``, whose rows have ``width`` bits
    (null where a left join finds no row of it)."""
    slot = F.pmod(F.xxhash64(key), F.lit(bits))
    byte = F.conv(F.hex(F.substring("_map", (F.floor(F.col("_slot") % width / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    held = df.withColumn("_slot", slot).withColumn("_bucket", F.floor(F.col("_slot") / width).cast("int"))
    bit = F.pmod(F.floor(byte / F.pow(F.lit(2), F.col("_slot") % 8)), F.lit(2)) == 1
    return held.join(F.broadcast(made), "_bucket", how).withColumn("_bit", bit).drop("_slot", "_bucket", "_map")


def maybe_in(df: DataFrame, key: Column, made: DataFrame, bits: int, width: int = _BITS) -> DataFrame:
    """The rows of ``df`` whose key may be among those of ``made = bitmap(...)`` (``pieces`` of it: ``width`` 8 PIECE): all that are, and a few
    that are not. The bitmap is broadcast; its size is bounded by ``bits``, whatever the data."""
    return _bit(df, key, made, bits, "inner", width).where("_bit").drop("_bit")


def surely_not_in(df: DataFrame, key: Column, made: DataFrame, bits: int, width: int = _BITS) -> DataFrame:
    """The other rows of ``df``, those that ``maybe_in`` leaves out."""
    return _bit(df, key, made, bits, "left", width).where(~F.coalesce("_bit", F.lit(False))).drop("_bit")
