"""Benchmark decontamination (operator 1).

One Aho-Corasick automaton holds every window of 13 consecutive words of the normalised
benchmark texts (an item of fewer words, but not none, is one window). Each document is
normalised to its words joined by single spaces and scanned once; the automaton reports all
occurrences of all windows. Match offsets lead back to word numbers, and those to code point
spans of the original text.

Normal form: ASCII letters lower-cased; a word is a run of ASCII letters, digits and
non-ASCII characters. Patterns and texts carry a space at both ends, so only whole words
match.

The benchmark is a stated item set. Its distinct (window, item) pairs are spread by hash over blocks of
about ``BLOCK_BYTES`` (the size is summed by Spark before anything is collected), so a window that very
many items share is spread as well. The driver holds one block at a time and broadcasts it; there is
one automaton, and one scan, per block, and blocks meet as unions of hits. With several blocks
what a scan found is written before the next one begins, so that no task holds two automata: a larger
benchmark costs more scans, never more memory.

Defined results: null and empty texts have no words: ``n_words`` = ``n_hit`` = ``n_items`` = 0,
not contaminated. Null or empty items have no window. Repeated rows and items are judged
alike; an item id counts once. An item without an id contributes hits but no id. Empty
tables give empty results, or clean documents. Other columns are ignored or, with
``carry``, passed through whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import Scratch, documents, map_text

WINDOW = 13
SHARE = 20                       # contaminated: 20 * n_hit >= n_words
BLOCK_BYTES = 16 << 20           # of windows in one automaton

#: Bytes of no word become spaces, A-Z become a-z, the rest stays.
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
               for b in range(256))
WORD = re.compile(rb"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")

FIELDS = [T.StructField(n, T.LongType()) for n in ("n_words", "n_hit", "n_items")] + [
    T.StructField("items_sha256", T.StringType()), T.StructField("contaminated", T.BooleanType()),
    T.StructField("item_ids", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType())))]


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(NORMAL).split()


def windows_of(text: bytes | None) -> set[bytes]:
    w = words(text)
    n = min(WINDOW, len(w))
    return {b" ".join(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set()


def windows(bench: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """The distinct (window, item as string) pairs of the benchmark."""
    out = [T.StructField("windows", T.ArrayType(T.BinaryType()))]

    def make():
        return lambda texts: [pa.array([sorted(windows_of(t)) for t in texts], pa.list_(pa.binary()))]

    made = map_text(bench, text_col, [id_col], out, make).toDF("item", "windows")
    return made.select(F.explode("windows").alias("window"), F.col("item").cast("string").alias("item")).distinct()


def window_blocks(pairs: DataFrame) -> Iterator[tuple[bool, list[tuple[bytes, list[str]]]]]:
    """(last one?, windows with their items) of one block after the other, each of about BLOCK_BYTES.

    The pairs of a block lie together in cached batches, which the other blocks' reads skip.
    """
    entry = F.length("window") + 16 + F.coalesce(F.length("item"), F.lit(0))
    size = pairs.agg(F.sum(entry).alias("n")).first().n or 0
    k = -(-size // BLOCK_BYTES) or 1
    dealt = pairs.withColumn("block", F.pmod(F.xxhash64("window", "item"), F.lit(k)).cast("int"))
    if k > 1:
        dealt = dealt.repartition("block").sortWithinPartitions("block")
    dealt = dealt.persist()
    try:
        for b in range(k):
            rows = (dealt.where(F.col("block") == b).groupBy("window")
                    .agg(F.array_sort(F.collect_set("item")).alias("items")).collect())
            yield b == k - 1, [(bytes(r.window), list(r["items"])) for r in rows]
    finally:
        dealt.unpersist()


def automaton(block):
    """Aho-Corasick automaton over the block's windows: value (words, item ids)."""
    import ahocorasick

    a = ahocorasick.Automaton()
    if not block:
        a.add_word("  ", (0, ()))    # never found: no text in normal form has two spaces in a row
    for w, items in block:
        # latin-1 keeps one character per byte
        a.add_word(f" {w.decode('latin-1')} ", (w.count(b" ") + 1, tuple(items)))
    a.make_automaton()
    return a


def scan(text: bytes | None, machine) -> tuple[np.ndarray, set[str]]:
    """Mask over the words of the text (hit or not) and the ids of items with an occurring window."""
    norm = b" ".join(words(text))
    if not norm:
        return np.zeros(0, bool), set()
    line = f" {norm.decode('latin-1')} "
    mask, hits, items = np.zeros(norm.count(b" ") + 1, bool), set(), set()
    for end, (n, ids) in machine.iter(line):
        hits.add((end, n))
        items.update(ids)
    if hits:
        # the space that ends word i stands at the i-th entry
        ends = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)[1:]
        for end, n in hits:
            word = int(np.searchsorted(ends, end))
            mask[word - n + 1:word + 1] = True
    return mask, items


def original_spans(text: bytes, mask: np.ndarray) -> list[list[int]]:
    """Code point spans [start, end) of the original text that maximal runs of hit words cover."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    if not len(edge):
        return []
    at = [(m.start(), m.end()) for m in WORD.finditer(text.translate(NORMAL))]
    lead = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    return [[int(lead[at[a][0]]), int(lead[at[b - 1][1]])] for a, b in zip(edge[::2], edge[1::2])]


def decontaminate(docs: DataFrame, bench: DataFrame, text_col: str = "text", carry=("doc_id",),
                  item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``carry`` columns, then n_words, n_hit, n_items, items_sha256, contaminated, item_ids and
    the code point spans of the hit passages."""
    carry, sc = list(carry), docs.sparkSession.sparkContext
    kept = list(dict.fromkeys([*carry, text_col]))
    cur, masks = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(kept)]), []
    text = f"k{kept.index(text_col)}"
    part = [T.StructField("mask", T.BinaryType()), T.StructField("items", T.ArrayType(T.StringType()))]

    def partial(shared):
        def make():
            machine = automaton(shared.value)

            def fn(texts):
                got = [scan(t, machine) for t in texts]
                return [pa.array([np.packbits(m).tobytes() for m, _ in got], pa.binary()),
                        pa.array([sorted(i) for _, i in got], pa.list_(pa.string()))]

            return fn

        return make

    scratch, before = Scratch(docs.sparkSession, "decontam"), None
    for i, (last, block) in enumerate(window_blocks(windows(bench, item_col, item_text))):
        shared = sc.broadcast(block)            # at most about BLOCK_BYTES
        if last:
            break
        names = cur.columns
        cur = scratch.table(map_text(cur, text, names, part, partial(shared)).toDF(
            *names, f"m{i}", f"i{i}"), f"scan{i}")
        if before:
            scratch.release(*before)
        before = f"scan{i}", cur.schema
        masks += [f"m{i}", f"i{i}"]

    def make():
        machine = automaton(shared.value)

        def fn(texts, *before):
            rows = []
            for k, t in enumerate(texts):
                mask, items = scan(t, machine)
                for m, ids in zip(before[::2], before[1::2]):
                    mask = mask | np.unpackbits(np.frombuffer(m[k], np.uint8), count=len(mask)).view(bool)
                    items = items | set(ids[k])
                hit, ids = int(mask.sum()), sorted(items)
                rows.append((len(mask), hit, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(),
                             hit > 0 and SHARE * hit >= len(mask), ids,
                             original_spans(t, mask) if hit else []))
            cols = list(zip(*rows)) if rows else [()] * len(FIELDS)
            kinds = [pa.int64()] * 3 + [pa.string(), pa.bool_(), pa.list_(pa.string()),
                                        pa.list_(pa.list_(pa.int32()))]
            return [pa.array(c, k) for c, k in zip(cols, kinds)]

        return fn

    through = [f"k{kept.index(c)}" for c in carry] + masks
    done = map_text(cur, text, through, FIELDS, make, also=masks)
    names = [f"a{i}" for i in range(len(through))] + [f"o{i}" for i in range(len(FIELDS))]
    return done.toDF(*names).select(
        *[F.col(f"a{i}").alias(c) for i, c in enumerate(carry)],
        *[F.col(f"o{i}").alias(f.name) for i, f in enumerate(FIELDS)])


def op1_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated, with the columns of ``docs``."""
    found = decontaminate(docs, documents(spark, sf_dir, "benchmark"), carry=docs.columns)
    n = len(docs.columns)
    named = found.toDF(*[f"c{i}" for i in range(n)], *[f.name for f in FIELDS])
    return named.where(~F.col("contaminated")).select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
