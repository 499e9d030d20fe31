"""Byte-level BPE encoding and decoding with a public rank file (operator 5).

A text is cut by the tokenizer's pattern; every piece is encoded alone by ranked merges: of all
neighbouring byte strings, the pair of the lowest rank (the leftmost of equals) is joined,
until no pair has a rank. Decoding concatenates the byte strings of the ids.

Two forms of the same fold, held against each other and against the tiktoken library in the
tests:

* ``encode_words`` folds with Spark's higher-order functions over byte arrays of distinct
  words; the rank map is a literal.
* ``encode`` folds in Arrow batches and keeps the distinct words that the task has met. The
  query uses it: the README has the figures.

Defined results: null and empty texts have no tokens, and decode to nothing (for the query and
the stage null counts as empty). Bytes that are not UTF-8 are read as U+FFFD, as any reader of
strings would. Repeated rows are encoded alike; an empty table gives an empty result. Other
columns are ignored or, with ``carry``, passed through whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import documents, map_text

RANKS_FILE = "byte_bpe_multi_50k.tiktoken"
CACHE_WORDS = 300_000            # distinct words that a task keeps before it starts afresh
SHORT = 64                       # bytes; longer words use a heap

FIELDS = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
          T.StructField("decoded_sha256", T.StringType())]
IDS = T.StructField("ids", T.ArrayType(T.IntegerType()))


def load_ranks(path: str) -> dict[bytes, int]:
    """A fixed vocabulary file (under 1 MB), read on the driver: piece -> rank, rank = id."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f.read().splitlines())}


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word by ranked merges."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > SHORT:
        return _merge_long(word, ranks)
    parts = [word[i:i + 1] for i in range(len(word))]
    none = len(ranks) + 1
    pair = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:])]
    while pair and (low := min(pair)) < none:
        i = pair.index(low)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del pair[i]
        if i:
            pair[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
        if i < len(pair):
            pair[i] = ranks.get(parts[i] + parts[i + 1], none)
    return [ranks[p] for p in parts]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges with a heap of (rank, place) over a linked list of pieces."""
    n = len(word)
    end = list(range(1, n + 1))              # end of the piece that starts here; 0: none does
    before = list(range(-1, n - 1))          # start of the piece before
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, e = heapq.heappop(heap)
        j = end[i]
        if not j or j >= n or end[j] != e:
            continue                         # one of the two has grown meanwhile
        end[i], end[j] = e, 0
        if e < n:
            before[e] = i
            if (r := ranks.get(word[i:end[e]])) is not None:
                heapq.heappush(heap, (r, i, end[e]))
        if (b := before[i]) >= 0 and (r := ranks.get(word[b:e])) is not None:
            heapq.heappush(heap, (r, b, e))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[word[i:end[i]]])
        i = end[i]
    return ids


def decode(ids, pieces: list[bytes]) -> bytes:
    return b"".join(map(pieces.__getitem__, ids))


class _Words(dict):
    """word -> ids, filled as words are met."""

    def __init__(self, ranks):
        self.ranks = ranks

    def __missing__(self, word):
        ids = self[word] = merge_word(word.encode("utf-8"), self.ranks)
        return ids


def _maker(shared, pattern: str, with_ids: bool):
    def make():
        import regex

        ranks = shared.value
        pieces = [b""] * (max(ranks.values(), default=-1) + 1)
        for piece, i in ranks.items():
            pieces[i] = piece
        names = [str(i) for i in range(len(pieces))]
        cut = regex.compile(pattern).findall
        known = _Words(ranks)

        def fn(texts):
            n, sha, back, flat = [], [], [], []
            for t in texts:
                ids = []
                for word in cut((t or b"").decode("utf-8", "replace")):
                    ids += known[word]
                n.append(len(ids))
                sha.append(hashlib.sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest())
                back.append(hashlib.sha256(decode(ids, pieces)).hexdigest())
                if with_ids:
                    flat.append(np.array(ids, np.int32))
                if len(known) > CACHE_WORDS:
                    known.clear()
            out = [pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(back, pa.string())]
            if with_ids:
                ends = np.concatenate(([0], np.cumsum(n, dtype=np.int32))).astype(np.int32)
                values = np.concatenate(flat) if flat else np.empty(0, np.int32)
                out.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32())))
            return out

        return fn

    return make


def encode(docs: DataFrame, text_col: str = "text", carry=("doc_id",), path: str | None = None,
           pattern: str = public_tokenizers.PATTERN, with_ids: bool = True) -> DataFrame:
    """``carry`` columns, n_tokens, digests of the ids and of the decoded bytes, and the ids."""
    ranks = load_ranks(path or public_tokenizers.path(RANKS_FILE))
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    return map_text(docs, text_col, carry, FIELDS + [IDS] * with_ids, _maker(shared, pattern, with_ids))


# ---------------------------------------------------------------- higher-order functions

BUCKETS = 4096


def rank_literal(ranks: dict[bytes, int]) -> Column:
    """The ranks as a literal: an array of BUCKETS small maps from hex string to rank, by CRC-32."""
    buckets: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for piece, i in ranks.items():
        h = piece.hex()
        buckets[zlib.crc32(h.encode()) % BUCKETS][h] = i
    return F.from_json(F.lit(json.dumps(buckets)), "array<map<string,int>>")


def fold_merges(word: Column, table: Column) -> Column:
    """Ids of a binary word: in as many rounds as it has bytes the lowest-ranked pair is joined."""
    word = F.lower(F.hex(word))
    size = (F.length(word) / 2).cast("int")
    first = F.transform(F.sequence(F.lit(1), size), lambda i: F.substring(word, i * 2 - 1, F.lit(2)))

    def rank(piece):
        return F.try_element_at(F.get(table, (F.crc32(piece) % BUCKETS).cast("int")), piece)

    def step(parts, _):
        n = F.size(parts)
        pairs = F.when(n > 1, F.transform(F.sequence(F.lit(0), n - 2), lambda i: rank(
            F.concat(F.get(parts, i), F.get(parts, i + 1)))))
        low = F.array_min(pairs)
        at = F.array_position(pairs, low).cast("int")
        joined = F.concat(F.slice(parts, 1, at - 1),
                          F.array(F.concat(F.get(parts, at - 1), F.get(parts, at))),
                          F.slice(parts, at + 2, F.greatest(n - at - 1, F.lit(0))))
        return F.when(low.isNull(), parts).otherwise(joined)

    parts = F.when(size > 1, F.aggregate(F.sequence(F.lit(2), size), first, step)).otherwise(first)
    return F.transform(parts, rank)


def encode_words(words: DataFrame, word_col: str, ranks: dict[bytes, int]) -> DataFrame:
    """(word, ids) of the distinct non-empty words of a column, folded by Spark alone."""
    w = words.select(F.col(f"`{word_col}`").cast("binary").alias("word")).where(F.length("word") > 0).distinct()
    return w.select("word", fold_merges(F.col("word"), rank_literal(ranks)).alias("ids"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(documents(spark, sf_dir), with_ids=False)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document: doc_id, n_tokens, digests and ids."""
    return encode(docs)
