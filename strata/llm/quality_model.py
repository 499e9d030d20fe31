"""Quality classifier on supervised subword embeddings (operator 4).

Every word and every character n-gram (n bytes inside a word, its bounding blanks included) is
hashed into a table of learned vectors; so is a mark wherever a word repeats the one before. The vectors of a document are averaged and a softmax
layer gives the probability of label 1. Vectors and layer are trained together by stochastic
gradient descent in numpy.

Training uses a bounded sample: at most ``TRAIN_ROWS`` labelled documents of each class and at
most ``TRAIN_BYTES`` of text, chosen by a hash of the id (whole texts; a text that does not
fit is left out of the sample). Scoring reads every text whole: the model is linear in the
averaged vectors, so each bucket has one number and a document the mean of its buckets'.

Defined results: null, empty and blank texts have no features and get the score of the bias
alone. Rows without an id are scored and never held out. Repeated rows get equal scores. An
empty table gives an empty result; without labels of both classes the score is the share of
label 1 (0.5 without any). Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import Scratch, documents, map_text
from strata.llm.labelled import train_sample, verdict

PARTS, HELD = 3, 1
THRESHOLD = 0.5
TRAIN_ROWS = 2500                # of each class, at most
TRAIN_BYTES = 48 << 20           # of text, at most
NGRAMS = (3, 4)
BITS = 17                        # buckets
DIM = 8
REPEAT_WEIGHT = 12               # tokens for a word that repeats the one before it
EPOCHS, RATE = 6, 0.05           # steps are divided by the root of the squared gradients so far
SEGMENT = 1 << 20                # bytes of text that are hashed at once

_P = 0x9E3779B97F4A7C15          # odd: has an inverse modulo 2^64
_PINV = pow(_P, -1, 1 << 64)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[0] = 1
    return np.cumprod(p)


def _buckets(h: np.ndarray, kind: int) -> np.ndarray:
    h = (h ^ np.uint64(kind * 0x2545F4914F6CDD1D % (1 << 64))) * _MIX
    h ^= h >> np.uint64(32)
    return ((h * _MIX) >> np.uint64(64 - BITS)).astype(np.int64)


def hashed(block: bytes, at: np.ndarray):
    """(buckets, first positions) of the words and n-grams of a block of parts, each between two blanks of its own.

    The parts begin at the positions ``at``. No n-gram reaches over two blanks and no word is compared with
    one of another part, so a part gets the same tokens whatever stands beside it.
    """
    data = np.frombuffer(block, np.uint8)
    blank = _SPACE[data]
    n = len(data)
    value = np.where(blank, np.uint64(1), data.astype(np.uint64) + np.uint64(2))
    prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value * _powers(_P, n))))
    back = _powers(_PINV, n)
    blanks = np.concatenate(([0], np.cumsum(blank)))
    edge = np.diff(blank.view(np.int8))
    start, end = np.flatnonzero(edge == -1) + 1, np.flatnonzero(edge == 1) + 1
    word = (prefix[end] - prefix[start]) * back[start]
    yield _buckets(word, 0), start
    # a token of its own, as heavy as a word with its n-grams, where a word repeats the last one
    part = np.searchsorted(at, start, side="right")
    again = np.repeat(start[1:][(word[1:] == word[:-1]) & (part[1:] == part[:-1])], REPEAT_WEIGHT)
    yield _buckets(np.zeros(len(again), np.uint64), 1), again
    for k in NGRAMS:
        i = np.flatnonzero(blanks[k - 1:n] == blanks[1:n - k + 2]) if n >= k else np.empty(0, np.int64)
        yield _buckets((prefix[i + k] - prefix[i]) * back[i], k), i


def segments(texts: list[bytes | None]):
    """Blocks of whole words of the texts, up to SEGMENT bytes: (block, the text of each part, first positions).

    A text's parts depend on the text alone; the blocks that hold them depend on the batch."""
    parts, owner, size = [], [], 0

    def block():
        at = np.cumsum([0] + [len(p) + 2 for p in parts])[:-1]
        return b"".join(b" " + p + b" " for p in parts), np.array(owner), at

    for k, t in enumerate(texts):
        t, i = t or b"", 0
        while i < len(t):
            j = min(i + SEGMENT, len(t))
            while j < len(t) and not _SPACE[t[j]]:
                j += 1
            if size and size + j - i > SEGMENT:
                yield block()
                parts, owner, size = [], [], 0
            parts.append(t[i:j])
            owner.append(k)
            size += j - i
            i = j
    if parts:
        yield block()


def counts(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and their shares."""
    found = [b for block, _, at in segments([text]) for b, _ in hashed(block, at)]
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.float32)
    idx, n = np.unique(np.concatenate(found), return_counts=True)
    return idx, (n / n.sum()).astype(np.float32)


def train(samples: list[tuple[bytes | None, int]], seed: int = 7) -> tuple[np.ndarray, float]:
    """One number per bucket, and a bias: their mean and sum are the log-odds of label 1."""
    ones = sum(y for _, y in samples)
    if not 0 < ones < len(samples):
        share = min(max(ones / len(samples), 1e-6), 1 - 1e-6) if samples else 0.5
        return np.zeros(1 << BITS, np.float32), math.log(share / (1 - share))
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM)).astype(np.float32)
    layer, bias = np.zeros((2, DIM), np.float32), np.zeros(2, np.float32)
    docs = [(*counts(t), y) for t, y in samples]
    weight = (len(docs) / (2 * (len(docs) - ones)), len(docs) / (2 * ones))   # classes count alike
    steps, step = EPOCHS * len(docs), 0
    squares, layer_squares, bias_squares = np.full_like(table, 1e-8), np.full_like(layer, 1e-8), np.full_like(bias, 1e-8)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(docs)):
            idx, share, y = docs[k]
            rate = RATE * (1 - step / steps)
            step += 1
            rows = table[idx]
            mean = share @ rows if len(idx) else np.zeros(DIM, np.float32)
            z = layer @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            p *= weight[y]
            if len(idx):
                g = share[:, None] * (p @ layer)
                s = squares[idx] + g * g
                squares[idx] = s
                table[idx] = rows - rate * g / np.sqrt(s)
            g = np.outer(p, mean)
            layer_squares += g * g
            layer -= rate * g / np.sqrt(layer_squares)
            bias_squares += p * p
            bias -= rate * p / np.sqrt(bias_squares)
    return table @ (layer[1] - layer[0]), float(bias[1] - bias[0])


def _maker(shared):
    def make():
        table, bias = shared.value

        def fn(texts):
            total, number = np.zeros(len(texts)), np.zeros(len(texts))
            for block, owner, at in segments(texts):
                sums, tokens = np.zeros(len(at)), np.zeros(len(at))
                for idx, pos in hashed(block, at):
                    part = np.searchsorted(at, pos, side="right") - 1
                    sums += np.bincount(part, table[idx], len(at))
                    tokens += np.bincount(part, minlength=len(at))
                np.add.at(total, owner, sums)           # part by part, in the order of the text
                np.add.at(number, owner, tokens)
            z = total / np.maximum(number, 1) + bias
            return [pa.array(1 / (1 + np.exp(-np.clip(z, -700, 700))))]

        return fn

    return make


def sample_texts(docs: DataFrame, labels: DataFrame, scratch: Scratch, text_col: str) -> list[tuple[bytes, int]]:
    """The training texts with their labels: bounded by TRAIN_ROWS and TRAIN_BYTES."""
    chosen = train_sample(labels, "quality", PARTS, HELD, TRAIN_ROWS)
    text = F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b""))
    rows = scratch.table(docs.select("doc_id", text.alias("t"))
                         .join(F.broadcast(chosen), "doc_id")          # at most 2 * TRAIN_ROWS narrow rows
                         .select("doc_id", "y", "t", F.length("t").alias("n"), F.xxhash64("t").alias("h"),
                                 F.monotonically_increasing_id().alias("uid")), "sample")
    taken, size, seen = [], 0, set()
    for r in rows.select("doc_id", "h", "n", "uid").orderBy(F.xxhash64("doc_id"), "doc_id", "h", "uid").limit(2 * TRAIN_ROWS).collect():
        if (r.doc_id, r.h) not in seen and size + r.n <= TRAIN_BYTES:
            seen.add((r.doc_id, r.h))
            size += r.n
            taken.append((r.uid,))
    if not taken:
        return []
    uids = docs.sparkSession.createDataFrame(taken, "uid long")
    got = rows.join(F.broadcast(uids), "uid").select("doc_id", "h", "t", "y").collect()
    return [(bytes(r.t), r.y) for r in sorted(got, key=lambda r: (r.doc_id, r.h))]


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  scratch: Scratch | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    named = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    scratch = scratch or Scratch(docs.sparkSession, "quality-model")
    model = train(sample_texts(named, labels, scratch, "text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)           # 2^BITS floats
    scored = map_text(named, "text", ["doc_id"], [T.StructField("score", T.DoubleType())], _maker(shared))
    return scored.select(*verdict(F.col("doc_id"), F.col("score"), PARTS, HELD, THRESHOLD))


def op4_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))
