"""Quality rules with compression bands (operator 10).

A document that passes the base rules (enough words, not made of repeated 3-word windows)
is compressed with zstandard, as a whole and in fixed chunks (the last one ends with the text and
overlaps the one before). Natural text of a given length compresses within a band: repeated text compresses
far better, random or encoded text far worse. A document is rejected when its whole ratio falls outside the
band of its length, or when ``NOISE_SHARE`` or more of its chunks lie below the chunk band or more
than ``REPEAT_SHARE`` above it. The lowest ratio is one of bytes; the highest is per code point (ratio divided
by bytes per code point), since scripts of two or three bytes a letter compress that much better
without being repetitive.

Defined results: null and empty texts have no words, so ``n_words`` = 0, ``base_failed`` is
true, ``ratio`` is null and ``kept`` false. Ties and repeated rows do not matter (each row
is judged alone); an empty table gives an empty result; other columns are ignored or, with
``carry``, passed through whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import documents, map_text

WS = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
FOLLOWING = bytes(range(0x80, 0xC0))     # bytes that go on with a code point
MIN_WORDS = 50
LEVEL = 3
CHUNK = 4096
#: Fixed values: (bytes up to, lowest ratio of original to compressed size of whole texts, highest
#: ratio per code point). The lowest lies between encoded noise and the densest technical prose of that
#: length, the highest is three times the middle of natural text.
BANDS = ((384, 1.1, 4.7), (512, 1.2, 4.7), (768, 1.3, 5.0), (1024, 1.35, 5.4), (1536, 1.4, 5.7),
         (2048, 1.45, 5.9), (3072, 1.5, 6.1), (4096, 1.52, 6.3), (8192, 1.55, 6.5),
         (16384, 1.6, 6.8), (32768, 1.6, 7.0), (131072, 1.6, 7.2), (1 << 62, 1.6, 9.0))
#: The band of a chunk of CHUNK bytes, and the shares of chunks below it that rejects and above it that is kept.
CHUNK_BAND = (1.5, 6.4)
NOISE_SHARE, REPEAT_SHARE = 0.25, 0.5

FIELDS = [T.StructField(n, T.LongType()) for n in
          ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] + [
    T.StructField("base_failed", T.BooleanType()), T.StructField("ratio", T.DoubleType()),
    T.StructField("noisy_chunks", T.DoubleType()), T.StructField("repetitive_chunks", T.DoubleType()),
    T.StructField("kept", T.BooleanType())]


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found at least twice in the text."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, n)
    v = len(ids)
    if v < 2_000_000:
        key = (w[:-2] * v + w[1:-1]) * v + w[2:]
    else:
        pair = np.unique(w[:-2] * v + w[1:-1], return_inverse=True)[1]
        key = pair.astype(np.int64) * v + w[2:]
    _, inv, cnt = np.unique(key, return_inverse=True, return_counts=True)
    twice = cnt[inv] > 1
    hit = np.zeros(n, bool)
    for k in range(3):
        hit[k:n - 2 + k] |= twice
    return int(hit.sum())


def code_points(b: bytes) -> int:
    return len(b.decode("utf-8", "replace"))


def base_stats(b: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text in UTF-8."""
    words = b.split()
    if not words:
        return 0, 0, len(b) - len(b.translate(None, SYMBOLS)), 0, 0
    lines = [x for x in b.split(b"\n") if x.strip()]
    return (len(words), code_points(b.translate(None, WS)),
            len(b) - len(b.translate(None, SYMBOLS)), len(lines) - len(set(lines)),
            repeated_words(words))


def per_point(b: bytes, ratio: float) -> float:
    """The ratio divided by the bytes per code point of ``b``, which may begin or end within one."""
    return ratio * max(len(b.translate(None, FOLLOWING)), 1) / len(b)


def compression(b: bytes, size_of) -> tuple[float, float, float]:
    """Ratio of the whole text, and the shares of its chunks below and above the chunk band.

    The last chunk ends with the text; a text shorter than a chunk has none.
    """
    low = high = n = 0
    for i in range(0, len(b) if len(b) >= CHUNK else 0, CHUNK):
        n += 1
        at = min(i, len(b) - CHUNK)
        c = b[at:at + CHUNK]
        r = CHUNK / size_of(c)
        low += r < CHUNK_BAND[0]
        high += per_point(c, r) > CHUNK_BAND[1]
    return len(b) / size_of(b), low / max(n, 1), high / max(n, 1)


def within_bands(b: bytes, ratio: float, noisy: float, repetitive: float) -> bool:
    low, high = next((lo, hi) for top, lo, hi in BANDS if len(b) <= top)
    return low <= ratio and per_point(b, ratio) <= high and noisy < NOISE_SHARE and repetitive <= REPEAT_SHARE


def _maker():
    import zstandard

    z = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
    size_of = lambda b: len(z.compress(b))

    def fn(texts):
        rows = []
        for t in texts:
            b = t or b""
            s = base_stats(b)
            failed = s[0] < MIN_WORDS or 100 * s[4] > 50 * s[0]
            pressed = compression(b, size_of) if b else (None, None, None)
            rows.append((*s, failed, *pressed, not failed and within_bands(b, *pressed)))
        cols = list(zip(*rows)) if rows else [()] * len(FIELDS)
        kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.float64(), pa.float64(), pa.bool_()]
        return [pa.array(c, k) for c, k in zip(cols, kinds)]

    return fn


def judge(docs: DataFrame, text_col: str = "text", carry=("doc_id",)) -> DataFrame:
    """``carry`` columns and, per row, the base counts, compression ratios and the verdict."""
    return map_text(docs, text_col, carry, FIELDS, _maker)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, with the columns of ``docs``."""
    judged = judge(docs, carry=docs.columns)
    names = [f"c{i}" for i in range(len(docs.columns))] + [f.name for f in FIELDS]
    return judged.toDF(*names).where(F.col("kept")).select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
