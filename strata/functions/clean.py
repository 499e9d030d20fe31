"""Scalar column expressions for locale-formatted text.

All functions return ``Column`` objects built from Spark built-ins, so they stay inside
whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two textual spellings of "no value" used by the landed files.
MISSING_TOKENS = ("-", "")
# Date and timestamp layouts of the landed files.
DATE_FORMAT = "dd/MM/yyyy"
TIMESTAMP_FORMAT = "dd/MM/yyyy HH:mm:ss"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_number(col: str | Column, dtype: str = "double") -> Column:
    """B1 strict parse: trim, missing token -> NULL, every ',' -> '.', cast.

    Under ANSI mode a malformed value raises at run time (cast, not try_cast).
    """
    text = F.translate(F.trim(_c(col)), ",", ".")
    for token in MISSING_TOKENS:
        text = F.nullif(text, F.lit(token))
    return text.cast(dtype)


def try_parse_number(col: str | Column, dtype: str = "double") -> Column:
    """B2 tolerant parse: comma rule, anything that does not parse -> NULL."""
    text = F.replace(F.trim(_c(col).cast("string")), F.lit(","), F.lit("."))
    return text.try_cast(dtype)


def is_null(col: str | Column) -> Column:
    """The value is SQL NULL."""
    return _c(col).isNull()


def is_token(col: str | Column) -> Column:
    """The value is present but is a missing token after trim ('' or '-')."""
    c = _c(col).cast("string")
    return c.isNotNull() & F.trim(c).isin(*MISSING_TOKENS)


def is_missing(col: str | Column) -> Column:
    """NULL, blank or hyphen."""
    c = _c(col).cast("string")
    return c.isNull() | F.trim(c).isin(*MISSING_TOKENS)


def is_filled(col: str | Column) -> Column:
    return ~is_missing(col)


def normalize_label(col: str | Column) -> Column:
    """Trim and drop one trailing '.'."""
    return F.regexp_replace(F.trim(_c(col)), r"\.$", "")


def parse_date(col: str | Column, fmt: str = DATE_FORMAT, strict: bool = True) -> Column:
    """Text date -> DATE (strict raises under ANSI, tolerant gives NULL)."""
    return F.to_date(_c(col), fmt) if strict else F.try_to_date(_c(col), fmt)


def parse_ts(col: str | Column, fmt: str = TIMESTAMP_FORMAT, strict: bool = True) -> Column:
    """Text timestamp -> TIMESTAMP_NTZ (a wall-clock time, no zone)."""
    if strict:
        return F.to_timestamp_ntz(_c(col), F.lit(fmt))
    return F.try_to_timestamp(_c(col), F.lit(fmt)).cast("timestamp_ntz")


def row_stats(cols: list[str], base: float = 100.0, mean_scale: int = 3) -> dict[str, Column]:
    """B12 row-wise statistics over n columns.

    mean and complement use plain addition, so one NULL member makes them NULL;
    spread and all_max use greatest/least, which skip NULLs.
    """
    n = len(cols)
    total = reduce(lambda a, b: a + b, [F.col(c) for c in cols])
    return {
        "mean": F.round(total / F.lit(n), mean_scale),
        "complement": F.round(F.lit(base) - total / F.lit(n), mean_scale),
        "spread": F.greatest(*[F.col(c) for c in cols]) - F.least(*[F.col(c) for c in cols]),
        "all_max": F.least(*[F.col(c) for c in cols]) >= F.lit(base),
    }


def count_where(cols: list[str], predicate) -> Column:
    """How many of the columns satisfy ``predicate(col)`` (NULL counts as no)."""
    return reduce(lambda a, b: a + b,
                  [F.when(predicate(F.col(c)), 1).otherwise(0) for c in cols])


def signed_pair(placed: str | Column, removed: str | Column) -> Column:
    """Exclusive placed/removed columns as one signed measure; both NULL -> NULL."""
    a, b = _c(placed), _c(removed)
    return F.when(a.isNull() & b.isNull(), F.lit(None)).otherwise(
        F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0)))


# State labels of a signed pair (removed wins when both are set).
PAIR_REMOVED, PAIR_PLACED, PAIR_NONE = "RETIRADA", "REPOSICAO", "SEM_LEITURA"


def pair_state(placed: str | Column, removed: str | Column) -> Column:
    """B15 state label: removed set -> RETIRADA, else placed set -> REPOSICAO, else SEM_LEITURA."""
    return (F.when(_c(removed).isNotNull(), F.lit(PAIR_REMOVED))
             .when(_c(placed).isNotNull(), F.lit(PAIR_PLACED))
             .otherwise(F.lit(PAIR_NONE)))
