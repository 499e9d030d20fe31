"""Semantics ledger 1, 2, 6: locale parsing, missing tokens, row-wise statistics."""

import pytest
from pyspark.sql import functions as F

from strata.functions import clean


def test_strict_and_tolerant_parse(spark):
    vals = ["14,0", " 7 ", "-", "", " - ", None, "1.234,56"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    ok = df.filter(F.col("s").isNull() | (F.col("s") != "1.234,56"))
    strict = [r[0] for r in ok.select(clean.parse_number("s")).collect()]
    assert strict == [14.0, 7.0, None, None, None, None]
    tolerant = [r[0] for r in df.select(clean.try_parse_number("s")).collect()]
    # '1.234,56' -> '1.234.56' does not parse: NULL in the tolerant form
    assert tolerant == [14.0, 7.0, None, None, None, None, None]


def test_strict_parse_raises_on_malformed(spark):
    df = spark.createDataFrame([("abc",)], "s string")
    with pytest.raises(Exception):
        df.select(clean.parse_number("s")).collect()
    df2 = spark.createDataFrame([("14,0",)], "s string")
    with pytest.raises(Exception):  # '14.0' is not an int under ANSI
        df2.select(clean.parse_number("s", "int")).collect()


def test_missing_tokens(spark):
    df = spark.createDataFrame([(v,) for v in [None, "", " ", "-", " - ", "x"]], "s string")
    rows = df.select(clean.is_null("s"), clean.is_token("s"), clean.is_missing("s")).collect()
    assert [tuple(r) for r in rows] == [
        (True, False, True), (False, True, True), (False, True, True), (False, True, True),
        (False, True, True), (False, False, False)]


def test_label_and_dates(spark):
    df = spark.createDataFrame([("  PLUV4. ", "31/08/2026"), ("PLUV4", "1/2/2026")], "l string, d string")
    r = df.select(clean.normalize_label("l"), clean.parse_date("d", strict=False)).collect()
    assert r[0][0] == r[1][0] == "PLUV4"
    assert str(r[0][1]) == "2026-08-31"
    bad = spark.createDataFrame([("31/02/2026",)], "d string")
    assert bad.select(clean.parse_date("d", strict=False)).first()[0] is None
    with pytest.raises(Exception):
        bad.select(clean.parse_date("d")).collect()


def test_row_stats_nulls(spark):
    cols = ["r1", "r2", "r3"]
    df = spark.createDataFrame([(100, 100, 100), (90, None, 80), (None, None, None), (75, 100, 90)],
                               "r1 int, r2 int, r3 int")
    st = clean.row_stats(cols, base=100)
    rows = df.select(st["mean"], st["complement"], st["spread"], st["all_max"],
                     clean.count_where(cols, lambda c: c == 100)).collect()
    assert tuple(rows[0]) == (100.0, 0.0, 0, True, 3)
    assert rows[1][0] is None and rows[1][1] is None  # one NULL ruler -> NULL mean
    assert rows[1][2] == 10 and rows[1][3] is False    # greatest/least skip NULLs
    assert rows[2][0] is None and rows[2][2] is None and rows[2][3] is None
    assert tuple(rows[3])[2:] == (25, False, 1)


def test_signed_pair(spark):
    df = spark.createDataFrame([(5, None), (None, 3), (5, 3), (None, None)], "a int, b int")
    rows = df.select(clean.signed_pair("a", "b"), clean.pair_state("a", "b")).collect()
    assert [tuple(r) for r in rows] == [(5, "REPOSICAO"), (-3, "RETIRADA"), (2, "RETIRADA"),
                                        (None, "SEM_LEITURA")]
