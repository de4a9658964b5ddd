"""Lenient parsing of landed text (C5, C6, C7, C8; decisions D2-D5)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from touchline.functions.parsing import lenient_int, match_date, season_code, season_start_year


def _one(spark, expr, values, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_lenient_int(spark):
    got = _one(spark, lenient_int, ["3", "3.0", "3.7", " 4 ", "", "x", None, "1e1", "99999999999", "3d", "2.5D", "-3.9", "+2."])
    assert got == [3, 3, 3, 4, None, None, None, None, None, None, None, -3, 2]


def test_match_date_formats_and_century(spark):
    got = _one(spark, match_date, ["14/08/93", "14/08/01", "14/08/1993", "2001-08-14", "31/02/99", "", "junk", None,
                                   "01/01/69", "01/01/70"])
    assert got == [dt.date(1993, 8, 14), dt.date(2001, 8, 14), dt.date(1993, 8, 14), dt.date(2001, 8, 14),
                   None, None, None, None, dt.date(2069, 1, 1), dt.date(1970, 1, 1)]


def test_season_start_year_keeps_leading_zero_and_century(spark):
    got = _one(spark, season_start_year, ["9394", "9900", "0001", "0910", "2324", None])
    assert got == [1993, 1999, 2000, 2009, 2023, None]


def test_season_code_roundtrip(spark):
    got = _one(spark, season_code, [1993, 1999, 2000, 2009, 2023], "int")
    assert got == ["9394", "9900", "0001", "0910", "2324"]


def test_readable_path_decodes_uri_escapes_and_escapes_globs():
    from touchline.sources.bronze import readable_path
    assert readable_path("file:/l/premier%20league/9394.csv") == "file:/l/premier league/9394.csv"
    assert readable_path("file:/l/liga%5B1%5D/a+b/%7Bx%7D*.csv") == "file:/l/liga\\[1\\]/a+b/\\{x\\}\\*.csv"
    assert readable_path("file:/l/plain/0001.csv") == "file:/l/plain/0001.csv"
