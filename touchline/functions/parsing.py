"""Lenient, ANSI-safe parsing of landed text into typed values.

Landed values are untrusted text. Under Spark 4 (ANSI on) ``cast`` and
``to_date`` raise on bad input, so every parse here is a ``try_*`` form that
yields NULL instead, and all of them stay JVM-side built-ins.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Two-digit years at or above this value belong to the 1900s, the rest to the
# 2000s (match files start in the 1990s).
CENTURY_PIVOT = 70

_SHORT_DATE = r"^\d{2}/\d{2}/\d{2}$"
DECIMAL_TEXT = r"^\s*([+-]?\d+)\.\d*\s*$"
DATE_FORMATS = ("dd/MM/yyyy", "yyyy-MM-dd")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_int(c: str | Column) -> Column:
    """Text -> INT: ``"3"``, ``" 3 "`` and ``"3.0"`` give 3; junk, exponents,
    type suffixes (``3d``) and empty text give NULL.

    Plain integers take the direct cast; only text of the shape sign, digits,
    point, digits has its fraction cut off and is cast again.
    """
    text = _col(c)
    whole = F.regexp_extract(text, DECIMAL_TEXT, 1)
    return F.coalesce(text.try_cast("int"), F.when(text.rlike(DECIMAL_TEXT), whole.try_cast("int")))


def two_digit_year_century(yy: Column) -> Column:
    """Full year from an INT two-digit year using :data:`CENTURY_PIVOT`."""
    return F.when(yy >= CENTURY_PIVOT, yy + 1900).otherwise(yy + 2000)


def match_date(c: str | Column) -> Column:
    """Text -> DATE from ``dd/MM/yy``, ``dd/MM/yyyy`` or ``yyyy-MM-dd``.

    A two-digit year first gets its century inserted, so ``14/08/93`` reads as
    1993-08-14; impossible dates (``31/02/99``) and junk give NULL.
    """
    text = _col(c)
    yy = F.substring(text, 7, 2)
    century = F.when(yy.try_cast("int") >= CENTURY_PIVOT, F.lit("19")).otherwise(F.lit("20"))
    # Each format is tried first on the text shape it can parse: a failed
    # parse costs a thrown exception inside the parser, so trying every
    # format on every row is several times slower. Other shapes still go
    # through all formats, so the result equals a plain first-that-parses.
    return (
        F.when(text.rlike(_SHORT_DATE),
               F.try_to_date(F.concat(F.substring(text, 1, 6), century, yy), DATE_FORMATS[0]))
        .when(text.rlike(r"^\d{2}/\d{2}/\d{4}$"), F.try_to_date(text, DATE_FORMATS[0]))
        .when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(text, DATE_FORMATS[1]))
        .otherwise(F.coalesce(*[F.try_to_date(text, fmt) for fmt in DATE_FORMATS]))
    )


def season_start_year(season: str | Column) -> Column:
    """Season code ``"9394"`` -> 1993, ``"0001"`` -> 2000, ``"2324"`` -> 2023."""
    return two_digit_year_century(F.substring(_col(season), 1, 2).try_cast("int"))


def season_code(start_year: str | Column) -> Column:
    """Start year -> season code: 1999 -> ``"9900"``, 2023 -> ``"2324"``."""
    y = _col(start_year)
    return F.concat(F.lpad((y % 100).cast("string"), 2, "0"), F.lpad(((y + 1) % 100).cast("string"), 2, "0"))


def run_id_at(moment: Column | str) -> Column:
    """``yyyyMMdd'T'HHmmss'Z'`` of a timestamp, in UTC whatever the session's zone (also before 1970)."""
    seconds = F.unix_seconds(moment)
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / F.lit(86400)).cast("int"))
    inside = F.pmod(seconds, F.lit(86400))
    clock = [F.lpad(F.floor(inside % outer / F.lit(unit)).cast("string"), 2, "0")
             for outer, unit in ((86400, 3600), (3600, 60), (60, 1))]
    return F.concat(F.date_format(day, "yyyyMMdd"), F.lit("T"), *clock, F.lit("Z"))
