"""Coercing parsers: a value that does not parse becomes NULL, never an error.

Spark 4 runs with ANSI mode on, where ``to_date`` and ``CAST`` raise on bad
input; the ``try_*`` forms give NULL instead, which is what the data-quality
flags test for.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ident(name: str) -> str:
    """A column name as a quoted SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    """A Python string as a SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def date_sql(name: str, pattern: str = "M/d/yyyy") -> str:
    return f"try_to_date({ident(name)}, {text(pattern)})"


def time_sql(name: str, pattern: str = "H:m") -> str:
    return f"date_format(try_to_timestamp({ident(name)}, {text(pattern)}), 'HH:mm:ss')"


# Signed digits with one optional point and exponent, or an infinity, between
# optional spaces: what pandas reads as a number.  A plain cast would also
# take Java's type suffixes (``10d``, ``10f``).
NUMBER_PATTERN = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"


def number_sql(name: str) -> str:
    return f"CASE WHEN {ident(name)} RLIKE {text(NUMBER_PATTERN)} THEN try_cast({ident(name)} as double) END"


def date_to_iso(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(c, "yyyy-MM-dd")


def null_markers_to_null(col: Column | str, markers: list[str]) -> Column:
    """Map exact null-marker tokens (``NA``, ``null``, empty ...) to NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isin(markers), F.lit(None).cast("string")).otherwise(c)
