"""Casts used at the raw -> bronze edge.

``col::VARCHAR(n)`` truncates to n characters in the source system, while a
Spark ``CAST AS VARCHAR(n)`` does not, so the bounded text cast is a
``substring``.  Numeric casts use ``try_cast`` so one bad cell yields NULL
(and is caught by ingestion's quarantine) instead of failing the job under
ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def varchar(col: Column | str, n: int) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.substring(c.cast("string"), 1, n)


def to_decimal(col: Column | str, precision: int = 10, scale: int = 2) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast(f"decimal({precision},{scale})")
