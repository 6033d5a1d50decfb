"""Date and timestamp expressions.

Contract formats are written in the source system's notation; Spark's
patterns are derived from them.  Single-letter fields (``d``, ``M``, ``H``)
accept both one- and two-digit values, as the source system's parser does.
Parsing always uses the ``try_`` variants: an unparseable cell is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Contract date formats and their Spark datetime patterns.
FORMAT_TO_PATTERN = {
    "DD/MM/YYYY": "d/M/yyyy",
    "MM/DD/YYYY": "M/d/yyyy",
    "YYYY-MM-DD": "yyyy-M-d",
    "DD-MM-YYYY": "d-M-yyyy",
    "DD/MM/YYYY HH24:MI:SS": "d/M/yyyy H:m:s",
}


def spark_pattern(contract_format: str) -> str:
    try:
        return FORMAT_TO_PATTERN[contract_format]
    except KeyError:
        raise ValueError(f"unsupported date format: {contract_format}") from None


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(col: Column | str, contract_format: str = "DD/MM/YYYY") -> Column:
    """``TO_DATE(col, fmt)``; NULL when the text does not parse."""
    return F.try_to_date(_col(col), spark_pattern(contract_format))


def parse_timestamp(col: Column | str,
                    contract_format: str = "DD/MM/YYYY HH24:MI:SS") -> Column:
    """``TO_TIMESTAMP(col, fmt)`` as a zone-free wall-clock timestamp.

    Parsing and the cast to TIMESTAMP_NTZ both use the session zone, so the
    wall clock in the text is preserved whatever the zone is.
    """
    return F.try_to_timestamp(_col(col), F.lit(spark_pattern(contract_format))) \
        .cast("timestamp_ntz")


def month_start(col: Column | str) -> Column:
    """``DATE_TRUNC('month', d)`` kept as a DATE (zone-independent)."""
    return F.trunc(_col(col), "MM")


def month_label(col: Column | str) -> Column:
    """``TO_CHAR(DATE_TRUNC('month', d), 'Mon-YYYY')``, e.g. ``Feb-2023``."""
    return F.date_format(_col(col), "MMM-yyyy")


def micros_between(start: Column | str, end: Column | str) -> Column:
    """Exact ``end - start`` in microseconds (DECIMAL(38,0)).

    Zone-free timestamps subtract to a day-time interval without consulting
    the session zone; the interval is read out as seconds with six decimals.
    """
    seconds = (_col(end) - _col(start)).cast("interval second").cast("decimal(38,6)")
    return (seconds * 1_000_000).cast("decimal(38,0)")


def utc_now() -> Column:
    """Load time as a zone-free UTC wall clock (``insert_date``), whatever
    the session zone; constant within one query."""
    return F.convert_timezone(None, F.lit("UTC"), F.current_timestamp())
