"""Column-expression helpers (all JVM-side built-ins)."""

from tessera.functions.casts import to_decimal, varchar
from tessera.functions.dates import (month_label, month_start, parse_date,
                                     parse_timestamp, spark_pattern,
                                     micros_between, utc_now)

__all__ = ["to_decimal", "varchar", "month_label", "month_start", "parse_date",
           "parse_timestamp", "spark_pattern", "micros_between", "utc_now"]
