"""Column-level helpers: safe casts, date bounds and label mappings.

All return ``pyspark.sql.Column`` expressions built from built-in
functions, so they stay inside whole-stage code generation.
"""

from accrualkit.functions.casts import as_boolean, try_bigint, try_int
from accrualkit.functions.dates import at_midnight, date_lit, days_in_month, last_day, next_month
from accrualkit.functions.labels import resolve_pms, sync_type_label

__all__ = [
    "as_boolean",
    "try_bigint",
    "try_int",
    "at_midnight",
    "date_lit",
    "days_in_month",
    "last_day",
    "next_month",
    "resolve_pms",
    "sync_type_label",
]
