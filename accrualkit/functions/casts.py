"""Safe casts.

Event-log values are free text.  ANSI mode (the Spark 4 default) makes a
bare ``cast`` fail on the first malformed value, so every text → number
conversion goes through ``try_cast``, which yields NULL instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, StringType


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_bigint(c: str | Column) -> Column:
    """Text → BIGINT, NULL when the text is not an integer."""
    return _col(c).try_cast("bigint")


def try_int(c: str | Column) -> Column:
    """Text → INT, NULL when the text is not an integer in range."""
    return _col(c).try_cast("int")


def as_boolean(c: str | Column, dtype: DataType) -> Column:
    """Normalise a flag stored either as BOOLEAN or as text.

    Text such as 'TRUE', 'True', 'false', 't', 'no' maps case-insensitively
    to a boolean; anything else becomes NULL (and so fails any filter).
    """
    col = _col(c)
    if isinstance(dtype, BooleanType):
        return col
    if isinstance(dtype, StringType):
        return F.trim(col).try_cast("boolean")
    return col.try_cast("boolean")
