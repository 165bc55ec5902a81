"""NaN-aware numeric helpers.

Readings are DOUBLE because the feed carries NaN and Spark DECIMAL cannot hold it. Rounding
and averaging are done in DECIMAL so .xx5 ties round half away from zero exactly as the
reference's NUMERIC does; NaN is carried alongside as a flag and compared by the Postgres
rule (NaN equals NaN and sorts above every number).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(28,10)"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nullif_nan(c: str | Column) -> Column:
    """``nullif(value, 'NaN')``."""
    c = col_(c)
    return F.when(~F.isnan(c), c)


def is_nan(c: str | Column) -> Column:
    """True for NaN, False for a number, NULL for NULL."""
    c = col_(c)
    return F.when(c.isNotNull(), F.isnan(c))


def exact(c: str | Column) -> Column:
    """Non-NaN double as an exact decimal; NaN and NULL become NULL."""
    return nullif_nan(c).cast(EXACT)


def round_exact(c: str | Column, dp: int = 2) -> Column:
    """Half-away-from-zero rounding of a double through DECIMAL (NaN → NULL)."""
    return F.round(exact(c), dp)


def to_double(c: str | Column) -> Column:
    return col_(c).cast("double")
