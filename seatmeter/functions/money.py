"""Money and ratio helpers.

Sums run over DECIMAL so totals do not depend on row order; per-row ratios run
in DOUBLE and are rounded once, at the edge, through DECIMAL(38,10).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """Round to 4 decimals and return DOUBLE (the output type of every amount)."""
    return F.round(as_col(c).cast("decimal(38,10)"), 4).cast("double")


def dec(c) -> Column:
    """Amount as DECIMAL(18,4), the type summed over."""
    return F.round(as_col(c).cast("decimal(38,10)"), 4).cast(MONEY)


def money_sum(c) -> Column:
    """Order-independent sum of amounts, returned as DOUBLE."""
    return F.sum(dec(c)).cast("double")


def safe_div(num, den) -> Column:
    """num / den in DOUBLE; NULL when den is 0 or NULL (ANSI-safe)."""
    den = as_col(den)
    return F.when(den.isNull() | (den == 0), F.lit(None)).otherwise(as_col(num).cast("double") / den.cast("double"))


def share_of(part, whole, amount) -> Column:
    """Proportional allocation: part / whole * amount, 0 when the whole is 0 or NULL."""
    whole = as_col(whole)
    return F.when(whole.isNull() | (whole == 0), F.lit(0.0)).otherwise(
        as_col(part).cast("double") / whole.cast("double") * as_col(amount).cast("double")
    )
