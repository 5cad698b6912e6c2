"""Tier arithmetic as column expressions (stays inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .money import as_col


def graduated_piece(qty, tier_min, tier_max, price) -> Column:
    """Amount of one tier row of a graduated waterfall.

    max(0, min(q, tier_max) - (tier_min - 1)) * price. A NULL tier_max is an
    open-ended top tier; a NULL quantity gives NULL (no silent zero).
    Computed in DECIMAL (whole units x a 4-decimal price), so sums of pieces are
    exact and independent of row order.
    """
    q, lo, hi = as_col(qty), as_col(tier_min), as_col(tier_max)
    top = F.when(hi.isNull(), q).otherwise(F.least(q, hi))
    units = F.greatest(F.lit(0), top - (lo - F.lit(1)))
    piece = units.cast("decimal(20,0)") * as_col(price).cast("decimal(18,4)")
    return F.when(q.isNull(), F.lit(None)).otherwise(piece)


def tier_reached(qty, tier_min, tier_max) -> Column:
    """True for the tier row that contains the quantity (volume / all-units pricing)."""
    q, lo, hi = as_col(qty), as_col(tier_min), as_col(tier_max)
    return (q >= lo) & (hi.isNull() | (q <= hi))
