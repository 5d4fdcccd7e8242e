"""Closed vocabularies of the column contract."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The contract vocabulary, weakest to strictest.
CLASSIFICATIONS = ("Official-Open", "Official-Closed", "Restricted", "Confidential")
SENSITIVITIES = ("NA", "Sensitive-Normal", "Sensitive-High")
NEEDS_MASK = ("Restricted", "Confidential")


def in_vocabulary(col: Column, values) -> Column:
    """True when the value is one of `values`; a null value is not."""
    return F.coalesce(col.isin(*values), F.lit(False))


def strictest(values, order) -> str | None:
    """The last of `values` in `order`; None when there is nothing to compare."""
    known = [v for v in values if v in order]
    return max(known, key=order.index) if known else None
