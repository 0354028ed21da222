"""What counts as a price."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def usable(price: Column) -> Column:
    """A finite price above 0; NULL and NaN are none. Nothing is bought, sold or
    valued at any other price."""
    return F.coalesce((price > 0) & (price < float("inf")), F.lit(False))
