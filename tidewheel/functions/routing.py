"""Stable assignment of ids to variants, and the price rule applied to predictions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Commission rate and price precision.
COMMISSION = 1.05
PRICE_DIGITS = 2


def adjust_price(price: Column) -> Column:
    """Prediction with commission, to two digits (half up on the decimal form)."""
    return F.round(price * F.lit(COMMISSION), PRICE_DIGITS)


def ab_variant(identifier: Column) -> Column:
    """Odd MD5 digest goes to A, even to B. A missing id hashes as the empty string."""
    digest = F.md5(F.coalesce(identifier.cast("string"), F.lit("")))
    last_digit = F.conv(F.substring(digest, 32, 1), 16, 10).cast("int")
    return F.when(last_digit % 2 == 1, F.lit("A")).otherwise(F.lit("B"))


def percentile_slot(identifier: Column) -> Column:
    """Stable slot 0..99 out of the first eight digest digits."""
    digest = F.md5(F.coalesce(identifier.cast("string"), F.lit("")))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100).cast("int")


def weighted_route(identifier: Column, shares: list[tuple[str, int]]) -> Column:
    """Route an id to one of several versions by percentage shares that add up to 100."""
    if sum(share for _, share in shares) != 100:
        raise ValueError("traffic shares must add up to 100")
    slot, upper, route = percentile_slot(identifier), 0, None
    for version, share in shares:
        upper += share
        test = slot < upper
        route = F.when(test, F.lit(version)) if route is None else route.when(test, F.lit(version))
    return route
