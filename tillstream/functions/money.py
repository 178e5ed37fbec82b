"""Amounts, exact means and ratios.

Totals stay decimal and a mean is rounded once, half away from zero, so results do not
depend on how Spark split the rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Freight is this share of the price.
FREIGHT_SHARE = "0.1"


def line_revenue(price: Column | None = None, quantity: Column | None = None) -> Column:
    price = F.col("price") if price is None else price
    quantity = F.col("quantity") if quantity is None else quantity
    return price * quantity


def freight(price: Column) -> Column:
    return F.round(price * F.lit(FREIGHT_SHARE).cast("decimal(2,1)"), 2)


def exact_mean(total: Column, count: Column, digits: int, total_type: str = "decimal(30,2)") -> Column:
    """round(total / count, digits), half away from zero, NULL when count is 0.

    Decided on whole numbers, so it is exact for any count: a decimal quotient would be
    rounded to the digits that its type leaves it before it is rounded here.
    """
    scale = int(total_type.rstrip(")").rpartition(",")[2])
    whole = lambda c: c.cast("decimal(38,0)")
    power = lambda k: F.lit(10**k).cast("decimal(20,0)")
    parts = whole(F.abs(total.cast(total_type)) * power(scale)) * power(digits)
    each = whole(F.nullif(count, F.lit(0))) * power(scale)
    top, bottom = whole(parts * 2 + each), whole(each * 2)
    rounded = ((top - top % bottom) / bottom).cast("decimal(28,0)")
    value = (rounded / power(digits)).cast(f"decimal(30,{digits})")
    return F.when(total < 0, -value).otherwise(value)


def mean_of(value: Column, digits: int, scale: int = 0) -> Column:
    """Aggregate: exact mean of a numeric column with `scale` decimals, ignoring NULLs."""
    exact = value.cast(f"decimal(20,{scale})")
    return exact_mean(F.sum(exact), F.count(exact), digits, f"decimal(30,{scale})")


def percentage(part: Column, whole: Column) -> Column:
    """100 * part / whole with two digits, NULL when whole is 0."""
    hundredfold = part.cast("decimal(20,0)") * F.lit(100)
    return F.round(hundredfold.cast("decimal(20,0)") / F.nullif(whole, F.lit(0)), 2)


def share_text(part: Column, whole: Column) -> Column:
    """The ratio in percent with one digit, as C's and Python's '%.1f' print it.

    Java's formatter rounds the shortest decimal form of a double; '%.1f' rounds its
    exact binary value, ties to even.  To decide on the exact value, the double is
    split into two halves whose twentyfold is exact, and compared with the odd
    multiple of 0.05 between the two neighbouring tenths.
    """
    percent = (part.cast("double") / F.greatest(whole, F.lit(1)).cast("double")) * F.lit(100.0)
    below = F.floor(percent * 10)
    scaled = percent * F.lit(134217729.0)
    high = scaled - (scaled - percent)
    low = percent - high
    over = (high * 20 - (below * 2 + 1).cast("double")) + low * 20
    up = (over > 0) | ((over == 0) & (below % 2 == 1))
    tenths = below + F.when(up, 1).otherwise(0)
    return F.concat(
        F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string")
    )
