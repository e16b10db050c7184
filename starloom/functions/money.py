"""Exact money arithmetic.

Amounts arrive as doubles with two decimals. They are turned into whole
ten-thousandths once per row (plain long arithmetic) and summed as decimals,
so sums do not depend on row order and cannot overflow.
"""

from pyspark.sql import Column, functions as F


def hundredths(c) -> Column:
    """A two-decimal double as a whole number of hundredths."""
    return F.rint(F.col(c) * 100).cast("long")


def net_units(price="l_extendedprice", discount="l_discount") -> Column:
    """``price * (1 - discount)`` in ten-thousandths, ready to be summed."""
    return (hundredths(price) * (100 - hundredths(discount))).cast("decimal(18,0)")


def units_to_money(total: Column) -> Column:
    """A sum of ten-thousandths as money rounded to cents."""
    return F.round(total * F.lit("0.0001").cast("decimal(4,4)"), 2).cast("double")


def cents_to_money(total: Column) -> Column:
    """A sum of hundredths as money."""
    return F.round(total * F.lit("0.01").cast("decimal(3,2)"), 2).cast("double")
