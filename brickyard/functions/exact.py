"""Exact numeric helpers.

Money is carried as integer cents and every ratio that the output rounds is
computed as a HALF_UP quotient of integers, so results do not depend on the
order in which partitions were summed.  Doubles appear only at the very end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DEC = "decimal(20,0)"


def cents(col: Column) -> Column:
    """A money column (double or decimal with 2 dp) as integer cents."""
    return (col.cast("decimal(14,2)") * 100).cast("long")


def half_up(num: Column, den: Column, scale: int, wide: bool = False) -> Column:
    """HALF_UP(num / den) at ``scale`` decimals as double; NULL when den = 0.

    ``wide`` admits 38-digit operands (the quotient is then exact to 6 dp).
    """
    dec = "decimal(38,0)" if wide else _DEC
    q = F.round(num.cast(dec) / den.cast(dec), scale)
    return F.when(den != 0, q.cast("double"))


def half_up_int(num: Column, den: Column) -> Column:
    """HALF_UP(num / den) as a long; NULL when den = 0."""
    q = F.round(num.cast(_DEC) / den.cast(_DEC), 0)
    return F.when(den != 0, q.cast("long"))


def ratio(num: Column, den: Column) -> Column:
    """Plain double quotient of two exact integers (same IEEE ops as the oracle)."""
    return F.when(den != 0, num.cast("double") / den.cast("double"))


def stddev_exact(n: Column, s1: Column, s2: Column, unit: float = 1.0) -> Column:
    """Sample standard deviation from exact count, sum and sum of squares.

    ``unit`` rescales integer units back to the value scale (e.g. 100 for cents).
    NULL for n < 2 like STDDEV_SAMP.  n·Σx² − (Σx)² is taken as
    n·(Σx² − q·Σx) − r·Σx with Σx = q·n + r, the same integer without the two
    large products, so that 1e11 rows of £1m sales stay within 38 digits.
    """
    wide = lambda x: x.cast("decimal(38,0)")
    q = F.call_function("div", wide(s1), wide(F.greatest(n, F.lit(1))))
    r = (wide(s1) - wide(wide(q) * wide(n))).cast("decimal(18,0)")
    num = wide(wide(n) * wide(wide(s2) - wide(wide(q) * wide(s1)))) - wide(r * s1.cast("decimal(20,0)"))
    den = wide(n) * wide(n - 1)
    var = num.cast("double") / den.cast("double")
    return F.when(n > 1, F.sqrt(var) / F.lit(float(unit)))


def half_up_dec(num: Column, den: Column, scale: int) -> Column:
    """HALF_UP(num / den) at ``scale`` decimals kept as an exact decimal."""
    q = F.round(num.cast(_DEC) / den.cast(_DEC), scale).cast(f"decimal(30,{scale})")
    return F.when(den != 0, q)
