"""Rounding, guarded division and exact sums as Column expressions.

Two rules keep results independent of how rows are spread over tasks:

* a figure is rounded through ``DECIMAL(28,8)``, so 0.285 rounds to 0.29 and binary noise in the
  last digits does not decide a tie;
* a floating column is summed as decimals wider than the data, so partial sums can be merged in any
  order and the total is the same.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EXACT_MONEY, _EXACT_RATE = "decimal(28,6)", "decimal(28,12)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: Column | str, digits: int) -> Column:
    """Decimal half-up rounding, back to double."""
    return F.round(_col(c).cast("decimal(28,8)"), digits).cast("double")


def round_half_even(c: Column | str, digits: int) -> Column:
    """Array-library rounding: scale, round half to even, scale back."""
    scale = float(10 ** digits)
    return F.rint(_col(c) * F.lit(scale)) / F.lit(scale)


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient that is NULL, not an error, when the denominator is zero."""
    return F.try_divide(_col(numerator), _col(denominator))


def clamp(c: Column | str, low, high) -> Column:
    """Value limited to [low, high]; NULL stays NULL."""
    c = _col(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def money_total(c: Column | str) -> Column:
    """Exact sum of a money column, as double; values that are no finite number are left out."""
    return F.sum(_col(c).try_cast(_EXACT_MONEY)).cast("double")


def money_mean(c: Column | str) -> Column:
    return money_total(c) / F.count(_col(c).try_cast(_EXACT_MONEY))


def rate_mean(c: Column | str) -> Column:
    """Order-independent mean of a rate, ratio or score column; no finite number, no part in it."""
    exact = _col(c).try_cast(_EXACT_RATE)
    return F.sum(exact).cast("double") / F.count(exact)


def percent_of_rows(flag: Column | str) -> Column:
    """Mean of a 0/1 column in percent, unrounded."""
    return F.avg(_col(flag)) * 100


def correlation(x: Column | str, y: Column | str) -> Column:
    """Pearson correlation over rows with both values; NULL, not an error, for a constant column."""
    x, y = _col(x).cast("double"), _col(y).cast("double")
    paired_x, paired_y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return ratio(F.covar_pop(x, y), F.stddev_pop(paired_x) * F.stddev_pop(paired_y))


def order_key(c: Column | str) -> Column:
    """A bigint that orders doubles as they are ordered: the bits of the number, negated below zero.

    Distinct numbers have distinct keys, whatever their size; both zeros have key 0, NaN the greatest.
    Spark has no function for the bits, so they are computed from exponent and mantissa, exactly.
    """
    value = _col(c).cast("double")
    size = F.abs(value)
    # the logarithm may round across a power of two: then the mantissa tells
    rough = F.floor(F.log2(size)).cast("int")
    rough = F.least(F.greatest(rough, F.lit(-1022)), F.lit(1023))
    scaled = size * F.pow(F.lit(2.0), -rough)
    exponent = rough + F.when(scaled >= 2, 1).when((scaled < 1) & (rough > -1022), -1).otherwise(0)
    mantissa = size * F.pow(F.lit(2.0), -exponent)
    normal = F.shiftleft((exponent + 1022).cast("bigint"), 52) + (mantissa * F.lit(float(2 ** 52))).cast("bigint")
    infinite = F.lit(2047 << 52).cast("bigint")
    bits = (F.when(F.isnan(value), infinite + 1).when(size == 0, F.lit(0).cast("bigint"))
            .when(size == float("inf"), infinite).otherwise(normal))
    return F.when(value < 0, -bits).otherwise(bits)
