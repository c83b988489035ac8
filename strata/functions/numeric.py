"""Order-independent money arithmetic.

Floating-point sums depend on the order partial sums meet, which differs
between runs, partitionings and engines.  Money with at most six decimals is
summed as exact decimal; averages are the exact sum divided by the count;
rounding goes through decimal so a value like x.xx5 rounds half-up the same
way everywhere.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dec(c, scale: int = 6) -> Column:
    return _c(c).cast(f"decimal(38,{scale})")


_SPLIT_BITS = 20
_SPLIT_MASK = (1 << _SPLIT_BITS) - 1


def _split_parts(units: Column) -> tuple[Column, Column]:
    """Long sums of the high and low parts of integer units
    (units = hi * 2^20 + lo with 0 <= lo < 2^20)."""
    return (F.sum(F.shiftright(units, _SPLIT_BITS)), F.sum(units.bitwiseAND(F.lit(_SPLIT_MASK))))


def _total(hi: Column, lo: Column) -> Column:
    return (hi.cast("decimal(20,0)") * F.lit(1 << _SPLIT_BITS).cast("decimal(7,0)") + lo.cast("decimal(20,0)")).cast("decimal(30,0)")


def _combine_decimal(hi: Column, lo: Column, scale: int) -> Column:
    return _scaled(hi.cast("decimal(38,0)") * F.lit(1 << _SPLIT_BITS).cast("decimal(38,0)") + lo.cast("decimal(38,0)"), scale)


def _scaled(total: Column, scale: int) -> Column:
    # units * 10^-scale, exactly: a decimal multiply would fall under the
    # precision-loss rule (scale cut to 6), so the exponent is applied by the
    # string -> decimal cast (BigDecimal parsing), once per group.
    return F.concat(total.cast("string"), F.lit(f"E-{scale}")).cast(f"decimal(38,{scale})")


def _combine_double(hi: Column, lo: Column, scale: int) -> Column:
    """The double nearest to the exact total.  While the integer total is
    below 2^53 it is exact in a long and in a double, and one IEEE division
    by 10^scale is correctly rounded - the same double the exact decimal
    casts to; larger totals take the decimal path."""
    small = (F.abs(hi) < F.lit(1 << 32)) & (lo < F.lit(1 << 52))
    quick = (hi * F.lit(1 << _SPLIT_BITS) + lo).cast("double") / F.lit(float(10 ** scale))
    return F.when(small, quick).otherwise(_combine_decimal(hi, lo, scale).cast("double"))


def _units(c, scale: int) -> Column:
    return F.rint(_c(c).cast("double") * (10 ** scale)).cast("long")  # rint: no BigDecimal per row


def exact_sum(c, scale: int = 6) -> Column:
    """Exact sum of a value with at most ``scale`` decimals, as
    ``decimal(38, scale)`` (values with more decimals are first rounded to
    the nearest 10^-scale).

    Summing ``decimal(38, s)`` runs on BigDecimal (about 5x a double sum).
    Here each value becomes integer units of 10^-scale, split into a high and
    a low long, and the two longs are summed with plain long adds (partial
    sums map-side).  Neither sum can overflow below ~10^12 rows per group;
    the parts are combined once per group."""
    return _combine_decimal(*_split_parts(_units(c, scale)), scale)


def money_sum(c, scale: int = 6) -> Column:
    """Exact sum (see ``exact_sum``) returned as double: the double nearest
    to the exact decimal total, independent of how partial sums combine."""
    return _combine_double(*_split_parts(_units(c, scale)), scale)


def exact_product_sum(a, b, scale_a: int = 6, scale_b: int = 6) -> Column:
    """Exact sum of a * b where a and b carry at most ``scale_a`` /
    ``scale_b`` decimals (e.g. price x rate), as a double nearest to the
    exact total.  The units of a are split at 10^6, so that each product is a
    long up to |a| * |b| of about 9 * 10^12 (at six decimals each) and the two
    exact sums are combined once per group."""
    ua, ub = _units(a, scale_a), _units(b, scale_b)
    cut = F.lit(10 ** 6)
    low = ua % cut
    high = F.call_function("div", ua, cut)
    scale = scale_a + scale_b
    parts = [p * ub for p in (high, low)]
    wide, fine = (_total(*_split_parts(p)) for p in parts)
    return _scaled(wide * F.lit(10 ** 6).cast("decimal(7,0)") + fine, scale).cast("double")


def exact_avg(c, scale: int = 6) -> Column:
    """Exact decimal sum / count, as double (null on no rows)."""
    return money_sum(c, scale) / F.count(_c(c))


def round_half_up(c, places: int) -> Column:
    """Round through decimal(38,10): half-up on the decimal value."""
    return F.round(_c(c).cast("decimal(38,10)"), places).cast("double")


def cents(c) -> Column:
    """A money value with two decimals as exact integer cents."""
    return F.round(_c(c) * 100).cast("long")


def div_half_up(num: str, den: str) -> Column:
    """Exact integer ``num / den`` (den > 0) rounded half away from zero,
    in long arithmetic (``div``), so no floating-point tie can flip it."""
    return F.expr(f"CASE WHEN {num} < 0 THEN -((abs({num}) * 2 + {den}) div ({den} * 2)) "
                  f"ELSE ({num} * 2 + {den}) div ({den} * 2) END")
