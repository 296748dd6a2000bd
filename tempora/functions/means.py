"""Mean expressions.

``mean(c)`` is the reference's ``round(avg(c), 2)``. ``mean(c, exact=True)``
is the same figure computed exactly: every value becomes an integer number of
``10^-scale`` units (HALF_UP), the units are summed in integer arithmetic and
only the per-group result is divided and rounded (HALF_UP) in decimals. The
sum does not depend on the order in which partitions are combined, so reruns,
partition counts and an independent SQL engine all agree to the last cent.

A group in which a value is not finite, carries more than ``scale`` decimals or
is too large for a double to hold them falls back to the plain mean: such a
value is never rounded or replaced on the way into a sum.

The hot path is two ``long`` sums per value (codegen'd hash aggregation, no
``Decimal`` objects). Units are split into a high part (``units >> 20``) and a
low part (the low 20 bits), so neither sum can overflow before about 10^13
rows in one group; the recombination per group is a ``decimal(24,0)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tempora.functions.parsing import as_column

_SPLIT_BITS = 20


def units(col, scale: int = 2) -> Column:
    """``col`` in integer units of ``10^-scale``, rounded half away from zero."""
    x = as_column(col) * F.lit(float(10**scale))
    return F.when(x < 0, -F.floor(-x + F.lit(0.5))).otherwise(F.floor(x + F.lit(0.5))).cast("long")


def fits_units(col, scale: int = 2) -> Column:
    """Whether ``col`` is a whole number of units, as far as a double can tell
    (null is not; nor is NaN, an infinity or a value of 2^53 units and more)."""
    x = as_column(col).cast("double") * F.lit(float(10**scale))
    near = F.abs(x - F.rint(x)) <= F.lit(1e-6) + F.abs(x) * F.lit(1e-13)
    return F.coalesce((F.abs(x) < F.lit(float(1 << 53))) & near & ~F.isnan(x), F.lit(False))


def exact_sum_units(col, scale: int = 2) -> Column:
    """Aggregate: exact sum of ``units(col)`` as ``decimal(24,0)``; null when no value."""
    u = units(col, scale)
    hi = F.sum(F.shiftright(u, _SPLIT_BITS))
    lo = F.sum(u.bitwiseAND(F.lit((1 << _SPLIT_BITS) - 1)))
    total = hi.cast("decimal(24,0)") * F.lit(1 << _SPLIT_BITS).cast("decimal(8,0)") + lo.cast("decimal(24,0)")
    return total.cast("decimal(24,0)")


def mean(col, decimals: int | None = 2, exact: bool = False, scale: int = 2) -> Column:
    """Mean of ``col`` rounded HALF_UP to ``decimals`` (None: unrounded, one
    division of the exact sum by the count).

    Nulls are skipped. ``exact=True`` uses integer unit sums (see module doc);
    ``decimals`` must then be at most ``scale``."""
    c = as_column(col)
    avg = F.avg(c)
    plain = avg if decimals is None else F.round(avg, decimals)
    if not exact:
        return plain
    if decimals is not None and decimals > scale:
        raise ValueError("decimals must not exceed scale for the exact mean")
    fits = fits_units(c, scale)
    n = F.count(c)
    total = exact_sum_units(F.when(fits, c), scale)
    if decimals is None:
        value = total.cast("double") / (n * F.lit(10**scale)).cast("double")
    else:  # decimal(38,14): exact to 14 places in units
        value = F.round(total / n, decimals - scale).cast("double") / F.lit(float(10**scale))
    return F.when(F.count_if(fits) == n, F.when(n > 0, value)).otherwise(plain)
