"""Exact, order-independent sums of doubles.

A double sum depends on the order of its terms, so the same data summed under
another partitioning can differ in the last bits.  Terms are summed as
DECIMAL(34,16), which holds the shortest decimal form of a double from 1e-16 up
to 1e18 (every digit of it from about 1 on), into DECIMAL(38,16): identical for
any order, and no limit short of 1e22.  Beside it runs the plain double sum.
What the decimal cannot hold (NaN, infinities, terms or totals beyond its
range) is not lost: the plain sum is the result then.

A sum is carried as three columns so that partial sums add up again:
``<name>_exact``, ``<name>_plain`` and ``<name>_odd`` (terms beyond decimal).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TERM, TERM_LIMIT = "decimal(34,16)", 1e18
#: Type of a term's multiplier: a term times it is DECIMAL(38,16).
TIMES = "decimal(3,0)"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parts(name: str) -> list[str]:
    """The columns a sum is carried in."""
    return [f"{name}_exact", f"{name}_plain", f"{name}_odd"]


def sum_terms(x, name: str, times: Column | None = None) -> list[Column]:
    """Aggregates of ``x``, each term ``times`` over (an integer below 1000)."""
    x = _c(x)
    fine = F.abs(x) < TERM_LIMIT  # NaN is above every number
    term, plain = F.when(fine, x).cast(TERM), x
    if times is not None:
        term, plain = term * times.cast(TIMES), x * times
    odd = F.count(F.when(x.isNotNull() & ~fine, 1))
    return [c.alias(n) for c, n in zip((F.try_sum(term), F.sum(plain), odd), parts(name))]


def sum_parts(name: str) -> list[Column]:
    """Aggregates of sums carried by :func:`sum_terms`."""
    exact, plain, odd = parts(name)
    # a part that its decimal could not hold must not leave the total short
    lost = F.when(F.col(exact).isNull() & F.col(plain).isNotNull(), 1).otherwise(0)
    return [F.try_sum(exact).alias(exact), F.sum(plain).alias(plain), F.sum(F.col(odd) + lost).alias(odd)]


def value(name: str) -> Column:
    """The sum as a double; NULL when there was no term."""
    exact, plain, odd = (F.col(c) for c in parts(name))
    return F.when(F.coalesce(odd, F.lit(0)) == 0, F.coalesce(exact.cast("double"), plain)).otherwise(plain)


def exact_sum(x) -> Column:
    """``sum(x)`` of a double column in one aggregation."""
    x = _c(x)
    fine = F.abs(x) < TERM_LIMIT
    odd = F.count(F.when(x.isNotNull() & ~fine, 1))
    exact = F.try_sum(F.when(fine, x).cast(TERM)).cast("double")
    return F.when(odd == 0, F.coalesce(exact, F.sum(x))).otherwise(F.sum(x))
