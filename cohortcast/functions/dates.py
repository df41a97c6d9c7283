"""Date expressions of the cohort model, all native Spark columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortcast import params as P


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def day_diff(start, end) -> Column:
    """Whole days from ``start`` to ``end`` (``DATEDIFF(day, start, end)``)."""
    return F.datediff(_c(end), _c(start))


def increment_bucket(day, signup_date, width: int = P.INCREMENT_DAYS) -> Column:
    """Cohort age bucket: day difference divided by ``width`` truncating toward
    zero, plus one.  Days up to ``width - 1`` before sign-up land in bucket 1,
    and ``-width`` lands in bucket 0 (``div``, not ``floor``)."""
    return (day_diff(signup_date, day) / F.lit(width)).cast("long") + 1


def cohort_month(signup_month, increment) -> Column:
    """Calendar month of a bucket: sign-up month + (increment - 1) months."""
    return F.add_months(_c(signup_month), (_c(increment) - 1).cast("int"))


def month_start(d) -> Column:
    return F.trunc(_c(d), "MM")


def months_between_inclusive(later, earlier) -> Column:
    """Whole calendar months from ``earlier`` to ``later``, plus one."""
    later, earlier = _c(later), _c(earlier)
    return ((F.year(later) - F.year(earlier)) * 12
            + (F.month(later) - F.month(earlier)) + 1).cast("long")


def signup_month_of(month, increment) -> Column:
    """Inverse of :func:`cohort_month`: month - (increment - 1) months."""
    return F.add_months(_c(month), (1 - _c(increment)).cast("int"))


def parse_month(text) -> Column:
    """'Sep-2023' -> 2023-09-01 (any letter case); NULL when unparseable."""
    return F.try_to_date(_c(text), "MMM-yyyy")


def scenario_actual_month(scenario, stamp) -> Column:
    """Last month of actuals of a snapshot: the number of actual months written
    as '(A+F)' in the snapshot name, in the year of the snapshot's timestamp.
    'Sep-24 Forecast (8+4)' edited in 2024 -> 2024-08-01."""
    months = F.regexp_extract(_c(scenario), r"\((\d+)\+", 1)
    text = F.concat(F.year(_c(stamp)).cast("string"), F.lit("-"), months)
    return F.try_to_date(text, "yyyy-M")


def since_literal(since: dt.date | str) -> Column:
    return F.lit(since).cast("date")
