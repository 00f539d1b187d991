"""Day arithmetic with the two meanings the analyses use.

* ``whole_days_between``: complete 24-hour units between two timestamps
  (BigQuery ``TIMESTAMP_DIFF(a, b, DAY)``).  23:00 Jan 1 -> 01:00 Jan 3 is 1.
* ``calendar_days_between``: difference of the calendar dates
  (``DATE_DIFF`` on dates, MySQL ``DATEDIFF``).  The same pair gives 2.

Both stay JVM-side built-ins, so they run inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def whole_days_between(end, start) -> Column:
    """Whole 24-hour days from ``start`` to ``end`` (bigint, negative if reversed)."""
    return F.timestamp_diff("DAY", _c(start), _c(end))


def calendar_days_between(end, start) -> Column:
    """Calendar-date difference ``date(end) - date(start)`` as bigint."""
    return F.datediff(_c(end), _c(start)).cast("bigint")


def add_days(ts, days) -> Column:
    """``ts`` plus ``days`` days, keeping the time of day (and the type)."""
    n = F.lit(days) if isinstance(days, int) else _c(days)
    return F.timestamp_add("DAY", n, _c(ts))


def month_label(year, month) -> Column:
    """'YYYY-MM' label of a (year, month) pair; NULL if either is NULL."""
    return F.date_format(F.make_date(_c(year), _c(month), F.lit(1)), "yyyy-MM")
