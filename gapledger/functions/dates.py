"""Date and time-range expressions.

Inputs are ``timestamp_ntz``; every expression here is zone-free (dates are
taken with ``to_date``, not through the session zone).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Period names accepted by ``period``; the value is the ``trunc`` format.
PERIODS = {"day": None, "week": "week", "month": "month", "quarter": "quarter", "year": "year"}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _unit(period: str) -> str:
    p = period.lower()
    if p not in PERIODS:
        raise ValueError(f"unknown period {period!r}; use one of {sorted(PERIODS)}")
    return p


def period(c, unit: str = "month") -> Column:
    """``date_trunc(unit, ts)::date`` (F8)."""
    u = _unit(unit)
    d = F.to_date(_col(c))
    return d if u == "day" else F.trunc(d, PERIODS[u])


def previous_period(start, unit: str = "month") -> Column:
    """Start of the period before the one that starts on ``start``."""
    u = _unit(unit)
    if u in ("day", "week"):
        return F.date_sub(_col(start), 1 if u == "day" else 7)
    return F.add_months(_col(start), {"month": -1, "quarter": -3, "year": -12}[u])


def month_of_year(c) -> Column:
    """``date_part(month, ts)``: months of different years fall together."""
    return F.month(_col(c))


def month_diff(a, b) -> Column:
    """Month boundaries crossed from ``a`` to ``b`` (F13), not whole months."""
    a, b = F.to_date(_col(a)), F.to_date(_col(b))
    return (F.year(b) * 12 + F.month(b)) - (F.year(a) * 12 + F.month(a))


def day_diff(a, b) -> Column:
    """Calendar days from ``a`` to ``b``."""
    return F.datediff(F.to_date(_col(b)), F.to_date(_col(a)))


def interval_part(part: str, start, end) -> Column:
    """``extract(part FROM (end - start))``: the component, not the total."""
    s, e = _col(start), _col(end)
    return F.extract(F.lit(part.upper()), e - s).cast("bigint")


def ts_lit(value) -> Column:
    """Zone-less timestamp literal; folds to a constant that reaches the
    parquet reader as a pushed filter."""
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    elif isinstance(value, dt.date):
        value = value.isoformat()
    return F.lit(str(value)).cast("timestamp_ntz")


def half_open(c, start=None, end=None) -> Column:
    """``start <= c < end``; a missing bound is unbounded."""
    col = _col(c)
    cond = F.lit(True)
    if start is not None:
        cond = cond & (col >= ts_lit(start))
    if end is not None:
        cond = cond & (col < ts_lit(end))
    return cond


def closed_range(c, start=None, end=None) -> Column:
    """``start <= c <= end`` (P9): a midnight upper bound loses the last day."""
    col = _col(c)
    cond = F.lit(True)
    if start is not None:
        cond = cond & (col >= ts_lit(start))
    if end is not None:
        cond = cond & (col <= ts_lit(end))
    return cond


def open_range(c, start=None, end=None) -> Column:
    """``start < c < end`` (P10)."""
    col = _col(c)
    cond = F.lit(True)
    if start is not None:
        cond = cond & (col > ts_lit(start))
    if end is not None:
        cond = cond & (col < ts_lit(end))
    return cond


def _as_datetime(v) -> dt.datetime:
    if isinstance(v, dt.datetime):
        return v
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day)
    return dt.datetime.fromisoformat(str(v))


def period_ceil(v, unit: str) -> dt.datetime:
    """First period start at or after ``v``."""
    u = _unit(unit)
    t = _as_datetime(v)
    day = dt.datetime(t.year, t.month, t.day)
    if u == "day":
        start = day
        nxt = day + dt.timedelta(days=1)
    elif u == "week":
        start = day - dt.timedelta(days=day.weekday())
        nxt = start + dt.timedelta(days=7)
    elif u == "month":
        start = dt.datetime(t.year, t.month, 1)
        nxt = dt.datetime(t.year + (t.month == 12), t.month % 12 + 1, 1)
    elif u == "quarter":
        m0 = 3 * ((t.month - 1) // 3) + 1
        start = dt.datetime(t.year, m0, 1)
        nxt = dt.datetime(t.year + (m0 == 10), (m0 + 2) % 12 + 1, 1)
    else:
        start = dt.datetime(t.year, 1, 1)
        nxt = dt.datetime(t.year + 1, 1, 1)
    return t if t == start else nxt


def period_in_range(c, unit: str, start=None, end=None) -> Column:
    """``start <= trunc(unit, c) < end`` written as a raw range on ``c``.

    ``trunc(c) >= a`` holds exactly when ``c >= ceil(a)``, and
    ``trunc(c) < b`` exactly when ``c < ceil(b)``, so the filter stays on the
    stored column and is pushed to the parquet reader.
    """
    return half_open(
        c,
        None if start is None else period_ceil(start, unit),
        None if end is None else period_ceil(end, unit),
    )


def shift_months(v, n: int) -> dt.date:
    """Python-side bound shift by whole months (F15): 2018-08-01 -> 2018-09-01."""
    t = _as_datetime(v)
    m = t.month - 1 + n
    y, m = t.year + m // 12, m % 12 + 1
    import calendar

    d = min(t.day, calendar.monthrange(y, m)[1])
    return dt.date(y, m, d)
