"""Run-date arithmetic, done on the driver so bounds reach the scan as literals."""

from __future__ import annotations

import datetime as dt


def as_date(d) -> dt.date:
    if isinstance(d, dt.datetime):
        return d.date()
    if isinstance(d, dt.date):
        return d
    return dt.date.fromisoformat(str(d))


def month_start(d: dt.date) -> dt.date:
    return d.replace(day=1)


def prev_month_start(d: dt.date) -> dt.date:
    first = d.replace(day=1)
    return (first - dt.timedelta(days=1)).replace(day=1)


def billing_window(as_of) -> tuple[dt.date, dt.date]:
    """Peak window: the 2nd of the month up to the run date.

    On the 1st the previous month is settled, so the window is the 2nd of the
    previous month up to the run date.
    """
    d = as_date(as_of)
    start = prev_month_start(d) if d.day == 1 else month_start(d)
    return start + dt.timedelta(days=1), d


def bridge_anchors(as_of) -> tuple[dt.date, dt.date]:
    """(prior, current) snapshot dates of the recurring-revenue bridge."""
    d = as_date(as_of)
    prior = prev_month_start(d) if d.day == 1 else month_start(d)
    return prior, d


def sql_date(d) -> str:
    return f"DATE '{as_date(d).isoformat()}'"
