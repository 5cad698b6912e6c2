"""The scheduled daily run: every billing output for one run date, written day-replaced.

``run_day`` is what a scheduler calls once a day (or for a backfill date). Each
output table is partitioned by its date column and only that day's partition
is replaced, so re-running a day is idempotent and other days stay untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import sinks
from . import daily_bill as B

def outputs(d: B.Domain, as_of=None) -> dict[str, tuple[DataFrame, str]]:
    """Output name -> (DataFrame, date column) for one run date."""
    as_of = as_of or d.as_of
    out = {
        "root_itemized": (B.itemized(d, as_of), "billing_date"),
        "subtenant_itemized": (B.subtenant_itemized(d, as_of), "billing_date"),
        "peak_rows": (B.peak_rows(d, as_of), "date_recorded"),
        "mailbox": (B.mailbox_mart(d, as_of), "record_date"),          # all regions, a folder each
    }
    return out


def run_day(d: B.Domain, out_dir: str, as_of=None) -> dict[str, str]:
    """Compute and write every output of the day; returns name -> path."""
    from ..functions.dates import as_date
    day = as_date(as_of or d.as_of)
    d = d.at(day)
    # a bill from no snapshot would be minimum commitments only: refuse, and leave the day's outputs as they are
    if d.meta.isEmpty():
        raise ValueError(f"no account snapshot for {day}")
    if B.peak_rows(d, day).isEmpty():
        raise ValueError(f"no tenant snapshot in the billing window of {day}")
    paths = {}
    for name, (df, date_col) in outputs(d, day).items():
        path = f"{out_dir.rstrip('/')}/{name}"
        sinks.write_day(df, path, date_col=date_col, days=[day], within="region" if name == "mailbox" else None)
        paths[name] = path
    return paths
