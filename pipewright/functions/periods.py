"""Report periods.

Period bounds are parameters computed once on the driver from the report date
(they are scalars, not data). Column helpers give the same arithmetic inside a
plan. ``next_period_start`` follows the "ceiling" rule of the reports: a date
that is already the first day of a period still moves to the *next* period.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


# ---------------------------------------------------------------- driver side
def quarter_of(d: dt.date) -> int:
    return (d.month - 1) // 3 + 1


def quarter_key(d: dt.date) -> int:
    """Year-quarter as an integer key, e.g. 1998-08-15 -> 19983."""
    return d.year * 10 + quarter_of(d)


def floor_quarter(d: dt.date) -> dt.date:
    return dt.date(d.year, 3 * (quarter_of(d) - 1) + 1, 1)


def ceil_quarter(d: dt.date) -> dt.date:
    """First day of the next quarter (also for a date already on a boundary)."""
    s = floor_quarter(d)
    return dt.date(s.year + (s.month + 3 > 12), (s.month + 3 - 1) % 12 + 1, 1)


def floor_year(d: dt.date) -> dt.date:
    return dt.date(d.year, 1, 1)


def ceil_year(d: dt.date) -> dt.date:
    return dt.date(d.year + 1, 1, 1)


def quarter_label(d: dt.date) -> str:
    """'Qn-YYYY' label of the quarter holding ``d``."""
    return f"Q{quarter_of(d)}-{d.year}"


@dataclass(frozen=True)
class ReportParams:
    """All dates a report run depends on. Nothing reads the clock.

    rpt_date      date the report reflects (its quarter is "this quarter")
    anchor        snapshot date at which starting pipeline is frozen
    compare       'Y' grades owners on the prior year, 'Q' on the prior quarter
    stale_origin  date used to fill missing days-stale values
    velocity_since  earliest close date read by the time-in-stage job
    refreshed_at  text written into the report header
    """

    rpt_date: dt.date
    anchor: dt.date
    compare: str = "Y"
    stale_origin: dt.date = dt.date(2022, 2, 5)
    velocity_since: dt.date = dt.date(2022, 7, 1)
    refreshed_at: str = ""
    exclude_ids: tuple = field(default_factory=tuple)

    def __post_init__(self):
        if self.compare not in ("Y", "Q"):
            raise ValueError(f"compare must be 'Y' (prior year) or 'Q' (prior quarter), not {self.compare!r}")
        if not isinstance(self.rpt_date, dt.date) or not isinstance(self.anchor, dt.date):
            raise TypeError("rpt_date and anchor must be dates")

    # quarter of the report (movement reports)
    @property
    def q_start(self) -> dt.date:
        return floor_quarter(self.rpt_date)

    @property
    def q_end(self) -> dt.date:
        """First day of the next quarter (exclusive end)."""
        return ceil_quarter(self.rpt_date)

    @property
    def q_key(self) -> int:
        return quarter_key(self.rpt_date)

    @property
    def q_label(self) -> str:
        return quarter_label(self.rpt_date)

    # scorecard periods
    @property
    def rpt_start(self) -> dt.date:
        """Start of the prior year: first cohort date read by the scorecards."""
        return floor_year(floor_year(self.rpt_date) - dt.timedelta(days=1))

    @property
    def rpt_end(self) -> dt.date:
        """Start of the quarter after next: exclusive end of the scorecard read."""
        return ceil_quarter(ceil_quarter(self.rpt_date) + dt.timedelta(days=1))

    @property
    def past_q_start(self) -> dt.date:
        return floor_quarter(floor_quarter(self.rpt_date) - dt.timedelta(days=1))

    @property
    def past_q_end(self) -> dt.date:
        return ceil_quarter(self.past_q_start)

    @property
    def this_q_start(self) -> dt.date:
        return floor_quarter(self.rpt_date)

    @property
    def next_q_start(self) -> dt.date:
        return ceil_quarter(self.rpt_date)

    @property
    def last_year_start(self) -> dt.date:
        return self.rpt_start

    @property
    def last_year_end(self) -> dt.date:
        return ceil_year(self.rpt_start)

    @property
    def unit(self) -> tuple[dt.date, dt.date]:
        """Grading window: prior year ('Y') or prior quarter ('Q')."""
        if self.compare == "Y":
            return self.last_year_start, self.last_year_end
        return self.past_q_start, self.past_q_end

    def periods(self) -> dict[str, tuple[dt.date, dt.date]]:
        """Both scorecard windows, keyed by their label."""
        return {"Y": (self.last_year_start, self.last_year_end),
                "Q": (self.past_q_start, self.past_q_end)}


# ----------------------------------------------------------------- plan side
def col_quarter_key(c: Column) -> Column:
    return F.year(c) * 10 + F.quarter(c)


def col_floor_quarter(c: Column) -> Column:
    return F.trunc(c, "quarter")


def col_ceil_quarter(c: Column) -> Column:
    return F.add_months(F.trunc(c, "quarter"), 3)


def col_floor_year(c: Column) -> Column:
    return F.trunc(c, "year")


def col_ceil_year(c: Column) -> Column:
    return F.add_months(F.trunc(c, "year"), 12)


def col_quarter_label(c: Column) -> Column:
    return F.format_string("Q%d-%d", F.quarter(c), F.year(c))


def in_window(c: Column, start: dt.date, end: dt.date) -> Column:
    """Half-open ``start <= c < end``."""
    return (c >= F.lit(start)) & (c < F.lit(end))


def col_shard_suffix(c: Column) -> Column:
    """'YYYYMMDD' text of a date (the day suffix of a per-day table name)."""
    return F.date_format(c, "yyyyMMdd")


def col_in_zone(ts_utc: Column, tz: str) -> Column:
    """A UTC timestamp shown as wall-clock time in zone ``tz``."""
    return F.from_utc_timestamp(ts_utc, tz)
