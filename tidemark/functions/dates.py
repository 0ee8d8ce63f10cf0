"""Month arithmetic on snapshot dates."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.rules import TrainingWindow


def month_start(c: Column) -> Column:
    return F.trunc(c, "MM")


def month_index(c: Column) -> Column:
    """Months since year 0: consecutive months differ by exactly one."""
    return F.year(c) * 12 + F.month(c)


def period_month(c: Column) -> Column:
    """'YYYY-MM' of the month before the snapshot: the month the snapshot reports on."""
    return F.date_format(F.add_months(c, -1), "yyyy-MM")


def performance_period(c: Column, label_shift: int = 6) -> Column:
    """'YYYY-MM' in which the outcome of a score made at `c` is known."""
    return F.date_format(F.add_months(c, label_shift - 1), "yyyy-MM")


def reference_months(c: Column) -> Column:
    """The two months before a model's date, oldest first."""
    return F.array(F.add_months(c, -2), F.add_months(c, -1))


def name_date(c: Column) -> Column:
    """Date at the end of names such as model_x_2024_07_01[.ext]."""
    text = F.regexp_extract(c, r"_(\d{4}_\d{2}_\d{2})(\.[A-Za-z]+)?$", 1)
    return F.try_to_date(F.nullif(text, F.lit("")), "yyyy_MM_dd")


def name_family(c: Column) -> Column:
    """What precedes that date: the model family."""
    return F.regexp_extract(c, r"^(.*)_\d{4}_\d{2}_\d{2}(\.[A-Za-z]+)?$", 1)


def shift_months(day: dt.date, months: int) -> dt.date:
    """Plain-date twin of add_months for literals; clamps to the month's last day."""
    index = day.year * 12 + day.month - 1 + months
    year, month = divmod(index, 12)
    first_of_next = dt.date(year + (month == 11), (month + 1) % 12 + 1, 1)
    last_day = (first_of_next - dt.timedelta(days=1)).day
    return dt.date(year, month + 1, min(day.day, last_day))


@dataclass(frozen=True)
class SplitDates:
    train_start: dt.date
    train_end: dt.date
    oot_start: dt.date
    oot_end: dt.date


def split_dates(train_date: dt.date, window: TrainingWindow = TrainingWindow()) -> SplitDates:
    """Inclusive date windows: out-of-time months end the day before `train_date`."""
    oot_start = shift_months(train_date, -window.oot_months)
    one_day = dt.timedelta(days=1)
    return SplitDates(
        train_start=shift_months(oot_start, -window.train_test_months),
        train_end=oot_start - one_day,
        oot_start=oot_start,
        oot_end=train_date - one_day,
    )
