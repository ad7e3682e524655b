"""Calendar expressions. All stay in the JVM; none is a Python UDF."""

from __future__ import annotations

import math
from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the layout of timestamps in the raw files, as a regular expression.
TIMESTAMP_LAYOUT = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"

# Weekday names in report order.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

# More days than there are between the years 1 and 9999.
BEYOND_ANY_GAP = 4_000_000

# Days from 1970-01-01 to the first Monday.
FIRST_MONDAY = 4

MICROS_PER_DAY = 24 * 60 * 60 * 1_000_000


def lenient_timestamp(text: Column, layout: str = TIMESTAMP_LAYOUT) -> Column:
    """Parse text of one layout; any other text, and impossible dates, become null."""
    return F.when(text.rlike(layout), text.try_cast("timestamp_ntz"))


def week_ending_monday(ts: Column) -> Column:
    """Label of the week that runs from Tuesday to the end of Monday: that Monday, 00:00."""
    return F.next_day(F.date_sub(F.to_date(ts), 1), "MON").cast("timestamp_ntz")


def week_number(label: Column) -> Column:
    """Whole weeks from the first Monday of 1970 to a week's label."""
    return F.floor((F.unix_date(label.cast("date")) - FIRST_MONDAY) / 7).cast("int")


def week_of_number(number: Column) -> Column:
    """The label of a week of that number."""
    return F.date_from_unix_date(number * 7 + FIRST_MONDAY).cast("timestamp_ntz")


def month_end(ts: Column) -> Column:
    return F.last_day(F.to_date(ts)).cast("timestamp_ntz")


def month_start(ts: Column) -> Column:
    return F.trunc(F.to_date(ts), "MM")


def whole_days(start: Column, end: Column) -> Column:
    """Days from ``start`` to ``end``, rounded down: half a day early is -1.

    Clock times are subtracted as they are, without any time zone. The gap is
    moved to the positive side before its days are taken, since those are cut
    toward zero.
    """
    moved = (end - start) + F.lit(timedelta(days=BEYOND_ANY_GAP))
    return (F.extract(F.lit("DAY"), moved) - BEYOND_ANY_GAP).cast("bigint")


def iso_week(ts: Column) -> Column:
    return F.weekofyear(ts)


def weekday_name(ts: Column) -> Column:
    return F.element_at(F.array(*(F.lit(day) for day in WEEKDAYS)), weekday_index(ts))


def weekday_index(ts: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(ts) + 1


def month_angle(month: Column) -> Column:
    return F.lit(2.0 * math.pi) * month / F.lit(12.0)


def weeks_to_event(ts: Column, month: int = 11, day: int = 24, cap: int = 20) -> Column:
    """Whole weeks until the next yearly event, at most ``cap``. The event day itself gives 0."""

    def event_in(year: Column) -> Column:
        return F.make_date(year, F.lit(month), F.lit(day)).cast("timestamp_ntz")

    this_year = event_in(F.year(ts))
    event = F.when(ts > this_year, event_in(F.year(ts) + 1)).otherwise(this_year)
    weeks = F.floor(whole_days(ts, event) / F.lit(7)).cast("int")
    return F.least(weeks, F.lit(cap))
