"""Calendar column expressions.

All are built-in Spark expressions, so they stay inside whole-stage codegen and need no join:
the US federal holiday calendar is evaluated as a rule on (year, month, day, weekday) instead
of a lookup table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_of_day(hhmm: str | Column) -> Column:
    """Hour from an HHMM integer, clipped to 23 (2400 -> 23)."""
    return F.least(F.floor(_c(hhmm).cast("double") / 100), F.lit(23)).cast("int")


def day_of_week(date: str | Column) -> Column:
    """0 = Monday ... 6 = Sunday."""
    return F.weekday(_c(date))


def month(date: str | Column) -> Column:
    return F.month(_c(date))


def is_weekend(date: str | Column) -> Column:
    """C3."""
    return day_of_week(date).isin(5, 6).cast("int")


def cyclic(x: str | Column, period: int) -> tuple[Column, Column]:
    """(sin, cos) of 2*pi*x/period."""
    angle = F.lit(2 * math.pi) * _c(x) / F.lit(period)
    return F.sin(angle), F.cos(angle)


def time_block(hour: str | Column) -> Column:
    """early_morning [5,8), morning [8,12), afternoon [12,17), evening [17,21), else night."""
    h = _c(hour)
    return (F.when((h >= 5) & (h < 8), "early_morning")
             .when((h >= 8) & (h < 12), "morning")
             .when((h >= 12) & (h < 17), "afternoon")
             .when((h >= 17) & (h < 21), "evening")
             .otherwise("night"))


def _fixed_date_observed(mo: Column, dom: Column, wd: Column, m: int, d: int) -> Column:
    """A fixed-date holiday, plus Friday before when it falls on Saturday and Monday after
    when it falls on Sunday."""
    return (((mo == m) & (dom == d))
            | ((mo == m) & (dom == d - 1) & (wd == 4))
            | ((mo == m) & (dom == d + 1) & (wd == 0)))


def us_federal_holiday(date: str | Column) -> Column:
    """C4: True when the date is a US federal holiday or an observed substitute day.

    Rules: New Year's Day (Jan 1; observed Fri Dec 31 / Mon Jan 2), Martin Luther King Jr. Day
    (3rd Monday of January, from 1986), Washington's Birthday (3rd Monday of February),
    Memorial Day (last Monday of May), Juneteenth (Jun 19, from 2021), Independence Day
    (Jul 4), Labor Day (1st Monday of September), Columbus Day (2nd Monday of October),
    Veterans Day (Nov 11), Thanksgiving (4th Thursday of November), Christmas Day (Dec 25);
    fixed-date holidays move to Friday when on Saturday and to Monday when on Sunday.
    """
    d = _c(date)
    y, mo, dom, wd = F.year(d), F.month(d), F.dayofmonth(d), F.weekday(d)
    monday, thursday = wd == 0, wd == 3
    new_year = (((mo == 1) & (dom == 1)) | ((mo == 1) & (dom == 2) & monday)
                | ((mo == 12) & (dom == 31) & (wd == 4)))
    mlk = (y >= 1986) & (mo == 1) & monday & dom.between(15, 21)
    washington = (mo == 2) & monday & dom.between(15, 21)
    memorial = (mo == 5) & monday & (dom >= 25)
    juneteenth = (y >= 2021) & _fixed_date_observed(mo, dom, wd, 6, 19)
    independence = _fixed_date_observed(mo, dom, wd, 7, 4)
    labor = (mo == 9) & monday & (dom <= 7)
    columbus = (mo == 10) & monday & dom.between(8, 14)
    veterans = _fixed_date_observed(mo, dom, wd, 11, 11)
    thanksgiving = (mo == 11) & thursday & dom.between(22, 28)
    christmas = _fixed_date_observed(mo, dom, wd, 12, 25)
    return F.coalesce(new_year | mlk | washington | memorial | juneteenth | independence | labor
                      | columbus | veterans | thanksgiving | christmas, F.lit(False))


def is_holiday(date: str | Column, pad_days: int = 0) -> Column:
    """C4 (pad_days=0) / C5 (pad_days=1): holiday within +-pad_days, as int."""
    d = _c(date)
    cond = us_federal_holiday(d)
    for k in range(1, pad_days + 1):
        cond = cond | us_federal_holiday(F.date_sub(d, k)) | us_federal_holiday(F.date_add(d, k))
    return cond.cast("int")
