"""Weather column expressions: IFR, wind category, severe weather (C8-C10), unit conversion
(C11) and fixed-width ISD field parsing (C14)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ontime_spark import schemas as S


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ifr(ceiling: str | Column, visibility: str | Column) -> Column:
    """Ceiling < 1000 ft or visibility < 3 mi; a missing value compares false."""
    return (F.coalesce(_c(ceiling) < S.IFR_CEILING_FT, F.lit(False))
            | F.coalesce(_c(visibility) < S.IFR_VISIBILITY_MI, F.lit(False))).cast("int")


def wind_category(wind: str | Column) -> Column:
    """< 10 kt calm, 10-25 kt moderate, otherwise (missing too) strong."""
    w = _c(wind)
    return (F.when(w < S.WIND_CALM_KT, "calm")
             .when((w >= S.WIND_CALM_KT) & (w <= S.WIND_STRONG_KT), "moderate")
             .otherwise("strong"))


def severe_weather(thunder: str | Column, snow: str | Column, wind: str | Column) -> Column:
    """Thunderstorm or snow or wind > 35 kt; a missing flag counts as set, a missing wind (NaN
    too) does not."""
    return ((F.coalesce(_c(thunder).cast("double"), F.lit(1.0)) != 0)
            | (F.coalesce(_c(snow).cast("double"), F.lit(1.0)) != 0)
            | F.coalesce(F.nanvl(_c(wind).cast("double"), F.lit(None).cast("double")) > S.WIND_SEVERE_KT, F.lit(False))).cast("int")


# C11 conversion factors (exact definitions: 1 kt = 1852 m/h, 1 mi = 1609.344 m, 1 ft = 0.3048 m).
MS_TO_KT = 3600.0 / 1852.0
M_PER_MI = 1609.344
M_PER_FT = 0.3048


def ms_to_knots(c: str | Column) -> Column:
    return _c(c) * F.lit(MS_TO_KT)


def m_to_miles(c: str | Column) -> Column:
    return _c(c) / F.lit(M_PER_MI)


def m_to_feet(c: str | Column) -> Column:
    return _c(c) / F.lit(M_PER_FT)


def c_to_f(c: str | Column) -> Column:
    return _c(c) * 9.0 / 5.0 + 32.0


def mm_to_inches(c: str | Column) -> Column:
    return _c(c) / 25.4


# C14 ISD mandatory-section layouts: field -> (0-based start, end). "public" follows the
# published ISD format; "legacy" keeps the offsets whose visibility slice overlaps the
# temperature field (ceiling 78:83, visibility 84:90).
ISD_LAYOUTS = {
    "public": {"usaf": (4, 10), "wban": (10, 15), "date": (15, 23), "time": (23, 27),
               "wind_speed": (65, 69), "ceiling": (70, 75), "visibility": (78, 84),
               "temp": (87, 92), "dew_point": (93, 98)},
    "legacy": {"usaf": (4, 10), "wban": (10, 15), "date": (15, 23), "time": (23, 27),
               "wind_speed": (65, 69), "ceiling": (78, 83), "visibility": (84, 90),
               "temp": (87, 92), "dew_point": (93, 98)},
}
# Missing-value sentinels per field.
ISD_SENTINELS = {
    "wind_speed": ("9999",), "ceiling": ("99999",), "visibility": ("999999",),
    "temp": ("+9999", "-9999", "9999"), "dew_point": ("+9999", "-9999", "9999"),
}
ISD_MIN_LENGTH = 105


def isd_slice(line: str | Column, field: str, layout: str = "public") -> Column:
    start, end = ISD_LAYOUTS[layout][field]
    return F.substring(_c(line), start + 1, end - start)


def isd_raw(line: str | Column, field: str, layout: str = "public") -> Column:
    """Trimmed text of a numeric field, null when blank or a missing sentinel."""
    raw = F.trim(isd_slice(line, field, layout))
    return F.when((raw == "") | raw.isin(*ISD_SENTINELS[field]), F.lit(None)).otherwise(raw)


def isd_timestamp(line: str | Column, layout: str = "public") -> Column:
    stamp = F.concat(isd_slice(line, "date", layout), isd_slice(line, "time", layout))
    return F.try_to_timestamp(stamp, F.lit("yyyyMMddHHmm"))
