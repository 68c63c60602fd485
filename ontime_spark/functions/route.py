"""Route column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ontime_spark import schemas as S


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def distance_category(distance: str | Column) -> Column:
    """< 500 mi short, 500-1500 mi medium, otherwise (missing too) long."""
    d = _c(distance)
    return (F.when(d < S.SHORT_MI, "short")
             .when((d >= S.SHORT_MI) & (d <= S.LONG_MI), "medium")
             .otherwise("long"))


def route_key(origin: str | Column = "origin", dest: str | Column = "dest") -> Column:
    """C13: 'ORIGIN-DEST'; null when either side is missing."""
    o, d = _c(origin), _c(dest)
    return F.when(o.isNotNull() & d.isNotNull(), F.concat_ws("-", o, d))
