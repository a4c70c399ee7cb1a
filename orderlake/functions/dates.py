"""Order dates (F16) and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlake.functions.text import _col

LOCAL_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def parse_local_date(c, strict: bool = True) -> Column:
    """DATE(PARSE_TIMESTAMP('%Y-%m-%d %H:%M:%S', s)). Strict by default: malformed text
    fails the job as it would in the warehouse; ``strict=False`` gives null instead."""
    if strict:
        return F.to_date(_col(c), LOCAL_TIME_FORMAT)
    return F.try_to_timestamp(_col(c), F.lit(LOCAL_TIME_FORMAT)).cast("date")


def date_attributes(d) -> dict[str, Column]:
    d = _col(d)
    return {
        "day": F.dayofmonth(d),
        "month": F.month(d),
        "quarter": F.quarter(d),
        "year": F.year(d),
        "day_name": F.date_format(d, "EEEE"),
        "month_name": F.date_format(d, "MMMM"),
        # dayofweek: 1 = Sunday ... 7 = Saturday
        "is_weekend": F.dayofweek(d).isin(1, 7),
    }
