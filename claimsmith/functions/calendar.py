"""Date helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: synthesised events spread over the first 28 days of a month.
DAYS_PER_SPREAD = 28


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(month: Column | str) -> Column:
    """'yyyy-MM' -> first day of month; '', null or an invalid month -> null."""
    return F.try_to_date(F.concat_ws("-", _col(month), F.lit("01")), "yyyy-MM-dd")


def day_in_spread(first_day: Column | str, seq: Column | str) -> Column:
    """first_day + (seq - 1) mod 28 days (row 29 wraps to day 1)."""
    offset = F.pmod(_col(seq).cast("bigint") - 1, F.lit(DAYS_PER_SPREAD).cast("bigint")).cast("int")
    return F.date_add(_col(first_day), offset)


def date_key(d: Column | str) -> Column:
    """yyyyMMdd as int (E18), computed arithmetically: no formatter involved."""
    d = _col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def calendar_columns(d: Column | str) -> dict[str, Column]:
    """B5 attributes: year, quarter, month, day, ISO week, weekend flag."""
    d = _col(d)
    return {
        "date_sk": date_key(d),
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
        "week_of_year": F.weekofyear(d),
        "is_weekend": F.dayofweek(d).isin(1, 7),
    }
