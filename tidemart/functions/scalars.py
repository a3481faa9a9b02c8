"""Column helpers on top of ``pyspark.sql.functions``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The two date spellings the input files mix.
DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy")


def mixed_date(c: str | Column) -> Column:
    """Date from text in either known spelling; anything else is null."""
    return F.coalesce(*(F.try_to_date(_col(c), fmt) for fmt in DATE_FORMATS))


def full_name(first: str | Column, last: str | Column) -> Column:
    """First and last name with a blank between; a missing part counts as empty."""
    blank = F.lit("")
    return F.concat(F.coalesce(_col(first), blank), F.lit(" "), F.coalesce(_col(last), blank))


def in_year(c: str | Column, year: int) -> Column:
    """Within a calendar year, as a range that the scan can prune on."""
    return (_col(c) >= F.lit(dt.date(year, 1, 1))) & (_col(c) < F.lit(dt.date(year + 1, 1, 1)))


def in_month(c: str | Column, year: int, month: int) -> Column:
    """Within one calendar month, as a range."""
    following = dt.date(year + month // 12, month % 12 + 1, 1)
    return (_col(c) >= F.lit(dt.date(year, month, 1))) & (_col(c) < F.lit(following))


def within_days(c: str | Column, start: str | Column, days: int) -> Column:
    """On ``start`` or up to ``days`` days after it, both ends included."""
    return _col(c).between(_col(start), F.date_add(_col(start), days))


def mean_day(c: str | Column) -> Column:
    """Average date, as a fractional day number; free of any time zone."""
    return F.avg(F.unix_date(_col(c)))


def mean_date(c: str | Column) -> Column:
    """Average date as a timestamp (UTC midnight plus the fraction of a day)."""
    return F.timestamp_seconds(mean_day(c) * F.lit(86400))


def share_pct(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole`` to two places; null on a zero whole."""
    return F.round(F.try_divide(part, whole) * 100, 2)


def epoch_second(c: str | Column) -> Column:
    """Timestamp as whole seconds since 1970."""
    return _col(c).cast("long")


def millis_to_timestamp(c: str | Column) -> Column:
    """Epoch milliseconds (number or text) as a timestamp; bad text gives null."""
    return F.timestamp_millis(_col(c).try_cast("long"))


def descending(c: str | Column) -> list[Column]:
    """Ascending sort keys that order a number from high to low with nulls last."""
    return [_col(c).isNull(), -_col(c)]
