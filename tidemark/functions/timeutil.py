"""Column helpers: boundary date differences, log positions, vector cosine, column safety."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(value: dt.date | str) -> Column:
    return F.lit(str(value)).cast("date")


def day_diff(start: Column | str, end: Column | str) -> Column:
    """Day boundaries between two moments, not elapsed days."""
    return F.datediff(_col(end).cast("date"), _col(start).cast("date"))


def hour_diff(start: Column | str, end: Column | str) -> Column:
    """Hour boundaries between two moments."""
    s, e = _col(start), _col(end)
    return day_diff(s, e).cast("long") * 24 + F.hour(e) - F.hour(s)


def month_diff(start: Column | str, end: Column | str) -> Column:
    """Month boundaries between two moments."""
    s, e = _col(start), _col(end)
    return (F.year(e) - F.year(s)) * 12 + F.month(e) - F.month(s)


def second_diff(start: Column | str, end: Column | str) -> Column:
    """Second boundaries between two moments."""
    return hour_diff(start, end) * 3600 + (F.minute(_col(end)) - F.minute(_col(start))) * 60 + F.second(_col(end)) - F.second(_col(start))


def lsn_value(lsn: Column | str) -> Column:
    """A log position `hi/lo` of hexadecimal halves as one number; text order is wrong when the halves differ in length."""
    c = _col(lsn)
    part = lambda i: F.conv(F.split_part(c, F.lit("/"), F.lit(i)), 16, 10).cast("decimal(20,0)")
    return (part(1) * F.lit(4294967296).cast("decimal(20,0)") + part(2)).cast("decimal(38,0)")


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine of two arrays; null where a length is zero."""
    x, y = _col(a).cast("array<double>"), _col(b).cast("array<double>")
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda s, v: s + v)
    dot = total(F.zip_with(x, y, lambda p, q: p * q))
    norm = lambda c: F.sqrt(total(F.transform(c, lambda v: v * v)))
    return F.try_divide(dot, norm(x) * norm(y))


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(_col(a), _col(b), lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)


def unit(a: Column | str) -> Column:
    """The array brought to length one; null where its length is zero."""
    x = _col(a).cast("array<double>")
    norm = F.sqrt(F.aggregate(x, F.lit(0.0), lambda s, v: s + v * v))
    return F.when(norm > 0, F.transform(x, lambda v: v / norm))


def ratio(top: Column, bottom: Column, scale: int = 6) -> Column:
    """Division as a rounded double; null for a zero divisor."""
    return F.round(F.try_divide(top.cast("double"), bottom.cast("double")), scale)
