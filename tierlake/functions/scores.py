"""Column expressions shared by the stages. All are built-in Spark expressions, so
they stay inside whole-stage codegen; nothing here runs Python per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number(c: str | Column) -> Column:
    """The text as a double, NULL for text that is not a number.

    Every number holds a digit, or the n of NaN and of infinity. Text without any is not
    tried: a cast that fails raises an exception inside, at many times the cost of one
    that does not."""
    raw = _col(c)
    return F.when(raw.cast("string").rlike("[0-9nN]"), raw.try_cast("double"))


def parse_score(c: str | Column, fill: float = 0.0, value: Column | None = None) -> Column:
    """Absent score (NULL raw text) becomes ``fill``; anything else is cast to double, or is
    ``value`` where the caller has ``number(c)`` already.

    The NULL test is on the raw value, so text that is not a number stays NULL rather
    than turning into ``fill``. ``try_cast`` keeps that true under ANSI mode, where a
    plain cast would raise instead.
    """
    raw = _col(c)
    return F.when(raw.isNull(), F.lit(float(fill))).otherwise(number(raw) if value is None else value)


def is_malformed(c: str | Column, value: Column | None = None) -> Column:
    """Raw text present but not a number."""
    raw = _col(c)
    return raw.isNotNull() & (number(raw) if value is None else value).isNull()


def is_nan(c: str | Column, value: Column | None = None) -> Column:
    return F.isnan(number(c) if value is None else value)


def positive(c: str | Column) -> Column:
    """The ranking predicate: NULL and zero both fail it."""
    return _col(c) > 0


def bin_of(c: str | Column, width: float) -> Column:
    """Fixed-width histogram bin index as bigint; NULL for NaN and infinite values."""
    value = _col(c).cast("double")
    unplaced = F.isnan(value) | (F.abs(value) == float("inf"))
    return F.when(~unplaced, F.floor(value / F.lit(float(width))).cast("bigint"))


def year_of(c: str | Column) -> Column:
    return F.year(_col(c)).cast("int")
