"""Boolean quality flags; never NULL."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .parse import safe_date


def missing_flag(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit("")) == ""


def invalid_date_flag(c: Column) -> Column:
    return safe_date(c).isNull() & ~missing_flag(c)


def negative_flag(value: Column) -> Column:
    return F.coalesce(value < 0, F.lit(False))


def zero_flag(value: Column) -> Column:
    return F.coalesce(value == 0, F.lit(False))
