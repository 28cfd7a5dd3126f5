"""Tolerant parsing: bad input yields NULL, never a failed job."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,4)"


def safe_date(c: Column) -> Column:
    """ISO dates, ``dd-MON-yyyy`` and ``MM/dd/yyyy``; anything else is NULL.

    The shape is tested before parsing: a failed parse costs far more than a failed pattern.
    """
    text = F.trim(c)
    return (
        F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), F.try_to_date(text))
        .when(text.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_date(text, "M/d/yyyy"))
        .when(text.rlike(r"^\d{1,2}-[A-Za-z]{3}-\d{4}$"), F.try_to_date(text, "d-MMM-yyyy"))
    )


def safe_decimal(c: Column) -> Column:
    return c.try_cast(MONEY)


def safe_integer(c: Column) -> Column:
    """Whole number, rounded half up."""
    return c.try_cast("decimal(38,0)").try_cast("bigint")


def abs_value(c: Column) -> Column:
    return F.abs(c)


def abs_integer(c: Column) -> Column:
    # widened first: the absolute value of the smallest bigint does not fit one
    return F.abs(c.cast("decimal(20,0)")).try_cast("bigint")


def line_total(quantity: Column, unit_price: Column) -> Column:
    return F.try_multiply(quantity.cast("decimal(20,0)"), unit_price).try_cast(MONEY)
