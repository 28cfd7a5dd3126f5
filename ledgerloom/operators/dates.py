"""Calendar dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

FIRST_DAY, LAST_DAY = "2020-01-01", "2030-12-31"


def calendar_attributes(d: Column) -> dict[str, Column]:
    """All calendar columns of a date. Weeks start on Monday, day 0 is Sunday."""
    weekday = F.dayofweek(d) - 1
    week_start = F.trunc(d, "week")
    quarter_end = F.last_day(F.add_months(F.trunc(d, "quarter"), 2))
    year_end = F.last_day(F.add_months(F.trunc(d, "year"), 11))
    big = lambda c: c.cast("bigint")
    return {
        "date_sk": F.date_format(d, "yyyyMMdd").cast("bigint"),
        "date_actual": d,
        "day_of_week": big(weekday),
        "day_of_week_name": F.date_format(d, "EEE"),
        "day_of_week_short": F.left(F.date_format(d, "EEE"), F.lit(3)),
        "day_of_month": big(F.dayofmonth(d)),
        "day_of_year": big(F.dayofyear(d)),
        "is_weekday": weekday.between(1, 5),
        "is_weekend": weekday.isin(0, 6),
        "week_of_year": big(F.weekofyear(d)),
        "week_of_month": big(F.ceil(F.dayofmonth(d) / F.lit(7.0))),
        "week_start_date": week_start,
        "week_end_date": F.date_add(week_start, 6),
        "month_actual": big(F.month(d)),
        "month_name": F.date_format(d, "MMM"),
        "month_name_short": F.left(F.date_format(d, "MMM"), F.lit(3)),
        "month_start_date": F.trunc(d, "month"),
        "month_end_date": F.last_day(d),
        "quarter_actual": big(F.quarter(d)),
        "quarter_name": F.concat(F.lit("Q"), F.quarter(d).cast("string")),
        "quarter_start_date": F.trunc(d, "quarter"),
        "quarter_end_date": quarter_end,
        "year_actual": big(F.year(d)),
        "year_start_date": F.trunc(d, "year"),
        "year_end_date": year_end,
        "fiscal_year": big(F.year(d)),
        "fiscal_quarter": big(F.quarter(d)),
        "is_holiday": F.lit(False),
        "holiday_name": F.lit(None).cast("string"),
        "is_last_day_of_month": d == F.last_day(d),
        "is_last_day_of_quarter": d == quarter_end,
        "is_last_day_of_year": d == year_end,
    }


def calendar_of(days: DataFrame, column: str = "date_actual") -> DataFrame:
    """Calendar rows of a DataFrame of distinct dates."""
    return days.select(*[c.alias(name) for name, c in calendar_attributes(F.col(column)).items()])


def build_dim_date(spark: SparkSession, first: str = FIRST_DAY, last: str = LAST_DAY, unknown: bool = True) -> DataFrame:
    """One row per day, plus the unknown member with key -1."""
    span = spark.range(1).select(
        F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("date_actual")
    )
    days = calendar_of(span)
    if not unknown:
        return days
    member = spark.range(1).select(
        F.lit(-1).cast("bigint").alias("date_sk"), F.lit("1900-01-01").cast("date").alias("date_actual"),
        F.lit(0).cast("bigint").alias("day_of_week"), F.lit(1).cast("bigint").alias("month_actual"),
        F.lit(1900).cast("bigint").alias("year_actual"), F.lit(False).alias("is_holiday"),
    )
    return days.unionByName(member, allowMissingColumns=True)
