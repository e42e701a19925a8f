"""Rating, price and date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewtide.functions.fixed_values import (
    DAY_FORMAT,
    NEGATIVE,
    NEUTRAL,
    NEUTRAL_ABOVE,
    POSITIVE,
    POSITIVE_ABOVE,
)


def sentiment_of(rating: Column) -> Column:
    """Sentiment class of a star rating; null and NaN have none."""
    known = rating.isNotNull() & ~F.isnan(rating.cast("double"))
    return F.when(
        known,
        F.when(rating > POSITIVE_ABOVE, POSITIVE)
        .when(rating > NEUTRAL_ABOVE, NEUTRAL)
        .otherwise(NEGATIVE),
    )


def parse_rating(text: Column) -> Column:
    """Rating as float; unreadable text gives null."""
    return F.trim(text.cast("string")).try_cast("float")


def parse_price(text: Column) -> Column:
    """Whole price such as '1,299.' as an integer; unreadable text gives null."""
    return F.trim(F.regexp_replace(text, "[.,]", "")).try_cast("int")


def day_of(timestamp_text: Column) -> Column:
    """Date from the first ten characters of a timestamp string; null if unreadable."""
    return F.try_to_date(F.substring(timestamp_text, 1, 10), DAY_FORMAT)


def shift_days(day: Column, n: int) -> Column:
    """The date ``n`` days earlier."""
    return F.date_sub(day, n)
