"""Checks that a record fits the results table, and the split into valid and rejected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewtide.functions.fixed_values import MAX_ASIN_CHARS, MAX_CATEGORY_CHARS, MAX_RATING
from reviewtide.schemas import CORRUPT


def stored_review_rules(columns: list[str]) -> dict[str, Column]:
    """Named violations for the columns that are present."""
    asin, rating, price = F.col("asin"), F.col("rating"), F.col("price")
    rules = {
        CORRUPT: ("unreadable", F.col(CORRUPT).isNotNull()),
        "asin": ("asin_empty", F.coalesce(F.trim(asin) == "", F.lit(True))),
        "name": ("name_missing", F.col("name").isNull()),
        "price": ("price_missing", price.isNull()),
        "review_date": ("date_missing", F.col("review_date").isNull()),
        "rating": ("rating_missing", rating.isNull()),
        "review_text": ("text_missing", F.col("review_text").isNull()),
    }
    limits = {
        "asin": ("asin_too_long", F.char_length(asin) > MAX_ASIN_CHARS),
        "category": ("category_too_long", F.char_length("category") > MAX_CATEGORY_CHARS),
        "rating": (
            "rating_out_of_range",
            F.isnan(rating.cast("double")) | (rating < 0) | (rating > MAX_RATING),
        ),
        "price": ("price_negative", price < 0),
    }
    found = {}
    for group in (rules, limits):
        for column, (name, violated) in group.items():
            if column in columns:
                found[name] = violated
    return found


def tag_quality(df: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """Add ``reasons``, the names of all violated rules, in one pass."""
    rules = stored_review_rules(df.columns) if rules is None else rules
    named = [F.when(violated, F.lit(name)) for name, violated in rules.items()]
    return df.withColumn("reasons", F.array_compact(F.array(*named)))


def check_quality(
    df: DataFrame, rules: dict[str, Column] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected); rejected rows keep their ``reasons``. Together they are the input."""
    tagged = tag_quality(df, rules)
    valid = tagged.filter(F.size("reasons") == 0).drop("reasons")
    return valid, tagged.filter(F.size("reasons") > 0)
