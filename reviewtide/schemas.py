"""Fixed schemas of the records the library reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

# Full review dump, eleven fields.
RAW_REVIEW = T.StructType(
    [
        T.StructField("overall", T.IntegerType()),
        T.StructField("vote", T.StringType()),
        T.StructField("verified", T.BooleanType()),
        T.StructField("reviewTime", T.StringType()),
        T.StructField("reviewerID", T.StringType()),
        T.StructField("asin", T.StringType()),
        T.StructField("style", T.MapType(T.StringType(), T.StringType())),
        T.StructField("reviewerName", T.StringType()),
        T.StructField("reviewText", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("unixReviewTime", T.LongType()),
    ]
)

# The three fields training needs.
TRAINING_REVIEW = T.StructType(
    [
        T.StructField("overall", T.FloatType()),
        T.StructField("reviewText", T.StringType()),
        T.StructField("summary", T.StringType()),
    ]
)

# One message on the wire. Producers disagree on names (timestamp/reviewDate,
# rating/overall, review_content/reviewText) and on the rating's JSON type, so
# everything is read as text and normalised afterwards.
MESSAGE = T.StructType(
    [
        T.StructField("asin", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("price", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("reviewDate", T.StringType()),
        T.StructField("rating", T.StringType()),
        T.StructField("overall", T.StringType()),
        T.StructField("review_content", T.StringType()),
        T.StructField("reviewText", T.StringType()),
        T.StructField(CORRUPT, T.StringType()),
    ]
)

# Results table. The key is the content hash; the date is the partition column.
STORED_REVIEW = T.StructType(
    [
        T.StructField("msg_id", T.StringType()),
        T.StructField("asin", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("price", T.DecimalType(10, 2)),
        T.StructField("review_date", T.DateType()),
        T.StructField("rating", T.FloatType()),
        T.StructField("review_text", T.StringType()),
        T.StructField("sentiment", T.StringType()),
    ]
)

PRODUCT = T.StructType(
    [T.StructField("asin", T.StringType()), T.StructField("name", T.StringType())]
)

STORED_PAGE = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)
