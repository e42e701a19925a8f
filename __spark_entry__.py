"""Registered queries and the SQL that checks them."""

from __future__ import annotations

import importlib.util
import math
import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import reviewtide as rt  # noqa: E402
from reviewtide.functions.fixed_values import PRODUCT_LINK_CLASS, REVIEW_LINK_CLASS  # noqa: E402
from reviewtide.functions.text import content_id  # noqa: E402
from reviewtide.oracle import TERMS_PER_CLASS, TOPK, statements  # noqa: E402
from reviewtide.plans.numbering import number_rows  # noqa: E402
from reviewtide.plans.storage import file_bytes, list_paths, materialise, new_dir  # noqa: E402
from reviewtide.schemas import RAW_REVIEW, TRAINING_REVIEW  # noqa: E402
from reviewtide.sources import tables  # noqa: E402
from reviewtide.streaming.trend import SENTIMENT_TREND  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"
SHOP = "https://shop.example"
DUMP_LINES = 100
FILE_BYTES = 65_536
#: Bytes of the table in one of the partitions that it is dealt over.
DEALT_BYTES = 8 * 1024 * 1024


def _dealt(frame: Callable[..., DataFrame], spark: SparkSession, sf_dir: str) -> DataFrame:
    """A frame over the documents, with at least a partition per core of a local session, and more
    as the table grows. A table of many files, as a cluster's are, is left as it is."""
    context = spark.sparkContext
    cores, path = context.defaultParallelism, f"{sf_dir}/documents.parquet"
    if not context.master.startswith("local") or len(list_paths(spark, f"{path}/*.parquet")) >= cores:
        return frame(spark, sf_dir)
    rounds = max(1, math.ceil(file_bytes(spark, path) / DEALT_BYTES / cores))
    return frame(spark, sf_dir, partitions=cores * rounds)


def _prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rated reviews, cleaned, with class and split."""
    reviews = rt.prepare_text(_dealt(tables.reviews_labelled, spark, sf_dir))
    return rt.split_by_key(rt.with_sentiment(reviews), "review_id")


def _training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prepared(spark, sf_dir).filter("is_train")


def _everything(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every review, cleaned; those without a rating have no class, but get a prediction."""
    reviews = rt.prepare_text(_dealt(tables.reviews_all, spark, sf_dir))
    return rt.split_by_key(rt.with_sentiment(reviews), "review_id")


def _all_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rt.prepare_text(_dealt(tables.reviews_unrated, spark, sf_dir))


def _r6(*columns: str) -> list[Column]:
    return [F.round(c, 6).alias(c) for c in columns]


# Preparation.


def clean_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_prepared(spark, sf_dir).select(
        "review_id", F.col("processedReviewText").alias("processed_text"), "length"
    )


def sentiment_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviews = rt.with_sentiment(_dealt(tables.reviews_all, spark, sf_dir))
    return reviews.select("review_id", "overall", "sentiment")


def sentiment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rt.sentiment_counts(rt.with_sentiment(_dealt(tables.reviews_all, spark, sf_dir)))


def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviews = _dealt(tables.reviews_unrated, spark, sf_dir)
    return rt.split_by_key(reviews, "review_id").select("review_id", "is_train")


def label_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rt.label_index(rt.with_sentiment(_dealt(tables.reviews_all, spark, sf_dir)))


def review_msg_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = content_id("asin", "overall", "review_date", "reviewText")
    return _dealt(tables.reviews_all, spark, sf_dir).select("review_id", parts.alias("msg_id"))


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_dir(spark, "reviews")
    reviews = _dealt(tables.reviews_all, spark, sf_dir).select("overall", "reviewText", "summary")
    rt.write_reviews(reviews, path, max_records=100_000)
    return rt.read_reviews(spark, path).withColumnRenamed("reviewText", "review_text")


def reduced_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full dump in gzip files, reduced to the training fields in files of few lines, read back."""
    full, reduced = new_dir(spark, "dump"), new_dir(spark, "reduced")
    reviews = _dealt(tables.reviews_all, spark, sf_dir)
    given = {"overall": F.col("overall").cast("int"), "reviewerID": F.col("review_id").cast("string")}
    kept = ("asin", "reviewText", "summary")
    fields = [
        given[f.name].alias(f.name) if f.name in given
        else F.col(f.name) if f.name in kept
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in RAW_REVIEW.fields
    ]
    reviews.select(*fields).write.option("ignoreNullFields", "false").option("compression", "gzip").json(full)
    dump = rt.read_reviews(spark, full, schema=RAW_REVIEW)
    rt.write_reviews(dump.select("overall", "reviewText", "summary"), reduced, max_records=DUMP_LINES)
    return rt.read_reviews(spark, reduced).withColumnRenamed("reviewText", "review_text")


def unreadable_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as JSON lines, every seventh cut short: what cannot be read, told apart."""
    path = new_dir(spark, "cut-lines")
    review = F.to_json(F.struct(F.col("review_id").alias("overall"), "reviewText", "summary"), {"ignoreNullFields": "false"})
    line = F.when(F.expr("review_id % 7 = 0"), F.expr("left(_line, length(_line) - 3)")).otherwise(F.col("_line"))
    reviews = _dealt(tables.reviews_unrated, spark, sf_dir).withColumn("_line", review)
    reviews.select(line.alias("value")).write.text(path)
    none = F.lit(None)
    read = rt.read_reviews(spark, path).select(
        F.col("overall").cast("long").alias("overall"), F.col("reviewText").alias("review_text"), "summary", none.cast("string").alias("line")
    )
    lost = rt.unreadable_lines(spark, path).select(
        none.cast("long").alias("overall"), none.cast("string").alias("review_text"), none.cast("string").alias("summary"), "line"
    )
    return read.unionByName(lost)


def review_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense ids of all reviews, by date and then by number."""
    reviews = _dealt(tables.reviews_unrated, spark, sf_dir).select("review_id", "review_date")
    return number_rows(reviews, "review_date", "review_id", name="dense_id", first=1)


def bounded_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews in files of bounded length, read back with whether their file keeps to the bound or is one line."""
    path = new_dir(spark, "bounded")
    reviews = _dealt(tables.reviews_all, spark, sf_dir).select("overall", "reviewText", "summary")
    rt.write_reviews(reviews, path, max_bytes=FILE_BYTES)
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("at"), F.col("_metadata.file_size").alias("bytes")
    )
    files = lines.groupBy("at").agg(F.count(F.lit(1)).alias("lines"), F.max("bytes").alias("bytes"))
    fits = (F.col("bytes") <= FILE_BYTES) | (F.col("lines") == 1)
    review = F.from_json("value", TRAINING_REVIEW).alias("review")
    read = lines.select("at", review).join(files.select("at", fits.alias("fits")), "at")
    return read.select("review.overall", F.col("review.reviewText").alias("review_text"), "review.summary", "fits")


def stored_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads into one results table, the first replayed: nothing lost, nothing twice."""
    path = new_dir(spark, "stored")
    rated = rt.with_sentiment(_records(spark, sf_dir), "rating")
    even = F.expr("conv(right(msg_id, 1), 16, 10) % 2 = 0")
    for load, part in (("even", even), ("odd", ~even), ("even", even)):
        rt.append_scored(rated.filter(part), path, run=load)
    price = F.col("price").cast("double").alias("price")
    return rt.read_scored(spark, path).select(
        "msg_id", "asin", "name", "category", price, "review_date", "rating", "review_text",
        "sentiment",
    )


def stored_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in four batches, compacted after two and after all of them, one replayed after it was folded."""
    path = new_dir(spark, "stored")
    rated = rt.with_sentiment(_records(spark, sf_dir), "rating")
    part = F.expr("conv(right(msg_id, 1), 16, 10) % 4")
    for batch_id in (0, 1, None, 2, 0, 3, None):
        if batch_id is None:
            rt.compact_scored(spark, path)
        else:
            rt.append_scored(rated.filter(part == batch_id), path, run="load", batch_id=batch_id)
    price = F.col("price").cast("double").alias("price")
    return rt.read_scored(spark, path).select(
        "msg_id", "asin", "name", "category", price, "review_date", "rating", "review_text",
        "sentiment",
    )


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message, encoded and decoded again, with id and types."""
    encoded = rt.encode_messages(_dealt(tables.messages, spark, sf_dir))
    return rt.normalise_types(rt.with_msg_id(rt.decode_messages(encoded)))


def message_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("price").cast("double").alias("price")
    return _records(spark, sf_dir).select(
        "msg_id", "asin", "name", "category", price, "review_date", "rating", "review_text"
    )


# Text features.


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.col("tokenised_text")
    return rt.with_tokens(_all_prepared(spark, sf_dir)).select(
        "review_id", F.size(words).alias("n_tokens"), F.array_join(words, "|").alias("tokens")
    )


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rt.remove_stop_words(rt.with_tokens(_all_prepared(spark, sf_dir)))


def tokens_no_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.col("tokenised_text_without_stop_words")
    return _words(spark, sf_dir).select(
        "review_id", F.size(words).alias("n_words"), F.array_join(words, "|").alias("words")
    )


def bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    grams = F.col("nGrams")
    return rt.with_ngrams(_words(spark, sf_dir)).select(
        "review_id", F.size(grams).alias("n_bigrams"), F.array_join(grams, "|").alias("bigrams")
    )


def term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rt.term_counts(_all_prepared(spark, sf_dir))


def vocabulary_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = rt.term_counts(_all_prepared(spark, sf_dir))
    totals = materialise(rt.document_frequencies(counts).select("term", "total"), "totals")
    return rt.vocabulary(totals, TOPK)


def _counts_with_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = rt.term_counts(_all_prepared(spark, sf_dir), with_length=True)
    return materialise(counts, "counts")


def idf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = rt.idf_weights(_counts_with_length(spark, sf_dir))
    return weights.select("term", "doc_freq", *_r6("idf"))


def tfidf_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = rt.tfidf(_all_prepared(spark, sf_dir))
    return weights.select("review_id", "term", *_r6("value"))


# Classifier.


def nb_priors(spark: SparkSession, sf_dir: str) -> DataFrame:
    training = _training(spark, sf_dir)
    return rt.priors(rt.nb_fit(training), training).select("sentiment", "docs", *_r6("log_prior"))


def nb_term_logprob(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = rt.nb_fit(_training(spark, sf_dir))
    log_prob = F.round("log_prob", 5).alias("log_prob")
    return rt.log_probabilities(model).select("sentiment", "term", log_prob)


def _nb_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = rt.nb_fit(_training(spark, sf_dir))
    return rt.nb_predict(_everything(spark, sf_dir), model, keep=("sentiment", "is_train"))


def nb_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nb_predictions(spark, sf_dir).select(
        "review_id", "sentiment", "predicted_sentiment", "prediction"
    )


def _model_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rt.score(rt.fit_pipeline(_training(spark, sf_dir)), _everything(spark, sf_dir))


def model_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _model_predictions(spark, sf_dir).select(
        "review_id", "sentiment", "predicted_sentiment", "prediction"
    )


def staged_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with every estimator fitted on the training rows by ``Pipeline.fit``."""
    scored = rt.score(rt.fit_stages(_training(spark, sf_dir)), _everything(spark, sf_dir))
    return scored.select("review_id", "sentiment", "predicted_sentiment", "prediction")


def reloaded_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a model that was saved and loaded again."""
    path = new_dir(spark, "model")
    rt.save_model(rt.fit_pipeline(_training(spark, sf_dir)), path)
    scored = rt.score(rt.load_model(path), _everything(spark, sf_dir))
    return scored.select("review_id", "sentiment", "predicted_sentiment", "prediction")


def _rated_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = _prepared(spark, sf_dir)
    return rt.score(rt.fit_pipeline(prepared.filter("is_train")), prepared)


def _confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rt.confusion(_rated_predictions(spark, sf_dir), by=("is_train",))


def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _confusion(spark, sf_dir)


def class_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rt.class_metrics(_confusion(spark, sf_dir), by=("is_train",)).select(
        "is_train", "class", "support", "hits", *_r6("precision", "recall", "f1")
    )


def classifier_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = ("accuracy", "weighted_precision", "weighted_recall", "weighted_f1")
    overall = rt.metrics(_confusion(spark, sf_dir), by=("is_train",))
    return overall.select("is_train", "n", *_r6(*scores))


def prediction_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = _prepared(spark, sf_dir)
    model = rt.fit_pipeline(prepared.filter("is_train"))
    counts = rt.confusion(rt.score(model, prepared), by=("is_train",))
    return rt.rmse(counts, model.stages[0].labels, by=("is_train",)).select(
        "is_train", "n", *_r6("rmse")
    )


def top_terms_per_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rt.top_terms(rt.nb_fit(_training(spark, sf_dir)), TERMS_PER_CLASS)


# Scoring and storing.


def scored_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = rt.fit_pipeline(_training(spark, sf_dir))
    records = _records(spark, sf_dir)
    predictions = materialise(
        rt.score_messages(model, records).select("msg_id", "sentiment"), "predictions"
    )
    joined = rt.attach_predictions(records.drop("name", "review_text"), predictions)
    named = rt.attach_products(joined, tables.products(spark, sf_dir))
    return named.select("msg_id", "asin", "name", "review_date", "rating", "sentiment")


def stored_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_dir(spark, "stored")
    records = _records(spark, sf_dir)
    rt.append_scored(rt.with_sentiment(records, "rating"), path, run="all")
    price = F.col("price").cast("double").alias("price")
    return rt.read_scored(spark, path).select(
        "msg_id", "asin", "name", "category", price, "review_date", "rating", "review_text",
        "sentiment",
    )


def quality_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _dealt(tables.loose_messages, spark, sf_dir)
    typed = rt.normalise_types(raw.withColumn("price", rt.parse_price(F.col("price"))))
    _, rejected = rt.check_quality(typed)
    return rejected.select(
        "review_id",
        "asin",
        F.col("price").cast("int").alias("price"),
        "review_date",
        "rating",
        F.array_join("reasons", ",").alias("reasons"),
    )


def _checked(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    raw = _dealt(tables.mixed_messages, spark, sf_dir)
    return rt.check_quality(rt.normalise_types(raw.withColumn("price", rt.parse_price(F.col("price")))))


def quality_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("price").cast("int").alias("price")
    return _checked(spark, sf_dir)[0].select("review_id", "asin", "name", "category", price, "review_date", "rating", "review_text")


def quality_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rejected message with all the rules that it breaks."""
    reasons = F.array_join(F.array_sort("reasons"), ",").alias("reasons")
    return _checked(spark, sf_dir)[1].select("review_id", reasons)


def recent_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviews = rt.recent(_dealt(tables.reviews_unrated, spark, sf_dir), "review_date", "2022-12-25", 30)
    before = rt.shift_days(F.col("review_date"), 3).alias("three_days_before")
    return reviews.select("review_id", "review_date", before)


# Stored pages.


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rt.read_pages(spark, f"{sf_dir}/pages.parquet")


def page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.get(rt.tag_texts(F.col("html"), "title"), F.lit(0))
    return _pages(spark, sf_dir).select("page_id", title.alias("title"))


def page_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rt.tag_texts(F.col("html"), "p")
    return _pages(spark, sf_dir).select("page_id", F.posexplode(found).alias("pos", "paragraph"))


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rt.attr_values(F.col("html"), "a", "href")
    links = _pages(spark, sf_dir).select("page_id", F.explode(found).alias("href"))
    # Two levels keep the distinct count mergeable: one row per (href, page) first.
    per_page = links.groupBy("href", "page_id").agg(F.count(F.lit(1)).alias("n"))
    return per_page.groupBy("href").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_pages")
    )


def page_link_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.col("html")
    zipped = F.arrays_zip(
        rt.attr_values(html, "a", "href").alias("href"), rt.tag_texts(html, "a").alias("link_text")
    )
    rows = _pages(spark, sf_dir).select("page_id", F.posexplode(zipped).alias("pos", "link"))
    return rows.select("page_id", "pos", "link.href", "link.link_text")


def product_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _dealt(tables.shop_pages, spark, sf_dir).select(
        "page_id",
        "asin",
        rt.page_link(F.col("search_html"), PRODUCT_LINK_CLASS).alias("product_href"),
        rt.page_link(F.col("product_html"), REVIEW_LINK_CLASS).alias("review_href"),
    )
    return rt.product_urls(found, SHOP).select("page_id", "search_url", "product_url", "review_url")


def scraped_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages to reviews to recent ones to messages in a queue, and back."""
    pages = _dealt(tables.review_pages, spark, sf_dir).withColumns(
        {"price": rt.page_price(F.col("html")), "name": F.concat(F.lit("Product "), F.col("asin"))}
    )
    reviews = rt.explode_reviews(rt.review_lists(pages))
    sent = rt.review_messages(rt.recent(reviews, "review_date", "2022-12-25", 30))
    queue = new_dir(spark, "scraped")
    rt.send_messages(sent, queue)
    received = rt.decode_messages(spark.read.text(queue))
    return rt.normalise_types(received).select(
        "asin", "name", "category", F.col("price").cast("double").alias("price"), "review_date", "rating", "review_text"
    )


def review_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = F.concat(
        F.lit("Reviewed in Canada on "), F.date_format("review_date", "MMMM d, yyyy")
    )
    parsed = F.get(rt.review_dates(F.array(shown)), F.lit(0))
    return _dealt(tables.reviews_unrated, spark, sf_dir).select("review_id", parsed.alias("review_date"))


def review_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _dealt(tables.review_pages, spark, sf_dir)
    lines = pages.select("page_id", F.posexplode(rt.review_lines(F.col("html"))).alias("pos", "line"))
    return lines.select("page_id", "pos", "line")


def page_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _dealt(tables.review_pages, spark, sf_dir)
    priced = pages.withColumn("price", rt.page_price(F.col("html")))
    return rt.explode_reviews(rt.review_lists(priced)).select(
        "page_id", "asin", "pos", "price", "review_date", "rating", "review_content"
    )


# Trends.


def _day(trend: DataFrame, *rounded: str) -> DataFrame:
    rest = [c for c in trend.columns if c not in ("period_start", *rounded)]
    day = F.col("period_start").cast("date").alias("period_start")
    return trend.select(*rest, day, *_r6(*rounded))


def rating_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _day(rt.rating_trend(tables.ratings_events(spark, sf_dir)), "avg_rating")


def sentiment_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = rt.with_sentiment(tables.ratings_events(spark, sf_dir), "rating")
    shares = ("share_positive", "share_neutral", "share_negative")
    return _day(rt.sentiment_trend(rated), *shares)


def rating_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    change = rt.rating_change(rt.rating_trend(tables.ratings_events(spark, sf_dir)))
    return _day(change.drop("n_reviews"), "avg_rating", "previous_rating", "rating_change")


def rating_smoothed(spark: SparkSession, sf_dir: str) -> DataFrame:
    smoothed = rt.rating_smoothed(rt.rating_trend(tables.ratings_events(spark, sf_dir)), 3)
    return _day(smoothed.drop("n_reviews"), "avg_rating", "smoothed_rating")


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rt.rating_trend(tables.ratings_events(spark, sf_dir), "1 day")


def rating_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day of a product's life, also those without reviews."""
    return _day(rt.every_period(_daily(spark, sf_dir), "1 day"), "avg_rating")


def daily_rating_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change and smoothing over days, many of which have no review of a product."""
    changed = rt.rating_change(_daily(spark, sf_dir), "1 day")
    smoothed = rt.rating_smoothed(changed, 3, "1 day").drop("n_reviews")
    return _day(smoothed, "avg_rating", "previous_rating", "rating_change", "smoothed_rating")


def sentiment_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    predicted = _rated_predictions(spark, sf_dir)
    agreement = rt.sentiment_agreement(predicted, "overall", "predicted_sentiment")
    return agreement.select("asin", "n_reviews", "n_agree", *_r6("agreement"))


def stored_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly trend of the results table, written and read back."""
    path = new_dir(spark, "stored")
    rt.append_scored(rt.with_sentiment(_records(spark, sf_dir), "rating"), path, run="all")
    stored = rt.read_scored(spark, path).withColumn(
        "day", F.col("review_date").cast("timestamp_ntz")
    )
    rated = stored.filter("rating IS NOT NULL")
    return _day(rt.rating_trend(rated, "28 days", "day"), "avg_rating")


# Streams.


def stream_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = rt.fit_pipeline(_training(spark, sf_dir))
    base = new_dir(spark, "stream-scored")
    rt.send_messages(_dealt(tables.messages, spark, sf_dir), f"{base}/queue")
    query = rt.stream_score(spark, f"{base}/queue", model, f"{base}/sink", f"{base}/checkpoint")
    query.awaitTermination()
    return rt.read_scored(spark, f"{base}/sink").select(
        "msg_id", "asin", "name", "review_date", "rating", "sentiment"
    )


def _delivered_twice(spark: SparkSession, sf_dir: str) -> str:
    """A queue that holds every message twice, read by two checkpoints, with rules; where it all is."""
    model = rt.fit_pipeline(_training(spark, sf_dir))
    base = new_dir(spark, "stream-once")
    for _ in range(2):
        rt.send_messages(_dealt(tables.faulty_messages, spark, sf_dir), f"{base}/queue")
    rules = rt.stored_review_rules(tables.mixed_messages(spark, sf_dir).columns + ["review_date"])
    for reader in ("one", "two"):
        rt.stream_score(
            spark, f"{base}/queue", model, f"{base}/sink", f"{base}/checkpoint-{reader}", rules, f"{base}/rejects"
        ).awaitTermination()
    return base


def stored_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid messages of a queue that was delivered twice and read by two checkpoints."""
    stored = rt.read_scored(spark, f"{_delivered_twice(spark, sf_dir)}/sink")
    return stored.withColumn("price", F.col("price").cast("double")).drop("msg_id")


def rejected_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected messages of the same queue, with all the rules that each breaks."""
    fields = "asin string, name string, category string, price double, review_text string, reasons array<string>"
    rejected = spark.read.schema(fields).json(f"{_delivered_twice(spark, sf_dir)}/rejects")
    reasons = F.array_join(F.array_sort("reasons"), ",").alias("reasons")
    return rejected.select("asin", "name", "category", "price", "review_text", reasons)


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = new_dir(spark, "stream-dedup")
    sent = _dealt(tables.messages, spark, sf_dir)
    rt.send_messages(sent, f"{base}/queue")
    rt.send_messages(sent, f"{base}/queue")
    records = rt.normalise_types(
        rt.with_msg_id(rt.decode_messages(rt.read_messages(spark, f"{base}/queue")))
    ).withColumn("event_time", F.col("review_date").cast("timestamp"))
    single = rt.stream_dedup(records, "90 days", ts="event_time")
    query = (
        single.select("msg_id", "asin", "review_date", "review_text")
        .writeStream.format("parquet")
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{base}/sink")
    )
    query.awaitTermination()
    return spark.read.parquet(f"{base}/sink")


def _arriving_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = tables.table(spark, sf_dir, "events").schema
    # The glob matches the table whether it is one file or a folder of files.
    arriving = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    # A watermark needs instants; run the session in UTC so that days are the same.
    at = F.col("timestamp").cast("timestamp")
    return tables.as_ratings(arriving).withColumn("timestamp", at)


def stream_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = new_dir(spark, "stream-trend")
    trend = rt.stream_trend(_arriving_ratings(spark, sf_dir), delay="31 days")
    rt.write_trend(trend, f"{base}/sink", f"{base}/checkpoint").awaitTermination()
    return _day(rt.read_trend(spark, f"{base}/sink"), "avg_rating")


def stream_sentiment_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = new_dir(spark, "stream-sentiment")
    rated = rt.with_sentiment(_arriving_ratings(spark, sf_dir), "rating")
    trend = rt.stream_trend(rated, delay="31 days", trend=rt.sentiment_trend)
    rt.write_trend(trend, f"{base}/sink", f"{base}/checkpoint").awaitTermination()
    newest = rt.read_trend(spark, f"{base}/sink", SENTIMENT_TREND)
    return _day(newest, "share_positive", "share_neutral", "share_negative")


_QUERIES: tuple[Callable[[SparkSession, str], DataFrame], ...] = (
    clean_reviews,
    sentiment_label,
    sentiment_counts,
    train_test_split,
    label_index,
    review_msg_id,
    json_roundtrip,
    reduced_dump,
    unreadable_lines,
    review_ids,
    bounded_files,
    message_roundtrip,
    tokens,
    tokens_no_stop,
    bigrams,
    term_counts,
    vocabulary_topk,
    idf_weights,
    tfidf_terms,
    nb_priors,
    nb_term_logprob,
    nb_predictions,
    model_predictions,
    staged_predictions,
    reloaded_predictions,
    confusion,
    class_metrics,
    classifier_metrics,
    prediction_rmse,
    top_terms_per_class,
    scored_reviews,
    stored_reviews,
    stored_twice,
    stored_compacted,
    quality_rejects,
    quality_valid,
    quality_reasons,
    recent_reviews,
    page_titles,
    page_paragraphs,
    page_links,
    page_link_positions,
    product_urls,
    review_dates,
    review_lines,
    page_reviews,
    scraped_messages,
    rating_trend,
    sentiment_trend,
    rating_change,
    rating_smoothed,
    rating_periods,
    daily_rating_change,
    sentiment_agreement,
    stored_trend,
    stream_scored,
    stored_once,
    rejected_once,
    stream_dedup,
    stream_trend,
    stream_sentiment_trend,
)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: fit the classifier on the smoke data and name the class of every review."""
    return model_predictions(spark, SMOKE_DIR)


def _llm():
    """The queries of the llm subpackage and the pipeline, or None where they are not installed."""
    for module in ("reviewtide.llm", "corpus_pipeline"):
        spec = importlib.util.find_spec(module)
        if spec is None or spec.origin is None:  # a folder without the package has no origin
            return None
    import corpus_pipeline
    from reviewtide.llm import queries as llm_queries

    return llm_queries, corpus_pipeline


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every registered query by name."""
    found = {query.__name__: query for query in _QUERIES}
    if llm := _llm():
        found |= {**llm[0].queries(), "pipeline": llm[1].run}
    return found


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the registered queries that SQL can express."""
    found = statements()
    if llm := _llm():
        found |= llm[0].oracle_sql()
        if llm[1].ORACLE_SQL:
            found["pipeline"] = llm[1].ORACLE_SQL
    return found
