"""Product-review sentiment and rating trends on Spark."""

from reviewtide.functions.html import (
    attr_values,
    nested_tag_texts,
    review_bodies,
    review_dates,
    review_ratings,
    review_texts,
    tag_texts,
)
from reviewtide.functions.ratings import day_of, parse_price, sentiment_of, shift_days
from reviewtide.operators.attach import attach_predictions, attach_products
from reviewtide.operators.bayes import log_probabilities, nb_fit, nb_predict, priors, top_terms
from reviewtide.operators.evaluate import class_metrics, confusion, metrics, rmse
from reviewtide.operators.extract import (
    explode_reviews,
    page_link,
    page_price,
    product_urls,
    review_lines,
    review_lists,
    review_messages,
)
from reviewtide.operators.features import (
    document_frequencies,
    idf_weights,
    remove_stop_words,
    term_counts,
    tfidf,
    tfidf_terms,
    vocabulary,
    with_ngrams,
    with_tokens,
)
from reviewtide.operators.prepare import (
    label_index,
    prepare_text,
    random_split,
    recent,
    sentiment_counts,
    split_by_key,
    with_sentiment,
)
from reviewtide.operators.quality import check_quality, stored_review_rules, tag_quality
from reviewtide.operators.trends import (
    every_period,
    rating_change,
    rating_smoothed,
    rating_trend,
    sentiment_agreement,
    sentiment_trend,
)
from reviewtide.plans.training import (
    build_pipeline,
    fit_pipeline,
    fit_stages,
    load_model,
    name_predictions,
    save_model,
    score,
    score_messages,
)
from reviewtide.sources.messages import (
    decode_messages,
    encode_messages,
    normalise_types,
    read_messages,
    send_messages,
    with_msg_id,
)
from reviewtide.sources.reviews import read_pages, read_reviews, unreadable_lines, write_reviews
from reviewtide.sources.store import append_once, append_rejects, append_scored, compact_scored, preview, read_scored
from reviewtide.streaming.dedup import stream_dedup
from reviewtide.streaming.score import scored_stream, stream_score
from reviewtide.streaming.trend import fold_trend, read_trend, stream_trend, write_trend
