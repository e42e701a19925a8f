"""DuckDB statements that compute every registered query from the same tables."""

from __future__ import annotations

from reviewtide.functions.fixed_values import PARAGRAPH_ENDS, PARENT_ENDS, STOP_WORDS, VOCABULARY_SIZE

TOPK = 10000
TERMS_PER_CLASS = 20

_STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS)
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_CLASSES = ("Positive", "Neutral", "Negative")

_REVIEWS = """
all_reviews AS (
  SELECT d.doc_id AS review_id, d.source AS asin, d.text AS reviewText,
         split_part(d.text, chr(10), 1) AS summary,
         CAST(CASE WHEN quality = 1 AND toxic = 0 THEN 5 WHEN quality = 1 THEN 4
                   WHEN quality = 0 THEN 2 END AS FLOAT) AS overall,
         DATE '2022-11-01' + CAST(d.doc_id % 60 AS INTEGER) AS review_date,
         d.n_chars, l.doc_id IS NOT NULL AS labelled
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
),
reviews AS (
  SELECT *, CASE WHEN overall > 4 THEN 'Positive' WHEN overall > 3 THEN 'Neutral'
                 WHEN overall <= 3 THEN 'Negative' END AS sentiment,
         regexp_replace(lower(reviewText), '[^\\x00-\\x7F]', '', 'g') AS clean,
         ('0x' || substr(md5(CAST(review_id AS VARCHAR)), 1, 8))::BIGINT % 10 < 8 AS is_train
  FROM all_reviews WHERE reviewText IS NOT NULL
)"""

_WORDS = f"""
tokenised AS (
  SELECT *, CASE WHEN rtrim(clean, {_SPACE}) = '' AND clean <> '' THEN CAST([] AS VARCHAR[])
            ELSE string_split_regex(rtrim(clean, {_SPACE}), '[ \\t\\n\\x0B\\f\\r]') END AS tokens
  FROM reviews
),
worded AS (
  SELECT *, [x FOR x IN tokens IF x NOT IN ({_STOP})] AS words FROM tokenised
),
grams AS (
  SELECT *, [words[i] || ' ' || words[i + 1] FOR i IN range(1, len(words))] AS bigrams
  FROM worded
)"""

_COUNTS = """
counts AS (
  SELECT review_id, term, count(*) AS n
  FROM (SELECT review_id, unnest(bigrams) AS term FROM grams) GROUP BY review_id, term
)"""

_FIT = f"""
train AS (SELECT * FROM grams WHERE labelled AND is_train),
train_counts AS (
  SELECT review_id, sentiment, term, count(*) AS n
  FROM (SELECT review_id, sentiment, unnest(bigrams) AS term FROM train) GROUP BY ALL
),
class_docs AS (
  SELECT sentiment, count(*) AS docs, sum(length(clean)) AS chars FROM train GROUP BY sentiment
),
size AS (SELECT sum(docs) AS m, count(*) AS k FROM class_docs),
ranked AS (
  SELECT sentiment, docs, chars,
         row_number() OVER (ORDER BY docs DESC, sentiment) - 1 AS label_index
  FROM class_docs
),
vocab AS (
  SELECT term, sum(n) AS total, count(*) AS doc_freq,
         ln((SELECT m + 1 FROM size) / CAST(count(*) + 1 AS DOUBLE)) AS idf
  FROM train_counts GROUP BY term ORDER BY total DESC, term LIMIT {VOCABULARY_SIZE}
),
class_terms AS (
  SELECT c.sentiment, v.term, v.idf, coalesce(t.tf, 0) * v.idf AS s
  FROM vocab v CROSS JOIN class_docs c
  LEFT JOIN (SELECT sentiment, term, sum(n) AS tf FROM train_counts GROUP BY ALL) t
    ON t.term = v.term AND t.sentiment = c.sentiment
),
class_sums AS (
  SELECT r.sentiment, r.label_index, r.docs, r.chars,
         ln(t.s + r.chars + 1.0 * (t.v + 1)) AS bottom,
         ln(r.docs + 1.0) - ln((SELECT m + k FROM size) * 1.0) AS log_prior
  FROM ranked r JOIN (SELECT sentiment, sum(s) AS s, count(*) AS v FROM class_terms
                      GROUP BY sentiment) t USING (sentiment)
),
log_probs AS (
  SELECT t.sentiment, t.term, t.idf, ln(t.s + 1.0) - c.bottom AS log_prob
  FROM class_terms t JOIN class_sums c USING (sentiment)
)"""


def _predict(rows: str) -> str:
    return f"""
scored AS (
  SELECT g.review_id, p.sentiment, sum(p.idf * p.log_prob) AS w
  FROM (SELECT review_id, unnest(bigrams) AS term FROM {rows}) g JOIN log_probs p USING (term)
  GROUP BY ALL
),
predicted AS (
  SELECT g.review_id, g.sentiment, g.is_train, c.sentiment AS predicted_sentiment, c.label_index
  FROM {rows} g CROSS JOIN class_sums c
  LEFT JOIN scored s ON s.review_id = g.review_id AND s.sentiment = c.sentiment
  QUALIFY row_number() OVER (
    PARTITION BY g.review_id
    ORDER BY coalesce(s.w, 0) + c.log_prior + length(g.clean) * (ln(c.chars + 1.0) - c.bottom) DESC,
             c.label_index) = 1
)"""


_LABELLED = "(SELECT * FROM grams WHERE labelled)"
_PREDICT_LABELLED = ",".join([_REVIEWS, _WORDS, _FIT, _predict(_LABELLED)])
_PREDICT_ALL = ",".join([_REVIEWS, _WORDS, _FIT, _predict("grams")])

_CONFUSION = """
conf AS (
  SELECT is_train, sentiment AS label, predicted_sentiment AS prediction, count(*) AS n
  FROM predicted WHERE sentiment IS NOT NULL GROUP BY ALL
)"""

_METRICS = """
sides AS (
  SELECT is_train, label AS class, n AS support, 0 AS predicted,
         CASE WHEN label = prediction THEN n ELSE 0 END AS hits FROM conf
  UNION ALL
  SELECT is_train, prediction, 0, n, 0 FROM conf
),
sums AS (
  SELECT is_train, class, sum(support) AS support, sum(predicted) AS predicted, sum(hits) AS hits
  FROM sides GROUP BY ALL
),
rates AS (
  SELECT *, CASE WHEN predicted > 0 THEN hits / CAST(predicted AS DOUBLE) ELSE 0 END AS precision,
         CASE WHEN support > 0 THEN hits / CAST(support AS DOUBLE) ELSE 0 END AS recall
  FROM sums
),
f AS (
  SELECT *, CASE WHEN precision + recall > 0
                 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1
  FROM rates
)"""


def _framed(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"coalesce(length({text}) || ':' || {text}, '-')"


def _msg_id(*columns: str) -> str:
    return "sha256(" + " || ".join(_framed(c) for c in columns) + ")"


_MESSAGES = """
messages AS (
  SELECT review_id, asin, 'Product ' || asin AS name, CAST(n_chars AS INTEGER) AS price,
         strftime(review_date, '%Y-%m-%d') || ' 00:00:00' AS ts, review_date,
         CAST(overall AS VARCHAR) AS rating_text, overall AS rating, reviewText AS review_text
  FROM all_reviews
)"""

_MSG_ID = _msg_id("asin", "name", "NULL", "price", "ts", "rating_text", "review_text")

_RATINGS = """
ratings AS (
  SELECT event_id AS rating_id, 'P' || user_id AS asin, ts,
         least(5.0::DOUBLE, 1.0::DOUBLE + floor(value / 10.0::DOUBLE) / 2.0::DOUBLE) AS rating
  FROM events
),
trend AS (
  SELECT asin, CAST(time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01') AS DATE) AS period_start,
         count(*) AS n_reviews, avg(rating) AS avg_rating
  FROM ratings GROUP BY ALL
)"""

_PAGES = r"""
plain AS (
  SELECT page_id, url, regexp_replace(html,
    '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'g') AS html
  FROM pages
)"""


# A paragraph without a closing tag ends where one of these begins.
_P_ENDS = rf"</?(?:{'|'.join(PARAGRAPH_ENDS)})(?:[\s/][^>]*)?>|</(?:{'|'.join(PARENT_ENDS)})\s*>"


def _decoded(text: str) -> str:
    for reference, character in (
        ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"),
        ("&amp;", "&"),
    ):
        text = f"replace({text}, '{reference}', '{character}')"
    return text


def _tag_texts(tag: str) -> str:
    found = f"regexp_extract_all(html, '(?is)<{tag}(?:\\s[^>]*)?>.*?</{tag}\\s*>')"
    return f"[regexp_replace(x, '<[^>]*>', '', 'g') FOR x IN {found}]"


def _body(text: str) -> str:
    lines = f"[x FOR x IN string_split({text}, chr(10)) IF x <> '']"
    return f"array_to_string({lines}, chr(10))"


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def statements() -> dict[str, str]:
    """Query name to DuckDB SQL."""
    sql: dict[str, str] = {}

    # Preparation.
    sql["clean_reviews"] = f"""{_with(_REVIEWS)}
        SELECT review_id, clean AS processed_text, length(clean) AS length FROM reviews"""
    sql["sentiment_label"] = f"""{_with(_REVIEWS)}
        SELECT review_id, overall, sentiment FROM reviews"""
    sql["sentiment_counts"] = f"""{_with(_REVIEWS)}
        SELECT sentiment, count(*) AS n FROM reviews GROUP BY sentiment"""
    sql["train_test_split"] = f"""{_with(_REVIEWS)}
        SELECT review_id, is_train FROM reviews"""
    sql["label_index"] = f"""{_with(_REVIEWS)}
        SELECT sentiment, CAST(row_number() OVER (ORDER BY count(*) DESC, sentiment) - 1 AS DOUBLE)
               AS label_index, count(*) AS n
        FROM reviews WHERE sentiment IS NOT NULL GROUP BY sentiment"""
    sql["review_msg_id"] = f"""{_with(_REVIEWS)}
        SELECT review_id, {_msg_id("asin", "overall", "review_date", "reviewText")} AS msg_id
        FROM all_reviews"""
    sql["json_roundtrip"] = f"""{_with(_REVIEWS)}
        SELECT overall, reviewText AS review_text, summary FROM all_reviews"""
    sql["reduced_dump"] = sql["json_roundtrip"]
    sql["bounded_files"] = f"""{_with(_REVIEWS)}
        SELECT overall, reviewText AS review_text, summary, TRUE AS fits FROM all_reviews"""
    sql["review_ids"] = f"""{_with(_REVIEWS)}
        SELECT review_id, review_date, row_number() OVER (ORDER BY review_date, review_id) AS dense_id
        FROM all_reviews"""
    sql["message_roundtrip"] = f"""{_with(_REVIEWS, _MESSAGES)}
        SELECT {_MSG_ID} AS msg_id, asin, name, 'Electronics' AS category,
               CAST(price AS DOUBLE) AS price, review_date, rating, review_text FROM messages"""

    # Text features.
    sql["tokens"] = f"""{_with(_REVIEWS, _WORDS)}
        SELECT review_id, len(tokens) AS n_tokens, array_to_string(tokens, '|') AS tokens FROM grams"""
    sql["tokens_no_stop"] = f"""{_with(_REVIEWS, _WORDS)}
        SELECT review_id, len(words) AS n_words, array_to_string(words, '|') AS words FROM grams"""
    sql["bigrams"] = f"""{_with(_REVIEWS, _WORDS)}
        SELECT review_id, len(bigrams) AS n_bigrams, array_to_string(bigrams, '|') AS bigrams
        FROM grams"""
    sql["term_counts"] = f"""{_with(_REVIEWS, _WORDS, _COUNTS)}
        SELECT review_id, term, n FROM counts"""
    sql["vocabulary_topk"] = f"""{_with(_REVIEWS, _WORDS, _COUNTS)}
        SELECT term, CAST(sum(n) AS BIGINT) AS total FROM counts GROUP BY term
        ORDER BY total DESC, term LIMIT {TOPK}"""
    idf = "ln(((SELECT count(*) FROM reviews) + 1) / CAST(count(*) + 1 AS DOUBLE))"
    sql["idf_weights"] = f"""{_with(_REVIEWS, _WORDS, _COUNTS)}
        SELECT term, count(*) AS doc_freq, round({idf}, 6) AS idf FROM counts GROUP BY term"""
    sql["tfidf_terms"] = f"""{_with(_REVIEWS, _WORDS, _COUNTS)},
        idf AS (SELECT term, {idf} AS idf FROM counts GROUP BY term)
        SELECT review_id, term, round(n * idf, 6) AS value FROM counts JOIN idf USING (term)
        UNION ALL
        SELECT review_id, NULL, CAST(length(clean) AS DOUBLE) FROM reviews"""

    # Classifier.
    fit = _with(_REVIEWS, _WORDS, _FIT)
    sql["nb_priors"] = f"""{fit}
        SELECT sentiment, docs, round(log_prior, 6) AS log_prior FROM class_sums"""
    sql["nb_term_logprob"] = f"""{fit}
        SELECT sentiment, term, round(log_prob, 5) AS log_prob FROM log_probs"""
    predictions = f"""WITH {_PREDICT_ALL}
        SELECT review_id, sentiment, predicted_sentiment,
               CAST(label_index AS DOUBLE) AS prediction FROM predicted"""
    sql["nb_predictions"] = predictions
    sql["model_predictions"] = predictions
    sql["staged_predictions"] = predictions
    sql["reloaded_predictions"] = predictions
    confusion = f"WITH {_PREDICT_LABELLED}, {_CONFUSION}"
    sql["confusion"] = f"{confusion} SELECT * FROM conf"
    sql["class_metrics"] = f"""{confusion}, {_METRICS}
        SELECT is_train, class, CAST(support AS BIGINT) AS support, CAST(hits AS BIGINT) AS hits,
               round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1
        FROM f"""
    sql["classifier_metrics"] = f"""{confusion}, {_METRICS}
        SELECT is_train, CAST(sum(support) AS BIGINT) AS n,
               round(sum(hits) / CAST(sum(support) AS DOUBLE), 6) AS accuracy,
               round(sum(support * precision) / sum(support), 6) AS weighted_precision,
               round(sum(support * recall) / sum(support), 6) AS weighted_recall,
               round(sum(support * f1) / sum(support), 6) AS weighted_f1
        FROM f GROUP BY is_train"""
    sql["prediction_rmse"] = f"""{confusion}
        SELECT c.is_train, CAST(sum(c.n) AS BIGINT) AS n,
               round(sqrt(sum(c.n * pow(p.label_index - l.label_index, 2)) / sum(c.n)), 6) AS rmse
        FROM conf c JOIN ranked p ON p.sentiment = c.prediction
                    JOIN ranked l ON l.sentiment = c.label
        GROUP BY c.is_train"""
    sql["top_terms_per_class"] = f"""{fit},
        ratios AS (
          SELECT sentiment, term, round(log_prob - (sum(log_prob) OVER (PARTITION BY term) - log_prob)
                 / ((SELECT k FROM size) - 1), 6) AS log_ratio FROM log_probs
        )
        SELECT sentiment, row_number() OVER (PARTITION BY sentiment ORDER BY log_ratio DESC, term)
               AS rank, term, log_ratio
        FROM ratios QUALIFY rank <= {TERMS_PER_CLASS}"""

    # Scoring and storing.
    scored = f"""WITH {_PREDICT_ALL}, {_MESSAGES}
        SELECT {_MSG_ID} AS msg_id, m.asin, m.name, m.review_date, m.rating,
               p.predicted_sentiment AS sentiment
        FROM messages m LEFT JOIN predicted p USING (review_id)"""
    sql["scored_reviews"] = scored
    sql["stored_reviews"] = f"""{_with(_REVIEWS, _MESSAGES)}
        SELECT {_MSG_ID} AS msg_id, m.asin, m.name, 'Electronics' AS category,
               CAST(m.price AS DOUBLE) AS price, m.review_date, m.rating, m.review_text,
               CASE WHEN rating > 4 THEN 'Positive' WHEN rating > 3 THEN 'Neutral'
                    WHEN rating <= 3 THEN 'Negative' END AS sentiment
        FROM messages m"""
    sql["quality_rejects"] = """
        WITH raw AS (
          SELECT d.doc_id AS review_id, d.source || '-' || d.lang || '-' || d.doc_id AS asin,
                 CAST(d.n_chars AS INTEGER) AS price,
                 TRY_CAST('2022-11-' || lpad(CAST(d.doc_id % 60 + 1 AS VARCHAR), 2, '0') AS DATE)
                   AS review_date,
                 TRY_CAST(CASE WHEN quality = 1 THEN '5' WHEN toxic = 1 THEN 'one'
                               ELSE CAST(quality AS VARCHAR) END AS FLOAT) AS rating
          FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
        ),
        checked AS (
          SELECT *, concat_ws(',', CASE WHEN review_date IS NULL THEN 'date_missing' END,
                                   CASE WHEN rating IS NULL THEN 'rating_missing' END,
                                   CASE WHEN length(asin) > 10 THEN 'asin_too_long' END) AS reasons
          FROM raw
        )
        SELECT review_id, asin, price, review_date, rating, reasons FROM checked
        WHERE reasons <> ''"""
    checked = """
        WITH raw AS (
          SELECT doc_id AS review_id, doc_id % 47 = 23 AS cut,
                 CASE WHEN doc_id % 11 = 5 THEN ' ' WHEN doc_id % 13 = 6
                      THEN source || '-' || lang || '-' || doc_id || '-long' ELSE source END AS asin,
                 CASE WHEN doc_id % 17 <> 8 THEN 'Product ' || source END AS name,
                 CASE WHEN doc_id % 19 = 9 THEN repeat('c', 151) ELSE 'Electronics' END AS category,
                 CASE WHEN doc_id % 23 = 11 THEN -5 WHEN doc_id % 29 <> 14 THEN CAST(n_chars AS INTEGER) END AS price,
                 CASE WHEN doc_id % 31 <> 15 THEN DATE '2022-11-01' + CAST(doc_id % 30 AS INTEGER) END AS review_date,
                 CAST(CASE WHEN doc_id % 37 = 18 THEN 11 WHEN doc_id % 41 <> 20 THEN doc_id % 5 + 1 END AS FLOAT) AS rating,
                 CASE WHEN doc_id % 43 <> 21 THEN text END AS review_text
          FROM documents
        ),
        checked AS (
          SELECT *, concat_ws(',', CASE WHEN coalesce(trim(asin), '') = '' THEN 'asin_empty' END,
            CASE WHEN length(asin) > 10 THEN 'asin_too_long' END,
            CASE WHEN length(category) > 150 THEN 'category_too_long' END,
            CASE WHEN review_date IS NULL THEN 'date_missing' END, CASE WHEN name IS NULL THEN 'name_missing' END,
            CASE WHEN price IS NULL THEN 'price_missing' END, CASE WHEN price < 0 THEN 'price_negative' END,
            CASE WHEN rating IS NULL THEN 'rating_missing' END,
            CASE WHEN rating > 9.9 THEN 'rating_out_of_range' END,
            CASE WHEN review_text IS NULL THEN 'text_missing' END, CASE WHEN cut THEN 'unreadable' END) AS reasons
          FROM raw
        )"""
    sql["quality_valid"] = f"""{checked}
        SELECT review_id, asin, name, category, price, review_date, rating, review_text FROM checked WHERE reasons = ''"""
    sql["quality_reasons"] = f"{checked} SELECT review_id, reasons FROM checked WHERE reasons <> ''"
    sql["recent_reviews"] = f"""{_with(_REVIEWS)}
        SELECT review_id, review_date, review_date - 3 AS three_days_before FROM all_reviews
        WHERE CAST(review_date AS TIMESTAMP) > TIMESTAMP '2022-12-25 00:00:00' - INTERVAL 30 DAY"""

    # Stored pages.
    sql["page_titles"] = f"""{_with(_PAGES)}
        SELECT page_id, {_decoded(_tag_texts("title") + "[1]")} AS title FROM plain"""
    sql["page_paragraphs"] = f"""{_with(_PAGES)},
        closed AS (SELECT page_id, regexp_replace(html, '(?i)({_P_ENDS})', '</p>\\1', 'g') AS html FROM plain),
        found AS (SELECT page_id, {_tag_texts("p")} AS ps FROM closed)
        SELECT page_id, pos, {_decoded("ps[pos + 1]")} AS paragraph
        FROM (SELECT page_id, ps, unnest(range(len(ps))) AS pos FROM found)"""
    links = "regexp_extract_all(html, '(?is)<a\\s[^>]*?href=\"([^\"]*)\"', 1)"
    sql["page_links"] = f"""{_with(_PAGES)}
        SELECT href, count(*) AS n, count(DISTINCT page_id) AS n_pages
        FROM (SELECT page_id, unnest({links}) AS href FROM plain) GROUP BY href"""
    sql["page_link_positions"] = f"""{_with(_PAGES)},
        found AS (SELECT page_id, {links} AS hrefs, {_tag_texts("a")} AS texts FROM plain)
        SELECT page_id, pos, hrefs[pos + 1] AS href, {_decoded("texts[pos + 1]")} AS link_text
        FROM (SELECT *, unnest(range(greatest(len(hrefs), len(texts)))) AS pos FROM found)"""
    sql["product_urls"] = """
        SELECT doc_id AS page_id, 'https://shop.example/s?k=' || source || '&s=review-rank' AS search_url,
               'https://shop.example/dp/' || doc_id || '?a=1&b=2' AS product_url,
               'https://shop.example/reviews/' || doc_id || '?a=1&b=2&sortBy=recent&pageNumber=1' AS review_url
        FROM documents"""
    sql["review_dates"] = f"""{_with(_REVIEWS)}
        SELECT review_id, review_date FROM all_reviews"""
    sql["review_lines"] = f"""{_with(_REVIEWS)},
        texts AS (
          SELECT review_id AS page_id, [x FOR x IN string_split(reviewText, chr(10))
                 || string_split(summary, chr(10)) IF x <> ''] AS lines
          FROM all_reviews
        )
        SELECT page_id, pos, lines[pos + 1] AS line
        FROM (SELECT *, unnest(range(len(lines))) AS pos FROM texts)"""
    # The third review of a page has no text, some pages no dates, and documents without a label no rating.
    sql["page_reviews"] = f"""{_with(_REVIEWS)},
        entries AS (
          SELECT review_id AS page_id, asin, pos, length(reviewText) AS price,
                 CASE WHEN review_id % 11 <> 5 THEN review_date + CAST(pos AS INTEGER) END AS review_date, overall,
                 CASE WHEN pos = 0 THEN reviewText WHEN pos = 1 THEN summary END AS text
          FROM all_reviews, range(3) positions(pos)
        )
        SELECT page_id, asin, pos, price, review_date, CAST(overall AS INTEGER) AS rating,
               CASE WHEN pos < 2 THEN coalesce({_body("text")}, '') END AS review_content
        FROM entries"""

    shown = sql["page_reviews"]
    sql["scraped_messages"] = f"""
        SELECT asin, 'Product ' || asin AS name, 'Electronics' AS category, CAST(price AS DOUBLE) AS price,
               review_date, CAST(rating AS FLOAT) AS rating, review_content AS review_text
        FROM ({shown})
        WHERE CAST(review_date AS TIMESTAMP) > TIMESTAMP '2022-12-25 00:00:00' - INTERVAL 30 DAY"""

    # Trends.
    trends = _with(_RATINGS)
    sql["rating_trend"] = f"""{trends}
        SELECT asin, period_start, n_reviews, round(avg_rating, 6) AS avg_rating FROM trend"""
    sql["sentiment_trend"] = f"""{trends},
        classed AS (
          SELECT asin, CAST(time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01') AS DATE)
                   AS period_start,
                 CASE WHEN rating > 4 THEN 'Positive' WHEN rating > 3 THEN 'Neutral'
                      WHEN rating <= 3 THEN 'Negative' END AS sentiment
          FROM ratings
        )
        SELECT asin, period_start, count(*) AS n_reviews,
               {", ".join(f"count(*) FILTER (sentiment = '{c}') AS n_{c.lower()}" for c in _CLASSES)},
               {", ".join(f"round(count(*) FILTER (sentiment = '{c}') / CAST(count(*) AS DOUBLE), 6) AS share_{c.lower()}" for c in _CLASSES)}
        FROM classed WHERE sentiment IS NOT NULL GROUP BY asin, period_start"""
    # Every period of the calendar between a product's first and last, so that neighbours are neighbours in time.
    def spine_of(days: int) -> str:
        start = f"CAST(time_bucket(INTERVAL {days} DAY, ts, TIMESTAMP '1970-01-01') AS DATE)"
        return f"""{trends}, periods AS (SELECT asin, {start} AS period_start, count(*) AS n_reviews, avg(rating) AS avg_rating
          FROM ratings GROUP BY ALL),
        ends AS (SELECT asin, min(period_start) AS f, max(period_start) AS l FROM periods GROUP BY asin),
        days AS (SELECT asin, unnest(generate_series(f, l, INTERVAL {days} DAY)) AS day FROM ends),
        spine AS (SELECT days.asin, CAST(day AS DATE) AS period_start, n_reviews, avg_rating
          FROM days LEFT JOIN periods p ON p.asin = days.asin AND p.period_start = CAST(day AS DATE))"""

    spine = spine_of(7)
    order = "OVER (PARTITION BY asin ORDER BY period_start"
    sql["rating_change"] = f"""{spine},
        changed AS (SELECT asin, period_start, avg_rating, n_reviews, lag(avg_rating) {order}) AS before FROM spine)
        SELECT asin, period_start, round(avg_rating, 6) AS avg_rating, round(before, 6) AS previous_rating,
               round(avg_rating - before, 6) AS rating_change
        FROM changed WHERE n_reviews IS NOT NULL"""
    sql["rating_smoothed"] = f"""{spine},
        smoothed AS (SELECT asin, period_start, avg_rating, n_reviews,
               avg(avg_rating) {order} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS smooth FROM spine)
        SELECT asin, period_start, round(avg_rating, 6) AS avg_rating, round(smooth, 6) AS smoothed_rating
        FROM smoothed WHERE n_reviews IS NOT NULL"""
    sql["rating_periods"] = f"""{spine_of(1)}
        SELECT asin, period_start, coalesce(n_reviews, 0) AS n_reviews, round(avg_rating, 6) AS avg_rating FROM spine"""
    sql["daily_rating_change"] = f"""{spine_of(1)},
        changed AS (SELECT *, lag(avg_rating) {order}) AS before,
               avg(avg_rating) {order} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS smooth FROM spine)
        SELECT asin, period_start, round(avg_rating, 6) AS avg_rating, round(before, 6) AS previous_rating,
               round(avg_rating - before, 6) AS rating_change, round(smooth, 6) AS smoothed_rating
        FROM changed WHERE n_reviews IS NOT NULL"""
    sql["sentiment_agreement"] = f"""WITH {_PREDICT_LABELLED}
        SELECT r.asin, count(*) AS n_reviews,
               count(*) FILTER (p.predicted_sentiment = p.sentiment) AS n_agree,
               round(count(*) FILTER (p.predicted_sentiment = p.sentiment)
                     / CAST(count(*) AS DOUBLE), 6) AS agreement
        FROM predicted p JOIN all_reviews r USING (review_id)
        WHERE p.sentiment IS NOT NULL GROUP BY r.asin"""

    sql["stored_trend"] = f"""{_with(_REVIEWS)}
        SELECT asin, CAST(time_bucket(INTERVAL 28 DAY, CAST(review_date AS TIMESTAMP),
                                      TIMESTAMP '1970-01-01') AS DATE) AS period_start,
               count(*) AS n_reviews, round(avg(overall), 6) AS avg_rating
        FROM all_reviews WHERE overall IS NOT NULL GROUP BY asin, period_start"""

    # Streams give what the batch gives.
    # A stream scores a message once, however often it is delivered.
    sql["stream_scored"] = f"SELECT DISTINCT * FROM ({scored})"
    sql["stored_twice"] = sql["stored_reviews"]
    sql["stored_compacted"] = sql["stored_reviews"]
    # A message is its raw fields; equal ones are one message, and a cut line is none of them.
    wire = checked.replace("CASE WHEN cut THEN 'unreadable' END", "NULL")
    sql["stored_once"] = f"""{wire}, {_PREDICT_ALL}
        SELECT DISTINCT c.asin, c.name, c.category, CAST(c.price AS DOUBLE) AS price, c.review_date, c.rating,
               c.review_text, p.predicted_sentiment AS sentiment
        FROM checked c LEFT JOIN predicted p USING (review_id) WHERE c.reasons = ''"""
    sql["rejected_once"] = f"""{wire}, kinds AS (
          SELECT DISTINCT asin, name, category, price, review_date, rating, review_text, reasons,
                 CASE WHEN doc_id % 41 = 20 AND doc_id % 37 <> 18 THEN 'one' END AS raw_rating
          FROM checked JOIN documents ON review_id = doc_id WHERE reasons <> '')
        SELECT asin, name, category, CAST(price AS DOUBLE) AS price, review_text, reasons FROM kinds"""
    sql["unreadable_lines"] = f"""{_with(_REVIEWS)},
        written AS (
          SELECT *, CAST(to_json({{'overall': review_id, 'reviewText': reviewText, 'summary': summary}}) AS VARCHAR)
                 AS line FROM all_reviews
        )
        SELECT review_id AS overall, reviewText AS review_text, summary, NULL AS line
        FROM written WHERE review_id % 7 <> 0
        UNION ALL
        SELECT NULL, NULL, NULL, left(line, -3) FROM written WHERE review_id % 7 = 0"""
    sql["stream_dedup"] = f"""{_with(_REVIEWS, _MESSAGES)}
        SELECT DISTINCT {_MSG_ID} AS msg_id, asin, review_date, review_text FROM messages"""
    sql["stream_trend"] = sql["rating_trend"]
    sql["stream_sentiment_trend"] = sql["sentiment_trend"]
    return sql
