"""Fixed values that decide results and therefore must not vary.

Class names and rating bounds, the English stop words (identical to the default
list of ``pyspark.ml.feature.StopWordsRemover``), the class attributes of the
review-page layout, column limits of the stored table and date formats.
"""

# Sentiment classes: rating > 4 Positive, (3, 4] Neutral, <= 3 Negative.
POSITIVE = "Positive"
NEUTRAL = "Neutral"
NEGATIVE = "Negative"
SENTIMENTS = (POSITIVE, NEUTRAL, NEGATIVE)
POSITIVE_ABOVE = 4.0
NEUTRAL_ABOVE = 3.0

# Classifier settings.
NGRAM_SIZE = 2
VOCABULARY_SIZE = 262144
SMOOTHING = 1.0
TRAIN_PERCENT = 80

# Column names of the fitted pipeline.
CLEAN_TEXT = "processedReviewText"
LENGTH = "length"
SENTIMENT = "sentiment"
LABEL = "label"
TOKENS = "tokenised_text"
WORDS = "tokenised_text_without_stop_words"
NGRAMS = "nGrams"
COUNTS = "c_vectorized_review"
TFIDF = "tf_idf_reviews"
FEATURES = "features"

# Whitespace as Java's \s and therefore the ML tokenizer sees it.
WHITESPACE = " \t\n\x0b\f\r"

# The 181 English stop words, in the order of Spark's default list.
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his "
    "himself she her hers herself it its itself they them their theirs themselves what which "
    "who whom this that these those am is are was were be been being have has had having do "
    "does did doing a an the and but if or because as until while of at by for with about "
    "against between into through during before after above below to from up down in out on "
    "off over under again further then once here there when where why how all any both each "
    "few more most other some such no nor not only own same so than too very s t can will "
    "just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd "
    "they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't "
    "wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't "
    "mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's "
    "where's who's why's would"
).split()

# Class attributes of the review-page layout.
REVIEW_DATE_CLASS = "a-size-base a-color-secondary review-date"
REVIEW_TEXT_CLASS = "a-size-base review-text review-text-content"
RATING_LINK_CLASS = "a-link-normal"
RATING_TITLE_MARK = "out"
REVIEW_BLOCK_CLASS = "review"
PRICE_CLASS = "a-price-whole"
PRODUCT_LINK_CLASS = "a-link-normal s-underline-text s-underline-link-text s-link-style a-text-normal"
REVIEW_LINK_CLASS = "a-link-emphasis a-text-bold"
SEARCH_PATH = "/s?k="
SEARCH_ORDER = "&s=review-rank"
REVIEW_ORDER = "&sortBy=recent&pageNumber=1"
LEADING_DATES = 2

# Limits of the stored-review table.
MAX_ASIN_CHARS = 10
MAX_CATEGORY_CHARS = 150
PRICE_TYPE = "decimal(10,2)"
MAX_RATING = 9.9
DEFAULT_CATEGORY = "Electronics"

# Formats.
DAY_FORMAT = "yyyy-MM-dd"
REVIEW_DATE_FORMAT = "MMMM d, yyyy"

# Tags before which an open paragraph ends, as the HTML standard lists them, and the further end tags.
PARAGRAPH_ENDS = (
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul"
).split()
PARENT_ENDS = "body html button caption dd dt li object td th".split()
