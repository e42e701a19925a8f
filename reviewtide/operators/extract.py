"""Reviews from stored review pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewtide.functions import html as H
from reviewtide.functions.fixed_values import (
    PRICE_CLASS,
    RATING_LINK_CLASS,
    RATING_TITLE_MARK,
    REVIEW_BLOCK_CLASS,
    REVIEW_DATE_CLASS,
    REVIEW_ORDER,
    REVIEW_TEXT_CLASS,
    SEARCH_ORDER,
    SEARCH_PATH,
)
from reviewtide.functions.ratings import parse_price


_BLOCK = "div"


def review_lists(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add the aligned arrays ``dates``, ``ratings`` and ``bodies`` and drop the page itself.

    The page is cut into the containers of its reviews first, and each gives its own first date,
    rating and body, null where it has none. So a review that lacks one does not shift the
    others, and highlighted reviews outside the containers do not count.

    On a page without containers the parts are paired by position: the first two dates belong
    to highlighted reviews and are left out, and the lists are aligned at their ends, which is
    right whether or not the highlighted reviews also brought a rating and a body.
    """

    page = F.col(html)
    names = ("dates", "ratings", "bodies")
    units = H.let(H.blocks(page, _BLOCK, REVIEW_BLOCK_CLASS), lambda found: _units(page, found))
    rest = [c for c in pages.columns if c != html]
    found = pages.select(*rest, H.let(units, _reviews).alias("_found"))
    return found.select(*rest, *[F.col(f"_found.{c}").alias(c) for c in names])


def _units(page: Column, blocks: Column) -> Column:
    """Whether a page has containers, and per container, or of the whole page, all dates, ratings and bodies."""

    def parts(tokens: Column) -> Column:
        titles = H.link_titles(tokens, RATING_LINK_CLASS)
        found = (
            H.outer_texts(tokens, "span", REVIEW_DATE_CLASS, _BLOCK),
            F.filter(titles, lambda t: F.contains(t, F.lit(RATING_TITLE_MARK))),
            H.outer_texts(tokens, "span", REVIEW_TEXT_CLASS, _BLOCK),
        )
        return F.transform(F.array(*found), lambda texts: H.decoded_texts(texts))

    by_block = F.size(blocks) > 0
    pieces = F.when(by_block, blocks).otherwise(F.array(H.without_noise(page)))
    return F.struct(by_block.alias("by_block"), F.transform(pieces, lambda piece: H.let(H.tokens_of(piece), parts)).alias("parts"))


def _reviews(units: Column) -> Column:
    """The three lists: the first part of each kind of every container, or the parts of the page aligned at their ends."""
    whole = units["parts"][0]
    shown = H.without_leading(whole[0])
    positions = (shown, _last(whole[1], F.size(shown)), _last(whole[2], F.size(shown)))

    def chosen(kind: int) -> Column:
        firsts = F.transform(units["parts"], lambda parts: F.get(parts[kind], F.lit(0)))
        return F.when(units["by_block"], firsts).otherwise(positions[kind])

    return F.struct(
        H.review_dates(chosen(0)).alias("dates"), H.review_ratings(chosen(1)).alias("ratings"), H.review_bodies(chosen(2)).alias("bodies")
    )


def review_lines(html: Column) -> Column:
    """All non-blank lines of the reviews on a page."""
    bodies = H.let(H.page_tokens(html), lambda tokens: H.outer_texts(tokens, "span", REVIEW_TEXT_CLASS, _BLOCK))
    return H.review_texts(H.decoded_texts(bodies))


def _last(values: Column, n: Column) -> Column:
    """The last ``n`` entries; the array itself when it is shorter."""
    extra = F.greatest(F.size(values) - n, F.lit(0))
    return F.slice(values, extra + 1, F.greatest(n, F.lit(0)))


def explode_reviews(lists: DataFrame) -> DataFrame:
    """One row per review: ``pos``, ``review_date``, ``rating``, ``review_content``.

    Entries are paired by position before any filter, so dropping old reviews later cannot
    shift ratings or texts. Where a list is shorter the value is null and the quality rules
    reject the row.
    """
    rest = [c for c in lists.columns if c not in ("dates", "ratings", "bodies")]
    zipped = F.arrays_zip(
        F.col("dates").alias("dates"),
        F.col("ratings").alias("ratings"),
        F.col("bodies").alias("bodies"),
    )
    rows = lists.select(*rest, F.posexplode(zipped).alias("pos", "review"))
    return rows.select(
        *rest,
        "pos",
        F.col("review.dates").alias("review_date"),
        F.col("review.ratings").alias("rating"),
        F.col("review.bodies").alias("review_content"),
    )


def page_price(html: Column) -> Column:
    """First whole price on the page, as an integer."""
    return parse_price(F.get(H.tag_texts(html, "span", PRICE_CLASS), F.lit(0)))


def page_link(html: Column, cls: str) -> Column:
    """Address of the first link of a class, null without one."""
    return F.get(H.attr_values(html, "a", "href", cls), F.lit(0))


def product_urls(
    df: DataFrame, base_url: str, asin: str = "asin", product: str = "product_href", review: str = "review_href"
) -> DataFrame:
    """Add the search address of a product, and its product and review addresses where the
    columns with their links are there.

    The search page links the product (``page_link`` with ``PRODUCT_LINK_CLASS``), the product
    page its reviews (``REVIEW_LINK_CLASS``).
    """
    base = F.lit(base_url.rstrip("/"))
    df = df.withColumn("search_url", F.concat(base, F.lit(SEARCH_PATH), asin, F.lit(SEARCH_ORDER)))
    if product in df.columns:
        df = df.withColumn("product_url", F.concat(base, product))
    if review in df.columns:
        df = df.withColumn("review_url", F.concat(base, F.col(review), F.lit(REVIEW_ORDER)))
    return df


def review_messages(reviews: DataFrame) -> DataFrame:
    """The message record of an extracted review."""
    return reviews.select(
        "asin",
        "name",
        "price",
        F.date_format("review_date", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        "rating",
        "review_content",
    )
