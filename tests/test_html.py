import datetime
import html as standard
import random
import time
from html.parser import HTMLParser

from pyspark.sql import functions as F

import reviewtide as rt
from reviewtide.functions.fixed_values import REVIEW_DATE_CLASS as DATE
from reviewtide.functions.fixed_values import REVIEW_TEXT_CLASS as BODY


def date(text):
    return f'<span class="{DATE}">Reviewed in Canada on {text}</span>'


def stars(n):
    return f'<a class="a-link-normal" title="{n}.0 out of 5 stars" href="/r"><i>x</i></a>'


def body(text):
    return f'<span data-hook="b" class="{BODY}">\n  <span>{text}</span>\n</span>'.replace("\n  ", "\n")


def one(spark, html, column):
    df = spark.createDataFrame([(html,)], "html string")
    return df.select(column(F.col("html"))).first()[0]


def test_tag_texts_by_class(spark):
    html = (
        '<p class="x y">one <b>bold</b></p><P CLASS=\'y\'>two &amp;lt; &quot;q&quot;</P>'
        '<p title="a>b" class=z>three</p><pre>no</pre><!-- <p class="y">hidden</p> -->'
        '<script>var t="<p class=y>no</p>";</script><p>four</p>'
    )
    texts = one(spark, html, lambda h: rt.tag_texts(h, "p"))
    assert texts == ["one bold", 'two &lt; "q"', "three", "four"]
    assert one(spark, html, lambda h: rt.tag_texts(h, "p", "y")) == ["one bold", 'two &lt; "q"']
    assert one(spark, html, lambda h: rt.tag_texts(h, "p", "x y")) == ["one bold"]
    assert one(spark, html, lambda h: rt.tag_texts(h, "p", "y x")) == []
    assert one(spark, html, lambda h: rt.tag_texts(h, "p", "z")) == ["three"]
    assert one(spark, html, lambda h: rt.nested_tag_texts(h, "p")) == texts


def test_attr_values(spark):
    html = (
        '<a href="/1" title="t">x</a><a class=\'k\' href=\'/2\'>y</a><a data-href="/no">z</a>'
        '<a href=/3 class="k l">w</a><area href="/no"><a\nhref = "/4?a=1&amp;b=2">v</a>'
    )
    assert one(spark, html, lambda h: rt.attr_values(h, "a", "href")) == [
        "/1", "/2", "/3", "/4?a=1&b=2",
    ]
    assert one(spark, html, lambda h: rt.attr_values(h, "a", "href", "k")) == ["/2", "/3"]
    assert one(spark, html, lambda h: rt.attr_values(h, "a", "title")) == ["t"]


def test_odd_attributes(spark):
    html = (
        '<a title="see href=/no" disabled href="/1">x</a><a disabled>y</a><a href="">z</a>'
        "<a hrefx='/no' HREF='/2\n3'>w</a><a " + "k=v " * 20000 + 'href="/4" ' + "d " * 20000 + ">v</a>"
    )
    assert one(spark, html, lambda h: rt.attr_values(h, "a", "href")) == ["/1", "", "/2\n3", "/4"]
    assert one(spark, html, lambda h: rt.tag_texts(h, "a")) == ["x", "y", "z", "w", "v"]


def test_nested_tags_keep_their_whole_text(spark):
    html = body("first <span>inner</span> last") + "<span>other</span>"
    assert one(spark, html, lambda h: rt.nested_tag_texts(h, "span", BODY)) == [
        "\nfirst inner last\n"
    ]
    assert one(spark, "<p>open<p>again</p></p>tail", lambda h: rt.nested_tag_texts(h, "p")) == [
        "open", "again",
    ]
    assert one(spark, None, lambda h: rt.nested_tag_texts(h, "p")) is None
    assert one(spark, None, lambda h: rt.tag_texts(h, "div")) is None


PAGES = [
    "", "plain", "<div><p>one<p>two</div><p>three</p>", "<p>a<b>b<br><p>c</p>d</b><h1>e</h1>f",
    "<ul><li>1<li>2<ul><li>x<li>y</ul><li>3</ul><li>4", "<ul><li>1</li><li>2</li></ul>",
    "<span class=k>out<span class='k j'>in</span></span><span>no</span>", "<span>never closed <b>x",
    "<span class=o><span class=k>in</span></span>", "<div>a<div>b<div>c</div>d</div></div>",
    "<table><tr><td>1<td>2<tr><td>3</table>", "<dl><dt>t<dd>d<dt>u</dl>",
    "<p>it&#8217;s caf&eacute; &#x27;x&#x27; &amp;eacute; &copy 1 &lt;b&gt; a & b</p><span>&hearts;</span>",
    "<!-- <p>no --><p>yes<!-- never closed <p>no</p>", "<script>'<p>no</p>'</script><p>yes</p><style>p{}",
]


class Texts(HTMLParser):
    """Texts of all elements of one tag and class, with the standard library's parser."""

    def __init__(self, tag, cls):
        super().__init__(convert_charrefs=True)
        self.wanted, self.open, self.found = (tag, cls), [], []

    def leave(self, size):
        del self.open[size:]

    def handle_starttag(self, name, attrs):
        from reviewtide.functions.html import _IMPLIED, _VOID_TAGS

        closes, scope = _IMPLIED.get(name, ((), ()))
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] in closes:
                self.leave(i)
                break
            if self.open[i][0] in scope:
                break
        if name in _VOID_TAGS:
            return
        tag, cls = self.wanted
        classes = (dict(attrs).get("class") or "").split()
        fits = name == tag and (cls is None or cls in classes)
        self.open.append((name, len(self.found) if fits else None))
        if fits:
            self.found.append("")

    def handle_endtag(self, name):
        places = [i for i, (n, _) in enumerate(self.open) if n == name]
        if places:
            self.leave(places[-1])

    def handle_data(self, data):
        for name, slot in self.open:
            if slot is not None and self.open[-1][0] not in ("script", "style"):
                self.found[slot] += data


def parsed(page, tag, cls):
    import re

    from reviewtide.functions.html import _NOISE

    parser = Texts(tag, cls)
    parser.feed(re.sub(_NOISE.replace(r"\z", r"\Z"), "", page))
    parser.close()
    return parser.found


def test_expression_path_equals_the_parser(spark):
    rng = random.Random(6)
    tags = ["p", "li", "ul", "span", 'span class="k j"', "div", "td", "tr", "table", "a href=/x", "h1", "br", "b", "div class=k", "dt", "dl"]
    soup = [
        "".join(
            rng.choice([f"<{t}>", f"</{t.split()[0]}>", "text &amp; ", "x"]) for t in rng.choices(tags, k=rng.randrange(1, 40))
        )
        for _ in range(150)
    ]
    pages = [*PAGES, *soup, layout(True), layout(False)]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(pages)], "i int, html string")
    for tag in ("p", "li", "span", "div", "td", "dt", "a", "h1"):
        for cls in (None, "k"):
            both = df.select(
                "html", rt.tag_texts(F.col("html"), tag, cls).alias("x"), rt.nested_tag_texts(F.col("html"), tag, cls).alias("y")
            )
            for row in both.collect():
                want = parsed(row.html, tag, cls)
                assert row.y == want, (tag, cls, row.html)
                assert row.x == want or tag in ("p", "a"), (tag, cls, row.html)
    df = df.filter(F.col("i") < len(PAGES))
    for tag in ("p", "a"):
        both = df.select(rt.tag_texts(F.col("html"), tag).alias("x"), rt.nested_tag_texts(F.col("html"), tag).alias("y"))
        assert all(r.x == r.y for r in both.collect())
    texts = {r.html: r.x for r in df.select("html", rt.tag_texts(F.col("html"), "p").alias("x")).collect()}
    assert texts[PAGES[2]] == ["one", "two", "three"]
    assert texts[PAGES[12]] == ["it\u2019s caf\u00e9 'x' &eacute; \u00a9 1 <b> a & b"]
    assert one(spark, PAGES[4], lambda h: rt.tag_texts(h, "li")) == ["1", "2xy", "x", "y", "3", "4"]
    assert one(spark, PAGES[8], lambda h: rt.tag_texts(h, "span", "k")) == ["in"]


def test_references_are_decoded_as_the_standard_says(spark):
    texts = [
        "&amp;lt;", "&copyx", "&notit;", "&#x41;", "&#65", "&#0;", "&#x80;", "&#128;", "&#x110000;", "&#xD800;", "&#1;", "&#11;", "&#13;",
        "&hearts;", "&heartsx;", "& ", "&", "&;", "&#;", "&#x;", "&zzz;", "&AMP", "&NotEqualTilde;", "&fjlig;", "&#99999999999;",
        "&#x1F600;", "a&lt b", "&ampamp;", "&#xfdd0;", "&#159;", "&#x7f;", "no reference", "",
    ]
    from reviewtide.functions.html import decode_references

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in df.select("t", decode_references(F.col("t")).alias("d")).collect():
        assert row.d == standard.unescape(row.t), row.t


def block(*parts):
    return '<div id="r1" class="a-section review aok"><div>' + "".join(parts) + "</div><span>Helpful</span></div>"


def test_a_review_that_lacks_a_part_does_not_shift_the_others(spark):
    blocks = [
        (date("November 20, 2022"), stars(5), body("one")),
        (date("November 21, 2022"), body("no rating")),
        (stars(3), body("no <span>date</span>")),
        (stars(2), date("November 23, 2022")),
        (),
        (date("soon"), stars(4), body("a bad date")),
        (body("<div>deep</div> &hearts;"), stars(1), date("November 24, 2022")),
    ]
    head = date("January 1, 2001") + stars(2) + body("old one") + date("January 2, 2001")
    html = f"<html>{head}<div class='reviews'>{''.join(block(*b) for b in blocks)}</div><p>{body('footer')}</p></html>"
    df = spark.createDataFrame([(1, html), (2, "<p>none</p>"), (3, None)], "page_id int, html string")
    rows = rt.explode_reviews(rt.review_lists(df)).orderBy("page_id", "pos").collect()
    day = lambda d: datetime.date(2022, 11, d)
    assert [(r.pos, r.review_date, r.rating, r.review_content) for r in rows] == [
        (0, day(20), 5, "one"), (1, day(21), None, "no rating"), (2, None, 3, "no date"), (3, day(23), 2, None),
        (4, None, None, None), (5, None, 4, "a bad date"), (6, day(24), 1, "deep \u2665"),
    ]


def test_pages_need_no_python(spark):
    df = spark.createDataFrame([("",)], "html string")
    page = F.col("html")
    frames = [rt.review_lists(df), df.select(rt.review_lines(page), rt.page_price(page), rt.tag_texts(page, "p"), rt.attr_values(page, "a", "href"))]
    for frame in frames:
        assert "Python" not in frame._jdf.queryExecution().executedPlan().toString().replace("PythonRDD", "")


def test_references_in_addresses(spark):
    html = '<a href="/caf&eacute;?a=1&copy=2&#38;b=3&amp;lt;">x</a>'
    assert one(spark, html, lambda h: rt.attr_values(h, "a", "href")) == ["/caf\u00e9?a=1&copy=2&b=3&lt;"]


def test_unclosed_tags_take_one_pass(spark):
    for html, tag in (("<p>some text" * 20_000, "p"), ("<li>some text" * 20_000, "li"), ("<!-- <p>" * 20_000, "p")):
        one(spark, "<p>warm", lambda h: rt.tag_texts(h, tag))
        started = time.monotonic()
        n = one(spark, html, lambda h: F.size(rt.tag_texts(h, tag)))
        assert n == (0 if html.startswith("<!--") else 20_000)
        assert time.monotonic() - started < 5


def test_review_dates(spark):
    df = spark.createDataFrame(
        [(["Reviewed in Canada on May 11, 2022", "on June 3, 2021 ", "soon", "Smarch 1, 2020"],)],
        "t array<string>",
    )
    got = df.select(rt.review_dates(F.col("t"))).first()[0]
    assert got == [datetime.date(2022, 5, 11), datetime.date(2021, 6, 3), None, None]


def test_review_ratings_and_texts(spark):
    df = spark.createDataFrame(
        [(["4.0 out of 5 stars", "other", "n out of 5"], ["\nfirst\n\nsecond\n", "third"])],
        "r array<string>, t array<string>",
    )
    row = df.select(
        rt.review_ratings(F.col("r")), rt.review_texts(F.col("t")), rt.review_bodies(F.col("t"))
    ).first()
    assert row[0] == [4, None]
    assert row[1] == ["first", "second", "third"]
    assert row[2] == ["first\nsecond", "third"]


def layout(with_head):
    """A page whose two highlighted reviews are old; the listed ones are 5, 1 and 3 stars."""
    head = date("January 1, 2001") + date("January 2, 2001")
    if with_head:
        head = (
            date("January 1, 2001") + stars(2) + body("old one")
            + date("January 2, 2001") + stars(4) + body("old two")
        )
    listed = [("November 20, 2022", 5, "new"), ("March 4, 2019", 1, "aged"), ("November 2, 2022", 3, "fresh")]
    rows = "".join(f"<div>{stars(n)}{date(d)}{body(t)}</div>" for d, n, t in listed)
    return f'<html><span class="a-price-whole">1,049<span>.</span></span>{head}{rows}</html>'


def test_reviews_of_a_page_stay_aligned(spark):
    df = spark.createDataFrame([(1, layout(False)), (2, layout(True))], "page_id int, html string")
    reviews = rt.explode_reviews(rt.review_lists(df))
    kept = rt.recent(reviews, "review_date", "2022-11-25", 30).orderBy("page_id", "pos").collect()
    assert [(r.page_id, r.pos, str(r.review_date), r.rating, r.review_content) for r in kept] == [
        (1, 0, "2022-11-20", 5, "new"), (1, 2, "2022-11-02", 3, "fresh"),
        (2, 0, "2022-11-20", 5, "new"), (2, 2, "2022-11-02", 3, "fresh"),
    ]
    assert df.select(rt.page_price(F.col("html"))).first()[0] == 1049


def test_bad_entries_are_rejected_one_by_one(spark):
    html = date("May 1, 2022") * 2 + "".join(
        [stars(5), date("garbage"), body("a"), stars(4), date("May 3, 2022"), body("b")]
    )
    short = date("May 1, 2022") * 3 + stars(5)
    df = spark.createDataFrame([(1, html), (2, short), (3, "<p>no review</p>")], "page_id int, html string")
    reviews = rt.explode_reviews(rt.review_lists(df)).withColumnRenamed("review_content", "review_text")
    valid, rejected = rt.check_quality(reviews)
    assert [(r.page_id, r.review_text) for r in valid.collect()] == [(1, "b")]
    assert {(r.page_id, tuple(r.reasons)) for r in rejected.collect()} == {
        (1, ("date_missing",)), (2, ("text_missing",)),
    }


def test_product_urls_and_messages(spark):
    df = spark.createDataFrame(
        [("B01", "/dp/1?x=1", "/reviews/1?y=2")], "asin string, product_href string, review_href string"
    )
    row = rt.product_urls(df, "https://shop.example/").first()
    assert row.search_url == "https://shop.example/s?k=B01&s=review-rank"
    assert row.product_url == "https://shop.example/dp/1?x=1"
    assert row.review_url == "https://shop.example/reviews/1?y=2&sortBy=recent&pageNumber=1"
    assert rt.product_urls(df.select("asin"), "https://shop.example").columns == ["asin", "search_url"]
    review = df.select(
        "asin", F.lit("n").alias("name"), F.lit(5).alias("price"),
        F.lit("2022-01-02").cast("date").alias("review_date"), F.lit(4).alias("rating"),
        F.lit("ok").alias("review_content"),
    )
    value = rt.encode_messages(rt.review_messages(review)).first().value
    assert value == (
        '{"asin":"B01","name":"n","price":5,"timestamp":"2022-01-02 00:00:00","rating":4,'
        '"review_content":"ok"}'
    )
