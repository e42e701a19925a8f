"""Text and attribute extraction from stored HTML, as column expressions.

A page is cut once into tokens, each a whole tag or a stretch of text, after comments, scripts and
styles are gone. One fold over the tags keeps the stack of open elements and notes where each
wanted element starts and ends; its text is the text tokens in between. So nested elements, and
those that other tags end, come out right in one pass. Elements that cannot hold their own kind
(paragraphs, links, titles) need no stack: each ends at the next tag that ends it. Everything runs
inside the scan, without a shuffle and without Python.

Closing tags that HTML lets a page leave out are implied: a paragraph ends before the next
block, a list item before the next item of its list, a link before the next link.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewtide.functions.fixed_values import (
    LEADING_DATES,
    PARAGRAPH_ENDS,
    PARENT_ENDS,
    RATING_TITLE_MARK,
    REVIEW_DATE_FORMAT,
)

_NOISE = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)"
_VALUE = r"""("[^"]*"|'[^']*'|[^\s>"']+)"""
_ATTRIBUTE = rf"""\s([^\s=>"'/]+)\s*=\s*{_VALUE}"""
_INSIDE_TAG = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
_ANY_TAG = rf"<[a-zA-Z/!](?:{_INSIDE_TAG}|[^>]*)>"
_VOID_TAGS = "area base br col embed hr img input link meta param source track wbr".split()

#: Tags that one fold takes at a time.
_CHUNK = 128
_TOKEN = rf"(?s){_ANY_TAG}|[^<]+|<"
_REFERENCES = r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*);?|[^&]+|&"

# Character references: the standard's names, of which the old ones also count without a semicolon, and
# the numbers that stand for other characters: those of Windows-1252, the carriage return and what is no text.
_NAMED = json.dumps({name.rstrip(";"): text for name, text in html5.items()})
_OLD_NAMES = sorted((name for name in html5 if not name.endswith(";")), key=len, reverse=True)
_OLD_NAME = "^&(" + "|".join(_OLD_NAMES) + ")"
_WINDOWS = {str(i): bytes([i]).decode("cp1252", "ignore") or chr(i) for i in range(0x80, 0xA0)}
_NUMBERED = json.dumps({**_WINDOWS, "0": "\ufffd", "13": "\r"})

#: Elements that cannot hold their own kind, and the tags before which they end.
_FLAT = {
    "p": "/?(?:" + "|".join(PARAGRAPH_ENDS) + ")|/(?:" + "|".join(PARENT_ENDS) + ")",
    "a": "/?a",
    "title": "/?title",
}
#: For an opening tag: the open tags it closes, and those beyond which it does not look.
_IMPLIED = {
    **{tag: ({"p"}, set(PARENT_ENDS) | {"table"}) for tag in PARAGRAPH_ENDS},
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _numbered(number: Column) -> Column:
    """The character of a numeric reference."""
    written = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    other = F.try_element_at(F.from_json(F.lit(_NUMBERED), "map<string, string>"), number.cast("string"))
    outside = number.isNull() | (number > 0x10FFFF) | number.between(0xD800, 0xDFFF)
    return F.coalesce(other, F.when(outside, "\ufffd").when(_no_text(number), "").otherwise(written))


def _no_text(n: Column) -> Column:
    """Control characters and code points that are never characters."""
    control = n.between(1, 8) | (n == 11) | n.between(14, 31) | (n == 127)
    return control | n.between(0xFDD0, 0xFDEF) | (n % 0x10000 >= 0xFFFE)


def _reference(piece: Column, value: bool) -> Column:
    """A piece of text with its reference decoded, or as it is.

    In attribute values a reference needs its semicolon, so that the parameters of an address stay.
    """
    closed = piece.endswith(";")
    number = F.when(
        piece.rlike("^&#[xX]"), F.conv(F.regexp_extract(piece, "^&#[xX]0*([0-9a-fA-F]{1,7});?$", 1), 16, 10).cast("bigint")
    ).otherwise(F.regexp_extract(piece, "^&#0*([0-9]{1,8});?$", 1).try_cast("bigint"))
    zero = piece.rlike("^&#[xX]?0+;?$")
    name, old = F.regexp_replace(piece, "^&|;$", ""), F.regexp_extract(piece, _OLD_NAME, 1)

    def named(names: Column) -> Column:
        whole = F.when(closed, F.try_element_at(names, name))
        begun = F.when(old != "", F.concat(F.try_element_at(names, old), F.substr(piece, F.length(old) + 2)))
        return F.coalesce(whole, begun)

    decoded = F.when(piece.startswith("&#"), F.when(zero, "\ufffd").otherwise(_numbered(number))).otherwise(
        let(F.from_json(F.lit(_NAMED), "map<string, string>"), named)
    )
    wanted = piece.rlike("^&[#a-zA-Z]") & (closed if value else F.lit(True))
    return F.when(wanted, F.coalesce(decoded, piece)).otherwise(piece)


def decode_references(text: Column, value: bool = False) -> Column:
    """``text`` with its HTML character references decoded, as the standard says."""
    pieces = F.regexp_extract_all(text, F.lit(_REFERENCES), F.lit(0))
    decoded = F.array_join(F.transform(pieces, lambda piece: _reference(piece, value)), "")
    return F.when(F.contains(text, F.lit("&")), decoded).otherwise(text)


def decoded_texts(raw: Column, value: bool = False) -> Column:
    """All of the texts with their character references decoded."""
    return F.transform(raw, lambda text: decode_references(text, value))


def escape_text(text: Column) -> Column:
    """Escape text for use inside HTML."""
    for character, reference in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(character), F.lit(reference))
    return text


def _attribute(element: Column, name: str) -> Column:
    """Raw value of one attribute of an element's opening tag, null when it is not there.

    Attributes are found one after the other, each with its whole value, so neither text inside
    a value nor a tag with thousands of attributes causes trouble.
    """
    opening = F.regexp_extract(element, rf"(?s)^<\w+{_INSIDE_TAG}>", 0)
    all_attributes = F.regexp_extract_all(opening, F.lit(f"(?s){_ATTRIBUTE}"), F.lit(0))
    named = F.filter(all_attributes, lambda a: a.rlike(rf"(?is)^\s{name}\s*="))
    value = F.regexp_extract(F.get(named, F.lit(0)), f"(?s)^{_ATTRIBUTE}$", 2)
    return F.regexp_replace(value, r"""^["']|["']$""", "")


def _has_class(opening: Column, cls: str) -> Column:
    """A one-word class matches any of the tag's classes, several words the whole list."""
    names = F.trim(F.regexp_replace(_attribute(opening, "class"), r"\s+", " "))
    wanted = " ".join(cls.split())
    matches = names == wanted if " " in wanted else F.array_contains(F.split(names, " "), wanted)
    return F.coalesce(matches, F.lit(False))


def without_noise(html: Column) -> Column:
    """A page without comments, scripts and styles."""
    return F.regexp_replace(html, _NOISE, "")


def _openings(html: Column, pattern: str, cls: str | None) -> Column:
    found = F.regexp_extract_all(without_noise(html), F.lit(pattern), F.lit(0))
    return found if cls is None else F.filter(found, lambda e: _has_class(e, cls))


def _flat_texts(html: Column, tag: str, cls: str | None) -> Column:
    """Texts of elements that hold none of their own kind: each up to the next tag that ends it."""
    found = _openings(html, rf"(?is)<{tag}(?=[\s/>]){_INSIDE_TAG}>.*?(?=<(?:{_FLAT[tag]})(?=[\s/>])|\z)", cls)
    return decoded_texts(F.transform(found, lambda e: F.regexp_replace(e, _ANY_TAG, "")))


def page_tokens(html: Column) -> Column:
    """A page as an array of tags and stretches of text, in order."""
    return tokens_of(without_noise(html))


def tokens_of(clean: Column) -> Column:
    """The same for a part of a page without comments, scripts and styles."""
    return F.regexp_extract_all(clean, F.lit(_TOKEN), F.lit(0))


def _is_tag(token: Column) -> Column:
    return token.rlike("^<.")


def _among(names: Column, wanted: tuple[str, ...]) -> Column:
    return F.filter(names, lambda name: name.isin(*wanted))


def _kept(stack: Column, tag: Column) -> Column:
    """How many of the open elements stay open as a tag comes."""
    # Innermost first.
    names = F.reverse(stack["name"])
    size = F.size(stack)

    def without(position: Column) -> Column:
        return F.when(position > 0, size - position).otherwise(size)

    kept = F.when(tag["close"], without(F.array_position(names, tag["name"])))
    groups: dict[tuple, list[str]] = {}
    for name, (closes, scope) in _IMPLIED.items():
        groups.setdefault((tuple(sorted(closes)), tuple(sorted(scope))), []).append(name)
    for (closes, scope), openings in groups.items():
        # The nearest open element that this tag ends, unless one beyond which it does not look is nearer.
        met = F.get(_among(names, (*closes, *scope)), F.lit(0))
        implied = F.when(met.isin(*closes), without(F.array_position(names, met))).otherwise(size)
        any_open = F.array_contains(names, closes[0])
        for name in closes[1:]:
            any_open = any_open | F.array_contains(names, name)
        kept = kept.when(tag["name"].isin(openings) & ~tag["close"] & any_open, implied)
    return kept.otherwise(size)


def _noted(start: Column, end: Column, kind: Column) -> Column:
    """A span as text, which is appended faster than to an array."""
    return F.concat_ws(":", start, end, kind)


def _step(state: Column, tag: Column) -> Column:
    """The open elements and found spans after one more tag."""

    def after(kept: Column) -> Column:
        stack, spans = state["stack"], state["spans"]
        fewer = kept < F.size(stack)
        ended = F.filter(F.slice(stack, kept + 1, F.size(stack) - kept), lambda e: e["kind"] >= 0)
        closed = F.concat_ws(",", F.transform(ended, lambda e: _noted(e["start"], tag["at"], e["kind"])))
        spans = F.when(fewer, F.concat(spans, closed, F.lit(","))).otherwise(spans)
        spans = F.when(tag["empty"] & (tag["kind"] >= 0), F.concat(spans, _noted(tag["at"], tag["at"], tag["kind"]), F.lit(","))).otherwise(spans)
        stack = F.when(fewer, F.slice(stack, 1, kept)).otherwise(stack)
        opened = F.array(F.struct(tag["name"].alias("name"), tag["at"].alias("start"), tag["kind"].alias("kind")))
        stack = F.when(tag["close"] | tag["empty"], stack).otherwise(F.concat(stack, opened))
        return F.struct(stack.alias("stack"), spans.alias("spans"))

    return let(_kept(state["stack"], tag), after)


def element_spans(tokens: Column, wanted: list[tuple[str, str | None]]) -> Column:
    """Where the wanted elements, each a (tag, class), lie in the tokens of a page.

    An array of (start, end, kind) in page order: the place of the opening tag, that of the tag
    that ends the element, and its place among ``wanted``; an element of two kinds is of the first.
    """

    def kind_of(token: Column, name: Column, close: Column) -> Column:
        kind = F.when(close, F.lit(-1))
        for i, (tag, cls) in enumerate(wanted):
            fits = name == tag
            kind = kind.when(fits if cls is None else F.when(fits, _has_class(token, cls)).otherwise(False), F.lit(i))
        return kind.otherwise(F.lit(-1))

    def described(token: Column, at: Column) -> Column:
        name = F.lower(F.regexp_extract(token, r"^</?([a-zA-Z][^\s/>]*)", 1))
        close = token.startswith("</")
        empty = ~close & (name.isin(_VOID_TAGS) | token.rlike(r"""(?s)^<[a-zA-Z][^\s/>]*/>$|[\s"']/>$"""))
        kind = kind_of(token, name, close)
        # Void elements have no text and are not noted.
        kind = F.when(name.isin(_VOID_TAGS), F.lit(-1)).otherwise(kind)
        return F.struct(at.alias("at"), name.alias("name"), close.alias("close"), empty.alias("empty"), kind.alias("kind"))

    # Only tags cost a step, and the tests on them are made once.
    numbered = F.transform(tokens, lambda t, i: F.struct(t.alias("token"), i.alias("at")))
    tags = F.filter(numbered, lambda t: t["token"].rlike("^</?[a-zA-Z]"))
    tags = F.transform(tags, lambda t: described(t["token"], t["at"]))
    nothing = F.struct(
        F.array().cast("array<struct<name: string, start: int, kind: int>>").alias("stack"),
        F.lit("").alias("spans"),
    )

    def span(noted: Column) -> Column:
        parts = F.split(noted, ":").cast("array<int>")
        return F.struct(parts[0].alias("start"), parts[1].alias("end"), parts[2].alias("kind"))

    def finish(state: Column) -> Column:
        left = F.filter(state["stack"], lambda e: e["kind"] >= 0)
        left = F.transform(left, lambda e: _noted(e["start"], F.size(tokens), e["kind"]))
        noted = F.filter(F.concat(F.split(state["spans"], ","), left), lambda n: n != "")
        return F.array_sort(F.transform(noted, span))

    # What is found is gathered per chunk first, since every step copies what it holds.
    def many(state: Column, chunk: Column) -> Column:
        start = F.struct(state["stack"].alias("stack"), F.lit("").alias("spans"))
        return let(
            F.aggregate(chunk, start, _step),
            lambda end: F.struct(end["stack"].alias("stack"), F.concat(state["spans"], end["spans"]).alias("spans")),
        )

    def chunks(tags: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(tags), F.lit(1)), F.lit(_CHUNK))
        return F.transform(starts, lambda at: F.slice(tags, at, F.lit(_CHUNK)))

    return F.aggregate(let(tags, chunks), nothing, many, finish)


def token_texts(tokens: Column) -> Column:
    """The texts among the tokens of a page, empty in place of tags."""
    return F.transform(tokens, lambda t: F.when(_is_tag(t), "").otherwise(t))


def span_text(texts: Column, span: Column) -> Column:
    """The text of an element whose place is known, out of ``token_texts``."""
    inside = F.slice(texts, span["start"] + 2, F.greatest(span["end"] - span["start"] - 1, F.lit(0)))
    return decode_references(F.array_join(inside, ""))


def outer_texts(tokens: Column, tag: str, cls: str, around: str) -> Column:
    """Raw texts of the ``tag`` elements of class ``cls`` in some tokens, by counting tags of two names only.

    An element ends where its own tags are closed as often as opened, or where the element
    ``around`` it ends. Much cheaper than the stack of all open elements, and the same unless yet
    other tags are left open across the element's end.
    """

    def named(token: Column, name: str) -> tuple[Column, Column]:
        return token.rlike(rf"(?i)^<{name}[\s/>]"), token.rlike(rf"(?i)^</{name}[\s>]")

    def depth(state: Column, token: Column) -> Column:
        (opens, closes), (enters, leaves) = named(token, tag), named(token, around)
        own = state["own"] + F.when(opens, 1).when(closes, -1).otherwise(0)
        outer = state["outer"] + F.when(enters, 1).when(leaves, -1).otherwise(0)
        grown = F.struct(own.alias("own"), outer.alias("outer"), (state["size"] + 1).alias("size"))
        return F.when((state["own"] > 0) & (state["outer"] >= 0), grown).otherwise(state)

    def text(place: Column) -> Column:
        rest = F.slice(tokens, place + 2, F.size(tokens))
        start = F.struct(F.lit(1).alias("own"), F.lit(0).alias("outer"), F.lit(0).alias("size"))
        inside = F.slice(rest, 1, F.aggregate(rest, start, depth, lambda state: state["size"]))
        return F.array_join(F.filter(inside, lambda t: ~_is_tag(t)), "")

    def place_of(token: Column, place: Column) -> Column:
        fits = F.when(token.rlike(rf"(?i)^<{tag}[\s]"), _has_class(token, cls)).otherwise(False)
        return F.when(fits, place)

    places = F.filter(F.transform(tokens, place_of), lambda place: place.isNotNull())
    return F.transform(places, text)


def link_titles(tokens: Column, cls: str) -> Column:
    """Raw titles of the links of a class in some tokens."""
    links = F.filter(tokens, lambda t: F.when(t.rlike(r"(?i)^<a\s"), _has_class(t, cls)).otherwise(False))
    return F.filter(F.transform(links, lambda t: _attribute(t, "title")), lambda title: title.isNotNull())


def blocks(html: Column, tag: str, cls: str) -> Column:
    """A page cut at each ``tag`` of class ``cls``: the blocks, each up to the next, without what is before the first."""
    quoted = "|".join(rf"{q}(?:[^{q}]*\s)?{cls}(?:\s[^{q}]*)?{q}" for q in "\"'")
    opening = rf"""<{tag}\s(?:[^>"']|"[^"]*"|'[^']*')*?\bclass\s*=\s*(?:{quoted}|{cls}(?=[\s>]))"""
    return F.filter(F.split(without_noise(html), f"(?i)(?={opening})"), lambda block: block.rlike(f"(?i)^{opening}"))


def nested_tag_texts(html: Column, tag: str, cls: str | None = None) -> Column:
    """Texts of all ``tag`` elements (of class ``cls``) in page order, by the stack of open elements."""

    def texts(tokens: Column) -> Column:
        spans = element_spans(tokens, [(tag, cls)])
        return let(token_texts(tokens), lambda found: F.transform(spans, lambda span: span_text(found, span)))

    # A page without the tag needs no tokens.
    relevant = F.contains(F.lower(html), F.lit(f"<{tag}"))
    for word in (cls or "").split():
        relevant = relevant & F.contains(html, F.lit(word))
    nothing = F.when(html.isNotNull(), F.array().cast("array<string>"))
    return F.when(relevant, let(page_tokens(html), texts)).otherwise(nothing)


def tag_texts(html: Column, tag: str, cls: str | None = None) -> Column:
    """Texts of all ``tag`` elements (of class ``cls``) in page order."""
    return _flat_texts(html, tag, cls) if tag in _FLAT else nested_tag_texts(html, tag, cls)


def attr_values(html: Column, tag: str, attr: str, cls: str | None = None) -> Column:
    """Values of attribute ``attr`` over all ``tag`` elements that have it."""
    pattern = rf"(?is)<{tag}(?=[\s/>]){_INSIDE_TAG}>"
    values = F.transform(_openings(html, pattern, cls), lambda e: _attribute(e, attr))
    return decoded_texts(F.filter(values, lambda v: v.isNotNull()), value=True)


def review_dates(texts: Column) -> Column:
    """Dates at the end of texts such as 'Reviewed in Canada on May 11, 2022'."""
    day = r"(\w+)\s+(\d{1,2}),?\s+(\d{4})\s*$"
    return F.transform(
        texts,
        lambda t: F.try_to_date(
            F.concat_ws(
                " ",
                F.regexp_extract(t, day, 1),
                F.concat(F.regexp_extract(t, day, 2), F.lit(",")),
                F.regexp_extract(t, day, 3),
            ),
            REVIEW_DATE_FORMAT,
        ),
    )


def review_ratings(titles: Column) -> Column:
    """First digit of every title like '4.0 out of 5 stars'."""
    stars = F.filter(titles, lambda t: t.isNull() | F.contains(t, F.lit(RATING_TITLE_MARK)))
    return F.transform(stars, lambda t: F.substring(t, 1, 1).try_cast("int"))


def review_texts(texts: Column) -> Column:
    """All non-blank lines of the given texts, in order."""
    lines = F.flatten(F.transform(texts, lambda t: F.split(t, "\n")))
    return F.filter(lines, lambda line: line != "")


def review_bodies(texts: Column) -> Column:
    """One body per text: its non-blank lines joined, so bodies stay aligned with reviews."""
    return F.transform(
        texts,
        lambda t: F.array_join(F.filter(F.split(t, "\n"), lambda line: line != ""), "\n"),
    )


def without_leading(values: Column, n: int = LEADING_DATES) -> Column:
    """Array without its first ``n`` entries."""
    return F.slice(values, n + 1, F.greatest(F.size(values) - n, F.lit(0)))
