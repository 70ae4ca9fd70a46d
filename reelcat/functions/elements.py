"""Elements of an HTML page as native Column expressions: events, nesting by running depth, text, links.

A page is cut once into events (tags, texts, comments, whole scripts and styles). An element's
content is found by counting the open and close tags of its own name from its open tag on
(an aggregate over the events with a depth and a count as its state, linear in the page), so
elements of one name may nest. An element that is never closed goes to the end of the page;
close tags that HTML lets a page leave out (of ``li``, ``p``) are not supplied.

Give each step a column of its own (events, an element's content, its fields): nested in one
expression they would take the analyzer too many rounds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelcat.functions.text import ColumnOrName, _col, strip_ws

#: Comment, script, style, declaration, tag (quoted values may hold ">"), text, a lone "<".
EVENT = (r"(?is)<!--.*?-->|<script(?=[\s>])[^>]*+>.*?</script\s*+>|<style(?=[\s>])[^>]*+>.*?</style\s*+>|<![^>]*+>"
         r"|</?[a-z](?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^<]++|<")
NAME = r"^<(/?[a-zA-Z][^\s/>]*)"
#: A level of depth in a count of events.
DEPTH = 1 << 32
#: Elements without content.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
ENTITIES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\u00a0"}


def _attr(name: str) -> str:
    return (r"(?is)^<[a-z][^\s/>]*+(?:\s+[^\s=>/\"']++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'>]++))?+|\s*+/)*?\s+"
            + name + r"\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))")


def attribute(tag: Column, name: str) -> Column:
    """An attribute's value in a tag (double, single or no quotes; entities as written), null if it isn't there."""
    p = _attr(name)
    return F.when(tag.rlike(p), F.concat(F.regexp_extract(tag, p, 1), F.regexp_extract(tag, p, 2), F.regexp_extract(tag, p, 3)))


@dataclass(frozen=True)
class Match:
    """Which elements are meant: by tag name, and by an attribute that equals, holds as a word (``class``) or contains a value."""

    tag: str | None = None
    attr: str | None = None
    value: str = ""
    how: str = "word"

    def __call__(self, event: Column) -> Column:
        opens = event["name"] == self.tag if self.tag else (event["name"] != "") & ~event["name"].startswith("/")
        if self.attr is None:
            return opens
        value = attribute(event["tag"], self.attr)
        fits = {"equals": value == self.value, "contains": F.contains(value, F.lit(self.value)),
                "word": F.array_contains(F.split(value, r"\s+"), self.value)}[self.how]
        return F.contains(event["tag"], F.lit(self.value)) & opens & F.coalesce(fits, F.lit(False))  # the tests that tell most first


def by_id(value: str) -> Match:
    return Match(attr="id", value=value, how="equals")


def by_class(value: str, tag: str | None = None) -> Match:
    return Match(tag, "class", value)


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), 0)


def events(html: ColumnOrName) -> Column:
    """The page's events in order: (tag or text, name), the name with a slash for close tags and empty for texts."""
    return F.transform(F.regexp_extract_all(_col(html), F.lit(EVENT), 0), lambda e: F.struct(
        e.alias("tag"), F.lower(F.regexp_extract(e, NAME, 1)).alias("name")))


def positions(page: Column, match: Match) -> Column:
    """Where the open tags of the elements meant are, from 0 on."""
    return F.filter(F.transform(page, lambda e, i: F.when(match(e), i)), lambda i: i.isNotNull())


def content(page: Column, at: Column) -> Column:
    """The events within the element whose open tag is at ``at``; null if ``at`` is."""

    def within(x):
        # the state is one number, so a step makes no row: the depth in steps of DEPTH, and the events counted
        def step(s, e):
            closed = F.when(s < 2 * DEPTH, s - DEPTH).otherwise(s - DEPTH + 1)
            return F.when(s < DEPTH, s).when(e["name"] == x["name"], s + DEPTH + 1).when(e["name"] == x["close"], closed).otherwise(s + 1)

        start = F.when(x["name"].isin(*VOID), 0).otherwise(DEPTH).cast("long")
        return F.slice(x["rest"], F.lit(1), F.aggregate(x["rest"], start, step) % DEPTH)

    rest = F.slice(page, at + 2, F.greatest(F.size(page) - at - 1, F.lit(0)))
    return F.when(at.isNotNull(), bound(F.struct(F.get(page, at)["name"].alias("name"), F.concat(F.lit("/"), F.get(page, at)["name"]).alias("close"), rest.alias("rest")), within))


def elements(page: Column, match: Match) -> Column:
    """The contents of all elements meant, in page order."""
    return F.transform(positions(page, match), lambda at: content(page, at))


def first(page: Column, match: Match) -> Column:
    """The content of the first element meant, null if there is none."""
    return content(page, F.get(positions(page, match), 0))


def raw_text(page: Column) -> Column:
    """The texts of events, one after the other, entities as written; null of null."""
    texts = F.filter(page, lambda e: (e["name"] == "") & ~e["tag"].startswith("<!"))
    return F.array_join(F.transform(texts, lambda e: e["tag"]), "")


def text_of(page: Column) -> Column:
    """The texts of events, one after the other, entities decoded; null of null."""
    return decoded(raw_text(page))


def first_link(page: Column) -> Column:
    """``href`` of the first link that has one, as written (see ``target``); null if none has."""
    return F.get(F.filter(F.transform(F.filter(page, lambda e: e["name"] == "a"), lambda e: attribute(e["tag"], "href")), lambda h: h.isNotNull()), 0)


def decoded(text: Column) -> Column:
    """Entities (named ones of ``ENTITIES``, decimal, hexadecimal) as characters, each once."""

    def one(part):
        name = F.regexp_extract(part, "^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z]+);", 1)
        number = F.when(name.rlike("^#[0-9]"), F.substr(name, F.lit(2)).cast("long")).when(
            name.rlike("^#[xX]"), F.conv(F.substr(name, F.lit(3)), 16, 10).cast("long"))
        number = F.when((number > 0) & (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF), number).when(number.isNotNull(), 0xFFFD)
        char = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        for k, v in ENTITIES.items():
            char = F.when(name == k, F.lit(v)).otherwise(char)
        whole = F.concat(F.lit("&"), part)
        return F.when(name == "", whole).otherwise(F.coalesce(F.concat(char, F.substr(part, F.length(name) + 2)), whole))

    parts = lambda t: F.concat(F.get(t, 0), F.array_join(F.transform(F.slice(t, F.lit(2), F.size(t)), one), ""))
    return bound(text, lambda t: F.when(F.contains(t, F.lit("&")), bound(F.split(t, "&", -1), parts)).otherwise(t))


def target(href: Column, base: Column) -> Column:
    """Where a written ``href`` leads from the page at ``base``."""
    return bound(F.struct(decoded(href).alias("ref"), base.alias("base")), lambda x: resolved(x["base"], x["ref"]))  # named often there, decoded once


def _without_dots(path: Column) -> Column:
    """A path that begins with a slash, without its ``.`` and ``..`` segments."""

    def step(stack, s):
        return F.when(s == ".", stack).when(s == "..", F.slice(stack, F.lit(1), F.greatest(F.size(stack) - 1, F.lit(0)))).otherwise(F.concat(stack, F.array(s)))

    segments = F.split(F.substr(path, F.lit(2)), "/", -1)
    kept = F.aggregate(segments, F.array().cast("array<string>"), step)
    kept = F.when(F.element_at(segments, -1).isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.when(path.rlike(r"/\.\.?(?:/|$)"), F.concat(F.lit("/"), F.array_join(kept, "/"))).otherwise(path)


def resolved(base: Column, ref: Column) -> Column:
    """A link's target against the URL of its page (RFC 3986); null of null."""
    ref = strip_ws(ref)
    scheme = F.regexp_extract(base, "^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    host = F.regexp_extract(base, "^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/?#]*)", 1)
    path = F.regexp_extract(base, "^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    query = F.regexp_extract(base, r"^[^?#]*(\?[^#]*)", 1)
    own = F.regexp_extract(ref, "^[^?#]*", 0)
    rest = F.substr(ref, F.length(own) + 1)
    merged = F.concat(F.when(path == "", F.lit("/")).otherwise(F.regexp_replace(path, "[^/]*$", "")), own)
    return (F.when(ref.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), ref).when(ref.startswith("//"), F.concat(scheme, ref))
            .when((own == "") & ref.startswith("?"), F.concat(scheme, host, path, ref)).when(own == "", F.concat(scheme, host, path, query, ref))
            .when(own.startswith("/"), F.concat(scheme, host, _without_dots(own), rest)).otherwise(F.concat(scheme, host, _without_dots(merged), rest)))
