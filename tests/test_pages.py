"""Elements of pages: nesting, groups, texts, entities and link targets against plain parsers."""

import html
import random
import urllib.parse
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from reelcat.functions import elements as E
from reelcat.operators.pages import PageSpec, extract_page_fields, page_threshold


class Tree(HTMLParser):
    """Elements with attributes, children and texts; a close tag ends the nearest open element of its name."""

    def __init__(self, text):
        super().__init__(convert_charrefs=True)
        self.root = self.at = {"tag": "", "attrs": {}, "kids": [], "up": None}
        self.feed(text)
        self.close()

    def handle_starttag(self, tag, attrs):
        node = {"tag": tag, "attrs": dict(attrs), "kids": [], "up": self.at}
        self.at["kids"].append(node)
        if tag not in E.VOID:
            self.at = node

    def handle_endtag(self, tag):
        node = self.at
        while node and node["tag"] != tag:
            node = node["up"]
        if node:
            self.at = node["up"]

    def handle_data(self, data):
        self.at["kids"].append(data)


def walk(node):
    for k in node["kids"]:
        if isinstance(k, dict):
            yield k
            yield from walk(k)


def text(node):
    return "".join(k if isinstance(k, str) else "" if k["tag"] in ("script", "style") else text(k) for k in node["kids"])


def random_page(rng):
    def part(depth):
        out = []
        for _ in range(rng.randint(0, 4)):
            kind = rng.random()
            cls = rng.choice(["box", "box big", "x box", "boxes", "main", "link-group", "g link-group", "", "link-group-2"])
            quote = rng.choice(['"', "'"])
            if kind < 0.45 and depth < 5:
                tag = rng.choice(["div", "DIV", "span", "ul", "section"])
                ident = f' id={quote}{rng.choice("pqr")}{quote}' if rng.random() < 0.4 else ""
                out.append(f'<{tag} data-x="a>b"{ident} class={quote}{cls}{quote}>{part(depth + 1)}</{tag.lower()}>')
            elif kind < 0.65:
                href = rng.choice(["/a/../b", "x?y=1&amp;z=2", "../up", "//o.net/p", "https://o.net/q", "?only", "#f", "a&#47;b", "./", ""])
                out.append(rng.choice([f"<a href={quote}{href}{quote} class='{cls}'>go <b>on</b></a>", "<a name=n>none</a>", f"<A CLASS=box HREF={quote}{href}{quote}>in</A>"]))
            elif kind < 0.75:
                out.append(rng.choice(["<!-- <div id='p'> -->", "<script>var x='</div>';</script>", "<br>", "<img src='a>b'>", "<style>a>b{}</style>", "<!doctype x>"]))
            else:
                out.append(rng.choice(["words ", "1 &lt; 2 ", "&amp;lt;", "é &#233; &#x1F600;", " 400 ", "not found"]))
        return "".join(out)

    return f"<html lang=en><body>{part(0)}</body></html>"


def test_elements_against_a_tree(spark):
    rng = random.Random(12)
    pages = [random_page(rng) for _ in range(400)] + ["", "no tags", "<", "<div id='p'>never closed <a href=/x>l</a>", None]
    base = "https://h.org/a/b/c.html?q#f"
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, html string").repartition(3)
    df = df.withColumn("page", E.events("html")).withColumn("p", E.first(F.col("page"), E.by_id("p")))
    df = df.withColumn("boxes", E.elements(F.col("p"), E.by_class("box"))).withColumn("groups", E.elements(F.col("page"), E.by_class("link-group")))
    df = df.withColumn("hrefs", F.transform("groups", E.first_link)).withColumn("texts", F.transform("boxes", E.raw_text))
    df = df.select("i", E.text_of(F.col("p")).alias("text"), "texts", "hrefs", E.target(E.first_link(F.col("page")), F.lit(base)).alias("link"))
    found = 0
    for r in df.collect():
        if pages[r.i] is None:
            assert (r.text, r.texts, r.hrefs, r.link) == (None,) * 4
            continue
        nodes = list(walk(Tree(pages[r.i]).root))
        named = lambda n, c: c in (n["attrs"].get("class") or "").split()
        href = lambda ns: next((n["attrs"]["href"] for n in ns if n["tag"] == "a" and "href" in n["attrs"]), None)
        p = next((n for n in nodes if n["attrs"].get("id") == "p"), None)
        assert r.text == (text(p) if p else None)
        assert (r.texts and [html.unescape(t) for t in r.texts]) == (p and [text(n) for n in walk(p) if named(n, "box")])
        assert [h if h is None else html.unescape(h) for h in r.hrefs] == [href(walk(n)) for n in nodes if named(n, "link-group")]
        first = href(nodes)
        assert r.link == (None if first is None else urllib.parse.urljoin(base, first) if first else base.split("#")[0])
        found += len(r.hrefs) + (p is not None)
    assert found > 200


def test_link_targets_against_the_standard_resolver(spark):
    bases = ["http://h.org/a/b/c?q=1#f", "https://h.org", "http://h.org/", "http://h/a/b/", "http://h.org?x=1"]
    refs = ["x", "./x", "../x", "../../x", "../../../x", "/x/../y", "/x/./", "?a=1", "#z", "//o.net/p?x", "https://o/p", "mailto:a@b", "a/./b/../c#f",
            "..", ".", "a/..", "g;x=1/../y", "x?../a", "x#/../a"]
    df = spark.createDataFrame([(b, r) for b in bases for r in refs], "b string, r string")
    for x in df.select("b", "r", E.resolved(F.col("b"), F.col("r")).alias("o")).collect():
        assert x.o == urllib.parse.urljoin(x.b, x.r), (x.b, x.r)


@pytest.mark.parametrize("text_, want", [("a&amp;b", "a&b"), ("&amp;lt;", "&lt;"), ("&#65;&#x41;&#128512;", "AA😀"), ("&", "&"), ("&nope;", "&nope;"), ("&#0;", "�"),
                                         ("&#xD800;", "�"), ("&quot;&apos;&nbsp;x", "\"'\u00a0x"), ("", ""), ("&#;&", "&#;&"), ("plain", "plain"), (None, None)])
def test_entities(spark, text_, want):
    assert spark.createDataFrame([(text_,)], "t string").select(E.decoded(F.col("t"))).first()[0] == want


def test_page_fields_of_hard_pages(spark):
    rows = [
        (1, "http://h.org/d/p", '<div id="sf_result"><div class="def-btn-name"><span>40<i>0</i></span></div><div class="def-btn-box"><div>x</div></div>'
         '<div class="def-btn-box"><div><div><a href="../f.mp4?a&amp;b">l</a></div></div></div></div><div class="main"><div class="link-group"></div></div>'),
        (2, None, '<div class="result-failure">Sorry<p>x</p>The download link not found.</div><div id="c-ui-popup">Unable to download file</div>'),
        (3, "u", None), (4, "u", ""),
        (5, "http://h.org/d", '<div class="main"><a href="/no">n</a><p class="link-group"><b>b</b></p><p class="link-group"><a href="/2">b</a></p></div>'
         '<div id="sf_result"><div class="def-btn-name"><span>399.9</span></div></div>'),
    ]
    got = {r.page_id: r for r in extract_page_fields(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert (got[1].container_link, got[1].group_link, got[1].label_value, got[1].above_threshold) == ("http://h.org/f.mp4?a&b", None, 400.0, True)
    assert (got[2].is_failure, got[2].has_notice, got[2].is_link_found, got[2].container_link) == (True, True, False, None)
    assert all((got[k].is_failure, got[k].has_notice, got[k].label_value, got[k].text_link) == (False, False, None, None) for k in (3, 4, 5) if k != 5)
    assert got[5].group_link is None and not got[5].above_threshold  # the first group has no link
    empty = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert extract_page_fields(empty).count() == 0 and page_threshold(empty, PageSpec()).count() == 0
