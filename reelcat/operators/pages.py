"""Extract links, labels and markers from stored result pages.

Every field is found by element (id, class, nesting), read from ``html`` alone; link targets
are entity-decoded and resolved against ``url``. One scan, no shuffle; a null page has no
elements, so its fields are null and its flags false.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelcat.functions import elements as E
from reelcat.functions.elements import Match, by_class, by_id
from reelcat.functions.numbers import at_least, tolerant_double
from reelcat.functions.text import strip_ws, url_filename


@dataclass(frozen=True)
class PageSpec:
    """Where each field sits on a page. Names are fixed values of the result pages' format; None means the whole page."""

    result: Match | None = by_id("sf_result")          # X1, X5: inside this element ...
    link_box: Match | None = by_class("def-btn-box")   # X1: ... the first link of an element like this
    label_box: Match = by_class("def-btn-name")        # X5: ... and in an element like this ...
    label: Match = Match("span")                       # ... the text of the first of these
    label_threshold: float = 400.0                     # F9
    groups: Match | None = by_class("main")            # X2: inside this element ...
    group: Match = by_class("link-group")              # ... elements like this, however deep ...
    min_groups: int = 2                                # ... if there are so many, the first one's first link
    section: Match | None = by_id("landingTz-main-screen-top")                  # X3: inside this element ...
    text_link: Match = Match("a", "class", "landingTz-btn-close", "equals")     # ... a link like this ...
    link_text: str = "with low quality"                                         # ... whose text holds this
    failure: Match = Match("div", "class", "result-failure", "contains")        # X4/F10: an element like this ...
    failure_text: str = "The download link not found."                          # ... whose text holds this
    notice: Match = by_id("c-ui-popup")                # F12: the text of this element ...
    notice_text: str = "Unable to download"            # ... holds this


#: The crawled ``pages`` table, which has neither ids nor result blocks.
CRAWLED = PageSpec(result=Match("nav"), link_box=None, groups=Match("nav"), group=Match("li"), section=None, text_link=Match("a"), link_text="the",
                   failure=Match("div", "class", "ad", "contains"), failure_text="the", notice=Match("nav"), notice_text="The")


def _inside(df: DataFrame, name: str, where: Match | None) -> DataFrame:
    return df.withColumn(name, F.col("__page") if where is None else E.first(F.col("__page"), where))


def _some(values: Column) -> Column:
    """The first value that isn't null."""
    return F.get(F.filter(values, lambda x: x.isNotNull()), 0)


def _opened(pages: DataFrame) -> DataFrame:
    return pages.withColumn("__page", E.events("html"))


def _links(df: DataFrame, spec: PageSpec) -> DataFrame:
    """X1, X2, X3 as written: ``__container``, ``__group``, ``__text``."""
    df = _inside(df, "__result", spec.result)
    df = df.withColumn("__boxes", F.array("__result") if spec.link_box is None else E.elements(F.col("__result"), spec.link_box))
    df = df.withColumn("__container", _some(F.transform("__boxes", E.first_link)))
    df = _inside(df, "__main", spec.groups).withColumn("__groups", E.elements(F.col("__main"), spec.group))
    df = df.withColumn("__group", F.when(F.size("__groups") >= spec.min_groups, E.first_link(F.get("__groups", 0))))
    df = _inside(df, "__section", spec.section).withColumn("__at", E.positions(F.col("__section"), spec.text_link))
    df = df.withColumn("__anchors", F.transform("__at", lambda at: F.struct(
        E.attribute(F.get("__section", at)["tag"], "href").alias("href"), E.raw_text(E.content(F.col("__section"), at)).alias("text"))))
    return df.withColumn("__text", F.get(F.filter("__anchors", lambda a: F.contains(a["text"], F.lit(spec.link_text))), 0)["href"])


def _link_fields() -> list[Column]:
    return [E.target(F.col(f"__{n}"), F.col("url")).alias(f"{n}_link") for n in ("container", "group", "text")]


def _markers(df: DataFrame, spec: PageSpec) -> DataFrame:
    """``__failed``, ``__noticed``."""
    df = df.withColumn("__failures", E.elements(F.col("__page"), spec.failure)).withColumn("__notice", E.first(F.col("__page"), spec.notice))
    failed = F.exists("__failures", lambda c: F.contains(E.raw_text(c), F.lit(spec.failure_text)))
    return df.withColumn("__failed", F.coalesce(failed, F.lit(False))).withColumn(
        "__noticed", F.coalesce(F.contains(E.text_of(F.col("__notice")), F.lit(spec.notice_text)), F.lit(False)))


def _label(df: DataFrame, spec: PageSpec) -> DataFrame:
    """``__label``, the text of the first label."""
    if "__result" not in df.columns:
        df = _inside(df, "__result", spec.result)
    df = df.withColumn("__names", E.elements(F.col("__result"), spec.label_box))
    df = df.withColumn("__spans", F.transform("__names", lambda c: E.first(c, spec.label)))
    return df.withColumn("__label", strip_ws(E.text_of(_some(F.col("__spans")))))


def _title(df: DataFrame) -> DataFrame:
    return df.withColumn("__title", E.first(F.col("__page"), Match("title")))


def page_links(pages: DataFrame, spec: PageSpec = PageSpec()) -> DataFrame:
    """X1, X2, X3 and the page title."""
    return _title(_links(_opened(pages), spec)).select("page_id", *_link_fields(), E.text_of(F.col("__title")).alias("page_title"))


def page_markers(pages: DataFrame, spec: PageSpec = PageSpec(), lang: str = "es") -> DataFrame:
    """X4/F10 (failure block -> link not found), F12 (notice text), and a language marker."""
    df = _markers(_opened(pages), spec)
    in_lang = F.size(E.positions(F.col("__page"), Match("html", "lang", lang, "contains"))) > 0
    return df.select("page_id", F.col("__failed").alias("is_failure"), (~F.col("__failed")).alias("is_link_found"),
                     F.coalesce(in_lang, F.lit(False)).alias("has_lang_marker"), F.col("__noticed").alias("has_notice"))


def page_threshold(pages: DataFrame, spec: PageSpec = PageSpec()) -> DataFrame:
    """X5 + P17 + F9: numeric label and whether it reaches the threshold."""
    return _label(_opened(pages), spec).select("page_id", tolerant_double("__label").alias("label_value"),
                                               at_least("__label", spec.label_threshold).alias("above_threshold"))


def page_url_filename(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """File name a download URL would be saved under."""
    return pages.select("page_id", url_filename(url_col).alias("url_filename"))


def extract_page_fields(pages: DataFrame, spec: PageSpec = PageSpec()) -> DataFrame:
    """Every page field in one pass over the pages."""
    df = _title(_label(_markers(_links(_opened(pages), spec), spec), spec))
    return df.select("page_id", *_link_fields(), E.text_of(F.col("__title")).alias("page_title"),
                     F.col("__failed").alias("is_failure"), (~F.col("__failed")).alias("is_link_found"), F.col("__noticed").alias("has_notice"),
                     tolerant_double("__label").alias("label_value"), at_least("__label", spec.label_threshold).alias("above_threshold"),
                     url_filename("url").alias("url_filename"))
