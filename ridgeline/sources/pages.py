"""Stored HTML pages with issued levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.functions import label_band, label_level
from ridgeline.schemas import BANDS

# Class names that mark the parts of a page.
ZONE_CLASS = "nac-h2"
BOX_CLASS = "nac-dangerToday"
DATE_CLASS = "nac-dangerDate"
BLOCK_CLASS = "nac-elevationBlock"
BAND_CLASS = "nac-elevationLabel"
LEVEL_CLASS = "nac-dangerLabel"


def plain_text(html: Column) -> Column:
    """Text of a fragment: tags removed, the common entities decoded."""
    text = F.regexp_replace(html, r"(?s)<[^>]*>", "")
    for entity, char in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.trim(text)


def tag_text(html: Column, tag: str) -> Column:
    """Text of the first element of a tag, null if there is none."""
    inner = F.regexp_extract(html, rf"(?s)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>", 1)
    return F.when(html.rlike(rf"(?s)<{tag}(?:\s[^>]*)?>.*?</{tag}>"), plain_text(inner))


def class_text(html: Column, name: str) -> Column:
    """Text of the first element that carries a class name."""
    opening = rf"(?s)<(\w+)[^>]*class=\"[^\"]*\b{name}\b[^\"]*\"[^>]*>(.*?)</\1>"
    inner = F.regexp_extract(html, opening, 2)
    return F.when(html.rlike(opening), plain_text(inner))


def page_summary(pages: DataFrame, html: str = "html") -> DataFrame:
    """Title, first heading and number of links of every page."""
    body = F.col(html)
    return pages.withColumns({
        "title": tag_text(body, "title"),
        "heading": tag_text(body, "h1"),
        "links": F.size(F.regexp_extract_all(body, F.lit(r"<a\s[^>]*href="), F.lit(0))).cast("bigint"),
    }).drop(html)


def long_date(text: Column) -> Column:
    """Date written like ``Wednesday, February 25, 2026``."""
    return F.try_to_date(F.regexp_replace(F.trim(text), r"^[A-Za-z]+,\s*", ""), "MMMM d, yyyy")


def _in_band(band: str):
    return lambda block: block.band == F.lit(band)


def read_levels(pages: DataFrame, html: str = "html") -> DataFrame:
    """Zone, date and the level of each band of a stored page.

    Only the first box of a page counts. Parts a page lacks are null.
    """
    body = F.col(html)
    box = F.get(F.split(body, BOX_CLASS, 3), F.lit(1))
    parts = F.split("_box", BLOCK_CLASS)
    blocks = F.slice(parts, F.lit(2), F.size(parts))
    # Each part starts inside the tag that carried the class name.
    read = F.transform(
        blocks,
        lambda b: F.struct(
            label_band(class_text(b, BAND_CLASS)).alias("band"), label_level(class_text(b, LEVEL_CLASS)).alias("level")
        ),
    )
    rows = pages.withColumns({
        "zone_name": F.lower(class_text(body, ZONE_CLASS)), "_box": box,
    }).withColumns({"date": long_date(class_text(F.col("_box"), DATE_CLASS)), "_blocks": read})
    levels = {
        band: F.get(F.filter("_blocks", _in_band(band)), F.lit(0)).getField("level")
        for band in BANDS
    }
    return rows.withColumns(levels).drop("_box", "_blocks", html)


def card_date(text: Column) -> Column:
    """Date in the first three words of an archive card."""
    words = F.split(text, " ")
    year = F.regexp_replace(F.get(words, F.lit(2)), r"\D", "")
    return F.try_to_date(F.concat_ws(" ", F.get(words, F.lit(0)), F.get(words, F.lit(1)), year), "MMM d, yyyy")


def cards_of_day(cards: DataFrame, day: str | Column, text: str = "text") -> DataFrame:
    """Distinct cards written for a day."""
    wanted = (day if isinstance(day, Column) else F.lit(day)).cast("date")
    return cards.withColumn("date", card_date(F.col(text))).filter(F.col("date") == wanted).dropDuplicates([text])
