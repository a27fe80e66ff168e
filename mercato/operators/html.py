"""HTML listing extraction as a Spark job.

``parse_listings`` runs a stdlib ``html.parser`` per page inside
``mapInPandas`` (Arrow batches in, one row per article out, fixed schema, so
pages without articles simply yield nothing).  ``listing_features`` then
derives the typed columns with built-in expressions only.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.text import digits_to_int, first_word

LISTING_SCHEMA = ("page_id long, article_idx int, title string, link string, price_text string, "
                  "garage string, details array<string>, description string")

# The listing site's base URL and the article classes of a listing.
BASE_URL = "https://www.idealista.pt"
LISTING_CLASSES = ("item", "extended-item")


class _ArticleParser(HTMLParser):
    def __init__(self, classes):
        super().__init__(convert_charrefs=True)
        self.classes = classes
        self.items: list[dict] = []
        self.cur: dict | None = None
        self.nest = 0
        self.field: str | None = None
        self.field_tag: str | None = None
        self.buf: list[str] = []

    def _flush(self):
        if self.cur is not None and self.field:
            text = "".join(self.buf).strip()
            f = self.field
            if f == "detail":
                self.cur["details"].append(text)
            elif f == "para":
                if text:
                    self.cur["paras"].append(text)
            elif f == "heading":
                if self.cur["heading"] is None:
                    self.cur["heading"] = text
            elif f == "price":
                self.cur["price_text"] = text
            elif f == "description":
                self.cur["description"] = text
        self.field, self.field_tag, self.buf = None, None, []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        cls = (a.get("class") or "").split()
        if tag == "article":
            if self.cur is None:
                if self.classes is None or any(c in cls for c in self.classes):
                    self.cur = {"title": None, "link": None, "price_text": None, "garage": "No", "details": [],
                                "description": None, "paras": [], "heading": None}
                    self.nest = 1
                return
            self.nest += 1
            return
        if self.cur is None:
            return
        if tag == "p" and self.field == "para":
            self._flush()
        if tag == "a" and "item-link" in cls:
            self.cur["title"] = a.get("title") or ""
            self.cur["link"] = BASE_URL + (a.get("href") or "")
        elif tag == "span" and "item-parking" in cls:
            self.cur["garage"] = "Yes"
        elif self.field is None:
            if tag == "span" and "item-price" in cls:
                self.field, self.field_tag = "price", tag
            elif tag == "span" and "item-detail" in cls:
                self.field, self.field_tag = "detail", tag
            elif tag == "div" and "item-description" in cls:
                self.field, self.field_tag = "description", tag
            elif tag in ("h1", "h2"):
                self.field, self.field_tag = "heading", tag
            elif tag == "p":
                self.field, self.field_tag = "para", tag

    def handle_endtag(self, tag):
        if self.cur is None:
            return
        if tag == "article":
            self.nest -= 1
            if self.nest == 0:
                self._flush()
                self._close()
            return
        if self.field and tag == self.field_tag:
            self._flush()

    def handle_data(self, data):
        if self.cur is not None and self.field:
            self.buf.append(data)

    def _close(self):
        c = self.cur
        title = c["title"] if c["title"] is not None else (c["heading"] or "")
        desc = c["description"] if c["description"] is not None else " ".join(c["paras"])
        self.items.append({"title": title, "link": c["link"], "price_text": c["price_text"],
                           "garage": c["garage"], "details": c["details"], "description": desc})
        self.cur = None


def extract_articles(html: str, classes=LISTING_CLASSES) -> list[dict]:
    p = _ArticleParser(classes)
    p.feed(html or "")
    p.close()
    if p.cur is not None:  # unterminated article at end of file
        p._flush()
        p._close()
    return p.items


def parse_listings(pages: DataFrame, key: str = "page_id", html: str = "html",
                   classes=LISTING_CLASSES) -> DataFrame:
    """One row per article of every page (pages are independent: no shuffle)."""
    def run(batches):
        for pdf in batches:
            out = []
            for pid, doc in zip(pdf[key].tolist(), pdf[html].tolist()):
                for i, it in enumerate(extract_articles(doc, classes)):
                    out.append({"page_id": pid, "article_idx": i, **it})
            yield pd.DataFrame(out, columns=["page_id", "article_idx", "title", "link", "price_text", "garage",
                                             "details", "description"])

    from mercato.operators.relational import spread
    return spread(pages.select(key, html)).mapInPandas(run, LISTING_SCHEMA)


def listing_features(listings: DataFrame) -> DataFrame:
    """Typed listing columns from the raw article fields (built-ins only)."""
    d = F.col("details")
    third = F.get(d, 2)
    has_floor = third.contains("andar")
    price = digits_to_int(F.col("price_text"))
    area = F.regexp_extract(F.get(d, 1), r"\d+", 0).try_cast("int")
    return listings.select(
        "page_id", "article_idx", "title", first_word(F.col("title")).alias("home_type"), "link",
        price.alias("price"), "garage", F.get(d, 0).alias("home_size"), area.alias("home_area"),
        F.when(has_floor, F.regexp_extract(third, r"\d+", 0).try_cast("int")).otherwise(F.lit(0)).alias("floor"),
        F.coalesce(F.when(has_floor, third.contains("com elevador")), F.lit(False)).alias("elevator"),
        F.try_divide(price, area).alias("price_per_sqr_meter"),
        F.trim("description").alias("description"))


def page_text(pages: DataFrame) -> DataFrame:
    """Built-in fast path: <title> and tag-stripped text per page."""
    text = F.trim(F.regexp_replace(F.regexp_replace("html", r"<[^>]+>", " "), r"\s+", " "))
    return pages.select("page_id", F.regexp_extract("html", r"<title>(.*?)</title>", 1).alias("title"),
                        text.alias("text"))
