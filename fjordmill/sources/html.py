"""HTML pages and HTML exports with the standard library's parser, in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fjordmill.functions import urls
from fjordmill.session import ship_package

SKIPPED = {"script", "style", "noscript", "template", "nav", "header", "footer", "aside", "form"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCKS = {"p", "div", "li", "h1", "h2", "h3", "h4", "h5", "h6", "br", "tr", "section", "article", "main", "body", "blockquote"}


class PageParser(HTMLParser):
    """Title, metadata and text of a page: of its first article, else main, else body, without furniture elements."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.meta: dict[str, str] = {}
        self.lang = None
        self.title: list[str] = []
        self.texts: dict[str, list[str]] = {"article": [], "main": [], "body": []}
        self.open: list[str] = []
        self.done: set[str] = set()

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "html":
            self.lang = a.get("lang")
        if tag == "meta":
            name = (a.get("name") or a.get("property") or "").lower()
            if name and a.get("content"):
                self.meta.setdefault(name, a["content"])
        if tag == "time" and a.get("datetime"):
            self.meta.setdefault("time", a["datetime"])
        if tag in BLOCKS:
            self._add("\n")
        if tag not in VOID:
            self.open.append(tag)

    def handle_endtag(self, tag):
        if tag in self.open:
            while self.open and self.open.pop() != tag:
                pass
            if tag in ("article", "main") and tag not in self.open:
                self.done.add(tag)
        if tag in BLOCKS:
            self._add("\n")

    def _add(self, data: str):
        for part, texts in self.texts.items():
            if part in self.open and part not in self.done:
                texts.append(data)

    def handle_data(self, data):
        if self.open and self.open[-1] == "title" and "body" not in self.open:
            self.title.append(data)
        elif not SKIPPED.intersection(self.open):
            self._add(data)

    def result(self) -> dict:
        body = next((t for t in (clean("".join(x)) for x in self.texts.values()) if t), "")
        first = lambda *names: next((self.meta[n] for n in names if self.meta.get(n)), None)
        return {
            "title": " ".join("".join(self.title).split()) or first("og:title"), "content": body, "description": first("description", "og:description"),
            "author": first("author", "article:author", "dc.creator", "byl"), "date": first("article:published_time", "date", "dc.date", "time"), "language": self.lang or first("language", "og:locale"),
        }


def clean(text: str) -> str:
    return "\n".join(x for x in (" ".join(line.split()) for line in text.split("\n")) if x)


def parse_page(html: str | None) -> dict:
    p = PageParser()
    if html:
        p.feed(html)
        p.close()
    return p.result()


COLUMNS = ["title", "content", "description", "author", "date", "language"]


def extract_pages(df: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """id, title, content, description, author, date, language of each page; null pages have an empty content."""
    ship_package(df.sparkSession)
    kind = dict(df.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pages = [parse_page(h) for h in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([p[c] for p in pages], pa.string()) for c in COLUMNS)], ["id", *COLUMNS])

    return df.select(F.col(id_col).alias("id"), F.col(html_col).cast("string")).mapInArrow(run, f"id {kind}, " + ", ".join(f"{c} string" for c in COLUMNS))


class ActivityParser(HTMLParser):
    """Times, posts and media of an HTML activity export."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple[str, str | None, str | None]] = []
        self.time: str | None = None
        self.post: list[str] | None = None
        self.depth = 0

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "time" and a.get("datetime"):
            self.time = a["datetime"]
            self.rows.append(("activity", self.time, None))
        elif tag in ("img", "video") and a.get("src"):
            self.rows.append(("photo" if tag == "img" else "video", self.time, a["src"]))
        elif tag == "div":
            if self.post is not None:
                self.depth += 1
            elif "_3-95" in (a.get("class") or "").split():
                self.post, self.depth = [], 1

    def handle_endtag(self, tag):
        if tag == "div" and self.post is not None:
            self.depth -= 1
            if not self.depth:
                text = " ".join("".join(self.post).split())
                if len(text) > 10:
                    self.rows.append(("post", self.time, text))
                self.post = None

    def handle_data(self, data):
        if self.post is not None:
            self.post.append(data)


def activities(df: DataFrame, file_col: str, html_col: str) -> DataFrame:
    """source_file, no, kind, time, value: what an HTML export holds, in document order, each with the time before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for name, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                p = ActivityParser()
                p.feed(html or "")
                p.close()
                rows += [(name, n, *r) for n, r in enumerate(p.rows)]
            columns = list(zip(*rows)) or [()] * 5
            types = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["source_file", "no", "kind", "time", "value"])

    ship_package(df.sparkSession)
    return df.select(F.col(file_col).cast("string"), F.col(html_col).cast("string")).mapInArrow(run, "source_file string, no int, kind string, time string, value string")


def urls_in_html(df: DataFrame, file_col: str, html_col: str) -> DataFrame:
    """source_file, pos, url: the URLs in a page's text and links, tags taken out by expression."""
    links = F.regexp_extract_all(F.col(html_col), F.lit("(?:href|src)=[\"'](https?://[^\"'<>\\s]+)"), F.lit(1))
    shown = urls.urls_in_text(F.regexp_replace(F.col(html_col), "<[^>]*>", " "))
    return df.select(F.col(file_col).alias("source_file"), F.posexplode(F.array_distinct(F.concat(links, shown))).alias("pos", "url"))


def viewed_links(df: DataFrame, file_col: str, html_col: str) -> DataFrame:
    """source_file, pos, day, url: links of a recently-viewed page, by the date text before them, shims decoded."""
    date = r"(?=(?:jan|feb|mar|apr|maj|may|jun|jul|aug|sep|okt|oct|nov|dec)[a-z]*\.? \d{1,2}, \d{4})"
    blocks = df.select(F.col(file_col).alias("source_file"), F.posexplode(F.split(F.col(html_col), "(?i)" + date)).alias("pos", "block"))
    day = F.nullif(F.regexp_extract("block", r"(?i)^([a-z]+\.? \d{1,2}, \d{4}(?: \d{1,2}:\d{2}:\d{2} [ap]m)?)", 1), F.lit(""))
    found = F.array_distinct(F.concat(urls.shim_targets("block"), F.filter(urls.urls_in_text(F.regexp_replace("block", "[\"'<>]", " ")), lambda u: ~u.contains("facebook.com"))))
    return blocks.select("source_file", "pos", day.alias("day"), F.explode(found).alias("url"))
