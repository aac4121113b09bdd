"""HTML extraction by text-to-tag ratios.

The standard library's parser streams events over the page. Every block of text is a line with its characters and its tags.
The ratios of text to tags are smoothed with a Gaussian along the page and split in two clusters by the threshold between
them; the upper cluster marks the content. The content region is the article (or main) element that holds marked lines,
or else the smallest element around all of them, and everything in it is kept but what its element or class names as
menu, advert, form, notice, comment and the like.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts

CHUNK, SIGMA = 1 << 16, 1.0
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark", "q", "s", "samp", "small",
          "span", "strong", "strike", "sub", "sup", "time", "tt", "u", "var", "big", "br", "wbr", "img"}
#: Elements that never belong to the main text, and those that hold no text to read.
ASIDE = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "textarea", "label", "fieldset"}
UNREAD = {"script", "style", "noscript", "template", "iframe", "svg", "object", "canvas", "head", "title", "audio", "video", "datalist"}
#: Words of class, id and role that name such parts.
NAMED = set("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
            "popup modal overlay subscribe subscription newsletter signup login nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar "
            "footer masthead topbar toolbar share sharing social related recommended widget pagination pager search alert toast "
            "complementary contentinfo".split())
REMARKS = set("comment comments commentlist reply replies respond disqus discussion".split())
NAME = re.compile(r"[a-z]+")
BLANK = re.compile(r"\s+")


@dataclass
class Line:
    """A block of text, the elements around it (as numbers, outermost first), and its tags."""

    text: str
    tags: int
    within: tuple[int, ...]


class Lines(HTMLParser):
    """Collects the lines of a page that no element or class names as boilerplate."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.names: list[str] = []  # of every container opened so far
        self.stack: list[tuple[str, str, int]] = []  # (tag, "" or why it is left out, container number or -1)
        self.left_out = 0
        self.parts: list[str] = []
        self.tags = 1

    def end_line(self) -> None:
        text = BLANK.sub(" ", "".join(self.parts)).strip()
        if text:
            self.lines.append(Line(text, self.tags, tuple(n for _, _, n in self.stack if n >= 0)))
        self.parts, self.tags = [], 1

    def why(self, tag: str, attrs: list[tuple[str, str | None]]) -> str:
        if tag in UNREAD:
            return "unread"
        if tag in ASIDE or tag == "header" and not any(t in ("article", "main") for t, _, _ in self.stack):
            return "aside"
        found = {w for k, v in attrs if k in ("class", "id", "role") and v for w in NAME.findall(v.lower())}
        if tag in ("html", "body", "article", "main"):  # their classes describe the page ("has-sidebar")
            return "remark" if tag == "article" and found & REMARKS else ""
        return "remark" if found & REMARKS else "aside" if found & NAMED else ""

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in INLINE:
            self.end_line()
        self.tags += 1
        if tag in VOID:
            if tag == "br":
                self.parts.append(" ")
            return
        why = self.why(tag, attrs)
        if tag in ("article", "main") and not why:
            # A part left open by mistake does not swallow the article.
            while self.left_out and not any(w == "remark" for _, w, _ in self.stack):
                self.pop()
        container = -1
        if tag not in INLINE and tag != "p":
            container = len(self.names)
            self.names.append(tag)
        self.stack.append((tag, why, container))
        self.left_out += bool(why)

    def pop(self) -> None:
        _, why, _ = self.stack.pop()
        self.left_out -= bool(why)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self.end_line()
        self.tags += 1
        for depth in range(len(self.stack) - 1, -1, -1):
            if self.stack[depth][0] == tag:
                while len(self.stack) > depth:
                    self.pop()
                return
            if self.stack[depth][0] in ("article", "main", "body") and tag not in ("body", "html", "main", "article"):
                return

    def handle_data(self, data: str) -> None:
        if not self.left_out:
            self.parts.append(data)


def marked(lines: list[Line]) -> np.ndarray:
    """Which lines belong to the upper cluster of smoothed text-to-tag ratios."""
    ratio = np.array([len(x.text) / x.tags for x in lines])
    reach = np.arange(-3, 4)
    kernel = np.exp(-(reach**2) / (2 * SIGMA**2))
    smooth = np.convolve(ratio, kernel / kernel.sum(), mode="full")[3 : 3 + len(ratio)]
    low, high = smooth.min(), smooth.max()
    while True:  # two means of numbers on a line: they only move outward or stay
        cut = (low + high) / 2
        above = smooth >= cut
        means = (smooth[~above].mean() if (~above).any() else low), smooth[above].mean()
        if np.allclose(means, (low, high)):
            return above
        low, high = means


def main_text(html: str) -> str:
    """The main text of a page, one block a line."""
    parser = Lines()
    for i in range(0, len(html), CHUNK):
        parser.feed(html[i : i + CHUNK])
    parser.close()
    parser.end_line()
    lines = parser.lines
    if not lines:
        return ""
    content = marked(lines)
    inside = [x for x, m in zip(lines, content) if m]
    chars = sum(len(x.text) for x in inside)
    for kind in ("article", "main"):
        roots = {next(n for n in x.within if parser.names[n] == kind) for x in inside if any(parser.names[n] == kind for n in x.within)}
        held = sum(len(x.text) for x in inside if roots & set(x.within))
        if roots and 2 * held >= chars:
            return "\n".join(x.text for x in lines if roots & set(x.within))
    shared = 0
    while all(len(x.within) > shared and x.within[shared] == inside[0].within[shared] for x in inside):
        shared += 1
    region = inside[0].within[:shared]
    # A lone marked line would shrink the region to its own block.
    while region and parser.names[region[-1]] not in ("div", "section", "body", "html", "td", "center"):
        region = region[:-1]
    return "\n".join(x.text for x in lines if x.within[: len(region)] == region)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    Null and empty pages, and pages without text, give empty text. Text outside any element counts as a block of its own.
    Repeated rows give repeated results.
    """
    def work(texts: list[str]) -> dict:
        found = [main_text(t) for t in texts]
        return {"found": pa.array(found, pa.string()), "n_chars": pa.array(list(map(len, found)), pa.int64())}

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("text"))
    return map_texts(rows, work, "page_id long, url string, found string, n_chars long", ["page_id", "url"]).withColumnRenamed("found", "text")
