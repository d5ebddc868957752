"""Operator 2: the main text of web pages by scoring the element tree.

Paragraphs pass points for their length and commas to their ancestors, less with each
level; a container's points are discounted by its share of link text. The best container
and those of its siblings that score well are kept, without boilerplate inside. What only
its class, id or role or a form calls boilerplate is measured first: the wrapper of most
of a page's paragraphs is not.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlens.llm.shared import text_slices

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|title|svg|math|iframe|object)\b(?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs2>[^>]*)>"
    r"|<[!?/][^>]*>|<[/a-zA-Z][^>]*\Z", re.S | re.I)
_ATTR = re.compile(r"""\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that never hold the article's text.
DROPPED = set("nav footer aside button select option menu dialog head label audio video canvas map".split())
#: Elements that are dropped unless they wrap the page's paragraphs, as by a class word.
FORMS = {"form", "fieldset"}
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q s samp small span "
             "strike strong sub sup time tt u var wbr ruby rb rt rp".split())
#: Elements whose text is a paragraph; others count if they hold text directly.
PARAGRAPHS = {"p", "pre", "td", "blockquote"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: A start tag closes these when they are open, up to the nearest of the stops.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}),
          "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead"}, {"table"})}
#: Words of class, id and role that mark boilerplate.
BOILERPLATE = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|adbox|adsense|banner|breadcrumbs?|comments?|commentlist|"
    r"complementary|consent|contentinfo|cookies?|cookie-?\w*|copyright|disqus|footer|gdpr|header|legal|login|masthead|"
    r"menus?|modal|nav|navbar|navigation|newsletter|notices?|notification|outbrain|overlay|pager|pagination|paywall|"
    r"popups?|promos?|promotions?|recommended|recommendations|related|replies|reply|respond|search|share|sharing|sidebars?|"
    r"site-?header|site-?footer|skip|social|sponsors?|sponsored|subscribe|subscription|taboola|tags|toolbar|"
    r"trending|warning|widgets?)(?:$|[\s_-])", re.I)
COMMENTS = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|disqus|replies|reply|respond)(?:$|[\s_-])", re.I)
PREFERRED = re.compile(r"article|body|content|entry|main|post|story|text", re.I)

#: Points by the method: a paragraph of at least so many characters gets 1, 1 for each
#: comma and 1 for each 100 characters up to 3.
LEAST_LENGTH, LEVELS = 25, 5
SIBLING_SHARE, LINK_LIST = 0.2, 0.5
#: A wrapper's paragraphs have at most this share of its points beside it.
BESIDE = 0.2
#: Elements that tell where the article is.
MARKS = {"article", "main", "h1"}


class Tree:
    """Elements in page order: an element's descendants follow it up to ``last``. Text
    of boilerplate is not in the tree, but that of elements in ``doubted`` is until their
    paragraphs are counted."""

    def __init__(self, page: str):
        self.tag, self.parent, self.last, self.weight = ["#"], [-1], [0], [0.0]
        self.first_chunk, self.end_chunk = [0], [0]
        self.chunks: list[tuple[int, str, bool]] = []  # (element, text, in a link)
        self.doubted: dict[int, tuple[bool, int]] = {}  # element: (named as comments, articles around it)
        self.gone: set[int] = set()  # of the doubted
        stack, skipped, links, at = [0], 0, 0, 0  # skipped: depth of boilerplate

        def close(down_to: int) -> None:
            nonlocal skipped, links
            while len(stack) > down_to:
                node = stack.pop()
                if node < 0:
                    skipped -= 1
                    continue
                links -= self.tag[node] == "a"
                self.last[node], self.end_chunk[node] = len(self.tag) - 1, len(self.chunks)

        def text(piece: str) -> None:
            if piece and not skipped:
                self.chunks.append((stack[-1], html.unescape(piece), links > 0))

        names = ["#"]  # of the open elements, boilerplate too
        for m in _TOKEN.finditer(page):
            text(page[at:m.start()])
            at = m.end()
            tag = m["tag"] or m["tag2"]
            if not tag:
                continue
            tag = tag.lower()
            if m["end"] or m["end2"]:
                if tag in names:
                    down = len(names) - 1 - names[::-1].index(tag)
                    close(down)
                    del names[down:]
                elif tag == "br":
                    self._gap(stack[-1], skipped)
                continue
            if tag in VOID:
                if tag in ("br", "hr"):
                    self._gap(stack[-1], skipped)
                continue
            closes, stops = CLOSES.get(tag, ((), ()))
            if not closes and tag not in INLINE and "p" in names:
                closes, stops = {"p"}, {"td", "th", "table", "button", "object"}
            for down in range(len(names) - 1, 0, -1) if closes else ():
                if names[down] in closes:
                    close(down)
                    del names[down:]
                    break
                if names[down] in stops:
                    break
            names.append(tag)
            attrs = m["attrs"] or m["attrs2"] or ""
            why = None if skipped else self._boilerplate(tag, attrs, names)
            if skipped or why == "sure":
                skipped += 1
                stack.append(-1)
                continue
            if why:
                self.doubted[len(self.tag)] = why == "comments", names[:-1].count("article") + names[:-1].count("main")
            links += tag == "a"
            self.parent.append(stack[-1])
            stack.append(len(self.tag))
            self.tag.append(tag)
            self.weight.append(25.0 if tag in ("article", "main") or attrs and PREFERRED.search(attrs) and
                               any(PREFERRED.search(v) for _, v in _ATTR.findall(attrs)) else 0.0)
            self.last.append(0)
            self.first_chunk.append(len(self.chunks))
            self.end_chunk.append(0)
        text(page[at:])
        close(0)
        self._measure()
        if self.doubted:
            self._drop()

    def _gap(self, node: int, skipped: int) -> None:
        if not skipped:
            self.chunks.append((node, " ", False))

    @staticmethod
    def _boilerplate(tag: str, attrs: str, names: list[str]) -> str | None:
        """"sure", or by its name only "comments" or "word"; None for other elements."""
        if tag in DROPPED or tag == "header" and not ("article" in names or "main" in names):
            return "sure"
        why = "word" if tag in FORMS else None
        if not attrs or tag in ("html", "body"):
            return why
        for name, value in _ATTR.findall(attrs):
            name = name.lower()
            if name in ("class", "id", "role"):
                value = value.strip("\"'")
                if COMMENTS.search(value):
                    why = "comments"
                elif tag not in ("article", "main", "header") and BOILERPLATE.search(value):
                    why = why or "word"
            elif name == "hidden" and tag not in INLINE or name == "aria-hidden" and "true" in value \
                    or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return "sure"
        return why

    def _drop(self) -> None:
        """Take the text of the doubted elements away, from the outermost on, but for
        those that wrap the page's paragraphs."""
        got = [0.0] * len(self.tag)
        for node, points in self._paragraphs(1):
            got[node] += points
        points, marks = [0.0, *accumulate(got)], [0, *accumulate(t in MARKS for t in self.tag)]
        inside = lambda sums, n: sums[self.last[n] + 1] - sums[n]
        within: dict[int, list[int]] = {}  # the doubted by the nearest doubted around them
        around = [-1]
        for n in self.doubted:
            while around[-1] >= 0 and self.last[around[-1]] < n:
                around.pop()
            within.setdefault(around[-1], []).append(n)
            around.append(n)
        # what is not in a doubted element
        free, free_marks = points[-1], marks[-1]
        todo = within.get(-1, [])
        free -= sum(inside(points, n) for n in todo)
        free_marks -= sum(inside(marks, n) for n in todo)
        while todo:
            wrapper = next((n for n in todo if self._wraps(n, inside(points, n), points[-1], free, inside(marks, n), free_marks)), None)
            self.gone.update(n for n in todo if n != wrapper)
            todo = within.get(wrapper, []) if wrapper is not None else []
            if wrapper is not None:
                free += inside(points, wrapper) - sum(inside(points, n) for n in todo)
                free_marks += inside(marks, wrapper) - sum(inside(marks, n) for n in todo)
        kept, chunk = [True] * len(self.chunks), [0]
        for n in self.gone:
            kept[self.first_chunk[n]:self.end_chunk[n]] = [False] * (self.end_chunk[n] - self.first_chunk[n])
        chunk += accumulate(kept)
        self.chunks = [c for c, k in zip(self.chunks, kept) if k]
        self.first_chunk, self.end_chunk = [chunk[x] for x in self.first_chunk], [chunk[x] for x in self.end_chunk]
        self._measure()

    def _wraps(self, node: int, own: float, total: float, free: float, marks: int, free_marks: int) -> bool:
        """Whether a doubted element with ``own`` of the ``total`` points, ``free`` beside
        it, holds the article: most points, and no sign of an article beside it."""
        comments, articles = self.doubted[node]
        if own * 2 <= total:
            return False
        beside = free_marks - articles  # an article around it is no other one
        if free < 1e-9 and beside <= 0 or marks and beside <= 0:
            return True
        if comments or beside > 0 and not articles:
            return False
        return free <= BESIDE * own

    def _measure(self) -> None:
        """Sums over the chunks, so that any element's are a difference."""
        sizes = [len(" ".join(t.split())) for _, t, _ in self.chunks]
        self.chars = [0, *accumulate(sizes)]
        self.linked = [0, *accumulate(n * link for n, (_, _, link) in zip(sizes, self.chunks))]
        self.commas = [0, *accumulate(sum(map(t.count, ",،、，")) for _, t, _ in self.chunks)]

    def over(self, sums: list[int], node: int) -> int:
        return sums[self.end_chunk[node]] - sums[self.first_chunk[node]]

    def link_share(self, node: int) -> float:
        return self.over(self.linked, node) / max(1, self.over(self.chars, node))

    def _paragraphs(self, least: int) -> Iterator[tuple[int, float]]:
        """The paragraphs of ``least`` characters and their points."""
        direct: dict[int, list[int]] = {}
        for i, (node, _, _) in enumerate(self.chunks):
            while self.tag[node] in INLINE:
                node = self.parent[node]
            if self.tag[node] not in HEADINGS:
                direct.setdefault(node, []).append(i)
        for node, own in direct.items():
            size = sum(self.chars[i + 1] - self.chars[i] for i in own)
            if size < least:
                continue
            linked = sum(self.linked[i + 1] - self.linked[i] for i in own)
            got = 1 + sum(self.commas[i + 1] - self.commas[i] for i in own) + min(size // 100, 3)
            got *= 1 - linked / size
            yield node, got

    def scores(self, least: int) -> dict[int, float]:
        """Points of every container that a paragraph of ``least`` characters passes any."""
        points: dict[int, float] = {}
        for node, got in self._paragraphs(least):
            up = self.parent[node] if self.tag[node] in PARAGRAPHS | {"li", "dd", "dt", "th"} and node else node
            for level in range(LEVELS):
                if up < 0:
                    break
                points[up] = points.get(up, self.weight[up]) + got / (1, 2, 6, 9, 12)[level]
                up = self.parent[up]
        return {n: p * (1 - self.link_share(n)) for n, p in points.items()}

    def children(self, node: int) -> list[int]:
        return [n for n in range(node + 1, self.last[node] + 1) if self.parent[n] == node]

    def kept(self) -> list[int]:
        """The containers to take, in page order."""
        for least in (LEAST_LENGTH, 1):
            if points := self.scores(least):
                break
        else:
            named = [n for n, t in enumerate(self.tag) if t in ("article", "main") and not any(g <= n <= self.last[g] for g in self.gone)]
            return named[:1] or [0]
        best = max(points, key=lambda n: (points[n], -n))
        around = best
        while around > 0 and self.tag[around] != "article":
            around = self.parent[around]
        if around > 0:
            best = around  # the best container is a part of an article: take the article
        if self.parent[best] < 0:
            return [best]
        enough = max(10.0, points.get(best, 0.0) * SIBLING_SHARE)
        return [n for n in self.children(self.parent[best]) if n == best or points.get(n, 0.0) >= enough or self._goes_along(n)]

    def _goes_along(self, node: int) -> bool:
        size, share = self.over(self.chars, node), self.link_share(node)
        if self.tag[node] in HEADINGS:
            return share == 0
        return self.tag[node] == "p" and (size > 80 and share < 0.25 or size > 0 and share == 0)

    def text(self) -> str:
        out: list[str] = []
        for top in self.kept():
            listed, until = set(), top  # elements inside link lists, each counted once
            for n in range(top + 1, self.last[top] + 1):
                if self.last[n] > until and self.tag[n] in ("ul", "ol", "table", "div", "section") and self.link_share(n) > LINK_LIST:
                    listed.update(range(max(n, until + 1), self.last[n] + 1))
                    until = self.last[n]
            block, was = [], None
            for node, piece, _ in self.chunks[self.first_chunk[top]:self.end_chunk[top]]:
                if node in listed:
                    continue
                while self.tag[node] in INLINE:
                    node = self.parent[node]
                if node != was:
                    out.append("".join(block))
                    block, was = [], node
                block.append(piece)
            out.append("".join(block))
        return " ".join(" ".join(out).split())


def main_text(page: str | None) -> str:
    """The article of one page; empty for a null or empty page."""
    return Tree(page).text() if page else ""


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every page, from its whole html.

    Null and empty pages have an empty text; null ids and urls stay null; repeated rows
    are answered each; other columns are not read. One narrow pass, no shuffle."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "html"):
            texts = [main_text(x) for x in batch.column(2).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                   pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(task, "page_id long, url string, text string, n_chars long")
