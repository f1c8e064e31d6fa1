"""Main text of web pages: parser events, text-to-tag ratio per line, Gaussian smoothing, threshold clustering.

The standard library's streaming parser turns a page into lines (one per block) with their text, tag and link counts and the
place of the block in the element tree.  Blocks that are never article text are masked: menus, page headers, footers,
sidebars, notices, adverts, forms, scripts, styles and reader comments, by element and by class, id or role.  A class, id or role
masks no element that wraps the page's article or without which little text is left.

The ratio of text (without links) to tags of the other lines is smoothed by a Gaussian; lines that reach the threshold (a share of the
smoothed ratios' standard deviation) before and after form the content clusters, and these alone choose the region: from the root down, an element in
which the clusters touch one container passes the choice on to it; one in which they touch several containers passes it on to each of
them; one whose own lines, paragraphs or other blocks without containers they touch is content, with all of its lines.  The page's
body itself is content from its first to its last touched block, with the headings before and the text blocks after.  So whole
articles, tables and lists stay, with short lines at their ends, and what the clusters do not reach goes.

One narrow stage: a page is read whole, nothing is shuffled.  Null and empty html give empty text; html without markup is its
own text; repeated rows are extracted alike; other columns are ignored by ``extract`` unless named in ``keep``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from capsight.llm.common import table, workers_import

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table "
    "tbody td tfoot th thead tr ul".split())
MASKED = frozenset(
    "applet aside audio button canvas datalist dialog embed fieldset footer form iframe input label legend map math menu meter nav "
    "noscript object optgroup option output progress script search select style svg template textarea title video".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
ARTICLE = frozenset(("article", "main"))
#: a new start of the key's element ends an open one of these, up to the nearest of the boundary elements
IMPLIED_END = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
               "option": ("option",), "optgroup": ("option", "optgroup")}
BOUNDARY = frozenset("ul ol dl table select body article main section div td th nav aside footer header form blockquote".split())
CLOSES_P = BLOCK - {"br"}
#: words in class, id or role that mark a masked block
HINTS = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert\w*|adsbygoogle|banner|breadcrumbs?|byline-share|comment\w*|consent|contentinfo|cookies?|copyright|disclaimer|"
    r"disqus\w*|footer\w*|gdpr|hidden|masthead|menu\w*|modal|nav|navbar|navigation|newsletter\w*|notices?|notification|outbrain|pager|pagination|"
    r"paywall|popup|promo\w*|recommend\w*|related\w*|replies|reply|respond|search|share\w*|sharing|sidebar\w*|signup|skip-?link|social\w*|"
    r"sponsor\w*|subscri\w*|taboola|tags?|toolbar|widget\w*|site-?header|page-?header|header|complementary|alert|cookiebar|aside)(?=$|[\s_-])")
NEVER_HINTED = frozenset(("html", "body", "main", "article", "p", "h1", "h2", "h3", "h4", "h5", "h6"))
COMMENT = re.compile(r"(?:^|[\s_-])(?:comment\w*|disqus\w*|repl(?:y|ies))(?=$|[\s_-])")

SIGMA = 1.0
THRESHOLD = 0.5  # of the standard deviation of the smoothed ratios
LEFT = 0.25  # share of the page's text that blocks marked by class, id or role must leave
LINKS = 0.6  # at the end of a page without containers, blocks with a larger share of linked text are no content
#: elements that hold running text and are never passed by on the way down
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote table ul ol dl figure caption center address".split())
PAGE = frozenset(("#", "html", "body"))


class Page(HTMLParser):
    """Unmasked lines of a page: ``text, tags, linked characters, heading, block``."""

    def __init__(self, freed: frozenset = frozenset(), marks: bool = False):
        super().__init__(convert_charrefs=True)
        self.freed = freed  # start tags, by number, whose class, id or role masks nothing
        self.marks = marks  # note marked elements instead of masking them
        self.starts = 0
        self.veils: list[int] = []  # heights of the stack at open elements that a class, id or role masks
        self.veiled = 0  # characters that only these mask
        self.doubt = False  # whether they mask an article
        self.marked: list[tuple[int, bool, int]] = []  # open elements: start tag, whether an article, height of the stack
        self.plain: dict[tuple[tuple[int, bool], ...], int] = {}  # characters without links by the open marked elements and articles
        self.lines: list[tuple[str, int, int, bool, int]] = []
        self.parent, self.tag = [-1], ["#"]  # element tree of the blocks, by number
        self.open: list[tuple[str, int, bool]] = []  # element, its block, whether it masks
        self.masks = self.links = self.heads = 0
        self.text: list[str] = []
        self.tags = self.linked = 0

    def block(self) -> int:
        return self.open[-1][1] if self.open else 0

    def flush(self) -> None:
        if self.text:
            if text := " ".join("".join(self.text).split()):
                self.lines.append((text, self.tags, self.linked, self.heads > 0, self.block()))
                self.tags = 0
            self.text.clear()
        self.linked = 0

    def pop(self) -> None:
        tag, _, masks = self.open[-1]
        if tag in BLOCK:
            self.flush()
        self.open.pop()
        if self.marked and self.marked[-1][2] > len(self.open):
            self.marked.pop()
        if self.veils and self.veils[-1] > len(self.open):
            self.veils.pop()
        self.masks -= masks
        self.links -= tag == "a"
        self.heads -= tag in HEADING

    def inside(self, tags: frozenset) -> bool:
        return any(t in tags for t, _, _ in self.open)

    def end_implied(self, tag: str) -> None:
        if tag in CLOSES_P:
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] == "p":
                    while len(self.open) > i:
                        self.pop()
                    break
                if self.open[i][0] in BOUNDARY:
                    break
        if ends := IMPLIED_END.get(tag):
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] in ends:
                    while len(self.open) > i:
                        self.pop()
                    break
                if self.open[i][0] in BOUNDARY:
                    break

    def masking(self, tag: str, attrs: list) -> bool:
        if tag in MASKED:
            return True
        if tag == "header":
            return not self.inside(ARTICLE)
        if not attrs:
            return False
        found = {k: v or "" for k, v in attrs}
        if "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", found.get("style", "")):
            return True
        if self.starts in self.freed or not self.hints(tag, found):
            return False
        if self.marks:
            self.marked.append((self.starts, False, len(self.open) + 1))
        else:
            self.veils.append(len(self.open) + 1)
        return not self.marks

    @staticmethod
    def hints(tag: str, found: dict) -> bool:
        name = " ".join(found.get(k, "") for k in ("class", "id", "role")).lower()
        if tag in NEVER_HINTED:
            return tag not in ("html", "body", "main") and bool(COMMENT.search(name) or re.search(r"(?:^|[\s_-])(?:ad|ads|advert\w*)(?=$|[\s_-])", name))
        return bool(name.strip()) and bool(HINTS.search(name))

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.tags += not self.masks
        self.starts += 1
        if tag in BLOCK:
            self.end_implied(tag)
            self.flush()
        if tag in ARTICLE and self.masks and not COMMENT.search(" ".join(v or "" for k, v in attrs if k in ("class", "id")).lower()):
            # an unclosed menu, header or form does not swallow the article
            at = next(i for i, (_, _, masks) in enumerate(self.open) if masks)
            if self.open[at][0] in ("nav", "header", "form") and not any(m for _, _, m in self.open[at + 1:]):
                while len(self.open) > at:
                    self.pop()
        if tag in VOID:
            return
        self.doubt = self.doubt or tag in ARTICLE and bool(self.veils)
        masks = self.masking(tag, attrs)
        if self.marks and tag in ARTICLE and not masks and not (self.marked and self.marked[-1][0] == self.starts):
            self.marked.append((self.starts, True, len(self.open) + 1))
        block = self.block()
        if tag in BLOCK:
            self.parent.append(block)
            self.tag.append(tag)
            block = len(self.parent) - 1
        self.open.append((tag, block, masks))
        self.masks += masks
        self.links += tag == "a"
        self.heads += tag in HEADING

    def handle_endtag(self, tag: str) -> None:
        self.tags += not self.masks
        if tag in BLOCK:
            self.flush()
        if tag in VOID:
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                while len(self.open) > i:
                    self.pop()
                break
            if tag not in BLOCK and self.open[i][0] in BLOCK:
                break  # a stray inline end tag closes no block

    def handle_data(self, data: str) -> None:
        if not self.masks:
            self.text.append(data)
            if self.links:
                self.linked += len(data)
            elif self.marks and (size := len("".join(data.split()))):
                at = tuple(m[:2] for m in self.marked)
                self.plain[at] = self.plain.get(at, 0) + size
        elif self.masks == len(self.veils):
            self.veiled += len(data)

    def updatepos(self, i: int, j: int) -> int:
        return j  # line numbers are not asked for

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        return self.parse_bogus_comment(i)


def smooth(values: list[float], sigma: float = SIGMA) -> list[float]:
    """Gaussian weights over three sigmas, normalised at the ends."""
    radius = max(1, math.ceil(3 * sigma))
    kernel = [math.exp(-k * k / (2 * sigma * sigma)) for k in range(-radius, radius + 1)]
    out = []
    for i in range(len(values)):
        a, b = max(0, i - radius), min(len(values), i + radius + 1)
        weights = kernel[a - i + radius:b - i + radius]
        out.append(sum(w * v for w, v in zip(weights, values[a:b])) / sum(weights))
    return out


def _wrappers(html: str) -> frozenset:
    """Start tags, by number, of elements whose class, id or role must not mask them.

    Those around the article or main element with the most text, if it has more than stands outside of marked elements; without
    articles outside of them, also the heaviest ones until ``LEFT`` of the text is left.
    """
    page = Page(marks=True)
    page.feed(html)
    page.close()
    articles, freed = {}, set()
    for at, size in page.plain.items():
        for k, (start, article) in enumerate(at):
            if article:
                around = frozenset(n for n, inner in at[:k] if not inner)
                held = articles.get(start, (0, around))[0]
                # marked elements inside the article do not count for it
                articles[start] = held + size * all(inner for _, inner in at[k:]), around

    def left() -> int:
        return sum(size for at, size in page.plain.items() if all(article or n in freed for n, article in at))

    if articles:
        size, around = max(articles.values(), key=lambda x: (x[0], -len(x[1])))
        if size > left():
            freed |= around
    if not any(size and around <= freed for size, around in articles.values()):
        total = sum(page.plain.values())
        while left() < LEFT * total:
            weight: dict[int, int] = {}
            for at, size in page.plain.items():
                if outer := next((n for n, article in at if not article and n not in freed), None):
                    weight[outer] = weight.get(outer, 0) + size
            freed.add(max(weight, key=weight.__getitem__))
    return frozenset(freed)


def chosen_lines(lines: list[tuple[str, int, int, bool, int]]) -> list[bool]:
    """The content clusters: lines whose ratio of text to tags reaches the threshold, smoothed (so among others of their kind) and by itself."""
    ratio = [max(0, len(text) - linked) / max(1, tags) for text, tags, linked, *_ in lines]
    level = smooth(ratio)
    mean = sum(level) / max(1, len(level))
    least = THRESHOLD * math.sqrt(sum((x - mean) ** 2 for x in level) / max(1, len(level)))
    return [r >= least and x >= least for r, x in zip(ratio, level)]


def region(page: Page, cluster: list[bool]) -> list[int]:
    """The lines of the region that the clusters choose, in page order."""
    parent, tag, lines = page.parent, page.tag, page.lines
    touched, holds = [0] * len(parent), [0] * len(parent)  # chosen lines, and all lines, under every block
    own: list[list[int]] = [[] for _ in parent]
    for i, (line, chosen) in enumerate(zip(lines, cluster)):
        own[line[4]].append(i)
        holds[line[4]] += 1
        touched[line[4]] += chosen
    children: list[list[int]] = [[] for _ in parent]
    for i in range(len(parent) - 1, 0, -1):
        touched[parent[i]] += touched[i]
        holds[parent[i]] += holds[i]
        if holds[i]:
            children[parent[i]].append(i)  # last first

    def subtree(node: int) -> list[int]:
        out, todo = [], [node]
        while todo:
            at = todo.pop()
            out += own[at]
            todo += children[at]
        return out

    taken: list[int] = []
    todo = [0] if touched[0] else []
    while todo:
        node = todo.pop()
        below = [i for i in children[node] if touched[i]]
        direct = any(cluster[i] for i in own[node]) or any(tag[i] in PROSE or not children[i] for i in below)
        if not direct:
            todo += below
        elif tag[node] not in PAGE:
            taken += subtree(node)
        else:  # blocks and lines of the page itself, in order: (first line, block or -1)
            parts = sorted([(i, -1) for i in own[node]] + [(min(subtree(i)), i) for i in children[node]])
            hit = [k for k, (i, block) in enumerate(parts) if (touched[block] if block >= 0 else cluster[i])]
            first, last = hit[0], hit[-1]
            while first and lines[parts[first - 1][0]][3]:
                first -= 1
            while last + 1 < len(parts):
                i, block = parts[last + 1]
                some = subtree(block) if block >= 0 else [i]
                if (block >= 0 and tag[block] not in PROSE) or sum(lines[k][2] for k in some) > LINKS * sum(len(lines[k][0]) for k in some):
                    break
                last += 1
            for k in range(first, last + 1):
                i, block = parts[k]
                if block < 0:
                    taken.append(i)
                elif tag[block] in PROSE or not children[block]:
                    taken += subtree(block)
                elif touched[block]:
                    todo.append(block)
    return sorted(taken)


def read(html: str) -> Page:
    """The page's lines; parsed again only where a class, id or role may have masked the article or most of the text."""
    page = Page()
    page.feed(html)
    page.close()
    page.flush()
    plain = sum(max(0, len(text) - linked) for text, _, linked, *_ in page.lines)
    if page.doubt or plain < 2 * LEFT * (plain + page.veiled):
        if page.veiled and (freed := _wrappers(html)):
            page = Page(freed)
            page.feed(html)
            page.close()
            page.flush()
    return page


def main_text(html: str | None) -> str:
    """The text of the page's content region, blocks joined by one space."""
    if not html:
        return ""
    page = read(html)
    return " ".join(page.lines[i][0] for i in region(page, chosen_lines(page.lines)))


def extract(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns with ``text`` and ``n_chars`` (code points)."""
    workers_import(pages.sparkSession)
    rows = pages.select(*keep, pages[html].cast("string").alias("_html"))
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [main_text(x.as_py()) for x in part.column(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    [*part.schema.names[:-1], "text", "n_chars"])

    return rows.mapInArrow(run, ", ".join([*fields, "text string", "n_chars long"]))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


QUERY = {"op7_html_text": op7_html_text}
