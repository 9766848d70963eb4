"""Main text of web pages by consensus host paths.

Pass 1 parses every page and scores its containers: text length, less the part inside links, weighted by
paragraphs and by what tag and class say. Every page votes for the generalised path (tags and classes from the
root, digits in classes folded) of its best container, with the container's share of the page's text as weight.
Spark sums the votes per host and path and keeps, per host, the path with most weight. Pass 2 parses again and
extracts from the host's winning path; a page without that path falls back to its own best container.

In both passes menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments
are left out, wherever they stand: by element name, by role, or by a word of class or id.

Unclosed elements end where their parent ends; a paragraph ends where the next block starts. Character
references are decoded, white space inside a block becomes one blank, blocks are joined by an empty line.

Votes are pre-summed per batch, so a host with a third of all pages is a few rows. The winning paths (one per
host) go to the pages by broadcast when their counted size allows it, so pages are not moved at all; beyond it the
join by host may be split, as its other side is unique.

Defined results: null or empty html, or a page without text, gives an empty text and no vote. A null url is a
host of its own. Repeated rows vote as often as they occur. Ties between paths go to the greater summed
text, then the smaller path. An empty table gives an empty result. Other columns are never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paypanel.llm.tables import hinted
from paypanel.plans.stages import written

# Fixed values of HTML: elements without end tags, elements that break a line of text, and what ends a paragraph.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
CLOSES = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]),
    "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
SCOPES = frozenset("ul ol menu dl table tbody thead tfoot article section main div body td th li aside nav form".split())
SKIPPED = frozenset(
    "head script style noscript template nav footer aside form button select textarea input label iframe object svg canvas "
    "audio video map menu dialog title".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
NOISE = re.compile(
    r"(?:^|[^a-z])(?:ad|ads|advert[a-z]*|sponsor[a-z]*|promo[a-z]*|banner|nav|navbar|navigation|menu|breadcrumbs?|pagination|pager|"
    r"header|masthead|footer|sidebar|side|aside|widget|related|recommended|cookie[a-z]*|consent|gdpr|notice|alert|popup|modal|"
    r"newsletter|subscribe|signup|login|share|sharing|social|comment[a-z]*|disqus|replies|respond|search|toolbar|skip|hidden)(?:$|[^a-z])"
)
GOOD = re.compile(r"(?:^|[^a-z])(?:article|content|entry|main|post|story|text|body)(?:$|[^a-z])")
CONTAINERS = frozenset("article main section div td body center blockquote".split())


class Node:
    """An open or closed container: its path, text and links inside, paragraphs inside."""

    __slots__ = ("path", "chars", "linked", "paragraphs", "bonus")

    def __init__(self, path: str, bonus: float):
        self.path, self.bonus = path, bonus
        self.chars = self.linked = self.paragraphs = 0


def generalised(tag: str, attrs: dict[str, str]) -> str:
    """Tag and sorted classes, digits folded, so that numbered classes fall together."""
    names = sorted({re.sub(r"\d+", "0", c) for c in attrs.get("class", "").lower().split()})
    return ".".join([tag, *names])


def is_noise(tag: str, attrs: dict[str, str], in_article: bool) -> bool:
    if tag in SKIPPED or "hidden" in attrs or attrs.get("aria-hidden") == "true" or attrs.get("role", "").lower() in ROLES:
        return True
    if "display:none" in attrs.get("style", "").replace(" ", "").lower():
        return True
    if tag == "header" and not in_article:
        return True
    if tag in ("html", "body", "article", "main", "p", "b", "i", "em", "strong", "a", "span", "h1", "h2", "h3"):
        named = f"{attrs.get('class', '')} {attrs.get('id', '')}".lower()
        return tag in ("p", "span", "a") and bool(NOISE.search(named)) and not GOOD.search(named)
    named = f"{attrs.get('class', '')} {attrs.get('id', '')}".lower()
    return bool(NOISE.search(named))


class Reader(HTMLParser):
    """One pass over a page: containers with their counts, and the blocks of text with the containers they lie in."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, Node | None]] = []  # tag, noise, container
        self.noisy = 0
        self.links = 0
        self.articles = 0
        self.nodes: list[Node] = []
        self.blocks: list[tuple[str, tuple[int, ...]]] = []
        self.text: list[str] = []
        self.within: tuple[int, ...] = ()
        self.linked = 0

    def end_block(self) -> None:
        joined = " ".join("".join(self.text).split())
        if joined:
            self.blocks.append((joined, self.within))
            for i in self.within:
                node = self.nodes[i]
                node.chars += len(joined)
                node.linked += min(self.linked, len(joined))
                node.paragraphs += 1
        self.text, self.linked = [], 0

    def pop(self) -> None:
        tag, noise, node = self.open.pop()
        if tag in BLOCK:
            self.end_block()
        self.noisy -= noise
        self.links -= tag == "a"
        self.articles -= tag == "article"
        if node is not None:
            self.within = self.within[:-1]

    def close_implied(self, tag: str) -> None:
        if tag in BLOCK:
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] == "p":
                    while len(self.open) > i:
                        self.pop()
                    break
                if self.open[i][0] in SCOPES:
                    break
        ends = CLOSES.get(tag)
        if ends:
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] in ends:
                    while len(self.open) > i:
                        self.pop()
                    break
                if self.open[i][0] in ("ul", "ol", "menu", "dl", "table", "select"):
                    break

    def handle_starttag(self, tag, attrs):
        given = {k: v or "" for k, v in attrs}
        self.close_implied(tag)
        if tag in BLOCK:
            self.end_block()
        if tag in VOID:
            if tag == "br":
                self.text.append(" ")
            return
        noise = is_noise(tag, given, self.articles > 0)
        node = None
        if tag in CONTAINERS and not self.noisy and not noise:
            above = self.nodes[self.within[-1]].path if self.within else ""
            named = f"{given.get('class', '')} {given.get('id', '')}".lower()
            bonus = {"article": 2.0, "main": 1.6, "body": 0.7}.get(tag, 1.0) * (1.3 if GOOD.search(named) else 1.0)
            node = Node(f"{above}/{generalised(tag, given)}", bonus)
            self.nodes.append(node)
            self.within = (*self.within, len(self.nodes) - 1)
        self.open.append((tag, noise, node))
        self.noisy += noise
        self.links += tag == "a"
        self.articles += tag == "article"

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open and self.open[-1][0] == tag:
            self.pop()

    def handle_endtag(self, tag):
        if tag in VOID:
            return
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                while len(self.open) > i:
                    self.pop()
                return
            if tag not in BLOCK and self.open[i][0] in BLOCK:
                return  # a stray end tag of inline text

    def handle_data(self, data):
        if not self.noisy:
            self.text.append(data)
            if self.links:
                self.linked += len(data)

    def read(self, html: str) -> Reader:
        self.feed(html)
        self.close()
        while self.open:
            self.pop()
        self.end_block()
        return self

    def best(self) -> int | None:
        """The container of highest score: its own text beyond links, by kind; deeper ones win ties."""
        top, found = 0.0, None
        for i, node in enumerate(self.nodes):
            score = (node.chars - node.linked) * node.bonus * (1 + min(node.paragraphs, 10) / 20)
            if node.chars and score >= top and score > 0:
                top, found = score, i
        return found

    def text_in(self, chosen: set[int] | None) -> str:
        """The blocks inside any of the chosen containers, or all blocks."""
        return "\n\n".join(t for t, within in self.blocks if chosen is None or chosen.intersection(within))

    def at_path(self, path: str | None) -> str:
        """The text under ``path``; else of the page's own best container; else of the whole page."""
        chosen = {i for i, n in enumerate(self.nodes) if n.path == path and n.chars}
        if not chosen:
            own = self.best()
            chosen = {own} if own is not None else None
        return self.text_in(chosen)


def vote_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (host, html) to votes (host, path, weight, chars), folded per batch."""
    for batch in batches:
        votes: dict[tuple[str, str], list[float]] = {}
        for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            page = Reader().read(html or "")
            i = page.best()
            if i is None:
                continue
            total = sum(len(t) for t, _ in page.blocks)
            kept = votes.setdefault((host, page.nodes[i].path), [0.0, 0])
            kept[0] += page.nodes[i].chars / total
            kept[1] += page.nodes[i].chars
        yield pa.RecordBatch.from_pydict(
            {
                "host": pa.array([k[0] for k in votes], pa.string()),
                "path": pa.array([k[1] for k in votes], pa.string()),
                "weight": pa.array([round(v[0] * 1_000_000) for v in votes.values()], pa.int64()),
                "chars": pa.array([int(v[1]) for v in votes.values()], pa.int64()),
            }
        )


def extract_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (page_id, url, html, path) to (page_id, url, path, text)."""
    for batch in batches:
        texts = [
            Reader().read(html or "").at_path(path)
            for html, path in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(3), pa.array(texts, pa.string())],
            names=["id", "url", "path", "text"],
        )


def host_of(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1))


def winning_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, path): the path most of a host's pages vote for."""
    votes = (
        pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
        .mapInArrow(vote_task, "host string, path string, weight long, chars long")
        .groupBy("host", "path")
        .agg(F.sum("weight").alias("weight"), F.sum("chars").alias("chars"))
    )
    ranked = Window.partitionBy("host").orderBy(F.desc("weight"), F.desc("chars"), "path")
    return votes.withColumn("rank", F.row_number().over(ranked)).where("rank = 1").select("host", "path")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: id, url, the path it was extracted by, and the main text."""
    paths = hinted(written(winning_paths(pages, url_col, html_col), "host-paths"), 200)
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host_of(F.col(url_col)).alias("host")
    )
    kind = rows.schema["id"].dataType.simpleString()
    return (
        rows.join(paths, "host", "left")
        .select("id", "url", "html", "path")
        .mapInArrow(extract_task, f"id {kind}, url string, path string, text string")
    )


def report(pages: DataFrame) -> DataFrame:
    return extract(pages).select(
        F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"), F.col("path").alias("host_path")
    )
