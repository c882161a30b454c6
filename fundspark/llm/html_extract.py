"""Main text of web pages by the container paths that a host's pages agree on.

Each page is cut into blocks of text, each with the path of its containers (tag and class, digits
left out). From the body down, the innermost container that leaves no text of the page's own outside is
the page's candidate, weighted by that text; menus, adverts and the like, and blocks or sibling
containers that are mostly links, are not its own. A ``main`` with half of the text is entered
whatever is beside it, an article is never cut into, and inside a main only an article, or a container of all
its text, is entered. The candidates vote per host; paths with a fifth of a host's votes win.
Then every page is cut again and the blocks under its host's best winning path are its text; a page
without a winning path, or whose own candidate holds more than the winning path, uses its own candidate.

The votes are summed before the shuffle; winners are a few short paths per host, written to the
shared folder and joined back by host (Spark sends them to all tasks while they are below its
threshold, else it splits the join).

What lies outside: elements that never hold an article (navigation, footers, buttons, hidden parts and
the like), and containers marked by a word of their class or id, or forms, unless such a container holds
most of the page and an article, a main part or a first heading (or, but for comments and forms, nearly
all of the page in three blocks or more): then the word names the layout, not the contents.

Defined results: null, empty or text-less html gives an empty text; a null url, or one without a
host, belongs to the host ''; repeated rows give equal results; an empty table gives an empty
table. Broken markup is read as far as it goes: an unclosed comment or script runs to the end, an
unclosed drawing or list of choices is ignored, as are stray end tags and quotes that do not close; an
unknown element is inline. The time grows in step with the page, however deep its elements are nested.
Only key, url and html are read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import materialise

SHARE = 0.2

# A quote opens a value only after "="; one that no quote in a likely place closes is a character like any other.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)"
    r"((?:=\s*(?:\"[^\"<]*\"|'[^'<]*'|\"[^\"]*\"(?=[\s/>])|'[^']*'(?=[\s/>]))|[^>])*+)>|<[!?][^>]*>",
    re.S,
)
ATTRIBUTE = re.compile(r"""([A-Za-z_:][-\w:.]*)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript textarea title template iframe".split())
SKIPPED = frozenset("svg math select object canvas audio video".split())  # up to their end tag, if they have one
CONTAINERS = frozenset("html body main article section div td center nav header footer aside form figure details dialog menu fieldset".split())
LEAVES = frozenset(
    "p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd pre blockquote table thead tbody tfoot tr th caption address figcaption summary hr option".split()
)
BLOCKS = CONTAINERS | LEAVES
# An opening tag closes open elements of these kinds, up to the nearest of the second set.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
OUTSIDE = frozenset("nav footer aside head button dialog menu option optgroup".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
BOILER = re.compile(
    r"(?:^|[\s_-])(?:(?P<head>masthead|site-?header|header|banner)|(?P<talk>comments?|comment-?list|disqus|respond|repl(?:y|ies))|"
    r"nav(?:bar|igation)?|menus?|breadcrumbs?|side-?bar|foot(?:er)?|ads?|adverts?|advertisement|"
    r"sponsor(?:ed)?|promo(?:tion)?s?|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|"
    r"share|sharing|social|related|recommend(?:ed|ations)?|newsletter|subscribe|signup|login|pagination|pager|widget|toolbar|skip)(?:$|[\s_-])",
    re.I,
)
DIGITS = re.compile(r"\d+")
MOST, NEARLY = 2, 10  # more than a half, less than a tenth


class Block:
    __slots__ = ("node", "text", "linked", "outside", "title", "mark")

    def __init__(self, node: int, outside: bool, title: bool, mark: int):
        self.node, self.text, self.linked, self.outside, self.title, self.mark = node, [], 0, outside, title, mark


class Mark:
    """A marked container: its kind, the marked container around it, and what it holds."""

    __slots__ = ("kind", "over", "size", "blocks", "holds")

    def __init__(self, kind: str, over: int):
        self.kind, self.over, self.size, self.blocks, self.holds = kind, over, 0, 0, set()


class Page:
    """Blocks of text in page order, and the tree of container paths: ``names[i]`` under ``parents[i]``."""

    def __init__(self):
        self.blocks: list[Block] = []
        self.marks: list[Mark] = []
        self.names, self.parents, self.index = [""], [-1], {}

    def node(self, parent: int, name: str) -> int:
        found = self.index.get((parent, name))
        if found is None:
            found = self.index[parent, name] = len(self.names)
            self.names.append(name)
            self.parents.append(parent)
        return found

    def judge_marks(self) -> None:
        """Blocks in marked containers are outside, but for containers that hold the page itself."""
        total = 0
        for b in self.blocks:
            if not b.outside:
                n = sum(map(len, b.text))
                total += n
                if b.mark >= 0:
                    self.marks[b.mark].size += n
                    self.marks[b.mark].blocks += 1
        for mark in reversed(self.marks):
            if mark.over >= 0:
                over = self.marks[mark.over]
                over.size += mark.size
                over.blocks += mark.blocks
                over.holds |= mark.holds
        outside = []
        for mark in self.marks:
            page = bool(mark.holds & ({"h1", "main"} if mark.kind == "talk" else {"h1", "main", "article"}))
            if mark.kind == "" and mark.blocks >= 3 and NEARLY * (total - mark.size) < total:
                page = True
            outside.append(not (page and MOST * mark.size > total) or (mark.over >= 0 and outside[mark.over]))
        for b in self.blocks:
            b.outside = b.outside or (b.mark >= 0 and outside[b.mark])


def is_outside(tag: str, attributes: dict[str, str], inside_article: bool) -> bool:
    if tag in OUTSIDE or (tag == "header" and not inside_article):
        return True
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or attributes.get("role", "").lower() in ROLES:
        return True
    return bool(re.search(r"display\s*:\s*none", attributes.get("style", "")))


def marked(tag: str, attributes: dict[str, str], inside_article: bool) -> str | None:
    """The kind of a marked container ('' for most), None if it is not marked."""
    if tag == "form":
        return "form"
    if tag in ("html", "body", "main", "article"):
        return None
    for a in ("class", "id"):
        for m in BOILER.finditer(attributes.get(a) or ""):
            if m.group("talk"):
                return "talk"
            if not (m.group("head") and inside_article):
                return ""
    return None


def read_page(html: str) -> Page:
    page = Page()
    # (tag, node, outside, inside an article, inside a first heading, innermost mark)
    stack: list[tuple[str, int, bool, bool, bool, int]] = []
    top = ("", 0, False, False, False, -1)
    is_open: dict[str, int] = defaultdict(int)
    endless: set[str] = set()  # tags that no end tag follows any more
    current: Block | None = None
    links = 0
    position = 0

    def add(raw: str) -> None:
        nonlocal current
        if not raw:
            return
        if current is None:
            if raw.isspace():
                return
            _, node, outside, _, title, mark = stack[-1] if stack else top
            current = Block(node, outside, title, mark)
            page.blocks.append(current)
        current.text.append(raw)
        if links:
            current.linked += len(raw)

    def pop_to(depth: int) -> None:
        nonlocal current
        while len(stack) > depth:
            tag, _, outside, *_ = stack.pop()
            is_open[tag] -= 1
            if tag in BLOCKS or outside:
                current = None

    def past(tag: str, start: int) -> int | None:
        """The place after the next end tag, None if there is none."""
        if tag in endless:
            return None
        end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, start)
        if end is None:
            endless.add(tag)
            return None
        return end.end()

    while m := TOKEN.search(html, position):
        add(html[position : m.start()])
        position = m.end()
        tag = (m.group(2) or "").lower()
        if not tag:
            continue
        if m.group(1):
            if tag == "a":
                links = 0
            if is_open[tag]:
                depth = len(stack) - 1
                while stack[depth][0] != tag:
                    depth -= 1
                pop_to(depth)
            elif tag in BLOCKS:
                current = None
            continue
        if tag in RAW:
            position = past(tag, position) or len(html)
            continue
        if tag in SKIPPED:
            if not m.group(3).rstrip().endswith("/"):
                position = past(tag, position) or position
            continue
        if tag == "br":
            add("\n")
            continue
        if tag in VOID:
            if tag == "hr":
                current = None
            continue
        if tag == "a":
            links = 1
        attributes = {}
        if m.group(3).strip(" /"):
            attributes = {k.lower(): (v or "").strip("\"'") for k, v in ATTRIBUTE.findall(m.group(3))}
        if tag in BLOCKS:
            links = 0
            if is_open["p"]:
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] == "p":
                        pop_to(depth)
                        break
                    if stack[depth][0] in CONTAINERS:
                        break
            while stack and stack[-1][0] in ("option", "optgroup"):  # they hold no blocks
                pop_to(len(stack) - 1)
            if tag in CLOSES:
                closed, stop = CLOSES[tag]
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] in closed:
                        pop_to(depth)
                        break
                    if stack[depth][0] in stop or stack[depth][0] in CONTAINERS:
                        break
            current = None
        _, node, around, article, title, mark = stack[-1] if stack else top
        outside = is_outside(tag, attributes, article)
        kind = None if outside else marked(tag, attributes, article)
        if tag in BLOCKS or outside or kind is not None:
            if tag in CONTAINERS:
                words = attributes.get("class", "").split()
                name = f"{tag}.{words[0]}" if words else f"{tag}#{attributes['id']}" if attributes.get("id") else tag
                node = page.node(node, DIGITS.sub("", name).replace(">", ""))
            if tag not in BLOCKS:
                current = None
            if kind is not None:
                page.marks.append(Mark(kind, mark))
                mark = len(page.marks) - 1
            if tag in ("article", "main", "h1") and mark >= 0:
                page.marks[mark].holds.add(tag)
            stack.append((tag, node, around or outside, article or tag == "article", title or tag == "h1", mark))
            is_open[tag] += 1
    add(html[position:])
    page.judge_marks()
    return page


def clean(block: Block) -> str:
    return " ".join(unescape("".join(block.text)).split())


def element(name: str) -> str:
    return name.split(".")[0].split("#")[0]


def candidate(page: Page) -> tuple[str, int]:
    """(path, characters) of the innermost container that leaves none of the page's own text outside."""
    count = len(page.names)
    sizes, whole, linked, direct = ([0] * count for _ in range(4))
    for b in page.blocks:
        if not b.outside:
            n = sum(map(len, b.text))
            own = b.title or 2 * b.linked <= n
            direct[b.node] += n if own else 0  # own blocks of no container below
            sizes[b.node] += n if own else 0  # characters of blocks that are not mostly links
            whole[b.node] += n
            linked[b.node] += b.linked
    below: list[list[int]] = [[] for _ in range(count)]
    for i in range(count - 1, 0, -1):
        up = page.parents[i]
        below[up].append(i)
        sizes[up] += sizes[i]
        whole[up] += whole[i]
        linked[up] += linked[i]
    at, names = 0, []
    inside = False  # a main
    while element(page.names[at]) != "article":
        best = max(below[at], key=lambda i: (sizes[i], page.names[i]), default=0)
        if not best or not sizes[best]:
            break
        left = direct[at] + sum(sizes[i] for i in below[at] if i != best and 2 * linked[i] <= whole[i])
        kind = element(page.names[best])
        if kind == "main" and 2 * sizes[best] >= sizes[at]:
            inside = True
        elif left or (inside and kind != "article" and whole[best] < whole[at]):
            break
        at = best
        names.append(page.names[at])
    return ">".join(names), sizes[at]


def text_under(page: Page, path: str) -> str | None:
    """Text of the blocks under a path; None if the page has no block there."""
    at = 0
    for name in path.split(">") if path else ():
        at = page.index.get((at, name), -1)
        if at < 0:
            return None
    under = [False] * len(page.names)
    for i in range(len(under)):
        under[i] = i == at or (i > 0 and under[page.parents[i]])
    mine = [b for b in page.blocks if under[b.node]]
    if not mine:
        return None
    return " ".join(t for b in mine if not b.outside and (t := clean(b)))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1))


def extract_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", share: float = SHARE) -> DataFrame:
    """Key, url, text, n_chars, and ``path`` (the path used) of every row."""
    types = dict(pages.dtypes)
    rows = pages.select(F.col(key).alias("_key"), F.col(url).alias("_url"), host_of(F.col(url)).alias("host"), F.col(html).alias("_html"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [candidate(read_page(v.as_py() or "")) for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([p for p, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())],
                ["host", "path", "weight"],
            )

    votes = rows.select("host", "_html").mapInArrow(vote, "host string, path string, weight long").where("weight > 0")
    sums = votes.groupBy("host", "path").agg(F.sum("weight").alias("votes"))
    totals = sums.groupBy("host").agg(F.sum("votes").alias("all"))
    winners = (
        sums.join(totals, "host").where(F.col("votes") >= share * F.col("all"))
        .groupBy("host").agg(F.sort_array(F.collect_list(F.struct("votes", "path")), asc=False).alias("w"))
        .select("host", F.transform("w", lambda x: x["path"]).alias("paths"))
    )
    winners = materialise(winners, "winners")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, used = [], []
            for value, paths in zip(batch.column(2), batch.column(3), strict=True):
                page = read_page(value.as_py() or "")
                own, weight = candidate(page)
                text = path = None
                for path in paths.as_py() or ():
                    text = text_under(page, path)
                    if text:
                        break
                if not text or (weight and (not own or path.startswith(own + ">"))):
                    path, text = own, text_under(page, own) or ""
                texts.append(text)
                used.append(path)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(used, pa.string())],
                [key, url, "text", "n_chars", "path"],
            )

    whole = rows.join(winners, "host", "left").select("_key", "_url", "_html", "paths")
    return whole.mapInArrow(extract, f"`{key}` {types[key]}, `{url}` string, text string, n_chars long, path string")
