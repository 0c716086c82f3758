"""Main text of web pages by site style trees.

A page is laid out into segments, the texts of its blocks in order, and into the block
elements that cover them.  If it marks an article, that is all that is laid out; else
it is the body.  Elements whose tag or name says what they are (menus, footers, adverts,
notices, comments, forms, scripts) are left out.

The block elements of all pages of a host are merged by style path: the tags, classes
and ids from the root down, also with the place among siblings of one style, counted
from the first and from the last.  For each style node two entropies are taken over the
pages: of its presentation (the styles of its children) and of its content (its text);
each is divided by its largest possible value.  Their maximum is the importance: what a
site repeats is unimportant, what differs from page to page is its content.  An element
goes from a page if it lies at a node under ``threshold`` and its own text is one of
those that ``min_pages`` pages repeat there.

Repetition tells a site's parts only where the rest of the page differs.  So a page is
evidence only if enough of its text is its own, that is in segments that no other text
of the host has: of pages that are copies of each other but for a line, none is.  Equal
texts count as one page.  Inside a marked article only whole blocks may go; never its
first heading or what holds it, other headings, list items, tables or what is in them,
nor inline elements; and a text that would lose four fifths stays whole.

Scale: a page sends a row for each segment and each block element, of a few numbers;
entropies come from sums that combine on the way, so a host with a third of all pages
is spread over tasks.  Only the unimportant nodes and repeated texts of a host, as
64-bit hashes, go back to its pages, by a join on the host that broadcasts only if the
written table is small, and can split a hot host if not.

Defined results: null and empty html have empty text; a null or broken url belongs to
host ""; broken markup never fails: unknown ends are ignored, open elements end with
the page, elements deeper than 400 levels are read beside each other; repeated rows are
extracted each but count once in the style tree; a page that would be left empty keeps
its segments; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from basketlab.storage import materialize

THRESHOLD = 0.35
MIN_PAGES = 8
OWN_IN_ARTICLE = 0.2  # share of a text that must be its own for a page to be evidence
OWN_IN_BODY = 0.05
LEFT_IN_ARTICLE = 0.2  # share of a marked article that must be left
DEEPEST = 400

# fixed values: names of HTML elements and of usual page parts
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes svg math".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody "
    "tfoot thead tr caption ul".split()
)
# blocks that never go by themselves, and those that stay in an article with all they hold
KEPT = HEADINGS | frozenset("html body li dt dd tr tbody thead tfoot caption legend summary figcaption hr option optgroup".split())
KEPT_IN_ARTICLE = frozenset("table pre figure".split())
SPACED = frozenset("br td th wbr".split())
NOT_TEXT = frozenset(
    "head script style noscript template title iframe object embed applet canvas audio video svg math map nav footer aside "
    "form button input select textarea label fieldset dialog menu".split()
)
PART_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion menu nav navbar "
    "navigation breadcrumb breadcrumbs sidebar aside widget footer masthead toolbar cookie cookies consent gdpr notice "
    "notices alert popup modal overlay newsletter subscribe subscription signup login comment comments disqus respond reply "
    "replies social share sharing related recommended recommendations pagination pager skip search".split()
)
PART_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog menu menubar form".split())
HEADER_WORDS = frozenset("header topbar".split())
# elements that end when one of the second kind begins
ENDED_BY = {
    "p": BLOCK,
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot", "thead"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot", "thead"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot", "thead"]),
    "option": frozenset(["option", "optgroup"]),
}
STOPS = frozenset("html body article main section div table td th ul ol dl nav aside footer header form blockquote".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']+|\"[^\"]*\"|'[^']*')*+|[^>]*)(?:>|\Z)", re.S
)
ATTRIBUTE = re.compile(r"([^\s\"'=/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
READ = frozenset("class id role hidden aria-hidden".split())
NAME_WORD = re.compile(r"[a-z]+")
HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"


class Node:
    __slots__ = ("tag", "style", "path", "names", "role", "hidden", "children", "keys")

    def __init__(self, tag: str, attributes: str, above: int):
        found = {}
        if attributes.strip(" /"):
            for name, value in ATTRIBUTE.findall(attributes):
                if (name := name.lower()) in READ:
                    found.setdefault(name, value.strip("\"'").lower())
        self.tag, self.children, self.keys = tag, [], ()
        self.names = f"{found.get('class', '')} {found.get('id', '')}" if found else ""
        self.role = found.get("role", "")
        self.hidden = "hidden" in found or found.get("aria-hidden") == "true"
        self.style = f"{tag} {re.sub(r'[0-9]+', '', self.names)} {self.role}"
        self.path = xxhash.xxh3_64_intdigest(self.style.encode(), above) - (1 << 63)


def parse(page: str | None) -> Node:
    """The element tree; attributes other than class, id, role and hidden are dropped."""
    root = Node("#page", "", 0)
    if not page:
        return root
    stack, at = [root], 0
    while (token := TOKEN.search(page, at)) is not None:
        if token.start() > at:
            stack[-1].children.append(page[at : token.start()])
        at, tag = token.end(), token[2]
        if tag is None:
            continue
        tag = tag.lower()
        if token[1]:
            if any(n.tag == tag for n in stack[1:]):
                while stack.pop().tag != tag:
                    pass
            continue
        while len(stack) > 1:
            # the innermost element of a kind that the new one ends, if nothing stronger lies between
            inner = next((i for i in range(len(stack) - 1, 0, -1) if tag in ENDED_BY.get(stack[i].tag, ()) or stack[i].tag in STOPS), 0)
            if not inner or tag not in ENDED_BY.get(stack[inner].tag, ()):
                break
            del stack[inner:]
        node = Node(tag, token[3], stack[-1].path & ((1 << 64) - 1))
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif tag not in VOID and not token[3].endswith("/") and len(stack) < DEEPEST:
            stack.append(node)
    if at < len(page):
        stack[-1].children.append(page[at:])
    _place(root)
    return root


def _place(node: Node) -> None:
    """Gives the blocks below their keys in the style tree: path, path and place from the first, and from the last."""
    below = [c for c in node.children if isinstance(c, Node)]
    total, seen = Counter(c.path for c in below), Counter()
    for child in below:
        path, first = child.path, seen[child.path]
        seen[path] += 1
        if child.tag in BLOCK:
            above = path & ((1 << 64) - 1)
            places = (b"%d" % first, b"%d" % (first - total[path]))
            child.keys = (path, *[xxhash.xxh3_64_intdigest(n, above) - (1 << 63) for n in places])
        _place(child)


def _named(node: Node, words: frozenset[str]) -> bool:
    """Whether a class or id consists of such words only; a looser likeness is left to the style tree."""
    return any((runs := NAME_WORD.findall(name)) and words.issuperset(runs) for name in node.names.split())


def _is_part(node: Node, in_article: bool, by_name: bool = True) -> bool:
    """Whether tag, role or name says that an element is not part of a main text; names say nothing of a whole page."""
    if node.tag in NOT_TEXT or node.hidden or node.role in PART_ROLES:
        return True
    if by_name and node.names.strip() and node.tag not in ("html", "body"):
        if _named(node, PART_WORDS) or not in_article and _named(node, HEADER_WORDS):
            return True
    return not in_article and node.tag == "header"


def _is_article(node: Node) -> bool:
    return node.tag in ("article", "main") or node.role in ("main", "article")


class Layout:
    """Segments of a page and the block elements over them.

    ``segments`` are the texts of the blocks, ``elements`` (node, begin, end) the blocks
    that may go with the segments they cover.
    """

    def __init__(self, root: Node):
        self.segments: list[str] = []
        self.elements: list[tuple[Node, int, int]] = []
        self._parts: list[str] = []
        self._title: int | None = None  # segment of the first heading of a marked article
        found: list[Node] = []
        self._look(root, True, found)
        if not found:  # then the names of what lies around the only articles are wrong
            self._look(root, False, found)
        self.marked = bool(found)
        for top in found or [root]:
            self._walk(top, False)
            self._flush()
        if self.marked:
            self.elements = [e for e in self.elements if self._title is None or not e[1] <= self._title < e[2]]

    def _look(self, node: Node, by_name: bool, found: list[Node]) -> None:
        """The outermost articles."""
        for child in node.children:
            if isinstance(child, Node) and not _is_part(child, False, by_name):
                if _is_article(child):
                    found.append(child)
                else:
                    self._look(child, by_name, found)

    def _flush(self) -> None:
        text = " ".join(html.unescape("".join(self._parts)).split())
        if text:
            self.segments.append(text)
        self._parts.clear()

    def _walk(self, node: Node, fixed: bool) -> None:
        """``fixed`` blocks stay with the table they are in."""
        for child in node.children:
            if isinstance(child, str):
                self._parts.append(child)
            elif _is_part(child, self.marked):
                self._parts.append(" ")
            elif child.tag in BLOCK:
                self._flush()
                begin = len(self.segments)
                stays = fixed or self.marked and child.tag in KEPT_IN_ARTICLE
                self._walk(child, stays)
                self._flush()
                end = len(self.segments)
                if self._title is None and child.tag in HEADINGS and end > begin:
                    self._title = begin
                if end > begin and not stays and child.tag not in KEPT and not _is_article(child):
                    self.elements.append((child, begin, end))
            else:
                space = " " if child.tag in SPACED else ""
                self._parts.append(space)
                self._walk(child, fixed)
                self._parts.append(space)

    def said(self, begin: int, end: int) -> int:
        return _hash("\n".join(self.segments[begin:end]))


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode()) - (1 << 63)


def blocks(root: Node, low: frozenset[int], repeated: frozenset[int]) -> list[str]:
    """Texts of the blocks in page order, without elements at ``low`` nodes that say what is ``repeated`` there."""
    page = Layout(root)
    gone: set[int] = set()
    for node, begin, end in page.elements if low else ():
        if not low.isdisjoint(node.keys) and page.said(begin, end) in repeated:
            gone.update(range(begin, end))
    out = [text for i, text in enumerate(page.segments) if i not in gone]
    left, total = sum(map(len, out)), sum(map(len, page.segments))
    return page.segments if left < (LEFT_IN_ARTICLE * total if page.marked else 1) else out


_ROWS = pa.schema(
    [("host", pa.string()), ("page", pa.int64()), ("marked", pa.bool_()), ("total", pa.int64()), ("said", pa.int64()),
     ("chars", pa.int64()), ("shown", pa.int64()), ("keys", pa.list_(pa.int64()))]
)
_ROWS_TYPE = "host string, page long, marked boolean, total long, said long, chars long, shown long, keys array<long>"


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages (host, html) -> a row for each segment, without keys, and for each block element; equal texts are one page."""
    for batch in batches:
        rows = []
        for host, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            page = Layout(parse(text.as_py()))
            total = sum(map(len, page.segments))
            own = (host, page.said(0, len(page.segments)), page.marked, total)
            for segment in set(page.segments):
                rows.append((*own, _hash(segment), len(segment), None, None))
            for node, begin, end in page.elements:
                styles = "\n".join(c.style for c in node.children if isinstance(c, Node))
                rows.append((*own, page.said(begin, end), None, _hash(styles), node.keys))
        columns = list(zip(*rows)) if rows else [()] * len(_ROWS)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ROWS)], schema=_ROWS)


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, HOST, 1)), F.lit(""))


def evidence(rows: DataFrame) -> DataFrame:
    """(host, page) of the pages of which enough text is their own.

    A segment is a page's own if all rows of the host that have it are of that page,
    which the least and the largest page tell without listing the pages.
    """
    segments = rows.where("keys IS NULL")
    alone = segments.groupBy("host", "said").agg(
        F.min("page").alias("page"), F.max("page").alias("last"), F.min("chars").alias("chars"),
        F.min("total").alias("total"), F.min("marked").alias("marked"),
    )
    own = alone.where("page = last").groupBy("host", "page").agg(
        F.sum("chars").alias("own"), F.min("total").alias("total"), F.min("marked").alias("marked")
    )
    share = F.when(F.col("marked"), F.lit(OWN_IN_ARTICLE)).otherwise(F.lit(OWN_IN_BODY))
    return own.where(F.col("own") >= share * F.col("total")).select("host", "page")


def _spread(counts: DataFrame, name: str) -> DataFrame:
    """(host, key, all, ``name``): entropy of counts (host, key, n) over its largest value; 1 for a single page."""
    entropy = F.log(F.col("all")) - F.col("weighted") / F.col("all")
    summed = counts.groupBy("host", "key").agg(F.sum("n").alias("all"), F.sum(F.col("n") * F.log("n")).alias("weighted"))
    return summed.select("host", "key", "all", F.when(F.col("all") > 1, entropy / F.log("all")).otherwise(1.0).alias(name))


def style_tree(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (host, key, pages, importance) and their texts (host, key, said, n) over the pages that are evidence."""
    nodes = rows.where("keys IS NOT NULL").join(evidence(rows), ["host", "page"], "left_semi")
    nodes = nodes.select("host", "page", "said", "shown", F.explode("keys").alias("key")).distinct()
    said = materialize(nodes.groupBy("host", "key", "said").agg(F.count(F.lit(1)).alias("n")), "style-texts")
    shown = nodes.groupBy("host", "key", "shown").agg(F.count(F.lit(1)).alias("n"))
    content = _spread(said, "content").withColumnRenamed("all", "pages")
    presentation = _spread(shown, "presentation").drop("all")
    tree = content.join(presentation, ["host", "key"])
    return tree.select("host", "key", "pages", F.greatest("content", "presentation").alias("importance")), said


def extract(
    pages: DataFrame,
    threshold: float = THRESHOLD,
    min_pages: int = MIN_PAGES,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """(page_id, url, text, n_chars) of every row."""
    read = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host_of(F.col(url_col)).alias("host")
    )
    rows = materialize(read.select("host", "html").mapInArrow(_merge, _ROWS_TYPE), "style-rows")
    tree, said = style_tree(rows)
    low = tree.where((F.col("pages") >= min_pages) & (F.col("importance") < threshold)).select("host", "key")
    found = said.where(F.col("n") >= min_pages).join(low, ["host", "key"])
    found = found.groupBy("host").agg(F.collect_set("key").alias("low"), F.collect_set("said").alias("repeated"))
    found = materialize(found.withColumnRenamed("host", "_host"), "style-low")

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, frozenset] = {}

        def one(numbers: list[int] | None) -> frozenset[int]:
            return known.setdefault(key := tuple(numbers or ()), frozenset(key))

        for batch in batches:
            texts = []
            for page, low, repeated in zip(batch.column(2), batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                texts.append("\n".join(blocks(parse(page.as_py()), one(low), one(repeated))))
            lengths = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(texts, pa.string()), lengths], ["page_id", "url", "text", "n_chars"]
            )

    kinds = dict(read.dtypes)
    return (
        read.join(found, F.col("host") == F.col("_host"), "left")
        .select("page_id", "url", "html", "low", "repeated")
        .mapInArrow(take, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
    )
