"""Main text of web pages by wrapper induction: pages of one host are aligned by simple tree matching.

A page is parsed into a tree; siblings of one kind become one node that holds the texts of all of them.
Trees of a host are folded into a wrapper, a tree in which every node knows on how many pages it stood,
whether its text was always the same, and which texts of single siblings came again. What most pages of the host have in one
place is template, the rest are slots; pages that are the same to the byte count once. A page's main text is what its slots hold, without regions that are no
content by their kind (navigation, footers, forms, adverts, comments and the like). Articles, or else main
elements, narrow the slots where they hold at least half of that text.

Trees are at most ``MAX_DEPTH`` deep and wrappers have at most ``MOST_NODES`` nodes, so time is linear in a page
and what a host needs doesn't grow with its pages.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyrelith.runtime import Scratch, column, text_batches

TOKEN = re.compile(r"<!--.*?(?:-->|$)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.S)
#: Fixed values, from the HTML standard and common practice.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math".split())
BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - {"br", "html", "body", "head", "td", "th", "tr", "li", "option"}
SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table article section div body main aside nav header footer form".split())
NOISE_TAGS = frozenset("nav footer aside form script style noscript template button select textarea input iframe svg math dialog menu head title object".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar toolbar form".split())
#: Names of regions that are no content, and words that only say what form a region has.
NOISE_WORDS = frozenset("ad adbox ads adslot adunit adv advert adverts advertisement advertising advertorial banner banners sponsor sponsors sponsored promo promos promotion nav navbar navigation navlinks navlist sidenav subnav topnav menu menubar menus breadcrumb breadcrumbs sidebar sidebars side aside footer cookie cookiebar cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription share sharebar sharing social comment commentlist comments disqus reply replies respond related recommended recommendations widget widgets pagination pager login signup search searchbar searchbox toolbar skip legal copyright paywall".split())
HEADER_WORDS = frozenset("header masthead".split())
FORM_WORDS = frozenset("area article articles bar block body bottom box button buttons card cards col column container content field first form global group icon icons inner item items js label last left link links list main menu outer page pages panel post posts primary right row rows secondary section site slot sticky stories story text thread title toggle top unit wrap wrapper".split())
#: Elements that hold pages or texts; their names tell of layouts and subjects.
WHOLE = frozenset("html body main article".split())
#: Elements that are regions of a page; in an article only a whole one can be template, never a heading or a paragraph alone.
REGIONS = frozenset("div section aside ul ol dl table figure details center".split())
#: Inline styles of what a reader doesn't see.
UNSEEN = re.compile(r"(?:^|[;\s])(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
#: Elements nested deeper stand beside one another in the tree, in page order.
MAX_DEPTH = 150
#: A node's children of more kinds than this are told apart by their tags alone.
MOST_KINDS = 64
#: Bounds of a wrapper: nodes, children of a node, texts of single siblings of a node. The most frequent stay.
MOST_NODES, MOST_CHILDREN, MOST_TEXTS = 4000, 128, 16
#: Shorter texts of single siblings come again by chance.
LEAST_WORDS = 4


@lru_cache(50_000)
def is_named(names: str, words: frozenset[str]) -> bool:
    """Whether a class or id consists of such words and words of form only: ``cookie-bar`` is a notice, ``promo-code-guide`` isn't."""
    for name in names.split():
        parts = [p for p in re.split(r"[-_\d]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower()) if p]
        if any(p in words for p in parts) and all(p in words or p in FORM_WORDS for p in parts):
            return True
    return False


@lru_cache(50_000)
def kind_of(tag: str, names: str) -> str:
    """A tag and its names, without those that hold digits, as numbered ones differ from page to page."""
    return " ".join([tag, *(n for n in names.split() if not any(c.isdigit() for c in n))])


class Node:
    """An element: its kind (tag and names), its children, and its own pieces of text in page order."""

    __slots__ = ("children", "key", "named", "noise", "tag")

    def __init__(self, tag: str, key: str, noise: bool = False, named: bool = False):
        #: named: noise by nothing but its class or id
        self.tag, self.key, self.noise, self.children, self.named = tag, key, noise, [], named


class Builder:
    """The open elements of a page, and where those of each tag stand, so that no step walks through them."""

    def __init__(self):
        self.root = Node("", "")
        self.open, self.where, self.scopes = [self.root], {}, []

    def nearest(self, tags) -> int:
        return max((w[-1] for t in tags if (w := self.where.get(t))), default=0)

    def scope(self) -> int:
        return self.scopes[-1] if self.scopes else 0

    def close(self, to: int) -> None:
        """End the open elements from the place ``to`` on."""
        while len(self.open) > to:
            node = self.open.pop()
            self.where[node.tag].pop()
            if node.tag in SCOPES:
                self.scopes.pop()
            if len(self.open) > MAX_DEPTH and node.tag in BLOCK:
                self.border()

    def border(self) -> None:
        """Below the greatest depth: where a block begins or ends."""
        held = self.open[MAX_DEPTH].children
        if not held or isinstance(held[-1], str) or held[-1].tag != "br":
            held.append(Node("br", "br"))

    def text(self, piece: str) -> None:
        at = self.open[-1]
        if len(self.open) <= MAX_DEPTH + 1:
            at.children.append(piece)
        elif at.noise:
            held = Node("span", "span", True, at.named)
            held.children.append(piece)
            self.open[MAX_DEPTH].children.append(held)
        else:
            self.open[MAX_DEPTH].children.append(piece)

    def start(self, node: Node, stays: bool) -> None:
        if len(self.open) <= MAX_DEPTH:
            self.open[-1].children.append(node)
        else:
            if node.tag in BLOCK:
                self.border()
            up = self.open[-1]
            if len(self.open) > MAX_DEPTH + 1 and up.noise:
                node.named = up.named and (node.named or not node.noise)
                node.noise = True
        if stays:
            self.where.setdefault(node.tag, []).append(len(self.open))
            if node.tag in SCOPES:
                self.scopes.append(len(self.open))
            self.open.append(node)


def is_unseen(attributes: dict[str, str]) -> bool:
    return "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or bool(UNSEEN.search(attributes.get("style", "")))


def parse(page: str) -> Node:
    """A tolerant tree: end tags may be missing, wrong or crossed, and the page may stop anywhere."""
    tree = Builder()
    pos, n = 0, len(page)
    find = TOKEN.search
    while pos < n:
        m = find(page, pos)
        if not m:
            tree.text(page[pos:])
            break
        if m.start() > pos:
            tree.text(page[pos : m.start()])
        pos = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            at = tree.nearest((tag,))
            if at and (tag in BLOCK or at >= tree.scope()):
                tree.close(at)
            continue
        if tag in CLOSES_P or tag in SELF_CLOSING:
            at = tree.nearest(SELF_CLOSING.get(tag, ("p",)))
            if at > tree.scope():
                tree.close(at)
        names, noise, named = "", tag in NOISE_TAGS, False
        if m[3].strip("/ \n\t\r"):
            attributes = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(m[3])}
            names = " ".join(x for x in (attributes.get("class"), attributes.get("id")) if x)
            noise = noise or attributes.get("role", "").lower() in NOISE_ROLES or is_unseen(attributes)
            named = not noise and tag not in WHOLE and bool(names and is_named(names, NOISE_WORDS))
        if not noise and not named and tag not in WHOLE and (tag == "header" or (names and is_named(names, HEADER_WORDS))):
            found = not tree.nearest(("article", "main"))  # a page's header is noise, an article's isn't
            noise, named = found and tag == "header", found and tag != "header"
        raw = tag in RAW
        tree.start(Node(tag, kind_of(tag, names), noise or named, named), not raw and tag not in VOID and not m[3].rstrip().endswith("/"))
        if raw:
            end = re.compile(rf"</{tag}\s*(?:>|$)", re.I).search(page, pos)
            pos = end.end() if end else n
    return tree.root


def clean(text: str) -> str:
    return " ".join(entities.unescape(text).split())


def digest_of(pieces: list[str]) -> str:
    text = clean(" ".join(pieces))
    return xxhash.xxh3_64_hexdigest(text.encode("utf-8", "surrogatepass")) if text else ""


class Slot:
    """What siblings of one kind are in a page: their own texts, and slots for their inner elements."""

    __slots__ = ("children", "digest", "key", "nodes", "texts")

    def __init__(self, key: str, nodes: list[Node]):
        self.key, self.nodes, self.children = key, nodes, []
        own = [[c for c in n.children if isinstance(c, str) and not c.isspace()] for n in nodes]
        self.digest = digest_of([c for pieces in own for c in pieces])
        #: by place, the digests of the siblings' own texts, of the longer ones
        self.texts: dict[int, str] = {}
        if len(nodes) > 1:
            self.texts = {i: digest_of(p) for i, p in enumerate(own) if len(" ".join(p).split()) >= LEAST_WORDS}


def slots(nodes: list[Node], key: str) -> Slot:
    """Collapse siblings of one kind, and below them their children of one kind, in order of first appearance."""
    out = Slot(key, nodes)
    inner = [c for n in nodes for c in n.children if not isinstance(c, str) and c.tag not in RAW]
    for name in (lambda c: c.key, lambda c: c.tag + " *", lambda c: "*"):
        groups: dict[str, list[Node]] = {}
        for c in inner:
            groups.setdefault(name(c), []).append(c)
        if len(groups) <= MOST_KINDS:
            break
    out.children = [slots(v, k) for k, v in groups.items()]
    return out


# A wrapper node: [kind, pages it stood on, its text's digest or "" once two differ, children, {digest of a sibling's text: pages}].


def as_wrapper(s: Slot) -> list:
    return [s.key, 1, s.digest, [as_wrapper(c) for c in s.children], dict.fromkeys(s.texts.values(), 1)]


def match(a: list, b: list, seen: dict) -> int:
    """Simple tree matching: the most pairs of nodes of one kind that keep both order and parents."""
    if a[0] != b[0]:
        return 0
    got = seen.get((id(a), id(b)))
    if got is None:
        got = seen[id(a), id(b)] = 1 + table(a[3], b[3], seen)[len(a[3])][len(b[3])]
    return got


def table(x: list, y: list, seen: dict) -> list[list[int]]:
    m = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i, a in enumerate(x):
        for j, b in enumerate(y):
            m[i + 1][j + 1] = max(m[i][j + 1], m[i + 1][j], m[i][j] + match(a, b, seen))
    return m


def aligned(x: list, y: list, seen: dict) -> list[tuple[int | None, int | None]]:
    """Pairs of places in two lists of children, in order; None where one has no partner."""
    if len(x) == len(y) and all(a[0] == b[0] for a, b in zip(x, y, strict=True)):
        return [(i, i) for i in range(len(x))]
    m, out, i, j = table(x, y, seen), [], len(x), len(y)
    while i and j:
        w = match(x[i - 1], y[j - 1], seen)
        if w and m[i][j] == m[i - 1][j - 1] + w:
            i, j = i - 1, j - 1
            out.append((i, j))
        elif m[i][j] == m[i - 1][j]:
            i -= 1
            out.append((i, None))
        else:
            j -= 1
            out.append((None, j))
    out += [(k, None) for k in range(i - 1, -1, -1)] + [(None, k) for k in range(j - 1, -1, -1)]
    return out[::-1]


def merge(a: list, b: list, seen: dict | None = None) -> list:
    """The wrapper of the pages of both; folding in any order counts the same pages."""
    seen = {} if seen is None else seen
    children = []
    for i, j in aligned(a[3], b[3], seen):
        children.append(a[3][i] if j is None else b[3][j] if i is None else merge(a[3][i], b[3][j], seen))
    if len(children) > MOST_CHILDREN:
        stay = sorted(sorted(range(len(children)), key=lambda k: (-children[k][1], k))[:MOST_CHILDREN])
        children = [children[k] for k in stay]
    return [a[0], a[1] + b[1], a[2] if a[2] == b[2] else "", children, most_frequent({k: a[4].get(k, 0) + b[4].get(k, 0) for k in a[4] | b[4]})]


def most_frequent(texts: dict[str, int], most: int = MOST_TEXTS) -> dict[str, int]:
    return texts if len(texts) <= most else dict(sorted(texts.items(), key=lambda x: (-x[1], x[0]))[:most])


def bounded(w: list) -> list:
    """A wrapper cut to its most frequent nodes; no node stands on more pages than the one above it, so a tree stays."""
    nodes = [w]
    for node in nodes:
        node[4] = most_frequent(node[4], 4 * MOST_TEXTS)
        nodes.extend(node[3])
    if len(nodes) > MOST_NODES:
        stay = {id(nodes[k]) for k in sorted(range(len(nodes)), key=lambda k: (-nodes[k][1], k))[:MOST_NODES]}
        for node in nodes:
            node[3] = [c for c in node[3] if id(c) in stay]
    return w


#: Fewer pages of a host than this may well be copies of one another.
FEW = 5


def template_nodes(w: list, s: Slot, shape: list, found: dict[int, bool], pages: int, seen: dict) -> None:
    """The nodes of a page whose text is template, and whether most pages of the host have it.

    A slot is template if its text was the same on all of several pages; one of several siblings is if most pages have its text.
    """
    if pages > 1 and w[1] > 1 and w[2] == s.digest and w[2]:
        found.update(dict.fromkeys(map(id, s.nodes), 2 * w[1] > pages))
    elif pages >= FEW:
        found.update({id(s.nodes[i]): True for i, d in s.texts.items() if 2 * w[4].get(d, 0) > pages})
    for i, j in aligned(w[3], shape[3], seen):
        if i is not None and j is not None:
            template_nodes(w[3][i], s.children[j], shape[3][j], found, pages, seen)


def blocks(node: Node, template: set[int], regions: set[int], out: list[str], line: list[str]) -> None:
    """Text in page order; a block's pieces are joined as they stand and its white space is made one space.

    Left out are the own texts of ``template`` nodes and all that lies in ``regions``.
    """
    for child in node.children:
        if isinstance(child, str):
            if id(node) not in template:
                line.append(child)
        elif not child.noise and child.tag not in RAW and id(child) not in regions:
            if child.tag in BLOCK:
                flush(out, line)
                blocks(child, template, regions, out, line)
                flush(out, line)
            else:
                blocks(child, template, regions, out, line)


def flush(out: list[str], line: list[str]) -> None:
    if line:
        if text := clean("".join(line)):
            out.append(text)
        line.clear()


def outermost(at: Node, tag: str, found: list[Node]) -> list[Node]:
    """The elements of a kind that are no noise and in no other of that kind."""
    for c in at.children:
        if not isinstance(c, str) and not c.noise:
            if c.tag == tag:
                found.append(c)
            else:
                outermost(c, tag, found)
    return found


def bodies(node: Node) -> list[Node]:
    """The outermost articles that are no noise, or else the outermost main elements."""
    return outermost(node, "article", []) or outermost(node, "main", [])


def unname(node: Node, tags: frozenset[str]) -> bool:
    """Take noise names off what holds an element of ``tags``, or off everything if there are none; whether ``node`` holds one."""
    holds = not tags
    for c in node.children:
        if not isinstance(c, str) and (c.named or not c.noise) and (unname(c, tags) or c.tag in tags):
            c.noise = c.named = False
            holds = True
    return holds


def page_tree(page: str) -> Node:
    """The tree of a page. What holds a main element is no noise by name; nor is what holds an article if all articles stand in such noise."""
    root = parse(page)
    unname(root, frozenset({"main"}))
    if not bodies(root):
        unname(root, frozenset({"article", "main"}))
    return root


def text_of(tops: list[Node], template: set[int], regions: set[int] = frozenset()) -> str:
    out: list[str] = []
    line: list[str] = []
    for top in tops:
        blocks(top, template, regions, out, line)
        flush(out, line)
    return " ".join(out)


def constant_regions(node: Node, steady: set[int], found: set[int]) -> bool | None:
    """Whether all text below a node is template, None without text; the outermost regions that are go to ``found``."""
    own = [c for c in node.children if isinstance(c, str) and not c.isspace()]
    kinds = {id(node) in steady} if own else set()
    inner: set[int] = set()
    for c in node.children:
        if not isinstance(c, str) and not c.noise and c.tag not in RAW and (whole := constant_regions(c, steady, inner)) is not None:
            kinds.add(whole)
    if kinds == {True} and node.tag in REGIONS:
        found.add(id(node))
    else:
        found |= inner
    return None if not kinds else kinds == {True}


def slots_within(tops: list[Node], steady: set[int]) -> str:
    """The text of articles without the regions whose text is template on most pages of the host.

    Headings and paragraphs stay, though they come again: only whole regions go. Nothing goes where less than a third of
    the text is no template, as those pages look like copies of one another.
    """
    whole = text_of(tops, set())
    if not steady or 3 * len(text_of(tops, steady)) < len(whole):
        return whole
    regions: set[int] = set()
    for top in tops:
        constant_regions(top, steady, regions)
    return text_of(tops, set(), regions) or whole


def extract(page: str | None, wrapper: list | None) -> str:
    """The main text of a page, given its host's wrapper (None: nothing is known as template).

    Text that every page of the host has where it has that element is template; inside an article only whole
    regions that most pages of the host have are. The text is that of the articles, or else of the main
    elements, unless they hold less than half of the page's text outside template and noise regions; where
    the host has no other page, less than a quarter. Otherwise all that text of the page is taken. If there
    is none, the page is a copy of the host's others and all its text outside noise regions is taken. If
    that leaves nothing either, regions that are noise by nothing but their class or id are taken too.
    """
    if not page:
        return ""
    root = page_tree(page)
    template: dict[int, bool] = {}
    pages = wrapper[1] if wrapper else 1
    if pages > 1:
        s = slots([root], "")
        template_nodes(wrapper, s, as_wrapper(s), template, pages, {})
    steady = {k for k, most in template.items() if most}
    everything = text_of([root], set(template))
    for tag in ("article", "main"):
        inside = slots_within(outermost(root, tag, []), steady)
        if inside and (4 if pages == 1 else 2) * len(inside) >= len(everything):
            return inside
    if not everything and not (everything := text_of([root], set())):
        unname(root, frozenset())
        everything = text_of([root], set())
    return everything


def induce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A wrapper for each host of a partition, folded page by page."""
    part = TaskContext.get().partitionId() if TaskContext.get() else 0
    found: dict[str, list] = {}
    for b in batches:
        for host, page in zip(b["host"], b["html"], strict=True):
            w = as_wrapper(slots([parse(page)], ""))
            found[host] = bounded(merge(found[host], w) if host in found else w)
        if len(found) > 20_000:
            yield dump(found, part)
            found = {}
    yield dump(found, part)


def dump(found: dict[str, list], part: int) -> pd.DataFrame:
    return frame([(host, part, json.dumps(w, separators=(",", ":"))) for host, w in found.items()])


def frame(rows: list[tuple]) -> pd.DataFrame:
    """Text columns that stay text without rows."""
    return pd.DataFrame(rows, columns=["host", "part", "wrapper"]).astype({"host": object, "part": "int32", "wrapper": object})


def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Merge the wrappers of a host, which come one after another; only one is held."""
    host, held, part = None, None, 0
    for b in batches:
        out = []
        for h, p, w in zip(b["host"], b["part"], b["wrapper"], strict=True):
            w = json.loads(w)
            if h == host:
                held = bounded(merge(held, w))
            else:
                if host is not None:
                    out.append((host, part, json.dumps(held, separators=(",", ":"))))
                host, part, held = h, p, w
        yield frame(out)
    if host is not None:
        yield frame([(host, part, json.dumps(held, separators=(",", ":")))])


def host_of(url: str = "url"):
    """Scheme, user, port and path removed, lower case; pages without an URL are hosts of their own."""
    return F.lower(F.regexp_extract(F.col(url), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))


SCHEMA = "host string, part int, wrapper string"


def distinct_pages(rows: DataFrame) -> DataFrame:
    """Each host's pages once: copies say no more of what is template. Only pages that have copies move."""
    rows = rows.withColumn("digest", F.xxhash64("html"))
    several = Scratch(rows.sparkSession, "page-copies").table(rows.groupBy("host", "digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "several")
    if several.isEmpty():
        return rows.drop("digest")
    single = rows.join(several, ["host", "digest"], "left_anti")
    return single.unionByName(rows.join(several, ["host", "digest"], "left_semi").dropDuplicates(["host", "digest"])).select("host", "html")


def wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html", salt: int = 32) -> DataFrame:
    """``(host, wrapper)``: each partition folds its own distinct pages of a host, then those wrappers are folded in two steps.

    A host with a third of all pages sends one wrapper (a page's outline) from each partition, to up to
    ``salt`` tasks first, so no task gets its pages.
    """
    rows = distinct_pages(pages.select(host_of(url_col).alias("host"), F.col(html_col).alias("html")).where("html is not null and host <> ''"))
    first = rows.mapInPandas(induce, SCHEMA)
    step = first.withColumn("salt", F.pmod("part", F.lit(salt))).repartition("host", "salt").sortWithinPartitions("host", "salt", "part").select("host", "part", "wrapper").mapInPandas(fold, SCHEMA)
    return step.repartition("host").sortWithinPartitions("host", "part").mapInPandas(fold, SCHEMA).select("host", "wrapper")


def extractor(found: Callable[[str], str | None], names: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages, whose last columns are the host and the HTML, become texts; ``found`` has a host's wrapper as JSON. Other columns pass under ``names``."""
    known: dict[str, list | None] = {}
    for b in batches:
        texts = []
        for host, page in zip(b.column(b.num_columns - 2).to_pylist(), b.column(b.num_columns - 1).to_pylist(), strict=True):
            if host and host not in known:
                if len(known) > 1_000:
                    known.clear()
                known[host] = json.loads(w) if (w := found(host)) else None
            texts.append(extract(page, known.get(host) if host else None))
        new = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        yield pa.RecordBatch.from_arrays([*b.columns[:-2], *new], names=[*names, "text", "n_chars"])


def extract_main_text(pages: DataFrame, url_col: str = "url", html_col: str = "html", broadcast_bytes: int = 16 << 20, salt: int = 32) -> DataFrame:
    """``pages`` with the columns ``text`` and ``n_chars`` (code points) in place of the HTML, one row a row.

    Null and empty HTML give empty text; pages with a null or odd URL are extracted without a wrapper;
    rows that repeat are extracted each, and count once where a host's template is found; an empty table gives no rows;
    other columns are kept, whatever their names, but for any named text or n_chars. Wrappers are written once. If their JSON, measured as it is, has up to ``broadcast_bytes``
    it is sent to all workers; else pages are dealt by host and one of ``salt`` numbers, and each such
    group gets its host's wrapper once, ahead of its pages.
    """
    spark = pages.sparkSession
    text_batches(spark)
    found = Scratch(spark, "wrappers").table(wrappers(pages, url_col, html_col, salt), "wrappers")
    keep = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    out = T.StructType([pages.schema[c] for c in keep]).add("text", "string").add("n_chars", "long")
    # numbered while they pass through Python, where names with dots don't
    rows = pages.select(*[column(c).alias(f"c{i}") for i, c in enumerate(keep)], F.coalesce(host_of(url_col), F.lit("")).alias("host"), F.col(html_col).alias("html"))
    if (found.agg(F.sum(F.octet_length("wrapper"))).first()[0] or 0) <= broadcast_bytes:
        held = spark.sparkContext.broadcast({r.host: r.wrapper for r in found.collect()})
        return rows.mapInArrow(lambda batches: extractor(held.value.get, keep, batches), out)

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by host; the one with a wrapper comes ahead of the pages it is for."""
        now: dict[str, str] = {}

        def only_pages() -> Iterator[pa.RecordBatch]:
            for b in batches:
                ahead = b.column(0)
                cuts = [*np.flatnonzero(ahead.is_valid().to_numpy(zero_copy_only=False)).tolist(), b.num_rows]
                pages = b.select(range(2, b.num_columns))
                yield pages.slice(0, cuts[0])
                for lo, hi in zip(cuts, cuts[1:], strict=False):
                    now.clear()
                    now[pages.column(pages.num_columns - 2)[lo].as_py()] = ahead[lo].as_py()
                    yield pages.slice(lo + 1, hi - lo - 1)

        return extractor(now.get, keep, only_pages())

    dealt = rows.where("host <> ''").select(F.lit(None).cast("string").alias("wrapper"), F.floor(F.rand(1) * salt).cast("int").alias("salt"), "*")
    ahead = found.select("host", "wrapper", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))).alias("salt"))
    together = dealt.unionByName(ahead, allowMissingColumns=True).repartition("host", "salt").sortWithinPartitions("host", "salt", F.col("wrapper").isNull())
    alone = rows.where("host = ''").mapInArrow(lambda batches: extractor(lambda host: None, keep, batches), out)
    return together.mapInArrow(grouped, out).unionByName(alone)
