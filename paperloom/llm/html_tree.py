"""Main text of HTML pages by tree scoring.

A page becomes a tree of elements. Paragraphs pass points for length and commas to their ancestors, less to farther
ones; an element's points are discounted by its link density. The best container is kept with all beside it that isn't
mostly links, and so upwards as long as what is kept is most of the text; parts that are never content (menus, forms, comments, ...) are left out by tag, role or
class. Text is emitted block by block in page order. Reading takes time in proportion to the page's length, however it is nested.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import defaultdict, deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table

# An attribute value in quotes may hold ">"; possessive, so that no input makes it go back.
_TAG = re.compile(r"<(?:!--(?P<comment>.*?)(?:-->|\Z)|(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)>|[!?/][^>]*+>)", re.S)
_ATTR = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
#: Elements that a start tag of these ends when they are open, up to a boundary.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
NEVER = frozenset("head script style noscript template nav footer aside button select input textarea iframe object embed canvas svg math audio video map dialog menu title fieldset label".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
BAD = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs byline comment comments commentlist disqus consent cookie cookies dialog footer foot footnav gdpr header masthead "
    "login logo menu menus meta modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo promotion related recommended recommendations replies reply respond "
    "search share sharing shoutbox sidebar sidebars signup skip social sponsor sponsored subscribe subscription tags toolbar widget widgets".split()
)
GOOD = frozenset("article articlebody body content main post entry story text page hentry".split())
#: Of those, these leave an element out whatever else its class says.
WORST = frozenset("adsense advert advertisement advertising adverts commentlist comments disqus".split())
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
#: A sibling of the best container is kept if less than SIBLING_LINKS of its text is in links; beside an article element only
#: from a share of its points on, or as a paragraph of text.
SIBLING_SHARE, SIBLING_CHARS, SIBLING_LINKS = 0.2, 80, 0.25
FORM_SHARE = 0.5


class Node:
    __slots__ = ("tag", "attrs", "parent", "items", "skip", "points")

    def __init__(self, tag: str, attrs: str, parent: Node | None):
        self.tag, self.attrs, self.parent, self.items, self.skip, self.points = tag, attrs, parent, [], False, 0.0


class Open:
    """The open elements, innermost last. For each tag it is known at which depths it is open, so no start or end tag looks through them."""

    def __init__(self, root: Node):
        self.path, self.at, self.blocks = [root], defaultdict(list), [0]

    @property
    def here(self) -> Node:
        return self.path[-1]

    def push(self, node: Node) -> None:
        self.at[node.tag].append(len(self.path))
        if node.tag in BLOCK:
            self.blocks.append(len(self.path))
        self.path.append(node)

    def cut(self, depth: int) -> None:
        """Closes what is open from this depth on."""
        while len(self.path) > depth:
            node = self.path.pop()
            self.at[node.tag].pop()
            if node.tag in BLOCK:
                self.blocks.pop()

    def last(self, tags) -> int:
        """The depth of the innermost open element with one of these tags; 0 if none is open."""
        return max((self.at[t][-1] for t in tags if self.at[t]), default=0)

    def imply(self, name: str) -> None:
        """A start tag ends an open paragraph, list item, row or cell."""
        if name in BLOCK and self.at["p"] and self.at["p"][-1] > self.last(P_BOUNDS):
            self.cut(self.at["p"][-1])
        if name in ENDS:
            ended, bounds = ENDS[name]
            bound = self.last(bounds)
            # a row ends all of an open one, others the innermost only
            depths = [d for t in ended for d in (self.at[t] if name == "tr" else self.at[t][-1:]) if d > bound]
            if depths:
                self.cut(min(depths) if name == "tr" else max(depths))

    def close(self, name: str) -> None:
        """An end tag ends its innermost open element; an inline one does not end a block."""
        depth = self.at[name][-1] if self.at[name] else 0
        if depth and (name in BLOCK or self.blocks[-1] < depth):
            self.cut(depth)


#: Beyond these an open paragraph isn't ended by a block's start tag.
P_BOUNDS = ("td", "th", "caption", "button", "object", "li", "div", "section", "article", "blockquote")


def parse(page: str) -> Node:
    """The page's tree; texts are strings with character references decoded. Unclosed and stray tags are allowed."""
    root = Node("html", "", None)
    opened, at, end, last = Open(root), 0, len(page), page.rfind(">")
    raw_ends: dict[str, re.Pattern] = {}
    while at < end:
        start = page.find("<", at)
        if start < 0 or (start > last and not page.startswith("<!--", start)):
            opened.here.items.append(html_lib.unescape(page[at:]))  # no tag ends any more
            break
        m = _TAG.match(page, start)
        if m is None:
            # a "<" that starts no tag is text
            stop = page.find("<", start + 1)
            stop = end if stop < 0 else stop
            opened.here.items.append(html_lib.unescape(page[at:stop]))
            at = stop
            continue
        if start > at:
            opened.here.items.append(html_lib.unescape(page[at:start]))
        at = m.end()
        name = m["name"] or m["name2"]
        if not name:
            continue
        name = name.lower()
        if m["close"] or m["close2"]:
            opened.close(name)
            continue
        attrs = m["attrs"] if m["name"] else m["attrs2"]
        if name in ("html", "body"):
            root.attrs += attrs
            continue
        opened.imply(name)
        node = Node(name, attrs, opened.here)
        opened.here.items.append(node)
        if name in RAW:
            if name not in raw_ends:
                raw_ends[name] = re.compile(rf"</{name}(?=[\s/>])", re.I)
            stop = raw_ends[name].search(page, at)
            gt = -1 if stop is None else page.find(">", stop.start())
            at = end if gt < 0 else gt + 1
        elif name not in VOID:
            opened.push(node)
    return root


def boilerplate(node: Node, inside: bool = False) -> bool:
    """Whether an element is left out by its tag, role, class or id. `inside` says that it is part of an article or main element."""
    if node.tag in NEVER:
        return True
    if node.tag == "header" and not inside:
        return True
    if not node.attrs or node.attrs.isspace():
        return False
    found = {k.lower(): html_lib.unescape(a or b or c or "") for k, a, b, c in _ATTR.findall(node.attrs)}
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or found.get("role", "").lower() in ROLES or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I):
        return True
    if node.tag in ("article", "main"):
        return bool({"comment", "comments", "ad", "ads", "advert", "promo", "related"} & {p.lower() for p in _PART.findall(found.get("class", "") + " " + found.get("id", ""))})
    bad = good = False
    for name in [*found.get("class", "").split(), *found.get("id", "").split()]:
        parts = [p.lower() for p in _PART.findall(name)]
        if parts and parts[0] in ("has", "with", "no", "is", "without"):
            continue
        if WORST.intersection(parts):
            return True
        if BAD.intersection(parts):
            bad = True
        elif GOOD.intersection(parts):
            good = True
    return bad and not good


def _mark(root: Node) -> list[Node]:
    """The elements that are not left out, parents first. A form is left out if it holds less than FORM_SHARE of the text beside it:
    one around the whole page is none."""
    nodes, forms = [], []
    todo = [(root, False)]
    while todo:
        x, inside = todo.pop()
        x.skip = x is not root and x.tag != "form" and boilerplate(x, inside)
        if not x.skip:
            nodes.append(x)
            if x.tag == "form":
                forms.append(x)
            within = inside or x.tag in ("article", "main")
            todo += [(y, within) for y in x.items if y.__class__ is Node]
    if not forms:
        return nodes
    size: dict[int, int] = {}
    for x in reversed(nodes):
        size[id(x)] = sum(len(y.strip()) if y.__class__ is str else size.get(id(y), 0) for y in x.items)
    gone: set[int] = set()
    for x in nodes:
        if (x.tag == "form" and size[id(x)] < FORM_SHARE * size[id(root)]) or (x.parent is not None and id(x.parent) in gone):
            x.skip = True
            gone.add(id(x))
    return [x for x in nodes if not x.skip]


def main_nodes(root: Node) -> list[Node | str | None]:
    """The best container with what is kept beside it and above, in page order; None ends a block. Inside an article or main element
    the whole of it is the container, for those say where an article ends; of several main elements all are."""
    nodes, size, links, inline = _mark(root), {}, {}, {}
    for x in reversed(nodes):  # children before parents
        own = sum(len(y.split()) and len(" ".join(y.split())) for y in x.items if y.__class__ is str)
        commas = sum(y.count(",") for y in x.items if y.__class__ is str)
        total, linked, flat_size, flat_commas, nested = own, 0, own, commas, False
        for y in x.items:
            if y.__class__ is Node and not y.skip:
                total += size[id(y)]
                linked += links[id(y)]
                if y.tag in BLOCK or inline[id(y)][2]:
                    nested = True
                if y.tag not in BLOCK:
                    flat_size += inline[id(y)][0]
                    flat_commas += inline[id(y)][1]
        size[id(x)], links[id(x)] = total, total if x.tag == "a" else linked
        inline[id(x)] = (flat_size, flat_commas, nested)
        # a paragraph is a block's own run of text, inline elements included
        if flat_size and x.tag in BLOCK and x.tag not in ("li", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol"):
            points = (0.2 if flat_size < 25 else 1.0) + flat_commas + min(flat_size / 100, 3.0)
            up, distance = (x.parent if x.tag in ("p", "pre", "td", "blockquote") and x.parent is not None else x), 1
            while up is not None and distance <= 5:
                up.points += points / (1 if distance == 1 else 2 if distance == 2 else distance * 3)
                up, distance = up.parent, distance + 1
    density = lambda x: links[id(x)] / max(1, size[id(x)])
    score = {id(x): x.points * (1 - density(x)) for x in nodes}
    holders = [x for x in nodes if x.tag not in ("p", "b", "i", "em", "strong", "span", "a")]
    best = max(holders, key=lambda x: score[id(x)], default=root)
    up = best
    while up is not None:  # an article or main element that holds it is the whole of it
        if up.tag in ("article", "main"):
            best = up
        up = up.parent
    if best.parent is None:
        return [best]
    if best.tag == "main":
        mains, todo = [], [root]
        while todo:
            x = todo.pop()
            if x.tag == "main":
                mains += [x, None]
            else:
                todo += [y for y in reversed(x.items) if y.__class__ is Node and not y.skip]
        return mains
    if best.tag != "article":
        return _beside(best, size, links)
    kept = []
    for y in best.parent.items:
        if y.__class__ is not Node or y.skip:
            continue
        text_like = y.tag in ("p", "pre", "blockquote") and (size[id(y)] > SIBLING_CHARS and density(y) < SIBLING_LINKS)
        if y is best or text_like or (score[id(y)] >= SIBLING_SHARE * score[id(best)] > 0 and y.tag == best.tag and density(y) < SIBLING_LINKS):
            kept.append(y)
    return kept


def _beside(best: Node, size: dict[int, int], links: dict[int, int]) -> list[Node | str | None]:
    """What is kept of the best container's parent, and of each ancestor of which that is at least half the text. Texts and inline
    elements that stand together are judged as one, so that a link inside a sentence stays."""
    here, kept, length = best, deque([best, None]), size[id(best)]
    while here.parent is not None and (here is best or 2 * length >= size[id(here.parent)]):
        before: list[Node | str | None] = []
        after: list[Node | str | None] = []
        out = before
        runs: list[list[Node | str]] = [[]]
        for y in here.parent.items:
            if y.__class__ is Node and (y is here or y.tag in BLOCK):
                runs += [[y], []]
            elif y.__class__ is str or not y.skip:
                runs[-1].append(y)
        for run in runs:
            if run == [here]:
                out = after
                continue
            total = sum(len(" ".join(y.split())) if y.__class__ is str else size.get(id(y), 0) for y in run)
            linked = sum(links.get(id(y), 0) for y in run if y.__class__ is Node)
            heading = len(run) == 1 and run[0].__class__ is Node and not run[0].skip and run[0].tag in ("h1", "h2")
            if total and (heading or linked < SIBLING_LINKS * total):
                out += [*run, None]
                length += total
        kept.extendleft(reversed(before))
        kept.extend(after)
        here = here.parent
    return list(kept)


def blocks(nodes: list[Node | str | None]) -> list[str]:
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        text = " ".join("".join(run).split())
        if text:
            out.append(text)
        run.clear()

    todo: list = list(reversed(nodes))
    while todo:
        x = todo.pop()
        if x is None:
            flush()
        elif x.__class__ is str:
            run.append(x)
        elif not x.skip:
            if x.tag == "br":
                run.append(" ")
            elif x.tag in BLOCK:
                flush()
                todo.append(None)
            todo += reversed(x.items)
    flush()
    return out


def main_text(page: str | None) -> str:
    """The main text of a page, one block a line; empty for null and for pages without text."""
    return "\n".join(blocks(main_nodes(parse(page)))) if page else ""


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of pages(page_id, url, html): page_id, url, text, n_chars (code points).

    A null or empty page has an empty text; the whole page is read, however long or deep. Null ids and urls are kept, repeated rows
    are extracted each, an empty table gives none; other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [main_text(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op2_html_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
