"""Main text of web pages by composite text density."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rapport.llm.common import small_batches, text_bytes

# Element names of HTML by what they mean for the main text.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe textarea title xmp noembed noframes svg math".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option optgroup p pre search section summary "
    "table tbody td tfoot th thead tr ul".split()
)
DROPPED = set("head button select input object embed applet canvas audio video map datalist".split()) | RAW
# Dropped unless they turn out to be a wrapper of the article.
DOUBTED = set("nav footer aside form menu dialog fieldset label".split())
# These two run to the end of the page if they are never closed, as in browsers.
ENDLESS = {"script", "style"}
# A start tag in this list ends an open paragraph.
ENDS_P = BLOCKS - set("body html option optgroup".split())
# A start tag ends an open element of these names, up to the nearest of the stops.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
}
# Words in a class, id or role that mark a part as not the article.
NOISE = set(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies disclaimer disqus footer gdpr header login masthead menu menubar modal nav navbar navigation "
    "newsletter notice notices notification overlay pagination pager popup promo promoted promotion related replies respond "
    "search share sharing sidebar signup skip social sponsor sponsored subscribe subscription teaser toolbar widget "
    "complementary contentinfo alert alertdialog".split()
)
ARTICLE = {"article", "main"}

TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S
)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NOTABLE = re.compile(r"class|id|role|hidden|style", re.I)
WORDS = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Node:
    """An element with its text and children in page order, and its counts."""

    __slots__ = ("name", "parent", "items", "drop", "chars", "tags", "link_chars", "link_tags", "density", "sum", "doubt", "text")

    def __init__(self, name: str, parent: Node | None, drop: bool = False, doubt: bool = False):
        self.name, self.parent, self.items, self.drop, self.doubt = name, parent, [], drop, doubt


def is_noise(name: str, attributes: str) -> tuple[bool, bool]:
    """Is the element no part of an article by its class, id or role, and is it hidden."""
    noise = False
    if not attributes or name in ("html", "body", "article", "main") or not NOTABLE.search(attributes):
        return False, False
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key in ("class", "id", "role") and NOISE & set(WORDS.findall(CAMEL.sub(" ", value).lower())):
            noise = True
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return noise, True
        if key == "style" and "display:none" in value.lower().replace(" ", ""):
            return noise, True
    return noise, False


def letters(text: str) -> int:
    return len("".join(text.split()))


def decide(nodes: list[Node]) -> None:
    """Drop the doubted elements of a page, all its elements given in page order, but not wrappers.

    A wrapper holds the article or main element with most text outside links, or more than
    half of such text of the page where no article outside doubted elements holds any. The
    density decides inside wrappers.
    """
    if not any(n.doubt for n in nodes):
        return
    # Of the whole subtree, and what is left of it in articles if all doubted elements go.
    for node in reversed(nodes):
        inner = [x for x in node.items if isinstance(x, Node)]
        node.text = 0
        if not node.drop and node.name != "a":
            node.text = sum(letters(x) for x in node.items if isinstance(x, str)) + sum(x.text for x in inner)
    total = nodes[0].text
    inside, kept = {nodes[0]: (False, False)}, 0
    for node in nodes:
        article, doubted = inside[node]
        article, doubted = article or node.name in ARTICLE, doubted or node.doubt
        for x in node.items:
            if isinstance(x, Node):
                inside[x] = article, doubted
            elif article and not doubted and not node.drop and node.name != "a":
                kept += letters(x)
    largest = max((n for n in nodes if n.name in ARTICLE), key=lambda n: n.text, default=None)
    wrappers = set()
    if largest and largest.text:
        up = largest
        while up:
            wrappers.add(up)
            up = up.parent
    for node in nodes:
        if node.doubt and node not in wrappers and not (2 * node.text > total and not kept):
            node.drop = True


def parse(html: str) -> Node:
    """Tree of a page, unclosed and misnested elements included; dropped parts are marked.

    How many elements of a name are open is counted, so that an end tag without a start, or a
    deeply nested page, costs no search.
    """
    root = Node("html", None)
    stack, is_open, nodes = [root], Counter(), [root]
    at, low, endless = 0, None, set()

    def close(keep: int) -> None:
        """Leave the first ``keep`` open elements open."""
        while len(stack) > keep:
            is_open[stack.pop().name] -= 1

    for m in TOKEN.finditer(html):
        if m.start() < at:
            continue
        if m.start() > at and not stack[-1].drop:
            stack[-1].items.append(html[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if m[1]:
            if is_open[name]:
                up = len(stack) - 1
                # A block's end closes what is open in it; an inline end does not leave its block.
                while stack[up].name != name and (name in BLOCKS or stack[up].name not in BLOCKS):
                    up -= 1
                if stack[up].name == name:
                    close(up)
            continue
        if name in ("html", "body") and len(stack) == 1:
            continue
        if name in ENDS_P and is_open["p"]:
            up = len(stack) - 1
            while up and stack[up].name != "p" and stack[up].name not in BLOCKS:
                up -= 1
            if stack[up].name == "p":
                close(up)
        if name in SIBLINGS:
            closed, stops = SIBLINGS[name]
            if any(is_open[c] for c in closed):
                up, keep = len(stack) - 1, len(stack)
                while up and stack[up].name not in stops:
                    if stack[up].name in closed:
                        keep = up
                    up -= 1
                close(keep)
        node = stack[-1]
        noise, unseen = is_noise(name, m[3])
        noise = noise or name in DOUBTED or name == "header" and not any(is_open[x] for x in ARTICLE)
        child = Node(name, node, node.drop or unseen or name in DROPPED, noise)
        node.items.append(child)
        nodes.append(child)
        if name in RAW:
            if name in ("svg", "math") and m[3].endswith("/"):
                continue
            low = low if low is not None else html.lower()
            end = -1 if name in endless else low.find("</" + name, at)
            if end >= 0:
                at = html.find(">", end) + 1 or len(html)
            elif name in ENDLESS:
                at = len(html)
            else:
                # Never closed: the start tag alone goes.
                endless.add(name)
        elif name not in VOID and not m[3].endswith("/") or name in BLOCKS - VOID:
            stack.append(child)
            is_open[name] += 1
    if at < len(html) and not stack[-1].drop:
        stack[-1].items.append(html[at:])
    decide(nodes)
    return root


def in_order(root: Node) -> list[Node]:
    """Kept elements, each before its descendants."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(x for x in reversed(node.items) if isinstance(x, Node) and not x.drop)
    return out


def measure(nodes: list[Node]) -> None:
    """Link-adjusted characters per tag of every element, and the sum over its children.

    density = C / T * log_b(C * T / (LC * LT)) with b = ln(C * LC / (C - LC) + LC_body / C_body * C + e),
    where C and T are characters and tags below the element, LC and LT those in links
    (counts that are zero enter as one).
    """
    for node in reversed(nodes):
        node.chars = sum(len(x.split()) and len("".join(x.split())) for x in node.items if isinstance(x, str))
        children = [x for x in node.items if isinstance(x, Node) and not x.drop]
        node.chars += sum(x.chars for x in children)
        node.tags = sum(x.tags + 1 for x in children)
        inside = node.name == "a"
        node.link_chars = node.chars if inside else sum(x.link_chars for x in children)
        node.link_tags = node.tags if inside else sum(x.link_tags + (x.name == "a") for x in children)
    body = nodes[0]
    linked = body.link_chars / max(body.chars, 1)
    for node in reversed(nodes):
        c, t = node.chars, max(node.tags, 1)
        if c == 0:
            node.density = 0.0
        else:
            lc, lt = max(node.link_chars, 1), max(node.link_tags, 1)
            base = log(c / max(c - node.link_chars, 1) * node.link_chars + linked * c + e)
            ratio = c / lc * t / lt
            node.density = c / t * (log(ratio) / log(base) if base > 1 and ratio > 1 else 1.0 if ratio >= 1 else 0.0)
        node.sum = sum(x.density for x in node.items if isinstance(x, Node) and not x.drop)


def content(nodes: list[Node]) -> list[Node]:
    """Elements that make up the article, in page order, none inside another.

    The element with the largest sum of its children's densities is the article's core, and
    an article or main element around it is the whole. Without one, the least density on the
    core's way up to the body is the threshold: in every part at or above it, the element
    with the largest sum is content too.
    """
    best = max(nodes, key=lambda n: (n.sum, n.chars))
    up = best
    path = [best]
    whole = best if best.name in ARTICLE else None
    while up.parent:
        up = up.parent
        path.append(up)
        whole = up if up.name in ARTICLE else whole
    if whole:
        return [whole]
    least = min(n.density for n in path)
    top: dict[Node, Node] = {}
    for node in reversed(nodes):
        inner = [top[x] for x in node.items if isinstance(x, Node) and not x.drop]
        top[node] = max([node, *inner], key=lambda n: (n.sum, n.chars))
    marked = {top[n] for n in nodes if n.chars and n.density >= least}
    chosen, inside = [], set()
    for node in nodes:
        if node.parent in inside:
            inside.add(node)
        elif node in marked:
            inside.add(node)
            chosen.append(node)
    return chosen


def blocks(node: Node) -> list[str]:
    """Text of an element by block, white space as one blank, references decoded."""
    out, held, stack = [], [], [node]

    def flush():
        line = " ".join(unescape("".join(held)).split())
        held.clear()
        if line:
            out.append(line)

    while stack:
        x = stack.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            held.append(x)
        elif x.name == "br":
            held.append(" ")
        elif not x.drop:
            if x.name in BLOCKS:
                flush()
                stack.append(None)
            stack.extend(reversed(x.items))
    flush()
    return out


def extract(html: str | None) -> str:
    """Main text of a page: its blocks in page order, a blank line between two."""
    nodes = in_order(parse(html or ""))
    measure(nodes)
    return "\n\n".join(line for node in content(nodes) for line in blocks(node))


def main_text(pages: DataFrame) -> DataFrame:
    """Main text of every page: (page_id, url, text, n_chars).

    Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, hidden parts
    and comments go by element name or by words in class, id and role, unless they wrap the
    article or most of the text (``decide``); composite text density then picks the article
    from the rest of the tree. A script or style that is never closed takes the rest of the page. A null or empty page, or one without
    text outside those parts, gives an empty text and 0. Text without any markup is one
    block. Cut-off tags, references and elements are taken as far as they go. Every row
    gives one row; null ids and urls stay null. Other columns are not read.
    """

    def run(batches):
        for batch in batches:
            texts = [extract((html or b"").decode("utf-8", "replace")) for html in text_bytes(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    small_batches(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url"), F.col("html").cast("binary"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
