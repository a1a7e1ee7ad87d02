"""Main text of web pages by tag-path ratios.

Text nodes are grouped by their path of tags from the root. For every path the length of its text and
its punctuation are added up and set against its number of nodes and links; the ratios are
smoothed over the path's siblings, fused, and compared with a threshold; an article or main element
raises the ratio of its paths and the weight of its text. The sibling containers that hold most of the chosen text
are the content; all their blocks are kept, but for boilerplate inside.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import map_rows

#: A tag, comment, declaration, or a run of text. A last tag cut off by the end of the page is no text.
TOKEN = re.compile(
    r"<!--(?P<comment>.*?)(?:-->|\Z)|<(?P<close>/)?(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|(?P<text>[^<]+|<)",
    re.S,
)
ATTRIBUTE = re.compile(r"(?<![^\s\"'/])(class|id|role|hidden|aria-label)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I | re.S)
#: Fixed values of HTML: elements without content, and elements whose text is not markup.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template svg iframe object".split())
#: Elements within a line; all others begin and end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img".split()
)
#: Elements that are never main text; others that are not, and parts of class, id and role names that say so, unless they hold the article.
BOILERPLATE = frozenset("nav footer aside button select option menu dialog head script style title template noscript textarea iframe svg object".split())
SOFT_BOILERPLATE = frozenset(("form",))
NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|sponsor(?:ed)?|promo|banner|nav|navbar|navigation|menu|breadcrumbs?|"
    r"header|masthead|footer|sidebar|aside|widget|related|share|social|cookies?|consent|notice|popup|modal|subscribe|"
    r"newsletter|signup|login|search|comments?|comment-list|replies|disqus|respond|complementary|contentinfo|"
    r"pagination|pager|copyright|legal|toolbar|skip|hidden)(?:$|[\s_-])",
    re.I,
)
#: A name that speaks for content even if one of the above is part of it.
CONTENT_NAMES = re.compile(r"(?:^|[\s_-])(?:article|content|entry|post|story|main|body|text)(?:$|[\s_-])", re.I)
#: Elements that an opening tag of the same group closes.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BLOCKS_CLOSE_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
CONTAINERS = frozenset("body article main section div td blockquote center header".split())
#: Elements that speak for content, and how much more their paths and text count.
NAMED, NAMED_FACTOR = frozenset(("article", "main")), 2.0
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？]")


@dataclass(eq=False)
class Node:
    """An element. ``path`` numbers its tag path; ``soft`` marks one that only its name or kind speaks against."""

    tag: str
    path: int
    parent: Node | None
    number: int
    boilerplate: bool
    link: bool
    soft: bool = False
    container: Node | None = None
    length: int = 0


class Paths:
    """Tag paths as numbers, so that a deep page does not spell each of them out; ``named`` are those below an article or main."""

    def __init__(self) -> None:
        self.numbers: dict[tuple[int, str], int] = {}
        self.parents, self.named = [-1], [False]

    def below(self, parent: int, label: str, tag: str) -> int:
        found = self.numbers.setdefault((parent, label), len(self.parents))
        if found == len(self.parents):
            self.parents.append(parent)
            self.named.append(self.named[parent] or tag in NAMED)
        return found


@dataclass
class Block:
    """A run of text between two block limits."""

    node: Node
    parts: list[str] = field(default_factory=list)
    linked: int = 0

    @cached_property
    def text(self) -> str:
        joined = "".join(self.parts)
        return " ".join((html.unescape(joined) if "&" in joined else joined).split())


def _attributes(rest: str) -> tuple[str, bool]:
    names, hidden = [], False
    for name, a, b, c in ATTRIBUTE.findall(rest):
        if name.lower() == "hidden":
            hidden = True
        else:
            names.append(a or b or c)
    return " ".join(names), hidden


def _is_soft(tag: str, names: str) -> bool:
    if tag in SOFT_BOILERPLATE:
        return True
    if tag == "header":
        return False
    return bool(names and NAMES.search(names) and tag not in ("html", "body", "article", "main") and not CONTENT_NAMES.search(names))


def _last(stack: list[Node], wanted: frozenset[str] | set[str], through: frozenset[str] | None, stop: frozenset[str]) -> int | None:
    """The highest place in the stack of a wanted tag, if only tags of ``through`` (and none of ``stop``) lie above it."""
    for index in range(len(stack) - 1, 0, -1):
        tag = stack[index].tag
        if tag in wanted:
            return index
        if tag in stop or (through is not None and tag not in through):
            return None
    return None


#: Elements that end the search for an open element of the same group.
GROUPS = frozenset("ul ol dl table select".split())


def blocks_of(page: str) -> tuple[list[Block], list[Node], Paths]:
    """All blocks in page order, each with the element that holds it; all elements, parents first; their paths."""
    paths = Paths()
    root = Node("", 0, None, 0, False, False)
    root.container = root
    stack, nodes, blocks = [root], [root], []
    opened: Counter[str] = Counter()
    block: Block | None = None
    at, end, token = 0, len(page), TOKEN.match

    def cut(index: int) -> None:
        for node in stack[index:]:
            opened[node.tag] -= 1
        del stack[index:]

    while at < end:
        begin = at
        at = page.find("<", begin)
        if at != begin:
            at = end if at < 0 else at
            text, match = page[begin:at], None
        else:
            match = token(page, begin)
            at = match.end()
            text = match["text"]
        if text is not None:
            top = stack[-1]
            if block is None:
                holder = top
                while holder.tag in INLINE:
                    holder = holder.parent
                block = Block(holder)
                blocks.append(block)
            if not top.boilerplate:
                block.parts.append(text)
                block.linked += len(text.strip()) if top.link else 0
            elif top.tag not in RAW:
                block.parts.append(text)
            continue
        if match["tag"] is None:
            continue
        tag = match["tag"].lower()
        if tag not in INLINE:
            block = None
        if match["close"]:
            if opened[tag]:
                index = len(stack) - 1
                while stack[index].tag != tag:
                    index -= 1
                cut(index)
            continue
        if tag in VOID:
            continue
        if tag in BLOCKS_CLOSE_P:
            if opened["p"] and (index := _last(stack, {"p"}, INLINE, frozenset())) is not None:
                cut(index)
        elif tag in CLOSES and any(opened[t] for t in CLOSES[tag]) and (index := _last(stack, CLOSES[tag], None, GROUPS)) is not None:
            cut(index)
        parent = stack[-1]
        names, hidden = _attributes(match["rest"])
        first = names.split(" ", 1)[0].lower()
        outer = tag == "header" and not opened["article"] and not opened["main"]
        node = Node(
            tag,
            paths.below(parent.path, f"{tag}.{first}" if first else tag, tag),
            parent,
            len(nodes),
            parent.boilerplate or hidden or tag in BOILERPLATE or outer,
            parent.link or tag == "a",
            _is_soft(tag, names),
        )
        nodes.append(node)
        node.container = node if tag in CONTAINERS else parent.container
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\s*[>/\s]|</{re.escape(tag)}\Z", re.I).search(page, at)
            at = close.start() if close else end
            if close:
                at = page.find(">", at) + 1 or end
            continue
        if not match["rest"].endswith("/"):
            stack.append(node)
            opened[tag] += 1
    _judge_names(blocks, nodes)
    return blocks, nodes, paths


def _judge_names(blocks: list[Block], nodes: list[Node]) -> None:
    """Carry out what names speak for: their elements are no main text, unless they hold the principal element.

    That is the article or main element with most text; without any, an element that holds a first heading
    and half of the text of the page. Names inside the principal element count as ever.
    """
    for block in blocks:
        if not block.node.boilerplate:
            block.node.length += len(block.text)
    for node in reversed(nodes[1:]):
        node.parent.length += node.length
    articles = [n for n in nodes if n.tag in NAMED and not n.boilerplate]
    principal = max(articles, key=lambda n: (n.length, -n.number), default=None)
    holds: set[int] = set()
    chosen = principal or next((n for n in nodes if n.tag == "h1"), None)
    above = chosen.parent if chosen else None
    while above is not None:
        if principal or 2 * above.length >= nodes[0].length:
            holds.add(above.number)
        above = above.parent
    for node in nodes[1:]:
        node.boilerplate = node.boilerplate or node.parent.boilerplate or (node.soft and node.number not in holds)


def path_ratios(blocks: list[Block], paths: Paths) -> dict[int, float]:
    """The fused ratio of every path: text length and punctuation per node, less links, smoothed over siblings."""
    length: dict[int, float] = {}
    signs: dict[int, float] = {}
    nodes: dict[int, set[int]] = {}
    for block in blocks:
        if block.node.boilerplate or not (text := block.text):
            continue
        path = block.node.path
        length[path] = length.get(path, 0.0) + max(0, len(text) - 2 * block.linked)
        signs[path] = signs.get(path, 0.0) + len(PUNCTUATION.findall(text))
        nodes.setdefault(path, set()).add(block.node.number)
    raw = {p: (math.log1p(length[p]) * (1 + length[p] / len(nodes[p]) / 80)) * (1 + math.log1p(signs[p])) for p in length}
    raw = {p: v * NAMED_FACTOR if paths.named[p] else v for p, v in raw.items()}
    families: dict[int, list[float]] = {}
    for path, value in raw.items():
        family = families.setdefault(paths.parents[path], [0.0, 0.0])
        family[0] += value
        family[1] += 1
    return {p: 0.75 * v + 0.25 * families[paths.parents[p]][0] / families[paths.parents[p]][1] for p, v in raw.items()}


#: Containers further out than this get no weight from a text: their share is below 1e-9.
FARTHEST = 197


def main_text(page: str) -> str:
    """The blocks of the content containers joined by line ends; empty if there are none."""
    blocks, nodes, paths = blocks_of(page)
    ratios = path_ratios(blocks, paths)
    if not ratios:
        return ""
    values = list(ratios.values())
    mean = sum(values) / len(values)
    spread = math.sqrt(sum((v - mean) ** 2 for v in values) / len(values))
    threshold = min(max(values), mean + 0.25 * spread)
    # Containers are weighed together with their siblings: by the number of the container around them.
    weight: dict[int, float] = {}
    members: dict[int, set[int]] = {}
    for block in blocks:
        if block.node.boilerplate or ratios.get(block.node.path, -1.0) < threshold or not (text := block.text):
            continue
        node, share = block.node.container, 1.0
        for _ in range(FARTHEST):
            if node is None:
                break
            around = node.parent.container if node.parent else None
            group = around.number if around else -1
            factor = NAMED_FACTOR if node.tag in NAMED else 1.0
            weight[group] = weight.get(group, 0.0) + share * factor * len(text)
            members.setdefault(group, set()).add(node.number)
            node, share = around, share * 0.9
    inside = members[max(weight, key=lambda n: (weight[n], n))] if weight else {0}
    kept = [False] * len(nodes)
    for node in nodes:
        kept[node.number] = node.number in inside or (node.parent is not None and kept[node.parent.number])
    return "\n".join(text for b in blocks if not b.node.boilerplate and kept[b.node.number] and (text := b.text))


def extract(df: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row, from the whole page.

    Null and empty pages give an empty text. Broken markup is read as browsers do, roughly; a tag
    or character reference cut off at the end is no reason to stop. Every row is read by itself,
    so rows without a number and repeated rows stay as they are. Other columns are not looked at; an empty table gives no rows.
    """

    def each():
        def row(doc_id: int | None, url: str | None, page: bytes) -> Iterator[tuple]:
            text = main_text(page.decode("utf-8", "replace"))
            yield doc_id, url, text, len(text)

        return row

    pages = df.select(
        F.col(id_column).cast("long").alias("page_id"),
        F.col(url_column).cast("string").alias("url"),
        F.coalesce(F.col(html_column), F.lit("")).cast("binary").alias("html"),
    )
    return map_rows(pages, "page_id long, url string, text string, n_chars long", each)
