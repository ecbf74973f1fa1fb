"""Main text of web pages by minimum-cut labelling of their blocks.

A page is cut into blocks at block-level tags. A small linear classifier turns
the marks of a block (the elements around it and words in their class and id,
its length, its links) into two costs: to call it content, and to call it
boilerplate. These are the capacities of its terminal arcs. Blocks next to each
other, and blocks of one parent element, are tied by smoothness arcs. The
minimum cut, found as a maximum flow, labels all blocks of a page at once.
Blocks whose own costs outweigh all their ties keep their label in any minimum
cut and are settled before the flow.

Character references are decoded; white space inside a block becomes one space
(a line break element is white space); blocks are trimmed and joined by line
feeds in page order. Scripts, styles, comments and the head never give blocks.
A null or empty page gives an empty text. Rows are taken as they are.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import chunks

# Elements of HTML by what they do to text.
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav noscript ol optgroup option p "
    "pre section select summary table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SILENT = frozenset(
    "script style head template noscript iframe svg math canvas object textarea select button video audio datalist".split()
)
_RAW = frozenset("script style textarea title iframe noscript xmp noembed noframes".split())
_CLOSES_P = _BLOCK - {"body", "html", "noscript", "option", "optgroup", "legend", "caption", "tbody", "td", "tfoot", "th", "thead", "tr"}
# An element that a sibling ends without a tag of its own, and where the search for it stops.
_SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Words in class, id and role of an element, with what they say about its text: above 0 for content.
_WORDS = {
    **dict.fromkeys(
        "ad ads advert advertisement advertising adsense sponsor sponsored promo promoted banner nav navbar navigation menu "
        "breadcrumb breadcrumbs footer header masthead sidebar side aside widget related recommended share sharing social "
        "comment comments reply replies respond disqus notice cookie cookies consent gdpr popup modal overlay newsletter "
        "subscribe signup login form search pagination pager toolbar copyright legal disclaimer tags hidden "
        "complementary contentinfo alert dialog".split(), -1.0),
    **dict.fromkeys("article main content post entry story body text".split(), 0.6),
}
# Cost per element around a block, for content if above 0.
_AROUND = {
    "nav": -4.0, "footer": -4.0, "aside": -4.0, "form": -4.0, "menu": -3.0, "header": -3.0, "dialog": -3.0,
    "address": -0.8, "article": 2.0, "main": 1.2, "p": 0.5, "blockquote": 0.3, "pre": 0.5, "h1": 0.4, "h2": 0.2, "h3": 0.2,
}
_WORD_COST = 3.5
# In one name with these, a word tells of the layout and not of the text in it: "with-sidebar", "nav-open".
_LAYOUT = frozenset("with without no has have layout open closed collapsed enabled disabled".split())
_WRAPPER = frozenset("wrap wrapper container".split())
# Elements that say for sure that nothing inside is content.
_SURE = frozenset("nav footer aside menu header dialog address".split())
_NEXT, _SAME_PARENT = 0.6, 0.4

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|hidden|aria-hidden|style|itemprop)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_FORM = re.compile(r"<(/?)form\b[^>]*>", re.I)
_UNREAD = re.compile(r"<(script|style|select|textarea)\b.*?(?:</\1\s*>|\Z)", re.I | re.S)
_MARKUP = re.compile(r"\s*<[^>]*>\s*")
# Words of a line of prose in a form; a form with twice as many in such lines holds text to read.
_PROSE = 20
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")


@dataclass
class Block:
    text: str
    balance: float  # content minus boilerplate, from all elements around it
    parent: int  # number of its parent element
    linked: int  # characters inside links


def _telling(name: str) -> list[str]:
    """Words of a class or id that tell of the text inside: none in the name of a layout."""
    words = [w.lower() for w in _NAME_PART.findall(name)]
    around = any(w in _WRAPPER for w in words) and any(_WORDS.get(w, 0.0) > 0 for w in words)
    return [] if around or any(w in _LAYOUT for w in words) else words


def _own(tag: str, attributes: str) -> tuple[float, bool]:
    """What an element says about the text in it, and whether it hides it."""
    balance, hidden = _AROUND.get(tag, 0.0), False
    if attributes and tag not in ("html", "body"):
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'")
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                hidden = True
            elif name == "style":
                hidden |= re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I) is not None
            else:
                words = [w for one in value.split() for w in _telling(one)]
                said = {_WORDS.get(w, 0.0) for w in words}
                low, high = min(said, default=0.0), max(said, default=0.0)
                if high > 0 and not any(_WORDS.get(w, 0.0) < 0 for w in words if w != "header"):
                    low = 0.0  # the header of an article holds its title
                balance += _WORD_COST * (low if low < 0 else high)
    return balance, hidden


def _layout_forms(page: str) -> set[int]:
    """Starts of forms that hold prose: those are the layout of a page, not something to fill in."""
    out, start = set(), None
    for m in _FORM.finditer(page):
        if not m.group(1):
            start = m.start() if start is None else start
        elif start is not None:
            inside = _UNREAD.sub(" ", page[start : m.start()])
            if sum(len(p.split()) for p in _MARKUP.sub("\n", inside).split("\n") if len(p.split()) >= _PROSE) >= 2 * _PROSE:
                out.add(start)
            start = None
    return out


def blocks(page: str) -> list[Block]:
    """Text blocks in page order. Unclosed and stray tags are handled as browsers do, in the main."""
    out: list[Block] = []
    # tag, balance of it and all around it, silent, number, what evidence for content counts inside
    stack: list[tuple[str, float, bool, int, str]] = [("", 0.0, False, 0, "all")]
    pieces: list[str] = []
    linked, number = 0, 0
    opened: Counter[str] = Counter()  # open elements by tag
    forms = _layout_forms(page) if "<form" in page.lower() else set()

    def depth_of(tag: str) -> int:
        return next(i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag) if opened[tag] else 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = _SPACE.sub(" ", "".join(pieces)).strip()
            if text:
                place = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in _BLOCK or not i)
                out.append(Block(text, stack[-1][1], stack[max(0, place - 1)][3], min(linked, len(text))))
            pieces.clear()
        linked = 0

    def say(raw: str) -> None:
        nonlocal linked
        if raw and not stack[-1][2]:
            text = references.unescape(raw) if "&" in raw else raw
            pieces.append(text)
            if opened["a"]:
                linked += len(text.strip())

    def pop_to(depth: int) -> None:
        while len(stack) > depth:
            opened[stack.pop()[0]] -= 1

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at : m.start()])
        at = m.end()
        closing, opening = m.group(1), m.group(2)
        if closing:
            tag = closing.lower()
            depth = depth_of(tag)
            if tag in _BLOCK:
                flush()
                if depth:
                    pop_to(depth)
            elif tag == "br":
                say(" ")
            elif depth and not any(stack[i][0] in _BLOCK for i in range(len(stack) - 1, depth, -1)):
                pop_to(depth)
        elif opening:
            tag, attributes = opening.lower(), m.group(3)
            if tag == "br":
                say(" ")
                continue
            if tag in _BLOCK:
                flush()
                if tag in _CLOSES_P:
                    depth = depth_of("p")
                    if depth:
                        pop_to(depth)
                ends, stops = _SIBLINGS.get(tag, (set(), set()))
                for i in range(len(stack) - 1 if any(opened[t] for t in ends) else 0, 0, -1):
                    if stack[i][0] in stops:
                        break
                    if stack[i][0] in ends:
                        pop_to(i)
                        break
                if tag == "body":
                    pop_to(1 + (len(stack) > 1 and stack[1][0] == "html"))
            if tag in _VOID:
                continue
            balance, hidden = _own(tag, attributes)
            if m.start() in forms:
                balance -= _AROUND["form"]
            if tag == "header" and opened["article"]:
                balance = max(balance, 0.0)
            number += 1
            outer = stack[-1][1]
            counts = stack[-1][4]
            if balance < 0:
                # Boilerplate inside content is boilerplate.
                inner = min(outer, 0.0) + balance
                counts = "none" if tag in _SURE or counts == "none" else "article"
            elif outer >= 0 or counts == "all":
                inner = outer + balance
            elif tag in ("main", "article") and counts == "article":
                # Names and forms around may be the layout of the page: a page has one main part; an article weighs against one of them.
                inner = balance + (0.0 if tag == "main" else max(outer, -_WORD_COST))
                counts = "all"
            else:
                inner = outer
            stack.append((tag, inner, stack[-1][2] or hidden or (tag in _SILENT and not (tag == "button" and opened["p"])), number, counts))
            opened[tag] += 1
            if tag in _RAW:
                close = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                if tag not in _SILENT and tag != "title":
                    say(page[at : close.start() if close else end])
                at = close.end() if close else end
                pop_to(len(stack) - 1)
    flush()
    return out


def costs(block: Block) -> tuple[float, float]:
    """Cost of calling a block content, and of calling it boilerplate."""
    words = block.text.count(" ") + 1
    balance = max(-8.0, min(8.0, block.balance))
    balance += min(words, 60) / 30.0 - 0.4
    balance -= 4.0 * block.linked / len(block.text)
    if block.text[-1] in ".!?…。":
        balance += 0.3
    if words <= 25 and re.match(r"(?:©|\(c\)|copyright|all rights reserved)", block.text, re.I):
        balance -= 1.2
    return (0.0, balance) if balance >= 0 else (-balance, 0.0)


def cut(terminal: list[tuple[float, float]], ties: list[tuple[int, int, float]]) -> list[bool]:
    """Minimum cut: true for nodes on the side of the source, that is content.

    A node on the side of the source pays its first cost, on the other side its
    second; a tie is paid when its ends part. Ties inside what stays undecided
    go through a maximum flow (shortest augmenting paths).
    """
    n = len(terminal)
    gain = [b - c for c, b in terminal]
    around: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, w in ties:
        around[a][b] = around[a].get(b, 0.0) + w
        around[b][a] = around[b].get(a, 0.0) + w
    label: list[bool | None] = [None] * n
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if label[i] is None and abs(gain[i]) > sum(around[i].values()):
            label[i] = gain[i] > 0
            # The rest of the graph sees a settled neighbour as part of a terminal.
            for j, w in around[i].items():
                gain[j] += w if label[i] else -w
                del around[j][i]
                queue.append(j)
            around[i] = {}
    open_ = [i for i in range(n) if label[i] is None]
    if open_:
        s, t = n, n + 1
        room: dict[int, dict[int, float]] = {i: dict(around[i]) for i in open_}
        room[s], room[t] = {}, {}
        for i in open_:
            if gain[i] > 0:
                room[s][i], room[i][s] = gain[i], 0.0
            elif gain[i] < 0:
                room[i][t], room[t][i] = -gain[i], 0.0
        while True:
            via = {s: s}
            queue = deque([s])
            while queue and t not in via:
                a = queue.popleft()
                for b, r in room[a].items():
                    if r > 1e-12 and b not in via:
                        via[b] = a
                        queue.append(b)
            if t not in via:
                break
            path, b = [], t
            while b != s:
                path.append((via[b], b))
                b = via[b]
            push = min(room[a][b] for a, b in path)
            for a, b in path:
                room[a][b] -= push
                room[b][a] = room[b].get(a, 0.0) + push
        for i in open_:
            label[i] = i in via
    return [bool(x) for x in label]


def main_text(page: str | None) -> str:
    """Main text of a page. Source without any markup is text as a whole."""
    if page and "<" not in page:
        return _SPACE.sub(" ", references.unescape(page)).strip()
    found = blocks(page) if page else []
    ties = [(i, i + 1, _NEXT) for i in range(len(found) - 1)]
    last: dict[int, int] = {}
    for i, block in enumerate(found):
        if block.parent in last:
            ties.append((last[block.parent], i, _SAME_PARENT))
        last[block.parent] = i
    content = cut([costs(b) for b in found], ties)
    return "\n".join(b.text for b, keep in zip(found, content, strict=True) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""

    def run(batches) -> Iterator[pd.DataFrame]:
        for part in chunks(batches, "html"):
            texts = [main_text(page) for page in part["html"]]
            yield pd.DataFrame(
                {"page_id": part["page_id"].astype("Int64"), "url": part["url"], "text": texts, "n_chars": [len(t) for t in texts]}
            )

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInPandas(run, "page_id long, url string, text string, n_chars long")
