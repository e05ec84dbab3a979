"""HTML pages as trees of block elements, and simple tree matching between their shapes.

A tree keeps block elements only; inline markup adds text to the block around
it.  Labels are tag, first class name and marks: "!" for elements that their
tag, role, class or id name as boilerplate, "@" for the elements marked as the
article.  A shape is [label, [child shapes]] with neighbours of one label
merged, so a list counts as one repeated node.
"""

from __future__ import annotations

import re
from html import unescape

#: HTML's element classes.
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary
    table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
NOT_SHOWN = frozenset("button select label datalist svg canvas object audio video template applet progress meter".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
IN_HEAD = frozenset("meta link title style script base noscript template".split())
#: Boilerplate by tag, by role and by words of class or id.
TAGS = frozenset("nav footer aside form header menu dialog fieldset legend search head".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
WORDS = frozenset("""nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead topbar footer copyright sidebar
    aside rail widget notice notices alert banner cookie cookies consent gdpr popup modal overlay newsletter subscribe signup
    ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion promoted share sharing social
    comment comments disqus respond replies related recommended login search pagination pager toolbar""".split())
READERS = frozenset("comment comments disqus respond replies related recommended".split())
ARTICLE_WORDS = ("article", "post", "entry", "story", "content")

#: An element opened while one of these is open in its scope ends it.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
         "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
         "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
         "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"})}
_SCOPE = {"td", "th", "table", "caption", "button", "body", "html"}
_TAG = re.compile(r"<(?:(/?)([A-Za-z][^\s/>]*)|!--|[!?/])")
_REST = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
DEPTH, WIDTH = 40, 64
STACK = 512  # elements open at once; deeper ones only part blocks
BREAK = object()


class Node:
    """A block element: label and, in page order, pieces of text, child nodes and BREAK marks."""

    __slots__ = ("tag", "label", "bad", "rank", "readers", "items", "shape", "groups", "index")

    def __init__(self, tag: str, name: str = "", bad: bool = False, rank: int = 0, readers: bool = False):
        self.tag, self.bad, self.rank, self.readers = tag, bad, rank, readers
        self.label, self.items = f"{tag}.{name}" if name else tag, []


def _marks(tag: str, attrs: str) -> tuple[str, bool, int, bool]:
    """(name for the label, boilerplate?, article rank, of readers?) of an element."""
    bad, rank, name, readers = tag in TAGS, {"article": 1, "main": 2}.get(tag, 0), "", False
    if attrs.strip(" /\n\t\r\f"):
        a = {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(attrs)}
        text = f"{a.get('class', '')} {a.get('id', '')}"
        words = {w.lower() for w in _WORD.findall(text)}
        role = a.get("role", "").strip().lower()
        style = a.get("style", "").replace(" ", "").lower()
        readers = not words.isdisjoint(READERS)
        bad = (bad or role in ROLES or not words.isdisjoint(WORDS) or "hidden" in a or a.get("aria-hidden", "").lower() == "true"
               or "display:none" in style or "visibility:hidden" in style)
        if role in ("main", "article") or a.get("itemprop", "").lower() == "articlebody":
            rank = rank or 3
        elif not rank and tag in ("div", "section", "td"):
            rank = next((4 + i for i, w in enumerate(ARTICLE_WORDS) if w in words), 0)
        first = (a.get("class", "").split() or a.get("id", "").split() or [""])[0]
        name = re.sub(r"\d+", "#", first)[:40]
    return name, bad and tag not in ("html", "body"), 0 if bad else rank, readers


def parse(html: str | None) -> Node:
    """The tree below an outer node; unclosed, crossed and cut markup is accepted."""
    html = html or ""
    root = Node("html")
    stack: list[tuple[str, Node, bool]] = [("#", root, False)]  # (tag, block node, text shown?)
    hidden = 0
    at, n = 0, len(html)

    def add(text):
        if hidden:
            return
        tag, node, _ = stack[-1]
        if node.tag == "head" and text.strip():
            close("head")
            node = stack[-1][1]
        node.items.append(unescape(text))

    def pop():
        nonlocal hidden
        hidden -= stack.pop()[2]

    def close(tag):
        while stack[-1][0] != tag:
            pop()
        pop()

    def opened(tags, scope):
        """The innermost open element of ``tags`` that no element of ``scope`` shields."""
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in tags:
                return i
            if stack[i][0] in scope:
                return 0
        return 0

    while at < n:
        m = _TAG.search(html, at)
        if m is None:
            add(html[at:])
            break
        if m.start() > at:
            add(html[at:m.start()])
        tag = (m[2] or "").lower()
        if not tag:
            end = html.find("-->", m.end()) + 3 if m[0] == "<!--" else html.find(">", m.end()) + 1
            at = end if end >= 3 or (end and m[0] != "<!--") else n
            continue
        rest = _REST.match(html, m.end())
        end = rest.end() if rest else html.find(">", m.end()) + 1
        if not end:
            break  # a tag cut off at the end
        attrs, at = html[m.end():end - 1], end
        if m[1]:
            if tag in ("body", "html"):
                continue
            i = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
            if tag not in BLOCK and tag not in NOT_SHOWN and any(stack[j][0] in BLOCK for j in range(i + 1, len(stack))):
                i = 0  # inline ends do not close blocks
            if i:
                while len(stack) > i:
                    pop()
            elif tag == "p" and not hidden:
                stack[-1][1].items.append(BREAK)
            continue
        if tag in RAW:
            stop = re.compile(rf"</{tag}\b", re.I).search(html, at)
            if stop:
                at = html.find(">", stop.end()) + 1 or n
            elif tag in ("script", "style", "iframe", "xmp"):
                at = n
            continue
        if tag == "br" and not hidden:
            stack[-1][1].items.append(" ")
        if tag in VOID and tag != "hr":
            continue
        if stack[-1][1].tag == "head" and tag not in IN_HEAD:
            close("head")
        if tag in ("html", "body"):
            continue  # one outer node stands for both
        closed = attrs.endswith("/") and tag not in BLOCK
        if tag not in BLOCK:
            _, bad, _, _ = _marks(tag, attrs) if attrs else ("", False, 0, False)
            dropped = tag in NOT_SHOWN or bad
            if not closed and len(stack) < STACK:
                stack.append((tag, stack[-1][1], dropped))
                hidden += dropped
            continue
        i = opened({"p"}, _SCOPE)
        while i and len(stack) > i:
            pop()
        if tag in HEADINGS and stack[-1][0] in HEADINGS:
            pop()
        ends = _ENDS.get(tag)
        if ends:
            i = opened(*ends)
            if i and tag in ("tr", "tbody", "thead", "tfoot"):  # the outermost of the row's or group's parts
                while i > 1 and stack[i - 1][0] in ends[0]:
                    i -= 1
            while i and len(stack) > i:
                pop()
        parent = stack[-1][1]
        if hidden or len(stack) > DEPTH or tag == "hr":  # deeper elements only part blocks
            if not hidden:
                parent.items.append(BREAK)
            if tag != "hr" and len(stack) < STACK:
                stack.append((tag, parent, False))
            continue
        node = Node(tag, *_marks(tag, attrs))
        parent.items.append(node)
        stack.append((tag, node, False))
    return root


def blocks(root: Node):
    """(node, text) of each block in page order; white space is one space, trimmed, empty blocks left out."""
    out, text = [], []

    def flush(node):
        if text:
            t = " ".join("".join(text).split())
            text.clear()
            if t:
                out.append((node, t))

    stack = [(root, iter(root.items))]
    while stack:
        node, it = stack[-1]
        for x in it:
            if isinstance(x, str):
                text.append(x)
                continue
            flush(node)
            if x is not BREAK:
                stack.append((x, iter(x.items)))
                break
        else:
            flush(node)
            stack.pop()
    return out


def children(node: Node) -> list[Node]:
    return [x for x in node.items if isinstance(x, Node)]


def mark(root: Node, found) -> None:
    """Settle the marks: a boilerplate mark on an element that holds most of the page's text together with an article
    is a layout's and goes (not so readers' comments); of the article marks the strongest kind stays, outermost first."""
    chars: dict[int, int] = {}
    for node, t in found:
        chars[id(node)] = chars.get(id(node), 0) + len(t)
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += children(node)
    total, held, best = {}, {}, {}
    for node in reversed(order):
        kids = children(node)
        total[id(node)] = chars.get(id(node), 0) + sum(total[id(k)] for k in kids)
        held[id(node)] = bool(node.rank) or any(held[id(k)] for k in kids)
    whole = max(total[id(root)], 1)
    for node in order:
        if node.bad and not node.readers and node.tag not in ("nav", "footer", "aside", "head") and held[id(node)] \
                and total[id(node)] > 0.6 * whole:
            node.bad = False
    todo, seen = [(root, False)], []
    while todo:
        node, off = todo.pop()
        off = off or node.bad
        if node.rank and not off and total[id(node)]:
            seen.append((node.rank, node))
        todo += [(k, off) for k in children(node)]
    best = min((r for r, _ in seen), default=0)
    for node in order:
        if node.rank and node.rank != best:
            node.rank = 0
    for node in order:
        node.label = ("!" if node.bad else "@" if node.rank else "") + node.label


# ---- shapes --------------------------------------------------------------------

def _same(x, y) -> bool:
    return x is y or x == y


def match(a: list, b: list, memo: dict | None = None) -> int:
    """Simple tree matching: the most pairs of equal labels that keep order and ancestry (0 if the roots differ)."""
    if a[0] != b[0]:
        return 0
    if not a[1] or not b[1]:
        return 1
    memo = {} if memo is None else memo
    key = (id(a), id(b))
    if key not in memo:
        memo[key] = 1 + _table(a[1], b[1], memo)[len(a[1])][len(b[1])]
    return memo[key]


def _table(xs: list, ys: list, memo: dict) -> list[list[int]]:
    m = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
    for i, x in enumerate(xs):
        above, row = m[i], m[i + 1]
        for j, y in enumerate(ys):
            best = above[j + 1] if above[j + 1] >= row[j] else row[j]
            if x[0] == y[0]:
                best = max(best, above[j] + match(x, y, memo))
            row[j + 1] = best
    return m


def align(xs: list, ys: list) -> list[tuple[int | None, int | None]]:
    """The matching's pairs of children with the unmatched ones between them, in order."""
    if [x[0] for x in xs] == [y[0] for y in ys]:
        return [(i, i) for i in range(len(xs))]
    memo: dict = {}
    m = _table(xs, ys, memo)
    out, i, j = [], len(xs), len(ys)
    while i or j:
        if i and j and xs[i - 1][0] == ys[j - 1][0] and m[i][j] == m[i - 1][j - 1] + match(xs[i - 1], ys[j - 1], memo):
            i, j = i - 1, j - 1
            out.append((i, j))
        elif j and m[i][j] == m[i][j - 1]:
            j -= 1
            out.append((None, j))
        else:
            i -= 1
            out.append((i, None))
    return out[::-1]


def _narrow(shapes: list) -> tuple[list, list[int]]:
    """Neighbours of one label merged; beyond ``WIDTH`` nodes all of one label, then of one tag.  (shapes, group of each)"""
    out, groups = [], []
    for s in shapes:
        if out and out[-1][0] == s[0]:
            out[-1] = merge(out[-1], s)
        else:
            out.append(s)
        groups.append(len(out) - 1)
    for short in (lambda label: label, lambda label: label.split(".")[0]):
        if len(out) <= WIDTH:
            break
        at: dict[str, int] = {}
        wide, out, moved = out, [], []
        for s in wide:
            label = short(s[0])
            if label in at:
                out[at[label]] = merge(out[at[label]], [label, s[1]])
            else:
                at[label] = len(out)
                out.append([label, s[1]])
            moved.append(at[label])
        groups = [moved[g] for g in groups]
    return out, groups


def merge(a: list, b: list) -> list:
    """Union of two shapes of one label, aligned by simple tree matching."""
    if not b[1] or _same(a[1], b[1]):
        return a
    if not a[1]:
        return b
    kids = [merge(a[1][i], b[1][j]) if i is not None and j is not None else a[1][i] if j is None else b[1][j]
            for i, j in align(a[1], b[1])]
    return [a[0], _narrow(kids)[0]]


def shape(node: Node) -> list:
    """The node's shape; notes on each node which child group its children belong to."""
    stack = [(node, False)]
    while stack:
        x, ready = stack.pop()
        kids = children(x)
        if kids and not ready:
            stack.append((x, True))
            stack += [(k, False) for k in kids]
            continue
        if kids:
            shapes, x.groups = _narrow([k.shape for k in kids])
        else:
            shapes, x.groups = [], []
        x.shape = [x.label, shapes]
    return node.shape


def number(root: list) -> dict[int, int]:
    """Preorder numbers of a shape's nodes by identity; every node of ``root`` must be an object of its own."""
    out, todo = {}, [root]
    while todo:
        s = todo.pop()
        out[id(s)] = len(out)
        todo += reversed(s[1])
    return out


def _to(xs: list, ys: list) -> dict:
    """Index of each of ``xs`` -> its place among ``ys``: the aligned one, else the first of its label, else of its tag."""
    to = {i: ys[j] for i, j in align(xs, ys) if i is not None and j is not None}
    for i, x in enumerate(xs):
        if i not in to:  # grouped elsewhere in the wider shape
            near = next((y for y in ys if y[0] == x[0]), None) or next((y for y in ys if y[0] == x[0].split(".")[0]), None)
            if near is not None:
                to[i] = near
    return to


def onto(a: list, b: list) -> list[int]:
    """For each node of shape ``a`` in preorder the preorder number of its place in ``b``, or -1."""
    b_number = number(b)
    out, todo = [], [(a, b)]
    while todo:
        x, y = todo.pop()
        out.append(b_number[id(y)] if y is not None else -1)
        to = _to(x[1], y[1]) if y is not None else {}
        todo += [(k, to.get(i)) for i, k in reversed(list(enumerate(x[1])))]
    return out


def places(root: Node) -> None:
    """Set ``index`` of each page node: the preorder number of its place in the root's shape."""
    at = number(root.shape)
    todo = [(root, root.shape)]
    while todo:
        node, s = todo.pop()
        node.index = at[id(s)] if s is not None else -1
        kids = children(node)
        if kids:
            to = _to(node.shape[1], s[1]) if s is not None else {}
            todo += [(k, to.get(g)) for k, g in zip(kids, node.groups)]
