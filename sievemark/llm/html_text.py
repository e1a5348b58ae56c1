"""Main text of HTML pages by tree scoring.

Pages are parsed into a tree that closes what authors leave open. Subtrees that are no article text by their tag, role, class
or id (scripts, styles, forms, menus, headers, footers, sidebars, notices, adverts, reader comments) go first. Every paragraph
then passes points to its ancestors: one, one for each comma, and one for each hundred characters, whole to the parent and
half as much with each further level. A container's points are discounted by its link density, the share of its text inside links.
The best container is kept, with the siblings that score a fifth as much, or read like running text.

Text rules. Character references are decoded; white space inside a block becomes one space; blocks are trimmed and joined in
page order by one space.

Defined results. Null or empty html, and pages without text: the empty string. Unclosed, crossed and unknown tags are taken
as they come; a page cut short ends where it is cut. A comment or declaration without its proper end ends at the next ">", so
that what follows is read. Whole pages are parsed, however long. Repeated rows are extracted one by one; page_id and url pass through, null too. Other columns are not read.

At scale: one pass over the pages without a shuffle. Reading and scoring are linear in the page, whatever its markup: every
search that can fail fails once for a page, open elements are found by their depth, and points pass up in one walk.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

from pyspark.sql import DataFrame

from .common import over_batches

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: What an opening tag closes, and where the search for it ends.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}, "tbody": {"table"}}
ENDS_P = BLOCK - {"br", "body", "html", "caption", "tr", "td", "th", "tbody", "thead", "tfoot", "legend"}
P_SCOPE = frozenset("article aside blockquote body button caption dd div footer form header html li main nav object section table td th".split())
NO_TEXT = frozenset("script style noscript template head title meta link svg math iframe object embed applet canvas audio video map form button input select textarea option label fieldset nav footer aside menu dialog".split())
NO_ROLE = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
NO_NAME = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright disclaimer disqus dropdown footer gdpr hidden login masthead menu"
    " modal nav navbar navigation newsletter notice notices notification overlay pager pagination paywall popup promo promoted promotion recommended related replies respond search share sharing sidebar signup"
    " skip social sponsor sponsored subscribe subscription tagcloud toolbar topbar widget widgets".split()
)
GOOD_NAME = frozenset("article body content entry main page post story text blog hentry".split())
PARAGRAPH = frozenset("p pre td blockquote li dd div section article main figcaption".split())
#: What noise is compounded with in names ("site-footer", "sidebar-left"); other compounds ("has-sidebar", "social-history") name no noise.
LAYOUT_NAME = frozenset("area bar block bottom box buttons container global icons inner items left link links list outer panel posts right section site top wrap wrapper".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_NAME = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
#: Numeric references that int() refuses to read.
_LONG_NUMBER = re.compile(r"&#([0-9]{1000,})")


_TAG = re.compile(r"[A-Za-z][^\s/>]*")
_ATTRIBUTE = re.compile(r"""[\s/]*+([^\s/>][^\s/>=]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|(?!["'])[^\s>]*+))?""")
_TAG_END = re.compile(r"[\s/]*+>?")
_COMMENT_END = re.compile(r"--!?>")
#: Elements whose content is text up to their own end tag.
RAW = {t: re.compile(rf"</{t}(?=[\s/>])", re.IGNORECASE) for t in ("script", "style", "title", "textarea")}


class Node:
    __slots__ = ("tag", "attrs", "children", "parent", "points", "chars", "linked", "own", "commas", "dropped", "scored")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []
        self.points, self.chars, self.linked, self.own, self.commas = 0.0, 0, 0, 0, 0  # own, commas: of the text outside inner blocks
        self.dropped = self.scored = False

    @property
    def density(self) -> float:
        return self.linked / self.chars if self.chars else 0.0

    @property
    def score(self) -> float:
        return self.points * (1 - self.density)


def tokens(page: str) -> Iterator[tuple[str, str, dict[str, str]]]:
    """("text", characters, {}), ("start", tag, attributes) and ("end", tag, {}) in page order. What looks like no tag is text; comments, declarations and the content of scripts and the like are passed over."""
    at, size = 0, len(page)
    missing: set[str] = set()  # ends that do not occur in the rest of the page

    def after(end: str | re.Pattern, start: int) -> int:
        """Where the rest begins after the next such end; -1 if there is none."""
        name = end if isinstance(end, str) else end.pattern
        if name in missing:
            return -1
        if isinstance(end, str):
            found = page.find(end, start)
            found = found + len(end) if found >= 0 else -1
        else:
            m = end.search(page, start)
            found = m.end() if m else -1
        if found < 0:
            missing.add(name)
        return found

    while at < size:
        mark = page.find("<", at)
        if mark < 0:
            yield "text", unescape(page[at:]), {}
            return
        closing = page.startswith("</", mark)
        name = _TAG.match(page, mark + 1 + closing)
        if name is None and not page.startswith(("<!", "<?", "</"), mark):
            yield "text", unescape(page[at : mark + 1]), {}
            at = mark + 1
            continue
        if mark > at:
            yield "text", unescape(page[at:mark]), {}
        if name is None:
            at = -1
            if page.startswith("<!--", mark):
                at = mark + 5 if page.startswith("<!-->", mark) else mark + 6 if page.startswith("<!--->", mark) else after(_COMMENT_END, mark + 4)
            if at < 0:
                at = after(">", mark + 2)
            if at < 0:
                return
            continue
        tag, at, attrs = name[0].lower(), name.end(), {}
        while m := _ATTRIBUTE.match(page, at):
            value = m[2] or ""
            attrs.setdefault(m[1].lower(), unescape(value[1:-1] if value[:1] in ('"', "'") else value))
            at = m.end()
        at = _TAG_END.match(page, at).end()
        if page[at - 1] != ">":  # the page ends within the tag
            return
        if closing:
            yield "end", tag, {}
            continue
        yield "start", tag, attrs
        if tag in RAW:
            end = after(RAW[tag], at)
            if end >= 0:
                at = after(">", end)
            elif tag in ("script", "style"):
                return
            yield "end", tag, {}
            if at < 0:
                return


class Builder:
    """Builds the tree, closing what authors leave open. For every tag, and for blocks and what ends the search for a paragraph, the depths at which it is open are kept, so that nothing has to be walked through."""

    def __init__(self):
        self.root = Node("html", {}, None)
        self.open = [self.root]
        self.depths: dict[str, list[int]] = {}

    def _groups(self, tag: str) -> list[list[int]]:
        names = [tag]
        if tag in BLOCK:
            names.append("#block")
        if tag in P_SCOPE:
            names.append("#p")
        return [self.depths.setdefault(n, []) for n in names]

    def _innermost(self, tags) -> int:
        return max((d[-1] for t in tags if (d := self.depths.get(t))), default=0)

    def _close(self, tags, scope) -> bool:
        """Closes the innermost open element of these tags, unless one of scope lies in it."""
        depth = self._innermost(tags)
        if not depth or depth < self._innermost(scope):
            return False
        while len(self.open) > depth:
            for held in self._groups(self.open.pop().tag):
                held.pop()
        return True

    def start(self, tag: str, attrs: dict[str, str]) -> None:
        if tag in ("html", "body") and self.open[-1].tag in ("html", "body"):
            if tag == "html" or self.open[-1].tag == "body":
                return
        if tag in ENDS_P:
            self._close(("p",), ("#p",))
        if tag in CLOSES:
            while self._close(CLOSES[tag], SCOPE[tag]):
                pass
        if tag in HEADINGS and self.open[-1].tag in HEADINGS:
            self._close((self.open[-1].tag,), ())
        node = Node(tag, attrs, self.open[-1])
        node.parent.children.append(node)
        if tag not in VOID:
            for held in self._groups(tag):
                held.append(len(self.open))
            self.open.append(node)

    def end(self, tag: str) -> None:
        if tag == "br":
            self.open[-1].children.append(Node("br", {}, self.open[-1]))
        elif tag in BLOCK:
            self._close((tag,), SCOPE.get(tag, ()))
        else:
            self._close((tag,), ("#block",))

    def read(self, page: str) -> Node:
        for kind, what, attrs in tokens(page):
            if kind == "text":
                self.open[-1].children.append(what)
            elif kind == "start":
                self.start(what, attrs)
            else:
                self.end(what)
        return self.root


def _tokens(node: Node) -> list[str]:
    return f"{node.attrs.get('class', '')} {node.attrs.get('id', '')}".lower().split() if node.attrs else []


def _names(node: Node) -> set[str]:
    return {n for t in _tokens(node) for n in _NAME.findall(t)}


def _noise_name(token: str) -> bool:
    """Whether a class or id as a whole names noise, alone or with words of layout."""
    pieces = set(_NAME.findall(token))
    return bool(pieces & NO_NAME) and pieces <= NO_NAME | LAYOUT_NAME


def _no_text(node: Node, in_article: bool) -> bool:
    if node.tag in NO_TEXT or node.tag == "header" and not in_article:
        return True
    a = node.attrs
    if not a or node.tag in ("html", "body", "main"):
        return False
    if "hidden" in a or a.get("aria-hidden") == "true" or a.get("role", "").lower() in NO_ROLE or re.search(r"display\s*:\s*none", a.get("style", "").lower()):
        return True
    tokens = _tokens(node)
    if "header" in tokens and not in_article and node.tag != "article":
        return True
    # names tell of containers; a paragraph or heading is named for what it says
    if node.tag == "p" or node.tag in HEADINGS or not any(_noise_name(t) for t in tokens):
        return False
    return not GOOD_NAME.intersection(tokens) or not {"comment", "comments"}.isdisjoint(tokens)


def _measure(root: Node) -> list[Node]:
    """Marks what is no text, counts characters and link characters, passes points up; returns the containers that got any."""
    order: list[tuple[Node, bool, bool]] = []
    stack = [(root, False, False)]
    while stack:
        node, in_article, in_link = stack.pop()
        if node.parent is not None and _no_text(node, in_article):
            node.dropped = True
            continue
        in_article |= node.tag in ("article", "main")
        in_link |= node.tag == "a"
        order.append((node, in_article, in_link))
        stack += [(x, in_article, in_link) for x in node.children if isinstance(x, Node)]
    containers: list[Node] = []
    for node, _, in_link in reversed(order):
        for x in node.children:
            if isinstance(x, str):
                n = len(_SPACE.sub(" ", x).strip())
                node.chars += n
                node.linked += n if in_link else 0
                node.own += n
                node.commas += x.count(",")
            elif not x.dropped:
                node.chars += x.chars
                node.linked += x.linked
                if x.tag not in BLOCK:
                    node.own += x.own
                    node.commas += x.commas
        passed, at_all = node.points / 2, node.scored
        if node.tag in PARAGRAPH and node.own > 0:
            points, at_all = (1 + node.commas + node.own // 100) * (1 - node.density), True
            if node.tag in ("article", "main"):
                node.points, node.scored = node.points + points, True
                passed += points / 2
            else:
                passed += points
        if at_all and node.parent is not None:
            node.parent.points += passed
            node.parent.scored = True
        if node.scored:
            containers.append(node)
    for node in containers:
        node.points += {"article": 25, "main": 15}.get(node.tag, 0) + (10 if _names(node) & GOOD_NAME and node.tag != "body" else 0)
    return containers


def _blocks(node: Node, out: list[list[str]]) -> None:
    stack: list[Node | str | None] = [node]
    while stack:
        x = stack.pop()
        if x is None:
            out.append([])
        elif isinstance(x, str):
            out[-1].append(x)
        elif not x.dropped:
            if x.tag in BLOCK:
                out.append([])
                stack.append(None)
            stack += reversed(x.children)


def _short_number(m: re.Match) -> str:
    """The reference without leading zeros, or one beyond the last code point, which is replaced alike."""
    digits = m[1].lstrip("0") or "0"
    return "&#" + (digits if len(digits) < 8 else "1114112")


def extract(html: str | None) -> str:
    """The main text of a page."""
    if not html:
        return ""
    root = Builder().read(_LONG_NUMBER.sub(_short_number, html))
    containers = _measure(root)
    chosen: list[Node] = [root]
    if containers:
        best = max(reversed(containers), key=lambda n: n.score)  # of equal ones the outermost, which holds the others
        chosen = [best]
        if best.parent is not None and best.tag not in ("body", "html"):
            least = max(10.0, best.score / 5)
            held = {id(n) for n in containers}
            chosen = []
            for x in best.parent.children:
                if x is best:
                    chosen.append(x)
                elif isinstance(x, Node) and not x.dropped and x.chars and ((id(x) in held and x.score >= least) or (x.tag == "p" and x.density < 0.25 and x.chars > 80) or (x.tag in ("h1", "h2") and best.tag != "article")):
                    chosen.append(x)
    blocks: list[list[str]] = [[]]
    for node in chosen:
        _blocks(node, blocks)
    texts = (_SPACE.sub(" ", "".join(b)).strip() for b in blocks)
    return " ".join(t for t in texts if t)


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row."""

    def rows(batch: list[dict]) -> list[dict]:
        texts = [extract(r["html"]) for r in batch]
        return [{"page_id": r["page_id"], "url": r["url"], "text": t, "n_chars": len(t)} for r, t in zip(batch, texts, strict=True)]

    kind = pages.schema["page_id"].dataType.simpleString()
    return over_batches(pages.select("page_id", "url", "html"), rows, f"page_id {kind}, url string, text string, n_chars long")
