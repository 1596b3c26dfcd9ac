"""HTML to a flat tree of elements with the features a classifier needs."""

from __future__ import annotations

import html
import math
import re
from dataclasses import dataclass, field

import numpy as np

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript iframe template xmp noembed noframes".split())
# Elements whose text is not shown as text; a tag of TAG_GROUPS ends them if they were left open.
UNSEEN = set("svg select datalist object canvas audio video annotation annotation-xml".split())
# Tags that may stand in a head; any other closes it.
HEAD = set("html head title base link meta style script noscript template".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rt"
    " rp s samp small span strike strong sub sup time tt u var br wbr img nobr math mfrac mi mn mo mover"
    " mpadded mroot mrow ms mspace msqrt mstyle msub msubsup msup mtext munder munderover semantics".split()
)
# An opening tag of the key ends an open element of the value, unless a stopper is between.
ENDS = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
    "body": {"head"},
    "tbody": {"tr", "td", "th", "thead", "tbody"},
}
STOPS = {"ul", "ol", "dl", "table", "select", "html"}
PARAGRAPH_STOPS = {"table", "td", "th", "button", "html"}

TAG_GROUPS = [
    {"p"},
    {"h1", "h2", "h3", "h4", "h5", "h6"},
    {"li", "dt", "dd"},
    {"ul", "ol", "dl"},
    {"table", "thead", "tbody", "tr", "td", "th"},
    {"div"},
    {"section"},
    {"article", "main"},
    {"nav", "menu"},
    {"aside"},
    {"header"},
    {"footer"},
    {"form", "fieldset"},
    {"blockquote", "pre", "figure", "figcaption"},
]
BLOCKS = set().union(*TAG_GROUPS, {"body"})
NOT_MAIN_TAGS = {"nav", "menu", "aside", "footer", "form", "fieldset", "dialog"}
MAIN_TOKENS = set("article main content post entry story body text page prose hentry".split())
OTHER_TOKENS = [
    set("nav navbar navigation navi menu topnav breadcrumb breadcrumbs pager pagination".split()),
    set("header masthead topbar banner logo branding".split()),
    set("footer colophon copyright legal imprint bottom".split()),
    set("sidebar aside widget widgets rail related recommended recommendations trending popular"
        " teaser teasers more".split()),
    set("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion"
        " adsense dfp outbrain taboola".split()),
    set("cookie cookies consent notice notices gdpr popup modal overlay alert paywall newsletter"
        " subscribe subscription signup toast".split()),
    set("comment comments commentlist disqus reply replies respond discussion reactions".split()),
    set("share sharing social follow tags tag meta byline toolbar rating print hidden".split()),
    set("form login search register contact".split()),
]
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>")
LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
ATTRIBUTE = re.compile(
    r"(?<![\w-])(class|id|role|itemprop|hidden|aria-hidden|style|data-y)(?![\w-])(?:\s*=\s*"
    r"(\"[^\"]*\"|'[^']*'|[^\s>]+))?",
    re.I,
)
COMMENT_END = re.compile(r"--!?>")
TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
SENTENCE_MARKS = ".,;:!?"


@dataclass
class Element:
    tag: str
    parent: int
    depth: int
    tokens: list[str]
    label: int | None = None
    own_chars: int = 0
    link_chars: int = 0
    marks: int = 0
    inputs: int = 0
    children: int = 0


@dataclass
class Page:
    """Elements in document order (parents first) and text runs (block, element, text)."""

    elements: list[Element] = field(default_factory=list)
    runs: list[tuple[int, int, str]] = field(default_factory=list)


def _tokens(attributes: str, marked: bool) -> tuple[list[str], int | None]:
    tokens, label = [], None
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "data-y":
            label = int(value) if marked else None
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            tokens.append("hidden")
        elif name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                tokens.append("hidden")
        else:
            tokens += [t.lower() for t in TOKEN.findall(value)]
    return tokens, label


def parse(source: str, marked: bool = True) -> Page:
    """Tolerant parse: unclosed and stray tags, cut-off input, comments and raw text are handled.

    Only a ``marked`` page, one made for training, has its ``data-y`` labels read.
    The places of the open tags are kept by name, so the time is in proportion to
    the source however deep it nests.
    """
    page = Page()
    elements, runs = page.elements, page.runs
    elements.append(Element("#page", -1, 0, []))
    stack: list[tuple[str, int]] = [("#page", 0)]  # open tags with their nearest element
    block, at, end, links, unseen = 0, 0, len(source), 0, 0
    opened: dict[str, list[int]] = {}  # places in the stack, by tag
    outer = [0]  # places of the tags that are not inline

    def push(tag: str, owner: int) -> None:
        opened.setdefault(tag, []).append(len(stack))
        if tag not in INLINE:
            outer.append(len(stack))
        stack.append((tag, owner))

    def last(tags) -> int:
        """Place of the innermost open tag of ``tags``, 0 if there is none."""
        return max((opened[t][-1] for t in tags if opened.get(t)), default=0)

    def text(raw: str) -> None:
        if unseen:
            return
        if in_head() and not raw.strip():
            return
        close_head()
        words = html.unescape(raw) if "&" in raw else raw
        runs.append((block, stack[-1][1], words))
        e = elements[stack[-1][1]]
        n = len(words) - words.count(" ")
        if n:
            e.own_chars += n
            e.link_chars += n if links else 0
            e.marks += sum(words.count(c) for c in SENTENCE_MARKS)

    def pop_to(depth: int) -> None:
        nonlocal block, links, unseen
        unseen -= sum(tag in UNSEEN for tag, _ in stack[depth:])
        hides = unseen > 0
        for tag, _ in stack[depth:]:
            links -= tag == "a"
            hides = hides or tag in UNSEEN
            if tag not in INLINE and not hides:
                block += 1
        for tag, _ in reversed(stack[depth:]):
            opened[tag].pop()
            if tag not in INLINE:
                outer.pop()
        del stack[depth:]

    def in_head() -> bool:
        return any(tag == "head" for tag, _ in stack[:3])

    def close_head() -> None:
        for i, (tag, _) in enumerate(stack[:3]):
            if tag == "head":
                pop_to(i)
                break

    while at < end:
        lt = source.find("<", at)
        if lt < 0:
            text(source[at:])
            break
        if lt > at:
            text(source[at:lt])
        if source.startswith("<!--", lt):
            empty = re.match("-?>", source[lt + 4 : lt + 6])
            close = COMMENT_END.search(source, lt + 4)
            at = lt + 4 + empty.end() if empty else close.end() if close else end
            continue
        if source.startswith(("<!", "<?", "</"), lt) and not source[lt + 2 : lt + 3].isalpha() or (
            source.startswith(("<!", "<?"), lt)
        ):
            close = source.find(">", lt)
            at = end if close < 0 else close + 1
            continue
        match = TAG.match(source, lt) or LOOSE_TAG.match(source, lt)
        if not match:
            if re.match(r"</?[a-zA-Z]", source[lt : lt + 3]):
                break  # a tag cut off by the end of the input
            text("<")
            at = lt + 1
            continue
        at = match.end()
        closing, tag, attributes = match.group(1), match.group(2).lower(), match.group(3)
        if closing:
            place = last([tag])
            if place and (tag not in INLINE or place > outer[-1]):
                pop_to(place)
            continue
        if tag not in HEAD:
            close_head()
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(source, at)
            if not attributes.rstrip().endswith("/"):
                at = close.end() if close else end
            if tag == "textarea":
                elements[stack[-1][1]].inputs += 1
            continue
        if unseen and tag in BLOCKS:
            pop_to(min(opened[t][0] for t in UNSEEN if opened.get(t)))
        if tag in VOID:
            if tag in ("br", "hr"):
                runs.append((block, stack[-1][1], " "))
                block += tag == "hr"
            elif tag == "input":
                elements[stack[-1][1]].inputs += 1
            continue
        if unseen or tag in UNSEEN:
            if tag == "select":
                elements[stack[-1][1]].inputs += 1
            if not attributes.rstrip().endswith("/"):
                links += tag == "a"
                unseen += tag in UNSEEN
                push(tag, stack[-1][1])
            continue
        inline = tag in INLINE
        if not inline and (place := last(["p"])) > last(PARAGRAPH_STOPS):
            pop_to(place)
        if tag in ENDS and (place := last(ENDS[tag])) > last(STOPS):
            pop_to(place)
        tokens, label = _tokens(attributes, marked) if attributes else ([], None)
        owner = stack[-1][1]
        if tag == "button":
            elements[owner].inputs += 1
        special = any(t in group for t in tokens for group in OTHER_TOKENS)
        if not inline or special or label is not None:
            if not inline:
                block += 1
            parent = elements[owner]
            parent.children += 1
            elements.append(Element(tag, owner, parent.depth + 1, tokens, label))
            owner = len(elements) - 1
        links += tag == "a"
        push(tag, owner)
    return page


FEATURES = 14 + len(TAG_GROUPS) + 1 + len(OTHER_TOKENS) + 4


def features(page: Page) -> np.ndarray:
    """One row per element: subtree density, links, depth, siblings, tags and attribute tokens."""
    es = page.elements
    n = len(es)
    chars = [e.own_chars for e in es]
    links = [e.link_chars for e in es]
    marks = [e.marks for e in es]
    inputs = [e.inputs for e in es]
    nodes = [1] * n
    for i in range(n - 1, 0, -1):
        p = es[i].parent
        chars[p] += chars[i]
        links[p] += links[i]
        marks[p] += marks[i]
        inputs[p] += inputs[i]
        nodes[p] += nodes[i]
    total = max(1, chars[0])
    same: dict[tuple[int, str], int] = {}
    for e in es:
        same[e.parent, e.tag] = same.get((e.parent, e.tag), 0) + 1
    place, before = [0] * n, 0
    seen = [0] * n
    good, bad, in_main, in_other = [0] * n, [0] * n, [0] * n, [0] * n
    out = np.zeros((n, FEATURES), dtype=np.float32)
    for i, e in enumerate(es):
        p = e.parent if i else 0
        siblings = es[p].children if i else 1
        place[i] = seen[p]
        if i:
            seen[p] += 1
        own_good = sum(t in MAIN_TOKENS for t in e.tokens)
        groups = [sum(t in g for t in e.tokens) for g in OTHER_TOKENS]
        own_bad = sum(groups)
        if i:
            good[i] = good[p] + own_good
            bad[i] = bad[p] + own_bad
            in_main[i] = in_main[p] or e.tag in ("article", "main")
            in_other[i] = in_other[p] or e.tag in NOT_MAIN_TAGS
        sibling_chars = (chars[p] - chars[i]) / max(1, siblings - 1)
        row = [
            e.depth,
            math.log1p(e.own_chars),
            math.log1p(chars[i]),
            chars[i] / total,
            links[i] / max(1, chars[i]),
            math.log1p(chars[i] / nodes[i]),
            math.log1p(nodes[i]),
            e.children,
            place[i] / max(1, siblings - 1),
            math.log1p(siblings),
            same[e.parent, e.tag] / siblings,
            math.log1p(chars[i]) - math.log1p(sibling_chars),
            marks[i] / max(1, chars[i]),
            before / total,
            *(e.tag in g for g in TAG_GROUPS),
            own_good,
            *groups,
            good[p] if i else 0,
            bad[p] if i else 0,
            in_main[i] - in_other[i],
            inputs[i],
        ]
        out[i] = row
        before += e.own_chars
    return out


def decode(page: Page, log_odds: np.ndarray) -> list[bool]:
    """Kept elements of greatest total score such that nothing dropped holds anything kept.

    Dropping an element drops its subtree; the better of dropping and keeping
    is found bottom-up, then applied top-down.  Each element's log-odds weigh
    with the root of its own text, so wrappers follow what they hold.
    """
    es = page.elements
    n = len(es)
    own = [float(s) * (1.0 + math.sqrt(e.own_chars)) for s, e in zip(log_odds, es)]
    drop = [-x for x in own]
    keep = list(own)
    for i in range(n - 1, 0, -1):
        p = es[i].parent
        drop[p] += drop[i]
        keep[p] += max(keep[i], drop[i])
    kept = [True] * n
    for i in range(1, n):
        kept[i] = kept[es[i].parent] and keep[i] > drop[i]
    return kept


def blocks(page: Page, kept: list[bool]) -> list[str]:
    """Texts of the kept runs by block, white space collapsed, empty blocks left out."""
    parts: dict[int, list[str]] = {}
    for block, element, text in page.runs:
        if kept[element]:
            parts.setdefault(block, []).append(text)
    joined = (" ".join("".join(p).split()) for _, p in sorted(parts.items()))
    return [b for b in joined if b]
