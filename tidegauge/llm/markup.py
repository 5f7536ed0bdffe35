"""The visible blocks of a page, and what its markup says of them.

A small scanner in the manner of the HTML standard's tokenizer: raw text elements, comments,
unclosed paragraphs and cut-off pages are read as browsers read them. It says where a block
stands; whether a template printed it is for ``boilerplate`` to find out.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

#: Where a block stands, from what says least to what says most.
OPEN, MAIN, ARTICLE = range(3)

_TAG = re.compile(
    r"""<(?:!--(?P<comment>.*?)(?:--!?>|\Z)|[!?][^>]*(?:>|\Z)"""
    r"""|(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<given>(?:[^>"']+|"[^"]*"|'[^']*'|["'])*)(?:>|\Z))""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])|[^a-zA-Z0-9]+")

# Element names of the HTML standard.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# An end tag of these parts blocks even where none is open.
_LONE = frozenset("br hr p".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_BLOCKS = frozenset(
    """address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol
    optgroup option p pre search section summary table tbody td tfoot th thead tr ul""".split()
)
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"},
}

# Elements that hold no part of an article; those of the second set hold none even around one.
_APART = frozenset("nav footer form header menu search button select fieldset label datalist".split())
_NEVER = frozenset("head aside dialog noscript template object canvas svg audio video map".split())
# The same for words of an element's class and id, and for its role.
_APART_WORDS = frozenset(
    """ad ads adsbygoogle advert adverts advertisement advertising sponsor sponsored promo promotion banner
    cookie cookies consent gdpr notice notices alert sidebar menu menus nav navbar navigation breadcrumb
    breadcrumbs footer masthead topbar toolbar share sharing social related recommended newsletter
    subscribe subscription signup login popup modal overlay paywall search widget widgets pagination pager
    copyright""".split()
)
_NEVER_WORDS = frozenset("comment comments disqus respond replies".split())
_HEADER_WORDS = frozenset("header site page global top main".split())
_LAYOUT_WORDS = frozenset("has no with without".split())
_APART_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split()
)


class Block(NamedTuple):
    place: int
    tag: str
    words: list[str]


class _Element(NamedTuple):
    name: str
    place: int
    apart: int
    label: str


def visible_blocks(page: str) -> list[Block]:
    """The page's blocks of words outside of menus, forms and the like, in order."""
    blocks: list[Block] = []
    stack = [_Element("", OPEN, 0, "")]
    held: list[str] = []

    def flush() -> None:
        if words := "".join(held).split():
            blocks.append(Block(stack[-1].place, _label(stack), words))
        held.clear()

    at = 0
    while at < len(page):
        tag = _TAG.search(page, at)
        low = tag.start() if tag else len(page)
        if low > at and not stack[-1].apart:
            text = page[at:low]
            held.append(html.unescape(text) if "&" in text else text)
        if tag is None:
            break
        at = tag.end()
        if tag["name"] is None:
            continue
        name = tag["name"].lower()
        if name in _BLOCKS and (not tag["end"] or name in _LONE or any(x.name == name for x in stack)):
            flush()
        if name in _LONE and name != "p":
            continue
        if tag["end"]:
            _close(stack, name)
        elif name in _RAW:
            end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
        elif name not in _VOID:
            _open(stack, name, tag["given"])
    flush()
    return blocks


def _label(stack: list[_Element]) -> str:
    return next((x.label for x in reversed(stack) if x.name in _BLOCKS), "")


def _close(stack: list[_Element], name: str) -> None:
    """End the innermost element of the name; an inline one is looked for in its block only."""
    crossing = name in _BLOCKS or name in _APART or name in _NEVER
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].name == name:
            del stack[k:]
            return
        if not crossing and stack[k].name in _BLOCKS:
            return


def _open(stack: list[_Element], name: str, given: str) -> None:
    if name in _BLOCKS:
        # A block ends an open paragraph, and an item the item before it.
        ended, cut = _CLOSES.get(name, frozenset()) | {"p"}, len(stack)
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].name in ended:
                cut = k
            elif stack[k].name in _BLOCKS or stack[k].name in _APART:
                break
        del stack[cut:]
    above = stack[-1]
    found = _ATTRIBUTE.findall(given) if given and not given.isspace() else ()
    attributes = {k.lower(): a or b or c for k, a, b, c in found}
    named = f"{attributes.get('class', '')} {attributes.get('id', '')}".strip()
    place, apart = above.place, above.apart
    role = attributes.get("role", "").lower()
    starts = ARTICLE if name == "article" or role == "article" else MAIN if name == "main" or role == "main" else OPEN
    own = 0 if name in ("html", "body") else _apartness(name, named, role, attributes, place)
    if starts and own < 2:
        # An article within an article is a comment, or a teaser of another one.
        own = 2 if starts == ARTICLE and above.place == ARTICLE else 0
        if apart < 2:
            apart = 0
        place = max(place, starts)
    label = "\x01" + name + "." + ".".join(named.split())
    stack.append(_Element(name, place, max(apart, own), label))


def _apartness(name: str, named: str, role: str, attributes: dict[str, str], place: int) -> int:
    """0 for a part of the text, 1 for what stands apart from it, 2 for what does so always."""
    style = attributes.get("style", "").replace(" ", "").lower()
    hidden = "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in style
    if name in _NEVER or hidden:
        return 2
    worst = 0
    for part in named.split():
        words = {x.lower() for x in (part, *_HUMP.split(part)) if x}
        if words & _NEVER_WORDS:
            return 2
        if words & _LAYOUT_WORDS:
            continue
        header = "header" in words and words - {part.lower()} <= _HEADER_WORDS and not place
        worst = max(worst, int(bool(words & _APART_WORDS) or header))
    # The header of an article or of the main part holds its title.
    apart = name in _APART and not (name == "header" and place)
    return max(worst, int(apart or role in _APART_ROLES))
