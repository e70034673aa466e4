"""HTML as a stream of tokens, each with its role: what it is and on which path of elements it stands."""

from __future__ import annotations

import html
import re
from functools import lru_cache
from typing import NamedTuple

import xxhash

from tidemark.llm.common import utf8

TAG = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</[^a-zA-Z>][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"'=]++|=\s*+(?:\"[^\"]*\"|'[^']*')?+|[\"'])*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)

# Fixed values of HTML: elements without content, with raw text, within a line of text
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rb rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
# Fixed values of HTML: a start tag ends an open element of the first group, unless one of the second is nearer
_BLOCKS = ("address article aside blockquote center details dialog dir div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr "
           "main menu nav ol p pre section table ul").split()
_CELLS = frozenset(("td", "th")), frozenset(("tr", "table"))
ENDS = {**{t: (frozenset(("p",)), frozenset(("button", "td", "th", "caption"))) for t in _BLOCKS},
        "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu"))), "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
        "dd": (frozenset(("dt", "dd")), frozenset(("dl",))), "td": _CELLS, "th": _CELLS,
        "tr": (frozenset(("tr",)), frozenset(("table", "tbody", "thead", "tfoot"))),
        "option": (frozenset(("option",)), frozenset(("select",)))}

# What an element says about its text: never part of an article, by name ...
ASIDE = frozenset("head script style noscript template iframe textarea select button nav footer aside menu dialog svg math canvas object "
                  "audio video title xmp noembed noframes".split())
# ... by a word of its class or id, or by its role
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disqus "
    "footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promotion "
    "promoted recommended related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe "
    "subscription teaser toolbar topbar widget".split())
ASIDE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
WHOLE = frozenset(("html", "body", "main"))  # their classes speak of the page, not of their text

OFF, PLAIN, MAIN, ARTICLE = range(4)
START, CLOSE, TEXT = range(3)


class Token(NamedTuple):
    kind: int
    role: int  # 64 bits: path and name; of a text also its words
    name: str
    region: int
    linked: bool
    text: str


@lru_cache(maxsize=4096)
def _label(name: str, attributes: str) -> tuple[str, frozenset, bool]:
    """Name with classes and id (digits alike), the words of these, and whether the element holds an article."""
    words, parts, article = set(), [], name == "article"
    for key, *values in ATTRIBUTE.findall(attributes):
        value, key = html.unescape("".join(values)), key.lower()
        if key in ("class", "id"):
            parts.append(key[0] + re.sub(r"\d+", "0", " ".join(sorted(value.split()))))
            words.update(re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()))
        elif key == "role" and value.strip().lower() in ASIDE_ROLES:
            words.add(" off")
        elif key == "role" and value.strip().lower() == "main":
            words.add(" main")
        article |= key == "itemprop" and value.strip() == "articleBody"
    return ".".join([name, *sorted(parts)]), frozenset(words), article


def _region(name: str, words: frozenset, article: bool, outer: int, form: bool) -> int:
    if outer == OFF and not (form and (article or name == "main" or " main" in words)):
        return OFF
    inside = outer in (MAIN, ARTICLE)
    if name in ASIDE or name == "form" or " off" in words or (name == "header" and not inside):
        return OFF
    marks = words & ASIDE_WORDS
    if name not in WHOLE and marks and not (inside and marks <= {"header"}):
        return OFF
    if article:
        return ARTICLE
    return max(outer, MAIN if name == "main" or " main" in words else PLAIN)


def tokens(page: str) -> list[Token]:
    """Tags and texts of a page in order. Unclosed and stray tags are taken as browsers do, nearly enough."""
    out, stack, open_count = [], [("", 0, PLAIN, False, False)], {}  # name, path, region, in a link, off by a form alone
    at = 0

    def text(raw: str) -> None:
        if raw and not raw.isspace():
            _, path, region, linked, _ = stack[-1]
            words = " ".join(html.unescape(raw).split())
            out.append(Token(TEXT, xxhash.xxh3_64_intdigest(utf8(words), path ^ 1), "", region, linked, raw))

    def pop() -> tuple:
        gone = stack.pop()
        open_count[gone[0]] -= 1
        return gone

    end = len(page)
    while at < end:
        found = TAG.search(page, at)
        if found is None:
            text(page[at:])
            break
        text(page[at:found.start()])
        at = found.end()
        if found[1] is not None:
            text(html.escape(found[1], quote=False))
        name = (found[3] or "").lower()
        if not name:
            continue
        if found[2]:
            if open_count.get(name):
                while True:
                    gone = pop()
                    if gone[0] == name:
                        break
                out.append(Token(CLOSE, gone[1] ^ 2, name, stack[-1][2], stack[-1][3], ""))
            else:
                out.append(Token(CLOSE, xxhash.xxh3_64_intdigest(utf8(name), stack[-1][1] ^ 3), name, stack[-1][2], stack[-1][3], ""))
            continue
        attributes = found[4]
        if name in ENDS:
            closed, walls = ENDS[name]
            if any(open_count.get(c) for c in closed):
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] in walls:
                        break
                    if stack[depth][0] in closed:
                        while len(stack) > depth:
                            pop()
                        break
        label, words, article = _label(name, attributes if "=" in attributes and ATTRIBUTE.search(attributes) else "")
        _, path, region, linked, form = stack[-1]
        mine = xxhash.xxh3_64_intdigest(utf8(label), path)
        inner = _region(name, words, article, region, form)
        out.append(Token(START, mine, name, inner, linked, ""))
        if name in VOID:
            continue
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(page, at)
            at = close.start() if close else end
        stack.append((name, mine, inner, linked or name == "a", inner == OFF and (form or (region != OFF and name == "form"))))
        open_count[name] = open_count.get(name, 0) + 1
    return out


def blocks(kept: list[tuple[Token, bool]]) -> str:
    """Texts that are kept, by blocks: character references decoded, white space as one space."""
    out, held = [], []
    for token, keep in kept:
        if token.kind == TEXT:
            if keep:
                held.append(html.unescape(token.text))
        elif token.name not in INLINE and held:
            out.append(" ".join("".join(held).split()))
            held = []
    out.append(" ".join("".join(held).split()))
    return " ".join(x for x in out if x)
