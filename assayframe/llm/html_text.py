"""Main text of web pages by a tree-structured graphical model.

A page's DOM is a tree of elements and text runs.  All text of a node is
content, or none, or some of it; a node's observed features (tag, words of its
class, id and role, its place and neighbours, text length, share of linked
text, ...) and the state of its parent decide which.  What is below a node of
all content is content, so a list of links in an article stays with it, and
only children of mixed nodes are told apart.  Potentials of features, and of
children of mixed nodes by their tag, are fitted to labelled pages by
conditional likelihood.  Sum-product messages pass upward from the leaves and downward from the
root, for the nodes of many pages at once, level by level, and give the exact
marginal of every node; the text runs whose marginal of being content is at
least one half are kept and joined by block.

The labelled pages are made here from layouts (``labelled_pages``): an article
among menus, headers, footers, sidebars, notices, adverts, forms and comments,
in different markup and order, or bare divisions, lists and tables, or plain
text.  The fit is of fixed size; applying the model covers every page whole.

Defined results: a null or empty page, or one without content, has an empty
text; broken markup is read as far as it goes, a quote that nothing closes
ending with its tag; a page's rows may repeat.
White space inside a block becomes one space, blocks are trimmed and joined by
an empty line, and nothing is cut.
"""

from __future__ import annotations

import functools
import html
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayframe.llm.bpe import slices
from assayframe.llm.shared import short_batches

#: Elements by what the HTML standard says of them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template svg iframe".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br img".split())
#: An opening tag of the first kind ends an open element of the second kind.
BLOCK_ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SAME_END = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "thead": (), "tbody": ("thead", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"), "body": ("head",)}
SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "option": ("select",), "tbody": ("table",), "tfoot": ("table",)}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*')(?=[\s/>]|\Z)|=)*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z]{2,}")
TEXT = "#text"


class Node:
    __slots__ = ("tag", "names", "parent", "depth", "text", "block")

    def __init__(self, tag: str, names: str, parent: int, depth: int, text: str = "", block: int = 0):
        self.tag, self.names, self.parent, self.depth, self.text, self.block = tag, names, parent, depth, text, block


def parse(page: str) -> list[Node]:
    """Elements and text runs of a page in order; the first is the root.

    ``block`` of a text run changes wherever a block element opens or ends.
    """
    nodes = [Node("#root", "", -1, 0)]
    open_nodes = [0]
    places: dict[str, list[int]] = {}  # of each tag, where its open elements stand among all
    block, at, size = 0, 0, len(page)
    lower = None

    def text(raw: str) -> None:
        if raw and not raw.isspace():
            nodes.append(Node(TEXT, "", open_nodes[-1], len(open_nodes), html.unescape(raw), block))
        elif raw and nodes[-1].tag == TEXT and nodes[-1].block == block:
            nodes[-1].text += " "

    def end(tags: tuple[str, ...], scope: tuple[str, ...]) -> None:
        """Ends the innermost open element of ``tags`` that ``scope`` doesn't enclose, and what is open in it."""
        last = lambda names: max((places[t][-1] for t in names if places.get(t)), default=0)
        if (at := last(tags)) > last(scope):
            for i in open_nodes[at:]:
                places[nodes[i].tag].pop()
            del open_nodes[at:]

    while at < size:
        found = _TOKEN.search(page, at)
        if not found:
            text(page[at:])
            break
        text(page[at : found.start()])
        at = found.end()
        if not found[2]:
            continue
        tag = found[2].lower()
        if tag == "br":
            if nodes[-1].tag == TEXT and nodes[-1].block == block:
                nodes[-1].text += " "
            else:
                text("\n")
            continue
        if tag not in INLINE:
            block += 1
        if found[1]:
            if tag not in VOID:
                end((tag,), ("td", "th") if tag in INLINE or tag == "p" else ())
            continue
        if tag in BLOCK_ENDS_P:
            end(("p",), ("article", "section", "div", "aside", "td", "th", "li", "blockquote", "form", "main", "nav", "header", "footer", "button"))
        if tag in SAME_END and SAME_END[tag]:
            for same in SAME_END[tag]:
                end((same,), SCOPE.get(tag, ()))
        names = ""
        if found[3] and "=" in found[3]:
            names = " ".join(f"{a.lower()} {b or c or d}" for a, b, c, d in _ATTRIBUTE.findall(found[3])).lower()
        nodes.append(Node(tag, names, open_nodes[-1], len(open_nodes)))
        if tag in RAW:
            lower = lower or page.lower()
            close = lower.find(f"</{tag}", at)
            close = size if close < 0 else close
            if tag in ("title", "textarea", "noscript") and page[at:close].strip():
                nodes.append(Node(TEXT, "", len(nodes) - 1, len(open_nodes) + 1, html.unescape(page[at:close]), block))
            at = page.find(">", close) + 1 or size
            block += 1
        elif tag not in VOID and not found[3].endswith("/"):
            places.setdefault(tag, []).append(len(open_nodes))
            open_nodes.append(len(nodes) - 1)
    return nodes


#: Elements that say what part of a page they are.
PARTS = frozenset("article main section nav aside header footer form".split())


def features(nodes: list[Node]) -> list[tuple[str, ...]]:
    """Observed features of each node; none for elements without text."""
    n = len(nodes)
    size, linked, texts = [0] * n, [0] * n, [0] * n
    in_link, inside = [False] * n, ["page"] * n
    for i in range(1, n):
        node = nodes[i]
        p = node.parent
        in_link[i] = in_link[p] or node.tag == "a"
        inside[i] = nodes[p].tag if nodes[p].tag in PARTS else inside[p]
        if node.tag == TEXT:
            size[i] = len(node.text.split())
            linked[i] = size[i] if in_link[i] else 0
            texts[i] = 1
    for i in range(n - 1, 0, -1):
        p = nodes[i].parent
        size[p] += size[i]
        linked[p] += linked[i]
        texts[p] += texts[i]
    before, after, last = [""] * n, [""] * n, {}
    for i in range(1, n):
        if texts[i]:
            p = nodes[i].parent
            if p in last:
                before[i] = nodes[last[p]].tag
                after[last[p]] = nodes[i].tag
            last[p] = i
    out: list[tuple[str, ...]] = []
    for i, node in enumerate(nodes):
        if not texts[i]:
            out.append(())
            continue
        if node.tag in ("#root", "html", "body"):  # what they hold decides
            out.append((f"tag {node.tag}",))
            continue
        own = [f"tag {node.tag}", f"size {size[i].bit_length()}", f"linked {4 * linked[i] // max(1, size[i])}", f"parent {nodes[node.parent].tag if i else ''}", f"share {4 * size[i] // max(1, size[0])}"]
        own += [f"inside {inside[i]}", f"{node.tag} linked {4 * linked[i] // max(1, size[i])}"]
        own += [f"{side} {tag}" for side, tag in (("before", before[i]), ("after", after[i])) if tag]
        if node.tag == TEXT:
            stripped = node.text.strip()
            own.append(f"ends {stripped[-1:] in tuple('.!?…:;') if stripped else ''}")
            own.append(f"sign {any(c in node.text for c in '©|»·')}")
        else:
            own.append(f"mean {(size[i] // texts[i]).bit_length()}")
            own += [f"name {w}" for w in sorted(set(_WORD.findall(node.names)) - {"class", "id", "role"})] or ["unnamed"]
        out.append(tuple(own))
    return out


# Labelled pages


@functools.cache
def _vocabulary() -> list[str]:
    rng = random.Random(5)
    return ["".join(rng.choices("abcdefghilmnoprstuvéèüñ", k=rng.randint(1, 9))) for _ in range(3000)]


def _words(rng: random.Random, low: int, high: int) -> str:
    return " ".join(rng.choices(_vocabulary(), k=rng.randint(low, high))).capitalize() + rng.choice(("", ".", ".", "."))


def _sentences(rng: random.Random, low: int = 1, high: int = 7) -> str:
    return " ".join(_words(rng, 3, 18).rstrip(".") + rng.choice((".", ".", ".", "?", "!")) for _ in range(rng.randint(low, high)))


def _named(rng: random.Random, tag: str, names: tuple[str, ...], bare: float = 0.25) -> str:
    if rng.random() < bare:
        return f"<{tag}>"
    return f'<{tag} {rng.choice(("class", "class", "id"))}="{rng.choice(names)}">'


def _links(rng: random.Random, list_share: float = 0.7) -> str:
    links = [f'<a href="/{i}">{_words(rng, 1, 3)}</a>' for i in range(rng.choice((1, 2, 3, 4, 5, 6, 8)))]
    if rng.random() < list_share:
        tag = rng.choice(("ul", "ul", "ol"))
        return f"<{tag}>" + "".join(f"<li>{x}</li>" for x in links) + f"</{tag}>"
    return rng.choice((" | ", " ", " &middot; ", "<br>")).join(links)


def _prose(rng: random.Random) -> str:
    """Inside a content block: sentences with inline markup and links."""
    text = _sentences(rng)
    kind = rng.random()
    if kind < 0.15:
        return f"<b>{text}</b> {_sentences(rng)}"
    if kind < 0.3:
        return f'{text} <a href="/x">{_words(rng, 1, 4)}</a> {_sentences(rng)}'
    if kind < 0.4:
        return f"<em>{_words(rng, 1, 5)}</em> {text}"
    if kind < 0.5:
        return f"<b>{text}<br>"
    if kind < 0.7:  # short runs between inline elements
        tags = rng.choices(("b", "em", "a href=/y", "code", "span", "i"), k=rng.randint(1, 4))
        return "".join(f"{_words(rng, 1, 5)} <{t}>{_words(rng, 1, 3)}</{t.split()[0]}> " for t in tags) + rng.choice((".", _words(rng, 1, 6), ""))
    return text


def _short(rng: random.Random) -> str:
    """A block of an article of short or linked parts: lists, steps, indexes, questions, galleries, verses, figures."""
    many = range(rng.randint(2, 9))
    few = lambda: _words(rng, 1, 6).rstrip(".")
    kind = rng.choice((0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 9, 10))
    if kind == 0:
        tag = rng.choice(("ul", "ol"))
        return f"<{tag}>" + "".join(f"<li>{few()}</li>" for _ in many) + f"</{tag}>"
    if kind == 1:
        tag = rng.choice(("ul", "ul", "ol"))
        return f"<{tag}>" + "".join(f'<li><a href="/{i}">{few()}</a>{rng.choice(("", "", " " + few()))}</li>' for i in many) + f"</{tag}>"
    if kind in (2, 9):
        tag = rng.choice(("div", "p", "div", "span")) if kind == 2 else "div"
        stop = rng.choice((".", ""))
        return "".join(f"<{tag}>{few()}{stop}</{tag}>" for _ in many)
    if kind == 10:  # columns of text written out
        return f"<p>{' | '.join(few() for _ in range(rng.randint(3, 40)))}</p>"
    if kind == 3:
        return "".join(f"<h3>{few()}?</h3><p>{_words(rng, 2, 12)}</p>" for _ in many)
    if kind == 4:
        return "".join(f"<figure><img src=/{i}.png><figcaption>{few()}</figcaption></figure>" for i in many)
    if kind == 5:
        return "<p>" + "<br>".join(few() for _ in many) + "</p>"
    if kind == 6:
        head = "<tr>" + "".join(f"<th>{few()}</th>" for _ in range(3)) + "</tr>"
        return f"<table>{head}" + "".join("<tr>" + "".join(f"<td>{rng.randint(0, 9999) / rng.choice((1, 10, 100))}</td>" for _ in range(3)) + "</tr>" for _ in many) + "</table>"
    if kind == 7:
        return "".join(f"<details><summary>{few()}</summary>{rng.choice(('', '<p>'))}{_words(rng, 3, 15)}</details>" for _ in many)
    return "".join(f'<p><a href="/{i}">{few()}</a></p>' for i in many)


def _content(rng: random.Random) -> list[str]:
    """Blocks of an article; of one in four, most are short."""
    out = []
    if rng.random() < 0.85:
        out.append(f"<h1>{_words(rng, 2, 12)}</h1>")
    short = rng.choice((0.08, 0.08, 0.7))
    for _ in range(rng.choice((1, 1, 2, 3, 4, 5, 6, 7, 9))):
        if rng.random() < short:
            out.append(_short(rng))
            continue
        kind = rng.random()
        if kind < 0.72:
            out.append(f"<p>{_prose(rng)}" + ("</p>" if rng.random() < 0.9 else ""))
        elif kind < 0.8:
            out.append(f"<{(h := rng.choice(('h2', 'h3', 'h4')))}>{_words(rng, 1, 8)}</{h}>")
        elif kind < 0.86:
            out.append("<ul>" + "".join(f"<li>{_sentences(rng, 1, 2)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>")
        elif kind < 0.9:
            out.append(f"<blockquote><p>{_sentences(rng)}</p></blockquote>")
        elif kind < 0.93:
            out.append(f"<pre><code>{_words(rng, 3, 20)}</code></pre>")
        elif kind < 0.945:
            out.append("<dl>" + "".join(f"<dt>{_words(rng, 1, 4)}</dt><dd>{_sentences(rng, 1, 2)}</dd>" for _ in range(rng.randint(1, 4))) + "</dl>")
        elif kind < 0.96:
            out.append("<table>" + "".join(f"<tr><td>{_words(rng, 1, 4)}</td><td>{_words(rng, 1, 6)}</td></tr>" for _ in range(rng.randint(2, 4))) + "</table>")
        else:
            out.append(f'<figure><img src="x.png"><figcaption>{_words(rng, 3, 12)}</figcaption></figure>')
    return out


#: Names that layouts give to what is not content, by the kinds that the contract of the extraction lists.
OTHER_NAMES = {
    "nav": ("nav", "menu", "navbar", "main-menu", "breadcrumb", "breadcrumbs", "navigation", "pagination", "toc"),
    "header": ("header", "masthead", "top", "banner", "site-header", "topbar", "logo"),
    "footer": ("footer", "site-footer", "bottom", "copyright", "legal", "colophon"),
    "aside": ("sidebar", "aside", "widget", "related", "recommended", "popular", "trending", "right-rail"),
    "notice": ("cookie", "cookie-notice", "consent", "notice", "gdpr", "banner-cookie", "alert", "popup", "modal", "newsletter", "subscribe", "paywall"),
    "ad": ("ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner-ad", "ad-slot", "sponsor"),
    "form": ("search", "login", "signup", "form", "contact-form", "search-form", "subscribe-form"),
    "comments": ("comments", "comment", "comment-list", "responses", "replies", "disqus", "discussion", "reader-comments"),
    "share": ("share", "social", "share-buttons", "tags", "author-box", "follow"),
}


def _other(rng: random.Random, kind: str) -> str:
    names = OTHER_NAMES[kind]
    if kind == "nav":
        tag = rng.choice(("nav", "nav", "div", "ul"))
        if tag == "ul":
            return _named(rng, "ul", names, 0) + "".join(f'<li><a href="/{i}">{_words(rng, 1, 2)}</a></li>' for i in range(rng.randint(3, 8))) + "</ul>"
        return _named(rng, tag, names, 0.6 if tag == "nav" else 0) + _links(rng) + f"</{tag}>"
    if kind == "header":
        tag = rng.choice(("header", "header", "div"))
        inner = rng.choice(("", f'<a href="/">{_words(rng, 1, 3)}</a>', f"<h1>{_words(rng, 1, 4)}</h1>", f"<p>{_words(rng, 2, 9)}</p>", f"<div>{_words(rng, 1, 6)}</div>"))
        return _named(rng, tag, names, 0.6 if tag == "header" else 0) + (inner or _words(rng, 1, 5)) + (_other(rng, "nav") if rng.random() < 0.4 else "") + f"</{tag}>"
    if kind == "footer":
        tag = rng.choice(("footer", "footer", "footer", "div"))
        inner = rng.choice((_words(rng, 1, 3), f"&copy; {_words(rng, 1, 6)}", f"<p>&copy; {_sentences(rng, 1, 3)}</p>", _links(rng), f"{_sentences(rng, 1, 3)}\n{_sentences(rng, 1, 2)}", f"<p>{_sentences(rng, 1, 3)}</p>" + _links(rng)))
        return _named(rng, tag, names, 0.6 if tag == "footer" else 0) + inner + f"</{tag}>"
    if kind == "aside":
        tag = rng.choice(("aside", "aside", "div", "section"))
        inner = "".join(rng.choice((f"<h3>{_words(rng, 1, 4)}</h3>", f"<p>{_sentences(rng, 1, 4)}</p>", _links(rng), f"<div>{_words(rng, 2, 12)}</div>")) for _ in range(rng.randint(1, 3)))
        return _named(rng, tag, names, 0.5 if tag == "aside" else 0) + inner + f"</{tag}>"
    if kind == "form":
        label = f"<label>{_words(rng, 1, 4)}</label><input type=text>"
        field = rng.choice((label, f"<p>{_words(rng, 2, 9)}</p>{label}", f"<select><option>{_words(rng, 1, 2)}<option>{_words(rng, 1, 2)}</select>", f"<textarea>{_words(rng, 1, 6)}</textarea>", f"<fieldset><legend>{_words(rng, 1, 3)}</legend>{label}</fieldset>"))
        return _named(rng, "form", names, 0.5) + field + f"<button>{_words(rng, 1, 2)}</button></form>"
    if kind == "comments":
        tag = rng.choice(("section", "div", "div", "ul", "ol"))
        inner_tag = "li" if tag in ("ul", "ol") else rng.choice(("div", "article", "p"))
        inner = "".join(_named(rng, inner_tag, ("comment", "comment-body", "reply", "comment-item"), 0.4) + (f"<b>{_words(rng, 1, 2)}</b> " if rng.random() < 0.5 else "") + (f"<p>{_sentences(rng)}</p>" if inner_tag != "p" and rng.random() < 0.7 else _sentences(rng)) + f"</{inner_tag}>" for _ in range(rng.randint(1, 5)))
        return _named(rng, tag, names, 0) + (f"<h{(h := rng.choice('234'))}>{_words(rng, 1, 3)}</h{h}>" if rng.random() < 0.6 and inner_tag != "li" else "") + inner + f"</{tag}>"
    tag = rng.choice(("div", "div", "section", "aside", "p")) if kind != "share" else rng.choice(("div", "ul", "p"))
    inner = rng.choice((_sentences(rng, 1, 3), f"{_sentences(rng, 1, 2)}\n{_sentences(rng, 1, 2)}", f'{_sentences(rng, 1, 2)} <a href="/k">{_words(rng, 1, 3)}</a>', f"<span>{_words(rng, 1, 7)}</span><button>{_words(rng, 1, 2)}</button>"))
    if tag not in ("p", "ul") and rng.random() < 0.5:
        inner = f"<p>{inner}</p>"
    return _named(rng, tag, names, 0) + inner + f"</{tag}>"


#: Names that parts of articles have, some with words that elsewhere name what is none.
PART_NAMES = ("related-work", "background", "introduction", "method", "results", "discussion-of-results", "summary", "top-story", "notice-of-change", "section", "chapter", "legal-history", "comment-on-results", "text", "body")


def _bare(rng: random.Random) -> list[str]:
    """Blocks of an article without paragraphs."""
    kind = rng.random()
    if kind < 0.2:
        return [*([f"<h1>{_words(rng, 1, 6)}</h1>"] if rng.random() < 0.6 else []), *(_short(rng) for _ in range(rng.randint(1, 3)))]
    if kind < 0.35:
        return [f"<div>{_prose(rng)}</div>" for _ in range(rng.randint(1, 6))]
    if kind < 0.5:
        return ["<dl>" + "".join(f"<dt>{_words(rng, 1, 4)}<dd>{_sentences(rng, 1, 3)}" for _ in range(rng.randint(1, 6))) + "</dl>"]
    if kind < 0.65:
        return ["<table>" + "".join(f"<tr><td>{_words(rng, 1, 4)}</td><td>{_sentences(rng, 1, 3)}</td></tr>" for _ in range(rng.randint(1, 6))) + "</table>"]
    if kind < 0.8:
        return ["<ul>" + "".join(f"<li>{_sentences(rng, 1, 3)}" for _ in range(rng.randint(2, 8))) + "</ul>"]
    if kind < 0.9:
        return [f"<pre>{_sentences(rng)}\n\n{_sentences(rng)}</pre>"]
    return ["<br><br>".join(_sentences(rng) for _ in range(rng.randint(1, 5)))]


#: How pages are laid out.
FAMILIES = ("article",) * 6 + ("parts", "parts", "bare", "bare", "bare", "table", "table", "plain")


def _mark(part: str) -> str:
    """``part`` with the mark \\x01 at the start of each of its texts."""
    return re.sub(r"(^|>)(?=[^<]*[^<\s])", "\\1\x01", part)


def _page(rng: random.Random, family: str = "article") -> str:
    """A page, with the mark \\x01 at the start of each text of its content."""
    if rng.random() < 0.03:  # nothing but what is around articles
        return f"<html><body>{''.join(_other(rng, rng.choice(('nav', 'header', 'footer', 'notice', 'form', 'share'))) for _ in range(rng.randint(1, 4)))}</body></html>"
    if family == "plain":
        text = _mark("\n\n".join(_words(rng, 1, 9) if rng.random() < 0.2 else _sentences(rng) for _ in range(rng.randint(1, 8))))
        return text if rng.random() < 0.6 else f"<html><body>{text}</body></html>"
    if family in ("bare", "table"):
        body = "".join(map(_mark, _bare(rng) if family == "bare" or rng.random() < 0.3 else _content(rng)))
        wrap = rng.random()
        if family == "bare" and wrap < 0.6:
            body = rng.choice((f"<div>{body}</div>", f"<article>{body}</article>", f"<main>{body}</main>", f'<div class="{rng.choice(("content", "text", "post", "body", "entry"))}">{body}</div>', f'<div id="content">{body}</div>'))
        around = lambda kinds, share: "".join(_other(rng, rng.choice(kinds)) for _ in range(rng.randint(0, 2)) if rng.random() < share)
        if family == "table":
            side = _links(rng, 0.3) if rng.random() < 0.7 else _other(rng, "aside")
            cells = [f"<td>{side}</td>", f"<td>{body}</td>"]
            rng.shuffle(cells)
            body = f"<table><tr>{''.join(cells)}</tr></table>"
        return f"<html><head><title>{_words(rng, 1, 6)}</title></head><body>{around(('nav', 'header', 'ad', 'notice'), 0.6)}{body}{around(('footer', 'footer', 'comments', 'ad', 'form'), 0.6)}</body></html>"
    blocks = [_mark(x) for x in _content(rng)]
    if family == "parts":
        blocks = [_named(rng, tag, PART_NAMES, 0) + "".join(_mark(x) for x in _content(rng)) + f"</{tag}>" for tag in rng.choices(("section", "div"), k=rng.randint(1, 4))]
    for kind in rng.sample(tuple(OTHER_NAMES), rng.randint(0, 2)):
        blocks.insert(rng.randint(1, len(blocks)), _other(rng, rng.choice((kind, "ad", "comments", "share", "aside", "form", "notice"))))
    body = "".join(blocks)
    wrap = rng.random()
    if wrap < 0.55:
        body = _named(rng, "article", ("post", "article", "entry", "story"), 0.6) + body + "</article>"
    elif wrap < 0.75:
        body = _named(rng, rng.choice(("div", "section")), ("content", "post", "article-body", "entry-content", "main-content", "story", "text"), 0.15) + body + "</div>"
    if wrap > 0.4:
        body = rng.choice(("<main>", '<div id="main">', '<div class="container">', '<div role="main">', "<div>")) + body + rng.choice(("</main>", "</div>"))
    before = [_other(rng, rng.choice(("nav", "header", "header", "ad", "notice", "form", "aside"))) for _ in range(rng.randint(0, 4))]
    after = [_other(rng, rng.choice(("footer", "footer", "aside", "comments", "ad", "notice", "nav", "form", "share"))) for _ in range(rng.randint(0, 4))]
    if rng.random() < 0.6:
        before = [_other(rng, "nav"), *before]
    if rng.random() < 0.6:
        after = [*after, _other(rng, "footer")]
    head = f"<head><meta charset=utf-8><title>{_words(rng, 2, 9)}</title><style>p{{margin:0}}</style><script>var t=1;</script></head>"
    return f"<!DOCTYPE html><html>{head}<body>{''.join(before)}<!-- x -->{body}{''.join(after)}" + ("</body></html>" if rng.random() < 0.9 else "")


#: States of a node: none of its text is content, some, all.
NONE, MIXED, ALL = range(3)


def labelled_pages(n: int, seed: int, families: tuple[str, ...] = FAMILIES) -> Iterator[tuple[list[Node], np.ndarray]]:
    """Parsed pages and the state of each node, that of elements without text meaning nothing."""
    rng = random.Random(seed)
    for _ in range(n):
        nodes = parse(_page(rng, rng.choice(families)))
        good, texts = np.zeros(len(nodes), int), np.zeros(len(nodes), int)
        for i in range(len(nodes) - 1, -1, -1):
            node = nodes[i]
            if node.tag == TEXT:
                good[i], texts[i] = "\x01" in node.text, 1
                node.text = node.text.replace("\x01", "")
            if i:
                good[node.parent] += good[i]
                texts[node.parent] += texts[i]
        yield nodes, np.where(good == 0, NONE, np.where(good == texts, ALL, MIXED))


class Forest:
    """The nodes of many pages that hold text, in order, as arrays for passing messages."""

    def __init__(self, pages: list[list[Node]]):
        nodes = [node for page in pages for node in page]
        starts = np.cumsum([0, *map(len, pages)])
        parent = np.array([node.parent for node in nodes], np.int64) + np.repeat(starts[:-1], np.diff(starts))
        self.features = [own for page in pages for own in features(page)]
        full = np.array([bool(own) for own in self.features], bool)
        place = np.cumsum(full) - 1
        self.kept = np.flatnonzero(full)  # elements without text say nothing and are left out
        self.parent = np.array([place[p] if d else -1 for p, d in zip(parent[self.kept], (nodes[i].depth for i in self.kept))], np.int64)
        self.tags = [nodes[i].tag for i in self.kept]
        self.text = np.array([t == TEXT for t in self.tags], bool)
        depth = np.array([nodes[i].depth for i in self.kept], np.int64)
        order = np.argsort(depth, kind="stable")
        self.levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)
        self.features = [self.features[i] for i in self.kept]
        self.starts = np.searchsorted(self.kept, starts)

    def passed(self, local: np.ndarray, mixed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Marginals of the states of each node, and of a mixed parent with them; from log potentials of nodes, and of nodes whose parent is mixed."""
        local = np.where(self.text[:, None] & (np.arange(3) == MIXED), -1e9, local)  # one text isn't parted
        up, sent = local.copy(), np.zeros_like(local)
        for level in self.levels[:0:-1]:
            # below a node of no or all content there is nothing else
            sent[level] = np.stack([up[level, NONE], np.logaddexp.reduce(mixed[level] + up[level], axis=1), up[level, ALL]], axis=1)
            np.add.at(up, self.parent[level], sent[level])
        belief, pair = up.copy(), np.zeros_like(local)
        for level in self.levels[1:]:
            above = belief[self.parent[level]] - sent[level]
            through = mixed[level] + above[:, [MIXED]]
            down = through.copy()
            for state in (NONE, ALL):
                down[:, state] = np.logaddexp(down[:, state], above[:, state])
            belief[level] += down
            pair[level] = through + up[level]
        total = np.logaddexp.reduce(belief, axis=1, keepdims=True)
        pair[self.levels[0]] = -np.inf
        return np.exp(belief - total), np.exp(pair - total)


class TreeModel:
    """Log potentials of features by state, and of nodes with a mixed parent by tag and state."""

    def __init__(self, emissions: dict[str, tuple[float, ...]], transitions: dict[str, tuple[float, ...]]):
        self.emissions, self.transitions = emissions, transitions
        self._sums: dict[tuple[str, ...], tuple[float, ...]] = {}

    def _sum(self, own: tuple[str, ...]) -> tuple[float, ...]:
        """Log potentials of some features together; kept while they are few."""
        found = tuple(map(sum, zip((0.0,) * 3, *(self.emissions[f] for f in own if f in self.emissions))))
        if len(self._sums) < 50_000:
            self._sums[own] = found
        return found

    def marginals(self, pages: list[list[Node]]) -> list[np.ndarray]:
        """Probability that all text of each node is content, for all pages together; zero for elements without text."""
        trees = Forest(pages)
        out = np.zeros(sum(map(len, pages)))
        if len(trees.kept):
            get = self._sums.get
            local = np.array([get(own) or self._sum(own) for own in trees.features])
            mixed = np.array([self.transitions.get(tag, (0.0,) * 3) for tag in trees.tags])
            out[trees.kept] = trees.passed(local, mixed)[0][:, ALL]
        ends = np.cumsum([0, *map(len, pages)])
        return [out[a:b] for a, b in zip(ends, ends[1:])]


#: Share of independent features' log shares that potentials start from, and what is added to each count.
PRIOR, SMOOTHING = 0.3, 0.5
#: Steps of the fit, their size, the weight of squared changes of potentials against the mean log likelihood of a page, and the parts of the pages that take turns.
STEPS, STEP, RIDGE, PARTS_OF_FIT = 260, 0.1, 3e-3, 8


@functools.cache
def fit(n_pages: int = 1200, seed: int = 11, families: tuple[str, ...] = FAMILIES) -> TreeModel:
    """The model of greatest conditional likelihood of the states of ``n_pages`` labelled pages.

    Its gradient is what is counted less what the marginals expect, as for any
    log-linear model; steps are scaled by running means of squared gradients.
    """
    labelled = list(labelled_pages(n_pages, seed, families))
    parts = [labelled[k::PARTS_OF_FIT] for k in range(PARTS_OF_FIT)]
    trees = [Forest([nodes for nodes, _ in part]) for part in parts]
    counts = Counter(f for part in trees for own in part.features for f in own)
    known = {f: k for k, f in enumerate(sorted(f for f, c in counts.items() if c >= 5))}
    tags = {t: k for k, t in enumerate(sorted({t for part in trees for t in part.tags}))}
    batches = []
    for part, own in zip(parts, trees):
        states = np.concatenate([state for _, state in part])[own.kept]
        places = [[known[f] for f in x if f in known] or [len(known)] for x in own.features]
        sizes = np.array([len(x) for x in places])
        flat, node = np.array([k for x in places for k in x]), np.repeat(np.arange(len(places)), sizes)
        true = np.eye(3)[states]
        with_mixed = true * ((own.parent >= 0) & (states[own.parent] == MIXED))[:, None]
        batches.append((own, len(part), flat, node, sizes.cumsum() - sizes, np.array([tags[t] for t in own.tags]), true, with_mixed))
    summed = lambda at, values, like: np.stack([np.bincount(at, values[:, k], len(like)) for k in range(3)], axis=1)
    seen = sum(summed(flat, true[node], range(len(known) + 1)) for _, _, flat, node, _, _, true, _ in batches)
    prior = PRIOR * np.log((seen + SMOOTHING) / (seen.sum(axis=0) + SMOOTHING))  # as features that are independent would have it, so what is never seen in a state counts against it
    starts_at = [prior - prior.mean(axis=1, keepdims=True), np.zeros((len(tags), 3))]
    weights = [w.copy() for w in starts_at]
    means = [[np.zeros_like(w), np.zeros_like(w)] for w in weights]
    for step in range(1, STEPS + 1):
        own, n, flat, node, starts, tag, true, with_mixed = batches[step % len(batches)]
        held, pair = own.passed(np.add.reduceat(weights[0][flat], starts), weights[1][tag])
        slopes = [summed(flat, (true - held)[node], weights[0]), summed(tag, with_mixed - pair, weights[1])]
        for w, began, slope, (first, second) in zip(weights, starts_at, slopes, means):
            slope = slope / n - RIDGE * (w - began)
            first += 0.1 * (slope - first)
            second += 0.01 * (slope**2 - second)
            w += STEP * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return TreeModel({f: tuple(weights[0][k].tolist()) for f, k in known.items()}, {t: tuple(weights[1][k].tolist()) for t, k in tags.items()})


def main_texts(pages: list[str], model: TreeModel) -> list[str]:
    """The main text of each page."""
    trees = [parse(page) for page in pages]
    out = []
    for nodes, p in zip(trees, model.marginals(trees)):
        blocks: dict[int, list[str]] = {}
        for node, own in zip(nodes, p):
            if node.tag == TEXT and own >= 0.5:
                blocks.setdefault(node.block, []).append(node.text)
        texts = (" ".join("".join(parts).split()) for parts in blocks.values())
        out.append("\n\n".join(t for t in texts if t))
    return out


def extract(page: Column) -> Column:
    """The main text of a column of pages."""
    model = fit()

    @F.arrow_udf(T.StringType())
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([t for pages in slices(batch, 500_000) for t in main_texts([x or "" for x in pages], model)], pa.string())

    return text(page)


def with_text(df: DataFrame, page: str = "html", to: str = "text") -> DataFrame:
    """``df`` with the main text of column ``page`` in column ``to``."""
    short_batches(df.sparkSession)
    return df.withColumn(to, extract(F.col(page)))
