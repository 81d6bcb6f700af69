"""Main text of web pages by line-block distribution (operator 7).

Markup is stripped to *lines*, one for each block of the page. What markup itself
declares not to be the article (scripts, styles, menus, page headers and footers,
sidebars, notices, adverts, forms, reader comments) leaves empty lines behind, and
so does a line that is links for the most part, unless it is a sentence with words of its own; but an element that holds the page's
article or main part, or most of its text, is never left out. Then the text lengths of
``window`` neighbouring lines are summed for each line: the distribution *surges* where
text begins and *dives* to zero where a window is empty. Text between a surge and the
next dive is kept when the distribution reaches ``thick`` characters there; inside an
element that the page marks as its article or main part, any text does, and text outside
it counts only where it is thicker than the marked part. If nothing is that thick, the
thickest stretch is kept.

Every page is worked on by itself in an Arrow function.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import prepare, slices, utf8

WINDOW = 3
THICK = 80
#: Characters outside links with which a sentence that is links for the most part counts as text.
OWN = 10

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<[!?/][^>]*>|<(/?)([a-zA-Z][^\s/>"']*)([^>]*)>""", re.DOTALL)
#: One whole ``name``, ``name=value``, ``name="value"`` or ``name='value'``.
_ATTRIBUTE = re.compile(r"""([^\s/>="']+)(?:\s*=\s*(?:"([^"]*)(?:"|\Z)|'([^']*)(?:'|\Z)|([^\s>"'][^\s>]*)))?""")
_TOKEN = re.compile(r"[a-z0-9_-]+")
_WORD = re.compile(r"[a-z]+")
_SENTENCE = re.compile(r"""[.!?\u2026]["'\u201d\u2019)\]]*\Z""")
_CLOSED = re.compile(r"""(?:^|[\s"'])/\Z""")
#: Elements whose content is never page text; their content is skipped as it stands. (An annotation repeats a formula as source.)
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "object", "canvas", "annotation", "annotation-xml")
#: Elements that are not the article by their name.
APART = {"nav", "footer", "aside", "menu", "button", "select", "dialog", "head"}
#: Elements that begin and end a block.
BLOCKS = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
             "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th "
             "thead tr ul button select".split())
VOID = {"br", "hr", "img", "input", "meta", "link", "wbr", "area", "base", "col", "embed", "source", "track", "param"}
#: Items that the next item ends.
ITEMS = {"li", "dd", "dt", "option", "tr", "td", "th"}
#: Tokens of a class, id or role that name a part beside the article.
PARTS = set("nav navbar navigation menu menubar sidebar comment comments respond disqus reply replies related recommended recommendations breadcrumb "
            "breadcrumbs responses pagination pager footer complementary contentinfo ad ads adv advert adverts advertisement advertising sponsor sponsored cookie "
            "cookies consent gdpr promo promotion newsletter subscribe subscription signup login popup modal share sharing".split())
#: Tokens that mark an element as not the article.
MARKS = PARTS | set("banner notice notices alert social overlay masthead toolbar widget widgets search tags toc".split())
#: Words that a mark may stand with in one token (main-nav, comment-list, ad-300x250); with any other word it is another token (has-sidebar).
WITH = set("site main global page top bottom left right primary secondary post entry article block box bar links list area section items item icons "
           "buttons form body inner x reader readers user users visitor wide narrow large small cta".split())


def _marked(token: str) -> set[str]:
    """The marks that a whole token is made of; none if it has other words too."""
    if not _TOKEN.fullmatch(token):
        return set()
    words = set(_WORD.findall(token))
    return words & MARKS if words <= MARKS | WITH else set()


def _declared(attributes: str) -> tuple[str, str]:
    """What attributes declare: ``part`` (hidden, or a part beside the article), ``mark`` or nothing; and the role."""
    kind, role = "", ""
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").strip().lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            kind = "part"
        elif name in ("class", "id", "role"):
            role = value if name == "role" else role
            marks = set().union(*[_marked(x) for x in value.split()])
            kind = "part" if kind == "part" or marks & PARTS else "mark" if kind or marks else ""
    return kind, role


def _tokens(page: str) -> tuple[list[tuple], dict[int, int]]:
    """Texts ``("", text, whether in a link)`` and tags ``(name, closing, attributes)`` of a page in order;
    and where each element ends that a tag of its own or the next item closes (a footer in any case)."""
    tokens: list[tuple] = []
    ends: dict[int, int] = {}
    stack: list[tuple[str, int]] = []  # open elements
    places: dict[str, list[int]] = {}  # in the stack, by name
    blocks: list[int] = []  # places of blocks in the stack
    at, end, link = 0, len(page), 0  # link: height of the stack in the open link
    unclosed: set[str] = set()

    def close(place: int) -> None:
        nonlocal link
        while len(stack) > place:
            name, opened = stack.pop()
            places[name].pop()
            if blocks and blocks[-1] == len(stack):
                blocks.pop()
            if len(stack) == place or name == "footer":
                ends[opened] = len(tokens)
        link = link if link <= len(stack) else 0

    while at < end:
        tag = _TAG.search(page, at)
        stop = tag.start() if tag else end
        if stop > at:
            tokens.append(("", entities.unescape(page[at:stop]), link > 0))
        if not tag:
            break
        at = tag.end()
        name = (tag[2] or tag[5] or "").lower()
        if not name:
            continue
        closing, attributes = bool(tag[1] or tag[4]), tag[3] or tag[6] or ""
        empty = name in VOID or bool(_CLOSED.search(attributes))
        if not closing and name in RAW and not empty:
            shut = None if name in unclosed else re.compile(rf"</{name}\b[^>]*>", re.IGNORECASE).search(page, at)
            if not shut:
                unclosed.add(name)
            at = shut.end() if shut else (end if name in ("script", "style") else at)
            continue
        if closing:
            if places.get(name) and (name in BLOCKS or not blocks or places[name][-1] > blocks[-1]):
                close(places[name][-1])
            link = 0 if name == "a" else link
        elif name in BLOCKS:
            if blocks and stack[blocks[-1]][0] == "p":
                close(blocks[-1])
            if name in ITEMS and blocks and stack[blocks[-1]][0] == name:
                close(blocks[-1])
        tokens.append((name, closing, attributes))
        if not closing and not empty:
            if name in BLOCKS:
                blocks.append(len(stack))
            places.setdefault(name, []).append(len(stack))
            stack.append((name, len(tokens) - 1))
            link = len(stack) if name == "a" else link
    for name, opened in stack:
        if name == "footer":
            ends[opened] = len(tokens)
    return tokens, ends


def _lengths(tokens: list[tuple], without: list[tuple[int, int]]) -> list[int]:
    """Characters outside links before each token, those of some stretches not counted."""
    out, total, skip = [0], 0, 0
    opens = dict(without)
    for i, t in enumerate(tokens):
        skip = max(skip, opens.get(i, 0))
        if not t[0] and not t[2] and i >= skip:
            total += len(" ".join(t[1].split()))
        out.append(total)
    return out


def _left_out(tokens: list[tuple], ends: dict[int, int], thick: int, release: bool) -> tuple[dict[int, int], dict[int, int]]:
    """Begin and end of each element that is left out, and of those that have the role of an article or main part.

    A part beside the article (menu, footer, sidebar, comments, advert, hidden) is kept if it holds the main
    part or an article with most of the page's text, and with ``release`` if it holds most of
    the text itself. Any other element that is marked, a form or a page header is kept if it holds the
    main part, an article (of at least a quarter of the longest one's text), or most of the text that is in no part."""
    length = _lengths(tokens, [])
    parts, marks, articles, mains, roles = [], [], [], [], {}
    depth = 0
    for i, (name, closing, attributes) in enumerate(tokens):
        if not name:
            continue
        if name in ("article", "main"):
            depth = max(0, depth + (-1 if closing else 1))
        if closing:
            continue
        kind, role = _declared(attributes) if attributes and name not in ("html", "body", "main") else ("", "")
        if name in APART:
            kind = "part"
        elif not kind and (name == "form" or (name == "header" and not depth)):
            kind = "mark"
        known = ends.get(i, 0)
        stop = known or len(tokens)
        if role in ("article", "main") and known:
            roles[i] = known
        if name == "main" or role == "main":
            if length[stop] > length[i]:
                mains.append(i)
        elif (name == "article" or role == "article") and kind != "part":
            articles.append((i, stop))
        if kind and known:
            (parts if kind == "part" else marks).append((i, known))

    def holds(opens: list[int], a: int, b: int) -> bool:
        k = bisect_left(opens, a)
        return k < len(opens) and opens[k] < b

    most = [i for i, stop in articles if 2 * (length[stop] - length[i]) > length[-1]]
    parts = [(a, b) for a, b in parts if not holds(mains, a, b) and not holds(most, a, b)
             and not (release and length[b] - length[a] >= thick and 2 * (length[b] - length[a]) > length[-1])]
    length = _lengths(tokens, parts)
    size = [length[stop] - length[i] for i, stop in articles]
    longest = max(size, default=0)
    large = [i for (i, _), n in zip(articles, size, strict=True) if n and 4 * n >= longest]
    least = thick if not release else 1
    marks = [(a, b) for a, b in marks if not holds(mains, a, b) and not holds(large, a, b)
             and not (length[b] - length[a] >= least and 2 * (length[b] - length[a]) > length[-1])]
    return dict(parts + marks), roles


def lines_of(page: str, thick: int = THICK, release: bool = False) -> list[tuple[str, int, bool]]:
    """Lines ``(text, characters outside links, inside an article or main part)`` of a page; an
    empty line stands where something that is not the article was."""
    tokens, ends = _tokens(page)
    out, roles = _left_out(tokens, ends, thick, release)
    lines: list[tuple[str, int, bool]] = []
    parts: list[str] = []
    linked: list[str] = []
    article, role, i = 0, 0, 0

    def flush(inside: bool) -> None:
        text = " ".join("".join(parts).split())
        if text:
            lines.append((text, len(text) - min(len(text), len(" ".join("".join(linked).split()))), inside))
        parts.clear()
        linked.clear()

    while i < len(tokens):
        name, closing, rest = tokens[i]
        if not name:
            parts.append(closing)
            if rest:
                linked.append(closing)
            i += 1
            continue
        if name in BLOCKS or i == role or i in roles:
            flush(article > 0 or i <= role)
        elif name == "br":
            parts.append(" ")
        if name in ("article", "main"):
            article = max(0, article + (-1 if closing else 1))
        if i in out:  # goes on at its closing tag
            if name in BLOCKS:
                lines.append(("", 0, False))
            i = max(i + 1, out[i])
            continue
        role = max(role, roles.get(i, 0))
        i += 1
    flush(article > 0 or i <= role)
    return lines


def _runs(weight: list[int], window: int) -> list[tuple[int, int, int]]:
    """Stretches from a surge to the next dive, and the height of each."""
    runs, start = [], None
    for i in range(len(weight)):
        block = sum(weight[i : i + window])  # the block that begins here
        if start is None and weight[i]:
            start = i  # surge
        if start is not None and not block:
            runs.append((start, i))  # dive
            start = None
    if start is not None:
        runs.append((start, len(weight)))
    return [(a, b, max(sum(weight[i : i + window]) for i in range(a, b))) for a, b in runs]


def main_blocks(page: str, window: int = WINDOW, thick: int = THICK) -> list[str]:
    """The blocks of a page's main text, in page order."""
    lines, runs = [], []
    for release in (False, True):
        lines = lines_of(page, thick, release)
        # a line of links weighs nothing, unless the article holds it or it is a sentence around links
        weight = [len(text) if inside else (free if 2 * free > len(text) or (free >= OWN and _SENTENCE.search(text)) else 0) for text, free, inside in lines]
        runs = _runs(weight, window)
        marked = any(text and inside for text, _, inside in lines)
        if marked or any(h >= thick for _, _, h in runs):
            break
    if marked:  # the page says where its article is; thicker text beside it is kept too
        within = _runs([w if x[2] else 0 for w, x in zip(weight, lines, strict=True)], window)
        beside = [r for r in _runs([0 if x[2] else w for w, x in zip(weight, lines, strict=True)], window) if r[2] >= thick]
        many = sum(w for a, b, _ in beside for w, x in zip(weight[a:b], lines[a:b], strict=True) if not x[2])
        both = bool(beside) and (max(h for _, _, h in beside) > max(h for _, _, h in within) or many > sum(w for w, x in zip(weight, lines, strict=True) if x[2]))
        kept = {i for a, b, _ in beside for i in range(a, b) if weight[i]} if both else set()
        return [text for i, (text, _, inside) in enumerate(lines) if text and (inside or i in kept)]
    if not runs:
        return []
    least = min(thick, max(h for _, _, h in runs))
    return [lines[i][0] for a, b, h in runs if h >= least for i in range(a, b) if lines[i][0] and weight[i]]


def _extract(batches: Iterator[pa.RecordBatch], window: int, thick: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "_html"):
        n = batch.num_columns - 1
        blocks = [main_blocks(x.decode("utf-8", "replace"), window, thick) for x in utf8(batch.column(n))]
        texts = ["\n\n".join(b) for b in blocks]
        new = [("text", pa.array(texts, pa.string())), ("n_chars", pa.array([len(t) for t in texts], pa.int64())), ("n_blocks", pa.array([len(b) for b in blocks], pa.int32()))]
        yield pa.RecordBatch.from_arrays([*batch.columns[:n], *[a for _, a in new]],
                                         schema=pa.schema([*list(batch.schema)[:n], *[pa.field(k, a.type) for k, a in new]]))


def extract_main_text(pages: DataFrame, *, window: int = WINDOW, thick: int = THICK, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns of ``pages`` named in ``keep``, and ``text`` (blocks joined by an empty line; empty
    if there is none), ``n_chars`` (its code points) and ``n_blocks``, for every row. A null page is
    empty. Character references are decoded; white space inside a block is one space.
    Columns are matched by position, so other names cannot clash; an empty table gives an
    empty table."""
    prepare(pages.sparkSession)
    rows = pages.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.col(html_col).cast("string").alias("_html"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema[:-1])
    out = rows.mapInArrow(partial(_extract, window=window, thick=thick), f"{fields}{', ' if keep else ''}text string, n_chars long, n_blocks int")
    return out.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "text", "n_chars", "n_blocks")
