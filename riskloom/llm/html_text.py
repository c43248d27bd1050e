"""Main text of web pages by differencing with the nearest page (operator 4).

Pages are sorted by host and URL path, and each is paired with the neighbour
of its host whose path shares more leading characters (ties: the next one).
Both are cut into text lines, one for each block of the page; the lines are
aligned by longest common subsequence, and shared lines are deleted, as they
belong to the site and not to the page.  What says itself what it is needs no
comparison: navigation, headers, footers, sidebars, notices, adverts, forms,
scripts, styles and reader comments go by their elements, roles and class
names (whole ones; a name hides neither the page's heading nor its only
articles, and inside an article only names that no part of its text has).
Shared lines go inside the page's article or main element as well, with
three exceptions there: its h1 stays; all stay if the neighbour is a copy
(every line is shared, or lines of at least ``LONG`` characters that are
shared make half of the text); and a run of shared lines stays if it is a long
passage (its lines of that length have ``PASSAGE`` characters together).  A page all
of whose lines are shared is a copy of its neighbour and keeps them.

Defined results: null html gives an empty text; a null URL has an empty host
and path; repeated rows are neighbours, and each gives its text; a host's only
page has no pair and loses no line by comparison; further columns are ignored.
Broken markup is read leniently: unknown end tags are passed over, a block
ends where the next one begins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import neighbours, parts

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math xmp noembed noframes".split())
ONCE = frozenset("p li dt dd tr td th option".split())  # ended by the next of their kind
OUT = frozenset("nav footer aside form head menu dialog button select object audio video canvas search label".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar "
                  "toolbar status".split())
NAMES = frozenset(
    "nav navbar navigation menu sidebar sidenav rail footer header masthead topbar banner ad ads adv advert adverts "
    "advertisement sponsor sponsored promo promotion cookie cookies consent gdpr notice alert popup modal overlay "
    "newsletter subscribe subscription signup share sharing social breadcrumb breadcrumbs pagination pager comment "
    "comments commentlist disqus respond related recommended widget toolbar login searchbox searchform copyright "
    "disclaimer".split())
# words that may stand beside such a name within one class or id
BESIDE = frozenset("site main page top bottom left right primary secondary global mobile box bar container wrapper "
                   "slot unit block list links buttons icons area section posts".split())
# inside an article these may name a part of its text
IN_TEXT = frozenset("rail footer header masthead banner promo promotion notice alert overlay modal comment respond widget "
                    "copyright disclaimer".split())
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
LONG, PASSAGE = 80, 240  # characters of a line of prose, and of a passage of them
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_QUICK = re.compile(r"class|id|role|hidden|style", re.I)


def _named(value: str, inside: bool) -> bool:
    """Whether one whole class or id of the value, all its words, names something beside the article."""
    for token in value.lower().split():
        words = [x for x in re.split(r"[-_]+", token) if x]
        names = NAMES.intersection(words)
        if names and all(x in NAMES or x in BESIDE for x in words) and not (inside and names <= IN_TEXT):
            return True
    return False


def _left_out(tag: str, attrs: str, inside: bool) -> str | None:
    """How an element says that it is not part of the article: by "kind" or by a "name", which may mislead."""
    if tag in OUT:
        return "kind"
    out = None
    if not attrs or not _QUICK.search(attrs):
        return out
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id"):
            if tag not in ("html", "body") and _named(value, inside):
                out = "name"
        elif name == "role":
            if value.lower() in ROLES:
                return "kind"
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return "kind"
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return "kind"
    return out


def lines(html: str | None) -> list[tuple[str, bool, str]]:
    """(text, kept by its elements, "text" or "h1" inside article or main, else "") of each block in page order."""
    html = html or ""
    out: list[tuple[str, bool, frozenset, str]] = []
    # tag, left out here by kind, numbers of the doubtful elements around, in article
    stack: list[tuple[str, bool, frozenset, bool]] = []
    held: list[str] = []
    left, doubt, inside, number = False, frozenset(), False, 0
    texts: list[frozenset] = []  # doubtful elements around each article or main
    headings: list[tuple[bool, frozenset]] = []  # of each h1: in article, doubtful elements around it
    forms = frozenset()  # doubtful by their kind: nav, header, form
    bars = frozenset()  # of those, nav and header

    def flush() -> None:
        if held:
            text = " ".join(unescape("".join(held)).split())
            held.clear()
            if text:
                out.append((text, left, doubt, inside and ("h1" if any(x[0] == "h1" for x in stack) else "text")))

    at, end = 0, len(html)
    while at < end:
        m = _TAG.search(html, at)
        if m is None:
            held.append(html[at:])
            break
        if m.start() > at:
            held.append(html[at:m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:
            continue
        tag, close, attrs = tag.lower(), m[1] or m[4], m[3] or m[6] or ""
        if tag == "br" or tag in VOID and tag != "hr":
            if tag == "br":
                held.append(" ")
            continue
        if not close and tag in RAW:
            drawn = tag in ("svg", "math")
            if drawn and attrs.endswith("/"):  # an empty element
                continue
            stop = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            flush_at = tag == "title"
            if flush_at:
                flush()
            at = stop.end() if stop else at if drawn else end
            continue
        block = tag in BLOCKS
        if block:
            flush()
        if close:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
                if not block and stack[k][0] in BLOCKS:  # an inline end does not end a block
                    break
        elif tag != "hr":
            if block:
                while stack and stack[-1][0] not in BLOCKS:  # an inline element ends with its block
                    stack.pop()
                if stack and (stack[-1][0] == tag in ONCE or stack[-1][0] == "p"):
                    stack.pop()
            hide, around, text = (stack[-1][1:] if stack else (False, frozenset(), False))
            omit = _left_out(tag, attrs, text)
            main = tag in ("article", "main")
            if tag == "header" and not text and not omit:
                omit = "kind"
            if omit == "name" or omit and tag in ("nav", "header", "form"):
                number += 1
                around = around | {number}
                if omit == "kind":
                    forms |= {number}
                    if tag != "form":
                        bars |= {number}
            elif omit:
                hide = True
            if main and not hide:
                # an unclosed menu, header or a form around the page does not hide its article
                around -= forms
                stack = [(t, h, d - forms, i) for t, h, d, i in stack]
                texts.append(around)
            if tag == "h1" and not hide and not around & bars:
                headings.append((text, around))
            if block or omit:
                flush()
                stack.append((tag, hide, around, text or main and not hide))
        left, doubt, inside = stack[-1][1:] if stack else (False, frozenset(), False)
    flush()
    # a name does not hide the page's heading, nor its articles if none is outside of such elements
    sure = next((d for i, d in headings if i), headings[0][1] if headings else frozenset())
    if texts and all(texts):
        sure = sure.union(*texts)
    return [(t, not hide and d <= sure, i or "") for t, hide, d, i in out]


def _row(a: list, b: list) -> int:
    """Bit j is 0 where the longest common subsequence of a and b[:j + 1] grows."""
    place: dict = {}
    for j, y in enumerate(b):
        place[y] = place.get(y, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        hit = row & place.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    return row


def _lengths(row: int, n: int) -> list[int]:
    out, total = [0], 0
    for c in reversed(bin(row)[2:].zfill(n)) if n else ():
        total += c == "0"
        out.append(total)
    return out


def common_places(a: list, b: list) -> list[int]:
    """Places in a of one longest common subsequence with b, in space linear in both."""
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    m = 0
    while m < min(len(a), len(b)) - n and a[-1 - m] == b[-1 - m]:
        m += 1
    head, tail = list(range(n)), list(range(len(a) - m, len(a)))
    both = set(a[n:len(a) - m]) & set(b[n:len(b) - m])
    at = [i for i in range(n, len(a) - m) if a[i] in both]
    x, y = [a[i] for i in at], [v for v in b[n:len(b) - m] if v in both]
    mid: list[int] = []
    todo = [(0, len(x), 0, len(y))]
    while todo:
        i, j, k, l = todo.pop()
        if i >= j or k >= l:
            continue
        if j - i == 1:
            if x[i] in y[k:l]:
                mid.append(at[i])
            continue
        h = (i + j) // 2
        up = _lengths(_row(x[i:h], y[k:l]), l - k)
        down = _lengths(_row(x[h:j][::-1], y[k:l][::-1]), l - k)
        cut = max(range(l - k + 1), key=lambda c: up[c] + down[l - k - c])
        todo += [(i, h, k, k + cut), (h, j, k + cut, l)]
    return head + sorted(mid) + tail


def _passages(kept: list[tuple[int, tuple]], shared: set[int]) -> set[int]:
    """Of the shared lines of an article, those that stay: its h1, a copy's, and runs that are long passages."""
    text = [(i, x[0], i in shared) for i, x in kept if x[2]]
    long = sum(len(t) for _, t, on in text if on and len(t) >= LONG)
    if all(on for *_, on in text) or 2 * long >= sum(len(t) for _, t, _ in text):
        return {i for i, *_ in text}
    stay, run = {i for i, x in kept if x[2] == "h1"}, []
    for i, t, on in [*text, (-1, "", False)]:
        if on:
            run.append((i, t))
            continue
        if sum(len(t) for _, t in run if len(t) >= LONG) >= PASSAGE:
            stay.update(i for i, _ in run)
        run = []
    return stay


def main_text(mine: list[tuple[str, bool, str]], other: list[tuple[str, bool, str]] | None) -> str:
    """The lines left after comparison with the paired page's, joined by two line ends."""
    shared = set(common_places([x[0] for x in mine], [x[0] for x in other])) if other else set()
    kept = [(i, x) for i, x in enumerate(mine) if x[1]]
    stay = _passages(kept, shared) if shared else set()
    left = [x[0] for i, x in kept if i not in shared or i in stay]
    return "\n\n".join(left or [x[0] for _, x in kept])


def _prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def extract(pages: DataFrame, partitions: int | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    kind = pages.schema["page_id"].dataType.simpleString()
    url = F.coalesce(F.col("url"), F.lit(""))
    rest = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    keyed = pages.select("page_id", "url", "html", F.lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)).alias("host"),
                         F.regexp_replace(rest, r"^[^/?#]*", "").alias("path"))
    deal = [F.col("host"), F.col("path"), F.col("page_id"), F.xxhash64("html")]

    def rows(cells: list, first: int, last: int) -> Iterator[tuple]:
        cut = {i: lines(cells[i][2]) for i in (first - 1, first) if cells[i]}
        for i in range(first, last):
            if cells[i + 1]:
                cut[i + 1] = lines(cells[i + 1][2])
            me = cells[i]
            near = [j for j in (i + 1, i - 1) if cells[j] and cells[j][3] == me[3]]
            pair = max(near, key=lambda j: _prefix(cells[j][4], me[4]), default=None)
            text = main_text(cut[i], None if pair is None else cut[pair])
            cut.pop(i - 1, None)
            yield me[0], me[1], text, len(text)

    return neighbours(keyed, deal, [*deal, F.col("html")], rows, f"page_id {kind}, url string, text string, n_chars long", partitions or parts(pages))


__all__ = ["common_places", "extract", "lines", "main_text"]
