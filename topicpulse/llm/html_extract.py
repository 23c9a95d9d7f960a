"""Main text of web pages by minimum-cut labelling.

A page is cut into blocks at block tags; scripts, styles, forms' controls and comments never become
text. A linear classifier gives each block a cost for either label from its length, links, punctuation and
the names of the elements around it (tag, class, id, role). The costs become the
capacities to the terminals; neighbouring blocks and blocks close in the element tree are joined by
smoothness edges. The minimum cut, found by augmenting paths after fixing the blocks whose own cost
outweighs all their edges, separates content from boilerplate.

White space in a block becomes single blanks, character references are decoded, and blocks are
joined in page order by an empty line. A null or empty page, or one without content, gives "".
Broken markup is read as far as it goes: unclosed elements end with their parent, an unclosed
script, style or comment ends with the page.
"""

from __future__ import annotations

import html
import re
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements that start a new block, elements without text, and void elements (fixed values of HTML).
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section "
                  "summary table tbody td tfoot th thead title tr ul".split())
SILENT = frozenset("script style noscript template svg math iframe object head title select button textarea "
                   "canvas audio video datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title".split())
# What opening one of these closes first.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("article aside body div footer form header main nav ol section table td ul".split())

# Classifier: evidence for content (positive) or boilerplate (negative).
TAG_WEIGHT = {"article": 3.0, "main": 2.0, "p": 1.0, "h1": 1.5, "h2": 0.7, "h3": 0.5, "blockquote": 0.7, "pre": 0.7,
              "nav": -9.0, "footer": -9.0, "aside": -9.0, "form": -9.0, "menu": -6.0, "header": -3.0, "dialog": -7.0,
              "li": -0.3, "option": -5.0, "fieldset": -4.0, "figcaption": 0.2}
NAME_WEIGHT = {
    -9.0: "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion promoted banner "
          "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe "
          "subscription signup login comment comments commentlist disqus reply replies respond sidebar side nav navbar "
          "navigation menu breadcrumb breadcrumbs footer foot masthead toolbar pager pagination share sharing social "
          "related recommended recommendations widget widgets copyright legal search teaser outbrain taboola",
    1.5: "article content main post entry story body text prose"}
NAMES = {n: w for w, names in NAME_WEIGHT.items() for n in names.split()}
ROLES = {"navigation": -8.0, "banner": -5.0, "contentinfo": -8.0, "complementary": -7.0, "search": -7.0, "form": -7.0,
         "dialog": -7.0, "alert": -7.0, "main": 2.0, "article": 3.0}
START, LENGTH, LINKS, STOPS, SHORT_WORDS = -0.8, 0.55, -5.0, 0.6, 4
NEXT_EDGE, PARENT_EDGE = 0.5, 0.8
UNIT = 1000  # capacities are whole thousandths

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(/?)>", re.S)
_ATTR = re.compile(r"(?:^|[\s\"'/])(class|id|role|aria-label|hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_VALUE = re.compile(r"=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s/]|$)")  # among the names, without values
_SPLIT = re.compile(r"[^a-z0-9]+")
_ENDS = {t: re.compile(rf"</{t}\b[^>]*(?:>|\Z)|\Z", re.I) for t in RAW}


class _Block:
    __slots__ = ("parts", "linked", "parent", "weight", "text", "depth")

    def __init__(self, parent: int, weight: float, depth: int):
        self.parts, self.linked, self.parent, self.weight, self.depth = [], 0, parent, weight, depth


def _name_weight(tag: str, attrs: str) -> float:
    w = TAG_WEIGHT.get(tag, 0.0)
    if "=" in attrs:
        for name, a, b, c in _ATTR.findall(attrs):
            value = (a or b or c).lower()
            if name.lower() == "role":
                w += ROLES.get(value, 0.0)
            else:
                hints = [NAMES[x] for x in _SPLIT.split(value) if x in NAMES]
                if hints and not (min(hints) < 0 and tag in ("html", "body", "main", "article")):
                    w += min(hints) if min(hints) < 0 else max(hints)
    return w


def blocks(page: str) -> list[_Block]:
    """Blocks with text, in page order."""
    out: list[_Block] = []
    # tag, best evidence for content, sum of evidence against, element number, silent
    stack: list[tuple[str, float, float, int, bool]] = [("", 0.0, 0.0, 0, False)]
    seen, current, link, at = 0, None, 0, 0
    if "<" not in page:
        body = _Block(0, 0.0, 0)
        body.parts.append(page)
        out.append(body)
    while at < len(page):
        m = _TOKEN.search(page, at)
        text = page[at:m.start() if m else len(page)]
        if text and not stack[-1][4]:
            if current is None:
                if not text.isspace():
                    current = _Block(stack[-1][3], stack[-1][1] + stack[-1][2], len(stack))
                    out.append(current)
            if current is not None:
                current.parts.append(text)
                if link:
                    current.linked += len(text)
        if m is None:
            break
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
                if stack[i][0] in SCOPE and tag not in SCOPE and tag not in ("html", "body"):
                    break
            if tag == "a":
                link = 0
            elif tag in BLOCK:
                current = None
            continue
        if tag == "br" and current is not None:
            current.parts.append(" ")
        if tag in BLOCK:
            current = None
            link = 0
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in CLOSES.get(tag, ()):
                    del stack[i:]
                    break
                if stack[i][0] in SCOPE:
                    break
        if tag == "a":
            link = 1
        if tag in VOID or m[4]:
            continue
        if tag in RAW:
            at = _ENDS[tag].search(page, at).end()
            continue
        if tag in BLOCK or tag in SILENT:
            seen += 1
            _, best, worst, _, silent = stack[-1]
            own = _name_weight(tag, m[3])
            hidden = "hidden" in m[3] and _HIDDEN.search(_VALUE.sub(" ", m[3])) is not None
            stack.append((tag, max(best, own), worst + min(own, 0.0), seen, silent or hidden or tag in SILENT))
    for b in out:
        b.text = " ".join(html.unescape("".join(b.parts)).split())
    return [b for b in out if b.text]


def score(b: _Block) -> float:
    """Evidence that the block is content."""
    words = b.text.count(" ") + 1
    raw = max(1, sum(map(len, b.parts)))
    ends = b.text.count(". ") + b.text.count("? ") + b.text.count("! ") + (b.text[-1] in ".!?…")
    return (START + b.weight + LENGTH * min(words, 30) ** 0.5 - (0.8 if words < SHORT_WORDS else 0.0)
            + LINKS * min(1.0, b.linked / raw) + STOPS * min(ends, 3))


def edges(found: list[_Block]) -> list[tuple[int, int, int]]:
    """Neighbours in page order, and neighbours below the same element."""
    out, last = [], {}
    for i, b in enumerate(found):
        if i:
            near = abs(found[i - 1].depth - b.depth)
            out.append((i - 1, i, int(UNIT * NEXT_EDGE / (1 + near))))
        if b.parent in last:
            out.append((last[b.parent], i, int(UNIT * PARENT_EDGE)))
        last[b.parent] = i
    return [e for e in out if e[2] > 0]


def minimum_cut(gain: list[int], links: list[tuple[int, int, int]]) -> list[bool]:
    """True for the source side. gain > 0 is the cost of labelling a node False, < 0 of True.

    Nodes whose own gain is at least the sum of their edges are fixed first (they keep that side in some
    minimum cut) and their edges become gains of the neighbours; the rest is cut by maximum flow.
    Ties go to the sink side (False).
    """
    n, gain = len(gain), list(gain)
    near: list[dict[int, int]] = [{} for _ in range(n)]
    for a, b, c in links:
        near[a][b] = near[a].get(b, 0) + c
        near[b][a] = near[b].get(a, 0) + c
    side: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:
        i = todo.popleft()
        if side[i] is None and (abs(gain[i]) > sum(near[i].values()) or not near[i]):
            side[i] = gain[i] > 0
            for j, c in near[i].items():
                del near[j][i]
                gain[j] += c if side[i] else -c
                todo.append(j)
            near[i] = {}
    rest = [i for i in range(n) if side[i] is None]
    if rest:
        flow = [dict(x) for x in near]
        supply, drain = [max(g, 0) for g in gain], [max(-g, 0) for g in gain]

        def search():
            came, queue = {i: -1 for i in rest if supply[i] > 0}, deque(i for i in rest if supply[i] > 0)
            while queue:
                i = queue.popleft()
                if drain[i] > 0:
                    return came, i
                for j, c in flow[i].items():
                    if c > 0 and j not in came:
                        came[j] = i
                        queue.append(j)
            return came, None

        while (found := search())[1] is not None:
            came, end = found
            path, i = [end], end
            while came[i] >= 0:
                i = came[i]
                path.append(i)
            push = min(supply[path[-1]], drain[end], *(flow[b][a] for a, b in zip(path, path[1:])))
            supply[path[-1]] -= push
            drain[end] -= push
            for a, b in zip(path, path[1:]):
                flow[b][a] -= push
                flow[a][b] = flow[a].get(b, 0) + push
        for i in rest:
            side[i] = i in found[0]
    return [bool(s) for s in side]


def main_text(page: str) -> str:
    found = blocks(page)
    content = minimum_cut([int(UNIT * score(b)) for b in found], edges(found))
    return "\n\n".join(b.text for b, c in zip(found, content) if c)


def extracted(pages: DataFrame, page_id: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """page_id, url, text, n_chars."""
    def run(batches):
        for b in batches:
            texts = [main_text(p or "") for p in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(body).alias("b")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
