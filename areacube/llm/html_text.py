"""Main text of web pages by minimum cut.

A page becomes a row of text blocks.  A small linear classifier on what each
block looks like and where it stands in the DOM gives two costs, of calling it
content and of calling it boilerplate: the capacities of its edges to the two
terminals.  Neighbouring blocks, and blocks under one parent, are tied by
smoothness edges.  The minimum cut is the cheapest labelling; the source side
is the text.

Before max-flow, blocks whose own preference is at least the sum of
their edges are fixed (their label is the same in some minimum cut) and
their edges become preferences of their neighbours; what is left, mostly
nothing, goes through Dinic's algorithm.

Blocks end at block-level tags; white space inside a block, line breaks
included, becomes one space; blocks are joined by one newline, and none
is dropped for its length.

Cases.  Null or empty html, or a page without content: empty text, n_chars 0.
A page cut off in a tag, comment or script: what came before counts; an open
reference at the end stays as written.  Any length: all steps but the cut of
the undecided rest are linear.  Repeated ids: one row each.  Extra
columns are ignored.  Empty table: empty result.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import as_strings, short_batches, slices

TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)"
    r"|<(?P<close>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*+)(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)", re.S)
ATTR = re.compile(r"([A-Za-z][\w:-]*+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
SPACES = re.compile(r"\s+")

#: Elements whose content is no text of the page.
SKIPPED = frozenset("script style template noscript svg math head title iframe object audio video canvas select textarea button".split())
RAW = frozenset("script style textarea title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form
 h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul""".split())
#: Opening one of these ends an open paragraph; opening one of the values' keys ends an open element of its own kind.
ENDS_P = BLOCK - {"body", "html"}
ENDS_OWN = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPE = frozenset("table ul ol dl div section article main body aside nav footer header form blockquote".split())

BAD_TAGS = frozenset("nav aside footer form menu dialog search fieldset".split())
BAD_NAMES = frozenset("""ad ads adv advert advertisement advertising adbox banner breadcrumb breadcrumbs comment comments commentlist consent cookie
 cookies copyright disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification overlay
 pager pagination paywall popup privacy promo promoted promotion recommended related reply replies respond share sharing sidebar signup social
 sponsor sponsored subscribe subscription tags teaser toolbar widget widgets alert""".split())
BAD_ROLES = frozenset("banner navigation contentinfo complementary search form alert dialog menu menubar toolbar".split())
GOOD_TAGS = frozenset("article main".split())
GOOD_NAMES = frozenset("article content post entry story main body text prose".split())

#: Weights of the block classifier (log odds of content).
W_BIAS, W_GOOD, W_BAD, W_WORDS, W_LINKS, W_PARAGRAPH, W_HEADING, W_LIST, W_BARE, W_STOP = -0.6, 4.0, -14.0, 0.45, -4.5, 0.8, 0.3, -0.4, -0.5, 0.4
#: Smoothness of blocks side by side, and of the next one under the same parent.
E_NEXT, E_PARENT = 0.35, 0.5


class Block:
    __slots__ = ("text", "linked", "tag", "good", "bad", "parent")

    def __init__(self, text, linked, tag, good, bad, parent):
        self.text, self.linked, self.tag, self.good, self.bad, self.parent = text, linked, tag, good, bad, parent


def _signs(tag: str, attrs: str, in_article: bool) -> tuple[bool, bool]:
    """Whether an element by itself points to content, to boilerplate."""
    good, bad = tag in GOOD_TAGS, tag in BAD_TAGS or (tag == "header" and not in_article)
    if attrs and not attrs.isspace():
        for m in ATTR.finditer(attrs):
            name, value = m[1].lower(), html.unescape(m[2] or m[3] or m[4] or "")
            if name in ("class", "id"):
                for part in value.split():
                    names = {w.lower() for w in NAME.findall(part)}
                    bad |= bool(names & BAD_NAMES)
                    good |= bool(names & GOOD_NAMES)
            elif name == "role":
                bad |= value.lower() in BAD_ROLES
                good |= value.lower() in ("main", "article")
            elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and "display:none" in value.replace(" ", "").lower():
                bad = True
    return good and not bad, bad


def blocks(page: str) -> list[Block]:
    """The text blocks of a page, in order, outside skipped elements."""
    out: list[Block] = []
    # open elements: (tag, number, good, bad, link, skipped)
    stack: list[tuple[str, int, bool, bool, bool, bool]] = [("", 0, False, False, False, False)]
    parts: list[str] = []
    linked = number = 0
    at, end = 0, len(page)

    def flush():
        nonlocal linked
        if parts:
            text = SPACES.sub(" ", "".join(parts)).strip()
            if text:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in BLOCK or not k:
                        break
                home = stack[k]
                out.append(Block(text, min(linked, len(text)), home[0], home[2], stack[-1][3], stack[k - 1][1] if k else 0))
            parts.clear()
        linked = 0

    def words(raw):
        nonlocal linked
        top = stack[-1]
        if raw and not top[5]:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if top[4]:
                linked += len(text.strip())

    while at < end:
        m = TOKEN.search(page, at)
        if m is None:
            words(page[at:])
            break
        words(page[at: m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["close"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    if any(s[0] in BLOCK for s in stack[k:]):
                        flush()
                    del stack[k:]
                    break
            continue
        if tag == "br" or tag == "hr":
            parts.append(" ")
            if tag == "hr":
                flush()
            continue
        if tag in VOID:
            continue
        if tag in BLOCK:
            flush()
            if tag in ENDS_P:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == "p":
                        del stack[k:]
                        break
                    if stack[k][0] in SCOPE:
                        break
            if tag in ENDS_OWN:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] in ENDS_OWN[tag]:
                        del stack[k:]
                        break
                    if stack[k][0] in SCOPE:
                        break
        if tag == "body":                      # an unclosed head ends here
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "head":
                    del stack[k:]
                    break
        attrs = m["attrs"]
        above = stack[-1]
        good, bad = _signs(tag, attrs, above[2])
        number += 1
        if attrs.endswith("/") and tag in SKIPPED:
            continue
        if tag in RAW:                         # up to its own end tag, whatever stands in between
            close = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(page, at)
            if close is None:
                break
            at = page.find(">", close.end())
            at = end if at < 0 else at + 1
            continue
        stack.append((tag, number, above[2] or good, above[3] or bad, above[4] or tag == "a", above[5] or tag in SKIPPED))
    flush()
    return out


def preference(b: Block) -> float:
    """Log odds that a block is content."""
    n = b.text.count(" ") + 1
    x = W_BIAS + W_WORDS * math.log1p(n) + W_LINKS * b.linked / len(b.text)
    if b.good:
        x += W_GOOD
    if b.bad:
        x += W_BAD
    if b.tag in ("p", "blockquote", "pre"):
        x += W_PARAGRAPH
    elif b.tag[:1] == "h" and b.tag[1:].isdigit():
        x += W_HEADING
    elif b.tag in ("li", "td", "th", "dt", "dd"):
        x += W_LIST
    elif b.tag in ("", "body", "html"):
        x += W_BARE
    if b.text[-1] in ".!?…。\"”":
        x += W_STOP
    return x


def smoothness(found: list[Block]) -> list[tuple[int, int, float]]:
    edges = []
    last: dict[int, int] = {}
    for i, b in enumerate(found):
        near = last.get(b.parent)
        if near is not None:
            edges.append((near, i, E_PARENT))
        if i and near != i - 1:
            edges.append((i - 1, i, E_NEXT))
        last[b.parent] = i
    return edges


def minimum_cut(pref: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """The labelling of least cost: max(0, -pref) for a node called content,
    max(0, pref) for one that is not, and an edge's weight where its ends differ."""
    n = len(pref)
    pref = list(pref)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, w in edges:
        near[i][j] = near[i].get(j, 0.0) + w
        near[j][i] = near[j].get(i, 0.0) + w
    label: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:
        i = todo.popleft()
        if label[i] is None and abs(pref[i]) >= sum(near[i].values()):
            label[i] = pref[i] > 0
            for j, w in near[i].items():
                del near[j][i]
                pref[j] += w if label[i] else -w
                todo.append(j)
            near[i] = {}
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        content = _source_side(rest, pref, near)
        for i in rest:
            label[i] = i in content
    return label                               # type: ignore[return-value]


def _source_side(nodes: list[int], pref: list[float], near: list[dict[int, float]]) -> set[int]:
    """Dinic's algorithm; the nodes that residual capacity reaches from the source."""
    source, sink = -1, -2
    room: dict[int, dict[int, float]] = {v: {} for v in [source, sink, *nodes]}
    for i in nodes:
        for j, w in near[i].items():
            room[i][j] = w
        a, b = (source, i) if pref[i] > 0 else (i, sink)
        room[a][b], room[b][a] = abs(pref[i]), 0.0
    while True:
        level, queue = {source: 0}, deque([source])
        while queue:
            v = queue.popleft()
            for u, c in room[v].items():
                if c > 1e-12 and u not in level:
                    level[u] = level[v] + 1
                    queue.append(u)
        if sink not in level:
            return set(level) - {source}
        ways = {v: iter(room[v]) for v in level}
        path = [source]
        while path:
            v = path[-1]
            if v == sink:
                push = min(room[a][b] for a, b in zip(path, path[1:]))
                for a, b in zip(path, path[1:]):
                    room[a][b] -= push
                    room[b][a] = room[b].get(a, 0.0) + push
                while len(path) > 1 and min(room[a][b] for a, b in zip(path, path[1:])) <= 1e-12:
                    path.pop()
                continue
            for u in ways[v]:
                if room[v][u] > 1e-12 and level.get(u) == level[v] + 1:
                    path.append(u)
                    break
            else:
                path.pop()
                level[v] = -1


def main_text(page: str) -> str:
    found = blocks(page)
    keep = minimum_cut([preference(b) for b in found], smoothness(found))
    return "\n".join(b.text for b, k in zip(found, keep) if k)


def _extracted(batches):
    for batch in batches:
        for part in slices(batch, "html"):
            texts = [main_text(h) for h in as_strings(part.column("html")).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages(page_id, url, html)``."""
    return short_batches(pages).select("page_id", "url", "html").mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
