"""Main text of web pages by wrappers: union-free regular expressions inferred from the pages of a host."""

from __future__ import annotations

import html
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketspark.llm.common import groups_for, prepare, stage

# HTML element classes and words by which sites name their page parts.
RAW = "script|style|noscript|template|svg|iframe|object|textarea|select|title"
LEAVES = frozenset("p li h1 h2 h3 h4 h5 h6 td th tr dt dd caption figcaption summary hr".split())
CONTAINERS = frozenset("html head body main article section div header footer nav aside form fieldset ul ol dl table "
                       "thead tbody tfoot blockquote pre figure details address dialog center menu".split())
DROPPED = frozenset("head nav footer aside form fieldset button label dialog menu".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu".split())
SIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent "
    "gdpr notice notices notification popup modal overlay newsletter subscribe subscription signup login menu nav "
    "navbar navigation breadcrumb breadcrumbs sidebar widget widgets footer header masthead social share sharing "
    "related recommended recommendations toc pagination pager copyright disclaimer skip search hidden".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
COMMENT_WORDS = frozenset("comment comments commentlist reply replies disqus respond responses".split())
MAIN_WORDS = frozenset("article content post entry story main".split())

#: The longest group of tokens tried as a repeated unit.
LONGEST_UNIT = 64
#: Skeletons merged in one task before their wrapper meets the others of the host.
FAN_IN = 128

_TAG = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*+>.*?(?:</\1\s*+>|\Z)|<[!?][^>]*+>|"
    r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:\"[^\"]*+\"|'[^']*+'|[^'\">])*+)>", re.S | re.I)
_ATTR = re.compile(r"""(class|id|role|style|hidden|aria-hidden)\b(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]++))?""", re.I)
_WORD = re.compile(r"[a-z]+")


def _marks(tag: str, attrs: str) -> tuple[str, bool, bool]:
    """(class words, whether the element is beside the article, whether it is named as the article)."""
    if not attrs or attrs.isspace():
        return "", False, False
    found = {k.lower(): (v or "").strip("\"'").lower() for k, v in _ATTR.findall(attrs)}
    words = _WORD.findall(found.get("class", "") + " " + found.get("id", ""))
    side = (not COMMENT_WORDS.isdisjoint(words) or "hidden" in found or found.get("aria-hidden") == "true"
            or "display:none" in found.get("style", "").replace(" ", "") or found.get("role") in ROLES)
    if tag in ("html", "body", "main"):
        side = False
    elif tag != "article":
        side = side or not SIDE_WORDS.isdisjoint(words)
    return ".".join(words), side, found.get("role") == "main" or (
        tag in ("div", "section") and not MAIN_WORDS.isdisjoint(words))


def page_tokens(page: str) -> tuple[list[str], list[tuple[str, str, float]]]:
    """(tokens, texts): block tags in page order with "#" for each text, and (text, role, share of links) of each "#".

    Tags carry their classes, leaves also their container, so that only parts in like places align. Role is "side" within menus, forms, comments and the like, "main" within an article, else "".
    """
    tokens: list[str] = []
    texts: list[tuple[str, str, float]] = []
    stack: list[tuple[str, str, str]] = []  # (tag, role, label) of open containers and leaves
    parts: list[str] = []
    linked, in_link, skip = 0, 0, []       # skip: open inline elements whose text goes

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                tokens.append("#")
                texts.append((text, stack[-1][1] if stack else "", min(1.0, linked / len(text))))
        parts, linked = [], 0

    def text(raw: str) -> None:
        nonlocal linked
        if not skip:
            parts.append(raw)
            if in_link:
                linked += len(raw)

    at = 0
    for m in _TAG.finditer(page):
        if m.start() > at:
            text(page[at:m.start()])
        at = m.end()
        if not m[3]:
            continue
        tag, closing = m[3].lower(), m[2]
        if tag in LEAVES or tag in CONTAINERS:
            flush()
            skip = []
            if closing:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        if tag in CONTAINERS:
                            tokens.append("/" + stack[i][2])
                        del stack[i:]
                        break
                    if tag in LEAVES and stack[i][0] in CONTAINERS:
                        break
                continue
            while stack and stack[-1][0] in LEAVES and not (tag in CONTAINERS and stack[-1][0] in ("li", "td", "th", "dd")):
                stack.pop()
            words, side, main = _marks(tag, m[4])
            role = stack[-1][1] if stack else ""
            if side or tag in DROPPED or (tag == "header" and role != "main"):
                role = "side"
            elif role == "" and (main or tag in ("article", "main")):
                role = "main"
            label = f"{tag}.{words}" if words else tag
            if tag in LEAVES:
                label += "<" + next((x[2] for x in reversed(stack) if x[0] in CONTAINERS), "")
            if tag != "hr":
                stack.append((tag, role, label))
            tokens.append(label)
        elif tag in VOID:
            if tag == "br":
                text(" ")
        elif closing:
            if tag == "a":
                in_link = 0
            if skip and tag == skip[-1]:
                skip.pop()
        else:
            if tag == "a":
                in_link = 1
            if tag in DROPPED or (m[4] and _marks(tag, m[4])[1]):
                skip.append(tag)
    if at < len(page):
        text(page[at:])
    flush()
    return tokens, texts


class Node:
    """A token, or a repeated group of nodes; ``at`` lists the page tokens it stands for."""

    __slots__ = ("sym", "kids", "at")

    def __init__(self, sym: str, kids: list[Node] | None = None, at: list[int] | None = None):
        self.sym, self.kids, self.at = sym, kids, at or []

    def absorb(self, other: Node) -> None:
        self.at += other.at
        for mine, theirs in zip(self.kids or (), other.kids or (), strict=True):
            mine.absorb(theirs)


def fold(tokens: list[str]) -> list[Node]:
    """Tokens with adjacent repeats of a unit replaced by one repeated group, shortest units first."""
    seq = [Node(t, None, [i]) for i, t in enumerate(tokens)]
    ids: dict[str, int] = {}
    length = 1
    codes = np.array([ids.setdefault(n.sym, len(ids)) for n in seq], dtype=np.int64)
    while length <= min(LONGEST_UNIT, len(seq) // 2):
        same = codes[:-length] == codes[length:]
        edge = np.flatnonzero(np.diff(np.r_[0, same.astype(np.int8), 0]))
        runs = [(lo, hi) for lo, hi in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)
                if hi - lo >= length and (length > 1 or seq[lo].sym != "#")]
        out, done, changed = [], 0, False
        for lo, hi in runs:
            # Units start at a tag, so "li #" is found rather than "# li".
            while lo < hi and (seq[lo].sym == "#" or seq[lo].sym[0] == "/"):
                lo += 1
            lo = max(lo, done)
            times = (hi + length - lo) // length
            if times < 2:
                continue
            out += seq[done:lo]
            unit = seq[lo:lo + length]
            for k in range(1, times):
                for mine, theirs in zip(unit, seq[lo + k * length:lo + (k + 1) * length], strict=True):
                    mine.absorb(theirs)
            if len(unit) == 1 and unit[0].kids:
                out.append(unit[0])
            else:
                out.append(Node("(" + " ".join(n.sym for n in unit) + ")+", unit))
            done, changed = lo + times * length, True
        if changed:
            seq = out + seq[done:]
            codes = np.array([ids.setdefault(n.sym, len(ids)) for n in seq], dtype=np.int64)
            length = 1
        else:
            length += 1
    return seq


# A wrapper is a list of elements [symbol, optional, kids or None, stats or None]. Slots ("#") carry the stats
# [texts, characters, characters in links, texts beside the article, texts in the article, one text's hash or None].

def wrapper_of(seq: list[Node], texts: list[tuple[str, str, float]], tokens: list[str]) -> list:
    slot = {t: i for i, t in enumerate(k for k, s in enumerate(tokens) if s == "#")}

    def build(nodes: list[Node]) -> list:
        out = []
        for n in nodes:
            if n.kids:
                out.append(["+", False, build(n.kids), None])
            elif n.sym == "#":
                own = [texts[slot[t]] for t in n.at]
                hashes = {zlib.crc32(x[0].encode("utf-8", "surrogatepass")) for x in own}
                out.append(["#", False, None, [
                    len(own), sum(len(x[0]) for x in own), round(sum(len(x[0]) * x[2] for x in own)),
                    sum(x[1] == "side" for x in own), sum(x[1] == "main" for x in own),
                    hashes.pop() if len(hashes) == 1 else None]])
            else:
                out.append([n.sym, False, None, None])
        return out

    return build(seq)


def _head(element: list) -> str:
    """What two elements must share to align: the tag, "#", or the first tag of a repeated group."""
    return "+" + _head(element[2][0]) if element[2] else element[0]


def _repeats(a: list, b: list) -> list:
    """``b`` with single occurrences of the repeated groups of ``a`` marked as repeated too."""
    units = {}
    for e in a:
        if e[2]:
            units.setdefault(tuple(_head(x) for x in e[2]), None)
    for unit in sorted(units, key=len, reverse=True):
        heads, out, i = [_head(e) for e in b], [], 0
        while i < len(b):
            if tuple(heads[i:i + len(unit)]) == unit and (len(unit) > 1 or not b[i][2]):
                out.append(["+", any(e[1] for e in b[i:i + len(unit)]), b[i:i + len(unit)], None])
                i += len(unit)
            else:
                out.append(b[i])
                i += 1
        b = out
    return b


def matched(a: list, b: list) -> list[tuple[int, int]]:
    """Pairs of positions that align: a longest common subsequence that prefers tags to texts."""
    ha, hb = [_head(e) for e in a], [_head(e) for e in b]
    lo = 0
    while lo < min(len(a), len(b)) and ha[lo] == hb[lo]:
        lo += 1
    end = 0
    while end < min(len(a), len(b)) - lo and ha[-1 - end] == hb[-1 - end]:
        end += 1
    xa, xb = ha[lo:len(a) - end], hb[lo:len(b) - end]
    best = [[0] * (len(xb) + 1) for _ in range(len(xa) + 1)]
    for i in range(len(xa) - 1, -1, -1):
        row, below, x = best[i], best[i + 1], xa[i]
        gain = 1 if x == "#" else 3
        for j in range(len(xb) - 1, -1, -1):
            row[j] = below[j + 1] + gain if x == xb[j] else max(below[j], row[j + 1])
    pairs, i, j = [(k, k) for k in range(lo)], 0, 0
    while i < len(xa) and j < len(xb):
        if xa[i] == xb[j]:
            pairs.append((lo + i, lo + j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return pairs + [(len(a) - k, len(b) - k) for k in range(end, 0, -1)]


def _add(s: list, t: list) -> list:
    return [x + y for x, y in zip(s[:5], t[:5], strict=True)] + [s[5] if s[5] == t[5] else None]


def align(a: list, b: list) -> list:
    """The most specific wrapper of both: mismatches become optional parts, groups repeated in one are repeated."""
    a, b = _repeats(b, a), _repeats(a, b)
    out, i, j = [], 0, 0
    for x, y in [*matched(a, b), (len(a), len(b))]:
        out += [[e[0], True, e[2], e[3]] for e in a[i:x]] + [[e[0], True, e[2], e[3]] for e in b[j:y]]
        if x < len(a):
            e, f = a[x], b[y]
            kids = align(e[2], f[2]) if e[2] else None
            out.append([e[0], e[1] or f[1], kids, _add(e[3], f[3]) if e[3] else None])
        i, j = x + 1, y + 1
    return out


def slots(wrapper: list) -> list[list]:
    out = []
    for e in wrapper:
        out += slots(e[2]) if e[2] else [e[3]] if e[0] == "#" else []
    return out


def chosen(wrapper: list) -> list[bool]:
    """For each slot, whether its texts belong to the article.

    A slot mostly beside the article never does. If the host marks articles, the slots inside do. Otherwise those do
    that hold little link text and whose text differs between pages.
    """
    stats = slots(wrapper)
    marked = any(s[4] * 2 > s[0] for s in stats)
    if marked:
        return [s[4] * 2 > s[0] for s in stats]
    return [s[3] * 2 <= s[0] and s[2] * 2 < s[1] and (s[0] < 3 or s[5] is None) for s in stats]


def _positions(element_list: list, start: int = 0) -> list[tuple[int, int]]:
    """(first slot number, slots) of each element."""
    out = []
    for e in element_list:
        n = len(slots(e[2])) if e[2] else int(e[0] == "#")
        out.append((start, n))
        start += n
    return out


def slot_map(wrapper: list, page: list) -> dict[int, int]:
    """Slot of the page's own wrapper -> slot of the host's wrapper."""
    page = _repeats(wrapper, page)
    pw, pp = _positions(wrapper), _positions(page)
    out = {}
    for x, y in matched(wrapper, page):
        if wrapper[x][2]:
            out.update({pp[y][0] + k: pw[x][0] + v for k, v in slot_map(wrapper[x][2], page[y][2]).items()})
        elif wrapper[x][0] == "#":
            out[pp[y][0]] = pw[x][0]
    return out


def _leaf_slots(seq: list[Node], tokens: list[str]) -> list[int]:
    """For each text of the page, the slot of the page's own wrapper."""
    slot, of = -1, {}
    stack = list(reversed(seq))
    while stack:
        n = stack.pop()
        if n.kids:
            stack += reversed(n.kids)
        elif n.sym == "#":
            slot += 1
            of.update(dict.fromkeys(n.at, slot))
    return [of[i] for i, t in enumerate(tokens) if t == "#"]


def extract(page: str, wrapper: list | None, cache: dict) -> str:
    """The article's blocks joined by line feeds; a page that fits no content slot falls back on its own marks."""
    tokens, texts = page_tokens(page)
    if not texts:
        return ""
    seq = fold(tokens)
    own = _leaf_slots(seq, tokens)
    keep: list[bool] = [False] * len(texts)
    if wrapper:
        shape = " ".join(n.sym for n in seq)
        if shape not in cache:
            good = chosen(wrapper)
            cache[shape] = {k for k, v in slot_map(wrapper, wrapper_of(seq, texts, tokens)).items() if good[v]}
        # The page's own marks win where a slot mixes places.
        keep = [s in cache[shape] and t[1] != "side" for s, t in zip(own, texts, strict=True)]
    if not any(keep) or any(t[1] == "main" for t in texts):
        keep = [k or t[1] == "main" for k, t in zip(keep, texts, strict=True)]
    if not any(keep):
        keep = [t[1] != "side" and t[2] < 0.5 for t in texts]
    return "\n".join(t[0] for t, k in zip(texts, keep, strict=True) if k)


def host_of(url: str = "url"):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^\w+://([^/:?#]+)", 1))


def _shape(wrapper: list) -> str:
    return " ".join(("(" + _shape(e[2]) + ")+" if e[2] else e[0]) + ("?" if e[1] else "") for e in wrapper)


def infer(pages: DataFrame) -> DataFrame:
    """(host, wrapper): one wrapper a host from (host, html), as JSON.

    Pages first fold to skeletons; equal ones meet per task, then per host, so copies cost one row. Skeletons of a
    host are merged at most ``FAN_IN`` at a time, and the wrappers again, until one is left.
    """

    def skeletons(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            met: dict[tuple[str, str], list] = {}
            for host, page in zip(part["host"], part["html"], strict=True):
                tokens, texts = page_tokens(page)
                own = wrapper_of(fold(tokens), texts, tokens)
                key = (host, _shape(own))
                met[key] = align(met[key], own) if key in met else own
            yield pd.DataFrame([(h, s, json.dumps(w)) for (h, s), w in met.items()],
                               columns=["host", "shape", "wrapper"])

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("shape")
        one = json.loads(part["wrapper"].iloc[0])
        for other in part["wrapper"].iloc[1:]:
            one = align(one, json.loads(other))
        return pd.DataFrame({"host": [part["host"].iloc[0]], "shape": [_shape(one)], "wrapper": [json.dumps(one)]})

    kind = "host string, shape string, wrapper string"
    found = stage(pages.mapInPandas(skeletons, kind), "skeletons")
    while True:
        most = found.groupBy("host").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            return found.select("host", "wrapper")
        salt = F.pmod(F.xxhash64("shape", "wrapper"), F.lit(groups_for(most, FAN_IN)))
        found = stage(found.groupBy("host", salt.alias("salt")).applyInPandas(merge, kind), "wrappers")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id_col, url_col, text, n_chars) for every row.

    NULL or empty html gives an empty text; a NULL address counts as a host of its own. Repeated rows stay repeated,
    an empty table gives no rows, other columns are ignored. Pages of any length are read whole.
    """
    prepare(pages.sparkSession)
    slim = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host_of(url_col).alias("host"),
                        F.coalesce(html_col, F.lit("")).alias("html"))
    wrappers = infer(slim.select("host", "html"))
    kind = slim.schema["id"].dataType.simpleString()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, tuple[list, dict]] = {}
        for part in parts:
            out = []
            for page, text in zip(part["html"], part["wrapper"], strict=True):
                if text is None:
                    out.append(extract(page, None, {}))
                    continue
                if text not in held:
                    if len(held) > 2000:
                        held.clear()
                    held[text] = (json.loads(text), {})
                wrapper, cache = held[text]
                if len(cache) > 5000:
                    cache.clear()
                out.append(extract(page, wrapper, cache))
            yield pd.DataFrame({"id": part["id"], "url": part["url"], "text": out, "n_chars": [len(t) for t in out]})

    joined = slim.join(wrappers, "host", "left").select("id", "url", "html", "wrapper")
    return joined.mapInPandas(run, f"id {kind}, url string, text string, n_chars long").withColumnsRenamed(
        {"id": id_col, "url": url_col})
