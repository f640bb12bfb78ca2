"""Main text of web pages through wrappers inferred per host.

A page is read as a tree of block elements (formatting is transparent, scripts,
styles and boilerplate by tag, role or name are left out).  The pages of a host
are aligned one after the other into a wrapper, a union-free expression: each
element has a list of child items, aligned by their keys in order; an item
missing in one page becomes optional, siblings with one key a repeated item,
siblings that change their order a repeated group of optional items, and a text
that differs a slot; of a repeated item's texts those on all pages are kept.  Partial wrappers of tasks are aligned the same way, first
in parts of a host, then per host, so a host that holds a third of all pages is
never in one task; only its small wrappers meet.

The wrapper shows where the varying text of the host is: the article or main
element if it holds most of it, else the deepest element that does.  Of every
page the text below that place is taken: of an article or main element all, else
without the texts at its start and end that the pages of the host share.  A page
that lacks the place, or has no host, is its own wrapper.

Defined cases: a null page is empty; broken markup is read as far as it goes;
pages without text give an empty text; repeated pages are aligned and extracted
each; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import html as entities
import pickle
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import saved, small

#: Parts of a host whose wrappers are aligned apart first; hosts held by a task before it passes them on.
PARTS, HOSTS = 16, 1000
#: Items of an element beyond which the rare ones lose their names; depth below which elements join their parent.
ITEMS, DEPTH = 64, 80
#: Share of the varying text that the main element holds; share of the pages that have a template text; different
#: pages that show what varies (one page can't).
SHARE, SAME, DIFFERENT = 0.5, 0.9, 2
#: Nameless siblings of different shape that are told apart by their number, at most.
NUMBERED = 12

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|</[^>]*(?:>|\Z)|(?P<text>[^<]+|<)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")

# Element names by what HTML makes of them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var".split()
)
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"},
}
CONTAINERS = frozenset("div section center table tbody tr td".split())
HOLDS = frozenset("ul ol dl table tbody thead tfoot select menu article section div main body".split())
# Elements, roles and words of class and id names that mark what is not the article.
BOILERPLATE = frozenset(
    "head nav footer aside form button select dialog menu svg object canvas video audio script style".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion promoted "
    "sidebar rail menu nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar cookie cookies consent "
    "gdpr notice notices notification alert popup modal overlay share sharing social related recommended newsletter "
    "subscribe subscription signup login search toolbar widget widgets pagination pager copyright reply replies respond "
    "responses discussion disqus skip side aside teaser teasers ticker".split()
)
CONTENT = frozenset("article main content post entry story body text".split())
HEADERS = frozenset("header masthead".split())


class Node:
    """An element: key, parts (texts and child elements in page order), text size and link text size."""

    __slots__ = ("key", "tag", "parts", "size", "links")

    def __init__(self, key: str, tag: str):
        self.key, self.tag, self.parts, self.size, self.links = key, tag, [], 0, 0


def _words(name: str) -> set[str]:
    return set(re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()))


def _is_boilerplate(tag: str, attrs: dict[str, str], in_article: bool) -> bool:
    if tag in BOILERPLATE or (tag == "header" and not in_article):
        return True
    if not attrs:
        return False
    if attrs.get("role", "").lower() in ROLES or "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none", attrs.get("style", ""), re.I):
        return True
    names = _words(f"{attrs.get('class', '')} {attrs.get('id', '')}")
    found = {w for w in names if w in NAMES or w.startswith("comment")}
    if in_article:
        found -= HEADERS
    return bool(found) and tag not in ("html", "body") and not (names & CONTENT and not found - {"sidebar", "header"})


def _key(tag: str, attrs: dict[str, str]) -> str:
    if not attrs or tag in ("html", "body"):
        return tag
    names = sorted({re.sub(r"[0-9]+", "", c) for c in attrs.get("class", "").lower().split()} - {""})[:3]
    own = re.sub(r"[0-9]+", "", attrs.get("id", "").lower())
    return tag + "".join("." + c for c in names) + ("#" + own if own else "")


def read_page(page: str) -> Node:
    """The page as a tree, without boilerplate."""
    root = Node("", "")
    # open elements: (tag, node that takes text, in an article); node None: left out
    stack: list[tuple[str, Node | None, bool]] = [("", root, False)]
    link, at = 0, 0

    def close(tags) -> None:
        """Close the nearest open element of ``tags`` unless another block holds it."""
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in tags:
                del stack[k:]
                return
            if stack[k][0] in HOLDS:
                return

    while at < len(page):
        m = TOKEN.match(page, at)
        at = m.end()
        here = stack[-1][1]
        text = m["text"] if m["data"] is None else m["data"]
        if text is not None:
            if here is not None:
                here.parts.append(entities.unescape(text) if m["data"] is None else text)
                if link:
                    here.links += len(text)
            continue
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        if m["end"] or m["end2"]:
            if tag == "a":
                link = 0
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    if tag not in INLINE and stack[k - 1][1] is not None:
                        stack[k - 1][1].parts.append(" ")
                    del stack[k:]
                    break
                if tag in INLINE and stack[k][0] not in INLINE:
                    break
            continue
        if tag in VOID:
            if here is not None and tag not in ("wbr", "input"):
                here.parts.append(" ")
            continue
        attrs = {}
        for name, value in ATTRIBUTE.findall(m["attrs"] or ""):
            attrs.setdefault(name.lower(), entities.unescape(value.strip("\"'")) if value else "")
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag not in INLINE:
            close({"p"} if tag not in CLOSES else CLOSES[tag])
            if tag in CLOSES:
                close({"p"})
            here = stack[-1][1]
        in_article = stack[-1][2] or tag in ("article", "main")
        if here is None or _is_boilerplate(tag, attrs, stack[-1][2]):
            if here is not None and tag not in INLINE:
                here.parts.append(" ")
            stack.append((tag, None, in_article))
        elif tag in INLINE:
            link = link or tag == "a"
            stack.append((tag, here, in_article))
        elif len(stack) > DEPTH:
            here.parts.append(" ")
            stack.append((tag, here, in_article))
        else:
            node = Node(_key(tag, attrs), tag)
            here.parts.append(node)
            stack.append((tag, node, in_article))
    _measure(root)
    return root


def _shape(node: Node) -> frozenset:
    return frozenset(p.tag for p in node.parts if isinstance(p, Node))


def _measure(node: Node) -> None:
    """Sizes; and numbers for siblings that have no name but are not alike (else they are one repeated item)."""
    nameless: dict[str, list[Node]] = {}
    for part in node.parts:
        if isinstance(part, Node) and part.key == part.tag and part.tag in CONTAINERS:
            nameless.setdefault(part.tag, []).append(part)
    for alike in nameless.values():
        if 1 < len(alike) <= NUMBERED and len({_shape(p) for p in alike}) > 1:
            for number, part in enumerate(alike):
                part.key += f":{number}"
    for part in node.parts:
        if isinstance(part, Node):
            _measure(part)
            node.size += part.size
            node.links += part.links
        else:
            node.size += len(part.strip())


def own_text(node: Node) -> str:
    """Text of an element without that of its child elements."""
    return " ".join("".join(p if isinstance(p, str) else " " for p in node.parts).split())


# A wrapper item: [key, pages that have it, repeated, digests of the texts that all of them have there (none: a slot),
# characters, link characters, items, group (0: in order, 1: a repeated group of optional items)].
KEY, SEEN, REPEATED, TEXTS, CHARS, LINKED, CHILDREN, GROUP = range(8)


def _digest(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "replace"))


def page_wrapper(node: Node) -> list:
    """A page's own expression: siblings with one key are folded into a repeated item."""
    own = own_text(node)
    item = [node.key, 1, False, {_digest(own)} if own else set(), node.size, node.links, [], 0]
    before, at = None, {}
    for child in (p for p in node.parts if isinstance(p, Node)):
        new = page_wrapper(child)
        k = at.setdefault(new[KEY], len(item[CHILDREN]))
        if k == len(item[CHILDREN]):
            item[CHILDREN].append(new)
        else:
            if before != new[KEY]:
                item[GROUP] = max(item[GROUP], 1)
            old = item[CHILDREN][k]
            both = old[TEXTS] | new[TEXTS]
            item[CHILDREN][k] = align(old, new)
            item[CHILDREN][k][SEEN], item[CHILDREN][k][REPEATED], item[CHILDREN][k][TEXTS] = 1, True, both
        before = new[KEY]
    return _folded(item)


def _bare(key: str) -> str:
    return re.split(r"[.#:]", key)[0]


#: Ends the key of items whose names are lost; no element of a page has such a key.
LOST = " "


def _folded(item: list) -> list:
    """Beyond ITEMS children, only element names tell the rare ones apart (generated class names don't).
    Article and main elements, and children that most pages have, keep their keys, ITEMS / 2 at most."""
    if len(item[CHILDREN]) <= ITEMS:
        return item

    def rank(c: list) -> tuple:
        return _bare(c[KEY]) not in ("article", "main"), -c[SEEN], -c[CHARS], c[KEY]

    named = [c for c in item[CHILDREN] if not c[KEY].endswith(LOST)]
    common = [c for c in named if _bare(c[KEY]) in ("article", "main") or 2 * c[SEEN] > item[SEEN]]
    own = {c[KEY] for c in sorted(common, key=rank)[:ITEMS // 2]}
    by: dict[str, list] = {}
    for c in item[CHILDREN]:
        if c[KEY] not in own:
            c[KEY] = _bare(c[KEY]).rstrip(LOST) + LOST
        by[c[KEY]] = align(by[c[KEY]], c) if c[KEY] in by else c
        if c[KEY].endswith(LOST):
            by[c[KEY]][REPEATED] = True
    item[CHILDREN], item[GROUP] = list(by.values()), 1
    return item


def align(a: list, b: list) -> list:
    """Two expressions of one element as one: matching items are aligned in order, others become optional."""
    out = [a[KEY], a[SEEN] + b[SEEN], a[REPEATED] or b[REPEATED], a[TEXTS] & b[TEXTS],
           a[CHARS] + b[CHARS], a[LINKED] + b[LINKED], [], max(a[GROUP], b[GROUP])]
    x, y = a[CHILDREN], b[CHILDREN]
    known, where = {c[KEY] for c in x}, {c[KEY]: j for j, c in enumerate(y)}
    done, placed = 0, set()  # items of b up to the last match; items of b that have a place
    for c in x:
        j = where.get(c[KEY])
        if j is None:
            out[CHILDREN].append(c)
            continue
        if j < done:  # the other order: a repeated group of optional items
            out[GROUP] = max(out[GROUP], 1)
        else:
            for k in range(done, j):
                if y[k][KEY] not in known:
                    out[CHILDREN].append(y[k])
                    placed.add(k)
            done = j + 1
        out[CHILDREN].append(align(c, y[j]))
        placed.add(j)
    out[CHILDREN] += [c for k, c in enumerate(y) if k not in placed]
    return _folded(out)


def main_place(wrapper: list, pages: int, different: int) -> tuple[tuple[str, ...], tuple]:
    """Path of the main element; and, unless it is an article or main element, (path, digest) of the texts
    below it that the pages share."""
    def varying(item: list) -> int:
        return max(0, item[CHARS] - 2 * item[LINKED])

    total, best = varying(wrapper), None
    stack = [(wrapper, ())]
    while stack:  # the innermost article, else the innermost main element, that holds most of the text
        item, path = stack.pop()
        tag = _bare(item[KEY])
        if tag in ("article", "main") and varying(item) >= SHARE * total > 0:
            rank = (tag == "article", len(path))
            if best is None or rank > best[0]:
                best = (rank, path, item)
        stack += [(c, path + (c[KEY],)) for c in item[CHILDREN] if not c[KEY].endswith(LOST)]
    if best:
        path, item = best[1], best[2]
    else:
        path, item = (), wrapper
        while True:  # go down as long as one child holds nearly all of the text
            child = max(item[CHILDREN], key=varying, default=None)
            if child is None or varying(child) < 0.8 * varying(item) or child[REPEATED] or child[KEY].endswith(LOST):
                break
            path, item = path + (child[KEY],), child
    same = []
    if not best and different >= DIFFERENT:
        stack = [(item, path)]
        while stack:
            item, path_ = stack.pop()
            for c in item[CHILDREN]:
                if c[KEY].endswith(LOST):
                    continue
                below = path_ + (c[KEY],)
                if not c[CHILDREN] and c[SEEN] >= SAME * pages:
                    same += [(below, d) for d in c[TEXTS]]
                stack.append((c, below))
    return path, tuple(sorted(same))


def text_at(page: Node, place: tuple[str, ...], same: frozenset) -> str | None:
    """Text below a path, blocks joined by one space, without shared texts at its
    start and end; None if the page lacks the path."""
    out: list[str] = []

    def take(node: Node, path: tuple[str, ...], shared: bool, found: list[tuple[str, bool]]) -> None:
        found.append((" ", shared))
        for part in node.parts:
            if isinstance(part, Node):
                below = path + (part.key,)
                take(part, below, shared or bool(same and (below, _digest(own_text(part))) in same), found)
            else:
                found.append((part, shared))
        found.append((" ", shared))

    def find(node: Node, path: tuple[str, ...]) -> bool:
        if path == place:
            found: list[tuple[str, bool]] = []
            take(node, path, False, found)
            own = [k for k, (text, shared) in enumerate(found) if not shared and text.strip()]
            out.extend(text for text, _ in (found[own[0]:own[-1] + 1] if own else []))
            out.append(" ")
            return True
        return any([find(p, path + (p.key,)) for p in node.parts
                    if isinstance(p, Node) and place[len(path)] == p.key])

    return " ".join("".join(out).split()) if find(page, ()) else None


def _host(page_url: str) -> str:
    return rf"lower(regexp_extract({page_url}, '^[^:/?#]+://([^/?#]*)', 1))"


def wrappers(pages: DataFrame) -> DataFrame:
    """host and place: the pickled main place of the host's wrapper."""
    schema = "host string, part int, wrapper binary"

    def pack(host: str, part: int, held: list) -> tuple:
        return host, part, zlib.compress(pickle.dumps(held), 1)

    def together(held: list | None, more: list) -> list:
        if held is None:
            return more
        return [align(held[0], more[0]), held[1] + more[1], sorted({*held[2], *more[2]})[:DIFFERENT]]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], list] = {}

        def flush() -> pa.RecordBatch:
            rows = [pack(*k, v) for k, v in sorted(held.items())]
            held.clear()
            cols = list(zip(*rows)) or [()] * 3
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.binary()))],
                names=["host", "part", "wrapper"])

        for batch in batches:
            for host, part, page in zip(*(batch.column(c).to_pylist() for c in ("host", "part", "html"))):
                node = read_page(page)
                text = text_at(node, (), frozenset()) or ""
                held[host, part] = together(
                    held.get((host, part)), [page_wrapper(node), 1, [_digest(text)]])
                if len(held) >= HOSTS:
                    yield flush()
        yield flush()

    def merge(key, rows):
        import pandas as pd

        held = None
        for w in sorted(rows["wrapper"]):
            held = together(held, pickle.loads(zlib.decompress(w)))
        return pd.DataFrame([pack(key[0], int(key[1]) if len(key) > 1 else 0, held)], columns=["host", "part", "wrapper"])

    def settle(key, rows):
        import pandas as pd

        merged = merge(key, rows)["wrapper"][0]
        wrapper, n, different = pickle.loads(zlib.decompress(merged))
        return pd.DataFrame([(key[0], pickle.dumps(main_place(wrapper, n, len(different))))], columns=["host", "place"])

    # parts by the page's content, so that the wrappers do not depend on how the input is split
    rows = pages.where("host <> ''").select("host", F.pmod(F.xxhash64("html"), F.lit(PARTS)).cast("int").alias("part"), "html")
    partial = saved(rows.mapInArrow(read, schema), "wrappers")
    merged = partial.groupBy("host", "part").applyInPandas(merge, schema)
    return merged.groupBy("host").applyInPandas(settle, "host string, place binary")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and the main text of every page."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("host", F.coalesce(F.expr(_host("url")), F.lit("")))
    places = small(wrappers(rows), "places")
    schema = rows.select("page_id", "url", F.lit("").alias("text")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple] = {}
        for batch in batches:
            texts = []
            for page, place in zip(batch.column("html").to_pylist(), batch.column("place").to_pylist()):
                node, text = read_page(page), None
                if place is not None:
                    if place not in known:
                        if len(known) >= HOSTS:
                            known.clear()
                        path, same = pickle.loads(place)
                        known[place] = (path, frozenset(same))
                    text = text_at(node, *known[place])
                if text is None:
                    text = text_at(node, main_place(page_wrapper(node), 1, 1)[0], frozenset())
                texts.append(text or "")
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return rows.join(places, "host", "left").select("page_id", "url", "html", "place").mapInArrow(run, schema)
