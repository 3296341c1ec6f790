"""Main text of web pages by wrappers inferred per host.

The pages of a host are made by few templates. A page is a stream of tags and texts; two streams of a
host are aligned, and what does not match becomes an optional group, a repeated group or, for texts, a
slot. The result is a union-free regular expression over tags, the host's wrapper; it is aligned with
the next page until all have been seen. Wrappers of parts of a host align like pages do, so every task
folds its own pages into one wrapper per host, and only those are shuffled and folded again.

Pages with an article element and pages without one are told apart first: a host that has both has one
expression for each.

A wrapper tells what one page cannot: which texts may be the same on every page and which groups hold links
only. It is matched with each page twice: to count the different pages that have each such text, over all pages of
the host, and to say which of the page's texts are the article.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape
from itertools import count
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from footfall.llm.common import ship_by_value
from footfall.operators.joins import join_per_key
from footfall.sources.storage import materialise

ship_by_value(__name__)

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = re.compile(r"</(script|style|textarea|title|xmp|iframe|noembed|noframes)[\s/>]", re.I)
RAW_TAGS = set("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre search section summary table tbody "
    "td tfoot th thead tr ul".split()
)
#: Elements that an opening tag closes, and the elements the search for them does not leave.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "option": ({"option"}, {"select"}),
}
P_ENDS = BLOCKS - {"body", "html", "caption", "dd", "dt", "li", "tbody", "td", "tfoot", "th", "thead", "tr"}
P_CLOSES = ({"p"}, {"table", "td", "th", "li", "button"})
#: Elements that are no part of an article wherever they are.
NEVER = set("aside button dialog footer form head iframe input menu nav noscript option script search select style svg template textarea title".split())
#: Of these, what does not enclose an article either: some sites put the whole page in a form.
NEVER_AROUND = NEVER - {"form"}
#: Words of a class, id or role that mark such parts.
HINTS = set(
    "ad ads adsbox advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent "
    "cookie cookies dialog disqus footer login menu modal nav navbar navigation newsletter notice notices "
    "popup promo promoted promotion related replies responses share sharing sidebar signup social sponsor sponsored subscribe "
    "subscription toolbar usercomments widget widgets".split()
)
#: Words after a hint that name its box or its place, those that do so after a hint alone, and those with which
#: a name tells of the layout of an element that has more than such a part.
HOLDERS = set("area bar block body bottom box button buttons container form frame holder icons inner item items left link links list panel posts right section slot text thread top unit".split())
WRAPS = {"wrap", "wrapper"}
LAYOUT = set("has layout no with without".split())
MAIN = {"article", "main"}
#: Keys of the two kinds of pages, and of the wrapper of a host that has both.
PLAIN, NAMED, KINDS = "", "NAMED", "KINDS"
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
#: More different children than this, and a wrapper's node knows those that are not the template's by their
#: tag, whether they are left out and whether they are links only: the last two as words no class can be.
MOST_CHILDREN = 200
OUT, LINKS = "OUT", "LINKS"
#: Such a word too: the element would be left out, but the page's article is in it.
AROUND = "AROUND"
LONGEST_GROUP = 4
#: Hashes of pages that an element of a wrapper keeps. ``extract`` counts all pages instead; they order the children
#: of an element that has too many, and judge where there is no more than the wrapper.
SAMPLE = 64
#: A text on so large a part of the different pages is the template's.
NEARLY_ALL = 0.9
#: Stands for a page itself among the places of its texts.
PAGE = -1
#: Texts of elements nested deeper belong to the element at this depth, as browsers have it at some depth too;
#: an article there, and what is left out, has its own texts.
DEEPEST = 120


# -- pages as trees: a node is [key, children], a child a node or a text ------------------------------

def _key(tag: str, attributes: str) -> str:
    """The tag, and its class, id and role without digits: template, not instance."""
    if "=" not in attributes:
        return tag
    found = NAMES.findall(attributes)
    words = {re.sub(r"\d+", "0", w.lower()) for _, *values in found for v in values for w in v.split()}
    return " ".join([tag, *sorted(words)])


def parse(html: str) -> list:
    """A forgiving parser: open elements are closed as HTML closes them, stray end tags are ignored."""
    root: list = ["", []]
    stack = [root]
    places: dict[str, list[int]] = {}  # of the open elements of a tag in the stack
    own: list[tuple[int, bool]] = []  # places of the deep elements with texts of their own; is it an article?

    def last(tags) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def close(k: int) -> None:
        while len(stack) > k:
            _, children, tag = stack.pop()
            places[tag].pop()
            if len(stack) >= DEEPEST and tag in BLOCKS:
                children.append([tag, [], tag])  # the end of the block
        while own and own[-1][0] >= k:
            own.pop()

    at, end = 0, len(html)
    while at < end:
        m = TOKEN.search(html, at)
        if m is None:
            stack[-1][1].append(html[at:])
            break
        if m.start() > at:
            stack[-1][1].append(html[at:m.start()])
        at = m.end()
        closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            k = last((tag,))
            # an end tag inside an article does not end the article
            if k and (tag in MAIN or tag in ("body", "html") or k > last(MAIN)):
                close(k)
            continue
        for tags, fence in ([P_CLOSES] if tag in P_ENDS else []) + ([CLOSES[tag]] if tag in CLOSES else []):
            if last(tags) > last(fence):
                close(last(tags))
        node = [_key(tag, attributes), [], tag]
        stack[-1][1].append(node)
        if tag in RAW_TAGS:
            stop = RAW.search(html, at)
            while stop and stop[1].lower() != tag:
                stop = RAW.search(html, stop.end())
            at = stop.start() if stop else end
        if tag not in VOID and not attributes.endswith("/"):
            if len(stack) >= DEEPEST:
                article = tag in MAIN
                if not any(a for _, a in own) if article else _left_out(node[0]) and (not own or own[-1][1]):
                    own.append((len(stack), article))
                else:
                    node = [node[0], stack[-1][1], tag]
            places.setdefault(tag, []).append(len(stack))
            stack.append(node)
    named = _has_main(root)
    _let_in(root, {"main"} if named else MAIN)
    root[0] = NAMED if named or _has_main(root) else PLAIN
    return root


def _has_main(node: list) -> bool:
    """An article element is below, outside of what is left out."""
    return any(c[2] in MAIN or not _left_out(c[0]) and _has_main(c) for c in node[1] if not isinstance(c, str))


def _let_in(node: list, tags: set) -> None:
    """Marks what encloses a main element, or the articles if none is elsewhere: comments and teasers may
    be article elements, too. Elements that are never part of an article stay out, but for forms."""
    for c in node[1]:
        if isinstance(c, str):
            continue
        if _left_out(c[0]):
            if c[2] in NEVER_AROUND or not _encloses(c, tags):
                continue
            c[0] = f"{c[0]} {AROUND}"
        _let_in(c, tags)


def _encloses(node: list, tags: set) -> bool:
    return any(c[2] in tags or c[2] not in NEVER_AROUND and _encloses(c, tags) for c in node[1] if not isinstance(c, str))


# -- wrappers: [key, optional, repeated, text, children, pages]; text is None, a hash or "*" ----------
# ``pages``: hashes of the pages that had this one text, the SAMPLE smallest: a union of such lists is the list
# of the union, however pages were dealt to tasks, and equal pages count once. The root has one more element,
# the same of all pages. Pages with an article element need neither.
# A group of several elements that repeats has the key "(" and its elements as children. The wrapper of
# pages of both kinds has the key KINDS and one wrapper of each kind as children.

def wrapper_of(page: list) -> list:
    """The expression of one page: texts as hashes, equal neighbours as repeated groups."""
    pages = [] if page[0] == NAMED else [_page_hash(page)]

    def walk(node: list) -> list:
        text = _own_text(node)
        children = [walk(c) for c in node[1] if not isinstance(c, str)]
        return [node[0], 0, 0, crc32(text.encode()) if text else None, fold(children), pages if text else []]

    return [*walk(page), pages]


def _own_text(node: list) -> str:
    return " ".join(" ".join(c.split()) for c in node[1] if isinstance(c, str)).strip()


def _content(node: list) -> str:
    """The texts below, other than in what is left out: pages that differ elsewhere only are one page."""
    below = (_content(c) for c in node[1] if not isinstance(c, str) and not _left_out(c[0]))
    return "\n".join(t for t in (_own_text(node), *below) if t)


def _page_hash(page: list) -> int:
    return int.from_bytes(blake2b(_content(page).encode(), digest_size=6).digest())


def _union(a: list, b: list) -> list:
    return a if a == b else sorted({*a, *b})[:SAMPLE]


def _shape(w: list) -> str:
    return w[0] if w[0] != "(" else "(" + ",".join(c[0] for c in w[4])


def align(a: list, b: list) -> list:
    """One expression for what either matches; the two have the same key or are wrappers."""
    if a[0] != b[0] or a[0] == KINDS:
        kinds: dict[str, list] = {}
        for w in (y for x in (a, b) for y in (x[4] if x[0] == KINDS else [x])):
            kinds[w[0]] = align(kinds[w[0]], w) if w[0] in kinds else w
        return [KINDS, 0, 0, None, [kinds[k] for k in sorted(kinds)], []]
    text = a[3] if b[3] is None or a[3] == b[3] else b[3] if a[3] is None else "*"
    lists = [_union(x, y) for x, y in zip(a[5:], b[5:])]
    if text == "*":
        lists[0] = []
    return [a[0], a[1] | b[1], a[2] | b[2], text, fold(_align_lists(a[4], b[4])), *lists]


def _optional(w: list) -> list:
    return [w[0], 1, *w[2:]]


def _align_lists(a: list, b: list) -> list:
    """Longest common subsequence by shape; what one side lacks is optional."""
    if [_shape(x) for x in a] == [_shape(x) for x in b]:
        return [align(x, y) for x, y in zip(a, b)]
    p, q = [_shape(x) for x in a], [_shape(x) for x in b]
    best = [[0] * (len(q) + 1) for _ in range(len(p) + 1)]
    for i in range(len(p) - 1, -1, -1):
        for j in range(len(q) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if p[i] == q[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(p) and j < len(q):
        if p[i] == q[j]:
            out.append(align(a[i], b[j]))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            out.append(_optional(a[i]))
            i += 1
        else:
            out.append(_optional(b[j]))
            j += 1
    return out + [_optional(x) for x in a[i:]] + [_optional(x) for x in b[j:]]


def fold(items: list) -> list:
    """Neighbours of the same shape, alone or in groups of up to four, become one that repeats."""
    for size in range(1, LONGEST_GROUP + 1):
        out: list = []
        for item in items:
            out.append(item)
            if len(out) >= 2 * size and [_shape(x) for x in out[-size:]] == [_shape(x) for x in out[-2 * size:-size]]:
                last, before = out[-size:], out[-2 * size:-size]
                both = [align(x, y) for x, y in zip(before, last)]
                del out[-2 * size:]
                out.append([both[0][0], both[0][1], 1, *both[0][3:]] if size == 1 else ["(", 0, 1, None, both, []])
            elif size > 1 and len(out) > size and out[-size - 1][0] == "(" and [_shape(x) for x in out[-size - 1][4]] == [_shape(x) for x in out[-size:]]:
                group = out[-size - 1]
                group = [*group[:4], [align(x, y) for x, y in zip(group[4], out[-size:])], []]
                del out[-size - 1:]
                out.append(group)
        items = out
    return _merged(items) if len(items) > MOST_CHILDREN else items


def _merged(items: list) -> list:
    """One element per key; if these are still too many, the rare ones by what decides on them."""
    keys: dict[str, list] = {}
    for x in _elements(items):
        x = [x[0], 1, 1, *x[3:]]
        keys[x[0]] = align(keys[x[0]], x) if x[0] in keys else x
    if len(keys) <= MOST_CHILDREN:
        return list(keys.values())
    # texts that several pages share are the template's: they are kept apart, so that they stay the same
    seen = {key: _most_pages(x) for key, x in keys.items()}
    shared = sorted((key for key in seen if seen[key] > 1), key=lambda key: (-seen[key], key))[:MOST_CHILDREN // 2]
    plain: dict[str, list] = {key: keys.pop(key) for key in shared}
    for key, x in keys.items():
        key = _sort_of(key, _only_links(x))
        plain[key] = align(plain[key], [key, *x[1:]]) if key in plain else [key, *x[1:]]
    return list(plain.values())


def _most_pages(w: list) -> int:
    return max(len(w[5]), *map(_most_pages, w[4]), 0)


def _sort_of(key: str, links: bool) -> str:
    """The key of many different elements that are decided alike."""
    tag, *names = key.split(" ")
    if AROUND in names:
        return f"{tag} {AROUND}"
    return f"{tag} {OUT}" if _left_out(key) else f"{tag} {LINKS}" if links else tag


def _elements(items: list) -> Iterator[list]:
    """The elements of a list, those of groups and of groups in groups as well."""
    for x in items:
        if x[0] == "(":
            yield from _elements(x[4])
        else:
            yield x


# -- what is the article ------------------------------------------------------------------------------

def _left_out(key: str) -> bool:
    tag, *names = key.split(" ")
    if AROUND in names:
        return False
    if tag in NEVER or OUT in names:
        return True
    if tag in MAIN or tag in ("body", "html"):
        return False
    return any(map(_is_hint, names))


def _is_hint(name: str) -> bool:
    """A hint as a whole or as the last part, words for its box and numbers aside."""
    parts = [part for part in re.split(r"[-_:]+", name) if part not in ("", "0")]
    if not HINTS.intersection(parts) or LAYOUT.intersection(parts):
        return False
    wrapped = False
    while len(parts) > 1 and (parts[-1] in HOLDERS or parts[-1] in WRAPS):
        wrapped |= parts.pop() in WRAPS
    return parts[-1] in HINTS and (len(parts) == 1 or not wrapped)


def _only_links(w: list) -> bool:
    """All texts below are inside links."""
    if w[0].split(" ")[0] == "a":
        return True
    return w[3] is None and bool(w[4]) and all(_only_links(c) for c in w[4])


def _only_links_here(node: list) -> bool:
    """The same of an element of a page."""
    if node[2] == "a":
        return True
    return bool(node[1]) and not _own_text(node) and all(_only_links_here(c) for c in node[1] if not isinstance(c, str))


def _grouped(same: list, numbers: Iterator[int]) -> list:
    """Elements of one key below elements of one key are decided together: [number, elements, {key: group}]."""
    number = next(numbers)
    groups: dict[str, list] = {}
    for c in (y for n in same for y in _elements(n[4])):
        groups.setdefault(c[0], []).append(c)
    return [number, same, {key: _grouped(group, numbers) for key, group in groups.items()}]


def _kinds(w: list) -> list:
    return w[4] if w[0] == KINDS else [w]


def _constant(same: list) -> set:
    """The texts of these elements, none if one of them varies."""
    texts = {c[3] for c in same} - {None}
    return set() if "*" in texts else texts


def _place(number: int, text: int) -> int:
    return number << 32 | text


def constants(w: list) -> list | None:
    """What may be the same on the pages without an article element, None if the host has no such page: per group
    [number, texts, {key: group}]."""
    def walk(group: list) -> list:
        number, same, below = group
        return [number, _constant(same), {key: walk(g) for key, g in below.items() if not _left_out(key)}]

    return next((walk(_grouped([kind], count())) for kind in _kinds(w) if kind[0] == PLAIN), None)


def places_of(page: list, groups: list) -> list[int]:
    """Where the page has one of these texts, and PAGE."""
    found = {PAGE}

    def walk(node: list, group: list) -> None:
        number, texts, below = group
        text = _own_text(node)
        if text and crc32(text.encode()) in texts:
            found.add(_place(number, crc32(text.encode())))
        for c in node[1]:
            if isinstance(c, str) or _left_out(c[0]):
                continue
            mine = below.get(c[0]) or below.get(_sort_of(c[0], _only_links_here(c))) or below.get(c[2])
            if mine is not None:
                walk(c, mine)

    walk(page, groups)
    return sorted(found)


def _same_on_pages(same: list, sample: list) -> bool:
    """All texts of these elements are the same on all or nearly all pages, of two at least."""
    pages: dict = {}
    for c in same:
        if c[3] is not None:
            pages[c[3]] = {*pages.get(c[3], ()), *c[5]}
    least = max(2, NEARLY_ALL * len(sample))
    return bool(pages) and "*" not in pages and all(len(p.intersection(sample)) >= least for p in pages.values())


def _counted_on_pages(number: int, same: list, found: dict) -> bool:
    """The same by the number of different pages that have each text, over all pages of the host."""
    texts = _constant(same)
    least = max(2, NEARLY_ALL * found.get(PAGE, 0))
    return bool(texts) and all(found.get(_place(number, t), 0) >= least for t in texts)


def rules(w: list, found: dict | None = None) -> dict:
    """The wrapper as a tree of decisions per kind of page: [take, {key: decision}]. ``take``: the
    element's own texts belong to the article. On pages without an article element, groups of links and
    texts that are the same on all or nearly all of several pages do not. ``found`` has the different pages by
    place; without it the pages that the wrapper keeps judge."""
    return {kind[0]: _decisions(kind, found) for kind in _kinds(w)}


def _decisions(w: list, found: dict | None) -> list:
    named = w[0] == NAMED

    def same_text(number: int, same: list) -> bool:
        return _same_on_pages(same, w[6]) if found is None else _counted_on_pages(number, same, found)

    def walk(groups: dict, inside: bool) -> dict:
        made: dict = {}
        for key, (number, same, below) in groups.items():
            tag = key.split(" ")[0]
            now = inside or tag in MAIN
            if _left_out(key) or (tag == "header" and not inside and named):
                made[key] = [0, {}]
            elif named:
                made[key] = [int(now), walk(below, now)]
            elif tag in ("ul", "ol", "table", "div", "section") and all(map(_only_links, same)):
                made[key] = [0, {}]
            else:
                made[key] = [int(tag != "header" and not same_text(number, same)), walk(below, now)]
        return made

    number, same, below = _grouped([w], count())
    return [int(not named and not same_text(number, same)), walk(below, False)]


def main_text(page: list, decisions: dict) -> str:
    """The page's article by the decisions for its kind: blocks in page order, white space inside a block as one space."""
    blocks: list[list[str]] = [[]]

    def walk(node: list, known: dict, take: int) -> None:
        for c in node[1]:
            if isinstance(c, str):
                if take:
                    blocks[-1].append(c)
                continue
            tag = c[2]
            if tag == "br":
                blocks[-1].append(" ")
                continue
            mine = known.get(c[0])
            if mine is None and _left_out(c[0]):
                mine = [0, {}]
            elif mine is None:  # one of many different children; one the wrapper does not have: as its parent
                mine = known.get(_sort_of(c[0], _only_links_here(c))) or known.get(tag) or [take, {}]
            if tag in BLOCKS:
                blocks.append([])
            if mine[0] or mine[1]:
                walk(c, mine[1], mine[0])
            if tag in BLOCKS:
                blocks.append([])

    take, known = decisions[page[0]]
    walk(page, known, take)
    # text in left-out inline elements is gone, so words on both sides stay apart as in the page
    texts = (" ".join(unescape("".join(b)).split()) for b in blocks)
    return "\n\n".join(t for t in texts if t)


# -- Spark ---------------------------------------------------------------------------------------------

def host_of(url: Column) -> Column:
    """Lower-case host without ``www.``; null if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.nullif(F.regexp_replace(host, r"^www\.", ""), F.lit(""))


def _folded(batches: Iterator[pa.RecordBatch], make) -> Iterator[pa.RecordBatch]:
    """One wrapper per host of the task. A task with very many hosts passes on what it has, early."""
    held: dict[str, list] = {}

    def out() -> pa.RecordBatch:
        rows = [json.dumps(w) for w in held.values()]
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(rows, pa.string())], names=["host", "wrapper"])

    for batch in batches:
        for host, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            w = make(raw)
            held[host] = align(held[host], w) if host in held else w
        if len(held) > 20_000:
            yield out()
            held.clear()
    yield out()


def infer(pages: DataFrame, parts: int = 16) -> DataFrame:
    """(host, wrapper as JSON) over all pages with a host: folded per task, then per part of a host,
    then per host. Equal wrappers of a host are folded once."""
    def of_pages(batches):
        return _folded(batches, lambda raw: wrapper_of(parse(raw or "")))

    def of_wrappers(batches):
        return _folded(batches, json.loads)

    schema = "host string, wrapper string"
    made = pages.select(host_of(F.col("url")).alias("host"), "html").filter("host IS NOT NULL").mapInArrow(of_pages, schema).distinct()
    part = F.pmod(F.xxhash64("wrapper"), F.lit(parts))
    made = made.repartition(F.col("host"), part).sortWithinPartitions("host", "wrapper").mapInArrow(of_wrappers, schema).distinct()
    return made.repartition("host").sortWithinPartitions("host", "wrapper").mapInArrow(of_wrappers, schema)


def counted(pages: DataFrame, wrappers: DataFrame) -> DataFrame:
    """(host, wrapper, found): ``found`` has the number of different pages by place as ``place:number``, for places
    on several pages. A page counts once however often it is repeated; one row per page is shuffled, and a host's
    places are at most the elements of its wrapper."""
    rows = pages.select(host_of(F.col("url")).alias("host"), "html").filter("host IS NOT NULL")
    rows = join_per_key(rows, wrappers, ["host"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list | None] = {}
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            for host, raw, wrapper in zip(*(batch.column(n).to_pylist() for n in ("host", "html", "wrapper"))):
                if host not in known:
                    if len(known) > 5_000:
                        known.clear()
                    known[host] = constants(json.loads(wrapper))
                page = parse(raw or "")
                if page[0] == PLAIN:
                    for column, x in zip(out, (host, _page_hash(page), places_of(page, known[host]))):
                        column.append(x)
            kinds = (pa.string(), pa.int64(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(list(map(pa.array, out, kinds)), names=["host", "page", "places"])

    seen = rows.select("host", "html", "wrapper").mapInArrow(run, "host string, page bigint, places array<bigint>")
    once = seen.groupBy("host", "page").agg(F.array_distinct(F.flatten(F.collect_set("places"))).alias("places"))
    numbers = once.select("host", F.explode("places").alias("place")).groupBy("host", "place").agg(F.count(F.lit(1)).alias("n"))
    pair = F.concat_ws(":", F.col("place").cast("string"), F.col("n").cast("string"))
    found = numbers.filter("n > 1").groupBy("host").agg(F.array_join(F.collect_list(pair), ",").alias("found"))
    return wrappers.join(found, "host", "left")


def _numbers(found: str | None) -> dict[int, int]:
    return {int(k): int(n) for k, n in (x.split(":") for x in (found or "").split(",") if x)}


def extract(pages: DataFrame) -> DataFrame:
    """Per row of pages: page_id, url, host, text, n_chars (code points of the text).

    A null html has an empty text; a page without a host is its own wrapper. Repeated rows are
    extracted each; no rows give no rows."""
    wrappers = materialise(counted(pages, materialise(infer(pages), "wrappers")), "counted-wrappers")
    rows = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), "html")
    rows = join_per_key(rows, wrappers, ["host"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict] = {}
        for batch in batches:
            texts = []
            for host, raw, wrapper, found in zip(*(batch.column(n).to_pylist() for n in ("host", "html", "wrapper", "found"))):
                page = parse(raw or "")
                if wrapper is None:
                    decisions = rules(wrapper_of(page))
                else:
                    decisions = known.get(host)
                    if decisions is None:
                        if len(known) > 5_000:
                            known.clear()
                        decisions = known[host] = rules(json.loads(wrapper), _numbers(found))
                texts.append(main_text(page, decisions))
            kept = [batch.column(n) for n in ("page_id", "url", "host")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "host", "text", "n_chars"])

    kinds = ", ".join(f"{n} {t}" for n, t in rows.select("page_id", "url", "host").dtypes)
    return rows.select("page_id", "url", "host", "html", "wrapper", "found").mapInArrow(run, f"{kinds}, text string, n_chars bigint")
