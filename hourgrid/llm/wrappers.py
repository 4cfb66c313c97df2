"""Main text of web pages by inferring a union-free regular expression for every host.

A page is read as a stream of tags and texts, made well formed. Within a page, neighbouring runs
of the same tags become a repeated group. The streams of a host's pages are then aligned one after
the other: where a text differs there is a slot, tags that one side lacks become an optional group,
and runs that occur several times a repeated one. The outcome is the host's wrapper, an expression
of tags, slots, ``(...)?`` and ``(...)+`` without alternatives, that all its pages match. It knows
of every slot how many texts filled it, how long they were, how much of them was link text and
whether they were all the same.

Whether a slot is main text is decided once for a wrapper, and a page's texts are judged by the slots
they fill. Marked parts (menus, forms, comments and so on, by tag, class, id or role) are out. Main
text lies in ``article`` elements, else in ``main``; where a host has neither, in the innermost
element that holds nearly all text that varies and is not linked. Slots that say the same on every
page are template text.

Pages are first reduced to their expressions, which are counted natively, combined before the
shuffle; a host's distinct expressions are aligned in groups of bounded size, and the wrappers of
the groups in further rounds. The second pass joins wrappers to pages; pages of large hosts are
dealt to slices, and the wrapper goes to each slice.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.llm.common import batches_of, rows_of, travels_by_value
from hourgrid.session import saved

travels_by_value(__name__)

#: Expressions that are aligned in one group.
FAN = 256
#: A host with more than this share of all pages is dealt to slices.
SLICES = 1000
#: A slot with the same text this often is template text.
CONSTANT = 5
#: An element that holds this share of the free text around it is where the main text lies.
SHARE = 0.8
#: Elements below this depth are put side by side.
DEEPEST = 200

# ---- fixed values: names of HTML elements and of parts of pages -------------
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var math html head body".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noscript noembed noframes template svg canvas object".split())
#: Start tags that end an open paragraph.
BLOCKS = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup li main menu nav ol p pre section summary table ul".split())
#: Which open elements a start tag ends, and within which elements it looks for them.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
OUTSIDE = frozenset("nav header footer aside form button select dialog menu option optgroup datalist".split())
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot sponsor sponsored sponsors promo promotion promoted "
    "banner banners outbrain taboola nav navbar navigation navi menu menus breadcrumb breadcrumbs pagination pager toolbar "
    "sidebar sidebars sidenav rail widget widgets header masthead topbar footer colophon copyright notice notices cookie "
    "cookies consent gdpr alert alerts popup modal overlay toast paywall disclaimer form search login signin signup "
    "subscribe subscription newsletter share sharing social follow related recommended recommendations comment comments "
    "commentlist disqus respond replies reply discussion contentinfo complementary dialog hidden".split())
#: Before a hint these say that an element has such a part, not that it is one.
HAVING = frozenset("has with no non not without is".split())
#: Elements that hold one piece of a text, and not the text.
BLOCK_OF_TEXT = frozenset("p li dt dd td th tr tbody pre blockquote h1 h2 h3 h4 h5 h6".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|</([a-zA-Z][^\s/>]*)[^>]*>|<([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*)>""", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in RAW}

# ---- nodes: [tag, flags, content] -------------------------------------------
# A text's tag is "" and its content data; a group's tag is "*"; other tags are elements'.
OPTIONAL, REPEATED = 1, 2
TEXT, GROUP = "", "*"
Node = list
Join = Callable[[object, object], object]


@lru_cache(100_000)
def _tag(name: str, attributes: str) -> str:
    """Name, role, id and classes of an element, without digits, as its tag."""
    found = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(attributes)} if attributes.strip(" /") else {}
    parts = [f"{sign}{part}" for sign, key in (("@", "role"), ("#", "id"), (".", "class"))
             for part in sorted(set(re.sub(r"\d+", "", found.get(key, "")).split()))]
    if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", ""):
        parts.append(".hidden")
    return name + "".join(parts)


def _name(tag: str) -> str:
    return re.split(r"[@#.]", tag, maxsplit=1)[0]


@lru_cache(100_000)
def _hinted(tag: str) -> bool:
    """Whether the role, id or a class says that an element is no main text."""
    for word in re.split(r"[@#.]", tag)[1:]:
        pieces = [p for p in re.split(r"[-_]|(?<=[a-z])(?=[A-Z])", word) if p]
        if pieces and (pieces[0].lower() in HINTS or len(pieces) <= 3 and pieces[-1].lower() in HINTS
                       and pieces[0].lower() not in HAVING):
            return True
    return False


def read(page: str) -> tuple[list[Node], list[str], list[int]]:
    """(nodes, texts, linked characters of each text) of a page; the nodes' data are lists of numbers of texts."""
    root: list[Node] = []
    stack: list[tuple[str, list[Node]]] = [("", root)]
    texts: list[str] = []
    linked: list[int] = []
    pieces: list[str] = []
    marked: list[str] = []  # open inline elements that a hint marks, as elements of their own
    in_link, link_size = 0, 0

    def end_text() -> None:
        nonlocal link_size
        text = " ".join("".join(pieces).split())
        if text:
            stack[-1][1].append([TEXT, 0, [len(texts)]])
            texts.append(text)
            linked.append(min(link_size, len(text)))
        pieces.clear()
        link_size = 0

    def take(text: str) -> None:
        nonlocal link_size
        if text:
            text = html.unescape(text) if "&" in text else text
            pieces.append(text)
            link_size += len(text) if in_link else 0

    def open_element(name: str, tag: str) -> None:
        end_text()
        if len(stack) > DEEPEST:  # as browsers do, put what lies deeper side by side
            stack.pop()
        node = [tag, 0, []]
        stack[-1][1].append(node)
        stack.append((name, node[2]))

    def close(names: set[str], within: set[str] = frozenset()) -> None:
        """End the nearest open element of ``names``, with all in it, unless one of ``within`` is nearer."""
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in names:
                end_text()
                del stack[i:]
                return
            if stack[i][0] in within:
                return

    at = 0
    while at < len(page):
        found = TOKEN.search(page, at)
        if found is None:
            take(page[at:])
            break
        take(page[at:found.start()])
        at = found.end()
        if found[1]:
            name = found[1].lower()
            if name in INLINE:
                if name == "a":
                    in_link = 0
                if name in marked:
                    marked.remove(name)
                    close({name})
            elif name in ("br", "hr"):
                pieces.append(" ")
            else:
                close({name})
        elif found[2]:
            name, attributes = found[2].lower(), found[3]
            if name in RAW and not (name == "svg" and attributes.rstrip().endswith("/")):
                over = RAW_END[name].search(page, at)
                at = over.end() if over else len(page)
                pieces.append(" ")
            elif name in VOID or name in RAW:
                pieces.append(" " * (name in ("br", "hr")))
            elif name in INLINE:
                tag = _tag(name, attributes)
                if name not in ("html", "head", "body") and _hinted(tag):
                    open_element(name, tag)
                    marked.append(name)
                in_link = 1 if name == "a" else in_link
            else:
                if name in BLOCKS:
                    close({"p"}, {"td", "th", "table", "li", "blockquote", "article", "section", "div"})
                if name in ENDS:
                    for _ in range(3):
                        close(*ENDS[name])
                open_element(name, _tag(name, attributes))
    end_text()
    return root, texts, linked


# ---- expressions ------------------------------------------------------------


def key(node: Node):
    """What aligned nodes have in common."""
    if node[0] == GROUP:
        return tuple(key(n) for n in node[2] if not n[1] & OPTIONAL) or tuple(key(n) for n in node[2])
    return node[0]


def merged(a: Node, b: Node, join: Join) -> Node:
    """The node that both match; they have the same key."""
    return [a[0], a[1] | b[1], join(a[2], b[2]) if a[0] == TEXT else aligned(a[2], b[2], join)]


def regrouped(nodes: list[Node], groups: set[tuple]) -> list[Node]:
    """``nodes``, with runs that are one turn of one of ``groups`` as a group."""
    out = list(nodes)
    for group in sorted(groups, key=lambda g: (-len(g), repr(g))):
        keys = [key(n) for n in out]
        i = 0
        while i + len(group) <= len(out):
            if tuple(keys[i:i + len(group)]) == group:
                out[i:i + len(group)] = [[GROUP, 0, out[i:i + len(group)]]]
                keys[i:i + len(group)] = [group]
            i += 1
    return out


def folded(nodes: list[Node], join: Join) -> list[Node]:
    """``nodes``, with neighbouring runs of the same keys as one repeated node or group."""
    out = list(nodes)
    keys = [key(n) for n in out]
    for width in range(1, 5):
        i = 0
        while i + 2 * width <= len(out):
            run = keys[i:i + width]
            if keys[i + width:i + 2 * width] != run or (width == 1 and run == [TEXT]):
                i += 1
                continue
            turns = 1
            while keys[i + turns * width:i + (turns + 1) * width] == run:
                turns += 1
            body = out[i:i + width]
            for t in range(1, turns):
                body = [merged(a, b, join) for a, b in zip(body, out[i + t * width:i + (t + 1) * width])]
            whole = body[0] if width == 1 else [GROUP, 0, body]
            whole = [whole[0], whole[1] | REPEATED, whole[2]]
            out[i:i + turns * width] = [whole]
            keys[i:i + turns * width] = [key(whole)]
            i += 1
    return out


def aligned(a: list[Node], b: list[Node], join: Join) -> list[Node]:
    """The expression that two sequences of nodes match."""
    if [n[0] for n in a] != [n[0] for n in b] or any(n[0] == GROUP for n in a):
        groups = {key(n) for n in a if n[0] == GROUP}, {key(n) for n in b if n[0] == GROUP}
        a, b = regrouped(a, groups[1] - groups[0]), regrouped(b, groups[0] - groups[1])
    keys = [key(n) for n in a], [key(n) for n in b]
    if keys[0] == keys[1]:
        return [merged(x, y, join) for x, y in zip(a, b)]
    out: list[Node] = []
    for how, i, j, k, m in SequenceMatcher(None, *keys, autojunk=False).get_opcodes():
        if how == "equal":
            out += [merged(x, y, join) for x, y in zip(a[i:j], b[k:m])]
        else:
            out += [[n[0], n[1] | OPTIONAL, n[2]] for n in a[i:j] + b[k:m]]
    return folded(out, join)


def compact(nodes: list[Node], join: Join) -> list[Node]:
    """A page's own expression: repeated parts folded, from the inside out."""
    return folded([n if n[0] == TEXT else [n[0], n[1], compact(n[2], join)] for n in nodes], join)


def slots(nodes: list[Node]) -> Iterator[Node]:
    for node in nodes:
        if node[0] == TEXT:
            yield node
        else:
            yield from slots(node[2])


def with_data(nodes: list[Node], data: Iterator) -> list[Node]:
    """The same expression with other data in its slots, in order."""
    return [[n[0], n[1], next(data) if n[0] == TEXT else with_data(n[2], data)] for n in nodes]


def _both_lists(a: list, b: list) -> list:
    return a + b


def _summed(a: list[int], b: list[int]) -> list[int]:
    return [a[0] + b[0], a[1] + b[1], a[2] + b[2], min(a[3], b[3]), max(a[4], b[4])]


def expression(page: str) -> tuple[list[Node], list[str], list[int]]:
    nodes, texts, linked = read(page)
    return compact(nodes, _both_lists), texts, linked


# ---- which slots are main text ----------------------------------------------


def main_slots(nodes: list[Node]) -> list[bool]:
    """Whether each slot of a wrapper is main text, given its (texts, characters, linked ones, least and largest hash)."""
    found: list[tuple[Node, list[Node]]] = []  # slots with the elements around them

    def visit(nodes: list[Node], around: list[Node]) -> None:
        for node in nodes:
            if node[0] == TEXT:
                found.append((node, around))
            else:
                visit(node[2], around if node[0] == GROUP else [*around, node])

    visit(nodes, [])

    def varies(slot: Node) -> bool:
        return slot[2][3] != slot[2][4]

    def free(slot: Node) -> int:
        """Characters that are not linked, if they are not the same on many pages."""
        n, size, links, _, _ = slot[2]
        return max(size - links, 0) if varies(slot) or n < CONSTANT else 0

    total: dict[int, int] = {}
    for slot, around in found:
        for element in around:
            total[id(element)] = total.get(id(element), 0) + free(slot)
    everything = sum(free(slot) for slot, _ in found)

    def marks_main(element: Node) -> bool:
        return _name(element[0]) in ("article", "main") or "@main" in element[0]

    holds = {id(e) for _, around in found for i, e in enumerate(around) if any(map(marks_main, around[i + 1:]))}
    bare = not any(map(marks_main, (e for _, around in found for e in around)))

    def outside(around: list[Node], slot: Node) -> bool:
        """Whether an element around a slot is marked as other than main text."""
        heading = any(_name(e[0]) in HEADINGS for e in around)
        in_article = False
        for e in around:
            name = _name(e[0])
            marked = name in OUTSIDE or _hinted(e[0])
            if marked and id(e) not in holds:
                # a page's whole content may lie in a form; an article's own header holds its title
                wraps = bare and everything and total[id(e)] > SHARE * everything and name not in ("nav", "footer", "aside")
                title = heading and in_article and "header" in e[0]
                if not wraps and not title:
                    return True
            in_article |= marks_main(e)
        return False

    inside = [not outside(around, slot) for slot, around in found]

    def within(names: tuple[str, ...]) -> list[bool]:
        return [ok and any(_name(e[0]) in names or ("main" in names and "@main" in e[0]) for e in around)
                for ok, (_, around) in zip(inside, found)]

    chosen = next((c for c in (within(("article",)), within(("main",))) if any(c)), None)
    if chosen is None:
        chosen = _densest(found, inside, free)
    if any(c and varies(slot) for c, (slot, _) in zip(chosen, found)):
        # text that is the same on every page, but for headings, belongs to the template
        chosen = [c and (varies(slot) or slot[2][0] < CONSTANT or any(_name(e[0]) in HEADINGS for e in around))
                  for c, (slot, around) in zip(chosen, found)]
    return chosen


def _densest(found: list[tuple[Node, list[Node]]], inside: list[bool], free: Callable[[Node], int]) -> list[bool]:
    """Without marks: slots in the innermost element that holds nearly all free text, and headings of the first rank."""
    size: dict[int, int] = {}
    depth: dict[int, int] = {}
    for ok, (slot, around) in zip(inside, found):
        for i, element in enumerate(around):
            size[id(element)] = size.get(id(element), 0) + (free(slot) if ok else 0)
            depth[id(element)] = i
    whole = sum(free(slot) for ok, (slot, _) in zip(inside, found) if ok)
    best, level = None, -1
    block = {id(e) for _, around in found for e in around if _name(e[0]) in BLOCK_OF_TEXT}
    while whole:
        heavy = [e for e, d in depth.items() if d == level + 1 and size[e] >= SHARE * whole]
        if not heavy or heavy[0] in block:
            break
        best, level = heavy[0], level + 1
    out = []
    for ok, (slot, around) in zip(inside, found):
        here = best is None or any(id(e) == best for e in around) or any(_name(e[0]) == "h1" for e in around)
        out.append(ok and here and 2 * slot[2][2] <= slot[2][1])
    return out


def statistics(blocks: list[int], texts: list[str], linked: list[int]) -> list[int]:
    """(texts, characters, linked ones, least and largest hash) of the texts of a slot."""
    hashes = [xxhash.xxh64_intdigest(texts[i].encode("utf-8", "replace")) >> 1 for i in blocks]
    return [len(blocks), sum(len(texts[i]) for i in blocks), sum(linked[i] for i in blocks), min(hashes), max(hashes)]


def main_text(page: str, wrapper: list[Node] | None) -> str:
    """The texts of a page that fill slots of main text; ``wrapper`` holds whether a slot is one."""
    nodes, texts, linked = expression(page)
    kept: dict[int, bool] = {}

    def fills(a: object, b: object) -> object:
        """A wrapper's slot has a truth value, a page's a list of texts."""
        if isinstance(a, list) and isinstance(b, list):
            return a + b
        a, b = (b, a) if isinstance(a, list) else (a, b)
        if isinstance(b, list):
            kept.update(dict.fromkeys(b, bool(a)))
        return a

    if wrapper is not None:
        aligned(wrapper, nodes, fills)
    if len(kept) < len(texts):  # without a wrapper, or beside it, a page is its own wrapper
        own = main_slots(with_data(nodes, iter([statistics(s[2], texts, linked) for s in slots(nodes)])))
        for slot, is_main in zip(slots(nodes), own):
            for block in slot[2]:
                kept.setdefault(block, is_main)
    return " ".join(text for i, text in enumerate(texts) if kept[i])


# ---- Spark ------------------------------------------------------------------

PARTS = "host string, expression string, slot int, n long, size long, links long, low long, high long"


def _expressions(pages: DataFrame) -> DataFrame:
    """(host, expression, slots): the distinct expressions of every host, with statistics of their slots in order."""
    fields = [("host", pa.string()), ("expression", pa.string()), ("slot", pa.int32()),
              *((c, pa.int64()) for c in ("n", "size", "links", "low", "high"))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[str, str], list[list[int]]] = {}
            for host, page in rows_of([batch]):
                nodes, texts, linked = expression(page)
                stats = [statistics(s[2], texts, linked) for s in slots(nodes)]
                place = host, json.dumps(with_data(nodes, iter([0] * len(stats))), separators=(",", ":"))
                found[place] = [_summed(a, b) for a, b in zip(found[place], stats)] if place in found else stats
            yield from batches_of(((*place, i, *s) for place, stats in found.items() for i, s in enumerate(stats)), fields, 8192)

    parts = pages.select("host", "html").mapInArrow(run, PARTS)
    each = parts.groupBy("host", "expression", "slot").agg(
        *(F.sum(c).alias(c) for c in ("n", "size", "links")), F.min("low").alias("low"), F.max("high").alias("high"))
    whole = each.groupBy("host", "expression").agg(F.sort_array(F.collect_list(
        F.struct("slot", F.array("n", "size", "links", "low", "high").alias("stats")))).alias("slots"))
    return whole.select("host", "expression", F.to_json("slots.stats").alias("slots"))


def infer(pages: DataFrame, fan: int = FAN) -> DataFrame:
    """(host, expression, slots): one wrapper a host; ``slots`` holds JSON arrays of its slots' statistics, in order."""
    rows = saved(_expressions(pages), "wrapper-expressions")

    def align(group: pa.Table) -> pa.Table:
        found = sorted(zip(*(group.column(c).to_pylist() for c in ("expression", "slots"))), key=lambda r: (len(r[0]), *r))
        wrapper = None
        for expression, stats in found:
            nodes = with_data(json.loads(expression), iter(json.loads(stats)))
            wrapper = nodes if wrapper is None else aligned(wrapper, nodes, _summed)
        stats = [s[2] for s in slots(wrapper)]
        return pa.table({"host": group.column("host")[:1], "expression": [json.dumps(with_data(wrapper, iter([0] * len(stats))))],
                         "slots": [json.dumps(stats)]})

    while True:
        many = saved(rows.groupBy("host").count().filter("count > 1"), "wrapper-hosts")
        if many.isEmpty():
            return rows
        groups = F.ceil(F.col("count") / F.lit(fan))
        joined = rows.join(many.withColumnRenamed("host", "h"), F.col("host") == F.col("h"), "left")
        single = joined.filter("h is null").select(rows.columns)
        dealt = joined.filter("h is not null").select(
            *rows.columns, F.pmod(F.xxhash64("expression", "slots"), groups).alias("group"))
        merged_rows = dealt.groupBy("host", "group").applyInArrow(align, "host string, expression string, slots string")
        rows = saved(single.unionByName(merged_rows), "wrapper-round")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            fan: int = FAN) -> DataFrame:
    """(id, url, text, n_chars): the main text of every row.

    Texts lie between tags that are not inline; character references are decoded, white space
    becomes one space, and the texts that are kept are joined by one space, in order. A null,
    empty or blank page, and one without main text, has an empty text. Rows without a URL, or
    with one without a host, make one host of their own. Ids may be null or repeat; repeated rows
    get the same text. Unclosed and misplaced tags, comments, scripts and quotes are read as
    browsers do, roughly. No rows give no rows. Other columns are not read.
    """
    host = F.regexp_extract(F.lower(F.col(url_col)), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"), F.coalesce(host, F.lit("")).alias("host"))
    found = infer(rows, fan)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def wrappers() -> Iterator[tuple]:
            for host, expression, stats in rows_of(batches):
                nodes = with_data(json.loads(expression), iter(json.loads(stats)))
                yield host, json.dumps(with_data(nodes, iter(map(int, main_slots(nodes)))), separators=(",", ":"))

        yield from batches_of(wrappers(), [("host", pa.string()), ("wrapper", pa.string())], 256)

    # hosts with more than a SLICES-th of all pages: fewer than SLICES of them, with 2 * SLICES slices in all at most
    counts = saved(rows.groupBy("host").count(), "wrapper-counts")
    least = counts.agg(F.sum("count")).first()[0] or 0
    large = counts.filter(F.col("count") > F.lit(least / SLICES)).select(
        F.col("host").alias("h"), F.ceil(F.col("count") * SLICES / F.lit(least or 1)).alias("slices"))
    large = F.broadcast(large)
    judged = found.mapInArrow(decide, "host string, wrapper string").join(large, F.col("host") == F.col("h"), "left").select(
        F.col("host").alias("of"), "wrapper", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("slices", F.lit(1)) - 1)).alias("part"))
    # any slice will do for a page, so copies of one page are dealt to all
    dealt = rows.withColumn("row", F.monotonically_increasing_id()).join(large, F.col("host") == F.col("h"), "left").withColumn(
        "slice", F.pmod("row", F.coalesce("slices", F.lit(1))))
    joined = dealt.join(judged.hint("shuffle_hash"), (F.col("host") == F.col("of")) & (F.col("slice") == F.col("part")), "left")
    fields = [("url", pa.string()), ("text", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parsed: dict[str | None, list[Node] | None] = {}

        def texts(batch: pa.RecordBatch) -> Iterator[tuple]:
            for id_value, url, page, wrapper in rows_of([batch]):
                if wrapper not in parsed:
                    if len(parsed) > 10_000:
                        parsed.clear()
                    parsed[wrapper] = json.loads(wrapper) if wrapper else None
                yield id_value, url, main_text(page, parsed[wrapper])

        for batch in batches:
            yield from batches_of(texts(batch), [("id", batch.schema.field("id").type), *fields], 1024)

    id_type = rows.schema["id"].dataType.simpleString()
    out = joined.select("id", "url", "html", "wrapper").mapInArrow(run, f"id {id_type}, url string, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))
