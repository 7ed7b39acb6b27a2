"""Main text of web pages by wrapper induction over the pages of a host.

1. Each page is parsed into its tree of block elements.  Siblings with the same label (tag and
   classes) are one node, so a page's *layout* is small however long its lists and articles are.
   Text is kept as blocks that point to their node.
2. The layouts of a host are aligned with the host's most frequent one by simple tree matching: of
   two trees with matching roots, the order-preserving matching of children that covers the
   most nodes.  Matched nodes are one *slot* of the host's wrapper; a node without a match is a slot of its own.
3. Over all different pages of the host, a slot whose text never changes is template, and one
   that changes is content, unless what it is says otherwise: navigation, footers, forms,
   adverts, notices, comments and the like vary as well and are never content.
4. In each layout the main region is the element that is declared as such (``article``, ``main`` and
   the usual class names), or else the smallest one that holds most of the changing text.
   The text of a page is the blocks of the content slots inside.

Counting is done by Spark over nodes and slots; Python sees one page or one pair of layouts at a time, so a host
with a third of all pages is no group in any task.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexspark.llm.shipping import ship
from lexspark.operators.skew import join_per_key
from lexspark.session import stage

MAX_DEPTH = 200  # deeper elements are part of the one at this depth; their text stays
MIN_CONSTANT = 3  # different pages that must agree before a slot is template
DOMINANT = 0.6  # share of the changing text that leads into a part of a region
LINKED = 0.8  # share of link text beyond which an undeclared slot is a menu
BROADCAST_BYTES = 32 << 20

_TOKEN = re.compile(
    r"""<(?:!--(?:-?>|.*?(?:--!?>|\Z))|!\[CDATA\[.*?(?:\]\]>|\Z)|[!?][^>]*(?:>|\Z)"""
    r"""|(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*+)(?:>|\Z))""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
_NAMES = re.compile(r"[a-z]+")

# fixed values: element kinds of HTML
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_BLOCK = frozenset(
    "html body address article aside blockquote caption center colgroup dd details dialog dir div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 header hgroup legend li main menu nav ol p pre search section summary table"
    " tbody td tfoot th thead tr ul".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_FLOW = _HEADINGS | frozenset("p blockquote pre dd dt figcaption td th".split())
# an opening tag ends these, up to the nearest of the second set
_ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table", "tbody", "thead", "tfoot"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
# never content: by tag, and by the first or last word of a class, id or role
_NEVER = frozenset(
    "head nav aside footer form fieldset select option button label dialog menu noscript template object canvas audio video"
    " svg math map datalist".split()
)
_NEVER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsored sponsor promo promotion banner nav navbar navigation menu"
    " breadcrumb breadcrumbs pagination pager footer sidebar aside widget widgets related recommended recommendations"
    " comment comments disqus replies respond cookie cookies consent gdpr notice notices alert popup modal overlay"
    " newsletter subscribe subscription signup login search share sharing social toolbar masthead skip hidden"
    " complementary contentinfo banner alertdialog".split()
)
_ABOUT = frozenset("has have no not with without is".split())
_MAIN_WORDS = frozenset("article articlebody content entry post story main maincontent".split())


# ---------------------------------------------------------------- one page


class _Tree:
    """A layout as it grows: node 0 is the root; equal labels under one node are one node."""

    def __init__(self):
        self.labels, self.parents, self.children = ["html"], [-1], [{}]

    def child(self, node: int, label: str) -> int:
        found = self.children[node].get(label)
        if found is None:
            found = self.children[node][label] = len(self.labels)
            self.labels.append(label)
            self.parents.append(node)
            self.children.append({})
        return found


def _label(tag: str, rest: str) -> tuple[str, bool]:
    """The label of an element and whether it is never content.  Digits are no part of a class
    name, so that numbered ones are equal."""
    words: list[str] = []
    never = tag in _NEVER
    if rest and not rest.isspace():
        for name, *values in _ATTRIBUTE.findall(rest):
            name, value = name.lower(), "".join(values).lower()
            if name in ("class", "id", "role", "itemprop"):
                for found in map(_NAMES.findall, value.split()):
                    words.append("-".join(found))
                    # "content-sidebar-wrap" and "has-sidebar" are about what holds a sidebar
                    if found and tag != "body" and found[0] not in _ABOUT:
                        never |= not _NEVER_WORDS.isdisjoint((found[0], found[-1]))
            elif name == "hidden" or (name == "aria-hidden" and value == "true"):
                never = True
            elif name == "style" and "display:none" in value.replace(" ", ""):
                never = True
    label = ".".join([tag, *sorted(set(filter(None, words)))])
    return ("!" + label if never else label), never


def parse(page: str) -> tuple[list[str], list[int], list[tuple[int, str, int]]]:
    """``(labels, parents, blocks)`` of a page: its layout, and ``(node, text, characters in links)`` of
    each block of text in page order, character references decoded and white space made one blank.

    As in a browser, elements may lack their end tags, and an unfinished tag ends the page.
    """
    tree, blocks = _Tree(), []
    stack: list[tuple[str, int]] = [("html", 0)]
    piece: list[str] = []
    linked, in_link = 0, False
    at, size = 0, len(page)

    def close_block() -> None:
        nonlocal linked, in_link
        if piece:
            text = " ".join("".join(piece).split())
            if text:
                blocks.append((stack[-1][1], text, min(linked, len(text))))
            piece.clear()
        linked, in_link = 0, False

    def pop_to(names: frozenset, stop: frozenset) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in names:
                del stack[i:]
                return
            if stack[i][0] in stop:
                return

    while at < size:
        found = _TOKEN.search(page, at)
        until = found.start() if found else size
        if until > at:
            text = html.unescape(page[at:until]) if "&" in page[at:until] else page[at:until]
            piece.append(text)
            if in_link:
                linked += len(text)
        if not found:
            break
        at = found.end()
        tag = found["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if found["end"]:
            if tag == "a":
                in_link = False
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
            if depth:
                close_block()
                del stack[depth:]
            elif tag in _BLOCK:
                close_block()
            continue
        if tag in _RAW:
            closing = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(page, at)
            at = closing.start() if closing else size
            continue
        if tag == "br":
            piece.append(" ")
            continue
        if tag == "hr":
            close_block()
        if tag in _VOID:
            continue
        if tag == "a":
            in_link = True
        if tag == "html":
            continue
        label, never = _label(tag, found["rest"])
        if tag not in _BLOCK and not never:
            continue
        close_block()
        if tag in _BLOCK:
            pop_to(frozenset(["p"]), frozenset(["table", "button"]))
        if tag in _HEADINGS:
            pop_to(_HEADINGS, _BLOCK - _HEADINGS)
        if tag in _ENDS:
            pop_to(*_ENDS[tag])
        if len(stack) <= MAX_DEPTH:
            stack.append((tag, tree.child(stack[-1][1], label)))
    close_block()
    return tree.labels, tree.parents, blocks


# ---------------------------------------------------------------- layouts


def write_layout(labels: list[str], parents: list[int]) -> str:
    """A layout as text: for each node but the root, its parent's number and its label."""
    return "\n".join(f"{p} {label}" for p, label in zip(parents[1:], labels[1:]))


def read_layout(layout: str) -> tuple[list[str], list[int]]:
    lines = [line.split(" ", 1) for line in layout.split("\n") if line]
    return ["html", *(label for _, label in lines)], [-1, *(int(p) for p, _ in lines)]


def _paths(labels: list[str], parents: list[int]) -> list[str]:
    paths: list[str] = []
    for label, parent in zip(labels, parents):
        paths.append(label if parent < 0 else f"{paths[parent]}>{label}")
    return paths


def _children(parents: list[int]) -> list[list[int]]:
    out: list[list[int]] = [[] for _ in parents]
    for node, parent in enumerate(parents):
        if parent >= 0:
            out[parent].append(node)
    return out


def match_trees(labels: list[str], parents: list[int], other_labels: list[str], other_parents: list[int]) -> dict[int, int]:
    """Simple tree matching: which node of the first tree is which of the second.

    Nodes match if their tags and whether they are never content agree; equal labels count
    two, others one.  The weight of two nodes is that of the best matching of their children that
    keeps order, found by dynamic programming.
    """
    kinds = [label.split(".", 1)[0] for label in labels]
    other_kinds = [label.split(".", 1)[0] for label in other_labels]
    below, other_below = _children(parents), _children(other_parents)
    chosen: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def weight(a: int, b: int) -> int:
        rows, columns = below[a], other_below[b]
        best = [[0] * (len(columns) + 1)]
        step: list[list[int]] = []
        for x in rows:
            above, line, taken = best[-1], [0], []
            for j, y in enumerate(columns):
                both = above[j] + weight(x, y) if kinds[x] == other_kinds[y] else -1
                value = max(above[j + 1], line[j], both)
                taken.append(both if both == value else -1)
                line.append(value)
            best.append(line)
            step.append(taken)
        pairs, i, j = [], len(rows), len(columns)
        while i and j:
            if step[i - 1][j - 1] >= 0:
                pairs.append((rows[i - 1], columns[j - 1]))
                i, j = i - 1, j - 1
            elif best[i][j] == best[i - 1][j]:
                i -= 1
            else:
                j -= 1
        chosen[a, b] = pairs
        return best[-1][-1] + 1 + (labels[a] == other_labels[b])

    weight(0, 0)
    matched, todo = {0: 0}, [(0, 0)]
    while todo:
        for a, b in chosen[todo.pop()]:
            matched[a] = b
            todo.append((a, b))
    return matched


def slots(layout: str, wrapper: str) -> list[str]:
    """The slot of each node of a layout: the path of its match in the wrapper, or its own."""
    tree, main = read_layout(layout), read_layout(wrapper)
    matched = match_trees(*tree, *main) if layout != wrapper else {i: i for i in range(len(tree[0]))}
    own, paths = _paths(*tree), _paths(*main)
    return [paths[matched[i]] if i in matched else "+" + own[i] for i in range(len(own))]


# ---------------------------------------------------------------- content


def content_nodes(labels: list[str], parents: list[int], pages: list[int], constant: list[bool], chars: list[float], linked: list[float]) -> list[int]:
    """The nodes of a layout whose text is content; of each node's slot, how many different pages have
    text there, whether it is always the same, and characters per page, all and in links."""
    n = len(labels)
    below = _children(parents)
    kinds = [label.lstrip("!").split(".", 1)[0] for label in labels]
    declared = [
        not label.startswith("!") and (kind in ("article", "main") or not _MAIN_WORDS.isdisjoint(label.split(".")[1:]))
        for label, kind in zip(labels, kinds)
    ]
    never, within = [False] * n, [False] * n
    for i in range(n):
        above = parents[i]
        within[i] = declared[i] or (above >= 0 and within[above])
        never[i] = labels[i].startswith("!") or (above >= 0 and never[above])
        never[i] |= kinds[i] == "header" and not (above >= 0 and within[above])
    template = [pages[i] >= MIN_CONSTANT and constant[i] for i in range(n)]

    def masses(counted: list[bool]) -> list[float]:
        out = [max(0.0, chars[i] - linked[i]) if counted[i] and not never[i] else 0.0 for i in range(n)]
        for i in range(n - 1, 0, -1):
            out[parents[i]] += out[i]
        return out

    mass = masses([not t for t in template])
    if not mass[0]:
        mass = masses([True] * n)
    if not mass[0]:
        return []
    regions = [i for i in range(n) if declared[i] and not never[i] and mass[i] > 0]
    if regions:
        most = max(mass[i] for i in regions)
        region = max(i for i in regions if mass[i] >= 0.9 * most)  # a child's number is above its parent's
    else:
        region = 0
        while inner := [c for c in below[region] if mass[c] >= DOMINANT * mass[region] and kinds[c] not in _FLOW]:
            region = max(inner, key=lambda c: (mass[c], -c))
    inside, kept = [False] * n, []
    for i in range(n):
        inside[i] = i == region or (parents[i] >= 0 and inside[parents[i]])
        if not inside[i] or never[i]:
            continue
        # an article's own paragraphs may all be shared by its near copies, a menu's links vary
        if template[i] and not (regions and kinds[i] in _FLOW):
            continue
        if not regions and chars[i] and linked[i] > LINKED * chars[i]:
            continue
        kept.append(i)
    return kept


# ---------------------------------------------------------------- jobs

_BLOCKS = "array<struct<node: int, text: string>>"
_NODES = "array<struct<node: int, digest: bigint, chars: bigint, linked: bigint>>"
_BLOCK_TYPE = pa.list_(pa.struct([("node", pa.int32()), ("text", pa.string())]))
_NODE_TYPE = pa.list_(pa.struct([("node", pa.int32()), ("digest", pa.int64()), ("chars", pa.int64()), ("linked", pa.int64())]))


def _number(data: str) -> int:
    return int.from_bytes(hashlib.blake2b(data.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _page_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(page_id, url, html)`` as ``(page_id, url, layout, digest, nodes, blocks)``."""
    for batch in batches:
        for a in range(0, batch.num_rows, 200):
            part = batch.slice(a, 200)
            layouts, digests, nodes, blocks = [], [], [], []
            for page in part.column(2).to_pylist():
                labels, parents, found = parse(page or "")
                texts: dict[int, list] = {}
                for node, text, linked in found:
                    texts.setdefault(node, []).append((text, linked))
                rows = [
                    {"node": i, "digest": _number("\n".join(t for t, _ in v)), "chars": sum(len(t) for t, _ in v), "linked": sum(k for _, k in v)}
                    for i, v in sorted(texts.items())
                ]
                layouts.append(write_layout(labels, parents))
                digests.append(_number(" ".join(f"{r['node']} {r['digest']}" for r in rows)))
                nodes.append(rows)
                blocks.append([{"node": i, "text": text} for i, text, _ in found])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(layouts, pa.string()), pa.array(digests, pa.int64()),
                 pa.array(nodes, _NODE_TYPE), pa.array(blocks, _BLOCK_TYPE)],
                names=["page_id", "url", "layout", "digest", "nodes", "blocks"],
            )


def _slot_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(host, layout, wrapper)`` as one row per node with its slot."""
    for batch in batches:
        for host, layout, wrapper in zip(*(c.to_pylist() for c in batch.columns)):
            names = slots(layout, wrapper)
            n = len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array([host] * n, pa.string()), pa.array([layout] * n, pa.string()), pa.array(range(n), pa.int32()), pa.array(names, pa.string())],
                names=["host", "layout", "node", "slot"],
            )


def _content_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(host, layout, found)``, what is known of a layout's slots, as ``(host, layout, content)``."""
    for batch in batches:
        kept = []
        for layout, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            labels, parents = read_layout(layout)
            n = len(labels)
            pages, constant, chars, linked = [0] * n, [False] * n, [0.0] * n, [0.0] * n
            for row in found:
                i = row["node"]
                pages[i], constant[i], chars[i], linked[i] = row["pages"], row["constant"], row["chars"], row["linked"]
            kept.append(content_nodes(labels, parents, pages, constant, chars, linked))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(kept, pa.list_(pa.int32()))], names=["host", "layout", "content"]
        )


def host_of(url: Column) -> Column:
    """The host of a URL, lower case, without user and port; '' if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def parse_pages(pages: DataFrame, id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``(page_id, url, host, layout, digest, nodes, blocks)`` of each row of ``pages``, stored."""
    ship(pages.sparkSession)
    rows = pages.select(F.col(id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(page).cast("string").alias("html"))
    parsed = rows.mapInArrow(
        _page_batches, f"page_id long, url string, layout string, digest long, nodes {_NODES}, blocks {_BLOCKS}"
    )
    return stage(parsed.withColumn("host", host_of(F.col("url"))), "parsed_pages")


def induce(parsed: DataFrame) -> DataFrame:
    """``(host, layout, node, slot, pages, constant, chars, linked)``: each host's wrapper, by the nodes
    of its layouts: on how many different pages the slot has text, whether always the same,
    and its characters per page, all and in links.

    Pages of a host with the same layout and texts count once, so copies make no template.
    """
    # host and layout decide a page's number for its texts, so different layouts never fall together
    distinct = parsed.select("host", "layout", "digest", "nodes").dropDuplicates(["host", "layout", "digest"])
    distinct = stage(distinct, "distinct_pages")
    layouts = distinct.groupBy("host", "layout").agg(F.count("*").alias("n"))
    layouts = stage(layouts, "layouts")
    main = layouts.groupBy("host").agg(F.max_by("layout", F.struct("n", "layout")).alias("wrapper"), F.count("*").alias("n_layouts"))
    main = stage(main, "wrappers")
    aligned = join_per_key(layouts.select("host", "layout"), main, "host", "n_layouts").select("host", "layout", "wrapper")
    placed = stage(aligned.mapInArrow(_slot_batches, "host string, layout string, node int, slot string"), "slots")
    by_node = (
        distinct.select("host", "layout", F.explode("nodes").alias("x"))
        .select("host", "layout", "x.*")
        .groupBy("host", "layout", "node")
        .agg(
            F.count("*").alias("pages"), F.min("digest").alias("least"), F.max("digest").alias("most"),
            F.sum("chars").alias("chars"), F.sum("linked").alias("linked"),
        )
    )
    filled = placed.join(by_node, ["host", "layout", "node"])
    known = filled.groupBy("host", "slot").agg(
        F.sum("pages").alias("pages"),
        (F.min("least") == F.max("most")).alias("constant"),
        (F.sum("chars") / F.sum("pages")).alias("chars"),
        (F.sum("linked") / F.sum("pages")).alias("linked"),
    )
    return placed.join(known, ["host", "slot"]).select("host", "layout", "node", "slot", "pages", "constant", "chars", "linked")


def content_of_layouts(induced: DataFrame) -> DataFrame:
    """``(host, layout, content)``: the content nodes of each layout; one row per layout is gathered,
    which is as large as one page's tree."""
    gathered = induced.groupBy("host", "layout").agg(
        F.collect_list(F.struct("node", "pages", "constant", "chars", "linked")).alias("found")
    )
    return gathered.mapInArrow(_content_batches, "host string, layout string, content array<int>")


def extract(pages: DataFrame, id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """``(page_id, url, text)`` for each row of ``pages``: the blocks of the main text in page order,
    joined by line breaks.

    Null and empty pages, and pages without any text in a content slot, have an empty text.  Pages
    without a host in their URL, or without URL, are those of one host, ''.  Repeated rows and ids are
    rows like any other; copies of a page count once in the wrapper.  A host with fewer than
    ``MIN_CONSTANT`` different pages has no template beyond what elements say themselves.  Whole pages are
    taken whatever their length; an empty table gives an empty table; other columns are ignored.

    What is content is a small table by host and layout.  It is broadcast if it has less than
    ``BROADCAST_BYTES``, and otherwise joined in shares; both give the same rows.
    """
    parsed = parse_pages(pages, id, url, page)
    key = F.sha2(F.concat_ws("\n", "host", "layout"), 256).alias("key")
    content = stage(content_of_layouts(induce(parsed)).select(key, "content"), "content")
    size = content.agg(F.sum(F.size("content") * 4 + 100).alias("n")).first().n or 0
    rows = parsed.select("page_id", "url", "blocks", key)
    if size < BROADCAST_BYTES:
        joined = rows.join(F.broadcast(content), "key", "left")
    else:
        per_key = stage(parsed.groupBy(key).agg(F.count("*").alias("n_rows")), "pages_of_layouts")
        known = stage(per_key.join(content, "key", "left"), "content_of_pages")
        joined = join_per_key(rows, known, "key", "n_rows")
    main = F.filter("blocks", lambda block: F.array_contains(F.coalesce("content", F.array().cast("array<int>")), block["node"]))
    return joined.select("page_id", "url", F.array_join(main["text"], "\n").alias("text"))
