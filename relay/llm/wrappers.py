"""Main text of web pages by wrapper induction.

1. Every page is parsed into a DOM tree. Siblings of one kind in a row (paragraphs,
   list items) are one slot, which gives the page a skeleton of few nodes.
2. Per host, the most frequent skeleton is the wrapper. Every other skeleton of the
   host is aligned with it by simple tree matching: the largest set of node pairs that
   keeps parents and the order of siblings.
3. The texts of aligned slots are counted over the distinct pages of a host by aggregates;
   pages with the same blocks count once. A text that stands in its slot on MOST of the
   pages that have the slot, on CONSTANT_PAGES pages at least and on HOST_SHARE of the
   host, is template; all other texts are content. In marked main parts a text must stand
   on MAIN_PAGES pages and MAIN_SHARE of the host, and headings are never template.
4. Content blocks are joined. Blocks inside navigation, headers, footers, asides,
   forms, scripts, adverts, notices or comments are no content by their markup,
   whether they vary or not; where a page marks an article or main part, only what is
   in there can be content.

Broken markup is read as browsers do: missing end tags are implied, stray ones are
left out, scripts and styles end at their own end tag. A null or empty page has an
empty text; a page without url has no host and is read by its markup alone; pages
that repeat are separate rows. Whole pages are read; only the skeletons and slot
hashes are shuffled, and a host with very many pages is summed up before it is.
"""

from __future__ import annotations

import functools
import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relay.llm import words
from relay.session import ship, stage

CONSTANT_PAGES = 3
MOST = 0.9
HOST_SHARE = 0.25
MAIN_PAGES = 5
MAIN_SHARE = 0.5

HEADING = re.compile(r"/h[1-6](?![a-z0-9])[^/]*$")

# Elements of HTML by what they do.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math xmp noembed noframes object".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby "
                   "s samp small span strike strong sub sup time tt u var wbr".split())
NO_CONTENT = frozenset("nav header footer aside form button select option input menu dialog fieldset legend datalist "
                       "head canvas audio video".split())
ENDS_PARAGRAPH = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 "
                           "h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
ENDS_OWN_KIND = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
                 "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
                 "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th")}
STOPS = frozenset("ul ol dl table div article section main body td th select nav aside".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form".split())
MARKS = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert|adverts|advertisement|banner|sponsor|sponsored|promo|promotion|nav|navbar|"
    r"navigation|menu|breadcrumb|breadcrumbs|header|masthead|footer|sidebar|side|widget|notice|notices|cookie|cookies|"
    r"consent|gdpr|alert|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|comment|comments|reply|"
    r"replies|respond|disqus|discussion|share|sharing|social|related|recommended|pagination|pager|toolbar|skip|"
    r"disclaimer|copyright)(?:$|[\s_-])", re.I)
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
MAIN = frozenset(("article", "main"))

TAG = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|"
                 r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|itemprop)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
BLANKS = re.compile(r"\s+")


# Signs that write skeletons do not stand in keys.
CLEAN = str.maketrans("();/", "____")


class Node:
    __slots__ = ("tag", "key", "children", "drop", "main", "parts")

    def __init__(self, tag: str, key: str, drop: bool, main: bool):
        self.tag, self.key, self.drop, self.main = tag, key, drop, main
        self.children: list[Node] = []
        self.parts: list = []


@functools.lru_cache(maxsize=50_000)
def marked(tag: str, attributes: str) -> tuple[str, bool]:
    """What tells a node from others (tag, class, id), and if its markup rules it out."""
    if not attributes or attributes.isspace():
        return tag, tag in NO_CONTENT
    key, drop = tag, tag in NO_CONTENT
    if "=" not in attributes:
        return key, drop or "hidden" in attributes.lower().split()
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").strip()
        if name in ("class", "id"):
            if name == "class" or not any(c.isdigit() for c in value):
                key += f".{value}"
            drop = drop or tag not in ("html", "body", *MAIN) and bool(MARKS.search(CAMEL.sub("-", value)))
        elif name == "role":
            drop = drop or value.lower() in ROLES
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            drop = True
    return key.translate(CLEAN), drop


def parse(page: str) -> Node:
    """The DOM tree of a page. Texts stand among the parts of their node."""
    root = Node("", "", False, False)
    stack = [root]
    at, raw = 0, None
    for match in TAG.finditer(page):
        if match.start() < at:
            continue
        if match.start() > at:
            stack[-1].parts.append(page[at:match.start()])
        at = match.end()
        name = match[2]
        if name is None:
            continue
        name = name.lower()
        if match[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == name:
                    del stack[depth:]
                    break
                if name in INLINE and stack[depth].tag not in INLINE:
                    break
            continue
        if name in RAW:
            end = re.compile(f"</{re.escape(name)}(?=[\\s/>])[^>]*>?", re.I).search(page, at)
            if not match[3].endswith("/") or name in ("script", "style", "title"):
                at = end.end() if end else len(page)
            continue
        if name in ENDS_PARAGRAPH:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == "p":
                    del stack[depth:]
                    break
                if stack[depth].tag in STOPS:
                    break
        ended = ENDS_OWN_KIND.get(name)
        if ended:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in ended:
                    del stack[depth:]
                    if name != "tr" and name not in ("tbody", "tfoot"):
                        break
                elif stack[depth].tag in STOPS:
                    break
        key, drop = marked(name, match[3])
        above = stack[-1]
        if name in ("header", "footer") and above.main and not above.drop and name == "header":
            drop = False  # the head of an article holds its title; other parts are judged by themselves
        node = Node(name, key, above.drop or drop, above.main or name in MAIN)
        above.children.append(node)
        above.parts.append(node)
        if name not in VOID and not match[3].endswith("/"):
            stack.append(node)
    if at < len(page):
        stack[-1].parts.append(page[at:])
    return root


def skeleton(node: Node) -> tuple:
    """(key, children), with siblings of one kind in a row as one; inline nodes, which
    are part of the text, are left out."""
    out: list[tuple] = []
    for child in node.children:
        if child.tag in INLINE:
            continue
        own = skeleton(child)
        if out and out[-1][0] == own[0]:
            out[-1] = merge(out[-1], own)
        else:
            out.append(own)
    return node.key, tuple(out)


def merge(a: tuple, b: tuple) -> tuple:
    """Two siblings of one kind as one: the children of both, each kind once."""
    keys = {x[0]: i for i, x in enumerate(a[1])}
    children = list(a[1])
    for child in b[1]:
        if child[0] in keys:
            children[keys[child[0]]] = merge(children[keys[child[0]]], child)
        else:
            keys[child[0]] = len(children)
            children.append(child)
    return a[0], tuple(children)


def write(shape: tuple) -> str:
    return f"{shape[0]}({''.join(map(write, shape[1]))})" if shape[1] else f"{shape[0]};"


def blocks(root: Node) -> list[tuple[str, str, bool, bool]]:
    """(slot, text, ruled out, in a main part) of every block of text, in page order.
    A slot is the path of keys from the root."""
    out: list[list] = []

    def flush(path: str, node: Node, pieces: list[str]) -> None:
        text = BLANKS.sub(" ", entities.unescape("".join(pieces))).strip()
        pieces.clear()
        if text:
            out.append((path, text, node.drop, node.main))

    # Iterative, as broken pages can nest very deeply.
    todo: list[tuple] = [("node", "", root)]
    pieces: list[str] = []
    place: list[tuple[str, Node]] = []
    while todo:
        kind, path, what = todo.pop()
        if kind == "end":
            flush(*place.pop(), pieces)
            continue
        if kind == "text":
            pieces.append(what)
            continue
        if what.tag in INLINE and place and not what.drop:
            if what.tag == "br":
                pieces.append(" ")
            for part in reversed(what.parts):
                todo.append(("text", path, part) if isinstance(part, str) else ("node", path, part))
            continue
        if place:
            flush(*place[-1], pieces)
        own = f"{path}/{what.key}"
        place.append((own, what))
        todo.append(("end", own, what))
        for part in reversed(what.parts):
            todo.append(("text", own, part) if isinstance(part, str) else ("node", own, part))
    return out


def paths(shape: tuple, above: str = "") -> list[str]:
    own = f"{above}/{shape[0]}"
    return [own] + [p for child in shape[1] for p in paths(child, own)]


def match_trees(a: tuple, b: tuple) -> dict[str, str]:
    """Simple tree matching of two skeletons: slots of `a` with their slots in `b`."""
    sizes: dict[tuple[int, int], tuple[int, list]] = {}

    def size(x: tuple, y: tuple) -> int:
        if x[0] != y[0]:
            return 0
        key = (id(x), id(y))
        if key not in sizes:
            xs, ys = x[1], y[1]
            table = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
            for i, c in enumerate(xs):
                for j, d in enumerate(ys):
                    table[i + 1][j + 1] = max(table[i][j + 1], table[i + 1][j], table[i][j] + size(c, d))
            sizes[key] = (table[-1][-1] + 1, table)
        return sizes[key][0]

    found: dict[str, str] = {}

    def trace(x: tuple, y: tuple, above_x: str, above_y: str) -> None:
        if not size(x, y):
            return
        own_x, own_y = f"{above_x}/{x[0]}", f"{above_y}/{y[0]}"
        found[own_x] = own_y
        table, i, j = sizes[id(x), id(y)][1], len(x[1]), len(y[1])
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                trace(x[1][i], y[1][j], own_x, own_y)

    trace(a, b, "", "")
    return found


def unwrite(text: str) -> tuple:
    """A skeleton from its written form."""
    stack: list[tuple[str, list]] = [("", [])]
    for key, mark in re.findall(r"([^();]*)([();])", text):
        if mark == "(":
            stack.append((key, []))
        elif mark == ";":
            stack[-1][1].append((key, ()))
        else:
            name, children = stack.pop()
            stack[-1][1].append((name, tuple(children)))
    return stack[0][1][0]


def read(page: str | None) -> tuple[str, list[tuple[str, str, bool, bool]]]:
    root = parse(page or "")
    level = [root]
    for _ in range(60):
        level = [c for node in level for c in node.children]
        if not level:
            break
    for node in level:  # deeper nodes keep their text, but do not shape the skeleton
        node.children = []
    return write(skeleton(root)), blocks(root)


@functools.lru_cache(maxsize=50_000)
def slot_id(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def read_pages(pages: DataFrame) -> DataFrame:
    """Per page: its host, skeleton, and blocks that markup does not rule out."""
    ship(pages.sparkSession)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, "html"):
                shapes, slots, texts, hashes, offsets = [], [], [], [], [0]
                contents, own_slots, own_texts, own_mains, own_offsets = [], [], [], [], [0]
                for page in part.column("html").to_pylist():
                    shape, found = read(page)
                    shapes.append(shape)
                    kept = [b for b in found if not b[2]]
                    own: dict[tuple[int, int | None, bool], None] = {}
                    for slot, text, _, main in [b for b in kept if b[3]] or kept:
                        slots.append(slot_id(slot))
                        texts.append(text)
                        hashes.append(xxhash.xxh64_intdigest(text) - (1 << 63))
                        if not (main and HEADING.search(slot)):
                            own[slots[-1], None, main] = own[slots[-1], hashes[-1], main] = None
                    contents.append(xxhash.xxh64_intdigest(repr((slots[offsets[-1]:], hashes[offsets[-1]:]))) - (1 << 63))
                    offsets.append(len(slots))
                    own_slots += [x[0] for x in own]
                    own_texts += [x[1] for x in own]
                    own_mains += [x[2] for x in own]
                    own_offsets.append(len(own_slots))
                blocks_ = pa.StructArray.from_arrays(
                    [pa.array(slots, pa.int64()), pa.array(texts, pa.string()), pa.array(hashes, pa.int64())],
                    ["slot", "text", "hash"])
                seen = pa.StructArray.from_arrays(
                    [pa.array(own_slots, pa.int64()), pa.array(own_texts, pa.int64()), pa.array(own_mains, pa.bool_())],
                    ["slot", "text", "main"])
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), part.column("host"), pa.array(shapes, pa.string()),
                     pa.array([slot_id(s) for s in shapes], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), blocks_), pa.array(contents, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(own_offsets, pa.int32()), seen)],
                    ["page_id", "url", "host", "shape", "shape_id", "blocks", "content", "slots"])

    host = F.nullif(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    return pages.select("page_id", "url", host.alias("host"), "html").mapInArrow(
        run, "page_id long, url string, host string, shape string, shape_id long, "
             "blocks array<struct<slot: long, text: string, hash: long>>, content long, "
             "slots array<struct<slot: long, text: long, main: boolean>>")


def facts(found: DataFrame) -> DataFrame:
    """What the wrappers are induced from, for every distinct page of a host: skeleton, the
    slots it has (text null), and the hashes of the texts in them, each once."""
    return (found.filter("host IS NOT NULL").groupBy("host", "shape_id", "content")
            .agg(F.any_value("shape").alias("shape"), F.any_value("slots").alias("slots"))
            .select("host", "shape_id", "shape", "slots"))


def templates(known: DataFrame) -> DataFrame:
    """host, shape_id and the texts by slot that are template in pages of that skeleton, from a
    stored table of facts."""
    shapes = known.groupBy("host", "shape_id").agg(F.count("*").alias("pages"), F.min("shape").alias("shape"))
    wrapper = shapes.groupBy("host").agg(
        F.max_by("shape", F.struct("pages", "shape_id")).alias("wrapper"), F.count("*").alias("kinds"))
    pairs = shapes.join(wrapper, "host").select("host", "shape_id", "shape", "wrapper")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            host, shape_id, slot, same = [], [], [], []
            for h, i, shape, wrapper_ in zip(*(c.to_pylist() for c in batch.columns)):
                for own, other in match_trees(unwrite(shape), unwrite(wrapper_)).items():
                    host.append(h)
                    shape_id.append(i)
                    slot.append(slot_id(own))
                    same.append(slot_id(other))
            yield pa.RecordBatch.from_arrays(
                [pa.array(host, pa.string()), *(pa.array(c, pa.int64()) for c in (shape_id, slot, same))],
                ["host", "shape_id", "slot", "same"])

    aligned = pairs.mapInArrow(run, "host string, shape_id long, slot long, same long")
    texts = known.select("host", "shape_id", F.explode("slots").alias("b")).select(
        "host", "shape_id", "b.slot", "b.text", "b.main")
    # Counts come first per skeleton, then per aligned slot; both combine before the shuffle.
    each = texts.groupBy("host", "shape_id", "slot", "text").agg(F.count("*").alias("n"), F.max("main").alias("main"))
    each = each.join(aligned, ["host", "shape_id", "slot"])
    same = each.groupBy("host", "same", "text").agg(F.sum("n").alias("n"), F.max("main").alias("main"))
    have = same.filter("text IS NULL").select("host", "same", F.col("n").alias("have"))
    total = shapes.groupBy("host").agg(F.sum("pages").alias("total"))
    constant = (same.filter(f"text IS NOT NULL AND n >= {CONSTANT_PAGES}").join(have, ["host", "same"])
                .filter(f"n >= {MOST} * have").join(total, "host")
                .filter(f"n >= {HOST_SHARE} * total AND (NOT main OR n >= {MAIN_PAGES} AND n >= {MAIN_SHARE} * total)")
                .select("host", "same", "text"))
    return (aligned.join(constant, ["host", "same"]).groupBy("host", "shape_id")
            .agg(F.collect_set(F.struct("slot", "text")).alias("template")))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and the main text of every page, blocks joined by line feeds."""
    found = read_pages(pages)
    # Pages are read twice: to induce the wrappers, and to take the content out.
    template = stage(templates(stage(facts(found), "page-facts")), "wrappers").select(
        F.col("host").alias("_host"), F.col("shape_id").alias("_shape"), "template")
    own = lambda b: F.struct(b["slot"].alias("slot"), b["hash"].alias("text"))
    content = F.filter("blocks", lambda b: F.coalesce(~F.array_contains("template", own(b)), F.lit(True)))
    return (found.select("page_id", "url", "host", "shape_id", "blocks")
            .join(template, (F.col("host") == F.col("_host")) & (F.col("shape_id") == F.col("_shape")), "left")
            .select("page_id", "url", F.array_join(F.transform(content, lambda b: b["text"]), "\n").alias("text")))
