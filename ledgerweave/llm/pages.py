"""Main text of web pages by deducing each host's template.

A page is read as a sequence of tokens. A token's role is its path of elements from the
root, with their classes, so equal tags in different places differ. Over the pages of a
host, roles that occur equally often on each page share an occurrence vector and form
an equivalence class; a class is valid for a template if it has ``LEAST_PAGES`` pages,
covers all its host's pages and lies within the class above it. The class of the roles
that every page has once is the template's skeleton, classes nested in it are its
repeated parts. Text between the skeleton's tokens sits in slots: the slot with the
article is the one named as such or else the one with most text in blocks, apart from
parts that are named as something else. All of its blocks are the page's main text.

Occurrence vectors are never collected: they are compared by their support, their
total and two sums of page hashes weighted with the counts, which Spark adds up ahead
of its shuffle, so a host with a third of all pages is no heavier than its roles. Hosts
with fewer pages, and pages that lack their host's slot, are judged by the page alone.

Nulls: a null page has an empty text, a null url belongs to the host ''. Repeated pages
count each. Columns beside the named ones are not read. Malformed markup is read as
browsers do in outline: unclosed paragraphs and items end where the next begins.
"""

from __future__ import annotations

import html
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from .common import add_columns, column, map_batches, materialise

LEAST_PAGES = 3
# Elements by what browsers make of them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr br".split()
)
# What an element of a kind ends when it opens, up to the nearest of its bounds.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Elements and names of classes, ids and roles that hold no main text.
ASIDE = frozenset("nav header footer aside form button select dialog menu figure-ad".split())
ASIDE_NAMES = regex.compile(
    r"(?<![a-z])(ads?|advert\w*|banner|breadcrumbs?|comments?|comment-?list|cookies?|consent|disqus|footer|"
    r"header|masthead|menu|modal|nav|navbar|navigation|newsletter|notices?|pagination|popup|promo\w*|related|"
    r"replies|respond|share|sharing|sidebar|social|sponsor\w*|subscribe|toolbar|widget|contentinfo|"
    r"complementary|search)(?![a-z])",
    regex.IGNORECASE,
)
MAIN_NAMES = regex.compile(
    r"(?<![a-z])(article|main|content|post|entry|story)([-_]?(body|text|content))?(?![a-z])", regex.IGNORECASE
)
TAG = regex.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:\"[^\"]*+\"|'[^']*+'|[^'\">])*+)>",
    regex.DOTALL,
)
NAMED = regex.compile(r"(?<![-\w])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", regex.IGNORECASE)


class Node(NamedTuple):
    """An element: its path, whether it is a block, aside or named as the article."""

    name: str
    path: str
    block: bool
    aside: bool
    main: bool


ROOT = Node("", "", True, False, False)


def _node(above: Node, name: str, attributes: str) -> Node:
    labels = " ".join(a or b or c for _, a, b, c in NAMED.findall(attributes)) if "=" in attributes else ""
    own = f"{name}.{'.'.join(labels.split())}" if labels else name
    main = name in ("article", "main") or bool(labels and MAIN_NAMES.search(labels))
    aside = above.aside or name in ASIDE or bool(labels and not main and ASIDE_NAMES.search(labels))
    inline = name in INLINE and not aside
    return Node(name, f"{above.path}/{own}", not inline, aside, main and not aside)


def read_tokens(page: str) -> Iterator[tuple[Node, str | None]]:
    """Elements as they open (with None) and texts with the element they stand in.

    The white space that ``br`` stands for comes as a text.
    """
    stack = [ROOT]
    at, end = 0, len(page)
    while at < end:
        hit = TAG.search(page, at)
        if hit is None:
            yield stack[-1], page[at:]
            return
        if hit.start() > at:
            yield stack[-1], page[at : hit.start()]
        at = hit.end()
        closing, name = hit[1], (hit[2] or "").lower()
        if not name:
            continue  # a comment or declaration
        if closing:
            if any(node.name == name for node in stack):
                while stack.pop().name != name:
                    pass
            continue
        node = _node(stack[-1], name, hit[3])
        if node.block or name in ENDS:
            _end_implied(stack, name)
            node = _node(stack[-1], name, hit[3])
        yield node, None
        if name == "br":
            yield stack[-1], "\n"
        if name in VOID or hit[3].endswith("/"):
            continue
        if name in RAW:
            close = regex.compile(rf"</{regex.escape(name)}(?![\w-])[^>]*>", regex.IGNORECASE).search(page, at)
            at = close.end() if close else end
            continue
        stack.append(node)


def _end_implied(stack: list[Node], name: str) -> None:
    """End what the element ``name`` ends by opening: a paragraph, or its like."""
    ended, bounds = ENDS.get(name, ({"p"}, set()))
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].name in ended:
            del stack[i:]
            return
        if stack[i].name in bounds or (name not in ENDS and stack[i].block):
            return


def blocks_in(page: str, slot: str) -> list[str]:
    """The blocks of text below the elements with path ``slot``, without aside parts."""
    blocks: list[str] = []
    parts: list[str] = []
    current: str | None = None

    def flush() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            blocks.append(text)
        parts.clear()

    for node, text in read_tokens(page):
        inside = not node.aside and (node.path == slot or node.path.startswith(slot + "/"))
        if text is None:
            if node.block:
                flush()
            continue
        block = _block_path(node.path)
        if block != current:
            flush()
            current = block
        if inside:
            parts.append(text)
    flush()
    return blocks


def _block_path(path: str) -> str:
    """``path`` up to its last block."""
    while path:
        above, _, own = path.rpartition("/")
        if own.partition(".")[0] not in INLINE:
            return path
        path = above
    return path


def roles(page: str) -> dict[str, tuple[int, int, bool, bool]]:
    """Each role with its count, characters of text right in it, aside and main."""
    counts: Counter = Counter()
    chars: Counter = Counter()
    nodes: dict[str, Node] = {"": ROOT}
    for node, text in read_tokens(page):
        if text is None:
            counts[node.path] += 1
            nodes[node.path] = node
        elif not text.isspace():
            chars[_block_path(node.path)] += len(text)
    return {
        path: (counts[path], chars[path], node.aside, node.main) for path, node in nodes.items() if path
    }


def choose_slot(skeleton: list[tuple[str, int, bool, bool]]) -> str:
    """The article's slot among roles (path, characters, aside, main).

    The outermost role that is named as the article and holds text wins; without one,
    it is the deepest role that still holds most of the text outside aside parts.
    """
    usable = [(path, chars, main) for path, chars, aside, main in skeleton if not aside]
    below = {
        path: sum(c for other, c, _ in usable if other == path or other.startswith(path + "/"))
        for path, _, _ in usable
    }
    named = [path for path, _, main in usable if main and below[path]]
    articles = [path for path in named if path.rpartition("/")[2].partition(".")[0] in ("article", "main")]
    if named:
        return min(articles or named, key=lambda path: (-below[path], path.count("/"), path))
    total = sum(c for _, c, _ in usable)
    holding = [path for path in below if 2 * below[path] > total]
    return max(holding, key=lambda path: (path.count("/"), path), default="")


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))


def deduce_templates(pages: DataFrame) -> DataFrame:
    """Per host its template (host, skeleton, nested, slot) from ``pages`` (url, html).

    ``skeleton`` lists the roles every page has once, ``nested`` the classes of repeated
    roles below it, each a list of roles.
    """

    def start() -> Callable:
        def work(batch: pa.RecordBatch) -> dict:
            rows = [
                (host, page, path, *found)
                for host, page, text in zip(
                    column(batch, "host").to_pylist(),
                    column(batch, "page").to_pylist(),
                    column(batch, "html").to_pylist(),
                )
                for path, found in roles(text or "").items()
            ]
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
            names = ["host", "page", "path", "n", "chars", "aside", "main"]
            columns = list(zip(*rows)) or [[]] * len(names)
            return {name: pa.array(list(c), kind) for name, c, kind in zip(names, columns, kinds)}

        return work

    keyed = pages.select(host_of(F.col("url")).alias("host"), F.xxhash64("url", "html").alias("page"), "html")
    schema = "host string, page long, path string, n long, chars long, aside boolean, main boolean"
    low = F.lit((1 << 24) - 1)  # short hashes, so that sums stay within a long
    found = (
        map_batches(keyed, schema, start)
        .groupBy("host", "path")
        .agg(
            F.count("*").alias("support"),
            F.sum("n").alias("total"),
            F.sum(F.col("page").bitwiseAND(low) * F.col("n")).alias("vector_1"),
            F.sum(F.shiftright("page", 24).bitwiseAND(low) * F.col("n")).alias("vector_2"),
            F.sum("chars").alias("chars"),
            F.first("aside").alias("aside"),
            F.first("main").alias("main"),
        )
    )
    vector = ("support", "total", "vector_1", "vector_2")
    classes = found.groupBy("host", *vector).agg(
        F.sort_array(F.collect_list(F.struct("path", "chars", "aside", "main"))).alias("roles")
    )
    pages_of = keyed.groupBy("host").agg(F.count("*").alias("pages"))
    by_host = classes.groupBy("host").agg(F.collect_list(F.struct(*vector, "roles")).alias("classes"))
    return map_batches(
        by_host.join(pages_of, "host"),
        "host string, skeleton array<string>, nested array<array<string>>, slot string",
        lambda: _templates,
    )


def _templates(batch: pa.RecordBatch) -> dict:
    hosts = column(batch, "host").to_pylist()
    made = [
        template(classes, pages)
        for classes, pages in zip(column(batch, "classes").to_pylist(), column(batch, "pages").to_pylist())
    ]
    return {
        "host": pa.array(hosts, pa.string()),
        "skeleton": pa.array([m[0] for m in made], pa.list_(pa.string())),
        "nested": pa.array([m[1] for m in made], pa.list_(pa.list_(pa.string()))),
        "slot": pa.array([m[2] for m in made], pa.string()),
    }


def template(classes: list[dict], pages: int) -> tuple[list[str], list[list[str]], str | None]:
    """Skeleton, nested classes and article slot; no slot without enough pages."""
    if pages < LEAST_PAGES:
        return [], [], None
    once = next((c for c in classes if c["support"] == c["total"] == pages), None)
    if once is None:
        return [], [], None
    skeleton = [role["path"] for role in once["roles"]]
    inside = set(skeleton)
    nested = [
        paths
        for c in classes
        if c is not once
        for paths in [[role["path"] for role in c["roles"]]]
        if all(any(path.startswith(f"{top}/") for top in inside) for path in paths)
    ]
    # The text of repeated and optional parts counts for the skeleton's role above it.
    held = {path: 0 for path in skeleton}
    for c in classes:
        for role in c["roles"]:
            path = role["path"]
            while path and path not in held:
                path = path.rpartition("/")[0]
            if path and not role["aside"]:
                held[path] += role["chars"]
    slots = [(r["path"], held[r["path"]], r["aside"], r["main"]) for r in once["roles"]]
    return skeleton, sorted(nested), choose_slot(slots) or None


def main_text(page: str, slot: str | None) -> str:
    """The blocks of the page's article, one per line."""
    if slot:
        found = blocks_in(page, slot)
        if found:
            return "\n".join(found)
    own = [(path, chars, aside, main) for path, (_, chars, aside, main) in roles(page).items()]
    return "\n".join(blocks_in(page, choose_slot(own)))


def extract(df: DataFrame, templates: DataFrame | None = None) -> DataFrame:
    """``df`` (url, html, any others) with ``text``: each page's main text."""
    if templates is None:
        templates = deduce_templates(df)
    slots = materialise(templates.select(F.col("host").alias("_host"), F.col("slot").alias("_slot")))
    placed = df.join(slots, host_of(df["url"]) == slots["_host"], "left").drop("_host")

    def start() -> Callable:
        def work(batch: pa.RecordBatch) -> dict:
            pairs = zip(column(batch, "html").to_pylist(), column(batch, "_slot").to_pylist())
            return {"text": pa.array([main_text(page or "", slot) for page, slot in pairs], pa.string())}

        return work

    return add_columns(placed, StructType().add("text", StringType()), start).drop("_slot")
