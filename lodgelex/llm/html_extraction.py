"""Main text of web pages by equivalence-class template deduction.

1. Every page becomes a sequence of tokens: tags with their place (the open elements above them and
   their class or id), and the texts between them.  A token's occurrence vector says how often it
   occurs on each page of its host; copies of a page count as one page.
2. Tokens of a host with equal occurrence vectors are one equivalence class (A. Arasu and H.
   Garcia-Molina, "Extracting structured data from web pages", 2003).  A vector is never gathered:
   each page adds a hash of (page, count) to the token's sum, and equal sums are equal vectors.  So a
   host that holds a third of all pages costs one partial sum per token and task.
3. A class is valid if its tokens are on enough of the host's pages and, on a page, come in one order
   in every repetition.  Valid classes that lie inside the gaps of others nest; together they are the
   host's template.
4. The texts between template tokens are the slots.  Texts that are template tokens themselves
   (the same words on most pages of a host, and on nearly all that have the element they lie in) are
   furniture where a page has other slots; a page of nothing else keeps them.  A slot counts as main
   text by the elements it is nested in: the page's article, or else its main element, or else its
   body, without menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
   comments.
"""

from __future__ import annotations

import hashlib
import html
import re
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgelex.llm.common import saved

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Share of a host's pages that a template token is on, and pages a host needs for a template.
LEAST_SHARE = 0.5
LEAST_PAGES = 3
#: Of the pages that have the element a text lies in, the share that must have the text as well.
SLOT_SHARE = 0.85
#: Occurrences that a task sums up before it reports them.
REPORT_ROWS = 200_000
#: Numbers that contents are hashed to, to tell those that may repeat.
COARSE = 1 << 16

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")

# Element names of the format.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math object".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: An element that a start tag of the second kind closes when it is open.
CLOSED_BY = {
    "p": frozenset(
        "address article aside blockquote details div dl fieldset figcaption figure footer form h1 "
        "h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
    ),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option", "optgroup"]),
}
FURNITURE_TAGS = frozenset(
    "nav header footer aside form button select script style noscript template textarea iframe svg "
    "math object head title menu dialog datalist input".split()
)
FURNITURE_WORDS = (
    r"ads?|adverts?|advertis\w*|banner|sponsor\w*|promo\w*|menus?|nav|navbar|navigation|"
    r"breadcrumbs?|sidebars?|widgets?|cookies?|consent|gdpr|notices?|popup|modal|overlay|newsletter|"
    r"subscribe|subscription|share|sharing|social|related|recommend\w*|comments?|replies|respond|"
    r"disqus|pagination|pager|login|signup|footer"
)
OUTSIDE_WORDS = r"header|masthead|toolbar|search|copyright|legal|disclaimer|tags?|toc"
MARKED = re.compile(rf"(?:^|[\s_-])(?:{FURNITURE_WORDS})(?:$|[\s_-]|\d)", re.I)
MARKED_OUTSIDE = re.compile(
    rf"(?:^|[\s_-])(?:{FURNITURE_WORDS}|{OUTSIDE_WORDS})(?:$|[\s_-]|\d)", re.I
)
FURNITURE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split()
)


class Node:
    """An open element: its tag, its place, whether it is furniture."""

    __slots__ = ("name", "place", "furniture", "kind")

    def __init__(self, name: str, place: int, furniture: bool, kind: str):
        self.name, self.place, self.furniture, self.kind = name, place, furniture, kind


def stable(*parts) -> int:
    """A signed 64-bit hash that is the same in every process."""
    data = "\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


_places: dict[tuple, int] = {}


def _place(*parts) -> int:
    """``stable`` with a bounded memory."""
    if parts not in _places:
        if len(_places) > 100_000:
            _places.clear()
        _places[parts] = stable(*parts)
    return _places[parts]


def furniture(name: str, marks: str, role: str, hidden: bool, inside: str) -> bool:
    """Whether an element holds no main text.  ``inside``: body, main or article; an article's own
    header belongs to it."""
    if hidden or role in FURNITURE_ROLES:
        return True
    if name == "header":
        return inside != "article"
    if name in FURNITURE_TAGS:
        return True
    if name in ("html", "body", "main", "article"):
        return False
    names = MARKED if inside == "article" else MARKED_OUTSIDE
    return bool(marks and names.search(marks))


class Item:
    """One token of a page: a tag or a text, with what it is nested in.  ``holder``: the code of the
    start tag that a text lies in, 0 for tags and for texts outside all elements."""

    __slots__ = ("code", "text", "breaks", "furniture", "region", "holder")

    def __init__(self, code, text, breaks, is_furniture, region, holder=0):
        self.code, self.text, self.breaks = code, text, breaks
        self.furniture, self.region, self.holder = is_furniture, region, holder


def tokens(page: str) -> list[Item]:
    """The page's tokens in order.  ``breaks``: the token ends a block.  ``region``: 0 none, 1 body,
    2 main, 3 article.  Unclosed and misplaced tags are closed as a browser would close them."""
    out: list[Item] = []
    stack: list[Node] = [Node("", 0, False, "body")]
    at, size = 0, len(page)
    regions = {"body": 1, "main": 2, "article": 3}

    def text(raw: str, decode: bool = True) -> None:
        if not raw:
            return
        value = html.unescape(raw) if decode and "&" in raw else raw
        top = stack[-1]
        known = " ".join(value.split())
        code = stable(top.place, "#", known) if known else 0
        holder = _place(top.place, "") if len(stack) > 1 else 0
        out.append(Item(code, value, False, top.furniture, regions[top.kind], holder))

    def tag(name: str, sign: str, place: int) -> None:
        top = stack[-1]
        out.append(
            Item(_place(place, sign), None, name not in INLINE, top.furniture, regions[top.kind])
        )

    while at < size:
        found = TOKEN.search(page, at)
        if not found:
            text(page[at:])
            break
        text(page[at : found.start()])
        at = found.end()
        if found["cdata"] is not None:
            text(found["cdata"], decode=False)
            continue
        if not found["name"]:
            continue
        name = found["name"].lower()
        if found["close"]:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name), 0)
            if depth:
                place = stack[depth].place
                del stack[depth:]
                tag(name, "/", place)
            elif name == "p":
                tag(name, "/", 0)
            continue
        while len(stack) > 1 and name in CLOSED_BY.get(_open_block(stack), ()):
            depth = next(i for i in range(len(stack) - 1, 0, -1) if stack[i].name in CLOSED_BY)
            place, closed = stack[depth].place, stack[depth].name
            del stack[depth:]
            tag(closed, "/", place)
        rest = found["rest"]
        marks, role, hidden = "", "", False
        if "=" in rest or "hidden" in rest:
            values = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(rest)}
            marks = " ".join(values[k] for k in ("class", "id") if k in values)
            role = values.get("role", "").lower()
            hidden = values.get("aria-hidden") == "true" or bool(
                re.search(r"display\s*:\s*none", values.get("style", ""))
            ) or bool(re.search(r"(?:^|\s)hidden(?:$|\s|=)", ATTRIBUTE.sub(" ", rest)))
        top = stack[-1]
        place = _place(top.place, name, marks, role)
        if name in VOID or rest.endswith("/"):
            tag(name, "", place)
            if name == "br":
                text(" ")
            continue
        kind = name if name in ("main", "article") else top.kind
        if role in ("main", "article"):
            kind = role
        if top.kind == "article":
            kind = "article"
        inside = top.furniture or furniture(name, marks, role, hidden, top.kind)
        stack.append(Node(name, place, inside, kind))
        tag(name, "", place)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            stop = end.start() if end else size
            if name in ("title", "textarea"):
                text(page[at:stop])
            at = stop
    return out


def _open_block(stack: list[Node]) -> str:
    """The innermost open element that a start tag may close; nothing beyond a container."""
    for node in reversed(stack):
        if node.name in CLOSED_BY:
            return node.name
        if node.name not in INLINE:
            return ""
    return ""


def host_of(url: str = "url"):
    text = F.coalesce(F.col(url), F.lit(""))
    at = F.locate("://", text)
    rest = F.when(at > 0, F.substr(text, at + 3)).otherwise("")
    return F.lower(F.regexp_extract(rest, r"\A[^/?#]*", 0))


def _pages(batch: pa.RecordBatch, name: str) -> Iterator[str]:
    for value in batch.column(name):
        yield value.as_py() or ""


def distinct_contents(pages: DataFrame) -> DataFrame:
    """One row for each html of a host.  ``pages``: host, page_key (a hash of the html), html.

    Only what may repeat is shuffled: at most ``COARSE`` numbers of repeated contents are broadcast.
    """
    number = F.pmod(F.xxhash64("host", "page_key"), F.lit(COARSE))
    repeated = pages.groupBy("host", "page_key").agg(F.count("*").alias("copies")).where("copies > 1")
    numbers = F.broadcast(saved(repeated.select(number.alias("number")).distinct(), "copies"))
    once = pages.join(numbers, number == F.col("number"), "left_anti")
    often = pages.join(numbers, number == F.col("number"), "left_semi")
    return once.unionByName(often.dropDuplicates(["host", "page_key"]))


def deduce(pages: DataFrame, least_share: float, least_pages: int) -> DataFrame:
    """``host, template``: the template as an array of (code, class).  ``pages``: host, page_key, html.

    A class is named by the hash of its occurrence vector.  A text is a template token only if it is
    on ``SLOT_SHARE`` of the pages with the element that it lies in: otherwise it is one value of a
    slot among others.
    """

    def report(found: list[tuple]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.string(), *[pa.int64()] * 5)
        columns = [pa.array(list(c), k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)]
        grouped = pa.table(columns, names=["host", "code", "vector", "pages", "n", "holder"]).group_by(
            ["host", "code"]
        ).aggregate([("vector", "sum"), ("pages", "sum"), ("n", "max"), ("n", "min"), ("holder", "max")])
        names = ["host", "code", "vector", "pages", "most", "least", "holder"]
        yield from grouped.rename_columns(names).combine_chunks().to_batches()

    def holder_of(item: Item) -> int | None:
        return None if item.text is None else item.holder

    def count(batches):
        found: list[tuple] = []
        for batch in batches:
            hosts, keys = batch.column("host").to_pylist(), batch.column("page_key").to_pylist()
            for host, key, page in zip(hosts, keys, _pages(batch, "html"), strict=True):
                found.append((host, 0, 0, 1, 0, None))
                seen = Counter((item.code, holder_of(item)) for item in tokens(page) if item.code)
                for (code, holder), n in seen.items():
                    found.append((host, code, stable(key, n) >> 8, 1, n, holder))
                if len(found) > REPORT_ROWS:
                    yield from report(found)
                    found = []
        if found:
            yield from report(found)

    counted = (
        distinct_contents(pages).mapInArrow(
            count,
            "host string, code long, vector long, pages long, most long, least long, holder long",
        )
        .groupBy("host", "code")
        .agg(
            F.sum(F.col("vector").cast("decimal(38,0)")).alias("vector"),
            F.sum("pages").alias("pages"), F.max("most").alias("most"), F.min("least").alias("least"),
            F.max("holder").alias("holder"),
        )
        .where(F.col("pages") >= least_pages)
    )
    counted = saved(counted, "occurrences")
    totals = counted.where("code = 0").select(F.col("host").alias("h"), F.col("pages").alias("all"))
    frequent = counted.where("code != 0").join(totals, F.col("host") == F.col("h")).where(
        F.col("pages") >= least_share * F.col("all")
    )
    # A text outside all elements has code 0, that of the page, for its holder.
    held = counted.where("holder is null").select(
        F.col("host").alias("h"), F.col("code").alias("c"), F.col("pages").alias("around")
    )
    constant = frequent.where("holder is not null").drop("h").join(
        held, (F.col("host") == F.col("h")) & (F.col("holder") == F.col("c"))
        & (F.col("pages") >= SLOT_SHARE * F.col("around")), "left_semi",
    )
    tags = frequent.where("holder is null").drop("h")
    named = tags.unionByName(constant).select(
        "host", "code", F.xxhash64("vector", "pages", "most", "least").alias("class")
    )
    # Bounded: a host has at most 1 / least_share times the tokens of its average page.
    gathered = named.groupBy("host").agg(
        F.sort_array(F.collect_list(F.struct("code", "class"))).alias("template")
    )
    return saved(gathered, "templates")


def classes_on(items: list[Item], template: dict[int, int]) -> list[int]:
    """The class of each item that belongs to a valid class of this page, 0 for the others.

    On the page, a class's tokens must come in one order in every repetition, and the spans of two
    classes must be nested or apart; a class that breaks this is not valid here, the larger one of
    two that cross stays.
    """
    orders: dict[int, list[int]] = {}
    for i, item in enumerate(items):
        if (name := template.get(item.code, 0)):
            orders.setdefault(name, []).append(i)
    valid = {}
    for name, places in orders.items():
        codes = [items[i].code for i in places]
        width = len(set(codes))
        if len(codes) % width == 0 and codes == codes[:width] * (len(codes) // width):
            valid[name] = places
    spans = sorted((p[0], -p[-1], -len(p), name) for name, p in valid.items())
    open_until: list[tuple[int, int]] = []
    for first, last, _, name in spans:
        last = -last
        while open_until and open_until[-1][0] < first:
            open_until.pop()
        if open_until and last > open_until[-1][0]:
            other = open_until[-1][1]
            worse = name if len(valid[name]) <= len(valid[other]) else other
            valid.pop(worse)
            if worse == name:
                continue
            open_until.pop()
        open_until.append((last, name))
    out = [0] * len(items)
    for name, places in valid.items():
        for i in places:
            out[i] = name
    return out


def extract(page: str, template: dict[int, int]) -> str:
    """The main text: the slots that are left, block by block.

    Where the template takes all texts of the innermost region, they are the page's content and stay,
    with the slots of the next region.
    """
    items = tokens(page)
    classes = classes_on(items, template) if template else [0] * len(items)
    texts = [
        (i, item) for i, item in enumerate(items)
        if item.text is not None and item.code and not item.furniture
    ]
    slots = [(i, item) for i, item in texts if not classes[i] or item.region == 3]
    inner = max((item.region for _, item in texts), default=0)
    region = max((item.region for _, item in slots), default=0)
    wanted = {i for i, item in slots if item.region == region}
    if region < inner:
        wanted |= {i for i, item in texts if item.region == inner}
    blocks, open_block = [], []
    for i, item in enumerate(items):
        if item.text is not None:
            # White space between inline elements belongs to the block it stands in.
            if i in wanted or (not item.code and open_block):
                open_block.append(item.text)
        elif item.breaks:
            blocks.append("".join(open_block))
            open_block = []
    blocks.append("".join(open_block))
    return "\n".join(b for b in (" ".join(b.split()) for b in blocks) if b)


def main_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_share: float = LEAST_SHARE,
    least_pages: int = LEAST_PAGES,
) -> DataFrame:
    """Per row: page_id, url, text and n_chars (code points).

    Null or empty html has the empty text.  Urls without a host share the empty host.  A host with
    fewer than ``least_pages`` pages has no template: its slots are all texts, judged by the elements
    they are nested in.  Repeated rows are rows of the result, but count as one page of the host.
    """
    base = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host_of(url_col).alias("host"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
    )
    templates = deduce(
        base.select("host", F.xxhash64("html").alias("page_key"), "html"),
        least_share, least_pages,
    )
    joined = base.join(templates, "host", "left")
    kind = base.schema["page_id"].dataType.simpleString()

    def run(batches):
        held: dict[str, dict[int, int]] = {}
        for batch in batches:
            texts = []
            hosts = batch.column("host").to_pylist()
            for row, page in enumerate(_pages(batch, "html")):
                if hosts[row] not in held:
                    if len(held) > 256:
                        held.clear()
                    pairs = batch.column("template")[row].as_py() or []
                    held[hosts[row]] = {p["code"]: p["class"] for p in pairs}
                texts.append(extract(page, held[hosts[row]]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array(np.fromiter(map(len, texts), np.int64, len(texts)))],
                names=["page_id", "url", "text", "n_chars"],
            )

    return joined.select("page_id", "url", "host", "html", "template").mapInArrow(
        run, f"page_id {kind}, url string, text string, n_chars long"
    )
