"""Main text of web pages: containers scored per page, their generalised paths voted on per host, then extracted by path."""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from solvind.llm.common import stored

LEAST_SHARE = 0.02  # of a host's votes that a path needs, so that a host has at most 50 paths
LONGEST_PATH = 400  # characters
MERGED_SHARE = 0.1  # of a host's votes with which a path is taken beside one that stands elsewhere in the page
VOTING_SHARE = 0.5  # of a page's best score that a container needs to be voted for

# Element names by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script style noscript template textarea title iframe svg select object canvas"
TO_THE_END = frozenset("script style textarea title iframe".split())  # without an end tag these take the rest of the page
FOREIGN = frozenset(("svg", "math"))  # may close themselves
DROPPED = frozenset("nav header footer aside form button dialog menu label fieldset datalist option".split())
BLOCKS = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4"
    " h5 h6 head header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
ROOT = "#"  # the page as a whole
CONTAINERS = frozenset(f"{ROOT} html body main article section div td center".split())
NAMED = re.compile(
    r"(?:^|[-_\s])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner\w*|cookie\w*|consent|gdpr|notices?|alerts?|menu\w*|nav|navbar|navigation"
    r"|breadcrumbs?|side|sidebar\w*|widgets?|related|recommend\w*|share|sharing|social|comments?|commentlist|disqus|repl(?:y|ies)|respond"
    r"|footer|header|masthead|newsletter|subscri\w*|signup|login|search|popup|modal|overlay|pagination|pager|toolbar|skip)(?:$|[-_\s\d])",
    re.I,
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HEADING_WORDS = re.compile(r"header|masthead|banner|title|alert|notice", re.I)  # say of a heading only that it is one
ROLES = frozenset("navigation banner contentinfo complementary search alert dialog menu menubar form".split())

_RAW_TAG = rf"<(?P<raw>{RAW.replace(' ', '|')})(?=[\s/>])[^>]*+>"
_RAW_END = {name: re.compile(rf"</{name}\s*+>", re.I) for name in RAW.split()}
TOKEN = re.compile(
    rf"<!--(?s:.*?)(?:-->|\Z)|{_RAW_TAG}|<[!?][^>]*+>?"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attributes>(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>|<(?P<broken>/?[a-zA-Z][^>]*+)>",
    re.I,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
ENDS_PARAGRAPH = BLOCKS - {"br", "html", "body", "head"}


@dataclass
class Node:
    """An open or closed element. `keep` is false inside anything that is not part of an article."""

    name: str
    path: str
    keep: bool
    holder: int  # number of the nearest container, itself if it is one
    parent: int  # number of the container around `holder`
    linked: bool = False
    article: bool = False  # in an article
    titled: bool = False  # in the header of a kept article
    score: float = 0.0


@dataclass
class Page:
    nodes: list[Node] = field(default_factory=list)
    #: (number of the container around it, its text) of each kept block, in page order
    blocks: list[tuple[int, str]] = field(default_factory=list)

    def best(self) -> float:
        return max((node.score for node in self.nodes), default=0.0)


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(text)} if "=" in text else {}


def parse(source: str) -> Page:
    """Blocks of text with the containers around them. Tags may be unclosed or misplaced; scripts and comments go."""
    page = Page([Node(ROOT, "", True, 0, 0)])
    stack = [0]
    text: list[str] = []
    own = linked = 0

    def close_block() -> None:
        nonlocal own, linked
        line = " ".join("".join(text).split())
        text.clear()
        if line:
            number = page.nodes[stack[-1]].holder
            weight = own - linked
            page.nodes[number].score += weight
            page.nodes[page.nodes[number].parent].score += weight / 2 if page.nodes[number].parent != number else 0
            page.blocks.append((number, line))
        own = linked = 0

    def add(piece: str) -> None:
        nonlocal own, linked
        node = page.nodes[stack[-1]]
        if node.keep and piece:
            text.append(html.unescape(piece))
            own += len(piece)
            linked += len(piece) * node.linked

    at = 0
    named: set[str] = set()  # elements that were opened so far
    unended: set[str] = set()  # elements that have no end tag from here on
    while token := TOKEN.search(source, at):
        add(source[at : token.start()])
        at = token.end()
        name = token["name"]
        if token["raw"]:
            raw = token["raw"].lower()
            if not (raw in FOREIGN and token[0].endswith("/>")):
                end = None if raw in unended else _RAW_END[raw].search(source, at)
                if end:
                    at = end.end()
                else:
                    unended.add(raw)
                    at = len(source) if raw in TO_THE_END else at
            if raw != "svg":
                close_block()
            continue
        if not name:
            continue
        name = name.lower()
        if token["end"]:
            place = next((k for k in range(len(stack) - 1, 0, -1) if page.nodes[stack[k]].name == name), 0) if name in named else 0
            if name in BLOCKS:
                close_block()
            if place and (name in BLOCKS or not any(page.nodes[k].name in CONTAINERS for k in stack[place + 1 :])):
                del stack[place:]
            continue
        if name in BLOCKS:
            close_block()
        if name in VOID:
            continue
        if token["attributes"].endswith("/") and (name in FOREIGN or any(page.nodes[k].name in FOREIGN for k in stack)):
            continue
        if name in ENDS_PARAGRAPH:
            _close_implied(page, stack, name)
        attributes = _attributes(token["attributes"])
        above = page.nodes[stack[-1]]
        title = " ".join((attributes.get("class", ""), attributes.get("id", "")))
        heading = name in HEADINGS
        plain = name not in ("html", "body", "main", "article") and NAMED.search(HEADING_WORDS.sub("", title) if heading else title)
        hidden = "hidden" in token["attributes"].lower().split() or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", "").lower()
        titled = heading and above.titled  # an article's own header gives its headings
        keep = (above.keep or titled) and not (name in DROPPED or plain or hidden or attributes.get("role", "").lower() in ROLES)
        number = len(page.nodes)
        if name in CONTAINERS:
            words = () if name in ("html", "body") else sorted(re.sub(r"\d+", "#", title).split())  # pages differ in the body's classes
            step = name + "".join("." + word for word in words)
            node = Node(name, _path(above.path, step), keep, number, above.holder)
        else:
            node = Node(name, above.path, keep, above.holder, above.parent, above.linked or name == "a")
        node.article = above.article or name == "article"
        in_article = name == "header" and above.article and above.keep and not plain and not hidden
        node.titled = in_article or (above.titled and not heading and name not in DROPPED and not plain and not hidden)
        page.nodes.append(node)
        named.add(name)
        stack.append(number)
    add(source[at:])
    close_block()
    return page


def _path(above: str, step: str) -> str:
    """The path one step down; what is longer than `LONGEST_PATH` begins with its digest instead, so that deep pages stay small."""
    if len(above) > LONGEST_PATH:
        above = "~" + hashlib.blake2b(above.encode(errors="replace"), digest_size=12).hexdigest()
    return f"{above}/{step}"


def _close_implied(page: Page, stack: list[int], name: str) -> None:
    """End tags that may be left out: a block ends an open paragraph, an item an open item of its list."""
    for k in range(len(stack) - 1, 0, -1):
        open_name = page.nodes[stack[k]].name
        if open_name == "p" or open_name == name == "li" or (open_name in ("dt", "dd") and name in ("dt", "dd")):
            del stack[k:]
            return
        if open_name in CONTAINERS or open_name in DROPPED or open_name in ("ul", "ol", "dl", "table", "blockquote"):
            return


def votes(source: str) -> list[tuple[str, float]]:
    """(path, share) of the page's containers whose score is near its best, the shares adding up to 1."""
    page = parse(source)
    best = page.best()
    if best <= 0:
        return []
    by_path: dict[str, float] = {}
    for node in page.nodes:
        if node.name in CONTAINERS and node.score >= best * VOTING_SHARE:
            by_path[node.path] = by_path.get(node.path, 0.0) + node.score
    total = sum(by_path.values())
    return [(path, score / total) for path, score in by_path.items()]


def main_text(source: str, paths: list[str], merged: int = 1) -> str:
    """Text of the containers at the first of `paths` that the page has with text; else of all at its own best path.

    Those of the first `merged` paths that neither hold what is chosen nor lie in it are taken too. Containers refer to the
    one around them and are numbered before what they hold, so each is looked at once however deep it lies.
    """
    page = parse(source)
    nodes = page.nodes
    there: set[int] = set()  # containers with text in them
    for number, _ in page.blocks:
        while number not in there:
            there.add(number)
            number = nodes[number].parent
    by_path: dict[str, list[int]] = {}
    for number in sorted(there):
        by_path.setdefault(nodes[number].path, []).append(number)
    wanted = [path for path in paths if path in by_path]
    strong = set(paths[:merged])
    if not wanted:
        best = max(nodes, key=lambda node: node.score).path if page.best() > 0 else ""
        wanted = [best] if best in by_path else [""]
    around: set[int] = set()  # containers that hold a chosen one
    inside: set[int] = set()  # chosen ones and what they hold
    for place, path in enumerate(wanted):
        here = by_path.get(path, [])
        if place and (path not in strong or not around.isdisjoint(here) or not inside.isdisjoint(here)):
            continue
        inside.update(here)
        for number in sorted(there):
            if nodes[number].parent in inside:
                inside.add(number)
        for number in here:
            while nodes[number].parent != number and nodes[number].parent not in around:
                number = nodes[number].parent
                around.add(number)
    return " ".join(line for number, line in page.blocks if number in inside)


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, paths, merged) from pages (host, html): the paths that get at least `LEAST_SHARE` of the host's votes, most
    votes first, and how many of them get `MERGED_SHARE`."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cast: dict[tuple[str, str], float] = {}  # sums per batch before the shuffle
            for name, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                for path, share in votes(source or ""):
                    cast[name, path] = cast.get((name, path), 0.0) + share
            rows = [(name, path, share) for (name, path), share in cast.items()]
            columns = zip(*rows) if rows else ([], [], [])
            arrays = [pa.array(list(c), kind) for c, kind in zip(columns, (pa.string(), pa.string(), pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["host", "path", "votes"])

    # Six decimals, so that the order of summing does not decide.
    summed = pages.mapInArrow(vote, "host string, path string, votes double").groupBy("host", "path").agg(F.round(F.sum("votes"), 6).alias("votes"))
    summed = stored(summed, "votes")
    all_votes = summed.groupBy("host").agg(F.sum("votes").alias("all"))
    kept = summed.join(all_votes, "host").where(F.col("votes") >= LEAST_SHARE * F.col("all"))
    ranked = kept.groupBy("host").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("votes"), "path"))).alias("ranked"),
        F.count_if(F.col("votes") >= MERGED_SHARE * F.col("all")).cast("int").alias("merged"),
    )
    return ranked.select("host", F.col("ranked.path").alias("paths"), "merged")


def extract_pages(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page: its main text by the paths that its host's pages agree on.

    Null html is empty and gives the empty text; a null url or one without a host belongs to the host "". Pages of
    a host that has no votes, or none for a path they have, use all containers at their own best path. Repeated rows vote as often as they occur. Only the
    three columns are read.
    """
    read = pages.select(
        F.col(id_column).alias("page_id"), F.col(url_column).alias("url"), F.col(html_column).alias("html"), host(F.col(url_column)).alias("host")
    )
    # Stored, so that its true size decides how it is joined.
    paths = stored(host_paths(read.select("host", "html")), "paths")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                columns = (some.column(name).to_pylist() for name in ("html", "paths", "merged"))
                texts = [main_text(source or "", ways or [], merged or 1) for source, ways, merged in zip(*columns)]
                arrays = [some.column("page_id"), some.column("url"), pa.array(texts, pa.string()), pa.array([len(text) for text in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, ["page_id", "url", "text", "n_chars"])

    joined = read.join(paths, "host", "left").select(F.col("page_id").cast("long").alias("page_id"), "url", "html", "paths", "merged")
    return joined.mapInArrow(extract, "page_id long, url string, text string, n_chars long")
