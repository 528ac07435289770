"""Main text of web pages by consensus over the pages of a host.

``page_blocks`` reads each page once into blocks of text, each under the
generalised path of its containers (tag, classes and id, digits replaced), and
scores the containers: a page votes for its outermost article or main element
that holds most of its unlinked text, else for its deepest container that holds
all of it, so that only blocks of nothing but links fall outside, and further down as long
as what it leaves is teasers by their share of links.  An element whose class, id or role names boilerplate
is left out unless it holds the page's text itself.  Votes are
counted per host.  ``extract`` takes the blocks below the host's winning path if
they hold no less of the page's unlinked text than those below its own choice,
or if the winner is an article or main element with text on the page while no
other page of the host chose as this one did; any other page keeps its choice.

Defined edge cases: a null or blank page, or one with nothing but boilerplate,
has the empty text; a null or odd url counts as one host of its own; unclosed
tags, comments and quotes end where the page ends; repeated pages vote each;
ties go to the deeper, then to the alphabetically first path.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapfold.llm.common import free_name, null, slices, stage

# What HTML's elements are, and the names that sites give to what is not the article.
CONTAINERS = frozenset("html body main article section div td center".split())
BLOCKS = CONTAINERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr th caption blockquote pre hr address details summary figure figcaption fieldset".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg".split())
LEFT_OUT = frozenset("head nav header footer aside menu dialog button select object canvas audio video".split()) | RAW
ROLES = frozenset("navigation banner contentinfo complementary search menu menubar alert dialog form".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert "
    "sidebar sidenav rail widget widgets menu navbar nav navigation topnav breadcrumb breadcrumbs footer header masthead comment comments disqus "
    "reply replies respond share sharing social related recommended subscribe subscription newsletter signup login popup modal overlay paywall "
    "pagination pager toolbar copyright".split()
)
#: No open paragraph is looked for beyond these.
AROUND_P = BLOCKS - {"p"}
#: An element that a start tag of the same group ends, within the nearest of its parents.
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
LIMITS = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
KEPT_NAMES = frozenset("html body main article".split())
COMMENTS = frozenset("comment comments reply replies".split())
READERS = COMMENTS | {"respond", "disqus"}
#: Beside one of these a name says what is there or not, such as "no-sidebar", and not what the element is.
MODIFIERS = frozenset("no not has have with without open closed hide hidden hides show shown layout enabled disabled".split())
#: How sure it is that an element is no part of the article: by a part of a class, by a whole one, as readers' comments.
LIKELY, NAMED, READER = 1, 2, 3
#: Share of the unlinked text that makes an element the article after all, and, by how sure it was
#: that it is not, the most that may stand outside all such elements then, as a share of its own.
HALF = 0.5
OUTSIDE = {LIKELY: 0.25, NAMED: 0.05}
#: Unlinked characters that an element left out by name needs at least to be the article after all.
LEAST = 200
#: Share of links from which on text beside a container is a list of teasers.
TEASERS = 0.25

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/<>]*+)|(<[!?/])", re.S)
#: What ends a tag or changes how it is read; the rest of a tag with bad quotes; declarations.
IN_TAG = re.compile(r"[<>\"']")
BARE = re.compile(r"[^<>]*+>")
OTHER = re.compile(r"[^>]*(?:>|\Z)")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Share of a page's unlinked text that an article or main element holds if it is chosen.
MOST = 0.8
MAIN = re.compile(r"(?:article|main)(?:\.|$)")


def sureness(given: dict[str, str]) -> int:
    """How sure the classes, id and role of an element make it that it is no part of the article, 0 if they say nothing."""
    role = given.get("role", "").lower()
    found = (LIKELY if role == "form" else NAMED) if role in ROLES else 0
    for token in (given.get("class", "") + " " + given.get("id", "")).split():
        parts = {p.lower() for p in PART.findall(token)}
        if parts.isdisjoint(NAMES) or len(parts) > 1 and not parts.isdisjoint(MODIFIERS):
            continue
        found = max(found, READER if not parts.isdisjoint(READERS) else NAMED if len(parts) == 1 else LIKELY)
    return found


def without_named(blocks: list[tuple[str, str, int, tuple[int, ...]]], sure: list[int]) -> list[tuple[str, str, int]]:
    """Blocks outside the elements that names leave out.

    One that holds half of the unlinked text, and no little, while hardly any stands outside such elements, is the article whatever it is called;
    only comments never are.
    """
    counted = [(size, within) for _, _, size, within in blocks if all(sure[e] != READER for e in within)]
    total, plain = sum(size for size, _ in counted), sum(size for size, within in counted if not within)
    held = [0] * len(sure)
    for size, within in counted:
        for e in within:
            held[e] += size
    kept = {e for e, s in enumerate(sure) if s != READER and held[e] >= max(LEAST, HALF * total) and plain <= OUTSIDE[s] * held[e]}
    return [(path, text, size) for path, text, size, within in blocks if kept.issuperset(within)]


def blocks_of(html: str) -> list[tuple[str, str, int]]:
    """``(container path, text, unlinked characters)`` of every block outside boilerplate, in page order."""
    out: list[tuple[str, str, int, tuple[int, ...]]] = []
    sure: list[int] = []
    # Open elements: tag, path, number of left-out elements up to here, number of links, elements left out by name.
    stack: list[tuple[str, str, int, int, tuple[int, ...]]] = [("", "page", 0, 0, ())]
    opened: dict[str, int] = {}
    text: list[str] = []
    unlinked = 0

    def flush() -> None:
        nonlocal unlinked
        if text:
            joined = " ".join("".join(text).split())
            if joined:
                out.append((stack[-1][1], joined, unlinked, stack[-1][4]))
            text.clear()
        unlinked = 0

    def close(tag: str, limits=()) -> None:
        if not opened.get(tag):
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] == tag:
                if any(t in BLOCKS for t, *_ in stack[k:]) or stack[-1][4] != stack[k - 1][4]:
                    flush()
                for t, *_ in stack[k:]:
                    opened[t] -= 1
                del stack[k:]
                return
            if stack[k][0] in limits:
                return

    def say(piece: str) -> None:
        nonlocal unlinked
        _, _, out_of, links, _ = stack[-1]
        if piece and not out_of:
            piece = unescape(piece) if "&" in piece else piece
            text.append(piece)
            if not links:
                unlinked += len(piece)

    # Where the next quote of a kind is; looked for again only from beyond it, so bad quotes cost no rescans.
    quotes = {'"': -1, "'": -1}

    def tag_end(k: int) -> int:
        """Place of the bracket that ends the tag whose name ends at ``k``, -1 if none does."""
        begin = k
        while (met := IN_TAG.search(html, k)) is not None:
            kind, k = met[0], met.end()
            if kind == ">":
                return k - 1
            if kind == "<":
                break
            if quotes[kind] < k:
                stop = html.find(kind, k)
                quotes[kind] = stop if stop >= 0 else len(html)
            if quotes[kind] == len(html):
                break
            k = quotes[kind] + 1
        bare = BARE.match(html, begin)
        return bare.end() - 1 if bare else -1

    at = seek = 0
    while (found := TAG.search(html, seek)) is not None:
        name, rest, stop = found[2], "", found.end()
        if name is not None:
            last = tag_end(stop)
            if last >= 0:
                rest, stop = html[stop:last], last + 1
            elif found[1]:
                name, stop = None, OTHER.match(html, stop).end()
            else:  # a bracket that opens no tag is text
                seek = stop
                continue
        elif found[3]:
            stop = OTHER.match(html, stop).end()
        say(html[at : found.start()])
        at = seek = stop
        end = found[1]
        if name is None:
            continue
        tag = name.lower()
        if end:
            close(tag)
            continue
        if tag == "br":
            say(" ")
            continue
        if tag in BLOCKS:
            flush()
            close("p", AROUND_P)
        for other in SIBLINGS.get(tag, ()):
            close(other, LIMITS[tag])
        if tag in VOID:
            continue
        if tag in RAW:
            shut = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            at = seek = shut.end() if shut else len(html)
            continue
        _, path, out_of, links, within = stack[-1]
        classes, left_out, doubt = "", tag in LEFT_OUT, LIKELY if tag == "form" else 0
        if rest and not rest.isspace():
            given = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(rest)}
            classes = ".".join(sorted(given.get("class", "").lower().split()) + ["#" + i for i in given.get("id", "").lower().split()])
            if tag in KEPT_NAMES:
                names = {p.lower() for key in ("class", "id") for p in PART.findall(given.get(key, ""))}
                left_out = left_out or tag == "article" and not names.isdisjoint(COMMENTS)
            else:
                doubt = max(doubt, sureness(given))
        if doubt and not left_out and not out_of:
            flush()
            within = (*within, len(sure))
            sure.append(doubt)
        if left_out and not out_of:
            flush()
        if tag in CONTAINERS:
            step = f"{tag}.{re.sub('[0-9]+', '0', classes)}" if classes else tag
            # A container directly in one like it is the same place, which also bounds the path of deep nests.
            path = path if path.rpartition(">")[2] == step else f"{path}>{step}"
        opened[tag] = opened.get(tag, 0) + 1
        stack.append((tag, path, out_of + left_out, links + (tag == "a"), within))
    say(html[at:])
    flush()
    return without_named(out, sure)


def choice(blocks: list[tuple[str, str, int]]) -> str | None:
    """The outermost article or main path with most of the unlinked text, else the deepest path with all of it, teasers aside."""
    total = sum(size for _, _, size in blocks)
    held: dict[str, int] = {}
    for path, text, size in blocks:
        while path:
            # On a page of nothing but links, all text counts.
            held[path] = held.get(path, 0) + (size if total else len(text))
            path = path.rpartition(">")[0]
    total = held.get("page", 0)
    marked = [p for p, size in held.items() if size >= MOST * total and MAIN.match(p.rpartition(">")[2])]
    if marked:
        return min(marked, key=lambda p: (p.count(">"), p))
    whole = min((p for p, size in held.items() if size == total), key=lambda p: (-p.count(">"), p), default=None)
    while whole is not None:
        # Further down while all that is left beside a container with most of the text is teasers.
        inner = [p for p, size in held.items() if size >= MOST * held[whole] and p.rpartition(">")[0] == whole]
        beside: dict[str, list[int]] = {}
        for path, text, size in blocks:
            if _below(path, whole) and not any(_below(path, p) for p in inner):
                sums = beside.setdefault(path, [0, 0])
                sums[0] += len(text) - min(size, len(text))
                sums[1] += len(text)
        if not inner or not beside or any(linked < TEASERS * length for linked, length in beside.values()):
            break
        whole = inner[0]
    return whole


def _below(path: str, container: str) -> bool:
    return path == container or path.startswith(f"{container}>")


def page_blocks(pages: DataFrame, html: str = "html", blocks: str = "blocks", chosen: str = "chosen") -> DataFrame:
    """``pages`` without the html, with its blocks and the container it votes for."""
    rest = [c for c in pages.columns if c not in (html, blocks, chosen)]
    kind = "array<struct<path:string,text:string,size:long>>"
    schema = pages.select(*rest, null(kind).alias(blocks), null("string").alias(chosen)).schema
    struct = pa.struct([("path", pa.string()), ("text", pa.string()), ("size", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, html):
            found = [blocks_of(h or "") for h in batch.column(html).to_pylist()]
            lists = pa.array([[{"path": p, "text": t, "size": n} for p, t, n in page] for page in found], pa.list_(struct))
            votes = pa.array([choice(page) for page in found], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), lists, votes], names=[*rest, blocks, chosen])

    return pages.mapInArrow(run, schema)


def host_of(url: str) -> F.Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def extract(pages: DataFrame, html: str = "html", url: str = "url", text: str = "text", broadcast_hosts: int = 100_000) -> DataFrame:
    """``pages`` without the html, with the main text appended.

    The winners, one row per host and choice, are broadcast while there are at
    most ``broadcast_hosts``; else the join shuffles, and Spark splits a hot host.
    """
    blocks, chosen, host, path, alone = (free_name(pages, n) for n in ("_blocks", "_chosen", "_host", "_path", "_alone"))
    rest = [c for c in pages.columns if c not in (html, text)]
    read = stage(page_blocks(pages.select(*rest, html).withColumn(host, host_of(url)), html, blocks, chosen), "page-blocks")
    votes = stage(read.where(F.col(chosen).isNotNull()).groupBy(host, chosen).count(), "host-votes")
    depth = F.size(F.split(chosen, ">"))
    # The largest count, the greatest depth, then the first path: min of the negated pair.
    best = F.min(F.struct((-F.col("count")).alias("n"), (-depth).alias("d"), F.col(chosen).alias("p")))
    winners = votes.groupBy(host).agg(best.getField("p").alias(path))
    winners = stage(votes.join(winners, host).select(host, chosen, path, (F.col("count") == 1).alias(alone)), "host-paths")
    if winners.count() <= broadcast_hosts:
        winners = F.broadcast(winners)
    joined = read.join(winners, [host, chosen], "left")

    def below(at: F.Column):
        return F.filter(blocks, lambda b: (b["path"] == at) | F.startswith(b["path"], F.concat(at, F.lit(">"))))

    def held(found: F.Column):
        return F.aggregate(found, F.lit(0).cast("long"), lambda n, b: n + b["size"])

    by_host, by_page = below(F.col(path)), below(F.col(chosen))
    declared = F.regexp_like(F.col(path), F.lit("(^|>)(article|main)([.>]|$)"))
    outvoted = F.col(alone) & declared & ~F.regexp_like(F.col(chosen), F.lit("(^|>)(article|main)([.>]|$)"))
    use_host = (F.size(by_host) > 0) & ((held(by_host) >= held(by_page)) | outvoted)
    taken = F.when(use_host, by_host).otherwise(by_page)
    return joined.select(*rest, F.coalesce(F.array_join(F.transform(taken, lambda b: b["text"]), "\n"), F.lit("")).alias(text))
