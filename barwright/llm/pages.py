"""Main text of web pages: marked parts go, then lines shared with the page at the nearest URL.

A page is read into blocks in page order. Parts marked as menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles or reader comments, by element, role, class or id, are
left out. An element that contains `main` or an article's h1 is never left out, unless
it is hidden; one that contains all articles of the page is kept if they hold more than all other text. Articles marked as comments,
adverts or teasers are left out beside others. Inside an article only containers are judged, not paragraphs and inline elements. Marks after has, no or with and those of layouts
(`has-sidebar`) say how the rest is laid out and do not count, nor do headers inside an article. Of what remains, `core` blocks stand in an `article`, or in `main` if there is none.

Pages of a host with the same lines are copies and count as one. These are ordered by URL path, and each is paired with
the neighbour whose path has the longest beginning in common; a neighbour with which it shares `NEAR` of its
characters is a near copy, and the other one is taken, or none. The lines of both are aligned by their longest common
subsequence, and lines that both have are deleted, if they are not core or consist mostly of links, and if they stand in
`SEVERAL` different pages of the host, or in both of two. Core prose is kept
even if the other page has it: articles are copied and quoted, and a shared article is an
article. Lines outside the core are the text of pages without any core only. A page between two near copies keeps all its lines.

Each block is decoded, its white space is one space, blocks are joined by two line ends.

Nulls: null html is empty, its text is ''; a null URL has no host and no neighbour. Pages with
equal URLs are neighbours of one another. Repeated rows are kept, each with its text; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright.plans.durable import cut

from .common import small_batches, with_neighbours

# Elements that are never part of an article, that end a block, that have no content.
_LEFT_OUT = frozenset("nav footer aside form head menu dialog button select svg iframe object canvas datalist".split())
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody thead tfoot tr "
    "ul caption".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Words of roles, classes and ids.
_MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies disqus footer header masthead menu modal nav navbar navigation newsletter notice "
    "notices pagination popup promo promoted related search share sharing sidebar signup social sponsor "
    "sponsored subscribe toolbar widget widgets complementary contentinfo dialog alert promotion".split())
# Words that turn the marks after them in a class into a description of the page.
_TURNING = frozenset("has no not with without".split())
# The marks that tell an article beside the main one, and elements that hold a line or a paragraph, whose marks say how
# it looks. Those count outside of articles only.
_BESIDE = frozenset("ad ads adv advert adverts advertisement advertising comment comments promo promoted promotion related sponsored teaser".split())
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt a b em i mark q small span strong td th tr".split())
_MARKED_PAIRS = frozenset([("reader", "comments"), ("user", "comments"), ("site", "info"), ("skip", "link")])

#: Share of the characters of the longer page from which two pages are near copies.
NEAR = 0.9
#: Different pages of a host that have a line that is deleted.
SEVERAL = 3

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(?P<raw>script|style|noscript|template|textarea|title|xmp)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.IGNORECASE | re.DOTALL)
_ATTR = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


def _hidden(attrs: str) -> bool:
    return any(key.lower() == "hidden" and value.strip("\"'").lower() != "false"
               or key.lower() == "aria-hidden" and value.strip("\"'").lower() == "true" for key, value in _ATTR.findall(attrs))


def _marked(name: str, attrs: str, inside: bool) -> bool:
    """Whether role, class or id say that an element is no main text; `inside` an article headers are."""
    if name in ("html", "body", "main") or inside and name in _PROSE:
        return False
    marks = _BESIDE if name == "article" else _MARKS
    for key, value in _ATTR.findall(attrs):
        if key.lower() in ("class", "id", "role"):
            for part in value.strip("\"'").split():
                words = [w.lower() for w in _NAMES.findall(part)]
                if "layout" in words:
                    continue
                words = words[:next((i for i, w in enumerate(words) if w in _TURNING), len(words))]
                if any(w in marks and not (inside and w == "header") for w in words) or any(
                        p in _MARKED_PAIRS for p in zip(words, words[1:])):
                    return True
    return False


def blocks_of(page: str) -> list[tuple[str, bool, float]]:
    """Text, whether it is core, and the share of it that is links; of the blocks that are not left out."""
    kept: set[int] = set()
    while True:  # again only where an element was left out that holds the main text
        found, wrong, last = _parsed(page, kept)
        if not wrong <= kept:
            kept |= wrong
            continue
        if last <= kept or any(core for _, core, _ in found):
            return found
        inside = sum(len(text) for text, core, _ in _parsed(page, kept | last)[0] if core)
        if inside <= sum(len(text) for text, _, _ in found):  # teasers or comments beside a text without an article
            return found
        kept |= last


def _parsed(page: str, kept: set[int]) -> tuple[list[tuple[str, bool, float]], set[int], set[int]]:
    """Blocks as above if elements at the places `kept` are not left out; the places of those left out
    that contain `main` or an article's h1, and of those that contain any article."""
    wrong: set[int] = set()
    last: set[int] = set()
    found: list[tuple[str, str, float]] = []
    parts: list[str] = []
    linked = [0]
    stack: list[tuple[str, bool, int]] = []  # open elements, whether they are left out, and their place if they may be kept
    out = articles = mains = links = 0

    def flush():
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            region = "article" if articles else "main" if mains else ""
            found.append((text, region, min(1.0, linked[0] / len(text))))
        parts.clear()
        linked[0] = 0

    # where elements of each name are open, and those that are blocks; so that an end tag need not look through all
    opened: dict[str, list[int]] = {}
    open_blocks: list[int] = []

    def close(depth):
        nonlocal out, articles, mains, links
        while len(stack) > depth:
            name, left, _ = stack.pop()
            opened[name].pop()
            if name in _BLOCKS:
                open_blocks.pop()
            out -= left
            articles -= name == "article"
            mains -= name == "main"
            links -= name == "a"

    at = 0
    for token in _TOKEN.finditer(page):
        if not out:
            text = page[at:token.start()]
            parts.append(text)
            if links:
                linked[0] += len(text)
        at = token.end()
        name = token["name"]
        if not name:
            parts.append(" " if not out and token["raw"] else "")
            continue
        name = name.lower()
        if name in _BLOCKS:
            flush()
        elif name == "br" or name in ("td", "th"):
            parts.append(" ")
        if token["end"]:
            depth = opened[name][-1] if opened.get(name) else None
            # inline elements do not close the block around them
            if depth is not None and (name in _BLOCKS or name in _LEFT_OUT or not open_blocks or open_blocks[-1] <= depth):
                close(depth)
        elif name not in _VOID and not token["attrs"].rstrip().endswith("/"):
            if name in _BLOCKS and stack:  # what a new block ends by itself
                depth = open_blocks[-1] if open_blocks else None
                if depth is not None and (stack[depth][0] == "p" or stack[depth][0] == name == "li"
                                          or stack[depth][0] in ("dt", "dd") and name in ("dt", "dd")):
                    close(depth)
            hidden = _hidden(token["attrs"])
            left = hidden or token.start() not in kept and (
                name in _LEFT_OUT or name == "header" and not articles or _marked(name, token["attrs"], bool(articles)))
            if out and not hidden and (name in ("main", "article") or name == "h1" and articles):
                places = {place for _, gone, place in stack if gone}
                if -1 not in places:  # nothing around it is hidden
                    (last if name == "article" else wrong).update(places)
            if name == "article" and left and not hidden and not out:
                last.add(token.start())
            opened.setdefault(name, []).append(len(stack))
            if name in _BLOCKS:
                open_blocks.append(len(stack))
            stack.append((name, left, -1 if hidden else token.start()))
            out += left
            articles += name == "article"
            mains += name == "main"
            links += name == "a"
    if not out and "<" not in page[at:][:1]:
        parts.append(page[at:])
    flush()
    for region in ("article", "main"):
        if any(r == region for _, r, _ in found):
            return [(text, r == region, share) for text, r, share in found], wrong, last
    return [(text, False, share) for text, _, share in found], wrong, last


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Places in `a` of a longest common subsequence with `b`, by increasing runs of matches."""
    where: dict[int, list[int]] = {}
    for j, line in enumerate(b):
        where.setdefault(line, []).append(j)
    tails, ends, back, pairs = [], [], [], []
    for i, line in enumerate(a):
        for j in reversed(where.get(line, ())):
            k = bisect_left(tails, j)
            node = len(pairs)
            pairs.append(i)
            back.append(ends[k - 1] if k else -1)
            if k == len(tails):
                tails.append(j)
                ends.append(node)
            else:
                tails[k], ends[k] = j, node
    places, node = [], ends[-1] if ends else -1
    while node >= 0:
        places.append(pairs[node])
        node = back[node]
    return places[::-1]


def _alike(a: str, b: str | None) -> int:
    if b is None:
        return -1
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def _read(batches):
    for pdf in batches:
        rows = []
        for page in pdf["html"]:
            blocks = blocks_of(page)
            core = any(c for _, c, _ in blocks)
            # lines that may be deleted, and the others, which may not
            lines = [xxhash.xxh3_64_intdigest(t) - 2**63 for t, _, _ in blocks]
            loose = [not c or share >= 0.5 for _, c, share in blocks]
            able = any(may and (c or not core) for may, (_, c, _) in zip(loose, blocks))
            outside = [core and not c for _, c, _ in blocks]
            key = xxhash.xxh3_128_digest(repr((lines, loose, outside)))
            rows.append((["" if gone else t for gone, (t, _, _) in zip(outside, blocks)], outside, loose, lines,
                         [len(t) for t, _, _ in blocks], able, key))
        out = pd.DataFrame(rows, columns=["blocks", "outside", "loose", "lines", "sizes", "able", "key"])
        yield pd.concat([pdf[["page_id", "url", "host", "place"]], out], axis=1)


def _shared(batches):
    """Places and hashes of the lines that pages share with the nearest one that is no near copy."""
    for pdf in batches:
        out = []
        for row in pdf.itertuples(index=False):
            sizes = list(row.sizes)
            others = [(_alike(row.place, place), lines, size) for place, lines, size in (
                (row.place_after, row.lines_after, row.sizes_after), (row.place_before, row.lines_before, row.sizes_before))
                if lines is not None]
            for _, lines, size in sorted(others, key=lambda other: -other[0]):
                places = common_lines(list(row.lines), list(lines))
                if sum(sizes[i] for i in places) < NEAR * max(sum(sizes), sum(size)):
                    out += [(row.host, row.key, i, row.lines[i]) for i in places if row.loose[i] and not row.outside[i]]
                    break
        yield pd.DataFrame(out, columns=["host", "key", "at", "line"])


def main_text(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page; writes the blocks of the pages once and runs a job to cut the order of URLs."""
    small_batches(pages.sparkSession)
    address = F.regexp_replace(F.coalesce(F.col(url), F.lit("")), r"^[a-zA-Z][\w+.-]*://|[?#].*$", "")
    host = F.when(F.col(url).isNotNull(), F.lower(F.regexp_extract(address, r"^(?:www\.|m\.)?([^/:]*)", 1)))
    rows = pages.select(F.col(id).alias("page_id"), F.col(url).alias("url"), host.alias("host"),
                        F.concat_ws("\n", host, F.regexp_extract(address, r"^[^/]*(.*)$", 1),
                                    F.coalesce(F.col(url), F.lit("")), F.coalesce(F.col(id).cast("string"), F.lit(""))).alias("place"),
                        F.coalesce(F.col(html), F.lit("")).alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    read = cut(rows.mapInPandas(_read, f"page_id {kinds['page_id']}, url string, host string, place string, blocks array<string>, "
                                "outside array<boolean>, loose array<boolean>, lines array<bigint>, sizes array<int>, "
                                "able boolean, key binary"), "blocks")
    # one of the copies of a page, on hosts where a line of any page may be deleted
    hosts = read.where("able and host is not null").select("host").distinct()
    least = read.where("host is not null").groupBy("host", "key").agg(F.min("place").alias("place"))
    once = (read.join(hosts, "host", "left_semi").join(least, ["host", "key", "place"])
            .select("host", "key", "place", "lines", "sizes", "loose", "outside", "able").dropDuplicates(["host", "key"]))
    once = cut(once, "once")
    paired = with_neighbours(once, "place", {"lines_after": "lines", "place_after": "place", "sizes_after": "sizes"},
                             {"lines_before": "lines", "place_before": "place", "sizes_before": "sizes"}, within="host")
    shared = paired.where("able").mapInPandas(_shared, "host string, key binary, at int, line bigint")
    shared = cut(shared, "shared")
    lines = once.select("host", F.explode(F.array_distinct("lines")).alias("line"))
    counts = lines.join(shared.select("host", "line").distinct(), ["host", "line"], "left_semi").groupBy("host", "line").agg(F.count("*").alias("n"))
    counts = counts.join(once.groupBy("host").agg(F.count("*").alias("all")), "host")
    gone = (shared.join(counts.where(F.col("n") >= F.least(F.lit(SEVERAL), F.col("all"))), ["host", "line"])
            .groupBy("host", "key").agg(F.collect_set("at").alias("gone")))
    # lines outside the core are not wanted, nor are those to be deleted
    wanted = F.filter(F.transform("blocks", lambda text, i: F.when(
        ~F.get("outside", i) & ~F.coalesce(F.array_contains("gone", i), F.lit(False)), text)), lambda text: text.isNotNull())
    text = read.join(gone, ["host", "key"], "left").select("page_id", "url", F.array_join(wanted, "\n\n").alias("text"))
    return text.withColumn("n_chars", F.length("text").cast("bigint"))
