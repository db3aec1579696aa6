"""The main text of web pages, by markup and by differences between neighbouring pages.

A page is cut into blocks of text. Blocks inside elements that are menus, headers, footers, sidebars,
notices, adverts, forms, comments and the like are dropped. Of what is left, the blocks of the article
element, or, without one, all blocks, are candidates. Every page is then compared with its neighbours:
pages are ordered by URL path within their host, and a page's blocks are aligned with those of the page
before and the page after by longest common subsequence. A candidate that is shared is deleted if it
stands in no article, neither here nor at the neighbour. If an article holds it, it may be text that articles
have in common, so it is deleted only if it also stands on four fifths of the host's different pages,
five at least. A host's pages with equal blocks are one page, at the least of their paths, so a run of copies
has different neighbours. Neighbours that share four fifths of a page's candidate text or more are
nearly copies and decide nothing.

Blocks are aligned by their hashes, and the texts are read again from the pages in the end, so no text
is written on the way; it is shuffled only where the deletions are too many to be sent to all tasks.

The order is by ranges, so a host with a third of all pages is spread over many tasks; the two
rows at each range's ends are joined up afterwards.

Null or empty pages have no text. Pages without a URL form a host of their own. Repeated rows
give a row each, with the same text. Truncated markup is read to its end.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfproof.llm.graph import staged

#: Names of HTML elements.
RAW = "script|style|noscript|template|svg|iframe|textarea|object|canvas|math"
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set("address article aside blockquote body dd details dialog div dl dt fieldset figcaption "
            "figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section "
            "summary table tbody tfoot thead tr ul caption".split())
NOISE_TAGS = set("head nav footer aside form button select dialog menu label fieldset".split())
#: Words in class, id and role that mark what is not the article.
NOISE_WORDS = set(
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar footer header masthead banner cookie "
    "cookies consent gdpr notice notices alert popup modal overlay ad ads advert adverts advertisement "
    "advertising adsense sponsor sponsored promo promotion newsletter subscribe subscription signup "
    "login search share sharing social related recommended recommendations comment comments disqus "
    "replies respond widget widgets pagination pager toolbar skip copyright contentinfo "
    "complementary dialog hidden paywall".split())
WRAPPERS = set("has with no without wrapper container layout".split())
#: A block stands outside of all articles, in an article that is not the page's main one, or in that one.
OUTSIDE, ELSEWHERE, ARTICLE = 0, 1, 2
COPY = 0.8
#: A line of articles is the site's if this share of its different pages has it, and it has so many.
SITE_SHARE, SITE_PAGES = 0.8, 5

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-z][a-z0-9:-]*)([^>]*)(?:>|\Z)|<[!?][^>]*>",
    re.S | re.I)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HIDDEN = re.compile(r"""\bhidden\b(?!\s*=\s*["']?(?:false|until))|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")


def _noise(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in ("html", "body", "main", "article"):
        return False if tag != "article" else bool(_words(attributes) & {"comment", "comments"})
    if tag in NOISE_TAGS or tag == "header" and not in_article:
        return True
    if not attributes:
        return False
    words = _words(attributes)
    return bool(words & NOISE_WORDS and not words & WRAPPERS) or bool(_HIDDEN.search(attributes))


def _words(attributes: str) -> set[str]:
    found: set[str] = set()
    for m in _NAMES.finditer(attributes):
        found.update(w.lower() for w in _WORD.findall(m[2] or m[3] or m[4] or ""))
    return found


@dataclass
class Page:
    """Blocks in page order that the markup does not drop, and where each stands."""

    seen: list[str]
    place: list[int]  # OUTSIDE, ELSEWHERE or ARTICLE

    @property
    def open(self) -> bool:
        """Whether no article element holds text."""
        return ARTICLE not in self.place

    @property
    def blocks(self) -> list[str]:
        """The candidates for the main text."""
        return [self.seen[i] for i in candidates(self.place)]


def candidates(place: list[int]) -> list[int]:
    """Positions of the article's blocks, or, without an article, of all."""
    return [i for i, p in enumerate(place) if p == ARTICLE] if ARTICLE in place else list(range(len(place)))


def read(source: str | None) -> Page:
    """The blocks of a page that its markup does not drop."""
    stack: list[tuple[str, bool]] = []  # open elements; whether each began what is dropped
    dropped = 0
    article = None  # depth and number of the article that is open
    texts: list[str] = []
    blocks: list[tuple[int, str]] = []  # number of the article (0: none), text
    count = at = 0

    def close() -> None:
        nonlocal texts
        if texts:
            text = _SPACE.sub(" ", html.unescape("".join(texts))).strip()
            texts = []
            if text:
                blocks.append((article[1] if article else 0, text))

    def pop() -> None:
        nonlocal dropped, article
        _, began = stack.pop()
        dropped -= began
        if article and len(stack) < article[0]:
            article = None

    source = source or ""
    for m in _TOKEN.finditer(source):
        if not dropped and m.start() > at:
            texts.append(source[at:m.start()])
        at = m.end()
        if m[3] is None:
            continue
        tag = m[3].lower()
        if tag in BLOCK:
            close()
        elif tag in ("br", "td", "th"):
            texts.append(" ")
        if tag in VOID:
            continue
        if m[2]:
            if any(t == tag for t, _ in stack):
                while stack[-1][0] != tag:
                    pop()
                pop()
            continue
        if m[4].endswith("/"):
            continue
        if tag in BLOCK and any(t == "p" for t, _ in stack) or tag == "li" and stack and stack[-1][0] == "li":
            inner = "p" if tag != "li" else "li"
            while stack and any(t == inner for t, _ in stack):
                last = stack[-1][0]
                if last in BLOCK and last != inner:
                    break
                pop()
        began = _noise(tag, m[4], article is not None)
        stack.append((tag, began))
        dropped += began
        if tag == "article" and article is None and not dropped:
            count += 1
            article = (len(stack), count)
    if not dropped and at < len(source):
        texts.append(source[at:])
    close()
    best = 0
    if count:
        sizes = [0] * (count + 1)
        for number, text in blocks:
            sizes[number] += len(text)
        best = max(range(1, count + 1), key=lambda n: (sizes[n], -n))
    return Page([t for _, t in blocks],
                [OUTSIDE if not n else ARTICLE if n == best else ELSEWHERE for n, _ in blocks])


def aligned(x: list[int], y: list[int]) -> list[int]:
    """Positions in x of a longest common subsequence of x and y."""
    if x == y:
        return list(range(len(x)))
    common = set(x) & set(y)
    if not common:
        return []
    at = [i for i, v in enumerate(x) if v in common]
    return [at[i] for i in _aligned([x[i] for i in at], [v for v in y if v in common])]


def _aligned(x: list[int], y: list[int]) -> list[int]:
    places: dict[int, int] = {}
    for j, v in enumerate(y):
        places[v] = places.get(v, 0) | 1 << j
    full = (1 << len(y)) - 1
    row, rows = full, [full]  # a cleared bit j: the length grows at y[j]
    for v in x:
        hit = row & places.get(v, 0)
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    out, i, mask = [], len(x), full
    while i:
        grown = ~rows[i] & mask  # where the length grows, up to here
        if not grown:
            break
        if ~rows[i - 1] & mask == grown or (~rows[i - 1] & mask).bit_count() == grown.bit_count():
            i -= 1
            continue
        top = grown.bit_length() - 1
        i -= 1
        out.append(i)
        mask &= (1 << top) - 1
    return out[::-1]


_PARSED = pa.schema([("page_id", pa.int64()), ("row", pa.int64()), ("host", pa.string()), ("path", pa.string()),
                     ("hashes", pa.list_(pa.int64())), ("place", pa.list_(pa.int8())),
                     ("sizes", pa.list_(pa.int32()))])
_READ = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("row", pa.int64()),
                   ("blocks", pa.list_(pa.string()))])
_SHARED = pa.schema([("row", pa.int64()), ("host", pa.string()), ("position", pa.int32()), ("hash", pa.int64()),
                     ("sure", pa.bool_())])


def _address(url: str | None) -> tuple[str, str]:
    m = re.match(r"(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)([^?#]*)", url or "", re.I)
    return (m[1].lower(), m[2].rstrip("/")) if m else ("", (url or ""))


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Lists of id, URL, host, path, what is read of a page, its hashes and its name: the host's copies share one."""
    for batch in batches:
        for low in range(0, batch.num_rows, 500):
            part, out = batch.slice(low, 500), []
            for page_id, url, source in zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                page, (host, path) = read(source), _address(url)
                hashes = [xxhash.xxh3_64_intdigest(b) - 2 ** 63 for b in page.seen]
                name = xxhash.xxh3_64_intdigest(repr((host, hashes, page.place))) - 2 ** 63
                out.append((page_id, url, host, path, page, hashes, name))
            yield out


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the comparison needs of every page, with an article or without: no texts."""
    for pages in _pages(batches):
        yield _batch([(page_id, row, host, path, hashes, page.place, [len(b) for b in page.seen])
                      for page_id, _, host, path, page, hashes, row in pages], _PARSED)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for pages in _pages(batches):
        yield _batch([(page_id, url, row, page.blocks) for page_id, url, _, _, page, _, row in pages], _READ)


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a range in order: each with the one before and the one after, if the host is the same."""
    part, last, out = TaskContext.get().partitionId(), None, []
    names = ["row", "host", "before", "after", "part", "first", "last"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_()]

    def batch_of(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    for batch in batches:
        for row, host in zip(batch.column("row").to_pylist(), batch.column("host").to_pylist()):
            now = [row, host, None, None, part, last is None, False]
            if last is not None:
                if last[1] == host:
                    last[3], now[2] = row, last[0]
                out.append(last)
            last = now
            if len(out) >= 5000:
                yield batch_of(out)
                out = []
    if last is not None:
        last[6] = True
        yield batch_of([*out, last])


def neighbours(pages: DataFrame) -> DataFrame:
    """(row, before, after): the rows next in order of path within the host."""
    order = pages.select("row", "host", "path", "page_id").dropDuplicates(["row"])
    chained = staged(
        order.repartitionByRange(F.col("host"), F.col("path"), F.col("page_id"), F.col("row"))
        .sortWithinPartitions("host", "path", "page_id", "row")
        .mapInArrow(_chain, "row long, host string, before long, after long, part int, "
                            "first boolean, last boolean"))
    ends = chained.groupBy("part").agg(  # a row per range
        F.max(F.when(F.col("first"), F.struct("row", "host"))).alias("head"),
        F.max(F.when(F.col("last"), F.struct("row", "host"))).alias("tail"))
    by = Window.orderBy("part")
    ends = ends.select("part", F.lag("tail").over(by).alias("tail"), F.lead("head").over(by).alias("head"))
    return chained.join(ends, "part").select(
        "row",
        F.when(F.col("first") & (F.col("tail.host") == F.col("host")), F.col("tail.row"))
        .otherwise(F.col("before")).alias("before"),
        F.when(F.col("last") & (F.col("head.host") == F.col("host")), F.col("head.row"))
        .otherwise(F.col("after")).alias("after"))


def shared(own: list[int], place: list[int], sizes: list[int],
           other: list[int], other_place: list[int]) -> list[tuple[int, int, bool]]:
    """Candidates of a page that a neighbour shares: number, hash, whether no article holds them."""
    same = set(aligned(own, other))
    mine = candidates(place)
    if not same or sum(sizes[i] for i in mine if i in same) >= COPY * sum(sizes[i] for i in mine):
        return []
    outside = {v for v, p in zip(other, other_place) if p == OUTSIDE}
    return [(n, own[i], place[i] == OUTSIDE and own[i] in outside) for n, i in enumerate(mine) if i in same]


def _differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each page of a pair shares with the other."""
    for batch in batches:
        out = []
        names = ("row", "after", "host", "hashes", "place", "sizes", "next_hashes", "next_place", "next_sizes")
        for row, after, host, x, p, m, y, q, n in zip(*(batch.column(c).to_pylist() for c in names)):
            out += [(row, host, *found) for found in shared(x, p, m, y, q)]
            out += [(after, host, *found) for found in shared(y, q, n, x, p)]
        yield _batch(out, _SHARED)


def deletions(parsed: DataFrame) -> DataFrame:
    """(row, gone): numbers of the candidates that the comparison with the neighbours deletes."""
    pages = parsed.select("row", "host", "hashes", "place", "sizes").dropDuplicates(["row"])
    after = pages.drop("host").withColumnsRenamed(
        {"row": "after", **{c: f"next_{c}" for c in ("hashes", "place", "sizes")}})
    order = parsed.groupBy("row").agg(F.min(F.struct("host", "path", "page_id")).alias("at")).select("row", "at.*")
    pairs = neighbours(order).filter("after is not null").select("row", "after") \
        .join(pages, "row").join(after, "after")
    found = staged(pairs.mapInArrow(_differ, "row long, host string, position int, hash long, sure boolean"))
    # Lines of articles: on how many of the host's different pages they stand.
    line, asked = ["host", "hash"], found.filter("not sure")
    different = parsed.select("host", "hashes").dropDuplicates()
    counts = different.select("host", F.explode(F.array_distinct("hashes")).alias("hash")) \
        .groupBy(line).agg(F.count("*").alias("n"))
    totals = different.groupBy("host").agg(F.count("*").alias("pages"))
    site = counts.join(asked.select(line).distinct(), line, "left_semi").join(totals, "host") \
        .filter((F.col("pages") >= SITE_PAGES) & (F.col("n") >= SITE_SHARE * F.col("pages")))
    return found.filter("sure").select("row", "position") \
        .unionByName(asked.join(site, line, "left_semi").select("row", "position")) \
        .groupBy("row").agg(F.collect_set("position").alias("gone"))


def main_text(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars. Takes page_id (integer), url, html."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    parsed = staged(rows.mapInArrow(
        _parse, "page_id long, row long, host string, path string, hashes array<long>, place array<tinyint>, "
                "sizes array<int>"))
    gone = staged(deletions(parsed))
    kept = F.filter("blocks", lambda _, i: ~F.array_contains(F.coalesce("gone", F.array().cast("array<int>")), i))
    return rows.mapInArrow(_read, "page_id long, url string, row long, blocks array<string>") \
        .join(gone, "row", "left") \
        .select("page_id", "url", F.array_join(kept, "\n").alias("text")) \
        .withColumn("n_chars", F.length("text").cast("long"))
