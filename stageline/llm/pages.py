"""Main text of web pages by nearest-URL page differencing.

Pages are cut into text blocks in one pass over the markup. Blocks of menus, footers,
adverts and the like go by their markup. Each page is then paired with the page of other
lines whose URL path is nearest on the same host, their lines are aligned by longest
common subsequence, and lines that both share are template and go. An article (or main)
is evidence in one case: where two pages may be copies that differ in little, its lines stay.
"""

from __future__ import annotations

import bisect
import hashlib
import html
import itertools
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stageline.llm.common import slices, written

#: equal pairs of lines of two pages up to which they are threaded one by one
MATCHES = 1 << 18
#: elements whose text never counts, with all inside (fixed values of HTML)
HIDDEN = {"script", "style", "noscript", "template", "head", "title", "svg", "iframe", "object", "select", "button", "textarea", "form"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe"}
FURNITURE = {"nav", "footer", "aside", "menu", "dialog"}
OWN = {"article", "main"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q",
    "s", "samp", "small", "span", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
#: words of class, id or role that mark furniture
MARKS = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert|advertisement|banner|breadcrumbs?|comments?|contentinfo|cookies?|disqus|footer|menu|modal|nav|navbar|navigation|"
    r"newsletter|notices?|pagination|popup|promo|related|respond|share|sharing|sidebar|social|sponsor(?:ed)?|subscribe|toolbar|widget)(?:$|[\s_-])",
    re.IGNORECASE,
)
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>|<[!?][^>]*>|<(?:/?[A-Za-z!?][^>]*)\Z", re.DOTALL)
ATTRIBUTE = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
#: elements that end an open paragraph or item when they begin
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}


def page_blocks(source: str) -> list[tuple[str, bool]]:
    """(text, own) of the blocks that are not furniture, in page order.

    Character references are decoded, white space inside a block becomes one space.
    Unclosed elements end with their parent; a tag cut off at the end of the page is no text.
    """
    out: list[tuple[str, bool]] = []
    parts: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # name, hidden from here, own from here
    opened: Counter[str] = Counter()  # names in the stack: an end tag of none is skipped at once
    at, size = 0, len(source)

    def flush(own: bool) -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            out.append((text, own))

    def state() -> tuple[bool, bool]:
        return (stack[-1][1], stack[-1][2]) if stack else (False, False)

    while at < size:
        found = TAG.search(source, at)
        hidden, own = state()
        if not hidden:
            parts.append(source[at : found.start() if found else size])
        if not found:
            break
        at = found.end()
        name = (found.group(2) or "").lower()
        if not name:
            continue
        if found.group(1):
            if name not in INLINE:
                flush(own) if not hidden else parts.clear()
            for i in range(len(stack) - 1, -1, -1) if opened[name] else ():
                if stack[i][0] == name:
                    opened.subtract(s[0] for s in stack[i:])
                    del stack[i:]
                    break
                if name in INLINE and stack[i][0] not in INLINE:
                    break  # a stray inline end tag closes no block
            continue
        if name in INLINE:
            if name == "br" and not hidden:
                parts.append(" ")
        else:
            flush(own) if not hidden else parts.clear()
            ends = CLOSES.get(name, set() if name in ("span",) else {"p"})
            while stack and (stack[-1][0] in ends or (stack[-1][0] in INLINE and any(s[0] in ends for s in stack[-4:]))):
                opened[stack.pop()[0]] -= 1
            hidden, own = state()
        if name in VOID:
            continue
        marked = any(MARKS.search(next(filter(None, m), "")) for m in ATTRIBUTE.findall(found.group(3) or ""))
        header = name == "header" and not own
        gone = hidden or name in HIDDEN or name in FURNITURE or header or (marked and name not in ("html", "body", *OWN))
        if name in RAW:  # all up to its end tag, also after <script .../>
            end = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(source, at)
            at = end.end() if end else size
            continue
        if found.group(3).endswith("/") and name not in INLINE:
            continue
        stack.append((name, gone, own or name in OWN))
        opened[name] += 1
    hidden, own = state()
    if not hidden:
        flush(own)
    return out


def shared_lines(mine: list, other: list) -> set[int]:
    """Places in ``mine`` of a longest common subsequence with ``other``.

    Equal ends are taken at once. Matches of the rest are threaded by a longest increasing
    run of places (Hunt and Szymanski), so that long pages without much in common cost
    little. Where lines repeat so that there are more than ``MATCHES`` of them, the rest is
    split in two by lengths from bit rows (Hirschberg), which cost the same however many
    lines are equal.
    """
    low, most = 0, min(len(mine), len(other))
    while low < most and mine[low] == other[low]:
        low += 1
    high = 0
    while high < most - low and mine[-1 - high] == other[-1 - high]:
        high += 1
    out = {*range(low), *range(len(mine) - high, len(mine))}
    mine, other = mine[low : len(mine) - high], other[low : len(other) - high]
    if not mine or not other:
        return out
    if len(mine) > 1:
        count = Counter(other)
        if sum(count[line] for line in mine) > MATCHES:
            half = len(mine) // 2
            lengths = _prefix_lengths(mine[:half], other) + _prefix_lengths(mine[half:][::-1], other[::-1])[::-1]
            cut = int(lengths.argmax())
            parts = (0, shared_lines(mine[:half], other[:cut])), (half, shared_lines(mine[half:], other[cut:]))
            return out | {low + at + i for at, part in parts for i in part}
    return out | {low + i for i in _threaded(mine, other)}


def _prefix_lengths(mine: list, other: list) -> np.ndarray:
    """The length of the longest common subsequence with each prefix of ``other``, in bit rows."""
    places: dict = {}
    for j, line in enumerate(other):
        places[line] = places.get(line, 0) | 1 << j
    full = (1 << len(other)) - 1
    row = full
    for line in mine:
        both = row & places.get(line, 0)
        row = (row + both | row - both) & full
    bits = np.frombuffer(row.to_bytes(len(other) // 8 + 1, "little"), np.uint8)
    grows = 1 - np.unpackbits(bits, bitorder="little")[: len(other)].astype(np.int64)
    return np.concatenate(([0], np.cumsum(grows)))


def _threaded(mine: list, other: list) -> set[int]:
    places: dict = {}
    for j, line in enumerate(other):
        places.setdefault(line, []).append(j)
    ends: list[int] = []
    links: list[tuple] = []
    for i, line in enumerate(mine):
        for j in reversed(places.get(line, ())):
            k = bisect.bisect_left(ends, j)
            link = (i, links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(link)
            else:
                ends[k], links[k] = j, link
    out, link = set(), links[-1] if links else None
    while link:
        out.add(link[0])
        link = link[1]
    return out


def _url_parts(url) -> tuple:
    """Host and path of a URL, in lower case, without scheme, query and fragment."""
    bare = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://|[?#].*$", "")
    return F.substring_index(bare, "/", 1), F.regexp_replace(bare, r"^[^/]*|/+$", "")


def _digest(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Each slice with the blocks of its pages and the digest of each page's blocks, by
    which copies are recognised: equal for pages of equal lines."""
    for batch in slices(batches, "html"):
        found = [page_blocks(s) for s in batch.column("html").to_pylist()]
        hashes = [[_digest(t.encode()) for t, _ in f] for f in found]
        names = [_digest(repr((h, [o for _, o in f])).encode()) for h, f in zip(hashes, found, strict=True)]
        yield batch, found, hashes, pa.array(names, pa.int64())


LINES = "host string, path string, digest long, hashes array<long>, sizes array<int>, own array<boolean>"


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, found, hashes, names in _cut(batches):
        sizes = pa.array([[len(t) for t, _ in f] for f in found], pa.list_(pa.int32()))
        own = pa.array([[o for _, o in f] for f in found], pa.list_(pa.bool_()))
        columns = [batch.column("host"), batch.column("path"), names, pa.array(hashes, pa.list_(pa.int64())), sizes, own]
        yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in LINES.split(", ")])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tool = zstandard.ZstdCompressor(level=3)
    for batch, found, _, names in _cut(batches):
        z = pa.array([tool.compress("\n".join(t for t, _ in f).encode()) for f in found], pa.binary())
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("page_id", "url", "host")), names, z], names=["page_id", "url", "host", "digest", "z"])


def template_lines(page: dict, near: dict, far: dict | None) -> list[int]:
    """Places of the lines of ``page`` that are template: those that the nearest page shares.

    Lines of an article go only at its edges, and only if half of the host's articles have
    them (``common``): a sentence that a few articles have in common is no template. Where the shared lines are half of a page's
    text or more, the two may be copies that differ in little. Then lines of an article
    stay; of the others those go that the ``far`` neighbour shares too, if there is one.
    """
    shared = shared_lines(page["hashes"], near["hashes"])
    article = [i for i, own in enumerate(page["own"]) if own]
    common = set(page["common"] or ())
    template = {i for i in shared if page["hashes"][i] in common}
    edges = {i for side in (article, article[::-1]) for i in itertools.takewhile(template.__contains__, side)}
    shared -= set(article) - edges

    def copies(own: bool) -> bool:
        both = sum(page["sizes"][i] for i in shared if page["own"][i] == own)
        return 0 < min(sum(s for s, o in zip(p["sizes"], p["own"], strict=True) if o == own) for p in (page, near)) <= 2 * both

    kept = {i for i in shared if page["own"][i]} if copies(True) else set()
    if far is not None and copies(False):
        also = shared_lines(page["hashes"], far["hashes"])
        kept |= {i for i in shared if not page["own"][i] and i not in also}
    return sorted(shared - kept)


def _common(a: str, b: str) -> int:
    """Path elements before the first that differs."""
    x, y = a.split("/"), b.split("/")
    return next((i for i, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))


def _gone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The template lines of each page, from pages in the order of part, host and path;
    pages that another part lent (``lent``) are neighbours only."""

    def rows():
        for batch in batches:
            yield from batch.to_pylist()

    def judged():
        before, page = None, None
        for after in itertools.chain(rows(), [None]):
            if page is not None and not page["lent"]:
                sides = [p for p in (before, after) if p is not None and (p["part"], p["host"]) == (page["part"], page["host"])]
                if sides:
                    sides.sort(key=lambda p: -_common(page["path"], p["path"]))  # of equally near ones, the one before
                    lines = template_lines(page, sides[0], sides[1] if len(sides) > 1 else None)
                    if lines:
                        yield page["host"], page["digest"], lines
            before, page = page, after

    out = judged()
    while some := list(itertools.islice(out, 5000)):
        host, digest, lines = zip(*some, strict=True)
        columns = [pa.array(host, pa.string()), pa.array(digest, pa.int64()), pa.array(lines, pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays(columns, names=["host", "digest", "gone"])


def in_ranges(classes: DataFrame) -> DataFrame:
    """The pages dealt to ranges (``part``) of host and path, each range with the border
    page of the range before and after it (``lent``): neighbours are exact at any host size."""
    order = ["host", F.split("path", "/"), "digest"]  # by path elements: /a, /a/b, /a-b
    ranged = classes.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    ranged = written(ranged, "ranges")
    place = F.struct("host", F.split("path", "/").alias("key"), "digest")
    ends = ranged.groupBy("part").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    parts = Window.orderBy("part")  # a row per range
    ends = ends.withColumn("before", F.lag("part").over(parts)).withColumn("after", F.lead("part").over(parts))
    ends = written(ends, "borders")
    to_before = ends.select(F.col("first.host").alias("host"), F.col("first.digest").alias("digest"), F.col("before").alias("to"))
    to_after = ends.select(F.col("last.host").alias("host"), F.col("last.digest").alias("digest"), F.col("after").alias("to"))
    lent = ranged.join(to_before.unionByName(to_after).where("to is not null"), ["host", "digest"])
    lent = lent.drop("part").withColumnRenamed("to", "part").withColumn("lent", F.lit(True))
    return ranged.withColumn("lent", F.lit(False)).unionByName(lent)


def article_lines(classes: DataFrame) -> DataFrame:
    """``host, common``: the lines that half of a host's articles have, and two at least. A
    host has at most twice as many as its articles have lines on average."""
    lines = F.array_distinct(F.transform(F.filter(F.arrays_zip("hashes", "own"), lambda x: x["own"]), lambda x: x["hashes"]))
    articles = classes.select("host", lines.alias("lines")).where(F.size("lines") > 0)
    counts = articles.select("host", F.explode("lines").alias("line")).groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
    total = articles.groupBy("host").agg(F.count(F.lit(1)).alias("articles"))
    often = counts.where("n > 1").join(total, "host").where("2 * n >= articles")
    return written(often.groupBy("host").agg(F.collect_set("line").alias("common")), "article-lines")


def _left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tool = zstandard.ZstdDecompressor()
    for batch in batches:
        out = []
        for z, gone in zip(batch.column("z").to_pylist(), batch.column("gone").to_pylist(), strict=True):
            lines, drop = tool.decompress(z).decode().split("\n") if z else [], set(gone or ())
            out.append("\n".join(t for i, t in enumerate(lines) if i not in drop))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())], names=["page_id", "url", "text"])


def main_text(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text (empty if none), n_chars.

    Every page is aligned with the nearest page of its host that has other lines; lines
    that both share go, at the edges of an article too, unless the two are copies that differ in
    little (``template_lines``). Pages of equal lines are one page there, under the least
    of their paths, and are answered alike. Null html is empty; a null url is a host of
    its own name. Other columns are not read.
    """
    host, path = _url_parts(F.col("url"))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", host.alias("host"), path.alias("path"), F.coalesce("html", F.lit("")).alias("html")
    )
    lines = rows.select("host", "path", "html").mapInArrow(_lines, LINES).where(F.size("hashes") > 0)
    same = lines.groupBy("host", "digest")
    classes = same.agg(F.min("path").alias("path"), *(F.first(c).alias(c) for c in ("hashes", "sizes", "own")))
    classes = written(classes, "classes")
    ranged = in_ranges(classes).join(article_lines(classes), "host", "left")
    dealt = ranged.repartition("part").sortWithinPartitions("part", "host", F.split("path", "/"), "digest")
    gone = written(dealt.mapInArrow(_gone, "host string, digest long, gone array<int>"), "gone")
    texts = rows.select("page_id", "url", "host", "html").mapInArrow(_texts, "page_id long, url string, host string, digest long, z binary")
    text = texts.join(gone, ["host", "digest"], "left").select("page_id", "url", "z", "gone")
    return text.mapInArrow(_left, "page_id long, url string, text string").withColumn("n_chars", F.length("text").cast("long"))
