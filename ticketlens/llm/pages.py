"""Main text of web pages by nearest-URL page differencing.

1. Every page is cut into blocks: runs of inline content between block
   elements, with their place (inside the article element, inside page
   furniture, or in the open) and the path of elements around them.
2. Pages of a host with equal blocks outside furniture are one page, at the first
   of their paths, and share one result.  The pages of a host are put in the order
   of their URL path, and every page
   is compared with its neighbours in that order, the pages with the nearest
   paths (one before, one after, and a second one each in reserve).  The two block lists are aligned by a longest
   common subsequence, and the blocks in it are shared: they belong to the
   site and are deleted.  In a marked article that takes more proof: a block must
   be shared by two neighbours and stand in the articles of most other pages of
   the host, and headings stay.  A neighbour that is a copy (for the article: one
   that shares most of its blocks) tells nothing, and the next page on its side
   takes its place; at the ends of a host the article's two are on one side.
3. An exact check follows on what the page itself says: blocks inside menus,
   headers, footers, sidebars, notices, adverts, forms, comments, scripts and
   styles are deleted even where no neighbour shares them (menus and adverts
   that differ from page to page), and if the page marks its article, blocks
   outside it go too.  A header inside the article that holds a heading is part
   of it.  A name of several parts counts if its last part names furniture
   (site-header), or its first one and the rest only say where (ad-slot,
   nav-links), not if they turn its meaning (legal-text, search-result).

Scale: only block hashes travel for the comparison.  The (host, path) order is
cut into ranges of about ``RANGE_PAGES`` pages, so a host with a third of all
pages is split and the costly comparison has as many tasks as the pages ask
for; the four pages at the ends of each range look up their neighbours by place
number (the ranges' sizes, one number per range, are added up on the driver).
Block counts per host are summed in the tasks first.  The many copies of one
page get their result where they are.  A page that its neighbours change nothing
of is finished from its own markup; only the others' decisions are sent to the
pages, by broadcast within ``BROADCAST_PAGES`` and ``BROADCAST_FLAGS``, else by a
shuffle of the pages.

Defined results: a NULL or empty html gives an empty text; a NULL url is a host
of its own with an empty path; pages that share a URL are neighbours by id;
rows that share an
id are each a page, rows that also share URL and html get one text.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import html as entities
import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketlens.llm.common import hot_bound, join_hot, ready_workers, save

RANGE_PAGES = 2000
BROADCAST_BLOCKS = 500_000  # hosts and their usual blocks, some 10 MB
BROADCAST_PAGES = 200_000  # decisions that differ from the markup's, some 16 MB
BROADCAST_FLAGS = 32_000_000  # and the blocks they are about
TABLE_BITS = 1 << 28  # of an alignment's table, 32 MB

# fixed values: elements of HTML by their part in a page
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead title tr ul caption".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
FURNITURE = frozenset(
    "nav header footer aside form script style noscript iframe template head title button select textarea menu dialog svg "
    "object embed canvas audio video map datalist fieldset search".split()
)
# fixed values: words in class, id or role that name page furniture
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion menu nav navbar navigation "
    "breadcrumb breadcrumbs header masthead footer sidebar aside widget related recommended share sharing social comment "
    "comments disqus respond reply replies cookie cookies consent notice notices gdpr popup modal newsletter subscribe signup "
    "login search form complementary contentinfo search toolbar pagination pager copyright legal disclaimer skip".split()
)
# fixed values: words that only say where in the page a named part stands
PLACES = frozenset(
    "area bar block blocks bottom box button buttons center cell column container content group holder icons inner item items "
    "left link links list main outer panel posts region right row section slot stories top unit units wrap wrapper zone".split()
)
HEADER_NAMES = frozenset("header masthead".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
ARTICLE_NAMES = frozenset("article main".split())
TAG = re.compile(
    r"<(?:!--.*?(?:-->|$)|!\[CDATA\[.*?(?:\]\]>|$)|[!?][^>]*(?:>|$)|"
    r"(/?)([A-Za-z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*)(?:>|$))",
    re.S,
)
RAW_END = {name: re.compile(f"</{name}", re.I | re.A) for name in RAW}
ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none", re.I)

PARAGRAPH_ENDS = BLOCK - {"option", "optgroup", "legend", "caption", "td", "th", "tr", "tbody", "thead", "tfoot"}
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "optgroup": {"option", "optgroup"},
}
KEEP_OPEN = frozenset("ul ol dl table article section div body html main nav aside header footer form select".split())


def _part_named(element: str, attributes: str) -> str:
    """What an element's class, id or role makes of it: ``furniture``, ``header`` or nothing."""
    if element in ("html", "body", "main"):
        return ""
    found = ""
    for name, *values in ATTRIBUTE.findall(attributes):
        for value in "".join(values).lower().split():
            first, *rest = re.split(r"[-_:]+", value)
            last = rest[-1] if rest else first
            if last in HEADER_NAMES:
                found = "header"
            elif value in NAMES or last in NAMES or (rest and first in NAMES and PLACES.issuperset(rest)):
                return "furniture"
    return "furniture" if HIDDEN.search(attributes) else found


def blocks(page: str) -> list[tuple[str, str]]:
    """(kind, text) of every block in page order.

    Kinds: ``article`` (inside an article or main element), ``heading`` (a
    heading there), ``open`` (outside it), ``furniture``.  White space in a
    block is one space.
    """
    out: list[tuple[str, str]] = []
    # element, in furniture, in article, first block of a header inside an article or -1
    stack: list[tuple[str, bool, bool, int]] = []
    held: list[str] = []

    def state() -> tuple[bool, bool]:
        return (stack[-1][1], stack[-1][2]) if stack else (False, False)

    def flush() -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            furniture, article = state()
            of_article = "heading" if any(x[0] in HEADINGS for x in stack) else "article"
            out.append(("furniture" if furniture else of_article if article else "open", text))

    def drop(i: int) -> None:
        """Leave the elements from ``i`` on; a header without a heading turns out to be furniture."""
        for *_, since in stack[i:]:
            if since >= 0 and not any(kind == "heading" for kind, _ in out[since:]):
                out[since:] = [("furniture", text) for _, text in out[since:]]
        del stack[i:]

    def close(name: str) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == name:
                if any(x[0] in BLOCK for x in stack[i:]):
                    flush()
                drop(i)
                return
            if stack[i][0] in KEEP_OPEN and name not in KEEP_OPEN:
                return

    at = 0
    while at < len(page):
        found = TAG.search(page, at)
        if not found:
            held.append(entities.unescape(page[at:]))
            break
        held.append(entities.unescape(page[at : found.start()]))
        at = found.end()
        name = (found.group(2) or "").lower()
        if not name:
            continue
        if found.group(1):
            if name == "p" and not any(x[0] == "p" for x in stack):
                flush()
            close(name)
            continue
        if name == "br":
            held.append(" ")
            continue
        if name in PARAGRAPH_ENDS and any(x[0] == "p" for x in stack):
            close("p")
        for other in CLOSES.get(name, ()):
            close(other)
        if name in BLOCK:
            flush()
        if name in VOID or found.group(0).endswith("/>") and name not in BLOCK:
            continue
        if name in RAW:
            end = RAW_END[name].search(page, at)
            at = end.start() if end else len(page)
        furniture, article = state()
        part = _part_named(name, found.group(3) or "")
        header = name == "header" or (part == "header" and name in BLOCK)
        inside = header and article and not furniture and part != "furniture"
        furniture = furniture or (not inside and (name in FURNITURE or bool(part)))
        role_main = "main" in (x.lower() for _, *v in ATTRIBUTE.findall(found.group(3) or "") for x in v)
        stack.append((name, furniture, article or name in ARTICLE_NAMES or role_main, len(out) if inside else -1))
        if name in RAW:
            held.clear()
    flush()
    drop(0)
    return out


def _hashes(found: list[tuple[str, str]]) -> np.ndarray:
    import xxhash

    return np.array([xxhash.xxh64_intdigest(text.encode("utf-8", "replace")) for _, text in found], dtype=np.uint64)


def _grown(x: list[int], y: list[int]) -> tuple[int, list[int]]:
    """The last bit row of the table of ``x`` by ``y`` and all rows before it.

    Bit j of a row is 0 where the subsequence grows at y[j].
    """
    places: dict[int, int] = {}
    for j, value in enumerate(y):
        places[value] = places.get(value, 0) | 1 << j
    full = (1 << len(y)) - 1
    row, rows = full, [full]
    for value in x:
        match = row & places.get(value, 0)
        row = ((row + match) | (row - match)) & full
        if len(x) * len(y) <= TABLE_BITS:
            rows.append(row)
    return row, rows


def _lengths(x: list[int], y: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of ``x`` and y[:j], for every j."""
    row, _ = _grown(x, y)
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(y) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(y)]
    return np.concatenate([[0], np.cumsum(bits == 0)])


def _common(x: list[int], y: list[int]) -> list[int]:
    """Places in ``x`` of a longest common subsequence with ``y``."""
    if not x or not y:
        return []
    if len(x) * len(y) > TABLE_BITS and len(x) > 1:  # too large a table: halves of x with the best cut of y
        half = len(x) // 2
        ahead, behind = _lengths(x[:half], y), _lengths(x[half:][::-1], y[::-1])[::-1]
        cut = int((ahead + behind).argmax())
        return _common(x[:half], y[:cut]) + [half + i for i in _common(x[half:], y[cut:])]
    if len(x) == 1:
        return [0] if x[0] in y else []
    _, rows = _grown(x, y)
    full = (1 << len(y)) - 1
    picked = []
    i, j = len(x), len(y)
    while i and j:
        grown = full & ~rows[i] & ((1 << j) - 1)
        if not grown:
            break
        j = grown.bit_length()  # the last growth point in y[:j]
        while i and not rows[i - 1] >> (j - 1) & 1:  # already there one entry earlier
            i -= 1
        picked.append(i - 1)
        i, j = i - 1, j - 1
    return picked


def shared_lines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which entries of ``a`` are in the longest common subsequence with ``b``.

    Entries that the other list lacks cannot be in it and are left out first;
    then common beginnings and ends are taken off, and the rest is the
    textbook table, one bit row of whole numbers per entry, in parts of at most
    ``TABLE_BITS``.
    """
    out = np.zeros(len(a), dtype=bool)
    here, there = np.flatnonzero(np.isin(a, b)), np.flatnonzero(np.isin(b, a))
    x, y = a[here].tolist(), b[there].tolist()
    low = 0
    while low < min(len(x), len(y)) and x[low] == y[low]:
        low += 1
    high = 0
    while high < min(len(x), len(y)) - low and x[-1 - high] == y[-1 - high]:
        high += 1
    picked = list(range(low)) + list(range(len(x) - high, len(x)))
    picked += [low + i for i in _common(x[low : len(x) - high], y[low : len(y) - high])]
    out[here[np.array(picked, dtype=np.int64)]] = True
    return out


def by_markup(kinds: bytes) -> list[bool]:
    """Which of the blocks that are no furniture stay if no neighbour shares one: the article's, if the page marks it."""
    visible = kinds.replace(b"f", b"")
    marked = b"a" in visible or b"h" in visible
    return [not marked or k in b"ah" for k in visible]


def kept_blocks(
    kinds: bytes, own: np.ndarray, before: list[np.ndarray], after: list[np.ndarray], usual: np.ndarray
) -> tuple[list[bool], int]:
    """Which of the blocks that are no furniture stay, and how many of them a neighbour shares; nearest neighbours first.

    ``usual`` are the blocks in the articles of most other pages of the host.
    A neighbour that has all of them is a copy of the page and tells nothing;
    one that has more than half of a marked article's blocks tells nothing of it.
    """
    visible = np.frombuffer(kinds, np.uint8) != ord("f")
    heading = np.frombuffer(kinds, np.uint8) == ord("h")
    article = heading | (np.frombuffer(kinds, np.uint8) == ord("a"))
    sides = [[shared_lines(own, other) for other in side] for side in (before, after)]
    shared = np.zeros(len(own), dtype=bool)
    for side in sides:
        for common in [x for x in side if not x[visible].all()][:1]:
            shared |= common
    deleted = shared
    if article.any():
        told = [[x for x in side if 2 * x[article].sum() <= article.sum()] for side in sides]
        two = told[0][:1] + told[1][:1] if all(told) else told[0] + told[1]
        proven = two[0] & two[1] & np.isin(own, usual) & ~heading if len(two) == 2 else False
        deleted = ~article | proven
    return (~deleted[visible]).tolist(), int(shared[visible].sum())


def _usual_blocks(pages_once: DataFrame) -> DataFrame:
    """(host, usual): hashes of the blocks that stand in the articles of most other pages of a host, each page once.

    Each stands on more than half of the host's pages, so a host has at most
    twice as many of them as its pages have article blocks on average.
    """

    def article_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, found = [], [np.zeros(0, np.int64)]
            for host, kinds, hashes in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                own = np.unique(np.frombuffer(hashes, np.int64)[np.frombuffer(kinds, np.uint8) == ord("a")])
                hosts += [host] * len(own)
                found.append(own)
            yield pa.record_batch([pa.array(hosts, pa.string()), pa.array(np.concatenate(found))], ["host", "block"])

    n_pages = pages_once.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).where("pages > 2")
    counts = pages_once.select("host", "kinds", "hashes").mapInArrow(article_blocks, "host string, block long")
    counts = counts.groupBy("host", "block").agg(F.count(F.lit(1)).alias("n")).where("n > 1").join(n_pages, "host")
    usual = counts.where("2 * (n - 1) > pages - 1").groupBy("host").agg(F.collect_list("block").alias("usual"))
    usual = save(usual, "pages-usual")
    n_blocks = usual.agg(F.coalesce(F.sum(F.size("usual")), F.lit(0))).first()[0]
    return F.broadcast(usual) if n_blocks + usual.count() <= BROADCAST_BLOCKS else usual


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars, n_shared (blocks outside furniture that a neighbour shares) of every page."""
    spark = pages.sparkSession
    ready_workers(spark)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, hashes, same = [], [], []
            for page in batch.column(2).to_pylist():
                found = blocks(page or "")
                kinds.append("".join(k[0] for k, _ in found).encode())
                own = _hashes(found)
                hashes.append(own.tobytes())
                visible = np.frombuffer(kinds[-1], np.uint8) != ord("f")
                same.append(hashlib.blake2b(kinds[-1].replace(b"f", b"") + b" " + own[visible].tobytes(), digest_size=16).digest())
            arrays = [pa.array(x, pa.binary()) for x in (kinds, hashes, same)]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), *arrays, batch.column(3), batch.column(4)],
                ["page_id", "url", "kinds", "hashes", "same", "key", "key2"],
            )

    given = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    # rows that agree in id, url and html are one page; texts are cut again at the end rather than kept twice
    given = given.withColumn("key", F.xxhash64("page_id", "url", "html")).withColumn("key2", F.xxhash64(F.lit(8), "html", "url", "page_id"))
    cut_pages = given.mapInArrow(cut, "page_id long, url string, kinds binary, hashes binary, same binary, key long, key2 long")
    bare = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://", ""), r"[?#].*$", "")
    table = save(
        cut_pages.withColumn("host", F.lower(F.regexp_extract(bare, r"^([^/]*)", 1)))
        .withColumn("path", F.regexp_replace(F.regexp_extract(bare, r"^[^/]*(.*)$", 1), r"/+$", ""))
        .drop("url"),
        "pages-blocks",
    )
    # ranges of the (host, path) order; neighbours inside a range, then across the ranges' ends
    key = ["host", "path", "page_id", "key", "key2"]
    first = F.min(F.struct("path", "page_id", "key", "key2", "kinds", "hashes")).alias("first")
    pages_once = table.groupBy("host", "same").agg(first, F.count(F.lit(1)).alias("copies")).select("host", "same", "copies", "first.*")
    n_rows = table.count()
    n_ranges = max(1, math.ceil(n_rows / RANGE_PAGES))
    ranged = pages_once.repartitionByRange(n_ranges, *key).withColumn("range", F.spark_partition_id())
    ranged = save(ranged, "pages-order")
    near = F.struct("host", "hashes")
    inside = Window.partitionBy("range").orderBy(*key)
    away = {"before": -1, "before2": -2, "after": 1, "after2": 2}
    steps = {c: F.lag(near, -n) if n < 0 else F.lead(near, n) for c, n in away.items()}
    # as many tasks as ranges, whatever their bytes; the neighbours are not written, four to a page
    dealt = ranged.repartition(n_ranges, "range")
    linked = dealt.withColumns({**{c: x.over(inside) for c, x in steps.items()}, "number": F.row_number().over(inside)})
    at_end = F.greatest(*[F.col(c).isNull() for c in away])
    # pages at the ends of ranges find theirs by place in the whole order: four rows per range, dealt by place
    sizes = sorted((r["range"], r["count"]) for r in ranged.groupBy("range").count().collect())  # one number per range
    before = np.concatenate([[0], np.cumsum([n for _, n in sizes])])[:-1].tolist() if sizes else []
    offsets = spark.createDataFrame([(r, n) for (r, _), n in zip(sizes, before)], "range int, offset long")
    ends = linked.where(at_end).join(F.broadcast(offsets), "range").withColumn("place", F.col("offset") + F.col("number")).drop("offset")
    ends = save(ends, "pages-ends")
    for c, n in away.items():
        other = ends.select((F.col("place") - n).alias("place"), near.alias("found"))
        ends = ends.join(other, "place", "left").withColumn(c, F.coalesce(c, "found")).drop("found")
    whole = linked.where(~at_end).unionByName(ends.drop("place"))
    whole = whole.join(_usual_blocks(ranged), "host", "left")
    same_host = [F.when(F.col(f"{c}.host") == F.col("host"), F.col(f"{c}.hashes")).alias(c) for c in away]

    def difference(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, n_shared, plain = [], [], []
            for kinds, own, *others, usual in zip(*[batch.column(i).to_pylist() for i in range(3, 10)]):
                sides = [[np.frombuffer(x, np.uint64) for x in side if x is not None] for side in (others[:2], others[2:])]
                usual = np.array(usual or [], dtype=np.int64).view(np.uint64)
                kept, n = kept_blocks(kinds, np.frombuffer(own, np.uint64), *sides, usual)
                keep.append(kept)
                n_shared.append(n)
                plain.append(n == 0 and kept == by_markup(kinds))
            out = [*[batch.column(i) for i in range(3)], pa.array(keep, pa.list_(pa.bool_())), pa.array(n_shared, pa.int64())]
            yield pa.record_batch(out, ["host", "same", "copies", "keep", "n_shared"]).filter(pa.array([not x for x in plain], pa.bool_()))

    def assemble(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page, keep in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                found = blocks(page or "")
                visible = [t for k, t in found if k != "furniture"]
                keep = by_markup("".join(k[0] for k, _ in found).encode()) if keep is None else keep
                texts.append("\n".join([t for t, stays in zip(visible, keep, strict=True) if stays]))
            n_chars = pa.array([len(t) for t in texts], pa.int64())
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), n_chars, batch.column(4)],
                ["page_id", "url", "text", "n_chars", "n_shared"],
            )

    decided = whole.select("host", "same", "copies", "kinds", "hashes", *same_host, "usual")
    decided = save(decided.mapInArrow(difference, "host string, same binary, copies long, keep array<boolean>, n_shared long"), "pages-decided")
    decided = join_hot(table.select("key", "key2", "host", "same"), decided, ["host", "same"], "copies", hot_bound(n_rows))
    decided = decided.groupBy("key", "key2").agg(F.min(F.struct("keep", "n_shared")).alias("d"))
    decided = save(decided.select("key", "key2", "d.keep", "d.n_shared"), "pages-changed")
    n_changed, n_flags = decided.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("keep")), F.lit(0))).first()
    few = n_changed <= BROADCAST_PAGES and n_flags <= BROADCAST_FLAGS
    joined = given.join(F.broadcast(decided) if few else decided, ["key", "key2"], "left")
    joined = joined.select("page_id", "url", "html", "keep", F.coalesce("n_shared", F.lit(0)).alias("n_shared"))
    return joined.mapInArrow(assemble, "page_id long, url string, text string, n_chars long, n_shared long")
