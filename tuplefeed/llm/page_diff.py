"""Main text by differencing pages with their nearest neighbour by URL.

Pages become lines (blocks of text). Pages of a host with the same lines are one class, and stand at
the first of their paths. All classes are ordered by host and URL path, and each is paired with that
neighbour of its own host whose path shares more with its own. The longest common subsequence of the
two pages' lines is what the site's template repeats: shared lines are deleted. A neighbour is a copy
if what is not shared is the same on both sides; then the other neighbour is taken.
Lines that the markup itself puts outside the article (menus, adverts, footers, forms, comments)
go as well. Inside an ``article`` or ``main`` element, lines go that both neighbours share. Pages of
one site may carry the same article twice: a neighbour with half of the article's text does not count.

Classes are numbered along the order, so a host with a third of all pages is spread over many tasks,
and only hashes and sizes of lines travel between pages. Pages are parsed once for these and
once for the result, since hashes are much smaller than lines to keep.

Defined results: null or empty html gives an empty text; a null URL has an empty host and path;
repeated rows are pages each; a page alone on its host keeps all lines that its markup allows; an
empty table gives no rows; pages of any length are taken whole, in time linear in their markup
(tags without an end are text); other columns are dropped.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tuplefeed.llm.common import prepared, settled

RAW = re.compile(r"(?is)<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|iframe|textarea|select)\b.*?(?:</\1\s*>|\Z)")
OPENING = re.compile(r"<(?:(/?)([a-zA-Z][a-zA-Z0-9]*)|[!?])")
STOP = re.compile(r"[>\"']")
NAMED = re.compile(r"(?i)\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)")
ASIDE = re.compile(
    r"(?i)(?:^|[\s_\"'-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|consent|cookies?|disqus|footer|header|login|masthead|"
    r"menu|modal|nav\w*|newsletter|notices?|popup|promo\w*|related|repl(?:y|ies)|search|share|sidebar|signup|social|"
    r"sponsor\w*|subscribe|widget|complementary|contentinfo)(?:$|[\s_\"'-])"
)
OUTSIDE = {"head", "nav", "footer", "aside", "form", "button", "menu", "dialog", "header"}
INSIDE = {"article", "main"}
BLOCKS = OUTSIDE | INSIDE | set(
    "address blockquote body center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hr html "
    "legend li ol p pre section summary table tbody tfoot thead title tr ul".split()
)
SPACED = {"br", "td", "th", "wbr", "img", "option"}
ITEMS = {"p", "li", "dd", "dt", "tr"}  # may stay unclosed; held only where they are named as outside
HELD = BLOCKS - ITEMS - {"hr"} | {"span"}


def tags(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, slash, name, attributes) of every tag; a ``>`` in quotes does not end one.

    What opens like a tag and never ends is text. Where a tag ends is worked out from the back, once
    for every quote and ``>``, so that the time is linear however many openings have no end.
    """
    places = [m.start() for m in STOP.finditer(page)]
    ends, later = [-1] * (len(places) + 1), {}
    for k in range(len(places) - 1, -1, -1):
        char = page[places[k]]
        if char == ">":
            ends[k] = places[k]
        else:
            if char in later:
                ends[k] = ends[later[char] + 1]
            later[char] = k
    last, at, k = page.rfind(">"), 0, 0
    while (m := OPENING.search(page, at)) and m.end() <= last:
        while places[k] < m.end():
            k += 1
        end = ends[k] if m[2] else page.find(">", m.end())
        at = m.end() if end < 0 else end + 1
        if end >= 0:
            yield m.start(), at, m[1] or "", m[2] or "", page[m.end() : end] if m[2] else ""


def lines_of(page: str | None) -> list[tuple[str, int]]:
    """(text, where) of every block: 1 inside an article, -1 outside by its markup, else 0."""
    found: list[tuple[str, int]] = []
    page = RAW.sub(" ", page or "")
    open_tags: list[tuple[str, bool, bool, str]] = []  # name, outside, inside, innermost but for spans
    n_open: Counter[str] = Counter()
    held: list[str] = []
    outside = inside = False

    def item() -> str:
        """The innermost open element, if it is one of ``ITEMS``."""
        return open_tags[-1][3] if open_tags and open_tags[-1][3] in ITEMS else ""

    def pop() -> tuple[str, bool, bool, str]:
        last = open_tags.pop()
        n_open[last[0]] -= 1
        return last

    def close_block() -> None:
        text = " ".join("".join(held).split())
        if text:
            found.append((text, -1 if outside else int(inside)))
        held.clear()

    done = 0
    for start, end, slash, name, attributes in tags(page):
        if start > done:
            text = page[done:start]
            held.append(html.unescape(text) if "&" in text else text)
        done, name = end, name.lower()
        if name in SPACED:
            held.append(" ")
        if name not in BLOCKS and name != "span":
            continue
        attributes = "" if slash else attributes
        named = bool(attributes) and any(ASIDE.search(a) for a in NAMED.findall(attributes))
        if name in BLOCKS or named:
            close_block()
        if not slash and name in BLOCKS and (last := item()) and (last in ("p", name) or {last, name} <= {"dd", "dt"}):
            while open_tags[-1][0] == "span":
                pop()
            _, outside, inside, _ = pop()
        if name not in HELD and not (name in ITEMS and (item() == name if slash else named)):
            continue
        if not slash:
            if not attributes.endswith("/"):
                around = open_tags[-1][3] if open_tags else ""
                open_tags.append((name, outside, inside, around if name == "span" else name))
                n_open[name] += 1
                outside = outside or (name in OUTSIDE and not (name == "header" and inside)) or (named and name not in ("html", "body", *INSIDE))
                inside = inside or name in INSIDE
        elif n_open[name]:
            while True:
                last, was_outside, was_inside, _ = pop()
                if was_outside != outside or was_inside != inside:
                    close_block()
                outside, inside = was_outside, was_inside
                if last == name:
                    break
    text = page[done:]
    held.append(html.unescape(text) if "&" in text else text)
    close_block()
    return found


def common_lines(a: list[int], b: list[int]) -> set[int]:
    """Places of ``a`` in a longest common subsequence, by bit-parallel rows."""
    at: dict[int, int] = {}
    for j, line in enumerate(b):
        at[line] = at.get(line, 0) | 1 << j
    mine = [i for i, line in enumerate(a) if line in at]
    full = (1 << len(b)) - 1
    row, rows = full, []
    for i in mine:
        met = row & at[a[i]]
        row = ((row + met) | (row - met)) & full
        rows.append(row)
    shared: set[int] = set()
    i, j = len(mine) - 1, len(b)

    def length(i: int, j: int) -> int:
        return j - (rows[i] & ((1 << j) - 1)).bit_count() if i >= 0 else 0

    while i >= 0 and j > 0:
        here = length(i, j)
        if here == 0:
            break
        if length(i - 1, j) == here:
            i -= 1
        elif length(i, j - 1) == here:
            j -= 1
        else:
            shared.add(mine[i])
            i, j = i - 1, j - 1
    return shared


def _alike(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


Lines = tuple[list[int], list[int]]  # hashes, and the size of each line inside an article, else 0


def template_lines(path: str, page: Lines, neighbours: list[tuple[str, Lines]]) -> list[int]:
    """Places of the lines that are template: what the nearest neighbour shares that is no copy of
    the page and, inside an article, what both share."""
    lines, inside = page
    met = []
    for _, (other, other_inside) in sorted(neighbours, key=lambda n: -_alike(path, n[0])):
        shared = common_lines(lines, other)
        both = Counter(lines[k] for k in shared)
        met.append((shared, Counter(lines) - both, Counter(other) - both, other_inside))
    different = [m for m in met if m[1] != m[2]]
    # A page that holds all lines of the other may be a longer copy; it counts if there is none better.
    nearest = next((m for m in different if m[1] and m[2]), different[0] if different else None)
    gone = {k for k in nearest[0] if not inside[k]} if nearest else set()
    size = sum(inside)
    no_copies = [m[0] for m in met if 2 * sum(inside[k] for k in m[0]) < min(size, sum(m[3]) or size)]
    if len(no_copies) > 1:
        gone |= {k for k in set.intersection(*no_copies) if inside[k]}
    return sorted(gone)


def _read(pages: DataFrame) -> DataFrame:
    """Pages with host, path, and a salt."""
    prepared(pages.sparkSession)
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"], F.coalesce(pages["html"], F.lit("")).alias("html"))
    return rows.select(
        "page_id", "url", "html", F.pmod(F.xxhash64("page_id", "url"), F.lit(64)).alias("salt"),
        F.lower(F.coalesce(F.regexp_extract("url", r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1), F.lit(""))).alias("host"),
        F.coalesce(F.regexp_extract("url", r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1), F.lit("")).alias("path"),
    )


def _class_of(lines: list[tuple[str, int]]) -> tuple[list[int], list[int], bytes]:
    """Hashes, sizes inside articles, and a hash of both."""
    hashes = [xxhash.xxh64_intdigest(t) - 2**63 for t, _ in lines]
    inside = [len(t) if w == 1 else 0 for t, w in lines]
    return hashes, inside, xxhash.xxh3_128_digest(json.dumps([hashes, inside]))


def _line_hashes(pages: DataFrame) -> DataFrame:
    """(host, class, path, salts, hashes, inside): pages of a host with equal lines are one class.

    ``salts`` are those of its pages, so that a class of many is joined in many tasks.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [_class_of(lines_of(h)) for h in b.column(3).to_pylist()]
            columns = [
                *b.columns[:3], pa.array([m[2] for m in made], pa.binary()),
                pa.array([m[0] for m in made], pa.list_(pa.int64())), pa.array([m[1] for m in made], pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["host", "path", "salt", "class", "hashes", "inside"])

    rows = pages.select("host", "path", "salt", "html")
    made = rows.mapInArrow(task, "host string, path string, salt long, class binary, hashes array<long>, inside array<int>")
    return made.groupBy("host", "class").agg(
        F.min("path").alias("path"), F.collect_set("salt").alias("salts"), F.first("hashes").alias("hashes"), F.first("inside").alias("inside")
    )


def main_text(lines: list[tuple[str, int]], shared: list[int]) -> str:
    """The lines that neither markup nor template claims; of a page with an article, those inside."""
    gone, where = set(shared), int(any(w == 1 for _, w in lines))
    return "\n".join(t for i, (t, w) in enumerate(lines) if w == where and i not in gone)


def _numbered(pages: DataFrame) -> DataFrame:
    """``pages`` with ``at``, their place in the order of host and path."""
    order = ["host", "path", "class"]
    within = F.monotonically_increasing_id()
    parts = pages.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "*", F.shiftright(within, 33).alias("part"), within.bitwiseAND(F.lit((1 << 33) - 1)).alias("place")
    )
    sorted_pages = settled(parts, "page-order")
    sizes = sorted(sorted_pages.groupBy("part").count().collect())  # one row per partition
    starts, total = [], 0
    for part, n in sizes:
        starts.append((part, total))
        total += n
    offsets = pages.sparkSession.createDataFrame(starts, "part long, start long")
    return sorted_pages.join(F.broadcast(offsets), "part").withColumn("at", F.col("start") + F.col("place"))


def extract(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars, and how many lines are template."""
    read = _read(pages)
    keys = _numbered(_line_hashes(read))

    def beside(step: int, name: str) -> DataFrame:
        return keys.select((F.col("at") + step).alias("at"), *(F.col(c).alias(f"{name}_{c}") for c in ("host", "path", "hashes", "inside")))

    trio = keys.join(beside(1, "before"), "at", "left").join(beside(-1, "after"), "at", "left")
    wanted = ["host", "class", "salts", "path", "hashes", "inside"]
    wanted += [f"{name}_{c}" for name in ("before", "after") for c in ("host", "path", "hashes", "inside")]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shared = [
                template_lines(r["path"], (r["hashes"], r["inside"]), [
                    (r[f"{n}_path"], (r[f"{n}_hashes"], r[f"{n}_inside"])) for n in ("before", "after") if r[f"{n}_host"] == r["host"]
                ])
                for r in b.to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(shared, pa.list_(pa.int32()))], names=["host", "class", "salts", "shared"])

    shared = trio.select(*wanted).mapInArrow(compare, "host string, class binary, salts array<long>, shared array<int>")
    by_class = shared.select("host", "class", F.explode("salts").alias("salt"), "shared")

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for b in batches:
            found = [lines_of(h) for h in b.column(4).to_pylist()]
            lines = [pack.compress(json.dumps(f).encode()) for f in found]
            columns = [*b.columns[:4], pa.array([_class_of(f)[2] for f in found], pa.binary()), pa.array(lines, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "host", "salt", "class", "lines"])

    small = read.select("page_id", "url", "host", "salt", "html").mapInArrow(
        shrink, "page_id long, url string, host string, salt long, class binary, lines binary"
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            gone = b.column(3).to_pylist()
            texts = [main_text(json.loads(unpack.decompress(d)), g) for d, g in zip(b.column(2).to_pylist(), gone, strict=True)]
            columns = [
                *b.columns[:2], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()), pa.array(map(len, gone), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars", "n_shared"])

    joined = small.join(by_class, ["host", "class", "salt"]).select("page_id", "url", "lines", "shared")
    return joined.mapInArrow(finish, "page_id long, url string, text string, n_chars long, n_shared long")
