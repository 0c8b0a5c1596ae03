"""Main text of web pages by differencing pages with their nearest URL.

1. A page is read into text lines (one per block element); head, scripts,
   styles, forms, comments and markup yield none.  A line belongs to a declared
   article, to a declared part of the page's frame (menus, headers, footers,
   sidebars, notices, adverts, reader comments), or to neither.
2. Pages are ordered by host and URL path.  The order is cut into ranges at
   pages picked by a hash, so a host of any size is spread over many tasks and
   the result does not depend on how Spark deals out rows.  In its range every
   page is paired with the neighbour of the same host whose path shares the
   longer prefix.
3. The lines of a pair are aligned by longest common subsequence, and shared
   lines are deleted: what two neighbours have in common is the site's frame.

Lines of the declared frame are never text.  Lines outside an article are text
if the pair does not share them, also on pages that have an article.  If the
nearer neighbour shares every line (a copy) or no line at all (another layout),
the other neighbour is taken; if that does, too, nothing is deleted, except that
an article at least as long as the lines outside it is then the text alone.

Lines of an article may recur on other pages as its own text (quotations,
licence lines, copies), so one pair does not decide them: they are deleted if
the alignments with all the nearest pages of the host (``SIDE`` on each side,
``LEAST_WITNESSES`` at least) share them.  Articles that share half of their
text or more are copies of each other and say nothing about the frame.

Defined cases: null and empty pages have no text; pages without a URL share
one host; repeated rows are neighbours of each other; unclosed and stray tags
are tolerated; only id, url and html are read, so extra columns cannot clash.
"""

from __future__ import annotations

import bisect
import html
import os
import re
from collections import deque
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureforge.llm.words import blocks

#: Pages per range on average, and ranges at most.
RANGE_PAGES = 512
MAX_RANGES = 1 << 16
#: Pages per differencing task on average.
TASK_PAGES = 2048
#: Pages before and after that may witness an article line as frame, and how many must.
SIDE, LEAST_WITNESSES = 4, 4

# HTML element names by what they mean here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math object select xmp".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt "
                   "ruby s samp small span strike strong sub sup time tt u var wbr".split())
FRAME = frozenset("nav footer aside form dialog menu button head".split())
FRAME_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu "
                        "menubar form".split())
FRAME_NAMES = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner "
                        "cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe sidebar "
                        "menu nav navbar navigation breadcrumb breadcrumbs footer masthead comment comments disqus "
                        "share sharing social related recommended widget login signup search pagination".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_NAME = re.compile(r"[^a-z0-9]+")

FRAME_PART, PLAIN, ARTICLE = 0, 1, 2


def _region(name: str, attributes: str, inside: int) -> int | None:
    """Kind of part that an element opens, if any."""
    if name in ("html", "body"):
        return None
    found = {}
    if attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            found.setdefault(m[1].lower(), m[2].strip("\"'").lower())
    names = {x for key in ("class", "id") if key in found for x in _NAME.split(found[key])}
    if name in FRAME or found.get("role") in FRAME_ROLES or names & FRAME_NAMES:
        return FRAME_PART
    if name == "header" and inside != ARTICLE:
        return FRAME_PART
    if name in ("article", "main") or found.get("role") in ("main", "article"):
        return ARTICLE
    return None


def page_lines(source: str | None) -> list[tuple[int, str]]:
    """(part, text) of each block of a page in order."""
    if not source:
        return []
    out: list[tuple[int, str]] = []
    piece: list[str] = []
    stack: list[tuple[str, int]] = []  # open elements and the part they stand in
    part = PLAIN

    def flush():
        if piece:
            text = " ".join("".join(piece).split())
            if text:
                out.append((part, text))
            piece.clear()

    at = 0
    while True:
        m = _TAG.search(source, at)
        if m is None:
            if at < len(source):
                piece.append(html.unescape(source[at:]))
            break
        if m.start() > at:
            piece.append(html.unescape(source[at:m.start()]))
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if name not in INLINE:
            flush()
        if m[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    if stack[k][1] != part:
                        flush()
                    part = stack[k][1]
                    del stack[k:]
                    break
        elif name in RAW:
            if not m[3].endswith("/"):
                close = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(source, at)
                at = close.end() if close else len(source)
        elif name not in VOID:
            if name == "body":
                part = PLAIN
                stack.clear()
            opened = _region(name, m[3], part)
            if opened is not None or name not in INLINE:
                stack.append((name, part))
            if opened is not None:
                flush()
                part = opened
    flush()
    return out


def common_lines(a: list, b: list) -> list[bool]:
    """Which items of ``a`` are in a longest common subsequence with ``b``
    (bit-parallel rows, then a walk back)."""
    shared = [False] * len(a)
    low, high, end = 0, len(a), len(b)
    while low < min(high, end) and a[low] == b[low]:
        shared[low] = True
        low += 1
    while high > low and end > low and a[high - 1] == b[end - 1]:
        high, end = high - 1, end - 1
        shared[high] = True
    a, b, offset = a[low:high], b[low:end], low
    where: dict = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | (1 << j)
    full = (1 << len(b)) - 1
    rows, v = [full], full
    for x in a:
        hit = v & where.get(x, 0)
        v = ((v + hit) | (v - hit)) & full
        rows.append(v)
    i, j = len(a), len(b)
    while i and j:
        if rows[i] >> (j - 1) & 1:  # the last item of b adds nothing here
            j -= 1
        elif not rows[i - 1] >> (j - 1) & 1 and \
                (rows[i - 1] & ((1 << j) - 1)).bit_count() == (rows[i] & ((1 << j) - 1)).bit_count():
            i -= 1  # nor does the last item of a
        else:
            i -= 1
            if a[i] == b[j - 1]:
                shared[offset + i] = True
                j -= 1
    return shared


def article_frame(row: dict, near: list[dict]) -> set[int]:
    """Numbers of the row's article lines that all witnesses among ``near`` share."""
    def article(r):
        return [i for i, a in enumerate(r["article"]) if a]

    own = article(row)
    hashes = [row["hashes"][i] for i in own]
    size = [len(row["lines"][i]) for i in own]
    found, witnesses = set(own), 0
    for r in near:
        other = article(r)
        if not other or not found:
            continue
        shared = common_lines(hashes, [r["hashes"][i] for i in other])
        least = min(sum(size), sum(len(r["lines"][i]) for i in other))
        if 2 * sum(n for n, s in zip(size, shared) if s) < least:
            found &= {i for i, s in zip(own, shared) if s}
            witnesses += 1
    return found if witnesses >= LEAST_WITNESSES else set()


def text_lines(row: dict, before: list[dict], after: list[dict]) -> list[str]:
    """Text of a page from its nearest pages of the same host, nearest first."""
    lines, article = row["lines"], row["article"]
    own = [i for i, x in enumerate(lines) if x is not None]
    outside = [i for i in own if not article[i]]
    deleted: set[int] = set()
    if outside:
        pair = sorted(before[:1] + after[:1], key=lambda r: -_prefix(r["path"], row["path"]))
        for r in pair:
            shared = common_lines(row["hashes"], r["hashes"])
            if any(shared) and not all(shared[i] for i in own):
                deleted = {i for i in outside if shared[i]}
                break
        else:
            if len(outside) < len(own) and sum(len(lines[i]) for i in own) >= 2 * sum(len(lines[i]) for i in outside):
                deleted = set(outside)
    if len(outside) < len(own):
        deleted |= article_frame(row, before + after)
    return [lines[i] for i in own if i not in deleted]


def url_key(url: str | None) -> tuple[str, str]:
    """Host and path of a URL."""
    rest = re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*://", "", url or "")
    host, slash, path = rest.partition("/")
    return host.lower(), re.split(r"[?#]", slash + path, maxsplit=1)[0]


def _prefix(a: str, b: str) -> int:
    return len(os.path.commonprefix([a, b]))


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, ``text`` (main text) and ``n_lines`` (blocks it joins)."""
    given = pages.select(F.col(id_col).alias("p"), F.col(url_col).alias("u"), F.col(html_col).alias("t"))
    n = given.count()
    every = max(RANGE_PAGES, n // MAX_RANGES)
    picked = given.where(F.pmod(F.xxhash64("p", "u"), F.lit(every)) == 0).select("u").distinct().collect()
    cuts = sorted(url_key(r["u"]) for r in picked)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "t"):
                keys = [url_key(u) for u in block.column("u").to_pylist()]
                lines, hashes, article = [], [], []
                for source in block.column("t").to_pylist():
                    found = page_lines(source)
                    # the text of lines that may stay, null for those that cannot
                    lines.append([x if part != FRAME_PART else None for part, x in found])
                    article.append([part == ARTICLE for part, _ in found])
                    hashes.append(np.array([xxhash.xxh3_64_intdigest(x) for _, x in found], np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bisect.bisect_right(cuts, k) for k in keys], pa.int32()),
                     pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys]), block.column("p"),
                     block.column("u"), pa.array(article, pa.list_(pa.bool_())), pa.array(hashes, pa.list_(pa.int64())),
                     pa.array(lines, pa.list_(pa.string()))],
                    ["range_id", "host", "path", "p", "u", "article", "hashes", "lines"])

    def difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stream():
            for batch in batches:
                yield from batch.to_pylist()

        def results():
            rows = stream()
            window = deque(islice(rows, SIDE + 1))  # the page at ``at`` and up to SIDE pages on each side
            at = 0
            while at < len(window):
                row = window[at]
                same = [r["range_id"] == row["range_id"] and r["host"] == row["host"] for r in window]
                yield row, text_lines(row, [window[k] for k in range(at - 1, -1, -1) if same[k]],
                                      [window[k] for k in range(at + 1, len(window)) if same[k]])
                window.extend(islice(rows, 1))
                at += 1
                if at > SIDE:
                    window.popleft()
                    at -= 1

        held = []
        for row, lines in results():
            held.append((row["p"], row["u"], " ".join(lines), len(lines)))
            if len(held) >= 512:
                yield _out(held)
                held = []
        if held:
            yield _out(held)

    def _out(held):
        columns = list(zip(*held))
        return pa.RecordBatch.from_arrays([pa.array(columns[0], id_type), pa.array(columns[1], pa.string()),
                                           pa.array(columns[2], pa.string()), pa.array(columns[3], pa.int64())],
                                          ["p", "u", "text", "n_lines"])

    from pyspark.sql.pandas.types import to_arrow_type
    id_type = to_arrow_type(given.schema["p"].dataType)
    kind = given.schema["p"].dataType.simpleString()
    parsed = given.mapInArrow(read, f"range_id int, host string, path string, p {kind}, u string, article array<boolean>, "
                                    "hashes array<long>, lines array<string>")
    return (parsed.repartition(max(n // TASK_PAGES, 1), "range_id").sortWithinPartitions("range_id", "host", "path", "u", "p")
            .mapInArrow(difference, f"p {kind}, u string, text string, n_lines long")
            .withColumnRenamed("p", id_col).withColumnRenamed("u", url_col))
