"""Main text of web pages by differencing each page with the page of the nearest URL.

Pages become lines, one for each block element; lines inside elements that are no article by their tag, class or role (menus, forms, notices,
adverts, comments) are left out at once.  Within a host pages are ordered by URL path; a page is compared with its closest neighbours in
that order, both sides in turn, until one is not a copy of it (copies share more than half of their text, of their declared articles where there
are any).  The line hashes of the two pages are aligned by their longest common subsequence and the shared lines are deleted: what a site
repeats from page to page is template.  Shared lines inside a declared article stay, because articles of one site may quote the same passage.

A page may stand among any number of copies, or be so thin that all pages look like copies of it.  Then the lines go that two pages which are no
copies of each other share: two pages around it, or one of them and the closest page of the host that is no copy of it, however far away.  If all pages
of a host look like copies, what a page shares with both of the closest pages of other content is template, unless nothing would be left.

Only hashes of lines are sorted and compared: a range shuffle by (host, path), exact ranks from the sizes of its parts, and groups of
``CHUNK`` ranks with a margin of neighbours on both sides, so a host with a third of all pages is many groups.  Of a group of copies longer than
its chunk, each chunk sends at most two pages on to find the closest other page.  Whole texts are shuffled once, by the digest of their row.

Null or empty html gives an empty text, a null url is a host of its own with an empty path.  Repeated rows are copies of each other and get one answer.
Pages of any length are read whole.  An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import bisect
import hashlib
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import in_batches, parts_for, prepare, stored

MARGIN = 4
CHUNK = 512
COPY_SHARE = 0.5
ROWS_PER_PART = 5_000

# fixed values: elements by what they do
RAW = {"script", "style", "noscript", "template", "svg", "iframe", "object", "canvas", "title", "textarea", "math", "audio", "video", "select", "button"}
BLOCKS = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
CONTAINERS = set("article aside blockquote details dialog div dl fieldset figure footer form header main menu nav ol section table ul".split())
MAIN = {"article", "main"}
OTHER = {"nav", "footer", "aside", "form", "dialog", "menu"}
OTHER_WORDS = set("ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent notice notices gdpr alert sidebar menu nav navbar navigation breadcrumb breadcrumbs footer newsletter subscribe subscription signup share sharing social related recommended popup modal overlay widget widgets toolbar login pagination pager copyright".split())
COMMENT_WORDS = {"comment", "comments", "respond", "replies", "reply", "disqus", "discussion"}
HEAD_WORDS = {"header", "masthead", "topbar"}
# a name like "with-sidebar" or "has-ads" describes a frame, not a sidebar or an advert
FRAME_WORDS = {"has", "with", "no", "without", "layout", "wrapper", "container"}

_TAG = re.compile(r"""<!--.*?(?:-->|$)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.S)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_WORD = re.compile(r"[a-z]+")


@dataclass(frozen=True)
class Place:
    """Where a line stands: in a declared article, or in something that is no article ("comment" cannot be left by opening an article)."""

    main: bool = False
    other: str = ""


def _enter(place: Place, tag: str, attributes: str) -> Place:
    words = set()
    for m in _NAMED.finditer(attributes or ""):
        for name in m.group(1).strip("\"'").lower().split():
            own = set(_WORD.findall(name))
            words |= own if not own & FRAME_WORDS else set()
    if words & COMMENT_WORDS or place.other == "comment":
        return Place(place.main, "comment")
    if tag in MAIN or "main" in words and not place.main:
        return Place(True, "")
    if tag in OTHER or words & OTHER_WORDS or (tag == "header" or words & HEAD_WORDS) and not place.main or attributes and _HIDDEN.search(attributes):
        return Place(place.main, "other")
    return place


def lines(page: str) -> list[tuple[str, Place]]:
    """The page's blocks of text in order, white space collapsed, references decoded, with their places."""
    out: list[tuple[str, Place]] = []
    stack: list[tuple[str, Place]] = []
    place, parts, at, end = Place(), [], 0, len(page)

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append((text, place))
            parts.clear()

    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            parts.append(page[at:])
            break
        if m.start() > at:
            parts.append(page[at:m.start()])
        at = m.end()
        if m.group(2) is None:
            continue
        closing, tag = m.group(1), m.group(2).lower()
        if tag in RAW:
            if not closing and not m.group(3).rstrip().endswith("/"):
                shut = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                at = shut.end() if shut else end
            parts.append(" ")
            continue
        if tag == "br":
            parts.append(" ")
        if tag not in BLOCKS:
            continue
        flush()
        if tag in CONTAINERS:
            if closing:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        place = stack[k][1]
                        del stack[k:]
                        break
            elif not m.group(3).rstrip().endswith("/"):
                stack.append((tag, place))
                place = _enter(place, tag, m.group(3))
    flush()
    return out


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host without www. and port; path without scheme, query, fragment, trailing slash and file suffix."""
    rest = re.sub(r"^[a-zA-Z][\w+.-]*://", "", url or "")
    host, _, path = rest.partition("/")
    path = re.sub(r"\.(html?|php|aspx?|jsp)$", "", re.split(r"[?#]", path)[0].rstrip("/"), flags=re.I)
    return re.sub(r"^www\.", "", re.split(r"[?#:]", host)[0].lower()), path


def common_lines(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Pairs of places of a longest common subsequence (candidates in order of a, longest chain by patience sorting)."""
    spots: dict[int, list[int]] = {}
    for j, x in enumerate(b):
        spots.setdefault(x, []).append(j)
    tails: list[int] = []
    chain: list[tuple] = []                # chain[k]: (i, j, link to a chain of k pairs)
    for i, x in enumerate(a):
        for j in reversed(spots.get(x, ())):
            k = bisect.bisect_left(tails, j)
            node = (i, j, chain[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                chain.append(node)
            else:
                tails[k], chain[k] = j, node
    out, node = [], chain[-1] if chain else None
    while node:
        out.append(node[:2])
        node = node[2]
    return out[::-1]


def _hashed(batch: pa.RecordBatch) -> pa.RecordBatch:
    """seal, host, path, line hashes, line lengths and whether in a declared article, of a batch (seal, url, html)."""
    rows: list[list] = [[], [], [], [], []]
    for url, page in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
        found = own_lines(page)
        host, path = host_and_path(url)
        for column, value in zip(rows, (host, path, [int.from_bytes(_digest(t), "little", signed=True) for t, _ in found], [len(t) for t, _ in found], [p.main for _, p in found])):
            column.append(value)
    kinds = [pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.bool_())]
    return pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(rows, kinds)]], names=["seal", "host", "path", "hashes", "sizes", "main"])


def own_lines(page: str | None) -> list[tuple[str, Place]]:
    """The lines that the mark-up check leaves."""
    return [(t, place) for t, place in lines(page or "") if not place.other]


def _digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest()


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n))], names=[*batch.schema.names, "part", "spot"])
        at += n


class Sketch:
    """Line hashes of a page, and the lengths of the lines that tell copies: those of its declared articles, or all if it declares none."""

    def __init__(self, row: dict) -> None:
        self.hashes, self.held = row["hashes"], set(row["hashes"])
        judged = [(h, n) for h, n, main in zip(row["hashes"], row["sizes"], row["main"]) if main] or zip(row["hashes"], row["sizes"])
        self.judged: dict[int, int] = {}
        for h, n in judged:
            self.judged[h] = self.judged.get(h, 0) + n
        self.whole = sum(self.judged.values())

    def inside(self, other: Sketch) -> bool:
        return sum(self.judged[h] for h in self.judged.keys() & other.held) > COPY_SHARE * self.whole

    def copies(self, other: Sketch) -> bool:
        return self.hashes == other.hashes or self.inside(other) or other.inside(self)


def _outwards(i: int, lo: int, hi: int) -> Iterator[int]:
    """Places of lo..hi-1 other than i, the closest first."""
    for step in range(1, max(i - lo, hi - 1 - i) + 1):
        for j in (i - step, i + step):
            if lo <= j < hi:
                yield j


def _thin(sketches: list[Sketch], i: int, lo: int, hi: int) -> list[int]:
    """Lines that page i shares with both of the closest pages of other content, unless that is all of it."""
    others: list[Sketch] = []
    for j in _outwards(i, lo, hi):
        if sketches[j].hashes and all(sketches[j].held != s.held for s in (sketches[i], *others)):
            others.append(sketches[j])
            if len(others) == 2:
                break
    if len(others) < 2:
        return []
    first, second = ({a for a, _ in common_lines(sketches[i].hashes, s.hashes)} for s in others)
    both = first & second
    return sorted(both) if len(both) < len(sketches[i].hashes) else []


def _template(a: Sketch, b: Sketch) -> list[int]:
    return [a.hashes[i] for i, _ in common_lines(a.hashes, b.hashes)]


FOUND = pa.schema([("seal", pa.int64()), ("gone", pa.list_(pa.int32())), ("chunk", pa.int64()), ("host", pa.string()), ("open", pa.bool_()), ("lead", pa.bool_()),
                   ("hashes", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("main", pa.list_(pa.bool_()))])
FOUND_DDL = "seal long, gone array<int>, chunk long, host string, open boolean, lead boolean, hashes array<long>, sizes array<int>, main array<boolean>"


def _deleted(table: pa.Table) -> pa.Table:
    """Lines of the chunk's own pages that the closest page of the host that is no copy shares.

    ``open`` pages have only copies around them in a chunk that their host leaves; ``gone`` holds what goes if all the host's pages are like that.
    ``lead`` rows are the first page of a host in a chunk that it leaves, and the first that is no copy of it.
    """
    rows = sorted(table.to_pylist(), key=lambda r: r["rank"])
    sketches, out, lo = [Sketch(r) for r in rows], [], 0
    while lo < len(rows):
        hi = lo + 1
        while hi < len(rows) and rows[hi]["host"] == rows[lo]["host"]:
            hi += 1
        mine = [i for i in range(lo, hi) if not rows[i]["margin"]]
        filled = [i for i in range(lo, hi) if sketches[i].hashes]
        leads = filled[:1] + [i for i in filled if not sketches[i].copies(sketches[filled[0]])][:1]
        leaves = len(mine) < hi - lo
        shared = set(_template(*[sketches[i] for i in leads])) if len(leads) == 2 else None
        judged: dict[tuple, bool] = {}
        for i in mine:
            own = sketches[i]
            if not own.hashes:
                continue
            gone, still = None, False
            for j in _outwards(i, lo, hi):
                if sketches[j].hashes:
                    pair = tuple(own.hashes), tuple(sketches[j].hashes)
                    if pair not in judged:
                        judged[pair] = own.copies(sketches[j])
                    if not judged[pair]:
                        gone = [a for a, _ in common_lines(own.hashes, sketches[j].hashes)]
                        break
            if gone is None and shared is not None:
                gone = [a for a, h in enumerate(own.hashes) if h in shared]
            elif gone is None:
                gone, still = _thin(sketches, i, lo, hi), leaves
            if gone or still:
                out.append({"seal": rows[i]["seal"], "gone": gone, "open": still, "lead": False, "hashes": own.hashes if still else None, "chunk": rows[i]["chunk"], "host": rows[i]["host"]})
        if leaves and mine:
            out += [{**{k: rows[i][k] for k in ("hashes", "sizes", "main", "host")}, "chunk": rows[mine[0]]["chunk"], "open": False, "lead": True} for i in leads]
        lo = hi
    return pa.Table.from_pylist(out, FOUND)


def _far(table: pa.Table) -> pa.Table:
    """Template lines of every chunk of a host that holds only copies: what its first page shares with the closest page that is no copy of it."""
    rows = sorted(table.to_pylist(), key=lambda r: (r["chunk"], r["hashes"]))
    sketches, out = [Sketch(r) for r in rows], []
    for i, row in enumerate(rows):
        other = next((j for j in _outwards(i, 0, len(rows)) if not sketches[i].copies(sketches[j])), None)
        if other is not None:
            out.append({"chunk": row["chunk"], "host": row["host"], "template": _template(sketches[i], sketches[other])})
    return pa.Table.from_pylist(out, pa.schema([("chunk", pa.int64()), ("host", pa.string()), ("template", pa.list_(pa.int64()))]))


def _texts(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts, counts = [], []
    for page, gone in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
        deleted = set(gone or ())
        texts.append("\n".join(t for k, (t, place) in enumerate(own_lines(page)) if k not in deleted or place.main))
        counts.append(len(texts[-1]))
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(counts, pa.int64())], names=["key", "url", "text", "n_chars"])


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """key, url, text and n_chars (code points) of every row."""
    spark = pages.sparkSession
    prepare(spark)
    kind = pages.schema[key].dataType.simpleString()
    given = pages.select(F.xxhash64(key, url, page).alias("seal"), F.col(key).alias("key"), F.col(url).alias("url"), F.col(page).alias("html"))
    hashed = stored(given.select("seal", "url", "html").mapInArrow(in_batches(_hashed), "seal long, host string, path string, hashes array<long>, sizes array<int>, main array<boolean>"))
    total = hashed.count()
    line_up = hashed.repartitionByRange(parts_for(total, ROWS_PER_PART), "host", "path", "seal").sortWithinPartitions("host", "path", "seal")
    line_up = stored(line_up.mapInArrow(_numbered, "seal long, host string, path string, hashes array<long>, sizes array<int>, main array<boolean>, part int, spot long"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)          # one row a part
    offsets = line_up.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    ranked = line_up.join(offsets, "part").withColumn("rank", F.col("offset") + F.col("spot"))
    chunk, place = F.floor(F.col("rank") / CHUNK), F.col("rank") % CHUNK
    seats = F.array_compact(F.array(F.struct(chunk.alias("chunk"), F.lit(False).alias("margin")),
                                    F.when(place < MARGIN, F.struct((chunk - 1).alias("chunk"), F.lit(True).alias("margin"))),
                                    F.when(place >= CHUNK - MARGIN, F.struct((chunk + 1).alias("chunk"), F.lit(True).alias("margin")))))
    seated = ranked.select("seal", "host", "hashes", "sizes", "main", "rank", F.inline(seats))
    found = stored(seated.groupBy("chunk").applyInArrow(_deleted, FOUND_DDL))
    still = found.where("open").select("seal", "gone", "chunk", "host", "hashes")
    # at most two pages a chunk, of hosts with such pages only
    leads = found.where("lead").join(still.select("host").distinct(), "host", "left_semi").select("chunk", "host", "hashes", "sizes", "main")
    far = leads.groupBy("host").applyInArrow(_far, "chunk long, host string, template array<long>").groupBy("host", "chunk").agg(F.min("template").alias("template"))
    places = F.filter(F.sequence(F.lit(0), F.size("hashes") - 1), lambda i: F.array_contains("template", F.get("hashes", i)))
    closed = still.join(far, ["host", "chunk"], "left").select("seal", F.when(F.col("template").isNull(), F.col("gone")).otherwise(places).alias("gone"))
    gone = found.where("NOT open AND NOT lead").select("seal", "gone").unionByName(closed).groupBy("seal").agg(F.min("gone").alias("gone"))
    met = given.join(gone.hint("merge"), "seal", "left").select("key", "url", "html", "gone")
    out = met.mapInArrow(in_batches(_texts), f"key {kind}, url string, text string, n_chars long")
    return out.select(F.col("key").alias(key), F.col("url").alias(url), "text", "n_chars")
