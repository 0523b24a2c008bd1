"""Main text of web pages (operator 2).

A page is cut into blocks by its block-level elements. Structure tells most of them: what lies in menus, headers,
footers, sidebars, notices, adverts, forms and reader comments is dropped, and what lies in an article (or, without one,
in a main region or a container named like one) is kept whole. Blocks of pages without any such region are told
by their host: page token streams are concatenated and sorted by a suffix array as far as a run must be long; runs
that several distinct pages of the host share are boilerplate and are removed, unique runs stay.

A suffix array is built over at most a bounded number of pages. The pages of a larger host are dealt to several arrays
by a hash; a run that a share of all pages holds is on at least that share of the pages of some array, so that none is
missed, and what one array finds holds for the whole host. Only 32-bit token hashes are shuffled; the texts are read
again for the result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from acreage.llm.shared import cut_lineage, small_batches
from acreage.llm.words import NON_SPACE, find_words, gathered, grams, mix, texts_of

#: Tokens of the shortest run that is boilerplate; a power of two.
RUN = 8
#: Pages of a host that must hold it: so many, and so many percent of a suffix array's pages.
LEAST_PAGES, PERCENT = 2, 2
#: About so many pages of a host go into one suffix array.
ARRAY_PAGES = 512
#: Most hosts with several arrays, and most boilerplate runs, that are broadcast; both are counted first.
BROADCAST_ROWS = 1_000_000
#: Pages whose tokens are held at once when runs are looked up.
LOOKUP_PAGES = 256

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "select summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements whose content is not on the page, and further ones whose content is never main text.
UNSEEN = frozenset("script style noscript template iframe object svg math canvas audio video map".split())
DROPPED = frozenset("head title nav aside footer form button select textarea dialog menu search".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar status".split())
#: Words in class and id attributes of what is not main text.
DROPPED_WORDS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead topbar footer sidebar aside widget ad ads adv "
    "advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice "
    "popup modal overlay newsletter subscribe subscription share sharing social related recommended recommendations "
    "comment comments respond reply replies disqus login signup search searchbox pagination pager skip toolbar".split()
)
#: Words in class and id attributes of containers of main text.
REGION_WORDS = frozenset(
    "article articlebody articlecontent articletext post postbody postcontent posttext entry entrycontent entrybody story "
    "storybody storycontent content maincontent pagecontent".split()
)

#: Last parts of names that tell a state of the element, and words of articles that only point to another one.
STATES = frozenset("open opened closed active visible enabled expanded collapsed".split())
POINTERS = frozenset("teaser card preview excerpt".split())

_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
#: An open paragraph ends where one of these starts.
_ENDS_PARAGRAPH = BLOCK - {"option", "optgroup", "legend"}
#: Elements whose ids are anchors.
_ANCHORED = frozenset("section h1 h2 h3 h4 h5 h6 p".split())
_NEVER_NAMED = frozenset("html body main article".split())
_DROPPED_INSIDE = DROPPED_WORDS - {"header"}
_ANY_CONTENT = frozenset("area articles bar block box buttons container content form items links list posts section stories wrapper".split())
#: Elements that end an open element of the same kind, up to the container named.
_SIBLINGS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}


def _name_words(name: str | None) -> list[str]:
    """Lowered words of a class or id attribute, without names that tell a state, as menu-open."""
    words: list[str] = []
    for one in (name or "").split():
        parts = [w.lower() for w in _NAME_PARTS.findall(one)]
        if len(parts) < 2 or parts[-1] not in STATES:
            words += parts
    return words


def _named_to_drop(tag: str, classes: list[str], ids: list[str], inside: bool) -> bool:
    """Whether words of class and id tell that an element is not main text.

    Inside an article or main region a header holds the headline, and ids of sections and headings are mostly anchors
    made from headlines, so there the last word counts (reader-comments, but not social-history), and before words for
    any content (related-posts) all do.
    """
    words = _DROPPED_INSIDE if inside else DROPPED_WORDS
    if not words.isdisjoint(classes):
        return True
    if inside and tag in _ANCHORED and ids and ids[-1] not in _ANY_CONTENT:
        return ids[-1] in words
    return not words.isdisjoint(ids)


#: What attributes told before, emptied when full; a plain table, since it travels to workers with the functions.
_TOLD: dict[tuple[str, str | None, str | None, bool], tuple[bool, bool, bool]] = {}
_MOST_TOLD = 8192


def _told(tag: str, classes: str | None, ids: str | None, inside: bool) -> tuple[bool, bool, bool]:
    """What the attributes tell: the element is to drop, only points to an article, is a container of main text."""
    key = (tag, classes, ids, inside)
    known = _TOLD.get(key)
    if known is None:
        if len(_TOLD) >= _MOST_TOLD:
            _TOLD.clear()
        words = _name_words(classes)
        whole = {w.lower().replace("-", "").replace("_", "") for names in (classes, ids) for w in (names or "").split()}
        known = _TOLD[key] = _named_to_drop(tag, words, _name_words(ids), inside), not POINTERS.isdisjoint(words), not REGION_WORDS.isdisjoint(whole)
    return known


class _Page(HTMLParser):
    """Blocks of one page: (text, region bits, dropped, droppable).

    An element is dropped for good by its kind, role or state, and droppable by words of its names or as a form. What is
    droppable only by elements round its article or main region is marked as such, since these may be the whole page.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, int, bool, bool]] = []
        #: Text of the open block, and text in it that is dropped.
        self.parts: list[str] = []
        self.other: list[str] = []
        #: Open elements: (tag, region bits so far, 1 if dropped, 2 if unseen so far, 1 if only elements round its region drop it).
        self.open: list[tuple[str, int, int, int]] = [("", 0, 0, 0)]
        #: Places in ``open`` by tag, so that no tag walks through all open elements.
        self.places: dict[str, list[int]] = {}

    def _flush(self) -> None:
        for parts, dropped in ((self.parts, False), (self.other, True)):
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                self.blocks.append((text, self.open[-1][1], dropped, bool(dropped and self.open[-1][3])))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.handle_data("\n")
            return
        if tag in BLOCK:
            self._flush()
            if tag in _ENDS_PARAGRAPH:
                self._close("p", ("article", "main", "section", "div", "td", "li", "body"))
            if tag in _SIBLINGS:
                self._close(tag, _SIBLINGS[tag])
        if tag in VOID:
            return
        _, region, dropped, around = self.open[-1]
        held = dict(attrs)
        inside = bool(region & 6)
        named, points, contains = _told(tag, held.get("class"), held.get("id"), inside) if held else (False, False, False)
        if tag == "article" and not points:
            region |= 4
        elif tag == "main" or held.get("role") == "main":
            region |= 2
        elif contains:
            region |= 1
        inner_header = tag == "header" and inside
        firmly = (tag in DROPPED and tag != "form") or (tag == "header" and not inside) or bool(held) and (
            held.get("role") in DROPPED_ROLES or "hidden" in held or held.get("aria-hidden") == "true"
        )
        loosely = tag == "form" or (named and tag not in _NEVER_NAMED and not inner_header)
        unseen = tag in UNSEEN
        # A region's text is dropped by what is round it only if that is firm, or if other regions are not dropped.
        if firmly or unseen or (loosely and region & 6):
            around = 0
        elif loosely and not dropped:
            around = 1
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, region, max(dropped, 2 if unseen else int(firmly or loosely)), around))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag == "p":
            self._flush()
        self._close(tag, ("article", "main", "body") if tag not in ("article", "main", "body", "html") else ())

    def _close(self, tag: str, within: tuple[str, ...]) -> None:
        """Closes the last open element of that name and all in it, unless a container in between is still open."""
        places = self.places.get(tag)
        if not places:
            return
        place = places[-1]
        for name in within:
            blocking = self.places.get(name)
            if blocking and blocking[-1] > place:
                return
        if tag in BLOCK:
            self._flush()
        for name, *_ in self.open[place:]:
            self.places[name].pop()
        del self.open[place:]

    def handle_data(self, data: str) -> None:
        dropped = self.open[-1][2]
        if dropped < 2:
            (self.other if dropped else self.parts).append(data)

    def close(self) -> None:
        super().close()
        self._flush()


def page_blocks(html: str | None) -> list[tuple[str, int]]:
    """(text, kind) of a page's blocks in order: 2 main text by structure, 1 undecided, 0 dropped."""
    page = _Page()
    page.feed(html or "")
    page.close()
    blocks = [(text, region, dropped) for text, region, dropped, _ in page.blocks]
    left = sum(len(text) for text, _, dropped in blocks if not dropped)
    inner = [around and bool(region & 6) for _, region, _, around in page.blocks]
    if not any(region & 6 for _, region, dropped in blocks if not dropped) and left < sum(len(b[0]) for b, held in zip(blocks, inner) if held):
        # Only names or forms round the page's articles drop them, and they hold more than all else: then they are the page.
        blocks = [(text, region, dropped and not held) for (text, region, dropped), held in zip(blocks, inner)]
    regions = 0
    for _, region, dropped in blocks:
        if not dropped:
            regions |= region
    best = 1 << (regions.bit_length() - 1) if regions else 0
    return [(text, 0 if dropped else 1 if not best else 2 * bool(region & best)) for text, region, dropped in blocks]


def _tokens(pages: list[list[tuple[str, int]]]) -> tuple[np.ndarray, np.ndarray]:
    """32-bit hashes of all blocks' lowered words, page after page, and the number of tokens of each page."""
    words = find_words(texts_of(pa.array(["\n".join(text for text, _ in blocks) for blocks in pages], pa.large_string())), NON_SPACE)
    return (words.hash & np.uint64(0xFFFFFFFF)).astype(np.uint32), words.count


def run_keys(tokens: np.ndarray, owner: np.ndarray, run: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """64-bit key and place of every run of tokens within a page."""

    return grams(SimpleNamespace(hash=mix(tokens.astype(np.uint64)), text=owner), run)


def shared_runs(tokens: np.ndarray, owner: np.ndarray, run: int, least: int) -> np.ndarray:
    """Places of suffixes whose first ``run`` tokens are on at least ``least`` distinct pages.

    The suffix array of the concatenated pages is sorted by doubling up to ``run`` tokens; suffixes with equal heads
    are neighbours, and each such interval's distinct pages are counted.
    """
    n = len(tokens)
    if n < run:
        return np.zeros(0, dtype=np.int64)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    width = 1
    while width < run:
        rank = np.unique(rank[: len(rank) - width] * (rank.max() + 1) + rank[width:], return_inverse=True)[1].astype(np.int64)
        width *= 2
    inside = np.flatnonzero(owner[: n - run + 1] == owner[run - 1 :])
    suffixes = inside[np.lexsort((owner[inside], rank[inside]))]
    if not len(suffixes):
        return suffixes
    heads, pages = rank[suffixes], owner[suffixes]
    new_head = np.concatenate([[True], heads[1:] != heads[:-1]])
    new_page = new_head | np.concatenate([[True], pages[1:] != pages[:-1]])
    interval = np.cumsum(new_head) - 1
    distinct = np.bincount(interval, weights=new_page).astype(np.int64)
    return suffixes[distinct[interval] >= least]


def host_of(url: str):
    """Host of a URL column, lowered, without user and port; empty where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def boilerplate(pages: DataFrame, run: int = RUN, least_pages: int = LEAST_PAGES, percent: int = PERCENT, array_pages: int = ARRAY_PAGES) -> DataFrame:
    """(host, key): runs of ``pages`` (id, host, html) that several pages of their host share."""
    sizes = pages.groupBy("host").agg(F.count("*").alias("pages")).where(F.col("pages") > array_pages)
    large = cut_lineage(sizes.select(F.col("host").alias("large_host"), F.ceil(F.col("pages") / array_pages).alias("arrays")))
    few = large.count() <= BROADCAST_ROWS
    dealt = pages.join(F.broadcast(large) if few else large, F.col("host") == F.col("large_host"), "left")
    dealt = dealt.select("host", F.coalesce(F.pmod(F.xxhash64("id", "html"), F.col("arrays")), F.lit(0)).alias("array"), "html")

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, LOOKUP_PAGES):
                part = batch.slice(low, LOOKUP_PAGES)
                found, counts = _tokens([page_blocks(html) for html in part.column(2).to_pylist()])
                ends = np.cumsum(counts)
                held = [found[e - c : e].tobytes() for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(held, pa.binary())], names=["host", "array", "tokens"])

    def find(held: pa.Table) -> pa.Table:
        pieces = [np.frombuffer(x, dtype=np.uint32) for x in held.column("tokens").to_pylist()]
        stream = np.concatenate(pieces) if pieces else np.zeros(0, dtype=np.uint32)
        owner = np.repeat(np.arange(len(pieces)), [len(x) for x in pieces])
        places = shared_runs(stream, owner, run, max(least_pages, -(-percent * len(pieces) // 100)))
        keys, at = run_keys(stream, owner, run)
        found = np.unique(keys[np.searchsorted(at, places)]).view(np.int64)
        host = held.column("host")[0].as_py()
        return pa.table({"host": pa.array([host] * len(found), pa.string()), "key": pa.array(found)})

    streams = dealt.mapInArrow(tokens, "host string, array bigint, tokens binary")
    return streams.groupBy("host", "array").applyInArrow(find, "host string, key bigint").distinct()


def _unique_text(blocks: list[tuple[str, int]], covered: np.ndarray, run: int) -> list[str]:
    """What is left of undecided blocks without covered runs that fill the block or are ``run`` words long in it.

    Shorter covered stretches at a block's ends belong to runs that begin or end in its neighbours, and stay.
    """
    out, place = [], 0
    for text, kind in blocks:
        words = re.findall(r"[^\x20\t-\r]+", text)
        if kind == 1:
            here = np.concatenate([[0], covered[place : place + len(words)].astype(np.int8), [0]])
            edges = np.flatnonzero(np.diff(here))
            keep = np.ones(len(words), dtype=bool)
            for low, high in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                if high - low >= min(run, len(words)):
                    keep[low:high] = False
            if keep.any():
                out.append(" ".join(w for w, k in zip(words, keep.tolist(), strict=True) if k))
        place += len(words)
    return out


def main_text(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", **options) -> DataFrame:
    """(page_id, url, text, n_chars, n_blocks, n_tokens, n_repeated) of every row.

    A null or empty page has empty text; a null url or one without host belongs to the nameless host. Repeated rows all
    come back, and a repeated page counts as several pages. Pages of any length are read whole. Equal ids and further
    columns do no harm; no rows give no rows. n_repeated counts the tokens, of all blocks, in runs that other pages of the
    host share. Runs jobs while it builds its result.
    """
    run = options.get("run", RUN)
    rows = small_batches(pages).select(F.col(id_column).cast("bigint").alias("id"), F.col(url_column).cast("string").alias("url"), F.col(html_column).alias("html"))
    rows = rows.withColumn("host", host_of("url"))
    runs = cut_lineage(boilerplate(rows.select("id", "host", "html"), **options))
    schema = StructType([
        StructField("page_id", LongType()), StructField("url", StringType()), StructField("text", StringType()),
        *(StructField(name, LongType()) for name in ("n_chars", "n_blocks", "n_tokens", "n_repeated")),
    ])

    def extract(batch: pa.RecordBatch, keys_of) -> pa.RecordBatch:
        """``keys_of``: sorted run keys of the batch's row."""
        blocks = [page_blocks(html) for html in batch.column(2).to_pylist()]
        tokens, counts = _tokens(blocks)
        owner = np.repeat(np.arange(len(blocks)), counts)
        keys, at = run_keys(tokens, owner, run)
        bounds = np.searchsorted(owner[at] if len(at) else at, np.arange(len(blocks) + 1))
        ends = np.cumsum(counts)
        columns: list[list] = [[] for _ in range(5)]
        for i, held in enumerate(blocks):
            mine = slice(bounds[i], bounds[i + 1])
            known = keys_of(i)
            hit = at[mine][np.isin(keys[mine], known)] - (ends[i] - counts[i]) if len(known) else np.zeros(0, dtype=np.int64)
            covered = np.zeros(counts[i], dtype=bool)
            covered[gathered(hit, np.full(len(hit), run))] = True
            if any(kind == 1 for _, kind in held):
                texts = _unique_text(held, covered, run)
            else:
                texts = [text for text, kind in held if kind == 2]
            text = "\n\n".join(texts)
            for column, value in zip(columns, (text, len(text), len(held), int(counts[i]), int(covered.sum())), strict=True):
                column.append(value)
        kinds = (pa.string(), *(pa.int64(),) * 4)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=schema.names
        )

    none = np.zeros(0, dtype=np.uint64)
    if runs.count() <= BROADCAST_ROWS:
        held: dict[str, list[int]] = {}
        for host, key in runs.toLocalIterator():
            held.setdefault(host, []).append(key)
        sent = pages.sparkSession.sparkContext.broadcast({h: np.sort(np.array(k, dtype=np.int64).view(np.uint64)) for h, k in held.items()})

        def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for low in range(0, batch.num_rows, LOOKUP_PAGES):
                    part = batch.slice(low, LOOKUP_PAGES)
                    hosts = part.column(3).to_pylist()
                    yield extract(part, lambda i, hosts=hosts: sent.value.get(hosts[i], none))

        return rows.mapInArrow(looked_up, schema)

    def carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, LOOKUP_PAGES):
                part = batch.slice(low, LOOKUP_PAGES)
                keys = [np.sort(np.array(k or [], dtype=np.int64).view(np.uint64)) for k in part.column(4).to_pylist()]
                yield extract(part, lambda i, keys=keys: keys[i])

    by_host = runs.groupBy("host").agg(F.collect_list("key").alias("keys"))
    return rows.join(by_host, "host", "left").select("id", "url", "html", "host", "keys").mapInArrow(carried, schema)
