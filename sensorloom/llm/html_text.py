"""Main text of web pages: what markup settles, and a suffix array per host for the rest.

A page becomes blocks of text. Markup settles some of them: menus, headers, footers,
sidebars, notices, adverts, forms and comments are boilerplate by their element, role or
class; where a page marks its article (``article``, else ``main``), that is the text and
what lies outside isn't. Blocks that markup leaves open are decided by repetition: the
token streams of a host's pages are sorted as suffixes, to the depth of ``run`` tokens, and
substrings of that length or more on distinct pages are boilerplate, unless as many pages
have them in their marked articles. Covered tokens go, unique runs stay. A repeat that reaches from one block into
another by fewer tokens than ``run`` and not to its end leaves them there.

Marked articles are heard, not cut: their passages are found on more pages of their host
than its adverts are (README). They are sorted only where a repeat in open text is to be judged.

Suffixes are sorted by doubling in each task, which hands on one row per page and distinct
prefix; prefixes are counted over all tasks by a partial aggregate and go back to their
pages by a join. Nothing of a host or page group is collected. Pages whose texts are equal
are one page. A run must lie on two pages, and on ``share`` of the host's.

A null or empty page has no text. Pages without a host are compared with none. Repeated
rows give a row each; other columns are ignored. Markup may be broken: elements left open
end with their parent, raw text left open with the page.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import few_or_shuffled, written
from sensorloom.llm.words import chunks, find_words, mix, seeded

RUN = 8  # tokens of the shortest substring that counts as long
SHARE = 0.001  # of a host's pages that a boilerplate run is on, two at least

OPEN, TEXT, SETTLED = 0, 1, 2

# HTML's elements by what they do.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
BREAKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section select summary table tbody tfoot thead tr ul".split()
)
CELLS = frozenset(("td", "th", "br"))
ASIDE = frozenset("nav footer aside form noscript template button select svg menu dialog canvas object audio video search".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog menu menubar toolbar".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo banner cookie cookies consent gdpr "
    "notice popup modal overlay newsletter subscribe signup login sidebar menu nav navbar navigation breadcrumb breadcrumbs "
    "pagination pager footer masthead topbar toolbar comment comments respond disqus replies share sharing social related "
    "recommended widget".split()
)

_TAG = re.compile(r"<(?:!--.*?(?:--!?>|\Z)|[!?][^>]*>|(/?)([a-zA-Z][^\s/>]*)([^>]*)>)", re.S)
_OPEN_QUOTE = re.compile(r"""=\s*(?:("[^"]*)|('[^']*))\Z""")
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME = re.compile("[a-z0-9]+")
_HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#\s]+)", re.I)


def host_of(url: str | None) -> str | None:
    found = _HOST.match(url or "")
    return found[1].lower() if found else None


def _by_attributes(tag: str, attributes: str) -> tuple[bool, bool]:
    """Whether an element's attributes make it boilerplate, and whether they make it the main text."""
    aside = main = False
    for name, double, single, bare in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (double or single or bare).lower()
        if name in ("class", "id"):
            aside |= not NAMES.isdisjoint(_NAME.findall(value)) and tag not in ("html", "body", "main")
        elif name == "role":
            aside |= value in ROLES
            main |= value == "main"
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            aside = True
        elif name == "style":
            aside |= "display:none" in value.replace(" ", "")
        elif name == "itemprop":
            main |= value == "articlebody"
    return aside, main


class _Page:
    """Blocks of a page as its tags are read."""

    def __init__(self):
        self.blocks: list[tuple[str, int, bool]] = []  # text, article or main or neither, boilerplate
        self.parts: list[str] = []
        self.stack: list[tuple[str, int, bool]] = []  # element, what it makes of its text, boilerplate
        self.now = (0, False)

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.blocks.append((text, *self.now))
            self.parts = []

    def enter(self, tag: str, kind: int, aside: bool) -> None:
        held, off = self.now
        if (max(held, kind), off or aside) != self.now:
            self.flush()
        self.stack.append((tag, *self.now))
        self.now = (max(held, kind), off or aside)

    def leave(self, at: int) -> None:
        """Close the element at a place of the stack and all inside it."""
        now = self.stack[at][1:]
        if now != self.now:
            self.flush()
        del self.stack[at:]
        self.now = now

    def start(self, tag: str, attributes: str) -> None:
        if tag in BREAKS:
            self.flush()
            if self.stack and self.stack[-1][0] == "p":
                self.leave(len(self.stack) - 1)
            if tag == "li" or tag == "tr" or tag == "option":
                if self.stack and self.stack[-1][0] == tag:
                    self.leave(len(self.stack) - 1)
        elif tag in CELLS:
            self.parts.append(" ")
        if tag in VOID:
            return
        aside, main = _by_attributes(tag, attributes) if attributes and not attributes.isspace() else (False, False)
        if tag == "article" or tag == "main":
            # A menu or page header that was left open ends here.
            for at, (name, *_) in enumerate(self.stack):
                if name in ("nav", "header"):
                    self.leave(at)
                    break
        kind = 2 if tag == "article" else 1 if main or tag == "main" else 0
        aside |= tag in ASIDE or (tag == "header" and not self.now[0])
        if tag in BREAKS or tag in ("td", "th") or aside or kind or any(name == tag for name, *_ in self.stack):
            self.enter(tag, kind, aside)

    def end(self, tag: str) -> None:
        if tag in BREAKS:
            self.flush()
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at][0] == tag:
                return self.leave(at)


def blocks_of(page: str | None) -> list[tuple[str, int]]:
    """(text, OPEN, TEXT or SETTLED) of a page's blocks in order."""
    if not page:
        return []
    found, at, search = _Page(), 0, _TAG.search
    last = page.rfind(">") + 1
    while tag := search(page, at, last):
        if tag.start() > at:
            text = page[at : tag.start()]
            found.parts.append(html.unescape(text) if "&" in text else text)
        at, closing, name, attributes = tag.end(), tag[1], tag[2], tag[3]
        if not name:
            continue
        name = name.lower()
        # A '>' inside a quoted value doesn't end the tag.
        while attributes and (quote := _OPEN_QUOTE.search(attributes)):
            ends = page.find('"' if quote[1] else "'", at)
            ends = page.find(">", ends) if ends >= 0 else -1
            if ends < 0:
                break
            attributes, at = page[tag.start(3) : ends], ends + 1
        if closing:
            found.end(name)
        elif name in RAW and not attributes.endswith("/"):
            close = re.compile(f"</{name}(?=[\\s/>])", re.I).search(page, at)
            if not close:
                at = len(page)
                break
            at = page.find(">", close.end()) + 1 or len(page)
            found.parts.append(" ")
        else:
            found.start(name, attributes)
    # Behind the last '>' there are no tags, but there may be the beginning of one.
    rest = re.split(r"<[a-zA-Z/!?]", page[at:], maxsplit=1)[0]
    found.parts.append(html.unescape(rest))
    found.flush()
    marked = max((kind for _, kind, aside in found.blocks if not aside), default=0)

    def status(kind: int, aside: bool) -> int:
        if aside:
            return SETTLED
        return OPEN if not marked else TEXT if kind == marked else SETTLED

    return [(text, status(kind, aside)) for text, kind, aside in found.blocks]


def pages_in(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[list[tuple[str, int]]]]]:
    """Slices of the batches with about 1 MB of pages, and each page's blocks."""
    for batch, data, offsets in chunks(batches, "html"):
        pages = (data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:]))
        yield batch, [blocks_of(page) for page in pages]


def _joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    parts = [t.encode() for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)
    return np.frombuffer(b"".join(parts), np.uint8), offsets


def _text_hashes(texts: list[str]) -> np.ndarray:
    """A hash per text: of its words in order."""
    data, offsets = _joined(texts)
    words = find_words(data, offsets)
    h, place = words.hashes(fold=False), np.arange(len(words.starts)) - np.repeat(words.first[:-1], words.counts)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(h + place.astype(np.uint64) * _PLACE), dtype=np.uint64)))
    return mix(sums[words.first[1:]] - sums[words.first[:-1]] + words.counts.astype(np.uint64))


_PLACE = seeded(1, 12)[0] | np.uint64(1)


class Streams:
    """Token streams of a chunk of pages, concatenated, and what their suffixes begin with."""

    def __init__(self, streams: list[str], hosts: np.ndarray, run: int):
        self.words, self.run = find_words(*_joined(streams)), run
        self.page = self.words.doc
        own = mix(self.words.hashes(fold=False) ^ hosts[self.page])  # a token of its host
        self.tokens = own
        # Suffixes of fewer than `run` tokens begin no long substring.
        self.full = np.flatnonzero(np.arange(len(own)) + run <= np.repeat(self.words.first[1:], self.words.counts))
        key = np.zeros(len(own), np.uint64)
        for k in range(min(run, len(own))):
            key[: len(own) - k] = key[: len(own) - k] * _PLACE + own[k:]
        self.keys = mix(key[self.full])

    def ranks(self) -> np.ndarray:
        """Rank of each suffix among all, to a depth of ``run`` tokens, by doubling."""
        rank = np.unique(self.tokens, return_inverse=True)[1].astype(np.int64) + 1
        depth = 1
        while depth < self.run and len(rank):
            step = min(depth, self.run - depth)
            after, same = np.zeros_like(rank), self.page[:-step] == self.page[step:]
            after[:-step] = np.where(same, rank[step:], 0)
            rank = np.unique(rank * (int(rank.max()) + 1) + after, return_inverse=True)[1].astype(np.int64) + 1
            depth += step
        return rank

    def begun(self) -> tuple[np.ndarray, np.ndarray]:
        """(page, key) of the prefixes that pages have, each once: neighbours in the suffix array are compared."""
        page, rank = self.page[self.full], self.ranks()[self.full]
        array = np.lexsort((page, rank))
        page, rank = page[array], rank[array]
        new = np.ones(len(array), bool)
        new[1:] = (rank[1:] != rank[:-1]) | (page[1:] != page[:-1])
        return page[new], self.keys[array[new]]

    def covered(self, keys: list[np.ndarray]) -> np.ndarray:
        """Tokens that lie in a substring that begins with one of their page's keys."""
        starts = np.zeros(len(self.tokens) + 1, np.int64)
        page = self.page[self.full]
        edges = np.searchsorted(page, np.arange(len(keys) + 1))
        for own, a, b in zip(keys, edges[:-1], edges[1:]):
            if len(own):
                at = self.full[a:b][np.isin(self.keys[a:b], own)]
                starts[at] += 1
                starts[at + self.run] -= 1
        return np.cumsum(starts[:-1]) > 0


WINDOWS = "key long, host long, page long, open boolean"


def page_windows(run: int, articles: bool = False):
    """What the suffixes of pages' streams begin with, of marked articles or of all else: a row per page and distinct prefix of ``run`` tokens."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, pages in pages_in(batches):
            hosts = [host_of(url) for url in batch.column("url").to_pylist()]
            some = [i for i, host in enumerate(hosts) if host and any((status == TEXT) == articles for _, status in pages[i])]
            names = _text_hashes([hosts[i] for i in some])
            page = _page_hashes([pages[i] for i in some], names)
            found = Streams([_stream(pages[i], articles) for i in some], names, run)
            row, keys = found.begun()
            opens = np.array([any(status == OPEN for _, status in pages[i]) for i in some], bool)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(names.view(np.int64)[row]), pa.array(page[row]), pa.array(opens[row])],
                ["key", "host", "page", "open"],
            )

    return find


def _stream(blocks: list[tuple[str, int]], articles: bool) -> str:
    return " ".join(text for text, status in blocks if (status == TEXT) == articles)


def _page_hashes(pages: list[list[tuple[str, int]]], hosts: np.ndarray) -> np.ndarray:
    """A hash of each page's host and whole text."""
    return mix(_text_hashes([" ".join(text for text, _ in blocks) for blocks in pages]) ^ hosts).view(np.int64)


def _rows(batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
        ["page_id", "url", "text", "n_chars"],
    )


def _is_open(blocks: list[tuple[str, int]], url: str | None) -> bool:
    return host_of(url) is not None and any(status == OPEN for _, status in blocks)


def settled_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of the pages of which markup leaves nothing open, or that have no host to compare with."""
    for batch, pages in pages_in(batches):
        some = [i for i, url in enumerate(batch.column("url").to_pylist()) if not _is_open(pages[i], url)]
        yield _rows(batch.take(pa.array(some, pa.int64())), ["\n\n".join(t for t, s in pages[i] if s != SETTLED) for i in some])


OPEN_PAGES = "page_id long, url string, page long, blocks array<string>, settled array<boolean>"


def open_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The other pages: their blocks, and which of them are boilerplate anyway."""
    for batch, pages in pages_in(batches):
        urls = batch.column("url").to_pylist()
        some = [i for i, url in enumerate(urls) if _is_open(pages[i], url)]
        page = _page_hashes([pages[i] for i in some], _text_hashes([host_of(urls[i]) for i in some]))
        slim = batch.take(pa.array(some, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [
                slim.column("page_id"), slim.column("url"), pa.array(page),
                pa.array([[t for t, _ in pages[i]] for i in some], pa.list_(pa.string())),
                pa.array([[s == SETTLED for _, s in pages[i]] for i in some], pa.list_(pa.bool_())),
            ],
            ["page_id", "url", "page", "blocks", "settled"],
        )


def _long_only(gone: np.ndarray, run: int) -> np.ndarray:
    """A block's covered tokens without stretches shorter than ``run``, unless all is covered."""
    if gone.all() or not gone.any():
        return gone
    edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
    out = np.zeros(len(gone), bool)
    for a, b in zip(edges[::2], edges[1::2]):
        out[a:b] = b - a >= run
    return out


def unique_runs(run: int):
    """Texts of open pages without the tokens that boilerplate covers."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls, pages = batch.column("url").to_pylist(), batch.column("blocks").to_pylist()
            settled, keys = batch.column("settled").to_pylist(), batch.column("keys").to_pylist()
            hosts = _text_hashes([host_of(url) for url in urls])
            streams = Streams([" ".join(blocks) for blocks in pages], hosts, run)
            gone = streams.covered([np.array(own or [], np.int64).view(np.uint64) for own in keys])
            texts = []
            for i, blocks in enumerate(pages):
                kept, at = [], int(streams.words.first[i])
                for block, off in zip(blocks, settled[i]):
                    tokens = block.split(" ")
                    own = _long_only(gone[at : at + len(tokens)], run)
                    at += len(tokens)
                    if not off and not own.all():
                        kept.append(" ".join(t for t, g in zip(tokens, own) if not g) if own.any() else block)
                texts.append("\n\n".join(kept))
            yield _rows(batch, texts)

    return cut


def boilerplate(windows: DataFrame, share: float = SHARE) -> DataFrame:
    """(key, host) of prefixes on two distinct pages or more, and on ``share`` of their host's pages."""
    pages = written(windows.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("pages")), "html-hosts")
    counted = windows.groupBy("key", "host").agg(
        F.min("page").alias("low"), F.max("page").alias("high"), F.count("*").alias("places")
    )
    repeated = counted.where("low <> high").join(pages.where(F.col("pages") * F.lit(share) > 2), "host", "left")
    return repeated.where(F.col("places") >= F.coalesce(F.col("pages") * F.lit(share), F.lit(2))).select("key", "host")


def held_by_articles(repeated: DataFrame, windows: DataFrame, pages: DataFrame, run: int) -> DataFrame:
    """Those of the repeated prefixes (key, host) that as many distinct pages have in their marked article as elsewhere."""
    within = pages.select("url", "html").mapInArrow(page_windows(run, articles=True), WINDOWS)
    held = windows.withColumn("at", F.lit(0)).union(within.withColumn("at", F.lit(1)))
    held = held.join(few_or_shuffled(repeated), ["key", "host"], "left_semi").select("key", "host", "page", "at").distinct()
    return held.groupBy("key", "host").agg(F.sum("at").alias("in"), F.count("*").alias("all")).where("in * 2 >= all").select("key", "host")


def main_text(pages: DataFrame, run: int = RUN, share: float = SHARE) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of pages (page_id, url, html)."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    shape = "page_id long, url string, text string, n_chars long"
    windows = written(pages.select("url", "html").mapInArrow(page_windows(run), WINDOWS), "html-windows")
    opens = windows.where("open")
    repeated = opens.select("key", "host").join(boilerplate(windows, share), ["key", "host"], "left_semi").distinct()
    repeated = written(repeated, "html-repeated")
    text = held_by_articles(repeated, windows, pages, run)
    keys = opens.join(repeated.join(text, ["key", "host"], "left_anti"), ["key", "host"], "left_semi")
    marks = keys.groupBy("page").agg(F.collect_set("key").alias("keys"))
    undecided = pages.mapInArrow(open_pages, OPEN_PAGES).join(marks, "page", "left")
    undecided = undecided.select("page_id", "url", "blocks", "settled", "keys").mapInArrow(unique_runs(run), shape)
    return pages.mapInArrow(settled_pages, shape).unionByName(undecided)
