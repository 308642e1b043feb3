"""Main text of web pages: markup zones, then a suffix array over each host.

Markup decides first: the articles (or the body of a page without one) without the
zones of menus, notices, adverts, forms and comments. What is left may still hold
boilerplate that no tag betrays. It is the same on many pages of a host, so the token
streams of a host's pages are concatenated, their suffixes sorted by prefix doubling,
and tokens covered by long substrings that most pages share are removed.

A host may be of any size. Its distinct streams are dealt into shards of bounded bytes,
each with its own suffix array. A substring on a given share of all streams is on that
share of one shard's streams at least, so each shard names its candidates, and all shards
count them: what counts is the whole host. Texts are not shuffled, only token hashes, once
per distinct stream and task.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billshift.llm.arrays import mix, text_slices, word_hashes
from billshift.sources.writers import materialise

#: Tokens that a shared substring has at least.
DEPTH = 8
#: A substring is boilerplate on this share of a host's distinct streams, and no fewer
#: than so many: two pages alike are copies, not a frame.
LEAST_SHARE = 0.5
LEAST_PAGES = 3
#: A page that is covered to more than this share is a copy of others and stays whole.
MOST_COVERED = 0.9
#: Bytes of html whose streams are sorted together.
SHARD_BYTES = 8 << 20
#: Rows of hosts, and of their boilerplate substrings, that are broadcast at most.
BROADCAST_ROWS = 100_000

# Element names of the HTML standard by their part in a page.
RAW = frozenset("script style noscript template iframe textarea title select".split())
DROPPED = frozenset("nav footer aside form head menu dialog button".split())
CONTAINERS = DROPPED | frozenset(
    "html body div section article main header ul ol dl table figure blockquote details fieldset".split()
)
BLOCKS = CONTAINERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 li dt dd tr td th caption figcaption pre hr address summary legend".split()
)
#: Words of class, id or role that mark a zone which is not article text.
_ZONES = (
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent "
    "notice alert popup modal overlay sidebar menu nav navbar navigation breadcrumb breadcrumbs comment comments "
    "reply replies disqus discussion footer"
)
#: Words that mark one outside an article; within it they may name a part of it.
_FRAME = (
    "share sharing social related recommended newsletter subscribe signup login search toolbar widget pagination pager "
    "masthead topbar complementary contentinfo skip"
)
ZONES = frozenset(_ZONES.split())
FRAME = ZONES | frozenset(_FRAME.split())
_COMMENTS = frozenset("comment comments reply replies disqus discussion".split())

_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r"""[>"']""")
_CUT = re.compile(r"<[/!?a-zA-Z][^<>]*\Z")
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""\shidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_RAW_END = {name: re.compile(rf"</{name}\b", re.I) for name in RAW}


def _zone_words(attributes: str) -> set[str]:
    words = set()
    for _, value in _ATTRIBUTE.findall(attributes):
        words.update(re.split(r"[^a-z]+", value.lower()))
    return words


class _Tags:
    """Pieces of a page in order: texts and tags, each character looked at a bounded number of times."""

    def __init__(self, html: str):
        self.html, self.at = html, 0
        self.last_close = html.rfind(">")
        self.quotes = True

    def tag_end(self, start: int) -> int:
        """Where the tag at ``start`` ends. Brackets in quotes don't end it, unless none is left outside quotes."""
        at = start
        while self.quotes:
            stop = _STOP.search(self.html, at)
            if stop is None:
                self.quotes = False
            elif stop[0] == ">":
                return stop.end()
            else:
                closed = self.html.find(stop[0], stop.end())
                at = closed + 1 if closed >= 0 else stop.end()
        return self.html.find(">", start) + 1

    def skip_raw(self, name: str) -> None:
        """Past the end tag of a raw element; without one, past all."""
        end = _RAW_END[name].search(self.html, self.at)
        close = self.html.find(">", end.end()) if end else -1
        self.at = close + 1 if close >= 0 else len(self.html)

    def __iter__(self) -> Iterator[tuple[str, str, str]]:
        """``text``, closing mark, name and attributes; for a text the name is empty."""
        html, size = self.html, len(self.html)
        while self.at < size:
            start = self.at
            if html[start] != "<":
                end = html.find("<", start)
                self.at = end if end >= 0 else size
                yield html[start : self.at], "", ""
            elif start > self.last_close:
                # No tag ends any more: what looks like one at the very end was cut off.
                cut = _CUT.search(html, start)
                self.at = size
                yield html[start : cut.start() if cut else size], "", ""
            elif html.startswith("<!--", start):
                end = html.find("-->", start + 4)
                self.at = end + 3 if end >= 0 else size
            elif html[start + 1 : start + 2] in ("!", "?"):
                self.at = html.find(">", start) + 1
            elif name := _NAME.match(html, start):
                self.at = self.tag_end(name.end())
                yield name[1], name[2].lower(), html[name.end() : self.at - 1]
            else:
                self.at = start + 1
                yield "<", "", ""


def text_blocks(html: str) -> list[str]:
    """Blocks of text outside the dropped zones: of all articles, or else of all the page.

    Articles in a dropped zone count only where no other has text: a zone that was never
    closed does not swallow the article behind it.
    """
    #: Open containers: name, whether text below is dropped, whether by comments, kind of article.
    stack: list[tuple[str, bool, bool, int]] = []
    open_names: Counter[str] = Counter()
    #: Texts by kind: outside articles, in main parts, in articles, in articles of dropped zones.
    found: list[list[str]] = [[], [], [], []]
    current, kind, dropped = [], 0, False

    def close_block():
        text = " ".join("".join(current).split())
        current.clear()
        if text:
            found[kind].append(text)

    tags = _Tags(html)
    for mark, name, attributes in tags:
        if not name:
            if not dropped:
                current.append(unescape(mark))
            continue
        if name in RAW and not mark:
            if not attributes.endswith("/"):
                tags.skip_raw(name)
            continue
        if name in BLOCKS:
            close_block()
        elif name == "br":
            current.append(" ")
        if name not in CONTAINERS:
            continue
        if mark:
            while open_names[name]:
                closed = stack.pop()[0]
                open_names[closed] -= 1
                if closed == name:
                    break
        elif not attributes.endswith("/"):
            words = _zone_words(attributes) if attributes else set()
            commented = bool(words & _COMMENTS) or bool(stack and stack[-1][2])
            zone = bool(words & (ZONES if kind else FRAME))
            off = dropped or name in DROPPED or zone or bool(attributes and _HIDDEN.search(attributes))
            inside = kind
            if name == "header":
                off = off or not kind
            if name in ("article", "main") and not commented and not zone and kind < 2:
                # A main part may lie around its article, or around several.
                if name == "article" or not kind:
                    inside = 1 if name == "main" else 3 if dropped else 2
                    off = False
            stack.append((name, off, commented, inside))
            open_names[name] += 1
        kind = stack[-1][3] if stack else 0
        dropped = stack[-1][1] if stack else False
    close_block()
    return next((found[k] for k in (2, 3, 1) if found[k]), found[0])


def host(url: Column) -> Column:
    """Host in lower case; pages without one go by their whole url."""
    name = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1))
    return F.when(name == "", F.coalesce(url, F.lit(""))).otherwise(F.coalesce(name, F.lit("")))


def suffix_classes(tokens: np.ndarray, depth: int) -> np.ndarray:
    """Class of every suffix by its first ``depth`` (a power of two) tokens, by prefix doubling.

    Ordering the classes gives the suffix array to that depth: suffixes of a class are
    neighbours in it and share ``depth`` tokens.
    """
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    step = 1
    while step < depth:
        after = np.full(len(rank), -1, np.int64)
        after[:-step] = rank[step:]
        rank = np.unique(rank * (len(rank) + 1) + after + 1, return_inverse=True)[1].astype(np.int64)
        step *= 2
    return rank


def windows(tokens: np.ndarray) -> np.ndarray:
    """64-bit hash of every ``DEPTH`` tokens in a row."""
    if len(tokens) < DEPTH:
        return np.zeros(0, np.uint64)
    rows = np.lib.stride_tricks.sliding_window_view(mix(tokens.astype(np.uint64) + np.uint64(1)), DEPTH)
    total = np.zeros(len(rows), np.uint64)
    for i in range(DEPTH):
        total = mix(total * np.uint64(0x100000001B3) + rows[:, i])
    return total


def shared_windows(streams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``DEPTH``-token substrings of distinct streams, and how many streams each is on."""
    # A token of its own after each stream keeps substrings within streams.
    marks = (np.uint64(1) << np.uint64(32)) + np.arange(len(streams), dtype=np.uint64)
    stream = np.concatenate([x for s, m in zip(streams, marks) for x in (s.astype(np.uint64), [m])]).astype(np.uint64)
    owner = np.repeat(np.arange(len(streams)), [len(s) + 1 for s in streams])
    within = np.concatenate([np.arange(len(s), -1, -1) for s in streams]) >= DEPTH
    classes = suffix_classes(stream, DEPTH)[within]
    pairs = np.unique(classes * len(streams) + owner[within])
    number, first = np.unique(classes, return_index=True)
    spread = np.bincount(pairs // len(streams), minlength=int(number[-1]) + 1 if len(number) else 0)[number]
    starts = np.flatnonzero(within)[first]
    hashes = windows_at(stream, starts)
    return hashes, spread


def windows_at(stream: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """``windows`` at some places only."""
    total = np.zeros(len(starts), np.uint64)
    for i in range(DEPTH):
        total = mix(total * np.uint64(0x100000001B3) + mix(stream[starts + i] + np.uint64(1)))
    return total


def covered(tokens: np.ndarray, boilerplate: np.ndarray) -> np.ndarray:
    """Tokens of one stream within a substring whose hash is in ``boilerplate`` (sorted)."""
    hashes = windows(tokens)
    mask = np.zeros(len(tokens) + 1, np.int64)
    if len(boilerplate) and len(hashes):
        at = np.minimum(np.searchsorted(boilerplate, hashes), len(boilerplate) - 1)
        hit = np.flatnonzero(boilerplate[at] == hashes)
        np.add.at(mask, hit, 1)
        np.add.at(mask, hit + DEPTH, -1)
    return np.cumsum(mask)[:-1] > 0


def _tokens(blocks: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """32-bit token hashes of pages in order, and the number in each block."""
    hashes, per_block = word_hashes(pa.array([b for page in blocks for b in page], pa.string()), lower=False)
    return (hashes >> np.uint64(32)).astype(np.uint32), per_block


def _page_tokens(blocks: list[list[str]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    tokens, per_block = _tokens(blocks)
    at = k = 0
    for page in blocks:
        sizes = per_block[k : k + len(page)]
        yield tokens[at : at + int(sizes.sum())], sizes
        at, k = at + int(sizes.sum()), k + len(page)


_STREAM = "host string, shard long, shards long, stream long, tokens binary"
_SHARD = "host string, shard long, shards long, n_pages long, windows array<long>, spread array<long>, streams array<binary>"
_TEXTS = "page_id long, url string, text string, n_chars long"


def _stream_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The token stream of every page; of equal ones on a host, one a task."""
    seen: set[tuple[str, int]] = set()
    for batch in batches:
        for part in text_slices(batch, "html"):
            blocks = [text_blocks(h) for h in part.column("html").to_pylist()]
            names, shards = part.column("host").to_pylist(), part.column("shards").to_pylist()
            rows = []
            for name, of, (tokens, _) in zip(names, shards, _page_tokens(blocks)):
                places = mix(np.arange(1, len(tokens) + 1, dtype=np.uint64))
                stream = int(mix((tokens + np.uint64(1)) * places).sum(dtype=np.uint64)) & ((1 << 63) - 1)
                if (name, stream) not in seen:
                    seen.add((name, stream))
                    rows.append((name, stream % of, of, stream, tokens.tobytes()))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["host", "shard", "shards", "stream", "tokens"]
            )


def _shard_row(key: tuple[str, int, int], streams: list[bytes]) -> pa.RecordBatch:
    """What one shard has to say: its distinct streams, and substrings on enough of them."""
    host, shard, shards = key
    arrays = [np.frombuffer(s, np.uint32) for s in streams]
    hashes, spread = shared_windows(arrays)
    least = LEAST_SHARE * len(streams) if shards > 1 else max(LEAST_PAGES, LEAST_SHARE * len(streams))
    kept = spread >= least
    row = {
        "host": [host], "shard": [shard], "shards": [shards], "n_pages": [len(streams)],
        "windows": [hashes[kept].view(np.int64)], "spread": [spread[kept].astype(np.int64)],
        "streams": [streams if shards > 1 else []],
    }
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.binary())]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row.values(), kinds)], names=list(row))


def _shard_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by host, shard and stream go by; only a shard's distinct streams are held."""
    key, last, streams = None, None, []
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            for row in batch.slice(start, 256).to_pylist():
                here = (row["host"], row["shard"], row["shards"])
                if here != key:
                    if key is not None:
                        yield _shard_row(key, streams)
                    key, last, streams = here, None, []
                if row["stream"] != last:
                    last = row["stream"]
                    streams.append(row["tokens"])
    if key is not None:
        yield _shard_row(key, streams)


def _count_candidates(streams: pa.Table, candidates: pa.Table) -> pa.Table:
    """On how many of a shard's streams each candidate of its host is."""
    wanted = np.unique(candidates.column("window").to_numpy()).view(np.uint64)
    wanted.sort()
    counts = np.zeros(len(wanted), np.int64)
    for row in streams.column("streams").to_pylist() if len(wanted) else []:
        for stream in row:
            hashes = np.unique(windows(np.frombuffer(stream, np.uint32)))
            at = np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)
            counts[at[wanted[at] == hashes]] += 1
    hosts = candidates.column("host").to_pylist()[:1] * len(wanted)
    return pa.table({"host": pa.array(hosts, pa.string()), "window": wanted.view(np.int64), "n": counts})


def boilerplate(pages: DataFrame, shard: int = SHARD_BYTES) -> DataFrame:
    """``host, window``: hashes of the substrings that are boilerplate on a host.

    ``pages``: ``host, html``; ``shard``: bytes of html whose streams are sorted together.
    """
    sizes = pages.groupBy("host").agg(F.sum(F.octet_length("html")).alias("bytes"))
    sizes = materialise(sizes.select("host", F.expr(f"coalesce(bytes, 0) div {shard} + 1").alias("shards")), "html-hosts")
    dealt = pages.join(_small(sizes.where("shards > 1")), "host", "left").select(
        "host", "html", F.coalesce("shards", F.lit(1).cast("long")).alias("shards")
    )
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    streams = dealt.mapInArrow(_stream_rows, _STREAM).repartition(parts, "host", "shard")
    rows = streams.sortWithinPartitions("host", "shard", "stream").mapInArrow(_shard_rows, _SHARD)
    rows = materialise(rows, "html-shards")
    single = rows.where("shards = 1").select("host", F.explode("windows").alias("window"))

    # Hosts of several shards: every shard counts the candidates of all.
    several = rows.where("shards > 1")
    named = several.select("host", "shards", F.explode("windows").alias("window")).distinct()
    asked = named.select("host", "window", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"))
    counted = (
        several.select("host", "shard", "streams")
        .groupBy("host", "shard")
        .cogroup(asked.groupBy("host", "shard"))
        .applyInArrow(_count_candidates, "host string, window long, n long")
    )
    least = F.greatest(F.lit(float(LEAST_PAGES)), F.sum("n_pages") * LEAST_SHARE)
    least = several.groupBy("host").agg(least.alias("least"))
    found = counted.groupBy("host", "window").agg(F.sum("n").alias("n")).join(least, "host").where("n >= least")
    return materialise(single.unionByName(found.select("host", "window")), "html-boilerplate")


def _small(table: DataFrame) -> DataFrame:
    """Broadcast while there are few rows (counted first); beyond that both sides are shuffled."""
    few = table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return F.broadcast(table) if few else table.hint("merge")


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch, "html"):
            blocks = [text_blocks(h) for h in part.column("html").to_pylist()]
            texts = []
            lists = part.column("windows").to_pylist()
            for page, known, (tokens, sizes) in zip(blocks, lists, _page_tokens(blocks)):
                if known:
                    gone = covered(tokens, np.sort(np.array(known, np.int64).view(np.uint64)))
                    if gone.any() and gone.mean() <= MOST_COVERED:
                        page = _unique_runs(page, gone, sizes)
                texts.append("\n\n".join(page))
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )


def _unique_runs(blocks: list[str], gone: np.ndarray, sizes: np.ndarray) -> list[str]:
    kept, at = [], 0
    for text, size in zip(blocks, sizes):
        off = gone[at : at + size]
        at += size
        if off.any():
            words = re.findall(r"[^\x20\x09-\x0D]+", text)
            text = " ".join(w for w, o in zip(words, off) if not o)
        if text:
            kept.append(text)
    return kept


def main_text(pages: DataFrame, shard: int = SHARD_BYTES) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages`` (``page_id, url, html``).

    A null html counts as empty, a page without a host in its url goes by the whole url, and
    a null url is an own host; other columns don't matter. Blocks are joined by two line
    ends. Repeated rows each give a row; equal texts of a host count once in what is
    boilerplate. An empty table gives an empty one.
    """
    source = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", host(F.col("url")).alias("host"), "html"
    )
    found = boilerplate(source.select("host", "html"), shard)
    lists = found.groupBy("host").agg(F.collect_list("window").alias("windows"))
    marked = source.join(_small_lists(found, lists), "host", "left")
    return marked.select("page_id", "url", "html", "windows").mapInArrow(_clean, _TEXTS)


def _small_lists(rows: DataFrame, lists: DataFrame) -> DataFrame:
    """A host's list is at most as long as its average page is by ``1 / LEAST_SHARE``."""
    few = rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return F.broadcast(lists) if few else lists.hint("merge")
