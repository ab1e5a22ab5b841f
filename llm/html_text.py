"""Main text of web pages: structure, and a suffix array per host.

Each page is read once.  Elements that hold menus, headers, footers, sidebars,
adverts, notices, forms, scripts, styles or comments go with all they hold.
Where only a class or id tells so, an element that is or holds the article
stays, and so does everything when the page has no other text.  The same holds
for forms.  Articles beside a text of TEASERS times their length are teasers.
What is left is a list of blocks; those in an article (or main) element are
certain, others are not.

The token streams of a host's pages are then concatenated and their suffixes
sorted as far as ``least_tokens``: suffixes that agree so far and begin on
``least_pages`` distinct pages or more are boilerplate.  Tokens they cover go
from the blocks that are not certain, and the unique runs stay.  A certain
block stays as it is even where another page repeats it, as articles may be
published twice.

That is for hosts of at most ``unit_pages`` pages and ``unit_tokens`` tokens, so
memory is bounded and no host is one task.  On larger hosts the windows of
``least_tokens`` tokens are counted over all pages of the host by a digest of
64 bits, and the frequent ones are joined back to their pages: the same
tokens go, but for collisions of digests.  A host of which all pages mark an
article has nothing to count.

Null html, or a page without text, gives an empty string.  Pages without url
are one host.  Rows are handled one by one, whatever their ``page_id``; the
order inside a host is by ``page_id`` and url.  An empty table gives no rows.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from llm.common import SLICE, materialise, need

LEAST_TOKENS, LEAST_PAGES = 16, 3
UNIT_PAGES, UNIT_TOKENS = 512, 1_000_000
CACHE_WORDS = 200_000
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

# names of elements and words of attributes, fixed values of HTML and its common use
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary "
    "table tbody td tfoot th thead tr ul".split())
DROPPED = frozenset(
    "applet aside audio button canvas dialog embed footer frameset head iframe input map menu nav noscript object "
    "script search select style svg template textarea title video".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROPPED_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
DROPPED_WORDS = frozenset(
    "ad ads adsense advert advertisement advertising adverts announcement banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies disqus footer gdpr hidden masthead menu modal nav navbar navigation newsletter notice notices "
    "notification outbrain pager pagination popup promo promoted promotion recommended related replies respond share "
    "sharing sidebar signup skip social sponsor sponsored subscribe subscription taboola toolbar widget".split())
#: Opening one of the second ends an open one of the first.
IMPLIED_END = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"},
               "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}

_TAG = re.compile(r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*(?:"[^"]*(?:"|\Z)|'[^']*(?:'|\Z)|(?=[^"'])|\Z))*)(?:>|\Z))""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*))?""")
_WORD = re.compile(r"[a-z]+")
#: Class names that begin or end so tell of another element or a state: has-sidebar, no-ads, comments-open.
TELLS, STATES = frozenset("has no not with without".split()), frozenset("closed disabled enabled open".split())
#: Of the dropped words, those of elements whose articles are others' texts: readers' comments and teasers.
OTHERS_WORDS = frozenset(
    "comment comments disqus outbrain promoted recommended related replies respond taboola".split())
#: With these a header is that of the article and not of the page.
TITLE_WORDS = frozenset("article content entry headline post story title".split())
#: Text outside of the articles that is so many times as long makes these teasers.
TEASERS = 3
#: How sure it is that an element goes: not at all, by its class or id, the same and its articles are others', for certain.
STAYS, BY_CLASS, OTHERS, GOES = range(4)


def _named(names: str) -> set[str]:
    """Words of class names and ids that name the element itself."""
    found: set[str] = set()
    for name in names.split():
        words = _WORD.findall(name)
        if words and words[-1] not in STATES and not TELLS.intersection(words[:-1]):
            found.update(words)
    return found


def _drops(name: str, attributes: str, in_article: bool) -> int:
    if name in DROPPED or (name == "header" and not in_article):
        return GOES
    if name == "form":  # some pages are one form
        return BY_CLASS
    if not attributes or name in ("html", "body", "main") or not attributes.strip(" \t\n/"):
        return STAYS
    found = {k.lower(): html.unescape(v.strip("\"'")).lower() for k, v in _ATTRIBUTE.findall(attributes)}
    if "hidden" in found or found.get("aria-hidden") == "true" or found.get("role") in DROPPED_ROLES:
        return GOES
    words = _named(f"{found.get('class', '')} {found.get('id', '')}")
    if words & OTHERS_WORDS:
        return OTHERS
    return BY_CLASS if words & DROPPED_WORDS or (not in_article and "header" in words and not words & TITLE_WORDS) else STAYS


def blocks(page: str | None) -> tuple[list[str], list[bool]]:
    """Text blocks of a page in order, and whether each is in an article (or main) element.

    With an article, blocks outside of it are left out; the same for main
    when there is no article.

    What goes by class or id is told at the end: it stays where it is or
    holds the article, or where the page has no other text.
    """
    # text; place (0 body, 1 main, 2 article); kind of what is or holds that main or article; whether it goes by class inside of it
    found: list[tuple[str, int, int, bool]] = []
    pieces: dict[tuple[int, int, bool], list[str]] = {}
    stack: list[tuple[str, int]] = []
    opened: dict[str, int] = {}  # open elements by name
    depths = [0, 0, 0, 0]  # open elements of each kind of _drops
    dropped = articles = mains = 0
    # for the outermost open article (2) and main (1): the kind of what is or holds it, and how many such elements are open
    around = [(STAYS, 0)] * 3

    def add(piece: str) -> None:
        place = 2 if articles else 1 if mains else 0
        kind, count = around[place]
        pieces.setdefault((place, kind, depths[BY_CLASS] + depths[OTHERS] > count), []).append(piece)

    def flush() -> None:
        for state, own in pieces.items():
            text = " ".join(html.unescape("".join(own)).split())
            if text:
                found.append((text, *state))
        pieces.clear()

    def pop(count: int) -> None:
        nonlocal dropped, articles, mains
        for _ in range(count):
            name, drop = stack.pop()
            opened[name] -= 1
            depths[drop] -= 1
            dropped -= drop == GOES
            articles -= name == "article"
            mains -= name == "main"

    page = page or ""
    at, size = 0, len(page)
    while at < size:
        start = page.find("<", at)
        if start < 0:
            start = size
        if start > at and not dropped:
            add(page[at:start])
        if start == size:
            break
        tag = _TAG.match(page, start)
        if not tag:
            if not dropped:
                add("<")
            at = start + 1
            continue
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            continue
        if name in BLOCKS and not dropped:
            flush()
        if tag[1]:
            if opened.get(name):  # every step down the stack closes an element
                depth = 1
                while stack[-depth][0] != name:
                    depth += 1
                pop(depth)
            continue
        if name == "br" and not dropped:
            add(" ")
        if name in VOID:
            continue
        for open_name, enders in IMPLIED_END.items():
            if name in enders and opened.get(open_name):
                for depth in range(1, len(stack) + 1):
                    above = stack[-depth][0]
                    if above == open_name:
                        pop(depth)
                        break
                    if above in BLOCKS:
                        break
        if name in RAW:  # their text is not markup
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(page, at)
            at = end.start() if end else size
        drop = _drops(name, tag[3], articles > 0)
        if drop and not dropped and name not in BLOCKS and pieces:
            add(" ")
        stack.append((name, drop))
        opened[name] = opened.get(name, 0) + 1
        depths[drop] += 1
        dropped += drop == GOES
        articles += name == "article"
        mains += name == "main"
        if (name == "article" and articles == 1) or (name == "main" and mains == 1):
            around[2 if name == "article" else 1] = (
                OTHERS if depths[OTHERS] else BY_CLASS if depths[BY_CLASS] else STAYS, depths[BY_CLASS] + depths[OTHERS])
    flush()

    def best(kind: int) -> tuple[list[str], int]:
        own = [(text, place) for text, place, holds, inside in found if holds == kind and not inside]
        place = max((p for _, p in own), default=0)
        return [text for text, p in own if p == place], place

    kept, place = best(STAYS)
    if place == 2:
        beside = [text for text, p, holds, inside in found if p < 2 and holds == STAYS and not inside]
        if sum(map(len, beside)) >= TEASERS * sum(map(len, kept)):
            kept, place = beside, 0
    if place < 2:
        # teasers beside a text without an article are shorter than it
        wrapped, inner = best(BY_CLASS)
        if inner > 0 and sum(map(len, wrapped)) >= sum(map(len, kept)):
            kept, place = wrapped, inner
    if not kept:
        kept, place = best(OTHERS)
    if not kept:
        kept, place = [text for text, *_ in found], 0
    return kept, [place > 0] * len(kept)


def repeated(pages: list[list[str]], least_tokens: int = LEAST_TOKENS, least_pages: int = LEAST_PAGES) -> list[np.ndarray]:
    """For each page which tokens lie in a substring of ``least_tokens`` or more that ``least_pages`` pages share.

    Suffixes are sorted by doubling: ranks of 1, 2, 4 ... tokens, and last of
    two overlapping halves of exactly ``least_tokens``.  A suffix that is too
    short has a rank of its own.
    """
    lengths = np.array([len(p) for p in pages], np.int64)
    total = int(lengths.sum())
    number: dict[str, int] = {}
    ranks = np.fromiter((number.setdefault(t, len(number)) for p in pages for t in p), np.int64, total)
    page = np.repeat(np.arange(len(pages)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(total)  # tokens to the end of the page
    width = 1
    while width < least_tokens:
        step = min(width, least_tokens - width)
        later = np.full(total, -1, np.int64)
        later[: total - step] = ranks[step:] if step else ranks
        whole = left >= width + step
        pair = np.where(whole, ranks * (total + len(number) + 1) + later, -1 - np.arange(total))
        _, ranks = np.unique(pair, return_inverse=True)
        width += step
    covered = np.zeros(total + 1, np.int64)
    order = np.lexsort((page, ranks))
    r, p = ranks[order], page[order]
    new_rank = np.concatenate([[True], r[1:] != r[:-1]]) if total else np.zeros(0, bool)
    new_page = new_rank.copy()
    new_page[1:] |= p[1:] != p[:-1]
    group = np.cumsum(new_rank) - 1
    often = np.bincount(group, new_page)[group] >= least_pages if total else np.zeros(0, bool)
    starts = order[often & (left[order] >= least_tokens)]
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + least_tokens, -1)
    mask = np.cumsum(covered[:-1]) > 0
    return np.split(mask, np.cumsum(lengths)[:-1]) if len(pages) else []


def unique_text(found: list[str], certain: list[bool], mask: np.ndarray) -> str:
    """The blocks joined by new lines, less the covered tokens of those that are not certain."""
    out, at = [], 0
    for block, sure in zip(found, certain):
        tokens = block.split(" ")
        own = mask[at: at + len(tokens)]
        at += len(tokens)
        if not sure and own.any():
            block = " ".join(t for t, c in zip(tokens, own) if not c)
        if block:
            out.append(block)
    return "\n".join(out)


class Windows(dict):
    """Digests of all runs of ``least_tokens`` tokens of a page of a host; remembers words."""

    def __init__(self, least_tokens: int) -> None:
        super().__init__()
        self.least_tokens = least_tokens

    def __missing__(self, word: str) -> int:
        from xxhash import xxh3_64_intdigest

        value = xxh3_64_intdigest(word)
        if len(self) >= CACHE_WORDS:
            self.clear()
        if len(word) <= 100:
            self[word] = value
        return value

    def of(self, host: str, packed: str) -> np.ndarray:
        """One digest for each place where a window begins."""
        tokens = packed.replace("\n", " ").split(" ") if packed else []
        count = max(0, len(tokens) - self.least_tokens + 1)
        hashes = np.fromiter(map(self.__getitem__, tokens), np.uint64, len(tokens))
        found = np.full(count, self[host], np.uint64)
        for k in range(self.least_tokens if count else 0):
            found = (found ^ hashes[k: k + count]) * _M1
            found = (found ^ (found >> np.uint64(32))) * _M2
            found ^= found >> np.uint64(29)
        return found.view(np.int64)


def _large_hosts(parsed: DataFrame, least_tokens: int, least_pages: int) -> DataFrame:
    """page_id, url, text and n_chars of pages of hosts of any size."""
    # ids of stored rows stay, unlike those of rows that a lost task makes again
    stored = materialise(parsed.withColumn("row", F.monotonically_increasing_id()), "pages")
    unsure = F.col("certain").contains("0")
    # stored, so that its size is known and pages of the other hosts are not shuffled
    hosts = materialise(stored.where(unsure).select("host").distinct(), "unsure-hosts")
    counted = stored.join(hosts, "host", "left_semi")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(least_tokens)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                own = [np.unique(windows.of(host, packed)) for host, packed in zip(part.column(1).to_pylist(), part.column(2).to_pylist())]
                if own:
                    row = np.repeat(part.column(0).to_numpy(), [len(o) for o in own])
                    yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(np.concatenate(own))], names=["row", "digest"])

    def digests(pages: DataFrame) -> DataFrame:
        return pages.select("row", "host", "blocks").mapInArrow(digest, "row long, digest long")

    often = digests(counted).groupBy("digest").agg(F.count("*").alias("n")).where(F.col("n") >= least_pages).select("digest")
    covers = digests(stored.where(unsure)).join(often.hint("shuffle_hash"), "digest").groupBy("row").agg(
        F.collect_list("digest").alias("digests"))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(least_tokens)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                texts = []
                for host, packed, flags, often in zip(*(part.column(k).to_pylist() for k in range(2, 6))):
                    own = windows.of(host, packed) if often else np.zeros(0, np.int64)
                    covered = np.zeros(packed.count(" ") + packed.count("\n") + 2, np.int64)
                    starts = np.flatnonzero(np.isin(own, np.array(often or [], np.int64)))
                    np.add.at(covered, starts, 1)
                    np.add.at(covered, starts + least_tokens, -1)
                    found = packed.split("\n") if packed else []
                    texts.append(unique_text(found, [f == "1" for f in flags], np.cumsum(covered) > 0))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                ], names=["page_id", "url", "text", "n_chars"])

    def texts(pages: DataFrame) -> DataFrame:
        return pages.select("page_id", "url", "host", "blocks", "certain", "digests").mapInArrow(
            clean, "page_id long, url string, text string, n_chars long")

    sure = texts(stored.where(~unsure).withColumn("digests", F.lit(None).cast("array<long>")))
    return sure if hosts.isEmpty() else sure.union(texts(stored.where(unsure).join(covers, "row", "left")))


def main_text(pages: DataFrame, least_tokens: int = LEAST_TOKENS, least_pages: int = LEAST_PAGES,
              unit_pages: int = UNIT_PAGES, unit_tokens: int = UNIT_TOKENS) -> DataFrame:
    """page_id, url, text and n_chars of every row."""
    rows = need(pages, page_id="long", url="string", html="string")
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit("")))
    rows = rows.withColumn("host", host)
    # a token and what parts it from the next take two characters of a page or more
    large = materialise(
        rows.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.length("html")).alias("size"))
        .where((F.col("n") > unit_pages) | (F.col("size") > 2 * unit_tokens)).select("host"), "large-hosts")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                made = [blocks(page) for page in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), part.column(3), pa.array(["\n".join(found) for found, _ in made], pa.string()),
                    pa.array(["".join("01"[sure] for sure in certain) for _, certain in made], pa.string()),
                ], names=["page_id", "url", "host", "blocks", "certain"])

    def parsed(pages: DataFrame) -> DataFrame:
        return pages.select("page_id", "url", "html", "host").mapInArrow(
            parse, "page_id long, url string, host string, blocks string, certain string")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit: list[tuple] = []
        current = None

        def close() -> Iterator[pa.RecordBatch]:
            streams = [" ".join(found).split(" ") if found else [] for *_, found, _ in unit]
            masks = repeated(streams, least_tokens, least_pages)
            texts = [unique_text(found, certain, mask) for (_, _, found, certain), mask in zip(unit, masks)]
            yield pa.RecordBatch.from_arrays([
                pa.array([u[0] for u in unit], pa.int64()), pa.array([u[1] for u in unit], pa.string()),
                pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
            ], names=["page_id", "url", "text", "n_chars"])

        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                for host, page_id, url, packed, flags in zip(*(c.to_pylist() for c in part.columns)):
                    if unit and host != current:
                        yield from close()
                        unit = []
                    current = host
                    unit.append((page_id, url, packed.split("\n") if packed else [], [f == "1" for f in flags]))
        if unit:
            yield from close()

    small = parsed(rows.join(large, "host", "left_anti")).select("host", "page_id", "url", "blocks", "certain").repartition("host")
    texts = small.sortWithinPartitions("host", "page_id", "url").mapInArrow(
        clean, "page_id long, url string, text string, n_chars long")
    if large.isEmpty():
        return texts
    return texts.union(_large_hosts(parsed(rows.join(large, "host", "left_semi")), least_tokens, least_pages))
