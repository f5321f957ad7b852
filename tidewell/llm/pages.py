"""Main text of web pages, by markup and by a suffix array over the pages of each host.

A page is cut into blocks at block-level tags. Blocks in menus, headers, footers, sidebars,
notices, adverts, forms and comments, as their tags, roles and class names say, are left out, and
so are scripts, styles and hidden parts. If the page names its main part (an article, a main
element, or a class for it) only blocks in there are candidates, otherwise all that are left.

Candidates are then held against all other pages of the host. The token streams of a part of
the host's pages are concatenated, their suffixes sorted by prefix doubling, and strings of
``LEAST_TOKENS`` or more are found as equal prefixes of neighbours; longer prefixes would not
change which tokens are covered, so doubling stops there. On how many distinct pages a string
occurs is summed over the parts of the host by its hash.
Blocks that such strings cover are boilerplate and go; unique runs stay. On a page without a
named main part, ``FEW_PAGES`` are enough; inside a named one a string must be on most pages of the
host. A string that makes up half a page or more is no boilerplate, but a copy of the page, unless
it is on most pages.

A host is dealt by hash of the page to parts of about ``PART_CHARS``, so one host may hold any share
of the table, and its strings by their hashes to as many tasks that sum them. What counts is the sum
over the host, so neither the parts nor the size of the table change a result.

Defined results: a null or empty page has the text ""; pages without a host in their url are not
compared; repeated rows each have their result; other columns are not read, whatever their names.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import arrow_batch, slices, table

LEAST_TOKENS = 8
FEW_PAGES = 3
#: Most pages: this share of a host, and so many at least.
MOST_SHARE, MOST_PAGES = 0.6, 8
#: Share of a block's tokens that makes it covered.
COVERED = 0.7
#: Characters of candidate text in a part of a host.
PART_CHARS = 4 << 20
#: A host with a smaller share of the table than one in so many goes to one task, some chunks at a time.
SPLIT_HOSTS = 1 << 16
#: Bits of a string's hash: among 10^8 different strings of a host one meets another with a chance of 1.4 in 10^6.
HASH_BITS = 46
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

# -- markup ---------------------------------------------------------------------------------

# Element, role and class names of HTML and common templates.
RAW = "script style title textarea iframe noembed noframes xmp".split()
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
LEFT_OUT = set(
    "head nav footer aside form menu dialog button select datalist noscript template svg math object "
    "canvas audio video".split()
)
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav "
    "ol optgroup option p pre search section summary table tbody tfoot thead tr ul".split()
)
LEFT_OUT_ROLES = set(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)
LEFT_OUT_NAMES = set(
    "ad ads advert adverts advertisement advertisements advertising adsense banner breadcrumb breadcrumbs "
    "comment comments consent cookie cookies copyright disqus footer gdpr login masthead menu modal nav navbar "
    "navigation newsletter notice notices notification notifications overlay pager pagination popup promo "
    "promotion recommended related replies reply respond share sharing sidebar signup social sponsor sponsored "
    "subscribe subscription toolbar widget widgets".split()
)
#: First parts of names that say something about a page, not about a part of it.
STATES = set("has with without no is hide show".split())
MAIN_NAMES = set(
    "article article-body article-content article-text content-body entry entry-content main main-content "
    "main-text page-content post post-body post-content story story-body".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{'|'.join(RAW)})(?=[\s/>])[^<>]*+>.*?(?:</(?P=raw)\s*+>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^<>\"']++|\"[^\"]{0,4096}+\"|'[^']{0,4096}+'){0,64}+)>"
    r"|<[!?/][^<>]*+>",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(
    r"""(class|id|role|hidden|aria-hidden|itemprop|style)\s*+(?:=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""", re.IGNORECASE
)
_NAMED = re.compile(r"class|id|role|hidden|itemprop|style", re.IGNORECASE)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_PART = re.compile(r"[-_:.]+|(?<=[a-z])(?=[A-Z])")

#: Stands between the blocks of a page; never part of a text.
BREAK = "\x00"

#: How surely a block belongs to the main part.
ANY, BY_NAME, IN_MAIN, IN_ARTICLE = range(4)


def _kind(name: str, attrs: str, level: int) -> tuple[bool, int]:
    """Whether an element is left out, and how sure it is to be the main part."""
    if name in ("html", "body"):
        return False, ANY
    out = name in LEFT_OUT or (name == "header" and level < IN_MAIN)
    main = IN_ARTICLE if name == "article" else IN_MAIN if name == "main" else ANY
    if not _NAMED.search(attrs):
        return out, main
    for key, value in _ATTRIBUTE.findall(attrs):
        key, value = key.lower(), html.unescape(value.strip("\"'"))
        if key == "role":
            out = out or value.lower() in LEFT_OUT_ROLES
            main = max(main, {"main": IN_MAIN, "article": IN_ARTICLE}.get(value.lower(), ANY))
        elif key == "itemprop":
            main = max(main, IN_ARTICLE if value.lower() == "articlebody" else ANY)
        elif key == "style":
            out = out or bool(_HIDDEN.search(value))
        elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            out = True
        elif key in ("class", "id"):
            for word in value.split():
                parts = [p.lower() for p in _PART.split(word) if p]
                if parts and parts[0] not in STATES and not LEFT_OUT_NAMES.isdisjoint((parts[0], parts[-1])):
                    out = True
                elif "-".join(parts) in MAIN_NAMES:
                    main = max(main, BY_NAME)
    return out, main


class _Open:
    """The open elements. Wrongly nested and missing end tags close what they would in a browser, roughly."""

    def __init__(self):
        self.stack: list[tuple[str, bool, int]] = []
        self.names: Counter = Counter()
        self.out = 0

    def level(self) -> int:
        return self.stack[-1][2] if self.stack else ANY

    def push(self, name: str, attrs: str) -> None:
        if name in BLOCKS:
            self._before_block(name)
        out, main = _kind(name, attrs, self.level())
        self.stack.append((name, out, max(main, self.level())))
        self.names[name] += 1
        self.out += out

    def _before_block(self, name: str) -> None:
        if name == "body" or name == "main":
            # What a page left open before its body or main part ends there.
            self._cut(next((i for i, x in enumerate(self.stack) if x[1]), len(self.stack)))
        elif name == "article" and self.out:
            first = next(i for i, x in enumerate(self.stack) if x[1])
            if self.stack[first][0] in ("nav", "header", "head"):
                self._cut(first)
        if self.names["p"] and name != "table":
            self.close("p", within=("button", "td", "th", "table", "div", "section", "article"))
        if name == "li":
            self.close("li", within=("ul", "ol", "menu"))

    def close(self, name: str, within: tuple[str, ...] = ()) -> None:
        if not self.names[name]:
            return
        for i in range(len(self.stack) - 1, -1, -1):
            found = self.stack[i][0]
            if found == name:
                self._cut(i)
                return
            if found in within or (name not in BLOCKS and found in BLOCKS):
                return

    def _cut(self, size: int) -> None:
        for name, out, _ in self.stack[size:]:
            self.names[name] -= 1
            self.out -= out
        del self.stack[size:]


def blocks_of(page: str | None) -> tuple[int, list[str]]:
    """How sure the main part is (``ANY``: it is not named), and its blocks in page order."""
    found: list[tuple[int, str]] = []
    held: list[str] = []
    opened = _Open()

    def end_block() -> None:
        text = " ".join("".join(held).replace(BREAK, " ").split())
        held.clear()
        if text:
            found.append((opened.level(), text))

    page = page or ""
    at = 0
    for token in _TOKEN.finditer(page):
        if token.start() > at and not opened.out:
            held.append(html.unescape(page[at : token.start()]))
        at = token.end()
        name = (token["name"] or "").lower()
        if not name:
            continue
        if name in BLOCKS:
            end_block()
        elif name in ("br", "td", "th"):
            held.append(" ")
        if name in VOID:
            continue
        if token["close"]:
            opened.close(name)
        else:
            opened.push(name, token["attrs"])
    if at < len(page) and not opened.out:
        held.append(html.unescape(page[at:]))
    end_block()
    most = max((level for level, _ in found), default=ANY)
    return most, [text for level, text in found if level == most]


# -- strings that repeat on a host ----------------------------------------------------------


def string_classes(tokens: np.ndarray, least: int) -> np.ndarray:
    """A number for the string of ``least`` tokens (a power of two) at each place, by prefix doubling.

    Ranks of suffixes by their first 1, 2, 4, ... tokens; equal ranks are equal prefixes. Past the
    end there is a token of its own.
    """
    ranks = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    length = 1
    while length < least:
        after = np.concatenate([ranks[length:] + 1, np.zeros(min(length, len(ranks)), np.int64)])
        ranks = np.unique(ranks * (len(ranks) + 2) + after, return_inverse=True)[1].astype(np.int64)
        length *= 2
    return ranks


def _stream(pages: Iterable[list[str]]) -> tuple[np.ndarray, list[str], np.ndarray, list[np.ndarray]]:
    """The concatenated pages as numbers of their different tokens, these tokens, the page of each
    place, and the places of each page's tokens. The tokens of one page are held at a time."""
    number: dict[str, int] = {}
    stream, places, at = [], [], 0
    for k, page in enumerate(pages):
        # Between pages stands a token that occurs once.
        stream.append(np.array([*(number.setdefault(t, len(number)) for t in page), -1 - k], np.int64))
        places.append(np.arange(at, at + len(page), dtype=np.int64))
        at += len(page) + 1
    owner = np.repeat(np.arange(len(stream)), [len(own) for own in stream])
    return np.concatenate([np.empty(0, np.int64), *stream]), list(number), owner, places


def _tokens(pages: list[tuple[bool, list[str]]]) -> Iterator[list[str]]:
    return ([t for b in blocks for t in b.split(" ")] for _, blocks in pages)


def _whole(places: list[np.ndarray], size: int, least: int) -> np.ndarray:
    """Where a string of ``least`` tokens ends on its page: one that runs over the end is no string of the page."""
    whole = np.zeros(size, bool)
    for own in places:
        whole[own[: max(0, len(own) - least + 1)]] = True
    return whole


def _pages_with(classes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """On how many pages each class occurs."""
    pages = int(owner[-1]) + 1 if len(owner) else 1
    return np.bincount(np.unique(classes * pages + owner) // pages)


def repeated_on(pages: list[list[str]], least: int = LEAST_TOKENS) -> tuple[np.ndarray, list[np.ndarray]]:
    """For each token of the concatenated pages, on how many pages the string from there occurs;
    and the places of each page's tokens."""
    stream, _, owner, places = _stream(pages)
    classes = string_classes(stream, least)
    on = _pages_with(classes, owner)[classes]
    on[~_whole(places, len(stream), least)] = 0
    return on, places


def string_hashes(stream: np.ndarray, tokens: list[str], least: int) -> np.ndarray:
    """A hash of ``HASH_BITS`` bits of the string of ``least`` tokens at each place, the same in every part."""
    own = np.array([xxhash.xxh64_intdigest(t.encode(errors="replace")) for t in tokens] + [0], np.uint64)[stream.clip(-1)]
    out = np.zeros(len(stream), np.uint64)
    for k in range(min(least, len(stream))):
        out *= MULTIPLIER
        out[: len(own) - k] += own[k:]
    out = (out ^ (out >> np.uint64(32))) * MULTIPLIER
    return out >> np.uint64(64 - HASH_BITS)


def string_counts(pages: Iterable[list[str]], least: int = LEAST_TOKENS) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the strings of a part, ascending, and on how many of its pages each occurs."""
    stream, tokens, owner, places = _stream(pages)
    classes = string_classes(stream, least)
    on = _pages_with(classes, owner)
    whole = np.flatnonzero(_whole(places, len(stream), least))
    found, first = np.unique(classes[whole], return_index=True)
    hashes = string_hashes(stream, tokens, least)[whole[first]]
    order = np.argsort(hashes)
    return hashes[order], on[found[order]]


def host_counts(
    pages: Iterable[list[str]], often: tuple[np.ndarray, np.ndarray], least: int = LEAST_TOKENS
) -> tuple[np.ndarray, list[np.ndarray]]:
    """As ``repeated_on``, but over all pages of a host: by the hashes and counts of its frequent strings, others 0."""
    stream, tokens, _, places = _stream(pages)
    on = np.zeros(len(stream), np.int64)
    if len(often[0]):
        hashes = string_hashes(stream, tokens, least)
        at = np.minimum(np.searchsorted(often[0], hashes), len(often[0]) - 1)
        hit = (often[0][at] == hashes) & _whole(places, len(stream), least)
        on[hit] = often[1][at[hit]]
    return on, places


def most_of(pages: int) -> int:
    """How many of the pages of a host are most of them."""
    return max(MOST_PAGES, int(np.ceil(MOST_SHARE * pages)))


def packed(hashes: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending hashes, as differences, and their counts in bytes; low and high bytes apart."""
    both = np.concatenate([np.diff(hashes, prepend=np.uint64(0)), counts.astype(np.uint64)])
    squeeze = zlib.compressobj(1, zlib.DEFLATED, -15, 9, zlib.Z_RLE)
    return squeeze.compress(both.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()) + squeeze.flush()


def unpacked(pack: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zlib.decompress(pack, -15), np.uint8)
    both = np.ascontiguousarray(raw.reshape(8, -1).T).view("<u8").ravel()
    return np.cumsum(both[: len(both) // 2], dtype=np.uint64), both[len(both) // 2 :].astype(np.int64)


def _covered(on: np.ndarray, few: int, most: int, least: int) -> np.ndarray:
    """Which tokens of a page lie in strings on ``few`` pages or more, copies of the page aside.

    ``on`` counts the pages of the string from each token. A run of such strings that makes up
    half the page is a copy; of it only strings on ``most`` pages count.
    """
    shared = on >= few
    edges = np.flatnonzero(np.diff(np.concatenate([[False], shared, [False]]).astype(np.int8)))
    covered = np.zeros(len(on), bool)
    for start, stop in edges.reshape(-1, 2):
        if 2 * (stop - start + least - 1) < len(on):
            covered[start : stop + least - 1] = True
        else:
            for place in np.flatnonzero(on[start:stop] >= most) + start:
                covered[place : place + least] = True
    return covered


def kept_blocks(
    pages: list[tuple[bool, list[str]]], often: tuple[np.ndarray, np.ndarray], most: int, least: int = LEAST_TOKENS
) -> list[list[bool]]:
    """Which blocks of each page (main part named or not, blocks) of a host are no boilerplate, by the
    host's frequent strings; ``most`` are most of its pages."""
    if not len(often[0]):
        return [[True] * len(blocks) for _, blocks in pages]
    on, places = host_counts(_tokens(pages), often, least)
    out = []
    for (named, blocks), own in zip(pages, places, strict=True):
        covered = _covered(on[own], most if named else min(FEW_PAGES, most), most, least)
        sums = np.concatenate([[0], np.cumsum(covered)])
        lengths = [b.count(" ") + 1 for b in blocks]
        ends = np.cumsum(lengths).tolist()
        out.append([sums[e] - sums[e - n] < COVERED * n for e, n in zip(ends, lengths, strict=True)])
    return out


# -- the table ------------------------------------------------------------------------------

BLOCKED = "page_id long, url string, host string, named boolean, blocks binary, chars long, h long"
COUNTED = "host string, bucket int, part int, pages long, unnamed long, strings binary"
OFTEN = "host string, part int, pages long, strings binary"
EXTRACTED = "page_id long, url string, text string, n_chars long, n_boilerplate long"
_HOST = re.compile(r"\s*[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", re.IGNORECASE)


def host_of(url: str | None) -> str | None:
    found = _HOST.match(url or "")
    return found[1].lower() or None if found else None


def _blocked(batches):
    schema = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("named", pa.bool_()),
         ("blocks", pa.binary()), ("chars", pa.int64()), ("h", pa.int64())]
    )
    for batch in slices(batches):
        rows = []
        for page_id, url, page, h in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            level, blocks = blocks_of(page)
            joined = BREAK.join(blocks)
            packed = zlib.compress(joined.encode(errors="replace"), 6)
            rows.append((page_id, url, host_of(url), level > ANY, packed, len(joined), h))
        yield arrow_batch(list(zip(*rows, strict=True)), schema)


def _parts(batches) -> Iterator[list[tuple]]:
    """Rows (host, part, ..., chars at 6) of one part of a host at a time: neighbours, as sorted, up to twice ``PART_CHARS``."""
    held, chars, place = [], 0, None
    for batch in slices(batches):
        for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True):
            here = row[:2]
            if held and (here != place or here[0] is None or chars > 2 * PART_CHARS):
                yield held
                held, chars = [], 0
            held.append(row)
            chars, place = chars + row[6], here
    if held:
        yield held


def _unpacked_pages(part: list[tuple]) -> list[tuple[bool, list[str]]]:
    """Whether the main part is named and the blocks of each row."""
    joined = ((row[4], zlib.decompress(row[5]).decode()) for row in part)
    return [(named, text.split(BREAK) if text else []) for named, text in joined]


def _counted(batches):
    """The strings of each part, in as many ranges of hashes as its host has parts."""
    schema = pa.schema(
        [("host", pa.string()), ("bucket", pa.int32()), ("part", pa.int32()), ("pages", pa.int64()),
         ("unnamed", pa.int64()), ("strings", pa.binary())]
    )
    for part in _parts(batches):
        host, number, parts = part[0][0], part[0][1], part[0][8]
        if host is None:
            continue
        pages = _unpacked_pages(part)
        hashes, counts = string_counts(_tokens(pages))
        bounds = np.searchsorted((hashes >> np.uint64(24)) * np.uint64(parts) >> np.uint64(HASH_BITS - 24), np.arange(parts + 1))
        here = (number, len(pages), sum(not named for named, _ in pages))
        for start in range(0, parts, 64):
            rows = []
            for bucket in range(start, min(start + 64, parts)):
                own = slice(bounds[bucket], bounds[bucket + 1])
                rows.append((host, bucket, *here, packed(hashes[own], counts[own])))
            yield arrow_batch(list(zip(*rows, strict=True)), schema)


def _groups(batches) -> Iterator[list[tuple]]:
    """Neighbouring rows with equal first two columns."""
    rows = (r for b in slices(batches, 16) for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    for _, group in groupby(rows, lambda row: row[:2]):
        yield list(group)


def _often(batches):
    """Of each range of a host's strings those that are frequent enough to strike out a block of the
    host, to each part that has them. The first range tells the parts the number of pages, too."""
    schema = pa.schema([("host", pa.string()), ("part", pa.int32()), ("pages", pa.int64()), ("strings", pa.binary())])
    for group in _groups(batches):
        pages, unnamed = sum(row[3] for row in group), sum(row[4] for row in group)
        least = min(FEW_PAGES, most_of(pages)) if unnamed else most_of(pages)
        strings = [unpacked(row[5]) for row in group]
        hashes, place = np.unique(np.concatenate([h for h, _ in strings]), return_inverse=True)
        on = np.bincount(place, np.concatenate([n for _, n in strings]), len(hashes)).astype(np.int64)
        rows, at = [], 0
        for row, (own, _) in zip(group, strings, strict=True):
            here = place[at : at + len(own)]
            at += len(own)
            here = here[on[here] >= least]
            if len(here) or row[1] == 0:
                rows.append((row[0], row[2], pages, packed(hashes[here], on[here])))
        if rows:
            yield arrow_batch(list(zip(*rows, strict=True)), schema)


def _extracted(batches):
    schema = pa.schema(
        [("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64()),
         ("n_boilerplate", pa.int64())]
    )
    none = (np.empty(0, np.uint64), np.empty(0, np.int64))
    held, place, often, most = [], None, none, MOST_PAGES
    for part in _parts(batches):
        if part[0][:2] != place or place[0] is None:  # the first row of a part has its frequent strings
            place, often, most = part[0][:2], none, most_of(part[0][10] or 0)
            strings = [unpacked(x) for x in part[0][9] or ()]
            if strings:
                hashes, first = np.unique(np.concatenate([h for h, _ in strings]), return_index=True)
                often = hashes, np.concatenate([n for _, n in strings])[first]
        pages = _unpacked_pages(part)
        for row, (_, blocks), keep in zip(part, pages, kept_blocks(pages, often, most), strict=True):
            text = "\n\n".join(b for b, k in zip(blocks, keep, strict=True) if k)
            held.append((row[2], row[3], text, len(text), len(blocks) - sum(keep)))
        while len(held) >= 256:
            yield arrow_batch(list(zip(*held[:256], strict=True)), schema)
            held = held[256:]
    if held:
        yield arrow_batch(list(zip(*held, strict=True)), schema)


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, n_boilerplate): the main text of every row of ``pages``
    (page_id, url, html), its code points, and how many blocks the host's other pages struck out.
    """
    spark = pages.sparkSession
    narrow = pages.select(
        pages["page_id"].cast("long").alias("page_id"),
        pages["url"].cast("string").alias("url"),
        pages["html"].cast("string").alias("html"),
        F.xxhash64(pages["page_id"].cast("long"), pages["url"].cast("string"), pages["html"].cast("string")).alias("h"),
    )
    # Hosts too large for one task: at most SPLIT_HOSTS of them, whatever the table.
    host = F.lower(F.regexp_extract("url", r"^\s*[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    sizes = narrow.groupBy(host.alias("host")).agg(F.sum(F.length("html")).alias("chars")).where("host != ''")
    total = sizes.agg(F.sum("chars")).first()[0] or 0
    large = sizes.where(F.col("chars") > max(PART_CHARS, total // SPLIT_HOSTS)).select(
        F.col("host").alias("large"), F.ceil(F.col("chars") / PART_CHARS).cast("int").alias("parts")
    )
    large = spark.createDataFrame(large.collect(), "large string, parts int")
    blocked = narrow.mapInArrow(_blocked, BLOCKED)
    dealt = blocked.join(F.broadcast(large), blocked["host"] == large["large"], "left")
    part = F.pmod(F.col("h"), F.coalesce("parts", F.lit(1)).cast("long"))
    # Pages without a host need no company: they are dealt by hash.
    part = F.when(F.col("host").isNull(), F.pmod("h", F.lit(SPLIT_HOSTS))).otherwise(part)
    keyed = dealt.select(
        "host", part.cast("int").alias("part"), "page_id", "url", "named", "blocks", "chars", "h",
        F.coalesce("parts", F.lit(1)).alias("parts"),
    )
    placed = keyed.repartition("host", "part")
    # Both functions take all columns, so that Spark finds one shuffle of the pages for the two.
    counted = placed.sortWithinPartitions("host", "part").mapInArrow(_counted, COUNTED)
    often = counted.repartition("host", "bucket").sortWithinPartitions("host", "bucket").mapInArrow(_often, OFTEN)
    often = often.groupBy("host", "part").agg(F.max("pages").alias("pages"), F.collect_list("strings").alias("strings"))
    # Shuffled alike, and only the first row of a part takes the strings along.
    order = F.row_number().over(Window.partitionBy("host", "part").orderBy("h", "page_id"))
    joined = placed.withColumn("nth", order).join(often.hint("merge"), ["host", "part"], "left")
    first = F.col("nth") == 1
    return joined.select(
        *placed.columns, F.when(first, F.col("strings")).alias("strings"), F.when(first, F.col("pages")).alias("pages")
    ).mapInArrow(_extracted, EXTRACTED)


def op12_pages(spark, folder):
    return extracted(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars", "n_boilerplate")
