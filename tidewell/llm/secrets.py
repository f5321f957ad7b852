"""Secret scan: base patterns on the text, and on every layer hidden in it.

A text is a worklist of layers. Each layer is scanned; URL escapes, Unicode escapes and
character references in it are undone (a new layer of the whole text), base64 runs are
decoded and, when gzip, zlib or zstd data, unpacked (a new layer of that run). A layer
remembers for each character which characters of the document it stands for, so a find
in any layer is a span of the document. A layer already seen at its place is not taken
up again, which ends cycles; decoding stops when nothing new appears.
"""

from __future__ import annotations

import base64
import binascii
import codecs
import hashlib
import io
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from tidewell.llm.common import arrow_batch, slices, table

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(?ai:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
# A match of either class is a whole run, so the least length can stand in the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_ASSIGNED = 12
KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")

ESCAPE = re.compile(
    r"(?P<url>(?:%[0-9A-Fa-f]{2})+)"
    r"|(?P<uni>(?:\\u[0-9A-Fa-f]{4})+)"
    r"|(?P<wide>\\U[0-9A-Fa-f]{8}|\\u\{[0-9A-Fa-f]{1,6}\})"
    r"|(?P<byte>(?:\\x[0-9A-Fa-f]{2})+)"
    r"|&\#(?P<ref>[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});"
)
BASE64 = re.compile(r"([A-Za-z0-9+/_-]{16,})={0,2}")
#: Base64 wrapped over lines: the first piece ends its line, the later ones start theirs. A run is
#: read once, from its start, so a long unbroken one takes time in proportion.
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:\r?\n[ \t]*+[A-Za-z0-9+/_-]++)++={0,2}")
#: Letters of base64 that also part the words of a path or a name.
PARTING = re.compile(r"[+/_-]")
#: Least characters of a find; a shorter layer behind such a letter holds none.
LEAST_FIND = 16
PIECE = re.compile(r"[A-Za-z0-9+/_-]+")
#: A packed layer that grows beyond this many bytes is not opened; the row counts it in
#: ``n_refused``, so that one hostile text cannot take a task's memory.
MOST_UNPACKED = 64 << 20
REFUSED = "refused"
# First bytes of packed data, and bytes unpacked at one time.
GZIP, ZSTD = b"\x1f\x8b", b"\x28\xb5\x2f\xfd"
STEP = 1 << 20
PIECE_BYTES = 1 << 10

SCHEMA = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
    "n_layers long, n_refused long"
)
ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
     ("base_sha256", pa.string()), ("spans", pa.string()), ("n_layers", pa.int64()), ("n_refused", pa.int64())]
)


def finds(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, leftmost and non-overlapping per kind."""
    out = []
    low = text.lower()
    if any(word in low for word in KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _kept(text: str, run: str, step: int, widths: list[int]) -> list[tuple[str, int, int]] | None:
    """The characters of ``text`` with their part of the run; a lone surrogate stands for escapes
    that are no text and stay as written. None when nothing could be undone."""
    out, at, undone = [], 0, False
    for c, width in zip(text, widths, strict=True):
        end = at + width * step
        if 0xD800 <= ord(c) < 0xE000:
            out += [(run[i], i, i + 1) for i in range(at, end)]
        else:
            out.append((c, at, end))
            undone = True
        at = end
    return out if undone else None


def _unescaped(m: re.Match) -> list[tuple[str, int, int]] | None:
    """Characters of an escape run, each with its part of the run."""
    run, kind = m[0], m.lastgroup
    if kind in ("url", "byte"):
        step = 3 if kind == "url" else 4
        data = bytes(int(run[i + step - 2 : i + step], 16) for i in range(0, len(run), step))
        text = data.decode("utf-8", "surrogateescape")
        return _kept(text, run, step, [len(c.encode("utf-8", "surrogateescape")) for c in text])
    if kind == "uni":
        units = b"".join(int(run[i + 2 : i + 6], 16).to_bytes(2, "little") for i in range(0, len(run), 6))
        text = units.decode("utf-16-le", "surrogatepass")
        return _kept(text, run, 6, [1 + (ord(c) > 0xFFFF) for c in text])
    digits = m["ref"] if kind == "ref" else run[2:].strip("{}")
    value = int(digits, 10) if kind == "ref" and digits[0] not in "xX" else int(digits.lstrip("xX"), 16)
    if value > 0x10FFFF or 0xD800 <= value < 0xE000 or value == 0:
        return None
    return [(chr(value), 0, len(run))]


def unescape(text: str, first: np.ndarray, last: np.ndarray):
    """The layer with all escapes undone once, or None when it has none."""
    parts, firsts, lasts, at, changed = [], [], [], 0, False
    for m in ESCAPE.finditer(text):
        found = _unescaped(m)
        if not found:
            continue
        changed = True
        parts.append(text[at : m.start()] + "".join(c for c, _, _ in found))
        firsts += [first[at : m.start()], first[[m.start() + a for _, a, _ in found]]]
        lasts += [last[at : m.start()], last[[m.start() + b - 1 for _, _, b in found]]]
        at = m.end()
    if not changed:
        return None
    parts.append(text[at:])
    return "".join(parts), np.concatenate([*firsts, first[at:]]), np.concatenate([*lasts, last[at:]])


def _inflated(data: bytes, wbits: int) -> Iterator[bytes | None]:
    """Parts of a zlib or gzip stream; None at the very end of the last member. Read in small
    pieces, since a fault takes along what its piece holds."""
    while True:
        opened, at = zlib.decompressobj(wbits), 0
        while at < len(data) and not opened.eof:
            piece = data[at : at + PIECE_BYTES]
            at += len(piece)
            while piece and not opened.eof:
                yield opened.decompress(piece, STEP)
                piece = opened.unconsumed_tail
        if not opened.eof:
            return
        data = opened.unused_data + data[at:]
        if wbits < 16 or not data.startswith(GZIP):
            yield None
            return


def _expanded(data: bytes) -> Iterator[bytes | None]:
    with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True) as reader:
        while part := reader.read(STEP):
            yield part
    yield None


def _unpacked(data: bytes) -> tuple[bytes, bool] | None:
    """Packed data opened, as far as it goes, and whether it goes to its end; None if it is not
    packed. Raises OverflowError beyond the bound."""
    if data.startswith(GZIP):
        parts = _inflated(data, 31)
    elif data.startswith(ZSTD):
        parts = _expanded(data)
    elif len(data) > 2 and data[0] & 15 == 8 and (data[0] << 8 | data[1]) % 31 == 0:
        parts = _inflated(data, 15)
    else:
        return None
    out, size, whole = [], 0, False
    try:
        for part in parts:
            if part is None:
                whole = True
                break
            out.append(part)
            size += len(part)
            if size > MOST_UNPACKED:
                raise OverflowError
    except (zlib.error, zstandard.ZstdError):
        pass
    return (b"".join(out), whole) if size or whole else None


def _readable(data: bytes, whole: bool = True) -> str | None:
    """Text in UTF-8; of a faulty stream what comes before the first other byte."""
    try:
        text = codecs.utf_8_decode(data, "strict", whole)[0]
    except UnicodeDecodeError as error:
        if whole:
            return None
        text = data[: error.start].decode("utf-8")
    return text or None


def _pieces(m: re.Match) -> Iterator[list[tuple[int, int]]]:
    """Ways to read lines as one base64 run: all of them, or as far as they are equally wide,
    each also without the first or the last line, which may be other text."""
    pieces = [(m.start() + p.start(), m.start() + p.end()) for p in PIECE.finditer(m[0])]
    even, width = 2, pieces[1][1] - pieces[1][0]
    while even < len(pieces) and pieces[even - 1][1] - pieces[even - 1][0] == width >= pieces[even][1] - pieces[even][0]:
        even += 1
    for end in dict.fromkeys((len(pieces), even, len(pieces) - 1, even - 1)):
        for start in (0, 1):
            if end - start > 1:
                yield pieces[start:end]


def _text_bytes(data: memoryview) -> int:
    """How many bytes from the start are UTF-8; reads little more than that."""
    size = 64
    while True:
        try:
            good = codecs.utf_8_decode(data[:size], "strict", False)[1]
        except UnicodeDecodeError as error:
            return error.start
        if size >= len(data):
            return good
        size *= 2


def _glued(run: str) -> Iterator[tuple[int, int]]:
    """Parts of a run that are base64 of text or packed data behind the end of a path or name.

    The run is decoded once for each of the four ways to begin; a part of text ends where UTF-8
    ends, and the next one is looked for behind it.
    """
    plain, decoded, done = run.replace("-", "+").replace("_", "/"), {}, 0
    for m in PARTING.finditer(run):
        start = m.end()
        if len(run) - start < LEAST_FIND:
            return
        if start < done:
            continue
        way = start % 4
        if way not in decoded:
            # A last letter alone holds no byte; two or three hold one or two.
            rest = plain[way : len(run) - ((len(run) - way) % 4 == 1)]
            decoded[way] = memoryview(binascii.a2b_base64(rest + "=" * (-len(rest) % 4)))
        data = decoded[way][(start - way) // 4 * 3 :]
        if data[:4] == ZSTD or data[:3] == GZIP + b"\x08":
            yield start, len(run)
            return
        good = _text_bytes(data)
        if good >= LEAST_FIND:
            done = len(run) if good == len(data) else start + good // 3 * 4
            yield start, done


def unwrap(text: str, first: np.ndarray, last: np.ndarray) -> Iterator[tuple | str]:
    """Layers in the base64 runs of a layer; REFUSED for one that is too large to open."""
    for m in BASE64.finditer(text):
        layer = _opened(m[1], np.arange(m.start(), m.end(1)), m.end(), first, last)
        if layer is not None:
            yield layer
        else:
            for start, end in _glued(m[1]):
                at = np.arange(m.start() + start, m.start() + end)
                layer = _opened(m[1][start:end], at, m.end() if end == len(m[1]) else m.start() + end, first, last)
                if layer is not None:
                    yield layer
    for m in WRAPPED.finditer(text):
        for pieces in _pieces(m):
            at = np.concatenate([np.arange(a, b) for a, b in pieces])
            run = "".join(text[a:b] for a, b in pieces)
            layer = _opened(run, at, m.end() if pieces[-1][1] + 2 >= m.end() else pieces[-1][1], first, last)
            if layer is not None:
                yield layer


def _opened(run: str, at: np.ndarray, end: int, first: np.ndarray, last: np.ndarray) -> tuple | str | None:
    """The layer of a base64 run whose characters are at the places ``at`` of their layer and
    that ends, with its padding, before ``end``."""
    run = run.replace("-", "+").replace("_", "/")
    run = run[: len(run) - (len(run) % 4 == 1)]
    try:
        data = base64.b64decode(run + "=" * (-len(run) % 4), validate=True)
    except binascii.Error:
        return None
    packed, whole = False, True
    try:
        while (opened := _unpacked(data)) is not None:
            # Text may begin like a zlib stream, but none ends like one.
            if not opened[1] and not data.startswith((GZIP, ZSTD)) and _readable(data, whole):
                break
            (data, ended), packed = opened, True
            whole = whole and ended
    except OverflowError:
        return REFUSED
    found = _readable(data, whole)
    if found is None:
        return None
    if packed:  # a packed character stands for the whole run
        return found, np.full(len(found), first[at[0]]), np.full(len(found), last[end - 1])
    widths = np.fromiter((len(c.encode("utf-8")) for c in found), np.int64, len(found))
    ends = np.cumsum(widths)
    firsts = at[(ends - widths) * 4 // 3]
    lasts = np.minimum((ends - 1) * 4 // 3 + 1, len(at) - 1)
    return found, first[firsts], last[at[lasts]]


def all_spans(text: str, base: list[tuple[int, int, int]]):
    """Base spans and those of the hidden layers, in the document's code points."""
    spans, layers, refused = set(base), 0, 0
    if not (ESCAPE.search(text) or BASE64.search(text)):
        return spans, layers, refused
    place = np.arange(len(text))
    work, seen = [(text, place, place)], set()
    while work:
        layer, first, last = work.pop()
        for child in (unescape(layer, first, last), *unwrap(layer, first, last)):
            if child is None:
                continue
            if child == REFUSED:
                refused += 1
                continue
            digest = hashlib.sha256(child[0].encode("utf-8", "surrogatepass")).digest()
            mark = (digest, int(child[1][0]), int(child[2][-1]))
            if mark in seen:
                continue
            seen.add(mark)
            layers += 1
            spans.update(
                (int(child[1][s:e].min()), kind, int(child[2][s:e].max()) + 1) for s, kind, e in finds(child[0])
            )
            work.append(child)
    return spans, layers, refused


def _joined(spans) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def _scan(batches):
    for batch in slices(batches):
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            text = text or ""
            base = finds(text)
            spans, layers, refused = all_spans(text, base)
            counts = [sum(kind == k for _, kind, _ in base) for k in range(3)]
            digest = hashlib.sha256(_joined(base).encode()).hexdigest()
            rows.append((doc_id, *counts, digest, _joined(spans), layers, refused))
        if rows:
            yield arrow_batch(list(zip(*rows, strict=True)), ARROW)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: counts, base digest and all spans. Narrow, no shuffle.

    A null text counts as empty, a null id stays null, repeated rows give repeated rows,
    other columns are ignored, an empty table gives an empty result. Equal spans found in
    several layers are listed once.
    """
    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return narrow.mapInArrow(_scan, SCHEMA)


def op1_secrets(spark, folder):
    return scan_secrets(table(spark, folder, "documents"))
