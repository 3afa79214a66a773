"""Secret scans through nested encodings.

Each text is searched as it stands. A worklist then unwraps every encoded layer in it:
percent escapes, Unicode escapes, base64 runs, and compressed data inside any of them. Each
new layer is searched and unwrapped in turn until nothing new appears; a layer already
seen at the same place is not entered again, so self-reproducing archives end. What is
found in a layer is reported at the place in the original text it was unwrapped from.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import map_batches

# The kinds in their order, what they match, and how long a match must be.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_VALUE = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LENGTH = 20
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so shorter ones may be passed over

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_QUOTED = re.compile(r"(?<![!-~])[!-~]*?%[0-9A-Fa-f]{2}[!-~]*+")  # with the unquoted characters between
_QUOTED_BYTE = re.compile(rb"%[0-9A-Fa-f]{2}")
_ESCAPED_BYTE = re.compile(rb"\\(?:x[0-9a-fA-F]{2}|u00[0-9a-fA-F]{2}|U000000[0-9a-fA-F]{2}|[abfnrtv0\\'\"/])")
#: A piece of a stream may end within an escape, which then waits for the next piece.
_QUOTED_HEAD = re.compile(rb"%[0-9A-Fa-f]?\Z")
_ESCAPED_HEAD = re.compile(rb"(?:\\\\)*+(\\(?:x[0-9a-fA-F]?|u0?|u00[0-9a-fA-F]?|U0{0,6}|U000000[0-9a-fA-F]?)?)\Z")
_NAMED = np.arange(256, dtype=np.uint8)  # what a letter behind a backslash stands for
_NAMED[list(b"abfnrtv0")] = list(b"\a\b\f\n\r\t\v\0")
_DIGIT = np.zeros(256, dtype=np.uint8)
_DIGIT[list(b"0123456789abcdefABCDEF")] = [*range(16), *range(10, 16)]
_ESCAPE = re.compile(r"\\u[0-9a-fA-F]{4}|\\U[0-9a-fA-F]{8}|\\x[0-9a-fA-F]{2}")
_LINE = r"[^\n\r\u0100-\U0010ffff]"
_ESCAPED = re.compile(rf"(?<!{_LINE}){_LINE}*?(?:{_ESCAPE.pattern}){_LINE}*+")  # with the other characters of the line
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:\r?\n[\x20\t]*+[A-Za-z0-9+/_-]++)++={0,2}")
_BLANK = re.compile(r"[\r\n\t\x20=]+")
#: A secret has twelve ASCII characters at least, as have its encodings, so shorter stretches hold none.
_READABLE = re.compile(
    rb"(?:[\t-\r\x20-~]|[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}"
    rb"|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2}){12,}+"
)
_WIDE = re.compile(rb"(?:[\t-\r\x20-~]\x00){11,}+[\t-\r\x20-~]?")  # UTF-16 of either byte order
#: Beginnings of compressed data; of bzip2 with what opens its first block.
_COMPRESSED = re.compile(
    rb"\x1f\x8b\x08[\x00-\x1f]|\x78[\x01\x5e\x9c\xda]|BZh[1-9](?:1AY&SY|\x17rE8P\x90)|\xfd7zXZ\x00|\x28\xb5\x2f\xfd"
)

#: Bytes of unfolded data searched at a time; a layer of more is counted and searched in overlapping windows.
MAX_UNFOLDED = 16 << 20
_OVERLAP = 1 << 20
_RUN_END = re.compile(rb"(?<![A-Za-z0-9+/_=%\\\r\n\t\x20-])[A-Za-z0-9+/_=%\\\r\n\t\x20-]++\Z")
_LONG_RUN = re.compile(rb"(?<![A-Za-z0-9+/_\r\n\t\x20-])[A-Za-z0-9+/_\r\n\t\x20-]++\Z")
_NO_SYMBOL = re.compile(rb"[^A-Za-z0-9+/_\r\n\t\x20-]")
_PIECE = 1 << 20  # of unfolded bytes at a time
_INPUT = 1 << 16  # of compressed bytes at a time
_ZSTD_INPUT = 256  # its streams unfold to 128 KB for every four bytes at most, without a limit on output
_BROKEN = (zlib.error, OSError, EOFError, ValueError, lzma.LZMAError, zstandard.ZstdError)

Span = tuple[int, int, int]  # start, kind, end


@dataclass
class Stream:
    """Bytes that can be read again and again, and the stretch of the original they came from.

    ``cut`` is set when compressed data ended before their own end was reached; ``again``
    marks another reading of a stream met before, which is not counted anew.
    """

    pieces: Callable[[], Iterator[bytes]]
    at: tuple[int, int]
    cut: bool = False
    again: bool = False


@dataclass
class Layer:
    """A decoded text and, per code point, the stretch of the original it came from.

    Without arrays every code point stands for the whole stretch ``at``.
    """

    text: str
    at: tuple[int, int]
    starts: np.ndarray | None = None
    ends: np.ndarray | None = None

    def origin(self, start: int, end: int) -> tuple[int, int]:
        if self.starts is None:
            return self.at
        return int(self.starts[start]), int(self.ends[end - 1])


def find(text: str) -> Iterator[Span]:
    """Secrets that stand in the text as it is; leftmost, non-overlapping per kind."""
    for match in ASSIGN.finditer(text):
        if match.end(2) - match.start(2) >= ASSIGN_VALUE:
            yield match.start(), 0, match.end()
    for match in ACCESS.finditer(text):
        if match.end() - match.start() >= ACCESS_LENGTH:
            yield match.start(), 1, match.end()
    for match in HEX.finditer(text):
        yield match.start(), 2, match.end()


def _stretches(data: bytes) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """Maximal readable stretches, as UTF-8 and as UTF-16, with first and last byte of each code point."""
    for match in _READABLE.finditer(data):
        text = match.group().decode("utf-8")
        yield text, *_char_stretches(text, np.arange(match.start(), match.end(), dtype=np.int32))
    for match in _WIDE.finditer(data):
        at = np.arange(match.start(), match.end(), 2)
        yield match.group()[::2].decode("ascii"), at, at


def _runs(text: str) -> list[tuple[int, int]]:
    """Base64 runs; lines that are runs are also joined, whatever their widths, as foreign lines only shift the rest."""
    runs = [m.span() for m in _BASE64.finditer(text)]
    return runs + [m.span() for m in _WRAPPED.finditer(text) if len(_BLANK.sub("", m.group())) >= 16]


def _opened(head: bytes):
    """A decompressor for a stream that begins so, or None."""
    if head[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if len(head) > 2 and head[0] == 0x78 and (head[0] << 8 | head[1]) % 31 == 0:
        return zlib.decompressobj()
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if head[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    if head[:4] == b"\x28\xb5\x2f\xfd":
        return zstandard.ZstdDecompressor().decompressobj()
    return None


def _drained(stream, data: bytes) -> Iterator[bytes]:
    """What the stream gives for more input, in pieces; returns input beyond its end."""
    if hasattr(stream, "needs_input"):  # bzip2 and xz
        yield stream.decompress(data, _PIECE)
        while not stream.eof and not stream.needs_input:
            yield stream.decompress(b"", _PIECE)
        return stream.unused_data
    if isinstance(stream, type(zlib.decompressobj())):
        while True:
            out = stream.decompress(data, _PIECE)
            yield out
            data = stream.unconsumed_tail
            if stream.eof or not data and len(out) < _PIECE:
                return stream.unused_data
    for at in range(0, len(data), _ZSTD_INPUT):
        yield stream.decompress(data[at : at + _ZSTD_INPUT])
        if stream.eof:
            return stream.unused_data + data[at + _ZSTD_INPUT :]
    return b""


def _chunks(data: bytes, start: int) -> Iterator[bytes]:
    view = memoryview(data)
    for at in range(start, len(data), _INPUT):
        yield bytes(view[at : at + _INPUT])


def _skipped(pieces: Iterator[bytes], count: int) -> Iterator[bytes]:
    for piece in pieces:
        if count < len(piece):
            yield piece[count:]
        count = max(count - len(piece), 0)


def _unfold(stream: Stream, pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Contents of the compressed data at the start, one after another, up to what is broken or none."""
    held, opened = b"", None
    while True:
        if opened is None:
            while len(held) < 6 and (more := next(pieces, None)) is not None:
                held = (held + more).lstrip(b"\0")  # streams may be padded
            opened = _opened(held)
            if opened is None:
                return
        try:
            held = yield from _drained(opened, held)
        except _BROKEN:
            return
        if opened.eof:
            held, opened = held.lstrip(b"\0"), None
        else:
            held = next(pieces, None)
            if held is None:
                stream.cut = True
                return


def _from_base64(pieces: Iterator[bytes], skip: int) -> Iterator[bytes]:
    """Bytes of the run at the start without its first ``skip`` symbols; blanks in it do not count."""
    held = b""
    for piece in pieces:
        end = _NO_SYMBOL.search(piece)
        symbols = (piece[: end.start()] if end else piece).translate(_URL_SAFE, b"\r\n\t\x20")
        symbols, skip = symbols[skip:], max(skip - len(symbols), 0)
        held += symbols
        ready = len(held) - len(held) % 4
        yield base64.b64decode(held[:ready])
        held = held[ready:]
        if end:
            break
    if len(held) > 1:
        yield base64.b64decode(held + b"=" * (-len(held) % 4))


_URL_SAFE = bytes.maketrans(b"-_", b"+/")


def _from_escapes(pieces: Iterator[bytes], unit: re.Pattern, head: re.Pattern) -> Iterator[bytes]:
    """The bytes with every escape of the kind replaced by what it stands for."""
    held = b""
    for piece in pieces:
        held += piece
        tail = head.search(held[-12:])
        waits = len(tail.group(tail.lastindex or 0)) if tail else 0
        data, held = held[: len(held) - waits], held[len(held) - waits :]
        yield _byte_form(unit, data)[0]
    yield held


def _windows(pieces: Iterable[bytes], limit: int) -> Iterator[tuple[bytes, int]]:
    """The data in windows of about ``limit`` bytes, and how many bytes of each are new.

    A window begins in the one before by ``_OVERLAP``, or by as much as reaches back to the
    start of the encoded run that is cut, up to half a window.
    """
    held, old = bytearray(), 0
    for piece in pieces:
        held += piece
        if len(held) > limit:
            yield bytes(held), len(held) - old
            keep = min(_OVERLAP, limit // 2)
            back = bytes(held[-(limit // 2) :])
            run = _RUN_END.search(back)
            keep = max(keep, len(back) - run.start()) if run else keep
            held, old = held[-keep:], keep
    if len(held) > old:
        yield bytes(held), len(held) - old


def _byte_form(unit: re.Pattern, data: bytes) -> tuple[bytes, np.ndarray | None]:
    """The data with each escape as one byte, and which of its bytes stay or begin an escape (None: all)."""
    found = np.fromiter((m.start() << 4 | m.end() - m.start() for m in unit.finditer(data)), dtype=np.int64)
    if not len(found):
        return data, None
    start, width = found >> 4, (found & 15).astype(np.int64)
    octets = np.frombuffer(data, dtype=np.uint8)
    last = start + width - 1
    value = np.where(width == 2, _NAMED[octets[last]], _DIGIT[octets[last - 1]] << 4 | _DIGIT[octets[last]])
    stays = np.ones(len(octets), dtype=bool)
    for k in range(1, int(width.max())):
        stays[start[width > k] + k] = False
    octets = octets.copy()
    octets[start] = value
    return octets[stays].tobytes(), stays


def _places(stays: np.ndarray | None, wanted: list[int]) -> list[int]:
    """Where the wanted bytes of a byte form stood."""
    if stays is None:
        return wanted
    return np.searchsorted(np.cumsum(stays, dtype=np.int32), np.array(wanted) + 1).tolist()


def _char_stretches(text: str, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last byte of each code point, looked up in ``at``."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    widths = 1 + (points > 0x7F).astype(np.int32) + (points > 0x7FF) + (points > 0xFFFF)
    ends = np.cumsum(widths, dtype=np.int32)
    return at[ends - widths], at[ends - 1]


class Scanner:
    """Scans one text after another; ``limit`` bounds how much of a compressed layer is held."""

    def __init__(self, limit: int = MAX_UNFOLDED) -> None:
        self.limit = limit

    def scan(self, text: str) -> tuple[list[Span], list[Span], int, int]:
        """Base spans, all spans, number of layers unwrapped, number of more than ``limit`` bytes."""
        base = sorted(find(text))
        spans = set(base)
        self._too_large = 0
        self._seen: set[bytes] = set()
        work: list[Iterator[Layer | Stream]] = [self._unwrap(Layer(text, (0, len(text))), True)]
        entered = 0
        while work:  # depth first, so few layers are held
            layer = next(work[-1], None)
            if layer is None:
                work.pop()
                continue
            if isinstance(layer, Stream):
                work.append(self._search(layer))
                continue
            place = layer.at if layer.starts is None else (int(layer.starts[0]), int(layer.ends[-1]))
            mark = hashlib.sha256(f"{place}".encode())
            mark.update(layer.text.encode())
            if not self._is_new(mark.digest()):
                continue
            entered += 1
            for start, kind, end in find(layer.text):
                first, last = layer.origin(start, end)
                spans.add((first, kind, last))
            work.append(self._unwrap(layer, False))
        return base, sorted(spans), entered, self._too_large

    def _is_new(self, mark: bytes) -> bool:
        new = mark not in self._seen
        self._seen.add(mark)
        return new

    def _unwrap(self, outer: Layer, original: bool) -> Iterator[Layer | Stream]:
        runs = _runs(outer.text)
        if original:  # places in the original are its own; arrays only if something is encoded
            if "%" not in outer.text and "\\" not in outer.text and not runs:
                return
            places = np.arange(len(outer.text) + 1, dtype=np.int32)
            outer = Layer(outer.text, outer.at, places[:-1], places[1:])
        if _PERCENT.search(outer.text):
            yield from self._percent(outer)
        if _ESCAPE.search(outer.text):
            yield from self._escapes(outer)
        yield from self._base64(outer, runs)

    def _search(self, stream: Stream) -> Iterator[Layer | Stream]:
        """Texts in the bytes of a stream, and streams of compressed data in them.

        Up to ``limit`` bytes are searched as a whole. Of more, each window is; what may
        reach over a window's end is then read again from its start as a stream of its own:
        compressed data that were cut, base64 runs longer than half a window, and, if there
        are escapes, all bytes with these decoded. Content met before at its place is not
        entered again.
        """
        place, whole, size = stream.at, hashlib.sha256(f"{stream.at}:".encode()), 0
        again: list[Callable[[], Iterator[bytes]]] = []
        cut: list[int] = []
        run = None  # where the base64 run begins that is cut by the last window
        quoted = escaped = False
        for window, new in _windows(stream.pieces(), self.limit):
            begins = size + new - len(window)
            whole.update(memoryview(window)[-new:])
            size += new
            large = size > self.limit
            self._too_large += large and size - new <= self.limit and not stream.again
            if not large and not self._is_new(whole.digest()):
                return
            if len(window) >= 12:  # else no room for a secret
                yield Layer(window.decode("utf-8", "replace"), place)
                for wide in _WIDE.finditer(window):
                    yield Layer(wide.group()[::2].decode("ascii"), place)
            for found in _COMPRESSED.finditer(window):
                start = found.start()
                inner = Stream(lambda: iter(()), place)
                inner.pieces = lambda inner=inner, data=window, start=start: _unfold(inner, _chunks(data, start))
                yield inner
                if inner.cut and large:
                    cut.append(begins + start)
            if large:
                quoted = quoted or bool(_QUOTED_BYTE.search(window))
                escaped = escaped or bool(_ESCAPED_BYTE.search(window))
                tail = _LONG_RUN.search(window)
                if tail is None:
                    run = None
                elif len(window) - tail.start() > self.limit // 2 and (run is None or tail.start()):
                    run = begins + tail.start()
                    again += [partial(_from_base64_at, stream.pieces, run, skip) for skip in range(4)]
        if size <= self.limit or not self._is_new(whole.digest()):
            return
        for start in dict.fromkeys(cut):
            inner = Stream(lambda: iter(()), place, again=True)
            inner.pieces = lambda inner=inner, start=start: _unfold(inner, _skipped(stream.pieces(), start))
            yield inner
        if quoted:
            again.append(lambda: _from_escapes(stream.pieces(), _QUOTED_BYTE, _QUOTED_HEAD))
            again.append(lambda: _from_escapes((p.replace(b"+", b" ") for p in stream.pieces()), _QUOTED_BYTE, _QUOTED_HEAD))
        if escaped:
            again.append(lambda: _from_escapes(stream.pieces(), _ESCAPED_BYTE, _ESCAPED_HEAD))
        for pieces in again:
            yield Stream(pieces, place, again=True)

    def _replaced(self, outer: Layer, parts: list[tuple[int, int, str, np.ndarray, np.ndarray]]) -> Layer:
        """The text with stretches replaced; a part's arrays count code points of ``outer``."""
        text: list[str] = []
        starts: list[np.ndarray] = []
        ends: list[np.ndarray] = []
        mapped = outer.starts is not None
        done = 0
        for first, last, new, new_starts, new_ends in [*parts, (len(outer.text), 0, "", None, None)]:
            text.append(outer.text[done:first])
            text.append(new)
            if mapped:
                starts.append(outer.starts[done:first])
                ends.append(outer.ends[done:first])
                if new:
                    starts.append(outer.starts[new_starts])
                    ends.append(outer.ends[new_ends])
            done = last
        joined = "".join(text)
        if not mapped:
            return Layer(joined, outer.at)
        return Layer(joined, outer.at, np.concatenate(starts), np.concatenate(ends))

    def _percent(self, outer: Layer) -> Iterator[Layer]:
        parts = []
        yield from self._compressed_form(outer, _QUOTED, _QUOTED_BYTE)
        for match in _PERCENT.finditer(outer.text):
            data = binascii.unhexlify(match.group().replace("%", ""))
            for wide in _WIDE.finditer(data):
                at = match.start() + 3 * np.arange(wide.start(), wide.end(), 2)
                if outer.starts is None:
                    yield Layer(wide.group()[::2].decode("ascii"), outer.at)
                else:
                    yield Layer(wide.group()[::2].decode("ascii"), outer.at, outer.starts[at], outer.ends[at + 2])
            try:
                new = data.decode("utf-8")
            except UnicodeDecodeError:
                new = data.decode("latin-1")
                firsts = lasts = np.arange(len(data))
            else:
                firsts, lasts = _char_stretches(new, np.arange(len(data)))
            parts.append((match.start(), match.end(), new, match.start() + 3 * firsts, match.start() + 3 * lasts + 2))
        if parts:
            yield self._replaced(outer, parts)

    def _escapes(self, outer: Layer) -> Iterator[Layer]:
        yield from self._compressed_form(outer, _ESCAPED, _ESCAPED_BYTE)
        units: list[tuple[int, int, int]] = []
        for match in _ESCAPE.finditer(outer.text):
            code = int(match.group()[2:], 16)
            previous = units[-1] if units else None
            if (
                previous
                and previous[1] == match.start()
                and 0xD800 <= previous[2] < 0xDC00 <= code < 0xE000
            ):
                units[-1] = (previous[0], match.end(), 0x10000 + (previous[2] - 0xD800 << 10) + code - 0xDC00)
            else:
                units.append((match.start(), match.end(), code))
        parts = [
            (first, last, chr(code), np.array([first]), np.array([last - 1]))
            for first, last, code in units
            if code < 0x110000 and not 0xD800 <= code < 0xE000
        ]
        if parts:
            yield self._replaced(outer, parts)

    def _base64(self, outer: Layer, runs: list[tuple[int, int]]) -> Iterator[Layer | Stream]:
        for first, last in runs:
            run = outer.text[first:last].rstrip("=")
            octets = np.frombuffer(run.encode(), dtype=np.uint8)
            places = first + np.flatnonzero(_IS_SYMBOL[octets]).astype(np.int32)
            symbols = octets[_IS_SYMBOL[octets]].tobytes().translate(_URL_SAFE)
            for skip in range(4):  # foreign symbols before or after the encoded part only add unreadable bytes
                size = len(symbols) - skip
                size -= size % 4 == 1
                if size < 16:
                    break
                data = base64.b64decode(symbols[skip : skip + size] + b"=" * (-size % 4))
                at = places[skip:]
                for match in _COMPRESSED.finditer(data):
                    yield self._compressed(outer, data, match.start(), int(at[match.start() * 8 // 6]), last)
                for new, low, high in _stretches(data):
                    if outer.starts is None:
                        yield Layer(new, outer.at)
                        continue
                    low, high = at[low * 8 // 6], at[(high * 8 + 7) // 6]  # a byte has eight bits, a symbol six
                    yield Layer(new, outer.at, outer.starts[low], outer.ends[high])

    def _compressed(self, outer: Layer, data: bytes, start: int, first: int, last: int) -> Stream:
        """What the compressed data at ``start`` unfold to."""
        stream = Stream(lambda: iter(()), outer.origin(first, last))
        stream.pieces = lambda: _unfold(stream, _chunks(data, start))
        return stream

    def _compressed_form(self, outer: Layer, stretches: re.Pattern, unit: re.Pattern) -> Iterator[Stream]:
        """Compressed data in the byte form of stretches with escapes."""
        for match in stretches.finditer(outer.text):
            text = match.group()
            for version in {text, text.replace("+", " ")} if stretches is _QUOTED else {text}:
                data, stays = _byte_form(unit, version.encode("latin-1"))
                found = [m.start() for m in _COMPRESSED.finditer(data)]
                for start, place in zip(found, _places(stays, found), strict=True) if found else ():
                    yield self._compressed(outer, data, start, match.start() + place, match.end())


_IS_SYMBOL = np.ones(256, dtype=bool)
_IS_SYMBOL[list(b"\r\n\t\x20=")] = False


def _from_base64_at(pieces: Callable[[], Iterator[bytes]], start: int, skip: int) -> Iterator[bytes]:
    return _from_base64(_skipped(pieces(), start), skip)


_SPAN = "array<struct<kind:string,start:bigint,end:bigint>>"


def _structs(found: list[list[Span]]) -> pa.Array:
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    rows = [[(KINDS[k], s, e) for s, k, e in spans] for spans in found]
    return pa.array([[{"kind": a, "start": b, "end": c} for a, b, c in r] for r in rows], pa.list_(kind))


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = MAX_UNFOLDED
) -> DataFrame:
    """Per row: ``doc_id``, ``base`` and ``spans`` (structs of kind, start, end), ``n_layers``, ``n_too_large``.

    Places are code points of the original text, the end exclusive, ordered by start and
    then kind. A null text counts as empty: no spans. Null and repeated ids are kept, one
    row each; an empty table gives an empty result; other columns are not read.
    """

    def make():
        scanner = Scanner(limit)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [scanner.scan(t or "") for t in batch.column(1).to_pylist()]
            columns = [
                batch.column(0),
                _structs([f[0] for f in found]),
                _structs([f[1] for f in found]),
                pa.array([f[2] for f in found], pa.int64()),
                pa.array([f[3] for f in found], pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "base", "spans", "n_layers", "n_too_large"])

        return step

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = f"doc_id bigint, base {_SPAN}, spans {_SPAN}, n_layers bigint, n_too_large bigint"
    return map_batches(rows, schema, make)


def redact_secrets(
    docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", limit: int = MAX_UNFOLDED
) -> DataFrame:
    """The same rows and columns with every span of the text replaced by ``mark``.

    Overlapping spans are replaced together. A null text stays null, an empty one empty.
    Rows repeated in full stay and are changed alike, null ids do not matter, and an empty
    table stays empty.
    """
    place = docs.columns.index(text_col)

    def make():
        scanner = Scanner(limit)

        def clean(text: str | None) -> str | None:
            if not text:
                return text
            out, done = [], 0
            for start, _, end in scanner.scan(text)[1]:
                if start >= done:
                    out += [text[done:start], mark]
                done = max(done, end)
            return "".join([*out, text[done:]]) if out else text

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = pa.array([clean(t) for t in batch.column(place).to_pylist()], pa.string())
            columns = [texts if i == place else c for i, c in enumerate(batch.columns)]
            return pa.RecordBatch.from_arrays(columns, batch.schema.names)

        return step

    return map_batches(docs, docs.schema, make)


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns of ``find_secrets``."""

    def joined(column: str):
        one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        return F.concat_ws(",", F.transform(column, one))

    def number(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[number(k) for k in KINDS],
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
        "n_layers",
        "n_too_large",
    )
