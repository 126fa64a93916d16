"""Secrets in texts and in the encoded layers inside them."""

from __future__ import annotations

import base64
import binascii
import bz2
import codecs
import hashlib
import lzma
import re
import zlib
from collections import deque
from collections.abc import Generator, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Kinds in their order, patterns and least lengths.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST = 12

KEYWORDS = ("pass", "secret", "token", "api")
CONTROL = re.compile(r"[\x00-\x08\x0e-\x1f\x7f-\x9f]")
ESCAPE = re.compile(
    r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})"
    r"|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});"
)
PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
LETTERS = re.compile(r"[A-Za-z0-9+/_-]+")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
WRAPPED = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:\r?\n[\x20\t]*[A-Za-z0-9+/_-]+)+={0,2}")
#: A layer is opened at once up to this many bytes; larger ones are read in windows of so
#: many characters, which begin at a line or else share OVERLAP with the one before.
MAX_LAYER, OVERLAP = 1 << 24, 1 << 20
#: Bytes that a decompressor hands out at a time, about, and that zstd is fed at a time.
STEP, FEED = 1 << 20, 256


def matches(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the secrets that stand in the text itself.

    Runs of the access and hex patterns end where their letters end, so asking for the
    least length in the pattern finds what dropping short runs would leave.
    """
    found = [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    lowered = text.lower()
    if any(word in lowered for word in KEYWORDS):
        found += [
            (m.start(), 0, m.end())
            for m in ASSIGN.finditer(text)
            if len(m.group(1)) >= ASSIGN_LEAST
        ]
    return sorted(found)


class Layer:
    """A text and, for each of its characters, the span of the original it comes from."""

    def __init__(self, text: str, starts: np.ndarray | None = None, ends: np.ndarray | None = None):
        self.text, self.starts, self.ends = text, starts, ends

    def source(self, start: int, end: int) -> tuple[int, int]:
        if self.starts is None:
            return start, end
        return int(self.starts[start:end].min()), int(self.ends[start:end].max())

    def place(self) -> bytes:
        """Digest of the spans that the characters come from."""
        arrays = [np.ascontiguousarray(a, np.int64) for a in (self.starts, self.ends)]
        return hashlib.sha256(b"".join(a.tobytes() for a in arrays)).digest()

    def replaced(self, parts: list[tuple[int, int, str]]) -> Layer:
        """This layer with parts (start, end, new text) replaced."""
        texts, starts, ends, at = [], [], [], 0

        def copy(until: int) -> None:
            texts.append(self.text[at:until])
            span = np.arange(at, until)
            starts.append(span if self.starts is None else self.starts[at:until])
            ends.append(span + 1 if self.ends is None else self.ends[at:until])

        for start, end, new in parts:
            copy(start)
            low, high = self.source(start, end)
            texts.append(new)
            starts.append(np.full(len(new), low))
            ends.append(np.full(len(new), high))
            at = end
        copy(len(self.text))
        return Layer("".join(texts), np.concatenate(starts), np.concatenate(ends))


MAGIC = {"gzip": b"\x1f\x8b", "zstd": b"\x28\xb5\x2f\xfd", "bz2": b"BZh", "xz": b"\xfd7zXZ\x00"}
ERRORS = (zlib.error, OSError, EOFError, lzma.LZMAError, zstandard.ZstdError)


def _format(data: bytes) -> str | None:
    """Compression of the data by its magic number; None if it is no known format."""
    for name, magic in MAGIC.items():
        if data.startswith(magic):
            return name
    zlib_head = len(data) > 2 and data[0] == 0x78 and int.from_bytes(data[:2]) % 31 == 0
    return "zlib" if zlib_head else None


def _member(data: bytes, name: str) -> Generator[bytes, None, bytes]:
    """The content of the first member, in steps; returns what follows the member."""
    if name == "zstd":
        reader = zstandard.ZstdDecompressor(max_window_size=1 << 27).decompressobj()
        for at in range(0, len(data), FEED):
            yield reader.decompress(data[at : at + FEED])
            if reader.eof:
                return reader.unused_data + data[at + FEED :]
        return b""
    if name in ("gzip", "zlib"):
        reader = zlib.decompressobj(47)
    else:
        reader = bz2.BZ2Decompressor() if name == "bz2" else lzma.LZMADecompressor(memlimit=1 << 28)
    left = data
    while not reader.eof:
        out = reader.decompress(left, STEP)
        left = reader.unconsumed_tail if name in ("gzip", "zlib") else b""
        if not out and not left and not reader.eof:
            break
        yield out
    return reader.unused_data


def _inflated(data: bytes, name: str) -> Iterator[bytes]:
    """The content of all members, in steps. Only a broken first member is an error."""
    data = yield from _member(data, name)
    while name != "zlib" and (data := data.lstrip(b"\0")).startswith(MAGIC[name]):
        try:
            data = yield from _member(data, name)
        except ERRORS:
            break


class _Windows:
    """A layer over MAX_LAYER: windows of its text, which all stand for one span."""

    def __init__(self, data: bytes, name: str, low: int, high: int):
        self.data, self.name, self.low, self.high = data, name, low, high

    def __iter__(self) -> Iterator[Layer]:
        decoder, text = codecs.getincrementaldecoder("utf-8")(), ""
        parts, size = [], 0
        for piece in _inflated(self.data, self.name):
            parts.append(decoder.decode(piece))
            size += len(parts[-1])
            if size >= MAX_LAYER:
                text = "".join(parts)
                yield _whole(text, self.low, self.high)
                # Matches end at the end of a line, so nothing is cut off by starting there.
                text = text[max(text.rfind("\n", 0, len(text) - OVERLAP), len(text) - 2 * OVERLAP, 0) :]
                parts, size = [text], len(text)
        yield _whole("".join(parts), self.low, self.high)


def _readable(data: bytes) -> str | None:
    """The bytes as text, if they are UTF-8 with next to no control characters."""
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return None
    odd = sum(1 for c in text if c < " " and c not in "\t\n\r\x0b\x0c" or "\x7f" <= c < "\xa0")
    return text if text and odd * 20 <= len(text) else None


def _whole(text: str, low: int, high: int) -> Layer:
    """A layer whose characters all come from one span."""
    return Layer(text, *(np.broadcast_to(np.int64(at), len(text)) for at in (low, high)))


def _unpacked(data: bytes, low: int, high: int) -> tuple[Layer | _Windows | None, bool]:
    """The layer in compressed bytes, if it is readable, and whether they were compressed."""
    if (name := _format(data)) is None:
        return None, False
    decoder, held, size, length, odd = codecs.getincrementaldecoder("utf-8")(), [], 0, 0, 0
    try:
        for piece in _inflated(data, name):
            size += len(piece)
            if decoder:
                try:
                    text = decoder.decode(piece)
                except UnicodeDecodeError:
                    decoder, held = None, []
                    continue
                length, odd = length + len(text), odd + len(CONTROL.findall(text))
                held = [*held, text] if size <= MAX_LAYER else []
    except ERRORS:
        return None, False
    if not decoder or decoder.getstate()[0] or not length or odd * 20 > length:
        return None, True
    if size > MAX_LAYER:
        return _Windows(data, name, low, high), True
    return _whole("".join(held), low, high), True


def _percent(layer: Layer) -> Iterator[Layer | _Windows]:
    parts = []
    for m in PERCENT.finditer(layer.text):
        data = bytes.fromhex(m.group().replace("%", ""))
        inner, packed = _unpacked(data, *layer.source(m.start(), m.end()))
        if inner:
            yield inner
        elif not packed:
            at = m.start()
            for char in data.decode("utf-8", "surrogateescape"):
                end = at + 3 * len(char.encode("utf-8", "surrogateescape"))
                if not "\udc80" <= char <= "\udcff":
                    parts.append((at, end, char))
                at = end
    if parts:
        yield layer.replaced(parts)


def _escapes(layer: Layer) -> Iterator[Layer]:
    parts = []
    for m in ESCAPE.finditer(layer.text):
        number = int(m.group(m.lastindex), 10 if m.lastindex == 6 else 16)
        pair = parts and parts[-1][1] == m.start() and "\ud800" <= parts[-1][2] < "\udc00"
        if pair and 0xDC00 <= number < 0xE000:
            high = ord(parts[-1][2])
            joined = chr(0x10000 + ((high - 0xD800) << 10) + number - 0xDC00)
            parts[-1] = (parts[-1][0], m.end(), joined)
        elif number < 0x110000:
            parts.append((m.start(), m.end(), chr(number)))
    parts = [p for p in parts if not "\ud800" <= p[2] < "\ue000"]
    if parts:
        yield layer.replaced(parts)


def _runs(text: str) -> Iterator[tuple[str, np.ndarray | None, int, int]]:
    """Runs of base64 letters: letters, their places if not consecutive, start and end.

    Lines of letters that follow each other are also taken as one run: all of them, and
    each group of equally long lines with the shorter one that ends it.
    """
    for m in BASE64.finditer(text):
        yield m.group().rstrip("="), None, m.start(), m.end()
    for m in WRAPPED.finditer(text) if "\n" in text else ():
        lines = [(m.start() + k.start(), m.start() + k.end()) for k in LETTERS.finditer(m.group())]
        groups, at = {(0, len(lines))}, 0
        while at < len(lines):
            width, end = lines[at][1] - lines[at][0], at + 1
            while end < len(lines) and lines[end][1] - lines[end][0] == width:
                end += 1
            if end < len(lines) and lines[end][1] - lines[end][0] < width:
                groups.add((at, end + 1))
            groups.add((at, end))
            at = end
        for low, high in sorted(groups):
            if high - low > 1:
                places = np.concatenate([np.arange(*line) for line in lines[low:high]])
                run = "".join(text[x:y] for x, y in lines[low:high])
                yield run, places, lines[low][0], lines[high - 1][1]


def _base64(layer: Layer) -> Iterator[Layer | _Windows]:
    for run, places, begin, end in _runs(layer.text):
        if len(run) % 4 == 1:
            continue
        plain = run.replace("-", "+").replace("_", "/")
        try:
            data = base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
        except (binascii.Error, ValueError):
            continue
        inner, packed = _unpacked(data, *layer.source(begin, end))
        if inner:
            yield inner
        if packed or not (text := _readable(data)):
            continue
        sizes = np.array([len(c.encode()) for c in text])
        last = np.cumsum(sizes)
        first, final = (last - sizes) * 8 // 6, np.minimum(-(-last * 8 // 6), len(run)) - 1
        if places is None:
            first, final = begin + first, begin + final
        else:
            first, final = places[first], places[final]
        if layer.starts is None:
            yield Layer(text, first, final + 1)
        else:
            yield Layer(text, layer.starts[first], layer.ends[final])


def _opened(layer: Layer) -> Iterator[Layer | _Windows]:
    if "%" in layer.text:
        yield from _percent(layer)
    if "\\" in layer.text or "&#" in layer.text:
        yield from _escapes(layer)
    yield from _base64(layer)


def _key(text: str) -> str | bytes:
    """A short text itself, or the digest of a long one."""
    return text if len(text) < 64 else hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()


def scan(text: str | None) -> tuple[list, list, int, int]:
    """Base matches, all matches in spans of the text, layers opened, layers too large.

    The worklist starts with the text. Each layer is scanned and searched for URL,
    Unicode, base64 and compressed parts, which become new layers, until none is new;
    a content is opened once for each place of the text that it stands for, which ends
    cycles and keeps the spans of repeated parts. `layers` counts different contents.
    """
    base = matches(text or "")
    spans, known, seen = set(base), {_key(text or ""): base}, set()
    work, large = deque([Layer(text or "")]), 0
    while work:
        opened = work.popleft()
        if isinstance(opened, Layer):
            inners = _opened(opened)
        else:
            # Two windows are held at most; the others wait behind them.
            inners = list(islice(opened, 1))
            work.extend([opened] if inners else [])
        for inner in inners:
            if isinstance(inner, _Windows):
                place = (hashlib.sha256(inner.data).digest(), inner.low, inner.high)
                if place not in seen:
                    seen.add(place)
                    large += 1
                    work.append(iter(inner))
                continue
            key = _key(inner.text)
            if (key, inner.place()) in seen:
                continue
            seen.add((key, inner.place()))
            if key not in known:
                known[key] = matches(inner.text)
            for start, kind, end in known[key]:
                low, high = inner.source(start, end)
                spans.add((low, kind, high))
            work.append(inner)
    return base, sorted(spans), len(known) - 1, large


def joined(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in found)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Secrets per document: base counts and digest, and spans from all decoded layers.

    Spans are code points of the original text, end exclusive; a match in a decoded layer
    gets the span of the original that its characters come from. Every whole text is
    read. Documents are handled one by one, without a shuffle. A null text is empty. Rows
    may repeat; other columns are ignored; an empty table gives no rows. Layers
    larger than MAX_LAYER bytes are read in windows and counted in `n_too_large`.

    Returns doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_layers, n_too_large.
    """
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(1):
                base, spans, layers, large = scan(value.as_py())
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                counts = [sum(1 for m in base if m[1] == k) for k in range(3)]
                rows.append((*counts, digest, joined(spans), layers, large))
            kinds = [*[pa.int64()] * 3, pa.string(), pa.string(), pa.int64(), pa.int64()]
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            names = "doc_id n_assign n_access n_hex base_sha256 spans n_layers n_too_large"
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names.split())

    return narrow.mapInArrow(
        run,
        f"doc_id {dict(narrow.dtypes)['doc_id']}, n_assign bigint, n_access bigint, n_hex bigint, "
        "base_sha256 string, spans string, n_layers bigint, n_too_large bigint",
    )
