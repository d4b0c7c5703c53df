"""Media columns by signature sniffing.

One Aho-Corasick automaton finds the magic bytes of all known formats in a value; a format's validator then confirms
structure and lengths, whatever variant of the format it is. A valid medium at the start gives the value's true type,
whatever was declared; valid media further in are carved out. Reading samples back is a step of its own, which only
knows the variants that are written here: 8-bit mono sound and 8-bit grey pictures.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yardlake.session import ship

from .common import struct_of, text_column

RATE = 8000
ROW = 64
#: Sample codes of WAV; header sizes, bits and uncompressed codes of BMP; channels and bits of PNG's colour types. Fixed values.
PCM, FLOAT = 1, 3
BMP_HEADS, BMP_BITS, BMP_PLAIN = (40, 52, 56, 64, 108, 124), (1, 4, 8, 16, 24, 32), (0, 3, 6)
PNG_COLOURS = {0: (1, (1, 2, 4, 8, 16)), 2: (3, (8, 16)), 3: (1, (1, 2, 4, 8)), 4: (2, (8, 16)), 6: (4, (8, 16))}
#: First column and row, and steps, of PNG's seven interlaced passes. Fixed values.
PNG_PASSES = [(0, 0, 8, 8), (4, 0, 8, 8), (0, 4, 4, 8), (2, 0, 4, 4), (0, 2, 2, 4), (1, 0, 2, 2), (0, 1, 1, 2)]
#: Bytes that are inflated at once to count them.
PIECE = 1 << 16


@dataclass(frozen=True)
class Medium:
    kind: str
    start: int
    length: int
    samples: Callable[[], bytes | None]  # 8-bit samples, in order; None: the medium holds others


def make_wav(payload: bytes) -> bytes:
    """8-bit mono PCM."""
    odd = len(payload) & 1
    body = b"WAVE" + struct.pack("<4sIHHIIHH", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8) + struct.pack("<4sI", b"data", len(payload)) + payload + b"\0" * odd
    return struct.pack("<4sI", b"RIFF", len(body)) + body


def check_wav(data: bytes, at: int) -> Medium | None:
    """RIFF chunks up to the declared end, a format chunk before the data, and whole frames in it."""
    if data[at + 8 : at + 12] != b"WAVE" or len(data) < at + 12:
        return None
    end = at + 8 + struct.unpack_from("<I", data, at + 4)[0]
    if end > len(data):
        return None
    pos, form, body = at + 12, None, None
    while pos + 8 <= end:
        name, size = struct.unpack_from("<4sI", data, pos)
        if pos + 8 + size > end:
            return None
        if name == b"fmt " and size >= 16:
            form = struct.unpack_from("<HHIIHH", data, pos + 8)
        if name == b"data":
            body = slice(pos + 8, pos + 8 + size)
        pos += 8 + size + (size & 1)
    if form is None or body is None or pos != end:
        return None
    code, channels, rate, per_second, frame, bits = form
    plain = code in (PCM, FLOAT)
    if not channels or not frame or (plain and (frame != channels * bits // 8 or per_second != rate * frame or (body.stop - body.start) % frame)):
        return None
    return Medium("wav", at, end - at, lambda: data[body] if code == PCM and channels == 1 and bits == 8 else None)


def make_bmp(payload: bytes) -> bytes:
    """8-bit grey, ROW pixels a row, top row first."""
    palette = b"".join(bytes((i, i, i, 0)) for i in range(256))
    rows, at = len(payload) // ROW, 54 + len(palette)
    head = struct.pack("<2sIHHI", b"BM", at + len(payload), 0, 0, at) + struct.pack("<IiiHHIIiiII", 40, ROW, -rows, 1, 8, 0, len(payload), 0, 0, 256, 0)
    return head + palette + payload


def check_bmp(data: bytes, at: int) -> Medium | None:
    """Header, palette and pixels lie within the declared size; uncompressed pixels fill the rows that the header tells."""
    if len(data) < at + 54:
        return None
    size, _, _, first = struct.unpack_from("<IHHI", data, at + 2)
    head, width, height, planes, bits, packed, given, _, _, colours = struct.unpack_from("<IiiHHIIiiI", data, at + 14)
    if head not in BMP_HEADS or planes != 1 or bits not in BMP_BITS or width <= 0 or not height or at + size > len(data):
        return None
    palette = 4 * (colours or 1 << bits) if bits <= 8 else 0
    stride = (width * bits + 31) // 32 * 4
    pixels = stride * abs(height) if packed in BMP_PLAIN else given
    if first < 14 + head + palette or not pixels or not first + pixels <= size <= first + pixels + 3:
        return None

    def samples() -> bytes | None:
        if bits != 8 or packed:
            return None
        rows = [data[at + first + i * stride :][:width] for i in range(abs(height))] if stride != width else [data[at + first : at + first + pixels]]
        if height > 0:
            rows = [data[at + first + i * stride :][:width] for i in reversed(range(height))]
        return b"".join(rows)

    return Medium("bmp", at, size, samples)


PNG_MAGIC = b"\x89PNG\r\n\x1a\n"


def make_png(payload: bytes) -> bytes:
    """8-bit grey, ROW pixels a row, no filters."""
    chunk = lambda name, body: struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))
    rows = len(payload) // ROW
    lines = np.zeros((rows, ROW + 1), np.uint8)
    lines[:, 1:] = np.frombuffer(payload, np.uint8).reshape(rows, ROW)
    return PNG_MAGIC + chunk(b"IHDR", struct.pack(">IIBBBBB", ROW, rows, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines.tobytes(), 1)) + chunk(b"IEND", b"")


def png_bytes(width: int, height: int, bits: int, interlaced: bool) -> int:
    """Bytes of the filtered rows, the byte that names a row's filter included. bits: of a pixel."""
    rows = lambda w, h: h * (1 + (w * bits + 7) // 8) if w > 0 else 0
    if not interlaced:
        return rows(width, height)
    return sum(rows((width - x + dx - 1) // dx, (height - y + dy - 1) // dy) for x, y, dx, dy in PNG_PASSES)


def inflated(packed: list[bytes], want: int, keep: bool) -> bytes | bool:
    """Whether a stream holds exactly `want` bytes, or these bytes. It is inflated a PIECE at a time and no further than
    one byte too many, so that a small stream of a large content costs no memory."""
    stream, size, out = zlib.decompressobj(), 0, []
    try:
        for part in (x[i : i + PIECE] for x in packed for i in range(0, len(x), PIECE)):
            got = bytes(PIECE)
            while part or len(got) == PIECE:  # a full piece may have more behind it
                got = stream.decompress(part, PIECE)
                part, size = stream.unconsumed_tail, size + len(got)
                if size > want:
                    return False
                if keep:
                    out.append(got)
                if stream.eof:
                    break
    except zlib.error:
        return False
    if not stream.eof or size != want:
        return False
    return b"".join(out) if keep else True


def check_png(data: bytes, at: int) -> Medium | None:
    """Chunks with right checksums from IHDR to IEND, and as many bytes of pixels as the header tells."""
    pos, form, packed = at + 8, None, []
    while pos + 12 <= len(data):
        size, name = struct.unpack_from(">I4s", data, pos)
        if pos + 12 + size > len(data):
            return None
        body = data[pos + 8 : pos + 8 + size]
        if zlib.crc32(name + body) != struct.unpack_from(">I", data, pos + 8 + size)[0] or (form is None) != (name == b"IHDR"):
            return None
        pos += 12 + size
        if name == b"IHDR":
            if size != 13:
                return None
            width, height, depth, colour, method, filters, interlaced = form = struct.unpack(">IIBBBBB", body)
            channels, depths = PNG_COLOURS.get(colour, (0, ()))
            if not width or not height or depth not in depths or method or filters or interlaced > 1:
                return None
        elif name == b"IDAT":
            packed.append(body)
        elif name == b"IEND":
            want = png_bytes(width, height, depth * channels, bool(interlaced))
            if not inflated(packed, want, keep=False):
                return None

            def samples() -> bytes | None:
                if (depth, colour, interlaced) != (8, 0, 0):
                    return None
                rows = np.frombuffer(inflated(packed, want, keep=True), np.uint8).reshape(height, width + 1)
                return None if rows[:, 0].any() else rows[:, 1:].tobytes()

            return Medium("png", at, pos - at, samples)
    return None


#: Magic bytes of each format, what checks it, and what makes it.
FORMATS: dict[str, tuple[bytes, Callable[[bytes, int], Medium | None], Callable[[bytes], bytes]]] = {
    "wav": (b"RIFF", check_wav, make_wav),
    "bmp": (b"BM", check_bmp, make_bmp),
    "png": (PNG_MAGIC, check_png, make_png),
}


class Sniffer:
    def __init__(self) -> None:
        self.words = ahocorasick.Automaton()
        for kind, (magic, _, _) in FORMATS.items():
            self.words.add_word(magic.decode("latin-1"), (kind, len(magic)))
        self.words.make_automaton()

    def media(self, data: bytes) -> Iterator[Medium]:
        """Valid media in order; what lies inside one that was found is its content and not searched on its own."""
        past = 0
        for last, (kind, size) in self.words.iter(data.decode("latin-1")):
            at = last + 1 - size
            if at >= past and (found := FORMATS[kind][1](data, at)):
                yield found
                past = at + found.length


def describe(data: bytes, declared: str | None, sniffer: Sniffer) -> dict:
    """true_type (null: none was confirmed at the start), corrected, carved: (kind, start, length) of media further in."""
    found = list(sniffer.media(data))
    first = found[0] if found and found[0].start == 0 else None
    kind = first.kind if first else None
    rest = found[1:] if first else found
    return {"true_type": kind, "corrected": kind is not None and kind != declared, "carved": [{"kind": m.kind, "start": m.start, "length": m.length} for m in rest], "first": first}


SNIFFED = "true_type string, corrected boolean, carved array<struct<kind string, start long, length long>>"


def sniff(df: DataFrame, data: str, declared: str, into: str = "media") -> DataFrame:
    """df with a struct column (SNIFFED) for a binary column and a column of declared types.

    A null or empty value has no type. A null declared type counts as wrong wherever a type is confirmed.
    """
    ship(df.sparkSession)

    @F.arrow_udf(SNIFFED)
    def run(data: pa.Array, declared: pa.Array) -> pa.Array:
        sniffer = Sniffer()
        rows = [describe(d or b"", t, sniffer) for d, t in zip(data.to_pylist(), declared.to_pylist(), strict=True)]
        kind = pa.struct([("true_type", pa.string()), ("corrected", pa.bool_()), ("carved", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("length", pa.int64())])))])
        return pa.array([{k: r[k] for k in ("true_type", "corrected", "carved")} for r in rows], kind)

    return df.withColumn(into, run(F.col(data), F.col(declared)))


def padded(text: str | None) -> tuple[bytes, int]:
    raw = (text or "").encode("utf-8", "replace")
    size = max(ROW, -(-len(raw) // ROW) * ROW)
    return raw.ljust(size, b"\0"), len(raw)


STORED = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def store_and_read(df: DataFrame, text: str = "text", into: str = "media") -> DataFrame:
    """df with a struct column (STORED): each text is stored as a medium, its format chosen by the payload's crc32, under
    the declared type `wav`; the stored bytes are sniffed and read back. feature: the confirmed type, whether the
    declared type was wrong, media carved from within the payload, mean and spread of the samples. Null and empty texts are one row of
    zeros; equal texts are stored alike, long ones whole; an empty df gives no rows, and a column of that name is replaced."""

    def make():
        sniffer, kinds = Sniffer(), list(FORMATS)

        def one(text: str | None) -> tuple:
            payload, n = padded(text)
            stored = FORMATS[kinds[zlib.crc32(payload) % len(kinds)]][2](payload)
            found = describe(stored, "wav", sniffer)
            read = found["first"].samples()
            inside = list(sniffer.media(read))
            x = np.frombuffer(read, np.uint8)
            feature = f"{found['true_type']}|{'corrected' if found['corrected'] else 'as declared'}|{len(inside)}|{x.mean():.3f}|{x.std():.3f}"
            return n, len(read), hashlib.sha256(read).hexdigest(), zlib.crc32(read[-64:]), len(stored), hashlib.sha256(stored).hexdigest(), feature

        names = [x.split()[0] for x in STORED.split(", ")]

        def work(texts: list) -> pa.Array:
            columns = list(zip(*map(one, texts), strict=True))
            return struct_of(**{name: pa.array(c, pa.string() if name.endswith(("256", "feature")) else pa.int64()) for name, c in zip(names, columns, strict=True)})

        return work

    return df.withColumn(into, text_column(STORED, make)(F.col(text)))
