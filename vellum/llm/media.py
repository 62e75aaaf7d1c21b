"""Media columns: stored bytes, signature sniffing, validated structure and carving of embedded media.

``store`` turns a payload into one of four lossless formats of 8-bit samples (WAV sound, BMP, PGM and PNG grey images).
``sniff`` finds media in any bytes: an Aho-Corasick automaton of all formats' magic bytes proposes places, and the
format's validator confirms the structure and gives the exact length; a match of magic bytes alone counts for
nothing. The first medium at the start of the bytes corrects a declared type; media further in are carved.

Validators look at structure alone: RIFF chunk sizes, BMP header arithmetic (RLE by the stated size), PGM header with
comments and any maxval, PNG chunks and checksums, JPEG segments up to the end marker, GIF blocks up to the trailer. Samples are
given for WAV and PGM as stored, for 8-bit BMP, and for PNG of every colour type and depth with all row filters unless it
is interlaced; those of other BMP and PNG, of JPEG and of GIF are null. Not supported: RIFX and RF64, BMP of OS/2 (12-byte header).

Everything is per row, in Arrow batches cut into small runs, so memory follows the largest single value. A PNG is inflated to no
more bytes than its header promises, and to at most ``INFLATED`` times its packed size, the limit of its packing.

Defined cases: null and empty text are an empty payload, stored as one unit; very long texts are stored whole; equal texts are stored
alike, so repeated rows give equal values; null media have no finds; truncated or corrupted media are not found; of
formats that start at one place the first whose validator confirms counts; media inside the span of a found medium are not
reported again by ``sniff`` (op3 looks for them in the samples it reads back); other columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm._arrow import tidy

UNIT, PAD = 576, b"\xff"

# The magic bytes of the formats.
MAGIC = {
    "wav": b"RIFF",
    "bmp": b"BM",
    "pgm": b"P5",
    "png": b"\x89PNG\r\n\x1a\n",
    "jpg": b"\xff\xd8\xff",
    "gif": b"GIF8",
}
#: The most bytes that a packed byte can stand for.
INFLATED = 1032


def padded(data: bytes) -> bytes:
    """``data`` with bytes 255 up to a positive multiple of UNIT."""
    return data + PAD * ((-len(data)) % UNIT if data else UNIT)


# ---- writers: payload -> bytes of the format; rows of images are UNIT // 2 samples wide

WIDTH = UNIT // 2


def wav(payload: bytes) -> bytes:
    head = struct.pack("<4sIHHIIHH", b"fmt ", 16, 1, 1, 8000, 8000, 1, 8)
    return b"RIFF" + struct.pack("<I", 4 + len(head) + 8 + len(payload)) + b"WAVE" + head + b"data" + struct.pack("<I", len(payload)) + payload


def bmp(payload: bytes) -> bytes:
    palette = bytes(v for i in range(256) for v in (i, i, i, 0))
    at = 54 + len(palette)
    info = struct.pack("<IiiHHIIiiII", 40, WIDTH, -(len(payload) // WIDTH), 1, 8, 0, len(payload), 2835, 2835, 256, 0)
    return b"BM" + struct.pack("<IHHI", at + len(payload), 0, 0, at) + info + palette + payload


def pgm(payload: bytes) -> bytes:
    return b"P5\n%d %d\n255\n" % (WIDTH, len(payload) // WIDTH) + payload


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def png(payload: bytes) -> bytes:
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    lines = np.concatenate((np.zeros((len(rows), 1), np.uint8), rows), axis=1).tobytes()
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return MAGIC["png"] + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines, 1)) + _chunk(b"IEND", b"")


WRITERS: dict[str, Callable[[bytes], bytes]] = {"wav": wav, "bmp": bmp, "pgm": pgm, "png": png}


# ---- validators: (length of the medium, its samples or None where they are not decoded) at a place, or None


def read_wav(data: bytes, at: int) -> tuple[int, bytes | None] | None:
    if data[at + 8 : at + 12] != b"WAVE" or at + 12 > len(data):
        return None
    end = at + 8 + struct.unpack_from("<I", data, at + 4)[0]
    if end > len(data):
        return None
    spot, form, samples = at + 12, None, None
    while spot + 8 <= end:
        kind, size = data[spot : spot + 4], struct.unpack_from("<I", data, spot + 4)[0]
        if spot + 8 + size > end:
            return None
        if kind == b"fmt " and size >= 14:
            form = struct.unpack_from("<HHIIH", data, spot + 8)
        elif kind == b"data":
            samples = data[spot + 8 : spot + 8 + size]
        spot += 8 + size + (size & 1 if spot + 8 + size < end else 0)
    if form is None or samples is None or spot != end or form[1] == 0:
        return None
    return end - at, samples


def read_bmp(data: bytes, at: int) -> tuple[int, bytes | None] | None:
    if at + 54 > len(data):
        return None
    total, _, _, start = struct.unpack_from("<IHHI", data, at + 2)
    head, width, height, planes, bits, packing, size = struct.unpack_from("<IiiHHII", data, at + 14)
    if head not in (40, 52, 56, 108, 124) or planes != 1 or bits not in (1, 4, 8, 16, 24, 32) or packing not in (0, 1, 2, 3, 6):
        return None
    if width <= 0 or height == 0 or start < 14 + head or at + total > len(data):
        return None
    step = (width * bits + 31) // 32 * 4
    body = size if packing in (1, 2) else step * abs(height)
    if not body or start + body > total or (packing not in (1, 2) and size and size < body):
        return None
    if bits != 8 or packing:
        return total, None
    rows = np.frombuffer(data, np.uint8, body, at + start).reshape(-1, step)[:, :width]
    return total, (rows if height < 0 else rows[::-1]).tobytes()


def read_pgm(data: bytes, at: int) -> tuple[int, bytes | None] | None:
    fields, spot = [], at + 2
    while len(fields) < 3:
        if spot >= len(data) or data[spot] not in b" \t\r\n":
            return None
        while spot < len(data) and data[spot] in b" \t\r\n#":
            if data[spot] == 35:  # a comment runs to the end of its line
                line = data.find(b"\n", spot)
                spot = len(data) if line < 0 else line
            else:
                spot += 1
        stop = spot
        while stop < len(data) and stop - spot < 10 and 48 <= data[stop] <= 57:
            stop += 1
        if stop == spot:
            return None
        fields.append(int(data[spot:stop]))
        spot = stop
    if spot >= len(data) or data[spot] not in b" \t\r\n" or not 0 < fields[2] < 65536 or not fields[0] or not fields[1]:
        return None
    end = spot + 1 + fields[0] * fields[1] * (2 if fields[2] > 255 else 1)
    return (end - at, data[spot + 1 : end]) if end <= len(data) else None


#: Bits of a sample by the colour type of a PNG.
DEPTHS = {0: (1, 2, 4, 8, 16), 2: (8, 16), 3: (1, 2, 4, 8), 4: (8, 16), 6: (8, 16)}


def read_png(data: bytes, at: int) -> tuple[int, bytes | None] | None:
    spot, head, packed = at + 8, None, []
    while spot + 12 <= len(data):
        size, kind = struct.unpack_from(">I4s", data, spot)
        if spot + 12 + size > len(data) or struct.unpack_from(">I", data, spot + 8 + size)[0] != zlib.crc32(data[spot + 4 : spot + 8 + size]):
            return None
        if kind == b"IHDR" and size == 13:
            head = struct.unpack_from(">IIBBBBB", data, spot + 8)
        elif kind == b"IDAT":
            packed.append(data[spot + 8 : spot + 8 + size])
        spot += 12 + size
        if kind == b"IEND":
            break
    else:
        return None
    if head is None or not head[0] or not head[1] or head[2] not in DEPTHS.get(head[3], ()) or head[4:6] != (0, 0) or head[6] > 1 or not packed:
        return None
    return spot - at, None if head[6] else _png_samples(head[0], head[1], head[2] * CHANNELS[head[3]], b"".join(packed))


#: Channels by the colour type of a PNG.
CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def _png_samples(width: int, height: int, bits: int, packed: bytes) -> bytes | None:
    """The rows of an image that is not interlaced, filters undone; None if its data are not what the header promises."""
    step, back = (width * bits + 7) // 8, max(1, bits // 8)
    size = height * (step + 1)
    if size > INFLATED * len(packed) + 64:
        return None
    try:
        data = zlib.decompressobj().decompress(packed, size + 1)
    except zlib.error:
        return None
    if len(data) != size:
        return None
    lines = np.frombuffer(data, np.uint8).reshape(height, step + 1)
    if not lines[:, 0].any():
        return lines[:, 1:].tobytes()
    if lines[:, 0].max() > 4:
        return None
    out = np.zeros((height + 1, step), np.uint8)
    for y in range(height):
        out[y + 1] = _unfiltered(int(lines[y, 0]), lines[y, 1:], out[y], back)
    return out[1:].tobytes()


def _unfiltered(kind: int, line: np.ndarray, above: np.ndarray, back: int) -> np.ndarray:
    """A row of a PNG without its filter: none, left, above, mean of both, or Paeth's choice."""
    if kind == 0:
        return line
    if kind == 2:
        return line + above
    if kind == 1:
        wide = np.zeros(-(-len(line) // back) * back, np.uint8)
        wide[: len(line)] = line
        return np.cumsum(wide.reshape(-1, back), 0, dtype=np.uint8).ravel()[: len(line)]
    got, up = bytearray(len(line)), above.tobytes()
    for x, value in enumerate(line.tobytes()):
        a, b, c = (got[x - back], up[x], up[x - back]) if x >= back else (0, up[x], 0)
        if kind == 3:
            guess = (a + b) // 2
        else:
            p = a + b - c
            guess = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
        got[x] = (value + guess) & 255
    return np.frombuffer(bytes(got), np.uint8)


def read_jpg(data: bytes, at: int) -> tuple[int, bytes | None] | None:
    spot, frame = at + 2, False
    while spot + 4 <= len(data):
        if data[spot] != 0xFF:
            return None
        kind = data[spot + 1]
        if kind == 0xFF:  # filling
            spot += 1
            continue
        if kind in (0, 1) or 0xD0 <= kind <= 0xD9:
            return None
        size = struct.unpack_from(">H", data, spot + 2)[0]
        if size < 2 or spot + 2 + size > len(data):
            return None
        if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
            frame = size >= 11 and size == 8 + 3 * data[spot + 9] and struct.unpack_from(">H", data, spot + 7)[0] > 0
        spot += 2 + size
        if kind == 0xDA:  # entropy-coded bytes run to the next marker that is neither stuffed nor a restart
            if not frame:
                return None
            while True:
                spot = data.find(b"\xff", spot)
                if spot < 0 or spot + 1 >= len(data):
                    return None
                if data[spot + 1] == 0xD9:
                    return spot + 2 - at, None
                if data[spot + 1] and not 0xD0 <= data[spot + 1] <= 0xD7:
                    break
                spot += 2
    return None


def read_gif(data: bytes, at: int) -> tuple[int, bytes | None] | None:
    if data[at + 4 : at + 6] not in (b"7a", b"9a") or at + 13 > len(data):
        return None
    width, height, flags = struct.unpack_from("<HHB", data, at + 6)
    spot, images = at + 13 + (3 << (flags & 7) + 1 if flags & 128 else 0), 0
    while spot < len(data):
        kind = data[spot]
        if kind == 0x3B:
            return (spot + 1 - at, None) if images and width and height else None
        if kind == 0x2C and spot + 10 < len(data):
            flags = data[spot + 9]
            spot += 10 + (3 << (flags & 7) + 1 if flags & 128 else 0) + 1
            images += 1
        elif kind == 0x21:
            spot += 2
        else:
            return None
        while spot < len(data) and data[spot]:  # blocks of data, each with its length before it
            spot += 1 + data[spot]
        spot += 1
    return None


READERS: dict[str, Callable[[bytes, int], tuple[int, bytes | None] | None]] = {"wav": read_wav, "bmp": read_bmp, "pgm": read_pgm, "png": read_png, "jpg": read_jpg, "gif": read_gif}
_automata: list = []


def _automaton():
    if not _automata:
        own = ahocorasick.Automaton()
        for kind, magic in MAGIC.items():
            own.add_word(magic.decode("latin-1"), (kind, len(magic)))
        own.make_automaton()
        _automata.append(own)
    return _automata[0]


def finds(data: bytes | None) -> list[tuple[str, int, int, bytes | None]]:
    """(type, offset, length, samples) of every confirmed medium, left to right, outermost only."""
    out, free = [], 0
    if not data:
        return out
    text, spot = data.decode("latin-1"), 0
    while spot < len(text):  # goes on behind a confirmed medium instead of through it
        for end, (kind, size) in _automaton().iter(text, spot):
            at = end - size + 1
            if at >= free and (got := READERS[kind](data, at)):
                out.append((kind, at, *got))
                free = at + got[0]
                break
        else:
            break
        spot = free
    return out


# ---- DataFrame operators


def _kind_of(payload: bytes) -> str:
    """The format a payload is stored in: a function of its bytes, so equal payloads are stored alike."""
    return ("wav", "bmp", "pgm", "png")[zlib.crc32(payload) % 4]


@tidy
def _storer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            raw = [(x or "").encode() for x in part.column(1).to_pylist()]
            pads = [padded(x) for x in raw]
            kinds = [_kind_of(x) for x in pads]
            media = [WRITERS[k](x) for k, x in zip(kinds, pads, strict=True)]
            told = ["text/plain"] * len(kinds)  # what the column held; sniffing corrects it
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) for x in raw], pa.int64()), pa.array(told), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "declared", "media"])


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, declared, media): every text as one medium, declared as the plain text it came from, for sniff to correct."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(_storer, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, n_bytes bigint, declared string, media binary")


def _sniffer(n_keys: int, names: list[str], with_samples: bool):
    @tidy
    def sniffed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                who, found = [], []
                for i, data in enumerate(part.column(n_keys).to_pylist()):
                    for got in finds(data):
                        who.append(i), found.append(got)
                taken = [c.take(pa.array(who, pa.int32())) for c in part.columns[:n_keys]]
                cols = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.int64())]
                yield pa.RecordBatch.from_arrays([*taken, *cols, *([pa.array([f[3] for f in found], pa.binary())] if with_samples else [])], names)

    return sniffed


def sniff(df: DataFrame, media_col: str = "media", keys: tuple[str, ...] = ("doc_id",), with_samples: bool = False) -> DataFrame:
    """One row for each medium found: the keys, type, at, length (and the samples)."""
    slim = df.select(*keys, media_col)
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in slim.schema.fields[:-1]]
    names = [*keys, "type", "at", "length", *(["samples"] if with_samples else [])]
    return slim.mapInArrow(_sniffer(len(keys), names, with_samples), ", ".join([*fields, "type string, at bigint, length bigint" + ", samples binary" * with_samples]))


def carve(df: DataFrame, media_col: str = "media", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row for each medium found: the keys, type, at, and the medium's own bytes."""
    rows = sniff(df.select(*keys, media_col), media_col, (*keys, media_col))
    return rows.select(*keys, "type", "at", F.expr(f"substring({media_col}, cast(at + 1 as int), cast(length as int))").alias("carved"))


@tidy
def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    types = [None, pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    for batch in batches:
        out: list[list] = [[] for _ in names]
        for i in range(batch.num_rows):
            n, told, media = batch.column(1)[i].as_py(), batch.column(2)[i].as_py(), batch.column(3)[i].as_py()
            found = finds(media)
            kind, at, size, samples = found[0]
            level = np.bincount(np.frombuffer(samples, np.uint8), minlength=256)
            mean = float(level @ np.arange(256)) / len(samples)
            feature = f"type={kind};declared={told};corrected={int(told != kind)};at={at};embedded={len(found) - 1 + len(finds(samples))};levels={int((level > 0).sum())};mean={mean:.4f}"
            for k, v in enumerate((i, n, len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-32:]), size, hashlib.sha256(media[at : at + size]).hexdigest(), feature)):
                out[k].append(v)
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(out[0], pa.int32())), *(pa.array(v, t) for v, t in zip(out[1:], types[1:], strict=True))], names)


def media_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stores every text as a medium, reads the stored bytes back by sniffing, and gives their digests and features."""
    stored = store(docs, id_col, text_col)
    kind = stored.schema["doc_id"].dataType.simpleString()
    return stored.mapInArrow(_features, f"doc_id {kind}, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string")
