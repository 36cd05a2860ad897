"""GIF columns: LZW code streams, palettes, disposal and transparency, timed frames, colour histograms.

Everything works row by row inside Arrow batches, so nothing is shuffled and a task holds one batch.
Text is stored losslessly as 8-bit samples: the payload's bytes are palette indices, 192 a row, and
frames of at most 256 rows follow each other in time.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

WIDTH, ROWS, DELAY_CS = 192, 256, 10
#: Red is the index, so a sample can be read back from a composed pixel.
PALETTE = np.stack([np.arange(256), 255 - np.arange(256), np.arange(256) * 37 % 256], 1).astype(np.uint8)
TABLE = 4096
_SINGLES = [bytes([i]) for i in range(256)]


def _widths(first: int, n: int, bits: int) -> np.ndarray:
    """Bits of the codes number first, first + 1, ... after a clear code, for samples of ``bits`` bits."""
    i = np.arange(first, first + n)
    width = np.full(n, bits + 1)
    for b in range(bits + 1, 12):
        width += i >= (1 << b) - (1 << bits) - 1
    return width


def lzw_encode(samples: bytes) -> bytes:
    """Codes of 8-bit samples, least significant bit first; a clear code starts each table."""
    segments, codes, table, free = [], [], {}, 258
    find, put = table.get, codes.append
    w = samples[0]
    for c in samples[1:]:
        k = w << 8 | c
        v = find(k)
        if v is not None:
            w = v
            continue
        put(w)
        w = c
        if free < TABLE:
            table[k] = free
            free += 1
        else:
            segments.append(codes)
            codes, free = [], 258
            put = codes.append
            table.clear()
    put(w)
    segments.append(codes)
    values, widths = [np.array([256])], [np.array([9])]
    for k, seg in enumerate(segments):
        closing = 257 if k == len(segments) - 1 else 256
        values += [np.array(seg), np.array([closing])]
        widths.append(_widths(0, len(seg) + 1, 8))
    value, width = np.concatenate(values).astype("<u2"), np.concatenate(widths)
    bits = np.unpackbits(value.view(np.uint8).reshape(-1, 2), axis=1, bitorder="little")
    return np.packbits(bits[np.arange(16) < width[:, None]], bitorder="little").tobytes()


def lzw_decode(stream: bytes, bits: int, limit: int) -> bytes:
    """Samples of a code stream of ``bits``-bit samples, at most ``limit``. A code's width depends only on its
    number since the last clear code, so whole runs of codes are unpacked at once."""
    clear, end = 1 << bits, (1 << bits) + 1
    raw = np.frombuffer(stream + b"\0\0\0\0", np.uint8).astype(np.uint32)
    room, at, out, made = 8 * len(stream), 0, [], 0
    fresh = _SINGLES[:clear] + [b"", b""]
    table, prev, n, i = list(fresh), None, end + 1, 0
    while at < room and made < limit:
        width = _widths(i, 1024, bits)
        place = at + np.cumsum(width) - width
        fit = int(np.searchsorted(place + width, room, side="right"))
        if not fit:
            break
        place, width = place[:fit], width[:fit]
        byte = place >> 3
        codes = (raw[byte] | raw[byte + 1] << 8 | raw[byte + 2] << 16) >> (place & 7).astype(np.uint32) & ((1 << width) - 1).astype(np.uint32)
        stops = np.flatnonzero((codes == clear) | (codes == end))
        stop = int(stops[0]) if len(stops) else fit
        put = out.append
        for c in codes[:stop].tolist():
            if c < n:
                e = table[c]
            elif c == n and prev is not None:
                e = prev + prev[:1]
            else:
                raise ValueError("code beyond the table")
            put(e)
            made += len(e)
            if prev is not None and n < TABLE:
                table.append(prev + e[:1])
                n += 1
            prev = e
        if stop < fit:
            at = int(place[stop] + width[stop])
            if codes[stop] == end:
                break
            table, prev, n, i = list(fresh), None, end + 1, 0
        else:
            at, i = int(place[-1] + width[-1]), i + fit
    return b"".join(out)[:limit]


def _blocks(data: bytes) -> bytes:
    return b"".join(bytes([len(data[i : i + 255])]) + data[i : i + 255] for i in range(0, len(data), 255)) + b"\0"


def write_gif(samples: bytes) -> bytes:
    """An animated GIF whose frames hold ``samples``, a positive multiple of WIDTH bytes."""
    rows = len(samples) // WIDTH
    out = [b"GIF89a", struct.pack("<HHBBB", WIDTH, min(rows, ROWS), 0xF7, 0, 0), PALETTE.tobytes()]
    for top in range(0, rows, ROWS):
        part = samples[top * WIDTH : (top + ROWS) * WIDTH]
        out += [b"\x21\xf9\x04", struct.pack("<BHB", 1 << 2, DELAY_CS, 0), b"\0\x2c", struct.pack("<HHHHB", 0, 0, WIDTH, len(part) // WIDTH, 0), b"\x08", _blocks(lzw_encode(part))]
    return b"".join(out) + b"\x3b"


#: Pixels of the largest canvas, and of the largest frame, that are decoded: 64 MB of RGBA.
MOST_PIXELS = 1 << 24
#: Bytes of composed frames that a task gathers before it passes them on.
MOST_HELD = 1 << 26


def read_gif(data: bytes, most_pixels: int = MOST_PIXELS):
    """Frames as (delay_ms, disposal, (x, y, w, h), canvas of RGBA pixels after drawing). Transparent samples leave
    what is below; disposal 2 then clears the frame's area, 3 restores what was there before."""
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF")
    width, height, flags = struct.unpack_from("<HHB", data, 6)
    if width * height > most_pixels:
        raise ValueError("canvas too large")
    at, shared = 13, None
    if flags & 0x80:
        shared, at = np.frombuffer(data, np.uint8, 3 << (flags & 7) + 1, at).reshape(-1, 3), at + (3 << (flags & 7) + 1)
    canvas = np.zeros((height, width, 4), np.uint8)
    delay, disposal, clear = 0, 0, None

    def blocks(at):
        parts = []
        while data[at]:
            parts.append(data[at + 1 : at + 1 + data[at]])
            at += 1 + data[at]
        return b"".join(parts), at + 1

    while data[at] != 0x3B:
        if data[at] == 0x21:
            body, end = blocks(at + 2)
            if data[at + 1] == 0xF9:
                bits, hundredths, index = struct.unpack_from("<BHB", body)
                delay, disposal, clear = hundredths * 10, bits >> 2 & 7, index if bits & 1 else None
            at = end
            continue
        if data[at] != 0x2C:
            raise ValueError("unknown block")
        x, y, w, h, flags = struct.unpack_from("<HHHHB", data, at + 1)
        if w * h > most_pixels:
            raise ValueError("frame too large")
        at += 10
        colours = shared
        if flags & 0x80:
            colours, at = np.frombuffer(data, np.uint8, 3 << (flags & 7) + 1, at).reshape(-1, 3), at + (3 << (flags & 7) + 1)
        bits = data[at]
        stream, at = blocks(at + 1)
        index = np.frombuffer(lzw_decode(stream, bits, w * h), np.uint8)
        if len(index) < w * h or colours is None:
            raise ValueError("samples or palette missing")
        index = index.reshape(h, w)
        if flags & 0x40:
            order = np.concatenate([np.arange(a, h, s) for a, s in ((0, 8), (4, 8), (2, 4), (1, 2))])
            index = index[np.argsort(order)]
        before = canvas.copy() if disposal == 3 else None
        area = canvas[y : y + h, x : x + w]
        drawn = np.full((*index.shape, 4), 255, np.uint8)
        drawn[..., :3] = colours[np.minimum(index, len(colours) - 1)]
        drawn = drawn[: area.shape[0], : area.shape[1]]
        if clear is None:
            area[...] = drawn
        else:
            seen = index[: area.shape[0], : area.shape[1]] != clear
            area[seen] = drawn[seen]
        yield delay, disposal, (x, y, w, h), canvas.copy()
        if disposal == 2:
            area[...] = 0
        elif disposal == 3:
            canvas = before
        delay, disposal, clear = 0, 0, None


def histogram(rgb: np.ndarray) -> np.ndarray:
    """Pixels in each of 64 colour bins, two bits a channel."""
    c = (rgb >> 6).astype(np.intp)
    return np.bincount((c[..., 0] * 16 + c[..., 1] * 4 + c[..., 2]).ravel(), minlength=64)


def payload(text: str) -> bytes:
    raw = text.encode()
    return raw.ljust(max(WIDTH, -(-len(raw) // WIDTH) * WIDTH), b" ")


def store_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text as a GIF: id_col, n_bytes (of the text), gif. A null text is stored as an empty one; an empty one
    is a row of spaces. Repeated rows give repeated rows, an empty table an empty one; other columns are not read."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts = [t.as_py() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array([write_gif(payload(t)) for t in texts], pa.binary())], names=[id_col, "n_bytes", "gif"])

    return docs.select(F.col(id_col), text_of(text_col).alias("text")).mapInArrow(run, f"{id_col} {kind}, n_bytes long, gif binary")


def frames(media: DataFrame, id_col: str, gif_col: str = "gif") -> DataFrame:
    """A row per frame: id_col, frame (from 0), delay_ms, disposal, width, height, pixels (RGBA bytes of the composed
    canvas), histogram (64 colour bins over its opaque pixels), error. A null or broken GIF gives the frames before
    the fault and one row with error set, and so does one that declares a canvas or a frame of more than MOST_PIXELS; an empty table gives no
    rows. A task holds one file, and MOST_HELD bytes of its frames or one frame."""
    kind = media.schema[id_col].dataType.simpleString()
    names = [id_col, "frame", "delay_ms", "disposal", "width", "height", "pixels", "histogram", "error"]
    schema = f"{id_col} {kind}, frame int, delay_ms int, disposal int, width int, height int, pixels binary, histogram array<int>, error string"
    types = (pa.int32(),) * 5 + (pa.binary(), pa.list_(pa.int32()), pa.string())

    def table(key, rows):
        return pa.RecordBatch.from_arrays([pa.concat_arrays([key] * len(rows)), *(pa.array([r[c] for r in rows], t) for c, t in enumerate(types))], names=names)

    def run(batches):
        for batch in batches:
            for k, data in enumerate(batch.column(1)):
                key, n = batch.column(0).slice(k, 1), 0
                rows, held = [], 0
                try:
                    for delay, disposal, _, canvas in read_gif(data.as_py() or b""):
                        if held + canvas.nbytes > MOST_HELD and rows:
                            yield table(key, rows)
                            rows, held = [], 0
                        rows.append((n, delay, disposal, canvas.shape[1], canvas.shape[0], canvas.tobytes(), histogram(canvas[canvas[..., 3] > 0][:, :3]).tolist(), None))
                        n, held = n + 1, held + canvas.nbytes
                except (ValueError, IndexError, struct.error) as e:
                    rows.append((n, None, None, None, None, None, None, str(e) or "cut short"))
                if rows:
                    yield table(key, rows)

    return media.select(id_col, gif_col).mapInArrow(run, schema)


def describe(media: DataFrame, id_col: str = "doc_id", gif_col: str = "gif") -> DataFrame:
    """Digests of stored texts, computed from the decoded frames: id_col, n_bytes, payload_bytes, payload_sha256,
    tail_crc32, media_bytes, media_sha256, feature (frames, size, duration and the summed colour histogram). A null GIF, and one
    that cannot be read to its end, has nulls for all that comes from its frames."""
    kind = media.schema[id_col].dataType.simpleString()
    names = [id_col, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]

    def one(data: bytes | None):
        if data is None:
            return None, None, None, None, None, None
        parts, bins, ms, size = [], np.zeros(64, np.int64), 0, (0, 0)
        try:
            for delay, _, (x, y, w, h), canvas in read_gif(data):
                shown = canvas[y : y + h, x : x + w]
                parts.append(shown[..., 0].tobytes())
                bins += histogram(shown[..., :3])
                ms, size = ms + delay, canvas.shape[1::-1]
        except (ValueError, IndexError, struct.error):
            return None, None, None, len(data), hashlib.sha256(data).hexdigest(), None
        back = b"".join(parts)
        feature = f"frames={len(parts)};size={size[0]}x{size[1]};ms={ms};bins={','.join(map(str, bins))}"
        return len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(data), hashlib.sha256(data).hexdigest(), feature

    def run(batches):
        for batch in batches:
            rows = [one(g.as_py()) for g in batch.column(2)]
            types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array([r[c] for r in rows], t) for c, t in enumerate(types))], names=names)

    return media.select(id_col, "n_bytes", gif_col).mapInArrow(run, f"{id_col} {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
