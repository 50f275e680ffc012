"""Media columns: a baseline JPEG codec in numpy for DC-only luminance thumbnails.

``encode`` stores bytes losslessly: each byte is the quantised DC coefficient of one flat 8 x 8 block, so the
1/8-scale luminance thumbnail of the image is the payload. ``decode`` is a general baseline reader: it parses the
markers, Huffman-decodes the scan (AC coefficients included, to stay in step) and rebuilds the DC-only luminance
thumbnail of any sampling. Restart intervals of all images of a batch are decoded side by side, block by block.

Nothing is shuffled: media are made and read row by row, in chunks of bounded size.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks_by_bytes, short_batches, text_bytes

#: Payload bytes (blocks) of a row of the image, most rows of an image, and blocks of a restart interval.
ROW, MOST_ROWS, INTERVAL = 192, 8191, 64
BLOCK = 1_500_000
#: Code lengths of DC categories 0 to 8, fitted to the steps between neighbouring bytes of texts.
DC_LENGTHS = (5, 4, 4, 3, 2, 3, 5, 2, 5)
#: The one AC code: end of block, one bit.
AC_LENGTHS = (1,)


def canonical(symbols: list[int], lengths: list[int]) -> dict[int, tuple[int, int]]:
    """``symbol: (code, length)`` of a canonical Huffman table; symbols are in order of length."""
    out, code, last = {}, 0, lengths[0] if lengths else 0
    for symbol, length in zip(symbols, lengths, strict=True):
        code <<= length - last
        out[symbol], last = (code, length), length
        code += 1
    return out


def dht(kind: int, lengths: tuple[int, ...]) -> tuple[bytes, dict[int, tuple[int, int]]]:
    """A DHT segment and the codes of symbols 0, 1, ... with the given lengths."""
    order = sorted(range(len(lengths)), key=lambda s: (lengths[s], s))
    counts = bytes(sum(n == k for n in lengths) for k in range(1, 17))
    body = bytes([kind]) + counts + bytes(order)
    return b"\xff\xc4" + struct.pack(">H", len(body) + 2) + body, canonical(order, [lengths[s] for s in order])


DC_SEGMENT, DC_CODES = dht(0x00, DC_LENGTHS)
AC_SEGMENT, AC_CODES = dht(0x10, AC_LENGTHS)


def _steps() -> tuple[np.ndarray, np.ndarray]:
    """Bits and their number for a block whose DC differs by ``-255 .. 255`` from the last, end of block included."""
    word, size = np.zeros(511, np.int64), np.zeros(511, np.int64)
    for d in range(-255, 256):
        cat = abs(d).bit_length()
        code, length = DC_CODES[cat]
        extra = d if d >= 0 else d + (1 << cat) - 1
        word[d + 255] = ((code << cat | extra) << AC_CODES[0][1]) | AC_CODES[0][0]
        size[d + 255] = length + cat + AC_CODES[0][1]
    return word, size


STEP_WORD, STEP_SIZE = _steps()


def header(rows: int) -> bytes:
    """Everything before the scan of an image of ``rows`` rows of blocks."""
    quant = b"\xff\xdb" + struct.pack(">HB", 67, 0) + bytes([8] * 64)
    frame = b"\xff\xc0" + struct.pack(">HBHHB3B", 11, 8, rows * 8, ROW * 8, 1, 1, 0x11, 0)
    every = b"\xff\xdd" + struct.pack(">HH", 4, INTERVAL)
    scan = b"\xff\xda" + struct.pack(">HB2B3B", 8, 1, 1, 0x00, 0, 63, 0)
    return b"\xff\xd8" + quant + frame + DC_SEGMENT + AC_SEGMENT + every + scan


def padded(text: bytes) -> bytes:
    """``text`` with spaces up to a positive multiple of 192 bytes."""
    return text + b" " * (-len(text) % ROW or (0 if text else ROW))


def encode(payloads: list[bytes]) -> list[bytes]:
    """JPEG images (several in a row for a very long payload) that hold each payload; lengths are multiples of 192."""
    frames = [p[i : i + ROW * MOST_ROWS] for p in payloads for i in range(0, len(p), ROW * MOST_ROWS)]
    owner = [k for k, p in enumerate(payloads) for _ in range(0, len(p), ROW * MOST_ROWS)]
    samples = np.frombuffer(b"".join(frames), np.uint8).astype(np.int64) - 128
    step = np.diff(samples, prepend=0)
    step[::INTERVAL] = samples[::INTERVAL]
    word, size = STEP_WORD[step + 255], STEP_SIZE[step + 255]
    # Bits of an interval are padded with ones to whole bytes.
    per = size.reshape(-1, INTERVAL)
    bits = per.sum(axis=1)
    nbytes = (bits + 7) // 8
    first = np.concatenate(([0], np.cumsum(nbytes)[:-1]))
    at = (first[:, None] * 8 + np.cumsum(per, axis=1) - per).ravel()
    total = int(nbytes.sum())
    shifted = word << (24 - (at & 7) - size)
    data = sum(np.bincount((at >> 3) + k, (shifted >> (16 - 8 * k)) & 255, total + 3) for k in range(3))[:total].astype(np.int64)
    data[first + nbytes - 1] |= (1 << (nbytes * 8 - bits)) - 1
    # A zero follows each byte FF; a restart marker stands between the intervals of a frame.
    full = data == 255
    frame_intervals = np.array([len(f) // INTERVAL for f in frames])
    frame_end = np.cumsum(frame_intervals)
    number = np.arange(len(nbytes)) - np.repeat(frame_end - frame_intervals, frame_intervals)
    before = np.cumsum(full) - full + 2 * np.repeat(np.arange(len(nbytes)), nbytes)
    out = np.zeros(total + int(full.sum()) + 2 * len(nbytes), np.uint8)
    where = np.arange(total) + before
    out[where] = data
    mark = where[first + nbytes - 1] + 1 + full[first + nbytes - 1]
    out[mark], out[mark + 1] = 0xFF, 0xD0 + number % 8
    out[mark[frame_end - 1] + 1] = 0xD9  # the last interval ends the image
    raw, ends = out.tobytes(), (mark[frame_end - 1] + 2).tolist()
    media: list[list[bytes]] = [[] for _ in payloads]
    start = 0
    for k, frame, end in zip(owner, frames, ends, strict=True):
        media[k] += [header(len(frame) // ROW), raw[start:end]]
        start = end
    return [b"".join(m) for m in media]


# ---------------------------------------------------------------- reading

END_OF_SCAN = re.compile(rb"\xff[^\x00\xd0-\xd7]")


@dataclass(frozen=True)
class Image:
    """What the markers of a baseline image say, and where its entropy-coded data are."""

    width: int
    height: int
    layout: tuple[tuple[int, int, bytes, bytes], ...]  # of each component: h, v, DC and AC table segments
    quant: int  # of the luminance DC coefficient
    interval: int
    scan: bytes


def parse(data: bytes) -> list[Image]:
    """The baseline images of a byte string, one after the other; raises ValueError for others."""
    images, at = [], 0
    while at < len(data):
        if data[at : at + 2] != b"\xff\xd8":
            raise ValueError("not a JPEG image")
        at += 2
        quants: dict[int, int] = {}
        tables: dict[int, bytes] = {}
        frame, interval = None, 0
        while True:
            if at + 4 > len(data) or data[at] != 0xFF:
                raise ValueError("broken JPEG markers")
            kind, size = data[at + 1], struct.unpack_from(">H", data, at + 2)[0]
            body = data[at + 4 : at + 2 + size]
            at += 2 + size
            if kind == 0xDB:
                while body:
                    wide = body[0] >> 4
                    quants[body[0] & 15] = struct.unpack_from(">H", body, 1)[0] if wide else body[1]
                    body = body[1 + 64 * (1 + wide) :]
            elif kind == 0xC4:
                while body:
                    n = sum(body[1:17])
                    tables[body[0]] = body[1 : 17 + n]
                    body = body[17 + n :]
            elif kind == 0xC0:
                if body[0] != 8:
                    raise ValueError("samples are not 8 bits wide")
                frame = (*struct.unpack_from(">HH", body, 1), [tuple(body[6 + 3 * i : 9 + 3 * i]) for i in range(body[5])])
            elif 0xC1 <= kind <= 0xCF and kind not in (0xC8, 0xCC):
                raise ValueError("not a baseline JPEG image")
            elif kind == 0xDD:
                interval = struct.unpack(">H", body)[0]
            elif kind == 0xDA:
                break
        if frame is None or body[0] != len(frame[2]):
            raise ValueError("components are not in one scan")
        end = END_OF_SCAN.search(data, at)
        if not end or data[end.start() + 1] != 0xD9:
            raise ValueError("no end of image")
        height, width, parts = frame
        chosen = {body[1 + 2 * i]: body[2 + 2 * i] for i in range(body[0])}
        layout = tuple((p[1] >> 4, p[1] & 15, tables[chosen[p[0]] >> 4], tables[16 + (chosen[p[0]] & 15)]) for p in parts)
        if len(layout) == 1:
            layout = ((1, 1, *layout[0][2:]),)
        images.append(Image(width, height, layout, quants[parts[0][2]], interval, data[at : end.start()]))
        at = end.end()
    return images


def lookup(table: bytes) -> tuple[np.ndarray, np.ndarray]:
    """For each 16 bits, the length of the code that they begin with (0: none) and its symbol."""
    lengths = [k + 1 for k in range(16) for _ in range(table[k])]
    length, symbol = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
    for s, (code, n) in zip(table[16:], canonical(list(range(len(lengths))), lengths).values(), strict=True):
        length[code << (16 - n) : (code + 1) << (16 - n)], symbol[code << (16 - n) : (code + 1) << (16 - n)] = n, s
    return length, symbol


def extend(extra: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The signed value of ``size`` extra bits."""
    return np.where((size > 0) & (extra < (1 << np.maximum(size - 1, 0))), extra - (1 << size) + 1, extra)


def whole_block(dc: tuple[np.ndarray, np.ndarray], ac: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For each 16 bits that hold a whole block of a DC step and an end of block: bits used (else 0) and step."""
    bits = np.arange(1 << 16)
    length, cat = dc
    used = length + cat
    ok = (length > 0) & (used < 16)
    extra = (bits >> np.maximum(16 - used, 0)) & ((1 << cat) - 1)
    rest = (bits << np.minimum(used, 16)) & 0xFFFF
    ok &= (ac[0][rest] > 0) & (ac[1][rest] == 0) & (used + ac[0][rest] <= 16)
    return np.where(ok, used + ac[0][rest], 0), extend(extra, cat)


def luminance(images: list[Image]) -> list[np.ndarray]:
    """DC-only luminance thumbnails (uint8, one sample per 8 x 8 block) of images with one layout."""
    layout, unit = images[0].layout, []
    for c, (h, v, _, _) in enumerate(layout):
        unit += [c] * (h * v)
    dc, ac = [lookup(x[2]) for x in layout], [lookup(x[3]) for x in layout]
    fused = [whole_block(d, a) for d, a in zip(dc, ac, strict=True)]
    hmax, vmax = max(x[0] for x in layout), max(x[1] for x in layout)
    across = np.array([-(-im.width // (8 * hmax)) for im in images])
    down = np.array([-(-im.height // (8 * vmax)) for im in images])
    units = across * down
    every = np.array([im.interval or u for im, u in zip(images, units, strict=True)])
    # Stuffed zeros and restart markers go; segments begin where an image or an interval begins.
    raw = np.frombuffer(b"".join(im.scan for im in images) + bytes(16), np.uint8)
    image_at = np.concatenate(([0], np.cumsum([len(im.scan) for im in images])))
    ff = np.flatnonzero(raw[: image_at[-1]] == 255)
    follows = raw[ff + 1]
    keep = np.ones(len(raw), bool)
    marks = ff[(follows >= 0xD0) & (follows <= 0xD7)]
    keep[ff[follows == 0] + 1] = False
    keep[marks] = keep[marks + 1] = False
    place = np.cumsum(keep) - keep
    data = np.concatenate((raw[keep], np.zeros(16, np.uint8)))
    start = np.sort(np.concatenate((place[image_at[:-1]], place[np.minimum(marks + 2, len(raw) - 1)])))
    segments = -(-units // every)
    if len(start) != segments.sum():
        raise ValueError("restart markers do not fit the image")
    of = np.repeat(np.arange(len(images)), segments)
    number = np.arange(len(of)) - np.repeat(np.cumsum(segments) - segments, segments)
    length = np.minimum(every[of], units[of] - number * every[of])
    words = np.ndarray((len(data) - 7,), ">u8", data, strides=(1,))
    pos = start.astype(np.int64) * 8
    last = np.zeros((len(layout), len(of)), np.int64)
    most = int(length.max(initial=0))
    luma = unit.count(0)
    values = np.zeros((len(of), most * luma), np.int16)
    live, equal = np.arange(len(of)), bool((length == most).all())
    for m in range(most):
        if not equal:
            live = np.flatnonzero(length > m)
        seen = 0
        for c in unit:
            p = pos[live]
            w = words[p >> 3].astype(np.uint64) << (p & 7).astype(np.uint64)
            head = (w >> np.uint64(48)).astype(np.int64)
            used, step = fused[c][0][head], fused[c][1][head]
            slow = np.flatnonzero(used == 0)
            if len(slow):
                step[slow], used[slow] = _block(words, p[slow], dc[c], ac[c])
            pos[live] = p + used
            last[c, live] += step
            if c == 0:
                values[live, m * luma + seen] = last[0, live]
                seen += 1
    out = []
    first = np.cumsum(segments) - segments
    for i, im in enumerate(images):
        dcs = values[first[i] : first[i] + segments[i]].reshape(-1, luma)
        if segments[i] > 1 or most * segments[i] != units[i]:
            valid = (np.arange(most)[None, :] < length[first[i] : first[i] + segments[i], None]).ravel()
            dcs = dcs[valid]
        h, v = layout[0][:2]
        grid = dcs.reshape(down[i], across[i], v, h).transpose(0, 2, 1, 3).reshape(down[i] * v, across[i] * h)
        rows, cols = -(-im.height * v // (8 * vmax)), -(-im.width * h // (8 * hmax))
        out.append(np.clip(np.floor(grid[:rows, :cols].astype(np.int64) * im.quant / 8 + 0.5) + 128, 0, 255).astype(np.uint8))
    return out


def _block(words: np.ndarray, pos: np.ndarray, dc: tuple[np.ndarray, np.ndarray], ac: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """DC steps and bits used of whole blocks, symbol by symbol."""

    def symbol(at: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        w = words[at >> 3].astype(np.uint64) << (at & 7).astype(np.uint64)
        head = (w >> np.uint64(48)).astype(np.int64)
        if not table[0][head].all():
            raise ValueError("broken Huffman code")
        return table[0][head], table[1][head], w

    at = pos.copy()
    length, cat, w = symbol(at, dc)
    extra = ((w << length.astype(np.uint64)) >> np.minimum(64 - cat, 63).astype(np.uint64)).astype(np.int64)
    step = np.where(cat > 0, extend(extra, cat), 0)
    at += length + cat
    live, k = np.arange(len(pos)), np.ones(len(pos), np.int64)
    while len(live):
        length, rs, _ = symbol(at[live], ac)
        at[live] += length + (rs & 15)
        k[live] += np.where(rs == 0, 64, (rs >> 4) + 1)
        live = live[k[live] < 64]
    return step, at - pos


def decode(media: list[bytes]) -> list[list[tuple[int, int, np.ndarray]]]:
    """For each byte string, ``(width, height, thumbnail)`` of its images."""
    groups: dict[tuple, list[tuple[int, int, Image]]] = defaultdict(list)
    out: list[list] = []
    for k, data in enumerate(media):
        images = parse(data)
        out.append([None] * len(images))
        for j, im in enumerate(images):
            groups[im.layout].append((k, j, im))
    for members in groups.values():
        for (k, j, im), thumb in zip(members, luminance([m[2] for m in members]), strict=True):
            out[k][j] = (im.width, im.height, thumb)
    return out


def thumbnail_hash(thumb: np.ndarray) -> str:
    """16 hex digits: whether each of 8 x 8 mean brightnesses is below its right neighbour (9 columns)."""
    ys, xs = np.arange(8) * thumb.shape[0] // 8, np.arange(9) * thumb.shape[1] // 9
    sums = np.add.reduceat(np.add.reduceat(thumb.astype(np.int64), ys, axis=0), xs, axis=1)
    area = np.outer(np.maximum(np.diff(np.append(ys, thumb.shape[0])), 1), np.maximum(np.diff(np.append(xs, thumb.shape[1])), 1))
    mean = sums / area
    return np.packbits(mean[:, 1:] > mean[:, :-1]).tobytes().hex()


# ---------------------------------------------------------------- operators


def with_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, media)``: each whole text as JPEG. Null is empty; an empty text is a payload of 192 spaces."""
    short_batches(docs.sparkSession, 500)

    def block(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks_by_bytes(batches, "__text", BLOCK):
            texts = part.column("__text").to_pylist()
            media = encode([padded(t) for t in texts])
            yield pa.RecordBatch.from_arrays([part.column("__id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(media, pa.binary())], ["__id", "n_bytes", "media"])

    rows = docs.select(F.col(id_col).alias("__id"), text_bytes(text_col).alias("__text"))
    return rows.mapInArrow(block, f"__id {rows.schema['__id'].dataType.simpleString()}, n_bytes bigint, media binary").withColumnRenamed("__id", id_col)


def media_features(media: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """Dimensions, thumbnail and digests of a media column, read back from the stored bytes.

    Columns: the id, ``n_bytes`` if there is one, ``width`` and ``height`` (of the first image), ``thumbnail`` (samples of all images),
    ``media_bytes``, ``media_sha256``, ``thumbnail_sha256``, ``tail_crc32`` (of the last 16 samples) and ``feature``
    (dimensions and thumbnail hash of each image). Null or broken media have null features.
    """
    more = ["n_bytes"] if "n_bytes" in media.columns else []
    names = ["__id", *more, "width", "height", "thumbnail", "media_bytes", "media_sha256", "thumbnail_sha256", "tail_crc32", "feature"]

    def read(data: bytes | None) -> tuple:
        if data is None:
            return (None,) * 8
        head = (len(data), hashlib.sha256(data).hexdigest())
        try:
            images = decode([data])[0]
        except (ValueError, KeyError, IndexError, struct.error):
            return None, None, None, *head, None, None, None
        return told(images, head)

    def told(images: list, head: tuple) -> tuple:
        samples = b"".join(t.tobytes() for _, _, t in images)
        feature = ";".join(f"{w}x{h}:{thumbnail_hash(t)}" for w, h, t in images)
        width, height = images[0][:2] if images else (None, None)
        return width, height, samples, *head, hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-16:]), feature

    def block(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
        for part in chunks_by_bytes(batches, "__media", 2 * BLOCK):
            data = part.column("__media").to_pylist()
            try:  # the usual case: all images of the chunk side by side
                found = [told(images, (len(d), hashlib.sha256(d).hexdigest())) for d, images in zip(data, decode(data), strict=True)]
            except (ValueError, KeyError, IndexError, struct.error, TypeError):
                found = [read(d) for d in data]
            columns = [pa.array([row[i] for row in found], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([part.column("__id"), *(part.column(c) for c in more), *columns], names)

    rows = media.select(F.col(id_col).alias("__id"), *more, F.col(media_col).alias("__media"))
    kind = rows.schema["__id"].dataType.simpleString()
    shape = f"__id {kind}, {'n_bytes bigint, ' if more else ''}width bigint, height bigint, thumbnail binary, media_bytes bigint, media_sha256 string, thumbnail_sha256 string, tail_crc32 bigint, feature string"
    return rows.mapInArrow(block, shape).withColumnRenamed("__id", id_col)
