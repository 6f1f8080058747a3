"""Image bytes: TIFF's compressions and layouts, and PNG with a palette."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa

from framespan.sources.ranged import directories, exactly, value

PNG_HEAD = b"\x89PNG\r\n\x1a\n"


def lzw(data: bytes, limit: int) -> bytes:
    """TIFF's LZW: codes of 9 to 12 bits, first bit first, widened one code early; at most `limit` bytes."""
    first = [bytes([k]) for k in range(256)] + [b"", b""]
    table, width, before = list(first), 9, b""
    out = bytearray()
    held = bits = at = 0
    while len(out) < limit:
        while bits < width:
            if at == len(data):
                raise ValueError("truncated")
            held, bits, at = held << 8 | data[at], bits + 8, at + 1
        bits -= width
        code, held = held >> bits, held & (1 << bits) - 1
        if code == 257:
            break
        if code == 256:
            table, width, before = list(first), 9, b""
            continue
        if code < len(table):
            entry = table[code]
        elif before and code == len(table):
            entry = before + before[:1]
        else:
            raise ValueError("a code before its entry")
        if before:
            table.append(before + entry[:1])
        out += entry
        before = entry
        if len(table) + 1 >= 1 << width and width < 12:
            width += 1
    return bytes(out)


def packed_runs(data: bytes, limit: int) -> bytes:
    """Runs as a count and a byte, and stretches as a count and their bytes."""
    out, at = bytearray(), 0
    while len(out) < limit:
        if at >= len(data):
            raise ValueError("truncated")
        n, at = data[at], at + 1
        if n < 128:
            out += data[at : at + n + 1]
            at += n + 1
        elif n > 128:
            if at >= len(data):
                raise ValueError("truncated")
            out += data[at : at + 1] * (257 - n)
            at += 1
    return bytes(out)


def deflated(data: bytes, limit: int) -> bytes:
    try:
        return zlib.decompressobj().decompress(data, limit)
    except zlib.error as error:
        raise ValueError(str(error)) from error


#: compression tag -> expansion to a number of bytes
EXPAND = {1: lambda data, limit: data, 5: lzw, 8: deflated, 32946: deflated, 32773: packed_runs}


def read_tiff(data: bytes, height: int | None = None, width: int | None = None) -> tuple[int, int, np.ndarray]:
    """Height, width and the first channel of a 16-bit TIFF of one page, as a flat array.

    Strips and tiles; plain, LZW, deflate and packed runs; horizontal differences; both byte orders, classic and big."""
    source = pa.BufferReader(data)
    pages = list(directories(source))
    if len(pages) != 1:
        raise ValueError("more than one page" if pages else "no page")
    order, fields = pages[0]

    def tag(number: int, *default: int) -> tuple:
        if number not in fields and not default:
            raise ValueError(f"no tag {number}")
        return value(source, order, fields[number]) if number in fields else default

    w, h, samples, compression = tag(256)[0], tag(257)[0], tag(277, 1)[0], tag(259, 1)[0]
    if set(tag(258, 1)) != {16}:
        raise ValueError("not 16 bits a sample")
    if compression not in EXPAND or tag(266, 1)[0] != 1 or tag(317, 1)[0] not in (1, 2):
        raise ValueError("compressed in another way")
    if samples > 1 and tag(284, 1)[0] != 1:
        raise ValueError("channels apart")
    if (height and h != height) or (width and w != width):
        raise ValueError(f"shape {h}x{w}")
    tiled = 322 in fields
    part_w, part_h = (tag(322)[0], tag(323)[0]) if tiled else (w, min(h, tag(278, h)[0]))
    if not (w and h and part_w and part_h and samples):
        raise ValueError("no pixels")
    offsets = tag(324 if tiled else 273)
    sizes = tag(325 if tiled else 279, *([2 * part_w * part_h * samples] if compression == 1 and len(offsets) == 1 else []))
    across, down = -(-w // part_w), -(-h // part_h)
    if len(offsets) < across * down or len(sizes) < across * down:
        raise ValueError("truncated")
    image = np.zeros((down * part_h, across * part_w), np.int32)
    for k in range(across * down):
        y, x = k // across * part_h, k % across * part_w
        rows = part_h if tiled else min(part_h, h - y)
        need = 2 * part_w * rows * samples
        raw = EXPAND[compression](exactly(source, offsets[k], sizes[k]), need)
        if len(raw) < need:
            raise ValueError("truncated")
        cells = np.frombuffer(raw, order + "u2", need // 2).reshape(rows, part_w, samples)
        if tag(317, 1)[0] == 2:
            cells = np.cumsum(cells, axis=1, dtype=np.uint16)
        image[y : y + rows, x : x + part_w] = cells[:, :, 0]
    return h, w, np.ascontiguousarray(image[:h, :w]).ravel()


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def write_palette_png(cells: np.ndarray, palette: bytes) -> bytes:
    """A PNG whose pixels are the indices `cells` (rows of bytes) into a palette of RGB triples."""
    height, width = cells.shape
    raw = np.pad(cells.astype(np.uint8), ((0, 0), (1, 0))).tobytes()  # rows without a filter
    return PNG_HEAD + _chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 3, 0, 0, 0)) + _chunk(b"PLTE", palette) + _chunk(b"IDAT", zlib.compress(raw, 9)) + _chunk(b"IEND", b"")


def read_index_png(data: bytes) -> tuple[np.ndarray, bytes | None]:
    """The rows of indices and the palette, or gray levels and None, of a PNG of one channel with up to 8 bits, not interlaced."""
    if data[:8] != PNG_HEAD:
        raise ValueError("not a PNG")
    at, packed, head, palette = 8, b"", None, None
    while at + 8 <= len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + n]
        if len(body) < n or len(data) < at + 12 + n or struct.unpack(">I", data[at + 8 + n : at + 12 + n])[0] != zlib.crc32(kind + body):
            raise ValueError("truncated or damaged")
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"PLTE":
            palette = body
        elif kind == b"IDAT":
            packed += body
        elif kind == b"IEND":
            break
        at += 12 + n
    else:
        raise ValueError("truncated")
    if head is None or head[3] not in (0, 3) or head[2] > 8 or head[6]:
        raise ValueError("not one channel of 8 bits")
    width, height, depth = head[:3]
    wide = -(-width * depth // 8)
    raw = np.frombuffer(deflated(packed, height * (wide + 1)), np.uint8)
    if len(raw) < height * (wide + 1):
        raise ValueError("truncated")
    lines = raw.reshape(height, wide + 1)
    out, above = np.zeros((height, wide), np.uint8), np.zeros(wide, np.uint8)
    for y in range(height):
        kind, line = lines[y, 0], lines[y, 1:]
        if kind == 0:
            above = line
        elif kind == 1:
            above = np.cumsum(line, dtype=np.uint8)
        elif kind == 2:
            above = line + above
        elif kind in (3, 4):
            row, left, corner = bytearray(wide), 0, 0
            for x, (cell, up) in enumerate(zip(line.tolist(), above.tolist(), strict=True)):
                if kind == 3:
                    guess = left + up >> 1
                else:
                    guess = min((left, up, corner), key=lambda v: abs(left + up - corner - v))  # noqa: B023  the first of the least
                left, corner = (cell + guess) & 255, up
                row[x] = left
            above = np.frombuffer(bytes(row), np.uint8)
        else:
            raise ValueError("an unknown filter")
        out[y] = above
    if depth < 8:
        bits = np.unpackbits(out, axis=1).reshape(height, -1, depth)
        out = (bits << np.arange(depth - 1, -1, -1, dtype=np.uint8)).sum(2).astype(np.uint8)[:, :width]
    return out, palette if head[3] == 3 else None
