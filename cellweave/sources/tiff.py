"""TIFF files: tags, blocks within a window, and cloud-optimised copies with overviews."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

from cellweave.errors import FormatError

# Fixed values of the format: bytes and codes of field types.
FIELD_SIZE = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8, 16: 8, 17: 8}
FIELD_CODE = {1: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q", 17: "q"}
NONE, LZW, DEFLATE, OLD_DEFLATE = 1, 5, 8, 32946


@dataclass
class Image:
    """One image of a file: sizes, layout, and where its blocks are."""

    width: int
    height: int
    bands: int
    dtype: np.dtype
    packing: int
    predictor: int
    separate: bool
    tiled: bool
    block_width: int
    block_height: int
    offsets: tuple
    counts: tuple
    left: float
    top: float
    res_x: float
    res_y: float
    srid: int | None
    nodata: float | None


def _directories(raw: bytes) -> Iterator[dict[int, tuple]]:
    order = {b"II": "<", b"MM": ">"}.get(raw[:2])
    kind = struct.unpack(order + "H", raw[2:4])[0] if order and len(raw) >= 8 else 0
    if kind not in (42, 43):
        raise FormatError("not a TIFF file")
    big = kind == 43
    head, entry, word, width = ("Q", 20, "Q", 8) if big else ("H", 12, "I", 4)
    (at,) = struct.unpack(order + word, raw[8:16] if big else raw[4:8])
    seen = set()
    while at and at not in seen:
        seen.add(at)
        size = struct.calcsize(head)
        (n,) = struct.unpack(order + head, raw[at : at + size])
        tags: dict[int, tuple] = {0: (order,)}
        for i in range(n):
            e = at + size + entry * i
            tag, form = struct.unpack(order + "HH", raw[e : e + 4])
            (count,) = struct.unpack(order + word, raw[e + 4 : e + 4 + width])
            length, place = FIELD_SIZE.get(form, 1) * count, e + 4 + width
            if length > width:
                (place,) = struct.unpack(order + word, raw[place : place + width])
            body = raw[place : place + length]
            tags[tag] = (body.split(b"\0")[0].decode("latin-1"),) if form == 2 else struct.unpack(f"{order}{count}{FIELD_CODE[form]}", body) if form in FIELD_CODE else (body,)
        yield tags
        end = at + size + entry * n
        (at,) = struct.unpack(order + word, raw[end : end + width])


def images(raw: bytes) -> list[Image]:
    """The images of a file, the whole one first; classic and big files."""
    out = []
    for tags in _directories(raw):
        one = lambda tag, default=None: tags.get(tag, (default,))[0]  # noqa: B023, E731
        order, form, bits = tags[0][0], one(339, 1), one(258, 8)
        if form not in (1, 2, 3) or bits not in (8, 16, 32, 64):
            raise FormatError(f"samples of {bits} bits and format {form} are not supported")
        tiled = 322 in tags
        scale, tie, keys = tags.get(33550, (1.0, 1.0, 0.0)), tags.get(33922, (0.0,) * 6), tags.get(34735, ())
        text = one(42113, "")
        out.append(Image(
            one(256), one(257), one(277, 1), np.dtype(order + {1: "u", 2: "i", 3: "f"}[form] + str(bits // 8)), one(259, 1), one(317, 1), one(284, 1) == 2 and one(277, 1) > 1, tiled,
            one(322) if tiled else one(256), one(323) if tiled else one(278, one(257)), tags[324] if tiled else tags[273], tags[325] if tiled else tags[279],
            tie[3] - tie[0] * scale[0], tie[4] + tie[1] * scale[1], scale[0], scale[1],
            next((keys[k + 3] for k in range(4, len(keys) - 3, 4) if keys[k] in (2048, 3072)), None), float(text) if text.strip() else None,
        ))
    return out


def lzw_decode(data: bytes) -> bytes:
    """TIFF's LZW: codes of 9 to 12 bits, high bits first, wider one code early; 256 clears, 257 ends."""
    out, table = bytearray(), []
    held = bits = at = 0
    width, last = 9, b""
    while True:
        while bits < width:
            if at >= len(data):
                return bytes(out)
            held, bits, at = (held << 8 | data[at]) & 0xFFFFFFFF, bits + 8, at + 1
        code = held >> bits - width & (1 << width) - 1
        bits -= width
        if code == 257:
            return bytes(out)
        if code == 256:
            table, width, last = [bytes((i,)) for i in range(256)] + [b"", b""], 9, b""
            continue
        if not table:
            raise FormatError("LZW data without a first clear code")
        if code < len(table):
            word = table[code]
        elif code == len(table) and last:
            word = last + last[:1]
        else:
            raise FormatError("broken LZW data")
        if last:
            table.append(last + word[:1])
            if len(table) >= (1 << width) - 1 and width < 12:
                width += 1
        out += word
        last = word


def _unpack(body: bytes, packing: int) -> bytes:
    if packing == NONE:
        return body
    if packing in (DEFLATE, OLD_DEFLATE):
        return zlib.decompress(body)
    if packing == LZW:
        return lzw_decode(body)
    raise FormatError(f"compression {packing} is not supported")


def blocks(raw: bytes, image: Image, window: tuple[int, int, int, int] | None = None) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """First row, first column, first band and pixels (rows, columns, bands) of the blocks that meet a window.

    ``window`` is rows and columns from, to (exclusive); pixels beyond it and beyond the image are
    cut off. One block is unpacked at a time.
    """
    r0, r1, c0, c1 = window or (0, image.height, 0, image.width)
    r1, c1 = min(r1, image.height), min(c1, image.width)
    if image.predictor not in (1, 2):
        raise FormatError(f"predictor {image.predictor} is not supported")
    across, down = -(-image.width // image.block_width), -(-image.height // image.block_height)
    deep = 1 if image.separate else image.bands
    for i, (o, n) in enumerate(zip(image.offsets, image.counts, strict=True)):
        plane, place = divmod(i, across * down) if image.separate else (0, i)
        r, c = place // across * image.block_height, place % across * image.block_width
        if r >= r1 or c >= c1 or r + image.block_height <= r0 or c + image.block_width <= c0:
            continue
        rows = image.block_height if image.tiled else min(image.block_height, image.height - r)
        block = np.frombuffer(_unpack(raw[o : o + n], image.packing), image.dtype, rows * image.block_width * deep).reshape(rows, image.block_width, deep)
        if image.predictor == 2:
            block = np.cumsum(block, axis=1, dtype=image.dtype)
        top, left = max(r, r0), max(c, c0)
        yield top, left, plane, block[top - r : r1 - r, left - c : c1 - c]


def read_window(raw: bytes, image: Image, window: tuple[int, int, int, int] | None = None) -> np.ndarray:
    r0, r1, c0, c1 = window or (0, image.height, 0, image.width)
    out = np.zeros((max(0, min(r1, image.height) - r0), max(0, min(c1, image.width) - c0), image.bands), image.dtype)
    for r, c, band, block in blocks(raw, image, window):
        out[r - r0 : r - r0 + block.shape[0], c - c0 : c - c0 + block.shape[1], band : band + block.shape[2]] = block
    return out


def halve(data: np.ndarray, nodata: float | None, how: str) -> np.ndarray:
    """An overview of half the size: means of valid pixels (``bilinear``), or the first of four (``nearest``)."""
    if how == "nearest":
        return data[::2, ::2]
    if how != "bilinear":
        raise FormatError(f"no resampling {how!r}")
    h, w, n = data.shape
    padded = np.pad(data, ((0, h % 2), (0, w % 2), (0, 0)), mode="edge").astype(float)
    four = padded.reshape((h + 1) // 2, 2, (w + 1) // 2, 2, n).transpose(0, 2, 4, 1, 3).reshape((h + 1) // 2, (w + 1) // 2, n, 4)
    good = ~np.isnan(four) if nodata is None else ~np.isnan(four) & (four != nodata)
    count = good.sum(axis=-1)
    mean = np.where(good, four, 0).sum(axis=-1) / np.maximum(count, 1)
    if data.dtype.kind in "iu":
        mean = np.rint(mean)
    return np.where(count > 0, mean, np.nan if nodata is None and data.dtype.kind == "f" else nodata or 0).astype(data.dtype)


def write_cog(
    data: np.ndarray, left: float, top: float, res_x: float, res_y: float, nodata: float | None = None, srid: int = 4326, block: int = 512, levels: int = 6, resampling: str = "bilinear", deflate: bool = True, predictor: int | None = None
) -> bytes:
    """A cloud-optimised TIFF: all directories first, then tiles, those of the smallest overview first.

    Overviews halve the image until it fits one tile, at most ``levels`` times. Tiles are plain or
    deflated; ``predictor`` 2 stores differences of whole numbers.
    """
    data = np.ascontiguousarray(data if data.ndim == 3 else data[:, :, None]).astype(data.dtype.newbyteorder("<"))
    pyramid = [data]
    while len(pyramid) <= levels and max(pyramid[-1].shape[:2]) > block:
        pyramid.append(halve(pyramid[-1], nodata, resampling))
    predictor = 2 if predictor == 2 and data.dtype.kind in "iu" else 1
    tiles: list[list[bytes]] = []
    for image in pyramid:
        h, w, n = image.shape
        own = []
        for r in range(0, h, block):
            for c in range(0, w, block):
                tile = np.zeros((block, block, n), data.dtype)
                part = image[r : r + block, c : c + block]
                tile[: part.shape[0], : part.shape[1]] = part
                if predictor == 2:
                    tile[:, 1:] = tile[:, 1:] - tile[:, :-1]
                own.append(zlib.compress(tile.tobytes()) if deflate else tile.tobytes())
        tiles.append(own)

    def directory(level: int, offsets: list[int], at: int, last: bool) -> bytes:
        h, w, n = pyramid[level].shape
        keys = (1, 1, 0, 3, 1024, 0, 1, 2 if srid == 4326 else 1, 1025, 0, 1, 1, 2048 if srid == 4326 else 3072, 0, 1, srid)
        entries = [
            (254, 4, (0 if level == 0 else 1,)), (256, 4, (w,)), (257, 4, (h,)), (258, 3, (data.dtype.itemsize * 8,) * n), (259, 3, (DEFLATE if deflate else NONE,)), (262, 3, (1,)), (277, 3, (n,)),
            (284, 3, (1,)), (317, 3, (predictor,)), (322, 4, (block,)), (323, 4, (block,)), (324, 4, tuple(offsets)), (325, 4, tuple(map(len, tiles[level]))),
            (339, 3, ({"u": 1, "i": 2, "f": 3}[data.dtype.kind],) * n),
        ]
        if level == 0:
            entries += [(33550, 12, (res_x, res_y, 0.0)), (33922, 12, (0.0, 0.0, 0.0, left, top, 0.0)), (34735, 3, keys)]
            if nodata is not None:
                entries.append((42113, 2, f"{nodata!r}".encode() + b"\0"))
        size, body, extra = 2 + 12 * len(entries) + 4, struct.pack("<H", len(entries)), b""
        for tag, form, values in entries:
            packed = values if form == 2 else struct.pack(f"<{len(values)}{FIELD_CODE[form]}", *values)
            if len(packed) <= 4:
                place = packed.ljust(4, b"\0")
            else:
                place = struct.pack("<I", at + size + len(extra))
                extra += packed + b"\0" * (len(packed) % 2)
            body += struct.pack("<HHI", tag, form, len(values)) + place
        return body + struct.pack("<I", 0 if last else at + size + len(extra)) + extra

    order = range(len(pyramid))
    lengths = [len(directory(i, [0] * len(tiles[i]), 0, True)) for i in order]
    at = 8 + sum(lengths)
    offsets: list[list[int]] = [[] for _ in order]
    for i in reversed(order):
        for tile in tiles[i]:
            offsets[i].append(at)
            at += len(tile)
    if at >= 1 << 32:
        raise FormatError("the copy needs a big TIFF")
    head, out = 8, [b"II*\0" + struct.pack("<I", 8)]
    for i in order:
        out.append(directory(i, offsets[i], head, i == len(pyramid) - 1))
        head += lengths[i]
    for i in reversed(order):
        out += tiles[i]
    return b"".join(out)
