"""Hierarchical cells as 64-bit ids: expressions on ids, and a locator on a latitude/longitude grid.

Ids follow the common hexagon-index layout: mode 1 in bits 59-62, resolution in bits 52-55, base
cell in bits 45-51, then fifteen three-bit digits, 7 where unused. Parent, resolution and
text form are exact for any id in this layout.

The hexagon grid is in ``hexgrid``. The locator here is a grid of rectangles in the same layout:
120 base rectangles of 30 by 18 degrees, each split into seven, by turns along longitude and
latitude. Everything is a Column, so location stays in generated code, and its cells nest exactly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cellweave.errors import CellError

MAX_RESOLUTION = 15
_RES = 15 << 52
#: Base rectangles: columns, rows, and their sizes in degrees.
BASE_COLUMNS, BASE_ROWS, BASE_WIDTH, BASE_HEIGHT = 12, 10, 30.0, 18.0
MEAN_RADIUS_M = 6_371_008.8


def check_resolution(res: int) -> int:
    if not isinstance(res, int) or not 0 <= res <= MAX_RESOLUTION:
        raise CellError(f"resolution {res!r} is not within 0 and {MAX_RESOLUTION}")
    return res


def cell_resolution(cell: Column) -> Column:
    return F.shiftright(cell, 52).bitwiseAND(F.lit(15)).cast("int")


def cell_parent(cell: Column, res: int) -> Column:
    """The ancestor at ``res``; null where the cell is null or coarser than ``res``."""
    check_resolution(res)
    up = cell.bitwiseAND(F.lit(~_RES)).bitwiseOR(F.lit(res << 52)).bitwiseOR(F.lit((1 << 3 * (15 - res)) - 1))
    return F.when(cell_resolution(cell) >= res, up)


def cell_digit(cell: Column, level: int) -> Column:
    return F.shiftright(cell, 3 * (15 - level)).bitwiseAND(F.lit(7)).cast("int")


def cell_hex(cell: Column) -> Column:
    return F.lower(F.hex(cell))


def cell_from_hex(text: Column) -> Column:
    return F.conv(text, 16, 10).cast("long")


def cell_children(cell: Column, res: int) -> Column:
    """All descendants at ``res`` of a cell one level coarser, as an array of seven."""
    check_resolution(res)
    shift = 3 * (15 - res)
    base = cell.bitwiseAND(F.lit(~_RES)).bitwiseAND(F.lit(~(7 << shift))).bitwiseOR(F.lit(res << 52))
    return F.array(*[base.bitwiseOR(F.lit(d << shift)) for d in range(7)])


def cell_from_key(key: Column, res: int = 5, base_keys: int = 16_807) -> Column:
    """A cell for a whole number: its base-7 digits, with keys that share leading digits sharing parents."""
    check_resolution(res)
    out = F.lit((1 << 59) + (res << 52) + (1 << 3 * (15 - res)) - 1) + F.shiftleft((F.floor(key / base_keys) % 122).cast("long"), 45)
    for i in range(1, res + 1):
        out = out + F.shiftleft((F.floor(key / 7 ** (res - i)) % 7).cast("long"), 3 * (15 - i))
    return out


def _splits(res: int) -> tuple[int, int]:
    """Parts of a base rectangle along longitude and latitude at a resolution."""
    return 7 ** ((res + 1) // 2), 7 ** (res // 2)


def cell_at(lat: Column, lon: Column, res: int) -> Column:
    """The rectangle cell of a position. Longitude wraps, latitude 90 is in the top row; nulls and NaN give null."""
    check_resolution(res)
    across, up = _splits(MAX_RESOLUTION)
    col = F.floor((lon + 180.0) / BASE_WIDTH * float(across)).cast("long")
    col = F.pmod(F.when(lon < 180, F.least(col, F.lit(BASE_COLUMNS * across - 1))).otherwise(col), F.lit(BASE_COLUMNS * across))
    row = F.least(F.greatest(F.floor((lat + 90.0) / BASE_HEIGHT * float(up)).cast("long"), F.lit(0)), F.lit(BASE_ROWS * up - 1))
    # column and row of the finest cell, so that the cell of any resolution is an ancestor of the finer ones
    whole = lambda x, parts: F.floor(x / parts).cast("long")
    base = whole(row, up) * BASE_COLUMNS + whole(col, across)
    out = F.lit((1 << 59) + (res << 52) + (1 << 3 * (15 - res)) - 1) + F.shiftleft(base, 45)
    for level in range(1, res + 1):
        if level % 2:
            across //= 7
            digit = whole(col, across) % 7
        else:
            up //= 7
            digit = whole(row, up) % 7
        out = out + F.shiftleft(digit, 3 * (15 - level))
    valid = lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon) & lat.between(-90, 90)
    return F.when(valid, out)


def cell_box(cell: Column, res: int) -> Column:
    """west, south, east, north of a cell of the grid."""
    across, up = _splits(check_resolution(res))
    base = F.shiftright(cell, 45).bitwiseAND(F.lit(127))
    col, row = base % BASE_COLUMNS, F.floor(base / BASE_COLUMNS)
    for level in range(1, res + 1):
        if level % 2:
            col = col * 7 + cell_digit(cell, level)
        else:
            row = row * 7 + cell_digit(cell, level)
    w, h = BASE_WIDTH / across, BASE_HEIGHT / up
    west, south = col * w - 180.0, row * h - 90.0
    return F.struct(west.alias("west"), south.alias("south"), (west + w).alias("east"), (south + h).alias("north"))


def cell_center(cell: Column, res: int) -> Column:
    box = cell_box(cell, res)
    return F.struct(((box["south"] + box["north"]) / 2).alias("lat"), ((box["west"] + box["east"]) / 2).alias("lon"))


def cell_boundary_wkt(cell: Column, res: int) -> Column:
    """The cell's rectangle as a closed counter-clockwise ring."""
    b = cell_box(cell, res)
    corners = [("west", "south"), ("east", "south"), ("east", "north"), ("west", "north"), ("west", "south")]
    return F.concat(F.lit("POLYGON (("), F.concat_ws(", ", *[F.concat_ws(" ", b[x].cast("string"), b[y].cast("string")) for x, y in corners]), F.lit("))"))


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance on the mean sphere."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * MEAN_RADIUS_M) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))
