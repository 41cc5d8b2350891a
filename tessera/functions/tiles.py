"""National map-sheet tile grid (TM35 sheets) as column expressions.

A level-9 name has 7 characters: row letter, column digit, three quadrant
digits, one letter of a 4x2 split and a final quadrant digit, e.g.
``L4113H3``. Levels 1, 3, 5 and 7 are half sheets named by a trailing L/R.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the grid.
ROW_LETTERS = "KLMNPQRSTUVWX"          # row 0..12 (no O)
COLUMN_DIGITS = "23456"                # legal column numbers
ORIGIN_X = 500000.0 - 5 * 192000.0     # lower-left easting of column 0
ORIGIN_Y = 6570000.0                   # lower-left northing of row K
# (width, height) in metres, by level 0..9
LEVEL_SIZES = (
    (192000, 96000), (96000, 96000), (96000, 48000), (48000, 48000), (48000, 24000),
    (24000, 24000), (24000, 12000), (12000, 12000), (6000, 6000), (3000, 3000),
)
QUADRANT_CODES = "1234"               # index 2*east + north: SW=1, NW=2, SE=3, NE=4
EIGHTH_CODES = "ABCDEFGH"             # index 2*east + north over a 4x2 split
# Anchor names, two synonym vocabularies -> (x offset, y offset) as tile fractions
ANCHORS = {
    "ll": (0.0, 0.0), "sw": (0.0, 0.0), "l": (0.0, 0.5), "w": (0.0, 0.5),
    "ul": (0.0, 1.0), "nw": (0.0, 1.0), "d": (0.5, 0.0), "s": (0.5, 0.0),
    "c": (0.5, 0.5), "0": (0.5, 0.5), "u": (0.5, 1.0), "n": (0.5, 1.0),
    "lr": (1.0, 0.0), "se": (1.0, 0.0), "r": (1.0, 0.5), "e": (1.0, 0.5),
    "ur": (1.0, 1.0), "ne": (1.0, 1.0),
}

# Split sizes along north (rows) and east (columns) for the six subdivisions.
_NORTH_STEPS = (96000.0, 48000.0, 24000.0, 12000.0, 6000.0, 3000.0)
_EAST_STEPS = (192000.0, 96000.0, 48000.0, 24000.0, 6000.0, 3000.0)

_BASE = f"[{ROW_LETTERS}][{COLUMN_DIGITS}]"
# level -> full-match pattern of a well-formed name
LEVEL_PATTERNS = (
    (0, f"^{_BASE}\\z"),
    (1, f"^{_BASE}[LR]\\z"),
    (2, f"^{_BASE}[1-4]\\z"),
    (3, f"^{_BASE}[1-4][LR]\\z"),
    (4, f"^{_BASE}[1-4]{{2}}\\z"),
    (5, f"^{_BASE}[1-4]{{2}}[LR]\\z"),
    (6, f"^{_BASE}[1-4]{{3}}\\z"),
    (7, f"^{_BASE}[1-4]{{3}}[LR]\\z"),
    (8, f"^{_BASE}[1-4]{{3}}[A-H]\\z"),
    (9, f"^{_BASE}[1-4]{{3}}[A-H][1-4]\\z"),
)


def _c(v: Column | str) -> Column:
    return F.col(v) if isinstance(v, str) else v


def _split_digit(dist: Column, outer: float, inner: float) -> Column:
    """Which `inner`-sized slot of its `outer` cell a distance falls in (exact
    integer quotient, as floor division with a non-negative remainder)."""
    return F.round((F.pmod(dist, F.lit(outer)) - F.pmod(dist, F.lit(inner))) / F.lit(inner)).cast("int")


def inside_grid(x: Column | str, y: Column | str) -> Column:
    """True exactly where :func:`tile_of_xy` gives a name (rows K..X,
    columns 2..6): a plain bounding box, cheap to evaluate and to push down."""
    x0 = ORIGIN_X + 2 * _EAST_STEPS[0]
    x1 = ORIGIN_X + 7 * _EAST_STEPS[0]
    y1 = ORIGIN_Y + len(ROW_LETTERS) * _NORTH_STEPS[0]
    return (_c(x) >= x0) & (_c(x) < x1) & (_c(y) >= ORIGIN_Y) & (_c(y) < y1)


def tile_of_xy(x: Column | str, y: Column | str) -> Column:
    """Level-9 tile name of a point; null outside rows K..X / columns 2..6."""
    north = _c(y) - F.lit(ORIGIN_Y)
    east = _c(x) - F.lit(ORIGIN_X)
    row = F.round((north - F.pmod(north, F.lit(_NORTH_STEPS[0]))) / F.lit(_NORTH_STEPS[0]))
    col = F.round((east - F.pmod(east, F.lit(_EAST_STEPS[0]))) / F.lit(_EAST_STEPS[0]))
    parts = []
    for j in range(1, 6):
        n = _split_digit(north, _NORTH_STEPS[j - 1], _NORTH_STEPS[j])
        e = _split_digit(east, _EAST_STEPS[j - 1], _EAST_STEPS[j])
        codes = EIGHTH_CODES if j == 4 else QUADRANT_CODES
        parts.append(F.substring(F.lit(codes), e * 2 + n + 1, 1))
    inside = row.between(0, len(ROW_LETTERS) - 1) & col.between(2, 6)
    name = F.concat(
        F.substring(F.lit(ROW_LETTERS), row.cast("int") + 1, 1),
        col.cast("int").cast("string"),
        *parts,
    )
    return F.when(inside, name)


def tile_level(tile: Column | str) -> Column:
    """Level 0..9 of a tile name, -1 when malformed (null name -> null)."""
    t = _c(tile)
    expr = F.when(t.isNull(), F.lit(None).cast("int"))
    for level, pattern in LEVEL_PATTERNS:
        expr = expr.when(t.rlike(pattern), F.lit(level))
    return expr.otherwise(F.lit(-1))


def tile_size(tile: Column | str, level: Column | str | None = None) -> tuple[Column, Column]:
    """(width, height) in metres; nulls for a malformed name. Pass a computed
    ``level`` column to avoid re-evaluating the name patterns."""
    level = tile_level(tile) if level is None else _c(level)
    widths = F.array(*[F.lit(w) for w, _ in LEVEL_SIZES])
    heights = F.array(*[F.lit(h) for _, h in LEVEL_SIZES])
    ok = level >= 0
    return (F.when(ok, F.element_at(widths, level + 1)),
            F.when(ok, F.element_at(heights, level + 1)))


def tile_rollup(tile: Column | str) -> Column:
    """Level-9 name -> array of its 10 names, level 0 first (index = level).

    Half sheets: level 2i+1 is the level-2i name plus L or R, chosen by the
    next character (1/2 -> L at levels 1, 3, 5; A-D -> L at level 7).
    """
    t = _c(tile)
    names = []
    for i in range(5):
        prefix = F.substring(t, 1, i + 2)
        names.append(prefix)
        if i < 4:
            nxt = F.substring(t, i + 3, 1)
            left = "ABCD" if i == 3 else "12"
            names.append(F.concat(prefix, F.when(nxt.isin(*left), F.lit("L")).otherwise(F.lit("R"))))
    names.append(t)
    return F.when(t.rlike(LEVEL_PATTERNS[9][1]), F.array(*names))


def tile_anchor(tile: Column | str, anchor: str = "sw",
                level: Column | str | None = None) -> tuple[Column, Column]:
    """(x, y) of a corner, edge middle or centre of a tile; nulls if malformed."""
    if anchor not in ANCHORS:
        raise ValueError(f"unknown anchor {anchor!r}; expected one of {sorted(ANCHORS)}")
    fx, fy = ANCHORS[anchor]
    t = _c(tile)
    level = tile_level(t) if level is None else _c(level)

    # A code's position p in its list is 2 * east + north; an R half sheet is
    # its parent's east half, an L one the west half (no offset).
    row = (F.instr(F.lit(ROW_LETTERS), F.substring(t, 1, 1)) - 1).cast("double")
    x = F.lit(ORIGIN_X) + F.substring(t, 2, 1).try_cast("double") * F.lit(_EAST_STEPS[0])
    y = F.lit(ORIGIN_Y) + row * F.lit(_NORTH_STEPS[0])
    for j in range(1, 6):
        code = F.substring(t, j + 2, 1)
        codes = EIGHTH_CODES if j == 4 else QUADRANT_CODES
        place = F.greatest(F.instr(F.lit(codes), code) - 1, F.lit(0))
        halves = len(codes) // 4  # east steps of a half sheet
        half = F.when((code == "R") & (F.length(t) == j + 2), F.lit(halves)).otherwise(F.lit(0))
        x = x + (F.floor(place / 2) + half) * F.lit(_EAST_STEPS[j])
        y = y + (place % 2) * F.lit(_NORTH_STEPS[j])
    w, h = tile_size(t, level)
    ok = level >= 0
    return (F.when(ok, x + F.lit(fx) * w.cast("double")),
            F.when(ok, y + F.lit(fy) * h.cast("double")))
