"""SQL twins of the catalog queries, written independently in plain SQL for
DuckDB over the same parquet tables (views ``events``, ``lineitem``,
``embeddings``, ...). Only shared constants are imported; the formulas are
written out again here."""

from __future__ import annotations

import math

from tessera.functions.cyclic import DAY_POINTS, WEEKDAY_NAMES
from tessera.sources import fixtures as FX
from tessera.sources.schemas import ACCIDENT_FIELDS

# Fixed values of the grid and the projection, written out here once more so
# that a slip in the library cannot pass its own twin.
GRID_ROWS = "KLMNPQRSTUVWX"
GRID_X, GRID_Y = -460000.0, 6570000.0
GRID_WIDTHS = (192000, 96000, 96000, 48000, 48000, 24000, 24000, 12000, 6000, 3000)
GRID_HEIGHTS = (96000, 96000, 48000, 48000, 24000, 24000, 12000, 12000, 6000, 3000)
GRID_NAMES = (
    "[KLMNPQRSTUVWX][23456]", "[KLMNPQRSTUVWX][23456][LR]", "[KLMNPQRSTUVWX][23456][1234]",
    "[KLMNPQRSTUVWX][23456][1234][LR]", "[KLMNPQRSTUVWX][23456][1234][1234]", "[KLMNPQRSTUVWX][23456][1234][1234][LR]",
    "[KLMNPQRSTUVWX][23456][1234][1234][1234]", "[KLMNPQRSTUVWX][23456][1234][1234][1234][LR]",
    "[KLMNPQRSTUVWX][23456][1234][1234][1234][ABCDEFGH]", "[KLMNPQRSTUVWX][23456][1234][1234][1234][ABCDEFGH][1234]",
)
GRID_ANCHORS = {
    "sw": (0, 0), "ll": (0, 0), "w": (0, 0.5), "l": (0, 0.5), "nw": (0, 1), "ul": (0, 1),
    "s": (0.5, 0), "d": (0.5, 0), "c": (0.5, 0.5), "0": (0.5, 0.5), "n": (0.5, 1), "u": (0.5, 1),
    "se": (1, 0), "lr": (1, 0), "e": (1, 0.5), "r": (1, 0.5), "ne": (1, 1), "ur": (1, 1),
}
_n = 1 / (2 * 298.257222101 - 1)
ECC = math.sqrt(2 / 298.257222101 - 1 / 298.257222101**2)
METRES = 0.9996 * 6378137.0 / (1 + _n) * (1 + _n**2 / 4 + _n**4 / 64)
ALPHA = (_n / 2 - _n**2 * 2 / 3 + _n**3 * 5 / 16 + _n**4 * 41 / 180, _n**2 * 13 / 48 - _n**3 * 3 / 5 + _n**4 * 557 / 1440,
         _n**3 * 61 / 240 - _n**4 * 103 / 140, _n**4 * 49561 / 161280)
BETA = (_n / 2 - _n**2 * 2 / 3 + _n**3 * 37 / 96 - _n**4 / 360, _n**2 / 48 + _n**3 / 15 - _n**4 * 437 / 1440,
        _n**3 * 17 / 480 - _n**4 * 37 / 840, _n**4 * 4397 / 161280)


def _f(v: float) -> str:
    return f"CAST('{v!r}' AS DOUBLE)"


WEEKDAYS_CTE = "weekdays(Vkpv, dow_x, dow_y) AS (VALUES " + ", ".join(
    f"('{n}', {_f(p[0])}, {_f(p[1])})" for n, p in zip(WEEKDAY_NAMES, DAY_POINTS)) + ")"

POINTS_CTE = f"""points AS (
  SELECT event_id AS id,
         CASE WHEN event_id % {FX.MISSING_X_EVERY} = 0 THEN NULL
              WHEN event_id % {FX.NAN_X_EVERY} = 0 THEN CAST('NaN' AS DOUBLE)
              ELSE CAST({FX.X_BASE} + (event_id * {FX.X_MULT}) % {FX.X_SPAN} AS DOUBLE) END AS X,
         CASE WHEN event_id % {FX.MISSING_Y_EVERY} <> 0
              THEN CAST({FX.Y_BASE} + (event_id * {FX.Y_MULT}) % {FX.Y_SPAN} AS DOUBLE) END AS Y,
         CASE WHEN event_id % {FX.BLANK_DAY_EVERY} = 0 THEN ' '
              WHEN event_id % {FX.UNKNOWN_DAY_EVERY} = 0 THEN '{FX.UNKNOWN_DAY}'
              ELSE [{", ".join(f"'{n}'" for n in WEEKDAY_NAMES)}][isodow(ts)] END AS Vkpv,
         CASE WHEN event_id % {FX.NO_TYPE_EVERY} <> 0 THEN event_type END AS event_type
  FROM events)"""

ENC_CTE = """enc AS (SELECT p.id, p.X, p.Y, p.event_type, w.dow_x, w.dow_y
             FROM points p LEFT JOIN weekdays w ON p.Vkpv = w.Vkpv)"""

CLEAN2_CTE = "clean2 AS (SELECT id, X, Y, event_type FROM points WHERE X IS NOT NULL AND NOT isnan(X) AND Y IS NOT NULL)"
CLEAN4_CTE = """clean4 AS (SELECT id, X, Y, dow_x, dow_y, event_type FROM enc
                WHERE X IS NOT NULL AND NOT isnan(X) AND Y IS NOT NULL AND dow_x IS NOT NULL AND dow_y IS NOT NULL)"""


def scaled(v: str, lo: str, hi: str) -> str:
    return f"(CASE WHEN {hi} = {lo} THEN 0.0 ELSE ({v} - {lo}) / ({hi} - {lo}) END)"


SCALED2_CTE = f"""b2 AS (SELECT min(X) lx, max(X) hx, min(Y) ly, max(Y) hy FROM clean2),
s2 AS (SELECT id, event_type, X, Y, {scaled('X', 'lx', 'hx')} AS X_scaled, {scaled('Y', 'ly', 'hy')} AS Y_scaled
       FROM clean2, b2)"""

SCALED4_CTE = f"""b4 AS (SELECT min(X) lx, max(X) hx, min(Y) ly, max(Y) hy,
                   min(dow_x) la, max(dow_x) ha, min(dow_y) lb, max(dow_y) hb FROM clean4),
s4 AS (SELECT id, event_type, X, Y, dow_x, dow_y,
              {scaled('X', 'lx', 'hx')} AS X_scaled, {scaled('Y', 'ly', 'hy')} AS Y_scaled,
              {scaled('dow_x', 'la', 'ha')} AS dow_x_scaled, {scaled('dow_y', 'lb', 'hb')} AS dow_y_scaled
       FROM clean4, b4)"""

# Lloyd features: scaled X, Y (each by its own range) and the raw weekday point.
LLOYD_PTS_CTE = f"""bl AS (SELECT min(X) lx, max(X) hx, min(Y) ly, max(Y) hy FROM clean4),
pts AS (SELECT id, X, Y, dow_x, dow_y, {scaled('X', 'lx', 'hx')} AS f1, {scaled('Y', 'ly', 'hy')} AS f2,
               dow_x AS f3, dow_y AS f4 FROM clean4, bl)"""


def with_ctes(*ctes: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(ctes) + "\n"


def decode(x: str, y: str) -> str:
    a = f"(atan2({y}, {x}) * 7 / (2 * pi()))"
    return f"(CASE WHEN {a} > 0 THEN {a} ELSE {a} + 7 END)"


def pmod(a: str, b: float) -> str:
    return f"((({a}) % CAST({b} AS DOUBLE) + CAST({b} AS DOUBLE)) % CAST({b} AS DOUBLE))"


def tile_sql(x: str, y: str) -> str:
    n = f"(({y}) - {GRID_Y})"
    e = f"(({x}) - ({GRID_X}))"
    ns = (96000.0, 48000.0, 24000.0, 12000.0, 6000.0, 3000.0)
    es = (192000.0, 96000.0, 48000.0, 24000.0, 6000.0, 3000.0)
    row = f"CAST(round(({n} - {pmod(n, ns[0])}) / {ns[0]}) AS INTEGER)"
    col = f"CAST(round(({e} - {pmod(e, es[0])}) / {es[0]}) AS INTEGER)"
    parts = []
    for j in range(1, 6):
        dn = f"CAST(round(({pmod(n, ns[j - 1])} - {pmod(n, ns[j])}) / {ns[j]}) AS INTEGER)"
        de = f"CAST(round(({pmod(e, es[j - 1])} - {pmod(e, es[j])}) / {es[j]}) AS INTEGER)"
        codes = "ABCDEFGH" if j == 4 else "1234"
        parts.append(f"substr('{codes}', {de} * 2 + {dn} + 1, 1)")
    name = " || ".join([f"substr('{GRID_ROWS}', {row} + 1, 1)", f"CAST({col} AS VARCHAR)"] + parts)
    return f"(CASE WHEN {row} BETWEEN 0 AND 12 AND {col} BETWEEN 2 AND 6 THEN {name} END)"


def level_sql(t: str) -> str:
    whens = " ".join(f"WHEN regexp_full_match({t}, '{pat}') THEN {lvl}" for lvl, pat in enumerate(GRID_NAMES))
    return f"(CASE WHEN {t} IS NULL THEN NULL {whens} ELSE -1 END)"


def rollup_sql(t: str) -> list[str]:
    """The 10 names of a level-9 tile, level 0 first."""
    out = []
    for i in range(5):
        prefix = f"substr({t}, 1, {i + 2})"
        out.append(prefix)
        if i < 4:
            left = "('A','B','C','D')" if i == 3 else "('1','2')"
            out.append(f"({prefix} || CASE WHEN substr({t}, {i + 3}, 1) IN {left} THEN 'L' ELSE 'R' END)")
    out.append(t)
    return out


def size_sql(t: str) -> tuple[str, str]:
    lv = level_sql(t)
    ws, hs = ", ".join(map(str, GRID_WIDTHS)), ", ".join(map(str, GRID_HEIGHTS))
    return (f"(CASE WHEN {lv} >= 0 THEN [{ws}][{lv} + 1] END)",
            f"(CASE WHEN {lv} >= 0 THEN [{hs}][{lv} + 1] END)")


# What a name's characters add: place in the name, the codes there, and the
# width and height of one of their cells. Codes count north first, then east;
# a half's letter moves east by the width of its level.
GRID_STEPS = ((2, "1234", 96000.0, 48000.0, 1), (3, "1234", 48000.0, 24000.0, 3), (4, "1234", 24000.0, 12000.0, 5),
              (5, "ABCDEFGH", 6000.0, 6000.0, 7), (6, "1234", 3000.0, 3000.0, 9))


def anchor_sql(t: str, anchor: str) -> tuple[str, str]:
    """x, y of an anchor of tile ``t``, null where the name is malformed."""
    x = f"{_f(GRID_X)} + TRY_CAST(substr({t}, 2, 1) AS DOUBLE) * {GRID_WIDTHS[0]}"
    y = f"{_f(GRID_Y)} + (instr('{GRID_ROWS}', substr({t}, 1, 1)) - 1) * {GRID_HEIGHTS[0]}::DOUBLE"
    for at, codes, width, height, half in GRID_STEPS:
        code = f"(strpos('{codes}', substr({t}, {at + 1}, 1)) - 1)"
        own = f"length({t}) > {at} AND {code} >= 0"
        x += f" + CASE WHEN {own} THEN ({code} // 2) * {width}::DOUBLE WHEN substr({t}, {at + 1}, 1) = 'R' THEN {GRID_WIDTHS[half]}::DOUBLE ELSE 0::DOUBLE END"
        y += f" + CASE WHEN {own} THEN ({code} % 2) * {height}::DOUBLE ELSE 0::DOUBLE END"
    (fx, fy), (w, h), lv = GRID_ANCHORS[anchor], size_sql(t), level_sql(t)
    return f"(CASE WHEN {lv} >= 0 THEN {x} + {fx} * {w} END)", f"(CASE WHEN {lv} >= 0 THEN {y} + {fy} * {h} END)"


def latlon_sql(x: str, y: str) -> tuple[str, str]:
    """Inverse Krüger series in SQL (independent of the Column builder)."""
    xi = f"(({y}) / {METRES!r})"
    eta = f"((({x}) - 500000.0) / {METRES!r})"
    xip = xi + "".join(f" - {b!r} * sin({2 * j} * {xi}) * cosh({2 * j} * {eta})" for j, b in enumerate(BETA, 1))
    etap = eta + "".join(f" - {b!r} * cos({2 * j} * {xi}) * sinh({2 * j} * {eta})" for j, b in enumerate(BETA, 1))
    xip, etap = f"({xip})", f"({etap})"
    psi = f"asinh(sin({xip}) / sqrt(sinh({etap}) * sinh({etap}) + cos({xip}) * cos({xip})))"
    q = psi
    for _ in range(5):
        q = f"({psi} + {ECC!r} * atanh({ECC!r} * tanh({q})))"
    lat = f"degrees(atan(sinh({q})))"
    lon = f"(27.0 + degrees(atan2(sinh({etap}), cos({xip}))))"
    return lat, lon


def xy_sql(lat: str, lon: str) -> tuple[str, str]:
    """Forward Krüger series in SQL."""
    phi = f"radians({lat})"
    lam = f"(radians({lon}) - {math.radians(27.0)!r})"
    t = f"sinh(atanh(sin({phi})) - {ECC!r} * atanh({ECC!r} * sin({phi})))"
    xip = f"atan2({t}, cos({lam}))"
    etap = f"atanh(sin({lam}) / sqrt(1.0 + {t} * {t}))"
    xi = xip + "".join(f" + {a!r} * sin({2 * j} * {xip}) * cosh({2 * j} * {etap})" for j, a in enumerate(ALPHA, 1))
    eta = etap + "".join(f" + {a!r} * cos({2 * j} * {xip}) * sinh({2 * j} * {etap})" for j, a in enumerate(ALPHA, 1))
    return f"(500000.0 + {METRES!r} * ({eta}))", f"({METRES!r} * ({xi}))"


def line_places_cte(seed: int, k: int) -> str:
    """``seeds``: the first k places made from lines' keys, in md5 order."""
    return f"""places AS (
  SELECT id, (id * 7919 % 100003) / 100003.0::DOUBLE AS f1, (id * 104729 % 100019) / 100019.0::DOUBLE AS f2,
         (id * 31 % 2003) / 1001.5::DOUBLE - 1.0 AS f3, (id * 17 % 1999) / 999.5::DOUBLE - 1.0 AS f4
  FROM (SELECT DISTINCT CAST(l_orderkey * 8 + l_linenumber AS BIGINT) AS id FROM lineitem)),
seeds AS (SELECT row_number() OVER (ORDER BY md5(CAST(id AS VARCHAR) || ':{seed}'), id) - 1 AS idx, id, f1, f2, f3, f4
          FROM places ORDER BY md5(CAST(id AS VARCHAR) || ':{seed}'), id LIMIT {k})"""


def types_sql() -> str:
    """Report of the 102 columns; only four of them hold anything."""
    def held(at, name, kind, text):
        return (f"SELECT {at} AS position, '{name}' AS name, '{kind}' AS type, count(*) AS n_rows, "
                f"count(*) FILTER ({text} = '') AS n_null, CAST(max(length({text})) AS INTEGER) AS width FROM points")

    known = {
        "Onnett_id": ("integer", "CAST(id AS VARCHAR)"), "Vkpv": ("string", "trim(Vkpv)"),
        "X": ("double", "(CASE WHEN X IS NULL THEN '' WHEN isnan(X) THEN 'NaN' ELSE CAST(CAST(X AS BIGINT) AS VARCHAR) END)"),
        "Y": ("integer", "coalesce(CAST(CAST(Y AS BIGINT) AS VARCHAR), '')")}
    parts = [held(i, n, *known[n]) if n in known else
             f"SELECT {i}, '{n}', 'null', count(*), count(*), 0 FROM points" for i, (n, _) in enumerate(ACCIDENT_FIELDS)]
    return " UNION ALL ".join(parts)


def described_sql() -> str:
    return f"""WITH accident AS (SELECT o_orderkey AS a FROM orders WHERE o_orderkey % {FX.NO_ACCIDENT_EVERY} <> 0),
party0 AS (SELECT l_orderkey AS a, CASE WHEN l_partkey % {FX.NO_KEY_EVERY} <> 0 THEN l_linenumber END AS o FROM lineitem
           WHERE (l_orderkey + l_linenumber) % {FX.NO_PARTY_EVERY} <> 0),
party AS (SELECT * FROM party0 UNION ALL SELECT * FROM party0 WHERE a % {FX.TWICE_EVERY} = 0),
person AS (SELECT l_orderkey AS a, l_linenumber AS o, l_orderkey * 8 + l_linenumber AS h FROM lineitem)
SELECT 'accident' AS "table", (SELECT count(*) FROM accident) AS n_rows, CAST(0 AS BIGINT) AS n_broken,
       (SELECT count(a) - count(DISTINCT a) FROM accident) AS n_repeated, CAST(0 AS BIGINT) AS n_orphans
UNION ALL
SELECT 'party', (SELECT count(*) FROM party), (SELECT count(*) FROM party WHERE o IS NULL),
       (SELECT count(*) - count(DISTINCT (a, o)) FROM party WHERE o IS NOT NULL),
       (SELECT count(*) FROM party WHERE a NOT IN (SELECT a FROM accident))
UNION ALL
SELECT 'person', (SELECT count(*) FROM person), 0, (SELECT count(*) - count(DISTINCT (a, o, h)) FROM person),
       (SELECT count(*) FROM person WHERE a NOT IN (SELECT a FROM accident))
       + (SELECT count(*) FROM person p WHERE NOT EXISTS (SELECT 1 FROM party q WHERE q.a = p.a AND q.o = p.o))"""


# Ellipsoid, meridian, scale and false easting of the grids, and
# the old datum's shift to WGS 84.
OLD_ELLIPSOID, OLD_SHIFT = (6378388.0, 297.0), (-96.062, -82.428, -121.753, 4.801, 0.345, -1.376, 1.496)
GRID_ROWS_SQL = {
    2391: (*OLD_ELLIPSOID, 21.0, 1.0, 1500000.0, True), 2392: (*OLD_ELLIPSOID, 24.0, 1.0, 2500000.0, True),
    2393: (*OLD_ELLIPSOID, 27.0, 1.0, 3500000.0, True), 2394: (*OLD_ELLIPSOID, 30.0, 1.0, 4500000.0, True),
    32634: (6378137.0, 298.257223563, 21.0, 0.9996, 500000.0, False), 32635: (6378137.0, 298.257223563, 27.0, 0.9996, 500000.0, False),
    32636: (6378137.0, 298.257223563, 33.0, 0.9996, 500000.0, False)}


def _rotation() -> tuple[list[float], list[list[float]]]:
    """The old datum's shift as offsets and a matrix of numbers."""
    x, y, z = (r / 3600.0 * math.pi / 180.0 for r in OLD_SHIFT[3:6])
    s = 1.0 + OLD_SHIFT[6] / 1e6
    return list(OLD_SHIFT[:3]), [[s, -s * z, s * y], [s * z, s, -s * x], [-s * y, s * x, s]]


def _solved(m: list[list[float]], v: list[str]) -> list[str]:
    """SQL of the solution of m * u = v by Cramer's rule."""
    def det(a):
        return (a[0][0] * (a[1][1] * a[2][2] - a[1][2] * a[2][1]) - a[0][1] * (a[1][0] * a[2][2] - a[1][2] * a[2][0])
                + a[0][2] * (a[1][0] * a[2][1] - a[1][1] * a[2][0]))

    whole = det(m)
    out = []
    for k in range(3):
        terms = []
        for i in range(3):
            unit = [[1.0 if r == i else 0.0] for r in range(3)]
            terms.append(f"{_f(det([[unit[r][0] if c == k else m[r][c] for c in range(3)] for r in range(3)]) / whole)} * ({v[i]})")
        out.append("(" + " + ".join(terms) + ")")
    return out


def _geographic(x: str, y: str, z: str, a: float, inv_f: float) -> tuple[str, str]:
    """Latitude and longitude (radians) of a geocentric point near the ground,
    by repeated substitution."""
    e2 = 2 / inv_f - 1 / inv_f**2
    p = f"sqrt({x} * {x} + {y} * {y})"
    lat = f"atan2({z}, {p} * {1 - e2!r})"
    for _ in range(5):
        lat = f"atan2({z} + {e2 * a!r} * sin({lat}) / sqrt(1.0 - {e2!r} * sin({lat}) * sin({lat})), {p})"
    return lat, f"atan2({y}, {x})"


def grids_sql(codes) -> str:
    """Grid points in other grids: the forward series with the grids' numbers
    as columns, on latitudes and longitudes of each grid's datum."""
    lat, lon = latlon_sql("X", "Y")
    e2 = 2 / 298.257222101 - 1 / 298.257222101**2
    move, turn = _rotation()
    old = _solved(turn, [f"g{c} - {_f(m)}" for c, m in zip("xyz", move)])
    olat, olon = _geographic("ox", "oy", "oz", *OLD_ELLIPSOID)
    rows = ", ".join(f"({c}, {', '.join(_f(v) for v in GRID_ROWS_SQL[c][:5])}, {str(GRID_ROWS_SQL[c][5]).lower()})" for c in codes)
    series = ("(n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180)", "(13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440)",
              "(61 * n**3 / 240 - 103 * n**4 / 140)", "(49561 * n**4 / 161280)")
    xi = "xp" + "".join(f" + {h} * sin({2 * j}.0 * xp) * cosh({2 * j}.0 * ep)" for j, h in enumerate(series, 1))
    eta = "ep" + "".join(f" + {h} * cos({2 * j}.0 * xp) * sinh({2 * j}.0 * ep)" for j, h in enumerate(series, 1))
    return f"""grids(epsg, a, f, mer, k0, fe, old) AS (VALUES {rows}),
geo AS (SELECT id, radians({lat}) AS p, radians({lon}) AS l FROM clean2),
air AS (SELECT *, 6378137.0 / sqrt(1.0 - {e2!r} * sin(p) * sin(p)) AS r FROM geo),
xyz AS (SELECT id, p, l, r * cos(p) * cos(l) AS gx, r * cos(p) * sin(l) AS gy, {1 - e2!r} * r * sin(p) AS gz FROM air),
past AS (SELECT id, p, l, {old[0]} AS ox, {old[1]} AS oy, {old[2]} AS oz FROM xyz),
both_ AS (SELECT id, p, l, {olat} AS op, {olon} AS ol FROM past),
met AS (SELECT b.id, g.*, CASE WHEN g.old THEN op ELSE p END AS lat, (CASE WHEN g.old THEN ol ELSE l END) - radians(g.mer) AS d,
               1.0 / (2.0 * g.f - 1.0) AS n, sqrt(2.0 / g.f - 1.0 / (g.f * g.f)) AS e FROM both_ b, grids g),
conf AS (SELECT *, sinh(atanh(sin(lat)) - e * atanh(e * sin(lat))) AS t FROM met),
sph AS (SELECT *, atan2(t, cos(d)) AS xp, atanh(sin(d) / sqrt(1.0 + t * t)) AS ep FROM conf),
done AS (SELECT id, epsg, k0 * a / (1.0 + n) * (1.0 + n**2 / 4 + n**4 / 64) AS k, fe, {xi} AS xi, {eta} AS eta FROM sph)
SELECT id, CAST(epsg AS INTEGER) AS epsg, round(fe + k * eta, 3) AS easting, round(k * xi, 3) AS northing, true AS back_within_mm FROM done"""


def datums_sql(tile: str) -> str:
    """Points of the old datum in WGS 84, and the tile they are in."""
    a, inv_f = OLD_ELLIPSOID
    e2 = 2 / inv_f - 1 / inv_f**2
    move, turn = _rotation()
    new = [f"({_f(move[i])} + " + " + ".join(f"{_f(turn[i][j])} * g{c}" for j, c in enumerate("xyz")) + ")" for i in range(3)]
    wlat, wlon = _geographic("wx", "wy", "wz", 6378137.0, 298.257223563)
    glat, glon = _geographic("wx", "wy", "wz", 6378137.0, 298.257222101)
    gx, gy = xy_sql("glat", "glon")
    return f"""WITH places AS (SELECT event_id AS id, radians(60.0::DOUBLE + (event_id * 7919) % 990000 / 100000.0::DOUBLE) AS p,
               radians(20.0::DOUBLE + (event_id * 104729) % 1150000 / 100000.0::DOUBLE) AS l FROM events),
air AS (SELECT *, {a} / sqrt(1.0 - {e2!r} * sin(p) * sin(p)) AS r FROM places),
xyz AS (SELECT id, r * cos(p) * cos(l) AS gx, r * cos(p) * sin(l) AS gy, {1 - e2!r} * r * sin(p) AS gz FROM air),
now AS (SELECT id, {new[0]} AS wx, {new[1]} AS wy, {new[2]} AS wz FROM xyz),
ll AS (SELECT id, degrees({wlat}) AS lat, degrees({wlon}) AS lon, degrees({glat}) AS glat, degrees({glon}) AS glon FROM now),
grid AS (SELECT id, lat, lon, {gx} AS X, {gy} AS Y FROM ll)
SELECT id, round(lat, 7) AS lat, round(lon, 7) AS lon, {tile} AS tile FROM grid"""


def lloyd_recursive_cte(models: list[int], seed: int, tol: float, max_iter: int) -> str:
    """State of every pass of every model (one Lloyd run per k), as a
    recursive CTE named ``state``; relies on ``pts(id, f1..f4)``.

    Columns: pass, model, idx, f1..f4, n, sse, shift, stop. Pass 0 holds the
    seeds; a model stops after the pass whose total shift < tol or whose
    number exceeds max_iter.
    """
    kmax = max(models)
    mods = ", ".join(f"({m})" for m in models)
    d2 = " + ".join(f"(p.f{i} - c.f{i}) * (p.f{i} - c.f{i})" for i in range(1, 5))
    sse = " + ".join(f"var_pop(f{i}) * count(*)" for i in range(1, 5))
    mv = " + ".join(f"(coalesce(u.f{i}, c.f{i}) - c.f{i}) * (coalesce(u.f{i}, c.f{i}) - c.f{i})" for i in range(1, 5))
    means = ", ".join(
        f"CAST(sum(CAST(round_even(f{i} * {2.0**60!r}, 0) AS HUGEINT)) AS DOUBLE) / count(*) / {2.0**60!r} AS f{i}" for i in range(1, 5))
    return f"""models(k) AS (VALUES {mods}),
ordered AS (SELECT row_number() OVER (ORDER BY md5(CAST(id AS VARCHAR) || ':{seed}'), id) - 1 AS idx, f1, f2, f3, f4
            FROM pts ORDER BY md5(CAST(id AS VARCHAR) || ':{seed}'), id LIMIT {kmax}),
state(pass, model, idx, f1, f2, f3, f4, n, sse, shift, stop) AS (
  SELECT 0, m.k, o.idx, o.f1, o.f2, o.f3, o.f4, CAST(0 AS BIGINT), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), false
  FROM ordered o JOIN models m ON o.idx < m.k
  UNION ALL
  SELECT * FROM (
    WITH cur AS (SELECT * FROM state WHERE NOT stop),
    asg AS (SELECT c.model, p.id, p.f1, p.f2, p.f3, p.f4,
                   arg_min(c.idx, {{'d': {d2}, 'i': c.idx}}) AS idx
            FROM pts p, cur c GROUP BY c.model, p.id, p.f1, p.f2, p.f3, p.f4),
    upd AS (SELECT model, idx, count(*) AS n, {means},
                   {sse} AS sse
            FROM asg GROUP BY model, idx),
    nxt AS (SELECT c.pass + 1 AS pass, c.model, c.idx,
                   coalesce(u.f1, c.f1) AS f1, coalesce(u.f2, c.f2) AS f2,
                   coalesce(u.f3, c.f3) AS f3, coalesce(u.f4, c.f4) AS f4,
                   coalesce(u.n, 0) AS n, coalesce(u.sse, 0.0) AS sse, sqrt({mv}) AS mv
            FROM cur c LEFT JOIN upd u ON c.model = u.model AND c.idx = u.idx),
    tot AS (SELECT model, sum(mv) AS shift FROM nxt GROUP BY model)
    SELECT x.pass, x.model, x.idx, x.f1, x.f2, x.f3, x.f4, x.n, x.sse, t.shift,
           (t.shift < {tol!r} OR x.pass > {max_iter}) AS stop
    FROM nxt x JOIN tot t ON x.model = t.model))"""
