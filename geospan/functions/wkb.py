"""Per-value geometry codecs used inside Arrow-batched UDFs.

Spark SQL cannot reinterpret bytes as doubles, so reading WKB envelopes (and
writing WKB for the GeoParquet sink) is the one place where per-value Python
runs.  Everything here is small, dependency-free and called only from
``pandas_udf`` kernels, never on the driver for whole tables.
"""

from __future__ import annotations

import json
import math
import re
import struct

import numpy as np

# WKB geometry type codes (ISO 19125 / OGC simple features), fixed values.
POINT, LINESTRING, POLYGON = 1, 2, 3
MULTIPOINT, MULTILINESTRING, MULTIPOLYGON, GEOMETRYCOLLECTION = 4, 5, 6, 7
# Extended (EWKB) flag bits, fixed values.
EWKB_Z, EWKB_M, EWKB_SRID = 0x80000000, 0x40000000, 0x20000000

_COLLECTION_TYPES = {MULTIPOINT, MULTILINESTRING, MULTIPOLYGON, GEOMETRYCOLLECTION,
                     12, 13, 15, 16}  # 12/13 multisurface/-curve, 15/16 polyhedral/TIN


class WKBError(ValueError):
    pass


def readable(read, value):
    """``read(value)``, or None if the value is broken."""
    try:
        return read(value)
    except (ValueError, IndexError, KeyError, TypeError, AttributeError, AssertionError,
            struct.error, RecursionError):
        return None


def _coords_bounds(buf, pos, n, dims, dt):
    if n == 0:
        return pos, None
    end = pos + 8 * n * dims
    if end > len(buf):
        raise WKBError("truncated coordinates")
    arr = np.frombuffer(buf, dtype=dt, count=n * dims, offset=pos).reshape(n, dims)
    xs, ys = arr[:, 0], arr[:, 1]
    ok = ~(np.isnan(xs) | np.isnan(ys))
    if not ok.any():
        return end, None
    xs, ys = xs[ok], ys[ok]
    return end, (float(xs.min()), float(ys.min()), float(xs.max()), float(ys.max()))


def _merge(a, b):
    if a is None:
        return b
    if b is None:
        return a
    return (min(a[0], b[0]), min(a[1], b[1]), max(a[2], b[2]), max(a[3], b[3]))


def _read(buf, pos):
    if pos + 5 > len(buf):
        raise WKBError("truncated header")
    order = buf[pos]
    if order not in (0, 1):
        raise WKBError("bad byte order")
    end = "<" if order == 1 else ">"
    dt = np.dtype(end + "f8")
    (code,) = struct.unpack_from(end + "I", buf, pos + 1)
    pos += 5
    has_z = bool(code & EWKB_Z)
    has_m = bool(code & EWKB_M)
    if code & EWKB_SRID:
        pos += 4
    code &= 0x0FFFFFFF
    base, iso = code % 1000, code // 1000
    dims = 2 + int(has_z) + int(has_m) + (1 if iso in (1, 2) else 2 if iso == 3 else 0)
    if base == POINT:
        return _coords_bounds(buf, pos, 1, dims, dt)
    if base == LINESTRING:
        (n,) = struct.unpack_from(end + "I", buf, pos)
        return _coords_bounds(buf, pos + 4, n, dims, dt)
    if base in (POLYGON, 17):  # 17 = triangle, stored like a polygon
        (nrings,) = struct.unpack_from(end + "I", buf, pos)
        pos += 4
        box = None
        for _ in range(nrings):
            (n,) = struct.unpack_from(end + "I", buf, pos)
            pos, b = _coords_bounds(buf, pos + 4, n, dims, dt)
            box = _merge(box, b)
        return pos, box
    if base in _COLLECTION_TYPES:
        (nparts,) = struct.unpack_from(end + "I", buf, pos)
        pos += 4
        box = None
        for _ in range(nparts):
            pos, b = _read(buf, pos)
            box = _merge(box, b)
        return pos, box
    raise WKBError(f"unsupported geometry type {code}")


def wkb_bounds(buf) -> tuple:
    """``(xmin, ymin, xmax, ymax, bad)`` of one WKB/EWKB value.

    Empty geometries give four ``None`` and ``bad=False``; unreadable input
    (truncated, unknown type) gives four ``None`` and ``bad=True``.
    """
    if buf is None:
        return (None, None, None, None, False)
    try:
        _, box = _read(memoryview(buf).cast("B") if not isinstance(buf, bytes) else buf, 0)
    except (WKBError, struct.error, ValueError, IndexError):
        return (None, None, None, None, True)
    if box is None:
        return (None, None, None, None, False)
    return box + (False,)


_HEX = re.compile(r"^(?:[0-9A-Fa-f]{2})+$")


# --------------------------------------------------------------------------
# Writers: WKT / GeoJSON text -> little-endian ISO WKB (2-D or with Z).
# --------------------------------------------------------------------------

_TOKEN = re.compile(r"\s*([A-Za-z]+|\(|\)|,|[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?)")
_WKT_TYPES = {"POINT": POINT, "LINESTRING": LINESTRING, "POLYGON": POLYGON,
              "MULTIPOINT": MULTIPOINT, "MULTILINESTRING": MULTILINESTRING,
              "MULTIPOLYGON": MULTIPOLYGON, "GEOMETRYCOLLECTION": GEOMETRYCOLLECTION}


def _tokens(text):
    pos, out = 0, []
    text = text.strip()
    if text.upper().startswith("SRID="):
        text = text.split(";", 1)[1]
    while pos < len(text):
        m = _TOKEN.match(text, pos)
        if not m:
            raise ValueError(f"bad WKT near {text[pos:pos + 20]!r}")
        out.append(m.group(1))
        pos = m.end()
        while pos < len(text) and text[pos].isspace():
            pos += 1
    return out


def _parse_wkt(tok, i):
    name = tok[i].upper()
    i += 1
    dim_tag = ""
    if name not in _WKT_TYPES:  # POINTZ, written without a space
        whole = name
        name = whole.rstrip("ZM")
        dim_tag = whole[len(name):]
        if name not in _WKT_TYPES or dim_tag not in ("Z", "M", "ZM"):
            raise ValueError(f"unknown WKT type {whole}")
    if not dim_tag and i < len(tok) and tok[i].upper() in ("Z", "M", "ZM"):
        dim_tag = tok[i].upper()
        i += 1
    if i < len(tok) and tok[i].upper() == "EMPTY":
        return (name, dim_tag, None), i + 1

    def coord_seq(i):
        # ( x y [z [m]], ... )
        assert tok[i] == "("
        i += 1
        pts = []
        cur = []
        while True:
            t = tok[i]
            if t == ",":
                pts.append(cur)
                cur = []
            elif t == ")":
                pts.append(cur)
                return pts, i + 1
            elif t == "(":  # MULTIPOINT ((1 2), (3 4)) form
                sub, i = coord_seq(i)
                cur = sub[0]
                continue
            else:
                cur.append(float(t))
            i += 1

    def nested(i, depth):
        if depth == 0:
            return coord_seq(i)
        assert tok[i] == "("
        i += 1
        parts = []
        while True:
            if tok[i].upper() == "EMPTY":
                parts.append([])
                i += 1
            else:
                p, i = nested(i, depth - 1)
                parts.append(p)
            if tok[i] == ",":
                i += 1
                continue
            assert tok[i] == ")"
            return parts, i + 1

    if name == "GEOMETRYCOLLECTION":
        assert tok[i] == "("
        i += 1
        parts = []
        while True:
            g, i = _parse_wkt(tok, i)
            parts.append(g)
            if tok[i] == ",":
                i += 1
                continue
            return (name, dim_tag, parts), i + 1
    depth = {"POINT": 0, "LINESTRING": 0, "MULTIPOINT": 0, "POLYGON": 1,
             "MULTILINESTRING": 1, "MULTIPOLYGON": 2}[name]
    body, i = nested(i, depth)
    return (name, dim_tag, body), i


def _wkb_from_tree(tree) -> bytes:
    name, _, body = tree
    code = _WKT_TYPES[name]
    dims = _tree_dims(tree)
    iso = code + (1000 if dims == 3 else 3000 if dims == 4 else 0)
    head = struct.pack("<BI", 1, iso)

    def seq(pts):
        flat = [v for p in pts for v in (list(p) + [math.nan] * (dims - len(p)))[:dims]]
        return struct.pack("<I", len(pts)) + struct.pack(f"<{len(flat)}d", *flat)

    if body is None:
        if code == POINT:
            return head + struct.pack(f"<{dims}d", *([math.nan] * dims))
        return head + struct.pack("<I", 0)
    if code == POINT:
        return head + struct.pack(f"<{dims}d", *(body[0] + [math.nan] * dims)[:dims])
    if code == LINESTRING:
        return head + seq(body)
    if code == POLYGON:
        return head + struct.pack("<I", len(body)) + b"".join(seq(r) for r in body)
    if code == MULTIPOINT:
        return head + struct.pack("<I", len(body)) + b"".join(
            _wkb_from_tree(("POINT", "", [p])) for p in body)
    if code == MULTILINESTRING:
        return head + struct.pack("<I", len(body)) + b"".join(
            _wkb_from_tree(("LINESTRING", "", ls)) for ls in body)
    if code == MULTIPOLYGON:
        return head + struct.pack("<I", len(body)) + b"".join(
            _wkb_from_tree(("POLYGON", "", pg)) for pg in body)
    return head + struct.pack("<I", len(body)) + b"".join(_wkb_from_tree(g) for g in body)


def _tree_dims(tree):
    name, tag, body = tree
    if tag:
        return 2 + len(tag)

    def first(x):
        while isinstance(x, list) and x and isinstance(x[0], list):
            x = x[0]
        return x
    if body is None:
        return 2
    if name == "GEOMETRYCOLLECTION":
        return 2
    pt = first(body)
    return max(2, min(4, len(pt))) if isinstance(pt, list) else 2


def wkt_to_wkb(text):
    if text is None:
        return None
    tree, _ = _parse_wkt(_tokens(text), 0)
    return _wkb_from_tree(tree)


_GJ = {"Point": "POINT", "LineString": "LINESTRING", "Polygon": "POLYGON",
       "MultiPoint": "MULTIPOINT", "MultiLineString": "MULTILINESTRING",
       "MultiPolygon": "MULTIPOLYGON", "GeometryCollection": "GEOMETRYCOLLECTION"}


def _gj_tree(obj):
    name = _GJ[obj["type"]]
    if name == "GEOMETRYCOLLECTION":
        return (name, "", [_gj_tree(g) for g in obj.get("geometries") or []] or None)
    coords = obj.get("coordinates")
    if coords is None or coords == []:
        return (name, "", None)
    if name == "POINT":
        coords = [coords]
    return (name, "", coords)


def geojson_to_wkb(text):
    if text is None:
        return None
    return _wkb_from_tree(_gj_tree(json.loads(text)))


def geometry_text_to_wkb(text):
    """GeoJSON (leading ``{``), hex WKB, or WKT text -> WKB bytes."""
    if text is None:
        return None
    s = text.lstrip()
    if s.startswith("{"):
        return geojson_to_wkb(s)
    if _HEX.match(s.strip()):
        raw = bytes.fromhex(s.strip())
        if wkb_bounds(raw)[4]:
            raise WKBError("unreadable hex WKB")
        return raw
    return wkt_to_wkb(s)


# --------------------------------------------------------------------------
# Readers to GeoJSON (for the GeoJSON sink).
# --------------------------------------------------------------------------

_GJ_NAMES = {POINT: "Point", LINESTRING: "LineString", POLYGON: "Polygon",
             MULTIPOINT: "MultiPoint", MULTILINESTRING: "MultiLineString",
             MULTIPOLYGON: "MultiPolygon", GEOMETRYCOLLECTION: "GeometryCollection"}


def _read_geojson(buf, pos):
    order = buf[pos]
    end = "<" if order == 1 else ">"
    (code,) = struct.unpack_from(end + "I", buf, pos + 1)
    pos += 5
    has_z, has_m = bool(code & EWKB_Z), bool(code & EWKB_M)
    if code & EWKB_SRID:
        pos += 4
    code &= 0x0FFFFFFF
    base, iso = code % 1000, code // 1000
    dims = 2 + int(has_z) + int(has_m) + (1 if iso in (1, 2) else 2 if iso == 3 else 0)
    keep = 3 if (has_z or iso in (1, 3)) else 2

    def seq(pos, n):
        vals = struct.unpack_from(f"{end}{n * dims}d", buf, pos)
        pts = [list(vals[i * dims:i * dims + keep]) for i in range(n)]
        return pos + 8 * n * dims, pts

    if base not in _GJ_NAMES:
        raise WKBError(f"unsupported geometry type {code}")
    name = _GJ_NAMES[base]
    if base == POINT:
        pos, pts = seq(pos, 1)
        coords = [] if any(math.isnan(v) for v in pts[0][:2]) else pts[0]
        return pos, {"type": name, "coordinates": coords}
    (n,) = struct.unpack_from(end + "I", buf, pos)
    pos += 4
    if base == LINESTRING:
        pos, pts = seq(pos, n)
        return pos, {"type": name, "coordinates": pts}
    if base == POLYGON:
        rings = []
        for _ in range(n):
            (m,) = struct.unpack_from(end + "I", buf, pos)
            pos, pts = seq(pos + 4, m)
            rings.append(pts)
        return pos, {"type": name, "coordinates": rings}
    parts = []
    for _ in range(n):
        pos, g = _read_geojson(buf, pos)
        parts.append(g)
    if base == GEOMETRYCOLLECTION:
        return pos, {"type": name, "geometries": parts}
    return pos, {"type": name, "coordinates": [p["coordinates"] for p in parts]}


def wkb_to_geojson(buf):
    if buf is None:
        return None
    return json.dumps(_read_geojson(bytes(buf), 0)[1], separators=(",", ":"))


def geometry_to_geojson(value):
    """Any supported geometry value (GeoJSON/WKT/hex text or WKB bytes) ->
    GeoJSON geometry text."""
    if value is None:
        return None
    if isinstance(value, (bytes, bytearray, memoryview)):
        return wkb_to_geojson(value)
    s = value.strip()
    if s.startswith("{"):
        _gj_tree(json.loads(s))  # raises for what is no geometry
        return s
    return wkb_to_geojson(geometry_text_to_wkb(s))


# --------------------------------------------------------------------------
# Batch kernel: vectorised fast path for the common shapes.
# --------------------------------------------------------------------------

def _gather_f8(buf: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Little-endian doubles starting at byte positions ``pos``."""
    idx = pos[:, None] + np.arange(8)
    return buf[idx].copy().view("<f8").reshape(-1)


def _gather_u4(buf: np.ndarray, pos: np.ndarray) -> np.ndarray:
    idx = pos[:, None] + np.arange(4)
    return buf[idx].copy().view("<u4").reshape(-1)


def wkb_bounds_arrays(values):
    """Batch kernel behind :func:`wkb_envelope`: four float arrays (NaN where
    there is no box) and a ``bad`` flag array.

    Little-endian 2-D points and single-ring polygons (the bulk of real
    data) are decoded with numpy gathers over the concatenated batch; any
    other value goes through the per-value parser."""
    vals = [None if v is None else bytes(v) for v in values]
    n = len(vals)
    box = np.full((n, 4), np.nan)
    bad = np.zeros(n, dtype=bool)
    if n == 0:
        return box, bad
    lens = np.fromiter((0 if v is None else len(v) for v in vals), dtype=np.int64, count=n)
    buf = np.frombuffer(b"".join(v for v in vals if v is not None) + b"\0" * 16, dtype=np.uint8)
    starts = np.concatenate(([0], np.cumsum(lens)[:-1]))
    has = lens >= 5
    code = np.zeros(n, dtype=np.uint32)
    code[has] = _gather_u4(buf, starts[has] + 1)
    le = np.zeros(n, dtype=bool)
    le[has] = buf[starts[has]] == 1
    fast = np.zeros(n, dtype=bool) | np.fromiter((v is None for v in vals), dtype=bool, count=n)

    pts = np.flatnonzero(le & (code == POINT) & (lens == 21))
    if len(pts):
        x, y = _gather_f8(buf, starts[pts] + 5), _gather_f8(buf, starts[pts] + 13)
        empty = np.isnan(x) | np.isnan(y)
        box[pts] = np.where(empty[:, None], np.nan, np.stack([x, y, x, y], axis=1))
        fast[pts] = True

    cand = np.flatnonzero(le & (code == POLYGON) & (lens >= 13))
    if len(cand):
        nring = _gather_u4(buf, starts[cand] + 5)
        npt = _gather_u4(buf, starts[cand] + 9).astype(np.int64)
        ok = (nring == 1) & (npt > 0) & (lens[cand] == 13 + 16 * npt)
        poly, npt = cand[ok], npt[ok]
        if len(poly):
            first = np.concatenate(([0], np.cumsum(npt)[:-1]))
            within = np.arange(npt.sum()) - np.repeat(first, npt)
            pos = np.repeat(starts[poly] + 13, npt) + 16 * within
            xs, ys = _gather_f8(buf, pos), _gather_f8(buf, pos + 8)
            nan = np.isnan(xs) | np.isnan(ys)
            xs, ys = np.where(nan, np.nan, xs), np.where(nan, np.nan, ys)
            with np.errstate(invalid="ignore"):
                box[poly] = np.stack([np.fmin.reduceat(xs, first), np.fmin.reduceat(ys, first),
                                      np.fmax.reduceat(xs, first), np.fmax.reduceat(ys, first)],
                                     axis=1)
            fast[poly] = True

    for i in np.flatnonzero(~fast):
        r = wkb_bounds(vals[i])
        bad[i] = r[4]
        if r[0] is not None:
            box[i] = r[:4]
    return box, bad
