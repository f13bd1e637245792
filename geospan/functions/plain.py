"""Geometries in their most usual spelling, read and written a batch at a time.

A strict pattern tells which texts are plain: 2-D WKT or GeoJSON of one type, with numbers that have nothing unusual.  The numbers of
all plain texts of a batch are then read in one pass over its bytes.  Every other value is left to the per-value
codecs of :mod:`geospan.functions.wkb` and the SQL expressions of :mod:`geospan.functions.envelope`, and a plain one
gives what these give for it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from geospan.functions import wkb as _wkb


def _list(item: str, begin: str, end: str) -> str:
    return rf"{begin}{item}(?:, ?{item})*{end}"


_N = r"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?"
_XY, _JXY = f"{_N} {_N}", rf"\[{_N}, ?{_N}\]"
_CHAIN, _JCHAIN = _list(_XY, r"\(", r"\)"), _list(_JXY, r"\[", r"\]")
_RINGS, _JRINGS = _list(_CHAIN, r"\(", r"\)"), _list(_JCHAIN, r"\[", r"\]")
_PARTS, _JPARTS = _list(_RINGS, r"\(", r"\)"), _list(_JRINGS, r"\[", r"\]")


def _geojson(*kinds: tuple[str, str]) -> str:
    some = "|".join(f'{name}", ?"coordinates": ?{coordinates}' for name, coordinates in kinds)
    return rf'\{{"type": ?"(?:{some})\}}'


_ONE = rf"POINT ?\({_XY}\)|LINESTRING ?{_CHAIN}|POLYGON ?\({_CHAIN}\)"
_JONE = (("Point", _JXY), ("LineString", _JCHAIN), ("Polygon", rf"\[{_JCHAIN}\]"))
#: Points, and lines and polygons of one chain.
SIMPLE = rf"^(?:{_ONE}|{_geojson(*_JONE)})$"
#: Any type but collections.
ANY = (rf"^(?:POINT ?\({_XY}\)|(?:LINESTRING|MULTIPOINT) ?{_CHAIN}|MULTIPOINT ?{_list(rf'\({_XY}\)', r'\(', r'\)')}|"
       rf"(?:POLYGON|MULTILINESTRING) ?{_RINGS}|MULTIPOLYGON ?{_PARTS}|"
       + _geojson(("Point", _JXY), ("(?:LineString|MultiPoint)", _JCHAIN), ("(?:Polygon|MultiLineString)", _JRINGS), ("MultiPolygon", _JPARTS)) + ")$")
_DIGIT = np.zeros(256, bool)
_DIGIT[list(b"0123456789.+-eE")] = True


@dataclass
class Plain:
    """rows: places of the plain values in their batch; size: points of each; kind: POINT, LINESTRING or POLYGON of the
    simple ones; x, y: all points end to end."""

    rows: np.ndarray
    kind: np.ndarray
    size: np.ndarray
    x: np.ndarray
    y: np.ndarray

    def first(self) -> np.ndarray:
        return np.cumsum(self.size) - self.size

    def where(self, keep: np.ndarray) -> Plain:
        points = np.repeat(keep, self.size)
        return Plain(self.rows[keep], self.kind[keep], self.size[keep], self.x[points], self.y[points])


def _none() -> Plain:
    empty = np.zeros(0, np.int64)
    return Plain(empty, empty, empty, np.zeros(0), np.zeros(0))


def _flags(mask) -> np.ndarray:
    return pc.fill_null(mask, False).to_numpy(zero_copy_only=False)


def read_text(values: pa.Array, pattern: str) -> Plain:
    """The plain ones among texts; ``pattern``: SIMPLE or ANY."""
    rows = np.flatnonzero(_flags(pc.match_substring_regex(values, pattern)))
    if not len(rows):
        return _none()
    text = values.take(pa.array(rows)).cast(pa.large_binary())
    at = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2], np.uint8)[at[0]:at[-1]]
    name = text.cast(pa.large_string())
    kind = np.where(_flags(pc.match_substring(name, "point", ignore_case=True)), _wkb.POINT,
                    np.where(_flags(pc.match_substring(name, "line", ignore_case=True)), _wkb.LINESTRING, _wkb.POLYGON))
    number = _DIGIT[data]
    letter = np.zeros(len(data), bool)  # an e or E of a word has no digit before it
    exponent = np.flatnonzero((data == 101) | (data == 69))
    letter[exponent[(exponent == 0) | (data[exponent - 1] < 48) | (data[exponent - 1] > 57)]] = True
    number &= ~letter
    begins = np.flatnonzero(number & ~np.concatenate([[False], number[:-1]]))
    ends = np.flatnonzero(number & ~np.append(number[1:], False)) + 1
    edge = np.concatenate([[0], np.cumsum(ends - begins)])
    try:
        strings = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(edge.astype(np.int64)), pa.py_buffer(data[number].tobytes()))
        numbers = pc.cast(strings, pa.float64()).to_numpy()
    except pa.ArrowInvalid:  # a number that is none to Arrow
        return _none()
    count = np.diff(np.searchsorted(begins, at - at[0]))
    # infinite ones, and the minus zeros, which the readers don't all keep
    odd = ~np.isfinite(numbers) | ((numbers == 0) & np.signbit(numbers))
    out = Plain(rows, kind, count // 2, numbers[0::2], numbers[1::2])
    if odd.any():
        keep = np.ones(len(rows), bool)
        keep[np.repeat(np.arange(len(rows)), count)[odd]] = False
        out = out.where(keep)
    return out


def read_wkb(values: pa.Array) -> Plain:
    """The simple ones among little-endian 2-D WKB values: points, and lines and polygons of one chain."""
    there = np.flatnonzero(_flags(pc.greater_equal(pc.binary_length(values), 21)))
    if not len(there):
        return _none()
    raw = values.take(pa.array(there)).cast(pa.large_binary())
    at = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2], np.uint8)
    start, length = at[:-1], np.diff(at)
    kind, one, two = (_wkb._gather_u4(data, start + k).astype(np.int64) for k in (1, 5, 9))
    size = np.select([kind == _wkb.POINT, kind == _wkb.LINESTRING, (kind == _wkb.POLYGON) & (one == 1)], [1, one, two], 0)
    head = np.where(kind == _wkb.POINT, 5, np.where(kind == _wkb.LINESTRING, 9, 13))
    fits = (data[start] == 1) & (size > 0) & (length == head + 16 * size)
    start, head, size = start[fits], head[fits], size[fits]
    place = np.repeat(start + head - 16 * (np.cumsum(size) - size), size) + 16 * np.arange(size.sum())
    out = Plain(there[fits], kind[fits], size, _wkb._gather_f8(data, place), _wkb._gather_f8(data, place + 8))
    odd = ~(np.isfinite(out.x) & np.isfinite(out.y))
    if odd.any():
        keep = np.ones(len(size), bool)
        keep[np.repeat(np.arange(len(size)), size)[odd]] = False
        out = out.where(keep)
    return out


def bounds(plain: Plain) -> np.ndarray:
    """xmin, ymin, xmax, ymax of each value."""
    if not len(plain.rows):
        return np.zeros((0, 4))
    first = plain.first()
    return np.stack([f.reduceat(v, first) for f, v in ((np.minimum, plain.x), (np.minimum, plain.y), (np.maximum, plain.x), (np.maximum, plain.y))], axis=1)


def to_wkb(plain: Plain) -> list[bytes]:
    """Little-endian WKB of simple values."""
    if not len(plain.rows):
        return []
    head = np.where(plain.kind == _wkb.POINT, 5, np.where(plain.kind == _wkb.LINESTRING, 9, 13))
    end = np.cumsum(head + 16 * plain.size)
    start = end - head - 16 * plain.size
    out = np.zeros(end[-1], np.uint8)
    out[start], out[start + 1] = 1, plain.kind

    def u4(some, shift, value):
        out[(start[some] + shift)[:, None] + np.arange(4)] = np.ascontiguousarray(value, "<u4").view(np.uint8).reshape(-1, 4)
    line, polygon = plain.kind == _wkb.LINESTRING, plain.kind == _wkb.POLYGON
    u4(line, 5, plain.size[line])
    u4(polygon, 5, np.ones(polygon.sum()))
    u4(polygon, 9, plain.size[polygon])
    place = np.repeat(start + head - 16 * plain.first(), plain.size) + 16 * np.arange(len(plain.x))
    points = np.stack([plain.x, plain.y], axis=1).astype("<f8")
    out[place[:, None] + np.arange(16)] = points.view(np.uint8).reshape(-1, 16)
    raw = out.tobytes()
    return [raw[a:b] for a, b in zip(start.tolist(), end.tolist())]


def to_geojson(plain: Plain) -> list[str]:
    """GeoJSON text of simple values."""
    points = [f"[{x!r},{y!r}]" for x, y in zip(plain.x.tolist(), plain.y.tolist())]
    first, out = plain.first(), []
    for kind, a, n in zip(plain.kind.tolist(), first.tolist(), plain.size.tolist()):
        if kind == _wkb.POINT:
            out.append(f'{{"type":"Point","coordinates":{points[a]}}}')
        elif kind == _wkb.LINESTRING:
            out.append(f'{{"type":"LineString","coordinates":[{",".join(points[a:a + n])}]}}')
        else:
            out.append(f'{{"type":"Polygon","coordinates":[[{",".join(points[a:a + n])}]]}}')
    return out


def values_to_wkb(values: pa.Array) -> pa.Array:
    """GeoJSON / WKT / hex-WKB text -> little-endian ISO WKB bytes; unreadable text -> NULL."""
    plain = read_text(values, SIMPLE)
    return pa.array(_filled(values, plain, to_wkb(plain), _wkb.geometry_text_to_wkb), pa.binary())


def values_to_geojson(values: pa.Array) -> pa.Array:
    """Geometry (GeoJSON / WKT / hex text, or WKB bytes) -> GeoJSON text; unreadable -> NULL."""
    if pa.types.is_string(values.type) or pa.types.is_large_string(values.type):
        as_it_is = _flags(pc.match_substring_regex(values, ANY)) & _flags(pc.starts_with(values, "{"))
        plain = read_text(pc.if_else(pa.array(as_it_is), pa.scalar(None, values.type), values), SIMPLE)
        out = _filled(values, plain, to_geojson(plain), _wkb.geometry_to_geojson, as_it_is)
        return pc.if_else(pa.array(as_it_is), values.cast(pa.string()), pa.array(out, pa.string()))
    plain = read_wkb(values)
    return pa.array(_filled(values, plain, to_geojson(plain), _wkb.geometry_to_geojson), pa.string())


def _filled(values: pa.Array, plain: Plain, done: list, per_value, skip: np.ndarray | None = None) -> list:
    """What is done for the plain values, and ``per_value`` for the others."""
    out: list = [None] * len(values)
    left = _flags(pc.is_valid(values)).copy()
    left[plain.rows] = False
    if skip is not None:
        left &= ~skip
    for i, v in zip(plain.rows.tolist(), done):
        out[i] = v
    rest = np.flatnonzero(left)
    for i, v in zip(rest.tolist(), values.take(pa.array(rest)).to_pylist()):
        out[i] = _wkb.readable(per_value, v)
    return out


def text_bounds(values: pa.Array) -> pa.Array:
    """Structs (xmin, ymin, xmax, ymax, bad, plain) of texts: the box of a plain one, else that of hex WKB; text that isn't
    plain and no hex is ``bad``, and its box is to come from the SQL expressions."""
    plain = read_text(values, ANY)
    is_plain = np.zeros(len(values), bool)
    is_plain[plain.rows] = True
    box, bad = np.full((len(values), 4), np.nan), np.zeros(len(values), bool)
    box[plain.rows] = bounds(plain)
    rest = np.flatnonzero(_flags(pc.is_valid(values)) & ~is_plain)
    if len(rest):
        text = [v.strip() for v in values.take(pa.array(rest)).to_pylist()]
        raw = [bytes.fromhex(v) if _wkb._HEX.match(v) else None for v in text]
        box[rest], bad[rest] = _wkb.wkb_bounds_arrays(raw)
        bad[rest] |= np.fromiter((r is None for r in raw), bool, len(raw))
    columns = [pa.array(box[:, k], pa.float64(), mask=np.isnan(box[:, k])) for k in range(4)]
    return pa.StructArray.from_arrays([*columns, pa.array(bad), pa.array(is_plain)], names=["xmin", "ymin", "xmax", "ymax", "bad", "plain"])


# Numbers that JSON writers in Java leave as they are, so that a text of them is what Spark's JSON functions give for it.
_INT = r"(?:0|-?[1-9][0-9]*)"
_FLOAT = r"-?(?:[1-9][0-9]{0,6}\.(?:0|[0-9]{0,7}[1-9])|0\.(?:0|0{0,2}[1-9](?:[0-9]{0,5}[1-9])?))"
_KEPT = f"(?:{_INT}|{_FLOAT})"


def _kept(numbers: str) -> str:
    return numbers.replace(_N, _KEPT).replace(" ?", "")


_STRING = r'"[^"\\\x00-\x1f]*"'
_MEMBER = f"{_STRING}:(?:{_STRING}|{_KEPT}|true|false|null)"
_PROPERTIES = rf"^\{{(?:{_MEMBER}(?:,{_MEMBER})*)?\}}$"
_GEOMETRY = "^" + _kept(_geojson(("Point", _JXY), ("(?:LineString|MultiPoint)", _JCHAIN), ("(?:Polygon|MultiLineString)", _JRINGS), ("MultiPolygon", _JPARTS))) + "$"


def feature_members(properties: pa.Array, geometry: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(geometry, plain): which properties and geometry, cut out of a feature, are JSON in its tersest spelling, and the geometry
    without zeros at the end of its fractions, as Spark's ``from_json`` gives them as texts."""
    long = pc.match_substring_regex(geometry, r"\.[0-9]+0[,\]]")
    if pc.any(long).as_py():
        short = pc.replace_substring_regex(geometry.filter(long), r"(\.[0-9]*[1-9]|\.0)0+([,\]])", r"\1\2")
        geometry = pc.replace_with_mask(geometry, long, short)
    return geometry, _flags(pc.and_(pc.match_substring_regex(properties, _PROPERTIES), pc.match_substring_regex(geometry, _GEOMETRY)))
