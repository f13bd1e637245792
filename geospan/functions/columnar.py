"""Geometries of an Arrow batch as flat columns, and the exact box test on them (F2).

All coordinates of a batch lie end to end, with offsets for chains (points that follow each
other) and numbers for the geometry and the polygon that a chain belongs to.  WKB is read by all
values in step, one header or ring of each at a time; WKT and GeoJSON by one pass over the bytes of the batch
that finds brackets, words and numbers.  What these passes don't take (EMPTY parts, unusual members, broken
text) goes to the per-value readers of :mod:`geospan.functions.wkb`.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from geospan.functions import wkb as _wkb

#: Polygon number of chains that are lines, or only points.
LINE, POINTS = -1, -2


class Flat:
    """Columns of a batch: x, y per point; points, geometry and polygon per chain; readable per value."""

    def __init__(self, n: int):
        self.n = n
        self.readable = np.zeros(n, bool)
        self.x: list[np.ndarray] = []
        self.y: list[np.ndarray] = []
        self.size: list[np.ndarray] = []
        self.geometry: list[np.ndarray] = []
        self.polygon: list[np.ndarray] = []
        self._polygons = 0

    def add(self, x, y, size, geometry, polygon) -> None:
        """Chains of ``size`` points; polygon: any numbers that tell polygons apart, or LINE, POINTS."""
        polygon = np.asarray(polygon, np.int64)
        some = polygon >= 0
        if some.any():
            names, number = np.unique(polygon[some], return_inverse=True)
            polygon = polygon.copy()
            polygon[some] = number + self._polygons
            self._polygons += len(names)
        for column, value in zip((self.x, self.y, self.size, self.geometry, self.polygon), (x, y, size, geometry, polygon)):
            column.append(np.asarray(value))

    def columns(self):
        if not self.size:
            return (np.zeros(0), np.zeros(0), *(np.zeros(0, np.int64),) * 3)
        return tuple(np.concatenate(c) for c in (self.x, self.y, self.size, self.geometry, self.polygon))


# --- readers ----------------------------------------------------------------

def flatten(values: pa.Array) -> Flat:
    """WKB (binary), or WKT, GeoJSON and hex WKB text; unreadable and null values have no chains and aren't ``readable``."""
    flat = Flat(len(values))
    if pa.types.is_binary(values.type) or pa.types.is_large_binary(values.type):
        _read_wkb(flat, values, np.flatnonzero(pc.is_valid(values).to_numpy(zero_copy_only=False)))
        return flat
    text = pc.utf8_trim_whitespace(values)
    there = pc.is_valid(text).to_numpy(zero_copy_only=False)
    is_json = pc.fill_null(pc.starts_with(text, "{"), False).to_numpy(zero_copy_only=False)
    is_hex = pc.fill_null(pc.match_substring_regex(text, r"^(?:[0-9A-Fa-f]{2})+$"), False).to_numpy(zero_copy_only=False)
    rest: list[int] = []
    for rows, read in ((np.flatnonzero(is_hex), _read_hex), (np.flatnonzero(is_json), _read_geojson),
                       (np.flatnonzero(there & ~is_hex & ~is_json), _read_wkt)):
        if len(rows):
            rest += read(flat, text.take(pa.array(rows)), rows)
    for i in rest:
        _read_one(flat, i, text[i].as_py())
    return flat


def _read_one(flat: Flat, i: int, value: str) -> None:
    """The per-value reader, for what the batch passes leave over."""
    tree = _wkb.readable(lambda v: _wkb._gj_tree(json.loads(v)) if v.startswith("{") else _wkb._parse_wkt(_wkb._tokens(v), 0)[0], value)
    parts = None if tree is None else _wkb.readable(lambda t: list(_tree_chains(t)), tree)
    if parts is None:
        return
    flat.readable[i] = True
    number = 0
    for polygon, rings in parts:
        number += 1
        for ring in rings:
            if len(ring):
                flat.add(ring[:, 0], ring[:, 1], [len(ring)], [i], [number if polygon == 0 else polygon])


def _tree_chains(tree):
    """(0 or LINE or POINTS, chains) of every part of a parsed tree."""
    name, _, body = tree
    if body is None:
        return
    if name == "GEOMETRYCOLLECTION":
        for g in body:
            yield from _tree_chains(g)
        return

    def chain(points):
        return np.array([p[:2] for p in points], float).reshape(-1, 2)
    if name in ("POINT", "MULTIPOINT"):
        yield POINTS, [chain(body if name == "MULTIPOINT" else body[:1])]
    elif name == "LINESTRING":
        yield LINE, [chain(body)]
    elif name == "MULTILINESTRING":
        yield LINE, [chain(c) for c in body]
    elif name == "POLYGON":
        yield 0, [chain(r) for r in body]
    else:
        for rings in body:
            yield 0, [chain(r) for r in rings]


def _read_hex(flat: Flat, text: pa.Array, rows: np.ndarray) -> list[int]:
    size = pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64) // 2
    raw = bytes.fromhex(_joined(text, b"").decode("ascii"))
    _wkb_chains(flat, np.frombuffer(raw, np.uint8), np.concatenate([[0], np.cumsum(size)]), rows)
    return []


def _joined(values: pa.Array, mark: bytes) -> bytes:
    values = values.cast(pa.binary())
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values), mark)[0].as_py()


def _read_wkb(flat: Flat, values: pa.Array, rows: np.ndarray) -> None:
    if len(rows):
        there = values.take(pa.array(rows))
        size = pc.binary_length(there).to_numpy(zero_copy_only=False).astype(np.int64)
        _wkb_chains(flat, np.frombuffer(_joined(there, b""), np.uint8), np.concatenate([[0], np.cumsum(size)]), rows)


def _wkb_chains(flat: Flat, raw: np.ndarray, edge: np.ndarray, rows: np.ndarray) -> None:
    """All values in step: each turn every unfinished value reads one geometry header, or one ring of its polygon."""
    n = len(rows)
    raw = np.concatenate([raw, np.zeros(64, np.uint8)])
    pos, end = edge[:-1].copy(), edge[1:]
    bad = np.zeros(n, bool)
    left = np.ones((n, 1), np.int64)  # geometries to come at each level of nesting
    level = np.zeros(n, np.int64)
    rings = np.zeros(n, np.int64)  # rings to come of the polygon being read
    little, dims = np.zeros(n, bool), np.zeros(n, np.int64)
    polygon = np.zeros(n, np.int64)
    polygons = 0
    found = {k: [] for k in ("at", "size", "dims", "little", "value", "polygon")}

    def u4(at, le):
        b = raw[np.minimum(at, len(raw) - 4)[:, None] + np.arange(4)].astype(np.int64)
        return np.where(le, b @ (1 << np.array([0, 8, 16, 24])), b @ (1 << np.array([24, 16, 8, 0])))

    def chains(who, at, size, kind):
        """Points of some values from ``at``; gives back the place after them."""
        after = at + size * dims[who] * 8
        over = after > end[who]
        bad[who[over]] = True
        fine = ~over & (size > 0)
        for name, value in (("at", at), ("size", size), ("dims", dims[who]), ("little", little[who]), ("value", who), ("polygon", kind)):
            found[name].append(value[fine])
        return np.where(over, at, after)

    def closed(who):
        """One geometry of each is over, and so may be what it is a part of."""
        left[who, level[who]] -= 1
        while True:
            who = who[(left[who, level[who]] == 0) & (level[who] > 0)]
            if not len(who):
                return
            level[who] -= 1
            left[who, level[who]] -= 1
    while True:
        live = np.flatnonzero(~bad & ((left[np.arange(n), level] > 0) | (rings > 0)))
        if not len(live):
            break
        ring = live[rings[live] > 0]
        if len(ring):
            bad[ring[pos[ring] + 4 > end[ring]]] = True
            ring = ring[~bad[ring]]
            size = u4(pos[ring], little[ring])
            pos[ring] = chains(ring, pos[ring] + 4, size, polygon[ring])
            rings[ring] -= 1
            closed(ring[rings[ring] == 0])
        head = live[(rings[live] == 0) & ~np.isin(live, ring)]
        if not len(head):
            continue
        order = raw[np.minimum(pos[head], len(raw) - 1)]
        bad[head[(pos[head] + 5 > end[head]) | (order > 1)]] = True
        head = head[~bad[head]]
        little[head] = raw[pos[head]] == 1
        code = u4(pos[head] + 1, little[head])
        pos[head] += 5 + 4 * ((code & _wkb.EWKB_SRID) != 0)
        flags = ((code & _wkb.EWKB_Z) != 0).astype(np.int64) + ((code & _wkb.EWKB_M) != 0)
        code &= 0x0FFFFFFF
        iso = code // 1000
        dims[head] = 2 + flags + np.select([(iso == 1) | (iso == 2), iso == 3], [1, 2], 0)
        base = code % 1000
        bad[head[(base < 1) | (base > 7)]] = True
        point, line = head[base == _wkb.POINT], head[base == _wkb.LINESTRING]
        if len(point):
            pos[point] = chains(point, pos[point], np.ones(len(point), np.int64), np.full(len(point), POINTS))
            closed(point)
        counted = head[(base > _wkb.POINT) & (base <= 7)]
        base = base[(base > _wkb.POINT) & (base <= 7)]
        over = pos[counted] + 4 > end[counted]
        bad[counted[over]] = True
        counted, base = counted[~over], base[~over]
        count = u4(pos[counted], little[counted])
        pos[counted] += 4
        line, many = base == _wkb.LINESTRING, base > _wkb.POLYGON
        if line.any():
            who = counted[line]
            pos[who] = chains(who, pos[who], count[line], np.full(len(who), LINE))
            closed(who)
        poly = base == _wkb.POLYGON
        if poly.any():
            who = counted[poly]
            polygon[who] = polygons + np.arange(len(who))
            polygons += len(who)
            rings[who] = count[poly]
            closed(who[count[poly] == 0])
        if many.any():
            who = counted[many]
            # a part takes five bytes at least
            over = count[many] * 5 > end[who] - pos[who]
            bad[who[over]] = True
            level[who] += 1
            if level[who].max() >= left.shape[1]:
                left = np.concatenate([left, np.zeros((n, 1), np.int64)], axis=1)
            left[who, level[who]] = count[many]
            none = who[count[many] == 0]
            if len(none):
                level[none] -= 1
                closed(none)
    flat.readable[rows[~bad]] = True
    if not found["at"]:
        return
    at, size, dim, le, value, poly = (np.concatenate(found[k]) for k in found)
    keep = ~bad[value]
    at, size, dim, le, value, poly = (c[keep] for c in (at, size, dim, le, value, poly))
    within = np.arange(size.sum()) - np.repeat(np.concatenate([[0], np.cumsum(size)[:-1]]), size) if len(size) else np.zeros(0, np.int64)
    place = np.repeat(at, size) + within * np.repeat(dim * 8, size)
    swap = np.repeat(~le, size)

    def doubles(place):
        b = raw[place[:, None] + np.arange(8)]
        b[swap] = b[swap, ::-1]
        return np.ascontiguousarray(b).view("<f8").reshape(-1)
    x, y = doubles(place), doubles(place + 8)
    # an empty point is written as NaN
    nan = np.isnan(x) | np.isnan(y)
    if nan.any():
        owner = np.repeat(np.arange(len(size)), size)[~nan]
        size = np.bincount(owner, minlength=len(size))
        x, y = x[~nan], y[~nan]
    flat.add(x, y, size, rows[value], poly)


class _Text:
    """Tokens of the texts of a batch: kind, place, value number, depth of brackets, and the numbers among them.

    Words have been replaced by single control characters (``codes``), so that a byte's class is its token's
    kind, and only a number has more than one byte.
    """

    NUMBER, OPEN, CLOSE, COMMA, OTHER = 1, 2, 3, 4, 15

    def __init__(self, text: pa.Array, kinds: dict[bytes, int]):
        size = pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64)
        data = np.frombuffer(_joined(text, b"\n") + b"\n", np.uint8)
        start = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
        table = np.full(256, self.OTHER, np.uint8)
        table[[32, 9, 10, 13]] = 0
        table[list(b"0123456789.+-eE")] = self.NUMBER
        for chars, kind in kinds.items():
            table[list(chars)] = kind
        k = table[data]
        token = k != 0
        token[1:] &= (k[1:] != self.NUMBER) | (k[:-1] != self.NUMBER)
        self.at = np.flatnonzero(token)
        self.kind = k[self.at].astype(np.int64)
        self.byte = data[self.at]
        edge = np.searchsorted(self.at, start)
        self.value = np.repeat(np.arange(len(text)), np.diff(np.append(edge, len(self.at))))
        number = self.kind == self.NUMBER
        # the numbers' bytes end to end are a column of strings; one that isn't a number raises
        digit = k == self.NUMBER
        if (data[digit] == 43).any():  # Arrow reads a plus in front of an exponent only
            plus = np.flatnonzero(digit & (data == 43))
            digit[plus[k[plus - 1] != self.NUMBER]] = False
        begins = np.searchsorted(np.flatnonzero(digit), self.at[number])
        ends = np.append(begins, digit.sum()).astype(np.int32)
        self.numbers = pc.cast(pa.StringArray.from_buffers(len(begins), pa.py_buffer(ends), pa.py_buffer(data[digit])), pa.float64()).to_numpy()
        self.before = np.cumsum(number) - number  # numbers before a token
        step = np.zeros(16, np.int64)
        step[[self.OPEN, 5]], step[[self.CLOSE, 6]] = 1, -1
        depth = np.cumsum(step[self.kind])
        base = np.concatenate([[0], depth])[edge]
        self.depth = depth - base[self.value]
        there = edge < np.append(edge[1:], len(self.at))
        self.first = np.zeros(len(self.at), bool)
        self.first[edge[there]] = True
        self.last = np.append(self.first[1:], True) if len(self.at) else self.first
        self.bad = ~there
        self.bad[self.value[self.last & (self.depth != 0)]] = True
        self.bad[self.value[(self.depth < 0) | ((self.depth == 0) & (step[self.kind] < 0) & ~self.last)]] = True

    def follows(self, pairs, kind: np.ndarray) -> None:
        """Values with a token that may not follow the one before it (0: the begin) are bad."""
        allowed = np.zeros((16, 16), bool)
        for a, b in pairs:
            allowed[a, b] = True
        prev = np.where(self.first, 0, np.concatenate([[0], kind[:-1]]))
        self.bad[self.value[~allowed[prev, kind]]] = True
        # numbers and brackets side by side in one list
        mixed = (kind[1:-1] == 4) & (((kind[:-2] == 3) & (kind[2:] == 1)) | ((kind[:-2] == 1) & (kind[2:] == 2)))
        self.bad[self.value[1:-1][mixed]] = True

    def parent(self, child: np.ndarray, up: int) -> np.ndarray:
        """For tokens (opening brackets), the token of the bracket ``up`` levels above."""
        out = np.full(len(child), -1, np.int64)
        opens = np.flatnonzero(self.kind == self.OPEN)
        for d in np.unique(self.depth[child]).tolist():
            mine = self.depth[child] == d
            level = opens[self.depth[opens] == d - up]
            if len(level):
                out[mine] = level[np.maximum(np.searchsorted(level, child[mine], side="right") - 1, 0)]
        return out


def _coded(text: pa.Array, words: dict[str, str]) -> tuple[pa.Array, np.ndarray]:
    """The texts with words replaced by their codes, and which of them had no control characters before."""
    plain = pc.invert(pc.match_substring_regex(text, "[\x01-\x08\x0e-\x1f]")).to_numpy(zero_copy_only=False)
    for word, code in words.items():
        text = pc.replace_substring(text, word, code)
    return text, plain


#: Depth of a chain's bracket below its word, by type (1 is POINT).
_WKT_DEPTH = np.array([0, 1, 1, 2, 1, 2, 3, -9])
#: Longer words first, where one ends with another.
_WKT_WORDS = {"GEOMETRYCOLLECTION": "\x07", "MULTIPOLYGON": "\x06", "MULTILINESTRING": "\x05", "MULTIPOINT": "\x04",
              "POLYGON": "\x03", "LINESTRING": "\x02", "POINT": "\x01"}
POINT_, LINE_, POLYGON_, MPOINT_, MLINE_, MPOLYGON_, GROUP_ = range(1, 8)


def _read_wkt(flat: Flat, text: pa.Array, rows: np.ndarray) -> list[int]:
    """Gives back the rows that the batch pass doesn't take."""
    text, plain = _coded(pc.replace_substring_regex(pc.utf8_upper(text), r"^SRID=[0-9]+;", ""), _WKT_WORDS)
    try:
        t = _Text(text, {b"(": 2, b")": 3, b",": 4, bytes(range(1, 8)): 8, b"ZM": 7})
    except ValueError:
        return rows.tolist()
    t.bad |= ~plain
    kind = t.kind
    # begin 0, number 1, ( 2, ) 3, comma 4, Z and M 7, type 8
    t.follows(((0, 8), (8, 2), (8, 7), (7, 7), (7, 2), (2, 2), (2, 1), (2, 8), (1, 1), (1, 4), (1, 3), (4, 1), (4, 2), (4, 8), (3, 3), (3, 4)), kind)
    t.bad[t.value[t.last & (kind != 3)]] = True
    is_type = np.flatnonzero(kind == 8)
    open_ = np.flatnonzero((kind == 2) & (np.append(kind[1:], 0) == 1))
    open_ = open_[~t.bad[t.value[open_]]]
    if not len(open_):
        return rows.tolist()
    # the type that a chain belongs to is the last one before it
    owner = is_type[np.maximum(np.searchsorted(is_type, open_) - 1, 0)]
    what = t.byte[owner]
    depth = t.depth[open_] - t.depth[owner]
    fits = (depth == _WKT_DEPTH[what]) | ((what == MPOINT_) & (depth == 2))
    t.bad[t.value[open_[~fits | (t.value[owner] != t.value[open_])]]] = True
    nested = is_type[~t.first[is_type]]
    outer = is_type[np.searchsorted(t.value[is_type], t.value[nested])]
    t.bad[t.value[nested[t.byte[outer] != GROUP_]]] = True
    closes = np.flatnonzero(kind == 3)
    close = closes[np.searchsorted(closes, open_)]
    commas = np.concatenate([[0], np.cumsum(kind == 4)])
    points = commas[close] - commas[open_] + 1
    count = t.before[close] - t.before[open_]
    dims = count // points
    comma = np.flatnonzero(kind == 4)
    chain = np.maximum(np.searchsorted(open_, comma) - 1, 0)
    inner = comma[(comma < close[chain]) & (comma > open_[chain])]
    chain = np.searchsorted(open_, inner) - 1
    nth = commas[inner] - commas[open_[chain]] + 1
    uneven = t.before[inner] - t.before[open_[chain]] != nth * dims[chain]
    t.bad[t.value[inner[uneven]]] = True
    single = (what == POINT_) | ((what == MPOINT_) & (depth == 2))
    t.bad[t.value[open_[(count != points * dims) | (dims < 2) | (dims > 4) | (single & (points > 1))]]] = True
    polygon = np.where((what == POLYGON_) | (what == MPOLYGON_), t.parent(open_, 1), np.where((what == POINT_) | (what == MPOINT_), POINTS, LINE))
    keep = ~t.bad[t.value[open_]]
    _add_chains(flat, t, t.before[open_][keep], points[keep], dims[keep], rows[t.value[open_[keep]]], polygon[keep])
    flat.readable[rows[~t.bad]] = True
    return rows[t.bad].tolist()


def _add_chains(flat, t, first, points, dims, geometry, polygon) -> None:
    within = np.arange(points.sum()) - np.repeat(np.concatenate([[0], np.cumsum(points)[:-1]]), points) if len(points) else np.zeros(0, np.int64)
    at = np.repeat(first, points) + within * np.repeat(dims, points)
    flat.add(t.numbers[at], t.numbers[at + 1], points, geometry, polygon)


#: Depth of a point's bracket, that of the coordinates being 1, by type (1 is Point).
_JSON_DEPTH = np.array([0, 1, 2, 3, 2, 3, 4])
_JSON_WORDS = {'"Point"': "\x01", '"LineString"': "\x02", '"Polygon"': "\x03", '"MultiPoint"': "\x04", '"MultiLineString"': "\x05",
               '"MultiPolygon"': "\x06", '"GeometryCollection"': "\x07", '"type"': "\x0e", '"coordinates"': "\x0f", '"geometries"': "\x10"}


def _read_geojson(flat: Flat, text: pa.Array, rows: np.ndarray) -> list[int]:
    """Gives back the rows that the batch pass doesn't take."""
    text, plain = _coded(text, _JSON_WORDS)
    try:
        t = _Text(text, {b"[": 2, b"]": 3, b",": 4, b"{": 5, b"}": 6, b"\x0e": 7, b"\x0f": 8, b"\x10": 9, bytes(range(1, 8)): 10, b":": 11})
    except ValueError:
        return rows.tolist()
    t.bad |= ~plain
    kind = t.kind
    colon = np.flatnonzero(kind == 11)
    kind[colon] = np.where(kind[np.maximum(colon - 1, 0)] == 7, 12, 11)
    # begin 0, number 1, [ 2, ] 3, comma 4, { 5, } 6, "type" 7, "coordinates" 8, "geometries" 9, a type's name 10, colon 11, that of a type 12
    t.follows(((0, 5), (5, 7), (5, 8), (5, 9), (7, 12), (12, 10), (8, 11), (9, 11), (11, 2), (10, 4), (10, 6), (4, 7), (4, 8), (4, 9), (4, 5), (4, 2),
               (4, 1), (2, 2), (2, 1), (2, 5), (1, 4), (1, 3), (3, 3), (3, 4), (3, 6), (6, 4), (6, 3)), kind)
    t.bad[t.value[t.last & (kind != 6)]] = True
    what = t.byte
    key, named = np.flatnonzero(kind == 8), np.flatnonzero((kind == 10) & (what < GROUP_))
    n = len(rows)
    t.bad[np.bincount(t.value[key], minlength=n) != np.bincount(t.value[named], minlength=n)] = True
    group, groups = np.flatnonzero(kind == 9), np.flatnonzero((kind == 10) & (what == GROUP_))
    t.bad[np.bincount(t.value[group], minlength=n) != np.bincount(t.value[groups], minlength=n)] = True
    open_ = np.flatnonzero((kind == 2) & (np.append(kind[1:], 0) == 1))
    open_ = open_[~t.bad[t.value[open_]]]
    key, named = key[~t.bad[t.value[key]]], named[~t.bad[t.value[named]]]  # the k-th coordinates go with the k-th type
    if not len(key):
        return rows.tolist()
    mine = np.maximum(np.searchsorted(key, open_) - 1, 0)
    kind_of = what[named[mine]]
    depth = t.depth[open_] - t.depth[key[mine]]
    t.bad[t.value[open_[depth != _JSON_DEPTH[kind_of]]]] = True
    # members of a collection each have their own object: as many objects as types
    t.bad[np.bincount(t.value[kind == 5], minlength=n) != np.bincount(t.value[kind == 10], minlength=n)] = True
    closes = np.flatnonzero(kind == 3)
    count = t.before[closes[np.searchsorted(closes, open_)]] - t.before[open_]
    t.bad[t.value[open_[count < 2]]] = True
    t.bad[np.bincount(t.value[key], weights=np.bincount(mine, minlength=len(key)) == 0, minlength=n) > 0] = True
    keep = ~t.bad[t.value[open_]]
    open_, kind_of = open_[keep], kind_of[keep]
    if len(open_):
        dots = (kind_of == POINT_) | (kind_of == MPOINT_)
        chain = np.where(dots, open_, t.parent(open_, 1))
        new = np.concatenate([[True], chain[1:] != chain[:-1]])
        head = np.flatnonzero(new)
        size = np.diff(np.append(head, len(open_)))
        polygon = np.where((kind_of == POLYGON_) | (kind_of == MPOLYGON_), t.parent(open_, 2), np.where(dots, POINTS, LINE))[head]
        first = t.before[open_]
        flat.add(t.numbers[first], t.numbers[first + 1], size, rows[t.value[open_[head]]], polygon)
    flat.readable[rows[~t.bad]] = True
    return rows[t.bad].tolist()


# --- the test ---------------------------------------------------------------

def intersects_boxes(values: pa.Array, x0, y0, x1, y1) -> pa.Array:
    """Whether each geometry meets its closed box; null for null and unreadable ones.

    A vertex inside the box, a segment that the box clips to something, or a polygon (even-odd over its
    rings) around the box's corner; each over all points, segments and polygons of the batch.
    """
    flat = flatten(values)
    x, y, size, geometry, polygon = flat.columns()
    x0, y0, x1, y1 = (np.asarray(b, float) for b in (x0, y0, x1, y1))
    hit = np.zeros(flat.n, bool)
    owner = np.repeat(geometry, size)
    inside = (x >= x0[owner]) & (x <= x1[owner]) & (y >= y0[owner]) & (y <= y1[owner])
    hit[owner[inside]] = True
    ends = np.cumsum(size) - 1
    segment = np.ones(len(x), bool)
    segment[ends[size > 0]] = False
    segment[np.repeat(polygon == POINTS, size)] = False
    a = np.flatnonzero(segment & ~hit[owner])
    g = owner[a]
    hit[g[_clipped(x[a], y[a], x[a + 1], y[a + 1], x0[g], y0[g], x1[g], y1[g])]] = True
    ring = (polygon >= 0) & (size >= 3)
    a = np.flatnonzero(segment & np.repeat(ring, size) & ~hit[owner])
    g, p = owner[a], np.repeat(polygon, size)[a]
    px, py = x0[g], y0[g]
    crosses = (y[a] > py) != (y[a + 1] > py)
    a, g, p, px, py = a[crosses], g[crosses], p[crosses], px[crosses], py[crosses]
    right = px < x[a] + (py - y[a]) * (x[a + 1] - x[a]) / (y[a + 1] - y[a])
    if len(p):
        odd = np.bincount(p[right], minlength=int(p.max()) + 1) % 2 == 1
        hit[g[odd[p]]] = True
    return pa.array(hit, mask=~flat.readable)


def _clipped(ax, ay, bx, by, x0, y0, x1, y1) -> np.ndarray:
    """Segments of which a box leaves something (Liang and Barsky: the interval of the parameter that all four sides allow)."""
    dx, dy = bx - ax, by - ay
    low, high = np.zeros(len(ax)), np.ones(len(ax))
    fine = np.ones(len(ax), bool)
    for p, q in ((-dx, ax - x0), (dx, x1 - ax), (-dy, ay - y0), (dy, y1 - ay)):
        still = p == 0
        fine &= ~(still & (q < 0))
        r = np.divide(q, p, out=np.zeros_like(q), where=~still)
        low = np.where(p < 0, np.maximum(low, r), low)
        high = np.where(p > 0, np.minimum(high, r), high)
    return fine & (low <= high)
