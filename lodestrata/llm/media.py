"""Copies of images, cropped or edited: local descriptors and geometric consensus.

1. Corners (Harris) on a pyramid of scales, each the strongest within a radius.
   The radius grows with the 3/4th power of an image's side, so points grow with
   its root; a larger radius picks a subset of a smaller one's points, so a crop
   keeps the points that its original has there.
2. Each gets an orientation (intensity centroid) and 256 binary tests on the
   smoothed patch, turned by it, as in ORB (Rublee et al., 2011).
3. A Hamming table over sampled bits: its keys join a point and each of its
   ``MATES`` nearest ones on a level, ``BITS`` bits of either and the coarse
   angles between them. Two images are a candidate if they share a key and 64
   further bits and the finer geometry agree too.
4. A candidate is decided on all descriptors of both: mutually nearest ones
   within ``NEAR`` bits are matches, each match is a similarity transform (turn,
   scale, shift), and images are linked if ``MATCHES`` places of either agree on one.

Equal media collapse by digest first. The table's rows are shuffled once; of a
bucket go on the rows that agree with another one there. In each of ``ROUNDS``
rounds every image is then compared with one image only, the one that leads most
of its buckets (another leader each round) and is in another class; what links
is merged. Candidates of
different classes that are then left are all compared. In a bucket they are met
by joining what isn't in its main class with the bucket, so a group of copies
costs as many rows as it has images.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .scratch import Scratch

#: The pyramid's first scale, the ratio of neighbours, and its last.
FIRST, STEP, LAST = 0.5, 2**0.25, 4.0
#: Radius of a patch, least distance from an edge, and the radius in which a point of an image of ``SIDE`` x ``SIDE`` pixels is the strongest.
RADIUS, EDGE, APART, SIDE = 20, 6, 11, 96
NEAR, MATCHES = 40, 5
#: Points that a point is joined with, and sampled bits of either in a key. Unrelated rows of a bucket halve with each bit.
MATES, BITS = 5, 11
#: Most differing bits of 64; differences of the two angles (256ths of a turn) and of the distance (32nds of an octave).
CHECK, TURNS, APARTS = 12, (10, 14), 8
ROUNDS = 2
#: Rows of a bucket up to which it is looked through for rows without a partner; larger ones keep all rows.
LOOK = 4096
#: Rows that count as one image's when tasks are shared out.
TABLE_ROWS = 8
#: Pixels of a level that are worked on at once, besides what surrounds them.
BAND = 1 << 20

_rng = np.random.default_rng(17)
_TESTS = _rng.normal(0, RADIUS / 2.2, (4096, 2, 2)).astype(np.float32)
_TESTS = _TESTS[(np.hypot(_TESTS[..., 0], _TESTS[..., 1]) <= RADIUS).all(axis=1)][:256]
_DISC = np.array([(y, x) for y in range(-RADIUS, RADIUS + 1) for x in range(-RADIUS, RADIUS + 1) if x * x + y * y <= RADIUS * RADIUS])
#: The tests that a key samples, and those that are checked in a bucket.
_SAMPLE, _CHECKED = np.split(np.random.default_rng(3).permutation(256)[: BITS + 32], [BITS])


def decode(blob: bytes | None) -> np.ndarray | None:
    """Gray levels of a PNG (8 bits, not interlaced) or binary PNM image; None if it is neither, or broken."""
    try:
        if not blob:
            return None
        if blob[:8] == b"\x89PNG\r\n\x1a\n":
            return _png(blob)
        if blob[:2] in (b"P5", b"P6"):
            return _pnm(blob)
    except (ValueError, IndexError, KeyError, zlib.error):
        pass
    return None


def _gray(x: np.ndarray) -> np.ndarray:
    return (x[..., :3].astype(np.float32) @ np.array([0.299, 0.587, 0.114], np.float32)).round().astype(np.uint8) if x.shape[-1] >= 3 else x[..., 0]


def _pnm(blob: bytes) -> np.ndarray | None:
    at, field = 2, []
    while len(field) < 3:
        while blob[at : at + 1].isspace():
            at += 1
        if blob[at : at + 1] == b"#":
            at = blob.index(b"\n", at)
            continue
        end = at
        while not blob[end : end + 1].isspace():
            end += 1
            if end > len(blob):
                return None
        field.append(int(blob[at:end]))
        at = end
    w, h, top = field
    k = 3 if blob[:2] == b"P6" else 1
    if top != 255 or w < 1 or h < 1:
        return None
    return _gray(np.frombuffer(blob, np.uint8, w * h * k, at + 1).reshape(h, w, k))


def _png(blob: bytes) -> np.ndarray | None:
    at, data, palette = 8, b"", None
    w = h = depth = color = lace = 0
    while at + 8 <= len(blob):
        n, kind = int.from_bytes(blob[at : at + 4], "big"), blob[at + 4 : at + 8]
        body = blob[at + 8 : at + 8 + n]
        if kind == b"IHDR":
            w, h, depth, color, _, _, lace = int.from_bytes(body[:4], "big"), int.from_bytes(body[4:8], "big"), *body[8:13]
        elif kind == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            data += body
        at += 12 + n
    k = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[color]
    if depth != 8 or lace or not w or not h:
        return None
    raw = np.frombuffer(zlib.decompress(data), np.uint8).reshape(h, 1 + w * k)
    out, last = np.zeros((h, w * k), np.uint8), np.zeros(w * k, np.uint8)
    for y in range(h):
        how, line = int(raw[y, 0]), raw[y, 1:].copy()
        if how == 2:
            line += last
        elif how == 1:
            line = np.cumsum(line.reshape(w, k), axis=0, dtype=np.uint8).reshape(-1)
        elif how in (3, 4):
            v, up = line.tolist(), last.tolist()
            for i in range(len(v)):
                a, b = v[i - k] if i >= k else 0, up[i]
                if how == 3:
                    v[i] = (v[i] + (a + b) // 2) & 255
                else:
                    c = up[i - k] if i >= k else 0
                    pa_, pb, pc_ = abs(b - c), abs(a - c), abs(a + b - 2 * c)
                    v[i] = (v[i] + (a if pa_ <= pb and pa_ <= pc_ else b if pb <= pc_ else c)) & 255
            line = np.array(v, np.uint8)
        elif how:
            return None
        out[y] = last = line
    out = out.reshape(h, w, k)
    return _gray(palette[out[..., 0]]) if color == 3 else _gray(out[..., :1] if k == 2 else out)


def _resize(x: np.ndarray, by: float, top: int = 0, end: int | None = None) -> np.ndarray:
    """A stack of images, ``by`` times smaller, bilinear; only its rows from ``top`` to ``end``."""
    if by == 1.0:
        return x[:, top:end]
    h, w = int(x.shape[1] / by), int(x.shape[2] / by)
    ys, xs = (np.arange(h)[top:end] + 0.5) * by - 0.5, (np.arange(w) + 0.5) * by - 0.5
    y0, x0 = np.clip(ys.astype(int), 0, x.shape[1] - 2), np.clip(xs.astype(int), 0, x.shape[2] - 2)
    fy, fx = (ys - y0).astype(np.float32)[:, None], (xs - x0).astype(np.float32)
    x = x[:, y0] * (1 - fy) + x[:, y0 + 1] * fy
    return x[:, :, x0] * (1 - fx) + x[:, :, x0 + 1] * fx


def _cut(x: np.ndarray, axis: int, at: int, n: int) -> np.ndarray:
    return x[:, at : at + n] if axis == 1 else x[:, :, at : at + n]


def _blur(x: np.ndarray, r: int) -> np.ndarray:
    """Box mean of side 2 r + 1, edges repeated."""
    for axis in (1, 2):
        n = x.shape[axis]
        p = np.concatenate([np.repeat(x.take([0], axis), r, axis), x, np.repeat(x.take([-1], axis), r, axis)], axis)
        x = _cut(p, axis, 0, n).copy()
        for i in range(1, 2 * r + 1):
            x += _cut(p, axis, i, n)
        x *= np.float32(1 / (2 * r + 1))
    return x


def _highest(x: np.ndarray, r: int) -> np.ndarray:
    """The maximum within r in either direction."""
    for axis in (1, 2):
        pad = [(0, 0)] * 3
        pad[axis] = (r, r)
        x = np.pad(x, pad, constant_values=-np.inf)
        have = 1
        while have < 2 * r + 1:
            by = min(have, 2 * r + 1 - have)
            n = x.shape[axis] - by
            x = np.maximum(_cut(x, axis, 0, n), _cut(x, axis, by, n))
            have += by
    return x


def _level(x: np.ndarray, by: float, scale: float, apart: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(image, [x, y, scale, degrees], descriptor) of the points of the level that a stack resized ``by`` is; in bands of rows."""
    h, w = int(x.shape[1] / by), int(x.shape[2] / by)
    step, reach = max(64, BAND // (len(x) * w)), max(apart, RADIUS) + 8
    bands = [_band(_resize(x, by, max(0, y - reach), y + step + reach), max(0, y - reach), max(y, EDGE), min(y + step, h - EDGE), scale, apart) for y in range(0, h, step)]
    return tuple(np.concatenate(z) for z in zip(*bands, strict=True))


def _band(x: np.ndarray, at: int, top: int, end: int, scale: float, apart: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The points in rows ``top`` to ``end`` of a level of which ``x`` holds the rows from ``at`` on."""
    soft = _blur(x, 1)
    gy, gx = np.gradient(soft, axis=(1, 2))
    a, b, c = _blur(gx * gx, 2), _blur(gy * gy, 2), _blur(gx * gy, 2)
    r = a * b - c * c - np.float32(0.05) * (a + b) ** 2
    core = (slice(None), slice(top - at, max(top, end) - at), slice(EDGE, -EDGE))
    i, y, z = np.nonzero((r[core] >= _highest(r, apart)[core]) & (r[core] > 30))
    y, z = y + top - at, z + EDGE
    # What lies beyond an edge is taken to be like the edge. Sums are row by row, so that they don't depend on the stack.
    py, px = np.clip(y[:, None] + _DISC[:, 0], 0, x.shape[1] - 1), np.clip(z[:, None] + _DISC[:, 1], 0, x.shape[2] - 1)
    patch = soft[i[:, None], py, px]
    turn = np.arctan2((patch * _DISC[:, 0].astype(np.float32)).sum(axis=1), (patch * _DISC[:, 1].astype(np.float32)).sum(axis=1))
    cos, sin = np.cos(turn)[:, None, None], np.sin(turn)[:, None, None]
    ty, tx = _TESTS[None, :, :, 0], _TESTS[None, :, :, 1]
    py = np.clip(np.rint(sin * tx + cos * ty).astype(np.int64) + y[:, None, None], 0, x.shape[1] - 1)
    px = np.clip(np.rint(cos * tx - sin * ty).astype(np.int64) + z[:, None, None], 0, x.shape[2] - 1)
    wide = _blur(soft, 2)
    v = wide.reshape(-1)[(i[:, None, None] * x.shape[1] + py) * x.shape[2] + px]
    bits = np.packbits(v[:, :, 0] < v[:, :, 1], axis=1)
    return i, np.stack([(z + 0.5) * scale - 0.5, (y + at + 0.5) * scale - 0.5, np.full(len(z), scale), np.degrees(turn)], axis=1).astype(np.float32), bits


def points(images: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each of a stack of equally large images ([x, y, scale, degrees] as float32, descriptors as 32 bytes)."""
    n, h, w = images.shape
    apart = round(APART * max(1.0, np.sqrt(h * w) / SIDE) ** 0.75)
    got = [(np.zeros(0, np.int64), np.zeros((0, 4), np.float32), np.zeros((0, 32), np.uint8))]
    base = x = images.astype(np.float32)
    for k in range(round(np.log(LAST / FIRST) / np.log(STEP)) + 1):
        scale = FIRST * STEP**k
        # Levels from the image's own size on are resized from one to the next, those below from the image.
        by = scale if scale < 0.999 else 1.0
        if scale > 1.001:
            x = _resize(x, STEP)
        if min(h, w) >= 3 and min(x.shape[1:]) / by >= 2 * EDGE + 12:
            got.append(_level(base if by < 1 else x, by, scale, apart))
    own, geom, bits = (np.concatenate(t) for t in zip(*got, strict=True))
    by = np.argsort(own, kind="stable")
    cut = np.searchsorted(own[by], np.arange(n + 1))
    return [(geom[by[cut[i] : cut[i + 1]]], bits[by[cut[i] : cut[i + 1]]]) for i in range(n)]


def agree(geom: np.ndarray, bits: np.ndarray, others: np.ndarray, bits2: np.ndarray) -> int:
    """How many places of two images agree on one similarity transform: the fewer of either's."""
    n, m = len(bits), len(bits2)
    if min(n, m) < MATCHES:
        return 0
    a, b = np.ascontiguousarray(bits).view(np.uint64), np.ascontiguousarray(bits2).view(np.uint64)
    low, to = np.zeros(n, np.uint16), np.zeros(n, np.int64)
    high, back = np.full(m, 999, np.uint16), np.zeros(m, np.int64)
    step = max(1, (1 << 20) // m)
    for at in range(0, n, step):
        d = np.zeros((len(a[at : at + step]), m), np.uint16)
        for k in range(4):
            d += np.bitwise_count(a[at : at + step, k, None] ^ b[None, :, k])
        to[at : at + step] = d.argmin(axis=1)
        low[at : at + step] = d.min(axis=1)
        best = d.min(axis=0)
        less = best < high
        back[less], high[less] = d.argmin(axis=0)[less] + at, best[less]
    i = np.flatnonzero((low <= NEAR) & (back[to] == np.arange(n)))
    if len(i) < MATCHES:
        return 0
    p, q, dist = geom[i], others[to[i]], low[i]
    z, w = p[:, 0] + 1j * p[:, 1], q[:, 0] + 1j * q[:, 1]
    size = q[:, 2] / p[:, 2]
    turn = size * np.exp(1j * np.radians(q[:, 3] - p[:, 3]))
    # The closest matches are tried as transforms; each looks for others near where it puts them.
    h = np.argsort(dist, kind="stable")[:64]
    off = np.abs(w[h, None] + turn[h, None] * (z[None] - z[h, None]) - w[None])
    like = (np.abs(np.angle(turn[None] / turn[h, None])) < 0.45) & (np.abs(np.log2(size[None] / size[h, None])) < 0.6)
    ok = like & (off <= 4 * q[None, :, 2] + 0.15 * np.abs(w[None] - w[h, None]))
    most = 0
    for k in np.argsort(-ok.sum(axis=1), kind="stable")[:3]:
        on = ok[k]
        for _ in range(3):
            u, v = z[on] - z[on].mean(), w[on] - w[on].mean()
            spread = (np.abs(u) ** 2).sum()
            if on.sum() < 2 or spread < 1e-6:
                break
            fit = (v * np.conj(u)).sum() / spread
            if np.abs(fit) < 1e-6:
                break
            near = np.abs(w[on].mean() + fit * (z - z[on].mean()) - w) <= 2.5 * q[:, 2]
            on = near & (np.abs(np.angle(turn / fit)) < 0.45) & (np.abs(np.log2(size / np.abs(fit))) < 0.6)
            if not on.any():
                break
        places = (len(np.unique(np.rint(x[on] / 2))) for x in (z, w))
        most = max(most, min(places))
    return most



def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as int64."""
    return bits.astype(np.int64) @ (np.int64(1) << np.arange(bits.shape[1], dtype=np.int64))


def entries(geom: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, checked bits, geometry) of each point with each of its nearest ones on its level, as int64."""
    one, two = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for s in np.unique(geom[:, 2]):
        i = np.flatnonzero(geom[:, 2] == s)
        k = min(MATES, len(i) - 1)
        z = geom[i, 0] + 1j * geom[i, 1]
        for at in range(0, len(i) if k else 0, 1024):
            d = np.abs(z[at : at + 1024, None] - z[None])
            d[np.arange(len(d)), np.arange(at, at + len(d))] = np.inf
            one.append(np.repeat(i[at : at + 1024], k))
            two.append(i[np.argsort(d, axis=1, kind="stable")[:, :k].ravel()])
    p, q = np.concatenate(one), np.concatenate(two)
    test = np.unpackbits(bits, axis=1)
    drawn, check = _words(test[:, _SAMPLE]), _words(test[:, _CHECKED])
    x, y = geom[q, 0] - geom[p, 0], geom[q, 1] - geom[p, 1]
    angles = [np.floor(a / 360 * 256).astype(np.int64) & 255 for a in (np.degrees(np.arctan2(y, x)) - geom[p, 3], geom[q, 3] - geom[p, 3])]
    far = np.clip(np.rint(np.log2(np.maximum(np.hypot(x, y) / geom[p, 2], 1)) * 32), 0, 255).astype(np.int64)
    key = ((drawn[p] << BITS) + drawn[q]) * 64 + (angles[0] >> 5) * 8 + (angles[1] >> 5)
    return key, check[p] ^ (check[q] << 32), angles[0] + (angles[1] << 8) + (far << 16)


_POINTS = "n_points int, geom binary, bits binary"


def describe(images: DataFrame, id_col: str = "id", media_col: str = "media") -> DataFrame:
    """(id long, digest string, n_points int, geom binary, bits binary) of each row; the last three are null where the media is none that ``decode`` reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                blobs = part.column(2).to_pylist()
                by, got = defaultdict(list), {}
                for blob in dict.fromkeys(blobs):
                    x = decode(blob)
                    if x is not None:
                        by[x.shape].append((blob, x))
                for own in by.values():
                    step = max(1, (1 << 18) // own[0][1].size)
                    for i in range(0, len(own), step):
                        for (blob, _), (g, d) in zip(own[i : i + step], points(np.stack([x for _, x in own[i : i + step]])), strict=True):
                            got[blob] = len(g), g.tobytes(), d.tobytes()
                n, geom, bits = zip(*[got.get(x, (None, None, None)) for x in blobs], strict=True)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(n, pa.int32()), pa.array(geom, pa.binary()), pa.array(bits, pa.binary())], ["id", "digest", "n_points", "geom", "bits"])

    own = images.select(F.expr(f"try_cast(`{id_col}` as long)").alias("id"), F.sha2(F.coalesce(F.col(media_col), F.lit(b"")), 256).alias("digest"), F.col(media_col).alias("media"))
    return own.mapInArrow(run, f"id long, digest string, {_POINTS}")


def _table(own: DataFrame) -> DataFrame:
    """(row long, m long, bits long): the Hamming table's rows of every image, key and geometry in one number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                got = [entries(*_read(*x)) for x in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True)]
                m = np.repeat(part.column(0).to_numpy(zero_copy_only=False), [len(k) for k, _, _ in got])
                key, bits, geo = (np.concatenate(x) for x in zip(*got, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array((key << 24) + geo), pa.array(m), pa.array(bits)], ["row", "m", "bits"])

    return own.where("n_points > 1").select("m", "geom", "bits").mapInArrow(run, "row long, m long, bits long")


def _alike(l: str, r: str) -> Column:
    """Whether rows of one bucket agree in the checked bits and in geometry."""
    turn = lambda by, most: F.pmod(F.shiftright(f"{l}.geo", by) - F.shiftright(f"{r}.geo", by) + F.lit(most), F.lit(256)) <= 2 * most
    far = F.abs(F.shiftright(f"{l}.geo", 16) - F.shiftright(f"{r}.geo", 16)) <= APARTS
    return (F.bit_count(F.col(f"{l}.bits").bitwiseXOR(F.col(f"{r}.bits"))) <= CHECK) & turn(0, TURNS[0]) & turn(8, TURNS[1]) & far


def _agree(row: np.ndarray, bits: np.ndarray, row2: np.ndarray, bits2: np.ndarray) -> np.ndarray:
    """The same on arrays of the table's rows."""
    a, b = row & 0xFFFFFF, row2 & 0xFFFFFF
    on = (np.bitwise_count(bits ^ bits2) <= CHECK) & (np.abs((a >> 16) - (b >> 16)) <= APARTS)
    for shift, most in ((0, TURNS[0]), (8, TURNS[1])):
        on &= ((a >> shift) - (b >> shift) + most) % 256 <= 2 * most
    return on


def _partnered(table: DataFrame) -> DataFrame:
    """(row, m, bits, lead): the rows that agree with another image's in their bucket (all of a very large bucket), and the image that leads it where they agree with that."""

    def look(row: np.ndarray, m: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = row >> 24
        on, first = np.zeros(len(key), bool), np.searchsorted(key, key)
        lead = _agree(row, bits, row[first], bits[first])
        i, by = np.arange(len(key) - 1), 1
        while len(i):
            i = i[key[i] == key[i + by]]
            j = i + by
            k = (~on[i] | ~on[j]) & (m[i] != m[j])
            k[k] = _agree(row[i[k]], bits[i[k]], row[j[k]], bits[j[k]])
            on[i[k]] = on[j[k]] = True
            by += 1
            i = i[i + by < len(key)]
        return on, np.where(lead, m[first], m)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, passing = [np.zeros(0, np.int64)] * 3, None
        for b in batches:
            row, m, bits = (np.concatenate(x) for x in zip(held, [c.to_numpy(zero_copy_only=False) for c in b.columns], strict=True))
            key = row >> 24
            # Rows of a bucket that has been found to be very large, then whole buckets, then what may go on in the next batch.
            off = int(np.searchsorted(key, passing[0], "right")) if passing else 0
            last = max(off, int(np.searchsorted(key, key[-1]))) if len(key) else 0
            if off:
                lead = np.where(_agree(row[:off], bits[:off], passing[1], passing[3]), passing[2], m[:off])
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (row[:off], m[:off], bits[:off], lead)], ["row", "m", "bits", "lead"])
            if last > off:
                on, lead = look(row[off:last], m[off:last], bits[off:last])
                yield pa.RecordBatch.from_arrays([pa.array(x[on]) for x in (row[off:last], m[off:last], bits[off:last], lead)], ["row", "m", "bits", "lead"])
            held = [x[last:] for x in (row, m, bits)]
            if len(held[0]) > LOOK:
                passing = (key[last], row[last], m[last], bits[last])
                lead = np.where(_agree(held[0], held[2], *passing[1::2]), passing[2], held[1])
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*held, lead)], ["row", "m", "bits", "lead"])
                held = [np.zeros(0, np.int64)] * 3
        on, lead = look(*held)
        yield pa.RecordBatch.from_arrays([pa.array(x[on]) for x in (*held, lead)], ["row", "m", "bits", "lead"])

    rows = table.withColumn("key", F.shiftright("row", 24)).repartition("key").sortWithinPartitions("key", "m")
    return rows.select("row", "m", "bits").mapInArrow(run, "row long, m long, bits long, lead long")


def _read(geom: bytes, bits: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(geom, np.float32).reshape(-1, 4), np.frombuffer(bits, np.uint8).reshape(-1, 32)


def _linked(pairs: DataFrame, shared: DataFrame, near: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Those of the pairs (a, b) that agree; ``shared`` has the points of every m in a shared bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, *cols = batch.columns
            on = [agree(*_read(*x[:2]), *_read(*x[2:])) >= MATCHES for x in zip(*[c.to_pylist() for c in cols], strict=True)]
            on = pa.array(on, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(on), b.filter(on)], ["a", "b"])

    # A leader may be in very many pairs: adaptive execution splits it, and its points are sent once for each part.
    side = lambda k, x: shared.select(F.col("m").alias(k), F.col("geom").alias(f"{x}g"), F.col("bits").alias(f"{x}b")).hint("merge")
    return near(pairs.join(side("b", "r"), "b")).join(side("a", "l"), "a").select("a", "b", "lg", "lb", "rg", "rb").mapInArrow(run, "a long, b long")


def _pairs(x: str, y: str, rows: DataFrame) -> DataFrame:
    return rows.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


def copies(images: DataFrame, id_col: str = "id", media_col: str = "media") -> DataFrame:
    """(id long, n_points int, class_id long, class_media long) of each row of ``images``.

    class_id is the least id of the class that links reach, class_media the
    number of different media in it; equal media are one. Null, empty or
    unreadable media have n_points null and are a class with equal media only.
    Ids are cast to long; what can't be cast is null. Rows of a null id keep
    their rows and take no part in minima. Repeated rows are kept; an empty
    table gives an empty one; other columns play no part. Memory: a worker holds
    some 12 bytes for each pixel of an image, and some 100 MB besides.
    """
    scratch = Scratch(images.sparkSession, "media")
    own = scratch.put(describe(images, id_col, media_col).withColumn("m", F.xxhash64("digest")), "points")
    scratch.sized(own.count() * TABLE_ROWS)
    near = scratch.near
    table = scratch.put(_partnered(_table(own)), "buckets")
    table = table.select(F.shiftright("row", 24).alias("key"), "m", "bits", F.col("row").bitwiseAND(F.lit(0xFFFFFF)).alias("geo"), "lead")
    named = scratch.put(table.select("m").distinct(), "named")
    shared = scratch.put(own.join(_small(named), "m", "left_semi").select("m", "geom", "bits").dropDuplicates(["m"]), "shared")

    links, roots = [], None

    def classed() -> DataFrame:
        """The buckets that hold several classes, with the main class of each."""
        rows = table.withColumn("c", F.col("m")) if roots is None else table.join(_small(roots.withColumnRenamed("node", "m")), "m", "left").withColumn("c", F.coalesce("root", "m")).drop("root")
        main = near(rows.groupBy("key", "c").agg(F.count("*").alias("n"))).groupBy("key").agg(F.max_by("c", F.struct("n", "c")).alias("main"), F.count("*").alias("n"))
        return scratch.put(rows.join(near(main.where("n > 1").select("key", "main")).hint("merge"), "key"), "classed")

    def merge(pairs: DataFrame) -> bool:
        nonlocal roots
        links.append(scratch.put(_linked(scratch.put(pairs, "pairs"), shared, near), "links"))
        if not links[-1].isEmpty():
            every = links[0]
            for x in links[1:]:
                every = every.union(x)
            roots = scratch.put(components(every, scratch), "roots")
            return True
        return False

    def best(tries: DataFrame) -> DataFrame:
        """Each image with the one that leads it in most buckets."""
        tries = near(tries.groupBy("m", "lead").agg(F.count("*").alias("n")))
        return _pairs("m", "lead", near(tries.groupBy("m").agg(F.max_by("lead", F.struct("n", "lead")).alias("lead"))))

    l, r = F.col("l.m"), F.col("r.m")
    on = merge(best(table.where("lead <> m")))
    table = table.drop("lead")
    for turn in range(1, ROUNDS if on else 1):
        rows = classed()
        lead = near(rows.groupBy("key").agg(F.min_by("m", F.xxhash64("m", F.lit(turn))).alias("m")))
        lead = scratch.put(rows.join(lead.hint("merge"), ["key", "m"]), "leads")
        tries = rows.alias("r").join(lead.alias("l").hint("merge"), (F.col("l.key") == F.col("r.key")) & (F.col("l.c") != F.col("r.c")) & _alike("l", "r"))
        if not merge(best(near(tries.select(r.alias("m"), l.alias("lead"))))):
            break
    rows = classed()
    rest = rows.where("c <> main").alias("l").join(rows.alias("r").hint("merge"), (F.col("l.key") == F.col("r.key")) & (F.col("l.c") != F.col("r.c")) & _alike("l", "r"))
    merge(_pairs("m", "n", near(rest.select(l.alias("m"), r.alias("n")))))

    media = near(own.groupBy("digest").agg(F.min("id").alias("first"), F.first("m").alias("m"), F.min("n_points").alias("n_points")))
    media = media.withColumn("root", F.col("m")) if roots is None else media.join(roots.withColumnRenamed("node", "m"), "m", "left").withColumn("root", F.coalesce("root", "m"))
    whole = scratch.put(media, "media")
    least = scratch.put(whole.groupBy("root").agg(F.min("first").alias("class_id"), F.count("*").alias("class_media")), "least")
    whole = scratch.put(whole.join(least, "root").select("digest", "n_points", "class_id", "class_media"), "classes")
    return near(own.select("id", "digest").join(whole, "digest").select("id", "n_points", "class_id", "class_media"))


def _small(df: DataFrame, rows: int = 1 << 22) -> DataFrame:
    """A written table of one or two long columns, sent to all executors only where it has so few rows (at most 64 MB)."""
    return F.broadcast(df) if df.count() <= rows else df.hint("merge")


def postcards(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", side: int = 24, cell: int = 3) -> DataFrame:
    """(id long, media binary): each vector as a PGM image, for tables that have no images.

    The vector is projected to ``side`` x ``side`` gray levels by a fixed random
    matrix, and those are interpolated: like vectors look alike, and every
    corner of the image depends on all of the vector.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lenses: dict[int, np.ndarray] = {}
        for b in batches:
            vectors = b.column(1).to_pylist()
            out: list[bytes | None] = [None] * len(vectors)
            by = defaultdict(list)
            for i, v in enumerate(vectors):
                if v:
                    by[len(v)].append(i)
            for n, own in by.items():
                if n not in lenses:
                    lenses[n] = np.random.default_rng(n).normal(0, 1, (n, side * side)).astype(np.float32)
                for at in range(0, len(own), 64):
                    part = own[at : at + 64]
                    x = np.nan_to_num(np.array([vectors[i] for i in part], np.float32))
                    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
                    g = _resize((127.5 + 45 * (x @ lenses[n])).reshape(-1, side, side), 1 / cell)
                    for i, y in zip(part, np.clip(np.rint(g), 0, 255).astype(np.uint8), strict=True):
                        out[i] = b"P5\n%d %d\n255\n" % (y.shape[1], y.shape[0]) + y.tobytes()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["id", "media"])

    return vectors.select(F.expr(f"try_cast(`{id_col}` as long)").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).mapInArrow(run, "id long, media binary")
