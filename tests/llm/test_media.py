import itertools
import os
import random
import struct
import zlib

import numpy as np
import pytest

from lodestrata.llm import media as m
from lodestrata.llm import scratch


def pgm(x):
    return b"P5\n# made here\n%d %d\n255\n" % (x.shape[1], x.shape[0]) + x.astype(np.uint8).tobytes()


def png(x, color=0, how=0):
    """A PNG of gray (h, w), RGB or RGBA (h, w, k) with one filter for all rows."""
    x = x.astype(np.uint8).reshape(x.shape[0], x.shape[1], -1)
    h, w, k = x.shape
    rows, last = [], np.zeros(w * k, int)
    for y in range(h):
        line = x[y].reshape(-1).astype(int)
        left = np.concatenate([np.zeros(k, int), line[:-k]])
        diag = np.concatenate([np.zeros(k, int), last[:-k]])
        p = left + last - diag
        pa, pb, pc = abs(p - left), abs(p - last), abs(p - diag)
        paeth = np.where((pa <= pb) & (pa <= pc), left, np.where(pb <= pc, last, diag))
        base = (0, left, last, (left + last) // 2, paeth)[how]
        rows.append(bytes([how]) + ((line - base) & 255).astype(np.uint8).tobytes())
        last = line
    chunk = lambda t, b: struct.pack(">I", len(b)) + t + b + struct.pack(">I", zlib.crc32(t + b))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, color, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"".join(rows))) + chunk(b"IEND", b"")


def picture(seed, side=96):
    rng = np.random.default_rng(seed)
    return np.clip(np.rint(m._resize(rng.normal(127, 45, (1, side // 4, side // 4)).astype(np.float32), 0.25))[0], 0, 255).astype(np.uint8)


@pytest.mark.parametrize("how", range(5))
def test_png(how):
    rng = np.random.default_rng(how)
    x = rng.integers(0, 256, (9, 7))
    assert (m.decode(png(x, 0, how)) == x).all()
    rgb = rng.integers(0, 256, (5, 6, 3))
    want = np.rint(rgb @ np.array([0.299, 0.587, 0.114]))
    assert np.abs(m.decode(png(rgb, 2, how)).astype(int) - want).max() <= 1


def test_other_bytes():
    x = picture(1)
    assert (m.decode(pgm(x)) == x).all()
    for bad in (None, b"", b"GIF89a", b"P5\n3 3\n255\nx", png(x)[:60], b"\x89PNG\r\n\x1a\n", b"P5"):
        assert m.decode(bad) is None


def sampled(x, h, w, at):
    """Bilinear values of x where ``at`` puts each pixel of an h x w image; outside: 0."""
    yy, xx = np.mgrid[0:h, 0:w].astype(float)
    y, z = at(yy, xx)
    inside = (y >= -0.5) & (y <= x.shape[0] - 0.5) & (z >= -0.5) & (z <= x.shape[1] - 0.5)
    y, z = np.clip(y, 0, x.shape[0] - 1.001), np.clip(z, 0, x.shape[1] - 1.001)
    a, b = y.astype(int), z.astype(int)
    f, g, x = y - a, z - b, x.astype(float)
    v = (x[a, b] * (1 - g) + x[a, b + 1] * g) * (1 - f) + (x[a + 1, b] * (1 - g) + x[a + 1, b + 1] * g) * f
    return np.clip(np.rint(np.where(inside, v, 0)), 0, 255).astype(np.uint8)


def turned(x, degrees):
    t, cy, cx = np.radians(degrees), (x.shape[0] - 1) / 2, (x.shape[1] - 1) / 2
    return sampled(x, *x.shape, lambda y, z: (cy + np.cos(t) * (y - cy) - np.sin(t) * (z - cx), cx + np.sin(t) * (y - cy) + np.cos(t) * (z - cx)))


def scaled(x, by):
    h, w = int(x.shape[0] * by), int(x.shape[1] * by)
    parts = [sampled(x, h, w, lambda y, z, a=a, b=b: ((y + a) / by - 0.5, (z + b) / by - 0.5)) for a in (0.25, 0.75) for b in (0.25, 0.75)]
    return np.rint(np.mean(parts, axis=0)).astype(np.uint8)


def noisy(x, sd, seed):
    return np.clip(np.rint(x + np.random.default_rng(seed).normal(0, sd, x.shape)), 0, 255).astype(np.uint8)


def described(x):
    return m.points(np.ascontiguousarray(x)[None])[0]


def brute_linked(a, b):
    """Whether some transform through one pair of descriptors within NEAR bits puts 5 others' places where they are, all pairs tried."""
    (g, p), (h, q) = a, b
    if len(p) < 5 or len(q) < 5:
        return False
    d = np.unpackbits(p[:, None] ^ q[None], axis=2).sum(-1)
    i, j = np.nonzero(d <= m.NEAR)
    z, w = g[i, 0] + 1j * g[i, 1], h[j, 0] + 1j * h[j, 1]
    turn = h[j, 2] / g[i, 2] * np.exp(1j * np.radians(h[j, 3] - g[i, 3]))
    for k in np.argsort(d[i, j], kind="stable")[:200]:
        on = (np.abs(w[k] + turn[k] * (z - z[k]) - w) <= 3 * h[j, 2] + 0.1 * np.abs(w - w[k])) & (np.abs(np.angle(turn / turn[k])) < 0.4) & (np.abs(np.log2(np.abs(turn / turn[k]))) < 0.6)
        if min(len({tuple(np.rint(g[x, :2] / 2)) for x in i[on]}), len({tuple(np.rint(h[x, :2] / 2)) for x in j[on]})) >= 5:
            return True
    return False


def brute_alike(a, b):
    """Whether two images share a row of the table, compared one by one."""
    rows = {}
    for k, c, g in zip(*m.entries(*a), strict=True):
        rows.setdefault(int(k), []).append((int(c), int(g)))
    near = lambda x, y, most: min((x - y) % 256, (y - x) % 256) <= most
    for k, c, g in zip(*m.entries(*b), strict=True):
        for c2, g2 in rows.get(int(k), ()):
            if ((int(c) ^ c2) & (2**64 - 1)).bit_count() <= m.CHECK and near(int(g) & 255, g2 & 255, m.TURNS[0]) and near(int(g) >> 8 & 255, g2 >> 8 & 255, m.TURNS[1]) and abs((int(g) >> 16) - (g2 >> 16)) <= m.APARTS:
                return True
    return False


EDITS = {
    "same": lambda x, s: x,
    "crop": lambda x, s: x[8:, 12:],
    "left half": lambda x, s: x[:, :48],
    "quarter": lambda x, s: x[:48, :48],
    "brightness": lambda x, s: np.clip(x * 0.8 + 20, 0, 255).astype(np.uint8),
    "noise 8": lambda x, s: noisy(x, 8, s),
    "turn 15": lambda x, s: turned(x, 15),
    "turn 30": lambda x, s: turned(x, 30),
    "turn 90": lambda x, s: np.rot90(x),
    "scale 0.8": lambda x, s: scaled(x, 0.8),
    "scale 0.5": lambda x, s: scaled(x, 0.5),
}


def test_recall_of_candidates_and_votes_against_all_pairs():
    """Of edits that all pairs of descriptors link, 9 in 10 at least are candidates and agree; no unrelated pair does."""
    pictures = [picture(s) for s in range(30)]
    points = [described(x) for x in pictures]
    found, all_pairs = {}, {}
    for name, edit in EDITS.items():
        edited = [described(edit(x, s)) for s, x in enumerate(pictures)]
        all_pairs[name] = [brute_linked(a, b) for a, b in zip(points, edited, strict=True)]
        found[name] = [brute_alike(a, b) and m.agree(*a, *b) >= m.MATCHES for a, b in zip(points, edited, strict=True)]
    print({k: (sum(found[k]), sum(all_pairs[k])) for k in EDITS})
    assert all(sum(v) >= 29 for v in all_pairs.values())
    assert all(sum(a and b for a, b in zip(found[k], all_pairs[k], strict=True)) >= 0.9 * sum(all_pairs[k]) - 1 for k in EDITS)
    assert sum(map(sum, found.values())) >= 0.95 * sum(map(sum, all_pairs.values()))
    assert not any(m.agree(*points[i], *points[j]) >= m.MATCHES or brute_linked(points[i], points[j]) for i, j in itertools.combinations(range(12), 2))


def test_parts_of_large_images():
    """A corner of a 1200-pixel image, a quarter, half its size and a turn are found; points are those of any banding and stack."""
    x = picture(99, 1200)
    whole = described(x)
    for part in (x[:500, :500], x[600:, :600], scaled(x, 0.5), turned(x, 15)):
        got = described(part)
        assert m.agree(*whole, *got) >= 20 and brute_alike(whole, got)
    other = described(picture(98, 1200))
    assert m.agree(*whole, *other) < m.MATCHES


def test_points_do_not_depend_on_stack_or_band(monkeypatch):
    x = np.stack([picture(s, 160) for s in range(5)])
    want = m.points(x)
    monkeypatch.setattr(m, "BAND", 64 * 160)
    for i in range(5):
        got = m.points(x[i : i + 1])[0]
        by = [np.lexsort(g.T) for g, _ in (want[i], got)]
        assert len(got[0]) == len(want[i][0]) > 50 and (got[0][by[1]] == want[i][0][by[0]]).all() and (got[1][by[1]] == want[i][1][by[0]]).all()
    assert len(m.points(np.full((1, 96, 96), 7, np.uint8))[0][0]) == 0 and len(m.points(np.zeros((1, 3, 2), np.uint8))[0][0]) == 0


def test_copies_are_found(spark):
    rows, family = [], {}
    for s in range(12):
        x = picture(s)
        edits = [x, x[6:, 9:], np.clip(x * 0.85 + 15, 0, 255), np.rot90(x), noisy(x, 8, s), turned(x, 15), scaled(x, 0.8)] if s < 6 else [x]
        for e in edits:
            family[len(rows)] = s
            rows.append((len(rows), pgm(np.asarray(e)), "x"))
    n = len(rows)
    rows += [(n, pgm(picture(0)), "x"), (n + 1, None, "x"), (n + 2, b"junk", "x"), (n + 3, b"junk", "x"), (None, pgm(picture(7)), "x"), (0, rows[0][1], "x")]
    df = spark.createDataFrame(rows, "id long, media binary, points string")
    got = m.copies(df).collect()
    assert len(got) == len(rows)
    by = {r["id"]: r for r in got}
    first = {}
    for i, s in family.items():
        first.setdefault(s, i)
    assert {i: by[i]["class_id"] for i in family} == {i: first[s] for i, s in family.items()}
    assert by[n]["class_id"] == 0 and by[n + 1]["n_points"] is None and by[n + 1]["class_id"] == n + 1
    assert by[n + 2]["class_id"] == by[n + 3]["class_id"] == n + 2 and by[n + 2]["class_media"] == 1
    assert by[0]["class_media"] == 7 and by[None]["class_id"] == next(i for i, s in family.items() if s == 7)
    assert m.copies(df.limit(0)).count() == 0
    named = m.copies(spark.createDataFrame([("x2", rows[0][1]), ("7", rows[1][1])], "id string, media binary")).collect()
    assert sorted((r["id"] or -1, r["class_id"]) for r in named) == [(-1, 7), (7, 7)]


@pytest.mark.parametrize("look", [4096, 2])
def test_classes_are_those_of_all_candidates(spark, monkeypatch, look):
    """Chains of ever more noise, in few buckets of many images: classes are those of every candidate pair that agrees, whatever a bucket's size."""
    monkeypatch.setattr(m, "LOOK", look)
    rows = []
    for s in range(4):
        x = picture(s)
        for i in range(10):
            rows.append((len(rows), x))
            x = noisy(x, 7, 100 * s + i) if i % 2 else turned(x, 4)
    points = [described(x) for _, x in rows]
    root = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if brute_alike(points[i], points[j]) and m.agree(*points[i], *points[j]) >= m.MATCHES:
            a, b = root[i], root[j]
            root = [min(a, b) if r in (a, b) else r for r in root]
    random.Random(1).shuffle(rows)
    got = {r["id"]: r["class_id"] for r in m.copies(spark.createDataFrame([(i, pgm(x)) for i, x in rows], "id long, media binary").repartition(3)).collect()}
    assert got == dict(enumerate(root))


def test_postcards(spark):
    df = spark.createDataFrame([(1, [0.5] * 64), (2, [0.5] * 64), (3, None), (4, []), (5, [float("nan")] * 3)], "vec_id long, embedding array<float>")
    got = {r["id"]: r["media"] for r in m.postcards(df).collect()}
    assert got[1] == got[2] and m.decode(got[1]).shape == (72, 72) and got[3] is None and got[4] is None and m.decode(got[5]).shape == (72, 72)


def test_small_tables_take_few_tasks(spark, many_partitions):
    rng = np.random.default_rng(4)
    base = rng.normal(0, 1, 32)
    rows = [(i, [float(x) for x in (base + rng.normal(0, 0.02, 32) if i < 30 else rng.normal(0, 1, 32))]) for i in range(60)]
    mark = scratch.Scratch.mark()
    got = {r["id"]: r["class_id"] for r in m.copies(m.postcards(spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(2))).collect()}
    assert got == {i: 0 if i < 30 else i for i, _ in rows}
    files = [f for s in scratch.Scratch._made[mark:] for _, _, names in os.walk(s.root.removeprefix("file://")) for f in names if f.endswith(".parquet")]
    assert max(int(f.split("-")[1]) for f in files) < 2 * spark.sparkContext.defaultParallelism
    scratch.Scratch.close_since(mark)
