"""Edges, regions, area resizing and the anchor search on made images, against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from framespan.operators import pixels, search


def flood(cells):
    """Least index of each region, by walking."""
    out = np.full(cells.shape, -1)
    for y, x in np.argwhere(cells):
        if out[y, x] < 0:
            todo, out[y, x] = [(y, x)], y * cells.shape[1] + x
            while todo:
                a, b = todo.pop()
                for c, d in ((a + i, b + j) for i in (-1, 0, 1) for j in (-1, 0, 1)):
                    if 0 <= c < cells.shape[0] and 0 <= d < cells.shape[1] and cells[c, d] and out[c, d] < 0:
                        out[c, d] = out[y, x]
                        todo.append((c, d))
    return out


def spiral(n):
    cells = np.zeros((n, n), bool)
    y = x = k = 0
    for step, length in enumerate(sorted([*range(n - 1, 0, -2), *range(n - 1, 0, -2)], reverse=True)):
        dy, dx = ((0, 1), (1, 0), (0, -1), (-1, 0))[step % 4]
        for _ in range(length):
            cells[y, x] = True
            y, x, k = y + dy, x + dx, k + 1
    return cells


@pytest.mark.parametrize("share", [0.05, 0.3, 0.45, 0.6, 1.0])
def test_regions_are_flood_fills(share):
    rnd = np.random.default_rng(int(share * 100))
    for shape in ((1, 1), (1, 9), (9, 1), (23, 31)):
        cells = rnd.random(shape) < share
        assert (pixels.regions(cells) == flood(cells)).all()
    assert (pixels.regions(spiral(41)) == flood(spiral(41))).all()


def test_hysteresis_keeps_weak_cells_of_strong_regions():
    rnd = np.random.default_rng(1)
    strength = rnd.integers(0, 100, (40, 50))
    labels = flood(strength > 60)
    strong = {labels[y, x] for y, x in np.argwhere(strength > 97)}
    assert (pixels.hysteresis(strength, 60, 97) == np.isin(labels, list(strong - {-1}))).all()
    assert 0 < pixels.hysteresis(strength, 60, 97).sum() < (strength > 60).sum()


def test_edges_follow_a_step_and_an_outline():
    step = np.zeros((20, 20), int)
    step[:, 10:] = 200
    found = pixels.edges(step, 50, 150) > 0
    assert found[:, 9:11].any(1).all() and not found[:, :8].any() and not found[:, 13:].any()
    assert not pixels.edges(np.full((9, 9), 77)).any()
    y, x = np.mgrid[:60, :60]
    disk = np.where(np.hypot(y - 30, x - 28) < 15, 220, 20)
    away = np.abs(np.hypot(*(np.argwhere(pixels.edges(disk)) - [30, 28]).T) - 15)
    assert away.max() < 3 and len(away) > 80


@pytest.mark.parametrize("box, out", [((0, 0, 12, 9), (5, 7)), ((2, 1, 7, 5), (3, 3)), ((-3, 4, 9, 11), (4, 6)), ((5, 5, 1, 1), (2, 2)), ((20, 20, 4, 4), (2, 3))])
def test_area_mean_is_the_sum_over_cells(box, out):
    image = np.random.default_rng(3).integers(0, 256, (9, 12))
    x, y, w, h = box
    expected = np.zeros(out)
    part = lambda a, lo, hi: max(0.0, min(a + 1, hi) - max(a, lo))
    for i in range(out[0]):
        for j in range(out[1]):
            rows = [part(a, y + h * i / out[0], y + h * (i + 1) / out[0]) for a in range(9)]
            columns = [part(b, x + w * j / out[1], x + w * (j + 1) / out[1]) for b in range(12)]
            expected[i, j] = np.array(rows) @ image @ np.array(columns) / (w / out[1] * h / out[0])
    assert np.allclose(pixels.area_mean(pixels.summed(image), x, y, w, h, out[1], out[0]), expected)


VIDEO = (96, 120)
FULL = (64, 80)
K, FPS = 2, 4.0


def scene(t):
    """A moving scene: a disk and bars whose places depend on the time in video frames."""
    y, x = np.mgrid[: VIDEO[0], : VIDEO[1]]
    image = 40 + 30 * ((x // 9 + y // 11) % 2)
    image = np.where(np.hypot(y - 48 - 6 * np.sin(t / 5), x - 60 - t) < 17, 230, image)
    return np.where(np.abs(y - 20 - t) < 3, 150, image).astype(int)


@pytest.fixture(scope="module")
def planted(spark):
    """The thermal maps show crop 2 of frames 20 + 4 o; anchor 'b' the same around frame 24."""
    crops = {1: (0, 0, 100, 80), 2: (24, 12, 80, 64), 3: (30, 20, 80, 64), 4: (-10, 0, 90, 72)}
    frames = {t: scene(t) for t in range(48)}
    video = [("s", t, image.ravel().tolist(), {"cx": 60.0 + t, "cy": 48.0, "r": 17.0}) for t, image in frames.items()]
    thermal, candidates = [], []
    for anchor, true in (("a", 20), ("b", 24)):
        for o in range(-K, K + 1):
            t = true + int(o * FPS)
            small = pixels.area_mean(pixels.summed(frames[t]), *crops[2], FULL[1] // 2, FULL[0] // 2)
            scale = FULL[1] / crops[2][2]
            thermal.append((anchor, o, np.rint(small).astype(int).ravel().tolist(), {"cx": (60.0 + t - 24) * scale, "cy": 36.0 * scale, "r": 17.0 * scale}))
        candidates += [(anchor, "s", c, float(c - true - 3), FPS, 48) for c in range(4, 44)]
    rows = [(a, c, s, *box) for a, _, c, *_ in candidates for s, box in crops.items()]
    circle = "struct<cx:double,cy:double,r:double>"
    return (
        spark.createDataFrame(candidates, "anchor string, sequence_id string, candidate long, distance double, fps double, frame_count long"),
        spark.createDataFrame(thermal, f"anchor string, o int, gray array<int>, circle {circle}"),
        spark.createDataFrame(rows, "anchor string, candidate long, strategy int, x int, y int, w int, h int"),
        spark.createDataFrame(video, f"sequence_id string, frame_index long, gray array<int>, circle {circle}"),
    )


def ranked(tables, **options):
    found = search.anchor_search(*tables, k=K, size=(FULL[0] // 2, FULL[1] // 2), video_size=VIDEO, full=FULL, **options)
    return found.orderBy("anchor", "rank").collect()


def test_the_planted_frame_and_crop_are_found(planted):
    rows = ranked(planted)
    best = {r.anchor: r for r in rows if r["rank"] == 1}
    assert {a: (r.candidate, r.strategy, r.hard_pass) for a, r in best.items()} == {"a": (20, 2, True), "b": (24, 2, True)}
    assert all(r.full_visual_mean > 0.99 and (r.x, r.y, r.w, r.h) == (24, 12, 80, 64) for r in best.values())
    inside = [c for c in range(4, 44) if c - 8 >= 0 and c + 8 < 48]
    assert sorted((r.anchor, r.candidate) for r in rows) == sorted((a, c) for a in "ab" for c in inside)
    assert rows == ranked(planted, block=3)  # blocks do not show
    r = best["a"]
    scores = [r[f"score_tiff_{n}"] for n in ("m2", "m1", "p0", "p1", "p2")]
    assert r.center == scores[2] and r.least == min(scores) and r.aggregate == pytest.approx(np.mean(scores))


def test_pair_scores_by_hand(planted):
    candidates, thermal, crops, video = planted
    pairs = search.pair_scores(search.streams(search.needed(candidates, K), thermal, crops, video, 16), FULL[0] // 2, FULL[1] // 2, *VIDEO, FULL)
    maps = {(r.anchor, r.o): r for r in thermal.collect()}
    for r in pairs.orderBy(F.rand(4)).limit(12).collect():
        theirs = np.array(maps[r.anchor, r.o].gray).reshape(FULL[0] // 2, -1)
        small = np.rint(pixels.area_mean(pixels.summed(scene(int(r.candidate + r.o * FPS))), r.x, r.y, r.w, r.h, FULL[1] // 2, FULL[0] // 2)).astype(int)
        cos = lambda a, b: float(np.dot(a.ravel().astype(float), b.ravel())) / np.sqrt(float((a.astype(float) ** 2).sum()) * float((b.astype(float) ** 2).sum()))
        both = 0.75 * cos(pixels.edges(theirs), pixels.edges(small)) + 0.25 * cos(pixels.gradient(theirs), pixels.gradient(small))
        assert r.full_visual == pytest.approx(both, abs=1e-8)
        y, x = np.mgrid[: FULL[0] // 2, : FULL[1] // 2]
        c = maps[r.anchor, r.o].circle
        disk = np.hypot(y - c.cy / 2, x - c.cx / 2) <= c.r / 2 * 1.22
        both = 0.75 * cos(pixels.edges(theirs)[disk], pixels.edges(small)[disk]) + 0.25 * cos(pixels.gradient(theirs)[disk], pixels.gradient(small)[disk])
        assert r.masked_visual == pytest.approx(both, abs=1e-8)


def test_missing_images_and_empty_tables(planted, spark):
    candidates, thermal, crops, video = planted
    cut = video.withColumn("gray", F.when(F.col("frame_index") != 30, F.col("gray"))).where("frame_index <> 12")
    rows = ranked((candidates, thermal, crops, cut))
    lost = {c for c in range(8, 40) for o in range(-K, K + 1) if c + 4 * o in (12, 30)}
    assert {r.candidate for r in rows} == set(range(8, 40)) - lost
    for k in range(4):
        assert ranked([t.limit(0) if i == k else t for i, t in enumerate(planted)]) == []
    twice = ranked((candidates, thermal, crops.union(crops), video))
    assert [(r.candidate, r.strategy, r.aggregate) for r in twice] == [(r.candidate, r.strategy, r.aggregate) for r in ranked(planted)]


def test_drawn_circles_win_the_votes(spark):
    y, x = np.mgrid[:90, :110]
    circles = [(30, 35, 14), (60, 80, 20), (25, 88, 9)]
    edges = np.zeros((90, 110), int)
    for cy, cx, r in circles:
        edges |= (np.abs(np.hypot(y - cy, x - cx) - r) < 0.6).astype(int)
    edges[:, 55] = 1  # a line is no circle
    rows = spark.createDataFrame([(1, edges.ravel().tolist()), (2, [0] * 9900), (3, None)], "id int, edges array<int>")
    found = {r.id: r for r in pixels.vote_circles(rows, 90, 110, (7, 24), least=0.6).collect()}
    assert sorted(zip(found[1].cy, found[1].cx, found[1].r, strict=True)) == sorted(circles)
    assert found[2].cx == [] and found[3].cx is None
    votes = pixels.circle_votes(edges > 0, range(7, 25))
    a, b, k = 33, 41, 5
    assert votes[k, a, b] == sum(round(np.hypot(i - a, j - b)) == 7 + k for i, j in np.argwhere(edges))


def test_regions_have_boundaries_and_circles(spark):
    y, x = np.mgrid[:80, :120]
    mask = (np.hypot(y - 40, x - 30) <= 20).astype(int)
    mask[10:31, 60:101] = 1
    mask[70, 70] = 1
    mask[75, 60:66] = 1  # a line has no inside
    mask[45:56, 80:91] = 1
    mask[48:53, 83:88] = 0  # a hole does not change the outer boundary
    row = pixels.region_features(spark.createDataFrame([(mask.ravel().tolist(),)], "mask array<int>"), 80, 120).first()
    features = {n: (area, *rest) for n, area, *rest in zip(row.label, row.area, row.cx, row.cy, row.r, row.circularity, row.fill, strict=True)}
    disk = features[20 * 120 + 30]
    assert disk[0] == mask[20:61, :60].sum() and disk[1:4] == pytest.approx((30, 40, 20), abs=0.2) and disk[4] > 0.85 and disk[5] > 0.9
    box = features[10 * 120 + 60]
    assert box[0] == 21 * 41 and box[1:4] == pytest.approx((80, 20, np.hypot(10, 20))) and box[4] == pytest.approx(4 * np.pi * 800 / 120**2) and box[5] == pytest.approx(800 / (np.pi * 500))
    assert features[70 * 120 + 70] == (1, 70, 70, 0, 0, 0) and features[75 * 120 + 60] == (6, 62.5, 75, 2.5, 0, 0)
    holed = features[45 * 120 + 80]
    assert holed[0] == 96 and holed[4] == pytest.approx(4 * np.pi * 100 / 40**2)


def test_boundaries_walk_every_outer_cell_once():
    rnd = np.random.default_rng(7)
    for _ in range(60):
        cells = rnd.random((9, 11)) < 0.55
        labels = flood(cells)
        for label in set(labels.ravel()) - {-1}:
            own = labels == label
            path = pixels.boundary(own, divmod(int(label), 11))
            assert all(own[p] for p in path) and len(path) <= 4 * own.sum()
            assert all(max(abs(a[0] - b[0]), abs(a[1] - b[1])) <= 1 for a, b in zip(path, path[1:] + path[:1], strict=True))
            outside = flood(np.pad(~own, 1, constant_values=True)) == 0  # cells that the border reaches over eight neighbours
            edge = {(i, j) for i, j in np.argwhere(own) if any(outside[i + 1 + a, j + 1 + b] for a, b in ((0, 1), (1, 0), (0, -1), (-1, 0)))}
            assert set(path) <= {(i, j) for i, j in np.argwhere(own)} and {p for p in edge if _four(own, p)} <= set(path)


def _four(own, p):
    """Whether a side of the cell is reached from outside over four neighbours."""
    free = np.pad(~own, 1, constant_values=True)
    seen, todo = {(0, 0)}, [(0, 0)]
    while todo:
        a, b = todo.pop()
        for c, d in ((a, b + 1), (a + 1, b), (a, b - 1), (a - 1, b)):
            if 0 <= c < free.shape[0] and 0 <= d < free.shape[1] and free[c, d] and (c, d) not in seen:
                seen.add((c, d))
                todo.append((c, d))
    return any((p[0] + 1 + a, p[1] + 1 + b) in seen for a, b in ((0, 1), (1, 0), (0, -1), (-1, 0)))


def test_least_circles_around_points():
    rnd = np.random.default_rng(5)
    for n in (1, 2, 3, 8, 40):
        points = rnd.integers(0, 30, (n, 2))
        cy, cx, r = pixels.enclosing_radius(points)
        away = np.hypot(points[:, 0] - cy, points[:, 1] - cx)
        assert away.max() <= r + 1e-6
        tried = [np.hypot(points[:, 0] - a, points[:, 1] - b).max() for a, b in rnd.uniform(0, 30, (3000, 2))]
        assert r <= min(tried) + 1e-6
