"""Edge maps, gradients, area resizing and connected regions of gray images.

Kernels work on one image as an array of rows; tables carry an image as an array of cells, row by row, and are worked on in
Arrow batches, an image at a time.  An image is never exploded into rows and never shuffled here."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from framespan.operators.images import by_row

#: Canny: tangents that part the four directions
_LOW, _HIGH = np.tan(np.pi / 8), np.tan(3 * np.pi / 8)
#: thresholds of an edge map as shares of the median level, their bounds, and the pair for a map without contrast
MEDIAN_SHARES, LEAST_UPPER, FLAT_PAIR = (0.66, 1.33), 30, (30, 90)


def around(image: np.ndarray, n: int = 1) -> np.ndarray:
    """The image with n cells more on each side, mirrored without the border cell; a side of one cell is repeated."""
    pads = [(n, n)] * 2
    return np.pad(image, pads, "reflect") if min(image.shape) > n else np.pad(image, pads, "edge")


def blurred(image: np.ndarray) -> np.ndarray:
    """Weights 1 2 1 both ways, sums of sixteenths rounded half up, as levels."""
    p = around(image.astype(np.int64))
    rows = p[:, :-2] + 2 * p[:, 1:-1] + p[:, 2:]
    return (rows[:-2] + 2 * rows[1:-1] + rows[2:] + 8) >> 4


def slopes(image: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sobel sums in x and y."""
    p = around(image.astype(np.int64))
    x, y = p[:, 2:] - p[:, :-2], p[2:] - p[:-2]
    return x[:-2] + 2 * x[1:-1] + x[2:], y[:, :-2] + 2 * y[:, 1:-1] + y[:, 2:]


def ridge(gx: np.ndarray, gy: np.ndarray) -> np.ndarray:
    """The magnitude |gx| + |gy| where it is not less than along its direction, else 0; the border counts as 0 outside."""
    ax, ay = np.abs(gx), np.abs(gy)
    m = ax + ay
    p = np.pad(m, 1)
    at = lambda dy, dx: p[1 + dy : p.shape[0] - 1 + dy, 1 + dx : p.shape[1] - 1 + dx]
    flat, steep = ay < ax * _LOW, ay > ax * _HIGH
    falling = (gx ^ gy) < 0
    before = np.where(flat, at(0, -1), np.where(steep, at(-1, 0), np.where(falling, at(-1, 1), at(-1, -1))))
    after = np.where(flat, at(0, 1), np.where(steep, at(1, 0), np.where(falling, at(1, -1), at(1, 1))))
    last = np.where(flat | steep, m >= after, m > after)
    return np.where((m > before) & last, m, 0)


def regions(cells: np.ndarray) -> np.ndarray:
    """For every cell that is set the least index of the cells it is joined to over the eight neighbours; -1 for others.

    Union-find over all cells at once: every root takes the least root next to it, then paths are halved, until nothing
    changes; the number of rounds grows with the logarithm of a region's length."""
    height, width = cells.shape
    parent = np.arange(height * width)
    grid = parent.reshape(height, width)
    sides = []
    for dy, dx in ((0, 1), (1, -1), (1, 0), (1, 1)):
        a = (slice(0, height - dy), slice(max(0, -dx), width - max(0, dx)))
        b = (slice(dy, height), slice(max(0, dx), width - max(0, -dx)))
        both = cells[a] & cells[b]
        sides.append((grid[a][both], grid[b][both]))
    a, b = (np.concatenate(x) for x in zip(*sides, strict=True))
    while len(a):
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        if not apart.any():
            break
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while (parent[parent] != parent).any():
            parent = parent[parent]
    return np.where(cells.ravel(), parent, -1).reshape(height, width)


def hysteresis(strength: np.ndarray, low: float, high: float) -> np.ndarray:
    """Cells above `low` in a region that has one above `high`."""
    labels = regions(strength > low)
    strong = np.zeros(strength.size + 1, bool)
    strong[labels[strength > high]] = True
    return (labels >= 0) & strong[labels]


def edges(image: np.ndarray, low: float | None = None, high: float | None = None) -> np.ndarray:
    """255 on edges: blur, Sobel, ridges, hysteresis, each edge widened to the cells right and below; 0 elsewhere.

    Without thresholds they follow the median level of the blurred image."""
    smooth = blurred(image)
    if low is None or high is None:
        middle = float(np.median(smooth))
        low, high = int(max(0, MEDIAN_SHARES[0] * middle)), int(min(255, max(LEAST_UPPER, MEDIAN_SHARES[1] * middle)))
        if high <= low:
            low, high = FLAT_PAIR
    found = np.pad(hysteresis(ridge(*slopes(smooth)), low, high), ((1, 0), (1, 0)))
    return 255 * (found[1:, 1:] | found[:-1, 1:] | found[1:, :-1] | found[:-1, :-1]).astype(np.int32)


def stretched(values: np.ndarray) -> np.ndarray:
    """Levels from the 1st to the 99th percentile; least to greatest where these agree; zeros for a constant image."""
    low, high = np.percentile(values, [1, 99])
    if high <= low:
        low, high = values.min(), values.max()
    return np.rint(np.clip((values - low) / (high - low), 0, 1) * 255).astype(np.int32) if high > low else np.zeros(values.shape, np.int32)


def gradient(image: np.ndarray) -> np.ndarray:
    """Length of the Sobel vector, stretched to levels."""
    return stretched(np.hypot(*slopes(image)))


def summed(image: np.ndarray) -> np.ndarray:
    """Sums of all cells above and left of each corner."""
    return np.pad(image.astype(np.float64), ((1, 0), (1, 0))).cumsum(0).cumsum(1)


def area_mean(sums: np.ndarray, x: float, y: float, w: float, h: float, width: int, height: int) -> np.ndarray:
    """The rectangle resized to height x width cells, each the mean over its area; cells cut by a border count by their part,
    outside the image is 0.  Takes the summed-area table, so the cost does not depend on the rectangle's size."""

    def along(table: np.ndarray, start: float, length: float, n: int) -> np.ndarray:
        at = np.clip(start + length * np.arange(n + 1) / n, 0, len(table) - 1)
        low = np.minimum(np.floor(at).astype(int), len(table) - 2)
        part = (at - low)[:, None]
        return table[low] * (1 - part) + table[low + 1] * part

    corners = along(along(sums, y, h, height).T, x, w, width).T
    return np.diff(np.diff(corners, axis=0), axis=1) / (w / width * h / height)


def edge_maps(frames: DataFrame, height: int, width: int, *, low: float | None = None, high: float | None = None) -> DataFrame:
    """edges (0 or 255 a cell) and density of the images `gray`; null without an image."""

    def work(gray):
        if gray is None:
            return {"edges": None, "density": None}
        found = edges(gray.reshape(height, width), low, high)
        return {"edges": found.ravel(), "density": float((found > 0).mean())}

    return by_row(frames, ["gray"], work, "edges array<int>, density double")


def region_labels(frames: DataFrame, height: int, width: int) -> DataFrame:
    """regions: for every cell of `mask` the least cell of its region, -1 where it is 0; count: the number of regions."""

    def work(mask):
        if mask is None:
            return {"regions": None, "count": None}
        labels = regions(mask.reshape(height, width) > 0).ravel()
        return {"regions": labels.astype(np.int32), "count": int((labels == np.arange(len(labels))).sum())}

    return by_row(frames, ["mask"], work, "regions array<int>, count int")


def resized(frames: DataFrame, height: int, width: int, out_height: int, out_width: int) -> DataFrame:
    """small: the images `gray` resized by area; means, not rounded to levels."""

    def work(gray):
        if gray is None:
            return {"small": None}
        return {"small": area_mean(summed(gray.reshape(height, width)), 0, 0, width, height, out_width, out_height).ravel()}

    return by_row(frames, ["gray"], work, "small array<double>")


def ring_offsets(radius: int) -> np.ndarray:
    """Rows and columns of the cells whose rounded distance from a cell is the radius."""
    y, x = np.mgrid[-radius - 1 : radius + 2, -radius - 1 : radius + 2]
    return np.argwhere(np.floor(np.hypot(y, x) + 0.5) == radius) - radius - 1


def circle_votes(cells: np.ndarray, radii: range) -> np.ndarray:
    """Votes by radius and centre: every cell that is set votes for the centres at a rounded distance of the radius."""
    height, width = cells.shape
    found = np.zeros((len(radii), height, width), np.int32)
    at = np.argwhere(cells)
    for k, radius in enumerate(radii):
        for dy, dx in ring_offsets(radius):
            y, x = at[:, 0] + dy, at[:, 1] + dx
            ok = (y >= 0) & (y < height) & (x >= 0) & (x < width)
            found[k, y[ok], x[ok]] += 1  # one offset moves all cells to different places
    return found


def vote_peaks(votes: np.ndarray, radii: range, least: float, apart: int, most: int) -> list[tuple[int, int, int, int]]:
    """Row, column, radius and votes of the circles with the greatest share of their ring, one after the other; of circles
    whose centres are less than `apart` cells from each other in both directions the first stays.

    Only local maxima are sorted: centres with a greater share beside them, at any radius, are left out before."""
    sizes = np.array([len(ring_offsets(r)) for r in radii], float)
    share = votes / sizes[:, None, None]
    best = share.argmax(0)  # the least radius of equal shares
    top = np.take_along_axis(share, best[None], 0)[0]
    p = np.pad(top, 1)
    near = np.max([p[1 + dy : 1 + dy + top.shape[0], 1 + dx : 1 + dx + top.shape[1]] for dy in (-1, 0, 1) for dx in (-1, 0, 1)], axis=0)
    y, x = np.nonzero((top >= near) & (top >= least) & (top > 0))
    order = np.lexsort((x, y, best[y, x], -top[y, x]))
    kept: list[tuple[int, int, int, int]] = []
    for i in order:
        if len(kept) == most:
            break
        if all(max(abs(y[i] - a), abs(x[i] - b)) >= apart for a, b, *_ in kept):
            kept.append((int(y[i]), int(x[i]), radii[int(best[y[i], x[i]])], int(votes[best[y[i], x[i]], y[i], x[i]])))
    return kept


def vote_circles(frames: DataFrame, height: int, width: int, radii: tuple[int, int], *, least: float = 0.4, apart: int = 8, most: int = 12) -> DataFrame:
    """cx, cy, r and votes, arrays of the circles found in the maps `edges`, the best first; radii: least and greatest.

    Candidates of the tracker are the rows of arrays_zip over them."""
    tried = range(radii[0], radii[1] + 1)

    def work(edges):
        if edges is None:
            return dict.fromkeys(("cx", "cy", "r", "votes"))
        found = vote_peaks(circle_votes(edges.reshape(height, width) > 0, tried), tried, least, apart, most)
        return {"cx": [float(x) for _, x, *_ in found], "cy": [float(y) for y, *_ in found], "r": [float(r) for *_, r, _ in found], "votes": [n for *_, n in found]}

    return by_row(frames, ["edges"], work, "cx array<double>, cy array<double>, r array<double>, votes array<int>")


def vote_sums(frames: DataFrame, height: int, width: int, radii: tuple[int, int]) -> DataFrame:
    """total: the votes of a map, each times its radius and place, as a check of the accumulator."""
    tried = range(radii[0], radii[1] + 1)

    def work(edges):
        if edges is None:
            return {"total": None}
        votes = circle_votes(edges.reshape(height, width) > 0, tried).reshape(len(tried), -1).astype(np.int64)
        return {"total": int((votes * (np.array(tried)[:, None] * height * width + np.arange(height * width))).sum())}

    return by_row(frames, ["edges"], work, "total long")


#: steps around a cell, clockwise from the left, as rows and columns
_TURN = ((0, -1), (-1, -1), (-1, 0), (-1, 1), (0, 1), (1, 1), (1, 0), (1, -1))


def boundary(cells: np.ndarray, start: tuple[int, int]) -> list[tuple[int, int]]:
    """The outer boundary of the region whose first cell in reading order is `start`, clockwise, by turning around each cell
    from the side it was entered; a cell that is passed twice is there twice."""
    height, width = cells.shape
    path, at, side = [start], start, 0
    first_move = None
    while True:
        for k in range(8):
            turn = (side + k) % 8
            y, x = at[0] + _TURN[turn][0], at[1] + _TURN[turn][1]
            if 0 <= y < height and 0 <= x < width and cells[y, x]:
                break
        else:
            return path
        if at == start and first_move == turn:
            return path[:-1]
        first_move = turn if first_move is None else first_move
        at, side = (y, x), (turn + 6 - turn % 2) % 8  # just after the empty cell that was looked at last
        path.append(at)


def enclosing_radius(points: np.ndarray) -> tuple[float, float, float]:
    """Centre and radius of the least circle around points, grown point by point from those outside."""

    def of_two(a, b):
        return (*((a + b) / 2), float(np.hypot(*(a - b))) / 2)

    def of_three(a, b, c):
        m = 2 * np.array([b - a, c - a])
        if abs(np.linalg.det(m)) < 1e-12:
            return max((of_two(p, q) for p, q in ((a, b), (a, c), (b, c))), key=lambda t: t[2])
        center = np.linalg.solve(m, [b @ b - a @ a, c @ c - a @ a])
        return (*center, float(np.hypot(*(center - a))))

    def outside(circle, upto):
        far = np.hypot(points[:upto, 0] - circle[0], points[:upto, 1] - circle[1]) > circle[2] + 1e-9
        return np.flatnonzero(far)

    points = np.unique(points.astype(float), axis=0)
    points = points[np.random.default_rng(0).permutation(len(points))]
    circle = (*points[0], 0.0)
    while len(far := outside(circle, len(points))):
        i = far[0]
        circle = (*points[i], 0.0)
        while len(far := outside(circle, i)):
            j = far[0]
            circle = of_two(points[i], points[j])
            while len(far := outside(circle, j)):
                circle = of_three(points[i], points[j], points[far[0]])
    return circle


def region_features(frames: DataFrame, height: int, width: int, *, least_area: int = 1) -> DataFrame:
    """Arrays over the regions of `mask` with least_area cells or more, in the order of their first cells: label, area (in
    cells), cx, cy, r of the least circle around the boundary, circularity and fill.

    Circularity is 4 pi A / P^2 and fill A / (pi r^2), A and P being the area in and the length of the traced boundary; 0 for
    regions without an inside."""
    names = ("label", "area", "cx", "cy", "r", "circularity", "fill")

    def work(mask):
        if mask is None:
            return dict.fromkeys(names)
        labels = regions(mask.reshape(height, width) > 0)
        rows = []
        for label, area in zip(*np.unique(labels[labels >= 0], return_counts=True), strict=True):
            if area < least_area:
                continue
            path = np.array(boundary(labels == label, divmod(int(label), width)), float)
            step = np.roll(path, -1, 0) - path
            inside = abs(float((path[:, 1] * np.roll(path[:, 0], -1) - np.roll(path[:, 1], -1) * path[:, 0]).sum())) / 2
            length = float(np.hypot(*step.T).sum())
            cy, cx, r = enclosing_radius(path)
            rows.append((int(label), int(area), cx, cy, r, 4 * np.pi * inside / length**2 if length else 0.0, inside / (np.pi * r * r) if r else 0.0))
        return dict(zip(names, map(list, zip(*rows, strict=True)) if rows else [[] for _ in names], strict=True))

    return by_row(frames, ["mask"], work, "label array<int>, area array<int>, cx array<double>, cy array<double>, r array<double>, circularity array<double>, fill array<double>")
