"""Similarity and ring measures on small image maps.

A map is an array of cells, row by row.  Array expressions stay in Spark; what needs gathers over many cells is done on
Arrow batches of bounded size in NumPy.  Images are not shuffled here: the callers join ids first."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: images that are held as arrays at a time inside a batch
ROWS = 128
#: cells whose levels are made at a time
CELLS = 1 << 18


def density(cells: Column) -> Column:
    """Share of cells that are not zero."""
    return F.size(F.filter(cells, lambda x: x > 0)) / F.size(cells)


def cosine(a: Column, b: Column) -> Column:
    """0 when the product of the norms is next to nothing."""

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q), F.lit(0.0), lambda s, p: s + p)

    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms <= 1e-8, 0.0).otherwise(dot(a, b) / norms)


def similarity(edges_a: Column, edges_b: Column, slopes_a: Column, slopes_b: Column) -> Column:
    """Three quarters cosine of the edge maps, one quarter of the gradient maps."""
    return 0.75 * cosine(edges_a, edges_b) + 0.25 * cosine(slopes_a, slopes_b)


def _distance(circle: dict, grid: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Of every cell from the circle's centre; grid: the cells' rows and columns."""
    y, x = grid
    return np.sqrt((x - circle["cx"]) ** 2 + (y - circle["cy"]) ** 2)


def by_row(frames: DataFrame, needs: list[str], work: Callable[..., dict], schema: str) -> DataFrame:
    """Adds the results of work(*values of the needed columns) to the other columns."""
    keep = [c for c in frames.columns if c not in needs]
    kept = ", ".join(f"`{c}` {frames.schema[c].dataType.simpleString()}" for c in keep)
    names = [part.split()[0] for part in schema.split(", ")]

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in it:
            for a in range(0, whole.num_rows, ROWS):
                batch = whole.slice(a, ROWS)
                columns = [batch.column(batch.schema.get_field_index(c)) for c in needs]
                rows = [work(*(None if not x.is_valid else x.values.to_numpy(zero_copy_only=False) if isinstance(x, pa.ListScalar) and not pa.types.is_list(x.type.value_type) else x.as_py() for x in row)) for row in zip(*columns, strict=True)]
                made = [pa.array([r[n] for r in rows], type=_ARROW[schema.split(", ")[k].split()[1]]) for k, n in enumerate(names)]
                yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(c)) for c in keep], *made], names=[*keep, *names])

    return frames.select(*keep, *needs).mapInArrow(batches, f"{kept}, {schema}" if keep else schema)


_ARROW = {"double": pa.float64(), "array<int>": pa.list_(pa.int32()), "array<double>": pa.list_(pa.float64()), "int": pa.int32(), "long": pa.int64(), "string": pa.string()}


def masked_similarity(pairs: DataFrame, height: int, width: int, *, scale: float = 1.22, least: int = 32) -> DataFrame:
    """Cosine of maps a and b inside the circle's disk; of the whole maps when the disk has fewer than `least` cells."""
    grid = np.divmod(np.arange(height * width), width)

    def work(a, b, circle):
        if a is None or b is None:
            return {"similarity": None}
        a, b = a.astype(float), b.astype(float)
        if circle and circle["r"] > 0:
            inside = _distance(circle, grid) <= circle["r"] * scale
            if inside.sum() >= least:
                a, b = a[inside], b[inside]
        norms = np.linalg.norm(a) * np.linalg.norm(b)
        return {"similarity": float(a @ b / norms) if norms > 1e-8 else 0.0}

    return by_row(pairs, ["a", "b", "circle"], work, "similarity double")


def ring_support(frames: DataFrame, height: int, width: int, thickness: float) -> DataFrame:
    """Share of non-zero cells of `map` on the circle's ring, max(3, r * thickness) thick; 0 without circle."""
    grid = np.divmod(np.arange(height * width), width)

    def work(cells, circle):
        if cells is None or not circle or circle["r"] <= 0:
            return {"support": 0.0}
        ring = np.abs(_distance(circle, grid) - circle["r"]) <= max(3.0, circle["r"] * thickness)
        return {"support": float((cells[ring] > 0).mean()) if ring.any() else 0.0}

    return by_row(frames, ["map", "circle"], work, "support double")


def _fused(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """a * b + c, rounded once: the product and the sum with their errors."""

    def halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wide = x * 134217729.0  # 2**27 + 1
        high = wide - (wide - x)
        return high, x - high

    product, (a1, a2), (b1, b2) = a * b, halves(a), halves(b)
    lost = ((a1 * b1 - product) + a1 * b2 + a2 * b1) + a2 * b2
    total = product + c
    part = total - product
    return total + (((product - (total - part)) + (c - part)) + lost)


def normalize(frames: DataFrame, *, ends: bool = True) -> DataFrame:
    """gray: the DN stretched from their 1st to their 99th percentile to 0-255, half-even; zeros for a constant image.

    Where the percentiles agree, least and greatest value take their places, or all is zero without `ends`.  Levels are
    made in doubles, as quantile_cont and SQL make them, so that halves fall alike.  Many images are worked on at a time, CELLS at most or one; a cell without a value has none."""
    keep = [c for c in frames.columns if c != "dn"]
    kept = "".join(f"`{c}` {frames.schema[c].dataType.simpleString()}, " for c in keep)

    def levels(lists: pa.Array) -> pa.Array:
        lengths = lists.value_lengths().fill_null(0).to_numpy()
        cells, of = lists.flatten(), np.repeat(np.arange(len(lists)), lengths)
        x, there = cells.cast(pa.float64()).fill_null(0.0).to_numpy(), cells.is_valid().to_numpy(zero_copy_only=False)
        held = np.bincount(of[there], minlength=len(lists))
        ordered = x[there][np.lexsort((x[there], of[there]))] if there.any() else np.zeros(1)
        first = np.minimum(np.cumsum(held) - held, len(ordered) - 1)
        last = np.maximum(held - 1, 0)

        def percentile(share: float) -> np.ndarray:
            at = last * share
            part = at - np.floor(at)
            below, above = ordered[first + np.floor(at).astype(int)], ordered[first + np.ceil(at).astype(int)]
            return _fused(below, 1 - part, above * part)

        low, high = percentile(0.01), percentile(0.99)
        if ends:
            low, high = np.where(high <= low, ordered[first], low), np.where(high <= low, ordered[first + last], high)
        flat = high <= low
        share = (x - low[of]) / np.where(flat, 1.0, high - low)[of]
        gray = np.where(flat[of], 0, np.rint(np.clip(share, 0, 1) * 255)).astype(np.int32)
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(gray, mask=~there), mask=lists.is_null())

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in it:
            reach = np.cumsum(whole.column(0).value_lengths().fill_null(0).to_numpy(), dtype=np.int64)
            start = 0
            while start < whole.num_rows:
                done = reach[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(reach, done + CELLS, "right")))
                batch = whole.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], levels(batch.column(0))], names=[*keep, "gray"])
                start = stop

    return frames.select("dn", *keep).mapInArrow(batches, f"{kept}gray array<int>")


def ring_features(frames: DataFrame, height: int, width: int) -> DataFrame:
    """Support, off-ring support, coverage by 36 sectors, prominence, contrast and border score of the circle, from
    360 angles over the maps `edges` and `gray`."""
    angle = np.linspace(0, 2 * np.pi, 360, endpoint=False)
    cos, sin = np.cos(angle), np.sin(angle)
    names = ("support", "off_support", "coverage", "prominence", "contrast", "border")

    def work(gray, edges, circle):
        if gray is None or edges is None or not circle or circle["r"] <= 0:
            return dict.fromkeys(names, 0.0)
        cx, cy, r = circle["cx"], circle["cy"], circle["r"]
        grid = np.pad(edges.reshape(height, width) > 0, 2)
        near = np.zeros((height, width), bool)  # an edge within two cells
        for dy in range(5):
            for dx in range(5):
                near |= grid[dy : dy + height, dx : dx + width]

        def at(radius: float) -> tuple[np.ndarray, np.ndarray]:
            return np.rint(cx + radius * cos).astype(int), np.rint(cy + radius * sin).astype(int)

        def hits(radius: float, exact: bool) -> np.ndarray:
            x, y = at(radius)
            fx, fy = (cx + radius * cos, cy + radius * sin) if exact else (x, y)
            ok = (fx >= 2) & (fy >= 2) & (fx < width - 2) & (fy < height - 2)
            found = np.zeros(360, bool)
            found[ok] = near[y[ok].clip(0, height - 1), x[ok].clip(0, width - 1)]
            return found

        fx, fy = cx + r * cos, cy + r * sin
        usable = (fx >= 2) & (fy >= 2) & (fx < width - 2) & (fy < height - 2)
        on = hits(r, True)
        off = np.zeros(360, bool)
        for radius in (r - 12.0, r + 12.0):
            if radius > 2:
                off |= hits(radius, False)
        off &= usable
        levels = []
        for radius in (r - 8.0, r + 8.0):
            x, y = at(radius)
            ok = usable & (x >= 0) & (y >= 0) & (x < width) & (y < height) & (radius > 0)
            levels.append(gray.reshape(height, width)[y[ok], x[ok]])
        contrast = abs(levels[0].mean() - levels[1].mean()) / 255 if len(levels[0]) and len(levels[1]) else 0.0
        border = min(1.0, max(0.0, min(cx, width - cx, cy, height - cy) / max(r, 1.0)))
        return dict(zip(names, map(float, (on.mean(), off.mean(), on.reshape(36, 10).any(1).mean(), max(0.0, on.mean() - off.mean()), contrast, border)), strict=True))

    return by_row(frames, ["gray", "edges", "circle"], work, ", ".join(f"{n} double" for n in names))


def affine_warp(frames: DataFrame, height: int, width: int, out_height: int, out_width: int) -> DataFrame:
    """warped: the image under the 2x3 matrix on the output grid, bilinear, zero outside, half-even levels."""
    y, x = np.divmod(np.arange(out_height * out_width), out_width)

    def work(image, matrix):
        if image is None or matrix is None:
            return {"warped": None}
        m = np.array(matrix, float)
        sx, sy = np.linalg.solve(m[:, :2], np.stack([x, y]).astype(float) - m[:, 2:])
        grid = np.pad(image.reshape(height, width).astype(float), 1)
        left, top = np.floor(sx), np.floor(sy)
        value = np.zeros(len(x))
        for dy in (0, 1):
            for dx in (0, 1):
                px, py = left + dx, top + dy
                weight = (1 - np.abs(sx - px)) * (1 - np.abs(sy - py))
                value += weight * grid[np.clip(py + 1, 0, height + 1).astype(int), np.clip(px + 1, 0, width + 1).astype(int)]
        return {"warped": np.rint(value).astype(np.int32)}

    return by_row(frames, ["image", "matrix"], work, "warped array<int>")
