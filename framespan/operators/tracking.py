"""Circles followed over frames: gaps, smoothing, seeds, tracks and duplicate removal."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framespan import constants as C
from framespan.functions.circles import track_cost

VALUES = ("cx", "cy", "r")


def _interpolated(track: DataFrame, reliable: Column, window: int) -> DataFrame:
    """For each frame the value between the nearest reliable frames within `window` on both sides, or of the one side."""
    own = Window.partitionBy("anchor").orderBy("frame_index")
    point = F.when(reliable, F.struct("frame_index", *VALUES, "confidence"))
    found = track.withColumn("_b", F.last(point, True).over(own.rangeBetween(-window, -1))).withColumn("_a", F.first(point, True).over(own.rangeBetween(1, window)))
    b, a = F.col("_b"), F.col("_a")
    ratio = (F.col("frame_index") - b["frame_index"]) / (a["frame_index"] - b["frame_index"])

    def between(name: str) -> Column:
        if name == "confidence":
            both = 0.5 * (b[name] + a[name])
        else:
            both = b[name] + ratio * (a[name] - b[name])
        return F.when(b.isNotNull() & a.isNotNull(), both).otherwise(F.coalesce(b[name], a[name]))

    return found.withColumns({f"_{n}": between(n) for n in (*VALUES, "confidence")})


def fill_gaps(track: DataFrame, window: int) -> DataFrame:
    """Missing circles (null cx) of a track (anchor, frame_index, cx, cy, r, confidence), marked `filled`."""
    found = _interpolated(track, F.col("cx").isNotNull(), window)
    missing = F.col("cx").isNull()
    filled = missing & F.col("_cx").isNotNull()
    return found.select("anchor", "frame_index", *[F.when(missing, F.col(f"_{n}")).otherwise(F.col(n)).alias(n) for n in (*VALUES, "confidence")], filled.alias("filled"))


def smooth(track: DataFrame, window: int, *, least: float = C.HIGH_CONFIDENCE) -> DataFrame:
    """Circles of low confidence, partial ones and missing ones take the value of reliable neighbours; what they were
    stays in raw_confidence and raw_partial.  Without neighbour a circle stays."""
    partial = F.coalesce(F.col("partial"), F.lit(False)) if "partial" in track.columns else F.lit(False)
    good = F.col("cx").isNotNull() & (F.coalesce("confidence", F.lit(0.0)) >= least) & ~partial
    found = _interpolated(track, good, window)
    moved = ~good & F.col("_cx").isNotNull()
    return found.select("anchor", "frame_index", *[F.when(moved, F.col(f"_{n}")).otherwise(F.col(n)).alias(n) for n in (*VALUES, "confidence")], moved.alias("smoothed"), F.when(moved, F.coalesce("confidence", F.lit(0.0))).alias("raw_confidence"), F.when(moved, F.col("cx").isNotNull() & partial).alias("raw_partial"))


def seed_circles(candidates: DataFrame, seeds: DataFrame) -> DataFrame:
    """One circle a frame: the candidate of least cost inside the gates, else the manual seed itself.

    candidates: frame_id, cand_no, cx, cy, r, confidence, source, partial; seeds: frame_id, seed (circle struct)."""
    rows = seeds.join(candidates, "frame_id", "left")
    cost, center, radius = track_cost(F.col("cx"), F.col("cy"), F.col("r"), F.col("confidence"), F.col("source") == "hough_saturation", F.col("partial"), F.col("seed"))
    rows = rows.withColumns({"cost": cost, "center": center, "radius": radius})
    best = rows.withColumn("_n", F.row_number().over(Window.partitionBy("frame_id").orderBy(F.asc_nulls_last("cost"), "cand_no"))).where("_n = 1")
    matched = F.coalesce((F.col("center") <= C.SEED_CENTER) & (F.col("radius") <= math.log(C.SEED_RATIO)), F.lit(False))
    return best.select("frame_id", *[F.when(matched, F.col(n)).otherwise(F.col("seed")[n]).alias(n) for n in VALUES], F.when(matched, F.when(F.col("source") == "hough_saturation", "seeded_hough").otherwise("seeded_contour")).otherwise("manual_seed").alias("source"))


def auto_seed(candidates: DataFrame) -> DataFrame:
    """Without a manual seed: the first candidate of a frame that is not partial, else the first."""
    first = Window.partitionBy("frame_id").orderBy(F.col("partial").cast("int"), "cand_no")
    return candidates.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def propagate(candidates: DataFrame, seeds: DataFrame) -> DataFrame:
    """Tracks from a seed frame forwards and backwards with constant velocity and gates that widen with the gap.

    candidates: anchor, frame_index, cand_no, cx, cy, r, confidence, hough, partial (cx null: a frame without
    candidate); seeds: anchor, seed_index, seed_cx, seed_cy, seed_r.  The circle of least cost inside the gates is taken,
    the first on ties.  Each anchor and direction is read once as a sorted stream that holds the candidates of one frame
    and the last two circles taken, so an anchor may have any number of frames; one that dwarfs all others still takes as
    long as its frames follow on each other."""
    w, seed = C.COST_WEIGHTS, [f"seed_{n}" for n in VALUES]
    near, far = math.log(C.RATIO_GATE), math.log(C.RATIO_MOST)

    def best_of(frame: int, options: list[tuple], last: tuple, before: tuple | None) -> tuple | None:
        at0, px, py, pr = last
        if before is not None and at0 != before[0]:
            step = (frame - at0) / (at0 - before[0])
            px, py, pr = px + step * (px - before[1]), py + step * (py - before[2]), max(C.LEAST_PREDICTED, pr)
        gap, own, best = max(1, abs(frame - at0)), max(pr, C.LEAST_SCALE), None
        for cx, cy, r, confidence, hough, partial in options:
            center, radius = math.hypot(cx - px, cy - py) / own, abs(math.log(max(r, 1.0) / own))
            if center <= min(C.CENTER_MOST, C.CENTER_GATE + C.CENTER_STEP * gap) and radius <= min(far, near + C.RATIO_STEP * gap):
                cost = w["center"] * center + w["radius"] * radius + w["doubt"] * (1 - confidence) + (0 if hough else w["no_hough"]) + (w["partial"] if partial else 0)
                if best is None or cost < best[3]:
                    best = (cx, cy, r, cost)
        return best

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        track = at = last = before = None
        options: list[tuple] = []
        out: list[tuple] = []

        def close() -> None:
            nonlocal last, before, options
            if at is not None:
                best = best_of(at, options, last, before)
                out.append((track[0], at, *(best or (None,) * 4)))
                if best:
                    before, last = last, (at, *best[:3])
            options = []

        def made() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * 6
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), *[pa.float64()] * 4), strict=True)], names=["anchor", "frame_index", *VALUES, "cost"])

        for batch in it:
            for anchor, ahead, frame, cx, cy, r, confidence, hough, partial, index, *start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (anchor, ahead) != track or frame != at:
                    close()
                    if (anchor, ahead) != track:
                        track, last, before = (anchor, ahead), (index, *start), None
                    at = frame
                if cx is not None:
                    options.append((cx, cy, r, confidence, hough, partial))
            yield made()
        close()
        yield made()

    rows = candidates.join(seeds, "anchor").where("frame_index <> seed_index").withColumn("ahead", F.col("frame_index") > F.col("seed_index"))
    order = ["anchor", "ahead", F.abs(F.col("frame_index") - F.col("seed_index")), "cand_no"]
    sorted_ = rows.repartition("anchor", "ahead").sortWithinPartitions(*order).select("anchor", "ahead", "frame_index", *VALUES, "confidence", "hough", "partial", "seed_index", *seed)
    found = sorted_.mapInArrow(batches, "anchor long, frame_index long, cx double, cy double, r double, cost double")
    # the seed's own row, of anchors that have frames
    own = seeds.join(candidates.select("anchor").distinct(), "anchor", "left_semi")
    return found.union(own.select("anchor", "seed_index", *seed, F.lit(0.0)))


def _greedy(circles: DataFrame, order: list[Column], duplicate: Callable[[float, float, float], bool]) -> DataFrame:
    """Keeps the circles of a frame that no circle kept before them makes a duplicate.

    Frames are dealt by frame_id and lie in order in a partition, so only one frame's kept circles are held."""
    at = [circles.columns.index(n) for n in ("frame_id", *VALUES)]

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frame, kept = None, []
        for batch in it:
            take = []
            for i, (f, x, y, r) in enumerate(zip(*(batch.column(k).to_pylist() for k in at), strict=True)):
                if f != frame:
                    frame, kept = f, []
                if not any(duplicate(math.hypot(x - kx, y - ky), r, kr) for kx, ky, kr in kept):
                    kept.append((x, y, r))
                    take.append(i)
            yield batch.take(pa.array(take, pa.int64()))

    return circles.repartition("frame_id").sortWithinPartitions("frame_id", *order).mapInArrow(batches, circles.schema)


def dedupe(circles: DataFrame) -> DataFrame:
    """Near duplicates by score: the bounds come from the circle that stays."""
    return _greedy(circles, [F.desc("confidence"), F.asc("cand_no")], lambda d, r, kept: d <= max(8.0, 0.08 * kept) and abs(r - kept) <= max(6.0, 0.08 * kept))


def concentric(circles: DataFrame) -> DataFrame:
    """The outer circle of each concentric group, the largest first."""

    def same(d: float, r: float, kept: float) -> bool:
        large, small = max(r, kept), min(r, kept)
        return small > 0 and small / large >= 0.55 and d <= max(18.0, 0.20 * large)

    return _greedy(circles, [F.desc("r"), F.asc("cand_no")], same)


def top_circles(circles: DataFrame, n: int) -> DataFrame:
    """The first n candidates of a frame: confidence, found by Hough, radius, not partial; numbered from 1."""
    order = Window.partitionBy("frame_id").orderBy(F.desc("confidence"), (F.col("source") == "hough_saturation").cast("int").desc(), F.desc("r"), F.col("partial").cast("int"), "cand_no")
    return circles.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def without_overlaps(contours: DataFrame, hough: DataFrame) -> DataFrame:
    """Contour circles that no Hough circle of the same frame overlaps."""
    h = hough.select("frame_id", *[F.col(n).alias(f"h_{n}") for n in VALUES])
    large, small = F.greatest("r", "h_r"), F.least("r", "h_r")
    distance = F.sqrt(F.pow(F.col("cx") - F.col("h_cx"), 2) + F.pow(F.col("cy") - F.col("h_cy"), 2))
    near = (distance <= F.greatest(F.lit(24.0), 0.30 * large)) & (small / large >= 0.45)
    return contours.join(h, (contours["frame_id"] == h["frame_id"]) & near, "left_anti")


def substitute_seeds(candidates: DataFrame, seeds: DataFrame) -> DataFrame:
    """Continuity seeds take the place of the candidates they match; seeds first, renumbered."""
    s = seeds.select("frame_id", *[F.col(n).alias(f"s_{n}") for n in VALUES])
    large = F.greatest("r", "s_r")
    match = (F.sqrt(F.pow(F.col("cx") - F.col("s_cx"), 2) + F.pow(F.col("cy") - F.col("s_cy"), 2)) <= F.greatest(F.lit(8.0), 0.08 * large)) & (F.abs(F.col("r") - F.col("s_r")) <= F.greatest(F.lit(6.0), 0.08 * large))
    rest = candidates.join(s, (candidates["frame_id"] == s["frame_id"]) & match, "left_anti").withColumn("is_seed", F.lit(0))
    both = rest.unionByName(seeds.withColumn("is_seed", F.lit(1)))
    return both.withColumn("rank", F.row_number().over(Window.partitionBy("frame_id").orderBy(F.desc("is_seed"), "cand_no")))


def fit_circles(points: DataFrame) -> DataFrame:
    """Least-squares circle through the points (frame_id, x, y) of each frame; null for fewer than 6 or degenerate ones.

    Points are centred on their mean, so the normal equations reduce to two unknowns."""
    mean = points.groupBy("frame_id").agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("mx"), F.avg("y").alias("my"))
    u, v = F.col("x") - F.col("mx"), F.col("y") - F.col("my")
    z = u * u + v * v
    s = points.join(mean, "frame_id").groupBy("frame_id", "n", "mx", "my").agg(F.sum(u * u).alias("uu"), F.sum(u * v).alias("uv"), F.sum(v * v).alias("vv"), F.sum(u * z).alias("uz"), F.sum(v * z).alias("vz"), F.sum(z).alias("z"))
    det = F.col("uu") * F.col("vv") - F.col("uv") * F.col("uv")
    a, b = F.try_divide(F.col("uz") * F.col("vv") - F.col("vz") * F.col("uv"), 2 * det), F.try_divide(F.col("vz") * F.col("uu") - F.col("uz") * F.col("uv"), 2 * det)
    usable = (F.col("n") >= 6) & (det > 1e-9 * F.col("uu") * F.col("vv"))
    radius = F.sqrt(F.when(usable, a * a + b * b + F.col("z") / F.col("n")))
    return s.select("frame_id", "n", F.when(usable, F.col("mx") + a).alias("cx"), F.when(usable, F.col("my") + b).alias("cy"), radius.alias("r"))
