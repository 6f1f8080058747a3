"""Crop generators and the choice of crops by pad geometry."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framespan import constants as C
from framespan.functions.circles import map_circle, pad_metrics

#: pairs whose crops are held at a time
PAIRS = 1024
#: candidate numbers whose circles are one list, and crops that are scored against their lists at a time
BLOCK, ROWS = 256, 2048


def crop_grid(videos: DataFrame, fractions: list[float], aspect: float, step_fraction: float) -> DataFrame:
    """Crops x, y, w, h of each video (w, h in video_w, video_h) on a grid of several sizes, the last row and column flush
    with the border; seq_no counts in the order size, y, x.  Sizes larger than the video are left out."""
    sizes = videos.select("*", F.posexplode(F.array(*[F.lit(f) for f in fractions])).alias("size_no", "fraction"))
    sizes = sizes.withColumn("h", F.rint(F.col("video_h") * F.col("fraction")).cast("int"))
    sizes = sizes.withColumn("w", F.rint(F.col("h") * F.lit(aspect)).cast("int")).where("h > 0 AND w > 0 AND w <= video_w AND h <= video_h")
    step = F.greatest(F.lit(32), F.rint(F.least("w", "h") * F.lit(step_fraction)).cast("int"))

    def places(whole: str, part: str):
        last = F.col(whole) - F.col(part)
        return F.array_union(F.sequence(F.lit(0), last, step), F.array(last))

    grid = sizes.withColumn("y", F.explode(places("video_h", "h"))).withColumn("x", F.explode(places("video_w", "w")))
    return grid.withColumn("seq_no", F.row_number().over(Window.partitionBy("video_id").orderBy("size_no", "y", "x"))).select("video_id", "seq_no", "x", "y", "w", "h")


def _guided(own: np.ndarray, tx: np.ndarray, ty: np.ndarray, vx: np.ndarray, vy: np.ndarray, vr: np.ndarray, whole_w: np.ndarray, whole_h: np.ndarray, out_w: int, out_h: int) -> tuple[np.ndarray, ...]:
    """x, y, w and h of all crops of some pairs, by size, row, column and pair, and which of them count: those of a size that
    fits, and of equal ones the first.

    Places of one size are the product of a few columns and rows, so equal crops have equal sizes and equal columns and
    rows, and each is found where it is made."""
    scales = [(s, np.sqrt(a)) for s in C.SIZE_SCALES for a in C.ASPECT_SCALES]
    w = np.rint(np.stack([vr * out_w / own * s * root for s, root in scales]))
    h = np.rint(np.stack([vr * out_h / own * s / root for s, root in scales]))
    kept = (w > 0) & (h > 0) & (w <= whole_w) & (h <= whole_h)
    for k in range(1, len(scales)):
        kept[k] &= ~((w[:k] == w[k]) & (h[:k] == h[k])).any(0)

    def places(video: np.ndarray, thermal: np.ndarray, side: np.ndarray, out: int, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each size the places of the shifts, and whether a place is the first of its kind."""
        at = video - thermal * side / out
        found = np.stack([np.minimum(np.maximum(np.rint(at + s * vr), 0), whole - side) for s in C.CENTER_SHIFTS], 1)
        first = np.ones(found.shape, bool)
        for n in range(1, found.shape[1]):
            first[:, n] = ~(found[:, :n] == found[:, n : n + 1]).any(1)
        return found, first

    y, first_y = places(vy, ty, h, out_h, whole_h)
    x, first_x = places(vx, tx, w, out_w, whole_w)
    counts = kept[:, None, None] & first_y[:, :, None] & first_x[:, None]
    return *np.broadcast_arrays(x[:, None], y[:, :, None], w[:, None, None], h[:, None, None]), counts


def _by_pair(pairs: DataFrame, made: Callable[..., list[pa.Array]], schema: str, out_w: int, out_h: int) -> DataFrame:
    """Columns made(pair ids, x, y, w, h, which count) for some pairs at a time; pairs with a null among their values have no crops."""
    names = [part.split()[0] for part in schema.split(", ")]
    values = {"own": F.greatest(F.col("thermal.r"), F.lit(1.0)), "tx": F.col("thermal.cx"), "ty": F.col("thermal.cy"), "vx": F.col("video.cx"), "vy": F.col("video.cy"), "vr": F.col("video.r"), "whole_w": F.col("video_w"), "whole_h": F.col("video_h")}

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in it:
            for start in range(0, whole.num_rows, PAIRS):
                batch = whole.slice(start, PAIRS)
                crops = _guided(*(c.to_numpy() for c in batch.columns[1:]), out_w, out_h)
                yield pa.RecordBatch.from_arrays(made(batch.column(0), *crops), names=names)

    flat = pairs.where("thermal IS NOT NULL AND video IS NOT NULL").select("pair_id", *[v.cast("double").alias(n) for n, v in values.items()])
    return flat.dropna(subset=list(values)).mapInArrow(batches, schema)


def _orders(shape: tuple[int, ...]) -> np.ndarray:
    """seq_no of the crops of one pair, from 1."""
    return np.arange(1.0, np.prod(shape[:-1]) + 1).reshape(*shape[:-1], 1)


def guided_crops(pairs: DataFrame, out_w: int = C.WIDTH, out_h: int = C.HEIGHT) -> DataFrame:
    """Crops that put a video circle on a thermal circle: sizes, aspects and shifts around the exact one, clamped to the
    video; equal crops once, in order of their first place.  pairs: pair_id, thermal, video (circles), video_w, video_h.

    Pairs are dealt to all shuffle partitions first, as one narrow row becomes up to 135."""

    def made(ids, x, y, w, h, counts):
        numbers, pairs_ = (np.broadcast_to(v, counts.shape)[counts] for v in (_orders(counts.shape), np.arange(counts.shape[-1])))
        return [ids.take(pa.array(pairs_)), *[pa.array(v.astype(np.int32)) for v in (*(v[counts] for v in (x, y, w, h)), numbers)]]

    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = pairs.schema["pair_id"].dataType.simpleString()
    return _by_pair(pairs.repartition(parts), made, f"pair_id {kind}, x int, y int, w int, h int, seq_no int", out_w, out_h)


def guided_crop_sums(pairs: DataFrame, out_w: int = C.WIDTH, out_h: int = C.HEIGHT) -> DataFrame:
    """Of each pair that has crops: their number, the sums of x, y, w and h, and a digest, the sum of seq_no times
    x + 3y + 7w + 11h.  All crops of guided_crops are made, and summed in the task that makes them."""

    def made(ids, x, y, w, h, counts):
        some, sums = counts.any((0, 1, 2)), np.zeros((6, counts.shape[-1]))
        for size, of_size in enumerate(counts):  # one size at a time stays in the processor's cache
            held = of_size.astype(float)
            number = _orders(counts.shape)[size]
            xs, ys, ws, hs = (v[size] for v in (x, y, w, h))
            for k, v in enumerate((1, xs, ys, ws, hs, (xs + 3 * ys + 7 * ws + 11 * hs) * number)):
                sums[k] += (v * held).sum((0, 1))
        return [ids.filter(pa.array(some)), *[pa.array(v[some].astype(np.int64)) for v in sums]]

    kind = pairs.schema["pair_id"].dataType.simpleString()
    return _by_pair(pairs, made, f"pair_id {kind}, crops long, x long, y long, w long, h long, digest long", out_w, out_h)


def crop_metrics(rows: DataFrame, out_w: int = C.WIDTH, out_h: int = C.HEIGHT) -> DataFrame:
    """Adds the pad metrics (struct m) of rows with x, y, w, h and the circles thermal and video."""
    mapped = map_circle(*(F.col(c) for c in "xywh"), F.lit(float(out_w)), F.lit(float(out_h)), F.col("video"))
    return rows.withColumn("mapped", mapped).withColumn("m", pad_metrics(F.col("thermal"), F.col("mapped"))).drop("mapped")


def _scored(mapped: list[np.ndarray], thermal: list[np.ndarray], there: np.ndarray) -> dict[str, np.ndarray]:
    """pad_metrics of pairs: mapped cx, cy, r, rx, ry and thermal cx, cy, r; the defaults where a circle is not there."""
    mx, my, mr, rx, ry = mapped
    tx, ty, tr = thermal
    own = np.maximum(tr, 1.0)
    error = np.sqrt((mx - tx) ** 2 + (my - ty) ** 2)
    center, radius, anisotropy = error / own, np.abs(mr - tr) / own, np.abs(rx - ry) / np.maximum(mr, 1.0)
    bell = lambda v, width: np.exp(-(v / width) * (v / width))
    scores = {"center": bell(center, C.CENTER_WIDTH), "radius": bell(radius, C.RADIUS_WIDTH), "anisotropy": bell(anisotropy, C.ANISOTROPY_WIDTH)}
    scores["ring"] = scores["center"] * scores["radius"]
    total = sum((weight * scores[k] for k, weight in C.GEOMETRY_WEIGHTS.items()), 0.0)
    passed = (center <= C.CENTER_LIMIT) & (radius <= C.RADIUS_LIMIT) & (anisotropy <= C.ANISOTROPY_LIMIT)
    found = {"center_error_px": (error, np.inf), "center_ratio": (center, 1.0), "radius_ratio": (radius, 1.0), "anisotropy": (anisotropy, 1.0), "ring_iou": (scores["ring"], 0.0), "geometry_score": (total, 0.0), "hard_pass": (passed, False)}
    return {name: np.where(there, v, default) for name, (v, default) in found.items()}


def _best_of_lists(crops: DataFrame, keep: list[str]) -> DataFrame:
    """Adds cand_no, thermal, m and _level of the best circle of _circles against _mapped to the columns to keep."""
    kinds = {f.name: f.dataType.simpleString() for f in crops.schema.fields}
    number = crops.schema["_circles"].dataType.elementType["cand_no"].dataType.simpleString()
    metrics = "struct<center_error_px:double,center_ratio:double,radius_ratio:double,anisotropy:double,ring_iou:double,geometry_score:double,hard_pass:boolean>"
    schema = "".join(f"`{c}` {kinds[c]}, " for c in keep) + f"cand_no {number}, thermal struct<cx:double,cy:double,r:double>, m {metrics}, _level double"
    sides = ("cx", "cy", "r")

    def doubles(struct: pa.StructArray, names: tuple[str, ...]) -> list[np.ndarray]:
        return [struct.field(n).cast(pa.float64()).to_numpy(zero_copy_only=False) for n in names]

    def part(batch: pa.RecordBatch) -> pa.RecordBatch:
        mapped, lists = batch.column(0), batch.column(1)
        lengths = lists.value_lengths().to_numpy()
        circles, of = lists.flatten(), np.repeat(np.arange(len(lists)), lengths)
        starts = np.cumsum(lengths) - lengths
        thermal = doubles(circles, sides)
        there = circles.field("there").to_numpy(zero_copy_only=False) & mapped.is_valid().to_numpy(zero_copy_only=False)[of]
        with np.errstate(all="ignore"):
            m = _scored([v[of] for v in doubles(mapped, (*sides, "rx", "ry"))], thermal, there & (thermal[2] > 0))
            level = np.trunc(m["geometry_score"] * 1e12 + 0.5) / 1e12
        order = np.where(np.isnan(level), -1.0, level)  # a score that is not known comes last
        numbers = circles.field("cand_no").to_numpy(zero_copy_only=False)
        top = order == np.maximum.reduceat(order, starts)[of]
        first = np.minimum.reduceat(np.where(top, numbers, np.iinfo(numbers.dtype).max), starts)
        chosen = np.flatnonzero(top & (numbers == first[of]))
        chosen = chosen[np.unique(of[chosen], return_index=True)[1]]
        got = lambda v: pa.array(v[chosen], mask=np.isnan(v[chosen]) if v.dtype.kind == "f" else None)
        circle = pa.StructArray.from_arrays([got(v) for v in thermal], names=list(sides), mask=pa.array(~circles.field("there").to_numpy(zero_copy_only=False)[chosen]))
        best = [circles.field("cand_no").take(pa.array(chosen)), circle, pa.StructArray.from_arrays([got(v) for v in m.values()], names=list(m)), got(level)]
        return pa.RecordBatch.from_arrays([*batch.columns[2:], *best], names=[*keep, "cand_no", "thermal", "m", "_level"])

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in it:
            for start in range(0, whole.num_rows, ROWS):
                yield part(whole.slice(start, ROWS))

    return crops.select("_mapped", "_circles", *keep).mapInArrow(batches, schema)


def best_circles(crops: DataFrame, circles: DataFrame, n: int | None = None) -> DataFrame:
    """The best thermal circle of each crop by geometry, first on ties, and of those the first n crops a frame.

    crops: frame_id, seq_no, x, y, w, h, video; circles: frame_id, cand_no, thermal.  Scores are compared at twelve places,
    so that what differs in the last bits only is a tie.  A frame's circles are lists of BLOCK numbers each, joined with its
    crops by one equality, so that pairs are no rows; every pair is scored, and one row a crop and list leaves the task."""
    t = F.col("thermal")
    circle = F.struct("cand_no", *[t[c].cast("double").alias(c) for c in ("cx", "cy", "r")], t.isNotNull().alias("there"))
    lists = circles.groupBy("frame_id", F.floor(F.col("cand_no") / BLOCK).alias("_block")).agg(F.collect_list(circle).alias("_circles")).drop("_block")
    mapped = map_circle(*(F.col(c) for c in "xywh"), F.lit(float(C.WIDTH)), F.lit(float(C.HEIGHT)), F.col("video"))
    scored = _best_of_lists(crops.withColumn("_mapped", mapped).join(lists, "frame_id"), crops.columns)
    one = F.row_number().over(Window.partitionBy("frame_id", "seq_no").orderBy(F.col("_level").desc(), "cand_no"))
    best = scored.withColumn("_n", one).where("_n = 1").drop("_n")
    rank = F.row_number().over(Window.partitionBy("frame_id").orderBy(F.col("_level").desc(), "seq_no"))
    best = best.withColumn("rank", rank).drop("_level")
    return best.where(F.col("rank") <= n) if n else best
