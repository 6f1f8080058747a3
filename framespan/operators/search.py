"""The anchor search: which video frame, and which crop of it, shows what the thermal frames around an anchor show.

A candidate is a video frame near the anchor with some crops.  Each is scored over a window of 2k + 1 offsets: the thermal
frame at an offset against the video frame that lies as far from the candidate.  A video frame serves many candidates and
offsets, so images are not joined with candidates.  An anchor's frames are cut into blocks; a block is one sorted stream of
the anchor's thermal maps, then frame by frame the few numbers that tell what to score, and the frame itself.  A task
holds the maps and one frame; the frame becomes one summed-area table, each crop of it one small map, and each map is
compared with the thermal maps of all offsets that ask for it.  What leaves is a row a candidate, crop and offset without
pixels; geometry, windows and ranks are built-in expressions on those.

Defined cases: candidates whose window leaves the video, or lacks a frame, a crop or a thermal map, are left out whole; a
missing image scores nothing; without circle geometry scores as missing and the mask is the whole map; crops beyond the
video are dark outside; rows repeated in full count once; an empty table gives no rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framespan.functions.circles import composite
from framespan.operators import crops as G
from framespan.operators import pixels as P
from framespan.operators import ranking as R
from framespan.sources.shared import fresh_folder

#: frame numbers that are sent to every task; more are joined by shuffle
BROADCAST_ROWS = 1_000_000
#: video frames in a block of an anchor's stream
BLOCK = 64
MASK_SCALE, MASK_LEAST = 1.22, 32
#: places of a score: less is not a difference, and ties are kept
DIGITS = 9
CIRCLE = "struct<cx:double,cy:double,r:double>"
JOB = "struct<candidate:bigint,o:int,strategy:int,x:int,y:int,w:int,h:int>"
MEANS = ("pad_geometry", "masked_visual", "full_visual")

Maps = tuple[np.ndarray, np.ndarray]


def edge_features(image: np.ndarray) -> Maps:
    return P.edges(image), P.gradient(image)


def level_features(image: np.ndarray) -> Maps:
    """Bright cells, and the steps from cell to cell in reading order: for maps of a few cells."""
    return np.maximum(image - 128, 0), np.abs(np.diff(image.ravel()))


def cosine(a: np.ndarray, b: np.ndarray) -> float:
    a, b = a.ravel().astype(float), b.ravel().astype(float)
    norms = np.linalg.norm(a) * np.linalg.norm(b)
    return float(a @ b / norms) if norms > 1e-8 else 0.0


def needed(candidates: DataFrame, k: int) -> DataFrame:
    """candidates (anchor, sequence_id, candidate, fps, frame_count) by offset, with the video frame; windows inside the video only."""
    rows = candidates.select("anchor", "sequence_id", "candidate", "fps", "frame_count").distinct()
    index = lambda o: F.col("candidate") + F.rint(o * F.col("fps")).cast("long")
    rows = rows.where((index(F.lit(-k)) >= 0) & (index(F.lit(k)) < F.col("frame_count")))
    return rows.withColumn("o", F.explode(F.sequence(F.lit(-k), F.lit(k)))).select("anchor", "sequence_id", "candidate", "o", index(F.col("o")).alias("index"))


def streams(needs: DataFrame, thermal: DataFrame, crops: DataFrame, video: DataFrame, block: int) -> DataFrame:
    """Thermal maps (kind 0), what to score (1) and frames (2) of every block, as one table sorted in partitions."""
    number = F.floor(F.col("index") / block)
    none = lambda kind: F.lit(None).cast(kind)
    jobs = needs.join(crops.select("anchor", "candidate", "strategy", "x", "y", "w", "h").distinct(), ["anchor", "candidate"])
    job = F.struct(F.col("candidate").cast("long").alias("candidate"), F.col("o").cast("int").alias("o"), *[F.col(c).cast("int").alias(c) for c in ("strategy", "x", "y", "w", "h")])
    jobs = jobs.select("anchor", number.alias("block"), "index", F.lit(1).alias("kind"), job.alias("job"), none("int").alias("o"), none("array<int>").alias("gray"), none(CIRCLE).alias("circle"))
    frames = needs.select("anchor", "sequence_id", "index").distinct()
    wanted = F.broadcast(frames) if frames.count() <= BROADCAST_ROWS else frames  # then images move once, to their block
    circle = F.col("circle").cast(CIRCLE).alias("circle")
    shown = video.withColumnRenamed("frame_index", "index").join(wanted, ["sequence_id", "index"])
    shown = shown.select("anchor", number.alias("block"), "index", F.lit(2).alias("kind"), none(JOB).alias("job"), none("int").alias("o"), F.col("gray").cast("array<int>").alias("gray"), circle)
    blocks = needs.select("anchor", number.alias("block")).distinct()
    maps = thermal.select("anchor", "o", "gray", "circle").join(blocks, "anchor")
    maps = maps.select("anchor", "block", F.lit(-1).cast("long").alias("index"), F.lit(0).alias("kind"), none(JOB).alias("job"), F.col("o").cast("int").alias("o"), F.col("gray").cast("array<int>").alias("gray"), circle)
    whole = maps.unionByName(jobs).unionByName(shown)
    return whole.repartition("anchor", "block").sortWithinPartitions("anchor", "block", "index", "kind")


def pair_scores(stream: DataFrame, height: int, width: int, video_height: int, video_width: int, full: tuple[int, int], *, features: Callable[[np.ndarray], Maps] = edge_features, mask_least: int = MASK_LEAST) -> DataFrame:
    """A row a candidate, crop and offset: the crop of the frame, resized to the thermal map, against that map.

    full: height and width of the thermal frame that the thermal circles refer to."""
    kind = stream.schema["anchor"].dataType.simpleString()
    schema = f"anchor {kind}, candidate long, strategy int, o int, x int, y int, w int, h int, thermal {CIRCLE}, video {CIRCLE}, full_visual double, masked_visual double, thermal_edge_density double, video_edge_density double"
    grid = np.divmod(np.arange(height * width), width)

    def disk(circle: dict | None) -> np.ndarray | None:
        if circle is None or not circle["r"] or circle["r"] <= 0:
            return None
        sx, sy = width / full[1], height / full[0]
        inside = np.hypot(grid[1] - circle["cx"] * sx, grid[0] - circle["cy"] * sy) <= circle["r"] * 0.5 * (sx + sy) * MASK_SCALE
        return inside if inside.sum() >= mask_least else None

    def mixed(a: Maps, b: Maps, inside: np.ndarray | None) -> float:
        scores = []
        for p, q in zip(a, b, strict=True):
            p, q = p.ravel(), q.ravel()
            cut = inside[: len(p)] if inside is not None else slice(None)
            scores.append(cosine(p[cut], q[cut]))
        return round(0.75 * scores[0] + 0.25 * scores[1], DIGITS)

    density = lambda m: float((m[0] > 0).mean())

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, maps, jobs = None, {}, []
        for batch in it:
            made: list[tuple] = []
            columns = {c: batch.column(c) for c in ("anchor", "block", "index", "kind", "job", "o", "gray", "circle")}
            small = {c: columns[c].to_pylist() for c in ("anchor", "block", "index", "kind", "job", "o", "circle")}
            for row in range(batch.num_rows):
                anchor, block, index, what, job, o, circle = (small[c][row] for c in ("anchor", "block", "index", "kind", "job", "o", "circle"))
                if place != (anchor, block):
                    place, maps, jobs = (anchor, block), {}, []
                if what == 1:
                    jobs.append((index, job))
                    continue
                image = columns["gray"][row]
                gray = image.values.to_numpy(zero_copy_only=False) if image.is_valid else None
                if what == 0:
                    if gray is not None:
                        maps[o] = features(gray.reshape(height, width)), circle, disk(circle)
                    continue
                own, jobs = [j for at, j in jobs if at == index], []
                if gray is None or not own:
                    continue
                sums, seen = P.summed(gray.reshape(video_height, video_width)), {}
                for j in own:
                    if j["o"] not in maps or j["w"] <= 0 or j["h"] <= 0:
                        continue
                    crop = j["x"], j["y"], j["w"], j["h"]
                    if crop not in seen:
                        seen[crop] = features(np.rint(P.area_mean(sums, *crop, width, height)).astype(np.int64))
                    theirs, thermal, inside = maps[j["o"]]
                    made.append((anchor, j["candidate"], j["strategy"], j["o"], *crop, thermal, circle, mixed(theirs, seen[crop], None), mixed(theirs, seen[crop], inside), density(theirs), density(seen[crop])))
            if made:
                types = [columns["anchor"].type, pa.int64(), *[pa.int32()] * 6, *[columns["circle"].type] * 2, *[pa.float64()] * 4]
                names = [part.split()[0] for part in schema.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*made, strict=True), types, strict=True)], names=names)

    return stream.mapInArrow(batches, schema)


def scored(pairs: DataFrame, full: tuple[int, int]) -> DataFrame:
    """Adds pad geometry, hard pass and the composite score to pair scores."""
    measured = G.crop_metrics(pairs, full[1], full[0])
    score = F.round(composite(F.col("m.geometry_score"), F.col("masked_visual"), F.col("full_visual"), F.col("m.hard_pass")), DIGITS)
    return measured.withColumns({"pad_geometry": F.round("m.geometry_score", DIGITS), "hard_pass": F.col("m.hard_pass"), "score": score}).drop("m")


def anchor_search(candidates: DataFrame, thermal: DataFrame, crops: DataFrame, video: DataFrame, *, k: int, size: tuple[int, int], video_size: tuple[int, int], full: tuple[int, int], features: Callable[[np.ndarray], Maps] = edge_features, mask_least: int = MASK_LEAST, block: int = BLOCK) -> DataFrame:
    """The best crop of every candidate frame and the candidates' rank at their anchor.

    candidates: anchor, sequence_id, candidate (a frame), distance (from the anchor), fps, frame_count; thermal: anchor, o,
    gray, circle; crops: anchor, candidate, strategy, x, y, w, h; video: sequence_id, frame_index, gray, circle.  Sizes are
    heights and widths: of the thermal maps, the video frames, and the thermal frames."""
    needs = needed(candidates, k)
    pairs = pair_scores(streams(needs, thermal, crops, video, block), *size, *video_size, full, features=features, mask_least=mask_least)
    keys = ["anchor", "candidate", "strategy"]
    folder = fresh_folder(pairs.sparkSession, "pairs")
    pairs.write.parquet(folder)  # scores without pixels, so that no image is read for each of the sums below
    whole = scored(pairs.sparkSession.read.parquet(folder), full)
    rows = R.window_rows(whole, keys, k, MEANS)
    center = whole.where("o = 0").select(*keys, "x", "y", "w", "h", "thermal_edge_density", "video_edge_density")
    complete = whole.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == 2 * k + 1).drop("n")
    distance = candidates.groupBy("anchor", "candidate").agg(F.min("distance").alias("distance"))
    rows = rows.join(complete, keys).join(center, keys).join(distance, ["anchor", "candidate"])
    rows = rows.withColumn("aggregate", F.round("mean", DIGITS))
    best = R.best_strategies(rows, ["anchor", "candidate"]).drop("rank").withColumn("search_order", F.col("candidate"))
    return R.rank_candidates(best, ["anchor"]).drop("search_order", "mean")
