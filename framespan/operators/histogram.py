"""Exact histograms of digital numbers and the statistics taken from them.

A histogram is a long table (sequence_id, dn, pixel_count): partial sums merge by addition, so the pixels are read once
and everything after works on at most 65,536 rows a sequence.  The saturated value may hold a large share of all pixels;
it is only ever a key of sums, which Spark combines before the shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framespan import constants as C
from framespan.functions.radiometry import celsius
from framespan.sources.shared import fresh_folder

ALL = "all"


def dn_histogram(pixels: DataFrame) -> DataFrame:
    """From a table of pixels (sequence_id, dn)."""
    return pixels.groupBy("sequence_id", "dn").agg(F.count(F.lit(1)).alias("pixel_count"))


def pixel_counts(pixels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The histogram (sequence_id, dn, pixel_count) and the frames of each sequence (sequence_id, tiff_count), from one
    read of the pixels (sequence_id, frame_no, dn): one grouping by level and one by frame, whose sums become a table."""
    sets = pixels.groupingSets([["sequence_id", "dn"], ["sequence_id", "frame_no"]], "sequence_id", "dn", "frame_no")
    folder = fresh_folder(pixels.sparkSession, "counts")
    sets.agg(F.count(F.lit(1)).alias("pixel_count"), F.grouping("dn").alias("of_frame")).write.partitionBy("of_frame").parquet(folder)
    counts = pixels.sparkSession.read.parquet(folder)
    frames = counts.where("of_frame = 1").groupBy("sequence_id").agg(F.count("frame_no").alias("tiff_count"))
    return counts.where("of_frame = 0").select("sequence_id", "dn", "pixel_count"), frames


def array_histogram(frames: DataFrame) -> DataFrame:
    """From frames (sequence_id not null, dn array): each task counts its frames, tasks' counts are summed.

    Pixels are never exploded to rows."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in it:
            lists = batch.column(1)
            values = lists.flatten().to_numpy(zero_copy_only=False)
            sizes = np.diff(np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))))
            names = batch.column(0).dictionary_encode()
            of = np.repeat(names.indices.to_numpy(zero_copy_only=False), sizes)
            for k, name in enumerate(names.dictionary.to_pylist()):
                n = np.bincount(values[of == k], minlength=65536)
                totals[name] = totals.get(name, 0) + n
        for name, n in totals.items():
            dn = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(dn)), pa.array(dn.astype(np.int32)), pa.array(n[dn])], names=["sequence_id", "dn", "pixel_count"])

    counted = frames.select("sequence_id", "dn").mapInArrow(batches, "sequence_id string, dn int, pixel_count long")
    return counted.groupBy("sequence_id", "dn").agg(F.sum("pixel_count").alias("pixel_count"))


def with_overall(histogram: DataFrame) -> DataFrame:
    """The histogram of every sequence and of all together, under the name `all`."""
    both = histogram.select(F.explode(F.array(F.col("sequence_id"), F.lit(ALL))).alias("sequence_id"), "dn", "pixel_count")
    return both.groupBy("sequence_id", "dn").agg(F.sum("pixel_count").alias("pixel_count"))


def percentile_array(wanted: tuple[float, ...]) -> Column:
    """Aggregate of a histogram: percentiles by linear interpolation on the frequencies."""
    return F.percentile("dn", F.array(*[F.lit(p / 100) for p in wanted]), F.col("pixel_count"))


def percentile_columns(wanted: tuple[float, ...]) -> list[Column]:
    return [F.col("p")[k].alias(f"{name(p)}_dn") for k, p in enumerate(wanted)]


def percentiles(histogram: DataFrame, wanted: tuple[float, ...] = C.PERCENTILES) -> DataFrame:
    """One row a sequence with columns p50_dn and so on."""
    found = histogram.groupBy("sequence_id").agg(percentile_array(wanted).alias("p"))
    return found.select("sequence_id", *percentile_columns(wanted))


def name(percentile: float) -> str:
    return "p" + f"{percentile:g}".replace(".", "_")


def distribution_stats(histogram: DataFrame, wanted: tuple[float, ...] = C.PERCENTILES) -> DataFrame:
    """Statistics in DN and in degrees of every sequence and of all together, in one aggregation of the histogram:
    pixels, extremes, mean, population deviation, percentiles, and counts of saturated and hot pixels."""
    n, dn = F.col("pixel_count"), F.col("dn").cast("long")
    sums = with_overall(histogram).groupBy("sequence_id").agg(
        F.sum(n).alias("pixel_count"), F.min("dn").alias("min_dn"), F.max("dn").alias("max_dn"),
        F.sum(dn * n).cast("double").alias("s1"), F.sum((dn * dn * n).cast("decimal(38,0)")).cast("double").alias("s2"),
        F.sum(F.when(dn == C.SATURATION_DN, n).otherwise(0)).alias("saturation_count"),
        F.sum(F.when(dn >= C.HOT_DN, n).otherwise(0)).alias("mask_positive_pixels"), percentile_array(wanted).alias("p"),
    )
    mean = F.col("s1") / F.col("pixel_count")
    std = F.sqrt(F.greatest(F.lit(0.0), F.col("s2") / F.col("pixel_count") - mean * mean))
    row = sums.select("sequence_id", "pixel_count", "min_dn", "max_dn", mean.alias("mean_dn"), std.alias("std_dn"), "saturation_count", "mask_positive_pixels", *percentile_columns(wanted))
    degrees = [celsius(F.col(f"{k}_dn")).alias(f"{k}_celsius") for k in ("min", "max", "mean", *map(name, wanted))]
    return row.select("*", *degrees, (F.col("std_dn") * C.GAIN).alias("std_celsius"), (F.col("saturation_count") / F.col("pixel_count") * 100).alias("saturation_percent"))


def mask_stats(histogram: DataFrame, frames: DataFrame) -> DataFrame:
    """Release statistics of each dataset and of all: the row `all` has no mean and deviation.  frames: sequence_id, tiff_count."""
    stats = distribution_stats(histogram, (1.0, 50.0, 99.0))
    counted = frames.unionByName(frames.agg(F.sum("tiff_count").alias("tiff_count")).withColumn("sequence_id", F.lit(ALL)))
    one = F.col("sequence_id") != ALL
    columns = [F.col("min_celsius"), F.col("p1_celsius").alias("p01_celsius"), F.col("p50_celsius").alias("median_celsius"), F.col("p99_celsius"), F.col("max_celsius"), F.when(one, F.col("mean_celsius")).alias("mean_celsius"), F.when(one, F.col("std_celsius")).alias("std_celsius")]
    return stats.join(counted, "sequence_id").select(F.col("sequence_id").alias("dataset_id"), "tiff_count", "pixel_count", *columns, "mask_positive_pixels", (F.col("mask_positive_pixels") / F.col("pixel_count")).alias("mask_positive_fraction"))


def binned(histogram: DataFrame, bins: int) -> DataFrame:
    """Equal-width bins on [least, greatest + 1] of all sequences, empty ones included, with each bin's percent.

    A value on an edge belongs to the bin above it; the edge is compared, not only divided."""
    span = histogram.agg(F.min("dn").cast("double").alias("lo"), (F.max("dn") + 1).cast("double").alias("hi"))
    placed = histogram.crossJoin(F.broadcast(span))  # one row
    width = (F.col("hi") - F.col("lo")) / bins
    guess = F.least(F.floor((F.col("dn") - F.col("lo")) / width), F.lit(bins - 1))
    exact = F.when((guess < bins - 1) & (F.col("dn") >= F.col("lo") + width * (guess + 1)), guess + 1).when(F.col("dn") < F.col("lo") + width * guess, guess - 1).otherwise(guess)
    counts = placed.groupBy("sequence_id", exact.cast("int").alias("bin")).agg(F.sum("pixel_count").alias("pixel_count"))
    every = histogram.select("sequence_id").distinct().select("sequence_id", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    full = every.join(counts, ["sequence_id", "bin"], "left").select("sequence_id", "bin", F.coalesce("pixel_count", F.lit(0)).alias("pixel_count"))
    return full.withColumn("percent", F.col("pixel_count") / F.sum("pixel_count").over(Window.partitionBy("sequence_id")) * 100)


def frequency_table(histogram: DataFrame) -> DataFrame:
    """Rows of the histogram with degrees and percent of the group."""
    total = F.sum("pixel_count").over(Window.partitionBy("sequence_id"))
    return histogram.where("pixel_count > 0").select("sequence_id", "dn", celsius(F.col("dn")).alias("celsius"), "pixel_count", (F.col("pixel_count") / total * 100).alias("percent"))


def mask_summary(frames: DataFrame, threshold: int = C.HOT_DN) -> DataFrame:
    """Per sequence: frames, hot pixels, pixels, percent, and frames without a hot pixel.  frames: sequence_id, dn array."""
    hot = F.size(F.filter("dn", lambda x: x >= threshold)).cast("long")
    counted = frames.select("sequence_id", hot.alias("hot"), F.size("dn").cast("long").alias("n"))
    sums = counted.groupBy("sequence_id").agg(F.count(F.lit(1)).alias("tiff_count"), F.sum("hot").alias("positive"), F.sum("n").alias("total"), F.sum((F.col("hot") == 0).cast("long")).alias("all_zero"))
    return sums.withColumn("percent", F.col("positive") / F.col("total") * 100)
