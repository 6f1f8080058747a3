"""Times and names as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_video_time(text: Column) -> Column:
    """Seconds of `S`, `M:S` or `H:M:S` (fractions allowed); null for other shapes."""
    parts = F.split(F.trim(text), ":")
    number = F.transform(parts, lambda p: F.trim(p).try_cast("double"))
    total = F.aggregate(number, F.lit(0.0), lambda sum_, x: sum_ * 60 + x)
    return F.when(F.size(parts).between(1, 3), total)


def format_video_time(seconds: Column) -> Column:
    """`HH:MM:SS`, with `.mmm` when there are milliseconds; negative is zero; half-even milliseconds carry."""
    ms = F.rint(F.greatest(seconds, F.lit(0.0)) * 1000).cast("long")
    part = lambda div, mod: F.lpad((F.floor(ms / div) % mod).cast("string"), 2, "0")
    hours = F.floor(ms / 3_600_000)
    head = F.concat_ws(":", F.when(hours < 10, F.lpad(hours.cast("string"), 2, "0")).otherwise(hours.cast("string")), part(60_000, 60), part(1000, 60))
    rest = ms % 1000
    return F.when(rest == 0, head).otherwise(F.concat(head, F.lit("."), F.lpad(rest.cast("string"), 3, "0")))


def parse_frame_time(name: Column) -> Column:
    """Naive time of the first `yyyyMMdd_HHmmss` in a file's stem; null without one."""
    stem = F.regexp_replace(F.regexp_extract(name, r"([^/]*)$", 1), r"\.[^.]*$", "")
    return F.try_to_timestamp(F.regexp_extract(stem, r"(\d{8}_\d{6})", 1), F.lit("yyyyMMdd_HHmmss")).cast("timestamp_ntz")


def frame_index(time_s: Column, fps: Column, frame_count: Column) -> Column:
    """Half-even frame index of a time, both clamped to the video."""
    time_s = F.greatest(F.lit(0.0), F.least(time_s, frame_count / fps))
    return F.greatest(F.lit(0), F.least(F.rint(time_s * fps).cast("long"), frame_count - 1))


def video_seconds(tiff_s: Column, start_s: Column, end_s: Column, video_start: Column, video_end: Column, offset: Column) -> Column:
    """Linear time model: thermal time to video time; null when the thermal range is empty."""
    return F.when(end_s > start_s, video_start + (tiff_s - start_s) * ((video_end - video_start) / (end_s - start_s)) + offset)


def tiff_seconds(video_s: Column, start_s: Column, end_s: Column, video_start: Column, video_end: Column, offset: Column) -> Column:
    """The inverse of video_seconds."""
    return F.when(end_s > start_s, start_s + (video_s - offset - video_start) / ((video_end - video_start) / (end_s - start_s)))


def offset_label(offset: Column) -> Column:
    """`score_tiff_m2` for -2, `score_tiff_p2` for 2."""
    return F.concat(F.lit("score_tiff_"), F.when(offset < 0, "m").otherwise("p"), F.abs(offset).cast("string"))


def percentile_label(percentile: Column) -> Column:
    """`p0_1` for 0.1, `p50` for 50."""
    return F.concat(F.lit("p"), F.translate(F.regexp_replace(percentile.cast("string"), r"\.0$", ""), ".", "_"))
