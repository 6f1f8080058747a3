"""Release paths as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: fixed replacements, in order: machine paths of frames, of videos, of transforms
RULES = (
    (r"""(?:/Users/[^,\s"'}]+/|raw_data/[^,\s"'}]+/)(\d{8}_\d{6}\.tiff)""", "raw/thermal/$1"),
    (r"""(?:/Users/[^,\s"'}]+|raw_data/[^,\s"'}]+)\.(?:MP4|mp4|MOV|mov)""", "raw/video.mp4"),
    (r"""output/[^,\s"'}]+/transform\.json""", "metadata/transform.json"),
)
#: fixed place of a special key
KEYS = {"tiff_dir": "raw/thermal", "video": "raw/video.mp4", "out": "processed"}


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)/*$", 1)


def clean_path(value: Column, key: str = "") -> Column:
    """A machine's path as a release path; other texts stay."""
    for pattern, to in RULES:
        value = F.regexp_replace(value, pattern, to)
    low = F.lower(value)
    found = (
        F.when(low.rlike(r"\.(mp4|mov)$"), "raw/video.mp4")
        .when(low.rlike(r"\.tiff?$"), F.concat(F.lit("raw/thermal/"), base_name(value)))
        .when(low.contains("pad_circles_manual"), "metadata/calibration/pad_circles_manual.json")
        .when(low.contains("video_pad_seeds"), "metadata/calibration/video_pad_seeds_manual.json")
        .when(low.contains("transform.json") & (low.contains("output") | low.contains("review")), "metadata/transform.json")
    )
    if key in KEYS:
        return found.otherwise(KEYS[key])
    found = found.when(value.startswith("/Users/") | value.contains("/output/") | value.startswith("output/"), F.concat(F.lit("metadata/calibration/"), base_name(value)))
    return found.when(value.startswith("raw_data/"), "raw/video.mp4").otherwise(value)


def sanitize(column: Column, kind: T.DataType, key: str = "") -> Column:
    """The cleaner applied to every string of a nested value; the field max_pairs becomes max_aligned."""
    if isinstance(kind, T.StringType):
        return clean_path(column, key)
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda x: sanitize(x, kind.elementType, key))
    if isinstance(kind, T.MapType) and isinstance(kind.valueType, T.StringType):
        return F.transform_values(column, lambda k, v: clean_path(v))
    if isinstance(kind, T.StructType):
        fields = [sanitize(column[f.name], f.dataType, f.name).alias("max_aligned" if f.name == "max_pairs" else f.name) for f in kind.fields]
        return F.when(column.isNotNull(), F.struct(*fields))
    return column


def repository_path(sequence_id: Column, path: Column) -> Column:
    """Path inside the repository; null for an absolute path or one that leaves the folder."""
    return F.when(~path.rlike(r"(^/|(^|/)\.\.(/|$))"), F.concat_ws("/", sequence_id, path))
