"""Files as tables: frame listings, thermal images, calibration JSON, configurations and checksums."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framespan.functions.paths import base_name
from framespan.functions.timeparse import parse_frame_time
from framespan.sources.codecs import read_tiff

#: pixels that are decoded before they leave a task
PIXELS = 1 << 20
CIRCLE = "struct<cx:double,cy:double,r:double,score:double>"
CANDIDATE = "struct<cx:double,cy:double,r:double,source:string,score:double,edge_support:double,edge_off_support:double,edge_coverage:double,edge_prominence:double,edge_contrast:double,radius_prior:double,border_score:double,rank:int>"
FRAMES = f"array<struct<tiff_name:string,tiff_path:string,timestamp:string,selected_rank:int,circle:{CIRCLE},candidates:array<{CANDIDATE}>>>"
SEED = "struct<frame_index:int,video_time_s:double,target:string,note:string,circle:struct<cx:double,cy:double,r:double>>"
CONFIG = "dataset_id string, source_sequence_id string, strategy string, time_mapping struct<tiff_start:string,tiff_end:string,video_start:string,video_end:string,anchors:array<struct<name:string,requested:string,selected:string>>>, mask struct<threshold_celsius:double,threshold_dn:int>, counts struct<raw_tiff:long,aligned:long>"
TRANSFORM_SIDE = "struct<anchor_s:double,offset_s:double,selected:struct<crop_x:int,crop_y:int,crop_w:int,crop_h:int,matrix:array<array<double>>>,selected_candidate:struct<crop_x:int,crop_y:int,crop_w:int,crop_h:int,matrix:array<array<double>>>>"
TRANSFORM = f"strategy string, split_tiff_s double, primary {TRANSFORM_SIDE}, secondary {TRANSFORM_SIDE}"


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """path, length and modificationTime of the files below a folder; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder).select("path", "length", "modificationTime")


def scan_frames(files: DataFrame) -> DataFrame:
    """Thermal frames of a listing (path): .tif and .tiff in any case, with a time in the name."""
    found = files.where(F.lower("path").rlike(r"\.tiff?$")).withColumn("tiff_time", parse_frame_time(F.col("path")))
    return found.where("tiff_time IS NOT NULL").select("path", base_name(F.col("path")).alias("tiff_name"), "tiff_time")


def sequence_of(path: Column, root: str) -> Column:
    """Folder of a file below the root; `.` in the root itself."""
    inside = F.regexp_replace(path, rf"^\Q{root.rstrip('/')}\E/", "")
    folder = F.regexp_replace(inside, r"/?[^/]*$", "")
    return F.when(folder == "", ".").otherwise(folder)


def decode_thermal(files: DataFrame, *, height: int | None = None, width: int | None = None) -> DataFrame:
    """path, height, width, dn and error of 16-bit TIFF contents (path, content).

    Layouts and compressions as in codecs.read_tiff, the first channel; other and damaged files give an error text.  A
    file is one value of a row, so files are dealt to tasks by Spark's reader."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            rows: list[tuple] = []
            first = pixels = 0

            def made(last: int) -> pa.RecordBatch:
                columns = zip(*rows, strict=True)
                return pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), *[pa.array(v, t) for v, t in zip(columns, (pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.string()), strict=True)]], names=["path", "height", "width", "dn", "error"])  # noqa: B023

            for k in range(batch.num_rows):
                try:
                    h, w, dn = read_tiff(batch.column(1)[k].as_py() or b"", height, width)
                    rows.append((h, w, dn, None))
                    pixels += len(dn)
                except (ValueError, KeyError, IndexError, OSError, struct.error, TypeError) as error:
                    rows.append((None, None, None, str(error) or type(error).__name__))
                if pixels >= PIXELS:  # a few images at a time in memory
                    yield made(k + 1)
                    rows, first, pixels = [], k + 1, 0
            if rows:
                yield made(batch.num_rows)

    return files.select("path", "content").mapInArrow(batches, "path string, height int, width int, dn array<int>, error string")


def png_size(content: Column) -> tuple[Column, Column]:
    """Width and height in the header of a PNG file; null for other contents."""
    head = F.hex(F.substring(content, 1, 24))
    number = lambda at: F.when(head.startswith("89504E470D0A1A0A"), F.conv(F.substring(head, at, 8), 16, 10).cast("int"))
    return number(33), number(41)


def read_json(spark: SparkSession, path: str | list[str], schema: str, *, lines: bool = False) -> DataFrame:
    """Documents of JSON files below the path, one a file as published, or one a line."""
    return spark.read.schema(schema).option("multiLine", str(not lines).lower()).option("recursiveFileLookup", "true").json(path)


def confirmed_circles(frames: DataFrame) -> DataFrame:
    """One row a calibrated frame: its circle by coordinates, else the candidate of the selected rank, else an issue.

    frames: entry (struct as in FRAMES).  With coordinates a missing or zero rank becomes -1."""
    e = F.col("entry")
    coordinates = e["circle"]["cx"].isNotNull() & e["circle"]["cy"].isNotNull() & e["circle"]["r"].isNotNull()
    by_rank = F.try_element_at(F.filter(e["candidates"], lambda c: c["rank"] == e["selected_rank"]), F.lit(1))
    pick = lambda n: F.when(coordinates, e["circle"][n]).otherwise(by_rank[n]).alias(n)
    rank = F.when(coordinates, F.when(F.coalesce(e["selected_rank"], F.lit(0)) == 0, -1).otherwise(e["selected_rank"])).otherwise(e["selected_rank"])
    issue = F.when(~coordinates & by_rank.isNull(), "no circle and no candidate of the selected rank")
    return frames.select(base_name(e["tiff_name"]).alias("tiff_name"), e["tiff_path"].alias("tiff_path"), e["timestamp"].alias("timestamp"), rank.alias("selected_rank"), pick("cx"), pick("cy"), pick("r"), issue.alias("issue"))


def read_pad_circles(spark: SparkSession, path: str | list[str], *, lines: bool = False) -> DataFrame:
    return confirmed_circles(read_json(spark, path, f"version int, instructions string, frames {FRAMES}", lines=lines).select(F.explode("frames").alias("entry")))


def seed_rows(seeds: DataFrame) -> DataFrame:
    """Rows of the map `anchors`: primary and secondary only, with issues of unusable ones."""
    keep = [c for c in seeds.columns if c == "dataset"]
    rows = seeds.select(*keep, F.explode("anchors").alias("anchor", "s")).where("anchor IN ('primary', 'secondary')")
    c = F.col("s.circle")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    checks = [(F.coalesce(F.col("s.frame_index"), F.lit(-1)) < 0, "frame_index"), (~(finite(c["cx"]) & finite(c["cy"]) & finite(c["r"])), "circle"), (F.coalesce(c["r"], F.lit(0.0)) <= 0, "radius")]
    return rows.select(*keep, "anchor", "s.frame_index", "s.video_time_s", c["cx"].alias("cx"), c["cy"].alias("cy"), c["r"].alias("r"), F.filter(F.array(*[F.when(bad, F.lit(n)) for bad, n in checks]), lambda x: x.isNotNull()).alias("issues"))


def read_video_seeds(spark: SparkSession, path: str | list[str], *, lines: bool = False) -> DataFrame:
    """dataset, anchor, the seed's values and issues."""
    return seed_rows(read_json(spark, path, f"version int, dataset string, notes string, anchors map<string,{SEED}>", lines=lines))


def config_rows(configs: DataFrame) -> DataFrame:
    """One row an anchor of each configuration."""
    return configs.select("dataset_id", "source_sequence_id", "strategy", "time_mapping.tiff_start", "time_mapping.tiff_end", "time_mapping.video_start", "time_mapping.video_end", "mask.threshold_dn", "counts.raw_tiff", "counts.aligned", F.posexplode_outer("time_mapping.anchors").alias("anchor_no", "a")).select("*", F.col("a.name").alias("anchor"), F.col("a.requested").alias("requested"), F.col("a.selected").alias("selected")).drop("a")


def read_configs(spark: SparkSession, path: str | list[str], *, lines: bool = False) -> DataFrame:
    return config_rows(read_json(spark, path, CONFIG, lines=lines))


def read_transforms(spark: SparkSession, path: str | list[str], *, keys: str = "", lines: bool = False) -> DataFrame:
    """The segments of transform files; keys: further fields of the documents, that tell them apart."""
    return transform_segments(read_json(spark, path, f"{keys}{', ' * bool(keys)}{TRANSFORM}", lines=lines))


def transform_segments(bundles: DataFrame) -> DataFrame:
    """One row a segment of each transform; dual when the strategy says so or both anchors are there."""
    dual = F.col("strategy").contains("dual") | (F.col("primary").isNotNull() & F.col("secondary").isNotNull())
    side = lambda n: F.struct(F.lit(n).alias("segment"), F.coalesce(F.col(f"{n}.selected"), F.col(f"{n}.selected_candidate")).alias("crop"), F.col(f"{n}.offset_s").alias("offset_s"))
    rows = bundles.select("*", F.inline(F.when(dual, F.array(side("primary"), side("secondary"))).otherwise(F.array(side("primary")))))
    complete = F.col("crop.matrix").isNotNull() & F.col("crop.crop_w").isNotNull() & F.col("crop.crop_h").isNotNull()
    keep = [c for c in bundles.columns if c not in ("strategy", "split_tiff_s", "primary", "secondary")]
    return rows.select(*keep, "segment", "offset_s", "split_tiff_s", "crop.crop_x", "crop.crop_y", "crop.crop_w", "crop.crop_h", "crop.matrix", complete.alias("complete"))


def checksum_lines(lines: DataFrame) -> DataFrame:
    """digest and path of lines `<digest>  <path>`, split once; blank lines are skipped."""
    parts = F.split("value", "  ", 2)
    return lines.where(F.trim("value") != "").select(parts[0].alias("digest"), F.try_element_at(parts, F.lit(2)).alias("path"))
