"""Manifests, incremental refreshes and the checks of a release; checks give rows, not exceptions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framespan import constants as C
from framespan.functions.paths import base_name, repository_path
from framespan.functions.radiometry import general_12, xmp_number
from framespan.functions.timeparse import format_video_time, parse_frame_time
from framespan.operators.timealign import in_segments, numbered, with_video
from framespan.sources.files import checksum_lines
from framespan.sources.ranged import digests, walk_files
from framespan.sources.sinks import write_checksums, write_ordered


def issues(*checks: tuple[Column, str]) -> Column:
    """Names of the checks that hold, an array; a check that is null holds."""
    return F.filter(F.array(*[F.when(F.coalesce(bad, F.lit(True)), F.lit(name)) for bad, name in checks]), lambda x: x.isNotNull())


def page_issues(pages: DataFrame) -> DataFrame:
    """Violations of the thermal page contract in a table of tags."""
    near = lambda c, v: F.abs(c - v) <= 1e-12
    return pages.withColumn("issues", issues(
        (F.col("height") != C.HEIGHT, "height"), (F.col("width") != C.WIDTH, "width"), (F.col("bits") != C.BITS, "bits"),
        (F.col("samples") != 1, "samples"), (F.col("page_count") != 1, "page_count"),
        (F.col("dtype") != C.DTYPE, "dtype"), (F.col("make") != C.MAKE, "make"), (F.col("model") != C.MODEL, "model"), (F.col("xmp").isNull(), "xmp"),
        (F.col("xmp").isNotNull() & ~near(xmp_number(F.col("xmp"), "TlinearGain"), C.GAIN), "gain"),
        (F.col("xmp").isNotNull() & ~near(xmp_number(F.col("xmp"), "IsNormalized"), C.NORMALIZED), "normalized"),
    ))


def video_issues(videos: DataFrame, expected: DataFrame) -> DataFrame:
    """Rate, size and frame count against the expectations (sequence_id, expected)."""
    return videos.join(expected, "sequence_id", "left").withColumn("issues", issues((F.abs(F.col("fps") - C.FPS) > 1e-6, "fps"), ((F.col("width") != C.VIDEO_WIDTH) | (F.col("height") != C.VIDEO_HEIGHT), "size"), (F.col("frame_count") != F.col("expected"), "frame_count")))


def circle_issues(circles: DataFrame, width: int, height: int) -> DataFrame:
    inside = (F.col("cx") >= 0) & (F.col("cy") >= 0) & (F.col("cx") < width) & (F.col("cy") < height)
    whole = (F.col("cx") - F.col("r") >= 0) & (F.col("cy") - F.col("r") >= 0) & (F.col("cx") + F.col("r") <= width) & (F.col("cy") + F.col("r") <= height)
    return circles.withColumn("issues", issues((F.col("r") <= 0, "radius"), (~inside, "center"), (~whole, "border")))


def within_boundary(rows: DataFrame, bounds: DataFrame) -> DataFrame:
    """Rows whose stem lies between the sequence's first and last stem, as text, inclusive."""
    return rows.join(bounds, "sequence_id").where("stem BETWEEN first_stem AND last_stem")


def boundary_report(rows: DataFrame, bounds: DataFrame) -> DataFrame:
    """First and last stem and count of what is kept, against the bounds and the expected count."""
    kept = within_boundary(rows, bounds).groupBy("sequence_id").agg(F.min("stem").alias("first"), F.max("stem").alias("last"), F.count(F.lit(1)).alias("n"))
    return bounds.join(kept, "sequence_id", "left").withColumn("ok", F.coalesce((F.col("first") == F.col("first_stem")) & (F.col("last") == F.col("last_stem")) & (F.col("n") == F.col("expected")), F.lit(False)))


def refreshed_manifest(rows: DataFrame, other: DataFrame, folders: DataFrame, bounds: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """An existing release cut to its boundaries: the kept rows, the kept rows of the other form in the same order, the
    folders that no kept row names, and the faults, with which nothing may be written.

    rows and other (of the CSV and of the JSON lines): sequence_id, aligned_id, stem; rows also place, their order in a
    sequence.  folders: sequence_id, aligned_id; bounds: sequence_id, first_stem, last_stem, expected.  Faults are ids that
    one form alone has, ids without a folder, and sequences with another first or last row or another count."""
    keys = ["sequence_id", "aligned_id"]
    kept, also = (within_boundary(t, bounds.select("sequence_id", "first_stem", "last_stem")).drop("first_stem", "last_stem") for t in (rows, other))
    ordered = also.join(kept.select(*keys, "place"), keys)
    apart = missing_and_stale(kept, also, keys).withColumn("state", F.when(F.col("state") == "missing", "not in the lines").otherwise("not in the table"))
    against = missing_and_stale(kept, folders, keys)
    wrong = boundary_report(rows, bounds).where("NOT ok").select("sequence_id", F.lit(None).cast("string").alias("aligned_id"), F.lit("boundary").alias("state"))
    faults = apart.union(against.where("state = 'missing'").withColumn("state", F.lit("no folder"))).union(wrong)
    return kept, ordered, against.where("state = 'stale'").drop("state"), faults


def write_refreshed(kept: DataFrame, ordered: DataFrame, folder: str) -> None:
    """The manifest's CSV rows and JSON lines, both sorted by sequence and place over all files, so that line k of one is line
    k of the other; the place itself is not written."""
    order = ["sequence_id", "place"]
    for table, name, form in ((kept, "csv", F.to_csv), (ordered, "jsonl", F.to_json)):
        options = {"ignoreNullFields": "false"} if name == "jsonl" else {"emptyValue": ""}
        write_ordered(table, form(F.struct(*[c for c in table.columns if c != "place"]), options), order, f"{folder}/{name}")


def manifest(frames: DataFrame, models: DataFrame, segments: DataFrame, *, scores: DataFrame | None = None, masks: DataFrame | None = None, folder: str = "processed/aligned", six: bool = False) -> DataFrame:
    """Manifest rows of all frames, with the published fields: id, times, video frame, paths, scores, anchor and mask.

    segments: sequence_id, segment, from_s, to_s, seg_offset and, where there are anchors, requested_s, selected_s and
    center_tiff; scores: frame_id, visual_score, thermal_edge_density, video_edge_density; masks: frame_id, positive, total.
    A frame's video time follows the offset of its segment.  six: as in numbered."""
    rows = in_segments(numbered(frames, six=six), segments).join(models.withColumnRenamed("offset_s", "own_offset"), "sequence_id")
    rows = with_video(rows.withColumn("offset_s", F.coalesce("seg_offset", "own_offset")))
    for table in (scores, masks):
        rows = rows if table is None else rows.join(table, "frame_id", "left")
    here = lambda c, kind: F.col(c) if c in rows.columns else F.lit(None).cast(kind)
    path = lambda name: F.concat_ws("/", F.lit(folder), "aligned_id", F.lit(name))
    asked, chosen = here("requested_s", "double"), here("selected_s", "double")
    positive, total = here("positive", "long"), here("total", "long")
    fields = {
        "status": F.lit("exported"), "tiff_name": F.col("tiff_name"), "tiff_time_iso": parse_frame_time(F.col("tiff_name")).cast("string"),
        "video_time_s": F.col("video_s"), "video_time": format_video_time(F.col("video_s")), "video_frame_index": F.col("video_frame"),
        "thermal_source_path": F.concat(F.lit("raw/thermal/"), "tiff_name"), **{field: path(name) for field, name in C.MANIFEST_PATHS.items()},
        **{c: here(c, "double") for c in ("visual_score", "thermal_edge_density", "video_edge_density")}, "anchor_segment": F.col("segment"),
        "anchor_requested_video_time_s": asked, "anchor_requested_video_time": F.when(asked.isNotNull(), format_video_time(asked)),
        "anchor_selected_video_time_s": chosen, "anchor_selected_video_time": F.when(chosen.isNotNull(), format_video_time(chosen)),
        "anchor_center_tiff": here("center_tiff", "string"), "mask_positive_pixels": positive, "mask_positive_fraction": positive / total,
    }
    return rows.select("sequence_id", "frame_id", "aligned_id", *[c.alias(n) for n, c in fields.items()])


def normalized_manifest(rows: DataFrame, masks: DataFrame) -> DataFrame:
    """Legacy rows (pair_id) as release rows, with mask counts (aligned_id, positive, total)."""
    named = rows.withColumn("aligned_id", F.coalesce("aligned_id", "pair_id")).drop("pair_id")
    joined = named.join(masks, "aligned_id", "left")
    return joined.select("aligned_id", "tiff_name", F.concat(F.lit("raw/thermal/"), "tiff_name").alias("thermal_source_path"), F.concat_ws("/", F.lit("processed/aligned"), "aligned_id", F.lit("mask_80c.png")).alias("mask_80c_path"), F.col("positive").alias("mask_positive_pixels"), (F.col("positive") / F.col("total")).alias("mask_positive_fraction"))


def updated_masks(rows: DataFrame, masks: DataFrame) -> DataFrame:
    """Manifest rows with the counts of new masks; the fraction as text with 12 digits, rows without a new mask as before."""
    m = masks.select("aligned_id", F.col("positive").alias("_p"), general_12(F.col("positive") / F.col("total")).alias("_f"))
    return rows.join(m, "aligned_id", "left").withColumns({"mask_positive_pixels": F.coalesce("_p", "mask_positive_pixels"), "mask_positive_fraction": F.coalesce("_f", "mask_positive_fraction")}).drop("_p", "_f")


def viewer_rows(rows: DataFrame) -> DataFrame:
    """The typed viewer rows, their fields in the release's order, of manifest rows whose values are text; an unsafe path is null."""
    path = lambda c: repository_path(F.col("sequence_id"), F.col(c))
    typed = lambda c, kind: F.col(c).try_cast(kind).alias(c)
    return rows.select(
        "sequence_id", "aligned_id", *[path(c).alias(field) for field, c in C.VIEWER_FILES.items()], "tiff_time_iso", "video_time",
        typed("video_time_s", "double"), typed("video_frame_index", "long"), typed("visual_score", "double"), typed("mask_positive_pixels", "long"),
        typed("mask_positive_fraction", "double"), *[path(c).alias(c) for c in ("thermal_tiff_path", "thermal_source_path")],
    )


def viewer_issues(rows: DataFrame, sequences: list[str]) -> DataFrame:
    """Violations of viewer rows: fields and their order, empty texts, types of numbers, unknown sequence, time, templated paths."""
    kinds = dict(rows.dtypes)
    own = lambda c: F.col(c) if c in kinds else F.lit(None)
    bad_text = [own(c).isNull() | F.lit(kinds.get(c) != "string") | (own(c).cast("string") == "") for c in C.VIEWER_TEXTS]
    bad_number = [own(c).isNull() | F.lit(kinds.get(c) != kind) for c, kind in C.VIEWER_NUMBERS.items()]
    paths = {**{field: C.MANIFEST_PATHS[c] for field, c in C.VIEWER_FILES.items()}, "thermal_tiff_path": "thermal.tiff"}
    bad_path = [~own(field).eqNullSafe(F.concat_ws("/", own("sequence_id"), F.lit("processed/aligned"), own("aligned_id"), F.lit(name))) for field, name in paths.items()]
    fields = tuple(c for c in rows.columns if c in C.VIEWER_FIELDS)
    either = lambda checks: reduce(Column.__or__, checks)
    return rows.withColumn("issues", issues(
        (F.lit(fields != C.VIEWER_FIELDS), "fields"), (either(bad_text), "text"), (either(bad_number), "number"),
        (~own("sequence_id").isin(*sequences), "sequence"), (F.try_to_timestamp(own("tiff_time_iso").cast("string")).isNull(), "time"), (either(bad_path), "path"),
    ))


def manifest_path_issues(rows: DataFrame, *, folder: str = "processed/aligned") -> DataFrame:
    """The path fields of manifest rows that differ from their template."""
    templates = {"thermal_source_path": F.concat(F.lit("raw/thermal/"), "tiff_name"), **{field: F.concat(F.lit(f"{folder}/"), "aligned_id", F.lit(f"/{name}")) for field, name in C.MANIFEST_PATHS.items()}}
    return rows.withColumn("issues", issues(*[(F.col(field) != template, field) for field, template in templates.items()]))


def checksums(files: DataFrame) -> DataFrame:
    """digest and path of files (path, content), without the list itself, caches and system files."""
    return listed_files(files).select(F.sha2(F.col("content").cast("binary"), 256).alias("digest"), "path")


def below(path: Column, root: str) -> Column:
    """A path or URI relative to a folder that may be written with or without its scheme."""
    bare = re.sub(r"^[A-Za-z][\w+.-]*:(//[^/]*)?", "", root).rstrip("/")
    return F.regexp_replace(F.regexp_replace(path, r"^[A-Za-z][\w+.-]*:(//[^/]*)?", ""), rf"^\Q{bare}\E/+", "")


def listed_files(files: DataFrame) -> DataFrame:
    """Files (path) that a list of digests names: without the list itself, caches and system files."""
    return files.where(~F.col("path").rlike(r"(^|/)(checksums\.sha256|\.DS_Store)$|(^|/)\.cache/"))


def hashed_files(spark: SparkSession, root: str, chosen: DataFrame | None = None) -> DataFrame:
    """digest and path (below root) of the files of a folder, or of the chosen paths alone; read in tasks block by block."""
    paths = listed_files(walk_files(spark, root)) if chosen is None else chosen.select(F.concat(F.lit(f"{root.rstrip('/')}/"), "path").alias("path"))
    return digests(paths).select("digest", below(F.col("path"), root).alias("path"), "error")


def refresh_checksum_list(spark: SparkSession, root: str, old: str, chosen: DataFrame, new: str) -> None:
    """Writes to `new` the sorted list in `old` with the digests of the chosen paths (path) made anew; others are not read.

    A chosen file that cannot be read keeps its old entry, and has none if it is new."""
    fresh = hashed_files(spark, root, chosen).where("error IS NULL").select("digest", "path")
    write_checksums(upserted_checksums(checksum_lines(spark.read.text(old)), fresh), new)


def verified_files(spark: SparkSession, root: str, expected: DataFrame) -> DataFrame:
    """path and state of listed files (digest, path) that are missing, cannot be read, or whose digest differs."""
    there = walk_files(spark, root).select(below(F.col("path"), root).alias("path"), F.lit(True).alias("there"))
    found = expected.join(there, "path", "left")
    actual = hashed_files(spark, root, found.where("there").select("path")).withColumnRenamed("digest", "actual")
    state = F.when(F.col("there").isNull(), "missing").when(F.col("error").isNotNull(), "unreadable").when(~F.col("actual").eqNullSafe(F.col("digest")), "changed")
    return found.join(actual, "path", "left").withColumn("state", state).where("state IS NOT NULL").select("path", "state")


def verified_checksums(expected: DataFrame, files: DataFrame) -> DataFrame:
    """Listed paths that are missing or whose digest differs."""
    actual = checksums(files).withColumnRenamed("digest", "actual")
    return expected.join(actual, "path", "left").withColumn("state", F.when(F.col("actual").isNull(), "missing").when(F.col("actual") != F.col("digest"), "changed")).where("state IS NOT NULL").select("path", "state")


def upserted_checksums(old: DataFrame, new: DataFrame) -> DataFrame:
    """The digests of chosen paths replaced, the others kept."""
    return old.join(new.withColumnRenamed("digest", "_new"), "path", "full_outer").select("path", F.coalesce("_new", "digest").alias("digest"))


def missing_and_stale(expected: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of one side only, with the side: `missing` are expected and not there, `stale` the other way round."""
    missing = expected.select(*keys).distinct().join(found.select(*keys), keys, "left_anti").withColumn("state", F.lit("missing"))
    return missing.union(found.select(*keys).distinct().join(expected.select(*keys), keys, "left_anti").withColumn("state", F.lit("stale")))


def missing_paths(rows: DataFrame, columns: list[str], listing: DataFrame, keys: list[str]) -> DataFrame:
    """Paths in any of the columns that the listing (path) does not have."""
    named = rows.select(*keys, F.inline(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("path")) for c in columns])))
    return named.join(listing.select("path").distinct(), "path", "left_anti")


def sample_gaps(ids: DataFrame, listing: DataFrame, files: tuple[str, ...] = C.SAMPLE_FILES) -> DataFrame:
    """Required files of each sample (sequence_id, aligned_no) that the listing (path) does not have."""
    wanted = ids.select("sequence_id", "aligned_no", F.explode(F.array(*map(F.lit, files))).alias("file"))
    wanted = wanted.withColumn("path", F.concat_ws("/", "sequence_id", F.col("aligned_no").cast("string"), "file"))
    return wanted.join(listing.select("path").distinct(), "path", "left_anti")


def sample_issues(ids: DataFrame, files: DataFrame, masks: DataFrame, required: tuple[str, ...] = C.SAMPLE_FILES) -> DataFrame:
    """The faults of each sample (sequence_id, aligned_no), rows without a fault left out.

    files: sequence_id, aligned_no, file, height, width and dtype (null for images without one); masks: sequence_id,
    aligned_no and differing, the pixels in which the mask is not the hot pixels.  A required file is missing, has
    another size than a thermal frame, or the thermal image another type; the mask differs or is not there."""
    wanted = ids.select("sequence_id", "aligned_no", F.explode(F.array(*map(F.lit, required))).alias("file"))
    here = files.select("sequence_id", "aligned_no", "file", "height", "width", "dtype", F.lit(True).alias("there"))
    found = wanted.join(here, ["sequence_id", "aligned_no", "file"], "left")
    bad_size = (F.col("height") != C.HEIGHT) | (F.col("width") != C.WIDTH)
    fault = F.when(F.col("there").isNull(), "missing").when(F.coalesce(bad_size, F.lit(True)), "size").when((F.col("file") == required[0]) & ~F.col("dtype").eqNullSafe(F.lit(C.DTYPE)), "dtype")
    faults = found.select("sequence_id", "aligned_no", "file", fault.alias("issue")).where("issue IS NOT NULL")
    wrong = ids.select("sequence_id", "aligned_no").join(masks, ["sequence_id", "aligned_no"], "left").where("differing IS NULL OR differing > 0")
    return faults.union(wrong.select("sequence_id", "aligned_no", F.lit(required[-1]), F.lit("mask")))


def circle_lookup(frames: DataFrame, entries: DataFrame, value: str) -> DataFrame:
    """Frames (path) with the value of their entry (entry_path): by base name, else by path; `missing` without one.

    Of several entries of one name that of the least path counts."""
    named = frames.withColumn("_base", base_name(F.col("path")))
    by_name = entries.groupBy(base_name(F.col("entry_path")).alias("_base")).agg(F.min_by(value, "entry_path").alias("_by_name"))
    by_path = entries.groupBy(F.col("entry_path").alias("path")).agg(F.min_by(value, "entry_path").alias("_by_path"))
    found = named.join(by_name, "_base", "left").join(by_path, "path", "left").withColumn("found", F.coalesce("_by_name", "_by_path"))
    return found.withColumn("missing", F.col("found").isNull()).drop("_base", "_by_name", "_by_path")


def prior_review(frames: DataFrame, prior: DataFrame) -> DataFrame:
    """Frames (tiff_name) of a new review with what an earlier one decided: selected_rank, cx, cy, r.

    prior: tiff_name, selected_rank, circle and candidates (with rank).  An entry with coordinates keeps them and its rank;
    one with a rank alone takes the circle of that candidate; frames without an entry, or with neither, stay open."""
    c = F.col("circle")
    whole = c["cx"].isNotNull() & c["cy"].isNotNull() & c["r"].isNotNull()
    ranked = F.try_element_at(F.filter("candidates", lambda x: x["rank"] == F.col("selected_rank")), F.lit(1))
    rows = frames.join(prior.select("tiff_name", "selected_rank", "circle", "candidates"), "tiff_name", "left")
    keep = [n for n in frames.columns if n != "tiff_name"]
    return rows.select("tiff_name", *keep, "selected_rank", *[F.when(whole, c[n]).otherwise(ranked[n]).alias(n) for n in ("cx", "cy", "r")])


def catalog(configs: DataFrame, stats: DataFrame) -> DataFrame:
    """One row a sequence: what its configuration says, with the selected times of its anchors, and its statistics.

    configs: dataset_id, source_sequence_id, strategy, counts (raw_tiff, aligned), time_mapping (tiff_start, tiff_end,
    anchors); stats: rows of mask_stats, of which that of all sequences is left out."""
    own = configs.select(
        "dataset_id", "source_sequence_id", "strategy", F.col("counts.raw_tiff").alias("raw_tiff_count"), F.col("counts.aligned").alias("aligned_count"),
        "time_mapping.tiff_start", "time_mapping.tiff_end", F.array_join(F.col("time_mapping.anchors")["selected"], " / ").alias("anchors"),
    )
    return own.join(stats, "dataset_id").select(*own.columns, *[c for c in stats.columns if c != "dataset_id"])


def last_id_checks(rows: DataFrame, bounds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For a report: whether the last aligned_id of a sequence is the expected one (1), and the ids from the cutoff on (0).

    bounds: sequence_id, last_id, cutoff."""
    own = bounds.join(rows, "sequence_id", "left").groupBy("sequence_id", "last_id", "cutoff").agg(F.max("aligned_id").alias("last"), F.sum((F.col("aligned_id") >= F.col("cutoff")).cast("int")).alias("over"))
    key = F.col("sequence_id").alias("key")
    last = own.select(key, F.lit(1).alias("expected"), F.coalesce((F.col("last") == F.col("last_id")).cast("int"), F.lit(0)).alias("actual"))
    return last, own.select(key, F.lit(0).alias("expected"), F.coalesce("over", F.lit(0)).alias("actual"))


def total_check(expected: DataFrame, actual: DataFrame, times: int = 1) -> DataFrame:
    """For a report: the rows of a table against those of another, `times` over."""
    return expected.agg((F.count(F.lit(1)) * times).alias("expected")).crossJoin(actual.agg(F.count(F.lit(1)).alias("actual"))).withColumn("key", F.lit("all"))  # one row each


def counts_report(rows: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows a sequence against the expected counts, both ways."""
    n = rows.groupBy("sequence_id").agg(F.count(F.lit(1)).alias("actual"))
    both = n.join(expected, "sequence_id", "full_outer").select("sequence_id", F.coalesce("actual", F.lit(0)).alias("actual"), F.coalesce("expected", F.lit(0)).alias("expected"))
    return both.withColumn("ok", F.col("actual") == F.col("expected"))


def duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def missing_masks(frames: DataFrame, masks: DataFrame) -> DataFrame:
    """Work list: created for frames without a mask, preserved for the others."""
    return frames.join(masks.select("aligned_id").distinct().withColumn("_m", F.lit(True)), "aligned_id", "left").select("aligned_id", F.when(F.col("_m"), "preserved").otherwise("created").alias("state"))


def mask_differences(frames: DataFrame, threshold: int = C.HOT_DN) -> DataFrame:
    """differing pixels and values other than 0/1 of mask against dn, both arrays of a row."""
    wrong = F.size(F.filter(F.zip_with("dn", "mask", lambda d, m: (d >= threshold).cast("int") != m), lambda x: x | x.isNull()))
    return frames.withColumns({"differing": wrong, "not_binary": F.size(F.filter("mask", lambda m: ~m.isin(0, 1)))})


def release_report(checks: list[tuple[str, DataFrame]]) -> DataFrame:
    """All checks as rows (check, key, expected, actual, ok); each check has key, expected and actual."""
    rows = [c.select(F.lit(name).alias("check_name"), F.col("key").cast("string").alias("key"), F.col("expected").cast("long").alias("expected"), F.col("actual").cast("long").alias("actual"), (F.col("expected") == F.col("actual")).alias("ok")) for name, c in checks]
    return reduce(DataFrame.unionByName, rows)
