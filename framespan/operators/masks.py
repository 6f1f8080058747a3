"""Masks of hot pixels as files: all inputs are judged before the first write, valid masks stay, missing ones are made.

Tasks open files by path and send back a few numbers; images are neither joined nor shuffled.  A mask is the indices 0 and 1
with a black and white palette, beside its thermal image."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framespan import constants as C
from framespan.operators.releases import page_issues
from framespan.sources.codecs import read_index_png, read_tiff, write_palette_png
from framespan.sources.ranged import facts, page_tags, walk_files
from framespan.sources.shared import fresh_folder
from framespan.sources.sinks import put_file

THERMAL, MASK = "thermal.tiff", "mask_80c.png"
#: fixed values: black, white
PALETTE = bytes((0, 0, 0, 255, 255, 255))


def _signed(cells: np.ndarray) -> str:
    """Tells masks apart: their size and all cells."""
    return hashlib.sha256(repr(cells.shape).encode() + np.ascontiguousarray(cells, np.uint8).tobytes()).hexdigest()


def _mask(data: bytes, threshold: int) -> np.ndarray:
    height, width, dn = read_tiff(data)
    return (dn >= threshold).astype(np.uint8).reshape(height, width)


def folder_of(path: str) -> Column:
    return F.regexp_replace(path, r"/[^/]*$", "")


def preflight(spark: SparkSession, root: str, *, threshold: int = C.HOT_DN, contract: bool = True) -> DataFrame:
    """path, state, positive, total and error of every thermal image below root.

    `created` has no mask yet, `preserved` a right one; `conflicting` masks differ in pixels, size or palette or cannot be
    read; `unreadable` are images that cannot be, or break the page contract."""

    def judged(source: pa.NativeFile, _: str) -> dict:
        mask = _mask(source.read(), threshold)
        return {"positive": int(mask.sum()), "total": mask.size, "signature": _signed(mask)}

    def held(source: pa.NativeFile, _: str) -> dict:
        cells, palette = read_index_png(source.read())
        if palette is None or palette[:6] != PALETTE:
            raise ValueError("not indices of black and white")
        return {"held": _signed(cells)}

    tree = walk_files(spark, root)
    images = tree.where(F.col("path").endswith(f"/{THERMAL}"))
    found = facts(images, judged, "positive long, total long, signature string").withColumn("folder", folder_of("path"))
    masks = facts(tree.where(F.col("path").endswith(f"/{MASK}")), held, "held string").select(folder_of("path").alias("folder"), "held", F.col("error").alias("mask_error"), F.lit(True).alias("there"))
    if contract:
        bad = page_issues(page_tags(images)).where(F.size("issues") > 0).select("path", F.concat(F.lit("page: "), F.array_join("issues", ", ")).alias("bad"))
        found = found.join(bad, "path", "left").withColumn("error", F.coalesce("error", "bad")).drop("bad")
    both = found.join(masks, "folder", "left")
    state = F.when(F.col("error").isNotNull(), "unreadable").when(F.col("there").isNull(), "created").when(F.col("held").eqNullSafe(F.col("signature")), "preserved").otherwise("conflicting")
    differs = F.when(state == "conflicting", F.coalesce("mask_error", F.lit("the mask differs")))
    return both.select("path", state.alias("state"), "positive", "total", F.coalesce("error", differs).alias("error"))


def build_masks(spark: SparkSession, root: str, *, threshold: int = C.HOT_DN, contract: bool = True) -> DataFrame:
    """Makes the missing masks below root, and gives the rows of the preflight with `valid`, whether the mask is right now.

    With an unreadable image or a conflicting mask anywhere nothing is written.  Masks are written under another name and
    renamed, and a task that runs again writes the same bytes; afterwards every mask is opened again."""

    def make(source: pa.NativeFile, path: str) -> dict:
        data = write_palette_png(_mask(source.read(), threshold), PALETTE)
        put_file(f"{path.rsplit('/', 1)[0]}/{MASK}", data)
        return {"bytes": len(data)}

    plan = fresh_folder(spark, "masks")
    preflight(spark, root, threshold=threshold, contract=contract).write.parquet(plan)
    report = spark.read.parquet(plan)
    if not report.where("state IN ('unreadable', 'conflicting')").limit(1).count():
        facts(report.where("state = 'created'"), make, "bytes long").where("error IS NOT NULL").count()
    after = preflight(spark, root, threshold=threshold, contract=contract).select("path", (F.col("state") == "preserved").alias("valid"))
    return report.join(after, "path", "left").withColumn("valid", F.coalesce("valid", F.lit(False)))


def mask_report(report: DataFrame) -> DataFrame:
    """One row: images, masks made and kept, hot and all pixels, masks without a hot pixel."""
    return report.agg(
        F.count(F.lit(1)).alias("tiff_count"), F.count_if((F.col("state") == "created") & F.col("valid")).alias("created"), F.count_if(F.col("state") == "preserved").alias("preserved"),
        F.coalesce(F.sum("positive"), F.lit(0)).alias("positive"), F.coalesce(F.sum("total"), F.lit(0)).alias("total"), F.count_if(F.col("positive") == 0).alias("all_zero"),
    )
