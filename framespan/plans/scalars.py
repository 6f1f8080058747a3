"""Queries of the scalar functions and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from framespan.functions import circles, paths, radiometry, timeparse
from framespan.plans.registry import query


@query("fn_parse_video_time", """
SELECT id, CASE len(string_split(text, ':')) WHEN 1 THEN TRY_CAST(text AS DOUBLE)
  WHEN 2 THEN TRY_CAST(split_part(text, ':', 1) AS DOUBLE) * 60 + TRY_CAST(split_part(text, ':', 2) AS DOUBLE)
  WHEN 3 THEN (TRY_CAST(split_part(text, ':', 1) AS DOUBLE) * 60 + TRY_CAST(split_part(text, ':', 2) AS DOUBLE)) * 60 + TRY_CAST(split_part(text, ':', 3) AS DOUBLE) END AS seconds
FROM fx_time_text""")
def parse_video_time(v):
    return v.fx_time_text.select("id", timeparse.parse_video_time(F.col("text")).alias("seconds"))


@query("fn_format_video_time", """
SELECT o_orderkey AS id, lpad(CAST(ms // 3600000 AS VARCHAR), 2, '0') || ':' || lpad(CAST(ms // 60000 % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(ms // 1000 % 60 AS VARCHAR), 2, '0')
  || CASE WHEN ms % 1000 = 0 THEN '' ELSE '.' || lpad(CAST(ms % 1000 AS VARCHAR), 3, '0') END AS text
FROM (SELECT o_orderkey, CAST(round_even(greatest((o_totalprice - 1000) / 8, 0) * 1000, 0) AS BIGINT) AS ms FROM orders)""")
def format_video_time(v):
    return v.orders.select(F.col("o_orderkey").alias("id"), timeparse.format_video_time((F.col("o_totalprice") - 1000) / 8).alias("text"))


@query("fn_parse_frame_time", "SELECT frame_id, strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(tiff_s), '%Y-%m-%d %H:%M:%S') AS tiff_time FROM fx_frames")
def parse_frame_time(v):
    return v.fx_frames.select("frame_id", F.date_format(timeparse.parse_frame_time(F.concat(F.lit("raw/"), "tiff_name")), "yyyy-MM-dd HH:mm:ss").alias("tiff_time"))


@query("fn_dn_to_celsius", "SELECT DISTINCT dn, round(dn * CAST(0.04 AS DOUBLE) - CAST(273.15 AS DOUBLE), 6) AS celsius FROM fx_pixels")
def dn_to_celsius(v):
    return v.fx_pixels.select("dn").distinct().select("dn", F.round(radiometry.celsius(F.col("dn")), 6).alias("celsius"))


@query("fn_threshold_dn", "SELECT DISTINCT t, g, CASE WHEN g > 0 THEN CAST(ceil((t + CAST(273.15 AS DOUBLE)) / g) AS BIGINT) END AS dn FROM (SELECT floor(l_quantity * 4) AS t, CASE WHEN l_linenumber = 1 THEN CAST(0 AS DOUBLE) ELSE l_linenumber * CAST(0.02 AS DOUBLE) END AS g FROM lineitem)")
def threshold_dn(v):
    rows = v.lineitem.select(F.floor(F.col("l_quantity") * 4).cast("double").alias("t"), F.when(F.col("l_linenumber") == 1, 0.0).otherwise(F.col("l_linenumber") * 0.02).alias("g")).distinct()
    return rows.select("t", "g", radiometry.threshold_dn(F.col("t"), F.col("g")).alias("dn"))


@query("fn_mask_array", "SELECT sequence_id, frame_no, list_sum(list_transform(dn, lambda x: CASE WHEN x >= 8829 THEN 1 ELSE 0 END))::BIGINT AS hot, len(dn)::BIGINT AS total FROM fx_dn_arrays")
def mask_array(v):
    masks = v.fx_dn_arrays.select("sequence_id", "frame_no", radiometry.mask(F.col("dn")).alias("m"))
    return masks.select("sequence_id", "frame_no", F.aggregate("m", F.lit(0).cast("long"), lambda a, x: a + x).alias("hot"), F.size("m").cast("long").alias("total"))


@query("fn_xmp_number", "SELECT l_orderkey, l_linenumber, l_discount AS d, CASE WHEN l_linenumber = 2 THEN NULL ELSE l_discount END AS gain FROM lineitem")
def xmp_number(v):
    xmp = F.when(F.col("l_linenumber") == 2, "<x:xmpmeta/>").otherwise(F.concat(F.lit("<x><FLIR:TlinearGain> "), F.col("l_discount").cast("string"), F.lit(" </FLIR:TlinearGain></x>")))
    return v.lineitem.select("l_orderkey", "l_linenumber", F.col("l_discount").alias("d"), radiometry.xmp_number(xmp, "TlinearGain").alias("gain"))


@query("fn_clean_path", """
SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'raw/thermal/20240101_000000.tiff' WHEN 1 THEN 'raw/video.mp4' WHEN 2 THEN 'metadata/transform.json'
  WHEN 3 THEN 'metadata/calibration/' || CAST(page_id AS VARCHAR) || '.json' WHEN 4 THEN 'raw/video.mp4' ELSE url END AS path FROM pages""")
def clean_path(v):
    number = F.col("page_id").cast("string")
    shapes = {0: F.lit("/Users/me/raw/20240101_000000.tiff"), 1: F.concat(F.lit("raw_data/a/"), number, F.lit(".MOV")), 2: F.concat(F.lit("output/"), number, F.lit("/transform.json")), 3: F.concat(F.lit("/Users/me/output/"), number, F.lit(".json")), 4: F.concat(F.lit("raw_data/"), number)}
    raw = F.col("url")
    for k, shape in shapes.items():
        raw = F.when(F.col("page_id") % 6 == k, shape).otherwise(raw)
    return v.pages.select("page_id", paths.clean_path(raw).alias("path"))


@query("fn_sanitize_nested", "SELECT page_id, 'raw/thermal/' || CAST(page_id AS VARCHAR) || '.tiff' AS video_file, 'processed' AS out_dir, page_id AS max_aligned FROM pages")
def sanitize_nested(v):
    record = v.pages.select("page_id", F.struct(F.array(F.concat(F.lit("/x/"), F.col("page_id").cast("string"), F.lit(".tiff"))).alias("files"), F.lit("/tmp/o").alias("out"), F.col("page_id").alias("max_pairs")).alias("config"))
    clean = record.select("page_id", paths.sanitize(F.col("config"), record.schema["config"].dataType).alias("c"))
    return clean.select("page_id", F.col("c.files")[0].alias("video_file"), F.col("c.out").alias("out_dir"), "c.max_aligned")


@query("fn_repository_path", "SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE source || '/' || 'a/' || CAST(doc_id AS VARCHAR) END AS path FROM documents")
def repository_path(v):
    n = F.col("doc_id").cast("string")
    raw = F.when(F.col("doc_id") % 10 == 0, F.concat(F.lit("/a/"), n)).when(F.col("doc_id") % 10 == 5, F.concat(F.lit("a/../"), n)).otherwise(F.concat(F.lit("a/"), n))
    return v.documents.select("doc_id", paths.repository_path(F.col("source"), raw).alias("path"))


_CROP = "CAST(l_partkey % 100 AS DOUBLE) AS x, CAST(l_suppkey % 100 AS DOUBLE) AS y, 512 + l_quantity * 16 AS w, 512 + l_quantity * 8 AS h"


@query("fn_crop_matrix", f"""
SELECT l_orderkey, round(sum(640 / w), 6) AS a, round(sum(-x * (640 / w)), 5) AS c, round(sum(512 / h), 6) AS e, round(sum(-y * (512 / h)), 5) AS f, round(sum(2 * (640 / w)), 6) AS a2, round(sum(2 * (-x * (640 / w)) + 3), 5) AS c2
FROM (SELECT l_orderkey, {_CROP} FROM lineitem) GROUP BY l_orderkey""")
def crop_matrix(v):
    rows = v.lineitem.selectExpr("l_orderkey", *_CROP.split(", "))
    m = rows.select("l_orderkey", circles.crop_matrix(*(F.col(c) for c in "xywh"), F.lit(640.0), F.lit(512.0)).alias("m"))
    double = F.array(F.array(F.lit(2.0), F.lit(0.0), F.lit(3.0)), F.array(F.lit(0.0), F.lit(2.0), F.lit(3.0)))
    m = m.withColumn("t", circles.compose_affine(double, F.col("m")))
    cell = lambda c, i, j, n, d: F.round(F.sum(F.col(c)[i][j]), d).alias(n)
    return m.groupBy("l_orderkey").agg(cell("m", 0, 0, "a", 6), cell("m", 0, 2, "c", 5), cell("m", 1, 1, "e", 6), cell("m", 1, 2, "f", 5), cell("t", 0, 0, "a2", 6), cell("t", 0, 2, "c2", 5))


_MAP = "(cx - 10) * CAST(640 AS DOUBLE) / 1280", "(cy - 20) * CAST(512 AS DOUBLE) / 960", "r * CAST(640 AS DOUBLE) / 1280", "r * CAST(512 AS DOUBLE) / 960"


@query("fn_map_circle", f"SELECT frame_id, cand_no, round({_MAP[0]}, 6) AS cx, round({_MAP[1]}, 6) AS cy, round(0.5 * ({_MAP[2]} + {_MAP[3]}), 6) AS r, round(r * 0.5 * (CAST(192 AS DOUBLE) / 640 + CAST(154 AS DOUBLE) / 512), 6) AS small_r FROM fx_circles")
def map_circle(v):
    lit = lambda x: F.lit(float(x))
    c = v.fx_circles.withColumn("c", F.struct("cx", "cy", "r"))
    m = circles.map_circle(lit(10), lit(20), lit(1280), lit(960), lit(640), lit(512), F.col("c"))
    s = circles.scale_circle(F.col("c"), lit(640), lit(512), lit(192), lit(154))
    c = c.select("frame_id", "cand_no", m.alias("m"), s.alias("s"))
    return c.select("frame_id", "cand_no", *[F.round(f"m.{k}", 6).alias(k) for k in ("cx", "cy", "r")], F.round("s.r", 6).alias("small_r"))


@query("fn_circle_partial", "SELECT frame_id, cand_no, (cx - r <= 2 OR cy - r <= 2 OR cx + r >= 638 OR cy + r >= 510) AS partial FROM fx_circles")
def circle_partial(v):
    return v.fx_circles.select("frame_id", "cand_no", circles.partial(F.col("cx"), F.col("cy"), F.col("r"), F.lit(640), F.lit(512)).alias("partial"))


@query("fn_frame_index", "SELECT id, CAST(greatest(0, least(round_even(greatest(0, least(t, 9000 / CAST(30 AS DOUBLE))) * 30, 0), 8999)) AS BIGINT) AS i FROM (SELECT o_orderkey AS id, o_totalprice / 512 - 50 AS t FROM orders)")
def frame_index(v):
    return v.orders.select(F.col("o_orderkey").alias("id"), timeparse.frame_index(F.col("o_totalprice") / 512 - 50, F.lit(30.0), F.lit(9000).cast("long")).alias("i"))


@query("fn_candidate_label", "SELECT DISTINCT o, 'score_tiff_' || CASE WHEN o < 0 THEN 'm' ELSE 'p' END || CAST(abs(o) AS VARCHAR) AS label, 'p' || CAST(abs(o) AS VARCHAR) || '_5' AS percentile FROM fx_scores")
def candidate_label(v):
    return v.fx_scores.select("o").distinct().select("o", timeparse.offset_label(F.col("o")).alias("label"), timeparse.percentile_label(F.abs("o") + F.lit(0.5)).alias("percentile"))
