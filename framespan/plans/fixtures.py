"""Views on the test tables in the roles of frames, pixels, circles, scores and manifests.

Each view is SQL that both engines read alike; where they differ, a view has a text for either."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("lineitem", "orders", "events", "documents", "embeddings", "labels", "pages", "part")

#: name -> SQL; {x} is a table or an earlier view
VIEWS: dict[str, str | dict[str, str]] = {
    "fx_pixels": "SELECT l_returnflag || l_linestatus AS sequence_id, l_orderkey AS frame_no, CAST(least(CAST(floor(l_extendedprice / 8) AS INT), 11568) AS INT) AS dn FROM {lineitem}",
    "fx_dn_arrays": {
        "spark": "SELECT sequence_id, frame_no, sort_array(collect_list(dn)) AS dn FROM {fx_pixels} GROUP BY sequence_id, frame_no",
        "duck": "SELECT sequence_id, frame_no, list_sort(list(dn)) AS dn FROM {fx_pixels} GROUP BY sequence_id, frame_no",
    },
    "fx_frames": {
        "spark": "SELECT event_type AS sequence_id, event_id AS frame_id, timestampdiff(SECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts) AS tiff_s, date_format(ts, 'yyyyMMdd_HHmmss') || '.tiff' AS tiff_name FROM {events}",
        "duck": "SELECT event_type AS sequence_id, event_id AS frame_id, CAST(floor(epoch(ts) - epoch(TIMESTAMP '2024-01-01 00:00:00')) AS BIGINT) AS tiff_s, strftime(ts, '%Y%m%d_%H%M%S') || '.tiff' AS tiff_name FROM {events}",
    },
    "fx_models": "SELECT sequence_id, min(tiff_s) AS start_s, max(tiff_s) AS end_s, CAST(78.0 AS DOUBLE) AS video_start, 78.0 + (max(tiff_s) - min(tiff_s)) * CAST(1.0009765625 AS DOUBLE) AS video_end, CAST(0.5 AS DOUBLE) AS offset_s, CAST(30.0 AS DOUBLE) AS fps, CAST(floor((78.0 + (max(tiff_s) - min(tiff_s)) * CAST(1.0009765625 AS DOUBLE)) * 30) AS BIGINT) AS frame_count FROM {fx_frames} GROUP BY sequence_id",
    "fx_segments": "SELECT sequence_id, 'primary' AS segment, start_s AS from_s, start_s + CAST(floor((end_s - start_s) / 2) AS BIGINT) AS to_s, CAST(0.5 AS DOUBLE) AS seg_offset FROM {fx_models} UNION ALL SELECT sequence_id, 'secondary', start_s + CAST(floor((end_s - start_s) / 2) AS BIGINT), end_s + 1, CAST(-0.433 AS DOUBLE) FROM {fx_models}",
    "fx_time_text": "SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderkey % 60 AS VARCHAR(10)) || ':' || CAST(o_orderkey % 59 AS VARCHAR(10)) || '.5' WHEN 1 THEN CAST(o_orderkey % 24 AS VARCHAR(10)) || ':' || CAST(o_orderkey % 60 AS VARCHAR(10)) || ':' || CAST(o_orderkey % 58 AS VARCHAR(10)) WHEN 2 THEN CAST(o_orderkey % 977 AS VARCHAR(10)) ELSE 'x:' || CAST(o_orderkey % 7 AS VARCHAR(10)) END AS text FROM {orders}",
    "fx_circles": "SELECT frame_id, CAST(row_number() OVER (PARTITION BY frame_id ORDER BY cx, cy, r, confidence, source) AS INT) AS cand_no, cx, cy, r, confidence, source FROM (SELECT DISTINCT l_orderkey AS frame_id, CAST(l_partkey % 640 AS DOUBLE) AS cx, CAST((l_suppkey * 37) % 512 AS DOUBLE) AS cy, 20 + l_quantity AS r, 1 - l_discount AS confidence, CASE WHEN l_returnflag = 'A' THEN 'hough_saturation' ELSE 'outer_contour' END AS source FROM {lineitem}) t",
    "fx_track": "SELECT user_id AS anchor, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS frame_index, CASE WHEN event_type <> 'error' THEN value END AS cx, CASE WHEN event_type <> 'error' THEN value / 2 END AS cy, CASE WHEN event_type <> 'error' THEN 64 + value / 8 END AS r, CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'signup' THEN CAST(0.5 AS DOUBLE) ELSE CAST(0.9 AS DOUBLE) END AS confidence FROM {events}",
    "fx_scores": "SELECT anchor, CAST(floor((rn - 1) / 5) AS BIGINT) AS candidate, CAST((rn - 1) % 5 - 2 AS INT) AS o, score, hard_pass FROM (SELECT user_id AS anchor, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn, value / 512 AS score, event_type <> 'error' AS hard_pass FROM {events}) t",
    "fx_maps": {
        "spark": "SELECT vec_id, transform(embedding, e -> CAST(floor(greatest(least((CAST(e AS DOUBLE) + 1) * 128, 255D), 0D)) AS INT)) AS map FROM {embeddings}",
        "duck": "SELECT vec_id, list_transform(embedding, lambda e: CAST(floor(greatest(least((CAST(e AS DOUBLE) + 1) * 128, 255), 0)) AS INT)) AS map FROM {embeddings}",
    },
    "fx_manifest": "SELECT source AS sequence_id, doc_id AS aligned_no, source || '/' || CAST(doc_id AS VARCHAR(20)) || '/thermal.tiff' AS path FROM {documents}",
    "fx_listing": "SELECT d.source AS sequence_id, l.doc_id + CASE WHEN l.doc_id % 7 = 0 THEN 1000000 ELSE 0 END AS aligned_no, d.source || '/' || CAST(l.doc_id + CASE WHEN l.doc_id % 7 = 0 THEN 1000000 ELSE 0 END AS VARCHAR(20)) || '/thermal.tiff' AS path FROM {labels} l JOIN {documents} d ON d.doc_id = l.doc_id",
    "fx_expected": "SELECT sequence_id, count(*) + CASE WHEN sequence_id = 'error' THEN 1 ELSE 0 END AS expected FROM {fx_frames} GROUP BY sequence_id",
}


def _text(name: str, engine: str) -> str:
    value = VIEWS[name]
    return value if isinstance(value, str) else value[engine]


def _names(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", text)))


class Views:
    """Views and tables of one folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        text = _text(name, "spark")
        return self.spark.sql(text, **{n: getattr(self, n) for n in _names(text)})


def with_views(sql: str) -> str:
    """The SQL with the views it names, and those they name, as common table expressions."""
    found: dict[str, str] = {}

    def add(name: str) -> None:
        if name in VIEWS and name not in found:
            text = _text(name, "duck")
            for n in _names(text):
                add(n)
            found[name] = re.sub(r"\{(\w+)\}", r"\1", text)

    for name in re.findall(r"\bfx_\w+", sql):
        add(name)
    if not found:
        return sql
    head = ", ".join(f"{name} AS ({text})" for name, text in found.items())
    body = sql.strip()
    first, rest = re.fullmatch(r"(WITH RECURSIVE |WITH |)(.*)", body, re.S | re.I).groups()
    return f"{first.strip() or 'WITH'} {head}{',' if first else ''} {rest}"
