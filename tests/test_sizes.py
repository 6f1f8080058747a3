"""Work whose cost or result once changed with the size of the tables."""

import duckdb
import numpy as np
from pyspark.sql import functions as F

from framespan import constants as C
from framespan.operators import crops, images, ranges, releases, timealign
from framespan.plans import registry
from framespan.sources import sinks


def against_sql(spark, name: str, folder) -> list[tuple]:
    """The rows of a query on the tables of a folder, which are those of its SQL."""
    found = registry.queries()[name](spark, str(folder))
    columns = sorted(found.columns)
    connection = duckdb.connect()
    for path in folder.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}{'/*.parquet' if path.is_dir() else ''}'")
    rows = sorted(map(tuple, found.select(*columns).collect()), key=repr)
    assert list(map(repr, rows)) == sorted(map(repr, connection.sql(f"SELECT {', '.join(columns)} FROM ({registry.oracle_sql()[name]})").fetchall()))
    return rows


def made(folder, **tables: str):
    """The folder with tables of DuckDB's SQL."""
    for name, sql in tables.items():
        duckdb.connect().execute(f"COPY ({sql}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return folder


def test_sums_of_crops_are_those_of_the_crops(spark):
    """Also of pairs whose crops are clamped into one place, do not fit, or have no circle."""
    rng = np.random.default_rng(7)
    rows = [(k, (float(rng.integers(640)), float(rng.integers(512)), r), (float(rng.integers(3840)), float(rng.integers(2160)), v), 3840, 2160) for k, (r, v) in enumerate([(0.0, 2.0), (30.0, 70.0), (21.0, 0.01), (40.0, 9000.0), (3.0, 2.0), (64.0, 216.0)] * 40)]
    rows += [(-1, None, (1.0, 1.0, 1.0), 3840, 2160), (-2, (1.0, 1.0, 1.0), (None, 1.0, 1.0), 3840, 2160)]
    circle = "struct<cx:double,cy:double,r:double>"
    pairs = spark.createDataFrame(rows, f"pair_id long, thermal {circle}, video {circle}, video_w int, video_h int")
    expected, sums = set(), {}
    for pair, thermal, video, whole_w, whole_h in rows[:-2]:
        seen, number = set(), 0
        for s in C.SIZE_SCALES:
            for a in C.ASPECT_SCALES:
                w = round(video[2] * 640 / max(thermal[2], 1) * s * a**0.5)
                h = round(video[2] * 512 / max(thermal[2], 1) * s / a**0.5)
                for dy in C.CENTER_SHIFTS:
                    for dx in C.CENTER_SHIFTS:
                        number += 1
                        if not (0 < w <= whole_w and 0 < h <= whole_h):
                            continue
                        x = min(max(round(video[0] - thermal[0] * w / 640 + dx * video[2]), 0), whole_w - w)
                        y = min(max(round(video[1] - thermal[1] * h / 512 + dy * video[2]), 0), whole_h - h)
                        if (x, y, w, h) not in seen:
                            seen.add((x, y, w, h))
                            expected.add((pair, x, y, w, h, number))
                            sums[pair] = [p + q for p, q in zip(sums.get(pair, [0] * 6), (1, x, y, w, h, number * (x + 3 * y + 7 * w + 11 * h)), strict=True)]
    found = [tuple(r) for r in crops.guided_crops(pairs).collect()]
    assert len(found) == len(expected) and set(found) == expected
    assert {r.pair_id: list(r[1:]) for r in crops.guided_crop_sums(pairs).collect()} == sums
    assert 0 < min(v[0] for v in sums.values()) < max(v[0] for v in sums.values()) and len(sums) < len(rows)


def test_no_frame_is_walked_anew_for_every_row(spark):
    """A window to the end of its key costs the square of the key's rows."""
    rows = spark.range(1000).selectExpr("1 AS k", "id AS t", "IF(id % 7 = 3, id, NULL) AS v")
    for most in (ranges.ONE_TASK, 0):
        found = ranges.before_and_after(rows, "k", ["t"], F.col("v"), most=most)
        assert "unboundedfollowing" not in found._jdf.queryExecution().optimizedPlan().toString().lower().replace("rowframe, 1, unboundedfollowing", "")
        place = lambda t, step: next((x for x in range(t, 1000 if step > 0 else -1, step) if x % 7 == 3), None)
        assert {(r.t, r.before, r.after) for r in found.collect()} == {(t, place(t, -1), place(t, 1)) for t in range(1000)}
    frames = spark.createDataFrame([("a", k, t) for k, t in enumerate([1, 4, 4, 6, 10, 15, 30])] + [("b", 9, 5), ("c", 10, None)], "sequence_id string, frame_id long, t long")
    bounds = spark.createDataFrame([("a", 12, 5), ("b", -3, 100), ("c", 1, 2), ("d", 1, 2)], "sequence_id string, low long, high long")
    found = timealign.frames_between(frames, bounds)
    assert "Window" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.frame_id for r in found.collect()) == [1, 2, 3, 4, 9]  # 4 of the two at one distance, and 10


def test_frames_between_two_days(spark, tmp_path):
    """Many frames of one second."""
    events = "SELECT k::BIGINT AS event_id, TIMESTAMP '2024-01-02 00:00:00' + to_seconds((k * 7919 % 9973) * 41) AS ts, (k % 5)::BIGINT AS user_id, ['view', 'click', 'error'][1 + k % 3] AS event_type, k / 4 AS value FROM range(30000) t(k)"
    assert against_sql(spark, "flt_frames_between", made(tmp_path, events=events))


def test_numbers_of_seven_digits(spark):
    """The library keeps them whole; the query follows the lpad of its SQL."""
    frames = spark.range(1_000_003).selectExpr("'a' AS sequence_id", "id AS frame_id", "id AS tiff_s", "'x.tiff' AS tiff_name")
    last = F.col("frame_id") >= 999_998
    assert [r.aligned_id for r in timealign.numbered(frames).where(last).orderBy("frame_id").collect()] == ["999999_x", "1000000_x", "1000001_x", "1000002_x", "1000003_x"]
    assert [r.aligned_id for r in timealign.numbered(frames, six=True).where(last).orderBy("frame_id").collect()] == ["999999_x", *["100000_x"] * 4]


def test_paths_of_seven_digits(spark):
    frames = spark.range(1_000_001).selectExpr("'a' AS sequence_id", "id AS frame_id", "id AS tiff_s", "'x.tiff' AS tiff_name")
    models = spark.sql("SELECT 'a' AS sequence_id, 0L AS start_s, 1000000L AS end_s, 0D AS video_start, 1000000D AS video_end, 0D AS offset_s, 30D AS fps, 30000000L AS frame_count")
    segments = spark.sql("SELECT 'a' AS sequence_id, 'primary' AS segment, 999999L AS from_s, 1000001L AS to_s, 0D AS seg_offset")
    path = lambda six: [r[0] for r in releases.manifest(frames, models, segments, six=six).orderBy("frame_id").select("thermal_tiff_path").collect()]
    assert path(False) == ["processed/aligned/1000000_x/thermal.tiff", "processed/aligned/1000001_x/thermal.tiff"]
    assert path(True) == ["processed/aligned/100000_x/thermal.tiff"] * 2


def test_texts_of_large_doubles(spark, tmp_path):
    """Nine places of the exact value, as printf gives them."""
    values = [8113669238.15918, 35056257521.2041, 59476865696.637695, 0.0009765625, 0.0029296875, 5e-10, -1.5, None]
    rows = spark.createDataFrame([(k, x) for k, x in enumerate(values)], "n int, x double")
    assert [tuple(r) for r in sinks.stats_text(rows).orderBy("n").collect()] == [(k, None if x is None else "%.9f" % x) for k, x in enumerate(values)]
    price = "SELECT k::BIGINT AS l_orderkey, 'A' AS l_returnflag, 'F' AS l_linestatus, 89999.0 + k % 3 AS l_extendedprice FROM range(4000007) t(k)"
    assert against_sql(spark, "sink_stats_csv", made(tmp_path, lineitem=price))


def test_levels_of_images_on_the_half(spark, tmp_path):
    """Small images whose levels lie on halves; large ones, of which some have one value but for a cell."""
    rng = np.random.default_rng(5)
    made(tmp_path, lineitem="SELECT (k // 3)::BIGINT AS l_orderkey, 'A' AS l_returnflag, 'F' AS l_linestatus, 8 * (4000 + CASE k % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 + k // 3 % 97 ELSE 100 + k // 3 % 300 END)::DOUBLE AS l_extendedprice FROM range(60000) t(k) UNION ALL SELECT 100000 + k % 3, 'A', 'F', CASE WHEN k < 3 THEN 900.0 ELSE 8000.0 + k % 3 * (k // 3) END FROM range(3000) t(k) UNION ALL SELECT 100009, 'A', 'F', 9535 * 8.0 UNION ALL SELECT 100009, 'A', 'F', 9561 * 8.0 UNION ALL SELECT 100009, 'A', 'F', 9691 * 8.0")
    assert against_sql(spark, "img_normalize", tmp_path)
    whole = [int(x) for x in rng.integers(0, 65536, 300_000)]
    rows = [(1, whole), (2, [7] * 500 + [9]), (3, []), (4, None), (5, [3, None, 5, None]), (6, [5] * 9)]
    found = {r.id: r.gray for r in images.normalize(spark.createDataFrame(rows, "id int, dn array<int>")).collect()}
    low, high = np.percentile(whole, [1, 99])
    assert found.pop(1) == np.rint(np.clip((np.array(whole) - low) / (high - low), 0, 1) * 255).astype(int).tolist()
    assert found == {2: [0] * 500 + [255], 3: [], 4: None, 5: [0, None, 255, None], 6: [0] * 9}


def test_changed_files_that_are_empty(spark, tmp_path):
    """Spark's own listing leaves empty files out."""
    documents = "SELECT k::BIGINT AS doc_id, CASE WHEN k < 200 THEN '' ELSE 'text ' || k END AS text, 'en' AS lang, ['web', 'news', 'code'][1 + k % 3] AS source, 0::BIGINT AS n_chars FROM range(0, 2500, 10) t(k)"
    rows = against_sql(spark, "inc_checksum_files", made(tmp_path, documents=documents))
    assert len(rows) > 100


def test_tags_without_a_listing_on_the_driver(spark, tmp_path, monkeypatch):
    def fails(*_):
        raise AssertionError("the driver lists a file a document")

    monkeypatch.setattr("framespan.sources.files.list_files", fails)
    documents = "SELECT k::BIGINT AS doc_id, 'x' AS text, 'en' AS lang, 'a' AS source, k % 7 AS n_chars FROM range(0, 300) t(k)"
    assert len(against_sql(spark, "src_page_tags", made(tmp_path, documents=documents))) == 300


def test_best_circles_are_those_of_all_pairs(spark):
    """A frame of 700 circles, ties, a crop without a video circle, circles that are missing or empty; pairs are no rows."""
    rng = np.random.default_rng(3)
    circle = "struct<cx:double,cy:double,r:double>"
    frames = [(1, 700), (2, 3), (3, 1), (4, 0)]
    near = lambda: (float(300 + rng.integers(12)), float(250 + rng.integers(12)), float(60 + rng.integers(8)))
    rows = [(f, k, near()) for f, n in frames for k in range(n)] + [(2, 7, None), (2, 8, (1.0, 1.0, 0.0)), (5, 1, None)]
    circles = spark.createDataFrame(rows, f"frame_id long, cand_no int, thermal {circle}")
    crops_ = [(f, k, 90, 60, 1280 + 16 * (k % 3), 1024, None if k == 4 else (700.0, 560.0, 128.0)) for f in range(1, 7) for k in range(6)]
    crops_ = spark.createDataFrame(crops_, f"frame_id long, seq_no int, x int, y int, w int, h int, video {circle}")
    pairs = crops.crop_metrics(crops_.join(circles, "frame_id")).select("frame_id", "seq_no", "cand_no", "m").collect()
    best: dict = {}
    for p in sorted(pairs, key=lambda p: (-round(p.m.geometry_score, 12), p.cand_no)):
        best.setdefault((p.frame_id, p.seq_no), p)
    found = crops.best_circles(crops_, circles)
    assert "collect_list" in found._jdf.queryExecution().optimizedPlan().toString()
    found = {(r.frame_id, r.seq_no): r for r in found.collect()}
    assert found.keys() == best.keys() and len(best) == 24
    for key, p in best.items():
        assert found[key].cand_no == p.cand_no and found[key].m.hard_pass == p.m.hard_pass
        assert np.allclose(list(found[key].m), list(p.m), rtol=1e-12)
    assert {r.thermal for r in found.values() if r.frame_id == 5} == {None}
    ranked = crops.best_circles(crops_, circles, 2).collect()
    expected = [key for f in (1, 2, 3, 5) for key in sorted((k for k in best if k[0] == f), key=lambda k: (-round(best[k].m.geometry_score, 12), k[1]))[:2]]
    assert {(r.frame_id, r.seq_no) for r in ranked} == set(expected) and {r.rank for r in ranked} == {1, 2}
