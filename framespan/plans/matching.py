"""Queries of candidate generation, geometry, scores and ranking."""

from __future__ import annotations

from pyspark.sql import functions as F

from framespan.functions import circles as C
from framespan.operators import crops as G
from framespan.operators import ranking as R
from framespan.plans.registry import query

_D = "CAST({} AS DOUBLE)".format


@query("gen_crop_grid", f"""WITH v AS (SELECT p_partkey AS video_id, 640 + p_size * 16 AS video_w, 480 + p_size * 8 AS video_h FROM part),
s AS (SELECT v.*, k, CAST(round_even(video_h * f, 0) AS INT) AS h FROM v, (VALUES (0, {_D(0.5)}), (1, {_D(0.75)}), (2, {_D(1.0)})) t(k, f)), q AS (SELECT *, CAST(round_even(h * {_D(1.25)}, 0) AS INT) AS w FROM s),
c AS (SELECT *, greatest(32, CAST(round_even(least(w, h) * {_D(0.25)}, 0) AS INT)) AS step FROM q WHERE w <= video_w AND h <= video_h),
y AS (SELECT *, unnest(list_distinct(list_append(range(0, video_h - h + 1, step), video_h - h))) AS y FROM c), x AS (SELECT *, unnest(list_distinct(list_append(range(0, video_w - w + 1, step), video_w - w))) AS x FROM y)
SELECT video_id, CAST(row_number() OVER (PARTITION BY video_id ORDER BY k, y, x) AS INT) AS seq_no, CAST(x AS INT) AS x, CAST(y AS INT) AS y, w, h FROM x""")
def crop_grid(v):
    videos = v.part.select(F.col("p_partkey").alias("video_id"), (640 + F.col("p_size") * 16).alias("video_w"), (480 + F.col("p_size") * 8).alias("video_h"))
    return G.crop_grid(videos, [0.5, 0.75, 1.0], 1.25, 0.25)


_GUIDED = f"""p AS (SELECT frame_id * 100 + cand_no AS pair_id, cx, cy, r, cx * 2 + 300 AS vx, cy * 2 + 200 AS vy, r * 2 AS vr FROM fx_circles),
g AS (SELECT *, CAST(round_even(vr * 640 / greatest(r, 1) * s * sqrt(a), 0) AS INT) AS w, CAST(round_even(vr * 512 / greatest(r, 1) * s / sqrt(a), 0) AS INT) AS h FROM p,
 (VALUES (0, {_D(0.92)}), (1, {_D(0.97)}), (2, {_D(1.0)}), (3, {_D(1.03)}), (4, {_D(1.08)})) t1(ns, s), (VALUES (0, {_D(0.98)}), (1, {_D(1.0)}), (2, {_D(1.02)})) t2(na, a), (VALUES (0, {_D(-0.12)}), (1, {_D(0.0)}), (2, {_D(0.12)})) t3(ny, sy), (VALUES (0, {_D(-0.12)}), (1, {_D(0.0)}), (2, {_D(0.12)})) t4(nx, sx)),
c AS (SELECT *, least(greatest(CAST(round_even(vx - cx * w / 640 + sx * vr, 0) AS INT), 0), 3840 - w) AS x, least(greatest(CAST(round_even(vy - cy * h / 512 + sy * vr, 0) AS INT), 0), 2160 - h) AS y FROM g WHERE w > 0 AND h > 0 AND w <= 3840 AND h <= 2160)"""


def _pairs(v):
    twice = F.struct((F.col("cx") * 2 + 300).alias("cx"), (F.col("cy") * 2 + 200).alias("cy"), (F.col("r") * 2).alias("r"))
    return v.fx_circles.select((F.col("frame_id") * 100 + F.col("cand_no")).alias("pair_id"), F.struct("cx", "cy", "r").alias("thermal"), twice.alias("video"), F.lit(3840).alias("video_w"), F.lit(2160).alias("video_h"))


@query("gen_guided_crops", f"WITH {_GUIDED}, k AS (SELECT pair_id, x, y, w, h, CAST(min(((ns * 3 + na) * 3 + ny) * 3 + nx + 1) AS INT) AS seq_no FROM c GROUP BY ALL) SELECT pair_id, count(*) AS crops, sum(x)::BIGINT AS x, sum(y)::BIGINT AS y, sum(w)::BIGINT AS w, sum(h)::BIGINT AS h, sum(seq_no * (x + 3 * y + 7 * w + 11 * h)::BIGINT)::BIGINT AS digest FROM k GROUP BY 1")
def guided_crops(v):
    """All crops of all pairs, and of each pair their number, sums and a digest of places in order."""
    return G.guided_crop_sums(_pairs(v))


@query("set_unique_crops", "SELECT CAST(l_partkey % 40 AS INT) AS x, CAST(l_suppkey % 30 AS INT) AS y, min(l_orderkey) AS seq_no FROM lineitem GROUP BY 1, 2")
def unique_crops(v):
    return R.first_seen(v.lineitem.select((F.col("l_partkey") % 40).cast("int").alias("x"), (F.col("l_suppkey") % 30).cast("int").alias("y"), F.col("l_orderkey").alias("seq_no")), ["x", "y"])


def _metrics_sql(source: str, keys: str) -> str:
    return f"""e AS (SELECT {keys}, sqrt(pow((vx - x) * 640 / CAST(w AS DOUBLE) - tx, 2) + pow((vy - y) * 512 / CAST(h AS DOUBLE) - ty, 2)) / greatest(tr, 1) AS center, abs(0.5 * (vr * 640 / CAST(w AS DOUBLE) + vr * 512 / CAST(h AS DOUBLE)) - tr) / greatest(tr, 1) AS radius,
 abs(vr * 640 / CAST(w AS DOUBLE) - vr * 512 / CAST(h AS DOUBLE)) / greatest(0.5 * (vr * 640 / CAST(w AS DOUBLE) + vr * 512 / CAST(h AS DOUBLE)), 1) AS aniso FROM {source}),
 f AS (SELECT *, exp(-pow(center / {_D(0.075)}, 2)) AS sc, exp(-pow(radius / {_D(0.12)}, 2)) AS sr, exp(-pow(aniso / {_D(0.18)}, 2)) AS sa FROM e),
 m AS (SELECT *, {_D(0.48)} * sc + {_D(0.28)} * sr + {_D(0.16)} * sc * sr + {_D(0.08)} * sa AS score, center <= {_D(0.12)} AND radius <= {_D(0.18)} AND aniso <= 0.25 AS pass FROM f)"""


_ROWS = "z AS (SELECT frame_id, cand_no, cx AS tx, cy AS ty, r AS tr, cx * 2 + 100 AS vx, cy * 2 + 50 AS vy, r * 2.125 AS vr, 90 AS x, 60 AS y, 1280 AS w, 1000 + frame_id % 64 AS h FROM fx_circles)"


def _crop_rows(v):
    video = F.struct((F.col("cx") * 2 + 100).alias("cx"), (F.col("cy") * 2 + 50).alias("cy"), (F.col("r") * 2.125).alias("r"))
    return v.fx_circles.select("frame_id", "cand_no", F.struct("cx", "cy", "r").alias("thermal"), video.alias("video"), F.lit(90).alias("x"), F.lit(60).alias("y"), F.lit(1280).alias("w"), (1000 + F.col("frame_id") % 64).alias("h"))


@query("geo_pad_metrics", f"WITH {_ROWS}, {_metrics_sql('z', 'frame_id, cand_no')} SELECT frame_id, cand_no, round(center, 6) AS center, round(radius, 6) AS radius, round(aniso, 6) AS anisotropy, round(score, 6) AS score, pass FROM m")
def pad_metrics(v):
    m = G.crop_metrics(_crop_rows(v))
    return m.select("frame_id", "cand_no", F.round("m.center_ratio", 6).alias("center"), F.round("m.radius_ratio", 6).alias("radius"), F.round("m.anisotropy", 6).alias("anisotropy"), F.round("m.geometry_score", 6).alias("score"), F.col("m.hard_pass").alias("pass"))


@query("geo_composite_score", f"WITH {_ROWS}, {_metrics_sql('z', 'frame_id, cand_no')} SELECT frame_id, cand_no, round(({_D(0.65)} * score + {_D(0.25)} * sc + {_D(0.1)} * sr) * CASE WHEN pass THEN 1 ELSE 0.25 END, 6) AS score FROM m")
def composite_score(v):
    m = G.crop_metrics(_crop_rows(v))
    bell = lambda c, w: F.exp(-F.pow(F.col(c) / w, 2))
    return m.select("frame_id", "cand_no", F.round(C.composite(F.col("m.geometry_score"), bell("m.center_ratio", 0.075), bell("m.radius_ratio", 0.12), F.col("m.hard_pass")), 6).alias("score"))


_POOL = """t AS (SELECT frame_id, cand_no, cx AS tx, cy AS ty, r AS tr FROM fx_circles), k AS (SELECT frame_id, cand_no AS seq_no, cx * 2 + 100 AS vx, cy * 2 + 50 AS vy, r * 2 AS vr, 1200 + cand_no * 20 AS w, 1000 AS h, 90 AS x, 60 AS y FROM fx_circles), z AS (SELECT * FROM k JOIN t USING (frame_id))"""


def _pool(v, n=None):
    c = v.fx_circles
    video = F.struct((F.col("cx") * 2 + 100).alias("cx"), (F.col("cy") * 2 + 50).alias("cy"), (F.col("r") * 2).alias("r"))
    crops = c.select("frame_id", F.col("cand_no").alias("seq_no"), video.alias("video"), (1200 + F.col("cand_no") * 20).alias("w"), F.lit(1000).alias("h"), F.lit(90).alias("x"), F.lit(60).alias("y"))
    return G.best_circles(crops, c.select("frame_id", "cand_no", F.struct("cx", "cy", "r").alias("thermal")), n)


_BEST = f"WITH {_POOL}, {_metrics_sql('z', 'frame_id, seq_no, cand_no')}, b AS (SELECT *, row_number() OVER (PARTITION BY frame_id, seq_no ORDER BY round(score, 12) DESC, cand_no) AS i FROM m)"


@query("agg_best_circle", f"{_BEST} SELECT frame_id, seq_no, cand_no, round(score, 6) AS score FROM b WHERE i = 1")
def best_circle(v):
    return _pool(v).select("frame_id", "seq_no", "cand_no", F.round("m.geometry_score", 6).alias("score"))


@query("geo_spatial_pool", f"{_BEST} SELECT frame_id, CAST(n AS INT) AS rank, seq_no, cand_no, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY frame_id ORDER BY round(score, 12) DESC, seq_no) AS n FROM b WHERE i = 1) WHERE n <= 3")
def spatial_pool(v):
    return _pool(v, 3).select("frame_id", "rank", "seq_no", "cand_no", F.round("m.geometry_score", 6).alias("score"))


@query("geo_circle_scores", f"""WITH z AS (SELECT *, r / 512 AS q, confidence AS sup, cx / 640 AS cov, cy / 4096 AS prom FROM fx_circles), s AS (SELECT *, exp(-pow((q - {_D(0.17)}) / {_D(0.11)}, 2)) AS prior FROM z)
SELECT frame_id, cand_no, round(prior, 10) AS prior, round(({_D(0.35)} * sup + {_D(0.3)} * cov + {_D(0.15)} * prom + {_D(0.1)} * {_D(0.5)} + {_D(0.07)} * prior + {_D(0.03)} * {_D(0.25)}) * CASE WHEN q > {_D(0.3)} THEN {_D(0.65)} ELSE 1 END * CASE WHEN q > {_D(0.24)} AND prom < {_D(0.03)} THEN {_D(0.85)} ELSE 1 END, 10) AS thermal,
 round({_D(0.3)} * least(1, r / (512 * {_D(0.18)})) + 0.25 * cov + 0.25 * sup + {_D(0.2)} * least(1, prom * 4 / CASE WHEN cx < 100 THEN {_D(0.3)} ELSE {_D(0.58)} END) + CASE WHEN cx < 100 AND cand_no = 1 THEN {_D(0.08)} ELSE 0 END, 10) AS contour,
 round({_D(0.78)} + {_D(0.12)} * least(1, prom / {_D(0.22)}) + {_D(0.08)} * least(1, cov / {_D(0.35)}) - CASE WHEN cx < 100 THEN {_D(0.12)} ELSE 0 END, 10) AS hough FROM s""")
def circle_scores(v):
    sup, cov, prom = F.col("confidence"), F.col("cx") / 640, F.col("cy") / 4096
    prior, thermal = C.thermal_circle_score(sup, cov, prom, F.lit(0.5), F.lit(0.25), F.col("r") / 512)
    part = F.col("cx") < 100
    contour = C.contour_circle_score(F.col("r"), F.lit(512.0), cov, sup, prom * 4, part, F.col("cand_no") == 1)
    columns = {"prior": prior, "thermal": thermal, "contour": contour, "hough": C.hough_confidence(prom, cov, part)}
    return v.fx_circles.select("frame_id", "cand_no", *[F.round(c, 10).alias(n) for n, c in columns.items()])


@query("agg_window_score", "SELECT anchor, candidate, count(*) AS n, round(avg(score), 12) AS mean, round(median(score), 12) AS median, round(sum(score * (3 - abs(o))) / sum(3 - abs(o)), 12) AS weighted FROM fx_scores GROUP BY 1, 2")
def window_score(v):
    s = R.window_scores(v.fx_scores, ["anchor", "candidate"], 2)
    return s.select("anchor", "candidate", "n", *[F.round(c, 12).alias(c) for c in ("mean", "median", "weighted")])


_O = ((-2, "m2"), (-1, "m1"), (0, "p0"), (1, "p1"), (2, "p2"))
_WINDOW_ROW = "SELECT anchor, candidate, arg_min(hard_pass, (abs(o), o)) AS hard_pass, arg_min(score, (abs(o), o)) AS center, min(score) AS least, round(avg(score), 12) AS mean, " + ", ".join(f"max(score) FILTER (o = {o}) AS score_tiff_{n}" for o, n in _O) + " FROM fx_scores GROUP BY 1, 2"


_MEANS = {"pad_geometry": "1 - score", "masked_visual": "score / 2", "full_visual": "score * score"}


@query("agg_window_row", _WINDOW_ROW.replace(" FROM fx_scores", "".join(f", round(avg({e}), 12) AS {m}_mean" for m, e in _MEANS.items()) + " FROM fx_scores"))
def window_row(v):
    scores = v.fx_scores.withColumns({m: F.expr(e) for m, e in _MEANS.items()})
    found = R.window_rows(scores, ["anchor", "candidate"], 2, tuple(_MEANS))
    return found.withColumns({c: F.round(c, 12) for c in ("mean", *(f"{m}_mean" for m in _MEANS))})


@query("agg_window_summary", "SELECT anchor, count(DISTINCT candidate) AS candidates, min(candidate) AS first, max(candidate) AS last FROM fx_scores GROUP BY 1")
def window_summary(v):
    return R.window_summary(v.fx_scores, "anchor", "candidate")


_RANKED = f"WITH w AS ({_WINDOW_ROW}), r AS (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY hard_pass DESC, mean DESC, center DESC, least DESC, abs(candidate - 5), candidate) AS n FROM w)"


def _ranked(v):
    rows = R.window_rows(v.fx_scores, ["anchor", "candidate"], 2)
    rows = rows.withColumns({"aggregate": F.round("mean", 12), "distance": F.col("candidate") - 5, "search_order": F.col("candidate")})
    return R.rank_candidates(rows, ["anchor"])


@query("win_rank_candidates", _RANKED + " SELECT anchor, candidate, CAST(n AS INT) AS rank FROM r")
def rank_candidates(v):
    return _ranked(v).select("anchor", "candidate", "rank")


@query("srt_top_candidates", _RANKED + " SELECT anchor, candidate, CAST(n AS INT) AS rank FROM r WHERE n <= 3")
def top_candidates(v):
    return _ranked(v).where("rank <= 3").select("anchor", "candidate", "rank")


_STRATEGIES = "s AS (SELECT anchor, candidate // 3 AS frame, CAST(candidate % 3 AS INT) AS strategy, o, score, hard_pass FROM fx_scores), w AS (SELECT anchor, frame, strategy, arg_min(hard_pass, (abs(o), o)) AS hard_pass, arg_min(score, (abs(o), o)) AS center, min(score) AS least, round(avg(score), 12) AS mean FROM s GROUP BY 1, 2, 3)"


@query("win_select_crop_strategy", f"WITH {_STRATEGIES} SELECT anchor, frame, strategy FROM (SELECT *, row_number() OVER (PARTITION BY anchor, frame ORDER BY hard_pass DESC, mean DESC, center DESC, least DESC, strategy) AS n FROM w) WHERE n = 1")
def select_crop_strategy(v):
    """Three strategies a frame, each with the scores of a whole window."""
    scores = v.fx_scores.select("anchor", F.floor(F.col("candidate") / 3).alias("frame"), (F.col("candidate") % 3).cast("int").alias("strategy"), "o", "score", "hard_pass")
    rows = R.window_rows(scores, ["anchor", "frame", "strategy"], 2).withColumns({"aggregate": F.round("mean", 12), "distance": F.col("frame")})
    return R.best_strategies(rows, ["anchor", "frame"]).select("anchor", "frame", "strategy")


_SEQ = "s AS (SELECT anchor, candidate * 10 + o AS id, abs(o) AS grp, score, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, candidate, o) AS seq_no FROM fx_scores)"


@query("win_diversify", f"WITH {_SEQ}, t AS (SELECT *, row_number() OVER (PARTITION BY anchor, grp ORDER BY seq_no) AS rnd, first(score) OVER (PARTITION BY anchor, grp ORDER BY seq_no) AS fs, first(seq_no) OVER (PARTITION BY anchor, grp ORDER BY seq_no) AS fq, count(*) OVER (PARTITION BY anchor) AS al FROM s), u AS (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY rnd, fs DESC, fq) AS turn FROM t) SELECT anchor, id, grp AS group_id FROM u WHERE al <= 20 OR turn <= 20")
def diversify(v):
    from pyspark.sql import Window

    seq = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "candidate", "o"))
    rows = v.fx_scores.select("anchor", (F.col("candidate") * 10 + F.col("o")).alias("id"), F.abs("o").alias("group"), "score", seq.alias("seq_no"))
    return R.diversify(rows, "anchor").select("anchor", "id", F.col("group").alias("group_id"))


@query("flt_min_alignment", "SELECT anchor, candidate, o, NOT any_ok AS fallback FROM (SELECT *, bool_or(score >= 0.125) OVER (PARTITION BY anchor, candidate) AS any_ok FROM fx_scores) WHERE score >= 0.125 OR NOT any_ok")
def min_alignment(v):
    rows = v.fx_scores.withColumns({"alignment": F.col("score"), "key": F.concat_ws("/", "anchor", "candidate")})
    return R.least_alignment(rows, "key", 0.125).select("anchor", "candidate", "o", "fallback")
