"""Queries of edge maps, regions, area resizing and the anchor search, on the small maps of the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from framespan.operators import pixels as P
from framespan.operators import search as S
from framespan.plans.matching import _metrics_sql
from framespan.plans.registry import query
from framespan.plans.statistics import _COS

_D = "CAST({} AS DOUBLE)".format


def _mirrored(values: str, dy: int, dx: int) -> str:
    """Cell k of an 8x8 list moved by (dy, dx), mirrored at the border without the border cell."""
    at = lambda v, d: f"(CASE {v} + {d} WHEN -1 THEN 1 WHEN 8 THEN 6 ELSE {v} + {d} END)"
    return f"{values}[{at('(k // 8)', dy)} * 8 + {at('(k % 8)', dx)} + 1]"


def _inside(values: str, dy: int, dx: int) -> str:
    return f"coalesce(CASE WHEN k // 8 + {dy} BETWEEN 0 AND 7 AND k % 8 + {dx} BETWEEN 0 AND 7 THEN {values}[k + {8 * dy + dx} + 1] END, 0)"


_NEAR = [(y, x) for y in (-1, 0, 1) for x in (-1, 0, 1)]
_BLUR = " + ".join(f"{(2 - abs(y)) * (2 - abs(x))} * {_mirrored('map', y, x)}" for y, x in _NEAR)
_GX = " + ".join(f"{x * (2 - abs(y))} * {_mirrored('b', y, x)}" for y, x in _NEAR if x)
_GY = " + ".join(f"{y * (2 - abs(x))} * {_mirrored('b', y, x)}" for y, x in _NEAR if y)
_M = "m[k + 1]"


def _beats(first: tuple[int, int], second: tuple[int, int], last: str) -> str:
    return f"{_M} > {_inside('m', *first)} AND {_M} {last} {_inside('m', *second)}"


@query("img_edge_map", f"""WITH RECURSIVE b AS (SELECT vec_id, list_transform(range(64), lambda k: ({_BLUR} + 8) >> 4) AS b FROM fx_maps),
t AS (SELECT *, list_aggregate(b, 'median') AS q FROM b), h AS (SELECT vec_id, b, CAST(floor(greatest(0, {_D(0.66)} * q)) AS INT) AS lo, CAST(floor(least(255, greatest(30, {_D(1.33)} * q))) AS INT) AS hi FROM t),
g AS (SELECT vec_id, CASE WHEN hi <= lo THEN 30 ELSE lo END AS lo, CASE WHEN hi <= lo THEN 90 ELSE hi END AS hi, list_transform(range(64), lambda k: {_GX}) AS gx, list_transform(range(64), lambda k: {_GY}) AS gy FROM h),
m AS (SELECT *, list_transform(range(64), lambda k: abs(gx[k + 1]) + abs(gy[k + 1])) AS m FROM g),
c AS (SELECT vec_id, k, lo, hi, {_M} AS s, CASE WHEN abs(gy[k + 1]) < abs(gx[k + 1]) * tan(pi() / 8) THEN {_beats((0, -1), (0, 1), '>=')} WHEN abs(gy[k + 1]) > abs(gx[k + 1]) * tan(3 * pi() / 8) THEN {_beats((-1, 0), (1, 0), '>=')}
 WHEN (gx[k + 1] < 0) <> (gy[k + 1] < 0) THEN {_beats((-1, 1), (1, -1), '>')} ELSE {_beats((-1, -1), (1, 1), '>')} END AS top FROM (SELECT *, unnest(range(64)) AS k FROM m)),
w AS (SELECT vec_id, k, s > hi AS strong FROM c WHERE top AND s > lo), e AS (SELECT vec_id, k FROM w WHERE strong UNION SELECT w.vec_id, w.k FROM e JOIN w ON w.vec_id = e.vec_id AND abs(w.k // 8 - e.k // 8) <= 1 AND abs(w.k % 8 - e.k % 8) <= 1),
d AS (SELECT DISTINCT vec_id, k + 8 * dy + dx AS k FROM e, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) t(dy, dx) WHERE k // 8 + dy < 8 AND k % 8 + dx < 8)
SELECT m.vec_id, sum(CASE WHEN d.k IS NULL THEN 0 ELSE (k2 + 1) * 255 END)::BIGINT AS digest, count(d.k) / {_D(64)} AS density FROM (SELECT vec_id, unnest(range(64)) AS k2 FROM fx_maps) m LEFT JOIN d ON d.vec_id = m.vec_id AND d.k = k2 GROUP BY 1""")
def edge_map(v):
    """Edge maps of all maps; the digest weighs every cell by its place."""
    found = P.edge_maps(v.fx_maps.select("vec_id", F.col("map").alias("gray")), 8, 8)
    places = F.transform("edges", lambda e, k: e.cast("long") * (k + 1))
    return found.select("vec_id", F.aggregate(places, F.lit(0).cast("long"), lambda a, x: a + x).alias("digest"), "density")


@query("img_regions", """WITH RECURSIVE c AS (SELECT vec_id, k FROM (SELECT vec_id, unnest(map) AS x, unnest(range(64)) AS k FROM fx_maps) WHERE x > 150),
r AS (SELECT vec_id, k, k AS to_k FROM c UNION SELECT r.vec_id, r.k, c.k FROM r JOIN c ON c.vec_id = r.vec_id AND abs(c.k // 8 - r.to_k // 8) <= 1 AND abs(c.k % 8 - r.to_k % 8) <= 1),
l AS (SELECT vec_id, k, min(to_k) AS label FROM r GROUP BY 1, 2)
SELECT m.vec_id, list(coalesce(label, -1) ORDER BY m.k)::INT[] AS regions, count(DISTINCT label)::INT AS count FROM (SELECT vec_id, unnest(range(64)) AS k FROM fx_maps) m LEFT JOIN l ON l.vec_id = m.vec_id AND l.k = m.k GROUP BY 1""")
def regions(v):
    return P.region_labels(v.fx_maps.select("vec_id", F.transform("map", lambda x: (x > 150).cast("int")).alias("mask")), 8, 8)


def _overlap(at: str, start: str, length: str, j: str, n: int) -> str:
    """Length of cell `at` inside part j of n of an interval."""
    return f"greatest(0, least({at} + 1, {start} + {length} * ({j} + 1) / {_D(n)}) - greatest({at}, {start} + {length} * {j} / {_D(n)}))"


_SMALL = f"list_transform(range(15), lambda j: round(list_sum(list_transform(range(64), lambda k: map[k + 1] * {_overlap('(k % 8)', '0', '8', '(j % 5)', 5)} * {_overlap('(k // 8)', '0', '8', '(j // 5)', 3)})) / ({_D(64)} / 15), 6))"


@query("img_area_resize", f"SELECT vec_id, {_SMALL} AS small FROM fx_maps")
def area_resize(v):
    """8x8 maps on 3x5 cells: no factor is whole."""
    return P.resized(v.fx_maps.select("vec_id", F.col("map").alias("gray")), 8, 8, 3, 5).select("vec_id", F.transform("small", lambda x: F.round(x, 6)).alias("small"))


_CROP = f"list_transform(range(16), lambda j: CAST(round_even(list_sum(list_transform(range(64), lambda k: map[k + 1] * {_overlap('(k % 8)', 'x', 'w', '(j % 4)', 4)} * {_overlap('(k // 8)', 'y', 'h', '(j // 4)', 4)})) / (w / {_D(4)} * h / {_D(4)}), 0) AS INT))"
_EDGE = "list_transform({}, lambda q: greatest(q - 128, 0))"
_STEP = "list_transform(range(15), lambda k: abs({0}[k + 2] - {0}[k + 1]))"
_CUT = "list_filter(list_transform(range(len({0})), lambda k: CASE WHEN {0}[k + 1] IS NOT NULL AND (cells IS NULL OR list_contains(cells, k)) THEN {0}[k + 1] END), lambda q: q IS NOT NULL)"


@query("srch_anchor_window", f"""WITH n AS (SELECT count(*) AS n FROM fx_maps), crops(s, x, y, w, h) AS (VALUES (1, 0, 0, 8, 8), (2, 1, 2, 6, 6), (3, 3, -1, 5, 4)),
r AS (SELECT vec_id AS f, s, x, y, w, h, {_CROP} AS g FROM fx_maps, crops), vf AS (SELECT f, s, x, y, w, h, {_EDGE.format('g')} AS e, {_STEP.format('g')} AS d FROM r),
tm AS (SELECT vec_id AS t, {_EDGE.format('map[1:16]')} AS e, {_STEP.format('map')} AS d FROM fx_maps),
p AS (SELECT a.vec_id AS anchor, a.vec_id + dc AS candidate, dc AS distance, o, (a.vec_id + o + n) % n AS t, a.vec_id + dc + o AS f, CASE WHEN a.vec_id % 3 <> 0 THEN 2 + a.vec_id % 2 END AS tx FROM fx_maps a, n, (SELECT unnest(range(-1, 2)) AS dc), (SELECT unnest(range(-1, 2)) AS o) WHERE a.vec_id + dc - 1 >= 0 AND a.vec_id + dc + 1 < n),
q AS (SELECT p.*, vf.s, x, y, w, h, tm.e AS te, tm.d AS td, vf.e AS ve, vf.d AS vd, CASE WHEN tx IS NOT NULL THEN list_filter(range(16), lambda k: sqrt(pow(k % 4 - tx, 2) + pow(k // 4 - 2, 2)) <= 1.25 * {_D(1.22)}) END AS cells FROM p JOIN tm ON tm.t = p.t JOIN vf ON vf.f = p.f),
u AS (SELECT *, {_CUT.format('te')} AS te2, {_CUT.format('td')} AS td2, {_CUT.format('ve')} AS ve2, {_CUT.format('vd')} AS vd2 FROM q),
z AS (SELECT anchor, candidate, distance, o, s, x, y, w, h, tx, 2 AS ty, 1.25 AS tr, CASE WHEN f % 4 <> 0 THEN 4 END AS vx, 3 + f % 2 AS vy, 2.5 AS vr, round({_D(0.75)} * {_COS('te', 've')} + 0.25 * {_COS('td', 'vd')}, 9) AS fv, round({_D(0.75)} * {_COS('te2', 've2')} + 0.25 * {_COS('td2', 'vd2')}, 9) AS mv FROM u),
{_metrics_sql('z', 'anchor, candidate, distance, o, s, x, y, w, h, fv, mv').replace('640', '4').replace('512', '4')},
k AS (SELECT anchor, candidate, distance, o, s, fv, coalesce(pass, false) AS hard, round(({_D(0.65)} * coalesce(score, 0) + 0.25 * mv + {_D(0.1)} * fv) * CASE WHEN coalesce(pass, false) THEN 1 ELSE 0.25 END, 9) AS score FROM m),
v AS (SELECT anchor, candidate, s AS strategy, any_value(distance) AS distance, bool_or(hard) FILTER (o = 0) AS hard, max(score) FILTER (o = 0) AS center, min(score) AS least, round(avg(score), 9) AS aggregate, avg(fv) AS fm FROM k GROUP BY 1, 2, 3),
b AS (SELECT *, row_number() OVER (PARTITION BY anchor, candidate ORDER BY hard DESC, aggregate DESC, center DESC, least DESC, strategy) AS i FROM v)
SELECT anchor, candidate, CAST(strategy AS INT) AS strategy, hard AS hard_pass, round(aggregate, 6) AS aggregate, round(center, 6) AS center, round(fm, 6) AS full_visual_mean, CAST(row_number() OVER (PARTITION BY anchor ORDER BY hard DESC, aggregate DESC, center DESC, least DESC, abs(distance), candidate) AS INT) AS rank FROM b WHERE i = 1""")
def anchor_window(v):
    """Every map is a video frame and, in its first 16 cells, a thermal map; every frame is an anchor with three candidates,
    each with three crops, one of them across the border."""
    maps = v.fx_maps.select("vec_id", "map")
    n = maps.count()
    circle = lambda ok, *at: F.when(ok, F.struct(*[c.cast("double").alias(name) for c, name in zip(at, ("cx", "cy", "r"), strict=True)]))
    near = F.explode(F.array(*[F.lit(d) for d in (-1, 0, 1)]))
    candidates = maps.select(F.col("vec_id").alias("anchor"), F.lit("all").alias("sequence_id"), near.alias("distance"), F.lit(1.0).alias("fps"), F.lit(n).alias("frame_count")).withColumn("candidate", F.col("anchor") + F.col("distance"))
    shown = maps.withColumn("o", near).select(F.pmod(F.col("vec_id") - F.col("o"), F.lit(n)).alias("anchor"), "o", F.slice("map", 1, 16).alias("gray"))
    thermal = shown.withColumn("circle", circle(F.col("anchor") % 3 != 0, 2 + F.col("anchor") % 2, F.lit(2), F.lit(1.25)))
    crops = F.explode(F.array(*[F.struct(*[F.lit(x).alias(c) for c, x in zip(("strategy", *"xywh"), row, strict=True)]) for row in ((1, 0, 0, 8, 8), (2, 1, 2, 6, 6), (3, 3, -1, 5, 4))]))
    crops = candidates.select("anchor", "candidate", crops.alias("c")).select("anchor", "candidate", "c.*")
    f = F.col("vec_id")
    video = maps.select(F.lit("all").alias("sequence_id"), f.alias("frame_index"), F.col("map").alias("gray"), circle(f % 4 != 0, F.lit(4), 3 + f % 2, F.lit(2.5)).alias("circle"))
    found = S.anchor_search(candidates, thermal, crops, video, k=1, size=(4, 4), video_size=(8, 8), full=(4, 4), features=S.level_features, mask_least=4)
    return found.select("anchor", "candidate", "strategy", "hard_pass", *[F.round(c, 6).alias(c) for c in ("aggregate", "center", "full_visual_mean")], "rank")


_VOTES = """WITH c AS (SELECT vec_id, k FROM (SELECT vec_id, unnest(map) AS x, unnest(range(64)) AS k FROM fx_maps) WHERE x > 150), t AS (SELECT unnest(range(64)) AS k),
o AS (SELECT dy, dx, floor(sqrt(dy * dy + dx * dx) + 0.5)::INT AS r FROM (SELECT unnest(range(-4, 5)) AS dy), (SELECT unnest(range(-4, 5)) AS dx)), n AS (SELECT r, count(*) AS n FROM o WHERE r BETWEEN 2 AND 3 GROUP BY 1),
v AS (SELECT vec_id, r, c.k + 8 * dy + dx AS k, count(*) AS votes FROM c, o WHERE r BETWEEN 2 AND 3 AND c.k // 8 + dy BETWEEN 0 AND 7 AND c.k % 8 + dx BETWEEN 0 AND 7 GROUP BY ALL),
b AS (SELECT v.*, row_number() OVER (PARTITION BY vec_id ORDER BY votes / n::DOUBLE DESC, r, k) AS i FROM v JOIN n USING (r))
SELECT vec_id, sum(votes * (r * 64 + k))::BIGINT AS digest, max(k % 8) FILTER (i = 1)::DOUBLE AS cx, max(k // 8) FILTER (i = 1)::DOUBLE AS cy, max(r) FILTER (i = 1)::DOUBLE AS r, max(votes) FILTER (i = 1)::INT AS votes FROM b GROUP BY 1"""


@query("img_circle_votes", _VOTES)
def circle_votes(v):
    """Votes of all bright cells for circles of two and three cells' radius, and the best circle of each map."""
    edges = v.fx_maps.select("vec_id", F.transform("map", lambda x: (x > 150).cast("int")).alias("edges"))
    found = P.vote_circles(edges, 8, 8, (2, 3), least=0.0, apart=1, most=1)
    sums = P.vote_sums(edges, 8, 8, (2, 3)).where("total > 0")
    return sums.join(found, "vec_id").select("vec_id", F.col("total").alias("digest"), *[F.col(c)[0].alias(c) for c in ("cx", "cy", "r", "votes")])


@query("img_region_features", """WITH RECURSIVE c AS (SELECT vec_id, k FROM (SELECT vec_id, unnest(map) AS x, unnest(range(64)) AS k FROM fx_maps) WHERE x > 120),
r AS (SELECT vec_id, k, k AS to_k FROM c UNION SELECT r.vec_id, r.k, c.k FROM r JOIN c ON c.vec_id = r.vec_id AND abs(c.k // 8 - r.to_k // 8) <= 1 AND abs(c.k % 8 - r.to_k % 8) <= 1),
l AS (SELECT vec_id, k, min(to_k) AS label FROM r GROUP BY 1, 2) SELECT vec_id, label::INT AS label, count(*)::INT AS area FROM l GROUP BY 1, 2 HAVING count(*) >= 3""")
def region_features(v):
    """Regions of three cells and more; their boundaries and circles are compared with drawn shapes in the tests."""
    masks = v.fx_maps.select("vec_id", F.transform("map", lambda x: (x > 120).cast("int")).alias("mask"))
    found = P.region_features(masks, 8, 8, least_area=3)
    return found.select("vec_id", F.explode(F.arrays_zip("label", "area")).alias("z")).select("vec_id", "z.label", "z.area")
