"""Circles, crops and scores as column functions.  A circle is a struct with cx, cy, r."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from framespan import constants as C


def crop_matrix(x: Column, y: Column, w: Column, h: Column, out_w: Column, out_h: Column) -> Column:
    """2x3 matrix that maps a crop to the output grid."""
    sx, sy = out_w / w, out_h / h
    zero = F.lit(0.0)
    return F.array(F.array(sx, zero, -x * sx), F.array(zero, sy, -y * sy))


def compose_affine(outer: Column, inner: Column) -> Column:
    """outer after inner, both 2x3."""

    def cell(i: int, j: int) -> Column:
        value = outer[i][0] * inner[0][j] + outer[i][1] * inner[1][j]
        return value + outer[i][2] if j == 2 else value

    return F.array(*[F.array(*[cell(i, j) for j in range(3)]) for i in range(2)])


def map_circle(x: Column, y: Column, w: Column, h: Column, out_w: Column, out_h: Column, circle: Column) -> Column:
    """A video circle on the output grid, with both radii; null without circle or with an empty crop."""
    rx, ry = circle["r"] * out_w / w, circle["r"] * out_h / h
    mapped = F.struct(((circle["cx"] - x) * out_w / w).alias("cx"), ((circle["cy"] - y) * out_h / h).alias("cy"), (0.5 * (rx + ry)).alias("r"), rx.alias("rx"), ry.alias("ry"))
    return F.when(circle.isNotNull() & (w > 0) & (h > 0), mapped)


def scale_circle(circle: Column, w: Column, h: Column, to_w: Column, to_h: Column) -> Column:
    sx, sy = to_w / w, to_h / h
    scaled = F.struct((circle["cx"] * sx).alias("cx"), (circle["cy"] * sy).alias("cy"), (circle["r"] * 0.5 * (sx + sy)).alias("r"))
    return F.when(circle.isNotNull() & (w > 0) & (h > 0), scaled)


def partial(cx: Column, cy: Column, r: Column, width: Column, height: Column, margin: float = 2.0) -> Column:
    """Whether a circle touches the border."""
    return (cx - r <= margin) | (cy - r <= margin) | (cx + r >= width - margin) | (cy + r >= height - margin)


def pad_metrics(thermal: Column, mapped: Column) -> Column:
    """Errors, scores and hard pass of a mapped video circle against a thermal circle; defaults when one is missing."""
    own = F.greatest(thermal["r"], F.lit(1.0))
    error = F.sqrt(F.pow(mapped["cx"] - thermal["cx"], 2) + F.pow(mapped["cy"] - thermal["cy"], 2))
    center, radius = error / own, F.abs(mapped["r"] - thermal["r"]) / own
    anisotropy = F.abs(mapped["rx"] - mapped["ry"]) / F.greatest(mapped["r"], F.lit(1.0))

    def bell(value: Column, width: float) -> Column:
        return F.exp(-(value / width) * (value / width))

    scores = {"center": bell(center, C.CENTER_WIDTH), "radius": bell(radius, C.RADIUS_WIDTH), "anisotropy": bell(anisotropy, C.ANISOTROPY_WIDTH)}
    scores["ring"] = scores["center"] * scores["radius"]
    total = sum((weight * scores[k] for k, weight in C.GEOMETRY_WEIGHTS.items()), F.lit(0.0))
    passed = (center <= C.CENTER_LIMIT) & (radius <= C.RADIUS_LIMIT) & (anisotropy <= C.ANISOTROPY_LIMIT)
    full = F.struct(error.alias("center_error_px"), center.alias("center_ratio"), radius.alias("radius_ratio"), anisotropy.alias("anisotropy"), scores["ring"].alias("ring_iou"), total.alias("geometry_score"), passed.alias("hard_pass"))
    missing = F.struct(F.lit(float("inf")).alias("center_error_px"), *[F.lit(1.0).alias(n) for n in ("center_ratio", "radius_ratio", "anisotropy")], F.lit(0.0).alias("ring_iou"), F.lit(0.0).alias("geometry_score"), F.lit(False).alias("hard_pass"))
    return F.when(thermal.isNotNull() & mapped.isNotNull() & (thermal["r"] > 0), full).otherwise(missing)


def composite(geometry: Column, masked: Column, full: Column, hard_pass: Column) -> Column:
    w = C.COMPOSITE_WEIGHTS
    score = w["geometry"] * geometry + w["masked"] * masked + w["full"] * full
    return F.when(hard_pass, score).otherwise(score * C.NO_PASS_FACTOR)


def thermal_circle_score(support: Column, coverage: Column, prominence: Column, contrast: Column, border: Column, radius_ratio: Column) -> tuple[Column, Column]:
    """Radius prior and score of a thermal circle from its measured features."""
    middle, width = C.RADIUS_PRIOR
    prior = F.exp(-F.pow((radius_ratio - middle) / width, 2))
    parts = {"support": support, "coverage": coverage, "prominence": prominence, "contrast": contrast, "prior": prior, "border": border}
    score = sum((w * parts[k] for k, w in C.THERMAL_WEIGHTS.items()), F.lit(0.0))
    score = F.when(radius_ratio > C.LARGE_RADIUS, score * C.LARGE_FACTOR).otherwise(score)
    return prior, F.when((radius_ratio > C.FLAT_RADIUS) & (prominence < C.FLAT_PROMINENCE), score * C.FLAT_FACTOR).otherwise(score)


def contour_circle_score(radius: Column, least_side: Column, circularity: Column, support: Column, area_ratio: Column, is_partial: Column, is_arc: Column) -> Column:
    """Score of a circle found as a colour contour."""
    one = F.lit(1.0)
    parts = {
        "size": F.least(one, radius / F.greatest(least_side * C.CONTOUR_SIDE, one)), "circularity": F.greatest(F.lit(0.0), F.least(circularity, one)),
        "support": support, "area": F.least(one, area_ratio / F.when(is_partial, C.PARTIAL_FILL).otherwise(C.CONTOUR_FILL)),
    }
    return sum((w * parts[k] for k, w in C.CONTOUR_WEIGHTS.items()), F.lit(0.0)) + F.when(is_arc & is_partial, C.ARC_BONUS).otherwise(0.0)


def hough_confidence(support: Column, fill: Column, is_partial: Column) -> Column:
    share = lambda c, w: w[0] * F.least(F.lit(1.0), c / w[1])
    return C.HOUGH_BASE + share(support, C.HOUGH_SUPPORT) + share(fill, C.HOUGH_FILL) - F.when(is_partial, C.HOUGH_PARTIAL).otherwise(0.0)


def track_cost(cx: Column, cy: Column, r: Column, confidence: Column, is_hough: Column, is_partial: Column, seed: Column) -> tuple[Column, Column, Column]:
    """Cost, center ratio and radius log error of a candidate against a predicted circle."""
    own, w = F.greatest(seed["r"], F.lit(C.LEAST_SCALE)), C.COST_WEIGHTS
    center = F.sqrt(F.pow(cx - seed["cx"], 2) + F.pow(cy - seed["cy"], 2)) / own
    radius = F.abs(F.log(F.greatest(r, F.lit(1.0)) / own))
    cost = w["center"] * center + w["radius"] * radius + w["doubt"] * (1.0 - confidence) + F.when(is_hough, 0.0).otherwise(w["no_hough"]) + F.when(is_partial, w["partial"]).otherwise(0.0)
    return cost, center, radius
