"""Ranking with explicit tie-breakers, and scores of windows of neighbouring frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framespan.constants import MOST_CROPS
from framespan.functions.timeparse import offset_label


def best_rows(rows: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first n rows of each key in the order, numbered in `rank`."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= n)


def window_scores(scores: DataFrame, keys: list[str], k: int) -> DataFrame:
    """Mean, median and centre-weighted mean of the scores of a window (o, score); the weight is k + 1 - |o|."""
    weight = k + 1 - F.abs("o")
    return scores.groupBy(*keys).agg(F.avg("score").alias("mean"), F.median("score").alias("median"), (F.sum(F.col("score") * weight) / F.sum(weight)).alias("weighted"), F.count(F.lit(1)).alias("n"))


def window_rows(scores: DataFrame, keys: list[str], k: int, means: tuple[str, ...] = ()) -> DataFrame:
    """One row a window: hard pass and score of the centre (least |o|, first), least and mean score, the means of other
    scores (pad geometry, masked and full visual similarity), a column an offset."""
    center = F.min_by(F.struct("hard_pass", "score"), F.struct(F.abs("o"), "o"))
    named = scores.withColumn("label", offset_label(F.col("o")))
    labels = [f"score_tiff_{'m' if o < 0 else 'p'}{abs(o)}" for o in range(-k, k + 1)]
    wide = named.groupBy(*keys).pivot("label", labels).agg(F.first("score"))
    others = [f"{m}_mean" for m in means]
    own = scores.groupBy(*keys).agg(center.alias("c"), F.min("score").alias("least"), F.avg("score").alias("mean"), *[F.avg(m).alias(name) for m, name in zip(means, others, strict=True)])
    return own.join(wide, keys).select(*keys, F.col("c.hard_pass").alias("hard_pass"), F.col("c.score").alias("center"), "least", "mean", *others, *labels)


def _window_order(*ties: str) -> list[Column]:
    """Hard pass, aggregate, centre and least score, descending, distance from the anchor, then the ties in order."""
    return [F.col("hard_pass").cast("int").desc(), F.desc("aggregate"), F.desc("center"), F.desc("least"), F.abs("distance").asc(), *map(F.asc, ties)]


def rank_candidates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rank by hard pass, aggregate, centre and least score descending, distance from the anchor, search order."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*_window_order("search_order"))))


def best_strategies(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The best crop strategy of each candidate frame: window rows compared as candidates are, the first strategy on ties."""
    return best_rows(rows, keys, _window_order("strategy"))


def window_summary(rows: DataFrame, key: str, index: str) -> DataFrame:
    """Number of candidates, first and last index of each key."""
    return rows.groupBy(key).agg(F.countDistinct(index).alias("candidates"), F.min(index).alias("first"), F.max(index).alias("last"))


def diversify(rows: DataFrame, key: str, limit: int = MOST_CROPS) -> DataFrame:
    """At most `limit` rows a key, taken in turn from its groups (group, score, seq_no in score order).

    Groups come in the order of their first row's score; a key with `limit` rows or fewer keeps all."""
    own = Window.partitionBy(key)
    inside = Window.partitionBy(key, "group").orderBy("seq_no")
    turned = rows.withColumn("_round", F.row_number().over(inside)).withColumn("_first", F.first("score").over(inside)).withColumn("_seen", F.first("seq_no").over(inside)).withColumn("_all", F.count(F.lit(1)).over(own))
    taken = turned.withColumn("_turn", F.row_number().over(own.orderBy("_round", F.desc("_first"), "_seen")))
    kept = taken.where((F.col("_all") <= limit) | (F.col("_turn") <= limit))
    final = F.when(F.col("_all") <= limit, F.lit(0.0)).otherwise(-F.col("score"))
    return kept.withColumn("place", F.row_number().over(own.orderBy(final, F.when(F.col("_all") <= limit, F.col("seq_no")).otherwise(F.col("_turn"))))).drop("_round", "_first", "_seen", "_all", "_turn")


def least_alignment(rows: DataFrame, key: str, least: float = 0.5) -> DataFrame:
    """Rows whose alignment reaches the bound; a key without any keeps all its rows, flagged as fallback."""
    good = F.col("alignment") >= least
    some = F.max(good.cast("int")).over(Window.partitionBy(key))
    return rows.withColumn("_some", some).where(good | (F.col("_some") == 0)).withColumn("fallback", F.col("_some") == 0).drop("_some")


def first_seen(rows: DataFrame, columns: list[str], seq: str = "seq_no") -> DataFrame:
    """Distinct values with the place where each came first."""
    return rows.groupBy(*columns).agg(F.min(seq).alias(seq))
