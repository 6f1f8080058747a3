"""Ordered work on keys with very many rows: range partitions, and what one partition needs of the others.

A window over (key, time) puts a whole key into one task.  Beyond ONE_TASK rows of a key the rows are dealt by ranges of
(key, time) instead; a small table with one row for each partition and key carries counts, last and first values from
one range to the next."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framespan.sources.shared import fresh_folder

#: rows of one key that a task sorts alone
ONE_TASK = 5_000_000


def has_large_key(rows: DataFrame, key: str, most: int) -> bool:
    """Counts the rows of each key: a job of its own over one column.  most=0 says that there is one, without a count,
    and math.inf that there is none."""
    if not 0 < most < math.inf:
        return not most
    largest = rows.groupBy(key).count().agg(F.max("count")).first()[0]
    return (largest or 0) > most


def ranged(rows: DataFrame, *order: str) -> DataFrame:
    """The rows with _part, their range partition; written to the shared folder, so that every later read sees the same
    ranges, also after the loss of executors."""
    spark = rows.sparkSession
    path = fresh_folder(spark, "ranges")
    placed = rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    placed.write.parquet(path)
    return spark.read.schema(placed.schema).parquet(path)


def place(rows: DataFrame, key: str, order: list[str], *, most: int = ONE_TASK) -> DataFrame:
    """Adds place, the number of each row in its key's order, from 1."""
    own = Window.partitionBy(key).orderBy(*order)
    if not has_large_key(rows, key, most):
        return rows.withColumn("place", F.row_number().over(own).cast("long"))
    parts = ranged(rows, key, *order)
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    offsets = parts.groupBy("_part", key).agg(F.count(F.lit(1)).alias("_n")).select("_part", key, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part", key).orderBy(*order))
    return parts.join(offsets, ["_part", key]).withColumn("place", F.col("_before") + inside).drop("_part", "_before")


def before_and_after(rows: DataFrame, key: str, order: list[str], value: Column, *, most: int = ONE_TASK) -> DataFrame:
    """Adds before and after: the last value that is not null up to the row in its key's order, and the first from it on.

    What comes after is found in the reversed order: a frame that reaches to the end of its key is walked anew for every row."""
    back, ahead = Window.unboundedPreceding, Window.unboundedFollowing

    def nearest(frame: DataFrame, keys: list[str]) -> DataFrame:
        own = Window.partitionBy(*keys)
        up, down = own.orderBy(*map(F.asc, order)), own.orderBy(*map(F.desc, order))
        return frame.withColumn("before", F.last(value, True).over(up.rowsBetween(back, 0))).withColumn("after", F.last(value, True).over(down.rowsBetween(back, 0)))

    if not has_large_key(rows, key, most):
        return nearest(rows, [key])
    parts = ranged(rows, key, *order)
    place_of = F.struct(*order)
    ends = parts.groupBy("_part", key).agg(F.max_by(value, F.when(value.isNotNull(), place_of)).alias("_last"), F.min_by(value, F.when(value.isNotNull(), place_of)).alias("_first"))
    over = Window.partitionBy(key).orderBy("_part")  # a row a partition
    carried = ends.select("_part", key, F.last("_last", True).over(over.rowsBetween(back, -1)).alias("_b"), F.first("_first", True).over(over.rowsBetween(1, ahead)).alias("_a"))
    found = nearest(parts, ["_part", key]).join(carried, ["_part", key])
    return found.withColumns({"before": F.coalesce("before", "_b"), "after": F.coalesce("after", "_a")}).drop("_part", "_b", "_a")
