"""Sharding along a Hilbert curve.

Several metadata dimensions are quantised to cells in the order of their values, each row gets the index of its cell on a Hilbert curve, rows
are ordered by that index and the order is cut into runs.  Rows near each other in all dimensions share a shard, so
a file's minima and maxima of each dimension stay narrow and readers can skip files on any of them.

Only built-in Spark expressions are used.  The global rank comes from a range partitioning on
(index, doc_id, checksum, size): ranks inside a partition plus the partition's offset; no stage holds all rows in one
task, and a hot cell is spread over partitions because doc_id is part of the sort key.

Defined cases: a null text has size 8 and checksum 0; null dimensions fall in cell 0; very long texts are
read for size and checksum alone; rows in one cell of the curve are in the order of doc_id, checksum and size, and rows
repeated in full get ranks of their own; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framespan.llm._common import BROADCAST_ROWS, cut, free_name, ranked, read_documents

SHARDS = 24
BITS = 5


def hilbert_index(cells: list[Column], bits: int) -> Column:
    """Index of an n-dimensional cell on the Hilbert curve of 2**bits cells a side (Skilling's transform).

    The two passes of the transform run as folds over arrays, so the expression has a constant size.
    """
    n = len(cells)
    axes = F.array(*[c.cast("int") for c in cells])
    steps = F.array(*[F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, 0, -1) for i in range(n)])

    def undo(x: Column, step: Column) -> Column:
        q, i = step["q"], step["i"]
        xi = F.element_at(x, i + 1)
        low = q - 1
        exchange = x[0].bitwiseXOR(xi).bitwiseAND(low)
        is_set = xi.bitwiseAND(q) != 0
        first = F.when(is_set, x[0].bitwiseXOR(low)).otherwise(x[0].bitwiseXOR(exchange))
        other = F.when(is_set, xi).otherwise(xi.bitwiseXOR(exchange))
        return F.transform(x, lambda v, k: F.when(k == 0, first).when(k == i, other).otherwise(v))

    undone = F.aggregate(steps, axes, undo) if bits > 1 else axes
    # Gray code: each axis takes the exclusive or of all axes up to it.
    gray = F.aggregate(
        undone,
        F.array().cast("array<int>"),
        lambda done, v: F.concat(done, F.array(F.when(F.size(done) == 0, v).otherwise(v.bitwiseXOR(F.element_at(done, F.greatest(F.size(done), F.lit(1))))))),
    )
    flips = F.array(*[F.lit(1 << b) for b in range(bits - 1, 0, -1)]) if bits > 1 else F.array().cast("array<int>")
    folded = F.transform(
        F.array(gray),
        lambda g: F.transform(
            F.array(F.aggregate(flips, F.lit(0), lambda t, q: F.when(g[n - 1].bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t))),
            lambda t: F.transform(g, lambda v: v.bitwiseXOR(t)),
        )[0],
    )[0]
    places = F.array(*[F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, -1, -1) for i in range(n)])
    return F.transform(
        F.array(folded),
        lambda x: F.aggregate(places, F.lit(0).cast("long"), lambda d, p: d * 2 + F.when(F.element_at(x, p["i"] + 1).bitwiseAND(p["q"]) != 0, 1).otherwise(0).cast("long")),
    )[0]


def value_cells(rows: DataFrame, column: str, bits: int) -> tuple[DataFrame, int]:
    """value and cell of the distinct values of a column, and their number: cells 1 to 2**bits - 1 in the order of the values,
    as many values in each as in the others, so that a shard's least and greatest value tell which values it can hold."""
    ranks = ranked(rows.where(F.col(column).isNotNull()).select(F.col(column).alias("value")).distinct(), "value", name="rank")
    n = ranks.count()
    return ranks.select("value", F.expr(f"1 + ((rank - 1) * {(1 << bits) - 1}) div {max(n, 1)}").cast("int").alias("cell")), n


def with_cell(rows: DataFrame, column: str, name: str, bits: int) -> DataFrame:
    """Adds the cell of a column's value under a name; 0 for null."""
    cells, n = value_cells(rows, column, bits)
    value, cell = free_name(rows, "value"), free_name(rows, "cell")
    cells = cells.select(F.col("value").alias(value), F.col("cell").alias(cell))
    joined = rows.join(F.broadcast(cells) if n <= BROADCAST_ROWS else cells, F.col(column) == F.col(value), "left")
    return joined.withColumn(name, F.coalesce(cell, F.lit(0))).drop(value, cell)


def size_cell(size: Column, bits: int) -> Column:
    """Cell of a size on a logarithmic scale: two cells an octave from 8 bytes on, the last cell open."""
    octaves = F.floor(2 * F.log2(F.greatest(size, F.lit(8)).cast("double")) - 6)
    return F.least(F.lit((1 << bits) - 1), octaves).cast("int")


def curve_order(rows: DataFrame, index: str, ties: list[str], *, shards: int) -> DataFrame:
    """Adds shard and slot: rank by (index, ties), cut into `shards` runs whose counts differ by one at most."""
    keys = [index, *ties]
    ranged = cut(rows.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()))
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    running = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # one row a partition: bounded by the number of shuffle partitions
    offsets = counts.select("_part", (F.sum("_rows").over(running) - F.col("_rows")).alias("_before"), F.sum("_rows").over(Window.partitionBy()).alias("_all"))
    ranked = ranged.join(F.broadcast(offsets), "_part").withColumn("_rank", F.col("_before") + F.row_number().over(Window.partitionBy("_part").orderBy(*keys)) - 1)
    shard = F.expr(f"(_rank * {shards}) div _all")
    first = F.expr(f"(((_rank * {shards}) div _all) * _all + {shards - 1}) div {shards}")
    return ranked.withColumn("shard", shard.cast("int")).withColumn("slot", (F.col("_rank") - first).cast("long")).drop("_part", "_before", "_all", "_rank")


def shard_documents(docs: DataFrame, *, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """doc_id, size, text_crc32, hilbert, shard and slot of every document under the law `rows`."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8
    narrow = docs.select("doc_id", size.alias("size"), F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"), "source", "lang")
    narrow = with_cell(with_cell(narrow, "source", "_s", bits), "lang", "_l", bits)
    narrow = narrow.select("doc_id", "size", "text_crc32", hilbert_index([F.col("_s"), F.col("_l"), size_cell(F.col("size"), bits)], bits).alias("hilbert"))
    return curve_order(narrow, "hilbert", ["doc_id", "text_crc32", "size"], shards=shards)


def shard_manifest(sharded: DataFrame, dims: list[str]) -> DataFrame:
    """Per shard: rows, bytes and the least and largest value of each dimension, for skipping files."""
    return sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"), *[f(d).alias(f"{n}_{d}") for d in dims for n, f in (("min", F.min), ("max", F.max))])


def op8_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_documents(read_documents(spark, sf_dir))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "hilbert")


#: the checksum byte by byte from its table, the curve by Skilling's steps for every cell that occurs
ORACLE_SQL = """
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
), texts AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text, source, lang FROM documents
), parts AS (
  SELECT row_id, 't' AS part, text AS value FROM texts
), cells AS (
  SELECT part, value, 1 + (row_number() OVER (PARTITION BY part ORDER BY value) - 1) * 31 // count(*) OVER (PARTITION BY part) AS c
  FROM (SELECT DISTINCT 's' AS part, source AS value FROM texts WHERE source IS NOT NULL UNION ALL SELECT DISTINCT 'l', lang FROM texts WHERE lang IS NOT NULL)
), sums AS (
  SELECT row_id, part, xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(value)), '..'), lambda p: CAST('0x' || p AS BIGINT))), lambda c, x: xor(c >> 8, crc[xor(c & 255, x) + 1])), 4294967295)::BIGINT AS c
  FROM parts, tab WHERE value IS NOT NULL
), rows AS (
  SELECT doc_id, octet_length(encode(text))::BIGINT + 8 AS size, t.c AS text_crc32, coalesce(s.c, 0)::INT AS a, coalesce(l.c, 0)::INT AS b,
         least(31, floor(2 * log2(octet_length(encode(text)) + 8) - 6))::INT AS z
  FROM texts JOIN sums t ON t.row_id = texts.row_id AND t.part = 't' LEFT JOIN cells s ON s.value = texts.source AND s.part = 's' LEFT JOIN cells l ON l.value = texts.lang AND l.part = 'l'
), undo AS (
  SELECT a, b, z, 0 AS k, a AS x0, b AS x1, z AS x2 FROM (SELECT DISTINCT a, b, z FROM rows)
  UNION ALL
  SELECT a, b, z, k + 1, CASE WHEN xi & q <> 0 THEN xor(x0, q - 1) ELSE xor(x0, xor(x0, xi) & (q - 1)) END,
         CASE WHEN k % 3 = 1 AND xi & q = 0 THEN xor(x1, xor(x0, xi) & (q - 1)) ELSE x1 END, CASE WHEN k % 3 = 2 AND xi & q = 0 THEN xor(x2, xor(x0, xi) & (q - 1)) ELSE x2 END
  FROM (SELECT *, 16 >> (k // 3) AS q, CASE k % 3 WHEN 0 THEN x0 WHEN 1 THEN x1 ELSE x2 END AS xi FROM undo WHERE k < 12)
), gray AS (
  SELECT a, b, z, x0 AS y0, xor(x0, x1) AS y1, xor(xor(x0, x1), x2) AS y2 FROM undo WHERE k = 12
), flipped AS (
  SELECT a, b, z, xor(y0, t) AS y0, xor(y1, t) AS y1, xor(y2, t) AS y2
  FROM (SELECT *, xor(xor(CASE WHEN y2 & 16 <> 0 THEN 15 ELSE 0 END, CASE WHEN y2 & 8 <> 0 THEN 7 ELSE 0 END), xor(CASE WHEN y2 & 4 <> 0 THEN 3 ELSE 0 END, CASE WHEN y2 & 2 <> 0 THEN 1 ELSE 0 END)) AS t FROM gray)
), curve AS (
  SELECT a, b, z, list_sum(list_transform(range(5), lambda p: (((y0 >> p) & 1) << (3 * p + 2)) + (((y1 >> p) & 1) << (3 * p + 1)) + (((y2 >> p) & 1) << (3 * p))))::BIGINT AS hilbert FROM flipped
), ranked AS (
  SELECT doc_id, size, text_crc32, hilbert, row_number() OVER (ORDER BY hilbert, doc_id, text_crc32, size) - 1 AS r, count(*) OVER () AS n FROM rows JOIN curve USING (a, b, z)
)
SELECT doc_id, size, text_crc32, 'rows' AS law, (r * 24 // n)::INT AS shard, (r - ((r * 24 // n) * n + 23) // 24)::BIGINT AS slot, CAST(NULL AS INT) AS grown_shard, hilbert FROM ranked
"""
