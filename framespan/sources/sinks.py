"""Tables as files, in the forms of the release."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framespan.sources.ranged import located


def scalar_columns(rows: DataFrame) -> list[str]:
    return [f.name for f in rows.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]


def write_both(rows: DataFrame, folder: str) -> None:
    """CSV of the columns that are not nested, JSON lines of all."""
    rows.select(*scalar_columns(rows)).write.mode("overwrite").option("header", "true").csv(f"{folder}/csv")
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{folder}/jsonl")


def union_rows(*parts: DataFrame) -> DataFrame:
    """Rows with different fields: their union in the order first seen, empty text for what is missing."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in whole.columns])


def stats_text(rows: DataFrame) -> DataFrame:
    """Doubles with nine places of their exact value, half-even; other columns as they are.

    Spark's and Java's forms round the shortest decimal that gives the double back, which has other digits from about
    10,000,000 on."""
    doubles = [c for c, kind in rows.dtypes if kind in ("double", "float")]
    schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name in doubles else f for f in rows.schema.fields])

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            texts = lambda values: pa.array([None if x is None else f"{x:.9f}" for x in values.to_pylist()], pa.string())
            columns = [texts(values) if name in doubles else values for name, values in zip(batch.schema.names, batch.columns, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return rows.mapInArrow(batches, schema)


def write_viewer(rows: DataFrame, folder: str, order: list[str], sort: list[str]) -> None:
    """JSON lines with the fields in a fixed order, nulls written."""
    rows.orderBy(*sort).select(*order).write.mode("overwrite").option("ignoreNullFields", "false").json(folder)


def write_files(rows: DataFrame) -> DataFrame:
    """Writes content to path for every row, a file each, and gives path and length of what was written.

    A task writes a file under a name of its own beside the place and then renames it into it, so readers see whole files
    only; a task that is killed and repeated, or runs twice, leaves one file.  The folders must be on a shared store."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            paths, sizes = batch.column(0).to_pylist(), []
            for path, content in zip(paths, batch.column(1), strict=True):
                data = content.as_py()
                put_file(path, data)
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], names=["path", "length"])

    return rows.select("path", F.col("content").cast("binary").alias("content")).mapInArrow(batches, "path string, length long")


def put_file(path: str, data: bytes) -> None:
    system, place = located(path)
    folder, name = place.rsplit("/", 1)
    system.create_dir(folder, recursive=True)
    own = f"{folder}/.{name}.{uuid.uuid4().hex}.tmp"
    try:
        with system.open_output_stream(own) as out:
            out.write(data)
        system.move(own, place)
    finally:
        if system.get_file_info(own).type != fs.FileType.NotFound:
            system.delete_file(own)


def write_ordered(rows: DataFrame, line: Column, order: list[str], folder: str) -> None:
    """Lines in text files that, read in the order of their names, are one list sorted by `order`.

    Rows are dealt by ranges of the order and sorted in each, so no task holds the list; files are numbered as the ranges."""
    value, names = "line", [f"k{k}" for k in range(len(order))]
    keyed = rows.select(line.alias(value), *[F.col(c).alias(n) for c, n in zip(order, names, strict=True)])
    keyed.repartitionByRange(*names).sortWithinPartitions(*names).select(value).write.mode("overwrite").text(folder)


def write_checksums(entries: DataFrame, folder: str) -> None:
    """`<digest>  <path>` lines sorted by path."""
    write_ordered(entries, F.concat_ws("  ", "digest", "path"), ["path"], folder)
