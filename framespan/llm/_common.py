"""Helpers shared by the text operators: session settings, tables, and column let-bindings."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word is a maximal run of characters other than the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
#: The six blanks, for translate().
BLANKS = " \t\n\x0b\x0c\r"


#: a table of fewer bytes in fewer files than cores is dealt to all cores when it is read
SPREAD_BYTES = 256 << 20


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents; a small table in one file or few, which Spark would read in one task, is dealt to all cores."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    cores = spark.sparkContext.defaultParallelism
    if len(docs.inputFiles()) < cores:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/documents.parquet")
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(path).getLength() < SPREAD_BYTES:
            return docs.repartition(cores)
    return docs


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster shares: spark.checkpoint.dir, or the checkpoint folder set on the context."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    found = spark.sparkContext._jsc.sc().getCheckpointDir()
    if not folder:
        if not found.isDefined():
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        return found.get()
    if not found.isDefined():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the shared folder; survives lost executors.  For small tables: Spark deletes checkpoints only where
    spark.cleaner.referenceTracking.cleanCheckpoints is set."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Write as a Parquet table in the shared folder and read it back, so that later scans prune columns.

    The table stays until `discard`; what a returned, lazy result reads must stay."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/framespan-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete written tables once all that was made of them is written too."""
    for table in tables:
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table.written_to)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def ranked(rows: DataFrame, *keys: Column | str, name: str) -> DataFrame:
    """Adds the rank of every row in the order of keys, from 1; the rows are sorted in the shared folder by ranges.

    Ranks inside a range plus the number of rows before it: no task holds more than a range, and a hot key is split where
    a later key differs.  The offsets have one row a partition."""
    part = free_name(rows, "range_no")
    ranged = written(rows.repartitionByRange(*keys).withColumn(part, F.spark_partition_id()))
    counts = ranged.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    before, own = free_name(ranged, "before"), free_name(ranged, "range_of")
    offsets = counts.select(F.col(part).alias(own), (F.sum("n").over(Window.orderBy(part)) - F.col("n")).alias(before))
    place = F.row_number().over(Window.partitionBy(part).orderBy(*keys))
    return ranged.join(F.broadcast(offsets), F.col(part) == F.col(own)).withColumn(name, F.col(before) + place).drop(part, own, before)


#: ids and hashes that are sent to every task; more are joined by shuffle
BROADCAST_ROWS = 1_000_000


def text_hash() -> Column:
    """Tells rows with one doc_id and different texts apart."""
    return F.xxhash64("text")


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return name


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of docs, with all columns, whose doc_id and hash of the text are not in gone (doc_id, th)."""
    own, other = free_name(docs, "gone_id"), free_name(docs, "gone_th")
    gone = written(gone.select(F.col("doc_id").alias(own), F.col("th").alias(other)).distinct())
    few = gone.count() <= BROADCAST_ROWS
    return docs.join(F.broadcast(gone) if few else gone, (F.col("doc_id") == F.col(own)) & (text_hash() == F.col(other)), "left_anti")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value evaluated once a row, also when body uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def remainder(doc_id: Column | str, modulus: int) -> Column:
    """crc32 of the id as text, modulo: the folds that the queries hold out."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(modulus)).cast("int")
