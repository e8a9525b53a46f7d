"""File-fed streams and running a stream to a table.

A stream reads parquet files as they arrive (one file per micro-batch by
default) and writes its result to a parquet sink whose checkpoint holds the
offsets and the state store; a restart continues from the checkpoint.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.csv import scratch_path
from .operators import use_rocksdb


def file_stream(spark: SparkSession, path: str, max_files: int = 1) -> DataFrame:
    """Stream over a parquet folder (or one local parquet file)."""
    schema = spark.read.parquet(path).schema
    r = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(where) and fs.getFileStatus(where).isFile():
        base, name = os.path.dirname(path), os.path.basename(path)
        # a one-file glob keeps the file source happy (it wants a folder)
        return r.option("basePath", base).parquet(os.path.join(base, f"{name[:-1]}[{name[-1]}]"))
    return r.parquet(path)


def run_to_table(stream: DataFrame, name: str, path: str | None = None, checkpoint: str | None = None,
                 timeout_s: int | None = None) -> DataFrame:
    """Run the stream over everything available now, into a parquet sink,
    and return the sink as a batch table."""
    spark = stream.sparkSession
    use_rocksdb(spark)
    out = path or scratch_path(spark, name)
    ck = checkpoint or out + "_checkpoint"
    q = (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
         .outputMode("append").trigger(availableNow=True).start())
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"stream {name} did not end in {timeout_s} s; its sink is not complete")
    return spark.read.schema(stream.schema).parquet(out)


def run_stream(stream: DataFrame, name: str, path: str | None = None, checkpoint: str | None = None,
               timeout_s: int | None = None) -> tuple[DataFrame, int]:
    """Like :func:`run_to_table`, and also the number of rows marked late
    (behind the watermark, not applied to the state)."""
    table = run_to_table(stream, name, path, checkpoint, timeout_s)
    if "late" not in table.columns:
        return table, 0
    return table.where(~F.col("late")), table.where(F.col("late")).count()
