"""Driver loops of DataFrame joins (survey kind I).

Each round is a set of joins and aggregates over the whole table.  Its result
is written as Parquet to the shared folder named by ``spark.checkpoint.dir``
and read back, which cuts the lineage, survives lost executors, and keeps the
optimizer's size estimate at the size of the files: a table that was only
checkpointed keeps the estimate of the plan that made it, which squares with
every round that joins the last result with itself.  Stop tests are counts.
Loops end by their own progress (labels that only fall, frontiers that empty,
edges that contract); only doublings, which need 64 rounds at most, have a cap
that raises.

Tables that a loop no longer needs are deleted by :func:`discard`; whatever is
left goes when the application ends.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir

_MARKED: set[str] = set()


def _path(spark: SparkSession, name: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def scratch_folder(spark: SparkSession) -> str:
    """Folder of this application's tables under the shared checkpoint folder;
    deleted when the application ends."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables-{spark.sparkContext.applicationId}"
    if folder not in _MARKED:
        fs, path = _path(spark, folder)
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _MARKED.add(folder)
    return folder


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._table_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete the files of tables that :func:`materialize` returned and that
    nothing will read again."""
    for f in frames:
        name = getattr(f, "_table_path", None)
        if name:
            fs, path = _path(f.sparkSession, name)
            fs.delete(path, True)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union of per-round results (each already a leaf), built once at the end
    instead of rewriting the growing union every round."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


class RoundCapReached(RuntimeError):
    pass


def check_cap(rounds: int, cap: int, what: str) -> None:
    if rounds >= cap:
        raise RoundCapReached(f"{what}: no fixed point after {cap} rounds")
