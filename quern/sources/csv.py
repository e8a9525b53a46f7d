"""CSV source and sink (survey 2.1).

The source reads a header row as is, takes an explicit schema (every field is
text until cast), accepts a UTF-8 byte-order mark and keeps malformed lines
in a corrupt-record column instead of failing.  The sink writes a header and
one line per row; the order of lines follows an explicit order column when
one is given (a directory of part files, one per task).
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             corrupt_column: str | None = None) -> DataFrame:
    # Quoted fields may hold line breaks, and a quote inside one is doubled.
    r = (spark.read.option("header", True).option("encoding", "UTF-8").option("mode", "PERMISSIVE")
         .option("multiLine", True).option("quote", '"').option("escape", '"'))
    if corrupt_column:
        r = r.option("columnNameOfCorruptRecord", corrupt_column)
        if schema is None:
            schema = T.StructType([T.StructField(f.name, T.StringType()) for f in r.csv(path).schema])
        elif isinstance(schema, str):
            schema = T._parse_datatype_string(schema)
        if corrupt_column not in schema.names:
            schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
    if schema is not None:
        r = r.schema(schema)
    df = r.csv(path)
    first = df.columns[0] if df.columns else None
    if first and first.startswith("﻿"):
        df = df.withColumnRenamed(first, first.lstrip("﻿"))
    return df


def write_csv(df: DataFrame, path: str, order: str | None = None, mode: str = "overwrite") -> str:
    """Write ``df`` with a header; with ``order`` the files hold rows in that
    order (range-partitioned sort, part files in order)."""
    out = df.orderBy(order) if order else df
    out.write.mode(mode).option("header", True).option("escape", '"').csv(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory (never a
    machine-local temporary folder on a cluster)."""
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


def all_text_schema(df: DataFrame) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in df.columns])


def round_trip(df: DataFrame, name: str = "csv") -> DataFrame:
    """Write ``df`` as CSV in a scratch folder and read it back as text columns."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    write_csv(df.select(*[F.col(c).cast("string") for c in df.columns]), path)
    return read_csv(spark, path, all_text_schema(df))
