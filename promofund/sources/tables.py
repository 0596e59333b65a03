"""Table scans (A1) with explicit projections so parquet reads only the
columns a job uses."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return os.path.join(sf_dir, f"{name}.parquet")


# Parquet footers are read once per (session, table): every later scan of the
# same table passes the schema explicitly, which skips the schema-inference
# job Spark would otherwise launch for each ``read.parquet`` call.
_SCHEMAS: dict[tuple[str, str], object] = {}


def folder_state(spark: SparkSession, sf_dir: str) -> str:
    """The tables' files: name, length and time of change; of a folder of part
    files their number and total length besides the folder's own time."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(sf_dir, "*.parquet")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for status in fs.globStatus(path) or ():
        state = [status.getPath().getName(), status.getLen(), status.getModificationTime()]
        if status.isDirectory():
            inside = fs.getContentSummary(status.getPath())
            state += [inside.getFileCount(), inside.getLength()]
        found.append(state)
    return repr(sorted(found))


def scan(spark: SparkSession, sf_dir: str, name: str,
         columns: Sequence[str] | None = None, merge_schema: bool = False) -> DataFrame:
    """A1: ``spark.read.parquet`` + projection.

    ``merge_schema`` is the read-side of schema evolution (new columns added by
    later writes show up as NULL in old files).
    """
    path = table_path(sf_dir, name)
    reader = spark.read
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
        df = reader.parquet(path)
    else:
        key = (spark.sparkContext.applicationId, path, folder_state(spark, sf_dir))
        schema = _SCHEMAS.get(key)
        if schema is None:
            df = reader.parquet(path)
            _SCHEMAS[key] = df.schema
        else:
            df = reader.schema(schema).parquet(path)
    if columns is not None:
        df = df.select(*columns)
    return df
