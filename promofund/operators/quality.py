"""Data-quality checks (M1–M3) as single aggregation passes.

Each check returns a small DataFrame of result rows, so a suite is a
``unionByName`` of checks and nothing is collected to the driver. A check on
a column the table does not have reports ``column_missing`` instead of
failing the run (N16).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESULT_COLS = ("check_name", "table_name", "target", "failing_rows", "status")


def no_nulls(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """M1: rows with NULL in each column (one ``count_if`` pass)."""
    present = [c for c in columns if c in df.columns]
    missing = [c for c in columns if c not in df.columns]
    out = None
    if present:
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in present])
        out = counts.unpivot([], present, "target", "failing_rows").select(
            F.lit("no_nulls").alias("check_name"), F.lit(table).alias("table_name"), "target",
            F.col("failing_rows").cast("bigint").alias("failing_rows"),
            F.when(F.col("failing_rows") == 0, F.lit("pass")).otherwise(F.lit("fail")).alias("status"))
    for c in missing:
        row = df.sparkSession.range(1).select(
            F.lit("no_nulls").alias("check_name"), F.lit(table).alias("table_name"), F.lit(c).alias("target"),
            F.lit(None).cast("bigint").alias("failing_rows"), F.lit("column_missing").alias("status"))
        out = row if out is None else out.unionByName(row)
    return out


def no_duplicates(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """M2: number of key groups with more than one row (partial aggregate
    per task, then one shuffle of the distinct keys)."""
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return dup.agg(F.count(F.lit(1)).alias("failing_rows")).select(
        F.lit("no_duplicates").alias("check_name"), F.lit(table).alias("table_name"),
        F.lit(",".join(keys)).alias("target"), F.col("failing_rows").cast("bigint").alias("failing_rows"),
        F.when(F.col("failing_rows") == 0, F.lit("pass")).otherwise(F.lit("fail")).alias("status"))


def statement_true(df: DataFrame, table: str, name: str, statement: str) -> DataFrame:
    """M3: an aggregate SQL expression that must be TRUE over the table."""
    return df.agg(F.expr(statement).alias("ok")).select(
        F.lit("statement_true").alias("check_name"), F.lit(table).alias("table_name"),
        F.lit(name).alias("target"),
        F.when(F.col("ok"), F.lit(0)).otherwise(F.lit(1)).cast("bigint").alias("failing_rows"),
        F.when(F.col("ok"), F.lit("pass")).otherwise(F.lit("fail")).alias("status"))


def suite(*checks: DataFrame) -> DataFrame:
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out
