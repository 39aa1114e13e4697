"""K-2 / O-1 / S-7: sorted Parquet export for BI and its read-back."""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from strivelake.operators.quality import assert_not_empty
from strivelake.sources.tables import is_missing

EXPORT_KEYS = ("year", "employee_id")


def export_sorted(df: DataFrame, path: str, keys: tuple[str, ...] = EXPORT_KEYS, *,
                  single_file: bool = False, check_empty: bool = True) -> str:
    """Write ``df`` sorted by ``keys``; an empty input is an error.

    Default: range-partitioned on the keys (sampled boundaries, parallel write)
    and sorted within each file, so the part files in name order are globally
    sorted. ``single_file=True`` reproduces the one-file export for small
    outputs only: it sends every row through one task.
    """
    if check_empty:
        assert_not_empty(df, "export input")
    if single_file:
        out = df.repartition(1)
    else:
        out = df.repartitionByRange(*keys)
    out.sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)
    return path


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """All part files of an export (the reference read only the first one; D-13)."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if is_missing(exc):
            raise FileNotFoundError(f"no Parquet file under {path}") from exc
        raise
