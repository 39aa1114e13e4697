"""K-1 / S-7: tables that a job replaces as a whole, with Spark's own writers.

Delta tables when Delta is on the class path (atomic overwrite), Parquet folders otherwise. The
current state of the change log has its own layout (:mod:`strivelake.sources.state`).
"""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def is_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def delta_available() -> bool:
    try:
        import delta.tables  # noqa: F401
        return True
    except ImportError:
        return False


def default_format() -> str:
    return "delta" if delta_available() else "parquet"


def _is_delta(spark: SparkSession, path: str) -> bool:
    if not delta_available():
        return False
    from delta.tables import DeltaTable
    return DeltaTable.isDeltaTable(spark, path)


def write_table(df: DataFrame, path: str, *, fmt: str = "parquet") -> str:
    """K-1: full replace; the new rows may have another schema. ``df`` must not read ``path``."""
    writer = df.write.format(fmt).mode("overwrite")
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    writer.save(path)
    return path


def read_table(spark: SparkSession, path: str, *, fmt: str | None = None) -> DataFrame:
    """The rows of a table: Delta when the folder is one, else Parquet."""
    return spark.read.format(fmt or ("delta" if _is_delta(spark, path) else "parquet")).load(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        read_table(spark, path)
    except AnalysisException as error:
        if is_missing(error):
            return False
        raise
    return True
