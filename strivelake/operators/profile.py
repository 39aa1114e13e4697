"""A-6 / A-7 / O-3: column profiling of a reference table."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency of each non-null value, most frequent first (ties by value)."""
    return (df.filter(F.col(column).isNotNull())
            .groupBy(F.col(column).alias("value"))
            .agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), F.col("value").asc()))


def column_profile(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type, non_null) for every column, in one aggregation."""
    entries = [F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("column_name"),
                        F.lit(f.dataType.simpleString()).alias("data_type"),
                        F.count(F.col(f"`{f.name}`")).alias("non_null"))
               for i, f in enumerate(df.schema.fields)]
    return df.agg(F.array(*entries).alias("_p")).select(F.inline("_p"))
