"""C-4 / A-1 kept up to date by the changes of the merged batches.

A merged batch gives the stored rows of the touched keys before and after it. Their activity years
become +1 / -1 per (employee, year); the sum of all deltas is the count, so nothing but the touched
keys is read again. Gold is computed anew for the touched employee-years only, and for whole years
when the list of years changes (a year that appears or that loses its last activity).

Deltas and gold rows are written in one folder per batch and rewritten by a retry, so a batch
counts once. A reader takes the newest row of every employee-year. The reference tables are taken
as they are when the batch runs; a change of theirs needs a full run of the gold job.
"""
from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strivelake.functions.expressions import activity_year
from strivelake.operators import gold
from strivelake.operators.cdc import top_row
from strivelake.rules import Rules
from strivelake.schemas import GOLD_COLUMNS
from strivelake.sources.tables import is_missing

KEY = ("employee_id", "activity_year")
COUNT = "physical_activities_count_year"
DELTA_SCHEMA = f"employee_id long, activity_year int, {COUNT} long, batch int"


def count_deltas(before: DataFrame, after: DataFrame) -> DataFrame:
    """(employee_id, activity_year, change of the count) of the touched rows, zeros left out."""
    def years(rows: DataFrame, sign: int) -> DataFrame:
        return rows.select("employee_id", activity_year("start_date").alias("activity_year"),
                           F.lit(sign).cast("long").alias("sign"))

    moved = years(before, -1).unionByName(years(after, 1)).filter(F.col("activity_year").isNotNull())
    return moved.groupBy(*KEY).agg(F.sum("sign").alias(COUNT)).filter(F.col(COUNT) != 0)


def summed(deltas: DataFrame) -> DataFrame:
    """The counts as :func:`gold.activities_by_year` gives them."""
    return deltas.groupBy(*KEY).agg(F.sum(COUNT).alias(COUNT)).filter(F.col(COUNT) > 0)


@dataclass(frozen=True)
class GoldView:
    """Gold in ``path``, maintained by :meth:`apply` (the ``watch`` of a merge)."""
    path: str
    employees: DataFrame
    sport_ref: DataFrame
    rules: Rules
    as_of: dt.date

    def _deltas(self, spark: SparkSession, up_to: int) -> DataFrame:
        try:
            found = spark.read.schema(DELTA_SCHEMA).parquet(f"{self.path}/deltas")
        except AnalysisException as error:
            if not is_missing(error):
                raise
            found = spark.createDataFrame([], DELTA_SCHEMA)
        return found.filter(F.col("batch") <= up_to)

    def counts(self, spark: SparkSession, up_to: int = 2**31 - 1) -> DataFrame:
        return summed(self._deltas(spark, up_to).select(*KEY, COUNT))

    def apply(self, before: DataFrame, after: DataFrame, batch_id: int) -> None:
        spark = before.sparkSession
        first = self._deltas(spark, batch_id - 1).isEmpty()
        (count_deltas(before, after).write.mode("overwrite")
         .parquet(f"{self.path}/deltas/batch={int(batch_id)}"))
        now, earlier = self.counts(spark, batch_id), self.counts(spark, batch_id - 1)
        listed = gold.year_array(gold.activity_years(now, self.as_of))
        was = F.lit([]).cast("array<int>") if first else gold.year_array(gold.activity_years(earlier, self.as_of))
        people = self.employees.select("employee_id")

        def whole(years: Column, removed: bool) -> DataFrame:
            return (gold.employee_year_spine(people, years)
                    .select(*KEY, F.lit(removed).alias("removed")))

        deltas = self._deltas(spark, batch_id).filter(F.col("batch") == batch_id)
        touched = (deltas.select(*KEY).join(people, "employee_id", "left_semi")
                   .filter(F.array_contains(listed, F.col("activity_year"))).withColumn("removed", F.lit(False))
                   .unionByName(whole(F.array_except(listed, was), False))
                   .unionByName(whole(F.array_except(was, listed), True)).distinct())
        rows = (gold.gold_employees(self.employees, self.sport_ref).join(touched, "employee_id")
                .join(now, list(KEY), "left").withColumnRenamed("activity_year", "year"))
        out = gold.gold_rows(rows, self.rules, self.as_of, "removed")
        out.write.mode("overwrite").parquet(f"{self.path}/rows/batch={int(batch_id)}")

    def read(self, spark: SparkSession) -> DataFrame:
        """Gold after the last batch: the newest row of every employee-year."""
        rows = spark.read.parquet(f"{self.path}/rows")
        key = F.struct("employee_id", "year")
        newest = top_row(rows.withColumn("_key", key), "_key", F.desc("batch"))
        return newest.filter(~F.col("removed")).select(*GOLD_COLUMNS)

    def rows_of_batch(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return spark.read.parquet(f"{self.path}/rows/batch={int(batch_id)}")
