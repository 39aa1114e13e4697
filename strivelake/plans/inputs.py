"""The pipeline's inputs at one scale-factor folder, each derived by Spark from the driver tables."""
from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from strivelake.operators.commute import enrich_employees
from strivelake.session import prepare
from strivelake.sources import fixtures
from strivelake.sources.reference import load_reference


class Inputs:
    """Lazily built DataFrames; nothing is computed until an action runs."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = prepare(spark)
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return fixtures.table(self.spark, self.sf_dir, name)

    @cached_property
    def activities(self) -> DataFrame:
        return fixtures.activities(self.spark, self.sf_dir)

    @cached_property
    def employee_sheet(self) -> DataFrame:
        return fixtures.employee_sheet(self.spark, self.sf_dir)

    @cached_property
    def employees(self) -> DataFrame:
        """ref/rh: sanitised sheet + commute_mode."""
        return load_reference(self.employee_sheet, is_rh=True, check_empty=False)

    @cached_property
    def sport_ref(self) -> DataFrame:
        """ref/sport: employee_id + Pratique_dun_sport."""
        return load_reference(fixtures.sport_sheet(self.spark, self.sf_dir), check_empty=False)

    @cached_property
    def names(self) -> DataFrame:
        return load_reference(fixtures.names_sheet(self.spark, self.sf_dir), check_empty=False)

    @cached_property
    def routes(self) -> DataFrame:
        return fixtures.routes(self.spark, self.sf_dir)

    @cached_property
    def enriched(self) -> DataFrame:
        """silver/rh_enriched."""
        return enrich_employees(self.employees, self.routes)

    @cached_property
    def change_log(self) -> DataFrame:
        """Log records with their batch number (0, 1, 2)."""
        return fixtures.change_log(self.spark, self.sf_dir)

    def log_batch(self, batch: int) -> DataFrame:
        return fixtures.log_batch(self.change_log, batch)

    @property
    def log(self) -> DataFrame:
        return self.change_log.drop("batch")

    def repeated_batch(self, batch: int) -> DataFrame:
        """A log batch as an at-least-once capture delivers it: some records come again."""
        return fixtures.repeated_batch(self.change_log, batch)

    @cached_property
    def names_log(self) -> DataFrame:
        """Name changes with the time from which they hold."""
        return fixtures.names_log(self.names)
