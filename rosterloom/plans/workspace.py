"""Stages of the pipeline kept as tables, so that later steps read instead of recompute.

A stage is written once per session and source folder into the shared folder and read back
as Parquet.  That is also how the deployed pipeline works: lookup results are stored, curated
tables are published, and the analyst questions read the published tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterloom.operators import matching, validation
from rosterloom.plans import derived, pipeline
from rosterloom.session import scratch_path
from rosterloom.sources import store

BUILT_AT = "2030-01-01 00:00:00"
_PATHS: dict[tuple, str] = {}


class Workspace:
    def __init__(self, spark: SparkSession, folder: str,
                 settings: pipeline.Settings | None = None) -> None:
        self.spark, self.folder = spark, folder
        self.settings = settings or pipeline.Settings()

    def path(self, name: str, write: Callable[[str], None]) -> str:
        key = (self.spark.sparkContext.applicationId, self.folder, self.settings, name)
        if key not in _PATHS:
            target = scratch_path(self.spark, name)
            write(target)
            _PATHS[key] = target
        return _PATHS[key]

    def stage(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        path = self.path(name, lambda p: build().write.parquet(p))
        return self.spark.read.parquet(path)

    # -------------------------------------------------------------- inputs

    def registrants(self) -> DataFrame:
        return derived.registrants(self.spark, self.folder)

    def table(self, name: str) -> DataFrame:
        return derived.table(self.spark, self.folder, name)

    def provider_calls(self) -> DataFrame:
        return derived.provider_calls(self.spark, self.folder)

    # -------------------------------------------------------------- stages

    def cleaned(self) -> DataFrame:
        return self.stage("cleaned", lambda: validation.clean_rows(
            self.registrants(), self.settings.guards))

    def valid(self) -> DataFrame:
        return validation.valid_rows(self.cleaned())

    def rejected(self, batch_prefix: str = "") -> DataFrame:
        return validation.rejected_rows(self.cleaned()).filter(
            F.col("batch_id").startswith(batch_prefix))

    def planned(self) -> DataFrame:
        return self.stage("planned", lambda: matching.plan_lookup(
            self.valid(), self.settings.ladder))

    def people(self) -> DataFrame:
        return self.stage("people", lambda: derived.catalogue(self.spark, self.folder))

    def candidates(self) -> DataFrame:
        return matching.name_candidates(self.people())

    def outcomes(self) -> DataFrame:
        """What every valid row would get, recorded faults included."""
        return self.stage("outcomes", lambda: pipeline.would_answer(
            self.valid(), self.people(), self.candidates(), self.settings,
            derived.faults(self.planned())))

    def results_path(self) -> str:
        def write(path: str) -> None:
            outcomes = matching.in_batch_cache(self.outcomes()).withColumn(
                "payer_ref", F.col("raw_ref"))
            store.write_lookup_results(pipeline.record(outcomes), path)
        return self.path("results", write)

    def results(self, batch_prefix: str | None = None) -> DataFrame:
        return store.lookup_results(self.spark, self.results_path(), batch_prefix)

    def built_at(self):
        return F.lit(BUILT_AT).cast("timestamp")

    def publish(self, path: str) -> None:
        pipeline.publish(self.results(), self.rejected(), path, self.built_at(),
                         self.settings.provider)

    def curated_path(self) -> str:
        return self.path("curated", self.publish)

    def curated(self, name: str) -> DataFrame:
        return store.read_curated(self.spark, self.curated_path(), name)
