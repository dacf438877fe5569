"""Counts of a run, taken in the jobs that write its tables (A4)."""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, functions as F

from rosterkeep.operators.lifecycle import EFFECTS
from rosterkeep.sources import paths
from rosterkeep.sources.store import Store, empty_frame

COUNTS = "run_date date, step string, name string, value long"
STATUSES = (0, 1, 2)


class RunCounts:
    """Collects metrics of the frames a run writes.

    They are attached to the frame as it is written, above its last shuffle: the tasks that write count each row once, also
    where an earlier stage runs again because an executor was lost. No job runs for them.
    """

    def __init__(self) -> None:
        self._seen: list[tuple[str, Observation]] = []

    def observe(self, df: DataFrame, step: str, **metrics: Column) -> DataFrame:
        """The frame, counted once it is written; metrics that are NULL (of no row) count 0."""
        seen = Observation()
        self._seen.append((step, seen))
        return df.observe(seen, *[metric.alias(name) for name, metric in metrics.items()])

    def add(self, other: RunCounts) -> None:
        """Take over what another one collected, now that what it counted is in force."""
        self._seen += other._seen

    def rows(self) -> list[tuple[str, str, int]]:
        """``step``, ``name`` and value of each metric; the frames have been written."""
        return [(step, name, int(value or 0)) for step, seen in self._seen for name, value in seen.get.items()]

    def write(self, store: Store, run_date: dt.date) -> None:
        """A file of the counts of this run; a run that is repeated leaves another one."""
        rows = [{"run_date": run_date.isoformat(), "step": step, "name": name, "value": value} for step, name, value in self.rows()]
        number = len(paths.names(store.spark, f"{store.root}/counts"))
        text = "\n".join(json.dumps(row) for row in rows)
        paths.write_text(store.spark, f"{store.root}/counts/{number:06d}-{uuid.uuid4().hex[:8]}.json", text)


def run_counts(store: Store) -> DataFrame:
    """``run_date, step, name, value`` of every run, of a date the last one; empty before the first."""
    spark = store.spark
    schema = spark.createDataFrame([], COUNTS).schema
    if not paths.names(spark, f"{store.root}/counts"):
        return empty_frame(spark, schema)
    rows = spark.read.schema(schema).json(f"{store.root}/counts").withColumn("_file", F.col("_metadata.file_name"))
    return rows.groupBy("run_date", "step", "name").agg(F.max_by("value", "_file").alias("value"))


def rows_counted() -> Column:
    return F.count(F.lit(1))


def rule_metrics() -> dict[str, Column]:
    """Accounts by rule, and by the status they are in then."""
    by_rule = {rule: F.count_if(F.col("rule") == rule) for rule in EFFECTS}
    return by_rule | {f"status {status}": F.count_if(F.col("delete_status") == status) for status in STATUSES}
