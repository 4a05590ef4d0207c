"""Queries over a pipeline event log ``(timestamp, event_type, update_id, details JSON)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import json_path

_EXPECTATIONS = "array<struct<name: string, dataset: string, passed_records: bigint, failed_records: bigint>>"


def quality_events(metrics: DataFrame, update_id: str, at) -> DataFrame:
    """Rule counts as log entries, one per dataset."""
    entry = F.struct("name", "dataset", "passed_records", "failed_records")
    per_dataset = metrics.groupBy("dataset").agg(F.collect_list(entry).alias("expectations"))
    details = F.struct(F.struct(F.struct("expectations").alias("data_quality")).alias("flow_progress"))
    return per_dataset.select(
        at.alias("timestamp"),
        F.lit("flow_progress").alias("event_type"),
        F.lit(update_id).alias("update_id"),
        F.to_json(details).alias("details"),
    )


def latest_update_id(log: DataFrame, event_type: str = "create_update"):
    """The update of the newest entry of a type, as a scalar subquery."""
    entries = log.where(F.col("event_type") == event_type)
    return entries.agg(F.max_by("update_id", F.struct("timestamp", "update_id"))).scalar()


def of_update(log: DataFrame, update_id) -> DataFrame:
    return log.where(F.col("update_id") == update_id)


def audit(log: DataFrame) -> DataFrame:
    """Who did what and when."""
    return log.where("event_type = 'user_action'").select(
        "timestamp",
        json_path("details", "user_action.action").alias("action"),
        json_path("details", "user_action.user_name").alias("user_name"),
        "update_id",
    )


def lineage(log: DataFrame) -> DataFrame:
    """Edges from input to output datasets, each once."""
    flows = log.where("event_type = 'flow_definition'")
    inputs = F.from_json(json_path("details", "flow_definition.input_datasets"), "array<string>")
    return flows.select(
        json_path("details", "flow_definition.output_dataset").alias("output_dataset"),
        F.explode(inputs).alias("input_dataset"),
    ).distinct()


def expectation_report(log: DataFrame) -> DataFrame:
    """Passed and failed records per dataset and rule."""
    text = json_path("details", "flow_progress.data_quality.expectations")
    rules = log.where("event_type = 'flow_progress'").select(F.inline(F.from_json(text, _EXPECTATIONS)))
    return rules.groupBy("dataset", F.col("name").alias("expectation")).agg(
        F.sum("passed_records").alias("passing_records"), F.sum("failed_records").alias("failing_records")
    )


def status_columns(log: DataFrame, statuses: dict[str, str]) -> DataFrame:
    """Requested executors over time, in one column per status."""
    status = json_path("details", "autoscale.status")
    wanted = json_path("details", "autoscale.requested_num_executors").cast("double")
    return log.where("event_type = 'autoscale'").select(
        "timestamp", *[F.when(status == value, wanted).alias(name) for value, name in statuses.items()]
    )
