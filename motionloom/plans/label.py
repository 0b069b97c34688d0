"""Labelled sample tables for all recordings of a task in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.labels import attention_labels, writing_labels
from ..operators.resample import decimation_factors, downsample, require_factors
from ..sources.zones import StoredTable, rows_of
from .manifest import refuse
from .select import (TASKS, LabelConfig, mixed_semantics, requested_ids, unknown_ids, with_eligibility)


def label_guards(selected: DataFrame, config: LabelConfig) -> None:
    """Refuse recordings that cannot be labelled and selections mixing acceleration semantics."""
    refuse(with_eligibility(selected, config).where("reason IS NOT NULL").select("recording_id", "reason"),
           f"recordings unfit for the {config.task} task")
    if TASKS[config.task][0] == "watch" and "accel_semantics" in selected.columns and not config.allow_mixed_accel:
        found = mixed_semantics(selected)
        if len(found.take(2)) > 1:
            refuse(found.orderBy("value"), "mixed watch acceleration semantics; restrict the selection or "
                                           "pass allow_mixed_accel=True")


def label_recordings(tables: dict[str, DataFrame | StoredTable], manifest: DataFrame, ids: list[str] | DataFrame,
                     config: LabelConfig) -> DataFrame:
    """Motion samples of the recordings with the task's label column."""
    motion_name, truth_name, _ = TASKS[config.task]
    chosen = requested_ids(manifest, ids).select("recording_id").distinct()
    refuse(unknown_ids(chosen, manifest), "recording id(s) not found in the manifest", KeyError)
    selected = manifest.join(chosen, "recording_id", "left_semi")
    label_guards(selected, config)
    motion, truth = rows_of(tables[motion_name], chosen), rows_of(tables[truth_name], chosen)
    if config.target_hz is not None:
        rate = "watch_hz_measured" if motion_name == "watch" else "head_hz_measured"
        factors = decimation_factors(selected.select("recording_id", F.col(rate).alias("rate_hz")),
                                     config.target_hz)
        require_factors(factors, config.target_hz)
        motion = downsample(motion, factors)
    if config.task == "writing":
        return writing_labels(motion, truth, gap_closing_s=config.gap_closing_s,
                              tolerance_s=config.contact_tolerance_s, pen_shift_s=config.pen_shift_s)
    return attention_labels(motion, truth)


def label_record(labelled: DataFrame, task: str, manifest: DataFrame | None = None) -> DataFrame:
    """(recording_id, n_samples, labelled_share) of a labelled table, with semantics if known."""
    label = F.col(TASKS[task][2])
    hit = (label == 1) if task == "writing" else label.isNotNull()
    record = labelled.groupBy("recording_id").agg(
        F.count("*").alias("n_samples"), F.bround(F.avg(hit.cast("double")), 4).alias("labelled_share"))
    if manifest is not None and task == "writing":
        record = record.join(manifest.select("recording_id", "accel_semantics"), "recording_id", "left")
    return record
