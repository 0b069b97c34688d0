"""Aggregates over the manifest, the channels and the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.layout import union_all
from ..operators.quantile import quantiles
from ..vocabulary import CATEGORY_COLUMNS, MODALITIES


def corpus_counts(manifest: DataFrame) -> DataFrame:
    """One row: recordings, distinct participants, hours."""
    people = manifest.where("participant_id IS NOT NULL").groupBy("participant_id").count()
    total = manifest.agg(F.count("*").alias("recordings"),
                         (F.sum("duration_s") / F.lit(3600.0)).alias("hours"))
    return total.withColumn("participants", F.lit(people.count()))


def cohort_counts(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("cohort").agg(F.count("*").alias("recordings"))


def pen_rate_summary(manifest: DataFrame) -> DataFrame:
    """Per pen model and clock: recordings, and median and range of the measured rates."""
    by = ["pen_model", "pen_hz_clock"]
    pens = manifest.where(F.col("has_pen") & F.col("pen_model").isNotNull() & F.col("pen_hz_clock").isNotNull())
    plain = pens.groupBy(*by).agg(F.count("*").alias("recordings"),
                                  F.min("pen_hz_measured").alias("lowest_hz"),
                                  F.max("pen_hz_measured").alias("highest_hz"))
    return plain.join(quantiles(pens, by, "pen_hz_measured", median_hz=0.5).drop("n"), by, "left")


def channel_summary(channels: DataFrame) -> DataFrame:
    return channels.groupBy("modality", "column", "quantity", "unit", "semantics", "time_domain").agg(
        F.count("*").alias("recordings"))


def category_values(tables: dict[str, DataFrame]) -> DataFrame:
    """(modality, column, value) of every category column, from one scan per table."""
    found = []
    for modality, table in tables.items():
        names = [c for m, c in CATEGORY_COLUMNS if m == modality and c in table.columns]
        if names:
            entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                                for c in names])
            found.append(table.select(F.lit(modality).alias("modality"), F.inline(entries))
                         .where("value IS NOT NULL").distinct())
    return union_all(found)


def withdrawn_streams(manifest: DataFrame) -> DataFrame:
    """(recording_id, modality) withdrawn according to the issue codes."""
    issues = F.from_json("issue_codes", "array<struct<code: string, modality: string>>")
    return (manifest.where("issue_codes <> ''").select("recording_id", F.inline(issues))
            .where("code = 'modality_withdrawn'").select("recording_id", "modality"))


def selection_summary(selected: DataFrame) -> DataFrame:
    """One row: recordings, hours and recordings per device."""
    devices = [f"has_{m}" for m in ("watch", "headimu", "pen", "attention")]
    return selected.agg(
        F.count("*").alias("recordings"), (F.coalesce(F.sum("duration_s"), F.lit(0.0)) / F.lit(3600.0)).alias("hours"),
        *[F.count_if(F.col(d)).alias(d.removeprefix("has_")) for d in devices if d in selected.columns])


def modality_counts(span: DataFrame) -> DataFrame:
    """(modality, recordings) with stored rows; every modality is listed."""
    zero = span.sparkSession.createDataFrame([(m,) for m in MODALITIES], "modality string")
    held = span.groupBy("modality").agg(F.count("*").alias("n"))
    return zero.join(held, "modality", "left").select("modality", F.coalesce("n", F.lit(0)).alias("recordings"))
