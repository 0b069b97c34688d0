"""Pen events: strokes, dot rate and the clock it can be measured on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..vocabulary import MAX_BATCHED_SHARE
from .layout import along, ordered, previous, running_sum

PEN_CLOCK = "src_timestamp"


def _down() -> Column:
    return F.coalesce(F.col("dot_type") == "PEN_DOWN", F.lit(False))


def strokes(pen: DataFrame) -> DataFrame:
    """Add ``stroke``: running count of pen-down events; dots before the first are stroke 0."""
    return along(ordered(pen), stroke=running_sum(_down().cast("bigint"))).frame


def _segmented(pen: DataFrame, split: bool | None = None) -> DataFrame:
    """Stroke numbers on both clocks and the gap inside a stroke, in one pass.

    The pen clock numbers only rows that carry it: a pen-down event without it starts no stroke.
    """
    logged = F.col(PEN_CLOCK).isNotNull()
    seen = along(ordered(pen.select("recording_id", "t_ns", "seq", "dot_type", PEN_CLOCK), split=split),
                 stroke=running_sum(_down().cast("bigint")),
                 logged_stroke=running_sum((_down() & logged).cast("bigint")),
                 _prev=previous(F.col("t_ns"))).frame
    return seen.withColumn("gap_ns", F.when(~_down(), F.col("t_ns") - F.col("_prev"))).drop("_prev")


def _rate(dots: DataFrame, stroke: str, clock: str, ticks_per_s: float, name: str) -> DataFrame:
    spans = dots.groupBy("recording_id", stroke).agg(
        ((F.max(clock) - F.min(clock)) / F.lit(ticks_per_s)).alias("span_s"),
        (F.count("*") - 1).alias("steps"))
    return spans.where("span_s > 0").groupBy("recording_id").agg(
        F.bround(F.sum("steps") / F.sum("span_s"), 3).alias(name))


def stroke_rate(pen: DataFrame) -> DataFrame:
    """Dots per second inside strokes on ``t_ns``; recordings without a timed stroke are left out."""
    return _rate(strokes(pen), "stroke", "t_ns", 1e9, "stroke_hz")


def batched_share(pen: DataFrame) -> DataFrame:
    """Share of in-stroke time steps that are zero; NULL without any step."""
    return _segmented(pen).groupBy("recording_id").agg(
        F.avg((F.col("gap_ns") == 0).cast("double")).alias("batched_share"))


def dot_rate(pen: DataFrame, split: bool | None = None) -> DataFrame:
    """Per recording: in-stroke dot rate and the clock it was measured on.

    The pen's own clock decides wherever any dot carries it.  Otherwise ``t_ns`` is used only if few
    in-stroke steps are zero; dots stamped in batches on arrival would overstate the rate.
    """
    # A stroke lies in one stroke of the pen clock, so one pass over the dots tells both: by stroke, by pen-clock stroke, by recording.
    by_stroke = _segmented(pen, split).groupBy("recording_id", "logged_stroke", "stroke").agg(
        ((F.max("t_ns") - F.min("t_ns")) / F.lit(1e9)).alias("_s"), (F.count("*") - 1).alias("_steps"),
        F.min(PEN_CLOCK).alias("_lo"), F.max(PEN_CLOCK).alias("_hi"), F.count(PEN_CLOCK).alias("_logged"),
        F.count("gap_ns").alias("_gaps"), F.count_if(F.col("gap_ns") == 0).alias("_zero"))
    timed = F.col("_s") > 0
    logged = by_stroke.groupBy("recording_id", "logged_stroke").agg(
        F.sum(F.when(timed, F.col("_s"))).alias("_s"), F.sum(F.when(timed, F.col("_steps"))).alias("_steps"),
        ((F.max("_hi") - F.min("_lo")) / F.lit(1e3)).alias("_pen_s"), F.sum("_logged").alias("_logged"),
        F.sum("_gaps").alias("_gaps"), F.sum("_zero").alias("_zero"))
    on_pen = F.col("_pen_s") > 0
    facts = logged.groupBy("recording_id").agg(
        F.sum("_logged").alias("logged"), F.try_divide(F.sum("_zero"), F.sum("_gaps")).alias("batched"),
        F.bround(F.sum(F.when(on_pen, F.col("_logged") - 1)) / F.sum(F.when(on_pen, F.col("_pen_s"))), 3).alias("pen_hz"),
        F.bround(F.sum("_steps") / F.sum("_s"), 3).alias("time_hz"))
    rate = F.when(F.col("logged") > 0, F.col("pen_hz")).when(
        F.col("batched") <= MAX_BATCHED_SHARE, F.col("time_hz"))
    clock = F.when(rate.isNull(), "").when(F.col("logged") > 0, PEN_CLOCK).otherwise("t_ns")
    return facts.select("recording_id", rate.alias("pen_hz_measured"), clock.alias("pen_hz_clock"))
