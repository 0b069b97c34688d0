"""Ground truth onto motion samples: pen contact, gap closing, attention intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clock import seconds_to_ns
from ..vocabulary import DEFAULT_CONTACT_TOLERANCE_S, WRITING_DOT_TYPES
from .containment import covered_by, timeline
from .layout import (Ordered, along, attach, following, last_seen, next_seen, numbered, ordered, previous)

KEY = ("recording_id",)


def contact_timeline(motion: DataFrame, pen: DataFrame, *,
                     tolerance_s: float = DEFAULT_CONTACT_TOLERANCE_S, pen_shift_s: float = 0.0,
                     label: str = "label_writing") -> Ordered:
    """``contact_labels`` that keeps its row layout for the next ordered operator."""
    dots = pen.select("recording_id", (F.col("t_ns") + F.lit(seconds_to_ns(pen_shift_s))).alias("t_ns"),
                      F.col("dot_type").isin(*WRITING_DOT_TYPES).alias("writing"), "seq")
    dots = dots.withColumn("at_ns", F.col("t_ns"))
    # Dots at the very time of a sample count as "at or after" it, hence after it on the axis.
    axis = timeline(motion, dots, ["at_ns", "writing"], marks_first=False)
    near = along(axis, _before=last_seen(F.col("_mark")), _after=next_seen(F.col("_mark")))
    back = F.col("t_ns") - F.col("_before.at_ns")
    ahead = F.col("_after.at_ns") - F.col("t_ns")
    earlier = F.coalesce(back <= ahead, back.isNotNull())
    distance = F.when(earlier, back).otherwise(ahead)
    writing = F.when(earlier, F.col("_before.writing")).otherwise(F.col("_after.writing"))
    hit = F.coalesce(writing & (distance <= F.lit(tolerance_s * 1e9)), F.lit(False))
    rows = (near.rows.where(F.col("_kind") == 1)
            .withColumn(label, hit.cast("tinyint")).drop("_mark", "_before", "_after"))
    return near.having(rows)


def contact_labels(motion: DataFrame, pen: DataFrame, *,
                   tolerance_s: float = DEFAULT_CONTACT_TOLERANCE_S,
                   pen_shift_s: float = 0.0) -> DataFrame:
    """Add ``label_writing``: 1 where the nearest pen event is a writing contact in reach.

    The nearest event within the tolerance decides alone; at equal distance the earlier one does.
    The shift is added to pen times first.  Ties inside one time follow ``seq``.
    """
    return contact_timeline(motion, pen, tolerance_s=tolerance_s,
                            pen_shift_s=pen_shift_s).frame.drop("_kind", "_tie")


def close_gaps_along(layout: Ordered, gap_closing_s: float, label: str = "label_writing") -> Ordered:
    if gap_closing_s <= 0:
        return layout
    value, t = F.col(label), F.col("t_ns")
    edges = along(layout, _prev=previous(value), _next=following(value))
    # Times where a run starts after another and ends before another: the first run has no such
    # start and the last no such end, which leaves them alone.
    runs = along(edges, _start=last_seen(F.when(F.col("_prev") != value, t)),
                 _end=next_seen(F.when(F.col("_next") != value, t)))
    idle = (value == 0) & (F.col("_end") - F.col("_start") <= F.lit(gap_closing_s * 1e9))
    closed = F.when(F.coalesce(idle, F.lit(False)), F.lit(1).cast("tinyint")).otherwise(value)
    return runs.having(runs.rows.withColumn(label, closed).drop("_prev", "_next", "_start", "_end"))


def close_gaps(labelled: DataFrame, *, gap_closing_s: float, label: str = "label_writing") -> DataFrame:
    """Turn idle runs between writing into writing if first to last sample span at most the gap."""
    return close_gaps_along(ordered(labelled), gap_closing_s, label).frame


def writing_labels(motion: DataFrame, pen: DataFrame, *, gap_closing_s: float,
                   tolerance_s: float = DEFAULT_CONTACT_TOLERANCE_S,
                   pen_shift_s: float = 0.0) -> DataFrame:
    """Contact labels followed by gap closing, over one layout of the samples."""
    contact = contact_timeline(motion, pen, tolerance_s=tolerance_s, pen_shift_s=pen_shift_s)
    return close_gaps_along(contact, gap_closing_s).frame.drop("_kind", "_tie")


def attention_labels(motion: DataFrame, intervals: DataFrame, name: str = "label_attention") -> DataFrame:
    """Add the label of the half-open interval containing each sample; later intervals win."""
    spans = intervals.withColumn(name, F.col("label"))
    return covered_by(motion, spans, [name])


def expansion_agreement(motion: DataFrame, intervals: DataFrame, source_label: str) -> DataFrame:
    """Share of samples whose own label equals the closed interval covering them, per recording."""
    closed = intervals.withColumns({"t_end_ns": F.col("t_end_ns") + 1, "_expanded": F.col("label")})
    expanded = covered_by(motion, closed, ["_expanded"])
    same = F.coalesce(F.col("_expanded") == F.col(source_label), F.lit(False))
    return expanded.groupBy("recording_id").agg(F.avg(same.cast("double")).alias("agreement"))


def anchored_intervals(blocks: DataFrame, span: DataFrame) -> DataFrame:
    """Protocol offsets to intervals: anchored at the first sample, ending where the next starts.

    ``blocks``: recording_id, seq, start_s, label, activity.  ``span``: recording_id, t_start_ns,
    t_end_ns of the motion samples.  The last block ends with the last sample.
    """
    anchor = span.select("recording_id", F.col("t_start_ns").alias("_t0"), F.col("t_end_ns").alias("_t1"))
    placed = attach(blocks, anchor, ["recording_id"], "inner").withColumn(
        "t_start_ns", F.col("_t0") + F.rint(F.col("start_s") * F.lit(1e9)).cast("bigint"))
    chained = along(ordered(placed, KEY, ("seq",)), _next=following(F.col("t_start_ns"))).frame
    return chained.select("recording_id", "seq", "t_start_ns",
                          F.coalesce("_next", "_t1").alias("t_end_ns"), "label", "activity")


def inverted_intervals(intervals: DataFrame) -> DataFrame:
    """Violations: intervals ending before they start."""
    return intervals.where(F.col("t_start_ns") > F.col("t_end_ns"))


def merged_blocks(blocks: DataFrame) -> DataFrame:
    """Adjacent blocks of one label as one row: recording_id, position, start_s, label."""
    layout = ordered(blocks, KEY, ("seq",))
    marked = along(layout, _prev=previous(F.col("label"))).frame
    heads = marked.where(F.col("_prev").isNull() | (F.col("_prev") != F.col("label")))
    return _positioned(heads.select("recording_id", "seq", "start_s", "label"), layout.split)


def _positioned(rows: DataFrame, split: bool | None = None) -> DataFrame:
    return numbered(ordered(rows, KEY, ("seq",), split=split), "position").frame.drop("seq")


def block_disagreements(blocks: DataFrame, truth: DataFrame, tolerance_s: float = 0.5) -> DataFrame:
    """Positions where merged blocks and stated ground truth differ in start, label or presence."""
    merged = merged_blocks(blocks).withColumnRenamed("start_s", "block_start_s").withColumnRenamed(
        "label", "block_label")
    stated = _positioned(truth.select("recording_id", "seq", "start_s", "label")).withColumnRenamed(
        "start_s", "truth_start_s").withColumnRenamed("label", "truth_label")
    both = merged.join(stated, ["recording_id", "position"], "full_outer")
    same = ((F.abs(F.col("block_start_s") - F.col("truth_start_s")) <= tolerance_s)
            & (F.col("block_label") == F.col("truth_label")))
    return both.where(~F.coalesce(same, F.lit(False)))


def protocol_tail(span: DataFrame, blocks: DataFrame) -> DataFrame:
    """Recording length minus the end of the last protocol block, in seconds."""
    total = blocks.groupBy("recording_id").agg(F.max_by("end_s", "seq").alias("total_s"))
    return span.join(total, "recording_id").select(
        "recording_id", ((F.col("t_end_ns") - F.col("t_start_ns")) / F.lit(1e9)
                         - F.col("total_s")).alias("tail_s"))


