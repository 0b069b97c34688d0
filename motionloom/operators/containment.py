"""Joining instants with the spans that contain them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .layout import (Ordered, along, attach, durable, following, last_seen, ordered, previous, running_max,
                     running_sum, union_all, written)



def timeline(points: DataFrame, marks: DataFrame, mark: list[str], *, marks_first: bool,
             key: tuple[str, ...] = ("recording_id",), tie: str = "seq") -> Ordered:
    """Points and marks of each key on one ordered axis ``t_ns``.

    Mark values arrive in the struct ``_mark``, which is NULL on points.  At equal times marks come
    first or last as asked.  Linear in the input: no pair of point and mark is ever built, so dense
    marks or a hot key cost no more than sorting them.
    """
    # Own types keep rows apart: points carry kind 1 and marks 0 or 2 around them.
    held = marks.select(*key, "t_ns", F.lit(0 if marks_first else 2).alias("_kind"),
                        F.col(tie).cast("bigint").alias("_tie"),
                        F.struct(*mark).alias("_mark"))
    own = points.withColumns({"_kind": F.lit(1), "_tie": F.col(tie).cast("bigint")})
    return ordered(union_all([own, held]), key, ("t_ns", "_kind", "_tie"))


def disjoint_spans(spans: DataFrame, values: list[str], rank: str,
                   key: tuple[str, ...] = ("recording_id",)) -> DataFrame:
    """Rewrite half-open spans ``[t_start_ns, t_end_ns)`` so that none overlap.

    Where several cover an instant, the one with the greatest ``rank`` (unique per key) wins.  Spans
    that never overlap, the normal case, pass through.  Otherwise boundaries are numbered, each span
    is cut into aligned power-of-two blocks of those numbers (at most two per size), and every piece
    between neighbouring boundaries looks its blocks up.  The work grows with the number of spans
    times its logarithm even where all of them cover each other.
    """
    spans = spans.where(F.col("t_start_ns") < F.col("t_end_ns"))
    laid = ordered(spans, key, ("t_start_ns", rank))
    reach = along(laid, _reach=running_max(F.col("t_end_ns")))
    before = along(reach, _before=previous(F.col("_reach")))
    if before.rows.where(F.col("_before") > F.col("t_start_ns")).isEmpty():
        return spans

    ends = F.array(F.struct(F.col("t_start_ns").alias("_t"), F.lit(0).alias("_side")),
                   F.struct(F.col("t_end_ns").alias("_t"), F.lit(1).alias("_side")))
    bounds = ordered(spans.select(*key, rank, *values, F.inline(ends)), key, ("_t", "_side", rank))
    seen = along(bounds, _prev=previous(F.col("_t")))
    fresh = F.when(F.col("_prev").eqNullSafe(F.col("_t")), 0).otherwise(1)
    places = durable(along(seen.having(seen.rows.withColumn("_fresh", fresh)),
                           _place=running_sum(F.col("_fresh"))).frame)
    highest = places.agg(F.max("_place")).first()[0]
    sizes = list(range(int(highest).bit_length()))
    placed = places.groupBy(*key, rank).agg(
        F.min("_place").alias("_low"), F.max("_place").alias("_high"),
        F.max(F.struct(F.col(rank).alias("_rank"), *values)).alias("_winner"))

    def blocks(size):
        low = -F.call_function("shiftright", -F.col("_low"), size)
        high = F.call_function("shiftright", F.col("_high"), size)
        odd = lambda v: F.pmod(v, F.lit(2)) == 1
        return F.array(
            F.when((low < high) & odd(low), F.struct(size.alias("_size"), low.alias("_block"))),
            F.when((low < high) & odd(high), F.struct(size.alias("_size"), (high - 1).alias("_block"))))

    levels = F.array(*[F.lit(s) for s in sizes])
    best = (placed.select(*key, "_winner", F.explode(F.flatten(F.transform(levels, blocks))).alias("b"))
            .where(F.col("b").isNotNull())
            .groupBy(*key, "b._size", "b._block").agg(F.max("_winner").alias("_winner")))
    cuts = places.where("_fresh = 1").select(*key, F.col("_t").alias("t_start_ns"), "_place")
    pieces = along(ordered(cuts, key, ("t_start_ns",), split=bounds.split),
                   t_end_ns=following(F.col("t_start_ns"))).frame
    probes = (pieces.where(F.col("t_end_ns").isNotNull()).withColumn("_size", F.explode(levels))
              .withColumn("_block", F.call_function("shiftright", F.col("_place"), F.col("_size"))))
    return (attach(probes, best, [*key, "_size", "_block"], "inner", costly=True)
            .groupBy(*key, "t_start_ns", "t_end_ns").agg(F.max("_winner").alias("_winner"))
            .select(*key, "t_start_ns", "t_end_ns", F.col("_winner._rank").alias(rank),
                    *[F.col(f"_winner.{v}").alias(v) for v in values]))


def covered_by(points: DataFrame, spans: DataFrame, values: list[str], rank: str = "seq",
               key: tuple[str, ...] = ("recording_id",)) -> DataFrame:
    """Every point with the values of the half-open span containing it, NULL outside all spans."""
    apart = disjoint_spans(spans, values, rank, key)
    marks = apart.select(*key, F.col("t_start_ns").alias("t_ns"), "t_end_ns", *values,
                         F.lit(0).alias("seq"))
    axis = timeline(points, marks, ["t_end_ns", *values], marks_first=True, key=key)
    seen = along(axis, _span=last_seen(F.col("_mark"))).frame
    inside = F.col("t_ns") < F.col("_span.t_end_ns")
    return seen.where(F.col("_kind") == 1).select(
        *points.columns, *[F.when(inside, F.col(f"_span.{v}")).alias(v) for v in values])


def inside_any(points: DataFrame, spans: DataFrame, name: str,
               key: tuple[str, ...] = ("recording_id",)) -> DataFrame:
    """Points with a flag: is the point inside some closed span ``[t_start_ns, t_end_ns]``?"""
    marks = spans.select(*key, F.col("t_start_ns").alias("t_ns"), "t_end_ns", F.lit(0).alias("seq"))
    axis = timeline(points, marks, ["t_end_ns"], marks_first=True, key=key)
    seen = along(axis, _reach=running_max(F.col("_mark.t_end_ns"))).frame
    return seen.where(F.col("_kind") == 1).select(
        *points.columns, F.coalesce(F.col("_reach") >= F.col("t_ns"), F.lit(False)).alias(name))


def swept(points: DataFrame, windows: DataFrame, key: list[str], at: str) -> tuple[DataFrame, DataFrame]:
    """``points`` and ``windows`` with a common column ``_segment``: they meet in it exactly if ``lo <= point <= hi``.

    Points and window ends are sorted on one axis.  Points with no end between them share a segment, and segments without points do
    not exist, so a window covers the segments from the one after its first end to the one before its last, all of which
    hold points.  Windows are repeated for each of these, which are never more than its pairs; points are not repeated.
    """
    numbered_windows = durable(windows.where(F.col("lo") <= F.col("hi")).withColumn("_window", F.monotonically_increasing_id()))
    ends = F.inline(F.array(F.struct(F.col("lo").cast("bigint").alias("_t"), F.lit(0).alias("_kind")), F.struct(F.col("hi").cast("bigint").alias("_t"), F.lit(2).alias("_kind"))))
    bounds = numbered_windows.select(*key, ends, F.col("_window"))
    dots = points.select(*key, F.col(at).cast("bigint").alias("_t"), F.lit(1).alias("_kind"), F.struct(*points.columns).alias("_point")).where("_t IS NOT NULL")
    axis = union_all([dots, bounds])
    order = ("_t", "_kind")  # ties of one kind are all alike
    layout = along(ordered(axis.withColumn("_tie", F.monotonically_increasing_id()), tuple(key), (*order, "_tie")), _before=previous(F.col("_kind")))
    starts = ((F.col("_kind") == 1) & ~F.coalesce(F.col("_before") == 1, F.lit(False))).cast("bigint")
    # Written once: ends and points are read from it separately, and joins count points before they read them.
    placed = written(along(layout, _segment=running_sum(starts)).frame.select("_kind", "_window", "_segment", "_point"))
    reach = (placed.where("_kind <> 1").groupBy("_window").agg(F.max(F.when(F.col("_kind") == 0, F.col("_segment") + 1)).alias("_from"), F.max(F.when(F.col("_kind") == 2, F.col("_segment"))).alias("_to"))
             .where("_from <= _to").select("_window", F.explode(F.sequence("_from", "_to")).alias("_segment")))
    return placed.where("_kind = 1").select("_point.*", "_segment"), numbered_windows.join(reach, "_window").drop("_window")


def contained(points: DataFrame, windows: DataFrame, key: list[str], at: str) -> DataFrame:
    """All (point, window) pairs with ``lo <= point <= hi`` in whole numbers; windows may overlap and repeat."""
    dots, spread = swept(points, windows, key, at)
    return attach(dots, durable(spread), [*key, "_segment"], "inner").drop("_segment")


def contained_values(points: DataFrame, windows: DataFrame, key: list[str], at: str, values: list[str]) -> DataFrame:
    """The distinct ``values`` of the points inside each window, with the window's columns, before any pair is built."""
    dots, spread = swept(points, windows, key, at)
    return dots.select(*key, "_segment", *values).distinct().join(spread, [*key, "_segment"]).drop("_segment").distinct()
