"""Redaction of pen coordinates and rebasing of absolute clocks, with their audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clock import in_any_sql, rebased_ms
from ..functions.payload import (holds_coordinates, payload_holds_unix_time, rebase_payload,
                                 strip_coordinates)
from ..functions.text import present
from ..vocabulary import (FREE_WRITING_TASKS, MS_COLUMNS, NS_COLUMNS, PAYLOAD_COLUMN,
                          REDACTION_POLICIES, TIME_ORIGINS, UNIX_NS_RANGE, UNIX_RANGES)
from .containment import inside_any
from .layout import attach, union_all
from .motion import table_span


def _known(value: str, allowed: tuple[str, ...], what: str) -> str:
    if value not in allowed:
        raise ValueError(f"unknown {what} {value!r}")
    return value


def free_writing_spans(markers: DataFrame) -> DataFrame:
    """Closed time span of every free-writing task that has both a start and an end."""
    def at(event):
        return F.when(F.col("event") == event, F.col("t_ns"))
    return (markers.where(F.col("task_id").isin(*FREE_WRITING_TASKS) & F.col("task_index").isNotNull())
            .groupBy("recording_id", "task_index")
            .agg(F.min(at("task_start")).alias("t_start_ns"), F.max(at("task_end")).alias("t_end_ns"))
            .where("t_start_ns IS NOT NULL AND t_end_ns IS NOT NULL"))


def unbounded_free_writing(markers: DataFrame) -> DataFrame:
    """Violations: free-writing tasks lacking a start or an end, which therefore blank nothing."""
    def has(event):
        return F.bool_or(F.col("event") == event)
    return (markers.where(F.col("task_id").isin(*FREE_WRITING_TASKS) & F.col("task_index").isNotNull())
            .groupBy("recording_id", "task_index")
            .agg(has("task_start").alias("has_start"), has("task_end").alias("has_end"))
            .where("NOT (has_start AND has_end)"))


def task_structure(markers: DataFrame) -> DataFrame:
    """Per recording: does any marker name a task?  A NULL or blank name is none."""
    return markers.groupBy("recording_id").agg(F.bool_or(present(F.col("task_id"))).alias("has_tasks"))


def _exposed(pen: DataFrame, markers: DataFrame) -> DataFrame:
    """Pen rows flagged where the free-writing policy demands blank coordinates."""
    flagged = inside_any(pen, free_writing_spans(markers), "_in_span")
    rows = attach(flagged, task_structure(markers), ["recording_id"], costly=True)
    # Without task names free writing cannot be told apart, so everything is blanked.
    blank = F.col("_in_span") | ~F.coalesce(F.col("has_tasks"), F.lit(False))
    return rows.withColumn("_blank", blank).drop("_in_span", "has_tasks")


def redact_coordinates(pen: DataFrame, markers: DataFrame, policy: str) -> DataFrame:
    """Blank ``x`` and ``y`` under the policy; the number of rows never changes."""
    _known(policy, REDACTION_POLICIES, "redaction policy")
    if policy == "none":
        return pen
    flagged = (pen.withColumn("_blank", F.lit(True)) if policy == "all_xy" else _exposed(pen, markers))
    blanked = {c: F.when(~F.col("_blank"), F.col(c)) for c in ("x", "y") if c in pen.columns}
    return flagged.withColumns(blanked).select(*pen.columns)


def redact_payload_coordinates(markers: DataFrame, policy: str) -> DataFrame:
    """Drop coordinates from marker payloads under every policy but ``none``."""
    if _known(policy, REDACTION_POLICIES, "redaction policy") == "none" or PAYLOAD_COLUMN not in markers.columns:
        return markers
    return markers.withColumn(PAYLOAD_COLUMN, strip_coordinates(F.col(PAYLOAD_COLUMN)))


def _counted(rows: DataFrame, modality: str) -> DataFrame:
    return rows.groupBy("recording_id", F.lit(modality).alias("modality")).agg(F.count("*").alias("violations"))


def redaction_violations(pen: DataFrame | None, markers: DataFrame | None, policy: str) -> DataFrame:
    """Stored rows that break the policy, counted per recording and table; either table may be absent.

    Marker payloads are judged without pen data too, and pen data without markers has no task structure.
    """
    _known(policy, REDACTION_POLICIES, "redaction policy")
    if pen is None and markers is None:
        raise ValueError("neither pen nor markers to judge")
    if policy == "none":
        return _counted((pen if pen is not None else markers).limit(0), "pen")
    found = []
    if pen is not None:
        stored = F.col("x").isNotNull() | F.col("y").isNotNull()
        if policy == "all_xy" or markers is None:
            found.append(_counted(pen.where(stored), "pen"))
        else:
            found.append(_counted(_exposed(pen, markers).where("_blank").where(stored), "pen"))
    if markers is not None and PAYLOAD_COLUMN in markers.columns:
        found.append(_counted(markers.where(holds_coordinates(F.col(PAYLOAD_COLUMN))), "markers"))
    return union_all(found) if found else _counted(markers.limit(0), "markers")


def inconsistent_values(manifest: DataFrame, column: str, allowed: tuple[str, ...]) -> DataFrame:
    """Violations of a fact that must be known and equal in all rows: value, rows, known."""
    counted = manifest.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("rows"))
    marked = counted.withColumn("known", F.coalesce(F.col("value").isin(*allowed), F.lit(False)))
    several = counted.limit(2).count() > 1
    return marked if several else marked.where("NOT known")


def redaction_policy_problems(manifest: DataFrame) -> DataFrame:
    return inconsistent_values(manifest, "redaction_policy", REDACTION_POLICIES)


def time_origin_problems(manifest: DataFrame) -> DataFrame:
    return inconsistent_values(manifest, "time_origin", TIME_ORIGINS)


def recording_span(tables: dict[str, DataFrame]) -> DataFrame:
    """First and last instant of each recording over all of its tables."""
    spans = union_all([table_span(t) for t in tables.values()])
    return spans.groupBy("recording_id").agg(
        F.coalesce(F.min("t_start_ns"), F.lit(0).cast("bigint")).alias("t_start_ns"),
        F.coalesce(F.max("t_end_ns"), F.lit(0).cast("bigint")).alias("t_end_ns"))


def rebase_table(table: DataFrame, origins: DataFrame) -> DataFrame:
    """Subtract each recording's origin from every absolute clock column of one table.

    ``origins``: recording_id, origin_ns.  Whole milliseconds stay whole by flooring the origin.
    """
    rows = attach(table, origins.select("recording_id", F.col("origin_ns").alias("_origin")),
                  ["recording_id"], costly=True)
    origin = F.coalesce(F.col("_origin"), F.lit(0).cast("bigint"))
    types = dict(table.dtypes)
    moved = {c: F.col(c) - origin for c in NS_COLUMNS if c in types}
    moved |= {c: rebased_ms(F.col(c), origin, whole=types[c] in ("int", "bigint"))
              for c in MS_COLUMNS if c in types}
    if PAYLOAD_COLUMN in types:
        moved[PAYLOAD_COLUMN] = rebase_payload(F.col(PAYLOAD_COLUMN), origin)
    return rows.withColumns(moved).select(*table.columns)


def rebase(tables: dict[str, DataFrame], origin: str) -> dict[str, DataFrame]:
    """All tables with the recording's first instant at 0, or unchanged for ``unix_epoch``."""
    if _known(origin, TIME_ORIGINS, "time origin") == "unix_epoch":
        return dict(tables)
    origins = recording_span(tables).select("recording_id", F.col("t_start_ns").alias("origin_ns"))
    return {name: rebase_table(table, origins) for name, table in tables.items()}


def leak_sql(column: str, kind: str) -> str | None:
    """SQL that tells whether a number of a column of this name and type reads as a Unix time; None where it never can."""
    if column not in ("recording_id", "seq") and (kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal")):
        return in_any_sql(f"`{column}`", UNIX_NS_RANGE if column in NS_COLUMNS else UNIX_RANGES)
    return None


def leak_test(column: str, kind: str) -> Column | None:
    """Does a value of a column of this name and type, payloads included, read as a Unix time?  None where it never can."""
    if column == PAYLOAD_COLUMN:
        return payload_holds_unix_time(F.col(column))
    sql = leak_sql(column, kind)
    return None if sql is None else F.coalesce(F.expr(sql), F.lit(False))


def epoch_columns(table: DataFrame) -> DataFrame:
    """(recording_id, column) still holding a Unix time, payload numbers included.

    Nanosecond columns are only tested against nanosecond dates: 17 minutes after the recording
    start they pass through values that would read as a date in milliseconds.
    """
    tests = {c: test for c, kind in table.dtypes if (test := leak_test(c, kind)) is not None}
    flagged = table.select("recording_id", *[test.alias(c) for c, test in tests.items()])
    held = flagged.groupBy("recording_id").agg(*[F.bool_or(c).alias(c) for c in tests])
    hits = F.array(*[F.when(F.col(c), F.lit(c)) for c in tests])
    return held.select("recording_id", F.explode(F.array_compact(hits)).alias("column"))
