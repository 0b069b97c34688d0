"""Redaction, rebasing and leaked clocks."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from motionloom.functions import payload as J
from motionloom.operators import privacy as P

S = 1_000_000_000
MARKER = "recording_id string, t_ns bigint, event string, task_id string, task_index double, src_payload string"


def pen_of(spark, rid="r"):
    return spark.createDataFrame([(rid, t * S, t, 1.0, 2.0) for t in (10, 26, 45, 60)],
                                 "recording_id string, t_ns bigint, seq bigint, x double, y double")


def markers_of(spark, rows):
    return spark.createDataFrame([("r", t * S, e, task, i, p) for t, e, task, i, p in rows], MARKER)


FREE = [(5, "task_start", "text_copying", 0.0, ""), (20, "task_end", "text_copying", 0.0, ""),
        (26, "task_start", "free_writing", 1.0, ""), (45, "task_end", "free_writing", 1.0, "")]


def kept(df):
    return [r.seq for r in df.where("x IS NOT NULL").orderBy("seq").collect()]


def test_policies(spark):
    pen, markers = pen_of(spark), markers_of(spark, FREE)
    assert kept(P.redact_coordinates(pen, markers, "none")) == [10, 26, 45, 60]
    assert kept(P.redact_coordinates(pen, markers, "free_writing_xy")) == [10, 60]  # both ends included
    assert kept(P.redact_coordinates(pen, markers, "all_xy")) == []
    with pytest.raises(ValueError, match="unknown redaction policy"):
        P.redact_coordinates(pen, markers, "some")
    assert P.redact_coordinates(pen, markers, "free_writing_xy").count() == 4


@pytest.mark.parametrize("rows", [[], [(5, "phase", "", None, "")], [(5, "phase", None, None, "")], [(5, "phase", "  ", None, "")]])
def test_without_task_names_everything_is_blank(spark, rows):
    assert kept(P.redact_coordinates(pen_of(spark), markers_of(spark, rows), "free_writing_xy")) == []


def test_a_task_without_end_blanks_nothing_but_is_listed(spark):
    markers = markers_of(spark, FREE[:3])
    assert kept(P.redact_coordinates(pen_of(spark), markers, "free_writing_xy")) == [10, 26, 45, 60]
    row = P.unbounded_free_writing(markers).first()
    assert (row.task_index, row.has_start, row.has_end) == (1.0, True, False)


def test_audit_finds_what_redaction_removes(spark):
    pen, markers = pen_of(spark), markers_of(spark, [*FREE, (50, "note", "math", 2.0, '{"tip": [{"x": 1}]}')])
    found = {r.modality: r.violations for r in P.redaction_violations(pen, markers, "free_writing_xy").collect()}
    assert found == {"pen": 2, "markers": 1}
    clean = P.redact_payload_coordinates(markers, "free_writing_xy")
    assert P.redaction_violations(P.redact_coordinates(pen, markers, "free_writing_xy"), clean, "free_writing_xy").isEmpty()
    assert P.redact_payload_coordinates(markers, "none") is markers


@pytest.mark.parametrize("text, want", [('{"x": 1, "a":  [1.50]}', {"a": [1.5]}), ('{"a": {"y": 1, "b": [{"x": 2}]}}', {"a": {"b": [{}]}})])
def test_payload_coordinates_leave_at_any_depth(spark, text, want):
    df = spark.createDataFrame([(text,), ('{"a":  1.50}',), ("",), (None,)], "p string")
    got = [r[0] for r in df.select(J.strip_coordinates(F.col("p"))).collect()]
    assert json.loads(got[0]) == want and got[1:] == ['{"a":  1.50}', "", None]


def test_payload_allow_list(spark):
    df = spark.createDataFrame([('{"idx": 2, "screen": 1, "tilt": {"x": 1}}',), ("[1]",), ("7",), ("nope",), (" ",), (None,)], "p string")
    got = [(r.p.payload, r.p.dropped) for r in df.select(J.allowed_payload(F.col("p")).alias("p")).collect()]
    assert got == [('{"idx": 2, "tilt": {"x": 1}}', 1)] + [("", 0)] * 5


def test_a_payload_that_is_no_object_is_refused(spark):
    with pytest.raises(Exception, match="not a JSON object"):
        spark.createDataFrame([("[1]",)], "p string").select(J.holds_coordinates(F.col("p"))).collect()


def test_rebase_moves_every_clock_of_a_recording_together(spark):
    t0 = 1_780_000_000_123_456_789
    watch = spark.createDataFrame([("r", t0 + 5, 0, t0 // 10**6 + 7)], "recording_id string, t_ns bigint, seq bigint, src_local_ts_ms bigint")
    pen = spark.createDataFrame([("r", t0, 0, 1_700_000_000_000.5)], "recording_id string, t_ns bigint, seq bigint, src_timestamp double")
    span = spark.createDataFrame([("r", t0 + 10, t0 + 90)], "recording_id string, t_start_ns bigint, t_end_ns bigint")
    payload = json.dumps({"time_origin_ms": t0 // 10**6 + 3, "session_start_t_ms": 12, "idx": t0})
    markers = spark.createDataFrame([("r", t0 + 1, payload), ("r", t0 + 2, '{"idx":  1}')], "recording_id string, t_ns bigint, src_payload string")
    tables = {"watch": watch, "pen": pen, "attention": span, "markers": markers}
    assert P.rebase(tables, "unix_epoch") == tables
    out = P.rebase(tables, "recording_start")
    assert tuple(out["watch"].select("t_ns", "src_local_ts_ms").first()) == (5, 7)
    assert out["pen"].first().src_timestamp == pytest.approx(1_700_000_000_000.5 - t0 / 1e6)
    assert tuple(out["attention"].select("t_start_ns", "t_end_ns").first()) == (10, 90)
    first, second = (r.src_payload for r in out["markers"].orderBy("t_ns").collect())
    assert json.loads(first) == {"time_origin_ms": 3, "session_start_t_ms": 12, "idx": t0} and second == '{"idx":  1}'
    with pytest.raises(ValueError, match="unknown time origin"):
        P.rebase(tables, "midnight")


def test_leaked_clocks(spark):
    df = spark.createDataFrame([("r", 10**12, 1.78e12, 17 * 86_400_000, '{"a": [{"b": 1780000000000}]}', "1780000000000")],
                               "recording_id string, t_ns bigint, other double, uptime_ms bigint, src_payload string, note string")
    assert {r.column for r in P.epoch_columns(df).collect()} == {"other", "src_payload"}


def test_archive_facts_must_agree(spark):
    df = spark.createDataFrame([("a", "none"), ("b", "none")], "recording_id string, redaction_policy string")
    assert P.redaction_policy_problems(df).isEmpty()
    mixed = df.union(spark.createDataFrame([("c", "all_xy")], "a string, b string"))
    assert P.redaction_policy_problems(mixed).count() == 2
    odd = spark.createDataFrame([("a", "?")], "recording_id string, redaction_policy string")
    assert not P.redaction_policy_problems(odd).first().known


def test_marker_payloads_are_judged_without_pen_data(spark):
    markers = spark.createDataFrame([("A", 1, "e", '{"x": 1, "y": 2}'), ("B", 1, "e", '{"z": 1}')], ["recording_id", "t_ns", "event", "src_payload"])
    found = P.redaction_violations(None, markers, "all_xy").collect()
    assert [tuple(r) for r in found] == [("A", "markers", 1)]
    assert P.redaction_violations(None, markers, "none").count() == 0
    with pytest.raises(ValueError):
        P.redaction_violations(None, None, "all_xy")
