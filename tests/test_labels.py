"""Contact labels, gap closing and attention intervals."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from motionloom.operators import labels as L
from motionloom.plans.label import label_record, label_recordings
from motionloom.plans.select import LabelConfig

MOTION = "recording_id string, t_ns bigint, seq bigint"
PEN = "recording_id string, t_ns bigint, seq bigint, dot_type string"
S = 1_000_000_000


def brute_contact(samples, dots, tolerance_ns):
    """Nearest event by scanning all of them: earlier wins a tie, ties at one time follow arrival."""
    out = {}
    for rid, t, seq in samples:
        own = [d for d in dots if d[0] == rid]
        before = [d for d in own if d[1] < t]
        after = [d for d in own if d[1] >= t]
        best = None
        if before:
            b = max(before, key=lambda d: (d[1], d[2]))
            best = (t - b[1], b)
        if after:
            a = min(after, key=lambda d: (d[1], d[2]))
            if best is None or a[1] - t < best[0]:
                best = (a[1] - t, a)
        out[(rid, seq)] = int(best is not None and best[0] <= tolerance_ns and best[1][3] in ("PEN_DOWN", "PEN_MOVE"))
    return out


def brute_gaps(labels, times, gap_ns):
    out, runs, start = list(labels), [], 0
    for i in range(1, len(labels) + 1):
        if i == len(labels) or labels[i] != labels[start]:
            runs.append((start, i))
            start = i
    for a, b in runs[1:-1]:
        if labels[a] == 0 and times[b - 1] - times[a] <= gap_ns:
            out[a:b] = [1] * (b - a)
    return out


def contact(spark, samples, dots, **options):
    rows = L.contact_labels(spark.createDataFrame(samples, MOTION), spark.createDataFrame(dots, PEN), **options)
    return {(r.recording_id, r.seq): r.label_writing for r in rows.collect()}


def test_tolerance_edge_belongs_to_the_contact(spark):
    dots = [("r", 10 * S, 0, "PEN_DOWN")]
    samples = [("r", 10 * S + 40_000_000, 0), ("r", 10 * S + 40_000_001, 1), ("r", 10 * S, 2)]
    assert contact(spark, samples, dots, tolerance_s=0.04) == {("r", 0): 1, ("r", 1): 0, ("r", 2): 1}


def test_nearest_event_decides_alone_and_shift_comes_first(spark):
    dots = [("r", 100, 0, "PEN_MOVE"), ("r", 130, 1, "PEN_UP")]
    assert contact(spark, [("r", 120, 0)], dots, tolerance_s=1.0) == {("r", 0): 0}
    assert contact(spark, [("r", 115, 0)], dots, tolerance_s=1.0) == {("r", 0): 1}  # tie: earlier
    shifted = contact(spark, [("r", S // 5 + 101, 0)], dots[:1], tolerance_s=1e-9, pen_shift_s=0.2)
    assert shifted == {("r", 0): 1}
    assert contact(spark, [("q", 1, 0)], dots, tolerance_s=1.0) == {("q", 0): 0}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 30)), min_size=1, max_size=25),
       st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 30), st.sampled_from(["PEN_DOWN", "PEN_UP"])), max_size=25),
       st.integers(0, 6))
def test_contact_and_gaps_equal_brute_force(tiny_tasks, samples, dots, tolerance):
    samples = [(r, t, i) for i, (r, t) in enumerate(samples)]
    dots = [(r, t, i, d) for i, (r, t, d) in enumerate(dots)]
    want = brute_contact(samples, dots, tolerance)
    assert contact(tiny_tasks, samples, dots, tolerance_s=tolerance / 1e9) == want
    rows = L.writing_labels(tiny_tasks.createDataFrame(samples, MOTION), tiny_tasks.createDataFrame(dots, PEN),
                            gap_closing_s=5e-9, tolerance_s=tolerance / 1e9)
    closed = {}
    for rid in "ab":
        own = sorted((s for s in samples if s[0] == rid), key=lambda s: (s[1], s[2]))
        values = brute_gaps([want[(rid, s[2])] for s in own], [s[1] for s in own], 5)
        closed |= {(rid, s[2]): v for s, v in zip(own, values)}
    assert {(r.recording_id, r.seq): r.label_writing for r in rows.collect()} == closed


def test_gap_closing_limits(spark):
    def close(labels, step_ns, gap_s):
        rows = [("r", i * step_ns, i, v) for i, v in enumerate(labels)]
        df = spark.createDataFrame(rows, MOTION + ", label_writing tinyint")
        return [r.label_writing for r in L.close_gaps(df, gap_closing_s=gap_s).orderBy("seq").collect()]
    assert close([1, 0, 0, 0, 1], S, 2.0) == [1, 1, 1, 1, 1]
    assert close([1, 0, 0, 0, 1], S, 1.9) == [1, 0, 0, 0, 1]
    assert close([0, 1, 0, 1, 0], S, 9.0) == [0, 1, 1, 1, 0]
    assert close([1, 0], S, 9.0) == [1, 0]
    assert close([1, 0, 1], S, 0) == [1, 0, 1]


def test_attention_is_half_open_and_the_later_interval_wins(spark):
    samples = spark.createDataFrame([("r", t, t) for t in (0, 10, 19, 20, 25, 40)], MOTION)
    spans = spark.createDataFrame([("r", 0, 0, 20, "focused"), ("r", 1, 10, 30, "distracted")],
                                  "recording_id string, seq bigint, t_start_ns bigint, t_end_ns bigint, label string")
    got = {r.seq: r.label_attention for r in L.attention_labels(samples, spans).collect()}
    assert got == {0: "focused", 10: "distracted", 19: "distracted", 20: "distracted", 25: "distracted", 40: None}


def test_block_merge_and_tail(spark):
    blocks = spark.createDataFrame([("r", 0, 0.0, 60.0, "focused", "a"), ("r", 1, 60.0, 90.0, "focused", "b"),
                                    ("r", 2, 90.0, 120.0, "distracted", "c")],
                                   "recording_id string, seq bigint, start_s double, end_s double, label string, activity string")
    truth = spark.createDataFrame([("r", 0, 0.4, "focused"), ("r", 1, 90.0, "distracted")],
                                  "recording_id string, seq bigint, start_s double, label string")
    assert L.block_disagreements(blocks, truth).isEmpty()
    late = truth.selectExpr("recording_id", "seq", "start_s + 0.6 AS start_s", "label")
    assert L.block_disagreements(blocks, late).count() == 2
    span = spark.createDataFrame([("r", 5 * S, 130 * S)], "recording_id string, t_start_ns bigint, t_end_ns bigint")
    assert L.protocol_tail(span, blocks).first().tail_s == pytest.approx(5.0)
    rows = L.anchored_intervals(blocks, span).orderBy("seq").collect()
    assert [(r.t_start_ns, r.t_end_ns) for r in rows] == [(5 * S, 65 * S), (65 * S, 95 * S), (95 * S, 130 * S)]


def test_task_guards(spark):
    with pytest.raises(ValueError, match="unknown task"):
        LabelConfig("reading")
    with pytest.raises(ValueError, match="gap_closing_s"):
        LabelConfig("writing")
    manifest = spark.createDataFrame(
        [("a", True, True, "user", "shared_clock"), ("b", True, True, "total", "shared_clock"),
         ("c", True, False, "user", "shared_clock"), ("d", True, True, "user", "overlap_only")],
        "recording_id string, has_watch boolean, has_pen boolean, accel_semantics string, time_alignment string")
    tables = {"watch": spark.createDataFrame([("a", 0, 0), ("b", 0, 0), ("d", 0, 0)], MOTION),
              "pen": spark.createDataFrame([("a", 0, 0, "PEN_DOWN")], PEN)}
    config = LabelConfig("writing", gap_closing_s=3.0)
    for ids, text in ((["a", "b"], "mixed watch acceleration"), (["c"], "has_pen is false"), (["d"], "overlap_only")):
        with pytest.raises(ValueError, match=text):
            label_recordings(tables, manifest, ids, config)
    with pytest.raises(KeyError):
        label_recordings(tables, manifest, ["zz"], config)
    with pytest.raises(ValueError, match="empty"):
        label_recordings(tables, manifest, [], config)
    mixed = LabelConfig("writing", gap_closing_s=3.0, allow_mixed_accel=True)
    record = label_record(label_recordings(tables, manifest, ["a", "b"], mixed), "writing", manifest)
    assert sorted(map(tuple, record.collect())) == [("a", 1, 1.0, "user"), ("b", 1, 0.0, "total")]
