"""Pen rates, clocks, vectors, stillness and resampling."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from motionloom.functions import clock as C
from motionloom.functions import vectors as V
from motionloom.operators import motion as M
from motionloom.operators import pen as P
from motionloom.operators import resample as R
from motionloom.vocabulary import VECTORS

PEN = "recording_id string, t_ns bigint, seq bigint, dot_type string, src_timestamp double"


def pen_of(spark, times, clock=None, downs=(0, 4)):
    rows = [("r", int(t), i, "PEN_DOWN" if i in downs else "PEN_MOVE", None if clock is None else float(clock[i]))
            for i, t in enumerate(times)]
    return spark.createDataFrame(rows, PEN)


def rate_of(pen):
    row = P.dot_rate(pen).first()
    return row.pen_hz_measured, row.pen_hz_clock


def test_pen_clock_decides_even_if_arrival_is_batched(spark):
    clock = [0, 12.5, 25, 37.5, 500, 512.5, 525, 537.5]
    assert rate_of(pen_of(spark, [0, 0, 0, 0, 9, 9, 9, 9], clock)) == (80.0, "src_timestamp")


def test_time_axis_stands_in_unless_batched(spark):
    ms = 1_000_000
    assert rate_of(pen_of(spark, [0, 25 * ms, 50 * ms, 75 * ms, 900 * ms, 925 * ms])) == (40.0, "t_ns")
    fifth = [0, 0, 25 * ms, 50 * ms, 75 * ms, 100 * ms]  # one of five steps is zero
    assert rate_of(pen_of(spark, fifth, downs=(0,)))[1] == "t_ns"
    assert rate_of(pen_of(spark, [0, 0, 0, 25 * ms, 50 * ms, 75 * ms], downs=(0,))) == (None, "")
    assert rate_of(pen_of(spark, [0, 5, 9], downs=(0, 1, 2))) == (None, "")


def test_a_pen_down_without_clock_starts_no_stroke_on_the_pen_clock(spark):
    rows = [("r", 0, 0, "PEN_DOWN", 0.0), ("r", 1, 1, "PEN_MOVE", 10.0), ("r", 2, 2, "PEN_DOWN", None),
            ("r", 3, 3, "PEN_MOVE", 20.0)]
    assert rate_of(spark.createDataFrame(rows, PEN)) == (100.0, "src_timestamp")


def test_nanoseconds_survive_large_clocks(spark):
    df = spark.createDataFrame([(1_780_000_000_123_456_789, 1_780_000_000.25)], "n bigint, s double")
    row = df.select(C.to_unix_ns(F.col("n"), "ns", whole=True).alias("n"), C.to_unix_ns(F.col("s"), "s", whole=False).alias("s"),
                    C.floor_div(-F.col("n"), 1_000_000).alias("f")).first()
    assert row.n == 1_780_000_000_123_456_789 and row.s == 1_780_000_000_250_000_000
    assert row.f == -1_780_000_000_123_456_789 // 1_000_000
    with pytest.raises(ValueError):
        C.to_unix_ns(F.col("n"), "session_relative", whole=True)


def test_median_rate_ignores_order_ties_and_lone_samples(spark):
    rows = [("a", t, i) for i, t in enumerate([30, 0, 10, 10, 20])] + [("b", 5, 0)]
    df = spark.createDataFrame(rows, "recording_id string, t_ns bigint, seq bigint")
    assert {r.recording_id: r.rate_hz for r in M.median_rate_hz(df).collect()} == {"a": 1e8}
    assert {r.recording_id: r.backward_steps for r in M.backward_steps(df).collect()} == {"a": 1, "b": 0}


def rotation(q):
    x, y, z, w = np.asarray(q) / np.linalg.norm(q)
    return np.array([[1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y)],
                     [2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x)],
                     [2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y)]])


def test_gravity_is_the_down_vector_in_the_device_frame(spark):
    quats = np.random.default_rng(1).normal(size=(50, 4)) * 3
    df = spark.createDataFrame([(i, *map(float, q)) for i, q in enumerate(quats)] + [(50, 0.0, 0.0, 0.0, 0.0)],
                               "i int, quat_x double, quat_y double, quat_z double, quat_w double")
    got = df.select("i", *V.gravity_from_quaternion(V.columns_of("quat"))).orderBy("i").collect()
    want = [rotation(q).T @ [0, 0, -1] for q in quats]
    assert np.allclose([list(r)[1:] for r in got[:50]], want)
    assert list(got[50])[1:] == [None, None, None]


def test_norm_statistics_ignore_gaps(spark):
    df = spark.createDataFrame([("r", 3.0, 4.0, 0.0), ("r", 0.0, 1.0, 0.0), ("r", None, 1.0, 1.0), ("q", None, 1.0, 1.0)],
                               "recording_id string, gyro_x double, gyro_y double, gyro_z double")
    rows = {r.recording_id: r for r in M.norm_stats(df, ["gyro"]).collect()}
    assert (rows["r"].n, rows["r"].median, rows["r"].mean, rows["r"].std) == (2, 3.0, 3.0, 2.0)
    assert rows["q"].n == 0 and rows["q"].median is None


@pytest.mark.parametrize("window_rows", [1, 2, 5, 6])
def test_stillness_equals_a_centred_rolling_maximum(tiny_tasks, window_rows):
    import pandas as pd
    rng = np.random.default_rng(window_rows)
    speed = np.where(rng.random(40) < 0.2, 0.5, 0.01)
    speed[[3, 4, 5, 6, 7, 8, 9, 20]] = np.nan
    rows = [("r", i, i, None if math.isnan(v) else float(v), 0.0, 0.0) for i, v in enumerate(speed)]
    df = tiny_tasks.createDataFrame(rows, "recording_id string, t_ns bigint, seq bigint, gyro_x double, gyro_y double, gyro_z double")
    got = [r.still for r in M.still(df, float(window_rows), window_s=1.0).orderBy("seq").collect()]
    want = pd.Series(speed).rolling(window_rows, center=True, min_periods=1).max() < 0.05
    assert got == want.tolist()


def test_user_acceleration_needs_an_orientation(spark):
    total = spark.createDataFrame([("r", 0, 0.0, 0.0, -1.0)], "recording_id string, seq bigint, accel_total_x double, "
                                  "accel_total_y double, accel_total_z double")
    with pytest.raises(ValueError, match="quaternion"):
        M.to_user_acceleration(total)
    with pytest.raises(ValueError, match="neither"):
        M.to_user_acceleration(total.select("recording_id"))
    turned = total.selectExpr("*", "0D AS quat_x", "0D AS quat_y", "0D AS quat_z", "1D AS quat_w")
    row = M.to_user_acceleration(turned).first()
    assert (row.accel_user_x, row.accel_user_y, row.accel_user_z) == (0.0, 0.0, 0.0)


@pytest.mark.parametrize("source, target, factor", [(100, 50, 2), (99.82, 50, 2), (50, 50, 1), (104, 50, 2), (106, 50, None),
                                                    (50, 100, None), (75, 50, None), (150, 50, 3)])
def test_decimation_factor(spark, source, target, factor):
    rates = spark.createDataFrame([("r", float(source))], "recording_id string, rate_hz double")
    assert R.decimation_factors(rates, target).first().factor == factor


def section_filter(x, factor):
    """The anti-alias filter as a plain recursion, one sample after another."""
    response = R.impulse_response(factor)
    return np.array([sum(response[j] * x[i - j] for j in range(min(i + 1, len(response)))) for i in range(len(x))])


def filtered_whole(x, factor):
    edge = R.EDGE
    ext = np.concatenate([2 * x[0] - x[edge:0:-1], x, 2 * x[-1] - x[-2:-edge - 2:-1]])
    lead = len(R.impulse_response(factor))
    forward = section_filter(np.concatenate([np.full(lead, ext[0]), ext]), factor)[lead:]
    back = section_filter(np.concatenate([np.full(lead, forward[-1]), forward[::-1]]), factor)[lead:][::-1]
    return back[edge:-edge]


def sine_table(n=1000):
    t = np.arange(n) / 100.0
    return np.sin(2 * np.pi * 5 * t), np.sin(2 * np.pi * 40 * t)


def test_filter_keeps_slow_and_removes_fast_tones():
    slow, fast = sine_table()
    for tone, low, high in ((slow, 0.95, 1.05), (fast, 0.0, 0.05)):
        kept = R.zero_phase(tone, 2, True, True)[100:-100]
        assert low <= np.abs(kept).max() <= high
    # An even order passes a constant at the bottom of its ripple: 0.05 dB per pass.
    assert np.allclose(R.zero_phase(np.full(60, 3.5), 2, True, True), 3.5 * 10 ** (-0.1 / 20))


def test_filter_equals_the_recursion():
    slow, fast = sine_table(300)
    x = slow + fast + np.linspace(0, 4, 300)
    assert np.allclose(R.zero_phase(x, 2, True, True), filtered_whole(x, 2), atol=1e-9)


def test_blocks_with_halo_equal_filtering_the_whole_recording(tiny_tasks):
    spark = tiny_tasks
    spark.conf.set("spark.motionloom.rowsPerTask", "700")
    rng = np.random.default_rng(5)
    x = rng.normal(size=4000).cumsum()
    rows = [("long", i * 10_000_000, i, float(v), 1.0, -float(v), i) for i, v in enumerate(x)]
    rows += [("same", i * 20_000_000, i, float(v), 1.0, 0.0, i) for i, v in enumerate(x[:50])]
    df = spark.createDataFrame(rows, "recording_id string, t_ns bigint, seq bigint, gyro_x double, gyro_y double, "
                               "gyro_z double, src_sequence bigint")
    factors = spark.createDataFrame([("long", 2), ("same", 1)], "recording_id string, factor int")
    out = R.downsample(df, factors, block_rows=1000).orderBy("recording_id", "t_ns").collect()
    long = [r for r in out if r.recording_id == "long"]
    whole = R.zero_phase(x, 2, True, True)[::2]
    assert [r.src_sequence for r in long] == list(range(0, 4000, 2))
    assert np.allclose([r.gyro_x for r in long], whole, atol=1e-8)
    assert np.allclose([r.gyro_y for r in long], 10 ** (-0.1 / 20))
    assert [r.gyro_x for r in out if r.recording_id == "same"] == [float(v) for v in x[:50]]


@pytest.mark.parametrize("rows, block_rows, scanned", [(1000, 28, 3), (83, 40, 1024), (56, 28, 2), (28, 50, 2)])
def test_border_states_are_scanned_in_levels(spark, monkeypatch, rows, block_rows, scanned):
    """Blocks as short as the mirrored end, scans over several levels, a recording of one block, and one with a column it lacks."""
    monkeypatch.setattr(R, "SCANNED", scanned)
    x = np.random.default_rng(6).normal(size=rows).cumsum()
    held = [("a", i, i, float(v), float(v) ** 2, None) for i, v in enumerate(x)] + [("b", i, i, -float(v), 1.0, 2.0) for i, v in enumerate(x[:40])]
    df = spark.createDataFrame(held, "recording_id string, t_ns bigint, seq bigint, gyro_x double, gyro_y float, gyro_z double")
    factors = spark.createDataFrame([("a", 3), ("b", 2)], "recording_id string, factor int")
    out = R.downsample(df, factors, block_rows=block_rows).orderBy("recording_id", "t_ns").collect()
    for name, values, factor in (("a", x, 3), ("b", -x[:40], 2)):
        mine = [r for r in out if r.recording_id == name]
        assert np.allclose([r.gyro_x for r in mine], R.zero_phase(values, factor, True, True)[::factor], atol=1e-9)
    assert {r.gyro_z for r in out if r.recording_id == "a"} == {None}


def test_downsampling_refuses_gaps_and_short_recordings(spark):
    schema = "recording_id string, t_ns bigint, seq bigint, gyro_x double, gyro_y double, gyro_z double"
    factors = spark.createDataFrame([("r", 2)], "recording_id string, factor int")
    gap = spark.createDataFrame([("r", i, i, None if i == 7 else 1.0, 1.0, 1.0) for i in range(60)], schema)
    with pytest.raises(ValueError, match="missing values"):
        R.downsample(gap, factors)
    short = spark.createDataFrame([("r", i, i, 1.0, 1.0, 1.0) for i in range(20)], schema)
    with pytest.raises(ValueError, match="more than 27"):
        R.downsample(short, factors)
    with pytest.raises(ValueError, match="positive"):
        R.decimation_factors(factors, 0)


def test_zero_quaternions_are_refused(spark):
    columns = [*VECTORS["accel_total"], *VECTORS["quat"]]
    rows = spark.createDataFrame([("A", *[1.0] * 3, 0.0, 0.0, 0.0, 1.0), ("B", *[1.0] * 3, 0.0, 0.0, 0.0, 0.0)], ["recording_id", *columns])
    assert [tuple(r) for r in M.zero_attitudes(rows).collect()] == [("B", 1)]
    with pytest.raises(ValueError, match="length zero: B"):
        M.to_user_acceleration(rows)
    assert M.to_user_acceleration(rows.where("recording_id = 'A'")).count() == 1


def test_every_recording_needs_a_decimation_factor(spark):
    rows = spark.createDataFrame([("A", 1, 1), ("B", 1, 1)], ["recording_id", "t_ns", "seq"])
    for factors in ([("A", 2)], [("A", 2), ("B", None)]):
        with pytest.raises(ValueError, match="no decimation factor for B"):
            R.downsample(rows, spark.createDataFrame(factors, "recording_id string, factor int"))


def test_clock_text_keeps_whole_numbers_and_fractions(spark):
    df = spark.createDataFrame([("1700000000000000001",), ("1700000000000.5",), (" 12 ",), (None,), ("-0.25",)], "t string")
    got = [tuple(r) for r in df.select(C.text_to_unix_ns(F.col("t"), "ns").alias("ns"), C.cut_to_whole(F.col("t")).alias("w")).collect()]
    assert got == [(1700000000000000001, 1700000000000000001), (1700000000000, 1700000000000), (12, 12), (None, None), (0, 0)]
    ms = df.where("t like '%.%'").select(C.text_to_unix_ns(F.col("t"), "ms").alias("ms")).collect()
    assert [r.ms for r in ms] == [1700000000000500000, -250000]


def test_dot_rate_orders_the_dots_once(spark):
    """Facts, pen-clock strokes and wall-clock strokes come from one layout; against the strokes counted one by one."""
    rng, rows = random.Random(5), []
    for k in range(12):
        t = 0
        for j in range(60):
            t += rng.choice((0, 5, 10)) if k % 3 else 10
            kind = "PEN_DOWN" if rng.random() < 0.15 else rng.choice(("PEN_MOVE", "PEN_UP"))
            rows.append((f"U{k}", t * 1_000_000, j, kind, float(t) * 1.5 if k % 2 and rng.random() < 0.8 else None))
    rows += [("one", 5, 0, "PEN_MOVE", None), ("flat", 5, 0, "PEN_DOWN", 7.0), ("flat", 6, 1, "PEN_MOVE", 7.0)]
    frame = spark.createDataFrame(rows, "recording_id string, t_ns bigint, seq bigint, dot_type string, src_timestamp double")
    found = P.dot_rate(frame)
    want = {}
    for name in dict.fromkeys(r[0] for r in rows):
        dots = sorted((r[1:] for r in rows if r[0] == name), key=lambda r: r[:2])
        logged = [d for d in dots if d[3] is not None]

        def rate(part, at, ticks):
            steps = seconds = 0
            for number in {n for n, _ in part}:
                times = [d[at] for n, d in part if n == number]
                if max(times) > min(times):
                    steps, seconds = steps + len(times) - 1, seconds + (max(times) - min(times)) / ticks
            return round(steps / seconds, 3) if seconds else None

        def numbered_strokes(part):
            return [(sum(x[2] == "PEN_DOWN" for x in part[:i + 1]), d) for i, d in enumerate(part)]
        gaps = [b[0] - a[0] for a, b in zip(dots, dots[1:]) if b[2] != "PEN_DOWN"]
        few = bool(gaps) and gaps.count(0) / len(gaps) <= 0.2
        hz = rate(numbered_strokes(logged), 3, 1e3) if logged else rate(numbered_strokes(dots), 0, 1e9) if few else None
        want[name] = (hz, "" if hz is None else "src_timestamp" if logged else "t_ns")
    got = {r.recording_id: (r.pen_hz_measured, r.pen_hz_clock) for r in found.collect()}
    assert got.keys() == want.keys() and len({c for _, c in want.values()}) == 3
    for name, (hz, clock) in want.items():
        assert got[name][1] == clock and (got[name][0] == hz or abs(got[name][0] - hz) <= 0.001), name
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 1


def test_spans_are_counted_once_however_often_they_are_joined(spark):
    from motionloom.plans.manifest import dropouts, spans
    from motionloom.plans.validate import streams_overlap
    rows = spark.range(100).selectExpr("concat('R', id % 2) AS recording_id", "id AS t_ns", "id AS seq")
    span = spans({m: rows for m in ("watch", "headimu")})
    overlap = streams_overlap(span, dropouts(span))
    assert "Range" not in overlap._jdf.queryExecution().optimizedPlan().toString()  # the tables themselves are not read again
    assert {r.recording_id: (r.modality, r.observed_num, r.passed) for r in overlap.collect()} == {f"R{k}": ("headimu+watch", 0.0, True) for k in range(2)}
