"""One injected fault per check on otherwise sound streams."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from motionloom.plans import validate as V
from motionloom.sources.bundle import without_nan
from motionloom.vocabulary import VECTORS

T0 = 1_780_000_000_000_000_000


def sound(n=400, hz=100, seed=1, still=0.0, with_gravity=True):
    rng = np.random.default_rng(seed)
    q = rng.normal(size=(n, 4))
    q /= np.linalg.norm(q, axis=1, keepdims=True)
    q[:30] = (0, 0, 0, 1)  # lying flat
    x, y, z, w = q.T
    gravity = np.stack([-2 * (x * z - w * y), -2 * (y * z + w * x), 2 * (x * x + y * y) - 1], axis=1)
    gyro = rng.normal(0, 0.15, (n, 3))
    gyro[: int(n * still)] = 0.001
    out = {"t_ns": T0 + np.arange(n) * (10**9 // hz), "gyro": gyro, "quat": q}
    if with_gravity:
        out |= {"accel_user": rng.normal(0, 0.04, (n, 3)), "gravity": gravity}
    else:
        out |= {"accel_total": gravity + rng.normal(0, 0.005, (n, 3))}
    return out


COLUMNS = [c for cols in VECTORS.values() for c in cols]


def table(spark, data, rid="r"):
    return many(spark, {rid: data})


def many(spark, streams):
    """One table of several recordings; vectors a recording lacks are NULL."""
    frames = []
    for rid, data in streams.items():
        frame = pd.DataFrame({"recording_id": rid, "t_ns": data["t_ns"], "seq": np.arange(len(data["t_ns"]))})
        for vector, columns in VECTORS.items():
            frame[list(columns)] = data.get(vector, np.full((len(frame), len(columns)), np.nan))
        frames.append(frame)
    schema = "recording_id string, t_ns bigint, seq bigint, " + ", ".join(f"{c} double" for c in COLUMNS)
    held = [c for c in COLUMNS if any(f[c].notna().any() for f in frames)]
    return without_nan(spark.createDataFrame(pd.concat(frames), schema)).select("recording_id", "t_ns", "seq", *held)


FACTS = {"watch_hz_nominal": 100.0, "head_hz_nominal": None, "time_origin": "unix_epoch", "accel_semantics": "user",
         "time_alignment": "shared_clock", "session_start_ns": T0}
META = ("recording_id string, watch_hz_nominal double, head_hz_nominal double, time_origin string, accel_semantics string, "
        "time_alignment string, session_start_ns bigint")


def meta(spark, facts):
    return spark.createDataFrame([(rid, *(FACTS | own).values()) for rid, own in facts.items()], META)


def check(spark, streams):
    """Findings of many recordings from one run: {recording: {check: finding}}."""
    watch = many(spark, {rid: data for rid, (data, _) in streams.items()})
    out = {rid: {} for rid in streams}
    for r in V.check_tables({"watch": watch}, meta(spark, {rid: f for rid, (_, f) in streams.items()})).collect():
        out[r.recording_id][r.check] = r
    return out


FAULTS = {
    "gravity in m/s2": (lambda d: d | {"gravity": d["gravity"] * 9.80665}, {}, {"gravity_norm"}),
    "gravity upside down": (lambda d: d | {"gravity": -d["gravity"]}, {}, {"gravity_sign", "quat_gravity_agreement"}),
    "user and total mixed": (lambda d: d | {"accel_user": np.full_like(d["accel_user"], 0.3)}, {}, {"accel_semantic_band"}),
    "angular rate in degrees": (lambda d: d | {"gyro": d["gyro"] * 2865}, {}, {"gyro_range"}),
    "scalar-first quaternion": (lambda d: d | {"quat": np.roll(d["quat"], 1, axis=1)}, {}, {"quat_gravity_agreement"}),
    "unnormalised quaternion": (lambda d: d | {"quat": d["quat"] * 1.01}, {}, {"quat_norm"}),
    "wrong nominal rate": (lambda d: d, {"watch_hz_nominal": 50.0}, {"sample_rate"}),
    "backward time": (lambda d: d | {"t_ns": np.concatenate([d["t_ns"][:10], d["t_ns"][9:10] - 1, d["t_ns"][11:]])}, {}, {"time_monotonic"}),
    "session-relative clock": (lambda d: d | {"t_ns": d["t_ns"] - T0}, {"session_start_ns": 0}, {"time_magnitude"}),
    "late session start": (lambda d: d, {"session_start_ns": T0 + 61 * 10**9}, {"spill_guard"}),
    "unknown alignment": (lambda d: d, {"time_alignment": "roughly"}, {"time_alignment_vocabulary"}),
    "semantics without columns": (lambda d: d, {"accel_semantics": "total"}, {"accel_semantics_matches_columns"}),
    "date left after rebasing": (lambda d: d, {"time_origin": "recording_start"}, {"time_magnitude", "no_unix_timestamps"}),
}


@pytest.fixture(scope="module")
def found(spark):
    streams = {name: (change(sound()), facts) for name, (change, facts, _) in FAULTS.items()}
    turned = sound(2000, with_gravity=False, still=0.3)
    streams |= {
        "sound": (sound(), {}), "few": (sound(90), {}),
        "80 Hz": (sound(hz=80), {}), "80 Hz undeclared": (sound(hz=80), {"watch_hz_nominal": None}),
        "still": (sound(2000, with_gravity=False, still=0.3), {"accel_semantics": "total"}),
        "still, turned": (turned | {"quat": np.roll(turned["quat"], 1, axis=1)}, {"accel_semantics": "total"}),
        "restless": (sound(2000, with_gravity=False), {"accel_semantics": "total"})}
    return check(spark, streams)


def test_sound_stream_passes_everything(found):
    sound_checks = found["sound"]
    assert all(r.passed for r in sound_checks.values()), [c for c, r in sound_checks.items() if not r.passed]
    assert set(sound_checks) >= {
        "time_monotonic", "sample_rate", "accel_semantic_band", "gravity_norm", "gravity_sign", "gyro_range", "quat_norm",
        "quat_gravity_agreement", "time_magnitude", "spill_guard", "accel_semantics_matches_columns",
        "time_alignment_vocabulary"}
    assert "quat_still_agreement" not in sound_checks and "streams_overlap" not in sound_checks


@pytest.mark.parametrize("fault", FAULTS)
def test_each_fault_fails_its_check_only(found, fault):
    assert {c for c, r in found[fault].items() if not r.passed} == FAULTS[fault][2]


def test_rate_limit_is_exclusive_and_an_undeclared_rate_passes(found):
    assert not found["80 Hz"]["sample_rate"].passed  # exactly 20 % off
    assert found["80 Hz undeclared"]["sample_rate"].passed


def test_fallback_without_gravity_needs_still_samples(found):
    assert found["still"]["quat_still_agreement"].passed and found["still"]["quat_still_agreement"].observed_num < 5
    assert not found["still, turned"]["quat_still_agreement"].passed
    restless = found["restless"]["quat_still_agreement"]
    assert not restless.passed and restless.observed == "0 still samples"


def test_few_quaternions_give_no_finding(found):
    assert not {"quat_norm", "quat_gravity_agreement"} & set(found["few"])


def test_overlap_and_dropouts(spark):
    later = sound(3000, seed=8) | {"t_ns": sound(3000)["t_ns"] + 60 * 10**9}
    watch = many(spark, {rid: sound(3000) for rid in ("brief", "apart")})
    head = many(spark, {"brief": sound(2), "apart": later})
    rows = V.check_tables({"watch": watch, "headimu": head}, meta(spark, {"brief": {}, "apart": {}})).collect()
    checks = {(r.recording_id, r.check): r for r in rows}
    assert checks["brief", "modality_dropout"].modality == "headimu" and ("brief", "streams_overlap") not in checks
    assert not checks["apart", "streams_overlap"].passed and checks["apart", "streams_overlap"].observed_num < -30
    assert ("apart", "modality_dropout") not in checks


def test_physics_is_the_same_when_groups_are_cut(tiny_tasks):
    spark = tiny_tasks
    data = sound(160, with_gravity=False, still=0.8)
    spark.conf.set("spark.motionloom.rowsPerTask", "60")
    cut = {r.measure: (r.n, r.median, r.iqr) for r in V.physics(V.all_motion({"watch": table(spark, data)})).collect()}
    spark.conf.set("spark.motionloom.rowsPerTask", "100000")
    whole = {r.measure: (r.n, r.median, r.iqr) for r in V.physics(V.all_motion({"watch": table(spark, data)})).collect()}
    assert cut.keys() == whole.keys()
    for name in whole:
        assert np.allclose(cut[name], whole[name], rtol=1e-9, atol=1e-12)
