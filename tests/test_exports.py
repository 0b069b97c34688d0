"""Every export layout, written to a temporary folder and read back as the common model."""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pytest

from motionloom.plans.manifest import build_channels, build_manifest
from motionloom.plans.validate import check_tables, failed
from motionloom.sources import exports as X
from motionloom.sources.files import csv_rows, lines

T0_MS = 1_780_000_000_000


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def csv(path, header, rows):
    write(path, "\n".join([header, *(",".join("" if v is None else str(v) for v in r) for r in rows)]) + "\n")


def unit_quats(n, seed=0):
    q = np.random.default_rng(seed).normal(size=(n, 4))
    return q / np.linalg.norm(q, axis=1, keepdims=True)


def down(q):
    x, y, z, w = q
    return (-2 * (x * z - w * y), -2 * (y * z + w * x), 2 * (x * x + y * y) - 1)


def collect(df, *order):
    return df.orderBy(*order).collect()


# --- files --------------------------------------------------------------------------------------------

def test_csv_files_are_matched_to_their_own_headers(spark, tmp_path):
    csv(tmp_path / "a.csv", "x,y", [(1, 2), (3, 4)])
    csv(tmp_path / "b.csv", "y,note,x", [(20, '"a, ""b"""', 10), (None, "c", 30)])
    rows = collect(csv_rows(spark, f"{tmp_path}/*.csv", ["x", "y", "note"]), "path", "seq")
    assert [(r.x, r.y, r.note) for r in rows] == [("1", "2", None), ("3", "4", None), ("10", "20", 'a, "b"'), ("30", None, "c")]
    with pytest.raises(ValueError, match="missing required"):
        csv_rows(spark, f"{tmp_path}/*.csv", ["note"], ("note",))
    assert csv_rows(spark, f"{tmp_path}/none/*.csv", ["x"]).count() == 0


def test_quoted_values_run_over_line_ends(spark, tmp_path):
    write(tmp_path / "a.csv", 'x,note\r\n1,"one\r\n\r\n""two"", 2"\r\n2,plain\r\n"3","\r\n"\r\n')
    write(tmp_path / "b.csv", 'note,x\n5 o\\clock,4\n"a, b",5\n\n')
    rows = collect(csv_rows(spark, f"{tmp_path}/*.csv", ["x", "note"]), "path", "seq")
    assert [(r.x, r.note) for r in rows] == [("1", 'one\n\n"two", 2'), ("2", "plain"), ("3", "\n"), ("4", "5 o\\clock"), ("5", "a, b")]
    write(tmp_path / "c.csv", 'x,note\n1,"open\n2,b\n')
    with pytest.raises(ValueError, match="do not pair"):
        csv_rows(spark, f"{tmp_path}/*.csv", ["x"])


def test_long_files_with_quoted_line_ends_use_many_tasks(spark, tmp_path):
    write(tmp_path / "long.csv", "x,note\n" + "".join(f'{i},"a\nb {i}"\n' if i % 3 else f"{i},c\n" for i in range(400)))
    old = spark.conf.get("spark.motionloom.rowsPerTask", None)
    spark.conf.set("spark.motionloom.rowsPerTask", "50")
    try:
        rows = collect(csv_rows(spark, f"{tmp_path}/*.csv", ["x", "note"]), "seq")
    finally:
        spark.conf.unset("spark.motionloom.rowsPerTask") if old is None else spark.conf.set("spark.motionloom.rowsPerTask", old)
    assert [(r.x, r.note) for r in rows] == [(str(i), f"a\nb {i}" if i % 3 else "c") for i in range(400)]


def test_session_events_are_complete(spark, tmp_path):
    write(tmp_path / "ok.json", json.dumps({"events": [{"t_ms": 1700000000000.75, "event": "phase", "payload": {"a": 1}}]}))
    got = X.session_events(X.session_files(spark, f"{tmp_path}/ok.json")).collect()
    assert [(r.t_ms, r.event, r.payload) for r in got] == [(1700000000000, "phase", '{"a": 1}')]
    for name, entry in (("time", {"event": "phase"}), ("type", {"t_ms": 5}), ("null", {"t_ms": None, "event": "phase"})):
        write(tmp_path / f"{name}.json", json.dumps({"events": [entry]}))
        with pytest.raises(ValueError, match="without t_ms or type"):
            X.session_events(X.session_files(spark, f"{tmp_path}/{name}.json"))


def test_line_numbers_follow_the_file_across_splits(spark, tmp_path):
    write(tmp_path / "long.txt", "\n".join(f"line {i:06d}" for i in range(5000)) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = lines(spark, f"{tmp_path}/long.txt")
        assert df.rdd.getNumPartitions() > 5
        assert [r.line for r in collect(df, "seq")] == [f"line {i:06d}" for i in range(5000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


# --- server export --------------------------------------------------------------------------------------

def server_root(root, person="P7"):
    write(root / "sessions.csv", "session_id,person_id,study_mode,protocol_id,subject_index,watch_profile,start_time,alignment_sigma\n"
          f"s1,{person},study,v2,3,50hz,2026-05-28T20:26:40Z,0.25\ns2,P8,study,v2,4,100hz,,\n")
    q = unit_quats(6)
    for sid, with_gravity in (("s1", True), ("s2", False)):
        rows = []
        for i in range(6):
            g = down(q[i]) if with_gravity else (None, None, None)
            rows.append((T0_MS + 900, sid, i, 50, T0_MS + 950, "w", T0_MS + 940, T0_MS + 20 * (5 - i),
                         .01, .02, .03, .1, .2, .3, *g, *q[i]))
        csv(root / "watch" / f"{sid}_watch.csv", "local_ts_ms,session_id,sequence,sample_rate_hz,server_received_ms,source,"
            "phone_received_at,ts,ax,ay,az,rx,ry,rz,gx,gy,gz,qx,qy,qz,qw", rows)
    csv(root / "pen" / "s1_pen.csv", "local_ts_ms,timestamp,x,y,pressure,dot_type,tilt_x,tilt_y,section,owner,note,page",
        [(T0_MS, 5000, 1.5, 2.5, 300, "PEN_DOWN", 10, 20, 3, 27, 746, 1), (T0_MS + 13, 5012.5, 1.6, 2.6, 310, "PEN_MOVE", 10, 20, 3, 27, 746, 1)])
    csv(root / "markers" / "s1_markers.csv", "timestamp_ms,event,task_id,task_name,task_index,task_category,protocol_id",
        [(T0_MS, "task_start", "abschreiben", "Abschreiben", 0, "writing", "v2"), (T0_MS + 99, "task_end", "abschreiben", "Abschreiben", 0, "writing", "v2"),
         (T0_MS + 99, "note", None, None, None, None, "v2")])


def test_server_export(spark, tmp_path):
    server_root(tmp_path)
    got = X.server_export(spark, str(tmp_path), "SRV", protocol_prefix="srv_")
    watch = collect(got.tables["watch"].where("recording_id = 'SRV-s1'"), "t_ns")
    assert [r.t_ns for r in watch] == [(T0_MS + 20 * i) * 1_000_000 for i in range(6)]
    assert [r.src_sequence for r in watch] == [5, 4, 3, 2, 1, 0]
    pen = collect(got.tables["pen"], "t_ns")[0]
    assert (pen.dot_type, pen.x, pen.src_timestamp, pen.src_t_session_ms) == ("PEN_DOWN", 1.5, 5000.0, None)
    markers = collect(got.tables["markers"], "seq")
    assert [(r.task_id, r.task_name) for r in markers] == [("text_copying", "Copying a text")] * 2 + [(None, None)]
    meta = {r.recording_id: r for r in got.meta.collect()}
    s1, s2 = meta["SRV-s1"], meta["SRV-s2"]
    assert (s1.participant_id, s1.watch_hz_nominal, s1.gravity_source, s1.pen_model) == ("SRV-P7", 50.0, "measured", "Moleskine Smart Pen NWP-F130")
    assert (s2.watch_hz_nominal, s2.gravity_source, s2.pen_model, s2.pen_delta_sigma) == (100.0, "none", "", None)
    assert s1.session_start_ns == T0_MS * 1_000_000 and s1.protocol_id == "srv_v2"
    manifest = {r.recording_id: r for r in build_manifest(got.tables, got.meta, got.clocks).collect()}
    m = manifest["SRV-s1"]
    assert m.has_gravity and not manifest["SRV-s2"].has_gravity and m.time_domain == "watch_capture_clock"
    assert m.watch_hz_measured == 50.0 and (m.n_writing_tasks, m.n_idle_tasks) == (1, 0)
    assert manifest["SRV-s2"].n_writing_tasks is None and m.alignment_note.startswith("markers, pen timestamps are on server_wall_clock")
    channels = {(r.recording_id, r.modality, r.column): r for r in build_channels(got.tables, got.clocks, got.factors).collect()}
    assert channels["SRV-s1", "pen", "src_timestamp"].time_domain == "pen_device_clock"
    assert channels["SRV-s1", "watch", "gyro_x"].unit == "rad/s"
    assert ("SRV-s2", "watch", "gravity_x") not in channels


def test_server_export_refuses_nameless_and_unlisted_sessions(spark, tmp_path):
    server_root(tmp_path / "a", person="nan")
    with pytest.raises(ValueError, match="person_id"):
        X.server_export(spark, str(tmp_path / "a"), "SRV")
    server_root(tmp_path / "b")
    write(tmp_path / "b" / "sessions.csv", "session_id,person_id\ns1,P1\n")
    with pytest.raises(ValueError, match="without a row"):
        X.server_export(spark, str(tmp_path / "b"), "SRV")


# --- watch app ------------------------------------------------------------------------------------------

def watch_app_root(root, gyro_is_gravity=False):
    d, q = root / "T6", unit_quats(240, 2)
    rows = []
    for i in range(240):
        g = down(q[i])
        gyro = g if gyro_is_gravity else (0.01, 0.0, 0.0)
        rows.append((i, "T6", T0_MS + 10 * i, 10 * i, *g, *gyro, q[i][3], *q[i][:3], "now"))
    csv(d / "imu_samples_rows.csv", "id,session_id,t_ms,t_session_ms,ax,ay,az,gx,gy,gz,qw,qx,qy,qz,created_at", rows)
    csv(d / "pen_events.csv", "t_ms,t_session_ms,type,x,y,force", [
        (T0_MS, 0, "pen_session_sync", None, None, None), (T0_MS + 5, 5, "pen_down", 1, 2, 30),
        (T0_MS + 30, 30, "pen_dot", 1.5, 2, 31), (T0_MS + 60, 60, "pen_up", 2, 2, 0)])
    start = json.dumps({"handedness": "Left ", "pen_name": "LAMY_safari", "user_agent": "x", "screen": {"w": 1}})
    csv(d / "events.csv", "t_ms,t_session_ms,event_type,payload", [
        (T0_MS, 0, "session_start", '"' + start.replace('"', '""') + '"'), (T0_MS + 40, 40, "phase", None)])
    csv(d / "sensor_session.csv", "started_at_ms", [(T0_MS,)])


def test_watch_app_export(spark, tmp_path):
    watch_app_root(tmp_path)
    codes = spark.createDataFrame([("T6", "P01")], "session_code string, participant_id string")
    got = X.watch_app_export(spark, str(tmp_path), "WEB", codes, prefix="WA")
    assert [(r.dot_type, r.pressure) for r in collect(got.tables["pen"], "t_ns")] == [("PEN_DOWN", 30.0), ("PEN_MOVE", 31.0), ("PEN_UP", 0.0)]
    markers = collect(got.tables["markers"], "t_ns", "seq")
    assert [r.event for r in markers] == ["session_start", "pen_session_sync", "phase"]
    assert json.loads(markers[0].src_payload) == {"handedness": "Left ", "pen_name": "LAMY_safari"}
    meta = got.meta.first()
    assert (meta.recording_id, meta.participant_id, meta.handedness) == ("WA-T6", "P01", "left")
    assert meta.pen_model == "LAMY safari all black ncode NWP-F80" and meta.head_model == ""
    assert meta.src_payload_dropped_key_count == 2 and abs(meta.accel_still_bias) < 1e-6
    findings = check_tables({m: t for m, t in got.tables.items() if m != "headimu"}, got.meta)
    ran = {r.check: r.passed for r in findings.where("modality = 'watch'").collect()}
    assert ran["quat_still_agreement"] and ran["quat_norm"] and ran["accel_semantics_matches_columns"]
    with pytest.raises(ValueError, match="known participant"):
        X.watch_app_export(spark, str(tmp_path), "WEB", codes.where("false"))


def test_watch_app_export_refuses_gravity_in_the_gyroscope_columns(spark, tmp_path):
    watch_app_root(tmp_path, gyro_is_gravity=True)
    codes = spark.createDataFrame([("T6", "P01")], "session_code string, participant_id string")
    with pytest.raises(ValueError, match="gravity vector"):
        X.watch_app_export(spark, str(tmp_path), "WEB", codes)


# --- phone logger ----------------------------------------------------------------------------------------

def logger_session(root, name, code, generation, standardised):
    d, q = root / name, unit_quats(30, 3)
    k = 9.80665 if standardised else 1.0
    header = "time,seconds_elapsed," + ",".join(f"{v}{a}" for v in ("rotationRate", "gravity", "acceleration") for a in "XYZ") + \
        ",quaternionW,quaternionX,quaternionY,quaternionZ"

    def rows(gravity_scale):
        return [((T0_MS + 10 * i) * 1_000_000 + 123, i / 100, .1, .2, .3, *(g * gravity_scale for g in down(q[i])),
                 .05 * k, 0, 0, q[i][3], *q[i][:3]) for i in range(30)]
    csv(d / "WristMotion.csv", header, rows(k))
    csv(d / "Headphone.csv", header, rows(9.80665))
    csv(d / "WatchAccelerometerUncalibrated.csv", "time,seconds_elapsed,x,y,z", [((T0_MS + 20 * i) * 1_000_000, i, 0, 0, k) for i in range(15)])
    csv(d / "Metadata.csv", "version,recording epoch time,sensors,sampleRateMs,standardisation",
        [(3, T0_MS, "Accelerometer|Wrist Motion|Annotation", "10|20|", str(standardised).lower())])
    start = {"t_ms": T0_MS, "t_session_ms": 0, "event": "session_start",
             "payload": {"participant_id": code, "handedness": None, "pen_name": "Neosmartpen_M1", "user_agent": "x"}}
    session = {"events": [start, {"t_ms": T0_MS + 1, "event": "phase", "payload": {"phase": {"n": 1}}}]}
    if generation == "flat":
        session["pen_events"] = [{"t_ms": T0_MS + 2, "t_session_ms": 2, "type": "pen_down", "x": 1, "y": 2, "force": 9},
                                 {"t_ms": T0_MS + 9, "type": "pen_dot", "x": 3, "y": 2, "force": 9},
                                 {"t_ms": T0_MS + 9, "type": "pen_session_sync", "secret": 1, "idx": 4}]
    else:
        session["events"].append({"t_ms": T0_MS + 2, "t_session_ms": 2.5, "event": "pen_move", "payload": {
            "x": 1.25, "y": 2, "force": 9, "tilt": {"x": 30, "y": 40}, "timestamp": 77}})
    write(d / "session.json", json.dumps(session))


def test_phone_logger_export(spark, tmp_path):
    logger_session(tmp_path, "S3_a", "S3", "flat", False)
    logger_session(tmp_path, "E1_b", "E1", "nested", True)
    codes = spark.createDataFrame([("S3", "P02"), ("E1", "P02")], "session_code string, participant_id string")
    got = X.phone_logger_export(spark, str(tmp_path), "WEB", codes, prefix="SL", withdrawn_heads=("E1",))
    for rid in ("SL-S3_a", "SL-E1_b"):
        row = collect(got.tables["watch"].where(f"recording_id = '{rid}'"), "t_ns")[3]
        assert row.t_ns == (T0_MS + 30) * 1_000_000 + 123
        assert abs(row.accel_user_x - 0.05) < 1e-12
        assert abs(row.gravity_x ** 2 + row.gravity_y ** 2 + row.gravity_z ** 2 - 1) < 1e-9
    assert [r.recording_id for r in got.tables["headimu"].select("recording_id").distinct().collect()] == ["SL-S3_a"]
    pen = {r.recording_id: r for r in got.tables["pen"].where("dot_type <> 'PEN_DOWN'").collect()}
    assert pen["SL-E1_b"].tilt_x == 30 and pen["SL-E1_b"].src_timestamp == 77 and pen["SL-E1_b"].src_t_session_ms == 2.5
    assert pen["SL-S3_a"].x == 3 and pen["SL-S3_a"].tilt_x is None
    meta = {r.recording_id: r for r in got.meta.collect()}
    assert meta["SL-S3_a"].pen_xy_unit == "webapp_raw" and meta["SL-E1_b"].pen_xy_unit == "sl_webapp_raw"
    assert meta["SL-S3_a"].watch_hz_nominal == 50.0 and meta["SL-S3_a"].handedness == "unknown"
    assert meta["SL-S3_a"].src_payload_dropped_key_count == 2 and meta["SL-E1_b"].src_payload_dropped_key_count == 1
    sync = got.tables["markers"].where("event = 'pen_session_sync'").first()
    assert json.loads(sync.src_payload) == {"idx": 4}
    factor = {(r.recording_id, r.modality, r.column): r.unit_conversion_factor for r in got.factors.collect()}
    assert factor["SL-S3_a", "watch", "accel_user_x"] == 1.0 and factor["SL-S3_a", "headimu", "gravity_x"] == 1 / 9.80665
    assert factor["SL-E1_b", "watch_rawaccel", "accel_total_z"] == 1 / 9.80665
    manifest = build_manifest(got.tables, got.meta, got.clocks, got.withdrawn)
    codes = {r.recording_id: r.issue_codes for r in manifest.collect()}
    assert codes == {"SL-S3_a": "", "SL-E1_b": '[{"code": "modality_withdrawn", "modality": "headimu"}]'}


# --- head study -------------------------------------------------------------------------------------------

def head_root(root, protocol=True, label="focused", stated="3:00"):
    header = ("timestamp_iso,sensor_timestamp_s," + ",".join(f"quaternion_{a}" for a in "xyzw") + ","
              + ",".join(f"{v}_{a}_{u}" for v, u in (("rotation_rate", "rad_s"), ("gravity", "g"), ("user_acceleration", "g")) for a in "xyz")
              + ",label")
    rows = []
    for i in range(181):
        own = label if i < 60 else "distracted"
        rows.append((f"2026-05-28T20:{26 + i // 60:02d}:{i % 60:02d}.250+00:00", 100 + i, 0, 0, 0, 1, .1, .1, .1, 0, 0, -1, .01, .01, .01, own))
    csv(root / "daten" / "csv-dateien" / "P3_3m00s_airpod_motion_x.csv", header, rows)
    write(root / "protokolle_P" / "P3_ground_truth_1.txt", "Ground truth\n0:00 focused\n1:00   distracted\n")
    if protocol:
        write(root / "protokolle_P" / "P3_protokoll_1.txt", f"Gesamtdauer: {stated} min\nidx | start | ende\n"
              "  1 |   0:00 |   1:00 |   1:00 | focused     | Loesen von Matheaufgaben\n"
              "  2 |   1:00 |   2:00 |   1:00 | distracted  | Ausruhen | ok\n"
              "  3 |   2:00 |   3:00 |   1:00 | distracted  | Handy benutzen\n"
              "  4 |   3:00 |   9:00 |   6:00 | focused     | Ausruhen | ENTFALLEN (Abbruch)\n")


def test_head_study_export(spark, tmp_path):
    head_root(tmp_path)
    got = X.head_study_export(spark, str(tmp_path), "HEAD", protocols=(("P", "head_p"), ("T", "head_t")))
    rows = collect(got.tables["attention"], "t_start_ns")
    t0 = got.tables["headimu"].selectExpr("min(t_ns)").first()[0]
    assert t0 % 1_000_000_000 == 250_000_000
    assert [((r.t_start_ns - t0) // 10**9, (r.t_end_ns - t0) // 10**9, r.label, r.activity) for r in rows] == [
        (0, 60, "focused", "Solving math problems"), (60, 120, "distracted", "Resting"), (120, 180, "distracted", "Using a phone")]
    meta = got.meta.first()
    assert meta.attention_protocol_tail_s == 0.0 and meta.protocol_id == "head_p" and meta.recording_id == "HEAD-P3"
    assert failed(check_tables(got.tables, got.meta)).where("check LIKE 'attention%'").isEmpty()


def test_head_study_without_protocol_and_its_refusals(spark, tmp_path):
    head_root(tmp_path / "a", protocol=False)
    got = X.head_study_export(spark, str(tmp_path / "a"), "HEAD")
    assert [r.activity for r in got.tables["attention"].collect()] == ["", ""]
    head_root(tmp_path / "b", label="distracted")
    with pytest.raises(ValueError, match="contradicts"):
        X.head_study_export(spark, str(tmp_path / "b"), "HEAD")
    head_root(tmp_path / "c", stated="8:00")
    with pytest.raises(ValueError, match="protocol total"):
        X.head_study_export(spark, str(tmp_path / "c"), "HEAD")
    assert X.head_study_export(spark, str(tmp_path / "c"), "HEAD", stale_totals=("HEAD-P3",)).tables["attention"].count() == 3


# --- notebook ---------------------------------------------------------------------------------------------

def test_notebook_export(spark, tmp_path):
    header = "loggingTime(txt),accelerometerTimestamp_sinceReboot(s)," + ",".join(f"accelerometerAcceleration{a}(G)" for a in "XYZ")
    rows = [(f"2026-05-28T20:26:{40 + i}.000Z", 50 + i, 0, 0, -1) for i in (2, 0, 1)]
    csv(tmp_path / "sensorlog" / "private name.csv", header, rows)
    key = hashlib.sha256(str(T0_MS).encode()).hexdigest()[:16]
    sessions = spark.createDataFrame([(key, "04")], "start_key string, number string")
    strokes = spark.createDataFrame([(1, 5), (2, 6)], "stroke_id bigint, page_id bigint")
    points = [(1, 1, T0_MS - 1, 17, 0.0, 0.0, 1.0), (2, 1, T0_MS, 17, 1.0, 2.0, 3.0), (3, 1, T0_MS + 2000, 20, 4.0, 5.0, 6.0),
              (4, 1, T0_MS + 2001, 18, 0.0, 0.0, 1.0), (5, 2, T0_MS + 9000, 18, 0.0, 0.0, 1.0)]
    schema = "point_id bigint, stroke_id bigint, date_ms bigint, draw_type int, page_x double, page_y double, pen_pressure double"
    got = X.notebook_export(spark, str(tmp_path), strokes, spark.createDataFrame(points, schema), sessions, "NOTE")
    assert [(r.recording_id, r.dot_type, r.x) for r in collect(got.tables["pen"], "t_ns")] == [("NOTE-S04", "PEN_DOWN", 1.0), ("NOTE-S04", "PEN_UP", 4.0)]
    assert got.meta.first().participant_id == "NOTE-P04"
    both = spark.createDataFrame([*points[:4], (6, 2, T0_MS + 1000, 18, 0.0, 0.0, 1.0)], schema)
    with pytest.raises(ValueError, match="exactly one notebook page"):
        X.notebook_export(spark, str(tmp_path), strokes, both, sessions, "NOTE")
    with pytest.raises(ValueError, match="no session number"):
        X.notebook_export(spark, str(tmp_path), strokes, both, sessions.where("false"), "NOTE")
    with pytest.raises(ValueError, match="no recordings"):
        X.notebook_export(spark, str(tmp_path), strokes, both, sessions, "NOTE", excluded=(key,))
