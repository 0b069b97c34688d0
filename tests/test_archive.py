"""A collection written, read, rechecked, tampered with, selected and exported."""

from __future__ import annotations

import json
import pathlib
import shutil

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from motionloom.plans import select as Q
from motionloom.plans import validate as V
from motionloom.plans.label import label_recordings
from motionloom.plans.manifest import build_channels, build_manifest
from motionloom.sources import bundle, sinks, zones
from motionloom.sources import publish as P
from motionloom.sources.files import lines
from motionloom.vocabulary import MODALITIES

from .test_validate import T0, many, sound

PEN = "recording_id string, t_ns bigint, seq bigint, dot_type string, x double, y double, pressure double, src_timestamp double"


def collection(spark):
    user, slow = sound(400), sound(300, hz=50, seed=4)
    total = sound(2000, with_gravity=False, still=0.3)
    watch = many(spark, {"A": user, "B": slow, "C": total})
    pen = spark.createDataFrame([(rid, T0 + i * 12_500_000, i, "PEN_DOWN" if i % 10 == 0 else "PEN_MOVE", 1.0, 2.0, 3.0, i * 12.5)
                                 for rid in "AB" for i in range(40)], PEN)
    ids = spark.createDataFrame([("A", "user", 100.0, "ncode_grid"), ("B", "user", 50.0, "webapp_raw"), ("C", "total", 100.0, "")],
                                "recording_id string, accel_semantics string, watch_hz_nominal double, pen_xy_unit string")
    meta = ids.withColumns({
        "participant_id": F.concat(F.lit("P"), "recording_id"), "cohort": F.lit("X"), "pipeline": F.lit("p"),
        "time_alignment": F.lit("shared_clock"), "watch_model": F.lit("Apple Watch Series 6"),
        "pen_model": F.when(F.col("recording_id") != "C", "unknown").otherwise(""), "session_start_ns": F.lit(T0)})
    clocks = ids.select("recording_id", F.explode(F.array(F.lit("watch"), F.lit("pen"))).alias("modality"),
                        F.lit(None).cast("string").alias("column"), F.lit("wall").alias("time_domain"))
    tables = {"watch": watch, "pen": pen}
    return tables, build_manifest(tables, meta, clocks), build_channels(tables, clocks)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("archive") / "data")
    tables, manifest, channels = collection(spark)
    sinks.write_collection(tables, manifest, channels, root)
    return root


def opened(spark, root):
    return (bundle.scan_manifest(spark, root, strict=True), bundle.scan_channels(spark, root, strict=True),
            {m: bundle.scan_modality(spark, root, m) for m in bundle.stored_modalities(spark, root)})


def test_stored_collection_passes_its_own_recheck(spark, stored):
    manifest, channels, tables = opened(spark, stored)
    findings = V.validate_archive(manifest, channels, tables)
    assert V.failed(findings).isEmpty(), V.failed(findings).collect()
    assert set(findings.columns) == set(V.FINDING)
    assert V.strict_gate(findings).count() == findings.count()
    summary = {r.check: r.findings for r in V.summary(findings).collect()}
    assert summary["time_monotonic"] == 3 and summary["quat_still_agreement"] == 1


@pytest.mark.parametrize("what, change, text", [
    ("manifest", lambda m, c, t: (m.withColumn("n_samples_pen", F.lit(1).cast("bigint")), c, t), "differs from the stored tables"),
    ("channels", lambda m, c, t: (m, c.where("column <> 'gyro_x'"), t), "do not describe"),
    ("orphan", lambda m, c, t: (m.withColumn("has_pen", F.lit(False)), c, t), "orphan tables"),
    ("policy", lambda m, c, t: (m.withColumn("redaction_policy", F.lit("all_xy")), c, t), "violate the policy"),
    ("stamp", lambda m, c, t: (m, c, t | {"pen": t["pen"].withColumn("schema_version", F.lit("0.1"))}), "schema version"),
    ("twice", lambda m, c, t: (m.union(m), c, t), "duplicate recording_id"),
    ("column", lambda m, c, t: (m.drop("cohort"), c, t), "contract columns"),
    ("sample", lambda m, c, t: (m, c, t | {"watch": t["watch"].withColumn("t_ns", F.col("t_ns") + F.when(
        F.col("seq") == 399, 7).otherwise(0))}), "differs from the stored tables"),
])
def test_tampering_is_noticed(spark, stored, what, change, text):
    with pytest.raises(ValueError, match=text):
        V.validate_archive(*change(*opened(spark, stored)))


def test_gate_stops_on_any_failure(spark, stored):
    manifest, channels, tables = opened(spark, stored)
    late = V.check_tables(tables, manifest.withColumn("time_alignment", F.lit("roughly")))
    with pytest.raises(ValueError, match="nothing was published"):
        V.strict_gate(late)


def test_loading_guards(spark, stored):
    manifest, channels, tables = opened(spark, stored)

    def load(ids, modality="watch", **options):
        return Q.load_recordings(tables[modality], manifest, ids, modality, channels=channels, **options)
    with pytest.raises(ValueError, match="mixed acceleration semantics"):
        load(["A", "C"])
    with pytest.raises(ValueError, match="mixed watch sample rates"):
        load(["A", "B"])
    with pytest.raises(KeyError, match="zz"):
        load(["A", "zz"])
    with pytest.raises(ValueError, match="empty"):
        load([])
    with pytest.raises(ValueError, match="mixed pen units"):
        load(["A", "B"], "pen")
    with pytest.raises(FileNotFoundError, match="has_pen is false"):
        load(["C"], "pen")
    with pytest.raises(ValueError, match="unknown modality"):
        Q.load_recordings(tables["pen"], manifest, ["A"], "glove")
    with pytest.raises(ValueError, match="applies to the motion"):
        load(["A"], "pen", target_hz=50.0, allow_mixed_pen_units=True)
    assert load(["A", "B", "A"], allow_mixed_rates=True).groupBy("recording_id", "sample_rate_hz").count().orderBy(
        "recording_id").collect() == [("A", 100.0, 800), ("B", 50.0, 300)]
    even = load(["A", "B"], target_hz=50.0)
    assert even.columns[:2] == ["recording_id", "sample_rate_hz"] and even.count() == 500
    units = load(["A", "B"], "pen", allow_mixed_pen_units=True)
    assert units.columns[:3] == ["recording_id", "pen_xy_unit", "pen_pressure_scale"]


def test_selection_export(spark, stored, tmp_path):
    manifest, channels, tables = opened(spark, stored)
    plain = {m: t.drop("stamped_id", "schema_version") for m, t in tables.items()}
    target = str(tmp_path / "subset")
    sinks.export_selection(plain, manifest, channels, {"digital_pen"}, target, watch_target_hz=50.0)
    subset, described, copied = opened(spark, target)
    assert sorted(r[0] for r in subset.select("recording_id").collect()) == ["A", "B"]
    a = subset.where("recording_id = 'A'").first()
    assert (a.watch_hz_nominal, a.n_samples_watch) == (50.0, 200)
    assert copied["watch"].where("recording_id = 'A'").count() == 200
    assert described.where("modality = 'watch' AND sample_rate_hz <> 50").isEmpty()
    with pytest.raises(ValueError, match="no recordings"):
        sinks.selection_tables(plain, manifest, channels, {"head_imu"})
    with pytest.raises(KeyError):
        sinks.selection_tables(plain, manifest, channels, {"wings"})
    listed = sinks.parse_checksum_list(lines(spark, f"{target}_sha256"))
    found = sinks.checksum_inventory(spark, target)
    assert sinks.checksum_problems(listed, found).isEmpty()
    victim = next(pathlib.Path(target, "pen").rglob("*.parquet"))
    victim.write_bytes(victim.read_bytes() + b"x")
    pathlib.Path(target, "extra.txt").write_text("?")
    problems = {r.problem for r in sinks.checksum_problems(listed, sinks.checksum_inventory(spark, target)).collect()}
    assert problems == {"content changed", "not listed"}


def test_labels_end_to_end(spark, stored, tmp_path):
    manifest, channels, tables = opened(spark, stored)
    plain = {m: t.drop("stamped_id", "schema_version") for m, t in tables.items()}
    config = Q.LabelConfig("writing", gap_closing_s=1.0, target_hz=50.0)
    ids = Q.eligible_recordings(manifest, config)
    assert sorted(r[0] for r in ids.select("recording_id").collect()) == ["A", "B"]
    labelled = label_recordings(plain, manifest, ids, config)
    sinks.write_labelled(labelled, config, manifest, str(tmp_path / "out"))
    record = {r.recording_id: r for r in spark.read.json(str(tmp_path / "out" / "record")).collect()}
    assert record["A"].n_samples == 200 and record["A"].accel_semantics == "user"
    assert json.loads(record["B"].config)["gap_closing_s"] == 1.0
    assert 0 < record["A"].labelled_share < 1


def test_bundles_of_one_file_per_recording_are_converted(spark, stored, tmp_path):
    manifest, channels, tables = opened(spark, stored)
    source = tmp_path / "bundle"
    for modality in ("watch", "pen"):
        (source / modality).mkdir(parents=True)
        columns = [c for c in tables[modality].columns if c not in ("recording_id", "seq", "stamped_id", "schema_version")]
        for rid in ("A", "B", "C"):
            rows = tables[modality].where(F.col("recording_id") == rid).orderBy("seq").select(*columns).toArrow()
            rows = rows.select([c for c in columns if rows[c].null_count < len(rows)])
            if len(rows):
                floats = {c: "BYTE_STREAM_SPLIT" for c in rows.column_names if pa.types.is_floating(rows.schema.field(c).type)}
                pq.write_table(rows, source / modality / f"{rid}.parquet", use_dictionary=False, column_encoding=floats)
    manifest.write.parquet(str(source / "sessions.parquet"))
    channels.write.parquet(str(source / "channels.parquet"))
    target = str(tmp_path / "converted")
    sinks.convert_bundle(spark, str(source), target)
    again = opened(spark, target)
    key = ["recording_id", "seq", "t_ns", "gyro_x", "accel_total_x"]
    assert sorted(map(tuple, again[2]["watch"].select(key).collect())) == sorted(map(tuple, tables["watch"].select(key).collect())) \
        or again[2]["watch"].select(key).exceptAll(tables["watch"].select(key)).isEmpty()
    session = bundle.bundle_session(spark)
    assert bundle.scan_bundle_modality(session, str(source), "pen", ["A"]).count() == 40
    with pytest.raises(ValueError, match="unknown modality"):
        bundle.scan_bundle_modality(session, str(source), "glove")
    files = sinks.recording_files(spark, str(source), ["watch", "pen"])
    preview = {r.modality: (r.files, r.bytes) for r in sinks.export_preview(files, manifest).collect()}
    assert preview == {m: (n, sum(p.stat().st_size for p in pathlib.Path(source, m).glob("*.parquet"))) for m, n in (("watch", 3), ("pen", 2))}


def test_text_bundles_are_written_and_listed_by_few_tasks(spark, tmp_path):
    """One file per recording, also where its lines come in several batches; folders are not listed by a task each."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = [(f"U{k}", f"{k}:{j}") for k in range(99) for j in range(1 + k % 20)] + [("a/b=c", "x"), (None, "y"), ("U0", None)]
        sinks.write_recording_texts(spark.createDataFrame(rows, "recording_id string, value string"), str(tmp_path / "pen"))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    files = sorted(p for p in (tmp_path / "pen").rglob("*") if p.is_file())
    assert len(files) == 101 and {p.name for p in files} == {"part.txt"}
    assert sorted((tmp_path / "pen" / "recording_id=U39" / "part.txt").read_text().split()) == sorted(f"39:{j}" for j in range(20))
    spark.sparkContext.setJobGroup("listing", "listing")
    listed = sinks.recording_files(spark, str(tmp_path), ["pen"])
    spark.sparkContext.setJobGroup("after", "after")
    status = spark.sparkContext.statusTracker()
    tasks = [status.getStageInfo(s).numTasks for j in status.getJobIdsForGroup("listing") for s in status.getJobInfo(j).stageIds]
    assert tasks and max(tasks) <= 4 * spark.sparkContext.defaultParallelism
    assert listed.where("recording_id LIKE 'U%'").count() == 99
    found = {r.recording_id: r.length for r in listed.collect()}
    assert found["U39"] == 20 * 3 + sum(len(str(j)) for j in range(20)) + 20 and found["U0"] == 4 + 1


@pytest.mark.parametrize("ids", [["007", "7", "2024"], ["2024-01-01", "1e3", "x"], [f"R{k}" for k in range(60)]])
def test_ids_are_stored_as_they_are(spark, tmp_path, ids):
    rows = spark.createDataFrame([(i, k, k) for k, i in enumerate(ids)], "recording_id string, t_ns long, seq long")
    sinks.write_table(rows, str(tmp_path / "pen"))
    again = bundle.scan_modality(spark, str(tmp_path), "pen")
    assert again.schema["recording_id"].dataType.simpleString() == "string"
    assert sorted((r.recording_id, r.seq) for r in again.collect()) == sorted((i, k) for k, i in enumerate(ids))
    listed = sinks.table_files(spark, str(tmp_path), ["pen"]).collect()
    assert {r.recording_id for r in listed} == set(ids) and all(r.length > 0 for r in listed)


def test_only_the_files_of_asked_recordings_are_opened(spark, tmp_path):
    rows = spark.range(4000).selectExpr("concat('R', lpad(id div 100, 3, '0')) AS recording_id", "id AS t_ns", "id AS seq", "'PEN_MOVE' AS dot_type", "double('nan') AS x")
    spark.conf.set("spark.motionloom.rowsPerTask", "250")
    try:
        sinks.write_table(rows, str(tmp_path / "pen"))
    finally:
        spark.conf.unset("spark.motionloom.rowsPerTask")
    stored = bundle.stored_modality(spark, str(tmp_path), "pen")
    names = {p.name for p in (tmp_path / "pen").glob("*.parquet")}
    assert len(names) >= 12 and "file" not in bundle.scan_modality(spark, str(tmp_path), "pen").columns
    asked = spark.createDataFrame([("R007",), ("R021",), ("nobody",)], "recording_id string")
    opened_files = {pathlib.Path(f).name for f in stored.near(asked).inputFiles()}
    holding = {pathlib.Path(r.f).name for r in stored.frame().where("recording_id IN ('R007', 'R021')").select(F.input_file_name().alias("f")).distinct().collect()}
    assert opened_files == holding and 0 < len(opened_files) <= 6
    listed = zones.recordings_of(stored).withColumns({"has_pen": F.lit(True)})
    assert listed.count() == 40
    loaded = Q.load_recordings(stored, listed, ["R021", "R007", "R021"], "pen")
    assert {pathlib.Path(f).name for f in loaded.inputFiles()} >= holding and loaded.count() == 300 and loaded.where("x IS NOT NULL").isEmpty()
    with pytest.raises(KeyError):
        Q.load_recordings(stored, listed, ["nobody"], "pen")
    assert stored.near(asked.where("recording_id = 'nobody'")).isEmpty()
    assert len(stored.files_of(asked, t_from_ns=2000)) < len(stored.files_of(asked)) and stored.files_of(asked, t_to_ns=600) == []
    shutil.rmtree(tmp_path / "pen" / "_zones")
    assert sorted(stored.files_of(asked)) == sorted(str(tmp_path / "pen" / n) for n in holding)


def test_a_refused_release_leaves_its_report_alone(spark, tmp_path):
    root, (tables, manifest, channels) = str(tmp_path / "home"), collection(spark)
    assert P.published(spark, root) is None
    first = P.publish(tables, manifest, channels, root)
    assert P.published(spark, root) == first and V.failed(P.latest_report(spark, root)).isEmpty()
    odd = tables | {"pen": tables["pen"].withColumn("dot_type", F.when(F.col("seq") == 3, "PEN_ODD").otherwise(F.col("dot_type")))}
    with pytest.raises(ValueError, match="nothing was published.*PEN_ODD"):
        P.publish(odd, manifest, channels, root)
    assert P.published(spark, root) == first and len(list((tmp_path / "home" / "releases").iterdir())) == 2  # the release and its list
    assert {(r.check, r.recording_id) for r in V.failed(P.latest_report(spark, root)).collect()} == {("dot_type_vocabulary", "A"), ("dot_type_vocabulary", "B")}
    with pytest.raises(ValueError, match="structure"):
        P.publish(tables, manifest.withColumn("n_samples_pen", F.lit(1).cast("bigint")), channels, root)
    second = P.publish(tables, manifest, channels, root)
    assert P.published(spark, root) == second > first and len(list((tmp_path / "home" / "reports").iterdir())) == 4
    damaged = next((tmp_path / "home" / "releases" / pathlib.Path(second).name / "pen").glob("*.parquet"))
    listed = pathlib.Path(f"{second}_sha256")
    for part in listed.glob("part-*"):
        part.write_text(part.read_text().replace(damaged.name, "other.parquet"))
        (listed / f".{part.name}.crc").unlink(missing_ok=True)
    assert {r.check for r in V.failed(P.audit(spark, second)).collect()} == {"checksum"}


def test_rows_without_tables_drift(spark):
    left = spark.createDataFrame([("a", 1), ("b", None), ("c", 2)], "k string, v int")
    right = spark.createDataFrame([("a", 1), ("b", 3), ("d", 4)], "k string, v int")
    assert {(r.k, r.stored, r.computed) for r in V.differing_values(left, right, ["k"], ["v"]).collect()} == {("b", None, "3"), ("c", "2", None), ("d", None, "4")}
