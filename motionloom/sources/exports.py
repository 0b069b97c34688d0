"""Source exports to the common data model: one function per export layout.

Each reads a whole directory of recordings at once and returns the tables by modality plus the facts
the source declares.  Cohort names, participant lookups and withdrawn streams are arguments: they
are facts of a study, not of a file layout.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clock import ceil_div, cut_to_whole, floor_div, iso_to_unix_ns, text_to_unix_ns, to_unix_ns
from ..functions.payload import allowed_payload
from ..functions.text import listed_rate_hz, lookup, present, session_key
from ..operators.containment import contained, contained_values
from ..operators.labels import (anchored_intervals, block_disagreements, expansion_agreement,
                                inverted_intervals, protocol_tail)
from ..operators.layout import attach, durable, union_all
from ..operators.motion import (gravity_lookalikes, harmonise_gravity, median_rate_hz,
                                norm_stats, scale_acceleration, still_bias, table_span)
from ..plans.manifest import refuse
from ..vocabulary import (ACTIVITY_NAMES, DROPPED_BLOCK_STATUS, EXPANSION_MIN_AGREEMENT, HANDEDNESS,
                          HEAD_MODELS, NOTEBOOK_DRAW_TYPES, PEN_EVENTS_FLAT, PEN_EVENTS_NESTED,
                          PEN_MODEL_BY_NAME, PEN_MODELS, PEN_NON_STROKE_EVENTS, STATED_TOTAL_WORD,
                          TASK_NAMES, VECTORS, WATCH_MODELS)
from .files import csv_rows, existing_lines, file_names, path_part

PEN_COLUMNS = ["recording_id", "seq", "t_ns", "dot_type", "x", "y", "pressure", "tilt_x", "tilt_y",
               "src_timestamp", "src_t_session_ms"]
MARKER_COLUMNS = ["recording_id", "seq", "t_ns", "event", "task_id", "task_name", "task_index",
                  "task_category", "protocol_id", "src_payload", "src_t_session_ms"]


@dataclass
class Collected:
    """What one export yields: tables and declared facts, all over every recording."""

    tables: dict[str, DataFrame]
    meta: DataFrame
    clocks: DataFrame
    factors: DataFrame | None = None
    withdrawn: DataFrame | None = None
    notes: dict[str, DataFrame] = field(default_factory=dict)


# --- rules shared by all exports --------------------------------------------------------------------

def number(name: str) -> Column:
    return F.col(name).cast("double")


def mapped(raw: DataFrame, time: Column, columns: dict[str, str], kept: dict[str, Column] | None = None) -> DataFrame:
    """Source columns renamed and cast to canonical vectors, provenance kept under ``src_`` names."""
    return raw.select("recording_id", "seq", time.alias("t_ns"),
                      *[number(source).alias(target) for source, target in columns.items()],
                      *[value.alias(f"src_{name}") for name, value in (kept or {}).items()])


def vector_map(sources: dict[str, tuple[str, ...]]) -> dict[str, str]:
    """{source column: canonical column} for vectors given as source component names."""
    return {s: t for quantity, names in sources.items() for s, t in zip(names, VECTORS[quantity])}


def declared_clocks(ids: DataFrame, tables: dict[str, str], columns: dict[tuple[str, str], str]) -> DataFrame:
    """Clock rows of every recording: one per table, one per column on a clock of its own."""
    entries = [F.struct(F.lit(m).alias("modality"), F.lit(None).cast("string").alias("column"),
                        F.lit(d).alias("time_domain")) for m, d in tables.items()]
    entries += [F.struct(F.lit(m).alias("modality"), F.lit(c).alias("column"), F.lit(d).alias("time_domain"))
                for (m, c), d in columns.items()]
    return ids.select("recording_id", F.inline(F.array(*entries)))


def translate(rows: DataFrame, column: str, names: dict, what: str) -> DataFrame:
    """Replace source vocabulary by published names; a value without one is refused."""
    translated = rows.withColumn("_t", lookup(F.col(column), names))
    refuse(untranslated(rows, column, names), f"{what} without a published name")
    return translated.withColumn(column, F.col("_t")).drop("_t")


def untranslated(rows: DataFrame, column: str, names: dict) -> DataFrame:
    """Violations: distinct values outside the vocabulary."""
    return rows.where(F.col(column).isNotNull() & lookup(F.col(column), names).isNull()).select(
        F.col(column).alias("value")).distinct()


def route_events(events: DataFrame, event: str, strokes: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Split events into pen strokes (with their ``dot_type``) and everything else."""
    named = events.withColumn("dot_type", lookup(F.col(event), strokes))
    return named.where("dot_type IS NOT NULL"), named.where("dot_type IS NULL").drop("dot_type")


def participants(recordings: DataFrame, codes: DataFrame) -> DataFrame:
    """Attach participants by session code; ``codes``: session_code, participant_id."""
    joined = attach(recordings, codes, ["session_code"])
    refuse(joined.where("participant_id IS NULL").select("session_code").distinct(),
           "session code without a known participant")
    return joined


def require_recordings(recordings: DataFrame, what: str) -> None:
    if recordings.isEmpty():
        raise ValueError(f"{what} holds no recordings")
    refuse(repeated_ids(recordings), "duplicate recording ids")


def repeated_ids(recordings: DataFrame) -> DataFrame:
    return recordings.groupBy("recording_id").agg(F.count("*").alias("rows")).where("rows > 1")


def blank_markers(rows: DataFrame, event: Column, time: Column, payload: Column, session_ms: Column,
                  protocol: str) -> DataFrame:
    """Marker rows of a source without task structure."""
    empty = F.lit("")
    return rows.select("recording_id", "seq", time.alias("t_ns"), event.alias("event"), empty.alias("task_id"),
                       empty.alias("task_name"), F.lit(None).cast("double").alias("task_index"),
                       empty.alias("task_category"), F.lit(protocol).alias("protocol_id"),
                       payload.alias("src_payload"), session_ms.cast("double").alias("src_t_session_ms"))


def pen_rows(strokes: DataFrame, time: Column, values: dict[str, Column]) -> DataFrame:
    """Pen rows in the fixed column set; what a source lacks is NULL."""
    columns = [values.get(c, F.lit(None)).cast("double").alias(c) for c in PEN_COLUMNS[4:]]
    return strokes.select("recording_id", "seq", time.alias("t_ns"), "dot_type", *columns)


def session_facts(starts: DataFrame) -> DataFrame:
    """Handedness and pen model from the first session start of each recording.

    ``starts``: recording_id, seq, payload (JSON text).
    """
    first = starts.groupBy("recording_id").agg(F.min_by("payload", "seq").alias("p"))
    hand = F.lower(F.trim(F.get_json_object("p", "$.handedness")))
    pen = F.nullif(F.trim(F.get_json_object("p", "$.pen_name")), F.lit(""))
    facts = first.select("recording_id", hand.alias("hand"), pen.alias("pen"))
    refuse(facts.where(~F.col("hand").isin(*HANDEDNESS)).select("recording_id", "hand"), "unrecognised handedness")
    refuse(facts.where(F.col("pen").isNotNull() & lookup(F.col("pen"), PEN_MODEL_BY_NAME).isNull())
           .select("recording_id", "pen"), "unrecognised pen_name")
    return facts.select("recording_id", F.coalesce("hand", F.lit("unknown")).alias("handedness"),
                        F.coalesce(lookup(F.col("pen"), PEN_MODEL_BY_NAME), F.lit(PEN_MODELS[-1])).alias("pen_model"))


def _present_ids(table: DataFrame, flag: str) -> DataFrame:
    return table.select("recording_id").distinct().withColumn(flag, F.lit(True))


def _if_table(meta: DataFrame, table: DataFrame | None, column: str, value: Column) -> DataFrame:
    """Name a device only for recordings that have its table."""
    if table is None:
        return meta.withColumn(column, F.lit(""))
    joined = meta.join(_present_ids(table, "_held"), "recording_id", "left")
    return joined.withColumn(column, F.when(F.col("_held"), value).otherwise("")).drop("_held")


# --- CSV export of a study server -------------------------------------------------------------------

def server_export(spark: SparkSession, root: str, cohort: str, pipeline: str = "server",
                  protocol_prefix: str = "") -> Collected:
    """``sessions.csv`` plus ``watch/``, ``pen/`` and ``markers/`` with a CSV per session."""
    sessions = csv_rows(spark, f"{root}/sessions.csv", [
        "session_id", "person_id", "study_mode", "protocol_id", "subject_index", "watch_profile", "start_time",
        "alignment_sigma"], ("session_id", "person_id")).drop("path", "seq")
    rid = F.concat(F.lit(f"{cohort}-"), "session_id")

    def of(kind, columns):
        raw = csv_rows(spark, f"{root}/{kind}/*_{kind}.csv", columns)
        return raw.withColumn("session_id", path_part(F.col("path"), rf"([^/]+)_{kind}\.csv$")).withColumn(
            "recording_id", rid)

    found = (file_names(spark, f"{root}/watch/*_watch.csv")
             .select(path_part(F.col("path"), r"([^/]+)_watch\.csv$").alias("session_id")))
    require_recordings(found.withColumn("recording_id", F.col("session_id")), root)
    known = found.join(sessions, "session_id", "left").withColumn("recording_id", rid)
    refuse(found.join(sessions, "session_id", "left_anti"), "session without a row in sessions.csv")
    refuse(known.where(~present(F.col("person_id")) | F.lower(F.trim("person_id")).isin("nan", "none"))
           .select("session_id"), "session without a person_id")

    vectors = vector_map({"accel_user": ("ax", "ay", "az"), "gyro": ("rx", "ry", "rz"),
                          "gravity": ("gx", "gy", "gz"), "quat": ("qx", "qy", "qz", "qw")})
    provenance = ("local_ts_ms", "sequence", "server_received_ms", "phone_received_at")
    raw = of("watch", ["ts", *vectors, *provenance])
    watch = mapped(raw, text_to_unix_ns(F.col("ts"), "ms"), vectors,
                   {c: F.col(c).cast("bigint") for c in provenance})
    raw = of("pen", ["local_ts_ms", "timestamp", "x", "y", "pressure", "dot_type", "tilt_x", "tilt_y"])
    pen = pen_rows(raw, text_to_unix_ns(F.col("local_ts_ms"), "ms"),
                   {**{c: F.col(c) for c in ("x", "y", "pressure", "tilt_x", "tilt_y")},
                    "src_timestamp": F.col("timestamp")})
    raw = of("markers", ["timestamp_ms", "event", "task_id", "task_name", "task_index", "task_category", "protocol_id"])
    ids, titles = ({k: v[i] for k, v in TASK_NAMES.items()} for i in (0, 1))
    refuse(untranslated(raw, "task_id", ids), "task id without a published name")
    markers = raw.select(
        "recording_id", "seq", text_to_unix_ns(F.col("timestamp_ms"), "ms").alias("t_ns"), "event",
        lookup(F.col("task_id"), ids).alias("task_id"),
        F.coalesce(lookup(F.col("task_id"), titles), "task_name").alias("task_name"),
        number("task_index").alias("task_index"), "task_category", "protocol_id", F.lit("").alias("src_payload"),
        F.lit(None).cast("double").alias("src_t_session_ms"))

    has_gravity = watch.groupBy("recording_id").agg((F.count("gravity_x") > 0).alias("_g"))
    meta = known.join(has_gravity, "recording_id", "left").select(
        "recording_id", F.concat(F.lit(f"{cohort}-"), F.trim("person_id")).alias("participant_id"),
        F.lit(cohort).alias("cohort"), F.lit(pipeline).alias("pipeline"), F.lit(WATCH_MODELS[0]).alias("watch_model"),
        F.when(F.col("watch_profile") == "50hz", 50.0).otherwise(100.0).alias("watch_hz_nominal"),
        F.lit("user").alias("accel_semantics"), F.lit("fused").alias("accel_calibration"),
        F.when(F.col("_g"), "measured").otherwise("none").alias("gravity_source"),
        F.lit("estimated_delta").alias("time_alignment"),
        F.concat(F.lit(protocol_prefix), "protocol_id").alias("protocol_id"), "study_mode",
        F.col("subject_index").cast("int").alias("subject_index"), F.lit("ncode_grid").alias("pen_xy_unit"),
        F.lit("moleskine_raw").alias("pen_pressure_scale"), number("alignment_sigma").alias("pen_delta_sigma"),
        iso_to_unix_ns(F.col("start_time")).alias("session_start_ns"))
    meta = _if_table(meta, pen, "pen_model", F.lit(PEN_MODELS[0]))
    clocks = declared_clocks(meta.select("recording_id"), {
        "watch": "watch_capture_clock", "pen": "server_wall_clock", "markers": "server_wall_clock"}, {
        ("watch", "src_local_ts_ms"): "server_wall_clock",
        ("watch", "src_server_received_ms"): "server_wall_clock",
        ("watch", "src_phone_received_at"): "phone_wall_clock",
        ("pen", "src_timestamp"): "pen_device_clock",
        ("pen", "src_t_session_ms"): "session_relative_offset_ms",
        ("markers", "src_t_session_ms"): "session_relative_offset_ms"})
    return Collected({"watch": watch, "pen": pen, "markers": markers}, meta, clocks)


# --- watch app export ---------------------------------------------------------------------------------

WEB_CLOCKS = {("pen", "src_timestamp"): "pen_device_clock",
              **{(m, "src_t_session_ms"): "session_relative_offset_ms"
                 for m in ("watch", "headimu", "pen", "markers")}}


def watch_app_export(spark: SparkSession, root: str, cohort: str, codes: DataFrame, *, prefix: str | None = None,
                     pipeline: str = "watch_app", protocol: str = "web") -> Collected:
    """A folder per session with ``imu_samples_rows.csv`` and optional head, pen and event files.

    ``codes``: session_code (the folder name), participant_id.
    """
    def of(name, columns, required=()):
        raw = csv_rows(spark, f"{root}/*/{name}.csv", columns, required)
        return raw.withColumn("session_code", path_part(F.col("path"), r"([^/]+)/[^/]+$")).withColumn(
            "recording_id", F.concat(F.lit(f"{prefix or cohort}-"), "session_code"))

    sensors = {"accel_total": ("ax", "ay", "az"), "gyro": ("gx", "gy", "gz"), "quat": ("qx", "qy", "qz", "qw")}
    vectors = vector_map(sensors)

    def motion(name):
        raw = of(name, ["t_ms", "t_session_ms", *vectors])
        return mapped(raw, text_to_unix_ns(F.col("t_ms"), "ms"), vectors,
                      {"t_session_ms": number("t_session_ms")})

    watch, head = motion("imu_samples_rows"), motion("head_motion_samples_rows")
    for name, table in (("watch", watch), ("headimu", head)):
        refuse(gravity_lookalikes(norm_stats(table, ["gyro"])), f"{name}: g* columns look like a gravity vector")
    found = watch.select("recording_id").distinct()
    require_recordings(found, root)
    sessions = participants(found.withColumn(
        "session_code", F.expr(f"substring(recording_id, {len(prefix or cohort) + 2})")), codes)

    raw = of("pen_events", ["t_ms", "t_session_ms", "type", "x", "y", "force"])
    strokes, rest = route_events(raw, "type", PEN_EVENTS_FLAT)
    refuse(rest.where(~F.col("type").isin(*PEN_NON_STROKE_EVENTS)).select("type").distinct(), "unmapped pen event types")
    at = text_to_unix_ns(F.col("t_ms"), "ms")
    pen = pen_rows(strokes, at, {"x": F.col("x"), "y": F.col("y"), "pressure": F.col("force"),
                                 "src_t_session_ms": F.col("t_session_ms")})
    events = of("events", ["t_ms", "t_session_ms", "event_type", "payload"]).withColumn(
        "_p", allowed_payload(F.col("payload")))
    # Session markers come before pen events of the same instant.
    markers = union_all([
        blank_markers(events, F.col("event_type"), at, F.col("_p.payload"), F.col("t_session_ms"), protocol),
        blank_markers(rest.withColumn("seq", F.col("seq") + F.lit(1 << 40)), F.col("type"), at, F.lit(""),
                      F.col("t_session_ms"), protocol)])
    facts = session_facts(events.where("event_type = 'session_start' AND trim(payload) <> ''"))
    dropped = events.groupBy("recording_id").agg(F.sum("_p.dropped").alias("src_payload_dropped_key_count"))
    started = of("sensor_session", ["started_at_ms"]).groupBy("recording_id").agg(
        text_to_unix_ns(F.min_by("started_at_ms", "seq"), "ms").alias("session_start_ns"))
    bias = still_bias(watch, median_rate_hz(watch))
    meta = sessions.select("recording_id", "participant_id")
    for part in (facts, dropped, started, bias):
        meta = meta.join(part, "recording_id", "left")
    meta = meta.withColumns({
        "cohort": F.lit(cohort), "pipeline": F.lit(pipeline), "watch_model": F.lit(WATCH_MODELS[1]),
        "accel_semantics": F.lit("total"), "accel_calibration": F.lit("raw_uncalibrated"),
        "gravity_source": F.lit("none"), "time_alignment": F.lit("shared_clock"), "protocol_id": F.lit(protocol),
        "study_mode": F.lit("study"), "pen_xy_unit": F.lit("webapp_raw"), "pen_pressure_scale": F.lit("webapp_force")})
    meta = _if_table(meta, pen, "pen_model", F.coalesce("pen_model", F.lit(PEN_MODELS[-1])))
    meta = _if_table(meta, head, "head_model", F.lit(HEAD_MODELS[0]))
    clocks = declared_clocks(meta.select("recording_id"), dict.fromkeys(
        ("watch", "headimu", "pen", "markers"), "backend_wall_clock"), WEB_CLOCKS)
    return Collected({"watch": watch, "headimu": head, "pen": pen, "markers": markers}, meta, clocks)


# --- phone logger export ------------------------------------------------------------------------------

SESSION_JSON = ("events array<struct<t_ms: string, t_session_ms: double, event: string, payload: string>>, "
                "pen_events array<string>")


def session_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, events, pen_events) of session JSON files; payloads stay text."""
    return durable(spark.read.schema(SESSION_JSON).option("multiLine", True).json(path).select(
        F.col("_metadata.file_path").alias("path"), "events", "pen_events"))


def session_events(files: DataFrame) -> DataFrame:
    """Events of session files in one shape: path, seq, generation, t_ms, t_session_ms, event, payload, flat.

    One generation of the export keeps pen events in a flat list of their own, the other among the
    session events.  An entry of either kind without time or type is refused; a fraction of t_ms is cut off.
    """
    generation = F.when(F.col("pen_events").isNotNull(), "flat").otherwise("nested").alias("generation")
    session = files.select("path", generation, F.posexplode("events").alias("seq", "e")).select(
        "path", F.col("seq").cast("bigint").alias("seq"), "generation", cut_to_whole(F.col("e.t_ms")).alias("t_ms"),
        "e.t_session_ms", "e.event", "e.payload", F.lit(False).alias("flat"))
    flat = files.select("path", generation, F.posexplode("pen_events").alias("seq", "j"))
    flat = flat.select("path", (F.col("seq") + F.lit(1 << 40)).alias("seq"), "generation",
                       cut_to_whole(F.get_json_object("j", "$.t_ms")).alias("t_ms"),
                       F.get_json_object("j", "$.t_session_ms").cast("double").alias("t_session_ms"),
                       F.get_json_object("j", "$.type").alias("event"), F.col("j").alias("payload"),
                       F.lit(True).alias("flat"))
    events = session.unionByName(flat)
    refuse(incomplete_events(events), "session event without t_ms or type")
    return events


def incomplete_events(events: DataFrame) -> DataFrame:
    """Violations: entries lacking their time or type."""
    return events.where("t_ms IS NULL OR event IS NULL").select("path", "seq", "payload")


def phone_logger_export(spark: SparkSession, root: str, cohort: str, codes: DataFrame, *, prefix: str | None = None,
                        withdrawn_heads: tuple[str, ...] = (), pipeline: str = "phone_logger",
                        protocol: str = "web") -> Collected:
    """A folder per session with wrist, head and raw streams, ``Metadata.csv`` and one session JSON.

    ``withdrawn_heads`` names session codes whose head stream stays unpublished.
    """
    def named(rows):
        return rows.withColumn("recording_id", F.concat(F.lit(f"{prefix or cohort}-"), path_part(
            F.col("path"), r"([^/]+)/[^/]+$")))

    info = named(csv_rows(spark, f"{root}/*/Metadata.csv", ["recording epoch time", "sensors", "sampleRateMs",
                                                            "standardisation"]))
    info = info.groupBy("recording_id").agg(*[F.min_by(c, "seq").alias(c) for c in info.columns
                                              if c not in ("recording_id", "path", "seq")])
    events = named(session_events(session_files(spark, f"{root}/*/*.json")))
    starts = events.where("event = 'session_start' AND NOT flat")
    token = starts.groupBy("recording_id").agg(F.get_json_object(
        F.min_by("payload", "seq"), "$.participant_id").alias("session_code"))
    wrist = named(file_names(spark, f"{root}/*/WristMotion.csv")).select("recording_id")
    require_recordings(wrist, root)
    sessions = wrist.join(token, "recording_id", "left")
    refuse(sessions.where("session_code IS NULL").select("recording_id"), "no session code in session_start")
    sessions = participants(sessions, codes)

    axes = "XYZ"
    vectors = vector_map({
        "accel_user": tuple(f"acceleration{a}" for a in axes), "gyro": tuple(f"rotationRate{a}" for a in axes),
        "gravity": tuple(f"gravity{a}" for a in axes), "quat": tuple(f"quaternion{a}" for a in "XYZW")})
    flags = info.select("recording_id", "standardisation")

    def motion(name):
        raw = named(csv_rows(spark, f"{root}/*/{name}.csv", ["time", *vectors]))
        rows = mapped(raw, text_to_unix_ns(F.col("time"), "ns"), vectors)
        return scale_acceleration(harmonise_gravity(rows), flags, "accel_user")

    watch, head = motion("WristMotion"), motion("Headphone")
    hidden = sessions.where(F.col("session_code").isin(*withdrawn_heads) if withdrawn_heads else F.lit(False))
    refuse(hidden.join(head.select("recording_id").distinct(), "recording_id", "left_anti").select("recording_id"),
           "withdrawn head stream has no file")
    head = attach(head, hidden.select("recording_id", F.lit(True).alias("_hidden")), ["recording_id"]).where(
        "_hidden IS NULL").drop("_hidden")
    raw = named(csv_rows(spark, f"{root}/*/WatchAccelerometerUncalibrated.csv", ["time", "x", "y", "z"]))
    rawaccel = scale_acceleration(mapped(raw, text_to_unix_ns(F.col("time"), "ns"),
                                         vector_map({"accel_total": ("x", "y", "z")})), flags, "accel_total")
    factors = []
    for modality, table in (("watch", watch), ("headimu", head), ("watch_rawaccel", rawaccel)):
        scaled = {"accel_factor": "accel_total" if modality == "watch_rawaccel" else "accel_user",
                  "gravity_factor": "gravity"}
        for name, quantity in scaled.items():
            if name in table.columns:
                factors.append(table.groupBy("recording_id").agg(F.max(name).alias("unit_conversion_factor")).select(
                    "recording_id", F.lit(modality).alias("modality"),
                    F.explode(F.array(*[F.lit(c) for c in VECTORS[quantity]])).alias("column"),
                    "unit_conversion_factor"))
    watch, head, rawaccel = (t.drop("accel_factor", "gravity_factor") for t in (watch, head, rawaccel))

    flat, nested = (route_events(events.where(F.col("generation") == g), "event", v)
                    for g, v in (("flat", PEN_EVENTS_FLAT), ("nested", PEN_EVENTS_NESTED)))
    strokes, rest = flat[0].unionByName(nested[0]), flat[1].unionByName(nested[1])

    def of(path):
        return F.get_json_object("payload", path)
    at = to_unix_ns(F.col("t_ms"), "ms", whole=True)
    pen = pen_rows(strokes, at, {
        "x": of("$.x"), "y": of("$.y"), "pressure": of("$.force"), "tilt_x": of("$.tilt.x"),
        "tilt_y": of("$.tilt.y"), "src_timestamp": of("$.timestamp"), "src_t_session_ms": F.col("t_session_ms")})
    rest = rest.withColumn("_p", allowed_payload(F.coalesce("payload", F.lit("{}"))))
    markers = blank_markers(rest, F.col("event"), at, F.col("_p.payload"), F.col("t_session_ms"), protocol)
    # Flat entries carry their own time and type beside the payload; those are not payload keys.
    envelope = sum(F.when(F.col("flat") & of(f"$.{k}").isNotNull(), 1).otherwise(0)
                   for k in ("t_ms", "t_session_ms", "type"))
    dropped = rest.groupBy("recording_id").agg(
        F.sum(F.col("_p.dropped") - envelope).alias("src_payload_dropped_key_count"))
    kinds = events.groupBy("recording_id").agg(F.max("generation").alias("generation"))
    meta = sessions.select("recording_id", "participant_id")
    for part in (session_facts(starts), dropped, kinds, info):
        meta = meta.join(part, "recording_id", "left")
    nested_kind = F.col("generation") == "nested"
    meta = meta.select(
        "recording_id", "participant_id", "handedness", "pen_model", "src_payload_dropped_key_count",
        F.lit(cohort).alias("cohort"), F.lit(pipeline).alias("pipeline"), F.lit(WATCH_MODELS[1]).alias("watch_model"),
        listed_rate_hz(F.col("sensors"), F.col("sampleRateMs"), "Wrist Motion").alias("watch_hz_nominal"),
        F.lit("user").alias("accel_semantics"), F.lit("fused").alias("accel_calibration"),
        F.lit("measured").alias("gravity_source"), F.lit("shared_clock").alias("time_alignment"),
        F.lit(protocol).alias("protocol_id"), F.lit("study").alias("study_mode"),
        F.when(nested_kind, "sl_webapp_raw").otherwise("webapp_raw").alias("pen_xy_unit"),
        F.when(nested_kind, "sl_webapp_force").otherwise("webapp_force").alias("pen_pressure_scale"),
        (F.lower(F.trim("standardisation")) == "true").alias("src_standardisation"),
        text_to_unix_ns(F.col("recording epoch time"), "ms").alias("session_start_ns"))
    meta = _if_table(meta, pen, "pen_model", F.coalesce("pen_model", F.lit(PEN_MODELS[-1])))
    meta = _if_table(meta, head, "head_model", F.lit(HEAD_MODELS[0]))
    clocks = declared_clocks(meta.select("recording_id"), dict.fromkeys(
        ("watch", "headimu", "watch_rawaccel", "pen", "markers"), "backend_wall_clock"),
        {k: v for k, v in WEB_CLOCKS.items() if k[0] in ("pen", "markers")})
    return Collected({"watch": watch, "headimu": head, "watch_rawaccel": rawaccel, "pen": pen, "markers": markers},
                     meta, clocks, union_all(factors), hidden.select("recording_id", F.lit("headimu").alias("modality")))


# --- head motion study ----------------------------------------------------------------------------------

# --- fixed values: text patterns of the study's ground truth and protocol files ---
TRUTH_LINE = r"^\s*(\d+):(\d{2})\s+(\S+)\s*$"
PROTOCOL_ROW = (r"^\s*\d+\s*\|\s*(\d+):(\d{2})\s*\|\s*(\d+):(\d{2})\s*\|\s*\d+:\d{2}\s*\|\s*(\S+)\s*"
                r"\|\s*([^|]+?)\s*(?:\|\s*(.+?)\s*)?$")
STATED_TOTAL = STATED_TOTAL_WORD + r"\D*(\d+):(\d{2})"
HEAD_FILE = r"/([PT]\d+)_\d+m\d{2}s_airpod_motion_[^/]*\.csv$"


def _seconds(line: str, pattern: str, minutes: int) -> Column:
    return (F.regexp_extract(line, pattern, minutes).cast("double") * 60
            + F.regexp_extract(line, pattern, minutes + 1).cast("double"))


def ground_truth(rows: DataFrame) -> DataFrame:
    """``M:SS label`` lines to (path, seq, start_s, label); other lines are ignored."""
    return rows.where(F.col("line").rlike(TRUTH_LINE)).select(
        "path", "seq", _seconds("line", TRUTH_LINE, 1).alias("start_s"),
        F.regexp_extract("line", TRUTH_LINE, 3).alias("label"))


def protocol_blocks(rows: DataFrame) -> DataFrame:
    """Protocol table rows to (path, seq, start_s, end_s, label, activity), without dropped blocks."""
    kept = rows.where(F.col("line").rlike(PROTOCOL_ROW) & ~F.startswith(
        F.regexp_extract("line", PROTOCOL_ROW, 7), F.lit(DROPPED_BLOCK_STATUS)))
    blocks = kept.select("path", "seq", _seconds("line", PROTOCOL_ROW, 1).alias("start_s"),
                         _seconds("line", PROTOCOL_ROW, 3).alias("end_s"),
                         F.regexp_extract("line", PROTOCOL_ROW, 5).alias("label"),
                         F.regexp_extract("line", PROTOCOL_ROW, 6).alias("activity"))
    return translate(blocks, "activity", ACTIVITY_NAMES, "protocol activity")


def stated_total_problems(rows: DataFrame, blocks: DataFrame, key: str = "path",
                          stale: tuple[str, ...] = ()) -> DataFrame:
    """Violations: files whose stated total is over a second away from the end of the last block."""
    stated = rows.where(F.col("line").rlike(STATED_TOTAL)).groupBy(key).agg(
        F.min_by(_seconds("line", STATED_TOTAL, 1), "seq").alias("stated_s"))
    last = blocks.groupBy(key).agg(F.max_by("end_s", "seq").alias("end_s"))
    both = stated.join(last, key)
    if stale:
        both = both.where(~F.col(key).isin(*stale))
    return both.where(F.abs(F.col("stated_s") - F.col("end_s")) > 1.0)


def head_study_export(spark: SparkSession, root: str, cohort: str, *, pipeline: str = "head_study",
                      stale_totals: tuple[str, ...] = (), protocols: tuple[tuple[str, str], ...] = ()) -> Collected:
    """Head motion CSVs with ground truth and protocol text beside them.

    ``stale_totals`` lists recording ids whose protocol header is known to be outdated; ``protocols``
    maps the first letter of an id to its protocol id.
    """
    vectors = vector_map({
        "accel_user": tuple(f"user_acceleration_{a}_g" for a in "xyz"),
        "gyro": tuple(f"rotation_rate_{a}_rad_s" for a in "xyz"), "gravity": tuple(f"gravity_{a}_g" for a in "xyz"),
        "quat": tuple(f"quaternion_{a}" for a in "xyzw")})

    def named(rows, pattern):
        person = path_part(F.col("path"), pattern)
        return rows.withColumn("recording_id", F.concat(F.lit(f"{cohort}-"), person)).where(person.isNotNull())

    raw = named(csv_rows(spark, f"{root}/daten/*/*.csv", ["timestamp_iso", "sensor_timestamp_s", *vectors, "label"]),
                HEAD_FILE)
    at = iso_to_unix_ns(F.col("timestamp_iso"))
    head = mapped(raw, at, vectors, {"sensor_timestamp_s": number("sensor_timestamp_s")})
    span = durable(table_span(head).select("recording_id", "t_start_ns", "t_end_ns"))
    require_recordings(span, root)

    truth = durable(named(ground_truth(existing_lines(spark, f"{root}/*/*_ground_truth*.txt")),
                          r"/([^/_]+)_ground_truth"))
    refuse(span.join(truth.select("recording_id").distinct(), "recording_id", "left_anti").select("recording_id"),
           "recording without ground truth", FileNotFoundError)
    text = durable(named(existing_lines(spark, f"{root}/*/*_protokoll*.txt"), r"/([^/_]+)_protokoll"))
    blocks = durable(named(protocol_blocks(text), r"/([^/_]+)_protokoll"))
    covered = blocks.select("recording_id").distinct()
    refuse(block_disagreements(blocks, truth.join(covered, "recording_id", "left_semi")),
           "protocol blocks and ground truth disagree")
    refuse(stated_total_problems(text, blocks, "recording_id", stale_totals), "protocol total disagrees with its blocks")
    plain = truth.join(covered, "recording_id", "left_anti").select(
        "recording_id", "seq", "start_s", "label", F.lit("").alias("activity"))
    rows = plain.unionByName(blocks.select("recording_id", "seq", "start_s", "label", "activity"))
    attention = durable(anchored_intervals(rows, span))
    refuse(inverted_intervals(attention), "attention interval ends before it starts")
    labelled = raw.select("recording_id", "seq", at.alias("t_ns"), "label").withColumnRenamed("label", "_own")
    judged = labelled.groupBy("recording_id").agg(F.count("_own").alias("n")).where("n > 0").select("recording_id")
    agreement = durable(expansion_agreement(attach(labelled, judged, ["recording_id"], "inner"), attention, "_own"))
    refuse(agreement.where(F.col("agreement") < EXPANSION_MIN_AGREEMENT), "interval expansion contradicts the samples")

    tail = protocol_tail(span, blocks).withColumnRenamed("tail_s", "attention_protocol_tail_s")
    letter = F.substring("recording_id", len(cohort) + 2, 1)
    meta = span.select("recording_id").join(tail, "recording_id", "left").withColumns({
        "participant_id": F.col("recording_id"), "cohort": F.lit(cohort), "pipeline": F.lit(pipeline),
        "head_model": F.lit(HEAD_MODELS[0]), "accel_semantics": F.lit("user"), "accel_calibration": F.lit("fused"),
        "gravity_source": F.lit("none"), "time_alignment": F.lit("shared_clock"), "study_mode": F.lit("study"),
        "protocol_id": lookup(letter, dict(protocols)) if protocols else F.lit("")})
    clocks = declared_clocks(meta.select("recording_id"), dict.fromkeys(("headimu", "attention"), "device_wall_clock"),
                             {("headimu", "src_sensor_timestamp_s"): "device_monotonic_clock"})
    return Collected({"headimu": head, "attention": attention}, meta, clocks, notes={"agreement": agreement})


# --- wrist log paired with a notebook backup ----------------------------------------------------------

def _paged(points: DataFrame, strokes: DataFrame, key: list[str]) -> DataFrame:
    return attach(points, strokes, [*key, "stroke_id"], "inner")


def _bounds_ms(windows: DataFrame, key: list[str]) -> DataFrame:
    return windows.select(*key, "recording_id", ceil_div(F.col("t_start_ns"), 1_000_000).alias("lo"), floor_div(F.col("t_end_ns"), 1_000_000).alias("hi"))


def points_in_windows(points: DataFrame, strokes: DataFrame, windows: DataFrame, key: list[str]) -> DataFrame:
    """Points of strokes inside each recording's window; bounds in ns are rounded inward to ms.

    ``points``: key, stroke_id, date_ms, ...; ``strokes``: key, stroke_id, page_id; ``windows``: key,
    recording_id, t_start_ns, t_end_ns.
    """
    return contained(_paged(points, strokes, key), _bounds_ms(windows, key), key, "date_ms").drop("lo", "hi")


def pages_in_windows(points: DataFrame, strokes: DataFrame, windows: DataFrame, key: list[str]) -> DataFrame:
    """(recording_id, page_id) of the pages with points in a recording's window, without pairing points and windows."""
    return contained_values(_paged(points, strokes, key), _bounds_ms(windows, key), key, "date_ms", ["page_id"]).select("recording_id", "page_id").distinct()


def page_problems(pages: DataFrame, windows: DataFrame) -> DataFrame:
    """Violations: recordings whose window holds points of no page or of several, from (recording_id, page_id)."""
    counted = pages.groupBy("recording_id").agg(F.count_distinct("page_id").alias("pages"))
    return windows.select("recording_id").join(counted, "recording_id", "left").select(
        "recording_id", F.coalesce("pages", F.lit(0)).alias("pages")).where("pages <> 1")


def notebook_export(spark: SparkSession, root: str, strokes: DataFrame, points: DataFrame, sessions: DataFrame,
                    cohort: str, *, excluded: tuple[str, ...] = (), pipeline: str = "notebook") -> Collected:
    """Wrist CSVs below ``sensorlog/`` and the notebook's stroke and point tables.

    ``sessions``: start_key, number.  Ids derive from the start of each recording, because file names
    carry private labels.
    """
    vectors = vector_map({"accel_total": tuple(f"accelerometerAcceleration{a}(G)" for a in "XYZ")})
    time, uptime = "loggingTime(txt)", "accelerometerTimestamp_sinceReboot(s)"
    raw = csv_rows(spark, f"{root}/sensorlog/*.csv", [time, uptime, *vectors], (time, uptime, *vectors))
    raw = raw.withColumn("t_ns", iso_to_unix_ns(F.col(f"`{time}`")))
    raw = raw.toDF(*[c.replace("(", "_").replace(")", "") for c in raw.columns])
    vectors = {s.replace("(", "_").replace(")", ""): t for s, t in vectors.items()}
    starts = raw.groupBy("path").agg(F.min("t_ns").alias("_start")).withColumn("start_key", session_key(F.col("_start")))
    if excluded:
        starts = starts.where(~F.col("start_key").isin(*excluded))
    numbered = starts.join(sessions, "start_key", "left")
    refuse(numbered.where("number IS NULL").select("start_key"), "no session number for this recording start")
    ids = numbered.select("path", F.concat(F.lit(f"{cohort}-S"), "number").alias("recording_id"),
                          F.concat(F.lit(f"{cohort}-P"), "number").alias("participant_id"))
    require_recordings(ids, root)
    rows = attach(raw, ids.select("path", "recording_id"), ["path"], "inner")
    watch = mapped(rows, F.col("t_ns"), vectors, {
        "accelerometer_timestamp_s": number(uptime.replace("(", "_").replace(")", ""))})
    windows = durable(table_span(watch).withColumn("source", F.lit(root)))
    notebook = (points.withColumn("source", F.lit(root)), strokes.withColumn("source", F.lit(root)), windows, ["source"])
    refuse(page_problems(pages_in_windows(*notebook), windows), "watch range must overlap exactly one notebook page")
    inside = durable(points_in_windows(*notebook))
    named = inside.withColumns({"dot_type": lookup(F.col("draw_type").cast("int"), NOTEBOOK_DRAW_TYPES),
                                "seq": F.col("point_id").cast("bigint")})
    refuse(named.where("dot_type IS NULL").select("draw_type").distinct(), "unknown draw type")
    pen = pen_rows(named, to_unix_ns(F.col("date_ms"), "ms", whole=True), {
        "x": F.col("page_x"), "y": F.col("page_y"), "pressure": F.col("pen_pressure")})
    meta = windows.select("recording_id", F.col("t_start_ns").alias("session_start_ns")).join(
        ids.select("recording_id", "participant_id"), "recording_id").withColumns({
            "cohort": F.lit(cohort), "pipeline": F.lit(pipeline), "watch_model": F.lit(WATCH_MODELS[1]),
            "pen_model": F.lit(PEN_MODELS[0]), "watch_hz_nominal": F.lit(50.0), "accel_semantics": F.lit("total"),
            "accel_calibration": F.lit("raw"), "gravity_source": F.lit("none"),
            "time_alignment": F.lit("overlap_only"), "pen_xy_unit": F.lit("ncode_grid"),
            "pen_pressure_scale": F.lit("moleskine_raw")})
    clocks = declared_clocks(meta.select("recording_id"), {
        "watch": "watch_device_wall_clock", "pen": "moleskine_app_wall_clock"}, {
        ("watch", "src_accelerometer_timestamp_s"): "device_monotonic_clock",
        ("pen", "src_timestamp"): "pen_device_clock", ("pen", "src_t_session_ms"): "session_relative_offset_ms"})
    return Collected({"watch": watch, "pen": pen}, meta, clocks)


