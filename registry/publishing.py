"""Manifest and channel derivation, redaction, and every validation check."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import functions as F

from motionloom.operators import privacy
from motionloom.operators.layout import durable, union_all
from motionloom.operators.motion import column_presence, partial_vectors
from motionloom.plans import manifest as M
from motionloom.plans import validate as V
from motionloom.sources import sinks
from motionloom.sources.bundle import scan_channels, scan_manifest, scan_modality
from motionloom.sources.publish import audit, latest_report, publish, published
from motionloom.vocabulary import (CAPABILITY_FLAGS, MODALITY_FLAGS,
                                   TIME_ORIGINS, VECTORS)

from .projections import (ORACLES, VIEWS, as_int, attention, channels, imu, manifest, markers, motion, nested, pen, query,
                          read, rounded)
from .labelling import STROKES_SQL

# --- a collection of tables that share recordings: watch, raw acceleration, pen and attention of users,
# --- head motion of embeddings, markers of conversations ------------------------------------------------

VIEWS["watch"] = """SELECT recording_id, t_ns, seq, v / 128 AS accel_user_x, v / 256 AS accel_user_y, v / 512 AS accel_user_z,
    CASE WHEN substr(recording_id, 2)::INT % 3 = 0 THEN v END AS gyro_x,
    CASE WHEN substr(recording_id, 2)::INT % 3 = 0 THEN v / 2 END AS gyro_y,
    CASE WHEN substr(recording_id, 2)::INT % 3 = 0 THEN v / 3 END AS gyro_z FROM (
    SELECT 'U' || user_id AS recording_id, epoch_us(ts) * 1000 AS t_ns, event_id AS seq, value AS v
    FROM events WHERE event_type IN ('view', 'error'))"""
#: Every third recording's raw acceleration runs a thousand times faster from this instant on, so that it covers next to nothing.
FAST_FROM_NS = 1_704_067_200_000_000_000
VIEWS["rawaccel"] = f"""SELECT recording_id, CASE WHEN substr(recording_id, 2)::INT % 3 = 1 THEN {FAST_FROM_NS} + (t_ns - {FAST_FROM_NS}) // 1000
    ELSE t_ns END AS t_ns, seq, v AS accel_total_x, v AS accel_total_y, v AS accel_total_z FROM (
    SELECT 'U' || user_id AS recording_id, epoch_us(ts) * 1000 AS t_ns, event_id AS seq, value AS v FROM events
    WHERE event_type IN ('view', 'error'))"""
VIEWS["stored"] = """SELECT recording_id, 'watch' AS modality, t_ns AS s, t_ns AS e FROM watch
    UNION ALL SELECT recording_id, 'watch_rawaccel', t_ns, t_ns FROM rawaccel
    UNION ALL SELECT recording_id, 'headimu', t_ns, t_ns FROM imu
    UNION ALL SELECT recording_id, 'pen', t_ns, t_ns FROM pen
    UNION ALL SELECT recording_id, 'markers', t_ns, t_ns FROM markers
    UNION ALL SELECT recording_id, 'attention', t_start_ns, t_end_ns FROM attention"""
VIEWS["spans"] = """SELECT recording_id, modality, min(s) AS t_start_ns, max(e) AS t_end_ns, count(*) AS n_samples
    FROM stored GROUP BY recording_id, modality"""
VIEWS["dropouts"] = """SELECT recording_id, modality, n_samples, round_even(ratio, 6) AS coverage_ratio FROM (
    SELECT *, (t_end_ns - t_start_ns) / total AS ratio FROM (SELECT *, count(*) OVER w AS streams,
    max(t_end_ns) OVER w - min(t_start_ns) OVER w AS total FROM spans
    WHERE modality IN ('watch', 'watch_rawaccel', 'headimu') WINDOW w AS (PARTITION BY recording_id))
    WHERE streams >= 2 AND total > 0) WHERE ratio < 0.01"""
VIEWS["clocks"] = """SELECT 'R' || c_custkey AS recording_id, m AS modality, CASE WHEN m = 'pen' AND c_custkey % 2 = 0
    THEN 'pen_clock' WHEN m = 'markers' AND c_custkey % 4 = 0 THEN 'server_clock' ELSE 'wall_clock' END AS time_domain
    FROM customer, (VALUES ('watch'), ('headimu'), ('pen'), ('markers')) v(m)
    WHERE NOT (m = 'watch' AND c_custkey % 3 = 0) AND NOT (m = 'headimu' AND c_custkey % 5 = 0)"""
ALL_TABLES = ("watch", "rawaccel", "imu", "pen", "markers", "attention", "stored", "spans")


def watch(spark, sf):
    rows = motion(spark, sf)
    turns = F.when(F.expr("substring(recording_id, 2) % 3 = 0"), F.col("v"))
    return rows.select("recording_id", "t_ns", "seq", (F.col("v") / 128).alias("accel_user_x"),
                       (F.col("v") / 256).alias("accel_user_y"), (F.col("v") / 512).alias("accel_user_z"),
                       turns.alias("gyro_x"), (turns / 2).alias("gyro_y"), (turns / 3).alias("gyro_z"))


def rawaccel(spark, sf):
    fast = F.expr(f"CASE WHEN substring(recording_id, 2) % 3 = 1 THEN {FAST_FROM_NS} + (t_ns - {FAST_FROM_NS}) div 1000 ELSE t_ns END")
    return motion(spark, sf).select("recording_id", fast.alias("t_ns"), "seq", *[F.col("v").alias(c) for c in VECTORS["accel_total"]])


def tables(spark, sf):
    return {"watch": watch(spark, sf), "watch_rawaccel": rawaccel(spark, sf), "headimu": imu(spark, sf),
            "pen": pen(spark, sf), "markers": markers(spark, sf), "attention": attention(spark, sf)}


def clocks(spark, sf):
    k = F.col("c_custkey")
    domain = (F.when((F.col("modality") == "pen") & (k % 2 == 0), "pen_clock")
              .when((F.col("modality") == "markers") & (k % 4 == 0), "server_clock").otherwise("wall_clock"))
    rows = read(spark, sf, "customer").select(k, F.explode(F.array(
        *[F.lit(m) for m in ("watch", "headimu", "pen", "markers")])).alias("modality"))
    kept = rows.where(~((F.col("modality") == "watch") & (k % 3 == 0)) & ~((F.col("modality") == "headimu") & (k % 5 == 0)))
    return kept.select(F.concat(F.lit("R"), k.cast("string")).alias("recording_id"), "modality",
                       F.lit(None).cast("string").alias("column"), domain.alias("time_domain"))


# --- manifest -----------------------------------------------------------------------------------------

RATES_SQL = """rates AS (SELECT recording_id, modality, 1e9 / quantile_cont(d, 0.5) AS rate FROM (SELECT recording_id,
        modality, t_ns - lag(t_ns) OVER (PARTITION BY recording_id, modality ORDER BY t_ns, seq) AS d FROM (
        SELECT recording_id, 'watch' AS modality, t_ns, seq FROM watch
        UNION ALL SELECT recording_id, 'watch_rawaccel', t_ns, seq FROM rawaccel
        UNION ALL SELECT recording_id, 'headimu', t_ns, seq FROM imu
        UNION ALL SELECT recording_id, 'markers', t_ns, seq FROM markers)) WHERE d > 0 GROUP BY recording_id, modality)"""
ISSUES_SQL = """issues AS (SELECT recording_id, '[' || string_agg('{"code": "modality_dropout", "modality": "' || modality ||
        '", "n_samples": ' || n_samples || ', "coverage_ratio": ' || coverage_ratio || '}', ', ' ORDER BY modality) || ']'
        AS issue_codes FROM dropouts GROUP BY recording_id)"""
COUNTS_SQL = """counts AS (SELECT recording_id, CASE WHEN named THEN w END AS n_writing_tasks, CASE WHEN named THEN i END
        AS n_idle_tasks FROM (SELECT recording_id, bool_or(event = 'task_start' AND task_category <> '') AS named,
        count(*) FILTER (event = 'task_start' AND task_category = 'writing') AS w,
        count(*) FILTER (event = 'task_start' AND task_category = 'idle') AS i FROM markers GROUP BY recording_id))"""
PEN_SQL = STROKES_SQL + """, on_time AS (SELECT recording_id, round_even(sum(n) / sum(s), 3) AS hz FROM (SELECT recording_id,
        count(*) - 1 AS n, (max(t_ns) - min(t_ns)) / 1e9 AS s FROM strokes GROUP BY recording_id, stroke)
        WHERE s > 0 GROUP BY recording_id),
    on_pen AS (SELECT recording_id, round_even(sum(n) / sum(s), 3) AS hz FROM (SELECT recording_id, count(*) - 1 AS n,
        (max(src_timestamp) - min(src_timestamp)) / 1e3 AS s FROM strokes WHERE src_timestamp IS NOT NULL
        GROUP BY recording_id, stroke) WHERE s > 0 GROUP BY recording_id),
    in_stroke AS (SELECT recording_id, CASE WHEN dot_type <> 'PEN_DOWN' THEN t_ns - lag(t_ns) OVER (PARTITION BY
        recording_id ORDER BY t_ns, seq) END AS gap, src_timestamp FROM pen),
    pen_rates AS (SELECT recording_id, CASE WHEN logged > 0 THEN p.hz WHEN batched <= 0.2 THEN t.hz END AS pen_hz,
        logged FROM (SELECT recording_id, count(src_timestamp) AS logged, avg(CASE WHEN gap = 0 THEN 1.0
        WHEN gap IS NOT NULL THEN 0.0 END) AS batched FROM in_stroke GROUP BY recording_id)
        LEFT JOIN on_time t USING (recording_id) LEFT JOIN on_pen p USING (recording_id))"""

_HAS = ", ".join(f"bool_or(modality = '{m}')::INT AS {flag}" for flag, m in MODALITY_FLAGS.items())
_NONE = ", ".join(f"0 AS {flag}" for flag in ("has_gravity", "has_quaternion"))


@query(f"""WITH {RATES_SQL}, {ISSUES_SQL}, {COUNTS_SQL}, {PEN_SQL},
    base AS (SELECT recording_id, {_HAS}, min(t_start_ns) AS t_start_ns, max(t_end_ns) AS t_end_ns,
        round_even((max(t_end_ns) - min(t_start_ns)) / 1e9, 3) AS duration_s,
        coalesce(max(n_samples) FILTER (modality = 'watch'), 0) AS n_samples_watch,
        coalesce(max(n_samples) FILTER (modality = 'pen'), 0) AS n_samples_pen,
        coalesce(max(n_samples) FILTER (modality = 'headimu'), 0) AS n_samples_head FROM spans GROUP BY recording_id)
    SELECT b.*, {_NONE}, (has_watch = 1 AND substr(b.recording_id, 2)::INT % 3 = 0)::INT AS has_watch_gyro,
        (has_headimu = 1 AND b.recording_id <> 'L2')::INT AS has_head_gravity, has_headimu AS has_head_quaternion,
        has_headimu AS has_head_gyro, round_even(w.rate, 3) AS watch_hz_measured, round_even(h.rate, 3) AS head_hz_measured,
        p.pen_hz AS pen_hz_measured, CASE WHEN p.pen_hz IS NULL THEN '' WHEN p.logged > 0 THEN 'src_timestamp'
        ELSE 't_ns' END AS pen_hz_clock, c.n_writing_tasks, c.n_idle_tasks, coalesce(i.issue_codes, '') AS issue_codes
    FROM base b LEFT JOIN rates w ON b.recording_id = w.recording_id AND w.modality = 'watch'
    LEFT JOIN rates h ON b.recording_id = h.recording_id AND h.modality = 'headimu'
    LEFT JOIN pen_rates p ON b.recording_id = p.recording_id LEFT JOIN counts c ON b.recording_id = c.recording_id
    LEFT JOIN issues i ON b.recording_id = i.recording_id""", *ALL_TABLES, "dropouts")
def derived_manifest(spark, sf):
    return as_int(M.derived_values(tables(spark, sf)), *MODALITY_FLAGS, *CAPABILITY_FLAGS)


@query("SELECT recording_id, modality, t_start_ns, t_end_ns, n_samples FROM spans", *ALL_TABLES)
def table_spans(spark, sf):
    return M.spans(tables(spark, sf))


@query("SELECT * FROM dropouts", *ALL_TABLES, "dropouts")
def modality_dropouts(spark, sf):
    return M.dropouts(M.spans(tables(spark, sf)))


@query(f"""WITH {ISSUES_SQL.replace("string_agg(", "string_agg(").replace("FROM dropouts", "FROM dropouts")},
    gone AS (SELECT DISTINCT recording_id FROM pen WHERE substr(recording_id, 2)::INT % 4 = 0)
    SELECT coalesce(i.recording_id, g.recording_id) AS recording_id, CASE WHEN g.recording_id IS NULL THEN i.issue_codes
    WHEN i.recording_id IS NULL THEN '[' || '{{"code": "modality_withdrawn", "modality": "headimu"}}' || ']'
    ELSE rtrim(i.issue_codes, ']') || ', ' || '{{"code": "modality_withdrawn", "modality": "headimu"}}' || ']' END AS issue_codes
    FROM issues i FULL JOIN gone g ON i.recording_id = g.recording_id""", *ALL_TABLES, "dropouts")
def issue_codes(spark, sf):
    gone = pen(spark, sf).where("substring(recording_id, 2) % 4 = 0").select(
        "recording_id", F.lit("headimu").alias("modality")).distinct()
    return M.issue_codes(M.dropouts(M.spans(tables(spark, sf))), gone)


@query(f"WITH {COUNTS_SQL} SELECT * FROM counts", "markers")
def task_counts(spark, sf):
    return M.task_counts(markers(spark, sf))


@query("""WITH broken AS (SELECT recording_id, CASE WHEN recording_id <> 'L1' THEN gyro_x END AS gyro_x, gyro_y, gyro_z,
    CASE WHEN recording_id = 'L0' THEN NULL ELSE gravity_x END AS gravity_x, gravity_y, gravity_z FROM imu)
    SELECT recording_id, quantity, missing FROM (
    SELECT recording_id, 'gyro' AS quantity, 'gyro_x' AS missing, count(gyro_x) AS a, count(gyro_y) AS b FROM broken GROUP BY 1
    UNION ALL SELECT recording_id, 'gravity', 'gravity_x', count(gravity_x), count(gravity_y) FROM broken GROUP BY 1)
    WHERE a = 0 AND b > 0""", "imu")
def partial_vector_problems(spark, sf):
    broken = imu(spark, sf).withColumns({
        "gyro_x": F.when(F.col("recording_id") != "L1", F.col("gyro_x")),
        "gravity_x": F.when(F.col("recording_id") != "L0", F.col("gravity_x"))})
    return partial_vectors(column_presence(broken))


@query("""SELECT recording_id, coalesce(max(time_domain) FILTER (modality = 'watch'),
    max(time_domain) FILTER (modality = 'headimu'), '') AS time_domain FROM clocks GROUP BY recording_id""", "clocks")
def primary_clock(spark, sf):
    return M.primary_clock(clocks(spark, sf))


_NOTE = M.NOTE_DIFFERS.replace("'", "''")
_NOTE_PARTS = [_NOTE.split("{modalities}")[0], *_NOTE.split("{modalities}")[1].replace("{domains}", "{primary}").split("{primary}")]


@query(f"""WITH main AS (SELECT recording_id, coalesce(max(time_domain) FILTER (modality = 'watch'),
        max(time_domain) FILTER (modality = 'headimu'), '') AS prim FROM clocks GROUP BY recording_id),
    other AS (SELECT recording_id, prim, string_agg(DISTINCT modality, ', ' ORDER BY modality) AS m,
        string_agg(DISTINCT time_domain, ' / ' ORDER BY time_domain) AS d FROM clocks JOIN main USING (recording_id)
        WHERE time_domain <> prim GROUP BY recording_id, prim)
    SELECT recording_id, coalesce('{_NOTE_PARTS[0]}' || m || '{_NOTE_PARTS[1]}' || d || '{_NOTE_PARTS[2]}' || prim || '{_NOTE_PARTS[3]}' ||
        CASE time_alignment WHEN 'estimated_delta' THEN '{M.NOTE_BY_ALIGNMENT["estimated_delta"].replace("'", "''")}'
        WHEN 'overlap_only' THEN '{M.NOTE_BY_ALIGNMENT["overlap_only"]}' END, '') AS alignment_note
    FROM manifest LEFT JOIN other USING (recording_id)""", "clocks", "manifest")
def alignment_notes(spark, sf):
    return M.alignment_notes(clocks(spark, sf), manifest(spark, sf))


@query("""SELECT recording_id, 'head_model' AS "column", head_model AS model, CASE WHEN has_headimu THEN 'unknown model'
    ELSE 'model without a table' END AS reason FROM manifest WHERE head_model = 'mystery'""", "manifest")
def device_model_problems(spark, sf):
    return M.device_model_problems(manifest(spark, sf))


@query("""SELECT recording_id, participant_id, cohort, watch_hz_nominal, 'unknown' AS handedness, 'none' AS gravity_source,
    -1 AS subject_index, time_alignment, '' AS pipeline_note, NULL::DOUBLE AS head_hz_nominal FROM manifest""", "manifest")
def assembled_manifest(spark, sf):
    """Declared facts and defaults of recordings without any table."""
    meta = manifest(spark, sf).select("recording_id", "participant_id", "cohort", "watch_hz_nominal", "time_alignment")
    derived = M.derived_values(tables(spark, sf))
    rows = M.assemble_manifest(meta, derived, clocks(spark, sf))
    return rows.select("recording_id", "participant_id", "cohort", "watch_hz_nominal", "handedness", "gravity_source",
                       "subject_index", "time_alignment", F.lit("").alias("pipeline_note"), "head_hz_nominal")


_PEN_COLUMNS = ["t_ns", "dot_type", "x", "y", "pressure", "src_timestamp"]


@query(f"""WITH {PEN_SQL}, cols AS (SELECT * FROM (VALUES ('t_ns', 'time', 'ns', 'timestamp'), ('dot_type', 'other', 'category',
    'pen_contact_state'), ('x', 'other', 'device_native', 'pen_position'), ('y', 'other', 'device_native', 'pen_position'),
    ('pressure', 'other', 'device_native', 'pen_pressure'), ('src_timestamp', 'other', 'source_native', 'source_provenance'))
    c("column", quantity, unit, semantics))
    SELECT recording_id, 'pen' AS modality, "column", quantity, unit, semantics, '' AS frame, pen_hz AS sample_rate_hz,
    1.0 AS unit_conversion_factor, CASE WHEN "column" = 'src_timestamp' THEN 'pen_device_clock' ELSE 'wall' END AS time_domain
    FROM pen_rates, cols UNION ALL
    SELECT r.recording_id, 'headimu', c, CASE c WHEN 't_ns' THEN 'time' ELSE c[:-3] END, CASE WHEN c = 't_ns' THEN 'ns'
    WHEN starts_with(c, 'quat') THEN '1' WHEN starts_with(c, 'gyro') THEN 'rad/s' ELSE 'g' END,
    CASE c WHEN 't_ns' THEN 'timestamp' ELSE c[:-3] END, CASE c WHEN 't_ns' THEN '' ELSE 'device' END, r.hz, 1.0, 'wall'
    FROM (SELECT recording_id, round_even(1e9 / quantile_cont(d, 0.5), 3) AS hz FROM (SELECT recording_id, t_ns - lag(t_ns)
    OVER (PARTITION BY recording_id ORDER BY t_ns) AS d FROM imu) GROUP BY recording_id) r,
    (SELECT unnest(['t_ns', 'accel_total_x', 'accel_total_y', 'accel_total_z', 'gyro_x', 'gyro_y', 'gyro_z', 'quat_x',
    'quat_y', 'quat_z', 'quat_w', 'gravity_x', 'gravity_y', 'gravity_z']) AS c)
    WHERE NOT (r.recording_id = 'L2' AND starts_with(c, 'gravity'))""", "pen", "imu")
def channel_rows(spark, sf):
    held = {"pen": pen(spark, sf).select("recording_id", "seq", *_PEN_COLUMNS), "headimu": imu(spark, sf)}
    ids = M.spans(held)
    domains = union_all([
        ids.select("recording_id", "modality", F.lit(None).cast("string").alias("column"), F.lit("wall").alias("time_domain")),
        ids.where("modality = 'pen'").select("recording_id", "modality", F.lit("src_timestamp").alias("column"),
                                             F.lit("pen_device_clock").alias("time_domain"))])
    return M.build_channels(held, domains)


# --- privacy ------------------------------------------------------------------------------------------

SPANS_SQL = """free AS (SELECT recording_id, task_index, min(t_ns) FILTER (event = 'task_start') AS lo,
        max(t_ns) FILTER (event = 'task_end') AS hi FROM markers WHERE task_id IN ('free_writing', 'think_pause_writing')
        AND task_index IS NOT NULL GROUP BY recording_id, task_index)"""
VIEWS["cpen"] = """SELECT 'C' || conv_id AS recording_id, turn AS seq, turn * 1000000000 + 500000000 AS t_ns,
    CAST(length(text) AS DOUBLE) AS x, CASE WHEN turn % 5 <> 0 THEN CAST(turn AS DOUBLE) END AS y FROM conversations"""
HIDDEN_SQL = f"""WITH {SPANS_SQL}, structure AS (SELECT recording_id, bool_or(coalesce(trim(task_id), '') <> '') AS tasks
        FROM markers GROUP BY recording_id),
    judged AS (SELECT p.*, NOT coalesce(s.tasks, FALSE) OR EXISTS (SELECT 1 FROM free f WHERE f.recording_id = p.recording_id
        AND p.t_ns BETWEEN f.lo AND f.hi) AS hidden FROM cpen p LEFT JOIN structure s USING (recording_id)) """


def conversation_pen(spark, sf):
    """A pen event between every two turns of a conversation."""
    return read(spark, sf, "conversations").select(
        F.concat(F.lit("C"), F.col("conv_id").cast("string")).alias("recording_id"), F.col("turn").alias("seq"),
        (F.col("turn") * F.lit(1_000_000_000) + F.lit(500_000_000)).alias("t_ns"),
        F.length("text").cast("double").alias("x"),
        F.when(F.col("turn") % 5 != 0, F.col("turn").cast("double")).alias("y"))


@query(f"""WITH {SPANS_SQL} SELECT recording_id, task_index, lo AS t_start_ns, hi AS t_end_ns FROM free
    WHERE lo IS NOT NULL AND hi IS NOT NULL""", "markers")
def free_writing_spans(spark, sf):
    return privacy.free_writing_spans(markers(spark, sf))


@query(f"""WITH {SPANS_SQL} SELECT recording_id, task_index, (lo IS NOT NULL)::INT AS has_start, (hi IS NOT NULL)::INT
    AS has_end FROM free WHERE lo IS NULL OR hi IS NULL""", "markers")
def unbounded_free_writing(spark, sf):
    return as_int(privacy.unbounded_free_writing(markers(spark, sf)), "has_start", "has_end")


@query("""SELECT recording_id, bool_or(coalesce(trim(task_id), '') <> '')::INT AS has_tasks FROM markers
    GROUP BY recording_id""", "markers")
def task_structure(spark, sf):
    return as_int(privacy.task_structure(markers(spark, sf)), "has_tasks")


@query(HIDDEN_SQL + """SELECT recording_id, seq, CASE WHEN NOT hidden THEN x END AS x, CASE WHEN NOT hidden THEN y END AS y
    FROM judged""", "markers", "cpen")
def redacted_coordinates(spark, sf):
    rows = privacy.redact_coordinates(conversation_pen(spark, sf), markers(spark, sf), "free_writing_xy")
    return rows.select("recording_id", "seq", "x", "y")


@query("SELECT recording_id, seq, NULL::DOUBLE AS x, NULL::DOUBLE AS y FROM cpen", "cpen")
def redacted_everywhere(spark, sf):
    rows = privacy.redact_coordinates(conversation_pen(spark, sf), markers(spark, sf), "all_xy")
    return rows.select("recording_id", "seq", "x", "y")


@query(HIDDEN_SQL + """SELECT recording_id, 'pen' AS modality, count(*) AS violations FROM judged WHERE hidden
    AND (x IS NOT NULL OR y IS NOT NULL) GROUP BY recording_id""", "markers", "cpen")
def redaction_violations(spark, sf):
    return privacy.redaction_violations(conversation_pen(spark, sf), markers(spark, sf), "free_writing_xy")


@query("""SELECT redaction_policy AS value, count(*) AS rows, (redaction_policy <> 'odd')::INT AS known FROM manifest
    GROUP BY redaction_policy""", "manifest")
def redaction_policy_problems(spark, sf):
    return as_int(privacy.redaction_policy_problems(manifest(spark, sf)), "known")


@query("SELECT time_origin AS value, count(*) AS rows, 1 AS known FROM manifest GROUP BY time_origin", "manifest")
def time_origin_problems(spark, sf):
    return as_int(privacy.inconsistent_values(manifest(spark, sf), "time_origin", TIME_ORIGINS), "known")


# --- checks -------------------------------------------------------------------------------------------

def _short(findings, digits=6):
    return rounded(as_int(findings, "passed"), "observed_num", digits=digits).select(
        "check", "recording_id", "modality", "column", "observed_num", "passed")


def _motion(spark, sf):
    return V.all_motion({k: v for k, v in tables(spark, sf).items() if k in ("watch", "watch_rawaccel", "headimu")})


@query("""WITH arrived AS (SELECT recording_id, modality, t_ns < lag(t_ns) OVER (PARTITION BY recording_id, modality
    ORDER BY seq) AS back FROM (SELECT recording_id, 'watch' AS modality, t_ns, seq FROM watch UNION ALL
    SELECT recording_id, 'watch_rawaccel', t_ns, seq FROM rawaccel UNION ALL SELECT recording_id, 'headimu', t_ns, seq FROM imu))
    SELECT 'time_monotonic' AS "check", recording_id, modality, 't_ns' AS "column", CAST(count(*) FILTER (back) AS DOUBLE)
    AS observed_num, (count(*) FILTER (back) = 0)::INT AS passed FROM arrived GROUP BY recording_id, modality""",
       "watch", "rawaccel", "imu")
def check_time_monotonic(spark, sf):
    return _short(V.time_monotonic(_motion(spark, sf)))


@query(f"""WITH {RATES_SQL}, streams AS (SELECT recording_id, modality, n_samples FROM spans
    WHERE modality IN ('watch', 'watch_rawaccel', 'headimu')),
    nominal AS (SELECT recording_id, CASE WHEN left(recording_id, 1) = 'U' AND substr(recording_id, 2)::INT % 2 = 0
    THEN 0.00004::DOUBLE END AS w, CASE WHEN recording_id = 'L0' THEN 40.0::DOUBLE WHEN recording_id = 'L1' THEN 17.0::DOUBLE END
    AS h FROM (SELECT DISTINCT recording_id FROM spans)),
    judged AS (SELECT s.*, r.rate, CASE WHEN s.modality = 'headimu' THEN h ELSE w END AS nominal FROM streams s
    LEFT JOIN rates r USING (recording_id, modality) LEFT JOIN nominal USING (recording_id))
    SELECT 'sample_rate' AS "check", recording_id, modality, 't_ns' AS "column", round_even(rate, 3) AS observed_num,
    CASE WHEN nominal IS NULL THEN 1 ELSE coalesce(abs(rate - nominal) / nominal < 0.2, FALSE)::INT END AS passed FROM judged""",
       *ALL_TABLES)
def check_sample_rate(spark, sf):
    nominal = M.spans(tables(spark, sf)).select("recording_id").distinct().withColumns({
        "watch_hz_nominal": F.when(F.expr("left(recording_id, 1) = 'U' AND substring(recording_id, 2) % 2 = 0"), 0.00004),
        "head_hz_nominal": F.when(F.col("recording_id") == "L0", 40.0).when(F.col("recording_id") == "L1", 17.0)})
    return _short(V.sample_rate(_motion(spark, sf), nominal))


_NORM = "sqrt({0}_x * {0}_x + {0}_y * {0}_y + {0}_z * {0}_z)"
_ANGLE = """degrees(acos(greatest(-1, least(1, (gx * {0}_x + gy * {0}_y + gz * {0}_z) / (sqrt(gx * gx + gy * gy + gz * gz) * """ + _NORM + "))))) "
GRAVITY_SQL = """turned AS (SELECT *, -(2 / size) * (quat_x * quat_z - quat_w * quat_y) AS gx, -(2 / size) * (quat_y * quat_z
        + quat_w * quat_x) AS gy, (2 / size) * (quat_x * quat_x + quat_y * quat_y) - 1 AS gz FROM (SELECT *,
        quat_x * quat_x + quat_y * quat_y + quat_z * quat_z + quat_w * quat_w AS size FROM imu))"""
PHYSICS_SQL = f"""{GRAVITY_SQL}, long AS (
        SELECT recording_id, 'headimu' AS modality, 'accel_total' AS measure, {_NORM.format('accel_total')} AS value FROM imu
        UNION ALL SELECT recording_id, 'headimu', 'gyro', {_NORM.format('gyro')} FROM imu
        UNION ALL SELECT recording_id, 'headimu', 'gravity', {_NORM.format('gravity')} FROM imu
        UNION ALL SELECT recording_id, 'headimu', 'quat', sqrt(size) FROM turned
        UNION ALL SELECT recording_id, 'headimu', 'flat_gz', gravity_z FROM imu WHERE greatest(abs(gravity_x), abs(gravity_y)) < 0.1
        UNION ALL SELECT recording_id, 'headimu', 'quat_gravity_angle', {_ANGLE.format('gravity')} FROM turned WHERE gravity_x IS NOT NULL
        UNION ALL SELECT recording_id, 'watch', 'accel_user', {_NORM.format('accel_user')} FROM watch
        UNION ALL SELECT recording_id, 'watch', 'gyro', {_NORM.format('gyro')} FROM watch
        UNION ALL SELECT recording_id, 'watch_rawaccel', 'accel_total', {_NORM.format('accel_total')} FROM rawaccel),
    stats AS (SELECT recording_id, modality, measure, count(*) AS n, quantile_cont(value, 0.5) AS median,
        quantile_cont(value, 0.95) AS p95, quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr
        FROM long WHERE value IS NOT NULL GROUP BY recording_id, modality, measure)"""


@query(f"""WITH {PHYSICS_SQL}, found AS (
    SELECT 'accel_semantic_band' AS "check", recording_id, modality, measure AS "column", round_even(median, 5) AS observed_num,
        CASE measure WHEN 'accel_user' THEN median BETWEEN 0 AND 0.2 ELSE median BETWEEN 0.9 AND 1.1 END AS ok FROM stats
        WHERE measure IN ('accel_user', 'accel_total')
    UNION ALL SELECT 'gravity_norm', recording_id, modality, measure, round_even(median, 5),
        median BETWEEN 0.99 AND 1.01 AND iqr < 0.01 FROM stats WHERE measure = 'gravity'
    UNION ALL SELECT 'gravity_sign', recording_id, modality, 'gravity', round_even(median, 4), median < 0 FROM stats
        WHERE measure = 'flat_gz' AND n > 10
    UNION ALL SELECT 'gyro_range', recording_id, modality, measure, round_even(median, 5),
        median BETWEEN 0.005 AND 2 AND p95 < 20 FROM stats WHERE measure = 'gyro'
    UNION ALL SELECT 'quat_norm', recording_id, modality, measure, round_even(median, 6), median BETWEEN 0.999 AND 1.001
        FROM stats WHERE measure = 'quat' AND n >= 100
    UNION ALL SELECT 'quat_gravity_agreement', recording_id, modality, 'quat', round_even(median, 4), median < 2 FROM stats
        WHERE measure = 'quat_gravity_angle' AND n >= 100
    UNION ALL SELECT 'quat_still_agreement', recording_id, modality, 'quat', NULL, FALSE FROM stats
        WHERE measure = 'quat' AND n >= 100 AND recording_id = 'L2')
    SELECT "check", recording_id, modality, "column", round(observed_num, 6) AS observed_num, ok::INT AS passed FROM found""",
       "watch", "rawaccel", "imu")
def check_physics(spark, sf):
    """All vector checks.  The recording without gravity has no still samples, so its fallback fails."""
    return _short(V.physics_findings(V.physics(_motion(spark, sf))))


@query(f"""WITH calm AS (SELECT * REPLACE (gyro_x / 100 AS gyro_x, gyro_y / 100 AS gyro_y, gyro_z / 100 AS gyro_z) FROM imu),
    {GRAVITY_SQL.replace('FROM imu', 'FROM calm')}, rates AS (SELECT recording_id, 2 * CAST(round_even(1e9 / quantile_cont(d, 0.5), 0) AS BIGINT) AS win
    FROM (SELECT recording_id, t_ns - lag(t_ns) OVER (PARTITION BY recording_id ORDER BY t_ns) AS d FROM calm) GROUP BY recording_id),
    judged AS (SELECT *, max({_NORM.format('gyro')}) OVER (PARTITION BY recording_id ORDER BY t_ns
    ROWS BETWEEN win // 2 PRECEDING AND (win - 1) // 2 FOLLOWING) < 0.05 AS still FROM turned JOIN rates USING (recording_id))
    SELECT recording_id, round(quantile_cont({_ANGLE.format('accel_total')}, 0.5), 4) AS median, count(*) AS n
    FROM judged WHERE still GROUP BY recording_id""", "imu")
def still_orientation(spark, sf):
    """The fallback without gravity columns, on recordings made calm enough to have still samples."""
    calm = imu(spark, sf).withColumns({c: F.col(c) / 100 for c in VECTORS["gyro"]}).drop(*VECTORS["gravity"])
    stats = V.physics(V.all_motion({"watch": calm})).where("measure = 'still_angle'")
    return rounded(stats, "median", digits=4).select("recording_id", "median", "n")


@query("""WITH used AS (SELECT DISTINCT recording_id, CASE WHEN seq % 50 = 0 THEN 'PEN_' || seq % 3 ELSE dot_type END AS value
    FROM pen), strange AS (SELECT * FROM used WHERE value NOT IN ('PEN_DOWN', 'PEN_MOVE', 'PEN_UP', 'PEN_HOVER'))
    SELECT recording_id, value AS observed, 0 AS passed FROM strange UNION ALL SELECT DISTINCT recording_id, '-', 1 FROM pen
    WHERE recording_id NOT IN (SELECT recording_id FROM strange)""", "pen")
def check_dot_types(spark, sf):
    odd = F.when(F.col("seq") % 50 == 0, F.concat(F.lit("PEN_"), (F.col("seq") % 3).cast("string")))
    rows = pen(spark, sf).withColumn("dot_type", F.coalesce(odd, "dot_type"))
    return as_int(V.dot_type_vocabulary(rows), "passed").select("recording_id", "observed", "passed")


@query("""WITH strange AS (SELECT DISTINCT recording_id, label FROM nested WHERE label NOT IN ('focused', 'distracted'))
    SELECT recording_id, label AS observed, 0 AS passed FROM strange""", "nested")
def check_attention_labels(spark, sf):
    return as_int(V.attention_label_vocabulary(nested(spark, sf)), "passed").select("recording_id", "observed", "passed")


def _meta(spark, sf, held=None):
    ids = M.spans(held or tables(spark, sf)).groupBy("recording_id").agg(F.min("t_start_ns").alias("s"))
    number = F.expr("CAST(substring(recording_id, 2) AS INT)")
    return ids.select(
        "recording_id", F.when(number % 4 == 0, "recording_start").otherwise("unix_epoch").alias("time_origin"),
        F.when(number % 3 == 0, "user").when(number % 3 == 1, "total").otherwise("other").alias("accel_semantics"),
        F.when(number % 5 == 0, "guess").otherwise("shared_clock").alias("time_alignment"),
        F.when(number % 2 == 0, F.col("s") + (number % 7) * F.lit(30_000_000_000)).alias("session_start_ns"),
        F.when(number % 6 == 0, number).alias("src_payload_dropped_key_count"),
        F.when(number % 6 == 1, number / 7.0).alias("attention_protocol_tail_s"))


VIEWS["meta"] = """SELECT recording_id, CASE WHEN k % 4 = 0 THEN 'recording_start' ELSE 'unix_epoch' END AS time_origin,
    CASE k % 3 WHEN 0 THEN 'user' WHEN 1 THEN 'total' ELSE 'other' END AS accel_semantics,
    CASE WHEN k % 5 = 0 THEN 'guess' ELSE 'shared_clock' END AS time_alignment,
    CASE WHEN k % 2 = 0 THEN s + (k % 7) * 30000000000::BIGINT END AS session_start_ns,
    CASE WHEN k % 6 = 0 THEN k END AS dropped, CASE WHEN k % 6 = 1 THEN k / 7.0::DOUBLE END AS tail
    FROM (SELECT recording_id, substr(recording_id, 2)::INT AS k, min(t_start_ns) AS s FROM spans GROUP BY recording_id)"""


@query("""SELECT 'time_magnitude' AS "check", recording_id, modality, '-' AS "column", CAST(t_start_ns AS DOUBLE) AS observed_num,
    (CASE WHEN time_origin = 'recording_start' THEN t_start_ns >= 0 AND t_start_ns < 1000000000000000000
    ELSE t_start_ns BETWEEN 1000000000000000000 AND 2000000000000000000 END)::INT AS passed
    FROM spans JOIN meta USING (recording_id)""", *ALL_TABLES, "meta")
def check_time_magnitude(spark, sf):
    return _short(V.time_magnitude(M.spans(tables(spark, sf)), _meta(spark, sf)))


@query("""WITH leaks AS (SELECT recording_id, modality, CASE WHEN modality = 'attention' THEN 't_end_ns, t_start_ns'
    WHEN modality = 'pen' AND substr(recording_id, 2)::INT % 2 = 0 THEN 'src_timestamp, t_ns' ELSE 't_ns' END AS text FROM spans
    WHERE left(recording_id, 1) = 'U')
    SELECT s.recording_id, s.modality, coalesce(l.text, 'none') AS observed, (l.text IS NULL)::INT AS passed FROM spans s
    JOIN meta m ON s.recording_id = m.recording_id AND m.time_origin = 'recording_start'
    LEFT JOIN leaks l ON s.recording_id = l.recording_id AND s.modality = l.modality""", *ALL_TABLES, "meta")
def check_no_unix_timestamps(spark, sf):
    held = tables(spark, sf)
    found = V.no_unix_timestamps(held, M.spans(held), _meta(spark, sf))
    return as_int(found, "passed").select("recording_id", "modality", "observed", "passed")


@query("""SELECT 'streams_overlap' AS "check", recording_id, string_agg(modality, '+' ORDER BY modality) AS modality, '-' AS "column",
    round_even((min(t_end_ns) - max(t_start_ns)) / 1e9, 3) AS observed_num, (min(t_end_ns) > max(t_start_ns))::INT AS passed
    FROM spans ANTI JOIN dropouts USING (recording_id, modality) GROUP BY recording_id HAVING count(*) > 1""",
       *ALL_TABLES, "dropouts")
def check_streams_overlap(spark, sf):
    span = M.spans(tables(spark, sf))
    return _short(V.streams_overlap(span, M.dropouts(span)))


@query("""SELECT 'modality_dropout' AS "check", recording_id, modality, '-' AS "column", coverage_ratio AS observed_num,
    1 AS passed FROM dropouts""", *ALL_TABLES, "dropouts")
def check_modality_dropout(spark, sf):
    return _short(V.modality_dropout(M.dropouts(M.spans(tables(spark, sf)))))


@query("""SELECT 'spill_guard' AS "check", recording_id, modality, '-' AS "column",
    round_even((session_start_ns - t_start_ns) / 1e9, 3) AS observed_num,
    ((session_start_ns - t_start_ns) / 1e9 <= 60)::INT AS passed FROM spans JOIN meta USING (recording_id)
    WHERE session_start_ns IS NOT NULL""", *ALL_TABLES, "meta")
def check_spill_guard(spark, sf):
    return _short(V.spill_guard(M.spans(tables(spark, sf)), _meta(spark, sf)))


@query("""SELECT 'payload_keys_redacted' AS "check", recording_id, 'markers' AS modality, '-' AS "column",
    CAST(dropped AS DOUBLE) AS observed_num, 1 AS passed FROM meta WHERE dropped IS NOT NULL UNION ALL
    SELECT 'attention_protocol_tail', recording_id, 'attention', '-', round_even(tail, 3), 1 FROM meta WHERE tail IS NOT NULL""",
       *ALL_TABLES, "meta")
def check_reported_quantities(spark, sf):
    meta = _meta(spark, sf)
    return _short(V.reported(meta, "payload_keys_redacted", "src_payload_dropped_key_count", "markers", 0, "").unionByName(
        V.reported(meta, "attention_protocol_tail", "attention_protocol_tail_s", "attention", 3, "")))


@query("""SELECT recording_id, (h.lo <= a.lo AND a.hi <= h.hi)::INT AS passed FROM (SELECT recording_id, min(t_start_ns) AS lo,
    max(t_end_ns) AS hi FROM attention GROUP BY recording_id) a JOIN (SELECT recording_id, min(t_ns) AS lo, max(t_ns) AS hi
    FROM motion GROUP BY recording_id) h USING (recording_id)""", "attention", "motion")
def check_attention_range(spark, sf):
    span = M.spans({"headimu": motion(spark, sf), "attention": attention(spark, sf)})
    return as_int(V.attention_within_headimu_range(span), "passed").select("recording_id", "passed")


@query("""SELECT recording_id, CASE left(recording_id, 1) WHEN 'U' THEN 'watch' ELSE 'headimu' END AS modality,
    accel_semantics AS observed, (CASE left(recording_id, 1) WHEN 'U' THEN accel_semantics = 'user'
    ELSE accel_semantics = 'total' END)::INT AS passed FROM meta
    WHERE recording_id IN (SELECT recording_id FROM watch UNION SELECT recording_id FROM imu)""", *ALL_TABLES, "meta")
def check_accel_semantics(spark, sf):
    held = tables(spark, sf)
    columns = M.stored_columns({m: held[m] for m in ("watch", "headimu")})
    found = V.accel_semantics_matches_columns(M.spans(held), _meta(spark, sf), columns)
    return as_int(found, "passed").select("recording_id", "modality", "observed", "passed")


@query("""SELECT recording_id, time_alignment AS observed, (time_alignment = 'shared_clock')::INT AS passed FROM meta""",
       *ALL_TABLES, "meta")
def check_time_alignment(spark, sf):
    found = V.time_alignment_vocabulary(_meta(spark, sf), M.spans(tables(spark, sf)))
    return as_int(found, "passed").select("recording_id", "observed", "passed")


def _coverage_sql() -> str:
    wanted = [f"SELECT recording_id, '{modality}' AS modality, '{check}' AS \"check\", {str(exempt).upper()} AS exempt "
              f"FROM manifest WHERE {flag}" for flag, modality, check, _, exempt in V.required_checks()]
    wanted.append("SELECT recording_id, 'attention', 'attention_within_headimu_range', FALSE FROM manifest "
                  "WHERE has_attention AND has_headimu")
    wanted.append("SELECT recording_id, 'watch', 'quat_gravity_agreement or quat_still_agreement', TRUE FROM manifest "
                  "WHERE has_quaternion")
    return f"""WITH wanted AS ({" UNION ALL ".join(wanted)}),
    ran AS (SELECT 'R' || l_orderkey AS recording_id, CASE l_returnflag WHEN 'A' THEN 'watch' WHEN 'N' THEN 'pen' ELSE 'headimu' END
        AS modality, CASE l_linenumber % 4 WHEN 0 THEN 'time_monotonic' WHEN 1 THEN 'sample_rate' WHEN 2 THEN 'gyro_range'
        ELSE 'quat_still_agreement' END AS "check" FROM lineitem),
    seen AS (SELECT * FROM ran UNION ALL SELECT recording_id, modality, 'quat_gravity_agreement or quat_still_agreement'
        FROM ran WHERE "check" = 'quat_still_agreement')
    SELECT w.recording_id, w.modality, w."check" FROM wanted w ANTI JOIN seen s ON w.recording_id = s.recording_id
    AND w.modality = s.modality AND w."check" = s."check"
    WHERE NOT (w.exempt AND w.modality = 'watch' AND substr(w.recording_id, 2)::INT % 8 = 0)"""


@query(_coverage_sql(), "manifest")
def coverage_gaps(spark, sf):
    """Checks a manifest demands against findings that only partly ran."""
    listed = manifest(spark, sf)
    check = (F.when(F.col("l_linenumber") % 4 == 0, "time_monotonic").when(F.col("l_linenumber") % 4 == 1, "sample_rate")
             .when(F.col("l_linenumber") % 4 == 2, "gyro_range").otherwise("quat_still_agreement"))
    ran = read(spark, sf, "lineitem").select(
        F.concat(F.lit("R"), F.col("l_orderkey").cast("string")).alias("recording_id"),
        F.when(F.col("l_returnflag") == "A", "watch").when(F.col("l_returnflag") == "N", "pen").otherwise("headimu")
        .alias("modality"), check.alias("check"))
    short = listed.where("substring(recording_id, 2) % 8 = 0").select("recording_id", F.lit("watch").alias("modality"))
    return V.coverage_gaps(listed, ran, short).select("recording_id", "modality", "check")


_DECLARED = "declared AS (" + " UNION ALL ".join(
    f"SELECT recording_id, '{m}' AS modality FROM manifest WHERE {flag}" for flag, m in MODALITY_FLAGS.items()) + ")"
_HELD = """held AS (SELECT DISTINCT 'R' || o_custkey AS recording_id, CASE o_orderkey % 3 WHEN 0 THEN 'watch' WHEN 1 THEN 'pen'
    ELSE 'attention' END AS modality FROM orders)"""


def _held(spark, sf):
    kind = (F.when(F.col("o_orderkey") % 3 == 0, "watch").when(F.col("o_orderkey") % 3 == 1, "pen").otherwise("attention"))
    return read(spark, sf, "orders").select(
        F.concat(F.lit("R"), F.col("o_custkey").cast("string")).alias("recording_id"), kind.alias("modality"))


@query(f"""WITH {_DECLARED}, {_HELD} SELECT *, 'declared but missing' AS problem FROM declared ANTI JOIN held
    USING (recording_id, modality) UNION ALL SELECT *, 'present but not declared' FROM held ANTI JOIN declared
    USING (recording_id, modality)""", "manifest")
def inventory_problems(spark, sf):
    return V.inventory_problems(V.declared_tables(manifest(spark, sf)), _held(spark, sf))


@query(f"""WITH {_DECLARED}, {_HELD} SELECT modality || '/' || recording_id || ' declared but missing' AS observed FROM declared
    ANTI JOIN held USING (recording_id, modality) UNION ALL SELECT modality || '/' || recording_id || ' present but not declared'
    FROM held ANTI JOIN declared USING (recording_id, modality)""", "manifest")
def check_manifest_consistency(spark, sf):
    return V.manifest_consistency(V.declared_tables(manifest(spark, sf)), _held(spark, sf)).select("observed")


@query(f"""WITH {_DECLARED} SELECT DISTINCT recording_id, modality FROM channels ANTI JOIN declared
    USING (recording_id, modality)""", "manifest", "channels")
def undeclared_channels(spark, sf):
    return V.undeclared_channels(channels(spark, sf), V.declared_tables(manifest(spark, sf)))


@query("""SELECT 'R' || o_custkey AS recording_id, count(*) AS rows FROM orders GROUP BY o_custkey HAVING count(*) > 1""")
def duplicate_ids(spark, sf):
    return V.duplicate_ids(_held(spark, sf))


@query("""SELECT recording_id, field FROM (SELECT recording_id, 'n_samples_watch' AS field FROM spans
    WHERE modality = 'watch' AND n_samples % 3 = 0 UNION ALL SELECT recording_id, 'has_pen' FROM (SELECT DISTINCT recording_id
    FROM spans) WHERE substr(recording_id, 2)::INT % 5 = 0 UNION ALL SELECT 'gone' || c_custkey, 'has_watch' FROM customer WHERE c_custkey % 7 = 0)""", *ALL_TABLES)
def manifest_drift(spark, sf):
    """A stored manifest with two kinds of tampering and with recordings that have no table."""
    held = tables(spark, sf)
    stored = M.derived_values(held).withColumns({
        "n_samples_watch": F.when((F.col("n_samples_watch") % 3 == 0) & (F.col("n_samples_watch") > 0),
                                  F.col("n_samples_watch") + 1).otherwise(F.col("n_samples_watch")),
        "has_pen": F.when(F.expr("substring(recording_id, 2) % 5 = 0"), ~F.col("has_pen")).otherwise(F.col("has_pen"))})
    gone = read(spark, sf, "customer").where("c_custkey % 7 = 0").select(F.concat(F.lit("gone"), F.col("c_custkey").cast("string")).alias("recording_id"), F.lit(True).alias("has_watch"))
    return V.manifest_drift(stored.unionByName(gone, allowMissingColumns=True), held).select("recording_id", "field")


@query("""SELECT recording_id, modality, "column", problem FROM (
    SELECT recording_id, 'pen' AS modality, 'x' AS "column", 'missing descriptor' AS problem, k % 4 = 0 AS hit FROM ids
    UNION ALL SELECT recording_id, 'pen', 'extra', 'describes no stored column', k % 4 = 1 FROM ids
    UNION ALL SELECT recording_id, 'pen', 'y', 'wrong unit', k % 4 = 2 FROM ids
    UNION ALL SELECT recording_id, 'pen', 't_ns', 'invalid unit_conversion_factor', k % 4 = 3 FROM ids
    UNION ALL SELECT recording_id, 'pen', 'dot_type', 'no time_domain', k % 7 = 0 FROM ids
    UNION ALL SELECT recording_id, 'pen', 'pressure', 'duplicate descriptor', k % 7 = 1 FROM ids) WHERE hit""".replace(
    "FROM ids", "FROM (SELECT DISTINCT recording_id, substr(recording_id, 2)::INT AS k FROM pen)"), "pen")
def descriptor_problems(spark, sf):
    """Channel rows damaged in six ways against the pen tables they describe."""
    held = {"pen": pen(spark, sf).select("recording_id", "seq", *_PEN_COLUMNS)}
    ids = held["pen"].select("recording_id").distinct()
    domains = ids.select("recording_id", F.lit("pen").alias("modality"), F.lit(None).cast("string").alias("column"),
                         F.lit("wall").alias("time_domain"))
    good = M.build_channels(held, domains)
    k, column = F.expr("CAST(substring(recording_id, 2) AS INT)"), F.col("column")
    damaged = good.where(~((k % 4 == 0) & (column == "x"))).withColumns({
        "unit": F.when((k % 4 == 2) & (column == "y"), "mm").otherwise(F.col("unit")),
        "unit_conversion_factor": F.when((k % 4 == 3) & (column == "t_ns"), F.lit(None)).otherwise(F.col("unit_conversion_factor")),
        "time_domain": F.when((k % 7 == 0) & (column == "dot_type"), "").otherwise(F.col("time_domain"))})
    extra = good.where((k % 4 == 1) & (column == "x")).withColumn("column", F.lit("extra"))
    twice = good.where((k % 7 == 1) & (column == "pressure"))
    listed = ids.withColumns({"has_pen": F.lit(True), "time_domain": F.lit("wall")})
    return V.descriptor_problems(damaged.unionByName(extra).unionByName(twice), held, listed)


@query("""SELECT DISTINCT recording_id, 'pen' AS modality, 'schema_version' AS stamp, '0.9' AS observed FROM pen WHERE seq % 40 = 0
    UNION ALL SELECT DISTINCT recording_id, 'pen', 'stamped_id', 'U0' FROM pen WHERE seq % 50 = 0 AND recording_id <> 'U0'
    UNION ALL SELECT recording_id, '-', 'schema_version', '2.0' FROM manifest WHERE has_attention""", "pen", "manifest")
def stamp_problems(spark, sf):
    rows = pen(spark, sf).withColumns({
        "schema_version": F.when(F.col("seq") % 40 == 0, "0.9").otherwise("1.0"),
        "stamped_id": F.when(F.col("seq") % 50 == 0, "U0").otherwise(F.col("recording_id"))})
    listed = manifest(spark, sf).withColumn("schema_version", F.when(F.col("has_attention"), "2.0").otherwise("1.0"))
    return V.stamp_problems({"pen": rows}, listed)


def _all_findings_sql() -> str:
    """The SQL of every part; what the parts measure on streams of their own is said anew for these tables."""
    whole = 'SELECT "check", recording_id, modality, "column", passed FROM'
    def part(name, check, modality=None, column="-"):
        return (f"SELECT '{check}' AS \"check\", recording_id, {'modality' if modality is None else repr(modality)} AS modality, "
                f"'{column}' AS \"column\", passed FROM ({ORACLES[name]})")
    parts = [f"{whole} ({ORACLES[name]})" for name in ("check_time_monotonic", "check_physics", "check_time_magnitude", "check_streams_overlap",
                                                       "check_modality_dropout", "check_spill_guard", "check_reported_quantities")]
    parts += [part("check_no_unix_timestamps", "no_unix_timestamps"), part("check_accel_semantics", "accel_semantics_matches_columns")]
    here = [f"""SELECT 'sample_rate', recording_id, modality, 't_ns', 1 FROM spans WHERE modality IN ('watch', 'watch_rawaccel', 'headimu')""",
            f"""SELECT 'time_alignment_vocabulary', recording_id, CASE WHEN recording_id IN (SELECT recording_id FROM watch) THEN 'watch'
                WHEN recording_id IN (SELECT recording_id FROM imu) THEN 'headimu' ELSE '-' END, '-', (time_alignment = 'shared_clock')::INT FROM meta""",
            "SELECT DISTINCT 'dot_type_vocabulary', recording_id, 'pen', 'dot_type', 1 FROM pen",
            "SELECT DISTINCT 'attention_label_vocabulary', recording_id, 'attention', 'label', 1 FROM attention",
            """SELECT 'attention_within_headimu_range', a.recording_id, 'attention', '-', (h.t_start_ns <= a.t_start_ns AND a.t_end_ns <= h.t_end_ns)::INT
                FROM spans a JOIN spans h ON a.recording_id = h.recording_id AND a.modality = 'attention' AND h.modality = 'headimu'"""]
    return " UNION ALL ".join([*parts, *here])


@query(_all_findings_sql(), *ALL_TABLES, "meta")
def all_findings(spark, sf):
    """Every check on every table, as one report; its parts are compared one by one above."""
    held = tables(spark, sf)
    found = V.check_tables(held, _meta(spark, sf, held))
    return as_int(found, "passed").select("check", "recording_id", "modality", "column", "passed")


@query("""WITH found AS (SELECT modality AS "check", time_domain <> '' AS ok FROM channels)
    SELECT "check", count(*) AS findings, count(*) FILTER (NOT ok) AS failed FROM found GROUP BY "check" """, "channels")
def report_summary(spark, sf):
    found = channels(spark, sf).select(F.col("modality").alias("check"), (F.col("time_domain") != "").alias("passed"))
    return V.summary(found)


# --- publishing -----------------------------------------------------------------------------------------

def _pen_collection(spark, sf, dots):
    """The pen recordings as a collection that can be published: tables, manifest and channels."""
    held = {"pen": dots}
    ids = dots.select("recording_id").distinct()
    declared = ids.withColumns({"participant_id": F.concat(F.lit("P"), "recording_id"), "cohort": F.lit("X"), "pipeline": F.lit("p"), "time_alignment": F.lit("shared_clock"),
                                "pen_model": F.lit("unknown"), "session_start_ns": F.lit(None).cast("bigint")})
    domains = ids.select("recording_id", F.lit("pen").alias("modality"), F.lit(None).cast("string").alias("column"), F.lit("wall").alias("time_domain"))
    rates = durable(M.table_rates(held))
    return held, M.build_manifest(held, declared, domains, rates=rates), M.build_channels(held, domains, rates=rates)


def _dots(spark, sf):
    return pen(spark, sf).select("recording_id", "seq", *_PEN_COLUMNS)


def _root(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or tempfile.mkdtemp(prefix="spark-")
    return f"{shared}/{uuid.uuid4().hex}"


@query("""SELECT p.recording_id, p.seq, p.t_ns, p.dot_type, n.n AS n_samples_pen, 6 AS described FROM pen p
    JOIN (SELECT recording_id, count(*) AS n FROM pen GROUP BY recording_id) n USING (recording_id)""", "pen")
def published_collection(spark, sf):
    """Staged, checked, published and read again through the manifest and channels of the release."""
    root = _root(spark)
    publish(*_pen_collection(spark, sf, _dots(spark, sf)), root)
    release = published(spark, root)
    listed, described = scan_manifest(spark, release, strict=True), scan_channels(spark, release, strict=True)
    counted = described.groupBy("recording_id").agg(F.count("*").cast("int").alias("described"))
    return scan_modality(spark, release, "pen").join(listed.select("recording_id", "n_samples_pen"), "recording_id").join(counted, "recording_id").select(
        "recording_id", "seq", "t_ns", "dot_type", "n_samples_pen", "described")


@query("""SELECT 'dot_type_vocabulary' AS "check", recording_id, 'PEN_ODD' AS observed, 0 AS published FROM (SELECT DISTINCT recording_id FROM pen WHERE seq % 50 = 0)""", "pen")
def refused_collection(spark, sf):
    """A collection with strange dot types: the failed findings of its report, and whether anything was published."""
    root = _root(spark)
    odd = _dots(spark, sf).withColumn("dot_type", F.when(F.col("seq") % 50 == 0, "PEN_ODD").otherwise(F.col("dot_type")))
    try:
        publish(*_pen_collection(spark, sf, odd), root)
    except ValueError:
        pass
    return V.failed(latest_report(spark, root)).select("check", "recording_id", "observed", F.lit(int(published(spark, root) is not None)).alias("published"))


@query("""WITH held AS (SELECT DISTINCT recording_id, recording_id IN (SELECT recording_id FROM pen WHERE seq % 50 = 0) AS odd FROM pen)
    SELECT "check", count(*) AS findings, count(*) FILTER (bad) AS failed FROM (SELECT 'dot_type_vocabulary' AS "check", odd AS bad FROM held
    UNION ALL SELECT 'time_magnitude', FALSE FROM held UNION ALL SELECT 'time_alignment_vocabulary', FALSE FROM held) GROUP BY "check" """, "pen")
def archive_summary(spark, sf):
    """Findings and failures by check of an audit over the files of a staged collection."""
    folder = _root(spark)
    odd = _dots(spark, sf).withColumn("dot_type", F.when(F.col("seq") % 50 == 0, "PEN_ODD").otherwise(F.col("dot_type")))
    sinks.write_collection(*_pen_collection(spark, sf, odd), folder)
    sinks.checksum_inventory(spark, folder).select(F.concat("sha256", F.lit("  "), "path").alias("value")).write.text(f"{folder}_sha256")
    return V.summary(audit(spark, folder))
