"""Ingest rules, payload handling and sinks over rows derived from the given tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import functions as F

from motionloom.functions import payload as J
from motionloom.functions import text as T
from motionloom.operators import motion as M
from motionloom.sources import exports as X
from motionloom.sources import sinks
from motionloom.plans.select import load_recordings
from motionloom.sources.bundle import scan_modality, stored_modality
from motionloom.sources.files import path_part
from motionloom.sources.zones import recordings_of
from motionloom.vocabulary import ACTIVITY_NAMES, NOTEBOOK_DRAW_TYPES, PEN_EVENTS_FLAT, TASK_NAMES

from .projections import VIEWS, imu, motion, nested, pen, query, read

_ID = "CAST(event_id AS VARCHAR)"


def _events(spark, sf):
    return read(spark, sf, "events")


def _case(column: str, mapping: dict, default: str = "NULL") -> str:
    tests = " ".join(f"WHEN {column} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {tests} ELSE {default} END"


# --- columns ------------------------------------------------------------------------------------------

@query("""SELECT 'U' || user_id AS recording_id, event_id AS seq, epoch_us(ts) * 1000 AS t_ns, value AS accel_user_x,
    value * 2 AS accel_user_y, value * 3 AS accel_user_z, event_id AS src_sequence FROM events""")
def mapped_columns(spark, sf):
    """Text columns of an export cast and renamed, with provenance kept; every third clock reading has a fraction."""
    micros = F.unix_micros(F.col("ts").cast("timestamp")).cast("string")
    raw = _events(spark, sf).select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("recording_id"), F.col("event_id").alias("seq"),
        F.when(F.col("event_id") % 3 == 0, F.concat(micros, F.lit(".0"))).otherwise(micros).alias("ts"), F.col("value").cast("string").alias("ax"),
        (F.col("value") * 2).cast("string").alias("ay"), (F.col("value") * 3).cast("string").alias("az"),
        F.col("event_id").cast("string").alias("sequence"))
    from motionloom.functions.clock import text_to_unix_ns
    return X.mapped(raw, text_to_unix_ns(F.col("ts"), "us"), X.vector_map({"accel_user": ("ax", "ay", "az")}),
                    {"sequence": F.col("sequence").cast("bigint")})


@query("""SELECT recording_id, c AS "column" FROM (SELECT recording_id, unnest(['accel_total_x', 'gyro_x', 'gravity_x', 't_ns'])
    AS c FROM (SELECT DISTINCT recording_id FROM imu)) WHERE NOT (c = 'gravity_x' AND recording_id = 'L2')""", "imu")
def column_presence(spark, sf):
    held = M.column_presence(imu(spark, sf), ["accel_total_x", "gyro_x", "gravity_x", "t_ns"])
    return held.select("recording_id", F.explode("columns").alias("column"))


@query("""SELECT recording_id, CASE WHEN recording_id = 'L0' THEN 'neither kind of acceleration is there'
    ELSE 'no attitude quaternion to take gravity from' END AS reason FROM (SELECT DISTINCT recording_id FROM imu)
    WHERE recording_id IN ('L0', 'L1')""", "imu")
def underivable_acceleration(spark, sf):
    rows = imu(spark, sf).withColumns({
        "accel_total_x": F.when(F.col("recording_id") != "L0", F.col("accel_total_x")),
        "quat_w": F.when(F.col("recording_id") != "L1", F.col("quat_w"))})
    return M.user_acceleration_problems(M.column_presence(rows))


# --- events -------------------------------------------------------------------------------------------

_KIND = "CASE event_id % 5 WHEN 0 THEN 'pen_down' WHEN 1 THEN 'pen_dot' WHEN 2 THEN 'pen_up' WHEN 3 THEN 'pen_session_sync' ELSE 'phase' END"


def _kind():
    return F.expr(_KIND)


@query(f"""SELECT {_ID} AS path, 0 AS seq, CASE WHEN user_id % 2 = 0 THEN 'flat' ELSE 'nested' END AS generation,
    epoch_us(ts) // 1000 AS t_ms, {_KIND} AS event, value AS x FROM events UNION ALL
    SELECT {_ID}, 1, 'nested', epoch_us(ts) // 1000 + 5, 'phase', NULL FROM events WHERE user_id % 2 = 1 UNION ALL
    SELECT {_ID}, 1, 'flat', epoch_us(ts) // 1000 + 5, 'pen_up', value * 2 FROM events WHERE user_id % 2 = 0""")
def session_events(spark, sf):
    """Session JSON of both generations: nested events, or events beside a flat pen list."""
    ms = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000).cast("bigint")

    def event(at, kind, body):
        return F.struct(at.alias("t_ms"), F.lit(1.5).alias("t_session_ms"), kind.alias("event"), body.alias("payload"))
    first = event(ms, _kind(), F.struct(F.col("value").alias("x")))
    second = event(ms + 5, F.lit("phase"), F.struct(F.lit(None).cast("double").alias("x")))
    entry = F.struct((ms + 5).alias("t_ms"), F.lit("pen_up").alias("type"), (F.col("value") * 2).alias("x"))
    nested = F.to_json(F.struct(F.array(first, second).alias("events")))
    flat = F.to_json(F.struct(F.array(first).alias("events"), F.array(entry).alias("pen_events")))
    text = _events(spark, sf).select(F.col("event_id").cast("string").alias("path"),
                                     F.when(F.col("user_id") % 2 == 0, flat).otherwise(nested).alias("text"))
    files = text.select("path", F.from_json("text", X.SESSION_JSON).alias("j")).select("path", "j.*")
    return X.session_events(files).select(
        "path", F.pmod("seq", F.lit(1 << 40)).alias("s"), "generation", "t_ms", "event", "flat",
        F.get_json_object("payload", "$.x").cast("double").alias("x")).select(
        "path", F.when(F.col("flat"), 1).otherwise(F.col("s")).cast("int").alias("seq"), "generation", "t_ms", "event", "x")


@query(f"""SELECT event_id AS seq, 'pen' AS target, CASE event_id % 5 WHEN 0 THEN 'PEN_DOWN' WHEN 1 THEN 'PEN_MOVE'
    ELSE 'PEN_UP' END AS name FROM events WHERE event_id % 5 < 3 UNION ALL
    SELECT event_id, 'markers', {_KIND} FROM events WHERE event_id % 5 >= 3""")
def routed_events(spark, sf):
    """Strokes go to the pen table with their dot type, everything else to the markers."""
    strokes, rest = X.route_events(_events(spark, sf).withColumn("kind", _kind()), "kind", PEN_EVENTS_FLAT)
    return strokes.select(F.col("event_id").alias("seq"), F.lit("pen").alias("target"), F.col("dot_type").alias("name")).unionByName(
        rest.select(F.col("event_id").alias("seq"), F.lit("markers").alias("target"), F.col("kind").alias("name")))


@query(f"""SELECT seq, t_ns, event, src_payload FROM (SELECT event_id AS seq, epoch_us(ts) * 1000 AS t_ns, {_KIND} AS event,
    props AS src_payload FROM events WHERE event_id % 5 = 4 UNION ALL SELECT event_id, epoch_us(ts) * 1000, {_KIND}, ''
    FROM events WHERE event_id % 5 = 3)""")
def merged_markers(spark, sf):
    """Session events and pen events without a position in one marker table."""
    rows = _events(spark, sf).withColumns({"kind": _kind(), "recording_id": F.col("user_id").cast("string"),
                                           "seq": F.col("event_id")})
    at = F.unix_micros(F.col("ts").cast("timestamp")) * 1000
    session = X.blank_markers(rows.where("kind = 'phase'"), F.col("kind"), at, F.col("props"), F.lit(None), "web")
    sync = X.blank_markers(rows.where("kind = 'pen_session_sync'"), F.col("kind"), at, F.lit(""), F.lit(None), "web")
    return session.unionByName(sync).select("seq", "t_ns", "event", "src_payload")


@query("""SELECT o_orderkey AS k, CASE o_custkey % 4 WHEN 0 THEN 1000.0::DOUBLE / (o_custkey % 40 + 4) END AS hz FROM orders""")
def listed_rates(spark, sf):
    """Two parallel lists; a missing stream, a blank, an unreadable or a non-positive period give no rate."""
    k = F.col("o_custkey")
    names = F.when(k % 4 == 3, "Accelerometer|Annotation").otherwise("Accelerometer|Wrist Motion|Annotation")
    period = F.when(k % 4 == 0, (k % 40 + 4).cast("string")).when(k % 8 == 1, "").when(k % 4 == 1, "fast").otherwise("-5")
    periods = F.concat_ws("|", F.lit("10"), period, F.lit(""))
    return read(spark, sf, "orders").select(F.col("o_orderkey").alias("k"),
                                            T.listed_rate_hz(names, periods, "Wrist Motion").alias("hz"))


_LINE = "CASE WHEN event_id % 3 = 0 THEN 'note ' || event_id ELSE ' ' || event_id % 50 || ':' || lpad(CAST(event_id % 60 AS VARCHAR), 2, '0') || '  ' || event_type || ' ' END"


@query("""SELECT event_id AS seq, CAST(event_id % 50 * 60 + event_id % 60 AS DOUBLE) AS start_s, event_type AS label FROM events
    WHERE event_id % 3 <> 0""")
def ground_truth(spark, sf):
    """``M:SS label`` lines among others."""
    minutes, seconds = F.col("event_id") % 50, F.lpad((F.col("event_id") % 60).cast("string"), 2, "0")
    line = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("note "), F.col("event_id").cast("string"))).otherwise(
        F.concat(F.lit(" "), minutes.cast("string"), F.lit(":"), seconds, F.lit("  "), "event_type", F.lit(" ")))
    rows = _events(spark, sf).select(F.lit("p").alias("path"), F.col("event_id").alias("seq"), line.alias("line"))
    return X.ground_truth(rows).select("seq", "start_s", "label")


_GERMAN = list(ACTIVITY_NAMES)


def _protocol(spark, sf):
    """A protocol line per event: four in five are blocks, some of them dropped afterwards."""
    k = F.col("event_id")

    def clock(v):
        return F.concat((v % 30).cast("string"), F.lit(":"), F.lpad((v % 60).cast("string"), 2, "0"))
    activity = F.element_at(F.array(*[F.lit(a) for a in _GERMAN]), (k % 6 + 1).cast("int"))
    status = F.when(k % 7 == 0, "| ENTFALLEN (Abbruch)").when(k % 7 == 1, "| ok ").otherwise("")
    block = F.concat(F.lit("  1 |  "), clock(k), F.lit(" | "), clock(k + 2), F.lit(" | 0:02 | "),
                     F.when(k % 2 == 0, "focused").otherwise("distracted"), F.lit("   | "), activity, F.lit("  "), status)
    total = F.concat(F.lit("Gesamtdauer: "), clock(k + F.when(k % 2 == 0, 1).otherwise(9)), F.lit(" min"))
    line = F.when(k % 5 == 0, total).otherwise(block)
    return _events(spark, sf).select(F.floor(k / 5).cast("string").alias("path"), k.alias("seq"), line.alias("line"))


_AT = "CAST({0} % 30 * 60 + {0} % 60 AS DOUBLE)"


@query(f"""SELECT event_id AS seq, {_AT.format('event_id')} AS start_s, {_AT.format('(event_id + 2)')} AS end_s,
    CASE WHEN event_id % 2 = 0 THEN 'focused' ELSE 'distracted' END AS label,
    CASE event_id % 6 {' '.join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(ACTIVITY_NAMES.values()))} END AS activity
    FROM events WHERE event_id % 5 <> 0 AND event_id % 7 <> 0""")
def protocol_blocks(spark, sf):
    return X.protocol_blocks(_protocol(spark, sf)).drop("path")


@query(f"""WITH last AS (SELECT CAST(event_id // 5 AS VARCHAR) AS path, arg_max({_AT.format('(event_id + 2)')}, event_id) AS end_s
    FROM events WHERE event_id % 5 <> 0 AND event_id % 7 <> 0 GROUP BY 1), stated AS (SELECT CAST(event_id // 5 AS VARCHAR) AS path,
    {_AT.format('(event_id + CASE WHEN event_id % 2 = 0 THEN 1 ELSE 9 END)')} AS stated_s FROM events WHERE event_id % 5 = 0)
    SELECT path, stated_s, end_s FROM stated JOIN last USING (path) WHERE abs(stated_s - end_s) > 1.0 AND path <> '7'""")
def stated_totals(spark, sf):
    lines = _protocol(spark, sf)
    return X.stated_total_problems(lines, X.protocol_blocks(lines), stale=("7",))


# --- pairing ------------------------------------------------------------------------------------------

VIEWS["points"] = """SELECT o_custkey AS source, l_orderkey * 8 + l_linenumber AS point_id, l_orderkey AS stroke_id,
    epoch_us(l_shipdate) // 1000 AS date_ms, o_custkey % 3 + CASE WHEN o_orderkey % 9 = 0 THEN 1 ELSE 0 END AS page_id
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
VIEWS["windows"] = """SELECT o_custkey AS source, 'R' || o_custkey || '_' || h AS recording_id,
    min(epoch_us(o_orderdate)) * 1000 + CASE WHEN h = 1 THEN 400 ELSE 0 END AS t_start_ns,
    min(epoch_us(o_orderdate)) * 1000 + (h + 1) * 20000000000000000::BIGINT - 300 AS t_end_ns
    FROM orders, (VALUES (0), (1), (2)) v(h) GROUP BY o_custkey, h"""


def _notebook(spark, sf):
    orders, items = read(spark, sf, "orders"), read(spark, sf, "lineitem")
    strokes = orders.select(F.col("o_custkey").alias("source"), F.col("o_orderkey").alias("stroke_id"),
                            (F.col("o_custkey") % 3 + F.when(F.col("o_orderkey") % 9 == 0, 1).otherwise(0)).alias("page_id"))
    points = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("source"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("point_id"),
        F.col("l_orderkey").alias("stroke_id"),
        F.floor(F.unix_micros(F.col("l_shipdate").cast("timestamp")) / 1000).cast("bigint").alias("date_ms"))
    start = F.min(F.unix_micros(F.col("o_orderdate").cast("timestamp"))) * 1000
    windows = (orders.withColumn("h", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))).groupBy("o_custkey", "h")
               .agg(start.alias("s")))
    windows = windows.select(
        F.col("o_custkey").alias("source"), F.concat(F.lit("R"), F.col("o_custkey").cast("string"), F.lit("_"),
                                                     F.col("h").cast("string")).alias("recording_id"),
        (F.col("s") + F.when(F.col("h") == 1, 400).otherwise(0)).alias("t_start_ns"),
        (F.col("s") + (F.col("h") + 1) * F.lit(20_000_000_000_000_000) - 300).alias("t_end_ns"))
    return points, strokes, windows


_INSIDE = """inside AS (SELECT w.recording_id, p.point_id, p.page_id, p.date_ms FROM windows w JOIN points p ON w.source = p.source
    AND p.date_ms BETWEEN (w.t_start_ns + 999999) // 1000000 AND w.t_end_ns // 1000000)"""


@query(f"WITH {_INSIDE} SELECT * FROM inside", "points", "windows")
def points_in_windows(spark, sf):
    points, strokes, windows = _notebook(spark, sf)
    return X.points_in_windows(points, strokes, windows, ["source"]).select("recording_id", "point_id", "page_id", "date_ms")


@query(f"""WITH {_INSIDE}, pages AS (SELECT recording_id, count(DISTINCT page_id) AS pages FROM inside GROUP BY recording_id)
    SELECT recording_id, coalesce(pages, 0) AS pages FROM windows LEFT JOIN pages USING (recording_id)
    WHERE coalesce(pages, 0) <> 1""", "points", "windows")
def ambiguous_pages(spark, sf):
    points, strokes, windows = _notebook(spark, sf)
    return X.page_problems(X.pages_in_windows(points, strokes, windows, ["source"]), windows)


# --- discovery and lookups ----------------------------------------------------------------------------

@query(r"""SELECT page_id, nullif(regexp_extract(url, '://([^/]+)/', 1), '') AS session_code,
    nullif(regexp_extract(url, '/([a-z]{2})/\d+', 1), '') AS lang FROM pages""")
def discovered_ids(spark, sf):
    """Ids read from paths; a path of another shape gives none."""
    return read(spark, sf, "pages").select("page_id", path_part(F.col("url"), r"://([^/]+)/").alias("session_code"),
                                           path_part(F.col("url"), r"/([a-z]{2})/\d+").alias("lang"))


@query("""SELECT recording_id, substr(sha256(CAST(min(t_ns) // 1000000 AS VARCHAR)), 1, 16) AS start_key FROM motion
    GROUP BY recording_id""", "motion")
def session_keys(spark, sf):
    starts = motion(spark, sf).groupBy("recording_id").agg(F.min("t_ns").alias("t"))
    return starts.select("recording_id", T.session_key(F.col("t")).alias("start_key"))


@query("SELECT CAST(user_id AS VARCHAR) AS recording_id, count(*) AS rows FROM events GROUP BY user_id HAVING count(*) > 1")
def repeated_ids(spark, sf):
    return X.repeated_ids(_events(spark, sf).select(F.col("user_id").cast("string").alias("recording_id")))


@query("""SELECT 'R' || c_custkey AS recording_id, 'code' || c_nationkey AS session_code, n_name AS participant_id FROM customer
    JOIN nation ON c_nationkey = n_nationkey""")
def participants(spark, sf):
    recordings = read(spark, sf, "customer").select(
        F.concat(F.lit("R"), F.col("c_custkey").cast("string")).alias("recording_id"),
        F.concat(F.lit("code"), F.col("c_nationkey").cast("string")).alias("session_code"))
    codes = read(spark, sf, "nation").select(F.concat(F.lit("code"), F.col("n_nationkey").cast("string")).alias("session_code"),
                                             F.col("n_name").alias("participant_id"))
    return X.participants(recordings, codes).select("recording_id", "session_code", "participant_id")


_TASK_IDS = list(TASK_NAMES)
_TASK_OF = "CASE event_id % 12 " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(_TASK_IDS)) + " END"


@query(f"""SELECT event_id AS seq, {_case('t', {k: v[0] for k, v in TASK_NAMES.items()})} AS task_id FROM
    (SELECT event_id, {_TASK_OF} AS t FROM events)""")
def translated_tasks(spark, sf):
    rows = _events(spark, sf).select(F.col("event_id").alias("seq"), F.expr(_TASK_OF).alias("task_id"))
    return X.translate(rows, "task_id", {k: v[0] for k, v in TASK_NAMES.items()}, "task id")


@query("SELECT DISTINCT event_type AS value FROM events WHERE event_type NOT IN ('click', 'view')")
def untranslated_values(spark, sf):
    return X.untranslated(_events(spark, sf), "event_type", {"click": "tap", "view": "look"})


@query(f"""SELECT k, CASE draw {' '.join(f"WHEN {k} THEN '{v}'" for k, v in NOTEBOOK_DRAW_TYPES.items())} END AS dot_type FROM
    (SELECT l_orderkey * 8 + l_linenumber AS k, 16 + l_linenumber AS draw FROM lineitem)""")
def draw_types(spark, sf):
    return read(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("k"),
        T.lookup((F.col("l_linenumber") + 16).cast("int"), NOTEBOOK_DRAW_TYPES).alias("dot_type"))


@query("""WITH first AS (SELECT user_id, min(event_id) AS e FROM events GROUP BY user_id) SELECT 'U' || user_id AS recording_id,
    CASE e % 4 WHEN 0 THEN 'left' WHEN 1 THEN 'right' ELSE 'unknown' END AS handedness, CASE e % 3 WHEN 0 THEN
    'Neo smartpen M1 NWP-F50' WHEN 1 THEN 'LAMY safari all black ncode NWP-F80' ELSE 'unknown' END AS pen_model FROM first""")
def session_facts(spark, sf):
    """Handedness and pen model in the first session start of every recording."""
    k = F.col("event_id")
    hand = F.when(k % 4 == 0, " Left ").when(k % 4 == 1, "RIGHT").when(k % 4 == 2, "unknown")
    name = F.when(k % 3 == 0, "Neosmartpen_M1").when(k % 3 == 1, "LAMY_safari ").otherwise(" ")
    starts = _events(spark, sf).select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("recording_id"), k.alias("seq"),
        F.to_json(F.struct(hand.alias("handedness"), name.alias("pen_name"))).alias("payload"))
    return X.session_facts(starts)


# --- payloads -----------------------------------------------------------------------------------------

def _payload(k, value):
    """JSON text around a number: coordinates at the top, deep down, or nowhere."""
    number = value.cast("string")
    return (F.when(k % 4 == 0, F.concat(F.lit('{"x": '), number, F.lit(', "idx": 1}')))
            .when(k % 4 == 1, F.concat(F.lit('{"tip": {"y":'), number, F.lit(', "force": 2}, "mode": "a"}')))
            .when(k % 4 == 2, F.concat(F.lit('{"color":  "blue", "idx": '), number, F.lit("}"))))


_PAYLOAD = """CASE event_id % 4 WHEN 0 THEN '{"x": ' || v || ', "idx": 1}' WHEN 1 THEN '{"tip": {"y":' || v || ', "force": 2}, "mode": "a"}'
    WHEN 2 THEN '{"color":  "blue", "idx": ' || v || '}' END"""
_PAYLOAD_ROWS = f"(SELECT event_id AS seq, {_PAYLOAD} AS src_payload FROM (SELECT event_id, CAST(value AS VARCHAR) AS v FROM events))"


def _payloads(spark, sf):
    return _events(spark, sf).select(F.col("event_id").alias("seq"), _payload(F.col("event_id"), F.col("value")).alias("src_payload"))


@query("SELECT event_id AS seq, (event_id % 4 < 2)::INT AS held FROM events")
def coordinates_in_payload(spark, sf):
    return _payloads(spark, sf).select("seq", J.holds_coordinates(F.col("src_payload")).cast("int").alias("held"))


@query("""SELECT event_id AS seq, CASE event_id % 4 WHEN 0 THEN '{"idx": 1}' WHEN 1 THEN '{"tip": {"force": 2}, "mode": "a"}'
    WHEN 2 THEN '{"color":  "blue", "idx": ' || value || '}' END AS src_payload FROM events""")
def stripped_payload(spark, sf):
    """Coordinates leave at any depth; text without them stays as it was, spaces included."""
    return _payloads(spark, sf).withColumn("src_payload", J.strip_coordinates(F.col("src_payload")))


@query("""SELECT event_id AS seq, CASE event_id % 3 WHEN 0 THEN '{"idx": 4, "mode": "q"}' WHEN 1 THEN '{}' ELSE '' END AS payload,
    CASE event_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END AS dropped FROM events""")
def allowed_payload(spark, sf):
    k = F.col("event_id")
    text = (F.when(k % 3 == 0, '{"idx": 4, "user_agent": "u", "mode": "q"}').when(k % 3 == 1, '{"screen": [1, 2], "notes": null}')
            .when(k % 2 == 0, " ").otherwise("[1, 2"))
    return _events(spark, sf).select(k.alias("seq"), J.allowed_payload(text).alias("p")).select("seq", "p.payload", "p.dropped")


@query("""SELECT event_id AS seq, CASE WHEN event_id % 2 = 0 THEN '{"time_origin_ms": ' || (epoch_us(ts) // 1000 - 1704000000000) ||
    ', "idx": 3}' ELSE '{"time_origin_ms":  1250, "idx": 3}' END AS src_payload FROM events""")
def rebased_payload(spark, sf):
    """Only values that look like a Unix time move; other text stays untouched."""
    ms = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000).cast("bigint")
    text = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('{"time_origin_ms": '), ms.cast("string"), F.lit(', "idx": 3}'))
                  ).otherwise('{"time_origin_ms":  1250, "idx": 3}')
    origin = F.lit(1_704_000_000_000_000_000)
    return _events(spark, sf).select(F.col("event_id").alias("seq"), J.rebase_payload(text, origin).alias("src_payload"))


@query("SELECT event_id AS seq, (event_id % 3 = 0)::INT AS held FROM events")
def unix_time_in_payload(spark, sf):
    ms = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000).cast("string")
    text = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('{"phase": [{"at": '), ms, F.lit("}]}"))).otherwise(F.col("props"))
    return _events(spark, sf).select(F.col("event_id").alias("seq"), J.payload_holds_unix_time(text).cast("int").alias("held"))


# --- sinks --------------------------------------------------------------------------------------------

def _scratch(spark) -> str:
    """A new folder where all executors can write: below the checkpoint folder, or local for tests."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return f"{shared or tempfile.mkdtemp(prefix='spark-')}/{uuid.uuid4().hex}"


@query("""SELECT id AS recording_id, t_ns, seq, dot_type, x, src_timestamp, id AS stamped_id, '1.0' AS schema_version FROM (
    SELECT *, CASE n % 3 WHEN 0 THEN n::VARCHAR WHEN 1 THEN lpad((n - 1)::VARCHAR, 8, '0') ELSE '2024-01-' || n END AS id
    FROM (SELECT *, substr(recording_id, 2)::INT AS n FROM pen))""", "pen")
def written_table(spark, sf):
    """A table written and scanned again; ids look like numbers, with and without zeros, and like dates."""
    folder, n = _scratch(spark), F.expr("CAST(substring(recording_id, 2) AS INT)")
    ids = (F.when(n % 3 == 0, n.cast("string")).when(n % 3 == 1, F.lpad((n - 1).cast("string"), 8, "0"))
           .otherwise(F.concat(F.lit("2024-01-"), n.cast("string"))))
    sinks.write_table(pen(spark, sf).withColumn("recording_id", ids), f"{folder}/pen")
    return scan_modality(spark, folder, "pen").select(
        "recording_id", "t_ns", "seq", "dot_type", "x", "src_timestamp", "stamped_id", "schema_version")


@query("""SELECT recording_id, seq, t_ns, dot_type, (t_ns >= (SELECT min(t_ns) + (max(t_ns) - min(t_ns)) // 2 FROM pen))::INT AS late
    FROM pen WHERE substr(recording_id, 2)::INT % 5 = 2""", "pen")
def loaded_from_files(spark, sf):
    """Every fifth recording loaded from a written table through its zone map."""
    folder, dots = _scratch(spark), pen(spark, sf)
    sinks.write_table(dots, f"{folder}/pen")
    stored = stored_modality(spark, folder, "pen")
    listed = recordings_of(stored).withColumns({"has_pen": F.lit(True)})
    rows = load_recordings(stored, listed, listed.where("substring(recording_id, 2) % 5 = 2").select("recording_id"), "pen")
    middle = stored.zones().agg(F.expr("min(t_first_ns) + (max(t_last_ns) - min(t_first_ns)) div 2")).first()[0]
    return rows.select("recording_id", "seq", "t_ns", "dot_type", (F.col("t_ns") >= middle).cast("int").alias("late"))


@query("""SELECT recording_id, count(*) AS rows, min(t_start_ns) AS t_first_ns, max(t_end_ns) AS t_last_ns FROM nested
    GROUP BY recording_id""", "nested")
def zones_of_tables(spark, sf):
    """Rows and times of every recording as the zone map of a written table has them."""
    folder = _scratch(spark)
    sinks.write_table(nested(spark, sf), f"{folder}/attention")
    held = stored_modality(spark, folder, "attention").zones().groupBy("recording_id")
    return held.agg(F.sum("rows").alias("rows"), F.min("t_first_ns").alias("t_first_ns"), F.max("t_last_ns").alias("t_last_ns"))


@query()
def checksum_inventory(spark, sf):
    """Digests of the files of a written table."""
    folder = _scratch(spark)
    sinks.write_table(pen(spark, sf), f"{folder}/pen")
    return sinks.checksum_inventory(spark, folder)


@query("""SELECT path, problem FROM (SELECT 'd/' || doc_id AS path, CASE doc_id % 8 WHEN 0 THEN 'listed but missing'
    WHEN 1 THEN 'not listed' WHEN 2 THEN 'content changed' END AS problem FROM documents UNION ALL
    SELECT 'junk ' || doc_id, 'malformed line' FROM documents WHERE doc_id % 8 = 3 UNION ALL
    SELECT 'd/' || doc_id, 'not listed' FROM documents WHERE doc_id % 8 = 3) WHERE problem IS NOT NULL""")
def checksum_problems(spark, sf):
    """A stored list against the contents it should describe."""
    docs, k = read(spark, sf, "documents"), F.col("doc_id")
    path = F.concat(F.lit("d/"), k.cast("string"))
    found = docs.where(k % 8 != 0).select(path.alias("path"), F.sha2("text", 256).alias("sha256"))
    text = F.when(k % 8 == 2, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    line = F.when(k % 8 == 3, F.concat(F.lit("junk "), k.cast("string"))).otherwise(
        F.concat(F.sha2(text, 256), F.lit("  "), path))
    listed = sinks.parse_checksum_list(docs.where(k % 8 != 1).select(line.alias("line")))
    return sinks.checksum_problems(listed, found)


_EXPORTED = ["recording_id", "seq", "t_ns", "dot_type"]


@query("""SELECT recording_id, seq, t_ns, dot_type FROM pen WHERE substr(recording_id, 2)::INT % 2 = 0""", "pen")
def exported_selection(spark, sf):
    """The pen table of a selection by pen model, as the export would write it."""
    dots = pen(spark, sf)
    even = F.expr("substring(recording_id, 2) % 2 = 0")
    listed = dots.select("recording_id").distinct().withColumns({
        "has_pen": F.lit(True), "has_watch": F.lit(False), "has_markers": F.lit(False),
        "pen_model": F.when(even, "Neo smartpen M1 NWP-F50").otherwise("unknown")})
    described = listed.select("recording_id", F.lit("pen").alias("modality"), F.lit("t_ns").alias("column"),
                              F.lit(None).cast("double").alias("sample_rate_hz"))
    chosen, _, _ = sinks.selection_tables({"pen": dots}, listed, described, {"pen_nwp_f50"})
    return chosen["pen"].select(*_EXPORTED)


@query("""SELECT 'pen' AS modality, count(DISTINCT recording_id) AS files,
    sum(length(recording_id || ':' || seq || ':' || dot_type) + 1)::BIGINT AS bytes FROM pen
    WHERE substr(recording_id, 2)::INT % 2 = 0""", "pen")
def export_preview(spark, sf):
    """Files and bytes a selection would take along, from a collection with a text file per recording."""
    folder, dots = _scratch(spark), pen(spark, sf)
    lines = dots.select("recording_id", F.concat_ws(":", "recording_id", F.col("seq").cast("string"), "dot_type").alias("value"))
    sinks.write_recording_texts(lines, f"{folder}/pen")
    selected = dots.where("substring(recording_id, 2) % 2 = 0").select("recording_id").distinct()
    return sinks.export_preview(sinks.recording_files(spark, folder, ["pen"]), selected)


@query("""SELECT 'pen' AS modality, count(DISTINCT recording_id) AS recordings FROM pen
    WHERE substr(recording_id, 2)::INT % 2 = 0""", "pen")
def files_of_tables(spark, sf):
    """Every selected recording is found in the files of a written table."""
    folder, dots = _scratch(spark), pen(spark, sf)
    sinks.write_table(dots, f"{folder}/pen")
    listed = sinks.table_files(spark, folder, ["pen"]).where("substring(recording_id, 2) % 2 = 0 AND length > 0")
    return listed.groupBy("modality").agg(F.count_distinct("recording_id").alias("recordings"))


