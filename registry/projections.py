"""The given tables seen as recordings: every projection in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

HOUR_NS = 3_600_000_000_000
DAY_NS = 24 * HOUR_NS
TOLERANCE_S = 14_400.0
GAP_S = 86_400.0


def query(sql: str | None = None, *views: str):
    """Register a function under its own name, with its SQL over the named projections."""
    def keep(function):
        name = function.__name__
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = with_views(sql, *views)
        return function
    return keep


def with_views(body: str, *views: str) -> str:
    named = [f"{v} AS ({VIEWS[v]})" for v in views]
    # A body may bring further common table expressions, after the word WITH.
    body = body.strip()
    for opening in ("WITH RECURSIVE ", "WITH "):
        if body.upper().startswith(opening):
            return f"{opening}{', '.join([*named, body[len(opening):]])}"
    return f"WITH {', '.join(named)} {body}" if named else body


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def as_int(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("int") for c in columns})


VIEWS = {
    "motion": """SELECT 'U' || user_id AS recording_id, epoch_us(ts) * 1000 AS t_ns, event_id AS seq, value AS v
        FROM events WHERE event_type IN ('view', 'error')""",
    "pen": """SELECT 'U' || user_id AS recording_id, epoch_us(ts) * 1000 AS t_ns, event_id AS seq,
        CASE event_type WHEN 'click' THEN 'PEN_DOWN' WHEN 'purchase' THEN 'PEN_MOVE' ELSE 'PEN_UP' END AS dot_type,
        value AS x, value / 2 AS y, value AS pressure,
        CASE WHEN user_id % 2 = 0 THEN epoch_us(ts) / 1000.0 END AS src_timestamp
        FROM events WHERE event_type IN ('click', 'purchase', 'signup')""",
    "attention": """SELECT recording_id, seq, t_ns AS t_start_ns, t_end_ns,
        CASE WHEN seq % 2 = 0 THEN 'focused' ELSE 'distracted' END AS label FROM (
        SELECT 'U' || user_id AS recording_id, event_id AS seq, epoch_us(ts) * 1000 AS t_ns,
        lead(epoch_us(ts) * 1000) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS t_end_ns
        FROM events WHERE event_type = 'signup') WHERE t_end_ns IS NOT NULL""",
    "nested": f"""SELECT 'U' || user_id AS recording_id, event_id AS seq, epoch_us(ts) * 1000 AS t_start_ns,
        epoch_us(ts) * 1000 + (event_id % 9) * 12 * {HOUR_NS}::BIGINT AS t_end_ns,
        'label' || event_id % 5 AS label FROM events WHERE event_type = 'signup'""",
    "markers": """SELECT 'C' || conv_id AS recording_id, turn AS seq, turn * 1000000000 AS t_ns,
        CASE role WHEN 'user' THEN 'task_start' WHEN 'assistant' THEN 'task_end' ELSE role END AS event,
        CASE conv_id % 3 WHEN 0 THEN 'free_writing' WHEN 1 THEN 'text_copying' ELSE '' END AS task_id,
        CASE WHEN conv_id % 3 <> 2 THEN CAST(turn // 2 AS DOUBLE) END AS task_index,
        CASE WHEN conv_id % 3 = 2 THEN '' WHEN (turn // 2) % 2 = 0 THEN 'writing' ELSE 'idle' END AS task_category
        FROM conversations""",
    "imu": """SELECT 'L' || label % 3 AS recording_id, vec_id * 20000000 AS t_ns, vec_id AS seq,
        embedding[1]::DOUBLE AS accel_total_x, embedding[2]::DOUBLE AS accel_total_y, embedding[3]::DOUBLE AS accel_total_z,
        embedding[4]::DOUBLE AS gyro_x, embedding[5]::DOUBLE AS gyro_y, embedding[6]::DOUBLE AS gyro_z,
        embedding[7]::DOUBLE AS quat_x, embedding[8]::DOUBLE AS quat_y, embedding[9]::DOUBLE AS quat_z,
        embedding[10]::DOUBLE AS quat_w, CASE WHEN label % 3 <> 2 THEN embedding[11]::DOUBLE END AS gravity_x,
        CASE WHEN label % 3 <> 2 THEN embedding[12]::DOUBLE END AS gravity_y,
        CASE WHEN label % 3 <> 2 THEN embedding[13]::DOUBLE END AS gravity_z FROM embeddings""",
    "manifest": """SELECT 'R' || c_custkey AS recording_id, 'P' || c_custkey % 40 AS participant_id,
        c_mktsegment AS cohort, c_custkey % 2 = 0 AS has_watch, FALSE AS has_watch_rawaccel,
        c_custkey % 5 = 0 AS has_headimu, c_custkey % 3 = 0 AS has_pen, c_custkey % 6 = 0 AS has_markers,
        c_custkey % 10 = 0 AS has_attention, c_custkey % 4 = 0 AS has_gravity, c_custkey % 8 = 0 AS has_quaternion,
        c_custkey % 2 = 0 AS has_watch_gyro, c_custkey % 15 = 0 AS has_head_gravity,
        c_custkey % 5 = 0 AS has_head_quaternion, c_custkey % 5 = 0 AS has_head_gyro,
        CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 4 = 0 THEN 'total' ELSE 'user' END AS accel_semantics,
        CASE WHEN c_custkey % 4 = 0 THEN 50.0 ELSE 100.0 END::DOUBLE AS watch_hz_nominal,
        CASE WHEN c_custkey % 2 = 0 THEN (CASE WHEN c_custkey % 4 = 0 THEN 50.0 ELSE 100.0 END)::DOUBLE
            * (1.0::DOUBLE + (c_custkey % 5) / 100.0::DOUBLE) END AS watch_hz_measured,
        CASE WHEN c_custkey % 2 <> 0 THEN '' WHEN c_custkey % 4 = 0 THEN 'Apple Watch Series 6'
            ELSE 'Apple Watch SE (2nd generation)' END AS watch_model,
        CASE WHEN c_custkey % 3 <> 0 THEN '' WHEN c_custkey % 9 = 0 THEN 'Neo smartpen M1 NWP-F50'
            ELSE 'Moleskine Smart Pen NWP-F130' END AS pen_model,
        CASE WHEN c_custkey % 5 = 0 THEN 'AirPods Pro 3' WHEN c_custkey % 101 = 0 THEN 'mystery' ELSE '' END AS head_model,
        CASE c_custkey % 3 WHEN 0 THEN 'shared_clock' WHEN 1 THEN 'estimated_delta' ELSE 'overlap_only' END AS time_alignment,
        abs(c_acctbal) AS duration_s, c_custkey * 7 AS n_samples_watch,
        CASE WHEN c_custkey % 6 = 0 THEN abs(c_acctbal) / 100 END AS pen_hz_measured,
        CASE WHEN c_custkey % 6 = 0 THEN 'src_timestamp' ELSE '' END AS pen_hz_clock,
        CASE WHEN c_custkey % 6 = 0 THEN 'ncode_grid' ELSE 'webapp_raw' END AS pen_xy_unit,
        CASE WHEN c_custkey % 12 = 0 THEN NULL ELSE 'webapp_force' END AS pen_pressure_scale,
        CASE WHEN c_custkey % 11 = 0 THEN '[{"code": "modality_withdrawn", "modality": "headimu"}]' ELSE '' END AS issue_codes,
        CASE WHEN c_custkey % 97 = 0 THEN 'odd' ELSE 'all_xy' END AS redaction_policy,
        CASE WHEN c_custkey % 2 = 0 THEN 'unix_epoch' ELSE 'recording_start' END AS time_origin FROM customer""",
    "channels": """SELECT 'R' || l_orderkey AS recording_id,
        CASE l_returnflag WHEN 'A' THEN 'watch' WHEN 'N' THEN 'pen' ELSE 'headimu' END AS modality,
        CASE l_linenumber % 4 WHEN 0 THEN 't_ns' WHEN 1 THEN 'accel_user_x' WHEN 2 THEN 'x' ELSE 'src_timestamp' END AS "column",
        CASE l_linestatus WHEN 'O' THEN 'time' ELSE 'other' END AS quantity, 'ns' AS unit, 'timestamp' AS semantics,
        '' AS frame, l_quantity AS sample_rate_hz, 1.0::DOUBLE + l_tax AS unit_conversion_factor,
        CASE WHEN l_discount > 0.09 THEN '' ELSE 'clock' || l_suppkey % 3 END AS time_domain FROM lineitem""",
}


def _events(spark, sf, *kinds):
    rows = read(spark, sf, "events")
    return rows.where(F.col("event_type").isin(*kinds)) if kinds else rows


def _when_ns():
    return F.unix_micros(F.col("ts").cast("timestamp")) * F.lit(1000).cast("bigint")


def _user():
    return F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("recording_id")


def motion(spark, sf):
    return _events(spark, sf, "view", "error").select(
        _user(), _when_ns().alias("t_ns"), F.col("event_id").alias("seq"), F.col("value").alias("v"))


def pen(spark, sf):
    dot = (F.when(F.col("event_type") == "click", "PEN_DOWN").when(F.col("event_type") == "purchase", "PEN_MOVE")
           .otherwise("PEN_UP"))
    stamp = F.when(F.col("user_id") % 2 == 0, F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1000.0))
    return _events(spark, sf, "click", "purchase", "signup").select(
        _user(), _when_ns().alias("t_ns"), F.col("event_id").alias("seq"), dot.alias("dot_type"),
        F.col("value").alias("x"), (F.col("value") / 2).alias("y"), F.col("value").alias("pressure"),
        stamp.alias("src_timestamp"))


def attention(spark, sf):
    from motionloom.operators.layout import along, following, ordered
    starts = _events(spark, sf, "signup").select(_user(), F.col("event_id").alias("seq"), _when_ns().alias("t_ns"))
    chained = along(ordered(starts), t_end_ns=following(F.col("t_ns"))).frame
    return chained.where("t_end_ns IS NOT NULL").select(
        "recording_id", "seq", F.col("t_ns").alias("t_start_ns"), "t_end_ns",
        F.when(F.col("seq") % 2 == 0, "focused").otherwise("distracted").alias("label"))


def nested(spark, sf):
    """Signup intervals of up to four days, which overlap freely."""
    return _events(spark, sf, "signup").select(
        _user(), F.col("event_id").alias("seq"), _when_ns().alias("t_start_ns"),
        (_when_ns() + (F.col("event_id") % 9) * F.lit(12 * HOUR_NS)).alias("t_end_ns"),
        F.concat(F.lit("label"), (F.col("event_id") % 5).cast("string")).alias("label"))


def markers(spark, sf):
    pair = F.floor(F.col("turn") / 2)
    return read(spark, sf, "conversations").select(
        F.concat(F.lit("C"), F.col("conv_id").cast("string")).alias("recording_id"), F.col("turn").alias("seq"),
        (F.col("turn") * F.lit(1_000_000_000)).alias("t_ns"),
        F.when(F.col("role") == "user", "task_start").when(F.col("role") == "assistant", "task_end")
        .otherwise(F.col("role")).alias("event"),
        F.when(F.col("conv_id") % 3 == 0, "free_writing").when(F.col("conv_id") % 3 == 1, "text_copying")
        .otherwise("").alias("task_id"),
        F.when(F.col("conv_id") % 3 != 2, pair.cast("double")).alias("task_index"),
        F.when(F.col("conv_id") % 3 == 2, "").when(pair % 2 == 0, "writing").otherwise("idle").alias("task_category"))


def imu(spark, sf):
    def part(i):
        return F.col("embedding")[i].cast("double")
    names = ["accel_total_x", "accel_total_y", "accel_total_z", "gyro_x", "gyro_y", "gyro_z",
             "quat_x", "quat_y", "quat_z", "quat_w"]
    gravity = [F.when(F.col("label") % 3 != 2, part(10 + i)).alias(f"gravity_{a}") for i, a in enumerate("xyz")]
    return read(spark, sf, "embeddings").select(
        F.concat(F.lit("L"), (F.col("label") % 3).cast("string")).alias("recording_id"),
        (F.col("vec_id") * F.lit(20_000_000)).alias("t_ns"), F.col("vec_id").alias("seq"),
        *[part(i).alias(n) for i, n in enumerate(names)], *gravity)


def manifest(spark, sf):
    return read(spark, sf, "customer").selectExpr(*[c.strip() for c in _MANIFEST_SPARK.strip().split(";\n")])


# The SQL text of the manifest view, in Spark's spelling.
_MANIFEST_SPARK = """
'R' || c_custkey AS recording_id;
'P' || c_custkey % 40 AS participant_id;
c_mktsegment AS cohort;
c_custkey % 2 = 0 AS has_watch;
FALSE AS has_watch_rawaccel;
c_custkey % 5 = 0 AS has_headimu;
c_custkey % 3 = 0 AS has_pen;
c_custkey % 6 = 0 AS has_markers;
c_custkey % 10 = 0 AS has_attention;
c_custkey % 4 = 0 AS has_gravity;
c_custkey % 8 = 0 AS has_quaternion;
c_custkey % 2 = 0 AS has_watch_gyro;
c_custkey % 15 = 0 AS has_head_gravity;
c_custkey % 5 = 0 AS has_head_quaternion;
c_custkey % 5 = 0 AS has_head_gyro;
CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 4 = 0 THEN 'total' ELSE 'user' END AS accel_semantics;
CASE WHEN c_custkey % 4 = 0 THEN 50.0D ELSE 100.0D END AS watch_hz_nominal;
CASE WHEN c_custkey % 2 = 0 THEN CASE WHEN c_custkey % 4 = 0 THEN 50.0D ELSE 100.0D END * (1.0D + (c_custkey % 5) / 100.0D) END AS watch_hz_measured;
CASE WHEN c_custkey % 2 <> 0 THEN '' WHEN c_custkey % 4 = 0 THEN 'Apple Watch Series 6' ELSE 'Apple Watch SE (2nd generation)' END AS watch_model;
CASE WHEN c_custkey % 3 <> 0 THEN '' WHEN c_custkey % 9 = 0 THEN 'Neo smartpen M1 NWP-F50' ELSE 'Moleskine Smart Pen NWP-F130' END AS pen_model;
CASE WHEN c_custkey % 5 = 0 THEN 'AirPods Pro 3' WHEN c_custkey % 101 = 0 THEN 'mystery' ELSE '' END AS head_model;
CASE c_custkey % 3 WHEN 0 THEN 'shared_clock' WHEN 1 THEN 'estimated_delta' ELSE 'overlap_only' END AS time_alignment;
abs(c_acctbal) AS duration_s;
c_custkey * 7 AS n_samples_watch;
CASE WHEN c_custkey % 6 = 0 THEN abs(c_acctbal) / 100 END AS pen_hz_measured;
CASE WHEN c_custkey % 6 = 0 THEN 'src_timestamp' ELSE '' END AS pen_hz_clock;
CASE WHEN c_custkey % 6 = 0 THEN 'ncode_grid' ELSE 'webapp_raw' END AS pen_xy_unit;
CASE WHEN c_custkey % 12 = 0 THEN NULL ELSE 'webapp_force' END AS pen_pressure_scale;
CASE WHEN c_custkey % 11 = 0 THEN '[{"code": "modality_withdrawn", "modality": "headimu"}]' ELSE '' END AS issue_codes;
CASE WHEN c_custkey % 97 = 0 THEN 'odd' ELSE 'all_xy' END AS redaction_policy;
CASE WHEN c_custkey % 2 = 0 THEN 'unix_epoch' ELSE 'recording_start' END AS time_origin
"""


def channels(spark, sf):
    return read(spark, sf, "lineitem").selectExpr(
        "'R' || l_orderkey AS recording_id",
        "CASE l_returnflag WHEN 'A' THEN 'watch' WHEN 'N' THEN 'pen' ELSE 'headimu' END AS modality",
        "CASE l_linenumber % 4 WHEN 0 THEN 't_ns' WHEN 1 THEN 'accel_user_x' WHEN 2 THEN 'x' ELSE 'src_timestamp' END AS `column`",
        "CASE l_linestatus WHEN 'O' THEN 'time' ELSE 'other' END AS quantity", "'ns' AS unit",
        "'timestamp' AS semantics", "'' AS frame", "l_quantity AS sample_rate_hz",
        "1.0D + l_tax AS unit_conversion_factor",
        "CASE WHEN l_discount > 0.09D THEN '' ELSE 'clock' || l_suppkey % 3 END AS time_domain")
