"""Clocks, vectors, rates, stillness, gravity and resampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from motionloom.functions import clock as C
from motionloom.functions import vectors as V
from motionloom.operators import motion as M
from motionloom.operators import privacy
from motionloom.operators import resample as R
from motionloom.operators.layout import numbered, ordered

from .projections import DAY_NS, as_int, attention, imu, motion, pen, query, read, rounded

GRAVITY_SQL = """gravity AS (SELECT *, CASE WHEN size > 0 THEN -(2 / size) * (quat_x * quat_z - quat_w * quat_y) END AS gx,
        CASE WHEN size > 0 THEN -(2 / size) * (quat_y * quat_z + quat_w * quat_x) END AS gy,
        CASE WHEN size > 0 THEN (2 / size) * (quat_x * quat_x + quat_y * quat_y) - 1 END AS gz FROM (
        SELECT *, quat_x * quat_x + quat_y * quat_y + quat_z * quat_z + quat_w * quat_w AS size FROM imu))"""


@query("""SELECT event_id AS seq, CAST(floor(value) AS BIGINT) * 1000000000 +
    CAST(round_even((value - floor(value)) * 1e9, 0) AS BIGINT) AS from_s, event_id * 1000000 AS from_ms,
    CAST(floor(value * 1000) AS BIGINT) * 1000 + CAST(round_even((value * 1000 - floor(value * 1000)) * 1000, 0)
    AS BIGINT) AS from_us FROM events""")
def unix_ns(spark, sf):
    value = F.col("value")
    return read(spark, sf, "events").select(
        F.col("event_id").alias("seq"), C.to_unix_ns(value, "s", whole=False).alias("from_s"),
        C.to_unix_ns(F.col("event_id"), "ms", whole=True).alias("from_ms"),
        C.to_unix_ns(value * 1000, "us", whole=False).alias("from_us"))


@query("SELECT event_id AS seq, epoch_us(ts) * 1000 AS t_ns FROM events")
def iso_ns(spark, sf):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    return read(spark, sf, "events").select(F.col("event_id").alias("seq"), C.iso_to_unix_ns(text).alias("t_ns"))


@query(f"""SELECT recording_id, seq, row_number() OVER (PARTITION BY recording_id ORDER BY t_ns // {DAY_NS}, seq) - 1
    AS position FROM motion""", "motion")
def stable_time_order(spark, sf):
    rows = motion(spark, sf).withColumn("t_ns", C.floor_div(F.col("t_ns"), DAY_NS))
    return numbered(ordered(rows), "position").frame.select("recording_id", "seq", "position")


@query("""SELECT recording_id, round(1e9 / quantile_cont(d, 0.5), 9) AS rate_hz FROM (SELECT recording_id,
    t_ns - lag(t_ns) OVER (PARTITION BY recording_id ORDER BY t_ns, seq) AS d FROM motion) WHERE d > 0
    GROUP BY recording_id""", "motion")
def median_rate(spark, sf):
    return rounded(M.median_rate_hz(motion(spark, sf)), "rate_hz", digits=9)


@query("""SELECT recording_id, count(*) FILTER (b) AS backward_steps FROM (SELECT recording_id, coalesce(t_ns < lag(t_ns)
    OVER (PARTITION BY recording_id ORDER BY seq), FALSE) AS b FROM (SELECT 'U' || user_id AS recording_id,
    event_id AS seq, CAST(floor(value * 1000) AS BIGINT) AS t_ns FROM events)) GROUP BY recording_id""")
def backward_steps(spark, sf):
    rows = read(spark, sf, "events").select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("recording_id"), F.col("event_id").alias("seq"),
        F.floor(F.col("value") * 1000).cast("bigint").alias("t_ns"))
    return M.backward_steps(rows)


SPAN_SQL = """SELECT recording_id, min(s) AS t_start_ns, max(e) AS t_end_ns FROM (
    SELECT recording_id, t_ns AS s, t_ns AS e FROM motion UNION ALL SELECT recording_id, t_ns, t_ns FROM pen
    UNION ALL SELECT recording_id, t_start_ns, t_end_ns FROM attention) GROUP BY recording_id"""


def _tables(spark, sf):
    return {"watch": motion(spark, sf), "pen": pen(spark, sf), "attention": attention(spark, sf)}


@query(SPAN_SQL, "motion", "pen", "attention")
def recording_span(spark, sf):
    return privacy.recording_span(_tables(spark, sf))


@query(f"""WITH span AS ({SPAN_SQL}) SELECT p.recording_id, p.seq, p.t_ns - s.t_start_ns AS t_ns,
    round(p.src_timestamp - s.t_start_ns / 1e6, 3) AS src_timestamp,
    p.t_ns // 1000000 - s.t_start_ns // 1000000 AS src_local_ts_ms
    FROM pen p JOIN span s USING (recording_id)""", "motion", "pen", "attention")
def rebased_clocks(spark, sf):
    tables = _tables(spark, sf)
    tables["pen"] = tables["pen"].withColumn("src_local_ts_ms", C.floor_div(F.col("t_ns"), 1_000_000))
    rows = privacy.rebase(tables, "recording_start")["pen"]
    return rounded(rows, "src_timestamp", digits=3).select(
        "recording_id", "seq", "t_ns", "src_timestamp", "src_local_ts_ms")


_LEAK_SQL = """SELECT recording_id, c AS "column" FROM (
    SELECT recording_id, 't_ns' AS c, bool_or(t_ns >= 1000000000000000000 AND t_ns < 2000000000000000000) AS hit FROM rows GROUP BY 1
    UNION ALL SELECT recording_id, 'stamp_ms', bool_or((stamp_ms >= 1e12 AND stamp_ms < 2e12)
        OR (stamp_ms >= 1e15 AND stamp_ms < 2e15)) FROM rows GROUP BY 1
    UNION ALL SELECT recording_id, 'uptime_ms', bool_or((uptime_ms >= 1e12 AND uptime_ms < 2e12)) FROM rows GROUP BY 1
    UNION ALL SELECT recording_id, 'v', bool_or(v >= 1e12) FROM rows GROUP BY 1) WHERE hit"""


@query(f"""WITH rows AS (SELECT 'U' || user_id AS recording_id, epoch_us(ts) * (CASE WHEN user_id % 3 = 0 THEN 1000 ELSE 1 END) AS t_ns,
    CASE WHEN user_id % 2 = 0 THEN epoch_us(ts) / 1000.0::DOUBLE ELSE value END AS stamp_ms, event_id * 1000000 AS uptime_ms,
    value AS v FROM events) {_LEAK_SQL}""")
def leaked_clocks(spark, sf):
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    rows = read(spark, sf, "events").select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("recording_id"), F.col("event_id").alias("seq"),
        (us * F.when(F.col("user_id") % 3 == 0, 1000).otherwise(1)).alias("t_ns"),
        F.when(F.col("user_id") % 2 == 0, us / F.lit(1000.0)).otherwise(F.col("value")).alias("stamp_ms"),
        (F.col("event_id") * 1_000_000).alias("uptime_ms"), F.col("value").alias("v"))
    return privacy.epoch_columns(rows)


# --- vectors ------------------------------------------------------------------------------------------

_NORMS = """norms AS (SELECT recording_id, 'accel_total' AS quantity, sqrt(accel_total_x * accel_total_x +
        accel_total_y * accel_total_y + accel_total_z * accel_total_z) AS n FROM imu
    UNION ALL SELECT recording_id, 'gyro', sqrt(gyro_x * gyro_x + gyro_y * gyro_y + gyro_z * gyro_z) FROM imu
    UNION ALL SELECT recording_id, 'gravity', sqrt(gravity_x * gravity_x + gravity_y * gravity_y + gravity_z * gravity_z) FROM imu)"""


@query(f"""WITH {_NORMS} SELECT recording_id, quantity, round(quantile_cont(n, 0.5), 6) AS median,
    round(quantile_cont(n, 0.05), 6) AS p05, round(quantile_cont(n, 0.95), 6) AS p95,
    round(quantile_cont(n, 0.75) - quantile_cont(n, 0.25), 6) AS iqr, round(avg(n), 6) AS mean,
    round(stddev_pop(n), 6) AS std, count(n) AS n FROM norms GROUP BY recording_id, quantity""", "imu")
def norm_stats(spark, sf):
    stats = M.norm_stats(imu(spark, sf), ["accel_total", "gyro", "gravity"])
    return rounded(stats, "median", "p05", "p95", "iqr", "mean", "std")


@query(f"""WITH {GRAVITY_SQL} SELECT seq, round(gx, 6) AS gx, round(gy, 6) AS gy, round(gz, 6) AS gz FROM gravity""", "imu")
def gravity_from_quaternion(spark, sf):
    parts = V.gravity_from_quaternion(V.columns_of("quat"))
    return rounded(imu(spark, sf).select("seq", *[p.alias(n) for p, n in zip(parts, ("gx", "gy", "gz"))]),
                   "gx", "gy", "gz")


@query("""SELECT seq, round(degrees(acos(greatest(-1, least(1, (accel_total_x * gyro_x + accel_total_y * gyro_y
    + accel_total_z * gyro_z) / (sqrt(accel_total_x * accel_total_x + accel_total_y * accel_total_y + accel_total_z *
    accel_total_z) * sqrt(gyro_x * gyro_x + gyro_y * gyro_y + gyro_z * gyro_z)))))), 6) AS angle FROM imu""", "imu")
def vector_angle(spark, sf):
    angle = V.angle_deg(V.columns_of("accel_total"), V.columns_of("gyro"))
    return rounded(imu(spark, sf).select("seq", angle.alias("angle")), "angle")


STILL_SQL = """still AS (SELECT *, coalesce(max(sqrt(gyro_x * gyro_x + gyro_y * gyro_y + gyro_z * gyro_z)) OVER (
        PARTITION BY recording_id ORDER BY t_ns, seq ROWS BETWEEN {back} PRECEDING AND {ahead} FOLLOWING) < {limit}, FALSE)
        AS still FROM imu)"""


@query("WITH " + STILL_SQL.format(back=3, ahead=2, limit=0.25) + " SELECT seq, CAST(still AS INT) AS still FROM still", "imu")
def still_samples(spark, sf):
    """A window of six samples: three before and two after."""
    rows = M.still(imu(spark, sf), 3.0, window_s=2.0, threshold=0.25)
    return as_int(rows, "still").select("seq", "still")


@query("WITH " + STILL_SQL.format(back=0, ahead=0, limit=0.2) + """, stats AS (SELECT recording_id, count(*) FILTER (still) AS n,
    avg(CASE WHEN still THEN sqrt(accel_total_x * accel_total_x + accel_total_y * accel_total_y
    + accel_total_z * accel_total_z) END) AS m FROM still GROUP BY recording_id)
    SELECT recording_id, CASE WHEN n >= 20 THEN round(m - 1, 6) END AS bias FROM stats""", "imu")
def still_acceleration(spark, sf):
    """Mean norm over still samples minus 1 g, with a window of one sample."""
    rows = M.still(imu(spark, sf), 1.0, window_s=1.0, threshold=0.2)
    size = V.norm(V.columns_of("accel_total"))
    stats = rows.groupBy("recording_id").agg(F.count_if("still").alias("n"), F.avg(F.when(F.col("still"), size)).alias("m"))
    return rounded(stats.select("recording_id", F.when(F.col("n") >= 20, F.col("m") - 1).alias("bias")), "bias")


@query("WITH loud AS (SELECT * REPLACE (gyro_x / 100 AS gyro_x, gyro_y / 100 AS gyro_y, gyro_z / 100 AS gyro_z) FROM imu),"
       + STILL_SQL.format(back=50, ahead=49, limit=0.05).replace("FROM imu", "FROM loud") + """,
    stats AS (SELECT recording_id, count(*) FILTER (still) AS n, avg(CASE WHEN still THEN sqrt(accel_total_x * accel_total_x
    + accel_total_y * accel_total_y + accel_total_z * accel_total_z) END) AS m FROM still GROUP BY recording_id)
    SELECT recording_id, CASE WHEN n >= 100 THEN round_even(m - 1, 6) END AS accel_still_bias FROM stats""", "imu")
def still_bias(spark, sf):
    calm = imu(spark, sf).withColumns({c: F.col(c) / 100 for c in ("gyro_x", "gyro_y", "gyro_z")})
    return M.still_bias(calm, 50.0)


@query("""WITH unit AS (SELECT recording_id, CASE WHEN recording_id = 'L0' THEN 1.0::DOUBLE ELSE sqrt(gyro_x * gyro_x
    + gyro_y * gyro_y + gyro_z * gyro_z) END AS n FROM imu)
    SELECT recording_id, round(quantile_cont(n, 0.5), 6) AS median FROM unit GROUP BY recording_id
    HAVING quantile_cont(n, 0.5) BETWEEN 0.99 AND 1.01 AND quantile_cont(n, 0.75) - quantile_cont(n, 0.25) < 0.01""", "imu")
def gravity_lookalikes(spark, sf):
    """Angular rates of one recording replaced by unit vectors: only that one must be refused."""
    size = V.norm(V.columns_of("gyro"))
    scale = F.when(F.col("recording_id") == "L0", 1 / size).otherwise(F.lit(1.0))
    rows = imu(spark, sf).select("recording_id", *[(F.col(c) * scale).alias(c) for c in ("gyro_x", "gyro_y", "gyro_z")])
    return rounded(M.gravity_lookalikes(M.norm_stats(rows, ["gyro"])).select("recording_id", "median"), "median")


@query("""WITH scaled AS (SELECT recording_id, seq, gravity_x * k AS x, gravity_y * k AS y, gravity_z * k AS z FROM (
    SELECT *, CASE WHEN recording_id = 'L0' THEN 50.0::DOUBLE ELSE 1.0::DOUBLE END AS k FROM imu)),
    factor AS (SELECT recording_id, quantile_cont(sqrt(x * x + y * y + z * z), 0.5) > 2 AS si FROM scaled GROUP BY recording_id)
    SELECT seq, round(CASE WHEN si THEN x / 9.80665 ELSE x END, 6) AS gravity_x,
    round(CASE WHEN si THEN 1 / 9.80665 ELSE 1 END, 6) AS gravity_factor
    FROM scaled JOIN factor USING (recording_id) WHERE x IS NOT NULL""", "imu")
def harmonised_gravity(spark, sf):
    k = F.when(F.col("recording_id") == "L0", 50.0).otherwise(1.0)
    rows = imu(spark, sf).where("gravity_x IS NOT NULL").withColumns(
        {c: F.col(c) * k for c in ("gravity_x", "gravity_y", "gravity_z")})
    return rounded(M.harmonise_gravity(rows).select("seq", "gravity_x", "gravity_factor"), "gravity_x", "gravity_factor")


@query("""SELECT seq, round(CASE WHEN recording_id = 'L1' THEN accel_total_x / 9.80665 ELSE accel_total_x END, 6)
    AS accel_total_x FROM imu""", "imu")
def scaled_acceleration(spark, sf):
    rows = imu(spark, sf)
    flag = F.when(F.col("recording_id") == "L1", " True ").otherwise("false")
    flags = rows.select("recording_id").distinct().withColumn("standardisation", flag)
    return rounded(M.scale_acceleration(rows, flags, "accel_total").select("seq", "accel_total_x"), "accel_total_x")


@query(f"""WITH {GRAVITY_SQL} SELECT seq, round(accel_total_x - gx, 6) AS accel_user_x,
    round(accel_total_y - gy, 6) AS accel_user_y, round(accel_total_z - gz, 6) AS accel_user_z FROM gravity""", "imu")
def user_acceleration(spark, sf):
    names = ("accel_user_x", "accel_user_y", "accel_user_z")
    return rounded(M.to_user_acceleration(imu(spark, sf)).select("seq", *names), *names)


@query("""SELECT l_orderkey AS k, l_linenumber AS n, l_suppkey AS s, l_partkey AS p,
    CASE WHEN f >= 1 AND abs(r - f) <= 0.05 * f THEN CAST(f AS INT) END AS factor
    FROM (SELECT *, round_even(l_quantity / 7, 0) AS f, l_quantity / 7 AS r FROM lineitem)""")
def decimation_factors(spark, sf):
    rates = read(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), F.col("l_suppkey").alias("s"),
        F.col("l_partkey").alias("p"), F.col("l_quantity").alias("rate_hz"))
    return R.decimation_factors(rates, 7.0).drop("rate_hz")


def _factors(rows):
    return rows.select("recording_id").distinct().withColumn(
        "factor", (F.expr("CAST(substring(recording_id, 2) AS INT)") % 4 + 1).cast("int"))


@query("""SELECT recording_id, seq FROM (SELECT recording_id, seq, row_number() OVER (PARTITION BY recording_id
    ORDER BY t_ns, seq) - 1 AS rn FROM motion) WHERE rn % (CAST(substr(recording_id, 2) AS INT) % 4 + 1) = 0""", "motion")
def picked_times(spark, sf):
    rows = motion(spark, sf)
    return R.picked_times(rows, _factors(rows)).select("recording_id", "seq")


@query("""SELECT recording_id, seq, CAST(round(quat_x, 6) AS DOUBLE) AS quat_x FROM (SELECT *, row_number() OVER (
    PARTITION BY recording_id ORDER BY t_ns, seq) - 1 AS rn FROM imu)
    WHERE rn % (CAST(substr(recording_id, 2) AS INT) % 4 + 1) = 0""", "imu")
def downsampled_rows(spark, sf):
    """Filtered and thinned motion: the rows kept and the orientation they keep."""
    rows = imu(spark, sf)
    return rounded(R.downsample(rows, _factors(rows)).select("recording_id", "seq", "quat_x"), "quat_x")


def _filter_sql() -> str:
    """The filter sample by sample: sections of second order one after another, over mirrored ends, forwards and then backwards."""
    kinds = ("accel_total_x", "gyro_x", "gravity_x")
    coefficients = []
    for recording, factor in (("L1", 2), ("L2", 3)):
        poles, gain = R.poles_and_gain(factor)
        pairs = [(2 * p.real, abs(p) ** 2) for p in poles[poles.imag > 0]]
        coefficients.append(f"('{recording}', {factor}, {float(gain)!r}::DOUBLE, {', '.join(f'{float(b)!r}::DOUBLE, {float(c)!r}::DOUBLE' for b, c in pairs)})")
    n = R.ORDER // 2

    def step(x: str, state: list[tuple[str, str]]) -> str:
        """Output and new states; the zeros at -1 make a section's output its input plus its first state."""
        inputs = ["(" + " + ".join([f"gain * {x}", *(z for z, _ in state[:k])]) + ")" for k in range(n + 1)]
        moved = [f"2 * {inputs[k]} + b{k} * {inputs[k + 1]} + {state[k][1]} AS u{k}, {inputs[k]} - c{k} * {inputs[k + 1]} AS w{k}" for k in range(n)]
        return f"{inputs[n]} AS y, " + ", ".join(moved)

    def settled(x: str) -> list[tuple[str, str]]:
        """The states after a constant, section by section."""
        out, level = [], f"(gain * {x})"
        for k in range(n):
            next_level = f"({level} * 4 / (1 - b{k} + c{k}))"
            out.append((f"({next_level} - {level})", f"({level} - c{k} * {next_level})"))
            level = next_level
        return out

    def passed(name: str, source: str, at: str) -> str:
        known = [(f"u{k}", f"w{k}") for k in range(n)]
        return f"""{name} AS (SELECT s.recording_id, s.kind, 0::BIGINT AS p, {step('s.v', settled('s.v'))} FROM {source} s JOIN filters USING (recording_id) WHERE {at} = 0
            UNION ALL SELECT s.recording_id, s.kind, {at}, {step('s.v', known)} FROM {name} f JOIN {source} s ON s.recording_id = f.recording_id AND s.kind = f.kind
            AND {at} = f.p + 1 JOIN filters ON filters.recording_id = s.recording_id)"""
    edge = R.EDGE
    values = " UNION ALL ".join(f"SELECT recording_id, '{k}' AS kind, seq, i, total, {k} AS v FROM placed WHERE {k} IS NOT NULL" for k in kinds)
    return f"""WITH RECURSIVE filters(recording_id, factor, gain, {', '.join(f'b{k}, c{k}' for k in range(n))}) AS (VALUES {', '.join(coefficients)}),
    placed AS (SELECT *, row_number() OVER (PARTITION BY recording_id ORDER BY t_ns, seq) - 1 AS i, count(*) OVER (PARTITION BY recording_id) AS total FROM imu),
    long AS (SELECT * FROM ({values}) JOIN (SELECT recording_id FROM filters) USING (recording_id)),
    ends AS (SELECT recording_id, kind, max(v) FILTER (i = 0) AS first, max(v) FILTER (i = total - 1) AS last FROM long GROUP BY ALL),
    wide AS (SELECT recording_id, kind, i + {edge} AS p, total + {2 * edge} AS n, v FROM long
        UNION ALL SELECT recording_id, kind, {edge} - i, total + {2 * edge}, 2 * first - v FROM long JOIN ends USING (recording_id, kind) WHERE i BETWEEN 1 AND {edge}
        UNION ALL SELECT recording_id, kind, {edge} + 2 * total - 2 - i, total + {2 * edge}, 2 * last - v FROM long JOIN ends USING (recording_id, kind)
            WHERE i BETWEEN total - 1 - {edge} AND total - 2),
    {passed('ahead', 'wide', 's.p')},
    turned AS (SELECT recording_id, kind, n - 1 - a.p AS p, y AS v FROM ahead a JOIN (SELECT DISTINCT recording_id, kind, n FROM wide) USING (recording_id, kind)),
    {passed('back', 'turned', 's.p')},
    done AS (SELECT l.recording_id, l.seq, l.kind, y FROM long l JOIN filters f USING (recording_id) JOIN back b ON b.recording_id = l.recording_id AND b.kind = l.kind
        AND b.p = l.total + {edge} - 1 - l.i WHERE l.i % f.factor = 0)
    SELECT recording_id, seq, {', '.join(f"round(max(y) FILTER (kind = '{k}'), 6) AS {k}" for k in kinds)} FROM done GROUP BY recording_id, seq
    UNION ALL SELECT recording_id, seq, {', '.join(f'round({k}, 6)' for k in kinds)} FROM imu WHERE recording_id NOT IN (SELECT recording_id FROM filters)"""


@query(_filter_sql(), "imu")
def downsampled_channels(spark, sf):
    """Filtered values themselves, against the recursion sample by sample."""
    rows, kinds = imu(spark, sf), ("accel_total_x", "gyro_x", "gravity_x")
    return rounded(R.downsample(rows, _factors(rows)).select("recording_id", "seq", *kinds), *kinds)
