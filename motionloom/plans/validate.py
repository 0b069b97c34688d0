"""Physical and structural checks over all recordings at once, as one table of findings.

Finding columns: check, recording_id, modality, column, observed (text), observed_num, expected,
passed.  A finding on a whole archive carries ``-`` where a recording would stand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import all_finite, angle_to_down, columns_of, norm_of, with_attitude_gravity
from ..operators.layout import attach, durable, union_all
from ..operators.motion import backward_steps, median_rate_hz, still, time_steps, with_presence_columns
from ..operators.privacy import (epoch_columns, redaction_policy_problems, redaction_violations,
                                 time_origin_problems)
from ..operators.quantile import cell_counts, quantiles
from ..vocabulary import (ACCEL_BANDS, ACCEL_MIX_BAND, ACCEL_SEMANTICS, ACCEL_SI_BAND,
                          ATTENTION_LABELS, CAPABILITY_FLAGS, CHANNEL_COLUMNS,
                          DERIVED_MANIFEST_COLUMNS, DOT_TYPES, GRAVITY_NORM_BAND,
                          GRAVITY_NORM_MAX_IQR, GYRO_MEDIAN_BAND, GYRO_P95_MAX, MANIFEST_COLUMNS,
                          MIN_PHYSICS_ROWS, MODALITY_FLAGS, MOTION_MODALITIES,
                          QUAT_GRAVITY_ANGLE_MAX_DEG, QUAT_NORM_BAND, QUAT_STILL_ANGLE_MAX_DEG,
                          RATE_TOLERANCE, SCHEMA_VERSION, SPILL_GUARD_S, TIME_ALIGNMENTS, VECTORS)
from .census import census
from .manifest import (channel_rows, derived_values, dropouts, oversized, refuse, rounded_rates, spans,
                       stored_columns, table_rates)

STREAM = ["recording_id", "modality"]
FINDING = ("check", "recording_id", "modality", "column", "observed", "observed_num", "expected", "passed")
EPOCH_NS = (10**18, 2 * 10**18)


def finding(rows: DataFrame, check: str, *, column: Column | str, observed: Column, expected: Column | str,
            passed: Column, modality: Column | str | None = None, number: Column | None = None) -> DataFrame:
    """Findings of one check from its rows; an undecidable comparison counts as failed."""
    def text(value):
        return value if isinstance(value, Column) else F.lit(value)
    return rows.select(
        F.lit(check).alias("check"), "recording_id",
        (F.col("modality") if modality is None else text(modality)).alias("modality"),
        text(column).alias("column"), observed.cast("string").alias("observed"),
        (F.lit(None) if number is None else number).cast("double").alias("observed_num"),
        text(expected).alias("expected"), F.coalesce(passed, F.lit(False)).alias("passed"))


def measured(rows: DataFrame, check: str, *, column: Column | str, value: Column, digits: int,
             expected: Column | str, passed: Column) -> DataFrame:
    shown = F.bround(value, digits)
    return finding(rows, check, column=column, observed=shown, number=shown, expected=expected, passed=passed)


def all_motion(tables: dict[str, DataFrame]) -> DataFrame:
    """The three motion streams as one table with every vector column."""
    parts = []
    for name in MOTION_MODALITIES:
        if name in tables:
            table = tables[name]
            for quantity in VECTORS:
                table = with_presence_columns(table, quantity)
            parts.append(table.select("recording_id", F.lit(name).alias("modality"), "t_ns", "seq",
                                      *[c for cols in VECTORS.values() for c in cols]))
    return union_all(parts)


# --- motion streams -------------------------------------------------------------------------------

def time_monotonic(motion: DataFrame, split: bool | None = None, steps: DataFrame | None = None) -> DataFrame:
    """``steps``: those of :func:`motionloom.operators.motion.time_steps` where they are there already."""
    counted = (backward_steps(motion, tuple(STREAM), split) if steps is None
               else steps.groupBy(*STREAM).agg(F.count_if("backward").alias("backward_steps")))
    n = F.col("backward_steps")
    return finding(counted, "time_monotonic", column="t_ns", observed=n, number=n, expected="no backward steps", passed=n == 0)


def sample_rate(motion: DataFrame, nominal: DataFrame, rates: DataFrame | None = None,
                span: DataFrame | None = None, split: bool | None = None) -> DataFrame:
    """Measured against declared rate; a stream without a declared rate passes as measured only.

    ``nominal``: recording_id, watch_hz_nominal, head_hz_nominal.
    """
    rate = (rates.withColumnRenamed("sample_rate_hz", "rate") if rates is not None
            else median_rate_hz(motion, "rate", tuple(STREAM), split))
    streams = (motion.select(*STREAM).distinct() if span is None
               else span.where(F.col("modality").isin(*MOTION_MODALITIES)).select(*STREAM))
    rows = streams.join(rate, STREAM, "left").join(nominal, "recording_id", "left")
    declared = F.when(F.col("modality") == "headimu", F.col("head_hz_nominal")).otherwise(
        F.col("watch_hz_nominal"))
    off = F.abs(F.col("rate") - declared) / declared
    return measured(rows, "sample_rate", column="t_ns", value=F.col("rate"), digits=3,
                    expected=F.coalesce(F.concat(declared.cast("string"), F.lit(" Hz +-20%")),
                                        F.lit("no nominal rate declared; measured only")),
                    passed=F.when(declared.isNull(), True).otherwise(off < RATE_TOLERANCE))


PHYSICAL_MEASURES = tuple(f"norm_{q}" for q in VECTORS) + ("flat_gz", "quat_gravity_angle")


def with_physical_measures(motion: DataFrame) -> DataFrame:
    """A column for each of PHYSICAL_MEASURES: the vector norms, the vertical gravity component lying flat, and the angle between
    stored and reconstructed gravity."""
    x, y, z = VECTORS["gravity"]
    rows = motion.withColumns({f"norm_{q}": norm_of(q) for q in VECTORS} | {"flat_gz": F.expr(f"CASE WHEN greatest(abs({x}), abs({y})) < 0.1D THEN {z} END")})
    angle = F.when(F.expr("norm_gravity IS NOT NULL AND norm_quat IS NOT NULL"), angle_to_down("gravity"))
    return with_attitude_gravity(rows).withColumn("quat_gravity_angle", angle)


def _long(motion: DataFrame) -> DataFrame:
    entries = ", ".join(f"named_struct('measure', '{m}', 'value', {m})" for m in PHYSICAL_MEASURES)
    return with_physical_measures(motion).selectExpr(*STREAM, f"inline(array({entries}))").where("value IS NOT NULL")


def physics(motion: DataFrame, split: bool | None = None, cells: DataFrame | None = None) -> DataFrame:
    """Quantiles of every measure the physical checks need: (stream, measure, n, median, ...).

    Besides PHYSICAL_MEASURES: the angle between acceleration and reconstructed gravity while still, for streams without a
    gravity vector.  Measures of the attitude need enough quaternions in a stream.  How many vectors a stream has of each kind
    follows from the ``cells`` that quantiles start from (counted here unless given), so no pass looks for that alone.
    """
    by = [*STREAM, "measure"]
    cells = durable(cell_counts(_long(motion), by, "value")) if cells is None else cells

    def rows_of(measure):
        return F.sum(F.when(F.col("measure") == measure, F.col("_n")).otherwise(0))
    quats = rows_of("norm_quat").over(Window.partitionBy(*STREAM))
    judged = cells.withColumn("_quats", quats).where(~F.col("measure").isin("norm_quat", "quat_gravity_angle") | (F.col("_quats") >= MIN_PHYSICS_ROWS)).drop("_quats")
    stats = [_measure_stats(_long(motion), judged)]

    without = durable(cells.groupBy(*STREAM).agg(*[rows_of(f"norm_{q}").alias(f"_{q}") for q in ("quat", "gravity", "accel_total", "gyro")]).where(
        (F.col("_quat") >= MIN_PHYSICS_ROWS) & (F.col("_gravity") == 0) & (F.col("_accel_total") > 0) & (F.col("_gyro") > 0)).select(*STREAM))
    if not without.isEmpty():
        fallback = attach(motion, without, STREAM, "inner").where(all_finite(columns_of("quat"))).select(*motion.columns)
        rate = median_rate_hz(fallback, "rate_hz", tuple(STREAM), split)
        calm = durable(still(fallback, rate, key=tuple(STREAM), split=split).where("still").select(
            *motion.columns))
        calm = with_attitude_gravity(calm).select(*STREAM, F.lit("still_angle").alias("measure"), angle_to_down("accel_total").alias("value"))
        counted = without.select(*STREAM, F.lit("still_angle").alias("measure"))
        stats.append(counted.join(_measure_stats(calm), by, "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint"))))
    return union_all(stats)


def _measure_stats(long: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    by = [*STREAM, "measure"]
    return (quantiles(long, by, "value", counts=cells, median=0.5, p95=0.95, q25=0.25, q75=0.75)
            .select(*by, "n", "median", "p95", (F.col("q75") - F.col("q25")).alias("iqr")))


def physics_findings(stats: DataFrame) -> DataFrame:
    """Acceleration band, gravity norm and sign, angular rate and quaternion checks.

    Every row of ``stats`` answers at most one check, so one pass over them is enough.
    """
    median, p95, iqr, n, measure = (F.col(c) for c in ("median", "p95", "iqr", "n", "measure"))
    enough = n >= MIN_PHYSICS_ROWS
    hint = (F.when(median.between(*ACCEL_MIX_BAND), "; observed value suggests a user/total mix")
            .when(median.between(*ACCEL_SI_BAND), "; observed value suggests m/s2 instead of g").otherwise(""))
    rules = [(f"norm_{q}", F.lit(True), "accel_semantic_band", q, 5, F.concat(F.lit(f"median in {band}"), hint),
              median.between(*band)) for q, band in ACCEL_BANDS.items()]
    rules += [
        ("norm_gravity", F.lit(True), "gravity_norm", "gravity", 5,
         F.lit(f"median in {GRAVITY_NORM_BAND}, IQR < {GRAVITY_NORM_MAX_IQR}"),
         median.between(*GRAVITY_NORM_BAND) & (iqr < GRAVITY_NORM_MAX_IQR)),
        ("flat_gz", n > 10, "gravity_sign", "gravity", 4, F.lit("gz near -1 when the device lies flat"), median < 0),
        ("norm_gyro", F.lit(True), "gyro_range", "gyro", 5, F.lit(f"median in {GYRO_MEDIAN_BAND}, p95 < {GYRO_P95_MAX}"),
         median.between(*GYRO_MEDIAN_BAND) & (p95 < GYRO_P95_MAX)),
        ("norm_quat", F.lit(True), "quat_norm", "quat", 6, F.lit(f"median in {QUAT_NORM_BAND}"),
         median.between(*QUAT_NORM_BAND)),
        ("quat_gravity_angle", enough, "quat_gravity_agreement", "quat", 4,
         F.lit(f"median angle < {QUAT_GRAVITY_ANGLE_MAX_DEG} deg"), median < QUAT_GRAVITY_ANGLE_MAX_DEG),
        ("still_angle", enough, "quat_still_agreement", "quat", 4,
         F.lit(f"median angle < {QUAT_STILL_ANGLE_MAX_DEG} deg over still windows"), median < QUAT_STILL_ANGLE_MAX_DEG),
    ]
    found = None
    for name, applies, check, column, digits, expected, passed in rules:
        shown = F.bround(median, digits)
        entry = F.struct(F.lit(check).alias("check"), F.lit(column).alias("column"), shown.cast("string").alias("observed"),
                         shown.alias("observed_num"), expected.alias("expected"),
                         F.coalesce(passed, F.lit(False)).alias("passed"))
        match = (measure == name) & applies
        found = F.when(match, entry) if found is None else found.when(match, entry)
    short = F.struct(F.lit("quat_still_agreement").alias("check"), F.lit("quat").alias("column"),
                     F.concat(n.cast("string"), F.lit(" still samples")).alias("observed"),
                     F.lit(None).cast("double").alias("observed_num"),
                     F.lit("at least 100 still samples for the fallback check").alias("expected"),
                     F.lit(False).alias("passed"))
    found = found.when((measure == "still_angle") & ~enough, short)
    return stats.select(*STREAM, found.alias("f")).where("f IS NOT NULL").select(
        "f.check", *STREAM, "f.column", "f.observed", "f.observed_num", "f.expected", "f.passed").select(*FINDING)


# --- event and interval tables ----------------------------------------------------------------------

def vocabulary(table: DataFrame, check: str, modality: str, column: str, known: tuple[str, ...]) -> DataFrame:
    """One passing finding per table, or one failing finding per value outside the vocabulary.

    A table may hold any number of strange values, so they are rows rather than one joined text.
    """
    used = table.groupBy("recording_id", F.col(column).alias("value")).agg(F.count("*").alias("rows"))
    strange = used.withColumn("value", F.when(~F.coalesce(F.col("value").isin(*known), F.lit(False)),
                                              F.coalesce("value", F.lit("NULL"))))
    listed = strange.where("value IS NOT NULL").select("recording_id", "value")
    clean = strange.groupBy("recording_id").agg(F.max("value").alias("value")).where("value IS NULL")
    rows = union_all([listed, clean])
    return finding(rows, check, modality=modality, column=column, observed=F.coalesce("value", F.lit("-")),
                   expected=f"subset of {known}", passed=F.col("value").isNull())


def dot_type_vocabulary(pen: DataFrame) -> DataFrame:
    return vocabulary(pen, "dot_type_vocabulary", "pen", "dot_type", DOT_TYPES)


def attention_label_vocabulary(attention: DataFrame) -> DataFrame:
    return vocabulary(attention, "attention_label_vocabulary", "attention", "label", ATTENTION_LABELS)


# --- across the tables of a recording ----------------------------------------------------------------

def _declared(meta: DataFrame, column: str) -> Column:
    return F.col(column) if column in meta.columns else F.lit(None)


def time_magnitude(span: DataFrame, meta: DataFrame) -> DataFrame:
    rows = span.join(meta.select("recording_id", _declared(meta, "time_origin").alias("time_origin")),
                     "recording_id", "left")
    rebased = F.coalesce(F.col("time_origin") == "recording_start", F.lit(False))
    start = F.col("t_start_ns")
    return finding(rows, "time_magnitude", column="-", observed=start, number=start,
                   expected=F.when(rebased, "timestamps relative to the recording start").otherwise(
                       "timestamps on the declared wall clock"),
                   passed=F.when(rebased, (start >= 0) & (start < EPOCH_NS[0])).otherwise(
                       start.between(*EPOCH_NS)))


def no_unix_timestamps(tables: dict[str, DataFrame], span: DataFrame, meta: DataFrame, leaks: DataFrame | None = None) -> DataFrame:
    """For recordings rebased to their start: no stored column may still hold a date.

    ``leaks``: recording_id, modality, column, where known already.
    """
    rebased = meta.where(_declared(meta, "time_origin") == "recording_start").select("recording_id")
    if leaks is None:
        leaks = union_all([epoch_columns(t.drop("modality")).withColumn("modality", F.lit(m)) for m, t in tables.items()])
    # At most one entry per stored column.
    listed = leaks.groupBy(*STREAM).agg(F.array_join(F.array_sort(F.collect_set("column")), ", ").alias("left"))
    rows = span.join(rebased, "recording_id", "left_semi").join(listed, STREAM, "left")
    return finding(rows, "no_unix_timestamps", column="-", observed=F.coalesce("left", F.lit("none")),
                   expected="no column holds a Unix timestamp under time_origin 'recording_start'",
                   passed=F.col("left").isNull())


def streams_overlap(span: DataFrame, dropped: DataFrame) -> DataFrame:
    """At least two streams that are no dropouts must share some time."""
    kept = span.join(dropped.select(*STREAM), STREAM, "left_anti")
    shared = kept.groupBy("recording_id").agg(
        F.count("*").alias("_n"), ((F.min("t_end_ns") - F.max("t_start_ns")) / F.lit(1e9)).alias("overlap_s"),
        F.array_join(F.array_sort(F.collect_set("modality")), "+").alias("modality")).where("_n > 1")
    shown = F.bround("overlap_s", 3)
    return finding(shared, "streams_overlap", column="-", observed=shown, number=shown,
                   expected="modality time ranges overlap", passed=F.col("overlap_s") > 0)


def modality_dropout(dropped: DataFrame) -> DataFrame:
    return finding(dropped, "modality_dropout", column="-", number=F.col("coverage_ratio"),
                   observed=F.concat(F.col("n_samples").cast("string"), F.lit(" samples, ratio "),
                                     F.col("coverage_ratio").cast("string")),
                   expected="coverage ratio < 0.01 - exempt from streams_overlap and minimum-length "
                            "capability checks", passed=F.lit(True))


def spill_guard(span: DataFrame, meta: DataFrame) -> DataFrame:
    """No sample long before the declared session start; skipped where none is declared."""
    rows = span.join(meta.select("recording_id", _declared(meta, "session_start_ns").cast("bigint").alias("s")),
                     "recording_id").where("s IS NOT NULL")
    lag = (F.col("s") - F.col("t_start_ns")) / F.lit(1e9)
    shown = F.bround(lag, 3)
    return finding(rows, "spill_guard", column="-", observed=shown, number=shown,
                   expected=f"no sample more than {SPILL_GUARD_S} s before session start",
                   passed=lag <= SPILL_GUARD_S)


def reported(meta: DataFrame, check: str, column: str, modality: str, digits: int, expected: str) -> DataFrame:
    """A declared quantity passed on as a finding that never fails."""
    shown = F.bround(_declared(meta, column).cast("double"), digits)
    rows = meta.where(_declared(meta, column).isNotNull())
    return finding(rows, check, modality=modality, column="-", observed=shown, number=shown,
                   expected=expected, passed=F.lit(True))


def attention_within_headimu_range(span: DataFrame) -> DataFrame:
    def of(name, prefix):
        return span.where(F.col("modality") == name).select(
            "recording_id", F.col("t_start_ns").alias(f"{prefix}_lo"), F.col("t_end_ns").alias(f"{prefix}_hi"))
    rows = of("attention", "a").join(of("headimu", "h"), "recording_id")
    def span_text(p):
        return F.format_string("[%d, %d]", f"{p}_lo", f"{p}_hi")
    return finding(rows, "attention_within_headimu_range", modality="attention", column="-",
                   observed=span_text("a"), expected=F.concat(F.lit("inside headimu range "), span_text("h")),
                   passed=(F.col("h_lo") <= F.col("a_lo")) & (F.col("a_hi") <= F.col("h_hi")))


def accel_semantics_matches_columns(span: DataFrame, meta: DataFrame, columns: DataFrame) -> DataFrame:
    """Declared acceleration semantics must be known and its vector stored on the primary stream.

    ``columns``: recording_id, modality, column of every stored column.
    """
    primary = _primary(span)
    vectors = {s: VECTORS[q] for s, q in ACCEL_SEMANTICS.items()}
    held = columns.groupBy(*STREAM).agg(*[
        (F.count_distinct(F.when(F.col("column").isin(*cols), F.col("column"))) == len(cols)).alias(f"_{s}")
        for s, cols in vectors.items()])
    rows = (primary.join(held, STREAM, "left")
            .join(meta.select("recording_id", _declared(meta, "accel_semantics").alias("said")),
                  "recording_id", "left"))
    passed = F.lit(False)
    for name in vectors:
        passed = passed | ((F.col("said") == name) & F.col(f"_{name}"))
    return finding(rows, "accel_semantics_matches_columns", column="-",
                   observed=F.coalesce(F.nullif("said", F.lit("")), F.lit("-")),
                   expected=f"accel_semantics must be one of {sorted(vectors)} and its implied "
                            "accel_total_*/accel_user_* columns must be present", passed=passed)


def _primary(span: DataFrame) -> DataFrame:
    """(recording_id, modality) of the watch, else the head sensor."""
    return (span.where(F.col("modality").isin("watch", "headimu")).groupBy("recording_id")
            .agg(F.max("modality").alias("modality")))  # "watch" sorts after "headimu"


def time_alignment_vocabulary(meta: DataFrame, span: DataFrame) -> DataFrame:
    rows = meta.select("recording_id", _declared(meta, "time_alignment").alias("a")).join(
        _primary(span), "recording_id", "left")
    return finding(rows, "time_alignment_vocabulary", modality=F.coalesce("modality", F.lit("-")), column="-",
                   observed=F.coalesce(F.nullif("a", F.lit("")), F.lit("-")), expected=f"one of {TIME_ALIGNMENTS}",
                   passed=F.col("a").isin(*TIME_ALIGNMENTS))


def check_tables(tables: dict[str, DataFrame], meta: DataFrame, rates: DataFrame | None = None) -> DataFrame:
    """Findings of every check that applies to the tables and declared facts.

    Motion is read three times: by the census, which every check of presence, time and dates shares and which counts the cells of the
    physical measures; along the order of its samples; and for the values of the cells that hold wanted ranks.
    """
    known = census(tables, with_physical_measures, PHYSICAL_MEASURES)
    span = known.spans()
    dropped = dropouts(span)
    split = oversized(span)
    found = []
    if any(m in tables for m in MOTION_MODALITIES):
        motion = all_motion(tables)
        nominal = meta.select("recording_id", _declared(meta, "watch_hz_nominal").cast("double").alias("watch_hz_nominal"),
                              _declared(meta, "head_hz_nominal").cast("double").alias("head_hz_nominal"))
        steps = time_steps(motion, tuple(STREAM), None if split else False)
        if rates is None:
            rates = median_rate_hz(motion, "sample_rate_hz", tuple(STREAM), steps=steps)
        found += [time_monotonic(motion, steps=steps), sample_rate(motion, nominal, rates, span),
                  physics_findings(physics(motion, None if split else False, known.cells))]
    if "pen" in tables:
        found.append(dot_type_vocabulary(tables["pen"]))
    if "attention" in tables:
        found.append(attention_label_vocabulary(tables["attention"]))
    if "headimu" in tables and "attention" in tables:
        found.append(attention_within_headimu_range(span))
    found += [time_magnitude(span, meta), no_unix_timestamps(tables, span, meta, known.dated_columns()), streams_overlap(span, dropped),
              modality_dropout(dropped), spill_guard(span, meta),
              accel_semantics_matches_columns(span, meta, known.columns("watch", "headimu")),
              time_alignment_vocabulary(meta, span)]
    found.append(reported(meta, "payload_keys_redacted", "src_payload_dropped_key_count", "markers", 0,
                          "payload keys outside the allow-list are dropped before publication"))
    found.append(reported(meta, "attention_protocol_tail", "attention_protocol_tail_s", "attention", 3,
                          "recording length minus the protocol's stated total"))
    return union_all(found)


# --- coverage -----------------------------------------------------------------------------------------

def required_checks() -> list[tuple[str, str, str, str, bool]]:
    """(flag, modality, check, reason, exempt for dropouts) of every check a flag demands."""
    rules = []
    for modality in MOTION_MODALITIES:
        rules += [(f"has_{modality}", modality, check, "motion table present", False)
                  for check in ("time_monotonic", "sample_rate", "accel_semantic_band")]
    rules += [(flag, modality, "time_magnitude", f"{flag} is true", False)
              for flag, modality in MODALITY_FLAGS.items()]
    rules += [(flag, modality, check, f"{flag} is true", True)
              for flag, (modality, _, check) in CAPABILITY_FLAGS.items()]
    rules += [("has_pen", "pen", "dot_type_vocabulary", "has_pen is true", False),
              ("has_attention", "attention", "attention_label_vocabulary", "has_attention is true", False)]
    return rules


def coverage_gaps(manifest: DataFrame, findings: DataFrame, dropped: DataFrame) -> DataFrame:
    """(recording_id, modality, check, reason) demanded by the manifest but absent from the findings."""
    def demand(flag, modality, check, reason, exempt):
        return F.when(flag, F.struct(F.lit(modality).alias("modality"), F.lit(check).alias("check"),
                                     F.lit(reason).alias("reason"), F.lit(exempt).alias("exempt")))
    rules = [demand(F.col(flag), *rest) for flag, *rest in required_checks() if flag in manifest.columns]
    both = F.col("has_attention") & F.col("has_headimu")
    rules.append(demand(both, "attention", "attention_within_headimu_range",
                        "has_attention and has_headimu are true", False))
    agreement = "quat_gravity_agreement or quat_still_agreement"
    if "has_quaternion" in manifest.columns:
        rules.append(demand(F.col("has_quaternion"), "watch", agreement, "has_quaternion is true", True))
    wanted = manifest.select("recording_id", F.inline(F.array_compact(F.array(*rules))))
    either = F.col("check").isin("quat_gravity_agreement", "quat_still_agreement")
    ran = findings.select("recording_id", "modality",
                          F.explode(F.array_compact(F.array(F.col("check"), F.when(either, F.lit(agreement)))))
                          .alias("check")).distinct()
    short = dropped.select("recording_id", "modality", F.lit(True).alias("exempt"))
    return (wanted.join(short, [*STREAM, "exempt"], "left_anti")
            .join(ran, [*STREAM, "check"], "left_anti").select(*STREAM, "check", "reason"))


def coverage_findings(gaps: DataFrame) -> DataFrame:
    text = F.concat("recording_id", F.lit("/"), "modality", F.lit(": "), "check", F.lit(" never ran ("),
                    "reason", F.lit(")"))
    return finding(gaps, "coverage_gap", column="-", observed=text, passed=F.lit(False),
                   expected="check ran and produced a finding")


# --- stored archive against its own descriptions -------------------------------------------------------

def declared_tables(manifest: DataFrame) -> DataFrame:
    """(recording_id, modality) of every table the manifest declares."""
    entries = [F.when(F.col(flag), F.lit(m)) for flag, m in MODALITY_FLAGS.items() if flag in manifest.columns]
    return manifest.select("recording_id", F.explode(F.array_compact(F.array(*entries))).alias("modality"))


def inventory_problems(declared: DataFrame, stored: DataFrame) -> DataFrame:
    """Declared tables without rows and stored tables nobody declared."""
    both = declared.withColumn("_d", F.lit(True)).join(
        stored.select(*STREAM).distinct().withColumn("_s", F.lit(True)), STREAM, "full_outer")
    problem = F.when(F.col("_s").isNull(), "declared but missing").when(
        F.col("_d").isNull(), "present but not declared")
    return both.select(*STREAM, problem.alias("problem")).where("problem IS NOT NULL")


def manifest_consistency(declared: DataFrame, stored: DataFrame) -> DataFrame:
    text = F.concat("modality", F.lit("/"), "recording_id", F.lit(" "), "problem")
    return finding(inventory_problems(declared, stored), "manifest_consistency", column="-", observed=text,
                   expected="has_<modality> flag matches table presence", passed=F.lit(False))


def undeclared_channels(channels: DataFrame, declared: DataFrame) -> DataFrame:
    """Violations: descriptors of tables the manifest does not declare."""
    return channels.select(*STREAM).distinct().join(declared, STREAM, "left_anti")


def duplicate_ids(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("recording_id").agg(F.count("*").alias("rows")).where("rows > 1")


def contract_problems(columns: list[str], expected: list[str] | tuple[str, ...], name: str) -> None:
    """Refuse a stored table whose columns differ from the published contract."""
    missing, extra = sorted(set(expected) - set(columns)), sorted(set(columns) - set(expected))
    if missing or extra:
        raise ValueError(f"{name}: contract columns mismatch (missing={missing}, unexpected={extra})")


def differing_values(stored: DataFrame, computed: DataFrame, on: list[str], columns: list[str]) -> DataFrame:
    """(keys, field, stored, computed) wherever two tables disagree; NULL equals NULL, and a row that one of them lacks is NULL there."""
    left = stored.select(*on, F.struct(*columns).alias("_s"))
    right = computed.select(*on, F.struct(*columns).alias("_c"))
    entries = F.array(*[F.when(~F.col(f"_s.{c}").eqNullSafe(F.col(f"_c.{c}")), F.struct(
        F.lit(c).alias("field"), F.col(f"_s.{c}").cast("string").alias("stored"),
        F.col(f"_c.{c}").cast("string").alias("computed"))) for c in columns])
    return left.join(right, on, "full_outer").select(*on, F.inline(F.array_compact(entries)))


def manifest_drift(manifest: DataFrame, tables: dict[str, DataFrame],
                   withdrawn: DataFrame | None = None, rates: DataFrame | None = None) -> DataFrame:
    """Stored manifest values that differ from what the tables say now."""
    return differing_values(manifest, derived_values(tables, withdrawn, rates), ["recording_id"],
                            list(DERIVED_MANIFEST_COLUMNS))


def descriptor_problems(channels: DataFrame, tables: dict[str, DataFrame], manifest: DataFrame,
                        rates: DataFrame | None = None) -> DataFrame:
    """(recording_id, modality, column, problem) of channel rows that do not describe the tables."""
    by = [*STREAM, "column"]
    columns = stored_columns(tables)
    repeated = channels.groupBy(*by).agg(F.count("*").alias("_n")).where("_n > 1").select(
        *by, F.lit("duplicate descriptor").alias("problem"))
    missing = columns.join(channels, by, "left_anti").select(*by, F.lit("missing descriptor").alias("problem"))
    extra = channels.join(columns, by, "left_anti").select(*by, F.lit("describes no stored column").alias("problem"))
    # Clocks are declared facts, so the stored ones stand in for them here.
    clocks = channels.select(*by, "time_domain")
    expected = channel_rows(columns, rounded_rates(rates if rates is not None else table_rates(tables)), clocks)
    both = channels.join(expected, by, "left_semi")  # rows that one side lacks are problems of their own, above
    wrong = differing_values(both, expected.join(channels, by, "left_semi"), by, ["quantity", "unit", "semantics", "frame", "sample_rate_hz"])
    wrong = wrong.select(*by, F.concat(F.lit("wrong "), "field").alias("problem"))
    factor = F.col("unit_conversion_factor")
    invalid = channels.where(factor.isNull() | F.isnan(factor) | (F.abs(factor) == float("inf"))).select(
        *by, F.lit("invalid unit_conversion_factor").alias("problem"))
    blank = channels.where(F.coalesce(F.trim("time_domain"), F.lit("")) == "").select(
        *by, F.lit("no time_domain").alias("problem"))
    primary = declared_tables(manifest).where(F.col("modality").isin("watch", "headimu")).groupBy(
        "recording_id").agg(F.max("modality").alias("modality"))
    clash = (channels.where(F.col("column") == "t_ns").join(primary, STREAM, "left_semi")
             .join(manifest.select("recording_id", F.col("time_domain").alias("_m")), "recording_id")
             .where(~F.col("time_domain").eqNullSafe(F.col("_m")))
             .select(*by, F.lit("clock differs from the manifest").alias("problem")))
    return union_all([repeated, missing, extra, wrong, invalid, blank, clash])


def stamp_problems(tables: dict[str, DataFrame], manifest: DataFrame) -> DataFrame:
    """Tables whose stamped id or schema version differs from where and how they are stored.

    Tables written by :func:`motionloom.sources.sinks.write_table` carry ``stamped_id`` and
    ``schema_version``; without a stamp, every recording of the table is a problem.
    """
    found = [manifest.where(~F.col("schema_version").eqNullSafe(F.lit(SCHEMA_VERSION))).select(
        "recording_id", F.lit("-").alias("modality"), F.lit("schema_version").alias("stamp"),
        F.col("schema_version").alias("observed"))]
    for name, table in tables.items():
        for stamp, expected in (("stamped_id", F.col("recording_id")), ("schema_version", F.lit(SCHEMA_VERSION))):
            observed = F.col(stamp) if stamp in table.columns else F.lit(None).cast("string")
            found.append(table.where(~observed.eqNullSafe(expected)).select(
                "recording_id", F.lit(name).alias("modality"), F.lit(stamp).alias("stamp"),
                observed.alias("observed")).distinct())
    return union_all(found)


def validate_archive(manifest: DataFrame, channels: DataFrame, tables: dict[str, DataFrame], *,
                     withdrawn: DataFrame | None = None, checksums: DataFrame | None = None) -> DataFrame:
    """Recheck a stored archive from its manifest, channels and tables alone.

    Structural contradictions raise; everything measurable becomes a finding.  ``checksums``: the
    problems found by :func:`motionloom.sources.sinks.checksum_problems`.
    """
    contract_problems(manifest.columns, MANIFEST_COLUMNS, "manifest")
    contract_problems(channels.columns, CHANNEL_COLUMNS, "channels")
    refuse(duplicate_ids(manifest), "duplicate recording_id values")
    refuse(redaction_policy_problems(manifest), "redaction_policy must be known and consistent")
    refuse(time_origin_problems(manifest), "time_origin must be known and consistent")
    declared = declared_tables(manifest)
    held = spans(tables)
    refuse(held.select(*STREAM).join(declared, STREAM, "left_anti"), "orphan tables")
    refuse(undeclared_channels(channels, declared), "channels for undeclared tables")
    refuse(stamp_problems(tables, manifest), "stamped id or schema version differs")
    stampless = {m: t.drop("stamped_id", "schema_version") for m, t in tables.items()}
    rates = durable(table_rates(stampless))
    refuse(manifest_drift(manifest, stampless, withdrawn, rates), "manifest differs from the stored tables")
    refuse(descriptor_problems(channels, stampless, manifest, rates), "channels do not describe the stored tables")
    policy = manifest.select("redaction_policy").first()
    if policy and policy[0] != "none" and {"pen", "markers"} & tables.keys():
        refuse(redaction_violations(stampless.get("pen"), stampless.get("markers"), policy[0]),
               "stored coordinates violate the policy")
    findings = durable(check_tables(stampless, manifest, rates))
    parts = [manifest_consistency(declared, held), findings,
             coverage_findings(coverage_gaps(manifest, findings, dropouts(held)))]
    if checksums is not None:
        parts.append(checksums.select(
            F.lit("checksum").alias("check"), F.lit("-").alias("recording_id"), F.lit("-").alias("modality"),
            F.lit("-").alias("column"), F.concat("path", F.lit(": "), "problem").alias("observed"),
            F.lit(None).cast("double").alias("observed_num"),
            F.lit("every file matches the stored list").alias("expected"), F.lit(False).alias("passed")))
    return union_all(parts).select(*FINDING)


def summary(findings: DataFrame) -> DataFrame:
    """(check, findings, failed) of a report."""
    return findings.groupBy("check").agg(F.count("*").alias("findings"),
                                         F.count_if(~F.col("passed")).alias("failed"))


def failed(findings: DataFrame) -> DataFrame:
    return findings.where("NOT passed")


def strict_gate(findings: DataFrame) -> DataFrame:
    """Keep the findings, and stop the publish if any failed."""
    kept = durable(findings)
    refuse(failed(kept).select("check", "recording_id", "modality", "observed"),
           "validation failed, nothing was published")
    return kept
