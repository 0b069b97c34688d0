"""Selection by capability, load guards, and reports over manifest and channels."""

from __future__ import annotations

from pyspark.sql import functions as F


from motionloom.plans import report, select

from .projections import TOLERANCE_S, as_int, channels, manifest, markers, motion, query, rounded
from .projections import attention, pen

WRITING = select.LabelConfig("writing", gap_closing_s=3.0)


@query("SELECT recording_id FROM manifest WHERE has_watch = TRUE AND accel_semantics = 'user'", "manifest")
def by_flags(spark, sf):
    return select.by_flags(manifest(spark, sf), has_watch=True, accel_semantics="user").select("recording_id")


@query("""SELECT recording_id FROM manifest WHERE pen_pressure_scale = 'webapp_force'""", "manifest")
def by_flags_nullable(spark, sf):
    """A NULL never matches a flag."""
    return select.by_flags(manifest(spark, sf), pen_pressure_scale="webapp_force").select("recording_id")


@query("""SELECT recording_id FROM manifest WHERE duration_s BETWEEN 1000 AND 4000 AND (has_pen OR cohort IN
    ('BUILDING', 'MACHINERY')) AND NOT has_attention""", "manifest")
def manifest_expression(spark, sf):
    return manifest(spark, sf).where("duration_s BETWEEN 1000 AND 4000 AND (has_pen OR cohort IN "
                                     "('BUILDING', 'MACHINERY')) AND NOT has_attention").select("recording_id")


@query("""SELECT recording_id FROM manifest WHERE watch_hz_nominal IN (50.0, 100.0) AND has_watch
    AND cohort IN ('BUILDING', 'FURNITURE') AND accel_semantics IN ('user')""", "manifest")
def facet_selection(spark, sf):
    extra = select.cohort_facets(["BUILDING", "FURNITURE", "MACHINERY"])
    return select.filter_manifest(manifest(spark, sf), {
        "smartwatch", "watch_50_hz", "watch_100_hz", "cohort_building", "cohort_furniture",
        "acceleration_user"}, extra).select("recording_id")


def _facet_sql() -> str:
    """One count per facet next to the active ones (smartwatch, watch_50_hz)."""
    active = {"smartwatch", "watch_50_hz"}
    rows = []
    for facet in select.FACETS:
        by_column: dict[str, list[str]] = {}
        for name, (column, value) in select.FACETS.items():
            if name in active | {facet}:
                literal = f"'{value}'" if isinstance(value, str) else str(value).upper()
                by_column.setdefault(column, []).append(f"{column} = {literal}")
        test = " AND ".join("(" + " OR ".join(v) + ")" for v in by_column.values())
        rows.append(f"SELECT '{facet}' AS facet, count(*) FILTER ({test}) AS recordings FROM manifest")
    return " UNION ALL ".join(rows)


@query(_facet_sql(), "manifest")
def facet_counts(spark, sf):
    return select.facet_counts(manifest(spark, sf), {"smartwatch", "watch_50_hz"})


@query("""SELECT recording_id, has_watch::INT AS has_watch, has_pen::INT AS has_pen, 0 AS has_headimu,
    0 AS has_attention, has_gravity::INT AS has_gravity, 0 AS has_head_gyro, watch_model, '' AS head_model,
    pen_model FROM manifest WHERE has_pen""", "manifest")
def subset_manifest(spark, sf):
    selected = select.filter_manifest(manifest(spark, sf), {"digital_pen"})
    modalities = select.selected_modalities(selected, {"digital_pen"})
    subset = select.subset_manifest(selected, modalities)
    flags = ["has_watch", "has_pen", "has_headimu", "has_attention", "has_gravity", "has_head_gyro"]
    return as_int(subset, *flags).select("recording_id", *flags, "watch_model", "head_model", "pen_model")


@query("""SELECT recording_id, CASE WHEN watch_hz_nominal = 100 THEN 50.0 ELSE watch_hz_nominal END AS watch_hz_nominal,
    CASE WHEN watch_hz_nominal = 100 THEN 50.0 ELSE watch_hz_measured END AS watch_hz_measured,
    CASE WHEN watch_hz_nominal = 100 THEN (n_samples_watch + 1) // 2 ELSE n_samples_watch END AS n_samples_watch
    FROM manifest WHERE has_watch""", "manifest")
def resampled_manifest(spark, sf):
    watches = manifest(spark, sf).where("has_watch")
    factors = watches.select("recording_id", F.col("watch_hz_nominal").alias("rate_hz"))
    from motionloom.operators.resample import decimation_factors
    return select.resampled_manifest(watches, decimation_factors(factors, 50.0), 50.0).select(
        "recording_id", "watch_hz_nominal", "watch_hz_measured", "n_samples_watch")


_REASON = """CASE WHEN NOT has_watch AND NOT has_pen THEN 'has_watch is false, has_pen is false'
    WHEN NOT has_watch THEN 'has_watch is false' WHEN NOT has_pen THEN 'has_pen is false'
    WHEN time_alignment = 'overlap_only' THEN 'time_alignment is overlap_only and include_overlap_only is off' END"""


@query(f"SELECT recording_id, {_REASON} AS reason FROM manifest", "manifest")
def eligibility(spark, sf):
    return select.with_eligibility(manifest(spark, sf), WRITING).select("recording_id", "reason")


@query(f"""WITH requested AS (SELECT DISTINCT 'R' || o_custkey * 2 AS recording_id FROM orders), judged AS (
    SELECT r.recording_id, CASE WHEN m.recording_id IS NULL THEN 'unknown recording id' ELSE coalesce({_REASON},
    CASE WHEN cohort NOT IN ('BUILDING', 'MACHINERY') THEN 'cohort ' || cohort || ' is not selected' END) END AS reason
    FROM requested r LEFT JOIN manifest m ON r.recording_id = m.recording_id)
    SELECT * FROM judged WHERE reason IS NOT NULL""", "manifest")
def rejected_recordings(spark, sf):
    requested = spark.read.parquet(f"{sf}/orders.parquet").select(
        F.concat(F.lit("R"), (F.col("o_custkey") * 2).cast("string")).alias("recording_id"))
    return select.rejected_recordings(requested, manifest(spark, sf), WRITING, ["BUILDING", "MACHINERY"])


@query("SELECT recording_id, cohort FROM manifest ORDER BY recording_id LIMIT 25", "manifest")
def first_recordings(spark, sf):
    return select.first_recordings(manifest(spark, sf), 25).select("recording_id", "cohort")


@query(r"""SELECT recording_id, array_to_string([CASE WHEN regexp_matches(p, '^\d')
    THEN lpad(length(ltrim(p, '0'))::VARCHAR, 9, '0') || ltrim(p, '0') ELSE p END FOR p IN regexp_extract_all(lower(recording_id), '(\d+|\D+)')], '') AS sort_key FROM manifest""", "manifest")
def natural_order(spark, sf):
    return select.natural_order(manifest(spark, sf)).select("recording_id", "sort_key")


# --- loading ------------------------------------------------------------------------------------------

_REQUESTED = ["U8", "U3", "U8", "U11"]


@query("""WITH requested AS (SELECT * FROM (VALUES ('U8', 0), ('U3', 1), ('U8', 2), ('U11', 3)) r(recording_id, ordinal))
    SELECT r.ordinal, m.recording_id, m.seq, m.t_ns, m.v FROM requested r JOIN motion m USING (recording_id)""", "motion")
def load_recordings(spark, sf):
    """An id asked for twice is loaded twice."""
    rows = motion(spark, sf)
    listed = rows.groupBy("recording_id").agg(F.lit(True).alias("has_watch"), F.lit("user").alias("accel_semantics"))
    return as_int(select.load_recordings(rows, listed, _REQUESTED), "ordinal").select(
        "ordinal", "recording_id", "seq", "t_ns", "v")


@query("""SELECT m.recording_id, m.seq, CASE WHEN substr(m.recording_id, 2)::INT % 2 = 0 THEN 50.0 ELSE 100.0 END
    AS sample_rate_hz FROM motion m""", "motion")
def load_mixed_rates(spark, sf):
    rows = motion(spark, sf)
    ids = rows.select("recording_id").distinct()
    rate = F.when(F.expr("substring(recording_id, 2) % 2 = 0"), 50.0).otherwise(100.0)
    described = ids.select("recording_id", F.lit("watch").alias("modality"), rate.alias("sample_rate_hz"))
    listed = ids.select("recording_id", F.lit(True).alias("has_watch"), F.lit("user").alias("accel_semantics"))
    return select.load_recordings(rows, listed, ids, channels=described, allow_mixed_rates=True).select(
        "recording_id", "seq", "sample_rate_hz")


@query("""SELECT recording_id, seq, 50.0 AS sample_rate_hz FROM (SELECT *, row_number() OVER (PARTITION BY recording_id
    ORDER BY t_ns, seq) - 1 AS rn FROM motion) WHERE substr(recording_id, 2)::INT % 2 = 0 OR rn % 2 = 0""", "motion")
def load_at_one_rate(spark, sf):
    """Recordings of 50 and 100 Hz brought to 50 Hz."""
    rows = motion(spark, sf)
    ids = rows.select("recording_id").distinct()
    rate = F.when(F.expr("substring(recording_id, 2) % 2 = 0"), 50.0).otherwise(100.0)
    described = ids.select("recording_id", F.lit("watch").alias("modality"), rate.alias("sample_rate_hz"))
    listed = ids.select("recording_id", F.lit(True).alias("has_watch"), F.lit("user").alias("accel_semantics"))
    return select.load_recordings(rows, listed, ids, channels=described, target_hz=50.0).select(
        "recording_id", "seq", "sample_rate_hz")


@query("""SELECT DISTINCT 'R' || o_custkey * 3 AS recording_id FROM orders WHERE 'R' || o_custkey * 3 NOT IN
    (SELECT recording_id FROM manifest)""", "manifest")
def unknown_ids(spark, sf):
    requested = spark.read.parquet(f"{sf}/orders.parquet").select(
        F.concat(F.lit("R"), (F.col("o_custkey") * 3).cast("string")).alias("recording_id"))
    return select.unknown_ids(requested, manifest(spark, sf))


@query("""WITH requested AS (SELECT recording_id FROM manifest UNION ALL SELECT 'X' || c_custkey FROM customer),
    stored AS (SELECT 'R' || o_custkey AS recording_id FROM orders)
    SELECT r.recording_id, CASE WHEN m.recording_id IS NULL THEN 'not a recording_id in the manifest'
    WHEN NOT m.has_pen THEN 'has_pen is false' ELSE '' END AS reason FROM requested r
    LEFT JOIN manifest m ON r.recording_id = m.recording_id
    WHERE r.recording_id NOT IN (SELECT recording_id FROM stored)""", "manifest")
def missing_tables(spark, sf):
    listed = manifest(spark, sf)
    extra = listed.select(F.regexp_replace("recording_id", "^R", "X").alias("recording_id"))
    stored = spark.read.parquet(f"{sf}/orders.parquet").select(
        F.concat(F.lit("R"), F.col("o_custkey").cast("string")).alias("recording_id")).distinct()
    return select.missing_tables(listed.select("recording_id").union(extra), stored, listed, "pen")


@query("""SELECT accel_semantics AS value, count(*) AS recordings FROM manifest WHERE accel_semantics <> ''
    GROUP BY accel_semantics""", "manifest")
def mixed_semantics(spark, sf):
    return select.mixed_semantics(manifest(spark, sf))


@query("""SELECT lowest, highest, (coalesce(highest / lowest > 1.1, FALSE))::INT AS mixed FROM (SELECT min(rate) AS lowest,
    max(rate) AS highest FROM (SELECT min(sample_rate_hz) AS rate FROM channels c JOIN manifest m USING (recording_id)
    WHERE modality = 'watch' AND m.has_watch GROUP BY recording_id))""", "manifest", "channels")
def rate_spread(spark, sf):
    watches = manifest(spark, sf).where("has_watch")
    return as_int(select.rate_spread(select.declared_rates(channels(spark, sf), watches, "watch")), "mixed")


@query("""SELECT field, value, count(*) AS recordings FROM (SELECT 'pen_xy_unit' AS field, pen_xy_unit AS value FROM manifest
    WHERE has_pen UNION ALL SELECT 'pen_pressure_scale', pen_pressure_scale FROM manifest WHERE has_pen)
    WHERE value IS NOT NULL GROUP BY field, value""", "manifest")
def mixed_units(spark, sf):
    return select.mixed_units(manifest(spark, sf).where("has_pen"))


@query("""SELECT watch_model AS value, recording_id FROM manifest WHERE has_watch""", "manifest")
def ids_by_value(spark, sf):
    return select.groups_of_values(manifest(spark, sf).where("has_watch"), "watch_model")


@query("""WITH counts AS (SELECT accel_semantics AS value, count(*) AS recordings FROM manifest WHERE has_watch AND has_pen
    AND accel_semantics <> '' AND time_alignment <> 'overlap_only' GROUP BY 1) SELECT * FROM counts""", "manifest")
def label_semantics(spark, sf):
    """What the guard of the writing task sees: semantics among the recordings it could label."""
    return select.mixed_semantics(select.eligible_recordings(manifest(spark, sf), WRITING))


@query()
def label_task(spark, sf):
    """The writing task end to end with its guards; the labels alone are compared in ``writing_labels``."""
    from motionloom.plans.label import label_recordings
    rows, dots = motion(spark, sf), pen(spark, sf)
    ids = rows.select("recording_id").distinct()
    listed = ids.withColumns({"has_watch": F.lit(True), "has_pen": F.lit(True), "accel_semantics": F.lit("user"),
                              "time_alignment": F.lit("shared_clock"), "cohort": F.lit("A")})
    config = select.LabelConfig("writing", gap_closing_s=86_400.0, contact_tolerance_s=TOLERANCE_S)
    return label_recordings({"watch": rows, "pen": dots}, listed, ids, config)


# --- reports ------------------------------------------------------------------------------------------

@query("""SELECT count(*) AS recordings, count(DISTINCT participant_id) AS participants,
    round(sum(duration_s) / 3600, 6) AS hours FROM manifest""", "manifest")
def corpus_counts(spark, sf):
    return rounded(report.corpus_counts(manifest(spark, sf)), "hours")


@query("SELECT cohort, count(*) AS recordings FROM manifest GROUP BY cohort", "manifest")
def cohort_counts(spark, sf):
    return report.cohort_counts(manifest(spark, sf))


@query("""SELECT pen_model, pen_hz_clock, count(*) AS recordings, round(quantile_cont(pen_hz_measured, 0.5), 6) AS median_hz,
    round(min(pen_hz_measured), 6) AS lowest_hz, round(max(pen_hz_measured), 6) AS highest_hz FROM manifest WHERE has_pen
    GROUP BY pen_model, pen_hz_clock""", "manifest")
def pen_rate_summary(spark, sf):
    return rounded(report.pen_rate_summary(manifest(spark, sf)), "median_hz", "lowest_hz", "highest_hz")


@query("""SELECT modality, "column", quantity, unit, semantics, time_domain, count(*) AS recordings FROM channels
    GROUP BY ALL""", "channels")
def channel_summary(spark, sf):
    return report.channel_summary(channels(spark, sf))


@query("""SELECT DISTINCT * FROM (SELECT 'pen' AS modality, 'dot_type' AS "column", dot_type AS value FROM pen
    UNION ALL SELECT 'attention', 'label', label FROM attention UNION ALL SELECT 'markers', 'event', event FROM markers
    UNION ALL SELECT 'markers', 'task_id', task_id FROM markers
    UNION ALL SELECT 'markers', 'task_category', task_category FROM markers) WHERE value IS NOT NULL""",
       "pen", "attention", "markers")
def category_values(spark, sf):
    return report.category_values({"pen": pen(spark, sf), "attention": attention(spark, sf),
                                   "markers": markers(spark, sf)})


@query("SELECT recording_id, 'headimu' AS modality FROM manifest WHERE issue_codes <> ''", "manifest")
def withdrawn_streams(spark, sf):
    return report.withdrawn_streams(manifest(spark, sf))


@query("""SELECT count(*) AS recordings, round(sum(duration_s) / 3600, 6) AS hours, count(*) FILTER (has_watch) AS watch,
    count(*) FILTER (has_headimu) AS headimu, count(*) FILTER (has_pen) AS pen,
    count(*) FILTER (has_attention) AS attention FROM manifest WHERE has_gravity""", "manifest")
def selection_summary(spark, sf):
    return rounded(report.selection_summary(manifest(spark, sf).where("has_gravity")), "hours")


@query("""SELECT CAST(round_even(watch_hz_measured, 0) AS INT) AS rate_hz, count(*) AS recordings FROM manifest
    WHERE watch_hz_measured IS NOT NULL GROUP BY 1""", "manifest")
def watch_rate_counts(spark, sf):
    return select.watch_rate_counts(manifest(spark, sf))


@query("SELECT count(*) FILTER (watch_hz_measured > 50.0 * 1.05) AS above_target FROM manifest", "manifest")
def watches_above(spark, sf):
    return select.watches_above(manifest(spark, sf), 50.0)


@query("""SELECT modality, coalesce(n, 0) AS recordings FROM (VALUES ('watch'), ('watch_rawaccel'), ('headimu'), ('pen'),
    ('markers'), ('attention')) m(modality) LEFT JOIN (SELECT 'watch' AS modality, count(DISTINCT recording_id) AS n
    FROM motion UNION ALL SELECT 'pen', count(DISTINCT recording_id) FROM pen
    UNION ALL SELECT 'attention', count(DISTINCT recording_id) FROM attention) USING (modality)""",
       "motion", "pen", "attention")
def modality_counts(spark, sf):
    from motionloom.plans.manifest import spans
    return report.modality_counts(spans({"watch": motion(spark, sf), "pen": pen(spark, sf),
                                         "attention": attention(spark, sf)}))


