"""One row per recording and one row per stored column, derived from the tables themselves.

``tables`` maps a modality to the table holding all its recordings (recording_id, seq, columns).
Declared facts come as tables too: ``meta`` (one row per recording), ``clocks`` (recording_id,
modality, column or NULL for the whole table, time_domain), ``factors`` (recording_id, modality,
column, unit_conversion_factor) and ``withdrawn`` (recording_id, modality).
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import lookup
from ..operators.layout import durable, rows_per_task, union_all
from ..operators.motion import column_presence, median_rate_hz, partial_vectors, table_span
from ..operators.pen import dot_rate
from .census import census
from ..vocabulary import (CAPABILITY_FLAGS, CHANNEL_COLUMNS, COLUMN_DESCRIPTIONS,
                          DERIVED_MANIFEST_COLUMNS, DEVICE_MODELS, DROPOUT_COVERAGE_MIN,
                          INTERNAL_META, MANIFEST_COLUMNS, MANIFEST_DEFAULTS, MANIFEST_SCHEMA,
                          MODALITY_FLAGS, MOTION_MODALITIES, NS_COLUMNS, SCHEMA_VERSION,
                          VECTOR_UNITS, VECTORS)

OWN_COLUMNS = ("recording_id", "seq")  # added by the scan, not part of a stored table


def refuse(problems: DataFrame, message: str, error: type[Exception] = ValueError, shown: int = 10) -> None:
    """Raise if there are violations, naming some of them."""
    rows = problems.take(shown)
    if rows:
        raise error(message + ": " + "; ".join(
            ", ".join(f"{k}={v!r}" for k, v in r.asDict().items()) for r in rows))


def spans(tables: dict[str, DataFrame]) -> DataFrame:
    """(recording_id, modality, t_start_ns, t_end_ns, n_samples) of every stored table.

    Written out: it is a row per recording and table, and those who ask join it with itself, which would put the counting of every
    table several times into one task.
    """
    return durable(union_all([table_span(table).withColumn("modality", F.lit(name))
                              for name, table in tables.items()]))


def dropouts(span: DataFrame) -> DataFrame:
    """Motion streams covering under 1 % of the time all motion streams of the recording cover."""
    motion = span.where(F.col("modality").isin(*MOTION_MODALITIES))
    whole = motion.groupBy("recording_id").agg(
        (F.max("t_end_ns") - F.min("t_start_ns")).alias("_total"), F.count("*").alias("_streams"))
    ratio = (F.col("t_end_ns") - F.col("t_start_ns")) / F.col("_total")
    return (motion.join(whole, "recording_id").where("_streams >= 2 AND _total > 0")
            .where(ratio < DROPOUT_COVERAGE_MIN)
            .select("recording_id", "modality", "n_samples", F.bround(ratio, 6).alias("coverage_ratio")))


def task_counts(markers: DataFrame) -> DataFrame:
    """Writing and idle task starts; NULL where no task start names a category."""
    start = F.col("event") == "task_start"
    known = F.bool_or(start & (F.coalesce(F.col("task_category"), F.lit("")) != ""))

    def starts(category):
        return F.when(known, F.count_if(start & (F.col("task_category") == category)).cast("int"))
    return markers.groupBy("recording_id").agg(starts("writing").alias("n_writing_tasks"),
                                               starts("idle").alias("n_idle_tasks"))


def capability_flags(facts: DataFrame) -> DataFrame:
    """Which complete vectors the watch and head tables of each recording carry, from the facts of a census."""
    def held(modality, vector):
        return (F.col("modality") == modality) & reduce(and_, [F.array_contains("columns", c) for c in VECTORS[vector]])
    return facts.where(F.col("modality").isin("watch", "headimu")).groupBy("recording_id").agg(
        *[F.bool_or(held(modality, vector)).alias(flag) for flag, (modality, vector, _) in CAPABILITY_FLAGS.items()])


def _shortest_decimal(ratio: Column) -> Column:
    """A ratio below 0.01 with six decimals, written the way JSON writers print it."""
    millionths = F.rint(ratio * 1e6).cast("bigint")
    plain = F.rtrim(ratio.cast("decimal(8,6)").cast("string"), F.lit("0"))
    tens = F.regexp_replace((millionths / 10).cast("string"), r"\.0$", "")
    return (F.when(millionths == 0, "0.0")
            .when(millionths < 10, F.concat(millionths.cast("string"), F.lit("e-06")))
            .when(millionths < 100, F.concat(tens, F.lit("e-05")))
            .otherwise(plain))


def issue_codes(dropped: DataFrame, withdrawn: DataFrame | None) -> DataFrame:
    """JSON list per recording: dropouts by modality, then withdrawn streams by modality."""
    entry = F.concat(F.lit('{"code": "modality_dropout", "modality": "'), "modality",
                     F.lit('", "n_samples": '), F.col("n_samples").cast("string"),
                     F.lit(', "coverage_ratio": '), _shortest_decimal(F.col("coverage_ratio")), F.lit("}"))
    parts = [dropped.select("recording_id", F.struct(F.lit(0).alias("o"), "modality", entry.alias("e")).alias("i"))]
    if withdrawn is not None:
        entry = F.concat(F.lit('{"code": "modality_withdrawn", "modality": "'), "modality", F.lit('"}'))
        parts.append(withdrawn.select("recording_id", F.struct(
            F.lit(1).alias("o"), "modality", entry.alias("e")).alias("i")))
    # At most one entry per modality and kind, so the list of a recording is short by construction.
    return union_all(parts).groupBy("recording_id").agg(F.concat(
        F.lit("["), F.array_join(F.transform(F.array_sort(F.collect_set("i")), lambda i: i["e"]), ", "),
        F.lit("]")).alias("issue_codes"))


def withdrawn_with_table(withdrawn: DataFrame, span: DataFrame) -> DataFrame:
    """Violations: streams declared withdrawn that still have rows."""
    return withdrawn.join(span.select("recording_id", "modality"), ["recording_id", "modality"], "left_semi")


def oversized(span: DataFrame) -> bool:
    """Does any stored table hold more rows of one recording than one task may?"""
    return (span.agg(F.max("n_samples")).first()[0] or 0) > rows_per_task(span.sparkSession)


def table_rates(tables: dict[str, DataFrame], split: bool | None = None) -> DataFrame:
    """(recording_id, modality, sample_rate_hz), unrounded: median rates, and the dot rate for pens, with its clock as ``rate_clock``."""
    timed = [tables[m].select("recording_id", F.lit(m).alias("modality"), "t_ns", "seq")
             for m in (*MOTION_MODALITIES, "markers") if m in tables]
    found = []
    if timed:
        found.append(median_rate_hz(union_all(timed), "sample_rate_hz", ("recording_id", "modality"), split))
    if "pen" in tables:
        found.append(dot_rate(tables["pen"], split).select(
            "recording_id", F.lit("pen").alias("modality"),
            F.col("pen_hz_measured").alias("sample_rate_hz"), F.col("pen_hz_clock").alias("rate_clock")))
    return union_all(found)


def rounded_rates(rates: DataFrame) -> DataFrame:
    """Rates as published, with three decimals."""
    return rates.withColumn("sample_rate_hz", F.bround("sample_rate_hz", 3))


def derived_values(tables: dict[str, DataFrame], withdrawn: DataFrame | None = None,
                   rates: DataFrame | None = None) -> DataFrame:
    """Every manifest value the tables alone determine, one row per recording."""
    found = census(tables)
    span = found.spans()
    split = oversized(span)

    def of(modality, column):
        return F.max(F.when(F.col("modality") == modality, F.col(column)))
    base = span.groupBy("recording_id").agg(
        F.min("t_start_ns").alias("t_start_ns"), F.max("t_end_ns").alias("t_end_ns"),
        *[F.bool_or(F.col("modality") == m).alias(flag) for flag, m in MODALITY_FLAGS.items()],
        *[F.coalesce(of(m, "n_samples"), F.lit(0).cast("bigint")).alias(name) for m, name in
          (("watch", "n_samples_watch"), ("pen", "n_samples_pen"), ("headimu", "n_samples_head"))],
    ).withColumn("duration_s", F.bround((F.col("t_end_ns") - F.col("t_start_ns")) / F.lit(1e9), 3))

    motion_tables = {m: t for m, t in tables.items() if m in ("watch", "headimu")}
    measured = rates if rates is not None else (table_rates(motion_tables, split) if motion_tables else None)
    parts = []
    if measured is not None:
        parts.append(rounded_rates(measured).groupBy("recording_id").agg(
            *[F.max(F.when(F.col("modality") == m, F.col("sample_rate_hz"))).alias(name)
              for m, name in (("watch", "watch_hz_measured"), ("headimu", "head_hz_measured"))]))
    if "pen" in tables:
        known = rates is not None and "rate_clock" in rates.columns
        parts.append(rates.where("modality = 'pen'").select("recording_id", F.col("sample_rate_hz").alias("pen_hz_measured"), F.col("rate_clock").alias("pen_hz_clock"))
                     if known else dot_rate(tables["pen"], split))
    if "markers" in tables:
        parts.append(task_counts(tables["markers"]))
    if "watch" in tables or "headimu" in tables:
        parts.append(capability_flags(found.facts))
    parts.append(issue_codes(dropouts(span), withdrawn))
    for part in parts:
        base = base.join(part, "recording_id", "left")
    missing = {"pen_hz_clock": F.lit(""), "issue_codes": F.lit(""),
               **{flag: F.lit(False) for flag in CAPABILITY_FLAGS}}
    types = {f.name: f.dataType for f in MANIFEST_SCHEMA.fields}
    columns = []
    for name in DERIVED_MANIFEST_COLUMNS:
        value = F.col(name) if name in base.columns else F.lit(None)
        if name in missing:
            value = F.coalesce(value, missing[name])
        columns.append(value.cast(types[name]).alias(name))
    return base.select("recording_id", *columns)


def require_complete_vectors(tables: dict[str, DataFrame]) -> None:
    for modality in ("watch", "headimu"):
        if modality in tables:
            refuse(partial_vectors(column_presence(tables[modality])), f"partial vector in {modality}")


# --- clocks ---------------------------------------------------------------------------------------

def table_clocks(clocks: DataFrame) -> DataFrame:
    return clocks.where(F.col("column").isNull()).select("recording_id", "modality", "time_domain")


def primary_clock(clocks: DataFrame) -> DataFrame:
    """Clock of the watch, else of the head sensor, else blank."""
    def of(modality):
        return F.max(F.when(F.col("modality") == modality, F.col("time_domain")))
    return table_clocks(clocks).groupBy("recording_id").agg(
        F.coalesce(of("watch"), of("headimu"), F.lit("")).alias("time_domain"))


# --- fixed values: alignment notes ----------------------------------------------------------------
NOTE_DIFFERS = ("{modalities} timestamps are on {domains}, not the '{primary}' clock the primary motion "
                "stream uses (see channels.parquet's time_domain column for the per-modality declaration). ")
NOTE_BY_ALIGNMENT = {
    "estimated_delta": (
        "The offset between the clocks is estimated but not applied or published: pen_delta_s is left "
        "NaN by design (publishing an estimated delta risks irreparable mislabeling); pen_delta_sigma "
        "is only the estimate's confidence, not the offset itself."),
    "overlap_only": (
        "Modalities were paired only because their wall-clock ranges overlap. The device clocks were "
        "not explicitly synchronised, and no offset was estimated or applied; treat sample-level "
        "cross-modal joins as approximate."),
}


def alignment_notes(clocks: DataFrame, alignment: DataFrame) -> DataFrame:
    """Warning text per recording whose tables run on several clocks.

    ``alignment``: recording_id, time_alignment.
    """
    primary = primary_clock(clocks).withColumnRenamed("time_domain", "_primary")
    other = table_clocks(clocks).join(primary, "recording_id").where(
        ~F.col("time_domain").eqNullSafe(F.col("_primary")))
    # Both sets are bounded by the number of modalities.
    named = other.groupBy("recording_id", "_primary").agg(
        F.array_join(F.array_sort(F.collect_set("modality")), ", ").alias("_m"),
        F.array_join(F.array_sort(F.collect_set(F.coalesce("time_domain", F.lit("")))), " / ").alias("_d"))
    head, rest = NOTE_DIFFERS.split("{modalities}")
    middle, rest = rest.split("{domains}")
    before, after = rest.split("{primary}")
    note = F.concat(F.lit(head), "_m", F.lit(middle), "_d", F.lit(before), "_primary", F.lit(after),
                    lookup(F.col("time_alignment"), NOTE_BY_ALIGNMENT))
    return alignment.join(named, "recording_id", "left").select(
        "recording_id", F.coalesce(note, F.lit("")).alias("alignment_note"))


# --- assembly -------------------------------------------------------------------------------------

def device_model_problems(manifest: DataFrame) -> DataFrame:
    """Violations: a table whose device is unnamed or unknown, or a device named without its table."""
    rows = []
    for column, (modality, known) in DEVICE_MODELS.items():
        there = F.coalesce(F.col(f"has_{modality}"), F.lit(False))
        model = F.coalesce(F.col(column), F.lit(""))
        reason = F.when(there & ~model.isin(*known), "unknown model").when(
            ~there & (model != ""), "model without a table")
        rows.append(F.when(reason.isNotNull(), F.struct(
            F.lit(column).alias("column"), model.alias("model"), reason.alias("reason"))))
    return manifest.select("recording_id", F.explode(F.array_compact(F.array(*rows))).alias("p")).select(
        "recording_id", "p.column", "p.model", "p.reason")


def assemble_manifest(meta: DataFrame, derived: DataFrame, clocks: DataFrame) -> DataFrame:
    """Declared facts, defaults and derived values in the published column order.

    Derived values win over declared ones.  A declared column that is neither published nor known
    to be internal is refused, so that no new fact is dropped unnoticed.
    """
    unknown = sorted(set(meta.columns) - set(MANIFEST_COLUMNS) - set(INTERNAL_META))
    if unknown:
        raise ValueError(f"unclassified manifest column(s) {unknown}: publish them or mark them internal")
    computed = {"time_domain", "alignment_note", *DERIVED_MANIFEST_COLUMNS}
    declared = meta.drop(*computed, *INTERNAL_META)
    alignment = (meta.select("recording_id", "time_alignment") if "time_alignment" in meta.columns
                 else meta.select("recording_id", F.lit("").alias("time_alignment")))
    rows = (declared.join(derived, "recording_id", "left")
            .join(primary_clock(clocks), "recording_id", "left")
            .join(alignment_notes(clocks, alignment), "recording_id", "left"))
    defaults = {**MANIFEST_DEFAULTS, **dict.fromkeys([*MODALITY_FLAGS, *CAPABILITY_FLAGS], False),
                "schema_version": SCHEMA_VERSION, "t_start_ns": 0, "t_end_ns": 0, "duration_s": 0.0,
                "n_samples_watch": 0, "n_samples_pen": 0, "n_samples_head": 0}
    columns = []
    for field in MANIFEST_SCHEMA.fields:
        value = F.col(field.name) if field.name in rows.columns else F.lit(None)
        if field.name == "source_pipeline" and field.name not in meta.columns and "pipeline" in meta.columns:
            value = F.col("pipeline")
        if field.name in defaults:
            value = F.coalesce(value, F.lit(defaults[field.name]))
        columns.append(value.cast(field.dataType).alias(field.name))
    return rows.select(*columns)


def build_manifest(tables: dict[str, DataFrame], meta: DataFrame, clocks: DataFrame,
                   withdrawn: DataFrame | None = None, rates: DataFrame | None = None) -> DataFrame:
    """The manifest of all recordings, after refusing malformed tables and declarations.  ``rates``: those of ``table_rates``, if known."""
    require_complete_vectors(tables)
    if withdrawn is not None:
        refuse(withdrawn_with_table(withdrawn, spans(tables)), "withdrawn stream still has a table")
    manifest = assemble_manifest(meta, derived_values(tables, withdrawn, rates), clocks)
    refuse(device_model_problems(manifest), "device model does not match the tables")
    return manifest


# --- channels -------------------------------------------------------------------------------------

def stored_columns(tables: dict[str, DataFrame]) -> DataFrame:
    """(recording_id, modality, column) of every stored column.

    Motion tables differ by recording, so there a column counts once it holds a value; pen, marker
    and attention tables have one fixed set of columns, filled or not.
    """
    found = []
    for name, table in tables.items():
        if name in MOTION_MODALITIES:
            rows = column_presence(table).select("recording_id", F.explode("columns").alias("column"))
        else:
            names = F.array(*[F.lit(c) for c in table.columns if c not in OWN_COLUMNS])
            rows = table.select("recording_id").distinct().select(
                "recording_id", F.explode(names).alias("column"))
        found.append(rows.select("recording_id", F.lit(name).alias("modality"), "column"))
    return union_all(found)


def describe_columns(columns: DataFrame) -> DataFrame:
    """Add quantity, unit, semantics and frame by column name; none is ever blank but ``frame``."""
    name = F.col("column")
    vector = lookup(name, {c: q for q, cols in VECTORS.items() for c in cols})
    source = name.startswith("src_")
    unit = lookup(name, {c: u for c, (u, _) in COLUMN_DESCRIPTIONS.items()})
    meaning = lookup(name, {c: s for c, (_, s) in COLUMN_DESCRIPTIONS.items()})
    return columns.withColumns({
        "quantity": F.coalesce(vector, F.when(name.isin(*NS_COLUMNS), "time").otherwise("other")),
        "unit": F.coalesce(lookup(vector, VECTOR_UNITS), F.when(source, "source_native"), unit, F.lit("n/a")),
        "semantics": F.coalesce(vector, F.when(source, "source_provenance"), meaning, F.lit("metadata")),
        "frame": F.when(vector.isNotNull(), "device").otherwise(""),
    })


def tables_without_clock(columns: DataFrame, clocks: DataFrame) -> DataFrame:
    """Violations: stored tables whose clock nobody declared."""
    named = table_clocks(clocks).where(F.coalesce(F.col("time_domain"), F.lit("")) != "")
    return columns.select("recording_id", "modality").distinct().join(
        named, ["recording_id", "modality"], "left_anti")


def build_channels(tables: dict[str, DataFrame], clocks: DataFrame,
                   factors: DataFrame | None = None, rates: DataFrame | None = None) -> DataFrame:
    """One descriptor row per stored column; declared clocks and factors override the defaults.  ``rates``: those of ``table_rates``, if known."""
    columns = stored_columns(tables)
    refuse(tables_without_clock(columns, clocks), "no clock declared for the table")
    return channel_rows(columns, rounded_rates(table_rates(tables) if rates is None else rates), clocks, factors)


def channel_rows(columns: DataFrame, rates: DataFrame, clocks: DataFrame,
                 factors: DataFrame | None = None) -> DataFrame:
    whole = table_clocks(clocks).withColumnRenamed("time_domain", "_table_clock")
    own = clocks.where(F.col("column").isNotNull()).select(
        "recording_id", "modality", "column", F.col("time_domain").alias("_own_clock"))
    rows = (describe_columns(columns).join(rates, ["recording_id", "modality"], "left")
            .join(whole, ["recording_id", "modality"], "left")
            .join(own, ["recording_id", "modality", "column"], "left")
            .withColumn("time_domain", F.coalesce("_own_clock", "_table_clock")))
    if factors is None:
        rows = rows.withColumn("unit_conversion_factor", F.lit(1.0))
    else:
        rows = rows.join(factors, ["recording_id", "modality", "column"], "left").withColumn(
            "unit_conversion_factor", F.coalesce("unit_conversion_factor", F.lit(1.0)))
    return rows.select(*CHANNEL_COLUMNS)


