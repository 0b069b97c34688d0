"""Ground truth joins, gap closing and pen strokes."""

from __future__ import annotations

from pyspark.sql import functions as F

from motionloom.operators import labels as L
from motionloom.operators import pen as P
from motionloom.operators.containment import covered_by
from motionloom.operators.motion import table_span
from motionloom.plans.label import label_record

from .projections import (DAY_NS, GAP_S, TOLERANCE_S, as_int, attention, markers, motion, nested, pen, query,
                          read, rounded)

TOL_NS = int(TOLERANCE_S * 1e9)
GAP_NS = int(GAP_S * 1e9)


def contact_sql(tolerance_ns: int, shift_ns: int = 0) -> str:
    """SQL of the nearest-event rule, as further common table expressions ending in ``contact``."""
    return f"""near AS (
        SELECT m.recording_id, m.seq, p.dot_type, row_number() OVER (PARTITION BY m.recording_id, m.seq ORDER BY
            abs(p.t_ns + {shift_ns}::BIGINT - m.t_ns), p.t_ns + {shift_ns}::BIGINT >= m.t_ns,
            CASE WHEN p.t_ns + {shift_ns}::BIGINT >= m.t_ns THEN p.seq ELSE -p.seq END) AS rn
        FROM motion m JOIN pen p ON m.recording_id = p.recording_id
            AND abs(p.t_ns + {shift_ns}::BIGINT - m.t_ns) <= {tolerance_ns}::BIGINT),
    contact AS (SELECT m.recording_id, m.seq, m.t_ns,
        CASE WHEN n.dot_type IN ('PEN_DOWN', 'PEN_MOVE') THEN 1 ELSE 0 END AS label_writing
        FROM motion m LEFT JOIN near n ON m.recording_id = n.recording_id AND m.seq = n.seq AND n.rn = 1)"""


def gaps_sql(source: str, gap_ns: int) -> str:
    """SQL of gap closing over ``source`` (recording_id, t_ns, seq, label_writing), ending in ``closed``."""
    return f"""changes AS (SELECT *, CASE WHEN label_writing <> lag(label_writing) OVER w THEN 1 ELSE 0 END AS c
        FROM {source} WINDOW w AS (PARTITION BY recording_id ORDER BY t_ns, seq)),
    runs AS (SELECT *, sum(c) OVER (PARTITION BY recording_id ORDER BY t_ns, seq) AS run FROM changes),
    spans AS (SELECT recording_id, run, max(t_ns) - min(t_ns) AS span,
        max(run) OVER (PARTITION BY recording_id) AS last_run FROM runs GROUP BY recording_id, run),
    closed AS (SELECT r.recording_id, r.seq, CASE WHEN r.label_writing = 0 AND r.run > 0 AND r.run < s.last_run
        AND s.span <= {gap_ns}::BIGINT THEN 1 ELSE r.label_writing END AS label_writing
        FROM runs r JOIN spans s ON r.recording_id = s.recording_id AND r.run = s.run)"""


PICK = "SELECT recording_id, seq, label_writing FROM "


@query(f"WITH {contact_sql(TOL_NS)} {PICK} contact", "motion", "pen")
def contact_labels(spark, sf):
    labelled = L.contact_labels(motion(spark, sf), pen(spark, sf), tolerance_s=TOLERANCE_S)
    return as_int(labelled, "label_writing").select("recording_id", "seq", "label_writing")


@query(f"WITH {contact_sql(TOL_NS, -2 * TOL_NS)} {PICK} contact", "motion", "pen")
def contact_labels_shifted(spark, sf):
    labelled = L.contact_labels(motion(spark, sf), pen(spark, sf), tolerance_s=TOLERANCE_S,
                                pen_shift_s=-2 * TOLERANCE_S)
    return as_int(labelled, "label_writing").select("recording_id", "seq", "label_writing")


_DAYS = f"""WITH m AS (SELECT recording_id, seq, t_ns // {DAY_NS} * {DAY_NS} AS t_ns FROM motion),
    p AS (SELECT recording_id, seq, dot_type, t_ns // {DAY_NS} * {DAY_NS} AS t_ns FROM pen), """


@query(_DAYS + contact_sql(0).replace("FROM motion m", "FROM m").replace("JOIN pen p", "JOIN p")
       + PICK + "contact", "motion", "pen")
def contact_labels_tied(spark, sf):
    """Whole days as times and no tolerance: nothing but ties."""
    def daily(df):
        return df.withColumn("t_ns", F.col("t_ns") - F.pmod(F.col("t_ns"), F.lit(DAY_NS)))
    labelled = L.contact_labels(daily(motion(spark, sf)), daily(pen(spark, sf)), tolerance_s=0.0)
    return as_int(labelled, "label_writing").select("recording_id", "seq", "label_writing")


@query(f"""WITH marked AS (SELECT recording_id, seq, t_ns, CASE WHEN v > 60 THEN 1 ELSE 0 END AS label_writing
    FROM motion), {gaps_sql('marked', 6 * GAP_NS)} {PICK} closed""", "motion")
def close_gaps(spark, sf):
    marked = motion(spark, sf).withColumn("label_writing", (F.col("v") > 60).cast("tinyint"))
    closed = L.close_gaps(marked, gap_closing_s=6 * GAP_S)
    return as_int(closed, "label_writing").select("recording_id", "seq", "label_writing")


@query(f"WITH {contact_sql(TOL_NS)}, {gaps_sql('contact', GAP_NS)} {PICK} closed", "motion", "pen")
def writing_labels(spark, sf):
    labelled = L.writing_labels(motion(spark, sf), pen(spark, sf), gap_closing_s=GAP_S, tolerance_s=TOLERANCE_S)
    return as_int(labelled, "label_writing").select("recording_id", "seq", "label_writing")


@query(f"""WITH {contact_sql(TOL_NS)}, {gaps_sql('contact', GAP_NS)} SELECT recording_id, count(*) AS n_samples,
    round_even(avg(label_writing), 4) AS labelled_share FROM closed GROUP BY recording_id""", "motion", "pen")
def labelled_share(spark, sf):
    labelled = L.writing_labels(motion(spark, sf), pen(spark, sf), gap_closing_s=GAP_S, tolerance_s=TOLERANCE_S)
    return label_record(labelled, "writing")


@query("""SELECT m.recording_id, m.seq, arg_max(a.label, a.seq) AS label_attention FROM motion m
    LEFT JOIN attention a ON m.recording_id = a.recording_id AND m.t_ns >= a.t_start_ns AND m.t_ns < a.t_end_ns
    GROUP BY m.recording_id, m.seq""", "motion", "attention")
def attention_labels(spark, sf):
    return L.attention_labels(motion(spark, sf), attention(spark, sf)).select("recording_id", "seq", "label_attention")


@query("""SELECT m.recording_id, m.seq, arg_max(a.label, a.seq) AS label_attention FROM motion m
    LEFT JOIN nested a ON m.recording_id = a.recording_id AND m.t_ns >= a.t_start_ns AND m.t_ns < a.t_end_ns
    GROUP BY m.recording_id, m.seq""", "motion", "nested")
def attention_labels_overlapping(spark, sf):
    """Overlapping intervals: the later one wins."""
    return L.attention_labels(motion(spark, sf), nested(spark, sf)).select("recording_id", "seq", "label_attention")


@query("""WITH expanded AS (SELECT m.recording_id, m.seq, arg_max(a.label, a.seq) AS label FROM motion m
    LEFT JOIN nested a ON m.recording_id = a.recording_id AND m.t_ns >= a.t_start_ns AND m.t_ns <= a.t_end_ns
    GROUP BY m.recording_id, m.seq)
    SELECT recording_id, round(avg(CASE WHEN label = 'label' || seq % 3 THEN 1.0 ELSE 0.0 END), 6) AS agreement
    FROM expanded GROUP BY recording_id""", "motion", "nested")
def expansion_agreement(spark, sf):
    own = motion(spark, sf).withColumn("own", F.concat(F.lit("label"), (F.col("seq") % 3).cast("string")))
    return rounded(L.expansion_agreement(own, nested(spark, sf), "own"), "agreement")


BLOCKS_SQL = """blocks AS (SELECT 'C' || conv_id AS recording_id, turn AS seq, turn * 10.25::DOUBLE AS start_s,
        (turn + 1) * 10.25::DOUBLE AS end_s, CASE WHEN turn % 3 = 0 THEN 'focused' ELSE 'distracted' END AS label,
        role AS activity FROM conversations),
    span AS (SELECT recording_id, t_start_ns, t_start_ns + (last + 1) * 6000000000::BIGINT AS t_end_ns FROM (
        SELECT 'C' || conv_id AS recording_id, conv_id * 7000000000::BIGINT AS t_start_ns, max(turn) AS last
        FROM conversations GROUP BY conv_id))"""


def _blocks(spark, sf):
    return read(spark, sf, "conversations").select(
        F.concat(F.lit("C"), F.col("conv_id").cast("string")).alias("recording_id"), F.col("turn").alias("seq"),
        (F.col("turn") * 10.25).alias("start_s"), ((F.col("turn") + 1) * 10.25).alias("end_s"),
        F.when(F.col("turn") % 3 == 0, "focused").otherwise("distracted").alias("label"),
        F.col("role").alias("activity"))


def _span(spark, sf):
    start = F.col("conv_id") * F.lit(7_000_000_000)
    return read(spark, sf, "conversations").groupBy("conv_id").agg(F.max("turn").alias("last")).select(
        F.concat(F.lit("C"), F.col("conv_id").cast("string")).alias("recording_id"), start.alias("t_start_ns"),
        (start + (F.col("last") + 1) * F.lit(6_000_000_000)).alias("t_end_ns"))


_ANCHORED = f"""WITH {BLOCKS_SQL}, placed AS (SELECT b.*, s.t_end_ns AS t1,
        s.t_start_ns + CAST(round_even(b.start_s * 1e9, 0) AS BIGINT) AS t_start_ns
        FROM blocks b JOIN span s USING (recording_id)),
    anchored AS (SELECT recording_id, seq, t_start_ns, coalesce(lead(t_start_ns) OVER (PARTITION BY recording_id
        ORDER BY seq), t1) AS t_end_ns, label, activity FROM placed) """


@query(_ANCHORED + "SELECT * FROM anchored")
def anchored_intervals(spark, sf):
    return L.anchored_intervals(_blocks(spark, sf), _span(spark, sf))


@query(_ANCHORED + "SELECT recording_id, seq FROM anchored WHERE t_start_ns > t_end_ns")
def inverted_intervals(spark, sf):
    return L.inverted_intervals(L.anchored_intervals(_blocks(spark, sf), _span(spark, sf))).select("recording_id", "seq")


_MERGED = f"""WITH {BLOCKS_SQL}, heads AS (SELECT *, lag(label) OVER (PARTITION BY recording_id ORDER BY seq) AS prev
        FROM blocks),
    merged AS (SELECT recording_id, row_number() OVER (PARTITION BY recording_id ORDER BY seq) - 1 AS position,
        start_s AS block_start_s, label AS block_label FROM heads WHERE prev IS NULL OR prev <> label),
    stated AS (SELECT recording_id, row_number() OVER (PARTITION BY recording_id ORDER BY seq) - 1 AS position,
        start_s + (CASE WHEN seq % 4 = 1 THEN 0.75 ELSE 0.25 END)::DOUBLE AS truth_start_s,
        label AS truth_label FROM blocks WHERE seq % 3 <> 2) """


@query(_MERGED + """SELECT recording_id, position, block_start_s, block_label, truth_start_s, truth_label
    FROM merged FULL JOIN stated USING (recording_id, position)
    WHERE NOT coalesce(abs(block_start_s - truth_start_s) <= 0.5 AND block_label = truth_label, FALSE)""")
def block_disagreements(spark, sf):
    blocks = _blocks(spark, sf)
    truth = blocks.where("seq % 3 <> 2").withColumn(
        "start_s", F.col("start_s") + F.when(F.col("seq") % 4 == 1, 0.75).otherwise(0.25))
    return L.block_disagreements(blocks, truth)


@query(f"""WITH {BLOCKS_SQL}, total AS (SELECT recording_id, arg_max(end_s, seq) AS total_s FROM blocks
    GROUP BY recording_id) SELECT recording_id, round((t_end_ns - t_start_ns) / 1e9 - total_s, 6) AS tail_s
    FROM span JOIN total USING (recording_id)""")
def protocol_tail(spark, sf):
    return rounded(L.protocol_tail(_span(spark, sf), _blocks(spark, sf)), "tail_s")


# --- pen ----------------------------------------------------------------------------------------------

STROKES_SQL = """strokes AS (SELECT *, sum(CASE WHEN dot_type = 'PEN_DOWN' THEN 1 ELSE 0 END) OVER (
        PARTITION BY recording_id ORDER BY t_ns, seq) AS stroke FROM pen)"""


@query(f"WITH {STROKES_SQL} SELECT recording_id, seq, CAST(stroke AS BIGINT) AS stroke FROM strokes", "pen")
def stroke_numbers(spark, sf):
    return P.strokes(pen(spark, sf)).select("recording_id", "seq", "stroke")


@query(f"""WITH {STROKES_SQL}, timed AS (SELECT recording_id, (max(t_ns) - min(t_ns)) / 1e9 AS span_s,
        count(*) - 1 AS steps FROM strokes GROUP BY recording_id, stroke)
    SELECT recording_id, round(sum(steps) / sum(span_s), 3) AS stroke_hz FROM timed WHERE span_s > 0
    GROUP BY recording_id""", "pen")
def stroke_rate(spark, sf):
    return P.stroke_rate(pen(spark, sf))


_DAILY_PEN = f"""daily AS (SELECT recording_id, seq, dot_type, src_timestamp, t_ns // {DAY_NS} * {DAY_NS} AS t_ns FROM pen)"""


def _daily_pen(spark, sf):
    return pen(spark, sf).withColumn("t_ns", F.col("t_ns") - F.pmod(F.col("t_ns"), F.lit(DAY_NS)))


@query(f"""WITH {_DAILY_PEN}, gaps AS (SELECT recording_id, CASE WHEN dot_type <> 'PEN_DOWN' THEN t_ns - lag(t_ns)
        OVER (PARTITION BY recording_id ORDER BY t_ns, seq) END AS gap FROM daily)
    SELECT recording_id, round(avg(CASE WHEN gap = 0 THEN 1.0 WHEN gap IS NOT NULL THEN 0.0 END), 6) AS batched_share
    FROM gaps GROUP BY recording_id""", "pen")
def batched_share(spark, sf):
    return rounded(P.batched_share(_daily_pen(spark, sf)), "batched_share")


@query(f"""WITH {_DAILY_PEN}, seen AS (SELECT *, sum(CASE WHEN dot_type = 'PEN_DOWN' THEN 1 ELSE 0 END) OVER w AS stroke,
        CASE WHEN dot_type <> 'PEN_DOWN' THEN t_ns - lag(t_ns) OVER w END AS gap FROM daily
        WINDOW w AS (PARTITION BY recording_id ORDER BY t_ns, seq)),
    facts AS (SELECT recording_id, count(src_timestamp) AS logged,
        avg(CASE WHEN gap = 0 THEN 1.0 WHEN gap IS NOT NULL THEN 0.0 END) AS batched FROM seen GROUP BY recording_id),
    on_time AS (SELECT recording_id, round(sum(n) / sum(s), 3) AS hz FROM (SELECT recording_id, count(*) - 1 AS n,
        (max(t_ns) - min(t_ns)) / 1e9 AS s FROM seen GROUP BY recording_id, stroke) WHERE s > 0 GROUP BY recording_id),
    on_pen AS (SELECT recording_id, round(sum(n) / sum(s), 3) AS hz FROM (SELECT recording_id, count(*) - 1 AS n,
        (max(src_timestamp) - min(src_timestamp)) / 1e3 AS s FROM seen WHERE src_timestamp IS NOT NULL
        GROUP BY recording_id, stroke) WHERE s > 0 GROUP BY recording_id),
    rated AS (SELECT f.recording_id, logged, CASE WHEN logged > 0 THEN p.hz WHEN batched <= 0.2 THEN t.hz END AS hz
        FROM facts f LEFT JOIN on_time t USING (recording_id) LEFT JOIN on_pen p USING (recording_id))
    SELECT recording_id, hz AS pen_hz_measured, CASE WHEN hz IS NULL THEN '' WHEN logged > 0 THEN 'src_timestamp'
        ELSE 't_ns' END AS pen_hz_clock FROM rated""", "pen")
def dot_rate(spark, sf):
    return P.dot_rate(_daily_pen(spark, sf))


@query("""SELECT m.recording_id, m.seq, n.label FROM markers m LEFT JOIN (SELECT recording_id, min(t_ns) AS lo,
    max(t_ns) AS hi, max(event) AS label FROM markers GROUP BY recording_id) n
    ON m.recording_id = n.recording_id AND m.t_ns >= n.lo AND m.t_ns < n.hi""", "markers")
def instants_in_spans(spark, sf):
    """The containment join under attention labels, on markers against their recording's own span."""
    rows = markers(spark, sf)
    label = rows.groupBy("recording_id").agg(F.max("event").alias("label"))
    spans = table_span(rows).join(label, "recording_id").withColumn("seq", F.lit(0))
    return covered_by(rows.drop("event"), spans, ["label"]).select("recording_id", "seq", "label")
