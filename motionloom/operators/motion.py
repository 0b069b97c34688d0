"""Regular sensor streams: rates, norms, stillness, gravity."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import columns_of, gravity_from_quaternion, norm, norm_of
from ..vocabulary import (DEFAULT_STILL_RATE_HZ, GRAVITY_NORM_BAND, GRAVITY_NORM_MAX_IQR,
                          GRAVITY_SI_NORM_THRESHOLD, MIN_PHYSICS_ROWS, STANDARD_GRAVITY,
                          STILL_THRESHOLD, STILL_WINDOW_S, VECTORS)
from .layout import along, attach, durable, last_seen, next_seen, numbered, ordered, previous
from .quantile import quantiles

KEY = ("recording_id",)


def time_steps(motion: DataFrame, key: tuple[str, ...] = KEY, split: bool | None = None) -> DataFrame:
    """(key, step_ns, backward), written out: time since the sample before, and whether time fell since the sample that arrived before.

    Both orders share one exchange; only if a recording has to be cut, rows are laid out once for each order, and a row holds one of the two.
    """
    narrow = motion.select(*key, "t_ns", "seq")
    timed = along(ordered(narrow, key, split=split), _prev=previous(F.col("t_ns")))
    step, back = (F.col("t_ns") - F.col("_prev")).alias("step_ns"), (F.col("t_ns") < F.col("_came")).alias("backward")
    if not timed.split:
        return durable(along(timed.having(timed.rows, ("seq",)), _came=previous(F.col("t_ns"))).frame.select(*key, step, back))
    arrived = along(ordered(narrow, key, ("seq",)), _came=previous(F.col("t_ns"))).frame
    return durable(timed.frame.select(*key, step, F.lit(None).cast("boolean").alias("backward")).unionByName(
        arrived.select(*key, F.lit(None).cast("bigint").alias("step_ns"), back)))


def median_rate_hz(motion: DataFrame, name: str = "rate_hz", key: tuple[str, ...] = KEY,
                   split: bool | None = None, steps: DataFrame | None = None) -> DataFrame:
    """1e9 over the median positive time step; recordings without one are left out.

    ``steps`` are those of :func:`time_steps` where they are there already.
    """
    if steps is None:
        layout = along(ordered(motion.select(*key, "t_ns", "seq"), key, split=split), _prev=previous(F.col("t_ns")))
        steps = durable(layout.frame.select(*key, (F.col("t_ns") - F.col("_prev")).alias("step_ns")))
    steps = steps.where("step_ns > 0")
    return quantiles(steps, list(key), "step_ns", median=0.5).select(
        *key, (F.lit(1e9) / F.col("median")).alias(name))


def backward_steps(motion: DataFrame, key: tuple[str, ...] = KEY, split: bool | None = None) -> DataFrame:
    """Number of samples whose time lies before the sample that arrived just before them."""
    arrived = along(ordered(motion.select(*key, "t_ns", "seq"), key, ("seq",), split),
                    _prev=previous(F.col("t_ns"))).frame
    return arrived.groupBy(*key).agg(F.count_if(F.col("t_ns") < F.col("_prev")).alias("backward_steps"))


def table_span(table: DataFrame, key: tuple[str, ...] = KEY) -> DataFrame:
    """First and last instant of one table per recording; interval tables use both their ends."""
    start, end = (("t_start_ns", "t_end_ns") if "t_start_ns" in table.columns else ("t_ns", "t_ns"))
    return table.groupBy(*key).agg(F.min(start).alias("t_start_ns"), F.max(end).alias("t_end_ns"),
                                   F.count("*").alias("n_samples"))


def norms(table: DataFrame, quantities: list[str], key: tuple[str, ...] = KEY) -> DataFrame:
    """Long table (key, quantity, norm) of the vectors named, from one scan."""
    entries = [F.struct(F.lit(q).alias("quantity"), norm_of(q).alias("norm"))
               for q in quantities]
    return table.select(*key, F.inline(F.array(*entries)))


def norm_stats(table: DataFrame, quantities: list[str], key: tuple[str, ...] = KEY) -> DataFrame:
    """Median, p05, p95, IQR, mean, population deviation and count of vector lengths.

    One row per key and quantity.  Rows with a non-finite component are ignored; with none left the
    statistics are NULL and the count 0.
    """
    long = norms(table, quantities, key)
    by = [*key, "quantity"]
    plain = long.groupBy(*by).agg(F.avg("norm").alias("mean"), F.stddev_pop("norm").alias("std"),
                                  F.count("norm").alias("n"))
    ranked = quantiles(long, by, "norm", median=0.5, p05=0.05, p95=0.95, q25=0.25, q75=0.75)
    return plain.join(ranked.drop("n"), by, "left").select(
        *by, "median", "p05", "p95", (F.col("q75") - F.col("q25")).alias("iqr"), "mean", "std", "n")


def still(motion: DataFrame, rate: DataFrame | float, *, window_s: float = STILL_WINDOW_S,
          threshold: float = STILL_THRESHOLD, name: str = "still",
          key: tuple[str, ...] = KEY, split: bool | None = None) -> DataFrame:
    """Flag samples whose centred window of angular speed stays below the threshold.

    ``rate`` is one rate or a table (key, rate_hz); recordings without one use 100 Hz.  The
    window holds ``round(window_s * rate)`` rows, so it differs by recording.  Instead of a frame,
    the nearest fast sample on either side is located: the window is still if both lie outside it.
    Samples without a norm are skipped, and a window holding none at all is not still.
    """
    if not isinstance(rate, DataFrame):
        rows = motion.withColumn("_rate", F.lit(float(rate)))
    else:
        rows = attach(motion, rate.select(*key, F.col("rate_hz").alias("_rate")), list(key), costly=True)
    window = F.greatest(F.rint(F.lit(window_s) * F.coalesce(F.col("_rate"), F.lit(DEFAULT_STILL_RATE_HZ)))
                        .cast("bigint"), F.lit(1))
    back = F.floor(window / 2)
    ahead = F.floor((window - 1) / 2)
    speed = norm_of("gyro")
    layout = numbered(ordered(rows, key, split=split), "_row")
    layout = layout.having(layout.rows.withColumn("_speed", speed))
    known = F.when(F.col("_speed").isNotNull(), F.col("_row"))
    fast = F.when(F.col("_speed") >= threshold, F.col("_row"))
    near = along(layout, _fast_before=last_seen(fast), _fast_after=next_seen(fast),
                 _known_before=last_seen(known), _known_after=next_seen(known)).frame
    row = F.col("_row")
    clear = (F.coalesce(row - F.col("_fast_before") > back, F.lit(True))
             & F.coalesce(F.col("_fast_after") - row > ahead, F.lit(True)))
    seen = (F.coalesce(row - F.col("_known_before") <= back, F.lit(False))
            | F.coalesce(F.col("_known_after") - row <= ahead, F.lit(False)))
    return near.withColumn(name, clear & seen).select(*motion.columns, name)


def still_bias(motion: DataFrame, rate: DataFrame | float) -> DataFrame:
    """Mean acceleration norm minus 1 g over still samples; NULL below 100 of them."""
    flagged = still(motion, rate).where("still")
    size = norm(columns_of("accel_total"))
    return motion.select("recording_id").distinct().join(
        flagged.groupBy("recording_id").agg(F.count("*").alias("n"), F.avg(size).alias("m")),
        "recording_id", "left").select(
        "recording_id", F.when(F.col("n") >= MIN_PHYSICS_ROWS, F.bround(F.col("m") - 1.0, 6))
        .alias("accel_still_bias"))


def gravity_lookalikes(stats: DataFrame) -> DataFrame:
    """Violations: streams declared as angular rate whose norm behaves like a gravity vector."""
    return stats.where((F.col("quantity") == "gyro") & F.col("median").between(*GRAVITY_NORM_BAND)
                       & (F.col("iqr") < GRAVITY_NORM_MAX_IQR))


def gravity_factor(motion: DataFrame) -> DataFrame:
    """Per recording: 1/g if the median gravity norm shows m/s2, else 1."""
    long = norms(motion, ["gravity"])
    median = quantiles(long, ["recording_id"], "norm", median=0.5)
    return median.select("recording_id", "median", F.when(
        F.col("median") > GRAVITY_SI_NORM_THRESHOLD, F.lit(1.0 / STANDARD_GRAVITY))
        .otherwise(F.lit(1.0)).alias("gravity_factor"))


def harmonise_gravity(motion: DataFrame) -> DataFrame:
    """Gravity columns in g, whichever unit each recording used, plus the factor applied."""
    rows = attach(motion, gravity_factor(motion).select("recording_id", "gravity_factor"), ["recording_id"], costly=True)
    si = F.col("gravity_factor") != 1.0
    return rows.withColumns({c: F.when(si, F.col(c) / F.lit(STANDARD_GRAVITY)).otherwise(F.col(c))
                             for c in VECTORS["gravity"]})


def scale_acceleration(motion: DataFrame, standardisation: DataFrame, quantity: str) -> DataFrame:
    """Acceleration in g: recordings flagged as standardised hold m/s2 and are divided.

    ``standardisation``: recording_id, standardisation (text flag of the source).
    """
    si = F.lower(F.trim(F.col("standardisation").cast("string"))) == "true"
    factors = standardisation.select("recording_id", F.when(si, F.lit(1.0 / STANDARD_GRAVITY))
                                     .otherwise(F.lit(1.0)).alias("accel_factor"))
    rows = attach(motion, factors, ["recording_id"])
    return rows.withColumns({c: F.col(c) * F.col("accel_factor") for c in VECTORS[quantity]})


def _present(quantity: str) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in VECTORS[quantity]])


#: What each step needs, and what to say of a recording or table that lacks it.
_DERIVATION = (("accel_total", "neither kind of acceleration is there"), ("quat", "no attitude quaternion to take gravity from"))


def _lacks(held, true, otherwise):
    """The reason why user acceleration is neither there nor derivable; ``held`` tells whether a quantity is complete."""
    reason = None
    for quantity, why in reversed(_DERIVATION):
        reason = otherwise(~held(quantity), why, reason)
    return otherwise(held("accel_user"), true, reason)


def user_acceleration_problems(presence: DataFrame) -> DataFrame:
    """Violations among recordings of ``column_presence``: nothing to derive acceleration from."""
    def held(q):
        return reduce(and_, [F.array_contains("columns", c) for c in VECTORS[q]])
    reason = _lacks(held, F.lit(None).cast("string"),
                    lambda test, this, other: F.when(test, this).otherwise(F.lit(None).cast("string") if other is None else other))
    return presence.select("recording_id", reason.alias("reason")).where("reason IS NOT NULL")


def zero_attitudes(motion: DataFrame) -> DataFrame:
    """Violations: recordings with quaternions of length zero, which stand for no attitude, and how many."""
    x, y, z, w = columns_of("quat")
    return motion.where(x * x + y * y + z * z + w * w == 0).groupBy("recording_id").agg(F.count("*").alias("rows"))


def to_user_acceleration(motion: DataFrame) -> DataFrame:
    """Replace ``accel_total_*`` by ``accel_user_*``; rows that already hold the latter keep it.

    Tables without the columns for it and quaternions of length zero where they are needed are refused.
    """
    have = set(motion.columns)
    complete = {q: set(VECTORS[q]) <= have for q in ("accel_user", "accel_total", "quat")}
    if complete["accel_user"] and not complete["accel_total"]:
        return motion
    for quantity, why in _DERIVATION:
        if not complete[quantity]:
            raise ValueError(f"{why}: columns {', '.join(VECTORS[quantity])} are missing")
    needed = motion.where(_present("accel_total") & ~(_present("accel_user") if complete["accel_user"] else F.lit(False)))
    if zero := zero_attitudes(needed).take(5):
        raise ValueError("quaternions of length zero: " + ", ".join(f"{r['recording_id']} ({r['rows']} rows)" for r in zero))
    gravity = gravity_from_quaternion(columns_of("quat"))
    derived = {}
    for user, total, g in zip(VECTORS["accel_user"], VECTORS["accel_total"], gravity):
        kept = F.when(_present("accel_user"), F.col(user)) if user in have else F.lit(None)
        derived[user] = F.coalesce(kept, F.col(total) - g)
    return motion.withColumns(derived).drop(*VECTORS["accel_total"])


def column_presence(table: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Columns each recording really carries, as a sorted array.

    All recordings share one table here, so a column a recording lacks is NULL in all its rows.
    """
    names = columns or [c for c in table.columns if c not in ("recording_id", "seq")]
    counted = table.groupBy("recording_id").agg(*[F.count(c).alias(c) for c in names])
    held = F.array(*[F.when(F.col(c) > 0, F.lit(c)) for c in names])
    return counted.select("recording_id", F.array_sort(F.array_compact(held)).alias("columns"))


def partial_vectors(presence: DataFrame) -> DataFrame:
    """Violations: vectors of which a recording carries some components but not all."""
    rows = []
    for quantity, columns in VECTORS.items():
        found = F.size(F.array_intersect("columns", F.array(*[F.lit(c) for c in columns])))
        missing = F.array_join(F.array_sort(F.array_except(
            F.array(*[F.lit(c) for c in columns]), F.col("columns"))), ", ")
        rows.append(F.when((found > 0) & (found < len(columns)),
                           F.struct(F.lit(quantity).alias("quantity"), missing.alias("missing"))))
    return presence.select("recording_id", F.explode(F.array_compact(F.array(*rows))).alias("p")).select(
        "recording_id", "p.quantity", "p.missing")


def with_presence_columns(table: DataFrame, quantity: str) -> DataFrame:
    """``table`` with NULL columns added for a vector its schema lacks."""
    return table.withColumns({c: F.lit(None).cast("double") for c in VECTORS[quantity]
                              if c not in table.columns})
