"""Decimation to a common rate with a zero-phase anti-alias filter."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clock import ceil_div
from ..vocabulary import DECIMATION_RATIO_TOLERANCE, FILTERED_VECTORS, VECTORS
from .layout import attach, durable, numbered, ordered, rows_per_task

ORDER, RIPPLE_DB = 8, 0.05        # Chebyshev type I, cut off at 0.8 of the new Nyquist rate
EDGE = 3 * (ORDER + 1)            # samples mirrored around each end of a recording
BLOCK_ROWS = 65_536
STEP, SCANNED = 64, 1024          # samples of one matrix step; borders that one task scans


def decimation_factors(rates: DataFrame, target_hz: float, source: str = "rate_hz") -> DataFrame:
    """Add ``factor``, the whole ratio to the target rate; NULL where the ratio is not whole.

    A ratio within 5 % of a whole number counts as that number; below one means upsampling.
    """
    if target_hz <= 0:
        raise ValueError(f"target_hz must be positive, got {target_hz}")
    ratio = F.col(source) / F.lit(float(target_hz))
    whole = F.rint(ratio)
    fits = (whole >= 1) & (F.abs(ratio - whole) <= F.lit(DECIMATION_RATIO_TOLERANCE) * whole)
    return rates.withColumn("factor", F.when(fits, whole.cast("int")))


def require_factors(factors: DataFrame, target_hz: float, source: str = "rate_hz") -> None:
    bad = factors.where("factor IS NULL").orderBy("recording_id").take(5)
    if bad:
        shown = ", ".join(f"{r['recording_id']} ({r[source]} Hz)" for r in bad)
        raise ValueError(f"cannot downsample to {target_hz:g} Hz, the ratio is not an integer "
                         f"(upsampling is not supported): {shown}")


def decimated_count(count, factor):
    """Rows left of ``count`` after keeping every ``factor``-th."""
    return ceil_div(count, factor)


@lru_cache(maxsize=64)
def poles_and_gain(factor: int) -> tuple[np.ndarray, float]:
    """The digital anti-alias filter: poles, of which each stands with its conjugate, and gain; all zeros lie at -1."""
    epsilon = np.sqrt(10 ** (RIPPLE_DB / 10) - 1)
    angles = np.pi * np.arange(-ORDER + 1, ORDER, 2) / (2 * ORDER)
    analog = -np.sinh(np.arcsinh(1 / epsilon) / ORDER + 1j * angles)
    gain = np.prod(-analog).real / np.sqrt(1 + epsilon ** 2)
    warped = 4 * np.tan(np.pi * (0.8 / factor) / 2)
    analog, gain = analog * warped, gain * warped ** ORDER
    return (4 + analog) / (4 - analog), gain * (1 / np.prod(4 - analog)).real


def impulse_response(factor: int) -> np.ndarray:
    """Impulse response of the anti-alias filter, up to where it vanishes in DOUBLE precision."""
    poles, gain = poles_and_gain(factor)
    length = int(np.ceil(np.log(1e-18) / np.log(np.abs(poles).max()))) + ORDER
    response = np.zeros(length)
    response[: ORDER + 1] = gain * np.poly(np.full(ORDER, -1.0))
    for pole in poles[poles.imag > 0]:  # one second-order section per conjugate pair
        b1, b2 = 2 * pole.real, -abs(pole) ** 2
        for i in range(1, length):
            response[i] += b1 * response[i - 1] + (b2 * response[i - 2] if i > 1 else 0.0)
    return response


@dataclass(frozen=True)
class Recursion:
    """The filter as a map of its state: state = a @ state + b * x, y = c @ state + d * x.

    ``spread`` and ``seen`` turn a step of STEP samples and the state before it into the step's outputs, ``taken`` adds up what the
    samples leave in the state, ``powers[k]`` is the k-th power of ``a``, and ``settled`` is the state after a constant one.
    """

    a: np.ndarray
    spread: np.ndarray
    seen: np.ndarray
    taken: np.ndarray
    powers: np.ndarray
    settled: np.ndarray

    def run(self, x: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Outputs of ``x`` (samples, channels) from ``state`` (ORDER, channels), and the state after them."""
        whole = len(x) // STEP
        body = x[:whole * STEP].reshape(whole, STEP, x.shape[1])
        left = np.einsum("oi,kic->koc", self.taken, body)
        before = np.empty((whole, ORDER, x.shape[1]))
        for k in range(whole):
            before[k] = state
            state = self.powers[STEP] @ state + left[k]
        y = np.matmul(self.spread, body) + np.matmul(self.seen, before)
        rest = x[whole * STEP:]
        n = len(rest)
        tail = self.spread[:n, :n] @ rest + self.seen[:n] @ state
        return np.concatenate([y.reshape(-1, x.shape[1]), tail]), self.after(state, n) + self.taken[:, STEP - n:] @ rest

    def after(self, state: np.ndarray, n: int) -> np.ndarray:
        """``state`` after ``n`` samples of zero."""
        return (self.powers[n] if n <= STEP else np.linalg.matrix_power(self.a, n)) @ state


@lru_cache(maxsize=64)
def recursion(factor: int) -> Recursion:
    """Second-order sections one after another, two states each."""
    poles, gain = poles_and_gain(factor)
    pairs = poles[poles.imag > 0]

    def step(state: np.ndarray, x: float) -> tuple[np.ndarray, float]:
        out, x = np.empty(ORDER), gain * x
        for k, pole in enumerate(pairs):
            y = x + state[2 * k]
            out[2 * k] = 2 * x + 2 * pole.real * y + state[2 * k + 1]
            out[2 * k + 1] = x - abs(pole) ** 2 * y
            x = y
        return out, x

    moved = [step(row, 0.0) for row in np.eye(ORDER)]
    b, d = step(np.zeros(ORDER), 1.0)
    a, c = np.array([m[0] for m in moved]).T, np.array([m[1] for m in moved])
    powers = np.array([np.linalg.matrix_power(a, k) for k in range(STEP + 1)])
    response = np.array([d, *(c @ powers[k] @ b for k in range(STEP - 1))])
    spread = np.array([[response[i - j] if i >= j else 0.0 for j in range(STEP)] for i in range(STEP)])
    taken = np.array([powers[STEP - 1 - j] @ b for j in range(STEP)]).T
    return Recursion(a, spread, powers[:STEP].transpose(0, 2, 1) @ c, taken, powers, np.linalg.solve(np.eye(ORDER) - a, b))


def _mirrored(x: np.ndarray, at_start: bool, at_end: bool) -> np.ndarray:
    """``x`` (samples, channels) continued at the ends of a recording, mirrored through the last value there."""
    head = 2 * x[0] - x[EDGE:0:-1] if at_start else x[:0]
    tail = 2 * x[-1] - x[-2:-EDGE - 2:-1] if at_end else x[:0]
    return np.concatenate([head, x, tail])


def zero_phase(values: np.ndarray, factor: int, at_start: bool = True, at_end: bool = True) -> np.ndarray:
    """Filter forwards and backwards, from states settled on the value that each direction starts with.

    At an end of the recording the signal is mirrored through its last value; elsewhere it starts as it is.
    """
    filtering = recursion(factor)
    x = _mirrored(values[:, None], at_start, at_end)
    forward, _ = filtering.run(x, np.outer(filtering.settled, x[0]))
    backward, _ = filtering.run(forward[::-1], np.outer(filtering.settled, forward[-1]))
    first = EDGE if at_start else 0
    return backward[::-1][first:first + len(values), 0]


# --- states at the borders of blocks ----------------------------------------------------------------

def _signal(table: pa.Table, columns: list[str]) -> tuple[np.ndarray, int, bool, bool]:
    """Samples of one block with mirrored ends (a column without values: zeros), its factor, and whether it is first and last."""
    at = table["_row"].to_numpy()
    factor, total = table["_factor"][0].as_py(), table["_total"][0].as_py()
    x = np.stack([np.zeros(len(table)) if table[c].null_count else table[c].to_numpy().astype(float) for c in columns], axis=1)
    start, end = bool(at[0] == 0), bool(at[-1] == total - 1)
    return _mirrored(x, start, end), factor, start, end


def _flat(state: np.ndarray) -> list[float]:
    return state.reshape(-1).tolist()


def _summary(table: pa.Table, columns: list[str]) -> pa.Table:
    """What a block does to the state, forwards from rest and backwards from rest, and what it needs to know of its ends.

    ``left``: state after the block; ``back``: state after running back over what comes out of it from rest; ``edge``: its first input,
    and its last output from rest.
    """
    table = table.sort_by("_row")
    x, factor, _, _ = _signal(table, columns)
    filtering = recursion(factor)
    rest = np.zeros((ORDER, x.shape[1]))
    y, left = filtering.run(x, rest)
    _, back = filtering.run(y[::-1], rest)
    row = {"recording_id": table["recording_id"][0].as_py(), "_block": table["_block"][0].as_py(), "_factor": factor, "_n": len(x),
           "left": _flat(left), "back": _flat(back), "edge": [*x[0].tolist(), *y[-1].tolist()]}
    return pa.Table.from_pylist([row], schema=_SUMMARY)


_SUMMARY = pa.schema([("recording_id", pa.string()), ("_block", pa.int64()), ("_factor", pa.int32()), ("_n", pa.int64()),
                      ("left", pa.list_(pa.float64())), ("back", pa.list_(pa.float64())), ("edge", pa.list_(pa.float64()))])


@lru_cache(maxsize=256)
def _echo(factor: int, n: int) -> np.ndarray:
    """The state that running back over ``n`` outputs leaves, for each unit of state that they started from and no input."""
    filtering = recursion(factor)
    y, _ = filtering.run(np.zeros((n, ORDER)), np.eye(ORDER))
    return filtering.run(y[::-1], np.zeros((ORDER, ORDER)))[1]


def _scan(maps: DataFrame, starts: DataFrame) -> DataFrame:
    """State before every map: (recording_id, _at, state).

    ``maps`` (recording_id, _at from 0, _factor, _n, f): in order, a recording's state becomes a**_n @ state + f.  ``starts``
    (recording_id, state): the state before the first.  Maps compose, so SCANNED of them in a row become one map of the next level, whose
    states are found first; no task holds more than that many.
    """
    top = maps.agg(F.max("_at")).first()[0]
    group = F.floor(F.col("_at") / SCANNED).cast("bigint")
    grouped = maps.withColumn("_group", group)
    if top is not None and top >= SCANNED:
        def composed(table: pa.Table) -> pa.Table:
            rows = table.sort_by("_at").to_pylist()
            filtering, n, f = recursion(rows[0]["_factor"]), 0, 0.0
            for r in rows:
                here = np.array(r["f"]).reshape(ORDER, -1)
                f, n = filtering.after(f * np.ones_like(here), r["_n"]) + here, n + r["_n"]
            return pa.Table.from_pylist([{"recording_id": rows[0]["recording_id"], "_at": rows[0]["_group"], "_factor": rows[0]["_factor"], "_n": n, "f": _flat(f)}],
                                        schema=pa.schema([("recording_id", pa.string()), ("_at", pa.int64()), ("_factor", pa.int32()), ("_n", pa.int64()), ("f", pa.list_(pa.float64()))]))
        longer = durable(grouped.groupBy("recording_id", "_group").applyInArrow(composed, "recording_id string, _at bigint, _factor int, _n bigint, f array<double>"))
        begin = _scan(longer, starts).withColumnRenamed("_at", "_group")
    else:
        begin = starts.withColumn("_group", F.lit(0).cast("bigint"))

    def followed(table: pa.Table, begin: pa.Table) -> pa.Table:
        if not len(begin) or not len(table):
            return _STATES.empty_table()
        rows, out = table.sort_by("_at").to_pylist(), []
        filtering = recursion(rows[0]["_factor"])
        state = np.array(begin["state"][0].as_py()).reshape(ORDER, -1)
        for r in rows:
            out.append({"recording_id": r["recording_id"], "_at": r["_at"], "state": _flat(state)})
            state = filtering.after(state, r["_n"]) + np.array(r["f"]).reshape(ORDER, -1)
        return pa.Table.from_pylist(out, schema=_STATES)
    return durable(grouped.groupBy("recording_id", "_group").cogroup(begin.groupBy("recording_id", "_group"))
                   .applyInArrow(followed, "recording_id string, _at bigint, state array<double>"))


_STATES = pa.schema([("recording_id", pa.string()), ("_at", pa.int64()), ("state", pa.list_(pa.float64()))])


def _per_block(rows: DataFrame, value, name: str) -> DataFrame:
    """``rows`` with an array that ``value`` makes of a block's columns, as a map over narrow rows."""
    names = rows.columns

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = [value(r) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(new, pa.list_(pa.float64()))], names=[*names, name])
    return rows.mapInArrow(made, T.StructType([*rows.schema.fields, T.StructField(name, T.ArrayType(T.DoubleType()))]))


def border_states(blocks: DataFrame, columns: list[str]) -> DataFrame:
    """(recording_id, _block, forward, backward): the states that either direction enters every block with."""
    width = len(columns)
    summary = durable(blocks.select("recording_id", "_block", "_row", "_factor", "_total", *columns).groupBy("recording_id", "_block").applyInArrow(
        lambda table: _summary(table, columns), "recording_id string, _block bigint, _factor int, _n bigint, left array<double>, back array<double>, edge array<double>"))

    def settled(factor, values):
        return _flat(np.outer(recursion(factor).settled, values))
    first = _per_block(summary.where("_block = 0"), lambda r: settled(r["_factor"], r["edge"][:width]), "state")
    forward = _scan(summary.select("recording_id", F.col("_block").alias("_at"), "_factor", "_n", F.col("left").alias("f")), first.select("recording_id", "state"))
    known = summary.join(forward.select("recording_id", F.col("_at").alias("_block"), F.col("state").alias("forward")), ["recording_id", "_block"])

    def back(r):
        """What running back leaves from rest, given the state that the outputs started from."""
        return _flat(np.array(r["back"]).reshape(ORDER, -1) + _echo(r["_factor"], r["_n"]) @ np.array(r["forward"]).reshape(ORDER, -1))

    def last_output(r):
        filtering = recursion(r["_factor"])
        state = filtering.after(np.array(r["forward"]).reshape(ORDER, -1), r["_n"] - 1)
        return settled(r["_factor"], np.array(r["edge"][width:]) + filtering.seen[0] @ state)
    known = durable(_per_block(known, back, "f").withColumn("_at", F.max("_block").over(Window.partitionBy("recording_id")) - F.col("_block")))
    last = _per_block(known.where("_at = 0"), last_output, "state")
    backward = _scan(known.select("recording_id", "_at", "_factor", "_n", "f"), last.select("recording_id", "state"))
    return known.join(backward.select("recording_id", "_at", F.col("state").alias("backward")), ["recording_id", "_at"]).select("recording_id", "_block", "forward", "backward")


def _filter_block(table: pa.Table, states: pa.Table, columns: list[str]) -> pa.Table:
    """One block of one recording: filtered from the states at its borders and thinned."""
    table = table.sort_by("_row")
    x, factor, start, _ = _signal(table, columns)
    filtering = recursion(factor)
    begin, end = (np.array(states[c][0].as_py()).reshape(ORDER, -1) for c in ("forward", "backward"))
    forward, _ = filtering.run(x, begin)
    done = filtering.run(forward[::-1], end)[0][::-1][EDGE if start else 0:]
    own = np.flatnonzero(table["_row"].to_numpy() % factor == 0)
    out = table.take(pa.array(own))
    for k, name in enumerate(columns):
        if not table[name].null_count:
            i = out.schema.get_field_index(name)
            out = out.set_column(i, name, pa.array(done[own, k]).cast(out.schema.field(i).type))
    return out.select([c for c in table.column_names if c not in ("_row", "_factor", "_total", "_block")])


def missing_in_filtered(counted: DataFrame, columns: list[str]) -> DataFrame:
    """Violations: (recording, column) with values in some rows and gaps in others, from counts by recording."""
    partial = F.array(*[F.when((F.col(c) > 0) & (F.col(c) < F.col("_total")), F.lit(c)) for c in columns])
    return counted.select("recording_id", F.explode(F.array_compact(partial)).alias("column"))


def downsample(motion: DataFrame, factors: DataFrame, *, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Keep every ``factor``-th sample of each recording, with sensor channels filtered first.

    ``factors``: recording_id, factor; a recording without one is refused.  Times, quaternions and provenance keep original readings.
    The zero-phase filter is a recursion, and what a block of samples does to its state is an affine map.  Recordings are numbered,
    cut into blocks and written; one pass takes the map of every block in both directions, a scan over these maps gives the
    states at all borders, and a second pass filters every block from them.  So one long recording uses many tasks, and the result
    is the recursion over the whole of it.  ``motion`` itself runs twice: for its counts and for its rows.
    """
    columns = [c for q in FILTERED_VECTORS for c in VECTORS[q] if c in motion.columns]
    counted = durable(motion.groupBy("recording_id").agg(F.count("*").alias("_total"), *[F.count(c).alias(c) for c in columns])
                      .join(factors.select("recording_id", F.col("factor").alias("_factor")), "recording_id", "left"))
    if unknown := counted.where("_factor IS NULL").select("recording_id").distinct().take(5):
        raise ValueError("no decimation factor for " + ", ".join(str(r["recording_id"]) for r in unknown))
    thinned = counted.where("_factor > 1")
    placed = attach(motion, counted.select("recording_id", "_factor", "_total"), ["recording_id"], "inner")
    unchanged, rows = placed.where("_factor = 1").select(*motion.columns), placed.where("_factor > 1")
    largest = thinned.agg(F.max("_total")).first()[0]
    if largest is None:
        return unchanged
    split = None if largest > rows_per_task(motion.sparkSession) else False
    if not columns:  # nothing to filter, so no row needs to leave the JVM
        kept = numbered(ordered(rows, split=split), "_row").frame.where(F.pmod(F.col("_row"), F.col("_factor")) == 0)
        return unchanged.unionByName(kept.select(*motion.columns))
    if gaps := missing_in_filtered(thinned, columns).take(5):
        raise ValueError("cannot filter columns with missing values: " + ", ".join(f"{r['recording_id']}.{r['column']}" for r in gaps))
    if short := thinned.where(F.col("_total") <= EDGE).take(5):
        raise ValueError(f"recordings need more than {EDGE} samples to be filtered: " + ", ".join(r["recording_id"] for r in short))
    block_rows = max(block_rows, EDGE + 1)
    # The last block takes what does not fill one, so that it holds the samples that are mirrored.
    block = F.least(F.floor(F.col("_row") / block_rows), F.greatest(F.floor(F.col("_total") / block_rows) - 1, F.lit(0))).cast("bigint")
    blocks = durable(numbered(ordered(rows, split=split), "_row").frame.withColumn("_block", block))
    states = border_states(blocks, columns)
    filtered = blocks.groupBy("recording_id", "_block").cogroup(states.groupBy("recording_id", "_block")).applyInArrow(
        lambda table, at: _filter_block(table, at, columns), motion.schema)
    return unchanged.unionByName(filtered)


def picked_times(motion: DataFrame, factors: DataFrame) -> DataFrame:
    """The (recording_id, t_ns, seq) that decimation keeps, without touching sensor channels."""
    rows = attach(motion.select("recording_id", "t_ns", "seq"),
                  factors.select("recording_id", "factor"), ["recording_id"], "inner")
    return numbered(ordered(rows), "_row").frame.where(
        F.pmod(F.col("_row"), F.col("factor")) == 0).select("recording_id", "t_ns", "seq")
