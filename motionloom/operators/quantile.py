"""Exact quantiles with linear interpolation, for groups of any size, by radix selection.

A value's leading digits put it into a cell: its sign, its octave and a 256th of that.  Any function that never falls as values rise
would do; this one follows the bits of a double.  Cells are counted per group before the shuffle, so a group is a few hundred
rows afterwards whatever its size.  Running counts tell which cells hold the wanted ranks.  A cell of one value is answered by it; of
the others, those with more values than one task may hold are cut into 4096 equal ranges from their least to their greatest value and
counted again, until every cell left is small.  Only the values of these cells are then shuffled and ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .layout import attach, durable, rows_per_task

OCTAVE_CELLS, RANGES = 256, 4096
#: Beyond the exponents of a double in either direction, so that cells of positive values are positive.
EXPONENTS = 1100
LAST_CELL = 3 * EXPONENTS * OCTAVE_CELLS  # NaN, which sorts after everything


def cell(name: str) -> Column:
    """A whole number that never falls as the values of the column rise."""
    v = f"cast(`{name}` as double)"
    step = f"cast(floor(greatest(least(log2(abs({v})), {EXPONENTS - 1}D), {1 - EXPONENTS}D) * {OCTAVE_CELLS}) as int) + {EXPONENTS * OCTAVE_CELLS}"
    return F.expr(f"CASE WHEN isnan({v}) THEN {LAST_CELL} WHEN {v} = 0 THEN 0 WHEN {v} > 0 THEN {step} ELSE -({step}) END")


def _holding(counts: DataFrame, groups: list[str], order: str, before: str, ranks: str) -> DataFrame:
    """Those of ``counts`` (groups, order, _n) that hold wanted ranks, with the values before them and these ranks."""
    by = ", ".join(f"`{g}`" for g in groups)
    along = f"coalesce(sum(_n) OVER (PARTITION BY {by} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L)"
    placed = counts.withColumn("_before", F.expr(f"{before} + {along}"))
    return placed.withColumn("_ranks", F.expr(f"filter({ranks}, r -> r >= _before AND r < _before + _n)")).where("size(_ranks) > 0")


def cell_counts(df: DataFrame, key: list[str], value: str) -> DataFrame:
    """(key, _cell, _n, _lo, _hi) of the values that are not NULL; counts of parts of a table add up."""
    rows = df.where(F.col(value).isNotNull())
    return rows.groupBy(*key, cell(value).alias("_cell")).agg(F.count("*").alias("_n"), F.min(value).alias("_lo"), F.max(value).alias("_hi"))


def quantiles(df: DataFrame, key: list[str], value: str, limit: int | None = None, counts: DataFrame | None = None,
              **probabilities: float) -> DataFrame:
    """One row per key with ``n`` and a column per named probability; NULL values are ignored, NaN is the greatest.

    Cells with over ``limit`` values, by default what a task may hold, are cut further.  ``counts`` are those of
    :func:`cell_counts` where they are there already.  Groups without a value have no row.
    """
    key, limit = list(key), limit or rows_per_task(df.sparkSession)
    totals = Window.partitionBy(*key)
    counts = cell_counts(df, key, value) if counts is None else counts
    counts = counts.withColumn("_total", F.sum("_n").over(totals))
    rank = {name: f"{float(p)!r}D * (_total - 1)" for name, p in probabilities.items()}
    ends = ", ".join(f"cast({side}({r}) as bigint)" for r in rank.values() for side in ("floor", "ceil"))
    cells = durable(_holding(counts, key, "_cell", "0L", f"array_distinct(array({ends}))").withColumn("_left", F.expr("CASE WHEN _lo < _hi THEN _n END")).drop("_n"))
    answered = [cells.where("_left IS NULL")]
    open_cells = cells.where("_left IS NOT NULL")

    def found_in(which: DataFrame) -> DataFrame:
        """The values that lie in open cells; the ranges of one cell do not meet, so a value lies in one of them at most."""
        rows = df.where(F.col(value).isNotNull()).select(*key, F.col(value).alias("_value"), cell(value).alias("_cell"))
        return attach(rows, which, [*key, "_cell"], "inner").where("_value >= _lo AND _value <= _hi")

    span = "(cast(_hi as double) - cast(_lo as double))"
    # Cells that end at infinity, hold NaN or differ beyond a double's digits alone cannot be cut by their range.
    cuttable = F.expr(f"_left > {limit} AND {span} > 0 AND {span} < double('Infinity')")
    while True:
        crowded, left = open_cells.where(cuttable), open_cells.agg(F.count("*"), F.count_if(cuttable)).first()
        if not left[1]:
            break
        part = F.expr(f"cast(floor((cast(_value as double) - cast(_lo as double)) / {span} * {RANGES}) as int)")
        groups = [*key, "_cell", "_lo", "_hi", "_before", "_ranks", "_total"]
        again = (found_in(crowded).groupBy(*groups, part.alias("_part")).agg(F.count("*").alias("_n"), F.min("_value").alias("_least"), F.max("_value").alias("_most"))
                 .withColumnsRenamed({"_before": "_start", "_ranks": "_wanted"}))
        finer = _holding(again, [*key, "_cell", "_lo"], "_part", "_start", "_wanted").select(
            *key, "_cell", F.col("_least").alias("_lo"), F.col("_most").alias("_hi"), "_total", "_before", "_ranks", F.when(F.col("_least") < F.col("_most"), F.col("_n")).alias("_left"))
        finer = durable(finer)
        answered.append(finer.where("_left IS NULL"))
        open_cells = durable(open_cells.where(~cuttable).unionByName(finer.where("_left IS NOT NULL")))

    values = [rows.select(*key, "_total", F.explode("_ranks").alias("_rank"), F.col("_lo").alias("_value")) for rows in answered]
    if left[0]:
        groups = [*key, "_cell", "_lo", "_before", "_ranks", "_total"]
        each = (found_in(open_cells).groupBy(*groups, "_value").agg(F.count("*").alias("_n")).withColumnsRenamed({"_before": "_start", "_ranks": "_wanted"}))
        picked = _holding(each, [*key, "_cell", "_lo"], "_value", "_start", "_wanted")
        values.append(picked.select(*key, "_total", F.explode("_ranks").alias("_rank"), "_value"))
    ranked = values[0]
    for more in values[1:]:
        ranked = ranked.unionByName(more)

    def between(r: str) -> Column:
        """The weighted sum of the two values around ``r``; each rank of a key is one row."""
        weight = f"CASE WHEN _rank = floor({r}) THEN 1 - ({r} - floor({r})) WHEN _rank = ceil({r}) THEN {r} - floor({r}) END"
        return F.expr(f"sum(CASE WHEN {weight} > 0 THEN cast(_value as double) * ({weight}) END)")
    return ranked.groupBy(*key).agg(F.first("_total").alias("n"), *[between(r).alias(name) for name, r in rank.items()])
