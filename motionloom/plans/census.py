"""What one pass over each table of a collection tells, for all operators that ask for it.

Every table is aggregated once: rows, first and last instant, the columns that hold a value and the columns that hold a Unix time
(both as bits of whole numbers, joined by ``bit_or``).  For motion tables the same aggregate counts the cells of the physical measures
that quantiles start from: a row becomes one entry for itself and one for each measure it has, and entries are combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.layout import durable, union_all
from ..operators.motion import with_presence_columns
from ..operators.privacy import leak_sql, leak_test
from ..operators.quantile import cell
from ..vocabulary import MOTION_MODALITIES, VECTORS

STREAM = ["recording_id", "modality"]
OWN_COLUMNS = ("recording_id", "seq", "modality")  # added by the scan, not part of a stored table
BITS = 62  # columns in one whole number


@dataclass(frozen=True)
class Census:
    """``facts``: recording_id, modality, n_samples, t_start_ns, t_end_ns, columns, dated (arrays of column names).

    ``cells``: the cell counts of the measures asked for, by recording, modality and measure.
    """

    facts: DataFrame
    cells: DataFrame

    def spans(self) -> DataFrame:
        return self.facts.select(*STREAM, "t_start_ns", "t_end_ns", "n_samples")

    def columns(self, *modalities: str) -> DataFrame:
        """(recording_id, modality, column) of every stored column, see :func:`motionloom.plans.manifest.stored_columns`."""
        rows = self.facts.where(F.col("modality").isin(*modalities)) if modalities else self.facts
        return rows.select(*STREAM, F.explode("columns").alias("column"))

    def dated_columns(self) -> DataFrame:
        """(recording_id, modality, column) of every column that holds a Unix time."""
        return self.facts.select(*STREAM, F.explode("dated").alias("column"))


def _mask(tests: list[str], j: int) -> str:
    """SQL of the j-th whole number whose bits are ``tests``."""
    bits = [f"CASE WHEN {test} THEN {1 << i}L ELSE 0L END" for i, test in enumerate(tests[j * BITS:(j + 1) * BITS])]
    return " + ".join(bits) or "0L"


def _names(columns: list[str], mask: str) -> str:
    """SQL of the array of those columns whose bits are set."""
    held = [f"CASE WHEN {mask}{i // BITS} & {1 << (i % BITS)}L <> 0 THEN '{c}' END" for i, c in enumerate(columns)]
    return f"array_compact(array({', '.join(held)}))" if held else "cast(array() as array<string>)"


def census(tables: dict[str, DataFrame], measured: Callable[[DataFrame], DataFrame] | None = None, measures: Sequence[str] = ()) -> Census:
    """The facts of ``tables`` and the cells of ``measures``, written out.

    ``measured`` adds one column for each of the ``measures`` to a motion table that has a column for every vector.
    """
    stored = {name: [c for c in table.columns if c not in OWN_COLUMNS] for name, table in tables.items()}
    width = max(-(-len(columns) // BITS) for columns in stored.values())
    masks = [f"{kind}{j}" for kind in ("held", "dated") for j in range(width)]
    parts = []
    for name, table in tables.items():
        types = dict(table.dtypes)
        start, end = ("t_start_ns", "t_end_ns") if "t_start_ns" in types else ("t_ns", "t_ns")
        tests = []
        for c in stored[name]:
            test = leak_sql(c, types[c])
            if test is None and (found := leak_test(c, types[c])) is not None:  # a payload, which SQL text cannot judge
                table, test = table.withColumn(f"_dated_{c}", found), f"`_dated_{c}`"
            tests.append(test or "false")
        entries = ["named_struct('measure', '', 'value', cast(NULL as double))"]
        if name in MOTION_MODALITIES and measured is not None:
            for quantity in VECTORS:
                table = with_presence_columns(table, quantity)
            table = measured(table)
            entries += [f"named_struct('measure', '{m}', 'value', {m})" for m in measures]
        facts = [f"{start} AS start", f"{end} AS end", *[f"{_mask([f'`{c}` IS NOT NULL' for c in stored[name]], j)} AS held{j}" for j in range(width)],
                 *[f"{_mask(tests, j)} AS dated{j}" for j in range(width)]]
        rows = table.selectExpr("recording_id", *facts, f"inline(array({', '.join(entries)}))").where("measure = '' OR value IS NOT NULL")
        # Least, greatest and joined bits stay the same when a row's entries repeat its facts.
        counted = rows.groupBy("recording_id", "measure", cell("value").alias("_cell")).agg(
            F.count("*").alias("_n"), F.min("value").alias("_lo"), F.max("value").alias("_hi"), F.min("start").alias("t_start_ns"), F.max("end").alias("t_end_ns"),
            *[F.bit_or(m).alias(m) for m in masks])
        parts.append(counted.withColumn("modality", F.lit(name)))
    known = durable(union_all(parts))
    columns, dated = [], []
    for name, names in stored.items():
        own = _names(names, "held") if name in MOTION_MODALITIES else f"array({', '.join(repr(c) for c in names)})"
        columns.append(f"WHEN modality = '{name}' THEN {own}")
        dated.append(f"WHEN modality = '{name}' THEN {_names(names, 'dated')}")
    facts = known.where("measure = ''").selectExpr(*STREAM, "_n AS n_samples", "t_start_ns", "t_end_ns", f"CASE {' '.join(columns)} END AS columns", f"CASE {' '.join(dated)} END AS dated")
    return Census(facts, known.where("measure <> ''").select(*STREAM, "measure", "_cell", "_n", "_lo", "_hi"))
