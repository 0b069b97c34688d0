"""How rows are spread over tasks before an order-dependent operator runs.

A recording is normally small enough for one task, and then one hash shuffle on its id is the best
plan.  Nothing guarantees that, so recordings with more rows than a task may hold are looked up first
(a count over the key column alone).  Only their rows are range-partitioned on key *and* order, which
cuts them into consecutive chunks of similar size whatever the distribution, and written; the
operators carry a few values per chunk across these cuts.  All other rows stay with the hash shuffle.
"""

from __future__ import annotations

import math
import tempfile
import uuid
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CHUNK, WHOLE = "_chunk", -1
DEFAULT_ROWS_PER_TASK = 1_000_000
DEFAULT_BROADCAST_ROWS = 200_000


def _setting(spark: SparkSession, name: str, default: int) -> int:
    return int(spark.conf.get(f"spark.motionloom.{name}", str(default)))


def rows_per_task(spark: SparkSession) -> int:
    """Largest group one task may hold; session setting ``spark.motionloom.rowsPerTask``."""
    return _setting(spark, "rowsPerTask", DEFAULT_ROWS_PER_TASK)


def broadcast_rows(spark: SparkSession) -> int:
    """Largest table sent to every executor; session setting ``spark.motionloom.broadcastRows``."""
    return _setting(spark, "broadcastRows", DEFAULT_BROADCAST_ROWS)


def _checkpoint_folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="spark-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder, so that it survives lost executors."""
    _checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` as Parquet in the shared checkpoint folder: for tables as long as the input, which several steps read.

    Compressed columns take a fraction of what ``durable`` writes, and a step reads only those it needs.
    """
    path = f"{_checkpoint_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class Ordered:
    """Rows with an order inside each key, and the chunk of that order every row belongs to.

    Keys that are not cut lie in chunk ``WHOLE``; ``split`` tells whether any key is cut.
    """

    rows: DataFrame
    key: tuple[str, ...]
    order: tuple[str, ...]
    split: bool

    def having(self, rows: DataFrame, order: tuple[str, ...] | None = None) -> Ordered:
        """The same layout over a projection or filter of its rows."""
        return replace(self, rows=rows, order=order or self.order)

    @property
    def frame(self) -> DataFrame:
        return self.rows.drop(CHUNK)


def crowded_keys(df: DataFrame, *key: str) -> DataFrame:
    """(key, _n) of the keys with more rows than one task may hold; at most all rows over that limit.

    Counts are combined before the shuffle, so skew is harmless.
    """
    counted = df.groupBy(*key).agg(F.count("*").alias("_n"))
    return durable(counted.where(F.col("_n") > rows_per_task(df.sparkSession)))


def ordered(df: DataFrame, key: tuple[str, ...] = ("recording_id",),
            order: tuple[str, ...] = ("t_ns", "seq"), split: bool | None = None) -> Ordered:
    """Lay ``df`` out for order-dependent work; ``split=False`` promises that no key needs cutting.

    Ties in ``order`` must not matter to the caller or be excluded by a last unique column.  Only the rows of
    crowded keys are written.
    """
    whole = Ordered(df.withColumn(CHUNK, F.lit(WHOLE)), key, order, False)
    if split is False:
        return whole
    crowded = crowded_keys(df, *key)
    rows = crowded.agg(F.sum("_n")).first()[0]
    if not rows:
        return whole
    named = crowded.select(*[F.col(k).alias(f"_key_{k}") for k in key])
    named = F.broadcast(named) if _at_most(named, broadcast_rows(df.sparkSession)) else named
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in key])
    parts = max(1, math.ceil(rows / rows_per_task(df.sparkSession)))
    cut = durable(df.join(named, same, "left_semi").repartitionByRange(parts, *key, *order)
                  .withColumn(CHUNK, F.spark_partition_id()))
    rest = df.join(named, same, "left_anti").withColumn(CHUNK, F.lit(WHOLE))
    return Ordered(rest.unionByName(cut), key, order, True)


# --- values that look along the order ---------------------------------------------------------

@dataclass(frozen=True)
class Along:
    """One value computed along the order; build it with the functions below."""

    kind: str
    value: Column


def previous(value: Column) -> Along:
    """Value of the row before (NULL on the first row of the key)."""
    return Along("previous", value)


def following(value: Column) -> Along:
    """Value of the row after (NULL on the last row of the key)."""
    return Along("following", value)


def last_seen(value: Column) -> Along:
    """Latest non-NULL value up to and including this row."""
    return Along("last_seen", value)


def next_seen(value: Column) -> Along:
    """Earliest non-NULL value from this row on."""
    return Along("next_seen", value)


def running_sum(value: Column) -> Along:
    """Sum up to and including this row."""
    return Along("running_sum", value)


def running_max(value: Column) -> Along:
    """Largest value up to and including this row."""
    return Along("running_max", value)


def along(layout: Ordered, **columns: Along) -> Ordered:
    """Add one column per named value.  All values of one call share the sorts and the carry."""
    keyed = [F.col(c) for c in (*layout.key, CHUNK)]
    up = Window.partitionBy(*keyed).orderBy(*[F.col(c).asc() for c in layout.order])
    down = Window.partitionBy(*keyed).orderBy(*[F.col(c).desc() for c in layout.order])
    so_far = (Window.unboundedPreceding, Window.currentRow)
    # Neighbours are wrapped so that "no row there" differs from "a row holding NULL".
    within = {
        "previous": lambda v: F.lag(F.struct(v.alias("v"))).over(up),
        "following": lambda v: F.lead(F.struct(v.alias("v"))).over(up),
        "last_seen": lambda v: F.last(v, ignorenulls=True).over(up.rowsBetween(*so_far)),
        # A frame reaching to the end is quadratic in Spark; walking backwards is linear.
        "next_seen": lambda v: F.last(v, ignorenulls=True).over(down.rowsBetween(*so_far)),
        "running_sum": lambda v: F.sum(v).over(up.rowsBetween(*so_far)),
        "running_max": lambda v: F.max(v).over(up.rowsBetween(*so_far)),
    }
    rows = layout.rows
    local = {name: within[a.kind](a.value) for name, a in columns.items()}
    if not layout.split:
        return layout.having(rows.select("*", *[
            (c["v"] if columns[name].kind in ("previous", "following") else c).alias(name)
            for name, c in local.items()]))

    position = F.struct(*layout.order)
    summary = {
        "previous": lambda v: F.max_by(F.struct(v.alias("v")), position),
        "following": lambda v: F.min_by(F.struct(v.alias("v")), position),
        "last_seen": lambda v: F.max_by(v, F.when(v.isNotNull(), position)),
        "next_seen": lambda v: F.min_by(v, F.when(v.isNotNull(), position)),
        "running_sum": F.sum,
        "running_max": F.max,
    }
    # One row per cut key and chunk; a key spans at most as many rows here as there are chunks.
    chunks = Window.partitionBy(*layout.key).orderBy(CHUNK)
    before = chunks.rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*layout.key).orderBy(F.col(CHUNK).desc()).rowsBetween(
        Window.unboundedPreceding, -1)
    carried = {
        "previous": lambda v: F.lag(v).over(chunks),
        "following": lambda v: F.lead(v).over(chunks),
        "last_seen": lambda v: F.last(v, ignorenulls=True).over(before),
        "next_seen": lambda v: F.last(v, ignorenulls=True).over(after),
        "running_sum": lambda v: F.sum(v).over(before),
        "running_max": lambda v: F.max(v).over(before),
    }
    merged = {
        "previous": lambda own, c: F.coalesce(own, c)["v"],
        "following": lambda own, c: F.coalesce(own, c)["v"],
        "last_seen": F.coalesce,
        "next_seen": F.coalesce,
        "running_sum": lambda own, c: F.when(own.isNotNull() & c.isNotNull(), own + c).otherwise(
            F.coalesce(own, c)),
        "running_max": lambda own, c: F.greatest(own, c),
    }
    # Written out, because steps build on each other: a step then reads the carries before it
    # instead of deriving all of them again.
    carry = durable(rows.where(F.col(CHUNK) != WHOLE).groupBy(*layout.key, CHUNK)
                    .agg(*[summary[a.kind](a.value).alias(f"_c_{n}") for n, a in columns.items()])
                    .select(*layout.key, CHUNK, *[carried[a.kind](F.col(f"_c_{n}")).alias(f"_c_{n}")
                                                  for n, a in columns.items()]))
    carry = F.broadcast(carry) if _at_most(carry, broadcast_rows(rows.sparkSession)) else carry
    joined = (rows.select("*", *[c.alias(f"_w_{n}") for n, c in local.items()])
              .join(carry, [*layout.key, CHUNK], "left"))
    return layout.having(joined.select(*rows.columns, *[
        merged[a.kind](F.col(f"_w_{n}"), F.col(f"_c_{n}")).alias(n) for n, a in columns.items()]))


def numbered(layout: Ordered, name: str = "row_number") -> Ordered:
    """Zero-based position of every row within its key."""
    counted = along(layout, **{name: running_sum(F.lit(1).cast("bigint"))})
    return layout.having(counted.rows.withColumn(name, F.col(name) - 1))


# --- joins with a smaller table ------------------------------------------------------------------

def attach(rows: DataFrame, lookup: DataFrame, on: list[str], how: str = "left", *,
           costly: bool = False) -> DataFrame:
    """Join ``rows`` with a table of few rows per key.

    The lookup is sent to every executor only if counting it stays below the limit.  Beyond it both
    sides are shuffled, and keys with more rows than one task may hold are looked up first: their
    rows are dealt out over as many salts as they fill tasks, with the lookup row repeated for each.
    A ``costly`` lookup is written out before it is counted, so that it is computed once.
    """
    spark = rows.sparkSession
    limit = broadcast_rows(spark)
    lookup = durable(lookup) if costly else lookup
    if _at_most(lookup, limit):
        return rows.join(F.broadcast(lookup), on, how)
    share = rows_per_task(spark)
    crowded = durable(rows.groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") > share)
                      .select(*on, F.ceil(F.col("_n") / share).cast("int").alias("_salts")))
    if crowded.isEmpty():
        return rows.join(lookup, on, how)
    # Crowded keys number at most all rows over the share of a task.
    crowded = F.broadcast(crowded) if _at_most(crowded, limit) else crowded
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    dealt = rows.join(crowded, on, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*rows.columns), salts).cast("int")).drop("_salts")
    repeated = lookup.join(crowded, on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    return dealt.join(repeated, [*on, "_salt"], how).drop("_salt")


def _at_most(df: DataFrame, limit: int) -> bool:
    return df.limit(limit + 1).count() <= limit


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union by name; a column missing in one frame is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
