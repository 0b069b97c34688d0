"""Shared plumbing: scans, written intermediate tables, bounded Arrow batches, files from tasks."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that one step of a vectorised scan takes at once; intermediate arrays are some 30 times that.
GROUP_BYTES = 1 << 20
#: Rows of an Arrow batch; a batch of ordinary documents is then a few MB.
BATCH_ROWS = 500


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which the driver and all executors share.

    Nothing deletes it: it must outlive the frames that read it, and the shared folder is scratch space.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"file://{tempfile.gettempdir()}/spark-shared-{uuid.uuid4().hex[:8]}"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: lineage ends there and lost executors do no harm."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(df: DataFrame) -> DataFrame:
    """Bound the Arrow batches of this session, since texts may be long; a smaller setting stays as it is."""
    key, spark = "spark.sql.execution.arrow.maxRecordsPerBatch", df.sparkSession
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    return df


@contextmanager
def batches_of(spark: SparkSession, rows: int):
    """For actions inside: Arrow batches of so few rows, where a row is a block of some MB."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def groups(sizes: Sequence[int], limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges whose sizes sum to at most ``limit``; a larger item stands alone."""
    first = total = 0
    for i, size in enumerate(sizes):
        if i > first and total + size > limit:
            yield first, i
            first, total = i, 0
        total += size
    if first < len(sizes):
        yield first, len(sizes)


def text_groups(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Pieces of the batches together with the UTF-8 bytes of their texts (NULL: empty)."""
    for batch in batches:
        raw = batch.column(column).cast(pa.binary())
        sizes = [0 if x is None else x for x in pa.compute.binary_length(raw).to_pylist()]
        for first, last in groups(sizes):
            yield batch.slice(first, last - first), [x or b"" for x in raw.slice(first, last - first).to_pylist()]


def ratio(n: int, per: int) -> int:
    """How many parts of ``per`` hold ``n``, at least one."""
    return max(1, math.ceil(n / per))


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI and the path in it, for tasks that read or write bytes themselves."""
    if "://" in uri:
        return pafs.FileSystem.from_uri(uri)
    if uri.startswith("file:"):
        uri = uri.removeprefix("file:")
    return pafs.LocalFileSystem(), uri
