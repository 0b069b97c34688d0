"""Stored collections: a manifest, channel descriptors and one table per modality.

Two layouts are read: one Parquet file per recording (``<modality>/<recording_id>.parquet``) and
this library's own tables, partitioned by recording.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..plans.validate import contract_problems
from ..vocabulary import CHANNEL_COLUMNS, MANIFEST_COLUMNS, MODALITIES
from .files import path_part
from .zones import StoredTable, without_nan


def scan_manifest(spark: SparkSession, root: str, *, strict: bool = False) -> DataFrame:
    manifest = without_nan(spark.read.parquet(f"{root}/sessions.parquet"))
    if strict:
        contract_problems(manifest.columns, MANIFEST_COLUMNS, "manifest")
    return manifest


def scan_channels(spark: SparkSession, root: str, *, strict: bool = False) -> DataFrame:
    channels = without_nan(spark.read.parquet(f"{root}/channels.parquet"))
    if strict:
        contract_problems(channels.columns, CHANNEL_COLUMNS, "channels")
    return channels


def _known(modality: str) -> None:
    if modality not in MODALITIES:
        raise ValueError(f"unknown modality {modality!r}; expected one of {MODALITIES}")


def scan_modality(spark: SparkSession, root: str, modality: str) -> DataFrame:
    """All recordings of one of this library's tables; see :func:`stored_modality` for some of them."""
    return stored_modality(spark, root, modality).frame()


def stored_modality(spark: SparkSession, root: str, modality: str) -> StoredTable:
    """One of this library's tables, to load recordings from without opening the files of others."""
    _known(modality)
    return StoredTable(spark, f"{root}/{modality}")


def scan_bundle_modality(spark: SparkSession, root: str, modality: str,
                         ids: list[str] | None = None) -> DataFrame:
    """One table of a file-per-recording bundle, with the recording and row order of each row.

    Columns may differ by recording and are merged.  ``ids`` opens only those files.
    """
    _known(modality)
    paths = [f"{root}/{modality}/{i}.parquet" for i in ids] if ids else [f"{root}/{modality}"]
    raw = spark.read.option("mergeSchema", True).parquet(*paths)
    named = raw.select(path_part(F.col("_metadata.file_name"), r"^(.*)\.parquet$").alias("recording_id"),
                       F.col("_metadata.row_index").alias("seq"), *raw.columns)
    return without_nan(named)


def stored_modalities(spark: SparkSession, root: str) -> list[str]:
    found = []
    for modality in MODALITIES:
        try:
            spark.read.parquet(f"{root}/{modality}")
        except AnalysisException:
            continue
        found.append(modality)
    return found


def bundle_session(spark: SparkSession) -> SparkSession:
    """A session that can read bundle files.

    Published floats use an encoding only Spark's row reader knows.  The switch belongs to a session
    and plans are lazy, so bundles are converted once in a session of their own (see
    :func:`motionloom.sources.sinks.convert_bundle`) and all later work reads vectorised.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.parquet.enableVectorizedReader", "false")
    session.conf.set("spark.sql.session.timeZone", "UTC")
    return session
