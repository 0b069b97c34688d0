"""Writing tables, and the checksum list that guards them."""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import groupby
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.layout import attach, rows_per_task, union_all
from ..operators.resample import decimation_factors, downsample, require_factors
from ..plans.label import label_record
from ..plans.manifest import refuse
from ..plans.select import (LabelConfig, declared_rates, filter_manifest, missing_tables,
                            resampled_manifest, selected_modalities, subset_manifest)
from ..vocabulary import MODALITIES, SCHEMA_VERSION
from .bundle import bundle_session, scan_bundle_modality, scan_channels, scan_manifest, stored_modalities
from .files import path_part
from .zones import StoredTable, recordings_of, rows_of, write_zones

READ_BYTES = 8 << 20


def write_table(table: DataFrame, path: str) -> None:
    """Write one modality, stamped with id and schema version.

    Files hold neighbouring recordings, sorted by recording and time, so that their statistics prune; an oversized
    recording is cut into several.  A zone map beside them names the recordings of each file.  The id is a stored text column, whatever it looks like, and the layout is the same for
    any number of recordings.  The number of range partitions follows the number of rows.
    """
    order = [c for c in ("recording_id", "t_ns", "t_start_ns", "seq") if c in table.columns]
    per_file = rows_per_task(table.sparkSession)
    stamped = table.withColumns({"recording_id": F.col("recording_id").cast("string"), "stamped_id": F.col("recording_id").cast("string"),
                                 "schema_version": F.lit(SCHEMA_VERSION)})
    parts = max(1, math.ceil(table.count() / per_file))
    (stamped.repartitionByRange(parts, *order).sortWithinPartitions(*order).write.mode("errorifexists")
     .option("compression", "zstd").option("maxRecordsPerFile", per_file).parquet(path))
    write_zones(table.sparkSession, path)


def write_collection(tables: dict[str, DataFrame], manifest: DataFrame, channels: DataFrame, root: str) -> None:
    for modality, table in tables.items():
        write_table(table, f"{root}/{modality}")
    manifest.write.parquet(f"{root}/sessions.parquet")
    channels.write.parquet(f"{root}/channels.parquet")


def convert_bundle(spark: SparkSession, source: str, target: str) -> None:
    """Rewrite a file-per-recording bundle as this library's tables."""
    session = bundle_session(spark)
    tables = {m: scan_bundle_modality(session, source, m) for m in stored_modalities(session, source)}
    write_collection(tables, scan_manifest(session, source), scan_channels(session, source), target)


# --- checksums --------------------------------------------------------------------------------------

def _digest(path: str) -> str:
    from pyarrow import fs
    system, local = fs.FileSystem.from_uri(path)
    total = hashlib.sha256()
    with system.open_input_stream(local) as stream:
        while part := stream.read(READ_BYTES):
            total.update(part)
    return total.hexdigest()


def checksum_inventory(spark: SparkSession, root: str) -> DataFrame:
    """(path, sha256) of every file below ``root``; files are streamed, never loaded whole."""
    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"path": batch["path"], "sha256": batch["path"].map(_digest)})

    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path"))
    hashed = listed.repartition("path").mapInPandas(digest, "path string, sha256 string")
    base = root.rstrip("/").split("://")[-1].replace("file:", "")
    return hashed.select(F.substring_index("path", f"{base}/", -1).alias("path"), "sha256")


def parse_checksum_list(rows: DataFrame) -> DataFrame:
    """Lines ``<sha256>  <path>`` to (path, sha256, malformed)."""
    shape = r"^([0-9a-f]{64})  (.+)$"
    return rows.where(F.trim("line") != "").select(
        F.coalesce(path_part(F.col("line"), shape, 2), "line").alias("path"),
        path_part(F.col("line"), shape, 1).alias("sha256"), (~F.col("line").rlike(shape)).alias("malformed"))


def checksum_problems(listed: DataFrame, found: DataFrame) -> DataFrame:
    """(path, problem) between a stored list and the files there are."""
    bad = listed.where("malformed").select("path", F.lit("malformed line").alias("problem"))
    both = (listed.where("NOT malformed").select("path", F.col("sha256").alias("_l"))
            .join(found.select("path", F.col("sha256").alias("_f")), "path", "full_outer"))
    problem = (F.when(F.col("_f").isNull(), "listed but missing").when(F.col("_l").isNull(), "not listed")
               .when(F.col("_l") != F.col("_f"), "content changed"))
    return bad.unionByName(both.select("path", problem.alias("problem")).where("problem IS NOT NULL"))


# --- exports ----------------------------------------------------------------------------------------

def write_recording_texts(lines: DataFrame, path: str) -> None:
    """Write (recording_id, value) as one text file per recording, ``path/recording_id=<id>/part.txt``.

    The tasks write the files themselves, since Spark's writer stages, moves and sets the rights of every file on its own, which takes
    far longer than the few lines a recording may have.  A recording is streamed into its file under a hidden name and renamed when
    it is whole, so an attempt that was lost or ran twice leaves one file with the same lines.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        system, root = fs.FileSystem.from_uri(path)
        rows = ((i, v) for b in batches for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        files = 0
        for name, of_recording in groupby(rows, lambda r: r[0]):
            folder = f"{root}/recording_id={'__HIVE_DEFAULT_PARTITION__' if name is None else quote(name, safe='')}"
            system.create_dir(folder)
            hidden = f"{folder}/.{uuid.uuid4().hex}"
            with system.open_output_stream(hidden) as stream:
                for _, value in of_recording:
                    stream.write(f"{value or ''}\n".encode())
            system.move(hidden, f"{folder}/part.txt")
            files += 1
        yield pa.RecordBatch.from_pydict({"files": [files]})

    dealt = lines.select("recording_id", "value").repartition("recording_id").sortWithinPartitions("recording_id")
    dealt.mapInArrow(write, "files long").agg(F.sum("files")).collect()


@contextmanager
def _listing_tasks(spark: SparkSession):
    """For loads inside: folders are listed by a few tasks a core, which take many each, instead of by up to 10,000 tasks."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def recording_files(spark: SparkSession, root: str, modalities: list[str]) -> DataFrame:
    """(recording_id, modality, path, length) of files that each belong to one recording, from one listing.

    A file is named after its recording (``<modality>/<recording_id>.parquet``) or lies in a folder
    ``recording_id=<id>``.
    """
    with _listing_tasks(spark):
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
                 .load([f"{root}/{m}" for m in modalities]).select("path", "length"))
    own = F.coalesce(path_part(F.col("path"), r"/recording_id=([^/]+)/[^/]+$"), path_part(F.col("path"), r"/([^/]+)\.parquet$"))
    modality = path_part(F.col("path"), rf"/({'|'.join(MODALITIES)})/[^/]+(?:/[^/]+)?$")
    return files.select(own.alias("recording_id"), modality.alias("modality"), "path", "length").where("recording_id IS NOT NULL")


def table_files(spark: SparkSession, root: str, modalities: list[str]) -> DataFrame:
    """(recording_id, modality, path, length): the files of this library's tables in which each recording has rows, from their zone maps."""
    return union_all([StoredTable(spark, f"{root}/{m}").zones().select(
        "recording_id", F.lit(m).alias("modality"), F.concat(F.lit(f"{root}/{m}/"), "file").alias("path"), F.col("bytes").alias("length")) for m in modalities])


def export_preview(files: DataFrame, selected: DataFrame) -> DataFrame:
    """(modality, files, bytes) of the stored files that a selection reads; ``files`` as the functions above list them."""
    taken = files.join(selected.select("recording_id"), "recording_id", "left_semi").select("modality", "path", "length").distinct()
    return taken.groupBy("modality").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


def selection_tables(tables: dict[str, DataFrame | StoredTable], manifest: DataFrame, channels: DataFrame, facets: set[str], *,
                     extra: dict | None = None, watch_target_hz: float | None = None,
                     ) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """Tables, manifest and channels of the recordings a facet selection matches.

    An empty selection and a declared table without rows are refused.  With ``watch_target_hz``
    faster watch tables are thinned, and manifest and channels say so.
    """
    selected = filter_manifest(manifest, facets, extra)
    if selected.isEmpty():
        raise ValueError("selection matched no recordings; nothing was exported")
    modalities = selected_modalities(selected, facets)
    chosen = {}
    for modality in modalities:
        flagged = selected.where(F.coalesce(F.col(f"has_{modality}"), F.lit(False))).select("recording_id")
        if modality not in tables:
            refuse(flagged, f"declared {modality} table is missing", FileNotFoundError)
            continue
        refuse(missing_tables(flagged, recordings_of(tables[modality]), manifest, modality),
               f"declared {modality} table is missing", FileNotFoundError)
        chosen[modality] = rows_of(tables[modality], flagged)
    subset = subset_manifest(selected, modalities)
    kept = channels.join(selected.select("recording_id"), "recording_id", "left_semi").where(
        F.col("modality").isin(*modalities))
    if watch_target_hz is not None and "watch" in chosen:
        watches = selected.where("has_watch")
        rates = declared_rates(channels, watches, "watch")
        refuse(rates.where("rate_hz IS NULL"), "no watch sample rate declared")
        factors = decimation_factors(rates, watch_target_hz)
        require_factors(factors, watch_target_hz)
        chosen["watch"] = downsample(chosen["watch"], factors)
        subset = resampled_manifest(subset, factors, watch_target_hz)
        thinned = (F.col("modality") == "watch") & F.coalesce(F.col("factor") > 1, F.lit(False))
        kept = attach(kept, factors.select("recording_id", "factor"), ["recording_id"]).withColumn(
            "sample_rate_hz", F.when(thinned, F.lit(float(watch_target_hz))).otherwise(F.col("sample_rate_hz"))
        ).select(*channels.columns)
    return chosen, subset, kept


def export_selection(tables: dict[str, DataFrame | StoredTable], manifest: DataFrame, channels: DataFrame, facets: set[str],
                     target: str, **options) -> None:
    """Write a selection as a collection of its own, with a checksum list."""
    chosen, subset, kept = selection_tables(tables, manifest, channels, facets, **options)
    write_collection(chosen, subset, kept, target)
    sums = checksum_inventory(manifest.sparkSession, target)
    (sums.select(F.concat("sha256", F.lit("  "), "path").alias("value"))
     .write.mode("errorifexists").text(f"{target}_sha256"))


def write_labelled(labelled: DataFrame, config: LabelConfig, manifest: DataFrame, target: str) -> None:
    """Write a labelled table and, beside it, one record per recording with the settings used."""
    write_table(labelled, f"{target}/{config.task}")
    stored = manifest.sparkSession.read.parquet(f"{target}/{config.task}")
    settings = F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in vars(config).items()]))
    (label_record(stored, config.task, manifest).withColumn("config", settings)
     .write.mode("errorifexists").json(f"{target}/record"))


