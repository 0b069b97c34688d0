"""Publishing a collection in two phases: everything is staged, read back and checked; only then does it count.

Below the root, ``releases/<name>`` holds the tables, manifest and channels of a release with a checksum list beside it,
``reports/<name>`` the findings on it, and ``committed/<name>`` one line for a release that passed.  Spark's own commit of that line is
the moment of publication, so a driver that is lost before leaves a staged folder that nobody reads.  A refused release leaves its report alone.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..plans.manifest import refuse
from ..plans.validate import FINDING, failed, validate_archive
from ..vocabulary import MODALITIES
from .bundle import scan_channels, scan_manifest, scan_modality
from .sinks import checksum_inventory, checksum_problems, parse_checksum_list, write_collection

REPORT = "check string, recording_id string, modality string, `column` string, observed string, observed_num double, expected string, passed boolean"


def _discard(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def audit(spark: SparkSession, release: str, withdrawn: DataFrame | None = None) -> DataFrame:
    """Findings on a staged or published release from its files alone, checksums included.

    A contradiction in its structure, which :func:`validate_archive` raises for, is one failed finding here.
    """
    listed = parse_checksum_list(spark.read.text(f"{release}_sha256").withColumnRenamed("value", "line"))
    problems = checksum_problems(listed, checksum_inventory(spark, release))
    tables = {}
    for modality in MODALITIES:
        try:
            tables[modality] = scan_modality(spark, release, modality)
        except AnalysisException:
            continue
    try:
        return validate_archive(scan_manifest(spark, release), scan_channels(spark, release), tables, withdrawn=withdrawn, checksums=problems)
    except ValueError as contradiction:
        return spark.createDataFrame([("structure", "-", "-", "-", str(contradiction), None, "tables, manifest and channels agree", False)], REPORT).select(*FINDING)


def publish(tables: dict[str, DataFrame], manifest: DataFrame, channels: DataFrame, root: str, *, withdrawn: DataFrame | None = None) -> str:
    """Publish a collection and return where it lies; raise if any finding failed, which then keeps the report alone."""
    spark = manifest.sparkSession
    name = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"  # names sort by time
    release = f"{root}/releases/{name}"
    write_collection(tables, manifest, channels, release)
    checksum_inventory(spark, release).select(F.concat("sha256", F.lit("  "), "path").alias("value")).write.text(f"{release}_sha256")
    audit(spark, release, withdrawn).write.parquet(f"{root}/reports/{name}")
    report = spark.read.parquet(f"{root}/reports/{name}")
    bad = failed(report).select("check", "recording_id", "modality", "observed")
    if not bad.isEmpty():
        _discard(spark, release)
        _discard(spark, f"{release}_sha256")
        refuse(bad, f"nothing was published, see {root}/reports/{name}")
    spark.createDataFrame([(name,)], "value string").coalesce(1).write.text(f"{root}/committed/{name}")
    return release


def published(spark: SparkSession, root: str) -> str | None:
    """Where the latest published release lies."""
    try:
        name = spark.read.option("recursiveFileLookup", True).text(f"{root}/committed").agg(F.max("value")).first()[0]
    except AnalysisException:
        return None
    return name and f"{root}/releases/{name}"


def latest_report(spark: SparkSession, root: str) -> DataFrame:
    """Findings of the last attempt to publish, whether it was refused or not."""
    place = F.col("_metadata.file_path")
    rows = spark.read.schema(REPORT).option("recursiveFileLookup", True).parquet(f"{root}/reports").withColumn("_attempt", F.regexp_extract(place, r"/reports/([^/]+)/", 1))
    latest = rows.agg(F.max("_attempt")).first()[0]
    return rows.where(F.col("_attempt") == F.lit(latest)).select(*FINDING)
