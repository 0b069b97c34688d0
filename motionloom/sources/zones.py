"""Zone maps: which recording lies in which file of a stored table, and over what time.

``write_zones`` is run once after a table is written and reads its id and time columns only.  The map has a row for each recording and
file, so it is about as long as the manifest.  Loading joins the asked-for ids with it and opens the files found, and questions about what
a table holds are answered from it without reading rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..operators.layout import attach

ZONES = "_zones"  # below the table's folder; scans skip names that start so


def without_nan(df: DataFrame) -> DataFrame:
    """NaN and NULL are one missing value in the data model; keep only NULL."""
    return df.withColumns({name: F.when(~F.isnan(name), F.col(name))
                           for name, kind in df.dtypes if kind in ("double", "float")})


def measured_zones(spark: SparkSession, path: str) -> DataFrame:
    """(recording_id, file, bytes, rows, t_first_ns, t_last_ns) of a table, from its id and time columns.

    ``file`` is relative to ``path``, so the map stays right when the table is moved.
    """
    table = spark.read.parquet(path)
    start, end = ("t_start_ns", "t_end_ns") if "t_start_ns" in table.columns else ("t_ns", "t_ns")
    return table.select("recording_id", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("bytes"),
                        F.col(start).alias("_start"), F.col(end).alias("_end")).groupBy("recording_id", "file", "bytes").agg(
        F.count("*").alias("rows"), F.min("_start").alias("t_first_ns"), F.max("_end").alias("t_last_ns"))


def write_zones(spark: SparkSession, path: str) -> None:
    measured_zones(spark, path).write.mode("overwrite").parquet(f"{path}/{ZONES}")


@dataclass(frozen=True)
class StoredTable:
    """One of this library's tables on disk, opened file by file."""

    spark: SparkSession
    path: str

    @property
    def columns(self) -> list[str]:
        return self.spark.read.parquet(self.path).columns

    def zones(self) -> DataFrame:
        """The stored zone map; a table written without one is measured."""
        try:
            return self.spark.read.parquet(f"{self.path}/{ZONES}")
        except AnalysisException:
            return measured_zones(self.spark, self.path)

    def frame(self) -> DataFrame:
        return without_nan(self.spark.read.parquet(self.path))

    def files_of(self, ids: DataFrame, t_from_ns: int | None = None, t_to_ns: int | None = None) -> list[str]:
        """Files that hold rows of the recordings, and of the time asked for; not more than the table has."""
        held = self.zones().join(ids.select("recording_id"), "recording_id", "left_semi")
        if t_from_ns is not None:
            held = held.where(F.col("t_last_ns") >= t_from_ns)
        if t_to_ns is not None:
            held = held.where(F.col("t_first_ns") <= t_to_ns)
        return sorted(f"{self.path}/{r['file']}" for r in held.select("file").distinct().collect())

    def near(self, ids: DataFrame, t_from_ns: int | None = None, t_to_ns: int | None = None) -> DataFrame:
        """All rows of the files that hold what is asked for."""
        whole, files = self.spark.read.parquet(self.path), self.files_of(ids, t_from_ns, t_to_ns)
        return without_nan(self.spark.read.schema(whole.schema).parquet(*files)) if files else self.spark.createDataFrame([], whole.schema)


def rows_of(table: DataFrame | StoredTable, ids: DataFrame) -> DataFrame:
    """Rows of the recordings in ``ids``, once for each time an id is listed, with the further columns of ``ids``."""
    return attach(table.near(ids) if isinstance(table, StoredTable) else table, ids, ["recording_id"], "inner")


def recordings_of(table: DataFrame | StoredTable) -> DataFrame:
    """recording_id of every recording that has rows; of a stored table without reading any."""
    return (table.zones() if isinstance(table, StoredTable) else table).select("recording_id").distinct()
