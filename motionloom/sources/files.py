"""Lines, CSV rows and paths of whole directories of source files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..operators.layout import along, attach, durable, ordered, running_max, running_sum

_ROW_BITS = (1 << 33) - 1


def path_part(path: Column, pattern: str, group: int = 1) -> Column:
    """Part of a file path by pattern; NULL when it does not match."""
    return F.nullif(F.regexp_extract(path, pattern, group), F.lit(""))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, seq, line) of every line below ``path``; ``seq`` follows the order inside each file.

    A split adds its own offset to the row number of its task.  A full split fills a task alone and
    has fewer rows than bytes, so numbers of later splits are always higher.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"),
        (F.col("_metadata.file_block_start")
         + F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))).alias("seq"),
        F.col("value").alias("line"))


def existing_lines(spark: SparkSession, path: str) -> DataFrame:
    """``lines``, or no rows where nothing matches the path."""
    try:
        return lines(spark, path)
    except AnalysisException:
        return spark.createDataFrame([], "path string, seq bigint, line string")


def _quotes(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))


def _headers(rows: DataFrame) -> DataFrame:
    """Per file: header names, where the header stands, number of quotes, and whether a quoted value runs over line ends."""
    quotes = _quotes(F.col("line"))
    first = rows.groupBy("path").agg(F.min_by("line", "seq").alias("_head"), F.min("seq").alias("_first"),
                                     F.sum(quotes).alias("_quotes"), F.max(quotes % 2 == 1).alias("_broken"))
    names = F.transform(F.split(F.regexp_replace("_head", "\r$", ""), ","),
                        lambda c: F.trim(F.regexp_replace(c, '^"|"$', "")))
    return first.select("path", "_first", "_quotes", "_broken", names.alias("_names"))


def joined_lines(rows: DataFrame) -> DataFrame:
    """``lines`` with the pieces of quoted values that run over line ends put together again, with a line feed between.

    A line belongs to the record before it if an odd number of quotes stands above it in its file.  That number is a
    running sum along the file, so a file is not read by one task, however long it is.
    """
    layout = ordered(rows.select("path", "seq", "line", (_quotes(F.col("line")) % 2).cast("bigint").alias("_odd")), ("path",), ("seq",))
    layout = along(layout, _upto=running_sum(F.col("_odd")))
    begins = F.when((F.col("_upto") - F.col("_odd")) % 2 == 0, F.col("seq"))
    records = along(layout, _record=running_max(begins)).frame
    pieces = F.sort_array(F.collect_list(F.struct("seq", "line")))
    return records.groupBy("path", F.col("_record").alias("seq")).agg(
        F.array_join(F.transform(pieces, lambda p: p["line"]), "\n").alias("line"))


def csv_rows(spark: SparkSession, path: str, columns: list[str], required: tuple[str, ...] = ()) -> DataFrame:
    """(path, seq, columns...) of all CSV files below ``path``; every value is text, blank is NULL.

    Exports of one kind differ in their optional columns, so values are matched to each file's own
    header, and a column a file lacks is NULL there.  Quoted values may hold commas, doubled quotes and
    line ends (read as line feeds); a file whose quotes do not pair is refused.  Files are parsed once:
    the rows are written out, and the checks and tables built on them read that.
    """
    rows = existing_lines(spark, path)
    heads = durable(_headers(rows))
    if required:
        lacking = heads.where(F.size(F.array_except(F.array(*[F.lit(c) for c in required]), "_names")) > 0)
        bad = lacking.take(3)
        if bad:
            raise ValueError("missing required column(s) "
                             + "; ".join(f"{r['path']}: {sorted(set(required) - set(r['_names']))}" for r in bad))
    bad = heads.where(F.col("_quotes") % 2 == 1).take(3)
    if bad:
        raise ValueError("quotes that do not pair in " + "; ".join(r["path"] for r in bad))
    facts = heads.agg(F.max(F.size("_names")), F.max("_broken")).first()
    body = attach(rows, heads, ["path"], "inner").where(F.col("seq") > F.col("_first"))
    records = body.where(~F.col("_broken")).select("path", "seq", "_names", "line")
    if facts[1]:
        again = joined_lines(body.where("_broken").select("path", "seq", "line"))
        records = records.unionByName(attach(again, heads.select("path", "_names"), ["path"], "inner")
                                      .select("path", "seq", "_names", "line"))
    names = [f"c{i}" for i in range(facts[0] or 1)]
    fields = F.from_csv(F.regexp_replace("line", "\r$", ""), ", ".join(f"{n} string" for n in names), {"escape": '"'})
    body = (records.where(F.trim(F.regexp_replace("line", "\r$", "")) != "").select("path", "seq", "_names", fields.alias("_f"))
            .select("path", "seq", "_names", F.array(*[F.col(f"_f.{n}") for n in names]).alias("_values")))

    def value(name):
        position = F.array_position("_names", name).cast("int")
        return F.when(position > 0, F.nullif(F.trim(F.try_element_at("_values", position)), F.lit("")))
    return durable(body.select("path", "seq", *[value(c).alias(c) for c in columns]))


def file_names(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of every file matching ``path``; contents are not read."""
    try:
        return spark.read.format("binaryFile").load(path).select("path", "length")
    except AnalysisException:
        return spark.createDataFrame([], "path string, length bigint")
