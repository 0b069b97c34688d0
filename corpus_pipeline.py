"""From raw documents to packed token sequences: five stages, each written as Parquet before the next reads it.

A stage takes (spark, docs, sf_dir), works on every row that its predecessor kept and, but for the last, returns the columns of
``docs``.  NULL texts and ids, repeated rows, empty tables and further columns of any name are handled as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motionloom.llm import decontamination, language, minmax, packing, secrets
from motionloom.llm.tables import read, shared_folder, stored

#: A document goes if it has no letters or no language is likelier than this.
LEAST_SCORE = 0.3


def _aside(docs: DataFrame, *needed: str) -> DataFrame:
    """``docs`` with all columns but the needed ones under names that no operator uses."""
    return docs.select(*(docs[c].alias(c if c in needed else f"_aside_{c}") for c in docs.columns))


def _back(made: DataFrame, docs: DataFrame, *needed: str) -> DataFrame:
    return made.select(*(made[c if c in needed else f"_aside_{c}"].alias(c) for c in docs.columns))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in one of the languages that ``lang`` teaches; the label itself decides nothing.

    If nothing can be learned, since no document has a language, all documents with letters stay.
    """
    model = language.train(docs)
    scored = language.predict(_aside(docs, "doc_id", "text"), model)
    keep = F.col("text").rlike(r"\p{L}") if model is None else (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return _back(scored.filter(keep), docs, "doc_id", "text")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest doc_id, and of several rows with that id the one that sorts first."""
    found = stored(minmax.near_duplicates(docs).select("doc_id", "kept"), "decisions")
    named = found.filter("doc_id is not null")
    # Both tables are written first: the planner then knows their size and moves texts only if they are large.
    dropped = stored(named.filter("not kept").select("doc_id").distinct(), "dropped")
    repeated = stored(named.filter("kept").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated")
    kept = docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
    once = kept.join(repeated, "doc_id", "left_anti").select(*docs.columns)
    first = kept.join(repeated, "doc_id", "left_semi").groupBy(kept["doc_id"].alias("_aside_id")).agg(F.min(F.struct("text", *(c for c in docs.columns if c != "text"))).alias("_aside_row"))
    return once.unionByName(first.select(*(F.col("_aside_row")[c].alias(c) for c in docs.columns)))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any item of the benchmark."""
    found = decontamination.with_matches(_aside(docs, "text"), read(spark, sf_dir, "benchmark"))
    return _back(found.filter(F.size("matches") == 0), docs, "text")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a placeholder and ``n_chars`` counted anew."""
    made = secrets.redacted(docs)
    if "n_chars" in docs.columns:
        made = made.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars").cast("long")))
    return made.select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 ids."""
    return packing.pack(docs).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


STAGES = [("language", identify_language), ("near_duplicates", drop_near_duplicates), ("decontamination", decontaminate),
          ("secrets", redact_secrets), ("packing", pack_sequences)]
#: SQL cannot express learned weights, a randomised decomposition or packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        made, path = stage(spark, docs, sf_dir), shared_folder(spark, name)
        made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
    return docs
