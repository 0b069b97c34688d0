"""Token counts by separator scan.

A flat token file holds little-endian unsigned 16-bit ids and nothing else; every document ends with one
end-of-document id.  Files are read in blocks of equal size by independent tasks that search their block for that
id.  What a block cannot know is how many documents ended before it and where the last one ended: both come from a
prefix scan over one summary row per block, in two levels (within spans of blocks, and over spans), so that no task
sees all blocks of a huge file.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import filesystem, shared_folder, small_batches, stored
from .tokens import encode, vocabulary_path

END_OF_DOCUMENT = 50_256
BLOCK_TOKENS = 1 << 21
BLOCKS_PER_SPAN = 1 << 10
INDEX = pa.schema([("path", pa.string()), ("ordinal", pa.int64()), ("doc_id", pa.int64()), ("tokens", pa.int64())])


def write_flat(docs: DataFrame, vocabulary: str | None = None, end_id: int = END_OF_DOCUMENT) -> DataFrame:
    """Write ``docs`` (doc_id, text) as flat token files, one per task, and return which document stands where.

    Rows: path, ordinal (place of the document in its file, from 0), doc_id, tokens (length of the whole file).
    A NULL or empty text is an ``end_id`` alone.  A repeated task writes a file of another name, and only files of the
    tasks that count are listed, so a lost executor leaves unlisted files at worst.
    """
    path, folder = vocabulary or vocabulary_path(), shared_folder(docs.sparkSession, "tokens")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"{folder}/tokens-{task.partitionId():06d}-{task.taskAttemptId()}.bin"
        fs, place = filesystem(name)
        out, held, total = None, [], 0
        for batch in batches:
            if out is None:
                fs.create_dir(place.rpartition("/")[0], recursive=True)
                out = fs.open_output_stream(place)
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = np.append(encode(text, path), np.uint32(end_id)).astype("<u2")
                out.write(ids.tobytes())
                held.append(doc_id)
                total += len(ids)
        if out is None:
            return
        out.close()
        for first in range(0, len(held), 10_000):
            ids = held[first:first + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(ids)), pa.array(range(first, first + len(ids)), pa.int64()),
                                              pa.array(ids, pa.int64()), pa.array([total] * len(ids), pa.int64())], schema=INDEX)

    rows = small_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    return stored(rows.mapInArrow(write, "path string, ordinal long, doc_id long, tokens long"), "token-index")


def count_tokens(files: DataFrame, end_id: int = END_OF_DOCUMENT, block: int = BLOCK_TOKENS, span: int = BLOCKS_PER_SPAN) -> DataFrame:
    """Length of every document in flat files given as (path, tokens).

    Rows: path, ordinal, start (ids before the document), n_tokens (its ids without the separator).  Ids after the last
    separator of a file form a last document without end.  Files without ids have no rows.
    """
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, number, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fs, place = filesystem(path)
                with fs.open_input_file(place) as file:
                    ids = np.frombuffer(file.read_at(2 * size, 2 * block * number), "<u2")
                ends = np.flatnonzero(ids == end_id) + block * number
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path]), pa.array([number], pa.int64()), pa.array([len(ends)], pa.int64()),
                     pa.array([ends[-1] if len(ends) else None], pa.int64()), pa.array([ends], pa.list_(pa.int64()))],
                    names=["path", "number", "n", "last", "ends"])

    blocks = (files.filter("tokens > 0")
              .select("path", "tokens", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(tokens - 1) div {block}"))).alias("number"))
              .select("path", "number", F.least(F.lit(block), F.col("tokens") - F.col("number") * block).alias("size")))
    found = stored(blocks.repartition("path", "number").mapInArrow(search, "path string, number long, n long, last long, ends array<long>"), "separators")
    spanned = found.withColumn("span", F.expr(f"number div {span}"))
    spans = spanned.groupBy("path", "span").agg(F.sum("n").alias("span_n"), F.max("last").alias("span_last"))
    above = Window.partitionBy("path").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.select("path", "span", F.coalesce(F.sum("span_n").over(above), F.lit(0)).alias("n_above"), F.max("span_last").over(above).alias("last_above"))
    before = Window.partitionBy("path", "span").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    scanned = (spanned.select("path", "span", "ends", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"), F.max("last").over(before).alias("last_before"))
               .join(carried, ["path", "span"])
               .select("path", "ends", (F.col("n_above") + F.col("n_before")).alias("first"),
                       (F.coalesce("last_before", "last_above", F.lit(-1)) + 1).alias("start")))
    ended = (scanned.select("path", "first", "start", "ends", F.posexplode("ends").alias("k", "end"))
             .select("path", (F.col("first") + F.col("k")).alias("ordinal"),
                     F.when(F.col("k") == 0, F.col("start")).otherwise(F.element_at("ends", F.greatest("k", F.lit(1))) + 1).alias("start"), "end")
             .select("path", "ordinal", "start", (F.col("end") - F.col("start")).alias("n_tokens")))
    totals = found.groupBy("path").agg(F.sum("n").alias("ordinal"), (F.coalesce(F.max("last"), F.lit(-1)) + 1).alias("start"))
    open_ended = (totals.join(files.select("path", "tokens"), "path").filter("start < tokens")
                  .select("path", "ordinal", "start", (F.col("tokens") - F.col("start")).alias("n_tokens")))
    return ended.unionByName(open_ended)
