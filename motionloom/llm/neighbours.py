"""Nearest vectors by cosine: inverted lists scanned with adaptive dimensions.

Equal vectors form a class that is indexed once and carries its smallest ids, as many as a result can show.  Unit vectors are
turned by a fixed random rotation, which spreads their length evenly over the dimensions, and assigned to the list of
their nearest centre; centres are fitted on a bounded sample (``FIT_VECTORS`` classes by hash of the id).  A list is
cut into blocks of bounded size, and the queries that probe it into chunks.  A task scans a block for a chunk column block
by column block.  After a random rotation, the share of a squared distance that falls on d of D dimensions follows a beta
distribution; a candidate whose partial distance exceeds the share that one of ``LOST`` at the query's distance so far would
exceed is abandoned.  What survives is scored in double precision on the original vectors.  Each query scans its own list
first, which gives the distance that the scan of all other probed lists starts from.  A query probes the lists nearest to it
until they are ``PROBED_SHARE`` of all lists and hold ``LEAST_CANDIDATES`` vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import batches_of, small_batches, stored

EVERY, NEAREST = 50, 5
FIT_VECTORS, ROUNDS = 50_000, 8
MAX_LISTS, PROBED_SHARE, LEAST_CANDIDATES = 4_096, 0.6, 2_048
BLOCK_VECTORS, CHUNK_QUERIES = 4_096, 256
COLUMNS, LOST = 16, 0.002


def rotation(dimensions: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64(64)).standard_normal((dimensions, dimensions)))
    return q * np.sign(np.diag(r))


def unit(vectors: np.ndarray) -> np.ndarray:
    v = vectors.astype(np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def centres(sample: np.ndarray, lists: int) -> np.ndarray:
    """Spherical k-means; a centre that loses all vectors stays."""
    found = sample[np.linspace(0, len(sample) - 1, lists).astype(int)]
    for _ in range(ROUNDS if lists > 1 else 0):
        nearest = (sample @ found.T).argmax(axis=1)
        total = np.zeros_like(found)
        np.add.at(total, nearest, sample)
        length = np.linalg.norm(total, axis=1, keepdims=True)
        found = np.where(length > 0, total / np.maximum(length, 1e-12), found)
    return found


def cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    q, v = query.astype(np.float64), vectors.astype(np.float64)
    return (v * q).sum(axis=1) / (np.sqrt((v * v).sum(axis=1)) * np.sqrt((q * q).sum()))


@lru_cache(maxsize=4096)
def allowed_share(seen: int, dimensions: int) -> float:
    """Share of a squared distance on ``seen`` of all dimensions that one in ``1 / LOST`` rotations exceeds."""
    if seen >= dimensions:
        return 1.0
    share = (np.arange(1 << 14) + 0.5) / (1 << 14)
    density = (seen / 2 - 1) * np.log(share) + ((dimensions - seen) / 2 - 1) * np.log1p(-share)
    below = np.cumsum(np.exp(density - density.max()))
    return float(share[np.searchsorted(below, (1 - LOST) * below[-1])])


def surviving(queries: np.ndarray, block: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Pairs (query, vector) of rotated unit vectors that no test abandons, and the number of dimensions read.

    ``reach`` is the squared distance of each query that still matters.
    """
    dimensions = block.shape[1]
    q, v, partial, read = None, None, None, 0
    for first in range(0, dimensions, COLUMNS):
        last = min(first + COLUMNS, dimensions)
        a, b = queries[:, first:last], block[:, first:last]
        if partial is None:
            full = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * a @ b.T
            read += full.size * (last - first)
        else:
            read += len(q) * (last - first)
            full = partial + ((a[q] - b[v]) ** 2).sum(axis=1)
        allowed = reach * allowed_share(last, dimensions) + 1e-5
        if partial is None:
            q, v = np.nonzero(full <= allowed[:, None])
            partial = full[q, v]
        else:
            stay = full <= allowed[q]
            q, v, partial = q[stay], v[stay], full[stay]
    return q, v, read


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the vectors that take part.

    Those with a NULL id, NULL, zero or of another length than most (of equally common lengths the longer counts), or with a
    NULL or non-finite component do not.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<float>"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    rows = rows.filter("vec_id is not null and embedding is not null").filter(F.coalesce(finite, F.lit(False)))
    common = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.filter(F.size("embedding") == (common["n"] if common else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _index(classes: DataFrame) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """Classes with their list and rotated vector, the centres and the rotation."""
    n = classes.count()
    lists = min(MAX_LISTS, 1 << round(math.log2(math.sqrt(n))))
    sample = classes.select("embedding").orderBy(F.xxhash64("rep"), "rep").limit(FIT_VECTORS).toArrow()
    sample = unit(_matrix(sample.column("embedding")))
    turn = rotation(sample.shape[1])
    found = centres(sample @ turn, lists)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                turned = unit(_matrix(batch.column("embedding"))) @ turn
                yield pa.RecordBatch.from_arrays([batch.column("rep"), batch.column("members"), batch.column("embedding"),
                                                  pa.array((turned @ found.T).argmax(axis=1).astype(np.int32)),
                                                  pa.array(list(turned.astype(np.float32)), pa.list_(pa.float32()))],
                                                 names=["rep", "members", "embedding", "list", "turned"])

    return small_batches(classes).mapInArrow(assign, "rep long, members array<long>, embedding array<float>, list int, turned array<float>"), found, turn


def _gathered(rows: DataFrame, key: list[str], extra: list[str]) -> DataFrame:
    """One row per key with its vectors as two binary matrices; a key has a bounded number of rows."""
    types = {"rep": "array<long>", "reach": "array<double>"}

    def gather(table: pa.Table) -> pa.Table:
        table = table.sort_by([("rep", "ascending")])
        columns = {k: pa.array([table.column(k)[0].as_py()], table.schema.field(k).type) for k in key}
        columns |= {x: pa.array([table.column(x).to_pylist()], pa.list_(table.schema.field(x).type)) for x in ["rep", *extra]}
        columns |= {m: pa.array([_matrix(table.column(m)).astype(np.float32).tobytes()], pa.binary()) for m in ("turned", "embedding")}
        return pa.table(columns)

    schema = ", ".join([*(f"{k} int" for k in key), *(f"{x} {types[x]}" for x in ["rep", *extra]), "turned binary, embedding binary"])
    return rows.groupBy(*key).applyInArrow(gather, schema)


def _scan(probes: DataFrame, blocks: DataFrame, keep: int) -> DataFrame:
    """The best ``keep`` classes of every block for every query of ``probes`` (list, rep, reach, turned, embedding)."""
    crowds = probes.groupBy("list").agg(F.ceil(F.count("*") / CHUNK_QUERIES).cast("int").alias("chunks"))
    dealt = probes.join(crowds, "list").withColumn("chunk", F.pmod(F.xxhash64("rep"), "chunks").cast("int")).drop("chunks")
    chunks = _gathered(dealt, ["list", "chunk"], ["reach"]).select("list", F.col("rep").alias("queries"), "reach", F.col("turned").alias("q_turned"), F.col("embedding").alias("q_embedding"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, reach = np.array(row["queries"]), np.array(row["reach"])
                vectors = np.array(row["rep"])
                qt, qe = (np.frombuffer(row[c], np.float32).reshape(len(ids), -1) for c in ("q_turned", "q_embedding"))
                bt, be = (np.frombuffer(row[c], np.float32).reshape(len(vectors), -1) for c in ("turned", "embedding"))
                q, v, _ = surviving(qt, bt, reach)
                out: tuple[list, list, list] = ([], [], [])
                for i, first, last in zip(*(x.tolist() for x in _ranges(q)), strict=True):
                    near = v[first:last]
                    score = cosines(qe[i], be[near])
                    best = np.lexsort((vectors[near], -score))[:keep]
                    out[0].extend([ids[i]] * len(best))
                    out[1].extend(vectors[near[best]])
                    out[2].extend(score[best])
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], names=["query", "rep", "score"])

    return chunks.join(blocks, "list").mapInArrow(scan, "query long, rep long, score double")


def _ranges(sorted_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    firsts = np.flatnonzero(np.diff(sorted_ids, prepend=-1))
    return sorted_ids[firsts], firsts, np.append(firsts, len(sorted_ids)).astype(int)[1:]


def _best(rows: DataFrame, key: str, order: list, n: int) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter(F.col("rank") <= n)


def nearest(vectors: DataFrame, every: int = EVERY, k: int = NEAREST, share: float = PROBED_SHARE) -> DataFrame:
    """The ``k`` nearest found of every vector whose id is divisible by ``every``: query_id, rank, vec_id, score.

    Order: largest cosine, then smaller vec_id.  Fewer rows come back only if there are fewer candidates.  Of rows
    with the same vec_id one counts, the one whose vector is greatest in array order.  See ``usable`` for the vectors that take no part.  An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = stored(usable(vectors).groupBy("vec_id").agg(F.max("embedding").alias("embedding")), "vectors")
    if rows.isEmpty():
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    members = rows.withColumn("k", F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))).filter(F.col("k") <= k + 1)
    classes = stored(members.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("members"))
                     .withColumn("rep", F.col("members")[0]), "classes")
    asking = stored(rows.filter(F.col("vec_id") % every == 0).join(classes.select("embedding", "rep"), "embedding").select("vec_id", "rep"), "asking")
    indexed, found, turn = _index(classes)
    indexed = stored(indexed, "index")
    sizes = indexed.groupBy("list").agg(F.count("*").alias("n"), F.ceil(F.count("*") / BLOCK_VECTORS).cast("int").alias("subs"))
    held = np.zeros(len(found), np.int64)
    for row in sizes.collect():  # a row for each list
        held[row["list"]] = row["n"]
    dealt = indexed.join(F.broadcast(sizes.drop("n")), "list").withColumn("sub", F.pmod(F.xxhash64("rep"), "subs").cast("int"))  # a row for each list
    blocks = stored(_gathered(dealt.select("list", "sub", "rep", "turned", "embedding"), ["list", "sub"], []), "blocks")
    queries = stored(indexed.join(asking.select("rep").distinct(), "rep", "left_semi").select("rep", "list", "turned", "embedding"), "queries")
    with batches_of(spark, 8):
        own = stored(_scan(queries.withColumn("reach", F.lit(4.5)), blocks, k + 1), "own")
    order = [F.desc("score"), "rep"]
    # Of a class that counts for less than k + 1 vectors, further ones may be needed, so k + 1 classes bound the distance.
    reach = (_best(own, "query", order, k + 1).groupBy("query").agg(F.when(F.count("*") == k + 1, 2 - 2 * F.min("score")).otherwise(4.5).alias("reach")))
    lists = len(found)
    probed = min(lists, max(1, math.ceil(lists * share)))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = np.argsort(-(_matrix(batch.column("turned")) @ found.T), axis=1, kind="stable").astype(np.int32)
                before = np.cumsum(held[near], axis=1) - held[near]
                taken = [row[(np.arange(lists) < probed) | (seen < LEAST_CANDIDATES)] for row, seen in zip(near, before, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(taken, pa.list_(pa.int32()))], names=["rep", "lists"])

    others = small_batches(queries.select("rep", "turned")).mapInArrow(probe, "rep long, lists array<int>").select("rep", F.explode("lists").alias("list"))
    probes = (others.join(queries.withColumnRenamed("list", "own"), "rep").filter("list <> own").drop("own")
              .join(reach.withColumnRenamed("query", "rep"), "rep", "left").select("list", "rep", F.coalesce("reach", F.lit(4.5)).alias("reach"), "turned", "embedding"))
    with batches_of(spark, 8):
        scored = stored(_best(own.unionByName(_scan(probes, blocks, k + 1)).distinct(), "query", order, 2 * (k + 1)).drop("rank"), "scored")
    shown = (asking.join(scored.withColumnRenamed("rep", "found"), F.col("rep") == F.col("query"))
             .join(classes.select(F.col("rep").alias("found"), "members"), "found")
             .select(F.col("vec_id").alias("query_id"), F.explode("members").alias("vec_id"), "score").filter("query_id <> vec_id"))
    return _best(shown, "query_id", [F.desc("score"), "vec_id"], k).select("query_id", "rank", "vec_id", "score")
