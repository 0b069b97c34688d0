"""Importance resampling towards a target text collection, with hashed word n-grams and a position-table CRC.

A feature is a run of one to three consecutive words joined by one space, and its bucket is its CRC-32 modulo ``BUCKETS``.  CRC-32 is
linear over bits: the checksum of a span is the exclusive or of one contribution for each byte, which depends on the byte and its
distance from the span's end alone, and of a constant for the length.  The words of many texts are therefore laid out once with single
spaces between them, all spans are expanded to their bytes, contributions are looked up in one table, and ``bitwise_xor.reduceat`` folds
them.  A span longer than the table goes block by block: what is folded so far is moved on by a block's length, a linear map of its four
bytes, before the next block is added.

Buckets are counted over all documents and all target texts (one map each, a row for each bucket and task), gains follow from the
counts, and a second map sums them over each document.  Texts are never shuffled.  Perturbing scores by Gumbel noise from a hash of
the id turns the highest scores into a draw without replacement.  Ranks come from one range sort of narrow rows: a row's place is its
position in its task plus the sizes of the tasks before it, so nothing is ranked in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import small_batches, stored, text_groups
from .words import Words, split_words

BUCKETS, LONGEST_RUN = 10_000, 3
PERCENT, LEAST_WORDS, SEED = 5, 20, 42
#: Bytes of a span that one look-up covers, and expanded bytes handled at once.
BLOCK, STEP = 256, 1 << 17
POLYNOMIAL, ONES = 0xEDB88320, np.uint32(0xFFFFFFFF)  # fixed values of CRC-32

_BYTES = np.arange(256)
_LETTER = (_BYTES >= 0x61) & (_BYTES <= 0x7A) | (_BYTES >= 0x41) & (_BYTES <= 0x5A)
BETWEEN = ~(_LETTER | (_BYTES >= 0x30) & (_BYTES <= 0x39) | (_BYTES >= 0x80))
_LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contributions by distance from the end and byte, registers of all ones moved on by 0 to BLOCK bytes, and the map that moves a
    register on by BLOCK bytes, for each of its four bytes."""
    single = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        single = (single >> np.uint32(1)) ^ np.where(single & 1, np.uint32(POLYNOMIAL), np.uint32(0))

    def moved(register: np.ndarray) -> np.ndarray:
        return (register >> np.uint32(8)) ^ single[register & 255]

    place, started = [single], [np.array([ONES])]
    moving = np.arange(256, dtype=np.uint32)[None, :] << np.array([[0], [8], [16], [24]], np.uint32)
    for _ in range(BLOCK):
        place.append(moved(place[-1]))
        started.append(moved(started[-1]))
        moving = moved(moving)
    return np.concatenate(place[:BLOCK]), np.concatenate(started), moving


def _folded(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Exclusive or of the contributions of spans of 1 to BLOCK bytes."""
    place = _tables()[0]
    lengths = ends - starts
    firsts = np.cumsum(lengths) - lengths
    at = np.arange(int(lengths.sum()), dtype=np.int32)  # a slice's bytes, far fewer than 2**31
    distance = np.repeat((firsts + lengths - 1).astype(np.int32), lengths) - at
    at += np.repeat((starts - firsts).astype(np.int32), lengths)
    distance <<= 8
    distance |= buffer[at]
    return np.bitwise_xor.reduceat(place.take(distance), firsts)


def span_crcs(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of the bytes of every span (none empty)."""
    started, moving = _tables()[1:]
    lengths = ends - starts
    out = np.empty(len(starts), np.uint32)
    short = np.flatnonzero(lengths <= BLOCK)
    steps = np.searchsorted(np.cumsum(lengths[short]), np.arange(STEP, int(lengths[short].sum()) + STEP, STEP))
    for part in np.split(short, steps):
        if len(part):
            out[part] = _folded(buffer, starts[part], ends[part]) ^ started[lengths[part]]
    long = np.flatnonzero(lengths > BLOCK)
    for part in np.split(long, np.arange(STEP // BLOCK, len(long), STEP // BLOCK)):
        if not len(part):
            continue
        head = (lengths[part] - 1) % BLOCK + 1  # the first block holds what does not fill one
        at = starts[part] + head
        register = _folded(buffer, starts[part], at) ^ started[head]
        left = np.arange(len(part))
        while len(left := left[at[left] < ends[part][left]]):
            r = register[left]
            r = moving[0][r & 255] ^ moving[1][(r >> np.uint32(8)) & 255] ^ moving[2][(r >> np.uint32(16)) & 255] ^ moving[3][r >> np.uint32(24)]
            register[left] = r ^ _folded(buffer, at[left], at[left] + BLOCK)
            at[left] += BLOCK
        out[part] = register
    return out ^ ONES


def buckets(texts: list[bytes]) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words, and bucket and text number of every feature of ``texts``."""
    words = split_words(texts, BETWEEN)
    lengths = words.ends - words.starts
    n = len(lengths)
    starts = np.cumsum(lengths + 1) - (lengths + 1)
    laid = np.full(int((lengths + 1).sum()), 0x20, np.uint8)
    laid[np.arange(int(lengths.sum())) + np.repeat(np.arange(n), lengths)] = _LOWER[words.buffer[~BETWEEN[words.buffer]]]
    text_of = np.repeat(np.arange(len(texts)), words.counts())
    numbers, owners = [], []
    for run in range(1, LONGEST_RUN + 1):
        first = np.flatnonzero(text_of[:n - run + 1] == text_of[run - 1:]) if n >= run else np.zeros(0, int)
        numbers.append(span_crcs(laid, starts[first], starts[first + run - 1] + lengths[first + run - 1]) % BUCKETS)
        owners.append(text_of[first])
    return words, np.concatenate(numbers).astype(np.int64), np.concatenate(owners)


def counted(texts: DataFrame) -> np.ndarray:
    """Features in each bucket over all rows of ``texts`` (text; NULL: none)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for _, raw in text_groups(batches):
            total += np.bincount(buckets(raw)[1], minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["bucket", "n"])

    rows = small_batches(texts.select(F.col("text").cast("string"))).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for row in rows.collect():  # at most BUCKETS
        out[row["bucket"]] = row["n"]
    return out


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed shares, rounded down."""
    t, s = target.astype(float), documents.astype(float)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS)))).astype(np.int64)


def weighed(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row of ``docs``."""
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in text_groups(batches):
            words, numbers, owners = buckets(raw)
            order = np.argsort(owners, kind="stable")
            running = np.concatenate([[0], np.cumsum(gain[numbers[order]])])
            upto = np.searchsorted(owners[order], np.arange(len(raw) + 1))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(words.counts().astype(np.int64)), pa.array(np.diff(upto).astype(np.int64)),
                                              pa.array(np.diff(running[upto]))], names=["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return small_batches(rows).mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def with_places(rows: DataFrame, order: list, name: str) -> DataFrame:
    """``rows`` with their place (from 1) in the whole order.  A written ``rows`` gives rows that tie a fixed order."""
    numbered = rows.withColumn("_tie", F.monotonically_increasing_id())
    laid = numbered.repartitionByRange(*order, F.col("_tie")).sortWithinPartitions(*order, "_tie").drop("_tie")
    laid = stored(laid.withColumn("_at", F.monotonically_increasing_id()), "places")  # task number << 33 | place in the task
    task = F.shiftright("_at", 33)
    before, total = [], 0
    for row in laid.groupBy(task.alias("_task")).count().orderBy("_task").collect():  # a row for each task
        before.append((row["_task"], total))
        total += row["count"]
    offsets = laid.sparkSession.createDataFrame(before, "_task long, _before long")
    placed = laid.withColumn("_task", task).join(F.broadcast(offsets), "_task")
    return placed.withColumn(name, F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1).drop("_at", "_task", "_before")


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with n_words, n_features, weight, score and rank; drawn are the rows with a rank.

    Of the N rows with at least ``least_words`` words, the ``percent * N // 100`` highest scores are drawn; ties go to the smaller
    doc_id, then to fewer features, and rows equal in these are interchangeable.  NULL and empty texts have no features and
    weight 0.  A NULL id has a NULL score and is never drawn.  Repeated rows count as often as they occur, in the buckets too.
    Words of any length are taken whole.  Other columns of ``docs`` and ``target`` are ignored; an empty table gives an empty
    result, and an empty target leaves smoothed gains.
    """
    gain = gains(counted(docs), counted(target))
    noise = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10).cast("double")
    score = F.col("weight") + F.floor(-1000 * F.log(-F.log((noise + 0.5) / 4294967296.0)))
    rows = stored(weighed(docs, gain).withColumn("score", score), "weighed")
    asking = rows.filter(F.col("n_words") >= least_words)
    drawn = asking.count() * percent // 100
    joins = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    placed = with_places(rows.filter(joins), [F.desc("score"), F.asc("doc_id"), F.asc("n_features"), F.asc("weight")], "place")
    ranked = placed.withColumn("rank", F.when(F.col("place") <= drawn, F.col("place"))).drop("place")
    return ranked.unionByName(rows.filter(~joins).withColumn("rank", F.lit(None).cast("long")))


def drawn_documents(docs: DataFrame, ranked: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id was drawn in ``ranked``, the result of :func:`resampled`, all columns kept; all rows of a repeated id come together."""
    return docs.join(ranked.filter("rank is not null").select("doc_id").distinct(), "doc_id", "left_semi").select(*docs.columns)
