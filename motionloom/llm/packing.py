"""Best-fit packing by sum of squares.

Documents become pieces of at most ``limit`` token ids: only longer documents are cut, from their end, so the
first piece may be shorter.  Pieces are dealt by document to tasks of bounded size and placed there in
descending length: into the open sequence for which the sum, over all residual gaps, of the squared number of open
sequences with that gap becomes smallest; ties go to the tighter gap, and a new sequence is opened only if the piece
fits nowhere.  A task keeps one count and one stack of sequence numbers per gap; ids only stream through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import ratio, small_batches
from .tokens import encode_with_added, vocabulary_path

PIECES = "doc_id long, piece int, start long, length long, ids binary"
PACKED = f"{PIECES}, sequence_id long, offset long"
#: Documents dealt to one packing task; what a task leaves open at its end is a few sequences.
DOCUMENTS_PER_TASK = 20_000


def cuts(n: int, limit: int) -> list[tuple[int, int]]:
    """Start and length of each piece of ``n`` ids: the first takes the remainder."""
    first = n if n <= limit else n % limit or limit
    return [(0, first), *((start, limit) for start in range(first, n, limit))]


def pieces(docs: DataFrame, limit: int = 2048, end_id: int = 0, vocabulary: str | None = None) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) with their ids as little-endian unsigned 32-bit numbers.

    Added tokens of the vocabulary that occur in a text keep their ids.  A NULL or empty text is ``end_id`` alone.  Repeated rows and NULL ids are documents like any other; other
    columns are ignored.  An empty table has no pieces.
    """
    path = vocabulary or vocabulary_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = np.append(encode_with_added(text, path), np.uint32(end_id)).astype("<u4")
                for k, (start, length) in enumerate(cuts(len(ids), limit)):
                    rows.append((doc_id, k, start, length, ids[start:start + length].tobytes()))
                    held += length
                    if held > 1 << 20:
                        yield _batch(rows, PIECE_SCHEMA)
                        rows, held = [], 0
            if rows:
                yield _batch(rows, PIECE_SCHEMA)

    return small_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))).mapInArrow(cut, PIECES)


PIECE_SCHEMA = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                          ("ids", pa.binary())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


class OpenSequences:
    """Open sequences by residual gap."""

    def __init__(self, limit: int, first_id: int):
        self.limit, self.next_id = limit, first_id
        self.counts = np.zeros(limit + 1, np.int64)  # gap 0 is closed and stays out of the sum
        self.stacks: list[list[int]] = [[] for _ in range(limit + 1)]

    def place(self, length: int) -> tuple[int, int]:
        """Sequence and offset for a piece."""
        have = self.counts[length:self.limit]
        # Moving one sequence from gap h to h - length changes the sum by 2 * (N[h - length] - N[h]) + 2; a filled one leaves it.
        change = 2 * (self.counts[:self.limit - length] - have) + 2
        if len(change):
            change[0] -= 1
        change[have == 0] = np.iinfo(np.int64).max
        best = int(np.argmin(change)) if len(change) else 0
        if len(change) and have[best]:
            gap = length + best
            sequence = self.stacks[gap].pop()
            self.counts[gap] -= 1
        else:
            gap, sequence = self.limit, self.next_id
            self.next_id += 1
        if gap > length:
            self.stacks[gap - length].append(sequence)
            self.counts[gap - length] += 1
        return sequence, self.limit - gap


def packed(parts: DataFrame, documents: int, limit: int = 2048, per_task: int = DOCUMENTS_PER_TASK) -> DataFrame:
    """Place ``parts`` (as ``pieces`` gives them, of about ``documents`` documents) into sequences of ``limit`` ids.

    Sequence ids are unique, not consecutive.  The pieces of a sequence follow each other without gaps.
    """
    n = ratio(documents, per_task)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = None
        for batch in batches:
            if bins is None:
                bins = OpenSequences(limit, batch.column("_part")[0].as_py() << 32)
            placed = [bins.place(length) for length in batch.column("length").to_pylist()]
            kept = batch.select(PIECE_SCHEMA.names)
            yield pa.RecordBatch.from_arrays([*kept.columns, *(pa.array(c, pa.int64()) for c in zip(*placed, strict=True))],
                                             names=[*PIECE_SCHEMA.names, "sequence_id", "offset"])

    dealt = (small_batches(parts).repartition(n, F.xxhash64("doc_id", "length"))
             .sortWithinPartitions(F.desc("length"), "doc_id", "start")
             .withColumn("_part", F.spark_partition_id().cast("long")))
    return dealt.mapInArrow(place, PACKED)


def pack(docs: DataFrame, limit: int = 2048, end_id: int = 0, vocabulary: str | None = None) -> DataFrame:
    """Token sequences of ``docs``: one row per piece with its ids, sequence and offset."""
    return packed(pieces(docs, limit, end_id, vocabulary), docs.count(), limit)
