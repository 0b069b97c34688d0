"""Removal of repeated word windows behind a count-min prefilter.

A window is ``size`` consecutive words of one document.  Of the grams of ``gram`` words inside a window the one with the
smallest hash is its anchor, so equal windows have equal anchors and neighbouring windows mostly share one.  Partitions
count anchors in count-min sketches, which are merged by addition; an anchor's estimate is never below the number of
documents that hold any window with it.  Only windows whose anchor is estimated to occur twice go to the second pass,
which groups them exactly.  A sketch is sent to the tasks as one bit a cell (counted twice or more) and has a fixed
largest size; for larger inputs anchors are divided by hash among several sketches, each with scans of its own, and
beyond ``MAX_SLICES`` sketches only get more crowded: more windows pass, none is lost.

The second pass groups runs before windows.  A run is neighbouring windows of a document with one anchor, and equal
runs have equal windows: wherever a run also stands in a document with a smaller id, all its windows go.  What is left
to compare window by window is each distinct run once, in the document with its smallest id.  Which runs these are is
told to the tasks by a bit filter of fixed largest size that forgets none; a run that passes it wrongly is only
compared too.  Texts are shuffled once, and only those that lose words.

Documents with the same words are settled by digest: all but the one with the smallest id lose every window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import small_batches, stored, text_groups
from .words import mixed, sequence_hashes, span_hashes, split_words

WINDOW, GRAM = 50, 20
CELLS_PER_ANCHOR, SKETCH_ROWS = 16, 4  # a window that does not repeat passes with a probability of 0.3 % or less
MAX_CELLS = 1 << 30  # 128 MiB of bits
MAX_SLICES = 16
BLOCK = 1 << 16
CELLS_PER_KEY = 16  # a bit filter with two cells a key passes 1.4 % wrongly
PIECE = 256  # windows; only runs of periodic texts are longer, and are cut
MERGERS = 64  # partial sketches of a block are merged in so many groups first
NO_WORDS = hashlib.sha256(b"").hexdigest()


def counted(docs: DataFrame) -> DataFrame:
    """Per document: number of words, SHA-256 of its words joined by single spaces, and the first 64 bits of that as ``mark``."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_groups(batches):
            split = [t.split() for t in texts]  # for bytes, white space is exactly the separators
            digests = [_digest(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(map(len, split), pa.int64()), pa.array([d.hex() for d in digests]),
                 pa.array(map(_mark, digests), pa.int64())], names=["doc_id", "n_words", "words_sha256", "mark"])

    return small_batches(docs).mapInArrow(count, "doc_id long, n_words long, words_sha256 string, mark long")


def _digest(text: bytes) -> bytes:
    return hashlib.sha256(b" ".join(text.split())).digest()


def _mark(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "big", signed=True)


def _anchors(hashes: np.ndarray, size: int, gram: int) -> np.ndarray:
    """Anchor of the window that starts at each word, as if all words belonged to one text."""
    grams, reach = sequence_hashes(hashes, gram), size - gram + 1
    step = 1
    while step < reach:  # minimum over 2, 4, 8, ... grams, the last two overlapping
        move = min(step, reach - step)
        grams = np.minimum(grams[:-move], grams[move:])
        step += move
    return grams


class _Windows:
    """Windows of several texts that do not cross from one text into the next."""

    def __init__(self, texts: list[bytes], size: int, gram: int):
        self.size, words = size, split_words(texts)
        self.hashes, counts = words.hashes(), words.counts()
        self.per_text = np.maximum(counts - size + 1, 0)
        first = np.repeat(words.offsets[:-1] - np.cumsum(self.per_text) + self.per_text, self.per_text)
        self.at = np.arange(int(self.per_text.sum())) + first  # word at which each window starts
        self.text = np.repeat(np.arange(len(texts)), self.per_text)
        self.start = self.at - words.offsets[self.text]
        self.anchors = _anchors(self.hashes, size, gram)[self.at] if len(self.at) else np.zeros(0, np.uint64)

    def pieces(self) -> tuple[np.ndarray, np.ndarray]:
        """First window and number of windows of every run; runs beyond ``PIECE`` windows are cut there."""
        new = np.ones(len(self.at), bool)
        new[1:] = (self.anchors[1:] != self.anchors[:-1]) | (self.text[1:] != self.text[:-1])
        runs = np.flatnonzero(new)
        place = np.arange(len(new)) - runs[np.cumsum(new) - 1] if len(runs) else runs
        first = np.flatnonzero(place % PIECE == 0)
        return first, np.diff(np.append(first, len(new)))


def _cells(anchors: np.ndarray, cells: int) -> np.ndarray:
    """The cell of each anchor in every row of the sketch; rows are equal parts of the cells."""
    width, out, a = np.uint64(cells // SKETCH_ROWS), [], anchors
    for k in range(SKETCH_ROWS):
        a = mixed(a ^ np.uint64(0xA5A5A5A5))
        out.append(np.uint64(k) * width + a % width)
    return np.stack(out)


def _in_slice(anchors: np.ndarray, part: int, parts: int) -> np.ndarray:
    return (anchors >> np.uint64(40)) % np.uint64(parts) == np.uint64(part)


def _blocks(cells: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """Cells by block, each at most ``most`` times."""
    hit = np.sort(cells)
    if len(hit):
        again = np.zeros(len(hit), bool)
        again[most:] = hit[most:] == hit[:-most]
        hit = hit[~again]
        blocks = (hit // np.uint64(BLOCK)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(blocks, prepend=-1))
        parts = np.split((hit % np.uint64(BLOCK)).astype("<u2"), cuts[1:])
        lot = TaskContext.get().partitionId() % MERGERS
        yield pa.RecordBatch.from_arrays([pa.array(blocks[cuts]), pa.array([lot] * len(cuts), pa.int32()), pa.array([x.tobytes() for x in parts], pa.binary())],
                                         names=["block", "lot", "hits"])


def _flushed(cells: Iterator[np.ndarray], most: int) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = []
    for some in cells:
        held.append(some)
        if sum(map(len, held)) > 1 << 22:
            yield from _blocks(np.concatenate(held), most)
            held = []
    if held:
        yield from _blocks(np.concatenate(held), most)


def _merged(partial: DataFrame, cells: int, least: int) -> np.ndarray:
    """Bits, packed, of the cells counted ``least`` times or more by all partitions together; partial counts are added in two levels."""
    def total(table: pa.Table) -> np.ndarray:
        out = np.zeros(BLOCK, np.int64)
        for hits in table.column("hits"):
            out += np.bincount(np.frombuffer(hits.as_py(), "<u2"), minlength=BLOCK)
        return out

    def add(table: pa.Table) -> pa.Table:
        counts = np.repeat(np.arange(BLOCK, dtype="<u2"), np.minimum(total(table), least))
        return pa.table({"block": table.column("block").slice(0, 1), "hits": pa.array([counts.tobytes()], pa.binary())})

    def settle(table: pa.Table) -> pa.Table:
        return pa.table({"block": table.column("block").slice(0, 1), "bits": pa.array([np.packbits(total(table) >= least).tobytes()], pa.binary())})

    lots = partial.groupBy("block", "lot").applyInArrow(add, "block long, hits binary")
    bits = np.zeros(cells // 8, np.uint8)
    for row in lots.groupBy("block").applyInArrow(settle, "block long, bits binary").toLocalIterator():  # at most MAX_CELLS / 8 bytes in all
        bits[row.block * BLOCK // 8:(row.block + 1) * BLOCK // 8] = np.frombuffer(row.bits, np.uint8)
    return bits


def _holds(bits: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """Where the bits of all cells of a column are set."""
    at = cells.astype(np.int64)
    return ((bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=0)


def sketch(docs: DataFrame, cells: int, part: int, parts: int, size: int, gram: int) -> np.ndarray:
    """Bits of the cells that all partitions together counted twice or more, packed."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[np.ndarray]:
            for _, texts in text_groups(batches):
                w = _Windows(texts, size, gram)
                anchors = w.anchors[w.pieces()[0]]
                yield _cells(anchors[_in_slice(anchors, part, parts)], cells).ravel()
        yield from _flushed(found(), 2)

    return _merged(small_batches(docs).mapInArrow(count, "block long, lot int, hits binary"), cells, 2)


def _joint(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    return mixed(one.view(np.uint64) ^ mixed(other.view(np.uint64)))


def _filter_cells(keys: np.ndarray, cells: int) -> np.ndarray:
    return np.stack([mixed(keys ^ np.uint64(k)) % np.uint64(cells) for k in (0x5A5A5A5A, 0xC3C3C3C3)])


class _Filter:
    """Bit filter over the joint hashes of two columns of longs: it passes every pair of the frame, and few others."""

    def __init__(self, frame: DataFrame, one: str, other: str, max_cells: int):
        need = max(BLOCK, frame.count() * CELLS_PER_KEY)
        self.cells = cells = min(max_cells, 1 << (need - 1).bit_length())

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from _flushed((_filter_cells(_joint(b.column(0).to_numpy(), b.column(1).to_numpy()), cells).ravel() for b in batches), 1)

        partial = frame.select(F.col(one).cast("long"), F.col(other).cast("long")).mapInArrow(spread, "block long, lot int, hits binary")
        self.bits = frame.sparkSession.sparkContext.broadcast(_merged(partial, cells, 1))

    def passing(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        return _holds(self.bits.value, _filter_cells(_joint(one, other), self.cells))


def _lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)), pa.int32()), pa.array(values, kind))


def _each_run(batches: Iterator[pa.RecordBatch], bits: np.ndarray, cells: int, part: int, parts: int, size: int, gram: int) -> Iterator[tuple]:
    """Windows of some texts with the runs whose anchor is estimated to be repeated: windows, texts, first, n, digest, check and doc_id of each run."""
    for rows, texts in text_groups(batches):
        w = _Windows(texts, size, gram)
        first, n = w.pieces()
        keep = np.flatnonzero(_in_slice(w.anchors[first], part, parts))
        keep = keep[_holds(bits, _cells(w.anchors[first[keep]], cells))]
        if len(keep):
            first, n = first[keep], n[keep]
            begin, end = w.at[first], w.at[first] + n + size - 1
            digest = span_hashes(w.hashes, begin, end).view(np.int64)
            check = (span_hashes(mixed(w.hashes), begin, end) >> np.uint64(32)).astype(np.uint32).view(np.int32)
            yield w, texts, first, n, digest, check, rows.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)[w.text[first]]


def _marks(w: _Windows, texts: list[bytes], first: np.ndarray) -> np.ndarray:
    which, place = np.unique(w.text[first], return_inverse=True)
    return np.array([_mark(_digest(texts[i])) for i in which], np.int64)[place]


def repeated_spans(docs: DataFrame, words: int, size: int = WINDOW, gram: int = GRAM, max_cells: int = MAX_CELLS) -> DataFrame:
    """Windows whose words also start in a document with a smaller id, as (doc_id, mark, start, n): the ``n`` windows from word ``start`` on."""
    need = max(BLOCK * SKETCH_ROWS, words * 2 // (size - gram + 2) * CELLS_PER_ANCHOR)
    parts = min(MAX_SLICES, -(-need // max_cells))
    cells = min(max_cells, 1 << (-(-need // parts) - 1).bit_length())
    out = None
    for part in range(parts):
        bits = docs.sparkSession.sparkContext.broadcast(sketch(docs, cells, part, parts, size, gram))
        found = _spans_of(docs, bits, (cells, part, parts, size, gram), max_cells)
        bits.destroy()  # what was found is written
        out = found if out is None else out.unionByName(found)
    return out


def _spans_of(docs: DataFrame, bits, setting: tuple, max_cells: int) -> DataFrame:
    size = setting[-2]

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for w, texts, first, n, digest, check, ids in _each_run(batches, bits.value, *setting):
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (ids, _marks(w, texts, first), w.start[first].astype(np.int32), n.astype(np.int32), digest, check)],
                names=["doc_id", "mark", "start", "n", "digest", "check"])

    runs = stored(small_batches(docs).mapInArrow(choose, "doc_id long, mark long, start int, n int, digest long, check int"), "runs")
    firsts = stored(runs.groupBy("digest", "check").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")), "firsts")
    whole = runs.join(firsts.filter("first < last"), ["digest", "check"]).filter("doc_id > first").select("doc_id", "mark", "start", "n")

    distinct = _Filter(firsts, "digest", "first", max_cells)

    def ship(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for w, texts, first, n, digest, _, ids in _each_run(batches, bits.value, *setting):
            mine = np.flatnonzero(distinct.passing(digest, ids))
            if len(mine):
                first, n, ids = first[mine], n[mine], ids[mine]
                at = w.at[np.arange(int(n.sum())) + np.repeat(first - np.cumsum(n) + n, n)]
                keys = sequence_hashes(w.hashes, size)[at].view(np.int64)
                checks = (sequence_hashes(mixed(w.hashes), size)[at] >> np.uint64(32)).astype(np.uint32).view(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(_marks(w, texts, first)), pa.array(w.start[first].astype(np.int32)),
                     _lists(keys, n, pa.int64()), _lists(checks, n, pa.int32())], names=["doc_id", "mark", "start", "hash", "check"])

    schema = "doc_id long, mark long, start int, hash array<long>, check array<int>"
    shipped = stored(small_batches(docs).mapInArrow(ship, schema), "windows")
    windows = shipped.select("doc_id", F.inline(F.arrays_zip("hash", "check")))
    shared = stored(windows.groupBy("hash", "check").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last")
                    .select("hash", "check", "first"), "shared")
    several = _Filter(shared, "hash", "check", max_cells)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, checks = (batch.column(c).flatten().to_numpy() for c in ("hash", "check"))
            n = np.asarray(pa.compute.list_value_length(batch.column("hash")))
            row = np.repeat(np.arange(len(n)), n)
            step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            mine = np.flatnonzero(several.passing(hashes, checks.astype(np.int64)))
            row = row[mine]
            start = np.asarray(batch.column("start"))[row] + step[mine]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row)), batch.column("mark").take(pa.array(row)), pa.array(start, pa.int32()),
                 pa.array(hashes[mine]), pa.array(checks[mine])], names=["doc_id", "mark", "start", "hash", "check"])

    single = (shipped.mapInArrow(again, "doc_id long, mark long, start int, hash long, check int")
              .join(shared, ["hash", "check"]).filter("doc_id > first").select("doc_id", "mark", "start", F.lit(1).alias("n")))
    return stored(whole.unionByName(single), "spans")


def _touched(docs: DataFrame, keys: _Filter) -> DataFrame:
    """Documents that the filter of (doc_id, mark) passes, with their texts."""
    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_groups(batches):
            digests = [_digest(t) for t in texts]
            marks = np.array([_mark(d) for d in digests], np.int64)
            mine = np.flatnonzero(keys.passing(rows.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64), marks))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id").take(pa.array(mine)), pa.array(marks[mine]), pa.array([digests[i].hex() for i in mine], pa.string()),
                 pa.array([texts[i] for i in mine], pa.binary()).cast(pa.string())], names=["doc_id", "mark", "words_sha256", "text"])

    return small_batches(docs).mapInArrow(choose, "doc_id long, mark long, words_sha256 string, text string")


def _cleared(rows: DataFrame, size: int) -> DataFrame:
    """Texts without the words of the windows in ``spans``."""
    def clear(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept: list[bytes] = []
            counts: list[int] = []
            removed: list[int] = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans"), strict=True):
                words = text.encode().split()
                start, n = (spans.values.field(c).to_numpy().astype(np.int64) for c in ("start", "n"))
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, start, 1)
                np.add.at(edge, start + n - 1 + size, -1)
                stay = np.cumsum(edge)[:-1] == 0
                kept.append(b" ".join(w for w, s in zip(words, stay, strict=True) if s))
                counts.append(len(words))
                removed.append(len(words) - int(stay.sum()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), batch.column("words_sha256"),
                                              pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "words_sha256", "kept_text"])

    return small_batches(rows).mapInArrow(clear, "doc_id long, n_words long, n_removed long, words_sha256 string, kept_text string")


def without_repeats(docs: DataFrame, size: int = WINDOW, gram: int = GRAM, max_cells: int = MAX_CELLS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, words_sha256 (before) and kept_text.

    A word goes if it is covered by a window whose words also start somewhere in a document with a smaller id; windows
    are judged on the input.  ``kept_text`` holds the remaining words joined by single spaces, and is NULL where nothing
    was removed.  A NULL or empty text has no words.  Rows without doc_id lose nothing and take nothing from others;
    rows with the same doc_id are judged one by one and take nothing from each other.  Other columns are ignored, and
    an empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = stored(counted(docs), "counted")
    classes = (rows.filter(F.col("n_words") >= size).groupBy("words_sha256").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"))
               .filter("rep < last").select("words_sha256", "rep"))
    copies = stored(rows.join(classes, "words_sha256").filter("doc_id > rep").select("doc_id", "mark", "words_sha256").distinct(), "copies")
    words = rows.agg(F.sum("n_words")).first()[0] or 0
    named = docs.filter("doc_id is not null")
    spans = repeated_spans(named, words, size, gram, max_cells).join(copies, ["doc_id", "mark"], "left_anti")
    hits = stored(spans.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("start", "n")).alias("spans")), "hits")
    cleared = _cleared(_touched(named, _Filter(hits, "doc_id", "mark", max_cells)).join(hits, ["doc_id", "mark"]).select("doc_id", "words_sha256", "text", "spans"), size)
    # The rows that lose no window, or, as copies, all of them.
    rest = (rows.join(hits, ["doc_id", "mark"], "left_anti").join(copies.withColumn("copy", F.lit(True)), ["doc_id", "mark", "words_sha256"], "left")
            .select("doc_id", "n_words", F.when(F.col("copy"), F.col("n_words")).otherwise(F.lit(0)).cast("long").alias("n_removed"),
                    "words_sha256", F.when(F.col("copy"), F.lit("")).alias("kept_text")))
    return cleared.unionByName(rest)
