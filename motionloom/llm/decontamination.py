"""Benchmark decontamination by latent semantic retrieval.

Items and windows of documents are TF-IDF vectors over the benchmark's words; document frequencies come from all
documents.  The latent space is spanned by the leading right singular vectors of the TF-IDF matrix of passages (all items
and all passages of all documents), found by a randomised SVD whose passes over the matrix are Spark jobs that add up matrices of
fixed size: texts are split once, what is kept of them are the numbers of the benchmark's words in each passage.  Coordinates are
divided by the singular values, so that strong directions do not drown the others; the squares are raised by their median first,
so that weak ones are not blown up.

Every window of every document is searched: windows of the size class next to an item's length, at strides of a third,
come from differences of one running sum of word vectors, and one matrix product gives their cosines with the items of that
class.  Since 64 directions cannot hold every item of a block, least of all those of rare words, a second path loses none:
an item that occurs must show some of its rarest words, so every start near enough of them is a candidate too (``_rare``).
Candidates are confirmed in place: the longest common subsequence of the item and the words around the window must
cover a share of the item, and of its answer (its last sentence, or its last quarter if it has one sentence).

Nothing is shuffled but counts.  The benchmark is searched in blocks of bounded size.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import groups, small_batches, stored
from .words import Words, split_words

ITEMS_PER_BLOCK = 1_000
PASSAGE, PASSAGES_PER_STEP, DENSE_TERMS, WORDS_PER_SLAB = 40, 2_048, 256, 128
RANK, OVERSAMPLING, POWER_ITERATIONS = 64, 8, 2
SMALLEST_WINDOW, WINDOW_RATIO, STRIDES = 12, 1.5, 3
CANDIDATE_COSINE, WEIGHT_SHARE = 0.45, 0.35
ITEM_SHARE, ANSWER_SHARE = 0.6, 0.5
RARE_SURPLUS, ITEMS_PER_PASS, STARTS_PER_PASS = 0.15, 128, 1 << 15
WORDS_PER_SUM = 32
GROUP_BYTES, PASSAGE_BYTES = 1 << 18, 1 << 16
_SEPARATOR = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
MATCHES = "array<struct<item_id:long,item_share:double,answer_share:double,cosine:double,word:long>>"
_MATCH = pa.list_(pa.struct([("item_id", pa.int64()), ("item_share", pa.float64()), ("answer_share", pa.float64()), ("cosine", pa.float64()), ("word", pa.int64())]))


def words_of(texts: list[str]) -> tuple[Words, np.ndarray]:
    """Words of lower-cased texts, ASCII punctuation separating them, and their hashes."""
    words = split_words([t.lower().encode("utf-8", "replace") for t in texts], _SEPARATOR)
    return words, words.hashes()


def answer_of(text: str) -> str:
    sentences = [s for s in re.split(r"(?<=[.?!])\s+", text.strip()) if s.strip(" .?!\n")]
    if len(sentences) > 1:
        return sentences[-1]
    parts = text.split()
    return " ".join(parts[-max(1, len(parts) // 4):])


class Sequence:
    """A word sequence prepared for longest common subsequences with others."""

    def __init__(self, hashes: list[int]):
        self.length, self.places = len(hashes), {}
        for k, h in enumerate(hashes):
            self.places[h] = self.places.get(h, 0) | 1 << k

    def common(self, others: list[int]) -> int:
        """Length of the longest common subsequence: one row of the table in the bits of an integer."""
        full = (1 << self.length) - 1
        row = full
        for h in others:
            if mask := self.places.get(h):
                match = row & mask
                row = (row + match | row - match) & full
        return self.length - row.bit_count()


@dataclass(frozen=True)
class Items:
    """A block of benchmark items with at least one word each."""

    ids: list[int | None]
    lengths: np.ndarray
    hashes: list[list[int]]
    answers: list[list[int]]
    vocabulary: np.ndarray
    slots: np.ndarray  # where the words of each leading 16 bits begin in the vocabulary, which is sorted

    @staticmethod
    def of(rows: list[tuple[int | None, str]]) -> Items:
        words, hashes = words_of([t for _, t in rows])
        split = [hashes[a:b] for a, b in zip(words.offsets[:-1], words.offsets[1:], strict=True)]
        kept = [i for i, h in enumerate(split) if len(h)]
        answer_words, answer_hashes = words_of([answer_of(rows[i][1]) for i in kept])
        vocabulary = np.unique(hashes)
        slots = np.searchsorted(vocabulary >> np.uint64(48), np.arange((1 << 16) + 1, dtype=np.uint64)).astype(np.int32)
        return Items([rows[i][0] for i in kept], np.array([len(split[i]) for i in kept], int), [split[i].tolist() for i in kept],
                     [answer_hashes[a:b].tolist() for a, b in zip(answer_words.offsets[:-1], answer_words.offsets[1:], strict=True)],
                     vocabulary, slots)

    def terms(self, hashes: np.ndarray) -> np.ndarray:
        """Index of each hash in the vocabulary, -1 where it is not in it."""
        if not len(self.vocabulary):
            return np.full(len(hashes), -1)
        slot = (hashes >> np.uint64(48)).astype(np.int32)
        first, n = self.slots[slot], self.slots[slot + 1] - self.slots[slot]
        found, left = np.full(len(hashes), -1), np.flatnonzero(n)
        at = first[left]
        while len(left):
            same = self.vocabulary[at] == hashes[left]
            found[left[same]] = at[same]
            more = np.flatnonzero(~same & (at + 1 < first[left] + n[left]))
            left, at = left[more], at[more] + 1
        return found


def _texts(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = GROUP_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for batch in batches:
        texts = [t or "" for t in batch.column(column).to_pylist()]
        for first, last in groups([len(t) for t in texts], limit):
            yield batch.slice(first, last - first), texts[first:last]


def _distinct(passage: np.ndarray, terms: np.ndarray, size: int, passages: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct known terms of each passage in order, how often they occur, and how many each passage has."""
    known = np.flatnonzero(terms >= 0)
    keys, times = np.unique(passage[known] * size + terms[known], return_counts=True)
    owner, term = np.divmod(keys, max(size, 1))
    return term.astype(np.int32), times.astype(np.int32), np.bincount(owner, minlength=passages).astype(np.int32)


def counted_passages(docs: DataFrame, items: Items) -> DataFrame:
    """The sparse matrix of all passages of ``docs``, written once: for each group of texts the distinct vocabulary words of their
    passages, how often they occur and how many each passage has (``terms``, ``times``, ``sizes``: 32-bit numbers).  Each task
    adds a row with the number of its ``documents`` and how many of them hold each word (``held``)."""
    size = len(items.vocabulary)
    entry = pa.list_(pa.struct([("term", pa.int32()), ("n", pa.int64())]))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(blobs: list, held: list | None, documents: int | None) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*(pa.array([b], pa.binary()) for b in blobs), pa.array([held], entry), pa.array([documents], pa.int64())], names=["terms", "times", "sizes", "held", "documents"])

        total, documents = np.zeros(size, np.int64), 0
        for _, texts in _texts(batches, limit=PASSAGE_BYTES):
            words, hashes = words_of(texts)
            counts = words.counts()
            parts = np.concatenate([[0], np.cumsum(-(-counts // PASSAGE))])
            place = np.arange(len(hashes)) - np.repeat(words.offsets[:-1], counts)
            terms, times, sizes = _distinct(np.repeat(parts[:-1], counts) + place // PASSAGE, items.terms(hashes), size, parts[-1])
            ends = np.concatenate([[0], np.cumsum(sizes)])[parts]
            seen = np.zeros(len(texts) * size, bool)
            seen[np.repeat(np.arange(len(texts)), np.diff(ends)) * size + terms] = True
            total += seen.reshape(len(texts), size).sum(axis=0)
            documents += len(texts)
            yield row([terms.tobytes(), times.tobytes(), sizes.tobytes()], None, None)
        at = np.flatnonzero(total)
        yield row([None] * 3, [{"term": t, "n": n} for t, n in zip(at.tolist(), total[at].tolist(), strict=True)], documents)

    schema = "terms binary, times binary, sizes binary, held array<struct<term:int,n:long>>, documents long"
    return stored(small_batches(docs.select("text")).mapInArrow(count, schema), "passages")


def document_frequencies(passages: DataFrame, items: Items) -> tuple[np.ndarray, int]:
    """Documents that hold each word of the vocabulary, and documents in all."""
    totals = passages.filter("documents is not null").select("held", "documents")
    found = np.zeros(len(items.vocabulary), np.int64)
    for term, n in totals.select(F.inline("held")).groupBy("term").agg(F.sum("n")).collect():
        found[term] = n
    return found, totals.agg(F.sum("documents")).first()[0] or 0


class _Matrix:
    """Products with sparse rows, their TF-IDF entries scaled to unit length.  Words are numbered by rising weight: the most frequent
    ones, which make up most entries, are multiplied as a dense block, the others entry by entry.  Products of a step are in single
    precision, sums of them in double: a product that should vanish has a square of some 1e-14, far below what counts as a direction."""

    def __init__(self, weights: np.ndarray):
        self.order = np.argsort(weights, kind="stable")
        self.place = np.argsort(self.order, kind="stable").astype(np.uint16 if len(weights) < 1 << 16 else np.int32)  # 16 bits are sorted by radix
        self.weights, self.dense = weights, min(DENSE_TERMS, len(weights))

    def add(self, total: np.ndarray, basis: np.ndarray, gram: bool, terms: np.ndarray, times: np.ndarray, sizes: np.ndarray) -> None:
        """Add A'A ``basis``, or ``basis``' A'A ``basis``, of these rows to ``total``; both matrices are in the order of ``order``."""
        basis = basis.astype(np.float32, copy=False)
        sizes = sizes[sizes > 0]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        for first in range(0, len(sizes), PASSAGES_PER_STEP):
            n = sizes[first:first + PASSAGES_PER_STEP]
            low, high = ends[first], ends[first + len(n)]
            term = terms[low:high]
            value, column, owner = times[low:high] * self.weights[term], self.place[term], np.repeat(np.arange(len(n)), n)
            value = (value / np.sqrt(np.bincount(owner, value * value))[owner]).astype(np.float32)
            often, seldom = np.flatnonzero(column < self.dense), np.flatnonzero(column >= self.dense)
            block = np.zeros((len(n), self.dense), np.float32)
            block[owner[often], column[often]] = value[often]
            product = block @ basis[:self.dense]
            owner, column, value = owner[seldom], column[seldom], value[seldom, None]
            if len(seldom):
                starts = np.flatnonzero(np.diff(owner, prepend=-1))
                product[owner[starts]] += np.add.reduceat(value * basis[column], starts)
            if gram:
                total += product.T @ product
                continue
            total[:self.dense] += block.T @ product
            if len(seldom):
                by = np.argsort(column, kind="stable")
                starts = np.flatnonzero(np.diff(column[by], prepend=-1))
                total[column[by[starts]]] += np.add.reduceat(value[by] * product[owner[by]], starts)


def latent_basis(passages: DataFrame, items: Items, weights: np.ndarray, rank: int = RANK) -> np.ndarray:
    """Right singular vectors (vocabulary by rank) of the passages' TF-IDF matrix, divided by their damped singular values."""
    size = len(weights)
    width = min(rank + OVERSAMPLING, size)
    matrix, passages = _Matrix(weights), passages.filter("documents is null").select("terms", "times", "sizes")
    known = [items.terms(np.array(h, np.uint64)) for h in items.hashes]
    of_items = _distinct(np.repeat(np.arange(len(known)), [len(k) for k in known]), np.concatenate(known), size, len(known))

    def summed(basis: np.ndarray, gram: bool) -> np.ndarray:
        """A'A basis, or basis' A'A basis, over items and passages: each task sums its rows, slabs of these sums are added by key."""
        shared = passages.sparkSession.sparkContext.broadcast(basis[matrix.order].astype(np.float32))

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((width if gram else size, width))
            for batch in batches:
                matrix.add(total, shared.value, gram, *(np.frombuffer(b"".join(batch.column(c).to_pylist()), np.int32) for c in ("terms", "times", "sizes")))
            slabs = [total[k:k + WORDS_PER_SLAB].tobytes() for k in range(0, len(total), WORDS_PER_SLAB)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(slabs)), pa.int32()), pa.array(slabs, pa.binary())], names=["slab", "part"])

        def merge(table: pa.Table) -> pa.Table:
            return pa.table({"slab": table["slab"][:1], "part": pa.array([sum(np.frombuffer(p.as_buffer()) for p in table["part"]).tobytes()], pa.binary())})

        total = np.zeros((width if gram else size, width))
        matrix.add(total, basis[matrix.order], gram, *of_items)
        for slab, part in passages.mapInArrow(add, "slab int, part binary").groupBy("slab").applyInArrow(merge, "slab int, part binary").collect():
            total[slab * WORDS_PER_SLAB:(slab + 1) * WORDS_PER_SLAB] += np.frombuffer(part).reshape(-1, width)
        return total if gram else total[matrix.place]

    basis = np.random.Generator(np.random.PCG64(1)).standard_normal((size, width))
    for _ in range(1 + POWER_ITERATIONS):
        basis, _ = np.linalg.qr(summed(basis, gram=False))
    values, turn = np.linalg.eigh(summed(basis, gram=True))
    order = np.argsort(-values)[:rank]
    order = order[values[order] > max(values.max(), 0) * 1e-9]
    return basis @ turn[:, order] / np.sqrt(values[order] + np.median(values[order]))


def _rare(items: Items, weights: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """The rarest words of each item, and how many of their occurrences any match must show.

    A common subsequence with ``ITEM_SHARE`` of an item leaves out at most ``misses`` of its words, so of any of its words that
    occur in it ``misses + n`` times, at least ``n`` occurrences are in the subsequence.  For each ``ITEMS_PER_PASS`` items: the
    items of each vocabulary word as offsets and a flat array.
    """
    chosen, required = [], np.zeros(len(items.ids), int)
    for k, h in enumerate(items.hashes):
        words, times = np.unique(items.terms(np.array(h, np.uint64)), return_counts=True)
        order = np.argsort(-weights[words], kind="stable")
        total = np.cumsum(times[order])
        misses = len(h) - next(n for n in range(len(h) + 1) if n / len(h) >= ITEM_SHARE)
        last = min(int(np.searchsorted(total, misses + max(1, math.ceil(RARE_SURPLUS * len(h))))), len(order) - 1)
        chosen.append(words[order[:last + 1]])
        required[k] = total[last] - misses
    passes = []
    for a in range(0, len(chosen), ITEMS_PER_PASS):
        part = chosen[a:a + ITEMS_PER_PASS]
        words, owner = np.concatenate(part), np.repeat(np.arange(a, a + len(part)), [len(c) for c in part])
        passes.append((np.concatenate([[0], np.cumsum(np.bincount(words, minlength=len(weights)))]), owner[np.argsort(words, kind="stable")]))
    return passes, required


@dataclass(frozen=True)
class Search:
    """All that a task needs to search windows for a block of items; its size follows from the block."""

    items: Items
    word_vectors: np.ndarray  # one row per vocabulary word
    weights: np.ndarray
    classes: dict[int, np.ndarray]  # window size -> items compared at that size
    least_weight: dict[int, float]  # window size -> total weight that a window needs to be compared
    item_vectors: np.ndarray
    item_counts: np.ndarray  # how often each item (column) holds each word (row)
    sizes: np.ndarray  # window size of each item
    rare: list[tuple[np.ndarray, np.ndarray]]
    required: np.ndarray

    @staticmethod
    def of(items: Items, weights: np.ndarray, basis: np.ndarray) -> Search:
        vectors = (weights[:, None] * basis).astype(np.float32)
        of_items = np.stack([vectors[items.terms(np.array(h, np.uint64))].sum(axis=0) for h in items.hashes])
        of_items /= np.maximum(np.linalg.norm(of_items, axis=1, keepdims=True), 1e-12)
        steps = np.maximum(np.round(np.log(items.lengths / SMALLEST_WINDOW) / math.log(WINDOW_RATIO)), 0).astype(int)
        sizes = np.round(SMALLEST_WINDOW * WINDOW_RATIO ** steps).astype(int)
        counts = np.zeros((len(weights), len(items.ids)), np.uint16)
        for k, h in enumerate(items.hashes):
            np.add.at(counts[:, k], items.terms(np.array(h, np.uint64)), 1)
        totals = np.array([weights[items.terms(np.array(h, np.uint64))].sum() for h in items.hashes])
        classes = {int(w): np.flatnonzero(sizes == w) for w in np.unique(sizes)}
        return Search(items, vectors, weights.astype(np.float32), classes, {w: WEIGHT_SHARE * totals[m].min() for w, m in classes.items()}, of_items, counts, sizes, *_rare(items, weights))

    def matches(self, texts: list[str]) -> list[list[dict]]:
        """Confirmed items of each text."""
        words, hashes = words_of(texts)
        found: list[dict[int, dict]] = [{} for _ in texts]
        prepared: dict[int, tuple[Sequence, Sequence]] = {}
        terms = self.items.terms(hashes)
        known = np.flatnonzero(terms >= 0)
        running = np.zeros((len(known) + 1, self.word_vectors.shape[1]), np.float32)
        self._sum_up(terms[known], running[1:])
        place = np.concatenate([[0], np.cumsum(terms >= 0)])  # known words before each word
        numbers = terms[known]
        before = self._before(numbers)
        # Latent candidates go first, so that the path by rare words only adds what they miss.
        for text, first, item, cosine in itertools.chain([self._candidates(words, terms, running, place)], self._by_rare_words(words, terms)):
            lengths = self.items.lengths[item]
            low, high = words.offsets[text], words.offsets[text + 1]
            start, end = np.maximum(low, first - lengths // 2), np.minimum(high, first + lengths + lengths // 2 + lengths // 4)
            a, b = place[start], place[end]
            # Each word of a common subsequence is a known word here, so too few of them are no match.
            possible = np.flatnonzero((b - a) / lengths >= ITEM_SHARE)
            covered = self._covered(numbers, before, a[possible], b[possible], item[possible])
            for i in possible[covered / lengths[possible] >= ITEM_SHARE].tolist():
                t, m = int(text[i]), int(item[i])
                if m in found[t]:
                    continue
                if m not in prepared:
                    prepared[m] = Sequence(self.items.hashes[m]), Sequence(self.items.answers[m])
                whole, answer = prepared[m]
                around = hashes[start[i]:end[i]].tolist()
                share = whole.common(around) / whole.length
                if share >= ITEM_SHARE and (of_answer := answer.common(around) / max(answer.length, 1)) >= ANSWER_SHARE:
                    if cosine is None:
                        vector = running[place[min(first[i] + self.sizes[m], high[i])]] - running[place[first[i]]]
                        near = float(vector @ self.item_vectors[m]) / max(float(np.linalg.norm(vector)), 1e-9)
                    else:
                        near = float(cosine[i])
                    found[t][m] = {"item_id": self.items.ids[m], "item_share": share, "answer_share": of_answer, "cosine": near, "word": int(first[i] - low[i])}
        return [list(f.values()) for f in found]

    def _by_rare_words(self, words: Words, terms: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, None]]:
        """Text, first word and item of every window, at stride one, whose surroundings hold as many rare words as a match needs."""
        offsets = words.offsets
        owner = np.repeat(np.arange(len(offsets) - 1), words.counts())
        known = np.flatnonzero(terms >= 0)
        for edges, members in self.rare:
            n = np.diff(edges)[terms[known]]
            which = np.repeat(np.arange(len(known)), n)
            item = members[np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + edges[terms[known[which]]]]
            at = known[which]
            order = np.argsort(item, kind="stable")
            item, at = item[order], at[order]
            ahead = np.arange(len(at)) + self.required[item] - 1
            inside = np.flatnonzero(ahead < len(at))
            inside = inside[(item[ahead[inside]] == item[inside]) & (owner[at[ahead[inside]]] == owner[at[inside]])]
            item, text, a, b = item[inside], owner[at[inside]], at[inside], at[ahead[inside]]
            length = self.items.lengths[item]
            low = np.maximum(offsets[text], b - (length + length // 2 + length // 4) + 1)
            high = np.minimum(offsets[text + 1], a + length // 2 + 1)
            # Both ends only grow within a text and an item: what an earlier interval held is cut off.
            again = np.flatnonzero((item[1:] == item[:-1]) & (text[1:] == text[:-1])) + 1
            reached = high.copy()
            low[again] = np.maximum(low[again], reached[again - 1])
            kept = np.flatnonzero(high > low)
            item, text, low, n = item[kept], text[kept], low[kept], (high - low)[kept]
            for x, y in groups(n.tolist(), STARTS_PER_PASS):
                m = n[x:y]
                run = np.repeat(np.arange(x, y), m)
                yield text[run], low[run] + np.arange(len(run)) - np.repeat(np.cumsum(m) - m, m), item[run], None

    def _sum_up(self, numbers: np.ndarray, out: np.ndarray) -> None:
        """Running sums of the vectors of known words: within blocks by a product with a triangle of ones, then over the blocks."""
        vectors, width = self.word_vectors[numbers], self.word_vectors.shape[1]
        whole = len(vectors) // WORDS_PER_SUM * WORDS_PER_SUM
        blocks = np.tri(WORDS_PER_SUM, dtype=np.float32) @ vectors[:whole].reshape(-1, WORDS_PER_SUM, width)
        blocks[1:] += np.cumsum(blocks[:-1, -1], axis=0)[:, None]
        out[:whole] = blocks.reshape(whole, width)
        np.cumsum(vectors[whole:], axis=0, out=out[whole:])
        if whole:
            out[whole:] += out[whole - 1]

    @staticmethod
    def _before(terms: np.ndarray) -> np.ndarray:
        """Where the same word stood last."""
        order = np.argsort(terms.astype(np.uint16) if terms.max(initial=0) < 1 << 16 else terms, kind="stable")  # 16 bits are sorted by radix
        again = np.flatnonzero(terms[order][1:] == terms[order][:-1])
        before = np.full(len(terms), -1)
        before[order[again + 1]] = order[again]
        return before

    def _covered(self, numbers: np.ndarray, before: np.ndarray, start: np.ndarray, end: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Words of each item that occur between start and end of the known words: no common subsequence is longer."""
        total = np.zeros(len(start), np.int64)
        for part in range(0, len(start), 4096):
            a, n = start[part:part + 4096], (end - start)[part:part + 4096]
            which = np.repeat(np.arange(len(a)), n)
            at = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + a[which]
            counted = np.flatnonzero(before[at] < a[which])
            which = which[counted]
            total[part:part + 4096] = np.bincount(which, self.item_counts[numbers[at[counted]], item[part + which]], len(a))
        return total

    def _candidates(self, words: Words, terms: np.ndarray, running: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text, first word, item and cosine of windows close to an item."""
        weight = np.concatenate([[0], np.cumsum(self.weights[terms[terms >= 0]], dtype=np.float64)])
        counts = words.counts()
        out: list[tuple[np.ndarray, ...]] = [(np.zeros(0, int), np.zeros(0, int), np.zeros(0, int), np.zeros(0, np.float32))]
        for size, members in self.classes.items():
            stride = max(1, size // STRIDES)
            per_text = np.where(counts > 0, np.maximum(-(-(counts - size) // stride), 0) + 1, 0)
            text = np.repeat(np.arange(len(counts)), per_text)
            first = words.offsets[text] + (np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)) * stride
            last = np.minimum(first + size, words.offsets[text + 1])
            a, b = place[first], place[last]
            able = np.flatnonzero((b > a) & (weight[b] - weight[a] >= self.least_weight[size]))
            for part in range(0, len(able), 4096):
                rows = able[part:part + 4096]
                vectors = running[b[rows]] - running[a[rows]]
                vectors /= np.maximum(np.sqrt(np.einsum("ij,ij->i", vectors, vectors)), 1e-9)[:, None]
                cosines = vectors @ self.item_vectors[members].T
                near = np.flatnonzero(cosines >= CANDIDATE_COSINE)
                r, m = np.divmod(near, len(members))
                out.append((text[rows[r]], first[rows[r]], members[m], cosines.ravel()[near]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def search_for(docs: DataFrame, items: Items) -> Search:
    passages = counted_passages(docs, items)
    frequency, documents = document_frequencies(passages, items)
    weights = np.log((1 + documents) / (1 + frequency)) + 0.1
    return Search.of(items, weights, latent_basis(passages, items, weights))


def with_matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` (with a column text) and ``matches``, the items of ``benchmark`` (item_id, text) found in the text.

    A match has item_id, item_share and answer_share (parts of the item and of its answer in the common subsequence of the first window
    that confirmed it), its cosine and the number of its first word.  A NULL or empty text has no matches, an item that is NULL
    or has no words matches nothing; repeated rows are searched like any other, and a repeated item is reported for
    each of its rows.  Column ``matches`` of ``docs`` is replaced, all others are kept.
    """
    names = [c for c in docs.columns if c != "matches"]
    docs = docs.select(*names)
    spark, found = docs.sparkSession, docs.withColumn("matches", F.lit(None).cast(MATCHES))
    schema = found.schema
    numbered = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).filter("text is not null").sort("item_id", "text")
    block: list[tuple] = []
    searches = []
    rows = iter(numbered.toLocalIterator())
    while True:
        row = next(rows, None)
        if row is not None:
            block.append((row.item_id, row.text))
        if block and (row is None or len(block) == ITEMS_PER_BLOCK):
            items = Items.of(block)
            if items.ids:
                searches.append(spark.sparkContext.broadcast(search_for(docs.select(F.col("text").cast("string")), items)))
            block = []
        if row is None:
            break
    for search in searches:
        def look(batches: Iterator[pa.RecordBatch], search=search) -> Iterator[pa.RecordBatch]:
            for part, texts in _texts(batches):
                new = search.value.matches(texts)
                old = part.column("matches").to_pylist()
                yield part.set_column(part.schema.get_field_index("matches"), "matches", pa.array([(o or []) + n for o, n in zip(old, new, strict=True)], _MATCH))

        found = small_batches(found).mapInArrow(look, schema)
    return found.withColumn("matches", F.coalesce("matches", F.array().cast(MATCHES)))
