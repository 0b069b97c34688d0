"""Near-duplicates by min-max hashing.

A document's set holds its distinct shingles of five words (A-Z lower-cased).  Each of 64 permutations is
evaluated once per shingle and gives two signature values, its smallest and its largest image; both are unbiased
estimates of the Jaccard similarity, so 128 values cost 64 evaluations.  A band joins two minima and two maxima of four
different permutations; 32 bands miss a pair of similarity 0.75 with probability (1 - 0.75**4)**32 = 5e-6.

Documents with equal sets form a class, represented by its smallest id; only representatives are compared.  Buckets
are never expanded into pairs of all members.  First, members are compared with one leader of the bucket (the order
that names it differs between buckets); four bits of each signature value travel with a member, so that a pair is tested
inside the join: one of similarity 0.75 agrees in 98 of 128 on average and in fewer than 76 with probability 1e-5.  Links
are followed to components.  Then a bucket may still hold several components.  Around the largest of each bucket, the hub, all
others that share such a bucket with it are gathered once, and compared with each other and with the hub's members by
products of incidence matrices over blocks of bounded size, which return links alone.  All links are confirmed on full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .tables import batches_of, small_batches, stored, text_groups
from .words import mixed, sequence_hashes, split_words

PERMUTATIONS, BANDS, SHINGLE, PERCENT = 64, 32, 5, 75
ORDERS = 4
BLOCK_SHINGLES, COLUMNS = 1 << 17, 1 << 12
NIBBLES, AGREEING = 16, 76
_RANDOM = np.random.Generator(np.random.PCG64(20_240_229))
_FACTORS = _RANDOM.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint32) | np.uint32(1)
_SHIFTS = _RANDOM.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint32)
_RANDOM_ORDERS = _RANDOM.integers(1, 1 << 63, ORDERS, dtype=np.int64)
_BAND = np.arange(BANDS)
_MINIMA = np.stack([2 * _BAND, 2 * _BAND + 1]) % PERMUTATIONS
_MAXIMA = (_MINIMA + PERMUTATIONS // 4) % PERMUTATIONS


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than ``size`` are one shingle, none give an empty set."""
    words = split_words(texts)
    hashes = words.hashes(fold=True)
    runs = sequence_hashes(hashes, size)
    for first, last in zip(words.offsets[:-1], words.offsets[1:], strict=True):
        n = last - first
        yield np.unique(runs[first:last - size + 1]) if n >= size else sequence_hashes(hashes[first:last], n) if n else runs[:0]


def signature(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minimum and maximum under every permutation of the 32-bit values."""
    low, high = np.full(PERMUTATIONS, 0xFFFFFFFF, np.uint32), np.zeros(PERMUTATIONS, np.uint32)
    values = (shingles >> np.uint64(32)).astype(np.uint32)
    for first in range(0, len(values), 2048):
        images = _FACTORS[:, None] * values[None, first:first + 2048] + _SHIFTS[:, None]
        np.minimum(low, images.min(axis=1), out=low)
        np.maximum(high, images.max(axis=1), out=high)
    return low, high


def band_keys(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    low, high = low.astype(np.uint64), high.astype(np.uint64)
    keys = _BAND.astype(np.uint64)
    for part in (low[_MINIMA[0]], low[_MINIMA[1]], high[_MAXIMA[0]], high[_MAXIMA[1]]):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + part)
    return keys.view(np.int64)


def nibbles(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Four bits of every signature value, sixteen to a number."""
    values = (np.concatenate([low, high]) & np.uint32(15)).astype(np.uint64).reshape(-1, NIBBLES)
    return (values << (4 * np.arange(NIBBLES, dtype=np.uint64))).sum(axis=1, dtype=np.uint64).view(np.int64)


SIGNED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("bands", pa.list_(pa.int64())), ("bits", pa.list_(pa.int64()))])


def signed(docs: DataFrame) -> DataFrame:
    """Per document: size and digest of its set, its band keys and signature bits."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_groups(batches):
            rest: list[tuple] = []
            for s in shingle_sets(texts):
                digest, values = hashlib.blake2b(s.tobytes(), digest_size=16).digest(), signature(s)
                rest.append((len(s), digest, band_keys(*values), nibbles(*values)) if len(s) else (0, digest, None, None))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *(pa.array(c, f.type) for c, f in zip(zip(*rest, strict=True), list(SIGNED)[1:], strict=True))],
                                             schema=SIGNED)

    return small_batches(docs).mapInArrow(sign, "doc_id long, n_shingles long, digest binary, bands array<long>, bits array<long>")


def _sets(docs: DataFrame) -> DataFrame:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in text_groups(batches):
            sets = [s.view(np.int64) for s in shingle_sets(texts)]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"])

    return small_batches(docs).mapInArrow(build, "node long, shingles array<long>")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets are similar enough."""
    a = sets.select(F.col("node").alias("u"), F.col("shingles").alias("su"))
    b = sets.select(F.col("node").alias("v"), F.col("shingles").alias("sv"))
    both = pairs.join(b, "v").join(a, "u")
    shared = F.size(F.array_intersect("su", "sv")).cast("long")
    return both.filter(100 * shared >= percent * (F.size("su") + F.size("sv") - shared)).select("u", "v")


def _alike(percent: int):
    """Whether sizes and signature bits of a pair (n, bits; n_u, bits_u) allow a link."""
    def equal(x, y):
        d = x.bitwiseXOR(y)
        d = d.bitwiseOR(F.shiftright(d, 1)).bitwiseOR(F.shiftright(d, 2)).bitwiseOR(F.shiftright(d, 3))
        return NIBBLES - F.bit_count(d.bitwiseAND(F.lit(0x1111111111111111)))

    agreeing = sum((equal(F.col("bits")[k], F.col("bits_u")[k]) for k in range(2 * PERMUTATIONS // NIBBLES)), F.lit(0))
    expected = 1 / 16 + 15 / 16 * percent / 100
    least = AGREEING - 98 + round(2 * PERMUTATIONS * expected)
    return (F.least("n", "n_u") * 100 >= F.greatest("n", "n_u") * percent) & (agreeing >= least)


def _leader(order: str = "order"):
    """Members of a bucket stand in the order of node XOR a constant of the bucket, which its smallest value leads back from."""
    return F.col(order).bitwiseXOR(_constant())


def _constant():
    return F.element_at(F.array(*(F.lit(int(x)) for x in _RANDOM_ORDERS)), (F.pmod("bucket", F.lit(ORDERS)) + 1).cast("int"))


def near_links(nodes: DataFrame, docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (u, v) among ``nodes`` (node, n, bands, bits) that connect all that is connected; texts in ``docs`` (doc_id, text)."""
    rows = nodes.select("node", F.explode("bands").alias("bucket"))
    crowded = (rows.groupBy("bucket").agg(F.count("*").alias("members"), F.min(F.col("node").bitwiseXOR(_constant())).alias("order"))
               .filter("members > 1").select("bucket", _leader().alias("leader")))
    described = nodes.select("node", "n", "bits")
    members = stored(rows.join(crowded, "bucket").join(described, "node"), "members")
    taking_part = members.select(F.col("node").alias("doc_id")).distinct()
    sets = stored(_sets(docs.join(taking_part, "doc_id", "left_semi")), "sets")

    def links_of(pairs: DataFrame) -> DataFrame:
        return stored(_confirmed(pairs.filter("u <> v").distinct(), sets, percent), "links")

    leading = members.filter("node = leader").select("bucket", F.col("node").alias("u"), F.col("n").alias("n_u"), F.col("bits").alias("bits_u"))
    links = links_of(members.join(leading, "bucket").filter("u <> node").filter(_alike(percent)).select("u", F.col("node").alias("v")))
    labelled = stored(members.join(components(links), "node", "left").select("bucket", "node", "n", F.coalesce("label", "node").alias("label")), "labelled")
    parts = labelled.groupBy("bucket", "label").agg(F.count("*").alias("c")).groupBy("bucket").agg(F.count("*").alias("labels"), F.max(F.struct("c", "label"))["label"].alias("hub"))
    around = (labelled.join(parts.filter("labels > 1").select("bucket", "hub"), "bucket").groupBy("hub", "node")
              .agg(F.max(F.col("label") != F.col("hub")).alias("outside"), F.max("label").alias("label"), F.max("n").alias("n")))
    return links.unionByName(_between(stored(around, "around"), sets, percent))


def _linked(outside: list[np.ndarray], others: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the sets of both lists that are similar enough, from products of incidence matrices in slices of columns."""
    values = [np.concatenate(x) for x in (outside, others)]
    owner = [np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (outside, others)]
    shared = np.intersect1d(np.unique(values[0]), np.unique(values[1]), assume_unique=True)
    entries = []
    for v, o in zip(values, owner, strict=True):
        at = np.minimum(np.searchsorted(shared, v), max(len(shared) - 1, 0))
        known = shared[at] == v if len(shared) else np.zeros(len(v), bool)
        order = np.argsort(at[known], kind="stable")
        entries.append((at[known][order], o[known][order]))
    common = np.zeros((len(outside), len(others)), np.float32)  # counts below 2**24 are exact
    for first in range(0, len(shared), COLUMNS):
        matrices = []
        for (at, o), n in zip(entries, common.shape, strict=True):
            a, b = np.searchsorted(at, [first, first + COLUMNS])
            matrix = np.zeros((n, COLUMNS), np.float32)
            matrix[o[a:b], at[a:b] - first] = 1
            matrices.append(matrix)
        common += matrices[0] @ matrices[1].T
    sizes = [np.array([len(s) for s in x], np.float64) for x in (outside, others)]
    common = common.astype(np.float64)
    return np.nonzero(100 * common >= percent * (sizes[0][:, None] + sizes[1][None, :] - common))


def _between(around: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between the nodes outside a hub and all nodes around it; ``around`` has hub, node, label, n and outside."""
    blocks = (F.ceil(F.sum(x) / BLOCK_SHINGLES).cast("int") for x in (F.when(F.col("outside"), F.col("n")), F.col("n")))
    shares = around.groupBy("hub").agg(*(b.alias(name) for b, name in zip(blocks, ("outside_blocks", "all_blocks"), strict=True)))
    rows = around.join(shares, "hub").join(sets, "node").withColumn("place", F.xxhash64("node"))

    def gathered(part: DataFrame, blocks: str, name: str) -> DataFrame:
        return part.groupBy("hub", F.pmod("place", blocks).alias("_block")).agg(F.collect_list(F.struct("node", "label", "shingles")).alias(name)).drop("_block")

    rows = stored(rows.select("hub", "node", "label", "outside", "outside_blocks", "all_blocks", "place", "shingles"), "around")
    pairs = gathered(rows.filter("outside"), "outside_blocks", "a").join(gathered(rows, "all_blocks", "b"), "hub").select("a", "b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                sides = [batch.column(c).slice(k, 1).flatten() for c in ("a", "b")]
                nodes, labels = ([s.field(c).to_numpy() for s in sides] for c in (0, 1))
                found = [[x.values.to_numpy() for x in s.field(2)] for s in sides]
                i, j = _linked(*found, percent)
                new = labels[0][i] != labels[1][j]
                i, j = i[new], j[new]
                _, one = np.unique(np.stack([i, labels[1][j]]), axis=1, return_index=True)  # one link leads to a whole component
                yield pa.RecordBatch.from_arrays([pa.array(nodes[0][i[one]]), pa.array(nodes[1][j[one]])], names=["u", "v"])

    with batches_of(around.sparkSession, 8):
        return stored(pairs.mapInArrow(compare, "u long, v long").distinct(), "links")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Component of every row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    ``component_id`` is the smallest doc_id reachable over links, ``kept`` says whether it is the row's own.  A NULL or
    empty text, or one of separators alone, has an empty set and no link.  Rows with the same doc_id are one document:
    each is returned, and their links count together.  A row without doc_id links nothing; its component is NULL, and it is
    kept.  Other columns are ignored, and an empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = stored(signed(docs), "signed")
    named = rows.filter("doc_id is not null and n_shingles > 0")
    classes = named.groupBy("digest").agg(F.min("doc_id").alias("node"), F.max("doc_id").alias("last"), F.first("bands").alias("bands"), F.first("bits").alias("bits"), F.first("n_shingles").alias("n"))
    classes = stored(classes, "classes")
    links = near_links(classes.select("node", "n", "bands", "bits"), docs, percent)
    repeated = named.groupBy("doc_id").agg(F.min("digest").alias("one"), F.max("digest").alias("other")).filter("one <> other").select("doc_id")
    same = (named.join(repeated, "doc_id", "left_semi").join(classes.select("digest", "node"), "digest")
            .select(F.col("doc_id").alias("u"), F.col("node").alias("v")))
    labels = components(links.unionByName(same))
    known = (classes.join(labels, "node", "left").filter("last > node or label is not null")
             .select("digest", F.coalesce("label", "node").alias("component_id")))
    found = rows.join(known, "digest", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return (found.select("doc_id", "n_shingles", component.alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))
