"""Importance resampling against a plain version, and checksums of spans against zlib."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from motionloom.llm import resampling

from . import cases

WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def features(text):
    w = WORD.findall((text or "").translate(LOWER))
    return w, [" ".join(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def by_force(rows, target, percent=5, least=20):
    def count(texts):
        return Counter(zlib.crc32(f.encode()) % 10000 for t in texts for f in features(t)[1])
    s, t = count(x for _, x in rows), count(target)
    n_s, n_t = sum(s.values()), sum(t.values())
    out = []
    for i, text in rows:
        w, fs = features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (n_s + 10000) / ((s[b] + 1) * (n_t + 10000)))) for b in (zlib.crc32(f.encode()) % 10000 for f in fs))
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(w), len(fs), weight, score, None])
    joins = sorted((r for r in out if r[1] >= least and r[4] is not None), key=lambda r: (-r[4], r[0]))
    for k, r in enumerate(joins[:percent * sum(r[1] >= least for r in out) // 100]):
        r[5] = k + 1
    return sorted(map(tuple, out), key=str)


def got(docs, target, **options):
    return sorted(map(tuple, resampling.resampled(docs, target, **options).select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=str)


def test_span_crcs():
    rng = np.random.default_rng(1)
    buffer = rng.integers(0, 256, 30_000, dtype=np.uint8)
    lengths = np.array([1, 2, 255, 256, 257, 511, 512, 513, 9000, *rng.integers(1, 60, 300), *rng.integers(1, 3000, 60)])
    starts = rng.integers(0, 20_000, len(lengths))
    assert resampling.span_crcs(buffer, starts, starts + lengths).tolist() == [zlib.crc32(buffer[s:s + n].tobytes()) for s, n in zip(starts, lengths, strict=True)]
    assert len(resampling.span_crcs(buffer, starts[:0], starts[:0])) == 0


def test_awkward_rows(spark):
    rows = [*cases.awkward(), (40, "naïve-Café ÀÉ x2\x00y\x7fz " + "word " * 30), (41, "字" * 400 + " b " + "é" * 300)]
    target = ["Word word naïve", None, "", cases.text(50, 1)]
    assert got(cases.frame(spark, rows), spark.createDataFrame([(k, t, 1.0) for k, t in enumerate(target)], "item_id long, text string, rank double"), percent=40) == by_force(rows, target, 40)


def test_ties_and_repeated_rows(spark):
    """A third of all rows are one row, the same words stand under two ids, and every id has the same text."""
    rows = [(k, cases.text(30, 3)) for k in range(40)] + [(7, cases.text(25, 9))] * 30 + [(None, cases.text(25, 9))] * 10
    target = [cases.text(40, 3)]
    assert got(cases.frame(spark, rows).repartition(5), spark.createDataFrame([(0, target[0])], "item_id long, text string"), percent=60) == by_force(rows, target, 60)


@pytest.mark.parametrize("rows,target", [([], ["a b"]), ([], []), ([(1, "a b c")] * 3, []), ([(None, None)], [None])])
def test_empty_tables(spark, rows, target):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(frame, spark.createDataFrame([(t,) for t in target], "text string"), percent=50, least_words=1) == by_force(rows, target, 50, 1)


def test_drawn_documents(spark):
    rows = [(k, cases.text(30, k)) for k in range(20)]
    frame = cases.frame(spark, rows)
    ranked = resampling.resampled(frame, spark.createDataFrame([(rows[3][1],)], "text string"), percent=30)
    kept = resampling.drawn_documents(frame, ranked)
    assert kept.columns == frame.columns and kept.count() == 6 and {r.doc_id for r in kept.collect()} >= {3}
