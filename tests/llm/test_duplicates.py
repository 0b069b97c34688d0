"""Min-max hashing, components and substring dedup against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from motionloom.llm import components, minmax, repeats
from motionloom.llm.words import sequence_hashes, split_words

from . import cases


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(0, k) for k in range(100, 160)] + [(k, k + 1) for k in range(200, 230)] + [(7, 7)]
    label = {n: n for e in edges if e[0] != e[1] for n in e}
    for _ in range(len(label)):
        for u, v in edges:
            if u != v:
                label[u] = label[v] = min(label[u], label[v])
    got = components.components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert sorted(map(tuple, got)) == sorted(label.items())
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_near_duplicates_of_awkward_rows(spark):
    rows = cases.awkward()
    got = minmax.near_duplicates(cases.frame(spark, rows))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=str) == cases.near_components(rows)


@pytest.mark.parametrize("shingles", [1, 400, 1 << 17])
def test_chains_of_near_copies(spark, monkeypatch, shingles):
    """Every text is linked with its neighbours alone, whatever the size of a block."""
    monkeypatch.setattr(minmax, "BLOCK_SHINGLES", shingles)
    rows, current = [], cases.text(150, 20)
    for k in range(14):
        rows.append((k * 7 % 14 + 10, current))
        current = cases.edited(current, 0.02, 50 + k)
    got = minmax.near_duplicates(cases.frame(spark, rows))
    assert sorted(map(tuple, got.collect()), key=str) == cases.near_components(rows)


def test_texts_of_one_id_count_together(spark):
    a, b = cases.text(80, 30), cases.text(80, 31)
    rows = [(1, a), (2, a), (2, b), (3, b), (4, cases.text(80, 32))]
    assert sorted(map(tuple, minmax.near_duplicates(cases.frame(spark, rows)).collect()), key=str) == cases.near_components(rows)


def test_signature_is_unbiased():
    rng = np.random.default_rng(0)
    union = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    a, b = minmax.signature(union[:3500]), minmax.signature(union[500:])
    agree = np.mean([np.mean(x == y) for x, y in zip(a, b, strict=True)])
    assert abs(agree - 3000 / 4000) < 0.12


def test_empty_tables(spark):
    assert minmax.near_duplicates(cases.frame(spark, [])).count() == 0
    assert repeats.without_repeats(cases.frame(spark, [])).count() == 0


def removed(spark, rows, **settings):
    got = repeats.without_repeats(cases.frame(spark, rows), **settings).collect()
    kept = {" ".join(cases.WORD.findall(t or "")) for _, t in rows}
    for r in got:
        assert (r.kept_text is None) == (r.n_removed == 0)
    texts = {hashlib.sha256(t.encode()).hexdigest(): t for t in kept}
    return sorted(((r.doc_id, r.n_words, r.n_removed, texts[r.words_sha256] if r.kept_text is None else r.kept_text) for r in got), key=str)


@pytest.mark.parametrize("max_cells", [repeats.MAX_CELLS, 1 << 17])
def test_repeated_windows_of_awkward_rows(spark, max_cells):
    """The smaller sketch divides anchors among several."""
    rows = cases.awkward() + [(30, "im " * 500), (31, "und " * 40 + "im " * 80), (29, cases.text(49, 60)), (28, cases.text(49, 60)), (27, cases.text(50, 61)), (26, cases.text(50, 61))]
    assert removed(spark, rows, max_cells=max_cells) == cases.without_repeats(rows, 50)


def test_small_windows(spark):
    rng = random.Random(8)
    rows = [(k, " ".join(rng.choice("abc") for _ in range(rng.randrange(0, 30)))) for k in range(40)]
    assert removed(spark, rows, size=6, gram=3) == cases.without_repeats(rows, 6)


def test_words_and_sequences_do_not_depend_on_neighbours():
    texts = [b"one two three", b"", b" three\ttwo ", b"two three one two three"]
    together = split_words(texts)
    hashes = together.hashes()
    alone = [split_words([t]).hashes() for t in texts]
    assert together.counts().tolist() == [3, 0, 2, 5] and np.array_equal(hashes, np.concatenate(alone))
    assert sequence_hashes(alone[0], 2)[1] == sequence_hashes(alone[3], 2)[0] and len(sequence_hashes(alone[2], 3)) == 0


def test_periodic_texts_and_shifted_passages_against_brute_force(spark):
    shared = " ".join(f"s{i}" for i in range(70))
    rows = [(9, "a b " * 700), (4, "x a b " + "a b " * 400 + "y"), (5, f"p q {shared} r"), (7, f"{shared} t u v"), (7, f"{shared} t u v"),
            (8, " ".join(f"k{i}" for i in range(30)) + f" {shared[:-4]} other end"), (None, shared), (3, "a b a b")]
    assert removed(spark, rows) == cases.without_repeats(rows, 50)
