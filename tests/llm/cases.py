"""Awkward rows that every operator must take, and brute-force versions of what operators compute."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EXTRA = "lang string, label string, score string, matches string, node string, row string, bucket string, rank string, kind string, k string, end string"


def words(n: int, seed: int, vocabulary: int = 400) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdeghilmnorstu") for _ in range(rng.randrange(2, 8))) if rng.random() < 0.3 else f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def text(n: int, seed: int) -> str:
    return " ".join(words(n, seed))


def edited(source: str, share: float, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join(f"x{rng.randrange(10**6)}" if rng.random() < share else w for w in source.split())


def awkward() -> list[tuple[int | None, str | None]]:
    """Ids and texts: NULLs, empty and separator-only texts, short and very long ones, copies, near copies, repeated rows."""
    base = text(300, 1)
    return [(1, base), (2, base), (3, edited(base, 0.02, 2)), (4, edited(base, 0.2, 3)), (5, None), (6, ""), (7, " \t\r\n "), (8, "One two"), (9, "oNE TWO"),
            (10, text(60_000, 4)), (11, "é" * 50_000), (12, text(120, 5)), (12, text(120, 5)), (None, base), (None, None), (13, base.upper()),
            (14, "  ".join(base.split())), (15, text(100, 6) + " " + " ".join(base.split()[100:180]) + " " + text(50, 7)), (-3, text(40, 8)), (16, "a b c d e")]


def frame(spark: SparkSession, rows: list[tuple[int | None, str | None]]) -> DataFrame:
    """Documents with further columns whose names clash with what operators use inside."""
    names = [c.split()[0] for c in EXTRA.split(", ")]
    return spark.createDataFrame([(i, t, *("en" if c == "lang" else c for c in names)) for i, t in rows], f"doc_id long, text string, {EXTRA}")


def near_components(rows: list[tuple[int | None, str | None]], percent: int = 75, size: int = 5) -> list[tuple]:
    """Sorted (doc_id, n_shingles, component_id, kept); rows of one doc_id are one document."""
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(lower))
        sets.append({tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    label = {i: i for i, _ in rows if i is not None}
    while True:
        before = dict(label)
        for (i, _), a in zip(rows, sets, strict=True):
            for (j, _), b in zip(rows, sets, strict=True):
                if i is not None and j is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
                    label[i] = label[j] = min(label[i], label[j])
        if label == before:
            break
    return sorted(((i, len(s), label.get(i), i == label.get(i)) for (i, _), s in zip(rows, sets, strict=True)), key=str)


def without_repeats(rows: list[tuple[int | None, str | None]], size: int) -> list[tuple]:
    """Sorted (doc_id, n_words, n_removed, kept words joined)."""
    split = [(i, WORD.findall(t or "")) for i, t in rows]
    first: dict[tuple, int] = {}
    for i, w in split:
        for k in range(len(w) - size + 1):
            if i is not None:
                first[key] = min(first.get(key := tuple(w[k:k + size]), i), i)
    out = []
    for i, w in split:
        gone = {k + d for k in range(len(w) - size + 1) if i is not None and first[tuple(w[k:k + size])] < i for d in range(size)}
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)
