"""Packing, flat token files, WARC and nearest vectors: exact round trips and brute force."""

from __future__ import annotations

import gzip
import io
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from motionloom.llm import neighbours, packing, separators, warc
from motionloom.llm.tables import filesystem, shared_folder
from motionloom.llm.tokens import encode, encode_with_added, vocabulary_path

from . import cases

# --- tokens, packing ----------------------------------------------------------------------------

public = pytest.importorskip("public_tokenizers")


def test_ids_equal_those_of_the_json_vocabulary():
    from tokenizers import Tokenizer
    other = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    other.encode_special_tokens = True
    texts = [t or "" for _, t in cases.awkward()] + ["<|endoftext|> it's   x\r\n\n  y  ", " " * 3000 + "a", "日本語 русский 😀😀", "a" * 3000]
    for t in texts:
        assert encode(t, vocabulary_path()).tolist() == other.encode(t, add_special_tokens=False).ids
    assert len(encode(None, vocabulary_path())) == 0


def test_packed_ids_keep_added_tokens(spark):
    from tokenizers import Tokenizer
    other = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    texts = [t or "" for _, t in cases.awkward()]
    texts += ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>  x", "a  <|endoftext|>\n\n b's", "<|endoftext| >", "x<|endoftext|>é😀 " * 700]
    want = [other.encode(t, add_special_tokens=False).ids for t in texts]
    for t, ids in zip(texts, want, strict=True):
        assert encode_with_added(t, vocabulary_path()).tolist() == ids
    assert len(encode_with_added(None, vocabulary_path())) == 0 and 50_256 not in encode("<|endoftext|>", vocabulary_path())
    pieces = packing.pack(cases.frame(spark, list(enumerate(texts)))).orderBy("doc_id", "start").collect()
    got = [[x for r in pieces if r.doc_id == k for x in np.frombuffer(r.ids, "<u4").tolist()] for k in range(len(texts))]
    assert got == [[*ids, 0] for ids in want]


def test_cuts():
    assert [packing.cuts(n, 4) for n in (1, 4, 5, 8, 9)] == [[(0, 1)], [(0, 4)], [(0, 1), (1, 4)], [(0, 4), (4, 4)], [(0, 1), (1, 4), (5, 4)]]


def test_packing_round_trip(spark):
    rows = cases.awkward() + [(100 + k, cases.text(k % 37, k)) for k in range(150)]
    got = packing.pack(cases.frame(spark, rows), limit=64).collect()
    want = {}
    for i, t in rows:
        want.setdefault(i, []).append([*encode(t, vocabulary_path()).tolist(), 0])
    pieces: dict = {}
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert 1 <= r.length == len(ids) <= 64
        pieces.setdefault(r.doc_id, []).append((r.piece, r.start, ids))
    for i, texts in want.items():
        found = sorted(pieces[i])
        assert sorted(x for p in found for x in p[2]) == sorted(x for t in texts for x in t)
        if len(texts) == 1:
            assert [x for p in found for x in p[2]] == texts[0] and [p[0] for p in found] == list(range(len(found)))
            assert [p[1] for p in found] == [sum(len(q[2]) for q in found[:k]) for k in range(len(found))]
    sequences: dict = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in sequences.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= 64
    total = sum(r.length for r in got)
    assert len(sequences) <= 1.05 * -(-total // 64) + 1
    assert packing.pack(cases.frame(spark, [])).count() == 0


def test_placement_minimises_the_sum_of_squares():
    rng = random.Random(1)
    bins, counts = packing.OpenSequences(20, 0), {}
    gaps: dict[int, int] = {}
    for _ in range(300):
        length = rng.randrange(1, 21)
        sequence, offset = bins.place(length)
        gap = gaps.get(sequence, 20)
        assert offset == 20 - gap

        def score(h: int) -> int:
            after = dict(counts)
            after[h] -= 1
            if h > length:
                after[h - length] = after.get(h - length, 0) + 1
            return sum(n * n for n in after.values())

        fitting = [h for h, n in counts.items() if n and h >= length]
        if fitting:
            assert sequence in gaps and gap == min(fitting, key=lambda h: (score(h), h))
            counts[gap] -= 1
        else:
            assert sequence not in gaps
        gaps[sequence] = gap - length
        if gap > length:
            counts[gap - length] = counts.get(gap - length, 0) + 1


# --- flat token files ---------------------------------------------------------------------------

def test_written_files_are_counted(spark):
    rows = cases.awkward()
    index = separators.write_flat(cases.frame(spark, rows).repartition(3))
    counted = separators.count_tokens(index.select("path", "tokens").distinct(), block=100, span=3)
    got = index.join(counted, ["path", "ordinal"], "full").select("doc_id", "n_tokens").collect()
    assert sorted(map(tuple, got), key=str) == sorted(((i, len(encode(t, vocabulary_path()))) for i, t in rows), key=str)
    assert separators.write_flat(cases.frame(spark, [])).count() == 0


@pytest.mark.parametrize("block,span", [(1, 1), (3, 2), (7, 100), (1000, 2)])
def test_blocks_are_stitched(spark, block, span):
    rng = np.random.default_rng(block)
    folder, files, want = shared_folder(spark, "flat"), [], []
    fs, place = filesystem(folder)
    fs.create_dir(place)
    for k, ids in enumerate([[], [9], [1, 2], [9, 9, 9], *(rng.choice([1, 2, 3, 9], n, p=[.3, .3, .3, .1]).tolist() for n in (20, 41, 64))]):
        with fs.open_output_stream(f"{place}/{k}.bin") as out:
            out.write(np.array(ids, "<u2").tobytes())
        files.append((f"{folder}/{k}.bin", len(ids)))
        start = 0
        ordinal = 0
        for end, x in enumerate([*ids, None]):
            if x == 9 or x is None and start < end:
                want.append((files[-1][0], ordinal, start, end - start))
                start, ordinal = end + 1, ordinal + 1
    got = separators.count_tokens(spark.createDataFrame(files, "path string, tokens long"), end_id=9, block=block, span=span)
    assert sorted(map(tuple, got.collect())) == sorted(want)


# --- WARC ---------------------------------------------------------------------------------------

PAGES = [(3, "http://a/é ü", "<p>é</p>"), (1, None, None), (2, "u", ""), (9, "u\r\nX: y", "<p>é</p>"), (4, "u", "same"), (5, "u", "same"), (5, "u", "same"), (6, "v", "x" * 300_000),
         (None, "w", "same"), (7, "u", "WARC/1.1\r\n\r\n")]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, holder string").withColumns({c: F.lit(c) for c in ("shard", "payload", "sha1", "tie")})


@pytest.mark.parametrize("roll,per_shard,revisit_from", [(1, 3, 0), (1 << 20, 100, 0), (200, 2, 5)])
def test_warc_round_trip(spark, roll, per_shard, revisit_from):
    folder = shared_folder(spark, "warc")
    manifest = warc.write(pages(spark, PAGES), folder, roll, per_shard, revisit_from)
    got = warc.read(manifest).collect()
    payloads = [(i, (h or "").encode()) for i, _, h in PAGES]
    want = []
    for i, p in payloads:
        group = [j for j, q in payloads if q == p and j is not None]
        holder = max(group) if len(p) >= revisit_from and sum(q == p for _, q in payloads) > 1 and group else i
        want.append((i, len(p), warc.base32_sha1(p), "response" if holder == i else "revisit", None if holder == i else holder))
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == sorted(want, key=str)
    for r in got:
        assert (r.payload is None) == (r.record_type == "revisit")
    files = manifest.sort("path").collect()
    assert sum(f.records for f in files) == len(PAGES) and len({f.path for f in files}) == len(files)
    for f in files:
        fs, place = filesystem(f.path)
        data = fs.open_input_stream(place, compression=None).read()
        assert len(data) == f.bytes and gzip.decompress(data).count(b"WARC-Record-ID: ") == f.records


def test_warc_is_deterministic(spark):
    def written(order):
        manifest = warc.write(pages(spark, PAGES).orderBy(order).repartition(3), shared_folder(spark, "warc"), 300, 3)
        return sorted((f.path.rpartition("/")[2], f.records, f.bytes, f.sha256) for f in manifest.collect())
    assert written("page_id") == written(F.desc("html"))


def test_warc_of_nothing_and_damage(spark):
    manifest = warc.write(pages(spark, []), shared_folder(spark, "warc"))
    assert manifest.count() == 0 and warc.read(manifest).count() == 0
    data = warc.record(1, "u", b"payload", warc.base32_sha1(b"payload"), None, False)
    assert warc.parse(data)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parse(data.replace(b"payload\r\n\r\n", b"paYload\r\n\r\n"))
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(gzip.compress(data)[:-9])))
    assert list(warc.members(io.BytesIO(gzip.compress(b"a") + gzip.compress(b"") + gzip.compress(b"b" * 3_000_000)))) == [b"a", b"", b"b" * 3_000_000]


# --- nearest vectors ----------------------------------------------------------------------------

def nearest_by_force(rows, every, k):
    vectors = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and any(v):
            vectors[i] = max(vectors.get(i, v), v)
    out = []
    for q in vectors:
        if q % every == 0:
            scored = sorted((-float(neighbours.cosines(np.float32(vectors[q]), np.float32([vectors[j]]))[0]), j) for j in vectors if j != q)
            out += [(q, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def test_neighbours_of_awkward_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(k, rng.standard_normal(8).astype(np.float32).tolist()) for k in range(60)]
    rows += [(k, [1.0] * 8) for k in range(100, 130)] + [(k, rows[0][1]) for k in (-5, 200, 205)]
    rows += [(300, None), (301, [0.0] * 8), (302, [1.0] * 7 + [None]), (303, [1.0] * 7 + [float("nan")]), (304, [float("inf")] * 8), (305, [1.0, 2.0]), (None, [1.0] * 8), (10, rows[10][1]), (306, [1e-30] * 8)]
    frame = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], "vec_id long, embedding array<float>, label int, rank string, rep int")
    got = neighbours.nearest(frame, every=5).collect()
    assert sorted(map(tuple, got)) == nearest_by_force(rows, 5, 5)


@pytest.mark.parametrize("rows", [[], [(0, [1.0, 2.0])], [(0, [1.0, 2.0]), (50, [2.0, 1.0]), (7, [1.0, 1.0])]])
def test_few_vectors(spark, rows):
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert len(got) == sum((len(rows) - 1) for i, _ in rows if i % 50 == 0)


def test_recall_over_many_lists(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_VECTORS", 100)
    monkeypatch.setattr(neighbours, "CHUNK_QUERIES", 7)
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((12, 48))
    vectors = np.concatenate([centres[rng.integers(0, 12, 1500)] + 0.3 * rng.standard_normal((1500, 48)), rng.standard_normal((1500, 48))]).astype(np.float32)
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    got = {(r.query_id, r.vec_id) for r in neighbours.nearest(frame).collect()}
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    want = set()
    for q in range(0, 3000, 50):
        s = unit @ unit[q]
        s[q] = -2
        want |= {(q, int(v)) for v in np.argsort(-s)[:5]}
    assert len(got) == len(want) and len(got & want) >= 0.9 * len(want)


def test_abandoned_candidates_are_far():
    rng = np.random.default_rng(5)
    vectors = neighbours.unit(rng.standard_normal((2000, 64))) @ neighbours.rotation(64)
    queries = vectors[:20].astype(np.float32)
    block = vectors.astype(np.float32)
    exact = ((queries[:, None] - block[None]) ** 2).sum(axis=2)
    reach = np.sort(exact, axis=1)[:, 5]
    q, v, read = neighbours.surviving(queries, block, reach)
    kept = set(zip(q.tolist(), v.tolist(), strict=True))
    near = {(i, j) for i in range(20) for j in np.flatnonzero(exact[i] <= reach[i]).tolist()}
    assert len(near & kept) >= 0.97 * len(near) and read < 0.8 * exact.size * 64
