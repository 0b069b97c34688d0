"""The corpus pipeline stage by stage, and the contract of the registered queries."""

from __future__ import annotations

import hashlib
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from motionloom.llm import language, minmax, packing, secrets
from motionloom.llm.tokens import encode, vocabulary_path

from . import cases
from .test_texts import spoken

CLASH = ("score", "matches", "kept", "found", "row")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    items = [(k, spoken("en", 30, 5000 + k)) for k in range(4)]
    rows = [(k, spoken(("en", "de", "fr")[k % 3], 40 + k, k), ("en", "de", "fr")[k % 3]) for k in range(60)]
    base = rows[9][1]
    rows += [(100, base, "en"), (101, base + " addition", "fr"), (102, "12 34", "en"), (103, None, "en"), (None, spoken("en", 50, 77), "en"), (104, "", None),
             (105, spoken("en", 30, 78) + " " + items[1][1] + " " + spoken("en", 30, 79), "en"), (106, "the password=0123456789abcdef " + spoken("en", 40, 80), "en"),
             (107, spoken("de", 45, 81), "de"), (107, spoken("de", 45, 81), "de"), (107, spoken("de", 45, 82), "de"), (108, spoken("fr", 9000, 83), "fr")]
    documents = spark.createDataFrame([(i, t, lang, "src", None if t is None else len(t), *(c for c in CLASH)) for i, t, lang in rows],
                                      f"doc_id long, text string, lang string, source string, n_chars long, {', '.join(c + ' string' for c in CLASH)}")
    documents.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows


def test_stages(spark, tables):
    folder, rows = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    made = []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, folder)
        if name != "packing":
            assert after.schema.simpleString() == docs.schema.simpleString()
        docs = spark.createDataFrame(after.collect(), after.schema)
        made.append([r.asDict() for r in docs.collect()])
    spoken_rows, single, clean, safe, pieces = made
    assert sorted((r["doc_id"] for r in spoken_rows), key=str) == sorted((i for i, t, _ in rows if i not in (102, 103, 104)), key=str)
    assert all(r[c] == c for r in spoken_rows for c in CLASH)
    gone = {100, 101}
    ids = sorted((r["doc_id"] for r in single), key=str)
    assert ids == sorted({i for i, _, _ in rows} - {102, 103, 104} - gone, key=str)
    assert [r["doc_id"] for r in single if r["doc_id"] not in {c["doc_id"] for c in clean}] == [105] and len(clean) == len(single) - 1
    by = {r["doc_id"]: r for r in safe}
    assert len(safe) == len(clean) and by[106]["text"].startswith(f"the {secrets.PLACEHOLDER} ") and by[106]["n_chars"] == len(by[106]["text"])
    assert all(by[r["doc_id"]]["text"] == r["text"] for r in clean if r["doc_id"] != 106)
    lengths: dict = {}
    for p in pieces:
        lengths[p["doc_id"]] = lengths.get(p["doc_id"], 0) + p["length"]
    assert lengths == {i: len(encode(r["text"], vocabulary_path())) + 1 for i, r in by.items()}


def test_run_equals_its_stages_by_other_means(spark, tables):
    """Rows of run() against decisions made row by row in Python, from the operators' own predictions of the language."""
    folder, rows = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    predicted = language.predict(docs.select("doc_id", "text"), language.train(docs)).collect()
    left = [(r.doc_id, r.text) for r in predicted if r.lang_pred != "und"]
    kept = {r[0] for r in cases.near_components(left) if r[3] or r[0] is None} - {105}
    got = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in got} == kept
    assert all(0 <= r.offset and r.offset + r.length <= 2048 for r in got)


def test_empty_tables(spark, tables, tmp_path):
    folder, _ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_nothing_to_learn_keeps_documents(spark):
    docs = spark.createDataFrame([(1, "words", None, "s"), (2, "12", None, "s"), (3, None, None, "s")], "doc_id long, text string, lang string, source string")
    assert [r.doc_id for r in corpus_pipeline.identify_language(spark, docs, "").collect()] == [1]


SF = entry.ENTRY_DATA
given = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")
CONTRACT = {"op2_language_id": ["doc_id", "held_out", "lang_pred", "score"], "op3_warc_round_trip": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
            "op4_minmax_near_duplicates": ["doc_id", "n_shingles", "component_id", "kept"], "op5_substring_dedup": ["doc_id", "n_words", "n_removed", "kept_sha256"],
            "op6_adaptive_neighbours": ["query_id", "rank", "vec_id", "score"], "op8_best_fit_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            "op9_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]}


@given
def test_given_documents_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = {name: entry.queries()[name](spark, SF) for name in CONTRACT}
    assert all(df.columns == CONTRACT[name] for name, df in found.items())
    near = sorted(map(tuple, found["op4_minmax_near_duplicates"].collect()), key=str)
    assert near == cases.near_components(rows)
    repeats = sorted(map(tuple, found["op5_substring_dedup"].collect()), key=str)
    assert repeats == sorted(((i, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in cases.without_repeats(rows, 50)), key=str)
    held = found["op2_language_id"].join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id").filter("held_out and lang is not null")
    assert held.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.9


def test_registered():
    names = entry.queries().keys()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names
    assert minmax.PERCENT == 75 and packing.DOCUMENTS_PER_TASK > 0 and F is not None
