"""Language, decontamination, secrets and pseudonyms on awkward rows and against brute force."""

from __future__ import annotations

import datetime
import math
import random
import re
import string
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from motionloom.llm import decontamination, language, pseudonyms, secrets

from . import cases

# --- language -----------------------------------------------------------------------------------

SPOKEN = {"en": "the of and that with this from ing tion er", "de": "der und mit ein ist ung keit lich zu öü", "fr": "le la est dans ère éau que ou ié ç"}


def spoken(name: str, n: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(SPOKEN[name].split()) for _ in range(rng.randrange(1, 3))) for _ in range(n))


def test_language_on_held_out_documents(spark):
    names = sorted(SPOKEN)
    rows = [(k, spoken(names[k % 3], 5 + k % 40, k), names[k % 3]) for k in range(600)]
    rows += [(1000, None, "en"), (1001, "", "de"), (1002, "12 34 !?", "fr"), (1003, spoken("de", 30, 9), None), (None, spoken("fr", 30, 8), "fr"), (1004, spoken("en", 30_000, 7), "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("mine")).withColumn("lang_pred", F.lit(1))
    got = language.predict(docs, language.train(docs)).withColumn("held_out", language.held_out()).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [by[k].lang_pred for k in (1000, 1001, 1002)] == ["und"] * 3 and by[1000].score == 0
    assert by[1003].lang_pred == "de" and by[None].lang_pred == "fr" and by[1004].lang_pred == "en"
    fold = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 1000]
    import zlib
    assert {r.doc_id for r in fold} == {k for k in range(600) if zlib.crc32(str(k).encode()) % 5 == 0}
    assert np.mean([r.lang_pred == names[r.doc_id % 3] for r in fold]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_language_does_not_learn_from_held_out_rows(spark):
    rows = [(k, spoken("en", 20, k), "en") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    wrong = docs.withColumn("lang", F.when(language.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    assert language.train(wrong).languages == ("en",)


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "words", None)], "doc_id long, text string, lang string")
    assert language.train(docs) is None and language.train(docs.limit(0)) is None
    assert [tuple(r)[1:] for r in language.predict(docs.drop("lang"), None).collect()] == [("words", "und", 0.0)]


def test_gram_counts_do_not_depend_on_neighbours():
    texts = [b"Ab, c", b"", b"\xc3\x89a", "İx".encode(), b"\xff\xfe"]
    together = [dict(zip(a.tolist(), c.tolist(), strict=True)) for a, c in language.gram_counts(texts)]
    assert together == [dict(zip(a.tolist(), c.tolist(), strict=True)) for t in texts for a, c in language.gram_counts([t])]
    assert sum(together[0].values()) == 5 + 4 + 3 + 1 - 1 and not together[1]


def test_temperature_lowers_the_loss():
    rng = np.random.default_rng(0)
    labels = rng.integers(0, 3, 500)
    logits = rng.normal(size=(500, 3)) + 1.5 * np.eye(3)[labels]
    assert 0.2 < language.calibrated(logits * 10, labels) / (10 * language.calibrated(logits, labels)) < 1.2


# --- decontamination ----------------------------------------------------------------------------

def test_common_subsequence():
    rng = random.Random(0)
    for _ in range(200):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(1, 14))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontamination.Sequence(a).common(b) == table[-1][-1]


def test_leaks_are_found_and_clean_documents_left(spark):
    items = [(k, cases.text(18 + k % 30, 900 + k) + ". " + cases.text(8, 990 + k)) for k in range(30)]
    clean = [(k, cases.text(200, k)) for k in range(100, 160)]
    exact = [(k, " ".join([*cases.words(40 + 3 * k, k), *items[k][1].upper().split(), *cases.words(60, k + 500)])) for k in range(30)]
    loose = [(k + 30, " ".join([*cases.words(70, k + 700), *cases.edited(items[k][1], 0.1, k).split(), *cases.words(60, k + 800)])) for k in range(30)]
    rows = [*clean, *exact, *loose, (None, items[0][1]), (200, None), (201, ""), (202, cases.text(30_000, 3) + " " + items[1][1]), (203, items[2][1]), (203, items[2][1])]
    benchmark = spark.createDataFrame([*items, (77, None), (78, " ?! "), (None, cases.text(20, 999))], "item_id long, text string")
    got = [(r.doc_id, [m.item_id for m in r.matches]) for r in decontamination.with_matches(cases.frame(spark, rows), benchmark).collect()]
    assert len(got) == len(rows)
    assert all(not m for i, m in got if i in range(100, 160) or i in (200, 201))
    assert all(m == [i] for i, m in got if i is not None and i < 30)
    assert sum(m == [i - 30] for i, m in got if i is not None and 30 <= i < 60) >= 28
    assert [m for i, m in got if i is None] == [[0]] and [m for i, m in got if i == 202] == [[1]] and [m for i, m in got if i == 203] == [[2], [2]]


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "text")]])
def test_little_to_search(spark, rows):
    docs, none = cases.frame(spark, rows), spark.createDataFrame([], "item_id long, text string")
    assert [r.matches for r in decontamination.with_matches(docs, none).collect()] == [[]] * len(rows)
    one = spark.createDataFrame([(5, "An item of some six words. Yes")], none.schema)
    assert [r.matches for r in decontamination.with_matches(docs, one).collect()] == [[]] * len(rows)


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "ITEMS_PER_BLOCK", 2)
    items = [(k, cases.text(25, 300 + k)) for k in range(5)]
    docs = cases.frame(spark, [(k, cases.text(60, k) + " " + t) for k, t in items])
    got = decontamination.with_matches(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r.doc_id, [m.item_id for m in r.matches]) for r in got.collect()) == [(k, [k]) for k in range(5)]


@pytest.mark.parametrize("dense", [256, 7])
def test_latent_space_of_all_documents(spark, monkeypatch, dense):
    """Against the eigenvectors of the whole matrix; rare words come in few documents, more than 4000 others have none."""
    monkeypatch.setattr(decontamination, "DENSE_TERMS", dense, raising=False)
    monkeypatch.setattr(decontamination, "PASSAGES_PER_STEP", 50, raising=False)
    items = [(k, " ".join(f"w{(7 * k + j * j) % 40}" for j in range(9 + k))) for k in range(6)]
    rows = [(k, f"w{k % 9} other{k} w{k * k % 40}") for k in range(4_200)] + [(k, None) for k in range(3)]
    rows += [(k, " ".join(f"w{(3 * j + k) % 40}" if j % 3 else f"w{j % 11}" for j in range(150 + k))) for k in range(40)]
    docs = cases.frame(spark, rows).select("text").repartition(3)
    block = decontamination.Items.of(items)
    search = decontamination.search_for(docs, block)
    held = [decontamination.words_of([t or ""])[1] for _, t in rows]
    terms = [block.terms(h) for h in held]
    frequency = sum(np.bincount(np.unique(t[t >= 0]), minlength=len(block.vocabulary)) for t in terms)
    weights = np.log((1 + len(rows)) / (1 + frequency)) + 0.1
    passages = [t[k:k + 40] for t in terms for k in range(0, len(t), 40)] + [block.terms(np.array(h, np.uint64)) for h in block.hashes]
    matrix = np.array([np.bincount(p[p >= 0], minlength=len(weights)) * weights for p in passages])
    matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)
    values, vectors = np.linalg.eigh(matrix.T @ matrix)
    kept = values > values.max() * 1e-9
    values, vectors = values[kept], vectors[:, kept]
    want = vectors / (values + np.median(values)) @ vectors.T
    got = search.word_vectors / weights[:, None]
    assert np.allclose(search.weights, weights) and np.allclose(got @ got.T, want, rtol=1e-3, atol=1e-4 * np.abs(want).max())


def lcs_matches(items: list[tuple[int, str]], rows: list[tuple[int, str]]) -> set[tuple[int, int]]:
    """Document and item of every window, from every start, whose common subsequence covers the shares of item and answer."""
    split = {i: decontamination.words_of([t])[1].tolist() for i, t in items}
    answers = {i: decontamination.words_of([decontamination.answer_of(t)])[1].tolist() for i, t in items}
    counts = {i: Counter(w) for i, w in split.items()}
    out = set()
    for d, t in rows:
        w = decontamination.words_of([t])[1].tolist()
        held = Counter(w)
        for i, item in split.items():
            n = len(item)
            if (counts[i] & held).total() / n < 0.6:
                continue
            whole, answer = decontamination.Sequence(item), decontamination.Sequence(answers[i])
            for s in range(len(w)):
                around = w[max(0, s - n // 2):s + n + n // 2 + n // 4]
                if whole.common(around) / n >= 0.6 and answer.common(around) / len(answers[i]) >= 0.5:
                    out.add((d, i))
                    break
    return out


def test_a_full_block_loses_no_item_outside_the_latent_space():
    """Against the common subsequence from every start, with a latent space that holds no word of the rare items."""
    rng = random.Random(4)
    items = [(k, cases.text(12 + k % 40, 3000 + k)) for k in range(500)]
    items += [(k, " ".join(f"r{rng.randrange(10**7)}" for _ in range(12 + k % 40)) + ". " + cases.text(3, k)) for k in range(500, 990)]
    items += [(k, " ".join([f"t{k}"] * 20 + [f"u{k}"] * 7)) for k in range(990, 1000)]
    assert len(items) == decontamination.ITEMS_PER_BLOCK
    others = " ".join(t for _, t in items).split()
    rows = []
    for k in range(300):
        share = (0, 0.1, 0.2, 0.3, 0.35)[k % 5]
        changed = [rng.choice(others) if rng.random() < share else w for w in items[(7 * k if k < 280 else 700 + k) % 1000][1].split()]
        rows.append((k, " ".join([*rng.choices(others, k=30 + k % 50), *changed, *rng.choices(others, k=40)])))
    block = decontamination.Items.of(items)
    inside = block.terms(decontamination.words_of([t for _, t in items[:500]])[1])
    basis = np.zeros((len(block.vocabulary), decontamination.RANK))
    basis[inside] = np.random.default_rng(1).standard_normal((len(inside), decontamination.RANK))
    search = decontamination.Search.of(block, np.ones(len(basis)), basis)
    got = search.matches([t for _, t in rows])
    want = lcs_matches(items, rows)
    assert len(want) > 200 and any(i >= 990 for _, i in want)
    assert {(k, m["item_id"]) for k, found in enumerate(got) for m in found} == want


def test_words_are_found_by_their_leading_bits():
    """Against a dictionary, with words that share their leading 16 bits, hold none of them or come after all others."""
    top = np.array([0, 0, 0, 5, 5, 65_535, 65_535, 9], np.uint64) << np.uint64(48)
    vocabulary = np.unique(top + np.array([0, 1, 7, 3, 4, 8, (1 << 48) - 1, 2], np.uint64))
    slots = np.searchsorted(vocabulary >> np.uint64(48), np.arange((1 << 16) + 1, dtype=np.uint64)).astype(np.int32)
    block = decontamination.Items([], np.zeros(0, int), [], [], vocabulary, slots)
    asked = np.concatenate([vocabulary, vocabulary + np.uint64(1), vocabulary ^ np.uint64(1 << 50), np.zeros(0, np.uint64)])
    number = {h: k for k, h in enumerate(vocabulary.tolist())}
    assert block.terms(asked).tolist() == [number.get(h, -1) for h in asked.tolist()]
    assert block.terms(asked[:0]).tolist() == []


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 100_000])
def test_running_sums_of_word_vectors(n):
    """Windows far into a long text are sums of a few words, so the rounding of all words before them must stay small."""
    block = decontamination.Items.of([(1, " ".join(f"w{k}" for k in range(50)))])
    search = decontamination.Search.of(block, np.ones(50), np.random.default_rng(3).random((50, 8)))
    numbers = np.random.default_rng(4).integers(0, 50, n)
    got = np.zeros((n, 8), np.float32)
    search._sum_up(numbers, got)
    want = np.cumsum(search.word_vectors[numbers].astype(np.float64), axis=0)
    assert np.allclose(got, want, rtol=3e-6)


# --- secrets ------------------------------------------------------------------------------------

BASE = {"assign": re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), "access": re.compile("AKIA[A-Z0-9]+"), "hex": re.compile("[0-9a-f]+")}


def base_spans(t: str) -> list[tuple[int, int, int]]:
    return sorted((m.start(), k, m.end()) for k, (kind, p) in enumerate(BASE.items()) for m in p.finditer(t)
                  if (len(m.group(2)) >= 12 if kind == "assign" else len(m.group()) >= (18 if kind == "access" else 16)))


SECRET_TEXTS = [None, "", "nothing here", "password=abc", "token=password:abcdefghijkl", 'é€😀 API_KEY = "0123456789abcdef" PASSWD:x', "AKIA" + "A" * 13, "AKIAAKIA" + "B" * 12 + " AKIAX",
                "f" * 15 + " " + "e" * 16 + "g" + "0" * 40, "secret: 'deadbeefdeadbeef' token=" + "x" * 11 + " token=" + "y" * 12, "ſecret=abcdefghijklmnop", "apikey=" * 4 + "z" * 20,
                "word " * 20_000 + "token=0123456789ab " + "1f" * 50_000]


def test_base_spans(spark):
    rows = [(k, t) for k, t in enumerate(SECRET_TEXTS)] + [(5, SECRET_TEXTS[5]), (None, SECRET_TEXTS[8])]
    got = secrets.find(cases.frame(spark, rows)).collect()
    found = [(r.doc_id, [tuple(s) for s in r.found if s.kind < 3]) for r in got]
    assert sorted(found, key=str) == sorted(((i, base_spans(t or "")) for i, t in rows), key=str)
    assert secrets.find(cases.frame(spark, [])).count() == 0


def test_random_spans(spark):
    rng = random.Random(5)
    keys = ["".join(rng.choice(string.ascii_letters + string.digits + "+/") for _ in range(40)) for _ in range(8)]
    plain = ["internationalisation" * 2, "getUserNameFromDatabaseConnectionPool", "a-rather-long-slug-of-plain-words", "=" * 60, "1234567890" * 3, "ABABABABABABABABABABABABAB"]
    rows = [(k, f"😀 see {v} there") for k, v in enumerate([*keys, *plain])] + [(99, f"token={keys[0]}")]
    got = {r.doc_id: [tuple(s) for s in r.found] for r in secrets.find(cases.frame(spark, rows)).collect()}
    assert all(got[k] == [(6, 3, 46)] for k in range(8))
    assert all(all(s[1] != 3 for s in got[k]) for k in range(8, 14))
    assert got[99] == [(0, 0, 46)]  # a candidate that overlaps a base span is none of its own


def test_redaction(spark):
    rows = [(k, t) for k, t in enumerate(SECRET_TEXTS[:-1])]
    docs = cases.frame(spark, rows)
    got = secrets.redacted(docs)
    assert got.columns == docs.columns
    for r in got.collect():
        before = SECRET_TEXTS[r.doc_id]
        if not base_spans(before or ""):
            assert r.text == before
        else:
            assert secrets.PLACEHOLDER in r.text and not base_spans(r.text)


def plain_evidence(t: str) -> float:
    """The battery of tests in plain Python."""
    n = len(t)
    alphabets = [(r"[0-9]+", 10), (r"[0-9a-f]+", 16), (r"[0-9A-F]+", 16), (r"[A-Z]+", 26), (r"[a-z]+", 26), (r"[A-Z2-7]+=*", 32), (r"[a-z0-9]+", 36), (r"[A-Z0-9]+", 36),
                 (r"[A-Za-z0-9]+", 62), (r"[A-Za-z0-9+/=]+", 64), (r"[A-Za-z0-9_=-]+", 64)]
    size = next((k for pattern, k in alphabets if re.fullmatch(pattern, t)), 65)
    chi = sum((t.count(c) - n / size) ** 2 / (n / size) for c in set(t)) + (size - len(set(t))) * n / size
    excess = n * size * secrets.EXCESS
    uniformity = (size - 1 + excess - chi) / math.sqrt(2 * (size - 1 + 2 * excess))
    classes = ["l" if c.islower() else "u" if c.isupper() else "d" for c in t if c.isalnum()]
    changes = sum(x != y for x, y in zip(classes, classes[1:]))
    share = secrets.CLASS_CHANGES
    runs = (changes - (n - 1) * share) / math.sqrt((n - 1) * share * (1 - share))
    codes = [secrets.SYMBOLS.index(c) + 1 for c in t]
    away = [c - sum(codes) / n for c in codes]
    variance = sum(x * x for x in away)
    serial = (secrets.CORRELATION - abs(sum(x * y for x, y in zip(away, away[1:])) / variance if variance else 1.0)) * math.sqrt(n)
    if chi > size - 1 + 4 * math.sqrt(2 * (size - 1)):
        return 0.0
    z = (uniformity + runs + serial) / math.sqrt(3)
    upper = math.exp(-z * z / 2) / (1.64 * abs(z) + math.sqrt(0.76 * z * z + 4))
    return -math.log10(max(upper if z > 0 else 1 - upper, 1e-300))


def test_evidence_against_plain_python(spark):
    rng = random.Random(8)
    alphabets = [string.digits, string.hexdigits.lower(), "0123456789ABCDEF", string.ascii_lowercase, string.ascii_uppercase, "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", string.ascii_lowercase + string.digits,
                 string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/", string.ascii_letters + string.digits + "_-", secrets.SYMBOLS, "ab"]
    texts = ["".join(rng.choice(a) for _ in range(rng.randrange(20, 90))) for a in alphabets for _ in range(6)] + ["=" * 30, "getUserNameFromDatabaseConnectionPool"]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    got = {r.k: r.e for r in rows.select("k", secrets.evidence(F.col("t")).alias("e")).collect()}
    assert all(math.isclose(got[k], plain_evidence(t), rel_tol=1e-9, abs_tol=1e-9) for k, t in enumerate(texts))


def test_discoveries_against_sorting(spark):
    """The histogram's threshold lets through what the step-up rule over sorted p values, put on its grid, lets through."""
    rng = random.Random(9)
    rows = [(rng.randrange(20, 80), rng.choice([0.0, rng.random() * 3, rng.random() * 20])) for _ in range(400)]
    threshold, mean = secrets.discoveries(spark.createDataFrame(rows, "length int, evidence double"))
    strength = sorted((math.floor(max(e + math.log10(n / mean), 0) * secrets.BINS_PER_DECADE) / secrets.BINS_PER_DECADE for n, e in rows), reverse=True)
    assert math.isclose(mean, sum(n for n, _ in rows) / 400)
    assert math.isclose(threshold, min(s for k, s in enumerate(strength, 1) if 400 * 10**-s <= 0.01 * sum(x >= s for x in strength)))


def test_candidates_beyond_base_spans(spark):
    """A random text around a hexadecimal run, around an access key, before an assignment, and one that an assignment holds."""
    rng = random.Random(6)
    def key(n):
        return "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(n))
    around = key(22) + "Z0123456789abcdefZ" + key(14)
    access = key(20) + "q/AKIA" + "7Q2W9E4R6T1Y8U3I" + "/q" + key(16)
    led = key(30) + "/token=" + key(24) + ".tail5"
    rows = [(0, f"see {around} there"), (1, f"😀{access} x"), (2, f"a {led} b"), (3, f"token={key(30)}.{key(30)}"), (4, "plain_words_token=abcdefghijkl next"), (5, f"see {around} there")]
    docs = cases.frame(spark, rows)
    got = {r.doc_id: [tuple(s) for s in r.found] for r in secrets.find(docs).collect()}
    assert (4, 3, 4 + len(around)) in got[0] and any(k == 2 for _, k, _ in got[0]) and got[5] == got[0]
    assert (1, 3, 1 + len(access)) in got[1] and any(k == 1 for _, k, _ in got[1])
    assert [s for s in got[2] if s[1] == 0] and (2, 3, 2 + led.index(".")) in got[2]
    assert [s[1] for s in got[3]] == [0]
    text = {r.doc_id: r.text for r in secrets.redacted(docs).collect()}
    mark = secrets.PLACEHOLDER
    assert text[0] == text[5] == f"see {mark} there" and text[1] == f"😀{mark} x" and text[2] == f"a {mark} b" and text[3] == mark and text[4] == f"plain_words_{mark} next"
    for k, before in rows:  # the union of the spans and nothing else
        covered = {i for start, _, end in got[k] for i in range(start, end)}
        assert text[k].replace(mark, "") == "".join(c for i, c in enumerate(before) if i not in covered)


# --- pseudonyms ---------------------------------------------------------------------------------

def swap(spark, texts, key="k"):
    docs = cases.frame(spark, list(enumerate(texts)))
    return [r.text for r in pseudonyms.pseudonymised(docs, key).sort("doc_id").collect()]


def luhn(d: str) -> bool:
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def test_formats_stay_valid_and_values_distinct(spark):
    rng = random.Random(2)
    cards = [c for c in ("4" + "".join(rng.choice(string.digits) for _ in range(15)) for _ in range(300)) if luhn(c)]
    phones = [f"+1 ({rng.randrange(1000):03}) {rng.randrange(1000):03}-{rng.randrange(10000):04}" for _ in range(40)]
    ips = [".".join(str(rng.randrange(256)) for _ in range(4)) for _ in range(40)]
    ssns = [f"{rng.randrange(1, 666):03}-{rng.randrange(1, 100):02}-{rng.randrange(1, 10000):04}" for _ in range(40)]
    dates = [(datetime.date(1800, 1, 1) + datetime.timedelta(rng.randrange(146_097))).isoformat() for _ in range(40)]
    emails = [f"{''.join(rng.choice('abcXYZ') for _ in range(rng.randrange(1, 12)))}.{rng.randrange(100):02}@mail.example.com" for _ in range(40)]
    shapes = {"card": (cards, lambda v: luhn(v) and len(v) == 16), "phone": (phones, lambda v: re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", v)), "ipv4": (ips, lambda v: all(int(x) < 256 for x in v.split("."))),
              "ssn": (ssns, lambda v: re.fullmatch(r"(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}", v)), "date": (dates, lambda v: datetime.date.fromisoformat(v)),
              "email": (emails, lambda v: v.endswith("@mail.example.com"))}
    for values, fits in shapes.values():
        values = list(dict.fromkeys(values))
        new = swap(spark, values)
        assert all(fits(v) for v in new) and len(set(new)) == len(values)
        assert sum(a == b for a, b in zip(values, new, strict=True)) <= 2
        assert swap(spark, values[:3]) == new[:3] != swap(spark, values[:3], "other key")


def test_a_small_set_is_permuted(spark):
    rows = spark.range(27 * 50).select(pseudonyms.permuted_number(F.lit("k"), "x", F.col("id"), (27, 50)).alias("v"))
    assert sorted(r.v for r in rows.collect()) == list(range(27 * 50))
    texts = spark.range(1000).select(pseudonyms.permuted_text(F.lit("k"), "x", F.lpad(F.col("id").cast("string"), 3, "0")).alias("v"))
    assert sorted(r.v for r in texts.collect()) == [f"{k:03}" for k in range(1000)]


def test_what_is_not_valid_stays(spark):
    texts = [None, "", "4111111111111112", "1.2.3.400", "666-10-1000", "2023-02-30", "30.02.2021", "a1b2c3d4e5f6789012345678901234567890abcd", "version 1.2.3.4.5", "x" * 200_000]
    assert swap(spark, texts) == texts
    assert pseudonyms.pseudonymised(cases.frame(spark, []), "k").count() == 0


def test_values_stay_linked_in_their_places(spark):
    card = "4111 1111-1111 1111"
    a, b = swap(spark, [f"é {card}, 12/31/1999 and 31.12.1999; {card} a.b@c.org", f"{card} 1999-12-31"])
    m = re.fullmatch(r"é (\d{4} \d{4}-\d{4} \d{4}), (\d\d)/(\d\d)/(\d{4}) and (\d\d)\.(\d\d)\.(\d{4}); (.*) [a-z]\.[a-z]@c\.org", a)
    assert m[1] == m[8] == b[:19] != card and (m[4], m[2], m[3]) == (m[7], m[6], m[5]) == tuple(b[20:].split("-"))
