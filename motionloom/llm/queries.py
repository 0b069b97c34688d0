"""One query per operator over the given tables, with production parameters, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, language, minmax, neighbours, packing, pseudonyms, repeats, resampling, secrets, separators, urlfilter, warc, whitening
from .tables import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function
    return keep


@query()
def op1_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents."""
    found = decontamination.with_matches(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.inline("matches"))


@query()
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from the documents outside the held-out fold."""
    docs = read(spark, sf_dir, "documents")
    scored = language.predict(docs.select("doc_id", "text"), language.train(docs))
    return scored.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


@query("""
WITH rows AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
held AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS holder FROM rows)
SELECT page_id, strlen(payload) AS payload_bytes,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + ((('0x' || substr(hex, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INTEGER, 1)), '') AS payload_digest,
    CASE WHEN holder = page_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN holder <> page_id THEN holder END AS refers_to
FROM held""")
def op3_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record and read back from the archives."""
    return warc.written_and_read(read(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op4_minmax_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return minmax.near_duplicates(read(spark, sf_dir, "documents"))


@query()
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stay after removing windows of 50 words that repeat a smaller document."""
    found = repeats.without_repeats(read(spark, sf_dir, "documents"))
    digest = F.when(F.col("kept_text").isNull(), F.col("words_sha256")).otherwise(F.sha2("kept_text", 256))
    return found.select("doc_id", "n_words", "n_removed", digest.alias("kept_sha256"))


@query()
def op6_adaptive_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest vectors of every vector whose id is divisible by 50."""
    return neighbours.nearest(read(spark, sf_dir, "embeddings"))


@query()
def op7_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal numbers, dates and addresses replaced by pseudonyms of the same format."""
    key = spark.conf.get(pseudonyms.KEY_SETTING, "set a secret key here")
    return pseudonyms.pseudonymised(read(spark, sf_dir, "documents").select("doc_id", "text"), key)


@query()
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 ids."""
    return packing.pack(read(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


@query()
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    found = secrets.find(read(spark, sf_dir, "documents"))
    names = F.array(*map(F.lit, secrets.KINDS))

    def joined(which):
        return F.array_join(F.transform(which, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")

    def number(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == secrets.KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    base = F.filter("found", lambda s: s["kind"] < secrets.KINDS.index("random"))
    return found.select("doc_id", number("assign"), number("access"), number("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))


@query()
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every document, found by scanning the flat token files written from all documents."""
    index = separators.write_flat(read(spark, sf_dir, "documents"))
    counted = separators.count_tokens(index.select("path", "tokens").distinct())
    return index.join(counted, ["path", "ordinal"]).select("doc_id", "ordinal", "start", "n_tokens")


@query()
def op11_characteristic_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four whitened components of every vector."""
    return whitening.whitened(read(spark, sf_dir, "embeddings"))


@query(r"""
WITH RECURSIVE bits AS (SELECT b, b AS c, 0 AS k FROM range(256) t(b)
    UNION ALL SELECT b, xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END), k + 1 FROM bits WHERE k < 8),
single AS (SELECT b, c FROM bits WHERE k = 8),
texts AS (SELECT 's' AS side, doc_id AS id, row_number() OVER () AS n, text FROM documents
    UNION ALL SELECT 't', item_id, row_number() OVER (), text FROM benchmark),
words AS (SELECT side, id, n, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
features AS MATERIALIZED (SELECT side, n, f, count(*) AS k FROM (SELECT side, n, unnest(list_concat(w, list_concat(
    list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
    list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])))) AS f FROM words) GROUP BY ALL),
distinct_features AS MATERIALIZED (SELECT f, hex(encode(f)) AS h, strlen(f) AS bytes FROM (SELECT DISTINCT f FROM features)),
longest AS (SELECT coalesce(max(bytes), 0) AS n FROM distinct_features),
place AS (SELECT b, 0 AS d, c FROM single
    UNION ALL SELECT p.b, d + 1, xor(p.c >> 8, s.c) FROM place p JOIN single s ON s.b = p.c & 255 WHERE d < (SELECT n FROM longest)),
named AS MATERIALIZED (SELECT printf('%02X', b) AS x, d, c FROM place),
moved AS (SELECT 0::BIGINT AS n, 4294967295 AS c
    UNION ALL SELECT n + 1, xor(m.c >> 8, s.c) FROM moved m JOIN single s ON s.b = m.c & 255 WHERE n < (SELECT n FROM longest)),
crcs AS (SELECT f, any_value(bytes) AS bytes, bit_xor(named.c) AS folded FROM (SELECT f, h, bytes, unnest(range(bytes)) AS i FROM distinct_features) e
    JOIN named ON named.x = substr(h, 2 * i + 1, 2) AND named.d = bytes - 1 - i GROUP BY f),
placed AS (SELECT f, xor(xor(folded, m.c), 4294967295) % 10000 AS bucket FROM crcs JOIN moved m ON m.n = bytes),
sums AS (SELECT bucket, coalesce(sum(k) FILTER (side = 's'), 0)::DOUBLE AS s, coalesce(sum(k) FILTER (side = 't'), 0)::DOUBLE AS t
    FROM features JOIN placed USING (f) GROUP BY bucket),
totals AS (SELECT coalesce(sum(s), 0) AS s, coalesce(sum(t), 0) AS t FROM sums),
gains AS (SELECT bucket, floor(1000 * ln((sums.t + 1) * (totals.s + 10000) / ((sums.s + 1) * (totals.t + 10000))))::BIGINT AS gain FROM sums, totals),
weights AS (SELECT n, sum(k) AS n_features, sum(k * gain) AS weight FROM features JOIN placed USING (f) JOIN gains USING (bucket) WHERE side = 's' GROUP BY n),
scored AS (SELECT id AS doc_id, len(w) >= 20 AS long, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
    FROM words LEFT JOIN weights USING (n) WHERE side = 's'),
ranked AS (SELECT *, row_number() OVER (PARTITION BY long AND score IS NOT NULL ORDER BY score DESC, doc_id) AS place FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN long AND score IS NOT NULL AND place <= 5 * (SELECT count(*) FROM scored WHERE long) // 100 THEN place END AS rank
FROM ranked""")
def op12_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance weights of all documents towards the benchmark's texts, and the five per cent drawn by them."""
    found = resampling.resampled(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def _template_sql() -> str:
    """The tree in SQL: the same levels, tests and constants, written out level by level."""
    u, m = urlfilter, [f"m{k}" for k in range(1, urlfilter.DEPTH + 1)]
    rules = sorted(u.RULES, key=lambda r: -len(r[0]))
    fits = " ".join(f"WHEN (host = '{d}' OR ends_with(host, '.{d}')) AND starts_with(path, '/{p}') THEN '{d}/{p}'" for d, _, p in (r.partition("/") for r, _ in rules))
    says = " ".join(f"WHEN '{r}' THEN '{v}'" for r, v in rules)
    plain = r"regexp_replace(regexp_replace(seg, '[0-9]+', '0', 'g'), '[^-_.%+=,;:@0]+', 'A', 'g')"
    steps = [f"""WITH cut AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    hosts AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM cut),
    parts AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM hosts),
    ruled AS (SELECT *, CASE {fits} END AS rule FROM parts),
    level0 AS (SELECT row_number() OVER () AS id, *, CASE rule {says} END AS said, '' AS node,
        CASE WHEN path <> '' THEN string_split(regexp_replace(path, '^/', ''), '/') ELSE [] END AS s FROM ruled)"""]
    for k in range(1, u.DEPTH + 1):
        steps.append(f"""cut{k} AS (SELECT *, CASE WHEN length({plain}) > {u.LONGEST_SHAPE} THEN 'X' ELSE {plain} END AS shape FROM (SELECT *, s[{k}] AS seg FROM level{k - 1})),
        nodes{k} AS (SELECT *, sum(n) OVER w AS total, count(*) OVER w AS kinds FROM (SELECT host, node, shape, seg, count(*) AS n FROM cut{k} WHERE seg IS NOT NULL
            GROUP BY ALL) WINDOW w AS (PARTITION BY host, node, shape)),
        level{k} AS (SELECT * EXCLUDE (seg, shape, node), node || '/' || coalesce(t{k}, '') AS node FROM (SELECT c.*,
            CASE WHEN n.seg IS NOT NULL THEN c.seg WHEN c.seg IS NOT NULL THEN '<' || c.shape || '>' END AS t{k}
            FROM cut{k} c LEFT JOIN (SELECT * FROM nodes{k} WHERE kinds < {u.FEW} OR n >= {u.SHARE}::DOUBLE * total) n USING (host, node, seg)))""")
    named = ", ".join(f"coalesce(t{k}, '') AS {c}, coalesce(t{k}, '') AS o{k}" for k, c in enumerate(m, 1))
    steps.append(f"""placed AS (SELECT page_id, host, path, rule, said, {named}, CASE WHEN len(s) > {u.DEPTH} THEN '**' ELSE '' END AS tail FROM level{u.DEPTH}),
    tree{u.DEPTH + 1} AS (SELECT host, {", ".join(m)}, {", ".join(f"o{k}" for k in range(1, u.DEPTH + 1))}, tail, count(*) AS pages, count(said) AS labelled,
        count(*) FILTER (said = 'block') AS blocked FROM placed GROUP BY ALL)""")
    for k in range(u.DEPTH, 0, -1):
        above, rest = ", ".join(["host", *m[:k - 1]]), ", ".join([*m[k:], "tail"])
        branch = m[k - 1]
        steps.append(f"""sums{k} AS (SELECT *, sum(pages) OVER (PARTITION BY {above}, {branch}, {rest}) AS cell, sum(pages) OVER b AS n, sum(pages) OVER (PARTITION BY {above}, {rest}) AS pool,
            sum(pages) OVER p AS total, count(DISTINCT ({rest}, 0)) OVER p AS kinds, sum(labelled) OVER b AS l, sum(blocked) OVER b AS bl, sum(labelled) OVER p AS pl, sum(blocked) OVER p AS pb
            FROM tree{k + 1} WINDOW b AS (PARTITION BY {above}, {branch}), p AS (PARTITION BY {above})),
        chi{k} AS (SELECT *, sum(pages::DOUBLE * cell * total / (n::DOUBLE * pool)) OVER (PARTITION BY {above}, {branch}) - n AS chi, (pb + 1.0::DOUBLE) / (pl + 2.0::DOUBLE) AS e FROM sums{k}),
        alike{k} AS (SELECT *, {branch} <> '' AND chi <= kinds - 1 + {u.DEVIATIONS}::DOUBLE * sqrt(2.0::DOUBLE * (kinds - 1)) + 1e-6::DOUBLE
            AND (l = 0 OR abs(bl / l - e) <= {u.DEVIATIONS}::DOUBLE * sqrt(e * (1 - e) / l)) AS alike FROM chi{k}),
        tree{k} AS (SELECT * EXCLUDE (cell, n, pool, total, kinds, l, bl, pl, pb, chi, e, alike, {branch}), CASE WHEN alike AND
            count(DISTINCT CASE WHEN alike THEN {branch} END) OVER (PARTITION BY {above}) > 1 THEN '*' ELSE {branch} END AS {branch} FROM alike{k})""")
    keys = ", ".join([*(f"o{k}" for k in range(1, u.DEPTH + 1)), "tail"])
    steps.append(f"""judged AS (SELECT host, {keys}, (sum(blocked) OVER w + {u.PRIOR_WEIGHT / 2}::DOUBLE) / (sum(labelled) OVER w + {u.PRIOR_WEIGHT}::DOUBLE) >= {u.PUREST}::DOUBLE AS gone
        FROM tree1 WINDOW w AS (PARTITION BY host, {", ".join(m)}, tail))
    SELECT page_id, host, path, rule, coalesce(said, CASE WHEN gone THEN 'block' ELSE 'allow' END) AS verdict FROM placed JOIN judged USING (host, {keys})""")
    return ", ".join(steps)


@query(_template_sql())
def op13_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URL of every page."""
    return urlfilter.judged_urls(read(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")
