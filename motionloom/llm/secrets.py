"""Secret scan in DataFrame expressions alone.

Three fixed patterns give the base spans.  Besides them, every run of at least 20 characters of the usual encodings is a
candidate.  Its encoding is inferred (decimal, hexadecimal, base 32, 36, 64), and three tests compare it with structured
text of the same length: chi-squared uniformity over the encoding's alphabet, runs of character classes, and lag-one
serial correlation of the codes.  Their z values are combined, the p value is divided by the candidate's length relative to the
mean (long spans are tested with more weight), and the Benjamini-Hochberg rule over all candidates of the table sets the
threshold.  A candidate that meets it and whose uniformity is not itself rejected is a span of kind ``random``, beside the base
spans that it overlaps; only a candidate that lies in one base span adds nothing and is left out.

Positions count code points.  They follow from the lengths of the pieces between matches, summed by a window along the
document, so a document with any number of matches costs no more than sorting them.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rewriting import matches, rebuilt
from .tables import stored

RUN, SHORTEST_RANDOM = "A-Za-z0-9+/_=-", 20
# The base patterns and the shortest match that counts.
PATTERNS = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{14,}",  # the whole run, so the same as filtering runs of any length for 18 characters
    "hex": r"(?<![0-9a-f])[0-9a-f]{16,}",
    "random": rf"(?<![{RUN}])[{RUN}]{{{SHORTEST_RANDOM},}}",
}
ASSIGNED_AT_LEAST = 12
KINDS = tuple(PATTERNS)
SYMBOLS = string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/_-="
FALSE_DISCOVERIES = 0.01
#: Structured text: its index of coincidence exceeds the uniform one by this, and neighbours change class or correlate so much.
EXCESS, CLASS_CHANGES, CORRELATION = 0.04, 0.12, 0.3
BINS_PER_DECADE, DECADES = 50, 60
PLACEHOLDER = "[SECRET]"


def _alphabet(t: Column) -> Column:
    size = F.lit(65.0)
    for pattern, symbols in ((r"^[A-Za-z0-9_=-]+$", 64.0), (r"^[A-Za-z0-9+/=]+$", 64.0), (r"^[A-Za-z0-9]+$", 62.0), (r"^[A-Z0-9]+$", 36.0), (r"^[a-z0-9]+$", 36.0),
                             (r"^[A-Z2-7]+=*$", 32.0), (r"^[a-z]+$", 26.0), (r"^[A-Z]+$", 26.0), (r"^[0-9A-F]+$", 16.0), (r"^[0-9a-f]+$", 16.0), (r"^[0-9]+$", 10.0)):
        size = F.when(t.rlike(pattern), symbols).otherwise(size)
    return size


def _chi_squared(t: Column, size: Column) -> Column:
    n = F.length(t)
    squares = F.aggregate(F.array(*map(F.lit, SYMBOLS)), F.lit(0.0), lambda total, symbol: total + F.pow(n - F.length(F.replace(t, symbol, F.lit(""))), F.lit(2.0)))
    return size * squares / n - n


def _changes(t: Column) -> Column:
    """Neighbouring letters and digits of different class, other characters aside."""
    plain = F.regexp_replace(t, "[^A-Za-z0-9]", "")
    return F.regexp_count(plain, F.lit("(?<=[a-z])[A-Z0-9]|(?<=[A-Z])[a-z0-9]|(?<=[0-9])[A-Za-z]"))


def _serial(t: Column) -> Column:
    codes = F.transform(F.filter(F.split(t, ""), lambda c: c != ""), lambda c: F.instr(F.lit(SYMBOLS), c).cast("double"))
    mean = F.aggregate(codes, F.lit(0.0), lambda a, x: a + x) / F.length(t)
    from_mean = F.transform(codes, lambda x: x - mean)
    products = F.zip_with(F.slice(from_mean, F.lit(1), F.length(t) - 1), F.slice(from_mean, F.lit(2), F.length(t) - 1), lambda a, b: a * b)
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)
    variance = total(F.transform(from_mean, lambda x: x * x))
    return F.when(variance > 0, total(products) / variance).otherwise(1.0)


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution, to about two digits at any distance."""
    side = F.abs(z)
    upper = F.exp(-side * side / 2) / (1.64 * side + F.sqrt(0.76 * side * side + 4))
    return F.when(z > 0, upper).otherwise(1 - upper)


def evidence(t: Column) -> Column:
    """Minus log10 of the p value that ``t`` is structured text; 0 if uniformity itself is rejected."""
    n, size = F.length(t).cast("double"), _alphabet(t)
    chi = _chi_squared(t, size)
    excess = n * size * EXCESS
    uniformity = (size - 1 + excess - chi) / F.sqrt(2 * (size - 1 + 2 * excess))
    runs = (_changes(t) - (n - 1) * CLASS_CHANGES) / F.sqrt((n - 1) * (CLASS_CHANGES * (1 - CLASS_CHANGES)))
    serial = (CORRELATION - F.abs(_serial(t))) * F.sqrt(n)
    uniform = chi <= size - 1 + 4 * F.sqrt(2 * (size - 1))
    return F.when(uniform, -F.log10(F.greatest(_tail((uniformity + runs + serial) / math.sqrt(3)), F.lit(1e-300)))).otherwise(0.0)


def _matches(text: Column, kind: str) -> Column:
    return matches(text, PATTERNS[kind])


def _passes(match: Column, kind: str) -> Column:
    if kind == "assign":
        return F.length(F.regexp_extract(match, PATTERNS["assign"], 2)) >= ASSIGNED_AT_LEAST
    return F.lit(True)


def spans(docs: DataFrame) -> DataFrame:
    """All base spans and candidates of ``docs`` (doc_id, text), written to the shared folder.

    Rows: row (unique for each row of ``docs``), doc_id, kind (index into KINDS), start, end, length, evidence; kind is NULL for
    failing base matches, for candidates that lie in one base span, and in the one row of a document without any.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("row", F.monotonically_increasing_id())
    rows = rows.withColumns({kind: _matches(F.col("text"), kind) for kind in KINDS})

    def described(number: int, kind: str) -> Column:
        before = F.when(F.size(kind) > 0, F.split("text", PATTERNS[kind], -1))
        return F.zip_with(kind, F.slice(before, F.lit(1), F.size(kind)), lambda m, gap: F.struct(
            F.lit(number).alias("kind"), F.length(gap).alias("gap"), F.length(m).alias("length"), _passes(m, kind).alias("passes"),
            (evidence(m) if kind == "random" else F.lit(0.0)).alias("evidence")))

    lists = [described(number, kind) for number, kind in enumerate(KINDS)]
    empty = F.expr("cast(array() as array<struct<kind:int,gap:int,length:int,passes:boolean,evidence:double>>)")
    found = rows.select("row", "doc_id", F.concat(*(F.coalesce(x, empty) for x in lists)).alias("all"))
    each = found.select("row", "doc_id", F.posexplode_outer("all").alias("k", "m")).select("row", "doc_id", "k", "m.*").repartition("row")
    along = Window.partitionBy("row", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("length")).over(along)
    placed = each.withColumn("end", end).withColumn("start", F.col("end") - F.col("length")).withColumn("kind", F.expr("if(passes, kind, NULL)"))
    base = F.col("kind") < KINDS.index("random")
    # A base span that starts where a candidate starts sorts before it.
    forward = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("base_end", F.max(F.when(base, F.col("end"))).over(forward))
    inside = ~base & (F.coalesce("base_end", F.lit(0)) >= F.col("end"))
    return stored(placed.select("row", "doc_id", F.when(~inside, F.col("kind")).alias("kind"), "start", "end", "length", "evidence"), "spans")


def discoveries(tested: DataFrame, rate: float = FALSE_DISCOVERIES) -> tuple[float, float]:
    """Least weighted evidence that counts, and the mean length, for ``tested`` candidates (length, evidence).

    Benjamini-Hochberg on a histogram of fixed size; the threshold is infinite if nothing counts.
    """
    mean, total = tested.agg(F.avg("length"), F.count("*")).first()
    if not total:
        return math.inf, 1.0
    strength = F.col("evidence") + F.log10(F.col("length") / mean)
    place = F.least(F.floor(F.greatest(strength, F.lit(0.0)) * BINS_PER_DECADE), F.lit(BINS_PER_DECADE * DECADES))
    above, threshold = 0, math.inf
    for step, n in sorted(tested.groupBy(place.alias("step")).count().collect(), reverse=True):
        above += n
        if total * 10 ** -(step / BINS_PER_DECADE) <= rate * above:
            threshold = step / BINS_PER_DECADE
    return threshold, mean


def counts_as_random(length: Column, strength: Column, threshold: float, mean: float) -> Column:
    return F.greatest(strength + F.log10(length / mean), F.lit(0.0)) >= threshold


def find(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id and ``found``, an array of (start, kind, end) in order.

    ``kind`` is an index into KINDS.  A NULL or empty text has none.  Repeated rows and NULL ids are searched like any other;
    other columns are ignored, and an empty table gives an empty result.
    """
    all_spans = spans(docs)
    threshold, mean = discoveries(all_spans.filter(F.col("kind") == KINDS.index("random")))
    counts = (F.col("kind") < KINDS.index("random")) | counts_as_random(F.col("length"), F.col("evidence"), threshold, mean)
    span = F.when(F.col("kind").isNotNull() & counts, F.struct("start", "kind", "end"))
    return all_spans.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(span)).alias("found")).drop("row")


#: An assignment with what stands before it in the same run of candidate characters.
LED_ASSIGN = rf"((?<![{RUN}])[{RUN}]*?)??" + PATTERNS["assign"]


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with the union of the spans that :func:`find` gives replaced by a placeholder in ``text``; all columns stay.

    Keys and hexadecimal runs lie in one run of candidate characters each, so three replacements in turn cover the union: assignments,
    together with the candidate that they start in if it counts as random; random candidates; and what is left of the other kinds.
    NULL and empty texts stay, repeated rows are treated alike, and an empty table stays empty.
    """
    known = spans(docs.select(F.lit(None).cast("long").alias("doc_id"), "text"))
    threshold, mean = discoveries(known.filter(F.col("kind") == KINDS.index("random")))

    def random(m: Column) -> Column:
        return (F.length(m) >= SHORTEST_RANDOM) & counts_as_random(F.length(m), evidence(m), threshold, mean)

    def without_assignment(m: Column) -> Column:
        led, found = F.regexp_extract(m, "^" + LED_ASSIGN, 1), F.length(F.regexp_extract(m, "^" + LED_ASSIGN, 3)) >= ASSIGNED_AT_LEAST
        whole = (F.length(led) == 0) | random(F.regexp_extract(m, f"^[{RUN}]+", 0))
        return F.when(~found, m).when(whole, F.lit(PLACEHOLDER)).otherwise(F.concat(led, F.lit(PLACEHOLDER)))

    steps = [(LED_ASSIGN, without_assignment), (PATTERNS["random"], lambda m: F.when(random(m), F.lit(PLACEHOLDER)).otherwise(m)),
             (PATTERNS["access"], lambda m: F.lit(PLACEHOLDER)), (PATTERNS["hex"], lambda m: F.lit(PLACEHOLDER))]
    for pattern, new in steps:
        found = docs.withColumn("_motionloom_matches", matches(F.col("text"), pattern))
        docs = found.withColumn("text", rebuilt(F.col("text"), pattern, F.col("_motionloom_matches"), new)).drop("_motionloom_matches")
    return docs
