"""Values along the order, quantiles and containment against brute force, with groups cut and whole."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from motionloom.operators import layout as L
from motionloom.operators.containment import contained, covered_by, disjoint_spans, inside_any
from motionloom.operators.quantile import quantiles

ROWS = [(k, t, i, v) for i, (k, t, v) in enumerate(
    (random.Random(i).choice("abb"), random.Random(i + 99).randrange(12), random.Random(i + 7).choice([None, 1, 2, 5]))
    for i in range(60))]


def expected():
    out = {}
    for key in "ab":
        rows = sorted((r for r in ROWS if r[0] == key), key=lambda r: (r[1], r[2]))
        values = [r[3] for r in rows]
        for i, r in enumerate(rows):
            before = [v for v in values[: i + 1] if v is not None]
            after = [v for v in values[i:] if v is not None]
            out[r[2]] = (values[i - 1] if i else None, values[i + 1] if i + 1 < len(rows) else None,
                         before[-1] if before else None, after[0] if after else None,
                         sum(before) if before else None, max(before) if before else None, i)
    return out


@pytest.mark.parametrize("split", [False, True])
def test_values_along_the_order(spark, split):
    if split:
        spark.conf.set("spark.motionloom.rowsPerTask", "4")
    try:
        df = spark.createDataFrame(ROWS, "recording_id string, t_ns bigint, seq bigint, v int").repartition(5)
        v = F.col("v")
        layout = L.numbered(L.along(
            L.ordered(df), p=L.previous(v), n=L.following(v), l=L.last_seen(v), x=L.next_seen(v),
            s=L.running_sum(v), m=L.running_max(v)), "i")
        assert layout.split is split
        got = {r.seq: (r.p, r.n, r.l, r.x, r.s, r.m, r.i) for r in layout.frame.collect()}
        assert got == expected()
    finally:
        spark.conf.unset("spark.motionloom.rowsPerTask")


def test_cut_groups_are_of_similar_size_even_with_one_hot_time(spark):
    spark.conf.set("spark.motionloom.rowsPerTask", "100")
    try:
        df = spark.range(2000).select(F.lit("hot").alias("recording_id"), F.lit(5).cast("bigint").alias("t_ns"),
                                      F.col("id").alias("seq"))
        layout = L.ordered(df)
        sizes = [r[1] for r in layout.rows.groupBy(L.CHUNK).count().collect()]
        assert layout.split and sum(sizes) == 2000 and max(sizes) < 400
    finally:
        spark.conf.unset("spark.motionloom.rowsPerTask")


def test_only_a_hot_recording_is_cut_and_written(spark):
    spark.conf.set("spark.motionloom.rowsPerTask", "100")
    try:
        df = spark.range(1500).select(F.when(F.col("id") < 900, F.lit("hot")).otherwise(F.concat(F.lit("r"), F.col("id") % 20)).alias("recording_id"),
                                      (F.col("id") % 13).alias("t_ns"), F.col("id").alias("seq"))
        layout = L.ordered(df)
        counted = {(r["recording_id"], r[L.CHUNK] == L.WHOLE): r["count"] for r in layout.rows.groupBy("recording_id", L.CHUNK).count().collect()}
        assert layout.split and {k for k, whole in counted if not whole} == {"hot"} and ("hot", True) not in counted and len(counted) == 21
        written = [line for line in layout.rows._jdf.queryExecution().optimizedPlan().toString().splitlines() if "LogicalRDD" in line]
        assert layout.rows.where(F.col(L.CHUNK) != L.WHOLE).count() == 900 and written
        rows = L.numbered(L.along(layout, before=L.previous(F.col("seq")), most=L.running_max(F.col("seq"))), "i").frame.collect()
        for name in {r.recording_id for r in rows}:
            mine = sorted((r for r in rows if r.recording_id == name), key=lambda r: (r.t_ns, r.seq))
            assert [r.i for r in mine] == list(range(len(mine)))
            assert [r.before for r in mine] == [None, *(r.seq for r in mine[:-1])]
            assert [r.most for r in mine] == [max(x.seq for x in mine[:k + 1]) for k in range(len(mine))]
    finally:
        spark.conf.unset("spark.motionloom.rowsPerTask")


@pytest.mark.parametrize("limit", [None, 1, 20])
def test_quantiles_equal_numpy(spark, limit):
    rng = np.random.default_rng(3)
    rows = [("a", float(x)) for x in rng.normal(size=101)] + [("b", float(x)) for x in rng.integers(0, 4, 60)] + [("a", None)]
    spark.conf.set("spark.motionloom.rowsPerTask", "7")
    try:
        df = spark.createDataFrame(rows, "k string, v double")
        got = {r.k: r for r in quantiles(df, ["k"], "v", limit, lo=0.05, mid=0.5, hi=0.95).collect()}
    finally:
        spark.conf.unset("spark.motionloom.rowsPerTask")
    for key in "ab":
        values = [v for k, v in rows if k == key and v is not None]
        assert np.allclose([got[key].lo, got[key].mid, got[key].hi], np.percentile(values, [5, 50, 95]))


@pytest.mark.parametrize("limit", [3, 50, None])
def test_quantiles_of_awkward_values(spark, limit):
    """Both signs, zeros of both signs, infinities, subnormal and huge values, dense clusters, and a group of one value."""
    rng = np.random.default_rng(4)
    groups = {"wide": np.concatenate([rng.normal(size=200) * 10.0 ** rng.integers(-300, 300, 200), [0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308]]),
              "dense": 1.0 + rng.integers(0, 1 << 12, 400) * 2.0 ** -52, "one": np.full(90, -7.25), "clusters": np.concatenate([1 + rng.random(150) * 1e-12, 1 + rng.random(150) * 1e-3]),
              "endless": np.array([float("-inf")] * 3 + [1.0, 2.0] + [float("inf")] * 4)}
    df = spark.createDataFrame([(k, float(v)) for k, vs in groups.items() for v in vs], "k string, v double").repartition(4)
    points = {"a": 0.0, "b": 0.05, "c": 0.25, "d": 0.5, "e": 0.875, "f": 1.0}
    got = {r.k: r for r in quantiles(df, ["k"], "v", limit, **points).collect()}
    for key, values in groups.items():
        s = np.sort(values)
        assert got[key].n == len(s)
        for name, p in points.items():
            at = p * (len(s) - 1)
            lo, hi = s[int(np.floor(at))], s[int(np.ceil(at))]
            want = lo if at == int(at) else lo * (1 - at % 1) + hi * (at % 1)
            assert got[key][name] == want or np.isnan(want) and np.isnan(got[key][name]), (key, name)


def test_quantiles_of_whole_numbers_beyond_a_double(spark):
    values = [2**60 + k for k in range(-50, 51)]
    df = spark.createDataFrame([("k", v) for v in values], "k string, v bigint")
    row = quantiles(df, ["k"], "v", 4, lo=0.0, mid=0.5, hi=1.0).first()
    assert (row.n, row.lo, row.mid, row.hi) == (101, float(values[0]), float(2**60), float(values[-1]))


def test_quantiles_shuffle_only_the_cells_they_need(spark):
    """Of 20,000 values, those in the cells that hold a wanted rank leave the scan."""
    df = spark.range(20_000).select(F.lit("k").alias("k"), (1 + F.col("id") / 7).alias("v"))
    result = quantiles(df, ["k"], "v", mid=0.5)
    result.collect()
    plan = result._jdf.queryExecution().executedPlan()
    assert abs(result.first().mid - (1 + 19_999 / 14)) < 1e-9 and "BroadcastHashJoin" in plan.toString()


def spans_and_points(seed):
    rng = random.Random(seed)
    spans = [("r", i, s := rng.randrange(-20, 60), s + rng.randrange(0, 30), f"v{i}") for i in range(25)]
    points = [("r", i, rng.randrange(-25, 95)) for i in range(80)]
    return spans, points


@pytest.mark.parametrize("seed", range(3))
def test_containment_against_every_pair(tiny_tasks, seed):
    spark = tiny_tasks
    spans, points = spans_and_points(seed)
    s = spark.createDataFrame(spans, "recording_id string, seq bigint, t_start_ns bigint, t_end_ns bigint, label string")
    p = spark.createDataFrame(points, "recording_id string, seq bigint, t_ns bigint")
    got = {r.seq: r.label for r in covered_by(p, s, ["label"]).collect()}
    assert got == {i: next((v for _, _, a, b, v in reversed(spans) if a <= t < b), None) for _, i, t in points}
    flags = {r.seq: r.f for r in inside_any(p, s, "f").collect()}
    assert flags == {i: any(a <= t <= b for _, _, a, b, _ in spans) for _, i, t in points}
    windows = s.select("recording_id", F.col("seq").alias("w"), F.col("t_start_ns").alias("lo"), F.col("t_end_ns").alias("hi"))
    pairs = {(r.seq, r.w) for r in contained(p, windows, ["recording_id"], "t_ns").collect()}
    assert pairs == {(i, w) for _, i, t in points for _, w, a, b, _ in spans if a <= t <= b}
    apart = sorted((r.t_start_ns, r.t_end_ns) for r in disjoint_spans(s, ["label"], "seq").collect())
    assert all(end <= start for (_, end), (start, _) in zip(apart, apart[1:]))


def test_attach_gives_the_same_rows_broadcast_and_salted(spark):
    rows = spark.range(500).select((F.col("id") % 3).alias("k"), F.col("id"))
    lookup = spark.createDataFrame([(0, "a"), (1, "b")], "k bigint, name string")
    whole = sorted(map(tuple, L.attach(rows, lookup, ["k"]).collect()), key=str)
    spark.conf.set("spark.motionloom.broadcastRows", "1")
    try:
        salted = L.attach(rows, lookup, ["k"])
        assert sorted(map(tuple, salted.collect()), key=str) == whole and len(whole) == 500
        assert "Broadcast" not in salted._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.motionloom.broadcastRows")


def test_swept_points_are_laid_out_once(spark):
    """Pairs of points and windows are read from rows written once; no later step sorts all points again."""
    from motionloom.operators.containment import contained
    points = spark.createDataFrame([(k % 3, k, k * 7 % 50) for k in range(60)], "source long, point_id long, t long")
    windows = spark.createDataFrame([(k % 3, k, k * 5, k * 5 + 9) for k in range(9)], "source long, w long, lo long, hi long")
    found = contained(points, windows, ["source"], "t")
    assert "Window" not in found._jdf.queryExecution().optimizedPlan().toString()
    want = points.join(windows, "source").where("t BETWEEN lo AND hi")
    assert sorted((r.point_id, r.w) for r in found.collect()) == sorted((r.point_id, r.w) for r in want.collect())
