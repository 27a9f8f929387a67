import os
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hydrolap.operators import dedup
from hydrolap.operators.mining import auc, roc_points, stratified_folds
from hydrolap.operators.ordered import hashed_rank, running_totals, surrogate_keys
from hydrolap.operators.quantiles import exact_quantiles


def hot_rows(n=3000, seed=1):
    """A third of the rows share one key; one key is null."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else (None if i % 97 == 0 else f"k{rnd.randrange(900)}")
        rows.append((key, rnd.choice([1, 2]), i, round(rnd.lognormvariate(0, 2), 3)))
    return rows


@pytest.fixture(scope="module")
def hot(spark):
    rows = hot_rows()
    return spark.createDataFrame(rows, "k string, b int, o int, v double").repartition(7), rows


def test_first_wins_with_hot_key(hot):
    df, rows = hot
    first = {}
    for k, b, o, _ in sorted(rows, key=lambda r: r[2]):
        first.setdefault((k, b), o)
    got = {(r.k, r.b): r.o for r in dedup.first_rows(df, ["k", "b"], ["o"]).collect()}
    assert got == first
    assert dedup.later_rows(df, ["k", "b"], ["o"]).count() == len(rows) - len(first)


def test_duplicate_members(hot):
    df, rows = hot
    counts = pd.Series([str(r[0]) + str(r[1]) for r in rows]).value_counts()
    assert dedup.duplicate_members(df, ["k", "b"]).count() == counts[counts > 1].sum()


def test_three_copies(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 4)], "k string, o int").select("k", F.col("o") * 0 + 1, "o")
    got = dedup.duplicate_profile(df.select("k")).first()
    assert (got.rows, got.extra_rows, got.duplicate_groups, got.pct_extra, got.pct_groups) == (4, 2, 1, 50.0, 25.0)


PROBS = {"p0": 0.0, "q1": 0.25, "m": 0.5, "q3": 0.75, "p99": 0.99, "p1": 1.0}


def test_quantiles_equal_brute_force(hot):
    df, rows = hot
    frame = pd.DataFrame(rows, columns=["k", "b", "o", "v"])
    for r in exact_quantiles(df, "v", PROBS, by=["b"]).collect():
        values = frame[frame.b == r.b].v
        assert r.n == len(values)
        for name, q in PROBS.items():
            assert r[name] == pytest.approx(np.quantile(values, q), abs=1e-12)
    whole = exact_quantiles(df, "v", {"m": 0.5}).first()
    assert whole.m == pytest.approx(np.quantile(frame.v, 0.5), abs=1e-12)


def test_quantiles_of_hard_values(spark):
    """Neighbouring doubles, all scales, both signs, zeros of both signs, one value a million times, infinities, NaN and null."""
    rnd = random.Random(8)
    neighbours = [1.0]
    for _ in range(3000):
        neighbours.append(float(np.nextafter(neighbours[-1], 2.0)))
    scales = [s * rnd.random() * 2.0 ** rnd.randint(-1073, 1023) for _ in range(3000) for s in (1, -1)] + [5e-324, 1e-323, -5e-324, 0.0, -0.0]
    groups = {"neighbours": neighbours, "scales": scales, "one": [7.25] * 5000 + [7.5], "infinite": [float("-inf"), 1.0, 2.0, 1.7976931348623157e308, float("inf")],
              "below": [-x for x in neighbours], None: [3.0, 1.0, 2.0]}
    rows = [(g, x) for g, xs in groups.items() for x in xs] + [("one", float("nan")), ("one", None), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    got = {r.g: r for r in exact_quantiles(df, "v", {**PROBS, "t": 1 / 3}, by=["g"]).collect()}
    assert set(got) == set(groups)
    for g, xs in groups.items():
        values = sorted(xs)
        assert got[g].n == len(xs)
        for name, q in {**PROBS, "t": 1 / 3}.items():
            place = q * (len(xs) - 1)
            low, high = values[int(np.floor(place))], values[int(np.ceil(place))]
            want = low + (high - low) * (place - np.floor(place))
            assert got[g][name] == want or (np.isnan(want) and np.isnan(got[g][name])), (g, name)


def test_quantile_rounds_are_few(spark, monkeypatch):
    """Numbers with two decimals are told apart in three rounds, and the row folder is removed."""
    from hydrolap import session
    from hydrolap.operators import quantiles

    stored, dropped = [], []
    monkeypatch.setattr(quantiles, "written", lambda df, name: stored.append(name) or session.written(df, name))
    monkeypatch.setattr(session, "drop_folder", lambda spark, path, drop=session.drop_folder: dropped.append(path) or drop(spark, path))
    df = spark.range(100_000).select((F.pmod(F.xxhash64("id"), F.lit(10_001)) / 100).alias("v"))
    assert exact_quantiles(df, "v", {"m": 0.5}).first().m == pytest.approx(50, abs=1)
    assert len(stored) <= 3 and len(dropped) == 1 and not os.path.exists(dropped[0].removeprefix("file:"))


def test_quantiles_of_small_groups(spark):
    df = spark.createDataFrame([("one", 3.0), ("two", 1.0), ("two", 2.0), ("null", None)], "g string, v double")
    got = {r.g: (r.n, r.q) for r in exact_quantiles(df, "v", {"q": 0.25}, by=["g"]).collect()}
    assert got == {"one": (1, 3.0), "two": (2, 1.25)}


def test_running_totals(spark):
    values = random.Random(3).sample(range(10_000), 2_000)
    df = spark.createDataFrame([(v, v % 7) for v in values], "v int, w int").repartition(9)
    got = sorted((r.v, r.position, r.cum_w) for r in running_totals(df, ["v"], ["w"]).collect())
    total, want = 0, []
    for i, v in enumerate(sorted(values), start=1):
        total += v % 7
        want.append((v, i, total))
    assert got == want


def test_surrogate_keys(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "n string")
    assert {r.n: r.k for r in surrogate_keys(df, "n", "k").collect()} == {"a": 1, "b": 2, "c": 3}


def test_folds_are_balanced(spark):
    df = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(1000)], "i int, y int")
    sizes = stratified_folds(df, "y", ["i"], 10).groupBy("y", "fold").count().collect()
    assert {(r.y, r["count"]) for r in sizes} == {(0, 80), (1, 20)}


@pytest.mark.parametrize("slice_rows", [1, 3, 40, 10_000])
def test_hashed_rank_for_any_number_of_slices(spark, slice_rows):
    import hashlib

    rows = [(i, None if i % 50 == 0 else "big" if i % 10 else "small") for i in range(300)]
    got = {(r.y, r.i): r["rank"] for r in hashed_rank(spark.createDataFrame(rows, "i int, y string"), "y", ["i"], slice_rows).collect()}
    for y in ("big", "small", None):
        ids = sorted((i for i, z in rows if z == y), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
        assert [got[y, i] for i in ids] == list(range(1, len(ids) + 1))


def test_auc_with_ties(spark):
    rnd = random.Random(5)
    rows = [(int(rnd.random() < 0.4), rnd.randrange(20) / 20) for _ in range(400)]
    df = spark.createDataFrame(rows, "label int, score double")
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    want = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert auc(df).first().auc == pytest.approx(want)
    points = sorted((r.fpr, r.tpr) for r in roc_points(df).collect())
    assert points[-1] == (1.0, 1.0) and all(a[1] <= b[1] for a, b in zip(points, points[1:]))


def test_silhouette_equals_brute_force(spark):
    from pyspark.ml.functions import array_to_vector

    from hydrolap.operators.learners import silhouette, silhouette_rows

    rnd = random.Random(9)
    rows = [(i, i % 3, [rnd.gauss(i % 3, 1.0), rnd.gauss(0, 1.0)]) for i in range(60)]
    df = spark.createDataFrame(rows, "i int, cluster int, x array<double>").withColumn("features", array_to_vector("x"))
    distance = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b))
    want = {}
    for i, c, x in rows:
        mean = {k: np.mean([distance(x, y) for j, d, y in rows if d == k and j != i]) for k in range(3)}
        a, b = mean[c], min(v for k, v in mean.items() if k != c)
        want[i] = (b - a) / max(a, b)
    got = {r.i: r.silhouette for r in silhouette_rows(df).collect()}
    assert all(got[i] == pytest.approx(want[i], abs=1e-9) for i in want)
    assert silhouette(df) == pytest.approx(np.mean(list(want.values())), abs=1e-9)


def test_nearest_centroid(spark):
    from hydrolap.operators.mining import assign_centroid

    rows = spark.createDataFrame([(0.0, 0.0), (5.0, 5.0), (1.0, 1.0)], "x double, y double")
    centres = spark.createDataFrame([(1, 0.0, 0.0), (2, 2.0, 2.0), (3, 6.0, 6.0)], "cluster int, x double, y double")
    got = {r.x: r.cluster for r in assign_centroid(rows, centres, ["x", "y"]).collect()}
    assert got == {0.0: 1, 5.0: 3, 1.0: 1}  # the smaller name wins the tie
