import random

import numpy as np
import pytest

from parceltide.operators.ranking import global_rank, running_totals
from parceltide.operators.selection import quantiles
from pyspark.sql import functions as F


def test_global_rank_matches_sorting(spark):
    random.seed(1)
    rows = [(random.randint(0, 5), i) for i in range(500)]
    frame = spark.createDataFrame(random.sample(rows, len(rows)), "a int, b int")
    got = global_rank(frame, [F.col("a").desc(), F.col("b")]).collect()
    expected = {pair: i for i, pair in enumerate(sorted(rows, key=lambda r: (-r[0], r[1])), start=1)}
    assert {(r["a"], r["b"]): r["rank"] for r in got} == expected


def test_running_totals_with_a_hot_group(spark):
    rows = [("hot" if i % 3 else f"g{i % 7}", i, i % 5) for i in range(900)]
    frame = spark.createDataFrame(rows, "g string, k int, v int")
    got = {(r["g"], r["k"]): r["total"] for r in running_totals(frame, [F.col("k")], {"total": "v"}, ["g"]).collect()}
    sums, expected = {}, {}
    for g, k, v in sorted(rows):
        sums[g] = sums.get(g, 0) + v
        expected[g, k] = sums[g]
    assert got == expected


@pytest.mark.parametrize("read_out", [10_000, 20])
@pytest.mark.parametrize("within", [[], ["g"]])
def test_exact_quantiles(spark, within, read_out):
    random.seed(2)
    rows = [("a" if i % 4 else "b", random.choice([1.5, 2.0, random.random() * 10, 10 ** random.uniform(-3, 3), None])) for i in range(400)]
    frame = spark.createDataFrame([*rows, ("none", None)], "g string, v double")
    probabilities = {"low": 0.0, "mid": 0.5, "p95": 0.95, "high": 1.0}
    got = quantiles(frame, "v", probabilities, within, read_out).collect()
    assert len(got) == (2 if within else 1)
    for r in got:
        values = [v for g, v in rows if v is not None and (not within or g == r["g"])]
        for name, p in probabilities.items():
            assert r[name] == pytest.approx(np.quantile(values, p), rel=1e-12)


@pytest.mark.parametrize("read_out", [10_000, 1])
def test_quantiles_of_infinities_equal_values_and_nothing(spark, read_out):
    inf, nan = float("inf"), float("nan")
    odd = [-inf, -inf, -1.7e308, -5e-324, 0.0, 5e-324, 1.7e308, inf, nan]
    frame = spark.createDataFrame([(float(v),) for v in odd], "v double")
    places = {f"p{k}": k / 8 for k in (0, 2, 3, 4, 5, 6)}
    row = quantiles(frame, "v", places, read_out=read_out).first()
    assert [row[f"p{k}"] for k in (2, 3, 4, 5, 6)] == [odd[k] for k in (2, 3, 4, 5, 6)]
    same = spark.createDataFrame([("x", 7.0)] * 50 + [("y", 1.0), ("y", 2.0)], "g string, v double")
    assert {r.g: r.m for r in quantiles(same, "v", {"m": 0.5}, ["g"], read_out).collect()} == {"x": 7.0, "y": 1.5}
    assert quantiles(frame.limit(0), "v", {"m": 0.5}, read_out=read_out).first()["m"] is None
    assert quantiles(same.limit(0), "v", {"m": 0.5}, ["g"], read_out).count() == 0


def test_even_count_interpolates(spark):
    frame = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "v double")
    assert quantiles(frame, "v", {"m": 0.5}).first()["m"] == 2.5


def test_quantile_of_many_columns_takes_few_passes(spark, monkeypatch):
    """Every value of every column became a row, joined with the ranks in each of several passes."""
    from parceltide.operators import selection

    rng = np.random.default_rng(4)
    wide = rng.permutation(200001) / 7.0  # more different values than are kept
    wide[:3] = [np.inf, -np.inf, np.nan]
    few = rng.integers(0, 5, 200001).astype(float)
    frame = spark.createDataFrame(list(zip(wide.tolist(), few.tolist())), "wide double, few double").repartition(4).selectExpr(
        "wide", "few", "cast(null as double) none", "if(few > 1, few, null) gaps", "cast('NaN' as double) nan"
    )
    passes = []
    inside = selection._inside
    monkeypatch.setattr(selection, "_inside", lambda *a: passes.append(a[1]) or inside(*a))
    for p in (0.0, 0.3, 0.5, 1.0):
        got = selection.column_quantile(frame, frame.columns, p)
        at = lambda v: np.sort(v)[int(np.floor((len(v) - 1) * p))]
        assert set(got) == {"wide", "few", "gaps", "nan"} and np.isnan(got["nan"])
        assert got["few"] == at(few) and got["gaps"] == at(few[few > 1])
        low, high = np.sort(wide)[[int(np.floor(200000 * p)), int(np.ceil(200000 * p))]]
        assert np.array_equal(got["wide"], low + (high - low) * (200000 * p - np.floor(200000 * p)), equal_nan=True)
    assert len(passes) <= 8 and all(set(later) <= {0} for later in passes[1::2])
    assert selection.column_quantile(frame.limit(0), frame.columns, 0.5) == {}
    assert selection.column_quantile(frame.selectExpr("if(wide is null or few < 4, null, few + 0.5) x").limit(0).unionByName(
        spark.createDataFrame([(1.0,), (2.0,), (None,)], "x double")), ["x"], 0.5) == {"x": 1.5}
