"""Second-order boosting against a plain numpy one."""

import json
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler

from parceltide.operators import boosting as B

PLAIN = B.Boosting(rounds=4, depth=2, rate=0.3, row_share=1.0, column_share=1.0, least_weight=2.0, penalty=5.0, least_gain=0.1)


def made(n, seed=1):
    rng = np.random.default_rng(seed)
    x = np.stack((rng.integers(0, 40, n) / 4, rng.normal(size=n).round(2), rng.integers(0, 2, n)), axis=1)
    y = (rng.random(n) < 1 / (1 + np.exp(2 - x[:, 0] / 2 + x[:, 1] * x[:, 2]))).astype(float)
    return x, y, np.where(y == 1, 2.5, 1.0)


def brute(x, y, w, how):
    """Exact greedy trees of depth 2 over all distinct values, as nested tuples, and the final scores."""
    score = lambda g, h: g * g / (h + how.penalty)
    margin, trees = np.zeros(len(y)), []

    def cut(rows, g, h):
        best = (0.0, None, None)
        for f in range(x.shape[1]):
            for v in np.unique(x[rows, f])[1:]:
                left, right = rows & (x[:, f] < v), rows & (x[:, f] >= v)
                if min(h[left].sum(), h[right].sum()) < how.least_weight:
                    continue
                gain = score(g[left].sum(), h[left].sum()) + score(g[right].sum(), h[right].sum()) - score(g[rows].sum(), h[rows].sum())
                if gain > best[0] + 1e-9:
                    best = (gain, f, v)
        return best

    for _ in range(how.rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)
        step = np.zeros(len(y))

        def build(rows, level):
            gain, f, v = cut(rows, g, h) if level < how.depth else (0.0, None, None)
            if f is not None:
                left, right = build(rows & (x[:, f] < v), level + 1), build(rows & (x[:, f] >= v), level + 1)
                if gain >= how.least_gain or isinstance(left, tuple) or isinstance(right, tuple):
                    return f, v, left, right
            value = -g[rows].sum() / (h[rows].sum() + how.penalty) * how.rate
            step[rows] = value
            return value

        trees.append(build(np.ones(len(y), bool), 0))
        margin = margin + step
    return trees, margin


def as_frame(spark, x, y, w):
    return spark.createDataFrame([([float(v) for v in r], float(a), float(b)) for r, a, b in zip(x, y, w)], "x array<double>, label double, weight double")


def leaf_values(tree):
    if not isinstance(tree, tuple):
        return {round(tree, 5)}
    return leaf_values(tree[2]) | leaf_values(tree[3])


@pytest.mark.parametrize("how", [PLAIN, replace(PLAIN, least_gain=6.0), replace(PLAIN, least_weight=15.0), replace(PLAIN, depth=3, rounds=2)])
def test_trees_equal_brute_force(spark, how):
    x, y, w = made(200)
    trees = B.fit_trees(as_frame(spark, x, y, w), how)
    want, margin = brute(x, y, w, how)
    assert np.allclose(B.margins(trees, x), margin, atol=1e-5)
    for tree, other in zip(trees, want):
        assert {round(v, 5) for v in tree.values} == leaf_values(other)


def test_weak_splits_collapse_and_light_children_are_refused(spark):
    x, y, w = made(200)
    none = B.fit_trees(as_frame(spark, x, y, w), replace(PLAIN, rounds=1, least_gain=1e9))[0]
    assert none.depth == 0 and len(set(none.values)) == 1
    assert none.values[0] == pytest.approx(0.3 * -(w * (0.5 - y)).sum() / ((w * 0.25).sum() + 5.0), abs=1e-6)
    assert B.fit_trees(as_frame(spark, x, y, w), replace(PLAIN, rounds=1, least_weight=1e9))[0].depth == 0
    # a weak root stays while a split below it is strong
    assert B.pruned([0, 1, -1], {0: 0.01, 1: 5.0}, 0.1) == [0, 1, -1]
    assert B.pruned([0, 1, -1], {0: 0.01, 1: 0.05}, 0.1) == [-1, -1, -1]


def test_blocks_and_samples_do_not_change_with_the_partitions(spark, monkeypatch):
    monkeypatch.setattr(B, "BLOCK_ROWS", 64)
    monkeypatch.setattr(B, "PARTITION_BLOCKS", 1)
    monkeypatch.setattr(B, "REFRESH", 3)
    x, y, w = made(300)
    trees = B.fit_trees(as_frame(spark, x, y, w), PLAIN)
    assert np.allclose(B.margins(trees, x), brute(x, y, w, PLAIN)[1], atol=1e-5)
    drawn = B._drawn(7, 1000, 3, replace(PLAIN, row_share=0.8))
    assert 740 < drawn.sum() < 860 and (drawn == B._drawn(7, 1000, 3, replace(PLAIN, row_share=0.8))).all()
    assert (drawn != B._drawn(7, 1000, 4, replace(PLAIN, row_share=0.8))).any()
    assert B.fit_trees(as_frame(spark, x, y, w).limit(0), PLAIN) == []


def test_model_is_saved_with_its_pipeline(spark, tmp_path):
    x, y, w = made(80)
    frame = spark.createDataFrame([(*map(float, r), float(a), float(b)) for r, a, b in zip(x, y, w)], "a double, b double, c double, label double, weight double")
    stages = [VectorAssembler(inputCols=["a", "b", "c"], outputCol="features"), B.SecondOrderBoosting(replace(PLAIN, rounds=2))]
    model = Pipeline(stages=stages).fit(frame)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    one, other = ([r.probability.toArray().tolist() for r in m.transform(frame).collect()] for m in (model, again))
    assert one == other and all(abs(sum(p) - 1) < 1e-12 for p in one)
    want = 1 / (1 + np.exp(-brute(x, y, w, replace(PLAIN, rounds=2))[1]))
    assert np.allclose([p[1] for p in one], want, atol=1e-5)
    assert json.loads(again.stages[-1].getOrDefault("trees_json"))


def test_a_pass_is_one_small_job_over_all_cores(spark):
    """Every pass was a planned query of two stages, over one task per 32 blocks."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, 40, (9 * B.BLOCK_ROWS // 2, 3)).astype(float)
    y = (x[:, 0] > 20).astype(float)
    how = replace(PLAIN, rounds=3)
    held = []
    kept = B._kept
    B._kept = lambda blocks: held.append(kept(blocks)) or held[-1]
    try:
        trees = B.fit_trees(as_frame(spark, x, y, np.ones(len(x))), how)
    finally:
        B._kept = kept
    assert held[0].getNumPartitions() > 1
    assert np.allclose(B.margins(trees, x), brute(x, y, np.ones(len(x)), how)[1], atol=1e-5)
    direct, B.DIRECT_TASKS = B.DIRECT_TASKS, 1  # sums that meet in a few tasks first
    try:
        assert B.fit_trees(as_frame(spark, x, y, np.ones(len(x))), how) == trees
    finally:
        B.DIRECT_TASKS = direct


def test_one_hot_features_share_lanes_and_give_the_same_trees(spark):
    """Every column of a one-hot vector was summed up on its own in every pass."""
    rng = np.random.default_rng(9)
    x, y, w = made(300)
    kind, other = rng.integers(0, 6, 300), rng.integers(0, 3, 300)
    hot = np.concatenate([x, (kind[:, None] == range(6)).astype(float), (other[:, None] == range(1, 3)).astype(float), np.ones((300, 1))], axis=1)
    y = np.where(kind == 2, 1.0, y)
    frame = as_frame(spark, hot, y, w)
    cuts = B.cut_points(frame, 12, 256)
    where = B.shared_lanes(frame, cuts, 256)
    assert [len(c) for c in cuts[2:]] == [1] * 9 + [0]
    assert len(where.many) < 8 and len({k for k, c in zip(where.lane, where.code) if c}) >= 3
    for k in range(12):  # no row has two features of a lane in their upper bin
        same = [f for f in range(12) if where.code[f] and where.code[k] and where.lane[f] == where.lane[k]]
        assert hot[:, same].sum(axis=1).max(initial=0) <= 1
    how = replace(PLAIN, depth=3, rounds=3)
    want, margin = brute(hot, y, w, how)
    trees = B.fit_trees(frame, how)
    assert np.allclose(B.margins(trees, hot), margin, atol=1e-5)
    alone = B.shared_lanes
    try:  # a lane per feature
        B.shared_lanes = lambda rows, cuts, bins: B.Lanes(list(range(12)), [0] * 12, [len(c) + 1 for c in cuts])
        assert B.fit_trees(frame, how) == trees
    finally:
        B.shared_lanes = alone


def test_a_pass_reads_files_of_its_machine_and_lost_ones_are_made_again(spark, monkeypatch):
    """Every pass sent all rows to Python again and worked out up to eight trees anew; a task held 32 blocks."""
    from pathlib import Path

    x, y, w = made(300)
    frame = as_frame(spark, x, y, w)
    where = B.shared_lanes(frame, B.cut_points(frame, 3, 256), 256)
    assert sorted(k for lanes in where.joint() for k in lanes) == list(range(len(where.many)))
    held, hits, last = [], [], []
    kept, grow = B._kept, B.grow
    monkeypatch.setattr(B, "_kept", lambda places: held.append(kept(places)) or held[-1])

    def grown(places, trees, start, *rest):
        last[:] = places.collect()
        if len(trees) == 3 and len(held) == 1:  # a machine goes with its files after three trees
            for folder in last:
                hits.extend(f.name for f in Path(folder).iterdir())
                for f in Path(folder).iterdir():
                    f.unlink()
        return grow(places, trees, start, *rest)

    whole = B.fit_trees(frame, PLAIN)
    monkeypatch.setattr(B, "grow", grown)
    held.clear()
    assert B.fit_trees(frame, PLAIN) == whole and len(held) == 2
    assert {"lanes", "known", "scores-2", "slopes-2"} <= set(hits) and "scores-0" not in hits
    assert last and not any(Path(folder).exists() for folder in last)


def test_cuts_are_at_exact_ranks_and_merged_points_stay_close(spark, monkeypatch):
    """Every value of every feature was moved into a row of its own; ranks of 20000 values were not exact."""
    rng = np.random.default_rng(3)
    x = np.stack((rng.normal(size=20000), rng.integers(0, 300, 20000) ** 2, np.full(20000, 7.0), rng.integers(1, 3, 20000)), axis=1)
    cuts = B.cut_points(as_frame(spark, x, x[:, 2], x[:, 2]), 4, 256)
    for k in (0, 1):
        values = np.sort(x[:, k])
        want = np.unique([*values[np.ceil(np.arange(1, 256) / 256 * 20000).astype(int) - 1], values[-1]])
        assert (cuts[k] == want[want > values[0]][:255]).all()
    assert len(cuts[2]) == 0 and cuts[3].tolist() == [2.0]
    from parceltide.operators import selection

    monkeypatch.setattr(selection, "POINTS", 1000)
    points = selection.Points()
    for part in np.split(x[:, 0], 40):
        points.add(*np.unique(part, return_counts=True))
    values, counts = points.merged()
    assert len(values) <= 1000 and counts.sum() == 20000 and values[0] == x[:, 0].min() and values[-1] == x[:, 0].max()
    ranks = np.searchsorted(np.sort(x[:, 0]), values, side="right")
    assert (ranks - np.cumsum(counts)).min() >= 0
    assert (ranks - np.cumsum(counts)).max() <= points.error <= 20000 * 16 / 1000
