"""Quality model, hard negatives and prefix trie against plain Python; odd rows, ties, repeated rows, empty tables."""

import hashlib
import itertools
import os
import random
import re
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
from parceltide.llm import hard_negatives as hn, list_rank, prefix_trie as pt, quality_gam as qg, text_features
from parceltide.llm.hilbert import hilbert_bits, hilbert_keys
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.01"
with_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are absent")


# -- 11 quality model


def test_shallow_tree_is_the_best_one():
    rng = np.random.default_rng(1)
    s = qg.Settings(leaves=2, least_weight=1.0, penalty=0.5)
    for _ in range(50):
        g, h = rng.normal(size=9), rng.uniform(0.1, 1.0, 9)
        gain = lambda a, b: a * a / (b + 0.5)
        cuts = [
            (gain(g[:k].sum(), h[:k].sum()) + gain(g[k:].sum(), h[k:].sum()) - gain(g.sum(), h.sum()), k)
            for k in range(1, 9) if h[:k].sum() >= 1 and h[k:].sum() >= 1
        ]
        best = max(cuts, default=(0, 0))
        want = np.full(9, -g.sum() / (h.sum() + 0.5))
        if best[0] > 1e-12:
            k = best[1]
            want = np.r_[np.full(k, -g[:k].sum() / (h[:k].sum() + 0.5)), np.full(9 - k, -g[k:].sum() / (h[k:].sum() + 0.5))]
        assert np.allclose(qg.shallow_tree(g, h, s), want)


def test_pairs_are_found_and_tables_are_sums():
    rng = np.random.default_rng(2)
    x = rng.uniform(-1, 1, (3000, 4))
    y = ((x[:, 1] > 0) ^ (x[:, 3] > 0)).astype(float)  # no feature tells anything alone
    model = qg.fit_gam(x, y, qg.Settings(rounds=20, pairs=2))
    assert model.pairs[0][:2] == (1, 3)
    assert ((qg.sigmoid(model.logits(x)) >= 0.5) == y).mean() > 0.95
    for row in x[:20]:  # a score is one table entry per feature and pair
        total = model.bias + sum(model.tables[k][qg.binned(row[k], model.edges[k])] for k in range(4))
        total += sum(t[qg.binned(row[i], model.coarse[i]), qg.binned(row[j], model.coarse[j])] for i, j, t in model.pairs)
        assert abs(total - model.logits(row[None])[0]) < 1e-9


def test_one_class_and_no_rows_give_a_constant():
    x = np.random.default_rng(3).normal(size=(10, 2))
    assert np.allclose(qg.fit_gam(x, np.ones(10)).logits(x), np.log(11))
    assert np.allclose(qg.fit_gam(np.zeros((0, 2)), np.zeros(0)).logits(x), 0)


def test_text_features():
    names = list(text_features.NAMES)
    rows = text_features.measure([b"", "Ab Ab ab. é!\nAb ab\n\nAb ab".encode(), b"x"])
    assert rows.shape == (3, len(names)) and not rows[0].any() and np.isfinite(rows).all()
    value = dict(zip(names, rows[1]))
    assert np.isclose(value["log_words"], np.log(9)) and np.isclose(value["upper_share"], 4 / 26)
    assert np.isclose(value["repeats_word"], 1 / 8) and np.isclose(value["double_lines"], 2 / 3)
    assert np.isclose(value["shouts_share"], 1 / 26) and np.isclose(value["distinct_words"], 4 / 8)
    alone = text_features.measure(["Ab Ab ab. é!\nAb ab\n\nAb ab".encode()])
    assert np.allclose(alone, rows[1:2])  # neighbours in a batch change nothing


def test_quality_odd_rows_and_held_out_labels(llm, documents):
    odd = [(1, "a b"), (1, "a b"), (None, None), (None, "x"), (2, ""), (3, " \t\n"), (4, "é" * 300_000), (5, "word " * 60_000)]
    docs = documents(odd)
    labels = llm.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 0, 0), (None, 1, 0), (4, None, 0)], "doc_id long, quality int, toxic int")
    model = qg.fit(docs, labels)
    got = qg.scores(docs, model).collect()
    assert len(got) == len(odd) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.id == 1}) == 1
    none = labels.limit(0)
    assert {round(r.score, 9) for r in qg.scores(docs, qg.fit(docs, none)).collect()} == {0.5}
    assert qg.scores(docs.limit(0), model).count() == 0
    many = documents([(i, f"text {i} " * (i % 7 + 1)) for i in range(60)])
    held = {i for i in range(60) if zlib.crc32(str(i).encode()) % 3 == 1}
    truth = llm.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    lies = llm.createDataFrame([(i, i % 2 if i not in held else 1 - i % 2) for i in range(60)], "doc_id long, quality int")
    one, other = qg.training_sample(many, truth), qg.training_sample(many, lies)
    assert len(one[1]) == 60 - len(held) and np.array_equal(one[0], other[0]) and np.array_equal(one[1], other[1])
    assert len(qg.training_sample(many, truth, qg.Settings(most_rows=7))[1]) == 7


@with_tables
def test_quality_is_learnt(llm):
    labels = {r.doc_id: r.quality for r in llm.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = [r for r in entry.queries()["op11_quality_gam"](llm, FOLDER).collect()]
    held = [r for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.5) for r in rows)
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.95


# -- 12 hard negatives


def test_hilbert_neighbours_differ_by_one_step():
    for dims, bits in ((1, 3), (2, 3), (3, 2), (5, 2)):
        points = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        keys = hilbert_keys(points, bits)
        assert len(set(keys)) == len(points)
        ordered = points[sorted(range(len(points)), key=lambda k: keys[k])]
        assert (np.abs(np.diff(ordered, axis=0)).sum(axis=1) == 1).all()
    assert hilbert_bits(np.zeros((2, 0), int), 2).shape == (2, 0)


def test_bounds_hold_and_products_are_exact():
    rng = np.random.default_rng(4)
    a, b = rng.integers(-300, 300, (7, 6)).astype(float), rng.integers(-300, 300, (20, 5)).astype(float)
    low, high = hn.bounds(a, b.min(axis=0)[None], b.max(axis=0)[None])
    found = hn.inner_products(a, b)
    assert np.array_equal(found, (a[:, :5] @ b.T).astype(int))
    assert (low[:, 0] <= found.min(axis=1)).all() and (high[:, 0] >= found.max(axis=1)).all()
    large = np.array([[2.0**40, 3.0]])
    assert hn.inner_products(large, np.array([[1.0, 2.0**14]]))[0, 0] == 2**40 + 3 * 2**14
    assert hn.inner_products(large, np.array([[2.0**40, 0.0]]))[0, 0] == hn.MOST_SCORE
    assert hn.inner_products(np.zeros((1, 0)), b).tolist() == [[0] * 20]


def mined(rows, wanted=hn.Wanted()):
    """Brute force over (id, vector, label) rows; anchors have ids divisible by 5."""
    fine = [
        (i, [int(np.floor(256 * np.float32(x).astype(float))) for x in v], g) for i, v, g in rows
        if i is not None and g is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for n, (i, v, g) in enumerate(fine):
        if i % 5:
            continue
        others = sorted(((-dot(v, w), j, k != g) for m, (j, w, k) in enumerate(fine) if m != n))
        for p, j, _ in [o for o in others if not o[2]][: wanted.positives]:
            inside = [o for o in others if o[2] and 50 * -p <= 100 * -o[0] <= 95 * -p]
            out += [(i, j, rank + 1, o[1], -p, -o[0]) for rank, o in enumerate(inside[: wanted.negatives])]
    return sorted(out)


ANY_SIZE = (hn.Sizes(), hn.Sizes(block_rows=4, panel_rows=3, slice_blocks=2, page_zones=5))


@pytest.mark.parametrize("sizes", ANY_SIZE)
def test_hard_negatives_equal_brute_force(llm, sizes):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(90):
        centre = np.eye(4)[i % 4] * 0.8
        rows.append((i, [float(x) for x in centre + rng.normal(0, 0.25, 4)], int(rng.integers(0, 3))))
    rows += [rows[10], rows[10], (200, rows[3][1], 1), (205, [0.0] * 4, 0), (210, [-1.0, 0.0, 0.0, 0.0], 2)]  # repeats, ties, signs
    rows += [(215, [0.5, 0.5], 1), (220, [], 0), (5, None, 1), (None, [1.0] * 4, 0), (225, [1.0] * 4, None)]
    rows += [(230, [1.0, None, 0.0, 0.0], 0), (235, [1.0, float("nan"), 0.0, 0.0], 0), (240, [float("inf"), 0.0, 0.0, 0.0], 0)]
    frame = llm.createDataFrame(
        [(*r, "x", 7, 0) for r in rows], "vec_id long, embedding array<float>, label int, block string, row int, key int"
    )
    counts = {}
    got = sorted(tuple(r) for r in hn.hard_negatives(frame, F.col("vec_id") % 5 == 0, sizes=sizes, counts=counts).collect())
    assert got == mined(rows) and len(got) > 100
    assert counts["positive_pairs"] <= counts["blocks"] * counts["panels"]


def test_hard_negatives_pass_over_blocks_and_empty_tables(llm):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in np.eye(8)[i % 8] + rng.normal(0, 0.02, 8)], i % 2) for i in range(400)]
    frame = llm.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    counts = {}
    sizes = hn.Sizes(block_rows=8, panel_rows=8)
    got = sorted(tuple(r) for r in hn.hard_negatives(frame, F.col("vec_id") % 5 == 0, sizes=sizes, counts=counts).collect())
    assert got == mined(rows)
    assert counts["positive_pairs"] < 0.5 * counts["blocks"] * counts["panels"]
    assert hn.hard_negatives(frame.limit(0), F.col("vec_id") % 5 == 0).count() == 0
    assert hn.hard_negatives(frame, F.col("vec_id") < 0).count() == 0
    huge = llm.createDataFrame([(0, [1e300, 1.0], 0), (1, [1e300, 1.0], 0), (2, [1.0, 1.0], 1)], "vec_id long, embedding array<double>, label int")
    assert hn.hard_negatives(huge, F.col("vec_id") == 0).count() == 0  # the positive is clipped, the negative below its window


# -- 13 prefix trie


@pytest.mark.parametrize("how", [{}, {"slice_rows": 7}, {"slice_rows": 7, "most_together": 0}])
def test_sums_to_end(llm, how):
    rnd = random.Random(7)
    rows, want = [], {}
    for start, size in ((0, 60), (1000, 1), (2000, 35)):
        order = list(range(start, start + size))
        rnd.shuffle(order)
        weights = {k: (rnd.randint(-5, 9), 1) for k in order}
        rows += [(a, b, *weights[a]) for a, b in zip(order, order[1:] + [-1])]
        total = (0, 0)
        for k in reversed(order):
            total = tuple(x + y for x, y in zip(total, weights[k]))
            want[k] = total
    links = llm.createDataFrame(rows, "at long, to long, w long, n long")
    got = {r.at: (r.w, r.n) for r in list_rank.sums_to_end(links, ["w", "n"], **how).collect()}
    assert got == want
    assert list_rank.sums_to_end(links.limit(0), ["w", "n"], **how).count() == 0


def trie(rows, group=20, most=4):
    """Brute force over (conv, turn, role, text) rows."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append(((turn is not None, turn or 0), tie, (role, text)))
    own = {c: [t for _, _, t in sorted(ts)] for c, ts in own.items()}
    paths = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % most
        paths[c] = tuple(own.get(c - c % group, [])[:h] + ts[h:])
    nodes = {p[:d]: [] for p in paths.values() for d in range(len(p) + 1)}
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            nodes[paths[c][:d]].append(c)
    words = lambda n: len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0
    below = {n: [m for m in nodes if m[: len(n)] == n] for n in nodes}
    kids = {n: [m for m in below[n] if len(m) == len(n) + 1] for n in nodes}
    return sorted((
        cs[0], len(n), nodes[n[:-1]][0] if n else -1, len(cs), len(kids[n]), sum(not kids[m] for m in below[n]),
        sum((len(nodes[m]) - 1) * words(m) for m in below[n]),
        hashlib.sha256(",".join(str(c) for c in cs if paths[c] == n).encode()).hexdigest(),
    ) for n, cs in nodes.items())


def rows_of(frame):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, *r[3:]) for r in frame.collect())


@pytest.mark.parametrize("how", [{}, {"slice_rows": 5, "most_together": 0}])
def test_trie_equals_brute_force(llm, how, monkeypatch):
    rnd = random.Random(8)
    say = ["hi there", "tell me more", "", None, "ok", "a\tb c"]
    rows = [(c, t, rnd.choice(["user", "assistant", None]), rnd.choice(say)) for c in range(45) for t in range(rnd.randint(1, 5))]
    rows += [(50, None, "user", "first"), (50, 0, "user", "second"), (50, 0, "user", "second"), (50, 0, "bot", "tie")]
    rows += [(60, t, "user", f"turn {t}") for t in range(80)] + [(61, t, "user", f"turn {t}") for t in range(80)]
    rows += [(c, 0, "user", "the same opening") for c in (100, 120, 140, 160, 180)]  # own groups
    rows += [(None, 0, "user", "nobody"), (207, 0, "user", "one turn, base absent"), (208, 0, "u", "x"), (209, 0, "u", "y"), (210, 0, "u", "z")]
    monkeypatch.setattr(pt, "PIECE", 6)
    frame = llm.createDataFrame([(*r, 1, "k") for r in rows], "conv_id long, turn long, role string, text string, pos int, key string")
    got = rows_of(pt.prefix_trie(*pt.with_shared_heads(pt.turns_of(frame)), **how))
    assert got == trie(rows)
    plain = rows_of(pt.prefix_trie(*pt.as_they_are(pt.turns_of(frame)), **how))
    assert plain == trie(rows, most=1)


def test_trie_of_nothing_and_of_turnless_conversations(llm):
    frame = llm.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert pt.prefix_trie(*pt.with_shared_heads(pt.turns_of(frame))).count() == 0
    lone = next(c for c in range(21, 400) if c % 20 and zlib.crc32(str(c).encode()) % 4)
    rows = [(lone, 0, "user", "replaced by a base that is absent")]
    got = rows_of(pt.prefix_trie(*pt.with_shared_heads(pt.turns_of(llm.createDataFrame(rows, frame.schema)))))
    assert got == trie(rows) and len(got) == 1


def test_digests_of_long_lists_come_in_pieces(llm, monkeypatch):
    monkeypatch.setattr(pt, "PIECE", 50)
    ends = llm.range(500).select(F.lit(1).cast("long").alias("a"), F.lit(2).cast("long").alias("b"), F.col("id").alias("conv"))
    want = hashlib.sha256(",".join(map(str, range(500))).encode()).hexdigest()
    assert [r.ends_sha256 for r in pt.end_digests(ends).collect()] == [want]
