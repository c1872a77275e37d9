import itertools
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pavelens.llm import nearest_time, packing, percentiles


def _values(seed):
    rnd = random.Random(seed)
    rows = []
    for g, n in (("a", 700), ("b", 31), (None, 5), ("one", 1), ("same", 300)):
        for _ in range(n):
            rows.append((g, 7.25 if g == "same" else rnd.choice([0.0, 1.5, rnd.random() * 1e-9, rnd.lognormvariate(0, 3), 999.0])))
    return rows + [("a", float("nan")), ("a", None), ("a", -1.0), ("a", 1e9), ("none", None), ("b", -0.0)]


@pytest.mark.parametrize("levels, broadcast", [(8, 40_000), (1, 40_000), (3, 0)])
def test_percentiles_are_exact(spark, monkeypatch, levels, broadcast):
    monkeypatch.setattr(percentiles, "BROADCAST_STATES", broadcast)
    monkeypatch.setattr(percentiles, "SALT_ROWS", 100)
    rows = _values(1)
    df = spark.createDataFrame([(*r, "clash") for r in rows], "g string, x double, part string")
    wanted = {"X": [0.0, 0.01, 0.5, 0.95, 1.0], "Y": [0.5]}
    counts = (percentiles.value_rows if levels == 8 else percentiles.value_counts)(df, ["g"], {"X": F.col("x"), "Y": F.when(F.col("g") == "b", F.col("x")), "Z": F.col("x")}, 0.0, 1000.0)
    got = {(r["g"], r["metric"], r["p"]): r for r in percentiles.percentiles_of_counts(counts, ["g"], wanted, levels).collect()}
    seen = 0
    for g in {r[0] for r in rows}:
        v = sorted(abs(x) for a, x in rows if a == g and x is not None and not math.isnan(x) and (0 <= x <= 1000))
        for m, ps in wanted.items():
            for p in ps if v and (m == "X" or g == "b") else []:
                r = got[g, m, p]
                rank = max(1, -(-round(p * 100) * len(v) // 100))
                assert (r["value"], r["n_valid"], r["rank_error"]) == (v[rank - 1], len(v), 0.0)
                seen += 1
    assert seen == len(got) == 5 * 5 + 1


def test_days_add_up_and_errors_are_bounded(spark):
    df = spark.createDataFrame([(i % 2, float((i * 7919) % 1009)) for i in range(3000)], "day int, x double").withColumn("g", F.lit(1))
    one = lambda d: percentiles.value_counts(d, ["g"], {"X": F.col("x")}, 0.0, 2000.0)
    whole = percentiles.percentiles_of_counts(one(df), ["g"], {"X": [0.5, 0.9]})
    parts = percentiles.percentiles_of_counts(percentiles.merge_counts(one(df.filter("day = 0")), one(df.filter("day = 1"))), ["g"], {"X": [0.5, 0.9]})
    assert sorted(whole.collect()) == sorted(parts.collect())
    rough = percentiles.percentiles_of_counts(one(df), ["g"], {"X": [0.5]}, levels=2, max_rank_error=0.1).first()
    v = sorted(float((i * 7919) % 1009) for i in range(3000))
    assert 0 < rough["rank_error"] <= 0.1 and abs(v.index(rough["value"]) - 1500) <= 0.1 * 3000 + 3
    assert percentiles.percentiles_of_counts(one(df.limit(0)), ["g"], {"X": [0.5]}).count() == 0


def _nearest(lefts, rights, tol):
    out = {}
    for e, t, i in set(lefts):
        if None in (e, t, i):
            continue
        best = min(((abs(u - t), k) for f, u, k in rights if f == e and u is not None and k is not None and abs(u - t) <= tol), default=None)
        if best:
            out[t, i] = (best[1], best[0])
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 5)), max_size=40), st.lists(st.tuples(st.integers(0, 60), st.integers(0, 9)), max_size=12), st.integers(0, 9), st.integers(1, 7))
def test_merge_against_brute_force(lefts, rights, tol, batch):
    stream = sorted([(t, False, k) for t, k in rights] + [(t, True, k) for t, k in lefts])
    m, found = nearest_time._Merge(tol), []
    for lo in range(0, len(stream), batch):
        part = stream[lo : lo + batch]
        t, left, ids = (np.array(c) for c in zip(*part))
        found += m.batch([np.zeros(len(t), int)], t.astype(np.int64), left.astype(bool), ids.astype(np.int64))
    found += m.flush()
    got = sorted((int(a), int(b), int(c)) for f in found for a, b, c in zip(*f))
    want = _nearest([(0, t, k) for t, k in lefts], [(0, t, k) for t, k in rights], tol)
    assert got == sorted((i, *want[t, i]) for t, i in want)


def test_what_waits_is_bounded_by_the_tolerance():
    m = nearest_time._Merge(5)
    for lo in range(0, 50_000, 1_000):
        t = np.arange(lo, lo + 1_000, dtype=np.int64)
        m.batch([np.zeros(1_000, int)], t, np.ones(1_000, bool), t)
        assert sum(len(w[0]) for w in m.waiting) <= 6


def test_hot_entities_and_ties(spark):
    rnd = random.Random(5)
    lefts = [(rnd.choice([1, 1, 1, 2, None]), rnd.randrange(4000), i) for i in range(800)] + [(1, 77, i) for i in range(900, 1300)]
    lefts += [lefts[0], (1, None, 5000), (1, 50, None)]
    rights = [(rnd.choice([1, 2, 3, None]), rnd.randrange(4000), i) for i in range(300)] + [(1, 87, 901), (1, 67, 902), (1, 67, 903), (1, None, 1), (1, 5, None)]
    schema = "entity long, t_us long, id long"
    l, r = spark.createDataFrame(lefts, schema).withColumn("slice", F.lit("x")), spark.createDataFrame(rights, schema).withColumn("part", F.lit("x"))
    want = _nearest(lefts, rights, 25)
    for rows in (2_000_000, 50):
        got = nearest_time.nearest_in_time(l, r, 25, slice_us=60, slice_rows=rows).collect()
        assert sorted((x["left_id"], x["right_id"], x["gap_us"]) for x in got) == sorted((i, *v) for (_, i), v in want.items())
    assert nearest_time.nearest_in_time(l.limit(0), r, 25).count() == 0 and nearest_time.nearest_in_time(l, r.limit(0), 25).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.dictionaries(st.integers(0, 64), st.integers(1, 60), max_size=20))
def test_plan_uses_every_piece_once(histogram):
    plan = packing.plan_containers(histogram, 64)
    used = {}
    for pattern, n in plan:
        assert n > 0 and sum(L * k for L, k in pattern) <= 64
        for L, k in pattern:
            used[L] = used.get(L, 0) + k * n
    assert used == {L: n for L, n in histogram.items() if L}


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=9, unique=True), st.integers(0, 2**30))
def test_best_patterns_against_all(lengths, seed):
    lengths = np.array(sorted(lengths))
    gain = np.random.default_rng(seed).normal(size=len(lengths))
    found = packing.best_patterns(lengths, gain, 40, 6, 3)
    values = dict(zip(lengths.tolist(), gain))
    every = [p for n in (1, 2, 3) for p in itertools.combinations_with_replacement(lengths.tolist(), n) if 34 <= sum(p) <= 40]
    for v, p in found:
        assert tuple(sorted(p)) in every and abs(sum(values[L] for L in p) - v) < 1e-9
    best = max((sum(values[L] for L in p) for p in every), default=None)
    assert (best is None and not found) or abs(max(v for v, _ in found) - best) < 1e-9


def test_least_squares_fit():
    a = np.array([[1.0, 0, 2], [0, 1, 1], [1, 1, 0]])
    x = packing.descend(a.T @ a, a.T @ (a @ np.array([3.0, 0.0, 5.0])), np.zeros(3), 20_000)
    assert np.allclose(x, [3, 0, 5], atol=1e-2)
    rng = np.random.default_rng(4)
    a, h = rng.random((12, 8)), rng.normal(size=12)
    x = packing.descend(a.T @ a, a.T @ h, np.zeros(8), 5_000)
    slope = a.T @ (a @ x - h)
    assert (x >= 0).all() and (slope > -2e-2).all() and np.abs(slope[x > 1e-6]).max(initial=0) < 2e-2  # no repeat can be bettered


def test_the_fit_places_most_pieces():
    rng = np.random.default_rng(5)
    sizes = np.clip(rng.lognormal(6.4, 0.8, 8_000).astype(int), 5, 2048)
    h = {int(L): int(n) for L, n in zip(*np.unique(sizes, return_counts=True))}
    report = {}
    plan = packing.plan_containers(h, 2048, report=report)
    assert report["residual"] < 0.05 and report["placed"] > 0.9 * report["pieces"] and report["pieces"] == 8_000
    assert sum(n for _, n in plan) <= 1.01 * np.ceil(sizes.sum() / 2048)


def test_packing_round_trip(spark):
    rnd = random.Random(2)
    word = ["road ", "crack\n", "Straße ", "x", "  ", "🙂", "0123 "]
    docs = [(i, "".join(rnd.choice(word) for _ in range(rnd.randrange(90)))) for i in range(300)]
    docs += [(1000, None), (1001, ""), (1002, "long text " * 30_000), (1003, "<|endoftext|>" * 5)] + [(2000 + i, "same") for i in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("piece", F.lit("clash"))
    for rank_rows in (1_000_000, 20):
        got = packing.pack(df, "doc_id", "text", 64, rank_rows=rank_rows).toPandas()
        enc = packing.load_encoder(packing.tokenizer_path())
        for i, t in docs:
            mine = got[got["id"] == i].sort_values("piece")
            n = len(enc.encode_ordinary(t or ""))
            assert mine["n_tokens"].sum() == n and len(mine) == max(1, -(-n // 64)) and (mine["token_start"] == 64 * mine["piece"]).all()
        full = got[got["n_tokens"] > 0].groupby("container_id")["n_tokens"].sum()
        assert full.max() <= 64 and full.sum() / (64 * len(full)) > 0.98
        order = got[got["n_tokens"] > 0].sort_values(["container_id", "container_offset"])
        end = (order["container_offset"] + order["n_tokens"]).groupby(order["container_id"]).shift().fillna(0)
        assert (order["container_offset"] == end).all()
    assert packing.pack(df.limit(0), "doc_id", "text", 64).count() == 0
