import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marquetry.llm.mixing import flight, landing, mix_sources, mixture_plan, reserve, shares_reached
from marquetry.llm.packing import Bins, pack_items, pack_shard
from marquetry.llm.tokens import load_tokenizer, token_counts


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=80))
def test_shard(sizes):
    where = pack_shard(np.array(sizes, np.int64), 100)
    fill = np.bincount(where, sizes) if sizes else np.zeros(0)
    assert (fill <= 100).all() and (fill > 0).all() and len(where) == len(sizes)
    assert len(fill) <= math.ceil(11 / 9 * math.ceil(sum(sizes) / 100)) + 40


def test_search_improves_on_best_fit():
    # best fit leaves three bins; exchanges empty one of them
    sizes = np.array([6, 5, 5, 4, 4, 3, 3])
    bins = Bins(sizes, 10)
    for i, b in enumerate([0, 1, 2, 2, 1, 0, 3]):
        while len(bins.fill) <= b:
            bins.fill.append(0)
            bins.items.append([])
        bins.put(i, b)
    before = sum(f * f for f in bins.fill)
    bins.search()
    assert sum(f * f for f in bins.fill) > before and sum(f > 0 for f in bins.fill) == 3


def packed(spark, rows, capacity=100, **how):
    df = spark.createDataFrame(rows, "doc bigint, tokens bigint")
    out = pack_items(spark, df, capacity, **how).toPandas()
    # a column with nulls comes as floats, which hold the numbers of the last round as well
    assert out.sequence.max() < 2**53 or not len(out)
    return out


@pytest.mark.parametrize("shard,slack", [(8192, 1.02), (64, 1.05)])  # small shards fill less well
def test_items(spark, shard, slack):
    rng = np.random.default_rng(1)
    rows = [(i, int(t)) for i, t in enumerate(rng.integers(1, 90, 300))] + [(1000, 250), (1001, 100), (1002, 0), (1003, 30), (1003, 30)]
    out = packed(spark, rows, shard=shard)
    assert out.tokens.sum() == sum(t for _, t in rows)
    seq = out[out.sequence.notna()].groupby("sequence").tokens.sum()
    assert seq.max() <= 100 and len(seq) <= slack * math.ceil(sum(t for _, t in rows) / 100) + 1
    pieces = out[out.doc == 1000].sort_values("piece")
    assert pieces.tokens.tolist() == [100, 100, 50] and (out[out.doc < 1000].piece == 1).all()
    assert out[out.doc == 1002].sequence.isna().all() and (out.doc == 1003).sum() == 2
    assert not out[out.sequence.notna()].duplicated(["sequence", "pos"]).any()


def test_no_items(spark):
    assert len(packed(spark, [])) == 0


def test_tokens(spark):
    text = "The cat's naïve plan — 2024!\n"
    df = spark.createDataFrame([(1, text, "s"), (2, None, "s"), (3, "", None), (4, text * 2000, "s")], "id bigint, text string, source string")
    sizes = {r["id"]: r["tokens"] for r in token_counts(df, "id", "text", "source").collect()}
    encoding = load_tokenizer()
    assert encoding.decode(encoding.encode_ordinary(text)) == text
    assert sizes == {1: len(encoding.encode_ordinary(text)), 2: 0, 3: 0, 4: len(encoding.encode_ordinary(text * 2000))}


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=60), st.floats(0.05, 0.95), st.integers(0, 99))
def test_flight(sizes, chance, seed):
    tokens, p = np.array(sizes), np.full(len(sizes), chance)
    moved = flight(tokens, p, np.random.default_rng(seed))
    assert ((moved > 0) & (moved < 1)).sum() <= 2
    assert moved.sum() == pytest.approx(p.sum(), abs=1e-6) and (moved * tokens).sum() == pytest.approx((p * tokens).sum(), abs=1e-5)


def test_flight_keeps_chances():
    tokens, p = np.array([10, 20, 35, 40, 55]), np.array([0.2, 0.4, 0.5, 0.6, 0.3])
    runs = np.mean([flight(tokens, p, np.random.default_rng(s)) for s in range(4000)], axis=0)
    assert np.abs(runs - p).max() < 0.04


def test_landing():
    """Many undecided documents, one of them long: the tokens come out nearly as wanted, and every chance is kept."""
    rng = np.random.default_rng(2)
    tokens = np.append(rng.integers(5, 400, 120), 6_000)
    chance = np.append(rng.uniform(0.1, 0.9, 120), 0.5)
    runs = np.array([landing(tokens, chance, np.random.default_rng(s)) for s in range(1500)])
    assert set(np.unique(runs)) == {0.0, 1.0}
    assert np.abs(runs @ tokens - chance @ tokens).max() < 400 and np.abs(runs @ tokens - chance @ tokens).mean() < 60
    assert np.abs(runs.mean(0) - chance).max() < 0.06
    assert landing(tokens, np.round(chance), rng).tolist() == np.round(chance).tolist()
    few = reserve(tokens, chance, 8)
    assert len(few) == 8 and 120 in few and len(reserve(tokens, chance, 8, room=True)) > 30


def test_same_however_partitioned(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), "a" if i % 3 else "b", int(t)) for i, t in zip(rng.integers(0, 500, 900), rng.integers(5, 60, 900))] + [(7, "a", 30)] * 40
    df = spark.createDataFrame(rows, "doc bigint, source string, tokens bigint")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 2)], "source string, target_share double, max_repeats int")
    got = []
    for n in (3, 30):
        mixture = mix_sources(spark, df.repartition(n), targets, shard=128)[0]
        got.append((sorted(map(tuple, mixture.collect())), sorted(map(tuple, pack_items(spark, df.repartition(n), 100, shard=128).collect()))))
    assert got[0] == got[1] and len(got[0][1]) == len(rows)


def test_equal_expected_copies(spark):
    """Over many seeds the documents of a source, long or short, are taken equally often."""
    tokens = np.array([5, 9, 14, 30, 31, 33, 60, 90, 200, 400, 15, 25])
    taken = np.zeros(len(tokens))
    for seed in range(3000):
        r = np.random.default_rng(seed)
        p = np.full(len(tokens), 0.4)
        taken += landing(tokens, flight(tokens, p, r, reserve(tokens, p, 4)), r)
    assert np.abs(taken / 3000 - 0.4).max() < 0.04


def test_no_exchange_is_left():
    """Against trying every move, one-for-one and two-for-one exchange of two underfull bins."""
    for seed in range(12):
        rng = np.random.default_rng(seed)
        sizes = rng.integers(5, 70, 40)
        where = pack_shard(sizes, 100)
        fill = np.bincount(where, sizes)
        members = [np.flatnonzero(where == b) for b in range(len(fill))]
        for b, o in ((b, o) for b in range(len(fill)) for o in range(len(fill)) if fill[o] < fill[b] < 100):
            come = [(s,) for s in sizes[members[o]]] + [(x, y) for i, x in enumerate(sizes[members[o]]) for y in sizes[members[o]][i + 1 :]]
            gone = [0, *sizes[members[b]]]
            gains = [sum(c) - g for c in come for g in gone if len(c) == 1 or g]
            assert not any(0 < x <= 100 - fill[b] for x in gains)


def test_mixture(spark):
    rng = np.random.default_rng(0)
    docs = [(i, "big", int(t)) for i, t in enumerate(rng.integers(20, 400, 900))] + [(10_000 + i, "small", int(t)) for i, t in enumerate(rng.integers(20, 400, 60))]
    docs += [(20_000, "small", 0), (20_001, None, 50), (20_002, "other", 50)]
    d = spark.createDataFrame(docs, "doc bigint, source string, tokens bigint")
    t = spark.createDataFrame([("big", 0.7, 1), ("small", 0.2, 3), ("none", 0.1, 2)], "source string, target_share double, max_repeats int")
    for shard in (8192, 64):
        mixture, plan = mix_sources(spark, d, t, shard=shard)
        rows = {r["source"]: r for r in shares_reached(spark, mixture, plan).collect()}
        assert rows["none"]["share"] == 0 and rows["none"]["docs"] == 0
        assert rows["big"]["share"] == pytest.approx(7 / 9, abs=1e-4) and rows["small"]["share"] == pytest.approx(2 / 9, abs=1e-4)
        found = mixture.toPandas()
        assert found[found.source == "small"].copies.max() <= 3 and found[found.source == "big"].copies.max() == 1
        assert set(found.source) == {"big", "small"} and not found.doc.duplicated().any()
    asked = {r["source"]: r for r in mixture_plan(d, t, total=1000)}
    assert asked["big"]["wanted"] == pytest.approx(7000 / 9) and asked["none"]["wanted"] == 0
    most = {r["source"]: r for r in mixture_plan(d, t, total=10**9)}
    assert most["small"]["repeats"] == pytest.approx(3) and most["big"]["repeats"] == pytest.approx(1)


def test_mixture_of_nothing(spark):
    d = spark.createDataFrame([], "doc bigint, source string, tokens bigint")
    t = spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats int")
    mixture, plan = mix_sources(spark, d, t)
    assert mixture.count() == 0 and [r["share"] for r in shares_reached(spark, mixture, plan).collect()] in ([None], [0.0])
