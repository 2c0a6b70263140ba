"""Mixtures: exact quotas of the splitting tree, repeats within their caps, shares near their targets."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from reconspark.llm import mixing
from reconspark.llm.mixing import _coprime, hypergeometric, mixture, quotas, shard_runs, shares, split

TARGETS = [("big", 0.5, 1), ("small", 0.3, 3), ("mid", 0.2, 2), ("none", 0.1, 4), (None, 0.1, 1), ("zero", 0.0, 1)]


@pytest.mark.parametrize("shards,top", [(1, 1024), (2, 1), (7, 3), (64, 5), (200, 1)])
def test_tree_hands_out_every_block_once(spark, monkeypatch, shards, top):
    blocks = {"a": 1000, "b": 3, "c": 77}
    monkeypatch.setattr(mixing, "TOP_NODES", top)
    runs = [tuple(r) for r in shard_runs(spark, blocks, shards, 5).orderBy("shard", "source").collect()]
    for s, n in blocks.items():
        own = sorted((lo, hi) for name, _, lo, hi in runs if name == s)
        assert own[0][0] == 0 and own[-1][1] == n and all(a[1] == b[0] for a, b in zip(own, own[1:]))
    sizes = Counter()
    for _, h, lo, hi in runs:
        sizes[h] += hi - lo
    assert max(sizes.values()) - min(sizes.values()) <= 8
    # The same shards whether the driver or the executors draw them.
    whole = split((0, shards, np.zeros(3, np.int64), np.array([1000, 3, 77])), 5)
    assert runs == [(name, lo, int(f), int(f + n)) for lo, _, first, given in whole for name, f, n in zip("abc", first, given) if n]


@pytest.mark.parametrize("good,bad,drawn", [(40, 60, 30), (5, 900, 450), (900, 5, 450), (1, 1, 1), (7, 0, 3), (3, 50, 53), (2000, 3000, 1200)])
def test_draws_of_large_wholes(monkeypatch, good, bad, drawn):
    exact = {k: math.comb(good, k) * math.comb(bad, drawn - k) / math.comb(good + bad, drawn) for k in range(max(0, drawn - bad), min(good, drawn) + 1)}
    monkeypatch.setattr(mixing, "NUMPY_MOST", 0)
    rng, n = np.random.default_rng(4), 4000
    seen = Counter(hypergeometric(rng, good, bad, drawn) for _ in range(n))
    assert set(seen) <= set(exact)
    for k, p in exact.items():
        assert abs(seen[k] - n * p) <= 5 * math.sqrt(n * p * (1 - p)) + 1


def test_draws_of_huge_wholes():
    rng, good, bad, drawn = np.random.default_rng(4), 3 * 10**11, 7 * 10**11, 5 * 10**11
    got = np.array([hypergeometric(rng, good, bad, drawn) for _ in range(12)], float)
    spread = math.sqrt(drawn * 0.3 * 0.7 * 0.5)
    assert abs(got.mean() - drawn * 0.3) < 2 * spread and 0.3 * spread < got.std() < 2 * spread


def test_quotas():
    got = quotas({"big": 1000, "small": 10, "mid": 400}, {s: (t, m) for s, t, m in TARGETS})
    assert got["small"] == 30 and abs(got["big"] - 50) <= 1 and abs(got["mid"] - 20) <= 1 and set(got) == {"big", "small", "mid"}
    assert quotas({}, {}) == {} and quotas({"a": 5}, {"a": (1.0, 0)}) == {}
    for n in (1, 2, 12, 999):
        step, start = _coprime(n, 3)
        assert len({(b * step + start) % n for b in range(n)}) == n
    assert math.gcd(_coprime(9 * 10**9, 3)[0], 9 * 10**9) == 1 and _coprime(9 * 10**9, 3)[0] * 9 * 10**9 < 2**63


def test_mixture(spark, monkeypatch):
    for name, value in (("BLOCK_TOKENS", 64), ("SHARD_TOKENS", 2000), ("BUCKET_TOKENS", 300), ("BUCKETS_AT_ONCE", 4)):
        monkeypatch.setattr(mixing, name, value)
    rows = [(i, "big", 20 + i % 30) for i in range(600)] + [(1000 + i, "small", 40) for i in range(30)] + [(2000 + i, "mid", 10 + i % 5) for i in range(200)] + [(9000, None, 9), (9001, "big", 0), (9002, "other", 5), (9003, "mid", None)]
    sizes = spark.createDataFrame(rows, "doc_id long, source string, tokens int")
    targets = spark.createDataFrame(TARGETS, "source string, target_share double, max_repeats int")
    mixed = mixture(sizes, targets)
    got = mixed.collect()
    assert len({(r.doc_id, r.copy) for r in got}) == len(got)
    most = Counter(r.doc_id for r in got)
    caps = {s: m for s, _, m in TARGETS}
    assert all(most[r.doc_id] <= caps[r.source] for r in got)
    total = sum(r.tokens for r in got)
    for s, want in (("big", 0.5), ("small", 0.3), ("mid", 0.2)):
        assert abs(sum(r.tokens for r in got if r.source == s) / total - want) < 0.02
    assert {r.source for r in got} == {"big", "small", "mid"}
    by_shard = defaultdict(list)
    for r in got:
        by_shard[r.shard].append(r)
    assert len(by_shard) > 1
    for part in by_shard.values():
        assert sorted(r.position for r in part) == list(range(len(part)))
    report = {r.source: r for r in shares(sizes, targets, mixed).collect()}
    assert abs(sum(r.reached_share for r in report.values()) - 1) < 1e-9 and report["none"].reached_share == 0 and report["small"].most_repeats == 3
    assert [tuple(r) for r in mixture(sizes, targets).orderBy("shard", "position").collect()] == [tuple(r) for r in mixed.orderBy("shard", "position").collect()]
    assert mixture(sizes.limit(0), targets).count() == 0 and mixture(sizes, targets.limit(0)).count() == 0
    bigger = mixture(sizes, targets, total=10**9).groupBy("source").count().collect()
    assert {r.source: r["count"] for r in bigger} == {"big": 600, "small": 90, "mid": 400}
