"""Mixing sources to target weights, measured in tokens.

Every record is laid on its source's line in a pseudo-random order and the line is cut into blocks of equal length.
A splitting tree hands each source's exact number of blocks down to output shards, at each node by a draw without
replacement over all blocks (multivariate hypergeometric), so that every shard has its size and every source its
quota exactly. A shard takes disjoint runs of its sources' permuted blocks and shuffles them locally.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reconspark.session import staged

BLOCK_TOKENS = 4096
SHARD_TOKENS = 2_000_000
BUCKET_TOKENS = 2_000_000
#: Nodes of the splitting tree on the driver; buckets that one prefix sum runs over; items that numpy's sampler takes.
TOP_NODES, BUCKETS_AT_ONCE, NUMPY_MOST = 1024, 1024, 10**9


def quotas(available: dict[str, int], targets: dict[str, tuple[float, int]], total: int | None = None) -> dict[str, int]:
    """Tokens that each source gives: its share of the total, at most max_repeats times what it has.

    Sources without tokens, share or repeats give nothing and the other shares are scaled up. Without `total` the
    largest total is taken at which every source still reaches its share.
    """
    usable = {s: (share, int(most)) for s, (share, most) in targets.items() if available.get(s, 0) > 0 and (share or 0) > 0 and (most or 0) > 0}
    whole = math.fsum(share for share, _ in usable.values())
    if not usable:
        return {}
    reach = min(available[s] * most / (share / whole) for s, (share, most) in usable.items())
    size = reach if total is None else total
    return {s: min(int(size * share / whole), available[s] * most) for s, (share, most) in sorted(usable.items())}


#: A node of the splitting tree: first shard, end shard, first block and number of blocks of each source.
Node = tuple[int, int, np.ndarray, np.ndarray]


def split(node: Node, seed: int, widest: int = 1) -> Iterator[Node]:
    """The nodes of at most `widest` shards below a node, from left to right.

    A node's draw is seeded by its shards alone, so that a subtree comes out the same wherever it is drawn. It takes the
    left half's blocks from all sources without replacement (multivariate hypergeometric: one draw a source, given the
    ones before); the right half has the rest.
    """
    todo = [node]
    while todo:
        lo, hi, first, counts = todo.pop()
        if hi - lo <= widest:
            yield lo, hi, first, counts
            continue
        rng, mid = np.random.default_rng([seed, lo, hi]), (lo + hi) // 2
        rest = int(counts.sum())
        need, take = rest * (mid - lo) // (hi - lo), np.zeros_like(counts)
        for i, n in enumerate(counts):
            rest -= int(n)
            take[i] = hypergeometric(rng, int(n), rest, need)
            need -= int(take[i])
        todo += [(mid, hi, first + take, counts - take), (lo, mid, first, take)]


def shard_runs(spark: SparkSession, blocks: dict[str, int], shards: int, seed: int) -> DataFrame:
    """source, shard, lo, hi: each shard's run of permuted blocks; the runs of a source are disjoint and complete.

    The driver draws the top of the tree, at most TOP_NODES nodes whatever the corpus holds; the subtrees below are drawn
    by the executors, each by itself.
    """
    names = sorted(blocks)
    counts = np.array([blocks[s] for s in names], dtype=np.int64)
    top = split((0, shards, np.zeros_like(counts), counts), seed, -(-shards // TOP_NODES)) if names else ()
    rows = [(lo, hi, first.tolist(), n.tolist()) for lo, hi, first, n in top]

    def below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                for at, _, first, n in split((r["lo"], r["hi"], np.array(r["first"], np.int64), np.array(r["n"], np.int64)), seed):
                    used = np.flatnonzero(n)
                    if len(used):
                        columns = [pa.array([names[i] for i in used], pa.string()), pa.array([at] * len(used), pa.int64()), pa.array(first[used]), pa.array((first + n)[used])]
                        yield pa.RecordBatch.from_arrays(columns, names=["source", "shard", "lo", "hi"])

    nodes = spark.createDataFrame(rows, "lo long, hi long, first array<bigint>, n array<bigint>").repartition(max(1, min(len(rows), spark.sparkContext.defaultParallelism)))
    return nodes.mapInArrow(below, "source string, shard long, lo long, hi long")


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """How many of `drawn` items taken without replacement from good + bad are good.

    Where the whole is too large for numpy's sampler, the distribution is inverted: the probabilities follow from one
    another by their exact ratios from the most likely number outwards, as far as they count in a double (12 standard
    deviations leave less than 1e-31).
    """
    if good == 0 or drawn == 0:
        return 0
    if good + bad < NUMPY_MOST:
        return int(rng.hypergeometric(good, bad, drawn))
    whole = good + bad
    mode = (drawn + 1) * (good + 1) // (whole + 2)
    spread = math.sqrt(drawn * (good / whole) * (bad / whole) * max(whole - drawn, 1) / (whole - 1))
    reach = int(12 * spread) + 64
    lo, hi = max(0, drawn - bad, mode - reach), min(good, drawn, mode + reach)
    k = np.arange(lo, hi, dtype=np.float64)
    steps = np.log((good - k) * (drawn - k)) - np.log((k + 1) * (bad - drawn + k + 1))
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    chance = np.cumsum(np.exp(logs - logs.max()))
    return lo + int(np.searchsorted(chance, rng.random() * chance[-1], "right"))


def _coprime(n: int, seed: int) -> tuple[int, int]:
    """Step and offset of the block permutation b -> (b * step + offset) mod n; n * step stays within a bigint."""
    rng = np.random.default_rng(seed)
    step = int(min(n, (1 << 62) // max(n, 1)) * 0.6180339887) + int(rng.integers(0, 97)) | 1
    while math.gcd(step, n) != 1:
        step += 1
    return step % max(n, 1) or 1, int(rng.integers(0, max(n, 1)))


def mixture(sizes: DataFrame, targets: DataFrame, total: int | None = None, seed: int = 17) -> DataFrame:
    """doc_id, copy (from 0), source, tokens, shard, position of every record of the mixture.

    `sizes` has doc_id, source and tokens and is read several times, so it should be a staged table; `targets` has
    source, target_share and max_repeats, one small row a source (the first by order counts if a source repeats).
    Every record of a source goes in as often as its quota has whole passes, a random part once more. Records
    without tokens or source, and sources without target, are not mixed. No targets or no records give no rows.
    Positions on a source's line are prefix sums in three levels, so a source that holds most rows is spread over
    buckets of about BUCKET_TOKENS; shards have about SHARD_TOKENS. Both grow in number, not in size.
    """
    spark = sizes.sparkSession
    live = sizes.where("tokens > 0 and source is not null").select("doc_id", "source", F.col("tokens").cast("long").alias("tokens"))
    have = {r.source: r.n for r in live.groupBy("source").agg(F.sum("tokens").alias("n")).join(targets.select("source").distinct(), "source", "left_semi").collect()}
    wanted = {r.source: (r.target_share, r.max_repeats) for r in targets.orderBy(F.desc("source"), "target_share", "max_repeats").collect()}
    quota = {s: q for s, q in quotas(have, wanted, total).items() if q > 0}
    blocks = {s: -(-q // BLOCK_TOKENS) for s, q in quota.items()}
    shards = max(1, round(sum(quota.values()) / SHARD_TOKENS))
    plan = []
    for i, s in enumerate(sorted(quota)):
        step, offset = _coprime(blocks[s], seed + i)
        plan.append((s, have[s], quota[s], blocks[s], step, offset, max(1, have[s] // BUCKET_TOKENS)))
    plan_df = spark.createDataFrame(plan, "source string, have long, quota long, blocks long, step long, start long, buckets long")
    runs = shard_runs(spark, blocks, shards, seed)

    keyed = live.join(plan_df, "source").withColumn("__h", F.xxhash64(F.lit(seed), "doc_id"))
    keyed = keyed.withColumn("__bucket", F.pmod(F.shiftright("__h", 20), F.col("buckets")))
    heads = keyed.groupBy("source", "__bucket").agg(F.sum("tokens").alias("__sum"))
    heads = staged(heads.withColumn("__run", F.floor(F.col("__bucket") / BUCKETS_AT_ONCE)), "mixing-buckets")
    before = lambda *keys, order: F.sum("__sum").over(W.partitionBy(*keys).orderBy(order)) - F.col("__sum")
    starts = heads.groupBy("source", "__run").agg(F.sum("__sum").alias("__sum")).select("source", "__run", before("source", order="__run").alias("__start"))
    heads = heads.select("source", "__run", "__bucket", before("source", "__run", order="__bucket").alias("__inside")).join(starts, ["source", "__run"])
    heads = heads.select("source", "__bucket", (F.col("__start") + F.col("__inside")).alias("__before"))
    inside = W.partitionBy("source", "__bucket").orderBy("__h", "doc_id", "tokens").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = keyed.withColumn("__end", F.sum("tokens").over(inside)).join(heads, ["source", "__bucket"])
    placed = placed.withColumn("__at", F.col("__before") + F.col("__end") - F.col("tokens"))
    passes = F.floor(F.col("quota") / F.col("have")).cast("int")
    extra = ((F.col("__at") + F.col("tokens") / 2) < F.col("quota") % F.col("have")).cast("int")
    copies = placed.withColumn("__copies", passes + extra).where("__copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("__copies") - 1)))
    block = F.least(F.floor((F.col("copy") * F.col("have") + F.col("__at")) / BLOCK_TOKENS).cast("long"), F.col("blocks") - 1)
    copies = copies.withColumn("__block", F.pmod(block * F.col("step") + F.col("start"), F.col("blocks")))
    spread = runs.select("source", "shard", F.explode(F.sequence("lo", F.col("hi") - 1)).alias("__block"))
    mixed = copies.join(spread, ["source", "__block"])
    local = W.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed + 1), "doc_id", "copy"), "doc_id", "copy")
    return mixed.select("doc_id", "copy", "source", F.col("tokens").cast("int").alias("tokens"), F.col("shard").cast("int").alias("shard"), (F.row_number().over(local) - 1).alias("position"))


def shares(sizes: DataFrame, targets: DataFrame, mixed: DataFrame) -> DataFrame:
    """For each target source: target_share, reached_share, docs and tokens it has, tokens mixed, most repeats used."""
    have = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("tokens").alias("tokens"))
    got = mixed.groupBy("source").agg(F.sum("tokens").alias("mixed_tokens"), (F.max("copy") + 1).alias("most_repeats"))
    whole = mixed.agg(F.sum("tokens").alias("__all"))
    out = targets.select("source", "target_share", "max_repeats").join(have, "source", "left").join(got, "source", "left").crossJoin(F.broadcast(whole))
    zero = {"docs": 0, "tokens": 0, "mixed_tokens": 0, "most_repeats": 0}
    out = out.fillna(zero).withColumn("reached_share", F.coalesce(F.try_divide(F.col("mixed_tokens"), F.col("__all")), F.lit(0.0)))
    return out.select("source", "target_share", "reached_share", "docs", "tokens", "mixed_tokens", "max_repeats", "most_repeats")
