"""Variant spellings of shop names, linked by a trie join.

Distinct texts are taken apart, their brands are sharded into tries inside blocks of the same platform and ordinal,
and a Levenshtein automaton walks each trie to enumerate the brands within a bounded distance; brands made of the same
characters are neighbours in any order of their parts. Surviving neighbours are checked (one edit, or characters left out, or the same characters in another order, and agreeing goods and kind).
Every spelling follows its best-attested neighbour up to a spelling that has none better attested; the spellings that
end there are one class.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reconspark.functions.text import is_blank
from reconspark.llm.names import KNOWN, Words, character_pairs, same_brand, shop_name
from reconspark.session import staged

#: Brands of one block in one trie, and queries that walk it in one task; larger blocks take more tasks, not larger ones.
SHARD_NAMES = 4000
DISTANCE = 2


def parsed_names(texts: DataFrame, column: str = "shop", words: Words = KNOWN) -> DataFrame:
    """The text and its parts: brand, nick, platform, kind, goods, ordinal (empty where missing). One row in, one out."""
    parts = ("brand", "nick", "platform", "kind", "goods", "ordinal")
    keep = [c for c in texts.columns if c not in parts]
    kinds = dict(texts.dtypes)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [shop_name(t.as_py(), words) for t in batch.column(keep.index(column))]
            made = [pa.array([getattr(n, p) for n in names], pa.string()) for p in parts]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*keep, *parts])

    return texts.select(*keep).mapInArrow(parse, ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", " + ", ".join(f"{p} string" for p in parts))


def trie_pairs(names: list[str], queries: list[str], distance: int = DISTANCE) -> Iterator[tuple[str, str]]:
    """(query, name) of all different pairs within the edit distance, by one walk of the names' trie for each query."""
    root: dict = {}
    for name in names:
        node = root
        for c in name:
            node = node.setdefault(c, {})
        node[""] = name
    for query in queries:
        todo = [(root, list(range(len(query) + 1)))]
        while todo:
            node, row = todo.pop()
            found = node.get("")
            if found is not None and found != query and row[-1] <= distance:
                yield query, found
            for c, child in node.items():
                if c == "":
                    continue
                state = [row[0] + 1]
                for j, q in enumerate(query, 1):
                    state.append(min(row[j] + 1, state[j - 1] + 1, row[j - 1] + (q != c)))
                if min(state) <= distance:
                    todo.append((child, state))


def _neighbours(cores: DataFrame) -> DataFrame:
    """(block, brand, other) of brands that are spellings of one another, from tries of bounded size.

    Two spellings of one brand share at least two characters, so a trie holds the brands of one block and one pair of
    characters and is asked by that pair's brands only; two brands are kept in the trie of their smallest shared pair. A pair
    of characters with more than SHARD_NAMES brands has several tries, and each is asked in parts of that size: the
    rows for that grow with the square of such a pair's brands, as the walks themselves do. After the tries, brands with
    the same characters are checked whatever their distance, since parts may stand in any order.
    """
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(block, brand, key) for block, brand in zip(*(c.to_pylist() for c in batch.columns), strict=True) for key in sorted(character_pairs(brand))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in (zip(*rows, strict=True) if rows else ((), (), ()))], names=["block", "brand", "letter"])

    own = staged(cores.select("block", "brand").mapInArrow(keyed, "block string, brand string, letter string"), "brand-pairs")
    sizes = own.groupBy("block", "letter").agg(F.ceil(F.count(F.lit(1)) / SHARD_NAMES).cast("int").alias("__s"), F.count(F.lit(1)).alias("__n")).where("__n > 1")
    own = own.join(sizes, ["block", "letter"]).withColumn("__h", F.pmod(F.xxhash64("brand"), F.col("__s")).cast("int"))
    every = F.sequence(F.lit(0), F.col("__s") - 1)
    key = ["block", "letter", "trie", "part"]
    built = own.select("block", "letter", "brand", F.lit(0).alias("side"), F.col("__h").alias("trie"), F.explode(every).alias("part"))
    asked = own.select("block", "letter", "brand", F.lit(1).alias("side"), F.explode(every).alias("trie"), F.col("__h").alias("part"))

    def join(group: pd.DataFrame) -> pd.DataFrame:
        names, queries = (group.loc[group["side"] == s, "brand"].tolist() for s in (0, 1))
        letter = group["letter"].iloc[0]
        pairs = [(q, n) for q, n in trie_pairs(names, queries) if same_brand(q, n) and letter == min(character_pairs(q) & character_pairs(n))]
        return pd.DataFrame({"block": group["block"].iloc[0], "brand": [q for q, _ in pairs], "other": [n for _, n in pairs]}, dtype=object)

    # The rows are small but each costs a walk: the number of tasks follows the cores, not the bytes.
    tasks = 3 * cores.sparkSession.sparkContext.defaultParallelism
    near = built.unionByName(asked).repartition(tasks, *key).groupBy(*key).applyInPandas(join, "block string, brand string, other string")
    made_of = F.array_join(F.array_sort(F.split("brand", "")), "")
    mine = cores.where(F.length("brand") > 2).select("block", "brand", made_of.alias("letters"))
    swapped = mine.join(mine.withColumnRenamed("brand", "other"), ["block", "letters"]).where("brand <> other").select("block", "brand", "other")
    return near.unionByName(swapped).distinct()


def spelling_classes(texts: DataFrame, nicknames: DataFrame | None = None, words: Words = KNOWN) -> DataFrame:
    """shop, class_id (its best-attested brand with platform and ordinal) and links (other texts of the class).

    `texts` has shop and n (how often it occurs, above 0), one row a text; blank texts and placeholders name no store and
    have no row. `nicknames` (nick, brand) resolves nicknames, `words` are the platforms that names may hold. Ties of attestation fall to the longer, then the
    greater text, so the result does not depend on order. No two texts of different platform or ordinal are linked.
    """
    names = parsed_names(texts.where(~is_blank("shop")).select("shop", F.col("n").cast("long").alias("n")), words=words)
    if nicknames is not None:
        known = nicknames.groupBy("nick", "brand").agg(F.count(F.lit(1)).alias("__n")).groupBy("nick").agg(F.max(F.struct("__n", "brand"))["brand"].alias("__brand"))
        names = names.join(known, "nick", "left").withColumn("brand", F.when(F.col("brand") == "", F.coalesce("__brand", "nick")).otherwise(F.col("brand"))).drop("__brand")
    names = names.withColumn("brand", F.when(F.col("brand") == "", F.coalesce(F.nullif("nick", F.lit("")), F.col("shop"))).otherwise(F.col("brand")))
    names = staged(names.select("shop", "n", "brand", "kind", "goods", F.concat_ws("|", "platform", "ordinal").alias("block")), "shop-names")

    most = lambda c: F.max(F.when(F.col(c) != "", F.struct(F.col("n"), F.col(c).alias("v"))))["v"].alias(c)
    cores = staged(names.groupBy("block", "brand").agg(F.sum("n").alias("weight"), most("kind"), most("goods")), "shop-brands")
    near = _neighbours(cores)
    rank = F.struct("weight", F.length("brand").alias("l"), F.col("brand").alias("b"))
    mine = cores.select("block", "brand", rank.alias("__rank"), F.col("kind").alias("__kind"), F.col("goods").alias("__goods"))
    other = cores.select("block", F.col("brand").alias("other"), rank.alias("__above"), "kind", "goods")
    agree = F.coalesce(F.col("kind") == F.col("__kind"), F.lit(True)) & F.coalesce(F.col("goods") == F.col("__goods"), F.lit(True))
    up = near.join(mine, ["block", "brand"]).join(other, ["block", "other"]).where(agree & (F.col("__above") > F.col("__rank")))
    up = up.groupBy("block", "brand").agg(F.max("__above")["b"].alias("root"))
    roots = staged(cores.select("block", "brand").join(up, ["block", "brand"], "left").select("block", "brand", F.coalesce("root", "brand").alias("root")), "shop-roots")
    while True:  # each round doubles the steps taken, so a chain of n spellings needs log2(n) rounds
        above = roots.select("block", F.col("brand").alias("root"), F.col("root").alias("__next"))
        further = staged(roots.join(above, ["block", "root"]).select("block", "brand", "root", F.col("__next")), "shop-roots")
        if further.where("root <> __next").limit(1).count() == 0:
            break
        roots = further.select("block", "brand", F.col("__next").alias("root"))
    classes = names.join(roots, ["block", "brand"]).select("shop", F.concat_ws("|", "root", "block").alias("class_id"))
    sizes = classes.groupBy("class_id").agg((F.count(F.lit(1)) - 1).alias("links"))
    return classes.join(sizes, "class_id").select("shop", "class_id", "links")


def spelling_pairs(classes: DataFrame) -> DataFrame:
    """shop_a, shop_b (the smaller by code point first) of every two texts of one class."""
    a, b = classes.select("class_id", F.col("shop").alias("shop_a")), classes.select("class_id", F.col("shop").alias("shop_b"))
    return a.join(b, "class_id").where("shop_a < shop_b").select("shop_a", "shop_b")
