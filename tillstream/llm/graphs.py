"""Connected components of an edge table, and work on all pairs of a group in bounded blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the component's smallest node.

    Alternating large-star and small-star steps, each an aggregate and a join, so a node with many
    neighbours is split like any skewed join key. Every round is written to the shared folder.
    """
    edges = _oriented(edges.select("a", "b"))
    state = None
    while True:
        edges = stored(_small_star(_large_star(edges)), "edges")
        count, total = edges.agg(F.count("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if (count, total) == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select(F.col("b"), F.col("b")).distinct())
        state = (count, total)


def _oriented(edges: DataFrame) -> DataFrame:
    return (edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node link to the smallest of the node and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return _oriented(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and the node, link to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _oriented(moved.union(least.select("a", F.col("m").alias("b"))))


def in_blocks(rows: DataFrame, group: str, member: str, weight: str, most: int,
              work: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """Run `work` on blocks that together hold every pair of members of each group once.

    A group whose weights sum to more than `most` is cut into chunks by the member's hash, and a
    block is two chunks (or one with itself), so a task holds about two chunks, whatever the group.
    `work` gets the rows of a block with `low` and `high`, the numbers of its chunks, and `chunk`:
    it must look at pairs across the chunks, or within the one.
    """
    sizes = rows.groupBy(group).agg(F.ceil(F.sum(weight) / F.lit(most)).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64(member), F.col("chunks")).cast("int")
    placed = (rows.join(sizes, group).withColumn("chunk", chunk)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
              .withColumn("low", F.least("chunk", "other")).withColumn("high", F.greatest("chunk", "other"))
              .drop("other", "chunks"))

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        current = None
        for batch in batches:
            keys = list(zip(batch[group], batch["low"], batch["high"]))
            start = 0
            for i in range(1, len(keys) + 1):
                if i == len(keys) or keys[i] != keys[start]:
                    if keys[start] != current:
                        if held:
                            yield work(pd.concat(held, ignore_index=True) if len(held) > 1 else held[0].reset_index(drop=True))
                        held, current = [], keys[start]
                    held.append(batch.iloc[start:i])
                    start = i
        if held:
            yield work(pd.concat(held, ignore_index=True) if len(held) > 1 else held[0].reset_index(drop=True))

    return (placed.repartition(group, "low", "high").sortWithinPartitions(group, "low", "high")
            .mapInPandas(split, schema))
