"""Connected components of a table of links, in rounds of joins and sums until nothing changes."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termpulse.llm import common

#: Links that a task joins up at once before the rounds; more only come in several pieces.
CONTRACTED_LINKS = 200_000


def stars(pairs: Iterator[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same components as links from each node to the smallest of its component."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [(x, root(x)) for x in list(parent) if root(x) != x]


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (a, b: long) that is not the smallest of its component.

    Each round links the larger neighbours of every node to its smallest neighbour, then the smaller ones. A node with
    very many links is a key of many rows; its smallest neighbour is summed before the shuffle and written, so that the
    join can be split.
    """
    spark = links.sparkSession

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int]] = []

        def out() -> pa.RecordBatch:
            found = stars(held)
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], ["a", "b"])

        for batch in batches:
            held += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            if len(held) >= CONTRACTED_LINKS:
                yield out()
                held = []
        yield out()

    # a larger, b smaller
    edges = common.stage(links.select("a", "b").filter("a <> b").mapInArrow(contract, "a long, b long").distinct(), "links")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = common.stage(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), "least")
        up = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        up = common.stage(up.distinct(), "up-links")
        low = common.stage(up.groupBy("a").agg(F.min("b").alias("m")), "low")
        down = up.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        following = common.stage(down.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "links")
        now = following.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        common.remove(spark, edges, least, up, low)
        edges = following
        if now == mark or not now[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = now
