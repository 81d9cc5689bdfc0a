"""Connected components over links as rounds of joins and minimum aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.scale import materialize


def _toward_minimum(sides: DataFrame) -> DataFrame:
    """(u, v, m) with the smallest of u and all its v. Minima combine before the exchange, and a
    node that a third of all links share is a join key adaptive execution can split."""
    least = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return sides.join(materialize(least, "least"), "u")


def _stars(edges: DataFrame) -> bool:
    """Whether every node points at one node, which points at none."""
    several = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    chained = edges.join(edges.select(F.col("u").alias("v")).distinct(), "v", "left_semi")
    return several.isEmpty() and chained.isEmpty()


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for every node of ``links`` (a, b).

    Alternates the two star operations: every node points its larger neighbours, then its
    smaller ones, at the smallest; the links become stars in a logarithmic number of rounds.
    """
    edges = materialize(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges"
    )
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _toward_minimum(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.filter("u <> v").distinct(), "large")
        small = _toward_minimum(large)
        pointed = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = small.select("u", F.col("m").alias("v"))
        edges = materialize(pointed.unionByName(own).filter("u <> v").distinct(), "small")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
