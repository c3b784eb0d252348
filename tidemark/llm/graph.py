"""Connected components of links between 64-bit nodes, by alternating large and small stars.

Joins are merges, by hint: the compressed files of a round say too little about its rows to broadcast them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.batches import kept


def oriented(links: DataFrame) -> DataFrame:
    """Distinct links (a, b) with a > b; loops and links with a null end go."""
    a, b = links.columns[:2]
    return links.select(
        F.greatest(a, b).cast("bigint").alias("a"), F.least(a, b).cast("bigint").alias("b"),
        F.col(a).isNotNull().alias("x"), F.col(b).isNotNull().alias("y"),
    ).filter("x AND y AND a > b").select("a", "b").distinct()


def large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to the smallest node it knows."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m"))
    return edges.join(least.hint("merge"), edges.b == least.u).select("a", F.col("m").alias("b"))


def small_star(edges: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours and itself to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    others = edges.join(least.hint("merge"), "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.union(least.select("a", F.col("m").alias("b"))).distinct()


def signature(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))
    ).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node with a link; the root is the smallest node it reaches.

    Rounds run until nothing changes. Each is written to the shared folder, so a lost executor costs
    one round; a node with very many links is only ever aggregated or split by the join.
    """
    edges = kept(oriented(links), "links")
    before = signature(edges)
    while before[0]:
        edges = kept(small_star(large_star(edges)), "links")
        after = signature(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
