"""Exact ranks by a hash of the id, computed in parallel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def hash_rank(
    df: DataFrame, identifier: str, strata: Sequence[str] = (), prefix: int = 4
) -> DataFrame:
    """Add ``hash_rank`` (1-based, in md5 order of the id) and ``stratum_size`` per stratum.

    A stratum can be most of the table, so it is not sorted in one piece: rows are ranked
    inside buckets of equal md5 prefix, and each bucket's start comes from a cumulative count
    over the at most 16**prefix buckets of the stratum.
    """
    hashed = df.withColumn("_hash", F.md5(F.col(identifier).cast("string"))).withColumn(
        "_bucket", F.substring("_hash", 1, prefix)
    )
    groups = [F.col(s) for s in strata]
    counts = hashed.groupBy(*groups, "_bucket").agg(F.count("*").alias("_n"))
    within = Window.partitionBy(*groups, F.lit(0)) if not groups else Window.partitionBy(*groups)
    starts = counts.select(
        *[g.alias(f"_s{i}") for i, g in enumerate(groups)],
        F.col("_bucket").alias("_b"),
        F.coalesce(
            F.sum("_n").over(
                within.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("_start"),
        F.sum("_n").over(within).alias("stratum_size"),
    )
    match = F.col("_bucket") == F.col("_b")
    for i, g in enumerate(groups):
        match &= g.eqNullSafe(F.col(f"_s{i}"))
    in_bucket = Window.partitionBy(*groups, "_bucket").orderBy("_hash", identifier)
    return (
        hashed.withColumn("_row", F.row_number().over(in_bucket))
        .join(starts, match)
        .withColumn("hash_rank", F.col("_start") + F.col("_row"))
        .select(*df.columns, "hash_rank", "stratum_size")
    )


def hash_sample(df: DataFrame, identifier: str, n: int) -> DataFrame:
    """The ``n`` rows with the smallest md5 of their id: random in effect, same on every run."""
    return (
        df.withColumn("_hash", F.md5(F.col(identifier).cast("string")))
        .orderBy("_hash", identifier)
        .limit(n)
        .drop("_hash")
    )
