"""Edit-distance join of any distance through segments.

A text of length l is cut into distance + 1 segments of even length. Two texts within the distance must
share one segment of the shorter one unchanged, at nearly the same place: d edits cannot touch d + 1
segments. So the shorter text is known by its segments, and the longer one looks for them with its
substrings in a small window of places for each length it can meet. Candidates are then measured.

A text has at most (distance + 1)^2 segments to look for at at most distance + 1 places each, whatever
its length. Texts too short to be cut are known by their characters instead: beyond the distance they
must share one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _segments(length: Column, distance: int) -> Column:
    """(i, at, size) of the segments of a text of this length; the last ones take the remainder."""
    parts = distance + 1
    size, rest = F.floor(length / parts).cast("int"), (length % parts).cast("int")
    short = F.lit(parts) - rest  # so many segments have the smaller size

    def segment(i: Column) -> Column:
        longer = F.greatest(i - short, F.lit(0))
        return F.struct(
            i.alias("i"), (i * size + longer + 1).cast("int").alias("at"),
            (size + F.when(i >= short, 1).otherwise(0)).cast("int").alias("size"),
        )

    return F.transform(F.sequence(F.lit(0), F.lit(distance)), segment)


def similar_pairs(df: DataFrame, text: str, distance: int, block: Column | None = None) -> DataFrame:
    """(block, left, right, distance) of all pairs of distinct texts within the distance, left < right.

    Nulls are left out; equal texts are one.
    """
    texts = (
        df.filter(F.col(text).isNotNull())
        .select((F.lit("") if block is None else block).alias("block"), F.col(text).alias("text"))
        .distinct()
        .withColumn("n", F.length("text"))
    )
    long_enough = texts.filter(F.col("n") > distance)
    known = long_enough.select("block", "text", "n", F.inline(_segments(F.col("n"), distance))).select(
        "block", F.col("text").alias("a"), F.col("n").alias("length"), "i",
        F.substr("text", F.col("at"), F.col("size")).alias("part"),
    )
    # The longer text meets lengths from its own down to distance less.
    lengths = F.sequence(F.greatest(F.lit(distance + 1), F.col("n") - distance), F.col("n"))
    wanted = long_enough.select("block", "text", "n", F.explode(lengths).alias("length"))
    wanted = wanted.select("block", "text", "n", "length", F.inline(_segments(F.col("length"), distance)))
    gap = F.col("n") - F.col("length")
    # A segment after i others, before distance - i: edits on either side bound how far it can move.
    low = F.greatest(F.lit(1), F.col("at") - F.col("i"), F.col("at") + gap - (F.lit(distance) - F.col("i")))
    high = F.least(
        F.col("n") - F.col("size") + 1, F.col("at") + F.col("i"), F.col("at") + gap + (F.lit(distance) - F.col("i"))
    )
    looked = wanted.filter(low <= high).select(
        "block", "text", "length", "i", "size", F.explode(F.sequence(low, high)).alias("p")
    )
    probes = looked.select(
        "block", F.col("text").alias("b"), "length", "i", F.substr("text", F.col("p"), F.col("size")).alias("part")
    ).distinct()
    met = probes.join(known, ["block", "length", "i", "part"]).select("block", "a", "b")

    characters = F.explode(F.array_distinct(F.concat(F.split("text", ""), F.array(F.lit(""))))).alias("c")
    # Short texts within the distance of the empty one all meet; others only over a shared character.
    small = texts.filter(F.col("n") <= 2 * distance).select("block", "text", "n", characters)
    small = small.filter((F.col("c") != "") | (F.col("n") <= distance))
    tiny = small.filter(F.col("n") <= distance).select("block", "c", F.col("text").alias("a"))
    met = met.unionByName(
        small.select("block", "c", F.col("text").alias("b")).join(tiny, ["block", "c"]).select("block", "a", "b")
    )
    ordered = met.filter("a <> b").select(
        "block", F.least("a", "b").alias("left"), F.greatest("a", "b").alias("right")
    ).distinct()
    measured = ordered.withColumn("distance", F.levenshtein("left", "right", distance))
    return measured.filter("distance >= 0")
