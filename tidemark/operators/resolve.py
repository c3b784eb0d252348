"""Entity resolution by edit distance without comparing all pairs.

Exact copies collapse to one text first. Each distinct text then emits *traces*: versions of
itself with up to ``max_distance`` characters blanked or removed. Two texts are within the
distance exactly when some shared trace needs few enough edits on both sides (an alignment
with s substitutions, i insertions and d deletions leaves a common trace with s blanks). The
work is linear in the number of texts, and per trace only the smallest text per edit count is
kept, so a trace shared by a third of all texts costs one aggregate, not a quadratic join.

The number of traces per text grows as length**max_distance; distances of 1 or 2 are meant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import shared_root

BLANK = "\x00"


def _one_more_edit() -> Column:
    """All (trace, blanks, removals) one edit away from the current one, and itself."""
    trace, blanks, removals = F.col("trace"), F.col("blanks"), F.col("removals")
    positions = F.sequence(F.lit(1), F.greatest(F.length(trace), F.lit(1)))

    def variants(position: Column) -> Column:
        head = F.substr(trace, F.lit(1), position - 1)
        tail = F.substr(trace, position + 1)
        is_blank = F.substr(trace, position, F.lit(1)) == BLANK
        blanked = F.struct(
            F.concat(head, F.lit(BLANK), tail).alias("trace"),
            (blanks + 1).alias("blanks"),
            removals.alias("removals"),
        )
        removed = F.struct(
            F.concat(head, tail).alias("trace"), blanks.alias("blanks"), (removals + 1).alias("removals")
        )
        # A blanked place is done with; editing it again would count it twice.
        return F.when(is_blank | (F.length(trace) == 0), F.array().cast(
            "array<struct<trace:string,blanks:int,removals:int>>"
        )).otherwise(F.array(blanked, removed))

    here = F.array(F.struct(trace.alias("trace"), blanks.alias("blanks"), removals.alias("removals")))
    return F.array_distinct(F.concat(here, F.flatten(F.transform(positions, variants))))


def traces(texts: DataFrame, max_distance: int) -> DataFrame:
    """(block, text, trace, blanks, removals), one row per distinct trace of each text."""
    out = texts.select(
        "block",
        "text",
        F.col("text").alias("trace"),
        F.lit(0).alias("blanks"),
        F.lit(0).alias("removals"),
    )
    for _ in range(max_distance):
        out = out.select("block", "text", F.inline(_one_more_edit()))
    return out.groupBy("block", "text", "trace", "blanks").agg(F.min("removals").alias("removals"))


def _smallest_two(df: DataFrame) -> DataFrame:
    """Per trace and removal count, the two smallest texts (the second serves the first)."""
    smallest = Window.partitionBy("block", "trace", "blanks", "removals").orderBy("text")
    return (
        df.withColumn("_rank", F.row_number().over(smallest))
        .filter("_rank <= 2")
        .select("block", "trace", "blanks", "removals", F.col("text").alias("other"))
    )


def closest_smaller_text(
    df: DataFrame, text: str, max_distance: int = 1, block: Column | None = None
) -> DataFrame:
    """For each distinct text with a neighbour: the alphabetically first other text within the
    distance in its block, and that distance. Columns ``block, text, match_text, distance``."""
    texts = distinct_texts(df, text, block)
    all_traces = traces(texts, max_distance)
    levels = _smallest_two(all_traces)
    mine = all_traces.withColumnRenamed("removals", "own_removals")
    # A trace has at most 2 * (max_distance + 1) candidates, so this join stays linear.
    met = mine.join(levels, ["block", "trace", "blanks"]).filter(
        (F.col("blanks") + F.col("own_removals") + F.col("removals") <= max_distance)
        & (F.col("text") != F.col("other"))
    )
    return (
        met.groupBy("block", "text")
        .agg(F.min("other").alias("match_text"))
        .withColumn("distance", F.levenshtein("text", "match_text"))
    )


def distinct_texts(df: DataFrame, text: str, block: Column | None = None) -> DataFrame:
    return (
        df.filter(F.col(text).isNotNull())
        .select((F.lit("") if block is None else block).alias("block"), F.col(text).alias("text"))
        .distinct()
    )


def star_links(texts: DataFrame, max_distance: int) -> DataFrame:
    """(block, text, hub): enough links to connect every pair within the distance.

    Per trace the hub is the text with the fewest removals. Whenever two texts meet in a
    trace within the budget, both also meet the hub within the budget, so linking each of
    them to the hub connects them; every link is itself within the distance.
    """
    all_traces = traces(texts, max_distance)
    hubs = all_traces.groupBy("block", "trace", "blanks").agg(
        F.min(F.struct("removals", "text")).alias("_hub")
    )
    return (
        all_traces.join(hubs, ["block", "trace", "blanks"])
        .filter(
            (F.col("blanks") + F.col("removals") + F.col("_hub.removals") <= max_distance)
            & (F.col("text") != F.col("_hub.text"))
        )
        .select("block", "text", F.col("_hub.text").alias("hub"))
        .distinct()
    )


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable from each node.

    Alternating large-star and small-star rounds, which need about log(size) rounds. Each
    round is checkpointed to the shared folder, and only the number of changed links comes
    back to the driver.
    """
    spark = nodes.sparkSession
    shared_root(spark)
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = edges.filter("a <> b").checkpoint()
    changed = 1
    while changed:
        large = _star(edges, larger_only=True)
        small = _star(large, larger_only=False).checkpoint()
        changed = edges.exceptAll(small).limit(1).count() + small.exceptAll(edges).limit(1).count()
        edges = small
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.join(roots, "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )


def _star(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Link neighbours to the smallest neighbour of their centre.

    Large-star centres every node and moves its larger neighbours; small-star centres a node
    on its smaller neighbours and moves those and the node itself. Edges point from the
    larger end ``a`` to the smaller end ``b``.
    """
    if larger_only:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("_m")).select(
            "a", F.least("_m", "a").alias("_m")
        )
        moved = both.join(least, "a").filter(F.col("b") > F.col("a")).select(
            F.col("b").alias("a"), F.col("_m").alias("b")
        )
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("_m"))
        moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
        moved = moved.unionByName(least.withColumnRenamed("_m", "b"))
    return moved.filter("a <> b").distinct()


def golden_records(
    df: DataFrame,
    identifier: str,
    text: str,
    max_distance: int = 1,
    block: Column | None = None,
    survivors: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per resolved entity: ``golden_id`` (smallest member id), ``golden_name`` (most
    frequent spelling, ties alphabetical), member counts, and any extra survivor aggregates.

    Rows with the same text are one node, so their copies never meet each other.
    """
    texts = distinct_texts(df, text, block)
    name = F.concat_ws("\x01", "block", "text")
    links = star_links(texts, max_distance).select(
        name.alias("a"), F.concat_ws("\x01", "block", "hub").alias("b")
    )
    resolved = components(texts.select(name.alias("node")), links)
    rows = df.filter(F.col(text).isNotNull()).withColumn(
        "node", F.concat_ws("\x01", F.lit("") if block is None else block, F.col(text))
    )
    per_spelling = rows.groupBy("node").agg(
        F.min(identifier).alias("_id"),
        F.count("*").alias("_n"),
        F.first(text).alias("_text"),
        *[c.alias(n) for n, c in (survivors or {}).items()],
    )
    return (
        per_spelling.join(resolved, "node")
        .groupBy("component")
        .agg(
            F.min("_id").alias("golden_id"),
            F.min(F.struct(-F.col("_n"), "_text")).getField("_text").alias("golden_name"),
            F.count("*").alias("spelling_count"),
            F.sum("_n").alias("record_count"),
            *[F.max(n).alias(n) for n in (survivors or {})],
        )
        .drop("component")
    )
