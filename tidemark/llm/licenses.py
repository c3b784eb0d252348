"""Licence scan: ordered signature rules behind keywords, overlaps resolved by priority.

All of it is DataFrame expressions. A text is offered only the rules whose keyword it holds; their
matches become intervals. An interval goes if another one of a stronger tier, or a longer one of its
own tier, contains it: with the intervals of a text in order of start, that is a running maximum of
the ends per tier, so many detections in one text cost a sort and no pairs.

Besides, places where the words of four basic phrases stand consecutively are counted exactly.

Null and empty texts have no words and no detections. Every row gets a number of its own before
detections are spread over rows, so repeated ids are told apart; extra columns are not looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.license_rules import NOTICE, SCORES, Rule, rules
from tidemark.llm.matches import matched, places

#: Basic phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by",
    "mit license": "mit",
}
PHRASE_SCORE = 0.8
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def any_holds(text: Column, parts: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(p)) for p in parts])


def blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" ")))


def phrase_places(line: Column, n_words: Column) -> Column:
    """For every basic phrase in a line of words: (label, n, first, last), in the order of PHRASES.

    The line has one blank before, between and after its words. The words before a match are the
    blanks before it less one, those after it the blanks after it less one.
    """

    def one(phrase: str, label: str) -> Column:
        length = phrase.count(" ") + 1
        row = lambda m, p: F.struct(
            F.lit(label).alias("label"), F.size(m).cast("bigint").alias("n"),
            (blanks(F.get(p, F.lit(0))) - 1).cast("bigint").alias("first"),
            (n_words - length - (blanks(F.element_at(p, -1)) - 1)).cast("bigint").alias("last"),
        )
        none = F.lit(None).cast("struct<label: string, n: bigint, first: bigint, last: bigint>")
        gate = lambda t: F.contains(t, F.lit(f" {phrase} "))
        return matched(line, rf"(?<= ){phrase}(?= )", gate, row, lambda t: none)

    return F.array_compact(F.array(*[one(*pair) for pair in PHRASES.items()]))


def with_phrases(df: DataFrame) -> DataFrame:
    """Add n_words, n_base, first_word, last_word and base_labels for the column ``low``."""
    low = F.col("low")
    heads = [phrase.split(" ")[0] for phrase in PHRASES]
    line = F.concat(F.lit(" "), F.trim(F.regexp_replace(low, GAPS, " ")), F.lit(" "))
    df = df.withColumn("n_words", F.regexp_count(low, F.lit(WORD)).cast("bigint"))
    found = phrase_places(F.when(any_holds(low, heads), line), F.col("n_words"))
    df = df.withColumn("base", F.coalesce(found, F.array().cast("array<struct<label: string, n: bigint, first: bigint, last: bigint>>")))
    total = F.aggregate("base", F.lit(0).cast("bigint"), lambda a, x: a + x["n"])
    return df.withColumns(
        {
            "n_base": total,
            "first_word": F.array_min(F.transform("base", lambda x: x["first"])),
            "last_word": F.array_max(F.transform("base", lambda x: x["last"])),
            "base_labels": F.array_sort(F.transform("base", lambda x: x["label"])),
        }
    ).drop("base")


def candidates(low: Column, rule_list: tuple[Rule, ...]) -> Column:
    """The rules whose keyword the text holds.

    A keyword is looked for once, however many rules have it.
    """
    by_keyword: dict[str, list[tuple[int, Rule]]] = {}
    for i, rule in enumerate(rule_list):
        by_keyword.setdefault(rule.keyword, []).append((i, rule))
    table = F.array(
        *[
            F.struct(
                F.lit(keyword).alias("keyword"),
                F.array(
                    *[
                        F.struct(
                            F.lit(i).alias("rule"), F.lit(r.label).alias("label"),
                            F.lit(r.tier).alias("tier"), F.lit(r.pattern).alias("pattern"),
                        )
                        for i, r in members
                    ]
                ).alias("rules"),
            )
            for keyword, members in by_keyword.items()
        ]
    )
    return F.flatten(F.transform(F.filter(table, lambda k: F.contains(low, k["keyword"])), lambda k: k["rules"]))


def detections(docs: DataFrame, rule_list: tuple[Rule, ...], carry: list[str]) -> DataFrame:
    """Rows of (carry, label, tier, rule, start, end, kept), one at least per row of ``docs``.

    ``docs`` has ``uid``, ``low`` and the carried columns; a row without detections has null in the
    others. Starts and ends count code points, the end is exclusive.
    """
    offered = docs.select("uid", *carry, "low", F.explode_outer(candidates(F.col("low"), rule_list)).alias("r"))
    found = places(F.col("low"), F.col("r.pattern"), lambda t: F.col("r").isNotNull())
    spread = offered.select("uid", *carry, "r.label", "r.tier", "r.rule", F.explode_outer(found).alias("at"))
    rows = spread.select("uid", *carry, "label", "tier", "rule", "at.start", "at.end")
    # A rule without a match leaves a row with null places, so that the text itself is not lost.
    before = (
        Window.partitionBy("uid")
        .orderBy("start", F.col("end").desc(), "tier", "rule")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    furthest = {
        f"end{t}": F.max(F.when(F.col("tier") <= t, F.col("end"))).over(before) for t in range(1, NOTICE + 1)
    }
    cover = reduce(
        lambda rest, t: F.when(F.col("tier") == t, F.col(f"end{t}")).otherwise(rest),
        range(1, NOTICE + 1), F.lit(None).cast("bigint"),
    )
    kept = F.col("end").isNotNull() & ~F.coalesce(cover >= F.col("end"), F.lit(False))
    return rows.withColumns(furthest).withColumn("kept", kept).drop(*furthest)


def scan(
    docs: DataFrame, rule_list: tuple[Rule, ...] | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: words, basic phrases, labels, score and detections kept."""
    rule_list = rules() if rule_list is None else rule_list
    texts = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("bigint").alias("doc_id"),
        lower_ascii(F.coalesce(text_col, F.lit(""))).alias("low"),
    )
    base = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    rows = detections(with_phrases(texts), rule_list, base)
    weight = reduce(
        lambda rest, t: F.when(F.col("tier") == t, F.lit(SCORES[t])).otherwise(rest), SCORES, F.lit(0.0)
    )
    detection = F.when(F.col("kept"), F.struct("start", "end", "tier", "rule", "label"))
    grouped = rows.groupBy("uid").agg(
        *[F.first(c).alias(c) for c in base],
        F.array_sort(F.collect_list(detection)).alias("detections"),
        F.max(F.when(F.col("kept"), weight)).alias("best"),
    )
    own = F.transform("detections", lambda d: d["label"])
    labels = F.array_sort(F.array_distinct(F.concat("base_labels", own)))
    base_score = F.when(F.col("n_base") > 0, F.lit(PHRASE_SCORE)).otherwise(F.lit(0.0))
    return grouped.select(
        *base[:-1], F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.greatest(F.coalesce("best", F.lit(0.0)), base_score).alias("score"), "detections",
    )
