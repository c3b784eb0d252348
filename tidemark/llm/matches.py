"""Places of regular expression matches as DataFrame expressions.

Spark gives the matches of a pattern and the pieces between them, but no places. A match begins
after all earlier pieces and matches, so places are running sums of lengths, counted in code points.

Every intermediate value is bound once (``let``), so an expression over a text names it once however
many patterns look at it: nothing grows when the optimizer moves a filter through.

Patterns use possessive repeats where nothing can be gained by giving back: the Java engine then
loops instead of recursing, and a long run costs one pass and no stack.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

#: Characters on either side of a match that count as near.
NEAR = 60
#: Values that are summed in one array.
BLOCK = 64


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def matched(
    text: Column, pattern: Column | str, gate: Callable[[Column], Column],
    found: Callable[[Column, Column], Column], none: Callable[[Column], Column],
) -> Column:
    """``found(matches, pieces)`` where the pattern occurs in the text, else ``none(text)``.

    ``gate`` is a cheap test that every text with a match passes.
    """
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    split = lambda t: F.split(t, pattern, F.lit(-1))
    some = lambda t, m: F.when(F.size(m) > 0, let(split(t), lambda p: found(m, p))).otherwise(none(t))
    search = lambda t: F.when(gate(t), F.regexp_extract_all(t, pattern, F.lit(0)))
    return let(text, lambda t: let(search(t), lambda m: some(t, m)))


def near(matches: Column, pieces: Column, i: Column) -> tuple[Column, Column]:
    """The ``NEAR`` characters of the text before and after match ``i``, other matches among them.

    A match has one character at least, so as many neighbours on a side are enough; of each no more
    than so many characters are looked at.
    """
    most = F.lit(NEAR)
    ends = lambda p, m: F.concat(F.right(p, most), F.right(m, most))
    heads = lambda p, m: F.concat(F.left(p, most), F.coalesce(F.left(m, most), F.lit("")))
    first, n = F.greatest(i - NEAR, F.lit(0)) + 1, F.least(i, most)
    earlier = F.zip_with(F.slice(pieces, first, n), F.slice(matches, first, n), ends)
    later = F.zip_with(F.slice(pieces, i + 2, most + 1), F.slice(matches, i + 2, most), heads)
    before = F.concat(F.array_join(earlier, ""), F.right(F.get(pieces, i), most))
    return F.right(before, most), F.left(F.array_join(later, ""), most)


PLACE = "struct<match: string, start: bigint, end: bigint, score: double>"
#: The score of a match, null for one that is none, from ``score(match, before, after)``.
Score = Callable[[Column, Column, Column], Column]


def _running(values: Column, levels: int = 3) -> Column:
    """Running sums of an array of whole numbers.

    An array that grows by appending is copied at every step, so sums are appended in blocks of at most
    ``BLOCK`` and each block begins with the sum of those before, found the same way. Three levels keep
    the work in proportion to the array up to ``BLOCK``^3 values.
    """
    state = "struct<at: bigint, done: array<bigint>>"
    empty = lambda at: F.struct(at.cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("done")).cast(state)

    def within(block: Column, before: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            at = acc["at"] + x
            return F.struct(at.alias("at"), F.array_append(acc["done"], at).alias("done")).cast(state)

        return F.aggregate(block, empty(before), step, lambda acc: acc["done"])

    if levels == 1:
        return within(values, F.lit(0))

    def blocked(v: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int"))
        blocks = F.transform(numbers, lambda b: F.slice(v, b * BLOCK + 1, F.lit(BLOCK)))
        sums = lambda bs: F.transform(bs, lambda x: F.aggregate(x, F.lit(0).cast("bigint"), lambda a, y: a + y))
        return let(
            blocks,
            lambda bs: let(
                _running(sums(bs), levels - 1),
                lambda ends: F.flatten(
                    F.transform(bs, lambda x, i: within(x, F.when(i > 0, F.get(ends, i - 1)).otherwise(F.lit(0))))
                ),
            ),
        )

    return let(values, lambda v: F.when(F.size(v) <= BLOCK, within(v, F.lit(0))).otherwise(blocked(v)))


def _places(matches: Column, pieces: Column, score: Score) -> Column:
    length = lambda x: F.length(x).cast("bigint")
    steps = F.transform(matches, lambda m, i: length(m) + length(F.get(pieces, i)))

    def row(ends: Column, m: Column, i: Column) -> Column:
        end = F.get(ends, i)
        return F.struct(
            m.alias("match"), (end - length(m)).alias("start"), end.alias("end"),
            score(m, *near(matches, pieces, i)).alias("score"),
        ).cast(PLACE)

    return let(_running(steps), lambda ends: F.transform(matches, lambda m, i: row(ends, m, i)))


def places(
    text: Column, pattern: Column | str, gate: Callable[[Column], Column],
    score: Score = lambda *_: F.lit(None),
) -> Column:
    """The matches as structs (match, start, end, score), in order; empty without any."""
    found = lambda m, p: _places(m, p, score)
    return matched(text, pattern, gate, found, lambda t: F.array().cast(f"array<{PLACE}>"))


def replaced(
    text: Column, pattern: str, gate: Callable[[Column], Column],
    tagged: Callable[[Column, Column, Column], Column], tag: str,
) -> Column:
    """``text`` with every match for which ``tagged(match, before, after)`` holds turned into ``tag``."""

    def put(matches: Column, pieces: Column) -> Column:
        new = lambda m, i: F.when(tagged(m, *near(matches, pieces, i)), F.lit(tag)).otherwise(m)
        parts = F.transform(matches, lambda m, i: F.concat(F.get(pieces, i), new(m, i)))
        return F.concat(F.array_join(parts, ""), F.element_at(pieces, -1))

    return matched(text, pattern, gate, put, lambda t: t)
