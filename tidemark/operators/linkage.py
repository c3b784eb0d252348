"""Record linkage by agreement weights, without pairing records.

Records agree on a field in full, in part, or not at all. How many pairs agree at least so far on every
field is a sum over groups of equal keys, n(n-1)/2 each; differences of these sums count the pairs of
every exact pattern. Expectation-maximisation then runs on this table, which has at most 3^fields rows.

Weights grow with agreement, so the patterns above a threshold are those at or above a few least ones,
and the records of one key of a least pattern are all linked: a star to its smallest id does for all
their pairs.
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

Pattern = tuple[int, ...]


@dataclass(frozen=True)
class Field:
    """A field: records agree in full on ``full``, in part on ``part`` (nothing in part if absent).

    Equal ``full`` values must have equal ``part`` values. NULL agrees with nothing.
    """

    name: str
    full: Column
    part: Column | None = None

    @property
    def levels(self) -> int:
        return 2 if self.part is None else 3

    def key(self, level: int) -> Column:
        top = level == self.levels - 1
        return (self.full if top else self.part).cast("string")


def patterns(fields: Sequence[Field]) -> list[Pattern]:
    return list(itertools.product(*[range(f.levels) for f in fields]))


def _key(fields: Sequence[Field], pattern: Pattern) -> Column:
    """What records must share to agree at least so far; NULL where a needed value is missing."""
    parts = [f.key(level) for f, level in zip(fields, pattern, strict=True) if level]
    missing = F.lit(False)
    for p in parts:
        missing = missing | p.isNull()
    return F.when(~missing, F.to_json(F.array(*parts)) if parts else F.lit(""))


def pattern_counts(df: DataFrame, fields: Sequence[Field]) -> dict[Pattern, int]:
    """Pairs of records per exact pattern of agreement. One aggregation; no pair is formed."""
    ask = patterns(fields)
    keys = F.array(*[F.struct(F.lit(i).alias("p"), _key(fields, p).alias("k")) for i, p in enumerate(ask)])
    groups = df.select(F.inline(keys)).filter("k IS NOT NULL").groupBy("p", "k").agg(F.count("*").alias("n"))
    pairs = F.sum((F.col("n") * (F.col("n") - 1) / 2).cast("decimal(38,0)"))
    found = {ask[r.p]: int(r.pairs) for r in groups.groupBy("p").agg(pairs.alias("pairs")).collect()}
    counts = {p: found.get(p, 0) for p in ask}
    # "At least" becomes "exactly", field by field, from the lowest level up.
    for at, f in enumerate(fields):
        for level in range(f.levels - 1):
            for p in ask:
                if p[at] == level:
                    counts[p] -= counts[p[:at] + (level + 1,) + p[at + 1 :]]
    return counts


@dataclass(frozen=True)
class Weights:
    """Log-odds per field and level, and the share of matching pairs."""

    share: float
    match: tuple[tuple[float, ...], ...]
    other: tuple[tuple[float, ...], ...]

    def of(self, pattern: Pattern) -> float:
        return sum(float(np.log2(m[x] / u[x])) for m, u, x in zip(self.match, self.other, pattern, strict=True))


def fit_weights(counts: Mapping[Pattern, int], rounds: int = 50, start: float = 0.1, floor: float = 1e-9) -> Weights:
    """Agreement weights by expectation-maximisation over the counted patterns."""
    ask = sorted(counts)
    n = np.array([counts[p] for p in ask], float)
    table = np.array(ask)
    levels = table.max(axis=0) + 1
    match = [np.linspace(1, 9, k) / np.linspace(1, 9, k).sum() for k in levels]
    other = [m[::-1].copy() for m in match]
    share = start
    for _ in range(rounds):
        like = lambda odds: np.prod([o[table[:, i]] for i, o in enumerate(odds)], axis=0)
        a, b = share * like(match), (1 - share) * like(other)
        g = a / np.maximum(a + b, 1e-300)
        for odds, weight in ((match, n * g), (other, n * (1 - g))):
            for i, k in enumerate(levels):
                mass = np.bincount(table[:, i], weight, k) + floor
                odds[i] = mass / mass.sum()
        share = float(np.clip((n * g).sum() / max(n.sum(), 1.0), floor, 1 - floor))
    freeze = lambda odds: tuple(tuple(map(float, o)) for o in odds)
    return Weights(share, freeze(match), freeze(other))


def least_patterns(fields: Sequence[Field], weight, threshold: float) -> list[Pattern]:
    """The accepted patterns that no other accepted one lies below.

    Weights that do not grow with agreement are refused, since then pairs cannot be left unformed.
    """
    ask = patterns(fields)
    good = [p for p in ask if weight(p) >= threshold]
    below = lambda a, b: a != b and all(x <= y for x, y in zip(a, b, strict=True))
    for p in good:
        if any(below(p, q) and q not in good for q in ask):
            raise ValueError("weights must not fall as agreement grows")
    return [p for p in good if not any(below(q, p) for q in good)]


def match_links(
    df: DataFrame, identifier: str, fields: Sequence[Field], weight, threshold: float
) -> DataFrame:
    """(a, b): links that connect every pair of records whose weight reaches the threshold."""
    least = least_patterns(fields, weight, threshold)
    keys = F.array(*[F.struct(F.lit(i).alias("p"), _key(fields, p).alias("k")) for i, p in enumerate(least)])
    placed = df.select(F.col(identifier).alias("a"), F.inline(keys)).filter("k IS NOT NULL AND a IS NOT NULL")
    heads = placed.groupBy("p", "k").agg(F.min("a").alias("b"))
    return placed.join(heads, ["p", "k"]).filter("a <> b").select("a", "b").distinct()
