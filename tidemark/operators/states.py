"""Mergeable states per day: checks and sketches that a new day extends without reading the old ones.

A state is one row per day (and group) of counts, sums, extremes and sketches. States of disjoint rows
merge, so a suite over any range of days reads rows of days, never the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.checks import Check, _result_columns

#: HLL with 2^12 registers errs by 1.04 / 64 of the count in one of three cases; KLL of size 200 by
#: about 1.65 % of the rank in one of a hundred.
HLL_LOG = 12
HLL_ERROR = 1.04 / 2 ** (HLL_LOG / 2)
KLL_SIZE = 200
KLL_ERROR = 0.0165


@dataclass(frozen=True)
class Measure:
    """A named state: ``kind`` is count, sum, min, max, distinct or quantiles over a SQL expression.

    ``count`` counts the rows on which its expression is true.
    """

    name: str
    kind: str
    value: str = "true"

    def build(self) -> Column:
        x = F.expr(self.value)
        return {
            "count": lambda: F.count_if(x),
            "sum": lambda: F.sum(x),
            "min": lambda: F.min(x),
            "max": lambda: F.max(x),
            "distinct": lambda: F.hll_sketch_agg(x, HLL_LOG),
            "quantiles": lambda: F.kll_sketch_agg_double(x.cast("double"), KLL_SIZE),
        }[self.kind]().alias(self.name)

    def merge(self) -> Column:
        x = F.col(self.name)
        return {
            "count": lambda: F.sum(x),
            "sum": lambda: F.sum(x),
            "min": lambda: F.min(x),
            "max": lambda: F.max(x),
            "distinct": lambda: F.hll_union_agg(x),
            "quantiles": lambda: F.kll_merge_agg_double(x),
        }[self.kind]().alias(self.name)


def build_states(df: DataFrame, measures: Sequence[Measure], *by: str | Column) -> DataFrame:
    """One row of states per group of ``by``."""
    return df.groupBy(*by).agg(*[m.build() for m in measures])


def merge_states(states: DataFrame, measures: Sequence[Measure], *by: str | Column) -> DataFrame:
    """States of coarser groups from those of finer ones."""
    return states.groupBy(*by).agg(*[m.merge() for m in measures])


def distinct_of(name: str) -> Column:
    return F.hll_sketch_estimate(name)


def quantile_of(name: str, share: float) -> Column:
    return F.kll_sketch_get_quantile_double(name, F.lit(share))


def suite_from_states(
    tables: Mapping[str, tuple[DataFrame, Sequence[Measure]]], checks: Sequence[Check]
) -> DataFrame:
    """The rows of ``run_suite`` where each check's value is an expression over merged states."""
    parts = []
    for table, (states, measures) in tables.items():
        group = [c for c in checks if c.table == table]
        if group:
            whole = merge_states(states, measures)
            values = whole.select(*[F.expr(c.value).alias(f"v{i}") for i, c in enumerate(group)])
            rows = F.array(*[_result_columns(c, F.col(f"v{i}")) for i, c in enumerate(group)])
            parts.append(values.select(F.inline(rows)))
    return reduce(DataFrame.unionByName, parts)
